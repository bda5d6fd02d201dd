"""Raw response parsing: the transform smoke record and the malformed-input matrix."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wxspark.sources import raw_json

MOCK = {
    "name": "Kolkata",
    "sys": {"country": "IN"},
    "main": {"temp": 34.2, "feels_like": 40.1, "temp_min": 30.0, "temp_max": 36.5, "humidity": 78, "pressure": 1005},
    "wind": {"speed": 3.6, "deg": 200},
    "weather": [{"main": "Clouds", "description": "overcast clouds"}],
    "visibility": 6000,
    "clouds": {"all": 90},
    "dt": 1694784000,
    "_extracted_at": "2024-09-15T14:30:00.000000",
}


def parse(spark, docs):
    df = spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)], "i int, doc string")
    raw = raw_json.parse_docs(df, F.col("doc"), keep=("i",))
    good, bad = raw_json.split_raw(raw, keep=("i",))
    return {r.i: r for r in good.collect()}, {r.i: r.reason for r in bad.collect()}


def test_mock_record_golden(spark):
    good, bad = parse(spark, [MOCK])
    r = good[0]
    assert not bad
    assert (r.city, r.country, r.temperature_c, r.feels_like_c, r.temp_min_c, r.temp_max_c) == ("Kolkata", "IN", 34.2, 40.1, 30.0, 36.5)
    assert (r.humidity_pct, r.pressure_hpa, r.wind_speed_mps, r.wind_direction_deg) == (78, 1005, 3.6, 200)
    assert (r.weather_condition, r.weather_description, r.visibility_m, r.cloudiness_pct) == ("Clouds", "Overcast Clouds", 6000, 90)
    assert r.recorded_at == datetime(2023, 9, 15, 13, 20) and r.extracted_at == datetime(2024, 9, 15, 14, 30)


def variant(**changes):
    d = json.loads(json.dumps(MOCK))
    for k, v in changes.items():
        path = k.split("__")
        tgt = d
        for p in path[:-1]:
            tgt = tgt[p]
        if v is KeyError:
            tgt.pop(path[-1], None)
        else:
            tgt[path[-1]] = v
    return d


@pytest.mark.parametrize(
    "doc,check",
    [
        ('{"name": "Kolkata", ', lambda g, b: b == {0: "malformed_json"}),
        (variant(main=5), lambda g, b: b == {0: "malformed_json"}),
        (variant(dt="abc"), lambda g, b: b == {0: "non_numeric_dt"}),
        (variant(dt=KeyError), lambda g, b: g[0].recorded_at is None),
        (variant(dt=0), lambda g, b: g[0].recorded_at is None),
        (variant(weather=KeyError), lambda g, b: (g[0].weather_condition, g[0].weather_description) == ("", "")),
        (variant(weather=None), lambda g, b: g[0].weather_condition == ""),
        (variant(weather=[]), lambda g, b: g[0].weather_condition == ""),
        (variant(main=KeyError), lambda g, b: g[0].temperature_c is None and g[0].humidity_pct is None),
        (variant(main=None), lambda g, b: g[0].temperature_c is None),
        (variant(name=KeyError), lambda g, b: g[0].city == ""),
        (variant(name=None), lambda g, b: g[0].city == ""),
        (variant(main__temp="32.5"), lambda g, b: g[0].temperature_c == 32.5),
        (variant(main__temp="x"), lambda g, b: g[0].temperature_c is None),
        (variant(main__humidity=55.5), lambda g, b: g[0].humidity_pct is None),
        (variant(name=" Kolkata "), lambda g, b: g[0].city == "Kolkata"),
    ],
)
def test_malformed_matrix_alone_and_mixed(spark, doc, check):
    good, bad = parse(spark, [doc])
    assert check(good, bad)
    good2, bad2 = parse(spark, [doc, MOCK])  # a good record next to it is unaffected
    assert good2[1].city == "Kolkata"
    assert check({k: v for k, v in good2.items() if k == 0}, {k: v for k, v in bad2.items() if k == 0})


def test_landing_files_json_lines_and_arrays(spark, tmp_dir):
    lines = os.path.join(tmp_dir, "lines")
    os.makedirs(lines)
    with open(os.path.join(lines, "a.json"), "w") as f:
        f.write(json.dumps(MOCK) + "\n" + "{broken\n" + json.dumps(variant(name="Delhi")) + "\n")
    arrays = os.path.join(tmp_dir, "arrays")
    os.makedirs(arrays)
    with open(os.path.join(arrays, "b.json"), "w") as f:
        json.dump([MOCK, variant(name="Pune")], f, indent=4)
    good, bad = raw_json.split_raw(raw_json.read_raw(spark, lines).cache(), keep=("source_file",))
    assert sorted(r.city for r in good.collect()) == ["Delhi", "Kolkata"] and bad.count() == 1
    good_a, bad_a = raw_json.split_raw(raw_json.read_raw(spark, arrays, multiline=True).cache())
    assert sorted(r.city for r in good_a.collect()) == ["Kolkata", "Pune"] and bad_a.count() == 0


def test_live_profile(spark):
    df = spark.createDataFrame([(json.dumps(variant(main__temp=26.5, main__temp_min=KeyError)),)], "doc string")
    raw = raw_json.parse_docs(df, F.col("doc"))
    now = datetime(2024, 9, 15, 15, 0)
    r = raw_json.flatten_live(raw, F.lit(now)).first()
    assert r.temperature_c == 26.0 and r.temp_min_c == 26.0 and r.feels_like_c == 40.0  # half-even
    assert r.comfort_level == "Warm" and r.weather_description == "overcast clouds"
    assert r.recorded_at == now and r.wind_direction_deg is None and r.heat_index_c is None
    missing = spark.createDataFrame([(json.dumps(variant(wind=KeyError)),)], "doc string")
    raw2 = raw_json.parse_docs(missing, F.col("doc"))
    assert raw_json.flatten_live(raw2, F.lit(now)).count() == 0
