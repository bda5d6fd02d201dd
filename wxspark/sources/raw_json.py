"""Raw weather responses (nested JSON) -> typed observations, plus the reject stream.

Numeric leaves are declared STRING on purpose: Spark renders a JSON number into a string
field, numeric text survives, and a tolerant cast afterwards reproduces
``to_numeric(errors="coerce")``. Declaring DOUBLE would null "32.5" and mark the whole
row corrupt.

Landing format is JSON lines (one response per line, splittable, one bad line loses one
record). ``multiline=True`` replays legacy pretty-printed arrays; there a single broken
element makes the whole file one corrupt row (Spark's unit of parsing is the file).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wxspark.functions import expr as X

S = T.StringType()

RAW = T.StructType(
    [
        T.StructField("name", S),
        T.StructField("sys", T.StructType([T.StructField("country", S), T.StructField("sunrise", S), T.StructField("sunset", S)])),
        T.StructField(
            "main",
            T.StructType([T.StructField(n, S) for n in ("temp", "feels_like", "temp_min", "temp_max", "humidity", "pressure")]),
        ),
        T.StructField("wind", T.StructType([T.StructField("speed", S), T.StructField("deg", S)])),
        T.StructField("weather", T.ArrayType(T.StructType([T.StructField("main", S), T.StructField("description", S)]))),
        T.StructField("clouds", T.StructType([T.StructField("all", S)])),
        T.StructField("visibility", S),
        T.StructField("dt", S),
        T.StructField("timezone", S),
        T.StructField("_extracted_at", S),
        T.StructField("_corrupt_record", S),
    ]
)
CORRUPT = "_corrupt_record"


def read_raw(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Read landing files with the fixed schema and the columns of :func:`with_lineage`, and
    ``raw_pos``, whose order within a block is that of its lines."""
    reader = (
        spark.read.schema(RAW)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multiline)
    )
    return with_lineage(reader.json(path)).withColumn("raw_pos", F.monotonically_increasing_id())


def stream_raw(spark: SparkSession, path: str, multiline: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """The landing folder as a stream of files, in the columns of :func:`with_lineage`."""
    reader = (
        spark.readStream.schema(RAW)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multiline)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_lineage(reader.json(path))


def with_lineage(files: DataFrame) -> DataFrame:
    """Add where a document came from: ``source_file`` and ``block_start``, the offset of the
    block it was read in. A document without an extraction time is stamped with the time its
    file landed, so that it has a place in the order of ingest.

    (``source_file``, ``block_start``, ``raw_pos``) is the order of lines in a file however
    the blocks are packed into tasks; ``raw_pos`` alone is not.
    """
    landed = F.date_format("_metadata.file_modification_time", "yyyy-MM-dd'T'HH:mm:ss")
    return files.withColumns(
        {
            "_extracted_at": F.coalesce("_extracted_at", landed),
            "source_file": F.col("_metadata.file_path"),
            "block_start": F.col("_metadata.file_block_start"),
        }
    )


def parse_json(text: Column) -> Column:
    """One JSON document (text column) -> RAW struct (corrupt text kept in ``_corrupt_record``)."""
    return F.from_json(text, RAW, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def parse_docs(df: DataFrame, text: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of JSON text -> ``keep`` columns + the RAW columns, parsed once per row.

    A filter on parsed fields (the reject split) would otherwise be pushed below the
    parse by alias substitution, so every reference to the parsed struct would parse the
    text again. A one-element ``inline`` is a generator: filters on its output stay
    above it, and the document is parsed exactly once.
    """
    return df.select(*keep, F.inline(F.array(parse_json(text))))


def _first_weather() -> Column:
    return F.get(F.col("weather"), 0)


def reject_reason() -> Column:
    """Why a raw record cannot become an observation (NULL when it can)."""
    dt = F.col("dt")
    return (
        F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed_json"))
        .when(dt.isNotNull() & X.to_double(dt).isNull(), F.lit("non_numeric_dt"))
        .when(~X.epoch_in_range(dt), F.lit("dt_out_of_range"))
    )


def flatten(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """RAW rows -> the 16 parsed observation fields (+ ``keep`` columns), batch profile.

    Missing nested objects behave as empty: struct access on NULL is NULL. Missing text
    defaults to "" (``.get(k, "")``); description is title-cased; city is stripped.
    """
    w = _first_weather()
    return raw.select(
        *keep,
        X.strip_whitespace(F.coalesce(F.col("name"), F.lit(""))).alias("city"),
        F.coalesce(F.col("sys.country"), F.lit("")).alias("country"),
        X.to_double("main.temp").alias("temperature_c"),
        X.to_double("main.feels_like").alias("feels_like_c"),
        X.to_double("main.temp_min").alias("temp_min_c"),
        X.to_double("main.temp_max").alias("temp_max_c"),
        X.to_int("main.humidity").alias("humidity_pct"),
        X.to_int("main.pressure").alias("pressure_hpa"),
        X.to_double("wind.speed").alias("wind_speed_mps"),
        X.to_int("wind.deg").alias("wind_direction_deg"),
        F.coalesce(w["main"], F.lit("")).alias("weather_condition"),
        X.title_case(F.coalesce(w["description"], F.lit(""))).alias("weather_description"),
        X.to_int("visibility").alias("visibility_m"),
        X.to_int("clouds.all").alias("cloudiness_pct"),
        X.epoch_to_timestamp("dt").alias("recorded_at"),
        X.iso_truncate("_extracted_at").alias("extracted_at"),
    )


def split_raw(raw: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(observations, rejects). Rejects keep the raw text (or record) and a reason."""
    reason = reject_reason()
    tagged = raw.withColumn("_reject", reason)
    good = flatten(tagged.where(F.col("_reject").isNull()), keep)
    bad = tagged.where(F.col("_reject").isNotNull()).select(
        *keep,
        F.col("_reject").alias("reason"),
        F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*[c for c in RAW.fieldNames() if c != CORRUPT]))).alias("raw"),
    )
    return good, bad


LIVE_REQUIRED = ("name", "sys.country")
LIVE_NUMBERS = {"main.temp": X.to_double, "main.feels_like": X.to_double, "main.humidity": X.to_int, "main.pressure": X.to_int, "wind.speed": X.to_double}


def flatten_live(raw: DataFrame, now: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Live-page profile: temps rounded half-even to whole degrees, description as sent,
    no wind direction or heat index, visibility default 10000, clouds default 0, min/max
    fall back to temp, comfort on the live bands, recorded_at = extracted_at = ``now``.
    A record missing any required field, or with text for a required number, is skipped
    (the live page shows nothing)."""
    w = _first_weather()
    ok = F.lit(True)
    for c in LIVE_REQUIRED:
        ok = ok & F.col(c).isNotNull()
    for c, number in LIVE_NUMBERS.items():
        ok = ok & number(c).isNotNull()
    ok = ok & w["main"].isNotNull() & w["description"].isNotNull() & F.col(CORRUPT).isNull()
    temp = F.rint(X.to_double("main.temp"))
    return raw.where(ok).select(
        *keep,
        F.col("name").alias("city"),
        F.col("sys.country").alias("country"),
        temp.alias("temperature_c"),
        F.rint(X.to_double("main.feels_like")).alias("feels_like_c"),
        F.rint(F.coalesce(X.to_double("main.temp_min"), X.to_double("main.temp"))).alias("temp_min_c"),
        F.rint(F.coalesce(X.to_double("main.temp_max"), X.to_double("main.temp"))).alias("temp_max_c"),
        X.to_int("main.humidity").alias("humidity_pct"),
        X.to_int("main.pressure").alias("pressure_hpa"),
        X.to_double("wind.speed").alias("wind_speed_mps"),
        F.lit(None).cast("int").alias("wind_direction_deg"),
        w["main"].alias("weather_condition"),
        w["description"].alias("weather_description"),
        F.coalesce(X.to_int("visibility"), F.lit(10000)).alias("visibility_m"),
        F.coalesce(X.to_int("clouds.all"), F.lit(0)).alias("cloudiness_pct"),
        F.lit(None).cast("double").alias("heat_index_c"),
        X.comfort_level(temp, "live").alias("comfort_level"),
        now.cast("timestamp_ntz").alias("recorded_at"),
        now.cast("timestamp_ntz").alias("extracted_at"),
    )


def observation_to_raw(df: DataFrame) -> Column:
    """Observation row -> the raw response document (JSON text), as the provider sends it.

    Used to land replayable raw files and to round-trip the parser. NULL fields are
    omitted from the document, i.e. they arrive as *missing* keys.
    """
    epoch = F.unix_timestamp(F.col("recorded_at").cast("timestamp"))
    doc = F.struct(
        F.col("city").alias("name"),
        F.struct(F.col("country").alias("country")).alias("sys"),
        F.struct(
            F.col("temperature_c").alias("temp"),
            F.col("feels_like_c").alias("feels_like"),
            F.col("temp_min_c").alias("temp_min"),
            F.col("temp_max_c").alias("temp_max"),
            F.col("humidity_pct").alias("humidity"),
            F.col("pressure_hpa").alias("pressure"),
        ).alias("main"),
        F.struct(F.col("wind_speed_mps").alias("speed"), F.col("wind_direction_deg").alias("deg")).alias("wind"),
        F.array(
            F.struct(F.col("weather_condition").alias("main"), F.col("weather_description").alias("description"))
        ).alias("weather"),
        F.struct(F.col("cloudiness_pct").alias("all")).alias("clouds"),
        F.col("visibility_m").alias("visibility"),
        epoch.alias("dt"),
        F.date_format(F.col("inserted_at"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_extracted_at"),
    )
    return F.to_json(doc)
