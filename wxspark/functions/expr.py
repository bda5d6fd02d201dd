"""Scalar column functions (native Spark expressions only, no Python UDFs).

Every function takes and returns ``pyspark.sql.Column`` so it stays inside whole-stage
codegen and can be used from the DataFrame API or registered views alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------
# Heat index polynomial coefficients (simplified Steadman), in the order
# c0 + c1*T + c2*H - c3*T*H - c4*T^2 - c5*H^2 + c6*T^2*H + c7*T*H^2 - c8*T^2*H^2
HEAT_INDEX_COEFFICIENTS = (
    -8.78469475556,
    1.61139411,
    2.33854883889,
    0.14611605,
    0.012308094,
    0.016424828,
    0.002211732,
    0.00072546,
    0.000003582,
)
# Comfort bands: upper bounds (exclusive) for Cold, Cool, Comfortable, Warm; above is Hot.
COMFORT_PROFILES = {
    "batch": (10.0, 20.0, 28.0, 35.0),
    "live": (10.0, 18.0, 26.0, 33.0),
}
COMFORT_LABELS = ("Cold", "Cool", "Comfortable", "Warm", "Hot")
# Weather condition -> icon. "Clear" depends on the time of day; anything else unknown
# gets the default icon.
CONDITION_ICONS = {
    "Clouds": "☁️",
    "Rain": "🌧️",
    "Drizzle": "🌦️",
    "Thunderstorm": "⛈️",
    "Snow": "❄️",
    "Mist": "🌫️",
    "Fog": "🌫️",
    "Haze": "🌫️",
    "Smoke": "💨",
    "Dust": "🌪️",
    "Sand": "🌪️",
    "Tornado": "🌪️",
}
CLEAR_ICONS = {"night": "🌙", "dawn": "🌄", "dusk": "🌄", "day": "☀️"}
DEFAULT_ICON = "🌤️"
# Time-of-day bands by local hour: night h>=20 or h<5, dawn 5-6, day 7-16, dusk 17-19.
TIME_OF_DAY_BOUNDS = {"dawn": 5, "day": 7, "dusk": 17, "night": 20}
# Gauge scaling: wind / 25 m/s, (pressure - 870) / 215 hPa, visibility / 15 km; defaults
# when a value is missing: humidity 50, wind 30, pressure 60, visibility 75, clouds 40.
GAUGE_WIND_FULL_MPS = 25.0
GAUGE_PRESSURE_BASE_HPA = 870.0
GAUGE_PRESSURE_SPAN_HPA = 215.0
GAUGE_VISIBILITY_FULL_KM = 15.0
GAUGE_DEFAULTS = {"humidity": 50, "wind": 30, "pressure": 60, "visibility": 75, "clouds": 40}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- rounding -----------------------------------------------------------------------

def round_half_even(x, digits: int) -> Column:
    """Round like numpy/pandas: half-to-even on the *scaled binary* value.

    ``F.round`` rounds half-up on the decimal text (0.125 -> 0.13); numpy computes
    ``rint(x * 10**n) / 10**n`` (0.125 -> 0.12, 1.005 -> 1.0). We do the same.
    """
    scale = float(10 ** digits)
    return F.rint(_c(x) * F.lit(scale)) / F.lit(scale)


def exact_mean(x, decimals: int) -> Column:
    """Mean of a column whose values carry at most ``decimals`` decimals (e.g. our rounded
    heat index), computed as an exact integer sum over an exact count.

    A floating-point ``avg`` depends on summation order, so a mean sitting on a rounding
    tie (57.225) could round either way from run to run; the integer sum cannot.
    """
    scale = 10 ** decimals
    scaled = F.rint(_c(x) * F.lit(float(scale))).cast("bigint")
    return F.sum(scaled).cast("double") / (F.count(scaled).cast("double") * F.lit(float(scale)))


# --- tolerant casts (pandas ``to_numeric(errors="coerce")``) -----------------------------

def nan_to_null(x) -> Column:
    """pandas treats NaN as missing; Spark does not. Normalise at ingestion."""
    return F.nanvl(_c(x), F.lit(None).cast("double"))


def to_double(x) -> Column:
    """Unparseable -> NULL, NaN -> NULL."""
    return nan_to_null(_c(x).try_cast("double"))


def to_int(x) -> Column:
    """Integral numbers only: 55.5 -> NULL (pandas refuses the Int64 cast), "7" -> 7."""
    d = to_double(x)
    return F.when(d == F.floor(d), d.try_cast("int"))


def to_timestamp_ntz(x) -> Column:
    """``to_datetime(errors="coerce")`` on text -> naive timestamp or NULL."""
    return _c(x).cast("string").try_cast("timestamp_ntz")


# --- time --------------------------------------------------------------------------------

# Unix seconds of the first and last second of the years 1 to 9999.
FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799


def epoch_in_range(x) -> Column:
    """Unix seconds (text or number) within the years 1 to 9999; NULL for NULL or no number."""
    return to_double(x).between(float(FIRST_SECOND), float(LAST_SECOND) + 0.999)


def epoch_to_timestamp(x) -> Column:
    """Unix seconds (text or number) -> naive UTC timestamp cut to the second; 0, NULL and
    seconds outside the years 1 to 9999 (infinite ones too) -> NULL."""
    seconds = F.when(epoch_in_range(x), to_double(x))
    return F.when(seconds != 0, F.timestamp_seconds(F.floor(seconds)).cast("timestamp_ntz"))


def iso_truncate(x) -> Column:
    """ISO-8601 text cut to seconds (first 19 chars, ``T`` -> space) -> naive timestamp."""
    text = F.replace(F.substring(_c(x).cast("string"), 1, 19), F.lit("T"), F.lit(" "))
    return F.when(F.length(text) > 0, text.try_cast("timestamp_ntz"))


def trunc_hour_ntz(x) -> Column:
    """``date_trunc`` returns LTZ in Spark; cast back so the column stays naive."""
    return F.date_trunc("HOUR", _c(x)).cast("timestamp_ntz")


def local_time(ts, offset_seconds) -> Column:
    """City-local wall time: naive UTC timestamp shifted by a UTC offset in seconds."""
    return _c(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _c(offset_seconds).cast("decimal(18,6)"))


def time_of_day(local_ts) -> Column:
    h = F.hour(_c(local_ts))
    b = TIME_OF_DAY_BOUNDS
    return (
        F.when(h.isNull(), F.lit(None).cast("string"))
        .when((h >= b["night"]) | (h < b["dawn"]), "night")
        .when(h < b["day"], "dawn")
        .when(h < b["dusk"], "day")
        .otherwise("dusk")
    )


def local_clock_label(epoch_seconds, offset_seconds) -> Column:
    """Epoch + offset -> ``h:mm AM`` without a leading zero (session zone is UTC)."""
    ts = F.timestamp_seconds(_c(epoch_seconds).cast("bigint") + _c(offset_seconds).cast("bigint"))
    return F.date_format(ts, "h:mm a")


def display_datetime(ts) -> Column:
    """``Weekday, dd Month · hh:mm AM``."""
    return F.date_format(_c(ts), "EEEE, dd MMMM · hh:mm a")


def run_stamp(ts) -> Column:
    return F.date_format(_c(ts), "yyyyMMdd_HHmmss")


# --- text --------------------------------------------------------------------------------

_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def title_case(x) -> Column:
    """Python ``str.title``: each run of cased letters starts upper, continues lower.

    ``initcap`` only looks at spaces (``Light-intensity``); here every cased letter that
    follows a non-cased character starts a word (``Light-Intensity``, ``O'Clock``, ``3Rd``).
    """
    pieces = F.split(_c(x), rf"(?<![{_CASED}])(?=[{_CASED}])")
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 30)))),
        "",
    )


def strip_whitespace(x) -> Column:
    """Python ``str.strip()`` (all whitespace, not only spaces as ``trim`` does)."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


# --- derived measures --------------------------------------------------------------------

def heat_index_raw(temp_c, humidity_pct) -> Column:
    """Unrounded heat index, evaluated left to right in the same order as the reference."""
    c = HEAT_INDEX_COEFFICIENTS
    t = _c(temp_c).cast("double")
    h = _c(humidity_pct).cast("double")
    t2 = t * t
    h2 = h * h
    return (
        F.lit(c[0])
        + F.lit(c[1]) * t
        + F.lit(c[2]) * h
        - F.lit(c[3]) * t * h
        - F.lit(c[4]) * t2
        - F.lit(c[5]) * h2
        + F.lit(c[6]) * t2 * h
        + F.lit(c[7]) * t * h2
        - F.lit(c[8]) * t2 * h2
    )


def heat_index(temp_c, humidity_pct, guarded: bool = False) -> Column:
    """Heat index rounded to one digit (half-even). ``guarded`` limits it to T>27, H>40."""
    hi = round_half_even(heat_index_raw(temp_c, humidity_pct), 1)
    if guarded:
        hi = F.when((_c(temp_c) > 27) & (_c(humidity_pct) > 40), hi)
    return hi


def comfort_level(temp_c, profile: str = "batch") -> Column:
    """Comfort band. ``batch``: NULL -> 'Unknown'; ``live``: NULL stays NULL."""
    bounds = COMFORT_PROFILES[profile]
    t = _c(temp_c)
    expr = F.when(t.isNull(), F.lit("Unknown" if profile == "batch" else None).cast("string"))
    for bound, label in zip(bounds, COMFORT_LABELS):
        expr = expr.when(t < bound, label)
    return expr.otherwise(COMFORT_LABELS[-1])


def condition_icon(condition, tod) -> Column:
    icons = F.create_map(*[F.lit(v) for kv in CONDITION_ICONS.items() for v in kv])
    clear = F.create_map(*[F.lit(v) for kv in CLEAR_ICONS.items() for v in kv])
    cond = _c(condition)
    return (
        F.when(cond == "Clear", F.coalesce(F.try_element_at(clear, _c(tod)), F.lit(CLEAR_ICONS["day"])))
        .otherwise(F.coalesce(F.try_element_at(icons, cond), F.lit(DEFAULT_ICON)))
    )


def visibility_km(visibility_m) -> Column:
    return round_half_even(_c(visibility_m).cast("double") / 1000.0, 1)


def _clamp_pct(x: Column, lower: bool) -> Column:
    """Clamp to <= 100 (and >= 0 if ``lower``); NULL stays NULL (``least`` skips NULLs)."""
    v = F.least(F.lit(100), x.cast("int"))
    v = F.greatest(F.lit(0), v) if lower else v
    return F.when(x.isNotNull(), v)


def gauge_wind_pct(wind_mps) -> Column:
    w = _c(wind_mps).cast("double")
    return F.coalesce(_clamp_pct(w / GAUGE_WIND_FULL_MPS * 100.0, lower=False), F.lit(GAUGE_DEFAULTS["wind"]))


def gauge_pressure_pct(pressure_hpa) -> Column:
    p = _c(pressure_hpa).cast("double")
    pct = (p - GAUGE_PRESSURE_BASE_HPA) / GAUGE_PRESSURE_SPAN_HPA * 100.0
    return F.coalesce(_clamp_pct(pct, lower=True), F.lit(GAUGE_DEFAULTS["pressure"]))


def gauge_visibility_pct(visibility_m) -> Column:
    km = visibility_km(visibility_m)
    return F.coalesce(_clamp_pct(km / GAUGE_VISIBILITY_FULL_KM * 100.0, lower=False), F.lit(GAUGE_DEFAULTS["visibility"]))


def gauge_humidity_pct(humidity_pct) -> Column:
    return F.coalesce(_c(humidity_pct).cast("int"), F.lit(GAUGE_DEFAULTS["humidity"]))


def gauge_clouds_pct(cloudiness_pct) -> Column:
    return F.coalesce(_c(cloudiness_pct).cast("int"), F.lit(GAUGE_DEFAULTS["clouds"]))


def percent(part, whole, digits: int = 1) -> Column:
    """``part / whole * 100`` rounded; 0 when ``whole`` is 0."""
    w = _c(whole)
    return F.when(w > 0, round_half_even(_c(part).cast("double") / w * 100.0, digits)).otherwise(F.lit(0.0))


def falsy_default(x, default) -> Column:
    """Python ``x or default``: NULL and 0 both take the default."""
    c = _c(x)
    d = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.when(c != 0, c), d)
