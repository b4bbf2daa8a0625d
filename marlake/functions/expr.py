"""Column expressions shared by all plans. Everything here stays inside Spark SQL."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000
EARTH_RADIUS_KM = 6371.0


# --- time -----------------------------------------------------------------------------------
def whole_hour_days(start, end) -> Column:
    """Whole elapsed hours (truncated) divided by 24."""
    return F.timestamp_diff("HOUR", _c(start), _c(end)) / F.lit(24.0)


def fractional_days(start, end) -> Column:
    """Elapsed time in days with microsecond resolution."""
    return (F.unix_micros(_c(end)) - F.unix_micros(_c(start))) / F.lit(float(MICROS_PER_DAY))


def sunday_week_start(day) -> Column:
    """First day (Sunday) of the week that holds ``day``."""
    return F.date_sub(_c(day), F.dayofweek(_c(day)) - 1)


def sunday_week_of_year(day) -> Column:
    """Week number with Sunday-based weeks; days before the first Sunday are week 0."""
    day = _c(day)
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def batch_window_id(ts, hours: int = 6) -> Column:
    """Identifier of the tumbling block of ``hours`` that holds ``ts``: live-<date>-HH-HH."""
    start = F.floor(F.hour(_c(ts)) / hours) * hours
    return F.concat(
        F.lit("live-"),
        F.date_format(_c(ts), "yyyy-MM-dd"),
        F.lit("-"),
        F.lpad(start.cast("string"), 2, "0"),
        F.lit("-"),
        F.lpad((start + hours).cast("string"), 2, "0"),
    )


# --- text -----------------------------------------------------------------------------------
def zip_pad(col, width: int = 5) -> Column:
    """Left-pad with zeros; longer values are kept whole."""
    col = _c(col)
    return F.when(F.length(col) < width, F.lpad(col, width, "0")).otherwise(col)


def clean_city(col) -> Column:
    return F.trim(F.lower(_c(col)))


def clean_state(col) -> Column:
    return F.upper(F.trim(_c(col)))


# --- numbers --------------------------------------------------------------------------------
def ratio(numerator, denominator) -> Column:
    """Division in doubles; null when the divisor is zero or null."""
    return F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))


def mean_of(col) -> Column:
    """Average taken as exact sum over count, so that decimals do not lose digits."""
    col = _c(col)
    return ratio(F.sum(col), F.count(col))


def floor_at(col, low) -> Column:
    """Lower clip that leaves null as null."""
    col = _c(col)
    return F.when(col < low, F.lit(low)).otherwise(col)


def shrink(mean, count, prior, weight: float) -> Column:
    """Mean pulled towards ``prior`` as if ``weight`` more rows had shown it."""
    mean, count, prior = _c(mean), _c(count), _c(prior)
    return (mean * count + prior * F.lit(float(weight))) / (count + F.lit(float(weight)))


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle distance between two points in degrees."""
    lat1, lng1, lat2, lng2 = (F.radians(_c(x)) for x in (lat1, lng1, lat2, lng2))
    half_lat = F.sin((lat2 - lat1) / 2)
    half_lng = F.sin((lng2 - lng1) / 2)
    chord = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lng * half_lng
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


# --- repeatable randomness ------------------------------------------------------------------
def hash_int(*parts) -> Column:
    """52-bit non-negative integer from the text of ``parts``; the same on every run."""
    text = F.concat_ws("|", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def hash_uniform(*parts) -> Column:
    """Uniform number in (0, 1) derived from ``parts``."""
    return (hash_int(*parts) + F.lit(0.5)) / F.lit(float(2**52))


def hash_normal(*parts) -> Column:
    """Standard normal number (Box-Muller on two hashed uniforms)."""
    u = hash_uniform(F.lit("u"), *parts)
    v = hash_uniform(F.lit("v"), *parts)
    return F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(6.283185307179586) * v)


# --- frames ---------------------------------------------------------------------------------
def decimals_to_double(df: DataFrame) -> DataFrame:
    """Cast every decimal column to double, driven by the schema."""
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in wide}) if wide else df


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)
