"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the message format and the map, kept equal to the reference:
# key fields are joined with ':'; the topic is 'currentTemp'; the heat scale is
# clipped to [-10, 10] degrees.
KEY_SEP = ":"
TOPIC = "currentTemp"
HEAT_LO = -10.0
HEAT_HI = 10.0

# A reading key is "<name>:<lon>:<lat>:<hour>"; the name may itself hold ':'.
# Anchoring at the end takes the last three fields, whatever the name holds.
KEY_PATTERN = r"^(.*):([^:]*):([^:]*):([^:]*)$"
# A station key (city_and_loc) is "<name>:<lon>:<lat>".
CITY_PATTERN = r"^(.*):([^:]*):([^:]*)$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode_key(name, lon, lat, hour) -> Column:
    """Name, lon, lat, hour joined with ':' (numbers in their shortest text).

    Null when a part is null: a shorter key would read as another one.
    """
    sep = F.lit(KEY_SEP)
    return F.concat(col(name), sep, col(lon).cast("string"), sep, col(lat).cast("string"), sep,
                    col(hour).cast("string"))


def as_text(c) -> Column:
    """Bytes (Kafka key/value) or text to text; binary is decoded as UTF-8."""
    return col(c).cast("string")


def hour_of_day(epoch_seconds) -> Column:
    """Epoch seconds to the hour 0-23 in the session time zone."""
    return F.hour(F.timestamp_seconds(col(epoch_seconds))).cast("int")


def day_index(ts, leap: str = "error") -> Column:
    """P10: day of year minus one (0..364).

    ``leap='error'`` fails on 31 December of a leap year (index 365) as the
    reference's assertion does; ``leap='clamp'`` maps it to 364.
    """
    d = (F.dayofyear(col(ts)) - 1).cast("int")
    if leap == "clamp":
        return F.least(d, F.lit(364))
    if leap == "error":
        return F.when(d <= 364, d).otherwise(
            F.raise_error(F.concat(F.lit("day index out of range 0..364: "), d.cast("string")))).cast("int")
    raise ValueError(f"leap must be 'error' or 'clamp', not {leap!r}")


def grid_x(lat, scale: float) -> Column:
    """Grid row coordinate of a latitude (row 0 is the north edge)."""
    return F.lit(float(scale)) * (F.lit(90.0) - col(lat))


def grid_y(lon, scale: float) -> Column:
    """Grid column coordinate of a longitude (column 0 is -180)."""
    return F.lit(float(scale)) * (col(lon) + F.lit(180.0))


def trunc_int(c) -> Column:
    """Integer part, truncating toward zero (-0.7 -> 0)."""
    return col(c).cast("int")


def heat_clip(diff, lo: float = HEAT_LO, hi: float = HEAT_HI) -> Column:
    """Clipped to [lo, hi]; null and NaN (no value) give null. ``greatest`` alone
    would skip a null and rank NaN above every number."""
    d = col(diff)
    return F.when(d.isNotNull() & ~F.isnan(d), F.least(F.greatest(d, F.lit(lo)), F.lit(hi)))


def heat_level(diff, lo: float = HEAT_LO, hi: float = HEAT_HI) -> Column:
    """0..255 position on the clipped colour scale (null and NaN give null)."""
    clipped = heat_clip(diff, lo, hi)
    scaled = F.floor((clipped - F.lit(lo)) / F.lit(hi - lo) * F.lit(256.0))
    return F.when(clipped.isNotNull(), F.least(F.lit(255), scaled.cast("int")))
