"""Time codes to seconds and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from capstream.functions.text import trimmed


def parse_timecode(c: Column) -> Column:
    """MM:SS or HH:MM:SS, comma or point, to seconds; anything else is null."""
    parts = F.split(F.replace(trimmed(c), F.lit(","), F.lit(".")), ":")
    whole = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("int")
    seconds = F.try_element_at(parts, F.lit(-1)).try_cast("double")
    return F.when(F.size(parts) == 2, whole(1) * 60 + seconds).when(F.size(parts) == 3, whole(1) * 3600 + whole(2) * 60 + seconds)


def parse_time_value(c: Column) -> Column:
    """Seconds, MM:SS or HH:MM:SS as typed on a command line; null where out of range or malformed."""
    parts = F.transform(F.split(trimmed(c), ":"), lambda x: x.try_cast("double"))
    part = lambda i: F.try_element_at(parts, F.lit(i))
    value = (
        F.when(F.size(parts) == 1, part(1))
        .when((F.size(parts) == 2) & (part(2) < 60), part(1) * 60 + part(2))
        .when((F.size(parts) == 3) & (part(2) < 60) & (part(3) < 60), part(1) * 3600 + part(2) * 60 + part(3))
    )
    return F.when(value >= 0, value)


def srt_timestamp(seconds: Column) -> Column:
    """HH:MM:SS,mmm, to the nearest millisecond (ties to even), never negative."""
    ms = F.greatest(F.lit(0).cast("long"), F.rint(seconds * 1000).cast("long"))
    unit = lambda size, of: F.floor(ms / size) % of if of else F.floor(ms / size)
    return F.format_string("%02d:%02d:%02d,%03d", unit(3_600_000, 0), unit(60_000, 60), unit(1000, 60), ms % 1000)


def display_timestamp(seconds: Column) -> Column:
    return F.replace(srt_timestamp(seconds), F.lit(","), F.lit("."))


def seconds_or_null(c: Column) -> Column:
    return F.nullif(trimmed(c), F.lit("")).try_cast("double")


def fixed(c: Column, places: int) -> Column:
    """A number with so many places, rounded by its exact binary value, exact halves to even.

    c times the power of ten is the sum of a double and its exact error (the upper and lower half of c are
    multiplied on their own, without loss), and the error decides what would look like a half.
    """
    x, scale = F.abs(c), float(10**places)
    wide = x * 134217729.0
    upper = wide - (wide - x)
    a, b = upper * scale, (x - upper) * scale
    near = a + b
    error = (a - (near - (near - a))) + (b - (near - a))
    whole = F.floor(near)
    rest = near - whole
    up = F.when(rest != 0.5, (rest > 0.5).cast("long")).when(error != 0, (error > 0).cast("long")).otherwise(whole % 2)
    units = whole + up
    digits = F.concat(F.floor(units / 10**places).cast("string"), F.lit("."), F.lpad((units % 10**places).cast("string"), places, "0")) if places else units.cast("string")
    return F.concat(F.when((c < 0) & (units > 0), "-").otherwise(""), digits)


def shown_number(c: Column) -> Column:
    """Up to six significant digits without trailing zeros; powers of ten below 1e-4 and from 1e6 on."""
    power = F.regexp_extract(F.format_string("%.5e", c), r"e(.+)$", 1).try_cast("int")
    plain = lambda text: F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+(?=$|e)", "$1"), r"\.(?=$|e)", "")
    digits = F.coalesce(*[F.when(power == k, fixed(c, 5 - k)) for k in range(-4, 6)])
    return F.when(c == 0, "0").when((power < -4) | (power >= 6), plain(F.format_string("%.5e", c))).otherwise(F.when(F.contains(digits, F.lit(".")), plain(digits)).otherwise(digits))
