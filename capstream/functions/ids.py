"""Video identifiers: recognising inputs, canonical addresses, output keys, parsing lists of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capstream.functions.text import LINE_BREAK, trimmed

# Identifiers and addresses of the video platform.
SUPPORTED = (r"(?i)^https?://\S+$", r"^BV[0-9A-Za-z]{10}$", r"^(?:av|AV)\d+$")
BV = r"\b(BV[0-9A-Za-z]{10})\b"
AV = r"\b(?:av|AV)(\d+)\b"
ANY_ID = r"(?i)(BV[0-9A-Za-z]{10}|av\d+)"
HOSTS = r"(?i)^https?://(?:www\.)?(?:b23\.tv|bilibili\.com)/"
VIDEO_URL = "https://www.bilibili.com/video/{}/"
NUMBER_PREFIX = r"^\s*(?:(?:\d+)\s*[.．、)）:]|[（(]\s*\d+\s*[）)])\s*"
SEPARATOR = r"(?U)[\s,，]+"


def _trimmed(c: Column) -> Column:
    return trimmed(F.coalesce(c, F.lit("")))


def is_supported(c: Column) -> Column:
    v = _trimmed(c)
    return v.rlike(SUPPORTED[0]) | v.rlike(SUPPORTED[1]) | v.rlike(SUPPORTED[2])


def _url(video_id: Column) -> Column:
    before, after = VIDEO_URL.split("{}")
    return F.concat(F.lit(before), video_id, F.lit(after))


def normalize_input(c: Column, strict: bool = False) -> Column:
    """The address of an id; an address stays; anything else is null, or an error if strict."""
    v = _trimmed(c)
    other = F.raise_error(F.concat(F.lit("unrecognized input: "), v)).cast("string") if strict else F.lit(None).cast("string")
    return F.when(v.rlike(SUPPORTED[1]) | v.rlike(SUPPORTED[2]), _url(v)).when(v.rlike(SUPPORTED[0]), v).otherwise(other)


def extract_video_id(c: Column) -> Column:
    """The first id of either kind, as written; null if there is none."""
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), ANY_ID, 1), F.lit(""))


def resolve(c: Column) -> Column:
    """struct(raw_input, url, video_id, output_key, error) of an input."""
    v = _trimmed(c)
    av = F.regexp_extract(v, AV, 1)
    video_id = F.when(v.rlike(BV), F.regexp_extract(v, BV, 1)).when(av != "", F.concat(F.lit("av"), av))
    hosted = v.rlike(HOSTS)
    known = is_supported(v)
    error = F.when(~known, "input must be a video URL, BV ID, or AV ID").when(video_id.isNull() & ~hosted, "URL must use a supported host")
    url = F.when(error.isNull(), F.coalesce(_url(video_id), v))
    key = F.when(error.isNull(), F.coalesce(video_id, F.concat(F.lit("url-"), F.substring(F.sha2(v, 256), 1, 12))))
    return F.struct(v.alias("raw_input"), url.alias("url"), F.when(error.isNull(), video_id).alias("video_id"), key.alias("output_key"), error.alias("error"))


def parse_inputs(rows: DataFrame, text: str = "raw", by: tuple[str, ...] = ()) -> DataFrame:
    """`by`, position, value: the distinct inputs of every free text, in order of first occurrence.

    Lines and the tokens in them lose list numbers; tokens that are only numbers are dropped.
    """
    clean = lambda x: _trimmed(F.regexp_replace(_trimmed(x), NUMBER_PREFIX, ""))
    keys = list(by)
    lines = rows.select(*keys, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), LINE_BREAK)).alias("line", "part"))
    tokens = lines.select(*keys, "line", F.posexplode(F.split(clean(F.col("part")), SEPARATOR)).alias("at", "token"))
    tokens = tokens.withColumn("value", clean(F.col("token"))).where((F.col("value") != "") & ~F.col("value").rlike(r"^\d+[.．、)）:]?$"))
    return tokens.groupBy(*keys, "value").agg(F.min(F.struct("line", "at")).alias("position")).select(*keys, "position", "value")
