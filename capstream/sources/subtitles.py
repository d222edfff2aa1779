"""Subtitle files to cues: SRT, VTT, ASS, SSA, JSON and XML."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.functions.text import clean_markup, is_dialogue
from capstream.functions.timecode import parse_timecode
from capstream.session import share_package

# The formats and what their fields are called.
SUFFIXES = (".srt", ".vtt", ".ass", ".ssa", ".json", ".xml")
TIME_RANGE = r"(\d{1,2}:\d{2}(?::\d{2})?[,.]\d{1,3})\s*-->\s*(\d{1,2}:\d{2}(?::\d{2})?[,.]\d{1,3})"
START_KEYS, END_KEYS, TEXT_KEYS = ("from", "start", "start_time"), ("to", "end", "end_time"), ("content", "text", "body")
XML_NODES = ("text", "p", "d")

_BLANK = r"\n(?:(?U)[\s&&[^\n]]*\n)+"


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """path, content, suffix of all files below a path."""
    rows = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^﻿", "").alias("content"))
    return rows.withColumn("suffix", suffix(F.col("path")))


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def _cues(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, cue_idx, start, end, text of rows(keys, at, start, end, raw) that last and say something."""
    rows = rows.withColumn("text", clean_markup(F.col("raw"))).where((F.col("text") != "") & (F.col("end") > F.col("start")))
    return rows.select(*keys, F.col("at").cast("long").alias("cue_idx"), "start", "end", "text")


def _lines(c: Column) -> Column:
    return F.split(F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), "\n")


def parse_srt(files: DataFrame, keys: list[str]) -> DataFrame:
    """SRT and VTT: in every block the first line with a time range, and the lines after it."""
    text = F.array_join(_lines(F.col("content")), "\n")
    blocks = files.select(*keys, F.posexplode(F.split(text, _BLANK)).alias("at", "block"))
    blocks = blocks.where(F.col("block").rlike(TIME_RANGE)).withColumn("lines", F.split("block", "\n"))
    head = F.array_position(F.transform("lines", lambda x: x.rlike(TIME_RANGE)), True).cast("int")
    blocks = blocks.withColumn("head", head).withColumn("line", F.get("lines", F.col("head") - 1))
    rows = blocks.select(
        *keys, "at", parse_timecode(F.regexp_extract("line", TIME_RANGE, 1)).alias("start"), parse_timecode(F.regexp_extract("line", TIME_RANGE, 2)).alias("end"),
        F.array_join(F.slice("lines", F.col("head") + 1, F.greatest(F.size("lines"), F.lit(0))), "\n").alias("raw"),
    )
    return _cues(rows, keys)


def parse_ass(files: DataFrame, keys: list[str]) -> DataFrame:
    lines = files.select(*keys, F.posexplode(_lines(F.col("content"))).alias("at", "line")).where(F.col("line").startswith("Dialogue:"))
    fields = F.split("line", ",", 10)
    rows = lines.where(F.size(fields) == 10).select(
        *keys, "at", parse_timecode(F.get(fields, F.lit(1))).alias("start"), parse_timecode(F.get(fields, F.lit(2))).alias("end"), F.get(fields, F.lit(9)).alias("raw")
    )
    return _cues(rows, keys)


def parse_json(files: DataFrame, keys: list[str]) -> DataFrame:
    """A list of objects, or an object with one as `body`. The first field name that is there counts, even if it is null."""
    body = F.when(F.col("content").rlike(r'^\s*\{') & F.array_contains(F.json_object_keys("content"), "body"), F.get_json_object("content", "$.body")).otherwise(F.col("content"))
    items = files.select(*keys, F.posexplode(F.from_json(body, "array<string>")).alias("at", "item"))
    items = items.withColumn("fields", F.from_json("item", "map<string,string>")).where("fields is not null")

    def field(names: tuple[str, ...]) -> Column:
        out = F.lit(None).cast("string")
        for name in reversed(names):
            out = F.when(F.map_contains_key("fields", name), F.col("fields")[name]).otherwise(out)
        return out

    rows = items.select(*keys, "at", field(START_KEYS).try_cast("double").alias("start"), field(END_KEYS).try_cast("double").alias("end"), field(TEXT_KEYS).alias("raw"))
    return _cues(rows.where("raw is not null"), keys)


def _elements(files: DataFrame, keys: list[str]) -> DataFrame:
    """keys, at, attributes, raw of the named elements; a parser runs over Arrow batches, as Spark's XML source knows one row tag."""
    rows = files.select(*keys, "content")
    kinds = dict(rows.dtypes)

    def found_in(content: str | None) -> list[tuple[int, list, str]]:
        try:
            tree = ET.fromstring(content or "")
        except ET.ParseError:
            return []
        places = {id(e): n for n, e in enumerate(tree.iter())}
        named = {id(e): e for e in tree.iter() if isinstance(e.tag, str) and e.tag.rpartition("}")[2].lower() in XML_NODES}
        return [(places[i], list(e.attrib.items()), "".join(e.itertext())) for i, e in named.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [(i, *hit) for i, content in enumerate(batch.column("content").to_pylist()) for hit in found_in(content)]
            source, at, attributes, raw = zip(*hits, strict=True) if hits else ((), (), (), ())
            own = [batch.column(k).take(pa.array(source, pa.int64())) for k in keys]
            columns = [pa.array(at, pa.int64()), pa.array(attributes, pa.map_(pa.string(), pa.string())), pa.array(raw, pa.string())]
            yield pa.RecordBatch.from_arrays([*own, *columns], names=[*keys, "at", "attributes", "raw"])

    share_package(files.sparkSession)
    return rows.mapInArrow(run, ", ".join([*[f"{k} {kinds[k]}" for k in keys], "at long, attributes map<string,string>, raw string"]))


def parse_xml(files: DataFrame, keys: list[str]) -> DataFrame:
    """Elements named text, p or d with a start, and an end or a length; an empty attribute counts as missing where another may stand in."""
    value = lambda name: F.col("attributes")[name]
    either = lambda one, other: F.coalesce(F.nullif(value(one), F.lit("")), value(other))
    start = F.coalesce(either("start", "from"), F.get(F.split(value("p"), ","), F.lit(0))).try_cast("double")
    given, lasts = either("end", "to"), F.coalesce(F.nullif(either("dur", "duration"), F.lit("")), F.lit("0"))
    rows = _elements(files, keys).withColumn("start", start)
    end = F.when(given.isNotNull(), given.try_cast("double")).otherwise(F.col("start") + lasts.try_cast("double"))
    return _cues(rows.withColumn("end", end), keys)


PARSERS = {".ass": parse_ass, ".ssa": parse_ass, ".json": parse_json, ".xml": parse_xml}


def parse_files(files: DataFrame, keys: tuple[str, ...] = ("path",)) -> DataFrame:
    """Cues of files(keys, content, suffix) of all formats; what no other parser claims is read as SRT."""
    names = list(keys)
    out = parse_srt(files.where(~F.col("suffix").isin(*PARSERS)), names)
    for parser, kinds in ((parse_ass, (".ass", ".ssa")), (parse_json, (".json",)), (parse_xml, (".xml",))):
        out = out.unionByName(parser(files.where(F.col("suffix").isin(*kinds)), names))
    return out


def dialogue(cues: DataFrame) -> DataFrame:
    return cues.where(is_dialogue(F.col("text")))
