"""Segments to documents: JSON lines, subtitles, transcripts, cards; one row or file for each video."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capstream.functions.text import trimmed
from capstream.functions.timecode import display_timestamp, fixed, srt_timestamp

SOURCES = ("subtitle_track", "hard_subtitle_ocr")


def coerced(rows: DataFrame) -> DataFrame:
    """Loosely typed segment rows with defaults for what is missing or malformed."""
    have = set(rows.columns)
    col = lambda c, kind, default: F.coalesce(F.col(c).try_cast(kind) if c in have else F.lit(None).cast(kind), default)
    start = col("start", "double", F.lit(0.0))
    source = col("source", "string", F.lit(SOURCES[1]))
    return rows.withColumns(
        {
            "start": start, "end": col("end", "double", start), "text": col("text", "string", F.lit("")), "confidence": col("confidence", "double", F.lit(1.0)),
            "sample_times": col("sample_times", "array<double>", F.array(start)), "reconstruction": col("reconstruction", "string", F.lit("direct_ocr")),
            "source": F.when(source.isin(*SOURCES), source).otherwise(SOURCES[1]), "alternatives": col("alternatives", "array<string>", F.array().cast("array<string>")),
        }
    )


def json_lines(segments: DataFrame, key: str = "output_key", number: str = "segment_id") -> DataFrame:
    """key, number, line: compact JSON with times to the millisecond and confidence to six places."""
    round_ = lambda c, d: F.bround(c, d).alias(c)
    fields = [F.col(number).alias("segment_id"), round_("start", 3), round_("end", 3), F.col("text"), round_("confidence", 6)]
    fields += [F.transform("sample_times", lambda t: F.bround(t, 3)).alias("sample_times"), "reconstruction", "source", "alternatives"]
    return segments.select(key, number, F.to_json(F.struct(*fields)).alias("line"))


def _document(segments: DataFrame, key: str, number: str, head: str, each: Column, separator: str) -> DataFrame:
    """key, document: `each` of a video's segments, in order."""
    rows = segments.select(key, F.col(number).alias("_n"), each.alias("_part"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("_n", "_part"))), lambda x: x["_part"])
    joined = rows.groupBy(key).agg(F.array_join(parts, separator).alias("_body"))
    return joined.select(key, F.concat(F.regexp_replace(F.concat(F.lit(head), F.col("_body")), r"(?U)[\s\x1C-\x1F]+$", ""), F.lit("\n")).alias("document"))


def srt(segments: DataFrame, key: str = "output_key", number: str = "segment_id") -> DataFrame:
    span = F.concat(srt_timestamp(F.col("start")), F.lit(" --> "), srt_timestamp(F.col("end")))
    each = F.concat_ws("\n", F.col(number).cast("string"), span, F.col("text"), F.lit(""))
    return _document(segments, key, number, "", each, "\n")


def markdown(segments: DataFrame, key: str = "output_key", number: str = "segment_id") -> DataFrame:
    span = F.concat(F.lit("["), display_timestamp(F.col("start")), F.lit(" --> "), display_timestamp(F.col("end")), F.lit("]"))
    note = F.format_string("<!-- source=%s; confidence=%s; reconstruction=%s -->", F.col("source"), fixed(F.col("confidence"), 3), F.col("reconstruction"))
    return _document(segments, key, number, "# Transcript\n\n", F.concat_ws("\n", span, F.col("text"), note, F.lit("")), "\n")


def plain_transcript(segments: DataFrame, source: str, key: str = "output_key", number: str = "segment_id") -> DataFrame:
    """The alternate, one line a segment, transcript."""
    each = F.format_string("- %ss-%ss %s", fixed(F.col("start"), 1), fixed(F.col("end"), 1), F.col("text"))
    rows = _document(segments, key, number, "", each, "\n")
    return rows.withColumn("document", F.concat(F.lit("# "), F.col(key).cast("string"), F.lit(f"\nSource: {source}\n\n"), F.col("document")))


def source_card(videos: DataFrame, interval: float, start: float | None = None, end: float | None = None) -> DataFrame:
    """output_key, document from videos(raw_input, url, video_id, output_key, title, source_type)."""
    until = f"{end:g} seconds" if end is not None else "video end"
    lines = [
        F.lit("# Source Card\n"), F.concat(F.lit("- Input: "), "raw_input"), F.concat(F.lit("- Resolved URL: "), "url"),
        F.concat(F.lit("- Video ID: "), F.coalesce("video_id", F.lit("unresolved"))), F.concat(F.lit("- Title: "), F.coalesce("title", F.lit("unknown"))),
        F.concat(F.lit("- Source type: "), "source_type"), F.lit(f"- Sample interval: {interval:g} seconds"),
        F.lit(f"- Processed range: {start or 0:g} to {until}"), F.lit("\nThis file holds source metadata only.\n"),
    ]
    return videos.select("output_key", F.concat_ws("\n", *lines).alias("document"))


def write_documents(documents: DataFrame, path: str, name: str, key: str = "output_key") -> None:
    """One text file for each video below path/name, in place of its older one; Spark's commit makes each write whole or not at all."""
    rows = documents.select(key, F.regexp_replace("document", r"\n\z", "").alias("document"))  # the writer ends the last line
    rows.repartition(key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).text(f"{path}/{name}")


def write_json_lines(lines: DataFrame, path: str, name: str = "segments.jsonl", key: str = "output_key") -> None:
    ordered = lines.repartition(key).sortWithinPartitions(key, "segment_id").select(key, "line")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).text(f"{path}/{name}")


def frame_index(samples: DataFrame) -> DataFrame:
    """Samples as they are listed: times to the millisecond, confidence and quality to six places."""
    return samples.withColumns({"time": F.bround("time", 3), "confidence": F.bround("confidence", 6), "quality": F.bround("quality", 6)})


def summary(items: DataFrame) -> DataFrame:
    """One row: processed, successful, cached, failed, and whether the run counts as a success."""
    good, cached = F.coalesce(F.col("success"), F.lit(False)), F.coalesce(F.col("skipped"), F.lit(False))
    return items.agg(F.count("*").alias("processed"), F.count_if(good).alias("successful"), F.count_if(good & cached).alias("cached"), F.count_if(~good).alias("failed")).withColumn("ok", F.col("successful") > 0)


def recognition_stats(samples: DataFrame, key: str = "output_key") -> DataFrame:
    """Per video: frames, calls, reuse, and mean confidence of what has text."""
    said = F.when(trimmed(F.col("text")) != "", F.col("confidence"))
    return samples.groupBy(key).agg(
        F.count("*").alias("frame_count"), F.sum("ocr_calls").alias("ocr_call_count"), F.count_if("reused").alias("reused"),
        F.count(said).alias("with_text"), F.coalesce(F.avg(said), F.lit(0.0)).alias("average_confidence"),
    )


def status_documents(stats: DataFrame, key: str = "output_key") -> DataFrame:
    """key, document: every other column of a video's one row (of recognition_stats, assembly_stats) as a JSON object."""
    return stats.select(key, F.to_json(F.struct(*[c for c in stats.columns if c != key]), {"ignoreNullFields": "false"}).alias("document"))
