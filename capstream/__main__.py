"""The batch run from a command line: inputs, subtitle files and samples in; segments, documents and manifests out."""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capstream.operators import manifest, sinks
from capstream.plans import batch
from capstream.session import share_package
from capstream.sources import subtitles

CUES = "output_key string, name string, start double, end double, text string"
SAMPLES = "output_key string, time double, text string, confidence double, quality double"
MANIFESTS = "output_key string, fingerprint string, status string, updated_at timestamp"


def arguments(words: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="capstream", description=__doc__)
    parser.add_argument("inputs", nargs="+", help="addresses or ids of videos, or @FILE with a list of them")
    parser.add_argument("--output", required=True, help="folder for segments, documents and manifests")
    parser.add_argument("--subtitles", help="folder with a folder of subtitle files for each video, named by its key")
    parser.add_argument("--samples", help=f"Parquet table of recognised captions: {SAMPLES}")
    parser.add_argument("--interval", type=float, default=manifest.LEAST_INTERVAL, help="seconds between samples")
    parser.add_argument("--start", type=float)
    parser.add_argument("--end", type=float)
    parser.add_argument("--force", action="store_true", help="do again what has been done")
    return parser.parse_args(words)


def _read(spark: SparkSession, path: str | None, kind: str) -> DataFrame:
    """A Parquet table, or an empty one where there is none yet."""
    try:
        return spark.read.parquet(path).select(*[c.split()[0] for c in kind.split(", ")]) if path else spark.createDataFrame([], kind)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], kind)


def cues_below(spark: SparkSession, path: str | None) -> DataFrame:
    if not path:
        return spark.createDataFrame([], CUES)
    files = subtitles.read_files(spark, path).where(F.col("suffix").isin(*subtitles.SUFFIXES))
    parts = F.split("path", "/")
    files = files.withColumns({"output_key": F.element_at(parts, -2), "name": F.element_at(parts, -1)})
    return subtitles.parse_files(files, ("output_key", "name")).select("output_key", "name", "start", "end", "text")


def main(spark: SparkSession, words: list[str] | None = None) -> int:
    """Runs, writes, prints a line for each input and the sums; 0 if any input succeeded."""
    given = arguments(words)
    lists = [spark.read.text(w[1:], wholetext=True).select(F.col("value").alias("raw")) for w in given.inputs if w.startswith("@")]
    raw = spark.createDataFrame([("\n".join(w for w in given.inputs if not w.startswith("@")),)], "raw string")
    for some in lists:
        raw = raw.unionByName(some)
    settings = manifest.Settings(sample_interval_seconds=given.interval, start_time=given.start, end_time=given.end, force=given.force)
    known = _read(spark, f"{given.output}/manifests", MANIFESTS)
    run = batch.run(raw, cues_below(spark, given.subtitles), _read(spark, given.samples, SAMPLES), manifest.latest(known), settings)
    found, listed = run.segments.persist(), run.items.persist()  # what follows reads them again and again
    number = F.row_number().over(Window.partitionBy("output_key").orderBy("start", "end"))
    segments = found.withColumn("segment_id", number.cast("long"))
    sinks.write_json_lines(sinks.json_lines(segments), given.output)
    sinks.write_documents(sinks.srt(segments), given.output, "subtitle.srt")
    sinks.write_documents(sinks.markdown(segments), given.output, "transcript.md")
    items, sums = listed.collect(), sinks.summary(listed).first()  # a row for each input that was typed or listed
    run.manifests.write.mode("append").parquet(f"{given.output}/manifests")
    listed.unpersist()
    found.unpersist()
    for item in items:
        print(f"{item.raw_input}: {'cached' if item.skipped else f'{item.segment_count} segments' if item.success else item.failure_reason}")
    print(f"{sums.processed} processed, {sums.successful} successful, {sums.cached} cached, {sums.failed} failed")
    return 0 if sums.ok else 1


if __name__ == "__main__":
    sys.exit(main(share_package(SparkSession.builder.appName("capstream").getOrCreate())))
