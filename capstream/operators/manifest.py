"""Settings, their fingerprints, and which videos need no work any more."""

from __future__ import annotations

import dataclasses
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capstream.operators.geometry import CROP

# Versions that fingerprints and manifests carry.
SCHEMA_VERSION, PIPELINE_VERSION, LEAST_INTERVAL = 3, "3.0.0", 3.0
REQUIRED_OUTPUTS = ("segments", "subtitle", "transcript", "ocr_status", "source_card")


@dataclasses.dataclass(frozen=True)
class Settings:
    """What a run is done with; `force` and `keep_frames` don't change results, so fingerprints leave them out.

    Names and defaults are fixed values: they are part of every fingerprint.
    """

    sample_interval_seconds: float = LEAST_INTERVAL
    start_time: float | None = None
    end_time: float | None = None
    crop: tuple[float, float, float, float] = CROP
    prefer_subtitle_track: bool = True
    enable_hardsub_ocr: bool = True
    keep_frames: str = "changed"
    max_frame_width: int = 1280
    frame_similarity_threshold: float = 0.018
    adaptive_ocr_confidence: float = 0.78
    force: bool = False

    def __post_init__(self):
        top, bottom, left, right = self.crop
        wrong = {
            f"frames can't be sampled more often than every {LEAST_INTERVAL:g} s": self.sample_interval_seconds < LEAST_INTERVAL,
            "a time before the video's beginning": min(self.start_time or 0, self.end_time or 0) < 0,
            "nothing lies between start_time and end_time": None not in (self.start_time, self.end_time) and self.end_time <= self.start_time,
            "crop is no part of the picture": not (0 <= left < right <= 1 and 0 <= top < bottom <= 1),
            "frames narrower than 640 pixels can't be read": self.max_frame_width < 640,
            "a threshold is not a share of one": not (0 <= self.frame_similarity_threshold <= 1 and 0 <= self.adaptive_ocr_confidence <= 1),
            "keep_frames is one of none, changed, all": self.keep_frames not in ("none", "changed", "all"),
        }
        for message, is_wrong in wrong.items():
            if is_wrong:
                raise ValueError(message)

    def canonical(self) -> dict:
        values = dataclasses.asdict(self)
        values["crop"] = dict(zip(("top", "bottom", "left", "right"), self.crop, strict=True))
        return {k: v for k, v in values.items() if k not in ("force", "keep_frames")}


def fingerprint(settings: Settings, source_key: Column) -> Column:
    """SHA-256 of the canonical JSON (sorted, compact, ASCII) of versions, settings and the source's key.

    The driver writes the JSON once, with a place for the key; keys are ids or hashes, which need no escapes.
    """
    payload = {"pipeline_version": PIPELINE_VERSION, "schema_version": SCHEMA_VERSION, "source_key": "\0", "config": settings.canonical()}
    before, after = json.dumps(payload, ensure_ascii=True, sort_keys=True, separators=(",", ":")).split("\\u0000")
    return F.sha2(F.concat(F.lit(before), source_key, F.lit(after)), 256)


def short_fingerprint(video_id: Column, interval: Column, start: Column, end: Column) -> Column:
    """The older form: 16 digits over the parts joined with bars; null prints as None."""
    shown = [F.coalesce(c.cast("string"), F.lit("None")) for c in (video_id, interval, start, end)]
    return F.substring(F.sha2(F.concat_ws("|", *shown, F.lit(str(SCHEMA_VERSION))), 256), 1, 16)


def valid(manifests: DataFrame) -> DataFrame:
    """output_key, fingerprint of successful runs; with an `outputs` map, only if all required files are not empty."""
    rows = manifests.where("status = 'success'")
    if "outputs" in manifests.columns:
        for name in REQUIRED_OUTPUTS:
            rows = rows.where(F.coalesce(F.col("outputs")[name], F.lit(0)) > 0)
    return rows.select("output_key", "fingerprint").distinct()


def pending(inputs: DataFrame, manifests: DataFrame, force: bool = False) -> DataFrame:
    """Inputs (output_key, fingerprint, ...) that no valid run covers."""
    return inputs if force else inputs.join(valid(manifests), ["output_key", "fingerprint"], "left_anti")


def done(inputs: DataFrame, manifests: DataFrame, force: bool = False) -> DataFrame:
    """Inputs that a successful run with the same fingerprint covers, whatever its files."""
    return inputs.where("false") if force else inputs.join(manifests.where("status = 'success'").select("output_key", "fingerprint").distinct(), ["output_key", "fingerprint"], "left_semi")


def latest(manifests: DataFrame, by: str = "updated_at") -> DataFrame:
    """The newest row of every video: how running becomes success or failed in an append-only table."""
    place = F.row_number().over(Window.partitionBy("output_key").orderBy(F.col(by).desc()))
    return manifests.withColumn("_n", place).where("_n = 1").drop("_n")


#: What is read of a manifest file; whatever else it holds is left alone.
FIELDS = "schema_version int, pipeline_version string, status string, fingerprint string, input string, resolved_url string, video_id string, output_key string, updated_at timestamp"


def read(spark: SparkSession, path: str, name: str = "manifest.json") -> DataFrame:
    """path and FIELDS of the manifest files at any depth; a file that holds no JSON object has no row."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=name)
    rows = files.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", FIELDS + ", _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("m"), "value")
    return rows.where(F.col("m").isNotNull() & F.col("m._bad").isNull() & F.col("value").rlike(r"^\s*\{")).select("path", *[f"m.{f.split()[0]}" for f in FIELDS.split(", ")])


def started(inputs: DataFrame, settings: Settings) -> DataFrame:
    """Rows that say what is being worked on; a run that dies leaves them, and latest() then shows no success."""
    return manifest_rows(inputs, settings, F.lit("running"))


def manifest_rows(items: DataFrame, settings: Settings, status: Column) -> DataFrame:
    """Rows of the manifests table for items(raw_input, url, video_id, output_key, fingerprint, ...)."""
    return items.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(PIPELINE_VERSION).alias("pipeline_version"), status.alias("status"), "fingerprint",
        F.col("raw_input").alias("input"), F.col("url").alias("resolved_url"), "video_id", "output_key",
        F.lit(json.dumps(settings.canonical(), sort_keys=True)).alias("config"), F.date_trunc("SECOND", F.current_timestamp()).alias("updated_at"),
    )
