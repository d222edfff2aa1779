"""A whole run as one plan: inputs to segments, by subtitle track where there is one, else by recognition."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstream.functions.ids import parse_inputs, resolve
from capstream.operators import captions, manifest, tracks


@dataclasses.dataclass
class Run:
    """What a run makes: items (one row per input), segments and new manifest rows."""

    items: DataFrame
    segments: DataFrame
    manifests: DataFrame


def resolved(raw: DataFrame, settings: manifest.Settings, column: str = "raw") -> DataFrame:
    """Distinct inputs with url, video_id, output_key, error and fingerprint."""
    rows = parse_inputs(raw, column).select(resolve(F.col("value")).alias("r"), "position").select("r.*", "position")
    return rows.withColumn("fingerprint", manifest.fingerprint(settings, F.col("output_key")))


def run(raw: DataFrame, cues: DataFrame, samples: DataFrame, manifests: DataFrame, settings: manifest.Settings) -> Run:
    """Inputs that no valid manifest covers are taken; those without a usable track go on to recognition.

    cues(output_key, name, start, end, text), samples(output_key, time, text, confidence, quality). The
    two branches are joined by key and unioned, so nothing is recognised for a video that has a track.
    """
    inputs = resolved(raw, settings)
    good = inputs.where("error is null").dropDuplicates(["output_key"])
    todo = manifest.pending(good, manifests, settings.force).select("output_key", "fingerprint")
    track = tracks.select(cues.join(todo, "output_key", "left_semi"), "output_key") if settings.prefer_subtitle_track else cues.where("false")
    direct = captions.cues_to_segments(track.select("output_key", "start", "end", "text"))
    found = direct.withColumn("source_type", F.lit("subtitle_track"))
    if settings.enable_hardsub_ocr:
        rest = samples.join(todo, "output_key", "left_semi").join(track.select("output_key").distinct(), "output_key", "left_anti")
        read = captions.assemble(rest, "output_key", settings.sample_interval_seconds).drop("segment_id")
        if settings.end_time is not None:
            read = captions.clamp(read, F.lit(settings.end_time))
        found = found.unionByName(read.withColumn("source_type", F.lit("hard_subtitle_ocr")))
    counts = found.groupBy("output_key").agg(F.count("*").alias("segment_count"), F.first("source_type").alias("source_type"))
    fresh = F.col("_todo").isNotNull()
    items = inputs.join(todo.select("output_key", F.lit(True).alias("_todo")), "output_key", "left").join(counts, "output_key", "left")
    items = items.withColumns(
        {
            "success": F.col("error").isNull() & (~fresh | (F.coalesce("segment_count", F.lit(0)) > 0)), "skipped": F.col("error").isNull() & ~fresh,
            "failure_reason": F.coalesce("error", F.when(fresh & F.col("segment_count").isNull(), "no segments")),
        }
    ).drop("_todo")
    done = items.where("not skipped and error is null")
    return Run(items, found, manifest.manifest_rows(done, settings, F.when(F.col("success"), "success").otherwise("failed")))
