"""From observed captions to sentences: grouping, choosing, joining, clipping.

Samples are rows (key columns, time, text, confidence, quality); within a key they are ordered by
time. All windows share partitioning and order, so one exchange by key serves them all; different keys
run in parallel, one key is serial by nature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstream.functions import scoring, similarity
from capstream.functions.text import OVERLAP_WINDOW, comparison_key, ends_sentence, first_occurrences, head, is_readable, join_lines, meaningful_length, once, overlap_of, spaced, tail, trimmed

INTERVAL = 3.0
CREDIBLE_CONFIDENCE, CREDIBLE_QUALITY = 0.55, 0.16


def samples_from_lines(frames: DataFrame, key: str = "output_key") -> DataFrame:
    """key, time, text, confidence, quality from frames(key, time, lines): lines of role speaker_hint don't count."""
    spoken = F.filter("lines", lambda x: ~F.coalesce(x["role"] == "speaker_hint", F.lit(False)))
    rows = frames.select(key, "time", spoken.alias("lines"))
    rows = rows.select(key, "time", "lines", join_lines(F.transform("lines", lambda x: x["text"])).alias("text"), scoring.weighted_confidence(F.col("lines")).alias("confidence"))
    return rows.select(key, "time", "text", "confidence", scoring.quality(F.col("text"), F.col("confidence"), F.size("lines")).alias("quality"))


def islands(samples: DataFrame, key: str = "output_key", fuzzy: bool = True) -> DataFrame:
    """Readable samples with the number of their group: a group ends at an unreadable sample or another caption.

    Only the sample just before matters, so `lag` finds the borders and their running sum the groups.
    """
    order = Window.partitionBy(key).orderBy("time")
    rows = samples.withColumn("_key", F.when(is_readable(F.col("text")), comparison_key(F.col("text"))))
    rows = rows.withColumn("_before", F.lag("_key").over(order))
    decide = similarity.same_caption if fuzzy else similarity.same_key
    rows = rows.where(F.col("_key").isNotNull())
    rows = rows.withColumn("_new", F.when(F.coalesce(decide(F.col("_before"), F.col("_key")), F.lit(False)), 0).otherwise(1))
    return rows.withColumn("island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_before", "_new")


def segments(grouped: DataFrame, key: str = "output_key", interval: float = INTERVAL, support: bool = True) -> DataFrame:
    """One row for each island: start, end, text, confidence, sample_times, reconstruction, source, alternatives.

    The text is that of the best sample: of the credible ones the longest, best supported, best; else by rank;
    the earliest of equals. An island is gathered once, in the partitioning that found it. Only where equally
    long candidates differ is their support asked for, once for all of them.

    What looks at all samples is bound by `once`, so that the work grows with the samples of an island; segments
    come out of a generator, through which no later filter repeats their expressions, nor the ratios in Python.
    """
    rank = scoring.sample_rank(F.col("text"), F.col("confidence"), F.col("quality"))
    sample = F.struct("time", "text", "confidence", "quality", F.col("_key").alias("key"), meaningful_length(F.col("text")).alias("length"), rank["support"].alias("rank"))
    rows = grouped.groupBy(key, "island").agg(F.avg("confidence").alias("confidence"), F.sort_array(F.collect_list(sample)).alias("_all"))
    if support:
        found = once(_open(F.col("_all")), lambda x: F.struct(x.alias("open"), F.array_distinct(F.transform(x, lambda y: y["key"])).alias("keys")))
        rows = rows.select(key, "island", "confidence", "_all", F.explode(F.array(F.when(F.size("_all") > 1, found))).alias("_o"))
        asked = F.size("_o.keys") > 1
        members = F.when(asked, F.transform("_all", lambda x: x["key"]))
        rows = rows.withColumn("_support", similarity.mean_ratios(F.when(asked, F.col("_o.keys")), members))
    open_ = F.col("_o.open") if support else _open(F.col("_all"))

    def backing(x: Column) -> Column:
        return F.coalesce(F.try_element_at("_support", F.array_position("_o.keys", x["key"]).cast("int")), F.lit(0.0)) if support else F.lit(0.0)

    def chosen(candidates: Column) -> Column:
        by_support = F.array_max(F.transform(candidates, lambda x: F.struct(backing(x).alias("a"), x["quality"].alias("b"), (-x["time"]).alias("c"), x["text"].alias("text"))))
        by_rank = F.array_max(F.transform("_all", lambda x: F.struct(x["rank"].alias("a"), x["length"].alias("b"), x["confidence"].alias("c"), (-x["time"]).alias("d"), x["text"].alias("text"))))
        return F.when(F.size(candidates) > 0, by_support["text"]).otherwise(by_rank["text"])

    def said(text: Column, alternatives: Column) -> Column:
        return F.struct(trimmed(text).alias("text"), alternatives.alias("alternatives"))

    several = once(once(open_, chosen), lambda x: said(x, F.array_except(first_occurrences(F.transform("_all", lambda y: y["text"])), F.array(x))))
    single = said(F.col("_all")[0]["text"], F.array().cast("array<string>"))
    rows = rows.select(key, "island", "confidence", "_all", F.explode(F.array(F.when(F.size("_all") > 1, several).otherwise(single))).alias("_said"))
    return rows.select(
        key, "island", F.col("_all")[0]["time"].alias("start"), (F.try_element_at("_all", F.lit(-1))["time"] + interval).alias("end"),
        "_said.text", "confidence", F.transform("_all", lambda x: x["time"]).alias("sample_times"),
        F.when(F.size("_all") > 1, "temporal_consensus").otherwise("direct_ocr").alias("reconstruction"),
        F.lit("hard_subtitle_ocr").alias("source"), "_said.alternatives",
    )


def _open(every: Column) -> Column:
    """The longest of the credible samples."""

    def longest(credible: Column) -> Column:
        return once(F.array_max(F.transform(credible, lambda x: x["length"])), lambda n: F.filter(credible, lambda x: x["length"] == n))

    def credible(best: Column) -> Column:
        return F.filter(every, lambda x: (x["confidence"] >= CREDIBLE_CONFIDENCE) & (x["quality"] >= best - CREDIBLE_QUALITY))

    return once(once(F.array_max(F.transform(every, lambda x: x["quality"])), credible), longest)


def without_fragments(found: DataFrame) -> DataFrame:
    return found.where(~scoring.is_fragment(F.col("text"), F.col("confidence")))


SEGMENT = "struct<start:double,end:double,text:string,confidence:double,sample_times:array<double>,reconstruction:string,source:string,alternatives:array<string>>"


def _runs(found: DataFrame, by: list[str], interval: float) -> DataFrame:
    """by, _run, _all: the segments in order, cut wherever two neighbours can't be joined whatever has been merged before.

    What has been merged into a segment ends with the whole of the segment's own text. So its ending, and, from
    OVERLAP_WINDOW characters on, its overlap with the next one are known before anything is merged.
    """
    fields = ("start", "end", "text", "confidence", "sample_times", "reconstruction", "source", "alternatives")
    kinds = dict(found.dtypes)
    one = F.struct(*[F.col(c).cast({"start": "double", "end": "double", "confidence": "double"}.get(c, kinds[c])) for c in fields])
    order = Window.partitionBy(*by).orderBy("start", "end", "text")
    ends = [tail(F.col("text"), OVERLAP_WINDOW).alias("_tail"), head(F.col("text"), OVERLAP_WINDOW).alias("_head")]
    rows = found.select(*by, one.cast(SEGMENT).alias("_s"), "start", "end", "text", *ends)
    rows = rows.withColumns({"_left": F.lag("_tail").over(order), "_gap": F.col("start") - F.lag("end").over(order)})
    near = (F.col("_gap") <= interval * 0.5) & ~ends_sentence(F.col("_left"))
    may = near & ((F.length("_left") < OVERLAP_WINDOW) | (overlap_of(F.col("_left"), F.col("_head")) >= 2))
    cut = F.when(F.coalesce(may, F.lit(False)), 0).otherwise(1)
    rows = rows.withColumn("_run", F.sum(cut).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*by, "_run").agg(F.sort_array(F.collect_list("_s")).alias("_all"))


def _folded(every: Column, interval: float) -> Column:
    """The segments of a run joined from the left, where the right one starts as what is merged so far ends."""

    def add(done: Column, x: Column) -> Column:
        return once(F.struct(F.try_element_at(done, F.lit(-1)).alias("last"), x.alias("x")), lambda both: matched(done, both["last"], both["x"]))

    def matched(done: Column, last: Column, x: Column) -> Column:
        near = (x["start"] - last["end"] <= interval * 0.5) & ~ends_sentence(last["text"])
        texts = F.struct(spaced(last["text"]).alias("left"), spaced(x["text"]).alias("right"))
        ends = lambda t: F.struct(F.right(t["left"], F.lit(OVERLAP_WINDOW)).alias("end"), F.left(t["right"], F.lit(OVERLAP_WINDOW)).alias("start"))
        merge = lambda t, n: F.when((n >= 2) & (n < F.length(t["right"])), F.concat(t["left"], F.substr(t["right"], (n + 1).cast("int"))))
        merged = once(texts, lambda t: once(once(ends(t), lambda e: overlap_of(e["end"], e["start"])), lambda n: once(merge(t, n), lambda m: F.when(m != t["right"], m))))
        return once(F.when(near, merged), lambda m: F.when(m.isNull(), F.concat(done, F.array(x))).otherwise(joint(done, last, x, m)))

    def joint(done: Column, last: Column, x: Column, merged: Column) -> Column:
        a, b = F.size(last["sample_times"]), F.size(x["sample_times"])
        joined = F.struct(
            last["start"].alias("start"), x["end"].alias("end"), merged.alias("text"),
            ((last["confidence"] * a + x["confidence"] * b) / (a + b)).alias("confidence"),
            F.concat(last["sample_times"], x["sample_times"]).alias("sample_times"),
            F.lit("overlap_join").alias("reconstruction"), F.lit("hard_subtitle_ocr").alias("source"),
            first_occurrences(F.concat(last["alternatives"], F.array(last["text"]), x["alternatives"], F.array(x["text"]))).alias("alternatives"),
        )
        return F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined.cast(SEGMENT)))

    rest = F.slice(every, F.lit(2), F.greatest(F.size(every) - 1, F.lit(0)))
    return F.when(F.size(every) == 1, every).otherwise(F.aggregate(rest, F.slice(every, 1, 1), add))


def join_overlaps(found: DataFrame, key: str = "output_key", interval: float = INTERVAL) -> DataFrame:
    """Neighbours folded where the right one starts as the left one ends: a chain is joined from the left.

    The fold looks at the text merged so far; it runs over short runs of neighbours that may be joined at all.
    """
    rows = _runs(found, [key], interval).select(key, F.explode(_folded(F.col("_all"), interval)).alias("s")).select(key, "s.*")
    number = F.row_number().over(Window.partitionBy(key).orderBy("start", "end", "text"))
    return rows.withColumn("segment_id", number.cast("long"))


def clip_ends(found: DataFrame, key: str = "output_key") -> DataFrame:
    """No segment ends after the next one starts."""
    following = F.lead("start").over(Window.partitionBy(key).orderBy("start"))
    return found.withColumn("end", F.least("end", following))


def clamp(found: DataFrame, timeline_end: Column) -> DataFrame:
    """Ends cut to the timeline; what would not last is dropped."""
    return found.withColumn("end", F.least("end", timeline_end)).where("end > start")


def assemble(samples: DataFrame, key: str = "output_key", interval: float = INTERVAL, fuzzy: bool = True, support: bool = True) -> DataFrame:
    """Samples to final segments, numbered from 1 within a key."""
    grouped = islands(samples, key, fuzzy)
    kept = without_fragments(segments(grouped, key, interval, support)).drop("island")
    return clip_ends(join_overlaps(kept, key, interval), key)


def assembly_stats(samples: DataFrame, key: str = "output_key", interval: float = INTERVAL, fuzzy: bool = True, support: bool = True) -> DataFrame:
    """input_samples, readable_samples, temporal_consensus_groups, overlap_joins, dropped_low_confidence_fragments."""
    seen = samples.groupBy(key).agg(F.count("*").alias("input_samples"), F.count_if(is_readable(F.col("text"))).alias("readable_samples"))
    found = segments(islands(samples, key, fuzzy), key, interval, support)
    found = found.withColumn("_dropped", scoring.is_fragment(F.col("text"), F.col("confidence")))
    runs = _runs(found, [key, "_dropped"], interval)
    joins = F.size("_all") - F.size(_folded(F.col("_all"), interval))
    several = F.size(F.filter("_all", lambda x: F.size(x["sample_times"]) > 1))
    parts = runs.groupBy(key).agg(
        F.sum(F.when(~F.col("_dropped"), several).otherwise(0)).alias("temporal_consensus_groups"),
        F.sum(F.when(~F.col("_dropped"), joins).otherwise(0)).alias("overlap_joins"),
        F.sum(F.when(F.col("_dropped"), F.size("_all")).otherwise(0)).alias("dropped_low_confidence_fragments"),
    )
    return seen.join(parts, key, "left").na.fill(0)


def frames_to_keep(samples: DataFrame, key: str = "output_key", mode: str = "changed", fuzzy: bool = True) -> DataFrame:
    """samples with `keep`: which frames are worth saving as evidence (mode none, all or changed)."""
    if mode in ("none", "all"):
        return samples.withColumn("keep", F.lit(mode == "all"))
    order = Window.partitionBy(key).orderBy("time")
    rows = samples.withColumn("_key", comparison_key(F.col("text"))).withColumn("_blank", spaced(F.col("text")) == "")
    rows = rows.withColumn("_before", F.lag("_key").over(order)).withColumn("_was_blank", F.lag("_blank").over(order))
    same = (similarity.same_caption if fuzzy else similarity.same_key)(F.col("_before"), F.col("_key"))
    keep = F.when(F.col("_was_blank").isNull(), True).when(F.col("_blank") & F.col("_was_blank"), False)
    keep = keep.otherwise(~F.coalesce(same, F.lit(False)) | (F.col("confidence") < 0.65))
    return rows.withColumn("keep", keep).drop("_key", "_blank", "_before", "_was_blank")


def cues_to_segments(cues: DataFrame) -> DataFrame:
    """Cues of a subtitle track are segments already."""
    return cues.withColumns(
        {
            "confidence": F.lit(1.0), "sample_times": F.array("start"), "reconstruction": F.lit("direct_subtitle_track"),
            "source": F.lit("subtitle_track"), "alternatives": F.array().cast("array<string>"),
        }
    )
