"""Recognised lines in the plane: reading rows, speaker labels, candidates of recognition passes, thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstream.functions import scoring
from capstream.functions.text import compact, join_lines, once, trimmed

# Relative regions of the picture (top, bottom, left, right).
CROP = (0.50, 0.94, 0.04, 0.96)
SPEAKER_REGIONS = {
    "left_upper": (0.54, 0.68, 0.14, 0.42),
    "left_lower": (0.62, 0.76, 0.06, 0.30),
    "center": (0.62, 0.76, 0.38, 0.64),
}
MARGIN, LABEL_CHARS, ROW_TOLERANCE = 0.025, 10, 0.65

LINE = "struct<text:string,confidence:double,box:array<array<double>>>"


def _at(box: Column, i: int) -> Column:
    return F.transform(box, lambda p: p[i])


def center_y(box: Column) -> Column:
    ys = _at(box, 1)
    return F.aggregate(ys, F.lit(0.0), lambda a, y: a + y) / F.size(ys)


def height(box: Column) -> Column:
    return F.array_max(_at(box, 1)) - F.array_min(_at(box, 1))


def left(box: Column) -> Column:
    return F.array_min(_at(box, 0))


def reading_rows(lines: Column) -> Column:
    """array<array<line>>: lines in rows from the top, each from the left.

    From the highest centre down, a line joins the last row if its centre is near the row's mean centre.
    """
    placed = F.sort_array(F.transform(lines, lambda x: F.struct(center_y(x["box"]).alias("y"), left(x["box"]).alias("x"), height(x["box"]).alias("h"), x.alias("line"))))
    kind = f"struct<y:double,x:double,h:double,line:{LINE}>"

    def add(rows: Column, item: Column) -> Column:
        return once(F.try_element_at(rows, F.lit(-1)), lambda last: placed_in(rows, item, last))

    def placed_in(rows: Column, item: Column, last: Column) -> Column:
        mean = F.aggregate(last, F.lit(0.0), lambda a, r: a + r["y"]) / F.size(last)
        tallest = F.array_max(F.transform(last, lambda r: r["h"]))
        near = F.abs(item["y"] - mean) <= F.greatest(tallest, item["h"]) * ROW_TOLERANCE
        joined = F.concat(F.slice(rows, F.lit(1), F.greatest(F.size(rows) - 1, F.lit(0))), F.array(F.concat(last, F.array(item))))
        return F.when(F.size(rows) == 0, F.array(F.array(item))).when(near, joined).otherwise(F.concat(rows, F.array(F.array(item))))

    rows = F.aggregate(placed.cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>"), add)
    by_left = lambda row: F.transform(F.sort_array(F.transform(row, lambda r: F.struct(r["x"].alias("x"), r["y"].alias("y"), r["line"].alias("line")))), lambda r: r["line"])
    return F.transform(rows, by_left)


def row_role(row: Column, width: Column, tall: Column, crop: tuple[float, float, float, float] = CROP) -> Column:
    """speaker_hint for a short row wholly within a label region, dialogue else, unknown without a picture."""
    top, bottom, start, stop = crop
    x = lambda v: F.lit(start) + v / width * (stop - start)
    y = lambda v: F.lit(top) + v / tall * (bottom - top)

    def extent(points: Column) -> Column:
        """left, right, top, bottom of the row in the whole picture."""
        xs, ys = _at(points, 0), _at(points, 1)
        return F.struct(x(F.array_min(xs)).alias("l"), x(F.array_max(xs)).alias("r"), y(F.array_min(ys)).alias("t"), y(F.array_max(ys)).alias("b"))

    def inside(e: Column) -> Column:
        found = F.lit(False)
        for t, b, lo, hi in SPEAKER_REGIONS.values():
            found = found | ((e["l"] >= lo - MARGIN) & (e["r"] <= hi + MARGIN) & (e["t"] >= t - MARGIN) & (e["b"] <= b + MARGIN))
        return found

    short = F.length(compact(join_lines(F.transform(row, lambda r: r["text"])))) <= LABEL_CHARS
    label = once(once(F.flatten(F.transform(row, lambda r: r["box"])), extent), inside)
    return F.when((width <= 0) | (tall <= 0) | (F.size(row) == 0), "unknown").when(short & label, "speaker_hint").otherwise("dialogue")


def candidate(frames: DataFrame, lines: str = "lines", width: str = "width", tall: str = "height", crop=CROP) -> DataFrame:
    """frames with the ordered lines and their role, and text, confidence and quality of what is not a label."""
    parsed = F.filter(F.col(lines), lambda x: (trimmed(x["text"]) != "") & (F.size(x["box"]) > 0) & x["confidence"].isNotNull())
    rows = reading_rows(F.transform(parsed, lambda x: F.struct(trimmed(x["text"]).alias("text"), x["confidence"].alias("confidence"), x["box"].alias("box"))))

    def with_role(row: Column) -> Column:
        line = lambda x, role: F.struct(x["text"].alias("text"), x["confidence"].alias("confidence"), x["box"].alias("box"), role.alias("role"))
        return once(row_role(row, F.col(width), F.col(tall), crop), lambda role: F.transform(row, lambda x: line(x, role)))

    out = frames.withColumn("_ordered", F.flatten(F.transform(rows, with_role)))
    out = out.withColumn("_spoken", F.filter("_ordered", lambda x: x["role"] != "speaker_hint"))
    out = out.withColumn("text", join_lines(F.transform("_spoken", lambda x: x["text"]))).withColumn("confidence", scoring.weighted_confidence(F.col("_spoken")))
    out = out.withColumn("quality", scoring.quality(F.col("text"), F.col("confidence"), F.size("_spoken")))
    return out.withColumn(lines, F.col("_ordered")).drop("_ordered", "_spoken")


def crop_box(width: Column, tall: Column, crop: tuple[float, float, float, float] = CROP) -> Column:
    """struct(left, top, right, bottom): the part of a picture in pixels, halves to even."""
    top, bottom, start, stop = crop
    pixel = lambda size, share, name: F.rint(size * F.lit(share)).cast("int").alias(name)
    return F.struct(pixel(width, start, "left"), pixel(tall, top, "top"), pixel(width, stop, "right"), pixel(tall, bottom, "bottom"))


def best_pass(candidates: DataFrame, by: list[str], number: str = "pass_no") -> DataFrame:
    """The best of a frame's recognition passes; the earliest of equals."""
    rank = scoring.candidate_rank(F.col("text"), F.col("confidence"), F.col("quality"))
    order = Window.partitionBy(*by).orderBy(rank.desc(), number)
    return candidates.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")


def otsu(histogram: DataFrame, by: list[str], bin_: str = "bin", count: str = "count") -> DataFrame:
    """by, threshold: the first bin of the largest variance between what lies up to it and above; 128 if there is none."""
    up_to = Window.partitionBy(*by).orderBy(bin_).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    n = F.col(count).cast("double")
    rows = histogram.withColumns({"_w": F.sum(n).over(up_to), "_s": F.sum(n * F.col(bin_)).over(up_to), "_n": F.sum(n).over(whole), "_t": F.sum(n * F.col(bin_)).over(whole)})
    usable = (F.col("_w") > 0) & (F.col("_n") > F.col("_w"))
    rest = F.nullif(F.col("_n") - F.col("_w"), F.lit(0.0))
    gap = F.col("_s") / F.nullif(F.col("_w"), F.lit(0.0)) - (F.col("_t") - F.col("_s")) / rest
    rows = rows.withColumn("_v", F.when(usable, F.col("_w") * (F.col("_n") - F.col("_w")) * gap * gap))
    best = rows.groupBy(*by).agg(F.max(F.when(F.col("_v").isNotNull(), F.struct(F.col("_v"), (-F.col(bin_)).alias("least")))).alias("best"))
    return best.select(*by, F.coalesce(-F.col("best.least"), F.lit(128)).cast("long").alias("threshold"))
