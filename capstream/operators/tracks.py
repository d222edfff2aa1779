"""Choosing among the subtitle tracks of a video."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstream.functions.text import is_dialogue

# What in a file's name tells how its track was made and its language.
MACHINE = ("ai", "auto", "asr", "自动")
CHINESE = ("zh", "chi", "chs", "cht", "中文")
JAPANESE = ("ja", "jp", "jpn", "日文")


def _any(name: Column, tokens: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for token in tokens:
        out = out | F.contains(name, F.lit(token))
    return out


def priority(file_name: Column) -> Column:
    """0 for people's Chinese, 1 for machines' Chinese, 2 for Japanese, 3 for the rest; tokens count anywhere in the name."""
    name = F.lower(file_name)
    chinese = _any(name, CHINESE)
    return F.when(chinese & ~_any(name, MACHINE), 0).when(chinese, 1).when(_any(name, JAPANESE), 2).otherwise(3).cast("long")


def rank(tracks: DataFrame, key: str, name: str = "name", count: str = "dialogue_count", path: str | None = None) -> DataFrame:
    """tracks with priority and place: 1 is the one to take."""
    order = [F.col("priority"), F.col(count).desc(), F.lower(name), *([F.col(path)] if path else [])]
    return tracks.withColumn("priority", priority(F.col(name))).withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long"))


def usable(cues: DataFrame, key: str, name: str) -> DataFrame:
    """key, name, dialogue_count of the tracks with at least one line of dialogue."""
    return cues.where(is_dialogue(F.col("text"))).groupBy(key, name).agg(F.count("*").alias("dialogue_count"))


def select(cues: DataFrame, key: str, name: str = "name") -> DataFrame:
    """The dialogue cues of every video's best track."""
    best = rank(usable(cues, key, name), key, name).where("place = 1").select(key, name)
    return cues.where(is_dialogue(F.col("text"))).join(best, [key, name], "left_semi")


def rejected(cues: DataFrame, files: DataFrame, key: str, name: str = "name") -> DataFrame:
    """key, name, reason of the files that give no dialogue."""
    return files.select(key, name).join(usable(cues, key, name), [key, name], "left_anti").withColumn("reason", F.lit("no dialogue cues"))
