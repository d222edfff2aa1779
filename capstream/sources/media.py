"""Files around a video, and what is fetched or recognised by others: pluggable seams."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capstream.functions import scoring
from capstream.operators.geometry import best_pass, candidate
from capstream.sources.subtitles import suffix

# Containers that count as video.
VIDEO_SUFFIXES = (".mp4", ".mkv", ".flv", ".webm", ".mov")
RETRIES, RETRY_SECONDS, RETRIED = 3, (2, 4), ("412", "Precondition Failed")


def listing(spark: SparkSession, path: str, suffixes: tuple[str, ...]) -> DataFrame:
    """path, length of non-empty files with one of the suffixes, at any depth; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return files.where((F.col("length") > 0) & suffix(F.col("path")).isin(*suffixes))


def find_videos(spark: SparkSession, path: str) -> DataFrame:
    return listing(spark, path, VIDEO_SUFFIXES)


def info_metadata(files: DataFrame, key: str) -> DataFrame:
    """key, title, video_id of the first *.info.json by name that can be parsed, from files(key, path, content)."""
    rows = files.where(F.col("path").endswith(".info.json")).withColumn("info", F.from_json("content", "title string, id string"))
    rows = rows.where("info is not null and content rlike '^\\\\s*[{]'")
    first = Window.partitionBy(key).orderBy("path")
    rows = rows.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    return rows.select(key, F.col("info.title").alias("title"), F.col("info.id").alias("video_id"))


def probed(rows: DataFrame, column: str = "probe") -> DataFrame:
    """width, height and duration from a media probe's JSON; null wherever something is missing or malformed."""
    kind = "streams array<struct<width:string,height:string>>, format struct<duration:string>"
    got = rows.withColumn("_p", F.from_json(column, kind))
    first = F.try_element_at("_p.streams", F.lit(1))
    return got.withColumns(
        {"width": first["width"].try_cast("int"), "height": first["height"].try_cast("int"), "duration": F.col("_p.format.duration").try_cast("double")}
    ).drop("_p")


def fetch_result(subtitles: DataFrame, videos: DataFrame, key: str) -> DataFrame:
    """key, path, source: the subtitle track where there is one, else the video."""
    both = subtitles.select(key, F.col("path").alias("_track")).join(videos.select(key, F.col("path").alias("_video")), key, "full")
    return both.select(key, F.coalesce("_track", "_video").alias("path"), F.when(F.col("_track").isNotNull(), "subtitle_track").otherwise("video").alias("source"))


def with_retries(call: Callable[[], object], sleep: Callable[[float], None] = time.sleep) -> object:
    """A fetch, tried again only where the service asks to slow down."""
    for attempt in range(RETRIES):
        try:
            return call()
        except Exception as error:
            if attempt == RETRIES - 1 or not any(sign in str(error) for sign in RETRIED):
                raise
            sleep(RETRY_SECONDS[attempt])
    return None


class Engine(Protocol):
    """Recognises text in a picture: [box, text, score] for each line."""

    name: str

    def recognize(self, image: bytes) -> list: ...


def lines_of(raw: object) -> list[tuple[object, object, object]]:
    """(box, text, score) of what an engine returned: an object with boxes, txts and scores, three equally long
    columns, rows, or a tuple that begins with any of these but the first; nothing for None."""
    plain = lambda x: isinstance(x, (list, tuple))
    names = ("boxes", "txts", "scores")
    if all(hasattr(raw, n) for n in names):
        columns = [getattr(raw, n) for n in names]
        return _zipped([[] if c is None else list(c) for c in columns])
    body = raw[0] if isinstance(raw, tuple) and raw else raw
    if not plain(body):
        return []
    columnar = len(body) == 3 and all(plain(x) for x in body) and len({len(x) for x in body}) == 1
    return _zipped(body) if columnar else [tuple(row) for row in body]


def _zipped(columns: list) -> list[tuple[object, object, object]]:
    return [(box.tolist() if hasattr(box, "tolist") else box, text, score) for box, text, score in zip(*columns, strict=False)]


_LINES = "lines array<struct<text:string,confidence:double,box:array<array<double>>>>"


def recognised(images: DataFrame, key: str, order: str, make_engine: Callable[[], Engine], content: str = "content", prepare: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """key, order, lines of every picture, `prepare`d if asked; one engine for each task, pictures in Arrow batches."""
    kinds = dict(images.dtypes)

    def read(engine: Engine, data: bytes) -> list[dict]:
        found = lines_of(engine.recognize(prepare(data) if prepare else data))
        return [{"text": str(t), "confidence": float(c), "box": [[float(x), float(y)] for x, y in box]} for box, t, c in found]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = make_engine()
        for batch in batches:
            yield pd.DataFrame({key: batch[key], order: batch[order], "lines": [read(engine, bytes(data)) for data in batch[content]]})

    return images.select(key, order, content).mapInPandas(run, f"{key} {kinds[key]}, {order} {kinds[order]}, {_LINES}")


def recognised_adaptively(
    images: DataFrame, key: str, order: str, make_engine: Callable[[], Engine], enhance: Callable[[bytes], bytes], binary: Callable[[bytes], bytes],
    threshold: float = 0.78, content: str = "content",
) -> DataFrame:
    """key, order, lines, text, confidence, quality, variant, ocr_calls from images(key, order, content, width, height).

    Each pass sees only the pictures that need it: the second those read badly at first, the third those
    whose best reading so far is still poor. Passes are rows, and the best row of a picture wins, the earlier of equals.
    """
    by = [key, order]

    def passed(some: DataFrame, number: int, variant: str, prepare: Callable[[bytes], bytes] | None) -> DataFrame:
        sizes = some.select(*by, "width", "height")
        rows = candidate(recognised(some, key, order, make_engine, content, prepare).join(sizes, by))
        return rows.drop("width", "height").withColumns({"pass_no": F.lit(number), "variant": F.lit(variant)})

    value = [F.col("text"), F.col("confidence"), F.col("quality")]
    rows = passed(images, 1, "base", None)
    rows = rows.unionByName(passed(images.join(rows.where(scoring.needs_enhancement(*value, threshold)), by, "left_semi"), 2, "enhanced", enhance))
    poor = best_pass(rows, by).where(scoring.needs_binary_pass(*value))
    rows = rows.unionByName(passed(images.join(poor, by, "left_semi"), 3, "binary", binary))
    calls = rows.groupBy(*by).agg(F.count("*").cast("int").alias("ocr_calls"))
    return best_pass(rows, by).drop("pass_no").join(calls, by)
