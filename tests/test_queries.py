"""Every registered query against its SQL in DuckDB, at the smallest scale; batch runs and streams."""

from __future__ import annotations

import os

import duckdb
import pytest
from capstream.operators import manifest
from capstream.plans import batch, catalogue
from capstream.streaming import captions as streaming

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from read_parquet('{SF}/{f}')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, con, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    assert name in catalogue.ORACLE_SQL or len(got)
    if name in catalogue.ORACLE_SQL:
        want = con.execute(catalogue.ORACLE_SQL[name]).df()
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        plain = lambda df: sorted(map(repr, df[columns].astype(object).where(df[columns].notna(), None).values.tolist()))
        assert plain(got) == plain(want)


def test_a_run_prefers_tracks_skips_what_is_done_and_isolates_errors(spark, tmp_path):
    settings = manifest.Settings()
    raw = spark.createDataFrame([("BV1uknVz9EeN av1 av2 av3\nnonsense",)], "raw string")
    cues = spark.createDataFrame([("av1", "x.zh.srt", 0.0, 1.0, "track"), ("av2", "x.srt", 0.0, 1.0, "[music]")], "output_key string, name string, start double, end double, text string")
    seen = [("av1", 0.0, "not read", 0.9, 0.9), ("av2", 0.0, "read from frames", 0.9, 0.9)]
    samples = spark.createDataFrame(seen, "output_key string, time double, text string, confidence double, quality double")
    none = spark.createDataFrame([], "output_key string, fingerprint string, status string")
    first = batch.run(raw, cues, samples, none, settings)
    assert {r.output_key: r.text for r in first.segments.collect()} == {"av1": "track", "av2": "read from frames"}
    items = {r.raw_input: (r.success, r.skipped, r.failure_reason) for r in first.items.collect()}
    assert items["av1"] == items["av2"] == (True, False, None)
    assert items["av3"] == (False, False, "no segments") and items["nonsense"][0] is False
    first.manifests.write.parquet(str(tmp_path / "manifests"))
    again = batch.run(raw, cues, samples, spark.read.parquet(str(tmp_path / "manifests")), settings)
    assert {r.raw_input for r in again.items.collect() if r.skipped} == {"av1", "av2"}
    assert again.segments.count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_throttled_stream_agrees_with_the_batch(spark, tmp_path):
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events"))
    stream = streaming.event_stream(spark, str(tmp_path / "events"), files_per_trigger=10)
    got = {(r.user_id, r.time) for r in streaming.drained(streaming.throttled(stream, "user_id", 86400.0)).collect()}
    want = {(r.user_id, r.time) for r in catalogue.throttle_sample(spark, SF).collect()}
    assert got == want
