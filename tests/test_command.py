"""A run from the command line, and a second one over what the first has written."""

from __future__ import annotations

import json

from capstream import __main__ as command


def test_two_runs(spark, tmp_path, capsys):
    (tmp_path / "subs" / "av11").mkdir(parents=True)
    (tmp_path / "subs" / "av11" / "x.srt").write_text("1\n00:00:01,000 --> 00:00:02,500\nfrom a file\n")
    samples = [("av12", 0.0, "read from", 0.9, 0.9), ("av12", 3.0, "read from frames", 0.9, 0.9)]
    spark.createDataFrame(samples, command.SAMPLES).write.parquet(f"{tmp_path}/samples")
    (tmp_path / "list.txt").write_text("1. av12\n2. av13\n")
    words = ["av11", f"@{tmp_path}/list.txt", "nonsense", "--output", f"{tmp_path}/out", "--subtitles", f"{tmp_path}/subs", "--samples", f"{tmp_path}/samples"]
    assert command.main(spark, words) == 0
    said = capsys.readouterr().out
    assert "av11: 1 segments" in said and "av12: 1 segments" in said and "av13: no segments" in said and "4 processed, 2 successful, 0 cached, 2 failed" in said
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/out/segments.jsonl").collect()]
    assert sorted(x["text"] for x in lines) == ["from a file", "read from frames"]
    assert command.main(spark, words) == 0
    assert "4 processed, 2 successful, 2 cached, 2 failed" in capsys.readouterr().out
    assert len(spark.read.text(f"{tmp_path}/out/subtitle.srt").collect()) == 6  # still there
