"""Subtitle formats, identifiers, time codes, tracks, settings, files and documents, on examples of our own."""

from __future__ import annotations

import json
import random
import re

import pytest
from capstream.functions import ids, text, timecode
from capstream.operators import captions, geometry, manifest, sampling, sinks, tracks
from capstream.sources import media, subtitles
from pyspark.sql import functions as F


def cues(spark, suffix, content):
    df = spark.createDataFrame([("p", content, suffix)], "path string, content string, suffix string")
    return [(r.start, r.end, r.text) for r in subtitles.parse_files(df).orderBy("cue_idx").collect()]


def test_srt_and_vtt(spark):
    two = "7\r\n01:02:03,500 --> 01:02:04,000\r\n<font color='red'>Guten</font>  Abend\r\n- wer da?\r\n\r\n\r\n8\r\n01:02:04,000 --> 01:02:04,000\r\nno time at all\r\n"
    assert cues(spark, ".srt", two) == [(3723.5, 3724.0, "Guten Abend\n- wer da?")]
    vtt = "WEBVTT - notes\n\nNOTE none\n\nintro\n00:09.250 --> 00:11.000 align:start\ncaf&eacute; &#8212; open\n\n00:12.000 --> 00:13.000\n\t\nlost"
    assert cues(spark, ".vtt", vtt) == [(9.25, 11.0, "café — open")]


def test_ass(spark):
    head = "[Events]\nFormat: Layer, Start, End, Style, Name, MarginL, MarginR, MarginV, Effect, Text\n"
    lines = "Comment: 0,0:00:00.00,0:00:09.00,D,,0,0,0,,hidden\nDialogue: 3,0:01:00.50,0:01:02.25,D,Mara,0,0,0,,{\\pos(3,4)\\b1}Wait, {\\b0}please\\n(now)\nDialogue: 0,bad,0:00:01.00,D,,0,0,0,,x\nDialogue: 0,0:00:01.00,short"
    assert cues(spark, ".ssa", head + lines) == [(60.5, 62.25, "Wait, please\n(now)")]


def test_json(spark):
    body = [{"start": "8.5", "to": 9, "body": "rain &amp; snow"}, {"from": None, "start": 1, "to": 2, "content": "a null counts"}, {"start_time": 4, "end_time": 6.5, "text": " two \n\n rows "}, {"from": 5, "to": 4, "text": "backwards"}, "word", 3]
    assert cues(spark, ".json", json.dumps({"body": body, "v": 1})) == cues(spark, ".json", json.dumps(body)) == [(8.5, 9.0, "rain & snow"), (4.0, 6.5, "two\nrows")]
    assert [cues(spark, ".json", x) for x in ("{", "17", "null", '{"body": {}}', "")] == [[]] * 5


def test_xml(spark):
    nodes = ['<P xmlns="urn:z" begin="0" start="2.5" end="3">one<br/>two</P>', '<text from="4" dur="1.5"> x<i>y</i> </text>', '<d p="7.25,1,25">shown</d>', '<d p="8,1" duration="2">shown &amp; gone</d>', '<p start="" from="11" end="" to="12">stand-in</p>', '<p start="1" end="?">odd</p>', '<span start="1" end="2">not ours</span>', "<p>no time</p>"]
    assert cues(spark, ".xml", f"<?xml version='1.0'?><r>{''.join(nodes)}<!-- <p/> --></r>") == [(2.5, 3.0, "onetwo"), (4.0, 5.5, "xy"), (8.0, 10.0, "shown & gone"), (11.0, 12.0, "stand-in")]
    assert cues(spark, ".xml", "<r><p start='1' end='2'>cut") == cues(spark, ".xml", "") == []


def test_srt_blocks_against_a_scan(spark):
    rng = random.Random(1)
    choices = ["", " ", "words", "00:01.0 --> 00:02.0", "00:00:01,5 --> 00:00:03,0", "7", "\t"]
    files = {i: [rng.choice(choices[:1] + choices) for _ in range(rng.randint(0, 12))] for i in range(150)}
    got = subtitles.parse_srt(spark.createDataFrame([(i, "\n".join(x)) for i, x in files.items()], "id int, content string"), ["id"]).orderBy("id", "cue_idx").collect()
    for i, rows in files.items():
        found, body = [], None
        for row in [*rows, ""]:
            if body is None:
                body = [] if re.search(subtitles.TIME_RANGE, row) else None
            elif row.strip():
                body.append(row)
            else:
                found += ["\n".join(body)] if body else []
                body = None
        assert [r.text for r in got if r.id == i] == found


def test_files_are_read_whole(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.srt").write_bytes(b"\xef\xbb\xbf1\n00:00:01,000 --> 00:00:02,000\nbad byte \xff here\n")
    (tmp_path / "deep" / "B.VTT").write_text("WEBVTT\n\n00:01.000 --> 00:02.000\nsecond\n")
    found = subtitles.parse_files(subtitles.read_files(spark, str(tmp_path))).collect()
    assert sorted(r.text for r in found) == ["bad byte � here", "second"]


def test_track_choice(spark):
    said = [("v", "clip.asr.chi.vtt", "by machine"), ("v", "clip.CHS.ass", "by hand"), ("v", "clip.jpn.srt", "♪ BGM ♪"), ("v", "clip.fr.srt", "autre"), ("w", "w.ja.srt", "one"), ("w", "w.en.srt", "two")]
    df = spark.createDataFrame([(k, n, 0.0, 1.0, t) for k, n, t in said], "output_key string, name string, start double, end double, text string")
    assert sorted(r.text for r in tracks.select(df, "output_key").collect()) == ["by hand", "one"]
    gone = tracks.rejected(df, df.select("output_key", "name").distinct(), "output_key").collect()
    assert [(r.name, r.reason) for r in gone] == [("clip.jpn.srt", "no dialogue cues")]
    segments = captions.cues_to_segments(df.where("output_key = 'w'")).collect()
    assert {(r.source, r.reconstruction, r.confidence, tuple(r.sample_times)) for r in segments} == {("subtitle_track", "direct_subtitle_track", 1.0, (0.0,))}


BV, AV = "BV1abcDEF234", "av170001"


def test_inputs(spark):
    raw = spark.createDataFrame([(f"(1) {BV}\n2、 {AV}， https://b23.tv/q7\n\n3. 4)  {BV} 99",)], "raw string")
    assert [r.value for r in ids.parse_inputs(raw).orderBy("position").collect()] == [BV, AV, "https://b23.tv/q7"]
    cases = {f" {BV}　": BV, "AV31": "av31", f"https://www.bilibili.com/video/{BV}?p=2": BV, "https://b23.tv/q7": None, "https://elsewhere.example/": None, "BVshort": None}
    got = {r.v: r.r for r in spark.createDataFrame([(c,) for c in cases], "v string").select("v", ids.resolve(F.col("v")).alias("r")).collect()}
    assert {v: r.video_id for v, r in got.items()} == cases
    assert [bool(got[v].error) for v in cases] == [False, False, False, False, True, True]
    assert re.fullmatch("url-[0-9a-f]{12}", got["https://b23.tv/q7"].output_key)


def test_identifiers_alone(spark):
    rows = spark.createDataFrame([(AV,), (" " + BV,), ("https://x.example/a",), ("see bV1abcDEF234 and av3",), ("nothing",), (None,)], "v string")
    got = rows.select(ids.normalize_input(F.col("v")).alias("n"), ids.extract_video_id(F.col("v")).alias("i")).collect()
    assert [r.n for r in got] == [ids.VIDEO_URL.format(AV), ids.VIDEO_URL.format(BV), "https://x.example/a", None, None, None]
    assert [r.i for r in got] == [AV, BV, None, "bV1abcDEF234", None, None]
    with pytest.raises(Exception, match="unrecognized input"):
        rows.where("v = 'nothing'").select(ids.normalize_input(F.col("v"), strict=True)).collect()


def test_time_codes(spark):
    def values(f, raw):
        return [r[0] for r in spark.createDataFrame([(x,) for x in raw], "v string").select(f(F.col("v"))).collect()]

    assert values(timecode.parse_timecode, ["　07:08,25 ", "10:00:00.5", "5", "a:1", "1:2:3:4"]) == [428.25, 36000.5, None, None, None]
    assert values(timecode.parse_time_value, ["12.5", "2:03", "2:61", "3:00:07", "3:60:00", "-4", "x", ""]) == [12.5, 123.0, None, 10807.0, None, None, None, None]
    assert values(timecode.seconds_or_null, [" ", "4", None, "x"]) == [None, 4.0, None, None]
    row = spark.range(1).select(timecode.srt_timestamp(F.lit(7384.0625)), timecode.display_timestamp(F.lit(-3.0)), timecode.srt_timestamp(F.lit(0.0005))).first()
    assert tuple(row) == ("02:03:04,062", "00:00:00.000", "00:00:00,000")
    numbers = [0.0, 3.0, 2.5, 1234567.0, 0.00001, -0.125, 100000.0, 999999.5, 1 / 3, 123456.5]
    got = spark.createDataFrame([(x,) for x in numbers], "v double").select(timecode.shown_number(F.col("v"))).collect()
    assert [r[0] for r in got] == [f"{x:g}" for x in numbers]
    rng = random.Random(8)
    numbers = [0.15, 0.25, 0.35, 2.675, -1.005, 0.0005, -0.0004, *(rng.randrange(10**6) / 1000 for _ in range(300)), *(rng.uniform(0, 5000) for _ in range(100))]
    got = spark.createDataFrame([(x,) for x in numbers], "v double").select("v", timecode.fixed(F.col("v"), 1).alias("a"), timecode.fixed(F.col("v"), 3).alias("b")).collect()
    assert all((r.a.lstrip("-"), r.b.lstrip("-")) == (f"{abs(r.v):.1f}", f"{abs(r.v):.3f}") for r in got)


def test_last_line_of_a_log(spark):
    df = spark.createDataFrame([("first\r\n  then\t\n\n",), (" \n",), (None,)], "t string")
    assert [r[0] for r in df.select(text.last_log_line(F.col("t"))).collect()] == ["then", "unknown error", "unknown error"]


def test_settings_and_fingerprints(spark):
    for wrong in ({"sample_interval_seconds": 1.0}, {"start_time": 8.0, "end_time": 8.0}, {"start_time": -1.0}, {"crop": (0.3, 0.2, 0.0, 1.0)}, {"max_frame_width": 320}, {"frame_similarity_threshold": 1.5}, {"keep_frames": "some"}):
        with pytest.raises(ValueError):
            manifest.Settings(**wrong)
    name = lambda s: spark.range(1).select(manifest.fingerprint(s, F.lit("k"))).first()[0]
    base = name(manifest.Settings())
    assert base == name(manifest.Settings(keep_frames="none", force=True))
    assert len({base, name(manifest.Settings(start_time=6.0)), name(manifest.Settings(adaptive_ocr_confidence=0.5))}) == 3


def test_manifest_files_and_lifecycle(spark, tmp_path):
    held = {"one": json.dumps({"status": "success", "output_key": BV, "fingerprint": "f", "extra": [1]}), "two": "{broken", "three": "[1, 2]", "four": "", "five": "{}"}
    for folder, content in held.items():
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "manifest.json").write_text(content)
    got = {r.path.rsplit("/", 2)[1]: (r.status, r.output_key) for r in manifest.read(spark, str(tmp_path)).collect()}
    assert got == {"one": ("success", BV), "five": (None, None)}
    kind = "output_key string, fingerprint string, status string, updated_at int"
    rows = spark.createDataFrame([("a", "f", "running", 1), ("a", "f", "success", 2), ("b", "f", "success", 1), ("b", "f", "running", 2), ("c", "g", "failed", 1)], kind)
    now = manifest.latest(rows)
    wanted = spark.createDataFrame([(k, "f") for k in "abcd"], "output_key string, fingerprint string")
    assert sorted(r.output_key for r in manifest.pending(wanted, now).collect()) == ["b", "c", "d"]
    assert [r.output_key for r in manifest.done(wanted, now).collect()] == ["a"] and manifest.done(wanted, now, force=True).isEmpty()
    full = {name: 5 for name in manifest.REQUIRED_OUTPUTS}
    files = spark.createDataFrame([("a", "f", "success", full), ("b", "f", "success", full | {"subtitle": 0})], "output_key string, fingerprint string, status string, outputs map<string,int>")
    assert [r.output_key for r in manifest.valid(files).collect()] == ["a"]
    inputs = spark.createDataFrame([("r", "u", BV, BV, "f")], "raw_input string, url string, video_id string, output_key string, fingerprint string")
    assert manifest.started(inputs, manifest.Settings()).first().status == "running"


SEGMENTS = "output_key string, segment_id long, start double, end double, text string, confidence double, sample_times array<double>, reconstruction string, source string, alternatives array<string>"


def test_documents(spark, tmp_path):
    rows = [("k", 2, 62.0, 63.25, "later", 0.75, [62.0], "direct_ocr", "hard_subtitle_ocr", ["Later"]), ("k", 1, 1.0, 2.0, "früher", 1.0, [1.0], "temporal_consensus", "subtitle_track", [])]
    df = spark.createDataFrame(rows, SEGMENTS)
    assert sinks.srt(df).first().document == "1\n00:00:01,000 --> 00:00:02,000\nfrüher\n\n2\n00:01:02,000 --> 00:01:03,250\nlater\n"
    page = sinks.markdown(df).first().document
    assert page.startswith("# Transcript\n\n[00:00:01.000 --> 00:00:02.000]\nfrüher\n<!-- source=subtitle_track; confidence=1.000; reconstruction=temporal_consensus -->\n") and page.endswith("-->\n")
    assert sinks.plain_transcript(df, "here").first().document == "# k\nSource: here\n\n- 1.0s-2.0s früher\n- 62.0s-63.2s later\n"
    found = [json.loads(r.line) for r in sinks.json_lines(df).orderBy("segment_id").collect()]
    assert found[1] == {"segment_id": 2, "start": 62.0, "end": 63.25, "text": "later", "confidence": 0.75, "sample_times": [62.0], "reconstruction": "direct_ocr", "source": "hard_subtitle_ocr", "alternatives": ["Later"]}
    sinks.write_json_lines(sinks.json_lines(df), str(tmp_path))
    sinks.write_documents(sinks.srt(df), str(tmp_path), "subtitle.srt")
    written = spark.read.text(f"{tmp_path}/segments.jsonl")
    assert [json.loads(r.value)["segment_id"] for r in written.collect()] == [1, 2]
    assert "früher" in "".join(r.value for r in spark.read.text(f"{tmp_path}/subtitle.srt").collect())


def test_loose_rows_get_defaults(spark):
    df = spark.createDataFrame([("4.5", None, "x", "elsewhere"), (None, "nan?", None, "subtitle_track")], "start string, end string, text string, source string")
    got = [(r.start, r.end, r.text, r.confidence, r.sample_times, r.source) for r in sinks.coerced(df).collect()]
    assert got == [(4.5, 4.5, "x", 1.0, [4.5], "hard_subtitle_ocr"), (0.0, 0.0, "", 1.0, [0.0], "subtitle_track")]


def test_cards_indexes_and_status(spark):
    video = spark.createDataFrame([("in", "u", None, "k", None, "subtitle_track")], "raw_input string, url string, video_id string, output_key string, title string, source_type string")
    card = sinks.source_card(video, 3.0, start=12.5).first().document
    assert "- Video ID: unresolved" in card and "- Title: unknown" in card and "- Processed range: 12.5 to video end" in card and "- Sample interval: 3 seconds" in card
    seen = spark.createDataFrame([("k", 1.23456, "a", 0.12345678, 0.5, 1, False), ("k", 4.0, "　", 0.9, 0.25, 0, True)], "output_key string, time double, text string, confidence double, quality double, ocr_calls int, reused boolean")
    assert [(r.time, r.confidence) for r in sinks.frame_index(seen).orderBy("time").collect()] == [(1.235, 0.123457), (4.0, 0.9)]
    stats = sinks.recognition_stats(seen)
    assert json.loads(sinks.status_documents(stats).first().document) == {"frame_count": 2, "ocr_call_count": 1, "reused": 1, "with_text": 1, "average_confidence": 0.12345678}
    items = spark.createDataFrame([(True, False), (True, True), (False, None), (None, None)], "success boolean, skipped boolean")
    assert tuple(sinks.summary(items).first()) == (4, 2, 1, 2, True)


def box(text, left, top, right, bottom, confidence=0.9):
    return (text, confidence, [[float(x), float(y)] for x, y in ((left, top), (right, top), (right, bottom), (left, bottom))])


def candidate(spark, *lines):
    df = spark.createDataFrame([(list(lines), 100.0, 100.0)], "lines array<struct<text:string,confidence:double,box:array<array<double>>>>, width double, height double")
    return geometry.candidate(df).first()


def test_reading_order_and_labels(spark):
    # two rows, given out of order; the second one slants
    two = candidate(spark, box("row", 60, 84, 80, 96), box("upper", 50, 50, 90, 60), box("lower", 10, 80, 40, 92))
    assert two.text == "upper lower row" and {x.role for x in two.lines} == {"dialogue"}
    label = candidate(spark, box("Ida", 22, 18, 30, 33), box("so it ends", 15, 80, 85, 95))
    assert (label.text, [x.role for x in label.lines]) == ("so it ends", ["speaker_hint", "dialogue"])
    long = candidate(spark, box("eleven chars", 22, 18, 30, 33))
    assert long.text == "eleven chars"  # too long for a label
    assert candidate(spark, box(" ", 1, 1, 2, 2)).text == "" and candidate(spark).quality == 0.0


def test_pictures_parts(spark):
    df = spark.createDataFrame([(640, 361)], "w int, h int")
    got = df.select(geometry.crop_box(F.col("w"), F.col("h")).alias("b")).first().b
    assert tuple(got) == (round(640 * 0.04), round(361 * 0.5), round(640 * 0.96), round(361 * 0.94))


def test_thinning_and_nominal_times(spark):
    rng = random.Random(3)
    times = sorted({round(rng.uniform(0, 90), 1) for _ in range(80)})
    want, last = [], None
    for t in times:
        if 5 <= t <= 80 and (last is None or t - last >= 4.0):
            want.append(t)
            last = t
    df = spark.createDataFrame([("v", t) for t in times], "k string, t double")
    rows = sampling.throttled(df, "k", "t", 4.0, start=5.0, end=80.0).orderBy("number")
    assert [r.time for r in rows.collect()] == want
    named = rows.withColumn("named", sampling.nominal_time("k", "number", 4.0, 5.0)).collect()
    assert [r.named for r in named] == [5.0 + 4.0 * i for i in range(len(want))]


def test_reuse_and_its_counts(spark):
    words = [0b1111, 0b1110, 0b1100, 0b1000, 0b1111, 0b1111 << 20, 0b1110]  # drifts bit by bit, returns, jumps
    df = spark.createDataFrame([("v", i, [w]) for i, w in enumerate(words)], "k string, i long, w array<long>")
    got = sampling.reuse(df, "k", "i", "w", 1 / 64)
    assert [(r.action, r.source) for r in got.orderBy("i").collect()] == [("call", 0), ("near", 0), ("near", 0), ("near", 0), ("exact", 0), ("call", 5), ("call", 6)]
    assert tuple(sampling.reuse_counts(got, "k").first()) == ("v", 7, 3, 1, 3)


def test_otsu_against_every_threshold(spark):
    rng = random.Random(6)
    counts = {b: rng.randint(0, 60) * (b < 90 or b > 160) for b in range(256)}

    def between(t):
        low, high = [(b, n) for b, n in counts.items() if b <= t], [(b, n) for b, n in counts.items() if b > t]
        w, v = sum(n for _, n in low), sum(n for _, n in high)
        return w * v * (sum(b * n for b, n in low) / w - sum(b * n for b, n in high) / v) ** 2 if w and v else -1.0

    best = max(range(256), key=lambda t: (round(between(t), 3), -t))
    df = spark.createDataFrame([("a", b, n) for b, n in counts.items() if n] + [("one", 3, 7)], "k string, bin long, count long")
    got = {r.k: r.threshold for r in geometry.otsu(df, ["k"]).collect()}
    assert got["one"] == 128 and between(got["a"]) == pytest.approx(between(best))


def test_files_around_a_video(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, size in (("a.MP4", 3), ("in/b.webm", 1), ("c.mov", 0), ("d.txt", 9)):
        (tmp_path / name).write_bytes(b"x" * size)
    assert sorted(r.path.rsplit("/", 1)[1] for r in media.find_videos(spark, str(tmp_path)).collect()) == ["a.MP4", "b.webm"]
    info = [("k", "z.info.json", '{"title":"Late","id":"2"}'), ("k", "a.info.json", "oops"), ("k", "b.info.json", '{"title":"Used","id":"1","x":{}}'), ("k", "b.json", "{}")]
    assert [tuple(r) for r in media.info_metadata(spark.createDataFrame(info, "key string, path string, content string"), "key").collect()] == [("k", "Used", "1")]
    probes = ['{"streams":[{"width":1920,"height":"1080"}],"format":{"duration":"12.5"}}', '{"streams":[]}', "no", None]
    got = media.probed(spark.createDataFrame([(p,) for p in probes], "probe string")).select("width", "height", "duration").collect()
    assert [tuple(r) for r in got] == [(1920, 1080, 12.5), *[(None, None, None)] * 3]
    one, two = (spark.createDataFrame(x, "k string, path string") for x in ([("a", "a.srt")], [("a", "a.mp4"), ("b", "b.mp4")]))
    assert sorted(tuple(r) for r in media.fetch_result(one, two, "k").collect()) == [("a", "a.srt", "subtitle_track"), ("b", "b.mp4", "video")]


def test_a_fetch_is_repeated_only_if_told_to_slow_down():
    for error, times, slept in (("status 412", 3, [2, 4]), ("no route", 1, [])):
        waits, calls = [], []

        def fetch(error=error, calls=calls):
            calls.append(1)
            raise OSError(error)

        with pytest.raises(OSError):
            media.with_retries(fetch, waits.append)
        assert (len(calls), waits) == (times, slept)


def test_shapes_of_what_engines_return():
    class Answer:
        boxes, txts, scores = [[[0, 0]], [[1, 1]]], ("a", "b"), [0.5, 0.75]

    rows = [([[0, 0]], "a", 0.5), ([[1, 1]], "b", 0.75)]
    empty = type("Empty", (), {"boxes": None, "txts": None, "scores": None})()
    columns = [[r[i] for r in rows] for i in range(3)]
    for raw in (Answer(), columns, (columns, 0.1), [list(r) for r in rows], ([list(r) for r in rows], [0.1])):
        assert media.lines_of(raw) == rows
    assert [media.lines_of(x) for x in (None, (None, 0.1), [], "text", 7, empty)] == [[]] * 6


def test_passes_over_pictures(spark):
    class Reader:
        name = "reader"

        def recognize(self, image):
            said = {b"good": ("a clear long line", 0.95), b"weak": ("weak", 0.6), b"weak+": ("weak but longer", 0.9), b"lost": ("l", 0.2), b"lost+": ("lo", 0.3), b"lost#": ("lost and found", 0.8)}
            words, score = said[image]
            return [[[[0, 90], [99, 90], [99, 99], [0, 99]], words, score]]

    shots = [("v", i, bytearray(x), 100.0, 100.0) for i, x in enumerate((b"good", b"weak", b"lost"))]
    df = spark.createDataFrame(shots, "k string, i long, content binary, width double, height double")
    plain = media.recognised(df.where("i = 0"), "k", "i", Reader).first()
    assert (plain.lines[0].text, plain.lines[0].confidence) == ("a clear long line", 0.95)
    got = media.recognised_adaptively(df, "k", "i", Reader, lambda x: x + b"+", lambda x: x + b"#").orderBy("i").collect()
    assert [(r.text, r.variant, r.ocr_calls) for r in got] == [("a clear long line", "base", 1), ("weak but longer", "enhanced", 2), ("lost and found", "binary", 3)]
