"""Grouping, choosing, joining and clipping: examples of each rule, and the whole of it against a plain model."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

import pytest
from capstream.functions import scoring, similarity, text
from capstream.operators import captions
from pyspark.sql import functions as F

from tests import model

COLUMNS = "output_key string, time double, text string, confidence double, quality double"


def samples(spark, rows, video="film"):
    return spark.createDataFrame([(video, float(t), x, c, q) for t, x, c, q in rows], COLUMNS)


def made(spark, rows, **kw):
    found = captions.assemble(samples(spark, rows), **kw).orderBy("segment_id").collect()
    return [(r.start, r.end, r.text, r.reconstruction) for r in found]


def test_a_caption_that_is_typed_out_becomes_one_segment(spark):
    rows = [(30, "Der Zug", 0.95, 0.8), (33, "Der Zug nach Norden", 0.9, 0.82), (36, "Der Zug nach Norden fährt", 0.7, 0.75), (39, "", 0.0, 0.0)]
    assert made(spark, rows) == [(30.0, 39.0, "Der Zug nach Norden fährt", "temporal_consensus")]
    assert captions.assemble(samples(spark, rows)).first().alternatives == ["Der Zug", "Der Zug nach Norden"]


def test_a_longer_text_that_is_not_credible_loses(spark):
    rows = [(0, "harbour lights", 0.9, 0.85), (3, "harbour lights l", 0.5, 0.84), (6, "harbour lights lo", 0.9, 0.6)]
    assert [x[2] for x in made(spark, rows)] == ["harbour lights"]


def test_a_rolling_caption_is_joined_once(spark):
    rows = [(9, "we walked along the ri", 0.9, 0.8), (12, "the river until dawn", 0.8, 0.8), (15, "nobody came", 0.8, 0.8)]
    assert made(spark, rows) == [(9.0, 15.0, "we walked along the river until dawn", "overlap_join"), (15.0, 18.0, "nobody came", "direct_ocr")]


def test_what_keeps_neighbours_apart(spark):
    ended = [(0, "that is that.", 0.9, 0.8), (3, "that. was all", 0.9, 0.8)]
    distant = [(0, "one two thr", 0.9, 0.8), (9, "two three", 0.9, 0.8)]
    one_letter = [(0, "blue moon", 0.9, 0.8), (3, "night sky", 0.9, 0.8)]
    for rows in (ended, distant, one_letter):
        assert len(made(spark, rows)) == 2


def test_white_space_of_any_kind_is_trimmed(spark):
    assert [x[2] for x in made(spark, [(0, "　wide blank ", 0.9, 0.8)])] == ["wide blank"]


def test_single_characters(spark):
    for confidence, kept in ((0.71, []), (0.72, ["Q"])):
        assert [x[2] for x in made(spark, [(0, "Q", confidence, 0.4)])] == kept
    stats = captions.assembly_stats(samples(spark, [(0, "Q", 0.3, 0.1), (3, "whole line", 0.9, 0.9)])).first()
    assert (stats.dropped_low_confidence_fragments, stats.overlap_joins, stats.input_samples) == (1, 0, 2)


def test_an_unreadable_frame_ends_a_group(spark):
    rows = [(0, "twice said", 0.9, 0.8), (3, "[unable to recognize]", 0.1, 0.1), (6, "twice said", 0.9, 0.8)]
    assert sorted(r.island for r in captions.islands(samples(spark, rows)).collect()) == [1, 2]


def test_ends_within_the_timeline(spark):
    found = captions.assemble(samples(spark, [(20, "nearly over", 0.9, 0.8), (50, "never shown", 0.9, 0.8)]))
    assert [(r.start, r.end) for r in captions.clamp(found, F.lit(21.5)).collect()] == [(20.0, 21.5)]


def test_close_texts_share_a_group_by_ratio_only(spark):
    rows = [(0, "the lighthouse keeper sleeps", 0.9, 0.8), (3, "the lighthouse keener sleeps", 0.9, 0.8)]
    assert len({r.island for r in captions.islands(samples(spark, rows)).collect()}) == 1
    assert len({r.island for r in captions.islands(samples(spark, rows), fuzzy=False).collect()}) == 2


WORDS = "lamp river stone cloud garden window paper song winter road bridge corner".split()


def noisy(rng, n):
    """Samples of captions that are typed out, misread, rolled, blank or ended by punctuation."""
    out, said = [], ""
    for k in range(n):
        p = rng.random()
        if p < 0.25 or not said:
            said = " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 6)))
        elif p < 0.4:
            said = said[-rng.randint(2, 9) :] + rng.choice(["", " "]) + rng.choice(WORDS)
        elif p < 0.5:
            said += rng.choice([".", "!", " " + rng.choice(WORDS)])
        shown = said if rng.random() < 0.7 else "".join(c if rng.random() > 0.06 else rng.choice("xqz") for c in said)
        shown = rng.choice(["", " ", "[unrecognized]", "x", "　"]) if rng.random() < 0.08 else shown
        out.append((3.0 * k, shown, rng.choice([0.4, 0.6, 0.75, 0.9]), rng.choice([0.3, 0.5, 0.7, 0.72, 0.9])))
    return out


@pytest.mark.parametrize(("fuzzy", "support"), [(True, True), (False, False)])
def test_assembly_against_the_model(spark, fuzzy, support):
    rng = random.Random(21)
    videos = {f"v{i}": noisy(rng, 60) for i in range(25)}
    df = spark.createDataFrame([(v, *s) for v, rows in videos.items() for s in rows], COLUMNS)
    got, stats = {}, {r.output_key: tuple(r)[1:] for r in captions.assembly_stats(df, fuzzy=fuzzy, support=support).collect()}
    for r in captions.assemble(df, fuzzy=fuzzy, support=support).orderBy("output_key", "segment_id").collect():
        got.setdefault(r.output_key, []).append((r.start, r.end, r.text, round(r.confidence, 9), r.sample_times, r.reconstruction, r.alternatives))
    joins = 0
    for v, rows in videos.items():
        want, counts = model.assembled(rows, fuzzy, support)
        assert got[v] == [(s["start"], s["end"], s["text"], round(s["confidence"], 9), s["times"], s["how"], s["others"]) for s in want]
        assert dict(zip(("input_samples", "readable_samples", "temporal_consensus_groups", "overlap_joins", "dropped_low_confidence_fragments"), counts, strict=True)) == {
            k: x for k, x in zip([c for c in captions.assembly_stats(df, fuzzy=fuzzy, support=support).columns if c != "output_key"], stats[v], strict=True)
        } if v == "v0" else sorted(stats[v]) == sorted(counts)
        joins += counts[3]
    assert joins > 20


def test_a_joined_short_middle_reaches_further_back(spark):
    """What is merged so far ends in more than the short middle segment, so runs are not cut behind it."""
    rows = [(0, "morning ha", 0.9, 0.8), (3, "haze", 0.9, 0.8), (6, "g haze lifts", 0.9, 0.8)]
    want, _ = model.assembled([(float(t), *x) for t, *x in rows])
    assert [x[2] for x in made(spark, rows)] == [s["text"] for s in want] == ["morning haze lifts"]


@pytest.mark.parametrize(("raw", "want"), [("  zwei\t\u001dWorte ", "zwei Worte"), (None, ""), ("a  b", "a b")])
def test_blanks_are_collapsed(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(text.spaced(F.col("t"))).first()[0] == want


def test_entities_named_and_numbered(spark):
    raw = "caf&eacute; &#8217;&#x41;&hearts; &amp;lt; &notanentity; <b>x</b>{pos}"
    assert spark.createDataFrame([(raw,), ("no sign",), (None,)], "t string").select(text.clean_markup(F.col("t"))).collect() == [("café ’A♥ &lt; ¬anentity; x",), ("no sign",), ("",)]


def test_overlaps_against_slices(spark):
    rng = random.Random(2)
    pairs = [("".join(rng.choice("ab ") for _ in range(rng.randint(0, 20))), "".join(rng.choice("ab ") for _ in range(rng.randint(0, 20)))) for _ in range(300)]
    got = spark.createDataFrame(pairs, "l string, r string").select("l", "r", text.overlap(F.col("l"), F.col("r")).alias("n")).collect()
    assert all(r.n == model.common(" ".join(r.l.split()), " ".join(r.r.split())) for r in got)


def test_measures_against_the_model(spark):
    raw = ["Größe 12, 光る!", "ﬀ_x", "İstanbul"[1:], "", None, "・・a", "ｱ１"]
    for r in spark.createDataFrame([(x,) for x in raw], "t string").select("t", text.comparison_key(F.col("t")).alias("k"), text.meaningful_length(F.col("t")).alias("n")).collect():
        assert (r.k, r.n) == (model.key_of(r.t), model.length(r.t))


def test_support_is_a_mean_over_all_members_in_order(spark):
    df = spark.createDataFrame([(["kite", "kits"], ["kite", "kits", "kite"]), (None, None)], "k array<string>, m array<string>")
    got = [r[0] for r in df.select(similarity.mean_ratios(F.col("k"), F.col("m"))).collect()]
    assert got == [[pytest.approx((1 + 0.75 + 1) / 3), pytest.approx((0.75 + 1 + 0.75) / 3)], None]


def test_confidence_and_quality(spark):
    kind = "l array<struct<text:string,confidence:double>>"
    df = spark.createDataFrame([([("seven77", 0.2), ("", 1.0)],), ([],)], kind)
    assert [r[0] for r in df.select(scoring.weighted_confidence(F.col("l"))).collect()] == [pytest.approx((7 * 0.2 + 1) / 8), 0.0]
    row = df.select(scoring.quality(F.lit("ab"), F.lit(0.5), F.lit(4)), scoring.quality(F.lit("?"), F.lit(1.0), F.lit(1))).first()
    assert tuple(row) == (pytest.approx(0.36 + 0.23 * 1.584962500721156 / 4 + 0.05 - 0.06), 0.0)


def test_samples_of_raw_lines_end_to_end(spark):
    kind = "output_key string, time double, lines array<struct<text:string,confidence:double,role:string>>"
    frames = [("v", 0.0, [("MARA", 0.99, "speaker_hint"), ("Come", 0.9, "dialogue"), ("closer", 0.8, "dialogue")]), ("v", 3.0, [("Come closer now", 0.7, None)]), ("v", 6.0, [("ANN", 0.9, "speaker_hint")])]
    rows = captions.samples_from_lines(spark.createDataFrame(frames, kind))
    assert [(r.text, r.confidence) for r in rows.orderBy("time").collect()] == [("Come closer", pytest.approx((4 * 0.9 + 6 * 0.8) / 10)), ("Come closer now", pytest.approx(0.7)), ("", 0.0)]
    assert [(r.start, r.end, r.text) for r in captions.assemble(rows).collect()] == [(0.0, 6.0, "Come closer now")]


def test_frames_worth_keeping(spark):
    rng = random.Random(4)
    rows = noisy(rng, 200)
    got = {r.time: r.keep for r in captions.frames_to_keep(samples(spark, rows)).collect()}
    before = None
    for t, shown, confidence, _ in rows:
        own, blank = model.key_of(shown), not (shown or "").strip()
        keep = True if before is None else False if blank and before[1] else not model.alike(before[0], own) or confidence < 0.65
        assert got[t] == keep
        before = own, blank
    assert not any(r.keep for r in captions.frames_to_keep(samples(spark, rows), mode="none").collect())


def planned(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_what_islands_and_joins_look_at_is_worked_out_once(spark):
    """No later filter repeats the choice of the text or the ratios in Python, and no lambda the measures of a whole island."""
    df = samples(spark, [(0, "lamp", 0.9, 0.8), (3, "lamp road", 0.9, 0.8)])
    assert planned(captions.assemble(df)).count("mean_ratios(") == 1
    kept = planned(captions.without_fragments(captions.segments(captions.islands(df, fuzzy=False), support=False)))
    assert kept.count("0.16") == 1 and ">= (array_max" not in kept and "= array_max" not in kept
    assert planned(captions.join_overlaps(captions.without_fragments(captions.segments(captions.islands(df))))).count("regexp_replace") < 20


def test_a_long_island_against_the_model(spark):
    """Cubic before: each sample looked at all samples for each sample."""
    rows = [(3.0 * k, "lamp road" + " river" * (k % 7), 0.6 + k % 4 / 10, 0.5 + k % 5 / 10) for k in range(400)]
    want, _ = model.assembled(rows)
    assert [x[2] for x in made(spark, rows)] == [s["text"] for s in want]


def test_only_texts_with_enough_in_common_are_compared_by_ratio(monkeypatch):
    rng = random.Random(8)
    asked = []

    class Counted(SequenceMatcher):
        def ratio(self):
            asked.append(1)
            return super().ratio()

    monkeypatch.setattr(similarity, "SequenceMatcher", Counted)
    assert (similarity.common_length("kitten", "sitting"), similarity.common_length("", "a"), similarity.common_length("aß光", "ß光a")) == (4, 0, 2)
    alike = 0
    for _ in range(600):
        a = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 300)))
        b = "".join(c if rng.random() > 0.1 * rng.random() else rng.choice("xyz") for c in a) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh") for _ in a)
        want = SequenceMatcher(None, a, b).ratio() >= 0.88
        assert similarity.reaches(a, b, 0.88) == want
        alike += want
    assert 100 < alike <= len(asked) < 400


def test_a_text_is_measured_once_for_its_scores(spark):
    from capstream.plans import catalogue

    docs = spark.createDataFrame([(1, "lamp"), (2, None), (3, "")], "doc_id long, text string")
    assert planned(catalogue._scored(docs)).count("regexp_replace") == 1
    assert [r.enhance for r in catalogue._scored(docs).orderBy("doc_id").collect()][0] is True


def test_a_row_is_measured_once_for_its_role(spark):
    from capstream.operators import geometry

    kind = "l array<struct<text:string,confidence:double,box:array<array<double>>>>"
    df = spark.createDataFrame([([("MARA", 0.9, [[15.0, 15.0], [35.0, 15.0], [35.0, 35.0], [15.0, 35.0]])],), ([],)], kind)
    roles = df.select(geometry.row_role(F.col("l"), F.lit(100.0), F.lit(100.0)).alias("r"))
    assert planned(roles).count("flatten(") == 1
    assert [r.r for r in roles.collect()] == ["speaker_hint", "unknown"]
