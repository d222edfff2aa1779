"""Registered queries over the driver tables and their DuckDB equivalents.

The tables stand in for the engine's own: turns of conversations and lines of documents for samples
of captions, embeddings for signatures, events for frame times, pages for markup and inputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capstream.functions import ids, scoring, signature, text, timecode
from capstream.operators import captions, geometry, manifest, sampling, sinks, tracks
from capstream.session import share_package
from capstream.sources import subtitles
from capstream.streaming import captions as streaming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return share_package(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _proxy_confidence(key: Column, at: Column) -> Column:
    return ((key * 13 + at * 7) % 50 + 50) / 100


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as samples."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("output_key"), (F.col("turn") * 3.0).alias("time"), "text", _proxy_confidence(F.col("conv_id"), F.col("turn")).alias("confidence"))
    return rows.withColumn("quality", scoring.quality(F.col("text"), F.col("confidence"), F.lit(1)))


def lines(spark: SparkSession, sf_dir: str, together: bool = True) -> DataFrame:
    """Lines of documents as samples; `together` shuffles the bare texts by key, so that windows need no further exchange."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("output_key"), "text")
    docs = docs.repartition("output_key") if together else docs
    rows = docs.select("output_key", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    rows = rows.select("output_key", F.col("pos").cast("long").alias("pos"), (F.col("pos") * 3.0).alias("time"), "text", _proxy_confidence(F.col("output_key"), F.col("pos")).alias("confidence"))
    return rows.withColumn("quality", scoring.quality(F.col("text"), F.col("confidence"), F.lit(1)))


# --- the same in SQL

_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def q_compact(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '{_WS}+', '', 'g')"


def q_spaced(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{_WS}+', ' ', 'g'))"


def q_trim(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def q_key(x: str) -> str:
    return rf"replace(lower(regexp_replace(coalesce({x}, ''), '[^\p{{L}}\p{{N}}]+', '', 'g')), 'ß', 'ss')"


def q_length(x: str) -> str:
    return rf"length(regexp_replace(coalesce({x}, ''), '[^A-Za-z0-9\x{{3040}}-\x{{30ff}}\x{{3400}}-\x{{9fff}}]', '', 'g'))"


def q_readable(x: str) -> str:
    return f"({q_compact(x)} not in ('', '[unrecognized]', '[unabletorecognize]'))"


def q_quality(x: str, confidence: str, n: str = "1") -> str:
    k = q_length(x)
    score = f"{confidence} * 0.72::double + least(1.0::double, log2({k} + 1.0::double) / 4.0::double) * 0.23::double + least(1.0::double, {n} / 2.0::double) * 0.05::double"
    return f"case when {k} = 0 then 0::double else greatest(0::double, least(1::double, {score} - case {k} when 1 then 0.22::double when 2 then 0.06::double else 0::double end)) end"


def q_stamp(x: str) -> str:
    ms = f"greatest(0, round_even(({x}) * 1000::double, 0)::bigint)"
    return f"printf('%02d:%02d:%02d,%03d', {ms} // 3600000, {ms} // 60000 % 60, {ms} // 1000 % 60, {ms} % 1000)"


def q_clean(x: str) -> str:
    y = f"replace(replace(coalesce({x}, ''), '\\N', chr(10)), '\\n', chr(10))"
    y = rf"regexp_replace(regexp_replace({y}, '\{{[^}}]*\}}', '', 'g'), '<[^>]+>', '', 'g')"
    for pattern, plain in (("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;|&apos;", "\'\'"), ("&nbsp;?", chr(160)), ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&")):  # those of the tables
        y = f"regexp_replace({y}, '{pattern}', '{plain}', 'g')"
    parts = rf"string_split_regex({y}, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]')"
    return f"array_to_string(list_filter(list_transform({parts}, lambda l: {q_spaced('l')}), lambda l: l != ''), chr(10))"


Q_TURNS = f"""turns as (select *, {q_quality("text", "confidence")} as quality from (
    select conv_id as output_key, turn * 3.0::double as time, text, ((conv_id * 13 + turn * 7) % 50 + 50) / 100 as confidence from conversations))"""
Q_LINES = f"""lines as (select *, {q_quality("text", "confidence")} as quality from (
    select doc_id as output_key, pos, pos * 3.0::double as time, line as text, ((doc_id * 13 + pos * 7) % 50 + 50) / 100 as confidence from (
        select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents)))"""


def q_islands(source: str) -> str:
    """CTEs ending in islands(output_key, time, text, confidence, quality, k, island)."""
    same = "b != '' and k != '' and (b = k or contains(k, b) or contains(b, k))"
    return f"""keyed as (select *, case when {q_readable("text")} then {q_key("text")} end as k from {source}),
    before as (select *, lag(k) over (partition by output_key order by time) as b from keyed),
    islands as (select *, sum(case when coalesce({same}, false) then 0 else 1 end) over (partition by output_key order by time rows unbounded preceding)::bigint as island
                from before where k is not null)"""


_CREDIBLE = "(confidence >= 0.55::double and quality >= best - 0.16::double)"
Q_CHOSEN = f"""ranked as (select *, {q_length("text")} as n, max(quality) over (partition by output_key, island) as best from islands),
    chosen as (select output_key, island, text as best_text from (select *, row_number() over (partition by output_key, island order by {_CREDIBLE} desc,
        case when {_CREDIBLE} then n::double else quality * 0.65::double + confidence * 0.35::double end desc,
        case when {_CREDIBLE} then 0::double else n::double end desc, case when {_CREDIBLE} then quality else confidence end desc, time) as place from ranked) where place = 1)"""
Q_SEGMENTS = f"""{Q_CHOSEN},
    spans as (select output_key, island, min(time) as start, max(time) + 3.0::double as stop, avg(confidence) as confidence, count(*) as n_samples from islands group by all),
    segments as (select s.*, {q_trim("best_text")} as text from spans s join chosen using (output_key, island))"""


# --- text


@query(f"select doc_id, length({q_compact('text')}) as n_compact, length({q_spaced('text')}) as n_spaced, length({q_key('text')}) as n_key, {q_length('text')}::bigint as n_meaningful, sha256({q_key('text')}) as key_sha256 from documents")
def text_measures(spark, sf_dir):
    t = F.col("text")
    n = lambda c: F.length(c).cast("long")
    key = F.transform(F.array(text.comparison_key(t)), lambda k: F.struct(n(k).alias("n_key"), F.sha2(k, 256).alias("key_sha256")))[0]  # made once
    rows = table(spark, sf_dir, "documents").select("doc_id", n(text.compact(t)).alias("n_compact"), n(text.spaced(t)).alias("n_spaced"), text.meaningful_length(t).alias("n_meaningful"), key.alias("k"))
    return rows.select("doc_id", "n_compact", "n_spaced", "k.n_key", "n_meaningful", "k.key_sha256")


@query(f"select page_id, length({q_clean('html')}) as n_chars, sha256({q_clean('html')}) as text_sha256 from pages")
def clean_markup(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", text.clean_markup(F.col("html")).alias("t"))
    return rows.select("page_id", F.length("t").cast("long").alias("n_chars"), F.sha2("t", 256).alias("text_sha256"))


@query(f"""with {Q_LINES} select output_key, count(*) as n_lines, count(*) filter ({q_compact("text")} != '' and not regexp_full_match({q_compact("text")},
    '[\\s♪♫♬【】\\[\\]()<>\\-_.:：,，]*(music|bgm|soundtrack|instrumental|音乐|纯音乐|音效)[\\s♪♫♬【】\\[\\]()<>\\-_.:：,，]*', 'i')) as n_dialogue from lines group by output_key""")
def dialogue_filter(spark, sf_dir):
    return lines(spark, sf_dir, together=False).groupBy("output_key").agg(F.count("*").alias("n_lines"), F.count_if(text.is_dialogue(F.col("text"))).alias("n_dialogue"))


@query("select page_id, trim(url) as title from pages")
def title_extract(spark, sf_dir):
    log = F.concat(F.lit("started\nTITLE： "), F.col("url"), F.lit(" \n[P1]other"))
    return table(spark, sf_dir, "pages").select("page_id", text.extract_title(log).alias("title"))


@query(f"""with {Q_LINES}, p as (select output_key, pos, {q_spaced("text")} as r, lag({q_spaced("text")}) over (partition by output_key order by pos) as l from lines)
    select output_key, pos, coalesce(list_max(list_filter(range(1, 13), lambda n: n <= least(length(l), length(r)) and right(l, n) = left(r, n))), 0)::bigint as overlap from p where l is not null""")
def overlap_pairs(spark, sf_dir):
    ends = [text.tail(F.col("text"), text.OVERLAP_WINDOW).alias("end"), text.head(F.col("text"), text.OVERLAP_WINDOW).alias("start")]  # all that a shuffle need move
    rows = lines(spark, sf_dir).select("output_key", "pos", *ends)
    rows = rows.withColumn("before", F.lag("end").over(Window.partitionBy("output_key").orderBy("pos"))).where("before is not null")
    return rows.select("output_key", "pos", text.overlap_of(F.col("before"), F.col("start")).alias("overlap"))


@query("select doc_id, list_unique(list_filter(string_split(text, chr(10)), lambda l: l != ''))::bigint as n_unique from documents")
def unique_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(text.first_occurrences(F.split("text", "\n"))).cast("long").alias("n_unique"))


# --- ids, times, settings

_MADE = "case page_id % 4 when 0 then 'BV' || substr(md5(page_id::varchar), 1, 10) when 1 then 'av' || page_id when 2 then url else 'https://b23.tv/' || page_id end"


@query(f"""with i as (select page_id, {_MADE} as v from pages)
    select page_id, case page_id % 4 when 0 then 'https://www.bilibili.com/video/' || v || '/' when 1 then 'https://www.bilibili.com/video/' || v || '/' when 3 then v end as url,
           case page_id % 4 when 0 then v when 1 then v when 3 then 'url-' || substr(sha256(v), 1, 12) end as output_key,
           case page_id % 4 when 2 then 'URL must use a supported host' end as error from i""")
def input_resolve(spark, sf_dir):
    page = F.col("page_id")
    made = F.when(page % 4 == 0, F.concat(F.lit("BV"), F.substring(F.md5(page.cast("string")), 1, 10))).when(page % 4 == 1, F.concat(F.lit("av"), page)).when(page % 4 == 2, F.col("url")).otherwise(F.concat(F.lit("https://b23.tv/"), page))
    return table(spark, sf_dir, "pages").select("page_id", ids.resolve(made).alias("r")).select("page_id", "r.url", "r.output_key", "r.error")


@query("select page_id, url as value from pages union all select page_id, 'av' || page_id from pages")
def input_list(spark, sf_dir):
    raw = F.concat(F.lit("1. "), "url", F.lit(", av"), F.col("page_id"), F.lit("\n(2) "), "url", F.lit(" 17\n3) av"), F.col("page_id"))
    return ids.parse_inputs(table(spark, sf_dir, "pages").select("page_id", raw.alias("raw")), "raw", ("page_id",)).select("page_id", "value")


@query(f"""with s as (select event_id, {q_stamp("value")} as stamp from events)
    select event_id, stamp, replace(stamp, ',', '.') as display, round(substr(stamp, 1, 2)::int * 3600 + substr(stamp, 4, 2)::int * 60 + replace(substr(stamp, 7), ',', '.')::double, 6) as seconds from s""")
def timecode_roundtrip(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "value", timecode.srt_timestamp(F.col("value")).alias("stamp"))
    return rows.select("event_id", "stamp", timecode.display_timestamp(F.col("value")).alias("display"), F.round(timecode.parse_timecode(F.col("stamp")), 6).alias("seconds"))


_CONFIG = '{"config":{"adaptive_ocr_confidence":0.78,"crop":{"bottom":0.94,"left":0.04,"right":0.96,"top":0.5},"enable_hardsub_ocr":true,"end_time":null,"frame_similarity_threshold":0.018,"max_frame_width":1280,"prefer_subtitle_track":true,"sample_interval_seconds":3.0,"start_time":null},"pipeline_version":"3.0.0","schema_version":3,"source_key":"'


@query(f"select distinct conv_id, sha256('{_CONFIG}av' || conv_id || '\"}}') as fingerprint, substr(sha256('av' || conv_id || '|3.0|None|None|3'), 1, 16) as short from conversations")
def cfg_fingerprint(spark, sf_dir):
    key = F.concat(F.lit("av"), F.col("conv_id"))
    none = F.lit(None).cast("double")
    rows = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    return rows.select("conv_id", manifest.fingerprint(manifest.Settings(), key).alias("fingerprint"), manifest.short_fingerprint(key, F.lit("3.0"), none, none).alias("short"))


@query("select o_orderkey from orders o where not exists (select 1 from orders m where m.o_orderkey = o.o_orderkey and m.o_orderstatus = 'F' and m.o_orderpriority = o.o_orderpriority and m.o_orderkey % 3 != 0)")
def incremental_skip(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    status = F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 3 != 0), "success").otherwise("failed")
    known = rows.select(F.col("o_orderkey").alias("output_key"), F.col("o_orderpriority").alias("fingerprint"), status.alias("status"))
    return manifest.pending(known.drop("status"), known).select(F.col("output_key").alias("o_orderkey"))


@query("select count(*) as processed, count(*) filter (value > 10) as successful, count(*) filter (value > 10 and event_id % 5 = 0) as cached, count(*) filter (value is null or value <= 10) as failed, count(*) filter (value > 10) > 0 as ok from events")
def run_summary(spark, sf_dir):
    return sinks.summary(table(spark, sf_dir, "events").select((F.col("value") > 10).alias("success"), (F.col("event_id") % 5 == 0).alias("skipped")))


# --- scores


@query(f"""select doc_id, round({q_quality("text", "c", "(doc_id % 3 + 1)")}, 6) as quality, (coalesce(text, '') = '' or {q_length("text")} < 4 or c < 0.78 or {q_quality("text", "c", "(doc_id % 3 + 1)")} < 0.68) as enhance,
    (coalesce(text, '') = '' or {q_length("text")} <= 1 or c < 0.58 or {q_quality("text", "c", "(doc_id % 3 + 1)")} < 0.5) as binary_pass from (select doc_id, text, (doc_id * 13 % 50 + 50) / 100 as c from documents)""")
def quality_score(spark, sf_dir):
    return _scored(table(spark, sf_dir, "documents"))


def _scored(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "text", ((F.col("doc_id") * 13 % 50 + 50) / 100).alias("c"))
    t, c = F.col("text"), F.col("c")

    def judged(n: Column, q: Column) -> Column:
        return F.struct(F.round(q, 6).alias("quality"), scoring.needs_enhancement(t, c, q, n=n).alias("enhance"), scoring.needs_binary_pass(t, c, q, n).alias("binary_pass"))

    # the text is measured once
    all_ = text.once(text.meaningful_length(t), lambda n: text.once(scoring.quality_of(n, c, F.col("doc_id") % 3 + 1), lambda q: judged(n, q)))
    return rows.select("doc_id", all_.alias("s")).select("doc_id", "s.quality", "s.enhance", "s.binary_pass")


@query(f"with {Q_LINES} select output_key, round(sum(confidence * greatest(1, {q_length('text')})) / sum(greatest(1, {q_length('text')})), 6) as confidence from lines group by output_key")
def weighted_conf(spark, sf_dir):
    weight = scoring.weight(F.col("text"))  # over rows it is a plain ratio of sums, which is added up before the shuffle
    return lines(spark, sf_dir, together=False).groupBy("output_key").agg(F.round(F.sum(F.col("confidence") * weight) / F.sum(weight), 6).alias("confidence"))


@query(f"with {Q_LINES} select output_key, pos from lines where {q_length('text')} = 0 or ({q_length('text')} = 1 and confidence < 0.72)")
def drop_fragments(spark, sf_dir):
    return lines(spark, sf_dir, together=False).where(scoring.is_fragment(F.col("text"), F.col("confidence"))).select("output_key", "pos")


_RANK = f"quality + least({q_length('text')}, 12) * 0.008::double desc, {q_length('text')} desc, confidence desc, pos"


@query(f"with {Q_LINES} select output_key, frame, pos from (select *, pos // 3 as frame, row_number() over (partition by output_key, pos // 3 order by {_RANK}) as place from lines) where place = 1")
def adaptive_best(spark, sf_dir):
    rows = lines(spark, sf_dir).withColumn("frame", F.floor(F.col("pos") / 3))
    return geometry.best_pass(rows, ["output_key", "frame"], "pos").select("output_key", "frame", "pos")


# --- tracks

_NAME = "lower(lang || '.' || source || '.srt')"
_PRIORITY = f"case when regexp_matches({_NAME}, 'zh|chi|chs|cht|中文') and not regexp_matches({_NAME}, 'ai|auto|asr|自动') then 0 when regexp_matches({_NAME}, 'zh|chi|chs|cht|中文') then 1 when regexp_matches({_NAME}, 'ja|jp|jpn|日文') then 2 else 3 end"


@query(f"select doc_id, ({_PRIORITY})::bigint as priority, row_number() over (partition by doc_id % 50 order by {_PRIORITY}, n_chars desc, {_NAME}, doc_id) as place from (select *, replace(replace(lang, 'en', 'zh.ai'), 'de', 'ja') as lang from (select doc_id, lang, source, n_chars from documents)) t(doc_id, lang0, source, n_chars, lang)")
def track_rank(spark, sf_dir):
    lang = F.replace(F.replace("lang", F.lit("en"), F.lit("zh.ai")), F.lit("de"), F.lit("ja"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars", (F.col("doc_id") % 50).alias("video"), F.concat_ws(".", lang, "source", F.lit("srt")).alias("name"))
    return tracks.rank(rows, "video", "name", "n_chars", "doc_id").select("doc_id", "priority", "place")


# --- captions


@query(f"with {Q_LINES}, {q_islands('lines')} select output_key, island, min(time) as start, max(time) + 3.0::double as stop, count(*) as n_samples from islands group by output_key, island")
def caption_islands(spark, sf_dir):
    return captions.islands(lines(spark, sf_dir), fuzzy=False).groupBy("output_key", "island").agg(F.min("time").alias("start"), (F.max("time") + 3.0).alias("stop"), F.count("*").alias("n_samples"))


@query()
def caption_islands_fuzzy(spark, sf_dir):
    return captions.islands(lines(spark, sf_dir)).groupBy("output_key", "island").agg(F.min("time").alias("start"), F.count("*").alias("n_samples"))


@query(f"with {Q_LINES}, {q_islands('lines')}, {Q_SEGMENTS} select output_key, island, text, round(confidence, 6) as confidence, n_samples from segments")
def whole_sentence(spark, sf_dir):
    found = captions.segments(captions.islands(lines(spark, sf_dir), fuzzy=False), support=False)
    return found.select("output_key", "island", "text", F.round("confidence", 6).alias("confidence"), F.size("sample_times").cast("long").alias("n_samples"))


@query()
def group_support(spark, sf_dir):
    return captions.segments(captions.islands(lines(spark, sf_dir))).select("output_key", "island", "text", "reconstruction")


@query(f"""with {Q_LINES}, {q_islands("lines")}, {Q_CHOSEN}, firsts as (select output_key, island, text, min(time) as t from islands where text != '' group by all)
    select output_key, island, string_agg(text, '|' order by t) as alternatives, count(*) as n from firsts join chosen using (output_key, island) where text != best_text group by output_key, island""")
def alternatives(spark, sf_dir):
    found = captions.segments(captions.islands(lines(spark, sf_dir), fuzzy=False), support=False).where(F.size("alternatives") > 0)
    return found.select("output_key", "island", F.array_join("alternatives", "|").alias("alternatives"), F.size("alternatives").cast("long").alias("n"))


_GONE = f"({q_length('text')} = 0 or ({q_length('text')} = 1 and confidence < 0.72))"


def q_fold() -> str:
    """The joins one after another: parts, then done(output_key, segment_id, start, stop, text, how, mean, n)."""
    n = "coalesce(list_max(list_filter(range(1, 13), lambda i: i <= least(length(l), length(r)) and right(l, i) = left(r, i))), 0)"
    return f"""parts as (select output_key, row_number() over (partition by output_key order by start) as nr, start, stop, text, confidence, n_samples,
        case when n_samples > 1 then 'temporal_consensus' else 'direct_ocr' end as how from segments where not {_GONE}),
    fold as (select output_key, nr, 1::bigint as segment_id, start, stop, text, how, confidence as mean, n_samples as n from parts where nr = 1
        union all select output_key, nr, segment_id + (not fits)::bigint, case when fits then l_start else start end, stop, case when fits then merged else text end,
               case when fits then 'overlap_join' else how end, case when fits then (l_mean * l_n + confidence * n_samples) / (l_n + n_samples) else confidence end, case when fits then l_n + n_samples else n_samples end
        from (select *, coalesce(start - l_stop <= 1.5::double and not regexp_matches(regexp_replace(l_text, '{_WS}+$', ''), '[.!?。！？…]$') and i >= 2 and merged not in (l, r), false) as fits
              from (select *, l || substr(r, i + 1) as merged from (select *, {n} as i from (
                    select p.*, f.segment_id, f.start as l_start, f.stop as l_stop, f.text as l_text, f.mean as l_mean, f.n as l_n, {q_spaced("f.text")} as l, {q_spaced("p.text")} as r
                    from fold f join parts p on p.output_key = f.output_key and p.nr = f.nr + 1))))),
    done as (select output_key, segment_id, min(start) as start, arg_max(stop, nr) as stop, arg_max(text, nr) as text, arg_max(how, nr) as how, arg_max(mean, nr) as mean, arg_max(n, nr) as n from fold group by output_key, segment_id)"""




@query(f"""with recursive {Q_LINES}, {q_islands("lines")}, {Q_SEGMENTS}, {q_fold()} select output_key, segment_id, start, stop as "end", text, how as reconstruction from done""")
def overlap_fold(spark, sf_dir):
    kept = captions.without_fragments(captions.segments(captions.islands(lines(spark, sf_dir), fuzzy=False), support=False))
    return captions.join_overlaps(kept).select("output_key", "segment_id", "start", "end", "text", "reconstruction")


@query(f"with {Q_LINES}, {q_islands('lines')}, {Q_SEGMENTS} select output_key, start, least(stop, lead(start) over (partition by output_key order by start)) as stop, text from segments where not {_GONE}")
def end_clip(spark, sf_dir):
    found = captions.without_fragments(captions.segments(captions.islands(lines(spark, sf_dir), fuzzy=False), support=False))
    return captions.clip_ends(found).select("output_key", "start", F.col("end").alias("stop"), "text")


@query(f"with {Q_LINES}, {q_islands('lines')}, {Q_SEGMENTS} select output_key, start, least(stop, 20::double) as stop from segments where least(stop, 20::double) > start")
def clamp_ends(spark, sf_dir):
    found = captions.segments(captions.islands(lines(spark, sf_dir), fuzzy=False), support=False)
    return captions.clamp(found, F.lit(20.0)).select("output_key", "start", F.col("end").alias("stop"))


@query(f"""with {Q_TURNS}, {q_islands("turns")}, {Q_SEGMENTS}, kept as (select *, least(stop, lead(start) over (partition by output_key order by start)) as until from segments where not {_GONE})
    select output_key, row_number() over (partition by output_key order by start) as segment_id, {q_stamp("start")} as start, {q_stamp("until")} as stop, text, round(confidence, 6) as confidence from kept""")
def caption_timeline(spark, sf_dir):
    """The flagship: samples, islands, whole sentences, fragments dropped, ends clipped, time stamps."""
    found = captions.segments(captions.islands(turns(spark, sf_dir), fuzzy=False), support=False)
    rows = captions.clip_ends(captions.without_fragments(found))
    number = F.row_number().over(Window.partitionBy("output_key").orderBy("start")).cast("long")
    return rows.select("output_key", number.alias("segment_id"), timecode.srt_timestamp(F.col("start")).alias("start"), timecode.srt_timestamp(F.col("end")).alias("stop"), "text", F.round("confidence", 6).alias("confidence"))


@query()
def assembly(spark, sf_dir):
    return captions.assemble(lines(spark, sf_dir)).select("output_key", "segment_id", "start", "end", "text", F.round("confidence", 6).alias("confidence"), "reconstruction")


@query(f"""with recursive {Q_LINES}, {q_islands("lines")}, {Q_SEGMENTS}, {q_fold()}
    select output_key, segment_id, start, least(stop, lead(start) over (partition by output_key order by start)) as "end", text, round(mean, 6) as confidence, how as reconstruction from done""")
def assembly_plain(spark, sf_dir):
    """As assembly, but for what SQL has no words for: groups by equality and containment, candidates without support."""
    found = captions.assemble(lines(spark, sf_dir), fuzzy=False, support=False)
    return found.select("output_key", "segment_id", "start", "end", "text", F.round("confidence", 6).alias("confidence"), "reconstruction")


@query(f"""with recursive {Q_LINES}, {q_islands("lines")}, {Q_SEGMENTS}, {q_fold()},
    seen as (select output_key, count(*) as input_samples, count(*) filter ({q_readable("text")}) as readable_samples from lines group by output_key),
    made as (select output_key, count(*) filter (not {_GONE} and n_samples > 1) as groups, count(*) filter (not {_GONE}) as kept, count(*) filter ({_GONE}) as gone from segments group by output_key),
    last as (select output_key, count(*) as n from done group by output_key)
    select output_key, input_samples, readable_samples, coalesce(groups, 0) as temporal_consensus_groups, coalesce(kept, 0) - coalesce(n, 0) as overlap_joins, coalesce(gone, 0) as dropped_low_confidence_fragments
    from seen left join made using (output_key) left join last using (output_key)""")
def assembly_stats_plain(spark, sf_dir):
    return captions.assembly_stats(lines(spark, sf_dir), fuzzy=False, support=False)


@query()
def assembly_stats(spark, sf_dir):
    return captions.assembly_stats(lines(spark, sf_dir))


@query(f"""with {Q_LINES}, k as (select *, {q_key("text")} as k, {q_spaced("text")} = '' as blank from lines),
    b as (select *, lag(k) over w as b, lag(blank) over w as was_blank from k window w as (partition by output_key order by time))
    select output_key, pos, case when was_blank is null then true when blank and was_blank then false
           else not (b != '' and k != '' and (b = k or contains(k, b) or contains(b, k))) or confidence < 0.65 end as keep from b""")
def frame_keep(spark, sf_dir):
    return captions.frames_to_keep(lines(spark, sf_dir), fuzzy=False).select("output_key", "pos", "keep")


@query()
def frame_keep_fuzzy(spark, sf_dir):
    """The whole rule, near-equal neighbours being unchanged; SQL has no ratio, so frame_keep goes without."""
    return captions.frames_to_keep(lines(spark, sf_dir)).select("output_key", "pos", "keep")


# --- frames


@query("""with recursive e as (select user_id, epoch_us(ts) / 1e6::double as t from events),
    r as (select user_id, 0::bigint as number, min(t) as time from e group by user_id
          union all select r.user_id, r.number + 1, min(e.t) from r join e on e.user_id = r.user_id and e.t - r.time >= 86400 group by r.user_id, r.number)
    select user_id, number, time from r""")
def throttle_sample(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"))
    return sampling.throttled(rows, "user_id", "t", 86400.0).select("user_id", F.col("number").cast("long").alias("number"), "time")


@query("""with h as (select event_type, least(255, greatest(0, floor(value)))::bigint as bin, count(*) as n from events where value is not null group by all),
    c as (select *, sum(n) over w as w, sum(n * bin) over w as s, sum(n) over (partition by event_type) as total, sum(n * bin) over (partition by event_type) as t from h window w as (partition by event_type order by bin rows unbounded preceding)),
    v as (select event_type, bin, w::double * (total - w)::double * (s::double / w::double - (t - s)::double / (total - w)::double) * (s::double / w::double - (t - s)::double / (total - w)::double) as v from c where total > w)
    select event_type, bin as threshold from (select *, row_number() over (partition by event_type order by v desc, bin) as place from v) where place = 1""")
def otsu(spark, sf_dir):
    bins = table(spark, sf_dir, "events").where("value is not null").select("event_type", F.least(F.lit(255), F.greatest(F.lit(0), F.floor("value"))).cast("long").alias("bin"))
    return geometry.otsu(bins.groupBy("event_type", "bin").agg(F.count("*").alias("count")), ["event_type"])


def _words(column: Column) -> Column:
    """Signs of all components, 64 to a word."""

    def word(k: Column) -> Column:
        bits = F.transform(F.slice(column, k * 64 + 1, F.lit(64)), lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
        return F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))

    return F.when(F.size(column) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(column) - 1) / 64).cast("int")), word)).when(F.size(column) == 0, F.array().cast("array<long>"))


#: So many ids in a block of _with_before.
_IDS = 1 << 16


def _with_before(rows: DataFrame, key: str, value: str) -> DataFrame:
    """rows with b, the value of the row before in the order of the key: lag, by blocks of keys.

    Only the last value of each block comes together to be handed to the next block's first row.
    """
    rows = rows.withColumn("_block", F.floor(F.col(key) / _IDS))
    order = Window.partitionBy("_block").orderBy(F.asc_nulls_last(key))
    rows = rows.withColumn("_place", F.row_number().over(order)).withColumn("_own", F.lag(value).over(order))
    last = rows.groupBy("_block").agg(F.max_by(value, "_place").alias("_last"))
    last = last.withColumn("_last", F.lag("_last").over(Window.orderBy(F.asc_nulls_last("_block"))))
    both = rows.join(last.withColumnRenamed("_block", "_of"), F.col("_block").eqNullSafe(F.col("_of")))
    return both.withColumn("b", F.when(F.col("_place") == 1, F.col("_last")).otherwise(F.col("_own"))).drop("_block", "_of", "_place", "_own", "_last")


_BITS = "list_transform(embedding, lambda x: (x > 0)::int)"


@query(f"""with s as (select vec_id, {_BITS} as w from embeddings), p as (select vec_id, w, lag(w) over (order by vec_id) as b from s),
    d as (select vec_id, list_sum(list_transform(range(1, len(w) + 1), lambda i: abs(w[i] - b[i])))::double / (ceil(len(w) / 64) * 64) as distance from p where b is not null)
    select vec_id, distance, distance <= 0.375 as similar from d""")
def hamming_neighbors(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", _words(F.col("embedding")).alias("w"))
    both = _with_before(rows, "vec_id", "w").where("b is not null")
    return both.select("vec_id", signature.distance(F.col("b"), F.col("w")).alias("distance"), signature.similar(F.col("b"), F.col("w"), 0.375).alias("similar"))


@query("select doc_id, first_value(doc_id) over (partition by source, md5(text) order by doc_id) as used from documents")
def exact_reuse(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", F.md5("text").alias("code"))
    return sampling.exact_reuse(rows, "source", "doc_id", "code").select("doc_id", "used")


@query(f"""with recursive s as (select label as video, vec_id, list_aggregate({_BITS}, 'string_agg', '') as w, row_number() over (partition by label order by vec_id) as nr from embeddings),
    r as (select video, vec_id, nr, 'call' as action, vec_id as source, [w] as codes, [vec_id] as firsts, w as before from s where nr = 1
        union all select video, vec_id, nr, action, case action when 'exact' then firsts[list_position(codes, w)] when 'near' then source else vec_id end,
               case action when 'call' then list_append(codes, w) else codes end, case action when 'call' then list_append(firsts, vec_id) else firsts end, w
        from (select s.*, r.codes, r.firsts, r.source, case when list_contains(r.codes, s.w) then 'exact' when hamming(s.w, r.before) / (ceil(length(s.w) / 64) * 64)::double <= 0.25 then 'near' else 'call' end as action
              from r join s on s.video is not distinct from r.video and s.nr = r.nr + 1))
    select video, vec_id, action, source from r""")
def reuse_chain(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(F.col("label").alias("video"), "vec_id", _words(F.col("embedding")).alias("words"))
    return sampling.reuse(rows, "video", "vec_id", "words", 0.25)


@query()
def signature_names(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", signature.signature_hex(_words(F.col("embedding"))).alias("signature"))


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("l_partkey") % 80 * 1.0, F.col("l_suppkey") % 70 * 1.0
    box = F.array(*[F.array(a, b) for a, b in ((x, y), (x + 20.0, y), (x + 20.0, y + 20.0), (x, y + 20.0))])
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.struct(F.concat("l_returnflag", F.col("l_linenumber")).alias("text"), F.col("l_discount").alias("confidence"), box.alias("box")).alias("line"))


_INSIDE = " or ".join(f"(gl >= {lo} - 0.025 and gr <= {hi} + 0.025 and gt >= {t} - 0.025 and gb <= {b} + 0.025)" for t, b, lo, hi in geometry.SPEAKER_REGIONS.values())


@query(f"""with b as (select l_orderkey, l_linenumber, (l_partkey % 80)::double as x, (l_suppkey % 70)::double as y from lineitem),
    g as (select *, 0.04::double + x / 100 * (0.96::double - 0.04::double) as gl, 0.04::double + (x + 20) / 100 * (0.96::double - 0.04::double) as gr, 0.5::double + y / 100 * (0.94::double - 0.5::double) as gt, 0.5::double + (y + 20) / 100 * (0.94::double - 0.5::double) as gb from b)
    select l_orderkey, l_linenumber, case when {_INSIDE} then 'speaker_hint' else 'dialogue' end as role from g""")
def row_role(spark, sf_dir):
    return _boxes(spark, sf_dir).select("l_orderkey", "l_linenumber", geometry.row_role(F.array("line"), F.lit(100.0), F.lit(100.0)).alias("role"))


@query()
def row_clusters(spark, sf_dir):
    rows = _boxes(spark, sf_dir).groupBy("l_orderkey").agg(F.collect_list("line").alias("lines"))
    found = geometry.candidate(rows.withColumn("width", F.lit(100.0)).withColumn("height", F.lit(100.0)))
    return found.select("l_orderkey", "text", F.round("confidence", 6).alias("confidence"), F.round("quality", 6).alias("quality"), F.size("lines").alias("n_lines"))


# --- formats

_SRT = f"string_agg(turn + 1 || chr(10) || {q_stamp('turn * 3.0::double')} || ' --> ' || {q_stamp('turn * 3.0::double + 3')} || chr(10) || {q_spaced('text')} || chr(10), chr(10) order by turn)"


def _spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return rows.select(F.col("conv_id").alias("output_key"), (F.col("turn") + 1).alias("segment_id"), (F.col("turn") * 3.0).alias("start"), (F.col("turn") * 3.0 + 3).alias("end"), text.spaced(F.col("text")).alias("text"))


@query(f"select conv_id as output_key, length(d) as n_chars, sha256(d) as document_sha256 from (select conv_id, rtrim({_SRT}, chr(10) || ' ') || chr(10) as d from conversations group by conv_id)")
def srt_format(spark, sf_dir):
    return sinks.srt(_spoken(spark, sf_dir)).select("output_key", F.length("document").cast("long").alias("n_chars"), F.sha2("document", 256).alias("document_sha256"))


_CUES = f"select conv_id as output_key, turn * 3.0::double as start, turn * 3.0::double + 3 as stop, {q_clean(q_spaced('text'))} as text from conversations where {q_clean(q_spaced('text'))} != ''"


def _named(cues: DataFrame) -> DataFrame:
    return cues.select("output_key", "start", F.col("end").alias("stop"), "text")


@query(_CUES)
def srt_parse(spark, sf_dir):
    return _named(subtitles.parse_srt(sinks.srt(_spoken(spark, sf_dir)).withColumnRenamed("document", "content"), ["output_key"]))


@query(_CUES)
def ass_parse(spark, sf_dir):
    times = [F.replace(timecode.srt_timestamp(F.col(c)), F.lit(","), F.lit(".")) for c in ("start", "end")]
    line = F.concat(F.lit("Dialogue: 0,"), times[0], F.lit(","), times[1], F.lit(",Default,,0,0,0,,{\\i1}"), F.col("text"))
    return _named(subtitles.parse_ass(_spoken(spark, sf_dir).select("output_key", F.concat(F.lit("[Events]\r\n"), line).alias("content")), ["output_key"]))


@query(_CUES)
def json_parse(spark, sf_dir):
    body = F.to_json(F.struct(F.array(F.struct(F.col("start").alias("from"), F.col("end").alias("to"), F.col("text").alias("content"))).alias("body")))
    return _named(subtitles.parse_json(_spoken(spark, sf_dir).select("output_key", body.alias("content")), ["output_key"]))


@query(_CUES)
def xml_parse(spark, sf_dir):
    safe = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    node = F.concat(F.lit('<tt xmlns="urn:x"><p start="'), F.col("start"), F.lit('" dur="3">'), safe, F.lit("</p><d p=\"1,2\">no end</d></tt>"))
    return _named(subtitles.parse_xml(_spoken(spark, sf_dir).select("output_key", node.alias("content")), ["output_key"]))


# --- streams


@query("""with e as (select user_id, epoch_us(ts) as t from events), b as (select *, coalesce(t > lag(t) over (partition by user_id order by t) + 1800000000, true) as new from e),
    g as (select *, sum(new::int) over (partition by user_id order by t rows unbounded preceding) as no from b),
    w as (select user_id, min(t) as t0, max(t) + 1800000000 as t1, count(*) as n from g group by user_id, no)
    select user_id, t0 as started, t1 as ended, n from w where t1 <= (select max(t) from e) - 3600000000""")
def stream_sessions(spark, sf_dir):
    """Sessions that the watermark has closed, with their times in microseconds."""
    found = _streamed(spark, sf_dir, lambda s: streaming.sessions(s, "user_id"))
    return found.select("user_id", F.unix_micros("start").alias("started"), F.unix_micros("end").alias("ended"), "n")


@query("select user_id, max(n) as n from (select user_id, count(*) over (partition by user_id) as n from events) group by user_id")
def stream_counts(spark, sf_dir):
    return _streamed(spark, sf_dir, lambda s: s.groupBy("user_id").agg(F.count("*").alias("n")), "complete")


def _streamed(spark: SparkSession, sf_dir: str, plan: Callable[[DataFrame], DataFrame], mode: str = "append") -> DataFrame:
    """What a stream over the table yields, written as Parquet to the shared folder."""
    path = f"{sf_dir}/{{events.parquet}}"  # as a pattern, so that it may be one file as well as a folder
    rows = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(path)
    return streaming.drained(plan(rows.withColumn("ts", F.col("ts").cast("timestamp"))), mode)
