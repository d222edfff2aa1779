"""Mixing sources to target weights by a low-discrepancy schedule (native).

The words of a source, its documents in hashed order, form a stream that is cut into blocks of
equal length. A source needs a whole number of slots, one for each block that the mix takes from
it; laid end to end, the slots of all sources are the cumulative weights, in units of slots. A slot
at place p gets time t, the van der Corput point of p: reversing the bits of p is its own inverse,
so mapping the points of all times through the cumulative weights, and reversing every place, are
the same. Slots are then ranked in time within their source, and the slot of rank r takes block
r mod (number of blocks): every block is taken before any is taken again. The mix is the blocks in the order of
their slots' times. A document stands in it wherever a slot takes a block that holds some of its words: its
first and last slot say where, and the mixed texts come in that order, a document's neighbouring blocks of an
epoch joined at the slot of its first word.

Scale: nothing but one row for each source meets in one task. Streams and ranks are prefix sums in
two levels (within a hash bucket or a stretch of time, then over their totals), so that a source
holding a third of all rows is spread over thousands of groups. Slots grow as words / block.

Null text has no words; such a document, like an empty one, is returned with taken 0. Null source
is a source of its own, the last. Null doc_id takes part like any other. Repeated rows are
documents of their own. Tied rows of the stream differ in nothing that the result holds. An empty
table gives an empty result. Other columns are ignored unless named in `keep`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capstream.llm.common import checkpoint, table, word_count

WEIGHTS = (1, 2, 3)
CAP = 3
#: Longest block in words, and into how many blocks a small corpus is cut.
BLOCK_WORDS, CORPUS_BLOCKS, SOURCE_BLOCKS = 2048, 2**17, 256
#: Hex digits of the order key that name a bucket of a source's stream; bits of a stretch of time.
BUCKET_DIGITS, STRETCH_BITS = 3, 16
MAX_BROADCAST, SALTS = 20_000, 64
#: So many slots are broadcast (some 16 MB) rather than joined by a shuffle of the texts.
MAX_SLOTS = 2**18


def order_key(seed: int, doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def sized(docs: DataFrame, seed: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, key and the columns to keep (as a struct, so that names can't clash)."""
    kept = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(None).cast("int")
    return docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        order_key(seed, F.col("doc_id")).alias("key"),
        F.xxhash64("text").alias("tie"),
        kept.alias("kept"),
    )


def source_plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row for each source: no, source, source_size, target, block, blocks, slots, start, bits.

    The targets solve min(cap * size, level * weight) summing to all sizes: in the order of
    cap * size / weight the level that the sources from here on would share is compared with the
    source's own ratio; the first source above its level fixes the level.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    rows = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = rows.select(
        (F.row_number().over(by_name) - 1).alias("no"), "source", "source_size",
        F.sum("source_size").over(everything).alias("total"),
    )
    rows = rows.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    ).withColumn("ratio", cap * F.col("source_size") / F.col("weight"))
    filling = Window.orderBy("ratio", "no")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(
        "level",
        (F.col("total") - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    ).withColumn("place", F.row_number().over(filling))
    rows = rows.withColumn(
        "level", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("place", "level"))).over(everything)["level"]
    )
    full = (cap * F.col("source_size")).cast("double")
    rows = rows.withColumn("target", F.least(full, F.coalesce(F.col("level") * F.col("weight"), full)))
    block = F.least(
        F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.col("total") / CORPUS_BLOCKS))),
        F.greatest(F.lit(1), F.floor(F.least(F.col("source_size"), F.col("target")) / SOURCE_BLOCKS)),
    ).cast("long")
    rows = rows.withColumn("block", block).withColumn("blocks", F.ceil(F.col("source_size") / F.col("block")))
    demand = F.col("target") * F.col("blocks") / F.nullif(F.col("source_size"), F.lit(0))
    rows = rows.withColumn("slots", F.coalesce(F.floor(demand + 0.5), F.lit(0)).cast("long"))
    rows = rows.withColumn("start", F.coalesce(F.sum("slots").over(by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("bits", F.length(F.bin(F.greatest(F.sum("slots").over(everything) - 1, F.lit(1)))))
    return rows.select("no", "source", "source_size", "target", "block", "blocks", "slots", "start", "bits")


def reversed_bits(rows: DataFrame, name: str) -> DataFrame:
    """`name`, a long, with its 64 bits in reverse order."""
    for shift, mask in (
        (1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF),
        (16, 0x0000FFFF0000FFFF), (32, 0x00000000FFFFFFFF),
    ):
        x, m = F.col(name), F.lit(mask)
        rows = rows.withColumn(name, F.shiftrightunsigned(x, shift).bitwiseAND(m).bitwiseOR(F.shiftleft(x.bitwiseAND(m), shift)))
    return rows


def schedule(plan: DataFrame) -> DataFrame:
    """no, time, rank, epoch, block_no: which block of which source comes at which time."""
    step = 1 << STRETCH_BITS
    parts = plan.where("slots > 0").select(
        "no", "blocks", "slots", "start", "bits",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / step))).alias("part"),
    ).repartition("no", "part")
    slots = parts.select(
        "no", "blocks", "bits",
        F.explode(F.sequence(F.col("part") * step, F.least(F.col("slots"), (F.col("part") + 1) * step) - 1)).alias("x"), "start",
    ).withColumn("time", F.col("x") + F.col("start"))
    slots = reversed_bits(slots, "time").withColumn("time", F.expr("shiftrightunsigned(time, 64 - bits)"))
    slots = slots.select("no", "blocks", "time", F.shiftright("time", STRETCH_BITS).alias("stretch"))
    earlier = Window.partitionBy("no").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = slots.groupBy("no", "stretch").count()
    totals = totals.select("no", "stretch", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("earlier"))
    here = Window.partitionBy("no", "stretch").orderBy("time")
    ranked = slots.withColumn("here", F.row_number().over(here) - 1).join(totals, ["no", "stretch"])
    ranked = ranked.withColumn("rank", F.col("earlier") + F.col("here"))
    return ranked.select(
        "no", "time", "rank", F.floor(F.col("rank") / F.col("blocks")).alias("epoch"), (F.col("rank") % F.col("blocks")).alias("block_no")
    )


def with_source(rows: DataFrame, sources: DataFrame, on: Column | str, n_sources: int, salt: Column) -> DataFrame:
    """Rows joined with what is known of their source, without bringing a hot source's rows together.

    Up to MAX_BROADCAST sources, counted before, are broadcast; more are repeated for each of SALTS salts.
    """
    if n_sources <= MAX_BROADCAST:
        return rows.join(F.broadcast(sources), on)
    salted = rows.withColumn("_salt", F.pmod(salt, F.lit(SALTS)))
    sources = sources.withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    if isinstance(on, str):
        sources, on = sources.withColumnRenamed(on, "_on"), F.col(on) == F.col("_on")
    return salted.join(sources, on & (F.col("_salt") == F.col("_of"))).drop("_salt", "_of", "_on")


def stream(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """Every document with its source's plan and `at`, its first word's place in the source's stream."""
    rows = sizes.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    known = plan.withColumnRenamed("source", "_source")
    rows = with_source(rows, known, F.col("source").eqNullSafe(F.col("_source")), plan.count(), F.xxhash64("key")).drop("_source")
    earlier = Window.partitionBy("no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("no", "bucket").agg(F.sum("size").alias("total"))
    totals = totals.select("no", "bucket", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("earlier"))
    here = Window.partitionBy("no", "bucket").orderBy("key", F.col("doc_id").asc_nulls_first(), "size", "tie")
    rows = rows.withColumn("here", F.sum("size").over(here.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    rows = rows.join(totals, ["no", "bucket"])
    return rows.withColumn("at", F.col("earlier") + F.col("here")).drop("earlier", "here", "bucket", "key", "tie")


def pieces(streamed: DataFrame) -> DataFrame:
    """Every document cut at the borders of its source's blocks: block_no, first, last (words of the document)."""
    cut = streamed.where("size > 0").withColumn(
        "block_no", F.explode(F.sequence(F.floor(F.col("at") / F.col("block")), F.floor((F.col("at") + F.col("size") - 1) / F.col("block"))))
    )
    return cut.withColumn("first", F.greatest(F.lit(0), F.col("block_no") * F.col("block") - F.col("at"))).withColumn(
        "last", F.least(F.col("size"), (F.col("block_no") + 1) * F.col("block") - F.col("at"))
    )


def mix(docs: DataFrame, seed: int = 4, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document, the source, and the first and last slot (times) that take of it, -1 where none does."""
    sizes = checkpoint(sized(docs, seed))
    plan = checkpoint(source_plan(sizes, weights, cap))
    streamed = stream(sizes, plan)
    takes = schedule(plan).groupBy("no", "block_no").agg(F.count("*").alias("times"), F.min("time").alias("first_slot"), F.max("time").alias("last_slot"))
    taken = pieces(streamed).join(takes, ["no", "block_no"])
    words = F.sum((F.col("last") - F.col("first")) * F.col("times"))
    taken = taken.groupBy("no", "at").agg(words.alias("taken"), F.min("first_slot").alias("first_slot"), F.max("last_slot").alias("last_slot"))
    names = ("doc_id", "size", "source_size", "target")
    some = streamed.where("size > 0").join(taken, ["no", "at"], "left")
    none = streamed.where("size = 0").withColumns({c: F.lit(None).cast("long") for c in ("taken", "first_slot", "last_slot")})
    last = ("source", "block", "slots", F.coalesce("first_slot", F.lit(-1)).alias("first_slot"), F.coalesce("last_slot", F.lit(-1)).alias("last_slot"))
    return some.unionByName(none).select(*names, F.coalesce("taken", F.lit(0)).alias("taken"), *last)


def mixed_texts(docs: DataFrame, columns: tuple[str, ...], seed: int = 4, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mix itself, in order: `columns` of the documents, one row for each time that it takes a stretch of a document.

    In every epoch a document's stretch comes at the slot that takes its first word, so that sources alternate
    as their slots do; rows are sorted by it. Neighbouring blocks of an epoch stay one stretch, so a document
    taken whole comes whole; a part of a document starts with a word and ends with the white space after its
    last one. A document taken n times comes as n rows.
    """
    sizes = checkpoint(sized(docs, seed))
    plan = checkpoint(source_plan(sizes, weights, cap))
    slots = checkpoint(schedule(plan).select("no", "epoch", "block_no", "time"))
    n_sources = plan.count()
    # a rank takes block rank mod blocks, so in each epoch the blocks taken are a prefix of all
    takes = slots.groupBy("no", "epoch").agg(F.max("block_no").alias("last_block"))
    rows = with_source(stream(sized(docs, seed, columns), plan).where("size > 0"), takes, "no", n_sources, F.xxhash64("at"))
    end = F.least(F.col("size"), (F.col("last_block") + 1) * F.col("block") - F.col("at"))
    rows = rows.withColumn("end", end).where("end > 0").withColumn("block_no", F.floor(F.col("at") / F.col("block")))
    some = (plan.agg(F.sum("slots")).first()[0] or 0) <= MAX_SLOTS
    rows = rows.join(F.broadcast(slots) if some else slots, ["no", "epoch", "block_no"])
    text = F.col("kept.text")
    words = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    lead = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    part = F.when(F.col("end") == F.col("size"), text).otherwise(F.concat_ws("", F.slice(words, F.lit(1), (F.col("end") + lead).cast("int"))))
    rows = rows.orderBy("time", "at")
    return rows.select(*[part.alias(c) if c == "text" else F.col(f"kept.{c}").alias(c) for c in columns])


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same mix: words taken in closed form (whole epochs, and the words of the last, unfinished one), slots by the schedule."""
    first = "rows between unbounded preceding and 1 preceding"
    return rf"""
    with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
                      md5('4:' || coalesce(doc_id::varchar, '')) as k from documents),
    s as (select source, sum(size)::bigint as source_size from d group by source),
    w as (select source, source_size, row_number() over (order by encode(source) nulls last) - 1 as no,
                 sum(source_size) over ()::bigint as total from s),
    r as (select *, (no % 3 + 1)::double as weight, 3 * source_size / (no % 3 + 1)::double as ratio from w),
    l as (select *, row_number() over (order by ratio, no) as place,
                 (total - coalesce(sum(3 * source_size) over (order by ratio, no {first}), 0)::bigint)
                 / (sum(weight) over () - coalesce(sum(weight) over (order by ratio, no {first}), 0)) as level from r),
    f as (select *, (select arg_min(level, place) from l where ratio > level) as fixed from l),
    t as (select *, least((3 * source_size)::double, coalesce(fixed * weight, (3 * source_size)::double)) as target from f),
    b as (select *, least(greatest(1, least({BLOCK_WORDS}, floor(total / {CORPUS_BLOCKS}))),
                          greatest(1, floor(least(source_size, target) / {SOURCE_BLOCKS})))::bigint as block from t),
    n as (select *, ceil(source_size / block)::bigint as blocks from b),
    p as (select *, coalesce(floor(target * blocks / nullif(source_size, 0) + 0.5), 0)::bigint as slots from n),
    o as (select d.doc_id, d.size, p.no, p.source_size, p.target, p.block, p.blocks, p.slots, d.source,
                 sum(d.size) over (partition by p.no order by d.k, d.doc_id nulls first, d.size rows unbounded preceding)::bigint - d.size as pos
          from d join p on d.source is not distinct from p.source),
    z as (select greatest(sum(slots) - 1, 1)::bigint as most from p),
    y as (select no, slots, blocks, coalesce(sum(slots) over (order by no {first}), 0)::bigint as start from p),
    x as (select no, blocks, unnest(range(start, start + slots)) as place from y),
    v as (select no, blocks, list_sum(list_transform(range(0, length(bin(most))), lambda i: ((place >> i) & 1) << (length(bin(most)) - 1 - i)))::bigint as time from x, z),
    g as (select no, time, (row_number() over (partition by no order by time) - 1) % blocks as block_no from v),
    h as (select no, block_no, min(time) as first_time, max(time) as last_time from g group by no, block_no),
    q as (select o.doc_id, o.no, o.pos, o.size, unnest(range(o.pos // o.block, (o.pos + o.size - 1) // o.block + 1)) as block_no from o where size > 0),
    e as (select no, pos, min(first_time) as first_slot, max(last_time) as last_slot from q join h using (no, block_no) group by no, pos)
    select doc_id, size, source_size, target, source, block, slots, case when size > 0 then coalesce(first_slot, -1) else -1 end as first_slot, case when size > 0 then coalesce(last_slot, -1) else -1 end as last_slot,
           case when size = 0 then 0 else (slots // blocks) * size
             + greatest(0, least(size, (slots % blocks) * block - pos)) end::bigint as taken from o left join e using (no, pos)
    """


QUERIES = {"op4_mixing": op4_mixing}
ORACLE_SQL = {"op4_mixing": _sql()}
