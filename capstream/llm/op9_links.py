"""URL filtering by rules and by propagation over the host graph.

A url's rule decides where one fits. Elsewhere the host's own standing does: trust spreads from hosts
with allowed pages along links (personalised PageRank), distrust spreads from hosts with blocked
pages against the links (a page that links to blocked hosts becomes suspect). A host whose distrust
exceeds `threshold` times its trust is blocked. The walk takes STEPS steps at most; DAMPING ** STEPS (4 %) of its mass
would go on beyond them.

Scale: ranks and links are keyed by host and shuffled by it, links are summed per pair of hosts before
the first shuffle, hot hosts are pre-aggregated in every step, and the lineage is cut in the shared
checkpoint folder every few steps. Hosts that hold very many pages or links are told their scores by broadcast (their
number is bounded, heavy_keys), so that their rows stay where they are. Only sums of scores reach the driver. Mass at
hosts without links leaves the walk.

Null url, or one without "://", has empty host and path, fits no rule, and is judged like a host that
nobody links to (allowed). Null html has no links. Null page_id and repeated rows are judged like any
other row. Tied trust and distrust allow. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.llm.common import ascii_lower, checkpoint, heavy_keys, table, with_known

#: (verdict, host, path): fits the host and its subdomains where the path starts so.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DAMPING, STEPS, STEPS_BETWEEN_CHECKPOINTS, TOLERANCE, THRESHOLD = 0.85, 20, 4, 1e-9, 1.0

LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null. Rules are a list written by people."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, at, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(start)
        chosen = F.when(fits, F.struct(F.lit(at + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def host_links(pages: DataFrame) -> DataFrame:
    """src, dst, n: links between different hosts, counted."""
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("dst"))
    links = links.select("src", ascii_lower(F.col("dst")).alias("dst")).where("src != '' and dst != '' and src != dst")
    return links.groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, steps: int = STEPS) -> DataFrame:
    """host, trust, distrust from seeds(host, trust, distrust), both summing to one at most."""
    out = links.groupBy("src").agg(F.sum("n").alias("out_n"))
    into = links.groupBy("dst").agg(F.sum("n").alias("in_n"))
    edges = links.join(out, "src").join(into, "dst")
    edges = checkpoint(edges.select("src", "dst", (F.col("n") / F.col("out_n")).alias("ahead"), (F.col("n") / F.col("in_n")).alias("back")))
    if edges.isEmpty():
        return seeds.select("host", *[((1 - damping) * F.col(c)).alias(c) for c in ("trust", "distrust")])
    base = seeds.select("host", *[((1 - damping) * F.col(c)).alias(c) for c in ("trust", "distrust")])
    ranks, nothing = seeds, F.lit(0.0)
    hot = {end: checkpoint(heavy_keys(edges.groupBy(F.col(end).alias("host")).agg(F.count("*").alias("n")), "host")) for end in ("src", "dst")}
    hot = {end: None if keys.isEmpty() else keys for end, keys in hot.items()}
    every = STEPS_BETWEEN_CHECKPOINTS if hot == {"src": None, "dst": None} else 1

    def ranked(end: str, ranks: DataFrame) -> DataFrame:
        rows = edges.withColumnRenamed(end, "host")
        return rows.join(ranks, "host") if hot[end] is None else with_known(rows, ranks, "host", hot[end])

    for step in range(1, steps + 1):
        ahead = ranked("src", ranks).select(F.col("dst").alias("host"), (damping * F.col("ahead") * F.col("trust")).alias("trust"), nothing.alias("distrust"))
        back = ranked("dst", ranks).select(F.col("src").alias("host"), nothing.alias("trust"), (damping * F.col("back") * F.col("distrust")).alias("distrust"))
        ahead, back = ahead.where("trust is not null"), back.where("distrust is not null")
        new = base.unionByName(ahead).unionByName(back).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if step % every == 0:
            new = checkpoint(new)
            both = ranks.select("host", F.col("trust").alias("t"), F.col("distrust").alias("d")).join(new, "host", "full")
            gap = [F.abs(F.coalesce(a, nothing) - F.coalesce(b, nothing)) for a, b in ((F.col("t"), F.col("trust")), (F.col("d"), F.col("distrust")))]
            moved = both.agg(F.sum(gap[0] + gap[1])).first()[0]
            if moved is None or moved < TOLERANCE:
                return new
        ranks = new
    return ranks


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("fits", fitting_rule(F.col("host"), F.col("path"), rules))
    count = [F.sum(F.when(F.col("fits.verdict") == v, 1.0).otherwise(0.0)).alias(c) for v, c in (("allow", "trust"), ("block", "distrust"))]
    seeds = rows.where("fits is not null and host != ''").groupBy("host").agg(*count)
    sums = seeds.agg(F.sum("trust"), F.sum("distrust")).first()
    share = lambda c, total: (F.col(c) / total if total else F.lit(0.0)).alias(c)
    seeds = checkpoint(seeds.select("host", share("trust", sums[0]), share("distrust", sums[1])))
    scores = checkpoint(spread(host_links(pages), seeds))
    counts = rows.groupBy("host").agg(F.count("*").alias("n"))
    judged = with_known(rows, scores, "host", checkpoint(heavy_keys(counts, "host")))
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    method = F.when(distrust > threshold * trust, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("fits.rule").alias("rule"), F.coalesce("fits.verdict", method).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )


def op9_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    """The same, its steps written out one after another."""
    steps = "".join(
        f""",
    r{k} as materialized (select host, sum(t) as trust, sum(d) as distrust from (
            select host, {1 - DAMPING!r} * trust as t, {1 - DAMPING!r} * distrust as d from r0
            union all select e.dst, {DAMPING} * e.ahead * r.trust, 0.0 from e join r{k - 1} r on e.src = r.host
            union all select e.src, 0.0, {DAMPING} * e.back * r.distrust from e join r{k - 1} r on e.dst = r.host) group by host)"""
        for k in range(1, STEPS + 1)
    )
    fit = lambda at, start: f"((host = '{at}' or ends_with(host, '.{at}')) and starts_with(path, '{start}'))"
    by_length = sorted(RULES, key=lambda r: (-len(r[1]) - len(r[2]), -len(r[1])))
    case = lambda value: "case " + " ".join(f"when {fit(at, start)} then '{value(v, at, start)}'" for v, at, start in by_length) + " end"
    link = LINK.replace("'", "''").replace("(?i)", "")
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    return f"""
    with p as (select page_id, html, coalesce({low("regexp_extract(url, '://([^/?#]*)', 1)")}, '') as host,
                      coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
    f as (select *, {case(lambda v, a, s: a + s)} as rule, {case(lambda v, a, s: v)} as ruled from p),
    c as (select host, sum((ruled = 'allow')::int)::double as t, sum((ruled = 'block')::int)::double as d
          from f where ruled is not null and host != '' group by host),
    r0 as materialized (select host, coalesce(t / nullif(sum(t) over (), 0), 0) as trust, coalesce(d / nullif(sum(d) over (), 0), 0) as distrust from c),
    x as (select host as src, unnest(regexp_extract_all(html, '{link}', 1, 'i')) as raw from p),
    l as (select src, {low("raw")} as dst, count(*) as n from x where src != '' and raw != '' and src != {low("raw")} group by all),
    e as materialized (select src, dst, n / sum(n) over (partition by src) as ahead, n / sum(n) over (partition by dst) as back from l){steps}
    select page_id, f.host, path, rule,
           coalesce(ruled, case when coalesce(distrust, 0) > coalesce(trust, 0) then 'block' else 'allow' end) as verdict
    from f left join r{STEPS} r on f.host = r.host
    """


QUERIES = {"op9_links": op9_links}
ORACLE_SQL = {"op9_links": _sql()}
