from __future__ import annotations

import duckdb
import pytest
from capstream.llm import op9_links as op

from tests.llm import tables


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def brute(rows, steps=op.STEPS, damping=op.DAMPING):
    import re

    hosts, links, seeds = {}, {}, {"allow": {}, "block": {}}
    for n, (_, url, html) in enumerate(rows):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for v, h, p in op.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        hosts[n] = (host, max(fits)[1:] if fits else None)
        if fits and host:
            seeds[max(fits)[2]][host] = seeds[max(fits)[2]].get(host, 0) + 1
        for x in re.findall(op.LINK, html or ""):
            if host and x.lower() != host:
                links[host, x.lower()] = links.get((host, x.lower()), 0) + 1
    score = {}
    for verdict, forward in (("allow", True), ("block", False)):
        total = sum(seeds[verdict].values())
        base = {h: c / total for h, c in seeds[verdict].items()}
        rank = dict(base)
        for _ in range(steps):
            new = {h: (1 - damping) * v for h, v in base.items()}
            for (a, b), n in links.items():
                u, v = (a, b) if forward else (b, a)
                out = sum(m for (x, y), m in links.items() if (x if forward else y) == u)
                new[v] = new.get(v, 0) + damping * rank.get(u, 0) * n / out
            rank = new
        score[verdict] = rank
    return {n: (h, r[0] if r else None, r[1] if r else ("block" if score["block"].get(h, 0) > score["allow"].get(h, 0) else "allow")) for n, (h, r) in hosts.items()}


def test_against_brute_force_and_sql(spark, tmp_path):
    rows = [(n, r[1], r[2]) for n, r in enumerate(tables.rows()["pages"])]
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in op.judge(frame(spark, rows)).collect()}
    assert got == brute(rows)
    frame(spark, rows).coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    sql = con.execute(op.ORACLE_SQL["op9_links"]).fetchall()
    assert {r[0]: (r[1], r[3], r[4]) for r in sql} == got


def test_distrust_flows_back_and_trust_forward(spark):
    link = lambda *to: "".join(f'<a href="https://{t}/">' for t in to)
    rows = [
        (1, "https://bad.example.com/de/1", ""), (2, "https://spam.example.com/en/1", link("bad.example.com")), (3, "https://good.example.net/en/1", link("friend.example.com")),
        (4, "https://friend.example.com/en/1", ""), (5, "https://alone.example.com/en/1", ""), (6, "https://both.example.com/x", link("spam.example.com")),
    ]
    got = {r.page_id: r.verdict for r in op.judge(frame(spark, rows)).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "block"}


@pytest.mark.parametrize(
    ("url", "rule"),
    [("http://x.net/", "net/"), ("http://net/a", "net/"), ("http://x.net", None), ("http://a.example.net/en/", "example.net/en/"), ("http://a.example.net/de/", "net/"), ("http://xexample.com/de/", None), ("HTTP://A.ORG/fr/", "org/fr/"), ("a://b://c.net/", None)],
)
def test_rules(spark, url, rule):
    assert op.judge(frame(spark, [(1, url, None)])).first().rule == rule


def test_hot_hosts(spark, monkeypatch):
    """The same ranks where a host with most pages and links is told its scores by broadcast."""
    link = lambda *to: "".join(f'<a href="https://{t}/">' for t in to)
    rows = [(i, f"https://hub.example.com/x/{i}", link(f"h{i % 7}.example.com", "bad.example.com")) for i in range(30)]
    rows += [(100 + i, f"https://h{i}.example.com/de/", link("hub.example.com", f"h{(i + 1) % 7}.example.com")) for i in range(7)] + [(200, "https://o.example.net/en/", link("hub.example.com", "h1.example.com"))]
    want = {n: x for n, x in brute(rows).items()}
    for share in (2000, 3):
        monkeypatch.setattr("capstream.llm.common.HEAVY", share)
        got = {r.page_id: (r.host, r.rule, r.verdict) for r in op.judge(frame(spark, rows)).collect()}
        assert got == {rows[n][0]: x for n, x in want.items()}
