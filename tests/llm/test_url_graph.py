"""Operator 8 against plain Python and its DuckDB SQL."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import types as T

from storepulse.llm import queries, url_graph
from storepulse.llm.frames import ship

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                       T.StructField("html", T.StringType()), T.StructField("host", T.StringType()), T.StructField("rule", T.IntegerType())])
URLS = [
    None, "", "no scheme", "http://", "https://x.org", "https://x.org/", "https://EXAMPLE.org/es/1?x=/en/", "https://a.example.org/en/12#t",
    "https://a.example.org/en/22", "http://notexample.org/es/1", "http://b.com/fr/1", "http://b.com/de/1", "http://b.com/de/2", "http://b.com/it/1",
    "http://c.com/it/1", "http://www.b.com/it/2", "http://d.net/x", "http://e.net/y", "ftp://f.net/a://g", "http://É.com?/fr/", "http://h.com#/de/",
    "http://c.com/fr/1\n2", "http://x.far.net/1", "http://y.far.net/1", "http://deep.y.far.net/de/", "http://" + "a." * 400 + "com/de/", "http://" + "k" * 20_000 + ".net/" + "p" * 20_000,
]
LINKS = {13: '<a href="http://d.net/q">', 14: "<A HREF = '//E.net'> <a href=//d.net>", 16: '<a href="http://b.com/x"><a href="/local">',
         17: '<a href="https://c.com">' * 3, 9: '<a href="http://unseen.net/">', 18: '<link href="http://f.net">'}


def rows():
    out = [(i, u, LINKS.get(i, None if i % 3 else "<p>none</p>"), "mine", 1) for i, u in enumerate(URLS)]
    return [*out, out[6], (None, "http://b.com/de/3", None, None, None)]


def plain(rows):
    """Verdicts by dictionaries."""
    pages, edges, good, bad = [], Counter(), Counter(), Counter()
    low = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x)
    for k, url, html, *_ in rows:
        rest = (url or "").partition("://")[2]
        host = re.match(r"[^/?#]*", rest)[0]
        path, host = re.match(r"[^?#]*", rest[len(host):])[0], low(host)
        fits = []
        for verdict, rule in url_graph.RULES:
            own, slash, tail = rule.partition("/")
            if (host == own or host.endswith("." + own)) and path.startswith(slash + tail):
                fits.append((len(rule), rule, verdict))
        rule, verdict = max(fits)[1:] if fits else (None, None)
        pages.append((k, host, path, rule, verdict))
        if host:
            good[host] += verdict == "allow"
            bad[host] += verdict == "block"
            for to in re.findall(url_graph.LINK, html or ""):
                if low(to) != host:
                    edges[host, low(to)] += 1
    kin = set()
    for h in list(good):
        while h.count(".") > 1 and len(h) <= 253:
            kin.add((h, h := h.partition(".")[2]))
    for h, parent in kin:
        edges[h, parent] += 1
        edges[parent, h] += 1
    out, into = Counter(), Counter()
    for (a, b), n in edges.items():
        out[a] += n
        into[b] += n
    hosts = set(good) | {h for e in edges for h in e}
    d = url_graph.DAMPING
    t, b = {h: (1 - d) * good[h] for h in hosts}, {h: (1 - d) * bad[h] for h in hosts}
    for _ in range(200):
        nt, nb = defaultdict(float), defaultdict(float)
        for (x, y), n in edges.items():
            nt[y] += d * t[x] * n / out[x]
            nb[x] += d * b[y] * n / into[y]
        t, b = {h: (1 - d) * good[h] + nt[h] for h in hosts}, {h: (1 - d) * bad[h] + nb[h] for h in hosts}
    return [(k, h, p, r, v or ("block" if b.get(h, 0) > 0.50001 * (t.get(h, 0) + b.get(h, 0)) else "allow"),
             t.get(h, 0.0), b.get(h, 0.0)) for k, h, p, r, v in pages]


def test_verdicts_match_plain_python(spark, tmp_path):
    ship(spark)
    pages = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    got = url_graph.judge(pages).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:5]))
    for a, b in zip(sorted((tuple(r) for r in got), key=key), sorted(plain(rows()), key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-4, abs=1e-4)
    by_id = {r["page_id"]: r["verdict"] for r in got}
    assert by_id[13] == "block"  # of a host with more blocked pages than allowed ones
    assert by_id[14] == "block"  # links to a host that links to that one
    assert by_id[0] == by_id[2] == by_id[22] == "allow"


def test_sql_matches(spark, tmp_path):
    ship(spark)
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    sql = queries.ORACLE_SQL["op8_url_graph"]
    for folder, path in ((str(tmp_path), f"{tmp_path}/pages.parquet/*.parquet"), ("/root/testdata/sf0.01", "/root/testdata/sf0.01/pages.parquet")):
        got = queries.op8_url_graph(spark, folder)
        db = duckdb.connect()
        db.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{path}')")
        want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({sql})").fetchall()
        assert Counter(tuple(r) for r in got.collect()) == Counter(want)


def test_plan_is_native(spark):
    pages = spark.createDataFrame(rows(), SCHEMA)
    plan = url_graph.judge(pages)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert url_graph.judge(spark.createDataFrame([], SCHEMA)).count() == 0


def test_propagation_decides_on_pages(spark):
    """The hosts of the given pages are connected through their domains, and some verdict follows from it alone."""
    pages = queries.table(spark, "/root/testdata/sf0.1", "pages")
    judged = url_graph.judged_by_rules(pages)
    edges = url_graph.host_edges(judged)
    assert edges.count() > 60
    with_links = {r["page_id"]: r["verdict"] for r in url_graph.judge(pages).collect()}
    without = {r["page_id"]: r["verdict"] for r in url_graph.judge(pages, family=False).collect()}
    assert any(with_links[k] != without[k] for k in without)


def test_rounds_are_enough():
    assert 0.85 ** url_graph.rounds_for(0.85) <= url_graph.TOLERANCE < 0.85 ** (url_graph.rounds_for(0.85) - 1)
