"""URL filters with trust and distrust spread over the host graph (operator 8).

DataFrame functions only.

Rules name a host and the start of a path (``example.org/es/``); one fits its
host and all subdomains where the path starts with its path, and the longest
that fits decides.  For urls that no rule fits, the host decides: personalised
PageRank spreads trust from the pages that rules allow along the links between
hosts, and distrust from those that rules block against the links' direction
(who links to a blocked host is suspect).  A host is blocked where its distrust
exceeds ``threshold`` of the sum of both.

Host edges are the absolute links of pages (``href`` to ``//host``), weighted by
their number, and, with ``family``, one link either way between a host and the
domain above it, and between that and the one above, down to domains of two
labels: these are nodes whether they have pages or not, so hosts under one
domain are connected through it.  Links from a host to itself move nothing and
are left out.

Rounds go on until no score changes by more than ``TOLERANCE`` of the largest.
A round passes on ``damping`` of what moved in the one before, so after
``rounds_for(damping)`` rounds less than ``TOLERANCE`` of all mass is unmoved,
whatever the graph; that is the last round at most.

Scale: pages are reduced to hosts and pairs of hosts by partial aggregation
before any shuffle, so a host with a third of all pages is a row a task; each
round is one join of hosts with edges (which adaptive execution splits at a host
with many links) and one sum.  Every fifth round is written to the checkpoint
folder and compared with the one before it.  The tasks of a round are as many as
the graph's rows need (``TASK_ROWS``), not as many as the pages'.
The rules are configuration and become part of the expression; nothing of the
tables is broadcast by hand or collected.

Defined results: null urls, and urls without ``://``, have an empty host and
path, no rule, and count as links' source no more than as a seed: they are
allowed.  Null html has no links.  Hosts of over 253 characters are no domains and
have none above them.  Hosts that neither kind of seed reaches are
allowed.  Repeated rows each count and each get their row.  An empty table
gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import checkpointed

#: (verdict, host and start of path)
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
DAMPING = 0.85
TOLERANCE = 1e-6
WRITTEN = 5  # rounds until scores are written and compared with those of the round before
THRESHOLD = 0.5
EPSILON = 1e-5  # of a host's sum, beyond what the tolerance leaves open; ties are allowed
LONGEST_DOMAIN = 253
TASK_ROWS = 100_000
LINK = r"""[Hh][Rr][Ee][Ff][\t\n\f\r ]*=[\t\n\f\r ]*["']?[\t\n\f\r ]*(?:[Hh][Tt][Tt][Pp][Ss]?:)?//([^/?#"'<>\\\t\n\f\r ]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rounds_for(damping: float) -> int:
    """Rounds after which less than ``TOLERANCE`` of the mass is unmoved."""
    return math.ceil(math.log(TOLERANCE) / math.log(damping)) if 0 < damping < 1 else 1


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(F.coalesce(at, F.lit(0)) > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule that fits, as (size, host size, rule, verdict); null if none does.

    Rules of one size go by the longer host, then by their text.
    """
    fits = []
    for verdict, rule in rules:
        own, slash, rest = rule.partition("/")
        hit = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + rest)
        fits.append(F.when(hit, F.struct(F.lit(len(rule)).alias("size"), F.lit(len(own)).alias("host_size"),
                                         F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array_compact(F.array(*fits))) if fits else F.lit(None).cast(
        "struct<size:int,host_size:int,rule:string,verdict:string>")


def judged_by_rules(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, id_col: str = "page_id",
                    url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, by_rule, html) of every page."""
    url = F.col(url_col).cast("string")
    out = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                       F.col(html_col).cast("string").alias("html"))
    m = matched_rule(F.col("host"), F.col("path"), rules)
    return out.withColumn("m", m).select("page_id", "host", "path", F.col("m.rule").alias("rule"),
                                         F.col("m.verdict").alias("by_rule"), "html")


def host_edges(judged: DataFrame, family: bool = True) -> DataFrame:
    """(src, dst, n): links between different hosts."""
    linked = judged.where("host != ''").select("host", F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("to"))
    edges = linked.select(F.col("host").alias("src"), F.translate("to", UPPER, LOWER).alias("dst")).where("src != dst")
    edges = edges.groupBy("src", "dst").agg(F.count("*").cast("double").alias("n"))
    if family:
        hosts = judged.where("host != ''").select("host").distinct().where(F.length("host") <= LONGEST_DOMAIN)
        labels = F.split("host", r"\.")
        named = hosts.withColumn("labels", labels).where(F.size("labels") > 2)
        above = named.select("labels", F.explode(F.sequence(F.lit(1), F.size("labels") - 2)).alias("at"))
        join = lambda first: F.array_join(F.slice("labels", first, F.size("labels")), ".")
        pairs = above.select(join(F.col("at")).alias("host"), join(F.col("at") + 1).alias("parent")).distinct()
        both = F.array(F.struct(F.col("host").alias("src"), F.col("parent").alias("dst")),
                       F.struct(F.col("parent").alias("src"), F.col("host").alias("dst")))
        kin = pairs.select(F.inline(both)).withColumn("n", F.lit(1.0))
        edges = edges.unionByName(kin).groupBy("src", "dst").agg(F.sum("n").alias("n"))
    return edges


def host_scores(judged: DataFrame, family: bool = True, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) of every host with pages, links or links to it."""
    edges = checkpointed(host_edges(judged, family))
    out_of = edges.groupBy("src").agg(F.sum("n").alias("out_n"))
    into = edges.groupBy("dst").agg(F.sum("n").alias("in_n"))
    shares = edges.join(out_of, "src").join(into, "dst").select(
        "src", "dst", (F.col("n") / F.col("out_n")).alias("trust_share"), (F.col("n") / F.col("in_n")).alias("distrust_share"))
    # what a host gives on: trust to those it links to, distrust to those that link to it
    moves = checkpointed(shares.select(F.col("src").alias("giver"), F.col("dst").alias("host"), F.col("trust_share").alias("t"),
                                       F.lit(0.0).alias("b")).unionByName(
        shares.select(F.col("dst").alias("giver"), F.col("src").alias("host"), F.lit(0.0).alias("t"), F.col("distrust_share").alias("b"))))
    seeds = judged.where("host != ''").groupBy("host").agg(
        F.sum(F.when(F.col("by_rule") == "allow", 1.0).otherwise(0.0)).alias("good"),
        F.sum(F.when(F.col("by_rule") == "block", 1.0).otherwise(0.0)).alias("bad"))
    ends = moves.select("host").distinct().withColumns({"good": F.lit(0.0), "bad": F.lit(0.0)})
    start = seeds.unionByName(ends).groupBy("host").agg(
        (F.sum("good") * (1 - damping)).alias("good"), (F.sum("bad") * (1 - damping)).alias("bad"))
    start = checkpointed(start)
    tasks = max(1, math.ceil((moves.count() + start.count()) / TASK_ROWS))
    moves, start = moves.coalesce(tasks), start.coalesce(tasks)
    scores = start.select("host", F.col("good").alias("trust"), F.col("bad").alias("distrust"))
    rounds = rounds_for(damping)
    for k in range(1, rounds + 1):
        given = scores.withColumnRenamed("host", "giver").join(moves, "giver").select(
            "host", (F.col("trust") * F.col("t") * damping).alias("trust"), (F.col("distrust") * F.col("b") * damping).alias("distrust"))
        before, scores = scores, start.select("host", F.col("good").alias("trust"), F.col("bad").alias("distrust")).unionByName(
            given).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")).coalesce(tasks)
        if k % WRITTEN == 0 or k == rounds:
            both = checkpointed(scores.join(before.withColumnsRenamed({"trust": "was_t", "distrust": "was_b"}), "host"))
            scores = both.select("host", "trust", "distrust")
            moved = both.agg(F.max(F.greatest(F.abs(F.col("trust") - F.col("was_t")), F.abs(F.col("distrust") - F.col("was_b")))).alias("most"),
                             F.max(F.greatest("trust", "distrust")).alias("largest")).first()
            if (moved["most"] or 0.0) <= TOLERANCE * (moved["largest"] or 0.0):
                break
    return scores


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, family: bool = True, damping: float = DAMPING,
          threshold: float = THRESHOLD, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page."""
    judged = judged_by_rules(pages, rules, id_col, url_col, html_col)
    scores = host_scores(judged, family, damping)
    zero = F.lit(0.0)
    trust, distrust = F.coalesce("trust", zero), F.coalesce("distrust", zero)
    by_host = F.when(distrust > (threshold + EPSILON) * (trust + distrust), "block").otherwise("allow")
    return judged.drop("html").join(scores, "host", "left").select(
        F.col("page_id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", by_host).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"))


def _values(rules) -> str:
    rows = []
    for verdict, rule in rules:
        own, slash, rest = rule.partition("/")
        rows.append(f"('{verdict}', '{rule}', '{own}', '{slash + rest}')")
    return ", ".join(rows)


def oracle_sql(rules: tuple[tuple[str, str], ...] = RULES, damping: float = DAMPING, threshold: float = THRESHOLD) -> str:
    """The same verdicts in DuckDB SQL, the rounds as a recursion that always goes to the last."""
    link = LINK.replace("'", "''")
    return f"""
WITH RECURSIVE rules(verdict, rule, own, start) AS (VALUES {_values(rules)}),
    cut AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    split AS (SELECT row_number() OVER () AS k, page_id, html, regexp_extract(rest, '^[^/?#]*') AS raw,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    named AS (SELECT k, page_id, html, translate(raw, '{UPPER}', '{LOWER}') AS host, path FROM split),
    fits AS (SELECT k, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS by_rule FROM named JOIN rules
        ON (host = own OR ends_with(host, '.' || own)) AND starts_with(path, start) GROUP BY k),
    judged AS MATERIALIZED (SELECT named.*, rule, by_rule FROM named LEFT JOIN fits USING (k)),
    found AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{UPPER}', '{LOWER}') AS dst FROM judged WHERE host != ''),
    hosts AS (SELECT DISTINCT string_split(host, '.') AS labels FROM judged WHERE host != '' AND length(host) <= {LONGEST_DOMAIN}),
    above AS (SELECT labels, unnest(range(1, len(labels) - 1)) AS place FROM hosts WHERE len(labels) > 2),
    kin AS (SELECT DISTINCT array_to_string(labels[place:], '.') AS child, array_to_string(labels[place + 1:], '.') AS parent FROM above),
    edges AS MATERIALIZED (SELECT src, dst, sum(n)::DOUBLE AS n FROM (SELECT src, dst, 1 AS n FROM found WHERE src != dst
        UNION ALL SELECT child, parent, 1 FROM kin UNION ALL SELECT parent, child, 1 FROM kin) GROUP BY src, dst),
    shares AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS t, n / sum(n) OVER (PARTITION BY dst) AS b FROM edges),
    moves AS (SELECT src AS giver, dst AS host, t, 0::DOUBLE AS b FROM shares UNION ALL SELECT dst, src, 0::DOUBLE, b FROM shares),
    start AS MATERIALIZED (SELECT host, {1 - damping!r} * sum(good) AS good, {1 - damping!r} * sum(bad) AS bad FROM (
        SELECT host, (coalesce(by_rule, '') = 'allow')::DOUBLE AS good, (coalesce(by_rule, '') = 'block')::DOUBLE AS bad FROM judged WHERE host != ''
        UNION ALL SELECT host, 0, 0 FROM moves) GROUP BY host),
    steps AS MATERIALIZED (SELECT giver, host, t, b, 0 AS own FROM moves UNION ALL SELECT host, host, 0, 0, 1 FROM start),
    scores(k, host, good, bad, trust, distrust) AS (SELECT 0, host, good, bad, good, bad FROM start
        UNION ALL SELECT k + 1, steps.host, sum(own * good), sum(own * bad), sum(own * good + {damping} * t * trust), sum(own * bad + {damping} * b * distrust)
        FROM scores JOIN steps ON scores.host = giver WHERE k < {rounds_for(damping)} GROUP BY k, steps.host),
    final AS (SELECT host, trust, distrust FROM scores WHERE k = {rounds_for(damping)})
SELECT page_id, judged.host AS host, path, rule, coalesce(by_rule,
    CASE WHEN coalesce(distrust, 0) > {threshold + EPSILON!r} * (coalesce(trust, 0) + coalesce(distrust, 0)) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN final ON judged.host = final.host"""
