"""URL filter: path rules first, then link-graph propagation over hosts.

Rules name a host and a path prefix; they fit the host and its subdomains, the longest rule that
fits decides. URLs without a rule get their host's verdict: the pages under rules make seeds (a
host's share of allowed pages is its trust seed, of blocked pages its distrust seed), trust spreads
along the links between hosts by personalised PageRank, distrust along the reversed links by the
same iteration from the blocked seeds, and a host is blocked where distrust is more than
``block_share`` of trust and distrust together. Host edges are counted from absolute links in the
pages before anything is joined, so a host with a third of the pages costs one row a task. Mass at
a host without links is dropped. The rank table is written between rounds until it changes by less
than ``tolerance`` in total (or ``rounds``, which bounds the error by ``damping ** rounds``).

Null URLs and URLs without ``://`` have empty host and path, and no rule; the empty host has no
evidence and is allowed. Repeated rows are judged one by one, null html has no links, extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedrank.llm.tables import Staged

#: fixed values: (host, path, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
DAMPING = 0.85
BLOCK_SHARE = 2 / 3
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty for null or no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_columns(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, from ``host`` and ``html``."""
    return (pages.filter("host <> ''").select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("dst"))
            .withColumn("dst", lower_ascii(F.col("dst"))).filter("src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def propagate(seeds: DataFrame, edges: DataFrame, stage: Staged, damping: float = DAMPING, rounds: int = 60, tolerance: float = 1e-9) -> DataFrame:
    """(host, kind, score): kind ``trust`` along the edges, ``distrust`` against them, from ``seeds``
    (host, kind, seed)."""
    def moves(src, dst, kind):
        total = edges.groupBy(src).agg(F.sum("n").alias("total"))
        return edges.join(total, src).select(F.col(src).alias("host"), F.col(dst).alias("to"), F.lit(kind).alias("kind"), (F.col("n") / F.col("total")).alias("p"))

    walk = stage.write(moves("src", "dst", "trust").unionByName(moves("dst", "src", "distrust")), "moves")
    base = seeds.select("host", "kind", (F.col("seed") * (1 - damping)).alias("score"))
    rank = stage.write(base, "rank0")
    for r in range(rounds):
        moved = rank.join(walk, ["host", "kind"]).groupBy(F.col("to").alias("host"), "kind").agg((F.sum(F.col("score") * F.col("p")) * damping).alias("score"))
        new = stage.write(base.unionByName(moved).groupBy("host", "kind").agg(F.sum("score").alias("score")), f"rank{r + 1}")
        old = rank.select("host", "kind", (-F.col("score")).alias("score"))
        change = new.unionByName(old).groupBy("host", "kind").agg(F.abs(F.sum("score")).alias("d")).agg(F.sum("d")).first()[0] or 0.0
        stage.drop(f"rank{r}")
        rank = new
        if change < tolerance:
            break
    return rank


def judge(pages: DataFrame, rules=RULES, damping: float = DAMPING, block_share: float = BLOCK_SHARE,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every row of ``pages``."""
    stage = Staged(pages.sparkSession, "urls")
    host, path = url_parts(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    edges = stage.write(host_edges(parsed), "edges")
    ruled = stage.write(parsed.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled")), "ruled")
    total = ruled.count() or 1
    per_host = ruled.filter("host <> '' AND ruled IS NOT NULL").groupBy("host", "ruled").agg((F.count(F.lit(1)) / total).alias("seed"))
    seeds = stage.write(per_host.select("host", F.when(F.col("ruled") == "allow", "trust").otherwise("distrust").alias("kind"), "seed"), "seeds")
    rank = propagate(seeds, edges, stage, damping)
    by_host = rank.groupBy("host").agg(F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
                                       F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"))
    by_host = stage.write(by_host, "hosts")
    out = ruled.join(by_host, "host", "left").fillna(0.0, ["trust", "distrust"])
    method = F.when(F.col("distrust") > block_share * (F.col("trust") + F.col("distrust")), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "trust", "distrust")
