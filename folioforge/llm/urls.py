"""Operator 10: allow or block urls by rules, and elsewhere by link-graph propagation.

A rule of host and path fits its host and all subdomains where the url's path starts
with the rule's; the longest fitting rule decides. Pages that no rule fits are judged
by their host: hosts with allowed pages are trusted seeds, hosts with blocked pages
distrusted seeds, each in proportion to its pages. Personalised PageRank spreads
trust along host edges and distrust against them; hosts without onward edges return
their mass to the seeds, which only scales all scores alike, so the walks are summed
without it and scaled to a total of 1 at the end. Walks grow by ``stride`` links a job
until the last link changes no host's score by more than its ``close``-th part: about
90 links at damping 0.85, more where a host is first reached later, so every host that
links reach is scored, however far or small. A host with more distrust than trust, by
over a part in 1e9, is blocked; the scores are given to 10 significant digits. Host
edges are the absolute links of the pages' html, counted per pair of hosts by a partial
aggregate, so a host with a third of all pages is one row a task.

Only DataFrame operations run. Defined results: a null url, or one without ``://``,
has an empty host and path, which no rule fits and the method allows; without html,
or without links between hosts, seeds keep their own score; pages that repeat, share
an id or have none count each; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from folioforge.llm._store import Scratch
from folioforge.llm.lines import LOWER, UPPER

#: Verdict and rule, host and path in one.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
_LINK = r"""(?i)\bhref\s*=\s*["']?((?:https?:)?//[^"'\s>]+)"""


def _after(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = _after(url)
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.coalesce(F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``src``, ``dst`` and the links between them, for different hosts."""
    links = pages.select(host_of(F.col(url_col)).alias("src"), F.explode(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(_LINK), F.lit(1))).alias("to"))
    return links.select("src", host_of(F.when(F.col("to").startswith("//"), F.concat(F.lit("http:"), "to")).otherwise(F.col("to"))).alias("dst")).where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame, scratch: Scratch, damping: float, stride: int, close: float) -> tuple[DataFrame, list[float]]:
    """Sums of damped walks from the seeds: ``kind``, ``host`` and ``score``, and the total of each kind.

    ``seeds`` has ``kind`` (0 for trust, 1 for distrust), ``host`` and ``mass``.
    """
    both = edges.select(F.lit(0).alias("kind"), "src", "dst", "n").union(edges.select(F.lit(1).alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    onward = both.groupBy("kind", "src").agg(F.sum("n").alias("of"))
    shares = scratch.keep(both.join(onward, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (damping * F.col("n") / F.col("of")).alias("share")), "shares")
    scores = scratch.keep(seeds.select("kind", "host", F.col("mass").alias("score"), F.col("mass").alias("last")), "scores")
    while True:
        step = scores.select("kind", "host", F.col("last").alias("mass"))
        walks = scores.select("kind", "host", "score", F.lit(0.0).alias("last"))
        for k in range(stride):
            step = step.where("mass > 0").join(shares, ["kind", "host"]).groupBy("kind", F.col("dst").alias("host")).agg(F.sum(F.col("mass") * F.col("share")).alias("mass"))
            walks = walks.union(step.select("kind", "host", "mass", F.col("mass") if k == stride - 1 else F.lit(0.0)))
        seen = Observation()
        new = walks.groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("last").alias("last"))
        new = new.observe(seen, F.max(F.try_divide("last", "score")).alias("moved"), *[F.sum(F.when(F.col("kind") == k, F.col("score"))).alias(f"total{k}") for k in (0, 1)])
        new = scratch.keep(new, "scores")
        scratch.drop(scores)
        scores, found = new, seen.get
        if (found["moved"] or 0.0) < close:
            return scores.select("kind", "host", "score"), [found[f"total{k}"] or 1.0 for k in (0, 1)]


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, damping: float = 0.85, stride: int = 6, close: float = 1e-6, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row a page: ``id_col``, ``host``, ``path``, ``rule``, ``verdict``, and its host's ``trust`` and ``distrust``."""
    scratch = Scratch(pages.sparkSession, "urls")
    rows = pages.select(id_col, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("said", verdict)
    seen = Observation()
    seeds = rows.where("said is not null").groupBy(F.when(F.col("said") == "allow", 0).otherwise(1).alias("kind"), "host").agg(F.count("*").alias("mass"))
    seeds = scratch.keep(seeds.observe(seen, *[F.sum(F.when(F.col("kind") == k, F.col("mass"))).alias(f"total{k}") for k in (0, 1)]), "seeds")
    all_of = F.when(F.col("kind") == 0, F.lit(float(seen.get["total0"] or 1))).otherwise(F.lit(float(seen.get["total1"] or 1)))
    edges = scratch.keep(host_edges(pages, url_col, html_col), "edges")
    scores, total = propagate(seeds.select("kind", "host", (F.col("mass") / all_of).alias("mass")), edges, scratch, damping, stride, close)
    by_host = scores.groupBy("host").agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score") / total[k])), F.lit(0.0)).alias(name) for k, name in ((0, "trust"), (1, "distrust"))])
    out = rows.join(by_host, "host", "left")
    both = [F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust")]
    by_method = F.when(both[1] > both[0] * (1 + 1e-9), F.lit("block")).otherwise(F.lit("allow"))
    shown = [F.format_string("%.9e", c).cast("double").alias(name) for c, name in zip(both, ("trust", "distrust"), strict=True)]
    return out.select(id_col, "host", "path", "rule", F.coalesce("said", by_method).alias("verdict"), *shown)
