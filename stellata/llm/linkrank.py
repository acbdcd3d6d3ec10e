"""URL verdicts: rules first, then trust and distrust over the links between hosts.

Hosts whose pages a rule allows are trusted seeds, hosts whose pages a rule blocks are
distrusted ones. Personalised PageRank carries trust along links, and distrust against
them (who links to a blocked host answers for it). A host whose share of distrust
reaches a threshold is blocked. DataFrame operations only.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellata.llm.common import col, stored

#: No bound of the turns; ranks are precise to about this part of themselves.
DAMPING, TURNS, PRECISION, THRESHOLD = 0.85, None, 1e-6, 0.5
#: Ranks below this are too close to the smallest double to have a precision.
_TINY = 1e-290
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    rest = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls. ``rules``: a short
    list of (verdict, host, path); a rule fits its host and all subdomains."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in ordered]
    pick = lambda values: reduce(
        lambda rest, x: F.when(x[0], F.lit(x[1])).otherwise(rest), list(zip(fits, values))[::-1],
        F.lit(None).cast("string"))
    return pick([h + p for _, h, p in ordered]), pick([v for v, _, _ in ordered])


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target, n) between different hosts, from (host, html). Links without a
    host stay on their own host and are not edges; neither are those of other schemes."""
    href = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""
    links = pages.select("host", F.explode(F.regexp_extract_all("html", F.lit(href), F.lit(1))).alias("link"))
    there = F.coalesce(F.translate(F.regexp_extract("link", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]+)", 1),
                                   _UPPER, _LOWER), F.lit(""))
    return (links.where(F.col("link").contains("//")).select(F.col("host").alias("source"), there.alias("target"))
            .where("source <> '' AND target <> '' AND source <> target")
            .groupBy("source", "target").agg(F.count("*").alias("n")))


def propagate(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, turns: int | None = TURNS,
              precision: float = PRECISION) -> DataFrame:
    """(host, trust, distrust), each summing to 1 over all hosts if it has a seed.

    ``links``: (source, target, n); ``seeds``: (host, trusted, blocked), counts of pages.
    What teleports and what reaches hosts without links goes back to the seeds. It ends
    when a turn reaches no further host and moves no rank by more than ``precision`` of
    itself, however small it is, or after ``turns`` turns if they are given.
    """
    both = links.select(F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("source").alias("a"), F.col("target").alias("b"), "n"),
        F.struct(F.lit("distrust").alias("kind"), F.col("target").alias("a"), F.col("source").alias("b"), "n"))
    ).alias("e")).select("e.*")
    out = both.groupBy("kind", "a").agg(F.sum("n").alias("total"))
    flow = stored(both.join(out, ["kind", "a"]).select("kind", "a", "b", (F.col("n") / F.col("total")).alias("w")),
                  "links")
    counts = seeds.select("host", F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("trusted").cast("double").alias("n")),
        F.struct(F.lit("distrust").alias("kind"), F.col("blocked").cast("double").alias("n")))).alias("s"))
    counts = counts.select("s.kind", "host", "s.n")
    sums = counts.groupBy("kind").agg(F.sum("n").alias("all"))  # two rows
    begin = counts.join(F.broadcast(sums), "kind").select(
        "kind", "host", F.when(F.col("all") > 0, F.col("n") / F.col("all")).otherwise(F.lit(0.0)).alias("seed"))
    nodes = (flow.select("kind", F.col("a").alias("host")).unionByName(flow.select("kind", F.col("b").alias("host")))
             .distinct())
    state = stored(nodes.join(begin, ["kind", "host"], "full").select(
        "kind", "host", F.coalesce("seed", F.lit(0.0)).alias("seed"),
        F.coalesce("seed", F.lit(0.0)).alias("rank")), "ranks")
    if flow.isEmpty():
        turns = 0  # nothing moves: all rank teleports back to the seeds
    for _ in count() if turns is None else range(turns):
        sent = (flow.join(state.select("kind", F.col("host").alias("a"), "rank"), ["kind", "a"])
                .groupBy("kind", F.col("b").alias("host"))
                .agg((F.sum(F.col("rank") * F.col("w")) * damping).alias("got")))
        sent = stored(sent, "sent")
        arrived = sent.groupBy("kind").agg(F.sum("got").alias("arrived"))  # two rows at most
        seeded = state.groupBy("kind").agg(F.sum("seed").alias("whole"))
        left = seeded.join(arrived, "kind", "left").select(
            "kind", (F.col("whole") - F.coalesce("arrived", F.lit(0.0))).alias("home"))
        state = stored(
            state.join(sent, ["kind", "host"], "left").join(F.broadcast(left), "kind").select(
                "kind", "host", "seed", F.col("rank").alias("before"),
                (F.coalesce("got", F.lit(0.0)) + F.col("seed") * F.col("home")).alias("rank")), "ranks")
        # a host once reached stays reached: when none is new, none will be
        further = (F.col("before") == 0) & (F.col("rank") > 0)
        moves = F.abs(F.col("rank") - F.col("before")) > F.col("rank") * precision + _TINY
        if state.where(further | moves).isEmpty():
            break
    value = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(F.lit(0.0)))
    return state.groupBy("host").agg(value("trust").alias("trust"), value("distrust").alias("distrust"))


def verdicts(pages: DataFrame, rules, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             threshold: float = THRESHOLD, damping: float = DAMPING, turns: int | None = TURNS,
             precision: float = PRECISION) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, trust and distrust of its host.

    The longest fitting rule decides. Other pages follow their host: it is blocked if
    distrust / (trust + distrust) is at least ``threshold``; hosts that neither reaches
    are allowed. A url that is null or has no ``://`` has an empty host and path, which no
    link reaches and which is never a seed. Null or empty html has no links. Repeated
    rows are judged alike (each counts as a page); an empty table gives no rows; other
    columns are ignored.
    """
    host, path = host_of(col(url_col)), path_of(col(url_col))
    placed = pages.select(col(id_col).alias("id"), host.alias("host"), path.alias("path"),
                          col(html_col).alias("html"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = placed.select("id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    pages_of = lambda v: F.sum((F.col("by_rule") == v).cast("long"))
    seeds = judged.where("by_rule IS NOT NULL AND host <> ''").groupBy("host").agg(
        pages_of("allow").alias("trusted"), pages_of("block").alias("blocked"))
    ranks = propagate(host_links(placed), seeds, damping, turns, precision)
    share = F.col("distrust") / (F.col("trust") + F.col("distrust"))
    by_host = ranks.select("host", "trust", "distrust", F.when(
        (F.col("trust") + F.col("distrust") > 0) & (share >= threshold), F.lit("block")).otherwise(F.lit("allow"))
        .alias("by_host"))
    return judged.join(by_host, "host", "left").select(
        "id", "host", "path", "rule", F.coalesce("by_rule", "by_host", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
