"""URL filters by rules and a path-template tree (operator 10).

Rules decide first.  All other URLs are judged by the template that their
path falls into.  For each host the tree of path segments is walked from
the root down, a fixed number of levels:

* a segment is variable if it looks like one (numbers, long hex, dates) or
  if its parent has many different children of which this is a rare one;
  variable segments become the wildcard ``*``;
* sibling branches whose labelled shares do not differ statistically (a
  two-sided test of proportions against the parent) are merged into ``*``,
  equal shares of 0 or 1 included;
* a template's purity is its labelled bad share, smoothed to the share of
  its host, which is itself smoothed to the share of the whole table, so a
  small branch goes with its host; templates over the limit are rejected.

Labels are what the rules decide, and hosts with a word of ``bad_words`` as
a label of their name or as a hyphen part of one count as bad as a whole:
their share starts from 1, whatever their size.  More labelled URLs can be
passed in.  All of it is
DataFrame functions: URLs are first combined to distinct (host, segments)
with counts, so a hot host or template is summed before any shuffle, and
each level is one aggregate and one join.

Defined results: a null URL or one without ``://`` has empty host and path
and the verdict of an unknown template, ``allow``; rows are judged one by
one, so repeated rows and null ids come out as they went in; an empty table
gives an empty result; ties between rules go to the first in the list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopcast.llm.common import table

# Fixed values: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Segments that are variable by their looks.
VARIABLE = r"^([0-9]+([._-][0-9a-z]+)*|[0-9a-f]{8,}|.*[0-9]{4,}.*|.{40,})$"


@dataclass(frozen=True)
class Tree:
    depth: int = 4
    many_children: int = 50
    rare_share: float = 0.02
    z: float = 1.96
    prior_rows: float = 5.0
    reject: float = 0.8
    bad_words: tuple[str, ...] = ("spam", "casino", "pills", "viagra", "porn", "xxx", "payday", "bets")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest fitting rule; null without one."""
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    name = verdict = F.lit(None).cast("string")
    for what, h, p in reversed(ranked):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name = F.when(fits, h + p).otherwise(name)
        verdict = F.when(fits, what).otherwise(verdict)
    return name, verdict


def named_bad(host: Column, tree: Tree) -> Column:
    """Whether a label of the host, or a hyphen part of one, is a bad word."""
    if not tree.bad_words:
        return F.lit(False)
    return host.rlike(f"(?<![a-z0-9])({'|'.join(tree.bad_words)})(?![a-z0-9])")


def _segments(path: Column, depth: int) -> Column:
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    parts = F.transform(parts, lambda s: F.when(s.rlike(VARIABLE), "*").otherwise(s))
    return F.when(F.size(parts) > depth, F.concat(F.slice(parts, 1, depth), F.array(F.lit("**")))).otherwise(parts)


def template_tree(urls: DataFrame, tree: Tree) -> DataFrame:
    """(host, segments, template, purity) for urls given as distinct (host,
    segments) with n rows, ``good`` and ``bad`` labelled ones."""
    now = urls.withColumn("template", F.lit(""))
    for level in range(1, tree.depth + 2):
        seg = F.get("segments", F.lit(level - 1))
        here = now.withColumn("seg", seg)
        nodes = here.filter("seg is not null").groupBy("host", "template", "seg").agg(
            *(F.sum(c).alias(c) for c in ("n", "good", "bad")))
        parent = nodes.groupBy("host", "template").agg(
            F.sum("n").alias("pn"), F.sum("good").alias("pg"), F.sum("bad").alias("pb"),
            F.count(F.lit(1)).alias("children"), F.count_if(F.col("good") + F.col("bad") > 0).alias("labelled"))
        joined = nodes.join(parent, ["host", "template"])
        rare = (F.col("children") >= tree.many_children) & (F.col("n") <= tree.rare_share * F.col("pn"))
        known = F.col("good") + F.col("bad")
        p = F.try_divide("pb", F.col("pg") + F.col("pb"))
        apart = F.abs(F.try_divide("bad", known) - p) > tree.z * F.sqrt(F.try_divide(p * (1 - p), known))
        alike = (F.col("labelled") >= 2) & (known > 0) & ~apart
        step = joined.select("host", "template", "seg", F.when(
            F.coalesce(rare | alike, F.lit(False)), "*").otherwise(F.col("seg")).alias("to"))
        now = (here.join(step, ["host", "template", "seg"], "left")
               .withColumn("template", F.when(F.col("seg").isNull(), F.col("template"))
                           .otherwise(F.concat("template", F.lit("/"), F.coalesce("to", "seg"))))
               .drop("seg", "to"))
        now = table(now, f"level{level}")
    sums = now.groupBy("host", "template").agg(F.sum("good").alias("tg"), F.sum("bad").alias("tb"))
    share = urls.agg(F.coalesce(F.sum("bad") / F.nullif(F.sum("bad") + F.sum("good"), F.lit(0)),
                                F.lit(0.0)).alias("share"))
    k = F.lit(tree.prior_rows)
    hosts = sums.groupBy("host").agg(F.sum("tg").alias("hg"), F.sum("tb").alias("hb"))
    start = F.when(named_bad(F.col("host"), tree), 1.0).otherwise(F.col("share"))
    hosts = hosts.crossJoin(F.broadcast(share)).select(
        "host", ((F.col("hb") + k * start) / (F.col("hb") + F.col("hg") + k)).alias("of_host"))
    purity = sums.join(hosts, "host").select(
        "host", "template", ((F.col("tb") + k * F.col("of_host")) / (F.col("tb") + F.col("tg") + k)).alias("purity"),
        (F.col("tb") + F.col("tg")).alias("labelled"))
    return now.join(purity, ["host", "template"]).select("host", "segments", "template", "purity", "labelled")


def url_verdicts(pages: DataFrame, rules=RULES, tree: Tree = Tree(), labels: DataFrame | None = None,
                 id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, template, purity) for each row;
    ``labels`` may add (url, bad 0/1)."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    if labels is not None:
        marked = labels.groupBy(F.col("url").alias("lurl")).agg(F.max("bad").cast("int").alias("given"))
        parsed = parsed.join(marked, F.col("url") == F.col("lurl"), "left").drop("lurl")
    else:
        parsed = parsed.withColumn("given", F.lit(None).cast("int"))
    parsed = parsed.select("id", "given", host.alias("host"), path.alias("path"))
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumns({"rule": rule, "ruled": verdict, "segments": _segments(F.col("path"), tree.depth)})
    named = named_bad(F.col("host"), tree)
    bad = F.when(F.col("given").isNotNull(), F.col("given") == 1).when(named, F.lit(True)).when(
        F.col("ruled").isNotNull(), F.col("ruled") == "block")
    parsed = table(parsed.withColumn("is_bad", bad), "urls")
    distinct = table(parsed.groupBy("host", "segments").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_bad")).alias("good"),
        F.count_if(F.col("is_bad")).alias("bad")), "paths")
    found = table(template_tree(distinct, tree), "templates")
    out = parsed.join(found, ["host", "segments"], "left")
    own = F.when((F.col("labelled") > 0) & (F.col("purity") >= tree.reject) & (F.col("host") != ""),
                 "block").otherwise("allow")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule",
                      F.coalesce("ruled", own).alias("verdict"), "template", "purity")
