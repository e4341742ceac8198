"""Mixing sources to target weights (operator 5).

Temperature mixing: the weight of a source is its token share to the power
``exponent``, normalised.  The exponent is found by bisection: the smallest
one whose weights have at most the target entropy and repeat no source more
often than the limit (0 mixes evenly, 1 keeps the shares, more sharpens
them, up to ``SHARPEST``).  Where no exponent does both (equal shares can't
be sharpened, a budget may ask for more epochs than the limit) it is 1: the
shares as they are.
The weights are realised over a token budget as permutations of blocks:
documents fall into blocks by hash; an epoch of a source is all its blocks
in an order of that epoch; a source gives as many whole epochs as its
weight asks for and of the last one the leading blocks.  The block at the
edge is cut in the same way into sub-blocks.
The sources are interleaved: the place of a draw is the share of its
source's drawn tokens that come before it, so every stretch of the order
holds the sources by their weights.  A block begins where the blocks before
it end; within it, documents are dealt by hash.

Only (id, source, tokens) rows are kept from the texts, sums by source and
by (source, epoch, block) are combined before the shuffle, and windows see at
most 1024 rows a source and epoch, so a source that holds a third of all
rows is no special case.  The source table stays a table; each bisection step brings
back a few sums.

Defined results: a null source is a source of its own; a null text has no
tokens, and documents without tokens go along with their block; a source
without any tokens has weight 0 and gives no draws; rows are drawn one by
one, repeated rows and rows without an id fall into one block and tie in
their place; texts of any length are counted whole; an empty table gives no
draws; other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopcast.llm.common import WORD, table

BLOCKS = 1024
#: The largest exponent that is tried.
SHARPEST = 64.0


@dataclass(frozen=True)
class Mix:
    """``entropy``: target as a share of the entropy of even weights;
    ``epochs``: most often that a source may be repeated; ``budget``: tokens
    to draw, by default as many as there are."""

    entropy: float = 0.97
    epochs: float = 4.0
    budget: int | None = None
    seed: int = 17


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def exponent(sources: DataFrame, mix: Mix, budget: float, steps: int = 40) -> float:
    """The bisected exponent for sources given as (source, tokens)."""
    shares = sources.filter("tokens > 0")
    n, total = shares.agg(F.count(F.lit(1)), F.sum("tokens")).first()
    if not n or n == 1:
        return 1.0
    p = F.col("tokens") / F.lit(float(total))
    target = mix.entropy * math.log(n)

    def measured(points: list[float]) -> list[tuple[bool, bool]]:
        """Entropy and repetition limit met, for some exponents in one job."""
        sums = []
        for a in points:
            w = F.pow(p, F.lit(a))
            sums += [F.sum(w), F.sum(w * F.log(p)), F.max(w / F.col("tokens"))]
        row = shares.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        out = []
        for i, a in enumerate(points):
            z, zl, most = row[3 * i], row[3 * i + 1], row[3 * i + 2]
            out.append((math.log(z) - a * zl / z <= target + 1e-12, most / z * budget <= mix.epochs * (1 + 1e-12)))
        return out

    def bisected(low: float, high: float, holds) -> float:
        """The smallest exponent that holds, given that ``high`` does."""
        k = 4  # levels in one job
        for _ in range(-(-steps // k)):
            points = [low + (high - low) * j / 2 ** k for j in range(1, 2 ** k)]
            good = [holds(m) for m in measured(points)]
            j = good.index(True) if True in good else len(points)
            low, high = ([low] + points)[j], (points + [high])[j]
        return high

    ends = [0.0, 1.0] + [2.0 ** k for k in range(1, int(math.log2(SHARPEST)) + 1)]
    found = measured(ends)
    if all(found[0]):
        return 0.0
    if all(found[1]):
        return bisected(0.0, 1.0, all)
    # sharper than the shares: entropy falls on, but the largest source comes up
    at = next((i for i in range(2, len(ends)) if found[i][0]), None)
    if at is None or found[1][0]:
        return 1.0
    a = bisected(ends[at - 1], ends[at], lambda m: m[0])
    return a if all(measured([a])[0]) else 1.0


def weights(counted: DataFrame, mix: Mix) -> DataFrame:
    """(source, tokens, weight, exponent, whole, rest): whole epochs and the
    tokens wanted of the next one."""
    sources = table(counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = float(mix.budget if mix.budget is not None else total)
    a = exponent(sources, mix, budget)
    p = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(a))).otherwise(0.0)
    z = sources.agg(F.sum(p)).first()[0] or 1.0
    want = F.col("weight") * F.lit(budget)
    out = sources.withColumn("weight", p / F.lit(z)).withColumn("exponent", F.lit(a))
    whole = F.when(F.col("tokens") > 0, F.floor(want / F.col("tokens") + F.lit(1e-9))).otherwise(0).cast("int")
    return table(out.withColumn("whole", whole).withColumn(
        "rest", F.greatest(want - F.col("whole") * F.col("tokens"), F.lit(0.0))), "weights")


def _prefix(frame: DataFrame, part: str, seed: int) -> DataFrame:
    """Running token sums before each part in the order of the last epoch."""
    order = F.xxhash64(F.lit(seed), F.col("whole"), F.col(part))
    w = Window.partitionBy("sid").orderBy(order, part)
    return frame.withColumn("before", F.sum("part_tokens").over(w) - F.col("part_tokens"))


def draws(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """(id, source, n_tokens, weight, exponent, epoch, block, place): one row
    for each time a document is drawn; reading by place (0 .. 1) gives the
    mixed order."""
    h = F.xxhash64(F.lit(mix.seed), F.col("id"))
    counted = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                          tokens(F.col(text_col)).alias("n_tokens"))
    counted = table(counted.withColumn("block", F.pmod(h, F.lit(BLOCKS)).cast("int")).withColumn(
        "sub", F.pmod(F.shiftright(h, 20), F.lit(BLOCKS)).cast("int")), "counted")
    plan = weights(counted, mix).withColumn("sid", F.xxhash64("source"))
    plan = plan.withColumnRenamed("source", "psource")
    rows = counted.join(plan, F.col("source").eqNullSafe(F.col("psource"))).drop("psource")

    blocks = rows.groupBy("sid", "whole", "rest", "block").agg(F.sum("n_tokens").alias("part_tokens"))
    blocks = table(_prefix(blocks, "block", mix.seed).filter("before < rest").select(
        "sid", "block", (F.col("before") + F.col("part_tokens") <= F.col("rest")).alias("all_in"),
        (F.col("rest") - F.col("before")).alias("left")), "blocks")
    subs = (rows.join(blocks.filter("not all_in"), ["sid", "block"])
            .groupBy("sid", "whole", "block", "left", "sub").agg(F.sum("n_tokens").alias("part_tokens")))
    subs = (_prefix(subs, "sub", mix.seed + 1).filter(F.col("before") + F.col("part_tokens") <= F.col("left"))
            .select("sid", "block", "sub"))
    chosen = (rows.join(blocks.filter("all_in").select("sid", "block", "all_in"), ["sid", "block"], "left")
              .join(subs.withColumn("part_in", F.lit(True)), ["sid", "block", "sub"], "left"))
    more = F.coalesce("all_in", "part_in", F.lit(False)).cast("int")
    last = F.col("whole") + more - 1
    each = chosen.filter(last >= 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), last)))
    spans = each.groupBy("sid", "epoch", "block").agg(F.sum("n_tokens").alias("span"))
    order = Window.partitionBy("sid").orderBy("epoch", F.xxhash64(F.lit(mix.seed), F.col("epoch"), F.col("block")), "block")
    spans = (spans.withColumn("begin", F.sum("span").over(order) - F.col("span"))
             .withColumn("drawn", F.sum("span").over(Window.partitionBy("sid"))))
    inside = F.shiftright(F.xxhash64(F.lit(mix.seed), F.col("id"), F.col("epoch")), 11) / F.lit(2.0 ** 53) + F.lit(0.5)
    place = F.when(F.col("drawn") > 0, (F.col("begin") + inside * F.col("span")) / F.col("drawn")).otherwise(inside)
    return each.join(spans, ["sid", "epoch", "block"]).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "n_tokens", "weight", "exponent",
        F.col("epoch").cast("int").alias("epoch"), "block", place.alias("place"))
