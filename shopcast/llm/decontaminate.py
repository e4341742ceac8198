"""Benchmark decontamination by spaced seeds (operator 1).

A seed is a fixed mask over word positions; its hash covers the words under
the ones and ignores the others, so a substituted word under a zero doesn't
break it.  Seeds of all benchmark items and of all document positions are
joined by hash.  A hit gives a diagonal: item and document aligned at one
offset.  On each diagonal the words are then compared one by one, and the
document counts as contaminated by the item if a window of ``window`` words
(or the whole item, if shorter) has at most ``misses`` different ones, in
proportion for a shorter item.  The masks leave out no such overlap: for each
length and each choice of different words at least one mask has an offset at
which all its ones are on equal words (``uncovered`` enumerates them, and
``Seeds`` refuses masks that leave any).  Items shorter than the window have
masks of their own, which are hashed only if the benchmark has such items;
those of four words and less must stand in the document whole.

All of it is DataFrame functions.  The only wide steps are the join of
document seeds with benchmark seeds, whose benchmark side is broadcast if a
count shows that it is small and shuffled with the documents' seeds
otherwise, and the join of the few hits with their documents.

Defined results: words are runs of letters and digits, lower-cased; a null
or wordless text is clean; null and wordless items match nothing; rows
that share an id (null included) get the union of their matches, one result
row for each input row; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopcast.llm.common import table

#: Seeds of 16 bytes that are broadcast at most (64 MB); more are shuffled.
BROADCAST_SEEDS = 4_000_000


@dataclass(frozen=True)
class Seeds:
    """``short``: (least words, masks) for items shorter than the window."""

    masks: tuple[str, ...] = ("11011011", "1100101011", "110111", "110100011")
    window: int = 13
    misses: int = 3
    short: tuple[tuple[int, tuple[str, ...]], ...] = (
        (9, ("11101", "100111")), (6, ("1111", "110011")), (5, ("111", "1101")),
        (4, ("1111",)), (3, ("111",)), (2, ("11",)), (1, ("1",)))

    def __post_init__(self) -> None:
        for span in range(1, self.window + 1):
            if left := uncovered(self.masks_for(span), span, self.allowed(span)):
                raise ValueError(f"no mask for {span} words that differ at {left[0]}")

    def allowed(self, span: int) -> int:
        return span * self.misses // self.window

    def masks_for(self, span: int) -> tuple[str, ...]:
        """Masks of items with ``span`` words (the window for longer ones)."""
        fit = [(least, masks) for least, masks in self.short if least <= span]
        return self.masks if span >= self.window or not fit else max(fit)[1]


def uncovered(masks: tuple[str, ...], span: int, misses: int) -> list[tuple[int, ...]]:
    """The choices of ``misses`` different words among ``span`` that break
    all masks at all offsets."""
    ones = [{i + k for k, m in enumerate(mask) if m == "1"}
            for mask in masks for i in range(span - len(mask) + 1)]
    return [p for p in combinations(range(span), misses) if not any(x.isdisjoint(p) for x in ones)]


def words(text: Column) -> Column:
    """Lower-cased words as an array; empty for null and wordless texts."""
    flat = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _seeds(hashes: str, mask: str) -> Column:
    """Array of the mask's hash at each position of an array of hashes."""
    used = [i for i, m in enumerate(mask) if m == "1"]
    at = F.sequence(F.lit(0), F.size(hashes) - F.lit(len(mask)))
    found = F.transform(at, lambda i: F.xxhash64(F.lit(mask), *[F.get(F.col(hashes), i + k) for k in used]))
    return F.when(F.size(hashes) >= len(mask), found).otherwise(F.array().cast("array<bigint>"))


def seeds(frame: DataFrame, key: str, hashes: str, masks: tuple[str, ...]) -> DataFrame:
    """(key, at, seed) for all positions of all rows; the hash has the mask in it."""
    each = F.array(*[_seeds(hashes, m) for m in masks])
    by_mask = frame.select(key, F.explode(each).alias("found"))
    return by_mask.select(key, F.posexplode("found").alias("at", "seed"))


def _best(equal: Column, window: Column) -> Column:
    """Most equal words in any window of an array of 0 and 1."""
    starts = F.sequence(F.lit(1), F.size(equal) - window + 1)
    return F.array_max(F.transform(starts, lambda i: F.aggregate(
        F.slice(equal, i, window), F.lit(0), lambda a, x: a + x)))


def matches(docs: DataFrame, items: DataFrame, rule: Seeds = Seeds()) -> DataFrame:
    """(id, item, same, length) of verified overlaps; ``docs`` as (id, t),
    ``items`` as (item, t)."""
    small = table(items.filter("item is not null").select("item", word_hashes(F.col("t")).alias("iw")),
                  "items")
    span = F.least(F.lit(rule.window), F.size("iw"))
    spans = [r.span for r in small.select(span.alias("span")).distinct().filter("span > 0").collect()]
    by_masks: dict[tuple[str, ...], list[int]] = {}
    for n in spans or [rule.window]:
        by_masks.setdefault(rule.masks_for(n), []).append(n)
    parts = [seeds(small.filter(span.isin(of)), "item", "iw", masks) for masks, of in by_masks.items()]
    wanted = reduce(DataFrame.unionByName, parts).select("item", F.col("at").alias("ia"), "seed").distinct()
    wanted = table(wanted, "itemseeds")
    if wanted.count() <= BROADCAST_SEEDS:
        wanted = F.broadcast(wanted)
    found = seeds(docs.select("id", word_hashes(F.col("t")).alias("dw")), "id", "dw",
                  tuple(sorted({m for masks in by_masks for m in masks})))
    hits = table(found.join(wanted, "seed").select(
        "id", "item", (F.col("at") - F.col("ia")).alias("diag")).distinct(), "hits")
    texts = docs.join(hits.select(F.col("id").alias("hid")).distinct(), F.col("id").eqNullSafe(F.col("hid")),
                      "left_semi").select(F.col("id").alias("did"), word_hashes(F.col("t")).alias("dw"))
    both = (hits.join(texts, F.col("id").eqNullSafe(F.col("did"))).join(small, "item"))
    at = F.sequence(F.lit(0), F.size("iw") - 1)
    equal = F.transform(at, lambda i: F.when(F.get("iw", i) == F.get("dw", i + F.col("diag")), 1).otherwise(0))
    allowed = F.floor(span * F.lit(rule.misses) / F.lit(rule.window))
    return (both.select("id", "item", "iw", equal.alias("equal"), span.alias("span"), allowed.alias("allowed"))
            .filter(_best(F.col("equal"), F.col("span")) >= F.col("span") - F.col("allowed"))
            .select("id", "item", F.aggregate("equal", F.lit(0), lambda a, x: a + x).alias("same"),
                    F.size("iw").alias("length")))


def contamination(docs: DataFrame, items: DataFrame, rule: Seeds = Seeds(), id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, contaminated, n_items, item_ids, most_same) for each row."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    bench = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("t"))
    found = matches(source, bench, rule).groupBy("id").agg(
        F.array_sort(F.collect_set("item")).alias("item_ids"), F.max("same").alias("most_same"))
    found = found.withColumnRenamed("id", "fid")
    out = source.select("id").join(found, F.col("id").eqNullSafe(F.col("fid")), "left")
    kind = bench.schema["item"].dataType.simpleString()
    none = F.array().cast(f"array<{kind}>")
    return out.select(F.col("id").alias(id_col), F.col("item_ids").isNotNull().alias("contaminated"),
                      F.coalesce(F.size("item_ids"), F.lit(0)).cast("bigint").alias("n_items"),
                      F.coalesce("item_ids", none).alias("item_ids"),
                      F.coalesce("most_same", F.lit(0)).alias("most_same"))


def clean_only(docs: DataFrame, items: DataFrame, rule: Seeds = Seeds(), id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a verified overlap, columns unchanged."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    bench = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("t"))
    bad = matches(source, bench, rule).select(F.col("id").alias("__bad")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["__bad"]), "left_anti")
