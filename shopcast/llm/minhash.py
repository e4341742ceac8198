"""Near-duplicate documents by bottom-k sketches (operator 3).

One hash function over word shingles; a document keeps the k smallest
values of its shingle set.  Steps:

1. ``sketches``: one pass over the texts gives each document's set size, a
   fingerprint of the whole set and the sketch.  Documents with equal sets
   form a class; only the smallest id of a class goes on.
2. Inverted lists: value -> classes that retained it.  Two sets with
   J >= t share at least ``need`` of the retained values (``_need``), so
   with values in a common order, rare ones first, each class is listed
   only under its first ``size - need + 1`` values.  Passages that many
   documents share are frequent, come last and mostly aren't listed.
3. Star pass: in each list every class is paired with one centre only, the
   class whose sketch has the most frequent values.  Pairs pass an estimate
   from the sketch of the union, then exact Jaccard of the full sets.
   A group of near copies is joined here with as many pairs as members.
4. Cross pass: classes of lists that the star pass has not put into one
   component are listed anew by their full sets, where the bounds are exact
   and sharp.  These lists get a star pass of their own; then pairs that
   still are in different components are filtered and verified as well.
5. Components of all verified links and of the classes' members.

Pairs that are already connected need no check of their own for the
result, and all others that the lists generate are checked, with no cap on
list length or partners.  The candidate step misses a pair with J >= 0.75
only if fewer than 31 of the 64 smallest values of the union are common;
for J = 0.75 the chance is below 2e-6, and smaller for nearer pairs.

Defined results: null or wordless texts have an empty set, link with
nothing and come back as their own component; a null id comes back with a
null component and is kept; rows that share an id are one document, whose
sets all count for its links; each input row gives one result row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopcast.llm.common import components, map_arrow, table
from shopcast.llm.words import U64, Words, buffers, groups, ngram_hash

SHINGLE_WORDS = 5
#: Percent of the union that the intersection must reach.
SIMILARITY_PERCENT = 75
#: Values that a sketch retains, and how many of them a pair at the
#: similarity above shares but for a chance of about 1e-6 (48 expected,
#: standard deviation 3.5).
SKETCH = 64
SHARED = 31


def shingle_sets(column: pa.Array, size: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The distinct shingles of each text as sorted 63-bit hashes."""
    data, offsets = buffers(column)
    for i, j in groups(offsets):
        w = Words(data, offsets[i:j + 1], lower=True)
        full = ngram_hash(w.hash, size) >> U64(1)
        for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
            if b - a >= size:
                yield np.unique(full[a:b - size + 1])
            elif b > a:
                yield ngram_hash(w.hash[a:b], b - a) >> U64(1)
            else:
                yield full[:0]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, U64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64)))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             k: int = SKETCH) -> DataFrame:
    """(id, n, set_key, sketch) of each document; ``set_key`` identifies the
    whole set (null for an empty one), ``sketch`` is ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, tops = [], [], []
            for s in shingle_sets(batch.column(1)):
                n.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None)
                tops.append(s[:k])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.string()), _lists(tops)],
                ["id", "n", "set_key", "sketch"])

    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t"))
    return map_arrow(source, run, "id bigint, n bigint, set_key string, sketch array<bigint>")


def full_sets(docs: DataFrame) -> DataFrame:
    """(id, shingles) of documents given as (id, t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[np.ndarray] = []
            for s in shingle_sets(batch.column(1)):
                held.append(s)
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(held)], ["id", "shingles"])

    return map_arrow(docs.select("id", "t"), run, "id bigint, shingles array<bigint>")


def _need():
    """Retained values that a class shares with any class it links with: for
    sets that the sketch holds whole, the similarity itself says so."""
    whole = F.ceil(F.col("n") * SIMILARITY_PERCENT / 100)
    return F.when(F.col("n") <= SKETCH * 3 // 4, whole).otherwise(F.lit(SHARED)).cast("int")


def _listed(sized: DataFrame, values: str) -> DataFrame:
    """(value, id, n, m, place, weight): the values of each row of (id, n, m,
    need, values) that it must be listed under, rare values first.

    Two rows that share ``need`` of their ``m`` values share one of their
    first ``m - need + 1`` in any common order.  ``place`` counts from 1;
    values that no other row has come first and need no list.  ``weight``
    is the centrality, the sum of the frequencies of all shared values.
    """
    each = sized.select("id", "n", "m", "need", F.explode(values).alias("value"))
    # counted before the shuffle and joined back, so that a hot value's rows can be split
    shared = each.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    mine = Window.partitionBy("id")
    ranked = (each.join(shared, "value").withColumn("single", F.col("m") - F.count(F.lit(1)).over(mine))
              .withColumn("weight", F.sum("df").over(mine))
              .withColumn("place", F.col("single") + F.row_number().over(mine.orderBy("df", "value"))))
    return ranked.filter("place <= m - need + 1").select("value", "id", "n", "m", "place", "weight")


def postings(classes: DataFrame) -> DataFrame:
    """Inverted lists of the retained values."""
    return _listed(classes.select("id", "n", F.size("sketch").alias("m"), _need().alias("need"), "sketch"),
                   "sketch").select("value", "id", "n", "weight")


def open_lists(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """(value, id, n, most, weight): lists of classes that may still be
    similar to one of another component.

    ``placed`` are the sketch lists with components.  Only members of lists
    with several components are unsettled; for these the prefix bound is
    taken on the full sets, where it is exact: a class is listed under its
    first ``n - 0.75 n + 1`` shingles, and a value at place i can be the
    first common one only for partners of at most ``most`` shingles, as too
    few values follow.  So classes that share much but not enough, such as
    copies with many edits, leave the lists before any pair is formed.
    """
    mixed = placed.groupBy("value").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y")
    loose = table(placed.join(mixed, "value", "left_semi").select("id", "comp").distinct(), "unsettled")
    sized = sets.join(loose, "id").withColumn("n", F.size("shingles"))
    need = F.ceil(F.col("n") * SIMILARITY_PERCENT / 100)
    lists = _listed(sized.select("id", "n", F.col("n").alias("m"), need.alias("need"), "shingles"), "shingles")
    # overlap * (1 + t) >= t * (n + partner), at most n - place + 1 can follow
    most = F.floor((F.col("n") - F.col("place") + 1) * (100 + SIMILARITY_PERCENT) / SIMILARITY_PERCENT) - F.col("n")
    lists = table(lists.select("value", "id", "n", most.alias("most"), "weight").join(loose, "id"), "fulllists")
    bounds = lists.groupBy("value").agg(F.min("n").alias("least"), F.min("comp").alias("x"),
                                        F.max("comp").alias("y")).filter("x < y")
    return table(lists.join(bounds.select("value", "least"), "value").filter("most >= least").drop("least", "comp"),
                 "open")


def star_pairs(lists: DataFrame) -> DataFrame:
    """Pairs (a, b) of each list's members with its most central one."""
    centre = lists.groupBy("value").agg(F.max(F.struct("weight", F.col("id"), F.col("n"))).alias("c"))
    return (lists.join(centre, "value").filter(F.col("id") != F.col("c.id")).filter(_similar_sizes("n", "c.n"))
            .select(F.least("id", "c.id").alias("a"), F.greatest("id", "c.id").alias("b")).distinct())


def in_components(lists: DataFrame, links_: DataFrame) -> DataFrame:
    comp = components(links_).withColumnRenamed("node", "id")
    return lists.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def _with_partners(lists: DataFrame) -> DataFrame:
    """Rows of open lists with ``comp`` that their list offers a partner:
    some other component has a class small enough for the row, and some
    other one may reach its size.  Two ends of each kind, of different
    components, decide this without looking at pairs."""
    per = lists.groupBy("value", "comp").agg(F.min("n").alias("lo"), F.max("most").alias("hi"))
    ends = per.groupBy("value").agg(F.min(F.struct("lo", "comp")).alias("low"),
                                    F.max(F.struct("hi", "comp")).alias("high"))
    ends = per.join(ends, "value").groupBy("value").agg(
        F.first("low").alias("low"), F.first("high").alias("high"),
        F.min(F.expr("CASE WHEN comp <> low.comp THEN lo END")).alias("lo2"),
        F.max(F.expr("CASE WHEN comp <> high.comp THEN hi END")).alias("hi2"))
    smallest = F.when(F.col("comp") != F.col("low.comp"), F.col("low.lo")).otherwise(F.col("lo2"))
    furthest = F.when(F.col("comp") != F.col("high.comp"), F.col("high.hi")).otherwise(F.col("hi2"))
    return (lists.join(ends, "value").filter((F.col("most") >= smallest) & (F.col("n") <= furthest))
            .select("value", "id", "n", "most", "comp"))


def cross_pairs(lists: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components in open lists with ``comp``.

    Blocks of equal list, component and set size are compared first, so
    that members are looked up only where the sizes suit the bounds.
    """
    lists = table(_with_partners(lists), "partners")
    blocks = lists.groupBy("value", "comp", "n").agg(F.max("most").alias("most"))
    x, y = blocks.alias("x"), blocks.alias("y")
    cross = x.join(y, (F.col("x.value") == F.col("y.value")) & (F.col("x.comp") < F.col("y.comp"))
                   & (F.col("x.n") <= F.col("y.most")) & (F.col("y.n") <= F.col("x.most"))).select(
        F.col("x.value").alias("value"), F.col("x.comp").alias("ca"), F.col("x.n").alias("na"),
        F.col("y.comp").alias("cb"), F.col("y.n").alias("nb")).alias("c")
    same = lambda m, s: ((F.col("c.value") == F.col(f"{m}.value")) & (F.col("c.c" + s) == F.col(f"{m}.comp"))
                         & (F.col("c.n" + s) == F.col(f"{m}.n")))
    return (cross.join(lists.alias("p"), same("p", "a") & (F.col("c.nb") <= F.col("p.most")))
            .join(lists.alias("q"), same("q", "b") & (F.col("c.na") <= F.col("q.most")))
            .select(F.least("p.id", "q.id").alias("a"), F.greatest("p.id", "q.id").alias("b")).distinct())


def _similar_sizes(a: str, b: str):
    return F.least(a, b) * 100 >= F.greatest(a, b) * SIMILARITY_PERCENT


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose union sketch has enough common values."""
    s = classes.select("id", "n", "sketch")
    both = (pairs.join(s.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
            .join(s.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
    both = both.select("a", "b", "na", "nb", F.array_intersect("sa", "sb").alias("common"),
                       union.alias("top"))
    in_both = F.size(F.array_intersect("top", "common"))
    # when the union has no more than the sketch holds, the share is exact
    exact = F.col("na") + F.col("nb") - F.size("common") <= SKETCH
    return both.filter(F.when(exact, in_both * 100 >= F.size("top") * SIMILARITY_PERCENT)
                       .otherwise(in_both >= SHARED)).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    both = (pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
            .join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a"))
    common = F.size(F.array_intersect("x", "y"))
    return both.select("a", "b", common.alias("c"), F.size("x").alias("p"), F.size("y").alias("q")).filter(
        F.col("c") * 100 >= (F.col("p") + F.col("q") - F.col("c")) * SIMILARITY_PERCENT).select("a", "b")


def links(docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """Verified links (a, b) that connect what belongs together."""
    reps = sketched.filter("n > 0 and id is not null").groupBy("set_key").agg(F.min("id").alias("id"))
    members = (sketched.filter("n > 0 and id is not null").select(F.col("id").alias("b"), "set_key")
               .join(reps.withColumnRenamed("id", "a"), "set_key").filter("a <> b").select("a", "b"))
    classes = table(sketched.join(reps, ["set_key", "id"]).dropDuplicates(["set_key"])
                    .select("id", "n", "sketch"), "classes")
    lists = table(postings(classes), "postings")
    wanted = lists.select("id").distinct()
    sets = table(full_sets(docs.join(wanted, "id", "left_semi")), "sets")

    first = table(verified(likely(star_pairs(lists), classes), sets), "starlinks")
    left = open_lists(table(in_components(lists, first), "placed"), sets)
    done = first.select("a", "b")
    again = star_pairs(left).join(done, ["a", "b"], "left_anti")
    second = table(verified(likely(again, classes), sets), "openlinks")
    placed = table(in_components(left, first.unionByName(second)), "openplaced")
    third = verified(likely(cross_pairs(placed), classes), sets)
    return table(members.unionByName(first).unionByName(second).unionByName(third), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per input row."""
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t"))
    sketched = table(sketches(docs, id_col, text_col), "sketches")
    comp = components(links(source, sketched))
    out = sketched.select("id", "n").join(comp.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("comp", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` but for those that a smaller id stands for."""
    gone = (near_duplicates(docs, id_col, text_col).filter("not kept")
            .select(F.col(id_col).alias("__gone")).distinct())
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
