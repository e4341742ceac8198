"""Exact duplicates with a heavy-hitter split (operator 12).

Two texts are equal if they are the same after deleting white space
(space and the control characters 9 to 13); the digest is SHA-256 of what
is left.  Of equal texts the longest original stays, then the smallest id.

1. Ids, lengths and digests are written as a narrow table.
2. Misra-Gries counters (Spark's frequent-items aggregate, kept for each
   partition and merged) name at most ``capacity`` digests; every digest of
   more than 1 / capacity of the rows is among them.
3. A second pass over the table verifies them: their exact group sizes and
   winners, combined on the map side.  At most ``capacity`` rows of about
   100 bytes are broadcast, whatever the corpus holds.
4. Rows of these digests get their group by that broadcast join and never
   meet a shuffle.  The others are dealt by digest; none of their groups
   has more than 1 / capacity of the rows.

DataFrame functions only.

Defined results: a null text counts as empty, so null, empty and blank
texts are one group; a null id comes after all others; of rows that agree
in length and id exactly one is kept, and all of them name the same
``keep_id``; texts of any length are digested whole; an empty table gives
an empty result; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopcast.llm.common import table

#: Misra-Gries counters, which is also the most rows that are broadcast.
CAPACITY = 1000
#: What is deleted before texts are compared.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def without_blanks(text: Column) -> Column:
    for c in BLANKS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, digest, row): code points of the original, digest, row number."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.length(text).cast("long").alias("n"),
                       F.sha2(without_blanks(text), 256).alias("digest"),
                       F.monotonically_increasing_id().alias("row"))


def frequent(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(digest): at most ``capacity`` of them, every one of more than
    1 / capacity of the rows among them."""
    found = rows.stat.freqItems(["digest"], 1 / capacity)
    return found.select(F.explode("digest_freqItems").alias("digest"))


def _best() -> Column:
    """Orders the rows of a group: longest first, then smallest id."""
    return F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("no"),
                    F.col("id").alias("id"), F.col("row").alias("row"))


def verified(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """(digest, size, best) of the candidates that have copies, counted exactly."""
    own = rows.join(F.broadcast(candidates), "digest", "left_semi")
    return (own.groupBy("digest").agg(F.count(F.lit(1)).alias("size"), F.min(_best()).alias("best"))
            .filter("size > 1"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``."""
    rows = table(digests(docs, id_col, text_col), "digests")
    winners = table(verified(rows, frequent(rows, capacity)), "winners")
    split = rows.join(F.broadcast(winners), "digest", "left")
    group = Window.partitionBy("digest")
    rest = (split.filter("size is null")
            .withColumn("size", F.count(F.lit(1)).over(group))
            .withColumn("best", F.min(_best()).over(group)))
    return split.filter("size is not null").unionByName(rest).select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("digest").alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; the ids must
    tell rows apart."""
    stay = copies(docs, id_col, text_col, capacity).filter("kept").select(F.col(id_col).alias("_stay"))
    return docs.join(stay, docs[id_col].eqNullSafe(stay["_stay"]), "left_semi")


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT doc_id, sha256(norm) AS text_sha256,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
