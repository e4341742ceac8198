"""Removal of repeated byte strings (operator 4).

A byte goes if a string of ``width`` bytes that covers it starts anywhere
else in the corpus.  The repeated strings are found by merging Burrows-
Wheeler orders, after two steps that leave nothing for it to do but what
needs it and that lose nothing:

1. Anchors.  In every window of ``width`` bytes the gram with the smallest
   hash (the leftmost of equals) is its anchor.  It depends on the window's
   bytes alone, so equal windows have equal anchors at equal places.  The
   windows of one anchor are consecutive; the bytes that they cover are a
   span, about one for each 185 bytes of text.  Spans are counted by (anchor
   hash, span hash): windows whose anchor comes once are unique, and a span
   that comes twice or more is repeated as a whole.  Exact copies, however
   many, end here as a sum combined before the shuffle.
2. What is left are anchors with several different spans.  One copy of each
   such span goes to the partition of its anchor, so that all equal windows
   meet.

Merging, in each partition: the spans are cut into shards, and each shard
has its Burrows-Wheeler transform.  Symbols are blocks of bytes, an eighth
of the width, and a span is read from each place of its first block, so a
suffix begins at every byte and eight symbols are one window.  The
transforms are merged by refining their interleave, one pass for each
symbol (``merge``): a pass deals shard numbers to places by the symbols
read along the interleave so far, which never sorts a suffix again.  The
pass in which two neighbours part gives their common prefix; intervals that
eight passes leave together are the repeated strings.

An anchor with more than ``hot`` different spans would make a partition
grow with the corpus; its windows are dealt by their own hash instead.

Defined results: a null or empty text has 0 bytes and the hash of the empty
string; rows are texts of their own, so a repeated row repeats the text and
loses what is long enough; ids may be null or equal; texts are read whole;
an empty table gives an empty result.  Equality is that of 64-bit hashes of
several blocks, which takes a chance below 1e-12 in a corpus of 100 TB for
the blocks together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopcast.llm.common import map_arrow, table, workers_ready
from shopcast.llm.words import U64, buffers, groups, mix, prefix_hash

WIDTH, GRAM = 400, 32
HOT = 4096
#: Different spans that fill a partition of step 2, and those of a shard.
BUCKET_SPANS, SHARD_SPANS = 1000, 250
#: Longest piece of one text that a numpy pass takes on.
PIECE = 1 << 23
_PLACE = U64((1 << 24) - 1)


def spans(data: np.ndarray, offsets: np.ndarray, width: int, gram: int = GRAM):
    """(text, lo, hi, anchor, anchor hash, span hash) arrays: windows that
    start at lo .. hi of a text have their anchor in common."""
    empty = np.zeros(0, np.int64)
    n = len(data)
    if n < width:
        return empty, empty, empty, empty, empty.astype(U64), empty.astype(U64)
    sums, down = prefix_hash(data)
    h = mix((sums[gram:] - sums[:-gram]) * down[:n - gram + 1])
    keys = (h & ~_PLACE) | np.arange(len(h), dtype=U64)
    per = width - gram + 1
    pad = np.full(-len(keys) % per, ~U64(0))
    blocks = np.concatenate([keys, pad]).reshape(-1, per)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    starts = n - width + 1
    least = np.minimum(ahead[:starts], behind[per - 1:per - 1 + starts])
    anchor = (least & _PLACE).astype(np.int64)
    inside = np.zeros(n + 1, np.int32)  # windows that stay in their text
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= width:
            inside[a] += 1
            inside[b - width + 1] -= 1
    ok = np.cumsum(inside)[:starts] > 0
    new = ok.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~ok[:-1]
    lo = np.flatnonzero(new)
    last = ok.copy()
    last[:-1] &= (anchor[1:] != anchor[:-1]) | ~ok[1:]
    hi = np.flatnonzero(last)
    a = anchor[lo]
    end = hi + width
    whole = mix((sums[end] - sums[lo]) * down[lo] + (end - lo).astype(U64) * U64(1 << 20) + (a - lo).astype(U64))
    text = np.searchsorted(offsets, lo, "right") - 1
    return text, lo - offsets[text], hi - offsets[text], a - offsets[text], h[a], whole


def _pieces(offsets: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """(first text, offsets, bytes before) of passes over texts; a text that
    is too long for one pass comes in pieces that overlap by a window."""
    for i, j in groups(offsets):
        size = int(offsets[j] - offsets[i])
        if size <= PIECE:
            yield i, offsets[i:j + 1], 0
        else:
            for at in range(0, max(size - width + 1, 1), PIECE):
                lo = int(offsets[i]) + at
                yield i, np.array([lo, min(lo + PIECE + width - 1, int(offsets[j]))]), at


def span_table(docs: DataFrame, width: int) -> DataFrame:
    """(id, th, lo, hi, off, ah, sh) of all spans; docs as (id, th, t)."""
    kind = docs.schema["id"].dataType.simpleString()
    names = ["id", "th", "lo", "hi", "off", "ah", "sh"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("t"))
            for first, cuts, before in _pieces(offsets, width):
                text, lo, hi, a, ah, sh = spans(data[cuts[0]:cuts[-1]], cuts - cuts[0], width)
                rows = pa.array(text + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(rows), batch.column("th").take(rows), pa.array(lo + before),
                     pa.array(hi + before), pa.array((a - lo).astype(np.int32)), pa.array(ah.view(np.int64)),
                     pa.array(sh.view(np.int64))], names)

    return map_arrow(docs, run, f"id {kind}, th bigint, lo bigint, hi bigint, off int, ah bigint, sh bigint")


_PARTS = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64()), ("ah", pa.int64()), ("sh", pa.int64()),
                             ("n", pa.int64()), ("hot", pa.bool_())]))


def _cut_out(docs: DataFrame, width: int) -> DataFrame:
    """Bytes of the wanted spans of (id, th, t, parts)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("t"))
            rows, kept = [], []
            for i, parts in enumerate(batch.column("parts").to_pylist()):
                for p in parts:
                    rows.append(i)
                    kept.append((p["lo"], p["ah"], p["sh"], p["n"], p["hot"],
                                 data[offsets[i] + p["lo"]:offsets[i] + p["hi"] + width].tobytes()))
            at = pa.array(rows, pa.int64())
            columns = list(zip(*kept)) if kept else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("th").take(at),
                 *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["id", "th", "lo", "ah", "sh", "n", "hot", "bytes"])

    return map_arrow(docs, run, f"id {kind}, th bigint, lo bigint, ah bigint, sh bigint, n bigint, hot boolean, "
                                "bytes binary")


def block_of(width: int) -> int:
    """Bytes of a symbol: the largest divisor of ``width`` up to an eighth."""
    return max(d for d in range(1, max(1, width // 8) + 1) if width % d == 0)


def _by_symbol(symbols: np.ndarray) -> np.ndarray:
    """Stable order by symbol: counting, 16 bits at a time."""
    order = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable")
    if len(symbols) and symbols.max() > 0xFFFF:
        order = order[np.argsort((symbols >> 16).astype(np.uint16)[order], kind="stable")]
    return order


class Suffixes:
    """All suffixes of some spans, a row for each place 0 .. len of a span.

    A span is read in steps of ``block`` bytes, from each of the ``block``
    first places, so the suffix after that at ``i`` is at ``i + block`` and
    the symbol before it is the block that ends at ``i``.  Symbols are
    numbered over all spans; 0 stands before the first ``block`` places of a
    span, and its last ``block`` places are empty suffixes.
    """

    def __init__(self, texts: list[bytes], block: int):
        data = np.frombuffer(b"".join(texts), np.uint8)
        size = np.array([len(t) for t in texts], np.int64)
        self.block = block
        self.first = np.concatenate([[0], np.cumsum(size + 1)])  # row of each span's place 0
        self.span = np.repeat(np.arange(len(texts), dtype=np.int32), size + 1)
        self.place = (np.arange(self.first[-1]) - self.first[self.span]).astype(np.int32)
        self.is_end = self.place > (size - block)[self.span]
        inner = np.flatnonzero(self.place >= block)
        at = inner - self.span[inner]  # in the bytes: every span before has one row more than bytes
        sums, down = prefix_hash(data)
        h = mix((sums[at] - sums[at - block]) * down[at - block])
        self.symbol = np.zeros(len(self.span), np.int32)
        self.symbol[inner] = np.unique(h, return_inverse=True)[1] + 1


class Shard:
    """The Burrows-Wheeler transform of the spans ``lo`` .. ``hi``: its rows
    in the order of ``depth`` symbols, and the symbol before each one.

    A pass sorts the rows, in their order so far, by the symbols before
    them, which gives the rows one block earlier in the order of one symbol
    more.
    """

    def __init__(self, suffixes: Suffixes, lo: int, hi: int, depth: int):
        a, b = int(suffixes.first[lo]), int(suffixes.first[hi])
        self.ends = np.flatnonzero(suffixes.is_end[a:b]) + a
        rows = np.arange(a, b)
        for _ in range(depth):
            order = _by_symbol(suffixes.symbol[rows])[len(self.ends):]
            rows = np.concatenate([self.ends, rows[order] - suffixes.block])
        self.rows, self.bwt = rows, suffixes.symbol[rows]


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, common): the rows of all shards in the order of their merged
    transform; ``common`` is the number of symbols a row shares with the one
    before it, up to ``depth``.

    ``z`` says which shard each place of the result takes its next row from.
    It begins with the shards one after another and is refined: a pass reads
    the transforms along ``z``, each from its first symbol on, and deals the
    shard numbers to places by symbol, in the order read.  After pass p, z
    is right for p symbols, and where a place parts from the one before it
    for the first time the two share p - 1.  Suffixes aren't looked at, and
    the rows of a shard never change their order.
    """
    bwt = np.concatenate([s.bwt for s in shards])
    kind = np.uint8 if len(shards) < 256 else np.uint16
    z = np.repeat(np.arange(len(shards), dtype=kind), [len(s.bwt) for s in shards])
    ends = np.repeat(np.arange(len(shards), dtype=kind), [len(s.ends) for s in shards])
    n, m = len(z), len(ends)
    common = np.full(n, depth, np.int16)
    interval = np.zeros(n, np.int32)
    read = np.empty(n, np.int32)
    for done in range(depth):
        read[np.argsort(z, kind="stable")] = bwt
        order = _by_symbol(read)[m:]
        symbol, inside = read[order], interval[order]
        new = np.ones(n, bool)  # each empty suffix is an interval of its own
        new[m + 1:] = (symbol[1:] != symbol[:-1]) | (inside[1:] != inside[:-1])
        common[new & (common == depth)] = done
        interval = np.cumsum(new, dtype=np.int32)
        z = np.concatenate([ends, z[order]])
    rows = np.empty(n, np.int64)
    rows[np.argsort(z, kind="stable")] = np.concatenate([s.rows for s in shards])
    return rows, common


def repeated(suffixes: Suffixes, shards: list[Shard], depth: int) -> np.ndarray:
    """Rows, ascending, that lie in intervals of two rows or more which share
    ``depth`` symbols."""
    rows, common = merge(shards, depth)
    deep = common >= depth
    deep[:-1] |= deep[1:]
    return np.sort(rows[deep])


def _runs(flags: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Byte ranges that flagged window starts cover."""
    step = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(step == 1).tolist(), (np.flatnonzero(step == -1) - 1 + width).tolist()))


def _merge_bucket(width: int, shard_spans: int):
    block = block_of(width)

    def run(rows: pa.Table) -> pa.Table:
        texts = rows.column("bytes").to_pylist()
        suffixes = Suffixes(texts, block)
        shards = [Shard(suffixes, i, min(i + shard_spans, len(texts)), width // block)
                  for i in range(0, len(texts), shard_spans)]
        found = repeated(suffixes, shards, width // block)
        cut = np.searchsorted(found, suffixes.first)
        single = np.asarray(rows.column("n")) == 1  # the others are known to be repeated
        lo = np.asarray(rows.column("lo"))
        at, begin, end = [], [], []
        for k in np.flatnonzero((cut[1:] > cut[:-1]) & single).tolist():
            flags = np.zeros(len(texts[k]) - width + 1, bool)
            flags[suffixes.place[found[cut[k]:cut[k + 1]]]] = True
            for x, y in _runs(flags, width):
                at.append(k)
                begin.append(lo[k] + x)
                end.append(lo[k] + y)
        at = pa.array(at, pa.int64())
        return pa.table([rows.column("id").take(at), rows.column("th").take(at),
                         pa.array(begin, pa.int64()), pa.array(end, pa.int64())], ["id", "th", "b", "e"])

    return run


def _windows(rows: DataFrame, width: int) -> DataFrame:
    """(id, th, at, n, ah, wh): every window of the spans of hot anchors."""
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "th", "at", "n", "ah", "wh"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("bytes").to_pylist()):
                sums, down = prefix_hash(np.frombuffer(text, np.uint8))
                m = len(text) - width + 1
                wh = mix((sums[width:] - sums[:m]) * down[:m])
                at = pa.array(np.full(m, i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(at), batch.column("th").take(at),
                     pa.array(np.arange(m) + batch.column("lo")[i].as_py()), batch.column("n").take(at),
                     batch.column("ah").take(at), pa.array(wh.view(np.int64))], names)

    return map_arrow(rows, run, f"id {kind}, th bigint, at bigint, n bigint, ah bigint, wh bigint")


def repeats(docs: DataFrame, width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """(id, th, b, e): byte ranges that repeated strings cover, overlapping
    ones as well; docs as (id, th, t)."""
    kind = docs.schema["id"].dataType.simpleString()
    every = table(span_table(docs, width), "spans")
    counted = every.groupBy("ah", "sh").agg(F.count(F.lit(1)).alias("n"))
    counted = table(counted, "spancounts")
    anchors = (counted.groupBy("ah").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
               .filter("total > 1").select("ah", "kinds"))
    counted = counted.join(anchors, "ah").select("ah", "sh", "n", "kinds")
    again = table(every.join(counted, ["ah", "sh"]).drop("off"), "repeated")
    whole = again.filter("n > 1").select("id", "th", F.col("lo").alias("b"), (F.col("hi") + width).alias("e"))

    # one place of each different span of the anchors that have several
    mixed = again.filter("kinds > 1")
    some = mixed.filter("n > 1").groupBy("ah", "sh", "n", "kinds").agg(
        F.min(F.struct("th", "lo", "hi", "id")).alias("f")).select("ah", "sh", "n", "kinds", "f.*")
    one = table(mixed.filter("n = 1").unionByName(some), "places")
    is_hot = F.col("kinds") > hot
    n_spans, n_hot = one.agg(F.count(F.lit(1)), F.count_if(is_hot)).first()
    parts = one.groupBy(F.col("id").alias("pid"), F.col("th").alias("pth")).agg(F.collect_list(
        F.struct("lo", "hi", "ah", "sh", "n", is_hot.alias("hot"))).alias("parts"))
    cut = _cut_out(docs.join(parts, F.col("id").eqNullSafe(F.col("pid")) & (F.col("th") == F.col("pth")))
                   .select("id", "th", "t", "parts"), width)
    n_buckets = max(1, -(-n_spans // BUCKET_SPANS))
    dealt = cut.filter("not hot").withColumn("bucket", F.pmod(F.xxhash64("ah"), F.lit(n_buckets)))
    merged = workers_ready(dealt).groupBy("bucket").applyInArrow(
        _merge_bucket(width, SHARD_SPANS), f"id {kind}, th bigint, b bigint, e bigint")
    found = whole.unionByName(merged)
    if n_hot:
        # in one plan with the rest, so that the shuffle of the texts is used twice
        many = F.sum("n").over(Window.partitionBy("ah", "wh"))
        windows = _windows(cut.filter("hot"), width).withColumn("many", many).filter("many > 1")
        found = found.unionByName(windows.select(
            "id", "th", F.col("at").alias("b"), (F.col("at") + width).alias("e")))
    return found


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("t"))


def marked(docs: DataFrame, width: int = WIDTH, hot: int = HOT, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, t, marks): each row with the byte ranges to remove, unordered."""
    source = _source(docs, id_col, text_col)
    ranges = repeats(source, width, hot).groupBy(F.col("id").alias("pid"), F.col("th").alias("pth")).agg(
        F.collect_set(F.struct("b", "e")).alias("marks"))  # rows that share id and text have the same ones
    return source.join(ranges, F.col("id").eqNullSafe(F.col("pid")) & (F.col("th") == F.col("pth")), "left").select(
        "id", "t", "marks")


def _union(marks: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each list of ranges the maximal runs (begins, ends)."""
    none = np.zeros(0, np.int64)
    flat = marks.flatten()
    b, e = flat.field("b").to_numpy(), flat.field("e").to_numpy()
    sizes = np.asarray(marks.value_lengths().fill_null(0))
    at = 0
    for n in sizes.tolist():
        if not n:
            yield none, none
            continue
        order = np.argsort(b[at:at + n], kind="stable")
        x, y = b[at:at + n][order], np.maximum.accumulate(e[at:at + n][order])
        new = np.ones(n, bool)
        new[1:] = x[1:] > y[:-1]
        yield x[new], np.append(y[:-1][new[1:]], y[-1])
        at += n


def digest(docs: DataFrame, width: int = WIDTH, hot: int = HOT, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of each row."""
    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("t"))
            rows: list[tuple] = []
            for i, (x, y) in enumerate(_union(batch.column("marks"))):
                text = data[offsets[i]:offsets[i + 1]]
                sha, at = hashlib.sha256(), 0
                for b, e in zip(x.tolist(), y.tolist()):
                    sha.update(text[at:b])
                    at = e
                sha.update(text[at:])
                rows.append((len(text), int((y - x).sum()), len(x), sha.hexdigest()))
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                names)

    found = marked(docs, width, hot, id_col, text_col)
    kind = found.schema["id"].dataType.simpleString()
    return map_arrow(found, run, f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                 "kept_sha256 string")


def removed(docs: DataFrame, width: int = WIDTH, hot: int = HOT, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id, text): texts without what repeats; bytes that no longer form a
    character are dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("t"))
            out = []
            for i, (x, y) in enumerate(_union(batch.column("marks"))):
                keep = np.ones(int(offsets[i + 1] - offsets[i]), bool)
                for b, e in zip(x.tolist(), y.tolist()):
                    keep[b:e] = False
                out.append(data[offsets[i]:offsets[i + 1]][keep].tobytes().decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], [id_col, text_col])

    found = marked(docs, width, hot, id_col, text_col)
    kind = found.schema["id"].dataType.simpleString()
    return map_arrow(found, run, f"`{id_col}` {kind}, `{text_col}` string")
