"""Stupid-backoff language-model scores (operator 6).

S(w | context) = count(context w) / count(context) if the n-gram has
``min_count`` occurrences in the corpus, else ``backoff`` * S(w | shorter
context); a single word scores count(w) / N.  Counts are those of all
documents.  The work is a join of two exploded sides by n-gram hash, with
many n-grams packed into one row so that the shuffle moves blocks of
numbers instead of one row for each n-gram:

1. Documents are dealt into groups of a few MB as they come, each one row
   of compressed texts.  A group sends its distinct words and word pairs
   with their counts, one row for each range of hash values (``bucket``)
   and order.
2. Each (order, bucket) is a partition of the count table: the counts of
   all groups are summed and each group gets the sums of what it sent.
3. For each higher order the groups meet the answers of the lower ones and
   send the n-grams whose two shorter ones are seen ``min_count`` times; no
   other can be, and counts below that are never asked for.
4. Groups meet all answers and their texts again, score every word and sum
   up by document.

A frequent n-gram comes once from each group, so it is combined before the
shuffle.  The number of groups and of buckets is in proportion to the
corpus, so both stay of one size however large the corpus is.  A group
sends rows for the buckets that it has n-grams in, so there are never more
rows than n-grams.

Defined results: a null or wordless text has n_tokens 0, a log score of 0
and a null mean; rows are scored one by one, so repeated rows and null ids
come back as they went in; texts are read whole; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.llm.common import map_arrow, table
from shopcast.llm.words import Words, buffers, inside_text, ngram_hash

#: Bytes of text in a group, and of text whose n-grams fill a bucket.
GROUP_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20

_GROUP = "grp bigint, texts binary"
_REQUEST = "`order` int, bucket int, grp bigint, hashes binary, counts binary"
_ANSWER = "`order` int, bucket int, grp bigint, counts binary"
_ZSTD = pa.Codec("zstd")


def _deal(limit: int):
    """Rows (id, t) as groups of ``limit`` bytes of text or one row more.  A
    group is named after its content, so it has its name again if a task is
    run again."""
    def group(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(pa.Table.from_batches(held).combine_chunks())
        texts = sink.getvalue().to_pybytes()
        name = int.from_bytes(hashlib.blake2b(texts, digest_size=8).digest(), "little", signed=True)
        return pa.record_batch([pa.array([name], pa.int64()), _binary([texts])], ["grp", "texts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, room = [], limit
        for batch in batches:
            offsets, at = buffers(batch.column(1))[1] + 8 * np.arange(len(batch) + 1), 0  # empty rows count too
            while at < len(batch):
                to = min(max(int(np.searchsorted(offsets, offsets[at] + room)), at + 1), len(batch))
                held.append(batch.slice(at, to - at))
                room -= int(offsets[to] - offsets[at])
                at = to
                if room <= 0:
                    yield group(held)
                    held, room = [], limit
        if held:
            yield group(held)

    return run


def _rows(group: pa.Table) -> pa.Table:
    """The rows (id, t) of a group; of all groups of that content."""
    return pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in group.column("texts").to_pylist()])


def _binary(values: list) -> pa.Array:
    return pa.array(values, pa.binary())


def _pack(values: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed: the planes of the high bytes are
    mostly zero, and those of small numbers take the bits they need."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(values).to_bytes(4, "little") + _ZSTD.compress(planes, asbytes=True)


def _unpack(data: bytes, kind: type) -> np.ndarray:
    size, n = np.dtype(kind).itemsize, int.from_bytes(data[:4], "little")
    planes = np.frombuffer(_ZSTD.decompress(data[4:], n * size, asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _grams(w: Words, k: int, counts: list[np.ndarray], min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-grams that are sent, and the word each one ends at:
    those inside texts, from order 3 on only where both shorter n-grams have
    ``min_count`` by ``counts`` (of each lower order, by last word)."""
    at = np.flatnonzero(inside_text(w.first, k))
    if k > 2:
        enough = counts[k - 2] >= min_count
        at = at[enough[at + (k - 1)] & enough[at + (k - 2)]]
    return ngram_hash(w.hash, k)[at], at + (k - 1)


def _counts(w: Words, answers: pa.Table, lowest: int, order: int, min_count: int) -> list[np.ndarray]:
    """For each order the count of the n-gram that ends at each word; 0 below
    the ``lowest`` order and for n-grams that weren't sent."""
    answers = answers.sort_by([("order", "ascending"), ("bucket", "ascending")])
    of = np.asarray(answers.column("order").to_numpy())
    blobs = answers.column("counts")
    out = [np.zeros(len(w.start)) for _ in range(order)]
    for k in range(lowest, order + 1):
        grams, ends = _grams(w, k, out, min_count)
        sent, inverse = np.unique(grams, return_inverse=True)
        found = np.concatenate([np.zeros(0, np.uint64), *(
            _unpack(blobs[i].as_py(), np.uint64) for i in np.flatnonzero(of == k).tolist())])
        if len(sent) != len(found):
            raise RuntimeError("the rows of a group are others than those that were counted")
        out[k - 1][ends] = found[inverse]
    return out


def _request(orders: range, bits: int, min_count: int):
    def first(key: tuple, group: pa.Table) -> pa.Table:
        return send(key, Words(*buffers(_rows(group).column("t"))), [])

    def later(key: tuple, group: pa.Table, answers: pa.Table) -> pa.Table:
        w = Words(*buffers(_rows(group).column("t")))
        return send(key, w, _counts(w, answers, 2, orders[0] - 1, min_count))

    def send(key: tuple, w: Words, known: list[np.ndarray]) -> pa.Table:
        rows: list[list] = [[], [], [], []]
        for k in orders:
            found, counts = np.unique(_grams(w, k, known, min_count)[0], return_counts=True)
            bucket = found >> np.uint64(64 - bits) if bits else np.zeros_like(found)
            cut = np.flatnonzero(np.diff(bucket, prepend=~np.uint64(0), append=~np.uint64(0)))
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
                part = slice(lo, hi)
                steps = np.diff(found[part], prepend=np.uint64(0))  # ascending hashes by their steps
                for r, v in zip(rows, (k, int(bucket[lo]), _pack(steps), _pack(counts[part].astype(np.uint32)))):
                    r.append(v)
        return pa.table([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int32()),
                         pa.array([key[0].as_py()] * len(rows[0]), pa.int64()),
                         _binary(rows[2]), _binary(rows[3])],
                        ["order", "bucket", "grp", "hashes", "counts"])

    return later if orders[0] > 2 else first


def _count(rows: pa.Table) -> pa.Table:
    """Sums of one partition of the count table, sent back to each group."""
    hashes = [np.cumsum(_unpack(x, np.uint64)) for x in rows.column("hashes").to_pylist()]
    counts = [_unpack(x, np.uint32) for x in rows.column("counts").to_pylist()]
    every = np.concatenate(hashes)
    order = np.argsort(every)
    new = np.ones(len(every), bool)
    new[1:] = every[order][1:] != every[order][:-1]
    which = np.empty(len(every), np.int64)
    which[order] = np.cumsum(new) - 1
    total = np.bincount(which, weights=np.concatenate(counts)).astype(np.uint64)[which]
    cut = np.cumsum([len(h) for h in hashes])[:-1]
    return rows.drop_columns(["hashes", "counts"]).append_column(
        "counts", _binary([_pack(x) for x in np.split(total, cut)]))


def _score(order: int, backoff: float, min_count: int, kind: pa.DataType):
    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        texts = _rows(group)
        w = Words(*buffers(texts.column("t")))
        counts = _counts(w, answers, 1, order, min_count)
        place = np.arange(len(w.start)) - np.repeat(w.first[:-1], w.count)  # in its text
        level = np.minimum(place, order - 1)  # words of context there are
        logs = np.zeros(len(w.start))
        open_ = np.ones(len(w.start), bool)
        for k in range(order - 1, 0, -1):
            before = np.concatenate([[1.0], counts[k - 1][:-1]]) if len(place) else counts[k - 1]
            hit = open_ & (level >= k) & (counts[k] >= min_count)
            logs[hit] += np.log(counts[k][hit]) - np.log(before[hit])
            logs[open_ & (level >= k) & ~hit] += math.log(backoff)
            open_ &= ~hit
        logs[open_] += np.log(counts[0][open_])
        n = len(texts)
        per = lambda x: np.bincount(w.text_of, weights=x, minlength=n).astype(np.float64)
        return pa.table([texts.column("id").combine_chunks().cast(kind), pa.array(w.count.astype(np.int64)),
                         pa.array(per(logs)), pa.array(per(open_).astype(np.int64))],
                        ["id", "n_tokens", "logs", "n_single"])

    return run


def backoff_scores(docs: DataFrame, order: int = 3, backoff: float = 0.4, min_count: int = 2,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_backed_off, log_score, mean_log_score) by document.

    ``log_score`` is the sum of the natural logarithms of S over the words;
    ``n_backed_off`` counts the words scored by their own frequency.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    size = source.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_groups = max(1, math.ceil(size / GROUP_BYTES))
    bits = max(0, math.ceil(math.log2(max(1, size / BUCKET_BYTES))))
    kind = source.schema["id"].dataType
    by_group = map_arrow(source.coalesce(n_groups), _deal(GROUP_BYTES), _GROUP).groupBy("grp")
    sent = by_group.applyInArrow(_request(range(1, min(order, 2) + 1), bits, min_count), _REQUEST)
    answers = sent.groupBy("order", "bucket").applyInArrow(_count, _ANSWER)
    for k in range(3, order + 1):
        lower = answers.filter("`order` > 1").groupBy("grp")
        sent = by_group.cogroup(lower).applyInArrow(_request(range(k, k + 1), bits, min_count), _REQUEST)
        answers = answers.unionAll(sent.groupBy("order", "bucket").applyInArrow(_count, _ANSWER))
    from pyspark.sql.pandas.types import to_arrow_type
    scored = by_group.cogroup(answers.groupBy("grp")).applyInArrow(
        _score(order, backoff, min_count, to_arrow_type(kind)),
        f"id {kind.simpleString()}, n_tokens bigint, logs double, n_single bigint")
    scored = table(scored, "scores")
    words = scored.agg(F.sum("n_tokens")).first()[0] or 1
    total = F.col("logs") - F.col("n_single") * math.log(max(words, 1))
    return scored.select(F.col("id").alias(id_col), "n_tokens", F.col("n_single").alias("n_backed_off"),
                         total.alias("log_score"),
                         F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_score"))
