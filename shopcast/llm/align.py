"""Alignment of two tokenizers by galloping intersection (operator 11).

Both tokenizers encode the same bytes, a space and the text.  The offsets
at which their tokens end are two ascending lists; the shorter one drives
a galloping search (doubling steps, then halving) through the longer.
Offsets found in both cut the tokens into groups; the differences of
neighbouring ranks are the ranges of tokens that overlap, hence the links.

On Spark:

1. A task encodes its documents in blocks of about ``BLOCK_BYTES`` of text
   and writes a row for each document, with the numbers of its groups
   within the block, and a row for each different list of links of the
   block's groups, with the times it comes ("shape").  Shapes are mostly
   words, so a block has far fewer of them than links.
2. Shapes are added up over the corpus, then exploded to links and added
   up by pair of ids: the counts.  The highest count of each B id and the
   sums over each shape follow by joins on shapes, not on documents.
3. Sums go back to the blocks that have the shape, and a co-group by block
   adds them up for each document.  A block is bounded by its text.

Defined results: texts that are null or empty, or that a tokenizer changes
(its tokens' bytes differ from the space and the text), have no tokens, so
zeros and an empty digest; repeated rows and null ids count as they come,
each row on its own; texts of any length are encoded whole; an empty table
gives an empty result; ties for the highest count all count; other columns
are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopcast.llm.common import map_arrow, table, workers_ready
from shopcast.llm.words import BASE, U64, mix

#: Folder and files of the tokenizers.
FOLDER = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Fixed value: how a byte-level pre-tokenizer cuts a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Text that one block holds, or one longer text.  Tokens, links and shapes
#: of a block take many times its text in the worker.
BLOCK_BYTES = 1 << 21
#: Needles that start from one anchor in a round of galloping.
STRIDE = 64


def _byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable
    ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def byte_bpe(path: str):
    """(encode, token bytes by id) of a byte-level BPE file.

    The ranks come from the file's vocabulary, which holds the merged
    tokens in merge order; that is checked, as the fast encoder needs it.
    """
    import tiktoken

    letters = _byte_letters()
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    ids = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()
           if all(c in letters for c in token)}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in merges]
    if made != list(range(256, 256 + len(made))):
        raise ValueError(f"{path}: ids are not in merge order")
    encoder = tiktoken.Encoding("align", pat_str=PATTERN, mergeable_ranks=ids, special_tokens={})
    entries = [b""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        entries[i] = token
    return encoder.encode_ordinary, entries


@lru_cache(maxsize=2)
def piece_bpe(path: str):
    """(encode, token bytes by id) of a sentencepiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    entries = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        entries.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i)
                       else piece.replace("▁", " ").encode())
    return (lambda text: model.encode(text, num_threads=1)), entries


@dataclass
class Side:
    """The tokens of some texts: ids, and the tokens at which texts begin."""

    ids: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def _encoded(texts: list[str | None], encode, entries) -> list[list[int]]:
    out = []
    for text in texts:
        ids = encode(text[0]) if text else []
        out.append(ids if text and b"".join([entries[i] for i in ids]) == text[1] else [])
    return out


def encode(texts: list[str | None], folder: str = FOLDER, a_file: str = A_FILE,
           b_file: str = B_FILE) -> tuple[Side, Side]:
    """Tokens of each text by both; none where either changes the bytes."""
    encode_a, entries_a = byte_bpe(f"{folder}/{a_file}")
    encode_b, entries_b = piece_bpe(f"{folder}/{b_file}")
    whole = [(" " + t).encode() if t else None for t in texts]
    a = _encoded([(" " + t, w) if t else None for t, w in zip(texts, whole)], encode_a, entries_a)
    b = _encoded([(t, w) if t else None for t, w in zip(texts, whole)], encode_b, entries_b)
    both = [bool(x and y) for x, y in zip(a, b)]
    sides = []
    for lists in (a, b):
        lists = [x if ok else [] for x, ok in zip(lists, both)]
        first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        ids = np.concatenate([np.array(x, np.int64) for x in lists]) if lists else np.zeros(0, np.int64)
        sides.append(Side(ids.astype(np.int64), first))
    return sides[0], sides[1]


@lru_cache(maxsize=2)
def _lengths(folder: str, a_file: str, b_file: str) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array([len(x) for x in entries], np.int64) for entries in (
        byte_bpe(f"{folder}/{a_file}")[1], piece_bpe(f"{folder}/{b_file}")[1]))


def gallop(needles: np.ndarray, hay: np.ndarray) -> np.ndarray:
    """The first place of ``hay`` that is not below each needle.

    Both ascend, and no needle is above the last of ``hay``.  Every
    ``STRIDE``-th needle is placed first; the others start at the anchor
    before them, step on by 1, 2, 4, ... until they are reached, and halve
    the last step.  All needles of a round move at once.
    """
    n = len(needles)
    if not n:
        return np.zeros(0, np.int64)
    if n <= STRIDE:
        low = np.zeros(n, np.int64)
    else:
        low = np.repeat(gallop(needles[::STRIDE], hay), STRIDE)[:n]
    high, last = low.copy(), len(hay) - 1
    on = np.flatnonzero(hay[low] < needles)
    step = 1
    while len(on):
        low[on] = high[on] + 1
        high[on] = np.minimum(high[on] + step, last)
        on = on[hay[high[on]] < needles[on]]
        step *= 2
    on = np.flatnonzero(low < high)
    while len(on):
        mid = (low[on] + high[on]) >> 1
        below = hay[mid] < needles[on]
        low[on[below]] = mid[below] + 1
        high[on[~below]] = mid[~below]
        on = on[low[on] < high[on]]
    return low


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] of them, then the next."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


@dataclass
class Alignment:
    """Groups and links of some texts, in text order.

    ``a_group``, ``b_group``: the group of each token.  ``link_a``,
    ``link_b``: the tokens of each link, ordered within its group;
    ``links``: the first link of each group and the total.  ``groups``:
    the first group of each text and the total.
    """

    a: Side
    b: Side
    a_group: np.ndarray
    b_group: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    links: np.ndarray
    groups: np.ndarray

    @property
    def n_links(self) -> np.ndarray:
        return np.diff(self.links[self.groups])

    def pairs(self) -> np.ndarray:
        """a_id * 2^32 + b_id of each link."""
        return (self.a.ids[self.link_a] << 32) | self.b.ids[self.link_b]


def intersect(a: Side, b: Side, a_length: np.ndarray, b_length: np.ndarray) -> Alignment:
    """Align texts whose tokens cover the same bytes by both tokenizers."""
    ends_a, ends_b = np.cumsum(a_length[a.ids]), np.cumsum(b_length[b.ids])
    by_a = a.count <= b.count  # the shorter list drives, text by text
    drive_a, drive_b = np.repeat(by_a, a.count), np.repeat(by_a, b.count)
    # both lists of all texts in one, in text order, which keeps them ascending
    n_short, n_long = np.minimum(a.count, b.count), np.maximum(a.count, b.count)
    short = _mixed(by_a, n_short, a.first, b.first, ends_a, ends_b)
    long = _mixed(~by_a, n_long, a.first, b.first, ends_a, ends_b)
    at = gallop(short, long)
    common = long[at] == short if len(at) else np.zeros(0, bool)

    # what a driver's token overlaps: from the rank after its start to that of its end
    begin = np.zeros(len(at), np.int64)
    begin[1:] = at[:-1] + common[:-1]
    counts = at - begin + 1
    link_short, link_long = np.repeat(np.arange(len(at)), counts), _ranges(begin, counts)

    cuts = np.zeros(len(long), np.int64)
    cuts[at[common]] = 1
    group_short, group_long = np.cumsum(common) - common, np.cumsum(cuts) - cuts
    first_short = np.concatenate([[0], np.cumsum(n_short)])
    first_long = np.concatenate([[0], np.cumsum(n_long)])
    a_group, b_group = np.empty(len(a.ids), np.int64), np.empty(len(b.ids), np.int64)
    a_group[drive_a], a_group[~drive_a] = group_short[np.repeat(by_a, n_short)], group_long[np.repeat(~by_a, n_long)]
    b_group[~drive_b], b_group[drive_b] = group_short[np.repeat(~by_a, n_short)], group_long[np.repeat(by_a, n_long)]

    text_of = np.repeat(np.arange(len(by_a)), n_short)[link_short] if len(at) else link_short
    of_a = by_a[text_of] if len(at) else np.zeros(0, bool)
    in_short, in_long = link_short - first_short[text_of], link_long - first_long[text_of]
    link_a = a.first[text_of] + np.where(of_a, in_short, in_long)
    link_b = b.first[text_of] + np.where(of_a, in_long, in_short)
    total = int(common.sum())
    links = np.searchsorted(group_short[link_short], np.arange(total + 1))
    groups = np.concatenate([[0], np.cumsum(common)])[first_short]
    return Alignment(a, b, a_group, b_group, link_a, link_b, links, groups)


def _mixed(of_a, counts, first_a, first_b, ends_a, ends_b) -> np.ndarray:
    """Ends of one tokenizer for each text: of A where ``of_a``."""
    out = np.empty(int(counts.sum()), np.int64)
    to_a = np.repeat(of_a, counts)
    at = _ranges(np.where(of_a, first_a[:-1], first_b[:-1]), counts)
    out[to_a], out[~to_a] = ends_a[at[to_a]], ends_b[at[~to_a]]
    return out


def align(texts: list[str | None], folder: str = FOLDER, a_file: str = A_FILE, b_file: str = B_FILE) -> Alignment:
    a, b = encode(texts, folder, a_file, b_file)
    return intersect(a, b, *_lengths(folder, a_file, b_file))


@lru_cache(maxsize=1)
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of 0 .. n-1 and room for a mark behind them, and their number."""
    texts = np.char.mod("%d", np.arange(n))
    width = texts.dtype.itemsize // 4
    digits = texts.astype(f"S{width + 1}").view(np.uint8).reshape(n, width + 1)
    return digits, np.char.str_len(texts).astype(np.int64)


def group_texts(x: Alignment, ids: int = 1 << 16) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each text."""
    total = int(x.groups[-1])
    per_a, per_b = np.bincount(x.a_group, minlength=total), np.bincount(x.b_group, minlength=total)
    before_a, before_b = np.cumsum(per_a) - per_a, np.cumsum(per_b) - per_b
    to_a = np.arange(len(x.a.ids)) + before_b[x.a_group]
    to_b = np.arange(len(x.b.ids)) + (before_a + per_a)[x.b_group]
    items = np.empty(len(to_a) + len(to_b), np.int64)
    items[to_a], items[to_b] = x.a.ids, x.b.ids
    mark = np.full(len(items), ord(","), np.uint8)
    ends = before_a + per_a + before_b  # items before the first B token of a group
    mark[ends - 1] = ord("|")
    mark[ends + per_b - 1] = ord(";")
    digits, size = _decimals(max(ids, int(items.max(initial=0)) + 1))
    out, size = digits[items], size[items]
    out[np.arange(len(items)), size] = mark
    flat = out[np.arange(digits.shape[1]) <= size[:, None]]
    at = np.concatenate([[0], np.cumsum(size + 1)])[x.a.first + x.b.first]
    data = flat.tobytes()
    return [data[i:j - 1] if j > i else b"" for i, j in zip(at[:-1].tolist(), at[1:].tolist())]


def shapes(x: Alignment) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number, starts, counts, times): groups with the same list of pairs
    have the same number; where a list's links lie and how often it comes."""
    pairs, n = x.pairs(), np.diff(x.links)
    place = np.arange(len(pairs)) - np.repeat(x.links[:-1], n)
    salt = 0
    while True:
        each = mix(pairs.astype(U64) * U64(BASE) + place.astype(U64) + U64(salt))
        sums = np.concatenate([[U64(0)], np.cumsum(each, dtype=U64)])
        keys = mix(sums[x.links[1:]] - sums[x.links[:-1]] + n.astype(U64))
        _, first, number, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        same = x.links[first[number]]
        if (n == n[first[number]]).all() and (pairs == pairs[np.repeat(same, n) + place]).all():
            return number, x.links[first], n[first], times
        salt += 1 << 40  # two lists met in one hash: deal anew


DOC_COLUMNS = ["n_a", "n_b", "n_groups", "n_links"]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """(ids, texts) of at most ``BLOCK_BYTES``, or of one text."""
    for batch in batches:
        texts = batch.column(1)
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = 0
        ends = np.cumsum(lengths)
        while at < len(lengths):
            done = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, done + BLOCK_BYTES, "right")), at + 1)
            yield batch.column(0).slice(at, to - at), texts.slice(at, to - at).to_pylist()
            at = to


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER,
            a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """Rows of two kinds: documents (id, counts, ``sha``, ``groups``: their
    shapes' numbers) and shapes (``number``, ``pairs``, ``times``), both
    with the ``block`` they belong to."""
    source = docs.select(id_col, text_col)
    kind = source.schema[id_col].dataType.simpleString()
    schema = (f"block long, id {kind}, {', '.join(f'{c} long' for c in DOC_COLUMNS)}, sha string, "
              "groups array<int>, number int, pairs array<bigint>, times long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 40
        for ids, texts in _blocks(batches):
            x = align(texts, folder, a_file, b_file)
            number, starts, counts, times = shapes(x)
            m, k = len(texts), len(starts)
            sha = [hashlib.sha256(g).hexdigest() if g else "" for g in group_texts(x)]
            lists = pa.ListArray.from_arrays(pa.array(x.groups, pa.int32()), pa.array(number, pa.int32()))
            figures = [x.a.count, x.b.count, np.diff(x.groups), x.n_links]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, block)), ids, *(pa.array(f, pa.int64()) for f in figures), pa.array(sha, pa.string()),
                 lists, pa.nulls(m, pa.int32()), pa.nulls(m, pa.list_(pa.int64())), pa.nulls(m, pa.int64())], names)
            pairs = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                pa.array(x.pairs()[_ranges(starts, counts)], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, block)), pa.nulls(k, ids.type), *(pa.nulls(k, pa.int64()) for _ in figures),
                 pa.nulls(k, pa.string()), pa.nulls(k, pa.list_(pa.int32())), pa.array(np.arange(k, dtype=np.int32)),
                 pairs, pa.array(times, pa.int64())], names)
            block += 1

    names = ["block", "id", *DOC_COLUMNS, "sha", "groups", "number", "pairs", "times"]
    return map_arrow(source, run, schema)


def corpus_shapes(rows: DataFrame) -> DataFrame:
    """(pairs, times): every list of links of the corpus once."""
    return rows.filter("number is not null").groupBy("pairs").agg(F.sum("times").alias("times"))


def pair_counts(lists: DataFrame) -> DataFrame:
    """(pair, a_id, b_id, count, best): links that hold each pair of ids
    linked, and whether no pair of the same B id has more."""
    counts = (lists.select(F.explode("pairs").alias("pair"), "times")
              .groupBy("pair").agg(F.sum("times").alias("count")))
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    top = F.max("count").over(Window.partitionBy("b_id"))  # at most a row for each A id
    return (counts.withColumn("a_id", F.shiftright("pair", 32)).withColumn("b_id", b)
            .withColumn("best", F.col("count") == top))


def scored(lists: DataFrame, counts: DataFrame) -> DataFrame:
    """(pairs, best, total): over the links of each list."""
    each = lists.select("pairs", F.explode("pairs").alias("pair"))
    return (each.join(counts.select("pair", "count", "best"), "pair").groupBy("pairs")
            .agg(F.sum(F.col("best").cast("long")).alias("best"), F.sum("count").alias("total")))


def document_sums(rows: DataFrame, scores: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: its counts, ``n_best``, ``count_sum``, digest."""
    docs = rows.filter("number is null").select("block", "id", *DOC_COLUMNS, "sha", "groups")
    own = (rows.filter("number is not null").select("block", "number", "pairs").join(scores, "pairs")
           .select(F.col("block").alias("of"), "number", "best", "total"))
    out = [*DOC_COLUMNS, "n_best", "count_sum", "groups_sha256"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        number = right.column("number").to_numpy()
        sums = []
        groups = left.column("groups").combine_chunks()
        if isinstance(groups, pa.ChunkedArray):
            groups = pa.concat_arrays(groups.chunks) if groups.num_chunks else pa.array([], pa.list_(pa.int32()))
        flat = groups.flatten().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(np.asarray(groups.value_lengths().to_numpy(zero_copy_only=False)))])
        for name in ("best", "total"):
            by = np.zeros(len(number), np.int64)
            by[number] = right.column(name).to_numpy()
            total = np.concatenate([[0], np.cumsum(by[flat])]).astype(np.int64)
            sums.append(pa.array(np.diff(total[ends.astype(np.int64)])))
        return pa.Table.from_arrays([left.column("id"), *(left.column(c) for c in DOC_COLUMNS), *sums,
                                     left.column("sha")], ["id", *out])

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, {', '.join(f'{c} long' for c in out[:-1])}, groups_sha256 string"
    return (workers_ready(docs).groupBy("block").cogroup(own.groupBy("of")).applyInArrow(run, schema)
            .withColumnRenamed("id", id_col))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER,
           a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """Counts, sums and digest of every document."""
    rows = table(encoded(docs, id_col, text_col, folder, a_file, b_file), "aligned")
    lists = table(corpus_shapes(rows), "shapes")
    return document_sums(rows, scored(lists, pair_counts(lists)), id_col)


def alignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER,
               a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """The groups themselves: id, ``a_ids``, ``b_ids`` and the number of the
    group of each token (``a_group``, ``b_group``) of every document."""
    source = docs.select(id_col, text_col)
    kind = source.schema[id_col].dataType.simpleString()

    def lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _blocks(batches):
            x = align(texts, folder, a_file, b_file)
            a_group = x.a_group - np.repeat(x.groups[:-1], x.a.count)
            b_group = x.b_group - np.repeat(x.groups[:-1], x.b.count)
            yield pa.RecordBatch.from_arrays(
                [ids, lists(x.a.ids, x.a.first), lists(x.b.ids, x.b.first), lists(a_group, x.a.first),
                 lists(b_group, x.b.first)], [id_col, "a_ids", "b_ids", "a_group", "b_group"])

    return map_arrow(source, run, f"`{id_col}` {kind}, a_ids array<int>, b_ids array<int>, a_group array<int>, "
                                  "b_group array<int>")
