"""Quality rules from repetition coverage (operator 7).

Rolling hashes of several n-gram lengths are formed over all words of a
group of texts in numpy; an n-gram is repeated if its hash comes twice or
more in its own text.  The rules look at the share of a text's characters
that repeated n-grams and repeated lines cover.  One pass, no shuffle.

Defined results: a null text counts as empty (no words, fails the base
rules); rows are judged one by one, so repeated rows and null ids come out
as they went in; texts of any length are read whole; an empty table gives
an empty result; columns other than the id and the text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shopcast.llm.common import map_arrow
from shopcast.llm.words import (BASE, U64, Words, buffers, groups, inside_text, mix, ngram_hash,
                                prefix_hash)

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
#: The window of the base rule, in words.
BASE_WINDOW = 5


@dataclass(frozen=True)
class Rules:
    """Limits.  ``coverage``: n-gram length to the largest share of word
    characters inside repeated n-grams, the first one included (so about
    twice the limits that are usual for later copies alone); ``lines``: the
    largest share of word characters in lines equal to an earlier line;
    ``symbols``: the largest number of symbols a word."""

    min_words: int = 10
    repeat_percent: int = 20
    coverage: dict = field(default_factory=lambda: {3: 0.50, 5: 0.30, 7: 0.26, 10: 0.22})
    lines: float = 0.30
    symbols: float = 0.25


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Positions of the keys that come twice or more, in the order of keys
    and then of positions."""
    ranked = np.sort(keys)
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if not len(twice):
        return np.zeros(0, np.int64)
    low = U64(0xFFFF)  # most keys go by a table lookup, the rest by a search
    maybe = np.zeros(1 << 16, bool)
    maybe[twice & low] = True
    at = np.flatnonzero(maybe[keys & low])
    near = np.minimum(np.searchsorted(twice, keys[at]), len(twice) - 1)
    hit = twice[near] == keys[at]
    return at[hit][np.argsort(near[hit], kind="stable")]


def _covered(w: Words, text_key: np.ndarray, n: int) -> np.ndarray:
    """Words inside an n-gram that its text has twice or more."""
    out = np.zeros(len(w.start), bool)
    at = np.flatnonzero(inside_text(w.first, n))
    if len(at):
        keys = mix(ngram_hash(w.hash, n)[at] + text_key[at])
        at = at[_repeated(keys)]
        step = np.zeros(len(w.start) + 1, np.int32)
        step[at] += 1
        step[at + n] -= 1
        out = np.cumsum(step)[:-1] > 0
    return out


def _sums(values: np.ndarray, text_of: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text_of, weights=values, minlength=n).astype(np.int64)


def measure(column: pa.Array, rules: Rules = Rules()) -> dict[str, np.ndarray]:
    """The measures and the verdict of each text of an Arrow column."""
    data, offsets = buffers(column)
    parts: list[dict[str, np.ndarray]] = [_measure(data, offsets[:1].repeat(1), rules)]
    parts += [_measure(data, offsets[i:j + 1], rules) for i, j in groups(offsets)]
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def _measure(data: np.ndarray, offsets: np.ndarray, rules: Rules) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    w = Words(data, offsets)
    text_of, chars, n_words = w.text_of, w.chars(), w.count
    text_key = mix((text_of + 1).astype(U64) * U64(BASE))
    out = {"n_words": n_words.astype(np.int64), "word_chars": _sums(chars, text_of, n)}
    symbols = np.zeros(len(w.data) + 1, np.int64)
    np.cumsum(SYMBOL[w.data], out=symbols[1:])
    out["n_symbols"] = symbols[w.offsets[1:]] - symbols[w.offsets[:-1]]

    # lines: every text begins one, and so does every \n
    breaks = np.flatnonzero(w.data == 10)
    begin = np.sort(np.concatenate([w.offsets[:-1], breaks + 1]), kind="stable")
    line_text = np.searchsorted(w.offsets[1:], begin, "right")
    # \n as a text's last byte begins an empty line that has no word
    end = np.concatenate([begin[1:], w.offsets[-1:]])[:len(begin)]
    end = np.where((end > begin) & (end > 0), end, begin)
    stop = np.where((end > begin) & (w.data[np.maximum(end - 1, 0)] == 10) if len(w.data) else False,
                    end - 1, end)
    a, b = np.searchsorted(w.start, begin), np.searchsorted(w.start, stop)
    full = b > a
    a, b, begin, stop = a[full], b[full], begin[full], stop[full]
    line_text = text_of[a] if len(a) else line_text[:0]
    keys = _line_hash(w.data, begin, stop)
    keys = mix(keys + mix((line_text + 1).astype(U64) * U64(BASE)))
    again = _repeated(keys)
    later = np.zeros(len(keys), bool)
    later[again[1:]] = keys[again][1:] == keys[again][:-1]
    total = np.concatenate([[0], np.cumsum(chars)])
    line_chars = total[b] - total[a]
    out["n_dup_lines"] = _sums(later, line_text, n)
    dup_chars = _sums(line_chars * later, line_text, n)

    base = _covered(w, text_key, BASE_WINDOW)
    out["n_repeat_words"] = _sums(base, text_of, n)
    per = np.maximum(out["word_chars"], 1)
    bad = dup_chars / per > rules.lines
    out["dup_line_share"] = dup_chars / per
    for k, most in sorted(rules.coverage.items()):
        cover = base if k == BASE_WINDOW else _covered(w, text_key, k)
        share = _sums(chars * cover, text_of, n) / per
        out[f"cover_{k}"] = share
        bad |= share > most
    bad |= out["n_symbols"] > rules.symbols * n_words
    out["base_failed"] = (n_words < rules.min_words) | (
        100 * out["n_repeat_words"] > rules.repeat_percent * n_words)
    out["kept"] = ~out["base_failed"] & ~bad
    return out


def _line_hash(data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    if not len(begin):
        return np.zeros(0, U64)
    sums, down = prefix_hash(data)
    return mix((sums[stop] - sums[begin]) * down[begin] + (stop - begin).astype(U64))


def repetition(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per document: id, measures, ``base_failed`` and ``kept``."""
    shares = ["dup_line_share"] + [f"cover_{k}" for k in sorted(rules.coverage)]
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = measure(batch.column(1), rules)
            names = [*longs, *shares, "base_failed", "kept"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(m[k]) for k in names)], [id_col, *names])

    source = docs.select(id_col, text_col)
    kind = source.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"`{id_col}` {kind}", *(f"{k} bigint" for k in longs),
                        *(f"{k} double" for k in shares), "base_failed boolean", "kept boolean"])
    return map_arrow(source, run, schema)


def keep_good(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(measure(batch.column(at), rules)["kept"]))

    return map_arrow(docs, run, docs.schema)
