"""Secrets in texts (operator 8).

Three fixed patterns (``BASE_KINDS``) give the base spans.  The method adds
spans of kind ``entropy``: over every candidate string (a long run of
key-like characters) slides a window whose character counts are kept up by
one increment and one decrement a step, so the Shannon entropy of each
window costs constant time.  Windows over the limit of the string's
character class are joined into spans, unless an allow-list pattern covers
the string or a base span touches the span.  One pass, no shuffle.

Defined results: a null text counts as empty; no spans give empty lists and
the hash of the empty string; rows are scanned one by one, so repeated rows
and null ids come out as they went in; texts are read whole; an empty table
gives an empty result.  Positions are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.llm.common import map_arrow

# The base patterns, in the order of their kinds.
# (password|passwd|secret|token|api_?key), ASCII letters in either case; the
# first letters stand apart so that the search skips quickly.
ASSIGN = re.compile(r"(?:[Pp](?ai:assword|asswd)|[Ss](?ai:ecret)|[Tt](?ai:oken)|[Aa](?ai:pi_?key))"
                    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ with 24 or more
BASE_KINDS = ("assign", "access", "hex")
ENTROPY = "entropy"
_RANK = {k: i for i, k in enumerate((*BASE_KINDS, ENTROPY))}

Span = tuple[str, int, int]


@dataclass(frozen=True)
class Scan:
    """``limits``: least entropy in bits of a window, by character class.
    Each is under what all but 0.5 % of the windows of a random key of the
    class have; words with numbers at their end (``word``, and ``words`` with
    separators) are as rich as short keys, so theirs are higher.
    ``allowed``: strings that one of these matches whole are no secrets."""

    window: int = 20
    limits: tuple = (("hex", 2.8), ("word", 3.8), ("words", 3.9), ("base32", 3.2), ("lower", 3.2),
                     ("upper", 3.2), ("alnum", 3.5), ("base64", 3.5))
    allowed: tuple = (
        r"[A-Za-z_=/-]+",  # words without digits, paths
        r"[0-9_=/+-]+",  # numbers
        r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUID
        r"(?i).*(example|placeholder|changeme|dummy|sample|x{6}|0{8}|12345678|abcdefgh).*",
        r"([A-Za-z]+|[0-9]+)([_/-]+([A-Za-z]+|[0-9]+))+",  # slugs and paths
    )


CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_PART = r"(?:[A-Za-z]+[0-9]{0,4}|[0-9]+)"
#: The first that matches a whole string is its class; base64 otherwise.
CLASSES = tuple((kind, re.compile(p)) for kind, p in (
    ("hex", r"[0-9a-fA-F]+"), ("word", r"[A-Za-z]+[0-9]{0,4}"),
    ("words", rf"[_/=-]*{_PART}(?:[_/-]+{_PART})*[_/=-]*"), ("base32", r"[A-Z2-7]+|[a-z2-7]+"),
    ("lower", r"[a-z0-9]+"), ("upper", r"[A-Z0-9]+"), ("alnum", r"[0-9A-Za-z]+")))


def base_spans(text: str) -> list[Span]:
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], _RANK[s[0]]))


def high_entropy(string: str, window: int, limit: float) -> Iterator[tuple[int, int]]:
    """Joined windows of ``string`` with ``limit`` bits or more."""
    c_log = [0.0] + [c * log2(c) for c in range(1, window + 2)]
    counts: dict[str, int] = {}
    total, full = 0.0, log2(window)  # total: sum of c * log2(c)
    begin = end = -1
    for i, ch in enumerate(string):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += c_log[c + 1] - c_log[c]
        if i >= window:
            old = string[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += c_log[c - 1] - c_log[c]
        if i >= window - 1 and full - total / window >= limit - 1e-9:
            if i - window + 1 > end or begin < 0:
                if begin >= 0:
                    yield begin, end
                begin = i - window + 1
            end = i + 1
    if begin >= 0:
        yield begin, end


class Scanner:
    def __init__(self, scan: Scan):
        self.window, self.limits = scan.window, dict(scan.limits)
        self.allowed = [re.compile(p) for p in scan.allowed]

    def __call__(self, text: str) -> list[Span]:
        base = base_spans(text)
        out = list(base)
        for m in CANDIDATE.finditer(text):
            s = m.group()
            if s.isalpha() or any(p.fullmatch(s) for p in self.allowed):
                continue
            kind = next((k for k, p in CLASSES if p.fullmatch(s)), "base64")
            for a, b in high_entropy(s, self.window, self.limits[kind]):
                a, b = a + m.start(), b + m.start()
                if not any(x < b and a < y for _, x, y in base):
                    out.append((ENTROPY, a, b))
        return sorted(out, key=lambda s: (s[1], _RANK[s[0]]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with each maximal run of spans replaced by a mark that names
    the first span's kind."""
    out, at = [], 0
    k = 0
    while k < len(spans):
        kind, a, b = spans[k]
        k += 1
        while k < len(spans) and spans[k][1] < b:
            b = max(b, spans[k][2])
            k += 1
        out += [text[at:a], f"<{kind}>"]
        at = b
    return "".join([*out, text[at:]]) if out else text


def secrets(docs: DataFrame, scan: Scan = Scan(), id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, begin, end>>) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(scan)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = [[{"kind": k, "begin": a, "end": b} for k, a, b in scanner(x.as_py() or "")]
                     for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["id", "spans"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = source.schema["id"].dataType.simpleString()
    out = map_arrow(source, run, f"id {kind}, spans array<struct<kind:string,begin:bigint,end:bigint>>")
    return out.withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by kind, the hash of the base spans and all spans as text."""
    text = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(
        ":", x["kind"], x["begin"].cast("string"), x["end"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint")
    base = F.filter("spans", lambda x: x["kind"] != ENTROPY)
    return found.select(id_col, *(of(k).alias(f"n_{k}") for k in BASE_KINDS),
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
                        of(ENTROPY).alias("n_entropy"))


def redacted(docs: DataFrame, scan: Scan = Scan(), text_col: str = "text",
             length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with secrets replaced by marks; ``length_col`` follows."""
    at = docs.columns.index(text_col)
    length = docs.columns.index(length_col) if length_col in docs.columns else None
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(scan)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            new = [None if t is None else redact(t, scanner(t)) for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array(new, columns[at].type)
            if length is not None:
                old = columns[length].to_pylist()
                columns[length] = pa.array([n if t == u else len(u) for t, u, n in zip(texts, new, old)],
                                           columns[length].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_arrow(docs, run, schema)
