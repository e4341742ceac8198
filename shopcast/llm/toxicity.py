"""Toxicity by a weighted finite-state pattern grammar (operator 9).

A text is cut into clauses and each clause into words.  The lexicon turns
words into marks (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER).  Small
weighted transducers (``llm.transducers``) rewrite the marks:

* report: from a REPORT to the end of the clause, insults and threats are
  written as reported;
* negation: a NEGATION does the same for the next few words;
* target: an INSULT within a few words after a TARGET is written as aimed;
* threat: a THREAT and a TARGET near each other, in either order, end in a
  THREATENED mark.

Their composition is one machine, built once; it reads a clause in one pass
and writes which clauses match which kind of pattern (see ``KINDS``), each
arc that completes one with the starting weight of its kind.

The score is a logistic function of the numbers of matched clauses by kind;
words outside a matched clause do not count.  The lexicon of insults starts
from a fixed list and grows by what the labels teach: word beginnings that
stand in toxic texts in many contexts, then, from the toxic texts that are
still not matched, whole words that hardly any clean text has.  So languages
without a list are covered; the weights of the kinds are learned as well.
All are fitted on a sample of labelled rows of at most
``Fit.rows`` expected rows, drawn by a hash, never from held-out rows.

Defined results: null and empty texts have no clause and get the score of
none; rows are scored one by one, so repeated rows and null ids come out as
they went in; a null label or a document without a label isn't learned
from; without any usable labels the starting weights hold; texts are read
whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopcast.llm.common import map_arrow, table
from shopcast.llm.transducers import Machine, compose, machine

# The starting lexicon.
INSULTS = frozenset(
    "idiot idiots moron morons stupid scum trash loser losers worthless pathetic disgusting clown imbecile "
    "dumbass bastard asshole jerk scumbag dimwit retard filth vermin garbage "
    "abschaum dummkopf trottel vollidiot arschloch "
    "imbécile crétin connard abruti ordure "
    "estúpido imbécil escoria inútil".split())
THREATS = frozenset(
    "kill hurt destroy beat stab shoot murder die hang burn strangle "
    "töten umbringen tuer frapper matar golpear".split())
TARGETS = frozenset(
    "you your yours u ur he she they him her them this these those people everyone "
    "du dich dir ihr sie euch tu toi vous tes tú te usted ustedes ellos ellas".split())
NEGATIONS = frozenset(
    "not no never isn't aren't wasn't don't doesn't nobody nothing without hardly "
    "nicht kein keine keinen nie ne pas jamais aucun ningún nunca jamás".split())
REPORTS = frozenset(
    "said says say called calls wrote writes quoted quote quotes according reported claimed "
    "sagte sagt nannte dit appelé dijo dice llamó".split())
#: Kinds of matched clauses and the weights before any label is seen.
KINDS = ("plain", "aimed", "negated", "reported", "threat")
START = np.array([-3.0, 2.5, 3.0, 0.5, 0.7, 3.0])

CLAUSE = re.compile(r"[.!?;:\n]+")
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
#: Words that a negation and a target reach ahead.
NEGATION_REACH, TARGET_REACH = 3, 4


OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = "other", "insult", "threat", "target", "negation", "report"
MARKS = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT)
AIMED, NEGATED, REPORTED, THREATENED = "aimed", "negated", "reported", "threatened"
#: The kind that a written mark completes.
KIND_OF = {INSULT: 0, AIMED: 1, NEGATED: 2, REPORTED: 3, THREATENED: 4}


def reporting() -> Machine:
    """After REPORT: insults reported, threats and targets without effect."""
    def arc(said, mark):
        if said and mark in (INSULT, THREAT, TARGET):
            return 1, {INSULT: REPORTED}.get(mark, OTHER), 0.0
        return int(said or mark == REPORT), mark, 0.0
    return machine(0, MARKS, arc)


def negating(reach: int = NEGATION_REACH) -> Machine:
    """``reach`` words after NEGATION: insults negated, threats void."""
    def arc(left, mark):
        after = reach if mark == NEGATION else max(left - 1, 0)
        written = {INSULT: NEGATED, THREAT: OTHER}.get(mark, mark) if left else mark
        return after, written, 0.0
    return machine(0, (*MARKS, REPORTED), arc)


def aiming(reach: int = TARGET_REACH) -> Machine:
    """A TARGET up to ``reach`` words before: insults aimed, a threat
    threatens; a TARGET up to ``reach`` words after a threat does as well."""
    def arc(state, mark):
        aimed, threat = state
        written = mark
        if mark == INSULT and aimed:
            written = AIMED
        elif mark == THREAT and aimed or mark == TARGET and threat and not aimed:
            written = THREATENED
        after = (reach if mark == TARGET else max(aimed - 1, 0), reach if mark == THREAT else max(threat - 1, 0))
        kind = KIND_OF.get(written)
        return after, written, 0.0 if kind is None else float(START[kind + 1])
    return machine((0, 0), (*MARKS, REPORTED, NEGATED), arc)


#: One machine for the whole grammar.
PATTERNS = compose(compose(reporting(), negating(), MARKS), aiming(), MARKS)


@dataclass(frozen=True)
class Fit:
    """``rows``: the sample bound; ``beginnings``: lengths of learned word
    beginnings; ``contexts``: different left neighbours that a beginning has
    in toxic texts at least; ``purity``: least toxic share of its contexts;
    ``texts``, ``missed``: toxic texts that a learned word has at least, and
    those of them that nothing else matches."""

    rows: int = 12_000
    beginnings: tuple[int, ...] = (4, 5, 6)
    contexts: int = 8
    purity: float = 0.85
    texts: int = 3
    missed: int = 2
    seed: int = 29


class Grammar:
    def __init__(self, stems: frozenset[str] = frozenset(), learned: frozenset[str] = frozenset()):
        self.lengths = sorted({len(s) for s in stems})
        self.stems = stems
        self.words = INSULTS | learned
        self.triggers = self.words | THREATS

    def insult(self, word: str) -> bool:
        return word in self.words or any(word[:n] in self.stems for n in self.lengths)

    def mark(self, word: str) -> str:
        if self.insult(word):
            return INSULT
        for mark, words in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
            if word in words:
                return mark
        return OTHER

    def matches(self, text: str) -> list[int]:
        """Numbers of matched clauses by kind."""
        out = [0] * len(KINDS)
        text = text.lower()
        known = set(TOKEN.findall(text))
        if self.triggers.isdisjoint(known) and all(
                self.stems.isdisjoint([w[:n] for w in known]) for n in self.lengths):
            return out
        for clause in CLAUSE.split(text):
            for written in PATTERNS.run(map(self.mark, TOKEN.findall(clause)))[0]:
                if written in KIND_OF:
                    out[KIND_OF[written]] += 1
        return out


def features(counts: np.ndarray) -> np.ndarray:
    return np.hstack([np.ones((len(counts), 1)), np.log2(1.0 + counts)])


def fit_weights(counts: np.ndarray, labels: np.ndarray, steps: int = 30, pull: float = 1.0) -> np.ndarray:
    """Logistic weights by Newton steps, pulled to the starting weights."""
    w = START.copy()
    if not len(labels):
        return w
    x = features(counts)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - labels) + pull * (w - START)
        hess = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        w = w - np.linalg.solve(hess, grad)
    w[1:] = np.maximum(w[1:], 0.0)  # no pattern speaks for a text
    return w


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, fit: Fit) -> DataFrame:
    """(id, t, y) of the rows to learn from; docs (id, t), labels (id, y)."""
    usable = labels.filter("y is not null and id is not null").filter(~held_out(F.col("id")))
    usable = usable.groupBy("id").agg(F.max("y").alias("y"))
    n = max(usable.count(), 1)
    share = int(min(1.0, fit.rows / n) * 1_000_000)
    usable = usable.filter(F.pmod(F.xxhash64(F.lit(fit.seed), "id"), F.lit(1_000_000)) < share)
    return docs.join(usable, "id")


def learn_stems(rows: DataFrame, fit: Fit) -> frozenset[str]:
    """Word beginnings that stand in toxic texts only, in many contexts."""

    def by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, y in zip(batch.column("t").to_pylist(), batch.column("y").to_pylist()):
                words = set(TOKEN.findall((text or "").lower()))
                for s in {w[:n] for w in words for n in fit.beginnings if len(w) >= n}:
                    c = counts.setdefault(s, [0, 0])
                    c[1 if y else 0] += 1
            yield pa.RecordBatch.from_pydict({"s": list(counts), "clean": [c[0] for c in counts.values()],
                                              "toxic": [c[1] for c in counts.values()]},
                                             schema=pa.schema([("s", pa.string()), ("clean", pa.int64()),
                                                               ("toxic", pa.int64())]))

    sums = map_arrow(rows, by_text, "s string, clean bigint, toxic bigint").groupBy("s").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    likely = [r[0] for r in sums.filter((F.col("toxic") >= max(fit.contexts // 2, 1)) & (
        F.col("toxic") >= fit.purity * (F.col("toxic") + F.col("clean")))).select("s").collect()]
    wanted = frozenset(likely)

    def by_context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[tuple[str, str, bool]] = set()
            for text, y in zip(batch.column("t").to_pylist(), batch.column("y").to_pylist()):
                words = TOKEN.findall((text or "").lower())
                for left, word in zip(["", *words], words):
                    for n in fit.beginnings:
                        if word[:n] in wanted and len(word) >= n:
                            found.add((word[:n], left, bool(y)))
            yield pa.RecordBatch.from_pydict(
                {"s": [f[0] for f in found], "left": [f[1] for f in found], "y": [f[2] for f in found]},
                schema=pa.schema([("s", pa.string()), ("left", pa.string()), ("y", pa.bool_())]))

    contexts = map_arrow(rows, by_context, "s string, left string, y boolean").distinct().groupBy("s").agg(
        F.count_if("y").alias("toxic"), F.count(F.lit(1)).alias("n"))
    good = {r[0] for r in contexts.filter((F.col("toxic") >= fit.contexts) & (
        F.col("toxic") >= fit.purity * F.col("n"))).select("s").collect()}
    short = sorted(good, key=len)
    return frozenset(s for s in short if not any(s[:n] in good for n in range(1, len(s))))


def learn_words(rows: DataFrame, grammar: Grammar, fit: Fit) -> frozenset[str]:
    """Whole words of the toxic texts that ``grammar`` doesn't match, if
    hardly any clean text has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, y in zip(batch.column("t").to_pylist(), batch.column("y").to_pylist()):
                missed = bool(y) and not any(grammar.matches(text or ""))
                for word in set(TOKEN.findall((text or "").lower())):
                    c = counts.setdefault(word, [0, 0, 0])
                    c[1 if y else 0] += 1
                    c[2] += missed
            columns = list(zip(*counts.values())) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                              *(pa.array(c, pa.int64()) for c in columns)], names)

    names = ["s", "clean", "toxic", "missed"]
    sums = map_arrow(rows, run, "s string, clean bigint, toxic bigint, missed bigint").groupBy("s").agg(
        *(F.sum(c).alias(c) for c in names[1:]))
    good = sums.filter((F.col("toxic") >= fit.texts) & (F.col("missed") >= fit.missed) & (
        F.col("toxic") >= fit.purity * (F.col("toxic") + F.col("clean"))))
    return frozenset(r[0] for r in good.select("s").collect())


def _counted(rows: DataFrame, grammar: Grammar, more: str) -> DataFrame:
    """(``more`` columns, m) with the matched clauses by kind of column t."""
    names = [c.strip().split(" ")[0] for c in more.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = [grammar.matches(t or "") for t in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(m, pa.list_(pa.int64()))],
                                             [*names, "m"])

    return map_arrow(rows, run, f"{more}, m array<bigint>")


def toxicity(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, held_out, score, predicted, and matched clauses by kind)."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    rows = table(sample(source, known, fit).select("id", "t", "y"), "labelled")
    stems = learn_stems(rows, fit)
    grammar = Grammar(stems, learn_words(rows, Grammar(stems), fit))
    seen = _counted(rows.select("y", "t"), grammar, "y int").groupBy("m", "y").count().collect()
    # equal rows of counts come once with their number: a few thousand at most
    counts = np.array([r["m"] for r in seen for _ in range(r["count"])], float).reshape(-1, len(KINDS))
    w = fit_weights(counts, np.array([r["y"] for r in seen for _ in range(r["count"])], float))
    kind = source.schema["id"].dataType.simpleString()
    scored = _counted(source, grammar, f"id {kind}")
    z = F.lit(float(w[0]))
    for i in range(len(KINDS)):
        z = z + F.lit(float(w[i + 1])) * F.log2(F.col("m")[i] + 1)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), score.alias("score"),
                         (score >= 0.5).cast("int").alias("predicted"),
                         *(F.col("m")[i].alias(f"n_{k}") for i, k in enumerate(KINDS)))
