"""Whitening of embeddings by shifted CholeskyQR (operator 13).

Every entry c becomes the whole number x = floor(1024 c) + 100000.  With
the exact sums S of n rows the centred matrix A has rows x - S/n, formed
from the whole number n x - S.  The covariance is never formed from raw
moments.  Instead A is factored as Q R in passes over the rows:

* a pass sends each row through triangular solves with the factors found
  so far and sums the Gram matrix of what comes out;
* the driver takes its Cholesky factor, shifted in the first pass (and in
  a later one if the matrix isn't safely positive), and multiplies it on;
* after three passes R holds all of A but its left vectors, and the SVD of
  R (as wide as a vector, whatever n) gives components and variances.

Each task adds its rows block by block and hands on one Gram matrix, cell
by cell; Spark adds the cells.  The driver holds two matrices as wide as a
vector.  A last pass measures the covariance of the whitened rows.

Defined results: a vector that is null, empty or holds null or non-finite
entries is dropped; where lengths differ, those of the most frequent
length (of the longest of these) stay; repeated rows and null ids count as
they come; an entry beyond +-2^42 counts as that; components without
variance (below 1e-13 of the first) have no rows, so identical vectors or
a single one give an empty result, as an empty table does; a deviation
beyond 64 bits is null; equal variances may give any basis of their space,
the same for all rows.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.llm.common import map_arrow, table

SCALE, OFFSET, LARGEST = 1024.0, 100_000, 2.0 ** 52
#: Rows that one matrix product takes on.
BLOCK = 4096
#: Passes of triangular solves; the first one is shifted.
PASSES = 3
#: Variance of the last component over that of the first, at least.
LEAST = 1e-13


def _whole(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, offsets, ok): x of all entries of a list column, and which
    rows have nothing but finite ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    c = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(c))])
    ok = (lengths > 0) & (bad[offsets[1:]] == bad[offsets[:-1]])
    c = np.where(np.isfinite(c), np.clip(c, -LARGEST / SCALE, LARGEST / SCALE), 0.0)
    return np.floor(SCALE * c).astype(np.int64) + OFFSET, offsets, ok


def fit_list(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x) of the rows that remain."""
    source = vectors.select(id_col, vector_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, offsets, ok = _whole(batch.column(1))
            lengths = np.diff(offsets)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths[ok])]), pa.int32()),
                                             pa.array(x[np.repeat(ok, lengths)]))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), lists], ["id", "x"])

    kind = source.schema[id_col].dataType.simpleString()
    return map_arrow(source, run, f"id {kind}, x array<bigint>")


def _sums(rows: DataFrame) -> DataFrame:
    """(length, dim, n, hi, lo): sums of all entries, split at 2^32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            lengths = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            each = np.repeat(lengths, lengths)
            for d in map(int, np.unique(lengths)):
                x = values[each == d].reshape(-1, d)
                n, hi, lo = held.get(d, (0, 0, 0))
                held[d] = n + len(x), hi + (x >> 32).sum(0), lo + (x & 0xFFFFFFFF).sum(0)
        for d, (n, hi, lo) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d, d)), pa.array(np.arange(d)), pa.array(np.full(d, n)), pa.array(hi), pa.array(lo)],
                ["length", "dim", "n", "hi", "lo"])

    parts = map_arrow(rows.select("id", "x"), run, "length long, dim long, n long, hi long, lo long")
    return parts.groupBy("length", "dim").agg(*(F.sum(c).alias(c) for c in ("n", "hi", "lo")))


@dataclass(frozen=True)
class Centre:
    """n rows and the exact sums; ``n x - S = n (x - whole) - rest``."""

    n: int
    sums: tuple[int, ...]

    @property
    def width(self) -> int:
        return len(self.sums)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, as int64 where that holds its squares' sum, else exact
        whole numbers of any size."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        near = x - whole
        most = (float(np.abs(near).max(initial=0)) + 1) * self.n
        if most * most * self.width >= 2.0 ** 62:
            near, rest = near.astype(object), rest.astype(object)
        return near * self.n - rest

    def rows(self, x: np.ndarray) -> np.ndarray:
        """x - S/n as doubles."""
        return self.deviations(x).astype(np.float64) / self.n


def centre(rows: DataFrame) -> Centre | None:
    """Rows and sums of the most frequent length; None without rows."""
    sums = table(_sums(rows), "sums")
    top = sums.filter("dim = 0").orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
    if not top:
        return None
    own = sums.filter(F.col("length") == top[0].length).orderBy("dim").collect()
    return Centre(top[0].n, tuple((r.hi << 32) + r.lo for r in own))


def blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, matrix of x) of some rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def solve_upper(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q r = a, for an upper triangular r, column by column."""
    q = np.empty_like(a, order="F")
    for j in range(r.shape[0]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def gram(rows: DataFrame, centred: Centre, into: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The Gram matrix of ``into(rows of A)``, with their column sums as its
    last row and column."""
    wide = width + 1
    at = np.triu_indices(wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((wide, wide))
        for _, x in blocks(batches, centred.width):
            q = into(centred.rows(x))
            q = np.hstack([q, np.ones((len(q), 1))])
            total += q.T @ q
        yield pa.RecordBatch.from_arrays([pa.array(at[0] * wide + at[1]), pa.array(total[at])], ["cell", "v"])

    cells = map_arrow(rows, run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(wide * wide)
    out[[r.cell for r in cells]] = [r.v for r in cells]
    out = out.reshape(wide, wide)
    return out + np.triu(out, 1).T


def _cholesky(g: np.ndarray, shifted: bool) -> np.ndarray:
    """Upper triangular r with r'r = g, plus a shift above the rounding of
    the blockwise sums where asked for or needed."""
    d = len(g)
    if not shifted:
        try:
            r = np.linalg.cholesky(g).T
            if np.diag(r).min() ** 2 > 1e-12 * np.trace(g):
                return r
        except np.linalg.LinAlgError:
            pass
    shift = 11 * (BLOCK * d + d * (d + 1)) * np.finfo(float).eps / 2 * np.trace(g)
    return np.linalg.cholesky(g + shift * np.eye(d)).T


@dataclass(frozen=True)
class Whitening:
    """Unit components as columns, their variances, the variance in all."""

    centred: Centre
    components: np.ndarray
    variances: np.ndarray
    total: float

    def project(self, a: np.ndarray) -> np.ndarray:
        return a @ self.components / np.sqrt(self.variances)


def _solved(factors: list[np.ndarray]) -> Callable[[np.ndarray], np.ndarray]:
    def into(a: np.ndarray) -> np.ndarray:
        for r in factors:
            a = solve_upper(a, r)
        return a
    return into


def fit(rows: DataFrame, most: int = 8, passes: int = PASSES) -> tuple[DataFrame, Whitening] | None:
    """(rows of the fitted length, whitening); None if no vector varies."""
    centred = centre(rows)
    if centred is None:
        return None
    rows = rows.filter(F.size("x") == centred.width).select("id", "x")
    factors: list[np.ndarray] = []
    product = np.eye(centred.width)
    for turn in range(passes):
        g = gram(rows, centred, _solved(factors), centred.width)[:-1, :-1]
        if not np.trace(g) > 0:
            return None
        factors.append(_cholesky(g, shifted=turn == 0))
        product = factors[-1] @ product
    _, sigma, right = np.linalg.svd(product)
    e = sigma ** 2 / centred.n
    k = int((e[:most] > LEAST * e[0]).sum())
    return rows, Whitening(centred, np.ascontiguousarray(right[:k].T), e[:k], float(e.sum()))


def identity_error(rows: DataFrame, white: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity."""
    k, n = len(white.variances), white.centred.n
    g = gram(rows, white.centred, white.project, k)
    mean = g[:-1, -1] / n  # of centred rows: rounding alone
    return float(np.abs(g[:-1, :-1] / n - np.outer(mean, mean) - np.eye(k)).max())


def whitened(rows: DataFrame, white: Whitening, error: float, id_col: str = "vec_id") -> DataFrame:
    """One row for each vector and component: see the module's text."""
    n, k = white.centred.n, len(white.variances)
    explained = white.variances / white.total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in blocks(batches, white.centred.width):
            far = white.centred.deviations(x)
            squares = (far * far).sum(1)
            squares = pa.array([v if v < 2 ** 63 else None for v in squares.tolist()], pa.int64())
            m, at = len(x), pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [ids.take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), squares.take(at), pa.array(white.project(white.centred.rows(x)).ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = rows.schema["id"].dataType.simpleString()
    out = map_arrow(rows, run, f"id {kind}, component int, n long, deviation long, whitened double, "
                               "explained double, identity_error double")
    return out.withColumnRenamed("id", id_col)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 8) -> DataFrame:
    """Fits on all vectors that remain and whitens each of them."""
    rows = table(fit_list(vectors, id_col, vector_col), "vectors")
    found = fit(rows, most)
    if found is None:
        spark = vectors.sparkSession
        kind = rows.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"`{id_col}` {kind}, component int, n long, deviation long, "
                                         "whitened double, explained double, identity_error double")
    rows, white = found
    return whitened(rows, white, identity_error(rows, white), id_col)
