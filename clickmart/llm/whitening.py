"""Embedding whitening on principal components of double precision.

Entries become whole numbers x = floor(64 c) + 1,000,000; each distinct x-vector counts once in the fit.

1. The sums per dimension are exact.  Products are summed over vectors centred at the whole number next to
   the mean, so every product and, below 2**53, every sum is exact too; partial matrices, one per partition,
   are added in a tree.  The rest of the mean, half a unit at most, is taken off in extended precision.
2. Eigenvectors of the covariance are computed in float32, then corrected by Ogita and Aishima's
   iteration, which consists of matrix products in extended precision and doubles the valid digits each
   time.  Eigenvalues nearer to each other than the residual bound form a cluster, whose pairs the iteration
   can't divide by their gap: it keeps the cluster's space, and a shifted sub-problem of the cluster's
   size, solved in double, turns the basis in it.  Later, as the bound falls, clusters part.
3. Each row is centred, projected and scaled; a further pass over the fit measures the covariance of what
   comes out.

Extended precision is numpy's ``longdouble`` (64 bits of mantissa on x86).  The driver holds d x d matrices
only; the largest a task holds is a batch of rows and one such matrix.

Nulls and edges: rows without a vector, or with a null or non-finite entry, or one whose x does not fit a
long, are left out; a null id is carried; repeated rows come out repeatedly but fit once.  Vectors
of another length have a fit of their own.  A component without variance (one vector only, fewer
vectors than dimensions) has whitened null; a deviation beyond a long is null, and so is ``explained``
without any variance.  Empty vectors have no components, an empty table gives an empty result; further columns
are ignored.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import clickmart.llm
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.llm.common import materialize

# workers need not have the package on their path
cloudpickle.register_pickle_by_value(clickmart.llm)

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: partial matrices that one task adds
FAN = 64
_LONG = 2**63
_WIDE = np.longdouble


# ---- eigenvectors ---------------------------------------------------------------------------

def _clusters(values: np.ndarray, bound: float) -> Iterator[np.ndarray]:
    """Places of eigenvalues that lie within ``bound`` of a neighbour, two or more together."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > bound) + 1
    return (part for part in np.split(order, cuts) if len(part) > 1)


def _turned(a: np.ndarray, basis: np.ndarray, centre) -> np.ndarray:
    """``basis`` of a cluster turned to the eigenvectors of the shifted problem within its space."""
    inner = basis.T @ (a @ basis - centre * basis)
    inner = (inner + inner.T) / 2
    size = np.abs(inner).max()
    if size == 0:
        return basis
    _, turn = np.linalg.eigh((inner / size).astype(np.float64))
    return basis @ turn.astype(_WIDE)


def refined(a: np.ndarray, x: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of the symmetric ``a`` from approximations ``x``.

    Ends when three rounds have not halved the residual bound; a cluster that has just parted may raise it once.
    """
    a, x = a.astype(_WIDE), x.astype(_WIDE)
    size = np.sqrt((a * a).sum())
    unit, best, found, idle = np.eye(len(a), dtype=_WIDE), np.inf, x, 0
    for _ in range(rounds):
        r, s = unit - x.T @ x, x.T @ a @ x
        # rounding that is not symmetric would be divided by small gaps
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        bound = 2 * (np.sqrt(((s - np.diag(values)) ** 2).sum()) + size * np.sqrt((r * r).sum()))
        idle = 0 if bound < best / 2 else idle + 1
        if bound < best:
            best, found = bound, x
        if idle == 3:
            break
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= bound
        with np.errstate(divide="ignore", invalid="ignore"):
            e = np.where(near, r / 2, (s + values[None, :] * r) / gap)
        x = x + x @ e
        for part in _clusters(values, bound):
            x[:, part] = _turned(a, x[:, part], values[part].mean())
    values = np.diag(found.T @ a @ found) / np.diag(found.T @ found)
    return values, found / np.sqrt((found * found).sum(axis=0))


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and their unit vectors, the largest entry of each positive."""
    size = np.abs(a).max(initial=0)
    if size == 0:
        return np.zeros(len(a)), np.eye(len(a))
    _, start = np.linalg.eigh((a / size).astype(np.float32))
    values, vectors = refined(a / size, start)
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(a))])
    return (values[order] * size).astype(np.float64), (vectors * signs).astype(np.float64)


# ---- sums over the cluster ------------------------------------------------------------------

def _tree_sum(rows: DataFrame, column: str, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all batches of ``part`` of the batch's vectors, added in a tree of tasks."""

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                own = part(np.stack(batch[column].to_numpy()))
                total = own if total is None else total + own
        if total is not None:
            yield pd.DataFrame({"sums": [total.tobytes()]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for sums in batch["sums"]:
                own = np.frombuffer(sums, np.float64)
                total = own if total is None else total + own
        if total is not None:
            yield pd.DataFrame({"sums": [total.tobytes()]})

    # the number of partial sums is that of the first stage's tasks
    partial = materialize(rows.select(column).mapInPandas(first, "sums binary"), "whitening-sums")
    left = partial.count()
    while left > 1:
        left = -(-left // FAN)
        partial = partial.repartition(left).mapInPandas(add, "sums binary")
    return np.frombuffer(partial.first().sums, np.float64)


@dataclass(frozen=True)
class Model:
    """The fit of all vectors of one length."""

    n: int
    sums: list[int]
    base: np.ndarray  # whole numbers next to the mean
    rest: np.ndarray  # mean less base
    values: np.ndarray  # the first eigenvalues
    total: float
    vectors: np.ndarray
    error: float | None = None

    @property
    def scaled(self) -> np.ndarray:
        """Projection that whitens; nan for components without variance."""
        limit = self.total * len(self.base) * 2.0**-50
        spread = np.where(self.values > limit, self.values, np.nan)
        return self.vectors / np.sqrt(spread)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        # within 2**53 of the mean the difference is exact
        return ((x - self.base).astype(np.float64) - self.rest) @ self.scaled

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 of each row, exact; None beyond a long."""
        offset = [s - self.n * int(b) for s, b in zip(self.sums, self.base, strict=True)]
        away = x - self.base
        reach = self.n * int(np.abs(away).max(initial=0)) + max(map(abs, offset), default=0)
        if reach * reach * max(1, len(offset)) < _LONG:
            return (((self.n * away - np.array(offset, np.int64)) ** 2).sum(axis=1)).tolist()
        found = [
            sum((self.n * (int(v) - int(b)) - o) ** 2 for v, b, o in zip(row, self.base, offset, strict=True))
            for row in x
        ]
        return [d if d < _LONG else None for d in found]


def whole_vectors(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """``table``'s usable rows with ``_x``, the whole-number vector."""
    c = F.col(vector)

    def usable(v):
        scaled = v.cast("double") * SCALE
        # nan is above every number
        return v.isNotNull() & (F.abs(scaled) < float(2**62))

    x = F.transform(c, lambda v: F.floor(v.cast("double") * SCALE).cast("long") + SHIFT)
    return table.filter(c.isNotNull() & F.forall(c, lambda v: F.coalesce(usable(v), F.lit(False)))).withColumn("_x", x)


def _model(vectors: DataFrame, n: int, sums: list[int], k: int) -> Model:
    d = len(sums)
    base = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    left = [s - n * int(b) for s, b in zip(sums, base, strict=True)]
    rest = np.array([r / n for r in left])

    def products(x: np.ndarray) -> np.ndarray:
        away = (x - base).astype(np.float64)
        return (away.T @ away).ravel()

    wide = np.array(left, dtype=_WIDE) / n
    v = _tree_sum(vectors, "_x", products).reshape(d, d).astype(_WIDE) / n - np.outer(wide, wide)
    values, basis = eigen((v + v.T) / 2)
    model = Model(n, sums, base, rest, values[:k], float(np.trace(v)), basis[:, :k])

    def outcome(x: np.ndarray) -> np.ndarray:
        y = np.nan_to_num(model.whiten(x))
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    live = ~np.isnan(model.scaled).any(axis=0)
    if not live.any():
        return model
    found = _tree_sum(vectors, "_x", outcome) / n
    k = len(live)
    covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    error = np.abs(covariance - np.eye(k))[np.ix_(live, live)].max()
    return Model(n, sums, base, rest, model.values, model.total, model.vectors, float(error))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> list[Model]:
    """A model for each length of the distinct vectors ``_x``, of at most ``components`` components."""
    distinct = materialize(vectors.select("_x").distinct().withColumn("_d", F.size("_x")), "whitening-fit")
    entries = distinct.select("_d", F.posexplode("_x").alias("_i", "_v"))
    # one row per dimension
    found = entries.groupBy("_d", "_i").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_v").cast("decimal(38,0)")).alias("s")
    ).orderBy("_d", "_i").collect()
    sums: dict[int, list] = {}
    for row in found:
        sums.setdefault(row["_d"], []).append((row.n, int(row.s)))
    return [
        _model(distinct.filter(F.col("_d") == d), own[0][0], [s for _, s in own], min(components, d))
        for d, own in sums.items()
    ]


def _matrices(x: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the vectors of each length."""
    lengths = x.value_lengths().to_numpy(zero_copy_only=False)
    flat = x.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        yield at, flat[starts[at][:, None] + np.arange(d)]


def whiten(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, list[Model]]:
    """The usable rows of ``table`` with ``deviation`` and ``whitened`` (array), and the models by length.

    Columns of these names are replaced.
    """
    models = fit(whole_vectors(table, vector), components)
    by_length = {len(m.sums): m for m in models}
    kept = [c for c in table.columns if c.lower() not in ("deviation", "whitened")]
    rows = whole_vectors(table, vector).select(*kept, F.col("_x").alias("deviation"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviation, whitened = [None] * batch.num_rows, [None] * batch.num_rows
            for at, x in _matrices(batch.column("deviation")):
                model = by_length.get(x.shape[1])
                if model is not None:
                    for i, own, row in zip(at, model.deviation(x), model.whiten(x), strict=True):
                        deviation[i], whitened[i] = own, [None if v != v else v for v in row.tolist()]
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(deviation, pa.int64()), pa.array(whitened, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "deviation", "whitened"])

    schema = T.StructType(
        [table.schema[c] for c in kept]
        + [T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    )
    return rows.mapInArrow(run, schema), models


def digest(table: DataFrame) -> DataFrame:
    """Contract columns: one row per usable row and component."""
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.size("embedding").alias("d"))
    found, models = whiten(rows)
    # one row per length, component
    facts = [
        (len(m.sums), c + 1, m.n, float(e / m.total) if m.total else None, m.error)
        for m in models for c, e in enumerate(m.values)
    ]
    about = table.sparkSession.createDataFrame(
        facts, "d int, component int, n long, explained double, identity_error double"
    )
    each = found.select(
        "vec_id", "d", "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).withColumn("component", F.col("at") + 1)
    return each.join(F.broadcast(about), ["d", "component"]).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )
