"""Embedding whitening: principal components by QDWH spectral divide-and-conquer, exact integer moments."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ecostar.llm.codes import _slices, finite
from ecostar.llm.common import staged

COMPONENTS, SCALE, SHIFT = 8, 1024, 100_000
#: Integers lie within this bound of SHIFT, so that sums stay exact.
BOUND = 2**40
#: Groups that the tasks' partial sums are added up in first.
BUCKETS = 256
_EPS = np.finfo(float).eps


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, its matrix sign, by dynamically weighted Halley steps."""
    n, least = len(a), 1e-15
    x, eye = a / np.linalg.norm(a), np.eye(len(a))
    for _ in range(30):
        sq = least * least
        d = (4 * (1 - sq) / (sq * sq)) ** (1 / 3)
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(8 - 4 * d + 8 * (2 - sq) / (sq * root)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            after = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            after = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(eye + wc * (x.T @ x), x.T).T
        moved, x = np.linalg.norm(after - x), (after + after.T) / 2
        least = min(1.0, least * (wa + wb * sq) / (1 + wc * sq))
        if least > 1 - 1e-14 and moved < 1e-8 * np.sqrt(n):
            break
    return x


def _split(a: np.ndarray, scale: float) -> tuple[np.ndarray, int] | None:
    """(basis, k): the first k columns span the eigenvectors above a shift, the others those below; None where all are equal."""
    n, mean = len(a), float(np.trace(a)) / len(a)
    spread = np.linalg.norm(a - mean * np.eye(n))
    if spread <= 4 * n * _EPS * scale:
        return None
    rng, best = np.random.default_rng(n), None
    tries = [float(np.median(np.diag(a))), mean, *(mean + spread / np.sqrt(n) * f for f in (0.05, -0.05, 0.2, -0.2, 0.5, -0.5))]
    for shift in tries:
        sign = polar(a - shift * np.eye(n))
        up = (sign + np.eye(n)) / 2
        k = int(round(float(np.trace(up))))
        if not 0 < k < n:
            continue
        basis = rng.normal(size=(n, n))
        for _ in range(2):  # projected twice, so that the random start leaves nothing behind
            basis, _ = np.linalg.qr(np.hstack([up @ basis[:, :k], basis[:, k:] - up @ basis[:, k:]]))
        left = np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k])
        if best is None or left < best[0]:
            best = left, basis, k
        if left <= 8 * n * _EPS * scale:
            break
    return (best[1], best[2]) if best else None


def _rotation(a: np.ndarray) -> np.ndarray:
    """Eigenvectors of a symmetric 2 x 2 matrix."""
    angle = 0.5 * np.arctan2(2 * a[0, 1], a[0, 0] - a[1, 1])
    return np.array([[np.cos(angle), -np.sin(angle)], [np.sin(angle), np.cos(angle)]])


def top_components(cov: np.ndarray, want: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the ``want`` largest, falling.

    An invariant subspace is split by the spectral projector of a shift, until its parts
    are single components (or all their eigenvalues equal). Parts that lie wholly below
    the wanted ones are left unsplit.
    """
    cov = (cov + cov.T) / 2
    scale, out = max(float(np.linalg.norm(cov)), 1e-300), []
    todo = [np.eye(len(cov))]
    while todo and sum(v.shape[1] for v in out) < want:
        basis = todo.pop()
        inner = basis.T @ cov @ basis
        inner = (inner + inner.T) / 2
        if len(inner) == 2:
            out.append(basis @ _rotation(inner))
        elif len(inner) == 1 or (parts := _split(inner, scale)) is None:
            out.append(basis)
        else:
            todo += [basis @ parts[0][:, parts[1] :], basis @ parts[0][:, : parts[1]]]  # the upper part next
    vectors, _ = np.linalg.qr(np.hstack(out)) if out else (np.zeros((0, 0)), None)
    values = np.einsum("ij,ij->j", vectors, cov @ vectors)
    order = np.argsort(-values, kind="stable")[:want]
    return np.maximum(values[order], 0.0), vectors[:, order]


class Model(NamedTuple):
    """Of the vectors of one length: count, exact sums, components as columns, eigenvalues, trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n without loss: the whole part of the mean leaves in integers."""
        base = [s // self.n for s in self.sums]
        rest = np.array([(s - b * self.n) / self.n for s, b in zip(self.sums, base, strict=True)])
        return (x - np.array(base, np.int64)).astype(float) - rest

    def used(self) -> np.ndarray:
        """Whether a component varies at all, beyond rounding."""
        return self.values > len(self.sums) * 16 * _EPS * max(self.trace, 0.0)


def whole(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values * float(SCALE)), -BOUND, BOUND).astype(np.int64) + SHIFT


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums over components of (n x - S)^2; null where one fits no long."""
    about = ((n * x.astype(float) - np.array(sums, float)) ** 2).sum(axis=1)
    if n * (BOUND + SHIFT) < 2**62 and (not len(x) or about.max() < 2**62):
        far = n * x - np.array(sums, np.int64)
        return (far * far).sum(axis=1).tolist()
    out = []
    for row, size in zip(x.tolist(), about, strict=True):
        exact = sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) if size < 2**64 else 2**64
        out.append(exact if exact < 2**63 else None)
    return out


def _gram(frame: DataFrame, rows_of, schema: str = "dim int, task int, i int, row array<double>") -> DataFrame:
    """(dim, i, row): sums of the tasks' partial matrices, added up in two levels."""
    partial = frame.mapInArrow(rows_of, schema)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.iloc[:1].assign(row=[np.sum(np.stack(pdf["row"].to_list()), axis=0)])

    dealt = partial.withColumn("task", F.pmod("task", F.lit(BUCKETS)))
    level = dealt.groupBy("dim", "i", "task").applyInPandas(add, schema)
    return level.groupBy("dim", "i").applyInPandas(lambda pdf: add(pdf)[["dim", "i", "row"]], "dim int, i int, row array<double>")


def _emit(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    from pyspark import TaskContext

    rows = [(d, TaskContext.get().partitionId(), i, row.tolist()) for d, m in sums.items() for i, row in enumerate(m)]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, kinds, strict=True)], ["dim", "task", "i", "row"])


def _sums(good: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """(count, exact sums) per length."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = {}, {}
        for batch in batches:
            for dim, rows, values in _slices(batch):
                count[dim] = count.get(dim, 0) + len(rows)
                total[dim] = [a + b for a, b in zip(total.get(dim, [0] * dim), whole(values).sum(axis=0).tolist(), strict=True)]
        rows = [(d, count[d], list(map(str, total[d]))) for d in count]
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, kinds, strict=True)], ["dim", "n", "sums"])

    found = staged(good.select("v").mapInArrow(add, "dim int, n long, sums array<string>"), "vector-sums")
    sizes = {r["dim"]: r["n"] for r in found.groupBy("dim").agg(F.sum("n").alias("n")).collect()}
    each = found.select("dim", F.posexplode("sums").alias("k", "s")).groupBy("dim", "k").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums = {d: [0] * d for d in sizes}
    for r in each.collect():  # one row per dimension
        sums[r["dim"]][r["k"]] = int(r["s"])
    return {d: (n, sums[d]) for d, n in sizes.items()}


def train(good: DataFrame, want: int = COMPONENTS) -> dict[int, Model]:
    """One model per length of vectors; only sums and the wanted components reach the driver."""
    moments = _sums(good)
    bare = {d: Model(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0) for d, (n, sums) in moments.items()}

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, values in _slices(batch):
                y = bare[dim].centred(whole(values))
                sums[dim] = sums.get(dim, 0) + y.T @ y
        yield _emit(sums)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        dim = int(pdf["dim"].iloc[0])
        cov = np.stack(pdf.sort_values("i")["row"].to_list()) / bare[dim].n
        values, vectors = top_components(cov, want)
        return pd.DataFrame({"dim": [dim], "vals": [values], "vectors": [vectors.reshape(-1)], "trace": [float(np.trace(cov))]})

    found = _gram(good.select("v"), products).groupBy("dim").applyInPandas(solve, "dim int, vals array<double>, vectors array<double>, trace double")
    models = dict(bare)
    for r in found.collect():
        m = bare[r["dim"]]
        models[r["dim"]] = Model(m.n, m.sums, np.array(r["vectors"]).reshape(r["dim"], -1), np.array(r["vals"]), r["trace"])
    return models


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", want: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row per usable row of ``vectors`` and component.

    Integers x = floor(1024 c) + 100000 are centred by their exact means and projected on
    the ``want`` largest eigenvectors of their covariance. Sums, products and checks are
    added up per task and then in Spark; the model, sums and ``want`` components, is sent
    to all tasks, which then need no shuffle. ``identity_error`` is measured on the
    whitened values themselves.

    Rows whose vector is null or holds null or non-finite entries are left out. Null and
    repeated ids are rows like others. Vectors of different lengths are whitened apart,
    with fewer components where a length has fewer dimensions (an empty vector has none,
    so no row). A component that doesn't vary has whitened 0 and explained 0 and is left
    out of ``identity_error``. Entries beyond 2^30 are clipped; a ``deviation`` that fits
    no long is null. No usable rows give no rows; other columns are not read.
    """
    good = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(finite(F.col("v")))
    models = train(good, want)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows, values in _slices(batch):
                m, x = models[dim], whole(values)
                used, root = m.used(), np.sqrt(np.where(m.values > 0, m.values, 1.0))
                white = np.where(used, m.centred(x) @ m.vectors / root, 0.0)
                share = np.where(used, m.values / m.trace if m.trace > 0 else 0.0, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(rows)), pa.array([dim] * len(rows), pa.int32()), pa.array([m.n] * len(rows), pa.int64()),
                        pa.array(deviations(x, m.n, m.sums), pa.int64()), pa.array(list(white), pa.list_(pa.float64())),
                        pa.array([share.tolist()] * len(rows), pa.list_(pa.float64())),
                    ], ["id", "dim", "n", "deviation", "w", "share"],
                )

    kind = good.schema["id"].dataType.simpleString()
    white = staged(good.mapInArrow(project, f"id {kind}, dim int, n long, deviation long, w array<double>, share array<double>"), "whitened")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per length the products of the whitened values and, as a last row, their sums."""
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim in np.unique(batch.column("dim").to_numpy()):
                some = batch.filter(pc.equal(batch.column("dim"), int(dim)))
                w = some.column("w").flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, -1)
                sums[int(dim)] = sums.get(int(dim), 0) + np.vstack([w.T @ w, w.sum(axis=0)[None]])
        yield _emit(sums)

    found: dict[int, list] = {}
    for r in _gram(white.select("dim", "w"), moments).orderBy("dim", "i").collect():  # nine rows per length
        found.setdefault(r["dim"], []).append(r["row"])
    error = 0.0
    for dim, m in models.items():
        if dim in found and m.used().any():
            *products, sums = np.array(found[dim])
            mean = np.array(sums) / m.n
            cov = np.stack(products) / m.n - np.outer(mean, mean)
            error = max(error, float(np.abs(cov - np.eye(len(cov)))[np.ix_(m.used(), m.used())].max()))
    each = white.select("*", F.posexplode(F.arrays_zip("w", "share")).alias("place", "c"))
    return each.select(
        F.col("id").alias(id_col), (F.col("place") + 1).alias("component"), "n", "deviation", F.col("c.w").alias("whitened"),
        F.col("c.share").alias("explained"), F.lit(error).alias("identity_error"),
    )
