"""Vector codes by product quantisation in whole numbers; distances by per-dimension value dictionaries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ecostar.llm.common import spread_join, staged

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components in memory at a time in a task.
CELLS = 1 << 20


def finite(embedding: Column) -> Column:
    """True for an array without null, NaN or infinite components; an empty one has none."""
    ok = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(embedding.isNotNull() & ok, F.lit(False))


def whole(values: np.ndarray, dim: int, scale: int = SCALE) -> np.ndarray:
    """(rows, width of 16 parts) of floor(scale * x); kept so near 0 that the squares of a vector add up to a long."""
    width = -(-dim // PARTS)
    most = int((2**61 / max(PARTS * width, 1)) ** 0.5) // 2
    out = np.zeros((len(values), PARTS * width), np.int64)
    out[:, :dim] = np.clip(np.floor(values * float(scale)), -most, most)
    return out


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) per row of one part: x (rows, width), book (entries, width).

    A dimension's distinct values are its dictionary. The squared differences of each value
    to all entries are tabulated once; a row's distances are table rows, looked up by its
    dictionary codes and added.
    """
    total = np.zeros((len(x), len(book)), np.int64)
    for k in range(x.shape[1]):
        values, code = np.unique(x[:, k], return_inverse=True)
        table = (values[:, None] - book[None, :, k]) ** 2
        total += table[code]
    entry = total.argmin(axis=1)  # the first of equal ones
    return entry, total[np.arange(len(x)), entry]


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, rows, values) per length and bounded number of rows; ``rows`` are places in the batch."""
    vectors = batch.column("v")
    lengths = vectors.value_lengths().to_numpy()
    flat, starts = vectors.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(lengths))
    for dim in np.unique(lengths):
        rows, step = np.flatnonzero(lengths == dim), max(1, CELLS // max(int(dim), 1))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            yield int(dim), some, flat[starts[some][:, None] + np.arange(dim)[None]]


def _parts(x: np.ndarray) -> np.ndarray:
    return x.reshape(len(x), PARTS, -1)


def _totals(good: DataFrame, books: dict[int, np.ndarray]) -> dict[tuple[int, int, int], tuple[int, list[int]]]:
    """(count, component sums) of the parts nearest to each entry, by (dim, part, entry); a row per entry and task is shuffled."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = {d: np.zeros(b.shape[:2], np.int64) for d, b in books.items()}
        sums = {d: np.zeros(b.shape, np.int64) for d, b in books.items()}
        for batch in batches:
            for dim, _, values in _slices(batch):
                x = _parts(whole(values, dim))
                for p in range(PARTS):
                    entry, _ = nearest(x[:, p], books[dim][p])
                    count[dim][p] += np.bincount(entry, minlength=count[dim].shape[1])
                    np.add.at(sums[dim][p], entry, x[:, p])
        rows = [(d, *at, int(count[d][*at]), sums[d][*at].tolist()) for d in books for at in np.argwhere(count[d]).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, kinds, strict=True)], names)

    names = ["dim", "part", "entry", "n", "sums"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
    found = good.select("v").mapInArrow(add, "dim int, part int, entry int, n long, sums array<long>")
    width = max(b.shape[2] for b in books.values())
    each = [F.sum(F.get("sums", F.lit(k)).cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)]
    rows = found.groupBy("dim", "part", "entry").agg(F.sum("n").alias("n"), *each).collect()  # as many as entries
    return {(r["dim"], r["part"], r["entry"]): (r["n"], [int(r[f"s{k}"]) for k in range(books[r["dim"]].shape[2])]) for r in rows}


def _first(good: DataFrame, entries: int) -> dict[int, np.ndarray]:
    """Per length the codebooks (part, entry, component) of the smallest ids; of an id's different vectors the least counts."""
    ids = good.select("dim", "id").distinct()
    least = ids.withColumn("place", F.row_number().over(W.partitionBy("dim").orderBy(F.col("id").asc_nulls_last())))
    least = least.filter(F.col("place") <= entries)  # bounded: a few rows per length
    least = least.select(F.col("dim").alias("of"), F.col("id").alias("start"), "place")
    same = (F.col("dim") == F.col("of")) & F.col("id").eqNullSafe(F.col("start"))
    picked = good.join(F.broadcast(least), same).groupBy("dim", "place").agg(F.min("v").alias("v"))
    books: dict[int, list] = {}
    for r in picked.orderBy("dim", "place").collect():
        books.setdefault(r["dim"], []).append(_parts(whole(np.array([r["v"]], float), r["dim"]))[0])
    return {d: np.stack(b, axis=1) for d, b in books.items()}


def train(good: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> dict[int, np.ndarray]:
    books = _first(good, entries)
    for _ in range(rounds if books else 0):
        for (d, p, e), (n, sums) in _totals(good, books).items():
            books[d][p, e] = [s // n for s in sums]
    return books


def digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def encode(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256), one row per usable row of ``vectors``.

    Vectors are cut into 16 parts, each coded by its nearest codebook entry. Codebooks
    start from the smallest ids and are moved ``rounds`` times to the floored means of
    their parts, all in whole numbers, so the result is the same for any partitioning.
    Only codebooks and their sums (``entries`` rows a part) pass through the driver; the
    vectors are scanned once per round and are never shuffled.

    Rows whose vector is null or holds null or non-finite components are left out; null
    ids come after all others; repeated rows are coded each, and a repeated id is one
    start entry. Vectors of different lengths are coded apart, each length with its own
    codebooks; a length that 16 doesn't divide is filled up with zeros, so an empty vector
    has code 00.. and no error. A component beyond about 2^29 / 256 in 64 dimensions is
    clipped, as its squares would not fit a long. Null labels count as one label, a
    ``label_error`` that fits no long is null. No usable rows give no rows; other
    columns, whatever their names, are not read.
    """
    good = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v")
    ).filter(finite(F.col("v"))).withColumn("dim", F.size("v"))
    books = train(good, entries, rounds)
    shas = {d: digest(b) for d, b in books.items()}

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            codes, error, sha = np.zeros((n, PARTS), np.uint8), np.zeros(n, np.int64), np.empty(n, object)
            for dim, rows, values in _slices(batch):
                x = _parts(whole(values, dim))
                for p in range(PARTS):
                    codes[rows, p], far = nearest(x[:, p], books[dim][p])
                    error[rows] += far
                sha[rows] = shas[dim]
            text = pa.array([c.tobytes().hex() for c in codes], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), text, pa.array(error), pa.array(sha, pa.string())], names)

    names = ["id", "label", "code", "error", "codebooks_sha256"]
    schema = f"id {good.schema['id'].dataType.simpleString()}, label string, code string, error long, codebooks_sha256 string"
    coded = staged(good.select("id", "label", "v").mapInArrow(code, schema), "vector-codes")
    coded = coded.withColumn("key", F.coalesce(F.concat(F.lit("="), "label"), F.lit("")))
    sums = staged(coded.groupBy("key").agg(F.try_sum("error").alias("label_error")), "label-errors")
    return spread_join(coded, sums, ["key"], ["id", "code"]).select(
        F.col("id").alias(id_col), "code", "error", "label_error", "codebooks_sha256"
    )


def codes_sql() -> str:
    """The same in DuckDB SQL, for vectors of one length that 16 divides, with unique ids."""

    def assigned(name: str, books: str) -> str:
        return f"""
{name}_d AS (SELECT vec_id, p, r, sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN {books} c USING (p, j) GROUP BY vec_id, p, r),
{name} AS (SELECT vec_id, p, arg_min(r, (d, r)) AS r, min(d) AS d FROM {name}_d GROUP BY vec_id, p)"""

    def moved(name: str, books: str, by: str) -> str:
        return f"""
{name} AS (SELECT c.p, c.r, c.j, coalesce(m.v, c.v) AS v FROM {books} c LEFT JOIN (
  SELECT p, r, j, CAST(floor(sum(v) / count(*)) AS BIGINT) AS v FROM x JOIN {by} USING (vec_id, p) GROUP BY p, r, j) m USING (p, r, j))"""

    return f"""
WITH good AS (
  SELECT vec_id, label, embedding AS e, len(embedding) // {PARTS} AS w, row_number() OVER (ORDER BY vec_id) - 1 AS place
  FROM embeddings WHERE embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
),
x AS (
  SELECT vec_id, place, (i - 1) // w AS p, (i - 1) % w AS j, CAST(floor({SCALE} * CAST(e[i] AS DOUBLE)) AS BIGINT) AS v
  FROM (SELECT vec_id, place, w, e, unnest(range(1, len(e) + 1)) AS i FROM good)
),
c0 AS (SELECT p, place AS r, j, v FROM x WHERE place < {ENTRIES}),{assigned("a0", "c0")},{moved("c1", "c0", "a0")},{assigned("a1", "c1")},
{moved("c2", "c1", "a1")},{assigned("a2", "c2")},
sha AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, r, j)) AS codebooks_sha256 FROM c2),
coded AS (SELECT vec_id, string_agg(printf('%02x', r), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN good USING (vec_id) CROSS JOIN sha"""
