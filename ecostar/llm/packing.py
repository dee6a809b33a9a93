"""Best-fit packing by the sum of squares of open bins per residual gap."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ecostar.llm.common import let_go, text_rows
from ecostar.llm.tokens import Encoder

CAPACITY = 2048
#: Documents that are packed together, about; sequences never mix shards.
SHARD_DOCS = 4096
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, shard long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, ids binary"


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else full ones after a shorter first."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def place(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, longest first.

    open[g] counts the open bins with g left. A piece goes to the open bin whose change
    of gap makes the sum of the squares of these counts smallest (full bins don't count,
    ties go to the tightest bin), to a new bin where none has room.
    """
    count, bins = np.zeros(capacity + 1, np.int64), [[] for _ in range(capacity + 1)]
    to, offset, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        here = count[n:capacity]
        if n < capacity and here.any():
            after = 2 * count[: capacity - n]  # of a change of the sum less 2, which all places share
            after[0] = -1  # a bin that becomes full leaves the sum
            change = np.where(here > 0, after - 2 * here, np.iinfo(np.int64).max)
            gap = n + int(change.argmin())
            count[gap] -= 1
            to[i], offset[i] = bins[gap].pop(), capacity - gap
        else:
            gap = capacity
            to[i], offset[i] = made, 0
            made += 1
        if gap > n:
            count[gap - n] += 1
            bins[gap - n].append(to[i])
    return to, offset


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
    capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS, with_ids: bool = True,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids), one row per piece.

    Every row of ``docs`` is a document, repeated rows too; its ids are those of its text
    (null: empty) and then ``end_id``. Documents longer than ``capacity`` are cut. Shards
    of about ``shard_docs`` documents, dealt by a hash of id and text, are packed
    independently, so their number grows with the corpus and no task packs it all.
    ``with_ids=False`` leaves ``ids`` null and shuffles only the numbers.
    """
    shards = max(1, -(-docs.count() // shard_docs))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = Encoder.of(tokenizer), np.array([end_id], "<u4").tobytes()
        rows, size = [], 0
        for doc_id, text, shard in text_rows(batches, "id", "text", "shard"):
            ids = ids_of(text) + end
            for k, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                own = ids[4 * start : 4 * (start + n)]
                rows.append((doc_id, k, start, n, zlib.crc32(own), own if with_ids else None, shard))
            size += len(ids)
            if size > 1 << 23:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "shard"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]

    def put(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        let_go()
        pdf = pdf.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable", ignore_index=True)
        to, offset = place(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"], pdf["offset"] = (int(key[0]) << 40) + to, offset
        return pdf[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]]

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    dealt = F.pmod(F.xxhash64("id", "text"), F.lit(shards))
    found = rows.withColumn("shard", dealt).mapInArrow(encode, PIECES)
    return found.groupBy("shard").applyInPandas(put, PACKED)


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids binary, n_tokens): the packed sequences of ``pack(..., with_ids=True)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "length")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    total = F.aggregate("parts", F.lit(0).cast("long"), lambda acc, x: acc + x["length"])
    return grouped.select("sequence_id", joined.alias("ids"), total.alias("n_tokens"))
