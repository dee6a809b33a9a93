"""Token ids as Arrow files of equal-length sequences and masks, and reading them back."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ecostar.llm.common import staged, text_rows
from ecostar.llm.tokens import Encoder
from ecostar.session import shared_folder

#: Ids of a sequence, sequences of a record batch.
LENGTH, BATCH = 2048, 64
SHARD_SCHEMA = "shard int, file string, documents long, tokens long"


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0] else (fs.LocalFileSystem(), folder)


def sequence_schema(length: int, narrow: bool) -> pa.Schema:
    """ids in 16 bits where the vocabulary allows it, else 32; ``mask`` is where a sequence's mask begins in the shared one.

    The shared mask, ``length`` ones and as many zeros in bytes, stands in the schema: a
    sequence of n used ids has the ``length`` bytes from place ``length`` - n on.
    """
    shared = b"\1" * length + b"\0" * length
    return pa.schema([("ids", pa.list_(pa.uint16() if narrow else pa.uint32(), length)), ("mask", pa.int32())], {"mask": shared})


class ShardWriter:
    """One Arrow file of fixed-size-list batches and one of the documents' places in it.

    Files get their final names when they are whole, by a move; a task that runs again
    writes the same bytes under the same names.
    """

    def __init__(self, folder: str, shard: int, length: int, narrow: bool):
        self.fs, self.folder = _open(folder)
        self.name, self.length, self.schema = f"shard-{shard:06d}", length, sequence_schema(length, narrow)
        self.kind = "<u2" if narrow else "<u4"
        self.attempt = f"{self.folder}/_{self.name}-{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}"
        self.fs.create_dir(self.folder)
        self.sink = self.fs.open_output_stream(self.attempt + ".arrow")
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.index_sink = self.fs.open_output_stream(self.attempt + ".index")
        self.index = pa.ipc.new_file(self.index_sink, pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())]))
        self.open, self.held, self.docs, self.tokens, self.documents = [], 0, [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.open.append(ids)
        self.held += len(ids) // 4
        self.docs.append((doc_id, len(ids) // 4))
        self.tokens += len(ids) // 4
        self.documents += 1
        if self.held >= self.length * BATCH:
            self._flush(self.held // (self.length * BATCH) * self.length * BATCH)

    def _flush(self, upto: int) -> None:
        flat = np.frombuffer(b"".join(self.open), "<u4")
        now, rest = flat[:upto], flat[upto:]
        self.open, self.held = [rest.tobytes()] if len(rest) else [], len(rest)
        pad = -len(now) % self.length
        ids = np.append(now, np.zeros(pad, "<u4")).astype(self.kind)
        unused = np.zeros(len(ids) // self.length, np.int32)
        unused[len(unused) - 1 :] = pad  # only the last sequence of a shard has any
        for at in range(0, len(unused), BATCH):
            some = pa.FixedSizeListArray.from_arrays(pa.array(ids[at * self.length : (at + BATCH) * self.length]), self.length)
            self.writer.write_batch(pa.record_batch([some, pa.array(unused[at : at + BATCH])], schema=self.schema))
        if self.docs:
            self.index.write_batch(
                pa.record_batch([pa.array([d for d, _ in self.docs], pa.int64()), pa.array([n for _, n in self.docs], pa.int64())], names=["doc_id", "n_tokens"])
            )
            self.docs = []

    def close(self) -> str:
        if self.held or self.docs:
            self._flush(self.held)
        for writer, sink, end in ((self.writer, self.sink, ".arrow"), (self.index, self.index_sink, ".index")):
            writer.close()
            sink.close()
            self.fs.move(self.attempt + end, f"{self.folder}/{self.name}{end}")
        return f"{self.name}.arrow"


def write_files(
    docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = 2, length: int = LENGTH,
) -> tuple[DataFrame, str]:
    """Write the ids of all documents, ascending by id, to one pair of files per partition of the id range.

    Returns the manifest (shard, file, documents, tokens) and the folder. A null text is
    empty (just ``end_id``), a null id comes first, repeated rows are written each; rows
    of one id follow each other in the order of a hash of their texts. ``folder`` must be
    a path or URI that executors can write to; by default a new one in the shared folder.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, writer, encode = TaskContext.get().partitionId(), None, Encoder.of(tokenizer)
        narrow = max(encode.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        end = np.array([end_id], "<u4").tobytes()
        for doc_id, text in text_rows(batches, "id", "text"):
            writer = writer or ShardWriter(folder, shard, length, narrow)
            writer.add(doc_id, encode(text) + end)
        if writer:
            name = writer.close()
            values = [pa.array([shard], pa.int32()), pa.array([name]), pa.array([writer.documents]), pa.array([writer.tokens])]
            yield pa.RecordBatch.from_arrays(values, ["shard", "file", "documents", "tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    return staged(rows.select("id", "text").mapInArrow(write, SHARD_SCHEMA), "token-manifest"), folder


class Shard:
    """Random access to a shard's sequences; memory-mapped without copies where the file is local."""

    def __init__(self, folder: str, file: str):
        self.fs, self.folder = _open(folder)
        path = f"{self.folder}/{file}"
        local = isinstance(self.fs, fs.LocalFileSystem)
        self.file = pa.ipc.open_file(pa.memory_map(path) if local else self.fs.open_input_file(path))
        self.docs = pa.ipc.open_file(self.fs.open_input_file(path.removesuffix("arrow") + "index"))
        self.length = self.file.schema.field("ids").type.list_size
        self.mask = np.frombuffer(self.file.schema.metadata[b"mask"], bool)

    def _batch(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(sequences, length) of ids and where the mask of each begins, both views of the file."""
        batch = self.file.get_batch(i)
        ids = batch.column(0).flatten().to_numpy(zero_copy_only=True).reshape(-1, self.length)
        return ids, batch.column(1).to_numpy(zero_copy_only=True)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and mask of one sequence, neither copied nor unpacked; batches hold BATCH of them, but the last."""
        (ids, begins), row = self._batch(i // BATCH), i % BATCH
        return ids[row], self.mask[begins[row] : begins[row] + self.length]

    def _used(self) -> Iterator[np.ndarray]:
        """The ids of each record batch without padding, which only a last sequence has."""
        for i in range(self.file.num_record_batches):
            ids, begins = self._batch(i)
            yield ids.reshape(-1)[: ids.size - int(begins[-1])]

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(doc_id, first, n_tokens, crc32 of the ids) of each document, in file order, a batch in memory at a time."""
        stream, held, first = self._used(), np.empty(0, "<u4"), 0
        for i in range(self.docs.num_record_batches):
            for row in self.docs.get_batch(i).to_pylist():
                crc, left = 0, row["n_tokens"]
                while left:
                    if not len(held):
                        held = next(stream)
                    crc = zlib.crc32(held[:left].astype("<u4"), crc)
                    left, held = left - min(left, len(held)), held[left:]
                yield row["doc_id"], first, row["n_tokens"], crc
                first += row["n_tokens"]


def read_files(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    ``start`` counts the ids of all documents before. Shards are read by one task each;
    only the manifest's counts, a row per shard, are added up on the driver.
    """
    shards = manifest.orderBy("shard").collect()
    starts, total = [], 0
    for s in shards:
        starts.append(Row(shard=s["shard"], file=s["file"], before=total))
        total += s["tokens"]
    if not starts:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for pdf in batches:
            for file, before in zip(pdf["file"], pdf["before"], strict=True):
                out = []
                for doc_id, first, n, crc in Shard(folder, file).documents():
                    out.append((doc_id, before + first, n, crc))
                    if len(out) == 10_000:
                        yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    dealt = spark.createDataFrame(starts, "shard int, file string, before long").repartition(len(starts), "shard")
    return dealt.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
