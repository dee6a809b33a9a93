"""Warehouse tables as partitioned Parquet: read, append, replace, number keys."""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T
from pyspark.errors import AnalysisException

from ecostar.session import delete_folder, list_files, list_folders, move_file, read_text, shared_folder, side_by_side, write_text


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def empty_table(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """No rows of a schema, as a relation that the optimizer knows to be empty."""
    struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in struct)
    return spark.sql(f"SELECT {columns} WHERE FALSE")


def read_table(spark: SparkSession, root: str, name: str, schema: str | T.StructType) -> DataFrame:
    """A warehouse table, empty where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(table_path(root, name))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return empty_table(spark, schema)
        raise


_STAGED: ContextVar[list | None] = ContextVar("staged", default=None)


@contextmanager
def staging(spark: SparkSession):
    """Tables staged inside the block are deleted when the job that needed them ends."""
    paths: list[str] = []
    token = _STAGED.set(paths)
    try:
        yield
    finally:
        _STAGED.reset(token)
        for path in paths:
            delete_folder(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage with a real table: a lost executor costs no recomputation,
    and a table can be replaced although the frame was computed from it.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    if _STAGED.get() is not None:
        _STAGED.get().append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_days(df: DataFrame, day: str) -> DataFrame:
    """Rows that a partitioned table is joined with to read only the days they name.

    Staged, so that the planner knows their size; the comparison marks them as a
    selective side, which makes a broadcast of them prune the folders of the table.
    """
    return stage(df, "days").filter(F.col(day) >= F.lit("0001-01-01").cast("date"))


_LEDGER = "_ledger"


class Batch:
    """The writes of one batch, prepared apart and then published together.

    First every table's new files are written below the batch's own folder. Then one
    manifest names them all: from here on the batch counts. Publishing moves the files
    into their tables under names that carry the batch, and of replaced partitions removes
    the others. Each step can be repeated, so a batch that was cut off is dropped where it
    has no manifest and is finished where it has (``recover``), whatever its rows' keys.
    One job at a time writes a warehouse.

    ``stream`` and ``epoch`` name a micro-batch: one that was published is never begun again.
    """

    def __init__(self, spark: SparkSession, root: str, stream: str | None = None, epoch: int = 0):
        self.spark, self.root, self.stream, self.epoch = spark, root, stream, epoch
        self.name = uuid.uuid4().hex if stream is None else f"{stream}-{epoch}"
        self.folder = f"{table_path(root, _LEDGER)}/{self.name}"
        self.writes: list[dict] = []
        recover(spark, root)
        done = [f for f in list_folders(spark, table_path(root, _LEDGER)) if f.startswith(f"done-{stream}-")]
        self.resumed = bool(done)  # whether a micro-batch of the stream was published before
        self.published = stream is not None and any(int(f.rsplit("-", 1)[1]) >= epoch for f in done)

    def write(self, df: DataFrame, name: str, partition: str | None = None, replace: bool = False) -> DataFrame:
        """Prepare rows to append, or to stand in place of the partitions they occur in; returns them as written."""
        path = f"{self.folder}/{name}"
        writer = df.hint("rebalance", partition).write.partitionBy(partition) if partition else df.write
        writer.parquet(path)
        self.writes.append({"table": name, "replace": replace})
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self) -> None:
        files = {w["table"]: list_files(self.spark, f"{self.folder}/{w['table']}") for w in self.writes}
        manifest = {"writes": [w | {"files": files[w["table"]]} for w in self.writes], "stream": self.stream, "epoch": self.epoch}
        write_text(self.spark, f"{self.folder}/manifest.json", json.dumps(manifest))
        _publish(self.spark, self.root, self.name)


def _publish(spark: SparkSession, root: str, batch: str) -> None:
    ledger = table_path(root, _LEDGER)
    manifest = json.loads(read_text(spark, f"{ledger}/{batch}/manifest.json"))
    for write in manifest["writes"]:
        table, folders = table_path(root, write["table"]), {}
        for file in write["files"]:
            folder, _, name = f"/{file}".rpartition("/")
            folders.setdefault(folder, []).append((file, name))

        def place(folder: str, write=write, table=table, folders=folders) -> None:
            for file, name in folders[folder]:
                move_file(spark, f"{ledger}/{batch}/{write['table']}/{file}", f"{table}{folder}/{batch}-{name}")
            for file in list_files(spark, table + folder) if write["replace"] else ():
                if not file.startswith(batch):
                    delete_folder(spark, f"{table}{folder}/{file}")

        side_by_side(place, folders)
    if manifest["stream"] is not None:
        mark = f"done-{manifest['stream']}-"
        write_text(spark, f"{ledger}/{mark}{manifest['epoch']}", "")
        for old in list_folders(spark, ledger):
            if old.startswith(mark) and int(old.rsplit("-", 1)[1]) < manifest["epoch"]:
                delete_folder(spark, f"{ledger}/{old}")
    delete_folder(spark, f"{ledger}/{batch}")


def recover(spark: SparkSession, root: str) -> None:
    """Finish batches that have a manifest and drop those that were cut off before."""
    ledger = table_path(root, _LEDGER)
    for batch in list_folders(spark, ledger):
        if batch.startswith(("done-", "_")):
            continue
        if "manifest.json" in list_folders(spark, f"{ledger}/{batch}"):
            _publish(spark, root, batch)
        else:
            delete_folder(spark, f"{ledger}/{batch}")


_BLOCK_BITS = 16
_SPAN_BITS = 40


def number_rows(df: DataFrame, order: str, key: str, after: Column) -> DataFrame:
    """Consecutive keys above ``after`` in the order of a unique integer column.

    Rows are numbered inside blocks of 2^16 order values. A block starts where the
    counts of the blocks before it end; these are added up inside spans of 2^40
    values, and only the counts of the spans meet in one task, however sparse the
    order values are.
    """
    blocked = df.withColumn("_block", F.shiftright(F.col(order).cast("bigint"), _BLOCK_BITS))
    span = F.shiftright("_block", _SPAN_BITS - _BLOCK_BITS).alias("_span")
    blocks = blocked.groupBy("_block").agg(F.count("*").alias("_n")).select("_block", "_n", span)
    spans = blocks.groupBy("_span").agg(F.sum("_n").alias("_n"))

    def before(window):
        return F.coalesce(F.sum("_n").over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))

    span_starts = spans.select("_span", before(W.orderBy("_span")).alias("_span_start"))
    starts = blocks.withColumn("_offset", before(W.partitionBy("_span").orderBy("_block"))).join(
        span_starts, "_span"
    ).select("_block", (F.col("_span_start") + F.col("_offset")).alias("_start"))
    within = W.partitionBy("_block").orderBy(order)
    return (
        blocked.join(starts, "_block")
        .withColumn(key, F.coalesce(after, F.lit(0)) + F.col("_start") + F.row_number().over(within))
        .drop("_block", "_start")
    )
