"""Helpers of the pipeline operators: inputs, staged tables, joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ecostar.llm.tokens import Encoder
from ecostar.session import delete_folder, shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Parts that the rows of one key are dealt to in ``spread_join``.
SPREAD = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def fold(id_col: Column, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text leaves ``fold``; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == fold, F.lit(False))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: the lineage ends at files all executors see."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def drop_staged(df: DataFrame) -> None:
    delete_folder(df.sparkSession, df.staged_path)


def let_go() -> None:
    """Frees what a Python worker holds from tasks of other kinds: workers outlive their tasks, and all of an executor's share its memory."""
    Encoder.forget()
    pa.default_memory_pool().release_unused()


def text_rows(batches, *columns: str, rows: int = 256):
    """Rows of Arrow batches as tuples, a few at a time as Python objects, so that whole texts don't pile up."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)
        pa.default_memory_pool().release_unused()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where a lambda inside uses it many times."""
    return F.transform(F.array(value), body)[0]


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], by: list[str], how: str = "inner", spread: int = SPREAD) -> DataFrame:
    """``left`` joined with the one row of ``right`` per key, however many left rows share a key.

    Left rows are dealt to ``spread`` parts by a hash of ``by``. Each part's distinct
    keys, at most ``spread`` per key, look up the right row; the left rows then meet
    their part's copy. No task gets more than a part of a key's rows.
    """
    dealt = left.withColumn("_part", F.pmod(F.xxhash64(*by), F.lit(spread)))
    found = dealt.select("_part", *keys).distinct().join(right, keys, "inner")
    return dealt.join(found, ["_part", *keys], how).drop("_part")
