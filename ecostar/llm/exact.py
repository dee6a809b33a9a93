"""Exact dedup by a tree-merge of sorted digest runs, DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ecostar.llm.common import ascii_lower, drop_staged, staged

#: Runs merged into one at each level.
FAN = 8
#: Rows of a run expected at most, and the least number of runs that documents are dealt to.
RUN_ROWS, MIN_RUNS = 100_000, 64

_KEY = ["digest", "octets", "second"]


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
    fan: int = FAN, run_rows: int = RUN_ROWS,
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. A key
    is the SHA-256 of the text, verified by its length and a hash of another kind, which
    every merge compares too.

    Rows are dealt by their ids to runs. A run keeps, sorted by digest, the identifier
    that stays and a count per digest. In each round ``fan`` runs merge into one, so
    that after log_fan rounds one run, spread by digest over all tasks, holds the
    verdicts. They then go down the same tree: a parent entry meets at most ``fan``
    children, and a document meets the entry of its own run. So neither way has a hot
    key, even if most rows are copies of one text.

    ``keep``: "largest" or "smallest" id stays. Null ids count as below all others and
    stay only where a group has no id (keep_id is null then). Repeated rows count in
    group_size; every row with the id that stays is ``kept``. No rows give no rows.
    """
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    runs = fan
    rows = docs.count()
    while runs < max(MIN_RUNS, rows / run_rows):
        runs *= fan
    base = staged(
        docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
            "id", F.sha2("text", 256).alias("digest"), F.octet_length("text").alias("octets"),
            F.xxhash64("text").alias("second"), F.pmod(F.xxhash64("id"), F.lit(runs)).alias("run"),
        ), "digests",
    )
    best = F.max if keep == "largest" else F.min
    merged = base.groupBy("run", *_KEY).agg(best("id").alias("keep_id"), F.count("*").alias("group_size"))
    levels = [staged(merged.sortWithinPartitions("run", "digest"), "run-0")]
    while runs > 1:
        runs //= fan
        up = levels[-1].withColumn("run", F.floor(F.col("run") / fan)).groupBy("run", *_KEY)
        merged = up.agg(best("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        levels.append(staged(merged.sortWithinPartitions("run", "digest"), f"run-{len(levels)}"))
    verdicts = levels.pop()
    while levels:
        below = levels.pop()
        parts = below.select(F.floor(F.col("run") / fan).alias("up"), F.col("run").alias("own"), *_KEY)
        down = parts.join(verdicts.withColumnRenamed("run", "up"), ["up", *_KEY]).drop("up").withColumnRenamed("own", "run")
        after = staged(down, "verdicts")
        drop_staged(verdicts)
        drop_staged(below)
        verdicts = after
    return base.join(verdicts, ["run", *_KEY]).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"),
    )
