"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ecostar.llm.common import drop_staged, fold, let_go, staged
from ecostar.llm.grams import Grams

ORDERS, BITS = (3, 4, 5), 18
#: Bound of the labelled rows that the classifier is fitted on (half of it per class, about).
FIT_ROWS = 8000
#: Fits that are averaged, each over its own part of the sample.
FITS = 4
EPOCHS, RATE, RIDGE, SMOOTH = 6, 0.5, 1e-6, 1.0
#: Buckets in fewer of the sample's texts have no weight.
LEAST_TEXTS = 4


class Model(NamedTuple):
    """weights: per bucket the weight and the squared ratio; bias: of every text."""

    weights: np.ndarray
    bias: float


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    let_go()
    grams = Grams(ORDERS, BITS)
    for pdf in batches:
        for at in range(0, len(pdf), 500):
            part = pdf.iloc[at : at + 500]
            yield pd.DataFrame({"y": part["y"], "fit": part["fit"], "grams": [grams(t) for t in part["text"]]})


def _scaled(ratio: np.ndarray, found: np.ndarray) -> np.ndarray:
    x = ratio[found]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


def _fit(pdf: pd.DataFrame, ratio: np.ndarray) -> pd.DataFrame:
    """Logistic regression by AdaGrad on one part of the sample, rows in a fixed order."""
    w, b = np.zeros(len(ratio)), 0.0
    gw, gb = np.full(len(ratio), 1e-8), 1e-8
    rows = [(np.asarray(g, np.int32), y) for g, y in zip(pdf["grams"], pdf["y"], strict=True)]
    rows = [(g, _scaled(ratio, g).astype(np.float32), y) for g, y in rows]
    rng = np.random.default_rng(len(rows))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            found, x, y = rows[i]
            error = 1 / (1 + np.exp(-np.clip(w[found] @ x + b, -30, 30))) - y
            step = error * x + RIDGE * w[found]
            gw[found] += step * step
            w[found] -= RATE * step / np.sqrt(gw[found])
            gb += error * error
            b -= RATE * error / np.sqrt(gb)
    kept = np.flatnonzero(w)
    return pd.DataFrame({"bucket": np.append(kept, -1), "w": np.append(w[kept], b)})


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", fit_rows: int = FIT_ROWS,
) -> Model:
    """Fit on the labelled rows for which ``learn`` (over the id column) holds.

    ``fit_rows`` bounds the sample: in each class the rows with the smallest hashes of
    their ids, ``fit_rows`` / 2 expected at most. Rows of the smaller class are all used
    up to that. Rows without id, label or with a label other than 0 and 1 teach nothing;
    an id labelled twice counts with its larger label; a null text is an empty one. With
    one class or no rows at all the model knows only the share of label 1.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    known = known.filter("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    known = known.join(texts.filter(learn).select("id").distinct(), "id", "left_semi")
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    part = F.when(F.col("y") == 1, fit_rows / 2 / max(counts.get(1, 0), 1)).otherwise(fit_rows / 2 / max(counts.get(0, 0), 1))
    drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < part * (1 << 30)
    sample = known.filter(drawn).select("id", "y", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(FITS)).cast("int").alias("fit"))
    sample = staged(sample, "toxic-sample")
    small = sample.count() <= 2 * fit_rows  # sent to the texts, which then need no shuffle
    rows = staged(
        texts.join(F.broadcast(sample) if small else sample, "id").select("y", "fit", "text").mapInPandas(_features, "y int, fit int, grams array<int>"), "toxic-grams"
    )
    drop_staged(sample)
    size = 1 << BITS
    empty = Model(np.zeros((2, size)), float(np.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1))))
    seen = rows.select("y", F.explode("grams").alias("g")).groupBy("g").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q"))
    seen = seen.toPandas()  # at most 2^BITS rows
    if min(counts.get(0, 0), counts.get(1, 0)) == 0 or seen.empty:
        drop_staged(rows)
        return empty
    p, q = np.full(size, SMOOTH), np.full(size, SMOOTH)
    p[seen["g"]] += seen["p"]
    q[seen["g"]] += seen["q"]
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    ratio[p + q < LEAST_TEXTS + 2 * SMOOTH] = 0.0
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    found = rows.groupBy("fit").applyInPandas(lambda pdf: _fit(pdf, shared.value), "bucket long, w double")
    mean = found.groupBy("bucket").agg(F.sum("w").alias("w")).toPandas()  # at most 2^BITS rows and the bias
    drop_staged(rows)
    weights, bias = np.zeros(size), 0.0
    inner = mean[mean["bucket"] >= 0]
    weights[inner["bucket"]] = inner["w"] / FITS
    bias = float(mean.loc[mean["bucket"] < 0, "w"].sum()) / FITS
    return Model(np.stack([weights * ratio, ratio * ratio]), bias)


def scorer(spark, model: Model):
    """A column function: probability of label 1 of a text; null counts as empty."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        let_go()
        weights, bias = shared.value
        grams = Grams(ORDERS, BITS)

        def one(text):
            found = grams(text)
            sums = weights[:, found].sum(axis=1)
            return bias + (sums[0] / np.sqrt(sums[1]) if sums[1] > 0 else 0.0)

        for texts in batches:
            z = np.array([one(t) for t in texts], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return score


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, score, predicted) per row of ``docs``; whole texts, no other column is read.

    Repeated rows are scored each, equal texts get equal scores, empty and null texts get
    the score of the bias alone.
    """
    scored = docs.select(id_col, scorer(docs.sparkSession, model)(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(id_col: str = "doc_id") -> Column:
    return fold(F.col(id_col), 5, 0)
