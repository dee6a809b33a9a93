"""Language by a string kernel: blended n-gram presence, Nyström landmarks, ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ecostar.llm.common import drop_staged, staged
from ecostar.llm.grams import Grams

ORDERS, BITS = (1, 2, 3), 14
#: Expected rows per language that the classifier is fitted on, and of these the landmarks, at most.
FIT_ROWS, LANDMARKS = 600, 32
RIDGE, BATCH, UNKNOWN = 1e-3, 256, "und"


class Model(NamedTuple):
    """langs: learned values; landmarks: (m, buckets) presence over norm, 0/1 rows scaled; alpha: (m, langs)."""

    langs: list[str]
    landmarks: np.ndarray
    alpha: np.ndarray


def presence(found: list[np.ndarray]) -> np.ndarray:
    """Rows of 0 and 1 over the buckets, each divided by its norm: products of rows are kernel values."""
    out = np.zeros((len(found), 1 << BITS), np.float32)
    for row, grams in zip(out, found, strict=True):
        if len(grams):
            row[grams] = 1 / np.sqrt(len(grams))
    return out


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    grams = Grams(ORDERS, BITS)
    for pdf in batches:
        yield pd.DataFrame({"lang": pdf["lang"], "rank": pdf["rank"], "grams": [grams(t) for t in pdf["text"]]})


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def train(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    fit_rows: int = FIT_ROWS, landmarks: int = LANDMARKS,
) -> Model:
    """Fit on rows with text and language for which ``learn`` (over the id column) holds.

    Per language the rows with the smallest hashes of their ids are used, ``fit_rows``
    expected at most, and the first ``landmarks`` of them are landmarks. The normal
    equations are summed up per task; the driver solves a system of the landmarks' size.
    Null, blank and letterless texts teach nothing; with nothing to learn there are no
    languages.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((0, 1 << BITS), np.float32), np.zeros((0, 0)))
    rank = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))
    share = F.element_at(F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, fit_rows / counts[k]))]), F.col("lang"))
    drawn = rows.withColumn("rank", rank).filter(F.col("rank") < share * (1 << 30))
    sample = staged(drawn.select("lang", "rank", "text").mapInPandas(_features, "lang string, rank long, grams array<int>"), "language-grams")
    firsts = []
    for k in langs:  # at most ``landmarks`` rows a language
        firsts += sample.filter(F.col("lang") == k).orderBy("rank", "grams").limit(landmarks).select("grams").collect()
    marks = presence([np.asarray(r["grams"]) for r in firsts])
    shared = docs.sparkSession.sparkContext.broadcast((langs, marks))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        langs, marks = shared.value
        kk, ky = np.zeros((len(marks), len(marks))), np.zeros((len(marks), len(langs)))
        for pdf in batches:
            for at in range(0, len(pdf), BATCH):
                part = pdf.iloc[at : at + BATCH]
                kernel = (presence([np.asarray(g) for g in part["grams"]]) @ marks.T).astype(float)
                y = (part["lang"].to_numpy()[:, None] == np.array(langs, object)[None]).astype(float)
                kk += kernel.T @ kernel
                ky += kernel.T @ y
        yield pd.DataFrame({"kk": [kk.ravel()], "ky": [ky.ravel()]})

    found = sample.select("lang", "grams").mapInPandas(sums, "kk array<double>, ky array<double>").collect()  # a row per task
    drop_staged(sample)
    m = len(marks)
    kk = sum((np.array(r["kk"]) for r in found), np.zeros(m * m)).reshape(m, m)
    ky = sum((np.array(r["ky"]) for r in found), np.zeros(m * len(langs))).reshape(m, -1)
    gram = (marks @ marks.T).astype(float)
    rows_used = sum(min(n, fit_rows) for n in counts.values())
    alpha = np.linalg.lstsq(kk + RIDGE * rows_used * gram + 1e-9 * np.eye(m), ky, rcond=None)[0]
    return Model(langs, marks, alpha)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score), one row per row of ``docs``; whole texts, no other column is read.

    score is the regression value of the predicted language, cut to 0..1. Texts that are
    null or without a letter, and all texts if no language was learned, give ``und`` and 0.
    Ties go to the language that sorts first; equal texts get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        langs, marks, alpha = shared.value
        grams = Grams(ORDERS, BITS)
        for pdf in batches:
            best, score = [], []
            texts = pdf["text"].to_list()
            for at in range(0, len(texts), BATCH):
                part = texts[at : at + BATCH]
                known = np.array([bool(langs) and has_letter(t) for t in part])
                lang, value = np.full(len(part), UNKNOWN, object), np.zeros(len(part))
                if known.any():
                    kernel = presence([grams(t) for t, k in zip(part, known, strict=True) if k]) @ marks.T
                    values = kernel.astype(float) @ alpha
                    lang[known] = np.array(langs, object)[values.argmax(axis=1)]
                    value[known] = np.clip(values.max(axis=1), 0, 1)
                best.append(lang)
                score.append(value)
            yield pd.DataFrame({"id": pdf["id"], "lang_pred": np.concatenate(best or [[]]), "score": np.concatenate(score or [[]])})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "id long, lang_pred string, score double").withColumnRenamed("id", id_col)
