"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of all labelled training documents are summed by Spark per language and feature; the matrix of
log probabilities (languages times ``FEATURES``) goes to all tasks, where whole batches are scored at
once.  All languages have the same prior: how many documents teach one says nothing about the next text.  Rows that are
there twice teach twice.  Only the text is looked at.  A text is ``und`` with score 0 if it is null, has no letter, or
nothing was learned (as from an empty table, which gives no rows itself); labels that are null teach nothing; ties go to
the first label in order.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .arrays import mix
from .shared import batch, by_batch, in_row, table, tidy

BITS = 15
FEATURES = 1 << BITS
SIZES = (1, 2, 3)
SMOOTHING = 0.5
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_GROUP = 1 << 18  # characters scored at a time


def _features(texts: list[str]):
    """For runs of texts: first row, hashed n-grams, and the text each belongs to."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= _GROUP):
            size += len(texts[j])
            j += 1
        lower = [f" {t.lower()} " for t in texts[i:j]]
        codes = np.frombuffer("".join(lower).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        who = np.repeat(np.arange(i, j), [len(t) for t in lower])
        found, owner = [], []
        for n in SIZES:
            m = len(codes) - n + 1
            if m <= 0:
                continue
            value = codes[:m].copy()
            for k in range(1, n):
                value = value * np.uint64(0x110001) + codes[k : k + m]
            inside = who[:m] == who[n - 1 :]
            found.append((mix(value + np.uint64(n << 56))[inside] >> np.uint64(64 - BITS)).astype(np.int64))
            owner.append(who[:m][inside])
        yield i, j, np.concatenate(found), np.concatenate(owner)
        i = j


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Labels and log probabilities [feature, label], from ``text`` and ``lang`` of every row."""

    def work(batches):
        sums: dict[str, np.ndarray] = {}
        for rows in batches:
            texts, langs = rows.column("text").to_pylist(), rows.column("lang").to_pylist()
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs])
            for _, _, found, owner in _features(texts):
                counts = np.bincount(code[owner] * FEATURES + found, minlength=len(names) * FEATURES)
                for k, name in enumerate(names):
                    sums[name] = sums.get(name, 0) + counts[k * FEATURES : (k + 1) * FEATURES]
        for name, counts in sums.items():
            at = np.flatnonzero(counts)
            yield batch(lang=pa.array([name] * len(at), pa.string()), feature=at.astype(np.int32), n=counts[at])

    known = docs.filter("lang is not null and text is not null").select("text", "lang")
    counts = known.mapInArrow(tidy(work), "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    # one short row per label and feature: bounded by the model's size, not by the data
    rows = counts.toPandas()
    labels = sorted(rows["lang"].unique())
    table_ = np.full((FEATURES, max(1, len(labels))), SMOOTHING)
    for k, name in enumerate(labels):
        own = rows[rows["lang"] == name]
        table_[own["feature"].to_numpy(np.int64), k] += own["n"].to_numpy(np.float64)
    return labels, np.log(table_ / table_.sum(0)).astype(np.float32)


def predict(docs: DataFrame, labels: list[str], log_p: np.ndarray) -> DataFrame:
    """``row`` (all columns of ``docs``), ``lang_pred`` and ``score``."""
    model = docs.sparkSession.sparkContext.broadcast(log_p)

    def work(rows):
        texts = rows.column("text").to_pylist()
        known = np.array([bool(labels) and t is not None and _LETTER.search(t) is not None for t in texts])
        points = np.zeros((len(texts), max(1, len(labels))))
        counts = np.zeros(len(texts))
        for i, j, found, owner in _features([t if ok else "" for t, ok in zip(texts, known)]):
            counts[i:j] += np.bincount(owner - i, minlength=j - i)
            for k in range(len(labels)):
                points[i:j, k] += np.bincount(owner - i, weights=model.value[:, k][found], minlength=j - i)
        # per feature, so that a long text does not make every score 1; then as for a text of 50 features
        mean = points / np.maximum(counts, 1)[:, None] * np.minimum(counts, 50)[:, None]
        chance = np.exp(mean - mean.max(1, keepdims=True))
        chance /= chance.sum(1, keepdims=True)
        best = points.argmax(1)
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("row"),
                pa.array([labels[b] if ok else UNKNOWN for b, ok in zip(best, known)], pa.string()),
                pa.array(np.where(known, chance[np.arange(len(texts)), best], 0.0)),
            ],
            names=["row", "lang_pred", "score"],
        )

    whole = in_row(docs).select("row", "row.text")
    return by_batch(whole, work, whole.select("row").schema.add("lang_pred", "string").add("score", "double"))


def held_out():
    """Every third document by the checksum of its id tests, the others teach."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels, log_p = fit(docs.filter(~held_out()))
    return predict(docs.select("doc_id", "text"), labels, log_p).select("row.doc_id", "lang_pred", "score").select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_known(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; those without letters go.  All columns stay as they are."""
    labels, log_p = fit(docs.filter(~held_out()))
    return predict(docs, labels, log_p).filter(F.col("lang_pred") != UNKNOWN).select("row.*")
