"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram (1 to ``ORDER`` lower-cased code points) of every training text: each task returns the sparse
counts of its rows, summed by language and bucket in Spark.  The log-probability matrix, languages x ``BUCKETS`` floats
and so of a bounded size, is broadcast; texts are scored in Arrow batches with numpy, in pieces of at most ``PIECE``
code points, so a very long text costs no more memory than a short one.

Defined cases: a text that is null or without a letter is ``und`` with score 0, and so is every text when nothing was
learned; ties go to the language that sorts first; training rows with a null language are not learned from; a null id
counts as part of the training rows; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import slices

BUCKETS, ORDER, PIECE = 1 << 16, 3, 1 << 16
#: Languages x buckets of the broadcast matrix: 64 million floats, 256 MB.
MOST_CELLS = 1 << 26
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def ngram_buckets(text: str, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of the text, piece by piece; pieces overlap so that no n-gram is lost or doubled."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    for start in range(0, len(codes), PIECE):
        tail = max(0, start - (ORDER - 1))
        piece = codes[tail : start + PIECE].astype(np.uint64)
        skip = start - tail
        hashed = np.zeros(len(piece), dtype=np.uint64)
        for n in range(1, ORDER + 1):
            if len(piece) < n:
                break
            hashed = (hashed[: len(piece) - n + 1] ^ piece[n - 1 :]) * _STEP
            hashed ^= hashed >> np.uint64(29)
            ends_from = max(0, skip - (n - 1))  # n-grams that end before ``start`` belong to the piece before
            yield (((hashed[ends_from:] + np.uint64(n)) * _STEP) >> shift).astype(np.int32)


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in slices(batches):
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            total = totals.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            for buckets in ngram_buckets(text):
                total += np.bincount(buckets, minlength=BUCKETS)
    for lang, total in totals.items():
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(total[used])],
            ["lang", "bucket", "n"],
        )


@dataclass
class Model:
    languages: list[str]
    #: buckets x languages
    log_p: np.ndarray
    log_prior: np.ndarray


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> Model:
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(
        "text is not null and lang is not null"
    )
    documents = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(documents)
    if len(languages) * BUCKETS > MOST_CELLS:
        raise ValueError(f"{len(languages)} languages do not fit the broadcast matrix")
    counts = np.zeros((BUCKETS, len(languages)))
    at = {lang: i for i, lang in enumerate(languages)}
    sums = rows.mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # one row per language: as bounded as the matrix itself
    for row in sums.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n")).toLocalIterator():
        counts[row["b"], at[row["lang"]]] = row["n"]
    counts += smoothing
    log_p = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    prior = np.array([documents[lang] for lang in languages], dtype=float)
    return Model(languages, log_p, np.log(prior / prior.sum()) if languages else prior)


def score_text(model: Model, text: str | None) -> tuple[str, float]:
    if not model.languages or text is None or not _LETTER.search(text):
        return UNKNOWN, 0.0
    total = model.log_prior.copy()
    for buckets in ngram_buckets(text):
        total += model.log_p[buckets].sum(axis=0, dtype=np.float64)
    odds = np.exp(total - total.max())
    best = int(np.argmax(total))
    return model.languages[best], float(odds[best] / odds.sum())


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but for clashing names, with lang_pred and score."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def scored(texts):
        import pandas as pd

        found = [score_text(held.value, t) for t in texts]
        return pd.DataFrame({"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]})

    own = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.withColumn("_scored", scored(F.col(text_col))).select(*own, "_scored.lang_pred", "_scored.score")


def in_held_out(id_col: str = "doc_id") -> Column:
    """The fold that is never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
