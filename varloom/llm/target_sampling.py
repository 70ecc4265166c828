"""Importance resampling towards a target distribution over hashed word n-grams.

A feature is a run of 1 to ``order`` consecutive words joined by one space; its bucket is the CRC-32 of its UTF-8 bytes
modulo ``buckets``.  The corpus and the target are bucket histograms; a bucket's gain is the floored, scaled log ratio of
their smoothed shares, a document's weight the floored mean gain of its features.  Gumbel noise hashed from the id makes the
highest scores a sample without replacement.

The vocabulary has a head and a tail.  The head is every word that makes up at least 1 in ``HEAD`` of the words of a task and of
the corpus as counted by those tasks (so there are at most ``HEAD`` of them), with its exact CRC state, and every such word pair with
its bucket; it is broadcast.  All other features take their CRC directly, continued from the state of the words before.
Both give the same bucket, so the histograms and gains are exact and the head only saves work.

A text is read in pieces of about ``PIECE`` bytes cut between words, so a very long one costs no more memory than a short one.

Defined cases: null and empty texts have no features and weight 0; they are never drawn when ``min_words`` is positive; an empty
target or corpus counts as a histogram of zeros; a null id is hashed as the empty string and comes after all others at equal
scores; rows that repeat an id and text tie and get neighbouring ranks; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import NO_ID, kept_rows, keyed, shown_id, slices
from varloom.operators.materialize import stored
from varloom.operators.scale import in_ranges, numbered

BUCKETS = 10_000
#: Most words, and most pairs, of the broadcast head; longer grams than ``HEAD_BYTES`` stay in the tail.
HEAD, HEAD_BYTES = 1 << 16, 64
PIECE = 1 << 20
#: Grams a counting task holds before it forgets its rare ones.
_COUNTED = 1 << 20

#: Byte table of the word contract: A-Z lower-cased, word bytes kept, all else a space.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def word_pieces(text: str | None, overlap: int = 0) -> Iterator[tuple[int, list[bytes]]]:
    """(number of words repeated from the piece before, words) of the text's pieces."""
    data = (text or "").encode().translate(_TABLE)
    start, before = 0, []
    while start < len(data):
        end = data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        words = data[start:end].split()
        yield len(before), before + words
        before = (before + words)[-overlap:] if overlap else []
        start = end


@dataclass
class Head:
    """CRC states of frequent words and buckets of frequent word pairs."""

    buckets: int = BUCKETS
    words: dict[bytes, int] = field(default_factory=dict)
    pairs: dict[tuple[bytes, bytes], int] = field(default_factory=dict)

    def features(self, words: list[bytes], seen: int, order: int) -> np.ndarray:
        """Buckets of all features that do not lie in the first ``seen`` words."""
        known = self.words.get
        states = [crc32(w) if (s := known(w)) is None else s for w in words]
        found = [np.array(states[seen:], dtype=np.int64) % self.buckets]
        if order > 1:
            pair, spaced = self.pairs.get, [b" " + w for w in words]
            for n in range(2, order + 1):
                if n == 2 and self.pairs:
                    last, at = states, []
                    states = [crc32(w, s) for w, s in zip(spaced[1:], last)] if order > 2 else None
                    for i in range(max(seen - 1, 0), len(words) - 1):
                        bucket = pair((words[i], words[i + 1]))
                        at.append(crc32(spaced[i + 1], last[i]) % self.buckets if bucket is None else bucket)
                    found.append(np.array(at, dtype=np.int64))
                else:
                    states = [crc32(w, s) for w, s in zip(spaced[n - 1 :], states)]
                    found.append(np.array(states[max(seen - n + 1, 0) :], dtype=np.int64) % self.buckets)
        return np.concatenate(found)

    def of_text(self, text: str | None, order: int) -> Iterator[tuple[int, np.ndarray]]:
        """(new words, buckets of the features that end in them) of every piece of the text."""
        for seen, words in word_pieces(text, order - 1):
            yield len(words) - seen, self.features(words, seen, order)


def _frequent(order: int):
    """Grams that make up at least 1 in ``HEAD`` of a task's words, and the task's number of words under a null gram."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        total = 0
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                for seen, words in word_pieces(text, 1):
                    total += len(words) - seen
                    found.update(words[seen:])
                    if order > 1:
                        found.update(map(b" ".join, zip(words, words[1:])))
                if len(found) > _COUNTED:
                    found = Counter({g: n for g, n in found.items() if n * HEAD >= total})
        kept = [(g, n) for g, n in found.items() if n * HEAD >= total and len(g) <= HEAD_BYTES]
        grams, counts = [g for g, _ in kept] + [None], [n for _, n in kept] + [total]
        yield pa.RecordBatch.from_arrays([pa.array(grams, pa.binary()), pa.array(counts, pa.int64())], ["gram", "n"])

    return count


def head_of(docs: DataFrame, order: int = 1, buckets: int = BUCKETS) -> Head:
    """The head of a corpus with a ``text`` column; at most ``HEAD`` words and pairs reach the driver."""
    counted = docs.select("text").mapInArrow(_frequent(order), "gram binary, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counted = stored(counted, "head")
    total = counted.filter("gram is null").select("n").first()
    head = Head(buckets)
    for gram, _ in counted.filter(F.col("gram").isNotNull() & (F.col("n") * HEAD >= (total.n if total else 0))).toLocalIterator():
        first, space, second = bytes(gram).partition(b" ")
        if space:
            head.pairs[first, second] = crc32(gram) % buckets
        else:
            head.words[first] = crc32(first)
    return head


def histogram(docs: DataFrame, head, order: int = 1, buckets: int = BUCKETS) -> list[int]:
    """Features of the whole table in every bucket; ``head`` is a broadcast :class:`Head`."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, dtype=np.int64)
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                for _, at in head.value.of_text(text, order):
                    totals += np.bincount(at, minlength=buckets)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(totals[used])], ["bucket", "n"])

    totals = [0] * buckets
    sums = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in sums.toLocalIterator():
        totals[bucket] = n
    return totals


def gains(corpus: list[int], target: list[int]) -> np.ndarray:
    """Floored 1000 * ln of the smoothed share of a bucket in the target over that in the corpus."""
    b, all_s, all_t = len(corpus), float(sum(corpus) + len(corpus)), float(sum(target) + len(target))
    ratio = ((t + 1.0) * all_s / ((s + 1.0) * all_t) for s, t in zip(corpus, target))
    return np.fromiter((math.floor(1000 * math.log(r)) for r in ratio), dtype=np.int64, count=b)


def weigh(docs: DataFrame, target: DataFrame, order: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """_id, _mark, n_words, n_features and weight of every row of ``docs``; both tables have a ``text`` column."""
    context = docs.sparkSession.sparkContext
    head = context.broadcast(head_of(docs, order, buckets))
    gain = context.broadcast(gains(histogram(docs, head, order, buckets), histogram(target, head, order, buckets)))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, features, weights = [], [], []
            for text in batch.column("_text").to_pylist():
                w = n = total = 0
                for new, at in head.value.of_text(text, order):
                    w, n, total = w + new, n + len(at), total + int(gain.value[at].sum())
                words.append(w)
                features.append(n)
                weights.append(total // n if n else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_mark"), *(pa.array(x, pa.int64()) for x in (words, features, weights))],
                ["_id", "_mark", "n_words", "n_features", "weight"],
            )

    return keyed(docs).mapInArrow(read, "_id long, _mark long, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    order: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
    min_words: int = 20,
    percent: int = 10,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, _mark, n_words, n_features, weight, score and rank (null: not drawn).

    Drawn are floor(percent * N / 100) of the N rows with at least ``min_words`` words, highest scores first, ties to the smaller id.
    """
    seeded = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(shown_id().cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(seeded, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weigh(docs, target, order, buckets).withColumn("score", F.col("weight") + noise)
    scored = stored(scored, "scored")
    eligible = F.col("n_words") >= min_words
    # scores are whole numbers between the least gain and the largest plus the noise: their number does not grow with the rows
    counts = dict(scored.filter(eligible).groupBy("score").count().collect())
    wanted, above, cut = sum(counts.values()) * percent // 100, 0, None
    for score in sorted(counts, reverse=True):
        if above >= wanted:
            break
        above, cut = above + counts[score], score
    columns = [shown_id().alias("doc_id"), "_mark", "n_words", "n_features", "weight", "score"]
    if cut is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    can_be_drawn = eligible & (F.col("score") >= cut)
    ordered = [F.desc("score"), F.asc("_id"), F.asc("_mark")]
    ranges = in_ranges(scored.filter(can_be_drawn), [], ordered)
    ranked = numbered(ranges, [], F.col("_range"), ordered, "place")
    drawn = ranked.select(*columns, F.when(F.col("place") <= wanted, F.col("place").cast("long")).alias("rank"))
    return drawn.union(scored.filter(~can_be_drawn).select(*columns, F.lit(None).cast("long").alias("rank")))


def drawn_documents(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The drawn rows of ``docs``, all columns; rows that repeat an id and text are drawn together."""
    drawn = resample(docs, target, **how).filter("rank is not null")
    return kept_rows(docs, drawn.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), "_mark"))
