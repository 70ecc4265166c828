"""Quality classifier by importance resampling.

Two bags of hashed n-grams (words and word pairs) are generative models: the target model is counted over labelled good
documents, the raw model over all documents.  The log ratio of an n-gram says how much likelier it is in good text; both
counts are shrunk towards each other, so rare n-grams say nothing.  A document's log weight is the worst of three readings,
each taken from a cut of its own and in units of its spread among good documents:

* the mean log ratio of all its n-grams (is the text as a whole like the target),
* the log ratio of its worst word, and of its worst word pair (does it hold what the target never holds, be it once).

The mean counts occurrences.  The worst word and pair count the documents that hold them, so that an n-gram repeated in one
long document is no evidence, and they are never summed, so that several rare n-grams do not add up to a rejected one.

Resampling without replacement is Gumbel top-k: every document's key is its log weight over the temperature plus Gumbel
noise hashed from id and text, and the k largest keys are the sample.  k follows from the data: the number of documents whose log weight
is above all cuts, and the cuts are where all rows of the calibration part of the labels (never counted into the target) are parted best.  The
k-th key is found by counting keys in finer and finer bins over all rows, so nothing is sorted in one task or collected.

The labels may be bounded: ``label_limit`` rows (smallest hashes of the id) are used, none by default.

Defined cases: null and empty texts have no n-grams, so there is no evidence against them and every reading counts as that of a
middling good document (so does the pair of a single word); without labels of either
kind every document is kept; labels that are null count as not good; rows that repeat an id and text get equal keys and are kept
or rejected together; a null id never has a label; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from varloom.llm.common import NO_ID, kept_rows, slices
from varloom.operators.materialize import stored
from varloom.operators.scale import in_ranges

#: Buckets of words and of word pairs: the two broadcast tables are 5 MB each whatever the corpus.
WORDS, PAIRS = 1 << 20, 1 << 18
SIZE = WORDS + PAIRS
#: Buckets whose counts travel as one compressed value.
BLOCK = 1 << 14
#: Pseudo-counts in the raw model: an n-gram seen far fewer times says nothing.
PRIOR = 20.0
#: Least share of the good calibration documents that the cuts together must keep.
KEEP = 0.985
TEMPERATURE = 0.05
_CACHE = 300_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_hashes: dict[str, int] = {}


def _word_hashes(text: str) -> np.ndarray:
    words = text.split()
    missing = set(words).difference(_hashes)
    if len(_hashes) + len(missing) > _CACHE:
        _hashes.clear()
        missing = set(words)
    for word in missing:
        _hashes[word] = xxhash.xxh3_64_intdigest(word)
    return np.array([_hashes[w] for w in words], dtype=np.uint64)


def buckets(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of the text's words, then of its word pairs (after the words' buckets)."""
    h = _word_hashes(text)
    pairs = (h[:-1] * _MIX + h[1:]) * _MIX
    return (h >> np.uint64(44)).astype(np.int64), (pairs >> np.uint64(46)).astype(np.int64) + WORDS


def _counts(batches: Iterable[pa.RecordBatch], documents: bool = False) -> Iterator[pa.RecordBatch]:
    """Occurrences per bucket; ``documents``: behind them, at bucket + SIZE, the number of documents that hold it."""
    raw = np.zeros(SIZE * (1 + documents), dtype=np.int64)
    good = np.zeros_like(raw)
    for batch in slices(batches):
        for text, is_good in zip(batch.column("text").to_pylist(), batch.column("good").to_pylist()):
            for part in buckets(text):
                held = np.unique(part) + SIZE if documents else part[:0]
                for counts in (raw, good) if is_good else (raw,):
                    np.add.at(counts, part, 1)
                    counts[held] += 1
    used = np.flatnonzero(raw)
    for start in range(0, len(used), 100_000):
        at = used[start : start + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(good[at])], ["bucket", "raw", "good"]
        )


def _blob(at: np.ndarray, raw: np.ndarray, good: np.ndarray) -> bytes:
    """Counts at sorted places of one block, byte planes apart: a byte or so per place instead of a row."""
    parts = [np.diff(at, prepend=0).astype(np.uint16), raw.astype(np.int64), good.astype(np.int64)]
    return zlib.compress(b"".join(p.view(np.uint8).reshape(len(p), -1).T.tobytes() for p in parts), 1)


def _add_blob(blob: bytes, raw: np.ndarray, good: np.ndarray) -> None:
    planes = np.frombuffer(zlib.decompress(blob), dtype=np.uint8).reshape(18, -1)
    steps, *counts = (np.ascontiguousarray(p.T) for p in (planes[:2], planes[2:10], planes[10:]))
    at = np.cumsum(steps.view(np.uint16).ravel(), dtype=np.int64)
    raw[at] += counts[0].view(np.int64).ravel()
    good[at] += counts[1].view(np.int64).ravel()


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of a task, of occurrences and of documents, as values of ``BLOCK`` buckets."""
    for batch in _counts(batches, documents=True):
        at, raw, good = (batch.column(i).to_numpy() for i in range(3))
        blocks, starts = np.unique(at // BLOCK, return_index=True)
        parts = zip(blocks.tolist(), starts, [*starts[1:], len(at)])
        blobs = [_blob(at[i:j] - k * BLOCK, raw[i:j], good[i:j]) for k, i, j in parts]
        yield pa.RecordBatch.from_arrays([pa.array(blocks.astype(np.int32)), pa.array(blobs, pa.binary())], ["block", "counts"])


def _sum_blocks(part: pd.DataFrame) -> pd.DataFrame:
    raw, good = np.zeros(BLOCK, dtype=np.int64), np.zeros(BLOCK, dtype=np.int64)
    for blob in part["counts"]:
        _add_blob(blob, raw, good)
    at = np.flatnonzero(raw | good)
    return pd.DataFrame({"block": part["block"].iloc[:1], "counts": [_blob(at, raw[at], good[at])]})


def _ratios(target: DataFrame, everything: DataFrame) -> np.ndarray:
    """Log ratios of every bucket, by occurrences and by documents; the counts come as one value per block.

    The driver keeps the values compressed and opens one block at a time.
    """
    found: tuple[dict[int, bytes], dict[int, bytes]] = ({}, {})
    for blobs, rows in zip(found, (everything, target)):
        sums = rows.mapInArrow(_blocks, "block int, counts binary").groupBy("block").applyInPandas(
            _sum_blocks, "block int, counts binary"
        )
        blobs.update((block, bytes(blob)) for block, blob in sums.toLocalIterator())

    def counts(block: int) -> tuple[np.ndarray, np.ndarray]:
        raw, good, unused = (np.zeros(BLOCK, dtype=np.int64) for _ in range(3))
        if block in found[0]:
            _add_blob(found[0][block], raw, unused)
        if block in found[1]:  # the target's rows are among everything already
            _add_blob(found[1][block], unused, good)
        return raw, good

    out = np.zeros(2 * SIZE, dtype=np.float32)
    for start in (0, SIZE):
        for blocks in (range(start, start + WORDS, BLOCK), range(start + WORDS, start + SIZE, BLOCK)):
            totals = [[int(x.sum()) for x in counts(at // BLOCK)] for at in blocks]
            share = sum(good for _, good in totals) / max(sum(raw for raw, _ in totals), 1)
            for at in blocks if share else ():
                raw, good = counts(at // BLOCK)
                out[at : at + BLOCK] = np.log((good + PRIOR * share) / ((raw + PRIOR) * share))
    return out.reshape(2, SIZE)


#: Names of the readings.
READINGS = ("mean", "word", "pair")


def readings(ratios: np.ndarray, text: str) -> tuple[float | None, float | None, float | None]:
    """Mean log ratio of all n-grams by occurrences; log ratios by documents of the worst word and of the worst word pair.

    What a text has none of is None.
    """
    words, pairs = buckets(text)
    if not len(words):
        return None, None, None
    total = ratios[0, words].sum(dtype=np.float64) + ratios[0, pairs].sum(dtype=np.float64)
    return (
        float(total / (len(words) + len(pairs))),
        float(ratios[1, words].min()),
        float(ratios[1, pairs].min()) if len(pairs) else None,
    )


@dataclass(frozen=True)
class Scale:
    """Cut of every reading, and its centre and spread among good documents."""

    centres: tuple[float, ...]
    cuts: tuple[float, ...]
    spreads: tuple[float, ...]


def _below(counted: DataFrame, keys: list[str], amounts: list[str]) -> tuple[DataFrame, DataFrame, dict[tuple, list[int]]]:
    """``counted`` (one row per ``keys`` and ``value``) in range partitions; the same with <amount>_below, the sums over the smaller
    values of the key; and the sums of every key.

    Only the sums of a key in a range, one row each, pass the driver.  So all amounts share one window, and a few exchanges do:
    a session keeps a thread for a minute after each of them, which its driver has to hold.
    """
    ranged = in_ranges(counted, keys, ["value"])
    totals: dict[tuple, list[int]] = {}
    before = []
    for row in sorted(ranged.groupBy(*keys, "_range").agg(*[F.sum(a).alias(a) for a in amounts]).collect()):
        total = totals.setdefault(row[: len(keys)], [0] * len(amounts))
        before.append((*row[: len(keys) + 1], *total))
        total[:] = [x + row[a] for x, a in zip(total, amounts)]
    names = [f"{a}_before" for a in amounts]
    fields = [*ranged.select(*keys, "_range").schema.fields, *[StructField(n, LongType()) for n in names]]
    before = ranged.sparkSession.createDataFrame(before, StructType(fields))
    inside = Window.partitionBy(*keys, "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumns({f"{a}_below": F.coalesce(F.sum(a).over(inside), F.lit(0)) for a in amounts})
    joined = within.join(F.broadcast(before), [*keys, "_range"])
    return ranged, joined.withColumns({f"{a}_below": F.col(f"{a}_below") + F.col(f"{a}_before") for a in amounts}), totals


def _middles(rows: DataFrame) -> dict[str, float]:
    """Exact median of ``value`` per ``reading``, by the ranks of its distinct values in range partitions."""
    _, ranked, sizes = _below(rows.groupBy("reading", "value").agg(F.count("*").alias("n")), ["reading"], ["n"])

    def holds(reading: str, rank: int) -> Column:
        return (F.col("reading") == reading) & (F.col("n_below") <= rank) & (F.col("n_below") + F.col("n") > rank)

    middle = reduce(Column.__or__, [holds(r, i) for (r,), (n,) in sizes.items() for i in {(n - 1) // 2, n // 2}])
    found: dict[str, list[float]] = {}
    for row in ranked.where(middle).select("reading", "value").collect():  # one or two rows per reading
        found.setdefault(row["reading"], []).append(row["value"])
    return {reading: sum(values) / len(values) for reading, values in found.items()}


def _cut(rows: DataFrame, reading: str, n_good: int, n_bad: int) -> float:
    """The cut of one reading over all ``rows`` that earlier cuts have left."""
    counted = rows.groupBy(F.col(reading).alias("value")).agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"))
    ranged, below, totals = _below(counted, [], ["g", "b"])
    left_good, left_bad = totals[()]
    if not left_bad:
        return ranged.where("g > 0").agg(F.min("value")).first()[0]
    kept, gone = (F.lit(left_good) - F.col("g_below")) / n_good, F.col("b_below") / n_bad
    gain = F.when(kept >= KEEP, gone + kept).otherwise(-1.0)
    # of equal gains the smallest value of a good document, then the smallest at all
    best = below.agg(F.max(F.struct(gain.alias("gain"), F.col("g") > 0, (-F.col("value")).alias("value"))).alias("best")).first()
    cut = -best["best"]["value"]
    lower = ranged.where((F.col("b") > 0) & (F.col("value") < cut)).agg(F.max("value")).first()[0]
    # nothing is known of the space between the best cut and the next bad document below it: cut in the middle
    return cut if lower is None else (cut + lower) / 2


def _calibrate(rows: DataFrame) -> Scale | None:
    """rows: the readings, then good, of all calibration labels; only counts, medians and cuts come to the driver."""
    n_good, n_bad = rows.agg(F.count_if("good"), F.count_if(~F.col("good"))).first()
    if not n_good or not n_bad:
        return None
    long = rows.where("good").select(F.explode(F.array(*[F.struct(F.lit(n).alias("reading"), F.col(n).alias("value")) for n in READINGS])).alias("r"))
    long = long.select("r.reading", "r.value")
    centre = _middles(long)
    own = F.create_map(*[F.lit(x) for n in READINGS for x in (n, centre[n])])[F.col("reading")]
    spread = _middles(long.select("reading", F.abs(F.col("value") - own).alias("value")))
    cuts = []
    for name in READINGS:
        # what an earlier cut has taken counts no more; the good ones lost so far count against what may be lost in all
        cuts.append(_cut(rows, name, n_good, n_bad))
        rows = rows.where(F.col(name) >= cuts[-1])
    return Scale(tuple(centre[n] for n in READINGS), tuple(cuts), tuple(max(spread[n], 1e-3) for n in READINGS))


def weights(docs: DataFrame, labels: DataFrame, label_limit: int | None = None) -> tuple[DataFrame, float]:
    """(_id, _mark, log_weight) per row of ``docs``, and the cut; nothing is learned (cut -inf) without both kinds of labels."""
    marks = labels.filter("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("_id"),
        (F.coalesce(F.col("quality") == 1, F.lit(False)) & F.coalesce(F.col("toxic") == 0, F.lit(True))).alias("good"),
    )
    if label_limit is not None:
        marks = marks.orderBy(F.xxhash64("_id"), "_id").limit(label_limit)
    marks = marks.groupBy("_id").agg(F.min("good").alias("good"))
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_mark"), text.alias("text")
    )
    calibrates = F.crc32(F.col("_id").cast("string").cast("binary")) % 4 == 0
    good_ids = marks.filter(F.col("good") & ~calibrates).select("_id", "good")
    # labels grow with the documents: never broadcast, so that the plan is the same at every size
    target = keys.join(good_ids.hint("merge"), "_id", "left_semi").select("text", F.lit(True).alias("good"))
    everything = keys.select("text", F.lit(False).alias("good"))
    held = docs.sparkSession.sparkContext.broadcast(_ratios(target, everything))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [readings(held.value, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_mark"),
                    *(pa.array([f[j] for f in found], pa.float64()) for j in range(len(READINGS))),
                ],
                ["_id", "_mark", *READINGS],
            )

    read_ = stored(keys.mapInArrow(read, "_id long, _mark long, mean double, word double, pair double"), "readings")
    held.destroy()  # the readings are stored: neither driver nor executors need to hold the ratios any longer
    sample = read_.join(marks.filter(calibrates).hint("merge"), "_id").filter("mean is not null").fillna(0.0, ["pair"]).select(*READINGS, "good")
    scale = _calibrate(stored(sample, "calibration"))
    if scale is None:
        return read_.select("_id", "_mark", F.lit(0.0).alias("log_weight")), float("-inf")
    log_weight = F.least(
        *[
            (F.coalesce(F.col(n), F.lit(centre)) - cut) / spread
            for n, centre, cut, spread in zip(READINGS, scale.centres, scale.cuts, scale.spreads)
        ]
    )
    return read_.select("_id", "_mark", log_weight.alias("log_weight")), 0.0


def top_k(keyed: DataFrame, k: int, bins: int = 4096) -> DataFrame:
    """Rows with the ``k`` largest ``key``; rows that tie with the last one stay as well."""
    low, high = keyed.agg(F.min("key"), F.max("key")).first()
    if low is None or k <= 0:
        return keyed.limit(0)
    above = 0
    while True:
        width = (high - low) / bins
        if not width > abs(low) * 1e-15:
            break
        inside = keyed.filter((F.col("key") >= low) & (F.col("key") <= high))
        at = F.least(F.floor((F.col("key") - low) / width), F.lit(bins - 1)).cast("int")
        found = inside.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        for row in sorted(found.collect(), key=lambda r: -r["bin"]):  # at most ``bins`` rows
            if above + row["n"] >= k:
                break
            above += row["n"]
        low, high = row["lo"], row["hi"]
        if above + row["n"] == k:
            break
    return keyed.filter(F.col("key") >= low)


def resample(docs: DataFrame, labels: DataFrame, label_limit: int | None = None) -> DataFrame:
    """The sample: _id, _mark, log_weight and key of every kept row."""
    weighed, cut = weights(docs, labels, label_limit)
    # uniform in (0, 1) from id and text, so that a lost task draws the same numbers again
    uniform = (F.pmod(F.xxhash64(F.lit(11), "_id", "_mark"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    noisy = stored(weighed.withColumn("key", F.col("log_weight") / TEMPERATURE - F.log(-F.log(uniform))), "keys")
    k = noisy.filter(F.col("log_weight") >= cut).count()
    return top_k(noisy, k)


def good_documents(docs: DataFrame, labels: DataFrame, label_limit: int | None = None) -> DataFrame:
    """Rows of ``docs``, all columns, that are in the sample."""
    return kept_rows(docs, resample(docs, labels, label_limit).select("_id", "_mark"))
