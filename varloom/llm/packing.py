"""Sequence packing by minimum bin slack.

Documents become token ids followed by id 0; longer ones are cut into pieces of the capacity.  Lengths are at most the
capacity, so the table of lengths and their counts is of a bounded size however many documents there are: it is all
the driver sees.  There the fullest combination of available lengths is found per bin by a bitset subset-sum dynamic
programme, seeded with the longest length left, and taken off the table as many times as the counts allow; so the plan has
a few thousand patterns for any number of bins.  Spark then numbers the pieces of each length (hash buckets with offsets, no
hot group) and every piece looks its place up in the plan.

Defined cases: null and empty texts are the single token 0; rows that repeat an id and text are packed each on its own,
told apart by a copy number; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varloom.llm.common import NO_ID, gapless, slices
from varloom.operators.materialize import stored

CAPACITY, END_ID = 2048, 0
#: Entries of a worker's word cache, some 200 bytes each.
CACHE = 600_000

_LOW = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Chunks whose pieces can be told without the tokenizer's own normaliser: printable ASCII without apostrophe and
#: ``<``, and composed Latin letters.
_PLAIN = re.compile(r"[!-&(-;=-@\[-~ß-öø-ÿ]+\Z")
_PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones themselves, the rest from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


class Encoder:
    """Token ids of texts, by white-space separated chunks that are remembered; equal to encoding the whole text.

    White space is dropped by the tokenizer and never inside a token, so ids of chunks joined are ids of the text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            shown = part if part.isascii() else "".join(self.letters[b] for b in part.encode())
            found = np.array([t.id for t in self.model.tokenize(shown)], dtype="<u4").tobytes()
            if len(self.parts) >= CACHE // 2:
                self.parts.clear()
            self.parts[part] = found
        return found

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        low = text if text.isascii() else text.lower()
        if _PLAIN.match(low) and unicodedata.is_normalized("NFC", text):
            return b"".join([self._part(p) for p in _PIECES.findall(low)])
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        chunks = text.split() if b"<|" in text else text.translate(_LOW).split()
        known = self.known
        missing = set(chunks).difference(known)
        if len(known) + len(missing) > CACHE:
            known.clear()
            missing = set(chunks)
        for chunk in missing:
            known[chunk] = self._chunk(chunk)
        return b"".join([known[c] for c in chunks])


_ENCODERS: dict[str, Encoder] = {}


def tokenized(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: _id, _mark, piece, start, length, ids_crc32."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_mark"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("_bytes"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(tokenizer)
        if encoder is None:
            encoder = _ENCODERS[tokenizer] = Encoder(tokenizer)
        end = END_ID.to_bytes(4, "little")
        for batch in slices(batches):
            out: list[list] = [[], [], [], [], [], []]
            for i, mark, text in zip(*(batch.column(c).to_pylist() for c in ("_id", "_mark", "_bytes"))):
                ids = encoder.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, value in zip(out, (i, mark, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], ["_id", "_mark", "piece", "start", "length", "ids_crc32"]
            )

    return rows.mapInArrow(run, "_id long, _mark long, piece int, start long, length long, ids_crc32 long")


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Lengths (with how many of each) of the fullest bin that holds the longest length left; longer ones are preferred."""
    seed = max(counts)
    room = capacity - seed
    reach, layers = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == seed), room // length)
        part = 1
        while left > 0:  # binary parts of the count
            take = min(part, left)
            layers.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            part *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen = {seed: 1}
    for length, take, before in reversed(layers):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Segments (length, first rank, last rank + 1, first sequence, pieces per sequence, offset) that place all pieces."""
    left = {length: n for length, n in counts.items() if n}
    used = dict.fromkeys(left, 0)
    segments, sequence = [], 0
    while left:
        chosen = fullest(left, capacity)
        times = min(left[length] // n for length, n in chosen.items())
        offset = 0
        for length in sorted(chosen, reverse=True):
            n = chosen[length]
            segments.append((length, used[length], used[length] + n * times, sequence, n, offset))
            used[length] += n * times
            left[length] -= n * times
            offset += n * length
            if not left[length]:
                del left[length]
        sequence += times
    return segments


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: _id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stored(tokenized(docs, tokenizer, capacity), "pieces")
    copies = Window.partitionBy("_id", "_mark", "piece").orderBy("start")
    single = pieces.groupBy("_id", "_mark").agg(F.count("*").alias("n"), F.max("piece").alias("m"))
    if single.filter("n > m + 1").limit(1).count():
        pieces = stored(pieces.withColumn("copy", F.row_number().over(copies)), "pieces")
    else:
        pieces = pieces.withColumn("copy", F.lit(1))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    segments = np.array(sorted(plan(counts, capacity)), dtype=np.int64).reshape(-1, 6)
    held = docs.sparkSession.sparkContext.broadcast(segments)
    ranked = gapless(pieces, ["length"], ["_id", "_mark", "piece", "copy"], "rank")

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(length, rank):
        import pandas as pd

        table = held.value
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        keys = table[:, 0] * (1 << 44) + table[:, 1]
        rows = table[np.searchsorted(keys, lengths * (1 << 44) + ranks, side="right") - 1]
        at = ranks - rows[:, 1]
        return pd.DataFrame(
            {"sequence_id": rows[:, 3] + at // rows[:, 4], "offset": rows[:, 5] + at % rows[:, 4] * lengths}
        )

    return ranked.withColumn("at", place("length", "rank")).select(
        "_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset"
    )
