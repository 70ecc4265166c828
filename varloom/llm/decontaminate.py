"""Benchmark decontamination with a suffix automaton over the words of the test items.

Texts are A-Z lower-cased and cut into words (runs of digits, ASCII letters and all non-ASCII characters).  A window is
``width`` consecutive words of an item, or a whole shorter item.  The items become one generalised suffix automaton;
document words are streamed through it, which keeps the longest matching length at every word, and wherever it reaches
the window width (or a short item ends) the words are hit.

The automaton is the broadcast side, so items are cut into blocks of at most ``BLOCK_WORDS`` words (a longer item into
overlapping parts); each block is one narrow pass over the documents, and only passes beyond the first need a merge by
document.  Memory of a task is one automaton and one batch of documents.

Defined cases: null texts have no words; an item without words matches nothing; a null item id counts as the empty
string; items that repeat an id count once; repeated documents get equal rows; no items or no documents give no hits or
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import kept_rows, keyed, packed, slices
from varloom.operators.materialize import stored

WIDTH = 10
#: Words of one automaton: some 25 MB in a task, 2 MB as broadcast.
BLOCK_WORDS = 50_000

#: Byte table of the word contract: A-Z lower-cased, word bytes kept, all else a space.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Automaton:
    """Generalised suffix automaton over word numbers, with the items of every window length needed."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], width: int):
        self.width = width
        self.vocab: dict[bytes, int] = {}
        self.edges: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[str, list[int]]] = []
        for item, words in items:
            numbers = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            if numbers:
                ends.append((item, numbers))
                state = 0
                for n in numbers:
                    state = self._extend(state, n)
        self._mark(ends)

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.edges.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The state of the string of ``state`` followed by ``word``, cut out of ``target`` if that holds longer ones."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, dict(self.edges[target]), self.link[target])
        self.link[target] = copy
        while state != -1 and self.edges[state].get(word) == target:
            self.edges[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, state: int, word: int) -> int:
        if word in self.edges[state]:
            return self._split(state, word, self.edges[state][word])
        fresh = self._state(self.length[state] + 1, {}, 0)
        while state != -1 and word not in self.edges[state]:
            self.edges[state][word] = fresh
            state = self.link[state]
        if state != -1:
            self.link[fresh] = self._split(state, word, self.edges[state][word])
        return fresh

    def _mark(self, ends: list[tuple[str, list[int]]]) -> None:
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        #: For every state, the suffix state that holds the last ``width`` words.
        self.window = [0] * len(self.length)
        for s in order:
            if self.length[s] >= self.width:
                up = self.link[s]
                self.window[s] = s if self.length[up] < self.width else self.window[up]
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for item, numbers in ends:
            state = 0
            for i, n in enumerate(numbers):
                state = self.edges[state][n]
                if i + 1 >= self.width:
                    self.items.setdefault(self.window[state], set()).add(item)
            if len(numbers) < self.width:
                while self.length[self.link[state]] >= len(numbers):
                    state = self.link[state]
                self.short.setdefault(state, []).append((len(numbers), item))
        #: Nearest suffix state, itself included, at which a short item ends.
        self.nearest = [0] * len(self.length)
        for s in order:
            self.nearest[s] = s if s in self.short else self.nearest[self.link[s]]
        self.least = min([self.width, *(len(n) for _, n in ends)], default=self.width)
        pairs = sorted({a * len(self.vocab) + b for _, n in ends for a, b in zip(n, n[1:])})
        self.pairs = np.array(pairs, dtype=np.int64)

    def _runs(self, numbers: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches that can hold a window: item words throughout, and word pairs that follow one another in an item."""
        if len(numbers) < self.least:
            return
        known = numbers >= 0
        if self.least > 1:
            codes = numbers[:-1].astype(np.int64) * len(self.vocab) + numbers[1:]
            at = np.minimum(np.searchsorted(self.pairs, codes), max(len(self.pairs) - 1, 0))
            follows = known[:-1] & known[1:] & ((self.pairs[at] == codes) if len(self.pairs) else False)
            breaks = np.flatnonzero(~follows) + 1
        else:
            breaks = np.flatnonzero(~known[1:] | ~known[:-1]) + 1
        starts = np.concatenate(([0], breaks))
        stops = np.concatenate((breaks, [len(numbers)]))
        for i in np.flatnonzero(stops - starts >= self.least):
            yield int(starts[i]), int(stops[i])

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word spans (start, stop) inside windows, and the items that own them."""
        get = self.vocab.get
        numbers = np.array([get(w, -1) for w in words], dtype=np.int32)
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        for start, stop in self._runs(numbers):
            state = matched = 0
            for i, n in enumerate(numbers[start:stop].tolist(), start):
                while state and n not in self.edges[state]:
                    state = self.link[state]
                    matched = self.length[state]
                state = self.edges[state].get(n, 0)
                matched = matched + 1 if state else 0
                reach = 0
                if matched >= self.width:
                    reach = self.width
                    found |= self.items.get(self.window[state], set())
                s = self.nearest[state]
                while s:
                    for length, item in self.short[s]:
                        if matched >= length:
                            reach = max(reach, length)
                            found.add(item)
                    s = self.nearest[self.link[s]]
                if reach:
                    begin = i + 1 - reach
                    while spans and spans[-1][1] >= begin:
                        begin = min(begin, spans.pop()[0])
                    spans.append((begin, i + 1))
        return spans, found


def item_blocks(items: DataFrame, id_col: str, text_col: str, width: int, block_words: int) -> Iterator[list]:
    """The items' words on the driver, one block of at most ``block_words`` words at a time."""
    block, size = [], 0
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit("")))
    for item, text in rows.toLocalIterator():
        words = words_of(text.encode())
        for start in range(0, len(words), block_words):
            part = words[max(0, start - width + 1) : start + block_words]
            if size and size + len(part) > block_words:
                yield block
                block, size = [], 0
            block.append((item, part))
            size += len(part)
    yield block


def _scan(base: DataFrame, automaton) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher: Automaton = automaton.value
        for batch in slices(batches):
            counts, spans, items = [], [], []
            for text in batch.column("_bytes").to_pylist():
                words = words_of(text)
                hit, found = matcher.scan(words)
                counts.append(len(words))
                spans.append([{"start": a, "stop": b} for a, b in hit])
                items.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_mark"),
                    pa.array(counts, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                    pa.array(items, pa.list_(pa.string())),
                ],
                ["_id", "_mark", "n_words", "spans", "items"],
            )

    return base.select("_id", "_mark", F.col("_text").cast("binary").alias("_bytes")).mapInArrow(
        run, "_id long, _mark long, n_words long, spans array<struct<start:int,stop:int>>, items array<string>"
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per row of ``docs``: _id, _mark, n_words, n_hit, spans (sorted, of words), items (sorted ids of found items)."""
    context = docs.sparkSession.sparkContext
    base = keyed(docs, id_col, text_col)
    passes = [
        _scan(base, context.broadcast(Automaton(block, width)))
        for block in item_blocks(benchmark, item_col, item_text_col, width, block_words)
    ]
    found = reduce(DataFrame.unionByName, passes)
    if len(passes) > 1:
        found = (
            found.groupBy("_id", "_mark")
            .agg(
                F.first("n_words").alias("n_words"),
                F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
            )
            .join(base.select("_id", "_mark"), ["_id", "_mark"])
        )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(s["end"], x["start"]))).alias("n"),
            F.greatest(s["end"], x["stop"]).alias("end"),
        ),
        lambda s: s["n"],
    )
    return found.select("_id", "_mark", "n_words", covered.alias("n_hit"), "spans", "items")


def _merged(spans) -> list[tuple[int, int]]:
    """Sorted spans, which may overlap where they come from several blocks, as stretches apart from one another."""
    out: list[tuple[int, int]] = []
    for span in spans:
        if out and span["start"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], span["stop"]))
        else:
            out.append((span["start"], span["stop"]))
    return out


def without_spans(
    docs: DataFrame, marked: DataFrame, max_coverage: float = 0.5, min_words: int = 1
) -> DataFrame:
    """Rows of ``docs`` (columns doc_id, text and any others) after removal, all columns kept.

    A document whose hit words make up more than ``max_coverage`` of its words goes as a whole.  In the others every span
    of at least ``min_words`` words is cut out of the text, from its first to its last word.  A column n_chars follows the text.
    """
    names = docs.columns
    hit = (
        marked.filter("n_hit > 0")
        .select("_id", "_mark", "spans", (F.col("n_hit") / F.col("n_words")).alias("share"))
        .dropDuplicates(["_id", "_mark"])
    )

    @F.pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd

        out = []
        for text, parts in zip(texts, spans):
            parts = [] if parts is None else [x for x in _merged(parts) if x[1] - x[0] >= min_words]
            if text is None or not len(parts):
                out.append(text)
                continue
            raw, places, at = text.encode(), [], 0
            spaced = raw.translate(_TABLE)
            for word in spaced.split():
                at = spaced.index(word, at)
                places.append((at, at + len(word)))
                at += len(word)
            kept, last = [], 0
            for start, stop in parts:
                kept.append(raw[last : places[start][0]])
                last = places[stop - 1][1]
            out.append(b"".join([*kept, raw[last:]]).decode())
        return pd.Series(out, dtype=object)

    joined = packed(docs).join(hit, ["_id", "_mark"], "left").filter(F.coalesce("share", F.lit(0.0)) <= max_coverage)
    row = F.col("_row")
    texts = joined.select("_row", cut(row["text"], F.col("spans")).alias("_new"))
    new = {"text": F.col("_new")}
    if "n_chars" in names:
        same = F.col("_new").eqNullSafe(row["text"])
        new["n_chars"] = F.when(same, row["n_chars"]).otherwise(F.char_length("_new").cast(docs.schema["n_chars"].dataType))
    return texts.select(*[new.get(n, row.getField(n)).alias(n) for n in names])


def cleaned(docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.5, **how) -> DataFrame:
    """``without_spans`` until no window is left: where a span is cut out, the words around it may make up another window.

    Only rows that were cut are scanned again, and each round takes words from every one of them; ``how`` goes to ``contamination``.
    """
    done = []
    while True:
        marked = stored(contamination(docs, benchmark, **how), "marked")
        hit = marked.filter("n_hit > 0")
        done.append(kept_rows(docs, marked.filter("n_hit = 0")))
        if not hit.limit(1).count():
            return reduce(DataFrame.unionByName, done)
        docs = stored(without_spans(kept_rows(docs, hit), hit, max_coverage), "cut")
