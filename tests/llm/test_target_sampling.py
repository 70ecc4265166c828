import hashlib
import math
import re
from zlib import crc32

import pytest

from llm_fixtures import documents, prose  # noqa: F401
from varloom.llm import target_sampling as t

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def features(text, order):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]


def plain(rows, target, order, buckets, min_words, percent, seed=2024):
    """The whole result by plain loops."""
    def counted(texts):
        totals = [0] * buckets
        for text in texts:
            for f in features(text, order)[1]:
                totals[crc32(f.encode()) % buckets] += 1
        return totals

    s, g = counted(x for _, x in rows), counted(target)
    gain = [
        math.floor(1000 * math.log((float(b) + 1) * (sum(s) + buckets) / ((float(a) + 1) * (sum(g) + buckets)))) for a, b in zip(s, g)
    ]
    scored = []
    for i, text in rows:
        words, found = features(text, order)
        weight = sum(gain[crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    able = sorted((r for r in scored if r[4] >= min_words), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    drawn = {id(r): k + 1 for k, r in enumerate(able[: len(able) * percent // 100])}
    return sorted(((*r[:4], drawn.get(id(r))) for r in scored), key=repr)


def odd_rows(prose):
    rows = [(i, " ".join(prose(i, 5 + i % 60, 300))) for i in range(200)]
    return rows + [
        (500, None),
        (501, ""),
        (502, "... !!! ---"),
        (503, "ÄÖ É 12_3 Straße\tA\x7fb{c}`d @e [f"),
        (504, "W1 " * 4000),
        (None, " ".join(prose(7, 40, 300))),
        (7, rows[7][1]),
        (505, "x" * 200_000 + " y"),
    ]


@pytest.mark.parametrize("order,percent,min_words", [(1, 10, 20), (2, 30, 20), (3, 100, 0), (1, 0, 20)])
def test_whole_result_equals_plain_loops(spark, documents, prose, order, percent, min_words):
    rows = odd_rows(prose)
    target = [" ".join(prose(900 + i, 30, 40)) for i in range(10)] + [None, ""]
    docs = documents(rows).repartition(3)
    frame = spark.createDataFrame([(str(i), x) for i, x in enumerate(target)], "item_id string, text string")
    got = t.resample(docs, frame, order=order, buckets=997, min_words=min_words, percent=percent)
    found = sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()), key=repr)
    assert found == plain(rows, target, order, 997, min_words, percent)


def test_texts_cut_into_pieces_lose_and_double_nothing(monkeypatch):
    text = " ".join(f"w{i % 13} Zé{i % 7}" for i in range(500))
    whole = [sorted(crc32(f.encode()) % 997 for f in features(text, n)[1]) for n in (1, 2, 3, 4)]
    for piece in (1, 7, 100):
        monkeypatch.setattr(t, "PIECE", piece)
        for order in (1, 2, 3, 4):
            head = t.Head(997, {b"w3": crc32(b"w3")}, {(b"w3", "zé3".encode()): crc32("w3 zé3".encode()) % 997} if order > 1 else {})
            assert sorted(b for _, at in head.of_text(text, order) for b in at.tolist()) == whole[order - 1]
            assert sum(n for n, _ in head.of_text(text, order)) == 1000


def test_head_holds_the_frequent_words(spark, documents, monkeypatch):
    docs = documents([(i, "the cat " * 50 + f"rare{i}") for i in range(20)])
    head = t.head_of(docs, 2)
    assert head.words[b"the"] == crc32(b"the") and head.pairs[b"the", b"cat"] == crc32(b"the cat") % t.BUCKETS
    assert len(head.words) <= t.HEAD


def test_empty_tables(spark, documents):
    none = documents([]), spark.createDataFrame([], "item_id string, text string")
    assert t.resample(*none).count() == 0
    docs = documents([(i, "a b c " * 10) for i in range(20)])
    got = t.resample(docs, none[1])
    assert got.filter("rank is not null").count() == 2 and got.select("weight").distinct().count() == 1


def test_drawn_rows_keep_their_columns(spark, documents, prose):
    docs = documents(odd_rows(prose))
    target = spark.createDataFrame([("a", "w1 w2 w3")], "item_id string, text string")
    kept = t.drawn_documents(docs, target, percent=50)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
