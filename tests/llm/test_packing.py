import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from llm_fixtures import documents  # noqa: F401
from varloom.llm import packing as p

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "it's DON'T we'll", "<|endoftext|> a <|ENDOFTEXT|><|startoftext|>", "É école ÉCOLE naïve ß ẞ ÿ Ÿ", "ｆｕｌｌ Å K é İi", "a1b22c... ***!!! €5",
    "\x1c\x85 x y", "日本語 テスト 😀👍🏽", "x" * 5000, "A,b;C'd's'", "Σίσυφος ΟΔΟΣ", "<a>|<|>", "ªº²³ μµ",
]


def test_ids_are_those_of_the_tokenizer():
    plain, mine = Tokenizer.from_file(PATH), p.Encoder(PATH)
    rng = random.Random(1)
    letters = "abcXYZéÉüßñ'’.,!?-0123 \n\t<|>_*"
    texts = [t or "" for t in ODD] + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    for t in texts:
        want = plain.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(mine.encode(t.encode()), dtype="<u4").tolist() == want, t


def optimum(lengths, capacity):
    best = len(lengths)
    bins = []

    def go(i):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + lengths[i] <= capacity and bins[b] not in bins[:b]:
                bins[b] += lengths[i]
                go(i + 1)
                bins[b] -= lengths[i]
        bins.append(lengths[i])
        go(i + 1)
        bins.pop()

    go(0)
    return best


def test_plan_places_every_piece_once_and_near_the_optimum():
    rng = random.Random(2)
    for _ in range(150):
        capacity = rng.choice([10, 17, 30])
        lengths = sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 12))), reverse=True)
        counts = defaultdict(int)
        for n in lengths:
            counts[n] += 1
        seen, fill = defaultdict(set), defaultdict(set)
        for length, first, last, seq, per, offset in p.plan(dict(counts), capacity):
            for rank in range(first, last):
                assert rank not in seen[length]
                seen[length].add(rank)
                at = offset + (rank - first) % per * length
                span = set(range(at, at + length))
                assert not span & fill[seq + (rank - first) // per]
                fill[seq + (rank - first) // per] |= span
        assert {k: len(v) for k, v in seen.items()} == dict(counts)
        assert all(f == set(range(len(f))) and len(f) <= capacity for f in fill.values())
        assert len(fill) <= optimum(lengths, capacity) + 1


def test_round_trip(spark, documents):
    rng = random.Random(3)
    texts = ODD + [" ".join(rng.choice(["alpha", "beta", "gamma", "Étude", "!!"]) for _ in range(rng.randrange(4000))) for _ in range(40)]
    rows = list(enumerate(texts)) + [(3, ODD[3]), (None, "no id"), (5, "another text")]
    got = p.pack(documents(rows), PATH).collect()
    plain = Tokenizer.from_file(PATH)
    want = []
    for i, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], dtype="<u4")
            want.append((i if i is not None else p.NO_ID, k, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    fill = defaultdict(list)
    for r in got:
        fill[r.sequence_id].append((r.offset, r.length))
    for spans in fill.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(fill) <= -(-sum(w[3] for w in want) // 2048) + 1
    assert p.pack(documents([]), PATH).count() == 0
