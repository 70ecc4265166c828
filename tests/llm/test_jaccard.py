import random

from llm_fixtures import documents, prose  # noqa: F401
from varloom.llm import jaccard as j
from varloom.llm.common import NO_ID, components, gapless
from varloom.operators.materialize import stored


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())


def brute(rows):
    ids = [NO_ID if i is None else i for i, _ in rows]
    sets = [shingles(t) for _, t in rows]
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if same and 100 * same >= 80 * (len(sets[a]) + len(sets[b]) - same):
                x, y = sorted((find(ids[a]), find(ids[b])))
                root[y] = x
    return sorted((i, len(s), find(i)) for i, s in zip(ids, sets))


def got(frame):
    return sorted((r._id, r.n_shingles, r.component) for r in j.join(frame).collect())


def edited(ws, rng, share):
    return [f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in ws]


def corpus(prose, seed):
    rng = random.Random(seed)
    passage = prose(99, 60)
    rows, n = [], 0
    for c in range(12):  # chains and groups of near copies around the threshold
        now = prose(seed * 100 + c, rng.choice([4, 8, 30, 150, 400]))
        for _ in range(rng.choice([1, 2, 5, 25])):
            rows.append((n, " ".join(now)))
            n += 1
            now = edited(now, rng, rng.choice([0, 0.005, 0.02, 0.04]))
            if rng.random() < 0.3:
                now = now[: int(len(now) * 0.85)] or now
    for _ in range(60):  # texts that share only a passage
        rows.append((n, " ".join(prose(rng.random(), rng.choice([0, 10, 60, 200])) + passage)))
        n += 1
    for _ in range(40):  # exact copies
        rows.append((n, "  " + rows[5][1].upper() + "\n"))
        n += 1
    return rows + [(5000, None), (5001, ""), (5002, " \t "), (5003, "one two"), (5004, "ONE  two"), (5005, "one two three")]


def test_against_brute_force(spark, documents, prose, monkeypatch):
    for seed, frequent in ((1, 24), (2, 3), (3, 10**9)):
        monkeypatch.setattr(j, "FREQUENT", frequent)
        rows = corpus(prose, seed)
        assert got(documents(rows)) == brute(rows)


def test_groups_around_an_absent_base(spark, documents, prose, monkeypatch):
    """Copies with one to six edits of a base that is not there, and copies of copies: pairs on either side of the threshold."""
    rng = random.Random(5)
    rows = []
    for g in range(4):
        base = prose(700 + g, 140 + 5 * g)
        spots = rng.sample(range(5, 135), 12)
        kept = []
        for _ in range(45):
            now = list(rng.choice(kept) if kept and rng.random() < 0.4 else base)
            for at in rng.sample(spots, rng.randrange(1, 7)):
                now[at] = f"e{rng.randrange(3 if g % 2 else 10**6)}"
            kept.append(now)
            rows.append((len(rows), " ".join(now)))
    rows += [(rows[3][0], rows[90][1]), (None, rows[7][1]), (None, rows[100][1])]
    told = {}
    old = j.stored

    def counted(frame, label):
        out = old(frame, label)
        told[label] = told.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(j, "stored", counted)
    assert got(documents(rows)) == brute(rows)
    assert told["centred"] and told["sure"] and told["derived"]


def test_repeated_and_null_ids(spark, documents, prose):
    a, b = " ".join(prose(1, 50)), " ".join(prose(2, 50))
    rows = [(1, a), (7, a), (7, b), (3, b), (3, b), (None, b), (9, " ".join(prose(3, 50)))]
    assert got(documents(rows)) == brute(rows)


def test_no_rows_and_very_long_text(spark, documents, prose):
    assert j.join(documents([])).count() == 0
    long = prose(4, 120_000, 10**6)
    rows = [(1, " ".join(long)), (2, " ".join(long[:110_000])), (3, " ".join(long[:80_000]))]
    assert [c for _, _, c in got(documents(rows))] == [1, 1, 3]


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + rng.randrange(1, 200)) for _ in range(300)] + [(5000, 5000), (6001, 6000), (6000, 6001)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(1, 301)) and found[6001] == 6000 and 5000 not in found
    assert {v for k, v in found.items() if 1000 < k < 1300} == {1000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_gapless(spark):
    frame = stored(spark.range(5000).selectExpr("id", "if(id % 3 = 0, 1, 0) as k"), "t")
    for size in (7, 100, 10**6):
        rows = gapless(frame, ["k"], ["id"], "n", size).collect()
        for key in (0, 1):
            mine = sorted(r.n for r in rows if r.k == key)
            assert mine == list(range(len(mine)))
