import zlib
from collections import Counter, defaultdict

from llm_fixtures import documents  # noqa: F401
from varloom.llm import sharding


def check(rows, frame, shards=8):
    got = sharding.shard(frame, shards).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.text_crc32) for r in got) == sorted(
        (i if i is not None else -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    places = defaultdict(set)
    for r in got:
        places[r.text_crc32].add(r["shard"])
    return {zlib.crc32(t.encode()): len(places[zlib.crc32(t.encode())]) for t, n in Counter(t or "" for _, t in rows).items() if n > 1}


def test_groups_stay_together_and_counts_are_even(spark, documents):
    rows = [(i, f"own text {i}") for i in range(700)]
    rows += [(1000 + i, f"group {i % 60} é") for i in range(300)] + [(5000, None), (5001, ""), (5002, None), (None, "x"), (3, "own text 3"), (3, "again 3")]
    parts = check(rows, documents(rows))
    assert sum(n > 1 for n in parts.values()) <= 2


def test_group_of_a_third_fills_few_shards(spark, documents):
    rows = [(i, "the same text") for i in range(400)] + [(1000 + i, f"t{i}") for i in range(800)]
    assert check(rows, documents(rows))[zlib.crc32(b"the same text")] <= 4


def test_all_linked_few_rows_and_none(spark, documents):
    rows = [(i, f"pair {i // 2}") for i in range(400)]
    check(rows, documents(rows))
    check([(1, "a"), (2, "a"), (3, "b")], documents([(1, "a"), (2, "a"), (3, "b")]))
    assert sharding.shard(documents([])).count() == 0


def test_full_shards_of_linked_rows_cut_no_group_that_fits(spark, documents):
    for rows in (
        [(i, f"pair {i // 2}") for i in range(800)],
        [(i, f"pair {i // 2}") for i in range(760)] + [(1000 + i, f"own {i}") for i in range(40)],
        [(i, f"twenty {i // 20}") for i in range(760)] + [(1000 + i, f"own {i}") for i in range(40)],
    ):
        assert set(check(rows, documents(rows)).values()) == {1}
    # 134 groups of 3 in shards of 50: 128 fit whole
    rows = [(i, f"three {i // 3}") for i in range(400)]
    assert sum(n > 1 for n in check(rows, documents(rows)).values()) <= 5
