import random

from llm_fixtures import documents, prose  # noqa: F401
from varloom.llm import quality as q


def corpus(prose, n=600):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        ws = prose(i, rng.randrange(60, 200), 800)
        kind = i % 10
        if kind == 0:
            ws = [w.upper() + "!!" for w in ws]
        elif kind == 1:
            ws = [ws[0]] * len(ws)
        elif kind == 2:
            for _ in range(5):
                ws.insert(rng.randrange(len(ws)), rng.choice(["scum", "moron"]))
        rows.append((i, " ".join(ws)))
        if rng.random() < 0.7:
            labels.append((i, int(kind > 1), int(kind == 2)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_bad_documents_go_and_good_ones_stay(spark, documents, prose):
    rows, labels = corpus(prose)
    docs = documents(rows + [(9000, None), (9001, ""), (None, rows[5][1]), rows[7]])
    kept = q.good_documents(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    good = [i for i, _ in rows if i % 10 > 2]
    bad = [i for i, _ in rows if i % 10 < 2]
    toxic = [i for i, _ in rows if i % 10 == 2]
    assert sum(i in ids for i in good) >= 0.97 * len(good)
    assert sum(i in ids for i in bad) <= 0.05 * len(bad)
    assert sum(i in ids for i in toxic) <= 0.2 * len(toxic)
    assert {9000, 9001} <= ids
    again = {r.doc_id for r in q.good_documents(docs, spark.createDataFrame(labels, LABELS)).select("doc_id").collect()}
    assert ids == again


def test_counts_equal_a_plain_count(spark, documents, prose):
    rows, _ = corpus(prose, 30)
    import numpy as np

    frame = documents(rows).selectExpr("text", "doc_id % 2 = 0 as good").mapInArrow(q._counts, "bucket int, raw long, good long")
    raw, good = np.zeros(q.WORDS + q.PAIRS), np.zeros(q.WORDS + q.PAIRS)
    for r in frame.collect():
        raw[r.bucket] += r.raw
        good[r.bucket] += r.good
    mine, mine_good = np.zeros_like(raw), np.zeros_like(raw)
    for i, t in rows:
        for part in q.buckets(t):
            for b in part:
                mine[b] += 1
                mine_good[b] += i % 2 == 0
    assert (raw == mine).all() and (good == mine_good).all()


def test_top_k_is_exact(spark):
    rng = random.Random(1)
    keys = [rng.gauss(0, 1) for _ in range(2000)] + [0.5] * 300 + [1e300, -1e300]
    frame = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, key double")
    for k in (0, 1, 5, 700, 1500, len(keys)):
        got = sorted((r.key for r in q.top_k(frame, k, bins=16).collect()), reverse=True)
        want = sorted(keys, reverse=True)[:k]
        assert got[:k] == want and all(x == want[-1] for x in got[k:])


def test_without_labels_and_rows(spark, documents):
    none = spark.createDataFrame([], LABELS)
    assert q.good_documents(documents([(1, "a b"), (2, None)]), none).count() == 2
    assert q.good_documents(documents([]), none).count() == 0
    odd = spark.createDataFrame([(None, 1, 0), (1, None, None), (1, 1, 0)], LABELS)
    assert q.good_documents(documents([(1, "a b"), (2, None)]), odd).count() == 2


def test_single_insults_go_and_passages_of_rare_words_stay(spark, documents, prose):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(800):
        ws = prose(i, rng.randrange(60, 200), 800)
        at = rng.randrange(len(ws))
        ws[at:at] = [f"rare{rng.randrange(1500)}" for _ in range(8)]
        if i % 10 == 1:
            ws.insert(rng.randrange(len(ws)), rng.choice(["scum", "moron"]))
        if i % 50 == 2:
            ws[at:at] = [f"name{i}"] * 60
        rows.append((i, " ".join(ws)))
        labels.append((i, 1, int(i % 10 == 1)))
    kept = {r.doc_id for r in q.good_documents(documents(rows), spark.createDataFrame(labels, LABELS)).select("doc_id").collect()}
    assert not any(i in kept for i, _ in rows if i % 10 == 1)
    assert sum(i in kept for i, _ in rows if i % 10 != 1) >= 0.97 * 720
    assert sum(i in kept for i, _ in rows if i % 50 == 2) >= 14


def plain_scale(rows):
    """Medians, spreads and cuts by numpy over a list of (mean, word, pair, good)."""
    import numpy as np

    good = np.array([r[:-1] for r in rows if r[-1]], dtype=float)
    bad = np.array([r[:-1] for r in rows if not r[-1]], dtype=float)
    centre = np.median(good, axis=0)
    spread = np.maximum(np.median(np.abs(good - centre), axis=0), 1e-3)
    n_good, n_bad, found = len(good), len(bad), []
    for j in range(3):
        g, b = np.sort(good[:, j]), np.sort(bad[:, j])
        if not len(b):
            found.append(g[0])
            continue
        cuts = np.concatenate((g, b))
        kept = (len(g) - np.searchsorted(g, cuts, side="left")) / n_good
        gone = np.searchsorted(b, cuts, side="left") / n_bad
        cut = cuts[int(np.argmax(np.where(kept >= q.KEEP, gone + kept, -1)))]
        lower = b[b < cut]
        cut = (cut + lower[-1]) / 2 if len(lower) else cut
        found.append(cut)
        good, bad = good[good[:, j] >= cut], bad[bad[:, j] >= cut]
    return q.Scale(tuple(centre), tuple(found), tuple(spread))


def test_cuts_and_medians_are_those_of_all_calibration_rows(spark):
    rng = random.Random(4)
    for n, bad_share in ((1, 0.5), (30, 0.4), (801, 0.3)):
        rows = [(1.0, 1.0, 1.0, True), (-1.0, 0.5, 0.0, False)]
        for _ in range(n):
            ok = rng.random() > bad_share
            rows.append((*(round(rng.gauss(1.0 if ok else -0.5, 0.7), 2) for _ in range(3)), ok))
        frame = spark.createDataFrame(rows, "mean double, word double, pair double, good boolean")
        assert q._calibrate(frame) == plain_scale(rows)


def test_calibration_is_not_cut_at_a_number_of_rows(spark):
    # 150,000 rows: a cut sample of them would have another median and another cut
    rows = spark.range(150_000).selectExpr("cast(id as double) as mean", "0d as word", "0d as pair", "id >= 30000 as good")
    scale = q._calibrate(rows)
    assert (scale.centres[0], scale.cuts[0], scale.spreads[0]) == (89_999.5, 29_999.5, 30_000.0)
    assert q._calibrate(rows.where("good")) is None


def test_calibration_takes_few_jobs(spark):
    # the driver keeps a thread for every exchange, broadcast and query of the last minute: 81 jobs when each sum had windows of its own
    rng = random.Random(8)
    rows = [(*(round(rng.gauss(1.0 if i % 3 else -0.5, 0.7), 2) for _ in range(3)), i % 3 > 0) for i in range(400)]
    frame = spark.createDataFrame(rows, "mean double, word double, pair double, good boolean")
    context = spark.sparkContext
    context.setJobGroup("calibration", "jobs of one calibration")
    try:
        found = q._calibrate(frame)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert found == plain_scale(rows)
    assert len(context.statusTracker().getJobIdsForGroup("calibration")) <= 60


def test_ratios_take_little_of_the_drivers_memory(spark, documents, prose):
    # 69 MB with dense counts of all buckets; the ratios are those of a plain count
    import tracemalloc

    import numpy as np

    rows, _ = corpus(prose, 30)
    frame = documents(rows).selectExpr("doc_id", "text")
    target = frame.filter("doc_id % 3 = 0").selectExpr("text", "true as good")
    tracemalloc.start()
    try:
        got = q._ratios(target, frame.selectExpr("text", "false as good"))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 25e6
    for j in range(2):
        for k, part in enumerate((slice(0, q.WORDS), slice(q.WORDS, q.SIZE))):
            raw, good = np.zeros(q.SIZE, dtype=np.int64), np.zeros(q.SIZE, dtype=np.int64)
            for i, text in rows:
                found = q.buckets(text)[k]
                np.add.at(raw, np.unique(found) if j else found, 1)
                if i % 3 == 0:
                    np.add.at(good, np.unique(found) if j else found, 1)
            share = good.sum() / raw.sum()
            want = np.log((good[part] + q.PRIOR * share) / ((raw[part] + q.PRIOR) * share))
            assert np.allclose(got[j, part], want, rtol=1e-5, atol=1e-6)
