import random
import re

from pyspark.sql import functions as F

from llm_fixtures import documents, prose  # noqa: F401
from varloom.llm import decontaminate as d

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        ws = words(text)
        n = min(width, len(ws))
        for i in range(len(ws) - n + 1 if ws else 0):
            windows.setdefault(tuple(ws[i : i + n]), set()).add(item or "")
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        ws, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                if tuple(ws[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(ws[i : i + n])]
        out.append((doc, len(ws), len(hit), sorted(found)))
    return sorted(out, key=repr)


def cases(seed):
    rng = random.Random(seed)
    small = lambda n: " ".join(rng.choice(["a", "b", "c", "dé"]) for _ in range(n))
    items = [(f"i{k}", small(rng.randrange(1, 40))) for k in range(12)] + [("none", " .,! "), ("null", None), (None, "x y z q r s t u v w k l"), ("i0", "other words under the same id of an item, long enough")]
    docs = [(k, small(rng.randrange(0, 120))) for k in range(40)]
    docs += [(100, None), (101, ""), (102, "X-y  z\nQ r,s;T u v_w k l end"), (103, "b A. " + items[0][1].upper()), (None, items[1][1]), (7, docs[7][1])]
    return docs, items


def test_against_brute_force(spark, documents):
    for seed, block in ((1, d.BLOCK_WORDS), (2, 30)):
        docs, items = cases(seed)
        bench = spark.createDataFrame(items, "item_id string, text string")
        got = d.contamination(documents(docs), bench, block_words=block).select(
            F.when(F.col("_id") < 2**62, F.col("_id")), "n_words", "n_hit", "items"
        )
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items)


def test_no_items_and_no_documents(spark, documents):
    none = spark.createDataFrame([], "item_id string, text string")
    got = d.contamination(documents([(1, "some words here")]), none).first()
    assert (got.n_words, got.n_hit, got["items"]) == (3, 0, [])
    assert d.contamination(documents([]), none).count() == 0


def test_spans_are_cut_and_covered_documents_go(spark, documents, prose):
    item = " ".join(prose(1, 20))
    bench = spark.createDataFrame([("t", item)], "item_id string, text string")
    docs = documents([(1, f"Before it, {item}; after it " + " ".join(prose(2, 60))), (2, item), (3, "clean"), (4, None)])
    left = {r.doc_id: r.text for r in d.without_spans(docs, d.contamination(docs, bench)).collect()}
    assert left == {1: "Before it, ; after it " + " ".join(prose(2, 60)), 3: "clean", 4: None}
    assert d.without_spans(docs, d.contamination(docs, bench)).columns == docs.columns


def brute_cleaned(text, windows, limit=0.5):
    while True:
        found = list(WORD.finditer("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")))
        ws, hit = [m.group() for m in found], set()
        for win in windows:
            for i in range(len(ws) - len(win) + 1):
                if tuple(ws[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
        if not hit:
            return True, text
        if len(hit) / len(ws) > limit:
            return False, None
        for i in sorted(hit, reverse=True):
            # up to the next word where that is hit too
            stop = found[i + 1].start() if i + 1 in hit else found[i].end()
            text = text[: found[i].start()] + text[stop:]


def test_cleaned_against_brute_force(spark, documents, prose):
    for seed, block in ((3, d.BLOCK_WORDS), (4, 30)):
        rng = random.Random(seed)
        items = [(f"i{k}", " ".join(prose(100 * seed + k, n, 3000))) for k, n in enumerate([25, 12, 10, 40, 3, 1])] + [("null", None)]
        long = items[0][1].split()
        # the same words again in another block, and an item inside another one: what is left around it is an item
        items += [("part", " ".join(long[:14])), ("inner", "in the middle")]
        docs = [(0, None), (1, ""), (2, items[3][1]), (None, "no item here")]
        docs += [(3, " ".join(prose(9, 40, 3000) + long[:6] + ["in", "the", "middle"] + long[6:20] + prose(8, 30, 3000)))]
        for k in range(10, 40):
            ws = prose(k + 1000 * seed, rng.randrange(5, 80), 3000)
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(ws))
                ws[at:at] = rng.choice(items[:6])[1].upper().split()
            docs.append((k, "".join(w + rng.choice([" ", ", é; ", "\n"]) for w in ws)))
        windows = set()
        for _, text in items:
            ws = words(text)
            n = min(d.WIDTH, len(ws))
            windows |= {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if ws else set()
        want = [(i, b, None if b is None else len(b)) for i, t in docs for kept, b in [brute_cleaned(t, windows)] if kept]
        assert 3 in {w[0] for w in want} and 2 not in {w[0] for w in want} and sum(len(w[1] or "") for w in want) < sum(len(t or "") for _, t in docs)
        frame = documents(docs)
        got = d.cleaned(frame, spark.createDataFrame(items, "item_id string, text string"), block_words=block)
        assert got.columns == frame.columns
        assert sorted(((r.doc_id, r.text, r.n_chars) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_pipeline_stage_keeps_documents_with_a_short_hit(spark, documents, prose, tmp_path):
    import corpus_pipeline

    item = " ".join(prose(1, 20))
    spark.createDataFrame([("t", item), ("u", "word")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rest = " ".join(prose(2, 300))
    docs = documents([(1, f"{item} {rest}"), (2, item), (3, f"word {rest}"), (4, None)])
    left = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.without_benchmark(spark, docs, str(tmp_path)).collect()}
    assert left == {1: (f" {rest}", len(rest) + 1), 3: (f" {rest}", len(rest) + 1), 4: (None, None)}
