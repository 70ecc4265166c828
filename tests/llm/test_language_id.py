import random

import numpy as np

from llm_fixtures import documents  # noqa: F401
from varloom.llm import language_id as m

SYLLABLES = {"en": ["th", "er", "ing", "and", "of", "wh"], "de": ["sch", "ung", "ein", "ü", "ich", "tz"], "fr": ["eau", "é", "que", "oi", "ê", "lle"]}


def text(lang, rng, n=60):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_ngrams_of_pieces_are_those_of_the_whole(monkeypatch):
    rng = random.Random(3)
    whole = text("fr", rng, 300) + "😀"
    before = np.sort(np.concatenate(list(m.ngram_buckets(whole))))
    for piece in (1, 2, 7, 64):
        monkeypatch.setattr(m, "PIECE", piece)
        assert (np.sort(np.concatenate(list(m.ngram_buckets(whole)))) == before).all()
    assert len(before) == sum(len(whole) - n + 1 for n in (1, 2, 3))


def test_scores_equal_plain_naive_bayes_and_held_out_accuracy(spark, documents):
    rng = random.Random(5)
    rows, langs = [], []
    for i in range(240):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, text(lang, rng)))
        langs.append(lang)
    odd = [(900, None), (901, ""), (902, "123 !?"), (903, "x"), (0, rows[0][1]), (None, text("de", rng)), (904, text("en", rng, 30_000))]
    docs = documents(rows + odd, langs + [None] * 4 + [langs[0], "de", "en"])
    docs = docs.withColumn("held", m.in_held_out())
    train = [(t, la) for (_, t), la, h in zip(rows + odd, langs + [None] * 4 + [langs[0], "de", "en"], [r.held for r in docs.select("held").collect()]) if not h and t is not None and la]
    model = m.fit(docs.filter("not held"))
    assert model.languages == sorted({la for _, la in train})
    # counts by hand
    counts = np.full((m.BUCKETS, 3), 0.5)
    for t, la in train:
        for b in m.ngram_buckets(t):
            np.add.at(counts[:, model.languages.index(la)], b, 1)
    assert np.allclose(model.log_p, np.log(counts / counts.sum(axis=0)), atol=1e-5)
    got = m.predict(docs, model).select("doc_id", "text", "held", "lang", "lang_pred", "score").collect()
    assert len(got) == len(rows) + len(odd)
    assert {r.lang_pred for r in got if r.doc_id in (900, 901, 902)} == {"und"}
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held and r.lang]
    assert len(held) > 30 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97


def test_nothing_learned_and_no_rows(spark, documents):
    docs = documents([(1, "abc"), (2, None)])
    model = m.fit(docs)
    assert {(r.lang_pred, r.score) for r in m.predict(docs, model).collect()} == {("und", 0.0)}
    assert m.predict(documents([]), model).count() == 0
