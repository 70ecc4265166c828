import random
import re

from llm_fixtures import documents  # noqa: F401
from varloom.llm import secrets as s

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KINDS = ("assign", "access", "hex")


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(out)]


def base(row):
    return [f"{f.kind}:{f.start}:{f.stop}" for f in row.found if f.kind in KINDS]


def test_against_brute_force(spark, documents):
    rng = random.Random(6)
    bits = ["password", "Token", "SECRET", "api_key", "apikey", "passwd", '"', "'", " ", ":", "=", "abc", "x9/+", "AKIA", "Z9", "AKIAAKIA", "0123456789ab", "def012345678", "é", "😀", "\n", "g", "token=token:secretvalue"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += [None, "", "AKIA" + "A" * 15, "AKIA" + "A" * 16, "a" * 23, "a" * 24, ("api_key = 'abcdef' é " * 3000), texts[0], texts[0]]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[4])]
    docs = documents(rows)
    findings, entries = s.scan(docs)
    got = sorted((r._id, base(r)) for r in s.by_path(docs, findings).collect())
    assert got == sorted((2**63 - 1 if i is None else i, brute(t)) for i, t in rows)
    blobs = len({t or "" for t in texts})
    assert entries.count() == entries.distinct().count() == blobs * len(s.RULES)


def test_only_unseen_pairs_are_scanned(spark, documents):
    one = documents([(1, "token: abcdefgh"), (2, "nothing")])
    found, ledger = s.scan(one)
    assert found.count() == 1 and ledger.count() == 2 * len(s.RULES)
    two = documents([(5, "token: abcdefgh"), (6, "secret=zyxwvuts -----BEGIN RSA PRIVATE KEY-----")])
    found, more = s.scan(two, ledger)
    assert sorted((r.kind, r.start, r.stop) for r in found.collect()) == [("assign", 0, 15), ("pem", 16, 47)]
    assert more.count() == len(s.RULES)
    newer = (s.Rule("assign", 2, s.BASE[0].pattern, 2, 3), *s.RULES[1:])
    found, more = s.scan(one, ledger, newer)
    assert more.count() == 2 and found.count() == 1
    assert s.scan(two, ledger.union(s.scan(two, ledger)[1]))[0].count() == 0
    findings, entries = s.scan(documents([]))
    assert findings.count() == entries.count() == s.by_path(documents([]), findings).count() == 0
