"""N-gram Jaccard join by set relations.

A document's set holds its distinct five-word shingles (64-bit digests); two documents link when the sets' Jaccard
similarity is at least 0.8.  The join is exact and returns components, never the pairs inside a group of copies:

1. Equal sets are one class; only its representative, the smallest id, is joined.
2. Shingles are put in one global order, rare ones first: a bitmap of fixed size tells which shingles many documents share (it only
   steers the order; any bitmap gives the same links).  A set's prefix in that order, a fifth of it, must meet the prefix of every partner.
3. Prefixes become index lists.  A list is skipped unless it has two sets and at least one of them within the positions that the
   smaller set of a linked pair can have (a ninth of the set).
4. Each set is verified against one leader, the most central set of most of its lists: the one whose position says that it has
   the fewest rare shingles of its own.  Sets linked to one leader are in one component without being compared.  In ``ROUNDS`` more
   rounds the sets outside the largest component of their lists meet the most central set of that component.
5. Only lists that still hold several components are left.  Two of their sets that were verified against one leader are
   derived from those answers: an answer keeps what the set has more and less than its leader, which also tells the centre of all
   its members (what most of them hold) and what each differs from it in.  Sets close to the centre link through the closest one.
   Any other pair links only if these differences share enough tokens: rare ones are met first, common ones skipped by position.
6. Sets without a common leader are joined on their lists, those outside the largest component against the list, under the
   size and position bounds and a bound from parity bitmaps of the whole sets, and verified exactly.

Long lists are salted when leaders are chosen, and joins split skewed keys.  Sets are made from the text where they are needed and
only for documents in a candidate pair (another fixed-size bitmap, exact join after it).

Defined cases: null, empty and blank texts have the empty set and link with nothing; texts of fewer than five words are one
shingle; rows that repeat an id are one document, so all their texts share a component (answers about an id that stands for
several sets are not reused); null ids are one document that comes last; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varloom.llm.common import components, keyed, slices
from varloom.operators.materialize import stored

SHINGLE = 5
#: Documents that make a shingle a frequent one.
FREQUENT = 24
#: Share of all shingle digests that are counted; prefixes seldom reach beyond it.  Sets up to SMALL are counted whole.
COUNTED, SMALL = 0.24, 64
#: Bits of the order and id bitmaps: 1 MB each.
BITS = 1 << 23
SALTS = 16
#: Words of 64 bits of a set's parity bitmap.
PARITY = 4
#: Rounds in which sets outside a list's largest component meet its most central set, before pairs are formed.
ROUNDS = 2

_LOW = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SIGN = np.uint64(1 << 63)
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX[1]
    h = (h ^ (h >> np.uint64(29))) * _MIX[2]
    return h ^ (h >> np.uint64(32))


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct shingle digests (signed 64-bit) of a text."""
    words = text.translate(_LOW).split()
    if not words:
        return np.empty(0, dtype=np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(SHINGLE, len(h))
    total = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for j in range(width):
        total += _mixed(h[j : len(h) - width + 1 + j] + _MIX[j]) * _MIX[(j + 1) % SHINGLE]
        total = (total ^ (total >> np.uint64(27))) * _MIX[0]
    return np.unique(_mixed(total).view(np.int64))


def _bitmap(ids: DataFrame, name: str) -> np.ndarray:
    """The bitmap, BITS wide, of the values of one non-negative integer column below BITS; at most 257 rows reach the driver."""
    at = F.col(name).cast("long") + 1
    parts = ids.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )
    size = 32768
    out = np.zeros(BITS, dtype=bool)
    for row in parts.collect():
        start = (row["part"] - 1) * size
        out[start : start + size] = np.unpackbits(np.frombuffer(bytes(row["bits"]), dtype=np.uint8), bitorder="little")
    return np.packbits(out)


def _has(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    limit = int(-(2**63) + COUNTED * 2**64)
    for batch in slices(batches, 2_000):
        parts = []
        for text in batch.column("_bytes").to_pylist():
            found = shingle_set(text)
            parts.append(found if len(found) <= SMALL else found[: np.searchsorted(found, limit)])
        tokens, n = np.unique(np.concatenate(parts) if parts else np.empty(0, np.int64), return_counts=True)
        for start in range(0, len(tokens), 50_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[start : start + 50_000]), pa.array(n[start : start + 50_000])], ["token", "n"]
            )


def _texts(base: DataFrame) -> DataFrame:
    return base.select("_id", F.col("_text").cast("binary").alias("_bytes"))


def _sets(base: DataFrame) -> DataFrame:
    """(_id, n, s1, s2, prefix, cold, parity): size, two digests and parity bitmap of the whole set, prefix in the global
    order and the length of its rare part."""
    counted = _texts(base).mapInArrow(_frequencies, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    frequent = counted.filter(F.col("n") >= FREQUENT).select(F.pmod("token", F.lit(BITS)).alias("at"))
    order = base.sparkSession.sparkContext.broadcast(_bitmap(frequent, "at"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list] = [[], [], [], [], [], []]
            for text in batch.column("_bytes").to_pylist():
                found = shingle_set(text)
                n = len(found)
                size = n - (4 * n + 4) // 5 + 1 if n else 0
                hot = _has(order.value, found & (BITS - 1))
                digests = found.view(np.uint64)
                # a shingle's place in the global order, 62 bits of its digest under the frequent bit
                keys = (((digests ^ _SIGN) >> np.uint64(2)) | (hot.astype(np.uint64) << np.uint64(62))).view(np.int64)
                rare = keys[~hot][:size]
                out[0].append(n)
                out[1].append(int(_mixed(digests + _MIX[3]).sum().view(np.int64)) if n else 0)
                out[2].append(int(_mixed(digests ^ _MIX[4]).sum().view(np.int64)) if n else 0)
                out[3].append(np.concatenate((rare, keys[hot][: size - len(rare)])))
                out[4].append(len(rare))
                odd = np.bincount((_mixed(digests) & np.uint64(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY) & 1
                out[5].append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), *(pa.array(c, k) for c, k in zip(out, kinds))],
                ["_id", "n", "s1", "s2", "prefix", "cold", "parity"],
            )

    return stored(
        _texts(base).mapInArrow(
            run, "_id long, n int, s1 long, s2 long, prefix array<long>, cold int, parity array<long>"
        ),
        "sets",
    )


def _whole_sets(base: DataFrame, ids: DataFrame) -> DataFrame:
    """(_id, tokens) of the documents in ``ids`` (column _id) and of few others."""
    at = F.pmod(F.xxhash64("_id"), F.lit(BITS))
    wanted = base.sparkSession.sparkContext.broadcast(_bitmap(ids.select(at.alias("at")), "at"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.flatnonzero(_has(wanted.value, batch.column("_at").to_numpy()))
            for part in slices([batch.take(pa.array(rows))]):
                tokens = [shingle_set(t) for t in part.column("_bytes").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(tokens, pa.list_(pa.int64()))], ["_id", "tokens"]
                )

    rows = base.select("_id", at.alias("_at"), F.col("_text").cast("binary").alias("_bytes"))
    return rows.mapInArrow(run, "_id long, tokens array<long>")


def _verified(base: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, same, total, added, removed) of each pair: overlap, sum of the sizes, and what b has more and less than a where
    that is at most half of the sum (else null); ``pairs`` (a, b) is stored and may repeat a often."""
    ids = pairs.select(F.col("a").alias("_id")).union(pairs.select(F.col("b").alias("_id")))
    whole = stored(_whole_sets(base, ids), "whole")
    with_b = pairs.join(whole.select(F.col("_id").alias("b"), F.col("tokens").alias("tb")), "b")
    both = with_b.join(whole.select(F.col("_id").alias("a"), F.col("tokens").alias("ta")), "a")
    differing = both.select(
        "a",
        "b",
        F.size("tb").alias("nb"),
        (F.size("ta") + F.size("tb")).alias("total"),
        F.array_except("tb", "ta").alias("added"),
        F.array_except("ta", "tb").alias("removed"),
    )
    near = (F.size("added") + F.size("removed")) * 2 <= F.col("total")
    return differing.select(
        "a",
        "b",
        (F.col("nb") - F.size("added")).alias("same"),
        "total",
        F.when(near, F.col("added")).alias("added"),
        F.when(near, F.col("removed")).alias("removed"),
    )


def _linked():
    return F.col("same") * 180 >= F.col("total") * 80


def _sizes_fit(a: str, b: str):
    return (F.col(a) * 5 >= F.col(b) * 4) & (F.col(b) * 5 >= F.col(a) * 4)


def _central():
    """Orders the sets of a list by how early its shingle comes: the set with the fewest rare shingles of its own is first."""
    return F.struct((F.col("pos") / F.col("n")).alias("place"), "rep", "n")


def _edges(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _asked(base: DataFrame, asks: DataFrame, answers: DataFrame | None) -> DataFrame:
    """(a, b, j, same, total, added, removed): each set b verified against the leader a that most of its ``asks`` name and
    ``answers`` lack."""
    named = (
        asks.filter((F.col("rep") != F.col("lead")) & _sizes_fit("n", "lead_n"))
        .groupBy("rep", "lead")
        .agg(F.count("*").alias("k"))
    )
    if answers is not None:
        named = named.join(answers.select(F.col("b").alias("rep"), F.col("a").alias("lead")), ["rep", "lead"], "left_anti")
    most = named.groupBy("rep").agg(F.max(F.struct("k", (-F.col("lead")).alias("minus"))).alias("m"))
    pairs = stored(most.select((-F.col("m.minus")).alias("a"), F.col("rep").alias("b")), "pairs")
    likeness = F.col("same") / (F.col("total") - F.col("same"))
    best = F.max(F.struct(likeness.alias("j"), "same", "total", "added", "removed")).alias("m")
    found = _verified(base, pairs).groupBy("a", "b").agg(best)
    return stored(found.select("a", "b", "m.*"), "answers")


def _open_lists(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """(token, rep, n, pos, root, main) of the lists with several components; main is the largest."""
    members = lists.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").withColumn(
        "root", F.coalesce("root", "rep")
    )
    several = (
        members.groupBy("token", "root")
        .agg(F.count("*").alias("k"))
        .groupBy("token")
        .agg(F.count("*").alias("roots"), F.max(F.struct("k", "root")).alias("m"))
        .filter("roots > 1")
        .select("token", F.col("m.root").alias("main"))
    )
    return stored(members.join(several, "token"), "open")


def _centred(near: DataFrame, members: DataFrame) -> DataFrame:
    """(lead, rep, n, root, diff, w) of the ``members`` (rep, n, root) with answers about a leader in ``near``.

    A leader's centre is the set of the tokens that most of its members hold; diff is what a set differs from that centre
    in.  Two sets of one leader differ in just what their diffs differ in.  w is 9 |diff| - n: two sets whose w sum to at most 0
    link, as the sizes of their diffs bound their difference.  Leaders whose members are all of one component are left out.
    """
    known = near.join(members, "rep").select("lead", "rep", "n", "root", F.concat("added", "removed").alias("diff"))
    spans = known.groupBy("lead").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("m"))
    open_ = known.join(spans.filter("r0 < r1").select("lead", "m"), "lead")
    held = open_.select("lead", "m", F.explode("diff").alias("token")).groupBy("lead", "token").agg(
        F.count("*").alias("k"), F.first("m").alias("m")
    )
    # at most twice a mean diff of tokens
    moved = held.filter(F.col("k") * 2 > F.col("m")).groupBy("lead").agg(F.collect_list("token").alias("moved"))
    centred = open_.join(moved, "lead", "left").withColumn("moved", F.coalesce("moved", F.array().cast("array<bigint>")))
    diff = F.concat(F.array_except("diff", "moved"), F.array_except("moved", "diff"))
    return stored(
        centred.select("lead", "rep", "n", "root", diff.alias("diff")).withColumn("w", 9 * F.size("diff") - F.col("n")), "centred"
    )


def _hubs(centred: DataFrame) -> DataFrame:
    """(a, b): each set and the set of least w of its leader, where their w say that they link.  Any two sets whose w say so
    both link with that one, so that the components of all such pairs are these."""
    hub = centred.groupBy("lead").agg(F.min(F.struct("w", "rep", "root")).alias("hub"))
    return centred.join(hub, "lead").filter("root <> hub.root and w + hub.w <= 0").select(
        F.col("rep").alias("a"), F.col("hub.rep").alias("b")
    )


def _derived(centred: DataFrame, roots: DataFrame) -> DataFrame:
    """(a, b) of the linked pairs with different roots and a common leader, from their diffs.

    A pair links if 9 times what its diffs differ in is at most the sum of the sizes.  Sets of different components have w that
    sum to more than 0, so their diffs share at least an eighteenth of that sum, which is more than nothing.  Tokens go
    rare ones first; those that only one diff of a leader has are left out.
    """
    now = centred.drop("root").join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").withColumn(
        "root", F.coalesce("root", "rep")
    )
    spans = now.groupBy("lead").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.min("w").alias("least_w"))
    open_ = now.join(spans.filter("r0 < r1").select("lead", "least_w"), "lead")
    each = open_.select("lead", "rep", "n", "root", "w", "least_w", F.explode("diff").alias("token"))
    shared = each.withColumn("k", F.count("*").over(Window.partitionBy("lead", "token"))).filter("k > 1")
    rare_last = Window.partitionBy("lead", "rep").orderBy(F.desc("k"), F.desc("token"))
    # rest: how many shared tokens a set has from here on; a partner's w is known to be at least the leader's least
    postings = shared.withColumn("rest", F.row_number().over(rare_last)).filter("18 * rest >= w + least_w")
    fits = [
        "x.lead = y.lead and x.token = y.token and x.root <> y.root and x.rep < y.rep",
        "x.n * 5 >= y.n * 4 and y.n * 5 >= x.n * 4",
        "18 * least(x.rest, y.rest) >= x.w + y.w",
    ]
    pairs = (
        postings.alias("x")
        .join(postings.alias("y"), F.expr(" and ".join(f"({f})" for f in fits)))
        .groupBy(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
        .agg(F.min("x.lead").alias("lead"))
    )
    x = centred.select("lead", F.col("rep").alias("a"), F.col("w").alias("wa"), F.col("diff").alias("da"))
    y = centred.select("lead", F.col("rep").alias("b"), F.col("w").alias("wb"), F.col("diff").alias("db"))
    both = stored(pairs, "derived").join(x, ["lead", "a"]).join(y, ["lead", "b"])
    return both.filter(18 * F.size(F.array_intersect("da", "db")) >= F.col("wa") + F.col("wb")).select("a", "b")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: _id, n_shingles, component (smallest id reachable by links)."""
    base = keyed(docs, id_col, text_col)
    sets = _sets(base)
    key = ["n", "s1", "s2"]
    some = sets.filter("n > 0")
    classes = some.groupBy(*key).agg(F.min("_id").alias("rep"))
    firsts = some.join(classes.withColumnRenamed("rep", "_id"), [*key, "_id"], "left_semi").withColumnRenamed("_id", "rep")
    postings = firsts.select("rep", "n", "cold", F.posexplode("prefix").alias("pos", "token")).select(
        "token",
        "rep",
        "n",
        "pos",
        F.when(F.col("pos") >= F.col("cold"), F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")).otherwise(-1).alias("salt"),
    )
    indexed = F.col("pos") <= F.col("n") - F.ceil(F.col("n") * 8 / 9)
    group = Window.partitionBy("token", "salt")
    lists = (
        postings.withColumn("size", F.count("*").over(group))
        .withColumn("usable", F.max(indexed).over(group))
        .withColumn("lead", F.min(_central()).over(group))
        .filter((F.col("salt") >= 0) | ((F.col("size") > 1) & F.col("usable")))
        .select("token", "salt", "rep", "n", "pos", F.col("lead.rep").alias("lead"), F.col("lead.n").alias("lead_n"))
    )
    lists = stored(lists, "lists")

    # round 1: every set against the most central set of most of its lists
    heads = lists.filter("salt >= 0").groupBy("token", "salt").agg(F.min(_central()).alias("m"))
    first = F.min(F.struct("m.place", "m.rep", "m.n")).over(Window.partitionBy("token"))
    heads = heads.withColumn("first", first).select(
        F.col("m.rep").alias("rep"), F.col("m.n").alias("n"), F.col("first.rep").alias("lead"), F.col("first.n").alias("lead_n")
    )
    answers = _asked(base, lists.select("rep", "n", "lead", "lead_n").unionByName(heads), None)
    again = classes.join(some.select(*key, "_id"), key).select("rep", "_id").distinct()
    repeated = again.groupBy("_id").agg(F.count("*").alias("k"), F.min("rep").alias("one")).filter("k > 1")
    same_id = again.join(repeated, "_id").filter("rep <> one").select(F.col("one").alias("a"), F.col("rep").alias("b"))
    roots = components(answers.filter(_linked()).select("a", "b").unionByName(same_id))
    left = _open_lists(lists.select("token", "rep", "n", "pos"), roots)

    # further rounds: sets outside a list's largest component against the most central set of that component
    for _ in range(ROUNDS):
        if not left.limit(1).count():
            break
        centre = left.filter("root = main").groupBy("token").agg(F.min(_central()).alias("m"))
        asks = left.filter("root <> main").join(
            centre.select("token", F.col("m.rep").alias("lead"), F.col("m.n").alias("lead_n")), "token"
        )
        more = _asked(base, asks.select("rep", "n", "lead", "lead_n"), answers)
        answers = answers.unionByName(more)
        roots = components(more.filter(_linked()).select("a", "b").unionByName(_edges(roots)))
        left = _open_lists(left.select("token", "rep", "n", "pos"), roots)

    # what is left: pairs across components, first those with a common leader, from the answers about it
    several = classes.groupBy("rep").agg(F.count("*").alias("k")).filter("k > 1").select("rep")
    told = answers.join(several.withColumnRenamed("rep", "a"), "a", "left_anti").join(
        several.withColumnRenamed("rep", "b"), "b", "left_anti"
    )
    near = stored(
        told.filter("added is not null").select(F.col("a").alias("lead"), F.col("b").alias("rep"), "added", "removed"), "near"
    )
    members = left.select("rep", "n", "root").distinct()
    centred = _centred(near, members)
    sure = stored(_hubs(centred), "sure")
    if sure.limit(1).count():
        roots = components(sure.unionByName(_edges(roots)))
    links = _derived(centred, roots)

    # then those without: no bound may rule them out
    known = told.groupBy(F.col("b").alias("rep")).agg(
        F.map_from_entries(F.collect_list(F.struct("a", 1 - F.col("j")))).alias("far"),
        F.collect_list(F.when(F.col("added").isNotNull(), F.col("a"))).alias("leads"),
    )
    alone = firsts.select("rep", "n", "parity").join(several.withColumn("many", F.lit(True)), "rep", "left")
    own = F.col("many").isNull()
    left = left.join(alone, ["rep", "n"]).join(known, "rep", "left").select(
        *left.columns,
        "parity",
        F.map_concat(
            F.coalesce("far", F.expr("map()").cast("map<bigint,double>")),
            F.when(own, F.create_map("rep", F.lit(0.0))).otherwise(F.expr("map()").cast("map<bigint,double>")),
        ).alias("far"),
        F.concat(
            F.coalesce("leads", F.array().cast("array<bigint>")),
            F.when(own, F.array("rep")).otherwise(F.array().cast("array<bigint>")),
        ).alias("leads"),
    )
    left = stored(left, "open")
    fits = [
        "x.token = y.token and x.root <> y.root and (y.root = y.main or x.rep < y.rep)",
        "x.n * 5 >= y.n * 4 and y.n * 5 >= x.n * 4",
        "least(x.n - x.pos, y.n - y.pos) * 9 >= (x.n + y.n) * 4",
        "not arrays_overlap(x.leads, y.leads)",
        # triangle inequality over every set both were verified against
        "not exists(map_keys(x.far), k -> abs(x.far[k] - coalesce(y.far[k], x.far[k])) > 0.2 + 1e-9)",
        # every shingle in one set only flips one parity bit, so as many bits differ as shingles at most
        " + ".join(f"bit_count(x.parity[{i}] ^ y.parity[{i}])" for i in range(PARITY))
        + " <= x.n + y.n - 2 * ((4 * (x.n + y.n) + 8) div 9)",
    ]
    rest = (
        left.filter("root <> main").alias("x")
        .join(left.alias("y"), F.expr(" and ".join(f"({f})" for f in fits)))
        .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))
        .distinct()
    )
    rest = stored(rest, "rest")
    links = stored(links.unionByName(_verified(base, rest).filter(_linked()).select("a", "b")), "links")
    if links.limit(1).count():
        roots = components(links.unionByName(_edges(roots)))
    whole = (
        sets.select("_id", *key)
        .join(classes, key, "left")
        .join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
    )
    return whole.select(
        "_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("root", "rep", "_id").alias("component")
    )
