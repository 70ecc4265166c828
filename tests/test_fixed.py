"""Exact weights: texts, multiples and sums against Python's decimals."""

import random
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from varloom.functions import fixed as fx
from varloom.operators import scoring as sc

TEXTS = (
    "0.123456789012345678 -0.123456789012345678 0.000000012345 49999999999999999999.999999999999999999 "
    "-49999999999999999999.999999999999999999 1e-8 1.5E-17 0 -0 -3 120e-2 12000e-20 1.0000000000000000000000 .5 5. 1e19 +7"
).split() + [" 2.5 "]
BAD = ["50000000000000000000", "-50000000000000000000", "abc", "", "1.5e-18", "1e-19", "1e30", "NaN", "inf", "1.2.3", "--1", None]


def exact(value):
    return None if value is None else value.quantize(Decimal(10) ** -18)


def test_texts_become_exact_numbers_or_none(spark):
    with localcontext() as context:
        context.prec = 60
        frame = spark.createDataFrame([(t,) for t in TEXTS + BAD], "t string").withColumn("n", fx.exact_number(F.col("t")))
        got = {r.t: r.n for r in frame.collect()}
        for t in TEXTS:
            assert got[t] == Decimal(t.strip()), t
        assert all(got[t] is None for t in BAD), got


def test_multiples_and_sums_keep_every_digit(spark):
    rnd = random.Random(8)

    def number():
        whole = rnd.choice(["0", "4", str(rnd.randrange(10**6)), "4" + "".join(rnd.choice("0123456789") for _ in range(19))])
        return rnd.choice(["", "-"]) + whole + "." + "".join(rnd.choice("0123456789") for _ in range(rnd.choice([1, 9, 18])))

    data = [(i % 40, number(), rnd.randrange(3)) for i in range(600)]
    frame = spark.createDataFrame(data, "k int, t string, d int").withColumn("n", fx.exact_number(F.col("t")))
    with localcontext() as context:
        context.prec = 80
        for r in frame.withColumn("v", fx.times(F.col("n"), F.col("d"))).collect():
            assert r.v == Decimal(r.t) * r.d
        one = F.col("d").cast("decimal(1,0)")
        sums = frame.groupBy("k").agg(
            fx.settled(F.sum(fx.whole(F.col("n")) * one), F.sum(fx.fraction(F.col("n")) * one)).alias("s")
        )
        totals = {}
        for k, t, d in data:
            totals[k] = totals.get(k, 0) + Decimal(t) * d
        overflow = 0
        for r in sums.collect():
            fits = abs(totals[r.k]) < Decimal(10) ** 20
            overflow += not fits
            assert r.s == (totals[r.k] if fits else None)
        assert 0 < overflow < 40


CALLS = "sample_id string, variant_id string, diploid_low int, diploid_high int"
VARIANTS = "pgs_id string, variant_id string, assembly string, chromosome string, position int, reference string, alternate string, effect_allele string, effect_weight string"


@pytest.fixture(scope="module")
def model(spark):
    def variant(pgs, i, weight):
        return (pgs, f"v{i}", "GRCh38", "1", i, "A", "C", "C", weight)

    rows = [variant("small", 1, "0.123456789012"), variant("small", 2, "0.000000012345"), variant("small", 3, "1e-18")]
    rows += [variant("wide", i, "49999999999999999999.5") for i in (1, 2)]
    rows += [variant("bad", 1, "seven"), variant("bad", 2, "0.1234567890123456789"), variant("bad", 3, "2")]
    models = [(p, "1", "all_supported_variants_required") for p in ("small", "wide", "bad")]
    return (
        sc.parsed_weights(spark.createDataFrame(rows, VARIANTS)),
        spark.createDataFrame(models, "pgs_id string, model_version string, completeness_policy string"),
    )


def test_scores_and_alignment_agree_on_odd_weights(spark, model):
    variants, models = model
    calls = spark.createDataFrame([("a", f"v{i}", 8 + d, 8 + d) for i, d in ((1, 1), (2, 1), (3, 2))], CALLS)
    requests = spark.createDataFrame([("a", p) for p in ("small", "wide", "bad")], "sample_id string, pgs_id string")
    got = {r.pgs_id: r for r in sc.scores(calls, variants, models, requests).collect()}
    assert got["small"].raw_partial_score == Decimal("0.123456801357000002") and got["small"].status == "evaluable"
    assert got["wide"].raw_partial_score == Decimal("99999999999999999999") and got["wide"].score_reason is None
    assert (got["bad"].raw_partial_score, got["bad"].status, got["bad"].contributed_marker_count) == (4, "partial_not_evaluable", 1)
    aligned = sc.alignment(calls, variants, requests).collect()
    reasons = {(r.pgs_id, r.variant_key.split("|")[2]): (r.status, r.reason, r.contribution) for r in aligned}
    assert reasons["small", "2"] == ("matched", None, Decimal("0.000000012345"))
    assert reasons["bad", "1"] == reasons["bad", "2"] == ("excluded", "MODEL_WEIGHT_INVALID", None)
    matched = {p: sum(s == "matched" for (q, _), (s, _, _) in reasons.items() if q == p) for p in got}
    assert matched == {p: r.contributed_marker_count for p, r in got.items()}


def test_a_sum_beyond_the_range_is_a_status(spark, model):
    variants, models = model
    calls = spark.createDataFrame([("a", "v1", 10, 10), ("a", "v2", 10, 10)], CALLS)
    requests = spark.createDataFrame([("a", "wide")], "sample_id string, pgs_id string")
    got = sc.scores(calls, variants, models, requests).first()
    assert (got.status, got.score_reason, got.raw_partial_score) == ("not_evaluable", "SCORE_OVERFLOW", None)
    assert got.absolute_weight_coverage == 1.0
