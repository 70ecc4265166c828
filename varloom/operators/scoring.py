"""Polygenic scores: exact fixed-point sums over requested (sample, model) pairs."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from varloom.functions.alleles import effect_dosage
from varloom.functions.fixed import EXACT as WEIGHT, exact_number, fraction, magnitude, settled, times, whole
from varloom.operators.materialize import stored
from varloom.operators.scale import balanced_join, in_ranges


def parsed_weights(model_variants: DataFrame) -> DataFrame:
    """Keep the original weight text and add its exact decimal (NULL when it is none or would lose digits)."""
    return model_variants.withColumn("weight", exact_number(F.col("effect_weight")))


def call_reason() -> Column:
    """Why a collapsed call cannot contribute (NULL: it does)."""
    return (
        F.when(F.col("diploid_low").isNull(), "TARGET_VARIANT_MISSING")
        .when(F.col("diploid_low") != F.col("diploid_high"), "DUPLICATE_OBSERVATION_CONFLICT")
        .when(F.col("diploid_low") >= 64, "TARGET_ALLELE_INCOMPATIBLE")
    )


def _dosage() -> Column:
    return effect_dosage(
        (F.col("diploid_low") - 8).cast("int"), F.col("effect_allele"), F.col("alternate")
    )


def alignment(calls: DataFrame, model_variants: DataFrame, requests: DataFrame) -> DataFrame:
    """Status of every model variant for every requesting sample.

    The fan-out over a model's variants follows the requests and rows of each model, so a model that every
    sample requests does not sit in one partition and a rare one is not copied.  A variant whose weight is no exact number is
    excluded here and in :func:`scores`.
    """
    # a dosage is 0, 1 or 2, so products are made once per model variant
    products = model_variants.withColumn("twice", times(F.col("weight"), F.lit(2)))
    wanted = balanced_join(requests, products, ["pgs_id"])
    slim = calls.select("sample_id", "variant_id", "diploid_low", "diploid_high")
    invalid = F.when(F.col("weight").isNull(), "MODEL_WEIGHT_INVALID")
    rows = wanted.join(slim, ["sample_id", "variant_id"], "left").withColumn("reason", F.coalesce(invalid, call_reason()))
    ok = F.col("reason").isNull()
    return rows.select(
        "sample_id",
        "pgs_id",
        F.concat_ws("|", "assembly", "chromosome", "position", "reference", "alternate").alias(
            "variant_key"
        ),
        F.when(ok, "matched").otherwise("excluded").alias("status"),
        "reason",
        F.when(ok, "observed").alias("input_source"),
        F.when(ok, _dosage()).alias("effect_dosage"),
        F.when(
            ok,
            F.when(_dosage() == 1, F.col("weight"))
            .when(_dosage() == 2, F.col("twice"))
            .otherwise(times(F.col("weight"), _dosage())),
        ).alias("contribution"),
    )


def scores(
    calls: DataFrame, model_variants: DataFrame, models: DataFrame, requests: DataFrame
) -> DataFrame:
    """Score, coverage and evaluability per requested (sample, model).

    Only observed calls are joined; what a sample misses is the model total
    minus what contributed, so absent markers are never materialised.  A sum of more than 20 whole digits has no score:
    ``score_reason`` says SCORE_OVERFLOW and the pair is not evaluable.
    """
    size_whole, size_rest = magnitude(F.col("weight"))
    totals = model_variants.groupBy("pgs_id").agg(
        F.count(F.lit(1)).alias("supported"),
        (F.sum(size_whole).cast("double") + F.sum(size_rest).cast("double")).alias("total_abs"),
    )
    info = models.select("pgs_id", "model_version", "completeness_policy").join(
        totals, "pgs_id", "left"
    )
    usable = calls.where(call_reason().isNull()).select("sample_id", "variant_id", "diploid_low")
    dose = _dosage().cast("decimal(1,0)")
    # floors and fractions are taken once per model variant; pairs that nobody requested go when the requests meet their parts
    split = model_variants.where(F.col("weight").isNotNull()).select(
        "pgs_id",
        "variant_id",
        "effect_allele",
        "alternate",
        whole(F.col("weight")).alias("w"),
        fraction(F.col("weight")).alias("f"),
        size_whole.alias("aw"),
        size_rest.alias("af"),
    )
    parts = (
        usable.join(split, "variant_id")
        .select("sample_id", "pgs_id", (F.col("w") * dose).alias("w"), (F.col("f") * dose).alias("f"), "aw", "af")
        .groupBy("sample_id", "pgs_id")
        .agg(
            F.count(F.lit(1)).alias("contributed"),
            settled(F.sum("w"), F.sum("f")).alias("score"),
            (F.sum("aw").cast("double") + F.sum("af").cast("double")).alias("matched_abs"),
        )
    )
    rows = requests.join(info, "pgs_id").join(parts, ["sample_id", "pgs_id"], "left")
    supported = F.coalesce("supported", F.lit(0))
    contributed = F.coalesce("contributed", F.lit(0))
    complete = (
        (contributed == supported)
        & (supported > 0)
        & (F.col("completeness_policy") == "all_supported_variants_required")
    )
    zero = F.lit(0).cast(WEIGHT)
    lost = (contributed > 0) & F.col("score").isNull()
    return rows.select(
        "sample_id",
        "pgs_id",
        "model_version",
        F.when(lost, "not_evaluable")
        .when(complete, "evaluable")
        .when(contributed > 0, "partial_not_evaluable")
        .otherwise("not_evaluable")
        .alias("status"),
        F.when(~lost, F.coalesce("score", zero)).alias("raw_partial_score"),
        F.when(lost, "SCORE_OVERFLOW").alias("score_reason"),
        supported.alias("supported_marker_count"),
        contributed.alias("contributed_marker_count"),
        (supported - contributed).alias("missing_or_excluded_marker_count"),
        contributed.alias("observed_contributed_count"),
        F.lit(0).alias("imputed_contributed_count"),
        F.when(supported > 0, contributed / supported).otherwise(0.0).alias("marker_coverage"),
        F.when(
            F.col("total_abs") > 0,
            F.coalesce("matched_abs", F.lit(0.0)) / F.col("total_abs"),
        )
        .otherwise(0.0)
        .alias("absolute_weight_coverage"),
    )


IDENTITY = ["pgs_id", "model_version", "assembly", "matching_pipeline", "missingness_policy"]


def compare_reference(
    results: DataFrame, reference: DataFrame, identity: list[str] | None = None
) -> DataFrame:
    """z-score and midrank percentile of evaluable scores in their reference distribution.

    ``reference`` is long: identity columns plus ``score``.  Ranks come from
    running counts over distinct values, cut into range partitions; no score is
    ever paired with each reference value.
    """
    identity = identity or IDENTITY
    key = identity[0]
    spread = reference.groupBy(*identity).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("score").isNull() | F.isnan("score") | (F.abs("score") == float("inf"))).alias("bad"),
        F.avg("score").alias("mean"),
        F.var_pop("score").alias("variance"),
    )
    known = reference.select(key).distinct().withColumn("has_reference", F.lit(True))
    asked = results.withColumn("value", F.col("raw_partial_score").cast("double"))
    joined = asked.join(known, key, "left").join(spread, identity, "left")
    reason = (
        F.when(F.col("status") != "evaluable", "MODEL_NOT_EVALUABLE")
        .when(F.col("has_reference").isNull(), "REFERENCE_NOT_SELECTED")
        .when(F.col("n").isNull(), "REFERENCE_IDENTITY_INCOMPATIBLE")
        .when((F.col("n") < 2) | (F.col("bad") > 0), "REFERENCE_DISTRIBUTION_INVALID")
        .when(F.col("variance") <= 0, "REFERENCE_ZERO_VARIANCE")
    )
    # stored: the scores behind it are read for the ranks, the placed and the rest
    judged = stored(
        joined.withColumn("comparison_reason", reason).select(
            "sample_id", *identity, "value", "n", "mean", "variance", "comparison_reason"
        ),
        "judged",
    )
    ready = judged.where("comparison_reason is null")
    points = (
        reference.select(*identity, F.col("score").alias("value"), F.lit(1).alias("w"))
        .unionByName(ready.select(*identity, "value", F.lit(0).alias("w")))
        .groupBy(*identity, "value")
        .agg(F.sum("w").alias("w"))
        .join(spread.where("variance > 0 and bad = 0").select(*identity), identity)
    )
    cut = in_ranges(points, identity, ["value"], "_bucket")
    inner = Window.partitionBy(*identity, "_bucket").orderBy("value")
    before = (
        Window.partitionBy(*identity)
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        cut.groupBy(*identity, "_bucket")
        .agg(F.sum("w").alias("bw"))
        .select(*identity, "_bucket", F.coalesce(F.sum("bw").over(before), F.lit(0)).alias("base"))
    )
    ranked = (
        cut.withColumn("run", F.sum("w").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
        .join(offsets, [*identity, "_bucket"])
        .select(
            *identity,
            "value",
            (F.col("base") + F.col("run") - F.col("w")).alias("below"),
            (F.col("base") + F.col("run")).alias("at_or_below"),
        )
    )
    placed = ready.join(ranked, [*identity, "value"]).select(
        "sample_id",
        *identity,
        F.lit("evaluable").alias("comparison_status"),
        "comparison_reason",
        ((F.col("value") - F.col("mean")) / F.sqrt("variance")).alias("z_score"),
        (100 * ((F.col("below") + F.col("at_or_below")) / 2) / F.col("n")).alias("percentile"),
        F.col("n").alias("sample_count"),
    )
    null_double = F.lit(None).cast("double")
    rest = judged.where("comparison_reason is not null").select(
        "sample_id",
        *identity,
        F.lit("not_evaluable").alias("comparison_status"),
        "comparison_reason",
        null_double.alias("z_score"),
        null_double.alias("percentile"),
        F.lit(None).cast("bigint").alias("sample_count"),
    )
    return placed.unionByName(rest)
