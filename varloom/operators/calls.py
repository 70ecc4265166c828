"""Collapse of repeated genotype calls, shared by every downstream model.

A canonical call over {REF, ALT} is fully described by two small integers, so
"more than one distinct allele multiset" is ``min(code) <> max(code)``: one
hash aggregation over integers with map-side combine, whatever the group size.
"""

from pyspark.sql import Column, DataFrame, functions as F


def call_code(foreign: bool = False) -> Column:
    inside = F.col("ploidy") * 4 + F.col("alt_count")
    return F.coalesce("foreign_code", inside) if foreign else inside


def collapse(genotypes: DataFrame, *keys: str) -> DataFrame:
    """Per (sample, key): row count, multiset agreement, ploidy range, ALT counts.

    Rows with NULL ``alt_count`` (no usable call) only keep the group present.
    An optional ``foreign_code`` marks multisets with an allele outside {REF, ALT}.
    """
    keys = keys or ("variant_id",)
    foreign = "foreign_code" in genotypes.columns
    code, diploid = call_code(foreign), F.col("ploidy") == 2
    inside = diploid & F.col("foreign_code").isNull() if foreign else diploid
    outside = F.count("foreign_code") if foreign else F.lit(0).cast("bigint")
    return genotypes.groupBy("sample_id", *keys).agg(
        F.count("alt_count").alias("call_count"),
        outside.alias("foreign_count"),
        F.min(code).alias("low_code"),
        F.max(code).alias("high_code"),
        F.max("alt_count").alias("max_alt"),
        F.min("alt_count").alias("min_alt"),
        F.min("ploidy").alias("min_ploidy"),
        F.max("ploidy").alias("max_ploidy"),
        F.min(F.when(diploid, code)).alias("diploid_low"),
        F.max(F.when(diploid, code)).alias("diploid_high"),
        F.min(F.when(inside, F.col("alt_count"))).alias("valid_low"),
        F.max(F.when(inside, F.col("alt_count"))).alias("valid_high"),
    )


def agreed() -> Column:
    return F.col("low_code") == F.col("high_code")


def genotype_state() -> Column:
    has_alt = F.col("max_alt") > 0
    return (
        F.when(F.coalesce(F.col("call_count"), F.lit(0)) == 0, "no_canonical_called_genotype")
        .when(~has_alt, "observed_reference_only")
        .when(~agreed(), "discordant_called_rows_with_alt")
        .when(F.col("call_count") == 1, "single_observed_alt_call")
        .otherwise("concordant_observed_alt_calls")
    )


def sorted_alleles(ploidy: Column, alt_count: Column, reference: Column, alternate: Column) -> Column:
    """Allele multiset of a collapsed one- or two-allele call, in sorted order."""
    return F.when(
        ploidy == 1, F.array(F.when(alt_count == 1, alternate).otherwise(reference))
    ).when(
        ploidy == 2,
        F.when(alt_count == 0, F.array(reference, reference))
        .when(alt_count == 2, F.array(alternate, alternate))
        .otherwise(F.array(F.least(reference, alternate), F.greatest(reference, alternate))),
    )
