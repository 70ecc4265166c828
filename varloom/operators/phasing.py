"""Phasing preparation: target alignment, masked-marker selection and assessment."""

from pyspark.sql import DataFrame, functions as F

from varloom.functions.tokens import is_autosome
from varloom.operators.calls import agreed, sorted_alleles
from varloom.operators.scale import numbered

CODES = "^[ACGT]$"


def phasing_alignment(calls: DataFrame, variants: DataFrame, chromosomes: list[str]) -> DataFrame:
    """Eligible collapsed calls, or the first reason that excludes them."""
    rows = calls.where("call_count > 0").join(variants, "variant_id")
    ref, alt = F.col("reference"), F.col("alternate")
    reason = (
        F.when(~agreed(), "discordant_duplicate")
        .when(
            ~F.col("chromosome").isin(*chromosomes) | ~is_autosome(F.col("chromosome")),
            "unsupported_chromosome",
        )
        .when((F.col("min_ploidy") != 2) | (F.col("max_ploidy") != 2), "unsupported_ploidy")
        .when((F.length(ref) != 1) | (F.length(alt) != 1), "non_snv")
        .when(~ref.rlike(CODES) | ~alt.rlike(CODES) | (ref == alt), "invalid_allele")
        .when(F.col("foreign_count") > 0, "reference_mismatch")
    )
    return rows.withColumn("reason", reason).select(
        "sample_id",
        "variant_id",
        F.when(is_autosome(F.col("chromosome")), F.col("chromosome").try_cast("int")).alias(
            "chromosome_number"
        ),
        "chromosome",
        "position",
        "reference",
        "alternate",
        "reason",
        F.when(
            F.col("reason").isNull(),
            sorted_alleles(F.col("min_ploidy"), F.col("max_alt"), ref, alt),
        ).alias("alleles"),
    )


def genomic_order(df: DataFrame) -> DataFrame:
    """Numeric-chromosome genomic order (a range-partitioned sort)."""
    return df.orderBy("chromosome_number", "position", "reference", "alternate", "sample_id")


def masked_markers(rows: DataFrame, fraction: float, seed: int) -> DataFrame:
    """First floor(n·fraction) markers of each sample by hash order of seed and variant.

    The hash prefix is a uniform bucket, so ranks need no per-sample sort.
    """
    if not 0 <= fraction < 1:
        raise ValueError("masked fraction must be in [0, 1)")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("variant_id")), 256)
    keyed = rows.select("sample_id", "variant_id").withColumn("digest", digest)
    sizes = keyed.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"))
    bucket = F.conv(F.substring("digest", 1, 2), 16, 10).cast("int")
    ranked = numbered(
        keyed, ["sample_id"], bucket, [F.col("digest"), F.col("variant_id")], "hash_rank"
    )
    kept = F.floor(F.col("n") * F.lit(fraction))
    return ranked.join(sizes, "sample_id").where(F.col("hash_rank") <= kept).select(
        "sample_id", "variant_id", "hash_rank"
    )


def masked_metrics(truth: DataFrame, inferred: DataFrame) -> DataFrame:
    """Exact denominators per sample; metrics without data stay NULL (not evaluable).

    ``truth``: sample_id, variant_id, reference, alleles; ``inferred``: gt (array, nullable)
    and ds (double, nullable).
    """
    joined = truth.join(
        inferred.select("sample_id", "variant_id", "gt", "ds").withColumn("returned", F.lit(True)),
        ["sample_id", "variant_id"],
        "left",
    )
    dosage = F.size(F.filter("alleles", lambda a: a != F.col("reference")))
    error = F.when(F.col("ds").isNotNull(), F.col("ds") - dosage)
    hard = F.col("gt").isNotNull()
    return joined.groupBy("sample_id").agg(
        F.count_if(F.col("returned")).alias("returned_numerator"),
        F.count(F.lit(1)).alias("returned_denominator"),
        F.count_if(hard & (F.array_sort("gt") == F.array_sort("alleles"))).alias("hard_numerator"),
        F.count_if(hard).alias("hard_denominator"),
        F.avg(F.abs(error)).alias("dosage_mae"),
        F.sqrt(F.avg(error * error)).alias("dosage_rmse"),
    )
