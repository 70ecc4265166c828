"""Exact-allele links between external representations and canonical variants."""

from pyspark.sql import DataFrame, functions as F

from varloom.functions.ids import stable_id
from varloom.operators.normalize import KEY


def exact_allele_links(representations: DataFrame, variants: DataFrame) -> DataFrame:
    """Outcome and reason per representation; only complete GRCh38 keys are joined."""
    incomplete = F.lit(False)
    for column in KEY:
        incomplete = incomplete | F.col(column).isNull()
    early = (
        F.when(F.col("variation_type") != "SimpleAllele", "unsupported_variation_type")
        .when(incomplete, "incomplete_allele_identity")
        .when(F.col("assembly") != "GRCh38", "assembly_incompatible")
    )
    marked = representations.withColumn("reason", early)
    targets = variants.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("targets"), F.min("variant_id").alias("target")
    )
    joined = (
        marked.where("reason is null")
        .drop("reason")
        .join(targets, KEY, "left")
        .withColumn(
            "reason",
            F.when(F.col("targets").isNull(), "allele_not_in_normalization_run")
            .when(F.col("targets") > 1, "multiple_canonical_targets")
            .otherwise("exact_allele_match"),
        )
        .withColumn("variant_id", F.when(F.col("targets") == 1, F.col("target")))
    )
    rest = marked.where("reason is not null").withColumn(
        "variant_id", F.lit(None).cast("string")
    )
    columns = ["representation_id", "reason", "variant_id", *KEY]
    out = joined.select(*columns).unionByName(rest.select(*columns))
    reason = F.col("reason")
    return out.withColumn(
        "outcome",
        F.when(reason == "exact_allele_match", "matched")
        .when(reason == "allele_not_in_normalization_run", "unmatched")
        .when(reason == "multiple_canonical_targets", "ambiguous")
        .when(reason == "unsupported_variation_type", "unsupported")
        .otherwise("incompatible"),
    ).withColumn("link_id", stable_id("link", "representation_id", *KEY, "outcome"))


def histogram(df: DataFrame, **dimensions: str) -> DataFrame:
    """Counts of several columns, one (dimension, value, n) row each, from one grouping."""
    counted = df.groupBy(*dimensions.values()).agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("dimension"), F.col(c).cast("string").alias("value"))
            for name, c in dimensions.items()
        ]
    )
    return (
        counted.select(F.explode(pairs).alias("kv"), "n")
        .where("kv.value is not null")
        .groupBy("kv.dimension", "kv.value")
        .agg(F.sum("n").alias("n"))
    )
