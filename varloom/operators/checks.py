"""Constraint checks.  Every check is a DataFrame of violations; empty means valid."""

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from varloom.operators.scale import in_ranges


def union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def missing_parents(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, check: str
) -> DataFrame:
    """Foreign keys without a parent, with the number of rows that carry each.

    The child side is counted per key first (map-side combine), so a popular
    broken key is one row by the time it is joined.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    known = parent.select(F.col(parent_column).alias("key")).distinct()
    return used.join(known, "key", "left_anti").select(
        F.lit(check).alias("check"), F.col("key").cast("string").alias("key"), "rows"
    )


def repeated_keys(df: DataFrame, keys: list[str], check: str) -> DataFrame:
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
        .select(F.lit(check).alias("check"), F.concat_ws("|", *keys).alias("key"), "rows")
    )


def broken_rules(df: DataFrame, rules: dict[str, str], *ids: str) -> DataFrame:
    """One row per (record, broken rule); a rule is a condition that must not be false or NULL."""
    names = F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(F.expr(ok), F.lit(False)), F.lit(name))
                for name, ok in rules.items()
            ]
        )
    )
    return df.select(*ids, F.explode(names).alias("rule"))


def count_mismatches(declared: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose declared count differs from the counted one (either side may be absent)."""
    d = declared.select(*keys, F.col("declared").cast("bigint").alias("declared"))
    a = actual.groupBy(*keys).agg(F.count(F.lit(1)).alias("actual"))
    joined = d.join(a, keys, "full")
    return joined.select(
        *keys,
        F.coalesce("declared", F.lit(0)).alias("declared"),
        F.coalesce("actual", F.lit(0)).alias("actual"),
    ).where("declared <> actual")


def order_violations(df: DataFrame, keys: list[str], index: str, columns: list[str], strict: bool = True) -> DataFrame:
    """Rows that are not after (``strict``) or not before their predecessor in ``index`` order, inside each key (or of all rows).

    Rows are cut into ranges of (keys, index), which follow the rows whatever the keys: predecessors are found inside a range, and
    the first row of a range meets the last one of the range before it that has the key, through a table of one row per key and range.
    """
    ranged = in_ranges(df.withColumn("_value", F.struct(*columns)), keys, [index])
    inside = Window.partitionBy(*keys, "_range").orderBy(index)
    ends = ranged.groupBy(*keys, "_range").agg(F.max_by("_value", index).alias("_last"))
    carried = ends.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_range").alias("_r"),
        F.lag("_last").over(Window.partitionBy(*keys).orderBy("_range")).alias("_carried"),
    )
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    rows = ranged.withColumn("_before", F.lag("_value").over(inside)).withColumn("_first", F.row_number().over(inside) == 1)
    met = rows.join(carried, same, "left")
    prior = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_before"))
    bad = F.col("_value") <= prior if strict else F.col("_value") < prior
    return met.where(prior.isNotNull() & bad).select(*df.columns)


def gram_violations(loadings: DataFrame, tolerance: float) -> DataFrame:
    """Entries of LᵀL that differ from the identity, from one pass over the markers."""
    pairs = F.flatten(
        F.transform(
            "loadings",
            lambda a, i: F.transform(
                "loadings", lambda b, j: F.struct(i.alias("i"), j.alias("j"), (a * b).alias("v"))
            ),
        )
    )
    gram = (
        loadings.select("model_id", F.explode(pairs).alias("e"))
        .groupBy("model_id", "e.i", "e.j")
        .agg(F.sum("e.v").alias("value"))
    )
    identity = F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)
    return gram.where(
        F.isnan("value") | (F.abs(F.col("value") - identity) > tolerance)
    ).select("model_id", F.col("i").alias("row"), F.col("j").alias("column"), "value")


def summary_mismatches(scores: DataFrame, declared: DataFrame, tolerance: float) -> DataFrame:
    """Components whose score mean or deviation differs from the declared metadata."""
    from varloom.operators.projection import component_spread

    actual = component_spread(scores)
    joined = actual.join(declared, "component_index", "full")
    bad = (
        F.abs(F.col("score_mean") - F.col("declared_mean")) > tolerance
    ) | (F.abs(F.col("score_sd") - F.col("declared_sd")) > tolerance)
    return joined.where(F.coalesce(bad, F.lit(True)))


def mixed_releases(rows: DataFrame) -> DataFrame:
    """(gene, source) pairs that mix source versions."""
    return (
        rows.select("gene_id", "source_id", "source_version")
        .distinct()
        .groupBy("gene_id", "source_id")
        .agg(F.count(F.lit(1)).alias("versions"))
        .where("versions > 1")
    )


def pgx_rule_violations(
    genes: DataFrame, alleles: DataFrame, constraints: DataFrame, rules: DataFrame | None = None
) -> DataFrame:
    """Alleles without constraints, structural constraints in matchable genes, retired use."""
    undefined = alleles.join(
        constraints.select("allele_id").distinct(), "allele_id", "left_anti"
    ).select(F.lit("allele_without_constraint").alias("rule"), F.col("allele_id").alias("key"))
    structural = (
        constraints.where("state = 'unsupported_structural_requirement'")
        .select("allele_id")
        .distinct()
        .join(alleles.select("allele_id", "gene_id"), "allele_id")
        .join(genes.where("strategy = 'star_haplotype_small_variant'").select("gene_id"), "gene_id")
        .select(F.lit("structural_constraint_in_matchable_gene").alias("rule"), F.col("allele_id").alias("key"))
    )
    parts = [undefined, structural]
    if rules is not None:
        retired = alleles.where("status = 'retired'").select(F.col("allele_id").alias("used"))
        used = rules.where("not coalesce(historical_mapping, false)").select(
            "rule_id", F.explode(F.array("allele_a", "allele_b")).alias("used")
        )
        parts.append(
            used.join(retired, "used", "left_semi")
            .select(F.lit("retired_allele_rule").alias("rule"), F.col("rule_id").alias("key"))
            .distinct()
        )
    return union(*parts)


# Record rules: SQL condition per rule name, applied with broken_rules.
VARIANT_RULES = {
    "position_positive": "position > 0",
    "alleles_upper": "reference = upper(reference) and alternate = upper(alternate)",
    "alleles_differ": "reference <> alternate",
}
OBSERVATION_RULES = {
    "called_has_alleles": "call_status <> 'called' or size(alleles) > 0",
    "uncalled_has_none": "call_status = 'called' or size(alleles) = 0",
}
MAPPING_RULES = {
    "mapped_has_target": "outcome <> 'mapped' or (variant_id is not null"
    " and target_chromosome is not null and target_position is not null)",
    "mapped_reference_match": "outcome <> 'mapped' or reference_validation = 'match'",
    "mapped_liftover_success": "outcome <> 'mapped' or not liftover_required"
    " or liftover_status = 'success'",
    "unmapped_has_no_variant": "outcome = 'mapped' or variant_id is null",
    "ambiguous_has_candidates": "outcome <> 'ambiguous' or candidate_count > 0",
}
LINK_RULES = {"matched_iff_variant": "(outcome = 'matched') = (variant_id is not null)"}
GENOTYPE_RULES = {
    "called_matches_ploidy": "call_status = 'called' and size(alleles) = ploidy",
    "alleles_in_ref_alt": "forall(alleles, a -> a = reference or a = alternate)",
}
INFERENCE_RULES = {
    "probabilities_in_range": "forall(map_values(genotype_probabilities), p -> p >= 0 and p <= 1)",
    "probabilities_sum_to_one": "abs(aggregate(map_values(genotype_probabilities), 0D,"
    " (acc, p) -> acc + p) - 1) <= 1e-6",
    "dosage_in_range": "dosage is null or dosage between 0 and 2",
}
PROVENANCE_RULES = {
    "completed_not_before_started": "completed_at is null or completed_at >= started_at",
}


def require_none(violations: DataFrame, label: str) -> None:
    """Fail closed when any violation exists (reads at most five rows)."""
    rows = violations.limit(5).collect()
    if rows:
        raise ValueError(f"{label}: {[r.asDict() for r in rows]}")
