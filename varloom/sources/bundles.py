"""Model bundles: declared tables, permissive scans with one violation row per bad field, and validators.

A bundle is a folder with one Parquet table per name.  A table is read as it is; every declared column is cast row by row, and a
field that is missing, cannot be cast, is NULL where a value is required, or breaks its own rule gives one violation row.  A row
without violations is accepted.  Rules across rows and tables are the validators' and see all rows that were read, so that one bad
field does not make every row that refers to it a violation as well.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from varloom.functions.fixed import exact_number
from varloom.functions.tokens import is_autosome
from varloom.operators import checks as ck

VIOLATION = "table_name string, key string, field string, problem string"


@dataclass(frozen=True)
class Column:
    type: str
    required: bool = True
    #: SQL condition that a value has to meet, over the column's own name.
    rule: str | None = None


@dataclass(frozen=True)
class Table:
    #: Columns whose values name a row; rows are unique by them and published in their order.
    key: tuple[str, ...]
    columns: dict[str, Column]


_TEXT, _COUNT = Column("string"), Column("bigint", rule="{0} >= 0")
_ASSEMBLY = Column("string", rule="{0} = 'GRCh38'")
_CHROMOSOME = Column("string")
_POSITION = Column("bigint", rule="{0} > 0")
_BASES = Column("string", rule="{0} rlike '^[ACGT]+$'")
_BASE = Column("string", rule="{0} rlike '^[ACGT]$'")
_FINITE = Column("double", rule="not isnan({0}) and abs({0}) < double('inf')")
_VECTOR = Column("array<double>", rule="forall({0}, v -> v is not null and not isnan(v) and abs(v) < double('inf'))")
_SHA = Column("string", rule="length({0}) = 64")
_LINK = Column("string", rule="startswith({0}, 'https://')")
_SITE = {"assembly": _ASSEMBLY, "chromosome": _CHROMOSOME, "position": _POSITION}

#: Declared tables of every bundle kind.
BUNDLES = {
    "projection": {
        "variant_loadings": Table(
            ("model_variant_id",),
            {"model_variant_id": _TEXT, **_SITE, "reference": _BASE, "alternate": _BASE, "effect_allele": _BASE, "loadings": _VECTOR},
        ),
        "reference_scores": Table(("reference_sample_id",), {"reference_sample_id": _TEXT, "reference_group_id": _TEXT, "scores": _VECTOR}),
        "reference_groups": Table(("reference_group_id",), {"reference_group_id": _TEXT, "declared_sample_count": _COUNT}),
        "component_metadata": Table(
            ("component_index",),
            {"component_index": Column("bigint", rule="{0} >= 1"), "declared_mean": _FINITE, "declared_sd": _FINITE},
        ),
    },
    "score": {
        "models": Table(
            ("pgs_id",),
            {
                "pgs_id": _TEXT, "model_version": _TEXT, "assembly": _ASSEMBLY, "source_url": _LINK, "license": _TEXT,
                "declared_variant_count": _COUNT, "completeness_policy": _TEXT,
            },
        ),
        "model_variants": Table(
            ("pgs_id", "assembly", "chromosome", "position", "reference", "alternate"),
            {"pgs_id": _TEXT, **_SITE, "reference": _BASE, "alternate": _BASE, "effect_allele": _BASE, "effect_weight": _TEXT},
        ),
        "model_exclusions": Table(("pgs_id", "source_row"), {"pgs_id": _TEXT, "source_row": _TEXT, "reason": _TEXT}),
    },
    "pharmacogene": {
        "sources": Table(
            ("source_id",),
            {"source_id": _TEXT, "version": _TEXT, "url": _LINK, "sha256": _SHA, "license": _TEXT, "content_fingerprint": _TEXT},
        ),
        "genes": Table(
            ("gene_id",),
            {
                "gene_id": _TEXT,
                "strategy": Column(
                    "string", rule="{0} in ('star_haplotype_small_variant', 'single_locus_genotype', 'external_validated_call_required')"
                ),
            },
        ),
        "loci": Table(("locus_id",), {"locus_id": _TEXT, "gene_id": _TEXT, **_SITE, "reference": _BASES, "alternate": _BASES}),
        "alleles": Table(
            ("allele_id",),
            {"allele_id": _TEXT, "gene_id": _TEXT, "status": _TEXT, "source_id": _TEXT, "source_version": _TEXT},
        ),
        "allele_locus_constraints": Table(
            ("allele_id", "locus_id"),
            {
                "allele_id": _TEXT,
                "locus_id": _TEXT,
                "state": Column(
                    "string",
                    rule="{0} in ('required_reference', 'required_alternate', 'not_constraining', 'unsupported_structural_requirement')",
                ),
            },
        ),
        "diplotype_phenotype_rules": Table(
            ("rule_id",),
            {
                "rule_id": _TEXT, "gene_id": _TEXT, "allele_a": _TEXT, "allele_b": _TEXT, "source_id": _TEXT, "source_version": _TEXT,
                "historical_mapping": Column("boolean", required=False),
            },
        ),
    },
}


def scan_table(rows: DataFrame, name: str, table: Table) -> tuple[DataFrame, DataFrame]:
    """(rows under the declared types, violations): rows carry ``accepted``; other columns are left out."""
    raw = {c.lower(): c for c in rows.columns}
    typed, tests = {}, {}
    for field, column in table.columns.items():
        source = F.col(f"`{raw[field.lower()]}`") if field.lower() in raw else F.lit(None)
        value = source.try_cast(column.type)
        typed[field] = value
        rule = F.expr(column.rule.format(f"t.{field}")) if column.rule else F.lit(True)
        tests[field] = (
            F.when(source.isNotNull() & value.isNull(), "type")
            .when(value.isNull() & F.lit(column.required), "null")
            .when(F.col(f"t.{field}").isNotNull() & ~F.coalesce(rule, F.lit(False)), "rule")
        )
    absent = [f for f, c in table.columns.items() if c.required and f.lower() not in raw]
    found = rows.withColumn("t", F.struct(*[v.alias(f) for f, v in typed.items()]))
    problems = [F.when(p.isNotNull(), F.struct(F.lit(f).alias("field"), p.alias("problem"))) for f, p in tests.items() if f not in absent]
    found = found.select("t", F.array_compact(F.array(*problems)).alias("bad")).select("t.*", "bad")
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in table.key])
    violations = found.select(F.lit(name).alias("table_name"), key.alias("key"), F.explode("bad").alias("b")).select(
        "table_name", "key", "b.field", "b.problem"
    )
    if absent:  # one row per missing column, not one per row of the table
        missing = rows.sparkSession.createDataFrame([(name, "", f, "column_missing") for f in absent], VIOLATION)
        violations = violations.unionByName(missing)
    accepted = (F.size("bad") == 0) & F.lit(not absent)
    return found.withColumn("accepted", accepted).drop("bad"), violations


def scan_bundle(spark: SparkSession, root: str, kind: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables of a bundle folder, and the violations of their fields; a table that is not there is one violation and empty."""
    from varloom.plans.catalog import _exists

    tables, found = {}, []
    for name, table in BUNDLES[kind].items():
        if _exists(spark, f"{root}/{name}"):
            rows, violations = scan_table(spark.read.parquet(f"{root}/{name}"), name, table)
        else:
            schema = ", ".join(f"{f} {c.type}" for f, c in table.columns.items())
            rows = spark.createDataFrame([], schema).withColumn("accepted", F.lit(True))
            violations = spark.createDataFrame([(name, "", "", "table_missing")], VIOLATION)
        tables[name] = rows
        found.append(violations)
    return tables, ck.union(*found)


def _row(name: str, rows: DataFrame, key, field: str, problem: str) -> DataFrame:
    return rows.select(
        F.lit(name).alias("table_name"), key.cast("string").alias("key"), F.lit(field).alias("field"), F.lit(problem).alias("problem")
    )


def _keys(kind: str, tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Repeated keys of every table."""
    found = []
    for name, table in BUNDLES[kind].items():
        repeated = tables[name].groupBy(*table.key).count().where("count > 1")
        found.append(_row(name, repeated, F.concat_ws("|", *table.key), "", "duplicate_key"))
    return found


def _orphans(name: str, rows: DataFrame, key: str, field: str, parents: DataFrame, parent: str) -> DataFrame:
    """Rows whose ``field`` names no row of ``parents``; a NULL is a field violation, not an orphan."""
    known = parents.select(F.col(parent).alias(field)).distinct()
    lost = rows.where(F.col(field).isNotNull()).join(known, field, "left_anti")
    return _row(name, lost, F.col(key), field, "unknown_parent")


def validate_pharmacogene_bundle(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations across the rows and tables of a scanned pharmacogene bundle."""
    genes, loci, alleles = tables["genes"], tables["loci"], tables["alleles"]
    constraints, rules, sources = tables["allele_locus_constraints"], tables["diplotype_phenotype_rules"], tables["sources"]
    scope = is_autosome(F.col("chromosome")) & (F.col("reference") != F.col("alternate"))
    broken = ck.pgx_rule_violations(genes, alleles, constraints, rules)
    # versions of one source inside one gene, over everything that cites it
    cited = alleles.select("gene_id", "source_id", "source_version").unionByName(rules.select("gene_id", "source_id", "source_version"))
    mixed = ck.mixed_releases(cited.where("source_version is not null"))
    pair = F.concat_ws("|", "allele_id", "locus_id")
    return ck.union(
        *_keys("pharmacogene", tables),
        _orphans("loci", loci, "locus_id", "gene_id", genes, "gene_id"),
        _orphans("alleles", alleles, "allele_id", "gene_id", genes, "gene_id"),
        _orphans("alleles", alleles, "allele_id", "source_id", sources, "source_id"),
        _orphans("diplotype_phenotype_rules", rules, "rule_id", "source_id", sources, "source_id"),
        _orphans("diplotype_phenotype_rules", rules, "rule_id", "allele_a", alleles, "allele_id"),
        _orphans("diplotype_phenotype_rules", rules, "rule_id", "allele_b", alleles, "allele_id"),
        _orphans("allele_locus_constraints", constraints.withColumn("pair", pair), "pair", "allele_id", alleles, "allele_id"),
        _orphans("allele_locus_constraints", constraints.withColumn("pair", pair), "pair", "locus_id", loci, "locus_id"),
        _row("loci", loci.where(~F.coalesce(scope, F.lit(False))), F.col("locus_id"), "chromosome", "unsupported_site"),
        broken.select(
            F.when(F.col("rule") == "retired_allele_rule", "diplotype_phenotype_rules").otherwise("alleles").alias("table_name"),
            "key", F.lit("").alias("field"), F.col("rule").alias("problem"),
        ),
        _row("sources", mixed, F.concat_ws("|", "gene_id", "source_id"), "source_version", "mixed_releases"),
    )


def validate_score_bundle(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations across the rows and tables of a scanned score bundle."""
    models, variants, excluded = tables["models"], tables["model_variants"], tables["model_exclusions"]
    key = F.concat_ws("|", *BUNDLES["score"]["model_variants"].key)
    variants = variants.withColumn("site", key)
    scope = is_autosome(F.col("chromosome")) & (F.col("reference") != F.col("alternate"))
    effect = F.col("effect_allele").isin(F.col("reference"), F.col("alternate"))
    # rows without a model are no part of any count
    prepared = variants.select("pgs_id").unionByName(excluded.select("pgs_id")).where("pgs_id is not null")
    declared = models.groupBy("pgs_id").agg(F.max("declared_variant_count").alias("declared"))
    counts = ck.count_mismatches(declared, prepared, ["pgs_id"]).join(models.select("pgs_id"), "pgs_id", "left_semi")
    return ck.union(
        *_keys("score", tables),
        _orphans("model_variants", variants, "site", "pgs_id", models, "pgs_id"),
        _row("model_variants", variants.where(~F.coalesce(scope, F.lit(False))), F.col("site"), "chromosome", "unsupported_site"),
        _row("model_variants", variants.where(~effect), F.col("site"), "effect_allele", "not_an_allele"),
        _row(
            "model_variants",
            variants.where(F.col("effect_weight").isNotNull() & exact_number(F.col("effect_weight")).isNull()),
            F.col("site"), "effect_weight", "no_exact_number",
        ),
        _row("models", counts, F.col("pgs_id"), "declared_variant_count", "count_mismatch"),
    )


def validate_projection_bundle(tables: dict[str, DataFrame], components: int, tolerance: float) -> DataFrame:
    """Violations across the rows and tables of a scanned projection bundle of one model with ``components`` components."""
    loadings, scores = tables["variant_loadings"], tables["reference_scores"]
    groups, declared = tables["reference_groups"], tables["component_metadata"]
    scope = is_autosome(F.col("chromosome")) & (F.col("reference") != F.col("alternate")) & (F.col("effect_allele") == F.col("alternate"))
    counts = ck.count_mismatches(
        groups.select("reference_group_id", F.col("declared_sample_count").alias("declared")), scores, ["reference_group_id"]
    ).join(groups.select("reference_group_id"), "reference_group_id", "left_semi")
    short = F.size("loadings") != components
    whole = loadings.where("accepted").where(~short).withColumn("model_id", F.lit("bundle"))
    sites = loadings.groupBy("assembly", "chromosome", "position", "reference", "alternate").agg(
        F.count("*").alias("n"), F.min("model_variant_id").alias("first")
    )
    return ck.union(
        *_keys("projection", tables),
        _row("variant_loadings", sites.where("n > 1"), F.col("first"), "position", "duplicate_site"),
        _row("variant_loadings", loadings.where(~F.coalesce(scope, F.lit(False))), F.col("model_variant_id"), "chromosome", "unsupported_site"),
        _row("variant_loadings", loadings.where(short), F.col("model_variant_id"), "loadings", "vector_length"),
        _row("reference_scores", scores.where(F.size("scores") != components), F.col("reference_sample_id"), "scores", "vector_length"),
        _orphans("reference_scores", scores, "reference_sample_id", "reference_group_id", groups, "reference_group_id"),
        _row("reference_groups", counts, F.col("reference_group_id"), "declared_sample_count", "count_mismatch"),
        _row(
            "variant_loadings", ck.gram_violations(whole, tolerance), F.concat_ws(",", F.col("row") + 1, F.col("column") + 1),
            "loadings", "not_orthonormal",
        ),
        _row(
            "component_metadata",
            ck.summary_mismatches(scores.where("accepted").where(F.size("scores") == components), declared, tolerance),
            F.col("component_index"), "declared_mean", "summary_mismatch",
        ),
    )


def validated(spark: SparkSession, root: str, kind: str, across) -> DataFrame:
    """All violations of a bundle folder: of its fields, and those that ``across`` finds between rows and tables."""
    tables, fields = scan_bundle(spark, root, kind)
    return fields.unionByName(across(tables))
