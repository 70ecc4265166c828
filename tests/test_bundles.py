"""Bundle scans: one violation row per bad field, whatever the file holds."""

from conftest import rows

from varloom.sources import bundles as b


def test_each_bad_field_is_one_row(spark):
    table = b.BUNDLES["pharmacogene"]["loci"]
    data = [
        ("L1", "G1", "GRCh38", "1", "10", "A", "C", "extra"),
        ("L2", None, "GRCh37", "1", "ten", "A", "c", "extra"),
        (None, "G1", "GRCh38", "1", "0", "A", "", "extra"),
        ("L4", "G1", "GRCh38", None, None, None, "C", None),
    ]
    names = "LOCUS_ID string, gene_id string, assembly string, chromosome string, position string, reference string, alternate string, other string"
    typed, violations = b.scan_table(spark.createDataFrame(data, names), "loci", table)
    assert rows(violations, "key", "field", "problem") == sorted(
        [
            ("L2", "gene_id", "null"), ("L2", "assembly", "rule"), ("L2", "position", "type"), ("L2", "alternate", "rule"),
            ("", "locus_id", "null"), ("", "position", "rule"), ("", "alternate", "rule"),
            ("L4", "chromosome", "null"), ("L4", "position", "null"), ("L4", "reference", "null"),
        ],
        key=repr,
    )
    assert [r.locus_id for r in typed.where("accepted").collect()] == ["L1"]
    assert dict(typed.dtypes)["position"] == "bigint" and "other" not in typed.columns and typed.count() == 4


def test_missing_columns_and_tables_are_told_once(spark, folder):
    lost = spark.createDataFrame([("g1",), ("g2",)], "gene_id string")
    typed, violations = b.scan_table(lost, "genes", b.BUNDLES["pharmacogene"]["genes"])
    assert rows(violations) == [("genes", "", "strategy", "column_missing")]
    assert typed.where("accepted").count() == 0 and typed.count() == 2
    tables, found = b.scan_bundle(spark, folder + "/none", "score")
    assert rows(found, "table_name", "problem") == [(n, "table_missing") for n in sorted(b.BUNDLES["score"])]
    assert b.validate_score_bundle(tables).count() == 0
    assert all(t.count() == 0 for t in tables.values())


def test_vectors_and_optional_fields(spark):
    table = b.BUNDLES["projection"]["reference_scores"]
    data = [("a", "g", [1.0, 2.0]), ("b", "g", [1.0, None]), ("c", "g", [float("nan")]), ("d", "g", [float("inf")]), ("e", "g", None)]
    _, violations = b.scan_table(
        spark.createDataFrame(data, "reference_sample_id string, reference_group_id string, scores array<double>"), "reference_scores", table
    )
    assert rows(violations, "key", "problem") == [("b", "rule"), ("c", "rule"), ("d", "rule"), ("e", "null")]
    rule = b.BUNDLES["pharmacogene"]["diplotype_phenotype_rules"]
    without = spark.createDataFrame([("r", "g", "a", "b", "s", "v")], "rule_id string, gene_id string, allele_a string, allele_b string, source_id string, source_version string")
    typed, violations = b.scan_table(without, "rules", rule)
    assert violations.count() == 0 and typed.first().historical_mapping is None and typed.first().accepted


def test_repeated_keys_and_lost_parents(spark):
    empty, _ = b.scan_bundle(spark, "/nowhere/at/all", "score")
    models = spark.createDataFrame([("p", 2), ("p", 2), ("q", 5)], "pgs_id string, declared_variant_count long")
    site = ("GRCh38", "1", 5, "A", "C")
    variants = spark.createDataFrame(
        [("p", *site, "A", "1"), ("p", *site, "C", "x"), ("z", *site, "G", "1"), (None, *site, "A", "2")],
        "pgs_id string, assembly string, chromosome string, position long, reference string, alternate string, effect_allele string, effect_weight string",
    )
    found = b.validate_score_bundle({**empty, "models": models, "model_variants": variants})
    key = "GRCh38|1|5|A|C"
    assert rows(found) == sorted(
        [
            ("models", "p", "", "duplicate_key"),
            ("model_variants", "p|" + key, "", "duplicate_key"),
            ("model_variants", "z|" + key, "pgs_id", "unknown_parent"),
            ("model_variants", "z|" + key, "effect_allele", "not_an_allele"),
            ("model_variants", "p|" + key, "effect_weight", "no_exact_number"),
            ("models", "q", "declared_variant_count", "count_mismatch"),
        ],
        key=repr,
    )
