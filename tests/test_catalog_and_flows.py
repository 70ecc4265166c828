import hashlib
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from varloom.operators import checks as ck, lookup as lu
from varloom.plans import catalog, flows, reports
from varloom.streaming import arrivals


def test_publish_verify_and_tamper(spark, folder):
    root = folder + "/run"
    tables = {
        "a": (spark.range(30, 0, -1).repartition(4), "id bigint, half double", ["id"]),
        "b": (spark.createDataFrame([], "x string"), "x int, m map<string,int>", []),
    }
    tables["a"] = (tables["a"][0].withColumn("half", F.col("id") / 2), *tables["a"][1:])
    tables["b"] = (tables["b"][0].withColumn("m", F.lit(None)), *tables["b"][1:])
    catalog.publish_run(spark, tables, root, file_bytes=160)
    assert catalog.verify_run(spark, root).count() == 0
    assert spark.read.parquet(root + "/b").dtypes == [("x", "int"), ("m", "map<string,int>")]
    files = sorted(f for f in os.listdir(root + "/a") if f.endswith(".parquet"))
    assert len(files) >= 3
    ends = [spark.read.parquet(f"{root}/a/{f}").agg(F.min("id"), F.max("id"), F.count("*")).first() for f in files]
    assert all(n <= 10 for _, _, n in ends)
    ends.sort()
    assert all(x[1] < y[0] for x, y in zip(ends, ends[1:]))
    told = {r.table_name: (r.row_count, r.column_types) for r in spark.read.parquet(f"{root}/{catalog.TABLES}").collect()}
    assert told == {"a": (30, "id bigint,half double"), "b": (0, "x int,m map<string,int>")}
    with pytest.raises(Exception, match="(?i)exist"):
        catalog.write_table(spark.range(1), root + "/a")
    with pytest.raises(ValueError, match="published once"):
        catalog.publish_run(spark, tables, root)
    with open(f"{root}/extra.txt", "w") as handle:
        handle.write("x")
    actual = catalog.inventory(spark, root)
    names = [r["artifact"] for r in actual.where("artifact like 'a/%.parquet'").orderBy("artifact").collect()]
    declared = spark.read.parquet(f"{root}/{catalog.MANIFEST}").withColumns(
        {
            "sha256": F.when(F.col("artifact") == names[0], F.lit("0")).when(F.col("artifact") != names[2], F.col("sha256")),
            "byte_size": F.when(F.col("artifact") == names[1], F.lit(1)).otherwise(F.col("byte_size")),
        }
    ).unionByName(spark.createDataFrame([("gone", "1", 1)], catalog.INVENTORY_SCHEMA))
    assert dict(rows(catalog.verify_run(spark, root))) == {"extra.txt": "undeclared"}
    assert dict(rows(catalog.artifact_mismatches(declared, actual))) == {
        names[0]: "checksum_mismatch",
        names[1]: "size_mismatch",
        names[2]: "not_digested",
        "extra.txt": "undeclared",
        "gone": "missing",
    }


def test_a_failed_publication_leaves_nothing(spark, folder):
    root = folder + "/run"
    bad = spark.range(3).withColumn("x", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        catalog.publish_run(spark, {"a": (spark.range(3), None, ["id"]), "b": (bad, None, [])}, root)
    assert not os.path.exists(root)
    flows.publish(spark, {"a": spark.range(3)}, root)
    assert catalog.verify_run(spark, root).count() == 0
    spark.range(2).write.mode("overwrite").parquet(root + "/a")
    assert ("a", "row_count_mismatch") in rows(catalog.verify_run(spark, root))


def test_files_too_long_to_digest_are_told(spark, write, monkeypatch):
    path = write("d/one.bin", b"hello")
    write("d/two.bin", b"hello hello")
    monkeypatch.setattr(catalog, "DIGEST_BYTES", 6)
    got = {r.uri.rsplit("/", 1)[1]: (r.sha256 is None, r.byte_size) for r in catalog.file_digests(spark, os.path.dirname(path)).collect()}
    assert got == {"one.bin": (False, 5), "two.bin": (True, 11)}


def test_digests(spark, write):
    path = write("d/one.bin", b"hello" * 1000)
    want = hashlib.sha256(b"hello" * 1000).hexdigest()
    row = catalog.file_digests(spark, os.path.dirname(path)).first()
    assert (row["sha256"], row["byte_size"]) == (want, 5000)


def test_import_is_idempotent(spark, write):
    path = write("in/a.txt", "same")
    write("in/b.txt", "same")
    digests = catalog.file_digests(spark, os.path.dirname(path))
    empty = spark.createDataFrame([], "sha256 string, byte_size bigint")
    fresh = catalog.new_sources(digests, empty, "subject-0001")
    assert fresh.count() == 1
    assert catalog.new_sources(digests, fresh, "subject-0001").count() == 0
    assert catalog.source_conflicts(digests, fresh.withColumn("byte_size", F.lit(1))).count() == 2


def test_run_catalog(spark, folder):
    path = folder + "/catalog"

    def entry(run, build):
        return spark.createDataFrame(
            [("M2", run, "subject-0001", "p/" + run, {"assembly": build})],
            "milestone string, run_id string, subject_id string, path string, constraints map<string,string>",
        )

    catalog.register(path, entry("r1", "GRCh37"))
    catalog.register(path, entry("r2", "GRCh38"))
    catalog.register(path, entry("r2", "GRCh38"))
    known = spark.read.parquet(path)
    assert known.count() == 2
    assert catalog.resolve_latest(known, "M2", {"assembly": "GRCh38"})["run_id"] == "r2"
    with pytest.raises(ValueError, match="other constraints"):
        catalog.resolve_latest(known, "M2", {"assembly": "GRCh37"})
    with pytest.raises(ValueError, match="holds no run"):
        catalog.resolve_latest(known, "M9", {})
    with pytest.raises(ValueError, match="other content"):
        catalog.register(path, entry("r2", "other"))
    assert catalog.run_id("M2", "a") == catalog.run_id("M2", "a") != catalog.run_id("M2", "b")


def test_stream_ingests_each_content_once(spark, folder, write):
    write("in/a.txt", "# build 37\nrs1\t1\t10\tAA\nrs2\t1\t5\tAG\n")
    write("in/copy.txt", "# build 37\nrs1\t1\t10\tAA\nrs2\t1\t5\tAG\n")
    target, mark = folder + "/out", folder + "/mark"
    arrivals.stream(spark, folder + "/in", target, mark).awaitTermination()
    write("in/b.txt", "rs1\t1\t10\tAA\n")
    write("in/again.txt", "# build 37\nrs1\t1\t10\tAA\nrs2\t1\t5\tAG\n")
    arrivals.stream(spark, folder + "/in", target, mark).awaitTermination()
    obs = spark.read.parquet(target + "/observations")
    assert obs.count() == 3
    assert spark.read.parquet(target + "/sources").count() == 2
    found = spark.read.parquet(target + "/findings")
    assert sorted(r["code"] for r in found.collect()) == ["BUILD_METADATA_ABSENT", "OUT_OF_ORDER_RECORD"]


def test_retried_batch_replaces_its_output(spark, folder, write):
    uri = write("in/a.txt", "rs1\t1\t10\tAA\n")
    for _ in range(2):
        arrivals.ingest_batch(spark, [uri], 0, folder + "/out")
    assert spark.read.parquet(folder + "/out/observations").count() == 1


def test_ingest_flow_and_report(spark, write):
    path = write("s.txt", "# build GRCh38\nrs1\t1\t10\tAA\nrs1\t1\t10\tAG\n")
    out = flows.ingest_genotype_text(spark, path)
    assert out["observations"].first()["source_build"] == "GRCh38"
    lines = [r["line"] for r in reports.qc_report(out["assay_qc"]).orderBy("ordinal").collect()]
    assert [x.split()[-1] for x in lines if x.startswith(("records read", "lines not", "share called"))] == ["2", "0", "1.000000"]
    bad = write("bad.txt", "rs1\t1\n")
    with pytest.raises(ValueError, match="line 1"):
        flows.ingest_genotype_text(spark, bad)
    assert flows.ingest_genotype_text(spark, bad, strict=False)["malformed_records"].count() == 1


EXTRACT = "marker_id string, chromosome string, position bigint, reference string, alternates array<string>"


def test_marker_resources(spark):
    markers = spark.createDataFrame(
        [("rs1", "1", 10), ("rs2", "1", 20), ("rs3", "1", 30), ("rs4", "2", 40), ("i5", "2", 50), ("rs6", "2", 60)],
        "marker_id string, chromosome string, position bigint",
    )
    common = spark.createDataFrame(
        [("rs1", "1", 10, "A", ["G", "T"]), ("rs2", "1", 99, "A", ["G"]), ("rs3", "1", 30, "A", ["G"]),
         ("rs3", "1", 30, "A", ["C"]), ("rs6", "2", 60, "AT", ["A"])],
        EXTRACT,
    )
    extra = spark.createDataFrame([("rs1", "1", 10, "A", ["C"]), ("rs4", "2", 40, "C", ["T"])], EXTRACT)
    target = spark.createDataFrame(
        [("rs1", "1", 110, "A", ["T"]), ("rs1", "1", 210, "A", ["G"]), ("rs4", "2", 140, "G", ["T"])], EXTRACT
    )
    out = flows.marker_resources(markers, [("common", common), ("clinvar", extra)], target, "GRCh37")
    assert dict(rows(out["tiers"])) == {
        "rs1": "common", "rs2": "common", "rs3": "common", "rs4": "clinvar", "i5": "unresolved", "rs6": "common",
    }
    assert rows(out["marker_definitions"], "marker_id", "alternate") == [("rs1", "G"), ("rs1", "T"), ("rs4", "T")]
    assert rows(out["liftover"], "pos0", "cand_pos0") == [(9, 109), (9, 209)]
    assert dict(rows(out["unresolved_markers"], "marker_id", "reason")) == {
        "rs2": "coordinate-incompatible", "rs3": "ambiguous", "rs6": "unsupported",
    }
    stats = dict(rows(out["statistics"]))
    assert stats["source_marker_count"] == 6 and stats["rsid_marker_count"] == 5
    assert stats["exact_source_placement_count"] == 3 and stats["ambiguous_marker_count"] == 1
    assert stats["unsupported_marker_count"] == 1 and stats["cross_build_mapped_marker_count"] == 1
    with pytest.raises(ValueError, match="coverage"):
        lu.require_coverage(out["statistics"])


def test_projection_bundle_validation(spark):
    loadings = spark.createDataFrame(
        [("m", "a", "GRCh38", "1", 1, "A", "G", "G", [1.0, 0.0]), ("m", "b", "GRCh38", "1", 2, "A", "G", "G", [0.0, 1.0])],
        "model_id string, model_variant_id string, assembly string, chromosome string, position bigint,"
        " reference string, alternate string, effect_allele string, loadings array<double>",
    )
    scores = spark.createDataFrame(
        [("s1", "g", [0.0, 1.0]), ("s2", "g", [2.0, 3.0])],
        "reference_sample_id string, reference_group_id string, scores array<double>",
    )
    groups = spark.createDataFrame([("g", 2)], "reference_group_id string, declared_sample_count int")
    parts = spark.createDataFrame(
        [(1, 1.0, 1.0), (2, 2.0, 1.0)], "component_index int, declared_mean double, declared_sd double"
    )
    assert flows.validate_projection_model(loadings, scores, groups, parts, 2, 1e-9).count() == 0
    bad = flows.validate_projection_model(
        loadings.withColumn("chromosome", F.lit("X")), scores.union(scores.limit(1)),
        groups.withColumn("declared_sample_count", F.lit(5)), parts, 2, 1e-9,
    )
    assert {r["check"] for r in bad.collect()} == {
        "unsupported_marker", "duplicate_sample", "group_count_mismatch", "score_summary",
    }


def test_require_none(spark):
    ck.require_none(spark.range(0), "x")
    with pytest.raises(ValueError, match="x"):
        ck.require_none(spark.range(1), "x")


def test_quality_control_of_a_batch_reads_the_written_tables(spark, write, folder, monkeypatch):
    read = []
    for name in ("assay_qc", "findings"):
        plain = getattr(arrivals.qc, name)

        def watched(*tables, plain=plain):
            read.extend(f for df in tables for f in df.inputFiles())
            return plain(*tables)

        monkeypatch.setattr(arrivals.qc, name, watched)
    path = write("late/a.txt", "rs1\t1\t5\tAA\nrs2\t1\t0\tAA\n")
    arrivals.ingest_batch(spark, [f"file:{path}"], 0, f"{folder}/out-qc")
    assert read and all("/out-qc/" in f for f in read)
    assert spark.read.parquet(f"{folder}/out-qc/assay_qc").first()["malformed_record_count"] == 1
