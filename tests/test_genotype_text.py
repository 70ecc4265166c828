import pytest
from conftest import rows
from pyspark.sql import functions as F

from varloom.operators import qc
from varloom.sources import genotype_text as gt
from varloom.sources.lines import scan_lines

NORMAL = (
    "# synthetic\n# rsid\tchromosome\tposition\tgenotype\n# human assembly build GRCh37\n"
    "rs1\t1\t101\tAG\nrs2\t1\t202\tCC\nrs3\tX\t303\t--\n"
)


def scanned(spark, path, **kw):
    parsed = gt.scan(spark, path, **kw)
    return parsed, gt.observations(parsed)


def test_normal_file(spark, write):
    parsed, obs = scanned(spark, write("s1.txt", NORMAL))
    summary = qc.assay_qc(obs).first()
    assert summary["sample_id"].startswith("s1-")
    assert summary["parsed_record_count"] == 3 and summary["called_record_count"] == 2
    assert summary["call_rate"] == pytest.approx(2 / 3)
    one = qc.chromosome_qc(obs).where("source_chromosome = '1'").first()
    assert (one["record_count"], one["min_source_position"], one["max_source_position"]) == (2, 101, 202)
    meta = gt.source_metadata(parsed).first()
    assert (meta["resolved_build"], meta["build_provenance"]) == ("GRCh37", "vendor_declared")
    assert (meta["comment_line_count"], meta["physical_line_count"]) == (3, 6)
    assert [r[0] for r in rows(obs, "source_line_number")] == [4, 5, 6]


def test_bom_and_line_endings(spark, write):
    _, bom = scanned(spark, write("a/bom.txt", b"\xef\xbb\xbfrs9\t1\t5\tAA\n"))
    assert rows(bom, "source_marker_id", "source_line_number") == [("rs9", 1)]
    _, crlf = scanned(spark, write("b/crlf.txt", b"# c\r\n\r\nrs7\t2\t8\tCT\r\n"))
    assert rows(crlf, "source_marker_id", "raw_genotype", "source_line_number") == [("rs7", "CT", 3)]


def test_invalid_utf8_fails(spark, write):
    path = write("bad.txt", b"rs1\t1\t5\tA\xff\n")
    with pytest.raises(Exception, match="(?i)utf"):
        scan_lines(spark, path).collect()


def test_line_numbers_across_file_splits(spark, write):
    text = "".join(f"rs{i}\t1\t{i + 1}\tAA\n" for i in range(5000))
    path = write("split/big.txt", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = scan_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 1
        wrong = lines.where(
            F.concat(F.lit("rs"), (F.col("line_number") - 1).cast("string"))
            != F.split("value", "\t")[0]
        )
        assert lines.count() == 5000 and wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_duplicates(spark, write):
    _, exact = scanned(spark, write("d1.txt", "rs1\t1\t10\tAA\nrs1\t1\t10\tAA\n"))
    s = qc.assay_qc(exact).first()
    assert (s["duplicate_marker_id_count"], s["exact_duplicate_record_count"]) == (1, 1)
    assert s["conflicting_duplicate_marker_count"] == 0
    _, place = scanned(spark, write("d2.txt", "rs1\t1\t10\tAA\nrs2\t1\t10\tAG\n"))
    s = qc.assay_qc(place).first()
    assert (s["duplicate_marker_id_count"], s["duplicate_coordinate_count"]) == (0, 1)
    _, conflict = scanned(spark, write("d3.txt", "rs1\t1\t10\tAA\nrs1\t1\t11\tAG\n"))
    s = qc.assay_qc(conflict).first()
    assert s["conflicting_duplicate_marker_count"] == 1
    found = {r["code"] for r in qc.findings(conflict).collect()}
    assert found == {"CONFLICTING_DUPLICATE_MARKER", "DUPLICATE_MARKER_ID"}
    lists = qc.related_lines(conflict).first()
    assert lists["related_source_line_numbers"] == [1, 2]


def test_malformed_lenient_and_strict(spark, write):
    parsed, obs = scanned(spark, write("m1.txt", "rs1\t1\t10\nrs2\t1\t10\tAA\textra\n"))
    assert gt.malformed(parsed).count() == 2 and obs.count() == 0
    with pytest.raises(ValueError, match="line 1"):
        gt.require_well_formed(parsed)
    parsed, obs = scanned(spark, write("m2.txt", "rs0\t1\t5\tAA\nrs1\t1\tx\tAA\nrs2\t1\t1_0\tAA\n"))
    assert rows(gt.malformed(parsed), "source_line_number", "reason_code") == [
        (2, "INVALID_POSITION"),
        (3, "INVALID_POSITION"),
    ]
    assert obs.count() == 1
    with pytest.raises(ValueError, match="line 2"):
        gt.require_well_formed(parsed)


def test_unknown_build_and_override(spark, write):
    path = write("n.txt", "# nothing\nrs1\t1\t10\tAA\n")
    parsed, obs = scanned(spark, path)
    meta = gt.source_metadata(parsed)
    assert meta.first()["resolved_build"] == "UNKNOWN"
    codes = [r["code"] for r in qc.findings(obs, gt.malformed(parsed), meta).collect()]
    assert codes == ["BUILD_METADATA_ABSENT"]
    forced = gt.source_metadata(parsed, "GRCh38").first()
    assert (forced["resolved_build"], forced["build_provenance"]) == ("GRCh38", "user_override")
    assert gt.unsupported_builds(meta).count() == 1


def test_tokens_and_chromosomes(spark, write):
    text = "i100\tcontig_7\t10\tA\nrs2\t1\t20\tAGT\nrs3\tMT\t30\tNC\nrs4\t1\t19\tag\nrs5\t1\t40\tDI\n"
    parsed, obs = scanned(spark, write("t.txt", text))
    got = {r["source_marker_id"]: (r["lexical_category"], r["lexical_zygosity"]) for r in obs.collect()}
    assert got == {
        "i100": ("single_allele_token", None),
        "rs2": ("other_token", None),
        "rs3": ("no_call", None),
        "rs4": ("two_allele_token", "heterozygous_lexical"),
        "rs5": ("two_allele_token", None),
    }
    s = qc.assay_qc(obs, gt.malformed(parsed)).first()
    assert s["unrecognized_chromosome_token_count"] == 1
    assert s["out_of_order_record_count"] == 1
    assert s["malformed_record_count"] == 0


def test_empty_file(spark, write):
    parsed, obs = scanned(spark, write("e.txt", "# only\n\n"))
    assert obs.count() == 0
    meta = gt.source_metadata(parsed).first()
    assert (meta["comment_line_count"], meta["blank_line_count"], meta["data_line_count"]) == (1, 1, 0)


def test_order_lag_matches_plain_window_for_any_bucket_width(spark):
    df = spark.range(200).select(
        F.lit("s").alias("sample_id"),
        (F.col("id") % 3).cast("string").alias("source_chromosome"),
        F.col("id").alias("source_line_number"),
        F.pmod(F.col("id") * 37, F.lit(101)).alias("source_position"),
    )
    wide = rows(qc.out_of_order(df, width=100000))
    assert wide == rows(qc.out_of_order(df, width=7)) and wide


def test_equal_names_in_two_folders_stay_apart(spark, write, folder):
    write("a/genome.txt", "rs1\t1\t101\tAG\n")
    write("b/genome.txt", "rs1\t1\t101\tCC\n")
    _, obs = scanned(spark, [f"{folder}/a/genome.txt", f"{folder}/b/genome.txt"])
    assert obs.select("sample_id").distinct().count() == 2
    assert qc.findings(obs).where("code = 'CONFLICTING_DUPLICATE_MARKER'").count() == 0
    uris = [r[0] for r in scan_lines(spark, f"{folder}/a").select("source_uri").collect()]
    named = gt.scan(spark, f"{folder}/a", spark.createDataFrame([(uris[0], "p1")], "source_uri string, sample_id string"))
    assert {r["sample_id"] for r in named.collect()} == {"p1"}


def test_bundled_sources_are_numbered_on_their_own(spark, write, folder):
    write("b/one.txt", "\x1csource=a\nx\r\n\n  \rlast\n\x1csource=b\n\n")
    write("b/two.txt", "\x1csource=c\n\x1csource=a\nno newline at the end")
    found = scan_lines(spark, f"{folder}/b", bundled=True)
    assert found.dtypes == scan_lines(spark, f"{folder}/b").dtypes
    told = sorted((r["source_uri"].split("/b/")[1], r["line_number"], r["value"]) for r in found.collect())
    assert told == [
        ("one.txt/source=a", 1, "x"), ("one.txt/source=a", 2, ""), ("one.txt/source=a", 3, "  "), ("one.txt/source=a", 4, "last"),
        ("one.txt/source=b", 1, ""), ("two.txt/source=a", 1, "no newline at the end"),
    ]


def test_bundles_read_in_many_splits_lose_no_source(spark, write, folder):
    body = "".join(f"\x1csource=s{i}\n" + "".join(f"{i}-{j}\n" for j in range(1 + i % 40)) for i in range(500))
    write("c/all.txt", body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3001")
    try:
        found = {(r["source_uri"].rsplit("=", 1)[1], r["line_number"], r["value"]) for r in scan_lines(spark, f"{folder}/c", bundled=True).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {(f"s{i}", j + 1, f"{i}-{j}") for i in range(500) for j in range(1 + i % 40)}


def test_uploads_of_a_query_are_bundled(spark, tmp_path):
    import os

    from varloom.plans import suite_files as sf

    spark.range(3000).selectExpr(
        "id as l_orderkey", "1 as l_linenumber", "id % 50 as l_partkey", "id % 300 as l_suppkey", "1d as l_quantity",
        "1d as l_extendedprice", "0d as l_discount", "0d as l_tax", "timestamp '2000-01-01 00:00:00' as l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    path = sf._genotype_files(spark, str(tmp_path))
    names = [n for _, _, files in os.walk(path) for n in files if n.startswith("part-")]
    assert 0 < len(names) <= 20
    told = sf.genotype_text_metadata(spark, str(tmp_path)).collect()
    assert len(told) == 300 and {r["data_line_count"] for r in told} == {11} and {r["physical_line_count"] for r in told} == {13}
