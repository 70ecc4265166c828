import json

import pytest
from conftest import rows

from varloom import vocab
from varloom.operators import normalize as nz
from varloom.sources import reference_files as rf


def test_fasta_tiles_wrapped_lines(spark, write):
    path = write("ref.fa", ">chr1 first\nACGT\nacgtAC\n>X\nTTTTT\n")
    for width in (3, 4, 100):
        tiles = rf.fasta_tiles(spark, path, width)
        text = {}
        for r in sorted(tiles.collect(), key=lambda r: (r["contig"], r["tile"])):
            text[r["contig"]] = text.get(r["contig"], "") + r["bases"]
        assert text == {"1": "ACGTACGTAC", "X": "TTTTT"}
        asked = spark.createDataFrame(
            [("1", 1, 3), ("1", 4, 4), ("1", 9, 2), ("1", 9, 3), ("X", 5, 1), ("2", 1, 1), ("1", 0, 1)],
            "c string, p bigint, n int",
        )
        from pyspark.sql import functions as F

        got = nz.reference_bases(asked, tiles, width, "c", "p", F.col("n"))
        assert {(r["c"], r["p"], r["n"]): r["bases"] for r in got.collect()} == {
            ("1", 1, 3): "ACG",
            ("1", 4, 4): "TACG",
            ("1", 9, 2): "AC",
            ("1", 9, 3): None,
            ("X", 5, 1): "T",
            ("2", 1, 1): None,
            ("1", 0, 1): None,
        }


def test_liftover_and_markers(spark, write):
    lift = write("l.json", json.dumps({"chr1:99": [["1", 199]], "2:5": [["2", 7], ["chrM", 9]]}))
    assert rows(rf.liftover_json(spark, lift)) == [
        ("1", 99, "1", 199),
        ("2", 5, "2", 7),
        ("2", 5, "MT", 9),
    ]
    markers = [
        dict(marker_id="rs1", assembly="37", chromosome="1", position=5, reference="A", alternate="G", orientation="none")
    ]
    one = rf.marker_json(spark, write("m.json", json.dumps(markers))).first()
    assert one["orientation_authoritative"] is False and one["rsid"] is None


def test_bed_extract(spark, write):
    text = "chr1\t9\t10\trs1\ta\t2\tG,T,\nchr1\t9\t9\trs2\tA\t1\tG,\nchr1\t1\t2\trs3\tA\t2\tG,\nchr1\t1\n"
    got = rf.bed_extract(spark, write("x.bed", text)).collect()
    good = [r for r in got if r["violation"] is None]
    assert [(r["marker_id"], r["position"], r["alternates"], r["reference"]) for r in good] == [
        ("rs1", 10, ["G", "T"], "A")
    ]
    assert sorted(r["violation"] for r in got if r["violation"]) == [
        "INCOHERENT_ROW",
        "INCOHERENT_ROW",
        "INVALID_COLUMN_COUNT",
    ]


def test_phasing_sites_and_map(spark, write):
    sites = rf.phasing_sites(
        spark, write("s.tsv", "#h\n1\t5\tA\tG\t1\t10\n1\t4\tA\tG\t1\t10\n1\t9\tA\tA\t1\t2\n1\t9\tA\n")
    )
    assert {r["line_number"]: r["violation"] for r in sites.collect()} == {
        2: None,
        3: None,
        4: "INVALID_ALLELE_OR_COUNT",
        5: "INVALID_COLUMN_COUNT",
    }
    bad = rf.site_order_violations(sites.where("violation is null"))
    assert rows(bad, "line_number") == [(3,)]
    assert rf.genetic_map_violations(rf.genetic_map(spark, write("ok.map", "1 0.0\n5 0.1\n9 0.1\n"))).count() == 0
    broken = rf.genetic_map_violations(rf.genetic_map(spark, write("bad.map", "5 0.2\n3 0.3\n9 0.1\n")))
    assert {r["rule"] for r in broken.collect()} == {"position_not_sorted", "cm_decreasing"}
    short = rf.genetic_map_violations(rf.genetic_map(spark, write("few.map", "5 0.2\n")))
    assert {r["rule"] for r in short.collect()} == {"fewer_than_two_points"}


def test_policy(spark, write):
    assert rf.load_policy(spark, write("p.json", json.dumps(vocab.DEFAULT_POLICY))) == vocab.DEFAULT_POLICY
    changes = {
        "term_in_two_routes": lambda p: p["term_routes"]["uncertain"].append(" PATHOGENIC "),
        "gone_records_active": lambda p: p["record_status_behavior"].update(deleted="active"),
        "record_behaviours": lambda p: p["record_status_behavior"].update(unknown="maybe"),
        "record_statuses": lambda p: p["record_status_behavior"].pop("unknown"),
        "version_parts": lambda p: p.update(version="1.x.0"),
        "schema_version": lambda p: p.update(schema_version=2),
        "fields": lambda p: p.update(more=1),
        "routes": lambda p: p["term_routes"].pop("uncertain"),
        "type_handling": lambda p: p["classification_type_handling"].update(germline="context_only"),
        "priority_rules": lambda p: p["priority_rules"].append(p["priority_rules"][0]),
        "review_levels": lambda p: p["source_review_status_mappings"].update(x="no such level"),
        "last_tie_breaker": lambda p: p["tie_breaking"].append("other"),
        "bands": lambda p: p["priority_rules"][0].update(band="no such band"),
    }
    documents = []
    for rule, change in changes.items():
        policy = json.loads(json.dumps(vocab.DEFAULT_POLICY))
        change(policy)
        documents.append((rule, json.dumps(policy)))
    got = rf.policy_violations(spark.createDataFrame(documents, "policy string, document string"))
    assert rows(got) == sorted((rule, rule) for rule in changes)
    with pytest.raises(ValueError, match="last_tie_breaker"):
        rf.load_policy(spark, write("bad.json", documents[-2][1]))


def test_pedigree_descriptor(spark, write):
    doc = {
        "schema": "s",
        "family_id": "f1",
        "members": [
            {"member_id": "c", "subject_id": "subject-0001", "m2_run": "r1"},
            {"member_id": "p", "subject_id": "subject-2", "m2_run": "r2"},
        ],
        "relationships": [
            {"assertion_id": "e", "parent_member_id": "p", "child_member_id": "c", "source": "guess"}
        ],
    }
    members, edges, bad = rf.pedigree_json(spark, write("ped.json", json.dumps(doc)))
    assert [r["member_id"] for r in members.collect()] == ["c", "p"]
    assert edges.count() == 1
    assert {(r["rule"], r["key"]) for r in bad.collect()} == {
        ("member_pattern", "p"),
        ("relationship_source", "e"),
    }


def test_typed_parquet(spark, folder):
    spark.range(3).write.parquet(folder + "/t")
    assert rf.typed_parquet(spark, folder + "/t", "id bigint").count() == 3
    with pytest.raises(ValueError, match="of another type"):
        rf.typed_parquet(spark, folder + "/t", "id string")
    with pytest.raises(ValueError, match="of another type"):
        rf.typed_parquet(spark, folder + "/t", "other bigint")
