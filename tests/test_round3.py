"""Findings of round 3: queries read and shuffle what they need once."""

import hashlib
import os

import numpy as np

import __spark_entry__ as contract
from varloom.operators import neighbors as nb, review as rv
from varloom.plans import catalog, suite_files
from varloom.sources.lines import MEMBER

SMALL = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_nearest_samples_asks_for_every_row(spark):
    rows = contract.queries()["nearest_samples"](spark, SMALL).collect()
    ids = [r["vec_id"] for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert {r["query_id"] for r in rows} == set(ids)


def test_candidates_hold_the_nearest():
    rng = np.random.default_rng(3)
    u = np.vstack([rng.normal(size=(200, 8)), np.zeros((3, 8)) + 1e8, [[np.nan] * 8]])
    q = np.vstack([rng.normal(size=(5, 8)), u[200:201], [[np.inf] * 8]])
    row, at = nb._candidates(q, u, 4)
    for i in range(len(q)):
        far = np.sqrt(((q[i] - u) ** 2).sum(axis=1))
        assert set(np.argsort(far, kind="stable")[:4]) <= set(at[row == i])
    # few pairs of an ordinary query are left for exact distances
    assert max(np.bincount(row)[:5]) < 12


def test_archives_are_parsed_once_per_use(spark):
    plan = _plan(contract.queries()["vcv_representations"](spark, SMALL))
    assert plan.count("from_xml(") == 1


def test_rationales_filter_rows_not_arrays(spark):
    assert "lambda" not in _plan(contract.queries()["rationales"](spark, SMALL))


def test_queue_stores_only_what_it_shows(spark):
    files = contract.queries()["review_queue"](spark, SMALL).inputFiles()
    held = set(spark.read.parquet(*files).columns)
    assert "queue_position" not in held and not {"candidate_id", "profile_id", "any_high"} & held


def test_midranks_and_findings_read_stored_rows(spark):
    for name in ("pgs_reference_midrank", "qc_findings"):
        files = contract.queries()[name](spark, SMALL).inputFiles()
        assert files and not any("lineitem" in f for f in files), name


def test_products_are_made_per_variant(spark):
    assert "twice" in _plan(contract.queries()["pgs_alignment"](spark, SMALL))
    assert "LeftSemi" not in _plan(contract.queries()["pgs_scores"](spark, SMALL))


def test_ids_travel_as_digests(spark):
    ids = ["rationale-" + "0a" * 32, "f" * 64, "p1", "", "x-" + "AB" * 32, None, "a\nb-" + "9" * 64]
    df = spark.createDataFrame([(n, i) for n, i in enumerate(ids)], "n int, id string")
    packed = rv._packed_id(df, "id")
    assert packed.where("n = 0").first()["_digest"] == bytes([10]) * 32
    assert {r["n"]: r["id"] for r in rv._whole_id(packed, "id").collect()} == dict(enumerate(ids))
    assert "_digest" in _plan(contract.queries()["rationale_genotypes"](spark, SMALL))


def test_bundled_artifacts_have_the_digests_of_their_bytes(spark, write, folder):
    contents = {"a": b"one\n", "b": b"", "c": "zwei\r\nZeilen \u00e4\n\n".encode(), "d": b"no end"}
    write("run/part-0", b"".join(MEMBER.encode() + n.encode() + b"\n" + contents[n] for n in "abc"))
    write("run/part-1", MEMBER.encode() + b"d\n" + contents["d"])
    got = {r["artifact"]: (r["sha256"], r["byte_size"]) for r in catalog.inventory(spark, f"{folder}/run", bundled=True).collect()}
    names = {"a": "part-0/a", "b": "part-0/b", "c": "part-0/c", "d": "part-1/d"}
    assert got == {names[n]: (hashlib.sha256(c).hexdigest(), len(c)) for n, c in contents.items()}


def test_artifacts_are_no_folder_each(spark, folder, monkeypatch):
    root = f"{folder}/run"
    monkeypatch.setattr(suite_files, "_fresh", lambda spark, name: root)
    rows = {(r["artifact"], r["problem"]) for r in suite_files.artifact_inventory(spark, SMALL).collect()}
    assert len([f for f in os.listdir(root) if f.startswith("part")]) <= 16 and not [f for f in os.listdir(root) if "=" in f]
    assert ("file-3", "missing") in rows and ("file-1000006", "undeclared") in rows
