"""Findings of round 4: whole jobs, and what is shuffled and stored for them."""

import hashlib
import os
import re

import numpy as np
import pytest
from conftest import rows

import __spark_entry__ as contract
from varloom.operators import neighbors as nb, pgx, projection as pj, qc, review as rv
from varloom.plans import reports, suite_files
from varloom.plans.driver_views import view
from varloom.sources.lines import source_sample

SMALL = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _vectors(spark, rows, id_name, vector):
    schema = f"{id_name} {'string' if id_name == 'reference_sample_id' else 'long'}, reference_group_id string, {vector} array<double>"
    return spark.createDataFrame([(i, f"g{n % 3}", [float(x) for x in v]) for n, (i, v) in enumerate(rows)], schema)


def test_nearest_of_all_rows_against_all_rows(spark):
    """Every row is a query, also ids that 20 does not divide; what its own cell rules out is no answer."""
    rng = np.random.default_rng(11)
    at = rng.normal(size=(300, 3))
    refs = _vectors(spark, [(f"r{i:03}", v) for i, v in enumerate(at)], "reference_sample_id", "scores")
    points = _vectors(spark, list(enumerate(at)), "query_id", "coordinates").drop("reference_group_id")
    got = {}
    for r in nb.nearest(points, refs, 4, 40).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.reference_sample_id, r.distance)
    scaled = at / at.std(axis=0)
    assert set(got) == set(range(300))
    for i in range(300):
        far = np.sqrt(((scaled[i] - scaled) ** 2).sum(axis=1))
        assert [got[i][k + 1][1] for k in range(4)] == pytest.approx(np.sort(far)[:4])
        assert [far[int(got[i][k + 1][0][1:])] for k in range(4)] == pytest.approx(np.sort(far)[:4])


def test_nearest_samples_sql_has_no_cut():
    assert "%20" not in contract.oracle_sql()["nearest_samples"]


CALL = "sample_id string, variant_id string, call_count long, valid_low int, valid_high int"


def _joined(calls, loadings, requests):
    """The rows by the plain joins."""
    out = []
    for sample, model in requests:
        for m, mv, v, c in loadings:
            if m is None or m != model:
                continue
            found = [x for x in calls if None not in (x[0], x[1], v) and x[:2] == (sample, v)] or [(sample, v, None, None, None)]
            for _, _, n, low, high in found:
                kind = "missing" if not n else "excluded" if low is None else "discordant" if high is not None and low != high else "used"
                why = {"missing": "model_marker_absent", "excluded": "invalid_alleles", "discordant": "discordant_calls"}.get(kind)
                out.append((sample, model, mv, v, c, kind, why, low if kind == "used" else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [(16_384, 2_000), (2, 1)])
def test_marker_alignment_sends_calls_not_pairs(spark, monkeypatch, sizes):
    """Same rows as plain joins with repeated and NULL keys, in blocks of any size; requests x markers rows are no join's left side."""
    monkeypatch.setattr(pj, "MARKERS", sizes[0])
    monkeypatch.setattr(pj, "REQUESTS", sizes[1])
    calls = [
        ("a", "v1", 1, 2, 2), ("a", "v2", 2, 0, 1), ("a", "v3", 1, None, None), ("a", "v4", 0, None, None), ("b", "v1", 1, 0, 0),
        ("b", None, 1, 1, 1), (None, "v1", 1, 1, 1), ("c", "v9", 1, 1, 1), ("b", "v5", None, None, None),
    ]
    loadings = [("m", f"mv{i}", f"v{i}", str(i % 3)) for i in range(1, 8)]
    loadings += [("m", "mv1", "v1", "1"), ("m", "mv1b", "v1", None), ("m", None, None, "2"), ("n", "mv1", "v1", "1"), (None, "mv1", "v1", "1")]
    requests = [("a", "m"), ("a", "m"), ("a", "n"), ("b", "m"), ("c", "m"), (None, "m"), ("d", "x"), ("e", None)]
    out = pj.marker_alignment(
        spark.createDataFrame(calls, CALL),
        spark.createDataFrame(loadings, "model_id string, model_variant_id string, variant_id string, chromosome string"),
        spark.createDataFrame(requests, "sample_id string, model_id string"),
    )
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == _joined(calls, loadings, requests)
    # rows of pairs come from the last step of all: nothing is joined or sorted above it
    plan = _plan(out)
    assert "array_except" in plan and plan.index("explode(transform(array_except") < plan.index("Join")


LINE = "sample_id string, source_marker_id string, source_chromosome string, source_position long, raw_genotype string, source_line_number long"


def test_finding_lines_of_repeated_and_unknown_keys(spark):
    rows = [
        ("a", "r1", "1", 10, "AA", 1), ("a", "r1", "1", 10, "AA", 2), ("a", "r1", "1", 10, "AC", 3), ("a", "r2", "1", 10, "AA", 4),
        ("a", "r3", None, 5, "AA", 5), ("a", "r3", None, 5, "AA", 6), ("a", None, "2", 7, "AA", 7), ("a", None, "2", 7, "AA", 8),
        (None, "r1", "1", 10, "AA", 9), (None, "r1", "1", 10, "AA", 10), ("b", "r1", "1", 10, "AA", 11),
    ]
    out = qc.finding_lines(spark.createDataFrame(rows, LINE))
    got = {}
    for r in out.collect():
        got.setdefault((r.sample_id, r.code, *[r[c] for c in qc.RECORD]), []).append(r.source_line_number)
    assert {k: sorted(v) for k, v in got.items()} == {
        ("a", "CONFLICTING_DUPLICATE_MARKER", "r1", None, None, None): [1, 2, 3],
        ("a", "DUPLICATE_MARKER_ID", "r1", None, None, None): [1, 2, 3],
        ("a", "DUPLICATE_MARKER_ID", "r3", None, None, None): [5, 6],
        ("a", "EXACT_DUPLICATE_RECORD", "r1", "1", "10", "AA"): [1, 2],
        ("a", "DUPLICATE_COORDINATE", None, "1", "10", None): [1, 2, 3, 4],
        ("a", "DUPLICATE_COORDINATE", None, "2", "7", None): [7, 8],
    }


def test_findings_see_lines_that_share_a_key(spark):
    for name in ("qc_finding_lines", "qc_related_lines"):
        df = contract.queries()[name](spark, SMALL)
        files = df.inputFiles()
        assert files and all("sharing-" in f for f in files), name
        # a line alone at its marker and place is not read again
        held = spark.read.parquet(*files).select("sample_id", "source_line_number").distinct().count()
        assert held < spark.read.parquet(f"{SMALL}/lineitem.parquet").count()


def test_line_items_are_numbered_before_texts_are_made(spark):
    text = _plan(view(spark, SMALL, "numbered_calls"))
    assert "subject-" in text and "subject-" not in text[text.index("Window [row_number()") :]


def test_called_loci_are_the_evidence_that_genes_read(spark):
    """Loci found from the calls are all loci but those without a call; both give the same outcomes and candidates."""
    calls = spark.createDataFrame(
        [
            ("a", "v1", 1, 0, 9, 9, 2, 1), ("a", "v2", 2, 0, 8, 9, 2, 1), ("b", "v1", 1, 0, 8, 8, 2, 0), ("b", "v3", 0, 0, None, None, None, None),
            ("c", "v2", 1, 0, 5, 5, 1, 1), ("d", "v9", 1, 0, 9, 9, 2, 1), (None, "v1", 1, 0, 9, 9, 2, 1),
        ],
        "sample_id string, variant_id string, call_count long, foreign_count long, low_code int, high_code int, min_ploidy int, max_alt int",
    )
    loci = spark.createDataFrame(
        [("L1", "G", "v1", "A", "C"), ("L2", "G", "v2", "A", "G"), ("L3", "H", "v3", "T", "C"), ("L1", "H", "v1", "A", "C"), ("L4", "G", None, "A", "C")],
        "locus_id string, gene_id string, variant_id string, reference string, alternate string",
    )
    asked = [("a", "G"), ("a", "H"), ("b", "G"), ("b", "H"), ("c", "G"), ("d", "G"), ("e", "K"), (None, "G")]
    requests = spark.createDataFrame(asked, "sample_id string, gene_id string")
    every, called = pgx.locus_evidence(calls, loci, requests), pgx.locus_evidence(calls, loci, requests, called=True)
    assert rows(called) == rows(every.join(calls.select("sample_id", "variant_id"), ["sample_id", "variant_id"], "left_semi").select(*every.columns))
    genes = spark.createDataFrame([("G", pgx.STAR), ("H", pgx.STAR), ("K", "other")], "gene_id string, strategy string")
    alleles = spark.createDataFrame([(g, f"{g}*{i}", "active") for g in "GHK" for i in (1, 2)], "gene_id string, allele_id string, status string")
    needs = spark.createDataFrame(
        [("G*1", "L1", "required_reference"), ("G*2", "L1", "required_alternate"), ("H*1", "L3", "required_reference")],
        "allele_id string, locus_id string, state string",
    )
    limits = pgx.gene_limits(genes, alleles, loci)
    pairs = pgx.pair_requirements(alleles, needs, limits)
    for operator in (pgx.diplotype_candidates, pgx.gene_outcomes):
        assert rows(operator(called, pairs, limits, requests)) == rows(operator(every, pairs, limits, requests))
    got = {(r.sample_id, r.gene_id): (r.outcome, r.candidate_count) for r in pgx.gene_outcomes(called, pairs, limits, requests).collect()}
    assert got[("a", "G")] == ("conflicting_observations", 0) and got[("b", "G")] == ("resolved_candidate", 1)
    assert got[("d", "G")] == ("insufficient_coverage", 3) and got[("e", "K")][0] == "unsupported_gene_or_method" and len(got) == len(asked)


def test_observations_travel_as_they_are(spark):
    """Neither a digest of the observed loci nor the limits of a gene go with every requested row."""
    for name in ("diplotype_candidates", "gene_outcomes"):
        df = contract.queries()[name](spark, SMALL)
        held = {c for f in df.inputFiles() if "requested-" in f for c in spark.read.parquet(f).columns}
        assert held == {"sample_id", "gene_id", "conflicted", "unmodeled", "observed"}, name


def test_archives_are_stored_small(spark, folder, monkeypatch):
    """Derived archives are compressed, what is parsed is kept as columns, and a link is distinct by its two ids."""
    monkeypatch.setattr(suite_files, "_fresh", lambda spark, name: f"{folder}/{name}")
    df = contract.queries()["assertion_conditions"](spark, SMALL)
    assert {f[-3:] for f in os.listdir(f"{folder}/archives") if f.startswith("part")} == {".gz"}
    held = [f for f in df.inputFiles() if "archives-" in f]
    assert held and "ClassifiedRecord" not in spark.read.parquet(held[0]).columns
    plan = _plan(df)
    distinct = next(line for line in plan.splitlines() if "Aggregate [assertion_id" in line)
    assert "relationship_id" not in distinct and "from_xml(" not in plan


def test_ids_are_made_where_they_are_used(spark):
    """Profiles travel without ids to where their rationales meet genotypes; a report stores no candidate."""
    text = _plan(contract.queries()["rationale_genotypes"](spark, SMALL))
    dealt = text[text.index("RepartitionByExpression [sample_id") :]
    assert "rationale-" in text and not any(prefix in dealt for prefix in ("rationale-", "candidate-", "profile-"))
    held = contract.queries()["review_report"](spark, SMALL).inputFiles()
    stored = {kind: set(spark.read.parquet(f).columns) for f in held for kind in ("profiles-", "ranges-") if kind in f}
    assert set(stored) == {"profiles-", "ranges-"}
    assert not {"profile_id", "candidate_id"} & stored["profiles-"] and not {"candidate_id", "any_high", "reason_code"} & stored["ranges-"]


def test_report_reasons_meet_candidates_of_any_id(spark):
    """Ids with and without digits at their end, and none, meet their reasons."""
    ids = ["candidate-" + "0a" * 32, "candidate-" + "0b" * 32, "c1", "", None]
    queue = spark.createDataFrame(
        [("s", n + 1, f"v{n}", "review_first", "single_observed_alt_call", False, i, "more") for n, i in enumerate(ids)],
        "sample_id string, queue_position long, variant_id string, band string, genotype_state string, source_conflict boolean, "
        "candidate_id string, other string",
    )
    reasons = spark.createDataFrame([(i, r) for i in ids for r in ("b" if i else "a", "c", "c")], "candidate_id string, reason_code string")
    evidence = spark.createDataFrame([("v0", ["k"], ["n"])], "variant_id string, logical_source_keys array<string>, condition_names array<string>")
    out = [r.line for r in reports.review_report(queue, evidence, reasons).orderBy("ordinal").collect()]
    assert len(out) == reports.REVIEW_HEAD + len(ids) * reports.REVIEW_ENTRY
    assert out[reports.REVIEW_HEAD + 6 :: reports.REVIEW_ENTRY] == [f"   because: {x}" for x in ("b, c", "b, c", "b, c", "a, c", "none")]
    assert rv.packed_id(queue, "candidate_id").where("_digest is null").count() == 0


def test_samples_are_named_from_the_file_name_alone(spark):
    """Same names as from the whole location, which is not searched for every line."""
    uris = [
        "file:/a/b.c/part-1.txt.gz", "hdfs://h:9/x/y", "x", "", "/a/b/", "/a/.hidden", "/a/b c.d-e.txt", "/a/..", "/a/x.\u00e9.txt", "/a.b/c\nd.txt",
        "s3://bucket/" + "long-folder-name/" * 40 + "name.tar.gz",
    ]
    frame = spark.createDataFrame([(u,) for u in uris], "uri string").select("uri", source_sample("uri").alias("s"))
    for r in frame.collect():
        found = re.search(r"([^/]+?)(?:\.[A-Za-z0-9]+)*$", r.uri)
        assert r.s == f"{found[1] if found else ''}-{hashlib.sha256(r.uri.encode()).hexdigest()[:32]}", r.uri
    assert "regexp_extract(substring_index(" in _plan(frame)
