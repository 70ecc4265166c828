from conftest import rows
from pyspark.sql import functions as F

from varloom import vocab
from varloom.operators import checks as ck, normalize as nz, review as rv
from varloom.operators.calls import collapse, genotype_state
from varloom.plans import flows
from varloom.functions.tokens import classify

DEFS = (
    "marker_id string, assembly string, chromosome string, position bigint, reference string, "
    "alternate string, orientation string, orientation_authoritative boolean, rsid string"
)


def observations(spark, data):
    df = spark.createDataFrame(
        [(s, i + 1, m, "1", 5 + i, t, b, "run") for i, (s, m, t, b) in enumerate(data)],
        "sample_id string, source_line_number bigint, source_marker_id string, source_chromosome string,"
        " source_position bigint, raw_genotype string, source_build string, ingestion_run_id string",
    )
    return classify(df)


def build(spark, data, with_lift=True):
    defs = spark.createDataFrame(
        [
            ("plain", "GRCh38", "1", 3, "A", "G", "none", True, "rs1"),
            ("comp", "hg38", "chr1", 4, "C", "T", "complement", True, None),
            ("mnv", "38", "1", 5, "GT", "CA", "reverse_complement", True, None),
            ("indel", "38", "1", 3, "A", "AG", "none", True, None),
            ("pal", "38", "1", 3, "A", "T", "none", False, None),
            ("strand", "38", "1", 3, "A", "G", "unknown", True, None),
            ("twice", "38", "1", 3, "A", "G", "none", True, None),
            ("twice", "38", "1", 3, "A", "C", "none", True, None),
            ("wrongref", "38", "1", 4, "A", "G", "none", True, None),
            ("old", "37", "1", 30, "A", "G", "none", True, None),
            ("oldmany", "37", "1", 31, "A", "G", "none", True, None),
            ("oldnone", "37", "1", 32, "A", "G", "none", True, None),
        ],
        DEFS,
    )
    tiles = spark.createDataFrame([("1", 0, "NNACG"), ("1", 1, "TT")], "contig string, tile bigint, bases string")
    lift = spark.createDataFrame(
        [("1", 29, "1", 2), ("1", 30, "1", 2), ("1", 30, "1", 3)],
        "chromosome string, pos0 bigint, cand_chromosome string, cand_pos0 bigint",
    )
    return flows.normalize(observations(spark, data), defs, tiles, 5, lift if with_lift else None)


DATA = [
    ("s", "plain", "AG", "38"),
    ("s", "plain", "--", "38"),
    ("s", "plain", "A", "38"),
    ("s", "plain", "CC", "38"),
    ("s", "comp", "ga", "38"),
    ("s", "mnv", "ACTG", "38"),
    ("s", "indel", "AG", "38"),
    ("s", "pal", "AT", "38"),
    ("s", "strand", "AG", "38"),
    ("s", "twice", "AG", "38"),
    ("s", "wrongref", "AG", "38"),
    ("s", "absent", "AG", "38"),
    ("s", "plain", "AG", "weird"),
    ("s", "plain", "AG", "37"),
    ("t", "old", "AG", "hg19"),
    ("t", "oldmany", "AG", "hg19"),
    ("t", "oldnone", "AG", "hg19"),
]


def test_every_reason_and_genotype(spark):
    out = build(spark, DATA)
    got = {
        r["source_line_number"]: (r["outcome"], r["reason"], "".join(r["source_to_canonical_alleles"]))
        for r in out["observation_mappings"].collect()
    }
    assert got == {
        1: ("mapped", None, "AG"),
        2: ("mapped", None, ""),
        3: ("mapped", None, "A"),
        4: ("mapped", None, "CC"),
        5: ("mapped", None, "CT"),
        6: ("mapped", None, "GTCA"),
        7: ("unsupported", "UNSUPPORTED_ALLELE_REPRESENTATION", ""),
        8: ("ambiguous", "PALINDROMIC_AMBIGUITY", ""),
        9: ("ambiguous", "STRAND_UNRESOLVED", ""),
        10: ("ambiguous", "MARKER_DEFINITION_CONFLICT", ""),
        11: ("failed", "TARGET_REF_MISMATCH", ""),
        12: ("unmapped", "MARKER_DEFINITION_ABSENT", ""),
        13: ("unmapped", "MISSING_OR_UNKNOWN_BUILD", ""),
        14: ("unsupported", "MARKER_DEFINITION_ASSEMBLY_MISMATCH", ""),
        15: ("mapped", None, "AG"),
        16: ("ambiguous", "MULTIPLE_LIFTOVER_CANDIDATES", ""),
        17: ("unmapped", "NO_LIFTOVER_CANDIDATE", ""),
    }
    calls = {r["observation_reference"]: r for r in out["canonical_genotypes"].collect()}
    assert len(calls) == 5
    assert sorted(r["ploidy"] for r in calls.values()) == [1, 2, 2, 2, 2]
    assert out["variants"].count() == 3
    assert ck.broken_rules(out["observation_mappings"], ck.MAPPING_RULES, "mapping_id").count() == 0
    assert ck.broken_rules(out["canonical_genotypes"], ck.GENOTYPE_RULES, "genotype_id").count() == 0
    per = out["mapping_candidates"].groupBy("source_marker_id").count().collect()
    assert {r[0]: r[1] for r in per} == {"pal": 1, "strand": 1, "twice": 2, "old": 1, "oldmany": 2}
    summary = {(r["dimension"], r["value"]): r["n"] for r in out["normalization_qc"].collect()}
    assert sum(n for (d, _), n in summary.items() if d == "outcomes") == len(DATA)


def test_no_liftover_resource(spark):
    out = build(spark, DATA[14:], with_lift=False)
    assert {r["reason"] for r in out["observation_mappings"].collect()} == {"NO_LIFTOVER_RESOURCE"}


def test_ids_are_stable(spark):
    a = rows(build(spark, DATA)["observation_mappings"], "mapping_id")
    assert a == rows(build(spark, DATA)["observation_mappings"], "mapping_id")


def test_genotype_states(spark):
    calls = spark.createDataFrame(
        [
            ("s", "a", 2, 1), ("s", "b", 2, 1), ("s", "b", 2, 1), ("s", "c", 2, 1), ("s", "c", 2, 0),
            ("s", "d", 2, 0), ("s", "d", 1, 0), ("s", "e", None, None),
        ],
        "sample_id string, variant_id string, ploidy int, alt_count int",
    )
    got = dict(rows(collapse(calls).select("variant_id", genotype_state())))
    assert got == {
        "a": "single_observed_alt_call",
        "b": "concordant_observed_alt_calls",
        "c": "discordant_called_rows_with_alt",
        "d": "observed_reference_only",
        "e": "no_canonical_called_genotype",
    }


def test_six_variant_review(spark):
    calls = collapse(
        spark.createDataFrame(
            [
                ("s", "v10", 2, 1), ("s", "v20", 2, 0), ("s", "v30", None, None), ("s", "v40", 2, 1),
                ("s", "v40", 2, 0), ("s", "v50", 2, 1), ("s", "v60", 2, 1),
            ],
            "sample_id string, variant_id string, ploidy int, alt_count int",
        )
    )
    links = spark.createDataFrame(
        [(f"v{i}", f"r{i}", "matched") for i in range(10, 70, 10)],
        "variant_id string, representation_id string, outcome string",
    )
    germ = ("source_submitted", "germline")
    data = [
        ("r10", "a1", *germ, ["pathogenic "], "current", "2020-01-01"),
        ("r10", "a2", *germ, ["Benign"], "replaced", None),
        ("r20", "a3", *germ, ["Pathogenic"], "current", "2020-01-01"),
        ("r30", "a4", *germ, ["Pathogenic"], "current", "2020-01-01"),
        ("r40", "a5", *germ, ["Uncertain significance"], None, "2020-01-01"),
        ("r50", "a6", *germ, ["Likely  benign"], "current", "2020-01-01"),
        ("r60", "a7", "source_submitted", "oncogenicity", ["Pathogenic"], "current", "2020-01-01"),
    ]
    assertions = spark.createDataFrame(
        data,
        "representation_id string, assertion_id string, assertion_level string, classification_type string,"
        " source_classification_terms array<string>, status_term string, d string",
    ).select(
        "*",
        F.col("d").cast("date").alias("date_last_evaluated"),
        F.col("assertion_id").alias("source_accession"),
        F.lit(1).alias("accession_version"),
        F.lit(None).cast("string").alias("review_status"),
        F.lit(None).cast("string").alias("submitter_name"),
    )
    out = flows.prioritize(calls, links, assertions, "2026-07-01", vocab.DEFAULT_POLICY)
    queue = {r["variant_id"]: r for r in out["review_queue"].collect()}
    assert {v: (r["band"], r["eligibility"]) for v, r in queue.items()} == {
        "v10": ("review_first", "eligible"),
        "v20": ("not_eligible", "not_eligible"),
        "v30": ("not_eligible", "not_eligible"),
        "v40": ("review_next", "data_conflict"),
        "v50": ("not_prioritized", "eligible"),
        "v60": ("context_only", "eligible"),
    }
    assert queue["v10"]["age_order"] == 2373 and queue["v10"]["missing_order"] == 1
    order = sorted(queue, key=lambda v: queue[v]["queue_position"])
    assert order[:4] == ["v10", "v40", "v60", "v50"]
    reasons = {}
    for r in out["priority_rationales"].collect():
        reasons.setdefault(r["variant_id"], set()).add(r["reason_code"])
    assert reasons["v40"] == {
        "active_germline_review_context",
        "data_conflict_alt_carriage_unresolved",
        "unknown_record_status_active_by_policy",
        "source_evaluation_older_than_policy_threshold",
    }
    arrays = {r["variant_id"]: r for r in out["profile_arrays"].collect()}
    assert arrays["v10"]["assertion_ids"] == ["a1", "a2"]
    assert arrays["v10"]["evidence_age_days"] == [2373, None]
    assert out["prioritization_exclusions"].count() == 2
    assert out["candidate_assertion_links"].count() == 7


def test_profile_arrays_are_complete_at_any_size(spark):
    routed = spark.range(5000).select(
        F.lit("v").alias("variant_id"), F.col("id").cast("string").alias("assertion_id"),
        *[F.lit("x").alias(c) for c in (
            "term", "route", "assertion_level", "classification_type", "source_accession", "review_level",
            "record_status", "submitter_name")],
        F.lit(1).alias("accession_version"), F.lit(None).cast("date").alias("date_last_evaluated"),
        F.lit(None).cast("int").alias("age_days"),
    )
    row = rv.profile_arrays(routed).first()
    assert row["row_count"] == 5000 and sorted(map(int, row["assertion_ids"])) == list(range(5000))
