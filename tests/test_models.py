import itertools

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from varloom.operators import checks as ck, family as fm, neighbors as nb, pgx, phasing as ph, projection as pj, scoring as sc, triangles as tr
from varloom.operators.calls import collapse
from varloom.operators.materialize import cut
from varloom.plans import flows

CALLS = "sample_id string, variant_id string, ploidy int, alt_count int"


def calls_of(spark, data):
    return collapse(
        spark.createDataFrame(data, CALLS).withColumn("foreign_code", F.lit(None).cast("int"))
    )


def test_scores(spark):
    variants = spark.createDataFrame(
        [("P", f"v{i}", "GRCh38", "1", i, "A", "G", e, w) for i, (e, w) in enumerate([("G", "0.25"), ("A", "0.5"), ("G", "-3e-1")])],
        "pgs_id string, variant_id string, assembly string, chromosome string, position bigint,"
        " reference string, alternate string, effect_allele string, effect_weight string",
    )
    models = spark.createDataFrame(
        [("P", "1", "all_supported_variants_required", 3)],
        "pgs_id string, model_version string, completeness_policy string, declared_variant_count bigint",
    )
    requests = spark.createDataFrame([("s", "P"), ("t", "P"), ("u", "P")], "sample_id string, pgs_id string")
    calls = calls_of(
        spark,
        [("s", "v0", 2, 2), ("s", "v1", 2, 1), ("t", "v0", 2, 2), ("t", "v1", 2, 1), ("t", "v2", 2, 0),
         ("u", "v0", 2, 2), ("u", "v0", 2, 1), ("u", "v1", 1, 1)],
    )
    out = flows.score(calls, variants, models, requests)
    got = {r["sample_id"]: r for r in out["results"].collect()}
    assert str(got["s"]["raw_partial_score"].normalize()) == "1"
    assert got["s"]["status"] == "partial_not_evaluable" and got["s"]["contributed_marker_count"] == 2
    assert got["t"]["status"] == "evaluable"
    assert got["u"]["status"] == "not_evaluable" and got["u"]["marker_coverage"] == 0
    assert got["s"]["absolute_weight_coverage"] == pytest.approx(0.75 / 1.05)
    reasons = rows(out["exclusions"].where("sample_id <> 's'"), "sample_id", "reason")
    assert reasons == [("u", "DUPLICATE_OBSERVATION_CONFLICT"), ("u", "TARGET_VARIANT_MISSING"), ("u", "TARGET_VARIANT_MISSING")]
    none = spark.createDataFrame([], "pgs_id string")
    assert flows.validate_score_bundle(models, variants, none).count() == 0
    bad = variants.withColumn("effect_weight", F.lit("NaN"))
    assert {r["check"] for r in flows.validate_score_bundle(models, bad, none).collect()} == {"invalid_weight"}
    with pytest.raises(ValueError, match="absent"):
        flows.score(calls, variants, models, requests.withColumn("pgs_id", F.lit("Q")))


def test_reference_comparison(spark):
    results = spark.createDataFrame(
        [("a", "P", "1", "evaluable", 2.0), ("b", "P", "1", "evaluable", 0.5), ("c", "P", "2", "evaluable", 1.0),
         ("d", "Q", "1", "evaluable", 1.0), ("e", "P", "1", "not_evaluable", 1.0), ("f", "R", "1", "evaluable", 1.0),
         ("g", "P", "1", "evaluable", 9.0), ("h", "P", "1", "evaluable", -9.0)],
        "sample_id string, pgs_id string, model_version string, status string, raw_partial_score double",
    )
    values = [1.0, 2.0, 2.0, 3.0]
    reference = spark.createDataFrame(
        [("P", "1", v) for v in values] + [("Q", "1", 5.0), ("Q", "1", 5.0)],
        "pgs_id string, model_version string, score double",
    )
    got = {r["sample_id"]: r for r in sc.compare_reference(results, reference, ["pgs_id", "model_version"]).collect()}
    assert got["a"]["percentile"] == 50.0 and got["a"]["z_score"] == 0.0
    assert got["b"]["percentile"] == 0.0
    assert got["g"]["percentile"] == 100.0 and got["h"]["percentile"] == 0.0
    assert got["b"]["z_score"] == pytest.approx((0.5 - 2) / np.std(values))
    assert {k: got[k]["comparison_reason"] for k in "cdef"} == {
        "c": "REFERENCE_IDENTITY_INCOMPATIBLE",
        "d": "REFERENCE_ZERO_VARIANCE",
        "e": "MODEL_NOT_EVALUABLE",
        "f": "REFERENCE_NOT_SELECTED",
    }


def pgx_tables(spark, n_alleles=2):
    genes = spark.createDataFrame(
        [("G", "star_haplotype_small_variant"), ("X", "unsupported")], "gene_id string, strategy string"
    )
    loci = spark.createDataFrame(
        [("L1", "G", "v1", "GRCh38", "1", 1, "A", "G"), ("L2", "G", "v2", "GRCh38", "1", 2, "C", "T")],
        "locus_id string, gene_id string, variant_id string, assembly string, chromosome string,"
        " position bigint, reference string, alternate string",
    )
    alleles = spark.createDataFrame(
        [("G", f"*{i:03d}", "active") for i in range(1, n_alleles + 1)], "gene_id string, allele_id string, status string"
    )
    constraints = spark.createDataFrame(
        [("*001", "L1", "required_reference"), ("*002", "L1", "required_alternate"),
         ("*001", "L2", "required_reference"), ("*002", "L2", "not_constraining")],
        "allele_id string, locus_id string, state string",
    )
    return genes, loci, alleles, constraints


def test_pharmacogene_outcomes(spark):
    genes, loci, alleles, constraints = pgx_tables(spark)
    data = [
        ("ref", "v1", 2, 0), ("ref", "v2", 2, 0), ("het", "v1", 2, 1), ("het", "v2", 2, 0),
        ("part", "v1", 2, 0), ("conf", "v1", 2, 0), ("conf", "v1", 2, 1), ("hap", "v1", 1, 0),
        ("dup", "v1", 2, 2), ("dup", "v1", 2, 2), ("no", "v1", 2, 0), ("no", "v2", 2, 2),
    ]
    samples = ["ref", "het", "part", "conf", "hap", "dup", "no", "none"]
    requests = spark.createDataFrame(
        [(s, "G") for s in samples] + [("ref", "X")], "sample_id string, gene_id string"
    )
    out = flows.infer_pharmacogenes(calls_of(spark, data), genes, loci, alleles, constraints, requests)
    got = {(r["sample_id"], r["gene_id"]): (r["outcome"], r["candidate_count"]) for r in out["gene_evaluability"].collect()}
    assert got == {
        ("ref", "G"): ("resolved_candidate", 1),
        ("het", "G"): ("resolved_candidate", 1),
        ("part", "G"): ("insufficient_coverage", 1),
        ("conf", "G"): ("conflicting_observations", 0),
        ("hap", "G"): ("conflicting_observations", 0),
        ("dup", "G"): ("resolved_candidate", 1),
        ("no", "G"): ("no_compatible_definition", 0),
        ("none", "G"): ("insufficient_coverage", 3),
        ("ref", "X"): ("unsupported_gene_or_method", 0),
    }
    pairs = rows(out["diplotype_candidates"].where("sample_id in ('het','dup')"), "sample_id", "allele_a", "allele_b")
    assert pairs == [("dup", "*002", "*002"), ("het", "*001", "*002")]
    states = dict(rows(out["locus_evidence"].where("locus_id = 'L1'"), "sample_id", "state"))
    assert states["dup"] == "duplicate_concordant" and states["none"] == "missing_or_unassayed"


def test_pharmacogene_limits_refuse_before_pairing(spark):
    genes, loci, alleles, constraints = pgx_tables(spark, 6)
    requests = spark.createDataFrame([("s", "G")], "sample_id string, gene_id string")
    calls = calls_of(spark, [("s", "v1", 2, 0)])
    out = flows.infer_pharmacogenes(calls, genes, loci, alleles, constraints, requests, max_pairs=20)
    assert rows(out["gene_evaluability"], "outcome", "candidate_count") == [("combinatorial_limit_exceeded", 0)]
    limits = pgx.gene_limits(genes, alleles, loci, max_pairs=20)
    assert pgx.pair_requirements(alleles, constraints, limits).count() == 0
    assert ck.pgx_rule_violations(genes, alleles, constraints).count() == 4


def test_all_trio_genotypes(spark):
    dosage = list(itertools.product(range(3), repeat=3))
    data = [(f"{role}{i}", "v", 2, d[j]) for i, d in enumerate(dosage) for j, role in enumerate("cfm")]
    members = spark.createDataFrame(
        [(f"{r}{i}", f"{r}{i}", f"{r}{i}", f"{r}{i}") for i in range(27) for r in "cfm"],
        "member_id string, subject_id string, run_id string, sample_id string",
    )
    edges = spark.createDataFrame(
        [(f"e{r}{i}", f"{r}{i}", f"c{i}") for i in range(27) for r in "fm"],
        "assertion_id string, parent_member_id string, child_member_id string",
    )
    variants = spark.createDataFrame(
        [("v", "GRCh38", "3", 1, "A", "G")],
        "variant_id string, assembly string, chromosome string, position bigint, reference string, alternate string",
    )
    out = flows.analyze_family(calls_of(spark, data), members, edges, variants)
    got = {r["child_member_id"]: r for r in out["segregation_evidence"].collect()}
    gametes = {0: {0}, 1: {0, 1}, 2: {1}}
    for i, (child, father, mother) in enumerate(dosage):
        ways = {(a, b) for a in gametes[father] for b in gametes[mother] if a + b == child}
        row = got[f"c{i}"]
        assert row["assignment_count"] == len(ways), (child, father, mother)
        assert row["compatibility"] == ("consistent" if ways else "inconsistent")
        assert row["informativeness"] == ("uninformative" if len(ways) > 1 else "informative")
    counts = dict(rows(out["compatibility_counts"]))
    assert sum(counts.values()) == 27 and len(counts) == 7 and counts["unsupported_locus"] == 0


def test_duo_missing_conflict_and_ploidy(spark):
    data = [("c", "a", 2, 1), ("p", "a", 2, 0), ("c", "b", 2, 2), ("p", "b", 2, 0), ("c", "d", 2, 1),
            ("c", "e", 2, 1), ("c", "e", 2, 0), ("p", "e", 2, 0), ("c", "f", 1, 1), ("p", "f", 2, 0),
            ("c", "x", 2, 1), ("p", "x", 2, 1)]
    members = spark.createDataFrame(
        [("c",) * 4, ("p",) * 4], "member_id string, subject_id string, run_id string, sample_id string"
    )
    edges = spark.createDataFrame([("e", "p", "c")], "assertion_id string, parent_member_id string, child_member_id string")
    variants = spark.createDataFrame(
        [(v, "X" if v == "x" else "1", "A", "G") for v in "abdefx"],
        "variant_id string, chromosome string, reference string, alternate string",
    )
    rows_ = fm.segregation(calls_of(spark, data), fm.families(members, edges), variants)
    assert {r["variant_id"]: (r["compatibility"], r["transmission_status"]) for r in rows_.collect()} == {
        "a": ("consistent", "unique_transmission"),
        "b": ("inconsistent", "no_compatible_transmission"),
        "d": ("indeterminate_missing", "unresolved_input"),
        "e": ("indeterminate_conflicting", "unresolved_input"),
        "f": ("unsupported_ploidy", "not_applicable"),
        "x": ("unsupported_locus", "not_applicable"),
    }


def test_pedigree_rules_and_cycles(spark):
    members = spark.createDataFrame([(m, m, m) for m in "abcd"], "member_id string, subject_id string, run_id string")

    def check(*pairs):
        edges = spark.createDataFrame(
            [(f"e{i}", p, c) for i, (p, c) in enumerate(pairs)],
            "assertion_id string, parent_member_id string, child_member_id string",
        )
        return {r["rule"] for r in flows.validate_pedigree(members, edges).collect()}

    assert check(("a", "b"), ("b", "c"), ("a", "c")) == set()
    assert check(("a", "b"), ("b", "c"), ("c", "a")) == {"ancestry_cycle"}
    assert check(("a", "a")) == {"self_parent"}
    assert check(("a", "z")) == {"unknown_member"}
    assert check(("a", "b"), ("a", "b")) == {"duplicate_edge"}
    assert check(("a", "d"), ("b", "d"), ("c", "d")) == {"more_than_two_parents"}


def test_edges_between_two_cycles_are_on_none(spark):
    cycles = [("a", "b"), ("b", "a"), ("d", "e"), ("e", "f"), ("f", "d")]
    others = [("b", "c"), ("c", "d"), ("x", "a"), ("f", "y"), ("z", "z")]
    edges = spark.createDataFrame(cycles + others, "parent_member_id string, child_member_id string")
    from varloom.operators import family
    from varloom.operators.materialize import cut

    assert rows(family.cycle_edges(edges, cut), "parent_member_id", "child_member_id") == sorted(cycles)
    assert family.cycle_edges(edges.limit(0), cut).count() == 0


def test_projection_against_numpy(spark):
    rng = np.random.default_rng(3)
    k, m = 3, 40
    load = np.linalg.qr(rng.normal(size=(m, k)))[0]
    chrom = [str(1 + i % 4) for i in range(m)]
    loadings = spark.createDataFrame(
        [("pc", f"v{i}", f"v{i}", chrom[i], 0.5, 1.5, [float(x) for x in load[i]]) for i in range(m)],
        "model_id string, model_variant_id string, variant_id string, chromosome string, mean double,"
        " scale double, loadings array<double>",
    )
    dose = rng.integers(0, 3, size=(5, m))
    seen = rng.random((5, m)) < 0.7
    seen[4] = False
    seen[4, :2] = True
    calls = calls_of(spark, [(f"s{s}", f"v{i}", 2, int(dose[s, i])) for s in range(5) for i in range(m) if seen[s, i]])
    requests = spark.createDataFrame([(f"s{s}", "pc") for s in range(6)], "sample_id string, model_id string")
    gates = {**pj.DEFAULT_GATES, "components": k, "marker_count": 5}
    used = pj.used_markers(calls, loadings, requests)
    out = {(r["sample_id"], r["omitted_chromosome"]): r for r in pj.project(used, loadings, requests, gates).collect()}
    for s in range(4):
        keep = seen[s]
        x = (dose[s][keep] - 0.5) / 1.5
        z, *_ = np.linalg.lstsq(load[keep], x, rcond=None)
        row = out[(f"s{s}", None)]
        assert np.allclose(row["coordinates"], z, atol=1e-9)
        assert np.allclose(row["singular_values"], np.linalg.svd(load[keep], compute_uv=False))
        assert np.allclose(row["loading_energy"], (load[keep] ** 2).sum(0) / (load**2).sum(0))
        for c in set(np.array(chrom)[keep]):
            part = keep & (np.array(chrom) != c)
            zc, *_ = np.linalg.lstsq(load[part], (dose[s][part] - 0.5) / 1.5, rcond=None)
            assert np.allclose(out[(f"s{s}", c)]["absolute_deviations"], np.abs(zc - z), atol=1e-9)
    assert out[("s4", None)]["failed_gates"] == ["minimum_observed_marker_count", "full_rank"]
    assert out[("s5", None)]["used_marker_count"] == 0 and out[("s5", None)]["coordinates"] is None
    assert ck.gram_violations(loadings, 1e-9).count() == 0
    assert ck.gram_violations(loadings.limit(m - 1), 1e-9).count() > 0


def test_gates_only_tighten(spark):
    model = {**pj.DEFAULT_GATES, "model_id": "pc", "components": 2, "maximum_components": 3, "condition": 100.0, "marker_count": 10}
    asked = [("a", "pc", 5, 500.0, 3), ("b", "pc", 20, 50.0, None), ("c", "pc", None, None, 4), ("d", "none", None, None, None)]
    requests = spark.createDataFrame(asked, "sample_id string, model_id string, marker_count int, condition double, components int")
    got = {r.sample_id: r for r in pj.gated_requests(requests, spark.createDataFrame([model])).collect()}
    assert sorted(got) == ["a", "b", "c"]
    assert (got["a"].marker_count, got["a"].condition, got["a"].components) == (10, 100.0, 3)
    assert (got["b"].marker_count, got["b"].condition, got["b"].components) == (20, 50.0, 2)
    assert [got[s].components_allowed for s in "abc"] == [True, True, False]


def _system(rng, rows, k, rank):
    left = rng.normal(size=(rows, rank)) @ rng.normal(size=(rank, k)) if rows else np.zeros((0, k))
    return left, rng.normal(size=rows)


@pytest.mark.parametrize("rows,k,rank", [(0, 3, 1), (1, 3, 1), (2, 3, 2), (3, 3, 3), (50, 3, 3), (50, 4, 2), (400, 10, 10)])
def test_triangles_say_what_the_whole_system_says(rows, k, rank):
    rng = np.random.default_rng(rows + k)
    left, x = _system(rng, rows, k, rank)
    cuts = np.sort(rng.integers(0, rows + 1, 4))
    parts = [tr.reduced(np.column_stack((l, y))) for l, y in zip(np.split(left, cuts), np.split(x, cuts))]
    got = tr.solution(tr.merged(*parts), rows, 1e-10)
    if not rows:
        assert got["matrix_rank"] == 0 and got["singular_values"] == [] and got["residual_norm"] == 0
        return
    z = np.linalg.lstsq(left, x, rcond=1e-10)[0]
    values = np.linalg.svd(left, compute_uv=False)
    assert np.allclose(got["coordinates"], z, atol=1e-9) and np.allclose(got["singular_values"], values, atol=1e-9)
    assert got["residual_norm"] == pytest.approx(np.linalg.norm(left @ z - x), abs=1e-9)
    assert got["matrix_rank"] == np.linalg.matrix_rank(left) == min(rank, rows)
    assert (got["condition_number"] is None) == (min(rank, rows) < k)
    if got["condition_number"]:
        assert got["condition_number"] == pytest.approx(np.linalg.cond(left), rel=1e-9)
    segments = tr.reduced_segments(np.column_stack((left, x)), np.array([0, *(c for c in sorted(set(cuts.tolist())) if 0 < c < rows)]))
    assert np.allclose(tr.solution(tr.merged(*segments), rows, 1e-10)["singular_values"], values, atol=1e-9)
    kept = np.split(np.arange(rows), cuts)
    for part, triangle in zip(kept, tr.all_but_one(parts)):
        rest = np.setdiff1d(np.arange(rows), part)
        both = np.column_stack((left, x))[rest]
        assert np.allclose(triangle.T @ triangle, both.T @ both, atol=1e-8)


@pytest.mark.parametrize("batch", [3, 10_000])
def test_requests_of_different_sizes_share_one_job(spark, batch):
    """Per-request component counts, a refused count, a non-finite marker, and replicates below the gates."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    rng = np.random.default_rng(9)
    load = rng.normal(size=(30, 3))
    load[29, 1] = np.nan
    loadings = spark.createDataFrame(
        [("pc", f"v{i}", f"v{i}", str(1 + i // 10), 0.5, 1.5, [float(x) for x in load[i]]) for i in range(30)],
        "model_id string, model_variant_id string, variant_id string, chromosome string, mean double, scale double, loadings array<double>",
    )
    dose = rng.integers(0, 3, size=30)
    seen = {"one": range(29), "two": range(29), "four": range(29), "odd": range(30), "few": range(9, 20)}
    calls = calls_of(spark, [(s, f"v{i}", 2, int(dose[i])) for s, at in seen.items() for i in at])
    model = {**pj.DEFAULT_GATES, "model_id": "pc", "components": 3, "maximum_components": 3, "marker_count": 4, "sensitivity": 2}
    counts = {"one": 1, "two": 2, "four": 4, "odd": None, "few": 2}
    requests = spark.createDataFrame([(s, "pc", c) for s, c in counts.items()], "sample_id string, model_id string, components int")
    gated = pj.gated_requests(requests, spark.createDataFrame([model]))
    fits = pj.project(pj.used_markers(calls, loadings, requests), loadings, gated)
    out = {(r.sample_id, r.omitted_chromosome): r for r in fits.collect()}
    x = (dose[:29] - 0.5) / 1.5
    for s, k in (("one", 1), ("two", 2)):
        assert np.allclose(out[s, None].coordinates, np.linalg.lstsq(load[:29, :k], x, rcond=None)[0], atol=1e-9)
        assert len([o for n, o in out if n == s and o]) == 3
    assert out["four", None].failed_gates[0] == "maximum_component_count" and out["four", None].coordinates is None
    assert "finite_inputs" in out["odd", None].failed_gates and ("odd", "1") not in out
    assert out["few", "1"].status == "projected" and out["few", "2"].failed_gates == ["minimum_observed_marker_count", "full_rank"]
    summary = {r.sample_id: (r.eligible_replicates, r.valid_replicates, r.summary_available) for r in pj.sensitivity_summary(fits).collect()}
    assert summary == {"one": (3, 3, True), "two": (3, 3, True), "four": (0, 0, False), "odd": (0, 0, False), "few": (2, 1, False)}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("cell_rows", [20, 5000])
def test_neighbours_and_support_match_brute_force(spark, cell_rows):
    rng = np.random.default_rng(11)
    ref = rng.normal(size=(300, 3)) * [1, 5, 0.3]
    ref[:120] = ref[0]  # a hot cell of identical samples
    group = [f"g{i % 4}" for i in range(300)]
    scores = spark.createDataFrame(
        [(f"r{i:03d}", group[i], [float(x) for x in ref[i]]) for i in range(300)],
        "reference_sample_id string, reference_group_id string, scores array<double>",
    )
    q = np.vstack([ref[0], rng.normal(size=(20, 3)) * [2, 6, 1]])
    points = spark.createDataFrame(
        [(i, [float(x) for x in q[i]]) for i in range(len(q))], "query_id int, coordinates array<double>"
    )
    sd = ref.std(axis=0)
    got = {}
    for r in nb.nearest(points, scores, 7, cell_rows).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["reference_sample_id"]
    for i in range(len(q)):
        d = np.sqrt((((q[i] - ref) / sd) ** 2).sum(1))
        want = [n for _, _, n in sorted((round(d[j], 12), group[j], f"r{j:03d}") for j in range(300))[:7]]
        assert [got[i][n] for n in range(1, 8)] == want
    radii = {r["reference_group_id"]: r["envelope_radius"] for r in pj.support_radii(scores, 0.8, 5).collect()}
    for g in set(group):
        own = ref[[x == g for x in group]]
        r = np.linalg.norm((own - own.mean(0)) / sd, axis=1)
        assert radii[g] == pytest.approx(np.quantile(r, 0.8))


def _points(spark, rng, n, spread):
    rows = [(i, [float(x) for x in rng.normal(size=3) * spread]) for i in range(n)]
    return spark.createDataFrame(rows, "query_id int, z array<double>")


def test_rows_sent_to_cells_follow_the_visits(spark, monkeypatch):
    monkeypatch.setattr(nb, "QUERIES", 50)
    rng = np.random.default_rng(4)
    ref = rng.normal(size=(3000, 3)) * [1, 4, 0.5]
    ref[:900] = ref[0] + rng.normal(size=(900, 3)) * 1e-3  # one dense spot
    refs = spark.createDataFrame([(f"r{i}", [float(x) for x in v]) for i, v in enumerate(ref)], "reference_sample_id string, u array<double>")
    cells = nb.tree(refs, 100)
    rows = cells.rows.collect()
    sizes = {}
    for r in rows:
        sizes[r.node] = sizes.get(r.node, 0) + 1
    assert len(rows) == 3000 and len(sizes) > 25 and max(sizes.values()) <= 250
    boxes = {b.node: b for b in cells.boxes.collect()}
    assert {n for n, b in boxes.items() if b.leaf} == set(sizes)
    for r in rows:
        node = r.node
        while node >= nb.ROOT:
            assert all(s.lo <= x <= s.hi for s, x in zip(boxes[node].sides, r.u))
            node >>= nb.AXES
    placed = nb.own_cells(_points(spark, rng, 300, [1, 4, 0.5]), cells)
    reach = placed.withColumnRenamed("node", "own").withColumn("reach", F.lit(0.2))
    got = {(r.query_id, r.node) for r in nb.visits(reach, cells).collect()}
    want = set()
    for q in reach.collect():
        for n in sizes:
            gap = sum(max(0.0, s.lo - x, x - s.hi) ** 2 for s, x in zip(boxes[n].sides, q.z)) ** 0.5
            if n != q.own and gap <= 0.2:
                want.add((q.query_id, n))
    assert got == want and len(want) < 300 * len(sizes) / 3
    a, b, _ = nb.sent(nb.visits(reach, cells), cells, 100)
    # a visited cell's rows once, and once more per 50 visits; a visit once per 100 rows of its cell
    assert b.count() <= 3000 + max(sizes.values()) * len(want) / 50
    assert a.count() <= len(want) * (1 + max(sizes.values()) // 100)
    empty = nb.tree(refs.limit(0), 100)
    assert empty.depth == 0 and empty.boxes.count() == 0


def test_phasing_and_masking(spark):
    calls = calls_of(spark, [("s", f"v{i}", 2, i % 3) for i in range(20)] + [("s", "h", 1, 1), ("s", "d", 2, 0), ("s", "d", 2, 1)])
    variants = spark.createDataFrame(
        [(f"v{i}", "2" if i < 19 else "X", 100 - i, "A", "G") for i in range(20)] + [("h", "1", 5, "A", "G"), ("d", "1", 6, "A", "G")],
        "variant_id string, chromosome string, position bigint, reference string, alternate string",
    )
    out = flows.prepare_phasing(calls, variants, ["1", "2"], 0.5, 7)
    assert dict(rows(out["excluded"], "variant_id", "reason")) == {
        "v19": "unsupported_chromosome", "h": "unsupported_ploidy", "d": "discordant_duplicate",
    }
    ordered = [r["position"] for r in out["aligned"].collect()]
    assert ordered == sorted(ordered) and len(ordered) == 19
    import hashlib

    names = [f"v{i}" for i in range(19)]
    want = sorted(names, key=lambda v: (hashlib.sha256(f"7:{v}".encode()).hexdigest(), v))[:9]
    assert {r["variant_id"] for r in out["masked"].collect()} == set(want)
    with pytest.raises(ValueError):
        ph.masked_markers(calls, 1.0, 1)


def test_masked_metrics(spark):
    truth = spark.createDataFrame(
        [("s", "a", "A", ["A", "G"]), ("s", "b", "A", ["A", "A"]), ("s", "c", "A", ["G", "G"]), ("t", "a", "A", ["A", "G"])],
        "sample_id string, variant_id string, reference string, alleles array<string>",
    )
    inferred = spark.createDataFrame(
        [("s", "a", ["G", "A"], 0.5), ("s", "b", None, 0.5)],
        "sample_id string, variant_id string, gt array<string>, ds double",
    )
    got = {r["sample_id"]: r for r in ph.masked_metrics(truth, inferred).collect()}
    s = got["s"]
    assert (s["returned_numerator"], s["returned_denominator"]) == (2, 3)
    assert (s["hard_numerator"], s["hard_denominator"]) == (1, 1)
    assert s["dosage_mae"] == 0.5 and s["dosage_rmse"] == 0.5
    assert got["t"]["dosage_mae"] is None and got["t"]["hard_denominator"] == 0
