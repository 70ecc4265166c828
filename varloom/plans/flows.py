"""End-to-end compositions: each returns a dict of lazy DataFrames, plus validators."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from varloom import vocab
from varloom.functions.alleles import count_allele, foreign_code
from varloom.operators import (
    checks as ck,
    family as fm,
    links as lk,
    lookup as lu,
    neighbors as nb,
    normalize as nz,
    pgx,
    phasing as ph,
    projection as pj,
    qc,
    review as rv,
    scoring as sc,
)
from varloom.operators.calls import collapse
from varloom.operators.materialize import cut
from varloom.plans import catalog
from varloom.sources import genotype_text as gt, vcv_xml as vx


def ingest_genotype_text(
    spark: SparkSession,
    paths,
    sources: DataFrame | None = None,
    build_override: str | None = None,
    strict: bool = True,
    run_id: str = "ingest",
) -> dict[str, DataFrame]:
    """Scan, classify and quality-check genotype files."""
    parsed = gt.scan(spark, paths, sources, run_id)
    if strict:
        gt.require_well_formed(parsed)
    meta = gt.source_metadata(parsed, build_override)
    obs, bad = gt.observations(parsed), gt.malformed(parsed)
    return {
        "observations": gt.with_build(obs, meta),
        "malformed_records": bad,
        "source_metadata": meta,
        "assay_qc": qc.assay_qc(obs, bad),
        "chromosome_qc": qc.chromosome_qc(obs),
        "qc_findings": qc.findings(obs, bad, meta),
        "qc_finding_lines": qc.finding_lines(obs),
    }


def normalize(
    observations: DataFrame,
    marker_defs: DataFrame,
    tiles: DataFrame,
    tile_width: int,
    liftover: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Map observations to canonical variants and genotypes."""
    resolved = nz.resolve_markers(marker_defs, tiles, tile_width, liftover)
    mapped = nz.map_observations(observations, resolved)
    return {
        "variants": nz.variants(resolved),
        "observation_mappings": nz.mapping_rows(mapped),
        "canonical_genotypes": nz.canonical_genotypes(mapped),
        "mapping_candidates": nz.mapping_candidates(
            mapped, nz.marker_candidates(marker_defs, resolved, liftover)
        ),
        "normalization_qc": nz.normalization_qc(mapped),
    }


def sample_summary(ingested: dict, normalized: dict) -> DataFrame:
    """Per-sample counts over the chained operators."""
    parts = (
        ("observation_count", ingested["observations"]),
        ("mapped_count", normalized["observation_mappings"].where("outcome = 'mapped'")),
        ("genotype_count", normalized["canonical_genotypes"]),
    )
    stacked = None
    for name, df in parts:
        rows = df.groupBy("sample_id").agg(F.count(F.lit(1)).alias(name))
        stacked = rows if stacked is None else stacked.unionByName(rows, allowMissingColumns=True)
    return stacked.groupBy("sample_id").agg(
        *[F.coalesce(F.max(name), F.lit(0)).alias(name) for name, _ in parts]
    )


def marker_resources(
    markers: DataFrame,
    tracks: list[tuple[str, DataFrame]],
    target: DataFrame,
    source_assembly: str,
) -> dict[str, DataFrame]:
    """Definitions, cross-build map, unresolved markers and statistics from two-tier extracts."""
    tiers = lu.tiered_lookup(markers, tracks)
    source = lu.merged_extracts(lu.tier_records(tiers, tracks))
    placed = lu.placements(markers, source)
    accepted = lu.accepted_source(placed)
    return {
        "tiers": tiers,
        "marker_definitions": lu.definitions(accepted, source_assembly),
        "liftover": lu.cross_build_map(accepted, target),
        "unresolved_markers": lu.unresolved_markers(markers, source, placed),
        "statistics": lu.resource_statistics(markers, placed, target, source_assembly),
    }


def ingest_assertion_xml(
    spark: SparkSession, paths, override: str | None = None
) -> dict[str, DataFrame]:
    """External snapshot tables from assertion archives."""
    header = vx.release_header(spark, paths, override)
    ck.require_none(header.where("violation is not null"), "release header")
    snapshot = header.first()["snapshot_id"]
    archives = vx.scan_archives(spark, paths, snapshot)
    ck.require_none(vx.archive_violations(archives), "archives")
    assertions = cut(vx.assertions(archives))
    traits = vx.condition_rows(archives)
    return {
        "external_snapshot": header.drop("violation"),
        "external_variant_representations": vx.representations(archives),
        "external_assertions": assertions,
        "assertion_relationships": vx.relationships(assertions),
        "external_conditions": vx.conditions(traits),
        "assertion_conditions": vx.condition_links(traits, assertions),
        "evidence_qc": lk.histogram(
            assertions, assertion_levels="assertion_level", classification_types="classification_type"
        ),
    }


def link_evidence(representations: DataFrame, variants: DataFrame) -> dict[str, DataFrame]:
    links = lk.exact_allele_links(representations, variants)
    return {
        "variant_evidence_links": links,
        "annotation_qc": lk.histogram(links, outcomes="outcome", reasons="reason"),
    }


def call_table(genotypes: DataFrame) -> DataFrame:
    """Collapsed calls from canonical genotypes with ``alleles``, ``reference``, ``alternate``."""
    ref, alt = F.col("reference"), F.col("alternate")
    rows = genotypes.withColumns(
        {
            "alt_count": count_allele(F.col("alleles"), alt),
            "foreign_code": foreign_code(F.col("alleles"), ref, alt),
        }
    )
    return collapse(rows)


def observed_calls(mappings: DataFrame, genotypes: DataFrame) -> DataFrame:
    """Collapsed calls for every variant a sample observed, called or not."""
    seen = mappings.where("variant_id is not null").select(
        "sample_id",
        "variant_id",
        F.lit(None).cast("int").alias("ploidy"),
        F.lit(None).cast("int").alias("alt_count"),
    )
    return collapse(seen.unionByName(genotypes.select("sample_id", "variant_id", "ploidy", "alt_count")))


def prioritize(
    calls: DataFrame,
    links: DataFrame,
    assertions: DataFrame,
    release_date: str,
    policy: dict = vocab.DEFAULT_POLICY,
) -> dict[str, DataFrame]:
    """Review queue and its audit tables."""
    routed = rv.routed_assertions(links, assertions, release_date, policy)
    rows = rv.profiles(calls, rv.evidence_summary(routed, policy), policy)
    return {
        "profiles": rows,
        "review_queue": rv.review_queue(rows),
        "priority_rationales": rv.rationales(rows, policy),
        "rationale_assertions": rv.rationale_assertions(routed, policy),
        "prioritization_exclusions": rv.exclusions(rows),
        "candidate_assertion_links": rv.candidate_assertion_links(routed),
        "profile_arrays": rv.profile_arrays(routed),
        "prioritization_qc": lk.histogram(rows, priority_bands="band", genotype_states="genotype_state"),
    }


def validate_projection_model(
    loadings: DataFrame, scores: DataFrame, groups: DataFrame, components: DataFrame, k: int, tolerance: float
) -> DataFrame:
    """Violations of a projection bundle: (check, key) rows."""

    def shaped(df, check, key):
        return df.select(F.lit(check).alias("check"), key.cast("string").alias("key"))

    finite = "forall({0}, v -> v is not null and not isnan(v) and abs(v) < double('inf'))"
    from varloom.functions.alleles import canonical_snv

    scope = canonical_snv(*[F.col(c) for c in ("assembly", "chromosome", "reference", "alternate")])
    counts = ck.count_mismatches(
        groups.select("reference_group_id", F.col("declared_sample_count").alias("declared")),
        scores,
        ["reference_group_id"],
    )
    return ck.union(
        shaped(ck.repeated_keys(loadings, ["model_id", "model_variant_id"], "x"), "duplicate_marker", F.col("key")),
        shaped(ck.repeated_keys(loadings, ["model_id", *nz.KEY], "x"), "duplicate_allele_key", F.col("key")),
        shaped(ck.repeated_keys(scores, ["reference_sample_id"], "x"), "duplicate_sample", F.col("key")),
        shaped(ck.repeated_keys(groups, ["reference_group_id"], "x"), "duplicate_group", F.col("key")),
        shaped(
            ck.missing_parents(scores, "reference_group_id", groups, "reference_group_id", "x"),
            "unknown_group", F.col("key"),
        ),
        shaped(counts, "group_count_mismatch", F.col("reference_group_id")),
        shaped(
            loadings.where(~F.coalesce(scope, F.lit(False)) | (F.col("effect_allele") != F.col("alternate"))),
            "unsupported_marker", F.col("model_variant_id"),
        ),
        shaped(
            loadings.where(f"size(loadings) <> {k} or not " + finite.format("loadings")),
            "loading_vector", F.col("model_variant_id"),
        ),
        shaped(
            scores.where(f"size(scores) <> {k} or not " + finite.format("scores")),
            "score_vector", F.col("reference_sample_id"),
        ),
        shaped(ck.gram_violations(loadings, tolerance), "loadings_not_orthonormal", F.concat_ws(",", "row", "column")),
        shaped(ck.summary_mismatches(scores, components, tolerance), "score_summary", F.col("component_index")),
    )


def infer_structure(
    calls: DataFrame,
    loadings: DataFrame,
    scores: DataFrame,
    requests: DataFrame,
    gates: dict | None,
    quantile: float,
    minimum_group: int,
    neighbours: int = vocab.NEIGHBOURS,
) -> dict[str, DataFrame]:
    """Projection, distances, neighbours, support and leave-one-chromosome-out sensitivity."""
    used = pj.used_markers(calls, loadings, requests)
    fits = pj.project(used, loadings, requests, gates)
    points = pj.replicate_points(fits)
    full = points.where("omitted_chromosome is null")
    distances = pj.group_distances(points, scores)
    radii = pj.support_radii(scores, quantile, minimum_group)
    support = pj.support_envelope(distances, radii)
    own = full.select("query_id")
    return {
        "marker_alignment": pj.marker_alignment(calls, loadings, requests),
        "projection": fits.where("omitted_chromosome is null"),
        "group_distances": distances.join(own, "query_id", "left_semi"),
        "neighbors": nb.nearest(full, scores, neighbours),
        "support": support.join(own, "query_id", "left_semi"),
        "support_status": pj.support_status(support).join(own, "query_id", "left_semi"),
        "sensitivity": pj.sensitivity(fits, distances, support),
        "sensitivity_summary": pj.sensitivity_summary(fits),
    }


def prepare_phasing(
    calls: DataFrame, variants: DataFrame, chromosomes: list[str], fraction: float, seed: int
) -> dict[str, DataFrame]:
    rows = ph.phasing_alignment(calls, variants, chromosomes)
    aligned = rows.where("reason is null").drop("reason")
    return {
        "aligned": ph.genomic_order(aligned),
        "excluded": rows.where("reason is not null").select("sample_id", "variant_id", "reason"),
        "masked": ph.masked_markers(aligned, fraction, seed),
    }


def validate_score_bundle(models: DataFrame, model_variants: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Violations of a score bundle: (check, key) rows."""
    from varloom.functions.alleles import canonical_snv

    def shaped(df, check, key):
        return df.select(F.lit(check).alias("check"), key.cast("string").alias("key"))

    scope = canonical_snv(*[F.col(c) for c in ("assembly", "chromosome", "reference", "alternate")])
    effect = F.col("effect_allele").isin(F.col("reference"), F.col("alternate"))
    declared = models.select("pgs_id", F.col("declared_variant_count").alias("declared"))
    prepared = model_variants.select("pgs_id").unionByName(exclusions.select("pgs_id"))
    return ck.union(
        shaped(ck.repeated_keys(models, ["pgs_id"], "x"), "duplicate_model", F.col("key")),
        shaped(ck.repeated_keys(model_variants, ["pgs_id", *nz.KEY], "x"), "duplicate_variant", F.col("key")),
        shaped(ck.missing_parents(model_variants, "pgs_id", models, "pgs_id", "x"), "unknown_model", F.col("key")),
        shaped(model_variants.where(~F.coalesce(scope, F.lit(False))), "unsupported_variant", F.col("pgs_id")),
        shaped(model_variants.where(~F.coalesce(effect, F.lit(False))), "effect_allele", F.col("pgs_id")),
        shaped(
            sc.parsed_weights(model_variants).where("weight is null"), "invalid_weight", F.col("pgs_id")
        ),
        shaped(ck.count_mismatches(declared, prepared, ["pgs_id"]), "count_mismatch", F.col("pgs_id")),
    )


def score(
    calls: DataFrame, model_variants: DataFrame, models: DataFrame, requests: DataFrame
) -> dict[str, DataFrame]:
    unknown = ck.missing_parents(requests, "pgs_id", models, "pgs_id", "requested_model")
    ck.require_none(unknown, "requested models absent from bundle")
    weighted = sc.parsed_weights(model_variants)
    rows = sc.alignment(calls, weighted, requests)
    return {
        "alignment": rows,
        "contributions": rows.where("status = 'matched'"),
        "exclusions": rows.where("status = 'excluded'").select("sample_id", "pgs_id", "variant_key", "reason"),
        "results": sc.scores(calls, weighted, models, requests),
    }


def infer_pharmacogenes(
    calls: DataFrame,
    genes: DataFrame,
    loci: DataFrame,
    alleles: DataFrame,
    constraints: DataFrame,
    requests: DataFrame,
    **limits: int,
) -> dict[str, DataFrame]:
    ck.require_none(
        ck.missing_parents(requests, "gene_id", genes, "gene_id", "requested_gene"),
        "requested genes absent from bundle",
    )
    evidence = pgx.locus_evidence(calls, loci, requests)
    bounds = pgx.gene_limits(genes, alleles, loci, **limits)
    needs = pgx.pair_requirements(alleles, constraints, bounds)
    return {
        "locus_evidence": evidence,
        "diplotype_candidates": pgx.diplotype_candidates(evidence, needs, bounds, requests),
        "gene_evaluability": pgx.gene_outcomes(evidence, needs, bounds, requests),
    }


def validate_pedigree(members: DataFrame, edges: DataFrame) -> DataFrame:
    """All pedigree violations, cycles included (iterates with checkpoints)."""
    plain = fm.pedigree_violations(members, edges)
    cycles = fm.cycle_edges(edges, cut).select(
        F.lit("ancestry_cycle").alias("rule"),
        F.concat_ws("|", "parent_member_id", "child_member_id").alias("key"),
    )
    return plain.unionByName(cycles)


def analyze_family(
    calls: DataFrame, members: DataFrame, edges: DataFrame, variants: DataFrame
) -> dict[str, DataFrame]:
    ck.require_none(validate_pedigree(members, edges), "pedigree")
    ck.require_none(fm.identity_conflicts(variants), "variant identity")
    evidence = fm.segregation(calls, fm.families(members, edges), variants)
    return {
        "segregation_evidence": evidence.drop("assignments"),
        "transmission_assignments": fm.transmission_assignments(evidence),
        "compatibility_counts": fm.compatibility_counts(evidence),
    }


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> None:
    """Publish ``tables`` as one run under ``root``: each in the order of its first column (its content id), the manifest last."""
    catalog.publish_run(spark, {name: (df, None, df.columns[:1]) for name, df in tables.items()}, root)
