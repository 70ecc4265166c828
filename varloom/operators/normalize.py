"""Normalisation of raw observations to canonical alleles.

Everything that depends only on the marker (definition choice, strand,
liftover, reference validation) is resolved once per marker and assembly, on
the small side.  The cohort table then needs a single equi-join.
"""

from pyspark.sql import Column, DataFrame, functions as F

from varloom import vocab
from varloom.functions import alleles as al
from varloom.functions.ids import stable_id, variant_id
from varloom.functions.tokens import canonical_assembly, canonical_chromosome

KEY = ["assembly", "chromosome", "position", "reference", "alternate"]


def canonical_definitions(marker_defs: DataFrame) -> DataFrame:
    return marker_defs.select(
        "marker_id",
        canonical_assembly(F.col("assembly")).alias("assembly"),
        canonical_chromosome(F.col("chromosome")).alias("chromosome"),
        F.col("position").cast("bigint").alias("position"),
        F.upper("reference").alias("reference"),
        F.upper("alternate").alias("alternate"),
        "orientation",
        "orientation_authoritative",
        "rsid",
    )


def reference_bases(
    sites: DataFrame, tiles: DataFrame, tile_width: int, chromosome: str, position: str, length: Column
) -> DataFrame:
    """Add ``bases``: the reference substring of each site, NULL when out of range.

    A site asks for the tiles it spans (one, or a few for long alleles), so the
    lookup is an equi-join on (contig, tile).
    """
    start = F.col(position) - 1
    first = F.floor(start / tile_width)
    last = F.floor((start + length - 1) / tile_width)
    keyed = sites.withColumn("_site", stable_id("site", chromosome, position, length))
    wanted = (
        keyed.where(F.col(position) >= 1)
        .select("_site", F.col(chromosome).alias("contig"), start.alias("_start"), length.alias("_len"),
                first.alias("_first"), last.alias("_last"))
        .dropDuplicates(["_site"])
        .withColumn("tile", F.explode(F.sequence("_first", "_last")))
    )
    named = tiles.select(
        canonical_chromosome(F.col("contig")).alias("contig"),
        F.col("tile").cast("bigint").alias("tile"),
        F.upper("bases").alias("_bases"),
    )
    found = (
        wanted.join(named, ["contig", "tile"])
        .groupBy("_site")
        .agg(
            F.array_sort(F.collect_list(F.struct("tile", "_bases"))).alias("_tiles"),
            F.first("_start").alias("_start"),
            F.first("_len").alias("_len"),
            F.first("_first").alias("_first"),
            F.first("_last").alias("_last"),
        )
        .where(F.size("_tiles") == F.col("_last") - F.col("_first") + 1)
        .select(
            "_site",
            F.array_join(F.transform("_tiles", lambda t: t["_bases"]), "")
            .substr((F.col("_start") - F.col("_first") * tile_width + 1).cast("int"), F.col("_len").cast("int"))
            .alias("bases"),
            "_len",
        )
        .where(F.length("bases") == F.col("_len"))
        .select("_site", "bases")
    )
    return keyed.join(found, "_site", "left").drop("_site")


def liftover_targets(liftover: DataFrame) -> DataFrame:
    """Candidate count and (only meaningful for one candidate) target per source coordinate."""
    return (
        liftover.select(
            canonical_chromosome(F.col("chromosome")).alias("lift_chromosome"),
            F.col("pos0").cast("bigint").alias("lift_pos0"),
            F.struct(
                canonical_chromosome(F.col("cand_chromosome")).alias("chromosome"),
                (F.col("cand_pos0") + 1).cast("bigint").alias("position"),
            ).alias("t"),
        )
        .groupBy("lift_chromosome", "lift_pos0")
        .agg(F.count(F.lit(1)).alias("lift_count"), F.min("t").alias("target"))
    )


def resolve_markers(
    marker_defs: DataFrame,
    tiles: DataFrame,
    tile_width: int,
    liftover: DataFrame | None = None,
    target: str = vocab.TARGET_ASSEMBLY,
) -> DataFrame:
    """One row per (marker, source assembly) with outcome, reason and canonical target."""
    defs = canonical_definitions(marker_defs)
    any_def = defs.groupBy("marker_id").agg(F.count(F.lit(1)).alias("definition_count"))
    per_build = (
        defs.where(F.col("assembly").isNotNull())
        .withColumnRenamed("assembly", "source_assembly")
        .groupBy("marker_id", "source_assembly")
        .agg(
            F.count(F.lit(1)).alias("build_count"),
            F.min(
                F.struct(
                    "chromosome", "position", "reference", "alternate", "orientation",
                    "orientation_authoritative", "rsid",
                )
            ).alias("d"),
        )
    )
    builds = F.array(*[F.lit(a) for a in vocab.ASSEMBLY_ALIASES])
    base = (
        any_def.withColumn("source_assembly", F.explode(builds))
        .join(per_build, ["marker_id", "source_assembly"], "left")
        .withColumn("build_count", F.coalesce("build_count", F.lit(0)))
    )
    one = F.col("build_count") == 1
    base = base.select(
        "marker_id",
        "source_assembly",
        "definition_count",
        "build_count",
        *[
            F.when(one, F.col("d." + c)).alias(c)
            for c in (
                "chromosome", "position", "reference", "alternate", "orientation",
                "orientation_authoritative", "rsid",
            )
        ],
    )
    ref, alt, strand = F.col("reference"), F.col("alternate"), F.col("orientation")
    early = (
        F.when(F.col("build_count") == 0, "MARKER_DEFINITION_ASSEMBLY_MISMATCH")
        .when(F.col("build_count") > 1, "MARKER_DEFINITION_CONFLICT")
        .when(~al.supported_alleles(ref, alt), "UNSUPPORTED_ALLELE_REPRESENTATION")
        .when(
            ~F.col("orientation_authoritative") | strand.isin("unknown", "ambiguous"),
            F.when(al.palindromic(ref, alt), "PALINDROMIC_AMBIGUITY").otherwise("STRAND_UNRESOLVED"),
        )
    )
    base = base.withColumn("early", early)
    lifts = (F.col("source_assembly") != target) & F.col("early").isNull()
    if liftover is None:
        base = base.withColumns(
            {
                "lift_count": F.lit(None).cast("bigint"),
                "target": F.lit(None).cast("struct<chromosome:string,position:bigint>"),
            }
        )
        lifted = F.when(lifts, "unsupported")
    else:
        base = base.join(
            liftover_targets(liftover),
            (F.col("source_assembly") != target)
            & (F.col("chromosome") == F.col("lift_chromosome"))
            & (F.col("position") - 1 == F.col("lift_pos0")),
            "left",
        )
        lifted = F.when(
            lifts,
            F.when(F.col("lift_count").isNull(), "failed")
            .when(F.col("lift_count") > 1, "ambiguous")
            .otherwise("success"),
        )
    base = base.withColumn("liftover_status", F.coalesce(lifted, F.lit("not_required")))
    direct = (F.col("source_assembly") == target) & F.col("early").isNull()
    success = F.col("liftover_status") == "success"
    placed = base.withColumns(
        {
            "target_chromosome": F.when(direct, F.col("chromosome")).when(
                success, F.col("target.chromosome")
            ),
            "target_position": F.when(direct, F.col("position")).when(
                success, F.col("target.position")
            ),
        }
    )
    checked = reference_bases(
        placed, tiles, tile_width, "target_chromosome", "target_position", F.length("reference")
    )
    tried = F.col("target_position").isNotNull()
    match = tried & F.coalesce(F.col("bases") == ref, F.lit(False))
    status = F.col("liftover_status")
    reason = (
        F.when(F.col("early").isNotNull(), F.col("early"))
        .when(status == "unsupported", "NO_LIFTOVER_RESOURCE")
        .when(status == "failed", "NO_LIFTOVER_CANDIDATE")
        .when(status == "ambiguous", "MULTIPLE_LIFTOVER_CANDIDATES")
        .when(~match, "TARGET_REF_MISMATCH")
    )
    outcome = (
        F.when(F.col("reason").isNull(), "mapped")
        .when(
            F.col("reason").isin(
                "MARKER_DEFINITION_ASSEMBLY_MISMATCH", "UNSUPPORTED_ALLELE_REPRESENTATION"
            ),
            "unsupported",
        )
        .when(F.col("reason") == "TARGET_REF_MISMATCH", "failed")
        .when(F.col("reason").isin("NO_LIFTOVER_RESOURCE", "NO_LIFTOVER_CANDIDATE"), "unmapped")
        .otherwise("ambiguous")
    )
    mapped = F.col("outcome") == "mapped"
    return (
        checked.withColumn("reason", reason)
        .withColumn("outcome", outcome)
        .select(
            "marker_id",
            "source_assembly",
            "definition_count",
            "build_count",
            "outcome",
            "reason",
            F.coalesce("orientation", F.lit("unknown")).alias("strand_transform"),
            "liftover_status",
            F.when(match, "match").when(tried, "mismatch").otherwise("not_attempted").alias(
                "reference_validation"
            ),
            "target_chromosome",
            "target_position",
            "reference",
            "alternate",
            "rsid",
            F.when(
                mapped,
                variant_id(
                    F.lit(target), "target_chromosome", "target_position", "reference", "alternate"
                ),
            ).alias("variant_id"),
            F.when(F.col("reason") == "MARKER_DEFINITION_CONFLICT", F.col("build_count"))
            .when(F.col("reason").isin("PALINDROMIC_AMBIGUITY", "STRAND_UNRESOLVED"), 1)
            .otherwise(F.coalesce("lift_count", F.lit(0)) * lifts.cast("int"))
            .alias("candidate_count"),
        )
    )


def observation_reference() -> Column:
    return stable_id(
        "obs",
        "ingestion_run_id",
        "source_line_number",
        "sample_id",
        "source_marker_id",
        "source_chromosome",
        "source_position",
        "raw_genotype",
    )


def map_observations(
    observations: DataFrame, resolved: DataFrame, target: str = vocab.TARGET_ASSEMBLY
) -> DataFrame:
    """Every observation with its mapping outcome; one left join on (marker, assembly)."""
    known = observations.withColumn(
        "source_assembly", canonical_assembly(F.col("source_build"))
    )
    joined = known.join(
        resolved.withColumnRenamed("marker_id", "source_marker_id"),
        ["source_marker_id", "source_assembly"],
        "left",
    )
    absent = F.col("outcome").isNull()
    unknown = F.col("source_assembly").isNull()
    return joined.withColumns(
        {
            "reason": F.when(unknown, "MISSING_OR_UNKNOWN_BUILD")
            .when(absent, "MARKER_DEFINITION_ABSENT")
            .otherwise(F.col("reason")),
            "outcome": F.coalesce("outcome", F.lit("unmapped")),
            "strand_transform": F.coalesce("strand_transform", F.lit("unknown")),
            "liftover_status": F.coalesce("liftover_status", F.lit("not_required")),
            "reference_validation": F.coalesce("reference_validation", F.lit("not_attempted")),
            "candidate_count": F.coalesce("candidate_count", F.lit(0)),
            "liftover_required": ~unknown & (F.col("source_assembly") != target),
            "target_assembly": F.lit(target),
        }
    )


def mapped_alleles() -> Column:
    """Token alleles on the canonical strand; NULL unless mapped, called and of fitting length."""
    strand = F.col("strand_transform")
    usable = (F.col("outcome") == "mapped") & (F.col("call_status") == "called")
    return F.when(
        usable,
        F.transform(
            al.token_alleles(F.col("raw_genotype"), F.length("reference")),
            lambda a: al.to_canonical_strand(a, strand),
        ),
    )


def mapping_rows(mapped: DataFrame) -> DataFrame:
    """The published mapping table."""
    ref = observation_reference()
    return mapped.select(
        stable_id("map", ref).alias("mapping_id"),
        ref.alias("observation_reference"),
        "sample_id",
        "source_line_number",
        "outcome",
        "reason",
        F.col("source_build").alias("source_assembly_token"),
        F.col("source_assembly").alias("resolved_source_assembly"),
        "source_chromosome",
        "source_position",
        "target_assembly",
        "target_chromosome",
        "target_position",
        "variant_id",
        "strand_transform",
        "liftover_required",
        "liftover_status",
        "reference_validation",
        "candidate_count",
        F.coalesce(mapped_alleles(), F.array().cast("array<string>")).alias(
            "source_to_canonical_alleles"
        ),
    )


def canonical_genotypes(mapped: DataFrame) -> DataFrame:
    """Called genotypes whose alleles all belong to the variant's REF/ALT set."""
    ref, alt = F.col("reference"), F.col("alternate")
    kept = (
        mapped.withColumn("alleles", mapped_alleles())
        .where(F.col("alleles").isNotNull())
        .where(F.forall("alleles", lambda a: (a == ref) | (a == alt)))
    )
    obs = observation_reference()
    return kept.select(
        stable_id("gt", obs, "variant_id", F.array_join("alleles", "/")).alias("genotype_id"),
        obs.alias("observation_reference"),
        F.col("ingestion_run_id").alias("normalization_run_id"),
        "sample_id",
        "variant_id",
        "alleles",
        F.size("alleles").alias("ploidy"),
        al.count_allele(F.col("alleles"), alt).alias("alt_count"),
        F.lit("called").alias("call_status"),
        F.col("target_assembly").alias("assembly"),
        F.col("target_chromosome").alias("chromosome"),
        F.col("target_position").alias("position"),
        "reference",
        "alternate",
    )


def variants(resolved: DataFrame, target: str = vocab.TARGET_ASSEMBLY) -> DataFrame:
    """Canonical variants reachable from the marker definitions (one row per 5-part key)."""
    return (
        resolved.where("outcome = 'mapped'")
        .groupBy(
            "variant_id",
            F.lit(target).alias("assembly"),
            F.col("target_chromosome").alias("chromosome"),
            F.col("target_position").alias("position"),
            "reference",
            "alternate",
        )
        .agg(F.min("rsid").alias("rsid"))
    )


def marker_candidates(
    marker_defs: DataFrame, resolved: DataFrame, liftover: DataFrame | None = None
) -> DataFrame:
    """Candidate coordinates per (marker, source assembly), before fan-out to observations."""
    defs = canonical_definitions(marker_defs).withColumnRenamed("assembly", "source_assembly")
    keyed = resolved.select("marker_id", "source_assembly", "reason", "liftover_status")
    from_defs = (
        keyed.where(
            F.col("reason").isin(
                "MARKER_DEFINITION_CONFLICT", "PALINDROMIC_AMBIGUITY", "STRAND_UNRESOLVED"
            )
        )
        .join(defs, ["marker_id", "source_assembly"])
        .select(
            "marker_id", "source_assembly", F.col("chromosome").alias("cand_chromosome"),
            F.col("position").alias("cand_position"),
            F.concat_ws("/", "reference", "alternate", "orientation").alias("cand_detail"),
        )
    )
    if liftover is None:
        return from_defs
    lifted = liftover.select(
        canonical_chromosome(F.col("chromosome")).alias("chromosome"),
        (F.col("pos0") + 1).cast("bigint").alias("position"),
        canonical_chromosome(F.col("cand_chromosome")).alias("cand_chromosome"),
        (F.col("cand_pos0") + 1).cast("bigint").alias("cand_position"),
    )
    from_lift = (
        keyed.where(F.col("liftover_status").isin("success", "ambiguous"))
        .join(defs, ["marker_id", "source_assembly"])
        .join(lifted, ["chromosome", "position"])
        .select(
            "marker_id", "source_assembly", "cand_chromosome", "cand_position",
            F.lit("liftover").alias("cand_detail"),
        )
    )
    return from_defs.unionByName(from_lift)


def mapping_candidates(mapped: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row per observation and candidate coordinate."""
    ref = observation_reference()
    return (
        mapped.where("candidate_count > 0")
        .join(
            candidates.withColumnRenamed("marker_id", "source_marker_id"),
            ["source_marker_id", "source_assembly"],
        )
        .select(
            stable_id("cand", ref, "cand_chromosome", "cand_position", "cand_detail").alias(
                "candidate_id"
            ),
            ref.alias("observation_reference"),
            F.col("ingestion_run_id").alias("normalization_run_id"),
            "sample_id",
            "source_marker_id",
            F.col("cand_chromosome").alias("chromosome"),
            F.col("cand_position").alias("position"),
        )
    )


_QC_DIMENSIONS = {
    "outcomes": "outcome",
    "reasons": "reason",
    "strand_transformations": "strand_transform",
    "liftover": "liftover_status",
    "reference_validation": "reference_validation",
    "source_chromosomes": "source_chromosome",
    "call_state": "call_status",
}


def normalization_qc(mapped: DataFrame) -> DataFrame:
    """Histograms of every mapping dimension in one pass (grouping sets over a pre-count)."""
    columns = list(_QC_DIMENSIONS.values())
    counted = mapped.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    stacked = counted.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("dimension"), F.col(c).alias("value"))
                    for name, c in _QC_DIMENSIONS.items()
                ]
            )
        ).alias("kv"),
        "n",
    )
    return (
        stacked.select("kv.dimension", "kv.value", "n")
        .where("value is not null")
        .groupBy("dimension", "value")
        .agg(F.sum("n").alias("n"))
    )
