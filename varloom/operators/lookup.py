"""Marker resources from rsID extracts: tiered lookup, definitions, cross-build maps."""

from pyspark.sql import DataFrame, functions as F

from varloom import vocab
from varloom.functions.tokens import canonical_chromosome

PLACE = ["marker_id", "chromosome", "position"]
RSID = "^rs[0-9]+$"


def parsed_extract(rows: DataFrame) -> DataFrame:
    """Typed extract rows: 1-based position, upper-case alleles and a violation code.

    Input columns: chrom, start0, end0, name, ref, alt_count, alts (comma list).
    """
    alternates = F.filter(F.split(F.upper("alts"), ","), lambda a: a != "")
    start, end = F.col("start0").try_cast("bigint"), F.col("end0").try_cast("bigint")
    count = F.col("alt_count").try_cast("bigint")
    violation = (
        F.when(start.isNull() | end.isNull() | count.isNull(), "INVALID_COORDINATES")
        .when((end <= start) | (count != F.size(alternates)), "INCOHERENT_ROW")
    )
    extra = [c for c in rows.columns if c == "track"]
    return rows.select(
        *extra,
        canonical_chromosome(F.col("chrom")).alias("chromosome"),
        (start + 1).alias("position"),
        F.col("name").alias("marker_id"),
        F.upper("ref").alias("reference"),
        alternates.alias("alternates"),
        violation.alias("violation"),
    )


def merged_extracts(*extracts: DataFrame) -> DataFrame:
    """Order-independent union of extracts without repeated rows."""
    out = extracts[0]
    for other in extracts[1:]:
        out = out.unionByName(other)
    return out.distinct()


def _tagged(tracks: list[tuple[str, DataFrame]]) -> DataFrame:
    out = None
    for order, (_, rows) in enumerate(tracks):
        part = rows.withColumn("tier_order", F.lit(order))
        out = part if out is None else out.unionByName(part)
    return out


def tiered_lookup(requested: DataFrame, tracks: list[tuple[str, DataFrame]]) -> DataFrame:
    """First tier that returns each requested id, else ``unresolved``.

    Ids of all tiers reduce to one row each (map-side minimum) before they meet
    the request, so a popular id costs one row and every tier is read once.
    """
    names = F.array(*[F.lit(name) for name, _ in tracks])
    first = _tagged([(n, r.select("marker_id")) for n, r in tracks]).groupBy("marker_id").agg(
        F.min("tier_order").alias("tier_order")
    )
    return (
        requested.select("marker_id")
        .distinct()
        .join(first, "marker_id", "left")
        .select(
            "marker_id",
            F.coalesce(F.get(names, F.col("tier_order")), F.lit("unresolved")).alias("tier"),
        )
    )


def tier_records(tiers: DataFrame, tracks: list[tuple[str, DataFrame]]) -> DataFrame:
    """Extract rows of the tier that resolved each id."""
    names = F.array(*[F.lit(name) for name, _ in tracks])
    rows = _tagged(tracks).withColumn("tier", F.get(names, F.col("tier_order")))
    return rows.join(tiers, ["marker_id", "tier"], "left_semi").drop("tier", "tier_order")


def coverage_partition_violations(flags: DataFrame) -> DataFrame:
    """Ids that break returned ⊎ missing = covered, covered ⊎ indeterminate = requested.

    ``flags``: marker_id and booleans requested, covered, returned, missing, indeterminate.
    """
    covered = F.col("returned").cast("int") + F.col("missing").cast("int")
    asked = F.col("covered").cast("int") + F.col("indeterminate").cast("int")
    return flags.where(
        (covered != F.col("covered").cast("int")) | (asked != F.col("requested").cast("int"))
    )


def exact_placements(markers: DataFrame, source: DataFrame) -> DataFrame:
    """Extract rows whose id, chromosome and position equal a requested rs marker."""
    wanted = markers.where(F.col("marker_id").startswith("rs")).select(*PLACE).distinct()
    return source.join(wanted, PLACE, "left_semi")


def valid_alternates():
    """Single-base ACGT alternates that differ from a single-base reference."""
    ref = F.col("reference")
    return F.array_sort(
        F.array_distinct(
            F.filter(
                "alternates", lambda a: a.rlike("^[ACGT]$") & ref.rlike("^[ACGT]$") & (a != ref)
            )
        )
    )


def placements(markers: DataFrame, source: DataFrame) -> DataFrame:
    """Per exactly placed id: number of distinct placements and (when single) the placement.

    One grouping answers both "is it ambiguous" and "which row is accepted".
    """
    rows = exact_placements(markers, source).select(*PLACE, "reference", "alternates").distinct()
    return (
        rows.groupBy("marker_id")
        .agg(
            F.count(F.lit(1)).alias("placements"),
            F.min(F.struct("chromosome", "position", "reference", "alternates")).alias("row"),
        )
        .select("marker_id", "placements", "row.*")
        .withColumn("valid_alts", valid_alternates())
    )


def ambiguous_markers(placed: DataFrame) -> DataFrame:
    """Ids with more than one distinct placement or allele set."""
    return placed.where("placements > 1").select("marker_id", "placements")


def accepted_source(placed: DataFrame) -> DataFrame:
    return placed.where("placements = 1").drop("placements")


def definitions(accepted: DataFrame, source_assembly: str) -> DataFrame:
    return accepted.select(
        "marker_id",
        F.lit(source_assembly).alias("assembly"),
        "chromosome",
        "position",
        "reference",
        F.explode("valid_alts").alias("alternate"),
        F.lit("none").alias("orientation"),
        F.lit(True).alias("orientation_authoritative"),
        F.col("marker_id").alias("rsid"),
    )


def cross_build_map(accepted: DataFrame, target: DataFrame) -> DataFrame:
    """0-based target candidates per 0-based source coordinate for compatible alleles."""
    placed = accepted.where(F.size("valid_alts") > 0).select(
        "marker_id", "chromosome", "position", "reference", "valid_alts"
    )
    other = target.where(F.length("reference") == 1).select(
        "marker_id",
        "reference",
        F.col("chromosome").alias("cand_chromosome"),
        F.col("position").alias("cand_position"),
        F.col("alternates").alias("cand_alternates"),
    )
    return (
        placed.join(other, ["marker_id", "reference"])
        .where(F.arrays_overlap("valid_alts", "cand_alternates"))
        .select(
            "marker_id",
            "chromosome",
            (F.col("position") - 1).alias("pos0"),
            "cand_chromosome",
            (F.col("cand_position") - 1).alias("cand_pos0"),
        )
        .distinct()
    )


def unresolved_markers(markers: DataFrame, source: DataFrame, placed: DataFrame) -> DataFrame:
    """Reason for every requested rsID without a definition."""
    rows = source.groupBy("marker_id").agg(F.count(F.lit(1)).alias("rows"))
    known = placed.select(
        "marker_id",
        F.lit(True).alias("exact"),
        ((F.col("placements") == 1) & (F.size("valid_alts") > 0)).alias("defined"),
    )
    return (
        markers.where(F.col("marker_id").rlike(RSID))
        .join(rows, "marker_id", "left")
        .join(known, "marker_id", "left")
        .where(~F.coalesce("defined", F.lit(False)))
        .select(
            "marker_id",
            F.col("chromosome").alias("source_chromosome"),
            F.col("position").alias("source_coordinate"),
            F.when(F.col("rows").isNull(), "absent")
            .when(F.col("exact").isNull(), "coordinate-incompatible")
            .when(F.col("rows") > 1, "ambiguous")
            .otherwise("unsupported")
            .alias("reason"),
        )
    )


def resource_statistics(
    markers: DataFrame, placed: DataFrame, target: DataFrame, source_assembly: str
) -> DataFrame:
    """Build statistics as (statistic, value) rows."""
    rs = markers.groupBy("marker_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("source_marker_count"),
        F.count_if(F.col("marker_id").startswith("rs")).alias("rsid_marker_count"),
        F.count_if(F.col("marker_id").rlike(RSID)).alias("requested_canonical_rsid_count"),
    )
    one, alts = F.col("placements") == 1, F.size("valid_alts")
    sites = placed.agg(
        F.count_if(one & (alts > 0)).alias("defined_marker_count"),
        F.sum(F.when(one, alts).otherwise(0)).alias("definition_count"),
        F.count_if(one).alias("exact_source_placement_count"),
        F.count_if(~one).alias("ambiguous_marker_count"),
    )
    parts = [rs, sites]
    if source_assembly == "GRCh37":
        crossed = cross_build_map(accepted_source(placed), target).select("marker_id").distinct()
        parts.append(crossed.agg(F.count(F.lit(1)).alias("cross_build_mapped_marker_count")))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    total = merged.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in merged.columns])
    requested, defined = F.col("requested_canonical_rsid_count"), F.col("defined_marker_count")
    exact = F.col("exact_source_placement_count")
    extra = {
        "unsupported_marker_count": F.greatest(exact - defined, F.lit(0)),
        "unresolved_marker_count": requested - defined,
        "unresolved_fraction": (requested - defined) / requested,
        "gross_coverage_observed_fraction": exact / requested,
    }
    named = {**{c: F.col(c) for c in merged.columns}, **extra}
    return total.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(n).alias("statistic"), c.cast("double").alias("value"))
                    for n, c in named.items()
                ]
            )
        ).alias("s")
    ).select("s.statistic", "s.value")


def require_coverage(statistics: DataFrame, minimum: float = vocab.MINIMUM_EXACT_COVERAGE) -> None:
    """Fail when too few requested ids have an exact placement (an action on one row)."""
    row = statistics.where("statistic = 'gross_coverage_observed_fraction'").first()
    if row is None or row["value"] is None or row["value"] < minimum:
        raise ValueError(f"source-definition coverage is below {minimum:.0%}")
