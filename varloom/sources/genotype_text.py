"""Tab-separated genotype text files: scan, malformed routing, build detection."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from varloom import vocab
from varloom.functions.tokens import canonical_assembly, canonical_chromosome, classify
from varloom.sources.lines import scan_lines, source_sample


def parse_lines(lines: DataFrame) -> DataFrame:
    """Kind, columns and malformed reason of each (source_uri, line_number, value)."""
    columns = F.split("value", "\t")
    position = F.when(
        columns[2].rlike(r"^\s*[+-]?\d+\s*$"), F.trim(columns[2]).try_cast("bigint")
    )
    kind = (
        F.when(F.col("value").rlike(r"(?U)^\s*$"), "blank")
        .when(F.col("value").startswith("#"), "comment")
        .otherwise("data")
    )
    rows = lines.withColumns({"kind": kind, "columns": columns})
    reason = F.when(
        F.col("kind") == "data",
        F.when(F.size("columns") != 4, "INVALID_COLUMN_COUNT").when(
            F.coalesce(position, F.lit(0)) <= 0, "INVALID_POSITION"
        ),
    )
    return rows.withColumns({"position": position, "reason_code": reason})


def scan(
    spark: SparkSession, paths, sources: DataFrame | None = None, run_id: str = "ingest"
) -> DataFrame:
    """Parsed lines with their sample.

    ``sources`` maps source_uri to sample_id (rows without a match keep NULL).  Without it every file is a sample of its own,
    named by its stem and the digest of its full location, so equal names in different folders stay apart.
    """
    parsed = parse_lines(scan_lines(spark, paths))
    if sources is None:
        named = parsed.withColumn("sample_id", source_sample("source_uri"))
    else:
        named = parsed.join(sources.select("source_uri", "sample_id"), "source_uri", "left")
    return named.withColumn("ingestion_run_id", F.lit(run_id))


def observations(parsed: DataFrame) -> DataFrame:
    good = parsed.where("kind = 'data' and reason_code is null")
    return classify(
        good.select(
            "sample_id",
            F.col("line_number").alias("source_line_number"),
            F.col("columns")[0].alias("source_marker_id"),
            F.col("columns")[1].alias("source_chromosome"),
            F.col("position").alias("source_position"),
            F.col("columns")[3].alias("raw_genotype"),
            "ingestion_run_id",
        )
    )


def malformed(parsed: DataFrame) -> DataFrame:
    code = F.col("reason_code")
    text = F.lit(None).cast("string")
    for name, explanation in vocab.MALFORMED_REASONS.items():
        text = F.when(code == name, explanation).otherwise(text)
    return parsed.where("reason_code is not null").select(
        "sample_id",
        F.col("line_number").alias("source_line_number"),
        "reason_code",
        text.alias("safe_explanation"),
    )


def require_well_formed(parsed: DataFrame) -> None:
    """Strict mode: fail at the lowest malformed line (reads one row per call)."""
    bad = malformed(parsed).orderBy("source_line_number", "sample_id").limit(1).collect()
    if bad:
        row = bad[0]
        raise ValueError(
            f"{row['sample_id']} line {row['source_line_number']}: {row['safe_explanation']}"
        )


def source_metadata(parsed: DataFrame, build_override: str | None = None) -> DataFrame:
    """Line counts and the resolved build per source (override, declared, else UNKNOWN)."""
    comment = F.col("kind") == "comment"
    token = F.when(comment, F.regexp_extract("value", vocab.BUILD_PATTERN, 1))
    declares = F.when(token != "", F.col("line_number"))
    counted = parsed.groupBy("source_uri", "sample_id").agg(
        F.count(F.lit(1)).alias("physical_line_count"),
        F.count_if(comment).alias("comment_line_count"),
        F.count_if(F.col("kind") == "blank").alias("blank_line_count"),
        F.count_if(F.col("kind") == "data").alias("data_line_count"),
        F.min_by(token, declares).alias("declared_build"),
    )
    override = F.lit(build_override)
    return counted.withColumns(
        {
            "resolved_build": F.coalesce(override, "declared_build", F.lit("UNKNOWN")),
            "build_provenance": F.when(override.isNotNull(), "user_override")
            .when(F.col("declared_build").isNotNull(), "vendor_declared")
            .otherwise("unknown"),
        }
    )


def with_build(obs: DataFrame, metadata: DataFrame) -> DataFrame:
    """Attach each sample's resolved build as ``source_build``."""
    builds = metadata.select("sample_id", F.col("resolved_build").alias("source_build"))
    return obs.join(builds, "sample_id", "left")


def source_markers(parsed: DataFrame) -> DataFrame:
    """Identifiers and coordinates only; genotype tokens are not carried."""
    return parsed.where("kind = 'data' and reason_code is null").select(
        "sample_id",
        F.col("columns")[0].alias("marker_id"),
        canonical_chromosome(F.col("columns")[1]).alias("chromosome"),
        "position",
    )


def unsupported_builds(metadata: DataFrame) -> DataFrame:
    """Sources whose build does not resolve to a supported assembly."""
    return metadata.where(canonical_assembly(F.col("resolved_build")).isNull()).select(
        "sample_id", "resolved_build"
    )
