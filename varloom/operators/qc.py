"""Assay quality control over raw observations of a cohort."""

from pyspark.sql import DataFrame, Window, functions as F

from varloom import vocab
from varloom.functions.tokens import recognized_chromosome
from varloom.operators.materialize import stored
from varloom.operators.scale import listed, previous_value

RECORD = ["source_marker_id", "source_chromosome", "source_position", "raw_genotype"]
LINE_BUCKET = 65536


def _n(condition=None):
    return F.count(F.lit(1)) if condition is None else F.count_if(condition)


def chromosome_qc(observations: DataFrame) -> DataFrame:
    """Counts, call rate and position span per sample and source chromosome."""
    return (
        observations.groupBy("sample_id", "source_chromosome")
        .agg(
            _n().alias("record_count"),
            _n(F.col("call_status") == "called").alias("called_count"),
            _n(F.col("call_status") == "no_call").alias("no_call_count"),
            F.min("source_position").alias("min_source_position"),
            F.max("source_position").alias("max_source_position"),
        )
        .withColumn("call_rate", F.col("called_count") / F.col("record_count"))
    )


def record_groups(observations: DataFrame) -> DataFrame:
    """One row per distinct source record with its multiplicity.

    This is the only grouping of the full data; marker- and coordinate-level
    duplicate counts roll up from it.
    """
    return observations.groupBy("sample_id", *RECORD).agg(_n().alias("n"))


def marker_groups(records: DataFrame) -> DataFrame:
    return records.groupBy("sample_id", "source_marker_id").agg(
        F.sum("n").alias("n"), _n().alias("distinct_records")
    )


def coordinate_groups(records: DataFrame) -> DataFrame:
    return records.groupBy("sample_id", "source_chromosome", "source_position").agg(
        F.sum("n").alias("n")
    )


def out_of_order(observations: DataFrame, width: int = LINE_BUCKET) -> DataFrame:
    """Records whose position is below the previous one of the same chromosome token."""
    slim = observations.select(
        "sample_id", "source_chromosome", "source_line_number", "source_position"
    )
    prior = previous_value(
        slim,
        ["sample_id", "source_chromosome"],
        "source_line_number",
        "source_position",
        width,
        "previous_position",
    )
    return prior.where(F.col("source_position") < F.col("previous_position"))


_COUNTERS = (
    "parsed_record_count",
    "called_record_count",
    "no_call_record_count",
    "conventional_two_acgt_allele_calls",
    "lexical_homozygous_acgt_calls",
    "lexical_heterozygous_acgt_calls",
    "single_allele_tokens",
    "other_called_tokens",
    "unrecognized_chromosome_token_count",
    "duplicate_marker_id_count",
    "duplicate_coordinate_count",
    "exact_duplicate_record_count",
    "conflicting_duplicate_marker_count",
    "out_of_order_record_count",
    "malformed_record_count",
    "invalid_position_count",
)


def assay_qc(observations: DataFrame, malformed: DataFrame | None = None) -> DataFrame:
    """Per-sample assay summary.

    Every part delivers partial counters per sample; one final sum merges them,
    so no per-sample join is needed and missing parts count as zero.
    """
    category, zygosity = F.col("lexical_category"), F.col("lexical_zygosity")
    basic = observations.groupBy("sample_id").agg(
        _n().alias("parsed_record_count"),
        _n(F.col("call_status") == "called").alias("called_record_count"),
        _n(F.col("call_status") == "no_call").alias("no_call_record_count"),
        _n((category == "two_allele_token") & zygosity.isNotNull()).alias(
            "conventional_two_acgt_allele_calls"
        ),
        _n(zygosity == "homozygous_lexical").alias("lexical_homozygous_acgt_calls"),
        _n(zygosity == "heterozygous_lexical").alias("lexical_heterozygous_acgt_calls"),
        _n(category == "single_allele_token").alias("single_allele_tokens"),
        _n(category == "other_token").alias("other_called_tokens"),
        _n(~recognized_chromosome(F.col("source_chromosome"))).alias(
            "unrecognized_chromosome_token_count"
        ),
    )
    records = record_groups(observations)
    markers = marker_groups(records)
    extra = F.col("n") - 1
    parts = [
        basic,
        records.groupBy("sample_id").agg(F.sum(extra).alias("exact_duplicate_record_count")),
        markers.groupBy("sample_id").agg(
            F.sum(extra).alias("duplicate_marker_id_count"),
            F.sum(F.when(F.col("distinct_records") > 1, extra).otherwise(0)).alias(
                "conflicting_duplicate_marker_count"
            ),
        ),
        coordinate_groups(records)
        .groupBy("sample_id")
        .agg(F.sum(extra).alias("duplicate_coordinate_count")),
        out_of_order(observations)
        .groupBy("sample_id")
        .agg(_n().alias("out_of_order_record_count")),
    ]
    if malformed is not None:
        parts.append(
            malformed.groupBy("sample_id").agg(
                _n().alias("malformed_record_count"),
                _n(F.col("reason_code") == "INVALID_POSITION").alias("invalid_position_count"),
            )
        )
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    present = [c for c in _COUNTERS if c in merged.columns]
    summed = merged.groupBy("sample_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in present],
        *[F.lit(0).cast("bigint").alias(c) for c in _COUNTERS if c not in present],
    )
    return summed.withColumn(
        "call_rate",
        F.when(
            F.col("parsed_record_count") > 0,
            F.col("called_record_count") / F.col("parsed_record_count"),
        ),
    )


def finding_groups(observations: DataFrame) -> DataFrame:
    """Duplicate groups that are findings: code, group key and distinct line statistics."""
    records = observations.groupBy("sample_id", *RECORD).agg(
        _n().alias("n"),
        F.min("source_line_number").alias("first_line"),
        F.max("source_line_number").alias("last_line"),
    )
    lines = [F.min("first_line").alias("first_line"), F.max("last_line").alias("last_line")]
    markers = records.groupBy("sample_id", "source_marker_id").agg(
        F.sum("n").alias("n"), _n().alias("distinct_records"), *lines
    )
    places = records.groupBy("sample_id", "source_chromosome", "source_position").agg(
        F.sum("n").alias("n"), *lines
    )

    def shaped(df, code):
        keys = [
            F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c)
            for c in RECORD
        ]
        return df.select(
            "sample_id",
            F.lit(code).alias("code"),
            *keys,
            F.col("n").alias("related_line_count"),
            "first_line",
            "last_line",
        )

    return (
        shaped(markers.where("distinct_records > 1"), "CONFLICTING_DUPLICATE_MARKER")
        .unionByName(shaped(markers.where("n > 1"), "DUPLICATE_MARKER_ID"))
        .unionByName(shaped(places.where("n > 1"), "DUPLICATE_COORDINATE"))
        .unionByName(shaped(records.where("n > 1"), "EXACT_DUPLICATE_RECORD"))
    )


def line_findings(
    observations: DataFrame,
    malformed: DataFrame | None = None,
    metadata: DataFrame | None = None,
) -> DataFrame:
    """Findings about a single line (or about the whole source when the line is NULL)."""
    out = observations.where(~recognized_chromosome(F.col("source_chromosome"))).select(
        "sample_id", F.lit("UNRECOGNIZED_CHROMOSOME_TOKEN").alias("code"), "source_line_number"
    )
    out = out.unionByName(
        out_of_order(observations).select(
            "sample_id", F.lit("OUT_OF_ORDER_RECORD").alias("code"), "source_line_number"
        )
    )
    out = out.withColumn("detail", F.lit(None).cast("string"))
    if malformed is not None:
        out = out.unionByName(
            malformed.select(
                "sample_id",
                F.lit("MALFORMED_RECORD").alias("code"),
                "source_line_number",
                F.col("safe_explanation").alias("detail"),
            )
        )
    if metadata is not None:
        out = out.unionByName(
            metadata.where("build_provenance = 'unknown'").select(
                "sample_id",
                F.lit("BUILD_METADATA_ABSENT").alias("code"),
                F.lit(None).cast("bigint").alias("source_line_number"),
                F.lit(None).cast("string").alias("detail"),
            )
        )
    return out


def _severity(code):
    out = F.lit("warning")
    for severity in ("info", "error"):
        codes = [c for c, (s, _) in vocab.FINDINGS.items() if s == severity]
        out = F.when(code.isin(*codes), severity).otherwise(out)
    return out


def _message(code, marker, detail):
    out = detail
    for name, (_, message) in vocab.FINDINGS.items():
        if message is None:
            continue
        head, _, tail = message.partition("{}")
        text = F.concat(F.lit(head), marker, F.lit(tail)) if tail else F.lit(message)
        out = F.when(code == name, text).otherwise(out)
    return out


def findings(
    observations: DataFrame,
    malformed: DataFrame | None = None,
    metadata: DataFrame | None = None,
) -> DataFrame:
    """One row per issue.  Lines of a group finding are in :func:`finding_lines`."""
    null_text, null_long = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    # stored: groups, tokens and order each read the numbered lines, whose numbering is a shuffle of all of them
    observations = stored(observations.select("sample_id", *RECORD, "source_line_number"), "observations")
    grouped = finding_groups(observations).select(
        "sample_id",
        "code",
        null_long.alias("source_line_number"),
        F.col("source_marker_id"),
        F.col("source_chromosome"),
        F.col("source_position"),
        F.col("raw_genotype"),
        "related_line_count",
        "first_line",
        "last_line",
        null_text.alias("detail"),
    )
    single = line_findings(observations, malformed, metadata).select(
        "sample_id",
        "code",
        F.col("source_line_number").cast("bigint").alias("source_line_number"),
        *[null_text.alias(c) for c in RECORD],
        F.lit(0).cast("bigint").alias("related_line_count"),
        null_long.alias("first_line"),
        null_long.alias("last_line"),
        "detail",
    )
    code = F.col("code")
    return (
        grouped.unionByName(single)
        .withColumn("severity", _severity(code))
        .withColumn("message", _message(code, F.col("source_marker_id"), F.col("detail")))
        .drop("detail")
    )


_LEVELS = {
    "CONFLICTING_DUPLICATE_MARKER": ["source_marker_id"],
    "DUPLICATE_MARKER_ID": ["source_marker_id"],
    "DUPLICATE_COORDINATE": ["source_chromosome", "source_position"],
    "EXACT_DUPLICATE_RECORD": RECORD,
}


def _sharing(lines: DataFrame, keys: list[str]) -> DataFrame:
    """The lines that share ``keys`` with another line of their sample, as a stored table: whole groups of more than one line."""
    known = lines.where(" and ".join(f"{c} is not null" for c in ("sample_id", *keys)))
    counted = known.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("sample_id", *keys)))
    return stored(counted.where("_n > 1").drop("_n"), "sharing")


def finding_lines(observations: DataFrame) -> DataFrame:
    """Every (finding, related line) pair in long form; complete at any group size.

    All lines meet twice, by marker and by place, to leave out those that share neither; findings and their joins see the rest.
    """
    # stored: both meetings read the numbered lines, whose numbering is a shuffle of all of them
    lines = stored(observations.select("sample_id", *RECORD, "source_line_number"), "lines")
    marker, place = ("source_marker_id",), ("source_chromosome", "source_position")
    # equal records share their marker
    shared = {keys: _sharing(lines, list(keys)) for keys in (marker, place)}
    out = None
    # codes with the same key share one join, so the lines are read once per key
    codes = {}
    for code, keys in _LEVELS.items():
        codes.setdefault(tuple(keys), []).append(code)
    for keys, alike in codes.items():
        rows = shared[place if keys == place else marker]
        base = rows.select("sample_id", *[F.col(c).cast("string").alias(c) for c in RECORD], "source_line_number")
        level = finding_groups(rows).where(F.col("code").isin(alike)).select("sample_id", "code", *keys)
        part = base.join(level, ["sample_id", *keys]).select(
            "sample_id",
            "code",
            *[
                F.col(c) if c in keys else F.lit(None).cast("string").alias(c)
                for c in RECORD
            ],
            "source_line_number",
        )
        out = part if out is None else out.unionByName(part)
    return out


def related_lines(observations: DataFrame) -> DataFrame:
    """Complete line list of every duplicate finding: code, its key columns, count and sorted lines."""
    return listed(
        finding_lines(observations),
        ["sample_id", "code", *RECORD],
        F.col("source_line_number"),
        "related_source_line_numbers",
    )
