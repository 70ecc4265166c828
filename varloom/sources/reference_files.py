"""Reference and bundle files: marker JSON, liftover JSON, FASTA, extracts, maps, policies."""

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from varloom import vocab
from varloom.functions.tokens import canonical_chromosome
from varloom.operators.checks import order_violations
from varloom.operators.lookup import parsed_extract
from varloom.operators.scale import filled_forward, running_total
from varloom.sources.lines import scan_lines

MARKER_SCHEMA = (
    "marker_id string, assembly string, chromosome string, position bigint, reference string, "
    "alternate string, orientation string, orientation_authoritative boolean, rsid string"
)


def marker_json(spark: SparkSession, paths) -> DataFrame:
    """Marker definitions from JSON arrays (one file each) or JSON lines."""
    return (
        spark.read.schema(MARKER_SCHEMA)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(paths)
        .withColumn(
            "orientation_authoritative", F.coalesce("orientation_authoritative", F.lit(False))
        )
    )


def liftover_json(spark: SparkSession, paths) -> DataFrame:
    """``{"chrom:pos0": [[chrom, pos0], ...]}`` objects as candidate rows."""
    whole = spark.read.text(paths, wholetext=True)
    entries = F.from_json("value", "map<string,array<array<string>>>", {"mode": "FAILFAST"})
    return liftover_rows(whole.select(F.explode(entries).alias("key", "targets")))


def liftover_lines(spark: SparkSession, paths) -> DataFrame:
    """The same mapping as JSON lines (one or more coordinates per line), read in parallel."""
    entries = F.from_json("value", "map<string,array<array<string>>>", {"mode": "FAILFAST"})
    return liftover_rows(spark.read.text(paths).select(F.explode(entries).alias("key", "targets")))


def liftover_rows(entries: DataFrame) -> DataFrame:
    """(key, targets) entries as 0-based candidate rows."""
    return entries.select("key", F.explode("targets").alias("t")).select(
        canonical_chromosome(F.split("key", ":")[0]).alias("chromosome"),
        F.split("key", ":")[1].cast("bigint").alias("pos0"),
        canonical_chromosome(F.col("t")[0]).alias("cand_chromosome"),
        F.col("t")[1].cast("bigint").alias("cand_pos0"),
    )


def fasta_tiles(spark: SparkSession, paths, width: int = 4096) -> DataFrame:
    """Reference sequence as fixed tiles (contig, tile, bases).

    A contig's name is carried forward from its header line and each line's
    offset is a running sum of line lengths, both cut into line buckets, so one
    long contig is processed by many tasks.
    """
    lines = scan_lines(spark, paths)
    header = F.when(
        F.col("value").startswith(">"),
        canonical_chromosome(F.regexp_extract("value", r"^>(\S*)", 1)),
    )
    named = filled_forward(
        lines.withColumn("header", header), ["source_uri"], "line_number", "header", 65536, "contig"
    )
    bases = (
        named.where("header is null and contig is not null")
        .withColumn("seq", F.upper(F.trim("value")))
        .withColumn("size", F.length("seq").cast("bigint"))
        .where("size > 0")
    )
    placed = running_total(
        bases, ["contig"], F.floor(F.col("line_number") / 65536), ["line_number"], "size", "start"
    )
    first, last = F.floor(F.col("start") / width), F.floor((F.col("start") + F.col("size") - 1) / width)
    pieces = placed.withColumn("tile", F.explode(F.sequence(first, last)))
    skip = F.greatest(F.col("tile") * width - F.col("start"), F.lit(0))
    room = (F.col("tile") + 1) * width - F.col("start") - skip
    piece = F.struct(
        F.col("start").alias("at"),
        F.col("seq").substr((skip + 1).cast("int"), room.cast("int")).alias("bases"),
    )
    return (
        pieces.groupBy("contig", "tile")
        .agg(F.array_sort(F.collect_list(piece)).alias("parts"))
        .select("contig", "tile", F.array_join(F.transform("parts", lambda p: p["bases"]), "").alias("bases"))
    )


def bed_extract(spark: SparkSession, paths) -> DataFrame:
    """BED4+ extract rows, typed, with a violation code for incoherent ones."""
    columns = F.split("value", "\t")
    lines = spark.read.text(paths).where("value <> ''").withColumn("c", columns)
    short = F.size("c") < 7
    named = lines.select(
        *[
            F.get("c", F.lit(i)).alias(n)
            for i, n in enumerate(("chrom", "start0", "end0", "name", "ref", "alt_count", "alts"))
        ],
        short.alias("short"),
    )
    flags = named.where("short").select(
        *[F.lit(None).cast(t).alias(n) for n, t in (
            ("chromosome", "string"), ("position", "bigint"), ("marker_id", "string"),
            ("reference", "string"), ("alternates", "array<string>"),
        )],
        F.lit("INVALID_COLUMN_COUNT").alias("violation"),
    )
    return parsed_extract(named.where("not short").drop("short")).unionByName(flags)


def phasing_sites(spark: SparkSession, paths) -> DataFrame:
    """Site index rows (chromosome, position, ref, alt, ac, an) with a violation code."""
    lines = scan_lines(spark, paths).where("value <> '' and not startswith(value, '#')")
    c = F.split("value", "\t")
    rows = lines.select(
        "source_uri",
        "line_number",
        F.size(c).alias("width"),
        *[F.get(c, F.lit(i)).alias(n) for i, n in enumerate(("chromosome", "p", "reference", "alternate", "a", "n"))],
    )
    number = {k: F.col(k).try_cast("bigint") for k in ("p", "a", "n")}
    bad = (
        F.when(F.col("width") != 6, "INVALID_COLUMN_COUNT")
        .when(number["p"].isNull() | number["a"].isNull() | number["n"].isNull(), "INVALID_NUMBER")
        .when(
            (number["p"] < 1)
            | ~F.col("reference").rlike("^[ACGT]$")
            | ~F.col("alternate").rlike("^[ACGT]$")
            | (F.col("reference") == F.col("alternate"))
            | ~number["a"].between(F.lit(0), number["n"]),
            "INVALID_ALLELE_OR_COUNT",
        )
    )
    return rows.select(
        "source_uri", "line_number", "chromosome", number["p"].alias("position"), "reference",
        "alternate", number["a"].alias("ac"), number["n"].alias("an"), bad.alias("violation"),
    )


def site_order_violations(sites: DataFrame) -> DataFrame:
    """Sites that are not strictly after their predecessor in the file."""
    return order_violations(
        sites, ["source_uri"], "line_number", ["position", "reference", "alternate"]
    )


def genetic_map(spark: SparkSession, paths) -> DataFrame:
    lines = scan_lines(spark, paths).where("trim(value) <> '' and not startswith(value, '#')")
    c = F.split(F.trim("value"), r"\s+")
    return lines.select(
        "source_uri",
        "line_number",
        F.get(c, F.lit(0)).try_cast("bigint").alias("position"),
        F.get(c, F.lit(1)).try_cast("double").alias("cm"),
    )


def genetic_map_violations(points: DataFrame) -> DataFrame:
    """Rules a map breaks: fewer than two points, unsorted, or decreasing cM."""
    few = points.groupBy("source_uri").agg(F.count(F.lit(1)).alias("n")).where("n < 2").select(
        "source_uri", F.lit("fewer_than_two_points").alias("rule")
    )
    unsorted = order_violations(
        points, ["source_uri"], "line_number", ["position", "cm"], strict=False
    ).select("source_uri", F.lit("position_not_sorted").alias("rule"))
    falling = order_violations(points, ["source_uri"], "line_number", ["cm"], strict=False).select(
        "source_uri", F.lit("cm_decreasing").alias("rule")
    )
    broken = points.where("position is null or cm is null").select(
        "source_uri", F.lit("invalid_number").alias("rule")
    )
    return few.unionByName(unsorted).unionByName(falling).unionByName(broken).distinct()


PEDIGREE_SCHEMA = (
    "schema string, family_id string, "
    "members array<struct<member_id:string,subject_id:string,m2_run:string>>, "
    "relationships array<struct<assertion_id:string,parent_member_id:string,"
    "child_member_id:string,source:string,declared_role:string>>, _broken string"
)


def pedigree_json(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, edges, violations) of pedigree descriptors, one JSON document per file."""
    docs = (
        spark.read.schema(PEDIGREE_SCHEMA)
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", "_broken")
        .json(paths)
    )
    members = docs.select("family_id", F.explode("members").alias("m")).select(
        "family_id", "m.member_id", "m.subject_id", F.col("m.m2_run").alias("run_id")
    ).orderBy("family_id", "member_id")
    edges = docs.select("family_id", F.explode("relationships").alias("r")).select(
        "family_id", "r.*"
    ).orderBy("family_id", "child_member_id", "parent_member_id", "assertion_id")
    name = r"^[A-Za-z0-9][A-Za-z0-9._-]{0,127}$"
    bad = (
        docs.where("_broken is not null or members is null or relationships is null")
        .select(F.lit("unreadable_descriptor").alias("rule"), F.col("family_id").alias("key"))
        .unionByName(
            docs.where(
                "members is not null and relationships is not null"
                " and (size(members) = 0 or size(relationships) = 0)"
            ).select(F.lit("empty_pedigree").alias("rule"), F.col("family_id").alias("key"))
        )
        .unionByName(
            docs.where(~F.coalesce(F.col("family_id").rlike(name), F.lit(False))).select(
                F.lit("family_id_pattern").alias("rule"), F.col("family_id").alias("key")
            )
        )
        .unionByName(
            members.where(
                ~F.coalesce(F.col("member_id").rlike(name), F.lit(False))
                | ~F.coalesce(F.col("subject_id").rlike(r"^subject-[0-9]{4,}$"), F.lit(False))
            ).select(F.lit("member_pattern").alias("rule"), F.col("member_id").alias("key"))
        )
        .unionByName(
            edges.where("source is null or source not in ('user_declared', 'project_record')").select(
                F.lit("relationship_source").alias("rule"), F.col("assertion_id").alias("key")
            )
        )
    )
    return members, edges, bad


_POLICY = (
    "schema_version int, version string, term_routes map<string,array<string>>, "
    "classification_type_handling map<string,string>, record_status_behavior map<string,string>, "
    "priority_rules array<struct<rule_id:string,band:string>>, "
    "source_review_status_mappings map<string,string>, tie_breaking array<string>"
)
_TERMS = "transform(flatten(map_values(p.term_routes)), t -> lower(trim(regexp_replace(t, '[ ]+', ' '))))"
_IDS, _BANDS = "transform(p.priority_rules, r -> r.rule_id)", "transform(p.priority_rules, r -> r.band)"


def _names(values) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in sorted(values)) + ")"


def policy_rules() -> list[tuple[str, str]]:
    """(rule, condition under which a parsed policy ``p`` with top-level ``fields`` breaks it)."""
    expected = vocab.DEFAULT_POLICY
    handling = expected["classification_type_handling"]
    same = " and ".join(f"p.classification_type_handling['{k}'] = '{v}'" for k, v in handling.items())
    return [
        ("fields", f"array_sort(fields) <> {_names(expected)}"),
        ("schema_version", "p.schema_version <> 1"),
        ("version_parts", "not p.version rlike '^[0-9]+[.][0-9]+[.][0-9]+$'"),
        ("routes", f"array_sort(map_keys(p.term_routes)) <> {_names(vocab.TERM_ROUTES)}"),
        ("term_in_two_routes", f"size({_TERMS}) <> size(array_distinct({_TERMS}))"),
        ("type_handling", f"not (size(p.classification_type_handling) = {len(handling)} and {same})"),
        ("record_statuses", f"array_sort(map_keys(p.record_status_behavior)) <> {_names(['current', 'replaced', 'deleted', 'unknown'])}"),
        ("record_behaviours", "exists(map_values(p.record_status_behavior), b -> b not in ('active', 'inactive'))"),
        ("gone_records_active", "'active' in (p.record_status_behavior['replaced'], p.record_status_behavior['deleted'])"),
        ("priority_rules", f"size({_IDS}) = 0 or size({_IDS}) <> size(array_distinct({_IDS}))"),
        ("bands", f"array_sort(array_distinct({_BANDS})) <> {_names(vocab.BAND_ORDER)}"),
        ("review_levels", f"size(array_except(map_values(p.source_review_status_mappings), {_names(vocab.REVIEW_LEVELS)})) > 0"),
        ("last_tie_breaker", "try_element_at(p.tie_breaking, -1) <> 'profile_id'"),
    ]


def policy_violations(documents: DataFrame) -> DataFrame:
    """(policy, rule) for every rule that a policy document (JSON text) breaks; what cannot be read breaks its rule."""
    parsed = documents.select(
        "policy", F.from_json("document", _POLICY).alias("p"), F.json_object_keys("document").alias("fields")
    )
    broken = F.array(*[F.when(F.coalesce(F.expr(c), F.lit(True)), F.lit(r)) for r, c in policy_rules()])
    return parsed.select("policy", F.explode(F.array_compact(broken)).alias("rule"))


def load_policy(spark: SparkSession, path: str) -> dict:
    """A review policy document (a few kilobytes), refused when it breaks a rule."""
    documents = spark.read.text(path, wholetext=True).select(F.lit(path).alias("policy"), F.col("value").alias("document"))
    broken = sorted(r["rule"] for r in policy_violations(documents).collect())
    if broken:
        raise ValueError(f"{path}: policy breaks {', '.join(broken)}")
    return json.loads(documents.first()["document"])


def typed_parquet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet rows under a declared schema; missing or differently typed columns fail."""
    from pyspark.sql.types import StructType

    wanted = StructType.fromDDL(schema)
    actual = {f.name: f.dataType for f in spark.read.parquet(path).schema}
    wrong = [
        f.name for f in wanted if f.name not in actual or actual[f.name] != f.dataType
    ]
    if wrong:
        raise ValueError(f"{path}: columns that are missing or of another type: {wrong}")
    return spark.read.schema(wanted).parquet(path)
