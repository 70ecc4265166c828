"""Publication of runs: typed, sorted, staged tables, artifact inventory, run catalog."""

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from varloom.functions.ids import stable_id
from varloom.sources.lines import MEMBER

MANIFEST = "_manifest"
#: Table of the tables of a run: it lies beside them and is an artifact like any other.
TABLES = "_tables"
#: Bytes a published file aims at, by the default sizes of its column types.
FILE_BYTES = 256 << 20
#: Spark reads a file to be digested as one value, which holds at most 2^31 - 1 bytes.
DIGEST_BYTES = (1 << 31) - 1

INVENTORY_SCHEMA = "artifact string, sha256 string, byte_size bigint"
TABLES_SCHEMA = "table_name string, row_count bigint, column_types string, sort_columns string"
CATALOG_SCHEMA = (
    "milestone string, run_id string, subject_id string, path string, "
    "constraints map<string,string>, registered_at timestamp"
)


def column_types(schema: StructType) -> str:
    return ",".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def write_table(
    df: DataFrame, path: str, schema: str | None = None, partition_by=(), sort_by=(), file_bytes: int = FILE_BYTES
) -> int:
    """Write-once Parquet under a declared schema (kept even when there are no rows); returns the number of rows.

    With ``sort_by`` rows are range-partitioned and sorted, so that files follow one another in order: adaptive execution merges small
    ranges by their bytes, and a file is closed at as many rows as ``file_bytes`` hold.
    """
    if schema is not None:
        wanted = StructType.fromDDL(schema)
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])
    spark, shape = df.sparkSession, df.schema
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    row_bytes = max(1, int(df._jdf.schema().defaultSize()))
    writer = df.write.mode("errorifexists").option("maxRecordsPerFile", max(1, file_bytes // row_bytes))
    writer.partitionBy(*partition_by).parquet(path)
    # a scan without columns: it reads footers only
    return spark.read.schema(shape).parquet(path).count()


def publish_run(spark: SparkSession, tables: dict, root: str, file_bytes: int = FILE_BYTES) -> None:
    """Publishes ``tables`` (name: (rows, declared schema or None, sort columns)) as one run under ``root``, which must not exist.

    All is written under a staging name beside ``root``, the table of tables next to last and the manifest, which marks the run
    complete, at the end; then the folder is renamed.  A publication that fails leaves nothing under ``root``.
    """
    fs, target = _file_system(spark, root)
    if fs.exists(target):
        raise ValueError(f"a run is published once: {root} is there already")
    staging = f"{root.rstrip('/')}.staging-{uuid.uuid4().hex}"
    told = []
    for name, (df, schema, sort_by) in tables.items():
        rows = write_table(df, f"{staging}/{name}", schema, sort_by=sort_by, file_bytes=file_bytes)
        shown = StructType.fromDDL(schema) if schema is not None else df.schema
        told.append((name, rows, column_types(shown), ",".join(sort_by)))
    write_table(spark.createDataFrame(told, TABLES_SCHEMA), f"{staging}/{TABLES}", TABLES_SCHEMA, sort_by=["table_name"])
    publish_manifest(spark, staging)
    source = _file_system(spark, staging)[1]
    if fs.exists(target) or not fs.rename(source, target):
        raise ValueError(f"a run is published once: {root} is there already")


def table_mismatches(spark: SparkSession, root: str) -> DataFrame:
    """(artifact, problem) of published tables whose rows, types or order are not the declared ones."""
    declared = spark.read.schema(TABLES_SCHEMA).parquet(f"{root}/{TABLES}").collect()  # one row per table of a run
    found = []
    for t in declared:
        path = f"{root}/{t['table_name']}"
        if not _exists(spark, path):
            found.append((t["table_name"], "table_missing"))
            continue
        df = spark.read.parquet(path)
        if column_types(df.schema) != t["column_types"]:
            found.append((t["table_name"], "column_types_mismatch"))
        if df.count() != t["row_count"]:
            found.append((t["table_name"], "row_count_mismatch"))
        if t["sort_columns"] and _overlaps(df, t["sort_columns"].split(",")):
            found.append((t["table_name"], "order_mismatch"))
    return spark.createDataFrame(found, "artifact string, problem string")


def _overlaps(df: DataFrame, sort_by: list[str]) -> bool:
    """Whether two files of a table share a stretch of the order (both ends alike is allowed)."""
    from pyspark.sql import Window

    ends = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(F.struct(*sort_by)).alias("low"), F.max(F.struct(*sort_by)).alias("high")
    )
    before = F.lag("high").over(Window.orderBy("low", "high"))  # one row per file
    return ends.withColumn("before", before).where("low < before").limit(1).count() > 0


def file_digests(spark: SparkSession, paths) -> DataFrame:
    """(uri, sha256, byte_size) of every file below the paths through Spark's own reader.

    Files of more than ``DIGEST_BYTES`` cannot be one value: their sha256 is NULL, which verification reports as ``not_digested``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*")
        .load(paths)
    )
    # the reader takes the bound on the length, so that no content of longer files is read
    short = files.where(F.col("length") <= DIGEST_BYTES).select(
        F.col("path").alias("uri"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("byte_size")
    )
    long = files.where(F.col("length") > DIGEST_BYTES).select(
        F.col("path").alias("uri"), F.lit(None).cast("string").alias("sha256"), F.col("length").alias("byte_size")
    )
    return short.unionByName(long)


def member_digests(spark: SparkSession, paths) -> DataFrame:
    """(uri, sha256, byte_size) of every source in bundles (see :func:`scan_lines`): the digest is that of its bytes as a file of its own.

    uri is the bundle's, followed by the source's name.  Bundles are split between sources, and a source is read as one value.
    """
    held = spark.read.option("recursiveFileLookup", True).option("lineSep", MEMBER).text(paths).where("value <> ''")
    name = F.substring_index("value", "\n", 1)
    content = F.substr("value", F.char_length(name) + 2)
    return held.select(
        F.concat_ws("/", "_metadata.file_path", name).alias("uri"),
        F.sha2(content, 256).alias("sha256"),
        F.octet_length(content).cast("bigint").alias("byte_size"),
    )


def inventory(spark: SparkSession, root: str, bundled: bool = False) -> DataFrame:
    """Artifacts of a run directory relative to its root (the manifest itself excluded); ``bundled``: sources of its bundles."""
    relative = F.regexp_extract("uri", r"^(?:[a-z0-9]+:)?(?://[^/]*)?" + _quoted(root) + r"/+(.*)$", 1)
    return (
        (member_digests if bundled else file_digests)(spark, root)
        .select(relative.alias("artifact"), "sha256", "byte_size")
        .where(~F.col("artifact").startswith(MANIFEST + "/"))
    )


def _quoted(path: str) -> str:
    bare = path.split("://", 1)[-1] if "://" in path else path.removeprefix("file:")
    bare = bare if bare.startswith("/") else "/" + bare.split("/", 1)[-1]
    return r"\Q" + bare.rstrip("/") + r"\E"


def publish_manifest(spark: SparkSession, root: str) -> None:
    """Record the inventory; written last, its presence marks the run complete."""
    write_table(inventory(spark, root), f"{root}/{MANIFEST}", INVENTORY_SCHEMA)


def artifact_mismatches(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Declared artifacts that are missing or changed, and files nobody declared."""
    d = declared.select("artifact", F.struct("sha256", "byte_size").alias("declared"))
    a = actual.select("artifact", F.struct("sha256", "byte_size").alias("actual"))
    status = (
        F.when(F.col("actual").isNull(), "missing")
        .when(F.col("declared").isNull(), "undeclared")
        .when(F.col("declared.byte_size") != F.col("actual.byte_size"), "size_mismatch")
        .when(F.col("declared.sha256") != F.col("actual.sha256"), "checksum_mismatch")
        .when(F.col("declared.sha256").isNull() | F.col("actual.sha256").isNull(), "not_digested")
    )
    return (
        d.join(a, "artifact", "full")
        .select("artifact", status.alias("problem"))
        .where("problem is not null")
    )


def verify_run(spark: SparkSession, root: str) -> DataFrame:
    declared = spark.read.schema(INVENTORY_SCHEMA).parquet(f"{root}/{MANIFEST}")
    found = artifact_mismatches(declared, inventory(spark, root))
    return found.unionByName(table_mismatches(spark, root)) if _exists(spark, f"{root}/{TABLES}") else found


def new_sources(digests: DataFrame, stored: DataFrame, subject_id: str) -> DataFrame:
    """Files whose content is not stored yet, one row per content (import is idempotent)."""
    fresh = digests.join(stored.select("sha256"), "sha256", "left_anti")
    return fresh.groupBy("sha256", "byte_size").agg(F.min("uri").alias("uri")).withColumn(
        "subject_id", F.lit(subject_id)
    )


def source_conflicts(digests: DataFrame, stored: DataFrame) -> DataFrame:
    """Contents stored under the same digest with another size or subject."""
    s = stored.select("sha256", F.col("byte_size").alias("stored_size"))
    return digests.join(s, "sha256").where(F.col("byte_size") != F.col("stored_size"))


def run_id(milestone: str, *fields: str) -> str:
    """Content-derived run id from scientific inputs."""
    text = "\x1f".join((milestone, *fields))
    return f"{milestone.lower()}-{hashlib.sha256(text.encode()).hexdigest()}"


def register(catalog_path: str, entry: DataFrame) -> None:
    """Append a completed run; the same run id with other content is refused."""
    spark = entry.sparkSession
    row = entry.select(
        "milestone", "run_id", "subject_id", "path", "constraints",
        F.current_timestamp().alias("registered_at"),
    )
    if _exists(spark, catalog_path):
        known = spark.read.schema(CATALOG_SCHEMA).parquet(catalog_path)
        same = known.join(row.select("run_id"), "run_id", "left_semi")
        flat = ["milestone", "run_id", "subject_id", "path", F.to_json("constraints").alias("c")]
        if same.limit(1).count():
            if row.select(*flat).exceptAll(same.select(*flat)).limit(1).count():
                raise ValueError("this run id is in the catalog with other content")
            return
    row.write.mode("append").parquet(catalog_path)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def latest_runs(catalog: DataFrame) -> DataFrame:
    """Newest registered run per milestone."""
    newest = F.max_by(
        F.struct("run_id", "subject_id", "path", "constraints"), F.struct("registered_at", "run_id")
    )
    return catalog.groupBy("milestone").agg(newest.alias("r")).select("milestone", "r.*")


def compatible(constraints: dict[str, str]):
    """Condition: the run's constraint map contains every requested pair."""
    ok = F.lit(True)
    for key, value in constraints.items():
        ok = ok & F.coalesce(F.try_element_at("constraints", F.lit(key)) == value, F.lit(False))
    return ok


def resolve_latest(catalog: DataFrame, milestone: str, constraints: dict[str, str]):
    """The newest run of a milestone, or an error when it is absent or incompatible."""
    rows = (
        latest_runs(catalog.where(F.col("milestone") == milestone))
        .withColumn("ok", compatible(constraints))
        .collect()
    )
    if not rows:
        raise ValueError(f"{milestone}: the catalog holds no run")
    if not rows[0]["ok"]:
        raise ValueError(f"{milestone}: the newest run was made under other constraints than {constraints}")
    return rows[0]
