"""Text lines with their physical line number, read in parallel inside large files."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: Opens each source of a bundle; its name follows on the same line.
MEMBER = "\x1c"


def scan_lines(spark: SparkSession, paths: str | list[str], bundled: bool = False) -> DataFrame:
    """(source_uri, line_number, value) of every line; LF, CRLF and CR all end a line.

    Files are split as usual; a first light pass counts lines per file block, and
    the running count of earlier blocks gives each block its first line number.
    Text that is not UTF-8 fails.

    ``bundled``: a file holds many small sources one after another, each opened by a line of ``MEMBER`` and its name.  That line
    belongs to no source, numbers start again behind it, and source_uri is the file's followed by the name.  Files are split
    between sources, and a source is read as one value, so it should be far smaller than a task's memory.
    """
    if bundled:
        return _bundled_lines(spark, paths)
    base = spark.read.text(paths)
    raw = base.select(
        F.validate_utf8("value").alias("value"),
        F.col("_metadata.file_path").alias("source_uri"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("serial"),
    )
    before = (
        Window.partitionBy("source_uri")
        .orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = (
        raw.groupBy("source_uri", "block")
        .agg(F.count(F.lit(1)).alias("n"), F.min("serial").alias("first_serial"))
        .select(
            "source_uri",
            "block",
            "first_serial",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        )
    )
    return raw.join(blocks, ["source_uri", "block"]).select(
        "source_uri",
        (F.col("offset") + F.col("serial") - F.col("first_serial") + 1).alias("line_number"),
        "value",
    )


def _bundled_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    base = spark.read.option("lineSep", MEMBER).text(paths)
    # what ends the last line opens no further one
    whole = F.regexp_replace(F.validate_utf8("value"), r"(?:\r\n|\n|\r)\z", "")
    lines = base.where("value <> ''").select(
        F.col("_metadata.file_path").alias("file"), F.split(whole, r"\r\n|\n|\r").alias("lines")
    )
    return lines.select("file", F.col("lines")[0].alias("name"), F.posexplode("lines").alias("line_number", "value")).where(
        "line_number > 0"
    ).select(F.concat_ws("/", "file", "name").alias("source_uri"), F.col("line_number").cast("bigint").alias("line_number"), "value")


def source_sample(uri: str):
    """A sample id for a file without a declared subject: its stem and the digest of its location."""
    # the pattern only ever sees the name: on a whole location it is tried from every character of it, for every line
    stem = F.regexp_extract(F.substring_index(uri, "/", -1), r"([^/]+?)(?:\.[A-Za-z0-9]+)*$", 1)
    return F.concat_ws("-", stem, F.substring(F.sha2(uri, 256), 1, 32))
