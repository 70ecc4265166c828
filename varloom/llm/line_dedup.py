"""Line deduplication: first occurrences streamed from range-partitioned line digests.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased.  Keys of at least ``min_chars`` code
points that occur in two or more documents stay only in the document with the smallest id.

Digests (128 bits) are partitioned by range and sorted by document and position, so a window streams the first
document of each key.  A key may hold a third of all lines: documents are dealt to ``SALTS`` groups, first occurrences
are streamed per key and group, and only the lines of each group's first document meet in a second pass.  Text is never
shuffled for the decision; what leaves is a run-length coded keep bitmap per document.

Defined cases: null and empty texts are one empty line; a key repeated inside its first document stays everywhere in
it; rows with a null id are one last document; rows that repeat an id and text get equal bitmaps; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varloom.llm.common import ascii_lower, keyed, packed

SALTS = 64
#: ASCII white space, fixed by the line contract.
BLANK = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANK)))


def _lines(base: DataFrame, min_chars: int) -> DataFrame:
    key = line_key(F.col("line"))
    return (
        base.select("_id", "_mark", F.posexplode(F.split("_text", "\n", -1)).alias("pos", "line"))
        .select("_id", "_mark", "pos", key.alias("key"))
        .filter(F.char_length("key") >= min_chars)
        .select(
            "_id",
            "_mark",
            "pos",
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(7), "key").alias("h2"),
            F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int").alias("salt"),
        )
    )


def dropped_lines(base: DataFrame, min_chars: int = 10) -> DataFrame:
    """(_id, _mark, pos) of every line that an earlier document holds."""
    group = Window.partitionBy("h1", "h2", "salt").orderBy("_id", "pos")
    first = (
        _lines(base, min_chars)
        .repartitionByRange("h1", "h2", "salt")
        .withColumn("first", F.first("_id").over(group))
    )
    repeated = first.filter(F.col("_id") > F.col("first"))
    heads = first.filter(F.col("_id") == F.col("first")).select("_id", "_mark", "pos", "h1", "h2")
    whole = Window.partitionBy("h1", "h2").orderBy("_id", "pos")
    later = (
        heads.repartitionByRange("h1", "h2")
        .withColumn("first", F.first("_id").over(whole))
        .filter(F.col("_id") > F.col("first"))
    )
    return repeated.select("_id", "_mark", "pos").unionByName(later.select("_id", "_mark", "pos"))


def drop_runs(dropped: DataFrame) -> DataFrame:
    """One row per document with dropped lines: ``runs``, sorted (start, length) pairs of its drop bitmap."""
    order = Window.partitionBy("_id", "_mark").orderBy("pos")
    return (
        dropped.withColumn("run", F.col("pos") - F.dense_rank().over(order))
        .groupBy("_id", "_mark", "run")
        .agg(F.min("pos").alias("start"), (F.max("pos") - F.min("pos") + 1).alias("length"))
        .groupBy("_id", "_mark")
        .agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("runs"))
    )


def _keep_runs(runs: Column, n: Column) -> Column:
    """The gaps between dropped runs, so the runs of kept lines."""
    gaps = F.transform(
        F.sequence(F.lit(0), F.size(runs)),
        lambda i: F.struct(
            F.when(i == 0, F.lit(0))
            .otherwise(F.get(runs, i - 1)["start"] + F.get(runs, i - 1)["length"])
            .alias("start"),
            F.when(i == F.size(runs), n).otherwise(F.get(runs, i)["start"]).alias("stop"),
        ),
    )
    return F.transform(
        F.filter(gaps, lambda g: g["stop"] > g["start"]),
        lambda g: F.struct(g["start"].alias("start"), (g["stop"] - g["start"]).alias("length")),
    )


def _applied(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``rows`` (_id, _mark, _text and others) with n_lines, n_dropped, keep_runs and kept."""
    none = F.array().cast("array<struct<start:int,length:int>>")
    joined = (
        rows.join(bitmaps, ["_id", "_mark"], "left")
        .withColumn("lines", F.split("_text", "\n", -1))
        .withColumn("runs", F.coalesce("runs", none))
        .withColumn("keep_runs", _keep_runs(F.col("runs"), F.size("lines")))
    )
    kept = F.flatten(F.transform("keep_runs", lambda r: F.slice("lines", r["start"] + 1, r["length"])))
    return joined.select(
        *rows.columns,
        F.size("lines").cast("long").alias("n_lines"),
        F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["length"]).alias("n_dropped"),
        "keep_runs",
        F.array_join(kept, "\n").alias("kept"),
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """Per row of ``docs``: _id, _mark, n_lines, n_dropped, keep_runs (run-length coded bitmap), kept (text)."""
    base = keyed(docs, id_col, text_col)
    return _applied(base, drop_runs(dropped_lines(base, min_chars))).drop("_text")


def rewritten(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``docs`` (doc_id, text and any columns) with the dropped lines taken out; rows that lose all their lines go.

    Unchanged texts stay as they are, null ones included; n_chars, where the table has it, follows the text.
    """
    rows = packed(docs).withColumn("_text", F.coalesce(F.col("_row").getField("text"), F.lit("")))
    found = _applied(rows, drop_runs(dropped_lines(keyed(docs), min_chars))).filter("n_dropped < n_lines")
    changed = F.col("n_dropped") > 0
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    old = {n: F.col("_row").getField(n) for n in docs.columns}
    return found.select(*[(F.when(changed, new[n]).otherwise(old[n]) if n in new else old[n]).alias(n) for n in old])
