"""Helpers shared by the text operators."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varloom.operators.materialize import stored

#: Rows whose id is null count as one document that comes after all others.
NO_ID = (1 << 63) - 1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def slices(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; a text of one byte per character takes the built-in short way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The three columns every operator works on, under names of their own: _id, _text and _mark.

    _mark is the digest of the text.  With _id it tells rows apart that repeat an id with another text; rows that repeat
    both get equal decisions.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"),
        text.alias("_text"),
        F.xxhash64(text).alias("_mark"),
    )


def shown_id(name: str = "_id") -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name))


def packed(docs: DataFrame) -> DataFrame:
    """_row (all columns of ``docs``), _id and _mark: a form in which no column name can clash."""
    return docs.select(
        F.struct("*").alias("_row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_mark"),
    )


def kept_rows(docs: DataFrame, kept: DataFrame, on: list[str] | None = None, distinct: bool = False) -> DataFrame:
    """Rows of ``docs``, all columns, whose keys (_id and _mark unless told) are in ``kept``; ``distinct``: repeated rows once."""
    on = on or ["_id", "_mark"]
    chosen = packed(docs).join(kept.select(*on), on, "left_semi")
    if distinct:
        chosen = chosen.dropDuplicates(["_id", "_mark"])
    return chosen.select(*[F.col("_row").getField(n).alias(n) for n in docs.columns])


def gapless(df: DataFrame, keys: list[str], order: list[str], out: str, rows_per_bucket: int = 50_000) -> DataFrame:
    """Adds ``out``: numbers from 0 without gaps for each value of ``keys``, which may be one hot value.

    Rows are numbered inside hash buckets of a bounded mean size; one row per key and bucket carries the offsets.  ``df``
    must be a stored table: it is read twice and has to give the same rows.
    """
    buckets = max(1, math.ceil(df.count() / rows_per_bucket))
    spread = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = spread.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    numbered = spread.withColumn("_at", F.row_number().over(inside) - 1)
    return (
        numbered.join(offsets, [*keys, "_bucket"])
        .withColumn(out, (F.col("_at") + F.col("_before")).cast("long"))
        .drop("_at", "_before", "_bucket")
    )


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node of the undirected ``edges`` (a, b): columns node, root.

    Stars alternate: every node hands its larger neighbours, then its smaller ones, to the smallest node it knows.  Each
    round is a stored table, and no node's neighbours are ever gathered.  Ends when a round changes nothing.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges"
    )
    last = None
    for _ in range(rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == last or not state[0]:
            break
        last = tuple(state)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        )
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(floor, "u")
        small = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(joined.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
        now = stored(small, "edges")
    else:
        raise RuntimeError(f"components: not settled after {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
