"""Skew-proof building blocks: ranks, lags and lists that never gather a hot group.

A plain ``row_number``/``lag`` over ``partitionBy(sample)`` sends every row of a
sample to one task.  Here each group is first cut into buckets that are
monotone in the requested order; the window works inside a bucket and one small
row per bucket carries what crosses the cut.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from varloom.operators.materialize import stored


def numbered(
    df: DataFrame, keys: list[str], bucket: Column, order: list[Column], name: str
) -> DataFrame:
    """1-based position of each row inside its key group.

    ``bucket`` must be non-decreasing along ``order`` and must not be NULL.
    """
    cut = df.withColumn("_bucket", bucket)
    inner = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    before = (
        Window.partitionBy(*keys)
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        cut.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
        )
    )
    return (
        cut.withColumn("_rank", F.row_number().over(inner))
        .join(offsets, [*keys, "_bucket"])
        .withColumn(name, F.col("_rank") + F.col("_offset"))
        .drop("_bucket", "_rank", "_offset")
    )


def in_ranges(df: DataFrame, keys: list[str], order: list, name: str = "_range") -> DataFrame:
    """``df`` with the number of its range partition along (keys, order): buckets that follow the rows, not their values.

    Numbers grow along the order inside each key, so they serve as ``bucket`` of :func:`numbered`.  The table is
    stored, because partition numbers hold for one run only.
    """
    ranged = df.repartitionByRange(*keys, *order).withColumn(name, F.spark_partition_id())
    return stored(ranged, "ranges")


def previous_value(
    df: DataFrame, keys: list[str], order: str, value: str, width: int, name: str
) -> DataFrame:
    """``lag(value)`` along the integer column ``order`` inside each key group."""
    cut = df.withColumn("_bucket", F.floor(F.col(order) / width))
    inner = Window.partitionBy(*keys, "_bucket").orderBy(order)
    across = Window.partitionBy(*keys).orderBy("_bucket")
    carried = (
        cut.groupBy(*keys, "_bucket")
        .agg(F.max_by(value, order).alias("_last"))
        .select(*keys, "_bucket", F.lag("_last").over(across).alias("_carried"))
    )
    return (
        cut.withColumn("_lag", F.lag(value).over(inner))
        .withColumn("_first", F.row_number().over(inner) == 1)
        .join(carried, [*keys, "_bucket"])
        .withColumn(name, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_lag")))
        .drop("_bucket", "_lag", "_first", "_carried")
    )


def listed(members: DataFrame, keys: list[str], item: Column, name: str) -> DataFrame:
    """Complete sorted list of every group, with its size in ``<name>_count``."""
    return members.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(name + "_count"), F.array_sort(F.collect_list(item)).alias(name)
    )


#: Rows of one side that one part of a popular key should hold.
PART_ROWS = 10_000


def balanced_sides(
    left: DataFrame, right: DataFrame, on: list[str], left_rows: int | None = None, right_rows: int | None = None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of an equi-join or cogroup on ``on``, cut so that no group is large, and the keys to bring them together on.

    A key's rows on either side are dealt to as many parts as its own count asks for, by the hash of the row; each row goes once
    to every part of the other side.  Keys of fewer than ``left_rows`` and ``right_rows`` rows stay one group and no row of
    theirs is repeated, so a side is sent at most its own rows plus the rows (or pairs) of the other side over that bound.
    Counts stay a table; only keys with several parts are in it.
    """
    left_rows, right_rows = left_rows or PART_ROWS, right_rows or PART_ROWS

    def parts(side: DataFrame, rows: int, name: str) -> DataFrame:
        counted = side.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(name))
        return counted.where(F.col(name) > 1)

    heavy = parts(left, left_rows, "_left_parts").join(parts(right, right_rows, "_right_parts"), on, "full")

    def dealt(side: DataFrame, own: str, other: str, own_part: str, other_part: str) -> DataFrame:
        known = side.join(heavy, on, "left")
        one = F.lit(1)
        at = F.pmod(F.xxhash64(*side.columns), F.coalesce(own, one)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.coalesce(other, one) - 1))
        return known.withColumn(own_part, at).withColumn(other_part, every).drop("_left_parts", "_right_parts")

    return (
        dealt(left, "_left_parts", "_right_parts", "_left_part", "_right_part"),
        dealt(right, "_right_parts", "_left_parts", "_right_part", "_left_part"),
        [*on, "_left_part", "_right_part"],
    )


def balanced_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on keys that may be popular on either side: see :func:`balanced_sides`."""
    a, b, keys = balanced_sides(left, right, on)
    return a.join(b, keys, how).drop("_left_part", "_right_part")


def one_value(df: DataFrame, item: Column) -> Column:
    """The rows of ``df`` as one sorted array value (scalar subquery).

    Only for tables whose size is fixed by a schema, such as one row per vector component.
    """
    return df.agg(F.array_sort(F.collect_list(item)).alias("rows")).scalar()


def in_blocks(rows: DataFrame, table: DataFrame, order: str, item: Column, block_rows: int = 1000) -> DataFrame:
    """Each row of ``rows`` with each block of ``table`` (column ``block``: an array of at most ``block_rows`` items).

    A stated set of rows against all rows of a table: blocks meet the rows through an equi-join on
    their number, so neither side travels as a whole.
    """
    blocks = max(1, -(-table.count() // block_rows))
    at = F.pmod(F.xxhash64(order), F.lit(blocks)).cast("int")
    packed = table.withColumn("_part", at).groupBy("_part").agg(F.array_sort(F.collect_list(item)).alias("block"))
    spread = rows.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return spread.join(packed, "_part").drop("_part")


def filled_forward(
    df: DataFrame, keys: list[str], order: str, value: str, width: int, name: str
) -> DataFrame:
    """Last non-NULL ``value`` at or before each row along the integer column ``order``."""
    cut = df.withColumn("_bucket", F.floor(F.col(order) / width))
    inner = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    before = (
        Window.partitionBy(*keys)
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        cut.groupBy(*keys, "_bucket")
        .agg(
            F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_last"),
        )
        .select(*keys, "_bucket", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    )
    return (
        cut.withColumn("_seen", F.last(value, ignorenulls=True).over(inner))
        .join(carried, [*keys, "_bucket"])
        .withColumn(name, F.coalesce("_seen", "_carried"))
        .drop("_bucket", "_seen", "_carried")
    )


def running_total(
    df: DataFrame, keys: list[str], bucket: Column, order: list, amount: str, name: str
) -> DataFrame:
    """Sum of ``amount`` over the rows before each row inside its key group."""
    cut = df.withColumn("_bucket", bucket)
    inner = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = (
        Window.partitionBy(*keys)
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        cut.groupBy(*keys, "_bucket")
        .agg(F.sum(amount).alias("_total"))
        .select(
            *keys, "_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")
        )
    )
    return (
        cut.withColumn("_within", F.coalesce(F.sum(amount).over(inner), F.lit(0)))
        .join(offsets, [*keys, "_bucket"])
        .withColumn(name, F.col("_within") + F.col("_offset"))
        .drop("_bucket", "_within", "_offset")
    )
