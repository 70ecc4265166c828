"""Sharding by balanced label propagation.

Rows with equal texts are linked (through one hub per text, never as pairs).  Labels start from a plan over the histogram of
group sizes, largest first: as many groups of a size as fit go whole into the shards with most room, and what fits nowhere
whole fills shard after shard.  So full shards are no obstacle, however many rows are linked.  In each following round a hub tallies the shards of its members, its best shard calls the others, and moves into a shard are taken in the
order of their gain as far as the shard's quota of rows goes; the cut is found on a histogram of bounded size (shards x gains x
cells), so no window ever orders the movers of a shard.  A group larger than a quota fills shard after shard.  Rows without
links have no edges to cut: they fill every shard up to its exact quota, so counts differ by one at most.

Defined cases: null texts count as empty ones (size 1) and are linked like any equal texts; rows that repeat an id are
rows of their own; rows with a null id keep it; fewer rows than shards leave the last shards empty; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varloom.llm.common import gapless
from varloom.operators.materialize import stored

GAINS, CELLS = 48, 64


def _quotas(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def _pick(values: list[int], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v).cast("long") for v in values]), at)


def _loads(labels: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["n"] for r in labels.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _plan(sizes: list[tuple[int, int]], quotas: list[int]) -> list[tuple[int, list, list]]:
    """Per size n of ``sizes`` (n, groups): (upto, shard) of whole groups by rank, and of the rows of the groups left, by place."""
    room, out = list(quotas), []
    for n, groups in sorted(sizes, reverse=True):
        whole = min(groups, sum(r // n for r in room))
        # the highest level down to which the shards are filled for all of them
        low, high = 0, max(room)
        while low < high:
            level = (low + high + 1) // 2
            low, high = (level, high) if sum(max(0, r - level) // n for r in room) >= whole else (low, level - 1)
        taken = [max(0, r - low) // n for r in room]
        over = sum(taken) - whole
        for s in range(len(room)):
            if over and taken[s]:
                taken[s] -= 1
                over -= 1
        upto, places = 0, []
        for s, k in enumerate(taken):
            if k:
                upto += k
                places.append((upto, s))
                room[s] -= k * n
        left, upto, parts = (groups - whole) * n, 0, []
        for s in sorted(range(len(room)), key=lambda s: -room[s]):
            k = min(left, room[s])
            if k:
                left, upto = left - k, upto + k
                parts.append((upto, s))
                room[s] -= k
        out.append((n, places, parts))
    return out


def _into(upto: str, at: Column) -> Column:
    """The shard of the first stretch of ``upto`` that ends beyond ``at``."""
    return F.get(F.filter(upto, lambda x: x["upto"] > at), F.lit(0))["shard"]


def planned(linked: DataFrame, groups: DataFrame, quotas: list[int]) -> DataFrame:
    """Labels (row, h1, h2, shard) to start from; ``linked``: row, h1, h2, ``groups``: h1, h2, n."""
    spark = linked.sparkSession
    # distinct sizes of groups: at most the root of twice the number of rows
    sizes = [(r["n"], r["k"]) for r in groups.groupBy("n").agg(F.count("*").alias("k")).collect()]
    stretch = "array<struct<upto:bigint,shard:int>>"
    plan = spark.createDataFrame(_plan(sizes, quotas), f"n bigint, whole {stretch}, parts {stretch}")
    ranked = gapless(groups, ["n"], ["h1", "h2"], "rank").join(plan, "n")
    placed = stored(
        ranked.select(
            "h1", "h2", "n", _into("whole", F.col("rank")).alias("shard"), "parts",
            (F.col("rank") - F.coalesce(F.get("whole", F.size("whole") - 1)["upto"], F.lit(0))).alias("nth"),
        ),
        "placed",
    )
    labels = linked.join(placed.filter("shard is not null").select("h1", "h2", "shard"), ["h1", "h2"]).select("row", "h1", "h2", "shard")
    rest = stored(linked.join(placed.filter("shard is null").select("h1", "h2", "n", "nth", "parts"), ["h1", "h2"]), "rest")
    split = gapless(rest, ["h1", "h2"], ["row"], "at").select(
        "row", "h1", "h2", _into("parts", F.col("nth") * F.col("n") + F.col("at")).alias("shard")
    )
    return labels.unionByName(split)


def propagate(start: DataFrame, quotas: list[int], rounds: int) -> DataFrame:
    """Labels (row, h1, h2, shard) after up to ``rounds`` rounds from the labels of ``start``."""
    shards = len(quotas)
    labels = stored(start, "labels")
    for _ in range(rounds):
        free = [max(0, q - n) for q, n in zip(quotas, _loads(labels, shards))]
        tally = labels.groupBy("h1", "h2", "shard").agg(F.count("*").alias("n"))
        room = _pick(free, F.col("shard")) > 0
        best = tally.groupBy("h1", "h2").agg(
            F.max(F.struct(room.alias("room"), "n", F.xxhash64("h1", "shard").alias("tie"), "shard")).alias("best")
        )
        calls = tally.join(best, ["h1", "h2"]).filter(
            (F.col("shard") != F.col("best.shard")) & F.col("best.room") & (F.col("best.n") >= F.col("n"))
        )
        gain = F.least(F.lit(GAINS - 1), F.floor(F.log2(F.col("best.n") - F.col("n") + 1))).cast("int")
        movers = labels.join(
            calls.select("h1", "h2", "shard", F.col("best.shard").alias("to"), gain.alias("gain")), ["h1", "h2", "shard"]
        ).withColumn("cell", F.pmod(F.xxhash64("row", F.lit(3)), F.lit(CELLS)).cast("int"))
        cells = movers.groupBy("to", "gain", "cell").agg(F.count("*").alias("n"))  # at most shards x GAINS x CELLS rows
        running = Window.partitionBy("to").orderBy(F.desc("gain"), "cell").rowsBetween(Window.unboundedPreceding, 0)
        taken = (
            cells.withColumn("sum", F.sum("n").over(running))
            .filter(F.col("sum") <= _pick(free, F.col("to")))
            .select("to", "gain", "cell")
        )
        moves = movers.join(F.broadcast(taken), ["to", "gain", "cell"]).select("row", "to")
        after = stored(
            labels.join(moves, "row", "left").select("row", "h1", "h2", F.coalesce("to", "shard").alias("shard"), F.col("to").isNotNull().alias("moved")),
            "labels",
        )
        labels = after.drop("moved")
        if not after.filter("moved").limit(1).count():
            break
    return labels


def shard(docs: DataFrame, shards: int = 8, rounds: int = 6) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard, linked (has an equal text elsewhere)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stored(
        docs.select(
            F.col("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h1"),
            F.xxhash64(F.lit(7), text).alias("h2"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    total = rows.count()
    quotas = _quotas(total, shards)
    groups = stored(rows.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1"), "groups")
    linked = rows.select("row", "h1", "h2").join(groups.select("h1", "h2"), ["h1", "h2"], "left_semi")
    labels = propagate(planned(linked, groups, quotas), quotas, rounds)
    joined = stored(
        rows.drop("h1", "h2")
        .join(labels.select("row", "shard"), "row", "left")
        .withColumn("class", F.coalesce("shard", F.lit(shards)))
        .drop("shard"),
        "classes",
    )
    ranked = gapless(joined, ["class"], ["row"], "rank")
    loads = _loads(labels, shards)
    stay = [min(n, q) for n, q in zip(loads, quotas)]
    over_before = [sum(n - k for n, k in zip(loads[:s], stay[:s])) for s in range(shards)]
    single = total - sum(loads)
    needs = [q - k for q, k in zip(quotas, stay)]
    upto = [sum(needs[: s + 1]) for s in range(shards)]
    stays = (F.col("class") < shards) & (F.col("rank") < _pick([*stay, 0], F.col("class")))
    # the pool: rows without links, then what a shard holds beyond its quota
    pool = F.when(F.col("class") == shards, F.col("rank")).otherwise(
        single + _pick([*over_before, 0], F.col("class")) + F.col("rank") - _pick([*stay, 0], F.col("class"))
    )
    into = F.size(F.filter(F.array(*[F.lit(u).cast("long") for u in upto]), lambda u: u <= F.col("pool")))
    return (
        ranked.withColumn("pool", F.when(~stays, pool))
        .withColumn("shard", F.when(stays, F.col("class")).otherwise(into).cast("int"))
        .withColumn(
            "slot",
            F.when(stays, F.col("rank")).otherwise(
                _pick(stay, F.col("shard")) + F.col("pool") - _pick([0, *upto[:-1]], F.col("shard"))
            ),
        )
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            F.col("slot").cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            (F.col("class") < shards).alias("linked"),
        )
    )
