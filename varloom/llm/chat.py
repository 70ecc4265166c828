"""Chat formatting: reply trees to conversations in a marked template.

Messages form trees by their parent links.  Iterative self-joins double the distance each message knows of its way up
(ancestor, length and score of the path), so a tree of depth d takes log2(d) joins.  Paths from root to leaf are ranked by
score (ties: the smaller leaf id), the chosen leaves hand the choice back down the same doubled links, and the messages of each
chosen path are written, in order, into one text with a loss mask over the assistant texts.

Control strings inside texts are escaped: a backslash is doubled and ``<|`` becomes ``<\\|``, so ``<|`` in the output is
always a mark of the template and every text can be read back.  In roles a line feed becomes ``\\n`` as well.

Defined cases: null texts and roles are empty; a message whose parent is null or missing is a root; messages that repeat
an id are told apart by ``reply_chain`` (which numbers them) and collapse to the smallest (role, text) in ``best_paths``;
messages on or below a parent cycle have no root and give no path; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varloom.operators.materialize import stored

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    parts = F.split(text, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("<\\|"), F.lit("<|"))), "\\")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\", -1)
    plain = F.transform(
        parts, lambda p: F.replace(F.replace(p, F.lit("<\\|"), F.lit("<|")), F.lit("\\n"), F.lit("\n"))
    )
    return F.array_join(plain, "\\")


def reply_chain(rows: DataFrame) -> DataFrame:
    """Messages of plain conversations (conv_id, turn, role, text): each turn replies to the one before it."""
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return (
        rows.select(
            F.col("conv_id").alias("tree"),
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .withColumn("id", F.row_number().over(order).cast("long"))
        .select(
            "tree",
            "id",
            F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"),
            "role",
            "text",
            F.lit(0.0).alias("score"),
        )
    )


def best_paths(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """The ``per_tree`` best root-to-leaf paths of each tree: tree, path_rank, depth (from 0), role, text.

    ``messages``: tree, id, parent, role, text, score.
    """
    nodes = messages.groupBy("tree", "id").agg(
        F.min(F.struct("parent", "role", "text", "score")).alias("m")
    ).select(F.struct("tree").alias("t"), "id", "m.*")
    plain = {"score": F.coalesce("score", F.lit(0.0)), "role": F.coalesce("role", F.lit("")), "text": F.coalesce("text", F.lit(""))}
    nodes = stored(nodes.withColumns(plain), "messages")
    ids = nodes.select("t", F.col("id").alias("parent"), F.lit(True).alias("known"))
    linked = nodes.select("t", "id", "parent", "score").join(ids, ["t", "parent"], "left")
    # up: the ancestor ``steps`` above, null once the root is passed; path: score of the messages from here up to it
    ways = linked.select(
        "t", "id", F.when(F.col("known"), F.col("parent")).alias("up"), F.col("score").alias("path"), F.lit(1).alias("steps")
    )
    total = nodes.count()
    links, reach = [], 1
    while True:
        ways = stored(ways, "ways")
        links.append(ways.select("t", "id", "up"))
        open_ = ways.filter("up is not null")
        if reach > total or not open_.limit(1).count():
            break
        above = ways.select(
            "t", F.col("id").alias("up"), F.col("up").alias("next"), F.col("path").alias("more"), F.col("steps").alias("far")
        )
        longer = open_.join(above, ["t", "up"]).select(  # paths that have reached their root take no part
            "t",
            "id",
            F.col("next").alias("up"),
            (F.col("path") + F.col("more")).alias("path"),
            (F.col("steps") + F.col("far")).alias("steps"),
        )
        ways = ways.filter("up is null").unionByName(longer)
        reach *= 2
    parents = linked.filter("known").select("t", F.col("parent").alias("id")).distinct()
    leaves = ways.filter("up is null").join(parents, ["t", "id"], "left_anti")
    best = Window.partitionBy("t").orderBy(F.desc("path"), "id")
    chosen = leaves.select(
        "t", "id", F.row_number().over(best).alias("path_rank"), F.count("*").over(Window.partitionBy("t")).alias("leaves")
    ).filter(F.col("path_rank") <= per_tree)
    depths = ways.filter("up is null").select("t", "id", (F.col("steps") - 1).alias("depth"))
    # a tree with one leaf is one path: all its messages that reach the root
    chosen = stored(chosen, "chosen")
    whole = depths.join(chosen.filter("leaves = 1").select("t", "path_rank"), "t").select("t", "id", "path_rank")
    branched = chosen.filter("leaves > 1").select("t", "id", "path_rank")
    if branched.limit(1).count():
        whole = whole.unionByName(_ancestors(branched, links))
    return (
        whole.join(depths, ["t", "id"])
        .join(nodes.select("t", "id", "role", "text"), ["t", "id"])
        .select("t.tree", "path_rank", "depth", "role", "text")
    )


def _ancestors(chosen: DataFrame, links: list[DataFrame]) -> DataFrame:
    """``chosen`` (t, id, path_rank) with all ancestors, handed down the doubled links."""
    for link in reversed(links):  # from the longest links to the shortest: every set covers twice as many ancestors
        up = chosen.join(link.filter("up is not null"), ["t", "id"]).select("t", F.col("up").alias("id"), "path_rank")
        chosen = stored(chosen.unionByName(up).distinct(), "chosen")
    return chosen


def write_conversations(paths: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per path: tree, path_rank, formatted, loss_spans (start, stop in code points of formatted)."""
    turn = F.struct(
        "depth",
        F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("role") == trained_role).alias("trained"),
    )
    tail = END + "\n"
    gathered = paths.groupBy("tree", "path_rank").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    pieces = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(tail)))
    ends = (
        paths.select("tree", "path_rank", "depth", "role", F.char_length(turn["head"]).alias("head"), F.char_length(turn["body"]).alias("body"))
        .withColumn(
            "stop",
            F.sum(F.col("head") + F.col("body") + len(tail)).over(
                Window.partitionBy("tree", "path_rank").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
            )
            - len(tail),
        )
        .filter(F.col("role") == trained_role)
        .groupBy("tree", "path_rank")
        .agg(F.sort_array(F.collect_list(F.struct((F.col("stop") - F.col("body")).alias("start"), "stop"))).alias("loss_spans"))
    )
    same = F.expr("a.path_rank = b.path_rank and a.tree <=> b.tree")
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return (
        gathered.select("tree", "path_rank", F.array_join(pieces, "").alias("formatted")).alias("a")
        .join(ends.alias("b"), same, "left")
        .select("a.tree", "a.path_rank", "a.formatted", F.coalesce("b.loss_spans", none).alias("loss_spans"))
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    turns = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda _, i: i > 0)
    return F.transform(
        turns,
        lambda t: F.struct(
            unescape_role(F.substring_index(t, "\n", 1)).alias("role"),
            unescape(
                F.substring_index(F.substr(t, F.char_length(F.substring_index(t, "\n", 1)) + 2), END, 1)
            ).alias("text"),
        ),
    )


def read_masked(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")))),
        "",
    )
