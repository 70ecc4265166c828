"""Secret scans with an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its text).  The ledger says which blobs were scanned under
which version of which rule; only the missing pairs are scanned, each blob once however many paths hold it, and findings
are joined back to all paths.  Positions come from the built-in regular expressions: the texts between matches and the
matches themselves, whose lengths are summed in order.

A rule matches leftmost and without overlap; matches whose ``group`` is shorter than ``least`` are dropped after that.

Defined cases: null and empty texts are one blob without findings; a null id is kept; repeated rows give repeated results;
a blob without findings still enters the ledger; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varloom.llm.common import keyed


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    group: int
    least: int


#: The base patterns in their listed order.  ``hex`` and ``access`` match whole runs, so their least length is
#: part of the pattern; a failing ``assign`` match uses its text up and is dropped afterwards.
BASE = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)
ADDED = (Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),)
RULES = BASE + ADDED


def _tag(rule: Rule) -> str:
    return f"{rule.kind}@{rule.version}"


def _matches(rule: Rule) -> Column:
    """All matches in ``_text`` with what lies before each: array of (before, length, value length)."""
    pattern = F.lit(rule.pattern)
    parts = F.zip_with(
        F.split("_text", rule.pattern, -1),
        F.zip_with(
            F.regexp_extract_all("_text", pattern, F.lit(0)),
            F.regexp_extract_all("_text", pattern, F.lit(rule.group)),
            lambda m, v: F.struct(F.char_length(m).alias("length"), F.char_length(v).alias("value")),
        ),
        lambda gap, m: F.struct(F.char_length(gap).alias("before"), m["length"].alias("length"), m["value"].alias("value")),
    )
    none = F.array().cast("array<struct<before:int,length:int,value:int>>")
    return F.when(F.col("_text").rlike(rule.pattern), F.filter(parts, lambda p: p["length"].isNotNull())).otherwise(none)


def address(versions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return keyed(versions, id_col, text_col).select("_id", "_text", F.sha2("_text", 256).alias("blob"))


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(findings, entries) of all blob and rule-version pairs of ``versions`` that ``ledger`` lacks.

    findings: blob, kind, start, stop; entries: blob, rule - what to append to the ledger.
    """
    addressed = address(versions)
    blobs = addressed.groupBy("blob").agg(F.min("_id").alias("_id"))
    if ledger is None:
        open_ = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        open_ = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    tags = F.array(*[F.lit(_tag(r)) for r in rules])
    open_ = open_.filter(F.size(F.array_except(tags, "seen")) > 0)
    texts = addressed.join(open_, ["_id", "blob"])
    none = F.array().cast("array<struct<before:int,length:int,value:int>>")
    kinds = F.array(
        *[
            F.struct(
                F.lit(i).alias("kind"),
                F.when(F.array_contains("seen", _tag(r)), none).otherwise(_matches(r)).alias("found"),
            )
            for i, r in enumerate(rules)
        ]
    )
    each = texts.select("blob", F.explode(kinds).alias("k")).filter(F.size("k.found") > 0)
    each = each.select("blob", "k.kind", F.posexplode("k.found").alias("at", "m")).dropDuplicates(["blob", "kind", "at"])
    order = Window.partitionBy("blob", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    least = F.get(F.array(*[F.lit(r.least) for r in rules]), F.col("kind"))
    findings = (
        each.select("blob", "kind", "at", "m.*")
        .withColumn("stop", F.sum(F.col("before") + F.col("length")).over(order))
        .filter(F.col("value") >= least)
        .select(
            "blob",
            F.get(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind")).alias("kind"),
            (F.col("stop") - F.col("length")).alias("start"),
            "stop",
        )
    )
    entries = open_.select("blob", F.explode(F.array_except(tags, "seen")).alias("rule"))
    return findings, entries


def by_path(versions: DataFrame, findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``versions``: _id, blob, found (sorted array of start, rank of the kind, stop, kind)."""
    rank = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind"))
    summed = findings.groupBy("blob").agg(
        F.array_sort(F.collect_set(F.struct("start", rank.alias("rank"), "stop", "kind"))).alias("found")
    )
    none = F.array().cast("array<struct<start:bigint,rank:bigint,stop:bigint,kind:string>>")
    paths = address(versions).select("_id", "blob")
    return paths.join(summed, "blob", "left").select("_id", "blob", F.coalesce("found", none).alias("found"))


def shown(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["stop"].cast("string"))), ","
    )
