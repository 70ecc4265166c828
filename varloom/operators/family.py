"""Mendelian transmission over declared families, and pedigree validation."""

from pyspark.sql import DataFrame, functions as F

from varloom import vocab
from varloom.functions import transmission as tr
from varloom.functions.ids import stable_id
from varloom.operators.calls import sorted_alleles

ROLES = ("child", "p1", "p2")


def families(members: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per child with its one or two declared parents in stable order."""
    parent = F.struct("parent_member_id", "assertion_id")
    grouped = edges.groupBy("child_member_id").agg(
        F.min(parent).alias("first"), F.max(parent).alias("last"), F.count(F.lit(1)).alias("parents")
    )
    subject = members.select("member_id", "sample_id")
    two = F.col("parents") > 1
    rows = grouped.select(
        "child_member_id",
        "parents",
        F.col("first.parent_member_id").alias("p1_member_id"),
        F.when(two, F.col("last.parent_member_id")).alias("p2_member_id"),
        F.when(two, F.array("first.assertion_id", "last.assertion_id"))
        .otherwise(F.array("first.assertion_id"))
        .alias("relationship_assertion_ids"),
    )
    for role, column in (
        ("child", "child_member_id"),
        ("p1", "p1_member_id"),
        ("p2", "p2_member_id"),
    ):
        named = subject.select(
            F.col("member_id").alias(column), F.col("sample_id").alias(role + "_sample")
        )
        rows = rows.join(named, column, "left")
    return rows


def family_calls(calls: DataFrame, family_rows: DataFrame) -> DataFrame:
    """Union of the family's variants per child, with each role's collapsed call.

    Every (role, variant) row comes from one equi-join on the sample; one
    grouping pivots the at most three roles side by side.
    """
    roles = family_rows.select(
        "child_member_id",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("role"), F.col(r + "_sample").alias("sample_id"))
                    for i, r in enumerate(ROLES)
                ]
            )
        ).alias("x"),
    ).select("child_member_id", "x.role", "x.sample_id").where("sample_id is not null")
    slim = calls.select(
        "sample_id", "variant_id", "call_count", "low_code", "high_code", "min_ploidy",
        "max_ploidy", "max_alt", "foreign_count",
    )
    called = F.col("call_count") > 0
    clean = called & (F.col("low_code") == F.col("high_code")) & (F.col("max_ploidy") == 2)
    return (
        slim.join(roles, "sample_id")
        .groupBy("child_member_id", "variant_id")
        .agg(
            F.bool_or(called & (F.col("low_code") != F.col("high_code"))).alias("conflicting"),
            F.bool_or(called & ((F.col("min_ploidy") != 2) | (F.col("max_ploidy") != 2))).alias(
                "bad_ploidy"
            ),
            F.bool_or(F.col("foreign_count") > 0).alias("outside"),
            F.sum("call_count").alias("genotype_count"),
            *[
                F.max(F.when((F.col("role") == i) & clean, F.col("max_alt"))).alias(r + "_alt")
                for i, r in enumerate(ROLES)
            ],
        )
    )


def segregation(calls: DataFrame, family_rows: DataFrame, variants: DataFrame) -> DataFrame:
    """Compatibility, informativeness and transmissions per (child, variant)."""
    sites = family_calls(calls, family_rows).join(
        variants.select("variant_id", "chromosome", "reference", "alternate"), "variant_id"
    )
    rows = sites.join(
        family_rows.select("child_member_id", "parents", "relationship_assertion_ids"),
        "child_member_id",
    )
    ref, alt = F.col("reference"), F.col("alternate")

    def alleles(role):
        count = F.col(role + "_alt")
        return F.when(count.isNotNull(), sorted_alleles(F.lit(2), count, ref, alt))

    duo = F.col("parents") == 1
    missing = (
        F.col("child_alt").isNull()
        | F.col("p1_alt").isNull()
        | (~duo & F.col("p2_alt").isNull())
    )
    unresolved = tr.unresolved_status(
        F.col("chromosome"),
        F.coalesce("bad_ploidy", F.lit(False)),
        ref,
        alt,
        F.coalesce("conflicting", F.lit(False)),
        missing,
        F.coalesce("outside", F.lit(False)),
    )
    rows = rows.withColumn("unresolved", unresolved).withColumn(
        "assignments",
        F.when(
            F.col("unresolved").isNull(),
            tr.assignments(
                alleles("child"),
                alleles("p1"),
                F.when(~duo, alleles("p2")),
                F.array(ref, alt),
            ),
        ),
    )
    count = F.coalesce(F.size("assignments"), F.lit(0))
    count = F.when(F.col("unresolved").isNull(), count).otherwise(0)
    return rows.select(
        stable_id("m9e", "variant_id", "child_member_id").alias("evidence_id"),
        "child_member_id",
        "variant_id",
        "relationship_assertion_ids",
        "genotype_count",
        F.coalesce(
            "unresolved", F.when(count == 0, "inconsistent").otherwise("consistent")
        ).alias("compatibility"),
        F.when(F.col("unresolved").isNotNull(), "not_evaluated")
        .when(count > 1, "uninformative")
        .otherwise("informative")
        .alias("informativeness"),
        F.when(
            F.col("unresolved").isin("indeterminate_missing", "indeterminate_conflicting"),
            "unresolved_input",
        )
        .when(F.col("unresolved").isNotNull(), "not_applicable")
        .when(count == 0, "no_compatible_transmission")
        .when(count == 1, "unique_transmission")
        .otherwise("ambiguous_transmission")
        .alias("transmission_status"),
        count.alias("assignment_count"),
        "assignments",
    )


def transmission_assignments(evidence: DataFrame) -> DataFrame:
    return evidence.select(
        "evidence_id",
        "child_member_id",
        "variant_id",
        "transmission_status",
        F.posexplode("assignments").alias("assignment_index", "a"),
    ).select("evidence_id", "child_member_id", "variant_id", "transmission_status", "assignment_index", "a.*")


def compatibility_counts(evidence: DataFrame) -> DataFrame:
    """Counts over the full status vocabulary, zero where a status does not occur."""
    statuses = F.array(*[F.lit(s) for s in vocab.COMPATIBILITY_STATUSES])
    spark = evidence.sparkSession
    every = spark.range(1).select(F.explode(statuses).alias("code"))
    counted = evidence.groupBy(F.col("compatibility").alias("code")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return every.join(counted, "code", "left").select(
        "code", F.coalesce("n", F.lit(0)).alias("count")
    )


def identity_conflicts(variants: DataFrame) -> DataFrame:
    """Variant ids that carry more than one allele key across runs."""
    from varloom.operators.normalize import KEY

    return (
        variants.select("variant_id", *KEY)
        .distinct()
        .groupBy("variant_id")
        .agg(F.count(F.lit(1)).alias("distinct_keys"))
        .where("distinct_keys > 1")
    )


def pedigree_violations(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Rule violations that need no graph walk: (rule, key) rows."""

    def repeated(df, keys, rule):
        return (
            df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .where("n > 1")
            .select(F.lit(rule).alias("rule"), F.concat_ws("|", *keys).alias("key"))
        )

    known = members.select(F.col("member_id"))

    def unknown(column):
        return (
            edges.join(known, edges[column] == known["member_id"], "left_anti")
            .select(F.lit("unknown_member").alias("rule"), F.col(column).alias("key"))
            .distinct()
        )

    crowded = (
        edges.select("child_member_id", "parent_member_id")
        .distinct()
        .groupBy("child_member_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 2")
        .select(F.lit("more_than_two_parents").alias("rule"), F.col("child_member_id").alias("key"))
    )
    parts = [
        repeated(members, ["member_id"], "duplicate_member"),
        repeated(members, ["subject_id"], "duplicate_subject"),
        repeated(members, ["run_id"], "duplicate_run"),
        repeated(edges, ["assertion_id"], "duplicate_assertion"),
        repeated(edges, ["parent_member_id", "child_member_id"], "duplicate_edge"),
        unknown("parent_member_id"),
        unknown("child_member_id"),
        edges.where("parent_member_id = child_member_id").select(
            F.lit("self_parent").alias("rule"), F.col("child_member_id").alias("key")
        ),
        crowded,
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def cycle_edges(edges: DataFrame, cut) -> DataFrame:
    """Edges whose child is also an ancestor of their parent: those on a cycle.

    First edges that cannot lie on a cycle are trimmed away (their parent is nobody's child or their child nobody's
    parent).  What is left, people on or between declared cycles, is closed under ancestry by doubling: each round joins the
    paths found so far, so a cycle of length n takes log2(n) rounds.  ``cut`` materialises a round.
    """
    core = _trimmed(edges, cut)
    paths = core
    size = paths.count()
    while size:
        onward = paths.select(F.col("parent_member_id").alias("child_member_id"), F.col("child_member_id").alias("next"))
        longer = paths.join(onward, "child_member_id").select("parent_member_id", F.col("next").alias("child_member_id"))
        paths = cut(paths.unionByName(longer).distinct())
        grown = paths.count()
        if grown == size:
            break
        size = grown
    back = paths.select(
        F.col("child_member_id").alias("parent_member_id"), F.col("parent_member_id").alias("child_member_id")
    )
    return core.join(back, ["parent_member_id", "child_member_id"], "left_semi")


def _trimmed(edges: DataFrame, cut) -> DataFrame:
    left = cut(
        edges.select("parent_member_id", "child_member_id").where("parent_member_id <> child_member_id").distinct()
    )
    size = left.count()
    while size:
        children = left.select(F.col("child_member_id").alias("parent_member_id")).distinct()
        parents = left.select(F.col("parent_member_id").alias("child_member_id")).distinct()
        kept = cut(
            left.join(children, "parent_member_id", "left_semi").join(parents, "child_member_id", "left_semi")
        )
        smaller = kept.count()
        if smaller == size:
            break
        left, size = kept, smaller
    return left
