"""Mendelian compatibility of one site, as array expressions.

Alleles are arrays of two strings; a NULL array means "no usable call".
"""

from pyspark.sql import Column, functions as F

from varloom.functions.tokens import is_autosome


def assignments(
    child: Column, parent_1: Column, parent_2: Column, alphabet: Column
) -> Column:
    """Sorted distinct (parent 1 allele, parent 2 allele) pairs that rebuild the child.

    A NULL ``parent_2`` ranges over ``alphabet`` (a duo).
    """
    second = F.array_distinct(F.coalesce(parent_2, alphabet))
    wanted = F.sort_array(child)
    pairs = F.flatten(
        F.transform(
            F.array_distinct(parent_1),
            lambda a: F.transform(
                second, lambda b: F.struct(a.alias("parent_1_allele"), b.alias("parent_2_allele"))
            ),
        )
    )
    return F.array_sort(
        F.filter(
            pairs,
            lambda p: F.sort_array(F.array(p["parent_1_allele"], p["parent_2_allele"])) == wanted,
        )
    )


def unresolved_status(
    chromosome: Column,
    bad_ploidy: Column,
    reference: Column,
    alternate: Column,
    conflicting: Column,
    any_missing: Column,
    outside: Column,
) -> Column:
    """First reason that forbids a compatibility statement, else NULL."""
    return (
        F.when(~is_autosome(chromosome), "unsupported_locus")
        .when(bad_ploidy, "unsupported_ploidy")
        .when(
            (F.length(reference) == 0) | (F.length(alternate) == 0) | (reference == alternate),
            "unsupported_genotype_representation",
        )
        .when(conflicting, "indeterminate_conflicting")
        .when(any_missing, "indeterminate_missing")
        .when(outside, "unsupported_genotype_representation")
    )
