"""Allele, strand and dosage expressions."""

from pyspark.sql import Column, functions as F

from varloom.functions.tokens import is_autosome


def supported_alleles(reference: Column, alternate: Column) -> Column:
    """Both alleles spelled with A/C/G/T only and of equal length."""
    return (
        reference.rlike("^[ACGT]+$")
        & alternate.rlike("^[ACGT]+$")
        & (F.length(reference) == F.length(alternate))
    )


def complement(bases: Column) -> Column:
    return F.translate(bases, "ACGT", "TGCA")


def to_canonical_strand(bases: Column, strand: Column) -> Column:
    return (
        F.when(strand == "complement", complement(bases))
        .when(strand == "reverse_complement", F.reverse(complement(bases)))
        .otherwise(bases)
    )


def palindromic(reference: Column, alternate: Column) -> Column:
    return (F.length(reference) == 1) & (alternate == complement(reference))


def token_alleles(token: Column, width: Column) -> Column:
    """Split a token into one or two alleles of the given width, else NULL."""
    upper = F.upper(token)
    return F.when(F.length(token) == width, F.array(upper)).when(
        F.length(token) == 2 * width,
        F.array(upper.substr(F.lit(1), width), upper.substr(width + 1, width)),
    )


def count_allele(alleles: Column, allele: Column) -> Column:
    return F.size(F.filter(alleles, lambda x: x == allele))


def canonical_snv(
    assembly: Column, chromosome: Column, reference: Column, alternate: Column
) -> Column:
    """Scope test of score, projection and pharmacogene models."""
    return (
        (assembly == "GRCh38")
        & is_autosome(chromosome)
        & reference.rlike("^[ACGT]$")
        & alternate.rlike("^[ACGT]$")
        & (reference != alternate)
    )


def effect_dosage(alt_count: Column, effect: Column, alternate: Column) -> Column:
    return F.when(effect == alternate, alt_count).otherwise(2 - alt_count)


def standardized(dosage: Column, mean: Column, scale: Column) -> Column:
    return (dosage - mean) / scale


def foreign_code(alleles: Column, reference: Column, alternate: Column) -> Column:
    """Integer naming an SNV allele multiset that leaves {REF, ALT}; NULL when it stays inside.

    Written over the at most two array slots, so it stays in generated code.
    """
    first, second = F.get(alleles, F.lit(0)), F.get(alleles, F.lit(1))

    def outside(allele):
        return F.coalesce((allele != reference) & (allele != alternate), F.lit(False))

    i, j = base_index(first), base_index(second)
    code = F.when(second.isNull(), 25 + i).otherwise(F.least(i, j) * 5 + F.greatest(i, j))
    return F.when(outside(first) | outside(second), code + 64)


def base_index(base: Column) -> Column:
    """1..4 for A, C, G, T and 0 for anything else."""
    return F.when(F.length(base) == 1, F.instr(F.lit("ACGT"), base)).otherwise(0)
