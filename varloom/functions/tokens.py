"""Genotype token, chromosome and assembly expressions."""

from pyspark.sql import Column, functions as F

from varloom import vocab


def token_category(token: Column) -> Column:
    return (
        F.when(F.upper(token).isin(*vocab.NO_CALL_TOKENS), "no_call")
        .when(F.length(token) == 1, "single_allele_token")
        .when(F.length(token) == 2, "two_allele_token")
        .otherwise("other_token")
    )


def token_zygosity(token: Column) -> Column:
    bases = F.upper(token)
    return F.when(
        bases.rlike("^[ACGT]{2}$"),
        F.when(
            F.substring(bases, 1, 1) == F.substring(bases, 2, 1), "homozygous_lexical"
        ).otherwise("heterozygous_lexical"),
    )


def call_status(category: Column) -> Column:
    return F.when(category == "no_call", "no_call").otherwise("called")


def recognized_chromosome(token: Column) -> Column:
    return F.upper(token).isin(*vocab.RECOGNIZED_CHROMOSOMES)


def canonical_assembly(token: Column) -> Column:
    lowered = F.lower(token)
    out = F.lit(None).cast("string")
    for name, aliases in vocab.ASSEMBLY_ALIASES.items():
        out = F.when(lowered.isin(*aliases), name).otherwise(out)
    return out


def canonical_chromosome(token: Column) -> Column:
    bare = F.upper(F.regexp_replace(token, "^chr", ""))
    return F.when(bare == "M", "MT").otherwise(bare)


def is_autosome(chromosome: Column) -> Column:
    return chromosome.isin(*vocab.AUTOSOMES)


def classify(observations):
    """Add call status, lexical category and lexical zygosity to raw observations."""
    category = token_category(F.col("raw_genotype"))
    return observations.withColumns(
        {
            "call_status": call_status(category),
            "lexical_category": category,
            "lexical_zygosity": token_zygosity(F.col("raw_genotype")),
        }
    )
