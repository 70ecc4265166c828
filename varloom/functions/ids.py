"""Content-derived identifiers."""

from pyspark.sql import Column, functions as F

# Field separator and explicit NULL token inside hashed keys.
UNIT, NULL_TOKEN = "\x1f", "\x1e"


def content_key(*columns) -> Column:
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_TOKEN))
        for c in columns
    ]
    return F.concat_ws(UNIT, *parts)


def stable_id(prefix: str, *columns) -> Column:
    """``prefix-`` + SHA-256 over the ordered fields; the same fields give the same id."""
    return F.concat(F.lit(prefix + "-"), F.sha2(content_key(*columns), 256))


def variant_id(assembly, chromosome, position, reference, alternate) -> Column:
    return stable_id("var", assembly, chromosome, position, reference, alternate)
