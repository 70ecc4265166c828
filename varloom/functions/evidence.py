"""Expressions over external assertions."""

from itertools import chain

from pyspark.sql import Column, functions as F

from varloom import vocab


def normalize_term(term: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(term), r"(?U)\s+", " "))


def record_status(term: Column) -> Column:
    lowered = F.lower(F.coalesce(term, F.lit("")))
    return (
        F.when(lowered.contains("current"), "current")
        .when(lowered.contains("replac"), "replaced")
        .when(lowered.contains("delet"), "deleted")
        .otherwise("unknown")
    )


def lenient_date(text: Column) -> Column:
    head = F.substring(text, 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head.try_cast("date"))


def age_days(evaluated: Column, released: Column) -> Column:
    return F.date_diff(released, evaluated)


def rank_of(value: Column, ordered: tuple) -> Column:
    pairs = [F.lit(x) for x in chain(*((v, i) for i, v in enumerate(ordered)))]
    return F.try_element_at(F.create_map(*pairs), value)
