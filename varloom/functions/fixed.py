"""Exact arithmetic on weights of up to 20 whole and 18 fractional digits.

A 38-digit decimal has no room for the carry of a product or a sum, and Spark then gives up fractional digits.  Here a number travels
as its floor and its fraction (which is never negative); each is multiplied and summed with room to spare, and the carry is settled once.
"""

from pyspark.sql import Column, functions as F

#: The widest decimal of a stored number.
EXACT = "decimal(38,18)"
#: Weights stay below half of the range, so that twice a weight is still a stored number.
LARGEST = "50000000000000000000"
_NUMBER = r"^\s*[+-]?(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,4}))?\s*$"


def exact_number(text: Column) -> Column:
    """The decimal a text spells out, or NULL when it spells none or one that would lose digits."""
    text = text.cast("string")
    digits = F.regexp_replace(F.regexp_extract(text, _NUMBER, 2), "0+$", "")
    shift = F.coalesce(F.regexp_extract(text, _NUMBER, 3).try_cast("int"), F.lit(0))
    # zeros at the end of the whole part make room for a negative exponent
    zeros = F.when(digits == "", F.length(F.regexp_extract(F.regexp_extract(text, _NUMBER, 1), "0*$", 0))).otherwise(0)
    number = text.try_cast(EXACT)
    fits = F.length(digits) - zeros - shift <= 18
    # no abs or unary minus on wide decimals: Spark rounds both to 34 digits
    inside = (number < F.lit(LARGEST).cast(EXACT)) & (number > F.lit("-" + LARGEST).cast(EXACT))
    return F.when(fits & inside, number)


def whole(number: Column) -> Column:
    return F.floor(number)


def fraction(number: Column) -> Column:
    return F.pmod(number, F.lit(1).cast("decimal(1,0)"))


def _plain(whole_part: Column, rest: Column) -> Column:
    """Text of whole_part + rest for 0 <= rest < 1."""
    negative = (whole_part < 0) & (rest > 0)
    one = F.lit(1).cast("decimal(1,0)")
    shown_whole = F.when(negative, F.abs(whole_part) - one).otherwise(F.abs(whole_part))
    shown_rest = F.when(negative, one - rest).otherwise(rest).cast("decimal(19,18)")
    micro = (shown_rest.cast("decimal(38,18)") * F.lit(10**18).cast("decimal(19,0)")).cast("decimal(19,0)")
    sign = F.when(whole_part < 0, "-").otherwise("")
    return F.concat(sign, shown_whole.cast("decimal(38,0)").cast("string"), F.lit("."), F.lpad(micro.cast("string"), 18, "0"))


def settled(wholes: Column, fractions: Column) -> Column:
    """The exact number of a sum of floors and a sum of fractions; NULL when it has more than 20 whole digits."""
    carry = F.floor(fractions)
    rest = F.pmod(fractions, F.lit(1).cast("decimal(1,0)")).cast("decimal(19,18)")
    total = (wholes + carry).cast("decimal(38,0)")
    # up to 19 whole digits the sum of both has room, and only longer numbers go through their text
    return F.coalesce((total.try_cast("decimal(19,0)") + rest).cast(EXACT), _plain(total, rest).try_cast(EXACT))


def magnitude(number: Column) -> tuple[Column, Column]:
    """Whole and fractional part of the absolute value, to be summed apart (the fraction may stand below zero)."""
    return (
        F.when(number < 0, -whole(number)).otherwise(whole(number)),
        F.when(number < 0, -fraction(number)).otherwise(fraction(number)),
    )


def times(number: Column, small: Column) -> Column:
    """``number`` times a whole number of one digit."""
    factor = small.cast("decimal(1,0)")
    return settled(whole(number) * factor, fraction(number) * factor)
