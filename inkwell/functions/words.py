"""Dates and numbers in words, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number words and their ordinals.
ONES = "One Two Three Four Five Six Seven Eight Nine Ten Eleven Twelve Thirteen Fourteen Fifteen Sixteen Seventeen Eighteen Nineteen".split()
TENS = "Twenty Thirty Forty Fifty Sixty Seventy Eighty Ninety".split()
ORDINALS = "First Second Third Fourth Fifth Sixth Seventh Eighth Ninth Tenth Eleventh Twelfth Thirteenth Fourteenth Fifteenth Sixteenth Seventeenth Eighteenth Nineteenth".split()
# Ids of the date patterns, seen in training (base) and held out.
WRITTEN_BASE = ("day_month_full_year", "ordinal_day_of_month_numeric_year", "ordinal_day_of_month_word_year")
WRITTEN_HELD_OUT = ("month_day_comma_full_year", "abbrev_month_numeric_ordinal_apostrophe_year", "the_ordinal_of_month_full_year")
NUMERIC_BASE = ("padded_month_day_full_year", "padded_day_month_full_year")
NUMERIC_HELD_OUT = ("full_year_month_day", "numeric_day_abbrev_month_short_year", "unpadded_month_day_apostrophe_year")


def number_words() -> list[str]:
    """Words of 0 to 99; 0 has none."""
    return ["", *ONES, *[t if r == 0 else f"{t}-{ONES[r - 1]}" for t in TENS for r in range(10)]]


def ordinal_words() -> list[str]:
    """Words of the 1st to the 31st."""
    return [*ORDINALS, "Twentieth", *[f"Twenty-{x}" for x in ORDINALS[:9]], "Thirtieth", "Thirty-First"]


def _entry(values: list[str], k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), k.cast("int"))


def in_words(n: Column) -> Column:
    return _entry(number_words(), n + 1)


def day_ordinal(day: Column) -> Column:
    return _entry(ordinal_words(), day)


def short_ordinal(day: Column) -> Column:
    rest = day % 10
    end = F.when((day % 100).between(10, 20), "th").when(rest == 1, "st").when(rest == 2, "nd").when(rest == 3, "rd").otherwise("th")
    return F.concat(day.cast("string"), end)


def year_words(year: Column, with_and: Column) -> Column:
    """A year as spoken; ``with_and`` puts "and " before what follows the hundreds or 2000."""
    joiner = F.when(with_and, "and ").otherwise("")
    century, rest = F.floor(year / 100), year % 100
    return (
        F.when(year == 2000, "Two Thousand")
        .when((year > 2000) & (year < 2100), F.concat(F.lit("Two Thousand "), joiner, in_words(year - 2000)))
        .when(rest == 0, F.concat(in_words(century), F.lit(" Hundred")))
        .otherwise(F.concat(in_words(century), F.lit(" Hundred "), joiner, in_words(rest)))
    )


def written_date(d: Column, roll: Column, with_and: Column, held_out: bool = False) -> tuple[Column, Column]:
    """(text, pattern id) of a date in words; ``roll`` is below 1000."""
    day, year = F.dayofmonth(d), F.year(d)
    month = F.date_format(d, "MMMM")
    if held_out:
        texts = (
            F.concat(month, F.lit(" "), day.cast("string"), F.lit(", "), year.cast("string")),
            F.concat(F.date_format(d, "MMM"), F.lit(". "), short_ordinal(day), F.lit(", '"), F.date_format(d, "yy")),
            F.concat(F.lit("the "), day_ordinal(day), F.lit(" of "), month, F.lit(", "), year.cast("string")),
        )
        edges, names = (333, 666), WRITTEN_HELD_OUT
    else:
        ordinal = F.concat(day_ordinal(day), F.lit(" day of "), month, F.lit(", "))
        texts = (F.date_format(d, "d MMMM yyyy"), F.concat(ordinal, year.cast("string")), F.concat(ordinal, year_words(year, with_and)))
        edges, names = (400, 700), WRITTEN_BASE
    choose = lambda v: F.when(roll < edges[0], v[0]).when(roll < edges[1], v[1]).otherwise(v[2])
    return choose(texts), choose(names)


def numeric_date(d: Column, roll: Column, sign: Column, held_out: bool = False) -> tuple[Column, Column]:
    """(text, pattern id) of a date in digits; ``sign`` is 0, 1 or 2 for ``/``, ``-``, ``.``."""
    if held_out:
        texts = (
            F.date_format(d, "yyyy/MM/dd"), F.date_format(d, "d-MMM-yy"),
            F.concat(F.date_format(d, "M/d/"), F.lit("'"), F.date_format(d, "yy")),
        )
        choose = lambda v: F.when(roll < 333, v[0]).when(roll < 666, v[1]).otherwise(v[2])
        return choose(texts), choose(NUMERIC_HELD_OUT)
    mark = F.element_at(F.array(F.lit("/"), F.lit("-"), F.lit(".")), sign + 1)
    texts = (F.replace(F.date_format(d, "MM~dd~yyyy"), F.lit("~"), mark), F.replace(F.date_format(d, "dd~MM~yyyy"), F.lit("~"), mark))
    choose = lambda v: F.when(roll < 500, v[0]).otherwise(v[1])
    return choose(texts), choose(NUMERIC_BASE)
