"""Values of registers and registries as Column functions: types, codes, dates, numbers, links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.names import strip, strip_column

#: Cells that a register's reader takes as missing.
NA_CELLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: Upper bounds of the size bands.
SIZE_BANDS = ((10, "micro"), (50, "small"), (250, "medium"), (999, "large"))


def text(c: Column) -> Column:
    """As text, missing as ''."""
    return F.coalesce(c.cast("string"), F.lit(""))


def na_to_blank(c: Column) -> Column:
    return F.when(c.isNull() | c.isin(*NA_CELLS), "").otherwise(c)


def slug(c: Column) -> Column:
    """Lower-case words joined by single hyphens."""
    spaced = F.trim(F.regexp_replace(F.lower(text(c)), "[^a-z0-9]+", " "))
    return F.regexp_replace(spaced, " +", "-")


def sic_codes(*cells: Column) -> Column:
    """The part before ' - ' of every cell that has one, joined by ';'."""
    codes = F.transform(F.array(*[strip_column(text(c)) for c in cells]), lambda x: strip_column(F.substring_index(x, " - ", 1)))
    return F.array_join(F.filter(codes, lambda x: x != ""), ";")


def sic_list(c: Column) -> Column:
    """The codes of a text separated by ';' or ','."""
    return F.filter(F.transform(F.split(F.translate(text(c), ",", ";"), ";"), strip), lambda x: x != "")


def parsed_date(c: Column) -> Column:
    """ISO or day/month/year as ISO text; blank stays blank; anything else is null."""
    t = strip_column(text(c))
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.try_to_timestamp(t, F.lit("yyyy-MM-dd")).cast("date"))
    day_first = F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}\z"), F.try_to_timestamp(t, F.lit("d/M/yyyy")).cast("date"))
    return F.when(t == "", "").otherwise(F.date_format(F.coalesce(iso, day_first), "yyyy-MM-dd"))


def strict_date(c: Column) -> Column:
    """parsed_date() that fails on what it can't read."""
    got = parsed_date(c)
    return F.when(got.isNull(), F.raise_error(F.concat(F.lit("not a date: "), text(c))).cast("string")).otherwise(got)


def snapshot_date(name: Column, otherwise: Column) -> Column:
    """The first 20dd-dd-dd in a file name, else the day of a UTC time."""
    return F.coalesce(F.nullif(F.regexp_extract(name, r"(20\d{2}-\d{2}-\d{2})", 1), F.lit("")), F.date_format(otherwise, "yyyy-MM-dd"))


def years_between(created: Column, as_of: Column) -> Column:
    return F.datediff(as_of, created) / F.lit(365.25)


def words(c: Column) -> Column:
    """Distinct words of a lower-cased text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text(c)), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))


def positive_int(c: Column) -> Column:
    """A whole number from 1 on, else null."""
    n = F.when(strip(text(c)).rlike(r"^\+?\d+\z"), strip(text(c)).try_cast("int"))
    return F.when(n >= 1, n)


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def size_band(n: Column) -> Column:
    out = F.when(n <= SIZE_BANDS[0][0], SIZE_BANDS[0][1])
    for top, name in SIZE_BANDS[1:]:
        out = out.when(n <= top, name)
    return out.when(n.isNull(), "unknown").otherwise("mega")


def cache_key(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix + ":"), F.substring(F.sha2(text(c), 256), 1, 16))


def text_bool(c: Column) -> Column:
    """True and False as a register's text form writes them."""
    return F.initcap(c.cast("string"))


def round_half_even(c: Column, digits: int = 4) -> Column:
    """A number from 0 to a few thousand rounded to decimal digits by its exact binary value, ties to
    even. Twice the scaled number is held as an exact sum of two, and compared with the odd number
    that stands for the middle; Spark's own rounding goes by the shortest decimal form instead."""
    scale = float(10**digits)
    high = c * F.lit(134217729.0) - (c * F.lit(134217729.0) - c)  # the upper half of the bits
    below = F.floor(c * F.lit(scale))
    middle = 2 * below.cast("double") + 1
    side = (high * F.lit(2 * scale) - middle) + (c - high) * F.lit(2 * scale)
    up = (side > 0) | ((side == 0) & (below % 2 == 1))
    return (below + F.when(up, 1).otherwise(0)).cast("double") / F.lit(scale)
