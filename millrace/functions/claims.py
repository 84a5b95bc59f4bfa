"""Numeric claims of a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.bind import let
from millrace.plans.values import UNITS

# The units that follow a number, in the order in which they are tried, the rates after them, and rates told before.
UNIT_PATTERN = (
    r"(?:megawatt-hours?|kilowatt-hours?|gigawatt-hours?|terawatt-hours?|megawatts?|kilowatts?|gigawatts?|terawatts?|mwh|kwh|gwh|twh|mw|kw|gw|tw|percent|percentage|%|million|billion|trillion|"
    r"kilomet(?:er|re)s?|km|m[³3]|cubic\s+met(?:er|re)s?|tons?|tonnes?|years?|months?|days?)"
)
RATE_PATTERN = r"(?:\s*(?:/|per)\s*(?:days?|months?|years?)|\s+(?:daily|monthly|annually))?"
NUMBER_PATTERN = r"(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?"
RATE_WORDS = {"annual": "year", "yearly": "year", "daily": "day", "monthly": "month", "annually": "year"}
LEADING_RATE = r"\b(annual|yearly|daily|monthly)((?:\s+\w+){0,4}\s+(?:capacity|output)(?:\s+of)?\s*)"
UNRATED = ("%", "million", "billion", "trillion")

_ALONE = r"(?<![\p{L}\p{N}_])"
#: Stands before a number, around the rate that the words before it tell.
_MARK = "\x01"


def unit_name(unit: Column) -> Column:
    """A unit's short form, with its rate as ``/day``, ``/month`` or ``/year``."""
    names = F.create_map(*(F.lit(x) for pair in UNITS.items() for x in pair))
    short = lambda x: F.coalesce(F.try_element_at(names, x), x)

    def named(value: Column) -> Column:
        base, rate = F.substring_index(value, "/", 1), F.regexp_extract(value, r"/(.*)$", 1)
        return F.when(F.instr(value, "/") == 0, short(value)).otherwise(let(rate, lambda r: F.when(r == "", short(base)).otherwise(F.concat(short(base), F.lit("/"), short(r)))))

    return let(_folded_unit(unit), named)


def _folded_unit(unit: Column) -> Column:
    value = F.replace(F.regexp_replace(F.lower(F.trim(unit)), r"\s+", " "), F.lit("³"), F.lit("3"))
    value = F.regexp_replace(F.regexp_replace(value, r"\s+per\s+", "/"), r"\s*/\s*", "/")
    for word in ("daily", "monthly", "annually"):
        value = F.regexp_replace(value, rf" {word}$", f"/{RATE_WORDS[word]}")
    return value


def number_text(number: Column) -> Column:
    """A number's shortest decimal spelling."""
    plain = F.replace(number, F.lit(","), F.lit(""))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(plain, r"(\.\d*?)0+$", "$1"), r"\.$", ""), r"^0+(?=\d)", "")


def numeric_claims(text: Column) -> Column:
    """array<struct<value, unit>>: the dates, of unit ``date``, then the numbers in order; addresses are left out.

    ``unit`` is empty without one. A rate told before a number, as in *annual capacity of 5 MW*, counts for its unit.
    """
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?i)https?://[^\s)>\]]+", " ")
    day = r"\b(\d{4}-\d{1,2}-\d{1,2})\b"
    dates = F.transform(F.regexp_extract_all(bare, F.lit(day), 1), lambda d: F.struct(F.regexp_replace(d, r"-0+(?=\d)", "-").alias("value"), F.lit("date").alias("unit")))
    dates = F.transform(dates, lambda d: F.struct(F.regexp_replace(d["value"], r"^0+(?=\d)", "").alias("value"), d["unit"].alias("unit")))
    undated = F.replace(F.regexp_replace(bare, day, " "), F.lit(_MARK), F.lit(" "))
    marked = F.regexp_replace(undated, rf"(?i){LEADING_RATE}{_ALONE}(?=\d)", f"$1$2{_MARK}$1{_MARK}")
    unit = rf"\s*(?:(?:more|additional)\s+|-\s*)?({UNIT_PATTERN}{RATE_PATTERN})"
    found = F.regexp_extract_all(marked, F.lit(rf"(?i)((?:{_MARK}\w+{_MARK})?{_ALONE}{NUMBER_PATTERN}(?:{unit})?)"), 1)
    rates = F.create_map(*(F.lit(x) for pair in RATE_WORDS.items() for x in pair))

    def rated(name: Column, x: Column) -> Column:
        rate = F.try_element_at(rates, F.lower(F.regexp_extract(x, rf"^{_MARK}(\w+){_MARK}", 1)))
        return F.when((name != "") & x.startswith(_MARK) & ~name.contains("/") & ~name.isin(*UNRATED), F.coalesce(F.concat(name, F.lit("/"), rate), name)).otherwise(name)

    def claim(x: Column) -> Column:
        said = F.regexp_extract(x, rf"(?i)^(?:{_MARK}\w+{_MARK})?{NUMBER_PATTERN}{unit}$", 1)
        name = let(said, lambda u: F.when(u == "", "").otherwise(let(unit_name(u), lambda n: rated(n, x))))
        return F.struct(number_text(F.regexp_extract(x, rf"^(?:{_MARK}\w+{_MARK})?({NUMBER_PATTERN})", 1)).alias("value"), name.alias("unit"))

    return F.concat(dates, F.transform(found, claim))


def unsupported(claims: Column, evidence: Column) -> Column:
    """The distinct claims that no evidence has: the value, and the unit, one that it is a rate of, or none asked for."""
    rate_of = lambda c, e: ~c["unit"].contains("/") & F.startswith(e["unit"], F.concat(c["unit"], F.lit("/")))
    return F.array_distinct(F.filter(claims, lambda c: ~F.exists(evidence, lambda e: (c["value"] == e["value"]) & ((c["unit"] == "") | (c["unit"] == e["unit"]) | rate_of(c, e)))))
