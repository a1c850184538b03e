"""Cleaning expressions for dirty text columns.

All builders return one Column made of built-in expressions, so a whole table
is cleaned in a single projection that stays inside code generation. Casts are
``try_`` casts: bad text becomes null under ANSI mode instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text patterns ------------------------------------------------
PLAIN_NUMBER = r"^-?\d+(?:\.\d+)?$"
FIRST_NUMBER = r"([-+]?\d*\.?\d+)"
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
PLACEHOLDER = r"_{2,}"
BEHAVIOUR = r"(Low|High)_spent_(Small|Medium|Large)_value"
LIST_SEPARATOR = r",\s*and\s+|\s+and\s+|,\s*"
LIST_SEPARATOR_LEGACY = r", |, and "


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cast_number(c: Column | str, dtype: str) -> Column:
    """Text to number; decimals text such as ``3.7`` truncates to int 3."""
    c = _col(c)
    if dtype in ("int", "bigint"):
        return c.try_cast("double").try_cast(dtype)
    return c.try_cast(dtype)


def clean_numeric(c: Column | str, dtype: str, low=None, high=None) -> Column:
    """Strict number: null when text starts or ends with ``_``, is not a plain
    number once inner ``_`` are removed, or lies outside ``[low, high]``."""
    text = _col(c).cast("string")
    body = F.translate(text, "_", "")
    number = cast_number(body, dtype)
    ok = ~text.startswith("_") & ~text.endswith("_") & body.rlike(PLAIN_NUMBER)
    if low is not None:
        ok = ok & (number >= F.lit(low))
    if high is not None:
        ok = ok & (number <= F.lit(high))
    return F.when(ok, number)


def extract_number(c: Column | str, dtype: str) -> Column:
    """Lenient number: the first numeric token of the text (``39_`` gives 39)."""
    token = F.regexp_extract(_col(c).cast("string"), FIRST_NUMBER, 1)
    return cast_number(F.nullif(token, F.lit("")), dtype)


def digits_only(c: Column | str, low: int = 18, high: int = 100) -> Column:
    """Digits of the text as int, kept when inside ``[low, high]``."""
    digits = F.regexp_replace(_col(c).cast("string"), "[^0-9]", "")
    number = cast_number(F.nullif(digits, F.lit("")), "int")
    return F.when(number.between(low, high), number)


def valid_range(c: Column | str, low=None, high=None) -> Column:
    """Value when inside the closed range, else null."""
    c = _col(c)
    ok = F.lit(True)
    if low is not None:
        ok = ok & (c >= F.lit(low))
    if high is not None:
        ok = ok & (c <= F.lit(high))
    return F.when(ok, c)


def null_placeholder(c: Column | str, pattern: str = PLACEHOLDER) -> Column:
    """Null where the text holds a placeholder run, trimmed text elsewhere."""
    c = _col(c)
    return F.when(~c.rlike(pattern), F.trim(c))


def null_tokens(c: Column | str, tokens: Sequence[str]) -> Column:
    """Null where the text equals one of the tokens."""
    c = _col(c)
    return F.when(~c.isin(*tokens), c)


def valid_pattern(c: Column | str, pattern: str = SSN_PATTERN) -> Column:
    """Text when it matches the whole pattern, else null."""
    c = _col(c)
    return F.when(c.rlike(pattern), c)


def ordinal_map(c: Column | str, ranks: Mapping[str, int]) -> Column:
    """Rank of a category; anything outside the mapping becomes null."""
    c = _col(c)
    out = None
    for value, rank in ranks.items():
        out = F.when(c == value, rank) if out is None else out.when(c == value, rank)
    return out


def yes_flag(c: Column | str, yes: str = "Yes") -> Column:
    """1 for ``yes``; 0 for everything else, null included."""
    return F.when(_col(c) == yes, 1).otherwise(0)


def behaviour_level(c: Column | str, ranks: Mapping[str, int]) -> Column:
    """Rank of the spending level that the text starts with (``High_spent...``)."""
    c = _col(c)
    out = None
    for name, rank in ranks.items():
        hit = c.startswith(f"{name}_spent")
        out = F.when(hit, rank) if out is None else out.when(hit, rank)
    return out


def behaviour_value(c: Column | str, ranks: Mapping[str, int]) -> Column:
    """Rank of the payment size named in the text (``..._Small_value...``)."""
    c = _col(c)
    out = None
    for name, rank in ranks.items():
        hit = c.contains(f"{name}_value")
        out = F.when(hit, rank) if out is None else out.when(hit, rank)
    return out


def behaviour_part(c: Column | str, part: int) -> Column:
    """Text part of a behaviour: 1 = spending level, 2 = payment size."""
    return F.nullif(F.regexp_extract(_col(c), BEHAVIOUR, part), F.lit(""))


def duration_part(c: Column | str, unit: str) -> Column:
    """Number in front of a unit, e.g. ``Year`` in ``22 Years and 1 Months``."""
    token = F.regexp_extract(_col(c), rf"(\d+)\s+{unit}", 1)
    return cast_number(F.nullif(token, F.lit("")), "int")


def duration_to_months(c: Column | str, months_required: bool = True) -> Column:
    """``22 Years and 1 Months`` as months. With ``months_required`` a missing
    month part makes the whole value null, otherwise it counts as 0."""
    years = duration_part(c, "Years")
    months = duration_part(c, "Months")
    return years * 12 + (months if months_required else F.coalesce(months, F.lit(0)))


def list_items(c: Column | str, legacy_split: bool = False) -> Column:
    """Distinct lower-case items of ``A, B, and C`` text; null stays null.

    ``legacy_split`` keeps ``and`` glued to the last item, as older tables did.
    """
    pattern = LIST_SEPARATOR_LEGACY if legacy_split else LIST_SEPARATOR
    return F.array_distinct(
        F.transform(F.split(_col(c), pattern), lambda x: F.lower(F.trim(x)))
    )


def list_distinct_count(c: Column | str, legacy_split: bool = False) -> Column:
    """Number of distinct items, 0 for null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.size(list_items(c, legacy_split))).otherwise(0)


def list_keys(c: Column | str) -> Column:
    """All items (repeats kept) as snake-case keys, empty items dropped."""
    parts = F.split(F.replace(_col(c), F.lit(" and "), F.lit(",")), ",")
    keys = F.transform(parts, lambda x: F.lower(F.replace(F.trim(x), F.lit(" "), F.lit("_"))))
    return F.filter(keys, lambda k: k != "")


def list_count_of(c: Column | str, key: str) -> Column:
    """How often one key occurs in the list text, 0 for null."""
    c = _col(c)
    hits = F.size(F.filter(list_keys(c), lambda k: k == key))
    return F.when(c.isNotNull(), hits).otherwise(0)


def bin_numeric(c: Column | str, edges: Sequence, labels: Sequence[str], null_label: str | None = None) -> Column:
    """Label of the band a number falls into; band i is below ``edges[i]`` and
    the last label takes the rest. Null gives ``null_label``."""
    c = _col(c)
    out = F.when(c.isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels):
        out = out.when(c < edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def fill_category(c: Column | str, token: str = "Unknown") -> Column:
    return F.coalesce(_col(c), F.lit(token))


def cap_constant(c: Column | str, high, low=None) -> Column:
    """Clip to constants; null stays null."""
    c = _col(c)
    out = F.when(c > F.lit(high), F.lit(high))
    if low is not None:
        out = out.when(c < F.lit(low), F.lit(low))
    return out.otherwise(c)
