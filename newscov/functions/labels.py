"""Label lists: display names to codes, themes, membership."""

from __future__ import annotations

from functools import reduce
from itertools import chain
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from newscov.taxonomy import CATEGORIES, EXPLORER_SPELLINGS, REACHABLE_CODES, THEME_CODES


def lookup(mapping: dict, key: Column) -> Column:
    """Value of ``key`` in a small fixed mapping, null when absent."""
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items())
    return F.try_element_at(F.create_map(*pairs), key)


def code_of(label: Column) -> Column:
    """Code of a display name or code; null when the label is unknown."""
    known = {code: code for code in REACHABLE_CODES} | {name: code for name, code, _ in CATEGORIES}
    return lookup(known, label)


def explorer_code_of(label: Column) -> Column:
    """``code_of`` that also knows the explorer's own spellings."""
    return F.coalesce(code_of(label), lookup(EXPLORER_SPELLINGS, label))


def theme_of(code: Column) -> Column:
    """Theme of a code; null when the code is unknown."""
    return lookup({code: theme for theme, codes in THEME_CODES.items() for code in codes}, code)


def coded_labels(*labels: str | Column) -> Column:
    """Label columns as a list of codes: unknown and null dropped, order and repeats kept."""
    return F.array_compact(F.transform(F.array(*labels), code_of))


def present_labels(*labels: str | Column) -> Column:
    """Label columns as a list without nulls, spellings untouched."""
    return F.array_compact(F.array(*labels))


def themes(*codes: str | Column) -> Column:
    """Distinct themes of the code columns, sorted; unknown codes ignored."""
    found = F.array_compact(F.transform(F.array(*codes), theme_of))
    return F.array_sort(F.array_distinct(found))


def indicators(labels: Column, codes: list[str]) -> list[Column]:
    """One 0/1 column per code."""
    return [F.array_contains(labels, code).cast("int").alias(code) for code in codes]


def any_in(columns: list[str], selection: list[str]) -> Column:
    """Filter for rows where any of the columns holds a selected value; null alone is no match.

    Plain comparisons, so that stored columns are filtered in the scan.
    """
    return reduce(or_, [F.col(c).isin(list(selection)) for c in columns])


def all_in(columns: list[str], allowed: list[str]) -> Column:
    """Filter for rows where every non-null column value is allowed."""
    return reduce(and_, [F.col(c).isNull() | F.col(c).isin(list(allowed)) for c in columns])
