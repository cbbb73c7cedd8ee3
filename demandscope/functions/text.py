"""Text and category column functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed spellings that count as missing in delimited files.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: Fixed province codes of distributor ids.
PROVINCES = {"W": "Western", "C": "Central", "S": "Southern", "NW": "North Western", "E": "Eastern", "NC": "North Central", "U": "Uva", "SG": "Sabaragamuwa", "N": "Northern"}


def missing_to_null(c: Column) -> Column:
    return F.when(~c.isin(*MISSING), c)


def lookup(c: Column, values: Mapping[str, object], default=None) -> Column:
    """Value of a small fixed mapping, or ``default``."""
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    found = F.try_element_at(table, F.coalesce(c, F.lit("\0")))
    return found if default is None else F.coalesce(found, F.lit(default))


def respell(c: Column, values: Mapping[str, str]) -> Column:
    """Whole-value replacement."""
    return F.coalesce(lookup(c, values), c)


def title(c: Column) -> Column:
    """Upper-case first letters of words apart by spaces."""
    return F.initcap(F.trim(c))


def province(distributor: Column) -> Column:
    """Province of an id like DIST_<code>_<number>: Other for an unknown code, Unknown without one."""
    parts = F.split(distributor, "_")
    return F.when(F.size(parts) > 1, lookup(F.get(parts, F.lit(1)), PROVINCES, "Other")).otherwise(F.lit("Unknown"))


def indicator_names(name: str, values: Sequence[str], drop_first: bool = True) -> dict[str, str]:
    """Column names ``name_value`` of a fixed vocabulary, with their values, without the first in order if asked."""
    return {f"{name}_{v}": v for v in sorted(values)[1 if drop_first else 0 :]}


def indicators(name: str, values: Sequence[str], drop_first: bool = True) -> dict[str, Column]:
    """0/1 columns of ``indicator_names``; a missing value gives zeros."""
    return {k: F.coalesce((F.col(name) == F.lit(v)).cast("int"), F.lit(0)) for k, v in indicator_names(name, values, drop_first).items()}
