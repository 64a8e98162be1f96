"""Text, map, JSON-envelope and time expressions (all native Spark)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

YEAR_KEY = r"^[0-9]{4}$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_year_key(m: Column | str) -> Column:
    """Largest 4-digit key of a ``map<string, *>`` (null when there is none)."""
    return F.array_max(F.filter(F.map_keys(_c(m)), lambda k: k.rlike(YEAR_KEY)))


def year_value(m: Column | str, year: int | Column) -> Column:
    """Value at ``year``, else at the latest 4-digit year key.

    A JSON null at the asked year counts as absent, as it does for a dict
    lookup followed by an ``is None`` test.
    """
    m = _c(m)
    y = year.cast("string") if isinstance(year, Column) else F.lit(str(year))
    latest = latest_year_key(m)
    return F.coalesce(F.try_element_at(m, y),
                      F.when(latest.isNotNull(), F.try_element_at(m, latest)))


def year_used(m: Column | str, year: int | Column) -> Column:
    """The year whose value ``year_value`` returned (``ano_origem``)."""
    m = _c(m)
    y = year.cast("string") if isinstance(year, Column) else F.lit(str(year))
    latest = latest_year_key(m)
    return F.when(F.try_element_at(m, y).isNotNull(), y.cast("int")).otherwise(
        F.when(latest.isNotNull() & F.try_element_at(m, latest).isNotNull(), latest.cast("int")))


def unwrap_envelope(j: Column | str, element: T.DataType, fields: Sequence[str]) -> Column:
    """The record array of a JSON payload that is either a bare list or an
    object whose first *present* field among ``fields`` holds the list.

    The list test is done on the text: parsing an object as an array would
    yield a one-element array of nulls and hide the envelope.
    """
    j = _c(j)
    arr = T.ArrayType(element)
    obj = F.from_json(j, T.StructType([T.StructField(f, arr) for f in fields]))
    keys = F.json_object_keys(j)
    pick = None
    for f in fields:
        cond = F.array_contains(keys, f)
        pick = F.when(cond, obj[f]) if pick is None else pick.when(cond, obj[f])
    is_list = F.ltrim(j).startswith("[")
    return F.when(is_list, F.from_json(j, arr)).otherwise(pick)


def run_stamp(ts: Column | None = None) -> Column:
    """Run stamp ``yyyyMMdd_HHmmss``."""
    return F.date_format(ts if ts is not None else F.current_timestamp(), "yyyyMMdd_HHmmss")


def iso_stamp(ts: Column | None = None) -> Column:
    """ISO-8601 local time text with microseconds."""
    return F.date_format(ts if ts is not None else F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def truthy_text(c: Column | str) -> Column:
    """Non-null and non-empty text."""
    c = _c(c)
    return c.isNotNull() & (c.cast("string") != "")


def truthy_number(c: Column | str) -> Column:
    """Non-null and non-zero number."""
    c = _c(c)
    return c.isNotNull() & (c != 0)


def upper_matches(c: Column | str, pattern: str) -> Column:
    """Regex search on the upper-cased text; null never matches."""
    return F.coalesce(F.upper(_c(c).cast("string")).rlike(pattern), F.lit(False))


def clean_name(c: Column | str) -> Column:
    """Lower case, spaces to underscores (file-name cleaning)."""
    return F.replace(F.lower(_c(c)), F.lit(" "), F.lit("_"))
