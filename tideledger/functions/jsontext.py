"""JSON kept as text in table columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .amounts import col

HOP_SCHEMA = (
    "array<struct<chain_id:bigint,amount:string,"
    "token:struct<symbol:string,name:string,address:string,decimals:int>>>"
)


def text_array(c) -> Column:
    return F.from_json(col(c), "array<string>")


def text_map(c) -> Column:
    """Object with free keys; drops nothing."""
    return F.from_json(col(c), "map<string,string>")


def route_hops(c) -> Column:
    return F.from_json(col(c), HOP_SCHEMA)


def first_item(array: Column) -> Column:
    return F.get(array, F.lit(0))


def last_item(array: Column) -> Column:
    return F.try_element_at(array, F.lit(-1))


def without_zero_address(fees: Column) -> Column:
    return F.map_filter(fees, lambda k, _: ~F.lower(k).rlike("^0x0*$"))


def nth_fee(fees: Column, n: int) -> tuple[Column, Column]:
    """Key and value of the ``n``-th entry in the order the text lists them."""
    entry = F.get(F.map_entries(fees), F.lit(n))
    return entry["key"], entry["value"]


def extracted(c, pattern: str, group: int = 1) -> Column:
    """Regex group, null when there is no match."""
    return F.when(col(c).rlike(pattern), F.regexp_extract(col(c), pattern, group))


def bracket_list(c) -> Column:
    """``['a', 'b']`` to ``a, b``; text without brackets is kept."""
    c = col(c)
    return F.coalesce(F.regexp_replace(extracted(c, r"\[(.*?)\]"), "'", ""), c)
