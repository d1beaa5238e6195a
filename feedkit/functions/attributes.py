"""Attribute maps: get, set, the JSON form, `name: value` lines and nanosecond times."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedkit.functions.binding import let

JSON_FORM = "array<struct<Name:string,Value:string>>"
NANOS = 1_000_000_000
_EDGES = r"(?U)^\s+|\s+$"
_RFC3339 = r"^(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d)(?:\.(\d{1,9}))?(Z|[+-]\d\d:\d\d)$"


def get_attr(attrs: Column, name: str | Column) -> Column:
    """Value of an attribute; a missing one reads as the empty string."""
    key = F.lit(name) if isinstance(name, str) else name
    return F.coalesce(F.try_element_at(attrs, key), F.lit(""))


def literal_attrs(pairs: Mapping[str, str | Column]) -> Column:
    """A map column from names to literals or Columns; null values are left out."""
    if not pairs:
        return F.expr("cast(map() as map<string,string>)")
    entries = [
        F.struct(
            F.lit(k).alias("key"),
            (v if isinstance(v, Column) else F.lit(v)).cast("string").alias("value"),
        )
        for k, v in pairs.items()
    ]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))


def set_attrs(attrs: Column, new: Column) -> Column:
    """Set every pair of `new` on `attrs`, replacing values that exist; no map counts as an empty one."""
    own = F.coalesce(attrs, literal_attrs({}))

    def merged(added: Column) -> Column:
        kept = F.map_filter(own, lambda k, v: ~F.map_contains_key(added, k))
        return F.map_concat(kept, added)

    return let(new, merged)


def attrs_to_json(attrs: Column) -> Column:
    """Ordered array of {Name, Value}; names are sorted so that the text is stable."""
    pairs = F.transform(
        F.array_sort(F.map_entries(attrs)),
        lambda e: F.struct(e["key"].alias("Name"), e["value"].alias("Value")),
    )
    return F.to_json(pairs)


def attrs_from_json(text: Column) -> Column:
    """Map from the {Name, Value} array; the last of several equal names wins."""
    pairs = F.from_json(text, JSON_FORM)
    return last_wins(F.transform(pairs, lambda p: F.struct(p["Name"].alias("key"), p["Value"].alias("value"))))


def last_wins(pairs: Column) -> Column:
    """Map from an array of structs (key, value) where a later pair replaces an earlier one."""

    def build(all_pairs: Column) -> Column:
        def is_last(pair: Column, i: Column) -> Column:
            later = F.slice(all_pairs, i + 2, F.size(all_pairs))
            return ~F.exists(later, lambda q: q["key"] == pair["key"])

        return F.map_from_entries(F.filter(all_pairs, is_last))

    return let(pairs, build)


def trim_space(text: Column) -> Column:
    """Strip Unicode white space from both ends."""
    return F.regexp_replace(text, _EDGES, "")


def attr_lines(text: Column) -> Column:
    """Array of (pos, name, value) from `name: value` lines; comments and other lines drop out."""
    split = F.transform(
        F.split(text, "\n"),
        lambda line, i: F.struct(i.alias("pos"), F.split(trim_space(line), ":", 2).alias("parts")),
    )
    kept = F.filter(
        split,
        lambda s: (F.size(s["parts"]) == 2) & ~F.get(s["parts"], F.lit(0)).startswith("#"),
    )
    return F.transform(
        kept,
        lambda s: F.struct(
            s["pos"].alias("pos"),
            trim_space(F.get(s["parts"], F.lit(0))).alias("name"),
            trim_space(F.get(s["parts"], F.lit(1))).alias("value"),
        ),
    )


def nanos(text: Column) -> Column:
    """RFC 3339 text with up to nine fraction digits as exact nanoseconds since the epoch.

    Null for other texts, and for times that 64 bits cannot count (before 1677, after 2262).
    """
    base, fraction, zone = (F.regexp_extract(text, _RFC3339, i) for i in (1, 2, 3))
    seconds = F.unix_seconds(F.concat(base, zone).try_cast("timestamp"))
    whole = F.try_multiply(seconds, F.lit(NANOS).cast("bigint"))
    return F.try_add(whole, F.rpad(fraction, 9, "0").cast("bigint"))


def rfc3339(ts: Column) -> Column:
    """Timestamp as RFC 3339 text with the session's zone offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
