"""Chain of custody: stamp hops, read them back, and measure the time between them.

Hop 0 is the newest. All hops of a file sit in its attribute map, so stamping, shifting and exploding
work row by row and never shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedkit.functions.attributes import get_attr, literal_attrs, nanos, rfc3339, set_attrs
from feedkit.plans.quantiles import exact_summary

# Attribute names of one hop, as <prefix>.<number>.<field>.
PREFIX = "custodyChain"
FIELDS = {
    "action": "action",
    "hostname": "local.hostname",
    "request_uri": "request.uri",
    "source_host": "source.host",
    "source_port": "source.port",
    "protocol": "protocol",
    "local_host": "local.host",
    "local_port": "local.port",
}
# Numbers as hops are written: no leading zeros, and room to count up; other names are left alone.
_NUMBERED = r"^custodyChain\.(0|[1-9]\d{0,17})\.(.*)$"


def shifted(attrs: Column) -> Column:
    """Every hop's number goes up by one."""

    def renumber(k: Column, v: Column) -> Column:
        n = F.regexp_extract(k, _NUMBERED, 1).try_cast("bigint")
        moved = F.concat_ws(".", F.lit(PREFIX), (n + 1).cast("string"), F.regexp_extract(k, _NUMBERED, 2))
        return F.when(k.rlike(_NUMBERED), moved).otherwise(k)

    return F.transform_keys(attrs, renumber)


def shift_chain(files: DataFrame, at: Column | None = None) -> DataFrame:
    """Renumber the chain and open hop 0 with the time `at` (now, unless given)."""
    opened = literal_attrs({f"{PREFIX}.0.time": at if at is not None else rfc3339(F.current_timestamp())})
    return files.withColumn("attrs", set_attrs(shifted(F.col("attrs")), opened))


def static_map(static: Mapping[str, str] | DataFrame) -> Column:
    """Static attributes as one map column.

    A DataFrame (pos, name, value) is read through a scalar subquery, so it never joins the files;
    of lines with one name the last wins, which partial aggregation decides.
    """
    if isinstance(static, Mapping):
        return literal_attrs(static)
    last = static.filter(F.col("name").isNotNull()).groupBy("name")
    last = last.agg(F.max_by("value", F.struct("pos", "value")).alias("value")).filter("value is not null")
    pairs = F.map_from_entries(F.collect_list(F.struct("name", "value")))
    return last.agg(pairs.alias("static")).scalar()


def attach_static_attrs(files: DataFrame, static: Mapping[str, str] | DataFrame) -> DataFrame:
    """Set each static pair on every row, replacing values that exist."""
    carried = files.withColumn("_static", static_map(static))
    return carried.withColumn("attrs", set_attrs(F.col("attrs"), F.col("_static"))).drop("_static")


def stamp_hop(
    files: DataFrame,
    label: str,
    host: str | Column | None = None,
    request: Mapping[str, Column | str] | None = None,
    update_chain: bool = True,
    static: Mapping[str, str] | DataFrame | None = None,
    at: Column | None = None,
) -> DataFrame:
    """Record a hop: static attributes, shift, action, then host and request details.

    `request` may name request_uri, source_host, source_port, protocol, local_host and local_port.
    With `update_chain=False` only the time and the action are recorded.
    """
    if static is not None:
        files = attach_static_attrs(files, static)
    hop: dict[str, str | Column] = {}
    if label:
        hop["action"] = label
    if update_chain:
        if host is not None:
            hop["hostname"] = host
        details = dict(request or {})
        unknown = set(details) - set(FIELDS)
        if unknown:
            raise ValueError(f"unknown request fields: {sorted(unknown)}")
        if "local_host" in details:
            local = details["local_host"]
            local = local if isinstance(local, Column) else F.lit(local)
            details["local_host"] = F.nullif(local, F.lit(""))
        hop.update(details)
    named = {f"{PREFIX}.0.{FIELDS[k]}": v for k, v in hop.items()}
    named[f"{PREFIX}.0.time"] = at if at is not None else rfc3339(F.current_timestamp())
    return files.withColumn("attrs", set_attrs(shifted(F.col("attrs")), literal_attrs(named)))


def hop_numbers(attrs: Column) -> Column:
    """Sorted numbers of the hops that the map holds, newest first."""
    numbers = F.transform(
        F.map_keys(attrs), lambda k: F.regexp_extract(k, _NUMBERED, 1).try_cast("int")
    )
    return F.array_sort(F.array_distinct(F.filter(numbers, lambda n: n.isNotNull())))


def explode_hops(files: DataFrame, keys: Sequence[str] = ("uuid",)) -> DataFrame:
    """One row per hop with typed columns; absent fields are null."""
    hops = files.select(*keys, "attrs", F.explode_outer(hop_numbers(F.col("attrs"))).alias("hop"))
    hops = hops.filter(F.col("hop").isNotNull())

    def field(name: str) -> Column:
        key = F.concat_ws(".", F.lit(PREFIX), F.col("hop").cast("string"), F.lit(name))
        return F.nullif(get_attr(F.col("attrs"), key), F.lit(""))

    typed = {k: field(v) for k, v in FIELDS.items()}
    return hops.select(
        *keys,
        "hop",
        typed.pop("action").alias("action"),
        typed.pop("hostname").alias("hostname"),
        nanos(field("time")).alias("ts_ns"),
        *[c.alias(k) for k, c in typed.items()],
    )


def latest_hops(hops: DataFrame, key: str = "uuid", ts: str = "ts_ns") -> DataFrame:
    """One row per hop number: `_ts` and `action` of the latest record; no action reads as empty."""
    known = F.struct(F.col(ts).isNotNull(), F.col(ts), F.coalesce("action", F.lit("")))
    action = F.max_by(F.coalesce("action", F.lit("")), known)
    return hops.groupBy(key, "hop").agg(F.max(ts).alias("_ts"), action.alias("action"))


def hop_pairs(hops: DataFrame, key: str = "uuid", ts: str = "ts_ns") -> DataFrame:
    """Adjacent hops of a file, from hop rows: from_action, to_action, elapsed.

    The rows are first reduced to one per hop number in the map tasks, the latest where a hop was
    recorded again. What is left of a key is one chain, which is no longer than a file's attributes
    allow, so a window can walk it.
    """
    once = latest_hops(hops, key, ts)
    chain = Window.partitionBy(key).orderBy(F.desc("hop"))
    return (
        once.withColumns(
            {"_before": F.lag("_ts").over(chain), "_from": F.lag("action").over(chain)}
        )
        .select(
            key,
            F.coalesce("_from", F.lit("")).alias("from_action"),
            F.coalesce("action", F.lit("")).alias("to_action"),
            (F.col("_ts") - F.col("_before")).alias("elapsed"),
        )
        .filter(F.col("elapsed").isNotNull())
    )


def attr_hop_pairs(files: DataFrame, keys: Sequence[str] = ("uuid",)) -> DataFrame:
    """The same pairs from the attribute map: each file brings its own, and nothing shuffles."""
    attrs = F.col("attrs")

    def field(hop: Column, name: str) -> Column:
        return get_attr(attrs, F.concat_ws(".", F.lit(PREFIX), hop.cast("string"), F.lit(name)))

    hops = F.transform(
        hop_numbers(attrs),
        lambda n: F.struct(field(n, "action").alias("action"), nanos(field(n, "time")).alias("ts")),
    )
    chains = files.select(*keys, hops.alias("_chain"))
    # The outer form keeps Spark from computing the chain a second time to test its size.
    placed = chains.select(*keys, "_chain", F.posexplode_outer("_chain").alias("_i", "_newer"))
    older = F.get("_chain", F.col("_i") + 1)
    return placed.select(
        *keys,
        older["action"].alias("from_action"),
        F.col("_newer.action").alias("to_action"),
        (F.col("_newer.ts") - older["ts"]).alias("elapsed"),
    ).filter(F.col("elapsed").isNotNull())


def hop_latency(hops: DataFrame, key: str = "uuid", ts: str = "ts_ns") -> DataFrame:
    """Time between adjacent hops by (from_action, to_action), from hop rows."""
    return latency_of_pairs(hop_pairs(hops, key, ts))


def latency_of_pairs(pairs: DataFrame) -> DataFrame:
    """n, sum (decimal), avg, p50, p95 and max of `elapsed` by (from_action, to_action).

    The percentiles are exact, interpolated between neighbours and rounded to whole units.
    """
    by = ["from_action", "to_action"]
    summary = exact_summary(pairs, by, "elapsed", {"p50": 0.5, "p95": 0.95})
    return summary.select(
        *by,
        "n",
        "sum",
        (F.col("sum").cast("double") / F.col("n")).alias("avg"),
        F.floor(F.col("p50") + 0.5).alias("p50"),
        F.floor(F.col("p95") + 0.5).alias("p95"),
        "max",
    )


def custody_path(attrs: Column) -> Column:
    """The actions a file took, oldest first, from its own attributes."""
    actions = F.transform(
        F.reverse(hop_numbers(attrs)),
        lambda n: get_attr(attrs, F.concat_ws(".", F.lit(PREFIX), n.cast("string"), F.lit("action"))),
    )
    return F.array_join(actions, ">")


def custody_paths(hops: DataFrame, key: str = "uuid", ts: str = "ts_ns") -> DataFrame:
    """How many files took each action sequence.

    A file has one action per hop number, the latest recorded, so the rows are first reduced to that:
    a key that repeats endlessly shrinks in the map tasks.
    """
    once = latest_hops(hops, key, ts)
    paths = once.groupBy(key).agg(
        F.expr("listagg(action, '>') WITHIN GROUP (ORDER BY hop DESC)").alias("path")
    )
    return paths.groupBy("path").agg(F.count(F.lit(1)).alias("files"))


def append_forwarded_for(
    files: DataFrame, remote: str | Column, column: str = "forwarded_for"
) -> DataFrame:
    """Put the remote address before the earlier ones, newest first."""
    address = remote if isinstance(remote, Column) else F.lit(remote)
    earlier = F.nullif(F.col(column), F.lit("")) if column in files.columns else F.lit(None).cast("string")
    return files.withColumn(column, F.concat_ws(",", address, earlier))
