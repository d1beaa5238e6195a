"""Row schemas: a feed is a table of files, fragments, frames, packets, hops or meter samples.

Attributes are strings on every row; the ones that operators read often are typed columns, the rest
stay in one open map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.functions.attributes import get_attr
from feedkit.functions.binding import let

FILES = (
    "seq bigint, batch_id string, uuid string, kind string, path string, filename string, "
    "size bigint, content binary, checksum_type string, checksum string, arrived_at timestamp, "
    "attrs map<string,string>"
)
FRAGMENTS = (
    "identifier string, path string, filename string, idx bigint, cnt bigint, offset bigint, "
    "part binary, checksum_type string, checksum string, orig_size bigint, orig_filename string, "
    "orig_checksum_type string, orig_checksum string, arrival bigint, arrived_at timestamp"
)
FRAMES = (
    "port int, arrival bigint, arrived_at timestamp, uuid string, size bigint, offset bigint, "
    "mtu int, payload binary"
)
PACKETS = (
    "socket_id string, n bigint, op string, payload binary, arrival bigint, arrived_at timestamp"
)
HOPS = (
    "uuid string, hop int, action string, hostname string, ts_ns bigint, request_uri string, "
    "source_host string, source_port string, protocol string, local_host string, local_port string"
)
METRICS = "host string, action string, ts timestamp, size bigint, files bigint"

# Attribute names that older feeds spell differently (current name, older name).
OLD_SPELLINGS = (
    ("checksumType", "checksum-type"),
    ("file.lastModifiedTime", "modtime"),
)


def canonical_attrs(files: DataFrame, attrs: str = "attrs") -> DataFrame:
    """Fold older attribute spellings into the current ones; a current value wins."""
    folded = F.col(attrs)
    for current, older in OLD_SPELLINGS:
        folded = _renamed(folded, older, current)
    return files.withColumn(attrs, folded)


def _renamed(attrs: Column, older: str, current: str) -> Column:
    """The map with one attribute renamed; it is dropped where the current name is set already."""

    def fold(a: Column) -> Column:
        kept = F.map_filter(a, lambda k, v: k != older)
        renamed = F.map_concat(kept, F.create_map(F.lit(current), F.element_at(a, older)))
        return (
            F.when(~F.map_contains_key(a, older), a)
            .when(F.map_contains_key(a, current), kept)
            .otherwise(renamed)
        )

    return let(attrs, fold)


def promote_attrs(rows: DataFrame, attrs: str = "attrs") -> DataFrame:
    """Typed columns of the `files` schema from the open attribute map."""
    a = F.col(attrs)
    return (
        canonical_attrs(rows, attrs)
        .withColumn("path", get_attr(a, "path"))
        .withColumn("filename", get_attr(a, "filename"))
        .withColumn("kind", get_attr(a, "kind"))
        .withColumn("uuid", get_attr(a, "uuid"))
        .withColumn("checksum_type", get_attr(a, "checksumType"))
        .withColumn("checksum", get_attr(a, "checksum"))
    )
