"""How the sources of a language differ in their terms, from stripes of counts.

Terms are runs of letters a to z and of all characters from U+0080 on, A-Z folded. Each task folds whole
documents into stripes, term -> (document frequency, count by source), and spills them when they grow
large; stripes are merged by (language, term). Terms in too few documents of their language go. The
merged stripes give the divergences directly: a bucket of a language's stripes meets that language's
sources once and yields its share of all pairs' sums, and its best terms of each group.

A group is a (language, source) that occurs, with or without terms. With count n of a term, N of all kept
terms and V kept terms, p = 1 + floor(10^9 (n + 1) / (N + V)), for a group and for its whole language (q).
A difference is floor((p - q)^2 / q). All of it is integer arithmetic; counts up to 9 * 10^15 are exact.

`pair` rows: for each group, every other source of the language (q its p), summed over the language's kept
terms, whether they occur or not. `term` rows: for each group, the kept terms that occur there with p > q,
the `top` largest differences. Ranks are by value, then by the item's bytes.

Null text, language and source count as empty strings; empty and long texts are read whole; repeated rows
are documents of their own; ids are not read; an empty table gives no rows; other columns are not read.
A language without kept terms has pairs of value 0 and no term rows; one with a single source has no pairs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedkit.plans.settle import settle
from feedkit.plans.skew import salted_lookup

#: A task's stripes are spilled beyond so many counts, or bytes of terms.
MOST_COUNTS, MOST_BYTES = 500_000, 32 << 20
#: Counts of a bucket of merged stripes, and cells of a matrix that are worked on at once.
BUCKET_COUNTS, CELLS = 200_000, 1 << 20
SCALE = 1_000_000_000

_FOLD = bytes(c | 0x20 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of UTF-8 text."""
    # What is no term becomes a blank; bytes.split() parts at ASCII white space alone.
    return text.translate(_FOLD).split()


def fold(docs: DataFrame) -> DataFrame:
    """Stripes: lang, term, docs (that hold the term), sources and counts (lists of one length)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Most terms have one source: a stripe is [documents, source, count] until a second one comes, then
        # [documents, {source: count}].
        stripes: dict[str, dict[bytes, list]] = {}
        counts = held = 0

        def spill() -> Iterator[pa.RecordBatch]:
            for lang, own in stripes.items():
                entries = list(own.values())
                by = [((s[1], s[2]),) if len(s) == 3 else tuple(s[1].items()) for s in entries]
                offsets = pa.array(np.cumsum([0, *map(len, by)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(own), pa.string()),
                        pa.array(list(own), pa.binary()).cast(pa.string()),
                        pa.array([s[0] for s in entries], pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array([x for pairs in by for x, _ in pairs], pa.string())),
                        pa.ListArray.from_arrays(offsets, pa.array([n for pairs in by for _, n in pairs], pa.int64())),
                    ],
                    names=["lang", "term", "docs", "sources", "counts"],
                )
            stripes.clear()

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = stripes.setdefault(lang, {})
                for term, n in Counter(terms(text)).items():
                    stripe = own.get(term)
                    if stripe is None:
                        own[term] = [1, source, n]
                        counts, held = counts + 1, held + len(term)
                        continue
                    stripe[0] += 1
                    if len(stripe) == 3:
                        if stripe[1] == source:
                            stripe[2] += n
                            continue
                        stripe[1:] = [{stripe[1]: stripe[2]}]
                    by = stripe[1]
                    if source in by:
                        by[source] += n
                    else:
                        by[source] = n
                        counts += 1
                if counts > MOST_COUNTS or held > MOST_BYTES:
                    yield from spill()
                    counts = held = 0
        yield from spill()

    rows = docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    return rows.mapInArrow(run, "lang string, term string, docs bigint, sources array<string>, counts array<bigint>")


def merge(stripes: DataFrame, least_docs: int) -> DataFrame:
    """lang, term, total, by (list of source and n): merged stripes of terms in enough documents."""
    # One exchange by (lang, term) serves both aggregations.
    dealt = stripes.repartition("lang", "term")
    each = dealt.select("lang", "term", "docs", F.posexplode(F.arrays_zip("sources", "counts")).alias("at", "one"))
    each = each.select(
        "lang", "term", F.when(F.col("at") == 0, F.col("docs")).otherwise(0).alias("docs"),
        F.col("one.sources").alias("source"), F.col("one.counts").alias("n"),
    )
    each = each.groupBy("lang", "term", "source").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    whole = each.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("by")
    )
    return whole.filter(F.col("docs") >= least_docs).select("lang", "term", "total", "by")


def share(n: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE (n + 1) / whole), digit by digit: no product leaves 64 bits."""
    n, whole = np.broadcast_arrays(np.asarray(n, np.int64) + 1, np.asarray(whole, np.int64))
    out, rest = np.divmod(n, whole)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _sums(base: np.ndarray, term: np.ndarray, source: np.ndarray, p: np.ndarray, first: int, last: int) -> np.ndarray:
    """For sources first to last against all: differences summed over a bucket's terms.

    Counts are given as (term, source, p), sorted by term; a source's `base` is its p of absent terms.
    """
    many, block = len(base), slice(first, last)
    n_terms = int(term[-1]) + 1 if len(term) else 0
    out = np.zeros((last - first, many), np.int64)
    both = np.zeros((last - first, many), np.int64)
    step = max(1, CELLS // max(many, 1))
    begin = 0
    while begin < len(term):  # whole terms, so that a term's counts are seen together
        end = min(begin + step, len(term))
        end = int(np.searchsorted(term, term[end - 1], "right"))
        rows = term[begin:end] - term[begin]
        own = np.broadcast_to(base, (int(rows[-1]) + 1, many)).copy()
        there = np.zeros(own.shape, bool)
        own[rows, source[begin:end]] = p[begin:end]
        there[rows, source[begin:end]] = True
        mine = (source[begin:end] >= first) & (source[begin:end] < last)
        # The block's source has the term.
        found = difference(p[begin:end][mine][:, None], own[rows[mine]])
        np.add.at(out, source[begin:end][mine] - first, found)
        np.add.at(both, source[begin:end][mine] - first, there[rows[mine]].astype(np.int64))
        # It does not, and the other one has.
        absent = np.where(there[rows][:, block], 0, difference(base[None, block], p[begin:end][:, None]))
        np.add.at(out.T, source[begin:end], absent)
        begin = end
    have = np.bincount(source, minlength=many)
    neither = n_terms - have[block, None] - have[None, :] + both
    return out + neither * difference(base[block, None], base[None, :])


def divergences(merged: DataFrame, langs: DataFrame, top: int) -> DataFrame:
    """lang, source, part, item, value: each bucket's share of the pairs' sums, and its best terms."""
    schema = "lang string, source string, part string, item string, value bigint"
    names = ["lang", "source", "part", "item", "value"]

    def run(stripes: pa.Table, sources: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(work(stripes, sources)), pa.schema([pa.field(n, pa.int64() if n == "value" else pa.string()) for n in names]))

    def rows(lang: str, part: str, source: pa.Array, item: pa.Array, value: np.ndarray) -> pa.RecordBatch:
        same = [pa.array([x] * len(value), pa.string()) for x in (lang, part)]
        return pa.RecordBatch.from_arrays([same[0], source, same[1], item, pa.array(value, pa.int64())], names=names)

    def work(stripes: pa.Table, facts: pa.Table) -> Iterator[pa.RecordBatch]:
        lang, kept, all_n = (facts.column(c)[0].as_py() for c in ("lang", "terms", "all_n"))
        groups = sorted(facts.column("groups")[0].as_py(), key=lambda g: g["source"].encode())
        labels = pa.array([g["source"] for g in groups], pa.string())
        whole = np.array([g["n"] for g in groups], np.int64) + kept
        base = share(0, whole) if kept else np.ones(len(groups), np.int64)
        stripes = stripes.combine_chunks()
        order = pa.compute.sort_indices(stripes.column("term").cast(pa.binary()))
        stripes = stripes.take(order)
        place = {g["source"]: i for i, g in enumerate(groups)}
        by = stripes.column("by").to_pylist()
        term = np.repeat(np.arange(len(by)), [len(x) for x in by])
        source = np.array([place[e["source"]] for x in by for e in x], np.int64)
        n = np.array([e["n"] for x in by for e in x], np.int64)
        p = share(n, whole[source]) if len(n) else n
        step = max(1, CELLS // max(len(groups), 1))
        for first in range(0, len(groups), step):
            last = min(first + step, len(groups))
            value = _sums(base, term, source, p, first, last)
            one, two = np.nonzero(np.arange(first, last)[:, None] != np.arange(len(groups))[None, :])
            yield rows(lang, "pair", labels.take(pa.array(one + first)), labels.take(pa.array(two)), value[one, two])
        if len(n):
            q = share(stripes.column("total").to_numpy(), all_n + kept)[term]
            more = np.flatnonzero(p > q)
            value = difference(p[more], q[more])
            # Terms are in the order of their bytes.
            order = np.lexsort((term[more], -value, source[more]))
            more, value = more[order], value[order]
            heads = np.flatnonzero(np.diff(source[more], prepend=-1))
            nth = np.arange(len(more)) - np.repeat(heads, np.diff(heads, append=len(more)))
            more, value = more[nth < top], value[nth < top]
            items = stripes.column("term").combine_chunks().take(pa.array(term[more]))
            yield rows(lang, "term", labels.take(pa.array(source[more])), items, value)

    buckets = langs.select("lang", "buckets")
    bucket = F.pmod(F.xxhash64("term"), F.col("buckets")).alias("bucket")
    left = salted_lookup(merged, buckets, ["lang"], ["term"], "inner").select("lang", bucket, "term", "total", "by")
    right = langs.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("buckets") - 1)))
    cogrouped = left.groupBy("lang", "bucket").cogroup(right.groupBy("lang", "bucket"))
    return cogrouped.applyInArrow(run, schema)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def _or_none(column: str) -> Column:
    return F.coalesce(column, F.lit(0).cast("bigint")).alias(column)


def audit(docs: DataFrame, least_docs: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank."""
    merged = settle(merge(fold(docs), least_docs), "stripes")
    groups = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    counted = merged.select("lang", F.inline("by")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = groups.join(counted, ["lang", "source"], "left").select("lang", "source", _or_none("n"))
    groups = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "n")).alias("groups"), F.sum("n").alias("all_n"))
    sizes = merged.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum(F.size("by").cast("bigint")).alias("counts"))
    langs = groups.join(sizes, "lang", "left").select("lang", "groups", "all_n", _or_none("terms"), _or_none("counts"))
    langs = settle(langs.withColumn("buckets", F.expr(f"counts div {BUCKET_COUNTS} + 1")), "langs")
    found = settle(divergences(merged, langs, top), "divergences")
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = _ranked(found.filter("part = 'term'")).filter(F.col("rank") <= top)
    return _ranked(pairs).unionByName(best).select("lang", "source", "part", "item", "value", "rank")
