"""Near-duplicate documents by MinHash with tensored banding.

A document is its set of word shingles; two are linked if their sets' Jaccard similarity reaches a
threshold. Two collections of `BANDS` small minhash collisions (`ROWS` minhashes each) are drawn;
every pair of one from each makes a table, so BANDS * BANDS tables of 2 * ROWS minhashes cost only
2 * BANDS * ROWS minhashes. At similarity 0.8 with 14 bands of 3, a pair misses all tables with
probability 9e-5, at 0.9 with 1e-8.

Documents with equal sets are one class and need no comparison. Most classes collide with nothing in
the first collection and go no further. The others are compared with two centres of their buckets first,
where a pair shares enough bands; then what a bucket still has outside its first component, with that
component and with each other, in blocks whose pairs never become rows. Every link is confirmed on full sets of 64-bit shingle hashes. Copies and buckets are counted before they
are shuffled, joins carry ids, and sets travel for candidate pairs alone.

Null and empty texts and texts without words have no shingles and link with nothing; a text of fewer
words than a shingle is one shingle; an empty table gives no rows; columns other than doc_id and
text are not read. Texts of any length are read whole. Repeated rows of one doc_id each get a row. Rows
without a doc_id are compared like all others, and name no component: theirs is null where no member has an
id, and they are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.components import components
from feedkit.llm.covertree import forest
from feedkit.llm.hashing import distinct_sets, mixed, shingle_hashes, word_hashes
from feedkit.llm.vectors import paired, regrouped
from feedkit.llm.wordids import slices
from feedkit.plans.settle import settle

BANDS, ROWS = 14, 3
#: Of the 2 * BANDS bands, a pair must share so many to be compared. At similarity 0.8 it shares 14 in
#: the mean, and fewer than 4 with probability 4e-6.
SHARED = 4
#: Shingles of the sets in a block, its most sets, and shingles that a matrix product takes at a time.
BLOCK_SHINGLES, BLOCK_ROWS, COLUMNS = 1 << 16, 1024, 1 << 12
_RANDOM = np.random.default_rng(77)
_FACTORS = _RANDOM.integers(1, 2**63, (2 * BANDS * ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
SIGNED = "doc_id bigint, n_shingles bigint, set_id bigint, left array<bigint>, right array<bigint>"


def _sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    words, counts = word_hashes(texts)
    return distinct_sets(*shingle_hashes(words, counts, width))


def _names(sets: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A number for each set that begins there and is not empty."""
    return mixed(np.add.reduceat(mixed(sets + np.uint64(1)), begins))


def _whole(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """SIGNED rows: set size, a number for the set, and the bands of both collections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for own in slices(texts):
                sets, sizes = _sets(texts[own], width)
                full = np.flatnonzero(sizes)
                begins = (np.cumsum(sizes) - sizes)[full]
                bands = np.zeros((2 * BANDS, len(sizes)), np.uint64)
                names = np.zeros(len(sizes), np.uint64)
                if len(full):
                    for i, factor in enumerate(_FACTORS):
                        least = np.minimum.reduceat((sets * factor) >> np.uint64(20), begins)
                        bands[i // ROWS, full] = mixed(bands[i // ROWS, full] * np.uint64(31) + least)
                    names[full] = _names(sets, begins)
                flat = bands.T.reshape(len(sizes), 2, BANDS).astype(np.int64, copy=False).view(np.int64)
                lists = [
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(0, (len(sizes) + 1) * BANDS, BANDS), pa.int32()),
                        pa.array(np.ascontiguousarray(flat[:, side]).reshape(-1), pa.int64()),
                    )
                    for side in (0, 1)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(own.start, own.stop - own.start),
                        pa.array(sizes, pa.int64()),
                        pa.array(names.view(np.int64), pa.int64()),
                        *lists,
                    ],
                    names=["doc_id", "n_shingles", "set_id", "left", "right"],
                )

    return _whole(docs).mapInArrow(run, SIGNED)


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """n_shingles, set_id and the full set of shingle hashes, of documents that have shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for own in slices(texts):
                sets, sizes = _sets(texts[own], width)
                sizes = sizes[sizes > 0]
                at = np.concatenate([[0], np.cumsum(sizes)])
                names = _names(sets, at[:-1]) if len(sizes) else np.zeros(0, np.uint64)
                lists = pa.ListArray.from_arrays(
                    pa.array(at, pa.int32()), pa.array(sets.view(np.int64), pa.int64())
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sizes, pa.int64()), pa.array(names.view(np.int64), pa.int64()), lists],
                    names=["n_shingles", "set_id", "shingles"],
                )

    sets = "n_shingles bigint, set_id bigint, shingles array<bigint>"
    return _whole(docs).select("text").mapInArrow(run, sets)


def _tables(classes: DataFrame) -> DataFrame:
    """`id`, `bucket` of classes that share a bucket with others, over all tables."""
    first = classes.select("id", "right", F.posexplode("left").alias("i", "_left"))
    first = first.withColumn("_left", F.xxhash64("i", "_left"))
    shared = first.groupBy("_left").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    first = first.join(shared, "_left")
    pairs = first.select("id", "_left", F.posexplode("right").alias("j", "_right"))
    return pairs.select("id", F.xxhash64("_left", "j", "_right").alias("bucket"))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    pairs = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("_b")), "b")
    pairs = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("_a")), "a")
    shared = F.size(F.array_intersect("_a", "_b"))
    union = F.size("_a") + F.size("_b") - shared
    return pairs.filter(100 * shared >= percent * union).select("a", "b")


def _alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) whose set sizes allow the similarity and that share SHARED bands."""
    facts = classes.select("id", F.col("n_shingles").alias("n"), F.concat("left", "right").alias("bands"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = pairs.join(facts.toDF("a", "_na", "_a"), "a").join(facts.toDF("b", "_nb", "_b"), "b")
    small, large = F.least("_na", "_nb"), F.greatest("_na", "_nb")
    pairs = pairs.filter(100 * small >= percent * large)
    return pairs.filter(F.size(F.array_intersect("_a", "_b")) >= SHARED).select("a", "b")


BLOCKS = "main bigint, stray bigint, ids binary, sizes binary, shingles binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (main, stray, part, id, shingles), sorted by main, stray and part, to BLOCKS rows."""

    def most(table: pa.Table) -> int:
        sizes = np.cumsum(pc.list_value_length(table.column(4)).to_numpy())
        return max(1, min(BLOCK_ROWS, int(np.searchsorted(sizes, BLOCK_SHINGLES, "right"))))

    for table in regrouped(batches, 3, most):
        sets = table.column(4).combine_chunks()
        columns = (
            table.column(3).to_numpy().astype("<i8"),
            pc.list_value_length(sets).to_numpy(zero_copy_only=False).astype("<i8"),
            sets.flatten().to_numpy().astype("<i8"),
        )
        yield pa.RecordBatch.from_arrays(
            [*[table.column(k).slice(0, 1).combine_chunks() for k in (0, 1)], *[pa.array([c.tobytes()], pa.binary()) for c in columns]],
            names=[c.split()[0] for c in BLOCKS.split(", ")],
        )


def similar_pairs(
    one: list[np.ndarray], two: list[np.ndarray] | None, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs whose sets reach the similarity; without `two`, pairs inside `one`."""
    every = one + (two or [])
    sizes = np.array([len(x) for x in every], np.int64)
    row = np.repeat(np.arange(len(every)), sizes)
    _, place, times = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    some = times[place] > 1  # what one set alone holds is in no intersection
    _, place = np.unique(place[some], return_inverse=True)
    row, wide = row[some], int(place.max(initial=-1)) + 1
    shared = np.zeros((len(one), len(two) if two else len(one)), np.int64)
    for begin in range(0, wide, COLUMNS):
        own = (place >= begin) & (place < begin + COLUMNS)
        cells = np.zeros((len(every), min(wide - begin, COLUMNS)), np.float32)
        cells[row[own], place[own] - begin] = 1
        # A product of so few columns is exact in single precision; the sum and the threshold are whole numbers.
        shared += (cells[: len(one)] @ cells[len(one) if two else 0 :].T).astype(np.int64)
    total = sizes[: len(one), None] + sizes[None, len(one) if two else 0 :]
    hit = (100 * shared >= percent * (total - shared)) & (shared > 0)
    return np.nonzero(hit if two else np.triu(hit, 1))


def _compare(percent: int):
    def sets_of(block: dict) -> tuple[np.ndarray, list[np.ndarray]]:
        ids, sizes, flat = (np.frombuffer(block[c], "<i8") for c in ("ids", "sizes", "shingles"))
        return ids, np.split(flat, np.cumsum(sizes)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                same = batch.column(0)[k].as_py() == batch.column(1)[k].as_py()
                ids, sets = sets_of(batch.column(2)[k].as_py())
                ids2, sets2 = (ids, None) if same else sets_of(batch.column(3)[k].as_py())
                a, b = similar_pairs(sets, sets2, percent)
                names, shift = (ids, 0) if same else (np.concatenate([ids, ids2]), len(ids))
                point, root = forest(a, b + shift, len(names))
                yield pa.RecordBatch.from_arrays([pa.array(names[root]), pa.array(names[point])], names=["a", "b"])

    return run


def block_pairs(blocks: DataFrame) -> DataFrame:
    """Pairs (a, b) of blocks (main, stray, block) of one component of which one at least holds strays."""
    one = blocks.filter("stray = 1").select("main", F.col("block").alias("a"))
    two = blocks.select("main", F.col("block").alias("b"), "stray")
    return one.join(two, "main").filter("stray = 0 or a <= b").select("a", "b")


def _stray_links(strays: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of strays (main, id) with their component and with each other.

    A component and its strays are cut into blocks, the strays into blocks of their own; a block of strays
    is compared with every other one by products of their indicator matrices, and only a forest of what is
    found becomes rows. Members of the component are linked already, so its own blocks never meet.
    """
    mains = strays.select("main").distinct()
    own = labels.select(F.col("component").alias("main"), F.col("node").alias("id")).join(mains, "main")
    own = own.union(mains.select("main", F.col("main").alias("id"))).distinct()
    group = strays.withColumn("stray", F.lit(1).cast("bigint"))
    group = group.unionByName(own.withColumn("stray", F.lit(0).cast("bigint")))
    sizes = sets.select("id", F.size("shingles").alias("n"))
    parts = group.join(sizes, "id").groupBy("main", "stray").agg(F.sum("n").alias("n"))
    parts = parts.select("main", "stray", F.ceil(F.col("n") / BLOCK_SHINGLES).cast("bigint").alias("_parts"))
    group = group.join(sets, "id").join(parts, ["main", "stray"])
    group = group.withColumn("part", F.pmod(F.xxhash64("id"), F.col("_parts")))
    key = ["main", "stray", "part"]
    group = group.repartition(*key).sortWithinPartitions(*key, "id")
    blocks = group.select(*key, "id", "shingles").mapInArrow(_pack, BLOCKS)
    blocks = settle(blocks.withColumn("block", F.xxhash64("main", "ids")), "blocks")
    todo = block_pairs(blocks.select("main", "stray", "block"))
    held = blocks.select("block", "ids", "sizes", "shingles")
    return paired(todo, held, held).mapInArrow(_compare(percent), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    signed = settle(signatures(docs, width), "signatures")
    classes = signed.filter("n_shingles > 0").groupBy("n_shingles", "set_id")
    classes = classes.agg(
        F.min("doc_id").alias("doc_id"), F.first("left").alias("left"), F.first("right").alias("right")
    )
    # Named by their sets, for rows may share an id or have none.
    name = F.xxhash64("n_shingles", "set_id").alias("id")
    classes = settle(classes.select(name, "*"), "classes")
    members = settle(_tables(classes), "members")

    # Stars: a bucket's centre is its smallest id, and a class is compared with the smallest and the
    # largest of its centres. This only saves work, for what stays apart is looked at below.
    centres = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"), F.min("id").alias("centre"))
    near = members.join(centres.filter("_n > 1").drop("_n"), "bucket").groupBy("id")
    near = settle(near.agg(F.min("centre").alias("first"), F.max("centre").alias("last")), "near")
    stars = near.select(F.explode(F.array_distinct(F.array("first", "last"))).alias("a"), F.col("id").alias("b"))
    stars = stars.filter("a <> b")
    near_ids = near.select("id")
    wanted = classes.join(near_ids, "id", "left_semi").select(F.col("doc_id").alias("_wanted")).distinct()
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = own.join(wanted, F.col("doc_id").eqNullSafe(F.col("_wanted")), "left_semi")
    # Rows of one doc_id may differ, and their classes do not all need their sets.
    sets = shingle_sets(found, width).select(name, "shingles").join(near_ids, "id", "left_semi")
    sets = settle(sets.dropDuplicates(["id"]), "sets")
    tried = settle(_alike(stars, classes, percent), "tried")
    links = settle(_confirm(tried, sets, percent), "links")
    labels = settle(components(links), "labels")

    # What a bucket still has outside its first component is a stray of that component.
    named = members.join(labels.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("bucket", "id", F.coalesce("component", "id").alias("component"))
    first = named.groupBy("bucket").agg(F.min("component").alias("main"), F.max("component").alias("_last"))
    strays = named.join(first.filter("main <> _last").drop("_last"), "bucket").filter("component <> main")
    strays = settle(strays.select("main", "id").distinct(), "strays")
    more = settle(_stray_links(strays, labels, sets, percent), "more")
    if not more.isEmpty():
        labels = settle(components(links.union(more)), "labels")

    # The smallest doc_id of each component; rows without an id have no say.
    linked = classes.select(F.col("id").alias("node"), "doc_id").join(labels, "node")
    least = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = labels.join(settle(least, "least"), "component").select(F.col("node").alias("id"), "component_id")
    ids = classes.join(linked, "id", "left")
    ids = ids.select("n_shingles", "set_id", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", "set_id").join(ids, ["n_shingles", "set_id"], "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )
