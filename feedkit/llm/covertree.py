"""Near-duplicate vectors by a dual traversal of cover trees.

Two vectors are linked if their cosine reaches a threshold, that is, if their directions lie within
a Euclidean distance `reach`. Equal vectors are one class with a count. A tree has nested levels:
the centres of a level are at least its radius apart, every class lies within the radius of its
centre, and radii halve from level to level; each node knows its covering radius, the distance to
the farthest class below it.

The top levels are fitted to a bounded sample (`SAMPLE` classes) and all classes take their place
below the nearest of these centres, with covering radii over all of them. Pairs of such nodes whose
centres are farther apart than both radii and `reach` are dropped; the rest is worked on in blocks.
Every block is packed with the lower levels of its own, and two blocks are traversed together, level by level:
node pairs beyond reach are dropped by the bound, and the points that remain are compared in double
precision.

A block pair gives each class its number of links, and a spanning forest of the links, so that a
group of thousands costs a row for each member and not for each pair.

Vectors that are null, zero or hold null or non-finite components link with nothing, and so do
vectors of different lengths; repeated rows are vectors of their own; an empty table gives no rows;
labels and other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.components import components
from feedkit.llm.vectors import matrix_of, paired, regrouped, rows_a_block, usable
from feedkit.plans.settle import settle

#: Classes that the top levels are fitted to, and radii from the top down.
SAMPLE = 2048
RADII = (1.0, 0.5, 0.25, 0.125)
#: Covering radius above which a node is compared apart from the others.
WIDE = 0.05
#: What rounding may add to a distance that was computed from single-precision products.
SLACK = 1e-3
#: Node pairs that are compared at a time.
PAIRS_AT_ONCE = 1 << 19


def directions(cells: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, safely for very large and very small components."""
    cells = cells / np.abs(cells).max(axis=1, keepdims=True)
    return cells / np.sqrt((cells * cells).sum(axis=1, keepdims=True))


def net(points: np.ndarray, radius: float, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres at least `radius` apart that cover all points, and each point's centre.

    `first` are indices of points that are centres already; they stay (levels are nested).
    """
    n = len(points)
    close = (points.astype(np.float32) @ points.astype(np.float32).T) > 1 - radius * radius / 2
    owner = np.full(n, -1)
    centres = []
    owner[first] = first
    for i in [*first.tolist(), *range(n)]:
        if owner[i] < 0 or len(centres) < len(first):
            centres.append(i)
            owner[close[i] & (owner < 0)] = i
            owner[i] = i
    return np.array(centres), owner


class Tree:
    """Levels of a cover tree over the rows of `points`; the last level is the points themselves."""

    def __init__(self, points: np.ndarray, levels: list | None = None) -> None:
        self.points = points
        self.single = points.astype(np.float32)
        if levels is not None:
            self.levels = levels
            return
        #: Per level: centres (indices), covering radii, and for each centre its children's places
        #: in the next level, as a list in one array with offsets.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        n = len(points)
        above = np.zeros(1, np.int64)
        owners = [np.zeros(n, np.int64)]
        tops = [above]
        for radius in RADII:
            above, owner = net(points, radius, above)
            tops.append(above)
            owners.append(owner)
            if len(above) == n:
                break
        if len(tops[-1]) < n:
            tops.append(np.arange(n))
            owners.append(np.arange(n))
        # A point's way up: its node on each level is that of the node it hangs on below.
        chain = [np.arange(n)]
        for level in range(len(tops) - 2, -1, -1):
            chain.append(owners[level][chain[-1]])
        chain.reverse()
        for level, centres in enumerate(tops):
            own = chain[level]
            gap = np.sqrt(((points - points[own]) ** 2).sum(axis=1))
            cover = np.zeros(n)
            np.maximum.at(cover, own, gap)
            if level + 1 < len(tops):
                below = tops[level + 1]
                up = owners[level][below]
                order = np.argsort(up, kind="stable")
                starts = np.searchsorted(up[order], centres)
                counts = np.searchsorted(up[order], centres, "right") - starts
            else:
                order, starts, counts = (np.zeros(0, np.int64),) * 3
            self.levels.append((centres, cover[centres], order, np.stack([starts, counts]) if len(starts) else np.zeros((2, 0), np.int64)))


def _children(tree: Tree, level: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many children each node has, and where its list starts (itself on the last level)."""
    if level >= len(tree.levels) - 1:
        return np.ones(len(places), np.int64), places
    starts, counts = tree.levels[level][3]
    return counts[places], starts[places]


def _within(dots: np.ndarray, left: np.ndarray, right: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of products whose distance is within both covering radii and `reach`.

    Most nodes cover little: one look at the matrix by the largest of their bounds is enough for them,
    and rows and columns of the few wide ones are looked at apart.
    """
    wide_left, wide_right = left > WIDE, right > WIDE
    limit = 2 * WIDE + reach
    x, y = np.divmod(np.flatnonzero(dots >= np.float32(1 - limit * limit / 2 - SLACK)), dots.shape[1])
    narrow = ~wide_left[x] & ~wide_right[y]
    places = [(x[narrow], y[narrow])]
    rows, columns = np.flatnonzero(wide_left), np.flatnonzero(wide_right)
    places.append(tuple(g.ravel() for g in np.meshgrid(rows, np.arange(dots.shape[1]), indexing="ij")))
    places.append(tuple(g.ravel() for g in np.meshgrid(np.flatnonzero(~wide_left), columns, indexing="ij")))
    x, y = (np.concatenate(c) for c in zip(*places, strict=True))
    limits = left[x] + right[y] + reach
    near = dots[x, y] >= 1 - limits * limits / 2 - SLACK
    return x[near], y[near]


def linked(one: Tree, two: Tree, cosine: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Arrays of linked pairs (places of points in both trees); with `same`, each pair once.

    With `same`, a node is paired with itself and each pair of its children is taken once; below two
    different nodes all pairs are different.
    """
    reach = np.sqrt(max(2 - 2 * cosine, 0.0))
    stack = [(0, 0, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        a_level, b_level, a, b = stack.pop()
        if len(a) > PAIRS_AT_ONCE:
            half = len(a) // 2
            stack += [(a_level, b_level, a[half:], b[half:]), (a_level, b_level, a[:half], b[:half])]
            continue
        (a_at, a_cover, a_order, _), (b_at, b_cover, b_order, _) = one.levels[a_level], two.levels[b_level]
        leaf = a_level == len(one.levels) - 1 and b_level == len(two.levels) - 1
        left, right = a_at[a], b_at[b]
        if leaf:
            dots = (one.points[left] * two.points[right]).sum(axis=1)
            hit = dots >= cosine
            if same:
                hit &= left != right
            if hit.any():
                yield left[hit], right[hit]
            continue
        gaps = np.sqrt(((one.points[left] - two.points[right]) ** 2).sum(axis=1))
        alive = gaps <= a_cover[a] + b_cover[b] + reach + SLACK
        a, b = a[alive], b[alive]
        a_many, a_from = _children(one, a_level, a)
        b_many, b_from = _children(two, b_level, b)
        a_next, b_next = min(a_level + 1, len(one.levels) - 1), min(b_level + 1, len(two.levels) - 1)
        # Wide nodes first: their children are compared as matrices.
        wide = a_many * b_many > 4096
        for i in np.flatnonzero(wide):
            mine = a_order[a_from[i] : a_from[i] + a_many[i]] if a_next > a_level else a[i : i + 1]
            yours = b_order[b_from[i] : b_from[i] + b_many[i]] if b_next > b_level else b[i : i + 1]
            p, q = one.levels[a_next], two.levels[b_next]
            dots = one.single[p[0][mine]] @ two.single[q[0][yours]].T
            x, y = _within(dots, p[1][mine], q[1][yours], reach + SLACK)
            if same and a[i] == b[i]:
                x, y = x[x <= y], y[x <= y]
            if len(x):
                stack.append((a_next, b_next, mine[x], yours[y]))
        a, b = a[~wide], b[~wide]
        a_many, a_from, b_many, b_from = a_many[~wide], a_from[~wide], b_many[~wide], b_from[~wide]
        each = a_many * b_many
        if not each.sum():
            continue
        pair = np.repeat(np.arange(len(a)), each)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
        x, y = a_from[pair] + nth // b_many[pair], b_from[pair] + nth % b_many[pair]
        x = a_order[x] if a_next > a_level else x
        y = b_order[y] if b_next > b_level else y
        if same:
            keep = (a[pair] != b[pair]) | (nth // b_many[pair] <= nth % b_many[pair])
            x, y = x[keep], y[keep]
        stack.append((a_next, b_next, x, y))


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star for each component of the links among n points: (point, smallest point)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        if (root == before).all():
            break
    moved = np.flatnonzero(root != np.arange(n))
    return moved, root[moved]


BLOCKS = "dim int, node int, ids binary, counts binary, cells binary, levels binary"
LINKS = "a bigint, b bigint, n_links bigint"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in regrouped(batches, 2, lambda t: rows_a_block(t.column(0)[0].as_py(), 4)):
        cells = matrix_of(table.column(4).combine_chunks())
        single = cells.astype("<f4")
        levels = pickle.dumps(Tree(directions(cells)).levels)
        yield pa.RecordBatch.from_arrays(
            [
                table.column(0).slice(0, 1).combine_chunks(),
                table.column(1).slice(0, 1).combine_chunks(),
                pa.array([table.column(2).to_numpy().astype("<i8").tobytes()], pa.binary()),
                pa.array([table.column(3).to_numpy().astype("<i8").tobytes()], pa.binary()),
                # Half the bytes where single precision holds every number.
                pa.array([(single if (single == cells).all() else cells.astype("<f8")).tobytes()], pa.binary()),
                pa.array([levels], pa.binary()),
            ],
            names=["dim", "node", "ids", "counts", "cells", "levels"],
        )


def _traverse(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[int, tuple] = {}

        def tree(number: int, block) -> tuple:
            """A block's tree, which came with it; the latest few stay."""
            if number not in trees:
                if len(trees) > 16:
                    trees.clear()
                block = block.as_py()
                ids, counts = np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["counts"], "<i8")
                kind = f"<f{len(block['cells']) // (len(ids) * block['dim'])}"
                cells = np.frombuffer(block["cells"], kind).astype(float).reshape(len(ids), -1)
                trees[number] = ids, counts, Tree(directions(cells), pickle.loads(block["levels"]))
            return trees[number]

        for batch in batches:
            for i in range(batch.num_rows):
                first, second = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                ids, counts, one = tree(first, batch.column(2)[i])
                same = first == second
                ids2, counts2, two = tree(second, batch.column(3)[i])
                n = len(ids)
                shift = 0 if same else n
                names = ids if same else np.concatenate([ids, ids2])
                links = np.zeros(len(names), np.int64)
                edges = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
                for a, b in linked(one, two, cosine, same):
                    np.add.at(links, a, counts2[b])
                    np.add.at(links, b + shift, counts[a])
                    # Links of one step shrink to a forest at once.
                    edges.append(forest(a, b + shift, len(names)))
                point, root = forest(*map(np.concatenate, zip(*edges, strict=True)), len(names))
                to = names.copy()
                to[point] = names[root]
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[some]), pa.array(to[some]), pa.array(links[some])],
                    names=["a", "b", "n_links"],
                )

    return run


def _nearest(centres: dict[int, np.ndarray]):
    """Add to rows (dim, id, n, cells) the nearest centre and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(0).to_numpy()
            node, gap = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for dim in np.unique(dims).tolist():
                own = dims == dim
                points = directions(matrix_of(batch.column(3).filter(pa.array(own))))
                if dim in centres and len(centres[dim]) > 1:
                    node[own] = (points @ centres[dim].T).argmax(axis=1)
                    gap[own] = np.sqrt(((points - centres[dim][node[own]]) ** 2).sum(axis=1))
                else:
                    gap[own] = 2.0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(node), *batch.columns[1:], pa.array(gap)],
                names=["dim", "node", "id", "n", "cells", "gap"],
            )

    return run


def _top_centres(sample: list, classes: int) -> dict[int, np.ndarray]:
    """Per vector length the finest level of the sample's net that leaves nodes a block or larger."""
    by_dim: dict[int, list] = {}
    for row in sample:
        by_dim.setdefault(len(row), []).append(row)
    out = {}
    for dim, rows in by_dim.items():
        points = directions(np.array(rows, float))
        most = max(1, classes // rows_a_block(dim, 4))
        chosen = above = np.zeros(1, np.int64)
        for radius in RADII:
            above, _ = net(points, radius, above)
            if len(above) > most:
                break
            chosen = above
        out[dim] = points[chosen]
    return out


def near_vectors(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """Per vector: vec_id, n_links, component_id (smallest vec_id reachable by links), kept."""
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    )
    # Equal numbers have equal bits: 0.0 and -0.0 are one.
    fit = usable(F.col("v")) & F.exists("v", lambda x: x != 0) & F.col("vec_id").isNotNull()
    rows = rows.withColumn("v", F.when(fit, F.transform("v", lambda x: x + F.lit(0.0))))
    classes = rows.filter("v is not null").groupBy("v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"))
    classes = settle(classes.select(F.size("v").alias("dim"), "id", "n", F.col("v").alias("cells")), "vectors")

    count = classes.count()
    sample = classes.orderBy(F.xxhash64("id"), "id").select("cells").limit(SAMPLE)
    centres = _top_centres([r[0] for r in sample.collect()], count)
    placed = classes.mapInArrow(_nearest(centres), "dim int, node int, id bigint, n bigint, cells array<double>, gap double")
    placed = settle(placed, "placed")
    nodes = placed.groupBy("dim", "node").agg(F.max("gap").alias("cover"), F.count(F.lit(1)).alias("n")).collect()

    # A row for each node of the top levels, SAMPLE at most, and for their pairs.
    reach, pairs = np.sqrt(max(2 - 2 * cosine, 0.0)), []
    nodes.sort(key=lambda r: (r["dim"], r["node"]))
    for i, x in enumerate(nodes):
        for y in nodes[i:]:
            if x["dim"] != y["dim"]:
                break
            if len(centres.get(x["dim"], ())) > 1:
                p, q = centres[x["dim"]][x["node"]], centres[y["dim"]][y["node"]]
                if np.sqrt(((p - q) ** 2).sum()) > x["cover"] + y["cover"] + reach + SLACK:
                    continue
            pairs.append((x["dim"], x["node"], y["node"]))
    many = {(r["dim"], r["node"]): -(-r["n"] // rows_a_block(r["dim"], 4)) for r in nodes}
    parts = spark.createDataFrame([(*k, n) for k, n in many.items()], "dim int, node int, _parts bigint")
    # A node larger than a block is dealt by the hash of the id.
    dealt = placed.drop("gap").join(F.broadcast(parts), ["dim", "node"])
    dealt = dealt.withColumn("_part", F.pmod(F.xxhash64("id"), F.col("_parts")))
    dealt = dealt.repartition("dim", "node", "_part").sortWithinPartitions("dim", "node", "_part", "id")
    blocks = dealt.select("dim", "node", "id", "n", "cells").mapInArrow(_pack, BLOCKS)
    blocks = settle(blocks.withColumn("block", F.xxhash64("dim", "node", "ids")), "blocks")
    near = spark.createDataFrame(pairs, "dim int, x int, y int")
    names = blocks.select("dim", "node", "block")
    todo = near.join(names.toDF("dim", "x", "a"), ["dim", "x"]).join(names.toDF("dim", "y", "b"), ["dim", "y"])
    todo = todo.filter("x <> y or a <= b").select("a", "b")
    held = blocks.select("block", "dim", "ids", "counts", "cells", "levels")
    found = settle(paired(todo, held, held).mapInArrow(_traverse(cosine), LINKS), "found")

    labels = components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("id")).agg(F.sum("n_links").alias("_links"))
    named = classes.select("id", "n", F.col("cells").alias("v")).join(links, "id", "left")
    named = named.join(labels.withColumnRenamed("node", "id"), "id", "left")
    named = named.select(
        "v",
        (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("_component"),
    )
    out = rows.join(named, "v", "left")
    component = F.coalesce("_component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
