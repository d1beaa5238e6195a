"""K-means in integers, vectors assigned through a vantage-point tree over the centroids.

Vectors of the wanted length with finite components become integers floor(1024 x). The first centroids
are the vectors with the smallest SHA-256 of a seed and their id. Each round builds a tree over the
centroids and broadcasts it (its size depends on k alone): a node holds a vantage point, and its other
centroids halved by distance from it, with the nearest and farthest distance of each half. A vector
looks at nodes in the order of their lower bounds, and stops when the least bound is above the best
distance; a bound equal to it is still looked at, so a tie goes to the smaller number. Bounds are
whole numbers, rounded to the safe side, and distances at vantage points and leaves are exact.

Tasks sum their vectors by centroid, Spark adds the tasks' sums in digits of 2^30, and the driver sees
k centroids. Vectors whose distances leave 64 bits are worked on in integers of any length; a distance
or inertia beyond 64 bits comes out as null.

Null vectors, other lengths, null or non-finite components: the row is left out. A null id comes last
among the candidates for a first centroid. Repeated rows count each, also as first centroids; equal centroids
leave the higher number empty, and an empty centroid stays where it is. Fewer rows than k give as many
centroids. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.vectors import matrix_of, usable
from feedkit.plans.settle import settle

GRID = 1024
#: Vectors that go through the tree together, and centroids of a leaf.
CHUNK, LEAF = 4096, 2
DIGIT = 30
OUT = (
    "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
    "centroid_sha256 string"
)
_TOP = np.iinfo(np.int64).max
_any_root = np.frompyfunc(math.isqrt, 1, 1)


def exact_limit(dim: int) -> int:
    """Components up to this size have squared distances of fewer than 62 bits."""
    return math.isqrt((1 << 60) // max(dim, 1)) - 1


def on_grid(vectors: np.ndarray) -> np.ndarray:
    """floor(GRID x) as 64-bit integers, or as Python's where they are too large."""
    scaled = np.floor(vectors * GRID)
    if not scaled.size or np.abs(scaled).max() <= exact_limit(scaled.shape[1]):
        return scaled.astype(np.int64)
    # From 2^53 on a double is a whole number, and its product may not be a double.
    out = np.array([int(x) * GRID if abs(x) >= 2.0**53 else math.floor(x * GRID) for x in vectors.ravel().tolist()], object)
    return out.reshape(vectors.shape)


def squares(rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = rows - centroid
    return (apart * apart).sum(axis=1)


def whole_roots(values: np.ndarray) -> np.ndarray:
    """Square roots rounded down, exactly."""
    if values.dtype == object:
        return _any_root(values)
    root = np.sqrt(values.astype(np.float64)).astype(np.int64)
    root -= root * root > values
    root += (root + 1) * (root + 1) <= values
    return root


@dataclass
class Node:
    """`point` and its centroids' halves, or a leaf of `members`."""

    members: list[int] = field(default_factory=list)
    point: int = -1
    #: Node number, and what its members' distances from the point are at least and at most.
    halves: list[tuple[int, int, int]] = field(default_factory=list)


@dataclass
class Tree:
    centroids: np.ndarray
    nodes: list[Node]

    @staticmethod
    def over(centroids: list[list[int]]) -> Tree:
        nodes: list[Node] = []

        def far(a: int, b: int) -> int:
            return sum((x - y) ** 2 for x, y in zip(centroids[a], centroids[b], strict=True))

        def build(members: list[int]) -> int:
            here = len(nodes)
            nodes.append(Node())
            if len(members) <= LEAF:
                nodes[here].members = members
                return here
            point = nodes[here].point = members[0]
            rest = sorted((far(point, m), m) for m in members[1:])
            middle = len(rest) // 2
            for half in (rest[:middle], rest[middle:]):
                low, high = math.isqrt(half[0][0]), math.isqrt(half[-1][0]) + 1
                nodes[here].halves.append((build([m for _, m in half]), low, high))
            return here

        if centroids:
            build(list(range(len(centroids))))
        small = all(abs(x) <= exact_limit(len(c)) for c in centroids for x in c)
        return Tree(np.array(centroids, np.int64 if small else object), nodes)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's nearest centroid (the smallest number of equals), and its squared distance."""
        parts = [self._nearest(rows[i : i + CHUNK]) for i in range(0, len(rows), CHUNK)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        exact = rows.dtype != object and self.centroids.dtype != object
        kind = np.int64 if exact else object
        rows = rows.astype(kind, copy=False)
        centroids = self.centroids.astype(kind, copy=False)
        n = len(rows)
        chosen = np.full(n, -1, np.int64)
        best = np.full(n, _TOP if exact else None, kind)
        bound = np.zeros((n, len(self.nodes)), kind)
        waiting = np.zeros((n, len(self.nodes)), bool)
        waiting[:, 0] = True
        beyond = _TOP if exact else 1 << 2200  # above every root of finite doubles

        def try_centroid(at: np.ndarray, c: int) -> np.ndarray:
            found = squares(rows[at], centroids[c])
            new = chosen[at] < 0
            old = np.where(new, found, best[at])
            closer = (new | (found < old) | ((found == old) & (c < chosen[at]))).astype(bool)
            best[at[closer]], chosen[at[closer]] = found[closer], c
            return found

        active = np.arange(n)
        while len(active):
            open_bounds = np.where(waiting[active], bound[active], beyond)
            node = open_bounds.argmin(axis=1)
            least = open_bounds[np.arange(len(active)), node]
            go = waiting[active, node]
            known = go & (chosen[active] >= 0)
            # The radius is inclusive: an equal distance may have a smaller number.
            go[known] = (least[known] * least[known] <= best[active[known]]).astype(bool)
            active, node, least = active[go], node[go], least[go]
            waiting[active, node] = False
            for v in np.unique(node):
                own, mine = self.nodes[v], active[node == v]
                if own.point < 0:
                    for c in own.members:
                        try_centroid(mine, c)
                    continue
                root = whole_roots(try_centroid(mine, own.point))
                for child, low, high in own.halves:
                    bound[mine, child] = np.maximum(np.maximum(root - high, low - 1 - root), least[node == v])
                    waiting[mine, child] = True
        return chosen, best


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of a batch and their vectors on the grid; the few large ones apart."""
    vectors = matrix_of(batch.column(1))
    with np.errstate(over="ignore"):
        large = (np.abs(vectors) * GRID > exact_limit(vectors.shape[1]) - 1).any(axis=1)
        for some in (~large, large):
            if some.any():
                yield np.flatnonzero(some), on_grid(vectors[some])


def _sums(rows: DataFrame, tree: Tree) -> dict[int, tuple[int, list[int]]]:
    """Each centroid's number of vectors and sum of vectors."""
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        totals = [[0] * (own.centroids.shape[1] + 1) for _ in own.centroids]  # the count comes first
        for batch in batches:
            if not batch.num_rows:
                continue
            for _, vectors in _parts(batch):
                chosen, _ = own.nearest(vectors)
                for c in np.unique(chosen).tolist():
                    some = vectors[chosen == c]
                    new = [len(some), *some.sum(axis=0).tolist()]
                    totals[c] = [a + b for a, b in zip(totals[c], new, strict=True)]
        out = []
        for c, own_totals in enumerate(totals):
            for at, value in enumerate(own_totals):
                sign, value, digit = (-1 if value < 0 else 1), abs(value), 0
                while value:
                    out.append((c, at, digit, sign * (value & ((1 << DIGIT) - 1))))
                    value, digit = value >> DIGIT, digit + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 4, [pa.int32()] * 3 + [pa.int64()], strict=True)],
            names=["c", "at", "digit", "value"],
        )

    parts = rows.mapInArrow(run, "c int, at int, digit int, value bigint")
    # A row for each centroid, component and digit, however many vectors there are.
    found = parts.groupBy("c", "at", "digit").agg(F.sum("value").alias("value")).collect()
    shared.unpersist()
    dim = tree.centroids.shape[1]
    sums = {c: [0] * (dim + 1) for c in range(len(tree.centroids))}
    for r in found:
        sums[r["c"]][r["at"]] += r["value"] << (DIGIT * r["digit"])
    return {c: (own[0], own[1:]) for c, own in sums.items()}


def _assigned(rows: DataFrame, tree: Tree) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cluster, distance = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, object)
            for at, vectors in _parts(batch):
                cluster[at], distance[at] = shared.value.nearest(vectors)
            fits = [int(d) if d <= _TOP else None for d in distance]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster), pa.array(fits, pa.int64())], names=["vec_id", "cluster", "distance"]
            )

    return rows.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def centroids_of(rows: DataFrame, k: int, rounds: int, seed: str) -> list[list[int]]:
    """The centroids after all rounds."""
    name = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(F.asc_nulls_last(name), "vec_id", "embedding").limit(k).collect()
    if not first:
        return []
    found = [on_grid(np.array([r["embedding"]], np.float64))[0].tolist() for r in first]
    for _ in range(rounds):
        sums = _sums(rows, Tree.over(found))
        found = [[x // n for x in total] if n else own for own, (n, total) in zip(found, sums.values(), strict=True)]
    return found


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, seed: str = "3:") -> DataFrame:
    """OUT rows, one for each vector that is kept."""
    spark = vectors.sparkSession
    kept = vectors.select(F.col("vec_id").cast("bigint"), "embedding")
    kept = settle(kept.filter(usable(F.col("embedding")) & (F.size("embedding") == dim)), "vectors")
    centroids = centroids_of(kept, k, rounds, seed)
    if not centroids:
        return spark.createDataFrame([], OUT)
    assigned = settle(_assigned(kept, Tree.over(centroids)), "assigned")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    whole = F.when(F.count("distance") == F.count(F.lit(1)), total)
    facts = {r["cluster"]: r["sum"] for r in assigned.groupBy("cluster").agg(whole.alias("sum")).collect()}

    def as_long(values: list) -> int | None:
        return int(sum(values)) if None not in values and sum(values) <= _TOP else None

    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia = as_long(list(facts.values()))
    table = [(c, as_long([facts[c]]), inertia, names[c]) for c in sorted(facts)]
    table = spark.createDataFrame(table, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # A row for each centroid.
    return assigned.join(F.broadcast(table), "cluster").select(*(c.split()[0] for c in OUT.split(", ")))
