"""A quality classifier: support vectors over Naive Bayes features.

A text's features are indicators of its n-grams: all byte pairs, all runs of four bytes (hashed to
2**18 places), and what the sequence of words does: words that repeat their predecessor, runs of
three, and how large a part of the words that is, by powers of two. Each indicator is scaled by the
logarithm of the ratio of its smoothed class counts, every text is scaled to length 1, and a linear
hinge-loss model is fitted by dual coordinate descent. A logistic curve that is fitted on a fifth of
the sample, left out of a first fit, turns margins into scores.

The model is fitted to a sample of labelled rows, at most `SAMPLE_ROWS` by the hash of their id; it
has a fixed size. Scoring reads every whole text in one pass without an exchange.

Null texts count as empty; empty texts have no features and get the score of the bias alone; without
labelled rows of both classes all scores are 0.5. Rows without a label or an id, and further labels of
an id, are not learned from. Labels, language, source and id are no features. Repeated rows are
scored each for itself, an empty table gives no rows, and columns other than doc_id and text are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the model is fitted to, and rounds of descent over them.
SAMPLE_ROWS, ROUNDS = 12_000, 15
#: Rows whose features are counted at a time.
COUNTED = 256
PAIRS, QUADS = 1 << 16, 1 << 18
PATTERNS = PAIRS + QUADS
SIZE = PATTERNS + 64
COST = 1.0
THRESHOLD = 0.3


class Features:
    """Distinct feature numbers of texts; one array of marks serves all texts."""

    def __init__(self) -> None:
        self.marks = np.zeros(SIZE, bool)

    def of(self, text: bytes) -> np.ndarray:
        """Sorted feature numbers of a text."""
        if not text:
            return np.zeros(0, np.int32)
        marks = self.marks
        cells = np.frombuffer(b" %s " % text, np.uint8)
        pairs = cells[:-1].astype(np.uint16)
        pairs <<= 8
        pairs |= cells[1:]
        marks[pairs] = True
        if len(cells) >= 4:
            quads = pairs[:-2].astype(np.uint32)
            quads <<= 16
            quads |= pairs[2:]
            quads *= np.uint32(2654435761)
            quads >>= np.uint32(14)
            marks[PAIRS + quads.astype(np.int64)] = True
        words = text.split()
        if words:
            again = [a == b for a, b in zip(words, words[1:])]
            some = sum(again)
            thrice = any(a and b for a, b in zip(again, again[1:]))
            marks[PATTERNS + min(some.bit_length(), 15)] = True
            marks[PATTERNS + 16 + (len(words) // some if some else 0).bit_length() % 16] = True
            marks[PATTERNS + 32 + thrice] = True
            marks[PATTERNS + 40 + (8 * len(set(words)) // len(words))] = True
        found = np.flatnonzero(marks).astype(np.int32)
        marks[found] = False
        return found


@dataclass
class Model:
    """`weights` holds the fitted weight times the feature's ratio."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        if not len(found):
            return self.bias
        own = self.ratios[found]
        length = float(np.sqrt(own @ own))
        return self.bias + (float(self.weights[found].sum()) / length if length else 0.0)

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.shift, -500, 500))))


def log_count_ratios(rows: Sequence[np.ndarray], good: np.ndarray) -> np.ndarray:
    """log((p / |p|) / (q / |q|)) of the classes' smoothed indicator counts."""
    logs = []
    for side in (True, False):
        own = [x for x, g in zip(rows, good, strict=True) if g == side]
        counts = np.ones(SIZE)
        for i in range(0, len(own), COUNTED):
            counts += np.bincount(np.concatenate(own[i : i + COUNTED]), minlength=SIZE)
        logs.append(np.log(counts / (len(own) + 2.0)))
    return (logs[0] - logs[1]).astype(np.float32)


def descend(rows: Sequence[np.ndarray], signs: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Hinge loss with L2 regularisation by dual coordinate descent; the bias is one more feature."""
    weights, bias = np.zeros(SIZE), 0.0
    wide = ratios.astype(np.float64)
    lengths = np.array([np.sqrt(own @ own) or 1.0 for own in (wide[found] for found in rows)])

    def values(i: int) -> tuple[np.ndarray, np.ndarray]:
        # Made again in each round: kept, they would take four times what the rows do.
        found = rows[i].astype(np.intp)
        own = wide[found]
        own /= lengths[i]
        return found, own

    norms = np.array([1 + v @ v for _, v in map(values, range(len(rows)))])
    dual = np.zeros(len(rows))
    order = np.random.default_rng(1)
    for _ in range(ROUNDS):
        moved = 0.0
        for i in order.permutation(len(rows)):
            (found, own), sign = values(i), signs[i]
            slope = sign * (weights[found] @ own + bias) - 1
            now = min(max(dual[i] - slope / norms[i], 0.0), COST)
            step = (now - dual[i]) * sign
            if step:
                weights[found] += step * own
                bias += step
                dual[i] = now
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def _logistic(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (margin, class), by Newton steps."""
    target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    design = np.stack([margins, np.ones(len(margins))], axis=1)
    at = np.array([2.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        at = at - np.linalg.solve(hessian, design.T @ (p - target) + 1e-3 * (at - [2.0, 0.0]))
    return float(max(at[0], 1e-3)), float(at[1])


def fit(rows: Sequence[np.ndarray], good: np.ndarray) -> Model:
    """The model of feature numbers and classes (true: good)."""
    signs = np.where(good, 1.0, -1.0)
    none = np.zeros(SIZE, np.float32)
    if not len(rows) or good.all() or not good.any():
        return Model(none, none, 0.0, 1.0, 0.0)

    def fitted(some: np.ndarray) -> Model:
        own = [rows[i] for i in some]
        ratios = log_count_ratios(own, good[some])
        weights, bias = descend(own, signs[some], ratios)
        return Model(ratios, (weights * ratios).astype(np.float32), bias, 1.0, 0.0)

    out = np.arange(len(rows)) % 5 == 0
    kept = np.flatnonzero(~out)
    slope, shift = 2.0, 0.0
    if good[kept].any() and not good[kept].all() and len(np.unique(good[out])) == 2:
        first = fitted(kept)
        slope, shift = _logistic(np.array([first.margin(rows[i]) for i in np.flatnonzero(out)]), good[out])
    model = fitted(np.arange(len(rows)))
    model.slope, model.shift = slope, shift
    return model


def held_out(key: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, learn_from: Column) -> Model:
    """Fit to a bounded sample of `labels` (doc_id, quality) that `learn_from` admits."""
    some = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & learn_from)
    some = some.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Features()
        for batch in batches:
            found = [made.of(t) for t in batch.column(2).to_pylist()]
            at = np.concatenate([[0], np.cumsum([len(x) for x in found])])
            flat = np.concatenate([*found, np.zeros(0, np.int32)])
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists], names=["doc_id", "quality", "found"]
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, keys, good = [], [], []
        for batch in batches:
            keys += batch.column(0).to_pylist()
            good += batch.column(1).to_pylist()
            rows += [x.values.to_numpy() for x in batch.column(2)]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        order = np.random.default_rng(2).permutation(order) if order else []
        model = fit([rows[i] for i in order], np.array([good[i] > 0 for i in order], bool))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([model.ratios.tobytes()], pa.binary()),
                pa.array([model.weights.tobytes()], pa.binary()),
                *[pa.array([x], pa.float64()) for x in (model.bias, model.slope, model.shift)],
            ],
            names=["ratios", "weights", "bias", "slope", "shift"],
        )

    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    # SAMPLE_ROWS rows of two numbers at most.
    rows = docs.select("doc_id", text).join(F.broadcast(some), "doc_id").select(
        F.col("doc_id").cast("bigint"), F.col("quality").cast("int"), "text"
    )
    rows = rows.mapInArrow(features, "doc_id bigint, quality int, found array<int>")
    model = rows.repartition(1).mapInArrow(
        learn, "ratios binary, weights binary, bias double, slope double, shift double"
    )
    row = model.first()
    if row is None:
        return fit([], np.zeros(0, bool))
    return Model(
        np.frombuffer(row["ratios"], np.float32), np.frombuffer(row["weights"], np.float32), row["bias"], row["slope"], row["shift"]
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Features()
        for batch in batches:
            scores = [model.score(made.of(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    return docs.select(F.col("doc_id").cast("bigint"), text).mapInArrow(run, "doc_id bigint, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, with all columns, whose score reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Features()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            good = [model.score(made.of((t.as_py() or "").encode())) >= threshold for t in texts]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
