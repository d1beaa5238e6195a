"""Removal of byte strings that occur elsewhere, by suffix arrays over places that may repeat.

A byte goes if it lies in a string of `LENGTH` bytes that also starts somewhere else in the corpus,
in the same document or in another one. Strings are judged on the input.

1. Anchors. Among the `K`-byte strings inside any window of LENGTH bytes, the one with the smallest
   hash is the window's anchor (ties: the first). Equal windows have equal anchors at equal offsets,
   so only anchors whose K bytes occur twice can lie in a repeated window. All bytes are looked at.
2. Contexts. For these anchors, the text from LENGTH - K bytes before to LENGTH behind holds every
   window they can serve. Equal contexts are counted, and one owner sends the text of each.
3. Suffix arrays. Contexts with the same K bytes come together. The texts behind the anchors, in
   blocks of `BLOCK` bytes that are numbered by their order, make a string whose suffix array (linear
   grouping, see `suffixes`) orders them. For every offset d, the contexts that agree in the d bytes
   before the anchor are taken in that order; a window is repeated if it equals that of a neighbour.
4. Documents take the windows' verdicts back, join them to spans and drop these bytes.

Anchors with more than `MOST_CONTEXTS` different contexts are not gathered: each of their windows
is counted for itself under a 128-bit hash, after partial sums in the map tasks.

Null and empty texts have no bytes and lose none; repeated rows are documents of their own, so they
lose all they share; documents under LENGTH bytes lose nothing; an empty table gives no rows; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.hashing import mixed
from feedkit.llm.suffixes import suffix_array
from feedkit.llm.wordids import slices
from feedkit.plans.settle import settle

LENGTH, K, BLOCK = 200, 72, 64
BEFORE = LENGTH - K
#: Different contexts of one anchor that a task compares; and contexts that it compares at a time.
MOST_CONTEXTS, BATCH = 50_000, 20_000
#: Bytes that are scanned for anchors at a time.
CHUNK = 1 << 17
_RANDOM = np.random.default_rng(5)
_BYTES = _RANDOM.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15 | 1
_PLACE = np.uint64((1 << 18) - 1)
_NONE = np.uint64(2**64 - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_STEP, CHUNK + LENGTH)
_DOWN = _powers(pow(_STEP, -1, 2**64), CHUNK + LENGTH)


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all windows in texts that end at `ends`."""
    places, hashes = [], []
    for begin in range(0, len(data), CHUNK):
        part = data[begin : begin + CHUNK + LENGTH - 1]
        m = len(part) - K + 1
        if m < LENGTH - K + 1:
            break
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTES[part] * _UP[: len(part)], out=sums[1:])
        keys = mixed((sums[K:] - sums[:m]) * _DOWN[:m])
        lo, hi = np.searchsorted(ends, [begin + 1, begin + len(part)])
        held = (keys & ~_PLACE) | np.arange(m, dtype=np.uint64)
        for e in ends[lo:hi] - begin:
            held[max(e - K + 1, 0) : e] = _NONE
        least, reach = held, 1
        while reach * 2 <= LENGTH - K + 1:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        rest = LENGTH - K + 1 - reach
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        at = (least[least < (_NONE & ~_PLACE)] & _PLACE).astype(np.int64)
        if len(at):
            at = at[np.concatenate([[True], at[1:] != at[:-1]])]
            places.append(at + begin)
            hashes.append(keys[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, hashes = np.concatenate(places), np.concatenate(hashes)
    first = np.concatenate([[True], places[1:] != places[:-1]])
    return places[first], hashes[first]


SCANNED = (
    "doc_id bigint, uid bigint, hash bigint, n_bytes bigint, sha string, "
    "places array<int>, anchors array<bigint>"
)


def _lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(3).to_pylist()
        for own in slices(texts):
            some = texts[own]
            sizes = np.array([len(t) for t in some], np.int64)
            ends = np.cumsum(sizes)
            at, hashes = anchors(np.frombuffer(b"".join(some), np.uint8), ends)
            row = np.searchsorted(ends, at, "right")
            long = sizes[row] >= LENGTH
            at, hashes, row = at[long], hashes[long], row[long]
            counts = np.bincount(row, minlength=len(some))
            yield pa.RecordBatch.from_arrays(
                [
                    *[c.slice(own.start, own.stop - own.start) for c in batch.columns[:3]],
                    pa.array(sizes, pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in some], pa.string()),
                    _lists(counts, pa.array(at - (ends - sizes)[row], pa.int32())),
                    _lists(counts, pa.array(hashes.view(np.int64), pa.int64())),
                ],
                names=[c.split()[0] for c in SCANNED.split(", ")],
            )


HELD = (
    "uid bigint, hash bigint, text binary, places array<int>, anchors array<bigint>, "
    "contexts array<bigint>"
)


def _name_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the hash of each anchor's context; the ends of the text are part of it."""
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        texts, lists = batch.column(2), batch.column(3)
        names = []
        for text, places in zip(texts, lists, strict=True):
            text = text.as_py()
            names += [
                digest(text[max(p - BEFORE, 0) : p + LENGTH], min(p, BEFORE)) for p in places.as_py()
            ]
        own = pa.array(np.array(names, np.uint64).view(np.int64), pa.int64())
        counts = np.array([len(x) for x in lists], np.int64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, _lists(counts, own)], names=[c.split()[0] for c in HELD.split(", ")]
        )


SENT = "anchor bigint, context bigint, copies bigint, left binary, right binary"


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, owned in zip(batch.column(0), batch.column(1), strict=True):
            text = text.as_py()
            for x in owned.as_py():
                p = x["place"]
                rows.append((x["anchor"], x["context"], x["copies"], text[max(p - BEFORE, 0) : p], text[p : p + LENGTH]))
        if rows:
            kinds = [pa.int64()] * 3 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=[c.split()[0] for c in SENT.split(", ")],
            )


def _matrix(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each text in a row, with zeros behind."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8)
    return data.reshape(len(texts), width), sizes


def _order(right: np.ndarray) -> np.ndarray:
    """Ranks of the rows by their bytes behind the anchor, from the suffix array of their blocks."""
    n, blocks = len(right), (LENGTH - K) // BLOCK
    cells = np.ascontiguousarray(right[:, K:]).reshape(n * blocks, BLOCK)
    words = cells.view(">u8").astype(np.uint64)
    by = np.lexsort(words.T[::-1])
    ordered = words[by]
    new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])
    ranks = np.empty(len(by), np.int64)
    ranks[by] = np.cumsum(new) + 1
    text = np.ones((n, blocks + 1), np.int64)  # 1 parts the contexts, 0 ends the text
    text[:, :blocks] = ranks.reshape(n, blocks)
    suffixes = np.array(suffix_array([*text.reshape(-1).tolist(), 0]), np.int64)
    heads = suffixes[(suffixes % (blocks + 1) == 0) & (suffixes < n * (blocks + 1))] // (blocks + 1)
    out = np.empty(n, np.int64)
    out[heads] = np.arange(n)
    return out


def repeated_windows(anchor: np.ndarray, lefts: list[bytes], rights: list[bytes], copies: np.ndarray) -> np.ndarray:
    """For each context a row of BEFORE + 1 flags: the window d bytes before the anchor is repeated."""
    n = len(lefts)
    left, before = _matrix([t[::-1] for t in lefts], BEFORE)
    right, behind = _matrix(rights, LENGTH)
    ranks = _order(right)
    # Hashes of the first bytes behind the anchor, and of the last ones before it.
    heads = np.zeros((LENGTH + 1, n), np.uint64)
    heads[0] = mixed(anchor.view(np.uint64))
    for i in range(LENGTH):
        heads[i + 1] = mixed(heads[i] * np.uint64(257) + right[:, i] + np.uint64(1))
    tail = heads[0].copy()
    found = np.zeros((n, BEFORE + 1), bool)
    by_rank = np.argsort(ranks, kind="stable")
    for d in range(BEFORE + 1):
        if d:
            tail = mixed(tail * np.uint64(257) + left[:, d - 1] + np.uint64(1))
        fits = (before >= d) & (behind >= LENGTH - d)
        found[fits & (copies > 1), d] = True
        own = by_rank[fits[by_rank]]
        own = own[np.argsort(tail[own], kind="stable")]
        head = heads[LENGTH - d]
        same = (tail[own[1:]] == tail[own[:-1]]) & (head[own[1:]] == head[own[:-1]])
        found[own[1:][same], d] = True
        found[own[:-1][same], d] = True
    return found


JUDGED = "context bigint, flags binary"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SENT rows ordered by anchor to JUDGED rows, some anchors at a time."""

    def done(table: pa.Table) -> pa.RecordBatch:
        found = repeated_windows(
            table.column(0).to_numpy(), table.column(3).to_pylist(), table.column(4).to_pylist(), table.column(2).to_numpy()
        )
        some = found.any(axis=1)
        flags = np.packbits(found[some], axis=1)
        return pa.RecordBatch.from_arrays(
            [table.column(1).filter(pa.array(some)).combine_chunks(), pa.array([f.tobytes() for f in flags], pa.binary())],
            names=["context", "flags"],
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BATCH:
            table = pa.Table.from_batches(held)
            keys = table.column(0).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last anchor may go on
            if cut:
                yield done(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
    if held and sum(b.num_rows for b in held):
        yield done(pa.Table.from_batches(held))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SENT rows to one row per window: its hash, which its anchor and d are part of."""
    for batch in batches:
        rows = []
        for anchor, context, copies, left, right in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for d in range(max(LENGTH - len(right), 0), len(left) + 1):
                window = b"%d %d " % (anchor, d) + left[len(left) - d :] + right[: LENGTH - d]
                name = xxhash.xxh3_128_digest(window)
                rows.append((context, d, copies, name))
        if rows:
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=["context", "d", "copies", "window"],
            )


def _pack_flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flags = np.zeros((batch.num_rows, BEFORE + 1), bool)
        for row, ds in zip(flags, batch.column(1).to_pylist(), strict=True):
            row[ds] = True
        packed = [f.tobytes() for f in np.packbits(flags, axis=1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(packed, pa.binary())], names=["context", "flags"]
        )


REMOVED = "uid bigint, hash bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def spans_of(starts: np.ndarray) -> np.ndarray:
    """Maximal runs [begin, end) covered by windows that start at the sorted `starts`."""
    opens = np.flatnonzero(np.concatenate([[True], starts[1:] > starts[:-1] + LENGTH]))
    return np.stack([starts[opens], starts[np.append(opens[1:], len(starts)) - 1] + LENGTH], axis=1)


def _remover(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for uid, hash_, text, verdicts in zip(*(c for c in batch.columns), strict=True):
                text, verdicts = text.as_py(), verdicts.as_py()
                places = np.array([v["place"] for v in verdicts], np.int64)
                flags = np.frombuffer(b"".join(v["flags"] for v in verdicts), np.uint8)
                flags = np.unpackbits(flags.reshape(len(places), -1), axis=1, count=BEFORE + 1)
                row, d = np.nonzero(flags)
                starts = np.unique(places[row] - d)
                spans = spans_of(starts)
                edges = np.concatenate([[0], spans.reshape(-1), [len(text)]]).reshape(-1, 2)
                kept = b"".join(text[a:b] for a, b in edges.tolist())
                rows.append(
                    (uid.as_py(), hash_.as_py(), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept if keep_text else None)
                )
            if rows:
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=[c.split()[0] for c in REMOVED.split(", ")],
                )

    return run


def remove_repeats(docs: DataFrame, keep_text: bool = False, most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and `kept`, the bytes left)."""
    whole = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    # Rows of one document id and text are told apart by nothing, and need not be.
    named = whole.select(
        "doc_id", F.xxhash64("doc_id", "text").alias("uid"), F.xxhash64("text", F.lit(3)).alias("hash"), "text"
    )
    scanned = settle(named.mapInArrow(_scan, SCANNED), "scanned")
    key = ["uid", "hash"]

    # 1. anchors that occur twice
    each = scanned.select(*key, F.explode(F.arrays_zip("places", "anchors")).alias("x"))
    each = each.select(*key, F.col("x.places").alias("place"), F.col("x.anchors").alias("anchor"))
    twice = each.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("anchor")
    found = each.join(twice, "anchor").groupBy(*key).agg(F.array_distinct(F.collect_list(F.struct("place", "anchor"))).alias("x"))
    found = found.select(*key, F.col("x.place").alias("places"), F.col("x.anchor").alias("anchors"))
    held = named.drop("doc_id").join(found, key).select(*key, "text", "places", "anchors")
    held = settle(held.mapInArrow(_name_contexts, HELD), "held")

    # 2. contexts, each with one owner
    each = held.select(*key, F.explode(F.arrays_zip("places", "anchors", "contexts")).alias("x"))
    each = each.select(*key, F.col("x.places").alias("place"), F.col("x.anchors").alias("anchor"), F.col("x.contexts").alias("context"))
    contexts = each.groupBy("context").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("uid", "hash", "place", "anchor")).alias("owner"),
    )
    contexts = settle(contexts.select("context", "copies", "owner.*"), "contexts")
    wide = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("_different"))
    wide = contexts.join(wide, "anchor").filter("_different > 1 or copies > 1")
    owned = wide.groupBy(*key).agg(
        F.collect_list(F.struct("place", "anchor", "context", "copies", "_different")).alias("owned")
    )
    owned = settle(held.select(*key, "text").dropDuplicates(key).join(owned, key).select("text", "owned"), "owned")

    # 3. windows that are repeated
    few = owned.select("text", F.filter("owned", lambda x: x["_different"] <= most_contexts).alias("owned"))
    sent = few.mapInArrow(_send, SENT).repartition("anchor").sortWithinPartitions("anchor")
    judged = sent.mapInArrow(_judge, JUDGED)
    if not contexts.groupBy("anchor").count().filter(F.col("count") > most_contexts).isEmpty():
        many = owned.select("text", F.filter("owned", lambda x: x["_different"] > most_contexts).alias("owned"))
        windows = settle(many.mapInArrow(_send, SENT).mapInArrow(_windows, "context bigint, d int, copies bigint, window binary"), "windows")
        again = windows.groupBy("window").agg(F.sum("copies").alias("_n")).filter("_n > 1").select("window")
        flags = windows.join(again, "window").groupBy("context").agg(F.collect_set("d").alias("ds"))
        judged = judged.unionByName(flags.mapInArrow(_pack_flags, JUDGED))
    judged = settle(judged, "judged")

    # 4. spans of the documents
    verdicts = each.join(judged, "context").groupBy(*key)
    verdicts = verdicts.agg(F.collect_set(F.struct("place", "flags")).alias("verdicts"))
    removed = held.select(*key, "text").dropDuplicates(key).join(verdicts, key)
    removed = removed.mapInArrow(_remover(keep_text), REMOVED)
    out = scanned.select("doc_id", *key, "n_bytes", "sha").join(removed, key, "left")
    out = out.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        *(["kept", *key] if keep_text else []),
    )
    return out
