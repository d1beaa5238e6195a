"""Encoding and decoding of whole texts by a byte-pair piece model, in vectorised merge rounds.

The model (a SentencePiece BPE file with byte fallback, a space put before every text and no other
normalisation) is read through its library; encoding and decoding are done here in numpy. A text is
split before every run of spaces, since no piece has a space behind another character. A
`WordMemory` keeps the ids of words; new words are encoded together:

* Their characters are one flat array of symbols, cut into segments wherever two neighbours occur side
  by side in no piece.
* Each round takes the minimum rank of a segment's pairs, in all segments at once, merges that rank's
  pairs from the left, and compacts the array. Segments without a pair left are done and leave it.
* A merge may bring forth a pair of a rank that is not higher, which comes before the next pair of the
  round. Such clusters of pairs are worked off one by one in their window: pieces are short, so what
  happens there cannot reach further than a piece's length.

Ties of rank go to the left. Characters without a piece become their UTF-8 bytes' pieces. Words of any
length are encoded whole; a round costs time in proportion to the symbols that are left.

Null texts count as empty; empty texts have no ids and decode to empty texts; repeated rows are encoded
each for itself; ids of documents (null, too) are passed on; an empty table gives no rows; columns other
than doc_id and text are not read. Decoding knows all ids: controls vanish, unknown ones are written
as the library writes them, bytes that are no UTF-8 become U+FFFD each.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.wordids import slices
from feedkit.llm.wordmemory import WORD_LIMIT, WordMemory

SPACE = "▁"
_NEVER = np.iinfo(np.int32).max
_UNIT = re.compile(" +[^ ]*")


class PieceModel:
    """Tables of a piece model: pairs of pieces by rank, characters, bytes."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = library.vocab_size()
        every = range(self.size)
        self.control = np.array([library.is_control(i) for i in every])
        self.is_byte = np.array([library.is_byte(i) for i in every])
        self.unknown = np.array([library.is_unknown(i) for i in every])
        names = [library.id_to_piece(i) for i in every]
        plain = np.flatnonzero(~(self.control | self.is_byte | self.unknown))
        ids = {names[i]: int(i) for i in plain}
        ranks = {s: r for r, s in enumerate(sorted({library.get_score(int(i)) for i in plain}, reverse=True))}
        self.byte_ids = np.zeros(256, np.int32)
        for i in np.flatnonzero(self.is_byte):
            self.byte_ids[int(names[i][1:-1], 16)] = i
        self.char_ids = np.full(0x110000, -1, np.int32)
        pairs, beside = [], set()
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char_ids[ord(piece)] = i
            for k in range(1, len(piece)):
                left, right = ids.get(piece[:k]), ids.get(piece[k:])
                if left is not None and right is not None:
                    pairs.append((left * self.size + right, ranks[library.get_score(i)], i))
                beside.add((piece[k - 1], piece[k]))
        pairs.sort()
        table = np.array(pairs, np.int64).reshape(-1, 3)
        # The last entry stands for all pairs that make no piece.
        self.keys = np.append(table[:, 0], np.iinfo(np.int64).max)
        self.ranks = np.append(table[:, 1], _NEVER).astype(np.int32)
        self.makes = np.append(table[:, 2], -1).astype(np.int32)
        self.place = dict(zip(self.keys[:-1].tolist(), range(len(table)), strict=True))
        self.beside = np.array(sorted(self._beside(ord(a), ord(b)) for a, b in beside), np.int64)
        self.longest = max(map(len, ids))
        texts = [b"" if self.control[i] else self._surface(names[i], i, library) for i in every]
        self.text_sizes = np.array([len(t) for t in texts], np.int64)
        self.text_starts = np.cumsum(self.text_sizes) - self.text_sizes
        self.texts = np.frombuffer(b"".join(texts), np.uint8)
        self.spaced = np.array([n.startswith(SPACE) for n in names]) & ~(self.control | self.is_byte | self.unknown)
        if any(p[k] == SPACE != p[k - 1] for p in ids for k in range(1, len(p))):
            raise ValueError("a piece has a space behind another character: words cannot be told apart")
        probe = " a  bé\nａ" + SPACE
        if PieceEncoder(self).encode([probe])[0].tolist() != library.encode(probe):
            raise ValueError("not a byte-pair model with byte fallback and a space before every text")

    @staticmethod
    def _beside(left, right):
        return left * 0x110000 + right

    def _surface(self, name: str, i: int, library) -> bytes:
        if self.is_byte[i]:
            return bytes([int(name[1:-1], 16)])
        if self.unknown[i]:
            return library.decode([int(i)]).encode()
        return name.replace(SPACE, " ").encode()

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair in the table; the last one if it makes no piece."""
        key = np.where((left < 0) | (right < 0), -1, left * np.int64(self.size) + right)
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, at, len(self.keys) - 1)

    def follow(self, chars: np.ndarray) -> np.ndarray:
        """Whether each character but the last stands beside the next in some piece."""
        key = self._beside(chars[:-1].astype(np.int64), chars[1:])
        if not len(self.beside):
            return np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
        return self.beside[at] == key


def one_by_one(model: PieceModel, symbols: list[int], top: int) -> list[int]:
    """All merges of ranks up to `top`, lowest rank and then leftmost first."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int, int]] = []
    ranks, makes = model.ranks, model.makes

    def offer(a: int) -> None:
        b = after[a] if a >= 0 else n
        if b < n and symbols[a] >= 0 and symbols[b] >= 0:
            at = model.place.get(symbols[a] * model.size + symbols[b])
            if at is not None and ranks[at] <= top:
                heapq.heappush(heap, (int(ranks[at]), a, symbols[a], symbols[b], int(makes[at])))

    for a in range(n - 1):
        offer(a)
    while heap:
        _, a, x, y, made = heapq.heappop(heap)
        b = after[a]
        if symbols[a] != x or b >= n or symbols[b] != y:
            continue  # one of the two has been merged since
        symbols[a], symbols[b] = made, None
        after[a] = after[b]
        if after[b] < n:
            before[after[b]] = a
        offer(before[a])
        offer(a)
    return [s for s in symbols if s is not None]


def merge_rounds(model: PieceModel, symbols: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge until no pair is left; the symbols, and each one's segment (numbers in rising order)."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    none = len(model.keys) - 1
    pair = np.full(len(symbols), none)

    def refresh(at: np.ndarray) -> None:
        pair[at[at >= 0]] = none
        at = at[(at >= 0) & (at < len(symbols) - 1)]
        found = model.find(symbols[at], symbols[at + 1])
        pair[at] = np.where(segment[at] == segment[at + 1], found, none)

    refresh(np.arange(len(symbols)))
    while len(symbols):
        heads = np.flatnonzero(np.diff(segment, prepend=-1))
        rank = model.ranks[pair]
        low = np.minimum.reduceat(rank, heads)
        low = np.repeat(low, np.diff(heads, append=len(symbols)))
        ended = low == _NEVER
        if ended.any():
            done.append((segment[ended], symbols[ended]))
            alive = ~ended
            symbols, segment, pair, rank, low = symbols[alive], segment[alive], pair[alive], rank[alive], low[alive]
            if not len(symbols):
                break
        hits = np.flatnonzero(rank == low)
        # Of hits one behind the other, every second: from the left, without overlaps.
        first = np.diff(hits, prepend=-2) != 1
        nth = np.arange(len(hits)) - np.maximum.accumulate(np.where(first, np.arange(len(hits)), 0))
        hits = hits[nth % 2 == 0]
        made = model.makes[pair[hits]]
        touched = _touched(model, symbols, segment, low, hits, made)
        keep = np.ones(len(symbols), bool)
        fresh = np.zeros(len(symbols), bool)
        for begin, end in touched[1]:
            own = one_by_one(model, symbols[begin:end].tolist(), int(low[begin]))
            symbols[begin : begin + len(own)] = own
            keep[begin + len(own) : end] = False
            fresh[begin : begin + len(own)] = True
        calm = hits[touched[0]]
        symbols[calm], fresh[calm], keep[calm + 1] = made[touched[0]], True, False
        symbols, segment, pair, fresh = symbols[keep], segment[keep], pair[keep], fresh[keep]
        changed = np.flatnonzero(fresh)
        refresh(np.union1d(changed, changed - 1))
    if not done:
        return symbols, segment
    owner, out = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(owner, kind="stable")
    return out[order], owner[order]


def _touched(model, symbols, segment, low, hits, made) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which hits may be merged at once, and the windows of those that may not.

    A hit may not if it, or one of its cluster, brings forth a pair of its rank or a lower one.
    """
    n = len(symbols)
    left, right = np.maximum(hits - 1, 0), np.minimum(hits + 2, n - 1)
    beside = symbols[left].copy()
    joined = np.flatnonzero(np.diff(hits, prepend=-3) == 2)
    beside[joined] = made[joined - 1]  # merged before it
    ways = np.minimum(
        np.where((hits > 0) & (segment[left] == segment[hits]), model.ranks[model.find(beside, made)], _NEVER),
        np.where((hits + 2 < n) & (segment[right] == segment[hits]), model.ranks[model.find(made, symbols[right])], _NEVER),
    )
    stirred = ways <= low[hits]
    if not stirred.any():
        return np.ones(len(hits), bool), []
    reach = model.longest
    apart = (np.diff(hits, prepend=-1) > 2 * reach + 2) | (np.diff(segment[hits], prepend=-1) != 0)
    cluster = np.cumsum(apart) - 1
    bad = np.unique(cluster[stirred])
    begin = np.flatnonzero(apart)[bad]
    end = np.append(np.flatnonzero(apart), len(hits))[bad + 1] - 1
    windows = []
    for b, e in zip(hits[begin].tolist(), hits[end].tolist(), strict=True):
        own = segment[b]
        low_end, high_end = max(b - reach, 0), min(e + 2 + reach, n)
        low_end += int(np.searchsorted(segment[low_end:b], own))
        high_end = e + int(np.searchsorted(segment[e:high_end], own, "right"))
        windows.append((low_end, high_end))
    return ~np.isin(cluster, bad), windows


class PieceEncoder:
    """Encodes batches of texts with a memory of words."""

    def __init__(self, model: PieceModel, limit: int = WORD_LIMIT) -> None:
        self.model, self.memory = model, WordMemory([], [], limit)

    def _learn(self) -> None:
        """Encode all new words; each stands for itself with a space before it."""
        model, words = self.model, self.memory.numbers.new
        flat = np.frombuffer((" " + " ".join(words)).replace(" ", SPACE).encode("utf-32-le"), np.uint32)
        heads = np.cumsum([0, *(len(w) + 1 for w in words)])
        cut = np.ones(len(flat), bool)
        cut[1:] = ~model.follow(flat)
        cut[heads[:-1]] = True
        symbols = model.char_ids[flat]
        symbols = np.where(symbols < 0, -1 - flat.astype(np.int64), symbols)
        segment = np.cumsum(cut) - 1
        word_of = np.repeat(np.arange(len(words)), np.diff(heads))[cut]
        ids, owner = merge_rounds(model, symbols, segment)
        owner = word_of[owner]
        odd = ids < 0
        if odd.any():
            chars = (-1 - ids[odd]).astype(np.uint32)
            raw = np.frombuffer(chars.tobytes().decode("utf-32-le").encode(), np.uint8)
            sizes = np.ones(len(ids), np.int64)
            sizes[odd] = 1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF)
            ids, owner = np.repeat(ids, sizes), np.repeat(owner, sizes)
            ids[np.repeat(odd, sizes)] = model.byte_ids[raw]
        self.memory.learn(ids.astype(np.uint32), np.bincount(owner, minlength=len(words)))

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        self.memory.make_room()
        found: list[int] = []
        counts = np.zeros(len(texts), np.int64)
        look = self.memory.numbers.__getitem__
        for i, text in enumerate(texts):
            if not text:
                continue
            if SPACE in text:
                text = text.replace(SPACE, " ")
            if "  " in text or text[0] == " " or text[-1] == " ":
                words = [w[1:] for w in _UNIT.findall(" " + text)]
            else:
                words = text.split(" ")
            found.extend(map(look, words))
            counts[i] = len(words)
        if self.memory.numbers.new:
            self._learn()
        ids, sizes = self.memory.gather(np.array(found, np.int64))
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
        return ids, np.diff(ends, prepend=0)


def decode(model: PieceModel, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """The texts of lists of ids, one after the other in `ids`."""
    sizes = model.text_sizes[ids]
    ends = np.cumsum(sizes)
    at = np.repeat(model.text_starts[ids] - (ends - sizes), sizes)
    at += np.arange(len(at))
    data = model.texts[at].tobytes()
    rows = np.cumsum(counts)
    cuts = np.concatenate([[0], ends])[np.concatenate([[0], rows])].tolist()
    out = []
    for i, (begin, end) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        own = ids[rows[i] - counts[i] : rows[i]]
        seen = next((x for x in own if not model.control[x]), None)
        skip = int(seen is not None and model.spaced[seen])
        try:
            if seen is not None and model.control[own].any():  # a control parts the bytes around it
                out.append(_decode_plainly(model, own)[skip:])
            else:
                out.append(data[begin + skip : end].decode())
        except UnicodeDecodeError:
            out.append(_decode_plainly(model, own)[skip:])
    return out


def _decode_plainly(model: PieceModel, ids: np.ndarray) -> str:
    """Runs of bytes that are no UTF-8 become a U+FFFD for each byte that begins no character."""
    out, run = [], bytearray()

    def flush() -> None:
        at = 0
        while at < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(bytes(run[at : at + n]).decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        run.clear()

    for i in ids.tolist():
        if model.is_byte[i]:
            run += model.texts[model.text_starts[i] : model.text_starts[i] + 1].tobytes()
        else:
            flush()
            begin = model.text_starts[i]
            out.append(model.texts[begin : begin + model.text_sizes[i]].tobytes().decode())
    flush()
    return "".join(out)


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """This worker's encoder for a model file, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(PieceModel(path))
    return _encoders[path]


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids.astype(np.int32), pa.int32())
    )


def encode_texts(docs: DataFrame, path: str, with_text: bool = False) -> DataFrame:
    """doc_id, ids (array<int>); `with_text` adds `decoded`, the text that these ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for own in slices(texts):
                ids, counts = words.encode(texts[own])
                columns = [keys.slice(own.start, own.stop - own.start), _lists(ids, counts)]
                if with_text:
                    columns.append(pa.array(decode(words.model, ids, counts), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])

    schema = "doc_id bigint, ids array<int>" + (", decoded string" if with_text else "")
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, schema)


def decode_ids(rows: DataFrame, path: str) -> DataFrame:
    """`rows` (doc_id, ids) as doc_id, decoded; null lists decode to null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path).model
        for batch in batches:
            lists = [None if x is None else np.array(x, np.int64) for x in batch.column(1).to_pylist()]
            flat = np.concatenate([np.zeros(0, np.int64), *(x for x in lists if x is not None)])
            texts = iter(decode(model, flat, np.array([len(x) for x in lists if x is not None], np.int64)))
            got = [None if x is None else next(texts) for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.string())], names=["doc_id", "decoded"])

    return rows.select(F.col("doc_id").cast("bigint"), "ids").mapInArrow(run, "doc_id bigint, decoded string")
