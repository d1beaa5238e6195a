"""Whole texts to token ids, each distinct word encoded once per worker.

A text's ids are those of its words one after the other: the tokenizer drops white space, and neither
its normaliser nor its pieces reach across it, nor from a letter a to z to a sign other than an apostrophe
or back. So many texts at a time are cut there, their words are numbered by Arrow, and a `WordMemory` gives
the ids of the distinct ones that were seen before; new ones are encoded together. Texts that hold the
opening of a special token are encoded as they are.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

from feedkit.llm.wordmemory import WORD_LIMIT, WordMemory

#: Bytes of text that are split into words at a time.
SLICE_BYTES = 1 << 20
#: Words that are encoded as one text, and such texts at a time: what the library returns is large.
JOINED, AT_ONCE = 64, 64
#: What may end a word as a piece of its own; an apostrophe can begin a contraction.
TAIL = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
WHITE, LETTERS = b" \t\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz"
LOWER = bytes(range(256)).translate(bytes.maketrans(LETTERS.upper(), LETTERS))
#: Kinds of bytes. Words are cut between two whose kinds differ by `APART` or more in their bits.
SPACE, LETTER, SIGN, OTHER, APART = 4, 1, 2, 0, 3
KINDS = bytes(SPACE if c in WHITE else LETTER if c in LETTERS else SIGN if c in TAIL else OTHER for c in LOWER)
#: Letters below this one have been the same in all versions of Unicode, and do not compose.
SETTLED = "\u0250"


def split_words(texts: Sequence[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of some texts in lower case, the place among them of each word, and how many each text has."""
    joined = b" ".join([b"", *texts, b""])
    kinds = np.frombuffer(joined.translate(KINDS), np.uint8)
    cut = (kinds[1:] ^ kinds[:-1]) >= APART
    starts, stops = np.flatnonzero(cut & (kinds[1:] != SPACE)), np.flatnonzero(cut & (kinds[:-1] != SPACE))
    ends = np.cumsum(stops - starts)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(joined.translate(LOWER, WHITE))]
    words = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    counts = np.diff(np.searchsorted(starts, begins))
    return words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy(), counts


class WordEncoder:
    """Encodes batches of UTF-8 texts; `end_id` is added to every text."""

    def __init__(self, path: str, end_id: int, limit: int = WORD_LIMIT) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # Words of settled letters in lower case need no normaliser, and white space alone parts them.
        self.bare = Tokenizer(self.tokenizer.model)
        in_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), in_bytes])
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.closes = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.closes[i] = token.endswith("</w>")
        self.memory = WordMemory([b""], [[end_id]], limit, max(size - 1, end_id))

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _bare(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.bare.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[bytes], encode: Callable[[list[str]], list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of words of letters alone: each is one piece, and ends with a closing token."""
        ids, sizes = [], []
        for i in range(0, len(words), JOINED * AT_ONCE):
            groups = [words[j : j + JOINED] for j in range(i, min(i + JOINED * AT_ONCE, len(words)), JOINED)]
            encoded = encode([b" ".join(g).decode() for g in groups])
            for own, found in zip(groups, encoded, strict=True):
                found = np.array(found, np.uint32)
                ends = np.flatnonzero(self.closes[found]) + 1
                if len(ends) == len(own):
                    sizes.append(np.diff(ends, prepend=0))
                    ids.append(found)
                else:
                    apart = self._plain([w.decode() for w in own])
                    sizes.append(np.array([len(x) for x in apart]))
                    ids += [np.array(x, np.uint32) for x in apart]
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self) -> None:
        """Give ids to the words that were new."""
        memory = self.memory
        numbers = memory.numbers
        words = numbers.new  # grows: a word with a tail needs its core and the tail as well
        bare, bare_at, letters, letters_at, others, composed = [], [], [], [], [], []
        first = numbers.count - len(words)
        for number, word in enumerate(words, first):
            if word.isalpha():
                # Only a to z: the texts are in lower case.
                bare_at.append(number)
                bare.append(word)
                continue
            core = word.rstrip(TAIL)
            text = core.decode()
            low = text.lower()
            if not (text.isalpha() and low.isalpha()):
                others.append((number, word.decode()))
            elif len(core) < len(word):
                composed.append((number, numbers[core], numbers[word[len(core) :]]))
            elif text == low and max(text) < SETTLED:
                bare_at.append(number)
                bare.append(word)
            else:
                letters_at.append(number)
                letters.append(word)
        if bare:
            memory.learn_at(np.array(bare_at), *self._letters(bare, self._bare))
        if letters:
            memory.learn_at(np.array(letters_at), *self._letters(letters, self._plain))
        for i in range(0, len(others), JOINED * AT_ONCE):
            some = others[i : i + JOINED * AT_ONCE]
            found = self._plain([t for _, t in some])
            sizes = np.array([len(x) for x in found])
            memory.learn_at(np.array([n for n, _ in some]), np.array([x for own in found for x in own], np.uint32), sizes)
        if composed:
            own = np.array(composed, np.int64)
            ids, sizes = memory.gather(own[:, 1:].ravel())
            memory.learn_at(own[:, 0], ids, sizes.reshape(-1, 2).sum(axis=1))
        numbers.new = []

    def encode(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has (its end id included)."""
        self.memory.make_room()
        whole = [i for i, text in enumerate(texts) if b"<|" in text]
        apart = set(whole)
        words, pick, counts = split_words([b"" if i in apart else t for i, t in enumerate(texts)] if whole else texts)
        numbers = np.fromiter(map(self.memory.numbers.__getitem__, words), np.int64, len(words))
        if self.memory.numbers.new:
            self._learn()
        ends = np.cumsum(counts)
        ids, sizes = self.memory.gather(np.insert(numbers[pick], ends, 0))
        at = ends + np.arange(len(counts))  # of the end ids
        lengths = np.add.reduceat(sizes, at - counts) if len(counts) else counts
        if whole:
            before = (np.cumsum(sizes) - sizes)[at[whole]]
            own = [np.array(x, np.uint32) for x in self._plain([texts[i].decode() for i in whole])]
            cuts = np.split(ids, before)
            ids = np.concatenate([cuts[0], *[y for x in zip(own, cuts[1:], strict=True) for y in x]])
            lengths[whole] += [len(x) for x in own]
        return ids, lengths


_encoders: dict[tuple, WordEncoder] = {}


def encoder(path: str, end_id: int) -> WordEncoder:
    """This worker's encoder for a tokenizer file, kept from task to task."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = WordEncoder(path, end_id)
    return _encoders[path, end_id]


def spans(lengths: Sequence[int], most: int = SLICE_BYTES) -> Iterator[slice]:
    """Ranges of texts of about `most` bytes, by their lengths; a longer text is a range of its own."""
    begin, size = 0, 0
    for i, length in enumerate(lengths):
        if size and size + length > most:
            yield slice(begin, i)
            begin, size = i, 0
        size += length
    if begin < len(lengths):
        yield slice(begin, len(lengths))


def slices(texts: Sequence[bytes], most: int = SLICE_BYTES) -> Iterator[slice]:
    """Such ranges of the texts themselves."""
    return spans([len(text) for text in texts], most)
