"""A worker's memory of words and their token ids, bounded without forgetting what is in use.

Words live in two generations. A word that is seen joins the young one; when that is full, it becomes
the old one and the former old one is dropped. So a word is forgotten only if it was not seen during a
whole generation: words that come up again and again stay, words seen once make room. At most
`2 * limit` words, and about as many ids as `IDS_A_WORD` for each, are held.
"""

from __future__ import annotations

import numpy as np

#: Words of a generation.
WORD_LIMIT = 450_000
#: A generation also ends when it holds so many ids for each word of the limit.
IDS_A_WORD = 16
#: Words whose ids are looked up at a time, in little memory.
PICKED = 1 << 16


class _Young(dict):
    """Word to number. A word of the old generation moves here with its number, a new one waits in `new`."""

    def __init__(self, old: dict, count: int) -> None:
        super().__init__()
        self.old, self.count, self.new = old, count, []

    def __missing__(self, word):
        number = self.old.pop(word, None)
        if number is None:
            self.new.append(word)
            number, self.count = self.count, self.count + 1
        self[word] = number
        return number


class WordMemory:
    """Numbers for words (`numbers[word]`), and their ids by number.

    After looking words up, give the ids of those in `numbers.new` with `learn` or `learn_at`.
    `first` words get the numbers from 0 on, for good. No id is above `top`.
    """

    def __init__(self, first: list, first_ids: list[list[int]], limit: int = WORD_LIMIT, top: int = (1 << 32) - 1) -> None:
        self.limit, self.first = limit, first
        self.ids, self.used = np.zeros(1 << 16, np.min_scalar_type(top)), 0
        self.start, self.size = np.zeros(1 << 14, np.uint32), np.zeros(1 << 14, np.uint32)
        self.numbers = _Young({}, 0)
        for word in first:
            self.numbers[word]
        self.learn(np.array([x for own in first_ids for x in own], np.uint32), np.array([len(own) for own in first_ids]))

    def learn(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """The ids of all new words, one after the other, and how many each has."""
        count = self.numbers.count
        self.learn_at(np.arange(count - len(self.numbers.new), count), ids, sizes)
        self.numbers.new = []

    def learn_at(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """The ids of some words by number; empty `numbers.new` when all are learned."""
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(ids)), self.ids.dtype)])
        if self.numbers.count > len(self.start):
            more = max(len(self.start), self.numbers.count - len(self.start))
            self.start = np.concatenate([self.start, np.zeros(more, np.uint32)])
            self.size = np.concatenate([self.size, np.zeros(more, np.uint32)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.size[numbers] = sizes
        self.start[numbers] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)

    def gather(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered words, one after the other, and how many each has."""
        sizes = self.size[pick].astype(np.int64)
        ids, done = np.empty(sizes.sum(), np.uint32), 0
        for i in range(0, len(pick), PICKED):
            own = sizes[i : i + PICKED]
            at = np.repeat(self.start[pick[i : i + PICKED]] - (np.cumsum(own) - own), own)
            at += np.arange(len(at))
            ids[done : done + len(at)] = self.ids[at]
            done += len(at)
        return ids, sizes

    def make_room(self) -> None:
        """End the generation if it is full. Numbers given before are void then."""
        if len(self.numbers) <= self.limit and self.used <= IDS_A_WORD * self.limit:
            return
        kept = self.numbers
        for word in self.first:
            kept[word]
        # The first words came first, and keep the first numbers.
        words, kept.old = kept, {}
        if len(kept) <= len(self.first) + 1 or self.used > 2 * IDS_A_WORD * self.limit:
            words = {w: kept[w] for w in self.first}  # a few words with endless ids
        ids, sizes = self.gather(np.fromiter(words.values(), np.int64, len(words)))
        for number, word in enumerate(words):
            words[word] = number  # in place: a second table would double the memory
        self.numbers = _Young({}, 0)
        for word in self.first:
            self.numbers[word]
        self.numbers.old = words
        self.numbers.count, self.numbers.new = len(words), []
        self.ids, self.used = ids.astype(self.ids.dtype), len(ids)
        self.size, self.start = sizes.astype(np.uint32), (np.cumsum(sizes) - sizes).astype(np.uint32)
