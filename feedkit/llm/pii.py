"""Personal data: rules for plain forms, and a semi-Markov random field for what they miss.

Rules find e-mail addresses, IPv4 addresses, card numbers and phone numbers, leftmost and without
overlaps for each kind. The field reads windows around numbers, `@` and `dot` that no rule's span
covers, and around `at` before labels with a dot; they grow over all that may belong to an address. It
scores segments (any of `MAX_TOKENS` tokens; numbers and addresses to their full length) by features of the whole span (shape, digits,
groups, separators, check digit, ends, neighbours), knows what follows what, and a dynamic program
over segment ends chooses boundaries and kinds together. Segments are made and scored for a block of
starts at a time, from running sums, so time and memory grow in proportion to the text. It adds spans outside those of the rules, and
takes none away.

The field is trained on windows of all documents, a bounded number of each kind by hash: the rules' spans as they stand,
and written in other ways (`at` and `dot`, brackets, other separators, no country code); all else in
these windows counts as no entity. Training maximises the exact likelihood.

Offsets are code points, ends exclusive. Null texts count as empty, and empty texts have no spans;
repeated rows are read each for itself; an empty table gives no rows; columns other than doc_id and
text are not read. Scans are linear in the text, also in endless runs of digits or signs.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.hashing import mixed
from feedkit.plans.settle import settle

KINDS = ("email", "ip", "card", "phone")
#: Windows that are learned from, rounds, and features of a span.
MOST_WINDOWS, ROUNDS, FEATURES = 700, 6, 1 << 12
#: Tokens of a segment that may hold anything. Numbers and addresses go on behind that: an address has at
#: most 254 characters, in turn labels and dots that `rewritten` makes five tokens of.
MAX_TOKENS, MOST_TOKENS = 20, 3 * 254
#: Most tokens `at` or `@` in such a long address; labels may be named so.
MOST_ATS = 4
#: Characters of an address as it is written out, and of the part before its at: no mail server takes more.
ADDRESS, LOCAL = 254, 64
#: Characters of a window that is learned from as holding no entity.
LESSON = 400
#: Characters that a window shows at least on each side of what it is about.
MARGIN = 30

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_ZONE = re.compile(r"[0-9][0-9 .-]*")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The rules' spans by start, then kind."""
    found: list[Span] = []
    at, end = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in _LOCAL:
            begin -= 1
        match = _DOMAIN.match(text, at + 1) if begin < at else None
        if match:
            end = match.end()
            found.append((begin, 0, end))
        at = text.find("@", max(at + 1, end))
    for zone in _ZONE.finditer(text):
        if zone.end() - zone.start() < 7:
            continue
        for m in _IP.finditer(text, zone.start(), zone.end()):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        if zone.end() - zone.start() >= 12:
            for m in _CARD.finditer(text, zone.start(), zone.end()):
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
    at = text.find("+")
    while at >= 0:
        m = _PHONE.match(text, at)
        if m and 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
        at = text.find("+", m.end() if m else at + 1)
    return sorted(found)


_TOKEN = re.compile(r"[^\W_]+|\s+|[\W_]")
#: What may stand around `at` and `dot`.
_AROUND = r"[\s\[\](){}<>]"
#: What a window is about: numbers of some length, the at sign, the word dot, and the word at before two
#: labels with a dot between them (one with a blank on its right alone ends a sentence).
_ABOUT = re.compile(
    r"[0-9][0-9 ().\-_/\[\]]{5,}[0-9]|@|(?<![^\W_])[dD][oO][tT](?![^\W_])"
    rf"|(?<![^\W_])[aA][tT](?![^\W_])(?={_AROUND}*+[^\W_](?:[^\W_]|-)*+(?:\.|{_AROUND}++\.{_AROUND}*+)[^\W_])"
)
_ADDRESS_SIGNS, _NUMBER_SIGNS = frozenset("._%+-@[](){}<>"), frozenset("+.-_/[]()")
_ADDRESS = re.compile(r"(?:[^\W_]|[._%+\-@\[\](){}<>])*+")
_BLANK = re.compile(r"\s*+")
#: Signs and words next to which a blank may be inside an address.
_BEFORE = re.compile(rf"(?:@|(?<![^\W_])(?:at|dot)|(?<![^\s\[\](){{}}<>])\.){_AROUND}*\Z", re.IGNORECASE)
_AFTER = re.compile(rf"{_AROUND}*+(?:@|\.|(?:at|dot)(?![^\W_]))", re.IGNORECASE)


def _joined(text: str, left: int, right: int, low: int, high: int) -> bool:
    """Whether the blanks from left to right may be inside an address."""
    return bool(_AFTER.match(text, right, high) or _BEFORE.search(text[max(left - MARGIN, low) : left]))


def _run_begin(text: str, at: int, low: int, high: int) -> int:
    """Where what may belong to an address with the character at `at` begins."""
    while True:
        while at > low and (text[at - 1].isalnum() or text[at - 1] in _ADDRESS_SIGNS):
            at -= 1
        left = at
        while left > low and text[left - 1].isspace():
            left -= 1
        if left in (low, at) or not _joined(text, left, at, low, high):
            return at
        at = left


def _run_end(text: str, at: int, low: int, high: int) -> int:
    while True:
        at = _ADDRESS.match(text, at, high).end()
        right = _BLANK.match(text, at, high).end()
        if right in (at, high) or not _joined(text, at, right, low, high):
            return at
        at = right


def gaps_of(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """What the rules' spans leave of the text."""
    out, at = [], 0
    for begin, end in sorted((s, e) for s, _, e in spans):
        if begin > at:
            out.append((at, begin))
        at = max(at, end)
    return [*out, (at, len(text))] if at < len(text) else out


def windows_of(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Ranges around what the rules' spans do not cover; they end at those spans and do not meet."""
    out: list[list[int]] = []
    for low, high in gaps_of(text, spans):
        # A match ends at the gap's end, so that a number next to a span is seen without it.
        run = low
        for m in _ABOUT.finditer(text, low, high):
            first = _run_begin(text, m.start(), run, high) if m.start() >= run else m.start()
            if m.end() > run:
                run = _run_end(text, m.end(), low, high)
            begin, end = max(min(m.start() - MARGIN, first), low), min(max(m.end() + MARGIN, run), high)
            if out and begin <= out[-1][1] and low <= out[-1][0]:
                out[-1][1] = max(out[-1][1], end)
            else:
                out.append([begin, end])
    return [(a, b) for a, b in out]


#: Codes of tokens: digits, blanks, letters, letters with digits; a sign's is its code point and SIGN.
DIGITS, BLANK, LETTERS, MIXED, BAR, SIGN = 1, 2, 3, 4, 5, 16
#: Starts of segments that are worked on at once.
BLOCK = 4096
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _kind_of(token: str) -> int:
    if token.isascii() and token.isdigit():
        return DIGITS
    if token[0].isspace():
        return BLANK
    if token[0].isalnum():
        return LETTERS if token.isalpha() else MIXED
    return SIGN + ord(token)


def _sums(values) -> np.ndarray:
    """Sums of what stands before each place."""
    return np.concatenate([[0], np.cumsum(np.asarray(values, np.int64))])


class Tokens:
    """The tokens of some windows, a bar behind each, with sums over what a span may hold."""

    def __init__(self, windows: list[tuple[str, int, int]]) -> None:
        self.bounds: list[tuple[int, int]] = []
        self.window: list[int] = []
        words, kinds, addressed = [], [], []
        for w, (text, begin, end) in enumerate(windows):
            # Tokens that the range cuts are left out.
            while begin > 0 and begin < end and text[begin - 1].isalnum() and text[begin].isalnum():
                begin += 1
            while end < len(text) and end > begin and text[end - 1].isalnum() and text[end].isalnum():
                end -= 1
            for m in _TOKEN.finditer(text, begin, end):
                word = m[0]
                kind = _kind_of(word)
                words.append(word)
                kinds.append(kind)
                if kind == BLANK:
                    addressed.append(_joined(text, m.start(), m.end(), begin, end))
                else:
                    addressed.append(kind < SIGN or word in _ADDRESS_SIGNS)
                self.bounds.append(m.span())
                self.window.append(w)
            words.append("")
            kinds.append(BAR)
            addressed.append(False)
            self.bounds.append((end, end))
            self.window.append(w)
        lower = [w.lower() for w in words]
        self.kinds = kind = np.array(kinds, np.int64)
        self.label = (kind == DIGITS) | (kind == LETTERS) | (kind == MIXED)
        digit = kind == DIGITS
        sizes = np.array([len(w) for w in words], np.int64)
        dots = np.array([w in (".", "dot") for w in lower], bool)
        ats = np.array([w in ("@", "at") for w in lower], bool)
        number = digit | (kind == BLANK) | np.isin(kind, [SIGN + ord(c) for c in _NUMBER_SIGNS])
        small = np.array([k == DIGITS and len(w) <= 3 and int(w) <= 255 for k, w in zip(kinds, words, strict=True)], bool)
        # What an address is written out to be: labels as they are, a character for at and dot.
        plain = np.where(ats | dots, 1, np.where(self.label | np.isin(kind, [SIGN + ord(c) for c in "._%+-"]), sizes, 0))
        self.n_digits, self.n_groups = _sums(np.where(digit, sizes, 0)), _sums(digit)
        self.n_letters, self.n_labels = _sums(self.label & ~digit), _sums(self.label)
        self.n_dots, self.n_ats, self.n_small, self.n_plain = map(_sums, (dots, ats, small, plain))
        self.not_address, self.not_number, self.bars = map(_sums, (~np.array(addressed, bool), ~number, kind == BAR))
        n = len(kinds)
        at_places = np.append(np.flatnonzero(ats), n)
        self.next_at = at_places[np.searchsorted(at_places, np.arange(n))]
        marks = kind.astype(np.uint64)
        self.powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _STEP, np.uint64)]))
        self.back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _BACK, np.uint64)]))
        shape = np.where(digit, sizes.astype(np.uint64) + np.uint64(1 << 40), marks)
        self.shapes = np.concatenate([[np.uint64(0)], np.cumsum(shape * self.powers[:-1], dtype=np.uint64)])
        self.plains = np.concatenate([[np.uint64(0)], np.cumsum(marks * self.powers[:-1], dtype=np.uint64)])
        figures = np.array([int(c) for k, w in zip(kinds, words, strict=True) if k == DIGITS for c in w], np.int64)
        twice = 2 * figures - 9 * (figures > 4)
        even = np.arange(len(figures)) % 2 == 0
        self.even, self.odd = _sums(np.where(even, figures, twice)), _sums(np.where(even, twice, figures))
        self.signs = {int(k): _sums(kind == k) for k in np.unique(kind[(kind == BLANK) | (kind >= SIGN)])}

        def hashes(texts) -> np.ndarray:
            return np.array([zlib.crc32(x.encode()) for x in texts], np.uint64)

        self.first = np.where(digit | (kind == MIXED), marks, hashes(lower) + np.uint64(1 << 33))
        self.ending = hashes(x[-6:] for x in lower)
        self.opening = hashes(x[:6] for x in lower)

    def __len__(self) -> int:
        return len(self.kinds)

    def segments(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """(begin, end) of the segments that may be an entity and begin from `first` to before `last`.

        Of up to MAX_TOKENS tokens, what has 7 to 24 digits or four groups of them, or an at and a dot.
        Beyond that, numbers of up to 24 digits, and what may be an address of up to ADDRESS characters
        with up to LOCAL before the at.
        """
        n = len(self)
        start = np.arange(first, last)
        start = start[self.label[start] | np.isin(self.kinds[start], [SIGN + ord("+"), SIGN + ord("(")])]
        near = self.next_at[start]
        local = self.n_plain[near] - self.n_plain[start] <= LOCAL
        begins, ends = [], []
        for d in range(MOST_TOKENS):
            stop = start + d + 1
            inside = stop <= n
            inside[inside] &= self.bars[stop[inside]] == self.bars[start[inside]]
            start, stop, local = start[inside], stop[inside], local[inside]
            digits = self.n_digits[stop] - self.n_digits[start]
            ats, dots = self.n_ats[stop] - self.n_ats[start], self.n_dots[stop] - self.n_dots[start]
            numbers = ((digits >= 7) & (digits <= 24)) | (self.n_groups[stop] - self.n_groups[start] == 4)
            names = (ats > 0) & (dots > 0)
            if d >= MAX_TOKENS:
                number = (self.not_number[stop] == self.not_number[start]) & (digits <= 24)
                plain = self.n_plain[stop] - self.n_plain[start]
                address = (self.not_address[stop] == self.not_address[start]) & (ats <= MOST_ATS) & (plain <= ADDRESS) & local
                going = (number | address) & (self.n_labels[stop] > self.n_labels[start])
                numbers, names = numbers & number & going, names & address & going
            found = self.label[stop - 1] & (numbers | names)
            begins.append(start[found])
            ends.append(stop[found])
            if d >= MAX_TOKENS:
                start, local = start[going], local[going]
            if not len(start):
                break
        begin, end = np.concatenate([np.zeros(0, np.int64), *begins]), np.concatenate([np.zeros(0, np.int64), *ends])
        order = np.lexsort((begin, end))
        return begin[order], end[order]

    def features(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of the features of each segment: what is in the whole span, and what is around it."""

        def inside(sums: np.ndarray) -> np.ndarray:
            return sums[end] - sums[begin]

        def rolled(sums: np.ndarray, most: int) -> np.ndarray:
            near = np.minimum(end, begin + most)
            return (sums[near] - sums[begin]) * self.back[begin] + (near - begin).astype(np.uint64)

        n = len(self)
        digits, groups, ats = inside(self.n_digits), inside(self.n_groups), inside(self.n_ats)
        letters = (inside(self.n_letters) > 0).astype(np.uint64)
        signs = np.zeros(len(begin), np.uint64)
        for kind, sums in self.signs.items():
            mark = np.uint64((int(_STEP) * (2 * kind + 1)) % (1 << 64))
            signs ^= np.where(inside(sums) > 0, mark, np.uint64(0))
        low, high = self.n_digits[begin], self.n_digits[end]
        total = np.where(high % 2 == 1, self.even[high] - self.even[low], self.odd[high] - self.odd[low])
        check = ((digits >= 12) & (total % 10 == 0)).astype(np.uint64)
        octets = ((groups == 4) & (inside(self.n_small) == 4)).astype(np.uint64)

        def kind_at(place: np.ndarray) -> np.ndarray:
            """The kind of the token there; a window ends at its bars."""
            return np.where((place >= 0) & (place < n), self.kinds[np.clip(place, 0, n - 1)], BAR).astype(np.uint64)

        before, after = kind_at(begin - 1), kind_at(end)
        two_before = np.where(before == BAR, np.uint64(BAR), kind_at(begin - 2) * np.uint64(1 << 24) + before)
        two_after = np.where(after == BAR, np.uint64(BAR), kind_at(end + 1) * np.uint64(1 << 24) + after)
        named = ats > 0
        opening = np.where((after != BAR) & named, self.opening[np.minimum(end + 1, n - 1)], np.uint64(0))
        values = (
            np.zeros(len(begin), np.uint64),
            rolled(self.shapes, 24),
            rolled(self.plains, 24),
            signs * np.uint64(2) + letters,
            np.minimum(digits, 20).astype(np.uint64) * np.uint64(2) + letters,
            np.minimum(groups, 6).astype(np.uint64) * np.uint64(2) + letters,
            check * np.uint64(2) + letters,
            octets * np.uint64(2) + letters,
            (np.minimum(ats, 2) * 8 + np.minimum(inside(self.n_dots), 4)).astype(np.uint64),
            (kind_at(begin) * np.uint64(1 << 24) + kind_at(end - 1)) * np.uint64(2) + named.astype(np.uint64),
            self.first[begin],
            before * np.uint64(2) + letters,
            after * np.uint64(2) + letters,
            two_before * np.uint64(2) + letters,
            two_after * np.uint64(2) + letters,
            np.where(named, self.ending[end - 1], np.uint64(0)),
            opening,
        )
        out = np.empty((len(begin), len(values)), np.int32)
        for i, value in enumerate(values):
            out[:, i] = mixed(value * np.uint64(64) + np.uint64(i + 1)) % np.uint64(FEATURES)
        return out


@dataclass
class Window:
    """Tokens of a window and its candidate segments with their features."""

    bounds: list[tuple[int, int]]
    segments: list[tuple[int, int]]
    features: np.ndarray


def read_window(text: str, begin: int, end: int) -> Window:
    """Split a range into tokens and list the segments that may be an entity: for training and tests."""
    tokens = Tokens([(text, begin, end)])
    first, last = tokens.segments(0, len(tokens))
    return Window(tokens.bounds[:-1], list(zip(first.tolist(), last.tolist(), strict=True)), tokens.features(first, last))


def _logsum(x: np.ndarray, axis: int = 0) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis=axis)


@dataclass
class Field:
    """Weights of features by kind (0 is no entity, which has none), and of what follows what."""

    weights: np.ndarray
    follows: np.ndarray

    def weigh(self, features: np.ndarray) -> np.ndarray:
        """A score by kind for each row of feature numbers."""
        out = np.zeros((len(features), len(KINDS)))
        table = np.ascontiguousarray(self.weights.T)
        for column in features.T:
            out += table[column]
        return out

    def scores(self, window: Window) -> np.ndarray:
        return self.weigh(window.features)

    def best(self, tokens: Tokens) -> list[tuple[int, int, int]]:
        """The best segmentation's entities: first token, kind (from 0), end token.

        Segments are made for a block of starts at a time and go into the program at their ends, in order;
        of a block, those that end behind it are kept. What grows with the text is a few numbers a token.
        """
        n, labels = len(tokens), len(KINDS) + 1
        value = np.full((n + 1, labels), -np.inf)
        value[0, 0] = 0.0
        # The best way into a segment of each kind from a place, and the label before it.
        into, prior = np.full((n + 1, labels - 1), -np.inf), np.zeros((n + 1, labels - 1), np.int8)
        back = np.full((n + 1, labels), -1, np.int64)
        label_before = np.zeros((n + 1, labels), np.int8)
        stay, enter = self.follows[:, 0], self.follows[:, 1:]
        into[0], prior[0] = (value[0][:, None] + enter).max(axis=0), (value[0][:, None] + enter).argmax(axis=0)
        bar_ends = np.flatnonzero(tokens.kinds == BAR) + 1
        begin, end = np.zeros(0, np.int64), np.zeros(0, np.int64)
        scores = np.zeros((0, labels - 1))

        def step(t: int) -> None:
            """From t - 1 to t without an entity."""
            ways = value[t - 1] + stay
            p = int(ways.argmax())
            value[t, 0], back[t, 0], label_before[t, 0] = ways[p], t - 1, p

        def fill(a: int, b: int) -> None:
            """Places from a + 1 to b, where nothing ends."""
            if a >= b:
                return
            step(a + 1)
            if b > a + 1:
                value[a + 2 : b + 1, 0] = value[a + 1, 0] + stay[0] * np.arange(1, b - a)
                back[a + 2 : b + 1, 0] = np.arange(a + 1, b)
            ways = value[a + 1 : b + 1, :1] + enter[0]
            into[a + 1 : b + 1] = ways  # label 0 is the only one there

        for low in range(0, n, BLOCK):
            high = min(low + BLOCK, n)
            b, e = tokens.segments(low, high)
            if len(b):
                new = self.weigh(tokens.features(b, e))
                begin, end, scores = np.concatenate([begin, b]), np.concatenate([end, e]), np.concatenate([scores, new])
                order = np.lexsort((begin, end))
                begin, end, scores = begin[order], end[order], scores[order]
            ready = int(np.searchsorted(end, high, "right"))
            bars = bar_ends[(bar_ends > low) & (bar_ends <= high)]
            events = np.union1d(end[:ready], bars)
            cuts = np.searchsorted(end[:ready], events)
            cuts = np.append(cuts, ready).tolist()
            ends_window = np.isin(events, bars).tolist()
            at = low
            for k, t in enumerate(events.tolist()):
                fill(at, t - 1)
                if ends_window[k]:
                    p = int(value[t - 1].argmax())
                    value[t, 0], back[t, 0], label_before[t, 0] = 0.0, t - 1, p
                    into[t], prior[t] = enter[0], 0
                    at = t
                    continue
                step(t)
                own = slice(cuts[k], cuts[k + 1])
                ways = into[begin[own]] + scores[own]
                which = ways.argmax(axis=0)
                value[t, 1:] = ways[which, np.arange(labels - 1)]
                back[t, 1:] = begin[own][which]
                label_before[t, 1:] = prior[back[t, 1:], np.arange(labels - 1)]
                ways = value[t][:, None] + enter
                prior[t] = ways.argmax(axis=0)
                into[t] = ways[prior[t], np.arange(labels - 1)]
                at = t
            fill(at, high)
            begin, end, scores = begin[ready:], end[ready:], scores[ready:]
        out, t, label = [], n, 0
        while t > 0:
            i, p = int(back[t, label]), int(label_before[t, label])
            if label:
                out.append((i, label - 1, t))
            t, label = i, p
        return out[::-1]

    def gradient(self, window: Window, truth: dict[tuple[int, int], int]) -> tuple[np.ndarray, np.ndarray]:
        """Of the log-likelihood: by segment and kind, and by what follows what."""
        n, labels = len(window.bounds), len(KINDS) + 1
        scores = self.scores(window)
        ahead, behind = np.full((n + 1, labels), -np.inf), np.full((n + 1, labels), -np.inf)
        ahead[0, 0] = 0.0
        ending: dict[int, list[int]] = {}
        starting: dict[int, list[int]] = {}
        for s, (i, j) in enumerate(window.segments):
            ending.setdefault(j, []).append(s)
            starting.setdefault(i, []).append(s)
        into = np.full((n + 1, labels), -np.inf)  # before a segment of a kind
        for t in range(n + 1):
            if t:
                ahead[t, 0] = into[t - 1, 0]
                own = ending.get(t)
                if own:
                    ahead[t, 1:] = _logsum(np.stack([into[window.segments[s][0], 1:] + scores[s] for s in own]))
            into[t] = _logsum(ahead[t][:, None] + self.follows)
        behind[n] = 0.0
        out_of = np.full((n + 1, labels), -np.inf)  # a segment of a kind begins here
        for t in range(n - 1, -1, -1):
            out_of[t, 0] = behind[t + 1, 0]
            own = starting.get(t)
            if own:
                out_of[t, 1:] = _logsum(np.stack([behind[window.segments[s][1], 1:] + scores[s] for s in own]))
            behind[t] = _logsum(self.follows + out_of[t][None, :], axis=1)
        total = _logsum(ahead[n])
        by_segment = np.zeros((len(window.segments), len(KINDS)))
        for s, (i, j) in enumerate(window.segments):
            by_segment[s] = -np.exp(np.minimum(into[i, 1:] + scores[s] + behind[j, 1:] - total, 0.0))
            if (i, j) in truth:
                by_segment[s, truth[i, j]] += 1.0
        by_pair = np.zeros((labels, labels))
        for t in range(n):
            by_pair -= np.exp(np.minimum(ahead[t][:, None] + self.follows + out_of[t][None, :] - total, 0.0))
        t, label = 0, 0
        begins = {i: (j, k + 1) for (i, j), k in truth.items()}
        while t < n:
            t, now = begins.get(t, (t + 1, 0))
            by_pair[label, now] += 1.0
            label = now
        return by_segment, by_pair


def rewritten(kind: int, text: str, choice: random.Random) -> str:
    """A span's text in a way of writing that the rules do not know."""
    if kind == 0:
        local, host = text.rsplit("@", 1)
        at, dot = choice.choice(((" at ", " dot "), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", ".")))
        return local + at + host.replace(".", dot)
    if kind == 1:
        return text.replace(".", choice.choice(("[.]", "(.)", " . ")))
    if kind == 2:
        digits = re.sub("[^0-9]", "", text)
        return choice.choice((".", "/", "_", " . ")).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    digits = re.sub("[^0-9]", "", text)[-10:]
    a, b, c = digits[:-7], digits[-7:-4], digits[-4:]
    return choice.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}) {b} {c}"))


def lessons(text: str, choice: random.Random) -> list[tuple[str, list[Span]]]:
    """Short texts with their entities: the rules' spans as they are and rewritten, and other numbers."""
    spans, out = base_spans(text), []
    for i, (begin, kind, end) in enumerate(spans):
        if any(b < end and begin < e for j, (b, _, e) in enumerate(spans) if j != i):
            continue
        left = text[max(begin - 2 * MARGIN, spans[i - 1][2] if i else 0) : begin]
        right = text[end : min(end + 2 * MARGIN, spans[i + 1][0] if i + 1 < len(spans) else len(text))]
        for body in (text[begin:end], rewritten(kind, text[begin:end], choice)):
            out.append((left + body + right, [(len(left), kind, len(left) + len(body))]))
        words = re.findall(r"[^\W\d_]+", left + right)
        if kind == 0 and words:  # the text's own words with at and dot are no address
            a, b, c = (choice.choice(words) for _ in range(3))
            at, dot = choice.choice(((" at ", " dot "), ("@", "."), (" at ", ". "), (" at ", ".")))
            out.append((f"{left}{a}{at}{b}{dot}{c}{right}" if at != "@" else f"{left}{a} @ {b} {c}{right}", []))
    for begin, end in windows_of(text, spans):
        if end - begin <= LESSON:  # a lesson on what is no entity; longer windows teach nothing else
            out.append((text[begin:end], []))
    return out


def learn(examples: list[tuple[str, list[Span]]]) -> Field:
    """Maximum likelihood by adaptive gradient steps."""
    labels = len(KINDS) + 1
    field = Field(np.zeros((len(KINDS), FEATURES)), np.zeros((labels, labels)))
    ready = []
    for text, spans in examples:
        window = read_window(text, 0, len(text))
        if not window.segments:
            continue
        starts = {a: i for i, (a, _) in enumerate(window.bounds)}
        ends = {b: i + 1 for i, (_, b) in enumerate(window.bounds)}
        truth = {(starts[b], ends[e]): k for b, k, e in spans if b in starts and e in ends}
        if len(truth) == len(spans) and truth.keys() <= set(window.segments):
            ready.append((window, truth))
    if not any(truth for _, truth in ready):
        field.follows[:, 1:] = -1e3  # nothing to learn from: no entities
        return field
    order = np.random.default_rng(3)
    seen, seen_pairs = np.full_like(field.weights, 1e-2), np.full_like(field.follows, 1e-2)
    for _ in range(ROUNDS):
        for i in order.permutation(len(ready)):
            window, truth = ready[i]
            by_segment, by_pair = field.gradient(window, truth)
            step = np.zeros_like(field.weights)
            for kind, own in enumerate(by_segment.T):
                np.add.at(step[kind], window.features, own[:, None])
            seen += step * step
            seen_pairs += by_pair * by_pair
            field.weights += 0.3 * step / np.sqrt(seen)
            field.follows += 0.3 * by_pair / np.sqrt(seen_pairs)
    return field


def train(docs: DataFrame) -> Field:
    """A field trained on windows of all documents' texts, of each kind the first by hash."""
    share = MOST_WINDOWS // (len(KINDS) + 1)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The first of a kind over all tasks are among the first of their task.
        first: dict[int, set[tuple]] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for body, spans in lessons(text, random.Random(zlib.crc32(text.encode()))):
                    kept = first.setdefault(spans[0][1] if spans else -1, set())
                    kept.add((zlib.crc32(body.encode()), body, tuple(x for s in spans for x in s)))
                    if len(kept) > 4 * share:
                        kept.difference_update(sorted(kept)[share:])
        rows = [row for kept in first.values() for row in sorted(kept)[:share]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[1] for r in rows], pa.string()),
                pa.array([list(r[2]) for r in rows], pa.list_(pa.int32())),
                pa.array([r[0] for r in rows], pa.int64()),
            ],
            names=["body", "spans", "nth"],
        )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            for body, flat in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                examples.append((body, [tuple(flat[i : i + 3]) for i in range(0, len(flat), 3)]))
        field = learn(sorted(examples, key=repr))
        yield pa.RecordBatch.from_arrays(
            [pa.array([field.weights.astype(np.float32).tobytes()], pa.binary()), pa.array([field.follows.tobytes()], pa.binary())],
            names=["weights", "follows"],
        )

    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    found = settle(texts.mapInArrow(collect, "body string, spans array<int>, nth bigint"), "lessons").distinct()
    # As many windows of each kind of truth as the bound allows, by hash.
    kind = F.coalesce(F.get("spans", F.lit(1)), F.lit(-1))
    found = found.withColumn("kind", kind)
    parts = [found.filter(F.col("kind") == k).orderBy("nth", "body", "spans").limit(share) for k in range(-1, len(KINDS))]
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.union(part)
    row = chosen.select("body", "spans").repartition(1).mapInArrow(fit, "weights binary, follows binary").first()
    if row is None:
        return learn([])
    weights = np.frombuffer(row["weights"], np.float32).astype(np.float64).reshape(len(KINDS), FEATURES)
    follows = np.frombuffer(row["follows"], np.float64).reshape(len(KINDS) + 1, -1)
    return Field(weights, follows)


#: Tokens of windows that go through the program together.
TOGETHER = 20_000


def added_spans_of(texts: list[str], spans: list[list[Span]], field: Field) -> list[list[Span]]:
    """What the field finds outside the rules' spans of some texts; windows are worked off many at a time."""
    out: list[list[Span]] = [[] for _ in texts]
    windows: list[tuple[str, int, int]] = []
    owner: list[int] = []

    def work() -> None:
        if windows:
            tokens = Tokens(windows)
            for i, kind, j in field.best(tokens):
                out[owner[tokens.window[i]]].append((tokens.bounds[i][0], kind, tokens.bounds[j - 1][1]))
        windows.clear()
        owner.clear()

    size = 0
    for k, (text, own) in enumerate(zip(texts, spans, strict=True)):
        for begin, end in windows_of(text, own):
            windows.append((text, begin, end))
            owner.append(k)
            size += end - begin
            if size > 2 * TOGETHER:
                work()
                size = 0
    work()
    return out


def added_spans(text: str, spans: list[Span], field: Field) -> list[Span]:
    """What the field finds outside the rules' spans."""
    return added_spans_of([text], [spans], field)[0]


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (of the rules), base_sha256, spans, n_added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, names, alls, added = [], [], [], []
            texts = batch.column(1).to_pylist()
            bases = [base_spans(text) for text in texts]
            for base, more in zip(bases, added_spans_of(texts, bases, field), strict=True):
                counts.append([sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))])
                names.append(hashlib.sha256(written(base).encode()).hexdigest())
                alls.append(written(base + more))
                added.append(len(more))
            table = np.array(counts, np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c) for c in table.T], pa.array(names), pa.array(alls), pa.array(added, pa.int64())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"],
            )

    schema = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, schema)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span (joined where they overlap) replaced by the name of its kind."""
    out, at = [], 0
    for begin, kind, end in sorted(spans):
        if begin >= at:
            out += [text[at:begin], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, field: Field) -> DataFrame:
    """`docs` with all columns, texts masked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            given = batch.column(place).to_pylist()
            own = [text or "" for text in given]
            bases = [base_spans(text) for text in own]
            more = added_spans_of(own, bases, field)
            texts = [text and masked(text, a + b) for text, a, b in zip(given, bases, more, strict=True)]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)
