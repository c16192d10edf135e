"""Names looked up at every place of texts by hashes (D-16): vectorised over UTF-8 bytes, exact, about 90 bytes a name of 13.

Hashes of 1, 2, 4, ... 64 bytes at each place come from one another. A name of n bytes is of the class of the greatest such length g
that it has; its head of g bytes says whether a place is looked at for the class, head and tail of g bytes together are its
key among the names of n bytes, and its bytes are compared at last. UTF-8 keeps the order of code points, and a place
where a whole name's bytes lie begins a character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of text that a step looks at (temporaries are about 80 times that); the longest head is of 2 ** CLASSES - 1 bytes; bytes of a text's
#: beginning that are looked at first for the first name.
STEP_BYTES, CLASSES, BEGINNING = 1 << 19, 7, 128
NONE = np.iinfo(np.int64).max
_RANDOM = np.random.default_rng(16)
_BYTES, _ODD = _RANDOM.integers(0, 1 << 64, 256, np.uint64), _RANDOM.integers(0, 1 << 64, CLASSES + 1, np.uint64) | np.uint64(1)


def hashes(raw: np.ndarray, classes: int) -> list[np.ndarray]:
    """By class k: the hash of the 2 ** k bytes from each place on, where there are so many."""
    out = [_BYTES[raw]]
    for k in range(1, classes):
        g = 1 << (k - 1)
        h = out[-1][:-g] * _ODD[k]
        h += out[-1][g:]
        h ^= h >> np.uint64(29)
        out.append(h)
    return out


def keys(h: np.ndarray, at: np.ndarray, far: np.ndarray | int) -> np.ndarray:
    """Of heads at `at` and tails `far` behind them."""
    q = h[at] * _ODD[0]
    q += h[at + far]
    return q


class Seen:
    """Which hashes may be among the given: two tables by bits of theirs, each of 4 to 8 times as many bytes as hashes."""

    def __init__(self, of: np.ndarray):
        bits = max(8, int(of.size * 4 - 1).bit_length())
        self.bits, self.shift = np.uint64(bits), np.uint64(64 - bits)
        self.first, self.second = np.zeros(1 << bits, bool), np.zeros(1 << bits, bool)
        self.first[self.places(of)] = True
        self.second[self.places(of << self.bits)] = True

    def places(self, h: np.ndarray) -> np.ndarray:
        return (h >> self.shift).view(np.int64)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """Where in h."""
        at = np.flatnonzero(self.first[self.places(h)])
        return at[self.second[self.places(h[at] << self.bits)]]


class NameIndex:
    """Names joined by NUL, in the order of their rank: more characters first, then by code points."""

    def __init__(self, names: bytes):
        self.blob = np.frombuffer(names, np.uint8)
        ends = np.append(np.flatnonzero(self.blob == 0), self.blob.size)
        self.start = np.append(0, ends[:-1] + 1)
        size = ends - self.start
        self.longest, n = int(size.max()), size.size
        # the class: one less than the bits of the length
        kind = np.minimum(np.frexp(size)[1] - 1, CLASSES - 1).astype(np.int8)
        self.chars, key, head = np.empty(n, np.int32), np.empty(n, np.uint64), np.empty(n, np.uint64)
        lo = 0
        while lo < n:  # a few names at a time
            hi = max(lo + 1, int(np.searchsorted(ends, self.start[lo] + STEP_BYTES)))
            raw, at = self.blob[self.start[lo] : ends[hi - 1]], self.start[lo:hi] - self.start[lo]
            self.chars[lo:hi] = np.add.reduceat(((raw & 0xC0) != 0x80) & (raw != 0), at, dtype=np.int32)
            for k, h in enumerate(hashes(raw, int(kind[lo:hi].max()) + 1)):
                own = np.flatnonzero(kind[lo:hi] == k)
                head[lo + own] = h[at[own]]
                key[lo + own] = keys(h, at[own], size[lo + own] - (1 << k))
            lo = hi
        order = np.lexsort((key, size)).astype(np.int32)
        lengths = {}  # by class: (length, keys seen, keys in order, their names, most names of a key), longest last
        for own in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
            held = key[own]
            most = int(np.diff(np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1], [True]]))).max())
            lengths.setdefault(int(kind[own[0]]), []).append((int(size[own[0]]), Seen(held), held, own, most))
        self.classes = [(k, Seen(np.unique(head[kind == k])), of) for k, of in lengths.items()]

    def name(self, rank: int) -> str:
        end = self.start[rank + 1] - 1 if rank + 1 < self.start.size else self.blob.size
        return self.blob[self.start[rank] : end].tobytes().decode()

    def hits(self, raw: np.ndarray, at: np.ndarray, q: np.ndarray, length: int, held: np.ndarray, own: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of `at` where a name of the length lies, and its rank. q: their keys."""
        found, first = [(at[:0], own[:0])], np.searchsorted(held, q)
        for more in range(most):
            j = np.minimum(first + more, held.size - 1)
            like = np.flatnonzero(held[j] == q)
            places, names = at[like], own[j[like]]
            some = max(1, STEP_BYTES // length)
            for lo in range(0, like.size, some):
                p, r, along = places[lo : lo + some], names[lo : lo + some], np.arange(length)
                same = (raw[p[:, None] + along] == self.blob[self.start[r][:, None] + along]).all(1)
                found.append((p[same], r[same]))
        return np.concatenate([p for p, _ in found]), np.concatenate([r for _, r in found])


class Texts:
    """A batch's texts, their best names so far, and the lookups in one index after another, those of longer names first."""

    def __init__(self, texts: pa.Array, longest: bool):
        texts = texts.fill_null("").cast(pa.large_binary())
        _, places, raw = texts.buffers()
        self.at = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.raw = np.frombuffer(raw, np.uint8) if raw and raw.size else np.empty(0, np.uint8)
        self.by_length, n = longest, len(texts)
        self.score, self.chars = np.full(n, NONE), np.zeros(n, np.int64)  # lower is better; the best name's characters
        self.start, self.found = np.full(n, NONE), np.full(n, None, object)  # where the best name begins, in bytes of `raw`

    def look_up(self, index: NameIndex, before: int) -> None:
        """before: how many names are in the indexes before this one."""
        if self.by_length:
            self.steps(index, before, self.at[:-1], self.at[1:])
        else:
            mid = np.minimum(self.at[:-1] + BEGINNING, self.at[1:])
            self.steps(index, before, self.at[:-1], mid)
            self.steps(index, before, mid, self.at[1:])

    def steps(self, index: NameIndex, before: int, lo: np.ndarray, hi: np.ndarray) -> None:
        """Looks at the places lo to hi of each text, unless what it has is better than all that could be found."""
        held, size = [], 0
        for i in np.flatnonzero((hi > lo) & ((self.chars <= index.longest) if self.by_length else (self.start >= lo))).tolist():
            for a in range(int(lo[i]), int(hi[i]), STEP_BYTES):
                b = min(int(hi[i]), a + STEP_BYTES)
                piece = i, a, min(b + index.longest - 1, int(self.at[i + 1]))  # a name may begin before b and go on
                held.append(piece)
                size += piece[2] - a
                if size >= STEP_BYTES:
                    self.step(index, before, held)
                    held, size = [], 0
        if held:
            self.step(index, before, held)

    def step(self, index: NameIndex, before: int, held: list[tuple[int, int, int]]) -> None:
        text, begin, end = np.array(held).T
        size, more = end - begin, min(index.longest, 1 << CLASSES)  # zeros behind, so that most tails need no look at where texts end
        raw = np.concatenate([*(self.raw[a:b] for _, a, b in held), np.zeros(more, np.uint8)])
        ends = np.cumsum(size)
        piece = np.repeat(np.arange(len(held), dtype=np.int32), size)
        shift = end - ends  # from a place here to one in self.raw
        h = hashes(raw, index.classes[-1][0] + 1)
        for k, heads, lengths in reversed(index.classes) if self.by_length else index.classes:
            open_ = self.chars[text] <= lengths[-1][0] if self.by_length else size > 0
            if np.dot(open_, size) < 0.7 * piece.size:
                at = np.flatnonzero(open_[piece])
                at = at[heads(h[k][at])]
            else:
                at = heads(h[k][: piece.size])
            own, fresh = piece[at], True
            for length, seen, *of in reversed(lengths) if self.by_length else lengths:
                if fresh:  # else no text has a better name than before
                    on = (self.chars[text] <= length)[own] if self.by_length else at + shift[own] <= self.start[text][own]
                    at, own = at[on], own[on]
                if not at.size:
                    break
                here = at if length <= more else at[ends[own] - at >= length]
                q = keys(h[k], here, length - (1 << k))
                like = seen(q)
                here, q = here[like], q[like]
                on = ends[piece[here]] - here >= length
                fresh = on.any() and self.take(index, before, text, piece, shift, *index.hits(raw, here[on], q[on], length, *of))

    def take(self, index: NameIndex, before: int, text: np.ndarray, piece: np.ndarray, shift: np.ndarray, at: np.ndarray, rank: np.ndarray) -> bool:
        """The better of what was found and what the texts have; whether any was better."""
        own, start = text[piece[at]], at + shift[piece[at]]
        score = rank + np.int64(before) if self.by_length else start
        better = score < self.score[own] if self.by_length else (score < self.score[own]) | ((score == self.score[own]) & (index.chars[rank] > self.chars[own]))
        own, start, score, rank = own[better], start[better], score[better], rank[better]
        order = np.lexsort((score, own))
        for j in order[np.append(True, np.diff(own[order]) != 0)[: order.size]].tolist():
            i = own[j]
            self.score[i], self.start[i], self.chars[i], self.found[i] = score[j], start[j], index.chars[rank[j]], index.name(int(rank[j]))
        return order.size > 0


_INDEX: dict = {}


def index_of(token: tuple, names: bytes) -> NameIndex:
    """The worker's last index."""
    if token not in _INDEX:
        _INDEX.clear()  # before the next one, not beside it
        _INDEX[token] = NameIndex(names)
    return _INDEX[token]
