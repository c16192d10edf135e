"""Elias-Fano sequences over numpy memory maps, searched many values at a time, and files of named arrays."""

from __future__ import annotations

import json
import uuid

import numpy as np
import pandas as pd

#: Buckets (or ones) between two entries of a directory.
EVERY = 8


def _kth() -> np.ndarray:
    """How many of 16 bits go up to their k-th one, k first; 255 where there are fewer ones."""
    out, y = np.zeros((EVERY + 1, 1 << 16), np.uint8), np.arange(1 << 16)
    for k in range(1, EVERY + 1):
        out[k] = np.where(y, np.bitwise_count((y & -y) - 1) + 1, 255)
        y &= y - 1
    return out.ravel()


KTH, LOW = _kth(), np.uint64(0xFFFF)


def _window(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64 bits from bit `at` on."""
    w, s = at >> 6, (at & 63).astype(np.uint64)
    return (words[w] >> s) | ((words[w + 1] << np.uint64(1)) << (np.uint64(63) - s))


def _after(words: np.ndarray, at: np.ndarray, k: np.ndarray, ones: bool) -> np.ndarray:
    """The bit behind the k-th zero (or one) from `at` on, k up to EVERY; `at` itself where k is 0."""
    x = _window(words, at)
    x = x if ones else ~x
    low = (x & LOW).astype(np.int64)
    step = KTH[(k << 16) | low]
    out = at + step
    left = np.flatnonzero(step == 255)
    if not len(left):
        return out
    x, at, k = x[left], at[left], k[left] - np.bitwise_count(low[left])  # the next 16 bits
    step = KTH[(k << 16) | ((x >> np.uint64(16)) & LOW).astype(np.int64)]
    out[left] = at + 16 + step
    if len(far := np.flatnonzero(step == 255)):
        out[left[far]] = _further(words, at[far] + 16, k[far], ones)
    return out


def _further(words: np.ndarray, at: np.ndarray, k: np.ndarray, ones: bool) -> np.ndarray:
    """As _after, for k from 1 on: 2 words at a time, then 64, since behind a frequent context a gap has thousands of bits."""
    out, left, lanes = at.copy(), np.arange(len(at)), 2
    while len(left):
        w = at >> 6
        x = words[np.minimum(w[:, None] + np.arange(lanes), len(words) - 1)]
        x = x if ones else ~x
        x[:, 0] &= ~np.uint64(0) << (at & 63).astype(np.uint64)
        up = np.cumsum(np.bitwise_count(x), axis=1, dtype=np.int64)
        done = up[:, -1] >= k
        i = np.flatnonzero(done)
        lane = np.argmax(up[i] >= k[i, None], axis=1)
        y, c = x[i, lane], k[i] - np.where(lane > 0, up[i, lane - 1], 0)
        for n in range(1, int(c.max(initial=0))):
            y = np.where(c > n, y & (y - np.uint64(1)), y)
        out[left[i]] = ((w[i] + lane) << 6) + np.bitwise_count((y & (~y + np.uint64(1))) - np.uint64(1)) + 1
        i = np.flatnonzero(~done)
        left, k, at, lanes = left[i], k[i] - up[i, -1], (w[i] + lanes) << 6, 64
    return out


def encode(values: np.ndarray, universe: int, name: str, least_low: int = 0) -> dict[str, np.ndarray]:
    """Arrays for sorted `values` below `universe`."""
    low = max(least_low, min(56, (universe // max(1, len(values))).bit_length() - 1))
    values = values.astype(np.uint64)
    return _encode((values >> np.uint64(low)).astype(np.int64), values, (universe >> low) + 1, low, name)


def _encode(high: np.ndarray, values: np.ndarray, buckets: int, low: int, name: str, by_place: bool = True) -> dict[str, np.ndarray]:
    """Unary high parts, the packed `low` bits of the values, a directory of zeros and, for `get`, one of ones."""
    n = len(high)
    bits = np.zeros(((n + buckets) // 64 + 4) * 64, np.uint8)
    for a in range(0, n, 1 << 18):
        bits[high[a : a + (1 << 18)] + np.arange(a, min(n, a + (1 << 18)))] = 1
    packed = [np.zeros(0, np.uint8)]
    for a in range(0, n, 1 << 16):
        part = values[a : a + (1 << 16)]
        packed.append(np.packbits(((part[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little"))
    lows = np.concatenate(packed)
    lows = np.concatenate([lows, np.zeros(24 - len(lows) % 8, np.uint8)])
    return {
        f"{name}.meta": np.array([n, low], np.int64), f"{name}.high": np.packbits(bits, bitorder="little").view(np.uint64), f"{name}.low": lows.view(np.uint64),
        f"{name}.zeros": np.searchsorted(high, np.arange(0, buckets + EVERY, EVERY)).astype(np.uint32),
    } | ({f"{name}.ones": high[::EVERY].astype(np.uint32 if buckets < 1 << 32 else np.uint64)} if by_place else {})


class Sequence:
    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.n, self.bits = (int(x) for x in arrays[f"{name}.meta"])
        self.high, self.low, self.zeros, self.ones = (arrays.get(f"{name}.{x}") for x in ("high", "low", "zeros", "ones"))
        self.mask = np.uint64((1 << self.bits) - 1)

    def _low(self, i: np.ndarray) -> np.ndarray:
        return _window(self.low, i * self.bits) & self.mask

    def get(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at positions `i` and those behind them."""
        block = i // EVERY
        at = self.ones[block].astype(np.int64) + block * EVERY
        at = _after(self.high, at, i % EVERY + 1, True)
        behind = _after(self.high, at, np.ones(len(i), np.int64), True)
        shift = np.uint64(self.bits)
        return ((at - 1 - i).astype(np.uint64) << shift) | self._low(i), ((behind - 2 - i).astype(np.uint64) << shift) | self._low(i + 1)

    def find(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the position of each v, whether it is there) in a sequence without equal values; 0 where it isn't."""
        return self.in_bucket((v >> np.uint64(self.bits)).astype(np.int64), v & self.mask)

    def in_bucket(self, h: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        block = h // EVERY
        start = _after(self.high, self.zeros[block].astype(np.int64) + block * EVERY, h % EVERY, False)
        x = ~_window(self.high, start)
        many = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.int64)  # ones from there on: the bucket's elements
        if len(i := np.flatnonzero(many == 64)):
            many[i] = _after(self.high, start[i], np.ones(len(i), np.int64), False) - 1 - start[i]
        each = np.repeat(np.arange(len(h)), many)
        at = np.arange(len(each)) + np.repeat(start - h - np.cumsum(many) + many, many)
        same = np.flatnonzero(self._low(at) == want[each])
        out, hit = np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        out[each[same]], hit[each[same]] = at[same], True
        return out, hit


def encode_children(context: np.ndarray, words: np.ndarray, contexts: int, bits: int) -> dict[str, np.ndarray]:
    """Arrays for the words (below 2^bits) that follow each context (below `contexts`), sorted by both.

    A context with d words owns the next power of two of buckets, which cut the words' range evenly; the
    buckets are numbered on from context to context, so they are monotone, as are the contexts' first
    buckets, the pointers. Frequent contexts so have as few words a bucket as rare ones.
    """
    d = np.bincount(context, minlength=contexts)
    own = np.where(d > 0, np.int64(1) << np.minimum(bits, np.ceil(np.log2(np.maximum(d, 1))).astype(np.int64)), 0)
    first = np.concatenate([[0], np.cumsum(own)])
    shift = bits - np.bitwise_count(np.maximum(own, 1) - 1).astype(np.int64)
    high = first[context]
    high += words >> shift[context]
    return encode(first, int(first[-1]) + 1, "first", 6) | _encode(high, words.astype(np.uint64), int(first[-1]) + 1, bits, "words", False)


class Children:
    def __init__(self, arrays: dict[str, np.ndarray]):
        self.first, self.words = Sequence(arrays, "first"), Sequence(arrays, "words")

    def find(self, context: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is there) of each word among its context's successors."""
        at, hit = np.zeros(len(context), np.int64), np.zeros(len(context), bool)
        which, each = pd.factorize(context)
        b, next_b = (x.astype(np.int64) for x in self.first.get(each))
        own = (next_b - b)[which]
        b = b[which]
        i = np.flatnonzero(own)
        shift = self.words.bits - np.bitwise_count(own[i] - 1).astype(np.int64)
        at[i], hit[i] = self.words.in_bucket(b[i] + (words[i] >> shift), words[i].astype(np.uint64))
        return at, hit


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


def write_arrays(path: str, arrays: dict[str, np.ndarray]) -> None:
    """A file of 64-byte aligned arrays in a folder that all executors share; whole or not there."""
    fs, p = _filesystem(path)
    fs.create_dir(p.rpartition("/")[0], recursive=True)
    head, at = {}, 0
    for k, a in arrays.items():
        head[k] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 64) * 64
    line = json.dumps(head).encode()
    start = -(-(len(line) + 16) // 64) * 64
    with fs.open_output_stream(own := f"{p}.{uuid.uuid4().hex}") as out:
        out.write(len(line).to_bytes(8, "little") + start.to_bytes(8, "little") + line + bytes(start - 16 - len(line)))
        for a in arrays.values():
            out.write(a.tobytes() + bytes(-a.nbytes % 64))
    fs.move(own, p)


def remove(path: str) -> None:
    fs, p = _filesystem(path)
    fs.delete_file(p)


def read_arrays(path: str) -> tuple[dict[str, np.ndarray], int]:
    """(a file's arrays, the bytes of memory that they take): maps, or read where the store can't be mapped; none if it isn't there."""
    from pyarrow import fs as pafs

    fs, p = _filesystem(path)
    if fs.get_file_info(p).type == pafs.FileType.NotFound:
        return {}, 0
    if fs.type_name != "local":
        with fs.open_input_file(p) as source:
            raw = np.frombuffer(source.read(), np.uint8)
    else:
        raw = np.asarray(np.memmap(p, np.uint8, "r"))  # a plain view of the map: memmap's own views cost microseconds each
    size, start = (int(x) for x in raw[:16].view(np.uint64))
    out = {}
    for k, (kind, n, at) in json.loads(raw[16 : 16 + size].tobytes()).items():
        out[k] = raw[start + at : start + at + n * np.dtype(kind).itemsize].view(kind)
    return out, 0 if fs.type_name == "local" else len(raw)
