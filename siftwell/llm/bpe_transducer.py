"""11. Byte-level BPE: merges compiled into a lazily determinised transducer; decoding by a UTF-8 state machine.

A sequence of tokens is what the merges make of its bytes exactly if each token follows its neighbour so in their
own bytes' encoding, which the merges tell (`Transducer.fits`). So an automaton reads bytes: an item is a place in
the trie of tokens, the token before it and the tokens still held back; where a token that fits ends, an item opens at
the root. A state is a set of such items. States and arcs are made as bytes ask for them; what all items of a state hold
back alike is emitted with the arc, so a token leaves as soon as no continuation can undo it, which the longest token
bounds. The table of states is bounded: a full one is begun anew.

The text is cut by the vocabulary's pattern first, in the Unicode version of the library whose ids these are. Ids of short
pre-tokens, as the transducer gave them, are kept in a bounded table in each Python worker. Decoding joins the tokens'
bytes and passes on whole characters only; bytes that are no UTF-8 become U+FFFD, as the library has it.

Null text: empty, no ids; null ids: an empty text. Very long texts and pre-tokens are taken part by part. Repeated rows and
doc_ids: a row each. Other columns are ignored, whatever their names. Empty table: no rows. An id outside the vocabulary
is an error.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import in_worker, map_arrow, table
from siftwell.llm.token_counts import _BYTE_LEVEL, PLAIN, text_groups

#: Characters from which a text is cut, and bytes from which a pre-token is read, in parts.
LONG, PART = 1 << 20, 1 << 16
START, NEVER = -1, 1 << 40


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(x): int(n) for x, n in map(bytes.split, f)}


class Transducer:
    """ids of byte strings; `most` bounds the states of the determinised table."""

    def __init__(self, ranks: dict[bytes, int], most: int = 1 << 17):
        self.ranks, self.most, self.fitting, self.edge = ranks, most, {}, {}
        self.items, self.number, self.arcs, self.ends = [], {}, {}, []
        self.bytes_of = {i: x for x, i in ranks.items()}
        self.below, self.token, self.inner = {}, [START], bytearray(1)
        for word, i in ranks.items():
            node = 0
            for b in word:
                child = self.below.get(node << 8 | b)
                if child is None:
                    child = self.below[node << 8 | b] = len(self.token)
                    self.token.append(START)
                    self.inner.append(0)
                    self.inner[node] = 1
                node = child
            self.token[node] = i
        self.begin()

    def begin(self) -> None:
        """The table holds the start state alone: at the trie's root, nothing before it, nothing held back."""
        for x in (self.items, self.number, self.arcs, self.ends):
            x.clear()
        self.state(((0, START, ()),))

    def state(self, items: tuple) -> int:
        """The number of a state, times 256. Items are (node, token before, tokens held back), the one at the root last."""
        found = self.number.get(items)
        if found is None:
            found = self.number[items] = len(self.items) << 8
            self.items.append(items)
            node, before, _ = items[0]
            token = self.token[node] if before == START else START  # a pre-token that is a token is that token
            self.ends.append(items[-1][2] if token == START else (token,))
        return found

    def edges(self, token: int) -> tuple[list, list] | None:
        """The first and the last part of a token as its merges go on, each with the rank of the merge that ends it; None
        if the merges of its bytes don't make it."""
        found = self.edge.get(token)
        if found is None:
            parts = [self.bytes_of[token][i : i + 1] for i in range(len(self.bytes_of[token]))]
            heads, tails = [], []
            while len(parts) > 1:
                rank, i = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank == NEVER:
                    break
                if i == 0:
                    heads.append((parts[0], rank))
                if i == len(parts) - 2:
                    tails.append((parts[-1], rank))
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            whole = (self.bytes_of[token], NEVER)
            found = self.edge[token] = ([*heads, whole], [*tails, whole]) if len(parts) == 1 else ()
        return found or None

    def fits(self, before: int, token: int) -> bool:
        """Whether `token` stays whole behind `before` (or at the start): no merge ever takes a part of either.

        The parts beside the seam change as the two merge, by rank, the left one first; a pair of them that is of lower
        rank than what comes next (or the same, as the one to the left) is merged across the seam.
        """
        own = self.edges(token)
        if before == START or own is None:
            return own is not None
        left, right, i, j = self.edges(before)[1], own[0], 0, 0
        while True:
            (a, next_left), (b, next_right) = left[i], right[j]
            rank = self.ranks.get(a + b, NEVER)
            if rank < next_left and rank <= next_right and rank != NEVER:
                return False
            if next_left == next_right == NEVER:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def determinise(self, state: int, byte: int) -> tuple[int, tuple]:
        """The arc of a state and a byte: (the next state, what is emitted)."""
        after, opened, least, byte_of, fitting = [], None, 1 << 30, self.below.get, self.fitting
        for item in self.items[state >> 8]:
            node, before, held = item
            child = byte_of(node << 8 | byte)
            if child is None:
                continue
            token = self.token[child]
            if token != START:
                key = before << 32 | token
                fits = fitting.get(key)
                if fits is None:
                    if len(fitting) > 1 << 20:
                        fitting.clear()
                    fits = fitting[key] = self.fits(before, token)
                if fits:
                    if opened is not None:
                        raise ValueError("two encodings of one string: the ranks are no byte pair merges")
                    opened = (0, token, (*held, token))
            else:
                fits = True
            if self.inner[child] or (before == START and not fits):
                after.append((child, before, held))
                if len(held) < least:
                    least = len(held)
        if opened is None:
            raise ValueError(f"no token ends at byte {byte}: the ranks are no byte pair merges of all bytes")
        first, emitted = opened[2], 0
        after.append(opened)
        least = min(least, len(first))
        while emitted < least and all(held[emitted] == first[emitted] for *_, held in after):
            emitted += 1
        items = tuple([(node, before, held[emitted:]) for node, before, held in after] if emitted else after)
        if len(self.items) >= self.most:
            self.begin()
            return self.state(items), first[:emitted]
        arc = self.arcs[state | byte] = self.state(items), first[:emitted]
        return arc

    def feed(self, state: int, data: bytes, out: list[int]) -> int:
        """Reads bytes from a state on; emitted ids go to `out`."""
        get = self.arcs.get
        for b in data:
            state, tokens = get(state | b) or self.determinise(state, b)
            if tokens:
                out += tokens
        return state

    def ids(self, data: bytes) -> list[int]:
        out: list[int] = []
        out += self.ends[self.feed(0, data, out) >> 8]
        return out if data else []

    def stream(self, data: bytes) -> Iterator[list[int]]:
        """As ids, a part at a time, in memory that doesn't grow with the bytes."""
        state = 0
        for a in range(0, len(data), PART):
            out: list[int] = []
            state = self.feed(state, data[a : a + PART], out)
            if a + PART >= len(data):
                out += self.ends[state >> 8]
            yield out


@functools.cache
def unknown_characters(kind: str) -> str:
    """What `regex` counts to a class (\\p{L}, \\p{N}) and the library, of another Unicode version, does not; as ranges of a set."""
    import regex
    import tiktoken

    probe = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    ours, theirs = set(regex.findall(kind, every)), set(probe.decode(probe.encode_ordinary(every)))
    if theirs - ours:
        raise ValueError(f"the library's {kind} has characters that regex does not know")
    codes = np.array(sorted(map(ord, ours - theirs)), np.int64)
    runs = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1) if len(codes) else []
    return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)


class Cutter:
    """Pre-tokens of texts by a pattern, as the library cuts them."""

    def __init__(self, pattern: str, letters: str, numbers: str):
        import regex

        self.usual = regex.compile(pattern)
        self.newer = re.compile(f"[{letters}{numbers}]") if letters + numbers else None
        for kind, unknown in ((r"\p{L}", letters), (r"\p{N}", numbers)):
            pattern = pattern.replace(kind, f"[{kind}--[{unknown}]]" if unknown else kind)
        self.exact = regex.compile("(?V1)" + pattern)

    def of(self, text: str):
        """The pattern for a text: that without exceptions is faster."""
        return self.exact if self.newer and not text.isascii() and self.newer.search(text) else self.usual

    def cut(self, text: str) -> list[str]:
        return _BYTE_LEVEL.findall(text) if PLAIN.fullmatch(text) else self.of(text).findall(text)

    def parts(self, text: str) -> Iterator[list[str]]:
        found = (m[0] for m in self.of(text).finditer(text))
        while some := list(islice(found, 1 << 16)):
            yield some


class Encoder:
    """Ids as little-endian unsigned 32-bit integers; pre-tokens of at most `longest` characters are kept, `limit` of them."""

    def __init__(self, path: str, limit: int = 1 << 18, longest: int = 48):
        self.transducer, self.limit, self.longest, self.known = Transducer(load_ranks(path)), limit, longest, {}

    def piece(self, text: str) -> bytes:
        data = text.encode("utf-8", "replace")
        if len(data) > PART:
            return b"".join(np.array(ids, "<u4").tobytes() for ids in self.transducer.stream(data))
        found = np.array(self.transducer.ids(data), "<u4").tobytes()
        if len(text) <= self.longest:
            if len(self.known) >= self.limit:
                self.known.clear()
            self.known[text] = found
        return found

    def pieces(self, found: Iterable[str]) -> bytes:
        get, piece = self.known.get, self.piece
        return b"".join([get(x) or piece(x) for x in found])

    def encode(self, text: str, cutter: Cutter) -> bytes:
        if len(text) <= LONG:
            return self.pieces(cutter.cut(text))
        return b"".join(self.pieces(x) for x in cutter.parts(text))


# ---- decoding ---------------------------------------------------------------------------------------------------

#: Well-formed UTF-8 (fixed values): from a state (0: between characters) the byte ranges that go on, and the next state.
_WELL_FORMED = {
    0: [(0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5), (0xEE, 0xEF, 2), (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7)],
    1: [(0x80, 0xBF, 0)],
    2: [(0x80, 0xBF, 1)],
    3: [(0x80, 0xBF, 2)],
    4: [(0xA0, 0xBF, 1)],
    5: [(0x80, 0x9F, 1)],
    6: [(0x90, 0xBF, 2)],
    7: [(0x80, 0x8F, 2)],
}
REJECT = 8
_AFTER = np.full((9, 256), REJECT, np.uint8)
for _state, _ranges in _WELL_FORMED.items():
    for _low, _high, _next in _ranges:
        _AFTER[_state, _low : _high + 1] = _next


class Utf8Stream:
    """Bytes in any parts to text: whole characters are passed on, an open one is held (3 bytes at most)."""

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def open_bytes(data: bytes) -> int:
        """How many bytes at the end belong to a character that more bytes could complete."""
        for k in range(1, min(3, len(data)) + 1):
            if data[-k] >= 0xC0:
                state = 0
                for b in data[len(data) - k :]:
                    state = int(_AFTER[state, b])
                return k if 0 < state < REJECT else 0
            if data[-k] < 0x80:
                break
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        whole = len(data) - self.open_bytes(data)
        self.held = data[whole:]
        return data[:whole].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class Vocabulary:
    def __init__(self, path: str):
        self.bytes_of = {i: x for x, i in load_ranks(path).items()}

    def decode(self, ids: bytes | None, part: int = 1 << 14) -> str:
        stream, found = Utf8Stream(), np.frombuffer(ids or b"", "<u4")
        try:
            parts = [stream.feed(b"".join(map(self.bytes_of.__getitem__, found[a : a + part].tolist()))) for a in range(0, len(found), part)]
        except KeyError as e:
            raise ValueError(f"id {e} is not in the vocabulary") from None
        return "".join([*parts, stream.close()])


# ---- operators --------------------------------------------------------------------------------------------------


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens and ids (binary, little-endian unsigned 32-bit integers) of each row."""
    kind = docs.schema[id_col].dataType.simpleString()
    unknown = unknown_characters(r"\p{L}"), unknown_characters(r"\p{N}")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, cutter = in_worker(Encoder, ranks_path), Cutter(pattern, *unknown)
        for b in rows:
            at = 0
            for texts in text_groups(b.column(1)):
                ids = pa.array([encoder.encode(x, cutter) for x in texts], pa.binary())
                n = pc.cast(pc.divide(pc.binary_length(ids), 4), pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), n, ids], names=["doc_id", "n_tokens", "ids"])
                at += len(texts)

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, f"doc_id {kind}, n_tokens long, ids binary", ("Encoder", ranks_path))


def decode_ids(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """The table with its ids replaced by their text, as `name`."""
    at = encoded.columns.index(ids_col)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = in_worker(Vocabulary, ranks_path)
        for b in rows:
            yield b.set_column(at, name, pa.array([vocabulary.decode(x.as_py()) for x in b.column(at)], pa.string()))

    schema = ", ".join(f"`{name}` string" if f.name == ids_col else f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return map_arrow(encoded, run, schema, ("Vocabulary", ranks_path))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = encode_texts(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    decoded = decode_ids(encoded.withColumn("ids_sha256", F.sha2("ids", 256)), path)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
