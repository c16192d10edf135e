"""10. LM scoring: an Elias-Fano n-gram trie of order 3.

Training tokens are counted over the whole corpus: words by hash, then word pairs and triples by the
words' places in the first level. Each level is sharded by its first word; a shard holds the sorted word
hashes, or each context's successors, as Elias-Fano sequences: monotone pointers lead from a context to
its successors, which are searched in the bucket that the word has relative to that context. Beside them
are 8-bit probabilities and 16-bit back-off weights. A word with more tokens than a shard should have is
hot: its successors are spread over several shards by their hash, and their sums are added up for its back-off
weight; so no shard grows with a frequent word (a pair's successors stay together: one for each word at most).
Shards are written by the tasks that count them to the shared folder, and memory-mapped by the scoring tasks,
once a worker; where the store can't be mapped, a worker holds HELD bytes of them at most, the last used.

Model: absolute discounting, interpolated. alpha(w|h) = (c(hw) - D) / c(h), rounded down to 2^(-q/8);
gamma(h) = 1 - the sum of alpha; p(w|h) = alpha + gamma p(w|shorter h); p(w) = (c + 1) / (N + V + 1).
All pairs and triples are kept (`least` = 1), those seen once too; p sums to one up to the rounding of
gamma. Counts travel as the differences of sorted keys, byte by byte, which compresses well.

Null and empty texts: the end token alone. Repeated rows count and score each. Null ids: training rows.
Without training rows N = V = 0 and every token has probability 1. Texts are scored whole, a window of tokens
at a time, so a very long one takes no more memory than its tokens' places. Empty table: no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import drop, free, in_worker, map_arrow, materialize, mix, new_path, steps, table, text_buffer, word_hashes
from siftwell.llm.elias_fano import Children, Sequence, encode, encode_children, read_arrays, remove, write_arrays

END = np.uint64(0x9E3779B97F4A7C15)
DISCOUNT = 0.75
PARTS = "part int, once binary, more binary, counts binary"
#: Tokens that are looked up at a time, a few thousand for each of hundreds of shards; entries that are made at a time; keys of a
#: batch that is sent; bytes of shards that a worker holds where they can't be mapped.
WINDOW, MADE, SENT, HELD = 1 << 20, 1 << 18, 1 << 18, 256 << 20


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all rows' tokens, an end token after each row, and where rows begin."""
    words, first = word_hashes(data, offsets)
    n = len(first) - 1
    out = np.full(len(words) + n, END, np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(first))] = words
    return out, first + np.arange(n + 1)


def tally(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their counts; sorts the array that it is given."""
    keys.sort()
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.diff(at, append=len(keys))


def planes(keys: np.ndarray) -> np.ndarray:
    """The differences of sorted keys: all lowest bytes, then all next ones."""
    return np.ascontiguousarray(np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T)


def keys_of(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def dealt(chunks: Iterator[tuple[np.ndarray, np.ndarray | None]], parts: int, flush: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Counts of (key, part) chunks (part None: the key's top bits), a row for each part and `flush` keys."""
    held, size = [], 0

    def out() -> Iterator[pa.RecordBatch]:
        keys = np.concatenate([k for k, _ in held]) if held else np.zeros(0, np.uint64)
        if not len(keys):
            return
        own = held[0][1] is not None
        part = np.concatenate([p for _, p in held]) if own else part_of(keys, parts)
        order = by_part(part)
        edges = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])
        made, n = [], 0
        for p in np.flatnonzero(np.diff(edges)).tolist():
            k, c = tally(keys[order[edges[p] : edges[p + 1]]])
            made.append((p, *(x.tobytes() for x in (planes(k[c == 1]), planes(k[c > 1]), c[c > 1].astype(np.uint32)))))
            n += len(k)
            if n >= SENT or p == part[order[-1]]:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), (pa.int32(), *[pa.binary()] * 3))], names=["part", "once", "more", "counts"])
                made, n = [], 0

    for keys, part in chunks:
        held.append((keys, part))
        size += len(keys)
        if size >= flush:
            yield from out()
            held, size = [], 0
    yield from out()


def by_part(part: np.ndarray) -> np.ndarray:
    """The order by part; numpy sorts 16 bits by counting, several times faster than wider ones."""
    return np.argsort(part.astype(np.uint16) if len(part) and part.max() < 1 << 16 else part, kind="stable")


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def gathered(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and summed counts of a part's rows."""

    def joined(name: str, decode, kind) -> np.ndarray:
        return np.concatenate([np.zeros(0, kind), *(decode(x.as_py()) for x in t.column(name))])

    k, c = tally(joined("once", keys_of, np.uint64))
    more, times = joined("more", keys_of, np.uint64), joined("counts", lambda x: np.frombuffer(x, np.uint32), np.uint32)
    if len(more):
        order = np.argsort(more, kind="stable")
        more, times = more[order], times[order].astype(np.int64)
        at = np.flatnonzero(np.concatenate([[True], more[1:] != more[:-1]]))
        more, times = more[at], np.add.reduceat(times, at)
        there = np.searchsorted(k, more)
        both = np.flatnonzero(k[np.minimum(there, len(k) - 1)] == more) if len(k) else np.zeros(0, np.int64)
        c[there[both]] += times[both]
        fresh = np.ones(len(more), bool)
        fresh[both] = False
        k, c = np.insert(k, there[fresh], more[fresh]), np.insert(c, there[fresh], times[fresh])
    return k, c


def alpha_code(counts: np.ndarray, context: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.ceil(-8 * np.log2((counts - DISCOUNT) / context) - 1e-9)).astype(np.uint8)


ALPHA = 2.0 ** (-np.arange(256) / 8)


def gamma_code(sums: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((1 - sums) * 65535), 1, 65535).astype(np.uint16)


class Shards:
    """What a worker has open of one model's files."""

    def __init__(self, path: str):
        self.path, self.open, self.held = path, {}, 0

    def get(self, level: int, p: int) -> dict:
        if (found := self.open.pop((level, p), None)) is None:
            arrays, size = read_arrays(f"{self.path}/{level}-{p}")
            arrays["seq"] = Sequence(arrays, "keys") if "keys.meta" in arrays else None
            arrays["next"] = Children(arrays) if "words.meta" in arrays else None
            found = arrays, size
            self.held += size
        self.open[level, p] = found  # the last used is last
        while self.held > HELD and len(self.open) > 1:
            self.held -= self.open.pop(next(iter(self.open)))[1]
        return found[0]


class Model:
    """The levels' files and where words are in them. sizes: entries of each shard of level 1; hot: (word, count, shards)."""

    def __init__(self, path: str, parts: int, sizes: list[int], total: int):
        self.path, self.parts, self.total, self.vocabulary = path, parts, total, sum(sizes)
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.shift = np.uint64(max(1, self.vocabulary).bit_length())
        self.width = -(-int(self.shift) // 8)  # bytes of a place
        self.hot, self.hot_sums = np.zeros((0, 3), np.int64), np.zeros(0)

    @property
    def holds(self) -> tuple[str, str]:
        return "Shards", self.path

    def shard(self, level: int, p: int) -> dict:
        return in_worker(Shards, self.path).get(level, p)

    def _routed(self, part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = by_part(part)
        edges = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=self.parts))])
        for p in np.flatnonzero(np.diff(edges)).tolist():
            yield p, order[edges[p] : edges[p + 1]]

    def words(self, hashes: np.ndarray) -> np.ndarray:
        """Places in level 1, -1 if unknown."""
        out = np.full(len(hashes), -1, np.int64)
        for a in range(0, len(hashes), WINDOW):
            which, own = pd.factorize(hashes[a : a + WINDOW])
            found = np.full(len(own), -1, np.int64)
            for p, i in self._routed(part_of(own, self.parts)):
                if self.first[p + 1] > self.first[p]:
                    at, hit = self.shard(1, p)["seq"].find(own[i] - base_of(p, self.parts))
                    found[i] = np.where(hit, at + self.first[p], -1)
            out[a : a + WINDOW] = found[which]
        return out

    def part(self, places: np.ndarray) -> np.ndarray:
        return (np.searchsorted(self.first, places, "right") - 1).astype(np.int32)

    def _hot(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the words are hot, their rows in the table)."""
        if not len(self.hot):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hot[:, 0], u), len(self.hot) - 1)
        which = np.flatnonzero(self.hot[at, 0] == u)
        return which, at[which]

    def pair_part(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The shard of a pair: its first word's, or one of those that a hot word has."""
        part = self.part(u)
        i, at = self._hot(u)
        part[i] = (part[i] + (mix(v[i].astype(np.uint64)) % self.hot[at, 2].astype(np.uint64)).astype(np.int64)) % self.parts
        return part

    def guests(self, p: int) -> np.ndarray:
        """Rows of the hot words that have successors in shard p and are no words of it."""
        away = (p - self.part(self.hot[:, 0])) % self.parts
        return np.flatnonzero((away > 0) & (away < self.hot[:, 2]))

    def contexts(self, p: int, u: np.ndarray) -> np.ndarray:
        """The numbers that words have as contexts of shard p: its own, then its guests."""
        own = u - self.first[p]
        n = self.first[p + 1] - self.first[p]
        other = np.flatnonzero((own < 0) | (own >= n))
        if len(other):
            own[other] = n + np.searchsorted(self.hot[self.guests(p), 0], u[other])
        return own

    def context_counts(self, p: int) -> np.ndarray:
        own = self.shard(1, p)["counts"].astype(np.int64) if self.first[p + 1] > self.first[p] else np.zeros(0, np.int64)
        return np.concatenate([own, self.hot[self.guests(p), 1]])

    def of_words(self, name: str, places: np.ndarray, level: int = 1) -> np.ndarray:
        """`name` (counts of level 1, gamma of level 2) at places that are all known."""
        out = np.zeros(len(places), np.int64)
        for p, i in self._routed(self.part(places)):
            out[i] = self.shard(level, p)[name][places[i] - self.first[p]]
        if level == 2:
            i, at = self._hot(places)
            out[i] = gamma_code(self.hot_sums[at])
        return out

    def pairs(self, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(part, node or -1, alpha) of the pairs of known words."""
        part = self.pair_part(u, v)
        node, alpha = np.full(len(u), -1, np.int64), np.zeros(len(u))
        for p, i in self._routed(part):
            a = self.shard(2, p)
            if a.get("next"):
                at, hit = a["next"].find(self.contexts(p, u[i]), v[i])
                node[i[hit]], alpha[i[hit]] = at[hit], ALPHA[a["alpha"][at[hit]]]
        return part, node, alpha

    def triples(self, part: np.ndarray, node: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(alpha, gamma of the pair) for pairs that are nodes."""
        alpha, gamma = np.zeros(len(node)), np.ones(len(node))
        for p, i in self._routed(part):
            a = self.shard(3, p)
            gamma[i] = a["gamma"][node[i]] / 65535.0
            if a["next"]:
                at, hit = a["next"].find(node[i], w[i])
                alpha[i[hit]] = ALPHA[a["alpha"][at[hit]]]
        return alpha, gamma


def base_of(p: int, parts: int) -> np.uint64:
    """The smallest hash of part p."""
    return np.uint64(-(-(p << 32) // parts) << 32)


def to_bytes(places: np.ndarray, width: int) -> bytes:
    """Places and -1, `width` bytes each."""
    return np.ascontiguousarray((places + 1).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def from_cells(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of all rows, where rows begin)."""
    data, at = text_buffer(column)
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = data.reshape(-1, width)
    return out.view("<i8").ravel() - 1, at // width


def windows(ids: np.ndarray, first: np.ndarray, before: int, after: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(place of the window, its tokens, those with `before` ones ahead and `after` ones behind, where a row begins there)."""
    heads = np.zeros(len(ids) + 1, bool)
    heads[first] = True
    for a in range(0, len(ids), WINDOW):
        own = slice(max(0, a - before), a + WINDOW + after)
        yield a, min(WINDOW, len(ids) - a), ids[own], heads[:-1][own]


def learn(docs: DataFrame, training: Column, text_col: str = "text", least: int = 1, part_bytes: int | None = None) -> tuple[Model, DataFrame, str]:
    """The model of the rows where `training` holds, and docs without their text, with their tokens' places (-1: unknown)
    in the column of the third result. part_bytes: text of a shard; 32 MB, or up to 64 where there would be over 64 shards,
    as each shard that a window of tokens meets costs it a millisecond."""
    spark = docs.sparkSession
    train_col, ids_col = free(docs.columns, "in_training"), free(docs.columns, "token_places")
    docs = docs.withColumn(train_col, training)
    total = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).collect()[0].n or 0
    part_bytes = part_bytes or min(64 << 20, max(32 << 20, total // 64))
    parts, path, most = max(2, math.ceil(total / part_bytes)), new_path(spark, "trie"), max(1, part_bytes // 8)  # tokens of a shard
    taught = docs.filter(F.col(train_col)).select(F.col(text_col).alias("text"))

    def hashes(rows):
        for b in rows:
            data, at = text_buffer(b.column(0))
            for i, j in steps(at):
                yield tokens(data[at[i] : at[j]], at[i : j + 1] - at[i])[0], None

    def level1(t: pa.Table) -> pa.Table:
        p = t.column("part")[0].as_py()
        keys, counts = gathered(t)
        base = base_of(p, parts)
        universe = int(base_of(p + 1, parts) - base) if p + 1 < parts else 2**64 - int(base)
        write_arrays(f"{path}/1-{p}", encode(keys - base, universe, "keys") | {"counts": counts.astype(np.int64 if counts.max() >= 2**32 else np.uint32)})
        hot = np.flatnonzero(counts > most)
        return pa.table({"part": pa.array([p], pa.int32()), "n": [len(keys)], "tokens": [int(counts.sum())], "hot": pa.array([hot], pa.list_(pa.int64())), "counts": pa.array([counts[hot]], pa.list_(pa.int64()))})

    sent = map_arrow(taught, lambda rows: dealt(hashes(rows), parts), PARTS)
    made = sent.groupBy("part").applyInArrow(level1, "part int, n long, tokens long, hot array<long>, counts array<long>").collect()  # a row for each shard; fewer hot words than shards
    sizes = dict((r.part, r.n) for r in made)
    model = Model(path, parts, [sizes.get(p, 0) for p in range(parts)], sum(r.tokens for r in made))
    if int(model.shift) > 32:
        raise ValueError("more than 2^32 words: pair keys would not fit 64 bits")
    drop(session=spark)
    hot = sorted((int(model.first[r.part]) + i, c, min(parts, -(-c // most))) for r in made for i, c in zip(r.hot, r.counts))
    model.hot, model.hot_sums = np.array(hot, np.int64).reshape(-1, 3), np.zeros(len(hot))

    at_text = docs.columns.index(text_col)

    def places(rows):
        for b in rows:
            data, at = text_buffer(b.column(at_text))
            found = [tokens(data[at[i] : at[j]], at[i : j + 1] - at[i]) for i, j in steps(at)]
            first = model.width * np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *(np.diff(f) for _, f in found)]))])
            ids = to_bytes(model.words(np.concatenate([np.zeros(0, np.uint64), *(h for h, _ in found)])), model.width)  # a batch's words at a time
            out = [ids[x:y] for x, y in zip(first[:-1], first[1:])]
            rest = [k for k in range(b.num_columns) if k != at_text]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in rest), pa.array(out, pa.binary())], names=[*(b.schema.names[k] for k in rest), ids_col])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text_col)
    numbered = materialize(map_arrow(docs, places, f"{kinds}, `{ids_col}` binary", model.holds), "ids")
    if not model.vocabulary:
        return model, numbered, ids_col
    known = numbered.filter(F.col(train_col)).select(ids_col)

    def often(ids: np.ndarray) -> np.ndarray:
        return model.of_words("counts", ids) >= least if least > 1 else np.ones(len(ids), bool)

    def two(rows):
        for b in rows:
            for _, n, x, head in windows(*from_cells(b.column(0), model.width), 0, 1):
                ok = often(x)
                i = np.flatnonzero(~head[1:] & ok[:-1] & ok[1:])
                i = i[i < n]
                yield (x[i].astype(np.uint64) << model.shift) | x[i + 1].astype(np.uint64), model.pair_part(x[i], x[i + 1])

    def level(keys: np.ndarray, counts: np.ndarray, h: np.ndarray, context: np.ndarray) -> tuple[dict, np.ndarray]:
        """Arrays of the successors of contexts with the counts `context`, h being each key's; and the sums of alpha."""
        code, sums = np.zeros(len(h), np.uint8), np.zeros(len(context))
        for a in range(0, len(h), MADE):
            own = slice(a, a + MADE)
            code[own] = alpha_code(counts[own], context[h[own]])
            low, high = h[a], h[own][-1] + 1  # sorted
            sums[low:high] += np.bincount(h[own] - low, ALPHA[code[own]], high - low)
        out = {"alpha": code, "gamma": gamma_code(sums)}
        return out | (encode_children(h, (keys & np.uint64((1 << int(model.shift)) - 1)).astype(np.int64), len(context), int(model.shift)) if len(h) else {}), sums

    def level2(p: int, keys: np.ndarray, counts: np.ndarray) -> pa.Table:
        keys, counts = keys[counts >= least], counts[counts >= least]
        h, context = model.contexts(p, (keys >> model.shift).astype(np.int64)), model.context_counts(p)
        order = np.lexsort((keys, h))  # guests behind the shard's own words
        keys, counts, h = keys[order], counts[order], h[order]
        arrays, sums = level(keys, counts, h, context)
        write_arrays(f"{path}/2-{p}", arrays)
        more = np.flatnonzero(counts > 255)
        write_arrays(f"{path}/20-{p}", {"counts": np.minimum(counts, 255).astype(np.uint8), "at": more, "more": counts[more].astype(np.int64)})  # until level 3 is made
        i, at = model._hot(np.concatenate([np.arange(model.first[p], model.first[p + 1]), model.hot[model.guests(p), 0]]))
        return pa.table({"part": pa.array([p] * len(i), pa.int32()), "at": pa.array(at, pa.int64()), "sum": pa.array(sums[i], pa.float64())})

    def level3(p: int, keys: np.ndarray, counts: np.ndarray) -> pa.Table:
        pairs = read_arrays(f"{path}/20-{p}")[0]
        context = pairs["counts"].astype(np.int64)
        context[pairs["at"]] = pairs["more"]
        keys, counts = keys[counts >= least], counts[counts >= least]
        write_arrays(f"{path}/3-{p}", level(keys, counts, (keys >> model.shift).astype(np.int64), context)[0])
        return pa.table({"part": pa.array([p], pa.int32()), "at": pa.array([0], pa.int64()), "sum": pa.array([0.0], pa.float64())})

    def build(chunks, make) -> list:
        """Counts of the keys that `chunks` gives, made into a file for each shard, for those without a key too."""
        empty = spark.range(parts).selectExpr("CAST(id AS INT) AS part", *(f"CAST('' AS BINARY) AS {c}" for c in ("once", "more", "counts")))
        sent = map_arrow(known, lambda rows: dealt(chunks(rows), parts), PARTS, model.holds).unionByName(empty)
        return sent.groupBy("part").applyInArrow(lambda t: make(t.column("part")[0].as_py(), *gathered(t)), "part int, at long, sum double").collect()  # a row for each shard and hot word in it

    for r in build(two, level2):
        model.hot_sums[r.at] += r.sum

    def three(rows):
        for b in rows:
            for _, n, x, head in windows(*from_cells(b.column(0), model.width), 0, 2):
                ok = often(x)
                i = np.flatnonzero(~head[1:] & ok[:-1] & ok[1:])
                part, node, _ = model.pairs(x[i], x[i + 1])
                at = np.full(len(x) + 1, -1, np.int64)
                own = np.zeros(len(x) + 1, np.int32)
                at[i], own[i] = node, part
                j = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0))
                j = j[j < n]
                yield (at[j].astype(np.uint64) << model.shift) | x[j + 2].astype(np.uint64), own[j]

    drop(session=spark)
    build(three, level3)
    for p in range(parts):
        remove(f"{path}/20-{p}")
    drop(session=spark)
    return model, numbered, ids_col


def score(numbered: DataFrame, model: Model, ids_col: str, keep: list[str]) -> DataFrame:
    """keep, n_tokens, n_known, base_score and score of each row of `learn`'s second result."""
    kinds = ", ".join(f"`{c}` {numbered.schema[c].dataType.simpleString()}" for c in keep)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            ids, first = from_cells(b.column(len(keep)), model.width)
            out = [np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows), np.zeros(b.num_rows)]
            for a, n, x, head in windows(ids, first, 2, 0):
                which, own = pd.factorize(x)
                good = np.flatnonzero(own >= 0)
                counts, gamma = np.zeros(len(own)), np.ones(len(own))
                counts[good] = model.of_words("counts", own[good])
                p1 = (counts + 1) / (model.total + model.vocabulary + 1)
                if len(good):
                    gamma[good] = model.of_words("gamma", own[good], 2) / 65535.0
                    p = interpolated(x, head, p1[which], gamma[which])[-n:]
                else:
                    p = p1[which][-n:]
                x, p1 = x[-n:], p1[which][-n:]
                i = np.searchsorted(first, a, "right") - 1
                j = np.searchsorted(first, a + n)
                at = np.maximum(first[i:j] - a, 0)
                for total, part in zip(out, (x >= 0, np.log10(p1), np.log10(p))):
                    total[i:j] += np.add.reduceat(part, at, dtype=total.dtype)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(np.diff(first)), *map(pa.array, out)], names=[*keep, "n_tokens", "n_known", "base_score", "score"])

    def interpolated(x: np.ndarray, head: np.ndarray, p: np.ndarray, gamma: np.ndarray) -> np.ndarray:
        """From the words' own probabilities `p`, which are changed, and their weights as contexts."""
        head = head.copy()
        head[0] = True  # in the middle of a row: what is there only for the tokens behind it
        t = np.flatnonzero(~head & (x >= 0) & (np.roll(x, 1) >= 0))  # both words known
        u = np.flatnonzero(~head & (np.roll(x, 1) >= 0))  # the context known
        p[u] *= gamma[u - 1]
        part, node, alpha = model.pairs(x[t - 1], x[t])
        p[t] += alpha
        nodes, parts = np.full(len(x), -1, np.int64), np.zeros(len(x), np.int32)
        nodes[t], parts[t] = node, part
        s = np.flatnonzero(~head & (np.roll(nodes, 1) >= 0))
        if len(s):
            w = np.maximum(x[s], 0)
            alpha, gamma = model.triples(parts[s - 1], nodes[s - 1], w)
            p[s] = p[s] * gamma + np.where(x[s] >= 0, alpha, 0)
        return p

    return map_arrow(numbered.select(*keep, ids_col), run, f"{kinds}, n_tokens long, n_known long, base_score double, score double", model.holds)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, numbered, places = learn(docs, ~held_out())
    out = score(numbered, model, places, ["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
