"""3. Best-fit packing: minimum bin slack.

Documents become pieces of at most `capacity` tokens. How many pieces there are of each length is a
table of at most `capacity` rows; over it the plan is drawn: bin by bin, the longest piece left opens
a bin, a bitset subset-sum over the lengths left finds the fullest combination for the rest, and that
combination is removed, as often in a row as the lengths allow. The plan has a few runs a length, so
its size does not follow the corpus. Pieces then find their place by their rank in their length.

Where the documents have an order (mixing's slot and place), `pack_in_order` cuts it into windows of `window` rows, give or
take a cell of slots, packs each window by a plan of its own, within which ranks follow the order, and numbers the
sequences window by window; so a run of sequences holds what that stretch of the schedule holds.

Null and empty texts: one piece, the end id alone. Repeated rows: packed each, each by itself. A text of any length is
read whole, a very long one part by part; its ids are cut into pieces only beyond the capacity. Equal lengths are
dealt by a hash of the piece. Other columns are ignored, whatever their names. Empty table: no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwell.llm.common import bucket_rows, in_worker, map_arrow, materialize, small, table, with_rank
from siftwell.llm.token_counts import _SHORT, LETTERS, PLAIN, SIGNS, Cache, encode, text_groups


#: Slots whose rows stay in one window, and such cells whose rows are summed up together.
CELL, CELLS = 64, 4096

_WORD_ENDS = re.compile(rf"[{LETTERS}]+|{_SHORT}|[{SIGNS}]+|[0-9]")
_WORD = re.compile(rf"[{LETTERS}]+")


def word_cut(text: str) -> list[str]:
    """Pre-tokens of plain texts, in lower case as the vocabulary has them; else the runs between spaces."""
    return _WORD_ENDS.findall(text.lower()) if PLAIN.fullmatch(text) else text.split(" ")


class Ids(Cache):
    """Little-endian unsigned 32-bit ids; words are encoded many at a time, their ids told apart by the word ends."""

    def __init__(self, path: str):
        super().__init__(path, word_cut, lambda ids: np.array(ids, "<u4").tobytes(), limit=1 << 19)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for x, i in vocabulary.items() if x.endswith("</w>")]] = True

    def misses(self, new: list[str]) -> dict:
        out, words = {}, [x for x in new if _WORD.fullmatch(x)]
        lines = [words[a : a + 512] for a in range(0, len(words), 512)]
        for line, ids in zip(lines, encode(self.tokenizer, [" ".join(x) for x in lines])):
            at = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(at) == len(line):
                data = np.array(ids, "<u4").tobytes()
                out.update((x, data[a:b]) for x, a, b in zip(line, [0, *at], at))
        return out | super().misses([x for x in new if x not in out])

    def of(self, texts: list[str]) -> list[bytes]:
        return self.pieces(texts, b"".join) if len(texts) > 1 else [b"".join(self.pieces([x], b"".join)[0] for x in self.parts(t, True)) for t in texts]


def to_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, text_col: str, id_col: str, keep: list[str] = []) -> DataFrame:
    """A row per piece, with the columns `keep` of its document."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = in_worker(Ids, tokenizer_path)
        for b in rows:
            at, piece, start, length, crc = [], [], [], [], []
            i = -1
            for texts in text_groups(b.column(1)):
                for body in ids.of(texts):
                    i, body = i + 1, body + end
                    for k in range(0, len(body), 4 * capacity):
                        part = body[k : k + 4 * capacity]
                        at.append(i)
                        piece.append(k // 4 // capacity)
                        start.append(k // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), *(b.column(2 + k).take(at) for k in range(len(keep)))], names=["doc_id", "piece", "start", "length", "ids_crc32", *keep])

    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *keep), cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long{kinds}", ("Ids", tokenizer_path))


def fullest(left: dict[int, int], room: int) -> list[tuple[int, int]]:
    """The (length, times) with the largest sum up to `room`; lengths that are left, each as often as it is there."""
    lengths = sorted((x for x in left if x <= room), reverse=True)
    full, mask = 1 << room, (1 << (room + 1)) - 1
    reach, layers = 1, []
    for x in lengths:
        times, k = min(left[x], room // x), 1
        while times and not reach & full:
            k = min(k, times)
            layers.append((x, k, reach))
            reach |= (reach << (x * k)) & mask
            times -= k
            k *= 2
        if reach & full:
            break
    at, took = reach.bit_length() - 1, {}
    for x, k, before in reversed(layers):
        if not before >> at & 1:
            took[x] = took.get(x, 0) + k
            at -= x * k
    return sorted(took.items(), reverse=True)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, pieces of it in a bin, first bin, offset of the first), over all bins."""
    left, used, runs, bins = dict(counts), dict.fromkeys(counts, 0), [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        rest = fullest({x: n for x, n in left.items() if n} if longest < capacity else {}, capacity - longest)
        left[longest] += 1
        own = dict(rest)
        own[longest] = own.get(longest, 0) + 1
        times, offset = min(left[x] // m for x, m in own.items()), 0
        for x, m in sorted(own.items(), reverse=True):
            runs.append((x, used[x], m, bins, offset))
            used[x] += m * times
            offset += x * m
            left[x] -= m * times
            if not left[x]:
                del left[x]
        bins += times
    return runs


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    pieces = materialize(to_pieces(docs, tokenizer_path, capacity, end_id, "text", "doc_id", ["row"]), "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # `capacity` rows at most
    runs = sorted(plan(counts, capacity))
    keys = np.array([(x << 42) + rank for x, rank, *_ in runs], np.int64)
    rest = np.array([r[1:] for r in runs], np.int64).reshape(-1, 4)

    def place(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            length, rank = (b.column(c).to_numpy() for c in ("length", "rank"))
            first, times, base, offset = rest[np.searchsorted(keys, (length << 42) + rank, "right") - 1].T if len(length) else np.zeros((4, 0), np.int64)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(base + (rank - first) // np.maximum(times, 1)), pa.array(offset + (rank - first) % np.maximum(times, 1) * length)], names=[*names, "sequence_id", "offset"])

    salted = pieces.withColumn("_key", F.xxhash64("row", "piece"))  # repeated rows have rows of their own
    buckets = F.array(*[F.lit(1 + counts.get(x, 0) // bucket_rows(sum(counts.values()))) for x in range(capacity + 1)])
    ranked = with_rank(salted, ["length"], [F.col("_key"), F.col("row"), F.col("piece")], "rank", F.element_at(buckets, F.col("length").cast("int") + 1))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name != "row")
    return map_arrow(ranked.select(*[c for c in pieces.columns if c != "row"], "rank"), place, f"{schema}, sequence_id long, offset long")


def windows_of(docs: DataFrame, window: int) -> DataFrame:
    """_window of each _cell of CELL slots: rows are counted in the order of the slots, and a cell goes where its first row falls.

    A slot has a row for each lane at most, so a window has `window` rows and those of one cell. Running sums are taken
    within blocks of cells, and over the blocks' sums.
    """
    cells = docs.groupBy(F.expr(f"slot DIV {CELL}").alias("_cell")).agg(F.count("*").alias("_n")).withColumn("_block", F.expr(f"_cell DIV {CELLS}"))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = cells.groupBy("_block").agg(F.sum("_n").alias("_sum"))
    blocks = blocks.select("_block", F.coalesce(F.sum("_sum").over(earlier.orderBy("_block")), F.lit(0)).alias("_before"))  # a row for each CELL * CELLS slots
    inside = cells.withColumn("_in", F.coalesce(F.sum("_n").over(earlier.partitionBy("_block").orderBy("_cell")), F.lit(0)))
    return inside.join(blocks, "_block").select("_cell", F.expr(f"(_in + _before) DIV {window}").alias("_window"))


def pack_in_order(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, window: int = 8192, text_col: str = "text", id_col: str = "doc_id", slot_col: str = "slot", place_col: str = "place") -> DataFrame:
    """As pack, of documents with slot and place: sequence_id follows the slots, window by window."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(slot_col).alias("slot"), F.col(place_col).alias("place"))
    windows = windows_of(docs, window)
    pieces = to_pieces(docs, tokenizer_path, capacity, end_id, "text", "doc_id", ["slot", "place"]).withColumn("_cell", F.expr(f"slot DIV {CELL}"))
    pieces = pieces.join(small(windows, 48), "_cell").drop("_cell")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(t: pa.Table) -> pa.Table:
        t = t.sort_by([(c, "ascending") for c in ("length", "slot", "place", "piece")])
        length = t.column("length").to_numpy()
        kinds, first, counts = np.unique(length, return_index=True, return_counts=True)
        runs = sorted(plan(dict(zip(kinds.tolist(), counts.tolist())), capacity))
        keys = np.array([(x << 42) + rank for x, rank, *_ in runs], np.int64)
        rank = np.arange(len(length)) - np.repeat(first, counts)
        start, times, base, offset = np.array([r[1:] for r in runs], np.int64)[np.searchsorted(keys, (length << 42) + rank, "right") - 1].T
        own = {"sequence_id": pa.array(base + (rank - start) // times), "offset": pa.array(offset + (rank - start) % times * length)}
        return pa.table({c: t.column(c) for c in names} | own | {"_window": t.column("_window")})

    schema = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in names) + ", sequence_id long, offset long, _window long"
    placed = materialize(pieces.groupBy("_window").applyInArrow(place, schema), "pieces")
    sizes = placed.groupBy("_window").agg((F.max("sequence_id") + 1).alias("_bins"))  # a narrow row for each window
    before = sizes.select("_window", F.coalesce(F.sum("_bins").over(Window.orderBy("_window").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.join(small(before, 96), "_window").select(*names, (F.col("sequence_id") + F.col("_before")).alias("sequence_id"), "offset")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
