"""1. Token counts: a map-side two-tier lookup.

A text of plain characters (ASCII and Latin letters) is cut into pre-tokens by the vocabulary's own
pattern; other texts are cut only before a space that ends a run of white space, where that pattern
always cuts, into runs of whole pre-tokens. Either has a number of tokens that its neighbours don't
change. Tier one is a broadcast table, of a fixed number of entries, of the frequent pre-tokens' token
counts; tier two is a bounded cache in each Python worker, which outlives tasks and is filled by
encoding a batch's misses together. Texts and their pre-tokens are never shuffled. Tier one's entries are the most frequent
pre-tokens of about `sample` rows (a documented bound), counted where they are read; they never change a result.

Null text: empty, 0 tokens. A text with one of the tokenizer's special strings is encoded whole, by
the library's default; other very long texts are cut where pre-tokens end and taken part by part. Repeated
rows and doc_ids: a row each. Other columns are ignored, whatever their names. Empty table: no rows.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import batch, in_worker, map_arrow, steps, table, text_buffer

#: Letters, signs and white space on which this module's patterns and the vocabularies' agree.
LETTERS, SIGNS, WHITE = "A-Za-zÀ-ÖØ-öø-įı-ɏ", r"!-/:-@\[-`{-~", r" \n\t\r"
PLAIN = re.compile(rf"[{LETTERS}0-9{SIGNS}{WHITE}]*")
_SHORT = "'(?:s|t|re|ve|m|ll|d)"
_BYTE_LEVEL = re.compile(rf" ?[{LETTERS}]+|{_SHORT}| ?[{SIGNS}]+| ?[0-9]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
_SPACED_WORD = re.compile(rf" [{LETTERS}]+")
#: What any Unicode version counts as white space or may: cuts beside these are left to the library.
_SPACE = r"\s\x1c-\x1f\x85᠎​-‍⁠﻿"
_RUN = re.compile(rf"[{_SPACE}] (?:[{_SPACE}]|\Z)")
_CUT = re.compile(rf" (?=[^{_SPACE}])")
_SAFE = re.compile(rf"(?<=[^{_SPACE}]) (?=[^{_SPACE}])")
#: Characters of a text that are cut into pieces at a time.
LONG = 1 << 18

def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def special_strings(tokenizer) -> re.Pattern | None:
    found = [re.escape(x.content) for x in tokenizer.get_added_tokens_decoder().values()]
    return re.compile("|".join(found)) if found else None


def encode(tokenizer, texts: list[str]) -> list[list[int]]:
    run = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    return [e.ids for e in run(texts, add_special_tokens=False)]


def byte_level_cut(text: str) -> list[str]:
    if PLAIN.fullmatch(text):
        return _BYTE_LEVEL.findall(text)
    first, *rest = _CUT.split(text) if _RUN.search(text) else text.split(" ")
    return [first, *(" " + x for x in rest)]


class Cache:
    """What `measure` makes of the ids of cut pieces; `limit` entries at most, pieces longer than `longest` aren't kept.

    Entries are of two generations: when the young one is full it becomes the old one, whose entries come back as they
    are asked for, so frequent pieces stay.
    """

    def __init__(self, path: str, cut: Callable[[str], list[str]], measure: Callable, limit: int = 1 << 19, longest: int = 96):
        self.tokenizer, self.cut, self.measure, self.limit, self.longest = load_tokenizer(path), cut, measure, limit, longest
        self.special, self.first, self.known, self.old = special_strings(self.tokenizer), {}, {}, {}

    def start(self, first: dict) -> Cache:
        self.first = first
        self.known.update(first)
        return self

    def misses(self, new: list[str]) -> dict:
        return dict(zip(new, map(self.measure, encode(self.tokenizer, new))))

    def parts(self, text: str, drop_space: bool = False) -> Iterator[str]:
        """A long text in parts that end where pre-tokens do: before a space between two other characters."""
        a = 0
        if not (self.special and self.special.search(text)):
            while len(text) - a > LONG:
                m = _SAFE.search(text, a + LONG)
                if not m:
                    break
                yield text[a : m.start()]
                a = m.start() + drop_space
        yield text[a:]

    def pieces(self, texts: list[str], fold: Callable) -> list:
        """For each text the measures of its pieces, folded."""
        cut = [[t] if self.special and self.special.search(t) else self.cut(t) if t else [] for t in texts]
        new = set(filterfalse(self.known.__contains__, chain.from_iterable(cut)))
        if len(self.known) + len(new) > self.limit // 2:
            self.old, self.known = self.known, dict(self.first)
            new = set().union(*cut) - self.known.keys()
        if self.old:
            back = {x: self.old[x] for x in new if x in self.old}
            self.known.update(back)
            new.difference_update(back)
        self.known.update(self.misses(list(new)))
        get = self.known.__getitem__
        out = [fold(map(get, c)) for c in cut]
        for x in new:
            if len(x) > self.longest:
                del self.known[x]
        return out


class Lookup(Cache):
    """Token counts; words behind a space are encoded many at a time, their tokens told apart by the space's sign."""

    def __init__(self, path: str):
        super().__init__(path, byte_level_cut, len)
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for x, i in vocabulary.items() if x.startswith("Ġ")]] = True

    def misses(self, new: list[str]) -> dict:
        out, words = {}, [x for x in new if _SPACED_WORD.fullmatch(x)]
        lines = [words[a : a + 512] for a in range(0, len(words), 512)]
        for line, ids in zip(lines, encode(self.tokenizer, ["".join(x) for x in lines])):
            at = np.flatnonzero(self.begins[ids])
            if len(at) == len(line):
                out.update(zip(line, np.diff(at, append=len(ids)).tolist()))
        return out | super().misses([x for x in new if x not in out])

    def counts(self, texts: list[str]) -> list[int]:
        return self.pieces(texts, sum) if len(texts) > 1 else [sum(self.pieces([x], sum)[0] for x in self.parts(t)) for t in texts]


def frequent_pieces(docs: DataFrame, text_col: str, entries: int, sample: int) -> list[str]:
    """The most frequent pre-tokens of about `sample` rows; `entries` at most.

    Rows are counted where they are read; a task passes on its `entries` most frequent pieces, and the tasks' lists are added up by Spark.
    """

    def summary(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in rows:
            for text in b.column(0).to_pylist():
                for a in range(0, len(text or ""), LONG):
                    seen.update(byte_level_cut(text[a : a + LONG]))
                    if len(seen) > 32 * entries:
                        seen = Counter(dict(seen.most_common(4 * entries)))
        top = [x for x in seen.most_common(entries) if len(x[0]) <= 32]
        yield batch([("piece", pa.string()), ("n", pa.int64())], [x for x, _ in top], [n for _, n in top])

    texts = docs.select(F.col(text_col).alias("text"))
    counted = map_arrow(texts.sample(min(1.0, sample / max(1, docs.count())), 1), summary, "piece string, n long")
    found = counted.groupBy("piece").agg(F.sum("n").alias("n")).filter("n > 1").orderBy(F.desc("n"), "piece").limit(entries)
    return [r.piece for r in found.collect()]


def text_groups(column: pa.Array) -> Iterator[list[str]]:
    """Texts of about half a megabyte together; a long one by itself. A null is an empty text."""
    column = pc.fill_null(column, "")
    for i, j in steps(text_buffer(column)[1]):
        yield column.slice(i, j - i).to_pylist()


def token_counts(docs: DataFrame, tokenizer_path: str, text_col: str = "text", id_col: str = "doc_id", entries: int = 8192, sample: int = 4096) -> DataFrame:
    """doc_id, n_bytes and n_tokens of each row; `entries` bounds the broadcast table, `sample` the rows that choose it."""
    frequent = [x for x in frequent_pieces(docs, text_col, entries, sample) if "\x00" not in x]
    sizes = np.array([len(x) for x in encode(load_tokenizer(tokenizer_path), frequent)], np.uint16)
    tier = docs.sparkSession.sparkContext.broadcast(("\x00".join(frequent), sizes.tobytes()))
    kind = docs.schema[id_col].dataType.simpleString()

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sizes = tier.value
        n = np.frombuffer(sizes, np.uint16).tolist()
        lookup = in_worker(Lookup, tokenizer_path).start(dict(zip(names.split("\x00"), n)) if n else {})
        for b in rows:
            found = [n for texts in text_groups(b.column(1)) for n in lookup.counts(texts)]
            yield pa.RecordBatch.from_arrays([b.column(0), pc.cast(pc.binary_length(pc.fill_null(b.column(1), "")), pa.int64()), pa.array(found, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), count, f"doc_id {kind}, n_bytes long, n_tokens long", ("Lookup", tokenizer_path))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)
