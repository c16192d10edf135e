"""12. Periodic runs of words, by Crochemore's partition refinement.

The texts of a batch are one string of word codes, each text closed by a sign of its own. Level by level, positions are
classed by the factor of that length which begins there. A class splits by the classes that its positions' successors have
moved to; of the parts of a split class all but the largest work on at the next level (the smaller half), so a position is moved
O(log n) times. Each class is a list by position; neighbours at a distance equal to the level are a square with a
primitive root, and squares at neighbouring positions are merged into a maximal run.

The squares of a run of `times` periods have `times` - 1 members at least in their classes, so smaller classes are not split
further, nor are texts beyond a level of their length / `times`; neither loses a run. Words are told apart exactly, by a dictionary of the batch.

Null, empty and blank texts: no words, no runs, an empty collapsed text. A text of any length is one task's work, of
O(n log n) steps and about 60 bytes a word. Repeated rows and ids: a row each. Other columns are ignored, whatever
their names. Runs may overlap; each is returned, by start, then period. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import WHITE, map_arrow, steps, table, text_buffer

#: Bytes of text whose words are one string, one text at least; words that are copied at a time.
GROUP, COPIED = 2 << 20, 1 << 17
#: Up to so many positions are moved one by one.
FEW = 48


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the words' bytes in a row, where each begins there, the first word of each text)."""
    word = ~WHITE[data]
    opens, ends = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    bounds = offsets[1:-1]
    bounds = bounds[(bounds > 0) & (bounds < len(data))]
    opens[bounds] = word[bounds]
    ends[bounds - 1] = word[bounds - 1]
    starts = np.flatnonzero(opens)
    lengths = np.flatnonzero(ends) + 1 - starts
    return data[word], np.concatenate([[0], np.cumsum(lengths)]), np.searchsorted(starts, offsets)


def codes_of(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number for each word, the same for the same words."""
    words = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def spaced(data: np.ndarray, at: np.ndarray, chosen: np.ndarray) -> Iterator[np.ndarray]:
    """The chosen words, each behind one space; COPIED of them at a time."""
    for k in range(0, len(chosen), COPIED):
        some = chosen[k : k + COPIED]
        sizes = at[some + 1] - at[some] + 1
        ends = np.cumsum(sizes)
        begins = ends - sizes
        out = data[np.maximum(np.repeat(at[some] - 1 - begins, sizes) + np.arange(ends[-1]), 0)]
        out[begins] = 32
        yield out


class Classes:
    """Positions by the factor that begins there, as ranges of `members`; in each class a position knows its neighbours."""

    def __init__(self, keys: np.ndarray):
        n = len(keys)
        _, of, size = np.unique(keys, return_inverse=True, return_counts=True)
        self.of, self.known = of.astype(np.int32), len(size)
        self.members = np.argsort(self.of, kind="stable").astype(np.int32)
        self.place = np.empty(n, np.int32)
        self.place[self.members] = np.arange(n, dtype=np.int32)
        self.size, self.begin = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.size[: self.known] = size
        self.begin[: self.known] = np.cumsum(size) - size
        self.next, self.before = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        self.chain(self.members, self.of[self.members])
        self.leaves = np.zeros(n, bool)

    def chain(self, x: np.ndarray, group: np.ndarray) -> None:
        """Positions in ascending order within each group become that group's list."""
        same = group[1:] == group[:-1]
        self.next[x], self.before[x] = -1, -1
        self.next[x[:-1][same]], self.before[x[1:][same]] = x[1:][same], x[:-1][same]

    def refine(self, x: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Splits the classes of the ascending positions x by the numbers `by`. (The parts that work on, all that have new neighbours.)"""
        nothing = np.zeros(0, np.int32)
        if not len(x):
            return nothing, nothing
        key = self.of[x].astype(np.int64) * len(self.of) + by
        order = np.argsort(key, kind="stable")
        x, key = x[order], key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))  # of each part
        sizes = np.diff(first, append=len(x))
        parent = self.of[x[first]]
        opens = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))  # of each class's parts
        parts = np.diff(opens, append=len(parent))
        moved = np.add.reduceat(sizes, opens)
        rest = self.size[parent[opens]] - moved
        split = (parts > 1) | (rest > 0)
        if not split.all():
            kept = np.repeat(np.repeat(split, parts), sizes)
            part = np.repeat(split, parts)
            x, sizes, parent = x[kept], sizes[part], parent[part]
            parts, moved, rest = parts[split], moved[split], rest[split]
            if not len(x):
                return nothing, nothing
            first, opens = np.cumsum(sizes) - sizes, np.cumsum(parts) - parts
        classes = parent[opens]

        # what leaves a class goes out of its list; chains of such positions are closed as one
        leaves = np.argsort(np.repeat(parent, sizes).astype(np.int64) * len(self.of) + x)
        y = x[leaves]
        tied = np.concatenate([[False], self.next[y[:-1]] == y[1:], [False]])
        p, s = self.before[y[~tied[:-1]]], self.next[y[~tied[1:]]]
        has_p, has_s = p >= 0, s >= 0
        self.next[p[has_p]], self.before[s[has_s]] = s[has_p], p[has_s]
        self.chain(x, np.repeat(np.arange(len(sizes)), sizes))

        # its range: what leaves comes first, part by part
        front = np.repeat(self.begin[classes] - (np.cumsum(moved) - moved), moved) + np.arange(len(x))
        there, mine = self.members[front], self.place[x] < np.repeat(self.begin[classes] + moved, moved)
        self.leaves[x] = True
        displaced, freed = there[~self.leaves[there]], self.place[x[~mine]]  # as many in each class
        self.leaves[x] = False
        self.members[freed], self.place[displaced] = displaced, freed
        self.members[front], self.place[x] = x, front

        # numbers: the rest keeps the class's, or the largest part where nothing is left
        largest = opens + _argmax(sizes, opens)
        whole = rest == 0
        fresh = np.ones(len(sizes), bool)
        fresh[largest[whole]] = False
        number = parent.copy()
        number[fresh] = self.known + np.arange(int(fresh.sum()))
        self.known += int(fresh.sum())
        starts = np.repeat(self.begin[classes] - first[opens], parts) + first
        after = self.begin[classes] + moved
        left = classes[~whole]
        self.begin[left], self.size[left] = after[~whole], rest[~whole]
        self.begin[number], self.size[number] = starts, sizes
        self.of[x] = np.repeat(number, sizes)

        # the largest of the parts and the rest does not work on
        idle = np.zeros(len(sizes), bool)
        by_part = sizes[largest] > rest
        idle[largest[by_part]] = True
        works = [x[~np.repeat(idle, sizes)]]
        smaller = by_part & (rest > 0)
        for a, n in zip(after[smaller].tolist(), rest[smaller].tolist()):
            works.append(self.members[a : a + n])
        return np.sort(np.concatenate(works)), np.concatenate([x, p[has_p]])


    def refine_few(self, xs: list[int], by: list[int]) -> tuple[list[int], list[int]]:
        """As refine, position by position: for a few, arrays would cost more than they save."""
        of, size, begin, members, place, after, before = (memoryview(v) for v in (self.of, self.size, self.begin, self.members, self.place, self.next, self.before))
        classes: dict[int, dict[int, list[int]]] = {}
        for x, k in zip(xs, by):
            classes.setdefault(of[x], {}).setdefault(k, []).append(x)
        works, touched = [], []
        for c, found in classes.items():
            parts = list(found.values())
            rest, at = size[c] - sum(map(len, parts)), begin[c]
            if len(parts) == 1 and not rest:
                continue
            largest = max(parts, key=len)
            for part in parts:
                last = -1
                for x in part:
                    p, s = before[x], after[x]
                    if p >= 0:
                        after[p] = s
                        touched.append(p)
                    if s >= 0:
                        before[s] = p
                    z, k = members[at], place[x]
                    members[k], place[z], members[at], place[x] = z, k, x, at
                    at += 1
                for x in part:
                    before[x], after[x] = last, -1
                    if last >= 0:
                        after[last] = x
                    last = x
                number = c
                if rest or part is not largest:
                    number, self.known = self.known, self.known + 1
                begin[number], size[number] = at - len(part), len(part)
                for x in part:
                    of[x] = number
                touched += part
                if part is not largest or len(part) <= rest:
                    works += part
            if rest:
                begin[c], size[c] = at, rest
                if rest < len(largest):
                    works += members[at : at + rest].tolist()
        return sorted(works), touched


def _argmax(values: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """In each stretch of values that opens there, the place of the first largest, from its opening."""
    most = np.repeat(np.maximum.reduceat(values, opens), np.diff(opens, append=len(values)))
    at = np.flatnonzero(values == most)
    stretch = np.searchsorted(opens, at, "right") - 1
    return at[np.searchsorted(stretch, np.arange(len(opens)))] - opens


def runs_of(codes: np.ndarray, first: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """Rows (text, start, length, period) of the maximal runs of max(least, times * period) words at least; sorted."""
    texts, sizes = len(first) - 1, np.diff(first)
    text = np.repeat(np.arange(texts), sizes + 1)
    signs = first[1:] + np.arange(texts)
    keys = np.empty(len(text), np.int64)
    keys[signs] = codes.max(initial=0) + 1
    word = np.ones(len(text), bool)
    word[signs] = False
    keys[word] = codes
    keys += text * (codes.max(initial=0) + 2)
    classes, most = Classes(keys), (sizes // times).astype(np.int32)[text]
    members = max(2, times - 1)  # that a class has at least, where it holds a square of such a run
    calendar: dict[int, list] = {}

    def enter(x: np.ndarray, level: int) -> None:
        """Positions whose distance to the next of the class can become a period, under that distance."""
        gap = classes.next[x] - x
        x, gap = (v[(gap >= level) & (gap <= most[x]) & (classes.size[classes.of[x]] >= members)] for v in (x, gap))
        order = np.argsort(gap, kind="stable")
        x, gap = x[order], gap[order]
        cuts = np.flatnonzero(np.diff(gap)) + 1
        for some, distance in zip(np.split(x, cuts), gap[np.concatenate([[0], cuts])].tolist() if len(x) else []):
            calendar.setdefault(distance, []).append(some)

    every = np.arange(len(keys), dtype=np.int32)
    enter(every, 1)
    works, level, found = every, 1, []
    of, size, after, most_of = (memoryview(v) for v in (classes.of, classes.size, classes.next, most))
    while calendar or len(works):
        if level in calendar:
            x = np.unique(np.hstack(calendar.pop(level)))
            x = x[classes.next[x] == x + level]
            if len(x):
                opens = np.flatnonzero(np.concatenate([[True], np.diff(x) > 1]))
                last = x[np.append(opens[1:], len(x)) - 1]
                length = last - x[opens] + 2 * level
                long = length >= max(least, times * level)
                start = x[opens][long]
                found.append(np.stack([text[start], start - first[text[start]] - text[start], length[long], np.full(len(start), level)], 1))
        if not len(works):
            level = min(calendar, default=level)
            continue
        if len(works) <= FEW:
            works = works if isinstance(works, list) else works.tolist()
            xs = [w - 1 for w in works if w and most_of[w - 1] > level and size[of[w - 1]] >= members]
            works, touched = classes.refine_few(xs, [of[x + 1] for x in xs])
            for x in touched:
                gap = after[x] - x
                if level < gap <= most_of[x] and size[of[x]] >= members:
                    calendar.setdefault(gap, []).append(x)
        else:
            works = np.asarray(works, np.int32)
            x = works[works > 0] - 1
            x = x[(most[x] > level) & (classes.size[classes.of[x]] >= members)]
            works, touched = classes.refine(x, classes.of[x + 1])
            enter(touched, level + 1)
        level += 1
    out = np.concatenate(found).astype(np.int64) if found else np.zeros((0, 4), np.int64)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(docs: DataFrame, least: int = 6, times: int = 4, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; numbers of words) and collapsed: the text's words, joined by a space,
    without those that a run holds after its first period."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            every, offsets = text_buffer(b.column(1))
            for i, j in steps(offsets, GROUP):
                data, at, first = words_of(every[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                runs = runs_of(codes_of(data, at), first, least, times)
                change = np.zeros(len(at), np.int32)
                np.add.at(change, first[runs[:, 0]] + runs[:, 1] + runs[:, 3], 1)
                np.add.at(change, first[runs[:, 0]] + runs[:, 1] + runs[:, 2], -1)
                kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
                text = b"".join(x.tobytes() for x in spaced(data, at, kept))
                ends = np.concatenate([[0], np.cumsum(at[kept + 1] - at[kept] + 1)])[np.searchsorted(kept, first)]
                collapsed = pa.array([text[x + 1 : y] for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary()).cast(pa.string())
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(runs[:, 0], np.arange(j - i + 1)).astype(np.int32)), pa.StructArray.from_arrays([pa.array(runs[:, k].copy()) for k in (1, 2, 3)], fields=list(RUNS.value_type)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(np.diff(first).astype(np.int64)), lists, collapsed], names=["doc_id", "n_words", "runs", "collapsed"])

    schema = f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, schema)


def made_periodic(doc_id: Column, text: Column) -> Column:
    """The contract's change of a tenth of the texts, chosen by their id: from some word on, the words repeat with a period."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    changed = (F.pmod(h, F.lit(10)) == 0) & text.rlike(r"[^\x20\x09-\x0D]")
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    g = F.floor(h / 10)

    def repeated(found: Column) -> Column:
        n = F.size(found)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        again = F.flatten(F.array_repeat(F.slice(found, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(found, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")

    # one element, so that the words are split once
    return F.when(changed, F.transform(F.array(words), repeated)[0]).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_runs(docs.withColumn("text", made_periodic(F.col("doc_id"), F.col("text"))))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n"))), "")
    found = found.withColumn("best", best).withColumn("lines", lines)
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
