"""5. Quality classifier: random indexing, pooled, and a two-layer network.

Every word has a sparse random index vector (a function of its hash) and a context vector: the sum of the
index vectors of the words beside it, over all training rows' texts (labelled or not), for `BUCKETS` hashed words.
How a word is written (case, ends, digits, length) has a random vector too. A document is the mean of its words'
vectors, by kind, with its length and its shares of repeated words, windows and lines; a numpy network with one
hidden layer scores it, and a temperature fitted on a tenth of the training rows calibrates the probability.
`kinds` leaves out features, to see what each gives (the README has the accuracies).

The fit reads `sample` labelled training rows, about, chosen by hash (documented bound); the context vectors and
the scores read every whole text. Labels, lang, source and doc_id are no inputs. Null and empty texts have no words
and score by the length word alone. Repeated rows score alike. Without labelled rows every score is 0.5. Labels that
are null, repeated or without a document are left out (of repeated ones the smallest is used). A very long text is
taken word slice by word slice; what is held of it are a few numbers a word. Empty table: no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import WHITE, free, map_arrow, mix, steps, table, text_buffer, word_hashes, word_hashes_at

BUCKETS, DIMS, HIDDEN, SHAPES = 8192, 64, 32, 2048
FEATURES = 2 * DIMS + 6
#: Where each kind of feature is.
KINDS = {"context": slice(0, DIMS), "shape": slice(DIMS, 2 * DIMS), "counts": slice(2 * DIMS, FEATURES)}
#: Words whose vectors are gathered at a time; rows of the context table that travel together.
SLICE, ROWS, FAN = 1 << 15, 512, 128
_SIGN, _UPPER, _LETTER, _DIGIT, _LINE = (np.zeros(256, bool) for _ in range(5))
_SIGN[list(b".,;:!?\"'()[]{}<>|#*$%&-_/\\=+~@^`")] = True
_UPPER[65:91] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = _DIGIT[48:58] = _LINE[10] = True


def index_vectors(n: int, seed: int) -> np.ndarray:
    """Sparse ternary vectors: four +1 and four -1 of DIMS."""
    at, out = index_places(n, seed), np.zeros((n, DIMS), np.float32)
    np.put_along_axis(out, at[:, :4], 1, 1)
    np.put_along_axis(out, at[:, 4:], -1, 1)
    return out


def index_places(n: int, seed: int) -> np.ndarray:
    """Where each of n index vectors has its +1 (four) and its -1 (four)."""
    return np.random.default_rng(seed).random((n, DIMS)).argsort(1, kind="stable")[:, :8]


def shapes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How each word is written, as a number below SHAPES: case, its first sign and last two, digits, length."""
    total = lambda mask: np.add.reduceat(mask[data], starts, dtype=np.int32)  # noqa: E731  white space between words counts nowhere
    upper, letters, size = total(_UPPER), total(_LETTER), total(~WHITE)
    last = starts + size - 1
    sign = lambda at: np.where(_SIGN[data[at]], data[at], 0).astype(np.uint64)
    case = np.where(letters == 0, 0, np.where((upper == letters) & (letters > 1), 1, np.where(_UPPER[data[starts]], 2, 3)))
    code = case.astype(np.uint64) | (sign(starts) << np.uint64(8)) | (sign(last) << np.uint64(16)) | (sign(np.maximum(last - 1, starts)) << np.uint64(24))
    code |= ((total(_DIGIT) > 0).astype(np.uint64) << np.uint64(32)) | (np.minimum(np.ceil(np.log2(size)), 6).astype(np.uint64) << np.uint64(40))
    return (mix(code) % np.uint64(SHAPES)).astype(np.int64)


def distinct(keys: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """How many different keys each of n rows has."""
    _, at = np.unique(mix(keys ^ mix(row.astype(np.uint64))), return_index=True)
    return np.bincount(row[at], minlength=n)


class Pooler:
    """Texts to features; `context`: BUCKETS x DIMS."""

    def __init__(self, context: np.ndarray | None):
        self.context, self.shapes = context, index_vectors(SHAPES, 2)

    def features(self, column: pa.Array) -> np.ndarray:
        data, at = text_buffer(column)
        return np.concatenate([np.zeros((0, FEATURES), np.float32), *(self._step(data[at[i] : at[j]], at[i : j + 1] - at[i]) for i, j in steps(at))])

    def _step(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        n, out = len(at) - 1, np.zeros((len(at) - 1, FEATURES), np.float32)
        h, first, starts = word_hashes_at(data, at)
        words = np.diff(first)
        row, many = np.repeat(np.arange(n), words), np.maximum(words, 1)
        lines, line_first = word_hashes(data, at, False, _LINE)
        n_lines = np.diff(line_first)
        tail = out[:, KINDS["counts"]]
        tail[:, 0], tail[:, 4], tail[:, 5] = np.log1p(words) / 8, np.log1p(n_lines) / 6, words == 0
        tail[:, 1] = 1 - distinct(lines, np.repeat(np.arange(n), n_lines), n) / np.maximum(n_lines, 1) if len(lines) else 0
        for a in range(0, len(h), SLICE):
            own, end = slice(a, a + SLICE), starts[a + SLICE] if a + SLICE < len(h) else len(data)
            shaped = shapes(data[starts[a] : end], starts[own] - starts[a])
            for k, (kinds, ids, vectors) in enumerate(((BUCKETS, (h[own] % np.uint64(BUCKETS)).astype(np.int64), self.context), (SHAPES, shaped, self.shapes))):
                seen, times = np.unique(row[own] * kinds + ids, return_counts=True)
                doc, pooled = seen // kinds, vectors[seen % kinds] * times[:, None].astype(np.float32)
                cut = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                out[doc[cut], k * DIMS : (k + 1) * DIMS] += np.add.reduceat(pooled, cut)
        out[:, : 2 * DIMS] /= many[:, None]
        if len(h):
            tail[:, 2] = np.where(words > 0, 1 - distinct(h, row, n) / many, 0)
            t = np.flatnonzero(row[2:] == row[:-2]) if len(row) > 2 else np.zeros(0, np.int64)
            if len(t):
                three = h[t] * np.uint64(3) + mix(h[t + 1]) * np.uint64(5) + mix(mix(h[t + 2]))
                tail[:, 3] = np.where(words > 2, 1 - distinct(three, row[t], n) / np.maximum(words - 2, 1), 0)
        return out


def neighbour_sums(column: pa.Array, total: np.ndarray, places: np.ndarray) -> None:
    """Adds to each word's row of `total` the index vectors of the two words to either side."""
    data, at = text_buffer(column)
    for i, j in steps(at):
        h, first = word_hashes(data[at[i] : at[j]], at[i : j + 1] - at[i])
        b, row = (h % np.uint64(BUCKETS)).astype(np.int64), np.repeat(np.arange(j - i), np.diff(first))
        for a in range(0, len(b), 8 * SLICE):
            x, y = [], []
            for d in (1, 2):
                k = a + np.flatnonzero(row[a + d : a + d + 8 * SLICE] == row[a : a + 8 * SLICE][: max(0, len(row) - a - d)])
                x += [b[k], b[k + d]]
                y += [b[k + d], b[k]]
            x, y = np.concatenate(x) * DIMS, np.concatenate(y)
            for c in range(8):
                got = np.bincount(x + places[y, c], minlength=BUCKETS * DIMS).reshape(BUCKETS, DIMS)
                np.add(total, got, total) if c < 4 else np.subtract(total, got, total)


def sums_packed(total: np.ndarray) -> bytes:
    """Zigzag, byte by byte: of small numbers the high bytes are zero and compress."""
    zigzag = ((total << 1) ^ (total >> 63)).astype("<u8").ravel()
    return np.ascontiguousarray(zigzag.view(np.uint8).reshape(-1, 8).T).tobytes()


def sums_unpacked(packed: bytes | pa.Buffer) -> np.ndarray:
    z = np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(8, -1).T).view("<u8").ravel()
    return (z >> np.uint64(1)).astype(np.int64) ^ -(z & np.uint64(1)).astype(np.int64)


def context_vectors(texts: DataFrame) -> np.ndarray:
    """BUCKETS x DIMS, each row of length one (or zero), from all rows of a one-column table.

    A task sends its sums once; FAN tasks meet in a group, FAN of those groups in the next, so that a group holds FAN sums of
    ROWS words at most, up to FAN ** 3 tasks.
    """

    def sums(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = TaskContext.get().partitionId() // FAN
        total, places = np.zeros((BUCKETS, DIMS), np.int64), index_places(BUCKETS, 1)
        for b in rows:
            neighbour_sums(b.column(0), total, places)
        for k in range(0, BUCKETS, ROWS):
            part = total[k : k + ROWS]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([of], pa.int32()), pa.array([sums_packed(part)], pa.binary())], names=["k", "of", "v"])

    def added(t: pa.Table) -> pa.Table:
        total = np.zeros(ROWS * DIMS, np.int64)
        for v in t.column("v"):
            total += sums_unpacked(v.as_buffer())
        return pa.table({"k": t.column("k")[:1], "of": pa.array([t.column("of")[0].as_py() // FAN], pa.int32()), "v": pa.array([sums_packed(total)], pa.binary())})

    kinds = "k int, of int, v binary"
    found = map_arrow(texts, sums, kinds)
    for _ in range(3):
        found = found.groupBy("k", "of").applyInArrow(added, kinds)
    out = np.zeros((BUCKETS, DIMS), np.int64)
    for r in found.toLocalIterator():  # a row of a fixed size for each BUCKETS / ROWS, and for each FAN ** 3 tasks
        out[r.k : r.k + ROWS] += sums_unpacked(r.v).reshape(-1, DIMS)
    out = out.astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6)


def _forward(net: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = np.maximum((x - net["mean"]) / net["sd"] @ net["w1"] + net["b1"], 0)
    return h, h @ net["w2"] + net["b2"]


def probability(net: dict, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_forward(net, x)[1] / net["t"], -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 1, epochs: int = 40, step: float = 3e-3) -> dict:
    """Two layers by Adam on the log loss; then the temperature that suits the rows that were set apart."""
    rng = np.random.default_rng(seed)
    apart = rng.random(len(x)) < 0.1
    if len(set(y[apart])) < 2:
        apart[:] = False
    own, z = np.flatnonzero(~apart), y.astype(np.float64)
    net = {"mean": x[own].mean(0), "sd": x[own].std(0) + 1e-3, "t": 1.0}
    net |= {"w1": rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN), "w2": rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN), "b2": 0.0}
    m, v, k = {p: 0.0 for p in ("w1", "b1", "w2", "b2")}, {p: 0.0 for p in ("w1", "b1", "w2", "b2")}, 0
    for _ in range(epochs):
        rng.shuffle(own)
        for a in range(0, len(own), 256):
            i = own[a : a + 256]
            xi = (x[i] - net["mean"]) / net["sd"]
            h, s = _forward(net, x[i])
            d = (1 / (1 + np.exp(-np.clip(s, -40, 40))) - z[i]) / len(i)
            dh = np.outer(d, net["w2"]) * (h > 0)
            g = {"w1": xi.T @ dh + 1e-4 * net["w1"], "b1": dh.sum(0), "w2": h.T @ d + 1e-4 * net["w2"], "b2": d.sum()}
            k += 1
            for p in g:
                m[p], v[p] = 0.9 * m[p] + 0.1 * g[p], 0.999 * v[p] + 0.001 * g[p] ** 2
                net[p] = net[p] - step * m[p] / (1 - 0.9**k) / (np.sqrt(v[p] / (1 - 0.999**k)) + 1e-8)
    if apart.any():
        s, t = _forward(net, x[apart])[1], z[apart]
        loss = {h: np.mean(np.logaddexp(0, s / h) - t * s / h) for h in np.geomspace(0.5, 8, 40)}
        net["t"] = min(loss, key=loss.get)
    return net


def train(docs: DataFrame, labels: DataFrame, training: Column, sample: int = 20_000, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality", kinds: tuple[str, ...] = tuple(KINDS)) -> dict:
    """{'context', 'net', 'kinds'}; training: over doc_id, which rows may teach. About `sample` labelled rows, by hash."""
    sc = docs.sparkSession.sparkContext
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter(training)
    context = context_vectors(docs.select("text"))
    shared = sc.broadcast(context)
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter(training & F.col("y").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("y").alias("y"))
    n = known.count()
    if n > sample:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * sample / n))
    taught = docs.join(F.broadcast(known), "doc_id")  # `sample` ids, about
    if (n := taught.count()) > 2 * sample:  # ids that many rows have
        taught = taught.filter(F.rand(7) < sample / n)

    def features(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = Pooler(shared.value)
        for b in rows:
            x = pool.features(b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "y", "x"])

    def learn(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((repr(i), y, x) for b in rows for i, y, x in zip(*(c.to_pylist() for c in b.columns)))
        y = np.array([r[1] for r in found])
        net = fit(chosen(np.array([np.frombuffer(r[2], np.float32) for r in found]), kinds), y) if len(set(y.tolist())) == 2 else None
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], names=["net"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = map_arrow(taught.select("doc_id", "y", "text"), features, f"doc_id {kind}, y int, x binary")
    net = map_arrow(made.repartition(1), learn, "net binary").collect()  # the bounded sample's features meet in one task
    shared.unpersist()
    return {"context": context, "net": pickle.loads(net[0].net) if net else None, "kinds": kinds}


def chosen(x: np.ndarray, kinds: tuple[str, ...]) -> np.ndarray:
    return np.concatenate([x[:, KINDS[k]] for k in kinds], axis=1)


def score(docs: DataFrame, model: dict, text_col: str = "text", keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """The columns `keep` (all, unless given) and `name`, the probability of label 1; no kept column may have that name."""
    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    own = free(keep, "text_to_score")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        pool = Pooler(model["context"])
        for b in rows:
            x = pool.features(b.column(b.num_columns - 1))
            p = probability(model["net"], chosen(x, model["kinds"])) if model["net"] and len(x) else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(p, pa.float64())], names=[*keep, name])

    return map_arrow(docs.select(*keep, F.col(text_col).alias(own)), run, f"{schema}, `{name}` double")


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), ~held_out())
    out = score(docs, model, keep=["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
