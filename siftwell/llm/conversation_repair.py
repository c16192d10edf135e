"""13. Conversation structure repair: a Viterbi path through the grammar ``(s?(ua)+)?`` of each conversation.

Rows are read by turn (nulls first; of one turn by role, then text). A row's first fault counts: blank (without a word),
duplicate (its role and text stood there before), truncated (it doesn't end a sentence). Edits: keep a row whose role's initial
goes on (0), rerole it to user or assistant, whichever goes on (1), delete it (2; blank and duplicate rows have to go), insert
an empty row of that role (5); a truncated row that stays adds 5. Between rows a layer holds, for each of four states (nothing yet,
after system, user, assistant), the least (cost, audit string of the edits' initials); inserts close it, three in a row
at most, as more come back to a state. Paths of one state and cost have as many rows behind them, so none is the beginning of another,
and what is less stays less. Of an audit only what paths may still differ in is compared: its beginning is kept apart, by rank.

Conversations are dealt by id and sorted by Spark; a task reads them as they come and holds, of a conversation, its
audit and four running digests, however long it is. Earlier rows of the same words are found by digest in a pass of their own, so
no task holds a conversation's texts. A conversation with very many rows is one task's stream, since the digest of its repair
is one sequence. Null roles and texts are one space (so such a text is blank); a null turn comes first and counts in
no gap; the null id is a conversation. An empty role has no initial and can't be kept. Repeated rows are duplicates of the first. Very long texts are read whole, one at a time.
Other columns are ignored, whatever their names. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from siftwell.llm.common import map_arrow, small, table

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: State: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. By state and initial the next state; the role that goes on.
GOES_ON = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
ENDS = (0, 3)
#: A state whose cost exceeds the least by more can't be on a cheapest path: from any state so much leads to where another would be.
HOPELESS = 2 * INSERT + DELETE
#: Edits after which the audits' beginnings are put away.
FREEZE = 256

FAULTS = ("blank", "duplicate", "truncated")


def fault_of(text: str, repeated: bool) -> str | None:
    text = text.rstrip(" \t\n\x0b\x0c\r")
    if not text:
        return "blank"
    if repeated:
        return "duplicate"
    return None if text[-1] in ".!?" else "truncated"


class Path(NamedTuple):
    """The best way to a state: its cost, its audit (the rank of the beginning put away, the rest), what it carries."""

    cost: int
    rank: int
    audit: str
    node: tuple | None  # what was put away: (node before, part)
    tape: object


class Repair:
    """The layers of one conversation. `tape` has add(role, text) -> a new tape: what a path has kept or inserted."""

    def __init__(self, tape):
        self.rows = 0
        self.layer = self.closed({0: Path(0, 0, "", None, tape)})

    @staticmethod
    def closed(layer: dict[int, Path]) -> dict[int, Path]:
        for _ in range(3):
            changed = False
            for state in sorted(layer):
                path = layer[state]
                role, into = WANTED[state]
                key = (path.cost + INSERT, path.rank, path.audit + "I")
                if into not in layer or key < layer[into][:3]:
                    layer[into] = Path(*key, path.node, path.tape.add(role, ""))
                    changed = True
            if not changed:
                break
        return layer

    def feed(self, role: str, text: str, fault: str | None) -> None:
        best: dict[int, tuple] = {}
        extra = TRUNCATED if fault == "truncated" else 0
        for state, path in self.layer.items():
            ways = [(DELETE, "D", state, None)]
            if fault not in ("blank", "duplicate"):
                if (state, role[:1]) in GOES_ON:
                    ways.append((extra, "K", GOES_ON[state, role[:1]], role))
                ways.append((REROLE + extra, "R", WANTED[state][1], WANTED[state][0]))
            for cost, edit, into, kept in ways:
                key = (path.cost + cost, path.rank, path.audit + edit)
                if into not in best or key < best[into][0]:
                    best[into] = key, path, kept
        least = min(key[0] for key, *_ in best.values())
        layer = {s: Path(*key, path.node, path.tape if kept is None else path.tape.add(kept, text)) for s, (key, path, kept) in best.items() if key[0] <= least + HOPELESS}
        self.layer = self.closed(layer)
        self.rows += 1
        if self.rows % FREEZE == 0:
            self.freeze()

    def freeze(self) -> None:
        """Puts the audits away up to the last row's edit: those are in order among themselves, for none begins another."""
        heads = {s: (p.rank, p.audit.rstrip("I")) for s, p in self.layer.items()}
        rank = {head: k for k, head in enumerate(sorted(set(heads.values())))}
        node = {}
        for s, p in self.layer.items():
            node.setdefault(heads[s], (p.node, heads[s][1]))
        self.layer = {s: Path(p.cost, rank[heads[s]], p.audit[len(heads[s][1]) :], node[heads[s]], p.tape) for s, p in self.layer.items()}

    def end(self) -> tuple[int, str, object]:
        """(cost, audit, tape) of the cheapest repair."""
        path = min((self.layer[s] for s in ENDS if s in self.layer), key=lambda p: p[:3])
        parts, node = [path.audit], path.node
        while node:
            node, part = node
            parts.append(part)
        return path.cost, "".join(reversed(parts)), path.tape


class Digest:
    """SHA-256 of the ``role:text`` lines so far."""

    def __init__(self, sha=None):
        self.sha = sha

    def add(self, role: str, text: str) -> Digest:
        sha = self.sha.copy() if self.sha else hashlib.sha256()
        sha.update((f"\n{role}:{text}" if self.sha else f"{role}:{text}").encode())
        return Digest(sha)

    def hexdigest(self) -> str:
        return (self.sha or hashlib.sha256()).hexdigest()


class Lines:
    """The rows themselves, the last with those before it."""

    def __init__(self, last: tuple | None = None):
        self.last = last

    def add(self, role: str, text: str) -> Lines:
        return Lines((self.last, role, text))

    def rows(self) -> list[tuple[str, str]]:
        out, at = [], self.last
        while at:
            at, *row = at
            out.append(tuple(row))
        return out[::-1]


def repair(rows: Iterable[tuple[str, str, bool]], tape) -> tuple[int, str, object]:
    """(cost, audit, tape) of rows (role, text, whether it stood there before)."""
    own = Repair(tape)
    for role, text, repeated in rows:
        own.feed(role, text, fault_of(text, repeated))
    return own.end()


class Conversation:
    """What is counted while a conversation's rows come by turn."""

    def __init__(self, conv_id, tape):
        self.conv_id, self.path, self.counts = conv_id, Repair(tape), dict.fromkeys(FAULTS, 0)
        self.illegal, self.before, self.low, self.turn, self.turns = 0, None, None, None, 0

    def feed(self, turn, role: str, text: str, earlier: bool) -> None:
        repeated = earlier or (turn, role, text) == self.before
        fault = fault_of(text, repeated)
        if fault:
            self.counts[fault] += 1
        if self.before is not None and self.before[1][:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None and turn != self.turn:
            self.low, self.turn, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        self.before = turn, role, text
        self.path.feed(role, text, fault)

    def row(self) -> dict:
        cost, audit, tape = self.path.end()
        gaps = 0 if self.low is None else self.turn - self.low + 1 - self.turns
        return {"conv_id": self.conv_id, "gaps": gaps, **self.counts, "illegal": self.illegal, "cost": cost, "audit": audit, "tape": tape}


def in_order(convs: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv_id, turn, role, text, earlier (the words stood in an earlier turn): each conversation in one partition, by turn."""
    own = convs.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))))
    own = own.withColumn("same", F.sha2(F.concat_ws("\x00", "role", "text"), 256))
    place = F.struct(F.col("turn").isNotNull().alias("late"), "turn")
    again = own.groupBy("conv_id", "same").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last")
    again = small(again.select(F.col("conv_id").alias("_conv"), F.col("same").alias("_same"), F.col("first.turn").alias("_turn")), 256)
    marked = own.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("same") == F.col("_same")), "left")
    earlier = F.col("_same").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_turn"))
    ordered = marked.select("conv_id", "turn", "role", "text", earlier.alias("earlier")).repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def conversations(rows: Iterator[pa.RecordBatch], new_tape) -> Iterator[list[dict]]:
    """For each batch the conversations that end in it; the last ones at the end."""
    now: Conversation | None = None
    for b in rows:
        out = []
        for conv_id, turn, role, text, earlier in zip(*(c.to_pylist() for c in b.columns)):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    out.append(now.row())
                now = Conversation(conv_id, new_tape())
            now.feed(turn, role, text, earlier)
        yield out
    if now is not None:
        yield [now.row()]


COUNTS = ["gaps", *FAULTS, "illegal", "cost"]
ROWS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _repaired(convs: DataFrame, columns: tuple[str, str, str, str], new_tape, read, kind: str, arrow: pa.DataType) -> DataFrame:
    id_type = convs.schema[columns[0]].dataType
    own = to_arrow_type(id_type)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in conversations(rows, new_tape):
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["conv_id"] for x in found], own), *(pa.array([x[c] for x in found], pa.int64()) for c in COUNTS), pa.array([x["audit"] for x in found], pa.string()), pa.array([read(x["tape"]) for x in found], arrow)],
                    names=["conv_id", *COUNTS, "audit", "repaired"],
                )

    return map_arrow(in_order(convs, *columns), run, f"conv_id {id_type.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS) + f", audit string, repaired {kind}")


def repair_conversations(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and the repaired rows (role, text), in order; a
    task holds one conversation's rows at a time."""
    return _repaired(convs, (conv_col, turn_col, role_col, text_col), Lines, lambda t: [{"role": r, "text": x} for r, x in t.rows()], "array<struct<role: string, text: string>>", ROWS)


def repair_digests(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """As repair_conversations, with the SHA-256 of the repaired ``role:text`` lines in place of the rows, which no task holds."""
    return _repaired(convs, (conv_col, turn_col, role_col, text_col), Digest, Digest.hexdigest, "string", pa.string())


def damaged(convs: DataFrame) -> DataFrame:
    """The contract's damage: by the checksum of ``conv_id:turn`` a row is dropped, emptied, loses its sentence ends, is
    repeated, or becomes the user's."""
    blank = F.lit(" ")
    kind = F.pmod(F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")), F.lit(20))
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    rows = convs.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    rows = rows.withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("time", F.explode(times)).drop("time", "kind")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair_digests(damaged(convs)).withColumnRenamed("conv_id", "_conv")
    every = convs.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    nothing = F.lit(hashlib.sha256().hexdigest())
    return every.select("conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired", nothing).alias("repaired_sha256"))
