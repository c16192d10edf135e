"""Operators 11 to 13 against the library, brute force and SQL's own words; edge cases."""

import hashlib
import itertools
import random
import re
import time
import zlib

import hypothesis
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftwell.llm import bpe_transducer, conversation_repair, packing, periodic_runs, pii

SCHEMA = "doc_id long, text string, ids string, runs long, same int"


@pytest.fixture(scope="module")
def docs(spark):
    random.seed(4)
    words = [f"w{i}" for i in range(30)]
    texts = [None, "", " \n\t ", "a", "É日本 ok x", "a b " * 40, "x " * 5000 + "end", "<|endoftext|> 'll  \n\n 12ab", "y" * 300_000, *(" ".join(random.choices(words, k=random.randint(1, 80))) for _ in range(40))]
    texts += [" ".join((random.choices(words, k=random.randint(1, 9)) * 9)[: random.randint(8, 60)]) for _ in range(40)]
    rows = [(i, t, "ids", 7, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[5], rows[5], (None, "no id no id no id no id", None, None, None)], SCHEMA).repartition(4).cache()


# ---- 11 ---------------------------------------------------------------------------------------------------------

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe_transducer.load_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER, VOCABULARY = bpe_transducer.Encoder(PATH), bpe_transducer.Vocabulary(PATH)
CUTTER = bpe_transducer.Cutter(public_tokenizers.PATTERN, *(bpe_transducer.unknown_characters(k) for k in (r"\p{L}", r"\p{N}")))


def ids_of(text, encoder=ENCODER):
    return np.frombuffer(encoder.encode(text, CUTTER), "<u4").tolist()


#: Of the last signs the library's Unicode version knows no letter or number.
SIGNS = ["a", "the", "ing", "aaaa", " ", "  ", "\n", "É", "日本", "'s", "1", "23", "<|endoftext|>", "​", ".", "!!", "\t", "Σ", "　", "-----", "\x85", "ÃÂ", "\x00", "\U0001f600", "\U00010940", "\U00011de0", "࢏"]


@hypothesis.settings(max_examples=1500, deadline=None)
@hypothesis.given(st.lists(st.sampled_from(SIGNS) | st.characters(exclude_categories=["Cs"]), max_size=40).map("".join), st.sampled_from([3, 1 << 20]))
def test_ids_are_the_library_s(text, long):
    was, bpe_transducer.LONG = bpe_transducer.LONG, long
    assert ids_of(text) == LIBRARY.encode_ordinary(text)
    bpe_transducer.LONG = was
    assert VOCABULARY.decode(ENCODER.encode(text, CUTTER)) == text


@pytest.mark.parametrize("most", [2, 40, 1 << 17])
def test_any_bytes_with_full_tables(most):
    """Byte strings that are no words, by tables that are begun anew all the time, as the merges are defined."""
    own, some = bpe_transducer.Transducer(RANKS, most), random.Random(9)
    for _ in range(400):
        data = bytes(some.choice(b"aberst -\xc3\xa9\x80") for _ in range(some.randint(0, 30)))
        parts = [data[i : i + 1] for i in range(len(data))]
        while found := min(((RANKS[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in RANKS), default=None):
            parts[found[1] : found[1] + 2] = [parts[found[1]] + parts[found[1] + 1]]
        assert own.ids(data) == [RANKS[x] for x in parts]
        assert len(own.items) <= most + 1


def test_ranks_that_are_no_merges():
    with pytest.raises(ValueError):
        bpe_transducer.Transducer({b"a": 0}).ids(b"b")


@hypothesis.settings(max_examples=400, deadline=None)
@hypothesis.given(st.lists(st.integers(0, len(RANKS) - 1), max_size=20), st.integers(1, 5))
def test_decoding_as_the_library(ids, part):
    assert VOCABULARY.decode(np.array(ids, "<u4").tobytes(), part) == LIBRARY.decode(ids)


def test_decoding_refuses_unknown_ids():
    with pytest.raises(ValueError):
        VOCABULARY.decode(np.array([len(RANKS)], "<u4").tobytes())


def test_long_pre_tokens_take_linear_time():
    began = time.time()
    text = "7" * 3_000_000 + " " + "ab" * 1_000_000
    assert VOCABULARY.decode(ENCODER.encode(text, CUTTER)) == text and time.time() - began < 60


def test_encode_and_decode_tables(docs):
    encoded = bpe_transducer.encode_texts(docs, PATH, public_tokenizers.PATTERN)
    back = bpe_transducer.decode_ids(encoded.withColumn("other", F.lit(1)), PATH)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.decoded) for r in back.collect())
    assert got == sorted((r.doc_id if r.doc_id is not None else -1, len(LIBRARY.encode_ordinary(r.text or "")), r.text or "") for r in docs.collect())
    assert back.columns == ["doc_id", "n_tokens", "decoded", "other"]
    assert bpe_transducer.encode_texts(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    assert bpe_transducer.decode_ids(encoded.select(F.lit(None).cast("binary").alias("ids")).limit(1), PATH).collect()[0].decoded == ""


# ---- 12 ---------------------------------------------------------------------------------------------------------


def runs_by_hand(words, least=6, times=4):
    """Every period at every place."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("few", [0, 6, 48])
@pytest.mark.parametrize("least, times", [(6, 4), (2, 2), (1, 3)])
def test_runs_by_hand(monkeypatch, few, least, times):
    monkeypatch.setattr(periodic_runs, "FEW", few)
    some = random.Random(few + times)
    for _ in range(150):
        texts = []
        for _ in range(some.randint(1, 5)):
            signs = "abcdefghijklmnopqrst"[: some.choice([1, 2, 3, 20])]
            words = some.choices(signs, k=some.randint(0, 40))
            for _ in range(some.randint(0, 3)):
                part, at = some.choices(signs, k=some.randint(1, 6)), some.randint(0, len(words))
                words[at:at] = part * some.randint(2, 9) + part[: some.randint(0, len(part))]
            texts.append(words)
        codes = np.array([ord(w) for words in texts for w in words], np.int64)
        got = periodic_runs.runs_of(codes, np.concatenate([[0], np.cumsum([len(x) for x in texts])]), least, times)
        assert [[tuple(r[1:]) for r in got.tolist() if r[0] == k] for k in range(len(texts))] == [runs_by_hand(x, least, times) for x in texts]


def test_find_runs(docs):
    got = {(r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic_runs.find_runs(docs).collect()}
    want = set()
    for r in docs.collect():
        words = words_of(r.text)
        runs = [(0, 5000, 1)] if len(words) == 5001 else runs_by_hand(words)
        want.add((r.doc_id, len(words), tuple(runs), collapsed(words, runs)))
    assert got == want and periodic_runs.find_runs(docs).count() == docs.count()
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


def test_made_periodic(docs):
    for r in docs.select("doc_id", "text", periodic_runs.made_periodic(F.col("doc_id"), F.col("text")).alias("made")).collect():
        h, words = zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1, words_of(r.text)
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert words_of(r.made) == words


def test_long_periodic_texts():
    """A text of 3 MB that repeats, in seconds; one of one word alone."""
    some = random.Random(2)
    words = [some.randrange(3000) for _ in range(100_000)]
    began = time.time()
    for codes, run in (((words * 5)[:470_000], (0, 470_000, 100_000)), ([1] * 400_000, (0, 400_000, 1))):
        assert [tuple(r) for r in periodic_runs.runs_of(np.array(codes, np.int64), np.array([0, len(codes)])).tolist()] == [(0, *run)]
    assert time.time() - began < 60


# ---- 13 ---------------------------------------------------------------------------------------------------------


def faults_by_hand(rows):
    out = []
    for i, (role, text) in enumerate(rows):
        word = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not word else "duplicate" if (role, text) in rows[:i] else None if word[-1] in ".!?" else "truncated")
    return out


def best_by_hand(rows):
    """All edit sequences with up to two inserts in a gap whose roles can still become a conversation; none with more is cheaper."""
    faults, prefix = faults_by_hand(rows), re.compile(r"s?(ua)*u?")
    ways = {("", "", ()): 0}  # (roles, audit, lines): cost
    for i in range(len(rows) + 1):
        for _ in range(2):
            for (roles, audit, lines), cost in list(ways.items()):
                for role in ("user", "assistant"):
                    ways.setdefault((roles + role[0], audit + "I", (*lines, f"{role}:")), cost + 5)
        most = min(ways.values()) + 25
        ways = {w: c for w, c in ways.items() if c <= most and prefix.fullmatch(w[0])}
        if i < len(rows):
            (role, text), fault, after = rows[i], faults[i], {}
            for (roles, audit, lines), cost in ways.items():
                after[roles, audit + "D", lines] = cost + 2
                if fault not in ("blank", "duplicate"):
                    extra = 5 * (fault == "truncated")
                    if role:  # one without a role can't be kept
                        after[roles + role[:1], audit + "K", (*lines, f"{role}:{text}")] = cost + extra
                    for other in ("user", "assistant"):
                        after[roles + other[0], audit + "R", (*lines, f"{other}:{text}")] = cost + 1 + extra
            ways = {w: c for w, c in after.items() if prefix.fullmatch(w[0])}
    cost, audit, lines = min((c, w[1], w[2]) for w, c in ways.items() if re.fullmatch(r"(s?(ua)+)?", w[0]))
    return cost, audit, lines


def test_repairs_by_hand():
    some = random.Random(8)
    for k in range(250):
        rows = [(some.choice(["user", "user", "assistant", "assistant", "system", "tool", ""]), some.choice(["Yes.", "No!", "And", "", "Why? ", f"{i}."])) for i in range(some.randint(0, 4))]
        faults = faults_by_hand(rows)
        cost, audit, tape = conversation_repair.repair(((r, t, f == "duplicate") for (r, t), f in zip(rows, faults)), conversation_repair.Lines())
        assert (cost, audit, tuple(f"{r}:{t}" for r, t in tape.rows())) == best_by_hand(rows), rows


def test_freezing_changes_nothing(monkeypatch):
    """Long conversations, their audits put away every row, every few rows and never."""
    some = random.Random(3)
    for _ in range(20):
        rows = [(some.choice(["user", "assistant", "user", "system"]), some.choice(["Yes.", "No!", "x", f"{i}."]), some.random() < 0.1) for i in range(300)]
        found = set()
        for every in (1, 7, 10_000):
            monkeypatch.setattr(conversation_repair, "FREEZE", every)
            for tape in (conversation_repair.Lines(), conversation_repair.Digest()):
                cost, audit, tape = conversation_repair.repair(rows, tape)
                found.add((cost, audit, tape.hexdigest() if hasattr(tape, "sha") else hashlib.sha256("\n".join(f"{r}:{t}" for r, t in tape.rows()).encode()).hexdigest()))
        assert len(found) == 1


def test_a_long_conversation_takes_linear_time():
    began = time.time()
    cost, audit, _ = conversation_repair.repair((("user", f"{i}.", False) for i in range(100_000)), conversation_repair.Digest())
    assert (cost, audit) == (50_000, "KR" * 50_000) and time.time() - began < 60


CONVS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello."), (1, 5, "user", "Hi."), (1, 6, "assistant", "Hello."),
    (2, None, "user", "No turn."), (2, 3, None, "x"), (2, 3, "user", None), (2, 3, "user", None), (2, None, "user", "No turn."),
    (None, 1, "assistant", "No id."), (None, 1, "assistant", "No id"), (3, 7, "user", " \n"), (4, 1, "user", "Only me?"), (4, 2, "user", "Still"), (5, 1, "user", "z" * 1_000_000 + "."),
]


def test_conversation_tables(spark):
    convs = spark.createDataFrame([(*r, 1, "x") for r in CONVS], "conv_id long, turn long, role string, text string, cost long, same string").repartition(5)
    got = {r.conv_id: r for r in conversation_repair.repair_conversations(convs).collect()}
    digests = {r.conv_id: r.repaired for r in conversation_repair.repair_digests(convs).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None}
    for conv_id, r in got.items():
        rows = sorted(((t is not None, t or 0, role or " ", text or " ") for c, t, role, text in CONVS if c == conv_id))
        turns, rows = [x[1] for x in rows if x[0]], [x[2:] for x in rows]
        faults, pairs = faults_by_hand(rows), [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(rows)]
        assert (r.blank, r.duplicate, r.truncated) == tuple(faults.count(x) for x in conversation_repair.FAULTS)
        assert r.gaps == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        assert r.illegal == sum(p not in ("su", "ua", "au") for p in pairs)
        lines = tuple(f"{x.role}:{x.text}" for x in r.repaired)
        assert (r.cost, r.audit, lines) == best_by_hand(rows)
        assert digests[conv_id] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert conversation_repair.repair_conversations(convs.limit(0)).count() == 0


def test_damage(spark, tmp_path):
    rows = [(c, t, random.choice(["system", "user", "assistant"]), f"Is it {c}.{t}?! Yes.") for c in range(60) for t in range(4)]
    spark.createDataFrame([*rows, (None, None, None, None)], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    convs = spark.read.parquet(f"{tmp_path}/conversations.parquet")
    want = []
    for c, t, role, text in [*rows, (None, None, " ", " ")]:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(c if c is not None else -1, t if t is not None else -1, "user" if kind == 4 else role, text)] * ((kind != 0) + (kind == 3))
    assert sorted((r.conv_id if r.conv_id is not None else -1, r.turn if r.turn is not None else -1, r.role, r.text) for r in conversation_repair.damaged(convs).collect()) == sorted(want)
    out = {r.conv_id: r for r in conversation_repair.op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(out) == {*range(60), None}
    for c in out:
        left = sorted((t, role, text) for i, t, role, text in want if i == (c if c is not None else -1))
        cost, audit, lines = best_by_hand([x[1:] for x in left])
        assert (out[c].cost, out[c].audit, out[c].repaired_sha256) == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


# ---- 8: patterns in linear time ---------------------------------------------------------------------------------

KEY_AS_ONE_PATTERN = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----(?:[A-Za-z0-9+/=\s:,.-]*?-----END (?:[A-Z]+ )*PRIVATE KEY-----)?")


@hypothesis.settings(max_examples=1000, deadline=None)
@hypothesis.given(st.lists(st.sampled_from(["-----BEGIN ", "-----END ", "RSA ", "PRIVATE KEY", "-----", "-", "aB1=\n", "!", " ", "PRIVATE KEY-----"]), max_size=16).map("".join))
def test_private_keys(text):
    assert list(pii.private_keys(text)) == [m.span() for m in KEY_AS_ONE_PATTERN.finditer(text)]


@hypothesis.settings(max_examples=1000, deadline=None)
@hypothesis.given(st.lists(st.sampled_from(["4111", "1111", "11111111", " ", "-", "  ", ".", "1", "0", "é", "+", "378282246310005"]), max_size=14).map("".join))
def test_cards(text):
    assert list(pii.cards(text)) == [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if pii.is_card(m[0])]


@pytest.mark.parametrize("part, size", [("7", 50), ("-----BEGIN PRIVATE KEY-----\n", 20), ("+1 ", 20), ("1 ", 10), ("1.", 5), ("a.", 10), ("@", 5), ("eyJabcdefgh.", 10), ("password=", 5), ("-----END PRIVATE KEY-----", 10)])
def test_pii_takes_linear_time(part, size):
    """Megabytes of what most patterns begin with, alone and before a text with an address."""
    began = time.time()
    text = part * (size * 1_000_000 // len(part)) + " mail a@b.co!"
    assert (len(text) - 7, 0, len(text) - 1) in pii.scored_spans(text)[0]
    assert time.time() - began < 120


def test_windows_hold_their_rows(spark):
    """One source of many rows beside many sources of one row: the first slots are crowded, the rest hold one row each."""
    rows = spark.range(6000).select(F.when(F.col("id") < 3000, F.col("id")).otherwise((F.col("id") - 3000).bitwiseAND(127)).alias("slot"))
    cells = packing.windows_of(rows, 500)
    sizes = rows.withColumn("_cell", F.expr(f"slot DIV {packing.CELL}")).join(cells, "_cell").groupBy("_window").count().collect()
    crowd = max(r["count"] for r in rows.groupBy(F.expr(f"slot DIV {packing.CELL}")).count().collect())
    assert sum(r["count"] for r in sizes) == 6000 and max(r["count"] for r in sizes) <= 500 + crowd
    slots = rows.distinct().withColumn("_cell", F.expr(f"slot DIV {packing.CELL}")).join(cells, "_cell").orderBy("slot").collect()
    assert [r._window for r in slots] == sorted(r._window for r in slots)
    assert packing.windows_of(rows.limit(0), 500).count() == 0
