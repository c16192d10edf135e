"""The pipeline's stages against brute force, over a table with nulls, repeated rows and ids, and columns that clash."""

import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from siftwell.llm import mixing, packing, pii

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, slot string, block long, Place int, token_places string, row_hash long"


def rows():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    draw = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [draw(150) for _ in range(4)]
    near = [" ".join(w if rng.random() > 0.01 else "x" for w in b.split()) for b in base for _ in range(5)]
    texts = [None, "", " \n", "few words", "few words", *base, *near, *base, base[0] + " mail a.b@c.org", *(draw(rng.randint(5, 400)) for _ in range(60)), draw(9000)]
    out = [(i, t, "en", None if i % 11 == 0 else f"s{min(3, i % 7)}", len(t or ""), "score", "slot", 5, 6, "x", 7) for i, t in enumerate(texts)]
    return [*out, out[6], out[6], (12, base[3], *out[0][2:]), (None, base[1], *out[0][2:]), (None, "no id and no copy at all here", *out[0][2:])]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(path := str(tmp_path_factory.mktemp("docs") / "documents.parquet"))
    return spark.read.parquet(path)


def key(r):
    return tuple(repr(x) for x in r)


def shingles(text):
    w = (text or "").split()
    return frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_deduplicate(spark, docs):
    found = docs.collect()
    sets = [shingles(r.text) for r in found]
    group = list(range(len(found)))
    for _ in found:
        before = list(group)
        for i in range(len(found)):
            for j in range(len(found)):
                linked = sets[i] and sets[j] and (found[i].doc_id is None) <= (sets[i] == sets[j]) and (found[j].doc_id is None) <= (sets[i] == sets[j]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
                if linked:
                    group[i] = group[j] = min(group[i], group[j])
        if group == before:
            break
    members = defaultdict(list)
    for i, g in enumerate(group):
        members[g].append(found[i])
    out = corpus_pipeline.deduplicate(spark, docs, "")
    got = Counter(map(key, out.collect()))
    assert out.columns == docs.columns and not got - Counter(map(key, found))
    for g, own in members.items():
        ids = [r.doc_id for r in own if r.doc_id is not None]
        stay = [r for r in own if got[key(r)]]
        if not sets[g] or not ids:
            assert all(got[key(r)] == sum(key(x) == key(r) for x in found) for r in own)
        else:
            assert len(set(map(key, stay))) == 1 and got[key(stay[0])] == 1 and stay[0].doc_id == min(ids)


def test_personal_data(spark, docs):
    out = corpus_pipeline.personal_data(spark, docs, "")
    want = Counter(key((r.doc_id, t := pii.redact(r.text), r.lang, r.source, len(t) if t is not None else None, *r[5:])) for r in docs.collect())
    assert Counter(map(key, out.collect())) == want and out.columns == docs.columns


def test_mix_and_pack(spark, docs):
    mixed = corpus_pipeline.mix(spark, docs, "").cache()
    assert mixed.columns == [*docs.columns, "slot_", "place_"] and mixed.select(*docs.columns).exceptAll(docs).count() == 0 and mixed.count() == docs.count()
    slots = mixed.toPandas().sort_values(["slot_", "place_"])
    assert not slots.duplicated(["slot_", "place_"]).any()
    for _, own in slots.groupby(slots.source.fillna("")):  # blocks of 8, in turn
        assert [len(x) for _, x in own.groupby("slot_")][:-1] == [8] * (-(-len(own) // 8) - 1)
    packed = corpus_pipeline.pack(spark, mixed, "").cache()
    out = packed.toPandas().sort_values(["sequence_id", "offset"])
    assert (out.groupby("sequence_id").length.cumsum() - out.length == out.offset).all() and out.groupby("sequence_id").length.sum().max() <= 2048
    t = packing.Ids(public_tokenizers.path("word_bpe_49k.json")).tokenizer
    want = []
    for r in docs.collect():
        ids = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(r.doc_id, k // 2048, k, min(2048, len(ids) - k), zlib.crc32(ids[k : k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
    assert Counter(want) == Counter(map(tuple, packed.select("doc_id", "piece", "start", "length", "ids_crc32").collect()))


def test_quality(spark, tmp_path):
    rng = random.Random(5)
    good = lambda: " ".join(rng.choice(["the", "of", "river", "and", "stone", "light", "was"]) + rng.choice(["", "", ","]) for _ in range(80))
    junk = lambda: " ".join(rng.choice(["BUY!!", "$$$", "now!!", "CLICK", "###"]) for _ in range(80))
    made = [(i, good() if i % 3 else junk(), "en", "s", 1, "score", "slot", 5, 6, "x", 7) for i in range(600)]
    docs = spark.createDataFrame([*made, (None, good(), *made[0][2:]), (601, None, *made[0][2:])], SCHEMA)
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(600) if i % 2] + [(5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.quality(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} - {601} == {None, *(i for i in range(600) if i % 3)}
    assert corpus_pipeline.quality(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_run(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "a" / "documents.parquet"))
    docs.limit(0).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    for d in ("a", "b"):
        spark.createDataFrame([(i, int(i % 2), 0) for i in range(90)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / d / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path / "a"))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
    assert corpus_pipeline.run(spark, str(tmp_path / "b")).count() == 0


def test_mixing_clashes(spark):
    docs = spark.createDataFrame([(1, "a", 1, 2, "q"), (1, "a", 1, 2, "q"), (None, None, 1, 2, None)], "doc_id long, source string, _key int, rank int, SLOT string")
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, "block", "release", "deadline", "slot_", "place"] and out.select(*docs.columns).exceptAll(docs).count() == 0
    assert mixing.scheduled(out.columns, "slot") == "slot_" and out.filter("slot_ >= release AND slot_ < deadline").count() == 3
    hot = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("s").alias("source"))  # one row, many times
    assert mixing.mix(hot).select("slot", "place").distinct().count() == 20_000
