"""Documents to packed training sequences, stage by stage; each stage reads what the one before has written.

Every stage but the last returns the columns of documents, whatever else they are called, and stage 4 two more: the
schedule's slot and place (named so that they meet no other column), which stage 5 packs by. Stage 4 neither drops
nor repeats rows: its decision is the order, which the order of stage 5's sequences follows. An empty table stays
empty through all stages; null and empty texts, repeated rows and ids, and very long texts are whole rows to each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm import jaccard_join, mixing, packing, pii, quality_classifier
from siftwell.llm.common import drop, free, materialize, small, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier gives 0.5 or more stay. Null texts are scored as empty; equal texts stay or go together."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"), ~quality_classifier.held_out())
    score = free(docs.columns, "score")
    return quality_classifier.score(docs, model, name=score).filter(F.col(score) >= 0.5).drop(score)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked rows stays: that of the smallest doc_id, of several such the one whose text hashes lowest.

    Rows are told apart by id and text, so a row goes only if its own text has a partner that stays; of rows that are
    alike in both, one stays. Rows without words all stay, as do rows without an id unless a copy has one.
    """
    links = materialize(jaccard_join.link(docs), "links")
    grouped = links.filter("n_shingles > 0 AND component_id IS NOT NULL")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash"))
    groups = grouped.groupBy("component_id").agg(best.alias("best"), F.count("*").alias("rows")).filter("rows > 1")
    groups = materialize(groups.select("component_id", F.col("best.doc_id").alias("kept_id"), F.col("best.text_hash").alias("kept_hash")), "groups")
    members = grouped.join(small(groups), "component_id")
    stays = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash"))
    own_id, own_hash = free(docs.columns, "row_id"), free(docs.columns, "row_hash")
    keyed = docs.withColumn(own_id, F.col("doc_id").cast("long")).withColumn(own_hash, F.xxhash64("text"))

    def is_one_of(rows: DataFrame, how: str) -> DataFrame:
        found = small(rows.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct())
        return keyed.join(found, F.col(own_id).eqNullSafe(F.col("_id")) & (F.col(own_hash) == F.col("_hash")), how)

    gone = materialize(members.filter(~stays).select("doc_id", "text_hash").distinct(), "gone")
    twice = materialize(members.filter(stays).groupBy("doc_id", "text_hash").count().filter("count > 1"), "twice")
    drop(groups)
    out = is_one_of(gone.unionByName(twice.drop("count")), "left_anti")
    if not twice.isEmpty():  # rows alike in id and text
        one = is_one_of(twice, "left_semi").groupBy(own_id, own_hash).agg(F.first(F.struct(*docs.columns)).alias("of"))
        return out.select(*docs.columns).unionByName(one.select("of.*"))
    return out.select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are masked in the text, and n_chars follows it where it was the text's length; all rows stay."""
    out = pii.redact_pii(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns) if "n_chars" in docs.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their slot of the schedule and their place there; without any, the columns alone."""
    own, names = docs.columns, mixing.schedule_names(docs.columns)
    return mixing.mix(docs).select(*own, names["slot"], names["place"])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece, with its sequence and its place there; sequences follow the schedule. Repeated rows are packed each."""
    import public_tokenizers

    slot, place = (mixing.scheduled(docs.columns, c) for c in ("slot", "place"))
    return packing.pack_in_order(docs, public_tokenizers.path("word_bpe_49k.json"), slot_col=slot, place_col=place)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", deduplicate), ("PII", personal_data), ("mixing", mix), ("best-fit packing", pack)]

#: The classifier, the hashes and the tokenizer have no SQL form; tests/llm/test_pipeline.py compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs, before = materialize(stage(spark, docs, sf_dir), f"stage{k}"), docs
        if k:
            drop(before)
    return docs
