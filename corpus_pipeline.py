"""The corpus pipeline: five stages over documents, each written as Parquet and read back.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of their input and drop the
documents they reject; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import decontam, host_rules, lang_id, packing, simhash
from pagewright.llm.common import free_name, materialize, table
from pagewright.llm.queries import tokenizer_path
from pagewright.sources.shared import new_path, remove

#: A document is rejected if its text is in no learned language, or hardly like any.
LEAST_LANGUAGE_SCORE = 0.05


def _set_aside(docs: DataFrame, taken: tuple[str, ...]) -> dict[str, str]:
    """Free names for those columns of ``docs`` whose names an operator adds."""
    aside: dict[str, str] = {}
    for c in docs.columns:
        if c.lower() in taken:
            aside[c] = free_name(f"__own_{c}", [*docs.columns, *aside.values()])
    return aside


def _as_before(rows: DataFrame, docs: DataFrame, aside: dict[str, str]) -> DataFrame:
    """The columns of ``docs`` from ``rows``."""
    return rows.select(*(F.col(aside.get(c, c)).alias(c) for c in docs.columns))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    aside = _set_aside(docs, ("held_out", "lang_pred", "score"))
    rows = docs.withColumnsRenamed(aside)
    model = lang_id.fit_prototypes(rows.select("doc_id", "text", "lang").where(~lang_id.held_out(F.col("doc_id"))))
    judged = lang_id.identify(rows, *model, keep=tuple(rows.columns))
    return _as_before(judged.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE)), docs, aside)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    whole = docs.select(F.struct("*").alias("row"), "text", "source")
    return host_rules.apply_host_rules(spark, whole).where("kept").select("row.*")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of smallest doc_id stays of each group; rows are told apart by a number of their own.

    Groups are op7's, with its contract parameters: four-word shingles, fingerprints that differ in 4 bits at most. That
    is not a similarity of 0.8 over five words: near copies of that kind with more differing bits all stay (README).
    """
    rows = materialize(spark, docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("rid")), "pipeline-rows")
    groups = simhash.near_duplicates(spark, rows.select(F.col("rid").alias("doc_id"), F.col("row.text").alias("text")))
    order = F.struct(F.col("id").isNull(), "id", "rid")
    first = (
        rows.select("rid", F.col("row.doc_id").alias("id"))
        .join(groups.select(F.col("doc_id").alias("rid"), "component_id").hint("merge"), "rid")
        .groupBy("component_id")
        .agg(F.min(order)["rid"].alias("rid"))
    )
    # The side that is built holds a number for each row that stays, a small part of what its texts take: texts need no sort.
    return rows.join(first.select("rid").hint("shuffle_hash"), "rid", "left_semi").select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    aside = _set_aside(docs, ("item_ids",))
    found = decontam.find_leaks(spark, docs.withColumnsRenamed(aside), table(spark, sf_dir, "benchmark"))
    return _as_before(found.where(F.size("item_ids") == 0), docs, aside)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs, tokenizer_path()).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language_id", keep_known_languages),
    ("quality_rules", keep_good_quality),
    ("near_dedup", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The models and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; a stage's table goes when the next one's is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"pipeline-{name}")
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
