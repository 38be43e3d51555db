"""Queries of the llm operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import normal_id
from ..session import table
from . import capping, history, leakage, markup, mixing, packing, pii, subjects

#: Key of the pseudonyms in the queries; a deployment passes its own.
PSEUDONYM_KEY = "threadloom"


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both text columns of the forum with their table and normal id."""
    comments = table(spark, sf_dir, "comments").select(F.lit("comments").alias("table_name"), normal_id("id").alias("record_id"), F.col("body").alias("text"))
    posts = table(spark, sf_dir, "submissions").select(F.lit("submissions").alias("table_name"), normal_id("id").alias("record_id"), F.col("selftext").alias("text"))
    return comments.unionByName(posts)


_COLUMNS = {"table_name": "table_name", "record_id": "record_id", "text": "text"}


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capping.dropped_comments(table(spark, sf_dir, "comments")).select(F.col("id").alias("comment_id"))


def p3_output_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments dropped so that nobody writes more than 2 % of what is left of a batch."""
    return capping.dropped_comments(table(spark, sf_dir, "comments"), of_output=True).select(F.col("id").alias("comment_id"), F.col("grp").alias("batch_no"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scrub(_texts(spark, sf_dir).where("record_id is not null and text is not null"), _COLUMNS, key=PSEUDONYM_KEY)
    rows = found.where(F.size("findings") > 0).select("table_name", "record_id", F.explode("findings").alias("f"))
    return rows.select("table_name", "record_id", F.col("f.kind").alias("pii_kind"), F.col("f.text").alias("pii_text")).where(F.col("pii_kind").isin(*pii.KINDS)).distinct()


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scrub(_texts(spark, sf_dir), _COLUMNS, key=PSEUDONYM_KEY).select("table_name", "record_id", "clean")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = markup.strip_markup(_texts(spark, sf_dir).where("record_id is not null and text is not null"), _COLUMNS)
    return found.where(F.size("kinds") > 0).select("table_name", "record_id", F.explode("kinds").alias("markup_kind")).distinct()


def p5_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.strip_markup(_texts(spark, sf_dir), _COLUMNS).select("table_name", "record_id", "clean")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches of both tables through one index, in loads no larger than what it holds."""
    return history.duplicates_in_tables({"comments": (table(spark, sf_dir, "comments"), "body"), "submissions": (table(spark, sf_dir, "submissions"), "selftext")})


def p6_last_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest batch of comments against an index of all earlier ones."""
    comments = table(spark, sf_dir, "comments")
    newest = comments.agg(F.max("batch_no")).first()[0]
    return history.duplicates_in_batch(comments, "body", newest if newest is not None else 0)


def p6_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All batches of comments, one after the other through the index."""
    return history.duplicates_by_batch(table(spark, sf_dir, "comments"), "body")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leakage.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
    return found.select("doc_id", "item_id")


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each leaked item the number of documents and its longest stretch."""
    found = leakage.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
    return found.groupBy("item_id").agg(F.count("*").alias("documents"), F.max("words").alias("longest"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = subjects.document_subjects(table(spark, sf_dir, "documents"), table(spark, sf_dir, "subjects"), table(spark, sf_dir, "subject_examples"))
    return found.select("doc_id", "subject_code").distinct()


def p10_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each subject."""
    found = subjects.document_subjects(table(spark, sf_dir, "documents"), table(spark, sf_dir, "subjects"), table(spark, sf_dir, "subject_examples"))
    return found.groupBy("subject_code").agg(F.count("*").alias("documents"), F.round(F.avg("share"), 4).alias("mean_share"))


def _recorded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments = table(spark, sf_dir, "comments").select(F.lit("comments").alias("table_name"), "rec_no", F.col("body").alias("text"))
    posts = table(spark, sf_dir, "submissions").select(F.lit("submissions").alias("table_name"), "rec_no", F.col("selftext").alias("text"))
    return comments.unionByName(posts)


def p1_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_recorded_texts(spark, sf_dir), table(spark, sf_dir, "pack_limits"))


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = table(spark, sf_dir, "pack_limits")
    return packing.pack_report(packing.pack(_recorded_texts(spark, sf_dir), limits), limits)


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = table(spark, sf_dir, "mix_targets")
    return mixing.shares(mixing.mix(table(spark, sf_dir, "documents"), targets), targets)


QUERIES = {
    "p1_packs": p1_packs, "p1_report": p1_report, "p9_mix": p9_mix, "p9_shares": p9_shares,
    "p10_found": p10_found, "p10_composition": p10_composition,
    "p8_found": p8_found, "p8_items": p8_items,
    "p6_found": p6_found, "p6_last_batch": p6_last_batch, "p6_batches": p6_batches,
    "p3_found": p3_found, "p3_output_share": p3_output_share, "p4_found": p4_found, "p4_clean": p4_clean, "p5_found": p5_found, "p5_clean": p5_clean,
}

_NORM = "regexp_replace(lower(trim({0}, chr(32)||chr(9)||chr(10)||chr(13)||chr(160))), '^t[13]_', '')"
ORACLES = {
    "p3_found": f"""WITH c AS (SELECT nullif({_NORM.format('id')}, '') AS id, rec_no, batch_no, score,
      regexp_replace(lower(trim(author, chr(32)||chr(9)||chr(10)||chr(13)||chr(160))), '^/?u/', '') AS a FROM comments),
    f AS (SELECT id, batch_no, score, nullif(nullif(a, ''), '[deleted]') AS who FROM c WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY rec_no) = 1),
    l AS (SELECT batch_no, greatest(2, count(*) // 50) AS cap FROM f GROUP BY 1)
    SELECT id AS comment_id FROM f JOIN l USING (batch_no) WHERE who IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY f.batch_no, who ORDER BY score DESC NULLS LAST, id) > cap""",
}
