"""What must hold of constructions that SQL cannot make: checked against the raw tables.

Containers, mixes, pieces and unified tables are made by tokenizers, trees and fitted
rates. SQL can still say what every such result has in common: each document is there
once, texts can be put together again, no row is lost, forms are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from traceloom.llm.chunking import p9_pieces
from traceloom.llm.drift import p6_unified
from traceloom.llm.mixing import p8_shares
from traceloom.llm.name_variants import p4_representatives
from traceloom.llm.packing import p7_packed
from traceloom.llm.pii_queries import p2_dates
from traceloom.session import cut, table

#: Distance of a share from its target that a mix may keep.
NEAR = 0.02


def p2_date_forms(spark: SparkSession, base: str) -> DataFrame:
    """(table_name, form, rows): how often birth dates are written in which form after permutation."""
    return p2_dates(spark, base).where("pseudonym IS NOT NULL").groupBy("table_name", F.regexp_replace("pseudonym", r"\d", "9").alias("form")).agg(F.count("*").alias("rows"))


def p6_rows(spark: SparkSession, base: str) -> DataFrame:
    """(file_name, rows): rows of every file in the unified table."""
    return p6_unified(spark, base).groupBy("file_name").agg(F.count("*").alias("rows"))


def p7_once(spark: SparkSession, base: str) -> DataFrame:
    """(job, doc_id, first_pieces, gaps, over_full): every document once in each job, its pieces without gap, no container over-full."""
    placed = cut(p7_packed(spark, base))
    filled = placed.groupBy("job", "container_id").agg((F.sum("n_tokens") > F.first("capacity")).alias("over"))
    docs = placed.join(filled, ["job", "container_id"]).groupBy("job", "doc_id").agg(
        F.count_if(F.col("piece_no") == 1).alias("first_pieces"), (F.max("piece_no") - F.count("*")).alias("gaps"), F.count_if("over").alias("over_full"))
    return docs.select("job", "doc_id", "first_pieces", "gaps", "over_full")


def p8_near(spark: SparkSession, base: str) -> DataFrame:
    """(source, near, capped): whether a source's share is near its target, and no document is repeated too often."""
    return p8_shares(spark, base).select(
        "source", (F.abs(F.col("actual_share") - F.col("target_share")) <= NEAR).alias("near"), (F.col("most_repeats") <= F.col("max_repeats")).alias("capped"))


def p9_rebuilt(spark: SparkSession, base: str) -> DataFrame:
    """(doc_id, digest, joined): texts put together from their own parts, one row per text and limit; texts within a limit are themselves."""
    pieces = cut(p9_pieces(spark, base))
    own = F.substring("piece", F.col("own_start") - F.col("char_start") + 1, F.col("char_end") - F.col("own_start"))
    follows = F.lag("char_end").over(Window.partitionBy("job", "doc_id").orderBy("piece_no"))
    parts = pieces.select("job", "doc_id", F.struct("piece_no", own.alias("t")).alias("part"), (F.coalesce(follows, F.lit(0)) == F.col("own_start")).alias("joins"))
    # The pieces of one text are as large as the text itself.
    rebuilt = parts.groupBy("job", "doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["t"]), "").alias("text"), F.min("joins").alias("joined"))
    docs = table(spark, base, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("whole"))
    jobs = table(spark, base, "token_limits").where("job LIKE 'cut_%'").select("job")
    # Two rows of a fixed table.
    every = docs.crossJoin(F.broadcast(jobs)).join(rebuilt, ["job", "doc_id"], "left")
    return every.select("job", "doc_id", F.md5(F.coalesce("text", "whole", F.lit(""))).alias("digest"), F.coalesce("joined", F.lit(True)).alias("joined"))


def p4_representatives_hold(spark: SparkSession, base: str) -> DataFrame:
    """(keys_twice, not_least): keys with two representatives, and representatives that stand for another; none of either."""
    rows = cut(p4_representatives(spark, base))
    twice = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("keys_twice"))
    chains = rows.where("key > representative").select("key").join(rows.select(F.col("representative").alias("key")).distinct(), "key").agg(F.count("*").alias("not_least"))
    # One row each.
    return twice.crossJoin(F.broadcast(chains))


QUERIES = {f.__name__: f for f in (p2_date_forms, p4_representatives_hold, p6_rows, p7_once, p8_near, p9_rebuilt)}
SQL = {
    "p2_date_forms": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, regexp_replace(dob, '\\d', '9', 'g') AS form, count(*) AS rows FROM {t} WHERE dob IS NOT NULL GROUP BY 2" for t in ("exposed_roster_003", "exposed_records_008")),
    "p4_representatives_hold": "SELECT 0 AS keys_twice, 0 AS not_least",
    "p6_rows": """SELECT file_name, count(*) AS rows FROM roster_drops GROUP BY 1 UNION ALL SELECT 'roster_contacts_a', count(*) FROM roster_contacts_a UNION ALL SELECT 'roster_contacts_b', count(*) FROM roster_contacts_b""",
    "p7_once": "SELECT job, doc_id, 1 AS first_pieces, 0 AS gaps, 0 AS over_full FROM documents, (SELECT job FROM token_limits WHERE job LIKE 'pack_%')",
    "p8_near": "SELECT source, true AS near, true AS capped FROM mix_targets",
    "p9_rebuilt": "SELECT job, doc_id, md5(coalesce(text, '')) AS digest, true AS joined FROM documents, (SELECT job FROM token_limits WHERE job LIKE 'cut_%')",
}
