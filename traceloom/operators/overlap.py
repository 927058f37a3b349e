"""Overlap of value sets between sources, by counts and digests only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tokens(df: DataFrame, source: str, label: str, value) -> DataFrame:
    """(source, token): digests of labelled values; the values do not leave."""
    v = F.lower(F.trim(value))
    return df.select(v.alias("_v")).where("_v <> ''").select(F.lit(source).alias("source"), F.sha2(F.concat_ws("=", F.lit(label), "_v"), 256).alias("token"))


def membership(all_tokens: DataFrame, left: str, right: str) -> DataFrame:
    """How many tokens are in both, in the left only, in the right only."""
    flags = all_tokens.groupBy("token").agg(F.max(F.col("source") == left).alias("l"), F.max(F.col("source") == right).alias("r"))
    both, lo, ro = F.count_if(F.col("l") & F.col("r")), F.count_if(F.col("l") & ~F.col("r")), F.count_if(~F.col("l") & F.col("r"))
    counts = flags.agg(both.alias("both"), lo.alias("left_only"), ro.alias("right_only"))
    union = F.greatest(F.lit(1), F.col("both") + F.col("left_only") + F.col("right_only"))
    return counts.withColumn("jaccard", F.round(F.col("both") / union, 6))


def source_frequency(all_tokens: DataFrame) -> DataFrame:
    """(sources, tokens): how many tokens occur in how many sources."""
    per = all_tokens.groupBy("token").agg(F.count_distinct("source").alias("sources"))
    return per.groupBy("sources").agg(F.count("*").alias("tokens"))


def multiset_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in common, counting repeats: the sum of the lesser counts."""
    a = left.groupBy("token").agg(F.count("*").alias("n"))
    b = right.groupBy("token").agg(F.count("*").alias("m"))
    return a.join(b, "token").agg(F.coalesce(F.sum(F.least("n", "m")), F.lit(0)).alias("shared_rows"), F.count("*").alias("shared_tokens"))


def person_tokens(linked: DataFrame, source: str, keys) -> DataFrame:
    """(source, token): digests of the strong and compound keys of linked evidence."""
    return linked.select(F.explode(keys).alias("k")).select(F.lit(source).alias("source"), F.sha2("k", 256).alias("token")).distinct()


def email_overlap(emails: DataFrame) -> DataFrame:
    """(left_source, right_source, shared): distinct addresses of each pair of sources.

    emails: (source, email). Sources are few; addresses meet in one aggregate.
    """
    per = emails.where("email <> ''").distinct().groupBy("email").agg(F.array_sort(F.collect_set("source")).alias("s")).where(F.size("s") > 1)
    pairs = F.flatten(F.transform("s", lambda a: F.transform(F.filter("s", lambda b: b > a), lambda b: F.struct(a.alias("l"), b.alias("r")))))
    return per.select(F.explode(pairs).alias("p")).groupBy(F.col("p.l").alias("left_source"), F.col("p.r").alias("right_source")).agg(F.count("*").alias("shared"))


def not_in_list(emails: DataFrame, listed: DataFrame, unit: str) -> DataFrame:
    """(email, rows): addresses no list holds, with the number of rows they stand in."""
    free = emails.where("email <> ''").join(listed.select("email").distinct(), "email", "left_anti")
    return free.groupBy("email").agg(F.count_distinct(unit).alias("rows"))
