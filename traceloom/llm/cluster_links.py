"""Links between the rows of clusters_not_in_list, and their groups (problem 5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.llm.components import components, groups, star_edges
from traceloom.session import table

#: Types whose values are kept apart from each other nowhere: all are mailboxes.
EMAIL_TYPES = ("email", "institutional email", "personal email")
#: Anchor types that never link two rows.
WEAK_TYPES = ("dob", "name")


def _clean(value: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(value, r"^[\s \"'\[]+|[\s \"'\]]+$", "")))


def _typed(kind: Column, value: Column) -> Column:
    kind, value = _clean(kind), _clean(value)
    return F.when(
        (kind != "") & (value != "") & ~kind.isin(*WEAK_TYPES),
        F.concat(F.lit("v:"), F.when(kind.isin(*EMAIL_TYPES), F.lit("email")).otherwise(kind), F.lit("="), value),
    )


def merge_key_tokens(cell: Column) -> Column:
    """Link tokens of a merge-key cell; singleton keys and cap marks give none."""
    keys = F.split(cell, r"(?i)[\s\"\[]*(?:[|;,\n\r\t][\s|;,\"]*)(?=(?:strong|compound|singleton):|(?:\.{3}|…)?\(\+)")
    return F.transform(keys, lambda k: _merge_token(k))


def _merge_token(key: Column) -> Column:
    parts = F.split(F.regexp_replace(key, r"[\s|;,\"\]]+$", ""), ":", 3)
    kind = _clean(F.get(parts, F.lit(0)))
    whole = F.array_join(F.transform(F.split(key, ":"), _clean), ":")
    return F.when((kind == "strong") & (F.size(parts) == 3), _typed(F.get(parts, F.lit(1)), F.get(parts, F.lit(2)))).when(
        (kind == "compound") & (F.size(parts) == 3), F.concat(F.lit("c:"), whole)
    )


def anchor_tokens(cell: Column) -> Column:
    """Link tokens of an anchor cell ``type=value|type=value``."""
    anchors = F.split(cell, r"[\s\"\[]*[|;,\n\r\t][\s|;,\"]*(?=[A-Za-z][A-Za-z /]*=|(?:\.{3}|…)?\(\+)")
    def one(a: Column) -> Column:
        parts = F.split(F.regexp_replace(a, r"[\s|;,\"\]]+$", ""), "=", 2)
        return F.when(F.size(parts) == 2, _typed(F.get(parts, F.lit(0)), F.get(parts, F.lit(1))))
    return F.transform(anchors, one)


def cluster_tokens(clusters: DataFrame) -> DataFrame:
    """(cluster_no, token): every key by which a row may be linked."""
    person = _clean(F.col("person_cluster_id"))
    empty = F.array().cast("array<string>")
    tokens = F.concat(
        F.array(F.when(person != "", F.concat(F.lit("p:"), person))),
        F.coalesce(merge_key_tokens(F.col("cluster_merge_keys")), empty),
        F.coalesce(anchor_tokens(F.col("cluster_anchor_values")), empty),
    )
    return (
        clusters.select(F.col("cluster_no").cast("long").alias("cluster_no"), F.explode(F.array_distinct(tokens)).alias("token"))
        .where("token IS NOT NULL")
        # Tokens are joined on and kept as 16 bytes; equal digests mean equal tokens.
        .select("cluster_no", F.unhex(F.md5("token")).alias("token"))
    )


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    """(cluster_no, group_no) of every row in a group of two or more."""
    tokens = cluster_tokens(table(spark, base, "clusters_not_in_list"))
    edges = star_edges(tokens, "token", "cluster_no")
    return groups(edges).select(F.col("vertex").alias("cluster_no"), F.col("group").alias("group_no"))


def p5_group_sizes(spark: SparkSession, base: str) -> DataFrame:
    """(group_size, n_groups): how large the groups are."""
    sizes = p5_found(spark, base).groupBy("group_no").agg(F.count("*").alias("group_size"))
    return sizes.groupBy("group_size").agg(F.count("*").alias("n_groups"))


def p5_rounds(spark: SparkSession, base: str) -> DataFrame:
    """(round_no, edges, cut_edges, steps): what each round of the decomposition left between clusters."""
    report: list[dict] = []
    components(star_edges(cluster_tokens(table(spark, base, "clusters_not_in_list")), "token", "cluster_no"), report=report)
    return spark.createDataFrame([tuple(r.values()) for r in report], "round_no int, edges long, cut_edges long, steps int")


QUERIES = {"p5_rounds": p5_rounds, "p5_found": p5_found, "p5_group_sizes": p5_group_sizes}
#: The same by a transitive closure; fit for groups of some hundred rows, not for hubs.
_GROUPS_SQL = r"""
WITH RECURSIVE keys AS (SELECT cluster_no, unnest(string_split_regex(coalesce(cluster_merge_keys, ''), '\s*[|;,]\s*')) AS k FROM clusters_not_in_list),
anchors AS (SELECT cluster_no, unnest(string_split_regex(coalesce(cluster_anchor_values, ''), '\s*\|\s*')) AS a FROM clusters_not_in_list),
typed AS (SELECT cluster_no, lower(trim(split_part(k, ':', 2))) AS t, lower(trim(k[length(split_part(k, ':', 1)) + length(split_part(k, ':', 2)) + 3:])) AS v FROM keys WHERE lower(k) LIKE 'strong:%'
  UNION SELECT cluster_no, lower(trim(split_part(a, '=', 1))), lower(trim(a[length(split_part(a, '=', 1)) + 2:])) FROM anchors WHERE a LIKE '%=%'),
tokens AS (SELECT cluster_no, 'v:' || CASE WHEN t IN ('email', 'institutional email', 'personal email') THEN 'email' ELSE t END || '=' || v AS tok FROM typed WHERE t NOT IN ('dob', 'name', '') AND v <> ''
  UNION SELECT cluster_no, 'c:' || array_to_string(list_transform(string_split(k, ':'), lambda x: lower(trim(x))), ':') FROM keys WHERE lower(k) LIKE 'compound:%'
  UNION SELECT cluster_no, 'p:' || lower(trim(person_cluster_id)) FROM clusters_not_in_list WHERE trim(person_cluster_id) <> ''),
edges AS (SELECT DISTINCT a.cluster_no AS x, b.cluster_no AS y FROM tokens a JOIN tokens b ON a.tok = b.tok AND a.cluster_no <> b.cluster_no),
reach AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x)
SELECT x AS cluster_no, least(x, min(y)) AS group_no FROM reach GROUP BY x
"""
SQL: dict[str, str] = {
    "p5_found": _GROUPS_SQL,
    "p5_group_sizes": f"SELECT group_size, count(*) AS n_groups FROM (SELECT group_no, count(*) AS group_size FROM ({_GROUPS_SQL}) GROUP BY 1) GROUP BY 1",
}
