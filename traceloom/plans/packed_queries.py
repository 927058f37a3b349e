"""Queries over packed cells (problem 3) and their DuckDB counterparts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.operators.packed import EVIDENCE_TYPES, FILE_PATHS, MAILBOXES, split_packed
from traceloom.session import table

FIELDS = (
    ("clusters_not_in_list", "cluster_no", "evidence_types", EVIDENCE_TYPES),
    ("clusters_not_in_list", "cluster_no", "file_paths", FILE_PATHS),
    ("synthetic_slim_contacts", "contact_no", "other_emails", MAILBOXES),
)


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    """(table_name, field_name, row_key, item_pos, item) of all packed cells."""
    parts = [
        split_packed(table(spark, base, name), key, column, field).select(
            F.lit(name).alias("table_name"), F.lit(column).alias("field_name"), "row_key", "item_pos", "item"
        )
        for name, key, column, field in FIELDS
    ]
    return reduce(DataFrame.unionByName, parts)


def p3_value_frequency(spark: SparkSession, base: str) -> DataFrame:
    """How often each unpacked value occurs, and in how many cells."""
    return (
        p3_found(spark, base)
        .groupBy("table_name", "field_name", "item")
        .agg(F.count("*").alias("n"), F.count_distinct("row_key").alias("n_cells"))
    )


_FOUND_SQL = r"""
WITH src AS (
  SELECT 'clusters_not_in_list' AS table_name, 'evidence_types' AS field_name, cluster_no AS row_key,
         evidence_types AS cell FROM clusters_not_in_list
  UNION ALL SELECT 'clusters_not_in_list', 'file_paths', cluster_no, file_paths FROM clusters_not_in_list
  UNION ALL SELECT 'synthetic_slim_contacts', 'other_emails', contact_no, other_emails FROM synthetic_slim_contacts
), quoted AS (
  SELECT table_name, field_name, row_key,
    CASE WHEN regexp_full_match(cell, '\s*\[(.|\n)*\]\s*')
      THEN replace(replace(regexp_replace(regexp_replace(cell, '^\s*\[', ''), '\]\s*$', ''), '\\', chr(57347)), '\"', chr(57346))
      ELSE replace(replace(replace(replace(cell, '""', chr(57346)), '\,', chr(57348) || '44'), '\;', chr(57348) || '59'), '\|', chr(57348) || '124')
    END AS cell
  FROM src
), held AS (
  SELECT table_name, field_name, row_key, list_transform(string_split(cell, '"'), lambda p, i:
    CASE WHEN i % 2 = 0 THEN chr(57345) || p || chr(57345)
    WHEN field_name = 'evidence_types' THEN regexp_replace(
      replace(replace(replace(p, 'Fee Status, Region', 'Fee Status' || chr(57348) || '44 Region'),
        'Bank Account, Sort Code', 'Bank Account' || chr(57348) || '44 Sort Code'),
        'Disability; Support Plan', 'Disability' || chr(57348) || '59 Support Plan'),
      '\s*[|;,\n\r\t](\s*[|;,\n\r\t])*\s*', chr(57344), 'g')
    WHEN field_name = 'file_paths' THEN regexp_replace(p,
      '\s*[|;,\n\r\t](?:\s*[|;,\n\r\t])*\s*(/|[A-Za-z]:\\|\.\.\.\(\+|$)', chr(57344) || '\1', 'g')
    ELSE regexp_replace(regexp_replace(p, '\s(and|/)\s', chr(57344), 'g'), '[|;,\n\r\t ]+', chr(57344), 'g') END) AS pieces
  FROM quoted
), slots AS (
  SELECT table_name, field_name, row_key, string_split(array_to_string(pieces, ''), chr(57344)) AS slots FROM held
), vals AS (
  SELECT table_name, field_name, row_key, list_filter(list_transform(slots, lambda s:
    CASE WHEN field_name = 'other_emails'
      THEN regexp_extract(replace(s, chr(57345), ' '), '([^\s<>()"''|;,:]+@[^\s<>()"''|;,:]+)', 1)
      ELSE replace(replace(replace(replace(replace(trim(replace(trim(s, chr(32) || chr(10) || chr(13) || chr(9)),
        chr(57345), CASE WHEN starts_with(trim(s), chr(57345)) THEN '' ELSE '"' END), chr(32) || chr(10) || chr(13) || chr(9)),
        chr(57346), '"'), chr(57347), '\'), chr(57348) || '44', ','), chr(57348) || '59', ';'), chr(57348) || '124', '|') END),
    lambda v: v <> '' AND NOT regexp_matches(v, '^(\.\.\.)?\s*\(\+\d+ more\)$')) AS vals
  FROM slots
)
SELECT table_name, field_name, row_key, CAST(unnest(generate_series(1, len(vals))) AS BIGINT) AS item_pos, unnest(vals) AS item
FROM vals WHERE len(vals) > 0
"""

QUERIES = {"p3_found": p3_found, "p3_value_frequency": p3_value_frequency}
SQL = {
    "p3_found": _FOUND_SQL,
    "p3_value_frequency": f"""SELECT table_name, field_name, item, count(*) AS n, count(DISTINCT row_key) AS n_cells
FROM ({_FOUND_SQL}) GROUP BY 1, 2, 3""",
}
