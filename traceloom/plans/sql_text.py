"""Pieces of SQL that several queries share."""

from __future__ import annotations

from collections.abc import Iterable

from traceloom.functions.validators import NO_PERSON_VALUE, STREET_WORDS
from traceloom.operators import linking as L
from traceloom.operators import people as P


def sql_list(words: Iterable[str]) -> str:
    """A list of texts."""
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def any_sql(words: Iterable[str]) -> str:
    """Whether the list ``types`` holds one of the words."""
    return f"list_has_any(types, {sql_list(words)})"


def exposure_sql() -> str:
    """Exposure of a person by the list ``types``."""
    return (
        f"CASE WHEN len(types) = 0 THEN 'none' WHEN {any_sql(L.STANDALONE)} OR ({any_sql(P.EMAILS)} AND {any_sql(('DOB', *P.IDS))}) "
        f"OR ({any_sql(L.SENSITIVE)} AND {any_sql(P.IDENTITY)}) THEN 'high' WHEN {any_sql(P.IDENTITY)} THEN 'medium' ELSE 'low' END"
    )


#: Whether a cleaned name ``c`` may be a person's, but for the number of its words.
NAME_SQL = rf"""(lower(c) NOT IN ('', 'n/a', 'na', 'none', 'null', 'not known', 'unknown') AND length(c) <= 120 AND regexp_full_match(c, '[\p{{L}} .''-]+')
  AND NOT list_has_any(regexp_extract_all(lower(c), '[a-z][a-z'']+'), {sql_list(NO_PERSON_VALUE)})
  AND NOT (regexp_matches(lower(c), '(?:^|[^\p{{L}}])(?:{"|".join(STREET_WORDS)})(?:$|[^\p{{L}}])') AND len(regexp_extract_all(c, '[A-Za-z][A-Za-z''.-]{{2,}}')) >= 2))"""
