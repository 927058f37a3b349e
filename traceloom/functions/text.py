"""Projections on text: cells, slugs, normal forms, contexts, e-mail domains."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

TITLE_WORDS = "mr|mrs|ms|miss|mx|dr|prof|professor|sir|dame|lord|lady"
POSTCODE = r"(?:GIR0AA|[A-PR-UWYZ][A-HK-Y]?\d[A-HJKPSTUW\d]?\d[ABD-HJLNP-UW-Z]{2})"


def safe_cell(value: Column) -> Column:
    """Runs of white space (also no-break) to one space, ends trimmed; null to empty."""
    return F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)\s+", " "))


def slug(value: Column) -> Column:
    """Lower case, everything else than letters and digits to single underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(value, F.lit(""))), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def digits_only(value: Column) -> Column:
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"\D", "")


def compact_upper(value: Column) -> Column:
    """Without blanks and hyphens, upper case."""
    return F.upper(F.regexp_replace(F.coalesce(value, F.lit("")), r"[\s-]+", ""))


def address_compact(value: Column) -> Column:
    return F.upper(F.regexp_replace(F.coalesce(value, F.lit("")), "[^A-Za-z0-9]+", ""))


def clean_name(value: Column) -> Column:
    """Edge punctuation and titles off; one ``Last, First`` turned round."""
    v = F.regexp_replace(safe_cell(value), r"^[ ,;|/]+|[ ,;|/]+$", "")
    v = F.regexp_replace(v, rf"(?i)^(?:(?:{TITLE_WORDS})\.?\s+)+", "")
    last, first = F.trim(F.substring_index(v, ",", 1)), F.trim(F.substring_index(v, ",", -1))
    turned = (F.length(v) - F.length(F.replace(v, F.lit(","), F.lit(""))) == 1) & (last != "") & (first != "")
    return safe_cell(F.when(turned, F.concat_ws(" ", first, last)).otherwise(v))


def name_key(value: Column) -> Column:
    return F.lower(F.translate(clean_name(value), "’‘", "''"))


def canonical_postcode(value: Column) -> Column:
    """``AB1 2CD`` of a valid postcode, empty text otherwise."""
    compact = F.upper(F.regexp_replace(F.coalesce(value, F.lit("")), r"\s+", ""))
    good = compact.rlike(f"^{POSTCODE}$")
    return F.when(good, F.concat(F.expr("''"), F.substring(compact, F.lit(1), F.length(compact) - 3), F.lit(" "), F.right(compact, F.lit(3)))).otherwise("")


def country_name(value: Column, aliases: dict[str, Iterable[str]]) -> Column:
    """A country by its usual name, in capitals; ``aliases`` lists other names by it. Others stay as they are."""
    pairs = sorted((a.upper(), name) for name, others in aliases.items() for a in others)
    v = F.upper(safe_cell(value))
    if not pairs:
        return v
    # Membership is one look into a hash set; a map is searched entry by entry.
    known = F.create_map(*[F.lit(x) for p in pairs for x in p])
    return F.when(v.isin(*[a for a, _ in pairs]), F.element_at(known, v)).otherwise(v)


NORMAL_FORMS = {
    "lower": lambda v: F.lower(F.trim(v)),
    "compact_upper": compact_upper,
    "address_compact": address_compact,
    "name_casefold": name_key,
    "none": lambda v: F.trim(v),
}


def normal_form(strategy: str, value: Column) -> Column:
    """The value by a named strategy; an unknown name is an error at plan time."""
    return NORMAL_FORMS[strategy](value)


def context_window(text: Column, start: Column, end: Column, width: int = 80) -> Column:
    """The characters around [start, end), white space collapsed."""
    low = F.greatest(start - width, F.lit(0))
    return safe_cell(F.substring(text, (low + 1).cast("int"), (end + width - low).cast("int")))


def email_domain(value: Column) -> Column:
    v = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return F.when(v.contains("@"), F.regexp_replace(F.substring_index(v, "@", -1), r"^\.+|\.+$", "")).otherwise("")


def domain_matches(domain: Column, suffixes: Iterable[str]) -> Column:
    """Whether a domain ends with a suffix at a label boundary; ``*`` stands for anything."""
    hit = F.lit(False)
    for s in suffixes:
        s = s.strip().lower().lstrip("@.").rstrip(".")
        if "*" in s:
            pattern = ".+".join("".join("\\" + c if not c.isalnum() else c for c in part) for part in s.split("*"))
            hit = hit | domain.rlike(rf"^(?:.+\.)?{pattern}$")
        elif s:
            hit = hit | (domain == s) | domain.endswith("." + s)
    return hit


def email_type(value: Column, suffixes: Iterable[str]) -> Column:
    """Institutional or personal, by the domain; plain ``Email`` without suffixes."""
    suffixes = list(suffixes)
    if not suffixes:
        return F.lit("Email")
    return F.when(domain_matches(email_domain(value), suffixes), "Institutional Email").otherwise("Personal Email")


def lines(text: Column) -> Column:
    """Physical lines without their ends; a final line end makes no empty line."""
    parts = F.split(F.coalesce(text, F.lit("")), "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]")
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def capped_join(values: Column, limit: int = 50) -> Column:
    """Sorted distinct values joined by ``|``, beyond ``limit`` with the number left out."""
    kept = F.array_sort(F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != ""))))
    more = F.size(kept) - limit
    head = F.array_join(F.slice(kept, 1, limit), "|")
    return F.when(more > 0, F.concat(head, F.lit("|...(+"), more.cast("string"), F.lit(" more)"))).otherwise(head)


def alias_rules(text: str) -> list[tuple[str, str]]:
    """Pairs of domain beginnings that stand for each other: ``a.org == mail.a.org; b == c``."""
    out: list[tuple[str, str]] = []
    for part in text.replace(";", ",").split(","):
        left, eq, right = part.partition("==") if "==" in part else part.partition("=")
        left, right = (x.strip().lower().lstrip("@").strip(".") for x in (left, right))
        if eq and left and right and left != right and (left, right) not in out and (right, left) not in out:
            out.append((left, right))
    return out


def email_aliases(value: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """The address and those it equals by one rule, sorted; a domain begins with a rule's side."""
    v = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    local, domain = F.substring_index(v, "@", 1), F.substring_index(v, "@", -1)
    found = [F.when(v != "", v)]
    for a, b in [p for left, right in rules for p in ((left, right), (right, left))]:
        tail = F.substring(domain, F.lit(len(a) + 1), F.length(domain))
        hit = v.contains("@") & ((domain == a) | domain.startswith(a + "."))
        found.append(F.when(hit, F.concat(local, F.lit("@"), F.lit(b), tail)))
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))
