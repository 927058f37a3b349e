"""Several values packed in one cell: one row per value, with its position.

The cell is split on quote characters. Pieces with an odd index are literals
(whatever delimiters they hold), pieces with an even index are split on the
field's delimiters; an array fold joins the pieces back into values. All of it
is a chain of built-in expressions inside one projection: no shuffle, no Python.

Defined results: a null, empty or blank cell and empty slots give no rows; a
cell with one value gives one row; repeated values stay (each has a position);
an unclosed quote is kept as text; cap marks such as ``...(+7 more)`` are no
values. Columns of the input other than the key and the field are not needed
and may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Private-use marks that stand for structure while a cell is being folded.
SLOT, LIT, QUOTE, BACK, HELD = "\ue000", "\ue001", "\ue002", "\ue003", "\ue004"
#: Delimiters that a backslash or a known literal takes out of splitting.
HOLDABLE = "|;,"
#: Blanks at either end. Runs are possessive and begin where the run does, so that no pattern
#: here takes more than linear time or a deep stack, however long the cell.
EDGES = r"^[\s\u00a0]++|(?<![\s\u00a0])[\s\u00a0]++$"
CAP_MARK = r"^(\.{3}|\u2026)?\s*\(\+\d+ more\)$"


@dataclass(frozen=True)
class PackedField:
    """How the values of one field look.

    starts: regex that a value begins with; a delimiter only counts where such
      a start (or a quote, a cap mark or the end) follows. None: it always counts.
    literals: values that hold a delimiter although they are often not quoted.
    delimiters: regex of one delimiter; None: any of | ; , and line ends and tabs, or a run of them.
    pick: regex of the part of a value that is wanted (group 1), for values that
      carry names or schemes around them.
    """

    delimiters: str | None = None
    starts: str | None = None
    literals: tuple[str, ...] = ()
    pick: str | None = None


def _held(delimiter: str) -> str:
    return HELD + str(ord(delimiter)) + HELD


def _is_list(cell: Column) -> Column:
    """Whether a cell is a list in brackets whose outermost values are quoted; told from its ends alone."""
    bare = F.trim(F.regexp_replace(cell, EDGES, ""))
    inner = F.regexp_replace(F.substring(bare, F.lit(2), F.length(bare) - 2), EDGES, "")
    return bare.startswith("[") & bare.endswith("]") & (F.length(bare) >= 2) & ((inner == "") | (inner.startswith('"') & inner.endswith('"') & (F.length(inner) >= 2)))


def _normal_quotes(cell: Column) -> Column:
    """Brackets off, escapes of both quoting styles turned into marks."""
    listed = F.regexp_replace(F.regexp_replace(cell, r"^\s*+\[", ""), r"\](?:\s++$|$)", "")
    listed = F.replace(F.replace(listed, F.lit("\\\\"), F.lit(BACK)), F.lit('\\"'), F.lit(QUOTE))
    plain = F.regexp_replace(cell, r'(^|[|;,\n\r\t])([ \u00a0]*+)""(?=[ \u00a0]*+($|[|;,\n\r\t]))', "$1$2")
    plain = F.replace(plain, F.lit('""'), F.lit(QUOTE))
    for d in HOLDABLE:
        plain = F.replace(plain, F.lit("\\" + d), F.lit(_held(d)))
    return F.when(_is_list(cell), listed).otherwise(plain)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, not once per element of the arrays it is used in."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def packed_values(cell: Column, field: PackedField) -> Column:
    """Array of the values of a cell, in order."""
    ahead = "" if field.starts is None else rf"(?={field.starts}|(?:\.{{3}}|\u2026)?\(\+\d+ more\)|$)"
    separator = field.delimiters or rf"(?<![\s|;,])[ \u00a0]*+[|;,\n\r\t][\s|;,]*+{ahead}"

    def even(piece: Column) -> Column:
        for value in field.literals:
            held = value
            for d in HOLDABLE:
                held = held.replace(d, _held(d))
            piece = F.replace(piece, F.lit(value), F.lit(held))
        return F.regexp_replace(piece, separator, SLOT)

    def mark(piece: Column, i: Column, last: Column) -> Column:
        odd = i % 2 == 1
        return (
            F.when(odd & (i < last), F.concat(F.lit(LIT), piece, F.lit(LIT)))
            .when(odd, F.concat(F.lit('"'), even(piece)))
            .otherwise(even(piece))
        )

    def fold(pieces: Column) -> Column:
        """The marked pieces put together again, and split at the slots."""
        last = F.size(pieces) - 1
        return _let(last, lambda n: F.split(F.array_join(F.transform(pieces, lambda p, i: mark(p, i, n)), ""), SLOT))

    slots = _let(F.split(_normal_quotes(cell), '"'), fold)

    def restore(value: Column) -> Column:
        value = F.trim(F.regexp_replace(value, EDGES, ""))
        if field.pick:
            value = F.replace(value, F.lit(LIT), F.lit(" "))
            value = F.regexp_extract(value, field.pick, 1)
        else:
            bare = F.regexp_replace(value, rf"^{LIT}\s*([^{LIT}]*?)\s*{LIT}$", "$1")
            value = F.replace(bare, F.lit(LIT), F.lit('"'))
        value = F.replace(F.replace(value, F.lit(QUOTE), F.lit('"')), F.lit(BACK), F.lit("\\"))
        for d in HOLDABLE:
            value = F.replace(value, F.lit(_held(d)), F.lit(d))
        return value

    return F.filter(F.transform(slots, restore), lambda v: (v != "") & ~v.rlike(CAP_MARK))


def split_packed(df: DataFrame, key: str, column: str, field: PackedField) -> DataFrame:
    """(row_key, item_pos, item): one row per value of ``column``."""
    values = df.select(
        F.col(f"`{key}`").cast("long").alias("row_key"),
        packed_values(F.col(f"`{column}`").cast("string"), field).alias("_values"),
    )
    return values.select("row_key", F.posexplode("_values").alias("_pos", "item")).select(
        "row_key", (F.col("_pos") + 1).cast("long").alias("item_pos"), "item"
    )


#: The packed fields of this project's tables. File paths start with a slash or
#: a drive; three evidence types hold a delimiter of their own.
EVIDENCE_TYPES = PackedField(
    literals=("Fee Status, Region", "Bank Account, Sort Code", "Disability; Support Plan")
)
FILE_PATHS = PackedField(starts=r"/|[A-Za-z]:\\")
MAILBOXES = PackedField(
    delimiters=r"(?:[|;,\n\r\t]|\s/\s|\s(?i:and|or|und|et)\s|(?<=[\w>])\s(?=<?[\w.+\-]+@))",
    pick=r"(?<![^\s<>()\[\]\"'|;,:])([^\s<>()\[\]\"'|;,:]+@[^\s<>()\[\]\"'|;,:]+)",
)
