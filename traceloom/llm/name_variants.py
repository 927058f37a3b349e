"""Variant spellings of people's names, linked across tables (problem 4).

A typed name becomes tokens; each ordered pair of tokens gives one object: the
initial of the one and the whole of the other, so turned parts, short forms and
initials still share an object. The space of objects has a discrete part (a
piece of evidence that two rows of one person share, birth date or mailbox, and
the initial) and the edit distance of the whole token.
Metric partitioning finds all objects within the radius; an exact check aligns
the two names token by token. Links are consolidated into people.

Defined results: rows without key or with a name of a single token link nothing
by name; repeated rows count once; a key never pairs with itself; empty tables
give no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from traceloom.llm.components import hooked_components
from traceloom.llm.metric_join import CELL, cell_sizes, listed_apart, radius_pairs
from traceloom.llm.people import initials_of, people_rows, same_name_pairs
from traceloom.session import cut, table

RADIUS = 2


def tokens_agree(a: Column, b: Column) -> Column:
    """Whether two tokens may be one: equal, an initial, typed alike, or a short form.

    The tests are in order of their cost; the first that holds ends them.
    """
    shortest = F.least(F.length(a), F.length(b))
    first = F.substring(a, 1, 1) == F.substring(b, 1, 1)
    limit = F.when(shortest <= 1, 0).when(shortest <= 3, 1).otherwise(2)
    typed = (shortest > 1) & ((shortest > 2) | first) & (F.levenshtein(a, b, 2).between(0, limit))
    # One look into a hash set; a text of all pairs would be searched from end to end.
    known = F.concat(a, F.lit("="), b).isin(*[x for p, q in same_name_pairs() for x in (f"{p}={q}", f"{q}={p}")])
    return (a == b) | ((shortest == 1) & first) | typed | ((shortest > 2) & known)


def names_agree(a: Column, b: Column) -> Column:
    """Whether every token of the shorter name has a counterpart in the longer one.

    Two tokens must agree at least, one of them in more than its initial.
    Names and hits are bound to variables, else each use would make them again.
    """
    def told(s: Column) -> Column:
        less, more = s["less"], s["more"]
        most = F.when(F.size(less) > 2, F.size(less) - 1).otherwise(F.size(less))

        def enough(hits: Column) -> Column:
            solid = F.exists(hits, lambda x: (F.length(x) > 2) & F.exists(more, lambda y: (F.length(y) > 2) & tokens_agree(x, y)))
            return (F.size(hits) >= F.greatest(F.lit(2), most)) & solid

        return F.exists(F.array(F.filter(less, lambda x: F.exists(more, lambda y: tokens_agree(x, y)))), enough)

    def turned(s: Column) -> Column:
        short = F.size(s["a"]) <= F.size(s["b"])
        return F.when(short, F.struct(s["a"].alias("less"), s["b"].alias("more"))).otherwise(F.struct(s["b"].alias("less"), s["a"].alias("more")))

    return F.exists(F.transform(F.array(F.struct(a.alias("a"), b.alias("b"))), turned), told)


def share_object(a: Column, b: Column, radius: int) -> Column:
    """Whether two names have objects within the radius: whole tokens that near, beside others of one initial."""
    def beside(tokens: Column, at: Column) -> Column:
        return F.flatten(F.transform(F.filter(tokens, lambda t, k: k != at), initials_of))

    def met(x: Column, i: Column, y: Column, j: Column) -> Column:
        near = (F.length(y) >= 3) & F.levenshtein(x, y, radius).between(0, radius)
        return F.when(near, F.arrays_overlap(beside(a, i), beside(b, j))).otherwise(False)

    return F.size(F.filter(a, lambda x, i: (F.length(x) >= 3) & (F.size(F.filter(b, lambda y, j: met(x, i, y, j))) > 0))) > 0


def evidence(rows: DataFrame) -> DataFrame:
    """(proof, name, key): one row per key, name and piece of evidence.

    Names travel as one text, evidence and keys as 64 bits: all are shuffled more
    than once, and numbers aggregate by hash where texts would be sorted.
    """
    # Numbered by a generator, which is compiled code: the first is the date, mailboxes follow.
    proofs = F.concat(F.array("dob"), F.coalesce("mails", F.array().cast("array<string>")))
    # A filter on the tokens would be moved to the scan, where names would be parsed a second time.
    proofs = F.when(F.size("tokens") >= 2, proofs)
    named = rows.select(F.xxhash64("key").alias("key"), F.array_join("tokens", " ").alias("name"), F.posexplode(proofs).alias("at", "value"))
    hashed = named.where("value IS NOT NULL AND (at = 0 OR length(value) >= 4)").select(
        F.xxhash64(F.concat(F.when(F.col("at") == 0, "d").otherwise("m"), "value")).alias("proof"), "name", "key"
    )
    # Placed by proof and name, as all that follows asks; so it is shuffled once.
    return hashed.repartition("proof", "name").distinct()


def held_evidence(rows: DataFrame) -> DataFrame:
    """The evidence with the least key of its proof and name as ``holder``.

    It is placed by both, so the window shuffles nothing; its buffer spills.
    """
    return evidence(rows).withColumn("holder", F.min("key").over(Window.partitionBy("proof", "name")))


def variant_links(rows: DataFrame, radius: int = RADIUS, report: list[dict] | None = None) -> DataFrame:
    """(a, b): hashed keys with variant spellings of one name and a common proof.

    Keys of equal name and proof are a star around the least of them; only that
    one stands for the name when spellings are compared.
    """
    known = cut(held_evidence(rows))
    holders = known.where("key = holder").drop("key")
    stars = known.where("key <> holder").select(F.col("key").alias("a"), F.col("holder").alias("b"))
    agree = names_agree(F.split("name_a", " "), F.split("name_b", " "))
    # A proof of a few names is a cell of its own: names are compared as they are, no objects are made of them.
    many = cut(holders.groupBy("proof").agg(F.count("*").alias("names")).where(F.col("names") > CELL).select("proof"))
    crowded, few = listed_apart(holders, many, "proof")
    sides = [few.select("proof", F.col("name").alias(f"name_{s}"), F.col("holder").alias(f"holder_{s}")) for s in "ab"]
    shared = share_object(F.split("name_a", " "), F.split("name_b", " "), radius)
    within = sides[0].join(sides[1], "proof").where(F.when(F.col("holder_a") < F.col("holder_b"), F.when(agree, shared).otherwise(False)).otherwise(False))
    near = radius_pairs(
        name_objects(holders.join(crowded, "proof")), "block", F.get(F.split("name", " "), F.col("n")), radius, keep=("name", "holder"), apart="holder", check=agree, report=report
    )
    if report is not None:
        own = cell_sizes(few, "proof")
        report[0] |= {"cells": report[0]["cells"] + own["cells"], "places": report[0]["places"] + own["places"], "largest": max(report[0]["largest"], own["largest"])}
    ends = [F.col("holder_a").alias("a"), F.col("holder_b").alias("b")]
    return near.select(*ends).unionByName(within.select(*ends)).unionByName(stars).distinct()


def name_objects(holders: DataFrame) -> DataFrame:
    """(block, n, name, holder): the objects of names (proof, name, holder), by proof and initial; ``n`` is the place of the whole token.

    The token that is compared is read from the name on the far side of the exchange.
    """
    tokens = F.split("name", " ")
    # Two generators are compiled code, nested functions over arrays would be interpreted.
    wholes = holders.select("proof", "name", "holder", F.posexplode(tokens).alias("n", "t")).where(F.length("t") >= 3)
    others = wholes.select("proof", "name", "holder", F.col("n").cast("tinyint").alias("n"), F.posexplode(tokens).alias("m", "i")).where("m <> n")
    return others.select("proof", "n", "name", "holder", F.explode(initials_of(F.col("i"))).alias("c")).select(F.xxhash64("proof", "c").alias("block"), "n", "name", "holder")


def people_of(links: DataFrame, rows: DataFrame) -> DataFrame:
    """(key, person): the keys of ``rows`` that are linked to others."""
    found = hooked_components(links)
    # Joined before repeated keys are left out, so both read one exchange.
    keys = rows.select("key", F.xxhash64("key").alias("vertex")).join(found, "vertex").distinct()
    return keys.select("key", F.col("root").alias("person"))


def keyed_rows(spark: SparkSession, base: str) -> DataFrame:
    """The people of the three tables of problem 4, brought together before they are read."""
    def raw(name, key, first, last, dob, mail, other):
        pick = [key, first, last, dob, mail, other]
        return table(spark, base, name).select(*[
            (F.col(c).cast("string") if c else F.lit(None).cast("string")).alias(a) for c, a in zip(pick, ("id", "first", "last", "dob", "mail", "other"))
        ])

    rows = raw("exposed_records_008", "student_id", "full_name", None, "dob", "email", None).unionByName(
        raw("exposed_roster_003", "id", "first_name", "last_name", "dob", "uon_email", "other_email")
    ).unionByName(raw("roster_contacts_a", "external_ref", "full_name", None, "birth_when", "mailbox", None))
    return people_rows(rows, "id", ["first", "last"], "dob", ["mail", "other"])


def _people(spark: SparkSession, base: str) -> DataFrame:
    rows = keyed_rows(spark, base)
    return people_of(variant_links(rows), rows)


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    """(key_a, key_b): every pair of different keys of one person."""
    people = cut(_people(spark, base))
    other = people.withColumnRenamed("key", "key_b")
    return people.withColumnRenamed("key", "key_a").join(other, "person").where("key_a < key_b").select("key_a", "key_b")


def p4_people(spark: SparkSession, base: str) -> DataFrame:
    """(keys, people): how many keys one person holds."""
    sizes = _people(spark, base).groupBy("person").agg(F.count("*").alias("keys"))
    return sizes.groupBy("keys").agg(F.count("*").alias("people"))


def p4_cells(spark: SparkSession, base: str) -> DataFrame:
    """(level, cells, places, largest): cells of the metric partitioning, how many strings stand in them, and in the largest.

    Level 0 has the blocks that are one cell, each further level the cells of pivots.
    """
    report: list[dict] = []
    variant_links(keyed_rows(spark, base), report=report)
    return spark.createDataFrame([tuple(r.values()) for r in report], "level int, cells long, places long, largest long")


def p4_representatives(spark: SparkSession, base: str) -> DataFrame:
    """(key, representative): every linked key with the least key of its person.

    The form of ``p4_found`` that grows with the keys and not with their pairs.
    """
    people = cut(_people(spark, base))
    return people.join(people.groupBy("person").agg(F.min("key").alias("representative")), "person").select("key", "representative")


QUERIES = {"p4_found": p4_found, "p4_people": p4_people, "p4_cells": p4_cells, "p4_representatives": p4_representatives}
SQL: dict[str, str] = {}
