"""Normal forms of names, birth dates, mailboxes and phone numbers, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters and their plain forms (fixed values); quotes and combining marks go,
#: digits become letters of like shape.
_PLAIN = {
    "a": "àáâãäåāăą", "c": "çćč", "d": "ďđð", "e": "èéêëēęěė", "g": "ğģ", "i": "ìíîïīı", "l": "łľĺ", "n": "ñńňņ", "o": "òóôõöøōő",
    "r": "ŕřŗ", "s": "śşšșß", "t": "ţťțþ", "u": "ùúûüūůűų", "y": "ýÿ", "z": "źżž",
}
_FROM = "".join(_PLAIN.values())
_TO = "".join(k * len(v) for k, v in _PLAIN.items())
_UPPER = [(f.upper(), t.upper()) for f, t in zip(_FROM, _TO) if len(f.upper()) == 1 and f.upper() != f]
_GONE = "'’`´\u0300\u0301\u0302\u0303\u0304\u0306\u0307\u0308\u030a\u030b\u030c\u0327\u0328"
#: Words of a name that do not tell people apart: titles and particles.
LEFT_OUT = ("dr", "mr", "mrs", "ms", "miss", "mx", "prof", "professor", "sir", "dame", "rev", "de", "van", "der", "den", "vander", "von", "la", "di", "al")


#: Short forms in common use, by the full name they stand for.
NICKNAMES = {
    "abigail": "abby abbie", "alexander": "alex sandy xander", "andrew": "andy drew", "anthony": "tony", "arabella": "bella",
    "barnaby": "barney", "beatrice": "bea", "beatrix": "trixie", "benjamin": "ben benji benny", "bernard": "bernie", "bridget": "bridie biddy",
    "caroline": "carrie car", "ibrahim": "ibby", "cassandra": "cassie sandra", "charles": "charlie chas chuck", "charlotte": "lottie", "chiamaka": "amaka",
    "christopher": "chris kit", "clementine": "clemmie", "constance": "connie", "cordelia": "delia", "cornelius": "neil", "daniel": "dan danny",
    "david": "dave davy", "deborah": "deb debbie", "dominic": "dom nic", "dorothea": "dot thea dora", "douglas": "doug", "edward": "ed eddie ted ned",
    "eleanor": "ellie nell nora", "elizabeth": "liz lizzie beth betty eliza", "emmeline": "emmy", "ernest": "ernie", "eugenia": "genie",
    "evangeline": "eva evie", "felicity": "fliss", "francesca": "fran frankie chess", "franklin": "frank", "frederick": "fred freddie freddy",
    "gabriel": "gabe", "geoffrey": "geoff jeff", "georgina": "georgie gina", "gerald": "gerry", "gregory": "greg", "gwendolyn": "gwen wendy",
    "harriet": "hattie", "henrietta": "hettie etta", "herbert": "bert herb", "ikechukwu": "ike", "imogen": "immy",
    "isabella": "izzy", "jacqueline": "jackie", "jeremiah": "jerry", "jonathan": "jon", "joseph": "joe joey", "josephine": "jo josie",
    "judith": "judy", "katherine": "kate katie kathy kitty kit", "lawrence": "larry laurie", "leonard": "len lenny", "letitia": "letty tish",
    "lucinda": "lucy cindy", "madeleine": "maddie maddy", "mahmoud": "moody", "margaret": "maggie meg peggy", "marianne": "mari",
    "matthew": "matt", "maximilian": "max", "michael": "mike mick mickey", "millicent": "millie", "montgomery": "monty", "nathaniel": "nat nate",
    "nicholas": "nick nicky", "octavia": "tavi", "oliver": "ollie", "olumide": "olu", "patricia": "pat patty trish", "penelope": "penny",
    "percival": "percy", "peter": "pete", "philippa": "pippa pip", "prudence": "prue", "raymond": "ray", "rebecca": "becky becca", "reginald": "reg reggie",
    "richard": "rick dick rich", "robert": "rob bob bobby", "rosalind": "ros roz", "rosemary": "rosie romy", "rudolph": "rudy", "samantha": "sam sammy",
    "samuel": "sam", "sebastian": "seb", "stephen": "steve ste", "susannah": "sue susie", "svetlana": "sveta lana", "sylvester": "sly", "tabitha": "tabby", "tadeusz": "tadek",
    "theodore": "theo", "thomas": "tom tommy thos", "timothy": "tim timmy", "valentina": "val", "victoria": "vicky tori", "vincent": "vince vinny",
    "wilhelmina": "mina billie", "william": "bill billy will liam", "winifred": "win winnie freda", "yelena": "lena", "zachary": "zach zac",
}
#: Short forms that are names of their own are not replaced.
_OWN = {"drew", "frank", "lucy", "rose", "will", "kit", "nora", "eva", "sandra", "bella", "neil", "frankie", "liam", "theo", "pat", "mari", "rosie", "sandy"}


def unambiguous() -> list[tuple[str, str]]:
    """(short, full) of the short forms that name tokens replace."""
    seen: dict[str, set[str]] = {}
    for full, shorts in NICKNAMES.items():
        for s in shorts.split():
            seen.setdefault(s, set()).add(full)
    return [(s, next(iter(f))) for s, f in sorted(seen.items()) if len(f) == 1 and s not in _OWN]


def given_map() -> Column:
    """Map from a short form to its full name; ambiguous or independent ones are left out."""
    return F.create_map(*[F.lit(x) for p in unambiguous() for x in p])


def initials_of(token: Column) -> Column:
    """The initials a token may stand for: its own, and those of the full names it shortens."""
    by: dict[str, set[str]] = {}
    for short, full in same_name_pairs():
        if short[0] != full[0]:
            by.setdefault(short, set()).add(full[0])
    other = F.create_map(*[x for s, i in sorted(by.items()) for x in (F.lit(s), F.array(*[F.lit(c) for c in sorted(i)]))])
    own = F.array(F.substring(token, 1, 1))
    return F.when(token.isin(*by), F.concat(own, F.element_at(other, token))).otherwise(own)


def same_name_pairs() -> list[tuple[str, str]]:
    """(short, full) pairs that may stand for each other and are not replaced."""
    gone = set(unambiguous())
    return [(s, f) for f, shorts in NICKNAMES.items() for s in shorts.split() if (s, f) not in gone]


def fold(text: Column) -> Column:
    """Letters without accents, case kept; quotes and combining marks gone, digits as letters."""
    frm = _FROM + "".join(f for f, _ in _UPPER) + "015" + _GONE
    to = _TO + "".join(t for _, t in _UPPER) + "ols"
    return F.translate(text, frm, to)


def name_tokens(name: Column) -> Column:
    """Tokens of a name in plain letters: no title, no particle, merged parts parted.

    ``Last, First`` needs no turning since tokens carry no order here.
    """
    # The capital is asked for first: what is before it is looked at only there.
    parted = F.regexp_replace(fold(name), r"(?=[A-Z])(?<=[a-z])(?<!\bMc)(?<!\bMac)", " ")
    tokens = F.split(F.regexp_replace(F.lower(parted), "[^a-z]+", " "), " ")
    tokens = F.filter(tokens, lambda t: (t != "") & ~t.isin(*LEFT_OUT))
    full = given_map()
    shorts = [s for s, _ in unambiguous()]

    def whole(t: Column) -> Column:
        # Membership is one look into a hash set; a map is searched entry by entry.
        named = F.when(t.isin(*shorts), F.element_at(full, t)).otherwise(t)
        return F.when(t.startswith("vander") & (F.length(t) > 8), F.substring(t, 7, 99)).otherwise(named)

    # Sorted by compiled code; array_sort would call a comparator written in SQL.
    return F.sort_array(F.array_distinct(F.transform(tokens, whole)))


def _months() -> Column:
    """Map from the first three letters of a month to its number."""
    return F.create_map(*[F.lit(x) for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1) for x in (m, f"{i:02d}")])


def birth_parts(value: Column) -> tuple[Column, Column, Column]:
    """(year, month, day) as text, null where unknown; placeholders are unknown."""
    v = F.lower(F.trim(value))
    months = _months()
    two = lambda c: F.lpad(c, 2, "0")
    forms = [  # pattern, year group, month group (or name), day group
        (r"^(\d{4})-(\d{2})-(\d{2})", 1, 2, 3), (r"^(\d{4})(\d{2})(\d{2})$", 1, 2, 3), (r"^(\d{1,2})[/.](\d{1,2})[/.](\d{4})$", 3, 2, 1),
        (r"^(\d{1,2}) ([a-z]{3})[a-z]* (\d{4})$", 3, -2, 1), (r"^(\d{4})-(\d{2})$", 1, 2, 0), (r"^(\d{2})/(\d{4})$", 2, 1, 0),
        (r"^([a-z]{3})[a-z]* (\d{4})$", 2, -1, 0), (r"^(\d{4})$", 1, 0, 0),
    ]
    year = month = day = F.lit(None).cast("string")
    for pattern, y, m, d in reversed(forms):
        hit = v.rlike(pattern)
        year = F.when(hit, F.regexp_extract(v, pattern, y)).otherwise(year)
        mm = F.lit(None).cast("string") if m == 0 else two(F.regexp_extract(v, pattern, m)) if m > 0 else F.element_at(months, F.regexp_extract(v, pattern, -m))
        month = F.when(hit, mm).otherwise(month)
        day = F.when(hit, two(F.regexp_extract(v, pattern, d)) if d else F.lit(None).cast("string")).otherwise(day)
    unknown = (year == "1900") | (year < "1900")
    return tuple(F.when(unknown, None).otherwise(c) for c in (year, month, day))


def birth_date(value: Column) -> Column:
    """yyyymmdd of a full date, else null; the usual form is tried first and costs one test.

    Each form tests its own year, so that no date is made twice.
    """
    v = F.trim(value)
    iso = v.rlike(r"^\d{4}-?\d{2}-?\d{2}")
    plain = F.substring(F.replace(v, F.lit("-"), F.lit("")), 1, 8)
    slashed = v.rlike(r"^\d{1,2}[/.]\d{1,2}[/.]\d{4}$")
    part = F.split(F.translate(v, ".", "/"), "/")
    turned = F.concat(F.get(part, F.lit(2)), F.lpad(F.get(part, F.lit(1)), 2, "0"), F.lpad(F.get(part, F.lit(0)), 2, "0"))
    low, named = F.lower(v), r"^(\d{1,2}) ([a-z]{3})[a-z]* (\d{4})$"
    day, month, year = (F.regexp_extract(low, named, i) for i in (1, 2, 3))
    spelled = F.concat(year, F.element_at(_months(), month), F.lpad(day, 2, "0"))
    since = lambda y, date: F.when(y >= "1901", date)
    return F.when(iso, since(F.substring(v, 1, 4), plain)).when(slashed, since(F.get(part, F.lit(2)), turned)).when(
        F.length(v) >= 9, F.when(low.rlike(named), since(year, spelled)))


def mailbox(value: Column) -> Column:
    """Local part of an address: lower case, no tag; domains vary for one person."""
    v = F.lower(F.trim(value))
    local = F.substring_index(v, "@", 1)
    untagged = F.when(local.contains("+"), F.regexp_replace(local, r"\+.*$", "")).otherwise(local)
    return F.when(v.contains("@"), F.nullif(untagged, F.lit("")))


def phone(value: Column) -> Column:
    """Last nine digits of a number, so that trunk and country prefixes agree."""
    digits = F.regexp_replace(value, r"\D", "")
    return F.when(F.length(digits) >= 9, F.substring(digits, -9, 9))


def people_rows(df: DataFrame, key: str, names: list[str], dob: str, mails: list[str]) -> DataFrame:
    """(key, tokens, dob, mails) of a table of people; rows without key are left out."""
    whole = F.concat_ws(" ", *[F.col(f"`{c}`") for c in names])
    return df.where(F.trim(F.col(f"`{key}`").cast("string")) != "").select(
        F.trim(F.col(f"`{key}`").cast("string")).alias("key"),
        name_tokens(whole).alias("tokens"),
        birth_date(F.col(f"`{dob}`").cast("string")).alias("dob"),
        F.array_distinct(F.array_compact(F.array(*[mailbox(F.col(f"`{c}`")) for c in mails]))).alias("mails"),
    )
