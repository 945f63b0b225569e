"""Sponsor cells: names, parties, districts and roles as column expressions.

Text is expected in NFKC; ``udfs.nfkc`` brings other text there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ids import collapse
from .text import split_list

# Spellings of parties.
PARTIES = {"d": "D", "dem": "D", "democrat": "D", "democratic": "D", "r": "R", "rep": "R", "republican": "R", "i": "I", "ind": "I", "independent": "I", "l": "L", "libertarian": "L", "g": "G", "green": "G", "np": "NP", "nonpartisan": "NP"}
# Cells without a name.
PLACEHOLDERS = ["none", "n/a", "na", "vacant"]
# What a trailing role word says.
ROLES = {"primary": "primary", "lead": "primary", "author": "primary", "cosponsor": "cosponsor", "coauthor": "cosponsor"}
# Words of a name that stay lower, or upper.
PARTICLES = ["de", "del", "der", "van", "von", "da", "di", "la", "le", "du", "of", "the"]
UPPER = ["ii", "iii", "iv", "jr", "sr", "md", "phd", "dds", "cpa", "usa", "us"]
# Wording in front of a name, and the wording that tells the chamber.
TITLE = r"(?i)^(?:the\s+)?(?:hon\.?|honorable|rep\.?|representative|sen\.?|senator|assemblyman|assemblywoman|assembly\s?member|delegate|del\.?|mr\.?|mrs\.?|ms\.?|dr\.?)\s+"
SENATE, HOUSE = r"(?i)\b(sen\.?|senator)\b", r"(?i)\b(rep\.?|representative|assembly|delegate|del\.?)\b"
ROLE_AT_END = r"(?i)\s*[-–,]\s*(primary|co-?sponsor|lead|author|coauthor)\s*$"
PARTY_DISTRICT = r"^\s*([A-Za-z]{1,12})\s*[-–/]\s*([A-Za-z0-9\- ]{1,12})\s*$"
DISTRICT = r"(?i)\bdistrict\s+([A-Za-z0-9\-]+)"
COMMITTEE = r"(?i)\b(committee|caucus|delegation|subcommittee)\b"

SPONSOR = "struct<name:string,role:string,party:string,district:string,chamber:string>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where no projection can hold it."""
    return F.element_at(F.transform(F.array(value), use), 1)


# Typographic characters and what stands for them; the soft hyphen goes.
_TYPOGRAPHIC = '\u2018\u2019\u201a\u201c\u201d\u201e\u2013\u2014\u2212\xa0'
_PLAIN = '\'\'\'"""--- '


def straight_quotes(text: Column) -> Column:
    """Plain quotes, dashes and spaces for typographic ones."""
    return F.translate(text, _TYPOGRAPHIC, _PLAIN)


def clean_line(text: Column) -> Column:
    """One line: plain quotes and dashes, no soft hyphens, single spaces; null gives ''."""
    return collapse(F.translate(F.coalesce(text, F.lit("")), "‘’‚“”„–—− ­", "'''\"\"\"--- "))


def _capital(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, 1 << 20)))


def titlecase_name(text: Column) -> Column:
    """Name in mixed case: Mc and O' prefixes, hyphens, particles and suffixes by rule."""

    def word(w: Column, i: Column) -> Column:
        def styled(bare: Column) -> Column:
            low = F.lower(bare)
            tail = F.substring(w, F.length(bare) + 1, F.length(w))
            after = lambda n: _capital(F.substring(bare, n + 1, 1 << 20))
            return (
                F.when(bare == "", w)
                .when(low.isin(UPPER), F.concat(F.upper(bare), tail))
                .when(low.isin(PARTICLES) & (i > 0), F.concat(low, tail))
                .when((F.length(bare) <= 2) & bare.rlike(r"^\p{Lu}+$"), F.concat(bare, tail))
                .when(low.startswith("mc") & (F.length(bare) > 2), F.concat(F.lit("Mc"), after(2), tail))
                .when(low.startswith("o'") & (F.length(bare) > 2), F.concat(F.lit("O'"), after(2), tail))
                .otherwise(F.concat(F.array_join(F.transform(F.split(bare, "-"), _capital), "-"), tail))
            )

        return let(F.regexp_replace(w, r"^[,.]+|[,.]+$", ""), styled)

    return F.array_join(F.transform(F.split(clean_line(text), " "), word), " ")


def party(raw: Column) -> Column:
    """Letter of a party; other spellings give their first four letters; blank gives null."""
    known = F.create_map(*[F.lit(x) for kv in PARTIES.items() for x in kv])
    key = F.lower(F.regexp_replace(F.trim(raw), r"^\.+|\.+$", ""))
    return F.when(key != "", F.coalesce(F.try_element_at(known, key), F.nullif(F.substring(F.upper(F.trim(raw)), 1, 4), F.lit(""))))


def _bracketed(text: Column) -> Column:
    """struct(party, district) of the groups in brackets; a later group overrides."""
    start = F.struct(F.lit(None).cast("string").alias("party"), F.lit(None).cast("string").alias("district"))

    def fold(seen: Column, group: Column) -> Column:
        inner = F.trim(group)
        both, alone = inner.rlike(PARTY_DISTRICT), F.lower(inner).isin(list(PARTIES)) | inner.rlike(r"^\p{L}{1,4}$")
        named = F.nullif(F.regexp_extract(inner, DISTRICT, 1), F.lit(""))
        p = F.when(both, party(F.regexp_extract(inner, PARTY_DISTRICT, 1))).when(alone, party(inner)).otherwise(seen["party"])
        d = F.when(both, F.nullif(F.trim(F.regexp_extract(inner, PARTY_DISTRICT, 2)), F.lit(""))).when(alone, seen["district"]).otherwise(F.coalesce(named, seen["district"]))
        return F.struct(p.alias("party"), d.alias("district"))

    return F.aggregate(F.regexp_extract_all(text, F.lit(r"\(([^)]*)\)"), F.lit(1)), start, fold)


def sponsor(raw: Column, default_role: Column | None = None, default_chamber: Column | None = None) -> Column:
    """struct(name, role, party, district, chamber) of one cell; null for cells without a name.

    A trailing role word decides over the default; a committee is known by its name and has
    neither party nor district.
    """
    role0 = default_role if default_role is not None else F.lit("unknown")
    chamber0 = default_chamber if default_chamber is not None else F.lit("unknown")
    roles = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])

    def read(text: Column) -> Column:
        said = F.try_element_at(roles, F.replace(F.lower(F.regexp_extract(text, ROLE_AT_END, 1)), F.lit("-"), F.lit("")))
        empty = (F.translate(text, "-.", "") == "") | F.lower(text).isin(PLACEHOLDERS)

        def rest(body: Column) -> Column:
            chamber = F.when(body.rlike(SENATE), "upper").when(body.rlike(HOUSE), "lower").otherwise(chamber0)
            bare = clean_line(F.regexp_replace(F.regexp_replace(body, r"\([^)]*\)", " "), DISTRICT, " "))
            name = F.regexp_replace(F.regexp_replace(bare, TITLE, ""), "^[ ,;-]+|[ ,;-]+$", "")
            outside = F.nullif(F.regexp_extract(body, DISTRICT, 1), F.lit(""))

            def built(n: Column, b: Column) -> Column:
                group = n.rlike(COMMITTEE)
                out = F.struct(F.when(group, n).otherwise(titlecase_name(n)).alias("name"), F.when(group, "committee").otherwise(F.coalesce(said, role0)).alias("role"), F.when(~group, b["party"]).alias("party"), F.when(~group, F.coalesce(b["district"], outside)).alias("district"), chamber.alias("chamber"))
                return F.when((n != "") & ~empty, out)

            return let(name, lambda n: let(_bracketed(body), lambda b: built(n, b)))

        return let(F.regexp_replace(text, ROLE_AT_END, ""), rest)

    return let(clean_line(raw), read)


def sponsors(cells: Column, default_chamber: Column | None = None) -> Column:
    """Sponsors of a list of cells. The first cell is the primary sponsor's, whether or not
    it holds a name; all others are cosponsors'."""
    out = F.transform(cells, lambda c, i: sponsor(c, F.when(i == 0, "primary").otherwise("cosponsor"), default_chamber))
    return F.filter(out, lambda s: s.isNotNull())


def sponsor_cell(cell: Column, default_chamber: Column | None = None) -> Column:
    """Sponsors of one delimited cell."""
    return sponsors(split_list(cell), default_chamber)


def merge_sponsors(rows: DataFrame, *keys: str) -> DataFrame:
    """One row for each (keys, name in any case) of keys, sponsor, ord: the first spelling,
    primary if any says so, else the first known role; blanks filled in order; ``ord`` is the
    first one, for the order of the list. Partial sums keep hot keys small."""
    s = lambda f: F.col(f"sponsor.{f}")
    known = lambda f, blank: F.when(s(f).isNotNull() & (s(f) != blank), F.col("ord"))
    first = lambda f, blank="": F.min_by(s(f), known(f, blank))
    role = F.when(F.max(s("role") == "primary"), "primary").otherwise(F.coalesce(first("role", "unknown"), F.lit("unknown")))
    merged = F.struct(F.min_by(s("name"), "ord").alias("name"), role.alias("role"), first("party").alias("party"), first("district").alias("district"), F.coalesce(first("chamber", "unknown"), F.lit("unknown")).alias("chamber"))
    return rows.groupBy(*keys, F.lower(s("name")).alias("_name")).agg(merged.alias("sponsor"), F.min("ord").alias("ord")).drop("_name")
