"""Derived keys and digests: the same input gives the same key anywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAMESPACE = "5f1b6f6a2d1c4f2a9a1a6b6f2c1d4e88"  # fixed value
# Fragments that change with each rendering.
VOLATILE = [
    r"(?i)\bprinted\s+on\b[^\n]{0,60}",
    r"(?i)\bgenerated\s+(?:at|on)\b[^\n]{0,60}",
    r"(?i)\blast\s+updated\b[^\n]{0,60}",
    r"(?i)\bretrieved\s+on\b[^\n]{0,60}",
    r"(?i)\bsession[_\- ]?id\b\s*[:=]\s*\S+",
    r"(?i)\bcsrf[_\- ]?token\b\s*[:=]\s*\S+",
    r"(?i)\bpage\s+\d+\s+of\s+\d+",
    r"\b[0-9a-fA-F]{32,64}\b",
]
_BILL = r"^\s*([A-Za-z](?:[\s._]*[A-Za-z]){0,5})[\s._-]*([0-9]{1,%d})(?:[\s._-]*([A-Za-z]{1,3}))?\s*$"
#: Digits of a bill number in the portals, and of any number that a table can have as its key.
BILL_DIGITS, KEY_DIGITS = 6, 19


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def slugify(text: Column, limit: int = 80) -> Column:
    folded = F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(folded == "", F.lit("unknown")).otherwise(F.regexp_replace(F.substring(folded, 1, limit), "-+$", ""))


def bill_number(raw: Column, digits: int = BILL_DIGITS) -> Column:
    """struct(prefix, number, suffix), null if the text is no bill designator; a number of more
    than ``digits`` digits makes none."""
    bill = _BILL % digits
    part = lambda i: F.regexp_extract(raw, bill, i)
    out = F.struct(F.upper(F.regexp_replace(part(1), "[^A-Za-z]+", "")).alias("prefix"), part(2).try_cast("int" if digits < 10 else "long").alias("number"), F.upper(part(3)).alias("suffix"))
    return F.when(raw.rlike(bill), out)


def citation(jurisdiction: Column, session: Column, raw: Column, digits: int = BILL_DIGITS) -> Column:
    b = bill_number(raw, digits)
    tail = F.coalesce(F.concat(b["prefix"], b["number"].cast("string"), b["suffix"]), F.upper(slugify(raw, 24)))
    return F.concat_ws("-", F.lower(jurisdiction), slugify(session, 24), tail)


def document_id(cite: Column, kind: Column) -> Column:
    """Version 5 UUID of ``kind::citation``, from the bits of a SHA-1."""
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE)), F.encode(F.concat(kind, F.lit("::"), cite), "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 19, 2), F.lit("-"), F.substring(h, 21, 12))


def run_id(jurisdiction: Column, dag_run: Column, task: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", jurisdiction, dag_run, task)), 1, 24)


def content_digest(payload: Column) -> Column:
    return F.sha2(payload, 256)


def semantic_digest(text: Column) -> Column:
    """For text in NFKC; udfs.nfkc brings other text there. Classes are those of Unicode, and
    the four ASCII separators count as white space."""
    out = F.translate(text, "\x1c\x1d\x1e\x1f­", "    ")
    for p in VOLATILE:
        out = F.regexp_replace(out, f"(?U){p}", " ")
    return F.sha2(F.lower(collapse(out)), 256)


def field_digest(**fields: Column) -> Column:
    """Order of names and of list items does not matter; null equals the empty text."""
    parts = []
    for name in sorted(fields):
        parts.append(F.concat(F.lit(f"{name}="), collapse(F.coalesce(fields[name].cast("string"), F.lit("")))))
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def short_digest(digest: Column, length: int = 12) -> Column:
    if length <= 0:
        raise ValueError("length must be positive")
    return F.substring(digest, 1, length)
