"""Text, date, URL and subject expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import collapse

# Query parameters that never change what a page holds.
TRACKING = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid", "mc_cid", "mc_eid", "_ga", "sessionid", "session_id", "jsessionid", "phpsessid", "aspxauth", "cachebuster", "_"]
# Subject and the phrases that stand for it.
SUBJECTS = {
    "agriculture": ["agriculture", "farming", "livestock", "crops", "agricultural policy"],
    "appropriations": ["appropriations", "budget", "state budget", "spending", "fiscal"],
    "banking": ["banking", "financial institutions", "credit unions", "banks"],
    "civil-rights": ["civil rights", "discrimination", "equal protection", "human rights"],
    "criminal-justice": ["criminal justice", "crimes", "criminal law", "corrections", "sentencing", "penal code"],
    "education": ["education", "schools", "higher education", "k-12", "school districts"],
    "elections": ["elections", "voting", "campaign finance", "redistricting", "ballot"],
    "energy": ["energy", "utilities", "electricity", "renewable energy", "power"],
    "environment": ["environment", "environmental protection", "conservation", "pollution", "water quality"],
    "health": ["health", "public health", "medicaid", "health care", "hospitals", "mental health"],
    "housing": ["housing", "landlord tenant", "affordable housing", "rent", "homelessness"],
    "immigration": ["immigration", "immigrants", "refugees"],
    "insurance": ["insurance", "health insurance", "property insurance", "insurers"],
    "labor": ["labor", "employment", "workers compensation", "wages", "unions", "minimum wage"],
    "local-government": ["local government", "counties", "municipalities", "cities", "townships"],
    "privacy": ["privacy", "data protection", "consumer data", "biometric", "data breach"],
    "public-safety": ["public safety", "law enforcement", "police", "fire", "emergency services"],
    "revenue": ["revenue", "taxation", "taxes", "tax credits", "sales tax", "income tax"],
    "technology": ["technology", "artificial intelligence", "broadband", "telecommunications"],
    "transportation": ["transportation", "highways", "motor vehicles", "transit", "roads"],
    "veterans": ["veterans", "military", "national guard", "armed forces"],
}
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


def truncate(text: Column, limit: int) -> Column:
    """At most ``limit`` characters with an ellipsis, cut at a space in the second half."""
    cut = F.substring(text, 1, limit - 1)
    space = F.length(cut) - F.locate(" ", F.reverse(cut))
    at = F.when((F.locate(" ", cut) > 0) & (space > limit // 2), space).otherwise(F.length(cut))
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.rtrim(F.substring(cut, F.lit(1), at.cast("int"))), F.lit("…")))


def split_list(text: Column) -> Column:
    """Items of a delimited cell, collapsed; of items equal but for case the first stays."""
    items = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"[;,|\n]"), collapse), lambda x: x != "")
    return F.filter(items, lambda x, i: ~F.exists(F.slice(items, F.lit(1), i), lambda y: F.lower(y) == F.lower(x)))


def sentences(text: Column) -> Column:
    return F.filter(F.split(collapse(text), r"(?<=[.!?])\s+(?=[\p{Lu}\"'])"), lambda x: x != "")


def strip_line_numbers(text: Column) -> Column:
    return F.regexp_replace(text, r"(?m)^[ \t]{0,8}[0-9]{1,3}[ \t]{2,}", "")


def strip_markup(html: Column) -> Column:
    """Markup without scripts, styles and tags; block ends become line ends. Entities and white
    space stay as they are."""
    t = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?i)</?(?:p|div|br|li|tr|h[1-6]|table|section|article|ul|ol)\b[^>]*>", "\n")
    return F.regexp_replace(t, r"<[^>]+>", " ")


def collapse_lines(text: Column) -> Column:
    """Lines without white space at their ends, single spaces, one blank line at most."""
    t = F.regexp_replace(text, r"\r\n|[\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]", "\n")
    t = F.regexp_replace(t, r"[ \t\x{A0}\x{2007}\x{202F}]+", " ")
    t = F.regexp_replace(t, r"(?U)[\s\x1F&&[^\n]]*\n[\s\x1F&&[^\n]]*", "\n")
    return F.regexp_replace(F.regexp_replace(t, r"\n{3,}", "\n\n"), r"(?U)^[\s\x1F]+|[\s\x1F]+\z", "")


def strip_tags(html: Column) -> Column:
    """Text of markup without scripts and styles, entities replaced; block ends become line ends."""
    from .udfs import unescape

    t = strip_markup(html)
    held = F.contains(t, F.lit("&"))
    return collapse_lines(F.when(held, unescape(F.when(held, t))).otherwise(t))


def content_kind(body: Column) -> Column:
    """Kind of a payload by its first bytes."""
    head = F.lower(F.substring(body.cast("string"), 1, 1024))
    return F.when(head.startswith("%pdf"), "pdf").when(head.startswith("{\\rtf"), "rtf").when(head.startswith("pk\u0003\u0004"), "zip").when(F.ltrim(head).startswith("<?xml"), "xml").when(head.rlike("<(html|!doctype html|body|table|div)"), "html").otherwise("text")


def parse_date(raw: Column) -> Column:
    """ISO, compact, US, long and reversed long dates; null for anything else."""
    t = F.regexp_replace(F.element_at(F.split(collapse(raw), " at "), 1), r"\.$", "")
    t = F.trim(F.regexp_replace(t, r"[T ]?\b[0-9]{1,2}:[0-9]{2}.*$", ""))
    part = lambda p, i: F.regexp_extract(t, p, i)
    safe = lambda y, m, d: F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")).try_cast("date")
    iso, compact, us = r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})$", r"^([0-9]{4})([0-9]{2})([0-9]{2})$", r"^([0-9]{1,2})[/-]([0-9]{1,2})[/-]([0-9]{4}|[0-9]{2})$"
    long, back = r"^([A-Za-z]+)\.? ([0-9]{1,2}),? ([0-9]{4})$", r"^([0-9]{1,2}) ([A-Za-z]+)\.?,? ([0-9]{4})$"
    year = part(us, 3)
    full = F.when(F.length(year) == 4, year.try_cast("int")).otherwise(year.try_cast("int") + F.when(year.try_cast("int") >= 70, 1900).otherwise(2000))
    months = F.array(*[F.lit(m[:3]) for m in MONTHS])
    month = lambda name: F.when(F.array_contains(F.array(*map(F.lit, MONTHS)), F.lower(name)) | (F.length(name) <= 4), F.nullif(F.array_position(months, F.lower(F.substring(name, 1, 3))), F.lit(0)))
    return F.when(t.rlike(iso), safe(part(iso, 1), part(iso, 2), part(iso, 3))).when(t.rlike(compact), safe(part(compact, 1), part(compact, 2), part(compact, 3))).when(t.rlike(us), safe(full, part(us, 1), part(us, 2))).when(t.rlike(long), safe(part(long, 3), month(part(long, 1)), part(long, 2))).when(t.rlike(back), safe(part(back, 3), month(part(back, 2)), part(back, 1)))


_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/@?#]*@)?([^/:?#]+)(?::([0-9]+))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _encoded(part: Column) -> Column:
    """A query part decoded and encoded again: spaces as +, letters, digits and _.-~ as they are."""
    plain = F.coalesce(F.try_url_decode(part), part)
    return F.replace(F.replace(F.url_encode(plain), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def canonical_url(url: Column, drop: tuple[str, ...] = ()) -> Column:
    """Scheme and host in lower case, without user, default port, tracking or dropped parameters,
    fragment or final slash; parameters encoded alike and in order. Other text is only trimmed,
    and null is empty."""
    raw = F.trim(F.coalesce(url, F.lit("")))
    part = lambda i: F.regexp_extract(raw, _URL, i)
    scheme, port = F.lower(part(1)), part(3)
    default = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    pairs = F.transform(F.filter(F.split(part(5), "&"), lambda x: x != ""), lambda x: F.struct(_encoded(F.substring_index(x, "=", 1)).alias("k"), F.when(F.contains(x, F.lit("=")), _encoded(F.substring(x, F.locate("=", x) + 1, F.length(x)))).otherwise("").alias("v")))
    unwanted = [*TRACKING, *(d.lower() for d in drop)]
    kept = F.array_sort(F.filter(pairs, lambda p: ~F.lower(p["k"]).isin(unwanted)))
    query = F.array_join(F.transform(kept, lambda p: F.concat_ws("=", p["k"], p["v"])), "&")
    path = F.regexp_replace(part(4), "/+$", "")
    out = F.concat(scheme, F.lit("://"), F.lower(part(2)), F.when(default, "").otherwise(F.concat(F.lit(":"), port)), F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(raw.rlike(_URL), out).otherwise(raw)


def registrable_host(url: Column) -> Column:
    """Host in lower case without user and port; empty for other text."""
    return F.lower(F.regexp_extract(F.trim(F.coalesce(url, F.lit(""))), _URL, 2))


def strip_params(url: Column, params: tuple[str, ...]) -> Column:
    return canonical_url(url, params)


def absolutise(base: Column, href: Column) -> Column:
    """An address resolved against a page's: absolute, without scheme, from the root, or beside
    the page, with . and .. taken away; canonical."""
    h = F.trim(F.coalesce(href, F.lit("")))
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_replace(path, "[^/]*$", "")
    tail = F.regexp_extract(h, r"([?#].*)$", 1)
    joined = F.when(h.startswith("/"), F.regexp_replace(h, r"[?#].*$", "")).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), F.regexp_replace(h, r"[?#].*$", "")))
    steps = F.aggregate(F.split(joined, "/"), F.array().cast("array<string>"), lambda a, x: F.when(x == "..", F.slice(a, F.lit(1), F.greatest(F.lit(1), F.size(a) - 1))).when(x == ".", a).otherwise(F.concat(a, F.array(x))))
    beside = F.when(h.startswith("?"), F.concat(root, path, h)).when(h.startswith("#"), base).otherwise(F.concat(root, F.array_join(steps, "/"), tail))
    full = F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h).when(h.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), h)).otherwise(beside)
    return F.when(h == "", "").otherwise(canonical_url(full))


def same_site(a: Column, b: Column) -> Column:
    last = lambda h: F.when(F.size(F.split(h, r"\.")) >= 2, F.array_join(F.slice(F.split(h, r"\."), -2, 2), ".")).otherwise(h)
    return (a != "") & (b != "") & ((a == b) | (last(a) == last(b)))


def subject(raw: Column) -> Column:
    """Canonical subject: exact phrase, else the longest phrase of five letters or more that
    the text holds (the earlier on ties), else null."""
    from .names import let

    key = F.trim(F.regexp_replace(F.regexp_replace(F.lower(collapse(raw)), r"(?:--|\(|;).*$", ""), r"[^\w]+", " "))
    order = [(p, s) for s, ps in SUBJECTS.items() for p in ps]
    exact = F.create_map(*[F.lit(x) for p, s in order for x in (p, s)])
    longest = sorted((x for x in order if len(x[0]) >= 5), key=lambda x: -len(x[0]))
    phrases = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(s).alias("s")) for p, s in longest])
    return let(key, lambda k: F.coalesce(F.try_element_at(exact, k), F.get(F.filter(phrases, lambda x: F.contains(k, x["p"])), F.lit(0))["s"]))


def subject_list(cells: Column) -> Column:
    """struct(subjects, unmapped): canonical subjects in order, and the collapsed texts that have
    none, as first seen. Null and blank cells are left out."""
    from .names import let

    def split(told: Column) -> Column:
        held = F.array_sort(F.array_distinct(F.filter(F.transform(told, lambda t: t["s"]), lambda s: s.isNotNull())))
        other = F.filter(told, lambda t: t["s"].isNull() & (t["c"] != ""))
        return F.struct(held.alias("subjects"), F.array_distinct(F.transform(other, lambda t: t["c"])).alias("unmapped"))

    clean = F.filter(F.coalesce(cells, F.array().cast("array<string>")), lambda c: c.isNotNull())
    return let(F.transform(clean, lambda c: F.struct(collapse(c).alias("c"), subject(c).alias("s"))), split)


def subject_aliases(canonical: Column) -> Column:
    """Phrases of a canonical subject; none for others."""
    held = F.create_map(*[x for s, ps in SUBJECTS.items() for x in (F.lit(s), F.array(*map(F.lit, ps)))])
    return F.coalesce(F.try_element_at(held, canonical), F.array().cast("array<string>"))


# Headings of sections, and the marks that may lead a line.
SECTION = r"(?im)^[\s&&[^\n]]*(SECTION\s+\d+[A-Z]?\.|Sec\.\s*\d+[A-Z]?\.|ARTICLE\s+[IVXLC]+\.?)\s*"
ENUMERATOR = r"^\s*(?:\(?[a-zA-Z0-9ivxIVX]{1,5}[\)\.]|SECTION\s+\d+\.|Sec\.\s*\d+\.)\s+"


def strip_leading_enumerator(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, ENUMERATOR, ""))


def split_sections(text: Column) -> Column:
    """(heading, body) of each section of a cleaned text: what stands before the first heading is
    the preamble, a text without headings one body, an empty text nothing."""
    mark = "\x1d"
    parts = F.split(F.regexp_replace(text, SECTION, f"{mark}$1\x1e"), mark)
    first = F.trim(F.get(parts, F.lit(0)))
    rest = F.transform(F.slice(parts, 2, 1 << 30), lambda p: F.struct(F.rtrim(F.trim(F.substring_index(p, "\x1e", 1))).alias("heading"), strip_leading_enumerator(F.btrim(F.substring_index(p, "\x1e", -1), F.lit(" \n\t"))).alias("body")))
    rest = F.filter(F.transform(rest, lambda p: F.struct(F.regexp_replace(p["heading"], r"\.+$", "").alias("heading"), p["body"].alias("body"))), lambda p: p["body"] != "")
    whole = F.array(F.struct(F.lit("body").alias("heading"), F.btrim(text, F.lit(" \n\t")).alias("body")))
    lead = F.when(F.btrim(first, F.lit(" \n\t")) != "", F.array(F.struct(F.lit("preamble").alias("heading"), F.btrim(first, F.lit(" \n\t")).alias("body")))).otherwise(F.slice(whole, 1, 0))
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", F.slice(whole, 1, 0)).when(F.size(parts) == 1, whole).otherwise(F.concat(lead, rest))


def dedent_block(text: Column) -> Column:
    """A block without the indentation that all its lines with text share."""
    lines = F.split(text, r"\r\n|\n|\r")
    widths = F.transform(F.filter(lines, lambda x: F.trim(x) != ""), lambda x: F.length(x) - F.length(F.ltrim(x)))
    cut = F.array_min(widths)
    out = F.array_join(F.transform(lines, lambda x: F.when(F.trim(x) != "", F.substring(x, cut + 1, F.length(x))).otherwise("")), "\n")
    return F.when(F.size(widths) == 0, F.trim(text)).otherwise(F.btrim(out, F.lit("\n")))


def parse_datetime(raw: Column) -> Column:
    """ISO timestamps, else a date with the first time that follows it, as UTC; a date alone is
    its midnight."""
    t = collapse(raw)
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"), F.try_to_timestamp(F.regexp_replace(t, "Z$", "+00:00")))
    day = parse_date(raw)
    time = r"\b(\d{1,2}):(\d{2})(?::(\d{2}))?"
    part = lambda i: F.coalesce(F.regexp_extract(t, time, i).try_cast("int"), F.lit(0))
    fits = t.rlike(time) & (part(1) < 24) & (part(2) < 60) & (part(3) < 60)
    seconds = F.when(fits, part(1) * 3600 + part(2) * 60 + part(3)).otherwise(0)
    return F.coalesce(iso, F.timestamp_seconds(F.unix_timestamp(day.cast("timestamp")) + seconds))


def iso_format(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def day_range(start: Column, end: Column) -> Column:
    """Days from start to end, both included; none if they are inverted."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))


def clamp_date(day: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(day, low), high)


def clean_text(text: Column) -> Column:
    """NFKC, plain quotes, no soft hyphens, lines collapsed with paragraphs kept."""
    from .names import straight_quotes
    from .udfs import nfkc

    wide = F.octet_length(text) != F.length(text)
    t = F.when(wide, nfkc(F.when(wide, text))).otherwise(text)
    return collapse_lines(F.replace(straight_quotes(t), F.lit("\u00ad"), F.lit("")))


def extract_body_text(body: Column, kind: Column | None = None) -> Column:
    """Readable text of markup or plain text; null for the kinds that need converting first."""
    kind = content_kind(body) if kind is None else kind
    t = body.cast("string")
    t = F.when(kind.isin("html", "xml"), strip_tags(F.when(kind.isin("html", "xml"), t))).otherwise(t)
    return F.when(~kind.isin("pdf", "rtf", "doc", "zip"), clean_text(strip_line_numbers(t)))
