"""Docket wording: kind and status of an action, ranks, and the status of a document."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wording, kind, status. The first wording that occurs decides; "passage" means
# that the chamber decides; no status means that the action implies none.
ACTION_PATTERNS = [
    (r"\bveto\s+overrid(?:den|e)\b", "floor_vote", "veto_overridden"),
    (r"\boverrode\s+(?:the\s+)?veto\b", "floor_vote", "veto_overridden"),
    (r"\bveto(?:ed)?\b", "executive_action", "vetoed"),
    (r"\bbecame\s+law\b", "executive_action", "enacted"),
    (r"\bchaptered\b", "executive_action", "enacted"),
    (r"\bact\s+no\.?\s*\d+", "executive_action", "enacted"),
    (r"\bpublic\s+law\b", "executive_action", "enacted"),
    (r"\bapproved\s+by\s+(?:the\s+)?governor\b", "executive_action", "signed"),
    (r"\bsigned\s+by\s+(?:the\s+)?(?:governor|president)\b", "executive_action", "signed"),
    (r"\bsent\s+to\s+(?:the\s+)?(?:governor|president)\b", "transmittal", "sent_to_executive"),
    (r"\bpresented\s+to\s+(?:the\s+)?(?:governor|president)\b", "transmittal", "sent_to_executive"),
    (r"\benroll(?:ed|ment)\b", "procedural", "enrolled"),
    (r"\bwithdrawn\b", "procedural", "withdrawn"),
    (r"\bindefinitely\s+postponed\b", "procedural", "dead"),
    (r"\bdied\s+in\s+committee\b", "procedural", "dead"),
    (r"\bfailed\s+to\s+pass\b", "floor_vote", "failed"),
    (r"\blost\b.*\bvote\b", "floor_vote", "failed"),
    (r"\bpassed\b", "floor_vote", "passage"),
    (r"\bthird\s+reading\b", "floor_vote", "on_floor"),
    (r"\bplaced\s+on\s+(?:the\s+)?calendar\b", "procedural", "on_floor"),
    (r"\breported\s+(?:out|favorably|do\s+pass)\b", "committee_vote", "reported"),
    (r"\bdo\s+pass\b", "committee_vote", "reported"),
    (r"\bcommittee\s+report\b", "committee_vote", "reported"),
    (r"\breferred\s+to\b", "referral", "in_committee"),
    (r"\bassigned\s+to\s+committee\b", "referral", "in_committee"),
    (r"\bhearing\s+(?:scheduled|held|set)\b", "hearing", "in_committee"),
    (r"\bamendment\b", "amendment_offered", None),
    (r"\bsubstitut(?:ed|e)\b", "substitution", None),
    (r"\bsecond\s+reading\b", "procedural", "on_floor"),
    (r"\bfirst\s+reading\b", "filing", "introduced"),
    (r"\bintroduced\b", "filing", "introduced"),
    (r"\bread\s+(?:the\s+)?first\s+time\b", "filing", "introduced"),
    (r"\bfiled\b", "filing", "introduced"),
    (r"\bprefiled\b", "filing", "prefiled"),
    (r"\bpre-?filed\b", "filing", "prefiled"),
]
# Progress from the lowest rank; outcomes without a rank stand above all.
STATUS_ORDER = ["unknown", "prefiled", "introduced", "in_committee", "reported", "on_floor", "passed_origin", "passed_second", "enrolled", "sent_to_executive", "vetoed", "signed", "veto_overridden", "enacted"]
TERMINAL = ["enacted", "failed", "withdrawn", "dead", "veto_overridden"]


def _first_match(text: Column, values: list, default: str | None) -> Column:
    """One CASE over the table; evaluation stops at the first wording that occurs."""
    low = F.lower(text)
    branches = list(zip(ACTION_PATTERNS, values, strict=True))
    case = reduce(lambda c, b: c.when(low.rlike(b[0][0]), F.lit(b[1])), branches[1:], F.when(low.rlike(branches[0][0][0]), F.lit(branches[0][1])))
    return case.otherwise(F.lit(default))


def classify_action(text: Column) -> Column:
    return _first_match(text, [k for _, k, _ in ACTION_PATTERNS], "unknown")


def status_from_action(text: Column, chamber: Column | None = None, origin: Column | None = None) -> Column:
    """Status that an action implies. Passage counts for the second chamber only if the origin
    is known and the chamber (given, or hinted by the wording) is another one."""
    status = _first_match(text, [s for _, _, s in ACTION_PATTERNS], None)
    low = F.lower(text)
    hint = F.when(low.rlike(r"\bsenate\b"), "upper").when(low.rlike(r"\b(house|assembly)\b"), "lower")
    known = lambda c: F.when(c != "unknown", c)
    acting = F.coalesce(known(chamber) if chamber is not None else F.lit(None).cast("string"), hint)
    start = known(origin) if origin is not None else F.lit(None).cast("string")
    passage = F.when(acting.isNotNull() & start.isNotNull() & (acting != start), "passed_second").otherwise("passed_origin")
    return F.when(status == "passage", passage).otherwise(status)


def status_rank(status: Column) -> Column:
    place = F.array_position(F.array(*map(F.lit, STATUS_ORDER)), status)
    return F.when(place > 0, place - 1).otherwise(F.lit(len(STATUS_ORDER))).cast("int")


def is_advance(before: Column, after: Column) -> Column:
    return status_rank(after) > status_rank(before)


def derive_status(status: Column, occurred_on: Column, sequence: Column, description: Column, fallback: str = "unknown") -> Column:
    """Aggregate: status of the latest implying action by (date, sequence, rank)."""
    order = F.struct(occurred_on, sequence, status_rank(status), description)
    return F.coalesce(F.max_by(status, F.when(status.isNotNull(), order)), F.lit(fallback))


def sql_case(text: str, which: int, default: str) -> str:
    """The same table as a CASE of DuckDB SQL."""
    rows = " ".join(f"when regexp_matches(lower({text}), '{p[0]}') then {'null' if p[which] is None else repr(p[which])}" for p in ACTION_PATTERNS)
    return f"case {rows} else {default} end"


def sql_rank(status: str) -> str:
    return f"coalesce(nullif(list_position({STATUS_ORDER!r}, {status}), 0) - 1, {len(STATUS_ORDER)})"
