"""Payloads of portals to loose records: docket blocks, API items, bill status XML, session numbers.

Text is expected in NFKC, as in ``operators.normalise``, which takes the records on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import collapse
from ..functions.names import clean_line

_SPACE = r"(?U)[\s&&[^\n\r]]"
_START = rf"(?m)^\s*([0-9]{{2}}/[0-9]{{2}}/[0-9]{{2}})(?={_SPACE}+\S)"
_MARK = "\u0001"

ACTIONS = "array<struct<date:string,description:string,chamber:string,committee:string,sequence:int>>"
VERSIONS = "array<struct<label:string,text:string,published_on:string>>"

# The first year and number of each portal's count of two-year sessions.
CONGRESS, TEXAS, ILLINOIS, OHIO = (1789, 1), (1846, 1), (2023, 103), (2023, 135)
ILLINOIS_ID_OFFSET = -15

API_ITEM = "number string, shortTitle string, longTitle string, status string, introductionDate string, sponsors array<struct<name:string>>, topics array<string>, actions array<struct<date:string,description:string,chamber:string>>"
_ITEMS = "struct<item:array<struct<{}:string>>>"
_BILL = f"billNumber:string,number:string,billType:string,type:string,title:string,introducedDate:string,latestAction:struct<text:string>,actions:struct<item:array<struct<actionDate:string,text:string,chamber:string>>>,sponsors:{_ITEMS.format('fullName')},cosponsors:{_ITEMS.format('fullName')},subjects:struct<billSubjects:struct<legislativeSubjects:{_ITEMS.format('name')}>>,summaries:struct<billSummaries:{_ITEMS.format('text')}>"
_ROOT = r"(?s)^\s*(?:(?:<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>]*>)\s*)*<([^\s/>]+)"


def _each(items: Column, of) -> Column:
    return F.coalesce(F.transform(items, of), F.array())


def status_line(line: Column) -> Column:
    """struct(date, description) of a line ``MM/DD/YY text``; null for a line that goes on."""
    return F.get(docket_block(F.when(line.rlike(_START), line)), F.lit(0)).dropFields("sequence")


def docket_block(block: Column) -> Column:
    """Actions of a docket block: lines without a date go on with the action before them, those
    before the first action are left out. A null or blank block has none."""
    plain = F.translate(F.coalesce(block, F.lit("")), _MARK, " ")
    parts = F.split(F.regexp_replace(plain, _START, _MARK + "$1"), _MARK)
    rest = F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))
    return F.transform(rest, lambda p, i: F.struct(F.substring(p, 1, 8).alias("date"), clean_line(F.substr(p, F.lit(9))).alias("description"), i.alias("sequence")))


def session_number(session: Column, count: tuple[int, int]) -> Column:
    """Number of the two-year session that ``session`` (``2023-2024``) starts in; null where it has no year."""
    year, number = count
    return (F.floor((F.split(session, "-")[0].try_cast("int") - year) / 2) + number).cast("int")


def texas_code(session: Column, special: int = 0) -> Column:
    return F.concat(session_number(session, TEXAS).cast("string"), F.lit(str(special) if special else "R"))


def illinois_session_id(session: Column) -> Column:
    return session_number(session, ILLINOIS) + ILLINOIS_ID_OFFSET


def base_records(records: DataFrame, jurisdiction: str, session: str, method: str) -> DataFrame:
    """Records with what every portal fills in alike; missing lists are empty."""
    lists = {"actions": ACTIONS, "sponsors": "array<string>", "subjects": "array<string>", "versions": VERSIONS}
    known = set(records.columns)
    filled = {c: (F.coalesce(c, F.array().cast(t)) if c in known else F.array().cast(t)) for c, t in lists.items()}
    return records.withColumns({"jurisdiction": F.lit(jurisdiction), "session": F.lit(session), "fetch_method": F.lit(method)} | filled)


def api_records(items: DataFrame, *keep: str) -> DataFrame:
    """Loose records of API items (columns of API_ITEM); ``keep`` names columns to carry along."""
    number = clean_line(F.col("number"))
    line = F.transform("actions", lambda a, i: F.struct(a["date"].alias("date"), a["description"].alias("description"), a["chamber"].alias("chamber"), F.lit(None).cast("string").alias("committee"), i.alias("sequence")))
    real = lambda c: F.filter(c, lambda x: x.isNotNull())
    return items.select(
        *keep, F.when(number == "", "unknown").otherwise(number).alias("identifier"), clean_line(F.col("shortTitle")).alias("title"),
        clean_line(F.col("longTitle")).alias("summary"), clean_line(F.col("status")).alias("status"), F.col("introductionDate").alias("introduced_on"),
        F.when(F.upper(number).startswith("S"), "upper").otherwise("lower").alias("chamber"),
        _each(real(F.col("sponsors")), lambda p: clean_line(p["name"])).alias("sponsors"), F.coalesce("topics", F.array().cast("array<string>")).alias("subjects"),
        F.coalesce(F.filter(line, lambda a: F.get(F.col("actions"), a["sequence"]).isNotNull()), F.array().cast(ACTIONS)).alias("actions"),
    )


def xml_records(payloads: DataFrame, column: str, *keep: str) -> tuple[DataFrame, DataFrame]:
    """(records, errors) of bill status documents, each a whole payload of ``column``. Payloads
    that are no XML, hold no bill, or whose bill has no number or type are errors."""
    text = F.col(column).cast("string")
    parsed = F.from_xml(text, f"struct<bill:struct<{_BILL}>,{_BILL},_broken:string>", {"columnNameOfCorruptRecord": "_broken"})
    d = payloads.select(*keep, text.alias("_text"), parsed.alias("_p"))
    own = F.struct(*[F.col(f"_p.{f.name}").alias(f.name) for f in d.schema["_p"].dataType["bill"].dataType.fields])
    root = F.regexp_extract("_text", _ROOT, 1)
    d = d.select(*keep, F.when((root == "") | F.col("_p").isNull() | F.col("_p._broken").isNotNull(), "payload is not XML").alias("_e"), F.when(root == "bill", own).otherwise(F.col("_p.bill")).alias("b"))
    said = lambda a, b: F.coalesce(F.nullif(clean_line(F.col(a)), F.lit("")), F.nullif(clean_line(F.col(b)), F.lit("")))
    d = d.withColumns({"_n": said("b.billNumber", "b.number"), "_t": said("b.billType", "b.type")})
    d = d.withColumn("error", F.coalesce("_e", F.when(F.col("b").isNull(), "no bill element"), F.when(F.col("_n").isNull() | F.col("_t").isNull(), "no identifier")))
    some = lambda items: F.filter(items, lambda x: x != "")
    people = F.concat(*[_each(F.col(f"b.{c}.item"), lambda p: clean_line(p["fullName"])) for c in ("sponsors", "cosponsors")])
    line = F.transform("b.actions.item", lambda a, i: F.struct(clean_line(a["actionDate"]).alias("date"), clean_line(a["text"]).alias("description"), clean_line(a["chamber"]).alias("chamber"), F.lit(None).cast("string").alias("committee"), i.alias("sequence")))
    records = d.where("error is null").select(
        *keep, F.concat(F.upper("_t"), F.col("_n")).alias("identifier"), clean_line(F.col("b.title")).alias("title"),
        collapse(F.array_join(_each(F.col("b.summaries.billSummaries.item"), lambda s: clean_line(s["text"])), " ")).alias("summary"),
        clean_line(F.col("b.introducedDate")).alias("introduced_on"), clean_line(F.col("b.latestAction.text")).alias("status"),
        F.when(F.lower("_t").startswith("s"), "upper").otherwise("lower").alias("chamber"), some(people).alias("sponsors"),
        some(_each(F.col("b.subjects.billSubjects.legislativeSubjects.item"), lambda s: clean_line(s["name"]))).alias("subjects"), F.coalesce(line, F.array().cast(ACTIONS)).alias("actions"),
    )
    return records, d.where("error is not null").select(*keep, "error")
