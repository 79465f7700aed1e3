"""Readers of landed files: delimited text, nested JSON, page tables, filings text, workbooks.

All return DataFrames. Network access, rate limits and terms of use are outside the engine: files are
fetched by something else and read from where they landed.
"""

from __future__ import annotations

import codecs
import csv
import io
import re
import zipfile
from collections.abc import Iterator
from functools import reduce
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import tables as t
from quillstone.functions.normalise import blank_to_null, let
from quillstone.operators.records import composite_id

# --- fixed values: what a text table may be written in -------------------------------------------
ENCODINGS = ("utf-8-sig", "utf-8", "cp1252", "latin-1")
DELIMITERS = ",\t;|"


def artifacts(spark: SparkSession, path: str) -> DataFrame:
    """Landed files with their checksum: path, bytes, modified, sha256, content."""
    rows = spark.read.format("binaryFile").load(path)
    return rows.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"), "content")


def sniff(head: bytes) -> tuple[str, str]:
    """Encoding and delimiter of a text table, from its first bytes."""
    encoding = next(e for e in ENCODINGS if _decodes(head, e))
    text = head.decode(encoding, "ignore")
    try:
        return encoding, csv.Sniffer().sniff(text, DELIMITERS).delimiter
    except csv.Error:
        return encoding, max(DELIMITERS, key=text.count)


def _decodes(head: bytes, encoding: str) -> bool:
    try:
        codecs.getincrementaldecoder(encoding)().decode(head)  # a character cut at the end is no fault
    except UnicodeDecodeError:
        return False
    return True


#: Names that Spark reads an encoding by. The one it does not know differs from the last in 27 characters, which are put right after reading.
READ_AS = {"utf-8-sig": "UTF-8", "utf-8": "UTF-8", "cp1252": "ISO-8859-1", "latin-1": "ISO-8859-1"}
_CP1252 = {bytes([b]).decode("latin-1"): c for b in range(0x80, 0xA0) if (c := bytes([b]).decode("cp1252", "ignore"))}


def written_in(spark: SparkSession, path: str, lines: int = 50) -> tuple[str, str]:
    """Encoding and delimiter of landed text tables, from the first lines of one of them; UTF-8 and comma where there is none."""
    # Each byte is a character of this encoding, and no delimiter or quote parts a line.
    rows = spark.read.option("encoding", "ISO-8859-1").option("sep", "\u0001").option("quote", "").schema("line string").csv(path).limit(lines).collect()
    head = "\n".join(r["line"] or "" for r in rows).encode("latin-1")
    return sniff(head) if head else ("utf-8", ",")


def read_table(spark: SparkSession, path: str, sep: str | None = None, encoding: str | None = None, keep_case: bool = False) -> DataFrame:
    """A text table with a header, all values text. Unless ``keep_case``: names in lower case, values stripped, none null.

    Encoding and delimiter are looked up in the files where they are not given.
    """
    if sep is None or encoding is None:
        found, delimiter = written_in(spark, path)
        sep, encoding = sep or delimiter, encoding or found
    rows = spark.read.csv(path, header=True, sep=sep, encoding=READ_AS.get(encoding, encoding), multiLine=True, escape='"', inferSchema=False)
    if encoding == "cp1252":
        a, b = "".join(_CP1252), "".join(_CP1252.values())
        rows = rows.select(*(F.translate(F.col(f"`{c}`"), a, b).alias(c.translate(str.maketrans(_CP1252))) for c in rows.columns))
    if keep_case:
        return rows
    return rows.select(*(F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c.strip().lower().removeprefix("﻿")) for c in rows.columns))


def _clean(c: Column, absent: tuple[str, ...]) -> Column:
    """The trimmed value, empty where it is null or a word for absent."""
    return F.when(F.lower(F.trim(c)).isin(*absent), "").otherwise(F.coalesce(F.trim(c), F.lit("")))


def renamed(df: DataFrame, aliases: dict[str, str], absent: tuple[str, ...] = (), underscores: bool = True) -> DataFrame:
    """Known headers by ``aliases`` (lower-cased header: field), others in lower case, with underscores if so wanted; empty rows go.

    Of several columns that become one field the last counts, as it would in a row read into a map.
    """
    out: dict[str, str] = {}
    for c in df.columns:
        own = c.strip().lower().removeprefix("\ufeff")
        out[aliases.get(own, own.replace(" ", "_") if underscores else own)] = c
    rows = df.select(*(_clean(F.col(f"`{c}`"), absent).alias(name) for name, c in out.items()))
    return rows.filter(F.greatest(*(F.length(f"`{c}`") for c in rows.columns), F.lit(0)) > 0)


def projected(df: DataFrame, columns: dict[str, str], absent: tuple[str, ...], required: str, cleaned: tuple[str, ...] | None = None) -> DataFrame:
    """Fixed columns (by header, as written), words for absent made empty (in the fields ``cleaned``, else in all), rows without the required one dropped."""
    own = {c.strip().removeprefix("\ufeff"): c for c in df.columns}
    of = lambda h, name: _clean(F.col(f"`{own[h]}`") if h in own else F.lit(""), absent if cleaned is None or name in cleaned else ())
    return df.select(*(of(h, name).alias(name) for h, name in columns.items())).filter(F.col(required) != "")


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole text files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def row_map(df: DataFrame) -> Column:
    """All columns as a map of texts."""
    return F.map_from_arrays(F.array(*map(F.lit, df.columns)), F.array(*(F.col(f"`{c}`").cast("string") for c in df.columns)))


def raw_records(df: DataFrame, payload: Column, source_key: str, grain: str, ids: list[str], repeats: bool = False, made_of: tuple[str, ...] = ()) -> DataFrame:
    """Raw records: source_key, grain, source_record_id, raw_payload.

    The id is the first value among ``ids``, else a hash of the row; or that of the values of ``made_of``, joined by colons. ``repeats``: id, hash of the row and the
    number among rows that are equal, joined by colons, so that no two rows share an id.
    """
    digest = F.substring(F.sha2(F.to_json("raw_payload"), 256), 1, 32)
    rows = df.select(payload.alias("raw_payload"))
    known = F.coalesce(*(blank_to_null(F.trim(F.col("raw_payload")[c])) for c in ids), F.lit(None).cast("string"))
    rows = rows.select("raw_payload", known.alias("known"), digest.alias("digest"))
    rid = F.coalesce("known", "digest")
    if made_of:
        rid = F.coalesce("known", composite_id(*(F.col("raw_payload")[c] for c in made_of)))
    if repeats:
        alike = rows.groupBy("known", "digest").agg(F.any_value("raw_payload").alias("raw_payload"), F.count("*").alias("n"))  # counted before they move
        spans = alike.withColumn("span", F.explode(F.sequence(F.lit(0), F.expr("(n - 1) div 65536"))))  # no long array for a row that repeats often
        rows = spans.withColumn("place", F.explode(F.sequence(F.col("span") * 65536 + 1, F.least("n", (F.col("span") + 1) * 65536))))
        rid = F.concat_ws(":", F.coalesce("known", F.lit("")), "digest", F.col("place").cast("string"))
    return rows.select(F.lit(source_key).alias("source_key"), F.lit(grain).alias("grain"), rid.alias("source_record_id"), "raw_payload")


def as_payload(df: DataFrame, source_key: str, grain: str, ids: list[str], repeats: bool = False) -> DataFrame:
    """``raw_records`` of a table."""
    return raw_records(df, row_map(df), source_key, grain, ids, repeats)


def directors(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """One row per director of each lookup answer; a row without names where there is none."""
    schema = "corp_number string, http_status int, directors array<struct<firstName:string,lastName:string,serviceAddress:string>>"
    rows = docs.select(F.from_json(json_col, schema).alias("d")).select("d.corp_number", F.explode_outer("d.directors").alias("p"))
    name = blank_to_null(F.trim(F.concat_ws(" ", "p.firstName", "p.lastName")))
    rid = F.when(name.isNull(), F.concat("corp_number", F.lit(":no_directors"))).otherwise(F.substring(F.sha2(F.concat_ws(":", F.col("corp_number"), name), 256), 1, 32))
    return rows.select("corp_number", rid.alias("source_record_id"), name.alias("director_name"), F.col("p.lastName").alias("director_last_name"), F.col("p.serviceAddress").alias("service_address"))


RESOURCES = "result struct<resources:array<struct<name:string,format:string,url:string>>>"


def picked_resource(answers: DataFrame, keyword: Column, json_col: str = "json") -> DataFrame:
    """``answers`` (JSON of a package each) with ``url``: that of the first CSV resource whose name holds the keyword and that has one; null where none does."""
    text = lambda c: F.coalesce(c, F.lit(""))
    fits = lambda r: F.contains(F.lower(text(r["name"])), F.lower(keyword)) & (F.upper(text(r["format"])) == "CSV") & (text(r["url"]) != "")
    found = F.filter(F.coalesce(F.from_json(json_col, RESOURCES)["result"]["resources"], F.array().cast("array<struct<name:string,format:string,url:string>>")), fits)
    return answers.withColumn("url", F.get(found, F.lit(0))["url"])


CREDENTIALS = (
    "topic_id string, credentials array<struct<id:string,credential_type:string,effective_date:string,revoked:boolean,revoked_date:string,latest:boolean,inactive:boolean,"
    "names:array<struct<type:string,text:string>>,attributes:array<struct<type:string,value:string>>>>"
)


def _credential(c: Column) -> Column:
    """One credential of a history: its dates and states, the name it gives and its attributes; flags that are absent are false."""
    flag = lambda k: F.coalesce(c[k], F.lit(False)).alias(k)
    names = F.coalesce(c["names"], F.array())
    name = F.coalesce(F.get(F.filter(names, lambda x: x["type"].isin("entity_name", "legal_name")), F.lit(0))["text"], F.get(names, F.lit(0))["text"], F.lit(""))
    kind = F.coalesce(F.get_json_object(c["credential_type"], "$.description"), F.when(~c["credential_type"].startswith("{"), c["credential_type"]), F.lit(""))
    attributes = F.transform(F.coalesce(c["attributes"], F.array()), lambda a: F.struct(F.lower(F.coalesce(a["type"], F.lit(""))).alias("type"), F.coalesce(a["value"], F.lit("")).alias("value")))
    return F.struct(c["id"].alias("credential_id"), kind.alias("credential_type"), c["effective_date"].alias("effective_date"), flag("revoked"), c["revoked_date"].alias("revoked_date"), flag("latest"), flag("inactive"), name.alias("legal_name"), attributes.alias("attributes"))


def latest_credentials(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """Per topic: the last non-empty name and status among its latest credentials, the number of all, and their history as JSON, in the order given."""
    rows = docs.select(F.from_json(json_col, CREDENTIALS).alias("d")).select("d.*")
    live = F.filter("credentials", lambda c: F.coalesce(c["latest"], F.lit(False)))
    names = F.filter(F.flatten(F.transform(live, lambda c: F.transform(F.coalesce(c["names"], F.array()), lambda x: F.trim(x["text"])))), lambda x: x != "")
    codes = F.filter(F.flatten(F.transform(live, lambda c: F.transform(F.filter(F.coalesce(c["attributes"], F.array()), lambda a: a["type"] == "entity_status"), lambda a: F.upper(a["value"])))), lambda x: x != "")
    code = F.try_element_at(codes, F.lit(-1))
    mapped = F.create_map(*[F.lit(x) for kv in t.CREDENTIAL_STATUS.items() for x in kv])[code]
    return rows.select("topic_id", F.try_element_at(names, F.lit(-1)).alias("legal_name"), F.coalesce(mapped, F.when(code.isNotNull(), "UNKNOWN")).alias("status"), F.size(F.coalesce("credentials", F.array())).alias("n_credentials"), F.to_json(F.transform(F.coalesce("credentials", F.array()), _credential), {"ignoreNullFields": "false"}).alias("credential_history"))


class _Tables(HTMLParser):
    """Cells of all tables, as lists of rows; inner tables are tables of their own."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.open: list[list[list[str]]] = []
        self.cell: list[str] | None = None

    def _end_cell(self) -> None:
        if self.cell is not None and self.open and self.open[-1]:
            self.open[-1][-1].append(re.sub(r"\s+", " ", " ".join(self.cell)).strip())
        self.cell = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self._end_cell()
            self.open.append([])
            self.tables.append(self.open[-1])
        elif tag == "tr" and self.open:
            self._end_cell()
            self.open[-1].append([])
        elif tag in ("td", "th") and self.open and self.open[-1]:
            self._end_cell()
            self.cell = []

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr"):
            self._end_cell()
        elif tag == "table" and self.open:
            self._end_cell()
            self.open.pop()

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def table_rows(html: str | None, headers: tuple[str, ...]) -> list[dict[str, str]]:
    """Rows of the first table whose header row has all ``headers``, ragged ones left out."""
    parser = _Tables()
    parser.feed(html or "")
    for rows in parser.tables:
        if rows and set(headers) <= {c.lower() for c in rows[0]}:
            return [dict(zip(rows[0], r, strict=True)) for r in rows[1:] if r and len(r) == len(rows[0])]
    return []


def page_tables(pages: DataFrame, html_col: str = "html", headers: tuple[str, ...] = t.INCORPORATION_HEADERS, lower: bool = False) -> DataFrame:
    """All columns of ``pages`` but the markup, and a map per row of the wanted table; ``lower``: by headers in lower case."""
    keep = [c for c in pages.columns if c != html_col]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f["row"] = [[{k.lower() if lower else k: v for k, v in r.items()} for r in table_rows(h, headers)] for h in f[html_col]]
            yield f.explode("row").dropna(subset=["row"])[[*keep, "row"]]

    schema = pages.select(*keep).withColumn("row", F.create_map().cast("map<string,string>")).schema
    return pages.mapInPandas(read, schema)


#: Character references that pages write text with.
REFERENCES = {"&nbsp;": " ", "&#160;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&#039;": "'", "&apos;": "'", "&amp;": "&"}


def page_text(markup: Column) -> Column:
    """The text of a piece of markup: without tags, references resolved, white space collapsed."""
    s = F.regexp_replace(markup, r"<[^>]*>", " ")
    s = reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), REFERENCES.items(), s)
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def _last_of_each(entries: Column) -> Column:
    """Entries (k, v) as a map; the last of equal keys wins."""
    return let(entries, lambda e: F.map_from_entries(F.filter(e, lambda x, i: ~F.exists(F.slice(e, i + 2, F.size(e)), lambda y: y["k"] == x["k"]))))


def profile_pairs(html: Column) -> Column:
    """Label (lower case, without a colon behind it) and value of the table rows that have two cells, as a map; the last of equal labels wins."""
    cells = lambda row: F.transform(F.regexp_extract_all(row, F.lit(r"(?is)<(td|th)\b[^>]*>(.*?)</\1\s*>"), F.lit(2)), page_text)
    rows = F.filter(F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), F.lit(1)), cells), lambda c: F.size(c) == 2)
    return _last_of_each(F.transform(rows, lambda c: F.struct(F.rtrim(F.lower(c[0]), F.lit(":")).alias("k"), c[1].alias("v"))))


def _page_list(html: Column, label: str) -> Column:
    """The items of the list whose class names ``label``, else of the first list behind a heading that does; null where there is none."""
    own = F.regexp_extract(html, rf"(?is)<ul\b[^>]*\bclass\s*=\s*[\"'][^\"'>]*{label}[^>]*>(.*?)</ul\s*>", 0)
    behind = F.regexp_extract(html, rf"(?is)<(?:h3|h4|td|th|strong)\b[^>]*>[^<]*{label}.*?(<ul\b[^>]*>.*?</ul\s*>)", 1)
    found = F.coalesce(blank_to_null(own), blank_to_null(behind))
    items = F.transform(F.regexp_extract_all(found, F.lit(r"(?is)<li\b[^>]*>(.*?)(?=<li\b|</li\b|</ul\b)"), F.lit(1)), page_text)
    return F.when(found.isNotNull(), F.to_json(items))


def profiles(pages: DataFrame, html_col: str = "html", path_col: str = "path") -> DataFrame:
    """(profile): the payload of each profile page, by the label map of the source, all in expressions.

    Labels and values stand in table rows of two cells; the first ``<time>`` gives the effective date if it has a datetime; sectors, goods and services
    are lists, kept as JSON. The employee count is the first number of its text, which is kept beside it. The number at the end of the path
    is the page's (``profile_id``; ``profile_key`` is what an id is made of where the business number is missing). A heading must name a list in its own text, not in a tag inside it.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    when = F.regexp_extract(F.regexp_extract(html, r"(?is)<time\b[^>]*>", 0), r"(?is)\bdatetime\s*=\s*[\"']([^\"']*)[\"']", 1)
    names = F.create_map(*[F.lit(x) for kv in t.HEADERS["nni"].items() for x in kv])
    own = F.transform(F.map_entries(F.col("_pairs")), lambda e: F.struct(F.coalesce(names[e["key"]], e["key"]).alias("k"), e["value"].alias("v")))
    number = F.regexp_extract(path_col, r"(\d+)[^/\d]*$", 1)
    more = [("effective_date", when), *((label, _page_list(html, label)) for label in t.PROFILE_LISTS), ("profile_id", number), ("profile_key", F.when(number != "", F.concat(F.lit("nni:"), number)))]
    given = F.filter(F.array(*(F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in more)), lambda x: x["v"].isNotNull() & (x["v"] != ""))
    rows = pages.select(profile_pairs(html).alias("_pairs"), html_col, path_col).select(_last_of_each(F.concat(own, given)).alias("p"))
    staff = F.col("p")["employee_count"]
    counted = F.map_filter(F.map_from_arrays(F.array(F.lit("employee_count"), F.lit("raw_employee_value")), F.array(blank_to_null(F.regexp_extract(staff, r"\d+", 0)), blank_to_null(staff))), lambda k, v: v.isNotNull())
    return rows.select(F.map_concat(F.map_filter("p", lambda k, v: k != "employee_count"), counted).alias("profile"))


def latest_link(links: DataFrame, href: str, pattern: str = r"(\d{4}-\d{2}-\d{2})") -> DataFrame:
    """The link with the newest date in it."""
    dated = links.select(F.col(href).alias("href"), F.to_date(F.nullif(F.regexp_extract(href, pattern, 1), F.lit(""))).alias("published")).filter("published is not null")
    return dated.agg(F.max_by("href", F.struct("published", "href")).alias("href"), F.max("published").alias("published"))


FILE_NO = r"(?i)file\s+no\.?\s*:?\s*([\w\-]+)"


def filings(docs: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """Records of the incorporations section of filing texts, the first of each file number.

    The section runs from its heading to the next section's; records start at a file number.
    """
    ends = r"(?im)^[ \t]*(amendments?|revivals?|dissolutions?|amalgamations?|continuations?)\b"
    section = F.regexp_extract(text_col, r"(?ims)^[ \t]*incorporations?\b[^\n]*\n(.*)", 1)
    section = F.element_at(F.split(section, ends, 2), 1)
    blocks = docs.select(id_col, F.posexplode(F.split(section, r"(?i)(?=file\s+no\.?\s*:?\s*[\w\-]+)")).alias("pos", "block"))
    number = blank_to_null(F.regexp_extract("block", FILE_NO, 1))
    name = F.get(F.filter(F.transform(F.split("block", "\n"), lambda s: F.btrim(s, F.lit(" \t\r\f"))), lambda s: (s == F.upper(s)) & s.rlike("[A-Z]") & F.length(s).between(5, 149)), 0)
    office = F.substring(F.trim(F.regexp_extract("block", r"(?i)registered\s+office\s*:?[ \t]*([^\n]+)", 1)), 1, 200)
    day = r"(\w+ \d+,? \d{4}|\d{4}-\d{2}-\d{2})"
    labels = ("date of incorporation", "date of registration", "effective date", "date")
    date = F.coalesce(*(blank_to_null(F.regexp_extract("block", rf"(?i){x}\s*:?\s*{day}", 1)) for x in labels))
    rows = blocks.select(id_col, "pos", number.alias("file_no"), name.alias("company_name"), blank_to_null(office).alias("registered_office"), date.alias("incorporation_date"), F.lit("PROVINCIAL_REGISTRATION").alias("event_type"))
    rows = rows.filter(F.col("file_no").isNotNull() | F.col("company_name").isNotNull())
    numbered = rows.filter("file_no is not null")
    cols = [c for c in rows.columns if c not in (id_col, "file_no")]
    first = numbered.groupBy(id_col, "file_no").agg(F.min(F.struct(*cols)).alias("r")).select(id_col, "file_no", "r.*")
    return first.unionByName(rows.filter("file_no is null")).drop("pos")


def sheet_rows(data: bytes) -> list[dict[str, str]]:
    """Rows of a workbook's first sheet under its first row; blank headers are named col_i, blank rows skipped."""
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        names = book.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(x.text or "" for x in si.iter(f"{{{ns['m']}}}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall("m:si", ns)]
        sheet = ElementTree.fromstring(book.read(min(n for n in names if n.startswith("xl/worksheets/sheet"))))
    table: list[dict[int, str]] = []
    for row in sheet.iterfind(".//m:row", ns):
        cells = {}
        for i, cell in enumerate(row.findall("m:c", ns)):
            letters = re.match(r"[A-Z]+", cell.get("r", ""))
            at = reduce(lambda a, ch: a * 26 + ord(ch) - 64, letters[0], 0) - 1 if letters else i
            value = cell.findtext("m:v", "", ns)
            if cell.get("t") == "s":
                value = shared[int(value)]
            elif cell.get("t") == "inlineStr":
                value = "".join(x.text or "" for x in cell.iter(f"{{{ns['m']}}}t"))
            cells[at] = value.strip()
        table.append(cells)
    if not table:
        return []
    width = max((max(r, default=-1) for r in table), default=-1) + 1
    header = [(table[0].get(i, "") or f"col_{i}").lower() for i in range(width)]
    return [{h: r.get(i, "") for i, h in enumerate(header)} for r in table[1:] if any(r.values())]


def workbooks(spark: SparkSession, path: str) -> DataFrame:
    """(path, row map) of every row of the workbooks at ``path``."""
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p, content in zip(f["path"], f["content"], strict=True):
                rows = sheet_rows(content)
                yield pd.DataFrame({"path": [p] * len(rows), "row": rows})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, "path string, row map<string,string>")


def zip_members(spark: SparkSession, path: str, suffix: str = ".csv") -> DataFrame:
    """(path, member, line) of the text members of landed archives."""
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p, content in zip(f["path"], f["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for m in (x for x in z.namelist() if x.lower().endswith(suffix)):
                        lines = z.read(m).decode("utf-8-sig", "replace").splitlines()
                        yield pd.DataFrame({"path": [p] * len(lines), "member": [m] * len(lines), "line": lines})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, "path string, member string, line string")
