"""The query surface: filtered lists, details, events, sources, statistics and exports."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXPORT = ("entity_id", "canonical_name", "province", "city", "status", "phone", "email", "domain", "composite", "sales_ready")
MOST_BUSINESSES = 500
MOST_EVENTS = 1000


@dataclass(frozen=True)
class Filters:
    """Conditions on businesses; None leaves one out. ``has_*``: rows with it if true, without it if false."""

    province: str | None = None
    status: str | None = None
    city: str | None = None
    naics_sector: str | None = None
    employee_bucket: str | None = None
    source_key: str | None = None
    sales_ready: bool | None = None
    has_phone: bool | None = None
    has_email: bool | None = None
    has_website: bool | None = None
    has_director: bool | None = None
    event_type: str | None = None
    new_since: str | None = None
    dnc: bool | None = None


def _member(rows: DataFrame, ids: DataFrame, want: bool) -> DataFrame:
    return rows.join(ids.select("entity_id"), "entity_id", "left_semi" if want else "left_anti")


def filtered(entities: DataFrame, by: Filters, contacts: DataFrame, events: DataFrame, flags: DataFrame, people: DataFrame | None = None) -> DataFrame:
    """Entities under ``by``; membership tests are semi and anti joins on the entity."""
    rows = entities
    for name in ("province", "status"):
        if (v := getattr(by, name)) is not None:
            rows = rows.filter(F.upper(name) == v.upper())
    if by.city is not None:
        rows = rows.filter(F.lower("city") == by.city.lower())
    for name in ("naics_sector", "employee_bucket", "source_key", "sales_ready"):
        if (v := getattr(by, name)) is not None:
            rows = rows.filter(F.col(name) == v)
    for name, kind in (("has_phone", "PHONE"), ("has_email", "EMAIL"), ("has_website", "WEBSITE")):
        if (v := getattr(by, name)) is not None:
            rows = _member(rows, contacts.filter(F.col("kind") == kind), v)
    if by.has_director is not None and people is not None:
        rows = _member(rows, people.filter(F.col("role_type") == "DIRECTOR"), by.has_director)
    if by.event_type is not None:
        rows = _member(rows, events.filter(F.col("event_type") == by.event_type.upper()), True)
    if by.new_since is not None:
        rows = _member(rows, events.filter(F.col("event_date") >= F.lit(by.new_since).cast("date")), True)
    if by.dnc is not None:
        rows = _member(rows, flags.filter(F.col("flag_type") == "DNC"), by.dnc)
    return rows


def page(rows: DataFrame, order: list[Column], number: int, size: int, most: int = MOST_BUSINESSES) -> DataFrame:
    """Page ``number`` (from 1) in an order that an id makes total."""
    size = max(1, min(size, most))
    return rows.orderBy(*order).offset((max(1, number) - 1) * size).limit(size)


def page_info(rows: DataFrame, number: int, size: int, most: int = MOST_BUSINESSES) -> DataFrame:
    """One row: total, page, page_size, and next_cursor, the next page's number, null behind the last."""
    number, size = max(1, number), max(1, min(size, most))
    return rows.agg(F.count("*").alias("total")).select("total", F.lit(number).alias("page"), F.lit(size).alias("page_size"), F.when(F.col("total") > number * size, number + 1).alias("next_cursor"))


def sources_of(records: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records that contributed to the wanted entities: by entity, newest first, ties to the smaller id. A sort over all, which splits an entity of many records."""
    return _member(records, wanted, True).orderBy("entity_id", F.desc("created_at"), "record_id")


def detail(entities: DataFrame, **kids: DataFrame) -> DataFrame:
    """Entities with a sorted array of structs per child table, each aggregated before its join."""
    rows = entities
    for name, child in kids.items():
        cols = [c for c in child.columns if c != "entity_id"]
        rows = rows.join(child.groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name)), "entity_id", "left")
        rows = rows.withColumn(name, F.coalesce(name, F.array().cast(rows.schema[name].dataType)))
    return rows


def detail_rows(wanted: DataFrame, **kids: DataFrame) -> DataFrame:
    """(entity_id, child, value) of the wanted entities: a row for each row of a child table, as JSON with its nulls, by entity, child and value.

    ``detail`` without its arrays: a sort over all, which splits an entity of many rows. An entity without rows in a child has none here.
    """
    def one(name: str, child: DataFrame) -> DataFrame:
        return child.select("entity_id", F.lit(name).alias("child"), F.to_json(F.struct(*(c for c in child.columns if c != "entity_id")), {"ignoreNullFields": "false"}).alias("value"))

    rows = reduce(DataFrame.unionByName, (one(name, child) for name, child in kids.items()))
    return _member(rows, wanted, True).orderBy("entity_id", "child", "value")


def set_flag(flags: DataFrame, ids: DataFrame, kind: str) -> DataFrame:
    return flags.unionByName(ids.select("entity_id", F.lit(kind.upper()).alias("flag_type")))


def drop_flag(flags: DataFrame, ids: DataFrame, kind: str) -> DataFrame:
    """Without any flag of this kind on these entities."""
    return flags.join(ids.select("entity_id", F.lit(kind.upper()).alias("flag_type")), ["entity_id", "flag_type"], "left_anti")


def list_events(events: DataFrame, entities: DataFrame, event_type: str | None = None, start: str | None = None, end: str | None = None, province: str | None = None) -> DataFrame:
    rows = events
    if event_type is not None:
        rows = rows.filter(F.col("event_type") == event_type.upper())
    if start is not None:
        rows = rows.filter(F.col("event_date") >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.filter(F.col("event_date") <= F.lit(end).cast("date"))
    if province is not None:
        rows = _member(rows, entities.filter(F.upper("province") == province.upper()), True)
    return rows


def source_status(sources: DataFrame, runs: DataFrame) -> DataFrame:
    """Each source with its latest run, if any."""
    last = runs.groupBy("source_key").agg(F.max_by(F.struct("run_id", "run_status", "started_at"), F.struct("started_at", "run_id")).alias("r"))
    return sources.join(last, "source_key", "left").select(*sources.columns, F.col("r.run_id").alias("last_run"), F.col("r.run_status").alias("last_status"), F.col("r.started_at").alias("last_started"))


def totals(entities: DataFrame, discovered: Column, as_of: Column) -> DataFrame:
    return entities.agg(F.count("*").alias("n_businesses"), F.count_if("sales_ready").alias("n_sales_ready"), F.count_if(discovered >= F.date_sub(as_of, 30)).alias("n_recent"))


def by_province(entities: DataFrame, gaps: DataFrame) -> DataFrame:
    """Count and ready count per province, with its coverage gap; rows without a province are UNKNOWN and never ready."""
    rows = entities.groupBy("province").agg(F.count("*").alias("n"), F.count_if(F.col("sales_ready") & F.col("province").isNotNull()).alias("n_ready"))
    rows = rows.select(F.coalesce("province", F.lit("UNKNOWN")).alias("province"), "n", "n_ready")
    return rows.join(F.broadcast(gaps), "province", "left")  # one row per province


def by_source(records: DataFrame) -> DataFrame:
    return records.groupBy("source_key").agg(F.countDistinct("entity_id").alias("n_entities"))


def fill_rates(entities: DataFrame, contacts: DataFrame) -> DataFrame:
    """Share of entities with each kind of contact."""
    total = entities.agg(F.count("*").alias("total"))
    have = contacts.groupBy("kind").agg(F.countDistinct("entity_id").alias("n"))
    return have.join(F.broadcast(total)).select("kind", "n", F.bround(F.col("n") / F.col("total"), 4).alias("rate"))  # one row


def export(entities: DataFrame, contacts: DataFrame, flags: DataFrame, has_phone: bool = False, has_email: bool = False, include_dnc: bool = False) -> DataFrame:
    """The export columns; entities not to be contacted are left out unless asked for."""
    rows = entities if include_dnc else _member(entities, flags.filter(F.col("flag_type") == "DNC"), False)
    if has_phone:
        rows = _member(rows, contacts.filter(F.col("kind") == "PHONE"), True)
    if has_email:
        rows = _member(rows, contacts.filter(F.col("kind") == "EMAIL"), True)
    return rows.select(*EXPORT)


def for_csv(rows: DataFrame) -> DataFrame:
    """As text; nothing and a zero score are written as empty."""
    return rows.select(*(F.coalesce(F.when(~((F.lit(c == "composite")) & (F.col(c).cast("string") == "0")), F.col(c).cast("string")), F.lit("")).alias(c) for c in rows.columns))


def write_csv(rows: DataFrame, path: str) -> None:
    for_csv(rows).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)
