"""Field observations with history, and the events they show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions import normalise as n
from quillstone.functions import tables as t

OBSERVED = {
    "legal_name": ("raw_legal_name", "legal_name"), "trade_name": ("raw_trade_name", "trade_name"), "address": ("raw_address", "normalised_address"), "postal_code": ("raw_postal_code", "postal_code"),
    "city": ("raw_city", "city"), "province": ("raw_province", "province"), "phone": ("raw_phone", "phone"), "email": ("raw_email", "email"), "website": ("raw_website", "domain"), "status": ("raw_status", "status"),
    "employee_value": ("raw_employees", "employee_bucket"), "naics": ("raw_naics", "naics_sector"), "issued_date": ("raw_issued_date", "issued_date"),
    "incorporation_date": ("raw_incorporation_date", "incorporation_date"),
}


def unpivot(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(record_id, ``keep``, field, raw_value, normalised_value) for every observed field, of those the records have, that has either."""
    dates = ("issued_date", "incorporation_date")
    rows = F.array(*(F.struct(F.lit(f).alias("field"), n.blank_to_null(F.col(raw).cast("string")).alias("raw_value"), (n.iso(F.col(own)) if own in dates else F.col(own).cast("string")).alias("normalised_value")) for f, (raw, own) in OBSERVED.items() if own in records.columns))
    if "extra" in records.columns:
        more = F.transform(F.map_entries("extra"), lambda e: F.struct(F.concat(F.lit("extra."), e["key"]).alias("field"), e["value"].alias("raw_value"), e["value"].alias("normalised_value")))
        rows = F.concat(rows, F.coalesce(more, F.array().cast(rows_type := "array<struct<field:string,raw_value:string,normalised_value:string>>")))
        rows = rows.cast(rows_type)
    return records.select("record_id", *keep, F.inline(F.filter(rows, lambda x: x["raw_value"].isNotNull() | x["normalised_value"].isNotNull())))


def with_current(observations: DataFrame) -> DataFrame:
    """Append-only observations with ``is_current``: the newest of each (entity, field); rows alike in time and id are so together.

    The newest is an aggregate, reduced before it moves, and the join on it can be split: no entity's history is one task's work.
    """
    order = F.struct("observed_at", "observation_id")
    newest = observations.groupBy(F.col("entity_id").alias("_entity"), F.col("field").alias("_field")).agg(F.max(order).alias("_newest"))
    same = F.col("entity_id").eqNullSafe(F.col("_entity")) & F.col("field").eqNullSafe(F.col("_field"))
    rows = observations.join(newest, same, "left")
    return rows.select(*(c for c in observations.columns if c != "is_current"), order.eqNullSafe(F.col("_newest")).alias("is_current"))


def appended(observations: DataFrame, added: DataFrame) -> DataFrame:
    """``observations`` with a batch behind them: what the batch observes anew is current no longer, nothing else changes.

    Only the keys of the batch are compared; the history before it is not ranked again.
    """
    touched = added.select("entity_id", "field", F.lit(True).alias("touched")).distinct()
    before = observations.join(touched, ["entity_id", "field"], "left").withColumn("is_current", F.col("is_current") & F.col("touched").isNull())
    return before.select(*observations.columns).unionByName(with_current(added).select(*observations.columns))


def field_history(observations: DataFrame) -> DataFrame:
    """Per entity and field: number of observations, current value, and all values, newest first."""
    return observations.groupBy("entity_id", "field").agg(
        F.count("*").alias("n_observations"), F.max_by("value", F.struct("observed_at", "observation_id")).alias("current_value"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("observed_at", "observation_id", "value")), asc=False), lambda x: F.coalesce(x["value"], F.lit(""))), ">").alias("history"),
    )


def event_date(*candidates: Column) -> Column:
    return F.coalesce(*(n.date(c) for c in candidates)).cast("date")


def event_fields(records: DataFrame) -> DataFrame:
    """``records`` with event_date, display_name, permit_number and event_type, as ``new_business_events`` wants them.

    ``records`` hold the normalised legal_name, trade_name, issued_date and incorporation_date, ``extra`` and ``raw_payload``. Normalised
    fields come first, then the payload's keys in their order; a date that cannot be read is passed over.
    """
    raw = F.col("raw_payload")
    first = lambda keys: F.coalesce(*(n.blank_to_null(raw[k]) for k in keys))
    dates = F.transform(F.array(*(raw[k] for k in t.EVENT_DATE_KEYS)), n.date)
    found = {
        "event_date": F.coalesce("incorporation_date", "issued_date", F.get(F.filter(dates, lambda d: d.isNotNull()), F.lit(0))).cast("date"), "display_name": F.coalesce("legal_name", "trade_name", first(t.EVENT_NAME_KEYS)),
        "permit_number": first(t.PERMIT_KEYS), "event_type": F.coalesce(n.blank_to_null(F.col("extra")["event_type"]), n.blank_to_null(raw["event_type"])),
    }
    return records.withColumns(found)


def new_business_events(records: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Discovery events of NEW records and typed events of event records, once per (entity, run, type, date, value).

    ``records``: entity_id, run_id, resolution_status, grain, event_type, event_date, display_name, permit_number.
    """
    typed = F.col("event_type").isin(*t.TYPED_EVENTS) & ((F.col("grain") == "EVENT") | (F.col("event_type") == t.FIRST_ISSUE))
    kinds = F.array_compact(F.array(F.when(F.col("resolution_status") == "NEW", "BUSINESS_DISCOVERED"), F.when(typed, F.col("event_type"))))
    rows = records.select("entity_id", "run_id", "event_date", "display_name", "permit_number", F.explode(kinds).alias("type"))
    value = F.coalesce("display_name", F.when(F.col("type") == "MUNICIPAL_PERMIT_ISSUED", F.col("permit_number")))
    events = rows.select("entity_id", "run_id", F.col("type").alias("event_type"), "event_date", value.alias("raw_value")).distinct()
    if existing is None:
        return events
    a, b = events.alias("a"), existing.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in events.columns]
    return a.join(b, same, "left_anti")


def compared(observations: DataFrame, run: int | Column) -> DataFrame:
    """(entity_id, field, old_value, new_value, observed_at, changed) of the values that are current in a run, next to the newest of any other run.

    A field that no other run has is no change. One pass: both sides are conditional aggregates over the same grouping.
    """
    run = F.lit(run) if isinstance(run, int) else run
    order = F.struct("observed_at", "observation_id")
    mine = F.col("run_id") == run
    both = observations.groupBy("entity_id", "field").agg(
        F.max_by(F.struct("value", "observed_at"), F.when(mine & F.col("is_current"), order)).alias("new"), F.max_by(F.struct("value"), F.when(~mine, order)).alias("old"),
        F.max(F.when(mine & F.col("is_current"), 1)).alias("has_new"), F.coalesce(F.max(F.when(~mine, 1)), F.lit(0)).alias("has_old"),
    )
    rows = both.filter("has_new = 1").select("entity_id", "field", "has_old", F.col("old.value").alias("old_value"), F.col("new.value").alias("new_value"), F.col("new.observed_at").alias("observed_at"))
    return rows.withColumn("changed", (F.col("has_old") == 1) & ~F.col("old_value").eqNullSafe(F.col("new_value"))).drop("has_old")


def changes(observations: DataFrame, run: int | Column) -> DataFrame:
    """(entity_id, field, old_value, new_value, observed_at) where a run's current value differs from the newest of any other run."""
    return compared(observations, run).filter("changed").drop("changed")


def change_events(values: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """At most one event per kind and entity, of ``compared`` values: status, name, location, and any change.

    The values before and after are JSON of the event's own fields, sorted. The date is that of the run's last observation of the
    entity, changed or not. Kinds that ``existing`` (entity_id, event_type; of the same run) has are left out.
    """
    pair = F.when(F.col("changed"), F.struct("field", "new_value", "old_value"))
    rows = values.groupBy("entity_id").agg(F.array_sort(F.collect_list(pair)).alias("all"), F.max("observed_at").cast("date").alias("event_date"))
    among = lambda fields: F.filter("all", lambda x: x["field"].isin(*fields))
    kinds = {"STATUS_CHANGED": among(("status",)), "NAME_CHANGED": among(t.NAME_FIELDS), "LOCATION_CHANGED": among(t.LOCATION_FIELDS), "BUSINESS_UPDATED": F.col("all")}
    events = rows.select("entity_id", "event_date", F.inline(F.array(*(F.struct(F.lit(k).alias("event_type"), part.alias("part")) for k, part in kinds.items())))).filter(F.size("part") > 0)
    text = lambda side: F.to_json(F.map_from_entries(F.transform("part", lambda x: F.struct(x["field"], x[side]))))
    events = events.select("entity_id", "event_type", "event_date", text("new_value").alias("raw_value"), text("old_value").alias("previous_value"))
    return events if existing is None else events.join(existing.select("entity_id", "event_type"), ["entity_id", "event_type"], "left_anti")


def status_history(values: DataFrame) -> DataFrame:
    """(entity_id, old_status, new_status, changed_at) of the statuses that changed; one that is gone is UNKNOWN."""
    rows = values.filter((F.col("field") == "status") & F.col("changed"))
    return rows.select("entity_id", F.col("old_value").alias("old_status"), F.coalesce("new_value", F.lit("UNKNOWN")).alias("new_status"), F.col("observed_at").alias("changed_at"))
