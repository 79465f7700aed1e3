"""The registered queries: each applies one operator to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import normalise as n
from quillstone.functions import tables as t
from quillstone.operators import batch, counts, enrich, extract, history, listing, profile, quality, records, resolve, snapshot, stages
from quillstone.operators.normalised import normalised
from quillstone.operators.store import Tables, hadoop_path
from quillstone.plans.landed import source_records
from quillstone.plans.landing import landing
from quillstone.sources import incremental, readers

QUERIES: dict = {}
AS_OF = "2024-06-01 00:00:00"


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalised(landing(spark, sf_dir))


_kept: dict[tuple, DataFrame] = {}


def kept_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalised records as a table, written once per application for the files as they are: what all but the normalisers begin with.

    They are dear to make and read by many; a plan that reads the table holds none of their expressions.
    """
    files = [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for name in ("customer", "supplier") for fs, p in [hadoop_path(spark, f"{sf_dir}/{name}.parquet")] for f in fs.listStatus(p)]
    key = (spark.sparkContext.applicationId, sf_dir, *files)
    if key not in _kept:
        _kept[key] = Tables(spark, "normalised").put("rows", norm(spark, sf_dir))
    return _kept[key]


def stores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Incoming records (the second source) and known entities (the first)."""
    rows = kept_norm(spark, sf_dir)
    return rows.filter("source_key = 'bc_indigenous'"), rows.filter("source_key = 'vancouver'").withColumn("entity_id", F.col("record_id"))


# --- normalisers ---------------------------------------------------------------------------------
@query
def norm_name(spark, sf_dir):
    return landing(spark, sf_dir).select("record_id", n.name(F.col("legal_name")).alias("legal_name"), n.name(F.col("trade_name")).alias("trade_name"))


@query
def norm_postal(spark, sf_dir):
    p = n.postal(F.col("postal_code"))
    return landing(spark, sf_dir).select("record_id", p["code"].alias("postal_code"), p["valid"].alias("postal_valid"))


@query
def norm_street(spark, sf_dir):
    return landing(spark, sf_dir).select("record_id", n.street(F.col("street")).alias("street"))


@query
def norm_address(spark, sf_dir):
    return norm(spark, sf_dir).select("record_id", "normalised_address", "raw_address", "address_line1", "address_line2", "city", "province")


@query
def norm_phone(spark, sf_dir):
    p = n.phone(F.col("phone"))
    return landing(spark, sf_dir).select("record_id", p["raw"].alias("raw_phone"), p["e164"].alias("phone"), p["valid"].alias("phone_valid"))


@query
def norm_email(spark, sf_dir):
    p = n.email(F.col("email"))
    return landing(spark, sf_dir).select("record_id", p["email"].alias("email"), p["valid"].alias("email_valid"))


@query
def norm_domain(spark, sf_dir):
    p = n.domain(F.col("website"))
    return landing(spark, sf_dir).select("record_id", p["domain"].alias("domain"), p["valid"].alias("domain_valid"))


@query
def norm_status(spark, sf_dir):
    return landing(spark, sf_dir).select("record_id", n.status(F.col("status"), F.col("source_key")).alias("status"))


@query
def norm_employee(spark, sf_dir):
    e = n.employee(F.col("employees"))
    return landing(spark, sf_dir).select("record_id", *(e[c].alias(f"employee_{c}") for c in ("low", "high", "bucket", "exact", "flag")))


@query
def norm_naics(spark, sf_dir):
    x = n.naics(F.col("naics"))
    return landing(spark, sf_dir).select("record_id", x["source"].alias("naics"), x["sector"].alias("naics_sector"))


@query
def norm_date(spark, sf_dir):
    return landing(spark, sf_dir).select("record_id", n.iso(n.date(F.col("issued_date"))).alias("issued"))


@query
def first_nonempty(spark, sf_dir):
    return landing(spark, sf_dir).select("record_id", n.first_nonempty(F.col("trade_name"), F.col("city"), F.col("legal_name")).alias("value"))


@query
def extra_passthrough(spark, sf_dir):
    payload = F.create_map(F.lit("name"), F.col("legal_name"), F.lit("businessname"), F.col("trade_name"), F.lit("zip"), F.col("postal_code"), F.lit("corp_number"), F.col("corp_number"))
    source = F.when(F.col("row_key") % 4 == 0, t.PERMITS).otherwise(F.col("source_key"))
    rows = landing(spark, sf_dir).select("record_id", n.extra(payload, source).alias("x"))
    return rows.select("record_id", F.explode_outer("x").alias("extra_key", "extra_value"))


# --- records -------------------------------------------------------------------------------------
@query
def record_ids(spark, sf_dir):
    rows = landing(spark, sf_dir)
    return rows.select("record_id", records.record_id([F.col("corp_number"), F.col("bn")], [F.col("legal_name"), F.col("status")]).alias("stable_id"), records.composite_id(F.col("legal_name"), F.col("city")).alias("composite_id"))


@query
def occurrence_ids(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus")
    out = records.with_occurrence(rows, F.col("l_returnflag"), [F.col("l_linestatus"), F.col("l_partkey")], F.struct("l_orderkey", "l_linenumber"), Tables(spark, "occurrences"))
    return out.select("l_orderkey", "l_linenumber", "occurrence_id")


@query
def event_only_filter(spark, sf_dir):
    return records.status_events(landing(spark, sf_dir), F.col("status")).select("record_id", "status", "event_type")


@query
def validation_report(spark, sf_dir):
    return records.validation(landing(spark, sf_dir), "record_id", ["trade_name", "city", "status"], ["source_key"])


@query
def validation_errors(spark, sf_dir):
    return records.validation_errors(landing(spark, sf_dir), "record_id", ["trade_name", "city", "status"])


@query
def incremental_cursor(spark, sf_dir):
    runs = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("kind")).agg(F.min("ts").alias("completed_at"), F.lit("COMPLETED").alias("run_status"))
    log = runs.withColumn("completed_at", F.timestamp_add("HOUR", F.lit(24 * 5), "completed_at"))
    return records.since(table(spark, sf_dir, "events").withColumnRenamed("event_type", "kind"), log, "ts", "kind").select("event_id", "kind")


@query
def incremental_files(spark, sf_dir):
    """The event stream as it lands, a file a day; read are the files of the last ten days, which planning picks by their date."""
    rows = table(spark, sf_dir, "events")
    folder = f"{Tables(spark, 'landed').folder}/events"
    rows.select("event_id", "event_type", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).repartition("day").write.partitionBy("day").option("header", True).csv(folder)
    cursor = F.lit(rows.agg(F.max(F.to_date("ts"))).first()[0]).cast("timestamp") - F.expr("INTERVAL 10 DAYS")
    got = incremental.landed(spark, folder, cursor, dated=r"day=(\d{4}-\d{2}-\d{2})")
    return got.select(F.col("row")["event_id"].cast("long").alias("event_id"), F.col("row")["event_type"].alias("kind"), F.col("row")["user_id"].cast("long").alias("user_id"), F.date_format("modified", "yyyy-MM-dd").alias("day"))


@query
def run_lifecycle(spark, sf_dir):
    state = F.element_at(F.array(*map(F.lit, ("RUNNING", "FAILED", "COMPLETED", "PARTIAL"))), (F.col("event_id") % 4 + 1).cast("int"))
    return records.latest_runs(table(spark, sf_dir, "events").select((F.col("user_id") % 200).alias("run_id"), state.alias("run_status"), F.col("ts").alias("changed_at")))


# --- resolution ----------------------------------------------------------------------------------
@query
def match_exact(spark, sf_dir):
    return resolve.match_exact(*stores(spark, sf_dir))


@query
def match_domain_postal(spark, sf_dir):
    return resolve.match_domain_postal(*stores(spark, sf_dir))


@query
def match_phone_postal(spark, sf_dir):
    return resolve.match_phone_postal(*stores(spark, sf_dir))


@query
def match_name_address(spark, sf_dir):
    return resolve.match_name_address(*stores(spark, sf_dir))


@query
def match_fuzzy(spark, sf_dir):
    return resolve.match_fuzzy(*stores(spark, sf_dir))


@query
def resolve_outcomes(spark, sf_dir):
    return resolve.resolve(*stores(spark, sf_dir))


@query
def resolve_batch(spark, sf_dir):
    """Records of both sources, of which some belong together, against the entities that every other record of the first made before."""
    rows = kept_norm(spark, sf_dir)
    known = rows.filter("source_key = 'vancouver' AND row_key % 2 = 1").withColumn("entity_id", F.col("record_id"))
    return batch.resolve_batch(rows.filter("source_key = 'bc_indigenous' OR row_key % 2 = 0"), known)


@query
def source_to_entity(spark, sf_dir):
    """From landed files of five sources, each in its own form, to the entities that their records make or join."""
    tables = Tables(spark, "arrival")
    arrived = source_records(spark, sf_dir, tables)
    outcomes = tables.put("outcomes", batch.resolve_batch(arrived, arrived.limit(0).withColumn("entity_id", F.col("record_id"))))
    rows = resolve.placed(arrived, outcomes)
    made = resolve.new_entities(rows).select("entity_id", "canonical_name")
    own = rows.withColumn("made", F.when(F.col("outcome").isin("CANDIDATE", "NEW"), F.col("entity_id")))
    named = own.join(made.withColumnRenamed("entity_id", "made"), "made", "left")
    return named.select("record_id", "source_key", "outcome", "rule", "confidence", "score", "entity_id", "canonical_name", "corp_number", "normalised_address")


@query
def run_stages(spark, sf_dir):
    """A run of the incoming records that stopped after resolution, taken up at that stage: per stage its state, attempts and tables with their rows."""
    rows = landing(spark, sf_dir).filter("source_key = 'bc_indigenous'")
    known = kept_norm(spark, sf_dir).filter("source_key = 'vancouver'").withColumn("entity_id", F.col("record_id"))
    run = stages.Run(spark, Tables(spark, "runs").folder, "run-1", stages.record_stages(rows, known, fuzzy=False, as_of=AS_OF))
    run.run(until="resolve")
    run.run(stage_from="resolve")
    return run.states().select("stage", "state", "attempts", F.explode("tables").alias("table_name", "n_rows"))


@query
def resolve_exact_steps(spark, sf_dir):
    """The cascade without its fuzzy step, which SQL cannot score."""
    return resolve.resolve(*stores(spark, sf_dir), fuzzy=False)


def exactly_placed(spark, sf_dir) -> DataFrame:
    new, known = stores(spark, sf_dir)
    return resolve.placed(new, resolve.resolve(new, known, fuzzy=False))


@query
def resolution_entities(spark, sf_dir):
    return resolve.new_entities(exactly_placed(spark, sf_dir))


@query
def resolution_edges(spark, sf_dir):
    return resolve.candidate_edges(exactly_placed(spark, sf_dir))


@query
def resolution_observations(spark, sf_dir):
    """The known entities' observations with those of the records behind them, which expire them where a record was matched."""
    _, known = stores(spark, sf_dir)
    columns = ("entity_id", "record_id", "field", "normalised_value", "confidence", "is_current", "observed_at", "observation_id")
    stamped = lambda rows, day: rows.withColumns({"observed_at": F.lit(day).cast("date"), "observation_id": F.col("record_id")})
    before = stamped(history.unpivot(known, ("entity_id",)), "2024-01-01").withColumns({"confidence": F.lit(None).cast("string"), "is_current": F.lit(True)}).select(*columns)
    added = stamped(resolve.record_observations(exactly_placed(spark, sf_dir)), "2024-02-01")
    return history.appended(before, added).drop("observed_at", "observation_id")


@query
def retry_set(spark, sf_dir):
    """What a run that begins again has to resolve, and what becomes of it."""
    status = F.element_at(F.array(*map(F.lit, ("PENDING", "UNRESOLVED", "MATCHED", "NEW", "CANDIDATE"))), (F.col("row_key") % 5 + 1).cast("int"))
    new, known = stores(spark, sf_dir)
    due = resolve.to_resolve(new.withColumn("resolution_status", status), 1)
    return resolve.resolve(due, known, fuzzy=False).select("record_id", "outcome", "rule", "matched_entity")


@query
def identity_gate(spark, sf_dir):
    """Names are left out of most rows, so that each of the five ids decides for some, as a column or among the extra values."""
    k = F.col("row_key")
    own = lambda n: F.when(k % 12 == n, F.lit(" id ")).when(k % 12 == 11, "").otherwise(F.lit(None))
    named = lambda c: F.when(k % 5 == 0, F.col(c)).alias(c)
    rows = norm(spark, sf_dir).select("record_id", named("legal_name"), named("trade_name"), own(1).alias("corp_number"), own(2).alias("bn"), F.create_map(*(x for i, c in enumerate(t.IDENTITY_KEYS, 3) for x in (F.lit(c), own(i))), F.lit("other"), F.lit("x")).alias("extra"))
    return rows.select("record_id", resolve.has_identity(rows.columns).alias("has_identity"))


@query
def entity_children(spark, sf_dir):
    return resolve.children(norm(spark, sf_dir))


@query
def entity_facts(spark, sf_dir):
    return resolve.size_and_industry(norm(spark, sf_dir))


@query
def back_references(spark, sf_dir):
    new, _ = stores(spark, sf_dir)
    references = new.select("record_id", F.lit("vancouver").alias("source_key"), (F.col("row_key") % 40).alias("source_record_id"))
    unresolved = landing(spark, sf_dir).filter("source_key = 'vancouver'").select("source_key", F.col("row_key").alias("source_record_id"))
    return resolve.linked_references(new.select("record_id", F.col("record_id").alias("entity_id")), references, unresolved)


def earlier_permits(spark, sf_dir) -> DataFrame:
    """The first source's records as permits of an earlier run: one in four has an entity already, one in three no name."""
    k, permit = F.col("row_key"), F.lit("MUNICIPAL_PERMIT_ISSUED")
    rows = kept_norm(spark, sf_dir).filter("source_key = 'vancouver'")
    done, unnamed = k % 4 == 0, {c: F.when(k % 3 != 0, F.col(c)) for c in ("legal_name", "raw_legal_name", "trade_name", "raw_trade_name")}
    more = {
        "source_record_id": k, "entity_id": F.when(done, "other"), "resolution_status": F.when(done, "MATCHED").otherwise("UNRESOLVED"), "grain": F.lit("EVENT"), "extra": F.create_map(F.lit("event_type"), permit),
        "raw_payload": F.create_map(F.lit("permit_number"), F.concat(F.lit("P"), k.cast("string"))), "incorporation_date": F.lit(None).cast("timestamp"), "raw_incorporation_date": F.lit(None).cast("string"),
    }
    return rows.withColumns({**unnamed, **more})


@query
def back_reference_follow_ups(spark, sf_dir):
    """Observations and events of the earlier permits that incoming records name."""
    new, _ = stores(spark, sf_dir)
    references = new.select("record_id", F.lit("vancouver").alias("source_key"), (F.col("row_key") % 40).alias("source_record_id"))
    _, observed, events = resolve.follow_ups(new.select("record_id", F.col("record_id").alias("entity_id")), references, earlier_permits(spark, sf_dir))
    seen = observed.select("entity_id", "run_id", F.lit("observation").alias("kind"), F.col("field").alias("name"), F.col("normalised_value").alias("value"), F.lit(None).cast("date").alias("event_date"))
    return seen.unionByName(events.select("entity_id", "run_id", F.lit("event").alias("kind"), F.col("event_type").alias("name"), F.col("raw_value").alias("value"), "event_date"))


# --- history and events --------------------------------------------------------------------------
def observations(spark, sf_dir) -> DataFrame:
    """The event stream as observations: user, kind of event as field, value from the properties, run by number."""
    rows = table(spark, sf_dir, "events")
    field = F.element_at(F.array(*map(F.lit, ("status", "legal_name", "address", "phone", "city"))), (F.col("event_id") % 5 + 1).cast("int"))
    return rows.select((F.col("user_id") % 300).alias("entity_id"), field.alias("field"), (F.get_json_object("props", "$.k").cast("int") % 3).cast("string").alias("value"), F.col("ts").alias("observed_at"), F.col("event_id").alias("observation_id"), (F.col("event_id") % 4).cast("int").alias("run_id"))


@query
def unpivot_observations(spark, sf_dir):
    return history.unpivot(norm(spark, sf_dir))


@query
def scd2_current(spark, sf_dir):
    return history.with_current(observations(spark, sf_dir)).select("observation_id", "entity_id", "field", "is_current")


@query
def scd2_batches(spark, sf_dir):
    """The observations taken in by three batches that interleave in time, the last one of few entities: as if all had come at once."""
    rows = observations(spark, sf_dir)
    kept = snapshot.Observations(spark, Tables(spark, "observed").folder, rows.schema, 16)
    part = F.when(F.col("entity_id") % 40 == 7, 2).otherwise(F.col("observation_id") % 2)
    for k in range(3):
        kept.append(str(k), rows.filter(part == k))
    return kept.history().select("observation_id", "entity_id", "field", "is_current")


@query
def field_history(spark, sf_dir):
    return history.field_history(observations(spark, sf_dir))


@query
def business_events(spark, sf_dir):
    kinds = F.element_at(F.array(*map(F.lit, (*t.TYPED_EVENTS, "OTHER"))), (F.col("row_key") % 9 + 1).cast("int"))
    status = F.element_at(F.array(*map(F.lit, ("NEW", "CANDIDATE", "MATCHED"))), (F.col("row_key") % 3 + 1).cast("int"))
    rows = kept_norm(spark, sf_dir).select(
        (F.col("row_key") % 400).alias("entity_id"), "run_id", status.alias("resolution_status"), F.when(F.col("row_key") % 2 == 0, "EVENT").otherwise("LICENCE").alias("grain"), kinds.alias("event_type"),
        F.col("issued_date").cast("date").alias("event_date"), F.when(F.col("row_key") % 5 != 0, F.col("legal_name")).alias("display_name"), F.concat(F.lit("P"), F.col("row_key").cast("string")).alias("permit_number"),
    )
    existing = rows.filter("entity_id % 7 = 0").select("entity_id", "run_id", F.lit("BUSINESS_DISCOVERED").alias("event_type"), "event_date", F.col("display_name").alias("raw_value"))
    return history.new_business_events(rows, existing)


@query
def field_changes(spark, sf_dir):
    return history.changes(history.with_current(observations(spark, sf_dir)), 1)


@query
def change_events(spark, sf_dir):
    return history.change_events(history.compared(history.with_current(observations(spark, sf_dir)), 1))


@query
def status_history(spark, sf_dir):
    return history.status_history(history.compared(history.with_current(observations(spark, sf_dir)), 1))


@query
def event_fields(spark, sf_dir):
    k = F.col("row_key")
    when = lambda n, c: F.when(k % n == 0, c)
    payload = {
        "effective date": when(4, F.col("raw_issued_date")), "issue_date": when(6, F.lit("no date")), "registration_date": when(3, F.lit("2024-02-01")), "company_name": when(2, F.col("raw_legal_name")), "name": when(3, F.lit("named")),
        "numero_permis": when(5, F.lit("")), "permit_number": F.concat(F.lit("P"), k.cast("string")), "event_type": when(7, F.lit(t.FIRST_ISSUE)),
    }
    rows = kept_norm(spark, sf_dir).select(
        "record_id", when(5, F.col("legal_name")).alias("legal_name"), when(11, F.col("trade_name")).alias("trade_name"), when(7, F.col("issued_date")).alias("issued_date"), when(13, F.lit("2020-01-01").cast("timestamp")).alias("incorporation_date"),
        F.create_map(F.lit("event_type"), when(3, F.lit("REGISTRY_FILING"))).alias("extra"), F.create_map(*(x for name, c in payload.items() for x in (F.lit(name), c))).alias("raw_payload"),
    )
    return history.event_fields(rows).select("record_id", "event_date", "display_name", "permit_number", "event_type")


# --- quality and listing -------------------------------------------------------------------------
def entities(spark, sf_dir) -> DataFrame:
    """Entities with everything that is scored and listed; what no record holds is a formula of the key."""
    rows = kept_norm(spark, sf_dir)
    k = F.col("row_key")
    return rows.select(
        F.col("record_id").alias("entity_id"), "row_key", "source_key", F.coalesce("legal_name", "trade_name", "source_key").alias("canonical_name"), "legal_name", F.when(k % 3 == 0, "CORPORATION").alias("entity_type"), "corp_number", "bn",
        "address_line1", "city", "province", "postal_code", (k % 6 == 0).alias("has_coordinates"), "phone", "phone_valid", "email", "email_valid", "domain", "employee_bucket", "employee_exact", "naics", "naics_sector",
        F.when(k % 5 == 0, k % 7).otherwise(0).cast("int").alias("directors"), (k % 4 == 0).alias("has_primary_contact"),
        F.when(k % 8 != 0, F.timestamp_add("HOUR", (-(k % 900) * 24).cast("int"), F.lit(AS_OF).cast("timestamp"))).alias("last_verified_at"),
        F.when(k % 9 != 0, F.array("source_class", F.when(k % 2 == 0, "B").otherwise("D"))).otherwise(F.array().cast("array<string>")).alias("source_classes"), "status", (k % 11 == 0).alias("dnc"), F.col("issued_date").cast("date").alias("first_seen"),
    )


def scored(spark, sf_dir) -> DataFrame:
    return quality.scores(entities(spark, sf_dir), F.lit(AS_OF).cast("timestamp"))


def listed(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Entities with score and readiness, contacts, events, flags, people."""
    rows = entities(spark, sf_dir)
    s = quality.scores(rows, F.lit(AS_OF).cast("timestamp")).select("entity_id", "composite", "sales_ready")
    contacts = rows.select("entity_id", F.inline(F.filter(F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value")) for kind, c in (("PHONE", "phone"), ("EMAIL", "email"), ("WEBSITE", "domain")))), lambda x: x["value"].isNotNull())))
    events = rows.filter("first_seen is not null").select("entity_id", F.when(F.col("row_key") % 2 == 0, "BUSINESS_DISCOVERED").otherwise("STATUS_CHANGED").alias("event_type"), F.col("first_seen").alias("event_date"))
    flags = rows.filter("dnc").select("entity_id", F.lit("DNC").alias("flag_type"))
    people = rows.filter("directors > 0").select("entity_id", F.lit("DIRECTOR").alias("role_type"))
    return rows.join(s, "entity_id"), contacts, events, flags, people


@query
def quality_scores(spark, sf_dir):
    return scored(spark, sf_dir)


@query
def quality_assembled(spark, sf_dir):
    """The same scores from tables of the entities' parts, one row per contact, identifier, location, person, source and flag."""
    rows = entities(spark, sf_dir)
    pairs = lambda *cs: F.inline(F.filter(F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value"), ok.alias("is_valid")) for kind, c, ok in cs)), lambda x: x["value"].isNotNull()))
    no, k = F.lit(False), F.col("row_key")
    contacts = rows.select("entity_id", pairs(("PHONE", "phone", F.col("phone_valid")), ("PHONE", "phone", no), ("EMAIL", "email", F.col("email_valid")), ("WEBSITE", "domain", no)))
    spot = F.when(F.col("has_coordinates"), F.lit(49.0))
    home = F.struct(F.lit(2).alias("location_id"), F.lit(True).alias("is_primary"), "address_line1", "city", "province", "postal_code", spot.alias("latitude"), spot.alias("longitude"))
    other = F.struct(F.lit(1).alias("location_id"), F.lit(False).alias("is_primary"), *(F.lit("elsewhere").alias(c) for c in ("address_line1", "city", "province", "postal_code")), F.lit(1.0).alias("latitude"), F.lit(1.0).alias("longitude"))
    roles = F.concat(F.array_repeat(F.lit("DIRECTOR"), F.col("directors")), F.when(F.col("has_primary_contact"), F.array(F.lit("PRESIDENT"))).otherwise(F.array(F.lit("CLERK"))))
    whole = quality.assembled(
        rows.select("entity_id", "canonical_name", "legal_name", "entity_type", F.lit("ON").alias("province"), "status", "last_verified_at"), contacts, rows.select("entity_id", pairs(("CORP_NUMBER", "corp_number", no), ("BN", "bn", no))).drop("is_valid"),
        rows.select("entity_id", F.inline(F.when(k % 2 == 0, F.array(home, other)).otherwise(F.array(home)))), rows.filter("employee_bucket is not null").select("entity_id", "employee_bucket", "employee_exact"),
        rows.select("entity_id", "naics", "naics_sector"), rows.select("entity_id", F.explode(roles).alias("role_type")), rows.select("entity_id", F.explode("source_classes").alias("source_class")), rows.filter("dnc").select("entity_id", F.lit("DNC").alias("flag_type")),
    )
    return quality.scores(whole, F.lit(AS_OF).cast("timestamp"))


@query
def quality_upserts(spark, sf_dir):
    rows = scored(spark, sf_dir).select("entity_id", "composite", "sales_ready", F.lit("2024-06-01").cast("date").alias("scored_at"))
    known = landing(spark, sf_dir).filter("row_key % 2 = 0").select(F.col("record_id").alias("entity_id"), F.lit(0).alias("composite"), F.lit(False).alias("sales_ready"), F.lit("2024-01-01").cast("date").alias("scored_at"))
    return quality.upserted(known, rows.filter("composite >= 50"))


@query
def quality_badges(spark, sf_dir):
    return scored(spark, sf_dir).groupBy(quality.badge(F.col("composite")).alias("badge")).agg(F.count("*").alias("n"), F.count_if("sales_ready").alias("n_ready"))


@query
def list_businesses(spark, sf_dir):
    rows, contacts, events, flags, people = listed(spark, sf_dir)
    by = listing.Filters(status="active", has_phone=True, has_email=False, dnc=False, new_since="2024-01-01")
    kept = listing.filtered(rows, by, contacts, events, flags, people).select("entity_id", "canonical_name", "province", "city", "composite", "sales_ready", "first_seen")
    return listing.page(kept, [F.desc_nulls_last("first_seen"), F.asc("entity_id")], 1, 50)


@query
def list_businesses_total(spark, sf_dir):
    """Totals and cursors of a first, a middle and a last page."""
    rows, contacts, events, flags, people = listed(spark, sf_dir)
    kept = listing.filtered(rows, listing.Filters(status="active", dnc=False), contacts, events, flags, people).select("entity_id")
    return listing.page_info(kept, 1, 10).unionByName(listing.page_info(kept, 2, 10)).unionByName(listing.page_info(kept, 1_000_000, 900))


@query
def business_sources(spark, sf_dir):
    rows = landing(spark, sf_dir)
    k = F.col("row_key")
    linked = rows.select(F.when(k % 10 != 9, k % 100).alias("entity_id"), "record_id", "source_key", "run_id", F.date_add(F.lit("2024-01-01").cast("date"), (k % 5).cast("int")).alias("created_at"))
    return listing.sources_of(linked, spark.range(0, 50).withColumnRenamed("id", "entity_id"))


@query
def list_businesses_members(spark, sf_dir):
    rows, contacts, events, flags, people = listed(spark, sf_dir)
    by = listing.Filters(province="on", has_website=True, has_director=False, event_type="status_changed")
    return listing.filtered(rows, by, contacts, events, flags, people).select("entity_id", "canonical_name", "composite")


@query
def business_detail(spark, sf_dir):
    rows, contacts, events, flags, _ = listed(spark, sf_dir)
    out = listing.detail(rows.select("entity_id", "canonical_name"), contacts=contacts, events=events, flags=flags)
    return out.select("entity_id", "canonical_name", F.array_join(F.transform("contacts", lambda c: F.concat_ws(":", c["kind"], c["value"])), "|").alias("contacts"), F.size("events").cast("long").alias("n_events"), F.size("flags").cast("long").alias("n_flags"))


@query
def business_detail_rows(spark, sf_dir):
    """All seven child tables of the entities that are sales ready."""
    rows, contacts, *_ = listed(spark, sf_dir)
    ids = F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value")) for kind, c in (("CORP_NUMBER", "corp_number"), ("BN", "bn"))))
    return listing.detail_rows(
        rows.filter("sales_ready"), locations=rows.select("entity_id", "address_line1", "city", "province", "postal_code"), identifiers=rows.select("entity_id", F.inline(F.filter(ids, lambda x: x["value"].isNotNull()))), contacts=contacts,
        persons=rows.filter("directors > 0").select("entity_id", F.lit("DIRECTOR").alias("role_type"), F.explode(F.sequence(F.lit(1), F.col("directors"))).alias("place")), employee_data=rows.filter("employee_bucket is not null").select("entity_id", "employee_bucket", "employee_exact"),
        industries=rows.filter("naics is not null or naics_sector is not null").select("entity_id", "naics", "naics_sector"), quality_score=rows.select("entity_id", "composite", "sales_ready"),
    )


@query
def flag_updates(spark, sf_dir):
    rows, _, _, flags, _ = listed(spark, sf_dir)
    more = listing.set_flag(flags, rows.filter("row_key % 13 = 0"), "vip")
    return listing.drop_flag(more, rows.filter("row_key % 2 = 0"), "dnc")


@query
def list_events(spark, sf_dir):
    rows, _, events, _, _ = listed(spark, sf_dir)
    kept = listing.list_events(events, rows, "business_discovered", "2024-01-01", "2024-03-31", "on")
    return listing.page(kept, [F.desc_nulls_first("event_date"), F.asc("entity_id")], 1, 100, listing.MOST_EVENTS)


@query
def source_status(spark, sf_dir):
    runs = table(spark, sf_dir, "events").select(F.concat(F.lit("s"), F.col("user_id") % 30).alias("source_key"), F.col("event_id").alias("run_id"), F.col("event_type").alias("run_status"), F.col("ts").alias("started_at"))
    sources = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey") % 40).alias("source_key")).distinct()
    return listing.source_status(sources, runs)


@query
def stats_totals(spark, sf_dir):
    rows = listed(spark, sf_dir)[0]
    return listing.totals(rows, F.col("first_seen"), F.lit("2024-04-01").cast("date"))


@query
def stats_by_province(spark, sf_dir):
    gaps = spark.createDataFrame([("NU", "CONFIRMED"), ("YT", "PARTIAL"), ("QC", "DEFERRED")], "province string, gap string")
    return listing.by_province(listed(spark, sf_dir)[0], gaps)


@query
def stats_by_source(spark, sf_dir):
    return listing.by_source(kept_norm(spark, sf_dir).select("source_key", F.col("legal_name").alias("entity_id")))


def counted(spark, sf_dir) -> DataFrame:
    """Bitmaps of names by source and by kind of contact: those of two thirds of the records, then a delta merged into them."""
    rows = kept_norm(spark, sf_dir)
    kinds = F.array_compact(F.array(F.concat(F.lit("source:"), "source_key"), *(F.when(F.col(c).isNotNull(), F.lit(k)) for c, k in (("phone", "kind:PHONE"), ("email", "kind:EMAIL"), ("domain", "kind:WEBSITE")))))
    members = rows.select("row_key", F.col("legal_name").alias("entity_id"), F.explode(kinds).alias("grp"))
    tables, delta = Tables(spark, "counted"), F.col("row_key") % 3 == 0
    numbers = counts.numbered(tables, members.filter(~delta).select("entity_id"))
    kept = tables.put("bitmaps", counts.bitmaps(members.filter(~delta), numbers, ["grp"]))
    numbers = counts.numbered(tables, members.filter(delta).select("entity_id"), numbers)
    return tables.put("merged", counts.merged(kept, counts.bitmaps(members.filter(delta), numbers, ["grp"]), ["grp"]))


@query
def stats_merged(spark, sf_dir):
    return counts.distinct_counts(counted(spark, sf_dir), ["grp"])


@query
def overlaps_merged(spark, sf_dir):
    return counts.overlaps(counted(spark, sf_dir), "grp")


@query
def contact_fill_rates(spark, sf_dir):
    rows, contacts, *_ = listed(spark, sf_dir)
    return listing.fill_rates(rows, contacts)


@query
def export_rows(spark, sf_dir):
    rows, contacts, _, flags, _ = listed(spark, sf_dir)
    return listing.for_csv(listing.export(rows, contacts, flags, has_phone=True))


# --- enrichment ----------------------------------------------------------------------------------
def corp_numbers(rows: DataFrame) -> DataFrame:
    return rows.filter("corp_number <> ''").select(F.col("record_id").alias("entity_id"), F.lit("CORP_NUMBER").alias("id_type"), F.col("corp_number").alias("id_value"))


@query
def enrich_directors(spark, sf_dir):
    rows = landing(spark, sf_dir)
    name = F.concat(F.lit("Director "), (F.col("row_key") % 7).cast("string"))
    found = rows.filter("row_key % 2 = 0").select("corp_number", F.when(F.col("row_key") % 5 == 0, "").otherwise(name).alias("director_name"))
    people = rows.filter("row_key % 3 = 0").select(F.col("record_id").alias("entity_id"), name.alias("person_name"), F.lit("DIRECTOR").alias("role_type"))
    return enrich.new_directors(found, corp_numbers(rows), people)


def answers(spark, sf_dir) -> DataFrame:
    """Two register answers for every third record."""
    rows = landing(spark, sf_dir).filter("row_key % 3 = 0").select("*", F.explode(F.array(F.lit(1), F.lit(0))).alias("position"))
    return rows.select(F.col("record_id").alias("entity_id"), "position", F.concat("legal_name", F.col("position").cast("string")).alias("legal_name"), "status", F.col("issued_date").alias("registration_date"), F.lit(None).cast("string").alias("entity_type"))


@query
def enrich_register(spark, sf_dir):
    return enrich.register_observations(answers(spark, sf_dir))


@query
def enrich_register_updates(spark, sf_dir):
    known = entities(spark, sf_dir).select("entity_id", "status", "last_verified_at")
    return enrich.register_updates(known, answers(spark, sf_dir), F.lit(AS_OF).cast("timestamp"))


@query
def enrich_website_phones(spark, sf_dir):
    four = F.lpad((F.col("page_id") % 10000).cast("string"), 4, "0")
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("entity_id"), F.concat("html", F.lit("<p>(416) 555-"), four, F.lit(" or +1 604.555.0199; 416.555."), four, F.lit(", 999-555-0100</p>")).alias("html"))
    contacts = pages.filter("entity_id % 4 = 0").select("entity_id", F.lit("PHONE").alias("kind"), F.lit("+16045550199").alias("value"))
    return enrich.website_phones(pages, contacts)


@query
def enrich_directors_due(spark, sf_dir):
    rows = landing(spark, sf_dir)
    k = F.col("row_key")
    events = rows.select(F.concat(F.lit("e"), "record_id").alias("event_id"), F.col("record_id").alias("entity_id"), F.when(k % 2 == 0, "FEDERAL_INCORPORATION").alias("event_type"), F.when(k % 3 == 0, enrich.ATTEMPTED).when(k % 3 == 1, F.col("legal_name")).alias("raw_value"))
    numbers = corp_numbers(rows)
    tried = enrich.directors_due(events, numbers, 10)
    return enrich.directors_due(enrich.mark_attempted(events, tried), numbers)


@query
def enrich_registers_due(spark, sf_dir):
    rows = kept_norm(spark, sf_dir)
    k = F.col("row_key")
    known = rows.filter("row_key % 2 = 0").select(F.col("record_id").alias("entity_id"), F.lit("BC_REG_ID").alias("id_type"), k.cast("string").alias("id_value"))
    seen = rows.select(F.col("record_id").alias("entity_id"), F.lit("legal_name").alias("field"), (k % 5 != 0).alias("is_current"), F.when(k % 7 < 3, enrich.REGISTER).alias("enrichment_source"))
    return enrich.registers_due(rows.select(F.col("record_id").alias("entity_id"), "province", F.when(k % 11 != 0, F.col("legal_name")).alias("canonical_name")), known, seen)


# --- profiles ------------------------------------------------------------------------------------
@query
def missingness(spark, sf_dir):
    return profile.missingness(landing(spark, sf_dir), ["trade_name", "street", "city", "province", "postal_code", "phone", "email"])


@query
def value_distribution(spark, sf_dir):
    return profile.distribution(landing(spark, sf_dir), F.col("province"), 30)


@query
def large_values(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(20)


@query
def duplicate_rows(spark, sf_dir):
    return profile.duplicates(kept_norm(spark, sf_dir).select("record_id", "trade_name"), F.col("trade_name"), ["record_id"])


@query
def cross_tab(spark, sf_dir):
    return profile.cross_tab(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")


@query
def value_shares(spark, sf_dir):
    return profile.shares(table(spark, sf_dir, "orders"), "o_orderpriority")


@query
def field_fill_rates(spark, sf_dir):
    return profile.fill_rates(landing(spark, sf_dir), ["phone", "email", "website", "employees", "naics"], t.NO_CONTACT)


@query
def date_profile(spark, sf_dir):
    return profile.date_profile(landing(spark, sf_dir), F.col("issued_date"), n.date(F.col("issued_date")))


@query
def numeric_profile(spark, sf_dir):
    return profile.numeric_profile(table(spark, sf_dir, "customer"), F.col("c_acctbal"))


@query
def bucket_histogram(spark, sf_dir):
    return profile.histogram(table(spark, sf_dir, "part"), F.col("p_size"))


@query
def multi_value_groups(spark, sf_dir):
    return profile.multi_value(table(spark, sf_dir, "part"), F.col("p_type"), F.col("p_size"))


@query
def recency_buckets(spark, sf_dir):
    return profile.recency_buckets(kept_norm(spark, sf_dir), F.col("issued_date").cast("date"), F.lit("2024-04-01").cast("date"))


@query
def set_overlap(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return profile.set_overlap(rows.select(F.col("l_returnflag").alias("set_name"), F.col("p_name").alias("item")))


@query
def set_difference(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return profile.set_difference(docs, labels, "doc_id")


@query
def membership_rate(spark, sf_dir):
    new, known = stores(spark, sf_dir)
    return profile.membership(new, F.col("raw_legal_name"), known, F.col("raw_legal_name"))


@query
def grain_profile(spark, sf_dir):
    return profile.grain(table(spark, sf_dir, "orders"), F.col("o_custkey"), F.col("o_orderkey"), F.col("o_orderpriority"))


@query
def contact_quality(spark, sf_dir):
    return profile.contact_quality(landing(spark, sf_dir), n.phone(F.col("phone")), n.email(F.col("email")), n.domain(F.col("website")))


@query
def stream_counters(spark, sf_dir):
    """Gaps and classes of a whole table in one pass."""
    rows = kept_norm(spark, sf_dir)
    return rows.groupBy("source_key").agg(F.count("*").alias("n"), F.count_if(F.col("province").isNull()).alias("no_province"), F.count_if(F.col("status") == "ACTIVE").alias("n_active"), F.countDistinct("province").alias("n_provinces"))


@query
def province_distribution(spark, sf_dir):
    return profile.shares(kept_norm(spark, sf_dir).filter("province is not null"), "province")


@query
def dimension_profile(spark, sf_dir):
    return profile.dimensions(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"])


@query
def dimension_values(spark, sf_dir):
    return profile.dimension_values(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"])


@query
def label_buckets(spark, sf_dir):
    return landing(spark, sf_dir).select("employees").distinct().select("employees", profile.label_bucket(F.col("employees")).alias("bucket"))


@query
def coverage_matrix(spark, sf_dir):
    regions = spark.createDataFrame([(p,) for p in t.PROVINCES], "province string")
    return profile.coverage(kept_norm(spark, sf_dir), regions, "province")


@query
def field_matrix(spark, sf_dir):
    return profile.field_matrix(landing(spark, sf_dir), "source_key", ["trade_name", "street", "phone", "corp_number", "naics"])


# --- extraction ----------------------------------------------------------------------------------
@query
def resource_pick(spark, sf_dir):
    """Package answers made of the parts: the first CSV whose name holds the keyword, in any case."""
    one = lambda name, form, url: F.struct(name.alias("name"), F.lit(form).alias("format"), url.alias("url"))
    k, name = F.col("p_partkey"), F.col("p_name")
    link = lambda n: F.concat(F.lit(f"https://data.example.ca/{n}/"), k.cast("string"))
    listed_ = F.array(one(F.lit("Readme"), "csv", link(1)), one(F.concat(F.lit("List of "), name), "XLSX", link(2)), one(F.concat(F.lit("List "), F.upper(name)), "csv", F.when(k % 2 == 0, "").otherwise(link(3))), one(F.when(k % 3 == 0, name), "CSV", link(4)))
    answers_ = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.to_json(F.struct(F.struct(listed_.alias("resources")).alias("result"))).alias("json"))
    return readers.picked_resource(answers_, F.col("p_name")).select("p_partkey", "url")


@query
def page_mailto(spark, sf_dir):
    html = F.concat("html", F.lit('<a href="MAILTO:Info@'), "page_id", F.lit('.example.com">x</a><a href="mailto:a.b@c.example.ca?subject=x">y</a>'))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(extract.mailto(html), "|").alias("emails"))


@query
def page_phones(spark, sf_dir):
    html = F.concat("html", F.lit(" <p>(416) 555-"), F.lpad((F.col("page_id") % 10000).cast("string"), 4, "0"), F.lit(" or +1 604.555.0199, 1234567890123</p>"))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(extract.phones(html), "|").alias("phones"))


@query
def page_persons(spark, sf_dir):
    html = F.concat("html", F.lit("<p>Jane Smith, President of us. Privacy Terms - Manager</p>"))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(F.transform(extract.persons(html), lambda p: F.concat_ws(":", p["name"], p["role"])), "|").alias("persons"))


@query
def page_json_ld(spark, sf_dir):
    block = F.concat(F.lit('<script type="application/ld+json">{"@type":"Organization","email":"org@'), "page_id", F.lit('.example.com","founder":[{"@type":"Person","name":"Ann Lee","jobTitle":"CEO"}]}</script>'))
    html = F.concat("html", block)
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(extract.ld_emails(html), "|").alias("emails"), F.array_join(extract.ld_persons(html), "|").alias("persons"))


@query
def page_emails(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(extract.page_emails(F.col("html")), "|").alias("emails"))


PROBED = '<a class="t" href="tel: 1-604-555-0100 ">call</a><a href="TEL:x">y</a> or (604) 555 0199, 123456045550199, +1.604.555.0123<script type="application/ld+json">{"telephone":"555","name":"Ann Co"}</script>'


@query
def page_contacts(spark, sf_dir):
    found = extract.page_contacts(F.concat("html", F.lit(PROBED)), F.when(F.col("page_id") % 3 == 0, F.concat("url", F.lit("/About"))).otherwise(F.col("url")))
    rows = table(spark, sf_dir, "pages").select("page_id", found.alias("c"))
    return rows.select("page_id", *(F.array_join(f"c.{x}", "|").alias(x) for x in ("phones", "emails", "sentences")), "c.name", "c.leader_page")


@query
def page_leadership(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(extract.leadership(F.concat("html", F.lit("<p>Our president is here. No.</p>"))), "|").alias("sentences"))


@query
def page_link_domains(spark, sf_dir):
    link = F.concat(F.lit('<a class="r" href="/l/?uddg=https%3A%2F%2Fwww.shop'), F.col("page_id") % 9, F.lit('.example.ca%2Fx&amp;rut=1">a</a><a href="https://www.facebook.com/x">b</a><a href="'), "url", F.lit('">c</a>'))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(extract.link_domains(F.concat("html", link), t.EXCLUDED_DOMAINS), "|").alias("domains"))


@query
def domain_verification(spark, sf_dir):
    name = F.concat_ws(" ", F.lit("The"), F.substring("html", 200, 12), F.lit("article"), F.lit("Inc"))
    return table(spark, sf_dir, "pages").select("page_id", extract.verify_domain(extract.page_text(F.col("html")), name, F.lit("nowhere"), F.lit("the")).alias("verdict"))
