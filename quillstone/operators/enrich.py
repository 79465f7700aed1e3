"""What lookups and crawled pages add to resolved entities, and which entities are due for a lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions import normalise as n
from quillstone.operators.extract import all_of

# --- fixed values: enrichment --------------------------------------------------------------------
REGISTER = "bc_orgbook"
REGISTER_FIELDS = ("legal_name", "status", "registration_date", "entity_type")
ATTEMPTED = "enrichment_attempted"
WEBSITE_PHONE = r"(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]\d{3}[-.\s]\d{4}"


def new_directors(looked_up: DataFrame, identifiers: DataFrame, people: DataFrame) -> DataFrame:
    """(entity_id, person_name, role_type, confidence) of looked-up directors that ``people`` lacks, each once.

    ``looked_up``: corp_number, director_name; ``identifiers``: entity_id, id_type, id_value; ``people``: entity_id, person_name,
    role_type. Blank names, and numbers that no entity has, add nothing.
    """
    known = identifiers.filter("id_type = 'CORP_NUMBER'").select("entity_id", F.col("id_value").alias("corp_number"))
    named = looked_up.select("corp_number", n.blank_to_null(n.stripped(F.col("director_name"))).alias("person_name")).filter("person_name is not null").distinct()
    found = named.join(known, "corp_number").select("entity_id", "person_name").distinct()
    return found.join(people.filter("role_type = 'DIRECTOR'"), ["entity_id", "person_name"], "left_anti").select("*", F.lit("DIRECTOR").alias("role_type"), F.lit("HIGH").alias("confidence"))


def _first(found: DataFrame) -> DataFrame:
    """Of each entity's answers, the one at the smallest position."""
    fields = F.struct(*REGISTER_FIELDS)
    return found.groupBy("entity_id").agg(F.min_by(fields, F.struct("position", fields)).alias("r")).select("entity_id", "r.*")


def register_observations(found: DataFrame) -> DataFrame:
    """(entity_id, field, value, enrichment_source, confidence): an observation for each field that the first answer fills.

    ``found``: entity_id, position and the register's fields as strings.
    """
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), n.blank_to_null(n.stripped(F.col(c))).alias("value")) for c in REGISTER_FIELDS))
    rows = _first(found).select("entity_id", F.inline(F.filter(pairs, lambda p: p["value"].isNotNull())))
    return rows.select("*", F.lit(REGISTER).alias("enrichment_source"), F.lit("MEDIUM").alias("confidence"))


def register_updates(entities: DataFrame, found: DataFrame, as_of) -> DataFrame:
    """``entities`` with the status of the first answer, verified at ``as_of``; those without one stay as they are."""
    told = _first(found).select("entity_id", n.blank_to_null(n.stripped(F.col("status"))).alias("_told"))
    has = F.col("_told").isNotNull()
    new = {"status": F.coalesce("_told", "status"), "last_verified_at": F.when(has, as_of).otherwise(F.col("last_verified_at"))}
    return entities.join(told, "entity_id", "left").select(*(new[c].alias(c) if c in new else F.col(c) for c in entities.columns))


def website_phones(pages: DataFrame, contacts: DataFrame) -> DataFrame:
    """(entity_id, kind, raw_value, value, confidence) of valid numbers on an entity's pages that ``contacts`` lacks, each once.

    ``pages``: entity_id, html; ``contacts``: entity_id, kind, value. Of several spellings the smallest is kept.
    """
    raw = pages.select("entity_id", F.explode(F.array_distinct(all_of(F.col("html"), WEBSITE_PHONE, 0))).alias("raw_value"))
    good = raw.withColumn("value", n.phone(F.col("raw_value"))["e164"]).filter("value is not null")
    once = good.groupBy("entity_id", "value").agg(F.min("raw_value").alias("raw_value"))
    new = once.join(contacts.filter("kind = 'PHONE'"), ["entity_id", "value"], "left_anti")
    return new.select("entity_id", F.lit("PHONE").alias("kind"), "raw_value", "value", F.lit("LOW").alias("confidence"))


def directors_due(events: DataFrame, identifiers: DataFrame, most: int = 50) -> DataFrame:
    """The next ``most`` incorporations, by event, whose directors nobody looked up yet: event_id, entity_id, corp_number."""
    due = events.filter(F.col("event_type").eqNullSafe("FEDERAL_INCORPORATION") & ~F.col("raw_value").eqNullSafe(ATTEMPTED))
    known = identifiers.filter("id_type = 'CORP_NUMBER'").select("entity_id", F.col("id_value").alias("corp_number"))
    return due.join(known, "entity_id").select("event_id", "entity_id", "corp_number").orderBy("event_id", "corp_number").limit(most)


def mark_attempted(events: DataFrame, attempted: DataFrame) -> DataFrame:
    """``events``, those in ``attempted`` marked so that they are not due again."""
    tried = attempted.select("event_id", F.lit(ATTEMPTED).alias("_tried")).distinct()
    return events.join(tried, "event_id", "left").select(*(F.coalesce("_tried", "raw_value").alias(c) if c == "raw_value" else F.col(c) for c in events.columns))


def registers_due(entities: DataFrame, identifiers: DataFrame, observations: DataFrame, most: int = 25) -> DataFrame:
    """The next ``most`` British Columbian entities, by id, whose name no register confirmed yet: entity_id, business_name, bc_reg_id."""
    done = observations.filter(F.expr("field = 'legal_name' and is_current") & (F.col("enrichment_source") == REGISTER)).select("entity_id")
    known = identifiers.filter("id_type = 'BC_REG_ID'").select("entity_id", F.col("id_value").alias("bc_reg_id"))
    rows = entities.filter("province = 'BC'").join(known, "entity_id", "left").join(done, "entity_id", "left_anti")
    rows = rows.filter("bc_reg_id is not null or canonical_name is not null")
    return rows.select("entity_id", F.col("canonical_name").alias("business_name"), "bc_reg_id").orderBy("entity_id", "bc_reg_id").limit(most)
