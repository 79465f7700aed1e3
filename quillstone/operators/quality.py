"""Completeness scores and readiness of entities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions import tables as t


def _if(test: Column, points: int) -> Column:
    return F.when(test, points).otherwise(0)


def _has(c: str) -> Column:
    return F.coalesce(F.col(c) != "", F.lit(False))


def contact_score(present: Column, valid: Column) -> Column:
    """Reliability is not known per contact, so its share is always that of an unknown class."""
    return F.when(present, F.least(F.lit(100), 40 + _if(F.coalesce(valid, F.lit(False)), 40) + int(50 * 0.20))).otherwise(0)


def recency(last: Column, as_of: Column) -> Column:
    """By whole days of 24 hours since the last check."""
    days = F.floor((F.unix_timestamp(as_of) - F.unix_timestamp(last)) / 86400)
    out = F.when(last.isNull(), 0)
    for limit, points in t.RECENCY:
        out = out.when(days <= limit, points)
    return out.otherwise(10)


def reliability(classes: Column) -> Column:
    """The best class that contributed."""
    weights = F.create_map(*[F.lit(x) for kv in t.CLASS_WEIGHT.items() for x in kv])
    return F.coalesce(F.array_max(F.transform(classes, lambda c: F.coalesce(weights[c], F.lit(0)))), F.lit(0))


def assembled(
    entities: DataFrame, contacts: DataFrame, identifiers: DataFrame, locations: DataFrame, employees: DataFrame, industries: DataFrame, people: DataFrame, records: DataFrame, flags: DataFrame,
) -> DataFrame:
    """One row per entity with all that ``scores`` reads, from the tables of its parts.

    The address is that of the primary location, else of the smallest location_id; without a location the entity's own province stands.
    A contact is valid if any of its kind is. All parts go through one aggregation by entity: they shuffle once, reduced before.
    ``entities``: entity_id, canonical_name, legal_name, entity_type, province, status, last_verified_at; ``contacts``: kind, value, is_valid;
    ``identifiers``: kind, value; ``locations``: location_id, is_primary, address_line1, city, province, postal_code, latitude, longitude;
    ``employees``: employee_bucket, employee_exact; ``industries``: naics, naics_sector; ``people``: role_type; ``records``: source_class; ``flags``: flag_type.
    """
    of = lambda kind, c: F.when(F.col("kind") == kind, F.col(c))
    exact = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    place = F.struct((~F.coalesce("is_primary", F.lit(False))).alias("rank"), "location_id", "address_line1", "city", "province", "postal_code", exact.alias("exact"))
    parts = [
        contacts.select("entity_id", *(of(k, "value").alias(c) for k, c in (("PHONE", "phone"), ("EMAIL", "email"), ("WEBSITE", "domain"))), of("PHONE", "is_valid").alias("phone_valid"), of("EMAIL", "is_valid").alias("email_valid")),
        identifiers.select("entity_id", of("CORP_NUMBER", "value").alias("corp_number"), of("BN", "value").alias("bn")), locations.select("entity_id", place.alias("place")),
        employees.select("entity_id", F.coalesce("employee_bucket", F.lit("")).alias("employee_bucket"), "employee_exact"), industries.select("entity_id", "naics", "naics_sector"),
        people.select("entity_id", "role_type"), records.select("entity_id", "source_class"), flags.select("entity_id", "flag_type"),
    ]
    facts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).groupBy("entity_id").agg(
        *(F.max(c).alias(c) for c in ("phone", "email", "domain", "phone_valid", "email_valid", "corp_number", "bn", "employee_bucket", "employee_exact", "naics", "naics_sector")), F.min("place").alias("place"),
        F.count_if(F.col("role_type") == "DIRECTOR").cast("int").alias("directors"), F.count_if(F.col("role_type").isin(*t.PRIMARY_ROLES)).alias("n_primary"),
        F.collect_set("source_class").alias("source_classes"), F.count_if(F.col("flag_type") == "DNC").alias("n_dnc"),
    )
    rows = entities.withColumnRenamed("province", "own_province").join(facts, "entity_id", "left")
    none = F.array().cast("array<string>")
    return rows.select(
        "entity_id", "canonical_name", "legal_name", "entity_type", "corp_number", "bn", "place.address_line1", "place.city", F.when(F.col("place").isNull(), F.col("own_province")).otherwise(F.col("place.province")).alias("province"), "place.postal_code",
        F.coalesce("place.exact", F.lit(False)).alias("has_coordinates"), "phone", "phone_valid", "email", "email_valid", "domain", "employee_bucket", "employee_exact", "naics", "naics_sector", F.coalesce("directors", F.lit(0)).alias("directors"),
        F.coalesce(F.col("n_primary") > 0, F.lit(False)).alias("has_primary_contact"), "last_verified_at", F.coalesce("source_classes", none).alias("source_classes"), "status", F.coalesce(F.col("n_dnc") > 0, F.lit(False)).alias("dnc"),
    )


def upserted(known: DataFrame, scored: DataFrame) -> DataFrame:
    """The stored scores, those of newly scored entities replaced or added."""
    return known.join(scored.select("entity_id"), "entity_id", "left_anti").unionByName(scored)


def scores(entities: DataFrame, as_of: Column) -> DataFrame:
    """All component scores, the composite and sales readiness.

    ``entities``: entity_id, canonical_name, legal_name, entity_type, corp_number, bn, address_line1, city, province,
    postal_code, has_coordinates, phone, phone_valid, email, email_valid, domain, employee_bucket, employee_exact, naics,
    naics_sector, directors, has_primary_contact, last_verified_at, source_classes, status, dnc.
    """
    rows = entities.select(
        "entity_id", "status", "dnc", "canonical_name", "address_line1", "province", "phone", "email", "domain", "directors",
        F.least(F.lit(100), _if(_has("canonical_name"), 40) + _if(_has("legal_name"), 20) + _if(_has("entity_type"), 10) + F.when(_has("corp_number"), 20).when(_has("bn"), 10).otherwise(0)).alias("identity"),
        F.least(F.lit(100), _if(_has("address_line1"), 30) + _if(_has("city"), 20) + _if(_has("province"), 20) + _if(_has("postal_code"), 15) + _if(F.col("has_coordinates"), 5)).alias("address"),
        contact_score(_has("phone"), F.col("phone_valid")).alias("phone_score"), contact_score(_has("email"), F.col("email_valid")).alias("email_score"),
        F.when(F.col("employee_bucket").isNull(), 0).when(F.col("employee_exact"), 100).otherwise(60).alias("employee"),
        F.when(_has("naics"), 100).when(_has("naics_sector"), 60).otherwise(0).alias("industry"),
        F.when(F.col("directors") > 0, F.least(F.lit(100), 60 + 10 * F.col("directors"))).when(F.col("has_primary_contact"), 40).otherwise(0).cast("int").alias("contact"),
        recency(F.col("last_verified_at"), as_of).alias("recency"), reliability(F.col("source_classes")).alias("source_reliability"),
    )
    part = {"phone": "phone_score", "email": "email_score"}
    weighted = reduce(lambda a, b: a + b, (F.col(part.get(k, k)) * F.lit(w) for k, w in t.COMPOSITE.items()))
    rel = F.when(F.col("source_reliability") == 0, 50).otherwise(F.col("source_reliability"))
    composite = F.least(F.lit(100), F.bround(weighted * (0.70 + rel / 100 * 0.30), 0).cast("int"))
    return rows.select(
        "entity_id", "identity", "address", "phone_score", "email_score", "employee", "industry", "contact", "recency", "source_reliability", composite.alias("composite"),
        (sales_ready() & ~F.col("dnc")).alias("sales_ready"),
    )


def sales_ready() -> Column:
    reach = _has("phone") | _has("email") | _has("domain") | (F.col("directors") > 0)
    return _has("canonical_name") & _has("address_line1") & _has("province") & F.coalesce(F.upper("status") == "ACTIVE", F.lit(False)) & reach


def badge(score: Column) -> Column:
    return F.when(score >= 70, "good").when(score >= 40, "fair").otherwise("poor")
