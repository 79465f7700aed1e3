"""The normalised record: all field normalisers in one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions import normalise as n

#: Raw fields; those of ``LATER`` are read where a table has them.
LATER = ("incorporation_date",)
RAW = ("legal_name", "trade_name", "street", "city", "province", "postal_code", "phone", "email", "website", "status", "employees", "naics", "issued_date", *LATER)


def from_payload(df: DataFrame, payload: str = "raw_payload", source: str = "source_key", compat: bool = False) -> DataFrame:
    """Raw fields and identifiers from a payload map by their aliases, and what no field reads as ``extra``; permits have defaults.

    Identifiers: corp_number, bn, external_id (of the one source that has it), and record_id, which is source and id in it
    unless the rows have one. What ``extra`` holds stays there when it is read as an identifier. ``compat``: see ``normalise.field``.
    """
    keys = F.map_from_entries(F.transform(F.map_entries(payload), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value"))))
    permits = F.col(source) == n.t.PERMITS
    p = F.when(permits, keys).otherwise(F.col(payload))
    fields = {c: n.field(p, c, compat) for c in n.t.ALIASES}
    fields["city"] = F.coalesce(fields["city"], F.when(permits, "Québec"))
    fields["province"] = F.coalesce(fields["province"], F.when(permits, "QC"))
    of = lambda keys: n.first_nonempty(*(p[k] for k in keys))
    ids = {"corp_number": of(n.t.CORP_NUMBER_KEYS[:2] if compat else n.t.CORP_NUMBER_KEYS), "bn": of(n.t.BN_KEYS), "external_id": F.when(F.col(source) == n.t.EXTERNAL_ID_SOURCE, of(n.t.EXTERNAL_ID_KEYS))}
    if "record_id" not in df.columns and "source_record_id" in df.columns:
        ids["record_id"] = F.concat_ws(":", source, "source_record_id")
    return df.select("*", *(v.alias(k) for k, v in (fields | ids).items()), n.extra(p, F.col(source), compat).alias("extra"))


def normalised(df: DataFrame) -> DataFrame:
    """``df`` with its raw fields as raw_*, and the normalised ones under their names. One projection, no shuffle."""
    later = [c for c in LATER if c in df.columns]
    raw = df.select(*(F.col(c).alias(f"raw_{c}" if c in RAW else c) for c in df.columns))
    address = n.address(F.col("raw_street"), F.col("raw_city"), F.col("raw_province"), F.col("raw_postal_code"))
    rows = raw.select(
        "*", n.name(F.col("raw_legal_name")).alias("legal_name"), n.name(F.col("raw_trade_name")).alias("trade_name"), address.alias("_a"), n.phone(F.col("raw_phone")).alias("_p"), n.email(F.col("raw_email")).alias("_m"),
        n.domain(F.col("raw_website")).alias("_w"), n.status(F.col("raw_status"), F.col("source_key")).alias("status"), n.employee(F.col("raw_employees")).alias("_e"), n.naics(F.col("raw_naics")).alias("_n"), n.date(F.col("raw_issued_date")).alias("issued_date"),
        *(n.date(F.col(f"raw_{c}")).alias(c) for c in later),
    )
    return rows.select(
        *raw.columns, "legal_name", "trade_name", "_a.normalised_address", "_a.raw_address", "_a.address_line1", "_a.address_line2", "_a.city", "_a.province", "_a.postal_code", "_a.postal_valid",
        F.col("_p.e164").alias("phone"), F.col("_p.valid").alias("phone_valid"), F.col("_m.email").alias("email"), F.col("_m.valid").alias("email_valid"), F.col("_w.domain").alias("domain"), F.col("_w.valid").alias("domain_valid"),
        "status", F.col("_e.low").alias("employee_min"), F.col("_e.high").alias("employee_max"), F.col("_e.bucket").alias("employee_bucket"), F.col("_e.exact").alias("employee_exact"), F.col("_e.flag").alias("employee_flag"),
        F.col("_n.source").alias("naics"), F.col("_n.sector").alias("naics_sector"), "issued_date", *later,
    )
