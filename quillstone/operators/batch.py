"""Resolution of a batch whose records may belong together before any entity exists.

Records that share a strong identifier (corporation number, business number, licence id within its source) are one business, as
are those linked over others: the connected components of the records and the identifiers they hold. The least record of a
component by (source, source record id), among those with an identity, is its seed and makes its entity; the others match it. A component one
of whose records matches a known entity belongs to that. Seeds are matched by weaker keys, and then by name, against the known entities
and against earlier seeds only, so that the answer does not depend on the order in which rows come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.operators import resolve
from quillstone.operators.store import Tables

KEY = ("kind", "a", "b")


def place(columns: list[str]) -> Column:
    """What orders the records of a batch: those with an identity first, then source and id."""
    own = "source_record_id" if "source_record_id" in columns else "record_id"
    return F.struct((~resolve.has_identity(columns)).alias("nameless"), F.col("source_key").alias("source"), F.col(own).alias("id"), F.col("record_id").alias("record"))


def components(members: DataFrame, tables: Tables) -> DataFrame:
    """(record_id, seed): the least place among all records that a record of ``members`` (record_id, place, and a key) reaches over shared keys.

    Every round takes the least place of each key's records to the key and back, then that record's own least place, which doubles the
    reach; it ends when no place changes. Both ways are aggregates that combine before their shuffle, so a common key is no task's load.
    """
    edges = tables.put("edges", members.select("record_id", *KEY).distinct())
    now = tables.put("places", members.groupBy("record_id").agg(F.min("place").alias("seed")))
    while True:
        least = edges.join(now, "record_id").groupBy(*KEY).agg(F.min("seed").alias("seed"))
        back = edges.join(least, list(KEY)).groupBy("record_id").agg(F.min("seed").alias("seed"))
        further = now.select(F.col("record_id").alias("_r"), F.col("seed").alias("_further"))
        onward = back.join(further, F.col("seed.record") == F.col("_r"), "left").select("record_id", F.least("seed", F.coalesce("_further", "seed")).alias("seed"))
        before = now.select("record_id", F.col("seed").alias("_before"))
        moved = onward.join(before, "record_id").select("record_id", "seed", (F.col("seed") != F.col("_before")).alias("moved"))
        now = tables.put("places", moved)
        done = now.filter("moved").isEmpty()
        now = now.drop("moved")
        if done:
            return now


def seeds(records: DataFrame, tables: Tables) -> DataFrame:
    """(record_id, seed) of every record: the place of its component's first record, which is its own where it shares no identifier."""
    placed = records.select("record_id", place(records.columns).alias("place"))
    keys = resolve.match_keys(records, "record_id", (0,)).select("record_id", *KEY)
    shared = keys.groupBy(*KEY).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    linked = components(tables.put("members", keys.join(shared, list(KEY)).join(placed, "record_id")), tables)
    return tables.put("seeds", placed.join(linked, "record_id", "left").select("record_id", "place", F.coalesce("seed", "place").alias("seed")))


def _entity(record: Column) -> Column:
    return F.concat(F.lit("entity:"), record)


def _weaker(free: DataFrame, entities: DataFrame) -> DataFrame:
    """(record_id, entity_id, rule, confidence, score) by the medium keys: the first step, its strongest key; known entities before earlier seeds, then the least."""
    steps = (1, 2, 3)
    known = resolve.match_keys(entities, "entity_id", steps).select(*KEY, "entity_id", F.lit(None).cast(free.schema["place"].dataType).alias("place"))
    keys = resolve.match_keys(free, "record_id", steps).join(free.select("record_id", "place"), "record_id")
    every = known.unionByName(keys.select(*KEY, F.lit(None).cast("string").alias("entity_id"), "place"))
    first = every.groupBy(*KEY).agg(F.min("entity_id").alias("known"), F.min("place").alias("earliest"))
    met = keys.join(first, list(KEY)).filter(F.col("known").isNotNull() | (F.col("earliest") < F.col("place")))
    rank = F.struct("step", "priority", F.col("known").isNull().alias("new"), "known", F.when(F.col("known").isNull(), F.col("earliest")).alias("earliest"))
    best = met.groupBy("record_id").agg(F.min(rank).alias("m"))
    of = lambda i: F.element_at(F.array(*(F.lit(r[i]) for r in resolve.RULES)), F.col("m.step") + 1)
    return best.select("record_id", F.coalesce("m.known", _entity(F.col("m.earliest.record"))).alias("entity_id"), of(0).alias("rule"), of(1).alias("confidence"), of(2).alias("score"))


def resolve_batch(records: DataFrame, entities: DataFrame, fuzzy: bool = True, threshold: int = resolve.THRESHOLD) -> DataFrame:
    """One row per record: outcome, rule, confidence, score, the entity it matched or is a candidate for, and ``seed``, the record whose entity it made or joined.

    Strong identifiers decide first: a record's own match among ``entities``, then the least match in its component, then its seed. Seeds that nothing
    matched are compared by the medium keys and by name (``fuzzy``) with known entities and earlier seeds, and make an entity of their own in any case.
    Components without an identity stay unresolved. ``records`` are of one batch, with distinct record ids; ``seed`` is null where the known entity decides or nothing does.
    """
    tables = Tables(records.sparkSession, "batch")
    placed = seeds(records, tables)
    direct = tables.put("direct", resolve.match_exact(records, entities).select("record_id", F.col("entity_id").alias("own")))
    anchors = placed.join(direct, "record_id").groupBy("seed").agg(F.min("own").alias("anchor"))
    rows = placed.join(direct, "record_id", "left").join(anchors, "seed", "left").withColumn("entity", F.coalesce("own", "anchor"))
    rows = tables.put("strong", rows.select("record_id", "place", "seed", "entity"))
    free = rows.filter(F.col("entity").isNull() & (F.col("seed") == F.col("place")) & ~F.col("place.nameless")).select("record_id", "place")
    free = tables.put("free", records.join(free, "record_id"))
    answers = tables.put("weaker", _weaker(free, entities))
    if fuzzy:
        left = free.join(answers.select("record_id"), "record_id", "left_anti")
        names = ("legal_name", "trade_name", "canonical_name")
        of = lambda df, entity, at: df.select(entity.alias("entity_id"), *((F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in names), "postal_code", at.alias("place"))
        never = F.lit(None).cast(free.schema["place"].dataType)
        pool = of(entities, F.col("entity_id"), never).unionByName(of(free, _entity(F.col("record_id")), F.col("place")))
        answers = answers.unionByName(tables.put("near", resolve.match_fuzzy(left.select("record_id", *names[:2], "postal_code", "place"), pool, threshold)))
    rows = rows.join(answers, "record_id", "left")
    strong = F.col("entity").isNotNull() | ((F.col("seed") != F.col("place")) & ~F.col("seed.nameless"))
    made = F.create_map(*[F.lit(x) for kv in resolve.OUTCOME.items() for x in kv])
    outcome = F.when(strong, "MATCHED").when(F.col("place.nameless"), "UNRESOLVED").otherwise(F.coalesce(made[F.col("confidence")], F.lit("NEW")))
    rule, confidence, score = resolve.RULES[0]
    matched = F.coalesce("entity", F.when(strong, _entity(F.col("seed.record"))), "entity_id")
    return rows.select(
        "record_id", outcome.alias("outcome"), F.when(strong, rule).otherwise(F.col("rule")).alias("rule"), F.when(strong, confidence).otherwise(F.col("confidence")).alias("confidence"),
        F.when(strong, F.lit(score)).otherwise(F.col("score")).alias("score"), matched.alias("matched_entity"), F.when(F.col("entity").isNull() & ~F.col("seed.nameless"), F.col("seed.record")).alias("seed"),
    )
