"""Entity resolution as a cascade: exact identifiers, field pairs, names within postal blocks.

A record's answer is that of the first step that has one. The steps on equal keys are one join: every
record and entity is exploded into the keys it can meet by, each with the number of its step, and an
aggregate takes the least step of a record. Only what is left is compared by similarity. A key's
entities are reduced to one before the join, so no common key multiplies rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions import tables as t
from quillstone.functions.normalise import blank_to_null, let
from quillstone.operators import history
from quillstone.operators.nearest_names import lcs, tile
from quillstone.operators.store import Tables

THRESHOLD = 88
#: The steps on equal keys, in their order: rule, confidence, score.
RULES = (("EXACT_IDENTIFIER", "HIGH", 100.0), ("DOMAIN_POSTAL", "MEDIUM", 90.0), ("PHONE_POSTAL", "MEDIUM", 85.0), ("NAME_ADDRESS", "MEDIUM", 80.0))


def match_keys(df: DataFrame, id_col: str, steps: tuple[int, ...]) -> DataFrame:
    """(id_col, step, priority, kind, a, b): all keys by which a row can be matched.

    Licence ids hold within their source: the ids that the source gives, where the rows have them, else that of the row.
    """
    def one(step: int, priority: int, kind: str, a: Column, b: Column) -> Column:
        return F.struct(F.lit(step).alias("step"), F.lit(priority).alias("priority"), F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"))

    none = F.lit("")
    licences = [c for c in ("external_id", "source_record_id") if c in df.columns] or [id_col]
    keys = {
        0: [one(0, 1, "CORP_NUMBER", blank_to_null(F.trim("corp_number")), none), one(0, 2, "BN", blank_to_null(F.trim("bn")), none), *(one(0, i, "LICENCE_ID", blank_to_null(F.trim(c)), F.col("source_key")) for i, c in enumerate(licences, 3))],
        1: [one(1, 1, "DOMAIN", F.col("domain"), F.col("postal_code"))],
        2: [one(2, 1, "PHONE", F.col("phone"), F.col("postal_code"))],
        3: [one(3, 1, "NAME", F.col(c), F.col("normalised_address")) for c in ("legal_name", "trade_name")],
    }
    whole = F.filter(F.array(*(k for s in steps for k in keys[s])), lambda x: x["a"].isNotNull() & x["b"].isNotNull())
    return df.select(id_col, F.inline(whole))


def match(records: DataFrame, entities: DataFrame, steps: tuple[int, ...] = (0, 1, 2, 3)) -> DataFrame:
    """(record_id, entity_id, rule, confidence, score) of the records that equal keys match: the first step, its strongest key, the smallest entity."""
    known = match_keys(entities, "entity_id", steps).groupBy("kind", "a", "b").agg(F.min("entity_id").alias("entity_id"))
    met = match_keys(records, "record_id", steps).join(known, ["kind", "a", "b"])
    best = met.groupBy("record_id").agg(F.min(F.struct("step", "priority", "entity_id")).alias("m"))
    of = lambda i: F.element_at(F.array(*(F.lit(r[i]) for r in RULES)), F.col("m.step") + 1)
    return best.select("record_id", F.col("m.entity_id").alias("entity_id"), of(0).alias("rule"), of(1).alias("confidence"), of(2).alias("score"))


def match_exact(records: DataFrame, entities: DataFrame) -> DataFrame:
    return match(records, entities, (0,))


def match_domain_postal(records: DataFrame, entities: DataFrame) -> DataFrame:
    return match(records, entities, (1,))


def match_phone_postal(records: DataFrame, entities: DataFrame) -> DataFrame:
    return match(records, entities, (2,))


def match_name_address(records: DataFrame, entities: DataFrame) -> DataFrame:
    """A name of the record among the names of the entity, and the same normalised address."""
    return match(records, entities, (3,))


def words_of(c: Column) -> Column:
    return F.array_remove(F.split(c, r"\s+"), "")


def key_of(*words: Column) -> Column:
    """The words of all arrays, sorted and joined."""
    return F.array_join(F.sort_array(F.concat(*words)), " ")


def ratio(a: Column, b: Column) -> Column:
    """100 * (1 - indel distance / total length) of two strings; Arrow batches, and only for pairs that passed the bound."""
    @F.pandas_udf("double")
    def score(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in pairs:
            yield pd.Series([200.0 * lcs(p, q) / (len(p) + len(q)) if p or q else 100.0 for p, q in zip(x, y, strict=True)], dtype="float64")

    # So called, it is not copied into a filter on its result.
    return score.asNondeterministic()(a, b)


#: Letters of the grams that names are looked up by; each name takes the size that leads to the fewest others.
GRAMS = (2, 3, 4)
#: Scores that ``match_fuzzy`` looks for first: pairs that cannot reach one are not scored before those that can.
RUNGS = (98, 96, 94, 92, 90)
#: Names of a block, on each side, that one task compares; larger blocks go out in pairs of tiles.
TILE = 8192


def grams(words: Column, size: int) -> Column:
    """All grams of a size within the words, each with its number among the equal ones, so that they form a set."""
    of = lambda w: F.when(F.length(w) >= size, F.transform(F.sequence(F.lit(1), F.length(w) - (size - 1)), lambda i: F.substring(w, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))
    numbered = lambda g: F.transform(g, lambda x, i: F.concat(F.lit(f"{size}:"), x, (i + 2 - F.array_position(g, x)).cast("string")))
    return let(F.array_sort(F.flatten(F.transform(words, of))), numbered)


def _looked_up(words: Column, whole: Column, share: float) -> Column:
    """For each size of grams a name's, and how many of them the changes that a score allows can take, of a text of ``whole`` letters.

    A deleted letter takes part in ``size`` grams at most, an inserted one in one fewer. Of lengths that differ, all changes are of one kind at the extremes.
    """
    def of(size: int) -> Column:
        can = F.greatest(whole * (2 * size * share / (1 + share)), whole * (2 * (size - 1) * share / (1 - share)))
        return F.struct(F.lit(size).alias("size"), grams(words, size).alias("grams"), F.floor(can + 1e-6).cast("int").alias("can"))

    return F.array(*map(of, GRAMS))


def names_to_compare(df: DataFrame, id_col: str, wanted: tuple[str, ...]) -> DataFrame:
    """Block (first three characters of the postal code), words, length and code of each row's name, and its place if it has one; rows without a code left out."""
    names = [F.col(c) for c in wanted if c in df.columns]
    words = words_of(F.lower(F.coalesce(*names, F.lit(""))))
    own = [c for c in ("place",) if c in df.columns]
    rows = df.filter(F.col("postal_code").isNotNull()).select(id_col, F.upper(F.substring("postal_code", 1, 3)).alias("fsa"), words.alias("words"), words_of(F.upper("postal_code")).alias("code"), F.coalesce(*names).isNotNull().alias("named"), *own)
    return rows.select("*", F.length(F.array_join("words", " ")).alias("length"), (F.length(F.array_join("code", " ")) + 1).alias("tail"))


def gram_pairs(records: DataFrame, entities: DataFrame, threshold: int) -> DataFrame:
    """(record_id, entity_id) of all pairs whose score can reach ``threshold``, and few others; of ``names_to_compare``.

    The score allows an indel distance of ``(100 - threshold)`` percent of both lengths. A name whose changes cannot take all its grams of a size
    shares one of its rarest with every name near enough: one more of them than can be taken. Rare are those that few
    of the block's entities hold, and of the sizes that serve a record takes the one whose rarest grams are held least often. Postal codes are the same on both
    sides and take no part. Names of so few grams that all can be taken meet the names of their block that are about as long.
    """
    share = (100 - threshold) / 100
    whole = F.col("length") + F.col("tail")
    own = ("record_id", "fsa", "l", "tail")
    a = records.select("record_id", "fsa", "length", "tail", whole.alias("l"), _looked_up(F.col("words"), whole, share).alias("sizes"))
    serves = lambda s: F.size(s["grams"]) > s["can"]
    asked = a.select(*own, F.inline(F.filter("sizes", serves))).select(*own, "size", "can", F.explode("grams").alias("gram"))
    held = entities.select("entity_id", "fsa", F.col("length").alias("name"), F.explode(F.concat(*(grams(F.col("words"), s) for s in GRAMS))).alias("gram"))
    # Only grams that a record asks for are counted.
    often = held.join(asked.select("fsa", "gram").distinct(), ["fsa", "gram"], "left_semi").groupBy("fsa", "gram").agg(F.count("*").alias("n"))
    met = asked.join(often, ["fsa", "gram"], "left")
    first = met.groupBy(*own, "size", "can").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0).cast("long")).alias("n"), "gram"))).alias("g"))  # of one name
    rarest = first.select(*own, "size", F.slice("g", F.lit(1), F.col("can") + 1).alias("g"))
    cost = F.aggregate("g", F.lit(0).cast("long"), lambda t, x: t + x["n"])
    least = rarest.groupBy(*own).agg(F.min_by("g", F.struct(cost, "size")).alias("g"))
    x = least.select(*own, F.explode(F.filter("g", lambda y: y["n"] > 0)).alias("y")).select(*own, "y.gram")
    near = lambda rows: rows.filter(F.abs(F.col("l") - F.col("name") - F.col("tail")) <= share * (F.col("l") + F.col("name") + F.col("tail")) + 1e-6).select("record_id", "entity_id")
    low = F.ceil((F.col("length") * (1 - share) - 2 * share * F.col("tail")) / (1 + share) - 1e-6)
    high = F.floor((F.col("length") * (1 + share) + 2 * share * F.col("tail")) / (1 - share) + 1e-6)
    short = a.filter(~F.exists("sizes", serves)).select(*own, F.explode(F.sequence(F.greatest(low, F.lit(0)).cast("int"), high.cast("int"))).alias("name"))
    return near(held.join(x, ["fsa", "gram"])).unionByName(near(short.join(entities.select("entity_id", "fsa", F.col("length").alias("name")), ["fsa", "name"]))).distinct()


def fuzzy_pairs(records: DataFrame, entities: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(record_id, entity_id, score) of names that are similar enough, within a postal block (first three characters).

    Both names are compared with the record's postal code behind them, words sorted. Pairs that share a rare gram (``gram_pairs``) are compared by
    the edit distance with substitutions, which is never larger than the one that counts, and what that leaves is scored. Nothing is lost by
    either. Where both sides have a ``place``, only entities without one or of a smaller one are compared.
    """
    a = names_to_compare(records, "record_id", ("legal_name", "trade_name")).filter("named")
    b = names_to_compare(entities, "entity_id", ("legal_name", "trade_name", "canonical_name"))
    return _scored(a, b, threshold)


def _scored(a: DataFrame, b: DataFrame, threshold: int) -> DataFrame:
    share = (100 - threshold) / 100
    pairs = gram_pairs(a, b, threshold)
    own = [F.col("place").alias(c) for c in ("_after",) if "place" in a.columns]
    pairs = pairs.join(a.select("record_id", F.col("words").alias("u"), "code", *own), "record_id").join(b.select("entity_id", F.col("words").alias("v"), *(c for c in ("place",) if c in b.columns)), "entity_id")
    if own and "place" in b.columns:
        pairs = pairs.filter(F.col("place").isNull() | (F.col("place") < F.col("_after")))
    # With its bound the distance is looked for near the diagonal only; beyond it the answer is -1.
    most = lambda k: F.floor(share * (F.length(k["x"]) + F.length(k["y"])) + 1e-6).cast("int")
    close = lambda k: F.when(F.call_function("levenshtein", k["x"], k["y"], most(k)) >= 0, k)
    keys = F.struct(key_of(F.col("u"), F.col("code")).alias("x"), key_of(F.col("v"), F.col("code")).alias("y"))
    pairs = pairs.select("record_id", "entity_id", let(keys, close).alias("k")).filter("k is not null")
    return pairs.select("record_id", "entity_id", ratio(F.col("k.x"), F.col("k.y")).alias("score")).filter(F.col("score") >= threshold)


def match_fuzzy(records: DataFrame, entities: DataFrame, threshold: int = THRESHOLD, rungs: tuple[int, ...] = RUNGS, most: int = TILE) -> DataFrame:
    """The highest score of each record, ties to the smallest entity: of the pairs of ``fuzzy_pairs``, without making them.

    Both sides are dealt by their block, in pairs of tiles of about ``most`` names where it is large; a tile's task keeps the best of each record
    (``nearest_names``). What is shuffled are the names, once in blocks of up to ``most``; the bounds that a task computes grow with the square of a block.
    """
    tables = Tables(records.sparkSession, "fuzzy")
    dealt = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    join = lambda c: F.array_join(c, " ")
    never = F.lit(None).cast("boolean")
    a = names_to_compare(records, "record_id", ("legal_name", "trade_name")).filter("named")
    b = names_to_compare(entities, "entity_id", ("legal_name", "trade_name", "canonical_name"))
    both = "place" in a.columns and "place" in b.columns
    a = tables.put("a", a.select("record_id", "fsa", join("words").alias("name"), join("code").alias("code"), (F.col("place") if both else never).alias("after")))
    b = tables.put("b", b.select("entity_id", "fsa", join("words").alias("name"), (F.col("place") if both else never).alias("place")))
    tiles = lambda df, name: df.groupBy("fsa").agg(F.ceil(F.count("*") / most).cast("int").alias(name))
    blocks = tables.put("blocks", tiles(a, "of_a").join(tiles(b, "of_b"), "fsa"))
    at = ("fsa", "_a", "_b")
    own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = a.join(blocks, "fsa").select("*", own("record_id", "of_a").alias("_a"), each("of_b").alias("_b")).drop("of_a", "of_b").repartition(dealt, *at)
    right = b.join(blocks, "fsa").select("*", each("of_a").alias("_a"), own("entity_id", "of_b").alias("_b")).drop("of_a", "of_b").repartition(dealt, *at)
    cuts = [*(float(r) for r in sorted(rungs, reverse=True) if r > threshold), float(threshold)]
    schema = f"record_id {records.schema['record_id'].dataType.simpleString()}, entity_id {entities.schema['entity_id'].dataType.simpleString()}, score double"
    found = left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(tile(threshold, cuts), schema)
    # Stored, as tasks are long and those who join with it may read it more than once.
    best = tables.put("best", found.groupBy("record_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "entity_id")).alias("m")))
    return best.select("record_id", F.col("m.entity_id").alias("entity_id"), F.lit("FUZZY_NAME").alias("rule"), F.lit("LOW").alias("confidence"), F.round(-F.col("m.s"), 2).alias("score"))


def has_identity(columns: list[str]) -> Column:
    """Whether a record has a name or one of the five business ids, in a column of its own or among its ``extra`` values."""
    ids = [blank_to_null(F.trim(c)) for c in t.IDENTITY_KEYS if c in columns]
    if "extra" in columns:
        ids += [blank_to_null(F.trim(F.col("extra")[k])) for k in t.IDENTITY_KEYS]
    return F.coalesce("legal_name", "trade_name", *ids).isNotNull()


OUTCOME = {"HIGH": "MATCHED", "MEDIUM": "CANDIDATE", "LOW": "NEW"}


def resolve(records: DataFrame, entities: DataFrame, fuzzy: bool = True) -> DataFrame:
    """One row per record: outcome, rule, confidence, score, and the entity it matched or is a candidate for.

    HIGH attaches to the entity; MEDIUM and LOW make a new entity with an edge to the one found; no
    match makes a new one; a record without name or identifier stays unresolved. Records are matched
    against the given entities only, so the answer does not depend on their order. ``fuzzy``: whether
    the records that no key matches are compared by name.
    """
    wanted = ("record_id", "legal_name", "trade_name", "postal_code")
    rows = records.select(*wanted, has_identity(records.columns).alias("identity")).join(match(records, entities), "record_id", "left")
    if fuzzy:
        near = match_fuzzy(rows.filter("rule is null").select(*wanted), entities)
        answer = ("entity_id", "rule", "confidence", "score")
        rows = rows.join(near.select("record_id", F.struct(*answer).alias("near")), "record_id", "left")
        rows = rows.select("record_id", "identity", *(F.coalesce(c, f"near.{c}").alias(c) for c in answer))
    made = F.create_map(*[F.lit(x) for kv in OUTCOME.items() for x in kv])
    none = F.when(F.col("identity"), "NEW").otherwise("UNRESOLVED")
    return rows.select("record_id", F.coalesce(made[F.col("confidence")], none).alias("outcome"), "rule", "confidence", "score", F.col("entity_id").alias("matched_entity"))


def to_resolve(records: DataFrame, run: int) -> DataFrame:
    """The records of a run that resolution has still to answer: new ones, and those it could not resolve before."""
    return records.filter((F.col("run_id") == run) & F.col("resolution_status").isin("PENDING", "UNRESOLVED"))


def placed(records: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``records`` with their outcome and ``entity_id``: the entity matched, else one of their own; null where they stay unresolved.

    An own entity's id follows from the record's, so that a repeated run makes the same one.
    """
    rows = records.join(outcomes, "record_id")
    own = F.concat(F.lit("entity:"), F.col("record_id"))
    return rows.withColumn("entity_id", F.when(F.col("outcome") == "MATCHED", F.col("matched_entity")).when(F.col("outcome") != "UNRESOLVED", own))


def new_entities(rows: DataFrame) -> DataFrame:
    """The entities that ``placed`` records make: all but those matched or unresolved."""
    made = rows.filter(F.col("outcome").isin("CANDIDATE", "NEW"))
    name = F.coalesce("legal_name", "trade_name", "source_key")
    return made.select("entity_id", name.alias("canonical_name"), "legal_name", "trade_name", "province", F.coalesce("status", F.lit("UNKNOWN")).alias("status"))


def candidate_edges(rows: DataFrame) -> DataFrame:
    """(entity_id_a, entity_id_b, ...): the entity found and the one made of the record, of MEDIUM and LOW matches, for review."""
    near = rows.filter(F.col("confidence").isin("MEDIUM", "LOW"))
    return near.select(F.col("matched_entity").alias("entity_id_a"), F.col("entity_id").alias("entity_id_b"), "confidence", F.col("rule").alias("match_method"), F.col("score").alias("match_score"), F.lit(False).alias("auto_resolved"))


def record_observations(rows: DataFrame) -> DataFrame:
    """(entity_id, record_id, confidence, field, raw_value, normalised_value) of ``placed`` records, those unresolved left out."""
    return history.unpivot(rows.filter("entity_id is not null"), ("entity_id", "confidence"))


def children(records: DataFrame) -> DataFrame:
    """Identifier, location and contact rows of new entities: (record_id, child, kind, value, confidence)."""
    def one(child: str, kind: str, value: Column, confidence: Column) -> Column:
        return F.struct(F.lit(child).alias("child"), F.lit(kind).alias("kind"), value.cast("string").alias("value"), confidence.alias("confidence"))

    graded = lambda ok: F.when(ok, "HIGH").otherwise("LOW")
    all_rows = F.array(
        one("identifier", "CORP_NUMBER", blank_to_null(F.trim("corp_number")), F.lit("HIGH")), one("identifier", "BN", blank_to_null(F.trim("bn")), F.lit("HIGH")), one("identifier", "LICENCE_ID", F.col("record_id"), F.lit("HIGH")),
        one("location", "OPERATING", F.col("normalised_address"), F.lit("HIGH")), one("contact", "PHONE", F.coalesce("phone", "raw_phone"), graded(F.col("phone_valid"))),
        one("contact", "EMAIL", F.coalesce("email", "raw_email"), graded(F.col("email_valid"))), one("contact", "WEBSITE", F.col("domain"), F.lit("MEDIUM")),
    )
    keep = lambda x: x["value"].isNotNull() & ~((x["kind"] == "PHONE") & F.col("phone_valid").isNull()) & ~((x["kind"] == "EMAIL") & F.col("email_valid").isNull())
    return records.select("record_id", F.inline(F.filter(all_rows, keep)))


def size_and_industry(records: DataFrame) -> DataFrame:
    """Employee, industry and ambiguity rows of new entities: (record_id, child, raw_value, value, low, high, exact); numbers for employees only."""
    none = F.lit(None)
    def one(child: str, raw: Column, value: Column, low: Column = none, high: Column = none, exact: Column = none) -> Column:
        return F.struct(F.lit(child).alias("child"), raw.alias("raw_value"), value.alias("value"), low.cast("int").alias("low"), high.cast("int").alias("high"), exact.cast("boolean").alias("exact"))

    bounds = (F.col("employee_min"), F.col("employee_max"))
    rows = F.array(
        one("employee", F.col("raw_employees"), F.col("employee_bucket"), *bounds, F.col("employee_exact")), one("industry", F.col("naics"), F.col("naics_sector")),
        one("flag", F.when(F.col("employee_flag").isNotNull(), F.col("raw_employees")), F.col("employee_flag"), *bounds),
    )
    given = lambda x: x["value"].isNotNull() | ((x["child"] == "industry") & x["raw_value"].isNotNull())
    return records.select("record_id", F.inline(F.filter(rows, given)))


def linked_references(matched: DataFrame, references: DataFrame, unresolved: DataFrame) -> DataFrame:
    """Unresolved records that a resolved record names by (source_key, source_record_id) attach to its entity."""
    named = references.join(matched.select("record_id", "entity_id"), "record_id").select("source_key", "source_record_id", "entity_id")
    hit = unresolved.join(named, ["source_key", "source_record_id"])
    return hit.groupBy("source_key", "source_record_id").agg(F.min("entity_id").alias("entity_id")).withColumn("outcome", F.lit("MATCHED"))


def follow_ups(matched: DataFrame, references: DataFrame, earlier: DataFrame, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, observations, events) of ``earlier`` records that a resolved one names and that are still without an entity.

    They attach with HIGH confidence, in the run they came with: their fields are observed for the entity and their typed events found, other than those
    that ``existing`` has. Where several resolved records name one, the least entity takes it; rows of one id in several runs all attach; nulls name nothing.
    ``earlier``: source_key, source_record_id, entity_id, resolution_status, run_id, grain, and what ``unpivot`` and ``event_fields`` read.
    """
    waiting = earlier.filter("entity_id is null and resolution_status = 'UNRESOLVED'").drop("entity_id")
    links = linked_references(matched, references, waiting.select("source_key", "source_record_id")).select("source_key", "source_record_id", "entity_id")
    rows = waiting.join(links, ["source_key", "source_record_id"]).withColumns({"resolution_status": F.lit("MATCHED"), "confidence": F.lit("HIGH")})
    return rows, history.unpivot(rows, ("entity_id", "run_id", "confidence")), history.new_business_events(history.event_fields(rows), existing)
