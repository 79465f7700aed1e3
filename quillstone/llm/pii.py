"""Personal data, by patterns and by contexts learned from what the patterns find.

Everything here is DataFrame expressions. The base patterns give seed entities. Every identifier-like
token has a lexical pattern, the two words before it. Patterns and identifiers (instances) form a
bipartite graph that is scored in rounds: a pattern's confidence for a kind is the share of its
distinct instances known to be of that kind; an instance met by confident patterns becomes known,
with the noisy-or of their confidences as its score. Instances that no base pattern covers are then
reported wherever they stand.

Java's regular expressions recurse on repeated groups and scan quadratically from inside a run, so the patterns
are written as possessive runs of character classes that start where a run starts; ``\\G`` allows a
start right after the last match. They match what the plain forms do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.shared import maybe_broadcast, stored

KINDS = ("email", "ip", "card", "phone")
MIN_SEEDS = 3
MIN_CONFIDENCE = 0.8

EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: In texts whose single separators between digits are replaced by JOINT.
CARD = "(?<![0-9\u0001])[0-9][0-9\u0001]{11,}+"
JOINT = "\u0001"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A token with a digit or an at sign, from its start.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: Two words nearly always end within so many characters; where they don't, the whole text before a token is kept.
CONTEXT_CHARS = 64
TWO_WORDS = r"([^\x20\x09-\x0D]+[\x20\x09]+[^\x20\x09-\x0D]+)[\x20\x09]+$"
#: All marks around a token are taken off; runs of them are looked at once.
OPENING = r"^[(\[{<\"']++"
CLOSING = r"(?<![.,;:!?)\]}>\"'])[.,;:!?)\]}>\"']++$"
#: Longer tokens travel as a hash.
LONG_TOKEN = 256
BLOCK = 64


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _scan(items: Column, zero: Column, advance, emit, fields: str) -> Column:
    """array<struct<fields>> of ``emit(state, item)`` (an array) for all items, the state going on by ``advance(state, item)``.

    Spark copies an aggregate's accumulator at every step, so the items are cut into blocks: a first pass finds the
    state before each block, a second gathers within blocks. The cost is linear in the items but for one number a block.
    """
    cut = lambda p: F.transform(F.sequence(F.lit(0), F.ceil(F.size(p) / BLOCK).cast("int") - 1), lambda i: F.slice(p, i * BLOCK + 1, F.lit(BLOCK)))

    def before(blocks):
        step = lambda acc, block: F.struct(F.aggregate(block, acc["state"], advance).alias("state"), F.concat(acc["all"], F.array(acc["state"])).alias("all"))
        return F.aggregate(blocks, F.struct(zero.alias("state"), F.slice(F.array(zero), 1, 0).alias("all")), step, lambda acc: acc["all"])

    def gathered(z):
        step = lambda acc, x: F.struct(advance(acc["state"], x).alias("state"), F.concat(acc["out"], emit(acc["state"], x)).alias("out"))
        return F.aggregate(z["block"], F.struct(z["state"].alias("state"), F.array().cast(f"array<struct<{fields}>>").alias("out")), step, lambda acc: acc["out"])

    return _let(items, lambda p: _let(cut(p), lambda blocks: F.flatten(F.transform(F.arrays_zip(blocks.alias("block"), before(blocks).alias("state")), gathered))))


def _context(gap: Column) -> Column:
    """The end of ``gap``, with all of the two words before a token."""
    end = F.right(gap, F.lit(CONTEXT_CHARS))
    return F.when((F.length(gap) <= CONTEXT_CHARS) | end.rlike(rf"[\x20\x09-\x0D]{TWO_WORDS}"), end).otherwise(gap)


def _spans(text: Column, pattern: str) -> Column:
    """array<struct<start, stop, found, gap>> of a pattern's matches, in code points, and the context before each."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))

    def emit(at, x):
        start = at + F.length(x["gap"])
        one = F.struct(start.alias("start"), (start + F.length(x["found"])).alias("stop"), x["found"].alias("found"), _context(x["gap"]).alias("gap"))
        return F.filter(F.array(one), lambda y: y["found"].isNotNull())

    return _scan(parts, F.lit(0), lambda at, x: at + F.length(x["gap"]) + F.coalesce(F.length(x["found"]), F.lit(0)), emit, "start:int,stop:int,found:string,gap:string")


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(i):
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == 0, d).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def _small(part: Column) -> Column:
    part = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.length(part) <= 3) & (F.lpad(part, 3, "0") <= "255")


def base_arrays(text: Column) -> dict[str, Column]:
    """By kind, the spans of the base patterns that pass; each runs only on texts that can hold one."""
    none = F.array().cast("array<struct<start:int,stop:int,found:string,gap:string>>")
    # A JOINT of the text itself is no separator.
    joined = F.regexp_replace(F.translate(text, JOINT, "\u0002"), r"(?<=[0-9])[\x20-](?=[0-9])", JOINT)
    plain = {
        "email": (text.contains("@"), _spans(text, EMAIL), lambda x: F.lit(True)),
        "ip": (text.rlike(r"[0-9]\.[0-9]"), _spans(text, IP), lambda x: F.forall(F.split(x["found"], r"\."), _small)),
        "card": (text.rlike(r"[0-9][0-9\x20-]{10,}[0-9]"), _spans(joined, CARD), lambda x: F.length(_digits(x["found"])).between(12, 19) & _luhn(_digits(x["found"]))),
        "phone": (text.contains("+"), _spans(text, PHONE), lambda x: F.length(_digits(x["found"])).between(9, 15)),
    }
    # A trailing separator is no part of a card: the replaced ones all stand between digits.
    return {k: F.when(may, F.filter(spans, test)).otherwise(none) for k, (may, spans, test) in plain.items()}


def _tagged(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["stop"].alias("stop")))


def span_text(spans: Column) -> Column:
    """kind:start:end of each of sorted (start, rank, stop), comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["rank"]], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The text as _text, and two hashes that tell rows of different id or text apart."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select("*", text.alias("_text"))
    return rows.select("*", F.xxhash64(F.col(id_col), "_text").alias("_k1"), F.hash(F.col(id_col), "_text").alias("_k2"))


def _base(rows: DataFrame) -> DataFrame:
    rows = rows.select("*", *(c.alias(f"_{k}") for k, c in base_arrays(F.col("_text")).items()))
    # Ends are part of the order: spans of equal start and kind cannot be.
    return rows.select("*", F.array_sort(F.concat(*(_tagged(F.col(f"_{k}"), k) for k in KINDS))).alias("_base"))


def _with_kind(tokens: Column, base: Column) -> Column:
    """``tokens`` with the kind of a base span each overlaps (-1: none), the one that reaches furthest.

    One sweep: tokens by their ends and base spans by their starts. Of the base spans that start before a
    token ends, the one that reaches furthest tells whether any overlaps it.
    """
    a = F.transform(tokens, lambda t: F.struct(t["stop"].alias("at"), F.lit(0).alias("base"), t["start"].alias("start"), F.lit(-1).alias("rank"), t["stop"].alias("stop"), t["found"].alias("found"), t["gap"].alias("gap")))
    b = F.transform(base, lambda s: F.struct(s["start"].alias("at"), F.lit(1).alias("base"), s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), F.lit("").alias("found"), F.lit("").alias("gap")))

    def advance(state, x):
        further = (x["base"] == 1) & (x["stop"] > state["reach"])
        return F.when(further, F.struct(x["stop"].alias("reach"), x["rank"].alias("rank"))).otherwise(state)

    def emit(state, x):
        one = F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["found"].alias("found"), x["gap"].alias("gap"), F.when(state["reach"] > x["start"], state["rank"]).otherwise(-1).alias("kind"))
        return F.filter(F.array(one), lambda y: x["base"] == 0)

    sweep = _scan(F.array_sort(F.concat(a, b)), F.struct(F.lit(0).alias("reach"), F.lit(-1).alias("rank")), advance, emit, "start:int,stop:int,found:string,gap:string,kind:int")
    return F.when(F.size(tokens) > 0, sweep)


def _marked(rows: DataFrame) -> DataFrame:
    """``rows`` with _base and _tokens (identifier-like ones, with context and kind), stored: the texts are scanned once."""
    based = _base(rows)
    found = F.when(F.col("_text").rlike("[0-9@]"), _spans(F.col("_text"), TOKEN))
    kept = [c for c in rows.columns if c != "_text"]
    return stored(based.select(*(F.col(f"`{c}`") for c in kept), "_base", _with_kind(found, F.col("_base")).alias("_tokens")), "pii-marked")


def _occurrences(marked: DataFrame) -> DataFrame:
    """Of each token: keys, start, stop, instance, pattern, and the kind a base span gives it (-1: none)."""
    rows = marked.select("_k1", "_k2", F.explode("_tokens").alias("t"))
    opened = F.regexp_replace("t.found", OPENING, "")
    body = F.lower(F.regexp_replace(opened, CLOSING, ""))
    rows = rows.select("_k1", "_k2", (F.col("t.stop") - F.length(opened)).alias("start"), body.alias("body"), F.lower(F.regexp_extract("t.gap", TWO_WORDS, 1)).alias("pattern"), F.col("t.kind").alias("kind"))
    instance = F.when(F.length("body") > LONG_TOKEN, F.concat(F.lit("#"), F.sha2("body", 256))).otherwise(F.col("body"))
    return rows.select("_k1", "_k2", "start", (F.col("start") + F.length("body")).alias("stop"), instance.alias("instance"), _identifier(F.col("body")).alias("whole"), "pattern", "kind")


def _identifier(body: Column) -> Column:
    """Six characters or more, all of them an identifier's, and with an at sign or four digits."""
    return body.rlike(r"^[a-z0-9][a-z0-9@._/+()\[\]-]{4,}[a-z0-9]$") & (body.contains("@") | (F.length(_digits(body)) >= 4))


def discover(occurrences: DataFrame, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(instance, kind, score, seed) of the known instances: seeds, and those that confident patterns reach; from stored occurrences.

    Rounds go on until one adds nothing: known instances only grow in number. Of kinds that tie, the first listed counts.
    """
    edges = stored(occurrences.filter("pattern <> '' and instance <> ''").groupBy("pattern", "instance").agg(F.max("whole").alias("whole")), "pii-edges")
    known = stored(occurrences.filter("kind >= 0").groupBy("instance").agg(F.min("kind").alias("kind")).withColumns({"score": F.lit(1.0), "seed": F.lit(True)}), "pii-known")
    while True:
        marked = edges.drop("whole").join(known.select("instance", "kind"), "instance", "left")
        hits = marked.groupBy("pattern").agg(F.count("*").alias("all"), *(F.count_if(F.col("kind") == k).alias(f"n{k}") for k in range(len(KINDS))))
        most = F.greatest(*(F.col(f"n{k}") for k in range(len(KINDS))))
        good = stored(
            hits.filter((most >= min_seeds) & (most >= min_confidence * F.col("all")))
            .select("pattern", (F.array_position(F.array(*(F.col(f"n{k}") for k in range(len(KINDS)))), most) - 1).cast("int").alias("kind"), (most / (F.col("all") + 1)).alias("confidence")),
            "pii-patterns",
        )
        reached = edges.filter("whole").select("pattern", "instance").join(maybe_broadcast(good, 120), "pattern").join(known.select("instance"), "instance", "left_anti")
        scored = reached.groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score"))
        best = scored.groupBy("instance").agg(F.min_by("kind", F.struct(-F.col("score"), F.col("kind"))).alias("kind"), F.max("score").alias("score")).withColumn("seed", F.lit(False))
        added = stored(best, "pii-reached")
        if added.isEmpty():
            return known
        known = stored(known.unionByName(added), "pii-known")


def _found(occurrences: DataFrame, **options) -> DataFrame:
    """(_k1, _k2, _more): the discovered spans of each text that has any."""
    known = discover(occurrences, **options).filter("not seed").drop("seed")
    hits = occurrences.filter("kind < 0").drop("kind").join(maybe_broadcast(stored(known, "pii-new"), 160), "instance")
    spans = hits.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("start", F.col("kind").alias("rank"), "stop")).alias("_more"))
    return stored(spans, "pii-found")


def _all_spans() -> Column:
    return F.array_sort(F.concat("_base", F.coalesce("_more", F.array().cast("array<struct<start:int,rank:int,stop:int>>"))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and hash are of the base spans; ``spans`` lists those and the discovered ones as
    kind:start:end in code points, by start, then kind. Discovered identifiers have six characters or more, without an upper bound,
    and any number of marks around them. Null text counts as empty; null ids and repeated
    rows are kept; of kinds that tie the first listed counts; an empty table gives no rows; other columns are not carried.
    """
    marked = _marked(_keyed(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text").drop("text"))
    found = _found(stored(_occurrences(marked), "pii-tokens"), **options)
    rows = marked.drop("_tokens").join(maybe_broadcast(found, 200), ["_k1", "_k2"], "left")
    count = lambda k: F.size(F.filter("_base", lambda x: x["rank"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return rows.select("doc_id", *map(count, KINDS), F.sha2(span_text(F.col("_base")), 256).alias("base_sha256"), span_text(_all_spans()).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every span of its text, base and discovered, replaced by [EMAIL], [IP], [CARD] or [PHONE].

    Overlapping spans get the tag of the first. Null texts stay null; all columns are kept.
    """
    # The row travels as one struct, so that no column of it can clash with the working ones.
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = _marked(_keyed(whole, "doc_id", "text").drop("text"))
    found = _found(stored(_occurrences(marked), "pii-tokens"), **options)
    rows = marked.drop("_tokens").join(maybe_broadcast(found, 200), ["_k1", "_k2"], "left").withColumn("_spans", _all_spans())
    tags = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    text = F.coalesce(F.col(f"_row.`{text_col}`").cast("string"), F.lit(""))

    def step(acc, x):
        new = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), tags[x["rank"]])
        return F.struct(F.greatest(acc["at"], x["stop"]).alias("at"), F.when(x["start"] >= acc["at"], new).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    new = F.when(F.col(f"_row.`{text_col}`").isNotNull(), F.when(F.size("_spans") > 0, clean).otherwise(text))
    return rows.select(*(new.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns))
