"""How filters interact: what each removes, alone and behind others, in every order.

Rows are counted once, by which filters they fail. From that come the joint-failure counts: for each of the 2^n sets of
filters the number of rows that fail all of it, the sum of the product of their flags. Everything else follows from these
by inclusion-exclusion, without another look at the rows:

- the survivors of a set are the sum of (-1)^|S| J(S) over its subsets S, for all sets at once by one Moebius transform;
- a step removes the survivors of the filters before it less those of them and itself;
- what fails a filter only is the survivors of all others less the survivors of all;
- what a set of filters removes is a game whose Harsanyi dividend of S is (-1)^(|S|+1) J(S), so a filter's Shapley value is the
  sum of the dividends of the sets it is in, each divided by the set's size. Summed over all orders it is a whole number.

The same transform of weighted counts tells what good or toxic rows each step loses.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.shared import stored

SPACE = r"[\x20\x09-\x0D]+"
NAMES = ("A", "B", "C", "D", "E")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text_flags(text: Column, least_words: int = 100, distinct_percent: int = 80, capital_percent: int = 10, symbols: str = "[#$%&*|]") -> Column:
    """struct<A,B,C,D>: 1 where a text has few words, few distinct ones, many capitals, or a symbol."""
    words = F.array_remove(F.split(text, SPACE), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    flag = lambda c, name: c.cast("int").alias(name)
    return _let(words, lambda w: F.struct(
        flag(F.size(w) < least_words, "A"), flag(F.size(F.array_distinct(w)) * F.lit(100).cast("long") < F.size(w) * F.lit(distinct_percent).cast("long"), "B"),
        flag(capitals * F.lit(100).cast("long") > F.length(text) * F.lit(capital_percent).cast("long"), "C"), flag(text.rlike(symbols), "D"),
    ))


def joint_failures(rows: DataFrame, part: str, filters: list[str], weights: dict[str, str]) -> DataFrame:
    """A row per part: for each name of ``weights`` the array of joint-failure counts of all sets of filters, by their bits.

    ``filters`` are columns of 0 and 1; ``weights`` names whole-number columns, as does the count ``n`` that is always there. Rows are first
    counted by their flags and weights, which combines before the shuffle: at most 2^(filters) rows times the distinct weights of a part.
    """
    counted = rows.groupBy(part, *filters, *weights.values()).agg(F.count("*").alias("_n"))

    def of(s: int, weight: Column) -> Column:
        product = F.col("_n") * weight
        for i, f in enumerate(filters):
            if s >> i & 1:
                product = product * F.col(f)
        return F.sum(product)

    sets = range(1 << len(filters))
    every = {"n": F.lit(1)} | {k: F.col(c) for k, c in weights.items()}
    return counted.groupBy(part).agg(*(F.array(*(of(s, w) for s in sets)).alias(k) for k, w in every.items()))


def survivors(joint: Column, filters: int) -> Column:
    """For each set of filters the rows that fail none of it: the Moebius transform of the joint-failure counts."""
    def summed(bit: int):
        return lambda x: F.transform(x, lambda v, s: F.when(s.bitwiseAND(F.lit(bit)) > 0, v + F.get(x, s - bit)).otherwise(v))

    out = F.transform(joint, lambda j, s: F.when(F.bit_count(s) % 2 == 1, -j).otherwise(j))
    for i in range(filters):
        out = _let(out, summed(1 << i))
    return out


def shapley_sums(joint: Column, filters: int) -> Column:
    """For each filter what it removes, summed over all orders: its dividends (-1)^(|S|+1) J(S) by n!/|S|."""
    orders = F.lit(factorial(filters)).cast("long")

    def of(bit: int) -> Column:
        share = lambda j, s: F.when(s.bitwiseAND(F.lit(bit)) > 0, F.when(F.bit_count(s) % 2 == 1, j).otherwise(-j) * (orders / F.bit_count(s)).cast("long")).otherwise(F.lit(0).cast("long"))
        return F.aggregate(F.transform(joint, share), F.lit(0).cast("long"), lambda a, x: a + x)

    return F.array(*(of(1 << i) for i in range(filters)))


def audit(rows: DataFrame, part: str, filters: dict[str, str], losses: dict[str, str] | None = None) -> DataFrame:
    """One row per part, order of the filters and step, from the joint-failure counts alone.

    ``filters``: names (one character each) and columns of 0 and 1; ``losses``: output columns and the 0/1 columns that they count among
    the removed. Columns: the part, filter_order, step, kept, removed, redundant, unique_fails, the losses, shapley. Empty rows give no part.
    """
    losses, n = losses or {}, len(filters)
    joint = joint_failures(rows, part, list(filters.values()), losses)
    left = joint.select(part, F.col("n").alias("_joint"), shapley_sums(F.col("n"), n).alias("_shapley"), *(survivors(F.col(k), n).alias(f"_{k}") for k in ("n", *losses)))
    # The orders are a constant: they go out from each part's row, not by a join.
    every = ",".join(f"array({','.join(map(str, p))})" for p in permutations(range(n)))
    steps = left.select("*", F.expr(f"explode(array({every}))").alias("_order")).select("*", F.posexplode("_order").alias("_at", "_filter"))
    bits = lambda xs: F.aggregate(xs, F.lit(0), lambda a, i: a.bitwiseOR(F.call_function("shiftleft", F.lit(1), i)))
    steps = steps.select("*", bits(F.slice("_order", F.lit(1), F.col("_at"))).alias("_before"), F.call_function("shiftleft", F.lit(1), F.col("_filter")).alias("_bit"))
    after, full = F.col("_before").bitwiseOR(F.col("_bit")), (1 << n) - 1
    lost = lambda k: F.get(f"_{k}", F.col("_before")) - F.get(f"_{k}", after)
    names = F.array(*map(F.lit, filters))
    return steps.select(
        part, F.array_join(F.transform("_order", lambda i: F.get(names, i)), "").alias("filter_order"), (F.col("_at") + 1).alias("step"), F.get("_n", after).alias("kept"), lost("n").alias("removed"),
        (F.get("_joint", F.col("_bit")) - lost("n")).alias("redundant"), (F.get("_n", F.lit(full) - F.col("_bit")) - F.get("_n", F.lit(full))).alias("unique_fails"), *(lost(k).alias(k) for k in losses),
        F.get("_shapley", F.col("_filter")).alias("shapley"),
    )


def flagged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, the flags A to E, good and toxic of every row of ``docs``.

    E: a smaller id has the same text. Texts are told apart by their SHA-256. The least id of each comes from an aggregate that combines before
    its shuffle, and the rows that hold it are found by text and id together, so a common text is neither one task's work nor one
    key of the join. A row is good or toxic where any label of its id says 1.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text_flags(text).alias("f"))
    rows = stored(rows.select("id", "part", "digest", "f.*"), "filter-flags")
    first = rows.filter("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(1))
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(*(F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(k) for c, k in (("quality", "good"), ("toxic", "toxic"))))
    rows = rows.join(first, ["digest", "id"], "left").join(marks, "id", "left")
    later = (F.col("id").isNotNull() & F.col("first").isNull()).cast("int")
    return rows.select("part", "A", "B", "C", "D", later.alias("E"), *(F.coalesce(k, F.lit(0)).alias(k) for k in ("good", "toxic")))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The audit of the five filters over all documents: one row per part, order (120) and step (5).

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley. Null texts count as empty, null
    parts as the empty string. A null id is nobody's copy and has no label; nobody is a copy of it. Rows that share id and text are
    none of each other's copies, and each counts. Several labels of an id count as one. Other columns of either table are not
    read. An empty table gives no rows; without labels nothing is lost.
    """
    return audit(flagged(docs, labels, id_col, text_col, part_col), "part", {k: k for k in NAMES}, {"good_lost": "good", "toxic_lost": "toxic"})
