"""Profiles of tables: gaps, distributions, duplicates, overlaps and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions import tables as t


def _stack(row: DataFrame, names: list[str], parts: dict[str, str]) -> DataFrame:
    """One wide row as a row per name; ``parts`` maps output columns to column prefixes."""
    entries = [F.struct(F.lit(n).alias("column_name"), *(F.col(f"{p}{i}").alias(out) for out, p in parts.items())) for i, n in enumerate(names)]
    return row.select(F.inline(F.array(*entries)))


def missingness(df: DataFrame, columns: list[str], absent: tuple[str, ...] = ("",)) -> DataFrame:
    """Rows without a value, per column, by count and share; one pass over the table."""
    gap = lambda c: F.count_if(F.col(c).isNull() | F.lower(F.trim(F.col(c).cast("string"))).isin(*absent))
    row = df.agg(F.count("*").alias("n"), *(gap(c).alias(f"m{i}") for i, c in enumerate(columns)))
    rows = row.select("n", F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("n_missing")) for i, c in enumerate(columns)))))
    return rows.select("column_name", "n_missing", F.bround(100 * F.col("n_missing") / F.greatest("n", F.lit(1)), 2).alias("pct_missing"))


def distribution(df: DataFrame, value: Column, top: int | None = None) -> DataFrame:
    """Counts of stripped values, absent ones as <MISSING>; with ``top``, the most frequent only."""
    rows = df.groupBy(F.coalesce(F.trim(value.cast("string")), F.lit("<MISSING>")).alias("value")).agg(F.count("*").alias("n"))
    return rows.orderBy(F.desc("n"), "value").limit(top) if top else rows


def duplicates(df: DataFrame, key: Column, columns: list[str]) -> DataFrame:
    """All rows whose key another row has too, blank keys apart."""
    keyed = df.withColumn("dup_key", F.lower(F.trim(F.regexp_replace(key.cast("string"), r"\s+", " ")))).filter("dup_key <> ''")
    # Keys are counted before they are joined, so a common key never gathers its rows in one task.
    twice = keyed.groupBy("dup_key").agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
    return keyed.join(twice, "dup_key").select(*columns, "dup_key", "n_rows")


def cross_tab(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def shares(df: DataFrame, key: str) -> DataFrame:
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select(key, "n", F.bround(100 * F.col("n") / F.col("total"), 2).alias("pct"))  # one row


def fill_rates(df: DataFrame, columns: list[str], absent: tuple[str, ...]) -> DataFrame:
    """Share of rows with a real value, to one decimal, and the number of distinct ones."""
    real = lambda c: F.when(~F.lower(F.trim(F.col(c).cast("string"))).isin(*absent), F.col(c).cast("string"))
    row = df.agg(*(F.bround(100 * F.count(real(c)) / F.greatest(F.count("*"), F.lit(1)), 1).alias(f"f{i}") for i, c in enumerate(columns)), *(F.countDistinct(real(c)).alias(f"d{i}") for i, c in enumerate(columns)))
    return _stack(row, columns, {"pct_filled": "f", "n_distinct": "d"})


ROLES = {"name": ("name", "nom"), "address": ("address", "street", "adresse"), "postal": ("postal", "zip"), "phone": ("phone", "tel"), "status": ("status", "etat"), "date": ("date", "issued"), "employees": ("employee", "emp_")}


def column_roles(columns: list[str], roles: dict[str, tuple[str, ...]] = ROLES) -> dict[str, str | None]:
    """The first column whose name holds one of a role's keywords; an exact name first."""
    low = {c.lower(): c for c in columns}
    return {r: next((low[k] for k in words if k in low), next((c for k in words for c in columns if k in c.lower()), None)) for r, words in roles.items()}


def date_profile(df: DataFrame, value: Column, parsed: Column, most: int = 5) -> DataFrame:
    """Given, unreadable and distinct dates, the extremes, and the first and last ``most`` as text."""
    # Only distinct texts reach the arrays' sort, and of those the extremes are picked by ordered limits per task.
    given = df.select(F.nullif(F.trim(value), F.lit("")).alias("v"), parsed.alias("d"))
    top = given.agg(F.count("v").alias("n_given"), F.count_if(F.col("v").isNotNull() & F.col("d").isNull()).alias("n_malformed"), F.min("d").cast("date").alias("first_date"), F.max("d").cast("date").alias("last_date"), F.countDistinct("v").alias("n_distinct"))
    names = given.select("v").dropna().distinct()
    low = names.orderBy("v").limit(most).agg(F.array_join(F.array_sort(F.collect_list("v")), "|").alias("smallest"))
    high = names.orderBy(F.desc("v")).limit(most).agg(F.array_join(F.array_sort(F.collect_list("v")), "|").alias("largest"))
    return top.join(F.broadcast(low)).join(F.broadcast(high))  # one row each


def bracketed(values: DataFrame, share: float, accuracy: int = 10_000) -> DataFrame:
    """The values (``x``, nulls left out) among which the one of rank ``floor(share * n)`` is, with ``rank`` and ``before``, the number of values below them.

    A quantile sketch, which combines before its shuffle, gives a bracket around the rank that is a few ranks in ``accuracy`` wide however the values are
    spread; below, inside and above it are counted exactly, and the part that holds the rank is taken. The sketch's error decides only how many rows that is.
    """
    given = values.filter("x is not null").select("x")
    near = [min(max(share + d / accuracy, 0.0), 1.0) for d in (-3, 3)]
    ends = given.agg(F.count("x").alias("n"), F.percentile_approx("x", near, accuracy).alias("q"))  # one row
    part = F.when(F.col("x") < F.col("q")[0], 0).when(F.col("x") <= F.col("q")[1], 1).otherwise(2)
    rows = given.join(F.broadcast(ends)).select("x", part.alias("part"), F.floor(F.col("n") * share).alias("rank"))
    counts = rows.groupBy("part").agg(F.count("*").alias("m"), F.first("rank").alias("rank"))  # three rows
    upto = F.sum("m").over(Window.partitionBy(F.lit(0)).orderBy("part"))
    held = counts.select("part", (upto - F.col("m")).alias("before"), upto.alias("upto"), "rank").filter("before <= rank and rank < upto").select("part", "before")
    return rows.join(F.broadcast(held), "part").select("x", "rank", "before")


def order_statistic(values: DataFrame, share: float, name: str) -> DataFrame:
    """One row: the value of ``x`` at rank ``floor(share * n)`` of the sorted values, exactly; null if there is none. Only the bracket around it is sorted."""
    counts = bracketed(values, share).groupBy("x", "rank", "before").agg(F.count("*").alias("m"))
    upto = F.col("before") + F.sum("m").over(Window.partitionBy(F.lit(0)).orderBy("x"))
    return counts.select("x", "rank", upto.alias("upto")).filter("upto > rank").agg(F.min("x").alias(name))


def numeric_profile(df: DataFrame, value: Column) -> DataFrame:
    """Readable, zero, negative and positive values, extremes, and the upper median (element n // 2 of the sorted values).

    The median is an order statistic within a bracket: no task sorts all values, whatever outliers there are.
    """
    numbers = df.select(value.cast("string").alias("raw"), value.try_cast("double").alias("x"))
    middle = order_statistic(numbers, 0.5, "upper_median")
    row = numbers.agg(
        F.count("raw").alias("n_given"), F.count("x").alias("n_numeric"), F.count_if(F.col("x") == 0).alias("n_zero"), F.count_if(F.col("x") < 0).alias("n_negative"), F.count_if(F.col("x") > 0).alias("n_positive"),
        F.min("x").alias("min_value"), F.max("x").alias("max_value"),
    )
    return row.join(F.broadcast(middle))  # one row


def histogram(df: DataFrame, value: Column) -> DataFrame:
    """Rows per employee band, with a band for zero; others uncounted."""
    band = F.when(value == 0, "0")
    for a, b, label in t.BUCKETS:
        band = band.when((value >= a) & (F.lit(True) if b is None else value <= b), label)
    return df.groupBy(band.alias("bucket")).agg(F.count("*").alias("n")).filter("bucket is not null")


def multi_value(df: DataFrame, key: Column, value: Column) -> DataFrame:
    """Keys, keys with more than one distinct value, and their share."""
    each = df.select(key.alias("k"), value.alias("v")).dropna().groupBy("k").agg(F.countDistinct("v").alias("d"))
    return each.agg(F.count("*").alias("n_keys"), F.count_if(F.col("d") > 1).alias("n_inconsistent"), F.bround(100 * F.count_if(F.col("d") > 1) / F.greatest(F.count("*"), F.lit(1)), 1).alias("pct_inconsistent"))


def recency_buckets(df: DataFrame, when: Column, today: Column, days: tuple[int, ...] = (30, 90, 365)) -> DataFrame:
    """Rows of the last so many days, cumulative."""
    return df.agg(F.count(when).alias("n_dated"), *(F.count_if(F.datediff(today, when).between(0, d)).alias(f"last_{d}") for d in days))


def set_overlap(sets: DataFrame, examples: int = 10) -> DataFrame:
    """For each pair of sets of (set_name, item): common items, shares of either, and the first common ones."""
    items = sets.distinct()
    sizes = items.groupBy("set_name").agg(F.count("*").alias("n"))
    # An item is in few sets: its pairs are made from one sorted array, not from a self-join of rows.
    groups = items.groupBy("item").agg(F.array_sort(F.collect_set("set_name")).alias("s")).filter(F.size("s") > 1)
    pairs = groups.select("item", F.explode(F.flatten(F.transform("s", lambda a: F.transform(F.filter("s", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("p"))
    counted = pairs.groupBy("p.a", "p.b").agg(F.count("*").alias("n_common"))
    rank = F.row_number().over(Window.partitionBy("a", "b").orderBy("item"))
    first = pairs.select("p.a", "p.b", "item").withColumn("r", rank).filter(F.col("r") <= examples).groupBy("a", "b").agg(F.array_join(F.array_sort(F.collect_list("item")), "|").alias("examples"))
    a, b = sizes.select(F.col("set_name").alias("a"), F.col("n").alias("na")), sizes.select(F.col("set_name").alias("b"), F.col("n").alias("nb"))
    share = lambda n: F.bround(100 * F.col("n_common") / F.col(n), 2)
    return counted.join(a, "a").join(b, "b").join(first, ["a", "b"]).select("a", "b", "n_common", share("na").alias("pct_of_a"), share("nb").alias("pct_of_b"), "examples")


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Items of one side only."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    only = lambda p, q, side: p.join(q, key, "left_anti").select(F.lit(side).alias("side"), key)
    return only(x, y, "first").unionByName(only(y, x, "second"))


def name_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def membership(rows: DataFrame, key: Column, others: DataFrame, other_key: Column) -> DataFrame:
    """How many rows (repeats counted) have a key that the others hold."""
    mine = rows.select(name_key(key).alias("k")).filter("k <> ''")
    theirs = others.select(name_key(other_key).alias("k")).filter("k <> ''").distinct().withColumn("hit", F.lit(1))
    return mine.join(theirs, "k", "left").agg(F.count("*").alias("n_rows"), F.count("hit").alias("n_members"), F.bround(100 * F.count("hit") / F.greatest(F.count("*"), F.lit(1)), 2).alias("pct_members"))


def grain(df: DataFrame, entity: Column, licence: Column, kind: Column) -> DataFrame:
    """Rows, distinct licences, entities, entities with several rows, and with several kinds."""
    rows = df.select(entity.alias("e"), licence.alias("l"), kind.alias("k"))
    each = rows.filter("e is not null").groupBy("e").agg(F.count("*").alias("n"), F.countDistinct("k").alias("kinds"))
    return rows.agg(F.count("*").alias("n_rows"), F.countDistinct("l").alias("n_licences")).join(F.broadcast(each.agg(F.count("*").alias("n_entities"), F.count_if(F.col("n") > 1).alias("n_repeated"), F.count_if(F.col("kinds") > 1).alias("n_multi_kind"))))


def contact_quality(df: DataFrame, phone: Column, email: Column, url: Column) -> DataFrame:
    """Present and valid contacts, and rows with all three valid. Arguments: structs with raw and valid."""
    parts = {"phone": phone, "email": email, "url": url}
    counts = [x for k, c in parts.items() for x in (F.count(c["raw"]).alias(f"{k}_present"), F.count_if(F.coalesce(c["valid"], F.lit(False))).alias(f"{k}_valid"))]
    return df.agg(F.count("*").alias("n"), *counts, F.count_if(F.coalesce(phone["valid"] & email["valid"] & url["valid"], F.lit(False))).alias("all_three"))


def dimensions(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct sorted values of each dimension: number, first, last."""
    row = df.agg(*(x for i, c in enumerate(columns) for x in (F.countDistinct(c).alias(f"n{i}"), F.min(F.col(c).cast("string")).alias(f"a{i}"), F.max(F.col(c).cast("string")).alias(f"z{i}"))))
    return _stack(row, columns, {"n_values": "n", "first_value": "a", "last_value": "z"})


def dimension_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, n) of every value of each dimension, nothing as the empty value: also how often a table's symbols mark a number as suppressed."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")).alias("value")) for c in columns)))
    return df.select(cells.alias("c")).groupBy("c.column_name", "c.value").agg(F.count("*").alias("n"))


def label_bucket(label: Column) -> Column:
    """The band a size label means: one that holds or is held by its name, else by the label's first number."""
    s = F.regexp_replace(F.translate(F.lower(label), "–—", "--"), "[ ,]", "")
    out = F.when(s.isNull() | (s == ""), F.lit(None).cast("string"))
    for _, _, name in t.BUCKETS:
        out = out.when(s.contains(name) | F.lit(name).contains(s), name)
    first = F.regexp_extract(s, r"(\d+)", 1).try_cast("long")
    for low, _, name in reversed(t.BUCKETS):
        out = out.when(first >= low, name)
    return out


def coverage(sources: DataFrame, regions: DataFrame, region: str) -> DataFrame:
    """Every region with the number of sources that cover it; zero is a gap."""
    have = sources.select("source_key", region).dropna().distinct().groupBy(region).agg(F.count("*").alias("n_sources"))
    return regions.join(have, region, "left").select(region, F.coalesce("n_sources", F.lit(0)).alias("n_sources"), F.col("n_sources").isNull().alias("gap"))


def field_matrix(df: DataFrame, by: str, columns: list[str], least: float = 0.5) -> DataFrame:
    """Per group, whether more than ``least`` of the rows fill each column."""
    filled = lambda c: F.avg(F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "", 1.0).otherwise(0.0)) > least
    return df.groupBy(by).agg(*(filled(c).alias(f"has_{c}") for c in columns))
