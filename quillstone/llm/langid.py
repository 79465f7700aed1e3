"""Language identification by Bayesian evidence fusion.

Four sources of evidence are added as logarithms: the text's likelihood under a byte-trigram model of
each language; the declared language, through how often each declaration meets each language; and a
prior from the address - global, then by suffix, then by host, each level smoothed towards the one
above. The declarations' and priors' counts are grouped aggregates over all rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.llm.shared import file_system, maybe_broadcast, stored

LANGUAGES = ("en", "fr", "de", "es")
BUCKETS = 1 << 16
SAMPLE_PER_LANGUAGE = 1_000
TEXT_WEIGHT = 0.3
STRENGTH = 20.0
MIN_POSTERIOR = 0.5
#: How far a text may lie below the usual of a language: so much, and so many standard errors of its mean.
SLACK = 4.0
ERRORS = 3.0

_TO_SPACE = bytes(32 if c < 128 and not chr(c).isalpha() else c for c in range(256))


def trigrams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of the lower-cased text, its other ASCII characters read as spaces."""
    data = np.frombuffer(b" " + text.lower().encode("utf-8").translate(_TO_SPACE) + b" ", dtype=np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, dtype=np.int64)
    code = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    code = code[(data[1:-1] != 32)]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


class Model:
    """Log likelihoods of trigrams by language, and the floors under which a text is of none."""

    def __init__(self, counts: np.ndarray, usual: list[tuple[float, float]] | None = None):
        self.log = np.log((counts + 0.1) / (counts.sum(axis=1, keepdims=True) + 0.1 * counts.shape[1])).astype(np.float32)
        #: Of each language's sample: the median of the texts' means, and the spread of single trigrams.
        self.usual = np.array(usual if usual is not None else [(-np.inf, 0.0)] * len(counts))

    @classmethod
    def load(cls, folder: str, n_languages: int, usual: list[tuple[float, float]] | None = None) -> Model:
        """From a stored table (label, bucket, n), read where it is needed."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        counts = np.zeros((n_languages, BUCKETS))
        store, path = file_system(folder)
        for f in store.get_file_info(fs.FileSelector(path)):
            if f.path.endswith(".parquet"):
                with store.open_input_file(f.path) as source:
                    label, bucket, n = (c.to_numpy() for c in pq.read_table(source, columns=["label", "bucket", "n"]).columns)
                counts[label, bucket] = n
        return cls(counts, usual)

    def score(self, text: str) -> tuple[int, np.ndarray]:
        """Number of trigrams, and the mean log likelihood of one under each language."""
        at = trigrams(text)
        return len(at), np.array([row[at].mean(dtype=np.float64) for row in self.log]) if len(at) else np.zeros(len(self.log))

    def known(self, n: int, means: np.ndarray) -> bool:
        """Whether a text is as likely as some language's texts are; trigrams overlap threefold, so three count as one."""
        return bool(n) and bool((means >= self.usual[:, 0] - SLACK - ERRORS * self.usual[:, 1] * math.sqrt(3 / n)).any())


def sample(docs: DataFrame, text_col: str, label_col: str, languages: tuple[str, ...], per_language: int) -> DataFrame:
    """At most ``per_language`` distinct texts of each language (label: its number), those of the smallest hashes, stored."""
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{label_col}`").cast("string").alias("of")).filter(F.col("of").isin(*languages) & F.col("text").isNotNull())
    rows = rows.withColumn("h", F.xxhash64("text"))
    distinct = {r["of"]: r["n"] for r in rows.groupBy("of").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()}  # a row a language
    # Somewhat more than wanted pass by their hash alone, before anything is moved.
    share = {k: min(1.0, 1.3 * per_language / max(1, distinct.get(k, 1))) for k in languages}
    most = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(int((2 * share[k] - 1) * 2**63), 2**63 - 1)))])
    few = rows.filter(F.col("h") <= most[F.col("of")]).dropDuplicates(["of", "h"])
    label = F.array_position(F.array(*map(F.lit, languages)), F.col("of")) - 1
    first = F.row_number().over(Window.partitionBy("of").orderBy("h"))
    return stored(few.withColumn("place", first).filter(F.col("place") <= per_language).select("text", label.cast("int").alias("label")), "lang-sample")


def train(labelled: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> tuple[str, list[tuple[float, float]]]:
    """The folder of a model's counts, and its ``usual``, from the stored (text, label) rows of a bounded sample.

    Trigrams that one text alone of a language's sample holds count as unseen, so that a mislabelled text
    does not make itself likely.
    """
    def count(batches):
        counts = np.zeros((2, len(languages), BUCKETS), dtype=np.int64)  # occurrences, texts
        for batch in batches:
            for text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = np.bincount(trigrams(text), minlength=BUCKETS)
                counts[0, label] += n
                counts[1, label] += n > 0
        label, bucket = np.nonzero(counts[1])
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(bucket, pa.int32()), pa.array(counts[0, label, bucket]), pa.array(counts[1, label, bucket])], names=["label", "bucket", "n", "texts"])

    counts = labelled.mapInArrow(count, "label int, bucket int, n long, texts long").groupBy("label", "bucket").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    # A few hundred thousand small rows at most, in one file: every task reads it.
    folder, n_languages = stored(counts.filter("texts > 1").select("label", "bucket", "n").repartition(1), "lang-model").scratch, len(languages)

    def usual(batches):
        model = Model.load(folder, n_languages)
        for batch in batches:
            of, means, spread = [], [], []
            for text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(at := trigrams(text)):
                    own = model.log[label][at]
                    of.append(label)
                    means.append(float(own.mean(dtype=np.float64)))
                    spread.append(float(own.var(dtype=np.float64)))
            yield pa.RecordBatch.from_arrays([pa.array(of, pa.int32()), pa.array(means, pa.float64()), pa.array(spread, pa.float64())], names=["label", "mean", "var"])

    # What is far below the usual of each language's sample is no known language; outliers in the sample do not move it.
    found = labelled.mapInArrow(usual, "label int, mean double, var double").groupBy("label").agg(F.median("mean").alias("mean"), F.sqrt(F.median("var")).alias("spread")).collect()  # a row a language
    by = {r["label"]: (r["mean"], r["spread"]) for r in found}
    return folder, [by.get(i, (math.inf, 0.0)) for i in range(n_languages)]  # a language without a sample is no text's


def declared_in(html: Column) -> Column:
    """The primary language of a page's html element, in lower case; null if it declares none."""
    return F.nullif(F.lower(F.regexp_extract(html, r"(?i)<html(?=\s)[^>]*?\s(?:xml:)?lang\s*+=\s*+[\"']?([A-Za-z]{2,3})", 1)), F.lit(""))


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))


def suffix_of(host: Column) -> Column:
    return F.nullif(F.regexp_extract(host, r"\.([^.]+)$", 1), F.lit(""))


def page_text(html: Column) -> Column:
    """A page's text: without scripts, styles, comments, tags and entities."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(text, r"<[^>]*>", " "), r"&#?\w{1,32};", " ")


def _scored(rows: DataFrame, model: tuple[str, list[tuple[float, float]]], languages: tuple[str, ...]) -> DataFrame:
    """``rows`` with n, means (per language) and known (the text is like one of the languages') for their text."""
    folder, usual = model
    kept = [f for f in rows.schema if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("n", T.LongType()), T.StructField("means", T.ArrayType(T.DoubleType())), T.StructField("known", T.BooleanType())])

    def run(batches):
        found = Model.load(folder, len(languages), usual)
        for batch in batches:
            ns, means, known = [], [], []
            for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                n, m = found.score(text or "")
                ns.append(n)
                means.append(m)
                known.append(found.known(n, m))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(f.name)) for f in kept), pa.array(ns, pa.int64()), pa.array(means, pa.list_(pa.float64())), pa.array(known, pa.bool_())], names=schema.names)

    return rows.mapInArrow(run, schema)


def identify(
    docs: DataFrame, text: Column | None = None, declared: Column | None = None, host: Column | None = None, suffix: Column | None = None, languages: tuple[str, ...] = LANGUAGES,
    label_col: str = "lang", train_on: DataFrame | None = None, train_text: str = "text", per_language: int = SAMPLE_PER_LANGUAGE, strength: float = STRENGTH, min_posterior: float = MIN_POSTERIOR, carry: list[str] | None = None,
) -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all), and language, confidence (posterior of that language) and accepted.

    The model is fitted on at most ``per_language`` distinct texts (``train_text``) a language of ``train_on`` (default ``docs``), labelled in ``label_col``;
    all counts cover all rows. A row is accepted if its text has letters, is not less likely than its languages' texts are (by
    ``SLACK`` and ``ERRORS`` standard errors of its own mean, so that short texts get a wider margin), and the best posterior is at least ``min_posterior``.
    Null or empty text has no evidence of its own: it gets the language its address and declaration suggest and is not accepted. Null
    declarations and addresses add nothing. Columns named like the three added ones are replaced. Empty tables stay empty.
    """
    text = F.col("text") if text is None else text
    added, n_lang = ("language", "confidence", "accepted"), len(languages)
    keep = [c for c in (docs.columns if carry is None else carry) if c.lower() not in added]
    none = F.lit(None).cast("string")
    # The row travels as one struct, so that no column of it can clash with the working ones.
    told = F.lower((none if declared is None else declared).cast("string"))
    rows = docs.select(
        F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in keep)).alias("row"), text.cast("string").alias("text"), F.when(told.isin(*languages), told).when(told.isNotNull(), F.lit("other")).alias("declared"),
        F.coalesce((none if suffix is None else suffix).cast("string"), F.lit("")).alias("suffix"), F.coalesce((none if host is None else host).cast("string"), F.lit("")).alias("host"),
    )
    model = train(sample(docs if train_on is None else train_on, train_text, label_col, languages, per_language), languages)
    scored = stored(_scored(rows, model, languages), "lang-scored")

    means, names = F.col("means"), F.array(*map(F.lit, languages))
    guess = F.array_position(means, F.array_max(means))
    counts = [F.count_if(guess == i + 1).alias(f"c{i}") for i in range(n_lang)]
    seen = stored(scored.filter("known").groupBy("declared", "suffix", "host").agg(*counts), "lang-counts")
    sums = [F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(n_lang)]

    # Declarations: the languages, other and none, so a handful of rows.
    by_declared = {r["declared"]: [r[f"c{i}"] for i in range(n_lang)] for r in seen.groupBy("declared").agg(*sums).collect()}
    per_lang = [sum(v[i] for k, v in by_declared.items() if k is not None) for i in range(n_lang)]
    kinds = [*languages, "other"]
    claims = F.create_map(*[x for k in kinds for x in (F.lit(k), F.array(*[F.lit(math.log((by_declared.get(k, [0] * n_lang)[i] + 0.5) / (per_lang[i] + 0.5 * len(kinds)))) for i in range(n_lang)]))])
    every = [sum(v[i] for v in by_declared.values()) for i in range(n_lang)]
    top = [(every[i] + 1) / (sum(every) + n_lang) for i in range(n_lang)]

    def smoothed(above: list[Column]) -> list[Column]:
        total = sum((F.col(f"c{i}") for i in range(1, n_lang)), F.col("c0"))
        return [(F.col(f"c{i}") + strength * above[i]) / (total + strength) for i in range(n_lang)]

    suffixes = seen.groupBy("suffix").agg(*sums)
    suffixes = suffixes.select("suffix", *[p.alias(f"s{i}") for i, p in enumerate(smoothed([F.lit(x) for x in top]))])
    hosts = seen.groupBy("suffix", "host").agg(*sums).join(suffixes, "suffix")
    hosts = stored(hosts.select("suffix", "host", F.array(*[F.log(p) for p in smoothed([F.col(f"s{i}") for i in range(n_lang)])]).alias("prior")), "lang-priors")

    found = scored.join(maybe_broadcast(hosts, 200), ["suffix", "host"], "left")
    prior = F.coalesce("prior", F.array(*[F.lit(math.log(x)) for x in top]))
    claim = F.coalesce(F.when(F.col("declared").isNotNull(), claims[F.col("declared")]), F.array(*[F.lit(0.0)] * n_lang))
    # Trigrams overlap and repeat, so a text's evidence is discounted.
    logs = F.transform(F.arrays_zip(means.alias("m"), claim.alias("d"), prior.alias("p")), lambda x: x["m"] * F.col("n") * TEXT_WEIGHT + x["d"] + x["p"])
    found = found.withColumn("logs", logs).withColumn("top", F.array_max("logs"))
    weight = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    best = F.element_at(names, F.array_position("logs", F.col("top")).cast("int"))
    return found.select(*(F.col(f"row.`{c}`").alias(c) for c in keep), best.alias("language"), (1 / weight).alias("confidence"), (F.col("known") & (1 / weight >= min_posterior)).alias("accepted"))


def identify_documents(docs: DataFrame, **options) -> DataFrame:
    """``identify`` for documents, whose declaration is ``lang`` and whose host is ``source``."""
    return identify(docs, F.col("text"), F.col("lang"), F.col("source"), **options)


def identify_pages(pages: DataFrame, labelled: DataFrame, **options) -> DataFrame:
    """``identify`` for web pages (page_id, url, html), with the text model fitted on labelled documents."""
    host = host_of(F.col("url"))
    return identify(pages, page_text(F.col("html")), declared_in(F.col("html")), host, suffix_of(host), train_on=labelled, **options)
