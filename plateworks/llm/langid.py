"""Language identification by Bayesian fusion of four kinds of evidence.

posterior(language) is proportional to
  text likelihood ^ TEMPER  x  P(declared | language)  x  P(suffix | language)  x  P(language | host).

Text likelihoods come from hashed character trigrams of the whole text, fitted to a bounded
sample of labelled rows (at most ``SAMPLE`` a language, those of the smallest hashed ids).
Whether a text is running text at all is a posterior of its own, from its share of symbols.
Declared languages (markup) and address suffixes are right with a fixed probability. Host
priors are counts of the text's best language by host, smoothed towards the host's address
suffix, and that towards the whole corpus; all three levels are grouped aggregations.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, materialize, prepare, texts_of

#: Labelled rows a language that the text model is fitted to, at most.
SAMPLE = 200
BUCKETS = 1 << 16
#: Labels with a column of the model, at most: those with the most rows. All others together are ``OTHER``.
LANGUAGES = 256
OTHER = "mis"
#: The text likelihood's exponent per trigram: neighbouring trigrams overlap.
TEMPER = 0.3
#: Probability that a declaration, or an address suffix that stands for a language, is right.
DECLARED_RIGHT, SUFFIX_RIGHT = 0.9, 0.7
#: Weight, in documents, of the level above in a host's and a suffix's prior.
HOST_WEIGHT, SUFFIX_WEIGHT = 10.0, 50.0
#: A document is rejected if its best language has less posterior, or it has fewer trigrams.
LEAST_POSTERIOR, LEAST_TRIGRAMS = 0.6, 1
#: A text whose mean log likelihood ratio against evenly spread trigrams is below this is in no known language.
LEAST_GAIN = 0.0
UNKNOWN = "und"
#: Symbols, how likely a character other than white space is one in running text (tables among it) and in junk, and how likely a document is junk.
SYMBOLS = "#*$%&|<>{}[]^~\\=@_+/"
SYMBOL_IN_TEXT, SYMBOL_IN_JUNK, JUNK = 0.1, 0.35, 0.02

# Country suffixes that stand for one language.
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en", "ie": "en"}
_HTML_LANG = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})"
_SUFFIX = r"(?i)^[a-z0-9.-]+\.([a-z]+)$"
_HOST = r"(?i)^[a-z][a-z0-9+.-]*://([^/:?#]+)"


def trigrams(text: str) -> np.ndarray:
    """Buckets of the character trigrams with a letter, lower-cased, white space and others as one blank."""
    codes = np.frombuffer(re.sub(r"[\W\d_]+", " ", f" {text.lower()} ").encode("utf-32-le"), np.uint32)
    if len(codes) < 3:
        return np.empty(0, np.uint32)
    mixed = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return mixed >> np.uint32(16)


class TextModel:
    """Log likelihood ratios of trigrams against an even spread, per language."""

    def __init__(self, languages: list[str], weights: np.ndarray):
        self.languages, self.weights = languages, weights  # (BUCKETS, languages) float32

    def gains(self, text: str) -> tuple[np.ndarray, int]:
        """(summed log likelihood ratio per language, trigrams)."""
        found = trigrams(text)
        if not len(found):
            return np.zeros(len(self.languages)), 0
        seen = np.bincount(found, minlength=BUCKETS).astype(np.float32) if len(found) > BUCKETS // 8 else None
        total = seen @ self.weights if seen is not None else self.weights[found].sum(axis=0)
        return total.astype(float), len(found)


def p_running(text: str) -> float:
    """The posterior that a text is running text, by its symbols; one without characters is by the prior alone."""
    symbols = sum(map(text.count, SYMBOLS))
    others = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")) - symbols
    odds = symbols * math.log(SYMBOL_IN_TEXT / SYMBOL_IN_JUNK) + others * math.log((1 - SYMBOL_IN_TEXT) / (1 - SYMBOL_IN_JUNK))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, TEMPER * odds + math.log((1 - JUNK) / JUNK)))))


def label_of(column: Column) -> Column:
    """A language label: lower case, without blanks around it; empty is null."""
    text = F.lower(F.trim(column.cast("string")))
    return F.when(text != "", text)


def fit_text_model(labelled: DataFrame, text: str = "text", label: str = "lang", sample: int = SAMPLE) -> TextModel:
    """Fit to at most ``sample`` rows of each label, the least by hash of the id; null labels are left out.

    Labels that differ in case are one. Beyond ``LANGUAGES`` labels, those with the fewest rows (of equals
    the last by name) are one label, ``OTHER``.
    """
    order = F.xxhash64("doc_id")
    rows = labelled.select(label_of(labelled[label]).alias("_label"), labelled[text].alias("_text"), order.alias("_order")).where("_label is not null")
    most = rows.groupBy("_label").agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "_label").limit(LANGUAGES + 1).collect()
    if len(most) > LANGUAGES:
        kept = [r["_label"] for r in most[: LANGUAGES - 1]]
        rows = rows.withColumn("_label", F.when(F.col("_label").isin(kept), F.col("_label")).otherwise(OTHER))
    # The hash below which a label has just `sample` rows; texts are read only for the rows below it.
    number = F.row_number().over(Window.partitionBy("_label").orderBy("_order"))
    least = rows.select("_label", "_order").withColumn("_number", number).where(F.col("_number") <= sample)
    limits = least.groupBy("_label").agg(F.max("_order").alias("_most")).collect()  # a row a label
    languages = sorted(r["_label"] for r in limits) or [UNKNOWN]
    chosen = F.lit(False)
    for r in limits:
        chosen = chosen | ((F.col("_label") == r["_label"]) & (F.col("_order") <= r["_most"]))
    counts = np.full((BUCKETS, len(languages)), 0.1, np.float64)
    for row in rows.where(chosen).orderBy("_order", "_text").limit(sample * len(languages)).toLocalIterator():
        counts[:, languages.index(row["_label"])] += np.bincount(trigrams(row["_text"] or ""), minlength=BUCKETS)
    even = np.log(1 / BUCKETS)
    return TextModel(languages, (np.log(counts / counts.sum(axis=0)) - even).astype(np.float32))


def text_evidence(documents: DataFrame, model: TextModel) -> DataFrame:
    """``documents`` without ``text``, with ``gains array<double>`` (tempered), ``trigrams``, ``gain``, and ``p_text``: how likely it is running text."""
    columns = [c for c in documents.columns if c != "text"]
    shared = documents.sparkSession.sparkContext.broadcast((model.languages, model.weights))

    def compute(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = TextModel(*shared.value)
        gains, sizes, best, running = [], [], [], []
        for text in texts_of(batch):
            g, n = own.gains(text)
            gains.append((TEMPER * g).tolist())
            sizes.append(n)
            best.append(float(g.max() / n) if n else 0.0)
            running.append(p_running(text))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in columns), pa.array(gains, pa.list_(pa.float64())), pa.array(sizes, pa.int64()), pa.array(best, pa.float64()), pa.array(running, pa.float64())],
            names=[*columns, "gains", "trigrams", "gain", "p_text"],
        )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields if f.name != "text")
    return map_batches(documents, compute, f"{kept}, gains array<double>, trigrams long, gain double, p_text double")


def identify(documents: DataFrame, model: TextModel, declared: Column, suffix: Column, host: Column, key: Column | None = None) -> DataFrame:
    """Per document: ``doc_id, language, posterior, text_language, p_text, accepted``, and ``key`` where a column for it is given.

    ``declared``, ``suffix`` and ``host`` are columns of ``documents``; null or unknown ones
    add no evidence, and documents without a host share one. A declaration names a language by its label or by
    a label with a region (``en-US``). Null and empty texts have no
    text evidence; with fewer than ``LEAST_TRIGRAMS`` trigrams, or if no language explains the
    text better than an even spread, the language is "und" and the document is rejected; so is one that
    is likelier junk than running text (``p_text``), whatever its language.
    Repeated rows get equal verdicts; an empty table gives no rows; other columns are not read.
    """
    prepare(documents.sparkSession)
    languages = model.languages
    read = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        label_of(declared).alias("declared"),
        label_of(suffix).alias("suffix"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.col("text").cast("string").alias("text"),
        *([] if key is None else [key.alias("key")]),
    )
    seen = materialize(text_evidence(read, model), "langid-text")
    known = (F.col("trigrams") >= LEAST_TRIGRAMS) & (F.col("gain") > LEAST_GAIN)
    names = F.array(*map(F.lit, languages))
    text_language = F.when(known, F.element_at(names, F.array_position("gains", F.array_max("gains")).cast("int"))).otherwise(UNKNOWN)
    seen = seen.withColumn("known", known).withColumn("text_language", text_language)

    # Counts by host, by suffix and over all: each level is the sum of the one below. Languages by number: labels can be any text.
    numbers = range(len(languages))
    ones = [F.sum((F.col("text_language") == one).cast("double")).alias(f"n{k}") for k, one in enumerate(languages)]
    hosts = materialize(seen.groupBy("host", "suffix").agg(*ones), "langid-hosts")
    suffixes = hosts.groupBy("suffix").agg(*(F.sum(f"n{k}").alias(f"s{k}") for k in numbers))
    total = hosts.agg(*(F.sum(f"n{k}") for k in numbers)).first()
    over = np.array([float(x or 0) for x in total]) + 1.0
    over /= over.sum()
    s_sum = sum((F.col(f"s{k}") for k in numbers), F.lit(0.0))
    suffix_prior = suffixes.select(
        F.col("suffix").alias("of_suffix"),
        *((F.col(f"s{k}") + F.lit(SUFFIX_WEIGHT * float(over[k]))).alias(f"s{k}") for k in numbers),
        (s_sum + F.lit(SUFFIX_WEIGHT)).alias("s_all"),
    )
    n_sum = sum((F.col(f"n{k}") for k in numbers), F.lit(0.0))
    priors = hosts.join(suffix_prior, F.col("suffix").eqNullSafe(F.col("of_suffix"))).select(
        F.col("host").alias("of_host"),
        "of_suffix",
        F.array(*(((F.col(f"n{k}") + F.lit(HOST_WEIGHT) * F.col(f"s{k}") / F.col("s_all")) / (n_sum + F.lit(HOST_WEIGHT))) for k in numbers)).alias("prior"),
    )
    priors = materialize(priors, "langid-priors")
    joined = seen.join(priors, (F.col("host") == F.col("of_host")) & F.col("suffix").eqNullSafe(F.col("of_suffix")), "left")

    def right(says: Column, one: str, p: float) -> Column:
        wrong = (1 - p) / max(1, len(languages) - 1)
        return F.when(~F.coalesce(says.isin(languages), F.lit(False)), F.lit(0.0)).when(says == one, F.lit(float(np.log(p)))).otherwise(F.lit(float(np.log(wrong))))

    base = F.regexp_extract("declared", "^[^-_]*", 0)
    says = F.when(F.col("declared").isin(languages), F.col("declared")).otherwise(base)
    stands = F.create_map(*[F.lit(x) for pair in SUFFIX_LANGUAGE.items() for x in pair])
    score = F.array(
        *(
            F.when(F.col("known"), F.col("gains")[k]).otherwise(F.lit(0.0))
            + right(says, one, DECLARED_RIGHT)
            + right(stands[F.col("suffix")], one, SUFFIX_RIGHT)
            + F.ln(F.greatest(F.lit(1e-12), F.coalesce(F.col("prior")[k], F.lit(float(over[k])))))
            for k, one in enumerate(languages)
        )
    )
    scored = joined.withColumn("score", score).withColumn("top", F.array_max("score"))
    posterior = F.lit(1.0) / F.aggregate("score", F.lit(0.0), lambda acc, s: acc + F.exp(s - F.col("top")))
    best = F.element_at(names, F.array_position("score", F.col("top")).cast("int"))
    return scored.select(
        "doc_id",
        F.when(F.col("known"), best).otherwise(UNKNOWN).alias("language"),
        posterior.alias("posterior"),
        "text_language",
        "p_text",
        (F.col("known") & (posterior >= LEAST_POSTERIOR) & (F.col("p_text") >= LEAST_POSTERIOR)).alias("accepted"),
        *([] if key is None else ["key"]),
    )


def identify_documents(documents: DataFrame, labelled: DataFrame | None = None, key: Column | None = None) -> DataFrame:
    """``identify`` for tables like ``documents``: ``lang`` is the declared language, ``source`` the host, and the
    address suffix that of ``source`` where it is a host name."""
    model = fit_text_model(documents if labelled is None else labelled)
    suffix = F.regexp_extract(documents["source"].cast("string"), _SUFFIX, 1)
    return identify(documents, model, documents["lang"], suffix, documents["source"], key)


def identify_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    """``identify`` for raw pages: language of the html element, suffix and host of the address, text without markup."""
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<[^>]*>", " ")
    host = F.lower(F.regexp_extract("url", _HOST, 1))
    read = pages.select(
        F.col("page_id").alias("doc_id"), text.alias("text"), F.regexp_extract("html", _HTML_LANG, 1).alias("declared"), host.alias("host"),
        F.regexp_extract(host, r"\.([a-z]+)$", 1).alias("suffix"),
    )
    return identify(read, model, read["declared"], read["suffix"], read["host"])


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all ``documents``."""
    return identify_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def language_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all ``pages``, by a text model of ``documents``."""
    model = fit_text_model(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return identify_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), model).withColumnRenamed("doc_id", "page_id")
