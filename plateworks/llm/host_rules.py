"""Quality rules by host: rule failures of documents, shrunken host rates, verdicts joined back.

Every document is tested by the rules below. Failures are summed by host; a beta prior for
each rule is fitted to all hosts' rates by moments (weighted by documents), and each host's
rate becomes the posterior Beta(failures + a, documents - failures + b). A host fails a rule
if even the posterior's lower bound (mean less ``SURE`` standard deviations) is over the
rule's limit, so a host with few documents is judged by what all hosts do. A document is
kept if it passes the base rule and its host fails no rule, or passes every rule itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, materialize, prepare, texts_of

MIN_WORDS = 50
SURE = 2.0
#: Rule -> (SQL condition for a failing document, host limit on the rate of failures).
RULES = {
    "base": ("base_failed", 0.5),
    "symbols": ("10 * n_symbols > n_words", 0.5),
    "lines": ("10 * n_dup_lines > 3 * n_lines", 0.5),
    "word_length": ("word_chars < 3 * n_words or word_chars > 12 * n_words", 0.5),
}
FEATURES = "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, first occurrences included."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = np.zeros(len(words), bool)
    at = np.flatnonzero(np.fromiter((counts[w] > 1 for w in windows), bool, len(windows)))
    for k in range(3):
        covered[at + k] = True
    return int(covered.sum())


def text_features(text: str) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of a whole text.

    Only lines with a word count as lines."""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
    )


def document_features(documents: DataFrame, host: str | Column = "source") -> DataFrame:
    """Counts of every whole text (null: no words) with its host (null hosts are one host)."""

    def compute(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = list(zip(*map(text_features, texts_of(batch))))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("host"), *(pa.array(r, pa.int64()) for r in rows)],
            names=["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"],
        )

    host = documents[host] if isinstance(host, str) else host
    read = documents.select(F.col("doc_id").cast("long"), F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.col("text").cast("string"))
    failed = f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words"
    return map_batches(read, compute, FEATURES).withColumn("base_failed", F.expr(failed))


#: Host limit on every rule for raw pages, of which there are plenty: hosts that are surely worse than one page in twenty go.
PAGE_LIMIT = 0.05


def host_verdicts(features: DataFrame, limit: float | None = None) -> DataFrame:
    """Per host: ``host, n_docs``, and for each rule its failures, shrunken rate, lower bound; ``host_failed``.

    ``limit`` takes the place of every rule's own. Moments are taken over hosts; if hosts do not differ more than chance would have it, the
    prior holds as much as all documents of an average host, at least two documents.
    """
    hosts = features.groupBy("host").agg(
        F.count("*").alias("n_docs"), *(F.sum(F.expr(rule).cast("long")).alias(f"{name}_failures") for name, (rule, _) in RULES.items())
    )
    moments = [F.count("*").alias("_k"), F.sum("n_docs").alias("_n"), F.sum(F.col("n_docs") * F.col("n_docs")).alias("_n2")]
    for name in RULES:
        share = F.col(f"{name}_failures") / F.col("n_docs")
        moments += [F.sum(f"{name}_failures").alias(f"_{name}_f"), F.sum(F.col("n_docs") * share * share).alias(f"_{name}_q")]
    hosts = materialize(hosts, "host-failures")
    seen = {k: float(v or 0) for k, v in hosts.agg(*moments).first().asDict().items()}  # one row of sums
    k, n = max(seen["_k"], 1.0), max(seen["_n"], 1.0)
    average = n / k
    out, failed = hosts, F.lit(False)
    for name, (_, own_limit) in RULES.items():
        mean = seen[f"_{name}_f"] / n
        spread = max(0.0, seen[f"_{name}_q"] / n - mean * mean)
        chance = mean * (1 - mean) * k / n
        between = max(0.0, (spread - chance) * n / max(1.0, n - seen["_n2"] / n))
        size = mean * (1 - mean) / between - 1 if between else average
        size = max(2.0, min(size, average))
        total = F.col("n_docs") + F.lit(size)
        rate = (F.col(f"{name}_failures") + F.lit(mean * size)) / total
        low = rate - F.lit(SURE) * F.sqrt(rate * (1 - rate) / (total + 1))
        out = out.withColumn(f"{name}_rate", rate).withColumn(f"{name}_low", low)
        failed = failed | (F.col(f"{name}_low") > (own_limit if limit is None else limit))
    return out.withColumn("host_failed", failed)


def judge(documents: DataFrame, host: str | Column = "source", limit: float | None = None) -> DataFrame:
    """Per document: its counts, ``base_failed``, ``own_failures`` (rules it fails), ``host_failed``, ``kept``.

    Null texts have no words and fail the base rule; null ids and repeated rows stay rows of
    their own; null hosts form one host. The verdict table has a row a host: whether it is
    broadcast is decided at run time by its size, and a hot host's documents are split else.
    """
    prepare(documents.sparkSession)
    features = materialize(document_features(documents, host), "host-features")
    verdicts = materialize(host_verdicts(features, limit), "host-verdicts").select("host", "host_failed")
    own = sum((F.expr(rule).cast("int") for rule, _ in RULES.values()), F.lit(0))
    judged = features.join(verdicts, "host", "left").withColumn("own_failures", own)
    kept = ~F.col("base_failed") & (~F.coalesce("host_failed", F.lit(False)) | (F.col("own_failures") == 0))
    return judged.withColumn("kept", kept)


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all ``documents`` with ``source`` as host."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_failed", "own_failures"
    )


#: A page's text: scripts and styles go, every other tag is a line end, entities stay. Its host is that of the address, in lower case.
_HIDDEN, _TAG, _HOST = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>", r"(?s)<[^>]*>", r"(?i)^[a-z][a-z0-9+.-]*://([^/:?#]+)"


def judge_pages(pages: DataFrame) -> DataFrame:
    """``judge`` for raw pages: ``page_id`` as id, hosts from addresses, texts without markup. Null addresses and markup are as in ``judge``."""
    text = F.regexp_replace(F.regexp_replace("html", _HIDDEN, " "), _TAG, "\n")
    read = pages.select(F.col("page_id").alias("doc_id"), text.alias("text"), F.lower(F.regexp_extract("url", _HOST, 1)).alias("host"))
    return judge(read, "host", PAGE_LIMIT).withColumnRenamed("doc_id", "page_id")


def host_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all ``pages`` with the address' host as host."""
    return judge_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "n_words", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_failed", "own_failures")


def _verdict_sql(source: str = "select doc_id, source, text from documents", limit: float = 0.5) -> str:
    """The verdicts' SQL over the rows of ``source`` (doc_id, source, text), one block a rule."""
    rules = {"base": "base_failed", "symbols": "10 * n_symbols > n_words", "lines": "10 * n_dup_lines > 3 * n_lines", "word_length": "word_chars < 3 * n_words or word_chars > 12 * n_words"}
    marks = ", ".join(f"cast({r} as integer) as f_{n}" for n, r in rules.items())
    sums = ", ".join(f"sum(f_{n}) as f_{n}" for n in rules)
    pooled = ", ".join(f"sum(f_{n}) / n as m_{n}, greatest(0, sum(f_{n} * f_{n} / cast(n_docs as double)) / n - (sum(f_{n}) / n) * (sum(f_{n}) / n)) as s_{n}" for n in rules)
    between = ", ".join(f"greatest(0, (s_{n} - m_{n} * (1 - m_{n}) * k / n) * n / greatest(1, n - n2 / n)) as b_{n}" for n in rules)
    sizes = ", ".join(f"greatest(2, least(n / k, case when b_{n} > 0 then m_{n} * (1 - m_{n}) / b_{n} - 1 else n / k end)) as z_{n}" for n in rules)
    rate = lambda n: f"((h.f_{n} + m_{n} * z_{n}) / (n_docs + z_{n}))"
    failed = " or ".join(f"{rate(n)} - 2.0 * sqrt({rate(n)} * (1 - {rate(n)}) / (n_docs + z_{n} + 1)) > {limit}" for n in rules)
    return f"""
with texts as (
  select row_number() over () as rid, doc_id, coalesce(source, '') as host, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws from ({source})
), windows as (
  select rid, i, count(*) over (partition by rid, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) as c
  from (select rid, ws, unnest(range(1, len(ws) - 1)) as i from texts where len(ws) > 2)
), repeats as (
  select rid, count(distinct i + k) as n from (select rid, i, unnest([0, 1, 2]) as k from windows where c > 1) group by 1
), counts as (
  select rid, doc_id, host, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from texts
), features as (
  select c.*, len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words,
    n_words < 50 or 100 * coalesce(r.n, 0) > 50 * n_words as base_failed from counts c left join repeats r using (rid)
), marked as (select *, {marks} from features),
hosts as (select host, count(*) as n_docs, {sums} from marked group by 1),
pooled as (select k, n, n2, {pooled} from hosts, (select count(*) as k, cast(sum(n_docs) as double) as n, cast(sum(n_docs * n_docs) as double) as n2 from hosts) group by k, n, n2),
spread as (select *, {between} from pooled), prior as (select *, {sizes} from spread),
verdicts as (select host, {failed} as host_failed from hosts h, prior)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
  cast(n_repeat_words as bigint) as n_repeat_words, base_failed, not base_failed and (not host_failed or f_base + f_symbols + f_lines + f_word_length = 0) as kept,
  host_failed, f_base + f_symbols + f_lines + f_word_length as own_failures
from marked join verdicts using (host)
"""


OP8_SQL = _verdict_sql()
PAGES_SQL = "select doc_id as page_id, host, n_words, n_dup_lines, n_repeat_words, base_failed, kept, host_failed, own_failures from (" + _verdict_sql(
    f"""select page_id as doc_id, lower(regexp_extract(coalesce(url, ''), '{_HOST}', 1)) as source, regexp_replace(regexp_replace(html, '{_HIDDEN}', ' ', 'g'), '{_TAG}', chr(10), 'g') as text from pages""",
    PAGE_LIMIT,
).replace("select doc_id, cast(n_words", "select doc_id, host, cast(n_words") + ")"
