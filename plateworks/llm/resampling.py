"""Importance resampling towards a target distribution over hashed runs of words.

Pass one: every task counts runs of words in a trie of its own (``word_trie``) and gives its
buckets' totals, which are added up. A bucket's gain is the log ratio of its smoothed shares
in target and documents. Pass two walks each document's words along a trie whose nodes hold
their buckets' gains; the gains' sum, with a Gumbel value from the document's id, is the
score. The highest scores are drawn: sampling without replacement by importance. Their ranks
come from ranges of the score, so no task sorts all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import ordered_ranks
from .common import leave, materialize, prepare, table
from .word_trie import WordTrie, blocks

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
MIN_WORDS = 20
PERCENT = 10


def _bytes_of(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def bucket_totals(df: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How often runs of 1 to ``longest`` words fall into each bucket, over all texts: ``buckets`` numbers."""
    prepare(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = WordTrie(longest, buckets)
        try:
            for batch in batches:
                for block in blocks(_bytes_of(batch), longest):
                    trie.count_block(block)
            trie.fold()
            full = np.flatnonzero(trie.totals)
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(trie.totals[full], pa.int64())], names=["bucket", "n"])
        finally:
            leave()

    rows = df.select(F.col("text").cast("string")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    totals = np.zeros(buckets, np.int64)
    for row in rows:
        totals[row["bucket"]] = row["n"]
    return totals


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's share in the target over that in the source, both smoothed by one a bucket."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), float(len(source))
    ratio = [(t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000.0 * math.log(x)) for x in ratio], np.int64)


def gumbel(doc_id: str, seed: int = SEED) -> Column:
    """floor(1000 g) of a Gumbel value that depends on seed and id alone (null id: as an empty one)."""
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(F.lit(-1000.0) * F.log(-F.log((drawn.cast("double") + 0.5) / F.lit(4294967296.0)))).cast("long")


def importance(
    documents: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT
) -> DataFrame:
    """Per document ``doc_id, row_hash, n_words, n_features, weight, score, rank``: rank in the draw, null if undrawn.

    ``target`` has a ``text`` column as ``documents`` has. Null and empty texts have no features
    and weight zero; documents of fewer than ``min_words`` words are never drawn; a null id has
    one Gumbel value and comes first among equals; repeated rows count, score and are drawn as
    often as they come, and rows that differ in nothing but text are told apart by its hash. An
    empty ``documents`` gives no row, an empty ``target`` a target of equal shares. Columns other
    than ``doc_id`` and ``text`` are not read.
    """
    spark = prepare(documents.sparkSession)
    gained = gains(bucket_totals(documents, longest, buckets), bucket_totals(target, longest, buckets))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = WordTrie(longest, buckets, gained)
        single = WordTrie(1, 1) if longest == 1 else None
        try:
            for batch in batches:
                features, weight, words = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
                for block in blocks(_bytes_of(batch), longest):
                    trie.score_block(block, features, weight)
                    if single is None:
                        np.add.at(words, block.doc, np.subtract(block.end, block.fresh))
                words = features if single is not None else words
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_hash"), *(pa.array(x) for x in (words, features, weight))], names=["doc_id", "row_hash", "n_words", "n_features", "weight"])
        finally:
            leave()

    text = F.col("text").cast("string")
    read = documents.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("row_hash"), text.alias("text"))
    scored = read.mapInArrow(score, "doc_id long, row_hash long, n_words long, n_features long, weight long").withColumn("score", F.col("weight") + gumbel("doc_id", seed))
    scored = materialize(scored, "importance")
    able = F.col("n_words") >= min_words
    drawn = scored.where(able).count() * percent // 100
    order = [F.desc_nulls_last(F.when(able, F.col("score"))), F.asc("doc_id"), F.asc("weight"), F.asc("n_features"), F.asc("row_hash")]
    # Equal rows are told apart by where they stand, so that many of them are not one range.
    ranked = ordered_ranks(scored.withColumn("_row", F.monotonically_increasing_id()), [*order, F.asc("_row")]).drop("_row")
    return ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))


def resample(documents: DataFrame, target: DataFrame, **parameters) -> DataFrame:
    """The drawn rows of ``documents``, whole, with ``resample_score`` and ``resample_rank``; parameters as in ``importance``.

    Rows equal in id and text share their fate: all are returned, with the best rank, if one is drawn.
    """
    drawn = importance(documents, target, **parameters).where("rank is not null")
    drawn = drawn.groupBy(F.col("doc_id").alias("_d"), F.col("row_hash").alias("_h")).agg(F.max("score").alias("resample_score"), F.min("rank").alias("resample_rank"))
    alike = F.col("doc_id").cast("long").eqNullSafe(F.col("_d")) & F.xxhash64(F.col("text").cast("string")).eqNullSafe(F.col("_h"))
    return documents.join(drawn, alike).drop("_d", "_h")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` scored for a draw of a tenth towards the texts of ``benchmark``."""
    found = importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


#: Bytes of the reflected CRC-32 polynomial's table and the fold over a word's bytes, as SQL.
OP11_SQL = f"""
with recursive crc_table as (
  select b as b, b as v, 0 as k from range(256) t(b)
  union all
  select b, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, k + 1 from crc_table where k < 8
), lookup as (select list(v order by b) as t from crc_table where k = 8),
words_of as (
  select kind, rid, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w
  from (select 's' as kind, row_number() over () as rid, doc_id, text from documents union all select 't', row_number() over (), null, text from benchmark)
), bytes as (
  select w, [cast(('0x' || substr(h, cast(2 * i + 1 as bigint), 2)) as bigint) for i in range(length(h) // 2)] as bs
  from (select w, hex(encode(w)) as h from (select distinct w from words_of))
), hashed as (
  select w, xor(list_reduce(list_prepend(4294967295, bs), lambda a, x: xor(a >> 8, t[1 + (xor(a, x) & 255)])), 4294967295) % {BUCKETS} as bucket from bytes, lookup
), counts as (
  select bucket, count(*) filter (kind = 's') as s, count(*) filter (kind = 't') as t from words_of join hashed using (w) group by 1
), gains as (
  select bucket, cast(floor(1000 * ln((t + 1.0::double) * (ss + {BUCKETS}) / ((s + 1.0::double) * (tt + {BUCKETS})))) as bigint) as gain
  from counts, (select sum(s)::double as ss, sum(t)::double as tt from counts)
), weighed as (
  select rid, count(*) as n, sum(gain) as weight from words_of join hashed using (w) join gains using (bucket) where kind = 's' group by 1
), scored as (
  select d.rid, d.doc_id, coalesce(n, 0) as n, cast(coalesce(weight, 0) as bigint) as weight, cast(coalesce(weight, 0) as bigint)
    + cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256('{SEED}:' || coalesce(cast(d.doc_id as varchar), '')), 1, 8) as bigint) + 0.5::double) / 4294967296))) as bigint) as score
  from (select row_number() over () as rid, doc_id from documents) d left join weighed using (rid)
), placed as (
  select *, row_number() over (partition by n >= {MIN_WORDS} order by score desc, doc_id) as place, count(*) filter (n >= {MIN_WORDS}) over () as able from scored
)
select doc_id, cast(n as bigint) as n_features, weight, score, case when n >= {MIN_WORDS} and place <= able * {PERCENT} // 100 then place end as rank from placed
"""
