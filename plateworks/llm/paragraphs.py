"""Substring dedup: paragraphs that repeat across documents, exactly or nearly.

A paragraph is a line (ended by a line feed) of ``LEAST_WORDS`` words or more, or shorter
lines in a row that have so many together; the set of its 5-word shingles is sketched, paragraphs that share a band fall together, and pairs are
verified by exact Jaccard similarity (see ``minhash``). Paragraphs linked, directly or over
others, are one cluster; a cluster that occurs in two documents or more is a repeat, of
which the first occurrence (by document id, then place) stays.

A passage is a maximal run of ``RUN_WORDS`` words or more that is found word by word in
another document, wherever lines begin and end. Every run of ``RUN_WORDS`` words has an anchor, the
smallest hash of its ``ANCHOR_WORDS``-word runs, which depends on these words alone; runs
whose anchor occurs in two documents are compared by hash. Words, runs and paragraphs are
told by 64-bit hashes: among 10^11 paragraphs a few hundred would be taken for equal by chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import minhash, wordstream
from .common import FILTER_BITS, discard, hashed_place, id_filter, in_filter, map_batches, materialize, no_filter, prepare, release, tidy

LEAST_WORDS = 40
PERCENT = 75
RECALL = 0.9998
BANDS, ROWS = minhash.tune_bands(PERCENT / 100, RECALL)

FOUND = f"doc_id long, paragraph int, begin int, finish int, id long, {minhash.SKETCHED}"

RUN_WORDS = 50
ANCHOR_WORDS = 25
#: Runs in a row that are carried together.
RUNS = 64
CLASS_PASSAGES = "class long, pos int, until int, start int, end int, cluster_id long, first_doc_id long"


class Paragraphs:
    """The paragraphs of a batch of texts: ``text``, ``index`` (of the first line among the text's
    non-empty ones), ``begin`` and ``finish`` (code points), words ``a`` to ``b``, and ``id``,
    a hash of the words, so that paragraphs with equal words are one.

    A line with enough words is a paragraph. Shorter lines that follow each other are joined
    until they have enough; what is left over before a long line or the end is none.
    """

    def __init__(self, words: wordstream.Words, least: int):
        data, at = words.data, words.at
        starts = np.unique(np.concatenate([at[:-1], np.flatnonzero(data == 10) + 1]))
        starts = starts[starts < len(data)]
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        ends = ends - (data[ends - 1] == 10)
        full = ends > starts
        starts, ends = starts[full], ends[full]
        owner = np.searchsorted(at, starts, "right") - 1
        number = np.arange(len(starts)) - np.searchsorted(owner, owner)
        first, last = np.searchsorted(words.begins, starts), np.searchsorted(words.begins, ends)
        spans, held, begin, before = [], 0, 0, -1
        for k, (text, n) in enumerate(zip(owner.tolist(), (last - first).tolist())):
            if text != before:
                held, before = 0, text
            if n >= least:
                held = 0
                spans.append((k, k))
                continue
            if not held:
                begin = k
            held += n
            if held >= least:
                spans.append((begin, k))
                held = 0
        x, y = np.array(spans, np.int64).reshape(-1, 2).T
        self.text, self.index, self.a, self.b = owner[x], number[x], first[x], last[y]
        self.begin, self.finish = words.points(starts[x], self.text), words.points(ends[y], self.text)
        self.id = wordstream.ordered_hash(words.hashes, self.a, self.b)


def repeated_paragraphs(documents: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """One row for each occurrence of a repeat: ``doc_id, paragraph, start, end, cluster_id, first_doc_id, removed``.

    ``start`` and ``end`` are code points of the text. Null and empty texts have no
    paragraphs; rows without ``doc_id`` are left out, as an id names the first holder;
    repeated rows of one id are one document. Only ``doc_id`` and ``text`` are read.
    """
    prepare(documents.sparkSession)
    read = documents.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def find(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = wordstream.Words(batch.column("text"))
        found = Paragraphs(words, least)
        # A repeat within the batch carries no sketch.
        kinds, at = np.unique(found.id, return_index=True)
        flat, offsets = wordstream.shingle_sets(words.hashes, found.a[at], found.b[at], minhash.WIDTH)
        sketched = minhash.sketch_columns(flat, offsets, BANDS, ROWS)
        take = np.full(len(found.id), -1)
        take[at] = np.arange(len(at))
        taken = pa.array(take, pa.int64(), mask=take < 0)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(found.text)), pa.array(found.index, pa.int32()), pa.array(found.begin, pa.int32()), pa.array(found.finish, pa.int32()),
                pa.array(found.id), *(c.take(taken) for c in sketched),
            ],
            names=["doc_id", "paragraph", "begin", "finish", "id", "n", "keys", "rest", "sketch"],
        )

    found = materialize(map_batches(read, find, FOUND), "paragraphs")
    distinct = materialize(found.where("keys is not null").select("id", "n", "keys", "rest", "sketch").dropDuplicates(["id"]), "paragraphs-distinct")
    linked = minhash.linked_classes(distinct, lambda ids, bits: _sets(read, ids, bits, least), ROWS, percent, "paragraphs", hashed_place, shallower=False)

    first = F.struct("doc_id", "paragraph")
    kinds = found.groupBy("id").agg(F.min(first).alias("first"), F.max("doc_id").alias("last"))
    kinds = kinds.join(linked, "id", "left").withColumn("cluster_id", F.coalesce("component", "id"))
    clusters = kinds.groupBy("cluster_id").agg(F.min("first").alias("of"), F.max("last").alias("until")).where("of.doc_id < until")
    repeats = materialize(kinds.select("id", "cluster_id").join(clusters.select("cluster_id", "of"), "cluster_id"), "paragraphs-repeats")
    return found.join(repeats, "id").select(
        "doc_id",
        "paragraph",
        F.col("begin").alias("start"),
        F.col("finish").alias("end"),
        "cluster_id",
        F.col("of.doc_id").alias("first_doc_id"),
        ((F.col("doc_id") != F.col("of.doc_id")) | (F.col("paragraph") != F.col("of.paragraph"))).alias("removed"),
    )


def _sets(documents: DataFrame, ids: DataFrame, bits: bytes, least: int) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(bits)

    def compute(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = wordstream.Words(batch.column("text"))
        found = Paragraphs(words, least)
        own, at = np.unique(found.id, return_index=True)
        good = in_filter(shared.value, np.mod(own, FILTER_BITS))
        own, at = own[good], at[good]
        flat, offsets = wordstream.shingle_sets(words.hashes, found.a[at], found.b[at], minhash.WIDTH)
        yield pa.RecordBatch.from_arrays([pa.array(own), wordstream.binaries(flat, offsets)], names=["id", "shingles"])

    return map_batches(documents, compute, "id long, shingles binary").join(ids, "id", "left_semi").dropDuplicates(["id"])


class Runs:
    """Every run of ``RUN_WORDS`` words of a batch of texts: its first word (``at``), its ``text``, its
    hash (``whole``) and its ``anchor``, the smallest hash of its ``ANCHOR_WORDS``-word runs."""

    def __init__(self, words: wordstream.Words):
        left = np.repeat(words.first[1:], np.diff(words.first)) - np.arange(len(words.hashes))
        self.at = np.flatnonzero(left >= RUN_WORDS)
        self.text = np.searchsorted(words.first, self.at, "right") - 1
        short = wordstream.mixed(_windows(words.hashes, ANCHOR_WORDS))
        reach = RUN_WORDS - ANCHOR_WORDS
        low = _sliding_least(short, reach + 1)
        self.whole = wordstream.mixed(short[self.at] * wordstream.STEP + short[self.at + reach]).view(np.int64) if len(self.at) else self.at
        self.anchor = low[self.at].view(np.int64) if len(self.at) else self.at
        cut = (self.at[1:] != self.at[:-1] + 1) | (self.text[1:] != self.text[:-1]) | (self.anchor[1:] != self.anchor[:-1])
        #: Where the anchor changes: one group of runs begins.
        self.groups = np.flatnonzero(np.concatenate([[True], cut])) if len(self.at) else self.at


def _windows(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` neighbours, put together from those of powers of two."""
    n = max(len(h) - size + 1, 0)
    out, done, part, width = np.zeros(n, np.uint64), 0, h, 1
    while done < size:
        if size & width:
            out = out * (wordstream.STEP + np.uint64(2 * width)) + part[done : done + n]
            done += width
        if done < size:
            part = part[: max(len(part) - width, 0)] * (wordstream.STEP + np.uint64(4 * width)) + part[width:]
            width *= 2
    return out


def _sliding_least(x: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` neighbours."""
    n, width = max(len(x) - size + 1, 0), 1
    while 2 * width <= size:
        x = np.minimum(x[: max(len(x) - width, 0)], x[width:])
        width *= 2
    return np.minimum(x[:n], x[size - width : size - width + n])


def repeated_passages(documents: DataFrame) -> DataFrame:
    """One row for each passage: ``doc_id, pos, until, start, end, cluster_id, first_doc_id``.

    ``pos`` and ``until`` are words of the text, ``start`` and ``end`` code points. ``first_doc_id`` is
    the smallest id that holds its words; a run whose parts have different first holders is
    one row for each. ``cluster_id`` is the hash of its first ``RUN_WORDS`` words. Rows without ``doc_id`` are left out.

    Equal texts are one class, of which two documents (of the smallest and the largest id) are compared with
    others. Each copy has its whole text as a passage, and besides the parts that a smaller id holds.
    Runs with an anchor in two classes are grouped by content and then by run, both with
    partial sums, so that a passage that very many documents share is a row a task.
    """
    spark = prepare(documents.sparkSession)
    kept = documents.where("doc_id is not null and text is not null")
    read = kept.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    read = read.withColumn("class", F.xxhash64("text"))
    named = materialize(read.select("doc_id", "class"), "passages-classes")
    copies = named.groupBy("class").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    copies = materialize(copies, "passages-copies")
    # The copies in between are left out by a filter; documents that it would leave out by chance are named by another.
    pair = F.pmod(F.xxhash64("doc_id", "class"), F.lit(FILTER_BITS)).cast("int").alias("pair")
    placed = named.join(copies, "class", "left").select(pair, F.coalesce(F.expr("doc_id <> low and doc_id <> high"), F.lit(False)).alias("between"))
    placed = materialize(placed, "passages-places")
    between, back, many = no_filter(), no_filter(), no_filter()
    if not copies.isEmpty():
        gone = placed.where("between").select("pair").distinct()
        between = id_filter(gone, "pair", F.col)
        back = id_filter(placed.where("not between").join(gone, "pair", "left_semi"), "pair", F.col)
        many = id_filter(copies, "class", hashed_place)
    shared = spark.sparkContext.broadcast((between, back, many))
    read = read.select("doc_id", "class", "text", pair)

    def compared(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = batch.column("pair").to_numpy()
        return batch.filter(pa.array(~in_filter(shared.value[0], place) | in_filter(shared.value[1], place)))

    def anchors(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        batch = compared(batch)
        found = Runs(wordstream.Words(batch.column("text")))
        yield pa.RecordBatch.from_arrays([pa.array(found.anchor[found.groups]), batch.column("class").take(pa.array(found.text[found.groups]))], names=["id", "class"])

    seen = map_batches(read, anchors, "id long, class long").groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("b"))
    # Lets through too much at most: what counts is the comparison below.
    met = spark.sparkContext.broadcast(id_filter(seen.where("a < b").select("id"), place=hashed_place))
    tidy(spark)

    def runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        batch = compared(batch)
        words = wordstream.Words(batch.column("text"))
        found = Runs(words)
        ends = np.append(found.groups[1:], len(found.at))
        good = in_filter(met.value, np.mod(found.anchor[found.groups], FILTER_BITS))
        begin, size = found.groups[good], (ends - found.groups)[good]
        parts = -(-size // RUNS)  # long groups (repetitive text) in parts
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.repeat(begin, parts) + RUNS * nth
        size = np.minimum(np.repeat(size, parts) - RUNS * nth, RUNS)
        cuts = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(begin - cuts[:-1], size) + np.arange(cuts[-1])
        word, text = found.at[at], found.text[at]
        owner = found.text[begin]
        # A row more for each text that may have copies: its whole, with its number of words.
        n = np.diff(words.first)
        whole = np.flatnonzero((n >= RUN_WORDS) & in_filter(shared.value[2], np.mod(batch.column("class").to_numpy(), FILTER_BITS)))
        at = np.concatenate([at, np.searchsorted(found.at, words.first[whole])])
        last = np.concatenate([word + RUN_WORDS, words.first[whole + 1]]) - 1
        word, text = np.concatenate([word, words.first[whole]]), np.concatenate([text, whole])
        cuts = np.concatenate([cuts, cuts[-1] + 1 + np.arange(len(whole))])
        lists = (found.whole[at], words.points(words.begins[word], text).astype(np.int32), words.points(words.ends[last], text).astype(np.int32))
        pos = np.concatenate([found.at[begin] - words.first[owner], np.zeros(len(whole), np.int64)])
        owner = pa.array(np.concatenate([owner, whole]))
        until = pa.array(np.concatenate([np.zeros(len(begin), np.int64), n[whole]]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(owner), batch.column("class").take(owner), pa.array(pos.astype(np.int32)), until,
                *(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x)) for x in lists),
            ],
            names=["doc_id", "class", "pos", "until", "runs", "starts", "ends"],
        )

    held = map_batches(read, runs, "doc_id long, class long, pos int, until int, runs array<long>, starts array<int>, ends array<int>")
    held = materialize(held.withColumn("content", F.xxhash64("runs")), "passages-runs")
    contents = held.where("until = 0").groupBy("content", "runs").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    contents = materialize(contents, "passages-contents")
    tidy(spark)
    firsts = contents.select(F.explode("runs").alias("run"), "low", "high").groupBy("run").agg(F.min("low").alias("first"), F.max("high").alias("last"))
    firsts = materialize(firsts.where("first < last").select("run", "first"), "passages-firsts")
    tidy(spark)
    # At most ``RUNS`` entries a content.
    hits = contents.select("content", F.posexplode("runs").alias("k", "run")).join(firsts, "run").select("content", F.struct("k", "first").alias("hit"))
    hits = hits.groupBy("content").agg(F.sort_array(F.collect_set("hit")).alias("hits"))
    hits = materialize(hits.select("content", F.col("hits.k").alias("ks"), F.col("hits.first").alias("firsts")), "passages-hits")
    discard(contents)
    discard(firsts)
    tidy(spark)

    def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        k, first = (batch.column(c) for c in ("ks", "firsts"))
        size = np.diff(k.offsets.to_numpy())
        k, first = k.flatten().to_numpy(), first.flatten().to_numpy()
        lists = [batch.column(c) for c in ("runs", "starts", "ends")]
        base = lists[0].offsets.to_numpy()[:-1]
        at = np.repeat(base - base[0], size) + k
        run, start, end = (x.flatten().to_numpy()[at] for x in lists)
        doc = np.repeat(batch.column("class").to_numpy(), size)
        pos = np.repeat(batch.column("pos").to_numpy(), size) + k
        cut = (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1) | (first[1:] != first[:-1])
        x = np.flatnonzero(np.concatenate([[True], cut]))
        y = np.append(x[1:], len(doc)) - 1
        yield _passage_batch(doc[x], pos[x], pos[y] + RUN_WORDS, start[x], end[y], run[x], first[x])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "class"):
            doc, pos, until, start, end, run, first = (part.column(c).to_numpy() for c in ("class", "pos", "until", "start", "end", "cluster_id", "first_doc_id"))
            cut = (doc[1:] != doc[:-1]) | (first[1:] != first[:-1]) | (pos[1:] > until[:-1] - RUN_WORDS + 1)
            x = np.flatnonzero(np.concatenate([[True], cut]))
            y = np.append(x[1:], len(doc)) - 1
            yield _passage_batch(doc[x], pos[x], until[y], start[x], end[y], run[x], first[x])

    found = held.where("until = 0").join(hits, "content").select("class", "pos", "runs", "starts", "ends", "ks", "firsts")
    # Two documents of a class give the same pieces.
    parts = map_batches(found, pieces, CLASS_PASSAGES).distinct().repartition("class").sortWithinPartitions("class", "pos").mapInArrow(merge, CLASS_PASSAGES)
    low = copies.select("class", F.col("low").alias("first_doc_id"))
    parts = parts.join(low, ["class", "first_doc_id"], "left_anti")
    wholes = held.where("until > 0").select("class", "pos", "until", F.col("starts")[0].alias("start"), F.col("ends")[0].alias("end"), F.col("runs")[0].alias("cluster_id"))
    by_class = materialize(parts.unionByName(wholes.distinct().join(low, "class")), "passages-by-class")
    discard(held)
    discard(hits)
    tidy(spark)
    return by_class.join(named.distinct(), "class").select("doc_id", "pos", "until", "start", "end", "cluster_id", "first_doc_id")


def _passage_batch(*columns: np.ndarray) -> pa.RecordBatch:
    types = (np.int64, np.int32, np.int32, np.int32, np.int32, np.int64, np.int64)
    names = ["class", "pos", "until", "start", "end", "cluster_id", "first_doc_id"]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(columns, types)], names=names)


def whole_groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The batches of a partition sorted by ``column``, cut where its value changes."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(column).to_numpy()
        if kept and kept[-1].column(column)[-1].as_py() != key[0]:
            yield pa.Table.from_batches(kept)
            kept = []
        at = int(np.searchsorted(key, key[-1]))
        if at:
            yield pa.Table.from_batches([*kept, batch.slice(0, at)])
            kept = []
        kept.append(batch.slice(at))
    if kept:
        yield pa.Table.from_batches(kept)
    release()


def repeats(documents: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """``repeated_paragraphs``, and with ``paragraph`` null the passages that lie in none of these."""
    passages = materialize(repeated_passages(documents), "passages")
    tidy(documents.sparkSession)
    found = materialize(repeated_paragraphs(documents, percent, least), "paragraphs-found")
    p, q = passages.alias("p"), found.alias("q")
    inside = F.expr("p.doc_id = q.doc_id and p.start >= q.start and p.end <= q.end and (q.removed or p.first_doc_id = p.doc_id)")
    rest = p.join(q, inside, "left_anti").select(
        "doc_id", F.lit(None).cast("int").alias("paragraph"), "start", "end", "cluster_id", "first_doc_id", (F.col("doc_id") != F.col("first_doc_id")).alias("removed")
    )
    return found.unionByName(rest)


def without_repeats(documents: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """``documents`` with removed paragraphs (and their line feeds) and passages cut out of ``text``; columns unchanged.

    What is repeated stays in the document of the smallest id that holds it. Rows without id stay as they are;
    rows of one id are cut alike.
    """
    end = F.col("end") + F.when(F.col("paragraph").isNotNull(), 1).otherwise(0)  # with its line feed
    spans = (
        repeats(documents, percent, least).where("removed")
        .groupBy(F.col("doc_id").alias("_cut_doc")).agg(F.sort_array(F.collect_set(F.struct("start", end.alias("end")))).alias("_cuts"))
    )
    joined = documents.join(spans, documents["doc_id"] == spans["_cut_doc"], "left").drop("_cut_doc")
    at, cuts = joined.columns.index("text"), len(joined.columns) - 1

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = []
        for text, gone in zip(batch.column(at).to_pylist(), batch.column(cuts).to_pylist()):
            if text is not None and gone:
                parts, begin = [], 0
                for span in gone:
                    if span["start"] > begin:
                        parts.append(text[begin : span["start"]])
                    begin = max(begin, min(len(text), span["end"]))
                text = "".join([*parts, text[begin:]])
            texts.append(text)
        columns = list(batch.columns[:-1])
        columns[at] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return map_batches(joined, cut, documents.schema)


def op3_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated paragraphs and passages of all ``documents``."""
    return repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
