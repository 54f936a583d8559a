"""Alignment of two tokenizers' tokens by the bytes they cover.

Both tokenizers' ends are cumulative sums of token lengths; ends that both have cut a text
into groups; a token of one and a token of the other whose bytes overlap are a link. Counts
of linked id pairs are summed in each task, then by a salted and a plain shuffle. Pairs with
the highest counts, a bounded number, go to every executor; the others' links, rare by then,
are joined to their counts by a shuffle, which no frequent pair can make uneven.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import discard, leave, materialize, prepare, table

#: Text bytes that are aligned at a time; a longer text is aligned by itself.
BLOCK_BYTES = 1 << 18
#: Distinct pairs that a task holds before it passes them on.
TASK_PAIRS = 1 << 20
#: Pairs that every executor gets (13 bytes each): those with the highest counts.
BROADCAST_PAIRS = 1 << 21
#: Parts of the first of the two shuffles that sum a pair's counts.
SALTS = 16

ENCODED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a_ids binary, b_ids binary, pairs binary, counts binary"
PAIRS = "pair long, n long, salt int"
SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, row long, n_best long, count_sum long, rare_pairs binary, rare_links binary"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Aligner:
    """Both tokenizers with their tokens' bytes."""

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece

        self.code = tokens.encoder(byte_level)
        self.model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters = {letter: byte for byte, letter in tokens._byte_letters().items()}
        vocabulary = self.code.tokenizer.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.a_bytes[k] = bytes(letters[x] for x in token) if all(x in letters for x in token) else token.encode()
        size = self.model.get_piece_size()
        names = [self.model.id_to_piece(k) for k in range(size)]
        self.b_bytes = [bytes([int(x[3:5], 16)]) if self.model.is_byte(k) else x.replace("▁", " ").encode() for k, x in enumerate(names)]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # Decimal ids with what follows them in a group's writing, padded with zero bytes, and their lengths.
        written = [f"{k}{mark}".encode() for n, marks in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for mark in marks for k in range(n)]
        self.written, self.written_size = np.array(written), np.array([len(x) for x in written])

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of every text by both; none where a tokenizer's bytes are not those of the text after a blank."""
        a = [np.frombuffer(self.code.encode(" " + t), "<u4") if t else np.empty(0, np.uint32) for t in texts]
        b = [np.array(x, np.uint32) for x in self.model.encode(texts, num_threads=1)] if texts else []
        for k, text in enumerate(texts):
            whole = b" " + text.encode()
            # Byte-level tokens are the text's bytes in their order, if the vocabulary has them all: then none is missing.
            if not text or self.a_size[a[k]].sum() != len(whole) or b"".join(map(self.b_bytes.__getitem__, b[k].tolist())) != whole:
                a[k] = b[k] = np.empty(0, np.uint32)
        return a, b


@functools.lru_cache(maxsize=2)
def aligner(byte_level: str, pieces: str) -> Aligner:
    return Aligner(byte_level, pieces)


@dataclass
class Aligned:
    """Tokens of several texts, one text after another, cut into groups and linked."""

    a: np.ndarray  # ids
    b: np.ndarray
    a_group: np.ndarray  # the group that each token is in
    b_group: np.ndarray
    links_a: np.ndarray  # places in a and b of every link's tokens, by a
    links_b: np.ndarray
    n_groups: int


def align(tools: Aligner, a: np.ndarray, b: np.ndarray) -> Aligned:
    """Groups and links of two token rows over the same bytes."""
    a_end, b_end = np.cumsum(tools.a_size[a]), np.cumsum(tools.b_size[b])
    a_begin = a_end - tools.a_size[a]
    cuts = np.intersect1d(a_end, b_end, assume_unique=True)
    first = np.searchsorted(b_end, a_begin, side="right")
    partners = np.searchsorted(b_end, a_end, side="left") - first + 1
    links_a = np.repeat(np.arange(len(a)), partners)
    links_b = np.arange(len(links_a)) + np.repeat(first - (np.cumsum(partners) - partners), partners)
    return Aligned(a, b, np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end), links_a, links_b, len(cuts))


def writings(tools: Aligner, found: Aligned, a_cuts: np.ndarray, b_cuts: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of every text; texts begin at ``a_cuts`` and ``b_cuts``."""
    n_a, n_b = len(tools.a_bytes), len(tools.b_bytes)
    last = lambda group: np.append(group[1:] != group[:-1], True) if len(group) else np.empty(0, bool)
    # A group's tokens of A come before its tokens of B, and these before the next group.
    a_place = np.arange(len(found.a)) + np.searchsorted(found.b_group, found.a_group, side="left")
    b_place = np.arange(len(found.b)) + np.searchsorted(found.a_group, found.b_group, side="right")
    parts = np.empty(len(found.a) + len(found.b), np.int64)
    parts[a_place] = found.a + n_a * last(found.a_group)
    parts[b_place] = 2 * n_a + found.b + n_b * last(found.b_group)
    flat = tools.written[parts].tobytes().translate(None, b"\0")
    cuts = np.concatenate([[0], np.cumsum(tools.written_size[parts])])[a_cuts + b_cuts].tolist()
    return [flat[x : max(x, y - 1)] for x, y in zip(cuts[:-1], cuts[1:])]


def _blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of texts of up to ``BLOCK_BYTES``."""
    begin = held = 0
    for k, size in enumerate(sizes):
        if held and held + size > BLOCK_BYTES:
            yield begin, k
            begin, held = k, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


class PairCounts:
    """Counts of id pairs that a task has seen, sorted by pair."""

    def __init__(self):
        self.pair, self.n, self.new = np.empty(0, np.int64), np.empty(0, np.int64), []

    def add(self, pairs: np.ndarray) -> None:
        self.new.append(np.unique(pairs, return_counts=True))
        if sum(len(p) for p, _ in self.new) >= TASK_PAIRS // 2:
            self.merge()

    def merge(self) -> None:
        pair, where = np.unique(np.concatenate([self.pair, *(p for p, _ in self.new)]), return_inverse=True)
        n = np.zeros(len(pair), np.int64)
        np.add.at(n, where, np.concatenate([self.n, *(n for _, n in self.new)]))
        self.pair, self.n, self.new = pair, n, []

    def passed_on(self, at_least: int = 1) -> Iterator[pa.RecordBatch]:
        """A row with all counts so far, which are then forgotten, if there are ``at_least`` so many."""
        if len(self.pair) >= at_least:
            row = [pa.array([None], pa.int64())] * 5 + [pa.array([None], pa.string())] + [pa.array([None], pa.binary())] * 2 + [pa.array([x.tobytes()], pa.binary()) for x in (self.pair, self.n)]
            self.pair, self.n = np.empty(0, np.int64), np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(row, names=[x.split()[0] for x in ENCODED.split(", ")])


def encode_pairs(documents: DataFrame, byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """Pass one, written to the shared folder: a row a document with its tokens, groups and links, and rows of pair counts.

    Rows of pair counts have ``pairs`` and ``counts``, and nothing else.
    """
    spark = prepare(documents.sparkSession)
    byte_level, pieces = byte_level or tokens.default_tokenizer(), pieces or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, counts = aligner(byte_level, pieces), PairCounts()
        narrow = lambda ids: ids.astype("<u2" if max(len(tools.a_bytes), len(tools.b_bytes)) <= 1 << 16 else "<u4").tobytes()
        try:
            for batch in batches:
                text_column, doc_ids = batch.column("text"), batch.column("doc_id")
                for x, y in _blocks(pc.fill_null(pc.binary_length(text_column), 0).to_pylist()):
                    a, b = tools.encode([t or "" for t in text_column[x:y].to_pylist()])
                    a_cuts, b_cuts = (np.concatenate([[0], np.cumsum([len(i) for i in ids])]) for ids in (a, b))
                    found = align(tools, np.concatenate(a), np.concatenate(b))
                    counts.add(found.a[found.links_a].astype(np.int64) << 32 | found.b[found.links_b])
                    n_groups = np.searchsorted(np.append(found.a_group, found.n_groups), np.arange(found.n_groups))  # a group's first token
                    links = np.searchsorted(found.links_a, a_cuts)
                    shas = [hashlib.sha256(w).hexdigest() if w else "" for w in writings(tools, found, a_cuts, b_cuts)]
                    whole = [np.diff(a_cuts), np.diff(b_cuts), np.diff(np.searchsorted(n_groups, a_cuts)), np.diff(links)]
                    rows = [doc_ids[x:y], *(pa.array(v, pa.int64()) for v in whole), pa.array(shas, pa.string()), pa.array(map(narrow, a), pa.binary()), pa.array(map(narrow, b), pa.binary())]
                    yield pa.RecordBatch.from_arrays([*rows, pa.nulls(y - x, pa.binary()), pa.nulls(y - x, pa.binary())], names=[c.split()[0] for c in ENCODED.split(", ")])
                    yield from counts.passed_on(TASK_PAIRS)
            if counts.new:
                counts.merge()
            yield from counts.passed_on()
        finally:
            leave()

    read = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # The row's number is taken when the table is read, where it depends on the files alone.
    return materialize(read.mapInArrow(run, ENCODED), "alignment-tokens")


def pair_table(encoded: DataFrame) -> DataFrame:
    """``a_id, b_id, pair, n, best``: links of each id pair, and whether no pair with the same B id has more. Written."""

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (pair, n) in enumerate(zip(batch.column("pairs"), batch.column("counts"))):
                pair, n = np.frombuffer(pair.as_buffer(), np.int64), np.frombuffer(n.as_buffer(), np.int64)
                for at in range(0, len(pair), 1 << 16):
                    part = pair[at : at + (1 << 16)]
                    # One salt for a task's counts: a pair that all tasks have is summed in so many parts first.
                    salt = np.full(len(part), int(pair[0] + len(pair) + k) % SALTS, np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(n[at : at + (1 << 16)]), pa.array(salt)], names=["pair", "n", "salt"])

    rows = encoded.where("pairs is not null").select("pairs", "counts").mapInArrow(unpacked, PAIRS)
    # The first shuffle is by pair and salt, so that no task sums a pair's parts of all tasks.
    salted = rows.repartition("pair", "salt").groupBy("pair", "salt").agg(F.sum("n").alias("n"))
    summed = materialize(salted.groupBy("pair").agg(F.sum("n").alias("n")), "alignment-pairs")
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = summed.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("_most"))
    # One row a B id: bounded by the vocabulary.
    known = summed.withColumns({"a_id": F.shiftright("pair", 32), "b_id": b_id}).join(F.broadcast(most), "b_id")
    return materialize(known.select("a_id", "b_id", "pair", "n", (F.col("n") == F.col("_most")).alias("best")), "alignment-counts")


def frequent(pairs: DataFrame, limit: int | None = None) -> tuple[pa.Table, bool]:
    """The pairs with the highest counts, at most ``limit``, sorted by pair; and whether there are others.

    The least count is a power of two, so that whole classes of counts are in or out.
    """
    limit = limit or BROADCAST_PAIRS
    sizes = pairs.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count("*").alias("c"), F.min("n").alias("least")).collect()
    held, least = 0, 1 << 62
    for row in sorted(sizes, key=lambda r: -r["power"]):
        if held + row["c"] > limit:
            break
        held, least = held + row["c"], row["least"]
    return pairs.where(F.col("n") >= least).select("pair", "n", "best").toArrow().sort_by("pair"), held < sum(r["c"] for r in sizes)


def align_documents(documents: DataFrame, byte_level: str | None = None, pieces: str | None = None, broadcast_pairs: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Per document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``; and the table of id pairs.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte, have no
    tokens: zeros, and an empty string as hash. Null ids stay null, repeated rows stay rows of
    their own and count as often as they come; an empty table gives two empty ones; only
    ``doc_id`` and ``text`` are read.
    """
    byte_level, pieces = byte_level or tokens.default_tokenizer(), pieces or default_model()
    spark = documents.sparkSession
    encoded = encode_pairs(documents, byte_level, pieces)
    pairs = pair_table(encoded)
    top, more = frequent(pairs, broadcast_pairs)
    sent = spark.sparkContext.broadcast(tuple(top.column(c).to_numpy() for c in ("pair", "n", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, (known, n, best) = aligner(byte_level, pieces), sent.value
        kind = "<u2" if max(len(tools.a_bytes), len(tools.b_bytes)) <= 1 << 16 else "<u4"
        try:
            for batch in batches:
                a_all, b_all = batch.column("a_ids"), batch.column("b_ids")
                outcome = []
                for x, y in _blocks([len(v.as_buffer()) * 2 for v in a_all]):
                    a, b = ([np.frombuffer(v.as_buffer(), kind) for v in ids[x:y]] for ids in (a_all, b_all))
                    cuts = np.concatenate([[0], np.cumsum([len(i) for i in a])])
                    found = align(tools, np.concatenate(a), np.concatenate(b))
                    pair = found.a[found.links_a].astype(np.int64) << 32 | found.b[found.links_b]
                    at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
                    hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
                    total = np.concatenate([[0], np.cumsum(np.where(hit, n[at], 0) if len(known) else np.zeros(len(pair), np.int64))])
                    bests = np.concatenate([[0], np.cumsum(hit & best[at] if len(known) else hit)])
                    links = np.searchsorted(found.links_a, cuts)
                    rare = np.flatnonzero(~hit)
                    rare_cuts = np.searchsorted(rare, links)
                    for k in range(y - x):
                        if rare_cuts[k] == rare_cuts[k + 1]:
                            outcome.append((int(bests[links[k + 1]] - bests[links[k]]), int(total[links[k + 1]] - total[links[k]]), None, None))
                            continue
                        keys, times = np.unique(pair[rare[rare_cuts[k] : rare_cuts[k + 1]]], return_counts=True)
                        outcome.append((int(bests[links[k + 1]] - bests[links[k]]), int(total[links[k + 1]] - total[links[k]]), keys.tobytes(), times.tobytes()))
                n_best, count_sum, keys, times = zip(*outcome)
                same = [batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "row")]
                yield pa.RecordBatch.from_arrays([*same, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), pa.array(keys, pa.binary()), pa.array(times, pa.binary())], names=[c.split()[0] for c in SCORED.split(", ")])
        finally:
            leave()

    documents_only = encoded.where("pairs is null").withColumn("row", F.monotonically_increasing_id()).drop("pairs", "counts")
    scored = documents_only.mapInArrow(run, SCORED)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if not more:
        return scored.select(*columns), pairs.drop("pair")
    scored = materialize(scored, "alignment-scored")
    discard(encoded)

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, keys, times in zip(batch.column("row"), batch.column("rare_pairs"), batch.column("rare_links")):
                keys = np.frombuffer(keys.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), row.as_py())), pa.array(keys), pa.array(np.frombuffer(times.as_buffer(), np.int64))], names=["row", "pair", "times"])

    links = scored.where("rare_pairs is not null").select("row", "rare_pairs", "rare_links").mapInArrow(rare, "row long, pair long, times long")
    added = links.join(pairs.select("pair", "n", "best"), "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"))
    whole = scored.drop("rare_pairs", "rare_links").join(added, "row", "left")
    whole = whole.withColumns({"n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))})
    return whole.select(*columns), pairs.drop("pair")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` aligned between the byte-level and the piece vocabulary."""
    return align_documents(table(spark, sf_dir, "documents"))[0]
