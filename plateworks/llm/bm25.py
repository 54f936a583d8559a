"""Exact top-k search by BM25: an inverted index by shard, block-max WAND, exact merge.

Index: each input partition is packed in parts of flat arrays (terms by 64-bit hash, postings by term), parted by the
commonest of some frequent words and by number of different words; like parts are merged to shards of some
``SHARD_DOCS`` documents, each a file that is mapped into memory. Within a shard documents are placed by their commonest
word and length, so that the blocks of ``BLOCK`` places are alike and have tight maxima, the same blocks for every term.

Search: document frequencies and lengths are summed over all shards first, so scores do not
depend on sharding. Like queries are packed in blocks of ``QUERY_BLOCK`` and searched for together. Queries whose terms'
greatest impacts in a shard cannot reach their k-th best score so far leave it out. The terms of a block are parted in two for
each shard: leading terms, which are rare in the shard or the block, and the rest, those with the longest postings. A document's
pivot bound is the exact score of its leading terms and the block maxima of the rest; only in documents' blocks where
a query's bound reaches its k-th best score are the rest's postings read, as rows of a matrix for all queries at once, in single
precision; what may be among the best within its rounding is scored exactly. A task
takes several shards one after another, so that the k-th best score of those before counts in the next, and
its results are merged by query. Queries are files in the shared folder as shards are; a task has some of both,
so neither shards nor queries are held whole anywhere.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordered import ordered_sums
from . import wordstream
from .common import discard_path, hashed_place, id_filter, in_filter, map_batches, materialize, open_store, prepare, shared_path
from .token_files import map_ids

K1, B = 1.2, 0.75
TOP = 10
#: What a part of the index holds, at most, and about what a shard made of parts holds: what a task has in memory (some 60 bytes a posting).
SHARD_DOCS, PART_POSTINGS, SHARD_POSTINGS = 16_384, 3_000_000, 6_000_000
#: A word that is the commonest of so many documents makes parts of its own, by numbers of different words.
ALIKE_DOCS, ALIKE_TERMS = 512, (128, 512, 2048)
BLOCK = 32
#: Queries of one block, which are searched for together; like ones (by commonest term and number of terms) are in one block.
QUERY_BLOCK = 256
#: A task has shards of about so many documents, and queries up to so many; fewer while there are not so many tasks a core.
TASK_DOCS, TASK_QUERIES, TASKS_A_CORE = 131_072, 8_192, 4
#: Pivot blocks of a query without a k-th best score that are scored first.
PIVOTS = 8
#: A shard's terms in this share of its documents or more can be rows of its matrix, of so many cells at most.
DENSE_SHARE, DENSE_CELLS = 1 / 32, 16_000_000
#: Cells of a matrix product that take as long as a posting read by itself, and blocks of a product.
POSTING_CELLS, PRODUCT_BLOCKS = 256, 64
#: Scores count to this many decimals; ties go to the smaller document id.
DECIMALS = 6
_EPS = 10.0**-DECIMALS

PARTS = "word long, terms int, file string, n_docs long, sum_length long, n_terms long, n_postings long"
INDEX = "file string, n_docs long, sum_length long, n_terms long, n_postings long"
#: A shard's file: these arrays one after another, by (name, type, length by the row's counts).
LAYOUT = (
    ("doc_ids", "<i8", lambda r: r["n_docs"]), ("lengths", "<i8", lambda r: r["n_docs"]), ("terms", "<i8", lambda r: r["n_terms"]),
    ("begins", "<i8", lambda r: r["n_terms"] + 1), ("counts", "<u4", lambda r: r["n_postings"]), ("places", "<u2", lambda r: r["n_postings"]),
)
#: And a file of queries, by distinct terms, with the place of each query's terms in these.
ASKED = "file string, n_queries long, n_terms long, n_pairs long"
ASKED_LAYOUT = (
    ("ids", "<i8", lambda r: r["n_queries"]), ("cuts", "<i8", lambda r: r["n_queries"] + 1), ("terms", "<i8", lambda r: r["n_terms"]),
    ("weights", "<f8", lambda r: r["n_terms"]), ("of", "<u4", lambda r: r["n_pairs"]),
)


def _by_owner(owner: np.ndarray, hashes: np.ndarray, owners: int) -> np.ndarray:
    """The order by owner and hash: by one number of as many bits of both as it holds, which is faster, unless the bits left out matter."""
    bits = np.uint64(max(1, int(owners).bit_length()))
    joined = (owner.astype(np.uint64) << (np.uint64(64) - bits)) | (hashes >> bits)
    order = np.argsort(joined)
    joined, sorted_ = joined[order], hashes[order]
    if ((joined[1:] == joined[:-1]) & (sorted_[1:] != sorted_[:-1])).any():
        return np.lexsort((hashes, owner))
    return order


def term_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words (64-bit hashes; A-Z lower-cased, between ASCII white space) of each text, how often each occurs, and the texts' offsets."""
    words = wordstream.Words(column)
    owner = np.repeat(np.arange(len(column)), np.diff(words.first))
    order = _by_owner(owner, words.hashes, len(column))
    terms, owner = words.hashes[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])])) if len(terms) else np.empty(0, np.int64)
    counts = np.diff(np.append(starts, len(terms)))
    return terms[starts].view(np.int64), counts.astype(np.uint32), np.searchsorted(owner[starts], np.arange(len(column) + 1))


def _commonest(terms: np.ndarray, counts: np.ndarray) -> int:
    return int(terms[counts.argmax()]) if len(terms) else 0


def _alike(doc_ids: list[int], found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    """Parts by which of the words that are commonest in many documents is the commonest in a document (0: it has none of them;
    mostly this tells the language), and by number of different words."""
    sizes = np.array([len(t) for t, _ in found])
    words, many = np.unique([_commonest(t, c) for t, c in found], return_counts=True)
    word, most = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
    flat, counts = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    owner = np.repeat(np.arange(len(found)), sizes)
    for one in words[many >= ALIKE_DOCS].tolist():
        at = np.flatnonzero(flat == one)
        at = at[counts[at] > most[owner[at]]]
        word[owner[at]], most[owner[at]] = one, counts[at]
    terms = np.searchsorted(ALIKE_TERMS, sizes, "right")
    kinds, of = np.unique(np.stack([word, terms], axis=1), axis=0, return_inverse=True)
    for k, (word, terms) in enumerate(kinds.tolist()):
        mine = np.flatnonzero(of.ravel() == k).tolist()
        yield word, terms, _packed([doc_ids[i] for i in mine], [found[i] for i in mine])


def _packed(doc_ids: list[int], found: list[tuple[np.ndarray, np.ndarray]]) -> dict[str, np.ndarray]:
    """The arrays of a shard."""
    lengths = np.array([int(c.sum()) for _, c in found], np.int64)
    common = np.array([_commonest(t, c) for t, c in found], np.int64)
    owner = np.repeat(np.arange(len(found)), [len(t) for t, _ in found])
    terms, counts = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    return _inverted(np.array(doc_ids, np.int64), lengths, common, owner, terms, counts)


def _inverted(doc_ids: np.ndarray, lengths: np.ndarray, common: np.ndarray, owner: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of a shard from postings of the documents numbered ``owner``."""
    order = np.lexsort((lengths, common))
    place = np.empty(len(order), np.uint16)
    place[order] = np.arange(len(order))
    by = np.argsort(terms, kind="stable")
    terms = terms[by]
    starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.empty(0, np.int64)
    begins = np.append(starts, len(terms)).astype(np.int64)
    return {"doc_ids": doc_ids[order], "lengths": lengths[order], "terms": terms[starts], "begins": begins, "counts": counts[by], "places": place[owner[by]]}


def _merged(parts: list[dict]) -> dict[str, np.ndarray]:
    """A shard of some parts."""
    loaded = [_load(row, LAYOUT) for row in parts]
    first = np.cumsum([0, *(row["n_docs"] for row in parts)])
    doc_ids, lengths, counts = (np.concatenate([x[key] for x in loaded]) for key in ("doc_ids", "lengths", "counts"))
    terms = np.concatenate([np.repeat(x["terms"], np.diff(x["begins"])) for x in loaded])
    owner = np.concatenate([x["places"].astype(np.int32) + np.int32(a) for x, a in zip(loaded, first)])
    return _inverted(doc_ids, lengths, np.repeat([row["word"] for row in parts], np.diff(first)), owner, terms, counts)


def _store(folder: str, layout: tuple, arrays: dict[str, np.ndarray], counts: dict[str, str]) -> dict[str, object]:
    """Write the arrays to a file and return its row, with the lengths of some. Every attempt writes a file of its own."""
    store, path = open_store(folder)
    name = f"{uuid.uuid4().hex}.idx"
    with store.open_output_stream(f"{path}/{name}") as out:
        for key, kind, _ in layout:
            out.write(np.ascontiguousarray(arrays[key], kind).tobytes())
    return {"file": f"{folder}/{name}", **{name: len(arrays[key]) for name, key in counts.items()}}


def _load(row: dict, layout: tuple) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory."""
    raw, at, out = map_ids(row["file"], "u1"), 0, {}
    for key, kind, length in layout:
        size = length(row) * np.dtype(kind).itemsize
        out[key] = raw[at : at + size].view(kind)
        at += size
    return out


def build_index(documents: DataFrame) -> DataFrame:
    """The index of all rows with an id, as files in the shared folder: a row a shard.

    Null and empty texts have no terms but count as documents; a row without ``doc_id`` cannot
    be returned and is left out; repeated rows are documents of their own. Only ``doc_id``
    and ``text`` are read. An empty table gives an empty index.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    prepare(documents.sparkSession)
    of_parts, of_shards = (to_arrow_schema(StructType.fromDDL(ddl)) for ddl in (PARTS, INDEX))
    of_documents, folder = (shared_path(documents.sparkSession, name) for name in ("bm25-unmerged", "bm25-shards"))

    def stored(folder: str, shard: dict[str, np.ndarray]) -> dict[str, object]:
        return _store(folder, LAYOUT, shard, {"n_docs": "doc_ids", "n_terms": "terms", "n_postings": "places"}) | {"sum_length": int(shard["lengths"].sum())}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        texts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"word": word, "terms": terms} | stored(of_documents, part) for word, terms, part in _alike(ids, texts)], schema=of_parts)

        for batch in batches:
            terms, counts, cuts = term_sets(batch.column("text"))
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist()):
                ids.append(doc_id)
                texts.append((terms[a:b], counts[a:b]))
                held += len(texts[-1][0])
                if len(ids) == SHARD_DOCS or held >= PART_POSTINGS:
                    yield closed()
                    ids, texts, held = [], [], 0
        if ids:
            yield closed()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([stored(folder, _merged(row["parts"]))], schema=of_shards)

    read = documents.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    parts = materialize(read.mapInArrow(build, PARTS), "bm25-parts")
    groups = _grouped(parts, ["word", "terms", "file"], F.col("n_docs") / SHARD_DOCS + F.col("n_postings") / SHARD_POSTINGS, 1, "parts")
    index = materialize(groups.repartitionByRange(max(1, groups.count()), "number").mapInArrow(merge, INDEX), "bm25-index")
    discard_path(documents.sparkSession, of_documents)
    return index


def _grouped(files: DataFrame, order: list[str], share: Column, size: int, name: str) -> DataFrame:
    """Numbered rows of some files each, one after another in ``order``, with about ``size`` of ``share`` in all."""
    numbered = ordered_sums(files, [F.asc(c) for c in order], {"before": share}, 8)
    groups = numbered.groupBy(F.floor(F.col("before") / size).alias("number")).agg(F.collect_list(F.struct(*files.columns)).alias(name))
    return materialize(groups, f"bm25-{name}")


class Queries:
    """Queries that are searched for together: distinct sorted ``terms`` with ``weights``; query k has the terms ``of[cuts[k] : cuts[k + 1]]`` of these.

    ``found`` are the ids and scores of each query so far, unordered; ``low`` is the k-th best score of those that are ``full``, else 0."""

    def __init__(self, ids: np.ndarray, cuts: np.ndarray, terms: np.ndarray, weights: np.ndarray, of: np.ndarray):
        self.ids, self.cuts, self.terms, self.weights, self.of = (np.asarray(x) for x in (ids, cuts, terms, weights, of))
        self.found = [(np.empty(0, np.int64), np.empty(0))] * len(ids)
        self.low, self.full = np.zeros(len(ids)), np.zeros(len(ids), bool)

    def add(self, k: int, ids: np.ndarray, scores: np.ndarray, top: int) -> None:
        ids, scores = np.concatenate([self.found[k][0], ids]), np.concatenate([self.found[k][1], scores])
        if len(ids) > top:
            keep = np.lexsort((ids, -scores))[:top]
            ids, scores = ids[keep], scores[keep]
        self.found[k] = ids, scores
        if len(ids) == top:
            self.full[k], self.low[k] = True, scores.min()


class Shard:
    """One shard's arrays with impacts under global statistics.

    Terms of many documents are rows of ``matrix`` besides (impacts by place), with their block maxima in ``peaks``.
    ``read`` and ``skipped`` count the postings of the queries' terms that were and were not read by ``best``."""

    def __init__(self, shard: dict[str, np.ndarray], average: float):
        self.doc_ids, lengths, self.terms, begins, self.places = (np.asarray(shard[k]) for k in ("doc_ids", "lengths", "terms", "begins", "places"))
        self.impacts = shard["counts"].astype(float)
        over = (K1 * (1 - B + B * lengths / max(average, 1e-9)))[self.places]
        over += self.impacts
        self.impacts *= K1 + 1
        self.impacts /= over
        del over
        self.blocks = -(-len(self.doc_ids) // BLOCK)
        self.begins, self.sizes = begins, np.diff(begins)
        self.greatest = np.maximum.reduceat(self.impacts, begins[:-1]) if len(self.terms) else np.empty(0)
        width = self.blocks * BLOCK
        often = np.flatnonzero(self.sizes >= DENSE_SHARE * len(self.doc_ids))
        often = often[np.argsort(-self.sizes[often], kind="stable")][: DENSE_CELLS // max(1, width)]
        self.row = np.full(len(self.terms), -1, np.int32)
        self.row[often] = np.arange(len(often))
        self.matrix = np.zeros((len(often), width))
        post, of = _ranges(self.begins[often], self.sizes[often])
        self.matrix.ravel()[of * width + self.places[post]] = self.impacts[post]
        self.peaks = self.matrix.reshape(len(often), self.blocks, BLOCK).max(axis=2).astype(np.float32)
        self.by_id = np.argsort(self.doc_ids, kind="stable")
        self.read = self.skipped = 0

    def search(self, asked: Queries, top: int) -> np.ndarray:
        """Add this shard's documents to the ``top`` of each query, its own id left out; true for the blocks scored, by query block.

        Terms that are rare here or in the queries lead: their postings are summed exactly. The rest, those with
        the longest postings, are bounded by block maxima, and read only in blocks where some query's
        bound reaches its k-th best score: as a product of matrices in single precision, whose
        rounding is bounded. What may be among the best by it is scored in double precision."""
        scored = np.zeros(self.blocks, bool)
        if not len(self.terms) or not len(asked.terms):
            return scored
        many, width = len(asked.ids), self.blocks * BLOCK
        of, owner = asked.of, np.repeat(np.arange(many), np.diff(asked.cuts))
        at = np.minimum(np.searchsorted(self.terms, asked.terms), len(self.terms) - 1)
        known = self.terms[at] == asked.terms
        rest = known & (self.row[at] >= 0) & (np.bincount(of, minlength=len(at)) * self.sizes[at] * float(POSTING_CELLS) >= many * width)
        rows, number = self.row[at[rest]], np.cumsum(rest) - 1
        here = np.flatnonzero(rest[of])
        weights = np.zeros((many, len(rows)))
        weights[owner[here], number[of[here]]] = asked.weights[of[here]]
        slack = (len(rows) + 8) * 2.0**-22  # all terms are positive: a sum is off by less than this share of it
        bound = weights.astype(np.float32) @ self.peaks[rows]
        leads = (known & ~rest)[of]
        most = np.bincount(owner[leads], asked.weights[of[leads]] * self.greatest[at[of[leads]]], many)
        # Queries that no document here can serve by the greatest impacts of its terms.
        live = np.flatnonzero((most + bound.max(axis=1)) * (1 + slack) >= np.maximum(asked.low - _EPS, _EPS / 2))
        if not len(live):
            return scored
        weights, bound = weights[live], bound[live]
        exact, peaks = self._leading(asked, live, at, leads)
        bound = (bound + peaks) * (1 + slack)
        new = np.flatnonzero(~asked.full[live])
        if len(new):
            scored[np.argpartition(-bound[new], min(PIVOTS, self.blocks) - 1, axis=1)[:, :PIVOTS].ravel()] = True
            self._score(asked, live, np.flatnonzero(scored), rows, weights, exact, slack, top)
        pivots = np.flatnonzero((bound >= np.maximum(asked.low[live] - _EPS, _EPS / 2)[:, None]).any(axis=0) & ~scored)
        self._score(asked, live, pivots, rows, weights, exact, slack, top)
        scored[pivots] = True
        return scored

    def _leading(self, asked: Queries, live: np.ndarray, at: np.ndarray, leads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sums of the leading terms by live query and place, -inf at a query's own documents, and their block maxima."""
        out, peaks = np.zeros((len(live), self.blocks * BLOCK)), np.zeros((len(live), self.blocks))
        own, end = (np.searchsorted(self.doc_ids, asked.ids[live], side, sorter=self.by_id).tolist() for side in ("left", "right"))
        cuts = np.concatenate([[0], np.cumsum(leads)])[asked.cuts]
        of = asked.of[leads]
        weights, begins, sizes = asked.weights[of], self.begins[at[of]], self.sizes[at[of]]
        numbers = np.arange(np.diff(np.concatenate([[0], np.cumsum(sizes)])[cuts]).max(initial=0))
        for k, (i, j) in enumerate(zip(cuts[live].tolist(), cuts[live + 1].tolist())):
            if i < j:
                size = sizes[i:j]
                post = np.repeat(begins[i:j] - np.cumsum(size) + size, size)
                post += numbers[: len(post)]
                value = np.repeat(weights[i:j], size)
                value *= self.impacts.take(post)
                out[k] = np.bincount(self.places.take(post), value, out.shape[1])
            if own[k] < end[k]:
                out[k, self.by_id[own[k] : end[k]]] = -np.inf
            peaks[k] = out[k].reshape(-1, BLOCK).max(axis=1)
        return out, peaks

    def _score(self, asked: Queries, live: np.ndarray, blocks: np.ndarray, rows: np.ndarray, weights: np.ndarray, exact: np.ndarray, slack: float, top: int) -> None:
        """Score the documents of these blocks."""
        rough = weights.astype(np.float32)
        least = np.maximum((asked.low[live] - _EPS) * (1 - slack), 0.0).astype(np.float32)
        many, shape, kept = len(exact), (-1, self.blocks, BLOCK), []
        for a in range(0, len(blocks), PRODUCT_BLOCKS):
            some = blocks[a : a + PRODUCT_BLOCKS]
            run = slice(some[0], some[-1] + 1) if some[-1] - some[0] == len(some) - 1 else None
            cells = self.matrix.reshape(shape)[:, run][rows] if run else self.matrix.reshape(shape)[rows[:, None], some]
            about = rough @ cells.reshape(len(rows), BLOCK * len(some)).astype(np.float32)
            about += exact.reshape(shape)[:, run or some].reshape(many, -1)
            query, column = np.divmod(np.flatnonzero(about > least[:, None]), about.shape[1])
            value = about[query, column]
            ends = np.searchsorted(query, np.arange(many + 1))
            for k in np.flatnonzero(np.diff(ends) > 2 * top):
                mine = slice(ends[k], ends[k + 1])
                value[mine][value[mine] < _least(value[mine], top, slack)] = 0
            kept.append((query[value > 0], (some[column // BLOCK] * BLOCK + column % BLOCK)[value > 0], value[value > 0]))
        if not kept:
            return
        query, place, value = (np.concatenate(c) for c in zip(*kept))
        order = np.argsort(query, kind="stable")
        ends = np.searchsorted(query[order], np.arange(many + 1))
        for k in np.flatnonzero(np.diff(ends)):
            mine = order[ends[k] : ends[k + 1]]
            if len(mine) > top:
                mine = mine[value[mine] >= _least(value[mine], top, slack)]
            at, row = place[mine], np.flatnonzero(weights[k])
            score = np.round(weights[k, row] @ self.matrix[rows[row][:, None], at] + exact[k, at], DECIMALS)
            good = score >= max(asked.low[live[k]], _EPS)
            if good.any():
                asked.add(live[k], self.doc_ids[at[good]], score[good], top)

    def best(self, own: int, terms: np.ndarray, weights: np.ndarray, top: int, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ``top`` ids and scores for one query (sorted terms) among those given and this shard's, unordered, its own id left out."""
        asked = Queries(np.array([own]), np.array([0, len(terms)]), terms, weights, np.arange(len(terms)))
        asked.add(0, ids, scores, top)
        scored = self.search(asked, top)
        for a in np.flatnonzero(np.isin(self.terms, terms)).tolist():
            place = self.places[self.begins[a] : self.begins[a + 1]]
            rest = self.row[a] >= 0 and len(place) * POSTING_CELLS >= self.blocks * BLOCK
            read = int(scored[place // BLOCK].sum()) if rest else len(place)
            self.read += read
            self.skipped += len(place) - read
        return asked.found[0]


def _least(about: np.ndarray, top: int, slack: float) -> float:
    """What the ``top`` best exact scores reach, whose rough values are among these, less the rounding."""
    return np.partition(about, -top)[-top] * (1 - 2 * slack) - 2 * _EPS


def _ranges(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after another, and the range of each."""
    size = size.astype(np.int64)
    of = np.repeat(np.arange(len(size)), size)
    return (begin - np.cumsum(size) + size)[of] + np.arange(len(of)), of


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in batches of ``QUERY_BLOCK``; the last can have fewer."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held = [pa.concat_batches([*held, batch])]
        while held[0].num_rows >= QUERY_BLOCK:
            yield held[0].slice(0, QUERY_BLOCK)
            held = [held[0].slice(QUERY_BLOCK)]
    if held and held[0].num_rows:
        yield held[0]


def search(index: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` documents of each query: ``query_id, rank, doc_id, score``, best first.

    ``queries(query_id, text)``: whole texts, each distinct word once; a document never is its
    own result. Queries without id are left out; queries whose words occur nowhere, or with
    null or empty text, have no rows; a repeated query id counts once, with all its words.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = prepare(index.sparkSession)

    def words(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        terms, _, cuts = term_sets(batch.column("text"))
        ids = batch.column("query_id").to_numpy().repeat(np.diff(cuts))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(terms)], names=["query_id", "term"])

    asked = queries.where("query_id is not null").select(F.col("query_id").cast("long").alias("query_id"), F.col("text").cast("string").alias("text"))
    asked = materialize(map_batches(asked, words, "query_id long, term long").distinct(), "bm25-asked")
    bits = spark.sparkContext.broadcast(id_filter(asked, "term", hashed_place))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        for batch in batches:
            for row in batch.to_pylist():
                shard = _load(row, LAYOUT)
                terms = np.array(shard["terms"])
                good = in_filter(bits.value, np.mod(terms, 8 * len(bits.value)))
                kept.append(terms[good])
                sizes.append(np.diff(shard["begins"])[good])
        if kept:
            terms, at = np.unique(np.concatenate(kept), return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(np.bincount(at, np.concatenate(sizes), len(terms)).astype(np.int64))], names=["term", "df"])

    totals = index.agg(F.sum("n_docs"), F.sum("sum_length")).first()
    n, average = float(totals[0] or 0), float(totals[1] or 0) / max(1.0, float(totals[0] or 0))
    df = index.mapInArrow(frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    idf = F.log(F.lit(1.0) + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    # The planner cannot know how many terms a shard's row unfolds to, so it must not broadcast them.
    pairs = asked.join(df.hint("merge"), "term").groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", idf.alias("w")))).alias("p"))
    # Like queries together: by commonest term and number of terms, in files of a block each.
    pairs = materialize(pairs, "bm25-pairs")
    count = pairs.count()
    folder = shared_path(spark, "bm25-queries")
    arrow = to_arrow_schema(StructType.fromDDL(ASKED))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            flat = batch.column("p").flatten()
            terms, first, of = np.unique(flat.field("term").to_numpy(), return_index=True, return_inverse=True)
            cuts = np.concatenate([[0], np.cumsum(batch.column("n").to_numpy())])
            arrays = {"ids": batch.column("query_id").to_numpy(), "cuts": cuts, "terms": terms, "weights": flat.field("w").to_numpy()[first], "of": of}
            yield pa.RecordBatch.from_pylist([_store(folder, ASKED_LAYOUT, arrays, {"n_queries": "ids", "n_terms": "terms", "n_pairs": "of"})], schema=arrow)

    alike = pairs.withColumn("n", F.size("p").cast("long")).withColumn("lead", F.array_min(F.transform("p", lambda x: F.struct(x["w"], x["term"])))["term"])
    parts = max(1, -(-count // (4 * QUERY_BLOCK)))
    alike = alike.repartitionByRange(parts, "lead", "n", "query_id").sortWithinPartitions("lead", "n", "query_id").coalesce(parts)
    packed = materialize(alike.select("query_id", "n", "p").mapInArrow(pack, ASKED), "bm25-queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                blocks = [Queries(**_load(one, ASKED_LAYOUT)) for one in row["queries"]]
                for one in sorted(row["shards"], key=lambda x: x["n_docs"]):  # small shards first: of most languages there is one
                    shard = Shard(_load(one, LAYOUT), average)
                    for asked in blocks:
                        shard.search(asked, top)
                    del shard
                for asked in blocks:
                    own = np.repeat(asked.ids, [len(p) for p, _ in asked.found])
                    found, scores = (np.concatenate(c) for c in zip(*asked.found))
                    yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(found), pa.array(scores)], names=["query_id", "doc_id", "score"])

    # A task for some shards and some blocks of queries.
    shards = _grouped(index, ["file"], F.col("n_docs"), TASK_DOCS, "shards")
    tasks = TASKS_A_CORE * spark.sparkContext.defaultParallelism
    blocks = _grouped(packed, ["file"], F.col("n_queries"), max(2 * QUERY_BLOCK, min(TASK_QUERIES, count * shards.count() // tasks)), "queries")
    work = materialize(shards.select("shards").crossJoin(blocks.select("queries").hint("broadcast")).withColumn("task", F.monotonically_increasing_id()), "bm25-work")
    local = work.repartitionByRange(max(1, work.count()), "task").mapInArrow(run, "query_id long, doc_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return local.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).select("query_id", "rank", "doc_id", "score")


def op6_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document whose id is divisible by 100, its ten best among all ``documents``."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    queries = documents.where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), "text")
    return search(build_index(documents), queries)


OP6_SQL = """
with words as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')) as w
  from documents
), tf as (select doc_id, w, count(*) as tf from words group by all),
len as (select d.doc_id, count(w.w) as n from documents d left join words w using (doc_id) group by 1),
stat as (select count(*) as n, avg(n) as average from len),
idf as (select w, ln(1.0 + (any_value(stat.n) - count(*) + 0.5) / (count(*) + 0.5)) as idf from tf, stat group by w),
scores as (
  select q.doc_id as query_id, d.doc_id,
    round(sum(idf.idf * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * len.n / stat.average))), 6) as score
  from tf q join tf d using (w) join idf using (w) join len on len.doc_id = d.doc_id, stat
  where q.doc_id % 100 = 0 and q.doc_id <> d.doc_id group by 1, 2
), ranked as (select query_id, row_number() over (partition by query_id order by score desc, doc_id) as rank, doc_id, score from scores)
select query_id, rank, doc_id, score from ranked where rank <= 10
"""
