"""MinHash sketches, LSH-forest orders and exact linking of near copies.

Linking works on distinct sets ("classes": equal sets are one vertex) in these steps:

1. every class has a label in each order: its first ``depth`` signature values (the key),
   then ``DEEPER`` more. All labels of an order are sorted, range partitioned, so that a
   dense region is split wherever it is cut and no count or size matters;
2. in that order the neighbour with the longest common prefix is next to a class. Depth is
   thus set by density: among like classes neighbours agree to the last value, and a class
   that shares its key with none still meets those that agree in one value less
   (``shallower``). Neighbours whose sketches allow a link are candidates, of which each
   class has its closest, and its closest of a smaller id, verified on full sets;
3. classes with a key in common that are not yet in one component, and whose sketches allow
   a link, are verified exactly, all of them, on full sets: region by region, and a large
   region in blocks of two parts each, which are bounded in rows and in shingles.

Nothing is capped: step 3 covers every pair with a key in common that is not already joined
through others, so the cuts between partitions, and step 2's choice, lose nothing. What can
be missed is a pair that shares no key, or whose sketch is off by over ``SLACK`` standard
deviations (probability 3e-6 at the threshold). The blocks of a large region whose members
are not linked grow with its square.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import wordstream
from .common import components, contract, discard, filter_place, id_filter, materialize, release, tidy

HASHES = 96
WIDTH = 5
#: Weight of a region beyond which it is compared in blocks; a member weighs one, and one more for each ``HEAVY`` shingles.
REGION, HEAVY = 2048, 512
#: Pairs of rows, and bytes of sets, that a task compares in memory at a time.
SLICE_PAIRS, SLICE_BYTES = REGION * REGION, 16 << 20
#: Standard deviations below the threshold at which a sketch still makes a candidate.
SLACK = 4.5
#: Signature values in a label after those of its key.
DEEPER = 4
#: Shingles whose signatures are computed at a time.
BLOCK = 1 << 15

_SEED = np.random.default_rng(20240229)
_FLIP = _SEED.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_TIMES = _SEED.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)


def signatures(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The smallest of each of ``HASHES`` hashes over each set (none empty): a row a set."""
    out = np.empty((len(offsets) - 1, HASHES), np.uint32)
    a = 0
    while a < len(out):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + BLOCK, "right")) - 1)
        low = flat[offsets[a] : offsets[b]].astype(np.uint32)
        begins = offsets[a:b] - offsets[a]
        for k in range(HASHES):
            part = low ^ _FLIP[k]
            part *= _TIMES[k]
            out[a:b, k] = np.minimum.reduceat(part, begins)
        a = b
    return out


def tune_bands(threshold: float, recall: float, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows with which, at ``threshold``, a pair shares a band with ``recall``
    or more, and then the fewest bands that do so within half of the hashes."""
    best = None
    for rows in range(1, hashes + 1):
        for bands in range(1, hashes // 2 // rows + 1):
            if 1 - (1 - threshold**rows) ** bands >= recall:
                best = (bands, rows)
                break
    if best is None:
        raise ValueError(f"no banding of {hashes} hashes reaches {recall} at {threshold}")
    return best


def value_bits(depth: int) -> int:
    """Bits of each signature value in a key of ``depth`` values."""
    return min(32, 63 // depth)


def labels_of(sigs: np.ndarray, orders: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Key and rest of each set's label in each order, as longs whose order is that of the values.

    Keys of different orders have no value in common; the rest takes values of the orders after.
    """
    bits = value_bits(depth)
    keys = np.zeros((len(sigs), orders), np.int64)
    rest = np.zeros((len(sigs), orders), np.uint64)
    at = np.arange(orders) * depth
    for k in range(depth):
        keys = (keys << bits) | (sigs[:, at + k] & np.uint32((1 << bits) - 1)).astype(np.int64)
    for k in range(DEEPER):
        rest = (rest << np.uint64(16)) | (sigs[:, (at + depth + k) % HASHES] & np.uint32(0xFFFF)).astype(np.uint64)
    return keys, rest.view(np.int64)


SKETCHED = "n long, keys array<long>, rest array<long>, sketch binary"


def sketch_columns(flat: np.ndarray, offsets: np.ndarray, orders: int, depth: int) -> list[pa.Array]:
    """The columns ``SKETCHED`` of sets; empty sets have no label and no sketch."""
    size = np.diff(offsets)
    full = size > 0
    sigs = signatures(flat, np.unique(offsets)) if full.any() else np.empty((0, HASHES), np.uint32)
    bounds = np.concatenate([[0], np.cumsum(full)]) * orders
    lists = [
        pa.ListArray.from_arrays(pa.array(bounds, pa.int32(), mask=np.append(~full, False)), pa.array(x.ravel()))
        for x in labels_of(sigs, orders, depth)
    ]
    low = iter((sigs & np.uint32(0xFF)).astype(np.uint8))
    return [pa.array(size, pa.int64()), *lists, pa.array([next(low).tobytes() if f else None for f in full.tolist()], pa.binary())]


MEMBERS = "tree int, region long, id long, n long, left long"


def neighbours(classes: DataFrame, depth: int, threshold: float, shallower: bool) -> DataFrame:
    """Walk each sorted order: the members of keys held by two or more, each with the neighbour
    before it (``left``) where their common prefix and their sizes allow a link."""
    shift = value_bits(depth) if shallower else 0
    order = ["tree", "region", "deeper", "id"]
    labels = classes.select("id", "n", F.posexplode(F.arrays_zip("keys", "rest")).alias("tree", "label"))
    labels = labels.select("tree", F.col("label.keys").alias("region"), F.col("label.rest").alias("deeper"), "id", "n")

    def batch_of(columns: list[np.ndarray], left: np.ndarray, known: np.ndarray, keep: np.ndarray) -> pa.RecordBatch:
        tree, region, own, n = (c[keep] for c in columns)
        arrays = [pa.array(tree), pa.array(region), pa.array(own), pa.array(n), pa.array(left[keep], pa.int64(), mask=~known[keep])]
        return pa.RecordBatch.from_arrays(arrays, names=["tree", "region", "id", "n", "left"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        # Of the row held back: whether it is known to share its key (at a cut, it may), and its neighbour.
        shares, before, met = True, 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in ("tree", "region", "id", "n")]
            if held is not None:
                columns = [np.concatenate(c) for c in zip(held, columns)]
            tree, region, own, n = columns
            one = tree[1:] == tree[:-1]
            same = one & (region[1:] == region[:-1])
            small, large = np.minimum(n[1:], n[:-1]), np.maximum(n[1:], n[:-1])
            near = one & (region[1:] >> shift == region[:-1] >> shift) & (small >= threshold * large)
            left, known = np.concatenate([[before], own[:-1]]), np.concatenate([[met], near])
            member = np.concatenate([[shares], same])
            member[:-1] |= same
            yield batch_of(columns, left, known, np.flatnonzero((member | known)[:-1]))
            held, shares, before, met = [c[-1:] for c in columns], bool(member[-1]), left[-1], bool(known[-1])
        if held is not None:
            yield batch_of(held, np.array([before]), np.array([met]), np.arange(1))

    return labels.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(walk, MEMBERS)


def _least_agreement(threshold: float) -> float:
    return HASHES * threshold - SLACK * math.sqrt(HASHES * threshold * (1 - threshold))


def likely_pairs(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """``pairs(a, b)`` whose sketches allow a link, with the number of values that agree (``same``)."""
    least = _least_agreement(threshold)

    def agree(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, HASHES) for c in ("x", "y"))
        same = np.count_nonzero(x == y, axis=1).astype(np.int32)
        fits = pa.array(same >= least)
        return pa.RecordBatch.from_arrays([batch.column("a").filter(fits), batch.column("b").filter(fits), pa.array(same).filter(fits)], names=["a", "b", "same"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield agree(batch)

    sketches = classes.select("id", "sketch")
    joined = pairs.join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("x")), "a")
    joined = joined.join(sketches.select(F.col("id").alias("b"), F.col("sketch").alias("y")), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, same int")


def closest(likely: DataFrame) -> DataFrame:
    """Of ``likely(a, b, same)`` the pairs of each class with its closest, and with its closest of a smaller id."""
    ends = likely.select(F.inline(F.array(*(F.struct(F.col(x).alias("id"), F.col(y).alias("other"), "same") for x, y in (("a", "b"), ("b", "a"))))))
    merit = F.struct("same", (-F.col("other")).alias("other"))
    best = ends.groupBy("id").agg(F.max(merit).alias("any"), F.max(F.when(F.col("other") < F.col("id"), merit)).alias("lower"))
    best = best.select("id", F.explode(F.array("any", "lower")).alias("best")).where("best is not null")
    other = -F.col("best.other")
    return best.select(F.least("id", other).alias("a"), F.greatest("id", other).alias("b")).distinct()


def weight() -> Column:
    """What a member counts in a region."""
    return F.lit(1) + F.floor(F.col("n") / F.lit(HEAVY))


def blocks_of(rows: DataFrame, threshold: float, name: str) -> DataFrame:
    """Blocks that hold all pairs of ``rows`` of one region but those of one component or of sizes that rule a link out.

    ``rows`` are members of large regions with their ``component``. A region is dealt by size
    of set, by component where that fills parts of its own, and by hash into parts of about half of ``REGION``; a
    block is two parts (``side`` 0 and 1, to be compared with each other) or one (``side`` 2).
    """
    most = max(REGION // 2, 1)
    # Sets whose spans are two or more apart differ too much in size; a little wider, for rounding.
    span = F.floor(F.log(F.col("n")) / F.lit(-math.log(threshold) * 1.0001 if threshold < 1 else 1e-3))
    keys = ["tree", "region", "span"]
    rows = materialize(rows.withColumn("span", span), f"{name}-large")
    kinds = rows.groupBy(*keys, "component").agg(F.sum(weight()).alias("members"))
    whole = F.when(F.col("members") > most, F.col("component")).alias("own")
    kinds = materialize(kinds.select(*keys, "component", whole, "members"), f"{name}-kinds")
    layout = kinds.groupBy(*keys, "own").agg(F.ceil(F.sum("members") / F.lit(most)).cast("int").alias("parts"))
    layout = materialize(layout, f"{name}-layout")
    place = F.xxhash64("tree", "region", "span", F.col("own").isNull(), "own", "part").alias("place")
    parts = materialize(layout.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*keys, "own", place), f"{name}-parts")
    a, b = parts.alias("a"), parts.alias("b").withColumn("from", F.explode(F.array(F.col("span"), F.col("span") - 1))).alias("b")
    met = a.join(b, F.expr("a.tree = b.tree and a.region = b.region and a.span = b.from"))
    met = met.where("(a.span < b.span or a.place <= b.place) and (a.own is null or b.own is null or a.own <> b.own)")
    pairs = met.select(F.col("a.place").alias("one"), F.col("b.place").alias("two"), F.xxhash64("a.place", "b.place").alias("block"))
    sides = F.when(F.col("one") == F.col("two"), F.array(F.struct(F.col("one").alias("place"), F.lit(2).alias("side"))))
    sides = sides.otherwise(F.array(F.struct(F.col("one").alias("place"), F.lit(0).alias("side")), F.struct(F.col("two").alias("place"), F.lit(1).alias("side"))))
    dealt = materialize(pairs.select("block", F.inline(sides)), f"{name}-blocks")
    heavy = kinds.where("own is not null").select(*keys, "component", "own")
    owned = rows.join(heavy, [*keys, "component"], "left").alias("r").join(
        layout.alias("l"), F.expr("r.tree = l.tree and r.region = l.region and r.span = l.span and r.own <=> l.own")
    )
    owned = owned.select("r.*", F.pmod(F.xxhash64("r.id"), F.col("l.parts")).cast("int").alias("part")).withColumn("place", place)
    return owned.join(dealt, "place").select("tree", F.col("block").alias("region"), "id", "n", "sketch", "component", "side")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches of a partition sorted by tree and region, cut where a region ends."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        tree, region = batch.column("tree").to_numpy(), batch.column("region").to_numpy()
        ends = np.flatnonzero((tree[1:] != tree[:-1]) | (region[1:] != region[:-1])) + 1
        if kept and (kept[-1].column("tree")[-1].as_py(), kept[-1].column("region")[-1].as_py()) != (tree[0], region[0]):
            yield pa.Table.from_batches(kept)
            kept = []
        if len(ends):
            yield pa.Table.from_batches([*kept, batch.slice(0, ends[-1])])
            kept = [batch.slice(ends[-1])]
        else:
            kept.append(batch)
    if kept:
        yield pa.Table.from_batches(kept)
    release()


def _numbered(table: pa.Table) -> np.ndarray:
    """The number, from zero, of each row's region."""
    tree, region = (table.column(c).to_numpy() for c in ("tree", "region"))
    return np.concatenate([[0], np.cumsum((tree[1:] != tree[:-1]) | (region[1:] != region[:-1]))])


def _slices(table: pa.Table) -> Iterator[pa.Table]:
    """Whole regions of a table, so few at a time that their pairs and sets fit in memory (one at least)."""
    number = _numbered(table)
    sizes = np.bincount(number)
    held = np.bincount(number, [len(s) for s in table.column("shingles").to_pylist()]) if "shingles" in table.column_names else np.zeros(len(sizes))
    begin = at = pairs = 0
    space = 0.0
    for size, more in zip(sizes.tolist(), held.tolist()):
        if at > begin and (pairs + size * size > SLICE_PAIRS or space + more > SLICE_BYTES):
            yield table.slice(begin, at - begin)
            begin, pairs, space = at, 0, 0.0
        at, pairs, space = at + size, pairs + size * size, space + more
    yield table.slice(begin)


def _unjoined(table: pa.Table, threshold: float) -> np.ndarray:
    """Rows of a table that, by sketch and size, may be linked with one of another component in their region (or block)."""
    n, number = table.column("n").to_numpy(), _numbered(table)
    component, side = (table.column(c).to_numpy() for c in ("component", "side"))
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, HASHES)
    least = _least_agreement(threshold)
    wanted = np.zeros(len(number), bool)
    for k in range(1, len(number)):
        near = np.flatnonzero(number[:-k] == number[k:])
        if not len(near):
            break
        near = near[component[near] != component[near + k]]
        near = near[(side[near] != side[near + k]) | (side[near] == 2)]
        small, large = np.minimum(n[near], n[near + k]), np.maximum(n[near], n[near + k])
        near = near[small >= threshold * large]
        for at in range(0, len(near), 1 << 15):
            part = near[at : at + (1 << 15)]
            part = part[np.count_nonzero(sketch[part] == sketch[part + k], axis=1) >= least]
            wanted[part] = True
            wanted[part + k] = True
    return np.flatnonzero(wanted)


def _exact(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of some sets, as products of 0/1 matrices over the shingles that two or more hold."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    begins = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(begins) - 1
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    column = np.cumsum(np.concatenate([[True], column[1:] != column[:-1]])) - 1 if len(column) else column
    total = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [at, at + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        total += part @ part.T
    return np.rint(total).astype(np.int64)


def _sorted_regions(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "region").sortWithinPartitions("tree", "region")


def linked_classes(
    classes: DataFrame,
    sets_for: Callable[[DataFrame, bytes], DataFrame],
    depth: int,
    percent: int,
    name: str,
    place: Callable[[str], Column] = filter_place,
    shallower: bool = True,
) -> DataFrame:
    """Components ``(id, component)`` of the classes that are linked with one of a smaller id.

    ``classes(id, n, keys, rest, sketch)`` are distinct sets; ``sets_for(ids, bits)`` gives ``(id, shingles binary)``
    of the wanted ids (``bits``: their filter of fixed size); two sets are linked if 100 * intersection >= ``percent`` * union.
    """
    threshold = percent / 100
    classes = classes.where("n > 0")
    members = materialize(neighbours(classes, depth, threshold, shallower), f"{name}-members")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    met = members.where("left is not null").select(F.least("id", "left").alias("a"), F.greatest("id", "left").alias("b")).distinct()
    likely = materialize(likely_pairs(met, classes, threshold), f"{name}-likely")
    tidy(members.sparkSession)
    pairs = materialize(closest(likely), f"{name}-pairs")
    discard(likely)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    sets = materialize(sets_for(wanted.distinct(), id_filter(wanted, place=place)), f"{name}-sets")
    first = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    second = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    links = pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(confirm, "a long, b long")
    found = components(contract(links), name)
    discard(pairs)

    def unjoined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in (part for run in _runs(batches) for part in _slices(run)):
            rows = _unjoined(table, threshold)
            yield from table.select(["tree", "region", "id", "component"]).take(pa.array(rows)).combine_chunks().to_batches()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in (part for run in _runs(batches) for part in _slices(run)):
            tree, region, ids, component = (table.column(c).to_numpy() for c in ("tree", "region", "id", "component"))
            sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
            cuts = np.flatnonzero((tree[1:] != tree[:-1]) | (region[1:] != region[:-1])) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
                size = np.array([len(s) for s in sets[begin:end]])
                both = _exact(sets[begin:end])
                good = 100 * both >= percent * (size[:, None] + size[None, :] - both)
                own = component[begin:end]
                x, y = np.nonzero(np.triu(good, 1) & (own[:, None] != own[None, :]))
                if not len(x):
                    continue
                # One link for each two components is enough to join them.
                _, one = np.unique(np.stack([np.minimum(own[x], own[y]), np.maximum(own[x], own[y])]), axis=1, return_index=True)
                a, b = own[x[one]], own[y[one]]
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    # Step 3: keys whose holders are in two components or more.
    known = members.drop("left").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    known = materialize(known, f"{name}-known")
    discard(members)
    tidy(members.sparkSession)
    parted = known.groupBy("tree", "region").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.sum(weight()).alias("size"))
    parted = parted.where("least <> most").select("tree", "region", "size")
    rows = known.join(parted, ["tree", "region"]).join(classes.select("id", "sketch"), "id")
    rows = materialize(rows, f"{name}-parted")
    open_rows = rows.where(F.col("size") <= REGION).drop("size").withColumn("side", F.lit(2))
    large = rows.where(F.col("size") > REGION).drop("size")
    if not large.isEmpty():
        open_rows = open_rows.unionByName(blocks_of(large, threshold, name))
    open_rows = _sorted_regions(open_rows).mapInArrow(unjoined, "tree int, region long, id long, component long")
    open_rows = materialize(open_rows, f"{name}-open")
    discard(known)
    discard(rows)
    asked = materialize(open_rows.select("id").distinct().join(sets.select("id"), "id", "left_anti"), f"{name}-asked")
    if not asked.isEmpty():  # sets that step 2 did not ask for
        sets = sets.unionByName(materialize(sets_for(asked, id_filter(asked, place=place)), f"{name}-more-sets"))
    more = _sorted_regions(open_rows.join(sets, "id")).mapInArrow(settle, "a long, b long").distinct()
    # Links between components found so far: a small graph on their smallest ids.
    merged = components(more, f"{name}-more").select(F.col("id").alias("was"), F.col("component").alias("now"))
    heads = merged.select(F.col("was").alias("id"), F.col("now").alias("component"))
    moved = found.join(merged, found["component"] == merged["was"], "left").select("id", F.coalesce("now", "component").alias("component"))
    return moved.union(heads.join(found, "id", "left_anti"))
