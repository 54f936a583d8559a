"""Licence scans: ordered signature rules behind a keyword prefilter, overlaps resolved by priority and containment.

One pass of an Aho-Corasick automaton over a text's normalised words finds which rules'
keywords it holds; only rules with all their keywords run. Detections are taken in order of
priority, longer ones first within a rule kind; one that lies inside another already taken
is suppressed. Fixed phrases (``BASE``) are found besides and never suppressed.
"""

from __future__ import annotations

import functools
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import map_batches, prepare, table
from .license_rules import KINDS, rules
from .word_trie import separated

# Phrases that always count, and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: How sure a fixed phrase is.
BASE_SCORE = 0.9

DETECTIONS = pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64())]))
SCANNED = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "detections array<struct<label:string,kind:string,first_word:bigint,end_word:bigint>>"
)


class Found(NamedTuple):
    """A detection: words ``first`` to ``end`` (exclusive) by the rule of this place in the order."""

    rank: int
    first: int
    end: int
    label: str
    kind: str


class Prefilter:
    """Which rules a text can match, by its keywords."""

    def __init__(self, ordered):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        keywords = sorted({k for rule in ordered for k in rule.keywords})
        for bit, keyword in enumerate(keywords):
            self.automaton.add_word(keyword, 1 << bit)
        self.automaton.make_automaton()
        self.needs = [(sum(1 << keywords.index(k) for k in set(rule.keywords)), rank) for rank, rule in enumerate(ordered)]

    def __call__(self, text: str) -> list[int]:
        seen = 0
        for _, bit in self.automaton.iter(text):
            seen |= bit
        return [rank for need, rank in self.needs if need & seen == need] if seen else []


@functools.lru_cache(maxsize=1)
def _ordered():
    ordered = rules()
    return ordered, Prefilter(ordered)


def unsuppressed(found: list[Found]) -> list[Found]:
    """Detections that lie inside none of higher priority (or of the same kind and longer, or equal and earlier in the rules), by place.

    ``starts`` and ``ends`` hold those taken that lie inside no other, so both ascend and one
    look-up tells whether anything taken contains a detection.
    """
    kinds = {kind: k for k, kind in enumerate(KINDS)}
    taken, starts, ends = [], [], []
    for x in sorted(found, key=lambda x: (kinds[x.kind], x.first - x.end, x.first, x.rank)):
        k = bisect_right(starts, x.first)
        if k and ends[k - 1] >= x.end:
            continue
        taken.append(x)
        a, b = bisect_left(starts, x.first), bisect_right(ends, x.end)
        starts[a:b], ends[a:b] = [x.first], [x.end]
    return sorted(taken, key=lambda x: (x.first, x.end, x.rank))


def places(words: bytes, phrase: bytes) -> list[int]:
    """All bytes at which ``phrase`` begins in ``words``; both have a blank at either end."""
    out, at = [], words.find(phrase)
    while at >= 0:
        out.append(at)
        at = words.find(phrase, at + 1)
    return out


def scan_text(text: bytes) -> tuple[int, list[tuple[int, str]], list[Found]]:
    """Number of words, places (word, label) of fixed phrases, and detections of a whole text."""
    split = separated(text).split()
    words = b" " + b" ".join(split) + b" "
    ordered, prefilter = _ordered()
    base = [(at, label) for phrase, label in BASE.items() for at in places(words, f" {phrase} ".encode())]
    # Each byte as one character, so that places agree.
    hits = [(rank, m.start(), m.end()) for rank in prefilter(words.decode("latin1")) for m in ordered[rank].pattern.finditer(words)]
    if not base and not hits:
        return len(split), [], []
    # A blank's number is the word that it stands before.
    blanks = np.flatnonzero(np.frombuffer(words, np.uint8) == 0x20)
    word = lambda at: int(np.searchsorted(blanks, at))
    found = [Found(rank, word(a - 1), word(b), ordered[rank].label, ordered[rank].kind) for rank, a, b in hits]
    return len(split), [(word(at), label) for at, label in base], unsuppressed(found)


def scan(documents: DataFrame) -> DataFrame:
    """Per document ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections``.

    ``score`` is that of the surest detection, 0 without any. Null and empty texts have no words
    and no finds; null ids and repeated rows stay rows of their own; an empty table gives no row;
    only ``doc_id`` and ``text`` are read. Equal detections of two rules go to the earlier rule;
    those that overlap without containment both stay.
    """
    prepare(documents.sparkSession)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            n, base, found = scan_text(text or b"")
            at = [place for place, _ in base]
            base_labels = {label for _, label in base}
            score = max([BASE_SCORE] * bool(base) + [KINDS[x.kind] for x in found], default=0.0)
            labels = ",".join(sorted(base_labels | {x.label for x in found}))
            detections = [{"label": x.label, "kind": x.kind, "first_word": x.first, "end_word": x.end} for x in found]
            rows.append((n, len(base), min(at, default=None), max(at, default=None), ",".join(sorted(base_labels)), labels, score, detections))
        n, n_base, first, last, base_labels, labels, score, detections = zip(*rows)
        whole = [pa.array(x, pa.int64()) for x in (n, n_base, first, last)]
        columns = [batch.column("doc_id"), *whole, pa.array(base_labels, pa.string()), pa.array(labels, pa.string()), pa.array(score, pa.float64()), pa.array(detections, DETECTIONS)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"])

    return map_batches(documents.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text"), run, SCANNED)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences in all ``documents``."""
    return scan(table(spark, sf_dir, "documents")).drop("detections")
