"""Importance resampling against a plain version without tries."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from plateworks.llm import resampling, word_trie

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = [
    (1, "The quick Brown-fox; jumps over ÄÖ über the lazy dog again and again and again", "a"),
    (2, None, "b"),
    (3, "", "b"),
    (None, "a row without an id, but with words in it that count as well as those of others", None),
    (4, "one\0two\x7fthree 日本語 É é", "c"),
    (5, "gold silver gold silver gold iron " * 40, "c"),
    (5, "gold silver gold silver gold iron " * 40, "d"),
    (7, "?!. --", "d"),
    *((k, f"plain words number {k} and number {k * k} with gold {'x' * (k % 5)} and silver", "e") for k in range(10, 60)),
]
TARGET = [(1, "gold and silver and gold"), (2, None), (3, "gold iron")]


def runs(text, longest):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, longest, buckets, min_words, percent):
    bucket = lambda run: zlib.crc32(run.encode()) % buckets
    s = Counter(bucket(r) for _, t, *_ in docs for r in runs(t, longest)[1])
    t = Counter(bucket(r) for _, x, *_ in target for r in runs(x, longest)[1])
    ss, tt = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text, *_ in docs:
        n, found = runs(text, longest)
        weight = sum(math.floor(1000 * math.log((t[b] + 1.0) * (ss + buckets) / ((s[b] + 1.0) * (tt + buckets)))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = len(able) * percent // 100
    ranks = {id(r): k + 1 for k, r in enumerate(able[:drawn])}
    return [(*r, ranks.get(id(r))) for r in out]


@pytest.mark.parametrize("longest,parts,nodes,block", [(1, 1, 10**6, 10**6), (1, 3, 7, 64), (3, 2, 10**6, 10**6), (3, 3, 20, 40)])
def test_equals_plain_version(spark, monkeypatch, longest, parts, nodes, block):
    monkeypatch.setattr(word_trie, "NODES", nodes)
    monkeypatch.setattr(word_trie, "BLOCK_BYTES", block)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, rank string").repartition(parts)
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    got = resampling.importance(docs, target, longest=longest, buckets=97, min_words=8, percent=30)
    want = plain(DOCS, TARGET, longest, 97, 8, 30)
    rows = [(r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()]
    assert sorted(rows, key=str) == sorted(want, key=str)
    whole = resampling.resample(docs, target, longest=longest, buckets=97, min_words=8, percent=30).collect()
    assert {r.doc_id for r in whole} == {r[0] for r in want if r[5]}
    assert {r.resample_rank for r in whole} <= {r[5] for r in want if r[5]}


def test_blocks_cut_long_texts_between_words(monkeypatch):
    monkeypatch.setattr(word_trie, "BLOCK_BYTES", 50)
    text = ("alpha beta " * 40 + "x" * 500 + " end").encode()
    trie, whole = word_trie.WordTrie(3, 1 << 20), word_trie.WordTrie(3, 1 << 20)
    for block in word_trie.blocks([text, None, b"alpha beta"], 3):
        trie.count_block(block)
    monkeypatch.setattr(word_trie, "BLOCK_BYTES", 1 << 20)
    for block in word_trie.blocks([text, None, b"alpha beta"], 3):
        whole.count_block(block)
    trie.fold(), whole.fold()
    assert (trie.totals == whole.totals).all() and trie.totals.sum() == 82 + 81 + 80 + 2 + 1


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.importance(docs, docs).count() == 0
    one = spark.createDataFrame([(1, "word " * 30)], "doc_id long, text string")
    assert resampling.importance(one, docs).collect()[0].n_features == 30
