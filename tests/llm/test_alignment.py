"""Alignment against loops over tokens."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from plateworks.llm import alignment, tokens

DOCS = [
    (1, "Hello world, it's  me\n\n  and you've 123abc", "x"),
    (2, None, "x"),
    (3, "", "x"),
    (4, "repeat repeat repeating repeated", "x"),
    (4, "repeat repeat repeating repeated", "y"),
    (None, "no id but <|endoftext|> and </s> and <0x0A>", "x"),
    (7, "日本語 text with wide größer naïve 😀 emoji", None),
    (8, "a ▁ blank that is none, so no tokens", "x"),
    (9, "nul \0 tab \t end", "x"),
    (10, "word another " * 2000, "x"),
    (11, "x" * 5000, "x"),
    (12, " leading and trailing ", "x"),
    (13, "é combined ﬁ ligature", "x"),
]


def one(tools, text):
    """Tokens (begin, end, id) of both, or none."""
    if not text:
        return [], []
    a = tools.code.tokenizer.encode(" " + text, add_special_tokens=False).ids
    b = tools.model.encode(text)
    out = []
    for ids, spelled in ((a, tools.a_bytes), (b, tools.b_bytes)):
        at, rows, joined = 0, [], b"".join(spelled[i] for i in ids)
        for i in ids:
            rows.append((at, at + len(spelled[i]), i))
            at += len(spelled[i])
        if joined != (" " + text).encode():
            return [], []
        out.append(rows)
    return out


def plain(rows):
    tools = alignment.aligner(tokens.default_tokenizer(), alignment.default_model())
    both = [one(tools, t) for _, t, *_ in rows]
    links = []
    for a, b in both:
        found, j = [], 0
        for x, y, i in a:
            while j < len(b) and b[j][1] <= x:
                j += 1
            k = j
            while k < len(b) and b[k][0] < y:
                found.append((i, b[k][2]))
                k += 1
        links.append(found)
    n = Counter(p for found in links for p in found)
    most = Counter()
    for (_, b), c in n.items():
        most[b] = max(most[b], c)
    out = []
    for (doc_id, *_), (a, b), found in zip(rows, both, links):
        cuts = sorted({y for _, y, _ in a} & {y for _, y, _ in b})
        groups, lo = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for x, y, i in t if lo < y <= cut) for t in (a, b)))
            lo = cut
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((doc_id, len(a), len(b), len(cuts), len(found), sum(n[p] == most[p[1]] for p in found), sum(n[p] for p in found), sha))
    return out, n, most


@pytest.mark.parametrize("parts,broadcast,block,held", [(1, None, 1 << 18, 1 << 20), (3, 5, 64, 8), (2, 0, 1000, 1 << 20)])
def test_equals_loops(spark, monkeypatch, parts, broadcast, block, held):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    monkeypatch.setattr(alignment, "TASK_PAIRS", held)
    if broadcast == 0:
        monkeypatch.setattr(alignment, "BROADCAST_PAIRS", 0)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, n_a string").repartition(parts)
    got, pairs = alignment.align_documents(docs, broadcast_pairs=broadcast)
    want, n, most = plain(DOCS)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert {(r.a_id, r.b_id): (r.n, r.best) for r in pairs.collect()} == {p: (c, c == most[p[1]]) for p, c in n.items()}


def test_query_equals_loops_on_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = alignment.op13_token_alignment(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain(rows)[0]))


def test_empty_table(spark):
    got, pairs = alignment.align_documents(spark.createDataFrame([], "doc_id long, text string"))
    assert got.count() == 0 and pairs.count() == 0


def test_token_bytes_are_the_vocabularys():
    tools = alignment.aligner(tokens.default_tokenizer(), alignment.default_model())
    text = " Grüße, 日本 \n done"
    assert b"".join(tools.a_bytes[i] for i in tools.code.tokenizer.encode(text).ids) == text.encode()
    assert sorted(b for b in tools.b_bytes if len(b) == 1 and b >= b"\x80") == [bytes([k]) for k in range(0x80, 0x100)]
    assert np.all(tools.a_size > 0) and np.all(tools.b_size[3:] > 0)
