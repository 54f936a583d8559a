import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plateworks.llm import packing, token_files, tokens

DOCS = [
    (5, "Hello world, it's  me\n\n  and you've 123abc", "x"),
    (2, None, "x"),
    (9, "", "x"),
    (2, "repeat repeat", "x"),
    (None, "no id", "x"),
    (7, "日本語 text with <|endoftext|> wide", None),
    (1, "word " * 3000, "x"),
    (11, "x" * 20000, "x"),
]


def frame(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id long, text string, start string")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=60) | st.text(max_size=40) | st.text(alphabet=" \n\t'sta1.²é", max_size=30))
def test_encoder_gives_the_librarys_ids(text):
    code = tokens.encoder(tokens.default_tokenizer())
    text = text.encode("utf-8", "ignore").decode()
    want = code.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(code.encode(text), dtype="<u4").tolist() == want


def test_memo_is_emptied_when_full(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", 3)
    code = tokens.Encoder(tokens.default_tokenizer())
    text = "one two three four five six one two"
    assert np.frombuffer(code.encode(text), dtype="<u4").tolist() == code.tokenizer.encode(text).ids
    assert len(code.memo) <= 3


def reference(rows):
    code = tokens.encoder(tokens.default_tokenizer()).tokenizer
    return [(d, code.encode(t or "", add_special_tokens=False).ids + [0]) for d, t, _ in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("parts", [1, 3])
def test_packing_round_trip(spark, parts):
    chunks = packing.encode_chunks(frame(spark).repartition(parts))
    rows = sorted(packing.cut(chunks).collect(), key=lambda r: (r.sequence_id, r.offset))
    stream, docs = {}, {}
    for r in rows:
        assert 0 < r.length and r.offset + r.length <= 1024
        stream.setdefault(r.sequence_id, []).append(r)
        docs.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for n, (s, got) in enumerate(sorted(stream.items())):
        assert s == n and [r.offset for r in got] == [sum(x.length for x in got[:k]) for k in range(len(got))]
        assert sum(r.length for r in got) == 1024 or n == len(stream) - 1
    want = reference(DOCS)
    whole = {(r.sequence_id): r for r in packing.sequences(chunks).collect()}
    assert set(whole) == set(stream) and all(len(r.ids) == 1024 for r in whole.values())
    flat = [i for _, r in sorted(whole.items()) for i in r.ids[: r.n_tokens]]
    assert len(flat) == sum(len(ids) for _, ids in want)
    for d, ids in want:
        got = sorted(docs[(d, len(ids))], key=lambda r: r.start)
        assert [r.ids_crc32 for r in got] == [crc(ids[r.start : r.start + r.length]) for r in got]
        at = got[0].sequence_id * 1024 + got[0].offset
        assert flat[at : at + len(ids)] == ids


def test_token_files_round_trip(spark):
    files = token_files.write_token_files(frame(spark), shards=3)
    rows = sorted(token_files.read_token_files(spark, files).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in rows) == sorted((d or -1, len(i), crc(i)) for d, i in reference(DOCS))


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert packing.pack(empty).count() == 0
    assert packing.sequences(packing.encode_chunks(empty)).count() == 0
    assert token_files.read_token_files(spark, token_files.write_token_files(empty)).count() == 0


def test_hot_and_null_ids_are_split_in_one_order(spark, monkeypatch):
    """Many rows of one id and many without: several shards, texts in order of their hash, starts alike in two runs."""
    rows = [(7 if k % 3 else None, f"row {k % 997} of many", "x") for k in range(100_000)] + [(9, "last", "x")]
    docs = frame(spark, rows)
    runs = []
    for parts in (3, 5):
        files = token_files.write_token_files(docs.repartition(parts), shards=8)
        got = token_files.read_token_files(spark, files).orderBy("start").collect()
        runs.append([(r.doc_id, r.start, r.ids_crc32) for r in got])
        sizes = [r.n_docs for r in spark.read.schema(token_files.MANIFEST).parquet(files.manifest).collect()]
        assert len(sizes) == 8 and max(sizes) < 25_000
    assert runs[0] == runs[1] and len(runs[0]) == len(rows)
    assert [d for d, _, _ in runs[0]] == [None] * 33_334 + [7] * 66_666 + [9]
