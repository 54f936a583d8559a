import hashlib
import math
import random
import re
import string
import time
import tracemalloc

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from plateworks.llm import secret_scan


def brute(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        out += [("assign", *m.span())] * (len(m.group(2)) >= 8)
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    return out + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]


PARTS = ["password", "PassWd", "api_key", "APIKEY", "token", "toKen", "ſecret", "secret", " ", ":", "=", '"', "'", "AKIA", "ABCD1234", "0123456789abcdef", "zz", ".", "é", "\n", "-_/+"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_base_spans_match_brute_force(text):
    assert secret_scan.base_spans(text) == brute(text)


def test_p_values_hold_under_writing_and_find_keys():
    rng = random.Random(5)
    for encoding, n in (("base62", 24), ("letters", 20), ("hex", 32), ("base64", 40)):
        usual = secret_scan.statistics(secret_scan.writing(encoding, n, 5000, seed=99), encoding)
        ps = np.array([secret_scan.p_writing(x, encoding, n) for x in usual])
        assert (ps <= 0.1).mean() < 0.13 and (ps <= 0.01).mean() < 0.02
    keys = ["".join(rng.choices(string.ascii_letters + string.digits, k=64)) for _ in range(200)]
    found = [secret_scan.tested(k)[0] for k in keys]
    assert sum(f[4] for f in found) > 190 and sum(f[3] / secret_scan.STEPS < -3 for f in found) > 180
    assert secret_scan.tested("onlylettersherenow")[0][2] == "lower" and secret_scan.tested("0123456789012345")[0][2] == "digits"


def brute_finds(rows, rate):
    """Benjamini and Hochberg's rule, token by token, in each length class."""
    tokens = [(n, a, b, step, even, token) for n, (_, text) in enumerate(rows) for a, b, _, step, even, token in secret_scan.tested(text or "")]
    size = lambda t: max(k for k, c in enumerate(secret_scan.CLASSES) if t[2] - t[1] >= c)
    out = set()
    for k in range(len(secret_scan.CLASSES)):
        own = [t for t in tokens if size(t) == k]
        steps = sorted({t[5]: t[3] for t in own}.values())
        most = max((p for j, p in enumerate(steps, 1) if 10 ** (p / secret_scan.STEPS) <= j * rate / len(steps) * (1 + 1e-12)), default=-math.inf)
        out |= {(t[0], t[1], t[2]) for t in own if t[3] <= most and t[4]}
    return out


def test_finds_match_brute_force(spark):
    rng = random.Random(8)
    alphabets = [string.ascii_letters + string.digits, "0123456789abcdef", string.ascii_letters, string.ascii_letters + string.digits + "+/", string.ascii_lowercase]
    words = ["internationalization", "getUserAccountDetailsById2", "report-2024-final-version-12", "donaudampfschifffahrt", "2024010112304500", "aaaaaaaaaaaaaaaaaaaaaaaa"]
    rows = []
    for d in range(60):
        parts = rng.choices(words, k=4)
        if d % 3 == 0:
            parts.append("".join(rng.choices(rng.choice(alphabets), k=rng.choice([18, 24, 33, 44, 80, 200]))))
        if d % 10 == 0:
            parts.append('token="' + "".join(rng.choices(alphabets[0], k=60)) + '"')
        rows.append((d, " ".join(parts)))
    got = secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    spans = {(r.doc_id, s.start, s.end) for r in got for s in r.secrets if s.kind == "random"}
    assert spans == brute_finds(rows, secret_scan.RATE) and len(spans) > 10
    assert sum(r.n_random for r in got) == len(spans)
    keys = {(d, t.find(w), t.find(w) + len(w)) for d, t in rows for w in t.split()[4:] if len(w) >= 80 and "=" not in w}
    assert keys and keys <= spans  # long keys of every alphabet
    # Documents without a key have no find.
    assert all(d % 3 == 0 or d % 10 == 0 for d, _, _ in spans)


def test_documents(spark):
    rng = random.Random(6)
    key = "".join(rng.choices(string.ascii_letters + string.digits, k=64))
    hexa = "".join(rng.choices("0123456789abcdef", k=40))
    rows = [(1, f"é see {key} there", 9), (2, f'password: "{key}" and AKIA{"Z9" * 8} or {hexa}', 9), (3, None, 9), (4, "", 9), (None, "plain text", 9), (5, "x" * 50000 + f" {key}", 9), (5, "x" * 50000 + f" {key}", 9)]
    found = secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string, spans int")).collect()
    assert [r.doc_id for r in found].count(5) == 2  # repeated rows stay
    got = {r.doc_id: r for r in found}
    assert got[1].spans == "random:6:70" and got[5].spans == "random:50001:50065"
    want = brute(rows[1][1])
    text = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(want, key=lambda s: (s[1], secret_scan.KINDS.index(s[0]))))
    assert got[2].base_sha256 == hashlib.sha256(text.encode()).hexdigest() and got[2].spans.startswith("assign:") and got[2].n_assign == got[2].n_access == got[2].n_hex == 1
    assert "random:11:75" in got[2].spans  # found beside a fixed pattern too
    assert got[3].base_sha256 == got[None].base_sha256 == hashlib.sha256(b"").hexdigest() and got[3].spans == ""
    assert secret_scan.find_secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_many_tokens_in_one_text():
    text = " ".join(f"token{k}=abcdefgh{k}wxyz{k}" for k in range(20_000))
    began = time.perf_counter()
    assert len(secret_scan.base_spans(text)) == 0 and len(secret_scan.tested(text)) > 0
    assert time.perf_counter() - began < 60


def test_very_long_token_costs_one_pass():
    secret_scan.tested("warm" * 10 + "UP123")
    rng = random.Random(1)
    for token in ("".join(rng.choices(string.ascii_letters + string.digits, k=1_000_000)), "a" * 1_000_000, "Zm9v" * 250_000):
        secret_scan.tested(token[:70])
        tracemalloc.start()
        began = time.perf_counter()
        found = secret_scan.tested(token)
        assert time.perf_counter() - began < 5 and len(found) == 1
        assert tracemalloc.get_traced_memory()[1] < 100e6
        tracemalloc.stop()


def test_bare_keys_are_found_and_clean_text_is_not(spark):
    """Keys of 32 to 64 characters without any word beside them, in the documents that have no secret of their own."""
    rng = random.Random(3)
    bare = lambda k: "".join(rng.choices(string.ascii_letters + string.digits, k=rng.randint(32, 64)))
    rows, keys = [], {}
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect():
        if secret_scan.base_spans(r.text or ""):
            continue
        text = r.text or ""
        if r.doc_id % 10 == 3:
            keys[r.doc_id] = bare(r.doc_id)
            text = f"{text} {keys[r.doc_id]} end"
        rows.append((r.doc_id, text))
    text_of = dict(rows)
    got = secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finds = {(r.doc_id, text_of[r.doc_id][s.start : s.end]) for r in got for s in r.secrets}
    assert len(keys) > 50 and len(finds & set(keys.items())) >= 0.9 * len(keys)
    assert finds <= set(keys.items())
