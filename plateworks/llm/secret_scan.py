"""Secret scans: fixed patterns, and a battery of randomness tests on every long token.

Every run of 16 or more characters of an encoding's alphabet is tested, whatever it is made
of and wherever it stands. Its encoding is inferred (the smallest alphabet that holds it), and
three statistics are taken: chi-squared over the alphabet's symbols, runs of the upper against
the lower half of the alphabet, and the serial correlation of neighbours. They are used twice:

* against an even draw (the key hypothesis): a token whose three p-values, combined by Fisher,
  reject evenness at ``EVEN`` is no find;
* against ordinary writing (the null hypothesis): letters by their usual frequency, upper case,
  lower case and digits in stretches. For each encoding and some lengths (``LENGTHS``) the statistics
  of simulated writing and of even draws give the linear score that parts them best; its p-value under
  writing says how rarely writing looks so even. A token's statistics are brought to the next shorter
  of these lengths, as they would be on average under writing, so a token of any length costs one pass
  over its characters, and longer tokens are judged with less certainty than they allow, never more.

False discoveries are controlled on these p-values by Benjamini and Hochberg's rule in each
length class, over all different tokens of the corpus, so that of the finds of a class an
expected ``RATE`` at most is ordinary writing. Long lower-case words and digits are tested too; as
writing and even draws hardly differ there (digits: not at all), only great length makes them finds.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MEMOS, map_batches, materialize, prepare, texts_of

RATE = 0.01
#: Below this combined p a token is not even enough to be a key.
EVEN = 1e-4
CLASSES = (16, 20, 28, 40, 64)
KINDS = ("assign", "access", "hex", "random")
#: Draws of each kind that a score is fitted to.
DRAWS = 4000
#: Lengths that scores are fitted at.
LENGTHS = (16, 18, 20, 24, 28, 32, 40, 48, 64)
#: Tokens up to this length are remembered with their verdicts.
REMEMBERED = 128
#: P-values are compared as steps of log10, rounded against a find.
STEPS, LEAST_STEP = 50, -1000

_ASSIGN = re.compile(r"""((?a:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_LONG_HEX = re.compile("(?<![0-9a-f])[0-9a-f]{32,}")
_TOKEN = re.compile("[A-Za-z0-9+/_-]{16,}={0,2}")

# Relative frequencies (per cent) of the letters a to z in English prose.
_LETTER_PERCENT = (
    8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4,
    6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074,
)
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_ALPHABETS = {
    "digits": _DIGITS, "hex": _DIGITS + "abcdef", "HEX": _DIGITS + "ABCDEF", "lower": _LOWER, "upper": _UPPER, "base32": _UPPER + "234567",
    "lower36": _DIGITS + _LOWER, "upper36": _DIGITS + _UPPER, "letters": _UPPER + _LOWER, "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/", "base64url": _UPPER + _LOWER + _DIGITS + "-_", "any": _UPPER + _LOWER + _DIGITS + "+/-_",
}
_SETS = {name: frozenset(letters) for name, letters in _ALPHABETS.items()}
#: An alphabet's place of each byte.
_PLACES = {name: np.array([max(letters.find(chr(c)), 0) for c in range(256)]) for name, letters in _ALPHABETS.items()}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns' matches: (kind, start, end) in code points, end exclusive."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    return found + [("hex", *m.span()) for m in _LONG_HEX.finditer(text)]


def infer_encoding(token: str) -> str:
    """The smallest alphabet that holds the token (without = at its end)."""
    used = set(token)
    return next(name for name, letters in _SETS.items() if used <= letters)


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi2_tail(x: float, k: float) -> float:
    """Upper tail of chi-squared by Wilson and Hilferty's cube root."""
    return 0.5 * math.erfc((((x / k) ** (1 / 3)) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k)) / math.sqrt(2))


def _upper_side(letters: str) -> np.ndarray:
    """Which symbols count as one side in the runs test."""
    for side in (str.islower, str.isalpha):
        marks = np.array([side(c) for c in letters])
        if 0 < marks.sum() < len(letters):
            return marks
    return np.arange(len(letters)) >= len(letters) / 2


_SIDES = {name: _upper_side(letters) for name, letters in _ALPHABETS.items()}


def statistics(x: np.ndarray, encoding: str) -> np.ndarray:
    """Chi-squared, runs (standardised) and serial correlation (standardised) of each row of symbols of an alphabet."""
    (k, n), size = x.shape, len(_ALPHABETS[encoding])
    counts = np.bincount((np.arange(k)[:, None] * size + x).ravel(), minlength=k * size).reshape(k, size)
    chi = ((counts - n / size) ** 2).sum(axis=1) * size / n
    high = _SIDES[encoding][x]
    n1 = high.sum(axis=1).astype(float)
    n0 = n - n1
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    product = 2 * n1 * n0
    spread = product * (product - n) / (n * n * (n - 1))
    # All on one side: one run where about half of n is usual.
    z_runs = np.where(spread > 0, (runs - 1 - product / n) / np.sqrt(np.where(spread > 0, spread, 1)), np.where(product > 0, 0.0, -math.sqrt(n)))
    d = x - x.mean(axis=1, keepdims=True)
    power = (d * d).sum(axis=1)
    z_serial = np.where(power > 0, (d[:, 1:] * d[:, :-1]).sum(axis=1) / np.where(power > 0, power, 1) * math.sqrt(n) + 1 / math.sqrt(n), math.sqrt(n))
    return np.stack([chi, z_runs, z_serial], axis=1)


def evenness(found: np.ndarray, n: int, size: int) -> float:
    """Combined p of an even draw: chi-squared, runs and serial correlation, by Fisher."""
    chi, z_runs, z_serial = found.tolist()
    # With few symbols for a large alphabet the statistic is scaled to its exact mean and variance.
    scale = 1 - 1 / n
    ps = (_chi2_tail(chi / scale, (size - 1) / scale), _normal_tail(z_runs), _normal_tail(z_serial))
    joint = -2 * sum(math.log(max(p, 1e-300)) for p in ps)
    # Upper tail of chi-squared with six degrees of freedom, in closed form.
    return math.exp(-joint / 2) * (1 + joint / 2 + joint * joint / 8)


#: Styles of writing: how likely a lower-case letter, upper-case letter, digit or other is followed by which.
STYLES = {
    "plain": {"l": {"l": 0.90, "u": 0.03, "d": 0.03, "o": 0.04}, "u": {"l": 0.45, "u": 0.45, "d": 0.05, "o": 0.05}, "d": {"l": 0.06, "u": 0.06, "d": 0.80, "o": 0.08}, "o": {"l": 0.40, "u": 0.20, "d": 0.30, "o": 0.10}},
    "words run together": {"l": {"l": 0.76, "u": 0.18, "d": 0.03, "o": 0.03}, "u": {"l": 0.88, "u": 0.06, "d": 0.03, "o": 0.03}, "d": {"l": 0.15, "u": 0.15, "d": 0.62, "o": 0.08}, "o": {"l": 0.40, "u": 0.40, "d": 0.15, "o": 0.05}},
}
_START = {"l": 0.4, "u": 0.3, "d": 0.25, "o": 0.05}


def _class_of(c: str) -> str:
    return "l" if c.islower() else "u" if c.isupper() else "d" if c.isdigit() else "o"


def writing(encoding: str, n: int, draws: int, style: str = "plain", seed: int = 1) -> np.ndarray:
    """Symbols of ``draws`` simulated tokens of ordinary writing with ``n`` characters of an alphabet, a row each."""
    letters = _ALPHABETS[encoding]
    rng = np.random.default_rng([seed, n, len(letters)])
    kinds = [k for k in "ludo" if any(_class_of(c) == k for c in letters)]
    symbols, chances = [], []
    for kind in kinds:
        own = [k for k, c in enumerate(letters) if _class_of(c) == kind]
        weight = np.array([_LETTER_PERCENT[ord(letters[k].lower()) - 97] if kind in "lu" else 1.0 for k in own])
        symbols.append(np.array(own))
        chances.append(weight / weight.sum())
    share = lambda of: np.array([of[k] for k in kinds]) / sum(of[k] for k in kinds)
    change = np.cumsum([share(STYLES[style][k]) for k in kinds], axis=1)
    state = np.searchsorted(np.cumsum(share(_START)), rng.random(draws), "right").clip(0, len(kinds) - 1)
    out = np.empty((draws, n), np.int64)
    for at in range(n):
        for k in range(len(kinds)):
            mine = np.flatnonzero(state == k)
            out[mine, at] = rng.choice(symbols[k], len(mine), p=chances[k])
        state = (rng.random(draws)[:, None] >= change[state]).sum(axis=1).clip(0, len(kinds) - 1)
    return out


def _scale(found: np.ndarray) -> np.ndarray:
    return np.stack([-np.log(found[:, 0] + 1), found[:, 1], found[:, 2]], axis=1)


@functools.lru_cache(maxsize=None)  # as many as there are alphabets, lengths and styles
def _score(encoding: str, n: int, style: str) -> tuple[np.ndarray, float, float]:
    """Weights of the three statistics that part even draws from a style of writing best, and the score's mean and deviation under it."""
    usual = _scale(statistics(writing(encoding, n, DRAWS, style), encoding))
    size = len(_ALPHABETS[encoding])
    even = _scale(statistics(np.random.default_rng([2, n, size]).integers(0, size, (DRAWS, n)), encoding))
    spread = np.cov(usual.T) + np.cov(even.T) + 1e-9 * np.eye(3)
    weights = np.linalg.solve(spread, even.mean(axis=0) - usual.mean(axis=0))
    score = usual @ weights
    # The deviation of the upper half, where finds are: the score need not be symmetric.
    above = score[score > score.mean()] - score.mean()
    return weights, float(score.mean()), float(max(np.sqrt((above**2).mean()), 1e-9)) if len(above) else 1e-9


def fitted_length(n: int) -> int:
    """The length whose score is used for ``n``: the next shorter of ``LENGTHS``."""
    return max(k for k in LENGTHS if k <= max(n, LENGTHS[0]))


def p_writing(found: np.ndarray, encoding: str, n: int) -> float:
    """How likely ordinary writing, in the style that is likeliest to, scores as even as the token."""
    fitted = fitted_length(n)
    # Under writing chi-squared grows with the length, and the standardised statistics with its root.
    at_fitted = found * [fitted / n, math.sqrt(fitted / n), math.sqrt(fitted / n)]
    x = _scale(at_fitted[None])[0]
    fits = [_score(encoding, fitted, style) for style in STYLES]
    return max(0.5 * math.erfc((float(x @ weights) - mean) / deviation / math.sqrt(2)) for weights, mean, deviation in fits)


def tested(text: str) -> list[tuple[int, int, str, int, bool, int]]:
    """Every long token: (start, end, encoding, step of its p-value, whether it is even enough, hash)."""
    out = []
    for m in _TOKEN.finditer(text):
        token = m[0].rstrip("=")
        out.append((*m.span(), *(_verdict(token) if len(token) <= REMEMBERED else _judged(token))))
    return out


def _judged(token: str) -> tuple[str, int, bool, int]:
    encoding = infer_encoding(token)
    size, found = len(_ALPHABETS[encoding]), statistics(_PLACES[encoding][np.frombuffer(token.encode(), np.uint8)][None], encoding)[0]
    p = max(p_writing(found, encoding, len(token)), 10.0 ** (LEAST_STEP / STEPS))
    return encoding, math.ceil(math.log10(p) * STEPS), evenness(found, len(token), size) >= EVEN, xxhash.xxh3_64_intdigest(token) - (1 << 63)


_verdict = functools.lru_cache(maxsize=4096)(_judged)
MEMOS.append(_verdict.cache_clear)


def _length_class(n):
    return sum((F.when(n >= c, 1).otherwise(0) for c in CLASSES[1:]), F.lit(0))


SCANNED = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
    "base array<struct<start:int,kind:int,end:int>>, found array<struct<start:int,end:int,encoding:string,step:int,even:boolean,token:long>>"
)


def _span_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))


def scan(documents: DataFrame) -> DataFrame:
    """First pass over whole texts, written to the shared folder: base spans and tested tokens."""
    prepare(documents.sparkSession)

    def compute(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
            base = base_spans(text)
            kinds = [k for k, _, _ in base]
            rows.append(
                {
                    "doc_id": doc_id,
                    **{f"n_{k}": kinds.count(k) for k in KINDS[:3]},
                    "base_sha256": hashlib.sha256(_span_text(base).encode()).hexdigest(),
                    "base": [{"start": a, "kind": KINDS.index(k), "end": b} for k, a, b in base],
                    "found": [dict(zip(("start", "end", "encoding", "step", "even", "token"), x)) for x in tested(text)],
                }
            )
        yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(SCANNED))
    read = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return materialize(map_batches(read, compute, SCANNED), "secret-scan")


def limits(scanned: DataFrame, rate: float = RATE) -> list[float]:
    """The largest step of a p-value that counts as a find, for each length class (-inf: none).

    With m different tokens tested in a class (a token counts once, however often it occurs), and k of them
    at p or below, p is a find for the largest p with p <= k * rate / m. P-values are summed up by
    step (a fixed number of rows, whatever the input).
    """
    seen = scanned.select(F.explode("found").alias("t"))
    seen = seen.select(_length_class(F.col("t.end") - F.col("t.start")).alias("class"), "t.step", "t.token").distinct()
    rows = seen.groupBy("class", "step").agg(F.count("*").alias("n")).collect()
    out = []
    for k in range(len(CLASSES)):
        own = sorted((r["step"], r["n"]) for r in rows if r["class"] == k)
        total, below, most = sum(n for _, n in own), 0, -math.inf
        for step, n in own:
            below += n
            if step / STEPS <= math.log10(below * rate / total):
                most = step
        out.append(most)
    return out


def find_secrets(documents: DataFrame, rate: float = RATE) -> DataFrame:
    """Per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random, secrets``.

    ``spans`` names all spans in code points; ``secrets`` has them as (kind, start, end). The battery's
    finds (``random``) are listed also where a fixed pattern matches.
    Null text is empty: no spans. Null ids and repeated rows keep rows of their own; only
    ``doc_id`` and ``text`` are read; an empty table gives no rows.
    """
    scanned = scan(documents)
    most = limits(scanned, rate)

    def good(t):
        n = t["end"] - t["start"]
        out = F.lit(False)
        for k, limit in enumerate(most):
            if limit > -math.inf:
                out = out | ((_length_class(n) == k) & (t["step"] <= F.lit(limit)))
        return out & t["even"]

    random = F.transform(F.filter("found", good), lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    both = scanned.withColumn("all", F.array_sort(F.concat("base", random)))
    kinds = F.array(*map(F.lit, KINDS))
    secrets = F.transform("all", lambda s: F.struct(kinds[s["kind"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    spans = F.array_join(F.transform("secrets", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return both.withColumn("secrets", secrets).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", spans.alias("spans"), F.size(random).cast("long").alias("n_random"), "secrets"
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all ``documents``."""
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("secrets")
