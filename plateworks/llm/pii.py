"""Personal data: keyed surrogates that keep type, format, script and gender.

Entities are found by pattern in whole texts. Each has a canonical form (digits of a phone
number, lower-case address), so that mentions written differently stay one entity, and a
space of strings of the same form: digits for digits, vowels for vowels, letters of the
same script, the same country code, valid check digits where they were valid, a given name
of the same gender and script. A keyed Feistel network ranks that space, and the surrogate
is the entity next in rank. That map is one to one and never leaves an entity as it was, so
distinct entities stay distinct and equal ones equal across all documents, with no table
to look up. The parts of a mail address have surrogates of their own, so that one domain stays one
domain and one user name one user name; network addresses stay in their kind (private, loopback,
link-local, public). Names are found by title or by a known given name; within a text, every other place
where such a name or its parts stand as a word takes the same surrogate, also in capitals, in lower case
beside its other part, and with a genitive s. ``surrogate_map`` nevertheless gathers the distinct entities of the corpus and
``replace`` fails if two of one kind got the same surrogate.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import MEMOS, map_batches, materialize, prepare, texts_of

#: The key for tests and registered queries; a real run passes its own secret.
DEFAULT_KEY = b"plateworks-surrogates"
KINDS = ("email", "iban", "card", "ssn", "ip", "phone", "name")
ROUNDS = 8

# Given names by gender and script.
GIVEN = {
    ("m", "latin"): "Adam Alan Albert Andreas Anton Carlos Charles Daniel David Diego Edward Felix Francisco Frank George Hans Henri Jack Jacques James Jean Johann John José Juan Karl Louis Luis Luke Manuel Mark Martin Michael Miguel Pablo Paul Peter Philippe Pierre Robert Stefan Thomas Walter William Wolfgang".split(),
    ("f", "latin"): "Alice Ana Anna Barbara Beatriz Camille Carmen Charlotte Claire Claudia Elena Elizabeth Emily Emma Eva Grace Hannah Helen Ingrid Isabel Jane Julia Karen Laura Linda Lucía Margaret Maria Marie Martha Mary Monika Nathalie Nicole Patricia Paula Rosa Sarah Sofía Sophie Susan Teresa Ursula Victoria".split(),
    ("m", "cyrillic"): "Александр Алексей Андрей Борис Виктор Владимир Дмитрий Иван Михаил Николай Олег Пётр Сергей Юрий".split(),
    ("f", "cyrillic"): "Анна Валентина Вера Галина Екатерина Елена Ирина Людмила Мария Надежда Наталья Ольга Светлана Татьяна".split(),
}
# Titles before a name, by gender.
TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "господин"), "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа"), "n": ("Dr", "Prof")}

# Network addresses that are not public, as (first address, number), in order.
_IP_BLOCKS = {
    "this": (0x00000000, 1 << 24), "private10": (0x0A000000, 1 << 24), "shared": (0x64400000, 1 << 22), "loopback": (0x7F000000, 1 << 24),
    "link": (0xA9FE0000, 1 << 16), "private172": (0xAC100000, 1 << 20), "private192": (0xC0A80000, 1 << 16), "beyond": (0xE0000000, 1 << 29),
}

_POOLS = {name: (pool, pool.index(name)) for pool in GIVEN.values() for name in pool}
_TITLE_GENDER = {t: g for g, titles in TITLES.items() for t in titles}
_PATTERNS = {
    "email": re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "card": re.compile(r"(?<![\w.+-])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{3,4}(?!\w|[.-]\d)"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "ip": re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\w|\.\d)"),
    "phone": re.compile(r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|(?:\(\d{2,5}\) ?|\d{2,4}[-.])\d{3,4}[ .-]\d{3,4}|\+\d{8,15})(?!\w|[.-]\d)"),
    "name": re.compile(
        r"(?=[A-ZÀ-ÞЀ-Яг])(?<!\w)(?:(?P<title>" + "|".join(map(re.escape, sorted(_TITLE_GENDER, key=len, reverse=True))) + r")\.? +(?:(?P<tgiven>" + "|".join(map(re.escape, _POOLS)) + r") +)?(?P<tlast>[^\W\d_][\w'-]+)"
        r"|(?P<given>" + "|".join(map(re.escape, _POOLS)) + r") +(?P<last>[^\W\d_][\w'-]+))(?!\w)"
    ),
}

_NUMERIC = {"iban", "card", "ssn", "ip", "phone"}  # kinds that no text without a digit has
_DIGIT = re.compile(r"\d")
_WORD = re.compile(r"(?<!\w)[^\W\d_]\w*(?:-\w+)*")
_FEW_NAMES = 8

_ALPHABETS = [
    "0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ",
    "àáâãäåæèéêëìíîïòóôõöøùúûüýÿ", "çðñþß", "ÀÁÂÃÄÅÆÈÉÊËÌÍÎÏÒÓÔÕÖØÙÚÛÜÝ", "ÇÐÑÞ",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь", "АЕЁИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩЪЬ",
    "".join(map(chr, range(0x3B1, 0x3C2))) + "".join(map(chr, range(0x3C3, 0x3CA))), "".join(map(chr, range(0x391, 0x3A2))) + "".join(map(chr, range(0x3A3, 0x3AA))),
    "".join(map(chr, range(0x4E00, 0x9FA6))),
]
_CLASS = {c: a for a in _ALPHABETS for c in a}


@functools.lru_cache(maxsize=4)
def _keyed(key: bytes):
    return hmac.new(key, digestmod=hashlib.sha256)


def _round(key: bytes, label: str, number: int, half: int, size: int) -> int:
    mac = _keyed(key).copy()
    mac.update(f"{label}|{number}|{half}".encode())
    wide = mac.digest()
    while len(wide) * 8 < size.bit_length() + 64:
        wide += hashlib.sha256(wide).digest()
    return int.from_bytes(wide, "big") % size


def next_in_rank(key: bytes, label: str, x: int, size: int) -> int:
    """A keyed permutation of range(size) that is one cycle: no fixed point for size over 1.

    A Feistel network over a near-square grid of cells ranks the values (walking past the
    cells that are no value); the result is the value of the next rank.
    """
    if size < 2:
        return x
    left = 1 << ((size - 1).bit_length() // 2)
    right = -(-size // left)

    def ranked(v: int, back: bool = False) -> int:
        while True:
            a, b = divmod(v, right)
            for number in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
                sign = -1 if back else 1
                if number % 2:
                    b = (b + sign * _round(key, label, number, a, right)) % right
                else:
                    a = (a + sign * _round(key, label, number, b, left)) % left
            v = a * right + b
            if v < size:
                return v

    return ranked((ranked(x) + 1) % size, back=True)


def shifted(key: bytes, label: str, text: str, classes: list[str | None] | None = None) -> str:
    """``text`` with every letter and digit replaced within its class, one to one over all texts of that form."""
    classes = classes or [_CLASS.get(c) for c in text]
    x, size = 0, 1
    for c, own in zip(text, classes):
        if own:
            x, size = x * len(own) + own.index(c), size * len(own)
    form = "".join("." if own else c for c, own in zip(text, classes))
    x = next_in_rank(key, f"{label}|{form}|{'|'.join(str(_ALPHABETS.index(o)) if o in _ALPHABETS else o for o in classes if o)}", x, size)
    out = []
    for c, own in zip(reversed(text), reversed(classes)):
        if own:
            x, at = divmod(x, len(own))
            c = own[at]
        out.append(c)
    return "".join(reversed(out))


def luhn_digit(digits: str) -> int:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _iban_rest(letters: str) -> int:
    return int("".join(str(int(c, 36)) for c in letters)) % 97


def canonical(kind: str, found: str) -> str:
    """The entity behind a mention."""
    if kind == "email":
        return found.lower()
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", found)
    if kind == "phone":
        country = re.match(r"\+\d{1,3}(?=\D)", found)
        digits = re.sub(r"\D", "", found)
        return f"+{digits[: len(country[0]) - 1]} {digits[len(country[0]) - 1 :]}" if country else ("+" if found[0] == "+" else "") + digits
    if kind == "iban":
        return found.replace(" ", "")
    if kind == "name" and found.isupper() and len(found) > 2:
        return found.title()
    return found


def surrogate(key: bytes, kind: str, entity: str) -> str:
    """The surrogate of a canonical entity, canonical too."""
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        host, _, top = domain.rpartition(".")
        return f"{shifted(key, 'user', local)}@{shifted(key, 'domain', host)}.{top}"
    if kind == "phone":
        head, _, rest = entity.rpartition(" ")
        classes = [("23456789" if k == 0 and c in "23456789" else "0123456789" if c != "+" else None) for k, c in enumerate(rest)]
        return (head + " " if head else "") + shifted(key, f"{kind}{head}", rest, classes)
    if kind == "card":
        body, off = entity[1:-1], (int(entity[-1]) - luhn_digit(entity[:-1])) % 10
        body = entity[0] + shifted(key, f"{kind}{entity[0]}{len(entity)}{off}", body)
        return body + str((luhn_digit(body) + off) % 10)
    if kind == "iban":
        off = (_iban_rest(entity[4:] + entity[:4]) - 1) % 97
        bban = shifted(key, f"{kind}{entity[:2]}{off}", entity[4:])
        if off:
            return entity[:4] + bban
        return f"{entity[:2]}{98 - _iban_rest(bban + entity[:2] + '00'):02d}{bban}"
    if kind == "ip":
        x = functools.reduce(lambda v, part: v << 8 | int(part), entity.split("."), 0)
        own = next((name for name, (first, size) in _IP_BLOCKS.items() if first <= x < first + size), None)
        if own:
            first, size = _IP_BLOCKS[own]
            x = first + next_in_rank(key, f"{kind}{own}", x - first, size)
        else:  # public addresses by their number among themselves
            x -= sum(size for first, size in _IP_BLOCKS.values() if first < x)
            x = next_in_rank(key, f"{kind}public", x, (1 << 32) - sum(size for _, size in _IP_BLOCKS.values()))
            for first, size in _IP_BLOCKS.values():
                x += size if x >= first else 0
        return ".".join(str(x >> k & 255) for k in (24, 16, 8, 0))
    if kind == "given":
        pool, at = _POOLS[entity]
        return pool[next_in_rank(key, f"given{pool[0]}", at, len(pool))]
    return shifted(key, kind, entity)


@functools.lru_cache(maxsize=65536)
def _cached(key: bytes, kind: str, entity: str) -> str:
    return surrogate(key, kind, entity)


MEMOS.append(_cached.cache_clear)


def _dressed(kind: str, found: str, entity: str, made: str) -> str:
    """The surrogate written as the mention was: its separators and capitals."""
    if kind in ("name", "given") and found != entity:
        return made.upper() if found.isupper() else made.lower() if found.islower() else made
    if kind == "email":
        return "".join(c.upper() if f.isupper() else c for c, f in zip(made, found)) if len(made) == len(found) else made
    if kind in ("card", "ssn", "phone", "iban"):
        fill = iter(c for c in made if c.isalnum())
        return "".join(next(fill) if c.isalnum() else c for c in found)
    return made


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """Non-overlapping (start, end, kind, mention); where two overlap, the kind listed first in ``KINDS`` stays.

    A name that is found once in a text is an entity wherever else it stands in it as a word. Linear in the text.
    """
    kept: list[tuple[int, int, str, str]] = []
    taken = bytearray(len(text))

    def take(a: int, b: int, kind: str) -> None:
        if taken.find(1, a, b) < 0:
            taken[a:b] = b"\1" * (b - a)
            kept.append((a, b, kind, text[a:b]))

    numbers = _DIGIT.search(text)
    given: list[tuple[int, int]] = []
    for kind in KINDS:
        if kind == "email" and "@" not in text or kind in _NUMERIC and not numbers:
            continue
        for m in _PATTERNS[kind].finditer(text):
            if kind != "name":
                take(*m.span(), kind)
                continue
            last = "tlast" if m["title"] else "last"
            if not m[last][0].isupper():
                continue
            a, b = m.span(last)
            take(a, b - 2 if m[last].endswith("'s") and b - a > 3 else b, "name")
            given += [m.span(g) for g in ("tgiven", "given") if m[g]]
    for a, b in given:
        take(a, b, "given")
    names: dict[str, str] = {}
    for _, _, kind, found in kept:
        if kind in ("given", "name"):
            names[found.casefold()] = "given" if "given" in (kind, names.get(found.casefold())) else "name"
    if names:
        low = text.casefold() if len(names) <= _FEW_NAMES else ""
        if len(names) > _FEW_NAMES or any(low.count(n) > 1 for n in names):
            _further(text, names, take)
    return sorted(kept)


def _further(text: str, names: dict[str, str], take: Callable[[int, int, str, str], None]) -> None:
    """Other places of names that a text is known to hold: as written, in capitals, with a genitive s; in lower case beside another name."""
    last_end, last_low = -2, None  # the end of the word before, and its span and kind if it is a name in lower case
    for m in _WORD.finditer(text):
        word, (a, b) = m[0], m.span()
        kind = names.get(word.casefold())
        if kind is None and word[-1] in "sS" and len(word) > 3:
            kind, b = names.get(word[:-1].casefold()), b - 1
        low = None
        if kind and word[0].isupper():
            take(a, b, kind)
        elif kind:
            low = (a, b, kind)
            if last_low and a - last_end == 1:
                take(*last_low)
                take(*low)
        last_end, last_low = m.end(), low


def _originals(found: list[tuple[int, int, str, str]]) -> dict[str, str]:
    """How each name of a text is written where it is not in capitals or lower case."""
    return {name.casefold(): name for _, _, kind, name in reversed(found) if kind in ("name", "given") and not name.isupper() and not name.islower()}


def replaced(key: bytes, text: str) -> tuple[str, dict[str, int], list[tuple[str, str, str]]]:
    """(new text, mentions by kind, (kind, entity, surrogate) of each mention)."""
    parts, at, counts, pairs = [], 0, dict.fromkeys(KINDS, 0), []
    spans = mentions(text)
    originals = _originals(spans)
    for a, b, kind, found in spans:
        entity = originals.get(found.casefold()) or canonical(kind, found) if kind in ("name", "given") else canonical(kind, found)
        made = _cached(key, kind, entity)
        pairs.append((kind, entity, made))
        counts["name" if kind == "given" else kind] += 1
        parts += [text[at:a], _dressed(kind, found, entity, made)]
        at = b
    return "".join([*parts, text[at:]]), counts, pairs


def surrogate_map(documents: DataFrame, key: bytes = DEFAULT_KEY) -> DataFrame:
    """Distinct entities of all documents: ``kind, entity, surrogate, n_mentions``."""
    prepare(documents.sparkSession)

    def compute(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str, str], int] = {}
        for text in texts_of(batch):
            for pair in replaced(key, text)[2]:
                seen[pair] = seen.get(pair, 0) + 1
        columns = list(zip(*seen)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns), pa.array(seen.values(), pa.int64())], names=["kind", "entity", "surrogate", "n"])

    found = map_batches(documents.select(F.col("text").cast("string")), compute, "kind string, entity string, surrogate string, n long")
    return found.groupBy("kind", "entity", "surrogate").agg(F.sum("n").alias("n_mentions"))


def collisions(pairs: DataFrame) -> DataFrame:
    """Surrogates that stand for two or more entities of a kind: ``kind, surrogate, n_entities``."""
    return pairs.groupBy("kind", "surrogate").agg(F.count("*").alias("n_entities")).where("n_entities > 1")


def reused(pairs: DataFrame) -> DataFrame:
    """Surrogates that are also found as entities of the corpus: ``kind, surrogate, entity``.

    Such an entity has another surrogate wherever it is found, so in the result a value still
    names one entity; in small spaces, as that of given names, this is the rule.
    """
    real = pairs.select("kind", F.col("entity").alias("surrogate")).distinct()
    return pairs.select("kind", "surrogate", "entity").distinct().join(real, ["kind", "surrogate"])


def replace(documents: DataFrame, key: bytes = DEFAULT_KEY, check: bool = True) -> DataFrame:
    """``documents`` with new ``text``, and ``_n_<kind>`` counts.

    Null texts stay null, empty ones empty; other columns and repeated rows pass through; a
    column that is named like a count is overwritten. With ``check``, the distinct entities
    of the corpus are gathered first and two with one surrogate raise an error.
    """
    prepare(documents.sparkSession)
    if check:
        twice = collisions(materialize(surrogate_map(documents, key), "pii-map"))
        if not twice.isEmpty():
            raise RuntimeError("two entities have one surrogate")
    names = [f"_n_{k}" for k in KINDS]
    source = documents.drop(*names)
    at = source.columns.index("text")

    def compute(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, counts = [], {k: [] for k in KINDS}
        for text in batch.column(at).to_pylist():
            new, found, _ = replaced(key, text or "")
            texts.append(None if text is None else new)
            for k in KINDS:
                counts[k].append(found[k])
        columns = list(batch.columns)
        columns[at] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays([*columns, *(pa.array(counts[k], pa.int64()) for k in KINDS)], names=[*batch.schema.names, *names])

    schema = StructType([*source.schema.fields, *(StructField(name, LongType()) for name in names)])
    return map_batches(source, compute, schema)


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with surrogates: ``doc_id, text``, mentions by kind and in all."""
    done = replace(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    counts = [F.col(f"_n_{k}").alias(f"n_{k}") for k in KINDS]
    return done.select("doc_id", "text", *counts, sum((F.col(f"_n_{k}") for k in KINDS), F.lit(0)).alias("n_mentions"))
