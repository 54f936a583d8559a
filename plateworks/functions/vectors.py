"""Vector and bit-set expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(c: Column) -> Column:
    return F.transform(c, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v * v))


def cosine_distance(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """1 - cosine; null if one is zero."""
    return 1 - F.try_divide(dot(a, b), (norm(a) if norm_a is None else norm_a) * (norm(b) if norm_b is None else norm_b))


def bits_of(vector: Column, width: int = 64) -> Column:
    """The signs of up to 64 values as one number: bit k is set if value k is positive."""
    # The sum may use the sign bit: shift and or, not powers of two.
    flags = F.transform(vector, lambda x, k: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), k)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(F.slice(flags, 1, width), F.lit(0).cast("long"), lambda s, v: s.bitwiseOR(v))


def bit_similarity(a: Column, b: Column) -> Column:
    """Shared over set bits; two empty sets are alike."""
    return F.coalesce(F.try_divide(F.bit_count(a.bitwiseAND(b)).cast("double"), F.bit_count(a.bitwiseOR(b)).cast("double")), F.lit(1.0))


def bit_distance(a: Column, b: Column) -> Column:
    return 1 - bit_similarity(a, b)


def hamming_share(a: Column, b: Column, width: int = 64) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) / F.lit(float(width))


def set_bits(c: Column, width: int) -> Column:
    """A number's bits as an array of 0 and 1, lowest first."""
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: F.getbit(c, k).cast("int"))


def one_hot(ordinal: Column, width: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: (k == ordinal).cast("int"))
