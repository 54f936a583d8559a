"""Compound libraries: overlap filters, lookups, keys."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import clean_name


def without_names(library: DataFrame, known: DataFrame, name: str, known_name: str) -> DataFrame:
    """Rows whose cleaned name is not among the cleaned known names (null names stay)."""
    seen = known.select(clean_name(F.col(known_name)).alias("_seen")).where("_seen is not null").distinct()
    return library.join(seen, clean_name(F.col(name)) == F.col("_seen"), "left_anti")


def with_names(library: DataFrame, known: DataFrame, name: str, known_name: str) -> DataFrame:
    """Rows whose cleaned name is among the known ones."""
    seen = known.select(clean_name(F.col(known_name)).alias("_seen")).distinct()
    return library.join(seen, clean_name(F.col(name)) == F.col("_seen"), "left_semi")


def without_codes(library: DataFrame, known: DataFrame, codes: Column, known_codes: Column, key: str) -> DataFrame:
    """Rows that share no code with the known ones; both sides are arrays, and empty codes never match."""
    seen = known.select(F.explode(known_codes).alias("_code")).where("_code <> ''").distinct()
    hit = library.select(F.col(key).alias("_key"), F.explode(codes).alias("_code")).join(seen, "_code", "left_semi").select("_key").distinct()
    return library.join(hit, library[key] == hit["_key"], "left_anti")


def drop_overlap(library: DataFrame, known: DataFrame, name: str, codes: Column, known_codes: Column, key: str, listed: list) -> DataFrame:
    """Three filters in a row: known names, known codes, a list of keys."""
    left = without_codes(without_names(library, known, name, name), known, codes, known_codes, key)
    return left.where(~F.col(key).isin(listed))


def gather(df: DataFrame, keys: list, key: str) -> DataFrame:
    """Rows by a list of keys, in its order (``ord``) and as often as listed; a missing key is an error.

    The list comes from the driver, so it is the side that is sent to the rows (by its size, which the planner knows).
    """
    kind = df.schema[key].dataType
    wanted = df.sparkSession.createDataFrame(pa.table([pa.array(range(len(keys)), pa.int64()), pa.array(keys, to_arrow_type(kind))], names=["ord", "_key"]))
    missing = wanted.join(df.select(F.col(key).alias("_found")), F.col("_key") == F.col("_found"), "left_anti").select("_key").distinct().collect()
    if missing:
        raise KeyError(f"no such key: {', '.join(str(r[0]) for r in missing)}")
    return df.join(wanted, df[key] == F.col("_key")).drop("_key")


def lookup_by_number(queries: DataFrame, table: DataFrame, number: str, value: str, missing: str = "not_found") -> DataFrame:
    """``value`` by a compound's registry number (whole numbers, however written: 7, 7.0, "7"), else ``missing``."""
    whole = lambda c: F.col(c).cast("string").try_cast("double").try_cast("long")
    known = table.groupBy(whole(number).alias("_n")).agg(F.max(value).alias("_v"))
    out = queries.withColumn("_q", whole(number)).join(known, F.col("_q") == F.col("_n"), "left")
    return out.withColumn(value, F.coalesce("_v", F.lit(missing))).drop("_q", "_n", "_v")


def enrich(predictions: DataFrame, library: DataFrame, key: str, broad: DataFrame | None = None, cut: int = 10) -> DataFrame:
    """Predicted totals (``key``, ``nk_total``, scores) with the library's columns, ``broad_spectrum`` by ``cut``,
    and columns of ``broad`` (literature on some compounds) where there are any; predictions without a library row stay."""
    out = predictions.join(library, key, "left").withColumn("broad_spectrum", (F.col("nk_total") >= cut).cast("int"))
    return out if broad is None else out.join(broad, key, "left")


def lookup_with_fallback(queries: DataFrame, table: DataFrame, name: str, value: str, missing: str = "not_found") -> DataFrame:
    """``value`` by exact name, then by cleaned name, then ``missing``. Equal table names: the last value by order wins."""
    exact = table.groupBy(F.col(name).alias("_a")).agg(F.max(value).alias("_va"))
    folded = table.groupBy(clean_name(F.col(name)).alias("_b")).agg(F.max(value).alias("_vb"))
    out = queries.join(exact, queries[name] == F.col("_a"), "left").join(folded, clean_name(queries[name]) == F.col("_b"), "left")
    return out.withColumn(value, F.coalesce("_va", "_vb", F.lit(missing))).drop("_a", "_va", "_b", "_vb")
