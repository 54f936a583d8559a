"""Structures as columns: validity, fragments, scaffolds, fingerprints, counts, representations.

Parsing has no native form, so these run in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..chem import network, smiles

GRAPH = "atom array<int>, chirality array<int>, source array<int>, target array<int>, kind array<int>, direction array<int>"
COUNTS = "n_atoms int, n_bonds int, n_rings int, n_hetero int, charge int, n_hydrogens int, exact_mass double"


def _parsed(text: str | None) -> smiles.Molecule | None:
    try:
        return None if text is None else smiles.parse(text)
    except smiles.SmilesError:
        return None


def is_valid_smiles(c: Column) -> Column:
    """Whether a structure parses; false for null."""

    @F.pandas_udf("boolean")
    def valid(texts: pd.Series) -> pd.Series:
        return texts.map(smiles.is_valid)

    return valid(c)


def structure_columns(df: DataFrame, column: str = "smiles", radius: int = 2, size: int = 1024) -> DataFrame:
    """``df`` with ``structure_key``, ``fragment_key`` (largest fragment), ``scaffold_key``, ``fingerprint`` and ``counts``; null where a structure does not parse."""

    @F.pandas_udf(f"structure_key string, fragment_key string, scaffold_key string, fingerprint array<int>, counts struct<{COUNTS.replace(' ', ':').replace(',:', ',')}>")
    def compute(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            mol = _parsed(text)
            if mol is None:
                rows.append((None, None, None, None, None))
            else:
                main = smiles.largest_fragment(mol)
                rows.append((smiles.graph_key(mol), smiles.graph_key(main), smiles.graph_key(smiles.scaffold(main)), smiles.fingerprint(main, radius, size), smiles.describe(main)))
        return pd.DataFrame(rows, columns=["structure_key", "fragment_key", "scaffold_key", "fingerprint", "counts"])

    return df.withColumn("_s", compute(column)).select(*df.columns, "_s.*")


def graphs(df: DataFrame, column: str = "smiles") -> DataFrame:
    """``df`` with ``graph``: atom and bond indices, hydrogens added, each bond twice."""

    @F.pandas_udf(GRAPH)
    def compute(texts: pd.Series) -> pd.DataFrame:
        names = [c.split()[0] for c in GRAPH.split(", ")]
        found = [smiles.graph(m) if (m := _parsed(t)) is not None else dict.fromkeys(names) for t in texts]
        return pd.DataFrame(found, columns=names)

    return df.withColumn("graph", compute(column))


def represent(df: DataFrame, method: str = "network", weights: dict | None = None, layers: int = 5, column: str = "smiles", key: str = "chem_id") -> DataFrame:
    """``key`` and ``vector`` by "network" (which needs ``weights``), "fingerprint" or "counts"; rows whose structure does not parse are left out."""
    if method == "fingerprint":
        out = structure_columns(df.select(key, column), column).where("fingerprint is not null")
        return out.select(key, F.col("fingerprint").cast("array<float>").alias("vector"))
    if method == "counts":
        out = structure_columns(df.select(key, column), column).where("counts is not null")
        return out.select(key, F.array(*(F.col(f"counts.{c.split()[0]}").cast("float") for c in COUNTS.split(", "))).alias("vector"))
    if method != "network":
        raise ValueError(f"no such method: {method}")
    if weights is None:
        raise ValueError("the network needs weights")
    shared = df.sparkSession.sparkContext.broadcast(weights)
    kind = df.schema[key].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            mols = [(k, m) for k, t in zip(part[key], part[column]) if (m := _parsed(t)) is not None]
            if mols:
                made = network.embed([smiles.graph(m) for _, m in mols], shared.value, layers)
                yield pd.DataFrame({key: [k for k, _ in mols], "vector": list(made)})

    return df.select(key, column).mapInPandas(run, f"`{key}` {kind}, vector array<float>")
