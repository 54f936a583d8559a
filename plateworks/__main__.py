"""Command line: ``represent`` structures, ``predict`` from a table of pairwise scores."""

from __future__ import annotations

import argparse

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import sources
from .operators import scoring, structures


def main(args: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="plateworks")
    commands = top.add_subparsers(dest="command", required=True)
    rep = commands.add_parser("represent", help="structures to vectors")
    pre = commands.add_parser("predict", help="pairwise scores to predictions or potentials")
    for one in (rep, pre):
        one.add_argument("source")
        one.add_argument("target")
    rep.add_argument("-c", "--smiles-column", default="smiles")
    rep.add_argument("-i", "--id-column", default="chem_id")
    rep.add_argument("-m", "--method", default="network", choices=["network", "fingerprint", "counts"])
    rep.add_argument("-w", "--weights", help="npz file of the network's weights; the network needs one")
    pre.add_argument("-a", "--aggregate", action="store_true")
    pre.add_argument("-s", "--strains", required=True, help="TSV with strain_name, gram_stain")
    pre.add_argument("-t", "--threshold", type=float, default=scoring.THRESHOLD)
    pre.add_argument("-k", "--min-strains", type=int, default=scoring.BROAD_STRAINS)
    o = top.parse_args(args)
    if o.command == "represent" and o.method == "network" and not o.weights:
        top.error("represent by the network needs --weights")
    spark = SparkSession.builder.appName("plateworks").getOrCreate()
    if o.command == "represent":
        made = structures.represent(sources.read_molecules(spark, o.source, o.smiles_column, o.id_column), o.method, dict(np.load(o.weights)) if o.method == "network" else None)
        width = len((made.first() or ([], []))[1])
        sources.write_tsv(made.select("chem_id", *(F.get("vector", F.lit(k)).alias(str(k)) for k in range(width))), o.target)
        return
    pairs = spark.read.option("sep", "\t").option("header", True).csv(o.source)
    scored = scoring.split_pair_id(pairs).withColumn("p", F.col("antimicrobial_predictive_probability").cast("double"))
    strains = spark.read.option("sep", "\t").option("header", True).csv(o.strains).select("strain_name", "gram_stain")
    scored = scored.join(strains, "strain_name", "left")
    if o.aggregate:
        out = scoring.potential(scored, o.threshold, o.min_strains).orderBy("chem_id")
    else:
        out = scored.select("pred_id", "antimicrobial_predictive_probability", scoring.inhibited(F.col("p"), o.threshold).alias("growth_inhibition"))
    sources.write_tsv(out, o.target)


if __name__ == "__main__":
    main()
