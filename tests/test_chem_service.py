import json
import os
import random
import sys
import threading
import urllib.request

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from published import MOLECULES  # noqa: E402

from plateworks import service  # noqa: E402
from plateworks.chem import network, smiles  # noqa: E402
from plateworks.operators import scoring, structures, training  # noqa: E402


def test_parsing():
    for _, text in MOLECULES:
        assert smiles.is_valid(text), text
    for bad in ("", "C(", "C1CC", "X", "C(C)(C)(C)(C)C", "[Zz]", "F=C=", "c1ccccc1(", "CC)", "C=#C", "c", None):
        assert not smiles.is_valid(bad), bad
    counts = smiles.describe(smiles.parse("OC(=O)c1ccccc1OC(C)=O"))
    assert counts["n_atoms"] == 13 and counts["n_rings"] == 1 and counts["n_hydrogens"] == 8 and abs(counts["exact_mass"] - 180.0423) < 1e-3


def test_keys_do_not_depend_on_order():
    assert smiles.graph_key(smiles.parse("OCC")) == smiles.graph_key(smiles.parse("CCO")) != smiles.graph_key(smiles.parse("COC"))
    assert smiles.graph_key(smiles.largest_fragment(smiles.parse("CC(=O)[O-].[Na+]"))) == smiles.graph_key(smiles.parse("CC(=O)[O-]"))
    assert smiles.graph_key(smiles.scaffold(smiles.parse("CCc1ccccc1CCN"))) == smiles.graph_key(smiles.parse("c1ccccc1"))
    assert smiles.graph_key(smiles.scaffold(smiles.parse("CCO"))) == ""
    assert smiles.fingerprint(smiles.parse("OCC")) == smiles.fingerprint(smiles.parse("CCO"))


def test_network_is_invariant():
    w = network.random_weights(3, 16)
    mols = [smiles.parse(t) for _, t in MOLECULES]
    together = network.embed([smiles.graph(m) for m in mols], w, 3)
    assert together.shape == (len(mols), 48)
    for m, row in zip(mols, together):
        order = list(range(len(m.atoms)))
        random.Random(1).shuffle(order)
        assert np.allclose(network.embed([smiles.graph(m.part(order))], w, 3)[0], row, rtol=1e-3, atol=1e-3)


def test_structure_columns(spark):
    df = spark.createDataFrame([*MOLECULES, ("bad", "C1"), ("none", None)], "chem_id string, smiles string")
    out = {r.chem_id: r for r in structures.structure_columns(df).collect()}
    assert out["bad"].fingerprint is None and len(out["Halicin"].fingerprint) == 1024 and out["Halicin"].counts.n_rings == 2
    assert df.where(structures.is_valid_smiles(F.col("smiles"))).count() == len(MOLECULES)
    vectors = structures.represent(df, "network", network.random_weights(2, 8), 2)
    assert vectors.count() == len(MOLECULES) and len(vectors.first().vector) == 16
    assert structures.represent(df, "counts").count() == len(MOLECULES)
    assert len(structures.graphs(df).where("chem_id = 'Halicin'").first().graph.atom) == 18


def scorer(molecules):
    strains = molecules.sparkSession.createDataFrame([("A (NT1)", "negative", 0.5), ("B (NT2)", "positive", 0.01)], "strain_name string, gram_stain string, p double")
    return scoring.pair_all(molecules, strains)


def test_requests(spark):
    params = {"molecules": [{"smiles": "CCO"}, {"smiles": "C1", "chem_id": "bad"}, {"smiles": "CCN", "chem_id": "amine"}], "smiles": "ignored"}
    out = "".join(service.answer(spark, {"id": "7", "method": "predict", "params": params}, scorer))
    kinds = [x.split("\n")[0] for x in out.strip().split("\n\n")]
    assert kinds == ["event: start", "event: data", "event: end"]
    data = json.loads(out.split("event: data\ndata: ")[1].split("\n")[0])["result"]
    assert {r["pred_id"] for r in data} == {f"{c}:{s}" for c in ("mol1", "amine") for s in ("A (NT1)", "B (NT2)")}
    total = service.tool(spark, scorer)({"smiles": "CCO", "aggregate_scores": True, "min_nkill": 1})
    assert total[0]["chem_id"] == "mol1" and total[0]["ginhib_total"] == 1 and total[0]["broad_spectrum"] == 1
    assert "event: error" in "".join(service.answer(spark, {"id": "1", "method": "other"}, scorer))
    assert "event: error" in "".join(service.answer(spark, {"id": "1", "method": "predict", "params": {}}, scorer))


def test_http(spark):
    server = service.serve(spark, scorer, 0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_address[1]}"
    try:
        assert json.loads(urllib.request.urlopen(f"{base}/mcp/schema").read())["method"] == "predict"
        body = json.dumps({"id": "a", "method": "predict", "params": {"smiles": "CCO"}}).encode()
        assert b"event: end" in urllib.request.urlopen(urllib.request.Request(f"{base}/mcp", body)).read()
    finally:
        server.shutdown()


def test_training(spark):
    rng = random.Random(3)
    vectors = [(f"c{k}", [rng.random() for _ in range(3)]) for k in range(60)]
    screen = [(c, s, int(v[0] + 0.2 * o > 0.6)) for c, v in vectors for o, s in enumerate(("A", "B"))]
    frame = training.training_frame(
        spark.createDataFrame(screen, "chem_id string, strain_name string, label int"), spark.createDataFrame(vectors, "chem_id string, vector array<float>"),
        spark.createDataFrame([("A", 0), ("B", 1)], "strain_name string, strain_ord int"),
        spark.createDataFrame([(c, "train" if k < 40 else "valid" if k < 50 else "test") for k, (c, _) in enumerate(vectors)], "chem_id string, split string"), 2,
    ).cache()
    assert frame.count() == 120
    log = training.search(frame, 1, grid={"maxDepth": [3], "maxIter": [5], "stepSize": [0.3]})
    assert log[0]["test_auroc"] > 0.8
    table = training.evaluate_models(frame, "random", 2, 2, grid={"maxDepth": [2, 3], "maxIter": [3], "stepSize": [0.3]}).collect()
    assert [(r.model, r.train) for r in table] == [(f"model_{m}", f"train_{t}") for m in (0, 1) for t in (0, 1)] and all(0 <= r.validation_f1 <= 1 and r.test_prauc > 0 for r in table)
    assert len({r.seed for r in table}) == 4 and {r.representation for r in table} == {"random"}
    with pytest.raises(ValueError):
        training.fit(frame, {"maxDepth": 31})
    assert len(training.draw({"a": [1, 2], "b": [1]}, 9, 1)) == 2


def test_training_frame_keeps_every_strain(spark):
    strains = spark.range(10_050).select(F.concat(F.lit("s"), "id").alias("strain_name"), F.lit(0).alias("strain_ord"))
    screen = strains.select(F.lit("c").alias("chem_id"), "strain_name", F.lit(1).alias("label"))
    vectors = spark.createDataFrame([("c", [1.0])], "chem_id string, vector array<float>")
    frame = training.training_frame(screen, vectors, strains, spark.createDataFrame([("c", "train")], "chem_id string, split string"), 1)
    assert frame.count() == 10_050


@pytest.mark.parametrize("text,tips", [("(('A x':4,B:2)P:1,C);", {("A x", "P"), ("B", "P"), ("C", None)})])
def test_newick(spark, text, tips):
    from plateworks.sources import newick_tips

    assert {(r.tip, r.parent) for r in newick_tips(spark, text).collect()} == tips
