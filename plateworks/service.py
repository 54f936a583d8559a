"""Serving: a request is answered as a stream of events; scorers are pluggable."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sources
from .operators import scoring
from .operators.structures import is_valid_smiles

#: A scorer takes molecules (ord, chem_id, smiles) and gives (chem_id, strain_name, gram_stain, p).
Scorer = Callable[[DataFrame], DataFrame]
SCHEMA = {
    "method": "predict",
    "params": {"molecules": "[{smiles, chem_id?}]", "smiles": "string", "chem_id": "string", "aggregate_scores": "boolean = false", "app_threshold": f"number = {scoring.THRESHOLD}", "min_nkill": f"integer = {scoring.BROAD_STRAINS}"},
    "result": {"pairwise": ["pred_id", "antimicrobial_predictive_probability", "growth_inhibition"], "aggregated": ["chem_id", "apscore_total", "apscore_gnegative", "apscore_gpositive", "ginhib_total", "ginhib_gnegative", "ginhib_gpositive", "broad_spectrum"]},
}


def predict(spark: SparkSession, params: dict, scorer: Scorer) -> DataFrame:
    """Pairwise or aggregated predictions for a request's parameters; structures that do not parse are left out."""
    molecules = sources.molecules_from_request(spark, params)
    scored = scorer(molecules.where(is_valid_smiles(F.col("smiles"))))
    threshold = float(params.get("app_threshold", scoring.THRESHOLD))
    if params.get("aggregate_scores"):
        return scoring.potential(scored, threshold, int(params.get("min_nkill", scoring.BROAD_STRAINS))).orderBy("chem_id")
    return scored.select(scoring.pair_id(F.col("chem_id"), F.col("strain_name")).alias("pred_id"), F.col("p").alias("antimicrobial_predictive_probability"), scoring.inhibited(F.col("p"), threshold).alias("growth_inhibition"))


def answer(spark: SparkSession, request: dict, scorer: Scorer) -> Iterator[str]:
    """The events that answer a request."""
    name = str(request.get("id", ""))
    if request.get("method") != "predict":
        yield from sources.events(name, error=f"unknown method: {request.get('method')}")
        return
    try:
        found = sources.records(predict(spark, request.get("params") or {}, scorer))
    except Exception as error:  # a request's failure is its answer
        yield from sources.events(name, error=str(error))
        return
    yield from sources.events(name, result=found)


def tool(spark: SparkSession, scorer: Scorer) -> Callable[[dict], list[dict]]:
    """The same as a plain function, for tool protocols."""
    return lambda params: sources.records(predict(spark, params, scorer))


def serve(spark: SparkSession, scorer: Scorer, port: int = 8000) -> ThreadingHTTPServer:
    """An HTTP server (not started): POST /mcp answers requests, GET /mcp/schema describes them."""

    class Handler(BaseHTTPRequestHandler):
        def _send(self, code: int, kind: str, body: bytes) -> None:
            self.send_response(code)
            self.send_header("Content-Type", kind)
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self) -> None:  # noqa: N802
            known = self.path == "/mcp/schema"
            self._send(200 if known else 404, "application/json", json.dumps(SCHEMA if known else {"error": "not found"}).encode())

        def do_POST(self) -> None:  # noqa: N802
            try:
                request = json.loads(self.rfile.read(int(self.headers.get("Content-Length", 0))))
            except ValueError as error:
                self._send(400, "application/json", json.dumps({"error": str(error)}).encode())
                return
            self._send(200, "text/event-stream", "".join(answer(spark, request, scorer)).encode())

        def log_message(self, *args) -> None:
            pass

    return ThreadingHTTPServer(("127.0.0.1", port), Handler)
