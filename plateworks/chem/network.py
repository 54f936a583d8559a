"""A graph network's forward pass in numpy: edge-aware sum aggregation, layer outputs pooled and concatenated.

Weights come as a dictionary of arrays; unknown names are ignored.
"""

from __future__ import annotations

import numpy as np

SELF_LOOP_KIND = 4


def random_weights(layers: int = 5, width: int = 200, seed: int = 0) -> dict[str, np.ndarray]:
    """Weights of the right shapes, for tests and as a stable random projection."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-1])).astype(np.float32)
    out = {"atom": draw(119, width), "chirality": draw(3, width)}
    for k in range(layers):
        out |= {f"{k}.kind": draw(5, width), f"{k}.direction": draw(3, width), f"{k}.w1": draw(2 * width, width), f"{k}.b1": draw(2 * width), f"{k}.w2": draw(width, 2 * width), f"{k}.b2": draw(width)}
        out |= {f"{k}.scale1": np.ones(2 * width, np.float32), f"{k}.shift1": np.zeros(2 * width, np.float32), f"{k}.scale": np.ones(width, np.float32), f"{k}.shift": np.zeros(width, np.float32)}
    return out


def embed(graphs: list[dict[str, list]], weights: dict[str, np.ndarray], layers: int = 5, pool: str = "add") -> np.ndarray:
    """One vector a graph: the pooled output of every layer side by side. Batches do not change results."""
    sizes = [len(g["atom"]) for g in graphs]
    offset = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
    cat = lambda key, shift=False: np.concatenate([np.asarray(g[key], int) + (offset[n] if shift else 0) for n, g in enumerate(graphs)]) if graphs else np.empty(0, int)
    h = weights["atom"][cat("atom")] + weights["chirality"][cat("chirality")]
    source, target, kind, direction = cat("source", True), cat("target", True), cat("kind"), cat("direction")
    owner = np.repeat(np.arange(len(graphs)), sizes)
    out = []
    for k in range(layers):
        edge = weights[f"{k}.kind"][kind] + weights[f"{k}.direction"][direction]
        got = h + weights[f"{k}.kind"][SELF_LOOP_KIND] + weights[f"{k}.direction"][0]
        np.add.at(got, target, h[source] + edge)
        x = got @ weights[f"{k}.w1"].T + weights[f"{k}.b1"]
        x = np.maximum(x * weights[f"{k}.scale1"] + weights[f"{k}.shift1"], 0)
        x = np.maximum(x @ weights[f"{k}.w2"].T + weights[f"{k}.b2"], 0)
        h = x * weights[f"{k}.scale"] + weights[f"{k}.shift"]
        if k < layers - 1:
            h = np.maximum(h, 0)
        pooled = np.zeros((len(graphs), h.shape[1]), h.dtype)
        if pool == "max":
            pooled[:] = -np.inf
            np.maximum.at(pooled, owner, h)
        else:
            np.add.at(pooled, owner, h)
            if pool == "mean":
                pooled /= np.maximum(1, np.array(sizes))[:, None]
        out.append(pooled)
    return np.concatenate(out, axis=1)
