"""Structures in plain Python: parsing, graphs, fingerprints, a graph network. See the README for limits."""
