"""Readers and writers for screening files."""

from .readers import (  # noqa: F401
    molecules_from_request,
    newick_tips,
    read_matrix,
    read_molecules,
    read_plates,
    read_representation,
    read_sheet,
)
from .writers import append_tsv, events, markdown, records, write_csv, write_shards, write_sheets, write_tsv  # noqa: F401
