"""All registered queries."""

from ledgerflow.plans import (  # noqa: F401
    ingest_queries,
    ledger_queries,
    run_queries,
    text_queries,
)
from ledgerflow.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
