"""Fixture mappings and the registered query catalogue."""

from kelpie.plans import (  # noqa: F401  (importing registers the queries)
    q_codecs,
    q_federated,
    q_files,
    q_learning,
    q_ledger,
    q_metrics,
    q_relational,
    q_sequences,
    q_serving,
    q_streaming,
)
from kelpie.plans.registry import ORACLE, QUERIES  # noqa: F401
