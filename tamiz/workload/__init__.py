"""Queries over the driver tables; importing the package registers them."""

from tamiz.workload import audit_queries, edge_queries, flow_queries, gold_queries, load_queries, shape_queries, state_queries, table_queries, text_queries  # noqa: F401
from tamiz.workload.registry import ORACLES, QUERIES  # noqa: F401
