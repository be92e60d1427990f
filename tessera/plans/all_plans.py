"""Imports every query module and exposes the filled registry."""

from tessera.plans import (  # noqa: F401
    bi_plans, dataset_plans, evaluation_plans, flow_plans, graph_plans, node_plans, retrieval_plans, similarity_plans, source_plans, streaming_plans,
    vector_plans)
from tessera.plans.registry import ORACLE, QUERIES  # noqa: F401
