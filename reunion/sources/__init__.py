"""Input relations: given tables, the demo view and derived workloads."""

from .fixtures import (
    WORKLOADS,
    customers,
    document_texts,
    part_attributes,
    planted_customers,
    sample_customers,
)
from .tables import read_table, register_tables

__all__ = [
    "WORKLOADS",
    "customers",
    "document_texts",
    "part_attributes",
    "planted_customers",
    "read_table",
    "register_tables",
    "sample_customers",
]
