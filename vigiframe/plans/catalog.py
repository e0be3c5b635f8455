"""Imports every query module so the registry is complete."""

from vigiframe.plans import q_core, q_pipes, q_publish, q_relational, q_scalars  # noqa: F401
from vigiframe.plans.registry import ORACLE, QUERIES  # noqa: F401
