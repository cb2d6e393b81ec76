"""All registered queries."""

from churnkit.plans import q_actions, q_building_blocks, q_datagen, q_layers, q_ml  # noqa: F401
from churnkit.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
