"""All named plans, grouped by the section of the blueprint they cover."""

from dunlin.plans.registry import PLANS, Plan, Tables
from dunlin.plans import functions, graphs, learning, relational, statistics, storage, streams, texts  # noqa: F401

__all__ = ["PLANS", "Plan", "Tables"]
