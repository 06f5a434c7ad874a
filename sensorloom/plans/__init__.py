"""Whole flows, the catalog, and facts about query plans."""

from sensorloom.plans.catalog import cached, define_table, register, reset, view
from sensorloom.plans.facts import plan_facts
from sensorloom.plans.medallion import READING_RULES, bronze, gold, silver

__all__ = [
    "READING_RULES", "bronze", "cached", "define_table", "gold", "plan_facts", "register", "reset", "silver", "view",
]
