"""Replicate source tables into an analytics store with PySpark."""

from tidemark.functions.marks import Mark
from tidemark.plans.replica import BadDelta, LostRace, Replica

__all__ = ["BadDelta", "LostRace", "Mark", "Replica"]
