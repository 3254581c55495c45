"""All catalogue queries, registered by importing their modules."""

from noticelens.plans import clusters, evaluation, labelling, preparation, training  # noqa: F401
from noticelens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
