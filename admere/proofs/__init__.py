"""Every operator and table of the pipeline, run on the driver tables, with SQL to check it."""

from admere.proofs import events, foundations, groups, increments, models, quality, streams  # noqa: F401
from admere.proofs.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
