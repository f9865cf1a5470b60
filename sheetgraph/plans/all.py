"""Every query module; importing this fills the register."""

from sheetgraph.plans import connect, crossings, detection, exchange, images, job, measures, resume, scalars, strings  # noqa: F401
from sheetgraph.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
