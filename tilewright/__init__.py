"""Table profiling and load planning on Spark."""

from tilewright.params import PlanParams
from tilewright.plans import Analysis, analyze
from tilewright.session import build_session
from tilewright.sources import Catalog, TableSpec, build_catalog

__all__ = [
    "Analysis",
    "Catalog",
    "PlanParams",
    "TableSpec",
    "analyze",
    "build_catalog",
    "build_session",
]
