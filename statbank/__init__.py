"""statbank: regional statistics (indicator, territorial unit, year, value) on Spark DataFrames."""

from statbank.plans.explore import Selection, build, export, resolve, series_chart
from statbank.plans.get import get
from statbank.plans.store import Store, build_store, export_store

__all__ = [
    "Selection",
    "Store",
    "build",
    "build_store",
    "export",
    "export_store",
    "get",
    "resolve",
    "series_chart",
]
