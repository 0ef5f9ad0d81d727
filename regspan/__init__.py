"""Lifecycle openness of study registrations, measured with Spark DataFrames."""

from regspan.schemas import REPORTING_LABELS, SUPPORTED_ATTRIBUTES
from regspan.sources.dump import Dump, open_dump, scan_table

__all__ = ["Dump", "REPORTING_LABELS", "SUPPORTED_ATTRIBUTES", "open_dump", "scan_table"]
