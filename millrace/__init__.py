"""Cleaning and consolidating tabular exports on Spark."""

from millrace.plans.clean import Batch, CleanOptions, clean_files, clean_table
from millrace.plans.master import Master, build_master
from millrace.sinks.files import save_master
from millrace.sinks.table import TableTarget, load_table, validate_target
from millrace.sources.assess import assess_files

__all__ = [
    "Batch", "CleanOptions", "Master", "TableTarget", "assess_files", "build_master",
    "clean_files", "clean_table", "load_table", "save_master", "validate_target",
]
