"""Inputs: Parquet tables, raw CSV files, and the retail frames built on them
(``Retail`` over the test data set, ``RetailFiles`` over the raw CSV files)."""

from .retail_files import RetailFiles
from .proxies import Retail

__all__ = ["Retail", "RetailFiles"]
