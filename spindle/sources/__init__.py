"""Sources and sinks: the driver's Parquet tables and CSV read/write."""

from spindle.sources.tables import load_table, TABLES
from spindle.sources.csv import read_csv, read_pair, write_csv

__all__ = ["load_table", "TABLES", "read_csv", "read_pair", "write_csv"]
