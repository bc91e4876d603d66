from .files import file_inventory, read_csv, read_parquet, rows_per_file
from .tables import read_table

__all__ = ["file_inventory", "read_csv", "read_parquet", "read_table", "rows_per_file"]
