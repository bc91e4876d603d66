from .tables import append_evolving, create_table, create_table_as, replace_table

__all__ = ["append_evolving", "create_table", "create_table_as", "replace_table"]
