from .ingest import (
    append_batches,
    append_to_evolving_table,
    append_to_table,
    enrich_stream,
    infer_schema,
    open_file_stream,
    read_batches,
)

__all__ = [
    "append_batches",
    "append_to_evolving_table",
    "append_to_table",
    "enrich_stream",
    "infer_schema",
    "open_file_stream",
    "read_batches",
]
