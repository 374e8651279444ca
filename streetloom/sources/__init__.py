from streetloom.sources.readers import (
    in_file_order,
    read_csv,
    read_csv_positional,
    read_jsonl,
    read_parquet,
    rejected_files,
    rejected_records,
)
from streetloom.sources.writers import write_by_radius, write_csv, write_metrics, write_parquet

__all__ = [
    "in_file_order",
    "read_csv",
    "read_csv_positional",
    "read_jsonl",
    "read_parquet",
    "rejected_files",
    "rejected_records",
    "write_by_radius",
    "write_csv",
    "write_metrics",
    "write_parquet",
]
