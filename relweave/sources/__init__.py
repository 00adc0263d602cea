"""Reading and writing files."""

from relweave.sources.readers import inline_lookup, read_csv, read_json, read_json_split, read_parquet, stage_json
from relweave.sources.writers import write_csv, write_json, write_parquet

__all__ = [
    "inline_lookup",
    "read_csv",
    "read_json",
    "read_json_split",
    "read_parquet",
    "stage_json",
    "write_csv",
    "write_json",
    "write_parquet",
]
