from tidefeed.sources.database import read_database, read_jdbc_table
from tidefeed.sources.files import (
    any_of,
    audit_files,
    id_number_pairs,
    load,
    load_split,
    read_delimited,
    read_json,
)

__all__ = [
    "any_of",
    "audit_files",
    "id_number_pairs",
    "load",
    "load_split",
    "read_database",
    "read_delimited",
    "read_jdbc_table",
    "read_json",
]
