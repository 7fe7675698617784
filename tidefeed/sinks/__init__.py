from tidefeed.sinks.files import (
    as_json,
    audit_outputs,
    text_form,
    write_csv,
    write_json,
    write_json_arrays,
    write_outputs,
)

__all__ = [
    "as_json",
    "audit_outputs",
    "text_form",
    "write_csv",
    "write_json",
    "write_json_arrays",
    "write_outputs",
]
