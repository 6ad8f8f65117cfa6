"""DataFrame -> DataFrame operators."""

from landfall.operators.quality import drop_reasons, key_report, schema_report
from landfall.operators.relational import (
    drop_null_keys,
    fits_broadcast,
    keep_first,
    label_or_other,
    lookup_left,
    union_codes,
)

__all__ = [
    "drop_null_keys", "drop_reasons", "fits_broadcast", "keep_first", "key_report",
    "label_or_other", "lookup_left", "schema_report", "union_codes",
]
