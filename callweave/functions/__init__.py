"""Scalar column functions, all built from ``pyspark.sql.functions``
(JVM-side, inside whole-stage codegen; no Python UDF)."""

from callweave.functions.ids import (artifact_path, extract_call_id, id_to_string,
                                     strip_extension)
from callweave.functions.text import (call_header, fill_template, normalize_newlines,
                                      null_to_sentinel, strip_whitespace)
from callweave.functions.time import (epoch_to_timestamp, lookback_start_epoch, run_date_string,
                                      timestamp_to_epoch)

__all__ = [
    "artifact_path", "extract_call_id", "id_to_string", "strip_extension",
    "call_header", "fill_template", "normalize_newlines", "null_to_sentinel",
    "strip_whitespace", "epoch_to_timestamp", "lookback_start_epoch",
    "run_date_string", "timestamp_to_epoch",
]
