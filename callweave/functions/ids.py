"""Call-id handling: ids are compared as strings everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from callweave.constants import AUDIO_EXT, CALL_ID_PATTERN


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def id_to_string(col) -> Column:
    """Numeric feed id -> the string key used by file names and URLs."""
    return _c(col).cast("string")


def extract_call_id(url) -> Column:
    """Digits after ``calls/`` in a recording URL; NULL when absent.

    ``regexp_extract`` yields '' on no match, which would be a key that joins
    nothing yet looks present, so it is turned into NULL.
    """
    return F.nullif(F.regexp_extract(_c(url), CALL_ID_PATTERN, 1), F.lit(""))


def strip_extension(name, ext: str = AUDIO_EXT) -> Column:
    """File name -> id by removing the extension wherever it occurs."""
    return F.replace(_c(name), F.lit(ext), F.lit(""))


def artifact_path(folder: str, key, ext: str) -> Column:
    """``<folder>/<key><ext>``; a NULL key gives ``<folder>/None<ext>`` like
    a formatted missing value would."""
    key_str = F.coalesce(_c(key).cast("string"), F.lit("None"))
    return F.concat(F.lit(folder.rstrip("/") + "/"), key_str, F.lit(ext))
