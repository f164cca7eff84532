"""Text functions: whitespace, newlines, headers and prompt templates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from callweave.constants import (CALL_HEADER_FORMAT, MISSING_DATE, MISSING_NAME, MISSING_NUMBER,
                                 NULL_SENTINEL)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# The characters of Java's \s class: space, tab, LF, VT, FF, CR.
ASCII_WHITESPACE = " \t\n\x0b\x0c\r"


def strip_whitespace(col, unicode: bool = False) -> Column:
    """Remove leading and trailing whitespace (spaces, tabs, newlines...).

    ``trim`` alone strips only spaces. The default strips the ASCII
    whitespace set with ``btrim``, which touches only the two ends of the
    string (no regex scan over long texts). ``unicode=True`` also strips
    Unicode spaces such as NBSP, like Python's ``str.strip``, via a regex.
    """
    if unicode:
        inner = F.regexp_replace(_c(col), r"^(?U)\s+", "")
        return F.regexp_replace(inner, r"(?U)\s+$", "")
    return F.btrim(_c(col), F.lit(ASCII_WHITESPACE))


def normalize_newlines(col) -> Column:
    """``\\r\\n`` and lone ``\\r`` -> ``\\n``, as a text-mode read would."""
    return F.regexp_replace(_c(col), "\r\n?", "\n")


def null_to_sentinel(col, sentinel: str = NULL_SENTINEL) -> Column:
    return F.coalesce(_c(col).cast("string"), F.lit(sentinel))


def render(fmt: str, **values) -> Column:
    """Fill a fixed ``{name}`` format with columns: the format is split once
    on the driver into literal pieces and placeholders, and the row value is
    a single ``concat`` (no per-row parsing, no chained replaces)."""
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", fmt)):
        if i % 2 == 0:
            if piece:
                parts.append(F.lit(piece))
        else:
            parts.append(values[piece])
    return F.concat(*parts)


def call_header(call_no, created, duration, agent) -> Column:
    """The per-call header line (``CALL_HEADER_FORMAT``). Every value is
    cast and coalesced, so a missing one prints a placeholder instead of
    nulling the whole header."""
    return render(
        CALL_HEADER_FORMAT,
        call_no=_c(call_no).cast("string"),
        created=F.coalesce(_c(created).cast("string"), F.lit(MISSING_DATE)),
        duration=F.coalesce(_c(duration).cast("string"), F.lit(MISSING_NUMBER)),
        agent=F.coalesce(_c(agent).cast("string"), F.lit(MISSING_NAME)),
    )


def fill_template(template: str, **values) -> Column:
    """Replace ``{name}`` placeholders of a fixed template with columns."""
    out = F.lit(template)
    for key, value in values.items():
        val = F.coalesce(_c(value).cast("string"), F.lit(MISSING_NAME))
        out = F.replace(out, F.lit("{" + key + "}"), val)
    return out
