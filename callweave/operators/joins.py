"""Join keys that do not gather NULLs.

A sort-merge join hashes every row with a NULL key to one partition even
though none of them can match. :func:`match_key` gives such rows a key of
their own that matches nothing, dealt by a salt, so an outer or anti join
keeps them where they are spread. Nothing else about a join is decided
here: Spark picks the strategy from the sizes it sees at run time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# U+0000 cannot occur in a call, account or user id.
_NO_KEY = "\x00"


def match_key(key, *salt) -> Column:
    """``key`` as a string; NULL becomes a string no id equals, one of many by ``salt``."""
    c = F.col(key) if isinstance(key, str) else key
    return F.coalesce(c.cast("string"), F.concat(F.lit(_NO_KEY), F.xxhash64(*salt).cast("string")))
