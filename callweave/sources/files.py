"""Folders of per-key files read as keyed tables.

The reference keeps one file per call or account (``<id>.mp3``,
``<id>.txt``). Here a folder becomes a table keyed by the file name, read
in parallel and then *joined* on the key -- never opened one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.constants import AUDIO_EXT, TEXT_EXT
from callweave.functions.ids import strip_extension
from callweave.functions.text import normalize_newlines
from callweave.sources import listing


def _file_name(path_col):
    return F.regexp_extract(path_col, r"([^/]+)$", 1)


def list_artifacts(spark: SparkSession, folder: str, kind: str,
                   ext: str = AUDIO_EXT) -> DataFrame:
    """(kind, name, call_id) for every ``*<ext>`` file of a folder.

    Uses the binary-file source with the ``content`` column pruned, so only
    the listing is read. Zero-byte files are skipped by Spark's file scans;
    where empty artifacts must count as held, keep a manifest table instead
    and pass it where ``artifacts`` is expected.
    """
    listing = (spark.read.format("binaryFile")
               .option("pathGlobFilter", f"*{ext}")
               .load(folder)
               .select("path"))
    name = _file_name(F.col("path"))
    return listing.select(F.lit(kind).alias("kind"), name.alias("name"),
                          strip_extension(name, ext).alias("call_id"))


def read_keyed_texts(spark: SparkSession, folder: str, key: str = "key",
                     ext: str = TEXT_EXT, shards: Sequence[str] = ()) -> DataFrame:
    """(key, text) with one row per ``<key><ext>`` file, whole file as text.

    Newlines are normalised to ``\\n`` as a text-mode read would do. With
    ``shards`` (subfolders that need not exist) the files lie in those, and
    tasks list and read them; a folder without is listed by the driver and
    planned file by file, which suits some thousands of files.
    """
    if shards:
        held = listing.read_files(spark, folder, ext, shards)
        return held.select(strip_extension(F.col("name"), ext).alias(key),
                           normalize_newlines(F.col("content").cast("string")).alias("text"))
    raw = (spark.read.option("pathGlobFilter", f"*{ext}")
           .text(folder, wholetext=True)
           .select(F.col("value"), F.col("_metadata.file_name").alias("_fname")))
    return raw.select(strip_extension(F.col("_fname"), ext).alias(key),
                      normalize_newlines(F.col("value")).alias("text"))
