"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Hashable
from types import ModuleType
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words: maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (the SQL ``lower`` folds all of Unicode)."""
    return F.translate(c, _UPPER, _LOWER)


def utf8(c: Column) -> Column:
    """A text column as its UTF-8 bytes, null as empty: what the Arrow operators take."""
    return F.coalesce(c, F.lit("")).cast("binary")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gave the first time in this Python worker: for tables that take long to load, whatever tasks come."""
    store = sys.modules.setdefault("_strata_kept", ModuleType("_strata_kept")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def strip_scheme(uri: str) -> str:
    """``file:`` URIs as plain paths; others unchanged."""
    return re.sub(r"^file:/+", "/", uri)


def bitmap_of(ids: DataFrame, key: str, buckets: int) -> DataFrame:
    """``ids[key]`` as hashed bitmaps: at most ``buckets`` rows of 4 KB, whatever the number of ids."""
    h = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets * 32768))
    return (ids.select(h.alias("__h"))
            .select((F.col("__h") / 32768).cast("int").alias("__bucket"), (F.col("__h") % 32768).alias("__bit"))
            .groupBy("__bucket").agg(F.bitmap_construct_agg("__bit").alias("__bits")))


def maybe_in(df: DataFrame, key: str, ids: DataFrame, buckets: int = 512) -> DataFrame:
    """``df`` with a boolean ``__maybe``: false only where ``key`` is surely not in ``ids``.

    A fixed-size hashed bitmap (``buckets`` x 4 KB: 2 MB, the proven bound of
    the broadcast) lets wide rows skip the shuffle of a semi or anti join;
    rows with ``__maybe`` still go through the exact join. A filter that fills
    up on huge id sets only lets more rows through.
    """
    h = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets * 32768))
    byte = F.conv(F.hex(F.substring("__bits", F.expr("cast(__h % 32768 div 8 as int) + 1"), F.lit(1))), 16, 10).cast("int")
    held = F.getbit(byte, F.expr("cast(__h % 8 as int)")) == 1
    return (df.withColumn("__h", h).withColumn("__bucket", (F.col("__h") / 32768).cast("int"))
            .join(F.broadcast(bitmap_of(ids, key, buckets)), "__bucket", "left")
            .withColumn("__maybe", F.coalesce(held, F.lit(False)))
            .drop("__h", "__bucket", "__bits"))
