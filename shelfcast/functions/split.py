"""Deterministic row splits.

A split drawn from ``rand()`` depends on partitioning and on retries; a hash of the row key does
not, needs no shuffle, and puts copies of a row on the same side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NULL_TEXT = "\\N"


def _key_text(keys: Sequence[str], schema: T.StructType | None) -> Column:
    """The key as text. With a schema, moments are microseconds: their text would follow the session's zone."""
    moments = {f.name for f in schema if isinstance(f.dataType, T.TimestampType)} if schema else set()
    values = [F.unix_micros(k) if k in moments else F.col(k) for k in keys]
    parts = [F.coalesce(v.cast("string"), F.lit(_NULL_TEXT)) for v in values]
    return parts[0] if len(parts) == 1 else F.concat_ws("\x1f", *parts)


def hash_bucket(
    keys: Sequence[str], buckets: int, word: int = 0, schema: T.StructType | None = None
) -> Column:
    """Bucket number from the ``word``-th (0..3) group of 8 hex digits of the key's md5.

    Different words give independent buckets for the same key. Keys with timestamps need the
    frame's ``schema``, or the bucket depends on the session's time zone.
    """
    if not 0 <= word <= 3:
        raise ValueError("md5 has four 8-digit words, 0 to 3")
    digits = F.substring(F.md5(_key_text(keys, schema)), 1 + 8 * word, 8)
    return F.conv(digits, 16, 10).cast("long") % F.lit(buckets)


def split_label(
    keys: Sequence[str],
    test_one_in: int = 4,
    validation_one_in: int = 5,
    schema: T.StructType | None = None,
) -> Column:
    """``test`` for one row in ``test_one_in``; of the rest one in ``validation_one_in`` is
    ``validation`` (0: none); the others are ``train``."""
    label = F.when(hash_bucket(keys, test_one_in, schema=schema) == 0, "test")
    if validation_one_in:
        label = label.when(hash_bucket(keys, validation_one_in, 1, schema) == 0, "validation")
    return label.otherwise("train")
