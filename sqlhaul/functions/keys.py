"""Stored-query object names as column expressions.

An uploaded file is named ``<USERID>_<DATASET_ID>_<UPLOAD_EPOCH>_<FILENAME>``;
the file name itself may contain ``_``. The fields are split off the base name
of the path with ``split``/``slice``/``array_join``, so the parse runs as one
codegen'd projection over any number of keys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The object name has four fields joined by "_", in this order.
KEY_SEPARATOR = "_"
KEY_FIELDS = ("user_id", "dataset_id", "upload_epoch", "file_name")


def base_name(path: Column) -> Column:
    """Last ``/``-separated element of a path or key."""
    return F.element_at(F.split(path, "/"), -1)


def upload_key_fields(path: Column) -> list[Column]:
    """``user_id, dataset_id, upload_epoch (bigint), file_name`` of a key.

    ``file_name`` is everything after the third ``_`` (so it may itself hold
    ``_``); it is the empty string when the name has three or fewer fields.
    ``upload_epoch`` is null unless the third field is ASCII digits (no sign,
    no blanks) that fit a bigint.
    """
    parts = F.split(base_name(path), KEY_SEPARATOR)
    rest = F.greatest(F.size(parts) - F.lit(3), F.lit(0))
    epoch = F.try_element_at(parts, F.lit(3))
    return [
        parts.getItem(0).alias("user_id"),
        F.try_element_at(parts, F.lit(2)).alias("dataset_id"),
        F.when(epoch.rlike("^[0-9]+$"), epoch.try_cast("bigint")).alias("upload_epoch"),
        F.array_join(F.slice(parts, 4, rest), KEY_SEPARATOR).alias("file_name"),
    ]
