"""One set of CSV options for every write and every read of a dataset.

Written and read with the same options, any text survives the round trip:
quotes, commas, CR/LF inside values, outer blanks, leading zeros, ``NA``,
non-ASCII, and null kept apart from the empty string. The one value that
cannot be told from null is the literal text ``\\N``, which loads refuse.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the contract.
NULL_TOKEN = "\\N"

WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": NULL_TOKEN,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}

READ_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    # values may hold line breaks; a multi-line file is read by one task,
    # which is why writers cap rows per file
    "multiLine": "true",
    "nullValue": NULL_TOKEN,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    # the header of every file must match the logged column list
    "enforceSchema": "false",
    "mode": "FAILFAST",
    "encoding": "UTF-8",
}

# Upload file formats: CSV is the dataset format; parquet (still all-string
# columns) is splittable, compressed and prunable, for large datasets.
UPLOAD_FORMATS = ("csv", "parquet")

# Rows per written file: multi-line CSV is not splittable, so files are kept
# small enough for one task each.
DEFAULT_MAX_RECORDS_PER_FILE = 500_000
# Bytes of a written file: larger ones (of few long rows) are cut before the
# load is logged.
DEFAULT_MAX_FILE_BYTES = 256 << 20


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
