"""Decoding of order messages (JSON text) into typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.sources.schemas import ORDER_MESSAGE

CORRUPT = "_corrupt_record"

# Keys every order message must carry (the producer writes all seven).
REQUIRED_KEYS = tuple(f.name for f in ORDER_MESSAGE.fields)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_quotes(c: Column | str) -> Column:
    """Remove ``"`` from both ends, as ids split from CSV lines carry them."""
    return F.btrim(_col(c), F.lit('"'))


def parse_timestamp(c: Column | str) -> Column:
    """ISO-8601 text without zone -> TIMESTAMP_NTZ; NULL when unparsable."""
    return _col(c).try_cast("timestamp_ntz")


def parse_order_json(value: Column | str) -> Column:
    """JSON text -> struct of the seven message keys plus ``_corrupt_record``.

    Broken JSON and mistyped values leave the struct fields NULL and the
    raw text in ``_corrupt_record``; nothing raises.
    """
    schema = T.StructType(ORDER_MESSAGE.fields + [T.StructField(CORRUPT, T.StringType())])
    return F.from_json(_col(value), schema,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def json_int(text: Column | str, path: str) -> Column:
    """Integer at a JSON path of a text column (NULL when absent or bad)."""
    return F.get_json_object(_col(text), path).try_cast("long")
