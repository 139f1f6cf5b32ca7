"""Strict reading of texts that must be one JSON object.

The JSON parser stops after the first root, so text behind it would go unseen. The text is
therefore read as the first element of an array whose second one is a mark made from the text
itself: a second root moves the mark, stray text is a syntax error, and a text that closes
the array early hides it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MARK = "mark of the end"


def _mark(text: str) -> Column:
    return F.xxhash64(text)


def json_roots(text: str, schema: T.StructType) -> Column:
    """The roots of a text and the mark behind them, null where the text is not JSON."""
    wrapped = F.concat(
        F.lit("["), F.col(text), F.lit(f',{{"{_MARK}":'), _mark(text).cast("string"), F.lit("}]")
    )
    marked = T.StructType([*schema.fields, T.StructField(_MARK, T.LongType())])
    return F.from_json(wrapped, T.ArrayType(marked), {"allowSingleQuotes": "false"})


def only_object(roots: str, text: str) -> Column:
    """The root object of a text that has exactly this one, else null."""
    found = F.get(F.col(roots), F.lit(1))[_MARK] == _mark(text)
    return F.when(found & (F.size(roots) == 2), F.get(F.col(roots), F.lit(0)))


def is_object(value: Column) -> Column:
    """Whether a variant holds an object; null for a missing value or a JSON null."""
    kind = F.schema_of_variant(value)
    return F.when(value.isNotNull() & ~F.is_variant_null(value), kind.startswith("OBJECT"))
