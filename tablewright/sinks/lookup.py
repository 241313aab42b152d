"""Tables that are looked up by a few keys: sorted by key, with Parquet's Bloom filters on the key columns.

Statistics of a row group say between which keys it lies, and the Bloom filter says which of those it certainly lacks. A list of
keys that has been counted to be small reaches the scan as literals, and row groups without any of them are not read. Beyond
the limit the keys are joined as usual.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most keys that go into a query as literals.
KEYS_PUSHED = 1000
#: Different keys that a Bloom filter of a row group is laid out for.
KEYS_PER_GROUP = 1_000_000

_EXACT = (T.IntegralType, T.StringType, T.DateType, T.TimestampNTZType, T.TimestampType)


def write_for_lookup(df: DataFrame, path: str, key: Sequence[str], mode: str = "errorifexists") -> None:
    """Write Parquet in ranges of the key, with Bloom filters on its columns."""
    rows = df.repartitionByRange(*[F.col(f"`{k}`") for k in key]).sortWithinPartitions(*[F.col(f"`{k}`") for k in key])
    writer = rows.write.mode(mode)
    for k in key:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{k}", str(KEYS_PER_GROUP))
    writer.parquet(path)


def key_filter(keys: DataFrame, key: Sequence[str], limit: int = KEYS_PUSHED) -> Column | None:
    """A filter by literals that all rows with one of the keys pass, null keys too; None when there are too many keys.

    With several columns each has its own list, so other rows may pass as well.
    """
    columns = [k for k in key if isinstance(keys.schema[k].dataType, _EXACT)]
    if not columns:
        return None
    found = keys.select(*columns).distinct().limit(limit + 1).collect()  # bounded
    if len(found) > limit:
        return None
    terms = []
    for k in columns:
        values = sorted({r[k] for r in found if r[k] is not None})
        term = F.col(f"`{k}`").isin(values) if values else F.lit(False)
        terms.append(term | F.col(f"`{k}`").isNull() if any(r[k] is None for r in found) else term)
    return reduce(operator.and_, terms)


def narrowed(df: DataFrame, keys: DataFrame, key: Sequence[str], limit: int = KEYS_PUSHED) -> DataFrame:
    """``df`` without rows that a small list of keys rules out in the scan; join with the keys afterwards."""
    found = key_filter(keys, key, limit)
    return df if found is None else df.where(found)
