"""Joins against a smaller side whose size is checked, never assumed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes up to which a side is broadcast.
BROADCAST_BYTES = 32 << 20

_WIDTH = {T.BooleanType: 1, T.IntegerType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.DateType: 4}


def _row_bytes(df: DataFrame, text_bytes: int) -> int:
    return 16 + sum(_WIDTH.get(type(f.dataType), text_bytes) for f in df.schema.fields)


def sized_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "left",
    *,
    spread_by: str | None = None,
    salts: int = 16,
    limit: int = BROADCAST_BYTES,
    text_bytes: int = 48,
) -> DataFrame:
    """Equi-join whose smaller side is broadcast only when its counted rows fit ``limit`` bytes.

    Beyond the limit both sides are shuffled; with ``spread_by`` (a column of ``big``) every key is cut into ``salts``
    parts by a hash of that column and ``small`` is repeated for each part, so one hot key is spread over several tasks.
    ``how`` is ``inner`` or ``left``. Null keys match nothing. Column names of the sides must differ but for the keys.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    if small.count() * _row_bytes(small, text_bytes) <= limit:
        return big.join(F.broadcast(small), keys, how)
    if spread_by is None:
        return big.join(small, keys, how)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    placed = big.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    return placed.join(salted, [*keys, "_salt"], how).drop("_salt")
