"""Bounded training samples, picked by a hash."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPAN = 1 << 30


def id_remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n (null for a null id)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def sample_per_class(rows: DataFrame, label: str, by: list[str], counts: dict, per_class: int, seed: str) -> DataFrame:
    """About ``per_class`` rows of every class of ``counts`` (class -> rows),
    picked by a hash of the columns ``by``; classes with fewer rows are taken
    whole. Rows equal in all columns are one example."""
    if not counts:
        return rows.where(F.lit(False))
    place = F.pmod(F.xxhash64(*by, F.lit(seed)), F.lit(_SPAN))
    picked = [(F.col(label) == F.lit(c)) & (place < F.lit(-(-_SPAN * per_class // n) if n > per_class else _SPAN))
              for c, n in counts.items()]
    return rows.where(reduce(lambda a, b: a | b, picked)).distinct()
