"""Sharding (operator 5): a keyed permutation of row numbers.

A Feistel network over the smallest even number of bits that holds the row
numbers permutes ``0 .. 2**bits - 1``; cycle walking (apply it again until the
value is a row number) restricts it to exactly ``0 .. n - 1``.  Row ``i`` gets
place ``p = permutation(i)``, shard ``p % shards`` and slot ``p // shards``:
the shuffle is reproducible from ``(n, seed)`` alone, every row's shard and
slot can be computed without the table, the inverse names the row in a given
slot, and shard sizes differ by one row at most.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflens.llm.common import no_clash, numbered, ship, unused

ROUNDS = 6
_STEP = 0x9E3779B97F4A7C15
_MASK = 2**64 - 1


def _round(half: np.ndarray, key: int) -> np.ndarray:
    x = half * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(key)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(27)
    return x


def _keys(seed: int) -> list[int]:
    return [(seed * 0xD1342543DE82EF95 + (r + 1) * _STEP) & _MASK for r in range(ROUNDS)]


def _network(x, half, keys, backwards=False):
    mask, width = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> width, x & mask
    for key in reversed(keys) if backwards else keys:
        if backwards:
            left, right = right ^ (_round(left, key) & mask), left
        else:
            left, right = right, left ^ (_round(right, key) & mask)
    return (left << width) | right


def permute(numbers, n: int, seed: int = 0, backwards: bool = False) -> np.ndarray:
    """The permutation of ``0 .. n - 1`` (or its inverse) at ``numbers``."""
    x = np.asarray(numbers, dtype=np.uint64).copy()
    if not len(x):
        return x.astype(np.int64)
    if int(x.max()) >= n:
        raise ValueError(f"row number {int(x.max())} outside 0..{n - 1}")
    half, keys = max(1, -(-(n - 1).bit_length() // 2)), _keys(seed)
    walking = np.arange(len(x))
    while len(walking):  # the domain is under 4n: few steps on average
        x[walking] = _network(x[walking], half, keys, backwards)
        walking = walking[x[walking] >= np.uint64(n)]
    return x.astype(np.int64)


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """The row number that lies in a shard's slot."""
    return int(permute([slot * shards + shard], n, seed, backwards=True)[0])


def shard(df: DataFrame, shards: int, order_cols=("doc_id",), seed: int = 0) -> DataFrame:
    """All rows with ``row_number``, ``shard`` and ``slot`` (input columns of
    these names are replaced).  Rows are numbered by ``order_cols`` (nulls
    first), then by the whole row; equal rows take adjacent numbers.  An
    empty table gives an empty table.  Groups of equal texts are not kept
    together: the law is equal row counts."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    ship(df.sparkSession)
    df = no_clash(df, ["row_number", "shard", "slot"])
    rows = numbered(df, [F.col(f"`{c}`").asc_nulls_first() for c in order_cols])
    n = rows.count()

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), n, seed))

    at = unused(rows, "__place")
    return (rows.withColumn(at, place("row_number"))
            .withColumn("shard", F.pmod(at, F.lit(shards)).cast("int"))
            .withColumn("slot", F.expr(f"`{at}` div {int(shards)}"))
            .drop(at))
