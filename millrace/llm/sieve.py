"""A filter of fixed size that lets rows without a partner skip a shuffle."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sieve(keys: DataFrame, key: str, bits: int = 1 << 26) -> Callable[[Column], Column]:
    """A test of 64-bit hashes: true for all of ``keys``, and false for most others while those fill little of the ``bits``.

    Two bits a key. The table has ``bits / 8`` bytes (8 MB) whatever the number of keys; when it is full the test is true for everything.
    """
    place = lambda shift: F.shiftrightunsigned(key, shift).bitwiseAND(bits - 1)
    places = keys.select(F.explode(F.array(place(0), place(32))).alias("p"))
    words = places.select(F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("set")).toArrow()  # at most bits / 64 rows
    table = np.zeros(bits >> 6, np.int64)
    table[found.column("word").to_numpy()] = found.column("set").to_numpy()
    shared = keys.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def passes(hashes: pa.Array) -> pa.Array:
        value = hashes.to_numpy(zero_copy_only=False).view(np.uint64)
        held = np.ones(len(value), bool)
        for shift in (0, 32):
            p = ((value >> np.uint64(shift)) & np.uint64(bits - 1)).astype(np.int64)
            held &= (shared.value[p >> 6] >> (p & 63)) & 1 == 1
        return pa.array(held)

    return passes
