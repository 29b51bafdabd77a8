"""Keeping rows that can't have a partner out of a shuffle, by a Bloom filter of fixed size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^23 bits, a broadcast of 1 MB whatever the input's size; when it fills up, rows only go through the shuffle after all.
BITS, PROBES = 1 << 23, 4


def _places(key: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), key), F.lit(BITS)) for i in range(PROBES)])


def maybe_in(key: Column, keys: DataFrame) -> Column:
    """Boolean column: false only if ``key`` is surely not among ``keys`` (its first column)."""
    places = keys.select(F.explode(_places(F.col(keys.columns[0]))).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits"))
    table = np.zeros(BITS // 64, dtype=np.int64)
    for row in words.collect():
        table[row["w"]] = row["bits"]
    shared = keys.sparkSession.sparkContext.broadcast(np.unpackbits(table.view(np.uint8), bitorder="little"))

    @F.pandas_udf("boolean")
    def test(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        bits = shared.value
        for columns in batches:
            found = np.ones(len(columns[0]), dtype=bool)
            for c in columns:
                found &= bits[c.to_numpy(dtype=np.int64)] == 1
            yield pd.Series(found)

    return test(*[F.pmod(F.xxhash64(F.lit(i), key), F.lit(BITS)) for i in range(PROBES)])
