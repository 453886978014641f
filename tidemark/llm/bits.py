"""Tables of a fixed number of bits that tell tasks which hashes cannot matter."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The size never follows the data: 2**26 bits are 8 MB in every task and at most 16 MB on their way to the driver.
# A table that fills up lets more hashes through and never fewer, so it saves work and decides nothing.
BITS = 26


def bit_table(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """Bytes with the bit of each hash set; the top ``bits`` bits of a 64-bit hash are its place."""
    place = F.shiftrightunsigned(F.col(column), 64 - bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    words = hashes.select(F.shiftright(place, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("set"))
    found = words.toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[found.column("word").to_numpy()] = found.column("set").to_numpy().view(np.uint64)
    return table.view(np.uint8)


def may_hold(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each unsigned 64-bit hash, whether its bit is set."""
    place = hashes >> np.uint64(64 - int(len(table) * 8).bit_length() + 1)
    return (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
