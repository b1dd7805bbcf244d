"""A sieve of fixed size: which keys of one pass to look at again in the next.

One bit per hash value is set on Spark and combined there; what the driver gets is at most
``WORDS`` rows, whatever the number of keys. A key that was put in always passes. One that
was not passes if it shares a bit: it then costs work, never a wrong result, so a sieve
that fills up with the input only stops saving.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 18  # of 64 bits


def marked(keys: DataFrame, hashed: Column) -> DataFrame:
    """(_word, _bits): the words with a bit set, from a 64-bit hash of each key."""
    slots = keys.select(hashed.alias("_hash"))
    word = F.expr(f"shiftrightunsigned(_hash, 6) & {WORDS - 1}L").alias("_word")
    return slots.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, cast(_hash & 63L AS INT))")).alias("_bits"))


def passing(rows: DataFrame, words: DataFrame, hashed: Column) -> DataFrame:
    """The rows whose key may be among those marked."""
    looked = rows.withColumn("_hash", hashed).withColumn("_word", F.expr(f"shiftrightunsigned(_hash, 6) & {WORDS - 1}L"))
    found = looked.join(F.broadcast(words), "_word")  # at most WORDS rows
    return found.where(F.expr("(shiftrightunsigned(_bits, cast(_hash & 63L AS INT)) & 1L) = 1L")).select(*rows.columns)


@dataclass(frozen=True)
class Sieve:
    """The same words as an array, for use inside tasks."""

    words: np.ndarray

    @classmethod
    def of(cls, keys: DataFrame, hashed: Column) -> Sieve:
        words = np.zeros(WORDS, np.uint64)
        for row in marked(keys, hashed).collect():  # at most WORDS rows
            words[row["_word"]] = np.uint64(row["_bits"] & (1 << 64) - 1)
        return cls(words)

    def shared(self, spark):
        return spark.sparkContext.broadcast(self)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash may have been put in."""
        h = hashes.astype(np.int64).view(np.uint64)
        return (self.words[((h >> np.uint64(6)) & np.uint64(WORDS - 1)).astype(np.int64)] >> (h & np.uint64(63)) & np.uint64(1)).astype(bool)
