"""Shared helpers: texts of an Arrow batch as bytes, hashes of words, word runs, stage files.

A batch is worked on in slices of about a megabyte of text, so that a task's memory follows the
longest single text and not the batch. All arithmetic on hashes wraps at 64 bits.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

SLICE_BYTES = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def ship(module: str) -> None:
    """Let the functions of ``module`` travel with a task, so that workers need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: later uses neither recompute nor reorder it."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(stem: str) -> str:
    """A column name that no input column clashes with."""
    return f"__{stem}_{uuid.uuid4().hex[:8]}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The white space that separates words in the contracts: blank, tab, line feed, vertical tab, form feed, return.
SPACE_CLASS = r"\x20\x09-\x0D"


def is_space() -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[[0x20, *range(0x09, 0x0E)]] = True
    return flags


def lower_ascii() -> np.ndarray:
    """Byte to byte, A-Z lower-cased."""
    lower = np.arange(256, dtype=np.uint8)
    lower[0x41:0x5B] += 0x20
    return lower


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, UTF-8, or binaries end to end, start of each text and the end of the last); NULL is ''."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
    else:
        column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in pieces of about ``most`` bytes of text; a longer text is a piece of its own."""
    _, starts = flat(batch.column(text))
    row = 0
    while row < batch.num_rows:
        end = int(np.searchsorted(starts, starts[row] + most, side="right")) - 1
        end = min(max(end, row + 1), batch.num_rows)
        yield batch.slice(row, end - row)
        row = end


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_values(seed: int = 1) -> np.ndarray:
    """A scrambled 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed))


class Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _FACTOR), ("down", _INVERSE)):
                full = np.full(size, base, np.uint64)
                full[0] = 1
                setattr(self, name, np.cumprod(full, dtype=np.uint64))
        return self.up, self.down


def prefix_hash(values: np.ndarray, powers: Powers) -> np.ndarray:
    """Running sums of ``values[i] * base**i``, from 0; see ``span_hash``."""
    up, _ = powers.get(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Scrambled hash of each span, the same wherever the span stands."""
    _, down = powers.get(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that do not cross a text's border."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(len(inside), bool)
    before[0], before[1:] = False, inside[:-1]
    borders = offsets[:-1]
    before[borders[borders < len(inside)]] = False
    after = np.empty(len(inside), bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = offsets[1:]
    after[ends[ends > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def gram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words, from the hashes of the words."""
    count = max(0, len(words) - n + 1)
    total = np.zeros(count, np.uint64)
    factor = 1
    for k in range(n):
        factor = factor * 0xC2B2AE3D27D4EB4F % (1 << 64)
        total += words[k : k + count] * np.uint64(factor)
    return mix(total + np.uint64(n))


def same(a: str, b: str):
    """Equality in which NULL equals NULL, for joins on keys that may be NULL."""
    return F.col(a).eqNullSafe(F.col(b))


# A key with more than one in HOT_PART of all rows is hot; there can be at most HOT_PART such keys.
HOT_PART = 4096
HOT_SALTS = 64


def join_hot(
    rows: DataFrame, keys: DataFrame, on: list[str], count: str, spread: str, how: str = "inner"
) -> DataFrame:
    """Join of ``rows`` with ``keys`` (stored, one row per key, ``count``: rows of the key), hot keys dealt out.

    Keys above 1 / HOT_PART of all rows number HOT_PART at most, whatever the size of the tables, so
    they are broadcast to mark the rows that get a salt from the column ``spread``; ``keys`` repeats
    those keys once per salt. All other keys join as they are; where no key is hot, nothing is broadcast or salted.
    """
    salt, hot, key_salt = fresh_name("salt"), fresh_name("hot"), fresh_name("salt")
    total, largest = keys.agg(F.coalesce(F.sum(count), F.lit(0)), F.coalesce(F.max(count), F.lit(0))).first()
    border = max(1, total // HOT_PART)
    if largest <= border:
        return rows.join(keys, on, how)
    is_hot = F.col(count) > border
    marks = keys.where(is_hot).select(*on, F.lit(True).alias(hot))
    dealt = F.when(F.col(hot), F.pmod(F.xxhash64(spread), F.lit(HOT_SALTS))).otherwise(F.lit(0))
    salted = rows.join(F.broadcast(marks), on, "left").withColumn(salt, dealt.cast("int")).drop(hot)
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = keys.withColumn(key_salt, F.explode(salts)).withColumnRenamed(key_salt, salt)
    return salted.join(repeated, [*on, salt], how).drop(salt)
