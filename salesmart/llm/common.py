"""Tables, staged results and word shingles shared by the corpus operators."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import remove_path, scratch_path, stage, stage_bucketed

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE = 5
SIMILARITY_PERCENT = 75
_CACHE_WORDS = 300_000
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Scratch:
    """Results of one operator run, written to the cluster's shared folder and read again.

    A staged table cuts the lineage and outlives lost executors. `drop` frees what is used up;
    the rest goes when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self._n = spark, scratch_path(spark, name), 0

    def stage(self, df: DataFrame) -> DataFrame:
        return self.staged(df)[0]

    def staged(self, df: DataFrame) -> tuple[DataFrame, str]:
        self._n += 1
        path = f"{self.root}/{self._n}"
        return stage(df, path), path

    def staged_alone(self, df: DataFrame) -> tuple[DataFrame, str]:
        """As `staged`; the write's shuffle files are freed as it ends, not when the driver happens
        to collect its garbage."""
        before = self.spark.conf.get(_FREE_SHUFFLES)
        self.spark.conf.set(_FREE_SHUFFLES, "true")
        try:
            return self.staged(df)
        finally:
            self.spark.conf.set(_FREE_SHUFFLES, before)

    def staged_by_key(self, df: DataFrame, by: str, buckets: int) -> tuple[DataFrame, str]:
        """As `staged_alone`, in buckets of a column whose equal values lie in one task: what groups
        by it later needs no shuffle."""
        before = self.spark.conf.get(_FREE_SHUFFLES)
        self.spark.conf.set(_FREE_SHUFFLES, "true")
        try:
            self._n += 1
            path = f"{self.root}/{self._n}"
            return stage_bucketed(df, path, by, buckets, dealt=True), path
        finally:
            self.spark.conf.set(_FREE_SHUFFLES, before)

    def drop(self, *paths: str) -> None:
        for path in paths:
            remove_path(self.spark, path)


class WordHashes(dict):
    """64-bit hashes of words (UTF-8), remembered while they are few enough."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    """The words of a text after lower-casing A-Z, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


_ODD = np.array(
    [xxhash.xxh3_64_intdigest(b"shingle%d" % i) | 1 for i in range(64)], dtype=np.uint64
)


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def shingle_hashes(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A 64-bit hash of each run of `size` words; of the whole sequence where it is shorter."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(n, size)
    total = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        total += hashes[i : n - size + 1 + i] * _ODD[i]
    return mix(total + np.uint64(size))


def shingle_set(text: str | None, cache: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingles of a text."""
    return np.unique(shingle_hashes(word_hashes(words_of(text), cache), size))


#: Bits of a sieve: half a megabyte, whatever the number of values.
SIEVE_BITS = 1 << 22


def sieve_slot(value: str) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(SIEVE_BITS)).cast("int")


def sieve(values: DataFrame, column: str) -> np.ndarray:
    """A fixed-size bitmap of a column's values: what it lacks is not among them.

    It spares rows a shuffle before an exact join; fuller, it spares fewer, with equal results.
    """
    slot = sieve_slot(column)
    bits = (
        values.groupBy(F.shiftright(slot, 5).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(31)))))
        .collect()  # SIEVE_BITS / 32 rows at most
    )
    words = np.zeros(SIEVE_BITS // 32, np.uint32)
    for word, value in bits:
        words[word] = value & 0xFFFFFFFF
    return np.unpackbits(words.view(np.uint8), bitorder="little")
