"""Operator 12: phrase collocations, counted in burst tries and merged as sorted runs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.common import Scratch, mix, whole_text


@dataclass(frozen=True)
class Mining:
    min_count: int = 10  # occurrences of a candidate
    covered_percent: int = 50  # a phrase goes if a longer candidate has so much of its count
    top: int = 2000  # phrases per language


#: Bytes that end a piece become 0xFF, which no UTF-8 text holds; tabs become spaces, A-Z a-z.
_BREAK = 0xFF
_PIECE_BYTES = bytes(
    _BREAK if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b
    for b in range(256)
)
_ID_BITS = 21
_ID_MASK = (1 << _ID_BITS) - 1
#: Words of one text that are taken at a time; words that wait; words that all languages of a task
#: have numbers for. Their sum stays below 2 ** _ID_BITS.
_SEGMENT, _PENDING, _VOCABULARY = 1 << 17, 1 << 18, 150_000
#: A container with more phrases bursts; tries of a task with more are spilled down to half.
BURST, SPILL = 8_192, 400_000
_RUN_ROWS = 100_000
#: Bits of the sieve of frequent pairs: 16 for each pair, so that it passes few others, and a
#: proven bound of 128 MB. Beyond that it passes more; the counts stay exact.
SIEVE_BITS = (1 << 20, 1 << 30)

_RUN = "lang string, size int, phrase string, f long"


def pieces_of(text: str | None) -> list[bytes]:
    """Lower-cased words in order, with a word 0xFF where a piece ends."""
    if not text:
        return []
    marked = text.encode("utf-8", "surrogatepass").translate(_PIECE_BYTES)
    return marked.replace(b"\xff", b" \xff ").split()


class _Numbers(dict):
    """Words numbered from 1; 0 ends a piece."""

    def __init__(self):
        super().__init__({b"\xff": 0})

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class HatTrie:
    """Counts of phrases of 2 or 3 numbered words.

    The root has a child per first word: a hash container of the words that follow, with their
    counts. A container of two-word ends that grows over `BURST` becomes a node with a container
    of last words per middle word. A subtree is taken out whole, as a sorted run.
    """

    def __init__(self, size: int):
        self._rest_bits = _ID_BITS * (size - 1)
        self._deep = size > 2
        self._root: dict[int, dict] = {}
        self._burst: set[int] = set()
        self._sizes: dict[int, int] = {}
        self.entries = 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        """Sorted distinct phrases, as their numbers side by side, and how often each was seen."""
        if not len(codes):
            return
        firsts = codes >> self._rest_bits
        cuts = np.flatnonzero(np.diff(firsts, prepend=-1)).tolist()
        rests, counts = (codes & ((1 << self._rest_bits) - 1)).tolist(), counts.tolist()
        for first, at, to in zip(firsts[cuts].tolist(), cuts, cuts[1:] + [len(rests)], strict=True):
            child = self._root.setdefault(first, {})
            before = self._sizes.get(first, 0)
            if first in self._burst:
                after = before
                for rest, count in zip(rests[at:to], counts[at:to], strict=True):
                    leaf = child.setdefault(rest >> _ID_BITS, {})
                    last = rest & _ID_MASK
                    after += last not in leaf
                    leaf[last] = leaf.get(last, 0) + count
            else:
                for rest, count in zip(rests[at:to], counts[at:to], strict=True):
                    child[rest] = child.get(rest, 0) + count
                after = len(child)
                if self._deep and after > BURST:
                    self._root[first] = self._split(child)
                    self._burst.add(first)
            self._sizes[first] = after
            self.entries += after - before

    @staticmethod
    def _split(container: dict[int, int]) -> dict[int, dict[int, int]]:
        node: dict[int, dict[int, int]] = {}
        for rest, count in container.items():
            node.setdefault(rest >> _ID_BITS, {})[rest & _ID_MASK] = count
        return node

    def take(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Take out whole subtrees, the largest first, until at most `most` phrases are left."""
        gone, left = [], self.entries
        for first in sorted(self._sizes, key=self._sizes.get, reverse=True):
            if left <= most:
                break
            gone.append(first)
            left -= self._sizes.pop(first)
        codes, counts = [], []
        for first in sorted(gone):
            child, base = self._root.pop(first), first << self._rest_bits
            if first in self._burst:
                self._burst.discard(first)
                for middle, leaf in child.items():
                    codes.append(self._keys(leaf) + (base | middle << _ID_BITS))
                    counts.append(self._values(leaf))
            else:
                codes.append(self._keys(child) + base)
                counts.append(self._values(child))
        self.entries = left
        if not codes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes, counts = np.concatenate(codes), np.concatenate(counts)
        order = np.argsort(codes)
        return codes[order], counts[order]

    @staticmethod
    def _keys(container: dict) -> np.ndarray:
        return np.fromiter(container, np.int64, len(container))

    @staticmethod
    def _values(container: dict) -> np.ndarray:
        return np.fromiter(container.values(), np.int64, len(container))


def _slots(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """Where pairs of hashed words stand in a sieve."""
    return (mix(mix(left) + right) & np.uint64(bits - 1)).astype(np.int64)


def _hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word, seed=xxhash.xxh32_intdigest(lang.encode()))


class _Language:
    """The words and the trie of one language in one task."""

    def __init__(self, lang: str, size: int, sieve: tuple[np.ndarray, int] | None):
        self.lang, self._size, self._sieve = lang, size, sieve
        self.n_words = 0
        self._reset()

    def _reset(self) -> None:
        self.numbers = _Numbers()
        self.trie = HatTrie(self._size)
        self._words = np.zeros(0, np.int64)
        self._hashes = np.zeros(0, np.uint64)
        self._ids: list[list[int]] = []
        self._starts: list[np.ndarray] = []
        self.pending = 0

    def add(self, words: list[bytes]) -> None:
        """The words of one text; a phrase belongs to the segment in which it starts."""
        for at in range(0, len(words), _SEGMENT):
            ids = list(map(self.numbers.__getitem__, words[at : at + _SEGMENT + self._size - 1]))
            starts = np.zeros(len(ids) + 1, bool)
            starts[: min(_SEGMENT, len(ids))] = True
            ids.append(0)
            self._ids.append(ids)
            self._starts.append(starts)
            self.pending += len(ids)

    def flush(self) -> None:
        """Count what waits, phrase by distinct phrase."""
        if not self.pending:
            return
        ids = np.fromiter(chain.from_iterable(self._ids), np.int64, self.pending)
        a = np.concatenate((ids, [0, 0]))
        a, b, c = a[:-2], a[1:-1], a[2:]
        start = np.concatenate(self._starts) & (a > 0)
        self._ids, self._starts, self.pending = [], [], 0
        if self._size == 2:
            words = np.bincount(a[start], minlength=len(self.numbers))
            words[: len(self._words)] += self._words
            self._words = words
            self.n_words += int(start.sum())
            keep = start & (b > 0)
            codes = a[keep] << _ID_BITS | b[keep]
        else:
            keep = np.flatnonzero(start & (b > 0) & (c > 0))
            bits, n_bits = self._sieve
            known = self._hashes
            fresh = list(self.numbers)[len(known) :]
            hashes = np.fromiter((_hash(self.lang, w) for w in fresh), np.uint64, len(fresh))
            self._hashes = known = np.concatenate((known, hashes))
            for left, right in ((a, b), (b, c)):
                slot = _slots(known[left[keep]], known[right[keep]], n_bits)
                keep = keep[(bits[slot >> 3] >> (slot & 7)) & 1 > 0]
            codes = (a[keep] << _ID_BITS | b[keep]) << _ID_BITS | c[keep]
        self.trie.add(*np.unique(codes, return_counts=True))

    def spill(self, most: int = 0) -> Iterator[pa.RecordBatch]:
        """Sorted runs of whole subtrees; of everything, words too, where nothing is to be left."""
        texts = pa.array(list(self.numbers), pa.binary())
        codes, counts = self.trie.take(most)
        for at in range(0, len(codes), _RUN_ROWS):
            part = codes[at : at + _RUN_ROWS]
            ids = [part >> (_ID_BITS * i) & _ID_MASK for i in reversed(range(self._size))]
            words = [texts.take(pa.array(i)) for i in ids]
            phrase = pc.binary_join_element_wise(*words, b" ")
            yield self._run(self._size, phrase, counts[at : at + _RUN_ROWS])
        if most:
            return
        held = np.flatnonzero(self._words)
        if len(held):
            yield self._run(1, texts.take(pa.array(held)), self._words[held])
        if self.n_words:
            yield self._run(0, pa.array([b""]), np.array([self.n_words]))
        self.n_words = 0
        self._reset()

    def _run(self, size: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        n = len(phrases)
        columns = [pa.repeat(self.lang, n), pa.repeat(pa.scalar(size, pa.int32()), n)]
        columns += [phrases.cast(pa.string()), pa.array(counts, pa.int64())]
        return pa.record_batch(columns, ["lang", "size", "phrase", "f"])


def _count(size: int, sieve: Broadcast | None = None):
    """Runs of a partition's phrases; with `size` 2 also its words and how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        if sieve is not None:
            packed, n_bits = sieve.value
            known = np.frombuffer(packed, np.uint8), n_bits
        languages: dict[str, _Language] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = languages.get(lang)
                if own is None:
                    own = languages[lang] = _Language(lang, size, known)
                own.add(pieces_of(text.as_py()))
                if own.pending >= _PENDING:
                    own.flush()
                    yield from _relieve(languages)
            if sum(x.pending for x in languages.values()) >= _PENDING:
                for own in languages.values():
                    own.flush()
                yield from _relieve(languages)
        for own in languages.values():
            own.flush()
            yield from own.spill()

    return run


def _relieve(languages: dict[str, _Language]) -> Iterator[pa.RecordBatch]:
    """Spill what has outgrown its bounds."""
    if sum(len(x.numbers) for x in languages.values()) > _VOCABULARY:
        for own in languages.values():
            own.flush()
            yield from own.spill()
    elif sum(x.trie.entries for x in languages.values()) > SPILL:
        for own in languages.values():
            yield from own.spill(max(1, own.trie.entries // 2))


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """Runs of all tasks merged by whole phrases, so that no first word gathers its subtree."""
    counts = runs.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return counts.filter((F.col("f") >= least) | (F.col("size") == 0))


def _sieve(spark: SparkSession, pairs: DataFrame) -> Broadcast:
    """A bitmap of the frequent pairs, to leave out phrases that cannot be candidates."""
    n_bits, most = SIEVE_BITS
    wanted = 16 * pairs.count()
    while n_bits < min(wanted, most):
        n_bits *= 2

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.array(
                [
                    [_hash(lang, w.encode()) for w in phrase.split(" ")]
                    for lang, phrase in zip(*[c.to_pylist() for c in batch.columns], strict=True)
                ],
                np.uint64,
            ).reshape(-1, 2)
            # bucket numbers and positions count from 1
            yield pa.record_batch([pa.array(_slots(hashes[:, 0], hashes[:, 1], n_bits) + 1)], ["slot"])

    buckets = (
        pairs.select("lang", "phrase").mapInArrow(slots, "slot long")
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        .collect()  # n_bits / 32768 rows at most
    )
    packed = bytearray(n_bits // 8)
    for bucket, bits in buckets:
        packed[(bucket - 1) * 4096 : bucket * 4096] = bits
    return spark.sparkContext.broadcast((bytes(packed), n_bits))


def _scored(candidates: DataFrame, parts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the lowest-scoring cut of each candidate."""
    words = F.split("phrase", " ")
    cut = F.struct(
        F.lit(1).alias("k"),
        words[0].alias("left"),
        F.array_join(F.slice(words, 2, F.size(words) - 1), " ").alias("right"),
    )
    late = F.struct(
        F.lit(2).alias("k"),
        F.array_join(F.slice(words, 1, 2), " ").alias("left"),
        words[2].alias("right"),
    )
    cuts = candidates.select(
        "lang", "phrase", "a",
        F.explode(F.when(F.col("size") == 2, F.array(cut)).otherwise(F.array(cut, late))).alias("c"),
    ).select("lang", "phrase", "a", "c.*")
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    whole = {x: f"cast({x} as decimal(19, 0))" for x in "alr"}
    score = F.expr(
        f"({whole['a']} * {whole['a']} * 1000000) div ({whole['l']} * {whole['r']})"
    ).cast("long")
    joined = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return joined.groupBy("lang", "phrase", "a").agg(best).select(
        "lang", "phrase", "a", "best.l", "best.r", "best.score"
    )


def collocations(
    docs: DataFrame, mining: Mining = Mining(), text: str = "text", lang: str = "lang"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of two and three words of each
    language that stick together most.

    A first pass counts words and pairs, a second one triples, those only whose two pairs are
    frequent: a phrase is never more frequent than its parts, so nothing is missed. Each task
    counts in one trie per language; tries that outgrow their bound are spilled by whole
    subtrees, as runs sorted by word number. Runs are merged by phrase in a shuffle: a task sends
    a phrase about once, however often it stands there, and no prefix, however frequent, meets in
    one task. Each language is cut to `top` before the last shuffle and after it.

    A cut of a candidate into two parts scores a * a / (l * r), in millionths, with the counts of
    the phrase and its parts; the lowest cut counts. A pair goes if a triple that holds it has
    `covered_percent` of its count.

    Defined cases: null and empty texts, and texts of separators, have no words; a null language
    is `und`, as are rows that say so. Repeated rows count each. Equal scores go by falling
    count, then by the bytes of the phrase. Only the text and the language are read. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "collocations")
    read = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        whole_text(F.col(text)).alias("text"),
    )
    runs = read.mapInArrow(_count(2), _RUN)
    short, _ = scratch.staged_alone(_merged(runs, mining.min_count))
    pairs = short.filter("size = 2")
    sieve = _sieve(spark, pairs)
    runs = read.mapInArrow(_count(3, sieve), _RUN)
    triples, _ = scratch.staged_alone(_merged(runs, mining.min_count))
    holders = triples.select("lang", "f", F.split("phrase", " ").alias("w")).select(
        "lang",
        "f",
        F.explode(
            F.array(F.concat_ws(" ", F.col("w")[0], F.col("w")[1]), F.concat_ws(" ", F.col("w")[1], F.col("w")[2]))
        ).alias("phrase"),
    )
    covered = holders.groupBy("lang", "phrase").agg(F.max("f").alias("more"))
    single = pairs.join(covered, ["lang", "phrase"], "left").filter(
        F.coalesce(F.col("more") * 100 < F.col("f") * mining.covered_percent, F.lit(True))
    )
    candidates = single.select("lang", "size", "phrase", F.col("f").alias("a")).union(
        triples.select("lang", "size", "phrase", F.col("f").alias("a"))
    )
    scored = _scored(candidates, short.filter("size > 0"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= mining.top
    )
    totals = short.filter("size = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
