"""Operator 6: document fingerprints by order MinHash, sensitive to edit distance.

For each of `SAMPLES` random orders the `TUPLE` least occurrence-numbered k-mers of a text are taken, put
back into the order in which the text has them, and hashed together. Two texts agree in a sample
if they share these k-mers and have them in the same order.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import Scratch, mix

KMER = 8
TUPLE = 2
SAMPLES = 64
_PIECE = 2048


def _constants(name: bytes) -> np.ndarray:
    values = [xxhash.xxh32_intdigest(name + b"%d" % i) for i in range(SAMPLES)]
    return np.array(values, np.uint32)[:, None]


_FLIP, _FACTOR = _constants(b"omh-flip"), _constants(b"omh-factor") | 1
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _kmers(points: np.ndarray, k: int = KMER) -> np.ndarray:
    """A hash of each run of k code points; of the whole text where it is shorter."""
    h, power, width = points.astype(np.uint64) + np.uint64(1), _BASE, 1
    if len(points) <= k:
        powers = np.array([pow(int(_BASE), i, 2**64) for i in range(len(h))], np.uint64)
        return mix(np.array([(h * powers).sum() + np.uint64(len(h))], np.uint64))
    while width < k:  # doubles the run
        h = h[:-width] * power + h[width:]
        power, width = np.uint64(pow(int(power), 2, 2**64)), 2 * width
    return mix(h)


def _numbered(kmers: np.ndarray) -> np.ndarray:
    """The k-mers made distinct: each is hashed with the number of times it came before."""
    order = np.argsort(kmers, kind="stable")
    ordered = kmers[order]
    start = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    if len(start) == len(kmers):
        return kmers
    times = np.arange(len(kmers)) - np.repeat(start, np.diff(np.append(start, len(kmers))))
    number = np.empty(len(kmers), np.uint64)
    number[order] = times.astype(np.uint64)
    return np.where(number == 0, kmers, mix(kmers + number * _BASE))


def _two_least(short: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the least and the second least value in each order; ties: the first place."""
    best = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    second = best.copy()
    at_best = np.zeros(SAMPLES, np.int64)
    at_second = np.zeros(SAMPLES, np.int64)
    for start in range(0, len(short), _PIECE):
        values = short[None, start : start + _PIECE] ^ _FLIP
        values *= _FACTOR
        for _ in range(TUPLE):
            at = values.argmin(axis=1)
            low = values[rows, at]
            values[rows, at] = 0xFFFFFFFF
            at += start
            first = low < best
            later = ~first & (low < second)
            second = np.where(first, best, np.where(later, low, second))
            at_second = np.where(first, at_best, np.where(later, at, at_second))
            best = np.where(first, low, best)
            at_best = np.where(first, at, at_best)
    return at_best, at_second


_ROWS = np.arange(SAMPLES)


def fingerprint(points: np.ndarray) -> np.ndarray:
    """The samples' 64-bit hashes of one text, given as code points."""
    if not len(points):
        return np.zeros(SAMPLES, np.uint64)
    kmers = _numbered(_kmers(points))
    short = (kmers >> np.uint64(32)).astype(np.uint32)
    one, two = _two_least(short, _ROWS)
    if len(kmers) == 1:
        two = one
    left, right = np.minimum(one, two), np.maximum(one, two)  # the order of the text
    return mix(kmers[left] * _BASE + kmers[right])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of samples in which two fingerprints agree."""
    return float(np.count_nonzero(a == b)) / SAMPLES


def _bytes(values: np.ndarray) -> bytes:
    """Four bytes of each sample."""
    return (values >> np.uint64(32)).astype(">u4").tobytes()


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def edit(points: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last half replaced by as much of the beginning of the next text."""
    half = len(points) // 2
    return np.concatenate((points[: len(points) - half], following[:half]))


_COLUMNS = {
    "doc_id": ("long", pa.int64()),
    "n_chars": ("long", pa.int64()),
    "edited_sha256": ("string", pa.string()),
    "fingerprint": ("binary", pa.binary()),
    "edited_fingerprint": ("binary", pa.binary()),
    "near_edited": ("double", pa.float64()),
    "near_next": ("double", pa.float64()),
}
_OUT = pa.schema([(name, kind) for name, (_, kind) in _COLUMNS.items()])
_OUT_TYPE = ", ".join(f"{name} {kind}" for name, (kind, _) in _COLUMNS.items())
_OPEN = _OUT.append(pa.field("part", pa.int32())).append(pa.field("end", pa.string())).append(
    pa.field("text", pa.string())
)


def _row(doc: int | None, own: np.ndarray, own_print: np.ndarray, following: np.ndarray,
         following_print: np.ndarray) -> tuple:
    edited = edit(own, following)
    edited_print = fingerprint(edited)
    text = edited.tobytes().decode("utf-32-le", "surrogatepass")
    return (
        doc, len(own), sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
        _bytes(own_print), _bytes(edited_print),
        likeness(own_print, edited_print), likeness(own_print, following_print),
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.record_batch(arrays, schema=schema)


def _compare_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted part (part, doc_id, text): each row against the row after it.

    The part's first and last rows also go out with their texts: what follows the last one lies
    in another part.
    """
    none, part, held = (None,) * len(_COLUMNS), None, None
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            piece, rows = batch.slice(at, 200), []
            for number, doc, text in zip(*[c.to_pylist() for c in piece.columns], strict=True):
                points = code_points(text)
                print_ = fingerprint(points)
                if held is None:
                    part = number
                    rows.append((*none, part, "first", text or ""))
                else:
                    rows.append((*_row(*held[:3], points, print_), part, None, None))
                held = doc, points, print_, text or ""
            yield _batch(rows, _OPEN)
    if held is not None:
        yield _batch([(held[0], *none[1:], part, "last", held[3])], _OPEN)


def _compare_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, text of the successor)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            rows = []
            columns = [c.to_pylist() for c in batch.slice(at, 200).columns]
            for doc, text, following in zip(*columns, strict=True):
                own, other = code_points(text), code_points(following)
                rows.append(_row(doc, own, fingerprint(own), other, fingerprint(other)))
            yield _batch(rows, _OUT)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            piece = batch.slice(start, 500)
            texts = [_bytes(fingerprint(code_points(t))).hex() for t in piece[1].to_pylist()]
            yield pa.record_batch([piece[0], pa.array(texts, pa.string())], ["id", "fingerprint"])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint) of each row: hexadecimal digits, eight for each sample.

    Equal texts have equal fingerprints; a null text counts as empty and empty texts share the
    fingerprint of zeros; texts up to `KMER` code points have one k-mer. No row meets another.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(_fingerprints, "id long, fingerprint string")


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of the text edited with its successor's beginning.

    The successor is the next row by ascending id, that of the last row the first. One range
    exchange sorts the texts into parts; a part is read row by row, and only its first and last
    texts leave it, to be joined with those of the neighbouring parts. A task holds two texts at a time.

    Defined cases: a row without id has no place in the order, its successor is the empty text;
    rows that repeat an id follow each other by a hash of their texts; a single row is its own
    successor; a null text is empty; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "fingerprints")
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = ["doc_id", "tie", "row"]
    compared = scratch.stage(
        docs.filter("doc_id is not null")
        .withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
        .mapInArrow(_compare_in_order, f"{_OUT_TYPE}, part int, end string, text string")
    )
    # the ends of the parts: the next part that has rows, after the last the first
    parts = compared.filter("end = 'first'").select("part")
    upwards = Window.orderBy("part")
    following = parts.select(
        "part",
        F.coalesce(
            F.lead("part").over(upwards), F.min("part").over(Window.partitionBy())
        ).alias("next"),
    )
    first = compared.filter("end = 'first'").select(
        F.col("part").alias("next"), F.col("text").alias("following")
    )
    ends = (
        compared.filter("end = 'last'").select("part", "doc_id", "text")
        .join(following, "part").join(first, "next")
        .select("doc_id", "text", "following")
    )
    alone = docs.filter("doc_id is null").select("doc_id", "text", F.lit("").alias("following"))
    rest = ends.union(alone).mapInArrow(_compare_pairs, _OUT_TYPE)
    return (
        compared.filter("end is null").select(*_COLUMNS).union(rest)
        .withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})
    )
