"""Operator 11: ranked lexical search, documents grouped by the terms of a query they hold."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import Scratch, whole_text

TOP = 10
#: Texts of the queries that are answered in one pass over the documents.
BLOCK_BYTES = 16 << 20
#: Documents whose masks are compared at a time.
_SLICE = 4096
#: Bytes that part terms become spaces, A-Z become a-z; bytes from 0x80 on belong to terms.
_TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).islower() or chr(b).isdigit() else (b + 32 if chr(b).isupper() else 32)
    for b in range(256)
)

_INDEX = "doc_id long, n long, terms array<int>, counts array<long>"
_FOUND = "item_id long, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text: maximal runs of ASCII letters, digits and all other characters."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


@dataclass(frozen=True)
class _Asked:
    """The queries of one block: bounded by `BLOCK_BYTES`, or a single query."""

    ids: list[int | None]
    terms: list[np.ndarray]  # per query, the numbers of its distinct terms
    times: list[np.ndarray]  # and how often each stands in it
    vocabulary: dict[bytes, int]

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]]) -> _Asked:
        words: dict[int | None, list[bytes]] = {}
        for key, text in rows:
            words.setdefault(key, []).extend(terms_of(text))
        vocabulary: dict[bytes, int] = {}
        terms, times = [], []
        for own in words.values():
            numbers = [vocabulary.setdefault(w, len(vocabulary)) for w in own]
            distinct, count = np.unique(np.array(numbers, np.int64), return_counts=True)
            terms.append(distinct)
            times.append(count.astype(np.int64))
        return cls(list(words), terms, times, vocabulary)


def _index(asked: Broadcast):
    """For every document with terms: their number, and the counts of the terms asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = asked.value.vocabulary.get
        for batch in batches:
            sizes, numbers, found = [], [], []
            for text in batch.column(1):
                words = terms_of(text.as_py())
                sizes.append(len(words))
                mine = [i for w in words if (i := known(w)) is not None]
                numbers.extend(mine)
                found.append(len(mine))
            row = np.repeat(np.arange(len(found), dtype=np.int64), found)
            pair, count = np.unique(
                row << 32 | np.array(numbers, np.int64), return_counts=True
            )
            ends = np.searchsorted(pair >> 32, np.arange(len(found) + 1)).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                for values in ((pair & 0xFFFFFFFF).astype(np.int32), count.astype(np.int64))
            ]
            sizes = pa.array(sizes, pa.int64())
            out = pa.record_batch(
                [batch.column(0), sizes, *lists], ["doc_id", "n", "terms", "counts"]
            )
            yield out.filter(pa.compute.greater(sizes, 0))

    return run


def _frequencies(n_terms: int):
    """How many documents of a partition hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        held = np.flatnonzero(df)
        yield pa.record_batch([pa.array(held), pa.array(df[held])], ["term", "df"])

    return run


def term_weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


class _Slice:
    """Some documents, with a bitmap of documents and the greatest contribution for each term."""

    def __init__(self, lengths, ends, terms, counts, corpus: tuple[int, int], n_terms: int):
        docs, total = corpus
        self.n_docs, self.ends, self.terms = len(lengths), ends, terms
        # whole numbers of any size: 75 n N may pass 64 bits
        m = np.array([25 + 75 * n * docs // total for n in lengths.tolist()], np.int64)
        doc = np.repeat(np.arange(self.n_docs), np.diff(ends))
        self.share = 1_000_000_000 * counts // (1000 * counts + 8 * m[doc])
        used, place = np.unique(terms, return_inverse=True)
        self.row_of = np.full(n_terms, -1, np.int64)
        self.row_of[used] = np.arange(len(used))
        self.greatest = np.zeros(len(used), np.int64)
        np.maximum.at(self.greatest, place, self.share)
        self.bits = np.zeros((len(used), -(-self.n_docs // 8)), np.uint8)
        np.bitwise_or.at(self.bits, (place, doc >> 3), (128 >> (doc & 7)).astype(np.uint8))

    def masks(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each document's group of equal masks over the given terms, and the masks as columns of
        bits. The bitmaps are turned, 64 terms to a word, and groups refined word by word."""
        held = np.unpackbits(self.bits[rows], axis=1, count=self.n_docs)
        group = np.zeros(self.n_docs, np.int64)
        for at in range(0, len(rows), 64):
            word = np.zeros((8, self.n_docs), np.uint8)
            packed = np.packbits(held[at : at + 64], axis=0)
            word[: len(packed)] = packed
            _, own = np.unique(np.ascontiguousarray(word.T).view(np.uint64)[:, 0], return_inverse=True)
            _, group = np.unique(group * (own.max() + 1) + own, return_inverse=True)
        _, some = np.unique(group, return_index=True)
        return group, held[:, some]

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The exact scores of some documents."""
        sizes = self.ends[docs + 1] - self.ends[docs]
        first = np.cumsum(sizes) - sizes
        at = np.repeat(self.ends[docs] - first, sizes) + np.arange(sizes.sum())
        gained = np.concatenate(([0], np.cumsum(weight[self.terms[at]] * self.share[at])))
        return gained[first + sizes] - gained[first]


def _best(part: _Slice, rows: np.ndarray, own: np.ndarray, weight: np.ndarray, least: int, top: int):
    """Documents that can be among the `top` with more than, or as much as, `least`.

    Masks are taken by falling maximum score: what a document with all of a mask's terms at their
    greatest contributions would score. It ends when the next maximum is below the score of
    rank `top` so far, so no document that belongs to the answer is left out, ties included.
    """
    group, masks = part.masks(rows)
    most = (own * part.greatest[rows]) @ masks.astype(np.int64)
    by_mask = np.argsort(-most[group], kind="stable")
    maxima = most[group][by_mask]
    kept_docs, kept_scores, at, step = [], np.zeros(0, np.int64), 0, 64
    while at < len(by_mask) and maxima[at] >= max(least, 1):
        # whole masks at a time
        to = np.searchsorted(-maxima, -maxima[min(at + step, len(by_mask)) - 1], side="right")
        docs = by_mask[at:to]
        kept_docs.append(docs)
        kept_scores = np.concatenate((kept_scores, part.scores(docs, weight)))
        if len(kept_scores) >= top:
            least = max(least, int(np.partition(kept_scores, -top)[-top]))
        at, step = to, step * 2
    docs = np.concatenate(kept_docs) if kept_docs else np.zeros(0, np.int64)
    good = kept_scores >= max(least, 1)
    return docs[good], kept_scores[good]


def _rank(asked: Broadcast, weights: np.ndarray, corpus: tuple[int, int], top: int):
    """The `top` best documents of a partition for every query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = asked.value
        # (score, negated id or the least number for none) of the best so far
        best: list[list[tuple]] = [[] for _ in block.ids]
        weight = np.zeros(len(weights), np.int64)
        for whole in batches:
            for start in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(start, _SLICE)
                ids = batch.column(0).to_pylist()
                sizes = pa.compute.list_value_length(batch.column(2)).to_numpy()
                ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
                part = _Slice(
                    batch.column(1).to_numpy(),
                    ends,
                    batch.column(2).flatten().to_numpy(),
                    batch.column(3).flatten().to_numpy(),
                    corpus,
                    len(weights),
                )
                for q, (terms, times) in enumerate(zip(block.terms, block.times, strict=True)):
                    rows = part.row_of[terms]
                    here = rows >= 0
                    if not here.any():
                        continue
                    own = times[here] * weights[terms[here]]
                    weight[terms] = times * weights[terms]
                    least = best[q][-1][0] if len(best[q]) == top else 0
                    docs, scores = _best(part, rows[here], own, weight, least, top)
                    weight[terms] = 0
                    more = [(s, ids[d]) for d, s in zip(docs.tolist(), scores.tolist(), strict=True)]
                    # rows without an id come last among equals
                    best[q] = sorted(
                        best[q] + more, key=lambda x: (-x[0], x[1] is None, x[1] or 0)
                    )[:top]
        found = [(block.ids[q], doc, s) for q, mine in enumerate(best) for s, doc in mine]
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The queries in blocks: dealt by a hash of the id, into more blocks until the texts of each
    have at most `BLOCK_BYTES` or belong to one query."""
    sized = items.groupBy("id").agg(F.sum(F.octet_length("text")).alias("bytes"))
    n, total = sized.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    count = max(1, -(-(total or 0) * 2 // BLOCK_BYTES)) if n else 0

    def dealt(of: int) -> F.Column:
        return F.pmod(F.xxhash64("id"), F.lit(of))

    while count < n and not (
        sized.groupBy(dealt(count)).agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n"))
        .filter(f"b > {BLOCK_BYTES} and n > 1").isEmpty()
    ):
        count *= 2
    for number in range(count):
        rows = items.filter(dealt(count) == number).collect()
        if rows:
            yield [(r["id"], r["text"]) for r in rows]


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best documents for the text of each item.

    The score of a document adds up, over the terms of the item with their repeats, the weight of
    a term (rarer terms weigh more) times its saturated count, in whole numbers.

    Items are broadcast in blocks of bounded size; per block the documents are read once, and only
    their lengths and the counts of terms asked for are written. In slices of documents, bitmaps
    say which documents hold a term of the item; turned, they give each document's mask of terms.
    Documents with one mask have one maximum score, masks are evaluated from the greatest maximum
    down, until what is left cannot reach the answer. Each task returns `top` documents per item,
    and the last ranking cuts them again before its shuffle, so no item gathers its documents.

    Defined cases: null and empty texts have no term and are never found; an item without terms,
    or whose terms no document has, gets no row; rows that share an item id are one item, their
    terms together; rows without item id are one item too. Repeated documents are ranked each for
    themselves; equal scores go by ascending id, rows without id last. Only the id and the text
    of either table are read. Empty tables give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical")
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    items = items.select(
        F.col(item_key).cast("long").alias("id"), whole_text(F.col(text)).alias("text")
    )
    found = []
    for rows in _blocks(items):
        asked = _Asked.of(rows)
        n_terms = len(asked.vocabulary)
        if not n_terms:
            continue
        sent = spark.sparkContext.broadcast(asked)
        index, path = scratch.staged(docs.mapInArrow(_index(sent), _INDEX))
        corpus = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        counted = (
            index.select("terms").mapInArrow(_frequencies(n_terms), "term long, df long")
            .groupBy("term").agg(F.sum("df").alias("df")).collect()  # terms of one block
        )
        weights = np.zeros(n_terms, np.int64)
        for term, df in counted:
            weights[term] = term_weight(corpus[0], df)
        ranked = index.filter(F.size("terms") > 0).mapInArrow(
            _rank(sent, weights, tuple(corpus), top), _FOUND
        )
        found.append(scratch.stage(ranked))
        scratch.drop(path)
    every = spark.createDataFrame([], _FOUND)
    for part in found:
        every = every.union(part)
    order = Window.partitionBy("item_id").orderBy(
        F.desc("score"), F.col("doc_id").asc_nulls_last()
    )
    ranked = every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")
