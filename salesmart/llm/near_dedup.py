"""Operator 4: near-duplicates by an inverted join over MinHash signature coordinates.

Every document is posted under each (coordinate, value) of its signature. Documents that share
enough postings are candidates, candidates are confirmed on their full shingle sets, confirmed
links are joined to components.

Posting lists are never expanded into all pairs. Three kinds of lists are skipped: lists of one
document; after the first round, lists whose documents lie in one component already; and, by the
prefix rule, the longest lists of a document that is left (two documents that share t of the lists
left to them share one of all but the t - 1 longest).
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm import graph
from salesmart.llm.common import (
    SIMILARITY_PERCENT,
    WORD,
    Scratch,
    WordHashes,
    shingle_hashes,
    sieve,
    sieve_slot,
    word_hashes,
    words_of,
)

COORDINATES = 64
#: Numbers from here on stand for rows whose id is taken by another text.
_OTHERS = 1 << 62
#: A pair just similar enough has fewer common coordinates than asked for with this chance.
MISS = 1e-6
#: Documents of a group that are compared at once with as many others.
BLOCK = 512


def least_matches(coordinates: int, percent: int, miss: float = MISS) -> int:
    """The greatest number of matches that a pair of the given similarity reaches but for `miss`."""
    p, below, t = percent / 100, 0.0, 0
    while True:
        below += comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if below > miss:
            return max(1, t)
        t += 1


def _constants(name: bytes, n: int) -> np.ndarray:
    values = [xxhash.xxh32_intdigest(name + b"%d" % i) for i in range(n)]
    return np.array(values, np.uint32)[:, None]


def minhash(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The least value of the shingles under each of the coordinates' permutations."""
    flip, factor = _constants(b"flip", coordinates), _constants(b"factor", coordinates) | 1
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 4096):  # long texts in pieces
        part = (short[None, at : at + 4096] ^ flip) * factor
        np.minimum(least, part.min(axis=1), out=least)
    return least


_SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("digest", pa.binary()),
        ("n_shingles", pa.int64()),
        ("signature", pa.binary()),
        ("postings", pa.list_(pa.int64())),
    ]
)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHashes()
    first = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            ids, digests, sizes, signatures, postings = [], [], [], [], []
            piece = batch.slice(at, 500)
            for doc, text in zip(piece[0].to_pylist(), piece[1].to_pylist(), strict=True):
                hashes = word_hashes(words_of(text), cache)
                shingles = np.unique(shingle_hashes(hashes))
                ids.append(doc)
                sizes.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                if len(shingles):
                    values = minhash(shingles)
                    signatures.append(values.astype(np.uint8).tobytes())
                    postings.append((first | values).view(np.int64))
                else:
                    signatures.append(None)
                    postings.append([])
            yield pa.record_batch(
                [pa.array(x, f.type) for x, f in zip(
                    (ids, digests, sizes, signatures, postings), _SIGNED, strict=True)],
                schema=_SIGNED,
            )


_SET_TYPE = "id long, shingles binary"


def _sets(wanted: np.ndarray):
    """Rows (id, text, slot): the shingle sets of those whose slot is wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            batch = batch.filter(pa.array(wanted[batch[2].to_numpy()].astype(bool)))
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                sets = [
                    np.unique(shingle_hashes(word_hashes(words_of(t), cache))).tobytes()
                    for t in piece[1].to_pylist()
                ]
                yield pa.record_batch([piece[0], pa.array(sets, pa.binary())], ["id", "shingles"])

    return run


def confirm_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, set of a, set of b) whose sets are similar enough."""
    for batch in batches:
        keep = []
        for x, y in zip(batch[2], batch[3], strict=True):
            x = np.frombuffer(x.as_buffer(), np.uint64)
            y = np.frombuffer(y.as_buffer(), np.uint64)
            n, m = len(x), len(y)
            if 100 * min(n, m) < SIMILARITY_PERCENT * max(n, m):
                keep.append(False)
                continue
            both = np.sort(np.concatenate((x, y)), kind="stable")  # merges two sorted runs
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            keep.append(100 * common >= SIMILARITY_PERCENT * (n + m - common))
        kept = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.record_batch([kept[0], kept[1]], ["a", "b"])




def _count_matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, signature of a, signature of b) with the number of equal coordinates."""
    for batch in batches:
        x = np.frombuffer(b"".join(batch[2].to_pylist()), np.uint8).reshape(-1, COORDINATES)
        y = np.frombuffer(b"".join(batch[3].to_pylist()), np.uint8).reshape(-1, COORDINATES)
        yield pa.record_batch(
            [batch[0], batch[1], pa.array((x == y).sum(axis=1), pa.int32())], ["a", "b", "matches"]
        )


_PAIR_TYPE = "a long, b long"


def common_shingles(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of every left with every right set (with every left one where
    there are no right ones), by products of matrices."""
    sets = left if right is None else [*left, *right]
    sizes = [len(x) for x in sets]
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1  # what one set has alone is in no intersection
    place = np.cumsum(shared) - 1
    row = np.repeat(np.arange(len(sizes)), sizes)
    kept = shared[column]
    row, column = row[kept], place[column[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total, columns = 0, int(shared.sum())
    for low in range(0, max(columns, 1), 4096):
        start, stop = np.searchsorted(column, (low, low + 4096))
        part = np.zeros((len(sizes), min(columns - low, 4096)), np.float32)
        part[row[start:stop], column[start:stop] - low] = 1
        total = total + part[: len(left)] @ (part if right is None else part[len(left) :]).T
    return total


#: Groups of so few sets are compared pair by pair.
_FEW = 6


def _near_pairs(left: list[np.ndarray], right: list[np.ndarray] | None) -> Iterator[tuple[int, int]]:
    """Places of similar sets, one on the left and one on the right or, without these, both on the
    left."""
    if right is None and len(left) <= _FEW:
        for i, x in enumerate(left):
            for j in range(i):
                n, m = len(x), len(left[j])
                if 100 * min(n, m) < SIMILARITY_PERCENT * max(n, m):
                    continue
                both = np.concatenate((x, left[j]))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())  # a set has each shingle once
                if 100 * common >= SIMILARITY_PERCENT * (n + m - common):
                    yield j, i
        return
    n = np.array([len(x) for x in left], np.float32)
    m = n if right is None else np.array([len(x) for x in right], np.float32)
    both = common_shingles(left, right)
    near = 100 * both >= SIMILARITY_PERCENT * (n[:, None] + m[None, :] - both)
    yield from np.argwhere(np.triu(near, 1) if right is None else near).tolist()


def _links_of(
    sides: np.ndarray, ids: list[int], components: list[int], sets: list[np.ndarray]
) -> list[tuple[int, int]]:
    """Links between different components in two blocks of one group (sides 0 and 1, or 2 for one
    block by itself): enough of them to join what belongs together, not every pair."""
    if sides[0] == 2:
        left = right = range(len(ids))
        pairs = _near_pairs(sets, None)
    else:
        left, right = (np.flatnonzero(sides == x).tolist() for x in (0, 1))
        if not left or not right:
            return []
        pairs = _near_pairs([sets[i] for i in left], [sets[j] for j in right])
    found, over = [], {}

    def top(c: int) -> int:
        while c in over:
            c = over[c]
        return c

    for i, j in pairs:
        p, q = top(components[left[i]]), top(components[right[j]])
        if p != q:
            over[max(p, q)] = min(p, q)
            a, b = ids[left[i]], ids[right[j]]
            found.append((min(a, b), max(a, b)))
    return found


def _join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, i, j, side, id, component, shingles), those of one pair of blocks one after the
    other: links between them. Most pairs of blocks are few rows, so many come in one batch."""

    def links(rows: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
        sides, found = rows["side"].to_numpy(), []
        ids, components = rows["id"].to_pylist(), rows["component"].to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"].to_pylist()]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            found += _links_of(sides[a:b], ids[a:b], components[a:b], sets[a:b])
        ends = np.array(found, np.int64).reshape(-1, 2)
        return pa.record_batch([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        keys = [rows[x].to_numpy() for x in ("group", "i", "j")]
        new = np.logical_or.reduce([x[1:] != x[:-1] for x in keys])
        edges = np.concatenate(([0], np.flatnonzero(new) + 1))
        rest = rows.slice(edges[-1])  # more of it may come
        yield links(rows, edges)
    if rest:
        yield links(rest, np.array([0, len(rest)]))


def link_in_blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that join different components of one group, found on full sets.

    members: id, component, group; sets: id, shingles. A group is cut into blocks by hash, and each
    pair of blocks is one task's input, so that no task holds a group.
    """
    counted = members.groupBy("group").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
        F.min("component").alias("x"), F.max("component").alias("y"),
    ).filter("x <> y").select("group", "blocks")
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rows = (
        members.join(counted, "group").withColumn("block", block).join(sets, "id")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            "id", "component", "shingles",
            F.when(F.col("block") < F.col("other"), 0).when(F.col("block") > F.col("other"), 1)
            .otherwise(2).alias("side"),
        )
    )
    blocks = ["group", "i", "j"]
    return rows.repartition(*blocks).sortWithinPartitions(*blocks).mapInArrow(_join_blocks, _PAIR_TYPE)


def _link(docs: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) of all documents that have a link. nodes: id, signature, postings."""
    least = least_matches(COORDINATES, SIMILARITY_PERCENT)
    posted = nodes.select("id", F.explode("postings").alias("key"))
    # Round one: each list of two or more is a star. Its centre differs from list to list, and
    # is found by a partial minimum, however long the list.
    mask = F.xxhash64("key")
    lists = (
        posted.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.col("id").bitwiseXOR(mask)).alias("m"))
        .filter("n > 1")
        .select("key", "n", F.col("m").bitwiseXOR(mask).alias("centre"))
    )
    shared, shared_path = scratch.staged(posted.join(lists, "key"))
    # Who shares too few lists can have no partner; the others' sets are computed once.
    able = shared.groupBy("id").agg(F.count(F.lit(1)).alias("lists")).filter(f"lists >= {least}")
    sets, sets_path = scratch.staged(
        docs.select("doc_id", "text", sieve_slot("doc_id"))
        .mapInArrow(_sets(sieve(able, "id")), _SET_TYPE)
    )
    bits = nodes.select("id", "signature")
    stars = (
        shared.filter("id <> centre")
        .select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))
        .distinct()
        .join(bits.toDF("a", "signature_a"), "a")
        .join(bits.toDF("b", "signature_b"), "b")
        .select("a", "b", "signature_a", "signature_b")
        .mapInArrow(_count_matches, "a long, b long, matches int")
        .filter(F.col("matches") >= least)
    )
    stars, stars_path = scratch.staged(stars)

    def confirmed(pairs: DataFrame) -> DataFrame:
        sized = pairs.select("a", "b").distinct()
        sized = sized.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
        return sized.select("a", "b", "set_a", "set_b").mapInArrow(confirm_pairs, _PAIR_TYPE)

    def component(rows: DataFrame, id_: str, name: str) -> DataFrame:
        """Add the component of `id_`: its own number where nothing is linked with it."""
        known = labels.toDF("__id", "__component")
        return (
            rows.join(known, F.col(id_) == F.col("__id"), "left")
            .withColumn(name, F.coalesce("__component", id_)).drop("__id", "__component")
        )

    def merged(links: DataFrame) -> DataFrame:
        """Components with further links; those so far are stars."""
        star = labels.filter("component < id").select("component", "id").toDF("a", "b")
        return scratch.stage(graph.components(star.union(links), scratch))

    # a document's most promising star edge to a lesser id first; what these join needs no other
    best = stars.groupBy("b").agg(F.max_by("a", "matches").alias("a"))
    labels = scratch.stage(graph.components(confirmed(best), scratch))
    apart = component(component(stars, "a", "x"), "b", "y").filter("x <> y")
    labels = merged(confirmed(apart))
    # Round two: lists that still hold different components, documents with enough such lists.
    rest = component(shared.select("id", "key", "n"), "id", "component")
    for _ in range(2):
        rest = rest.select("id", "key", "n", "component")
        mixed = rest.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
        rest = rest.join(mixed.filter("x <> y").select("key"), "key", "left_semi")
        enough = rest.groupBy("id").agg(F.count(F.lit(1)).alias("lists")).filter(f"lists >= {least}")
        rest = scratch.stage(rest.join(enough, "id"))
    by_length = Window.partitionBy("id").orderBy("n", "key")
    prefix = (
        rest.withColumn("place", F.row_number().over(by_length))
        .filter(f"place <= lists - {least - 1}").select("id", "key", "component")
    )
    prefix = scratch.stage(prefix)
    first = prefix.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a < z")
    chained = prefix.join(first, "key").filter("id <> a").select("a", F.col("id").alias("b"))
    # Documents that prefixes chain together are compared block with block, on their full sets.
    groups = scratch.stage(graph.components(chained, scratch)).toDF("id", "group")
    members = prefix.select("id", "component").distinct().join(groups, "id")
    across = link_in_blocks(members, sets)
    labels = merged(across)
    scratch.drop(shared_path, sets_path, stars_path)
    return labels


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row.

    Words are runs of non-white space after lower-casing A-Z, a document's set its distinct
    five-word shingles (fewer words: the whole sequence). Documents whose sets have a Jaccard similarity
    of 75 % or more are linked; a component is named by its least id, which is kept. Sets are
    compared by 64-bit hashes. A link is missed if a similar pair shares too few coordinates, with
    a chance of `MISS` at the threshold itself and less above it.

    Rows of one text are one node of the graph, named by their least id; a node is signed once.
    Defined cases: texts that are null, empty or white space have no shingles and no links; a row
    without id takes part in no link, has no component and is kept; rows that repeat an id share
    a component, which then holds whatever is linked with any of their texts. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "near")
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed, signed_path = scratch.staged(
        docs.mapInArrow(
            _sign,
            "doc_id long, digest binary, n_shingles long, signature binary, postings array<long>",
        )
    )
    known = signed.filter("doc_id is not null and n_shingles > 0")
    texts = scratch.stage(known.groupBy("digest").agg(F.min("doc_id").alias("id")))
    nodes, nodes_path = scratch.staged(
        known.join(texts, [known.digest == texts.digest, known.doc_id == texts.id])
        .select("id", "signature", "postings", texts.digest)
        .dropDuplicates(["id", "digest"])
        .drop("digest")
    )
    labels = _link(docs.filter("doc_id is not null"), nodes, scratch).toDF("__id", "__component")
    rows = signed.select("doc_id", "digest", "n_shingles").join(texts, "digest", "left")
    rows = rows.join(labels, F.col("id") == F.col("__id"), "left")
    component = F.coalesce("__component", "id", "doc_id")
    rows = rows.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), component))
    result = scratch.stage(rows.select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    ))
    scratch.drop(signed_path, nodes_path)
    return result


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near-duplicates: one row of each group stays.

    Where groups are concerned a row is its id and its text: the id of a group is the least of
    its rows, rows that share an id have groups of their own where their texts are not alike.
    Rows without words, or without id, are like nothing and stay, all of them. Of rows that agree
    in id and text one stays.
    """
    scratch = Scratch(docs.sparkSession, "distinct")
    own = F.xxhash64(F.col(text))
    worded = F.col(key).isNotNull() & F.coalesce(F.col(text).rlike(WORD), F.lit(False))
    # ids of several texts are few: the first text keeps the id, others get one above all ids
    several = scratch.stage(
        docs.filter(worded).groupBy(F.col(key).alias("__of"))
        .agg(F.min(own).alias("__first"), F.max(own).alias("__last"))
        .filter("__first <> __last")
    )
    other = F.lit(_OTHERS) + F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(_OTHERS // 2))
    row = F.when(F.col("__of").isNull() | (own == F.col("__first")), F.col(key)).otherwise(other)
    rows = docs.filter(worded).join(several, F.col(key) == F.col("__of"), "left")
    rows = rows.withColumn("__row", row).select(*docs.columns, "__row")
    kept = near_duplicates(rows.select("__row", text), "__row", text).filter("kept")
    kept = kept.select(F.col("doc_id").alias("__kept")).distinct()
    first = rows.join(kept, F.col("__row") == F.col("__kept"), "left_semi")
    return first.dropDuplicates(["__row"]).drop("__row").unionByName(docs.filter(~worded))
