"""Operator 2: benchmark decontamination by SimHash over item-sized windows.

DataFrame functions only. A window has the length of a benchmark item, or less where an end of the
text clips it, and holds a five-word shingle of an item of that length, at any place; windows without any are
never built, because they cannot reach the similarity asked for. Windows and items get a 64-bit SimHash of their
weighted shingles; a multi-index over five blocks of the fingerprint finds every pair within the
radius (of `RADIUS` differing bits some block has at most a fifth, and all values so near to an
item's block are posted); candidates are verified by exact weighted Jaccard similarity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import (
    SHINGLE,
    SIMILARITY_PERCENT,
    Scratch,
    ascii_lower,
    whole_text,
)

BITS = 64
RADIUS = 19
#: First bit and width of each block of a fingerprint.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Item shingles that are broadcast at once (a hash and two ints each, some 60 MB as a hash
#: table); more are taken in several passes over the documents.
BROADCAST_SHINGLES = 500_000
_SPACE = r"[\x20\x09-\x0D]+"


def words(text: str) -> Column:
    """The words of a text after lower-casing A-Z."""
    return F.array_remove(F.split(ascii_lower(whole_text(text)), _SPACE), "")


def _with_run_hashes(rows: DataFrame, size: int) -> DataFrame:
    """Add `hashes`: of each run of `size` words, put together from runs of 1, 2 and 4 words."""

    def both(left: str, right: str, skip: int) -> Column:
        after = F.slice(right, skip + 1, F.size(right))
        return F.zip_with(left, after, lambda x, y: F.xxhash64(x, y))

    rows = rows.withColumn("ones", F.transform("words", lambda w: F.xxhash64(w)))
    rows, have = rows.withColumn("hashes", F.col("ones")), 1
    while have < size:  # what reaches beyond the end is cut off below
        double = 2 * have <= size
        rows = rows.withColumn("hashes", both("hashes", "hashes" if double else "ones", have))
        have += have if double else 1
    runs = F.greatest(F.size("words") - (size - 1), F.lit(0))
    return rows.withColumn("hashes", F.slice("hashes", 1, runs)).drop("ones")


def _heaviness(run: Column) -> Column:
    """One, and one more for each word of four letters or more."""
    return F.size(F.filter(run, lambda w: F.char_length(w) > 3)) + 1


def weighted_shingles(words_: str) -> Column:
    """The distinct shingles of a window as (hash, weight).

    A shingle weighs one, and one more for each of its words of four letters or more: function
    words say little. Fewer than five words are one shingle.
    """
    size = F.least(F.size(words_), F.lit(SHINGLE))

    def shingle(i: Column) -> Column:
        run = F.slice(F.col(words_), i, size)
        return F.struct(F.xxhash64(run).alias("h"), _heaviness(run).alias("w"))

    starts = F.when(
        F.size(words_) > 0, F.sequence(F.lit(1), F.size(words_) - size + 1)
    ).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, shingle))


#: Four bits of a fingerprint are summed at once, each in sixteen bits of a long.
_LANES, _LANE = 4, 16
_LOWEST = sum(1 << (_LANE * lane) for lane in range(_LANES))


def simhash(shingles: str) -> Column:
    """Bit b is set if the shingles whose hash has it weigh more than the others; their weight is
    in a column of its own."""
    total = F.col(shingles + "_weight")

    def mark(bit: Column, heavier: Column) -> Column:
        one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
        return F.when(heavier, one).otherwise(F.lit(0).cast("long"))

    def bit(so_far: Column, b: Column) -> Column:
        weight = F.aggregate(
            F.col(shingles),
            F.lit(0),
            lambda s, x: s + F.when(F.getbit(x["h"], b) == 1, x["w"]).otherwise(-x["w"]),
        )
        return so_far.bitwiseOR(mark(b, weight > 0))

    def sums(k: Column) -> Column:
        return F.struct(k.alias("k"), F.aggregate(
            F.col(shingles),
            F.lit(0).cast("long"),
            lambda s, x: s + x["w"] * F.call_function("shiftrightunsigned", x["h"], k)
            .bitwiseAND(F.lit(_LOWEST)),
        ).alias("sums"))

    def bits(so_far: Column, x: Column) -> Column:
        for lane in range(_LANES):
            own = F.shiftrightunsigned(x["sums"], _LANE * lane).bitwiseAND(F.lit((1 << _LANE) - 1))
            so_far = so_far.bitwiseOR(mark(x["k"] + _LANE * lane, 2 * own > total))
        return so_far

    none = F.lit(0).cast("long")
    several = F.transform(F.sequence(F.lit(0), F.lit(_LANE - 1)), sums)
    # a lane holds the weight of windows of thousands of words; longer ones are summed bit by bit
    return F.when(total < 1 << (_LANE - 1), F.aggregate(several, none, bits)).otherwise(
        F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), none, bit)
    )


def _flipped(block: int, value: Column):
    return lambda flip: F.struct(
        F.lit(block).alias("block"), value.bitwiseXOR(flip).alias("value")
    )


def _block_values(fingerprint: Column, near: bool) -> Column:
    """(block, value) of a fingerprint; `near`: all values within a fifth of the radius too."""
    entries = []
    for number, (first, width) in enumerate(BLOCKS):
        own = F.shiftrightunsigned(fingerprint, first).bitwiseAND(F.lit((1 << width) - 1))
        own = own.cast("int")
        if not near:
            entries.append(F.array(F.struct(F.lit(number).alias("block"), own.alias("value"))))
            continue
        flips = F.filter(
            F.sequence(F.lit(0), F.lit((1 << width) - 1)),
            lambda m: F.bit_count(m) <= RADIUS // len(BLOCKS),
        )
        entries.append(F.transform(flips, _flipped(number, own)))
    return F.flatten(F.array(*entries))


def _weight(shingles: Column) -> Column:
    return F.aggregate(shingles, F.lit(0), lambda s, x: s + x["w"])


def _windows_that_may_reach(
    hits: DataFrame, least: DataFrame, percent: int, scratch: Scratch
) -> DataFrame:
    """(row, start, n_words, aligned) of the windows that hold a shingle of an item of their length
    and may be similar to some item, of any length.

    hits: row, p, n_words, size, w, ats: the places of items' shingles, once for each length of the
    items; least: size, other, least: the least weight of the items of a length. What a window has in
    common with an item weighs at most as much as its places with shingles of items of that item's
    length, so these must weigh `percent` of the least of them. Few windows do, and only these are
    made of words.
    """
    hits = scratch.stage(hits)
    enough = F.expr(f"100 * shared >= {percent} * least")
    other = hits.withColumnRenamed("n_words", "other")
    whole = other.groupBy("row", "size", "other").agg(F.sum("w").alias("shared"))
    strong = whole.join(F.broadcast(least), ["size", "other"]).filter(enough)
    strong = scratch.stage(strong.select("row", "size", "other", "least"))
    able = hits.join(strong.select("row", "size").distinct(), ["row", "size"], "left_semi")
    lengths = able.select("row", "size", "n_words").distinct()

    def spread(rows: DataFrame) -> DataFrame:
        """With the start of every window that holds the shingle, those before the text too."""
        return rows.withColumn("start", F.explode(F.sequence(
            F.col("p") + F.col("size") - F.col("n_words"), F.col("p"))))

    near = (
        spread(other.join(strong, ["row", "size", "other"]).join(lengths, ["row", "size"]))
        .groupBy("row", "start", "n_words", "other").agg(
            F.sum("w").alias("shared"), F.first("least").alias("least"))
        .filter(enough).select("row", "start", "n_words").distinct()
    )
    own = spread(able).groupBy("row", "start", "n_words").agg(
        F.max(F.array_contains("ats", F.col("p") - F.col("start"))).alias("aligned")
    )
    return own.join(near, ["row", "start", "n_words"])


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    percent: int = SIMILARITY_PERCENT,
) -> DataFrame:
    """(doc_id, item_id, start, n_words, distance, similarity): each item that a document holds,
    at the window most like it (`start` counts words from 1) of those that a common shingle aligns with an
    item, as in the SQL twin; of all others where none of these is like enough.

    Defined cases: null and empty texts hold nothing, empty items are found nowhere; items of
    fewer than five words are one shingle of their own length; repeated rows and rows that share
    an id give one row per id and item; rows without id give rows with a null id, one per item.
    Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "leaks")
    items = scratch.stage(
        benchmark.select(F.col(item_key).alias("item_id"), words(item_text).alias("words"))
        .filter(F.size("words") > 0)
        .withColumn("shingles", weighted_shingles("words"))
        .withColumn("shingles_weight", _weight(F.col("shingles")))
        .withColumn("fingerprint", simhash("shingles"))
        .select("item_id", F.size("words").alias("n_words"), "words", "shingles", "fingerprint")
    )
    found = items.withColumn("size", F.least("n_words", F.lit(SHINGLE)))
    least = found.groupBy("size", F.col("n_words").alias("other")).agg(
        F.min(_weight(F.col("shingles"))).alias("least"))
    # the first place of each shingle in its item gives the alignment
    posted = None
    for size in [r["size"] for r in found.select("size").distinct().collect()]:
        some = _with_run_hashes(found.filter(F.col("size") == size), size)
        weights = F.transform(
            F.sequence(F.lit(1), F.col("n_words") - F.col("size") + 1),
            lambda i: _heaviness(F.slice("words", i, F.col("size"))),
        )
        some = some.select(
            "item_id", "n_words", "size", F.posexplode(F.arrays_zip(
                F.col("hashes").alias("hash"), weights.alias("w"))).alias("at", "of"),
        ).select("item_id", "n_words", "size", "at", "of.hash", "of.w")
        posted = some if posted is None else posted.union(some)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", whole_text()))
    hits, sizes = None, {}
    if posted is not None:
        posted = scratch.stage(
            posted.groupBy("item_id", "hash", "n_words", "size")
            .agg(F.min("at").alias("at"), F.max("w").alias("w"))
            .groupBy("hash", "n_words", "size")
            .agg(F.collect_set("at").alias("ats"), F.max("w").alias("w"))
        )
        sizes = {r["size"]: r["n"] for r in posted.groupBy("size").agg(
            F.count(F.lit(1)).alias("n")).collect()}
    for size, n in sizes.items():
        passes = -(-n // BROADCAST_SHINGLES)
        hashed = _with_run_hashes(rows.select("row", words("text").alias("words")), size)
        for part in range(passes):
            some = posted.filter(
                (F.col("size") == size) & (F.pmod("hash", F.lit(passes)) == part)
            )
            # an outer explode has no filter pushed below it that would hash all runs once more
            hit = (
                hashed.select("row", F.posexplode_outer("hashes").alias("p", "hash"))
                .join(F.broadcast(some), "hash")
                .select("row", "p", "n_words", "size", "w", "ats")
            )
            hits = hit if hits is None else hits.union(hit)
    if hits is None:
        wanted = rows.select(
            "row", F.lit(0).alias("start"), F.lit(1).alias("n_words"), F.lit(True).alias("aligned")
        ).filter(F.lit(False))
    else:
        wanted = scratch.stage(_windows_that_may_reach(hits, least, percent, scratch))
    wanted = wanted.groupBy(F.col("row").alias("of")).agg(
        F.collect_list(F.struct("start", "n_words", "aligned")).alias("wanted")
    )
    first = F.greatest("at.start", F.lit(0))
    # the windows grow with the documents: the same join by shuffle whatever their number
    windows = scratch.stage(
        rows.join(wanted.hint("merge"), F.col("row") == F.col("of"))
        .select("doc_id", words("text").alias("all"), "wanted")
        .select("doc_id", "all", F.explode("wanted").alias("at"))
        .select(
            "doc_id", (first + 1).alias("start"), "at.aligned",
            F.slice("all", first + 1, F.col("at.start") + F.col("at.n_words") - first).alias("words"),
        )
        .withColumn("shingles", weighted_shingles("words"))
        .withColumn("shingles_weight", _weight(F.col("shingles")))
        .withColumn("fingerprint", simhash("shingles"))
        .select(
            "doc_id", "start", "fingerprint", "shingles", "aligned", F.size("words").alias("n_words"),
        )
    )
    # windows that say the same are looked up once
    blocks = windows.select("fingerprint").distinct().select(
        "fingerprint", F.inline(_block_values(F.col("fingerprint"), near=False))
    )
    near = items.select("fingerprint").distinct().select(
        F.col("fingerprint").alias("item_print"),
        F.inline(_block_values(F.col("fingerprint"), near=True)),
    )
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print")))
    pairs = (
        blocks.join(near, ["block", "value"])
        .withColumn("distance", distance)
        .filter(F.col("distance") <= RADIUS)
        .select("fingerprint", "item_print", "distance").distinct()
    )
    known = items.select(
        "item_id", F.col("fingerprint").alias("item_print"), F.col("shingles").alias("other")
    )
    common = _weight(F.array_intersect("shingles", "other"))
    checked = (
        windows.join(pairs, "fingerprint").join(known, "item_print")
        .withColumn("common", common)
        .withColumn("all", _weight(F.col("shingles")) + _weight(F.col("other")) - F.col("common"))
        .filter(f"100 * common >= {percent} * all")
        .withColumn("similarity", F.col("common") / F.col("all"))
    )
    best = F.max_by(
        F.struct("start", "n_words", "distance", "similarity"),
        F.struct("aligned", "similarity", -F.col("start")),
    )
    return checked.groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", "b.*"
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents that hold no benchmark item; a document without id cannot be named and stays."""
    found = contamination(docs, benchmark, key, text).select(F.col("doc_id").alias("__leak"))
    return docs.join(found.distinct(), F.col(key) == F.col("__leak"), "left_anti")
