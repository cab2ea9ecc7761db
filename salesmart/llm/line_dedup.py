"""Operator 8: line dedup by pairwise alignment.

Documents that share a rare line are aligned by patience diff, and the aligned common blocks are
deleted from the later one. A line is rare if it is long enough not to recur by chance; how often it was copied
says nothing against it. A line's posting list, however long, is a star: each later document is aligned
with the first one that has the line. Lines that this leaves are posted again and aligned with the next document
that still has them, until a round takes nothing more.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import Scratch, whole_text

#: A line of so many characters or more, without white space at its ends, can pair documents.
RARE_CHARS = 24


def _lines(text: str) -> Column:
    return F.split(whole_text(text), "\n")


def _bare(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, r"^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+$", ""))


def line_marks(text: str = "text") -> Column:
    """For each line (hash, rare): a null hash stands for a blank line."""

    def mark(line: Column) -> Column:
        bare = _bare(line)
        return F.struct(
            F.when(F.char_length(bare) > 0, F.xxhash64(bare)).alias("hash"),
            (F.char_length(bare) >= RARE_CHARS).alias("rare"),
        )

    return F.transform(_lines(text), mark)


def _longest_rise(places: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence."""
    tops: list[int] = []
    last: list[int] = []
    before = [-1] * len(places)
    for i, x in enumerate(places):
        pile = bisect_left(tops, x)
        before[i] = last[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(x)
            last.append(i)
        else:
            tops[pile], last[pile] = x, i
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _grown(a, b, anchors, ranges, found: set[int]) -> list[tuple]:
    """Add the blocks of b around (place in b, place in a) anchors to `found`; the gaps they leave."""
    a0, a1, b0, b1 = ranges
    gaps, low_a, low_b = [], a0, b0
    for i, j in anchors:
        if i < low_b or j < low_a:  # inside the block before
            continue
        start_b, start_a = i, j
        while start_b > low_b and start_a > low_a and a[start_a - 1] == b[start_b - 1]:
            start_b, start_a = start_b - 1, start_a - 1
        stop_b, stop_a = i + 1, j + 1
        while stop_b < b1 and stop_a < a1 and a[stop_a] == b[stop_b]:
            stop_b, stop_a = stop_b + 1, stop_a + 1
        found.update(range(start_b, stop_b))
        gaps.append((low_a, start_a, low_b, start_b))
        low_a, low_b = stop_a, stop_b
    return [*gaps, (low_a, a1, low_b, b1)]


def _prefix_lengths(a: list, b: list) -> list[int]:
    """The longest common subsequence of b with each prefix of a, by one bit per line of a."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    every = (1 << len(a)) - 1
    open_ = every
    for x in b:
        hit = open_ & places.get(x, 0)
        open_ = (open_ + hit | open_ - hit) & every
    return [0, *accumulate(bit == "0" for bit in reversed(f"{open_:0{len(a)}b}"))]


def _longest_common(a: list, b: list) -> list[tuple[int, int]]:
    """(place in b, place in a) of a longest common subsequence, in linear space."""
    out, work = [], [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((b0, a0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((b1, a1))
        if a0 == a1 or b0 == b1:
            continue
        if b1 - b0 == 1:
            if b[b0] in a[a0:a1]:
                out.append((b0, a.index(b[b0], a0, a1)))
            continue
        half = (b0 + b1) // 2
        head = _prefix_lengths(a[a0:a1], b[b0:half])
        tail = _prefix_lengths(a[a0:a1][::-1], b[half:b1][::-1])[::-1]
        cut = a0 + max(range(a1 - a0 + 1), key=lambda k: head[k] + tail[k])
        work += [(a0, cut, b0, half), (cut, a1, half, b1)]
    return sorted(out)


def aligned(a: list, b: list, rare: set, a_range=None, b_range=None) -> set[int]:
    """Lines of b that a patience diff aligns with lines of a in a block with a rare line.

    Anchors are rare lines that both ranges have once; the longest set of them in the order of both is
    kept and each grows to both sides over equal lines; the gaps between are treated alike. In a range without
    such lines equal ends and a longest common subsequence of the rare lines take their place.
    None (a blank line) equals a blank line but is no anchor.
    """
    found: set[int] = set()
    work = [(*(a_range or (0, len(a))), *(b_range or (0, len(b))))]
    while work:
        a0, a1, b0, b1 = work.pop()
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_a = {x: i for i, x in enumerate(a[a0:a1], a0) if x in rare and in_a[x] == 1}
        common = [(i, at_a[x]) for i, x in enumerate(b[b0:b1], b0) if x in at_a and in_b[x] == 1]
        if not common:
            found |= _repeated(a, b, rare, a0, a1, b0, b1)
            continue
        anchors = [common[i] for i in _longest_rise([j for _, j in common])]
        work += _grown(a, b, anchors, (a0, a1, b0, b1), found)
    return found


def _repeated(a, b, rare, a0, a1, b0, b1) -> set[int]:
    """Without unique lines: common rare lines at the ends of both ranges, and a longest common subsequence between."""
    whole, found, block = (a0, a1, b0, b1), set(), []
    while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
        block.append(b0)
        a0, b0 = a0 + 1, b0 + 1
    found.update(block if any(b[i] in rare for i in block) else ())
    block = []
    while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
        a1, b1 = a1 - 1, b1 - 1
        block.append(b1)
    found.update(block if any(b[i] in rare for i in block) else ())
    in_a = [j for j in range(a0, a1) if a[j] in rare]
    there = {a[j] for j in in_a}
    in_b = [i for i in range(b0, b1) if b[i] in there]
    if in_b:
        pairs = _longest_common([a[j] for j in in_a], [b[i] for i in in_b])
        matched = [(in_b[i], in_a[j]) for i, j in pairs]
        found.update(i for i, _ in matched)
        for n, (i, j) in enumerate(matched):
            low_b, low_a = matched[n - 1] if n else (whole[2] - 1, whole[0] - 1)
            top_b, top_a = matched[n + 1] if n + 1 < len(matched) else (whole[3], whole[1])
            step = 1
            while i - step > low_b and j - step > low_a and a[j - step] == b[i - step]:
                found.add(i - step)
                step += 1
            step = 1
            while i + step < top_b and j + step < top_a and a[j + step] == b[i + step]:
                found.add(i + step)
                step += 1
    return found


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, earlier lines, later lines, rare flags of the later): the aligned line numbers."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            piece, out = batch.slice(at, 1000), []
            for a, b, flags in zip(*[piece[i].to_pylist() for i in (1, 2, 3)], strict=True):
                if a == b:
                    rare = any(flags)
                    out.append(list(range(len(b))) if rare else [])
                    continue
                rare = {x for x, f in zip(b, flags, strict=True) if f}
                out.append(sorted(aligned(a, b, rare)))
            yield pa.record_batch([piece[0], pa.array(out, pa.list_(pa.int32()))], ["row", "lines"])


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, lines): for each row that loses lines, their numbers from 0. `row` is `row_hash`."""
    scratch = Scratch(docs.sparkSession, "lines")
    marked = docs.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("doc"), row_hash(key, text).alias("row"), line_marks(text).alias("marks")
    )
    marked = scratch.stage(
        marked.select("doc", "row", "marks.hash", "marks.rare").dropDuplicates(["doc", "row"])
    )
    left = marked.select("doc", "row", F.posexplode(F.arrays_zip("hash", "rare")).alias("line", "m")).select(
        "doc", "row", "line", F.col("m.hash").alias("hash"), F.col("m.rare").alias("rare")
    ).filter("rare").drop("rare")
    earlier = marked.select(F.col("doc").alias("first"), F.col("hash").alias("a"))
    later = marked.select("row", F.col("hash").alias("b"), "rare")
    found = None
    while True:
        firsts = left.groupBy("hash").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        firsts = firsts.filter("first < last").select("hash", "first")
        # what the first document has is aligned with nothing later
        copies = left.join(firsts, "hash").filter("doc > first")
        pairs = scratch.stage(copies.select("first", "row").distinct())
        taken = scratch.stage(
            pairs.join(later, "row").join(earlier, "first").select("row", "a", "b", "rare")
            .mapInArrow(_align, "row long, lines array<int>")
            .select("row", F.explode("lines").alias("line"))
        )
        rest = scratch.stage(
            copies.select("doc", "row", "line", "hash").join(taken, ["row", "line"], "left_anti")
            .select("doc", "row", "line", "hash")
        )
        # round by round: the lines left are few, and each round puts the next document first
        fresh = found is None or not taken.join(left, ["row", "line"], "left_semi").isEmpty()
        found = taken if found is None else found.union(taken)
        left = rest
        if not fresh or left.isEmpty():
            break
    return found.groupBy("row").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def row_hash(key: str, text: str) -> Column:
    return F.xxhash64(key, whole_text(text))


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` with `text` cleaned and the counts `n_lines` and `n_removed`.

    Later means a greater id. A rare line always stays in the first document that has it. Defined cases: a null text stays null and
    has one empty line; blank lines go only inside an aligned block; rows without id and rows that share an id are not compared with each other;
    columns named `n_lines` or `n_removed` are replaced.
    """
    docs = docs.drop(*[c for c in ("n_lines", "n_removed") if c not in (key, text)])
    removed = repeated_lines(docs, key, text).toDF("__row", "__lines")
    joined = docs.withColumn("__own", row_hash(key, text)).join(
        removed, F.col("__own") == F.col("__row"), "left"
    )
    kept = F.filter(
        _lines(text), lambda line, i: ~F.coalesce(F.array_contains("__lines", i), F.lit(False))
    )
    clean = F.when(F.col("__lines").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return joined.withColumns({
        "n_lines": F.size(_lines(text)),
        "n_removed": F.when(F.col("__lines").isNull(), 0).otherwise(F.size("__lines")),
        text: clean,
    }).drop("__own", "__row", "__lines")
