import random

from pyspark.sql import functions as F
from tests_llm_help import ODD, text_of

from salesmart.llm import decontamination


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def weight(shingle):
    return 1 + sum(len(w) > 3 for w in shingle)


def shingles(words):
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def best_by_hand(text, item):
    """Greatest weighted similarity over the windows that a common shingle aligns."""
    words, target = (text or "").lower().split(), item.lower().split()
    want, best, n = shingles(target), 0.0, min(5, len(target))
    place = {}
    for j in range(len(target) - n, -1, -1):
        place[tuple(target[j : j + n])] = j
    for p in range(len(words) - n + 1):
        if (j := place.get(tuple(words[p : p + n]))) is not None:
            have = shingles(words[max(0, p - j) : p - j + len(target)])
            all_ = sum(map(weight, have | want))
            best = max(best, sum(map(weight, have & want)) / all_)
    return best


def test_planted_items_are_found(spark, frame):
    rng = random.Random(11)
    bench = [(i, text_of(rng, rng.randrange(8, 70))) for i in range(30)]
    bench.append((30, "two words"))
    rows = []
    for i in range(120):
        words = text_of(rng, rng.randrange(20, 200)).split()
        if i % 2:
            part = bench[rng.randrange(30)][1].split()
            if i % 4 == 1:  # cut short, changed or in capitals
                part = part[rng.randrange(0, 4) :]
                part[-1] = part[-1].upper()
            at = rng.randrange(len(words))
            words[at:at] = part
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    rows.append((120, "here are Two  WORDS of it"))
    got = {
        (r.doc_id, r.item_id): r.similarity
        for r in decontamination.contamination(frame(rows), items(spark, bench)).collect()
    }
    for doc, text in rows:
        for item, passage in bench:
            best = best_by_hand(text, passage)
            if best >= 0.75:
                assert abs(got.pop((doc, item)) - best) < 1e-9
    assert not got


def best_of_all_windows(words, target):
    want, best = shingles(target), 0.0
    for s in range(1 - len(target), len(words)):
        have = shingles(words[max(0, s) : s + len(target)])
        if have & want:
            best = max(best, sum(map(weight, have & want)) / sum(map(weight, have | want)))
    return best


def test_windows_that_no_shingle_aligns_are_found(spark, frame):
    """Items cut, changed or with a word more, at the ends of texts and within: brute force."""
    rng = random.Random(22)
    short = lambda n: [rng.choice("abcdefgh") + str(rng.randrange(99)) for _ in range(n)]
    bench, rows = [], []
    for i in range(150):
        item = [w if rng.random() < 0.5 else w + "long" for w in short(rng.randrange(20, 50))]
        bench.append((i, " ".join(item)))
        cut = rng.randrange(1, 7)
        part = [item[cut:], item[:-cut]][i % 2]
        if i % 3 == 0:
            part.insert(rng.randrange(len(part)), "more")
        around = short(30)
        rows.append((i, " ".join([around + part, part + around, around[:9] + part + around][i % 3])))
    best = {i: best_of_all_windows(t.split(), x.split()) for (i, t), (_, x) in zip(rows, bench, strict=True)}
    got = {
        r.doc_id: r.similarity for r in
        decontamination.contamination(frame(rows), items(spark, bench)).collect() if r.doc_id == r.item_id
    }
    want = {i for i, b in best.items() if b >= 0.75}
    aligned = {i for i in want if best_by_hand(rows[i][1], bench[i][1]) >= 0.75}
    assert len(aligned) < 0.97 * len(want)
    assert got.keys() <= want and all(got[i] <= best[i] + 1e-9 for i in got)
    assert len(want - got.keys()) <= 0.02 * len(want)  # SimHash has a recall


def test_multi_index_finds_all_pairs_within_the_radius(spark):
    rng = random.Random(12)
    base = [rng.getrandbits(64) for _ in range(40)]
    other = []
    for x in base:
        for flips in (0, 7, decontamination.RADIUS, decontamination.RADIUS + 1):
            y = x
            for b in rng.sample(range(64), flips):
                y ^= 1 << b
            other.append(y)
    signed = lambda v: [((x + 2**63) % 2**64 - 2**63,) for x in v]
    a, b = (spark.createDataFrame(signed(v), "f long") for v in (base, other))
    values = lambda df, near: df.select(
        "f", F.inline(decontamination._block_values(F.col("f"), near))
    )
    found = {
        (r[0] % 2**64, r[1] % 2**64)
        for r in values(a, True).toDF("x", "block", "value")
        .join(values(b, False).toDF("y", "block", "value"), ["block", "value"])
        .select("x", "y").distinct().collect()
    }
    near = {(x, y) for x in base for y in other if (x ^ y).bit_count() <= decontamination.RADIUS}
    assert near <= found


def test_odd_rows(spark, frame):
    bench = items(spark, [(1, None), (2, ""), (3, "word word word word word word"), (None, "one"),
                          (4, "x" * 200_000), (5, "repeated row"), (5, "repeated row")])
    got = {(r.doc_id, r.item_id) for r in decontamination.contamination(frame(ODD), bench).collect()}
    assert got == {(106, 3), (103, None), (105, 4), (104, 5)}
    assert not decontamination.contamination(frame([]), bench).collect()
    assert not decontamination.contamination(frame(ODD), items(spark, [])).collect()
    left = decontamination.drop_contaminated(frame(ODD), bench)
    assert {r.doc_id for r in left.collect()} == {None, 100, 101, 102, 107}
    assert left.columns == frame([]).columns


def test_benchmark_in_several_passes(spark, frame, monkeypatch):
    rng = random.Random(13)
    bench = [(i, text_of(rng, 20)) for i in range(10)]
    rows = [(i, text_of(rng, 30) + " " + t) for i, t in bench]
    monkeypatch.setattr(decontamination, "BROADCAST_SHINGLES", 50)
    got = decontamination.contamination(frame(rows), items(spark, bench)).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i in range(10)]


def test_no_python_in_the_plan(spark, small):
    from salesmart.llm import queries

    for name in ("op1_secrets", "op2_decontamination", "op5_chat_format"):
        plan = queries.QUERIES[name](spark, small)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_only_windows_that_may_be_similar_are_made(spark, frame, monkeypatch):
    """A shingle that all texts share makes no windows; a whole item makes those at its place. An
    item of one length is found by windows of another item's length too."""
    rng = random.Random(31)
    common = text_of(rng, 5)
    bench = [(i, common + " " + text_of(rng, 25 + i)) for i in range(8)]
    rows = [(i, text_of(rng, 40) + " " + common + " " + text_of(rng, 40)) for i in range(50)]
    rows += [(50 + i, text_of(rng, 40) + " " + t + " " + text_of(rng, 40)) for i, t in bench]
    made, reach = [], decontamination._windows_that_may_reach

    def counted(hits, least, percent, scratch):
        found = scratch.stage(reach(hits, least, percent, scratch))
        made.append((hits.count(), found.groupBy("row").count().collect()))
        return found

    monkeypatch.setattr(decontamination, "_windows_that_may_reach", counted)
    got = decontamination.contamination(frame(rows), items(spark, bench)).collect()
    assert {(50 + i, i) for i, _ in bench} == {(r.doc_id, r.item_id) for r in got}
    hits, windows = made[0]
    assert hits > 50 * 8 and len(windows) == 8
    assert max(r["count"] for r in windows) < 8 * 40


def test_fingerprints_of_light_and_heavy_windows(spark):
    rng = random.Random(32)
    rows = [[(rng.getrandbits(64) - 2**63, rng.randrange(1, 7)) for _ in range(n)]
            for n in (1, 2, 30, 9_000, 12_000)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)],
                               "i int, s array<struct<h: long, w: int>>")
    df = df.withColumn("s_weight", decontamination._weight(F.col("s")))
    got = {r.i: r.f for r in df.select("i", decontamination.simhash("s").alias("f")).collect()}
    assert sum(w for _, w in rows[3]) < 2**15 < sum(w for _, w in rows[4])
    for i, x in enumerate(rows):
        want = sum(1 << b for b in range(64) if sum(w if h >> b & 1 else -w for h, w in x) > 0)
        assert got[i] % 2**64 == want
