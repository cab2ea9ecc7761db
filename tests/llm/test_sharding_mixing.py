import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from salesmart.llm import mixing, sharding
from tests_llm_help import ODD, text_of


def shards_by_hand(sizes, n):
    total, before, out = sum(sizes), 0, []
    for s in sizes:
        out.append(min(n - 1, (2 * before + s) * n // (2 * total)))
        before += s
    return out


def test_shards_are_contiguous_and_equal(frame):
    rng = random.Random(1)
    rows = [(i, text_of(rng, rng.randrange(1, 200))) for i in rng.sample(range(10_000), 400)]
    got = sharding.assign_shards(frame(rows), sharding.text_size(F.col("text")), 8).collect()
    got = sorted(got, key=lambda r: r.doc_id)
    sizes = [len(r.text.encode()) + 1 for r in got]
    assert [r.shard for r in got] == shards_by_hand(sizes, 8)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(s == list(range(len(s))) for s in slots.values())


def test_shards_of_odd_rows(frame):
    rows = frame(ODD)
    got = sharding.assign_shards(rows, sharding.text_size(F.col("text")), 4).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in ODD)
    assert min(got, key=lambda r: (r.shard, r.slot)).doc_id is None
    assert not sharding.assign_shards(frame([]), sharding.text_size(F.col("text"))).collect()


def test_one_key_with_most_rows_is_split(frame):
    rows = [(7, "same")] * 300 + [(i, "other") for i in range(8, 108)]
    got = sharding.assign_shards(frame(rows), sharding.text_size(F.col("text")), 4).collect()
    assert [n for _, n in sorted(Counter(r.shard for r in got).items())] == [105, 105, 105, 85] or (
        max(Counter(r.shard for r in got).values()) - min(Counter(r.shard for r in got).values())
        <= 21
    )
    assert len({(r.shard, r.slot) for r in got}) == 400


def many(frame):
    rng = random.Random(2)
    rows = []
    for i in range(600):  # source 0 holds most
        source = 0 if i % 6 else i % 5 + 1
        rows.append((i, text_of(rng, rng.randrange(5, 40)), source))
    df = frame([(i, t) for i, t, _ in rows], extra=False).drop("source")
    of = {i: s for i, _, s in rows}
    spark = df.sparkSession
    sources = spark.createDataFrame([(i, f"s{s}") for i, s in of.items()], "doc_id long, source string")
    tokens = Counter()
    for i, t, s in rows:
        tokens[f"s{s}"] += len(t.split())
    return df.join(sources, "doc_id"), tokens


def weights(tokens, exponent):
    powers = {s: (t / sum(tokens.values())) ** exponent for s, t in tokens.items()}
    return {s: p / sum(powers.values()) for s, p in powers.items()}


def bisect(holds):
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if holds(middle) else (low, middle)
    return (low + high) / 2


def test_mix_meets_the_repetition_limit(frame):
    docs, tokens = many(frame)
    got = mixing.mix_sources(docs, mixing.Target(repeats=2.0, blocks=16)).collect()

    def too_flat(x):
        w = weights(tokens, x)
        rates = [w[s] / tokens[s] for s in tokens]
        return max(rates) / min(rates) > 2.0

    want = weights(tokens, bisect(too_flat))
    read, per = Counter(), Counter()
    for r in got:
        read[r.source] += r.mix_tokens
        per[r.source, r.doc_id] += 1
    assert {r.source: pytest.approx(r.mix_weight) for r in got} == want
    total = sum(read.values())
    for s in tokens:  # within a document of the quota
        assert abs(read[s] / total - want[s]) < 40 / total * 2 + 1e-3
        assert 0.99 <= read[s] / tokens[s] <= 2.01
    assert len({d for _, d in per}) == 600 and max(per.values()) <= 2
    # every pass is a permutation of its own
    first = {r.doc_id: r.mix_order for r in got if r.mix_pass == 1}
    assert all(0 <= x <= 1 for x in first.values())


def test_mix_meets_the_entropy(frame):
    docs, tokens = many(frame)
    target = mixing.Target(entropy=0.95, budget=3_000, blocks=16)
    got = mixing.mix_sources(docs, target).collect()
    entropy = lambda w: -sum(x * math.log(x) for x in w.values())
    x = bisect(lambda x: entropy(weights(tokens, x)) >= 0.95 * math.log(len(tokens)))
    want, read = weights(tokens, x), Counter()
    for r in got:
        read[r.source] += r.mix_tokens
    for s in tokens:
        assert abs(read[s] - 3_000 * want[s]) <= 40
    # the partial pass reads whole blocks but for one
    assert len(got) == len({(r.doc_id, r.mix_pass) for r in got})


def test_mix_of_odd_rows(frame):
    docs = frame(ODD).withColumn("source", F.when(F.col("doc_id") > 103, F.lit("a")))
    got = mixing.mix_sources(docs, mixing.Target(repeats=1.0)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in ODD)
    assert not mixing.mix_sources(frame([]), mixing.Target(repeats=2.0)).collect()
    with pytest.raises(ValueError):
        mixing.Target()


def test_no_source_is_read_less_than_once_however_large(spark, monkeypatch):
    """Shares of 1e9 to 1e11 tokens: powers are rounded, the quota of the largest source is not."""
    rng = random.Random(12)
    for _ in range(6):
        sizes = [rng.randrange(10**9, 10**11) for _ in range(rng.randrange(3, 9))]
        shares = spark.createDataFrame(
            [(f"s{i}", n, n / sum(sizes)) for i, n in enumerate(sizes)], "source string, tokens long, share double"
        )
        target = mixing.Target(repeats=2.0)
        exponent, powers, budget = mixing.find_exponent(shares, target)
        weight = F.pow("share", F.lit(exponent)) / F.lit(powers)
        quotas = shares.withColumn("__weight", weight).withColumn("q", mixing._quota(budget, target))
        rows = quotas.collect()
        assert all(r.q >= r.tokens for r in rows)
        assert all(r.q <= 2 * r.tokens + 1e-6 * r.tokens for r in rows)
        assert min(r.q / r.tokens for r in rows) < 1 + 1e-9
