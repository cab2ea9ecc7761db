import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests_llm_help import ODD

from salesmart.llm import pitman_yor as py
from salesmart.llm.common import words_of

ROW = "doc_id long, text string, held boolean"


def score(spark, rows, model=py.Model(), **kw):
    docs = spark.createDataFrame(rows, ROW)
    return py.score_texts(docs, F.col("held"), model, **kw).collect()


# --- seating --------------------------------------------------------------------------------


def seatings(n, others, prior, d, strength):
    """The probability of each number of tables: all ways to seat the customers, one by one."""
    weight = defaultdict(float)

    def sit(left, sizes, w):
        if not left:
            weight[len(sizes)] += w
            return
        sit(left - 1, sizes + [1], w * (strength + d * (others + len(sizes))) * prior)
        for i, size in enumerate(sizes):
            sit(left - 1, sizes[:i] + [size + 1] + sizes[i + 1 :], w * (size - d))

    sit(n, [], 1.0)
    whole = sum(weight.values())
    return {t: w / whole for t, w in weight.items()}


@pytest.mark.parametrize("n, others, prior, d", [(2, 0, 0.2, 0.5), (3, 4, 0.01, 0.8), (5, 40, 0.1, 0.3), (7, 3, 0.9, 0.6)])
def test_tables_follow_their_conditional_distribution(n, others, prior, d):
    draws = 40_000
    rng = np.random.default_rng(3)
    got = py.draw_tables(np.full(draws, n), np.full(draws, others), np.full(draws, prior), d, 1.0, rng)
    counts = Counter(got.tolist())
    for tables, p in seatings(n, others, prior, d, 1.0).items():
        assert abs(counts[tables] / draws - p) < 4 * math.sqrt(p / draws) + 1e-4


def test_seated_from_few_to_many(monkeypatch):
    rng = np.random.default_rng(1)
    count = np.array([0, 1, 2, 199, 200, 201, 5_000, 10**9, 0, 1])
    n = len(count)
    tables = py.draw_tables(count, np.full(n, 9), np.full(n, 0.3), 0.7, 1.0, rng)
    assert (tables <= count).all() and ((tables > 0) == (count > 0)).all()
    assert tables[[0, 1, 8, 9]].tolist() == [0, 1, 0, 1]
    for prior, near in ((0.001, 0.05), (0.05, 0.05), (0.5, 0.15)):
        many = np.full(4000, 900)
        args = (np.full(4000, 50), np.full(4000, prior), 0.6, 1.0, rng)
        monkeypatch.setattr(py, "EXACT", 200)
        blocks = py.draw_tables(many, *args).mean()
        monkeypatch.setattr(py, "EXACT", 900)
        exact = py.draw_tables(many, *args).mean()
        assert abs(blocks / exact - 1) < near
    assert not len(py.draw_tables(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), 0.5, 1.0, rng))


# --- reading --------------------------------------------------------------------------------


class Counted(py._Numbers):
    looked_up = 0

    def __getitem__(self, word):
        Counted.looked_up += 1
        return super().__getitem__(word)


def test_texts_are_numbered_by_distinct_word_and_split_as_everywhere(monkeypatch):
    monkeypatch.setattr(py, "_Numbers", Counted)
    monkeypatch.setattr(py.TaskContext, "get", lambda: py.TaskContext)
    monkeypatch.setattr(py.TaskContext, "partitionId", lambda: 0)
    texts = [t for _, t in ODD]
    texts += [None, "", " ", " a", "a ", "\t\x0b\x0cA\x1cB\n", "ÀÉ Zé x\u0085y\u00a0z", "A\x00 a\x00", "b a " * 5_000]

    def read(parts=5):
        table = pa.table({"d": range(len(texts)), "h": [False] * len(texts), "t": pa.array(texts, pa.string())})
        return list(py._read_batches(parts, iter(table.to_batches())))

    distinct = len({w for t in texts for w in words_of(t)})
    Counted.looked_up = 0
    (batch,) = read()
    assert Counted.looked_up < distinct + 100  # not once for each of the 10,000 words
    numbers = py._Numbers()
    ids = [[*map(numbers.__getitem__, words_of(t)), 1] for t in texts]
    want = py._Batch(0, [(i, False) for i in range(len(texts))], ids, numbers, 5)
    assert batch.posts() == want.posts() and batch.asked() == want.asked()
    monkeypatch.setattr(py, "BATCH_TOKENS", 7)
    monkeypatch.setattr(py, "_SPLIT_BYTES", 16, raising=False)
    cut = read()
    assert [i for b in cut for i, _ in b.docs] == list(range(len(texts)))
    assert [b.number for b in cut] == list(range(len(cut))) and len(cut) > 3
    assert all(b.lengths[:-1].sum() < 7 for b in cut)
    assert [n for b in cut for n in b.lengths.tolist()] == [len(x) for x in ids]


# --- the model ------------------------------------------------------------------------------


def tables_of(rows, by):
    groups = defaultdict(list)
    for row in rows:
        groups[row[by]].append(row)
    return [pa.Table.from_pylist(g) for _, g in sorted(groups.items())]


def in_one_process(texts, model, parts=3, roots=2):
    """All steps without Spark: the averaged probability of every pair in the texts."""
    words, docs, ids = py._Numbers(), [], []
    for i, (text, held) in enumerate(texts):
        ids.append([*map(words.__getitem__, words_of(text)), 1])
        docs.append((i, held))
    batch = py._Batch(5, docs, ids, words, parts)
    posts = py._rows(batch.posts(), py._POST).to_pylist()
    state = [py._gather(t).to_pylist()[0] for t in tables_of(posts, "part")]
    count = np.concatenate([py._unpack(s["count"]) for s in state])
    discount = py._discount(int((count == 1).sum()), int((count == 2).sum()))
    totals, replies = [], []
    for number in range(model.rounds):
        asked = []
        for s in state:
            part = py._Part(s, discount, model)
            part.take([r for r in replies if r["part"] == s["part"]], totals)
            asked += py._rows(part.ask(roots), py._UP).to_pylist()
        root = py._root(number, roots, totals[-1] if totals else None, model)
        down = [r for t in tables_of(asked, "root") for r in root(t).to_pylist()]
        replies += down
        names = ["tokens", "distinct", "customers", "tables", "ones", "twos"]
        totals.append(py._Totals(*[sum(r[c] for r in down) for c in names]))
    spelled = {py.xxhash.xxh3_64_intdigest(w): w.decode() for w in words}
    out = {}
    for s in state:
        part = py._Part(s, discount, model)
        part.take([r for r in replies if r["part"] == s["part"]], totals)
        names = [spelled[h] for h in part.words.tolist()]
        for c, w, p in zip(part.context, part.word, part.total / part.samples, strict=True):
            out[names[c], names[w]] = p
    return out, totals[-1]


def test_probabilities_add_up_to_one_and_spark_gives_the_same(spark):
    rng = random.Random(4)
    known = [f"w{i}" for i in range(15)]
    texts = [(" ".join(rng.choices(known, range(1, 16), k=30)), False) for _ in range(40)]
    every = [*known, "unknown"]
    texts += [(f"{u} {w}", True) for u in every for w in every]
    model = py.Model(rounds=4)
    p, totals = in_one_process(texts, model, py.LEAST_PARTS, py.LEAST_PARTS)
    assert totals.distinct == 16 and totals.tokens == 40 * 31
    for u in every:
        assert abs(sum(p[u, w] for w in [*every, "  "]) - 1) < 1e-9
    assert abs(sum(p[" ", w] for w in every) + totals_of_end(p) - 1) < 1e-9
    got = score(spark, [(i, t, h) for i, (t, h) in enumerate(texts)], model)
    for r in got:
        path = [" ", *texts[r.doc_id][0].split(), "  "]
        want = sum(math.log10(p[a, b]) for a, b in itertools.pairwise(path))
        assert abs(r.score - want) < 1e-4


def totals_of_end(p):
    """An empty text is not among them: what the start leaves to the end is a share of the root."""
    return 1 - sum(v for (u, _), v in p.items() if u == " ")


def test_closed_form_where_all_sit_alone(spark):
    """Every word once: one customer and one table everywhere."""
    words = "a b c d".split()
    model = py.Model()
    got = {r.doc_id: r for r in score(spark, [(1, "a b c d", False), (2, "a d x", True)], model)}
    d = own = 0.95  # all counts are one
    root = 5  # four words and the end, each with one customer at one table
    even = (1 + own * root) / (root + 1)
    p = {w: ((1 - own) + even) / (1 + root) for w in [*words, "  "]}
    unknown = even / (1 + root)
    after = lambda prior, c: (c * (1 - d) + (1 + d) * prior) / 2
    whole = sum(math.log10(after(p[w], 1)) for w in [*words, "  "])
    assert abs(got[1].score - whole) < 1e-5
    steps = [after(p["a"], 1), after(p["d"], 0), after(unknown, 0), p["  "]]
    assert abs(got[2].score - sum(map(math.log10, steps))) < 1e-5


def test_it_learns_a_chain(spark):
    """Each word has three equally likely successors: log10(3) a token, less than single words say."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    after = {w: rng.sample(words, 3) for w in words}

    def text(n):
        out = [rng.choice(words)]
        while len(out) < n:
            out.append(rng.choice(after[out[-1]]))
        return " ".join(out)

    rows = [(i, text(100), i % 7 == 2) for i in range(300)]
    held = [r for r in score(spark, rows) if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    assert abs(sum(r.score for r in held) / tokens + math.log10(3)) < 0.08
    assert sum(r.base_score for r in held) / tokens < -1.6


def test_counts_and_base(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    got = py.score_texts(docs, held, stored=True).collect()
    rows = docs.select("doc_id", "text", held.alias("h")).collect()
    tokens = {r.doc_id: [*words_of(r.text), b" "] for r in rows}
    count = Counter(w for r in rows if not r.h for w in tokens[r.doc_id])
    n, v = sum(count.values()), len(count)
    assert len(got) == len(rows) and {r.doc_id for r in got if r.held_out} == {r.doc_id for r in rows if r.h}
    for r in got:
        own = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(w in count for w in own), n)
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)
        assert abs(r.base_score - base) < 1e-6 * abs(base)
        assert r.score < 0
    sums = [sum(getattr(r, c) for r in got if r.held_out) for c in ("score", "base_score", "n_tokens")]
    assert sums[0] - sums[1] > 0.3 * sums[2]


def test_held_out_rows_do_not_teach(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=40)), i % 3 == 0) for i in range(60)]
    other = [(i, "quite another text " * 9 if h and i else t, h) for i, t, h in rows]
    first = {r.doc_id: r.score for r in score(spark, rows)}
    second = {r.doc_id: r.score for r in score(spark, other)}
    same = [i for i, _, h in rows if not h or not i]
    assert all(first[i] == second[i] for i in same)
    monkeypatch.setattr(py, "BATCH_TOKENS", 100)  # another cut into batches, the same model
    third = {r.doc_id: r.score for r in score(spark, rows)}
    assert all(abs(first[i] - third[i]) < 1e-4 for i in first)


def test_odd_rows(spark, frame):
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    got = py.score_texts(frame(ODD), held).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == sorted(
        (i or 0, len(words_of(t)) + 1) for i, t in ODD
    )
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    twice = [r for r in got if r.doc_id == 104]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert not py.score_texts(frame([]), held).collect()
    none = score(spark, [(1, "no row teaches", True), (2, None, True)])
    assert {(r.train_tokens, r.n_known, r.score, r.base_score) for r in none} == {(0, 0, 0.0, 0.0)}
