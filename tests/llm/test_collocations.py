import random
import re
from collections import Counter

import numpy as np
import pytest
from tests_llm_help import ODD

from salesmart.llm import collocations as co

ROW = "doc_id long, text string, lang string"


def brute(rows, mining):
    """All phrases of all texts, counted one by one."""
    found, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    found[lang, tuple(words[i : i + size])] += 1
    candidates = {k: f for k, f in found.items() if len(k[1]) > 1 and f >= mining.min_count}
    covered = Counter()
    for (lang, w), f in candidates.items():
        if len(w) == 3:
            for part in (w[:2], w[1:]):
                covered[lang, part] = max(covered[lang, part], f)
    by_lang = {}
    for (lang, w), a in candidates.items():
        if len(w) == 2 and covered[lang, w] and 100 * covered[lang, w] >= mining.covered_percent * a:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = found[lang, w[:k]], found[lang, w[k:]]
            cuts.append((10**6 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, mine in by_lang.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(mine)[: mining.top], 1)
    )


def found(df):
    return sorted(tuple(r) for r in df.collect())


def texts(rng, n):
    words = ["a", "b", "B", "the", "of", "é", "漢", "x-1", "😀"] + [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(len(words))]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", ";!? ", "\x0b", "\x1c "]
    rows = []
    for i in range(n):
        text = "".join(w + rng.choice(ends) for w in rng.choices(words, weights, k=rng.randrange(120)))
        rows.append((i, text, rng.choice(["en", "de", "und", None])))
    return rows


@pytest.mark.parametrize("limits", [None, (3, 20, 16, 24, 6)])
def test_equals_brute_force(spark, monkeypatch, limits):
    """Also where containers burst, tries spill, texts are cut and words are numbered anew."""
    if limits:
        for name, value in zip(("BURST", "SPILL", "_SEGMENT", "_PENDING", "_VOCABULARY"), limits, strict=True):
            monkeypatch.setattr(co, name, value)
    rows = texts(random.Random(5), 150)
    rows += [(900, "the the the of of the the the " * 30, "en"), (900, "the the the of of the the the " * 30, "en")]
    mining = co.Mining(min_count=4, top=25)
    docs = spark.createDataFrame(rows, ROW).repartition(3)
    assert found(co.collocations(docs, mining)) == brute(rows, mining)


def test_trie_takes_whole_subtrees(monkeypatch):
    monkeypatch.setattr(co, "BURST", 4)
    rng, trie, want = random.Random(2), co.HatTrie(3), Counter()
    runs = Counter()

    def counted(codes, counts):
        assert (np.diff(codes) > 0).all()  # a sorted run
        runs.update(dict(zip(codes.tolist(), counts.tolist(), strict=True)))

    for _ in range(30):
        codes = [(rng.randrange(1, 4) << 21 | rng.randrange(1, 5)) << 21 | rng.randrange(1, 9) for _ in range(60)]
        want.update(codes)
        trie.add(*np.unique(np.array(codes), return_counts=True))
        assert trie.entries == sum(trie._sizes.values())
        if rng.random() < 0.3:
            codes, counts = trie.take(trie.entries // 2)
            assert not {c >> 42 for c in codes.tolist()} & set(trie._root)
            counted(codes, counts)
    counted(*trie.take(0))
    assert runs == want and not trie.entries


def test_counts_beyond_64_bits(spark):
    """a * a * 1000000 for a count of ten million million."""
    big = 10**13
    parts = spark.createDataFrame(
        [("en", "x", 3 * big), ("en", "y", 2 * big), ("en", "z", big), ("en", "x y", 2 * big), ("en", "y z", big)],
        "lang string, phrase string, f long",
    )
    candidates = spark.createDataFrame(
        [("en", 2, "x y", 2 * big - 1), ("en", 3, "x y z", big - 7)], "lang string, size int, phrase string, a long"
    )
    got = {r.phrase: (r.l, r.r, r.score) for r in co._scored(candidates, parts).collect()}
    a = 2 * big - 1
    assert got["x y"] == (3 * big, 2 * big, 10**6 * a * a // (6 * big * big))
    a = big - 7
    cuts = [(10**6 * a * a // (3 * big * big), 3 * big, big), (10**6 * a * a // (2 * big * big), 2 * big, big)]
    assert got["x y z"] == min(cuts)[1:] + min(cuts)[:1]


def test_odd_rows(spark, frame):
    mining = co.Mining(min_count=2)
    rows = [(i, t, "en") for i, t in ODD]
    assert found(co.collocations(frame(ODD), mining)) == brute(rows, mining)
    assert not co.collocations(frame([])).collect()
    assert not co.collocations(frame([(1, None), (2, ""), (3, " .,\n\t")]), mining).collect()
    clash = spark.createDataFrame(
        [("a b", None, 1, 2, "c")] * 12, "text string, lang string, f int, size int, phrase string"
    )
    assert found(co.collocations(clash)) == [("und", 1, "a b", 12, 12, 12, 24, 1_000_000)]
