import random
from hashlib import sha256

import numpy as np
from tests_llm_help import ODD, text_of

from salesmart.llm import fingerprints as fp


def by_hand(text):
    """Order MinHash, one k-mer at a time."""
    points = fp.code_points(text)
    if not len(points):
        return np.zeros(fp.SAMPLES, np.uint64)
    seen, kmers = {}, []
    for h in fp._kmers(points).tolist():
        times = seen[h] = seen.get(h, -1) + 1
        plus = (h + times * int(fp._BASE)) % 2**64
        kmers.append(h if not times else int(fp.mix(np.array([plus], np.uint64))[0]))
    out = []
    for flip, factor in zip(fp._FLIP[:, 0].tolist(), fp._FACTOR[:, 0].tolist(), strict=True):
        order = sorted(range(len(kmers)), key=lambda i: ((((kmers[i] >> 32) ^ flip) * factor) % 2**32, i))
        first, last = min(order[:2]), max(order[:2])
        value = (kmers[first] * int(fp._BASE) + kmers[last]) % 2**64
        out.append(int(fp.mix(np.array([value], np.uint64))[0]))
    return np.array(out, np.uint64)


def test_fingerprint_equals_the_slow_form():
    rng = random.Random(8)
    texts = ["", "a", "abcdefgh", "abcdefghi", "aaaa" * 30, "abcabcabc" * 400, text_of(rng, 700), "漢字😀" * 5]
    for t in texts:
        assert (fp.fingerprint(fp.code_points(t)) == by_hand(t)).all(), t[:20]


def test_likeness_follows_edits_and_order():
    rng = random.Random(9)
    words = text_of(rng, 300).split()
    base = fp.fingerprint(fp.code_points(" ".join(words)))
    few = words.copy()
    few[100] = "changed"
    moved = words[150:] + words[:150]
    like = lambda w: fp.likeness(base, fp.fingerprint(fp.code_points(" ".join(w))))
    assert like(words) == 1.0 and like(few) > 0.8
    assert 0.2 < like(moved) < like(few)  # the same k-mers in another order
    assert like(text_of(rng, 300).split()) < 0.05


def test_neighbours(spark, frame):
    rng = random.Random(10)
    rows = [(i, text_of(rng, rng.randrange(0, 60))) for i in rng.sample(range(5000), 90)]
    rows += [(i, t) for i, t in ODD if i is not None and i != 106]
    got = sorted(fp.compare_with_next(frame(rows)).collect(), key=lambda r: r.doc_id)
    assert len(got) == len(rows)
    texts = [t or "" for _, t in sorted(rows, key=lambda r: r[0])]
    for r, text, after in zip(got, texts, texts[1:] + texts[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == sha256(edited.encode()).hexdigest()
        a, b, c = (fp.fingerprint(fp.code_points(t)) for t in (text, edited, after))
        assert (r.near_edited, r.near_next) == (fp.likeness(a, b), fp.likeness(a, c))
        assert r.fingerprint == fp._bytes(a).hex()
        assert r.edited_fingerprint == fp._bytes(b).hex()


def test_odd_rows(frame):
    assert not fp.compare_with_next(frame([])).collect()
    one = fp.compare_with_next(frame([(5, "alone in the table")])).collect()
    assert one[0].near_next == 1.0
    no_id = fp.compare_with_next(frame([(None, "abcdefghijklmnop"), (None, None)])).collect()
    assert sorted(r.n_chars for r in no_id) == [0, 16]
    prints = {r.id: r.fingerprint for r in fp.fingerprints(frame(ODD)).collect()}
    assert prints[100] == prints[101] and set(prints[100]) == {"0"}
