import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from tests_llm_help import ODD, text_of

from salesmart.llm import line_dedup, passages


def prose(rng, words):
    """Sentences of 5 to 14 words in lines of a few sentences."""
    out = []
    while words > 0:
        n = min(words, rng.randrange(5, 15))
        out.append(text_of(rng, n) + rng.choice([". ", ". ", "!\n", ".\n"]))
        words -= n
    return "".join(out).strip()


def put(rng, text, passage):
    words = text.split(" ")
    at = rng.randrange(len(words) + 1)
    return " ".join([*words[:at], passage, *words[at:]])


def test_planted_passages_are_found_and_clean_texts_left_alone(frame):
    rng = random.Random(14)
    rows, holders = [], {}
    for p in range(25):
        passage = prose(rng, rng.randrange(55, 120))
        for _ in range(rng.randrange(2, 6)):
            holders.setdefault(p, []).append(len(rows))
            rows.append(put(rng, prose(rng, rng.randrange(40, 200)), passage))
    clean = range(len(rows), len(rows) + 60)
    rows += [prose(rng, rng.randrange(10, 200)) for _ in clean]
    df = frame(list(enumerate(rows)))
    got = passages.repeated_spans(df).collect()
    assert {r.doc_id for r in got} == {d for ids in holders.values() for d in ids}
    for ids in holders.values():
        assert {r.doc_id for r in got if r.doc_id in ids and not r.kept} == set(ids[1:])
        assert all(r.first_doc == ids[0] for r in got if r.doc_id in ids)
    left = {r.doc_id: r.text for r in passages.drop_repeated_spans(df).collect()}
    for d, text in enumerate(rows):
        if d in clean or any(d == ids[0] for ids in holders.values()):
            assert left[d] == text
        else:
            assert 25 <= len(text.split()) - len(left[d].split()) <= 125


def sets_of(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def similar(one, two):
    both = len(one & two)
    return 100 * both >= 75 * (len(one) + len(two) - both)


def spans_by_force(texts):
    """Similar paragraphs of five words or more, by components, and common runs of 25 words; what
    adjoins is one span; spans of 25 words and more, kept ones without what goes."""
    lines, runs = [], {}
    for d, text in enumerate(texts):
        at = 0
        for part in text.lower().split("\n"):
            n = len(part.split())
            if n >= 5:
                lines.append((d, at, at + n, sets_of(part)))
            at += n
        words = text.lower().split()
        for i in range(len(words) - 24):
            runs.setdefault(tuple(words[i : i + 25]), []).append((d, i))
    group = list(range(len(lines)))
    for i, one in enumerate(lines):
        for j in range(i):
            if group[i] != group[j] and similar(one[3], lines[j][3]):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    holders = {}
    for g, (d, *_) in zip(group, lines, strict=True):
        holders.setdefault(g, set()).add(d)
    marked = {}
    for g, (d, start, end, _) in zip(group, lines, strict=True):
        if len(holders[g]) > 1:
            first = min(holders[g])
            marked.setdefault((d, d == first), []).append((start, end, first))
    for places in runs.values():
        first = min(places)[0]
        if max(places)[0] > first:
            for d, i in places:
                marked.setdefault((d, d == first), []).append((i, i + 25, first))
    spans = {}
    for key, found in marked.items():
        merged = []
        for start, end, first in sorted(found):
            if merged and start <= merged[-1][1] + 6:
                merged[-1] = (merged[-1][0], max(merged[-1][1], end), min(merged[-1][2], first))
            else:
                merged.append((start, end, first))
        spans[key] = [x for x in merged if x[1] - x[0] >= 25]
    out = {(d, s, e - s, f, False) for (d, kept), x in spans.items() if not kept for s, e, f in x}
    for (d, kept), x in spans.items():
        if kept:
            gone = sorted(spans.get((d, False), []))
            for s, e, f in x:
                low = [max(s, g[1]) for g in [(0, 0), *gone]]
                high = [min(e, g[0]) for g in [*gone, (e, e)]]
                out |= {(d, i, j - i, f, True) for i, j in zip(low, high, strict=True) if j - i >= 25}
    return out


def places_of(spans):
    return {(d, p, f, kept) for d, start, n, f, kept in spans for p in range(start, start + n)}


def test_spans_equal_brute_force(frame):
    """Random lines, short ones too; changed words, passages put inside lines, copied blocks."""
    rng = random.Random(22)
    pool = [text_of(rng, rng.randrange(1, 70)) for _ in range(60)]
    texts = []
    for _ in range(140):
        lines = [text_of(rng, rng.randrange(1, 50)) for _ in range(rng.randrange(1, 5))]
        at = rng.randrange(55)
        block = pool[at : at + rng.randrange(1, 5)] if rng.random() < 0.7 else []
        for line in block:
            words = line.split()
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
            if rng.random() < 0.3:  # a piece of it inside a line
                low = rng.randrange(len(words))
                i = rng.randrange(len(lines))
                lines[i] = put(rng, lines[i], " ".join(words[low : low + 40]))
            else:
                lines.insert(rng.randrange(len(lines) + 1), " ".join(words))
        texts.append(rng.choice(["\n", "\n\n", "\n"]).join(lines))
    got = {
        (r.doc_id, r.start, r.n_words, r.first_doc, r.kept)
        for r in passages.repeated_spans(frame(list(enumerate(texts)))).collect()
    }
    want = spans_by_force(texts)
    assert len(want) > 100
    # banding has a recall: a paragraph of similarity 0.75 is missed once in 256
    missed = places_of(want) ^ places_of(got)
    assert len(missed) <= 0.01 * len(places_of(want)), (len(missed), len(places_of(want)))
    whole = [x for x in want if x not in got]
    assert len(whole) <= 0.02 * len(want)


def test_runs_inside_a_line_of_one_sentence(frame):
    rng = random.Random(23)
    run = text_of(rng, 26)
    rows = [(1, f"{text_of(rng, 5)} {run} {text_of(rng, 5)}"), (2, f"{text_of(rng, 10)} {run} {text_of(rng, 10)}"),
            (3, f"{run.rsplit(' ', 1)[0]} {text_of(rng, 20)}"), (4, f"{run.rsplit(' ', 2)[0]} {text_of(rng, 20)}")]
    got = {(r.doc_id, r.start, r.n_words, r.first_doc, r.kept) for r in passages.repeated_spans(frame(rows)).collect()}
    assert got == {(1, 5, 26, 1, True), (2, 10, 26, 1, False), (3, 0, 25, 1, False)}


def test_similar_paragraphs_equal_brute_force(frame):
    """Paragraphs with changed words, and the runs of 25 words that are left between the changes."""
    rng = random.Random(15)
    texts = []
    for _ in range(40):
        base = text_of(rng, rng.randrange(30, 48)).split()
        for edits in range(rng.randrange(1, 4)):
            words = base.copy()
            for _ in range(edits):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    rng.shuffle(texts)
    got = {
        (r.doc_id, r.start, r.n_words, r.first_doc, r.kept)
        for r in passages.repeated_spans(frame(list(enumerate(texts)))).collect()
    }
    want = spans_by_force(texts)
    assert len(got ^ want) <= 0.02 * len(want)


def test_hashed_lines_equal_split_words():
    rng = random.Random(25)
    texts = [None, "", " \t\n\n", "A b\x0bB\x0ca\r\n a", "mit Ümläuten 漢字\u2003x 😀\n", "\n\nend"]
    texts += [" ".join(text_of(rng, 3, ["ab", "ba", "AB", "a", "b", "\n"]) for _ in range(40))]
    hashes, words, lines = passages.hashed_lines(texts, passages.Powers())
    split = [[p.split() for p in (t or "").encode().lower().split(b"\n")] for t in texts]
    assert lines.tolist() == [len(t) for t in split]
    assert words.tolist() == [len(p) for t in split for p in t]
    flat = [w for t in split for p in t for w in p]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))
    assert [len(x) for x in passages.hashed_lines([], passages.Powers())] == [0, 0, 0]


def test_periodic_texts_and_ranges(frame):
    """Ranges follow a word repeated for ever, and a period of a few words."""
    rng = random.Random(24)
    period = text_of(rng, 3)
    texts = [" ".join(["la"] * 60), "x " + " ".join(["la"] * 31), " ".join([period] * 20),
             text_of(rng, 9) + " " + " ".join([period] * 11), " ".join(["la"] * 24), period]
    got = {
        (r.doc_id, r.start, r.n_words, r.first_doc, r.kept)
        for r in passages.repeated_spans(frame(list(enumerate(texts)))).collect()
    }
    assert got == spans_by_force(texts)


def in_earlier(texts, n=25):
    """For each text the places of words within runs of n words that an earlier text has."""
    seen, found = set(), []
    for text in texts:
        words = text.lower().split()
        runs = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        found.append({i + j for i, r in enumerate(runs) if r in seen for j in range(n)})
        seen.update(runs)
    return found


def test_runs_of_words_are_found_wherever_they_start(frame):
    """Cut out of sentences of 20 to 30 words and put inside others; verse; joined and split lines."""
    rng = random.Random(19)

    def sentences(n):
        return " ".join(text_of(rng, rng.randrange(20, 31)) + "." for _ in range(n))

    texts = []
    for _ in range(30):
        source = sentences(6).split()
        at = rng.randrange(len(source) - 80)
        passage = source[at : at + rng.randrange(25, 81)]
        into = sentences(4).split()
        at = rng.randrange(len(into))
        texts += [" ".join(source), " ".join([*into[:at], *passage, *into[at:]])]
    verse = "\n".join(text_of(rng, 5) for _ in range(20))
    texts += [verse, text_of(rng, 7) + "\n" + verse, text_of(rng, 30) + " " + verse.replace("\n", " ")]
    sentence = text_of(rng, 30)
    texts += [text_of(rng, 40) + " " + sentence, text_of(rng, 60) + " " + sentence]
    # a passage, then more that a third text copies with it
    one, two = text_of(rng, 40), text_of(rng, 40)
    texts += [one, one + " " + two, one + " " + two]
    got = passages.repeated_spans(frame(list(enumerate(texts)))).collect()
    places = lambda d, kept: {
        p for r in got if r.doc_id == d and r.kept == kept
        for p in range(r.start, r.start + r.n_words)
    }
    for d, want in enumerate(in_earlier(texts)):
        assert places(d, False) == want
        assert not places(d, True) & want
    assert places(len(texts) - 2, True) == set(range(40, 80))
    left = {r.doc_id: r.text for r in passages.drop_repeated_spans(frame(list(enumerate(texts)))).collect()}
    assert left[61].split() == texts[61].split()[:7]


def test_spans_of_odd_rows(frame):
    rng = random.Random(16)
    long = prose(rng, 60)
    rows = [*ODD, (1, long), (1, long), (2, long + "\n" + long), (None, long), (3, long.upper())]
    df = frame(rows)
    got = passages.repeated_spans(df).collect()
    assert {(r.doc_id, r.kept) for r in got} == {(1, True), (2, False), (3, False)}
    left = passages.drop_repeated_spans(df)
    assert left.columns == df.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(i for i, _ in rows)
    assert {r.text for r in left.filter("doc_id in (2, 3)").collect()} <= {"", "\n"}
    assert left.filter("doc_id is null").count() == 2
    assert not passages.repeated_spans(frame([])).collect()
    assert not passages.drop_repeated_spans(frame([])).collect()


def line(rng):
    return text_of(rng, rng.randrange(4, 9))


def test_patience_blocks():
    a, b = list("abcdefgh"), list("xabcyzgh")
    assert line_dedup.aligned(a, b, set("abcdefgh")) == {1, 2, 3, 6, 7}
    assert line_dedup.aligned(a, b, {"b"}) == {1, 2, 3}
    # blocks in another order: the longest run in the order of both
    assert line_dedup.aligned(list("abcXYZ"), list("XYabc"), set("abcXYZ")) == {2, 3, 4}
    assert line_dedup.aligned(list("aab"), list("aac"), set("a")) == {0, 1}
    assert line_dedup.aligned([], list("a"), {"a"}) == set()


def test_aligned_lines_are_a_common_subsequence():
    rng = random.Random(17)
    for _ in range(300):
        pool = [f"l{i}" for i in range(12)]
        a = [rng.choice(pool) for _ in range(rng.randrange(0, 15))]
        b = [rng.choice(pool) for _ in range(rng.randrange(0, 15))]
        got = sorted(line_dedup.aligned(a, b, set(pool)))
        rest = iter(a)
        assert all(any(x == b[i] for x in rest) for i in got)
        once = [x for x in set(a) & set(b) if a.count(x) == 1 and b.count(x) == 1]
        if once:
            assert got


def test_repeated_lines_align_by_a_longest_common_subsequence():
    block = ["intro", "B1", "B2", "mid", "B1", "B2", "end"]
    assert line_dedup.aligned(block, ["g0", "B1", "B2", "g1"], {"B1", "B2"}) == {1, 2}
    assert line_dedup.aligned(["g0", "B1", "B2", "g1"], block, {"B1", "B2"}) in ({1, 2}, {4, 5})
    rng = random.Random(20)
    for _ in range(200):
        a = [rng.choice("abcd") for _ in range(rng.randrange(0, 25))]
        b = [rng.choice("abcd") for _ in range(rng.randrange(0, 25))]
        size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                size[i + 1][j + 1] = max(size[i][j + 1], size[i + 1][j], size[i][j] + (x == y))
        got = line_dedup._longest_common(a, b)
        assert len(got) == size[-1][-1] and all(b[i] == a[j] for i, j in got)
        assert all(i < k and j < m for (i, j), (k, m) in zip(got, got[1:], strict=False))


def test_lines_left_are_aligned_with_the_next_holder(frame):
    rng = random.Random(21)
    x, y, z = (text_of(rng, 6) for _ in range(3))
    own = [text_of(rng, 6) for _ in range(8)]
    footer = [own[0], x, y, "mid", x, y, "end"]
    rows = [(1, "\n".join(footer)), (2, "\n".join([own[1], x, y, own[2]])), (3, "\n".join([x, y, own[3]]))]
    rows += [(4, "\n".join([z, own[4], own[5]])), (5, "\n".join([own[5], z])), (6, "\n".join([own[5], z]))]
    got = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(frame(rows)).collect()}
    assert got[1] == rows[0][1] and got[4] == rows[3][1]
    assert got[2] == "\n".join([own[1], own[2]]) and got[3] == own[3]
    assert got[5] in (own[5], z) and got[6] == ""


def test_lines_go_from_the_later_document(frame):
    rng = random.Random(18)
    rows, first_of, pool = [], {}, [line(rng) for _ in range(60)]
    for i in range(80):
        own = [line(rng) for _ in range(rng.randrange(1, 6))]
        at = rng.randrange(0, 50)
        block = pool[at : at + rng.randrange(1, 8)] if rng.random() < 0.6 else []
        cut = rng.randrange(len(own) + 1)
        rows.append((i, "\n".join([*own[:cut], *block, *own[cut:]])))
        for x in rows[-1][1].split("\n"):
            first_of.setdefault(x, i)
    got = {r.doc_id: r for r in line_dedup.drop_repeated_lines(frame(rows)).collect()}
    for i, text in rows:  # blocks keep one order: every copied line goes
        kept = [x for x in text.split("\n") if first_of[x] == i]
        assert got[i].text == "\n".join(kept)
        assert got[i].n_lines == len(text.split("\n"))
        assert got[i].n_removed == len(text.split("\n")) - len(kept)


def test_short_lines_go_only_within_a_block(frame):
    a = "Yes.\n\na line that is long enough to be rare\nNo."
    rows = [(1, a), (2, "Yes.\nsomething else entirely for once\nNo."), (3, "x\n" + a), (4, a)]
    got = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(frame(rows)).collect()}
    assert got == {1: a, 2: rows[1][1], 3: "x", 4: ""}


def test_lines_of_odd_rows(frame):
    rows = [*ODD, (5, "a line that is long enough to be rare"), (5, "a line that is long enough to be rare"),
            (None, "a line that is long enough to be rare"), (6, " a line that is long enough to be rare\r")]
    df = frame(rows)
    got = line_dedup.drop_repeated_lines(df).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert {(r.doc_id, r.n_removed) for r in got if r.n_removed} == {(6, 1)}
    assert [r.text for r in got if r.doc_id == 100] == [None]
    assert not line_dedup.drop_repeated_lines(frame([])).collect()
    clash = line_dedup.drop_repeated_lines(df.withColumn("lines", F.lit(1)))
    assert set(clash.columns) == {*df.columns, "lines", "n_lines", "n_removed"}


def test_bitmaps_hold_their_ids_and_few_others(spark):
    """Bitmaps of 2^20 bits let one in fifty of the others through."""
    rng = random.Random(42)
    ids = [rng.getrandbits(64) - 2**63 for _ in range(20_000)]
    bits = passages._low_bits(spark.createDataFrame([(i,) for i in ids], "id long"))
    assert passages._may_hold(bits, np.array(ids, np.int64)).all()
    others = np.array([rng.getrandbits(64) - 2**63 for _ in range(200_000)], np.int64)
    assert passages._may_hold(bits, others).mean() < 0.003
    assert not passages._may_hold(passages._low_bits(spark.createDataFrame([], "id long")), others).any()
