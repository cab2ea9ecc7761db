import random

import pytest
from pyspark.sql import functions as F
from tests_llm_help import ODD, text_of

from salesmart.llm import queries, secrets, toxicity


def test_features_of_a_text():
    hits = toxicity._Hits(("idiot", "clown"))
    names = toxicity.FEATURES
    got = dict(zip(names, toxicity.describe("You IDIOT! a cl0wn, and idiots.", hits), strict=True))
    assert got["hits"] == 2 and got["distinct_hits"] == 1
    assert got["disguised_hits"] == 1 and got["hits_near_second_person"] == 1
    assert got["shouted_words"] > 0 and got["exclamations"] > 0
    assert toxicity.describe(None, hits) == toxicity.describe("", hits) == [0.0] * len(names)


def toxic_rows(rng, n):
    words = [f"{a}{b}" for a in "bdfgklmn" for b in "aeiou"]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) + rng.choice(words) for _ in range(rng.randrange(5, 120))]
        toxic = int(rng.random() < 0.2)
        for _ in range(rng.randrange(2, 6) * toxic):  # an invented insult with endings
            text[rng.randrange(len(text))] = "zorqu" + rng.choice(words)
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    return rows, labels


def test_held_out_accuracy_with_learned_words(spark, frame):
    rng = random.Random(19)
    rows, labels = toxic_rows(rng, 900)
    docs = frame(rows)
    known = spark.createDataFrame(labels, "doc_id long, toxic int").filter(
        ~toxicity.held_out(F.col("doc_id"))
    )
    model = toxicity.fit_toxicity(docs, known)
    assert any("zorqu".startswith(s) or s.startswith("zorqu") for s in model.stems)
    scored = toxicity.score_toxicity(docs, model)
    assert sorted(scored.columns) == sorted(docs.columns)
    out = [r for r in scored.collect() if toxic_fold(r.doc_id) == 1]
    truth = dict(labels)
    right = sum((r.score >= 0.7) == truth[r.doc_id] for r in out)
    assert len(out) > 200 and right / len(out) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def toxic_fold(i):
    from zlib import crc32

    return crc32(str(i).encode()) % 3


def test_held_out_rows_do_not_teach(spark, small):
    """Turning round the labels of the held-out third changes no score."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    out = toxicity.held_out(F.col("doc_id"))
    assert {r.doc_id for r in labels.filter(out).collect()} == {
        r.doc_id for r in labels.collect() if toxic_fold(r.doc_id) == 1
    }
    turned = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [
        sorted(
            toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, x.filter(~out)))
            .select("doc_id", "score").collect()
        )
        for x in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_toxicity_of_odd_rows(spark, frame):
    rng = random.Random(20)
    rows, labels = toxic_rows(rng, 300)
    labels = [*labels, (None, 1), (5, None), (7, 1), (7, 0), (7, 1)]
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = frame([*rows, *((i and i + 10_000, t) for i, t in ODD)])
    model = toxicity.fit_toxicity(docs, known)
    got = toxicity.score_toxicity(docs, model).collect()
    assert len(got) == len(rows) + len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert {r.row for r in got} == {"row"} and {r.features for r in got} == {"features"}
    assert not toxicity.score_toxicity(frame([]), model).collect()
    no_labels = toxicity.fit_toxicity(docs, known.filter("false"))
    assert {r.score for r in toxicity.score_toxicity(docs, no_labels).collect()} == {0.0}


HEX = "0123456789abcdef"


def findings(rng, n):
    rows = []
    for i in range(n):
        text = text_of(rng, 20).split()
        secret = "".join(rng.choice(HEX) for _ in range(40))
        kind = i % 4
        text[10] = (f'token = "{secret}"', f"commit {secret}", "ordinarywordsstandhere",
                    "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOP234567") for _ in range(16)))[kind]
        rows.append((i, " ".join(text)))
    return rows


def test_forest_removes_false_positives(frame):
    rng = random.Random(21)
    rows = findings(rng, 800)
    docs = frame(rows)
    found = secrets.candidates(docs, F.lit("src/app.py"))
    label = F.when(F.col("doc_id") % 4 == 0, 1).when(F.col("doc_id") % 4 == 3, 1).otherwise(0)
    known = found.withColumn("label", label)
    scanner = secrets.fit_scanner(docs, known.filter("doc_id < 400"), secrets.Fit(words=50))
    got = secrets.scan(found, scanner).filter("doc_id >= 400").collect()
    assert len(got) == 400
    right = sum((r.score >= 0.5) == (r.doc_id % 4 in (0, 3)) for r in got)
    assert right / len(got) > 0.98


def test_candidates_and_their_surroundings(frame):
    text = "x=abcdefghijklmnop1 y, ünabcdefghijklmnopq (QRSTUVWXYZ0123456789) end"
    got = sorted(secrets.candidates(frame([(1, text)]), F.lit(None)).collect(), key=lambda r: r.place)
    assert [(r.candidate, r.before, r.after) for r in got] == [
        ("abcdefghijklmnop1", "x=", " y, ünabcdefghijklmn"),
        ("QRSTUVWXYZ0123456789", " y, ünabcdefghijklmnopq (", ") end"),
    ]


def test_secrets_of_odd_rows(frame):
    docs = frame(ODD)
    found = secrets.candidates(docs, F.col("lang"))
    assert {r.doc_id for r in found.collect()} == {105}
    known = found.withColumn("label", F.lit(1))
    scanner = secrets.fit_scanner(docs, known)
    assert {r.score for r in secrets.scan(found, scanner).collect()} == {1.0}  # one class only
    assert not secrets.candidates(frame([]), F.col("lang")).collect()


def test_registered_scan_finds_issued_keys(spark, small):
    got = queries.QUERIES["op1_secrets"](spark, small).filter("secret").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    import re

    planted = {d for d, t in docs.items() if re.search(r"AKIA[A-Z2-7]{16}|token = \"|password=", t)}
    if len(planted) < 3:
        pytest.skip("too few secrets at this size")
    assert {r.doc_id for r in got} >= planted
