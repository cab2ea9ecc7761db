"""The five stages, each against brute force on its own input."""

from collections import Counter

import corpus_pipeline as pipeline
from test_decontamination import best_by_hand
from test_near_dedup import by_hand


def test_stages_do_what_they_say(spark, small, root):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, small).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        if name != "shard":
            assert docs.columns == pipeline.COLUMNS
        rows[name] = docs.collect()
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "mix", "shard"]

    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    calm = {r.doc_id for r in rows["toxicity"]}
    assert sum(labels[d] == 0 and d not in calm for d in labels) <= 2
    assert sum(labels[d] == 1 and d in calm for d in labels) <= 5

    parts = by_hand([(r.doc_id, r.text) for r in rows["toxicity"]])
    assert {r.doc_id for r in rows["near_dedup"]} == set(parts.values())

    bench = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    for r in rows["near_dedup"]:
        held = any(best_by_hand(r.text, b) >= 0.75 for b in bench)
        assert held != any(x.doc_id == r.doc_id for x in rows["decontamination"])

    clean = {r.doc_id for r in rows["decontamination"]}
    read = Counter(r.doc_id for r in rows["mix"])
    assert read.keys() == clean and 1 <= max(read.values()) <= 2
    assert Counter(r.doc_id for r in rows["shard"]) == read
    sizes = Counter()
    for r in rows["shard"]:
        sizes[r.shard] += len(r.text.encode()) + 1
    longest = max(len(r.text.encode()) + 1 for r in rows["shard"])
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 2 * longest

    got = pipeline.run(spark, small).collect()
    assert Counter((r.doc_id, r.shard, r.slot) for r in got) == Counter(
        (r.doc_id, r.shard, r.slot) for r in rows["shard"]
    )
