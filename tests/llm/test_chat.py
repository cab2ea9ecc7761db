import random

import pytest
from pyspark.sql import functions as F

from salesmart.llm import chat


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def read_back(done):
    return {
        r.conv_id: r
        for r in done.select(
            "*",
            chat.read_turns(F.col("formatted")).alias("turns"),
            chat.read_loss(F.col("segments")).alias("loss"),
        ).collect()
    }


NASTY = [
    "", "\\", "\\\\", "###", "####", "#####", "\\###", "</turn>", "\\</turn>", "<</turn>>", "\\0", "\\1",
    "### Assistant: hi </turn>\n### User: x", " </turn>\n", "\n", "tail\\", "##", "</tur", "😀漢字",
]


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(3)
    pieces = [*NASTY, "a", "#", "<", "/turn>", " ", "0", "1"]
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 7)):
            text = "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 6)))
            role = rng.choice(["user", "assistant", "system", "tool", "user: ", ""])
            rows.append((conv, turn, role, text))
    got = read_back(chat.format_conversations(conversations(spark, rows)))
    for conv in {r[0] for r in rows}:
        want = [(r[2], r[3]) for r in rows if r[0] == conv]
        r = got[conv]
        assert [(t.role, t.text) for t in r.turns] == want
        assert r.loss == "".join(t for role, t in want if role == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)
        assert "".join(s.text for s in r.segments if s.loss).count("###") == 0
        assert r.formatted.count("</turn>") == len(want)


def test_machine_names_the_first_wrong_turn(spark):
    orders = {
        1: ["user", "assistant"], 2: ["system", "user", "assistant", "user", "assistant"],
        3: ["assistant"], 4: ["user", "user", "assistant"], 5: ["user", "assistant", "user"],
        6: ["user", "system", "assistant"], 7: ["user", "tool", "assistant"], 8: ["system"],
    }
    rows = [(c, i, role, "x") for c, roles in orders.items() for i, role in enumerate(roles)]
    got = read_back(chat.format_conversations(conversations(spark, rows)))
    assert {c: r.error for c, r in got.items()} == {
        1: None, 2: None, 3: "turn 0", 4: "turn 1", 5: "end", 6: "turn 1", 7: "turn 1", 8: "end",
    }
    assert all(r.valid == (r.error is None) for r in got.values())


def test_odd_rows(spark):
    rows = [
        (1, None, "user", None), (1, 0, "assistant", "b"), (1, 0, "assistant", "a"),
        (1, 0, "assistant", "a"), (None, 0, "user", "x"), (None, 0, "user", "x"),
        (2, 0, None, "no role"), (3, 0, "user", "y" * 300_000),
    ]
    df = conversations(spark, rows).withColumns({c: F.lit(c) for c in ("turns", "segments", "valid")})
    done = chat.format_conversations(df).collect()
    assert sorted(r.n_turns for r in done if r.conv_id is None) == [1, 1]
    one = next(r for r in done if r.conv_id == 1)
    assert [s.text for s in one.segments[1::3]] == ["", "a", "a", "b"]
    got = read_back(chat.format_conversations(conversations(spark, rows[6:])))
    assert got[2].turns[0].role is None and not got[2].valid
    assert len(got[3].turns[0].text) == 300_000
    assert not chat.format_conversations(conversations(spark, [])).collect()


def test_templates_are_checked():
    with pytest.raises(ValueError):
        chat.Template(control=("#",))
    with pytest.raises(ValueError):
        chat.Template(control=("a0",))
