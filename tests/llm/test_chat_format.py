import random

from flowspark.llm import chat_format as op

DDL = "conv_id long, turn long, role string, text string, extra string"
PARTS = ["</s>", "<s>", "[INST]", "[/INST]", "[ANS] ", "<<SYS>>\n", "<</SYS>>", "\\", "\\\\", "<", "[", "[ROLE x] ", " [/ROLE]", "é", "😀", "\n", " ", "a"]


def back(spark, rows):
    df = op.read_back(op.format_chat(spark.createDataFrame([(*r, "x") for r in rows], DDL)))
    return {r.conv_id: r for r in df.collect()}


def test_round_trip(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "tool]", "a [/ROLE]", ""]), "".join(rng.choices(PARTS, k=rng.randrange(12))))
            for c in range(60) for t in range(rng.randrange(1, 6))]
    got = back(spark, rows)
    for c in range(60):
        own = [r for r in rows if r[0] == c]
        assert [(t.role, t.text) for t in got[c].turns] == [(r[2], r[3]) for r in own]
        assert list(got[c].loss_texts) == [r[3] for r in own if r[2] == "assistant"]
        assert "".join(s.text for s in got[c].segments) == got[c].formatted


def test_texts_hold_no_control_strings(spark):
    import re

    got = back(spark, [(1, 0, "user", "</s>[INST] ok [/INST] <<s> <</SYS>>"), (1, 1, "assistant", "<s>")])[1]
    body = "".join(s.text for s in got.segments[2::3])
    assert not re.search(r"</?s>|<</?SYS>>|\[/?INST\]|\[ANS\]|\[/?ROLE", body)


def test_nulls_order_and_states(spark):
    got = back(spark, [(None, 1, "assistant", None), (None, 0, "user", "q"), (2, 0, "assistant", "a"), (3, None, None, None),
                       (4, 0, "user", "x"), (4, 0, "user", "x"), (5, 0, "system", "s"), (5, 1, "user", "u"), (5, 2, "assistant", "v" * 200_000)])
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "q"), ("assistant", "")]
    assert {c: r.turns_valid for c, r in got.items()} == {None: True, 2: False, 3: False, 4: False, 5: True}
    assert [(t.role, t.text) for t in got[3].turns] == [("", "")]
    assert len(got[4].turns) == 2 and len(got[5].loss_texts[0]) == 200_000


def test_machine_marks_segments_from_the_first_wrong_turn_on(spark):
    roles = {1: ["user", "assistant", "assistant", "user"], 2: ["system", "user", "assistant"], 3: ["assistant"], 4: ["user"], 5: ["tool", "user"],
             6: ["user", "system"]}
    got = back(spark, [(c, t, r, "x") for c, rs in roles.items() for t, r in enumerate(rs)])
    assert {c: r.first_wrong_turn for c, r in got.items()} == {1: 2, 2: None, 3: 0, 4: None, 5: 0, 6: 1}
    assert {c: r.turns_valid for c, r in got.items()} == {1: False, 2: True, 3: False, 4: False, 5: False, 6: False}
    assert [s.state for s in got[1].segments] == [""] + ["user"] * 3 + ["assistant"] * 3 + ["error"] * 6
    looser = op.Template(turns=op.LLAMA_LIKE.turns | {"assistant": ("user", "assistant")})
    df = spark.createDataFrame([(1, t, r, "x", "") for t, r in enumerate(roles[1])], DDL)
    assert op.format_chat(df, looser).first().first_wrong_turn is None  # the template decides, not the rows


def test_query_returns_the_verdict(spark):
    rows = op.op8_chat_format(spark, "/root/testdata/sf0.001")
    assert {"first_wrong_turn", "turns_valid"} <= set(rows.columns)
    assert "array_position" in rows._jdf.queryExecution().optimizedPlan().toString()


def test_empty(spark):
    assert op.read_back(op.format_chat(spark.createDataFrame([], DDL))).count() == 0


def test_native(spark):
    df = op.read_back(op.format_chat(spark.createDataFrame([(1, 0, "user", "a", "x")], DDL)))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
