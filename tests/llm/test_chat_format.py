from pyspark.sql import functions as F

from tripmart.llm import chat_format as cf

NASTY = ["", "\\### Assistant: </turn> ok", "<turn user>\\l\\b\\g", "a < b > c \\", "</turn></turn>", "漢😀\n\t", "\\\\l<", "<turn "]


def machine(roles, t=cf.DEFAULT):
    state = t.start
    for r in roles:
        state = t.transitions.get((state, r), t.wrong)
    return state in t.final


def test_round_trip_and_loss(spark):
    rows = [(c, i, role, text) for c, text in enumerate(NASTY) for i, role in enumerate(["user", "assistant", "<tool>\\g"])]
    back = {r.conv_id: r for r in cf.read_back(cf.format_conversations(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    for c, text in enumerate(NASTY):
        assert [(t.role, t.text) for t in back[c].turns] == [("user", text), ("assistant", text), ("<tool>\\g", text)]
        assert back[c].loss_text == text and not back[c].valid


def test_machine_against_brute_force(spark):
    orders = ["u", "ua", "sua", "su", "uaua", "uau", "a", "uu", "suaa", "ss", "usa", "suaua", "x"]
    names = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
    rows = [(c, i, names[x], "t") for c, o in enumerate(orders) for i, x in enumerate(o)]
    made = cf.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for r in made.collect():
        assert r.valid == machine([names[x] for x in orders[r.conv_id]]), orders[r.conv_id]
        assert r.formatted == "".join(f"<turn {names[x]}>t</turn>" for x in orders[r.conv_id])
        assert [s.loss for s in r.segments[1::3]] == [x == "a" for x in orders[r.conv_id]]


def test_nulls_ties_and_clashing_columns(spark):
    long = "word " * 40_000
    rows = [(1, 2, "assistant", "b"), (1, None, "user", None), (1, 2, "assistant", "a"), (None, 0, None, "x"), (2, 0, "user", long),
            (1, 2, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit(5) for c in ("turns", "segments", "state", "loss", "valid", "formatted")})
    back = {r.conv_id: r for r in cf.read_back(cf.format_conversations(df)).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [("user", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")]
    assert back[1].loss_text == "aab"
    assert [(t.role, t.text) for t in back[None].turns] == [("", "x")]
    assert back[2].turns[0].text == long
    assert cf.format_conversations(df.limit(0)).count() == 0


def test_another_template(spark):
    t = cf.ChatTemplate(opening="[(", after_role="]", closing="(/]", loss_roles=("bot",),
                        transitions={("start", "me"): "me", ("me", "bot"): "bot"}, final=("bot",))
    rows = [(1, 0, "me", "x [( y (/] z"), (1, 1, "bot", "ok [(")]
    r = cf.read_back(cf.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), t), t).first()
    assert r.valid and [x.text for x in r.turns] == ["x [( y (/] z", "ok [("] and r.loss_text == "ok [("
