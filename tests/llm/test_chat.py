"""Chat formatting: machine, mask and the way back, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from riskfeat.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
MARKS = ["### ", "</turn>", ": ", "\\", "\\0", "\\1", "#", "<", "\n", "a", "ä", "🙂", "</turn", "### assistant: "]


def plain(rows):
    """conv -> (turns, loss texts, number of bad turns, valid)."""
    by = {}
    for c, n, r, t in rows:
        by.setdefault(c, []).append((n is not None, n or 0, r or "", t or ""))
    follows = chat.ChatTemplate().follows
    out = {}
    for c, turns in by.items():
        turns = [(r, t) for *_, r, t in sorted(turns)]
        before = [None] + [r for r, _ in turns]
        bad = sum(r not in follows.get(b, ()) for b, (r, _) in zip(before, turns))
        out[c] = (turns, [t for r, t in turns if r == "assistant"], bad, bad == 0 and turns[-1][0] == "assistant")
    return out


def got(df, block=chat.BLOCK):
    seg = chat.format_conversations(df, block=block)
    rows = chat.joined(seg).withColumn("turns", chat.read_back(F.col("formatted"))).collect()
    return {r["conv"]: ([(t["role"], t["text"]) for t in r["turns"]], r["loss_texts"], r["n_bad"], r["valid"]) for r in rows}, {r["conv"]: r["formatted"] for r in rows}


def conversations(seed):
    rnd = random.Random(seed)
    rows = []
    for c in list(range(30)) + [None]:
        for n in range(rnd.choice([1, 2, 5, 40])):
            text = "".join(rnd.choice(MARKS) for _ in range(rnd.randrange(8)))
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "a: b", "### x", "\\3"])
            rows.append((c, rnd.choice([n, n, n // 2, None, -n]), role, rnd.choice([text, text, None])))
    return rows


@pytest.mark.parametrize("block", [1, 3, 1 << 40])
def test_equals_plain_python_whatever_the_block(spark, block):
    rows = conversations(7)
    have, _ = got(spark.createDataFrame(rows, SCHEMA).repartition(5), block)
    assert have == plain(rows)


def test_good_and_bad_orders(spark):
    orders = {1: "sua", 2: "uaua", 3: "ua" * 900, 4: "au", 5: "uua", 6: "us", 7: "u", 8: "suaa", 9: "a"}
    names = {"s": "system", "u": "user", "a": "assistant"}
    rows = [(c, k, names[x], f"{c}-{k}") for c, o in orders.items() for k, x in enumerate(o)]
    have, _ = got(spark.createDataFrame(rows, SCHEMA), block=100)
    assert {c: (v[2], v[3]) for c, v in have.items()} == {1: (0, True), 2: (0, True), 3: (0, True), 4: (1, False), 5: (1, False), 6: (1, False), 7: (0, False), 8: (1, False), 9: (1, False)}
    assert have[8][1] == ["8-2", "8-3"]  # a text is trained on whatever the order


def test_marks_in_texts_are_escaped(spark):
    rows = [(1, 0, "user", r"\### Assistant: </turn> ok"), (1, 1, "assistant", "### user: x</turn>\n" * 3), (1, 2, "x: y", "")]
    have, formatted = got(spark.createDataFrame(rows, SCHEMA))
    assert have[1][0] == [(r, t) for _, _, r, t in rows]
    assert formatted[1].count("### ") == formatted[1].count("</turn>\n") == 3
    seg = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).orderBy("place", "part").collect()
    assert [s["loss"] for s in seg] == [False, False, False, False, True, False, False, False, False]
    assert "".join(s["segment"] for s in seg) == formatted[1]


def test_edges(spark):
    empty, _ = got(spark.createDataFrame([], SCHEMA))
    assert empty == {}
    long = "ab ### </turn> \\" * 50_000
    df = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long), (1, 1, "assistant", long)], SCHEMA)
    for c in ("block", "place", "part", "segment", "loss", "ok", "conv", "key", "before", "edge"):
        df = df.withColumn(c, F.lit("x"))
    have, _ = got(df)
    assert have[1] == ([("user", long), ("assistant", long), ("assistant", long)], [long, long], 1, False)


def test_templates_that_cannot_be_read_back_are_refused():
    for bad in ({"open": "\\x"}, {"close": "abca"}, {"close": ""}, {"after_role": "#"}, {"escape": "ab"}):
        with pytest.raises(ValueError):
            chat.ChatTemplate(**bad)


def test_other_template(spark):
    t = chat.ChatTemplate(open="<s>", after_role="|", close="</s>", gap="", escape="%", loss_roles=("bot", "tool"), ends=("bot",), follows={None: ("me",), "me": ("bot", "tool"), "tool": ("bot",), "bot": ("me",)})
    rows = [(1, 0, "me", "100% <s>|"), (1, 1, "tool", "x"), (1, 2, "bot", "</s>%0")]
    out = chat.joined(chat.format_conversations(spark.createDataFrame(rows, SCHEMA), t), t).withColumn("turns", chat.read_back(F.col("formatted"), t)).first()
    assert out["valid"] and out["loss_texts"] == ["x", "</s>%0"]
    assert [tuple(x) for x in out["turns"]] == [(r, x) for _, _, r, x in rows]


def test_no_python_in_the_plan(spark, sf_dir):
    from riskfeat.llm import queries

    plan = queries.QUERIES["op12_chat_format"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))
