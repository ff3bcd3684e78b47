"""Reply trees, the template and the loss mask."""

from __future__ import annotations

from hypothesis import given, settings, strategies as st

from lossline.llm import chat

HOSTILE = st.text(alphabet="\\#: <>/turn\nabé", max_size=30) | st.sampled_from(["</turn>\n", "### ", ": ", "\\", r"\### a: </turn> ok"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(HOSTILE, HOSTILE), max_size=6))
def test_template_is_reversible(turns):
    assert chat.parse("".join(chat.turn(r, t) for r, t in turns)) == turns


def back(spark, nodes, best=1):
    formatted = chat.format_paths(nodes, best)
    found = chat.read_back(formatted).collect()
    return {(r.tree, r.path): ([(t.role, t.text) for t in r.turns], r.loss) for r in found}


NODES = "tree long, node long, parent long, role string, text string, score double, conv_id long, path int"


def test_branches(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0),
        (1, 2, 1, "assistant", "good", 5.0),
        (1, 3, 1, "assistant", "bad", 1.0),
        (1, 4, 2, "user", "more", 0.0),
        (1, 5, 4, "assistant", "yes", 4.0),
        (1, 6, 4, "assistant", "no", 4.0),
        (2, 1, None, "assistant", None, None),
        (2, 2, 99, None, "orphan", 1.0),
        (3, 1, 2, "user", "a cycle", 0.0),
        (3, 2, 1, "user", "a cycle", 0.0),
        (None, 1, None, "user", "no tree id", 0.0),
    ]
    nodes = spark.createDataFrame([(*r, 7, 1) for r in rows], NODES)
    found = back(spark, nodes, best=2)
    good = [("user", "q"), ("assistant", "good"), ("user", "more")]
    # Equal scores: the smaller leaf first. What both paths share is learned once.
    assert found[(1, 1)] == (good + [("assistant", "yes")], "goodyes")
    assert found[(1, 2)] == (good + [("assistant", "no")], "no")
    assert found[(2, 1)] == ([("", "orphan")], "") and found[(2, 2)] == ([("assistant", "")], "")
    assert found[(None, 1)] == ([("user", "no tree id")], "")
    assert not any(tree == 3 for tree, _ in found)
    assert back(spark, nodes.limit(0)) == {}


def test_conversations(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(70)]
    rows += [(2, 0, "user", None), (2, 0, "user", None), (2, None, "system", "s"), (None, 5, None, "x"), (3, 1, "assistant", "only")]
    table = spark.createDataFrame([(*r, 1, "n", 2) for r in rows], "conv_id long, turn long, role string, text string, node int, TEXT string, place int")
    found = back(spark, chat.linear(table))
    assert found == {
        (1, 1): ([(r, t) for _, _, r, t in rows[:70]], "".join(f"t{t}" for t in range(1, 70, 2))),
        (2, 1): ([("system", "s"), ("user", ""), ("user", "")], ""),
        (3, 1): ([("assistant", "only")], "only"),
        (None, 1): ([("", "x")], ""),
    }
    assert chat.linear(table.limit(0)).count() == 0


def test_marks_lie_on_texts(spark):
    rows = [(1, 0, "user", "a: b"), (1, 1, "assistant", r"\### x </turn>"), (1, 2, "assistant", "")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_paths(chat.linear(table)).first()
    assert [chat.unescape(made.formatted[a:b]) for a, b in made.mask] == [r"\### x </turn>", ""]
