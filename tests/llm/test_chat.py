"""Chat packing: round trips, sharing, depth-first layout, attention, edge cases."""

import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import SF, collected, rows
from tickroll.llm import chat
from tickroll.llm.catalog import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, node string, size int"


def packed(spark, turns):
    return chat.pack(spark.createDataFrame([(*t, "x", 1) for t in turns], SCHEMA))


def expected(turns):
    convs = {}
    for c, turn, role, text in turns:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for c, items in convs.items():
        items.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in items)
        loss = "".join(t for _, _, r, t in items if r == "assistant")
        chars = sum(len(chat.format_turn(r, t)) for _, _, r, t in items)
        out.append((c, len(items), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
    return sorted(out, key=repr)


def check_layout(nodes):
    """Every attention interval set holds exactly the ancestors, positions run along paths, and the order is depth-first."""
    by = {bytes(n["node"]): n for n in nodes}
    ordered = sorted(nodes, key=lambda n: n["start"])
    at = 0
    open_ends = []
    for n in ordered:
        assert n["start"] == at, "the stream has no gaps"
        at += n["size"]
        while open_ends and open_ends[-1] <= n["start"]:
            open_ends.pop()
        assert len(open_ends) == n["depth"], "a node lies inside exactly its ancestors' subtrees"
        open_ends.append(n["subtree_end"])
        above, parent = [], bytes(n["parent"])
        while parent:
            above.append(by[parent])
            parent = bytes(by[parent]["parent"])
        assert n["position"] == sum(a["size"] for a in above)
        covered = sorted(x for a, b in n["attention"] for x in range(a, b))
        assert covered == sorted(x for a in above for x in range(a["start"], a["start"] + a["size"]))
        assert n["size"] == len(n["formatted"])


def test_query_on_the_conversations(spark):
    said = "</s>[INST] ok [/INST]"
    turns = rows("conversations", "conv_id", "turn", "role", "text") + [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    assert collected(QUERIES["op9_chat"](spark, SF)) == expected(turns)


def test_shared_turns_are_emitted_once_in_depth_first_order(spark):
    turns = []
    for c, texts in enumerate(["a", "a b", "a b c", "a b d", "a e", "a b c", "f", "f b", "a b d g h", "a"]):
        turns += [(c, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts.split())]
    nodes, paths, leaves = packed(spark, turns)
    found = nodes.collect()
    assert len(found) == 9 and leaves.select("leaf").distinct().count() == 8
    check_layout(found)
    assert collected(chat.read_back(nodes, paths, leaves)) == expected(turns)


def test_edge_cases(spark):
    turns = [(1, 0, "user", None), (1, 1, None, ""), (1, 1, "assistant", "same"), (1, 1, "assistant", "same"), (2, None, "user", "first"),
             (2, 0, "assistant", "x" * 50_000), (None, 0, "user", "no id"), (None, 1, "assistant", "é🎉\\<|end|>\\\\<|turn|>[INST]"),
             (3, 5, "sys<|text|>tem", "a\nb"), *[(4, i, "assistant", f"t{i}") for i in range(300)]]
    nodes, paths, leaves = packed(spark, turns)
    check_layout([n for n in nodes.collect() if n["size"] < 2000 and n["depth"] < 0] or [])
    assert collected(chat.read_back(nodes, paths, leaves)) == expected(turns)
    long = nodes.filter("depth = 299").first()
    assert len(long["attention"]) == 1, "an unbranched path is one interval"


def test_no_row_holds_a_long_conversation(spark, monkeypatch):
    turns = [(None, i, "user", f"t{i}") for i in range(3000)]
    turns += [(1, i, "user", f"t{i}") for i in range(1500)] + [(2, i, "user", f"t{i}" if i < 700 else "other") for i in range(900)]
    turns += [(3, i, "user", f"t{i}") for i in range(1500)] + [(4, 0, "user", "else")]
    written, stage = [], chat.stage
    monkeypatch.setattr(chat, "stage", lambda df, name: written.append(stage(df, name)) or written[-1])
    nodes, paths, leaves = packed(spark, turns)
    arrays = [df.select(F.max(F.size(c))).first()[0] for df in written for c, t in df.dtypes if t.startswith("array")]
    assert arrays and max(arrays) <= 4, "forks and intervals only"
    assert collected(chat.read_back(nodes, paths, leaves)) == expected(turns)
    assert leaves.select("leaf").distinct().count() == 4 and paths.count() == 3000 + 1500 + 900 + 1


def test_order_is_that_of_whole_paths(spark):
    rnd = random.Random(5)
    turns = [(None if c == 7 else c, i, "user", rnd.choice("ab")) for c in range(60) for i in range(rnd.randrange(1, 9))]
    nodes, paths, _ = packed(spark, turns)
    found = nodes.collect()
    check_layout(found)
    ways = {}
    for r in sorted(paths.collect(), key=lambda r: r["depth"]):
        ways.setdefault(r["rank"], []).append(bytes(r["node"]))
    assert [ways[k] for k in range(len(ways))] == sorted(ways.values())
    first = list(dict.fromkeys(n for k in range(len(ways)) for n in ways[k]))
    assert [bytes(n["node"]) for n in sorted(found, key=lambda n: n["start"])] == first


def test_token_counts_and_loss_mask(spark):
    turns = [(c, i, ("user", "assistant", "system")[i % 3], t) for c, texts in enumerate([["é", "[INST]ü\\", "x"], ["é", "other", "", "b", "日本"], ["q", ""]])
             for i, t in enumerate(texts)]
    nodes, paths, leaves = chat.pack(spark.createDataFrame([(*t, "x", 1) for t in turns], SCHEMA), count=lambda s: len(s.encode()))
    found = nodes.collect()
    by, at = {bytes(n["node"]): n for n in found}, 0
    for n in sorted(found, key=lambda n: n["start"]):
        data, (role, text) = n["formatted"].encode(), chat.parse_turn(n["formatted"])
        assert n["start"] == at and n["size"] == len(data)
        at += n["size"]
        above, parent = 0, bytes(n["parent"])
        while parent:
            above, parent = above + by[parent]["size"], bytes(by[parent]["parent"])
        assert n["position"] == above
        masked = "".join(chat.unescape(data[a:b].decode()) for a, b in n["loss"])
        assert masked == "".join(chat.unescape(n["formatted"][a:b]) for a, b in n["loss_text"]) == (text if role == "assistant" else "")
    assert collected(chat.read_back(nodes, paths, leaves)) == expected(turns)
    bare = nodes.withColumn("loss_text", F.expr("filter(loss_text, x -> false)"))
    assert {r["loss_chars"] for r in chat.read_back(bare, paths, leaves).collect()} == {0}, "the text under the mask comes from the mask"


def test_empty_table(spark):
    assert collected(chat.read_back(*packed(spark, []))) == []


CONTROL_TEXT = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "|", "s>", "/", "a", "é", "\n", "[", "INST]", ""]), max_size=12).map("".join)


@given(CONTROL_TEXT, CONTROL_TEXT)
def test_escapes_are_reversible_and_leave_no_control_string(role, text):
    for x in (role, text):
        assert chat.unescape(chat.escape(x)) == x
        assert not any(c in chat.escape(x) for c in chat.CONTROLS)
    assert chat.parse_turn(chat.format_turn(role, text)) == (role, text)
