"""Reply trees and the chat template against plain versions, with odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from rosterlink.llm import chat

SCHEMA = "id bigint, parent bigint, role string, text string, score double, root string, place int, formatted string"
ODD = ["", None, " ", "[INST]", "[\\INST] [\\\\/INST]", "</s>[INST] ok [/INST]", "\\", "[", "<s", " [/INST]", "</s", "x\ny [TEXT] ",
       "[SYS]\\[/SYS]", "é\U0001f600 <s>", "[[INST]", "<<s>>", "[ROLE] user [TEXT]", "a" * 50_000 + "[/TEXT]"]


def plain_branches(rows, best):
    """(root, branch) -> rows in order, by following parents one by one."""
    kept = {}
    for i, parent, role, text, score in rows:
        if i is not None:
            row = (-(score or 0.0), text or "", role or "", (parent is not None, parent or 0), parent)
            kept[i] = min(kept.get(i, row), row)
    parent = {i: r[4] if r[4] in kept and r[4] != i else None for i, r in kept.items()}
    leaves = {}
    for i in kept.keys() - set(parent.values()):
        way, at = [], i
        while at is not None and at not in way:
            way.append(at)
            at = parent[at]
        if at is None:
            leaves.setdefault(way[-1], []).append((sum(kept[w][0] for w in way), i, way[::-1]))
    return {(root, n): ([(kept[w][2], kept[w][1]) for w in way], -loss)
            for root, found in leaves.items() for n, (loss, _, way) in enumerate(sorted(found)[:best], 1)}


def got(spark, rows, best):
    frame = spark.createDataFrame([(*r, "r", 7, "f") for r in rows], SCHEMA).repartition(3)
    read = chat.read_back(chat.format_branches(chat.branches(frame, best)))
    return {(r.root, r.branch): r for r in read.collect()}


def test_branches_and_texts_of_random_trees(spark):
    draw = random.Random(3)
    rows = [(i, draw.choice([None, i, 9999] if i % 9 == 0 else [max(0, i - draw.randrange(1, 9))]),
             draw.choice(["user", "assistant", "system", "tool [TEXT] x", "", None]), draw.choice(ODD), float(draw.randrange(4)))
            for i in range(160)]
    # Rings, repeated ids, no id, no score.
    rows += [(500, 501, "user", "a", 1.0), (501, 500, "user", "b", 1.0), (502, 501, "user", "c", 1.0)]
    rows += [(20, 3, "user", "again", 9.0), (20, 3, "user", "again", 9.0), (None, 3, "user", "lost", 1.0), (600, None, "user", "only", None)]
    for best in (2, 1000):
        expected, found = plain_branches(rows, best), got(spark, rows, best)
        assert found.keys() == expected.keys()
        for key, (turns, score) in expected.items():
            row = found[key]
            assert [(t.role, t.text) for t in row.read] == turns
            assert row.branch_score == pytest.approx(score)
            # The mask covers the assistant's texts and nothing else.
            cut = [row.formatted[t.loss_from: t.loss_upto] for t in row.turns]
            assert [t for t, (role, _) in zip(row.learnt, turns) if role == "assistant"] == [t for role, t in turns if role == "assistant"]
            assert all(not c for c, (role, _) in zip(cut, turns) if role != "assistant")


def test_a_long_chain_takes_few_rounds(spark):
    rows = [(i, i - 1 if i else None, "user" if i % 2 else "assistant", f"t{i}", 1.0) for i in range(1000)]
    (row,) = got(spark, rows, 1).values()
    assert [t.text for t in row.read] == [f"t{i}" for i in range(1000)]
    assert row.branch_score == 1000
    frame = spark.createDataFrame([(*r, "r", 7, "f") for r in rows], SCHEMA)
    nodes, _ = chat._nodes(frame)
    assert len(chat._ancestors(nodes)[0]) == 10


def test_plain_conversations(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (None, 1, "user", "n"), (None, None, "user", "m"),
            (2, 1, None, None)]
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], "conv_id int, turn int, role string, text string, id string, parent int")
    made = chat.read_back(chat.format_branches(chat.branches(chat.chained(frame, "conv_id", ["turn"]))))
    texts = {r.root.conversation: (r.formatted, [t.text for t in r.read]) for r in made.collect()}
    assert texts == {
        1: ("[INST] a [/INST]<s> b </s><s> b </s>", ["a", "b", "b"]),
        None: ("[INST] m [/INST][INST] n [/INST]", ["m", "n"]),
        2: ("[ROLE]  [TEXT]  [/TEXT]", [""])}


def test_no_messages(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.format_branches(chat.branches(frame))).count() == 0
    assert chat.branches(chat.chained(frame.select(F.col("id").alias("c"), "role", "text", "place"), "c", ["place"])).count() == 0


def test_escaping_is_reversible_and_leaves_no_mark(spark):
    draw = random.Random(5)
    parts = ["[", "<", "\\", "/", "INST]", "s>", "SYS]", "TEXT]", "ROLE]", " ", "a", "[INST]", "</s>"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(12))) for _ in range(3000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    rows = frame.select("t", "e", chat.unescaped(F.col("e")).alias("back")).collect()
    marks = [m.strip() for pair in chat.MARKS.values() for m in pair] + ["[ROLE]", "[TEXT]", "[/TEXT]"]
    assert all(r.t == r.back and not any(m in r.e for m in marks) for r in rows)
    assert len({r.e for r in rows}) == len(set(texts))
