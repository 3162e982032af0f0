"""op11: paths against plain recursion, the template's round trip, and the query's SQL."""

import hashlib
import os
import random

import duckdb
import pytest

from parley.llm import QUERIES, ORACLES, chat

PIECES = ["<", "[", "\\", "\\\\", "|im_start|>", "|im_end|>", "<|im_end|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\n", "a", " é🙂", "<|endoftext|>"]
SHAPE = "tree long, node long, parent long, role string, text string, score double"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def digests(conv, turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def test_template_round_trip(spark):
    draw = random.Random(5)
    said = [("".join(draw.choices(PIECES, k=draw.randint(0, 4))), "".join(draw.choices(PIECES, k=draw.randint(0, 12)))) for _ in range(800)]
    rows = [(i // 4, i // 4, i % 4, *x) for i, x in enumerate(said)]
    made = chat.formatted(spark.createDataFrame(rows, "path long, tree long, place long, role string, text string"), trained=("", "a")).collect()
    assert len(made) == 200
    for r in made:
        mine = said[4 * r.path: 4 * r.path + 4]
        assert chat.parse(r.text) == mine
        assert [chat.unescape_text(r.text[m.start: m.start + m.length]) for m in r.mask] == [t for role, t in mine if role in ("", "a")]
        assert r.text.count(chat.START) == r.text.count(chat.END) == 4
        rest = r.text.replace(chat.START, "").replace(chat.END, "")
        assert not any(f + c in rest for f, c in chat.CONTROLS)


def plain_paths(rows, keep):
    by = {r[1]: r for r in rows}
    inner = {r[2] for r in rows}
    best = {}
    for r in rows:
        if r[1] in inner:
            continue
        way, at = [], r
        while at is not None and len(way) <= len(rows):
            way.insert(0, at)
            at = by.get(at[2])
        if len(way) <= len(rows):
            best.setdefault(r[0], []).append((-sum(x[5] or 0.0 for x in way) / len(way), r[1], [x[1] for x in way]))
    return {(leaf): way for found in best.values() for _, leaf, way in sorted(found)[:keep]}


@pytest.mark.parametrize("keep", [1, None])
def test_paths_of_trees(spark, keep, monkeypatch):
    monkeypatch.setattr(chat, "HOT_ROWS", 10)
    draw = random.Random(6)
    rows = []
    for node in range(700):
        tree = node % 5
        # one reply chain of hundreds, one root with very many replies, random trees; some parents are in no row
        parent = None if node < 5 else node - 5 if tree == 0 else 1 if tree == 1 else draw.choice([None, -9, *range(tree, node, 5)])
        rows.append((tree, node, parent, "user", str(node), draw.choice([None, 0.0, 0.5, 1.0])))
    rows += [(7, 9001, 9002, "user", "", 1.0), (7, 9002, 9001, "user", "", 1.0), (7, 9003, 9002, "user", "", 1.0)]  # a cycle and what hangs on it
    table = spark.createDataFrame(rows, SHAPE)
    got = {}
    for r in sorted(chat.paths(table, keep).collect(), key=lambda r: r.place):
        got.setdefault(r.path, []).append(r.node)
    assert got == plain_paths(rows, keep)
    assert {r.node for r in chat.unrooted(chat.climb(table)).collect()} == {9001, 9002, 9003}


def test_best_path_is_one_conversation(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "worse", 0.2), (1, 3, 1, "assistant", "better", 0.9), (1, 4, 2, "user", "more", 0.1),
            (2, 5, None, None, None, None)]
    messages = spark.createDataFrame(rows, SHAPE)
    got = {r.tree: r for r in chat.format_trees(messages.select("tree", "node", "parent", "score"), messages.select("node", "role", "text")).collect()}
    assert chat.parse(got[1].text) == [("user", "q"), ("assistant", "better")] and chat.parse(got[2].text) == [("", "")]
    assert [(m.start, m.length) for m in got[1].mask] == [(got[1].text.index("better"), 6)]


def test_odd_conversations(spark):
    """Nulls, ties, repeated rows, gaps, a conversation of many parts, clashing columns."""
    shape = "conv_id long, turn long, role string, text string, node string, tree int"
    rows = [(1, None, "user", "no turn"), (1, 5, "assistant", ""), (1, 9, None, None), (2, 0, "user", "same"), (2, 0, "user", "same"), (2, 0, "assistant", "x"),
            (None, 1, "assistant", "é" * 100_000), (None, 0, "user", "no id"), (3, 2 ** 40, "assistant", "far")]
    rows += [(4, i, "assistant" if i % 2 else "user", f"</s> {i}") for i in range(3 * chat.PART_TURNS + 5)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], shape).repartition(3)
    got = {r.conv_id: tuple(r)[:5] for r in chat.read_back(chat.format_conversations(df)).collect()}
    want = {}
    for c in (1, 2, 3, 4, None):
        # ties go by role, as the text decides only between equal roles
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or ""))
        want[c] = digests(c, [(r[2] or "", r[3] or "") for r in mine])
    assert got == want
    parts = chat.format_conversations(df.filter("conv_id = 4")).collect()
    assert sorted(p.part for p in parts) == [0, 1, 2, 3]
    assert chat.read_back(chat.format_conversations(df.limit(0))).collect() == []


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{os.path.join(folder, 'conversations.parquet')}'")
    want = sorted(db.execute(ORACLES["op11_chat_formatting"]).fetchall())
    got = sorted(tuple(r) for r in QUERIES["op11_chat_formatting"](spark, folder).collect())
    assert got == want and got[0][0] == -7
