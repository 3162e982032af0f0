"""Chat formatting of reply trees: paths from root to leaf, ranked, each formatted as one conversation.

A message names the message it replies to. Every leaf is the end of one path. Iterative self-joins on the message
that is reached so far give each message its root, its depth and the score of its way; a round joins the table
with itself and so doubles the steps, so a path of a million messages takes twenty rounds. The leaves of a tree are
ranked by the mean score of their paths, and the messages of the chosen ones are gathered by way of the same tables,
from the longest step to the shortest. A path is ordered by depth.

Join keys that very many rows share (a root with a third of all replies) are joined apart, broadcast: at most
rows / HOT_ROWS keys can be so frequent.

The template marks a turn's start, role, text and end. A control string in a text gets a backslash behind its first
character, and one more if it has some already; so no text holds a control string, and taking one away gives the
text back. Roles have backslash, line end, < and [ written as backslash and a letter. A conversation is one text,
with the spans of the trained texts (the loss mask) in characters; one of more than PART_TURNS turns comes
in parts of so many, in order, so a task never holds an unbounded conversation.

Null role or text: empty. Null score: 0. A message whose parent is null or in no row is a root; messages in a cycle
have no root and are given back by `unrooted`. Repeated rows of a linear conversation are turns of their own. An
empty text is a turn with nothing in it. Texts are never cut. Other columns are not read. No rows: no rows.
"""

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from parley.llm.common import written
from parley.operators.ranking import top_per_group

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that chat templates and tokenizers act on, each as its first character and the rest. No string's end is
#: another's start, so they never overlap.
CONTROLS = (("<", "|im_start|>"), ("<", "|im_end|>"), ("<", "|endoftext|>"), ("<", "s>"), ("<", "/s>"), ("<", "<SYS>>"), ("<", "</SYS>>"),
            ("[", "INST]"), ("[", "/INST]"))
TRAINED = ("assistant",)
PART_TURNS = 128
HOT_ROWS = 5000
_RESTS = {c: "|".join(re.escape(r) for f, r in CONTROLS if f == c) for c, _ in CONTROLS}
_ESCAPE = "(?:" + "|".join(f"(?<={re.escape(c)})(?=\\\\*(?:{rests}))" for c, rests in _RESTS.items()) + ")"
_UNESCAPE = "(?:" + "|".join(f"(?<={re.escape(c)})\\\\(?=\\\\*(?:{rests}))" for c, rests in _RESTS.items()) + ")"
_ROLE = {"\\": "\\\\", "\n": "\\n", "<": "\\l", "[": "\\b"}


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"\\")


def escape_role(role: Column) -> Column:
    for c, said in _ROLE.items():
        role = F.replace(role, F.lit(c), F.lit(said))
    return role


def unescape_text(text: str) -> str:
    return re.sub(_UNESCAPE, "", text)


def unescape_role(role: str) -> str:
    back = {said[1]: c for c, said in _ROLE.items()}
    return re.sub(r"\\(.)", lambda m: back[m[1]], role)


# ---- trees and paths ----


def join_hot(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on `key`, which names a row of `right`; both are written tables. Keys of more than 1 / HOT_ROWS of
    the rows of `left` are joined by broadcast; there are HOT_ROWS of them at most. Null keys are not shuffled."""
    limit = max(1000, left.count() // HOT_ROWS)
    named = left.filter(F.col(key).isNotNull())
    hot = [r[0] for r in named.groupBy(key).count().filter(F.col("count") > limit).select(key).collect()]
    rest = left.filter(F.col(key).isNull())
    if hot:
        is_hot = F.col(key).isin(hot)
        rest = rest.unionByName(named.filter(is_hot).join(F.broadcast(right.filter(is_hot)), key, "left"), allowMissingColumns=True)
        named = named.filter(~is_hot)
    return named.join(right, key, "left").unionByName(rest, allowMissingColumns=True)


def linked_turns(turns: DataFrame, order):
    """(links, said) of linear conversations (tree, role, text, and the `order` columns): a turn replies to the one
    before it. links: (tree, node, parent, score); said: (node, role, text). Ties are ordered by role and text.

    The rows without their texts are sorted by range, so a conversation of any length is dealt over tasks; the
    last turn of each range, one row, goes to the next."""
    rows = turns.select("tree", *order, F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # a turn that comes again is another row, and its number deals even these over ranges
    rows = written(rows.withColumn("node", F.monotonically_increasing_id()).withColumn("_same", F.sha2("text", 256)), "chat-turns")
    key = ["tree", *order, "role", "_same", "node"]
    at = [F.col(k).asc_nulls_first() for k in key]
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = written(rows.drop("text").repartitionByRange(n, *at).withColumn("_range", F.spark_partition_id()), "chat-order")
    before = F.lag(F.struct("tree", "node")).over(Window.partitionBy("_range").orderBy(*at))
    last = narrow.groupBy("_range").agg(F.max_by(F.struct("tree", "node"), F.struct(*key)).alias("_end"))
    # one row per range
    ends = last.select(F.lead("_range").over(Window.orderBy("_range")).alias("_range"), "_end").filter("_range is not null")
    x = narrow.withColumn("_before", before).join(F.broadcast(ends), "_range", "left").withColumn("_before", F.coalesce("_before", "_end"))
    parent = F.when(F.col("_before.tree").eqNullSafe(F.col("tree")), F.col("_before.node"))
    links = written(x.select("tree", "node", parent.alias("parent"), F.lit(0.0).alias("score")), "chat-links")
    return links, rows.select("node", "role", "text")


def climb(messages: DataFrame) -> list[DataFrame]:
    """Tables (node, up, steps, total) of written messages (node, parent, score): the message 2^k replies above, or null above the root; how many messages the
    way has so far, itself included; and the sum of their scores. The last one has reached every root."""
    base = messages.select("node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    known = base.select(F.col("node").alias("parent"), F.lit(True).alias("_known"))
    first = join_hot(base, known, "parent")
    up = F.when(F.col("_known"), F.col("parent"))
    tables = [written(first.select("node", up.alias("up"), F.lit(1).cast("long").alias("steps"), F.col("score").alias("total")), "chat-climb")]
    for _ in range(base.count().bit_length()):  # more steps than messages: what is left is in a cycle
        t = tables[-1]
        if not t.filter("up is not null").limit(1).count():
            break
        ahead = t.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("steps").alias("_steps"), F.col("total").alias("_total"))
        x = join_hot(t.filter("up is not null"), ahead, "up").select(
            "node", F.col("_up").alias("up"), (F.col("steps") + F.col("_steps")).alias("steps"), (F.col("total") + F.col("_total")).alias("total"))
        tables.append(written(x.unionByName(t.filter("up is null")), "chat-climb"))
    return tables


def unrooted(tables: list[DataFrame]) -> DataFrame:
    """Messages that reply to themselves by way of others."""
    return tables[-1].filter("up is not null").select("node")


def paths(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """(path, tree, node, place, rank): the messages of the `keep` best paths of every tree (all if None), numbered
    from the root. A path is named by its leaf; the best has the highest mean score, ties go to the smallest leaf.

    messages: (tree, node, parent, score), written; node is unique, tree is that of the leaf."""
    tables = climb(messages)
    whole = tables[-1].filter("up is null")
    inner = messages.select(F.col("parent").alias("node")).filter("node is not null").distinct()
    leaves = messages.select("tree", "node").join(inner, "node", "left_anti").join(whole, "node")
    leaves = leaves.withColumn("_mean", F.col("total") / F.col("steps"))
    ranked = top_per_group(leaves, ["tree"], [F.desc("_mean"), "node"], keep) if keep is not None else leaves.withColumn("rank", F.lit(None).cast("int"))
    chosen = written(ranked.select(F.col("node").alias("path"), "tree", "node", "rank"), "chat-paths")
    for t in reversed(tables[:-1]):
        above = join_hot(chosen, t.select("node", "up"), "node").filter("up is not null").select("path", "tree", F.col("up").alias("node"), "rank")
        chosen = written(chosen.unionByName(above), "chat-paths")
    return join_hot(chosen, whole.select("node", (F.col("steps") - 1).alias("place")), "node").select("path", "tree", "node", "place", "rank")


# ---- the template ----


def formatted(turns: DataFrame, trained=TRAINED) -> DataFrame:
    """(path, tree, part, text, mask) of turns (path, tree, place, role, text): mask has (start, length) of the trained
    texts in `text`, in characters."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    x = turns.select("path", "tree", "place", F.floor(F.col("place") / PART_TURNS).cast("long").alias("part"), role.isin(*trained).alias("_loss"),
                     F.concat(F.lit(START), escape_role(role), F.lit("\n")).alias("_head"), escape_text(text).alias("_body"))
    x = x.withColumn("_turn", F.concat("_head", "_body", F.lit(END + "\n")))
    # a part has PART_TURNS turns at most
    sofar = F.sum(F.length("_turn")).over(Window.partitionBy("path", "part").orderBy("place"))
    x = x.withColumn("_start", sofar - F.length("_turn") + F.length("_head"))
    span = F.when(F.col("_loss"), F.struct(F.col("_start").alias("start"), F.length("_body").cast("long").alias("length")))
    one = F.sort_array(F.collect_list(F.struct("place", F.col("_turn").alias("turn"), span.alias("span"))))
    parts = x.groupBy("path", "part").agg(F.first("tree").alias("tree"), one.alias("_t"))
    spans = F.filter(F.transform("_t", lambda t: t["span"]), lambda s: s.isNotNull())
    return parts.select("path", "tree", "part", F.array_join(F.transform("_t", lambda t: t["turn"]), "").alias("text"), spans.alias("mask"))


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text."""
    turns = []
    for piece in text.split(START)[1:]:
        head, _, body = piece.partition("\n")
        if not body.endswith(END + "\n"):
            raise ValueError("a turn has no end")
        turns.append((unescape_role(head), unescape_text(body[: -len(END) - 1])))
    return turns


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(conversations: DataFrame) -> DataFrame:
    """DIGESTS of formatted conversations, from their texts and masks alone. Parts of a conversation come to a task in
    order and are read one after the other."""

    def close(c):
        return c[0], c[2], c[3].hexdigest(), c[4], c[5].hexdigest(), c[6]

    def frame(rows):
        got = pd.DataFrame(rows, columns=[c.split()[0] for c in DIGESTS.split(", ")])
        got["conv_id"] = pd.array([None if i is None else int(i) for i in got["conv_id"]], "Int64")
        return got

    def run(batches):
        now, rows = None, []
        for b in batches:
            for path, tree, text, starts, lengths in b.itertuples(index=False):
                if now is None or now[1] != path:
                    if now is not None:
                        rows.append(close(now))
                    now = [tree, path, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    now[2] += 1
                    now[3].update(f"{role}\n{said}\n".encode())
                for start, length in zip(starts, lengths):
                    said = unescape_text(text[start: start + length])
                    now[4] += len(said)
                    now[5].update(said.encode())
                now[6] += len(text)
            yield frame(rows)
            rows = []
        if now is not None:
            yield frame([close(now)])

    ordered = conversations.repartition("path").sortWithinPartitions("path", "part")
    pick = lambda c: F.transform("mask", lambda s: s[c])
    # ids as text: a null among them would turn numbers into floats
    return ordered.select("path", F.col("tree").cast("string"), "text", pick("start").alias("starts"), pick("length").alias("lengths")).mapInPandas(run, DIGESTS)


def format_trees(links: DataFrame, said: DataFrame, keep: int | None = 1, trained=TRAINED) -> DataFrame:
    """(path, tree, part, text, mask) of the chosen paths of reply trees: links (tree, node, parent, score) and
    what each message said (node, role, text). Texts meet the chosen paths only."""
    return formatted(paths(links, keep).join(said, "node"), trained)


def format_conversations(turns: DataFrame, trained=TRAINED) -> DataFrame:
    """The same of linear conversations (conv_id, turn, role, text); tree is the conv_id."""
    rows = turns.select(F.col("conv_id").cast("long").alias("tree"), "turn", "role", "text")
    links, said = linked_turns(rows, ["turn"])
    return format_trees(links, said, 1, trained)
