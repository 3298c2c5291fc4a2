"""Conversations from reply trees, formatted with a reversible template and a loss mask.

A message names the one it answers. *Iterative self-joins* find all ways from a
root to a leaf: joining the table of ancestors with itself doubles their
distance each round, so ``log2(depth)`` joins know every message's root and the
score of its way. The branches of a tree are ranked by score, and the chosen
leaves then walk the same tables back, from the farthest ancestors to the
nearest, which lists every message of a chosen way once. No message ever holds
its whole way, so a very long chain costs no more than as many short ones.

Only DataFrame functions run here. A formatted conversation is one value, so
it has to fit one row (2 GB).

Template: each turn stands between marks, one blank inside each::

    [SYS] text [/SYS]      system
    [INST] text [/INST]    user
    <s> text </s>          assistant, the text under the loss mask
    [ROLE] role [TEXT] text [/TEXT]    any other role

A mark inside a text or role gets a backslash behind its bracket, and one that
has backslashes there already gets one more; taking one away restores it.

Odd rows: a null text or role counts as empty, a null score as 0. Of rows with
one id the one with the highest score counts, then the least text and role. A
message that answers none, itself or an absent one is a root; messages whose
way up never ends (a ring) belong to no branch. Null ids are left out. No
messages give no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..store import settled

# The marks of turns by role.
MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
OTHER_ROLE, OTHER_TEXT, OTHER_END = "[ROLE] ", " [TEXT] ", " [/TEXT]"
LEARNT = "assistant"

_NAMES = r"(/?(?:INST|SYS|ROLE|TEXT)\]|/?s>)"
_TURN = r"(?s)(?:\[SYS\]|\[INST\]|<s>|\[ROLE\]) .*? (?:\[/SYS\]|\[/INST\]|</s>|\[/TEXT\])"


def escaped(text: Column) -> Column:
    """``text`` with no mark of the template left in it."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + _NAMES, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    """The text that ``escaped`` made this of."""
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _NAMES, "$1$2$3")


# --- reply trees ----------------------------------------------------------------------


def chained(rows: DataFrame, conversation: str, order: list[str]) -> DataFrame:
    """Messages of plain conversations: each answers the one before it in ``order``.

    ``rows`` have ``role`` and ``text`` besides. Rows alike in ``order`` follow
    by role and text, so repeated rows are repeated turns.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    turns = rows.select(F.col(conversation).alias("conversation"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(order)],
                        role.alias("role"), text.alias("text"))
    window = Window.partitionBy("conversation").orderBy(*[f"_{i}" for i in range(len(order))], "role", "text")
    place = F.row_number().over(window)
    numbered = turns.withColumn("_place", place)
    return numbered.select(
        F.struct("conversation", F.col("_place").alias("place")).alias("id"),
        F.when(F.col("_place") > 1, F.struct("conversation", (F.col("_place") - 1).alias("place"))).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"))


def _nodes(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links, one per id, whose ``parent`` is null unless it is another message; and the texts."""
    score = F.coalesce(F.col("score").cast("double"), F.lit(0.0))
    best = F.min(F.struct((-score).alias("_loss"), F.coalesce("text", F.lit("")).alias("text"),
                          F.coalesce("role", F.lit("")).alias("role"), "parent"))
    nodes = messages.where(F.col("id").isNotNull()).groupBy("id").agg(best.alias("_best"))
    nodes = settled(nodes.select("id", "_best.parent", "_best.role", "_best.text", (-F.col("_best._loss")).alias("score")))
    known = nodes.select(F.col("id").alias("parent"))
    answers = nodes.select("id", "parent", "score").where(F.col("parent") != F.col("id")).join(known, "parent", "left_semi")
    others = nodes.join(answers, "id", "left_anti").select("id", F.lit(None).cast(answers.schema["parent"].dataType).alias("parent"), "score")
    return settled(answers.select("id", "parent", "score").unionByName(others)), nodes.select("id", "role", "text")


def _ancestors(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables ``id, up`` of the ancestors 1, 2, 4, ... steps up, and each node's root, length and score of its way."""
    count = nodes.count()
    at = nodes.select("id", F.col("parent").alias("up"), F.coalesce("parent", "id").alias("root"), F.lit(1).cast("long").alias("length"), "score")
    levels: list[DataFrame] = []
    # A way has no more messages than there are; what still climbs after that runs in a ring.
    while (1 << len(levels)) <= count:
        climbing = at.where(F.col("up").isNotNull())
        if climbing.isEmpty():
            break
        levels.append(climbing.select("id", "up"))
        above = at.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("root").alias("_root"),
                          F.col("length").alias("_length"), F.col("score").alias("_score"))
        climbed = climbing.join(above, "up").select(
            "id", F.col("_up").alias("up"), F.col("_root").alias("root"),
            (F.col("length") + F.col("_length")).alias("length"), (F.col("score") + F.col("_score")).alias("score"))
        at = settled(climbed.unionByName(at.where(F.col("up").isNull())))
    return levels, at.where(F.col("up").isNull()).drop("up")


def branches(messages: DataFrame, best: int = 1) -> DataFrame:
    """Messages of the ``best`` highest-scored branches of every tree.

    ``messages`` have ``id, parent, role, text, score``. A branch is the way
    from a root to a message without answers; its score is the sum of its
    messages' scores, equal ones go to the least leaf. Output: ``root, branch``
    (from 1), ``branch_score, place`` (from 0), ``role, text``.
    """
    nodes, texts = _nodes(messages)
    levels, ways = _ancestors(nodes)
    answered = nodes.select(F.col("parent").alias("id")).distinct()
    leaves = ways.join(answered, "id", "left_anti")
    rank = F.row_number().over(Window.partitionBy("root").orderBy(F.desc("score"), "id"))
    chosen = leaves.withColumn("branch", rank).where(F.col("branch") <= best)
    path = settled(chosen.select("root", "branch", F.col("score").alias("branch_score"), "id",
                                 (F.col("length") - 1).alias("place")))
    # From the farthest step to the nearest: each ancestor is reached in one way.
    for k in reversed(range(len(levels))):
        higher = path.join(levels[k], "id").select("root", "branch", "branch_score", F.col("up").alias("id"),
                                                   (F.col("place") - (1 << k)).alias("place"))
        path = settled(path.unionByName(higher))
    return path.join(texts, "id").select("root", "branch", "branch_score", "place", "role", "text")


# --- template -------------------------------------------------------------------------


def _by_role(role: Column, values: dict[str, Column], other: Column) -> Column:
    for name, value in values.items():
        other = F.when(role == name, value).otherwise(other)
    return other


def format_branches(paths: DataFrame) -> DataFrame:
    """One row per branch: ``root, branch, branch_score, formatted, turns``.

    ``turns`` is the loss mask, one entry for each turn: ``at``, where the turn
    starts in ``formatted``, and ``loss_from, loss_upto``, the code points to
    learn (none where both are equal).
    """
    role = F.col("role")
    head = _by_role(role, {r: F.lit(m[0]) for r, m in MARKS.items()},
                    F.concat(F.lit(OTHER_ROLE), escaped(role), F.lit(OTHER_TEXT)))
    tail = _by_role(role, {r: F.lit(m[1]) for r, m in MARKS.items()}, F.lit(OTHER_END))
    pieces = paths.select("root", "branch", "branch_score", "place", (role == LEARNT).alias("learnt"),
                          head.alias("head"), escaped(F.col("text")).alias("body"), tail.alias("tail"))
    pieces = pieces.withColumn("piece", F.concat("head", "body", "tail"))
    so_far = Window.partitionBy("root", "branch").orderBy("place")
    at = F.sum(F.char_length("piece").cast("long")).over(so_far) - F.char_length("piece")
    first = F.col("at") + F.char_length("head")
    size = F.when(F.col("learnt"), F.char_length("body")).otherwise(0)
    turn = F.struct("place", "piece", F.struct("at", first.alias("loss_from"), (first + size).alias("loss_upto")).alias("turn"))
    whole = pieces.withColumn("at", at).groupBy("root", "branch").agg(
        F.first("branch_score").alias("branch_score"), F.sort_array(F.collect_list(turn)).alias("_turns"))
    return whole.select("root", "branch", "branch_score",
                        F.array_join(F.transform("_turns", lambda t: t["piece"]), "").alias("formatted"),
                        F.transform("_turns", lambda t: t["turn"]).alias("turns"))


def _read_turn(turn: Column) -> Column:
    body = F.substring_index(turn, OTHER_TEXT, 1)
    role, text = F.substring(body, len(OTHER_ROLE) + 1, 2**31 - 1), F.substring(turn, F.char_length(body) + len(OTHER_TEXT) + 1, F.char_length(turn))
    text = F.substring(text, F.lit(1), F.char_length(text) - len(OTHER_END))
    read = F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))
    for name, (head, tail) in MARKS.items():
        inside = F.substring(turn, F.lit(len(head) + 1), F.char_length(turn) - len(head) - len(tail))
        read = F.when(F.startswith(turn, F.lit(head)), F.struct(F.lit(name).alias("role"), unescaped(inside).alias("text"))).otherwise(read)
    return read


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds what the formatted text alone says: ``read`` (role and text per turn) and ``learnt`` (texts under the mask)."""
    pieces = F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(0))
    # A turn's own text is cut out of its own piece, so that long conversations are read once.
    masked = F.transform(F.arrays_zip(F.col("_pieces").alias("piece"), F.col("turns").alias("turn")), lambda x: F.substring(
        x["piece"], (x["turn"]["loss_from"] - x["turn"]["at"] + 1).cast("int"), (x["turn"]["loss_upto"] - x["turn"]["loss_from"]).cast("int")))
    return formatted.withColumn("_pieces", pieces).withColumn("read", F.transform("_pieces", _read_turn)).withColumn(
        "learnt", F.transform(masked, unescaped)).drop("_pieces")
