"""Chat formatting as a prefix tree: turns that conversations share at their start are written once.

A node stands for a conversation's first turns up to some depth; its key is the exclusive or of the hashes of those turns,
each with its place, so that equal beginnings have equal keys. Nodes are laid out depth first in one sequence of tokens.
A node carries its place in that sequence, the position of its first token in its own conversation, the intervals of the
sequence its tokens attend to besides themselves (its ancestors; neighbours are merged), and the part that counts in the loss.

Depth-first order needs no walk: conversations in the order of their paths visit the nodes depth first, so a node belongs to
the first conversation that holds it, and nodes are ordered by that conversation's rank and their depth. No tree and no
node's conversations are ever gathered in one place; a conversation's own turns are.

The nodes of one owner are a chain that stands in one piece. What a node sees is therefore the chain before it and, the same
for all nodes of the chain, one interval of each owner further up the path. Ranks, numbers and intervals are found with keys
and lengths only; texts are stored once as they come, combined by node key before they are shuffled, and joined at the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costgauge.llm.rows import checkpointed, quoted, ranked, running_total, stored, text_of

# The template. "&", "<" and, in roles, ">" are written as references, so no text can hold a control string.
HEAD, HEAD_END, TAIL = "<turn ", ">", "</turn>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(text: Column) -> Column:
    """What escaped() was given; references are read back in the opposite order."""
    plain = F.replace(F.replace(text, F.lit("&gt;"), F.lit(">")), F.lit("&lt;"), F.lit("<"))
    return F.replace(plain, F.lit("&amp;"), F.lit("&"))


def head(role: Column) -> Column:
    return F.concat(F.lit(HEAD), F.replace(escaped(role), F.lit(">"), F.lit("&gt;")), F.lit(HEAD_END))


def formatted(role: Column, text: Column) -> Column:
    return F.concat(head(role), escaped(text), F.lit(TAIL))


def keyed_turns(
    turns: DataFrame, n_tokens: Callable[[Column], Column], *, conv_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """Each turn with its depth (from 1), the key of its node, its tokens and their position in the conversation."""
    rows = turns.select(
        quoted(conv_col).alias("conv"),
        quoted(turn_col).alias("turn"),
        text_of(quoted(role_col)).alias("role"),
        text_of(quoted(text_col)).alias("text"),
    )
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    sized = rows.withColumn("depth", F.row_number().over(order)).withColumn(
        "tokens", n_tokens(formatted(F.col("role"), F.col("text"))).cast("long")
    )
    hashed = sized.withColumns(
        {f"h{i}": F.xxhash64(F.lit(i), F.col("depth"), F.char_length("role"), F.col("role"), F.col("text")) for i in (1, 2)}
    )
    return hashed.withColumns(
        {f"k{i}": F.bit_xor(f"h{i}").over(so_far) for i in (1, 2)}
        | {"position": F.sum("tokens").over(so_far) - F.col("tokens")}
    ).drop("h1", "h2", "turn")


def build(
    turns: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_role: str = "assistant",
    n_tokens: Callable[[Column], Column] = F.char_length,
) -> tuple[DataFrame, DataFrame]:
    """The tree's nodes, and the nodes of each conversation.

    Nodes: node (from 0, depth first), parent (null at a root), depth, formatted (the turn's text under the template),
    start and end (its tokens in the sequence), position (of its first token in its conversation), attends
    array<struct<start, end>> (its ancestors), loss_from and loss_to (code points of `formatted` that count in the loss, null
    if none do), conversations (how many hold it). Conversations: conv, depth, node.

    A conversation's turns are in the order of turn (null first), role, text; turns that repeat whole are turns of their own.
    Null roles and texts are empty; rows without a conversation id are one conversation. Tokens are code points unless
    n_tokens says how many a formatted turn has.
    """
    keyed = keyed_turns(turns, n_tokens, conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col)
    rows = stored(keyed, "chat-turns")
    step = F.struct("depth", "k1", "k2", "tokens", "position")
    paths = rows.groupBy("conv").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    rank = ranked(paths, ["steps", "conv"], "rank")
    on_path = checkpointed(rank.select("conv", "rank", F.inline("steps")))
    distinct = on_path.groupBy("k1", "k2").agg(
        F.min("rank").alias("owner"),
        F.count(F.lit(1)).alias("conversations"),
        *[F.first(c).alias(c) for c in ("depth", "tokens", "position")],
    )
    numbered = ranked(distinct, ["owner", "depth"], "node")
    total = running_total(numbered, ["node"], "tokens", "start").withColumn("end", F.col("start") + F.col("tokens"))
    nodes = checkpointed(total.drop("tokens"))
    # Which nodes a conversation holds. A node that many share is one row on the other side of a join whose large side splits.
    places = nodes.select(F.col("k1").alias("n1"), F.col("k2").alias("n2"), "node", "start", "end", "owner")
    steps = on_path.select("conv", "rank", "depth", "k1", "k2")
    held = steps.join(places, (F.col("k1") == F.col("n1")) & (F.col("k2") == F.col("n2"))).drop("k1", "k2", "n1", "n2")
    held = checkpointed(held)
    placed = nodes.join(_chains(held), "owner")
    begins = F.col("chain_start")
    own = F.filter(F.array(F.struct(begins.alias("start"), F.col("start").alias("end"))), lambda x: x["start"] < x["end"])
    placed = placed.select(
        F.col("k1").alias("n1"),
        F.col("k2").alias("n2"),
        "node",
        F.when(F.col("node") > F.col("chain_node"), F.col("node") - 1).otherwise(F.col("above_node")).alias("parent"),
        "depth",
        "start",
        "end",
        "position",
        _merged(F.concat("above", own)).alias("attends"),
        "conversations",
    )
    texts = rows.groupBy("k1", "k2").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    line, is_loss = formatted(F.col("role"), F.col("text")), F.col("role") == loss_role
    result = placed.join(texts, (F.col("k1") == F.col("n1")) & (F.col("k2") == F.col("n2"))).select(
        "node",
        "parent",
        "depth",
        line.alias("formatted"),
        "start",
        "end",
        "position",
        "attends",
        F.when(is_loss, F.char_length(head(F.col("role")))).alias("loss_from"),
        F.when(is_loss, F.char_length(line) - len(TAIL)).alias("loss_to"),
        "conversations",
    )
    return result, held.select("conv", "depth", "node")


def _chains(held: DataFrame) -> DataFrame:
    """Each owner's chain: chain_node and chain_start (where it begins), above (the intervals of the owners further up its
    path, in order, empty ones left out), above_node (the node it hangs from, null at a root).

    On a path each owner has one interval, combined before the shuffle, so a row holds as many as the path has branches, not
    as many as it has turns.
    """
    parts = held.groupBy("rank", "owner").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("node").alias("first"), F.max("node").alias("last")
    )
    is_own = F.col("owner") == F.col("rank")
    further_up = F.when(~is_own & (F.col("start") < F.col("end")), F.struct("start", "end"))
    chains = parts.groupBy("rank").agg(
        F.min(F.when(is_own, F.col("first"))).alias("chain_node"),
        F.min(F.when(is_own, F.col("start"))).alias("chain_start"),
        F.max(F.when(~is_own, F.col("last"))).alias("above_node"),
        F.array_sort(F.collect_list(further_up)).alias("above"),
    )
    return chains.where(F.col("chain_node").isNotNull()).withColumnRenamed("rank", "owner")


def _merged(intervals: Column) -> Column:
    """Intervals in order, neighbours that touch made one."""
    starts = F.filter(intervals, lambda x, i: (i == 0) | (F.get(intervals, i - 1)["end"] != x["start"]))
    ends = F.filter(
        intervals, lambda x, i: (i == F.size(intervals) - 1) | (F.get(intervals, i + 1)["start"] != x["end"])
    )
    return F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")),
        lambda x: F.struct(x["a"]["start"].alias("start"), x["b"]["end"].alias("end")),
    )


def read_back(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Each conversation from the tree: conv, turns array<struct<depth, role, text, loss, n_chars>>.

    role and text are parsed out of the formatted turn and unescaped; loss is the unescaped text under the loss mask.
    """
    lines = nodes.select(F.col("node").alias("_node"), "formatted", "loss_from", "loss_to")
    joined = conversations.join(lines, F.col("node") == F.col("_node"))
    turn = F.struct("depth", "formatted", "loss_from", "loss_to")
    whole = joined.groupBy("conv").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return whole.select("conv", F.transform("turns", _parsed).alias("turns"))


def _parsed(turn: Column) -> Column:
    """A formatted turn taken apart, after the shuffle, so that a text under the mask does not travel twice."""
    line = turn["formatted"]
    at = F.instr(line, HEAD_END)
    begins, ends = turn["loss_from"], turn["loss_to"]
    return F.struct(
        turn["depth"].alias("depth"),
        unescaped(F.substring(line, F.lit(len(HEAD) + 1), at - len(HEAD) - 1)).alias("role"),
        unescaped(F.substring(line, at + 1, F.char_length(line) - at - len(TAIL))).alias("text"),
        unescaped(F.substring(line, begins + 1, ends - begins)).alias("loss"),
        F.char_length(line).cast("long").alias("n_chars"),
    )
