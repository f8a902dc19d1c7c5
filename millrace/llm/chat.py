"""Reply trees to formatted conversations.

Messages form trees by their parents. Iterative self-joins double the distance to an ancestor in each
round, so a tree of depth d takes log2(d) rounds: the first pass gives every message the sum of the
scores up to its root, which ranks the branches; the second lists the messages of each chosen
root-to-leaf path. Each path is formatted as one conversation.

Template: an assistant turn is `<s>text</s>`, any other `[INST]role` line end `text[/INST]` with a
URL-encoded role. Inside texts backslashes are doubled and one is put into each control string, so no
text can open or close a turn, and removing them again is exact. loss_spans are the places of
assistant texts (code points, end exclusive) in the formatted conversation.

Edge cases: null text and null role are empty; a message whose parent is not there is a root; messages
on a cycle reach no root and are left out; equal scores are ranked by id; of rows with the same id in a
tree the least by parent, role and text stands for them (from_turns numbers rows itself, so repeated
turns stay); very long texts are kept whole; an empty table gives an empty table. One conversation is one
value and so has to fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import cut

CONTROL = r"(<|\[)(?=/?s>|/?INST\])"
TURN = r"(?s)\[INST\](.*?)\n(.*?)\[/INST\]|<s>(.*?)</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def from_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Linear conversations as trees: each row replies to the one before it by turn."""
    c = conversations
    rows = c.select(c[conv_col].cast("long").alias("tree"), c[turn_col].alias("turn"), F.coalesce(c[role_col], F.lit("")).alias("role"), F.coalesce(c[text_col], F.lit("")).alias("text"))
    node = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    rows = rows.withColumn("node", node)
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _same_tree(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def jump_tables(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables (tree, node, up): the ancestor 2^k above; and (tree, node, total) for nodes that reach a root."""
    ids = messages.select(F.col("tree").alias("t2"), F.col("node").alias("n2"))
    base = messages.join(ids, _same_tree("tree", "t2") & (F.col("parent") == F.col("n2")), "left")
    now = cut(base.select("tree", "node", F.col("n2").alias("up"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total")), "jumps")
    tables, rows = [], messages.count()
    while 2 ** len(tables) <= 2 * rows:
        active, ended = now.filter("up is not null"), now.filter("up is null")
        if active.isEmpty():
            break
        tables.append(active.select("tree", "node", "up"))
        over = now.select(F.col("tree").alias("t2"), F.col("node").alias("n2"), F.col("up").alias("up2"), F.col("total").alias("more"))
        step = active.join(over, _same_tree("tree", "t2") & (F.col("up") == F.col("n2")))
        now = cut(step.select("tree", "node", F.col("up2").alias("up"), (F.col("total") + F.col("more")).alias("total")).union(ended), "jumps")
    return tables, now.filter("up is null").select("tree", "node", "total")


def chosen_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """tree, leaf, rank, node and dist (from the leaf) of the best branches of each tree."""
    jumps, totals = jump_tables(messages)
    parents = messages.filter("parent is not null").select(F.col("tree").alias("t2"), F.col("parent").alias("n2")).distinct()
    leaves = totals.join(parents, _same_tree("tree", "t2") & (F.col("node") == F.col("n2")), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "node"))
    paths = leaves.withColumn("rank", rank).filter(F.col("rank") <= branches).select("tree", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("long").alias("dist"))
    for k, table in enumerate(jumps):
        above = table.select(F.col("tree").alias("t2"), F.col("node").alias("n2"), "up")
        further = paths.join(above, _same_tree("tree", "t2") & (F.col("node") == F.col("n2"))).select("tree", "leaf", "rank", F.col("up").alias("node"), (F.col("dist") + 2**k).alias("dist"))
        paths = cut(paths.union(further), "paths")
    return paths


def formatted(messages: DataFrame, branches: int = 1, unique: bool = False) -> DataFrame:
    """tree, leaf, rank, conversation and loss_spans of each chosen path. unique: no id is there twice in a tree."""
    rest = [c for c in messages.columns if c not in ("tree", "node")]
    order = [c for c in ("parent", "role", "text", "score") if c in rest]
    if not unique and not messages.groupBy("tree", "node").count().filter("count > 1").isEmpty():
        messages = messages.groupBy("tree", "node").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("m")).select("tree", "node", "m.*")
    paths = chosen_paths(messages, branches)
    said = messages.select(F.col("tree").alias("t2"), F.col("node").alias("n2"), "role", escape(F.col("text")).alias("safe"))
    turns = paths.join(said, _same_tree("tree", "t2") & (F.col("node") == F.col("n2")))
    own = F.col("role") == "assistant"
    piece = F.when(own, F.concat(F.lit("<s>"), "safe", F.lit("</s>"))).otherwise(F.concat(F.lit("[INST]"), F.url_encode("role"), F.lit("\n"), "safe", F.lit("[/INST]")))
    turns = turns.select("tree", "leaf", "rank", "dist", own.alias("own"), F.length("safe").alias("n"), piece.alias("piece"))
    key = ["tree", "leaf", "rank"]
    so_far = Window.partitionBy(*key).orderBy(F.desc("dist")).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("piece")).over(so_far), F.lit(0)) + 3
    turns = turns.withColumn("span", F.when(F.col("own"), F.struct(start.alias("start"), (start + F.col("n")).alias("end"))))
    turn = F.struct((-F.col("dist")).alias("at"), "piece", "span")
    out = turns.groupBy(*key).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return out.select(*key, F.array_join(F.col("turns.piece"), "").alias("conversation"), F.array_compact("turns.span").alias("loss_spans"))


def read_back(conversation: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""

    def turn(x: Column) -> Column:
        own = F.startswith(x, F.lit("<s>"))
        role = F.when(own, "assistant").otherwise(F.url_decode(F.regexp_extract(x, TURN, 1)))
        return F.struct(role.alias("role"), unescape(F.when(own, F.regexp_extract(x, TURN, 3)).otherwise(F.regexp_extract(x, TURN, 2))).alias("text"))

    return F.transform(F.regexp_extract_all(conversation, F.lit(TURN), F.lit(0)), turn)


def digests(conversations: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations, as counts and digests."""
    rows = conversations.withColumn("turns", read_back(F.col("conversation")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring("conversation", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    rows = rows.withColumn("learned", learned)
    return rows.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("conversation").cast("long").alias("formatted_chars"),
    )
