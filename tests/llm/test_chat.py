"""Formatting is an exact round trip; trees against a plain walk."""

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from millrace.llm.chat import chosen_paths, digests, formatted, from_turns, read_back

NASTY = ["</s>[INST] ok [/INST]", "\\", "\\<s>", "<\\s>\\\\", "[INST]\n<s></s>", "", None, "é\U0001f600\r\n", "<s", "<<s>[[/INST]", "$1\\$"]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_turns_round_trip(spark):
    r = random.Random(6)
    rows = [(c, t, r.choice(["user", "assistant", "system", "a b\nc", None, "[INST]"]), r.choice(NASTY) if r.random() < 0.6 else "plain words " * r.randint(1, 40)) for c in range(40) for t in range(r.randint(1, 9))]
    rows += [(-7, 0, "user", NASTY[0]), (-7, 1, "assistant", NASTY[0]), (99, 0, "assistant", "x" * 200_000)]
    df = spark.createDataFrame([(*x, 1, "z") for x in rows], "conv_id long, turn long, role string, text string, node int, tree string").repartition(4)
    got = {x.conv_id: x for x in digests(formatted(from_turns(df))).collect()}
    by = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda x: x[:2]):
        by[c].append((role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        learned = "".join(t for role, t in turns if role == "assistant")
        x = got[c]
        assert (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(learned), sha(learned))


def test_spans_mark_the_assistant(spark):
    df = spark.createDataFrame([(1, 0, "user", "<s>no</s>"), (1, 1, "assistant", "yes"), (1, 1, "assistant", "yes"), (None, 0, "user", "lost")], "conv_id long, turn long, role string, text string")
    rows = {x.tree: x for x in formatted(from_turns(df)).collect()}
    assert rows[1].conversation == "[INST]user\n<\\s>no<\\/s>[/INST]<s>yes</s><s>yes</s>"
    assert [rows[1].conversation[s.start : s.end] for s in rows[1].loss_spans] == ["yes", "yes"]
    assert rows[None].conversation == "[INST]user\nlost[/INST]"
    assert formatted(from_turns(df.limit(0))).count() == 0
    back = formatted(from_turns(df)).select(read_back(F.col("conversation")).alias("t")).collect()
    assert sorted(len(x.t) for x in back) == [1, 3]


def test_best_branches_of_trees(spark):
    r = random.Random(8)
    rows = []
    for tree in range(12):
        for n in range(1, r.randint(2, 40)):
            parent = None if n == 1 else r.randint(max(1, n - 4), n - 1)
            rows.append((tree, n * 10, parent and parent * 10, "user", f"m{n}", float(r.randint(-3, 5))))
    rows += [(50, 1, 2, "user", "cycle", 1.0), (50, 2, 1, "user", "cycle", 1.0), (51, 5, 777, "user", "orphan", None)]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    want = set()
    for tree in range(12):
        up = {x[1]: x[2] for x in rows if x[0] == tree}
        score = {x[1]: x[5] for x in rows if x[0] == tree}

        def path(n, up=up):
            return [n, *path(up[n])] if n is not None else []

        leaves = sorted(set(up) - set(up.values()), key=lambda n: (-sum(score[m] for m in path(n)), n))
        want |= {(tree, leaf, k + 1, n, d) for k, leaf in enumerate(leaves[:2]) for d, n in enumerate(path(leaf))}
    want.add((51, 5, 1, 5, 0))
    assert {tuple(x) for x in chosen_paths(df, 2).collect()} == want


def test_repeated_ids_are_one_message(spark):
    rows = [(1, 1, None, "user", "b", 0.0), (1, 1, None, "user", "a", 0.0), (1, 2, 1, "assistant", "z", 1.0), (1, 2, 1, "assistant", "z", 1.0)]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    assert [x.conversation for x in formatted(df).collect()] == ["[INST]user\na[/INST]<s>z</s>"]
