"""Conversation repair against a search that keeps whole paths."""

from collections import Counter

from pyspark.sql import functions as F

from lakewarden.llm import conversation
from lakewarden.llm.queries import QUERIES
from tests.llm import brute


def test_every_conversation_of_the_odd_table(spark, odd_dir):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{odd_dir}/conversations.parquet").collect()]
    found = QUERIES["op11_conversation_repair"](spark, odd_dir).collect()
    expected = brute.repairs(rows)
    assert len(found) == len(expected)
    assert {r[0]: tuple(r)[1:] for r in found} == expected


def _repaired(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    steps = conversation.repair(df)
    turns = conversation.repaired(steps).orderBy("conv_id", "turn").collect()
    return [tuple(r)[1:] for r in turns], steps.where(F.col("edit").isNull()).first()["cost"]


def test_the_repaired_turns_themselves(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hello?"), (1, 2, "user", "Still there?"), (1, 3, "assistant", "Yes.")]
    turns, cost = _repaired(spark, rows)
    assert cost == 3
    assert turns == [(0, "system", "Be brief."), (1, "user", "Hello?"), (2, "assistant", ""), (3, "user", "Still there?"), (4, "assistant", "Yes.")]


def test_a_conversation_without_rows_is_still_named(spark):
    df = spark.createDataFrame([(4, None, None, None)], "conv_id bigint, turn bigint, role string, text string")
    row = conversation.digests(conversation.repair(df, F.lit(False))).first()
    assert tuple(row)[:8] == (4, 0, 0, 0, 0, 0, 0, "") and row["repaired_sha256"].startswith("e3b0c442")


def _nodes(repairer):
    nodes, todo = 0, [repairer.root]
    while todo:
        node = todo.pop()
        assert node.refs == len(node.children) + sum(node is own for _, own in repairer.survivors.values())
        nodes += 1
        todo += node.children
    return nodes


def test_decided_edits_leave_the_tree():
    repairer, emitted = conversation.Repairer(), 0
    for n in range(20_000):
        must_go = n % 7 in (3, 4)
        emitted += len(repairer.row(("user", "assistant")[n % 2], f"turn {n}.", must_go, False))
        assert _nodes(repairer) < 40
    assert emitted > 10_000


def test_a_run_of_deletions_is_one_node():
    repairer = conversation.Repairer()
    repairer.row("user", "x.", False, False)
    for _ in range(20_000):
        repairer.row("user", "x.", True, False)
        assert _nodes(repairer) < 12
    edits, _ = repairer.finish()
    assert Counter(edit for edit, *_ in edits)["D"] <= 3
