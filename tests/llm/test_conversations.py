"""Conversation repair against a plain search over edits."""

import random
from collections import defaultdict

import brute
import pytest

from kestrel.llm import conversations as C
from kestrel.llm import queries as Q

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def query_dir(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS conv", "'x' AS key", "2 AS cost", "3 AS n", "4 AS part")
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def check(spark, path):
    rows = spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    by_conv = defaultdict(list)
    for r in rows:
        by_conv[r["conv_id"]].append(tuple(r))
    got = {r["conv_id"]: tuple(r)[1:] for r in Q.op12_conversation_repair(spark, path).collect()}
    assert got.keys() == by_conv.keys()
    for conv, own in by_conv.items():
        assert got[conv] == brute.conversation_repair(own), conv


def test_real_rows(spark):
    check(spark, "/root/testdata/sf0.01")


def test_edge_rows(spark, tmp_path):
    random.seed(3)
    texts = [None, "", "  \n", "Yes.", "No", "Hm! \t", "é?", "Yes.", "x" * 50_000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = [(random.choice([None, *range(40)]), random.choice([None, *range(-3, 12)]), random.choice(roles), random.choice(texts))
            for _ in range(600)]
    rows += rows[:40] + [(77, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(700)]
    rows += [(78, 5, "user", "again.")] * 300 + [(79, t, "user", "again.") for t in range(300)]
    check(spark, query_dir(spark, tmp_path, rows))


def test_empty_table(spark, tmp_path):
    assert Q.op12_conversation_repair(spark, query_dir(spark, tmp_path, [])).collect() == []


def test_one_conversation_over_many_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, query_dir(spark, tmp_path, [(1, t // 2, ("user", "assistant", "system")[t % 3], f"{t % 400}{'.' * (t % 5 > 0)}") for t in range(1500)]))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repaired_rows_follow_the_grammar(spark):
    convs = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = C.damaged(convs)
    found = C.plans(rows)
    out = defaultdict(list)
    for r in C.repaired_rows(rows, found, rows.select("conv").distinct()).collect():
        out[r["conv"]].append((r["pos"], r["role"][0]))
    assert out
    for own in out.values():
        initials = "".join(x for _, x in sorted(own))
        assert initials.lstrip("s") == "ua" * (len(initials.lstrip("s")) // 2) and initials.count("s") <= 1


@pytest.mark.parametrize("seed", range(3))
def test_audits_of_shared_suffixes(seed):
    random.seed(seed)
    strings = {"".join(random.choice("suaxSUAXd") for _ in range(random.randint(0, 9))) for _ in range(400)}
    ordered = sorted(strings, key=lambda s: s[::-1])
    whole = list(C.audits(ordered))
    assert whole == [next(C.audits([s])) for s in ordered]
    for string, (cost, audit) in zip(ordered, whole):
        rows = [(0, {"s": "system", "u": "user", "a": "assistant", "x": "tool", "d": "user"}[c.lower()], c) for c in string]
        paid = sum({"K": 0, "R": 2, "D": 3, "I": 2}[e] for e in audit)
        kept = [e for e in audit if e != "I"]
        assert len(kept) == len(rows) and cost == paid + sum(c.isupper() and e != "D" for c, e in zip(string, kept))
