from __future__ import annotations

from checks.compare import connect, differ

from gaugeloom.llm.chat import prefix_hashes, render
from gaugeloom.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F

KIND = "conv_id long, turn long, role string, text string, part long, conv string"


def frame(spark, talks):
    return spark.createDataFrame([(c, t, r, x, 9, "z") for c, rows in talks for t, r, x in rows], KIND)


def said(rows):
    return {(r["conv_id"], r["part"]): (r["n_turns"], r["text"]) for r in rows}


def test_snapshots_and_copies_collapse(spark):
    base = [(k, "user" if k % 2 == 0 else "assistant", f"t{k}") for k in range(6)]
    talks = [(k, base[:k]) for k in range(1, 7)]
    talks += [(20, base), (21, base[:3] + [(3, "assistant", "other")]), (22, base[1:]), (23, base[:2] + [(2, None, "t2")])]
    talks += [(24, base[:2] + [(2, "", "t2")]), (25, [(0, "user", None)]), (26, [(0, "user", "")])]
    got = said(render(frame(spark, talks)).collect())
    assert sorted(c for c, _ in got) == [6, 21, 22, 23, 24, 25, 26]
    assert got[6, 0] == (6, "".join(f"<|{r}|>\n{x}<|end|>\n" for _, r, x in base))
    assert got[25, 0] == got[26, 0] == (1, "<|user|>\n<|end|>\n")


def test_repeats_ties_and_null_turns(spark):
    rows = [(0, "user", "a"), (1, "bot", "b")]
    talks = [(1, rows * 3), (2, rows + [(1, "bot", "c")]), (3, rows + [(None, "bot", "end")]), (None, rows), (4, [(-1, "x", "y")])]
    got = said(render(frame(spark, talks)).collect())
    assert set(got) == {(2, 0), (3, 0), (3, -1), (4, -2)} | ({(1, 0)} - {(1, 0)})  # 1 begins 3
    assert got[2, 0][0] == 3
    assert render(frame(spark, [])).count() == 0


def test_a_tied_turn_is_a_set(spark):
    one = [(0, "u", "a"), (0, "u", "b")]
    got = said(render(frame(spark, [(1, one), (2, one[::-1] + [(1, "u", "c")]), (3, [(0, "u", "a"), (1, "u", "c")])])).collect())
    assert {c for c, _ in got} == {2, 3}


def test_long_conversation_in_blocks(spark):
    """One conversation with most rows: prefixes over several blocks, text in parts."""
    long = [(k, "user", f"text {k}") for k in range(1500)]
    talks = [(9, long), (10, long[:1100]), (11, long[:1100] + [(1100, "user", "else")]), (12, long[:512])]
    got = said(render(frame(spark, talks)).collect())
    assert {c for c, _ in got} == {9, 11}
    text = "".join(got[9, p][1] for p in range(24))
    assert text == "".join(f"<|{r}|>\n{x}<|end|>\n" for _, r, x in long)
    turns = frame(spark, [(1, long[:700]), (2, long[:600])]).select(F.col("conv_id").alias("conv"), "turn", "role", "text")
    prefix = {(r["conv"], r["turn"]): (r["p0"], r["p1"]) for r in prefix_hashes(turns).collect()}
    assert all(prefix[1, k] == prefix[2, k] for k in range(600)) and len(set(prefix.values())) == 700


def test_awkward_conversations_equal_sql(spark, tmp_path):
    base = [(k, "user", f"t{k}" * (k + 1)) for k in range(140)]
    talks = [(1, base), (2, base[:70]), (3, base[:70]), (4, base[:3] + [(2, None, None)]), (5, base[:2] * 2), (6, [(None, None, None)])]
    frame(spark, talks).coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    con = connect_to(tmp_path)
    got = QUERIES["op1_chat_formatting"](spark, str(tmp_path))
    assert differ(got.toPandas(), con.sql(ORACLES["op1_chat_formatting"]).df()) is None


def connect_to(path):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{path}/conversations.parquet/*.parquet'")
    return con


def test_query_equals_sql(spark, small):
    con = connect(small)
    got = QUERIES["op1_chat_formatting"](spark, small)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert differ(got.toPandas(), con.sql(ORACLES["op1_chat_formatting"]).df()) is None
