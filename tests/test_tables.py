import datetime
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmesh import scratch
from quillmesh.functions import messages as M
from quillmesh.functions import scoring as Q
from quillmesh.operators import chunking, usage
from quillmesh.operators.trajectory import answer_text, call_tree
from quillmesh.sources import context, logs
from quillmesh.streaming import logs as stream


def test_payloads(spark):
    meta = lambda p: context.metadata(context.load_payload(spark, p)).first()
    assert meta("Hello, world!")["context_lengths"] == [13]
    got = meta({"a": "xy", "b": [1, 2]})
    assert (got["context_type"], got["context_lengths"]) == ("dict", [2, 6])
    assert meta([{"content": "abc"}, {"role": "x"}])["context_lengths"] == [3, 0]
    assert meta([{"a": "é"}])["context_lengths"] == [len('{"a": "\\u00e9"}')]
    for bad, error in ((3, ValueError), ([1], TypeError)):
        with pytest.raises(error):
            context.payload_rows(bad)


def test_json_length(spark):
    df = spark.createDataFrame([('{"a":"é","b":[1,2]}',)], "j string")
    assert df.select(context.json_length("j")).first()[0] == len('{"a": "\\u00e9", "b": [1, 2]}')


def test_slices_with_few_items(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b")], "k string, pos int, text string")
    got = chunking.n_slices(df, "k", "pos", 5).collect()
    assert [(r["slice_no"], r["slice"]) for r in got] == [(4, "a\nb")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=30))
def test_greedy_packs(spark, sizes):
    df = spark.createDataFrame([("k", i, "x" * n) for i, n in enumerate(sizes)], "k string, pos int, text string")
    got = [r["pack_no"] for r in chunking.pack_greedy(df, "k", "pos", 40).orderBy("pos").collect()]
    want, pack, used = [], 0, 0
    for n in sizes:
        if used and used + n > 40:
            pack, used = pack + 1, 0
        used += n
        want.append(pack)
    assert got == want


def test_scores(spark):
    rows = [
        ("['cat']", "", "Answer: Cat", 1.0),
        ("[7]", Q.NUMERIC, "Answer: 9", 0.75**2),
        ("[7]", Q.NUMERIC, "Answer: many", 0.0),
        ("[datetime.date(2024, 3, 1)]", Q.DATE, "Answer: 2024-03-01", 1.0),
        ("[datetime.date(2024, 3, 1)]", Q.DATE, "Answer: 2024-03-02", 0.0),
        ("['more common than']", "", "it is less common than that", 0.0),
        ("['dog']", "", "what I found out after a long look: it was the big dog of them", 1.0),
        ("['dog']", "", "none", 0.0),
    ]
    df = spark.createDataFrame(rows, "gold string, kind string, output string, want double")
    for r in df.withColumn("got", Q.score(F.col("gold"), F.col("kind"), F.col("output"))).collect():
        assert r["got"] == pytest.approx(r["want"]), r


def test_escapes_and_answers(spark):
    df = spark.createDataFrame([("\x1b[31mred\x1b[0m \x1b]0;t\x07x", '["final", "yes"]')], "t string, a string")
    got = df.select(M.without_escapes(F.col("t")).alias("t"), answer_text(F.col("a")).alias("a")).first()
    assert got["t"] == "red x" and got["a"] == "yes"


def test_context_limit(spark):
    df = spark.createDataFrame([("@openai/gpt-4o-mini",), ("",), (None,), ("gpt-4",)], "m string")
    assert [r[0] for r in df.select(usage.context_limit(F.col("m"))).collect()] == [128_000, 128_000, 128_000, 8_192]


def test_bad_log_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"type":"metadata","root_model":"m","timestamp":"2024-01-01T00:00:00"}\nnot json\n\n{"iteration":1,"response":"r","code_blocks":[],"timestamp":"2024-01-01T00:10:00"}\n')
    lines = logs.read_log(spark, str(tmp_path))
    assert lines.count() == 2
    got = logs.trajectories(lines).first()
    assert got["root_model"] == "m" and got["max_depth"] is None and len(got["iterations"]) == 1


def test_stream_equals_batch(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.jsonl").write_text("".join(f'{{"iteration":{i},"response":"r","iteration_time":0.5,"code_blocks":[{{"code":"x"}}],"timestamp":"2024-01-01T0{i}:10:00"}}\n' for i in range(1, 6)))
    rolled = stream.run_rollup(stream.read_stream(spark, str(tmp_path), 1))
    got = []
    q = rolled.writeStream.outputMode("complete").foreachBatch(lambda b, n: (got.clear(), got.extend(b.collect()))).option("checkpointLocation", scratch.new_path(spark, "t")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert len(got) == 15 and all(r["n_iterations"] == 1 and r["n_blocks"] == 1 and r["total_time"] == 0.5 for r in got)


def test_activity_sessions(spark):
    at = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    df = spark.createDataFrame([("a", at(0)), ("a", at(10)), ("a", at(50))], "k string, ts timestamp")
    assert sorted(r["n_events"] for r in stream.activity_sessions(df, "k", "ts").collect()) == [1, 2]


def test_scratch(spark):
    t = scratch.table(spark.range(3).toDF("x"), "t")
    assert scratch.shared_dir(spark) in t.inputFiles()[0]
    assert scratch.table(spark.range(0).toDF("x"), "t").count() == 0
    located = scratch.with_row_locator(t.filter("x > 0").withColumn("y", F.lit(1)).groupBy("x").agg(F.max("y").alias("y")))
    assert located.select("__qm_row").distinct().count() == 2


def _tree(spark, rows):
    got = call_tree(spark, spark.createDataFrame(rows, "call_id bigint, parent_call_id bigint"))
    assert got.columns == ["call_id", "parent_call_id", "root_call_id", "depth"]
    return sorted(map(repr, map(tuple, got.collect())))


def _tree_sql(rows):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE c (call_id BIGINT, parent_call_id BIGINT)")
    con.executemany("INSERT INTO c VALUES (?, ?)", rows)
    sql = """WITH RECURSIVE t(call_id, parent_call_id, root_call_id, depth) AS (SELECT call_id, parent_call_id, call_id, 0 FROM c WHERE parent_call_id IS NULL
        UNION ALL SELECT c.call_id, c.parent_call_id, t.root_call_id, t.depth + 1 FROM c JOIN t ON c.parent_call_id = t.call_id) FROM t"""
    return sorted(map(repr, con.sql(sql).fetchall()))


def test_call_tree_beyond_a_million_calls(spark):
    calls = spark.range(1_100_000).selectExpr("id AS call_id", "CASE WHEN id % 2 = 1 THEN id - 1 END AS parent_call_id")
    got = call_tree(spark, calls).groupBy("depth").agg(F.count("*").alias("n"), F.sum("root_call_id").alias("roots"))
    assert sorted(map(tuple, got.collect())) == [(0, 550_000, 550_000 * 549_999), (1, 550_000, 550_000 * 549_999)]


def test_call_tree_of_a_long_chain(spark):
    got = _tree(spark, [(0, None)] + [(i, i - 1) for i in range(1, 700)])
    assert got == sorted(repr((i, i - 1 if i else None, 0, i)) for i in range(700))


@pytest.mark.parametrize(
    "rows",
    [
        [(1, None)],
        [(1, 2), (2, 1), (3, 3)],  # circles alone
        [(1, None), (2, 1), (3, 2), (4, 2), (5, 4), (6, 99), (7, 6), (8, 9), (9, 8), (10, 9), (None, 3), (None, None), (None, 77), (11, None)],
        [(1, None), (1, None), (2, 1), (2, 1), (3, 2), (4, 3), (4, 1), (5, 4), (6, 6), (6, 6), (7, 6), (None, 5)],  # repeated ids
    ],
)
def test_call_tree_equals_sql(spark, rows):
    assert _tree(spark, rows) == _tree_sql(rows)


def test_call_tree_of_random_parents(spark):
    draw = random.Random(3)
    once = [(i, draw.choice([None, i - 1, i - 1, draw.randrange(-3, 60)])) for i in range(60)]
    twice = [(draw.randrange(i - i % 2, i + 1), draw.choice([None, i - 2, i - 3])) for i in range(24)]  # parents come before
    for rows in (once, twice):
        assert _tree(spark, rows) == _tree_sql(rows)


@pytest.mark.parametrize("rows", [[(1, None), (1, 1)], [(0, None), (1, 0), (2, 1), (1, 3), (3, 2), (4, 3)]])
def test_call_tree_below_a_circle(spark, rows):
    with pytest.raises(ValueError, match="among its own parents"):
        _tree(spark, rows)
