import time

import pytest
from pyspark.sql import functions as F

from quillmesh.functions import models as m
from quillmesh.operators import calls


def test_echo_scripted_rule():
    assert m.EchoModel().complete("x").text == "Mock response to: x"
    s = m.ScriptedModel(["a", "b"])
    assert [s.complete("").text, s.complete("").text] == ["a", "b"]
    with pytest.raises(IndexError):
        s.complete("")
    assert m.get_model("rule", rule=str.upper).complete("x").text == "X"
    assert m.EchoModel().complete([{"role": "user"}] * 100).text == "Mock response to: " + str([{"role": "user"}] * 100)[:80]


def test_get_model_errors():
    with pytest.raises(ValueError, match="unknown kind"):
        m.get_model("nothing")
    with pytest.raises(ValueError, match="base_url"):
        m.get_model("vllm", name="x")
    settings = {"name": "x"}
    m.get_model("openrouter", **settings)
    assert settings == {"name": "x"}


def test_prompts_and_arguments():
    assert m.normalise_prompt("hi") == [{"role": "user", "content": "hi"}]
    with pytest.raises(ValueError):
        m.normalise_prompt(3)
    got = m.sampling_arguments({"max_tokens": 5, "top_p": None, "extra_body": {"a": 1}}, {"b": 2})
    assert got == {"max_completion_tokens": 5, "extra_body": {"a": 1, "b": 2}}


def test_costs():
    assert m.reported_cost({"cost": 0, "extra": {"cost": 0.5}}) == 0.5
    assert m.reported_cost({"cost_details": {"upstream_inference_cost": 1}}) == 1.0
    assert m.reported_cost({}) is None
    assert m.Usage(1, 2, 3).plus(m.Usage(1, 1, 1, 0.5)) == m.Usage(2, 3, 4, 0.5)


def test_calls_keep_order_and_errors(spark):
    df = spark.createDataFrame([(1, ["a", "bad", "c"]), (2, []), (1, ["a", "bad", "c"])], "k int, prompts array<string>")
    got = calls.lm_map_batched(df, settings={"fail_on": "bad"}).orderBy("k").collect()
    assert [len(r["responses"]) for r in got] == [3, 3, 0]
    assert got[0]["responses"][1] == "Error: llm() call failed - refused: bad"
    assert got[0]["responses"][2] == "Mock response to: c"
    assert [r["n_failed"] for r in got] == [1, 1, 0]


def test_empty_and_null_prompts(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "prompt string")
    got = {r["prompt"]: r for r in calls.lm_map(df).collect()}
    assert got[""]["error"] == calls.EMPTY_REQUEST and got[None]["response"].startswith("Error: ")
    assert got["x"]["error"] is None


def test_calls_run_side_by_side(spark):
    df = spark.range(16).select(F.col("id").cast("string").alias("prompt")).coalesce(1)
    calls.lm_map(df.limit(1)).collect()
    began = time.time()
    assert calls.lm_map(df, settings={"delay": 0.3}, in_flight=16).count() == 16
    assert time.time() - began < 3.0
