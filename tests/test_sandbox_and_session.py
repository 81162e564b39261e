import datetime
import time

import pytest

from quillmesh.functions import errors, tools
from quillmesh.functions.sandbox import Sandbox, plain_value
from quillmesh.plans.session import Config, Limits, Session, find_code, iterations, run_inline, run_sessions, turn_history


def box(**kind):
    return Sandbox(**{"query": lambda p, m=None: f"said {p}"} | kind)


def rule(*replies):
    return ("rule", {"rule": lambda prompt: replies[min(sum(x["role"] == "assistant" for x in prompt), len(replies) - 1)]})


DONE = "```repl\nanswer['content'] = 42\nanswer['ready'] = True\n```"


def test_state_and_errors():
    b = box()
    assert b.run("x = 1\nprint(x)").stdout == "1\n"
    failed = b.run("y = 2\nraise ValueError('no')")
    assert failed.stderr.endswith("\nValueError: no") and "y" not in b.locals and b.locals["x"] == 1
    assert b.run("print(SHOW_VARS())").stdout == "{'x': 'int'}\n"
    assert "TypeError" in b.run("eval('1')").stderr


def test_answers():
    b = box()
    got = b.run("answer['content'] = 'a'\nanswer['ready'] = True\nanswer['content'] = 'b'")
    assert got.final_answer == "a"
    assert box().run("answer = {'content': 'c', 'ready': True}").final_answer == "c"
    assert box().run("x = 1").final_answer is None


def test_reserved_names_come_back():
    b = box()
    b.add_context("text")
    b.run("context = 'other'\nllm_query = None")
    assert b.run("print(context, llm_query('q'))").stdout == "text said q\n"


def test_versions():
    b = box()
    assert [b.add_context("a"), b.add_context("b"), b.add_context("c", 5), b.add_context("d")] == [0, 1, 5, 6]
    messages = [{"role": "user", "content": "x"}]
    b.add_history(messages)
    messages[0]["content"] = "changed"
    assert b.run("print(history[0]['content'])").stdout == "x\n"


def test_calls_are_tracked_and_fail_softly():
    def ask(p, m=None):
        if p == "bad":
            raise RuntimeError("down")
        return "ok"

    got = Sandbox(ask).run("print(llm_query_batched(['a', 'bad', 'c']))")
    assert "'Error: llm() call failed - down'" in got.stdout and len(got.calls) == 2


def test_cell_timeout():
    got = box(cell_timeout=0.3).run("while True: pass")
    assert "CellTimeout" in got.stderr and got.seconds < 3


def test_dump_drops_what_does_not_pickle():
    b = box()
    b.run("import threading\nx = [1, 2]\nlock = threading.Lock()\ndef f(): return x")
    c = box()
    c.load(b.dump())
    assert c.locals["x"] == [1, 2] and "lock" not in c.locals and "f" in c.locals


def test_plain_values():
    import json

    assert plain_value((1, {"a": len, 2: json})) == [1, {"a": "<builtin_function_or_method 'len'>", "2": "<module 'json'>"}]
    assert plain_value({3, 1, 2}) == [1, 2, 3] and plain_value(b"a\xff") == "a\\xff" and plain_value([None, True, 1.5]) == [None, True, 1.5]
    assert plain_value(datetime.date(2020, 1, 2)) == "2020-01-02" and plain_value(complex(1, 2)) == "(1+2j)"
    shy = type("Shy", (), {"__repr__": lambda self: 1 / 0})()
    assert plain_value(shy) == "<Shy>"


@pytest.mark.parametrize("name", ["llm_query_batched", "rlm_query_batched"])
def test_batches_run_side_by_side(name):
    def ask(prompt, model=None):
        time.sleep(0.2)
        if prompt == "c":
            raise ValueError("no")
        return f"got {prompt}"

    b = box(query=ask, recurse=ask)
    began = time.monotonic()
    got = b.run(f"r = {name}(['a', 'b', 'c', 'd'])\nprint(r)")
    assert time.monotonic() - began < 0.6
    assert b.locals["r"][:2] == ["got a", "got b"] and b.locals["r"][2].startswith("Error: ") and b.locals["r"][3] == "got d"
    assert [c["prompt"] for c in got.calls] == ["a", "b", "d"]


def test_cells_side_by_side_keep_their_output():
    def child(prompt, model=None):
        one = box()
        for _ in range(20):
            assert one.run(f"print('{prompt}')").stdout == f"{prompt}\n"
        return prompt

    got = box(recurse=child).run("print(rlm_query_batched(['a', 'b', 'c', 'd']))\nimport sys\nprint('err', file=sys.stderr)")
    assert got.stdout == "['a', 'b', 'c', 'd']\n" and got.stderr == "err\n"


SCRIPTS = {
    "content first": ["```repl\nanswer['content'] = 'forty-two'\n```", "```repl\nanswer['ready'] = True\n```"],
    "state": ["```repl\nx = len(context)\n```", "```repl\ny = x + 1\n```", "```repl\nanswer['content'] = y\n```", "```repl\nanswer['ready'] = True\n```"],
    "context changed": ["```repl\ncontext_0 = 'other'\n```", "```repl\nanswer['content'] = context\nanswer['ready'] = True\n```"],
    "no answer": ["```repl\n1/0\n```", "thinking"],
}


@pytest.mark.parametrize("name", SCRIPTS)
def test_inline_equals_distributed(spark, name):
    config = Config(model=rule(*SCRIPTS[name]), limits=Limits(max_turns=4))
    want = run_inline("some text", config)
    for k in (1, 2, 5):
        got = run_sessions(spark.createDataFrame([("some text",)], "context string"), config, turns_a_step=k)
        row = got.first()
        assert (row["final_answer"], row["turn"], row["status"], row["calls"]) == (want.answer, want.turn, want.status, want.usage.calls)
        turns = iterations(got, "context").collect()
        assert sorted((t["iteration"], t["response"], len(t["code_blocks"])) for t in turns) == [(t["iteration"], t["response"], len(t["code_blocks"])) for t in want.log]


def test_fences():
    text = "a\n```repl\n x = 1 \n```\n```python\ny\n```\n```repl\nz\n```"
    assert find_code(text) == ["x = 1", "z"] and find_code("none") == []


def test_turn_history_cuts():
    class R:
        stdout, stderr, names = "x" * 30_000, "", []

    got = turn_history("r", [R()])
    assert len(got) == 2 and got[1]["content"].endswith("... + [10001 chars...]")


def test_session_answers():
    s = run_inline("some text", Config(model=rule("```repl\nprint(len(context))\n```", DONE)))
    assert s.answer == "42" and s.turn == 2 and s.history[4]["content"].startswith("REPL output:")


def test_last_call_after_all_turns():
    s = run_inline("t", Config(model=rule("thinking"), limits=Limits(max_turns=2)))
    assert s.answer == "thinking" and s.usage.calls == 3


def test_limits():
    bad = rule("```repl\n1/0\n```")
    with pytest.raises(errors.TooManyErrors) as e:
        run_inline("t", Config(model=bad, limits=Limits(errors=2)))
    assert e.value.count == 2 and e.value.partial_answer
    with pytest.raises(errors.TokensExceeded):
        run_inline("t", Config(model=rule("x"), limits=Limits(tokens=30)))
    with pytest.raises(errors.BudgetExceeded):
        run_inline("t", Config(model=("echo", {"cost": 0.6}), limits=Limits(budget=1.0)))
    with pytest.raises(errors.TimeExceeded):
        run_inline("t", Config(model=("echo", {"delay": 0.05}), limits=Limits(timeout=0.08)))


def test_errors_reset():
    turns = rule("```repl\n1/0\n```", "```repl\nx = 1\n```", "```repl\n1/0\n```", DONE)
    assert run_inline("t", Config(model=turns, limits=Limits(errors=2))).answer == "42"


def test_recursion_depth():
    def reply(prompt):
        if isinstance(prompt, str):
            return f"leaf {prompt}"
        n = sum(x["role"] == "assistant" for x in prompt)
        return "```repl\nr = rlm_query('sub')\n```" if n == 0 else "```repl\nanswer['content'] = r\nanswer['ready'] = True\n```"

    assert run_inline("t", Config(model=("rule", {"rule": reply}))).answer == "leaf sub"
    seen = []
    deep = Config(model=("rule", {"rule": reply}), limits=Limits(max_depth=2), on_event=lambda e, a: seen.append(e))
    assert run_inline("t", deep).answer == "leaf sub"
    assert "subcall_start" in seen and "iteration_complete" in seen


def test_child_limits():
    child = Limits(budget=1.0, timeout=60.0, tokens=9, errors=3).for_child(0.25, 10.0)
    assert (child.budget, child.timeout, child.tokens, child.errors) == (0.75, 50.0, 9, 3)


def test_compaction():
    s = Session(Config(model=rule("x" * 400), compaction=True, compaction_share=0.0005, limits=Limits(max_turns=3)))
    s.open("t")
    s.run()
    assert s.compactions >= 1 and s.sandbox.locals["history_0"][1]["type"] == "summary"
    before = list(s.sandbox.locals["history_0"])
    s.open("a second prompt")
    s.run()
    assert s.sandbox.locals["history_0"] == before  # an earlier conversation stays as it was


def test_persistent_session_keeps_versions():
    s = Session(Config(model=rule(DONE)))
    s.open("one")
    s.run()
    s.open("two")
    assert s.sandbox.contexts == 2 and s.sandbox.histories == 1 and s.status == "running"
    assert "context_0 to context_1" in s._prompt()[-1]["content"]


def test_tools():
    got = tools.parse_tools({"f": {"tool": len, "description": "counts"}, "d": {"tool": 3, "description": 5}})
    assert [t.description for t in got] == ["counts", None]
    assert tools.describe(got) == "- `f`: counts\n- `d`: data of type int"
    with pytest.raises(ValueError, match="answer, llm_query"):
        tools.parse_tools({"llm_query": 1, "answer": 2})
    assert tools.inherited({"a": 1}, None) == {"a": 1} and tools.inherited({"a": 1}, {}) == {}
    s = run_inline("t", Config(model=rule("```repl\nanswer['content'] = f('abc') + d\nanswer['ready'] = True\n```"), tools={"f": len, "d": 4}))
    assert s.answer == "7"
