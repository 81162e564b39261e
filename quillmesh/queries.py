"""The registered queries of the analysis engine and their DuckDB equivalents, side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmesh import scratch
from quillmesh.functions import messages as M
from quillmesh.functions import scoring as Q
from quillmesh.operators import calls, chunking, compaction, limits, trajectory, usage
from quillmesh.plans.recursion import recurse
from quillmesh.plans.session import Config, Limits, iterations, run_sessions
from quillmesh.sources import context, logs
from quillmesh.streaming.logs import activity_sessions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ordered(key: str, value: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(value).alias("v")))), lambda x: x["v"])


# documents as contexts of their source; conversations as histories; events as a log of iterations

CHUNK, CAP, KEYWORD = 1000, 100_000, "(?:the|der|les|los)"


def _contexts(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents")
    return docs.select(F.col("source").alias("ctx_id"), F.col("doc_id").alias("pos"), F.lit("list").alias("kind"), "text")


def _log(s: SparkSession, d: str) -> DataFrame:
    """Events as iterations of one session a user."""
    turn = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    e = table(s, d, "events").withColumn("turn", turn)
    return e.select(
        F.col("user_id").alias("session_id"),
        "turn",
        (F.col("event_type") == "error").alias("is_error"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.get_json_object("props", "$.k").cast("bigint").alias("tokens"),
        F.col("event_type").alias("model"),
        "event_id",
    )


LOG_SQL = """log AS (SELECT user_id AS session_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS turn,
    event_type = 'error' AS is_error, CAST(round(value * 100) AS BIGINT) AS cents,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS tokens, event_type AS model, event_id FROM events)"""
ERRORS_SQL = """island AS (SELECT *, sum(CASE WHEN is_error THEN 0 ELSE 1 END) OVER (PARTITION BY session_id ORDER BY turn) AS clean FROM log),
    err AS (SELECT *, sum(CASE WHEN is_error THEN 1 ELSE 0 END) OVER (PARTITION BY session_id, clean ORDER BY turn) AS in_row FROM island)"""


@query(f"""WITH c AS (SELECT source, doc_id, unnest(range(0, greatest(CAST(ceil(length(text) / {CHUNK}.0) AS BIGINT), 1))) AS n, text
    FROM documents WHERE regexp_matches(text, '{KEYWORD}')),
    r AS (SELECT doc_id, n, 'Mock response to: ' || substring(text, CAST(n * {CHUNK} + 1 AS BIGINT), {CHUNK}) AS response FROM c)
    SELECT doc_id, count(*) AS n_chunks, string_agg(response, chr(10) ORDER BY n) AS answer FROM r GROUP BY doc_id""")
def prefilter_llm_agg(s, d):
    """Filter by keyword, chunk, ask a model about each chunk, join a document's answers in order."""
    kept = chunking.keyword_filter(table(s, d, "documents").select("doc_id", "text"), "text", KEYWORD)
    asked = calls.lm_map(chunking.chunk_fixed(kept, CHUNK).select("doc_id", "chunk_no", F.col("chunk").alias("prompt")))
    return asked.groupBy("doc_id").agg(F.count("*").alias("n_chunks"), F.array_join(ordered("chunk_no", "response"), "\n").alias("answer"))


@query("""SELECT source AS ctx_id, 'list' AS context_type, string_agg(length(text), ',' ORDER BY doc_id) AS lengths,
    CAST(sum(length(text)) AS BIGINT) AS context_total_length FROM documents GROUP BY source""")
def ctx_metadata_list(s, d):
    got = context.metadata(_contexts(s, d))
    return got.select("ctx_id", "context_type", F.array_join(F.col("context_lengths").cast("array<string>"), ",").alias("lengths"), "context_total_length")


@query("""SELECT conv_id AS ctx_id, 'list' AS context_type, string_agg(length(text), ',' ORDER BY turn) AS lengths,
    CAST(sum(length(text)) AS BIGINT) AS context_total_length FROM conversations GROUP BY conv_id""")
def ctx_metadata_messages(s, d):
    rows = table(s, d, "conversations").select(F.col("conv_id").alias("ctx_id"), F.col("turn").alias("pos"), F.lit("list").alias("kind"), "text")
    got = context.metadata(rows)
    return got.select("ctx_id", "context_type", F.array_join(F.col("context_lengths").cast("array<string>"), ",").alias("lengths"), "context_total_length")


@query("""WITH v AS (SELECT source, doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS INT) AS ctx_index FROM documents)
    SELECT source, max(ctx_index) + 1 AS next_index, min(doc_id) FILTER (WHERE ctx_index = 0) AS context_0 FROM v GROUP BY source""")
def ctx_versioned(s, d):
    v = context.versions_by(table(s, d, "documents").select("source", "doc_id"), "source", "doc_id")
    return context.next_index(v, "source", "ctx_index").join(context.unversioned(v).select("source", F.col("doc_id").alias("context_0")), "source")


@query("""WITH base AS (SELECT source AS ctx_id, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS INT) AS ctx_index, text
      FROM documents JOIN (SELECT source, max(doc_id) AS last FROM documents GROUP BY source) USING (source) WHERE doc_id <> last),
    n AS (SELECT ctx_id, max(ctx_index) + 1 AS i FROM base GROUP BY ctx_id),
    added AS (SELECT source AS ctx_id, max(doc_id) AS doc_id FROM documents GROUP BY source)
    SELECT ctx_id, count(*) AS n_versions, CAST(sum(length(text)) AS BIGINT) AS chars, max(ctx_index) AS last_index FROM (
      SELECT * FROM base UNION ALL SELECT a.ctx_id, coalesce(n.i, 0), d.text FROM added a LEFT JOIN n USING (ctx_id) JOIN documents d USING (doc_id)) GROUP BY ctx_id""")
def ctx_add(s, d):
    """Every source's documents as versions, then the last one of each as the next."""
    docs = table(s, d, "documents").select(F.col("source").alias("ctx_id"), "doc_id", "text")
    last = docs.groupBy("ctx_id").agg(F.max("doc_id").alias("doc_id"))
    base = context.versions_by(docs.join(last, ["ctx_id", "doc_id"], "left_anti"), "ctx_id", "doc_id")
    added = docs.join(last, ["ctx_id", "doc_id"], "left_semi").select("ctx_id", "text")
    got = context.add_context(base.select("ctx_id", "ctx_index", "text"), added)
    return got.groupBy("ctx_id").agg(F.count("*").alias("n_versions"), F.sum(F.length("text")).alias("chars"), F.max("ctx_index").alias("last_index"))


@query("""SELECT conv_id, CAST(count(*) AS INT) AS next_index FROM conversations WHERE role = 'user' GROUP BY conv_id""")
def history_count(s, d):
    h = context.versions_by(table(s, d, "conversations").filter("role = 'user'"), "conv_id", "turn", "history_index")
    return context.next_index(h, "conv_id", "history_index")


@query("""SELECT conv_id, to_json(list(coalesce(text, '') ORDER BY turn))::VARCHAR AS contents FROM conversations GROUP BY conv_id""")
def context_contents(s, d):
    h = _histories(s, d)
    return h.select("conv_id", F.to_json(context.repl_contents(F.col("messages"))).alias("contents"))


@query("""SELECT doc_id, len(string_split(text, chr(10))) AS n_lines, array_to_string(string_split(text, chr(10))[1:5], chr(10)) AS head, substring(text, 1, 10000) AS start FROM documents""")
def probe_head(s, d):
    return chunking.probe(table(s, d, "documents").select("doc_id", "text")).select("doc_id", F.col("n_lines").cast("bigint").alias("n_lines"), "head", chunking.prefix(F.col("text")).alias("start"))


@query(f"""SELECT doc_id, CAST(n AS INT) AS chunk_no, substring(text, CAST(n * {CHUNK} + 1 AS BIGINT), {CHUNK}) AS chunk
    FROM (SELECT doc_id, text, unnest(range(0, greatest(CAST(ceil(length(text) / {CHUNK}.0) AS BIGINT), 1))) AS n FROM documents)""")
def chunk_fixed(s, d):
    return chunking.chunk_fixed(table(s, d, "documents").select("doc_id", "text"), CHUNK)


@query("""WITH r AS (SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM documents)
    SELECT source, CAST(CASE WHEN n // 7 = 0 THEN 6 ELSE least(pos // greatest(n // 7, 1), 6) END AS INT) AS slice_no, count(*) AS n_items, string_agg(text, chr(10) ORDER BY pos) AS slice
    FROM r GROUP BY ALL""")
def chunk_n_slices(s, d):
    return chunking.n_slices(table(s, d, "documents"), "source", "doc_id", 7)


@query(f"""SELECT source, doc_id, CAST(coalesce(sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {CAP // 10} AS INT) AS pack_no FROM documents""")
def pack_window(s, d):
    return chunking.pack_window(table(s, d, "documents"), "source", "doc_id", CAP // 10).select("source", "doc_id", "pack_no")


@query(f"""WITH RECURSIVE o AS (SELECT source, doc_id, length(text) AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
    p(source, doc_id, rn, pack_no, used) AS (SELECT source, doc_id, rn, 0, n FROM o WHERE rn = 1 UNION ALL
      SELECT o.source, o.doc_id, o.rn, CASE WHEN p.used > 0 AND p.used + o.n > {CAP // 10} THEN p.pack_no + 1 ELSE p.pack_no END,
        CASE WHEN p.used > 0 AND p.used + o.n > {CAP // 10} THEN o.n ELSE p.used + o.n END FROM p JOIN o ON o.source = p.source AND o.rn = p.rn + 1)
    SELECT source, doc_id, pack_no FROM p""")
def pack_greedy(s, d):
    return chunking.pack_greedy(table(s, d, "documents"), "source", "doc_id", CAP // 10)


@query("""SELECT source, doc_id, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 20 AS INT) AS batch_no FROM documents""")
def batch_20(s, d):
    return chunking.batches(table(s, d, "documents"), "source", "doc_id").select("source", "doc_id", "batch_no")


@query("""WITH b AS (SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM documents)
    SELECT source, CAST(pos // 10 AS INT) AS batch_no, count(*) AS n, sha256(string_agg(text, chr(1) ORDER BY pos)) AS digest FROM b GROUP BY ALL""")
def group_10(s, d):
    got = chunking.grouped_batches(table(s, d, "documents"), "source", "doc_id")
    return got.select("source", "batch_no", F.size("texts").cast("bigint").alias("n"), F.sha2(F.array_join("texts", "\x01"), 256).alias("digest"))


@query("""SELECT source, string_agg(CASE WHEN length(text) > 0 THEN left(text, 1) ELSE '' END, '' ORDER BY doc_id) AS carried FROM documents GROUP BY source""")
def fold_sections(s, d):
    """A buffer carried over each source's documents in order: here their first characters."""
    return chunking.fold(table(s, d, "documents"), "source", "doc_id", lambda carried, text: carried + (text or "")[:1], "")


@query(f"""SELECT source, count(*) AS n_second FROM documents WHERE regexp_matches(text, '{KEYWORD}')
    AND contains('Mock response to: ' || left(text, 200), 'password') = false GROUP BY source""")
def coarse_then_targeted(s, d):
    """A first pass over previews decides what the second one reads."""
    first = table(s, d, "documents").filter(F.col("text").rlike(KEYWORD)).select("doc_id", "source", F.substring("text", 1, 200).alias("prompt"))
    kept = calls.lm_map(first).filter(~F.contains("response", F.lit("password"))).select("doc_id", "source", F.col("response").alias("prompt"))
    return calls.lm_map(kept).filter("error is null").groupBy("source").agg(F.count("*").alias("n_second"))


@query("""SELECT source, round(avg(n_chars), 6) AS mean, median(n_chars) AS median, min(n_chars) AS least, max(n_chars) AS largest, round(stddev_samp(n_chars), 6) AS stddev FROM documents GROUP BY source""")
def text_statistics(s, d):
    got = chunking.statistics(table(s, d, "documents"), "n_chars", "source")
    return got.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


@query("""SELECT l_suppkey, CAST(sum(CAST(round(p_retailprice * 100) AS BIGINT) * CAST(l_quantity AS BIGINT)) AS BIGINT) AS cents FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey""")
def tool_portfolio(s, d):
    """A tool's aggregate: the sum of price times quantity."""
    part = table(s, d, "part").select("p_partkey", F.round(F.col("p_retailprice") * 100).cast("bigint").alias("price"))
    joined = table(s, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("l_suppkey").agg(F.sum(F.col("price") * F.col("l_quantity").cast("bigint")).alias("cents"))


@query("""SELECT source, label, count(*) AS n FROM (SELECT source, CASE WHEN contains(l, '!!') THEN 'loud' WHEN length(l) > 80 THEN 'long' ELSE 'short' END AS label
    FROM (SELECT source, unnest(string_split(text, chr(10))) AS l FROM documents)) GROUP BY ALL""")
def semantic_count(s, d):
    """A model by rule labels the lines of each context."""
    lines = table(s, d, "documents").select("source", F.explode(F.split("text", "\n")).alias("prompt"))

    def rule(p: str) -> str:
        return "loud" if "!!" in p else "long" if len(p) > 80 else "short"

    done = calls.lm_map(lines.withColumn("prompt", F.concat(F.lit(" "), "prompt")), kind="rule", settings={"rule": lambda p: rule(p[1:])}, in_flight=1)
    return chunking.label_counts(done, F.col("response"), "source")


@query("""SELECT conv_id, turn, 'Mock response to: ' || text AS response, 10 AS input_tokens, 10 AS output_tokens FROM conversations""")
def llm_query_echo(s, d):
    got = calls.lm_map(table(s, d, "conversations").select("conv_id", "turn", F.col("text").alias("prompt")))
    return got.select("conv_id", "turn", "response", "input_tokens", "output_tokens")


@query("""SELECT conv_id, string_agg(CASE WHEN contains(text, 'th') THEN 'Error: llm() call failed - refused: th' ELSE 'Mock response to: ' || text END, chr(10) ORDER BY turn) AS responses,
    count(*) FILTER (WHERE contains(text, 'th')) AS n_failed FROM conversations GROUP BY conv_id""")
def llm_batched_partial_failure(s, d):
    """Failing prompts leave their slot with an error; order and length stay."""
    batches = table(s, d, "conversations").groupBy("conv_id").agg(ordered("turn", "text").alias("prompts"))
    got = calls.lm_map_batched(batches, settings={"fail_on": "th"})
    return got.select("conv_id", F.array_join("responses", "\n").alias("responses"), "n_failed")


@query("""SELECT doc_id, depth, CASE WHEN lang IN ('en', 'fr') THEN lang WHEN depth = 1 THEN 'second' ELSE 'main' END AS model FROM documents, (SELECT unnest([0, 1, 2]) AS depth)""")
def route_client(s, d):
    at = table(s, d, "documents").select("doc_id", "lang", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("depth"))
    return at.select("doc_id", "depth", calls.route(F.col("lang"), F.col("depth"), ["en", "fr"], "main", "second").alias("model"))


@query(f"""SELECT doc_id, CASE WHEN length(p) = 0 THEN '{calls.EMPTY_REQUEST.replace("'", "''")}' WHEN length(p) > 5000 THEN 'Error: request of ' || length(p) || ' characters is over the limit of 5000' END AS error
    FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END AS p FROM documents)""")
def request_errors(s, d):
    p = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("text"))
    return table(s, d, "documents").select("doc_id", calls.request_error(p, 5000).alias("error"))


@query("""SELECT source, count(*) AS n_prompts, CAST(sum(length(text)) AS BIGINT) AS total_chars, max(length(text)) AS longest, sum(length(text)) > 100000 AS oversized FROM documents GROUP BY source""")
def oversized_batches(s, d):
    return calls.oversized_batches(table(s, d, "documents"), "source", "text", 100_000)


def _histories(s: SparkSession, d: str) -> DataFrame:
    message = F.struct("turn", "role", F.col("text").alias("content"))
    gathered = table(s, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(message)).alias("m"))
    return gathered.select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


@query("""SELECT conv_id, arg_max(text, turn) FILTER (WHERE role = 'user') AS last_user FROM conversations GROUP BY conv_id""")
def last_user_message(s, d):
    return _histories(s, d).select("conv_id", M.last_user(F.col("messages")).alias("last_user"))


@query("""SELECT conv_id, arg_max(text, turn) FILTER (WHERE role = 'system') AS system, count(*) FILTER (WHERE role <> 'system') AS n_rest,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN 'model' ELSE 'user' END, ',' ORDER BY turn) FILTER (WHERE role <> 'system'), '') AS roles FROM conversations GROUP BY conv_id""")
def system_split(s, d):
    h = _histories(s, d)
    rest = M.without_system(F.col("messages"))
    roles = F.array_join(F.transform(M.service_roles(F.col("messages")), lambda m: m["role"]), ",")
    return h.select("conv_id", M.last_system(F.col("messages")).alias("system"), F.size(rest).cast("bigint").alias("n_rest"), roles.alias("roles"))


@query("""SELECT conv_id, string_agg(CASE WHEN role = 'assistant' AND turn % 2 = 1 THEN 'thought ' || turn ELSE text END, '|' ORDER BY turn) AS contents FROM conversations GROUP BY conv_id""")
def filled_assistant(s, d):
    gone = (F.col("role") == "assistant") & (F.col("turn") % 2 == 1)
    c = table(s, d, "conversations").withColumn("content", F.when(gone, "").otherwise(F.col("text")))
    m = F.struct("turn", "role", "content", F.concat(F.lit("thought "), "turn").alias("reasoning"))
    g = c.groupBy("conv_id").agg(M.filled_assistant(F.array_sort(F.collect_list(m))).alias("m"))
    return g.select("conv_id", F.array_join(F.transform("m", lambda x: x["content"]), "|").alias("contents"))


@query("""SELECT conv_id, turn, len(b) AS n_blocks, array_to_string(list_transform(b, lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), '|') AS code FROM (
    SELECT conv_id, turn, regexp_extract_all(t, '(?s)```repl\\s*\\n(.*?)\\n```', 1) AS b FROM (SELECT conv_id, turn,
      CASE WHEN role = 'assistant' THEN 'so' || chr(10) || '```repl' || chr(10) || '  ' || text || ' ' || chr(10) || '```' || chr(10) || '```python' || chr(10) || 'x' || chr(10) || '```' || chr(10) || '```repl' || chr(10) || 'y = 1' || chr(10) || '```' ELSE text END AS t FROM conversations))""")
def code_blocks(s, d):
    fenced = F.concat(F.lit("so\n```repl\n  "), "text", F.lit(" \n```\n```python\nx\n```\n```repl\ny = 1\n```"))
    c = table(s, d, "conversations").withColumn("t", F.when(F.col("role") == "assistant", fenced).otherwise(F.col("text")))
    b = M.code_blocks(F.col("t"))
    return c.select("conv_id", "turn", F.size(b).cast("bigint").alias("n_blocks"), F.array_join(b, "|").alias("code"))


@query("""SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'assistant' AND length(text) > 40) AS answer FROM conversations GROUP BY conv_id""")
def final_answer_pick(s, d):
    answer = F.when((F.col("role") == "assistant") & (F.length("text") > 40), F.col("text"))
    g = table(s, d, "conversations").withColumn("a", answer).groupBy("conv_id").agg(ordered("turn", "a").alias("answers"))
    return g.select("conv_id", M.first_answer(F.col("answers")).alias("answer"))


@query("""SELECT doc_id, CASE WHEN length(text) > 500 THEN left(text, 500) || '... + [' || (length(text) - 500) || ' chars...]' ELSE text END AS shown,
    replace(left(text, 60), chr(10), ' ') AS snippet FROM documents""")
def truncate_output(s, d):
    return table(s, d, "documents").select("doc_id", M.cut(F.col("text"), 500).alias("shown"), M.snippet(F.col("text")).alias("snippet"))


@query("""WITH o AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END AS so, CASE WHEN doc_id % 4 = 0 THEN 'oops' ELSE '' END AS se, doc_id % 2 AS v FROM documents),
    r AS (SELECT doc_id, concat_ws(chr(10) || chr(10), CASE WHEN so <> '' THEN chr(10) || so END, CASE WHEN se <> '' THEN chr(10) || se END,
      CASE WHEN v = 1 THEN 'REPL variables: [''x'', ''y'']' || chr(10) END) AS r FROM o)
    SELECT doc_id, 'REPL output (block 1):' || chr(10) || CASE WHEN r = '' THEN 'No output' WHEN length(r) > 20000 THEN left(r, 20000) || '... + [' || (length(r) - 20000) || ' chars...]' ELSE r END || chr(10) || chr(10) || 'REPL output (block 2):' || chr(10) || 'No output' AS content FROM r""")
def iteration_messages(s, d):
    docs = table(s, d, "documents")
    out = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("text"))
    err = F.when(F.col("doc_id") % 4 == 0, "oops").otherwise("")
    names = F.when(F.col("doc_id") % 2 == 1, F.array(F.lit("x"), F.lit("_z"), F.lit("y"))).otherwise(F.array().cast("array<string>"))
    empty = F.array().cast("array<string>")
    results = F.array(M.execution_result(out, err, names), M.execution_result(F.lit(""), F.lit(""), empty))
    return docs.select("doc_id", F.element_at(M.turn_messages(F.lit("x"), results), 2)["content"].alias("content"))


@query(f"""SELECT conv_id, turn, CASE WHEN turn = 0 THEN '{M.FIRST_LOOK.strip()}' || chr(10) || chr(10) ELSE '' END || 'Turn ' || (turn + 1) || '/30:'
    || CASE WHEN conv_id % 3 > 1 THEN chr(10) || chr(10) || 'Contexts at hand: context_0 to context_' || (conv_id % 3 - 1) || '.' ELSE '' END
    || CASE WHEN conv_id % 4 = 1 THEN chr(10) || chr(10) || 'An earlier conversation is in `history`.' WHEN conv_id % 4 > 1 THEN chr(10) || chr(10) || 'Earlier conversations: history_0 to history_' || (conv_id % 4 - 1) || '.' ELSE '' END AS prompt
    FROM conversations""")
def user_prompt(s, d):
    c = table(s, d, "conversations")
    return c.select("conv_id", "turn", M.turn_prompt(F.col("turn"), 30, F.col("conv_id") % 3, F.col("conv_id") % 4).alias("prompt"))


@query("""SELECT source, 'Question: which?' || chr(10) || chr(10) || 'The context is of type list with ' || sum(length(text))::BIGINT || ' characters in all.' AS content FROM documents GROUP BY source""")
def opening_prompt(s, d):
    m = context.metadata(_contexts(s, d))
    first = M.opening("You answer.", F.col("context_type"), F.col("context_total_length"), F.lit("which?"), "- `f`: adds")
    return m.select(F.col("ctx_id").alias("source"), F.element_at(first, 2)["content"].alias("content"))


@query(f"WITH {LOG_SQL}, {ERRORS_SQL} SELECT session_id, min(turn) AS turn FROM err WHERE in_row >= 2 GROUP BY session_id")
def limit_errors(s, d):
    return limits.first_turn(limits.consecutive_errors(_log(s, d), F.col("is_error")), F.col("errors_in_row") >= 2)


@query(f"WITH {LOG_SQL}, r AS (SELECT *, sum(cents) OVER (PARTITION BY session_id ORDER BY turn) AS spent FROM log) SELECT session_id, min(turn) AS turn FROM r WHERE spent > 50000 GROUP BY session_id")
def limit_budget(s, d):
    return limits.first_turn(limits.running_total(_log(s, d), F.col("cents"), "spent"), F.col("spent") > 50_000)


@query(f"WITH {LOG_SQL}, r AS (SELECT *, sum(tokens) OVER (PARTITION BY session_id ORDER BY turn) AS used FROM log) SELECT session_id, min(turn) AS turn FROM r WHERE used > 500 GROUP BY session_id")
def limit_tokens(s, d):
    return limits.first_turn(limits.running_total(_log(s, d), F.col("tokens"), "used"), F.col("used") > 500)


@query(f"WITH {LOG_SQL}, r AS (SELECT *, coalesce(sum(cents) OVER (PARTITION BY session_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM log) SELECT session_id, min(turn) AS turn FROM r WHERE before > 30000 GROUP BY session_id")
def limit_timeout(s, d):
    return limits.timeout_turn(_log(s, d), F.col("cents").cast("double"), 30_000.0)


@query(f"""WITH {LOG_SQL}, {ERRORS_SQL}, r AS (SELECT *, sum(cents) OVER (PARTITION BY session_id ORDER BY turn) AS spent, sum(tokens) OVER (PARTITION BY session_id ORDER BY turn) AS used FROM err),
    h AS (SELECT session_id, turn, CASE WHEN in_row >= 2 THEN 'errors' WHEN spent > 50000 THEN 'budget' WHEN used > 500 THEN 'tokens' END AS cause FROM r)
    SELECT session_id, min(turn) AS turn, arg_min(cause, turn) AS cause FROM h WHERE cause IS NOT NULL GROUP BY session_id""")
def limit_first_trip(s, d):
    return limits.first_trip(_log(s, d), F.col("is_error"), F.col("cents"), F.col("tokens"), 2, 50_000, 500)


@query("""SELECT conv_id, arg_max(text, turn) AS partial_answer FROM conversations WHERE role = 'assistant' AND trim(regexp_replace(text, '\\s', '', 'g')) <> '' GROUP BY conv_id""")
def best_partial(s, d):
    return limits.best_partial(table(s, d, "conversations").filter("role = 'assistant'"), "text", "conv_id")


@query(f"""WITH {LOG_SQL}, t AS (SELECT session_id, sum(cents) AS spent FROM log GROUP BY session_id)
    SELECT session_id, CAST(900000 - spent AS BIGINT) AS left_cents, CASE WHEN 900000 - spent <= 0 THEN 'Error: no budget is left' END AS refusal FROM t""")
def child_limits(s, d):
    spent = _log(s, d).groupBy("session_id").agg(F.sum("cents").alias("spent"))
    got = limits.child_limits(F.lit(900_000), F.col("spent"), F.lit(60.0), F.lit(10.0))
    return spent.select("session_id", got["remaining_budget"].alias("left_cents"), got["refusal"].alias("refusal"))


@query(f"""WITH {LOG_SQL} SELECT model, count(*) AS total_calls, CAST(sum(tokens) AS BIGINT) AS total_input_tokens, CAST(sum(turn) AS BIGINT) AS total_output_tokens,
    CAST(nullif(sum(CASE WHEN model <> 'error' THEN cents ELSE 0 END), 0) AS BIGINT) AS total_cost FROM log GROUP BY model""")
def usage_rollup(s, d):
    log = _log(s, d).withColumn("cost", F.when(F.col("model") != "error", F.col("cents")).otherwise(0))
    return usage.by_model(log, input_tokens="tokens", output_tokens="turn")


@query(f"WITH {LOG_SQL} SELECT session_id, CAST(sum(tokens) AS BIGINT) AS total_input_tokens, CAST(sum(CASE WHEN model = 'purchase' THEN cents END) AS BIGINT) AS total_cost FROM log GROUP BY session_id")
def usage_null_cost(s, d):
    log = _log(s, d).withColumn("cost", F.when(F.col("model") == "purchase", F.col("cents")))
    return usage.totals(log, "session_id", input_tokens="tokens", output_tokens="turn").select("session_id", "total_input_tokens", "total_cost")


@query(f"""WITH {LOG_SQL} SELECT session_id, count(DISTINCT model) AS n_models, CAST(sum(tokens) AS BIGINT) AS total_input_tokens FROM log GROUP BY session_id""")
def usage_summary(s, d):
    """Per-model sums as a map, and the totals over it."""
    log = _log(s, d).withColumn("cost", F.col("cents").cast("double"))
    m = usage.usage_map(usage.by_model(log, "session_id", input_tokens="tokens", output_tokens="turn"), "session_id")
    return m.select("session_id", F.size("usage").cast("bigint").alias("n_models"), usage.map_totals(F.col("usage"))["total_input_tokens"].alias("total_input_tokens"))


@query(f"WITH {LOG_SQL} SELECT session_id, arg_max(tokens, turn) AS tokens, arg_max(cents, turn) AS cents FROM log GROUP BY session_id")
def last_usage(s, d):
    return usage.last_usage(_log(s, d), "session_id", "turn", "tokens", "cents")


@query("""SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN NULL WHEN a > 0 THEN a END, CASE WHEN event_id % 5 <> 0 AND b > 0 THEN b END, CASE WHEN c > 0 THEN c END) AS cost
    FROM (SELECT event_id, CAST(round(value * 100) AS BIGINT) AS a, user_id % 4 AS b, CAST(json_extract_string(props, '$.k') AS BIGINT) AS c FROM events)""")
def call_cost(s, d):
    e = table(s, d, "events")
    own = F.when(F.col("event_id") % 3 != 0, F.round(F.col("value") * 100).cast("bigint"))
    extra = F.when(F.col("event_id") % 5 != 0, F.col("user_id") % 4)
    return e.select("event_id", usage.call_cost(own, extra, F.get_json_object("props", "$.k").cast("bigint")).alias("cost"))


@query("SELECT conv_id, CAST((sum(length(text)) + 3) // 4 AS BIGINT) AS current_tokens FROM conversations GROUP BY conv_id")
def token_estimate(s, d):
    return usage.message_tokens(table(s, d, "conversations"), "conv_id", "text")


_KEYS = ", ".join(f"({i}, '{k}', {v})" for i, (k, v) in enumerate(usage.CONTEXT_LIMITS.items()))
_NAME = "CASE doc_id % 5 WHEN 0 THEN '@openai/gpt-4o-mini-x' WHEN 1 THEN 'gpt-5' WHEN 2 THEN 'some/kimi-k2.5' WHEN 3 THEN 'unknown' ELSE 'claude-2.1-' || lang END"


@query(f"""WITH k(i, key, lim) AS (VALUES {_KEYS}), m AS (SELECT doc_id, {_NAME} AS model FROM documents)
    SELECT doc_id, model, CAST(coalesce(arg_max(lim, length(key)), {usage.DEFAULT_LIMIT}) AS INT) AS context_limit FROM m LEFT JOIN k ON contains(model, key) GROUP BY doc_id, model""")
def context_limit(s, d):
    m = table(s, d, "documents").select("doc_id", F.expr(_NAME).alias("model"))
    return m.select("doc_id", "model", usage.context_limit(F.col("model")).alias("context_limit"))


@query("""SELECT conv_id, CAST((sum(length(text)) + 3) // 4 AS BIGINT) AS current_tokens, CAST(floor(8192 * 0.05) AS BIGINT) AS threshold_tokens,
    CAST((sum(length(text)) + 3) // 4 AS BIGINT) >= floor(8192 * 0.05) AS due FROM conversations GROUP BY conv_id""")
def compact_trigger(s, d):
    got = compaction.status(table(s, d, "conversations"), "conv_id", F.lit("gpt-4"), 0.05, "text")
    return got.select("conv_id", "current_tokens", "threshold_tokens", "due")


@query("""WITH t AS (SELECT conv_id, count(*) AS n, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS told FROM conversations GROUP BY conv_id)
    SELECT conv_id, CAST(least(n, 2) + 2 AS INT) AS n_messages, 1 AS compactions, length('Mock response to: ' || told) > 0 AS summarised FROM t""")
def compact_history(s, d):
    h = _histories(s, d).withColumn("compactions", F.lit(0))
    got = compaction.compact(h)
    return got.select("conv_id", F.size("messages").alias("n_messages"), "compactions", (F.length("summary") > 0).alias("summarised"))


@query("""SELECT conv_id, pos, kind FROM (SELECT DISTINCT conv_id FROM conversations), (VALUES (0, 'segment'), (1, 'summary')) AS v(pos, kind)""")
def compaction_entries(s, d):
    got = compaction.compact(_histories(s, d).withColumn("compactions", F.lit(0)))
    return compaction.history_entries(got, "conv_id", "compactions").select("conv_id", "pos", "kind")


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'model,temperature' ELSE 'base_url,model' END AS kept FROM documents""")
def redact_config(s, d):
    even = F.create_map(*map(F.lit, ["model", "x", "api_key", "k", "OPENAI_API_KEY", "k", "temperature", "0"]))
    odd = F.create_map(*map(F.lit, ["base_url", "u", "ApiKeyId", "k", "model", "x"]))
    kept = usage.redacted(F.when(F.col("doc_id") % 2 == 0, even).otherwise(odd))
    return table(s, d, "documents").select("doc_id", F.array_join(F.array_sort(F.map_keys(kept)), ",").alias("kept"))


TREE_SQL = """c AS (SELECT event_id AS call_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id // 10 * 10 + (event_id % 10) // 3 END AS parent_call_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
    t(call_id, root_call_id, depth) AS (SELECT call_id, call_id, 0 FROM c WHERE parent_call_id IS NULL UNION ALL SELECT c.call_id, t.root_call_id, t.depth + 1 FROM c JOIN t ON c.parent_call_id = t.call_id)"""


@query(f"WITH RECURSIVE {TREE_SQL} SELECT root_call_id, depth, count(*) AS n_calls, CAST(sum(cents) AS BIGINT) AS cents FROM t JOIN c USING (call_id) GROUP BY root_call_id, depth")
def call_tree(s, d):
    """Calls with made-up parents: what children spend counts for their root."""
    e = F.col("event_id")
    parent = F.when(e % 10 != 0, F.expr("event_id div 10 * 10 + (event_id % 10) div 3"))
    c = table(s, d, "events").select(e.alias("call_id"), parent.alias("parent_call_id"), F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    return trajectory.tree_rollup(trajectory.call_tree(s, c), c, "cents")


def _iterations(s: SparkSession, d: str) -> DataFrame:
    """Conversations as trajectories: an iteration a turn, its prompt the turn's text, a block with a call for assistants."""
    c = table(s, d, "conversations")
    answer = F.when((F.col("role") == "assistant") & (F.length("text") > 100), F.substring("text", 1, 20))
    stderr = F.when(F.col("turn") % 3 == 2, F.lit("oops")).otherwise("")
    call = F.struct(F.col("text").alias("prompt"))
    result = F.struct(
        F.lit("").alias("stdout"),
        stderr.alias("stderr"),
        F.when(F.col("turn") == 1, F.create_map(F.lit("context"), F.substring("text", 1, 30))).alias("locals"),
        F.lit(0.5).alias("execution_time"),
        F.array(call).alias("rlm_calls"),
    )
    block = F.struct(F.lit("x").alias("code"), result.alias("result"))
    blocks = F.when(F.col("role") == "assistant", F.array(block)).otherwise(F.slice(F.array(block), 1, 0))
    return c.select(
        "conv_id",
        F.col("turn").alias("iteration"),
        F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))).alias("prompt"),
        F.col("text").alias("response"),
        blocks.alias("code_blocks"),
        answer.alias("final_answer"),
        F.when(F.col("turn") % 2 == 0, F.lit(1.0)).alias("iteration_time"),
    )


@query("""SELECT conv_id, count(*) AS n_iterations, count(*) FILTER (WHERE role = 'assistant') AS code_blocks_n, count(*) FILTER (WHERE role = 'assistant') AS sub_calls,
    sum(CASE WHEN turn % 2 = 0 THEN 1.0 WHEN role = 'assistant' THEN 0.5 ELSE 0.0 END)::DOUBLE AS total_time, bool_or(role = 'assistant' AND turn % 3 = 2) AS has_errors,
    arg_max(left(text, 20), turn) FILTER (WHERE role = 'assistant' AND length(text) > 100) AS final_answer FROM conversations GROUP BY conv_id""")
def run_metadata(s, d):
    return trajectory.run_summary(_iterations(s, d), "conv_id")


@query("""SELECT conv_id, turn AS iteration, CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS code_blocks_n, CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS sub_calls,
    CASE WHEN turn % 2 = 0 THEN 1.0 WHEN role = 'assistant' THEN 0.5 ELSE 0.0 END::DOUBLE AS exec_time, role = 'assistant' AND turn % 3 = 2 AS has_error,
    role = 'assistant' AND length(text) > 100 AS has_final, CAST(floor(length(text) / 4.0 + 0.5) AS BIGINT) AS input_tokens, CAST(floor(length(text) / 4.0 + 0.5) AS BIGINT) AS output_tokens FROM conversations""")
def iteration_stats(s, d):
    names = "conv_id iteration code_blocks_n sub_calls exec_time has_error has_final input_tokens output_tokens".split()
    return trajectory.iteration_stats(_iterations(s, d)).select(*names)


@query("""SELECT conv_id, left(text, 30) AS context FROM conversations WHERE turn = 1 AND role = 'assistant' AND length(text) > 0""")
def context_variable(s, d):
    return trajectory.context_variable(_iterations(s, d), "conv_id")


@query(f"""SELECT conv_id, coalesce((list(CASE WHEN length(text) > 50 AND length(text) < 500 AND NOT contains(text, 'answer the prompt') THEN left(text, 200) || CASE WHEN length(text) > 200 THEN '...' ELSE '' END END ORDER BY turn)
    FILTER (WHERE role = 'user' AND length(text) > 50 AND length(text) < 500 AND NOT contains(text, 'answer the prompt')))[1], '{trajectory.NO_QUESTION}') AS question FROM conversations GROUP BY conv_id""")
def run_question(s, d):
    return _histories(s, d).select("conv_id", trajectory.question(F.col("messages"), F.lit(None).cast("string")).alias("question"))


@query("""SELECT conv_id, count(*) AS n_iterations, 1 AS n_metadata FROM conversations GROUP BY conv_id""")
def log_round_trip(s, d):
    """Trajectories written as JSON lines and read back."""
    it = _iterations(s, d)
    line = it.select(F.lit("iteration").alias("type"), F.format_string("2024-01-01T00:00:%02d", F.col("iteration").cast("int")).alias("timestamp"), F.col("conv_id").cast("string").alias("root_model"), F.col("iteration").cast("int").alias("iteration"), "prompt", "response", "iteration_time")
    meta = it.select("conv_id").distinct().select(F.lit("metadata").alias("type"), F.lit("2024-01-01").alias("timestamp"), F.col("conv_id").cast("string").alias("root_model"), F.lit(30).alias("max_iterations"))
    path = scratch.new_path(s, "log")
    logs.write_log(line, path)
    logs.write_log(meta.unionByName(meta), path)
    got = logs.read_log(s, path)
    told = logs.run_metadata(got, "root_model").select("root_model", F.lit(1).alias("n_metadata"))
    n = logs.iterations(got, "root_model").groupBy("root_model").agg(F.count("*").alias("n_iterations"))
    return n.join(told, "root_model").select(F.col("root_model").cast("bigint").alias("conv_id"), "n_iterations", "n_metadata")


@query("""WITH a AS (SELECT doc_id, text || ' is ' || p || ' ' || q AS t, p, q FROM documents,
      (SELECT * FROM (VALUES ('more common than', 'less common than'), ('same frequency as', 'so'), ('nothing', 'here')) AS v(p, q)))
    SELECT doc_id, p, CASE WHEN q LIKE 'less%' THEN q WHEN p = 'nothing' THEN NULL ELSE p END AS phrase FROM a""")
def comparison_phrase(s, d):
    pairs = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in (("more common than", "less common than"), ("same frequency as", "so"), ("nothing", "here"))])
    a = table(s, d, "documents").select("doc_id", "text", F.explode(pairs).alias("v"))
    t = F.concat("text", F.lit(" is "), "v.p", F.lit(" "), "v.q")
    return a.select("doc_id", F.col("v.p").alias("p"), Q.comparison_phrase(t).alias("phrase"))


@query("""WITH a AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Label: *' || lang || '*' WHEN 1 THEN lang ELSE 'the answer that was found is ' || lang END AS t, lang FROM documents)
    SELECT doc_id, lang AS answer, CASE doc_id % 3 WHEN 0 THEN 'vhigh' ELSE 'low' END AS confidence FROM a""")
def answer_parse(s, d):
    t = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Label: *"), "lang", F.lit("*"))).when(F.col("doc_id") % 3 == 1, F.col("lang")).otherwise(F.concat(F.lit("the answer that was found is "), "lang"))
    return table(s, d, "documents").select("doc_id", Q.parsed_answer(t).alias("a")).select("doc_id", "a.answer", "a.confidence")


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN 0.0 ELSE pow(0.75, abs(doc_id % 7 - doc_id % 5)) END AS score FROM labels""")
def score_numeric(s, d):
    gold = F.concat(F.lit("["), (F.col("doc_id") % 7).cast("string"), F.lit("]"))
    got = F.when(F.col("doc_id") % 4 == 3, F.lit("Answer: none")).otherwise(F.concat(F.lit("Answer: "), (F.col("doc_id") % 5).cast("string")))
    return table(s, d, "labels").select("doc_id", Q.score(gold, F.lit(Q.NUMERIC), got).alias("score"))


@query("""SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 AND doc_id % 10 >= 3 THEN doc_id % 10 / 10.0 ELSE 0.0 END::DOUBLE AS reward FROM labels""")
def gated_reward(s, d):
    passed = Q.passes_gates(F.col("quality") * 2, 1 - F.col("toxic"), 2, 1)
    value = (F.col("doc_id") % 10).cast("double") / 10
    return table(s, d, "labels").select("doc_id", Q.gated_reward(value, passed, 0.3).alias("reward"))


@query("""SELECT quality, count(*) AS n, CAST(sum(CASE WHEN doc_id % 6 < 3 THEN 1 ELSE 0 END) AS BIGINT) AS below_turns, CAST(sum(CASE WHEN doc_id % 4 < 1 THEN 1 ELSE 0 END) AS BIGINT) AS below_sub_calls,
    CAST(sum(CASE WHEN toxic = 0 THEN 1 ELSE 0 END) AS BIGINT) AS below_reward FROM labels GROUP BY quality""")
def rubric_metrics(s, d):
    r = table(s, d, "labels").select(
        "quality", (F.col("doc_id") % 6).alias("turns"), F.lit(1).alias("repl_calls"), (F.col("doc_id") % 4).alias("sub_calls"), F.lit("x").alias("final_answer"), F.col("toxic").cast("double").alias("reward")
    )
    m = Q.rubric_metrics(r, 3, 1, 0.5)
    return m.groupBy("quality").agg(F.count("*").alias("n"), F.sum("m_below_turns").alias("below_turns"), F.sum("m_below_sub_calls").alias("below_sub_calls"), F.sum("m_below_reward").alias("below_reward"))


@query("""SELECT doc_id FROM documents WHERE lang IN ('en', 'de') AND n_chars BETWEEN 500 AND 3000 AND doc_id % 5 <> 0""")
def dataset_filter(s, d):
    numeric = F.col("doc_id") % 5 == 0
    return context.dataset_rows(table(s, d, "documents"), F.col("lang"), F.col("n_chars"), ["en", "de"], 500, 3000, numeric, False).select("doc_id")


@query("""SELECT doc_id, CAST('{"lang":"' || lang || '","n_chars":' || n_chars || '}' AS VARCHAR) AS info, text AS question FROM documents""")
def dataset_projection(s, d):
    docs = table(s, d, "documents")
    got = context.qa_rows(docs, F.col("text"), F.col("doc_id").cast("string"), [F.col("lang"), F.col("n_chars")])
    return got.select(F.col("answer").cast("bigint").alias("doc_id"), "info", F.col("prompt")[0]["content"].alias("question"))


@query()
def dataset_shuffle(s, d):
    """A repeatable sample: the first 100 rows in hashed order."""
    return context.shuffled(table(s, d, "documents").select("doc_id"), F.col("doc_id"), 42, 100)


@query("""WITH c AS (SELECT doc_id, unnest(range(0, greatest(CAST(ceil(length(text) / 2000.0) AS BIGINT), 1))) AS n, text FROM documents)
    SELECT CAST(doc_id AS VARCHAR) AS call_id, string_agg('Mock response to: ' || substring(text, CAST(n * 2000 + 1 AS BIGINT), 2000), chr(10) ORDER BY n) AS told, count(*) AS sub_calls FROM c GROUP BY doc_id""")
def recurse_levels(s, d):
    """Documents as calls, split once into sub-calls that are answered and joined."""
    split = lambda p: F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.length(p) / 2000).cast("int"), F.lit(1)) - 1), lambda k: F.substring(p, k * 2000 + 1, F.lit(2000)))
    docs = table(s, d, "documents").select(F.col("doc_id").alias("call_id"), F.col("text").alias("prompt"))
    got = recurse(docs, split, 1).filter("depth = 0")
    return got.select("call_id", F.substring("response", len("Mock response to: ") + 1, 1 << 30).alias("told"), F.col("sub_calls").cast("bigint").alias("sub_calls"))


def _coded_rule(prompt) -> str:
    """A model that counts the words of its context by code, then answers."""
    turns = sum(m["role"] == "assistant" for m in prompt)
    if turns == 0:
        return "Let me see.\n```repl\nn = len(context.split())\nprint(n)\n```"
    return "```repl\nanswer['content'] = str(n)\nanswer['ready'] = True\n```"


@query("""SELECT conv_id, turn, CAST(len(regexp_extract_all(text, '\\S+')) AS VARCHAR) AS final_answer, 2 AS turns, 'done' AS status FROM conversations""")
def session_loop(s, d):
    """Sessions whose model writes code in one turn and answers in the next."""
    c = table(s, d, "conversations").select("conv_id", F.col("turn").alias("t"), F.col("text").alias("context"))
    got = run_sessions(c, Config(model=("rule", {"rule": _coded_rule}), limits=Limits(max_turns=5)))
    return got.select("conv_id", F.col("t").alias("turn"), "final_answer", F.col("turn").alias("turns"), "status")


def _two_turn_rule(prompt):
    """Sets the answer's content in the first turn and calls it ready in the second, from what the first left behind."""
    if isinstance(prompt, str):
        return f"leaf {len(prompt)}"
    n = sum(x["role"] == "assistant" for x in prompt)
    first = "```repl\nparts = llm_query_batched([context, context * 2, 'x'])\nanswer['content'] = ', '.join(parts)\nprint(len(context))\n```"
    return first if n == 0 else "```repl\nanswer['ready'] = len(parts) == 3\n```"


def _two_turns(s, d):
    c = table(s, d, "conversations").select("conv_id", F.col("turn").alias("t"), F.col("text").alias("context"))
    return run_sessions(c, Config(model=("rule", {"rule": _two_turn_rule}), limits=Limits(max_turns=5)))


@query("""SELECT conv_id, turn, 'leaf ' || length(coalesce(text, '')) || ', leaf ' || 2 * length(coalesce(text, '')) || ', leaf 1' AS final_answer, 2 AS turns,
    'done' AS status FROM conversations""")
def session_two_turns(s, d):
    """Sessions whose answer is put together in one turn and called ready in the next."""
    return _two_turns(s, d).select("conv_id", F.col("t").alias("turn"), "final_answer", F.col("turn").alias("turns"), "status")


@query("""SELECT conv_id, turn, i AS iteration, CASE WHEN i = 1 THEN CAST(length(coalesce(text, '')) AS VARCHAR) || chr(10) ELSE '' END AS stdout,
    i = 2 AS answered FROM conversations, (VALUES (1), (2)) v(i)""")
def session_iterations(s, d):
    """The turns of distributed sessions, as trajectories take them."""
    each = iterations(_two_turns(s, d).withColumnRenamed("turn", "turns"), "conv_id", "t")
    return each.select("conv_id", F.col("t").alias("turn"), "iteration", F.col("code_blocks")[0]["result"]["stdout"].alias("stdout"), F.col("final_answer").isNotNull().alias("answered"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
    n AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
    SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 6 HOUR AS ended, count(*) AS n_events FROM n GROUP BY user_id, k""")
def activity_windows(s, d):
    return activity_sessions(table(s, d, "events").select("user_id", "ts"), "user_id", "ts", "6 hours")
