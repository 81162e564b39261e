"""The registered queries of this subpackage and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh import scratch
from quillmesh.llm import _linear, language_id, mixing, pairwise_quality
from quillmesh.llm import secret_scan as secrets
from quillmesh.llm.bpe_chunks import digests, encode
from quillmesh.llm.exact_dedup import exact_dedup
from quillmesh.llm.html_extract import extract_pages
from quillmesh.llm.jaccard_join import Similarity, jaccard_components
from quillmesh.llm.sharding import ShardStore
from quillmesh.llm.quality_rules import MAX_REPEATED_PERCENT, MIN_WORDS, LineLimits, cleaned, quality_rules


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(documents(spark, sf_dir))
    return found.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, verdicts = exact_dedup(documents(spark, sf_dir))
    return verdicts.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules(documents(spark, sf_dir))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_words", "kept"
    )


def line_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(documents(spark, sf_dir)).select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.fit(docs.filter(_linear.learnable(F.col("doc_id"))))
    found = language_id.predict(docs, model)
    return found.select("doc_id", _linear.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


#: What the contract of the Jaccard join asks for: three words, 90 of 100.
OP6 = Similarity(words=3, num=90, den=100, cells=3, apart=1, margin=0.1)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, classes = jaccard_components(documents(spark, sf_dir), OP6)
    return classes.select("doc_id", "n_shingles", "component_id")


def jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, classes = jaccard_components(documents(spark, sf_dir), OP6, counted=True)
    return classes.select("doc_id", "n_shingles", "component_id", "n_links")


def op7_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = ShardStore(spark, scratch.new_path(spark, "shards"))
    schema = documents(spark, sf_dir).schema
    store.ingest(f"{sf_dir}/documents.parquet", schema, files_per_arrival=8, checkpoint=scratch.new_path(spark, "arrivals"))
    return store.located("doc_id")


def op8_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(documents(spark, sf_dir), tokenizer_path()))


def op9_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(_linear.learnable(F.col("doc_id")))
    found = pairwise_quality.score(docs, pairwise_quality.fit(docs, labels))
    return found.select("doc_id", _linear.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_entropy_mix": op1_entropy_mix,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_html_extract": op3_html_extract,
    "op4_line_frequency": op4_line_frequency,
    "line_removal": line_removal,
    "op5_language_id": op5_language_id,
    "op6_jaccard_join": op6_jaccard_join,
    "jaccard_links": jaccard_links,
    "op7_compaction": op7_compaction,
    "op8_bpe_chunks": op8_bpe_chunks,
    "op9_pairwise_quality": op9_pairwise_quality,
    "op10_secret_scan": op10_secret_scan,
}

_W = r"[^\x20\x09-\x0D]+"


def quality_sql(source: str = "documents", limits: LineLimits = LineLimits()) -> str:
    """CTEs up to ``verdict``: the base counts, removed words and verdict of each row of ``source``."""
    return rf"""
    d AS (SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t FROM {source}),
    w AS (SELECT rid, regexp_extract_all(t, '{_W}') AS w FROM d),
    g AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
    g3 AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n FROM g),
    rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, i + unnest([0, 1, 2]) AS p FROM g3 WHERE n > 1) GROUP BY rid),
    raw AS (SELECT rid, host, doc_id, t, unnest(string_split(t, chr(10))) AS l FROM d),
    ln AS (SELECT rid, host, doc_id, t, l, len(regexp_extract_all(l, '{_W}')) AS n,
        lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS k FROM raw WHERE regexp_matches(l, '{_W}')),
    dup AS (SELECT rid, count(*) - count(DISTINCT l) AS n FROM ln GROUP BY rid),
    hosts AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY host),
    spread AS (SELECT host, k, count(DISTINCT t) AS n, arg_min(t, coalesce(doc_id, 9223372036854775807)) AS first_text FROM ln GROUP BY host, k),
    above AS (SELECT s.host, s.k, s.first_text FROM spread s JOIN hosts h ON s.host IS NOT DISTINCT FROM h.host
        WHERE s.n > {limits.min_docs} OR s.n > {limits.least} AND s.n > {limits.host_share} * h.n),
    off AS (SELECT DISTINCT ln.t, ln.k FROM ln JOIN above a ON ln.k = a.k AND ln.host IS NOT DISTINCT FROM a.host WHERE ln.t <> a.first_text),
    gone AS (SELECT rid, sum(ln.n) AS n FROM ln JOIN off ON ln.k = off.k AND ln.t = off.t GROUP BY rid),
    base AS (SELECT d.rid, d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(d.t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_words
        FROM d JOIN w USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN gone USING (rid)),
    verdict AS (SELECT *, base_failed = false AND n_words - removed_words >= {limits.min_left} * n_words
            AND n_words - removed_words >= {MIN_WORDS} AS kept
        FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed FROM base))"""


def secret_sql(limits: secrets.Ownership = secrets.Ownership()) -> str:
    quoted = lambda p: p.replace("'", "''")
    kinds = " UNION ALL ".join(
        f"SELECT rid, owner, t, {k} AS kind, '{name}' AS name, {group} AS grp, {least} AS least, '{quoted(p)}' AS p, "
        f"regexp_extract_all(t, '{quoted(p)}') AS m, "
        + (f"regexp_extract_all(t, '{quoted(p)}', {group})" if group else f"regexp_extract_all(t, '{quoted(p)}')")
        + f" AS v, string_split_regex(t, '{quoted(p)}') AS gaps FROM d"
        for k, (name, p, group, least) in enumerate(secrets.KINDS)
    )
    n = len(secrets.BASE)
    mixed = " AND ".join(f"regexp_matches(v, '{p}')" for p in secrets.MIXED)
    return f"""WITH
    d AS (SELECT row_number() OVER () AS rid, doc_id, source AS owner, coalesce(text, '') AS t FROM documents),
    c AS ({kinds}),
    e AS (SELECT rid, owner, t, kind, name, least, unnest(range(1, len(m) + 1)) AS i, m, v, gaps FROM c WHERE len(m) > 0),
    s AS (SELECT rid, owner, t, kind, name, least, v[i] AS v, length(m[i]) AS n,
        sum(length(gaps[i]) + length(m[i])) OVER (PARTITION BY rid, kind ORDER BY i) AS stop FROM e),
    ok AS (SELECT *, stop - n AS start FROM s WHERE length(v) >= least AND (name <> 'opaque' OR {mixed})),
    own AS (SELECT v, count(DISTINCT coalesce('s' || owner, 'n')) <= {limits.max_owners}
        OR count(DISTINCT t) <= {limits.max_repositories} AS live FROM ok GROUP BY v),
    j AS (SELECT ok.*, live, name || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS item FROM ok JOIN own USING (v)),
    a AS (SELECT rid, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
        string_agg(item, ',' ORDER BY start, kind) FILTER (kind < {n}) AS base,
        string_agg(item, ',' ORDER BY start, kind) FILTER (kind < {n} OR live) AS spans,
        string_agg(item, ',' ORDER BY start, kind) FILTER (live) AS live_spans,
        count(*) FILTER (live) AS nl, count(*) FILTER (NOT live) AS ne FROM j GROUP BY rid)
    SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(live_spans, '') AS live_spans, coalesce(nl, 0) AS n_live, coalesce(ne, 0) AS n_example
    FROM d LEFT JOIN a USING (rid)"""


def jaccard_sql(words: int = 3, num: int = 90, den: int = 100) -> str:
    """All pairs with a shingle in common, then components by reachability."""
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""WITH RECURSIVE
    d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({lowered}, '{_W}') AS w FROM documents),
    s AS (SELECT DISTINCT rid, array_to_string(w[i:i + {words - 1}], ' ') AS x
        FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - {words - 2}, 2))) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
    p AS (SELECT a.rid AS a, b.rid AS b, count(*) AS i FROM s a JOIN s b ON a.x = b.x AND a.rid < b.rid GROUP BY a.rid, b.rid),
    l AS (SELECT a, b FROM p JOIN n AS na ON na.rid = a JOIN n AS nb ON nb.rid = b WHERE {den} * i >= {num} * (na.n + nb.n - i)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r(a, b) AS (SELECT rid, rid FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
    c AS (SELECT r.a AS rid, min(doc_id) AS component_id FROM r JOIN d ON d.rid = r.b GROUP BY r.a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d LEFT JOIN n USING (rid) JOIN c USING (rid)"""


def jaccard_links_sql() -> str:
    """The classes, and the pairs that link counted for each row."""
    ctes, found = jaccard_sql().rsplit("\n", 1)
    return f"""{ctes},
    k AS (SELECT a AS rid, count(*) AS n_links FROM e GROUP BY a)
    {found.replace("component_id FROM", "component_id, coalesce(n_links, 0) AS n_links FROM")} LEFT JOIN k USING (rid)"""


def line_removal_sql(limits: LineLimits = LineLimits()) -> str:
    """The texts of rows that are kept, line by line without those above the limit."""
    return rf"""WITH {quality_sql(limits=limits)},
    z AS (SELECT rid, t, unnest(string_split(t, chr(10))) AS l, unnest(range(len(string_split(t, chr(10))))) AS i FROM d),
    y AS (SELECT *, lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS k FROM z),
    o AS (SELECT rid, string_agg(l, chr(10) ORDER BY i) AS text FROM y LEFT JOIN off ON y.k = off.k AND y.t = off.t WHERE off.k IS NULL GROUP BY rid)
    SELECT v.doc_id, d.host AS source, coalesce(o.text, '') AS text FROM verdict v JOIN d USING (rid) LEFT JOIN o USING (rid) WHERE kept"""


ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": """WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
    g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS n FROM d GROUP BY t)
    SELECT doc_id, keep_id, n AS group_size,
        row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST, rid DESC) = 1 AS kept, sha256(t) AS text_sha256
    FROM d JOIN g USING (t)""",
    "op4_line_frequency": f"""WITH {quality_sql()}
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words, kept FROM verdict""",
    "line_removal": line_removal_sql(),
    "op6_jaccard_join": jaccard_sql(),
    "jaccard_links": jaccard_links_sql(),
    "op10_secret_scan": secret_sql(),
}
