"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found per document by pattern: the base kinds, and added ones (further
keyed values, passwords in addresses, private key blocks, opaque tokens of mixed
characters, and the forms of some services). Their values are hashed and aggregated over
the whole corpus by distinct owners and distinct repositories: a value that several owners
carry in several repositories is a copied example; one that stays with few owners looks
live, in however many of their texts it is. Base candidates are always reported;
candidates of the added kinds are reported where they look live. Which reported
spans look live is told besides.

Scale: one pass over the text yields a slim written table (lengths and 8-byte
hashes of the few matches); offsets are running sums in a window per document and
kind, and the ownership counts are distinct-then-count aggregations that combine
before the shuffle, so an example key copied into a third of all rows costs each
map task one row per owner and repository.

Defined results: null and empty texts have no spans (the digest is that of the
empty string); a null owner is one owner; repeated rows are each reported, and
count once towards ownership; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh import scratch
from quillmesh.llm import _text


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: The base patterns, then the added ones. The group that is the secret, and the least length of match or group.
ASSIGN = "(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    ("assign", ASSIGN, 2, 12),
    ("access", "AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", "[0-9a-f]{16,}", 0, 16),
)
KEYED = "(" + "|".join(_either_case(w) for w in ("pwd", "passphrase", "credentials?", "auth_?key", "private_?key", "access_?key", "client_?key")) + ")" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ADDED = (
    ("github", "gh[pousr]_[A-Za-z0-9]{30,}", 0, 34),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("stripe", "[rs]k_live_[A-Za-z0-9]{16,}", 0, 24),
    ("google", "AIza[A-Za-z0-9_-]{30,}", 0, 34),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 29),
    ("keyed", KEYED, 2, 12),
    ("address", r"[A-Za-z][A-Za-z0-9+.-]{1,19}://[^\x20\x09-\x0D:/@]{1,64}:([^\x20\x09-\x0D/@]{1,256})@", 1, 6),
    ("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]+-----END", 0, 60),
    ("opaque", "[A-Za-z0-9+/_-]{24,}", 0, 24),
)
#: An opaque token has characters of all of these.
MIXED = ("[0-9]", "[a-z]", "[A-Z]")
KINDS = BASE + ADDED


@dataclass(frozen=True)
class Ownership:
    """A value carried by more owners and more repositories than this is a copied example."""

    max_owners: int = 2
    max_repositories: int = 2


def _candidates(text: Column, matches: Column, kind: int) -> Column:
    """Matches of one kind as (kind, at, gap before, length, long enough, hash of the secret)."""
    name, pattern, group, least = KINDS[kind]
    secret = (lambda m: F.regexp_extract(m, pattern, group)) if group else (lambda m: m)
    mixed = (lambda m: reduce(and_, [m.rlike(p) for p in MIXED])) if name == "opaque" else lambda m: F.lit(True)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    zipped = F.arrays_zip(matches.alias("m"), F.slice(gaps, F.lit(1), F.size(matches)).alias("gap"), F.sequence(F.lit(1), F.size(matches)).alias("at"))
    return F.transform(
        zipped,
        lambda z: F.struct(
            F.lit(kind).alias("kind"),
            z["at"].alias("at"),
            z["gap"].alias("gap"),
            F.length(z["m"]).alias("len"),
            ((F.length(secret(z["m"])) >= least) & mixed(z["m"])).alias("ok"),
            F.xxhash64(secret(z["m"])).alias("value"),
        ),
    )


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """A written table with one row per row of ``docs``: row, doc_id, owner, repository, found."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(owner).alias("owner"), _text.whole(F.col(text)).alias("text"))
    d = d.select("*", *[F.regexp_extract_all("text", F.lit(p), 0).alias(f"m{k}") for k, (_, p, _, _) in enumerate(KINDS)])
    found = F.concat(*[_found(k) for k in range(len(KINDS))])
    d = d.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "owner", F.xxhash64("text", F.length("text")).alias("repository"), found.alias("found")
    )
    return scratch.table(d, "secrets")


EMPTY = "cast(array() as array<struct<kind:int,at:int,gap:int,len:int,ok:boolean,value:bigint>>)"


def _found(kind: int) -> Column:
    m = F.col(f"m{kind}")
    return F.when(F.size(m) > 0, _candidates(F.col("text"), m, kind)).otherwise(F.expr(EMPTY))


def ownership(spans: DataFrame, limits: Ownership) -> DataFrame:
    """value, live for every candidate value of the corpus."""
    def distinct(of: str, name: str) -> DataFrame:
        return spans.select("value", of).distinct().groupBy(F.col("value").alias(f"value_{name}")).agg(F.count("*").alias(name))

    owners, repositories = distinct("owner", "owners"), distinct("repository", "repositories")
    return owners.join(repositories, F.col("value_owners") == F.col("value_repositories")).select(
        F.col("value_owners").alias("of_value"),
        ((F.col("owners") <= limits.max_owners) | (F.col("repositories") <= limits.max_repositories)).alias("live"),
    )


def secret_scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", limits: Ownership = Ownership()
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, live_spans, n_live, n_example."""
    slim = scan(docs, doc_id, text, owner)
    each = slim.select("row", "owner", "repository", F.explode("found").alias("f")).select("row", "owner", "repository", "f.*")
    so_far = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = (
        each.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(so_far))
        .filter("ok")
        .select("row", "owner", "repository", "kind", "value", (F.col("end") - F.col("len")).alias("start"), "end")
    )
    spans = scratch.table(spans, "secret-spans")
    judged = spans.join(ownership(spans, limits), F.col("value") == F.col("of_value"), "left")

    base = F.col("kind") < len(BASE)
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    item = F.struct("start", "kind", "end")
    joined = lambda items: F.array_join(
        F.transform(F.array_sort(items), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )
    of_doc = (
        judged.groupBy(F.col("row").alias("span_row"))
        .agg(
            *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{name}") for k, (name, *_) in enumerate(BASE)],
            F.collect_list(F.when(base, item)).alias("base_spans"),
            F.collect_list(F.when(base | F.col("live"), item)).alias("all_spans"),
            F.collect_list(F.when(F.col("live"), item)).alias("live_spans"),
            F.count(F.when(F.col("live"), 1)).alias("n_live"),
            F.count(F.when(~F.col("live"), 1)).alias("n_example"),
        )
        .select(
            "span_row",
            *[f"n_{name}" for name, *_ in BASE],
            joined(F.col("base_spans")).alias("base"),
            joined(F.col("all_spans")).alias("spans"),
            joined(F.col("live_spans")).alias("live_spans"),
            "n_live",
            "n_example",
        )
    )
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return slim.select("row", "doc_id").join(of_doc, F.col("row") == F.col("span_row"), "left").select(
        "doc_id",
        *[count(f"n_{name}") for name, *_ in BASE],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("live_spans", F.lit("")).alias("live_spans"),
        count("n_live"),
        count("n_example"),
    )
