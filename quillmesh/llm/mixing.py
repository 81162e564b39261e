"""Mixing sources to target weights by entropy balancing.

Each source gets a target of words. The document rates that meet all targets
while staying closest, in bounded relative entropy, to a rate of one are
exponentially tilted: the odds rate / (cap - rate) of a document are
exp(lambda * z), with one multiplier lambda per source and z the document's size
over the source's mean size. The multipliers solve the convex dual; Newton's
iterations on it are aggregations over a histogram of sizes. The rates are then
rounded to whole copies: a document gets its rate's whole part, and one copy more
if a hash of it, less the rate's fraction, is below the source's cut. The cut is the
weighted quantile at which the source's words come up to its target; two further
cuts do the same for what is then missing, among the documents that still fit.

Scale: the text is read once into a slim written table. Newton works on distinct
(source, size) pairs. The cut is found by a few rounds of bucket sums. What a
document gets depends on its own row and its source's one row of the plan alone,
so there is no shuffle or window over documents, and a source with a third of all
rows is no special case. The plan has a row per source; it is broadcast only while
it is small. The few global windows run over that plan.

Defined results: null text has size 0; a null source is a source, last in order;
repeated rows get equal copies, and then the target is met as nearly as the
repeats allow; sources that tie are stopped together; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh import scratch
from quillmesh.llm import _text

#: Weights by source in code point order, repeating; share of all sizes to take; most copies of a document.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2
#: Newton ends at this relative distance from the targets, or after this many iterations.
TOLERANCE = 1e-9
MAX_ITERATIONS = 60
#: Sums of words are taken in whole fractions of a word, so that their order doesn't matter and reruns agree.
FRACTIONS = float(1 << 20)
#: Cuts a source; buckets and rounds of the search for each: 2 / BUCKETS**ROUNDS is the last bucket's width.
PASSES, BUCKETS, ROUNDS = 3, 4096, 2


Hint = Callable[[DataFrame], DataFrame]


def source_targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Adds ``target`` to rows of (source, source_size): shares by weight, stopped at cap times the source's size,
    the excess reshared. With sources in order of cap * size / weight, those before the first whose share stays below
    its stop are stopped, and the rest share what is left."""
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(by_name)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (n - 1) % len(weights) + 1)
    d = sources.withColumn("weight", weight).withColumn("stop", F.lit(float(cap)) * F.col("source_size"))
    d = d.withColumn("at", F.col("stop") / F.col("weight"))
    order = Window.orderBy("at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.lit(float(share)) * F.sum("source_size").over(everything)
    d = d.withColumn("place", F.row_number().over(order))
    d = d.withColumn("level", (budget - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    first = F.min(F.when(F.col("level") < F.col("at"), F.struct("place", "level"))).over(everything)  # by the order of the levels, ties included
    d = d.withColumn("level", F.coalesce(first["level"], F.lit(float("inf"))))
    return d.withColumn("target", F.least("stop", F.col("level") * F.col("weight"))).select(*sources.columns, "target")


def _rate(cap: float) -> Column:
    """The tilted rate of a document of size ``size`` under its source's multiplier."""
    z = F.col("size") / F.col("mean_size")
    return (
        F.when((F.col("target") <= 0) | (F.col("size") == 0), F.lit(0.0))
        .when(F.col("target") >= F.lit(float(cap)) * F.col("source_size"), F.lit(float(cap)))
        .otherwise(F.lit(float(cap)) / (1 + F.exp(-F.col("lam") * z)))
    )


def _of_source(rows: DataFrame, plan: DataFrame, hint: Hint) -> DataFrame:
    """Rows with their source's row of the plan."""
    plan = hint(plan.withColumnRenamed("source", "plan_source"))
    return rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")


def _hint(plan: DataFrame) -> Hint:
    """Broadcasts plans with as many rows as this one if these are few, and leaves them to shuffle otherwise."""
    few = plan.limit(scratch.BROADCAST_ROWS + 1).count() <= scratch.BROADCAST_ROWS
    return F.broadcast if few else lambda df: df


def multipliers(hist: DataFrame, plan: DataFrame, hint: Hint, cap: float = CAP) -> DataFrame:
    """Newton's iterations on the dual; ``hist`` has source, size, n; adds ``lam`` to the plan."""
    free = (F.col("target") > 0) & (F.col("target") < F.lit(float(cap)) * F.col("source_size"))
    state = plan.withColumn("free", free).withColumn(
        "lam", F.when(F.col("free"), F.log(F.col("target") / (float(cap) * F.col("source_size") - F.col("target")))).otherwise(0.0)
    )
    state = state.withColumn("lo", F.lit(float("-inf"))).withColumn("hi", F.lit(float("inf")))
    state = scratch.table(state, "mix-dual")
    words, z = F.col("n") * F.col("size"), F.col("size") / F.col("mean_size")
    exact = lambda c: F.sum((c * FRACTIONS).cast("decimal(38,0)")).cast("double") / FRACTIONS  # noqa: E731  in whatever order rows come
    for _ in range(MAX_ITERATIONS):
        w = _rate(cap)
        sums = (
            _of_source(hist, state.filter("free"), hint)
            .groupBy(F.col("source").alias("of"))
            .agg(exact(words * w).alias("got"), exact(words * z * w * (1 - w / float(cap))).alias("slope"))
        )
        over = F.col("got") > F.col("target")
        step = F.greatest(F.least((F.col("got") - F.col("target")) / F.col("slope"), F.lit(4.0)), F.lit(-4.0))
        moved = (
            state.join(sums, F.col("source").eqNullSafe(F.col("of")), "left")
            .withColumn("off", F.coalesce(F.abs(F.col("got") - F.col("target")) / F.col("target"), F.lit(0.0)))
            .withColumn("lo", F.when(~over, F.col("lam")).otherwise(F.col("lo")))
            .withColumn("hi", F.when(over, F.col("lam")).otherwise(F.col("hi")))
            .withColumn("next", F.when(F.col("slope") > 0, F.col("lam") - step).otherwise(F.col("lam") + F.when(over, -4.0).otherwise(4.0)))
            .withColumn(
                "next",
                F.when((F.col("next") > F.col("lo")) & (F.col("next") < F.col("hi")), F.col("next")).otherwise((F.col("lo") + F.col("hi")) / 2),
            )
            .withColumn("lam", F.when(F.col("free") & (F.col("off") > TOLERANCE), F.col("next")).otherwise(F.col("lam")))
            .select(*state.columns, "off")
        )
        moved = scratch.table(moved, "mix-dual")
        before, state = state, moved.drop("off")
        scratch.free(before)
        state.scratch_path = moved.scratch_path
        if not moved.filter(F.col("off") > TOLERANCE).limit(1).count():
            break
    return state.drop("free", "lo", "hi")


def _parts(cap: float) -> tuple[Column, Column]:
    """Whole part of the rate and the point at which a document's further copy is cut off."""
    rate = F.col("rate")
    whole = F.floor(rate)
    return whole.alias("whole"), F.when(rate > whole, F.col("u") - (rate - whole)).alias("point")


def _copied(cuts: Column) -> Column:
    """Whether one of the cuts gives the document a further copy."""
    return F.exists(cuts, lambda c: (F.col("size") <= c["most"]) & (F.col("point") < c["cut"]))


def cuts(rows: DataFrame, plan: DataFrame, hint: Hint, cap: float = CAP) -> DataFrame:
    """Adds ``cuts`` to the plan; ``rows`` has source, size and u, a hash of the row within [0, 1).

    The first cut stays below the target; the next adds, among documents no larger than what is still missing; the
    last, among documents up to twice that large, is set where the sum comes nearest."""
    none = F.expr("cast(array() as array<struct<most:double,cut:double>>)")
    state = plan.withColumns({"cuts": none, "below": F.lit(0.0), "most": F.lit(float("inf"))})
    for k in range(PASSES):
        last, room = k == PASSES - 1, 2.0 if k == PASSES - 2 else 1.0
        state = state.withColumns({"lo": F.lit(-1.0), "wide": F.lit(2.0)})
        for _ in range(ROUNDS):
            state = _narrowed(rows, scratch.table(state, "mix-cut"), hint, cap)
        cut = F.when(F.lit(last) & (F.col("words") - F.col("short") < F.col("short")), F.col("lo") + F.col("wide")).otherwise(F.col("lo"))
        state = state.select(
            *plan.columns,
            F.concat("cuts", F.array(F.struct("most", cut.alias("cut")))).alias("cuts"),
            "below",
            (F.greatest("short", F.lit(0.0)) * room).alias("most"),
        )
    return scratch.table(state.select(*plan.columns, "cuts"), "mix-plan")


def _narrowed(rows: DataFrame, state: DataFrame, hint: Hint, cap: float) -> DataFrame:
    """Narrows [lo, lo + wide) of each source to the bucket in which its words reach the target; adds ``short``, what
    is missing at the bucket's start, and ``words``, what the bucket holds."""
    each = _of_source(rows, state, hint).withColumn("rate", _rate(cap)).select("*", *_parts(cap))
    inside = (F.col("point") >= F.col("lo")) & (F.col("point") < F.col("lo") + F.col("wide"))
    inside = inside & (F.col("size") <= F.col("most")) & ~_copied(F.col("cuts"))
    bucket = F.least(F.floor((F.col("point") - F.col("lo")) / F.col("wide") * BUCKETS), F.lit(BUCKETS - 1))
    sums = each.groupBy("source", F.when(inside, bucket).otherwise(-1).alias("bucket")).agg(
        F.sum(F.when(inside, F.col("size")).otherwise(0)).cast("double").alias("bucket_words"),
        F.sum(F.col("whole") * F.col("size")).cast("double").alias("whole_words"),
    )
    w = Window.partitionBy("source")
    sums = sums.withColumn("upto", F.sum("bucket_words").over(w.orderBy("bucket"))).withColumn("sure", F.sum("whole_words").over(w))
    need = F.col("target") - F.col("sure") - F.col("below")
    at = F.struct("bucket", "upto", F.col("bucket_words").alias("words"))
    picked = (
        _of_source(sums, state.select("source", "target", "below"), hint)
        .withColumn("need", need)
        .groupBy(F.col("source").alias("of"))
        .agg(
            F.min(F.when((F.col("bucket") >= 0) & (F.col("upto") >= F.col("need")), at)).alias("hit"),
            F.max(F.when(F.col("bucket") >= 0, at)).alias("last"),
            F.first("need").alias("need"),
        )
        .select("of", F.coalesce("hit", "last").alias("hit"), "need")
    )
    kept = [c for c in state.columns if c not in ("lo", "wide", "below", "short", "words")]
    found, before, narrow = F.col("hit").isNotNull(), F.col("hit.upto") - F.col("hit.words"), F.col("wide") / BUCKETS
    return state.drop("words").join(picked, F.col("source").eqNullSafe(F.col("of")), "left").select(
        *kept,
        F.when(found, F.col("lo") + F.col("hit.bucket") * narrow).otherwise(F.col("lo")).alias("lo"),
        F.when(found, narrow).otherwise(F.col("wide")).alias("wide"),
        (F.col("below") + F.when(found, before).otherwise(0.0)).alias("below"),
        (F.coalesce("need", F.lit(0.0)) - F.when(found, before).otherwise(0.0)).alias("short"),
        F.coalesce("hit.words", F.lit(0.0)).alias("words"),
    )


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> list[Column]:
    """Columns source, size and u of a document."""
    shuffled = F.shiftrightunsigned(F.xxhash64(F.col(doc_id), F.col(text)), 11) * F.lit(2.0**-53)
    return [F.col(source).alias("source"), _text.n_words(F.col(text)).alias("size"), shuffled.alias("u")]


def mix_plan(rows: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """A written table with a row per source: source, source_size, mean_size, target, lam, cuts."""
    hist = scratch.table(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-sizes")
    sources = hist.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean_size"),
    )
    plan = scratch.table(source_targets(sources, weights, share, cap), "mix-targets")
    hint = _hint(plan)
    return cuts(rows, multipliers(hist, plan, hint, cap), hint, cap)


def with_copies(rows: DataFrame, plan: DataFrame, cap: int = CAP) -> DataFrame:
    """Rows having source, size and u, with their plan row's columns, ``rate`` and ``copies``."""
    each = _of_source(rows, plan, _hint(plan)).withColumn("rate", _rate(cap)).select("*", *_parts(cap))
    extra = F.when(_copied(F.col("cuts")), 1).otherwise(0)
    return each.withColumn("copies", (F.col("whole") + extra).cast("int")).drop("whole", "point")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **kind) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, rate, copies, taken."""
    rows = scratch.table(docs.select(F.col(doc_id).alias("doc_id"), *sized(docs, doc_id, text, source)), "mix-rows")
    plan = mix_plan(rows, **kind)
    out = with_copies(rows, plan, kind.get("cap", CAP))
    return out.select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **kind) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it has copies (empty texts have none)."""
    columns = docs.columns
    rows = scratch.table(docs.select(*sized(docs, doc_id, text, source)), "mix-rows")
    plan = mix_plan(rows, **kind)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), *sized(docs, doc_id, text, source))
    out = with_copies(packed, plan, kind.get("cap", CAP))
    repeated = out.filter("copies > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*[F.col("doc")[c].alias(c) for c in columns])
