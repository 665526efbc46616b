"""Mixing sources to target weights (operator 7), DataFrame functions only.

Entropy balancing of documents: find rates ``0 <= r <= most`` that minimise
``sum (r ln r - r + 1)`` over the documents such that the tokens taken from
each source, ``sum size * r``, reach its target.  The convex dual has one
multiplier per source and its solution is the exponential tilt
``r = min(most, exp(lambda[source] * size))``.  Sizes enter by size class
(documents of one class share the class's mean size; the tokens stay exact).

The dual is solved by Newton's method.  Every iteration is one distributed
aggregate over the class table, which gives the tokens reached (gradient) and
their derivative (Hessian, diagonal as a document lies in one source) of all
sources together; the multipliers are written as a table, and only the largest
relative error reaches the driver.  A step that leaves the bracket known to
hold the root is replaced by halving it, so the iteration always ends.  The
terms are summed as decimals, so multipliers depend on no order of rows.

Rates become whole copies: every document gets ``floor(r)`` copies, and one
more copy goes to some documents so that the tokens follow the target from the
largest documents down to the smallest (the deficit left by large documents is
made up by smaller ones).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflens.llm.common import numbered, stash

WORD = r"[^\x20\x09-\x0D]+"
TOLERANCE = 1e-6  # of a source's target, within which the iteration must meet it
FINEST = 64  # sizes below are classes of their own; above, 64 classes per octave


def count_words(text):
    """Words of a text (null: 0), without building them."""
    clean = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w")
    return F.length(F.regexp_replace(clean, r"[\x20\x09-\x0D]+", "")).cast("long")


def _class(size):
    """Size class: exact below FINEST, then logarithmic steps of 1/64 octave
    (about 64 classes per factor of two, whatever the input)."""
    return F.when(size < FINEST, size).otherwise(F.floor(F.log2(size.cast("double")) * 64).cast("long") + 1_000)


def source_targets(masses: DataFrame, weights, most: float = 3.0) -> DataFrame:
    """``(source, mass)`` -> targets: each source's weight (``weights`` repeating
    over the sources by code point, null last) of the total mass, none above
    ``most`` times its own mass, the excess shared by weight among the others
    until none is above.  Only two sums per round reach the driver."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = numbered(masses, [F.col("source").asc_nulls_last()], "__rank")
    ranked = stash(ranked.withColumn("weight", F.element_at(cycle, (F.pmod("__rank", F.lit(len(weights))) + 1).cast("int")))
                   .withColumn("ceiling", F.col("mass") * F.lit(float(most))).drop("__rank"), "sources")
    total = ranked.agg(F.sum("mass")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = F.col("ceiling") <= F.col("weight") * F.lit(level)
        n, held, open_weight = ranked.agg(
            F.coalesce(F.sum(over.cast("long")), F.lit(0)), F.coalesce(F.sum(F.when(over, F.col("ceiling"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))).first()
        if n == capped or not open_weight:
            break
        level, capped = (total - held) / open_weight, n
    return ranked.withColumn("target", F.least("ceiling", F.col("weight") * F.lit(level))).drop("weight", "ceiling")


def _rate(lam, mean, most: float):
    """The tilted rate of a class; an infinite multiplier takes all or nothing."""
    tilted = F.when(mean > 0, F.exp(lam * mean)).otherwise(F.lit(1.0))
    return F.least(F.lit(float(most)), tilted)


def reached(cells: DataFrame, state: DataFrame, most: float) -> DataFrame:
    """``state`` with ``got`` (tokens its rates take) and ``slope`` (their
    derivative by the multiplier) of every source: one aggregate over the classes."""
    exact = lambda x: F.coalesce(F.sum(x.cast("decimal(38,9)")), F.lit(0)).cast("double")
    mean = F.col("words") / F.col("n")
    rate = _rate(F.col("lam"), mean, most)
    tokens = F.col("words") * rate
    joined = cells.join(state, F.col("__source").eqNullSafe(F.col("source")))
    return joined.groupBy(*state.columns).agg(
        exact(tokens).alias("got"), exact(F.when(rate < most, tokens * mean)).alias("slope"))


def tilt(cells: DataFrame, targets: DataFrame, most: float = 3.0, tolerance: float = TOLERANCE) -> DataFrame:
    """Newton iterations (see above) over ``cells`` (``__source, __class, n, words``);
    gives ``targets`` (``source, mass, target``) with the multiplier ``lam``.

    Sources without tokens or target get minus infinity (no tokens), those whose target
    is all they can give plus infinity (every document ``most`` times).
    """
    smallest = (cells.where("words > 0").groupBy(F.col("__source").alias("s"))
                .agg(F.min(F.col("words") / F.col("n")).alias("least_mean")))
    mass, target, lam, low, high = (F.col(c) for c in ("mass", "target", "lam", "low", "high"))
    full, none = target >= mass * F.lit(most * (1 - 1e-9)), (mass <= 0) | (target <= 0)
    grow = target > mass
    state = (targets.join(smallest, F.col("source").eqNullSafe(F.col("s")), "left")
             # at these multipliers the smallest documents, hence all, take too few or too many tokens
             .withColumn("low", F.when(grow, F.lit(0.0)).otherwise(F.log(F.try_divide(target, mass.cast("double"))) / F.col("least_mean")))
             .withColumn("high", F.when(grow, F.log(F.lit(float(most))) / F.col("least_mean")).otherwise(F.lit(0.0)))
             .withColumn("lam", F.when(none, F.lit(float("-inf"))).when(full, F.lit(float("inf"))).otherwise(F.lit(0.0)))
             .withColumn("ended", none | full).select("source", "mass", "target", "low", "high", "lam", "ended"))
    got, slope = F.col("got"), F.col("slope")
    newton = lam + F.log(F.try_divide(target, got)) * F.try_divide(got, slope)  # on the logarithm, nearly linear in the multiplier
    middle = (F.when(low > 0, F.sqrt(low * high)).when(high < 0, -F.sqrt(low * high)).otherwise((low + high) / 2))
    while True:
        step = reached(cells, state, most)
        step = (step.withColumn("ended", F.col("ended") | (F.abs(got - target) <= target * tolerance))
                .withColumn("low", F.when(got < target, F.greatest(low, lam)).otherwise(low))
                .withColumn("high", F.when(got > target, F.least(high, lam)).otherwise(high))
                .withColumn("next", F.when((slope > 0) & (newton > low) & (newton < high), newton).otherwise(middle)))
        # a bracket without a number inside cannot get narrower
        step = (step.withColumn("ended", F.col("ended") | (F.col("next") == lam))
                .withColumn("lam", F.when(F.col("ended"), lam).otherwise(F.col("next"))).select(*state.columns))
        state = stash(step, "mix-multipliers")
        if not state.where(~F.col("ended")).limit(1).count():
            return state.select("source", "mass", "target", "lam")


def mix(df: DataFrame, weights=(5, 2, 1), most: float = 3.0, source_col: str = "source",
        text_col: str = "text", key_cols=("doc_id",)) -> DataFrame:
    """``key_cols`` plus ``size, source_size, target, rate, copies, taken``.

    A null source is a source of its own; null and empty texts have size 0
    and get copies like any other row (they take no words).  Ties are broken
    by the hash of the keys, then of the whole row, so reruns agree.  An empty table gives
    an empty result.  No document is taken more than ``most`` times.  ``rate`` is
    the document's tilted rate, the same for all of its source and size class.
    """
    rows = df.select(*[F.col(f"`{c}`") for c in key_cols], F.col(f"`{source_col}`").alias("__source"),
                     count_words(F.col(f"`{text_col}`")).alias("__size"), F.xxhash64(F.col(f"`{text_col}`")).alias("__text"))
    rows = rows.withColumn("__class", _class(F.col("__size"))).withColumn(
        "__hash", F.xxhash64(*[F.col(f"`{c}`") for c in key_cols], "__text"))
    # sorted once: by source, largest class first; row numbers give ranks in a class
    rows = stash(numbered(rows, [F.col("__source").asc_nulls_last(), F.col("__class").desc(), F.col("__size").desc(),
                                 F.col("__hash")], "__row"), "mix-rows")
    cells = (rows.groupBy("__source", "__class")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("__size").alias("words"), F.min("__row").alias("first")))
    cells = stash(cells, "mix-cells")
    masses = cells.groupBy(F.col("__source").alias("source")).agg(F.sum("words").alias("mass"))
    rates = tilt(cells, source_targets(masses, weights, most), most)

    # at most a few thousand size classes per source, whatever its rows
    rated = (cells.join(rates, F.col("__source").eqNullSafe(F.col("source")))
             .withColumn("rate", _rate(F.col("lam"), F.col("words") / F.col("n"), most)))
    listed = rated.groupBy("source", "mass", "target").agg(F.sort_array(F.collect_list(F.struct(
        F.col("__class").alias("c"), "n", "words", "first", "rate")), asc=False).alias("list"))
    zero = F.struct(F.lit(0.0).alias("owed"),
                    F.expr("cast(array() as array<struct<c:bigint,first:bigint,n:bigint,extra:bigint,rate:double>>)").alias("out"))

    def give(acc, cell):
        mean = cell["words"] / cell["n"]
        owed = acc["owed"] + (cell["rate"] - F.floor(cell["rate"])) * cell["words"]
        extra = F.when(mean > 0, F.greatest(F.lit(0), F.least(cell["n"], F.floor(owed / mean + 0.5)))).otherwise(F.lit(0)).cast("long")
        return F.struct((owed - extra * mean).alias("owed"), F.concat(acc["out"], F.array(F.struct(
            cell["c"].alias("c"), cell["first"].alias("first"), cell["n"].alias("n"), extra.alias("extra"),
            cell["rate"].alias("rate")))).alias("out"))

    plan = listed.select("source", "mass", "target", F.explode(F.aggregate("list", zero, give)["out"]).alias("x"))
    plan = stash(plan.select(F.col("source").alias("__s"), F.col("x.c").alias("__c"), F.col("x.first").alias("__first"),
                             F.col("x.n").alias("__n"), F.col("x.extra").alias("__extra"), "mass", "target", F.col("x.rate").alias("rate")), "mix-plan")
    joined = rows.join(plan, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__class") == F.col("__c")))
    place = F.col("__row") - F.col("__first")  # 0 .. n - 1: extras are spread evenly over the class
    taken_to = lambda k: F.expr(f"({k}) * __extra div __n")
    joined = joined.withColumn("__place", place)
    copies = F.floor("rate").cast("long") + taken_to("__place + 1") - taken_to("__place")
    return (joined.withColumn("copies", F.least(copies, F.lit(int(most))))
            .select(*[F.col(f"`{c}`") for c in key_cols], F.col("__size").alias("size"), F.col("mass").alias("source_size"),
                    "target", "rate", "copies", (F.col("copies") * F.col("__size")).alias("taken")))
