"""Mixing sources to target weights along a time-varying curriculum.

Each source has a piecewise-linear weight schedule over training time 0..1. The integral of its
schedule is its weight, which fixes the number of words the mix takes from it; its share of the
integral up to time t is its cumulative demand at t. A source's documents, in a fixed shuffled
order, fill that demand one after the other (again and again if the target exceeds the source), so
the training position of a copy is the time at which the demand reaches the copy's first word.

A source is cut into 4,096 hash buckets: bucket totals give each bucket's first word, and running
sums are taken inside (source, bucket) only. A source with a third of all rows is thus spread over
4,096 groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import WORD, fresh, landed

Schedule = Sequence[tuple[float, float]]
#: The production curriculum, integrals 1, 2 and 3: fades in; rises to the middle and falls; fades out.
CYCLE: tuple[Schedule, ...] = (((0.0, 0.0), (1.0, 2.0)), ((0.0, 1.0), (0.5, 3.0), (1.0, 1.0)), ((0.0, 4.0), (1.0, 2.0)))
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _segments(schedule: Schedule) -> list[tuple[float, float, float, float, float]]:
    """(t0, dt, w0, w1, area before) of each piece of a schedule."""
    out, area = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        out.append((t0, t1 - t0, w0, w1, area))
        area += (t1 - t0) * (w0 + w1) / 2
    return out


def integral(schedule: Schedule) -> float:
    return sum(dt * (a + b) / 2 for _, dt, a, b, _ in _segments(schedule))


def _time_of(share: Column, schedule: Schedule) -> Column:
    """The time at which the integral of ``schedule`` reaches ``share`` of its total."""
    want = share * F.lit(integral(schedule))
    out = F.lit(float(schedule[-1][0]))
    for t0, dt, a, b, before in reversed(_segments(schedule)):
        end = before + dt * (a + b) / 2
        if end <= before:
            continue
        x, slope = want - before, (b - a) / dt  # a u + slope u^2 / 2 = x
        inside = 2 * x / (F.lit(a) + F.sqrt(F.greatest(F.lit(0.0), F.lit(a * a) + 2 * slope * x))) if a or slope else F.lit(0.0)
        out = F.when(want < end, F.lit(t0) + F.when(x <= 0, 0.0).otherwise(inside)).otherwise(out)
    return out


def _schedules(cycle) -> list[Schedule]:
    return [[(0.0, float(c)), (1.0, float(c))] if isinstance(c, (int, float)) else [(float(t), float(w)) for t, w in c] for c in cycle]


def source_targets(sizes: DataFrame, weights: Sequence[float], max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size), one row per source -> the same plus slot and target.

    Sources in code point order, null last, take the weights in turn. The total size is shared by
    weight; a target over ``max_epochs`` times its source's size stops there and the excess is
    shared again. Sorted by limit per weight, the sources that stop are a prefix, so running sums
    settle all rounds at once. One row per source in one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    slot = (F.row_number().over(order) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("slot") + 1)
    s = sizes.withColumn("slot", slot).withColumn("w", w).withColumn("most", F.col("source_size") * max_epochs)
    total = Window.partitionBy()
    by_limit = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select(
        "*", (F.sum("source_size").over(total) - F.coalesce(F.sum("most").over(before), F.lit(0))).alias("left"),
        (F.sum("w").over(total) - F.coalesce(F.sum("w").over(before), F.lit(0.0))).alias("w_left"),
    ).withColumn("full", F.col("w") * F.col("left") >= F.col("most") * F.col("w_left"))
    open_left = F.min(F.when(~F.col("full"), F.struct(-F.col("w_left"), "left", "w_left"))).over(total)
    s = s.withColumn("o", open_left)
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.col("w") * F.col("o.left") / F.col("o.w_left"))
    return s.select("source", "source_size", "slot", target.alias("target"))


def mix(
    docs: DataFrame, cycle: Sequence = CYCLE, max_epochs: int = MAX_EPOCHS, seed: str = "mix", id_col: str = "doc_id",
    source_col: str = "source", size: Column | str = "text",
) -> DataFrame:
    """``docs`` plus a struct column ``mix``: size, source_size, target, taken, position and ``copies``.

    ``cycle`` has a weight, or a schedule [(time, weight), ...] from 0 to 1, for each source in
    turn. ``size`` is the text column whose words count, or a column expression. ``taken`` counts
    the words of all passes; the pass in which the target is reached stops inside a document, so a
    source's taken words are its target rounded down. ``position`` is the training position, from 0
    to 1, at which the first of a document's taken words comes; null if none are. ``copies`` lists,
    per pass that takes at least half of the document, its position.

    Null texts have size 0 and are never taken; a null source is a source of its own, ordered
    last. Rows with the same id stand side by side in the order, ordered by their other columns; a
    row without id comes last in its source. An empty table gives an empty result. The result
    depends only on the rows, not on their order or splits.
    """
    schedules = _schedules(cycle)
    size = word_count(F.col(size)) if isinstance(size, str) else size
    n = {k: fresh(docs, f"_{k}") for k in ("n", "h", "g", "s", "b", "before", "at")}
    rows = docs.withColumn(n["n"], size).withColumn(n["h"], F.coalesce(F.md5(F.concat(F.lit(seed + ":"), F.col(id_col).cast("string")).cast("binary")), F.lit("~")))
    rows = rows.withColumn(n["g"], F.col(source_col).isNull()).withColumn(n["s"], F.coalesce(source_col, F.lit(""))).withColumn(n["b"], F.substring(n["h"], 1, 3))
    key = [n["g"], n["s"], n["b"]]
    buckets = landed(rows.groupBy(*key).agg(F.sum(n["n"]).alias("bucket_size")))
    sizes = buckets.groupBy(n["g"], n["s"]).agg(F.sum("bucket_size").alias("source_size"))
    targets = source_targets(
        sizes.select(F.when(~F.col(n["g"]), F.col(n["s"])).alias("source"), "source_size"), [integral(x) for x in schedules], max_epochs
    ).select(F.col("source").isNull().alias(n["g"]), F.coalesce("source", F.lit("")).alias(n["s"]), "source_size", "slot", "target")
    ahead = Window.partitionBy(n["g"], n["s"]).orderBy(n["b"]).rowsBetween(Window.unboundedPreceding, -1)
    plan = buckets.withColumn(n["before"], F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0))).join(targets, [n["g"], n["s"]])
    plan = plan.select(*key, F.struct("source_size", "slot", "target", F.col(n["before"]).alias("before")).alias(n["before"]))

    rest = [F.col(f"`{c}`") for c in docs.columns if c != id_col and not docs.schema[c].dataType.simpleString().startswith("map")]
    inside = Window.partitionBy(*key).orderBy(n["h"], id_col, n["n"], *rest).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(n["at"], F.coalesce(F.sum(n["n"]).over(inside), F.lit(0))).join(plan, key)
    p, size = F.col(n["before"]), F.col(n["n"])
    limit = F.floor(p["target"])
    start = [e * p["source_size"] + p["before"] + F.col(n["at"]) for e in range(max_epochs)]
    words = [F.greatest(F.lit(0).cast("long"), F.least(size, limit - s)) for s in start]
    times = [
        F.element_at(F.array(*[_time_of(s / p["target"], x) for x in schedules]), p["slot"] + 1) for s in start
    ]
    copies = F.array_compact(F.array(*[F.when((w > 0) & (2 * w >= size), F.struct(F.lit(e).alias("pass"), t.alias("position"))) for e, (w, t) in enumerate(zip(words, times))]))
    taken = words[0]
    for w in words[1:]:
        taken = taken + w
    made = F.struct(size.alias("size"), p["source_size"].alias("source_size"), p["target"].alias("target"), taken.alias("taken"), F.when(words[0] > 0, times[0]).alias("position"), copies.alias("copies"))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], made.alias(fresh(docs, "mix")))


def stream(docs: DataFrame, cycle: Sequence = CYCLE, max_epochs: int = MAX_EPOCHS, seed: str = "mix", id_col: str = "doc_id", source_col: str = "source", size: Column | str = "text") -> DataFrame:
    """The training stream: ``docs`` repeated as the mix takes them, range-sorted by position."""
    mixed = mix(docs, cycle, max_epochs, seed, id_col, source_col, size)
    made, at = mixed.columns[-1], fresh(docs, "_position")
    rows = mixed.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.col(made)["copies"]["position"]).alias(at))
    order = [at, F.col(source_col).asc_nulls_last(), id_col]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*[f"`{c}`" for c in docs.columns])
