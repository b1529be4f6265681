"""Audit of how filters interact: what each would remove at each step of every order.

Each document has a mask of the filters that it fails. In the lexicographic list of
all orders the orders that begin alike are neighbours, so those in which a mask is
removed at a step are a few intervals of Lehmer ranks. A mask's counts are added at
the beginning of each interval and taken off at its end; the running sum over the
ranks is what every order removes there. Work grows with documents once, and then
with parts x masks only, never with documents x orders.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.store import stored

FILTERS = "ABCDE"

# Which of a document's flags each count is over.
FLAGS = {"removed": "n", "good_lost": "good", "toxic_lost": "toxic"}


def failures(text: Column, min_words: int = 200) -> dict[str, Column]:
    """Conditions A to D on a text that is not null.

    A: fewer words than ``min_words``; B: fewer than half of the words distinct; C: more
    than 3 % of the code points in ``A-Z``; D: any of ``#$%&*|``. Words are runs
    of anything but space and ``\\x09-\\x0D``.
    """
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    n_words = F.size(words)
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": n_words < min_words,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * n_words.cast("long"),
        "C": 100 * capitals.cast("long") > 3 * F.char_length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def _bits(conditions: dict[str, Column]) -> Column:
    bits = [F.when(c, 1 << FILTERS.index(f)).otherwise(0) for f, c in conditions.items()]
    return sum(bits[1:], bits[0])


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the filters that they fail.

    Null texts are empty, a null ``lang`` is the empty part. E compares text and
    ``doc_id``: a row fails it when a row of the same text has a smaller id. A null id is
    neither smaller nor larger than another, so such rows never fail E and make none fail;
    rows equal in id and text do not fail because of each other. A document is good or
    toxic when any row of its id in ``labels`` says so; a row of null id has no labels.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    shape = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
        _bits(failures(text)).alias("mask"),
    )
    # Equal rows are counted before anything is joined, also where a third of the rows are equal.
    rows = shape.groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    rows = stored(rows, "audit-rows")
    first = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("first_id"))
    known = labels.select(
        F.col("doc_id").cast("long").alias("label_id"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"),
    )
    known = known.where("label_id is not null").groupBy("label_id")
    known = known.agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    # Beside the id, the digest spreads rows of a null id; beside the digest, the id spreads copies.
    spread = F.when(F.col("id").isNull(), F.col("digest")).otherwise("")
    rows = rows.withColumn("spread", spread).join(
        known.withColumn("none", F.lit("")), (F.col("id") == F.col("label_id")) & (F.col("spread") == F.col("none")), "left"
    )
    first = first.select(F.col("digest").alias("first_digest"), "first_id")
    rows = rows.join(first, (F.col("id") == F.col("first_id")) & (F.col("digest") == F.col("first_digest")), "left")
    repeats = F.col("id").isNotNull() & F.col("first_id").isNull()
    full = F.col("mask") + F.when(repeats, 1 << FILTERS.index("E")).otherwise(0)
    return rows.groupBy("part", full.alias("mask")).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def intervals(mask: int, filters: str = FILTERS) -> list[tuple[int, int, int]]:
    """(step, first rank, rank after the last) of the orders that remove ``mask`` at that step.

    Every such order begins with filters that the mask passes and goes on with one that
    it fails; orders of one beginning are consecutive ranks.
    """
    size = len(filters)

    def walk(used: int, step: int, base: int):
        unused = [f for f in range(size) if not used >> f & 1]
        width = factorial(size - step)
        for at, f in enumerate(unused):
            begin = base + at * width
            if mask >> f & 1:
                yield step, begin, begin + width
            else:
                yield from walk(used | 1 << f, step + 1, begin)

    return list(walk(0, 1, 0)) if mask else []


def audit(docs: DataFrame, labels: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row per part, order and step, zeros included; an empty table has no part.

    Returns part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley.
    """
    spark, orders = docs.sparkSession, factorial(len(filters))
    counts = stored(masks(docs, labels), "audit-masks")
    ends = [
        (mask, step, rank, sign)
        for mask in range(1 << len(filters))
        for step, begin, end in intervals(mask, filters)
        for rank, sign in ((begin, 1), (end, -1))
        if rank < orders
    ]
    ends = spark.createDataFrame(ends, "mask int, step int, rank int, sign int")
    jumps = counts.join(F.broadcast(ends), "mask").groupBy("part", "step", "rank")
    jumps = jumps.agg(*(F.sum(F.col(c) * F.col("sign")).alias(c) for c in FLAGS.values()))

    names = F.split(F.lit(" ".join("".join(order) for order in permutations(filters))), " ")
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"))
    cells = parts.select("*", F.posexplode(names).alias("rank", "filter_order"))
    cells = cells.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step"))
    cells = cells.withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    grid = cells.join(jumps, ["part", "step", "rank"], "left")
    # At most 120 ranks, or 5 steps, in each of these windows.
    over_ranks = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    sums = {name: F.sum(F.coalesce(F.col(c), F.lit(0))).over(over_ranks) for name, c in FLAGS.items()}
    grid = grid.select("part", "total", "rank", "filter_order", "step", "filter", *(s.alias(c) for c, s in sums.items()))
    over_steps = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    grid = grid.withColumn("kept", F.col("total") - F.sum("removed").over(over_steps))

    bits = [F.struct(F.lit(f).alias("filter"), F.lit(1 << i).alias("bit")) for i, f in enumerate(filters)]
    each = counts.select("*", F.inline(F.array(*bits)))
    fails = F.col("mask").bitwiseAND(F.col("bit")) > 0
    each = each.groupBy("part", "filter").agg(
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n")).otherwise(0)).alias("unique_fails"),
    )
    return grid.join(each, ["part", "filter"]).select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        "kept",
        "removed",
        (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails",
        "good_lost",
        "toxic_lost",
        F.sum("removed").over(Window.partitionBy("part", "filter")).alias("shapley"),
    )
