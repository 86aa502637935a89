"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

A source's target is a number of words. Each of its documents is taken floor(target / size of
the source) times for certain; the rest, a fraction f of the source, is a sample without
replacement. Document i gets a random u from its id and the ranking value
(u / (1 - u)) / (p / (1 - p)), where p = f is its inclusion probability, and the documents with
the lowest values are taken until their words fill the rest of the target. The size that is
fixed is thus the number of words; the last document is taken if that comes nearer the target.

Ranks are found without ordering a source in one task: words are added up for each of ``cells``
equal parts of u, only the part in which the target is reached is ordered exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripledger.llm.common import full_text
from tripledger.staging import Staging

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def word_count(text: Column) -> Column:
    """Words, as runs of anything but ASCII white space, in one pass of a regular expression."""
    marks = F.regexp_replace(text, f"{BLANK}*+{WORD}++{BLANK}*+", ".")
    return F.when(marks.startswith("."), F.length(marks)).otherwise(0).cast("long")


def uniform(key: Column, seed: int) -> Column:
    """A number inside (0, 1) from 48 bits of a hash of the key."""
    bits = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), key.cast("string")), 256),
                              1, 12), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(1 << 48))


def targets(sizes: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from one row per source.

    Sources in code-point order, null last, take the weights in turn. The targets add up to
    ``share`` of all sizes; none goes beyond ``cap`` times its source, the excess goes to the
    others by weight. Capped are the sources with the least cap per weight, so one running sum
    in that order gives the level. One small row per source passes through one task.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    placed = sizes.withColumn("place", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last()))).withColumn("weight", weight)
    room = F.col("source_size") * F.lit(float(cap))
    order = Window.orderBy(F.col("room") / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    stepped = placed.withColumn("room", room).withColumn(
        "left", F.sum("source_size").over(everything) * F.lit(float(share))
        - F.coalesce(F.sum("room").over(before), F.lit(0.0))).withColumn(
        "open", F.sum("weight").over(everything)
        - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    level = F.col("left") / F.col("open")
    free = F.col("room") > level * F.col("weight")
    first = F.struct((F.col("room") / F.col("weight")).alias("ratio"), "place", level.alias("at"))
    leveled = stepped.withColumn("level", F.min(F.when(free, first)).over(everything)["at"])
    target = F.when(F.col("level").isNull(), F.col("room")).otherwise(
        F.least("room", F.col("level") * F.col("weight")))
    return leveled.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, staging: Staging, weights: list[float] = (3, 1, 2), share: float = 1.5,
        cap: float = 2.0, seed: int = 20, cells: int = 4096) -> DataFrame:
    """``doc_id``, ``text_key``, ``size``, ``source_size``, ``target`` and ``copies`` per row.

    Null text has size 0 and a null source is a source of its own. Documents of size 0 are never
    sampled. Rows that repeat an id, a text and a source are interchangeable. An empty table
    gives no rows. Equal input and seed give equal results.
    """
    rows = staging.put(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(full_text()).alias("text_key"),
        F.col("source"), word_count(full_text()).alias("size"),
        uniform(F.col("doc_id"), seed).alias("u")), "sizes")
    aims = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")),
                   list(weights), share, cap)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
                   ).otherwise(0).cast("long")
    aims = staging.put(aims.withColumn("whole", times).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    cell = F.floor(F.col("u") * cells).cast("int")
    sums = rows.withColumn("cell", cell).groupBy("source", "cell").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    last = sums.join(aims.withColumnRenamed("source", "_source"),
                     F.col("source").eqNullSafe(F.col("_source"))).where(
        (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest")))
    last = staging.put(last.select("_source", F.col("cell").alias("edge"), "before"), "edges")
    plan = staging.put(aims.join(last, F.col("source").eqNullSafe(F.col("_source")), "left").drop(
        "_source").withColumnRenamed("source", "_source"), "plan")
    placed = rows.withColumn("cell", cell).join(
        plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    p = F.col("rest") / F.col("source_size")
    ranking = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    upto = Window.partitionBy("source").orderBy("ranking", "doc_id", "text_key").rowsBetween(
        Window.unboundedPreceding, -1)
    inside = placed.where((F.col("cell") == F.col("edge")) & (F.col("size") > 0)).withColumn(
        "ranking", ranking).withColumn(
        "ahead", F.col("before") + F.coalesce(F.sum("size").over(upto), F.lit(0)))
    inside = inside.withColumn("sampled", F.col("ahead") + F.col("size") / 2 <= F.col("rest"))
    others = placed.where(~((F.col("cell") == F.col("edge")) & (F.col("size") > 0))
                          | F.col("edge").isNull()).withColumn(
        "sampled", (F.col("cell") < F.col("edge")) & (F.col("size") > 0))
    columns = ["doc_id", "text_key", "size", "source", "source_size", "target", "whole", "sampled"]
    return others.select(columns).unionByName(inside.select(columns)).select(
        "doc_id", "text_key", "source", "size", "source_size", "target",
        (F.col("whole") + F.coalesce(F.col("sampled"), F.lit(False)).cast("long")).alias("copies"))


def mixed_documents(docs: DataFrame, staging: Staging, **how) -> DataFrame:
    """The rows of ``docs`` that the mix takes at least once, with ``copies`` and ``target``, to which
    columns of these names give way. Rows that repeat an id, a text and a source have the most
    copies that any of them is given. Nulls, empty texts and empty tables as in ``mix``."""
    taken = mix(docs, staging, **how).where("copies > 0").groupBy("doc_id", "text_key", "source").agg(
        F.max("copies").alias("copies"), F.first("target").alias("target"))
    rows = docs.select(F.struct(*[c for c in docs.columns if c not in ("copies", "target")]).alias("row"),
                       F.col("doc_id").cast("long").alias("own_id"), F.xxhash64(full_text()).alias("own_key"),
                       F.col("source").alias("own_source"))
    same = (F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key"))
            & F.col("own_source").eqNullSafe(F.col("source")))
    return rows.join(taken, same).select("row.*", "copies", "target")
