"""Mixing sources to target weights.

The mix has ``share`` times the words of all documents.  Each source gets its
part by weight, but at most ``max_epochs`` times its own size; what a clamped
source cannot take is spread over the others by weight, again and again until
no source is above its limit (water-filling).

Within a source every document is taken a whole number of times, and the rest
of the target is a seeded part: documents in the order of a hash of their ids
are taken once more until the target is met.  ``take_plan`` counts the words
of the last of them that the target still holds, so a source's taken words are
its target rounded down; ``mix`` takes that document whole or not at all.

The order inside a source is never sorted in one task: documents fall into
hash buckets, the bucket where a source's target ends is found by sums over
coarse and then finer buckets, and only that one is put in order.

Cases: a null text has size 0; a null source is a source of its own, sorted
last; a source without words has target 0; rows with the same id come in the
order of their texts' hashes, rows with the same id and text share a partial
repetition by size (each part rounded down); an empty table gives no rows; a
very long text is only hashed and its words counted, by the JVM.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martline.llm.numbering import numbered
from martline.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_DIGITS = 4  # of the hash in hex: 65,536 buckets per source


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def seeded_order(key: Column, text: Column, seed: str) -> Column:
    """Documents in the order of a hash of their ids, those of equal ids by their texts'."""
    return F.concat(F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))), F.hex(F.xxhash64(text)))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Sources in code-point order, null last, get ``weights`` in turn.  The
    water level, words per unit of weight, rises from round to round; only
    sums over the sources reach the driver.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = per_source.select(F.lit(None).cast("string").alias("all"), F.col("source").isNull().alias("none"), "source", "source_size")
    placed = numbered(ordered, "all", ["none", "source"], f"{ensure_checkpoint_dir(sizes.sparkSession).rstrip('/')}/sources-{uuid.uuid4().hex}")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    table = placed.select("source", "source_size", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight")).checkpoint()
    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    limit = F.lit(float(max_epochs)) * F.col("source_size")
    level, clamped = (0.0, 1.0), -1
    while True:
        # free sources share what the clamped ones leave: level = rest / weight
        above = limit <= F.lit(level[0]) * F.col("weight") / F.lit(level[1]) if clamped >= 0 else F.lit(False)
        n, taken, free = table.agg(F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)),
                                   F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if n == clamped or not free:
            break
        level, clamped = (total - taken, float(free)), n
    target = F.least(limit, F.lit(level[0]) * F.col("weight") / F.lit(level[1]))
    return table.select("source", "source_size", target.alias("target"))


class MixPlan:
    """What each source gives, and how far into its seeded order the last, partial round over it reaches.

    ``sources``: s, source_size, target, whole, rest, last_bucket, before_bucket.
    ``border``: the documents of each source's last bucket, as (s, order,
    given, of): rows of that order give ``given / of`` of their words.
    """

    def __init__(self, sources: DataFrame, border: DataFrame, seed: str):
        self.seed = seed
        self.sources = F.broadcast(sources) if _few(sources) else sources
        self.border = F.broadcast(border) if _few(border) else border

    def apply(self, rows: DataFrame, order: Column, source: Column, size: Column) -> DataFrame:
        """``rows`` plus source_size, target, ``__whole`` repetitions and ``__part``, the words of one more."""
        given = rows.withColumn("__order", order).withColumn("__size", size)
        given = given.join(self.sources, source.eqNullSafe(F.col("s"))).drop("s")
        bucket = F.substring("__order", 1, BUCKET_DIGITS)
        border = self.border.select(F.col("s").alias("__s"), F.col("order").alias("__o"), "given", "of")
        given = given.join(border, source.eqNullSafe(F.col("__s")) & (F.col("__order") == F.col("__o")) & (bucket == F.col("last_bucket")), "left")
        part = (F.when(F.col("rest") <= 0, 0).when(F.col("last_bucket").isNull() | (bucket < F.col("last_bucket")), F.col("__size"))
                .when(F.col("of") > 0, F.floor(F.col("__size") * F.col("given") / F.col("of"))).otherwise(0).cast("bigint"))
        return (given.withColumn("__part", part).withColumnRenamed("whole", "__whole")
                .drop("__s", "__o", "given", "of", "rest", "last_bucket", "before_bucket", "__order", "__size"))


def make_plan(sized: DataFrame, weights: Sequence[int], share: float, max_epochs: float, seed: str) -> MixPlan:
    """Plan from (source, order, size) rows."""
    targets = source_targets(sized, weights, share, max_epochs)
    # floor(target) words of a source: whole rounds over it, then `rest` words of one more round
    goal = F.floor("target").cast("bigint")
    rounds = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("bigint")
    goals = (targets.withColumn("whole", rounds).withColumn("rest", goal - F.col("whole") * F.col("source_size"))
             .withColumnRenamed("source", "s"))
    ranked = sized.select("source", "size", "order")
    # where each source's rest ends, two digits of the hash at a time: no sum runs over more than 256 buckets
    last = goals.select(F.col("s").alias("l"), "rest", F.lit("").alias("last_bucket"), F.lit(0).cast("bigint").alias("before_bucket"))
    for digits in range(2, BUCKET_DIGITS + 1, 2):
        last = _bucket_of_rest(ranked, last, digits).checkpoint()
    last = last.drop("rest")
    sources = goals.join(last, F.col("s").eqNullSafe(F.col("l")), "left").drop("l").checkpoint()
    of_last = sources.where("last_bucket IS NOT NULL").select("s", "last_bucket", "before_bucket", "rest")
    units = (ranked.join(F.broadcast(of_last) if _few(of_last) else of_last, F.col("source").eqNullSafe(F.col("s")) & (F.substring("order", 1, BUCKET_DIGITS) == F.col("last_bucket")))
             .groupBy("s", "order", "before_bucket", "rest").agg(F.sum("size").alias("of")))
    until = F.col("before_bucket") + F.sum("of").over(W.partitionBy("s").orderBy("order").rowsBetween(W.unboundedPreceding, W.currentRow))
    given = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("of"), F.col("rest") - F.col("until") + F.col("of")))
    border = units.withColumn("until", until).select("s", "order", given.alias("given"), "of").checkpoint()
    return MixPlan(sources, border, seed)


def _bucket_of_rest(ranked: DataFrame, upper: DataFrame, digits: int) -> DataFrame:
    """(l, rest, last_bucket, before_bucket): of the bucket each source's rest ends in, the part two digits finer."""
    upper = F.broadcast(upper) if _few(upper) else upper
    inside = ranked.join(upper, F.col("source").eqNullSafe(F.col("l")) & (F.substring("order", 1, digits - 2) == F.col("last_bucket")))
    sums = inside.groupBy("l", "rest", "before_bucket", F.substring("order", 1, digits).alias("bucket")).agg(F.sum("size").alias("in_bucket"))
    upto = F.col("before_bucket") + F.sum("in_bucket").over(W.partitionBy("l").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow))
    ends = sums.withColumn("upto", upto).where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("in_bucket") <= F.col("rest")))
    return ends.select("l", "rest", F.col("bucket").alias("last_bucket"), (F.col("upto") - F.col("in_bucket")).alias("before_bucket"))


def _few(table: DataFrame, limit: int = 100_000) -> bool:
    """Whether a table of narrow rows is small enough to broadcast."""
    return table.count() <= limit


def take_plan(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: str = "mix",
              text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per document: key, source, size, source_size, target, ``whole`` repetitions and ``part``, the words of one more."""
    ensure_checkpoint_dir(docs.sparkSession)
    sized = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"),
                        seeded_order(F.col(f"`{key}`"), F.col(f"`{text}`"), seed).alias("order")).checkpoint()
    plan = make_plan(sized, weights, share, max_epochs, seed)
    done = plan.apply(sized, F.col("order"), F.col("source"), F.col("size"))
    return done.select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target",
                       F.col("__whole").alias("whole"), F.col("__part").alias("part"))


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: str = "mix",
        text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """The mix itself: each document, whole, as often as the plan takes it.

    The document in which a source's partial round ends is taken once more if
    the plan wants half of its words or more, else not, so a source is off its
    target by at most half of that document.  Texts are not shuffled: the plan
    reaches them by source, and by order for the few documents in the bucket
    where a source's target ends.  All columns of ``docs`` are kept.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    t, k = F.col(f"`{text}`"), F.col(f"`{key}`")
    sized = docs.select(F.col(f"`{source}`").alias("source"), word_count(t).alias("size"), seeded_order(k, t, seed).alias("order")).checkpoint()
    plan = make_plan(sized, weights, share, max_epochs, seed)
    # the plan's columns must not meet the input's: everything of the input is kept in one struct
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    row = F.col("__row")
    size = word_count(row[text])
    done = plan.apply(boxed, seeded_order(row[key], row[text], seed), row[source], size)
    copies = F.col("__whole") + F.when((F.col("__part") > 0) & (2 * F.col("__part") >= size), 1).otherwise(0)
    taken = done.withColumn("__copies", copies.cast("int")).where("__copies > 0")
    return taken.withColumn("__copy", F.explode(F.expr("sequence(1, __copies)"))).select(*[row[c].alias(c) for c in docs.columns])
