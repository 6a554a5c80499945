"""Request health per state key, kept up to date by micro-batches.

A micro-batch is reduced to one summary row per key by grouped aggregations, which begin in the tasks, and the summaries
are merged with a table of states in hash buckets. No task meets all requests of a key, however many it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from presslake.functions.text import is_blocking
from presslake.operators.health import KEY
from presslake.streaming import upserts

STATE = (
    "state_key STRING, requests BIGINT, successes BIGINT, streak INT, last_success TIMESTAMP,"
    " last_failure TIMESTAMP, blocked_until TIMESTAMP"
)


def hourly_success_rate(log: DataFrame, late: str = "1 hour") -> DataFrame:
    """Requests and successes per key and hour; native windowed aggregation, combined before the shuffle."""
    return (
        log.withWatermark("ts", late)
        .groupBy(F.window("ts", "1 hour").alias("hour"), KEY)
        .agg(F.count(F.lit(1)).alias("requests"), F.count_if(F.col("success")).alias("successes"))
        .select(F.col("hour.start").alias("hour"), KEY, "requests", "successes")
    )


def summaries(log: DataFrame) -> DataFrame:
    """One row per key: counts, the last success, failures since it, and the last blocking failure that is still open.

    ``tail`` counts the failures behind the last success (all, if there is none); ``open_tail`` those up to the open
    block's beginning. Each is a count or a maximum, so all are combined in the tasks first. Requests stand in order of
    time, then ``request_id``; those without a key or a time are left out, as they have no place in an order.
    """
    place = F.struct("ts", "request_id")
    ok = F.coalesce("success", F.lit(False))
    rows = log.filter(F.col(KEY).isNotNull() & F.col("ts").isNotNull()).select(
        KEY, place.alias("place"), ok.alias("ok"), is_blocking(F.col("success"), F.col("error_type")).alias("severe")
    )
    ends = rows.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if("ok").alias("successes"),
        F.max(F.when(F.col("ok"), F.col("place"))).alias("won"),
        F.max(F.when(~F.col("ok"), F.col("place"))).alias("lost"),
        F.max(F.when(F.col("severe"), F.col("place"))).alias("block"),
    )
    # The sides meet by key with one row per key on one of them: a hot key's failures may be split over tasks.
    marks = ends.select(KEY, "won", "block")
    behind = rows.filter(~F.col("ok")).join(marks, KEY).filter(F.col("won").isNull() | (F.col("place") > F.col("won")))
    tails = behind.groupBy(KEY).agg(F.count(F.lit(1)).alias("tail"), F.count_if(F.col("place") <= F.col("block")).alias("open_tail"))
    open_ = F.col("won").isNull() | (F.col("block") > F.col("won"))
    count = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return ends.join(tails, KEY, "left").select(
        KEY, "requests", "successes", F.col("won.ts").alias("last_success"), F.col("lost.ts").alias("last_failure"),
        F.when(open_, F.col("block.ts")).alias("block"), count("tail"), count("open_tail"),
    )


def advanced(old: DataFrame, new: DataFrame) -> DataFrame:
    """States ``old`` after the ``summaries`` ``new`` of later requests; keys without new requests stay as they are."""
    zero, none = F.lit(0).cast("long"), F.col("n.requests").isNull()
    both = lambda c: (F.coalesce(f"o.{c}", zero) + F.coalesce(f"n.{c}", zero)).alias(c)
    # A streak goes on where the new requests have no success before the place in question.
    carried = F.when(F.col("n.last_success").isNull(), F.coalesce("o.streak", F.lit(0))).otherwise(F.lit(0))
    seconds = F.least(F.lit(300).cast("long"), 30 * (carried + F.col("n.open_tail"))).cast("int")
    blocked = (
        F.when(none, F.col("o.blocked_until"))
        .when(F.col("n.block").isNotNull(), F.col("n.block") + F.make_dt_interval(secs=seconds))
        .when(F.col("n.last_success").isNull(), F.col("o.blocked_until"))
    )
    later = lambda c: F.greatest(f"o.{c}", f"n.{c}").alias(c)
    return old.alias("o").join(new.alias("n"), F.col(f"o.{KEY}") == F.col(f"n.{KEY}"), "full_outer").select(
        F.coalesce(f"n.{KEY}", f"o.{KEY}").alias(KEY),
        both("requests"),
        both("successes"),
        F.when(none, F.col("o.streak")).otherwise((carried + F.col("n.tail")).cast("int")).alias("streak"),
        later("last_success"),
        later("last_failure"),
        blocked.alias("blocked_until"),
    )


def latest_state(spark: SparkSession, root: str, as_of: Column | None = None) -> DataFrame:
    """The state of each key below ``root``; a block that has run out by ``as_of`` is over (``blocked_until`` is null)."""
    states = upserts.stored(spark, root, T.StructType.fromDDL(STATE))
    if as_of is None:
        return states
    return states.withColumn("blocked_until", F.when(F.col("blocked_until") > as_of, F.col("blocked_until")))


def keep_health(log: DataFrame, root: str, checkpoint: str, buckets: int = 64) -> DataStreamWriter:
    """A stream of requests into the states below ``root``; older requests of a key must not come in a later micro-batch.

    A micro-batch reads and rewrites the buckets of its keys only; one that is repeated starts from the states before it.
    """

    def save(batch: DataFrame, number: int) -> None:
        new = summaries(batch).persist()
        upserts.rewrite(new, number, root, [KEY], advanced, buckets, STATE)
        new.unpersist()

    return log.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
