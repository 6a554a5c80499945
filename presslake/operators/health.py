"""Request-log analytics per state key.

A key may own a large share of the log, so no window runs over a whole key. The log is cut into ``chunk``
intervals of time; windows run inside (key, chunk), each chunk is reduced to one summary row, the summaries
are carried along the key, and the carried value is joined back. The result equals the window over the
whole key for any chunk length. Rows are ordered by ``ts``, then ``request_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from presslake.functions.text import is_blocking

CHUNK_SECONDS = 600
KEY = "state_key"
ORDER = ["ts", "request_id"]


def _chunked(log: DataFrame, seconds: int) -> DataFrame:
    ts = F.col("ts")
    if log.schema["ts"].dataType.simpleString() == "timestamp_ntz":
        # Counted from the fields: a detour over the session's zone could change the order.
        second = F.unix_date(ts.cast("date")) * F.lit(86400).cast("long") + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    else:
        second = F.unix_seconds(ts)
    # Rows without a key or a time are no requests. Saying so here keeps the plans of all uses equal, so
    # that they share one shuffle.
    return log.withColumn("_chunk", F.floor(second / seconds)).filter(F.col(KEY).isNotNull() & F.col("_chunk").isNotNull())


def _in_chunk():
    return Window.partitionBy(KEY, "_chunk").orderBy(*ORDER)


def _across():
    return Window.partitionBy(KEY).orderBy("_chunk")


def failure_streak(log: DataFrame, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """``log`` plus ``streak``: failures in a row up to and including each request; a success has 0."""
    found = _with_streak(_chunked(log, chunk_seconds)).select(*log.columns, "streak")
    return found.unionByName(_outside(log).withColumn("streak", F.lit(None).cast("int")))


def _outside(log: DataFrame) -> DataFrame:
    """Rows without a key or a time, which stand in no order; measures over an order are NULL for them."""
    return log.filter(F.col(KEY).isNull() | F.col("ts").isNull())


def _with_streak(chunks: DataFrame) -> DataFrame:
    """Chunked rows with their streak, still partitioned by key and chunk."""
    failed = F.when(F.col("success"), 0).otherwise(1)
    w = _in_chunk().rowsBetween(Window.unboundedPreceding, 0)
    local = (
        chunks.withColumn("_f", F.sum(failed).over(w))
        .withColumn("_base", F.max(F.when(F.col("success"), F.col("_f"))).over(w))
    )
    summary = local.groupBy(KEY, "_chunk").agg(
        F.max("_f").alias("_fails"), F.max("_base").alias("_last")
    )
    # The streak that enters a chunk: the failures since the last chunk with a success, its tail included.
    past = _across().rowsBetween(Window.unboundedPreceding, -1)
    run = _across().rowsBetween(Window.unboundedPreceding, 0)
    carried = (
        summary.withColumn("_total", F.sum("_fails").over(run))
        .withColumn("_reset", F.when(F.col("_last").isNotNull(), F.col("_total") - F.col("_fails") + F.col("_last")))
        .withColumn(
            "_carry",
            F.coalesce(F.col("_total") - F.col("_fails"), F.lit(0)) - F.coalesce(F.max("_reset").over(past), F.lit(0)),
        )
        .select(KEY, "_chunk", "_carry")
    )
    streak = F.when(F.col("_base").isNotNull(), F.col("_f") - F.col("_base")).otherwise(F.col("_f") + F.col("_carry"))
    return (
        local.join(carried, [KEY, "_chunk"])
        .withColumn("streak", streak.cast("int"))
        .select(*chunks.columns, "streak")
    )


def recent_failure_rate(log: DataFrame, k: int = 10, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """``log`` plus ``recent_failures`` and ``recent_rate`` among the key's last ``k`` requests, once ``k`` exist."""
    failed = F.when(F.col("success"), 0).otherwise(1)
    place = F.row_number().over(_in_chunk())
    recent = F.sum(failed).over(_in_chunk().rowsBetween(-(k - 1), 0))
    back = Window.partitionBy(KEY, "_chunk").orderBy(*[F.desc(c) for c in ORDER])
    chunks = _chunked(log, chunk_seconds)
    local = chunks.withColumn("_rn", place).withColumn("_recent", recent)
    # At most k - 1 outcomes leave a chunk, oldest first; the k - 1 chunks before hold all that can matter.
    tail = (
        chunks.withColumn("_back", F.row_number().over(back))
        .filter(F.col("_back") <= k - 1)
        .groupBy(KEY, "_chunk")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("o"), failed.alias("f")))).alias("_tail"))
    )
    window = _across().rowsBetween(-(k - 1), -1)
    carried = tail.select(
        KEY, "_chunk", F.flatten(F.collect_list(F.transform("_tail", lambda x: x["f"])).over(window)).alias("_before")
    )
    missing = F.greatest(F.lit(k) - F.col("_rn"), F.lit(0))
    # A key's first chunk has nothing before it, and for k = 1 no outcome leaves a chunk.
    before = F.coalesce("_before", F.array().cast("array<int>"))
    borrowed = F.slice(F.col("_before"), F.greatest(F.size("_before") - missing + 1, F.lit(1)), missing)
    complete = (F.col("_rn") >= k) | (F.size("_before") >= missing)
    total = F.col("_recent") + F.aggregate(borrowed, F.lit(0), lambda a, x: a + x)
    return (
        local.join(carried, [KEY, "_chunk"], "left")
        .withColumn("_before", before)
        .withColumn("recent_failures", F.when(complete, total).cast("int"))
        .withColumn("recent_rate", F.col("recent_failures") / F.lit(float(k)))
        .select(*log.columns, "recent_failures", "recent_rate")
        .unionByName(
            _outside(log).select("*", F.lit(None).cast("int").alias("recent_failures"), F.lit(None).cast("double").alias("recent_rate"))
        )
    )


def adaptive_delay(rate: Column, hour: Column) -> Column:
    """Seconds between requests: 1, times 3 above half failures or 2 above 30 %, times 1.5 at peak hours."""
    factor = F.when(rate > 0.5, 3.0).when(rate > 0.3, 2.0).otherwise(1.0)
    return factor * F.when(hour.between(8, 10) | hour.between(17, 19), 1.5).otherwise(1.0)


def pattern_factor(recent_failures: Column) -> Column:
    """Factor on the retry delay: 2 when three of the last five requests failed."""
    return F.when(recent_failures >= 3, 2.0).otherwise(1.0)


def across_keys(log: DataFrame) -> DataFrame:
    """The log as one sequence, for measures over all keys; time chunks keep it distributed."""
    return log.withColumn(KEY, F.lit("all"))


def block_intervals(log: DataFrame, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """One row per blocking failure: blocked from ``ts`` for 30 s per failure in a row, at most 300 s.

    The next success or blocking failure of the key ends the interval early.
    """
    chunks = _chunked(log, chunk_seconds)
    blocking = is_blocking(F.col("success"), F.col("error_type"))
    ends = F.when(F.col("success") | blocking, F.col("ts"))
    after = _in_chunk().rowsBetween(1, Window.unboundedFollowing)
    local = _with_streak(chunks).withColumn("_blocking", blocking).withColumn("_next", F.min(ends).over(after))
    first = chunks.groupBy(KEY, "_chunk").agg(F.min(ends).alias("_first"))
    later = _across().rowsBetween(1, Window.unboundedFollowing)
    following = first.withColumn("_later", F.min("_first").over(later)).select(KEY, "_chunk", "_later")
    seconds = F.least(F.lit(300), F.lit(30) * F.col("streak"))
    planned = F.col("ts") + F.make_dt_interval(secs=seconds)
    return (
        local.filter("_blocking")
        .join(following, [KEY, "_chunk"])
        .select(
            KEY,
            "request_id",
            F.col("ts").alias("blocked_from"),
            F.least(planned, F.coalesce("_next", "_later")).alias("blocked_until"),
            "streak",
            "error_type",
        )
    )


def last_outcomes(log: DataFrame) -> DataFrame:
    """Most recent success and failure per key."""
    return log.groupBy(KEY).agg(
        F.max(F.when(F.col("success"), F.col("ts"))).alias("last_success"),
        F.max(F.when(~F.col("success"), F.col("ts"))).alias("last_failure"),
    )


def request_statistics(log: DataFrame, as_of: Column | None = None, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Requests, successes, success rate and current streak per key, and a ``total`` row over all rows.

    Rows without a key are a key of their own (NULL); rows without a time count, but stand in no streak.

    With ``as_of`` also whether the key is blocked at that time: its last request is then a blocking
    failure, or follows one without an intervening success, and the period has not run out.
    """
    streaks = failure_streak(log, chunk_seconds)
    blocking = is_blocking(F.col("success"), F.col("error_type"))
    place = F.struct("ts", "request_id")
    until = F.col("ts") + F.make_dt_interval(secs=F.least(F.lit(300), F.lit(30) * F.col("streak")))
    per_key = streaks.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("success")).alias("successes"),
        F.max_by("streak", place).alias("current_streak"),
        F.max(F.when(F.col("success"), place)).alias("_ok"),
        F.max(F.when(blocking, F.struct("ts", "request_id", until.alias("until")))).alias("_block"),
    )
    blocked_until = F.when(
        F.col("_ok").isNull() | (F.struct("_block.ts", "_block.request_id") > F.col("_ok")), F.col("_block.until")
    )
    keys = per_key.select(
        KEY, "requests", "successes", "current_streak",
        (F.coalesce(blocked_until > as_of, F.lit(False)) if as_of is not None else F.lit(None).cast("boolean")).alias("blocked"),
    )
    # The total is made of the keys' rows, in the same scan, and of one row without requests, which an empty log needs.
    both = keys.select(F.explode(F.array(F.lit(False), F.lit(True))).alias("_all"), "*")
    nothing = log.sparkSession.range(1).select(
        F.lit(True).alias("_all"), F.lit(None).cast("string").alias(KEY), F.lit(0).cast("long").alias("requests"),
        F.lit(0).cast("long").alias("successes"), F.lit(None).cast("int").alias("current_streak"), F.lit(None).cast("boolean").alias("blocked"),
    )
    own = lambda c: F.max(F.when(~F.col("_all"), F.col(c))).alias(c)
    grouped = both.unionByName(nothing).groupBy("_all", F.when(~F.col("_all"), F.col(KEY)).alias(KEY)).agg(
        F.sum("requests").alias("requests"), F.sum("successes").alias("successes"), own("current_streak"), own("blocked")
    )
    rate = F.when(F.col("requests") > 0, F.col("successes") * 100.0 / F.col("requests")).otherwise(F.lit(0.0))
    named = grouped.withColumn(KEY, F.when(F.col("_all"), F.lit("total")).otherwise(F.col(KEY)))
    return named.drop("_all").withColumn("success_rate", rate)
