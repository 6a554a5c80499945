"""Request-log analytics over ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.catalog.inputs import LOG, request_log
from presslake.catalog.registry import query
from presslake.operators import health as H

_TS = "'%Y-%m-%d %H:%M:%S.%f'"
STREAKS = f"""{LOG}, islands AS (SELECT *, sum(success::INT) OVER (PARTITION BY state_key ORDER BY ts, request_id) AS g FROM log),
  streaks AS (SELECT *, sum((NOT success)::INT) OVER (PARTITION BY state_key, g ORDER BY ts, request_id)::INT AS streak FROM islands)"""
_BLOCKING = "NOT success AND error_type IN ('ssl_error', 'connection_error')"
BLOCKS = f"""{STREAKS}, nexts AS (SELECT *, min(CASE WHEN success OR ({_BLOCKING}) THEN ts END) OVER (PARTITION BY state_key ORDER BY ts, request_id
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_end FROM streaks),
  blocks AS (SELECT state_key, request_id, ts AS blocked_from, least(ts + to_seconds(least(300, 30 * streak)), coalesce(next_end, TIMESTAMP '9999-01-01')) AS blocked_until,
      ts + to_seconds(least(300, 30 * streak)) AS planned, streak, error_type FROM nexts WHERE {_BLOCKING})"""


def _text(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)


@query(f"WITH {STREAKS} SELECT request_id, state_key, streak FROM streaks")
def failure_streak(spark, sf_dir):
    return H.failure_streak(request_log(spark, sf_dir)).select("request_id", "state_key", "streak")


def _rate_sql(k: int, key: str = "state_key") -> str:
    return f"""WITH {LOG}, r AS (SELECT *, sum((NOT success)::INT) OVER (PARTITION BY {key} ORDER BY ts, request_id ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)::INT AS f,
      row_number() OVER (PARTITION BY {key} ORDER BY ts, request_id) AS rn FROM log),
  v AS (SELECT request_id, hour(ts) AS h, CASE WHEN rn >= {k} THEN f END AS recent_failures, CASE WHEN rn >= {k} THEN f / {k}::DOUBLE END AS recent_rate FROM r)
  SELECT request_id, recent_failures, recent_rate, CASE WHEN recent_rate > 0.5 THEN 3.0 WHEN recent_rate > 0.3 THEN 2.0 ELSE 1.0 END::DOUBLE
    * CASE WHEN h BETWEEN 8 AND 10 OR h BETWEEN 17 AND 19 THEN 1.5 ELSE 1.0 END AS delay, CASE WHEN recent_failures >= 3 THEN 2.0 ELSE 1.0 END::DOUBLE AS factor FROM v"""


def _rates(rows):
    return rows.select(
        "request_id", "recent_failures", "recent_rate", H.adaptive_delay(F.col("recent_rate"), F.hour("ts")).alias("delay"),
        H.pattern_factor(F.col("recent_failures")).alias("factor"),
    )


@query(_rate_sql(10))
def recent_failure_rate(spark, sf_dir):
    return _rates(H.recent_failure_rate(request_log(spark, sf_dir), 10))


@query(_rate_sql(5))
def recent_failure_rate_5(spark, sf_dir):
    """The same with other cuts of time: the result does not depend on the chunk length."""
    return _rates(H.recent_failure_rate(request_log(spark, sf_dir), 5, chunk_seconds=86400 * 3))


@query(_rate_sql(10, "1"))
def recent_failure_rate_all_keys(spark, sf_dir):
    """All requests as one sequence."""
    return _rates(H.recent_failure_rate(H.across_keys(request_log(spark, sf_dir)), 10))


@query(f"WITH {BLOCKS} SELECT state_key, request_id, strftime(blocked_from, {_TS}) AS blocked_from, strftime(blocked_until, {_TS}) AS blocked_until, streak, error_type FROM blocks")
def block_intervals(spark, sf_dir):
    rows = H.block_intervals(request_log(spark, sf_dir))
    return rows.select("state_key", "request_id", _text("blocked_from"), _text("blocked_until"), "streak", "error_type")


@query(f"""WITH {LOG} SELECT state_key, strftime(max(ts) FILTER (success), {_TS}) AS last_success, strftime(max(ts) FILTER (NOT success), {_TS}) AS last_failure FROM log GROUP BY 1""")
def last_outcomes(spark, sf_dir):
    return H.last_outcomes(request_log(spark, sf_dir)).select("state_key", _text("last_success"), _text("last_failure"))


_AS_OF = "2024-01-30 12:00:00"


@query(f"""WITH {BLOCKS}, ends AS (SELECT state_key, arg_max(streak, struct_pack(ts, request_id)) AS current_streak, max(struct_pack(ts, request_id)) FILTER (success) AS ok FROM streaks GROUP BY 1),
  last_block AS (SELECT state_key, max(struct_pack(ts := blocked_from, request_id := request_id)) AS b, arg_max(planned, struct_pack(blocked_from, request_id)) AS until FROM blocks GROUP BY 1),
  keys AS (SELECT state_key, count(*) AS requests, count(*) FILTER (success) AS successes FROM log GROUP BY 1)
  SELECT state_key, requests, successes, current_streak, coalesce((ok IS NULL OR b > ok) AND until > TIMESTAMP '{_AS_OF}', false) AS blocked,
    round(successes * 100.0 / requests, 6)::DOUBLE AS success_rate FROM keys JOIN ends USING (state_key) LEFT JOIN last_block USING (state_key)
  UNION ALL SELECT 'total', count(*), count(*) FILTER (success), NULL, NULL, round(count(*) FILTER (success) * 100.0 / count(*), 6) FROM log""")
def request_statistics(spark, sf_dir):
    out = H.request_statistics(request_log(spark, sf_dir), F.lit(_AS_OF).cast("timestamp"))
    return out.withColumn("success_rate", F.round("success_rate", 6))
