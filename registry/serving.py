"""Serving queries over the whole event fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendmill.functions import pseudonym
from lendmill.plans import serving as S
from lendmill.sources import testviews as V

from registry.base import Domain, Query, portable, rounded, sql

_THROUGHPUT = f"""SELECT date_trunc('minute', ingested_at) AS minute, event_type, country_code, count(*) AS event_count,
  {rounded('avg(lag_s)', 3)} AS avg_lag_seconds,
  {rounded('percentile_cont(0.95) WITHIN GROUP (ORDER BY lag_s)', 3)} AS p95_lag_seconds
FROM event_fact {{where}} GROUP BY 1, 2, 3"""
_DAY = f"WHERE ingested_at >= TIMESTAMP '{V.AS_OF}' - INTERVAL 24 HOUR"

QUERIES: dict[str, Query] = {
    "event_throughput": Query(
        lambda spark, sf: portable(S.event_throughput(Domain(spark, sf).events, V.AS_OF)),
        sql(_THROUGHPUT.format(where=_DAY), "event_fact"),
    ),
    "event_throughput_history": Query(
        lambda spark, sf: portable(S.event_throughput(Domain(spark, sf).events)),
        sql(_THROUGHPUT.format(where=""), "event_fact"),
    ),
    "throughput_series": Query(
        lambda spark, sf: portable(S.throughput_series(Domain(spark, sf).events, V.AS_OF, 1440)),
        sql(
            f"""SELECT minute, event_type, CAST(sum(event_count) AS BIGINT) AS event_count,
              {rounded('avg(avg_lag_seconds)', 3)} AS avg_lag_seconds, max(p95_lag_seconds) AS p95_lag_seconds,
              {rounded('sum(avg_lag_seconds * event_count) / sum(event_count)', 3)} AS weighted_avg_lag_seconds
            FROM ({_THROUGHPUT.format(where=_DAY)}) WHERE minute >= TIMESTAMP '{V.AS_OF}' - INTERVAL 1440 MINUTE GROUP BY 1, 2""",
            "event_fact",
        ),
    ),
    "recent_events": Query(
        lambda spark, sf: portable(S.recent_events(Domain(spark, sf).events, 200)),
        sql(
            f"""SELECT event_id, event_type, occurred_at, ingested_at, source_system, country_code,
              left(customer_id, 8) || '…' AS customer_token, {rounded('CAST(lag_s AS DOUBLE)', 3)} AS lag_seconds, trace_id
            FROM event_fact ORDER BY ingested_at DESC, event_id DESC LIMIT 200""",
            "event_fact",
        ),
    ),
    "ingestion_summary": Query(
        lambda spark, sf: portable(S.ingestion_summary(Domain(spark, sf).events, V.AS_OF)),
        sql(
            f"""SELECT count(*) AS total_events, max(ingested_at) AS latest_event_at,
              count(*) FILTER (WHERE ingested_at >= TIMESTAMP '{V.AS_OF}' - INTERVAL 5 MINUTE) AS events_5m,
              greatest(0.0::DOUBLE, epoch_us(TIMESTAMP '{V.AS_OF}' - max(ingested_at)) / 1e6) AS latest_event_age_seconds
            FROM event_fact""",
            "event_fact",
        ),
    ),
    "pseudonymous_customers": Query(
        lambda spark, sf: portable(
            V.table(spark, sf, "customer").select(
                "c_custkey", pseudonym("c_name", "pepper").alias("name_hash"), F.char_length(pseudonym("c_name", "pepper")).alias("hash_length")
            )
        ),
        "SELECT c_custkey, sha256('pepper:' || c_name) AS name_hash, CAST(length(sha256('pepper:' || c_name)) AS INTEGER) AS hash_length FROM customer",
    ),
}
