"""Streams drained over the event table, each with the SQL of its batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import streams as S


def _stream(spark, sf_dir):
    return S.events(spark, f"{sf_dir}/events.parquet", "30 days")


def ntz(df):
    return df.withColumn("start", F.col("start").cast("timestamp_ntz"))


QUERIES = {
    "stream_tumbling": (lambda s, d: ntz(S.drained(S.tumbling(_stream(s, d)), "complete")), "select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n from events group by all"),
    "stream_sessions": (
        lambda s, d: ntz(S.drained(S.sessions(_stream(s, d)), "complete")),
        "with c as (select user_id, ts, case when ts >= lag(ts) over w + interval '3 hours' or lag(ts) over w is null then 1 else 0 end as cut from events window w as (partition by user_id order by ts)), g as (select *, sum(cut) over (partition by user_id order by ts rows unbounded preceding) as k from c) select user_id, min(ts) as start, count(*) as n from g group by user_id, k",
    ),
    "stream_distinct": (lambda s, d: S.drained(S.distinct(_stream(s, d), ["user_id", "event_type"]), "append"), "select distinct user_id, event_type from events"),
    "stream_heartbeats": (
        lambda s, d: S.drained(S.heartbeats(_stream(s, d), 21600), "update"),
        "with e as (select user_id, coalesce(epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts) > 21600000000, false) as cut from events) select user_id, count(*) as n, cast(sum(case when cut then 1 else 0 end) as bigint) as restarts from e group by all",
    ),
}
