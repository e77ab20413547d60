"""Windows, running totals and joins over whole event tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from brooklog.operators import aggregates as agg
from brooklog.operators.joins import enrich, interval_join
from brooklog.operators.ordered import running_sum
from brooklog.workloads.tables import table

# money is summed in whole cents: sums of doubles depend on their order
CENTS = "cast(round(value * 100) AS bigint)"


def sums():
    return {"n": F.lit(1).cast("bigint"), "cents": F.expr(CENTS)}


def sum_list():
    return [F.sum(expr).alias(name) for name, expr in sums().items()]


def window_tumbling(spark, sf_dir):
    return agg.windowed(
        table(spark, sf_dir, "events"), "ts", "1 day", sum_list(), ["event_type"]
    )


def window_sliding(spark, sf_dir):
    return agg.sliding_sums(
        table(spark, sf_dir, "events"), "ts", "2 days", "1 day", sums(), ["event_type"]
    )


def window_session(spark, sf_dir):
    return agg.session_windows(
        table(spark, sf_dir, "events"), "ts", "6 hours", sums(), ["user_id"]
    )


def running_total(spark, sf_dir):
    events = table(spark, sf_dir, "events").selectExpr(
        "user_id", "ts", "event_id", f"{CENTS} AS cents"
    )
    return running_sum(events, ["user_id"], ["ts", "event_id"], "cents", "running_cents").select(
        "event_id", "user_id", "running_cents"
    )


def accumulated_total(spark, sf_dir):
    return agg.accumulated(table(spark, sf_dir, "events"), ["user_id"], sum_list())


ENRICHED = ["event_id", "user_id", "event_type", "c_name", "c_mktsegment"]


def enrich_customer(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return enrich(events, customer, {"user_id": "c_custkey"}).select(*ENRICHED)


def click_and_purchase(events):
    """Both sides of the click → purchase join, from one batch or stream."""
    clicks = events.where("event_type = 'click'").selectExpr(
        "event_id AS click_id", "user_id", "ts AS click_ts"
    )
    purchases = events.where("event_type = 'purchase'").selectExpr(
        "event_id AS purchase_id", "user_id", "ts AS purchase_ts"
    )
    return clicks, purchases


def click_to_purchase(spark, sf_dir):
    clicks, purchases = click_and_purchase(table(spark, sf_dir, "events"))
    return interval_join(clicks, purchases, ["user_id"], "click_ts", "purchase_ts", "1 day")


QUERIES = {
    f.__name__: f
    for f in (
        window_tumbling,
        window_sliding,
        window_session,
        running_total,
        accumulated_total,
        enrich_customer,
        click_to_purchase,
    )
}

_SUMS = "count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents"

TUMBLING_SQL = f"""
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
       CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end,
       event_type, {_SUMS}
FROM events GROUP BY ALL"""

SLIDING_SQL = f"""
WITH placed AS (
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, value FROM events
  UNION ALL
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) - INTERVAL 1 DAY, event_type, value FROM events)
SELECT window_start, window_start + INTERVAL 2 DAY AS window_end, event_type, {_SUMS}
FROM placed GROUP BY ALL"""

SESSION_SQL = f"""
WITH marked AS (
  SELECT user_id, ts, event_id, value,
         CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                         + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
  FROM events),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM marked)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, {_SUMS}
FROM numbered GROUP BY user_id, session"""

ACCUMULATED_SQL = f"SELECT user_id, {_SUMS} FROM events GROUP BY user_id"

ENRICH_SQL = """
SELECT event_id, user_id, event_type, c_name, c_mktsegment
FROM events LEFT JOIN customer ON user_id = c_custkey"""

PAIRS_SQL = """
SELECT c.event_id AS click_id, c.user_id, c.ts AS click_ts,
       p.event_id AS purchase_id, p.ts AS purchase_ts
FROM events c JOIN events p
  ON c.user_id = p.user_id AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 1 DAY
WHERE c.event_type = 'click' AND p.event_type = 'purchase'"""

ORACLES = {
    "window_tumbling": TUMBLING_SQL,
    "window_sliding": SLIDING_SQL,
    "window_session": SESSION_SQL,
    "running_total": """
SELECT event_id, user_id,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (
         PARTITION BY user_id ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_cents
FROM events""",
    "accumulated_total": ACCUMULATED_SQL,
    "enrich_customer": ENRICH_SQL,
    "click_to_purchase": PAIRS_SQL,
}
