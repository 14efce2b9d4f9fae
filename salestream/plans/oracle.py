"""The catalogue's questions in plain SQL over the same tables.

Written from the definition of each question and not from the Spark plans. Sums
of BIGINT are HUGEINT in DuckDB and therefore cast back.
"""

from __future__ import annotations

# The printed reports, stated here again and not taken from the code under test.
_RULE = "─────────────────────────────────────────────────────────────"
LATEST_LAYOUT = f"Janela: %s → %s\nCategoria: %s\nFaturamento: R$ %s\nVolume: %s vendas\n{_RULE}"
CATEGORY_LAYOUT = (
    "Categoria: %s\n  Faturamento Total: R$ %s\n  Volume Total: %s vendas\n"
    f"  Ticket Médio: R$ %s\n{_RULE}"
)
TOP_LAYOUT = f"Janela: %s\nCategoria: %s\nFaturamento: R$ %s\nVolume: %s vendas\n{_RULE}"
EVOLUTION_LAYOUT = "%s | R$ %s | %s vendas"
STATS_LAYOUT = (
    "Total de Janelas Processadas: %s\nFaturamento Total: R$ %s\n"
    "Volume Total de Vendas: %s\nFaturamento Médio por Janela: R$ %s\n"
    "Volume Médio por Janela: %s vendas\nMaior Faturamento em uma Janela: R$ %s\n"
    "Menor Faturamento em uma Janela: R$ %s"
)
DISTRIBUTION_LAYOUT = "%s | %s %s%%"


def _windows(width: str, revenue: str = "sum(value)") -> str:
    return f"""
        SELECT time_bucket(INTERVAL '{width}', ts) AS window_start,
               time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' AS window_end,
               event_type AS category, {revenue} AS revenue, count(event_id) AS sales_count
        FROM events WHERE ts IS NOT NULL GROUP BY ALL"""


_CENTS = "round_even(revenue, 2) AS revenue"
_HOURLY = _windows("1 hour", "round_even(sum(value), 2)")
_W = f"WITH w AS ({_windows('1 hour')})"


# Every 40 minutes a window of 60 minutes starts: an event lies in the window that
# starts at its 40-minute mark, and in the one before if that still covers it.
_UNEVEN = """
    WITH placed AS (
      SELECT time_bucket(INTERVAL '40 minutes', ts, TIMESTAMP '1970-01-01') AS mark, *
      FROM events WHERE ts IS NOT NULL),
    spread AS (
      SELECT mark AS window_start, event_type, value, event_id FROM placed
      UNION ALL
      SELECT mark - INTERVAL '40 minutes', event_type, value, event_id FROM placed
      WHERE ts < mark + INTERVAL '20 minutes')
    SELECT window_start, window_start + INTERVAL '1 hour' AS window_end,
           event_type AS category, round_even(sum(value), 2) AS revenue,
           count(event_id) AS sales_count
    FROM spread GROUP BY ALL"""

_NOON = "TIMESTAMP '2024-01-15 12:00:00'"

_DIRTY = """
    WITH parsed AS (
      SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
             time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
             event_type AS category,
             CASE WHEN event_type <> 'purchase' THEN value END AS amount,
             CASE WHEN event_type <> 'view' THEN event_id END AS sale_id
      FROM events WHERE event_type NOT IN ('error', 'signup') AND ts IS NOT NULL),
    w AS (
      SELECT window_start, window_end, category, sum(amount) AS revenue,
             count(sale_id) AS sales_count
      FROM parsed GROUP BY ALL)"""

_BY_CATEGORY = """
    SELECT category, round_even(coalesce(sum(revenue), 0), 2) AS revenue,
           CAST(sum(sales_count) AS BIGINT) AS sales_count,
           round_even(avg(revenue / nullif(sales_count, 0)), 2) AS avg_ticket,
           round_even(coalesce(sum(revenue), 0) / nullif(sum(sales_count), 0), 2)
             AS weighted_ticket
    FROM w GROUP BY category"""

_LATEST = "FROM w ORDER BY window_start DESC, category LIMIT 10"
_TOP = "FROM w ORDER BY round_even(w.revenue, 2) DESC, window_start DESC, category LIMIT 5"

_EVOLUTION = """
    SELECT window_start, round_even(sum(revenue), 2) AS revenue,
           CAST(sum(sales_count) AS BIGINT) AS sales_count
    FROM (SELECT * FROM w ORDER BY window_start DESC, category LIMIT 20)
    GROUP BY window_start"""

_STATS = """
    SELECT count(*) AS n_rows, count(DISTINCT window_start) AS n_windows,
           round_even(sum(revenue), 2) AS revenue,
           CAST(sum(sales_count) AS BIGINT) AS sales_count,
           round_even(avg(revenue), 2) AS avg_revenue,
           round_even(avg(sales_count), 2) AS avg_sales_count,
           round_even(max(revenue), 2) AS max_revenue,
           round_even(min(revenue), 2) AS min_revenue
    FROM w HAVING count(*) > 0"""

_SHARES = """
    SELECT category, sum(revenue) AS revenue,
           sum(revenue) / (SELECT sum(revenue) FROM w) * 100 AS percent
    FROM w GROUP BY category"""

# One row per hour, category and slice of the events that changed it, with the running sums.
_LOG = """
    WITH part AS (
      SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type AS category,
             event_id % 4 AS slice, sum(value) AS revenue, count(event_id) AS sales_count
      FROM events WHERE ts IS NOT NULL GROUP BY ALL),
    w AS (
      SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, category,
             sum(revenue) OVER so_far AS revenue,
             CAST(sum(sales_count) OVER so_far AS BIGINT) AS sales_count, slice
      FROM part
      WINDOW so_far AS (PARTITION BY window_start, category ORDER BY slice))"""

_DIFF = f"""
    WITH expected AS ({_windows('1 hour')}),
    served AS (
      SELECT window_start,
             CASE WHEN CAST(window_start AS DATE) = DATE '2024-01-08' AND category = 'signup'
                  THEN 'ghost' ELSE category END AS category,
             revenue + CASE WHEN CAST(window_start AS DATE) = DATE '2024-01-06'
                             AND category = 'view' THEN 1 ELSE 0 END AS revenue,
             sales_count
      FROM expected
      WHERE NOT (CAST(window_start AS DATE) = DATE '2024-01-05' AND category = 'click')
      UNION ALL
      SELECT window_start, category, revenue, sales_count FROM expected
      WHERE CAST(window_start AS DATE) = DATE '2024-01-07' AND category = 'error'),
    s AS (
      SELECT window_start, category, sum(revenue) AS revenue,
             CAST(sum(sales_count) AS BIGINT) AS sales_count, count(*) AS n
      FROM served GROUP BY ALL)
    SELECT coalesce(s.window_start, e.window_start) AS window_start,
           coalesce(s.category, e.category) AS category,
           round_even(s.revenue, 2) AS served_revenue,
           round_even(e.revenue, 2) AS expected_revenue,
           coalesce(s.sales_count, 0) AS served_count,
           coalesce(e.sales_count, 0) AS expected_count,
           CASE WHEN s.n IS NULL THEN 'missing' WHEN e.category IS NULL THEN 'unexpected'
                WHEN s.n > 1 THEN 'duplicate' ELSE 'different' END AS status
    FROM s FULL JOIN expected e
      ON s.window_start = e.window_start AND s.category = e.category
    WHERE s.n IS NULL OR e.category IS NULL OR s.n > 1
       OR round_even(s.revenue, 2) IS DISTINCT FROM round_even(e.revenue, 2)
       OR s.sales_count IS DISTINCT FROM e.sales_count"""


def _text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def _printf(layout: str, *values: str) -> str:
    return f"printf('{layout}', {', '.join(values)}) AS line"


def _fixed2(column: str) -> str:
    return f"printf('%.2f', {column})"


def _digits(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


# An hour from every full hour, and one from every half hour.
_SLIDING = " UNION ALL ".join([
    _HOURLY,
    _HOURLY.replace(
        "time_bucket(INTERVAL '1 hour', ts)",
        "time_bucket(INTERVAL '1 hour', ts, INTERVAL '30 minutes')",
    ),
])

# One day's purchases corrected, another day without windows.
_CORRECTED = f"""WITH hours AS ({_windows('1 hour')}),
    w AS (
      SELECT * REPLACE (revenue + CASE WHEN CAST(window_start AS DATE) = DATE '2024-01-10'
               AND category = 'purchase' THEN 100 ELSE 0 END AS revenue)
      FROM hours WHERE CAST(window_start AS DATE) <> DATE '2024-01-12')"""

_TOPIC = """
    WITH placed AS (
      SELECT CAST(event_id % 3 AS INTEGER) AS p, event_id // 3 AS o FROM events),
    held AS (
      SELECT p, o, sum(CASE WHEN o BETWEEN 195 AND 205 OR o % 101 = 7 THEN 2 ELSE 1 END) AS n
      FROM placed WHERE NOT (o BETWEEN 95 AND 104 OR o % 97 IN (13, 14)) GROUP BY ALL),
    steps AS (SELECT p, o, lag(o) OVER (PARTITION BY p ORDER BY o) AS before FROM held),
    islands AS (SELECT p, o, n, o - row_number() OVER (PARTITION BY p ORDER BY o) AS i FROM held WHERE n > 1)
    SELECT 'sales' AS topic, p AS "partition", 'gap' AS kind, before + 1 AS first_offset, o - 1 AS last_offset,
           o - before - 1 AS n_messages
    FROM steps WHERE o > before + 1
    UNION ALL
    SELECT 'sales', p, 'repeat', min(o), max(o), CAST(sum(n - 1) AS BIGINT) FROM islands GROUP BY p, i"""

_QUALITY = """
    WITH told AS (
      SELECT CASE event_type WHEN 'error' THEN 'rejected_sale_id' WHEN 'view' THEN 'rejected_sale_id'
               WHEN 'signup' THEN 'rejected_event_time' WHEN 'purchase' THEN 'rejected_amount'
               ELSE 'valid' END AS metric, event_type FROM events)
    SELECT m.metric, (SELECT count(*) FROM told WHERE told.metric = m.metric) AS n
    FROM (VALUES ('valid'), ('rejected_sale_id'), ('rejected_category'), ('rejected_amount'),
                 ('rejected_event_time')) AS m(metric)
    UNION ALL SELECT 'events', count(*) FROM told
    UNION ALL SELECT 'null_ids', count(*) FROM told WHERE event_type IN ('error', 'view')"""

ORACLE_SQL: dict[str, str] = {
    "windowed_sales_1m": _windows("1 minute", "round_even(sum(value), 2)"),
    "windowed_sales_1h": _HOURLY,
    "windowed_sales_sliding": _SLIDING,
    "windowed_sales_sliding_uneven": _UNEVEN,
    "window_from_events": f"""{_W}
        SELECT window_start, window_end, category, {_CENTS}, sales_count FROM w
        WHERE category = 'purchase' AND window_start = {_NOON}""",
    "envelope_round_trip": _HOURLY,
    "dirty_windowed_sales": f"""{_DIRTY}
        SELECT window_start, window_end, category, {_CENTS}, sales_count FROM w""",
    "dirty_revenue_by_category": _DIRTY + _BY_CATEGORY,
    "event_quality": """
        SELECT CASE event_type WHEN 'error' THEN 'sale_id' WHEN 'view' THEN 'sale_id'
                 WHEN 'signup' THEN 'event_time' WHEN 'purchase' THEN 'amount'
                 ELSE 'valid' END AS verdict,
               count(*) AS n_events
        FROM events GROUP BY 1""",
    "split_rejects": """
        SELECT CASE event_type WHEN 'error' THEN 'sale_id' WHEN 'view' THEN 'sale_id'
                 WHEN 'signup' THEN 'event_time' ELSE 'amount' END AS reject_reason,
               count(*) AS n_events,
               count(*) FILTER (event_type = 'error') AS n_not_json
        FROM events WHERE event_type <> 'click' GROUP BY 1""",
    "partition_profile": """
        SELECT 'sales' AS topic, CAST(event_id % 3 AS INTEGER) AS "partition",
               min(event_id // 3) AS first_offset, max(event_id // 3) AS last_offset,
               count(*) AS n_messages,
               max(event_id // 3) - min(event_id // 3) + 1 - count(*) AS gaps
        FROM events GROUP BY 2""",
    "peek_messages": """
        SELECT CAST(event_id % 3 AS INTEGER) AS "partition", event_id // 3 AS "offset",
               printf('{"id_pedido":"%d","categoria":"%s","valor":%s,"timestamp":"%s"}',
                      event_id, event_type, CAST(value AS VARCHAR),
                      replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', ''))
                 AS message
        FROM events ORDER BY 1, 2 LIMIT 10""",
    "offset_gaps": _TOPIC,
    "latest_windows": f"""{_W}
        SELECT window_start, window_end, category, {_CENTS}, sales_count {_LATEST}""",
    "top_windows": f"""{_W}
        SELECT window_start, window_end, category, {_CENTS}, sales_count {_TOP}""",
    "revenue_by_category": _W + _BY_CATEGORY,
    "time_evolution": _W + _EVOLUTION,
    "general_stats": _W + _STATS,
    "category_distribution": f"""{_W}, shares AS ({_SHARES})
        SELECT category, {_CENTS}, round_even(percent, 2) AS percent FROM shares""",
    "category_totals": f"""{_W}
        SELECT category, round_even(sum(revenue), 2) AS revenue FROM w GROUP BY category""",
    "top_categories": f"""{_W}
        SELECT category, round_even(sum(revenue), 2) AS revenue,
               CAST(sum(sales_count) AS BIGINT) AS sales_count
        FROM w GROUP BY category ORDER BY round_even(sum(revenue), 2) DESC, category LIMIT 5""",
    "count_rows": f"{_W} SELECT count(*) AS n_rows FROM w",
    "find_window": f"""{_W}
        SELECT window_start, window_end, category, {_CENTS}, sales_count FROM w
        WHERE category = 'purchase' AND window_start = {_NOON}""",
    "serving_documents": f"""{_W}
        SELECT window_start AS janela_inicio, window_end AS janela_fim,
               category AS categoria, round_even(revenue, 2) AS faturamento_total,
               sales_count AS volume_vendas
        FROM w""",
    "latest_windows_lines": f"""{_W} SELECT {_printf(
        LATEST_LAYOUT, _text("window_start"), _text("window_end"), "category",
        _fixed2("revenue"), _digits("sales_count"))} {_LATEST}""",
    "revenue_by_category_lines": f"""{_W}, report AS ({_BY_CATEGORY}) SELECT {_printf(
        CATEGORY_LAYOUT, "category", _fixed2("revenue"), _digits("sales_count"),
        _fixed2("avg_ticket"))} FROM report""",
    "top_windows_lines": f"""{_W} SELECT {_printf(
        TOP_LAYOUT, _text("window_start"), "category", _fixed2("revenue"),
        _digits("sales_count"))} {_TOP}""",
    "time_evolution_lines": f"""{_W}, report AS ({_EVOLUTION}) SELECT {_printf(
        EVOLUTION_LAYOUT, _text("window_start"), f"lpad({_fixed2('revenue')}, 12, ' ')",
        f"lpad({_digits('sales_count')}, 4, ' ')")} FROM report""",
    "general_stats_lines": f"""{_W}, report AS ({_STATS}) SELECT {_printf(
        STATS_LAYOUT, _digits("n_rows"), _fixed2("revenue"), _digits("sales_count"),
        _fixed2("avg_revenue"), _fixed2("avg_sales_count"), _fixed2("max_revenue"),
        _fixed2("min_revenue"))} FROM report""",
    "category_distribution_lines": f"""{_W}, shares AS ({_SHARES}) SELECT {_printf(
        DISTRIBUTION_LAYOUT, "rpad(category, 15, ' ')",
        "repeat('█', CAST(floor(percent / 2 + 0.5) AS BIGINT))",
        _fixed2("percent"))} FROM shares""",
    "emission_log_latest": f"""{_LOG}
        SELECT window_start, window_end, category, {_CENTS}, sales_count FROM w
        QUALIFY row_number() OVER (
          PARTITION BY window_start, category ORDER BY slice DESC) = 1""",
    "emission_log_as_appended": _LOG + _BY_CATEGORY,
    "replayed_batch": f"""
        SELECT *, CAST(7 AS BIGINT) AS batch_id FROM ({_HOURLY})""",
    "appended_documents": f"{_HOURLY} UNION ALL {_HOURLY}",
    "truncated_log": f"""{_W}
        SELECT count(*) AS n_before, CAST(0 AS BIGINT) AS n_after FROM w""",
    "reconcile_injected": _DIFF,
    "reconcile_one_window": f"""{_W}
        SELECT window_start, category, round_even(revenue * 2, 2) AS served_revenue,
               round_even(revenue, 2) AS expected_revenue, sales_count AS served_count,
               sales_count AS expected_count, 'different' AS status
        FROM w WHERE category = 'purchase' AND window_start = {_NOON}""",
    "reconcile_sliding_window": f"""
        SELECT TIMESTAMP '2024-01-15 12:30:00' AS window_start, 'purchase' AS category,
               round_even(sum(value), 2) AS served_revenue,
               round_even(sum(value), 2) AS expected_revenue,
               count(event_id) + 1 AS served_count, count(event_id) AS expected_count,
               'different' AS status
        FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-15 12:30:00'
          AND ts < TIMESTAMP '2024-01-15 13:30:00' HAVING count(*) > 0""",
    "windows_and_rejects": """
        SELECT CASE event_type WHEN 'error' THEN 'sale_id' WHEN 'view' THEN 'sale_id'
                 WHEN 'signup' THEN 'event_time' WHEN 'purchase' THEN 'amount'
                 ELSE 'valid' END AS verdict,
               count(*) AS n_events,
               count(DISTINCT CASE WHEN event_type NOT IN ('error', 'signup')
                     THEN date_trunc('hour', ts) END) AS n_hours,
               round_even(sum(CASE WHEN event_type NOT IN ('error', 'purchase') THEN value END), 2)
                 AS revenue
        FROM events GROUP BY 1""",
    "published_messages": _HOURLY,
    "compacted_log_latest": _HOURLY,
    "anomalous_windows": f"""{_W},
        spread AS (SELECT category AS of, avg(revenue) AS mean, stddev_samp(revenue) AS sd
                   FROM w GROUP BY category),
        far AS (SELECT w.*, (revenue - mean) / nullif(sd, 0) AS deviation
                FROM w JOIN spread ON category IS NOT DISTINCT FROM of)
        SELECT window_start, window_end, category, {_CENTS}, sales_count,
               round_even(deviation, 2) AS deviation
        FROM far WHERE abs(deviation) > 2.0""",
    "anomalies_by_baseline": f"""
        WITH w AS ({_windows('15 minutes')}),
        placed AS (
          SELECT *, CAST(window_start AS DATE) AS day,
                 (isodow(window_start) - 1) * 24 + hour(window_start) AS how FROM w),
        judged AS (
          SELECT a.window_start, a.window_end, a.category, a.revenue, a.sales_count,
                 avg(b.revenue) AS expected, stddev_samp(b.revenue) AS sd, count(b.revenue) AS n
          FROM placed a JOIN placed b ON a.how = b.how AND a.category = b.category AND b.day < a.day
          GROUP BY ALL)
        SELECT window_start, window_end, category, {_CENTS}, sales_count,
               round_even(expected, 6) AS expected, round_even((revenue - expected) / sd, 2) AS deviation
        FROM judged WHERE n >= 3 AND sd > 0 AND abs((revenue - expected) / sd) > 2.0""",
    "rollup_reports": f"""{_CORRECTED}, report AS ({_BY_CATEGORY}), shares AS ({_SHARES})
        SELECT report.*, round_even(percent, 2) AS percent FROM report JOIN shares USING (category)""",
    "rollup_stats": _CORRECTED + _STATS,
    "reconcile_pruned": _DIFF,
    "compacted_partitions": f"""{_W}
        SELECT strftime(window_start, '%Y-%m-%d') AS day, count(*) AS n_rows,
               round_even(sum(revenue), 2) AS revenue, CAST(sum(sales_count) AS BIGINT) AS sales_count,
               CASE WHEN min(window_start) >= TIMESTAMP '2024-01-20' THEN 2 ELSE 1 END AS compaction
        FROM w GROUP BY 1""",
    "stream_after_compaction": f"SELECT *, true AS refused FROM ({_HOURLY})",
    "appended_deltas": f"""{_W}
        SELECT category, round_even(sum(revenue), 2) AS revenue, CAST(sum(sales_count) AS BIGINT) AS sales_count,
               count(DISTINCT window_start) AS n_windows FROM w GROUP BY category""",
    "stream_sliding_final": f"""SELECT * FROM ({_SLIDING})
        WHERE window_end <= (SELECT max(ts) - INTERVAL '2 minutes' FROM events)""",
    "stream_late_side": f"""{_W}
        SELECT date_trunc('day', window_start) AS window_start, category, round_even(sum(revenue), 2) AS revenue,
               count(*) FILTER (window_start >= TIMESTAMP '2024-01-15') AS sales_count,
               count(*) FILTER (window_start < TIMESTAMP '2024-01-15') AS late_count
        FROM w GROUP BY 1, 2""",
    "stream_observed": _QUALITY,
    "stream_update_latest": _HOURLY,
    "stream_reemitted_latest": f"""{_W}
        SELECT window_start AS janela_inicio, window_end AS janela_fim,
               category AS categoria, round_even(revenue, 2) AS faturamento_total,
               sales_count AS volume_vendas
        FROM w""",
    "stream_reemitted_as_appended": f"""{_LOG}
        SELECT window_start, window_end, category, {_CENTS}, sales_count FROM w""",
    "stream_restarted_log": f"SELECT *, true AS refused FROM ({_HOURLY})",
    "stream_sliding_latest": _SLIDING,
    "stream_envelope_latest": _HOURLY,
    "stream_late_rows": f"""{_W}
        SELECT date_trunc('day', window_start) AS window_start,
               date_trunc('day', window_start) + INTERVAL '1 day' AS window_end, category,
               round_even(sum(revenue), 2) AS revenue, count(*) AS sales_count
        FROM w WHERE window_start >= TIMESTAMP '2024-01-15' GROUP BY 1, 2, 3""",
    "stream_final_windows": f"""SELECT * FROM ({_HOURLY})
        WHERE window_end <= (SELECT max(ts) - INTERVAL '2 minutes' FROM events)""",
    "stream_rejects": """
        SELECT CASE event_type WHEN 'error' THEN 'sale_id' WHEN 'view' THEN 'sale_id'
                 WHEN 'signup' THEN 'event_time' ELSE 'amount' END AS reject_reason,
               count(*) AS n_events
        FROM events WHERE event_type <> 'click' GROUP BY 1""",
    "stream_progress": f"""{_LOG}
        SELECT (SELECT count(*) FROM events) AS input_rows,
               count(*) AS windows_updated, CAST(0 AS BIGINT) AS late_rows
        FROM w""",
}
