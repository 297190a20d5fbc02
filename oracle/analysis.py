"""Oracle statements for the sample statistics (DuckDB dialect)."""

SAMPLES = """
q_s AS (
    SELECT event_type AS scenario, ['product page', 'order history', 'checkout'][user_id % 3 + 1] AS operation,
           ts, value AS latency_ms, event_type <> 'error' AS ok, event_id
    FROM events
)"""

SQL = {}

SQL["a13_run_medians"] = f"""
WITH {SAMPLES}, q_r AS (
    SELECT scenario, operation, latency_ms,
           row_number() OVER (PARTITION BY scenario, operation ORDER BY latency_ms) AS rk,
           count(*) OVER (PARTITION BY scenario, operation) AS n
    FROM q_s
)
SELECT scenario, operation, CAST(max(n) AS BIGINT) AS runs,
       max(latency_ms) FILTER (WHERE rk = (n - 1) // 2 + 1) AS median_ms,
       max(latency_ms) FILTER (WHERE rk = n // 2 + 1) AS upper_median_ms,
       min(latency_ms) AS min_ms, max(latency_ms) AS max_ms
FROM q_r GROUP BY ALL"""

SQL["a14_lower_median_run"] = f"""
WITH {SAMPLES}, q_r AS (
    SELECT scenario, operation, event_id, latency_ms, ok,
           row_number() OVER (PARTITION BY scenario, operation ORDER BY latency_ms, event_id) AS rk,
           count(*) OVER (PARTITION BY scenario, operation) AS n
    FROM q_s
)
SELECT scenario, operation, event_id, latency_ms, ok FROM q_r WHERE rk = (n - 1) // 2 + 1"""

_STATS = """
q_r AS (
    SELECT {keys}, latency_ms, row_number() OVER (PARTITION BY {keys} ORDER BY latency_ms) AS rk,
           count(*) OVER (PARTITION BY {keys}) AS n
    FROM {src} WHERE ok
), q_p AS (
    SELECT {keys},
           max(latency_ms) FILTER (WHERE rk = greatest(least(ceil(n * 0.5), n), 1)) AS p50,
           max(latency_ms) FILTER (WHERE rk = greatest(least(ceil(n * 0.95), n), 1)) AS p95,
           max(latency_ms) FILTER (WHERE rk = greatest(least(ceil(n * 0.99), n), 1)) AS p99,
           max(latency_ms) FILTER (WHERE rk = greatest(least(ceil(n * 0.999), n), 1)) AS p999,
           max(latency_ms) FILTER (WHERE rk = greatest(least(ceil(n * 0.9999), n), 1)) AS p9999,
           max(latency_ms) FILTER (WHERE rk = least(greatest(round_even(n * 0.99 - 1.96 * sqrt(n * 0.99 * (1 - 0.99)), 0), 1), n)) AS p99_low,
           max(latency_ms) FILTER (WHERE rk = least(greatest(round_even(n * 0.99 + 1.96 * sqrt(n * 0.99 * (1 - 0.99)), 0), 1), n)) AS p99_high
    FROM q_r GROUP BY ALL
), q_b AS (
    SELECT {keys}, count(*) FILTER (WHERE ok) AS done, count(*) FILTER (WHERE NOT ok) AS failed,
           max(latency_ms) FILTER (WHERE ok) AS max,
           (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds
    FROM {src} GROUP BY ALL
)"""

SQL["a15_latency_stats"] = f"""
WITH {SAMPLES}, {_STATS.format(keys="scenario, operation", src="q_s")}
SELECT b.scenario, b.operation, b.done, b.failed,
       round(CASE WHEN b.seconds > 0 THEN b.done / b.seconds END, 6) AS per_second,
       p.p50, p.p95, p.p99, p.p999, p.p9999, b.max, p.p99_low, p.p99_high,
       CAST(floor(b.done * 0.0001) AS BIGINT) AS above_p9999, floor(b.done * 0.0001) >= 10 AS p9999_supported
FROM q_b b LEFT JOIN q_p p USING (scenario, operation)"""

SQL["a17_pooled_rounds"] = f"""
WITH {SAMPLES}, {_STATS.format(keys="scenario", src="q_s")}, q_time AS (
    SELECT scenario, CAST(count(*) AS INTEGER) AS rounds, sum(s) AS seconds
    FROM (SELECT scenario, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS s FROM q_s GROUP BY scenario, event_id % 3) GROUP BY scenario
)
SELECT b.scenario, t.rounds, b.done, b.failed, round(CASE WHEN t.seconds <> 0 THEN b.done / t.seconds END, 6) AS per_second,
       p.p50, p.p95, p.p99, b.max
FROM q_b b JOIN q_time t USING (scenario) LEFT JOIN q_p p USING (scenario)"""

SQL["a18_log_histogram"] = f"""
WITH {SAMPLES}, q_pos AS (SELECT * FROM q_s WHERE latency_ms > 0),
q_bounds AS (SELECT greatest(min(latency_ms), 0.05) AS lo, max(latency_ms) AS hi FROM q_pos)
SELECT scenario,
       CAST(least(37, floor((log10(greatest(latency_ms, lo)) - log10(lo)) / (log10(hi) - log10(lo)) * 38)) AS INTEGER) AS bucket,
       count(*) AS samples
FROM q_pos, q_bounds GROUP BY ALL"""

SQL["k10_run_analysis"] = f"""
WITH {SAMPLES}, q_r AS (
    SELECT scenario, operation, latency_ms,
           row_number() OVER (PARTITION BY scenario, operation ORDER BY latency_ms) AS rk,
           count(*) OVER (PARTITION BY scenario, operation) AS n
    FROM q_s
), q_m AS (
    SELECT scenario, operation, max(latency_ms) FILTER (WHERE rk = (n - 1) // 2 + 1) AS median_ms FROM q_r GROUP BY ALL
)
SELECT m.scenario, m.operation, m.median_ms, round(b.median_ms / m.median_ms, 4) AS speedup
FROM q_m m LEFT JOIN q_m b ON b.scenario = m.scenario AND b.operation = 'checkout'"""
