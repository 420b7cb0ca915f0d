"""Named SQL building blocks over the given tables, written independently of the Spark code."""

CTES = {
    "o_trades": """
SELECT upper(replace(p_brand, '#', '.')) AS symbol,
       CAST(date_trunc('week', l_shipdate) AS DATE) AS date,
       l_extendedprice / l_quantity AS price, l_quantity AS quantity,
       (l_shipdate, l_orderkey, l_linenumber, l_partkey) AS position
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_quantity > 0 AND l_extendedprice > 0""",
    "o_bars": """
SELECT date, symbol, arg_min(price, position) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, position) AS close, arg_max(price, position) * 0.97 AS adjusted_close,
       CAST(sum(quantity) AS BIGINT) AS volume
FROM o_trades GROUP BY date, symbol""",
    "o_std": """
SELECT *, adjusted_close / lag(adjusted_close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS daily_return,
       close * volume AS dollar_volume FROM o_bars""",
    "o_cal": """
SELECT session, row_number() OVER (ORDER BY session) AS sid
FROM (SELECT DISTINCT CAST(date_trunc('week', l_shipdate) AS DATE) AS session FROM lineitem)""",
    "o_bdays": """
SELECT session, row_number() OVER (ORDER BY session) AS sid
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS session FROM lineitem
      WHERE isodow(l_shipdate) <= 5 AND (CAST(l_shipdate AS DATE) - DATE '1990-01-01') % 23 NOT IN (5, 11))""",
    "o_pool": """
SELECT symbol, row_number() OVER (ORDER BY symbol) AS ord
FROM (SELECT DISTINCT upper(replace(p_brand, '#', '.')) AS symbol FROM part)""",
    "o_grid": "SELECT session AS as_of_date, sid, symbol, ord FROM o_cal CROSS JOIN o_pool",
    "o_mom": """
SELECT symbol, date,
       lag(adjusted_close, 21) OVER w / lag(adjusted_close, 252) OVER w - 1 AS v,
       lag(date, 252) OVER w AS first_day
FROM o_bars WINDOW w AS (PARTITION BY symbol ORDER BY date)""",
    "o_panel": """
SELECT g.as_of_date, g.sid, g.symbol, g.ord, 'momentum_12_1' AS factor_name, '1.0.0' AS factor_version,
       CASE WHEN m.first_day >= c.session AND isfinite(m.v) THEN m.v END AS raw_value,
       coalesce(m.first_day >= c.session AND isfinite(m.v), FALSE) AS is_eligible
FROM o_grid g LEFT JOIN o_mom m ON m.symbol = g.symbol AND m.date = g.as_of_date
LEFT JOIN o_cal c ON c.sid = g.sid - 252""",
    "o_labels": """
SELECT p.as_of_date, e.session AS end_date, p.symbol, p.factor_name, p.factor_version,
       CAST(21 AS BIGINT) AS horizon_sessions,
       b1.adjusted_close / b0.adjusted_close - 1 AS forward_return,
       b1.adjusted_close IS NOT NULL AND b0.adjusted_close IS NOT NULL AS is_available
FROM o_panel p JOIN o_cal e ON e.sid = p.sid + 21
LEFT JOIN o_bars b0 ON b0.symbol = p.symbol AND b0.date = p.as_of_date
LEFT JOIN o_bars b1 ON b1.symbol = p.symbol AND b1.date = e.session""",
    "o_pairs": """
SELECT p.as_of_date, l.end_date, p.symbol, p.factor_name, p.factor_version, l.horizon_sessions,
       p.raw_value, p.is_eligible, l.forward_return, l.is_available
FROM o_panel p JOIN o_labels l ON l.as_of_date = p.as_of_date AND l.symbol = p.symbol""",
    "o_use": """
SELECT * FROM o_pairs WHERE is_eligible AND is_available AND isfinite(raw_value) AND isfinite(forward_return)""",
    "o_ranks": """
SELECT *, 2 * rank() OVER (PARTITION BY as_of_date ORDER BY raw_value)
          + count(*) OVER (PARTITION BY as_of_date, raw_value) - 1 AS a,
       2 * rank() OVER (PARTITION BY as_of_date ORDER BY forward_return)
          + count(*) OVER (PARTITION BY as_of_date, forward_return) - 1 AS b,
       count(*) OVER (PARTITION BY as_of_date) AS n
FROM o_use""",
    "o_sizes": """
SELECT as_of_date, end_date, factor_name, factor_version, horizon_sessions, count(*) AS universe_size
FROM o_pairs GROUP BY ALL""",
    "o_moments": """
SELECT as_of_date, count(*) AS n,
       CAST(sum((a - n - 1) * (b - n - 1)) AS DOUBLE) AS cov,
       CAST(sum((a - n - 1) * (a - n - 1)) AS DOUBLE) AS va,
       CAST(sum((b - n - 1) * (b - n - 1)) AS DOUBLE) AS vb
FROM o_ranks GROUP BY as_of_date""",
    "o_ic": """
SELECT s.*, coalesce(m.n, 0) AS paired_count, coalesce(m.n, 0) / s.universe_size AS pair_coverage,
       CASE WHEN m.n >= 2 AND va > 0 AND vb > 0 THEN
         CASE WHEN cov = va AND va = vb THEN 1.0 WHEN cov = -va AND va = vb THEN -1.0
              ELSE least(1.0, greatest(-1.0, cov / (sqrt(va) * sqrt(vb)))) END END AS ic
FROM o_sizes s LEFT JOIN o_moments m USING (as_of_date)""",
    "o_groups": """
SELECT *, least(5, greatest(1, CAST(ceil((a / 2.0) * 5 / n) AS INT))) AS quantile FROM o_ranks""",
    "o_obs": """
SELECT s.as_of_date, s.end_date, s.factor_name, s.factor_version, s.horizon_sessions, 5 AS quantiles,
       q.quantile, s.universe_size, coalesce(c.n, 0) AS paired_count,
       coalesce(c.n, 0) / s.universe_size AS paired_coverage,
       coalesce(g.m, 0) AS member_count, coalesce(g.m, 0) / s.universe_size AS member_coverage,
       g.mean_forward_return
FROM o_sizes s CROSS JOIN (SELECT CAST(unnest(range(1, 6)) AS INT) AS quantile) q
LEFT JOIN (SELECT as_of_date, count(*) AS n FROM o_use GROUP BY 1) c ON c.as_of_date = s.as_of_date
LEFT JOIN (SELECT as_of_date, quantile, count(*) AS m, avg(forward_return) AS mean_forward_return
           FROM o_groups GROUP BY 1, 2) g ON g.as_of_date = s.as_of_date AND g.quantile = q.quantile""",
    "o_spread": """
SELECT as_of_date, end_date, factor_name, factor_version, horizon_sessions, quantiles,
       max(mean_forward_return) FILTER (quantile = 1) AS bottom_mean_forward_return,
       max(mean_forward_return) FILTER (quantile = quantiles) AS top_mean_forward_return,
       max(mean_forward_return) FILTER (quantile = quantiles)
         - max(mean_forward_return) FILTER (quantile = 1) AS top_minus_bottom
FROM o_obs GROUP BY ALL""",
    "o_stats": """
SELECT as_of_date, factor_name, factor_version, count(*) AS universe_size,
       count(*) FILTER (is_eligible) AS eligible_count,
       count(*) FILTER (is_eligible) / count(*) AS eligible_coverage,
       count(raw_value) AS valid_count, count(*) - count(raw_value) AS missing_count,
       (count(*) - count(raw_value)) / count(*) AS missing_rate, avg(raw_value) AS mean,
       stddev_pop(raw_value) AS std, min(raw_value) AS minimum, max(raw_value) AS maximum
FROM o_panel GROUP BY as_of_date, factor_name, factor_version""",
    "o_result": """
SELECT p.as_of_date, 'top_n_by_factor' AS strategy_name, '1.0.0' AS strategy_version, p.symbol, p.ord,
       p.raw_value AS score, r.rank, coalesce(r.rank <= 5, FALSE) AS is_selected
FROM o_panel p LEFT JOIN (
  SELECT as_of_date, symbol, CAST(row_number() OVER (PARTITION BY as_of_date ORDER BY raw_value DESC, symbol) AS INT) AS rank
  FROM o_panel WHERE raw_value IS NOT NULL) r USING (as_of_date, symbol)""",
    "o_sel": "SELECT as_of_date, symbol, ord, score FROM o_result WHERE is_selected",
    "o_refused": """
SELECT 'non_positive_score' AS rule, as_of_date, symbol FROM o_sel WHERE NOT coalesce(score > 0 AND isfinite(score), FALSE)
UNION ALL
SELECT 'infeasible_cap', as_of_date, NULL FROM o_sel GROUP BY as_of_date HAVING count(*) * 0.25 + 1e-12 < 0.95""",
    "o_fill0": """
SELECT *, score / max(score) OVER (PARTITION BY as_of_date) AS s,
       row_number() OVER (PARTITION BY as_of_date ORDER BY score DESC, symbol) - 1 AS i,
       count(*) OVER (PARTITION BY as_of_date) AS n
FROM o_sel WHERE as_of_date NOT IN (SELECT as_of_date FROM o_refused)""",
    "o_fill1": """
SELECT *, sum(s) OVER (PARTITION BY as_of_date ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS suf
FROM o_fill0""",
    "o_fill2": """
SELECT as_of_date, coalesce(min(i) FILTER ((0.95 - i * 0.25) * s / suf <= 0.25), max(n)) AS k
FROM o_fill1 GROUP BY as_of_date""",
    "o_pos": """
SELECT f.as_of_date, f.symbol, f.ord, f.score,
       CASE WHEN f.i < k.k THEN 0.25 ELSE (0.95 - k.k * 0.25) * f.s / t.suf END AS weight
FROM o_fill1 f JOIN o_fill2 k USING (as_of_date)
LEFT JOIN o_fill1 t ON t.as_of_date = f.as_of_date AND t.i = k.k""",
    "o_cash": """
SELECT as_of_date, CAST(CASE WHEN bool_or(is_selected) THEN 0.05 ELSE 1.0 END AS DOUBLE) AS cash_weight
FROM o_result WHERE as_of_date NOT IN (SELECT as_of_date FROM o_refused) GROUP BY as_of_date""",
    "o_next": "SELECT as_of_date, cash_weight, lead(as_of_date) OVER (ORDER BY as_of_date) AS next_date FROM o_cash",
    "o_state": "SELECT n.next_date AS as_of_date, p.symbol, p.ord, p.weight FROM o_pos p JOIN o_next n USING (as_of_date) WHERE n.next_date IS NOT NULL",
    "o_scash": "SELECT as_of_date, CAST(coalesce(lag(cash_weight) OVER (ORDER BY as_of_date), 1.0) AS DOUBLE) AS cash_weight FROM o_cash",
    "o_move": """
SELECT as_of_date, symbol, coalesce(s.weight, 0.0) AS current_weight, coalesce(t.weight, 0.0) AS target_weight,
       coalesce(t.weight, 0.0) - coalesce(s.weight, 0.0) AS weight_change,
       CAST(row_number() OVER (PARTITION BY as_of_date ORDER BY t.ord IS NULL, coalesce(t.ord, s.ord)) AS INT) AS position
FROM o_pos t FULL JOIN o_state s USING (as_of_date, symbol)""",
    "o_events": """
SELECT o_cash.as_of_date AS decision_date, n.session AS execution_date
FROM o_cash JOIN o_cal c ON c.session = as_of_date JOIN o_cal n ON n.sid = c.sid + 1""",
    "o_orders": """
SELECT m.as_of_date || '-' || m.symbol AS order_id, m.as_of_date AS decision_date,
       e.execution_date AS scheduled_fill_date, m.symbol,
       CASE WHEN weight_change > 0 THEN 'BUY' ELSE 'SELL' END AS side,
       abs(weight_change) * 1000000.0 / b.close AS quantity
FROM o_move m JOIN o_events e ON e.decision_date = m.as_of_date
JOIN o_bars b ON b.symbol = m.symbol AND b.date = m.as_of_date
WHERE abs(weight_change) > 1e-12""",
    "o_fills": """
SELECT *, fill_price * quantity AS gross_notional,
       CASE WHEN side = 'BUY' THEN -(fill_price * quantity + transaction_cost)
            ELSE fill_price * quantity - transaction_cost END AS cash_change
FROM (SELECT o.*, o.scheduled_fill_date AS fill_date,
             b.open * CASE WHEN side = 'BUY' THEN 1.0 + 0.0005 ELSE 1.0 - 0.0005 END AS fill_price,
             CAST(1.0 AS DOUBLE) AS transaction_cost
      FROM o_orders o JOIN o_bars b ON b.symbol = o.symbol AND b.date = o.scheduled_fill_date)""",
    "o_bsid": "SELECT b.*, c.sid, (SELECT max(sid) FROM o_cal) AS top FROM o_std b JOIN o_cal c ON c.session = b.date",
    "o_published": "SELECT * FROM o_bsid WHERE sid <= top - 10",
    "o_downloaded": """
SELECT symbol, date, open, high, low, close * 1.01 AS close, adjusted_close * 1.01 AS adjusted_close, volume, 0 AS arrival
FROM o_bsid WHERE sid > top - 15
UNION ALL
SELECT symbol, date, open, high, low, close * 1.02, adjusted_close * 1.02, volume, 1 FROM o_bsid WHERE sid > top - 3""",
    "o_merged": """
SELECT symbol, date, open, high, low, close, adjusted_close, volume,
       adjusted_close / lag(adjusted_close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS daily_return,
       close * volume AS dollar_volume
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY arrival DESC) AS pick
      FROM (SELECT symbol, date, open, high, low, close, adjusted_close, volume, -1 AS arrival FROM o_published
            UNION ALL SELECT * FROM o_downloaded))
WHERE pick = 1""",
    "o_held": """
SELECT b.symbol, b.date, b.sid FROM o_bsid b JOIN o_pool USING (symbol)
WHERE ord <= 22 AND (7 * b.sid + 3 * ord) % 11 <> 4 AND b.sid >= 5 + 2 * ord AND b.sid <= top - ord""",
    "o_wins": "SELECT session, sid FROM o_cal WHERE session BETWEEN DATE '1995-03-01' AND DATE '2001-10-15'",
    "o_missing": """
SELECT s.symbol, w.session, w.sid,
       CASE WHEN w.session < lo THEN 'head_gap' WHEN w.session > hi THEN 'tail_gap' ELSE 'internal_gap' END AS reason
FROM (SELECT symbol, min(date) AS lo, max(date) AS hi FROM o_held GROUP BY symbol) s CROSS JOIN o_wins w
WHERE NOT EXISTS (SELECT 1 FROM o_held h WHERE h.symbol = s.symbol AND h.date = w.session)""",
    "o_runs": """
SELECT symbol, reason, min(sid) AS s0, max(sid) AS s1
FROM (SELECT *, sid - row_number() OVER (PARTITION BY symbol, reason ORDER BY sid) AS grp FROM o_missing)
GROUP BY symbol, reason, grp""",
    "o_wish": """
SELECT *, CASE reason WHEN 'head_gap' THEN 1 WHEN 'internal_gap' THEN 2 WHEN 'tail_gap' THEN 3 ELSE 4 END AS kind
FROM (SELECT symbol, s0, s1, reason FROM o_runs UNION ALL
      SELECT symbol, (SELECT max(sid) FROM o_wins) - 4, (SELECT max(sid) FROM o_wins), 'overlap_refresh'
      FROM (SELECT DISTINCT symbol FROM o_held))""",
    "o_isl": """
SELECT *, sum(CASE WHEN s0 <= reach + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY symbol ORDER BY s0, s1, kind) AS island,
       row_number() OVER (PARTITION BY symbol ORDER BY s0, s1, kind) AS nth
FROM (SELECT *, max(s1) OVER (PARTITION BY symbol ORDER BY s0, s1, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
      FROM o_wish)""",
    "o_windows": """
SELECT symbol, min(s0) AS s0, max(s1) AS s1,
       string_agg(reason, '+' ORDER BY first_nth) AS reason
FROM (SELECT symbol, island, reason, min(s0) AS s0, max(s1) AS s1, min(nth) AS first_nth FROM o_isl GROUP BY ALL)
GROUP BY symbol, island""",
    "o_plan": """
SELECT p.symbol, 'planned' AS status,
       coalesce(a.session, greatest(DATE '1995-03-01', (SELECT min(session) FROM o_cal))) AS window_start,
       coalesce(z.session, least(DATE '2001-10-15', (SELECT max(session) FROM o_cal))) AS window_end,
       coalesce(w.reason, 'initial_backfill') AS reason
FROM o_pool p LEFT JOIN o_windows w USING (symbol)
LEFT JOIN o_cal a ON a.sid = w.s0 LEFT JOIN o_cal z ON z.sid = w.s1""",
    "o_weekly": """
SELECT max(c.session) AS decision_date
FROM (SELECT CAST(unnest(range(CAST(date_trunc('week', DATE '1995-03-01') AS DATE) + 3, DATE '2001-07-01', INTERVAL 7 DAY)) AS DATE) AS probe) p
JOIN o_bdays c ON c.session <= p.probe
WHERE p.probe <= (SELECT max(session) FROM o_bdays)
GROUP BY p.probe HAVING max(c.session) BETWEEN DATE '1995-03-01' AND DATE '2001-06-30'""",
    "o_monthly": """
SELECT decision_date FROM (SELECT max(session) AS decision_date FROM o_bdays GROUP BY date_trunc('month', session))
WHERE decision_date BETWEEN DATE '1995-03-01' AND DATE '2001-06-30'""",
    "o_rebalance": """
SELECT decision_date, e.session AS execution_date
FROM o_weekly JOIN o_bdays d ON d.session = decision_date JOIN o_bdays e ON e.sid = d.sid + 2
WHERE e.session <= DATE '2001-06-30'""",
    "o_master": """
SELECT ' s' || s_suppkey || ' ' AS symbol, s_name AS name,
       CASE WHEN s_nationkey < 12 THEN 'nyse' WHEN s_nationkey < 20 THEN ' Nasdaq ' ELSE 'lse' END AS exchange,
       CASE WHEN s_nationkey = 3 THEN 'etf' ELSE 'Common_Stock' END AS security_type,
       CASE WHEN s_acctbal > 0 THEN 'Yes' WHEN s_acctbal > -500 THEN 'n' ELSE 'maybe' END AS is_active,
       s_suppkey AS line FROM supplier
UNION ALL
SELECT CASE WHEN c_nationkey = 5 THEN 's' || c_custkey WHEN c_nationkey = 6 THEN '   '
            WHEN c_nationkey = 7 THEN 'c_' || c_custkey WHEN c_nationkey = 8 THEN c_name ELSE 'c' || c_custkey END,
       CASE WHEN c_nationkey = 9 THEN NULL ELSE c_name END,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'nyse arca' WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE 'bats' END,
       'common_stock', CASE WHEN c_acctbal > 0 THEN 'TRUE' ELSE '0' END, c_custkey + 10000000000 FROM customer""",
    "o_norm": """
SELECT upper(trim(coalesce(symbol, ''))) AS symbol, trim(coalesce(name, '')) AS name,
       upper(trim(coalesce(exchange, ''))) AS exchange, lower(trim(coalesce(security_type, ''))) AS security_type,
       is_active, CASE WHEN lower(trim(is_active)) IN ('true', 't', 'yes', 'y', '1') THEN TRUE
                       WHEN lower(trim(is_active)) IN ('false', 'f', 'no', 'n', '0') THEN FALSE END AS active, line
FROM o_master""",
    "o_raw": """
SELECT CASE WHEN sid % 97 = 3 THEN 'soon' ELSE CAST(date AS VARCHAR) END AS "Date",
       CASE WHEN sid % 89 = 4 THEN '??' || symbol ELSE ' ' || lower(symbol) END AS symbol,
       CASE WHEN sid % 41 = 5 THEN 'n/a' ELSE CAST(volume AS VARCHAR) END AS "Volume",
       CASE WHEN sid % 43 = 6 THEN '-' ELSE CAST(volume AS VARCHAR) END AS "Open",
       CAST(volume AS VARCHAR) AS "High", CAST(volume AS VARCHAR) AS "Low",
       CAST(volume + 1 AS VARCHAR) AS "Close", CAST(volume + 2 AS VARCHAR) AS "Adj Close"
FROM o_bsid""",
    "o_parsed": """
SELECT TRY_CAST("Date" AS DATE) AS date, upper(trim(symbol)) AS symbol, TRY_CAST("Open" AS DOUBLE) AS open,
       TRY_CAST("High" AS DOUBLE) AS high, TRY_CAST("Low" AS DOUBLE) AS low, TRY_CAST("Close" AS DOUBLE) AS close,
       TRY_CAST("Adj Close" AS DOUBLE) AS adjusted_close, TRY_CAST("Volume" AS BIGINT) AS volume
FROM o_raw""",
    "o_damaged1": """
SELECT date, CASE WHEN sid % 100 = 23 THEN lower(symbol) ELSE symbol END AS symbol, open,
       CASE WHEN sid % 50 = 7 THEN low * 0.5 ELSE high END AS high, low, close,
       CASE WHEN sid % 70 = 13 THEN 0.0 ELSE adjusted_close END AS adjusted_close,
       CASE WHEN sid % 60 = 11 THEN -1 ELSE volume END AS volume,
       CASE WHEN sid % 80 = 17 THEN NULL ELSE daily_return END AS daily_return, dollar_volume, sid
FROM o_bsid""",
    "o_damaged": "SELECT * EXCLUDE (sid) FROM o_damaged1 UNION ALL SELECT * EXCLUDE (sid) FROM o_damaged1 WHERE sid % 90 = 19",
}
