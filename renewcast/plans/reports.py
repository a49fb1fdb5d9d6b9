"""Report queries in portable SQL over the fine table; the first open month (:now) and its year's January (:january)
are bound parameters."""
from __future__ import annotations

REPORTS = {
    # What moved the rate between the last twelve closed months and the twelve before: mix of regions or their rates.
    "mix_vs_rate_decomposition": """
WITH part AS (SELECT region, CASE WHEN ord >= :now - 12 THEN 1 ELSE 0 END AS late, CAST(SUM(due_units) AS DOUBLE) AS due, CAST(SUM(ren_units) AS DOUBLE) AS ren FROM fine WHERE ord >= :now - 24 AND ord < :now GROUP BY region, CASE WHEN ord >= :now - 12 THEN 1 ELSE 0 END),
total AS (SELECT late, SUM(due) AS due, SUM(ren) AS ren FROM part GROUP BY late),
pair AS (SELECT a.region, a.due / (SELECT due FROM total WHERE late = 0) AS share_before, b.due / (SELECT due FROM total WHERE late = 1) AS share_after, a.ren / a.due AS rate_before, b.ren / b.due AS rate_after FROM part a JOIN part b ON a.region = b.region AND a.late = 0 AND b.late = 1)
SELECT region, ROUND(share_after - share_before, 6) AS share_change, ROUND((share_after - share_before) * (rate_before - (SELECT ren / due FROM total WHERE late = 0)), 6) AS mix_effect, ROUND(share_after * (rate_after - rate_before), 6) AS rate_effect FROM pair""",
    "signal_share_window": """
SELECT ord, CASE WHEN dormant + softcancel > 0 THEN 'negative' WHEN autorenew = 1 THEN 'positive' ELSE 'none' END AS signal, CAST(SUM(due_units) AS BIGINT) AS due_units,
       ROUND(CAST(SUM(due_units) AS DOUBLE) / SUM(SUM(due_units)) OVER (PARTITION BY ord), 6) AS share
FROM fine WHERE ord < :now GROUP BY ord, CASE WHEN dormant + softcancel > 0 THEN 'negative' WHEN autorenew = 1 THEN 'positive' ELSE 'none' END""",
    "top25_contributors": """
WITH rates AS (SELECT region, product, channel, CAST(SUM(CASE WHEN ord >= (:now - 12) THEN ren_units ELSE 0 END) AS BIGINT) - CAST(SUM(CASE WHEN ord < (:now - 12) THEN ren_units ELSE 0 END) AS BIGINT) AS change FROM fine WHERE ord >= (:now - 24) AND ord < :now GROUP BY region, product, channel)
SELECT region, product, channel, change FROM rates ORDER BY ABS(change) DESC, region, product, channel LIMIT 25""",
    "price_by_discount_known": """
SELECT CASE WHEN percent IS NULL THEN 'unknown' ELSE 'known' END AS discount, CAST(SUM(ren_units) AS BIGINT) AS ren_units, ROUND(CAST(SUM(ren_value) AS DOUBLE) / 200 / NULLIF(SUM(base_cents), 0), 6) AS uplift
FROM fine WHERE ord < :now GROUP BY CASE WHEN percent IS NULL THEN 'unknown' ELSE 'known' END""",
    "year_origin_totals": """
SELECT CAST(FLOOR(ord / 12) AS INT) AS year, COALESCE(term, 'TOTAL') AS origin, CAST(SUM(due_units) AS BIGINT) AS due_units, CAST(SUM(raw_due_units) AS BIGINT) AS raw_due_units
FROM fine WHERE ord >= :january GROUP BY GROUPING SETS ((CAST(FLOOR(ord / 12) AS INT), term), (CAST(FLOOR(ord / 12) AS INT)))""",
    "projected_share": """
SELECT region, CAST(SUM(CASE WHEN role = 'proyeccion' THEN due_cents ELSE 0 END) AS BIGINT) AS projected_cents, ROUND(CAST(SUM(CASE WHEN role = 'proyeccion' THEN due_cents ELSE 0 END) AS DOUBLE) / NULLIF(SUM(due_cents), 0), 6) AS share FROM fine GROUP BY region""",
    "machinery_counts": """
SELECT (SELECT COUNT(*) FROM fine) AS fine_rows, (SELECT COUNT(DISTINCT fs_id) FROM fine) AS series, (SELECT COUNT(DISTINCT cell_id) FROM fine) AS cells, (SELECT COUNT(DISTINCT ord) FROM fine WHERE role = 'examen') AS exam_months, (SELECT COUNT(*) FROM fine WHERE raw_due_units <> due_units) AS wiped""",
    "exam_by_month": """
SELECT ord, CAST(SUM(due_units) AS BIGINT) AS due_units, CAST(SUM(ren_units) AS BIGINT) AS ren_units, COUNT(DISTINCT fs_id) AS series, CAST(SUM(ren_units) AS DOUBLE) / SUM(due_units) AS rate FROM fine WHERE role = 'examen' GROUP BY ord""",
}
