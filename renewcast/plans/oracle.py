"""The queries' equivalents in DuckDB's SQL."""
from __future__ import annotations

from renewcast.operators import structure
from renewcast.operators.checks import in_sql
from renewcast.plans.covers import COVERS, bound
from renewcast.plans.reports import REPORTS

_LICENCES = """lic AS (
  SELECT CAST(year(l_shipdate) * 12 + month(l_shipdate) - 1 AS INT) AS ord, r_name AS region, p_type AS product, (o_orderstatus = 'P')::INT AS dormant, (p_size <= 5)::INT AS softcancel, (o_orderpriority = '1-URGENT')::INT AS autorenew, c_mktsegment AS channel,
         (round(l_tax * 100)::BIGINT >= 6)::INT AS newcust, CASE WHEN round(l_tax * 100)::BIGINT <> 8 THEN round(l_discount * 100)::BIGINT * 5 END AS percent, (p_brand = 'Brand#1')::INT AS ts, CASE WHEN l_linestatus = 'F' THEN '1 year' ELSE '3 year' END AS term,
         l_quantity::BIGINT AS due_units, round(l_extendedprice * 100)::BIGINT AS due_cents, CASE WHEN l_returnflag <> 'R' THEN l_quantity::BIGINT ELSE 0 END AS ren_units,
         CASE WHEN l_returnflag <> 'R' THEN round(l_extendedprice * 100)::BIGINT * (200 + 2 * round(l_tax * 100)::BIGINT - round(l_discount * 100)::BIGINT) ELSE 0 END AS ren_value, CASE WHEN l_returnflag <> 'R' THEN round(l_extendedprice * 100)::BIGINT ELSE 0 END AS base_cents
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_BASE = f"""WITH {_LICENCES},
ext AS (SELECT ord, region, product, dormant, softcancel, autorenew, channel, newcust, percent, ts, term, sum(due_units)::BIGINT AS raw_due_units, sum(due_cents)::BIGINT AS raw_due_cents, sum(ren_units)::BIGINT AS raw_ren_units, sum(ren_value)::BIGINT AS raw_ren_value, sum(base_cents)::BIGINT AS raw_base_cents FROM lic GROUP BY ALL),
fine AS (SELECT *, CASE WHEN ord >= 24009 THEN 'proyeccion' WHEN ord >= 24006 THEN 'examen' ELSE 'entrenamiento' END AS role,
  CASE WHEN ord >= 24021 AND term = '1 year' THEN 0 ELSE raw_due_units END AS due_units, CASE WHEN ord >= 24021 AND term = '1 year' THEN 0 ELSE raw_due_cents END AS due_cents,
  CASE WHEN ord < 24009 THEN raw_ren_units END AS ren_units, CASE WHEN ord < 24009 THEN raw_ren_value END AS ren_value, CASE WHEN ord < 24009 THEN raw_base_cents END AS base_cents,
  CASE WHEN percent IS NULL THEN 'sin_dato' WHEN percent < 10 THEN '01 _ 0-10%' WHEN percent < 20 THEN '02 _ 10-20%' WHEN percent < 30 THEN '03 _ 20-30%' WHEN percent < 40 THEN '04 _ 30-40%' ELSE '05 _ 40-100%' END AS bucket,
  concat_ws('|', region, product, dormant, softcancel, autorenew, channel) AS fs_id,
  CASE WHEN dormant + softcancel > 0 AND autorenew = 1 THEN 'mixto' WHEN dormant + softcancel > 0 THEN 'negativo' WHEN autorenew = 1 THEN 'positivo' ELSE 'neutro' END AS sign FROM ext),
fin AS (SELECT *, concat_ws('|', region, product, newcust, bucket) AS cell_id FROM fine),
units AS (SELECT fs_id, region, product, dormant, softcancel, autorenew, channel, sign, ord, role, sum(due_units)::BIGINT AS due_units, sum(due_cents)::BIGINT AS due_cents, sum(ren_units)::BIGINT AS ren_units, sum(ren_value)::BIGINT AS ren_value, count(*) AS rows FROM fine WHERE ts = 0 GROUP BY ALL),
past AS (SELECT * FROM units WHERE ord < 24009),
summary AS (SELECT fs_id, sign, median(CASE WHEN due_units > 0 THEN due_units::DOUBLE END) AS support, count(*) AS months, sum(due_units)::BIGINT AS due_units, sum(ren_units)::BIGINT AS ren_units FROM past GROUP BY fs_id, sign),
names AS (SELECT DISTINCT fs_id, sign, region, product, dormant, softcancel, autorenew, channel FROM units),
pattern AS (SELECT fs_id, sign, 0 AS pass, concat_ws('|', 'region=' || region, 'product=' || product, 'dormant=' || dormant, 'softcancel=' || softcancel, 'autorenew=' || autorenew, 'channel=' || channel) AS pattern FROM names
  UNION ALL SELECT fs_id, sign, 1, concat_ws('|', 'region=' || region, 'product=' || product, 'sign=' || sign, 'channel=' || channel) FROM names WHERE sign <> 'mixto'
  UNION ALL SELECT fs_id, sign, 2, concat_ws('|', 'region=' || region, 'product=' || product, 'sign=' || sign) FROM names WHERE sign <> 'mixto'
  UNION ALL SELECT fs_id, sign, 3, concat_ws('|', 'region=' || region, 'sign=' || sign) FROM names WHERE sign <> 'mixto'
  UNION ALL SELECT fs_id, sign, 4, 'sign=' || sign FROM names WHERE sign <> 'mixto'),
pmonth AS (SELECT pass, pattern, ord, sum(due_units)::BIGINT AS due, sum(ren_units)::BIGINT AS ren FROM past JOIN pattern USING (fs_id) GROUP BY ALL),
pstat AS (SELECT pass, pattern, median(CASE WHEN due > 0 THEN due::DOUBLE END) AS support, sum(due)::BIGINT AS due_units, sum(ren)::BIGINT AS ren_units, (SELECT count(DISTINCT q.fs_id) FROM pattern q JOIN past USING (fs_id) WHERE q.pass = pmonth.pass AND q.pattern = pmonth.pattern) AS series FROM pmonth GROUP BY pass, pattern),
ladder AS (SELECT p.fs_id, p.sign, p.pass, p.pattern, support, series, due_units, ren_units, coalesce(min(CASE WHEN support >= 30 THEN p.pass END) OVER w, max(p.pass) OVER w) AS take FROM pattern p JOIN pstat s ON p.pass = s.pass AND p.pattern = s.pattern WINDOW w AS (PARTITION BY fs_id)),
chosen AS (SELECT fs_id, sign, pass, pattern AS composition, support, series, due_units, ren_units FROM ladder WHERE pass = take),
cand AS (SELECT c.fs_id, c.composition, l.pattern AS reference, l.pass AS r_pass, l.support AS r_support, l.due_units AS r_due, l.ren_units AS r_ren,
  row_number() OVER (PARTITION BY c.fs_id ORDER BY CASE WHEN l.support >= 30 THEN 0 ELSE 1 END, CASE WHEN l.support >= 30 THEN l.pass ELSE -l.pass END) AS k
  FROM chosen c JOIN ladder l ON c.fs_id = l.fs_id AND l.pass > c.pass AND l.series > c.series WHERE c.support < 271 AND c.sign <> 'mixto'),
refs AS (SELECT * FROM cand WHERE k = 1),
sib AS (SELECT DISTINCT r.reference, c.composition, c.support AS w, c.ren_units::DOUBLE / c.due_units AS p FROM (SELECT DISTINCT composition, reference FROM refs) r JOIN chosen c ON r.composition = c.composition WHERE c.due_units > 0 AND c.support > 0),
ksum AS (SELECT reference, count(*) AS siblings, sum(w) AS w, sum(w * p) AS wp, avg(p * (1 - p)) AS within, sum(w * p * p) AS wpp, sum(w * p * (1 - p) / greatest(w, 1)) AS noise FROM sib GROUP BY reference),
kk AS (SELECT reference, siblings, round(wp / w, 6) AS mean_rate, round(CASE WHEN siblings < 3 THEN 60 WHEN (wpp - wp * wp / w - noise) / w <= 1e-6 THEN 600 ELSE within / ((wpp - wp * wp / w - noise) / w) END, 4)::DOUBLE AS k FROM ksum),
bridge AS (SELECT p.fs_id, p.pattern AS composition, CASE WHEN c.fs_id IS NOT NULL THEN 'uses' ELSE 'lends' END AS membership FROM pattern p JOIN (SELECT DISTINCT pass, composition FROM chosen) d ON p.pass = d.pass AND p.pattern = d.composition LEFT JOIN chosen c ON c.fs_id = p.fs_id AND c.composition = p.pattern),
pool AS (SELECT composition, ord, sum(due_units)::BIGINT AS due_units, sum(ren_units)::BIGINT AS ren_units, sum(due_cents)::BIGINT AS due_cents FROM bridge JOIN past USING (fs_id) GROUP BY ALL),
renew AS (SELECT *, concat_ws('|', region, product, bucket) AS parent, concat_ws('|', region, product) AS wide FROM fin WHERE ord < 24009 AND ren_units > 0 AND ts = 0)
"""
_UPLIFT = """, cells AS (SELECT DISTINCT cell_id AS cell, concat_ws('|', region, product, bucket) AS parent, concat_ws('|', region, product) AS wide FROM fin WHERE ts = 0),
rn AS (SELECT * FROM renew WHERE ord < {before}),
u1 AS (SELECT cell_id AS cell, sum(ren_units)::BIGINT AS n, sum(ren_value)::DOUBLE / 200 / sum(base_cents)::DOUBLE AS u FROM rn GROUP BY 1),
u2 AS (SELECT parent, sum(ren_units)::BIGINT AS n, sum(ren_value)::DOUBLE / 200 / sum(base_cents)::DOUBLE AS u FROM rn GROUP BY 1),
u3 AS (SELECT wide, sum(ren_units)::BIGINT AS n, sum(ren_value)::DOUBLE / 200 / sum(base_cents)::DOUBLE AS u FROM rn GROUP BY 1),
up AS (SELECT c.cell, coalesce(u1.n, 0)::BIGINT AS renewers, CASE WHEN u1.n >= 30 THEN 'propio' WHEN u2.n >= 30 THEN 'padre' WHEN u3.n > 0 THEN 'celda' ELSE 'global' END AS origin,
  round(greatest(least(CASE WHEN u1.n >= 30 THEN u1.u WHEN u2.n >= 30 THEN u2.u WHEN u3.n > 0 THEN u3.u ELSE (SELECT sum(ren_value)::DOUBLE / 200 / sum(base_cents)::DOUBLE FROM rn) END, 3.0), 0.01), 9) AS uplift
  FROM cells c LEFT JOIN u1 ON c.cell = u1.cell LEFT JOIN u2 ON c.parent = u2.parent LEFT JOIN u3 ON c.wide = u3.wide)
"""
_MONITOR = """, mm AS (SELECT product, ord, sum(ren_value)::DOUBLE / 200 / sum(base_cents)::DOUBLE AS uplift, sum(ren_value)::BIGINT AS ren_value FROM renew GROUP BY product, ord),
m1 AS (SELECT *, CASE WHEN count(uplift) OVER w >= 6 THEN avg(uplift) OVER w END AS before FROM mm WINDOW w AS (PARTITION BY product ORDER BY ord ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)),
m2 AS (SELECT *, round(uplift / before - 1, 6) AS step, row_number() OVER (PARTITION BY product ORDER BY ord) AS n FROM m1),
m3 AS (SELECT *, coalesce(step >= {step}, false)::INT AS above FROM m2),
m4 AS (SELECT *, n - row_number() OVER (PARTITION BY product, above ORDER BY ord) AS island FROM m3),
m5 AS (SELECT *, (above = 1 AND count(*) OVER r >= 3 AND n = min(n) OVER r)::INT AS starts FROM m4 WINDOW r AS (PARTITION BY product, above, island)),
mon AS (SELECT product, ord, round(uplift, 6) AS uplift, round(before, 6) AS before, step, above, starts, max(starts) OVER (PARTITION BY product ORDER BY ord ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS in_cycle,
  CAST(n - max(CASE WHEN starts = 1 THEN n END) OVER (PARTITION BY product ORDER BY ord) AS INT) AS months_since, ren_value FROM m5)
"""
_BACKTEST = """, hist AS (SELECT composition, ord, due_units, ren_units::DOUBLE / due_units AS rate FROM pool WHERE due_units > 0),
lg AS (SELECT *, ln(greatest(least(rate, 0.999), 0.001) / (1 - greatest(least(rate, 0.999), 0.001))) AS y FROM hist),
target AS (SELECT t.composition, t.ord, h, t.rate AS real, t.due_units FROM hist t CROSS JOIN (VALUES (1), (6)) v(h) WHERE t.ord >= 23994),
seen AS (SELECT t.composition, t.ord, t.h, t.real, t.due_units, s.y, row_number() OVER (PARTITION BY t.composition, t.ord, t.h ORDER BY s.ord) - 1 AS i, count(*) OVER (PARTITION BY t.composition, t.ord, t.h) AS n FROM target t JOIN lg s ON s.composition = t.composition AND s.ord <= t.ord - t.h),
sums AS (SELECT composition, ord, h, real, due_units, n, avg(y) AS all_mean, avg(y) FILTER (i >= n - 3) AS m3, avg(y) FILTER (i >= n - 6) AS m6, sum(y * pow(0.5, (n - 1 - i) / 3.0)) / sum(pow(0.5, (n - 1 - i) / 3.0)) AS ewma,
  sum(y * CASE WHEN i = 0 THEN 1 ELSE 0.3::DOUBLE END * pow(0.7::DOUBLE, n - 1 - i)) AS ses, regr_slope(y, i) AS slope, regr_intercept(y, i) AS intercept FROM seen WHERE n >= 12 GROUP BY ALL),
logits AS (SELECT composition, ord, h, real, due_units, 'T2_mean' AS technique, all_mean AS lo FROM sums UNION ALL SELECT composition, ord, h, real, due_units, 'T3_ma3', m3 FROM sums UNION ALL SELECT composition, ord, h, real, due_units, 'T3_ma6', m6 FROM sums
  UNION ALL SELECT composition, ord, h, real, due_units, 'T4_ewma', ewma FROM sums UNION ALL SELECT composition, ord, h, real, due_units, 'T9_ses', ses FROM sums
  UNION ALL SELECT composition, ord, h, real, due_units, 'T12_theta', 0.5 * (intercept + slope * (n - 1) + slope * 0.9::DOUBLE * (1 - pow(0.9::DOUBLE, h)) / 0.1::DOUBLE) + 0.5 * ses FROM sums
  UNION ALL SELECT composition, ord, h, real, due_units, 'T14_temporal_cred', 0.5 * m6 + 0.5 * all_mean FROM sums),
bt AS (SELECT composition, ord, CASE WHEN ord >= 24006 THEN 'examen' ELSE 'seleccion' END AS purpose, h, technique, 1 / (1 + exp(-lo)) AS predicted, real, due_units, greatest(least(real, 1 - 0.5::DOUBLE / due_units), 0.5::DOUBLE / due_units) AS p FROM logits)
"""

_RATES = """, r AS (SELECT n.region, n.product, n.dormant::VARCHAR AS dormant, n.softcancel::VARCHAR AS softcancel, n.autorenew::VARCHAR AS autorenew, n.channel, support AS w, s.ren_units::DOUBLE / s.due_units AS x FROM summary s JOIN names n ON s.fs_id = n.fs_id WHERE s.due_units > 0 AND support > 0)"""
_SERIES = ("region", "product", "dormant", "softcancel", "autorenew", "channel")
_PAIRS = [(a, b) for i, a in enumerate(_SERIES) for b in _SERIES[i + 1:]]


def _spread(name: str, values: list[str]) -> str:
    """CTEs of the sums of squares by values: rows (d, v, w, x) of all series for each dimension or pair."""
    rows = " UNION ALL ".join(f"SELECT {v}, w, x FROM r" for v in values)
    return f""", {name}0 AS ({rows}), {name}1 AS (SELECT d, v, count(*) AS n, sum(w) AS sw, sum(w * x) AS wx, sum(w * x * x) AS wxx FROM {name}0 GROUP BY d, v),
{name} AS (SELECT d, count(*) AS levels, sum(n)::BIGINT AS series, sum(wxx) - sum(wx) * sum(wx) / sum(sw) AS sst, sum(wx * wx / sw) - sum(wx) * sum(wx) / sum(sw) AS ssb FROM {name}1 GROUP BY d)"""


_SINGLE = _spread("sg", [f"'{d}' AS d, {d} AS v" for d in _SERIES])
_DYNAMICS = """, dy AS (SELECT composition, ord, due_units, ren_units, ren_units::DOUBLE / due_units AS rate, count(*) OVER c AS n, due_units / avg(due_units) OVER c AS w, (ord - min(ord) OVER c) / 12.0::DOUBLE AS t FROM pool WHERE due_units > 0 WINDOW c AS (PARTITION BY composition)),
d1 AS (SELECT *, t - sum(w * t) OVER c / sum(w) OVER c AS dt, rate - sum(w * rate) OVER c / sum(w) OVER c AS dr FROM dy WHERE n >= 24 WINDOW c AS (PARTITION BY composition)),
d2 AS (SELECT *, sum(w * dt * dt) OVER c AS sxx, sum(w * dt * dr) OVER c / sum(w * dt * dt) OVER c AS slope FROM d1 WINDOW c AS (PARTITION BY composition)),
d3 AS (SELECT *, dr - slope * dt AS res FROM d2),
m1 AS (SELECT composition, n, (ord % 12 + 1)::INT AS month, sum(w) AS mw, sum(w * res) AS wr, sum(w * res * res) AS wrr, count(*) AS seen FROM d3 GROUP BY ALL),
m2 AS (SELECT *, wr / mw - sum(wr) OVER c / sum(mw) OVER c AS effect, count(*) OVER c AS months, sum(wrr - wr * wr / mw) OVER c AS within FROM m1 WINDOW c AS (PARTITION BY composition)),
m3 AS (SELECT *, sum(mw * effect * effect) OVER (PARTITION BY composition) AS between_, greatest(months - 1, 1) AS df1, greatest(n - months - 1, 1) AS df2 FROM m2),
m4 AS (SELECT *, sqrt(greatest(within, 0) / df2 / seen) AS error FROM m3)
"""
_COMBOS = {"dormant": "dormant", "softcancel": "softcancel", "dormant_softcancel": "dormant+softcancel"}


def _moves() -> str:
    names = list(_COMBOS.values())
    part = lambda col, tag: ", ".join(f"coalesce(sum({col}) FILTER (mark = '{c}'), 0)::DOUBLE AS {tag}{i}" for i, c in enumerate(names))
    text = """, kr AS (SELECT concat_ws('|', region, product, channel) AS grp, concat_ws('|', region, product) AS cell, 'all' AS everything, CASE WHEN dormant = 1 AND softcancel = 1 THEN 'dormant+softcancel' WHEN dormant = 1 THEN 'dormant' WHEN softcancel = 1 THEN 'softcancel' ELSE 'neutral' END AS mark, ord, ord % 12 AS m, due_units, ren_units FROM fin WHERE ts = 0 AND due_units > 0),
kh AS (SELECT * FROM kr WHERE ord < 24009 AND ord IN (SELECT DISTINCT ord FROM kr WHERE ord < 24009 ORDER BY ord DESC LIMIT 12))"""
    levels = {"g": "grp", "c": "cell", "a": "everything"}
    for k, col in levels.items():
        text += f", mix_{k} AS (SELECT {col}, m, sum(due_units)::DOUBLE AS total, {part('due_units', 'u')} FROM kh GROUP BY {col}, m), rate_{k} AS (SELECT {col}, {part('due_units', 'd')}, {part('ren_units', 'r')} FROM kh GROUP BY {col})"
    text += f", kt AS (SELECT grp, cell, everything, ord, m, sum(due_units)::DOUBLE AS total, coalesce(sum(due_units) FILTER (mark = 'neutral'), 0)::BIGINT AS neutral, {part('due_units', 'now')} FROM kr WHERE ord >= 24009 GROUP BY ALL)"
    pick = lambda x: f"CASE WHEN mg.total >= 100 THEN mg.{x} WHEN mc.total >= 100 THEN mc.{x} ELSE ma.{x} END"
    rate = lambda i: f"coalesce(CASE WHEN rg.d{i} >= 100 THEN rg.r{i} / rg.d{i} WHEN rc.d{i} >= 100 THEN rc.r{i} / rc.d{i} ELSE ra.r{i} / nullif(ra.d{i}, 0) END, 0)"
    each = ", ".join(f"coalesce({pick(f'u{i}')} / {pick('total')}, 0) AS final{i}, now{i} / kt.total AS today{i}, {rate(i)} AS there{i}" for i in range(3))
    text += f""", k0 AS (SELECT kt.grp, kt.ord, kt.neutral, kt.total, CASE WHEN mg.total >= 100 THEN 'grp' WHEN mc.total >= 100 THEN 'cell' ELSE 'all' END AS level, {each} FROM kt
  LEFT JOIN mix_g mg ON kt.grp = mg.grp AND kt.m = mg.m LEFT JOIN mix_c mc ON kt.cell = mc.cell AND kt.m = mc.m LEFT JOIN mix_a ma ON kt.m = ma.m
  LEFT JOIN rate_g rg ON kt.grp = rg.grp LEFT JOIN rate_c rc ON kt.cell = rc.cell LEFT JOIN rate_a ra ON true WHERE kt.neutral > 0),
k1 AS (SELECT *, greatest(final0 - today0, 0) AS a0, greatest(final1 - today1, 0) AS a1, greatest(final2 - today2, 0) AS a2, greatest(final0 + final2 - today0 - today2, 0) AS room0, greatest(final1 + final2 - today1 - today2, 0) AS room1 FROM k0),
k2 AS (SELECT *, CASE WHEN a0 + a2 > room0 THEN room0 / (a0 + a2) ELSE 1 END AS s0 FROM k1), k3 AS (SELECT *, a0 * s0 AS g0, a2 * s0 AS b2 FROM k2),
k4 AS (SELECT *, CASE WHEN a1 + b2 > room1 THEN room1 / (a1 + b2) ELSE 1 END AS s1 FROM k3), k5 AS (SELECT *, a1 * s1 AS g1, b2 * s1 AS g2 FROM k4),
k6 AS (SELECT *, g0 + g1 + g2 AS gap, least((g0 + g1 + g2) / (neutral / total), 1) AS moved FROM k5 WHERE g0 + g1 + g2 > 1e-12)"""
    return text + " SELECT grp, ord, level, neutral, round(moved, 6) AS moved, round((g0 * there0 + g1 * there1 + g2 * there2) / gap, 6) AS rate_there, " + ", ".join(f"round(moved * g{i} / gap, 6) AS to_{c}" for i, c in enumerate(_COMBOS)) + " FROM k6"


_CLIMBED = """, climbed AS (SELECT p.fs_id, p.pass, p.pattern, s.support, s.due_units, s.ren_units, s.series, CASE WHEN p.pass <= 2 THEN p.pass ELSE 3 END AS stage FROM pattern p JOIN pstat s ON p.pass = s.pass AND p.pattern = s.pattern JOIN chosen c ON c.fs_id = p.fs_id WHERE p.pass <= c.pass)
, stages AS (SELECT fs_id, """ + ", ".join(f"max_by(pattern, pass) FILTER (stage <= {s}) AS stage{s}_id, max_by(support, pass) FILTER (stage <= {s}) AS stage{s}_support" for s in range(4)) + " FROM climbed GROUP BY fs_id)"
_STAGE = ", money AS (SELECT s.*, coalesce(m.cents, 0) AS cents FROM stages s LEFT JOIN (SELECT fs_id, sum(due_cents) AS cents FROM units WHERE ord >= 24009 GROUP BY fs_id) m ON s.fs_id = m.fs_id) " + " UNION ALL ".join(
    f"SELECT {s} AS stage, '{n}' AS name, count(DISTINCT stage{s}_id) AS groups, count(*) AS series, round(coalesce(sum(cents) FILTER (stage{s}_support >= 30), 0)::DOUBLE / sum(cents)::DOUBLE, 6) AS share_floor, round(coalesce(sum(cents) FILTER (stage{s}_support >= 271), 0)::DOUBLE / sum(cents)::DOUBLE, 6) AS share_own FROM money"
    for s, n in enumerate(("raw", "sign", "extras", "collapse")))

_ESTIMATE = """, rt AS (SELECT fs_id, max(sign) AS sign, count(DISTINCT ord) FILTER (role <> 'proyeccion') AS old, count(DISTINCT ord) FILTER (role = 'proyeccion') AS coming, avg(ts) AS share, coalesce(sum(due_cents) FILTER (role = 'proyeccion'), 0)::BIGINT AS cents FROM fin GROUP BY fs_id),
e0 AS (SELECT rt.*, coalesce(c.pass, 0) AS pass, coalesce(c.composition, rt.fs_id) AS composition, coalesce(CASE WHEN c.fs_id IS NULL THEN s.support ELSE c.support END, 0) AS n, CASE WHEN c.fs_id IS NULL THEN s.ren_units::DOUBLE / nullif(s.due_units, 0) ELSE c.ren_units::DOUBLE / nullif(c.due_units, 0) END AS p,
  greatest(coalesce(s.support, 0), 1) AS own, coalesce(s.months, 0) AS months, f.reference, f.r_support, coalesce(kk.k, 60) AS k, f.r_ren::DOUBLE / nullif(f.r_due, 0) AS r
  FROM rt LEFT JOIN summary s ON rt.fs_id = s.fs_id LEFT JOIN chosen c ON rt.fs_id = c.fs_id LEFT JOIN refs f ON rt.fs_id = f.fs_id LEFT JOIN kk ON f.reference = kk.reference),
e1 AS (SELECT *, reference IS NOT NULL AND r IS NOT NULL AND p IS NOT NULL AND n < 271 AS blends, 100 * sqrt(p * (1 - p) / greatest(n, 1)) AS alone, 100 * sqrt(r * (1 - r) / greatest(r_support, 1)) AS wide FROM e0),
e2 AS (SELECT *, CASE WHEN blends THEN n / (n + k) ELSE 1.0::DOUBLE END AS z FROM e1),
e3 AS (SELECT *, CASE WHEN blends THEN z * p + (1 - z) * r ELSE p END AS q, CASE WHEN blends THEN sqrt(z * alone * z * alone + (1 - z) * wide * (1 - z) * wide) ELSE alone END AS err FROM e2),
est AS (SELECT fs_id, composition, pass, reference, months, round(z, 3) AS z, round(q, 6) AS rate, round(err, 6) AS error_estimate_pp, round(sqrt(err * err + 10000 * q * (1 - q) / own), 6) AS error_prediction_pp, round(100 * (q - p), 6) AS credibility_effect_pp, (n >= 30)::INT AS reaches_floor,
  CASE WHEN coming = 0 THEN 'N_sin_impacto' WHEN share <> 0 THEN 'T_universo_ts' WHEN old = 0 OR months = 0 THEN 'D_sin_historia' WHEN sign = 'mixto' THEN 'M_signo_mixto' WHEN n < 30 AND sign <> 'neutro' THEN 'S_signo_bajo_suelo' WHEN n < 30 THEN 'C_lejano'
    WHEN pass = 0 AND n >= 271 AND months >= 12 THEN 'A_propio' WHEN pass = 0 AND n >= 271 THEN 'A2_propio_corto' WHEN pass = 0 THEN 'A3_propio_reforzado' WHEN pass <= 2 THEN 'B_prestado' ELSE 'C_lejano' END AS risk, cents AS to_predict_cents FROM e3)
"""
_SECOND = """, sm AS (SELECT region, ord, coalesce(sum(ren_units), 0)::DOUBLE AS units, coalesce(sum(ren_value), 0)::DOUBLE / 20000 AS value FROM fin WHERE ts = 1 AND ord < 24009 GROUP BY ALL),
sp AS (SELECT region, sum(units) FILTER (ord BETWEEN 24006 AND 24008) AS a, sum(units) FILTER (ord BETWEEN 23994 AND 23996) AS b, sum(units) FILTER (ord >= 23997) AS yu, sum(value) FILTER (ord >= 23997) AS yv FROM sm GROUP BY region),
sl AS (SELECT region, a / nullif(b, 0) AS level, yv / nullif(yu, 0) AS price, yu, sum(a) OVER () / nullif(sum(b) OVER (), 0) AS all_level, sum(yv) OVER () / nullif(sum(yu) OVER (), 0) AS all_price, sum(yu) OVER () AS all_units FROM sp),
so AS (SELECT region, ord + 12 AS ord, units FROM sm WHERE ord BETWEEN 23997 AND 23999), sn AS (SELECT ord, sum(units) AS total FROM so GROUP BY ord),
s1 AS (SELECT sl.*, m.ord, so.units AS old, total, so.units IS NULL OR level IS NULL AS shared FROM sl CROSS JOIN (SELECT unnest([24009, 24010, 24011])::INT AS ord) m LEFT JOIN so ON so.region = sl.region AND so.ord = m.ord LEFT JOIN sn ON sn.ord = m.ord),
s2 AS (SELECT region, ord, CASE WHEN shared THEN total * all_level * yu / nullif(all_units, 0) ELSE old * level END AS units, CASE WHEN shared THEN coalesce(price, all_price) ELSE price END AS price, CASE WHEN shared THEN all_level ELSE level END AS level, shared::INT AS by_share FROM s1),
sr AS (SELECT region, sum(ren_units)::DOUBLE / nullif(sum(due_units), 0)::DOUBLE AS rate FROM fin WHERE ts = 0 AND ord BETWEEN 23997 AND 24008 GROUP BY region), sg AS (SELECT sum(ren_units)::DOUBLE / nullif(sum(due_units), 0)::DOUBLE AS rate FROM fin WHERE ts = 0 AND ord BETWEEN 23997 AND 24008)
SELECT region, ord, 'ts_real' AS origin, round(units, 4) AS units, round(value, 4) AS value, round(value, 4) AS revenue, NULL::DOUBLE AS level, NULL::INT AS by_share, NULL::DOUBLE AS rate, NULL::VARCHAR AS rate_level, NULL::DOUBLE AS renewed_units FROM sm WHERE ord >= 24000
UNION ALL SELECT region, ord, 'ts_proyectado', round(units, 4), round(units * price, 4), round(units * price, 4), round(level, 6), by_share, NULL, NULL, NULL FROM s2 WHERE units IS NOT NULL
UNION ALL SELECT s2.region, ord + 12, 'ts_reentrada', round(units, 4), round(units * price, 4), round(units * price / 0.6::DOUBLE * coalesce(sr.rate, sg.rate), 4), NULL, NULL, round(coalesce(sr.rate, sg.rate), 6), CASE WHEN sr.rate IS NULL THEN 'global' ELSE 'region' END, round(units * coalesce(sr.rate, sg.rate), 4) FROM s2 LEFT JOIN sr ON s2.region = sr.region CROSS JOIN sg WHERE units IS NOT NULL"""
_SHEETS = """, x AS (SELECT fs_id, concat_ws('|', region, product) AS cell, ord, due_units, ren_units FROM past WHERE due_units > 0),
e AS (SELECT x.*, h, ord - h AS origin FROM x CROSS JOIN (VALUES (1), (6)) v(h) WHERE ord >= 24006), o AS (SELECT DISTINCT origin FROM e),
sc AS (SELECT origin, cell, sum(ren_units)::DOUBLE / sum(due_units)::DOUBLE AS r FROM o JOIN x ON x.ord BETWEEN origin - 11 AND origin GROUP BY ALL), sa AS (SELECT origin, sum(ren_units)::DOUBLE / sum(due_units)::DOUBLE AS r FROM o JOIN x ON x.ord BETWEEN origin - 11 AND origin GROUP BY ALL)
SELECT e.fs_id, e.ord, e.h, e.due_units, e.ren_units AS real_units, round(coalesce(sc.r, sa.r), 6) AS sheet_cell, round(sa.r, 6) AS sheet_all FROM e LEFT JOIN sc ON e.origin = sc.origin AND e.cell = sc.cell LEFT JOIN sa ON e.origin = sa.origin"""

def _effect(month: str, ys: str = "ys", ms: str = "ms") -> str:
    own = f"list_transform(list_filter(list_zip({ys}, {ms}), lambda p: p[2] = {month}), lambda p: p[1])"
    return f"coalesce(list_avg({own}) - list_avg({ys}), 0.0)"


#: What is left of a damped trend, and the calendar month aimed at.
_LEFT, _AIM = "(0.9::DOUBLE * (1 - pow(0.9::DOUBLE, h)) / 0.1::DOUBLE)", "((ms[-1] - 1 + h) % 12 + 1)"
_SES = "list_sum(list_transform(ys, lambda v, i: v * CASE WHEN i = 1 THEN 1.0::DOUBLE ELSE 0.3::DOUBLE END * pow(0.7::DOUBLE, n - i)))"
_SLOPE = "list_sum(list_transform(ys, lambda v, i: v * (i - 1 - (n - 1) / 2.0::DOUBLE) * 12 / (n * (n * n - 1.0::DOUBLE))))"
_HOLT = """list_reduce(list_transform(ys, lambda v, i: {'l': v, 't': CASE WHEN i = 1 THEN ys[2] - ys[1] ELSE 0.0::DOUBLE END}), lambda a, x:
  {'l': 0.3::DOUBLE * x.l + 0.7::DOUBLE * (a.l + 0.9::DOUBLE * a.t), 't': 0.1::DOUBLE * (0.3::DOUBLE * x.l + 0.7::DOUBLE * (a.l + 0.9::DOUBLE * a.t) - a.l) + 0.9::DOUBLE * 0.9::DOUBLE * a.t})"""
_HW_LEVEL = "(0.3::DOUBLE * (x.l - a.s[x.m]) + 0.7::DOUBLE * (a.l + 0.9::DOUBLE * a.t))"
_HW = f"""list_reduce(list_prepend({{'l': list_avg(ys[1:12]), 't': 0.0::DOUBLE, 's': list_transform(range(1, 13), lambda k: {_effect("k", "ys[1:12]", "ms[1:12]")}), 'm': 0}}, list_transform(list_zip(ys[13:], ms[13:]), lambda z: {{'l': z[1], 't': 0.0::DOUBLE, 's': [0.0::DOUBLE], 'm': z[2]}})), lambda a, x:
  {{'l': {_HW_LEVEL}, 't': 0.05::DOUBLE * ({_HW_LEVEL} - a.l) + 0.95::DOUBLE * 0.9::DOUBLE * a.t, 's': list_transform(a.s, lambda v, k: CASE WHEN k = x.m THEN 0.2::DOUBLE * (x.l - {_HW_LEVEL}) + 0.8::DOUBLE * v ELSE v END), 'm': x.m}})"""
#: Name -> (months needed, logit of a row with ys, ms, n and h), in the order that settles ties.
_TECHNIQUES = {
    "T2_mean": (1, "list_avg(ys)"), "T3_ma3": (3, "list_avg(ys[-3:])"), "T3_ma6": (6, "list_avg(ys[-6:])"),
    "T4_ewma": (4, "list_sum(list_transform(ys, lambda v, i: v * pow(0.5::DOUBLE, (n - i) / 3.0::DOUBLE))) / list_sum(list_transform(ys, lambda v, i: pow(0.5::DOUBLE, (n - i) / 3.0::DOUBLE)))"), "T9_ses": (4, _SES),
    "T10_holt_damped": (12, f"({_HOLT}).l + ({_HOLT}).t * {_LEFT}"),
    "T12_theta": (12, f"(list_avg(ys) + {_SLOPE} * (n - 1) / 2.0::DOUBLE + {_SLOPE} * {_LEFT} + {_SES}) / 2"),
    "T14_temporal_cred": (6, "0.5::DOUBLE * list_avg(ys[-6:]) + 0.5::DOUBLE * list_avg(ys)"),
    "T15_level_seasonal": (13, f"list_avg(list_transform(list_zip(ys[-3:], ms[-3:]), lambda z: z[1] - {_effect('z[2]')})) + {_effect(_AIM)}"),
    "T11_holt_winters": (24, f"({_HW}).l + ({_HW}).t * {_LEFT} + ({_HW}).s[{_AIM}]"),
}
_CLIP = "ln(greatest(least({0}, 0.999), 0.001) / (1 - greatest(least({0}, 0.999), 0.001)))"


def _logits(rows: str, keep: str) -> str:
    """The logit of every technique that has its months, of rows with ys, ms, n and h."""
    return " UNION ALL ".join(f"SELECT {keep}, '{t}' AS technique, {k} AS place, {x} AS lo FROM {rows} WHERE n >= {least}" for k, (t, (least, x)) in enumerate(_TECHNIQUES.items()))


def _of_chosen(rows: str, keep: str) -> str:
    """The rate by the technique that a row names, else the challenger's."""
    own = "CASE technique " + " ".join(f"WHEN '{t}' THEN CASE WHEN n >= {least} THEN {x} END" for t, (least, x) in _TECHNIQUES.items()) + " END"
    return f"SELECT {keep}, CASE WHEN own IS NULL THEN 'T3_ma3' ELSE technique END AS technique, 1 / (1 + exp(-coalesce(own, list_avg(ys[-3:])))) AS rate FROM (SELECT *, {own} AS own FROM {rows})"


_TRIED = f""", hy AS (SELECT composition, ord, due_units, ren_units::DOUBLE / due_units AS rate, {_CLIP.format("(ren_units::DOUBLE / due_units)")} AS y, ord % 12 + 1 AS m FROM pool WHERE due_units > 0),
series_seen AS (SELECT t.composition, t.ord, h, t.rate AS real, t.due_units, list(s.y ORDER BY s.ord) AS ys, list(s.m ORDER BY s.ord) AS ms, count(*) AS n FROM hy t CROSS JOIN (VALUES (1), (6)) v(h) JOIN hy s ON s.composition = t.composition AND s.ord <= t.ord - h WHERE t.ord >= 23994 GROUP BY ALL HAVING count(*) >= 12),
lo AS ({_logits("series_seen", "composition, ord, h, real, due_units")}),
tr AS (SELECT composition, ord, CASE WHEN ord >= 24006 THEN 'examen' ELSE 'seleccion' END AS purpose, h, technique, place, 1 / (1 + exp(-lo)) AS predicted, real, due_units, 100 * (1 / (1 + exp(-lo)) - real) AS error,
  100 * (1 / (1 + exp(-lo)) - real) / (100 * sqrt(greatest(least(real, 1 - 0.5::DOUBLE / due_units), 0.5::DOUBLE / due_units) * (1 - greatest(least(real, 1 - 0.5::DOUBLE / due_units), 0.5::DOUBLE / due_units)) / due_units)) AS error_norm FROM lo),
sco AS (SELECT composition, h, technique, place, avg(abs(error_norm)) AS score, count(*) AS n FROM tr WHERE purpose = 'seleccion' GROUP BY ALL),
bst AS (SELECT *, row_number() OVER (PARTITION BY composition, h ORDER BY CASE WHEN n >= 3 THEN 0 ELSE 1 END, round(score, 9), place) AS k FROM sco),
win AS (SELECT c.composition, v.h, b.technique, b.n, coalesce(b.n >= 3 AND b.technique <> 'T3_ma3' AND b.score < coalesce(r.score, 'inf'::DOUBLE) - CASE WHEN v.h = 1 THEN 0.1::DOUBLE ELSE 0 END, false) AS wins
  FROM (SELECT DISTINCT composition FROM chosen) c CROSS JOIN (VALUES (1), (6)) v(h) LEFT JOIN bst b ON b.composition = c.composition AND b.h = v.h AND b.k = 1 LEFT JOIN sco r ON r.composition = c.composition AND r.h = v.h AND r.technique = 'T3_ma3'),
dec AS (SELECT composition, h, CASE WHEN wins THEN technique ELSE 'T3_ma3' END AS technique, CASE WHEN wins THEN 'campeon' WHEN n IS NOT NULL THEN 'retador' ELSE 'sin_soporte' END AS origin FROM win),
bnd AS (SELECT technique, h, round(quantile_cont(error_norm, 0.05), 6) AS q_low, round(quantile_cont(error_norm, 0.95), 6) AS q_high, count(*) AS n FROM tr WHERE purpose = 'seleccion' GROUP BY ALL)
"""
_FORECAST = _TRIED + f""", wgt AS (SELECT c.fs_id, c.composition, f.reference, CASE WHEN f.reference IS NULL THEN 1.0::DOUBLE ELSE round(c.support / (c.support + coalesce(kk.k, 60)), 3) END AS z, c.ren_units::DOUBLE / nullif(c.due_units, 0) AS p, f.r_ren::DOUBLE / nullif(f.r_due, 0) AS r FROM chosen c LEFT JOIN refs f ON c.fs_id = f.fs_id LEFT JOIN kk ON f.reference = kk.reference),
fut AS (SELECT u.fs_id, concat_ws('|', region, product) AS cell, ord, ord - 24009 + 1 AS h, u.due_units, composition FROM units u LEFT JOIN chosen c ON c.fs_id = u.fs_id WHERE ord >= 24009),
fh AS (SELECT composition, list(y ORDER BY ord) AS ys, list(m ORDER BY ord) AS ms, count(*) AS n FROM hy GROUP BY composition),
fq AS (SELECT q.composition, q.h, coalesce(d.technique, 'T3_ma3') AS technique, ys, ms, n FROM (SELECT DISTINCT composition, h FROM fut) q JOIN fh USING (composition) LEFT JOIN dec d ON d.composition = q.composition AND d.h = CASE WHEN q.h <= 1 THEN 1 ELSE 6 END),
fr AS ({_of_chosen("fq", "composition, h")}),
fs AS (SELECT fut.*, fr.technique, fr.rate AS pool_rate, CASE WHEN z < 1 AND p > 0 AND p < 1 AND r > 0 AND r < 1 THEN (1 - z) * ({_CLIP.format("r")} - {_CLIP.format("p")}) ELSE 0 END AS shift FROM fut LEFT JOIN fr ON fr.composition = fut.composition AND fr.h = fut.h LEFT JOIN wgt ON wgt.fs_id = fut.fs_id),
fc AS (SELECT concat_ws('|', region, product) AS cell, sum(ren_units)::DOUBLE / sum(due_units)::DOUBLE AS cell_rate FROM past WHERE due_units > 0 GROUP BY 1), fg AS (SELECT sum(ren_units)::DOUBLE / sum(due_units)::DOUBLE AS global_rate FROM past WHERE due_units > 0),
ft AS (SELECT fs.* EXCLUDE (technique), coalesce(technique, 'T3_ma3') AS technique, CASE WHEN pool_rate IS NOT NULL THEN 'pool' WHEN cell_rate IS NOT NULL THEN 'cell' ELSE 'global' END AS origin, coalesce(CASE WHEN shift = 0 THEN pool_rate ELSE 1 / (1 + exp(-({_CLIP.format("pool_rate")} + shift))) END, cell_rate, global_rate) AS rate FROM fs LEFT JOIN fc USING (cell) CROSS JOIN fg),
fe AS (SELECT ft.*, least(coalesce(b.q_low, c.q_low, -1.645::DOUBLE), 0) * sqrt(rate * (1 - rate) / greatest(due_units, 1)) AS down, greatest(coalesce(b.q_high, c.q_high, 1.645::DOUBLE), 0) * sqrt(rate * (1 - rate) / greatest(due_units, 1)) AS up
  FROM ft LEFT JOIN bnd b ON b.technique = ft.technique AND b.h = CASE WHEN ft.h <= 1 THEN 1 ELSE 6 END LEFT JOIN bnd c ON c.technique = 'T3_ma3' AND c.h = CASE WHEN ft.h <= 1 THEN 1 ELSE 6 END),
forecast AS (SELECT fs_id, ord, h, composition, origin, technique, due_units, rate, least(greatest(rate + down, 0), 1) AS rate_low, least(greatest(rate + up, 0), 1) AS rate_high, rate * due_units AS expected_units FROM fe)
"""
#: The plan that the tables of sf0.01 lead to; ``ladder_sql`` takes any.
PLAN = ((0, "itself", "", True, True), (1, "sign", "", True, True), (2, "extra channel", "channel", True, True), (3, "without region", "channel,region", True, True), (4, "without product", "channel,product,region", True, True))


def ladder_sql(query: str, plan=PLAN) -> str:
    """A query over the passes (lrun) and the patterns (lstat) of a plan, which is given as values."""
    values = ", ".join(f"({k}, '{name}', '{without}', {merges}, {signed})" for k, name, without, merges, signed in plan)
    field = lambda c: f"CASE WHEN list_contains(string_split(without, ','), '{c}') THEN '*' ELSE {c}::VARCHAR END"
    pattern = f"CASE WHEN pass = 0 THEN fs_id ELSE concat_ws('|', {field('region')}, {field('product')}, 'SIG=' || sign, {field('channel')}) END"
    return _BASE + f""", lplan(pass, name, without, merges, signed) AS (VALUES {values}),
lrt AS (SELECT fs_id, coalesce(sum(due_cents) FILTER (role = 'proyeccion'), 0)::BIGINT AS cents FROM fin GROUP BY fs_id HAVING count(*) FILTER (role <> 'proyeccion') > 0 AND count(*) FILTER (role = 'proyeccion') > 0 AND avg(ts) = 0),
leach AS (SELECT fs_id, sign, cents, pass, name, merges, pass = 0 OR (sign <> 'mixto' AND (sign = 'neutro' OR signed)) AS allowed, {pattern} AS pattern FROM names JOIN lrt USING (fs_id) CROSS JOIN lplan),
lcount AS (SELECT * FROM leach WHERE pass = 0 OR sign <> 'mixto'),
lmonth AS (SELECT pass, pattern, ord, sum(due_units) AS due FROM lcount JOIN past USING (fs_id) WHERE due_units > 0 GROUP BY ALL),
lstat AS (SELECT e.*, coalesce(s.support, 0)::DOUBLE AS support, coalesce(c.series, 1) AS series FROM leach e LEFT JOIN (SELECT pass, pattern, count(*) AS series FROM lcount GROUP BY ALL) c ON c.pass = e.pass AND c.pattern = e.pattern LEFT JOIN (SELECT pass, pattern, median(due::DOUBLE) AS support FROM lmonth GROUP BY ALL) s ON s.pass = e.pass AND s.pattern = e.pattern),
lstop AS (SELECT *, coalesce(min(pass) FILTER (allowed AND support >= 30) OVER w, max(pass) FILTER (allowed) OVER w) AS stop FROM lstat WHERE merges WINDOW w AS (PARTITION BY fs_id)),
lmove AS (SELECT *, allowed AND pass <= stop AS moves FROM lstop),
lheld AS (SELECT *, max(series) FILTER (moves) OVER (PARTITION BY fs_id ORDER BY pass ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held FROM lmove),
lrun AS (SELECT fs_id, pass, name, cents, arg_max(pattern, pass) FILTER (moves AND (held IS NULL OR series > held)) OVER w AS group_id, arg_max(support, pass) FILTER (moves) OVER w AS group_support, arg_max(series, pass) FILTER (moves) OVER w AS group_series, stop FROM lheld WINDOW w AS (PARTITION BY fs_id ORDER BY pass ROWS UNBOUNDED PRECEDING))
""" + query


_LADDER = {
    "ladder_run": "SELECT *, (pass >= stop AND group_support >= 30)::INT AS closed FROM lrun",
    "ladder_pass_summary": ", lg AS (SELECT pass, name, group_id, max(group_support) AS support, sum(cents) AS cents FROM lrun GROUP BY ALL) SELECT pass, name, count(*) AS groups, sum((support < 30)::INT)::BIGINT AS open_groups, median(support) AS median_support, round(coalesce(sum(cents) FILTER (support >= 30), 0)::DOUBLE / sum(cents)::DOUBLE, 6) AS share_floor, round(coalesce(sum(cents) FILTER (support >= 271), 0)::DOUBLE / sum(cents)::DOUBLE, 6) AS share_full FROM lg GROUP BY pass, name",
    "ladder_compositions": """, ll AS (SELECT * FROM lrun QUALIFY row_number() OVER (PARTITION BY fs_id ORDER BY pass DESC) = 1),
lw AS (SELECT s.fs_id, s.pattern AS reference, s.pass AS reference_pass, s.support AS reference_support, s.series AS reference_series, row_number() OVER (PARTITION BY s.fs_id ORDER BY CASE WHEN s.support >= 30 THEN 0 ELSE 1 END, CASE WHEN s.support >= 30 THEN s.pass ELSE -s.pass END) AS k FROM lstat s JOIN ll ON ll.fs_id = s.fs_id WHERE ll.group_support < 271 AND s.sign <> 'mixto' AND s.allowed AND s.pass > ll.stop AND s.series > ll.group_series)
SELECT ll.fs_id, group_id AS composition, stop, group_support, group_series, (pass >= stop AND group_support >= 30)::INT AS closed, reference, reference_pass, reference_support, reference_series FROM ll LEFT JOIN lw ON lw.fs_id = ll.fs_id AND k = 1""",
}

#: Uplifts with the cell's id (cells of _UPLIFT), the extension and the acquisitions, as their own queries have them.
_CORE = _FORECAST + _UPLIFT.format(before=24009) + """, xr AS (SELECT region, product, sum(ren_units)::DOUBLE / sum(due_units)::DOUBLE AS rate FROM fin WHERE ord < 24009 AND ts = 0 GROUP BY ALL),
extension AS (SELECT region, product, (ord + 12)::INT AS ord, sum(due_units)::BIGINT AS due_units, round(sum(due_units * rate), 6) AS expected_units FROM fin JOIN xr USING (region, product) WHERE ord >= 24009 AND term = '1 year' AND due_units > 0 AND ts = 0 GROUP BY region, product, ord),
am AS (SELECT region, ord, sum(raw_due_units)::BIGINT AS units FROM fin WHERE newcust = 1 AND ord < 24009 GROUP BY ALL),
al AS (SELECT region, sum(units) FILTER (ord BETWEEN 24006 AND 24008)::DOUBLE / sum(units) FILTER (ord BETWEEN 23994 AND 23996)::DOUBLE AS level FROM am GROUP BY region),
acquisition AS (SELECT region, (ord + 12)::INT AS ord, round(units * coalesce(level, 1), 6)::DOUBLE AS units FROM am JOIN al USING (region) WHERE ord >= 23997),
c1 AS (SELECT region, product, fs_id, cell_id, ord, role, CASE WHEN ts = 1 THEN 'second_universe' ELSE 'real' END AS source, sum(due_units)::BIGINT AS due_units, sum(due_cents)::BIGINT AS due_cents, sum(ren_units)::BIGINT AS ren_units, sum(ren_value)::BIGINT AS ren_value, NULL::DOUBLE AS rate, NULL::DOUBLE AS uplift, NULL::DOUBLE AS expected_units, NULL::DOUBLE AS expected_cents, NULL::DOUBLE AS expected_cents_low, NULL::DOUBLE AS expected_cents_high FROM fin WHERE ord < 24009 GROUP BY region, product, fs_id, cell_id, ord, role, ts),
c2 AS (SELECT region, product, fs_id, cell_id, ord, role, sum(due_units)::BIGINT AS due_units, sum(due_cents)::BIGINT AS due_cents FROM fin WHERE ord >= 24009 AND ts = 0 GROUP BY ALL),
core0 AS (SELECT * FROM c1
  UNION ALL SELECT c2.region, c2.product, c2.fs_id, cell_id, c2.ord, role, 'forecast', c2.due_units, c2.due_cents, NULL, NULL, f.rate, up.uplift, round(c2.due_units * f.rate, 6), round(c2.due_cents * f.rate * up.uplift, 4), round(c2.due_cents * f.rate_low * up.uplift, 4), round(c2.due_cents * f.rate_high * up.uplift, 4) FROM c2 LEFT JOIN forecast f ON f.fs_id = c2.fs_id AND f.ord = c2.ord LEFT JOIN up ON up.cell = c2.cell_id
  UNION ALL SELECT region, product, NULL, NULL, ord, 'proyeccion', 'extension', due_units, NULL, NULL, NULL, NULL, NULL, expected_units, NULL, NULL, NULL FROM extension
  UNION ALL SELECT region, NULL, NULL, NULL, ord, 'proyeccion', 'acquisition', NULL, NULL, NULL, NULL, NULL, NULL, units, NULL, NULL, NULL FROM acquisition),
core AS (SELECT *, ('0x' || substr(md5(concat_ws('|', source, coalesce(region, 'null'), coalesce(product, 'null'), coalesce(fs_id, 'null'), coalesce(cell_id, 'null'), ord::VARCHAR)), 1, 12))::BIGINT AS row_key FROM core0)
"""
_TOTAL = """, g0 AS (SELECT (ord // 12)::INT AS year, 'pipeline_renovado_real' AS origin, due_units::DOUBLE AS du, due_cents::DOUBLE / 100 AS dv, ren_units::DOUBLE AS ru, ren_value::DOUBLE / 20000 AS rv FROM fin WHERE ts = 0 AND ord < 24009
  UNION ALL SELECT (ord // 12)::INT, CASE source WHEN 'forecast' THEN 'pipeline_real_esperado' WHEN 'extension' THEN 'pipeline_proyectada' ELSE 'pipeline_simulada' END, due_units::DOUBLE, due_cents::DOUBLE / 100, expected_units, expected_cents / 100 FROM core WHERE source IN ('forecast', 'extension', 'acquisition')
  UNION ALL SELECT (ord // 12)::INT, origin, CASE WHEN origin = 'ts_reentrada' THEN units ELSE 0.0::DOUBLE END, CASE WHEN origin = 'ts_reentrada' THEN value ELSE 0.0::DOUBLE END, CASE WHEN origin = 'ts_reentrada' THEN renewed_units ELSE units END, revenue FROM second),
g1 AS (SELECT year, origin, sum(du) AS du, sum(dv) AS dv, sum(ru) AS ru, sum(rv) AS rv FROM g0 WHERE year >= 2000 GROUP BY ALL)
SELECT year, origin, round(du, 2) AS due_units, round(dv, 2) AS due_value, round(ru, 2) AS renewed_units, round(rv, 2) AS renewed_value FROM (SELECT * FROM g1 UNION ALL SELECT year, 'TOTAL', sum(du), sum(dv), sum(ru), sum(rv) FROM g1 GROUP BY year)"""
_SECOND_CTE = _SECOND[:_SECOND.index("SELECT region, ord, 'ts_real'")] + ", second AS (" + _SECOND[_SECOND.index("SELECT region, ord, 'ts_real'"):] + ")"
_SHIFT = _CLIP.format("rl.level") + " - " + _CLIP.format("cl.level")
_LEVELS = lambda name, rows, keys: f"{name} AS (SELECT {keys}, o.origin, count(*) AS n, sum(ren_units)::DOUBLE / nullif(sum(due_units), 0)::DOUBLE AS level FROM {rows} x JOIN eo o ON x.ord <= o.origin GROUP BY ALL)"
#: Every series and exam month by four methods: see operators/exam.py.
_EXAM = _FORECAST + f""", ex AS (SELECT fs_id, concat_ws('|', region, product) AS cell, ord, due_units, ren_units FROM past WHERE due_units > 0),
er AS (SELECT ex.*, h, ord - h AS origin FROM ex CROSS JOIN (VALUES (1), (6)) v(h) WHERE ord >= 24006), eo AS (SELECT DISTINCT origin FROM er),
ey AS (SELECT origin, cell, sum(ren_units)::DOUBLE / sum(due_units)::DOUBLE AS r FROM eo JOIN ex ON ex.ord BETWEEN origin - 11 AND origin GROUP BY ALL), ez AS (SELECT origin, sum(ren_units)::DOUBLE / sum(due_units)::DOUBLE AS r FROM eo JOIN ex ON ex.ord BETWEEN origin - 11 AND origin GROUP BY ALL),
{_LEVELS("lcell", "ex", "cell")}, {_LEVELS("lall", "ex", "1 AS one")}, {_LEVELS("lown", "ex", "fs_id")}, epool AS (SELECT * FROM pool WHERE due_units > 0), {_LEVELS("lcomp", "epool", "composition")},
ewide AS (SELECT p.pattern AS reference, ex.ord, ex.due_units, ex.ren_units FROM pattern p JOIN (SELECT DISTINCT reference FROM wgt WHERE reference IS NOT NULL) r ON r.reference = p.pattern JOIN ex ON ex.fs_id = p.fs_id), {_LEVELS("lref", "ewide", "reference")},
eq AS (SELECT q.composition, q.origin, q.h, coalesce(d.technique, 'T3_ma3') AS technique, list(y ORDER BY ord) AS ys, list(m ORDER BY ord) AS ms, count(*) AS n FROM (SELECT DISTINCT w.composition, er.origin, er.h FROM er JOIN wgt w USING (fs_id)) q JOIN hy ON hy.composition = q.composition AND hy.ord <= q.origin LEFT JOIN dec d ON d.composition = q.composition AND d.h = q.h GROUP BY ALL HAVING count(*) >= 3),
ecomp AS ({_of_chosen("eq", "composition, origin, h")}),
eh AS (SELECT fs_id, ord, {_CLIP.format("(ren_units::DOUBLE / due_units)")} AS y, ord % 12 + 1 AS m FROM ex),
es AS (SELECT er.fs_id, er.ord, er.h, coalesce(d.technique, 'T3_ma3') AS technique, list(y ORDER BY eh.ord) AS ys, list(m ORDER BY eh.ord) AS ms, count(*) AS n FROM er JOIN eh ON eh.fs_id = er.fs_id AND eh.ord <= er.origin LEFT JOIN wgt w ON w.fs_id = er.fs_id LEFT JOIN dec d ON d.composition = w.composition AND d.h = er.h GROUP BY ALL HAVING count(*) >= 3),
ealone AS ({_of_chosen("es", "fs_id, ord, h")}),
ebase AS (SELECT er.*, w.composition, coalesce(ey.r, ez.r) AS sheet_cell, ez.r AS sheet_all, coalesce(lc.level, la.level) AS cell_level, lo.level AS own_level, s.technique AS own_technique, s.rate AS own_rate, c.technique AS comp_technique, c.rate AS comp_rate,
  CASE WHEN c.rate IS NOT NULL AND coalesce(w.z, 1) < 1 AND rl.level > 0 AND rl.level < 1 AND cl.level > 0 AND cl.level < 1 THEN (1 - w.z) * ({_SHIFT}) ELSE 0.0::DOUBLE END AS shift
  FROM er LEFT JOIN wgt w USING (fs_id) LEFT JOIN ey ON ey.cell = er.cell AND ey.origin = er.origin LEFT JOIN ez ON ez.origin = er.origin LEFT JOIN lcell lc ON lc.cell = er.cell AND lc.origin = er.origin LEFT JOIN lall la ON la.origin = er.origin LEFT JOIN lown lo ON lo.fs_id = er.fs_id AND lo.origin = er.origin
  LEFT JOIN ealone s ON s.fs_id = er.fs_id AND s.ord = er.ord AND s.h = er.h LEFT JOIN ecomp c ON c.composition = w.composition AND c.origin = er.origin AND c.h = er.h LEFT JOIN lref rl ON rl.reference = w.reference AND rl.origin = er.origin LEFT JOIN lcomp cl ON cl.composition = w.composition AND cl.origin = er.origin),
em AS (SELECT *, 'raw' AS method, coalesce(own_technique, CASE WHEN own_level IS NOT NULL THEN 'own_level' END, 'mandatory_cell') AS technique, coalesce(own_rate, own_level, cell_level) AS pred_rate, NULL::DOUBLE AS composition_rate, 0.0::DOUBLE AS moved FROM ebase
  UNION ALL SELECT *, 'framework', coalesce(comp_technique, 'mandatory_cell'), coalesce(CASE WHEN shift = 0 THEN comp_rate ELSE 1 / (1 + exp(-({_CLIP.format("comp_rate")} + shift))) END, cell_level), comp_rate, shift FROM ebase
  UNION ALL SELECT *, 'hoja_mandatory', 'last 12 months', sheet_cell, NULL, 0.0 FROM ebase UNION ALL SELECT *, 'hoja_global', 'last 12 months', sheet_all, NULL, 0.0 FROM ebase),
en AS (SELECT em.*, sqrt(pred_rate * (1 - pred_rate) / greatest(due_units, 1)) AS se, least(coalesce(b.q_low, c.q_low, -1.645::DOUBLE), 0) AS ql, greatest(coalesce(b.q_high, c.q_high, 1.645::DOUBLE), 0) AS qh FROM em LEFT JOIN bnd b ON b.technique = em.technique AND b.h = em.h LEFT JOIN bnd c ON c.technique = 'T3_ma3' AND c.h = em.h),
ed AS (SELECT fs_id, composition, ord, h, origin, due_units, ren_units AS real_units, method, technique, pred_rate, composition_rate, moved AS shift, CASE WHEN method IN ('raw', 'framework') THEN least(greatest(pred_rate + ql * se, 0), 1) END AS band_low, CASE WHEN method IN ('raw', 'framework') THEN least(greatest(pred_rate + qh * se, 0), 1) END AS band_high,
  ren_units::DOUBLE / due_units AS real_rate, pred_rate * due_units AS pred_units, pred_rate * due_units - ren_units AS err_units, 100 * (pred_rate - ren_units::DOUBLE / due_units) AS err_pp, 100 * sqrt(greatest(pred_rate * (1 - pred_rate), 0) / greatest(due_units, 1)) AS noise_pp FROM en),
exam AS (SELECT *, CASE WHEN band_low IS NOT NULL THEN (real_rate BETWEEN band_low - 1e-12 AND band_high + 1e-12)::INT END AS in_band FROM ed)
"""
_R6 = lambda *names: ", ".join(f"round({n}, 6) AS {n}" for n in names)


def _per_series() -> str:
    out = []
    for m in ("raw", "framework"):
        on = f"FILTER (method = '{m}')"
        rms = lambda c, on=on: f"sqrt(avg({c} * {c}) {on})"
        values = {"predictions": f"count(*) {on}", "in_band": f"sum(in_band) {on}::BIGINT", "pred_units": f"round(sum(pred_units) {on}, 6)", "real_units": f"sum(real_units) {on}::BIGINT", "abs_err_units": f"round(sum(abs(err_units)) {on}, 6)", "mae_pp": f"round(avg(abs(err_pp)) {on}, 6)", "bias_pp": f"round(avg(err_pp) {on}, 6)", "rmse_pp": f"round({rms('err_pp')}, 6)", "noise_pp": f"round({rms('noise_pp')}, 6)",
                  "error_over_noise": f"round({rms('err_pp')} / nullif({rms('noise_pp')}, 0), 6)", "wape": f"round(sum(abs(err_units)) {on} / nullif(sum(real_units) {on}, 0)::DOUBLE, 6)", "coverage": f"round(sum(in_band) {on}::DOUBLE / (count(*) {on})::DOUBLE, 6)"}
        out += [f"{v} AS {m}_{k}" for k, v in values.items()]
    return "SELECT fs_id, " + ", ".join(out) + ", round(avg(abs(err_pp)) FILTER (method = 'raw') - avg(abs(err_pp)) FILTER (method = 'framework'), 6) AS improvement_mae_pp FROM exam GROUP BY fs_id"


_MONTHS = ", emon AS (SELECT ord, h, method, sum(pred_units) AS pred_units, sum(real_units)::BIGINT AS real_units, (sum(pred_units) - sum(real_units)) / nullif(sum(real_units), 0)::DOUBLE AS error_total FROM exam GROUP BY ALL)"


def _differ(name: str, written: str, again: str, keys: list[str], values: list[str]) -> str:
    key = "concat_ws('|', " + ", ".join(f"coalesce(coalesce(a.{k}, b.{k})::VARCHAR, 'null')" for k in keys) + ")"
    each = ", ".join(f"{{'value': '{v}', 'written': a.{v}::DOUBLE, 'again': b.{v}::DOUBLE}}" for v in values)
    on = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    return f"""SELECT '{name}' AS what, key, x.value AS value, x.written AS written, x.again AS again FROM (SELECT {key} AS key, a.here IS NULL OR b.here IS NULL AS alone, unnest([{each}]) AS x FROM (SELECT *, 1 AS here FROM ({written})) a FULL JOIN (SELECT *, 1 AS here FROM ({again})) b ON {on})
WHERE alone OR NOT coalesce(abs(x.written - x.again) <= 1e-6 * greatest(1, abs(x.again)) OR (x.written IS NULL AND x.again IS NULL), false)"""


def _audit() -> str:
    sums = lambda table, keys, *v: f"SELECT {keys}, " + ", ".join(f"sum({c}) AS {c}" for c in v) + f" FROM {table} GROUP BY ALL"
    three, two = ("due_units", "due_cents", "ren_units"), ("due_units", "ren_units")
    done = "(SELECT fs_id, ord, due_units, ren_units FROM fin WHERE ts = 0 AND ord < 24009)"
    lent = f"(SELECT q.composition, d.ord, d.due_units, d.ren_units FROM {done} d JOIN (SELECT DISTINCT l.fs_id, l.pattern AS composition FROM ladder l JOIN chosen c ON c.pass = l.pass AND c.composition = l.pattern) q ON q.fs_id = d.fs_id)"
    wide = f"(SELECT q.reference, d.due_units, d.ren_units FROM {done} d JOIN (SELECT DISTINCT l.fs_id, l.pattern AS reference FROM ladder l JOIN refs r ON r.reference = l.pattern) q ON q.fs_id = d.fs_id)"
    return " UNION ALL ".join([
        _differ("units", sums("units", "ord", *three), sums("fin WHERE ts = 0", "ord", *three), ["ord"], list(three)),
        _differ("pooled", "SELECT composition, ord, due_units, ren_units FROM pool", sums(lent, "composition, ord", *two), ["composition", "ord"], list(two)),
        _differ("references", "SELECT DISTINCT reference, r_ren::DOUBLE / r_due AS rate FROM refs", f"SELECT reference, sum(ren_units)::DOUBLE / sum(due_units)::DOUBLE AS rate FROM {wide} GROUP BY reference", ["reference"], ["rate"]),
        _differ("forecast", sums("forecast", "ord", "due_units"), sums("fin WHERE ts = 0 AND ord >= 24009", "ord", "due_units"), ["ord"], ["due_units"]),
        _differ("core", sums("core WHERE source IN ('real', 'second_universe', 'forecast')", "ord", "due_cents"), sums("fin WHERE ts = 0 OR ord < 24009", "ord", "due_cents"), ["ord"], ["due_cents"])])


_TABLES = {"fine": "fin", "units": "units", "routes": "rt0", "summary": "sum0", "weights": "wgt0", "members": "bridge", "pooled": "pool", "forecast": "forecast", "core": "core"}
_STATISTICS = """, own AS (SELECT composition, n, sxx, slope, sum(ren_units)::DOUBLE / sum(due_units)::DOUBLE AS rate, var_samp(rate) AS var, avg(1.0::DOUBLE / due_units) AS per, sum(w * res * res) AS rss FROM d3 GROUP BY composition, n, sxx, slope),
sea AS (SELECT composition, df1, df2, within, between_, max(effect) - min(effect) AS amplitude, coalesce(string_agg(month::VARCHAR, ',' ORDER BY month) FILTER (effect > 2 * error), '') AS high, coalesce(string_agg(month::VARCHAR, ',' ORDER BY month) FILTER (-effect > 2 * error), '') AS low FROM m4 GROUP BY composition, df1, df2, within, between_),
mid AS (SELECT composition, median(y) AS middle FROM (SELECT DISTINCT composition, ord // 12 AS y FROM d3) GROUP BY composition),
hv AS (SELECT composition, ord % 12 AS m, avg(res) FILTER (ord // 12 <= middle) AS a, avg(res) FILTER (ord // 12 > middle) AS b FROM d3 JOIN mid USING (composition) GROUP BY ALL),
st AS (SELECT composition, CASE WHEN count(*) >= 3 AND stddev(a) > 0 AND stddev(b) > 0 THEN round(corr(a, b), 6) END AS consistency FROM hv WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY composition)
SELECT own.composition, n AS months, round(rate, 6) AS rate, round(var / nullif(rate * (1 - rate) * per, 0), 6) AS phi, round(100 * slope, 6) AS trend_pp, round(coalesce(slope / nullif(sqrt(rss / (n - 2) / sxx), 0), 0), 6) AS t, round(CASE WHEN within > 1e-15 THEN (between_ / df1) / (within / df2) ELSE 0 END, 6)::DOUBLE AS f, df1, df2, round(100 * amplitude, 6) AS amplitude_pp, high, low, consistency FROM own JOIN sea USING (composition) LEFT JOIN st USING (composition)"""


def _measured(name: str, months: str, least: int = 24) -> str:
    """CTE of a table's statistics (months: composition, ord, due_units, ren_units)."""
    text = (_DYNAMICS + _STATISTICS).replace("FROM pool WHERE", f"FROM {months} WHERE").replace("n >= 24", f"n >= {least}")
    return f", {name} AS (WITH " + text.strip().removeprefix(",") + ")"


#: Simpson's places and weights on [0, 1].
_SIMPSON = ", simpson AS (SELECT i / 4000.0::DOUBLE AS u, CASE WHEN i IN (0, 4000) THEN 1.0::DOUBLE WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END AS c FROM range(4001) r(i))"


def _tested(name: str, of: str) -> str:
    """CTE of statistics with p-values: P(F > f) is an incomplete beta function, summed on the sine-squared scale."""
    area = lambda top, d1, d2: f"sum(c * pow(sin(u * ({top})), {d2} - 1) * pow(abs(cos(u * ({top}))), {d1} - 1))"

    def tail(f, d1, d2):
        top = f"asin(sqrt(least({d2} / ({d2} + {d1} * ({f})), 1.0::DOUBLE)))"
        return f"round({area(top, d1, d2)} * any_value({top}) / ({area('pi() / 2', d1, d2)} * pi() / 2), 6)"

    return f""", {name}_p AS (SELECT composition, {tail('t * t', '1', '(months - 2)')} AS p_trend, {tail('f', 'df1', 'df2')} AS p_month FROM {of} CROSS JOIN simpson GROUP BY composition),
{name} AS (SELECT *, CASE WHEN p_trend < 0.05 THEN sign(trend_pp)::INT ELSE 0 END AS trend, (p_month < 0.05)::INT AS seasonal FROM {of} JOIN {name}_p USING (composition))"""


_POOLS = _measured("pool_st", "pool") + _SIMPSON + _tested("pool_t", "pool_st")
_OWN = """, own_months AS (SELECT fs_id AS composition, ord, due_units, ren_units FROM past)""" + _measured("own_st", "own_months", 12) + _tested("own_t", "own_st") + """,
sdyn AS (SELECT fs_id, c.composition, coalesce(q.n, 0) AS months, coalesce(s.support, 0) AS own_support, CASE WHEN coalesce(q.n, 0) < 12 THEN 'short_history' WHEN coalesce(s.support, 0) < 30 THEN 'low_support' ELSE 'yes' END AS measurable, o.phi,
  CASE WHEN o.trend_pp <> 0 THEN o.trend WHEN o.trend_pp IS NOT NULL THEN 0 END AS trend, o.trend_pp, CASE WHEN o.trend_pp <> 0 THEN o.p_trend WHEN o.trend_pp IS NOT NULL THEN 1.0::DOUBLE END AS p_trend,
  CASE WHEN o.months >= 24 THEN CASE WHEN o.amplitude_pp <> 0 THEN o.seasonal ELSE 0 END END AS seasonal, CASE WHEN o.months >= 24 THEN CASE WHEN o.amplitude_pp <> 0 THEN o.p_month ELSE 1.0::DOUBLE END END AS p_month, CASE WHEN o.months >= 24 THEN o.amplitude_pp END AS amplitude_pp,
  CASE WHEN o.months >= 24 THEN CASE WHEN o.amplitude_pp <> 0 THEN o.high ELSE '' END END AS high, CASE WHEN o.months >= 24 THEN CASE WHEN o.amplitude_pp <> 0 THEN o.low ELSE '' END END AS low, g.trend AS composition_trend, g.seasonal AS composition_seasonal
  FROM chosen c LEFT JOIN (SELECT fs_id, count(*) AS n FROM past WHERE due_units > 0 GROUP BY fs_id) q USING (fs_id) LEFT JOIN summary s USING (fs_id) LEFT JOIN own_t o ON o.composition = fs_id LEFT JOIN pool_t g ON g.composition = c.composition)
"""
_PORTFOLIO = ", everything AS (SELECT 'portfolio' AS composition, ord, sum(due_units)::BIGINT AS due_units, sum(ren_units)::BIGINT AS ren_units FROM past WHERE due_units > 0 GROUP BY ord)"


def _segments() -> str:
    marks = {"all": "true", "low_phi": "phi <= 1.5", "high_phi": "phi > 1.5", "trend": "measurable = 'yes' AND coalesce(trend, 0) <> 0", "no_trend": "measurable = 'yes' AND coalesce(trend, 0) = 0", "seasonal": "measurable = 'yes' AND seasonal = 1", "not_seasonal": "measurable = 'yes' AND seasonal = 0", "not_measurable": "coalesce(measurable, '') <> 'yes'"}
    of = lambda m, a, b: f"round(sum({m}_{a}) / nullif(sum({m}_{b}), 0)::DOUBLE, 6)"
    one = lambda name, where: (f"SELECT '{name}' AS segment, count(*) AS series, sum(framework_predictions)::BIGINT AS predictions, {of('framework', 'in_band', 'predictions')} AS in_band, {of('raw', 'in_band', 'predictions')} AS in_band_raw, {of('framework', 'abs_err_units', 'real_units')} AS wape, {of('raw', 'abs_err_units', 'real_units')} AS wape_raw, "  # noqa: E731
                               f"round(sum(framework_pred_units) / nullif(sum(framework_real_units), 0)::DOUBLE - 1, 6) AS bias FROM ps WHERE {where} HAVING count(*) > 0")
    return ", ps AS (SELECT * FROM (" + _per_series() + ") LEFT JOIN sdyn USING (fs_id) WHERE framework_predictions > 0) " + " UNION ALL ".join(one(n, w) for n, w in marks.items())


_NOISE = ", nz AS (SELECT * FROM exam WHERE method IN ('raw', 'framework'))"
_TRIALS = f""", sbt AS (SELECT w.fs_id, t.composition, t.ord, t.h, t.technique, coalesce((d.technique = t.technique)::INT, 0) AS chosen, t.predicted, e.due_units, e.ren_units,
  CASE WHEN coalesce(w.z, 1) < 1 AND r.level > 0 AND r.level < 1 AND c.level > 0 AND c.level < 1 THEN (1 - w.z) * ({_CLIP.format('r.level')} - {_CLIP.format('c.level')}) ELSE 0 END AS shift
  FROM tr t JOIN wgt w ON w.composition = t.composition JOIN ex e ON e.fs_id = w.fs_id AND e.ord = t.ord LEFT JOIN dec d ON d.composition = t.composition AND d.h = t.h
  LEFT JOIN lcomp c ON c.composition = t.composition AND c.origin = t.ord - t.h LEFT JOIN lref r ON r.reference = w.reference AND r.origin = t.ord - t.h WHERE t.purpose = 'examen'),
sb1 AS (SELECT *, CASE WHEN shift = 0 THEN predicted ELSE 1 / (1 + exp(-({_CLIP.format('predicted')} + shift))) END AS pred_rate FROM sbt),
sb2 AS (SELECT s.*, ren_units::DOUBLE / due_units AS real_rate, pred_rate * due_units AS pred_units, pred_rate * due_units - ren_units AS err_units, 100 * (pred_rate - ren_units::DOUBLE / due_units) AS err_pp, 100 * sqrt(pred_rate * (1 - pred_rate) / greatest(due_units, 1)) AS noise_pp,
  least(coalesce(b.q_low, c.q_low, -1.645::DOUBLE), 0) AS ql, greatest(coalesce(b.q_high, c.q_high, 1.645::DOUBLE), 0) AS qh FROM sb1 s LEFT JOIN bnd b ON b.technique = s.technique AND b.h = s.h LEFT JOIN bnd c ON c.technique = 'T3_ma3' AND c.h = s.h),
sb3 AS (SELECT *, least(greatest(pred_rate + ql * noise_pp / 100, 0), 1) AS band_low, least(greatest(pred_rate + qh * noise_pp / 100, 0), 1) AS band_high, CASE WHEN noise_pp > 0 THEN err_pp / noise_pp END AS err_norm FROM sb2)
"""
_GAIN = ", ba AS (SELECT est.*, coalesce(s.support, 0) AS own_support, CASE WHEN s.months > 0 THEN CASE WHEN s.due_units <= 0 OR s.q IS NULL THEN 50.0::DOUBLE ELSE round(100 * (1.645::DOUBLE * sqrt(s.q * (1 - s.q) / s.due_units + 2.706025::DOUBLE / (4 * s.due_units::DOUBLE * s.due_units)) / (1 + 2.706025::DOUBLE / s.due_units)), 6) END END AS before, 1.645::DOUBLE * error_estimate_pp AS after FROM est LEFT JOIN (SELECT *, ren_units::DOUBLE / nullif(due_units, 0) AS q FROM summary) s USING (fs_id))"
_DEEP = {
    "forecast_monthly_totals": _FORECAST + "SELECT ord, sum(due_units)::BIGINT AS due_units, round(sum(expected_units), 4) AS expected, round(sum(rate_low * due_units), 4) AS low, round(sum(rate_high * due_units), 4) AS high, round(sum(expected_units) - sqrt(sum(((rate - rate_low) * due_units) ^ 2)), 4) AS quadrature_low, round(sum(expected_units) + sqrt(sum(((rate_high - rate) * due_units) ^ 2)), 4) AS quadrature_high FROM forecast GROUP BY ord",
    "dynamics_tests": _POOLS + " SELECT * FROM pool_t",
    "series_dynamics": _POOLS + _OWN + " SELECT *, (measurable = 'yes' AND composition_trend IS NOT NULL AND coalesce((trend <> 0 AND trend <> composition_trend) OR seasonal <> composition_seasonal, false))::INT AS differs FROM sdyn",
    "dynamics_shares": _POOLS + ", pm AS (SELECT t.*, coalesce(sum(u.due_cents), 0)::BIGINT AS cents FROM pool_t t JOIN chosen c USING (composition) LEFT JOIN (SELECT fs_id, due_cents FROM units WHERE ord >= 24009) u USING (fs_id) GROUP BY ALL) " + " UNION ALL ".join(f"SELECT '{n}' AS attribute, count(*) AS compositions, sum(cents)::BIGINT AS cents, round(coalesce(sum(cents)::DOUBLE / nullif((SELECT sum(cents) FROM pm), 0)::DOUBLE, 0), 6) AS share FROM pm WHERE {w} HAVING count(*) > 0" for n, w in {"measured": "phi IS NOT NULL", "more_than_noise": "phi > 1.5", "trend": "trend <> 0", "seasonal": "seasonal = 1"}.items()),
    "portfolio_dynamics": _PORTFOLIO + _measured("all_st", "everything") + _SIMPSON + _tested("all_t", "all_st") + " SELECT * FROM all_t",
    "portfolio_month_profile": _PORTFOLIO + _DYNAMICS.replace("FROM pool WHERE", "FROM everything WHERE") + "SELECT composition, month, round(100 * effect, 6) AS effect_pp, round(100 * error, 6) AS error_pp, seen FROM m4",
    "exam_segments": _EXAM + _POOLS + _OWN + _segments(),
    "exam_noise_by_size": _EXAM + _NOISE + ", ns AS (SELECT CASE WHEN due_units < 30 THEN 0 WHEN due_units < 271 THEN 30 ELSE 271 END AS due_from, method, count(*) AS predictions, sqrt(avg(err_pp * err_pp)) AS error_pp, sqrt(avg(noise_pp * noise_pp)) AS noise_pp FROM nz GROUP BY 1, 2) SELECT due_from, method, predictions, " + _R6("error_pp", "noise_pp") + ", round(error_pp / nullif(noise_pp, 0), 6) AS error_over_noise, round(CASE WHEN error_pp > 0 THEN least(noise_pp * noise_pp / (error_pp * error_pp), 1) END, 6) AS noise_share FROM ns",
    "exam_noise_of_total": _EXAM + _NOISE + ", nt AS (SELECT ord, h, method, 100 * (sum(pred_units) - sum(real_units)) / sum(due_units) AS e, 100 * sqrt(sum(pred_rate * (1 - pred_rate) * due_units)) / sum(due_units) AS z FROM nz GROUP BY ALL) SELECT method, round(sqrt(avg(e * e)), 6) AS error_pp, round(sqrt(avg(z * z)), 6) AS noise_pp, round(sqrt(avg(e * e)) / nullif(sqrt(avg(z * z)), 0), 6) AS error_over_noise FROM nt GROUP BY method",
    "support_buckets": _ESTIMATE + _GAIN + " SELECT CASE WHEN own_support <= 0 THEN '0_none' WHEN own_support < 30 THEN '1_below_floor' WHEN own_support < 271 THEN '2_evidence' ELSE '3_own_rate' END AS support, count(*) AS series, sum(to_predict_cents)::BIGINT AS to_predict_cents, round(coalesce(sum(to_predict_cents)::DOUBLE / nullif((SELECT sum(to_predict_cents) FROM ba), 0)::DOUBLE, 0), 6) AS share FROM ba GROUP BY 1",
    "support_gain": _ESTIMATE + _GAIN + " SELECT sum(to_predict_cents)::BIGINT AS all_cents, " + ", ".join(f"coalesce(sum(to_predict_cents) FILTER ({c} <= 5), 0)::BIGINT AS known_cents_{c}, round(sum(coalesce({c}, 50) * to_predict_cents) / nullif(sum(to_predict_cents), 0)::DOUBLE, 6) AS error_pp_{c}" for c in ("before", "after")) + " FROM ba",
    "series_backtest": _EXAM + _TRIALS + " SELECT fs_id, composition, ord, h, technique, chosen, due_units, ren_units AS real_units, (real_rate BETWEEN band_low - 1e-12 AND band_high + 1e-12)::INT AS in_band, " + _R6("shift", "predicted", "pred_rate", "real_rate", "pred_units", "err_units", "err_pp", "noise_pp", "err_norm", "band_low", "band_high") + " FROM sb3",
    "series_technique_summary": _EXAM + _TRIALS + """, sq AS (SELECT fs_id, composition, h, technique, count(*) AS predictions, avg(abs(err_pp)) AS abs_err_pp, avg(err_pp) AS bias_pp, round(avg(abs(err_norm)), 9) AS abs_err_norm, sum(abs(err_units)) / nullif(sum(ren_units), 0)::DOUBLE AS wape, max(chosen) AS chosen FROM sb3 GROUP BY ALL),
sr AS (SELECT *, CASE WHEN abs_err_norm IS NOT NULL THEN rank() OVER (PARTITION BY fs_id, h, abs_err_norm IS NULL ORDER BY abs_err_norm)::INT END AS rank FROM sq)
SELECT fs_id, composition, h, technique, predictions, chosen, rank, coalesce((rank = 1)::INT, 0) AS best, max(CASE WHEN chosen = 1 THEN rank END) OVER (PARTITION BY fs_id, h) AS chosen_rank, """ + _R6("abs_err_pp", "bias_pp", "abs_err_norm", "wape") + " FROM sr",
}
_LATE = {
    "check_registry": _CORE + ", rt0 AS (SELECT DISTINCT fs_id FROM fin), sum0 AS (SELECT *, ren_units::DOUBLE / nullif(due_units, 0) AS rate FROM summary), wgt0 AS (SELECT * FROM wgt) " + in_sql(_TABLES),
    "audit_differences": _CORE + _audit(),
    "technique_trials": _TRIED + ", tt AS (SELECT c.composition, v.h, t.technique FROM (SELECT DISTINCT composition FROM chosen) c CROSS JOIN (VALUES (1), (6)) v(h) CROSS JOIN (VALUES " + ", ".join(f"('{t}')" for t in _TECHNIQUES) + """) t(technique)),
te AS (SELECT composition, h, technique, count(*) AS k, avg(abs(error_norm)) FILTER (purpose = 'seleccion') AS sn, avg(abs(error)) FILTER (purpose = 'seleccion') AS se, avg(abs(error_norm)) FILTER (purpose = 'examen') AS en, avg(abs(error)) FILTER (purpose = 'examen') AS ee FROM tr GROUP BY ALL)
SELECT tt.composition, tt.h, tt.technique, CASE WHEN k IS NULL THEN 'too_short' ELSE 'tested' END AS status, coalesce(k, 0) AS predictions, round(sn, 6) AS selection_error_norm, round(se, 6) AS selection_error, round(en, 6) AS exam_error_norm, round(ee, 6) AS exam_error,
  CASE WHEN sn IS NOT NULL THEN rank() OVER (PARTITION BY tt.composition, tt.h, sn IS NULL ORDER BY round(sn, 9)) END::INT AS rank, (tt.technique = dec.technique)::INT AS chosen
  FROM tt LEFT JOIN te ON te.composition = tt.composition AND te.h = tt.h AND te.technique = tt.technique LEFT JOIN dec ON dec.composition = tt.composition AND dec.h = tt.h""",
    "price_longest_runs": _MONITOR.format(step="0.002") + """, pr AS (SELECT *, row_number() OVER (PARTITION BY product ORDER BY ord) - row_number() OVER (PARTITION BY product, above ORDER BY ord) AS isle FROM mon WHERE ord BETWEEN 23997 AND 24008 AND step IS NOT NULL),
pq AS (SELECT product, above, isle, count(*) AS n, max(step) AS step FROM pr GROUP BY ALL), ps AS (SELECT product, sum(n)::BIGINT AS months, coalesce(sum(n) FILTER (above = 1), 0)::BIGINT AS months_above, coalesce(max(n) FILTER (above = 1), 0)::BIGINT AS longest_run, max(step) AS largest_step FROM pq GROUP BY product)
SELECT *, CASE WHEN longest_run >= 3 THEN 'increase' WHEN months_above > 0 THEN 'scattered' ELSE 'none' END AS verdict FROM ps""",
    "uplift_homogeneity": """, hl AS (SELECT region, CASE WHEN percent IS NULL THEN 'sin_dato' WHEN percent < 10 THEN '01 _ 0-10%' WHEN percent < 20 THEN '02 _ 10-20%' WHEN percent < 30 THEN '03 _ 20-30%' WHEN percent < 40 THEN '04 _ 30-40%' ELSE '05 _ 40-100%' END AS bucket, base_cents::DOUBLE AS w, ren_value / 200.0::DOUBLE AS wu FROM lic WHERE ts = 0 AND ord < 24009 AND ren_units > 0 AND base_cents > 0),
h1 AS (SELECT region, bucket, count(*) AS n, sum(wu) / sum(w) AS m, sum(wu * wu / w) / sum(w) AS q FROM hl GROUP BY ALL), h2 AS (SELECT region, bucket, count(*) AS n, sum(ren_value / 200.0::DOUBLE) / sum(base_cents)::DOUBLE AS m, sum((ren_value / 200.0::DOUBLE) * (ren_value / 200.0::DOUBLE) / base_cents) / sum(base_cents)::DOUBLE AS q FROM renew GROUP BY ALL)
SELECT region, bucket, h1.n AS exact_rows, round(h1.m, 6) AS exact_mean, round(sqrt(greatest(h1.q - h1.m * h1.m, 0)), 6) AS exact_std, h2.n AS rows_rows, round(h2.m, 6) AS rows_mean, round(sqrt(greatest(h2.q - h2.m * h2.m, 0)), 6) AS rows_std, round(round(sqrt(greatest(h1.q - h1.m * h1.m, 0)), 6) - round(sqrt(greatest(h2.q - h2.m * h2.m, 0)), 6), 6) AS hidden FROM h1 FULL JOIN h2 USING (region, bucket)""",
    "core_table": _CORE + "SELECT region, product, fs_id, cell_id, ord, role, source, due_units, due_cents, ren_units, ren_value, round(rate, 9) AS rate, uplift, expected_units, expected_cents, expected_cents_low, expected_cents_high, row_key FROM core",
    "new_rows_by_source": _CORE + "SELECT ord, source, count(*) AS rows, coalesce(sum(due_units), 0)::BIGINT AS due_units, round(coalesce(sum(expected_units), 0), 4) AS expected_units FROM core GROUP BY ord, source",
    "grand_total": _CORE + _SECOND_CTE + _TOTAL,
    "series_exam": _EXAM + "SELECT fs_id, composition, ord, h, origin, due_units, real_units, method, technique, in_band, " + _R6("pred_rate", "composition_rate", "shift", "band_low", "band_high", "real_rate", "pred_units", "err_units", "err_pp", "noise_pp") + " FROM exam",
    "series_exam_per_series": _EXAM + _per_series(),
    "series_exam_by_month": _EXAM + _MONTHS + "SELECT ord, h, method, real_units, " + _R6("pred_units", "error_total") + " FROM emon",
    "series_exam_summary": _EXAM + _MONTHS + """, e2 AS (SELECT method, h, avg(abs(error_total)) AS mean_error_total, avg(error_total) AS mean_bias_total FROM emon GROUP BY ALL), e3 AS (SELECT method, h, sum(abs(err_units)) / nullif(sum(real_units), 0)::DOUBLE AS wape_series, sqrt(avg(err_pp * err_pp)) / nullif(sqrt(avg(noise_pp * noise_pp)), 0) AS error_over_noise, avg(in_band) AS in_band FROM exam GROUP BY ALL)
SELECT method, h, """ + _R6("mean_error_total", "mean_bias_total", "wape_series", "error_over_noise", "in_band") + " FROM e2 JOIN e3 USING (method, h)",
    "series_cards": _FORECAST + """, ct AS (SELECT fs_id, count(DISTINCT ord) FILTER (role = 'entrenamiento') AS t, count(DISTINCT ord) FILTER (role = 'examen') AS e, count(DISTINCT ord) FILTER (role = 'proyeccion') AS p, coalesce(sum(due_cents) FILTER (role = 'proyeccion'), 0)::BIGINT AS to_predict_cents FROM fin WHERE ts = 0 GROUP BY fs_id)
SELECT ct.fs_id, concat_ws('+', CASE WHEN t > 0 THEN 'entrenamiento' END, CASE WHEN e > 0 THEN 'examen' END, CASE WHEN ct.p > 0 THEN 'proyeccion' END) AS coverage, CASE WHEN t + e > 0 AND ct.p > 0 THEN 'predecible' WHEN t + e > 0 THEN 'solo_historia' ELSE 'solo_futuro' END AS route, to_predict_cents, s.support AS own_support, s.months, round(s.ren_units::DOUBLE / nullif(s.due_units, 0), 6) AS own_rate,
  round(CASE WHEN s.fs_id IS NULL THEN NULL WHEN s.due_units <= 0 THEN 50.0 ELSE 100 * (1.645::DOUBLE * sqrt(s.ren_units::DOUBLE / s.due_units * (1 - s.ren_units::DOUBLE / s.due_units) / s.due_units + 2.706025::DOUBLE / (4 * s.due_units::DOUBLE * s.due_units)) / (1 + 2.706025::DOUBLE / s.due_units)) END, 6)::DOUBLE AS half_width,
  c.sign, c.pass, c.composition, c.support AS group_support, c.series, w.reference, w.z, round(w.z * w.p + (1 - w.z) * coalesce(w.r, w.p), 6) AS blended_rate, CASE WHEN s.support >= 271 THEN 'high' WHEN coalesce(c.support, 0) >= 30 THEN 'medium' ELSE 'low' END AS confidence
  FROM ct LEFT JOIN summary s USING (fs_id) LEFT JOIN chosen c USING (fs_id) LEFT JOIN wgt w USING (fs_id)""",
}

_BUCKET = "CASE WHEN percent IS NULL THEN 'sin_dato' WHEN percent < 10 THEN '01 _ 0-10%' WHEN percent < 20 THEN '02 _ 10-20%' WHEN percent < 30 THEN '03 _ 20-30%' WHEN percent < 40 THEN '04 _ 30-40%' ELSE '05 _ 40-100%' END"
_RATIO_EDGES = {"lt095": (0, 950), "095_100": (950, 1000), "100_105": (1000, 1050), "105_110": (1050, 1100), "110_120": (1100, 1200), "ge120": (1200, 10 ** 6)}
_UPLIFT_EDGES = (0, 800, 900, 950, 975, 1000, 1025, 1050, 1100, 1200, 1500)
#: The population of the revaluation report: extract rows with renewers (iso), those of the last months (pop), by series (val).
_ISOLATED = ", iso AS (SELECT ord, concat_ws('|', region, product, dormant, softcancel, autorenew, channel) AS fs_id, region, product, newcust, percent, " + _BUCKET + """ AS bucket, sum(due_units)::BIGINT AS due_units, sum(due_cents)::BIGINT AS due_cents, sum(ren_units)::BIGINT AS ren_units, sum(ren_value)::BIGINT AS ren_value,
  coalesce(sum(ren_units) FILTER (alone), 0)::BIGINT AS i_units, coalesce(sum(ren_value) FILTER (alone), 0)::BIGINT AS i_value, coalesce(sum(base_cents) FILTER (alone), 0)::BIGINT AS i_base, coalesce(sum((ren_value / 200.0::DOUBLE) ^ 2 / base_cents) FILTER (alone), 0) AS i_square, """ + ", ".join(f"coalesce(sum(base_cents) FILTER (alone AND ren_value * 5 >= base_cents * {a} AND ren_value * 5 < base_cents * {b}), 0)::BIGINT AS b_{n}" for n, (a, b) in _RATIO_EDGES.items()) + """
  FROM (SELECT *, softcancel = 0 AND ren_units > 0 AND base_cents > 0 AS alone FROM lic WHERE ts = 0 AND ord < 24009) GROUP BY ord, region, product, dormant, softcancel, autorenew, channel, newcust, percent, term HAVING sum(ren_units) > 0),
pop AS (SELECT * FROM iso WHERE i_base > 0 AND newcust = 0 AND ord IN (SELECT DISTINCT ord FROM iso ORDER BY ord DESC LIMIT 12)),
val0 AS (SELECT fs_id, count(DISTINCT ord) AS months, sum(due_units)::BIGINT AS due_units, sum(due_cents)::BIGINT AS due_cents, sum(i_units)::BIGINT AS i_units, sum(i_value)::BIGINT AS i_value, sum(i_base)::BIGINT AS i_base, sum(i_square) AS i_square, sum(b_095_100 + b_100_105)::BIGINT AS near_base, sum(b_110_120 + b_ge120)::BIGINT AS high_base, coalesce(sum(i_value) FILTER (percent IS NULL), 0)::BIGINT AS unknown_value FROM pop GROUP BY fs_id),
val AS (SELECT * FROM val0 WHERE due_units::DOUBLE / months >= 271 OR fs_id IN (SELECT fs_id FROM val0 ORDER BY due_cents DESC, fs_id LIMIT 50))
"""


def _ratios(rows: str) -> str:
    m = "(sum(i_value) / 200.0::DOUBLE / sum(i_base))"
    near, high = ("sum(near_base)", "sum(high_base)") if rows == "val" else ("sum(b_095_100 + b_100_105)", "sum(b_110_120 + b_ge120)")
    return f"round({m}, 6) AS uplift, round(sqrt(greatest(sum(i_square) / sum(i_base) - {m} * {m}, 0)), 6) AS spread, round({near}::DOUBLE / sum(i_base)::DOUBLE, 6) AS near, round({high}::DOUBLE / sum(i_base)::DOUBLE, 6) AS high"


_PATH = f""", pm AS (SELECT ord, sum(i_units)::BIGINT AS ren_units, {_ratios("iso")}, sum(i_value) / 200.0::DOUBLE / sum(i_base) AS own FROM iso WHERE i_base > 0 AND newcust = 0 AND ord IN (SELECT DISTINCT ord FROM iso ORDER BY ord DESC LIMIT 24) GROUP BY ord),
pp AS (SELECT *, CASE WHEN count(own) OVER w >= 6 THEN avg(own) OVER w END AS prior FROM pm WINDOW w AS (ORDER BY ord ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)),
path AS (SELECT ord, ren_units, uplift, spread, near, high, round(prior, 6) AS "before", round(own / prior - 1, 6) AS step, (round(own / prior - 1, 9) >= 0.03)::INT AS above FROM pp)
"""
_POINTS = """, vw AS (SELECT i_value / 200.0::DOUBLE / i_base AS u, i_value AS w FROM val), vc AS (SELECT u, w, row_number() OVER r AS k, sum(w) OVER r::DOUBLE / sum(w) OVER ()::DOUBLE AS s FROM vw WINDOW r AS (ORDER BY u, w ROWS UNBOUNDED PRECEDING)),
vl AS (SELECT *, lag(u) OVER r AS u0, lag(s) OVER r AS s0 FROM vc WINDOW r AS (ORDER BY k)), """ + "pts AS (SELECT " + ", ".join(f"round(min_by(coalesce(u0 + (u - u0) * ({q}::DOUBLE - s0) / (s - s0), u), k) FILTER (s >= {q}::DOUBLE), 6) AS p{n}" for q, n in ((0.1, 10), (0.25, 25), (0.5, 50), (0.75, 75), (0.9, 90))) + " FROM vl)"
#: Closed months with final marks (mh) and all that falls due ahead (mf), with the history's rates by combination (mr).
_MARK = "CASE WHEN dormant = 1 AND softcancel = 1 THEN 'dormant+softcancel' WHEN dormant = 1 THEN 'dormant' WHEN softcancel = 1 THEN 'softcancel' ELSE 'neutral' END"
_AHEAD = f""", mh AS (SELECT *, ord % 12 AS m, {_MARK} AS mark FROM fin WHERE ts = 0 AND due_units > 0 AND ord < 24009 AND ord IN (SELECT DISTINCT ord FROM fin WHERE ts = 0 AND due_units > 0 AND ord < 24009 ORDER BY ord DESC LIMIT 12)),
me AS (SELECT (ord + 12)::INT AS ord, round(sum(due_units * rate), 6) AS units FROM fin JOIN (SELECT region, product, sum(ren_units)::DOUBLE / sum(due_units)::DOUBLE AS rate FROM fin WHERE ord < 24009 AND ts = 0 GROUP BY ALL) USING (region, product) WHERE ord >= 24009 AND term = '1 year' AND due_units > 0 AND ts = 0 GROUP BY region, product, ord),
ma AS (SELECT region, ord, sum(raw_due_units)::BIGINT AS units FROM fin WHERE newcust = 1 AND ord < 24009 GROUP BY ALL), ml AS (SELECT region, sum(units) FILTER (ord BETWEEN 24006 AND 24008)::DOUBLE / sum(units) FILTER (ord BETWEEN 23994 AND 23996)::DOUBLE AS level FROM ma GROUP BY region),
mf AS (SELECT ord, {_MARK} AS mark, dormant, softcancel, due_units::DOUBLE AS units, due_cents, 1 AS extract FROM fin WHERE ts = 0 AND due_units > 0 AND ord >= 24009 UNION ALL SELECT ord, 'neutral', 0, 0, units, 0, 0 FROM me WHERE units > 0
  UNION ALL SELECT (ord + 12)::INT, 'neutral', 0, 0, round(units * coalesce(level, 1), 6)::DOUBLE, 0, 0 FROM ma JOIN ml USING (region) WHERE ord >= 23997 AND units * coalesce(level, 1) > 0),
mr AS (SELECT mark, sum(due_units) AS due_units, sum(ren_units)::DOUBLE / sum(due_units)::DOUBLE AS ru, sum(ren_value)::DOUBLE / 200 / sum(due_cents)::DOUBLE AS rv FROM mh GROUP BY mark)
"""
_EFFECT = """, mn AS (SELECT ord, ord % 12 AS m, sum(due_cents)::BIGINT AS due_cents, sum(units * coalesce(ru, nu)) / sum(units) AS tu, sum(units * coalesce(rv, nv)) / sum(units) AS tv FROM mf LEFT JOIN mr USING (mark) CROSS JOIN (SELECT max(ru) AS nu, max(rv) AS nv FROM mr WHERE mark = 'neutral') GROUP BY ord),
mx AS (SELECT m, sum(mh.due_units * ru) / sum(mh.due_units)::DOUBLE AS fu, sum(mh.due_units * rv) / sum(mh.due_units)::DOUBLE AS fv FROM mh JOIN mr USING (mark) GROUP BY m),
meff AS (SELECT ord, (ord // 12)::INT AS year, due_cents, round(tu, 6) AS today_units, round(coalesce(fu, tu), 6) AS final_units, round(tv, 6) AS today_value, round(coalesce(fv, tv), 6) AS final_value, round(due_cents * (coalesce(fv, tv) - tv), 4) AS effect_cents FROM mn LEFT JOIN mx USING (m))
"""
_SHARE = lambda c, n, units="units": f"round(coalesce(sum({units}) FILTER ({c}), 0)::DOUBLE / sum({units})::DOUBLE, 6) AS {n}"
_FLAGS = ("dormant", "softcancel")
_REPORTED = {
    "revaluation_funnel": _ISOLATED + ", wi AS (SELECT * FROM iso WHERE ord IN (SELECT DISTINCT ord FROM iso ORDER BY ord DESC LIMIT 12)) SELECT 'renewers' AS population, count(*) AS rows, sum(ren_value)::BIGINT AS ren_value FROM wi UNION ALL SELECT 'isolated', count(*), sum(i_value)::BIGINT FROM wi WHERE i_base > 0 UNION ALL SELECT 'not_acquired', count(*), sum(i_value)::BIGINT FROM pop",
    "revaluation_top_series": _ISOLATED + f"SELECT fs_id, months, round(due_units::DOUBLE / months, 6) AS units_a_month, due_cents, round(i_units::DOUBLE / due_units::DOUBLE, 6) AS rate, {_ratios('val')} FROM val GROUP BY fs_id, months, due_units, due_cents, i_units ORDER BY due_cents DESC, fs_id LIMIT 15",
    "revaluation_histogram": _ISOLATED + ", ed(a, b) AS (VALUES " + ", ".join(f"({a}, {b})" for a, b in zip(_UPLIFT_EDGES, (*_UPLIFT_EDGES[1:], 10 ** 6))) + "), st AS (SELECT 'all' AS among, * FROM val UNION ALL SELECT 'unknown', * FROM val WHERE unknown_value::DOUBLE / i_value > 0.5), hg AS (SELECT g.among, a AS from_thousandths, count(fs_id) AS series, coalesce(sum(i_value), 0)::BIGINT AS ren_value FROM (SELECT DISTINCT among FROM st) g CROSS JOIN ed LEFT JOIN st ON st.among = g.among AND i_value * 5 >= i_base * a AND i_value * 5 < i_base * b GROUP BY ALL) SELECT among, from_thousandths, series, round(series::DOUBLE / sum(series) OVER (PARTITION BY among)::DOUBLE, 6) AS series_share, ren_value, round(ren_value::DOUBLE / sum(ren_value) OVER (PARTITION BY among)::DOUBLE, 6) AS value_share FROM hg",
    "revaluation_summary": _ISOLATED + _POINTS + f", sg AS (SELECT {_ratios('pop')} FROM pop), sh AS (SELECT count(*) AS series, round(sum(i_value) / 200.0::DOUBLE / sum(i_base), 6) AS series_uplift, " + ", ".join(_SHARE(c, n, "i_value") for c, n in (("i_value * 5 >= i_base * 1000 AND i_value * 5 < i_base * 1050", "share_100_105"), ("i_value * 5 >= i_base * 950 AND i_value * 5 < i_base * 1050", "share_095_105"), ("i_value * 5 >= i_base * 1100", "share_from_110"))) + ", round(sum(i_value)::DOUBLE / (SELECT sum(i_value) FROM val0)::DOUBLE, 6) AS covered FROM val) SELECT *, CASE WHEN near >= 0.8 THEN 'holds' WHEN high >= 0.25 THEN 'fails' WHEN near IS NOT NULL THEN 'in_part' END AS claim FROM sh CROSS JOIN pts CROSS JOIN sg",
    "revaluation_bands": _ISOLATED + "SELECT *, round(base_cents::DOUBLE / sum(base_cents) OVER ()::DOUBLE, 6) AS share FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS band, coalesce(sum(b_{n}), 0)::BIGINT AS base_cents FROM pop" for n in _RATIO_EDGES) + ")",
    "revaluation_by_discount": _ISOLATED + f"SELECT 'bucket' AS cut, bucket AS value, sum(i_value)::BIGINT AS ren_value, {_ratios('pop')} FROM pop GROUP BY bucket UNION ALL SELECT 'discount', CASE WHEN percent IS NULL THEN 'unknown' ELSE 'known' END, sum(i_value)::BIGINT, {_ratios('pop')} FROM pop GROUP BY percent IS NULL",
    "revaluation_monthly": _ISOLATED + _PATH + "SELECT * FROM path",
    "revaluation_verdict": _ISOLATED + _PATH + ", lp AS (SELECT * FROM (SELECT * FROM path ORDER BY ord DESC LIMIT 12) WHERE above IS NOT NULL), li AS (SELECT above, row_number() OVER (ORDER BY ord) - row_number() OVER (PARTITION BY above ORDER BY ord) AS isle FROM lp), lr AS (SELECT above, count(*) AS n FROM li GROUP BY above, isle), lv AS (SELECT coalesce(sum(n), 0)::BIGINT AS months, coalesce(sum(n) FILTER (above = 1), 0)::BIGINT AS months_above, coalesce(max(n) FILTER (above = 1), 0)::BIGINT AS longest_run FROM lr) SELECT *, CASE WHEN longest_run >= 3 THEN 'increase' WHEN months_above > 0 THEN 'scattered' WHEN months > 0 THEN 'none' END AS verdict FROM lv",
    "mark_costs": _AHEAD + "SELECT mark, round(due_units::DOUBLE / sum(due_units) OVER ()::DOUBLE, 6) AS share_units, round(ru, 6) AS rate_units, round(rv, 6) AS rate_value FROM mr",
    "mark_shares_ahead": _AHEAD + ", fs AS (SELECT m, " + ", ".join([_SHARE(f"{c} = 1", f"final_{c}", "due_units") for c in _FLAGS] + [_SHARE("mark = 'neutral'", "final_neutral", "due_units")]) + " FROM mh GROUP BY m) SELECT n.*, " + ", ".join(f"final_{c}" for c in (*_FLAGS, "neutral")) + " FROM (SELECT ord, (ord - 24008)::INT AS h, sum(due_cents)::BIGINT AS due_cents, " + ", ".join([_SHARE("extract = 1", "extract_share")] + [_SHARE(f"{c} = 1", f"today_{c}") for c in _FLAGS] + [_SHARE("mark = 'neutral'", "today_neutral")]) + " FROM mf GROUP BY ord) n LEFT JOIN fs ON fs.m = n.ord % 12",
    "mark_mix_effect": _AHEAD + _EFFECT + "SELECT * FROM meff",
    "mark_effect_by_year": _AHEAD + _EFFECT + "SELECT year, sum(due_cents)::BIGINT AS due_cents, round(sum(effect_cents), 3) AS effect_cents, round(round(sum(effect_cents), 3) / nullif(sum(due_cents), 0)::DOUBLE, 6) AS share FROM meff GROUP BY year",
}
SQL = {k: _BASE + v for k, v in {
    "calendar_by_month": "SELECT ord, role, count(*) AS rows, sum(due_units)::BIGINT AS due_units, sum(due_cents)::BIGINT AS due_cents, sum(ren_units)::BIGINT AS ren_units, sum(ren_value)::BIGINT AS ren_value, sum(raw_due_units)::BIGINT AS raw_due_units, sum(raw_ren_units)::BIGINT AS raw_ren_units, sum(ren_units)::DOUBLE / nullif(sum(due_units), 0)::DOUBLE AS rate FROM fin GROUP BY ord, role",
    "months_per_role": "SELECT fs_id, count(DISTINCT ord) FILTER (role = 'entrenamiento') AS entrenamiento, count(DISTINCT ord) FILTER (role = 'examen') AS examen, count(DISTINCT ord) FILTER (role = 'proyeccion') AS proyeccion FROM fin GROUP BY fs_id",
    "value_checks": "SELECT count(*) AS rows, count(DISTINCT ord) AS months, sum((raw_due_units < 0)::INT)::BIGINT AS negative_due, sum((raw_ren_units > raw_due_units)::INT)::BIGINT AS renewed_over_due, sum((percent IS NULL)::INT)::BIGINT AS unknown_discount, sum((raw_due_units = 0 AND raw_due_cents > 0)::INT)::BIGINT AS money_without_units, coalesce(sum((percent < 0 OR percent > 100)::INT), 0)::BIGINT AS discount_out_of_range, sum((dormant + softcancel > 0 AND autorenew = 1)::INT)::BIGINT AS mixed_sign FROM ext",
    "grain_duplicates": "SELECT count(*) AS keys, sum(n)::BIGINT AS rows, sum((a > 1)::INT)::BIGINT AS split_by_newcust, sum((b > 1)::INT)::BIGINT AS split_by_percent, sum((c > 1)::INT)::BIGINT AS split_by_ts, sum((d > 1)::INT)::BIGINT AS split_by_term FROM (SELECT count(*) AS n, count(DISTINCT newcust) AS a, count(DISTINCT coalesce(percent::VARCHAR, 'null')) AS b, count(DISTINCT ts) AS c, count(DISTINCT term) AS d FROM fin GROUP BY fs_id, ord HAVING count(*) > 1)",
    "id_hash_keys": "SELECT kind, id, ('0x' || substr(md5(id), 1, 12))::BIGINT AS key FROM (SELECT DISTINCT 'fs' AS kind, fs_id AS id FROM fin UNION ALL SELECT DISTINCT 'fu', fs_id || '|' || ord FROM fin UNION ALL SELECT DISTINCT 'cell', cell_id FROM fin)",
    "series_routes": "SELECT fs_id, t AS training, e AS exam, p AS projection, money AS to_predict_cents, concat_ws('+', CASE WHEN t > 0 THEN 'entrenamiento' END, CASE WHEN e > 0 THEN 'examen' END, CASE WHEN p > 0 THEN 'proyeccion' END) AS coverage, CASE WHEN t + e > 0 AND p > 0 THEN 'predecible' WHEN t + e > 0 THEN 'solo_historia' ELSE 'solo_futuro' END AS route, CASE WHEN share = 1 THEN 'serie_temporal' WHEN share = 0 THEN 'normal' ELSE 'mixto' END AS universe FROM (SELECT fs_id, count(DISTINCT ord) FILTER (role = 'entrenamiento') AS t, count(DISTINCT ord) FILTER (role = 'examen') AS e, count(DISTINCT ord) FILTER (role = 'proyeccion') AS p, avg(ts) AS share, coalesce(sum(due_cents) FILTER (role = 'proyeccion'), 0)::BIGINT AS money FROM fin GROUP BY fs_id)",
    "unit_aggregate": "SELECT fs_id, ord, role, sign, due_units, due_cents, ren_units, ren_value, rows FROM units",
    "gap_role_asof": "SELECT g.fs_id, g.ord::INT AS ord, u.role AS as_of_role FROM (SELECT s.fs_id, s.ord FROM (SELECT fs_id, unnest(generate_series(min(ord), max(ord))) AS ord FROM past GROUP BY fs_id) s ANTI JOIN past p ON s.fs_id = p.fs_id AND s.ord = p.ord) g ASOF JOIN past u ON g.fs_id = u.fs_id AND g.ord >= u.ord",
    "series_rate_summary": "SELECT fs_id, sign, support, months, due_units, ren_units, p AS rate, round(CASE WHEN due_units <= 0 OR p IS NULL THEN 50.0 ELSE 100 * (1.645::DOUBLE * sqrt(p * (1 - p) / due_units + 2.706025::DOUBLE / (4 * due_units::DOUBLE * due_units)) / (1 + 2.706025::DOUBLE / due_units)) END, 6)::DOUBLE AS half_width, coalesce(support, 0) < 30 AS below_floor FROM (SELECT *, ren_units::DOUBLE / nullif(due_units, 0) AS p FROM summary)",
    "support_bound": "SELECT fs_id, ord, due_units, due_cents, round(100 * sqrt(0.25::DOUBLE / greatest(due_units, 1)), 6) AS bound, round(100 * sqrt(0.25::DOUBLE / greatest(due_units, 1)) * 1.645::DOUBLE * due_cents / 10000, 2) AS bound_usd FROM units WHERE ord >= 24009 AND due_units > 0",
    "two_stage_support": "SELECT region, product, median(CASE WHEN due > 0 THEN due::DOUBLE END) AS support, (SELECT count(DISTINCT fs_id) FROM past q WHERE q.region = m.region AND q.product = m.product) AS series, sum(due)::BIGINT AS due_units, sum(ren)::BIGINT AS ren_units, sum(ren)::DOUBLE / sum(due)::DOUBLE AS rate, round(100 * sqrt((sum(ren)::DOUBLE / sum(due)::DOUBLE) * (1 - sum(ren)::DOUBLE / sum(due)::DOUBLE) / sum(due)::DOUBLE), 6) AS error FROM (SELECT region, product, ord, sum(due_units)::BIGINT AS due, sum(ren_units)::BIGINT AS ren FROM past GROUP BY ALL) m GROUP BY region, product",
    "eta2_by_dimension": ", r AS (SELECT s.*, n.region, n.product, n.dormant, n.softcancel, n.autorenew, n.channel, s.ren_units::DOUBLE / s.due_units AS p FROM summary s JOIN names n ON s.fs_id = n.fs_id WHERE s.due_units > 0 AND support > 0), d AS (" + " UNION ALL ".join(f"SELECT '{c}' AS dimension, {c}::VARCHAR AS v, support AS w, p FROM r" for c in ("region", "product", "dormant", "softcancel", "autorenew", "channel")) + "), g AS (SELECT dimension, v, sum(w) AS w, sum(w * p) AS wx, sum(w * p * p) AS wxx FROM d GROUP BY ALL) SELECT dimension, count(*) AS levels, round(CASE WHEN sum(wxx) - sum(wx) ^ 2 / sum(w) > 0 THEN (sum(wx * wx / w) - sum(wx) ^ 2 / sum(w)) / (sum(wxx) - sum(wx) ^ 2 / sum(w)) ELSE 0 END, 6)::DOUBLE AS eta2 FROM g GROUP BY dimension",
    "ratio_bands": "SELECT product, CASE WHEN r < 0.95 THEN 'lt095' WHEN r < 1 THEN '095_100' WHEN r < 1.05 THEN '100_105' WHEN r < 1.1 THEN '105_110' WHEN r < 1.2 THEN '110_120' ELSE 'ge120' END AS band, sum(base_cents)::BIGINT AS base_cents, count(*) AS licences FROM (SELECT *, ren_value / 200.0::DOUBLE / base_cents AS r FROM lic WHERE softcancel = 0 AND ren_units > 0) GROUP BY 1, 2",
    "ladder_pattern_support": "SELECT pass, pattern, support, due_units, ren_units, series FROM pstat",
    "ladder_chosen_pass": "SELECT * FROM chosen",
    "credibility_reference": "SELECT fs_id, composition, reference, r_pass, r_support FROM refs",
    "credibility_k": "SELECT * FROM kk",
    "blended_rate": "SELECT fs_id, composition, reference, z, round(z * p + (1 - z) * coalesce(r, p), 6) AS rate FROM (SELECT c.fs_id, c.composition, f.reference, CASE WHEN f.reference IS NULL THEN 1.0::DOUBLE ELSE round(c.support / (c.support + coalesce(kk.k, 60)), 3) END AS z, c.ren_units::DOUBLE / nullif(c.due_units, 0) AS p, f.r_ren::DOUBLE / nullif(f.r_due, 0) AS r FROM chosen c LEFT JOIN refs f ON c.fs_id = f.fs_id LEFT JOIN kk ON f.reference = kk.reference)",
    "composition_members": "SELECT * FROM bridge",
    "composition_monthly": "SELECT * FROM pool",
    "technique_backtest": _BACKTEST + "SELECT composition, ord, purpose, h, technique, round(predicted, 6) AS predicted, round(real, 6) AS real, due_units, round(100 * (predicted - real), 6) AS error, round(100 * (predicted - real) / (100 * sqrt(p * (1 - p) / due_units)), 6) AS error_norm FROM bt",
    "uplift_hierarchy": _UPLIFT.format(before=24009) + "SELECT * FROM up",
    "contract_rule_check": "SELECT bucket, sum(ren_units)::BIGINT AS renewers, round(sum(ren_value)::DOUBLE / 200 / sum(base_cents)::DOUBLE, 6) AS paid, round(sum(rule * base_cents) / sum(base_cents)::DOUBLE, 6) AS rule, round(coalesce(sum(base_cents) FILTER (abs(ren_value / 200.0::DOUBLE / base_cents / rule - 1) <= 0.02::DOUBLE), 0)::DOUBLE / sum(base_cents)::DOUBLE, 6) AS share_near FROM (SELECT *, 1 / (1 - least(percent / 100.0::DOUBLE, 0.99::DOUBLE)) AS rule FROM renew WHERE percent IS NOT NULL) GROUP BY bucket",
    "uplift_backtest": _UPLIFT.format(before=24006) + "SELECT *, CASE WHEN wape_contract < wape_statistical THEN 'contrato' ELSE 'estadistico' END AS method FROM (SELECT bucket, count(*) AS n, round(sum(abs(base_cents / 100.0::DOUBLE * uplift - ren_value / 20000.0::DOUBLE)) / sum(ren_value / 20000.0::DOUBLE), 6) AS wape_statistical, round(sum(abs(base_cents / 100.0::DOUBLE / (1 - least(coalesce(percent, 0) / 100.0::DOUBLE, 0.99::DOUBLE)) - ren_value / 20000.0::DOUBLE)) / sum(ren_value / 20000.0::DOUBLE), 6) AS wape_contract FROM renew JOIN up ON cell_id = cell WHERE ord >= 24006 GROUP BY bucket)",
    "weighted_percentiles": ", wp AS (SELECT region, ren_value / 200.0::DOUBLE / base_cents AS u, base_cents AS w FROM renew), wl AS (SELECT region, u, w, sum(w) OVER r::DOUBLE / sum(w) OVER (PARTITION BY region)::DOUBLE AS share FROM wp WINDOW r AS (PARTITION BY region ORDER BY u, w ROWS UNBOUNDED PRECEDING)), wm AS (SELECT *, lag(u) OVER r AS u0, lag(share) OVER r AS s0 FROM wl WINDOW r AS (PARTITION BY region ORDER BY u, w, share)) SELECT region, " + ", ".join(f"round(min_by(coalesce(u0 + (u - u0) * ({q}::DOUBLE - s0) / (share - s0), u), share) FILTER (share >= {q}::DOUBLE), 6) AS {n}" for q, n in ((0.1, "p10"), (0.5, "p50"), (0.9, "p90"))) + " FROM wm GROUP BY region",
    "price_monitor_rolling12": _MONITOR.format(step="0.03") + "SELECT * FROM mon",
    "price_increase_calendar": _MONITOR.format(step="0.002") + "SELECT s.product, s.ord AS start, s.step, count(m.uplift) AS months_seen, sum(m.ren_value)::BIGINT AS ren_value FROM mon s JOIN mon m ON s.product = m.product AND m.ord >= s.ord AND m.ord < s.ord + 12 WHERE s.starts = 1 GROUP BY ALL",
    "marks_by_month": "SELECT ord, CASE WHEN dormant = 1 AND softcancel = 1 THEN 'dormant+softcancel' WHEN dormant = 1 THEN 'dormant' WHEN softcancel = 1 THEN 'softcancel' ELSE 'neutral' END AS marks, sum(due_units)::BIGINT AS due_units, sum(ren_units)::BIGINT AS ren_units FROM fin GROUP BY 1, 2",
    "same_month_last_year": ", mo AS (SELECT region, ord, sum(due_units)::BIGINT AS due_units, sum(ren_units)::BIGINT AS ren_units FROM fin GROUP BY ALL) SELECT a.region, a.ord, a.due_units, a.ren_units, b.due_units AS due_before, b.ren_units AS ren_before, a.due_units - b.due_units AS change FROM mo a JOIN mo b ON a.region = b.region AND a.ord = b.ord + 12",
    "acquisition_lag12": ", mo AS (SELECT region, ord, sum(raw_due_units)::BIGINT AS units FROM fin WHERE newcust = 1 AND ord < 24009 GROUP BY ALL), lv AS (SELECT region, sum(units) FILTER (ord BETWEEN 24006 AND 24008)::DOUBLE / sum(units) FILTER (ord BETWEEN 23994 AND 23996)::DOUBLE AS level FROM mo GROUP BY region) SELECT region, (ord + 12)::INT AS ord, round(units * coalesce(level, 1), 6)::DOUBLE AS units FROM mo JOIN lv USING (region) WHERE ord >= 23997",
    "region_rate_cascade": ", t AS (SELECT * FROM fin WHERE ts = 1 AND ord < 24009), a AS (SELECT region, product, sum(due_units) AS d, sum(ren_units) AS r FROM t GROUP BY ALL), b AS (SELECT region, sum(due_units) AS d, sum(ren_units) AS r FROM t GROUP BY ALL), c AS (SELECT sum(due_units) AS d, sum(ren_units) AS r FROM t) SELECT w.region, w.product, CASE WHEN a.d >= 30 THEN a.r::DOUBLE / a.d::DOUBLE WHEN b.d >= 30 THEN b.r::DOUBLE / b.d::DOUBLE ELSE c.r::DOUBLE / c.d::DOUBLE END AS rate, CASE WHEN a.d >= 30 THEN 'product' WHEN b.d >= 30 THEN 'region' ELSE 'global' END AS level FROM (SELECT DISTINCT region, product FROM fin) w LEFT JOIN a ON w.region = a.region AND w.product = a.product LEFT JOIN b ON w.region = b.region CROSS JOIN c",
    "totals_by_prefix": "SELECT region, product, grouping_id(region, product)::INT AS level, sum(due_units)::BIGINT AS due_units, sum(ren_units)::BIGINT AS ren_units, sum(ren_units)::DOUBLE / sum(due_units)::DOUBLE AS rate FROM fin WHERE ord < 24009 GROUP BY ROLLUP (region, product)",
    "horizon_extension": "SELECT region, product, (ord + 12)::INT AS ord, sum(due_units)::BIGINT AS due_units, round(sum(due_units * rate), 6) AS expected_units FROM fin JOIN (SELECT region, product, sum(ren_units)::DOUBLE / sum(due_units)::DOUBLE AS rate FROM fin WHERE ord < 24009 AND ts = 0 GROUP BY ALL) USING (region, product) WHERE ord >= 24009 AND term = '1 year' AND due_units > 0 AND ts = 0 GROUP BY region, product, ord",
    "omega2_by_dimension": _RATES + _SINGLE + " SELECT d AS dimension, levels, series, round(CASE WHEN sst > 0 AND series > levels THEN greatest(0, (ssb - (levels - 1) * (sst - ssb) / (series - levels)) / (sst + (sst - ssb) / (series - levels))) ELSE 0 END, 6)::DOUBLE AS omega2 FROM sg",
    "dimension_pairs": _RATES + _SINGLE + _spread("pr", [f"'{a}×{b}' AS d, {a} || '|' || {b} AS v" for a, b in _PAIRS]) + ", names2(d, a, b) AS (VALUES " + ", ".join(f"('{a}×{b}', '{a}', '{b}')" for a, b in _PAIRS) + "), eta AS (SELECT d, round(CASE WHEN sst > 0 THEN ssb / sst ELSE 0 END, 4)::DOUBLE AS e FROM sg) SELECT p.d AS pair, round(CASE WHEN sst > 0 THEN ssb / sst ELSE 0 END, 4)::DOUBLE AS eta2, round(round(CASE WHEN sst > 0 THEN ssb / sst ELSE 0 END, 4)::DOUBLE - greatest(x.e, y.e), 4)::DOUBLE AS interaction FROM pr p JOIN names2 k ON p.d = k.d JOIN eta x ON x.d = k.a JOIN eta y ON y.d = k.b ORDER BY interaction DESC, pair LIMIT 20",
    "level_values": ", tr AS (SELECT * FROM fin WHERE role = 'entrenamiento' AND due_units > 0), cr AS (SELECT region, sum(ren_units)::DOUBLE / sum(due_units)::DOUBLE AS rate FROM tr GROUP BY region), mo AS (SELECT product AS value, ord, sum(due_units)::BIGINT AS due_units, sum(ren_units)::BIGINT AS ren_units, sum(due_units * rate) AS expected FROM tr JOIN cr USING (region) GROUP BY ALL) SELECT value, sum(due_units)::BIGINT AS due_units, sum(ren_units)::BIGINT AS ren_units, round(sum(expected), 6) AS expected, median(due_units::DOUBLE) AS support FROM mo GROUP BY value",
    "dynamics_statistics": _DYNAMICS + _STATISTICS,
    "month_profile": _DYNAMICS + "SELECT composition, month, round(100 * effect, 6) AS effect_pp, round(100 * error, 6) AS error_pp, seen FROM m4",
    "mark_redistribution": _moves(),
    "merge_evidence": _CLIMBED + ", lagged AS (SELECT *, lag(series) OVER w AS before, lag(support) OVER w AS support_before FROM climbed WINDOW w AS (PARTITION BY fs_id ORDER BY pass)), ev AS (SELECT l.*, l.ren_units::DOUBLE / nullif(l.due_units, 0) AS q, s.ren_units::DOUBLE / nullif(s.due_units, 0) AS p, greatest(coalesce(s.support, 0), 1) AS n FROM lagged l JOIN summary s ON l.fs_id = s.fs_id WHERE before IS NOT NULL AND series > before), er AS (SELECT *, 100 * sqrt(p * (1 - p) / n) AS alone, 100 * sqrt((q - p) * (q - p) + q * (1 - q) / greatest(support, 1)) AS merged FROM ev) SELECT fs_id, pass, pattern, support_before, support, series, round(100 * (q - p), 6) AS bias_pp, round(alone, 6) AS error_alone_pp, round(merged, 6) AS error_merged_pp, (round(merged, 9) < round(alone, 9))::INT AS improves FROM er",
    "ladder_stages": _CLIMBED + " SELECT * FROM stages",
    "stage_summary": _CLIMBED + _STAGE,
    "series_estimate": _ESTIMATE + "SELECT * FROM est",
    "risk_levels": _ESTIMATE + "SELECT risk, count(*) AS series, sum(to_predict_cents)::BIGINT AS to_predict_cents, round(coalesce(sum(to_predict_cents)::DOUBLE / nullif(sum(sum(to_predict_cents)) OVER (), 0)::DOUBLE, 0), 6) AS share, round(sum(error_prediction_pp * to_predict_cents) FILTER (to_predict_cents > 0 AND error_prediction_pp IS NOT NULL) / sum(to_predict_cents) FILTER (to_predict_cents > 0 AND error_prediction_pp IS NOT NULL)::DOUBLE, 4) AS error_pp FROM est GROUP BY risk",
    "second_universe": _SECOND,
    "spreadsheet_exam": _SHEETS,
    "technique_backtest_recursive": _TRIED + "SELECT composition, ord, purpose, h, technique, round(predicted, 6) AS predicted, round(real, 6) AS real, due_units, round(error, 6) AS error, round(error_norm, 6) AS error_norm FROM tr",
    "champion_choice": _TRIED + "SELECT * FROM dec",
    "error_band_quantiles": _TRIED + "SELECT * FROM bnd",
    "exam_precision": _TRIED + "SELECT h, count(*) AS n, round(sum(predicted * due_units), 4) AS predicted_units, round(sum(real * due_units), 4) AS real_units, round(sum(abs(predicted * due_units - real * due_units)) / sum(real * due_units), 6) AS wape, round(avg(error), 6) AS bias FROM tr JOIN dec USING (composition, h, technique) WHERE purpose = 'examen' GROUP BY h",
    "forecast_rows": _FORECAST + "SELECT fs_id, ord, h, composition, origin, technique, due_units, round(rate, 9) AS rate, round(rate_low, 9) AS rate_low, round(rate_high, 9) AS rate_high, round(expected_units, 9) AS expected_units FROM forecast",
    "forecast_yearly_totals": _FORECAST + "SELECT (ord // 12)::INT AS year, round(sum(expected_units), 4) AS expected, round(sum(rate_low * due_units), 4) AS low, round(sum(rate_high * due_units), 4) AS high, round(sqrt(sum(((rate_high - rate_low) / 2 * due_units) ^ 2)), 4) AS quadrature FROM forecast GROUP BY 1",
}.items()}
SQL |= {k: _BASE + v for k, v in (_LATE | _REPORTED | _DEEP).items()}
#: What the covers read, by the names that it has here.
_COVERED = _CORE + _SECOND_CTE + ", predictions AS (SELECT * FROM tr), decision AS (SELECT * FROM dec) "


def cover_sql(name: str, **years: int) -> str:
    return _BASE + _COVERED + "SELECT * FROM (" + bound(COVERS[name], years or {"current_year": 2000, "next_year": 2001}) + ")"


SQL |= {k: cover_sql(k) for k in COVERS}
SQL["source_structure"] = structure.in_sql()
SQL |= {k: ladder_sql(v) for k, v in _LADDER.items()}


def report_sql(name: str, now: int = 24009) -> str:
    text = bound(REPORTS[name].replace("FROM fine", "FROM fin"), {"now": now, "january": now // 12 * 12}).strip()
    # A report's own CTEs go behind the base's.
    return _BASE + ("," + text.removeprefix("WITH") if text.startswith("WITH") else text)


SQL |= {k: report_sql(k) for k in REPORTS}
