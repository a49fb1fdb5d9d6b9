"""Named queries over the test tables: each applies operators to a scale factor's whole tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewcast.config import Config
from renewcast.functions import columns as X
from renewcast.operators import backtest as B
from renewcast.operators import audit, bootstrap, checks, core, levels
from renewcast.operators import dynamics as D
from renewcast.operators import evidence as E
from renewcast.operators import exam as EX
from renewcast.operators import ladder as L
from renewcast.operators import mark_diagnosis as MD
from renewcast.operators import maturation as M
from renewcast.operators import price as P
from renewcast.operators import relevance as V
from renewcast.operators import revaluation as R
from renewcast.operators import passes, risk, segments, series_backtest, structure, universe
from renewcast.operators import series as S
from renewcast.plans.covers import COVERS, READS, cover
from renewcast.plans.pipeline import SOURCES, steps
from renewcast.plans.projections import with_dims
from renewcast.plans.reports import REPORTS
from renewcast.sources.extract import extract, licences, table

CFG = Config()


def _of(*names: str):
    """A query over written steps."""
    def wrap(f=lambda t: t):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            tables = steps(spark, sf, CFG)
            return f(*(tables[n] for n in names))

        return run

    return wrap


_fine, _units, _pooled = _of("fine"), _of("units"), _of("pooled")


def _rounded(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({c: F.round(c, 6) for c in names})


def _six(rows: DataFrame) -> DataFrame:
    """All fractions to six places."""
    return _rounded(rows, *(c for c, t in rows.dtypes if t == "double"))


def months_per_role(fine: DataFrame) -> DataFrame:
    return fine.groupBy("fs_id").pivot("role", ["entrenamiento", "examen", "proyeccion"]).agg(F.count_distinct("ord")).na.fill(0)


def grain_duplicates(rows: DataFrame) -> DataFrame:
    """Which columns split the grain of series and months: rows that share it, and their distinct values."""
    keys = rows.groupBy("fs_id", "ord").agg(F.count(F.lit(1)).alias("n"), *(F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("null"))).alias(c) for c in ("newcust", "percent", "ts", "term"))).where("n > 1")
    return keys.agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows"), *(F.sum((F.col(c) > 1).cast("int")).alias(f"split_by_{c}") for c in ("newcust", "percent", "ts", "term")))


def lookups(rows: DataFrame) -> DataFrame:
    """Ids and their keys, of all three kinds."""
    kinds = {"fs": F.col("fs_id"), "fu": F.concat_ws("|", "fs_id", F.col("ord").cast("string")), "cell": F.col("cell_id")}
    out = None
    for kind, c in kinds.items():
        part = rows.select(F.lit(kind).alias("kind"), c.alias("id")).distinct().withColumn("key", X.hash_key(F.col("id")))
        out = part if out is None else out.unionByName(part)
    return out


def value_checks(spark: SparkSession, sf: str) -> DataFrame:
    """The extract's predicates, in one pass."""
    rows = extract(spark, sf)
    bad = lambda c: F.coalesce(F.sum(c.cast("int")), F.lit(0)).alias
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("ord").alias("months"), bad(F.col("due_units") < 0)("negative_due"), bad(F.col("ren_units") > F.col("due_units"))("renewed_over_due"), bad(F.col("percent").isNull())("unknown_discount"),
                    bad((F.col("due_units") == 0) & (F.col("due_cents") > 0))("money_without_units"), bad((F.col("percent") < 0) | (F.col("percent") > 100))("discount_out_of_range"), bad((F.col("dormant") + F.col("softcancel") > 0) & (F.col("autorenew") == 1))("mixed_sign"))


def eta2_by_dimension(summary: DataFrame, units: DataFrame) -> DataFrame:
    summary = with_dims(summary, units, CFG)
    out = None
    for d in CFG.series:
        part = S.eta_squared(summary, d)
        out = part if out is None else out.unionByName(part)
    return out


def ratio_bands(spark: SparkSession, sf: str) -> DataFrame:
    """What renewed without soft cancels, by the ratio of price paid to price due."""
    rows = licences(spark, sf).where((F.col("softcancel") == 0) & (F.col("ren_units") > 0))
    r = F.col("ren_value") / 200.0 / F.col("base_cents")
    band = F.when(r < 0.95, "lt095").when(r < 1, "095_100").when(r < 1.05, "100_105").when(r < 1.1, "105_110").when(r < 1.2, "110_120").otherwise("ge120")
    return rows.groupBy("product", band.alias("band")).agg(F.sum("base_cents").alias("base_cents"), F.count(F.lit(1)).alias("licences"))


def marks_by_month(fine: DataFrame) -> DataFrame:
    return fine.groupBy("ord", X.marks(CFG).alias("marks")).agg(F.sum("due_units").alias("due_units"), F.sum("ren_units").alias("ren_units"))


def same_month_last_year(fine: DataFrame) -> DataFrame:
    month = fine.groupBy("region", "ord").agg(F.sum("due_units").alias("due_units"), F.sum("ren_units").alias("ren_units"))
    old = month.select("region", (F.col("ord") + 12).alias("ord"), F.col("due_units").alias("due_before"), F.col("ren_units").alias("ren_before"))
    return month.join(old, ["region", "ord"]).withColumn("change", F.col("due_units") - F.col("due_before"))


def region_rate_cascade(fine: DataFrame) -> DataFrame:
    """Rates of the second universe climbing from region and product to region to all, by first level with units."""
    rows = fine.where((F.col("ts") == 1) & (F.col("ord") < CFG.current))
    sums = lambda *k: rows.groupBy(*k).agg(F.sum("due_units").alias("d"), F.sum("ren_units").alias("r"))
    fine2, region, everything = sums("region", "product"), sums("region"), sums()
    wanted = fine.select("region", "product").distinct()
    out = wanted.join(fine2.withColumnsRenamed({"d": "d1", "r": "r1"}), ["region", "product"], "left").join(region.withColumnsRenamed({"d": "d2", "r": "r2"}), "region", "left").crossJoin(F.broadcast(everything.withColumnsRenamed({"d": "d3", "r": "r3"})))
    ok = lambda i: F.coalesce(F.col(f"d{i}"), F.lit(0)) >= 30
    return out.select("region", "product", F.when(ok(1), X.ratio(F.col("r1"), F.col("d1"))).when(ok(2), X.ratio(F.col("r2"), F.col("d2"))).otherwise(X.ratio(F.col("r3"), F.col("d3"))).alias("rate"), F.when(ok(1), "product").when(ok(2), "region").otherwise("global").alias("level"))


def totals_by_prefix(fine: DataFrame) -> DataFrame:
    rows = fine.where(F.col("ord") < CFG.current).rollup("region", "product").agg(F.grouping_id().cast("int").alias("level"), F.sum("due_units").alias("due_units"), F.sum("ren_units").alias("ren_units"))
    return rows.withColumn("rate", X.ratio(F.col("ren_units"), F.col("due_units")))


def _rates(f):
    """Queries of the series' rates with their dimensions."""
    return _of("rates")(lambda rates: f(rates.sparkSession, rates))


def _marks_ahead(f):
    """Queries of closed months' rows and of all that falls due in open ones."""
    return _of("fine", "extension", "acquisition")(lambda fine, e, a: f(MD.history(fine, CFG), MD.ahead(fine, e, a, CFG)))


def matured_forecast(forecast: DataFrame, units: DataFrame, moves: DataFrame) -> DataFrame:
    """The forecast after the marks still to come."""
    return M.distribute(forecast.join(units.select("fs_id", *CFG.series).distinct(), "fs_id"), moves, CFG)


def spreadsheet_exam(u: DataFrame) -> DataFrame:
    real, closed = EX.exam_rows(u, CFG)
    return _rounded(EX.sheets(real, closed, CFG).select("fs_id", "ord", "h", "due_units", F.col("ren_units").alias("real_units"), "sheet_cell", "sheet_all"), "sheet_cell", "sheet_all")


def report(text: str, fine: DataFrame, now: int) -> DataFrame:
    months = {k: v for k, v in {"now": now, "january": now // 12 * 12}.items() if f":{k}" in text}
    text = text.replace("FROM fine", "FROM {fine}")
    return fine.sparkSession.sql(text, args=months, fine=fine) if months else fine.sparkSession.sql(text, fine=fine)


def _report(text: str):
    return _fine(lambda fine: report(text, fine, CFG.current))


def _cover(name: str):
    return _of(*READS)(lambda *t: cover(name, dict(zip(READS, t)), CFG.current // 12, CFG.current // 12 + 1))


_ESTIMATE = ("fine", "summary", "chosen", "references", "credibility")
NATIVE = ("T2_mean", "T3_ma3", "T3_ma6", "T4_ewma", "T9_ses", "T12_theta", "T14_temporal_cred")
QUERIES = {
    "calendar_by_month": _fine(S.calendar_table),
    "months_per_role": _fine(months_per_role),
    "value_checks": value_checks,
    "source_structure": lambda spark, sf: structure.structure({t: table(spark, sf, t) for t in SOURCES}),
    "grain_duplicates": _fine(grain_duplicates),
    "id_hash_keys": _fine(lookups),
    "series_routes": _of("routes")(),
    "unit_aggregate": _units(lambda u: u.select("fs_id", "ord", "role", "sign", "due_units", "due_cents", "ren_units", "ren_value", "rows")),
    "gap_role_asof": _units(lambda u: S.gaps(u, CFG)),
    "series_rate_summary": _of("summary")(),
    "support_bound": _units(lambda u: S.support_bound(u, CFG)),
    "two_stage_support": _units(lambda u: S.two_stage_support(u, ["region", "product"], CFG)),
    "eta2_by_dimension": _of("summary", "units")(eta2_by_dimension),
    "ratio_bands": ratio_bands,
    "ladder_pattern_support": _of("support")(),
    "ladder_chosen_pass": _of("chosen")(),
    "credibility_reference": _of("references")(lambda r: r.select("fs_id", "composition", "reference", "r_pass", "r_support")),
    "credibility_k": _of("credibility")(),
    "blended_rate": _of("weights")(L.blended),
    "composition_members": _of("members")(),
    "composition_monthly": _pooled(),
    "ladder_run": _of("passes")(),
    "ladder_pass_summary": _of("passes")(lambda p: passes.summary(p, CFG)),
    "ladder_compositions": _of("pass_stats", "passes")(lambda s, p: passes.compositions(s, p, CFG)),
    "technique_backtest": _pooled(lambda p: _rounded(B.backtest(p, CFG, NATIVE).drop("place"), "predicted", "real", "error", "error_norm")),
    "technique_backtest_recursive": _of("predictions")(lambda p: _rounded(p.drop("place"), "predicted", "real", "error", "error_norm")),
    "champion_choice": _of("decision")(),
    "error_band_quantiles": _of("bands")(),
    "exam_precision": _of("predictions", "decision")(B.exam),
    "forecast_rows": _of("forecast")(lambda f: f.withColumns({c: F.round(c, 9) for c in ("rate", "rate_low", "rate_high", "expected_units")})),
    "forecast_yearly_totals": _of("yearly")(),
    "forecast_monthly_totals": _of("forecast")(B.monthly_totals),
    "uplift_hierarchy": _of("uplift")(),
    "contract_rule_check": _fine(lambda f: P.contract_check(f, CFG)),
    "uplift_backtest": _fine(lambda f: P.uplift_backtest(f, CFG)),
    "weighted_percentiles": _fine(lambda f: P.weighted_percentiles(f, CFG)),
    "price_monitor_rolling12": _fine(lambda f: P.monitor(f, CFG)),
    "price_increase_calendar": _fine(lambda f: P.increase_calendar(P.monitor(f, CFG, 0.002))),
    "price_longest_runs": _fine(lambda f: P.longest_runs(P.monitor(f, CFG, 0.002), CFG)),
    "uplift_homogeneity": lambda spark, sf: P.homogeneity(licences(spark, sf), steps(spark, sf, CFG)["fine"], CFG),
    "revaluation_funnel": _of("isolated")(R.funnel),
    "revaluation_top_series": _of("valued")(R.top),
    "revaluation_histogram": _of("valued")(R.histogram),
    "revaluation_summary": _of("isolated", "valued")(R.summary),
    "revaluation_bands": _of("isolated")(R.bands),
    "revaluation_by_discount": _of("isolated")(R.by_discount),
    "revaluation_monthly": _of("isolated")(R.monthly),
    "revaluation_verdict": _of("isolated")(lambda rows: R.verdict(R.monthly(rows))),
    "technique_trials": _of("chosen", "predictions", "decision")(audit.technique_trials),
    "check_registry": _of(*checks.needed())(lambda *t: checks.registry(dict(zip(checks.needed(), t)))),
    "audit_differences": _of(*audit.AUDITED)(lambda *t: audit.differences(dict(zip(audit.AUDITED, t)), CFG)),
    "marks_by_month": _fine(marks_by_month),
    "same_month_last_year": _fine(same_month_last_year),
    "acquisition_lag12": _of("acquisition")(),
    "region_rate_cascade": _fine(region_rate_cascade),
    "totals_by_prefix": _fine(totals_by_prefix),
    "horizon_extension": _of("extension")(),
    "omega2_by_dimension": _rates(lambda spark, r: V.omega_squared(r, CFG.series)),
    "dimension_pairs": _rates(lambda spark, r: V.pairs(r, CFG.series)),
    "collapse_order": _rates(lambda spark, r: V.collapse_order(spark, r, CFG.mandatory + CFG.extra)),
    "pass_plan": _of("plan")(),
    "level_values": _fine(lambda f: levels.values(f, "product", CFG)),
    "level_groups": _fine(lambda f: levels.levels(f.sparkSession, f, "product", CFG)),
    "dynamics_statistics": _pooled(D.statistics),
    "dynamics_tests": _of("tested")(),
    "series_dynamics": _of("series_dynamics")(),
    "dynamics_shares": _of("tested", "chosen", "units")(lambda t, c, u: segments.dynamics_shares(t, c, u, CFG)),
    "portfolio_dynamics": _units(lambda u: D.tests(segments.portfolio(u, CFG))),
    "portfolio_month_profile": _units(lambda u: D.month_profile(segments.portfolio(u, CFG))),
    "month_profile": _pooled(D.month_profile),
    "mark_redistribution": _of("moves")(),
    "mark_shares_ahead": _marks_ahead(lambda past, future: MD.shares(past, future, CFG)),
    "mark_costs": _fine(lambda fine: MD.costs(MD.history(fine, CFG))),
    "mark_mix_effect": _marks_ahead(MD.effects),
    "mark_effect_by_year": _marks_ahead(lambda past, future: MD.by_year(MD.effects(past, future))),
    "matured_forecast": _of("forecast", "units", "moves")(matured_forecast),
    "uplift_bands": _fine(lambda f: bootstrap.bands(f, CFG)),
    "merge_evidence": _of("rungs", "chosen", "summary")(E.merges),
    "ladder_stages": _of("rungs", "chosen")(E.stages),
    "stage_summary": _of("units", "rungs", "chosen")(lambda u, r, c: E.stage_summary(u, r, c, CFG)),
    "series_cards": _of("fine", "summary", "chosen", "weights")(lambda f, s, c, w: E.cards(f, s, c, w, CFG)),
    "core_table": _of("core")(lambda c: c.withColumn("rate", F.round("rate", 9))),
    "core_legend": lambda spark, sf: core.legend(spark),
    "new_rows_by_source": _of("core")(core.new_rows),
    "grand_total": _of("fine", "core", "second")(lambda f, c, s: universe.grand_total(f, c, s, CFG)),
    "series_estimate": _of(*_ESTIMATE)(lambda *t: risk.estimates(*t, CFG)),
    "risk_levels": _of(*_ESTIMATE)(lambda *t: risk.report(risk.estimates(*t, CFG))),
    "second_universe": _of("second")(),
    "spreadsheet_exam": _units(spreadsheet_exam),
    "series_exam": _of("exam_rows")(_six),
    "series_exam_per_series": _of("exam_rows")(lambda e: _six(EX.per_series(e))),
    "series_exam_by_month": _of("exam_rows")(lambda e: _six(EX.by_month(e))),
    "series_exam_summary": _of("exam_rows")(lambda e: _six(EX.summary(e))),
    "exam_segments": _of("exam_rows", "series_dynamics")(lambda e, d: _six(segments.exam_segments(EX.per_series(e), d))),
    "exam_noise_by_size": _of("exam_rows")(lambda e: _six(segments.noise_by_size(e, CFG))),
    "exam_noise_of_total": _of("exam_rows")(lambda e: _six(segments.noise_of_total(e))),
    "support_buckets": _of("summary", *_ESTIMATE)(lambda s, *t: segments.support_buckets(risk.estimates(*t, CFG), s, CFG)),
    "support_gain": _of("summary", *_ESTIMATE)(lambda s, *t: segments.support_gain(risk.estimates(*t, CFG), s, CFG)),
    "series_backtest": _of("series_trials")(_six),
    "series_technique_summary": _of("series_trials")(lambda t: _six(series_backtest.summary(t))),
    **{name: _cover(name) for name in COVERS},
    **{name: _report(text) for name, text in REPORTS.items()},
}
