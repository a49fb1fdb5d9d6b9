"""The whole run: its steps, and a run of all of them into a folder."""
from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewcast.config import Config
from renewcast.functions import columns
from renewcast.operators import backtest as B
from renewcast.operators import core, dynamics, exam, ladder, maturation, passes, price, relevance, revaluation, segments, series, series_backtest, techniques, universe
from renewcast.plans import projections as P
from renewcast.plans.store import Step, Steps
from renewcast.sources import extract

SOURCES = ("lineitem", "orders", "part", "customer", "nation", "region")
_BASE = (columns, extract)
_TRIED = (columns, B, techniques)

STEPS = (
    Step("fine", lambda spark, sf_dir, c: extract.fine_table(spark, sf_dir, c), (), _BASE),
    Step("units", lambda t, c: extract.units(t["fine"], c), ("fine",), _BASE, ("fs_id", "ord")),
    Step("routes", lambda t, c: series.routes(t["fine"]), ("fine",), (series,), ("fs_id",)),
    Step("summary", lambda t, c: series.rate_summary(t["units"], c), ("units",), (series, columns), ("fs_id",)),
    Step("patterns", lambda t, c: ladder.patterns(t["units"], c), ("units",), (ladder,), ("fs_id", "pass")),
    Step("support", lambda t, c: ladder.pattern_support(t["units"], t["patterns"], c), ("units", "patterns"), (ladder,), ("pass", "pattern")),
    Step("rungs", lambda t, c: ladder.rungs(t["patterns"], t["support"]), ("patterns", "support"), (ladder,), ("fs_id", "pass")),
    Step("chosen", lambda t, c: ladder.chosen(t["rungs"], c), ("rungs",), (ladder,), ("fs_id",)),
    Step("references", lambda t, c: ladder.references(t["rungs"], t["chosen"], c), ("rungs", "chosen"), (ladder,), ("fs_id",)),
    Step("credibility", lambda t, c: ladder.credibility(t["chosen"], t["references"], c), ("chosen", "references"), (ladder,), ("reference",)),
    Step("weights", lambda t, c: ladder.weighted(t["chosen"], t["references"], t["credibility"], c), ("chosen", "references", "credibility"), (ladder,), ("fs_id",)),
    Step("members", lambda t, c: ladder.members(t["patterns"], t["chosen"]), ("patterns", "chosen"), (ladder,), ("fs_id", "composition")),
    Step("pooled", lambda t, c: ladder.pooled(t["members"], t["units"], c), ("members", "units"), (ladder,), ("composition", "ord")),
    Step("rates", lambda t, c: relevance.weighted_rates(P.with_dims(t["summary"], t["units"], c), c.series), ("summary", "units"), (relevance,)),
    Step("plan", lambda t, c: relevance.pass_plan(t["rates"].sparkSession, t["rates"], c), ("rates",), (relevance,), ("pass",)),
    Step("pass_stats", lambda t, c: passes.stats(t["units"], t["routes"], passes.read_plan(t["plan"]), c), ("units", "routes", "plan"), (passes,), ("fs_id", "pass")),
    Step("passes", lambda t, c: passes.run(t["pass_stats"], c), ("pass_stats",), (passes,), ("fs_id", "pass")),
    Step("predictions", lambda t, c: B.backtest(t["pooled"], c), ("pooled",), _TRIED, ("composition", "ord", "h", "technique")),
    Step("decision", lambda t, c: B.choose(t["predictions"], t["chosen"], c), ("predictions", "chosen"), _TRIED, ("composition", "h")),
    Step("bands", lambda t, c: B.error_bands(t["predictions"]), ("predictions",), _TRIED, ("technique", "h")),
    Step("uplift", lambda t, c: price.uplifts(t["fine"], c), ("fine",), (price, columns), ("cell",)),
    Step("forecast", lambda t, c: B.forecast(t["pooled"], t["members"], t["units"], t["decision"], t["bands"], t["weights"], c), ("pooled", "members", "units", "decision", "bands", "weights"), _TRIED, ("fs_id", "ord")),
    Step("yearly", lambda t, c: B.yearly_totals(t["forecast"]), ("forecast",), _TRIED, ("year",)),
    Step("extension", lambda t, c: P.horizon_extension(t["fine"], c), ("fine",), (P,)),
    Step("acquisition", lambda t, c: P.acquisition_lag12(t["fine"], c), ("fine",), (P,)),
    Step("core", lambda t, c: core.core(t["fine"], t["forecast"], t["uplift"], t["extension"], t["acquisition"], c), ("fine", "forecast", "uplift", "extension", "acquisition"), (core, columns), ("row_key",)),
    Step("second", lambda t, c: universe.second_universe(t["fine"], c), ("fine",), (universe,), ("region", "ord", "origin")),
    Step("moves", lambda t, c: maturation.moves(t["fine"], c), ("fine",), (maturation, columns)),
    Step("isolated", lambda spark, sf_dir, c: revaluation.isolated(extract.licences(spark, sf_dir), c), (), (revaluation, *_BASE)),
    Step("valued", lambda t, c: revaluation.series(t["isolated"]), ("isolated",), (revaluation,), ("fs_id",)),
    Step("exam_rows", lambda t, c: exam.detail(t["units"], t["patterns"], t["pooled"], t["decision"], t["bands"], t["weights"], c), ("units", "patterns", "pooled", "decision", "bands", "weights"), (exam, *_TRIED), ("fs_id", "ord", "h", "method")),
    Step("tested", lambda t, c: dynamics.tests(t["pooled"]), ("pooled",), (dynamics,), ("composition",)),
    Step("series_dynamics", lambda t, c: segments.series_dynamics(t["chosen"], t["summary"], t["units"], t["tested"], c), ("chosen", "summary", "units", "tested"), (segments, dynamics), ("fs_id",)),
    Step("series_trials", lambda t, c: series_backtest.detail(t["predictions"], t["decision"], t["bands"], t["weights"], t["patterns"], t["pooled"], t["units"], c), ("predictions", "decision", "bands", "weights", "patterns", "pooled", "units"), (series_backtest, exam, columns), ("fs_id", "ord", "h", "technique")),
)


def steps(spark: SparkSession, sf_dir: str, cfg: Config, folder: str | None = None, replaced: tuple[Step, ...] = (), sources: tuple[str, ...] = SOURCES) -> Steps:
    """``replaced``: steps that stand in for those of their names: another source (``fine`` and ``isolated``, with the
    tables that it reads as ``sources``) or another rule."""
    by = {s.name: s for s in replaced}
    if unknown := set(by) - {s.name for s in STEPS}:
        raise ValueError(f"no steps of these names: {sorted(unknown)}")
    return Steps(spark, sf_dir, cfg, tuple(by.get(s.name, s) for s in STEPS), sources, folder)


def run(spark: SparkSession, sf_dir: str, folder: str, cfg: Config | None = None, start: str | None = None, replaced: tuple[Step, ...] = (), sources: tuple[str, ...] = SOURCES) -> Steps:
    """All steps in a folder.  What a former run has left there is read where code, settings and source are still the
    same, from ``start`` on it is made again, and what they have outdated is deleted."""
    found = steps(spark, sf_dir, cfg or Config(), folder, replaced, sources)
    if start:
        found.forget(start)
    for name in found:
        found[name]
    found.drop_stale()
    manifest = [(json.dumps(asdict(found.cfg)), json.dumps({n: found.mark(n) for n in found}), json.dumps(found.made))]
    spark.createDataFrame(manifest, "config string, marks string, made string").coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")
    return found


def conservation(tables) -> DataFrame:
    """Money of the fine table against that of its units, by month: differences (none when all is well)."""
    a = tables["fine"].where("ts = 0").groupBy("ord").agg(F.sum("due_cents").alias("fine"))
    b = tables["units"].groupBy("ord").agg(F.sum("due_cents").alias("units"))
    return a.join(b, "ord", "full").where(~F.col("fine").eqNullSafe(F.col("units")))
