"""The written report: chapters of tables in Markdown, from written steps."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewcast.config import Config

#: Rows of a table that the report shows, the first ones by the chapter's order; it says how many there are.
TOP = 25


@dataclass(frozen=True)
class Table:
    """A query's columns under a heading, by an order (``-``: falling)."""

    query: str
    says: str
    columns: tuple[str, ...]
    order: tuple[str, ...]


CHAPTERS = {
    "What falls due": (Table("calendar_by_month", "Units and money by month and role.", (), ("ord",)), Table("check_registry", "Checks that something breaks come first.", ("scope", "name", "rows", "broken", "state"), ("-broken", "scope", "name"))),
    "Rows that the source doesn't have": (Table("new_rows_by_source", "By month and source.", (), ("ord", "source")),),
    "Support before and after the ladder": (Table("support_buckets", "Money by the series' own support.", (), ("support",)), Table("support_gain", "Money known within five points, and the error weighed by money.", (), ("all_cents",)), Table("stage_summary", "How support grows by stage.", (), ("stage",)), Table("risk_levels", "Money by risk.", (), ("risk",))),
    "Dynamics of the rate": (Table("portfolio_dynamics", "Is there more than noise in the whole?", (), ("composition",)), Table("portfolio_month_profile", "Each calendar month against the year, in points.", (), ("month",)), Table("dynamics_shares", "Compositions by what their rates do; attributes overlap.", (), ("attribute",))),
    "How good forecasts were": (Table("series_exam_summary", "Methods by horizon.", (), ("method", "h")), Table("exam_segments", "Segments overlap.", (), ("segment",)), Table("exam_noise_by_size", "What of the error is noise that no prediction removes.", (), ("due_from", "method")), Table("exam_noise_of_total", "The same of the whole.", (), ("method",))),
    "Prices": (Table("revaluation_summary", "What renewed against what fell due.", (), ()), Table("uplift_backtest", "Uplifts against contracts.", (), ())),
    "The forecast": (Table("forecast_yearly_totals", "Units by year.", (), ("year",)), Table("forecast_monthly_totals", "Units by month.", (), ("ord",)), Table("grand_total", "Everything, by origin.", (), ())),
    "Cards": (Table("series_estimate", "The series with most money to predict.", ("fs_id", "composition", "rate", "error_estimate_pp", "error_prediction_pp", "risk", "to_predict_cents"), ("-to_predict_cents", "fs_id")),),
}


def parameters(spark: SparkSession, cfg: Config) -> DataFrame:
    """name, kind, value (as text), and whether it differs from the default."""
    default = Config()
    rows = [(f.name, type(getattr(cfg, f.name)).__name__, str(getattr(cfg, f.name)), getattr(cfg, f.name) != getattr(default, f.name)) for f in fields(cfg)]
    return spark.createDataFrame(rows, "name string, kind string, value string, changed boolean")


def _cell(v) -> str:
    text = "" if v is None else f"{v:,.4f}".rstrip("0").rstrip(".") if isinstance(v, float) else str(v)
    return text.replace("\\", "\\\\").replace("|", "\\|").replace("\n", " ")


def markdown(columns: list[str], rows: list) -> str:
    lines = ["| " + " | ".join(map(_cell, r)) + " |" for r in (columns, ["---"] * len(columns), *rows)]
    return "\n".join(lines)


def shown(rows: DataFrame, table: Table) -> tuple[list[str], list, int]:
    """Columns, first rows and the number of all."""
    columns = list(table.columns or rows.columns)
    order = [F.desc(o[1:]) if o.startswith("-") else F.asc(o) for o in table.order] or [F.asc(c) for c in columns]
    return columns, [tuple(r) for r in rows.orderBy(*order).select(*columns).limit(TOP).collect()], rows.count()


def written(spark: SparkSession, sf_dir: str, queries: dict[str, Callable], cfg: Config, chapters=None) -> str:
    out = ["# Renewals report", "## Settings", markdown(["name", "value", "changed"], [(r["name"], r["value"], r["changed"]) for r in parameters(spark, cfg).collect()])]
    for title, tables in (chapters or CHAPTERS).items():
        out.append("## " + title)
        for t in tables:
            columns, rows, n = shown(queries[t.query](spark, sf_dir), t)
            out += [t.says + (f" The first {len(rows)} of {n} rows." if n > len(rows) else ""), markdown(columns, rows) if n else "No rows."]
    return "\n\n".join(out) + "\n"


def write(spark: SparkSession, sf_dir: str, folder: str, queries: dict[str, Callable], cfg: Config, chapters=None) -> str:
    """Writes the report, as one text file in a folder that any store may hold, and returns it."""
    text = written(spark, sf_dir, queries, cfg, chapters)
    spark.createDataFrame([(text.removesuffix("\n"),)], "value string").coalesce(1).write.mode("overwrite").text(folder)
    return text
