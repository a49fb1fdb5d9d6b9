"""The report's cover in SQL over the written core, with the years as bound parameters."""
from __future__ import annotations

import re

from pyspark.sql import DataFrame

READS = ("core", "second", "predictions", "decision")
COVERS = {
    # The year's number: renewed so far, still expected, and the bands of what is.
    "cover_yearly": """
SELECT CAST(FLOOR(ord / 12) AS INT) AS year, ROUND(SUM(COALESCE(CAST(ren_value AS DOUBLE) / 200, expected_cents, 0)) / 100, 2) AS renewed, ROUND(SUM(COALESCE(CAST(ren_value AS DOUBLE), 0)) / 20000, 2) AS renewed_actual, ROUND(SUM(COALESCE(expected_cents, 0)) / 100, 2) AS renewed_forecast,
       ROUND(CAST(SUM(due_cents) AS DOUBLE) / 100, 2) AS to_renew, ROUND(SUM(COALESCE(CAST(ren_value AS DOUBLE) / 200, expected_cents_low, 0)) / 100, 2) AS linear_low, ROUND(SUM(COALESCE(CAST(ren_value AS DOUBLE) / 200, expected_cents_high, 0)) / 100, 2) AS linear_high,
       ROUND(SQRT(SUM(POWER(COALESCE(expected_cents - expected_cents_low, 0) / 100, 2))), 2) AS quadrature_minus, ROUND(SQRT(SUM(POWER(COALESCE(expected_cents_high - expected_cents, 0) / 100, 2))), 2) AS quadrature_plus
FROM core WHERE source IN ('real', 'forecast') AND CAST(FLOOR(ord / 12) AS INT) IN (:current_year, :next_year) GROUP BY CAST(FLOOR(ord / 12) AS INT)""",
    # Trials by purpose, and how many decisions came of them.
    "cover_trials": """
SELECT purpose, COUNT(*) AS predictions, COUNT(DISTINCT composition) AS compositions, COUNT(DISTINCT technique) AS techniques, COUNT(DISTINCT ord) AS months, (SELECT COUNT(*) FROM decision) AS decisions, (SELECT COUNT(*) FROM decision WHERE origin = 'campeon') AS champions
FROM predictions GROUP BY purpose""",
    # Next year's pipeline by where it comes from.
    "cover_pipeline": """
WITH part AS (SELECT source AS origin, CAST(COALESCE(due_units, expected_units) AS DOUBLE) AS due, expected_units AS renewed FROM core WHERE source IN ('forecast', 'extension', 'acquisition') AND CAST(FLOOR(ord / 12) AS INT) = :next_year
  UNION ALL SELECT origin, units, renewed_units FROM second WHERE origin = 'ts_reentrada' AND CAST(FLOOR(ord / 12) AS INT) = :next_year)
SELECT origin, ROUND(SUM(due), 2) AS to_renew_units, ROUND(SUM(renewed), 2) AS renewed_units, ROUND(SUM(due) / NULLIF(SUM(SUM(due)) OVER (), 0), 6) AS share FROM part GROUP BY origin""",
    # What of next year's pipeline is acquired only by simulation.
    "cover_simulated": """
SELECT ROUND(SUM(CASE WHEN source = 'acquisition' THEN expected_units ELSE 0 END), 2) AS simulated_units, COUNT(DISTINCT CASE WHEN source = 'acquisition' THEN ord END) AS months, ROUND(SUM(CASE WHEN source = 'acquisition' THEN expected_units ELSE 0 END) / NULLIF(SUM(CAST(COALESCE(due_units, expected_units) AS DOUBLE)), 0), 6) AS share_of_pipeline
FROM core WHERE source IN ('forecast', 'extension', 'acquisition') AND CAST(FLOOR(ord / 12) AS INT) = :next_year""",
    # How much of the forecast's money has an uplift.
    "cover_uplift": """
SELECT CAST(FLOOR(ord / 12) AS INT) AS year, ROUND(SUM(expected_cents) / 100, 2) AS renewed_forecast, ROUND(SUM(CASE WHEN uplift IS NOT NULL THEN expected_cents ELSE 0 END) / 100, 2) AS with_uplift, ROUND(SUM(CASE WHEN uplift IS NOT NULL THEN expected_cents ELSE 0 END) / NULLIF(SUM(expected_cents), 0), 6) AS share
FROM core WHERE source = 'forecast' AND CAST(FLOOR(ord / 12) AS INT) IN (:current_year, :next_year) GROUP BY CAST(FLOOR(ord / 12) AS INT)""",
    # The second universe and its share of all that is renewed.
    "cover_second_universe": """
WITH retail AS (SELECT CAST(FLOOR(ord / 12) AS INT) AS year, SUM(CASE WHEN origin = 'ts_real' THEN revenue ELSE 0 END) AS actual, SUM(CASE WHEN origin = 'ts_proyectado' THEN revenue ELSE 0 END) AS projected, SUM(CASE WHEN origin = 'ts_reentrada' THEN value ELSE 0 END) AS reentry_due, SUM(CASE WHEN origin = 'ts_reentrada' THEN revenue ELSE 0 END) AS reentry_renewed, SUM(revenue) AS revenue FROM second GROUP BY CAST(FLOOR(ord / 12) AS INT)),
pipeline AS (SELECT CAST(FLOOR(ord / 12) AS INT) AS year, SUM(COALESCE(CAST(ren_value AS DOUBLE) / 20000, expected_cents / 100, 0)) AS renewed FROM core WHERE source IN ('real', 'forecast') GROUP BY CAST(FLOOR(ord / 12) AS INT))
SELECT retail.year AS year, ROUND(actual, 2) AS actual, ROUND(projected, 2) AS projected, ROUND(reentry_due, 2) AS reentry_due, ROUND(reentry_renewed, 2) AS reentry_renewed, ROUND(revenue / NULLIF(revenue + renewed, 0), 6) AS share_of_renewed FROM retail LEFT JOIN pipeline ON retail.year = pipeline.year WHERE retail.year IN (:current_year, :next_year)""",
    # One row of text.
    "cover_comment": """
WITH n AS (SELECT ROUND(SUM(CASE WHEN source = 'real' THEN CAST(ren_units AS DOUBLE) ELSE 0 END), 0) AS done, ROUND(SUM(CASE WHEN source = 'forecast' THEN expected_units ELSE 0 END), 0) AS ahead, COUNT(DISTINCT CASE WHEN source = 'forecast' THEN fs_id END) AS series FROM core WHERE CAST(FLOOR(ord / 12) AS INT) = :current_year)
SELECT CONCAT('Year ', CAST(:current_year AS VARCHAR(4)), ': ', CAST(CAST(done AS BIGINT) AS VARCHAR(20)), ' units renewed, ', CAST(CAST(ahead AS BIGINT) AS VARCHAR(20)), ' more expected from ', CAST(series AS VARCHAR(20)), ' series') AS comment FROM n""",
    # Who decides the forecast: units expected by technique and year.
    "expected_by_technique": """
SELECT origin AS choice, technique, COUNT(*) AS compositions FROM decision GROUP BY origin, technique""",
}


def cover(name: str, tables: dict[str, DataFrame], current_year: int, next_year: int) -> DataFrame:
    text, spark = COVERS[name], tables["core"].sparkSession
    used = {t: tables[t] for t in READS if re.search(rf"\bFROM {t}\b", text)}
    for t in used:
        text = re.sub(rf"\bFROM {t}\b", f"FROM {{{t}}}", text)
    years = {k: v for k, v in {"current_year": current_year, "next_year": next_year}.items() if f":{k}" in text}
    return spark.sql(text, args=years, **used) if years else spark.sql(text, **used)


def bound(text: str, years: dict[str, int]) -> str:
    """The text with its parameters as values, for engines that take none."""
    for k, v in years.items():
        text = text.replace(f":{k}", str(v))
    return text
