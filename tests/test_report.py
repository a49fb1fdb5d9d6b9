"""The source's structure, sinks, settings, the written report and replaced steps."""
from dataclasses import replace

import pytest

from renewcast.config import Config
from renewcast.operators import structure as S
from renewcast.plans import written_report as W
from renewcast.plans.pipeline import steps
from renewcast.plans.queries import QUERIES
from renewcast.plans.store import Step
from renewcast.sources.files import read_csv, write_csv

SF = "/root/testdata/sf0.001"


def test_structure(spark):
    a = spark.createDataFrame([(1, "x", 7), (1, None, 8), (2, "y", None), (None, "z", 7)], "id long, name string, to int")
    b = spark.createDataFrame([(7, 1)], "key int, more int")
    got = {(r.source, r.field, r.rule): (r.rows, r.broken, r.state) for r in S.structure({"a": a, "b": b}, {"a": {"id": S.NUMBER, "name": S.DATE, "gone": S.TEXT}, "b": {"key": S.NUMBER}}, {"a": "id", "b": "key"}, (("a", "to", "b"), ("a", "gone", "b"))).collect()}
    assert got == {("a", "id", "present"): (4, 0, "ok"), ("a", "name", "present"): (4, 0, "ok"), ("a", "gone", "present"): (4, 1, "failed"), ("a", "id", "type"): (4, 0, "ok"), ("a", "name", "type"): (4, 1, "failed"), ("a", "id", "not null"): (4, 1, "failed"), ("a", "name", "not null"): (4, 1, "failed"),
                   ("b", "key", "present"): (1, 0, "ok"), ("b", "key", "type"): (1, 0, "ok"), ("b", "key", "not null"): (1, 0, "ok"), ("a", "id", "unique"): (3, 1, "failed"), ("b", "key", "unique"): (1, 0, "ok"), ("a", "to", "in b"): (3, 1, "failed")}
    nothing = S.structure({"a": a.limit(0), "b": b.limit(0)}, {"a": {"id": S.NUMBER}}, {"a": "id", "b": "key"}, (("a", "to", "b"),)).collect()
    assert {(r.rows, r.broken, r.state) for r in nothing} == {(0, 0, "ok")} and len(nothing) == 6


def test_csv(spark, tmp_path):
    rows = [(1, 'a "quoted", cell', 0.5), (2, "two\nlines", None), (3, "", 1e-9), (4, None, 2.0), (5, "back\\slash", 3.0)]
    df = spark.createDataFrame(rows, "id long, text string, x double")
    path = str(tmp_path / "out")
    assert write_csv(df, path) == 5 and write_csv(df.limit(2), path) == 2 and write_csv(df.limit(0), path) == 0
    assert write_csv(df, path) == 5
    assert sorted(map(tuple, read_csv(spark, path, df.schema).collect())) == rows


def test_parameters(spark):
    rows = {r.name: r for r in W.parameters(spark, replace(Config(), support_floor=60)).collect()}
    assert rows["support_floor"].value == "60" and [n for n, r in rows.items() if r.changed] == ["support_floor"] and rows["mandatory"].kind == "tuple"


def test_report(spark, tmp_path):
    chapters = {"One": (W.Table("calendar_by_month", "By month.", ("ord", "role"), ("-ord",)),), "Two": (W.Table("none", "Nothing.", (), ()), W.Table("odd", "Odd cells.", (), ()))}
    queries = QUERIES | {"none": lambda s, d: s.range(0), "odd": lambda s, d: s.createDataFrame([("a|b\nc", None, 1234.5)], "t string, n long, x double")}
    text = W.write(spark, SF, str(tmp_path / "report"), queries, Config(), chapters)
    assert "".join(r.value for r in spark.read.text(str(tmp_path / "report"), wholetext=True).collect()) == text
    n, last = QUERIES["calendar_by_month"](spark, SF).count(), QUERIES["calendar_by_month"](spark, SF).orderBy("ord", ascending=False).first()
    assert f"The first {W.TOP} of {n} rows." in text and f"| {last.ord} | {last.role} |" in text and text.count("proyeccion") + text.count("examen") + text.count("entrenamiento") == W.TOP
    assert "No rows." in text and "| a\\|b c |  | 1,234.5 |" in text and "| support_floor | 30 | False |" in text


def test_chapters_have_queries():
    assert {t.query for tables in W.CHAPTERS.values() for t in tables} <= set(QUERIES)


def test_replaced_source(spark, tmp_path):
    """Another source stands in for the extract; what it makes is not mistaken for the other's."""
    own, cfg = steps(spark, SF, Config(), str(tmp_path)), Config()

    def half(s, d, c):
        return own["fine"].where("region = 'ASIA'")

    other = steps(spark, SF, cfg, str(tmp_path), (Step("fine", half),))
    assert other.path("units") != own.path("units") and {r.region for r in other["units"].select("region").distinct().collect()} == {"ASIA"}
    assert own["units"].select("region").distinct().count() > 1
    with pytest.raises(ValueError):
        steps(spark, SF, cfg, None, (Step("nothing", half),))
