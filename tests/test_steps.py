"""Steps that are written once: resumed, outdated by settings, code and data; the ladder from its plan; nested levels."""
import os
import shutil
from dataclasses import replace

import pytest

from renewcast.config import Config
from renewcast.operators import passes, relevance
from renewcast.plans.pipeline import conservation, run
from renewcast.plans.store import Step, Steps

SF = "/root/testdata/sf0.001"


def folders(path):
    return {n for n in os.listdir(path) if not n.startswith(".")}


def test_run_and_resume(spark, tmp_path):
    first = run(spark, SF, str(tmp_path))
    assert conservation(first).count() == 0 and {m["step"] for m in first.made} == set(first)
    n, there = first["forecast"].count(), folders(tmp_path)
    again = run(spark, SF, str(tmp_path))
    assert again.made == [] and again["forecast"].count() == n > 0
    part = run(spark, SF, str(tmp_path), start="decision")
    assert {m["step"] for m in part.made} == {"decision", "forecast", "yearly", "core", "exam_rows", "series_trials"} and folders(tmp_path) == there
    # Other settings: nothing of the former run is read where they matter, nor left behind.
    other = run(spark, SF, str(tmp_path), replace(Config(), support_floor=60))
    assert {m["step"] for m in other.made} == set(other) and not {n for n in folders(tmp_path) if n != "manifest"} & there
    assert other["chosen"].where("pass = 0").count() < spark.read.json(f"{tmp_path}/manifest").count() + n


@pytest.fixture
def small(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    spark.range(5).write.parquet(f"{data}/numbers.parquet")
    calls = []

    def steps(cfg=Config(), key=()):
        return Steps(spark, str(data), cfg, (
            Step("a", lambda s, d, c: calls.append("a") or s.read.parquet(f"{d}/numbers.parquet")),
            Step("b", lambda t, c: calls.append("b") or t["a"].selectExpr("id DIV 2 AS half"), ("a",), (), key)), ("numbers",), str(tmp_path / "steps"))

    return data, calls, steps


def test_steps_are_made_when_asked_for(small):
    data, calls, steps = small
    t = steps()
    assert calls == [] and t["b"].count() == 5 and calls == ["a", "b"]
    assert steps()["b"].count() == 5 and calls == ["a", "b"]


def test_new_data_outdates(spark, small):
    data, calls, steps = small
    old = steps()
    assert old["b"].count() == 5
    spark.range(7).write.mode("overwrite").parquet(f"{data}/numbers.parquet")
    new = steps()
    assert new["b"].count() == 7 and new.mark("a") != old.mark("a") and new.mark("b") != old.mark("b") and len(new.drop_stale()) == 2


def test_keys_and_broken_runs(small, tmp_path):
    data, calls, steps = small
    with pytest.raises(ValueError, match="not unique"):
        steps(key=("half",))["b"]
    # What was not whole has no name, so the step is made the next time.
    assert steps()["b"].count() == 5 and calls.count("a") == 1 and calls.count("b") == 2
    t = steps()
    shutil.rmtree(t.path("b"))
    assert steps()["b"].count() == 5 and calls.count("b") == 3


def test_ladder_from_a_plan(spark):
    """A plan of six passes, by hand: floors, signs, groups that gain nothing, and references."""
    cfg = Config()
    months = range(cfg.current - 4, cfg.current)
    series = {"EU|A|0|0|0|web": ("neutro", 100), "EU|A|1|0|0|web": ("negativo", 10), "EU|A|0|1|0|web": ("negativo", 25), "EU|B|0|0|0|web": ("neutro", 5), "NA|B|0|0|0|shop": ("neutro", 6), "NA|B|1|0|1|web": ("mixto", 3), "NA|A|1|0|0|web": ("negativo", 2)}
    rows = [(f, *f.split("|")[:2], *map(int, f.split("|")[2:5]), f.split("|")[5], sign, o, n, n // 2) for f, (sign, n) in series.items() for o in months]
    units = spark.createDataFrame(rows, "fs_id string, region string, product string, dormant int, softcancel int, autorenew int, channel string, sign string, ord int, due_units long, ren_units long")
    routes = spark.createDataFrame([(f, "predecible", "normal", 100) for f in series], "fs_id string, route string, universe string, to_predict_cents long")
    plan = [passes.Pass(0, "itself", frozenset(), True, True), passes.Pass(1, "sign", frozenset(), True, True), passes.Pass(2, "extra channel", frozenset({"channel"}), True, True), passes.Pass(3, "without region", frozenset({"channel", "region"}), True, True),
            passes.Pass(4, "without product", frozenset({"channel", "region", "product"}), False, False)]
    stats = passes.stats(units, routes, plan, cfg)
    got = {(r.fs_id, r["pass"]): r for r in passes.run(stats, cfg).collect()}
    assert {p for _, p in got} == {0, 1, 2, 3} and len(got) == 4 * len(series)
    of = lambda f: [got[f, p].group_id for p in range(4)]
    assert of("EU|A|0|0|0|web") == ["EU|A|0|0|0|web"] * 4 and all(got["EU|A|0|0|0|web", p].closed for p in range(4))
    # Two negative series meet at the sign and reach the floor there: 10 + 25.
    assert of("EU|A|1|0|0|web") == ["EU|A|1|0|0|web"] + ["EU|A|SIG=negativo|web"] * 3 and got["EU|A|1|0|0|web", 3].group_support == 35
    # The neutral ones of B gain nothing from sign and channel, and meet without the region; they stay below the floor.
    assert of("EU|B|0|0|0|web") == ["EU|B|0|0|0|web"] * 3 + ["*|B|SIG=neutro|*"] and got["EU|B|0|0|0|web", 3].group_series == 2 and not got["EU|B|0|0|0|web", 3].closed
    # All three negative series of A, though two of them stay before: 2 + 10 + 25.
    assert of("NA|A|1|0|0|web")[3] == "*|A|SIG=negativo|*" and got["NA|A|1|0|0|web", 3].group_support == 37
    assert of("NA|B|1|0|1|web") == ["NA|B|1|0|1|web"] * 4
    last = {r.fs_id: r for r in passes.compositions(stats, passes.run(stats, cfg), cfg).collect()}
    assert last["EU|B|0|0|0|web"].reference == "*|*|SIG=neutro|*" and last["EU|B|0|0|0|web"].reference_support == 111 and last["EU|B|0|0|0|web"].reference_pass == 4
    # Signed groups may not take the last pass; the next pass that does gain is a reference.
    assert last["EU|A|1|0|0|web"].reference == "*|A|SIG=negativo|*" and last["NA|A|1|0|0|web"].reference is None and last["NA|B|1|0|1|web"].reference is None


def test_nested_collapse(spark):
    """A finer level goes first, whatever it costs; a dimension beside its own levels is finer than they are."""
    rows = [("A", "A1", "x", 0.9, 5.0), ("A", "A1", "y", 0.9, 5.0), ("A", "A2", "x", 0.5, 5.0), ("A", "A2", "y", 0.5, 5.0), ("B", "B1", "x", 0.3, 5.0), ("B", "B1", "y", 0.3, 5.0)]
    df = spark.createDataFrame(rows, "product_level_1 string, product_level_2 string, channel string, rate double, w double")
    order = lambda *dims: [r.dimension for r in relevance.collapse_order(spark, df, dims).orderBy("place").collect()]
    assert order("product_level_1", "product_level_2") == ["product_level_2", "product_level_1"]
    assert order("product_level_1", "product_level_2", "channel") == ["channel", "product_level_2", "product_level_1"]
    raw = df.withColumnRenamed("product_level_2", "product")
    assert [r.dimension for r in relevance.collapse_order(spark, raw, ("product_level_1", "product")).orderBy("place").collect()] == ["product", "product_level_1"]
    left = ["product", "product_level_1", "product_level_2", "region_level_1", "channel"]
    assert relevance.level_of("product", left) == ("product", 3) and relevance.free(left) == ["product", "region_level_1", "channel"]


def test_percentiles(spark):
    """Rows of equal uplift stay apart, as in a straight-line interpolation over the cumulated shares."""
    import numpy as np

    from renewcast.operators.price import percentiles
    from pyspark.sql import functions as F

    rng = np.random.default_rng(6)
    cases = {"a": [(1.0, 1), (2.0, 1), (2.0, 1)], "b": [(float(rng.integers(1, 6)), int(rng.integers(1, 4))) for _ in range(60)], "c": [(3.0, 7)]}
    df = spark.createDataFrame([(k, u, w) for k, rows in cases.items() for u, w in rows], "k string, u double, w long")
    got = {r.k: r for r in percentiles(df, ["k"], [F.col("u"), F.col("w")], "w", {"p10": 0.1, "p50": 0.5, "p90": 0.9}).collect()}
    for k, rows in cases.items():
        u, w = zip(*sorted(rows))
        share = np.cumsum(w) / sum(w)
        assert [got[k][p] for p in ("p10", "p50", "p90")] == pytest.approx([np.interp(q, share, u) for q in (0.1, 0.5, 0.9)], abs=1e-6)
    assert (got["a"].p50, got["a"].p90) == (1.5, 2.0)


@pytest.fixture(scope="module")
def tables(spark):
    from renewcast.plans.pipeline import steps
    from renewcast.plans.queries import CFG

    return steps(spark, SF, CFG)


def test_audit_finds_what_is_planted(spark, tables):
    """No differences in what is written; a changed figure, a lost and an added row are found."""
    from pyspark.sql import functions as F

    from renewcast.operators import audit

    t = {k: tables[k] for k in audit.AUDITED}
    assert audit.differences(t, Config()).count() == 0
    month = t["forecast"].agg(F.min("ord")).first()[0]
    t["forecast"] = t["forecast"].where(F.col("ord") != month)
    one = t["pooled"].orderBy("composition", "ord").first()
    t["pooled"] = t["pooled"].withColumn("ren_units", F.when((F.col("composition") == one.composition) & (F.col("ord") == one.ord), F.col("ren_units") + 1).otherwise(F.col("ren_units")))
    t["core"] = t["core"].unionByName(t["core"].limit(1).withColumns({"ord": F.lit(1), "due_cents": F.lit(5).cast("long"), "source": F.lit("real")}))
    got = {(r.what, r.key, r.value): (r.written, r.again) for r in audit.differences(t, Config()).collect()}
    assert set(got) == {("forecast", str(month), "due_units"), ("pooled", f"{one.composition}|{one.ord}", "ren_units"), ("core", "1", "due_cents")}
    assert got["forecast", str(month), "due_units"][0] is None and got["core", "1", "due_cents"] == (5, None)
    written, again = got["pooled", f"{one.composition}|{one.ord}", "ren_units"]
    assert written == again + 1


def test_checks_tell(spark, tables):
    from pyspark.sql import functions as F

    from renewcast.operators import checks

    t = {k: tables[k] for k in checks.needed()}
    sound = {(r.scope, r.name): r for r in checks.registry(t).collect()}
    assert len(sound) == len(checks.CHECKS) + len(checks.KEYS) and not [r for r in sound.values() if r.state == "failed"]
    t["fine"] = t["fine"].withColumn("percent", F.when(F.col("percent") == 0, 120).otherwise(F.col("percent")))
    t["weights"] = t["weights"].where("z = 1")
    broken = {(r.scope, r.name): r for r in checks.registry(t).collect()}
    assert broken["fine", "discount is a percentage"].state == "failed" and broken["fine", "discount is a percentage"].broken == tables["fine"].where("percent = 0").count()
    assert broken["forecast", "fs_id is in weights"].state == "failed" and broken["fine", "discount known"].state == "warning"


def test_ranks_share_ties(spark):
    from renewcast.operators import audit

    comps = spark.createDataFrame([("c",)], "composition string")
    rows = [("c", "seleccion", 1, t, e, 10 * e) for t, e in (("T2_mean", 0.5), ("T3_ma3", -0.5), ("T3_ma6", 0.2), ("T4_ewma", 0.9))] + [("c", "examen", 1, "T9_ses", 0.1, 1.0)]
    predictions = spark.createDataFrame(rows, "composition string, purpose string, h int, technique string, error_norm double, error double")
    decision = spark.createDataFrame([("c", 1, "T3_ma6")], "composition string, h int, technique string")
    got = {r.technique: r for r in audit.technique_trials(comps, predictions, decision).where("h = 1").collect()}
    assert [got[t]["rank"] for t in ("T3_ma6", "T2_mean", "T3_ma3", "T4_ewma", "T9_ses", "T12_theta")] == [1, 2, 2, 4, None, None]
    assert got["T9_ses"].status == "tested" and got["T12_theta"].status == "too_short" and [t for t in got if got[t].chosen] == ["T3_ma6"]


def test_longest_run(spark):
    from renewcast.operators.price import longest_runs

    now = Config().current
    marks = {"a": "011101100000", "b": "010101000000", "c": "000000000000", "d": "111111111111"}
    rows = [(p, now - 12 + i, 0.05 if x == "1" else 0.0, int(x)) for p, m in marks.items() for i, x in enumerate(m)] + [("a", now - 13, 0.05, 1), ("c", now - 14, 0.05, 1)]
    got = {r.product: (r.months_above, r.longest_run, r.verdict) for r in longest_runs(spark.createDataFrame(rows, "product string, ord int, step double, above int"), Config()).collect()}
    assert got == {"a": (5, 3, "increase"), "b": (3, 1, "scattered"), "c": (0, 0, "none"), "d": (12, 12, "increase")}


def test_levels_are_kept(spark, tmp_path):
    """Written by one run, applied by the next; values that it has not seen fall to the rest."""
    from renewcast.operators import levels

    mapping = spark.createDataFrame([("product", "a", "a + b"), ("product", "b", "a + b"), ("region", "x", "x")], "dimension string, value string, level string")
    levels.save(mapping, f"file://{tmp_path}/levels")
    back = levels.load(spark, f"file://{tmp_path}/levels")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, mapping.collect()))
    got = levels.apply_levels(spark.createDataFrame([("a",), ("b",), ("new",), (None,)], "product string"), "product", back)
    assert sorted((r["product"] or "", r.product_level_1) for r in got.collect()) == [("", levels.RESIDUAL), ("a", "a + b"), ("b", "a + b"), ("new", levels.RESIDUAL)]
