"""Column expressions that several operators share."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from renewcast import config as C


def month_ordinal(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def month_start(ordinal: Column) -> Column:
    return F.make_date((ordinal / 12).cast("int"), (ordinal % 12 + 1).cast("int"), F.lit(1))


def parse_month(text: Column) -> Column:
    """First day of a month written yyyy-MM, yyyy-MM-dd or dd/MM/yyyy; null for anything else."""
    t = F.trim(text)
    return F.trunc(F.when(t.rlike(r"^\d{4}-\d{2}$"), F.try_to_timestamp(F.concat(t, F.lit("-01")), F.lit("yyyy-MM-dd")))
                   .when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(F.substring(t, 1, 10), F.lit("yyyy-MM-dd")))
                   .when(t.rlike(r"^\d{2}/\d{2}/\d{4}"), F.try_to_timestamp(F.substring(t, 1, 10), F.lit("dd/MM/yyyy"))).cast("date"), "month")


def role(ordinal: Column, cfg: C.Config) -> Column:
    return F.when(ordinal >= cfg.current, C.PROJECTION).when(ordinal >= cfg.exam, C.EXAM).otherwise(C.TRAINING)


def join_id(*columns: str) -> Column:
    return F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns))


def hash_key(text: Column) -> Column:
    """The first 48 bits of the MD5 of an id."""
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def active(flag: str) -> Column:
    return F.col(flag).cast("string").isin("1", "true")


def sign(cfg: C.Config) -> Column:
    def some(names):
        out = F.lit(False)
        for c in names:
            out = out | active(c)
        return out

    down, up = some(cfg.negative), some(cfg.positive)
    return F.when(down & up, C.MIXED).when(down, C.NEGATIVE).when(up, C.POSITIVE).otherwise(C.NEUTRAL)


def marks(cfg: C.Config) -> Column:
    """Labels of the active negative marks, in their declared order."""
    text = F.concat_ws("+", *(F.when(active(c), c) for c in cfg.negative))
    return F.when(text == "", "neutral").otherwise(text)


def discount_bucket(percent: Column, edges: tuple[int, ...]) -> Column:
    """[lo, hi) in percent; the last one is closed; unknown stays unknown, not 0 %."""
    out = F.when(percent.isNull(), C.UNKNOWN_DISCOUNT)
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        inside = (percent >= lo) & ((percent <= hi) if i == len(edges) - 2 else (percent < hi))
        out = out.when(inside, f"{i + 1:02d} _ {lo}-{hi}%")
    return out


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def wilson(p: Column, n: Column, z: float) -> Column:
    """Half width of the interval in points; 50 without cases."""
    m = F.greatest(n, F.lit(1)).cast("double")
    half = F.lit(z) * F.sqrt(p * (1 - p) / m + F.lit(z * z) / (4 * m * m)) / (1 + F.lit(z * z) / m)
    return F.when((n <= 0) | p.isNull(), F.lit(50.0)).otherwise(100 * half)


def binomial_error(p: Column, n: Column) -> Column:
    return 100 * F.sqrt(p * (1 - p) / F.greatest(n, F.lit(1)).cast("double"))


def logit(p: Column) -> Column:
    q = F.greatest(F.least(p, F.lit(0.999)), F.lit(0.001))
    return F.ln(q / (1 - q))


def inverse_logit(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))
