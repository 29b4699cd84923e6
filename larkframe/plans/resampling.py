"""Splits, folds, bootstraps and time windows."""

from larkframe.learning import resample as rs
from larkframe.operators.moments import fit_ols
from larkframe.operators.ordering import positions
from larkframe.plans.base import *
from larkframe.plans.sqltext import fitted_sql, leverage_sql, ols_sql
from larkframe.tables import DAILY_SQL, REG_SQL, u_sql

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def rank_sql(keys: str, seed: str, by: str = "") -> str:
    p = f"PARTITION BY {by} " if by else ""
    return f"row_number() OVER ({p}ORDER BY md5(concat_ws('-', {keys}, '{seed}')), {keys})"


def cnt_sql(by: str = "") -> str:
    return f"count(*) OVER ({'PARTITION BY ' + by if by else ''})"


@query("rs_initial_split", f"WITH {REG_SQL} SELECT key, CASE WHEN {rank_sql('key', 'split')} <= floor({cnt_sql()} * 0.75) THEN 'train' ELSE 'test' END AS role FROM reg")
def rs_initial_split(t):
    return rs.initial_split(t.reg.select("key"), ["key"])


@query("rs_strata", f"SELECT doc_id, quality, CASE WHEN {rank_sql('doc_id', 'split', 'quality')} <= floor({cnt_sql('quality')} * 0.75) THEN 'train' ELSE 'test' END AS role FROM labels")
def rs_strata(t):
    return rs.initial_split(t.labels.select("doc_id", "quality"), ["doc_id"], strata=["quality"])


@query("rs_strata_numeric", f"""WITH b AS (SELECT o_orderkey, ntile(4) OVER (ORDER BY o_totalprice, o_orderkey)::int AS bin FROM orders)
SELECT o_orderkey, bin, CASE WHEN {rank_sql('o_orderkey', 'split', 'bin')} <= floor({cnt_sql('bin')} * 0.75) THEN 'train' ELSE 'test' END AS role FROM b""")
def rs_strata_numeric(t):
    d = positions(t.orders.select("o_orderkey", "o_totalprice"), [], ["o_totalprice", "o_orderkey"])
    d = d.withColumn("bin", rs.ntile(col("pos"), F.lit(t.orders.count()), 4)).select("o_orderkey", "bin")
    return rs.initial_split(d, ["o_orderkey"], strata=["bin"])


@query("rs_three_way", f"""SELECT o_orderkey, CASE WHEN {rank_sql('o_orderkey', 'three')} <= floor({cnt_sql()} * 0.6) THEN 'train' WHEN {rank_sql('o_orderkey', 'three')} <= floor({cnt_sql()} * 0.8) THEN 'validation' ELSE 'test' END AS role FROM orders""")
def rs_three_way(t):
    return rs.three_way(t.orders.select("o_orderkey"), ["o_orderkey"], 0.6, 0.2)


@query("rs_vfold", "SELECT o_orderkey, ntile(10) OVER (ORDER BY md5(concat_ws('-', o_orderkey, 'fold')), o_orderkey)::int AS fold FROM orders")
def rs_vfold(t):
    return rs.vfold(t.orders.select("o_orderkey"), ["o_orderkey"], 10)


@query("rs_vfold_strata", "SELECT doc_id, quality, ntile(5) OVER (PARTITION BY quality ORDER BY md5(concat_ws('-', doc_id, 'fold')), doc_id)::int AS fold FROM labels")
def rs_vfold_strata(t):
    return rs.vfold(t.labels.select("doc_id", "quality"), ["doc_id"], 5, strata=["quality"])


@query("rs_vfold_repeated", "SELECT o_orderkey, rep::int AS rep, ntile(5) OVER (PARTITION BY rep ORDER BY md5(concat_ws('-', o_orderkey, rep, 'fold')), o_orderkey)::int AS fold FROM orders, range(1, 4) x(rep)")
def rs_vfold_repeated(t):
    return rs.vfold_repeated(t.orders.select("o_orderkey"), ["o_orderkey"], 5, 3)


@query("rs_loo", f"""WITH s AS (SELECT s_suppkey, s_acctbal AS y, s_nationkey::double AS x, s_suppkey::double AS k FROM supplier), {ols_sql('s', 'y', ['x', 'k'])}
SELECT s_suppkey, round((y - {fitted_sql(['x', 'k'], 'ols.')}) / (1 - {leverage_sql(['x', 'k'], 'ols.')}), 4) AS held_out_error FROM s, ols""")
def rs_loo(t):
    """Leave-one-out errors of a linear model by the leverage identity: one fit instead of n fits."""
    d = t.supplier.select("s_suppkey", col("s_acctbal").alias("y"), col("s_nationkey").cast("double").alias("x"), col("s_suppkey").cast("double").alias("k"))
    f = fit_ols(d, "y", ["x", "k"])
    return d.select("s_suppkey", r((col("y") - f.predict()) / (1 - f.leverage()), 4).alias("held_out_error"))


@query("rs_mc", """SELECT o_orderkey, rep::int AS rep, CASE WHEN row_number() OVER (PARTITION BY rep ORDER BY md5(concat_ws('-', o_orderkey, rep, 'mc')), o_orderkey) <= floor(count(*) OVER (PARTITION BY rep) * 0.9) THEN 'analysis' ELSE 'assessment' END AS role
FROM orders, range(1, 4) x(rep)""")
def rs_mc(t):
    return rs.mc_split(t.orders.select("o_orderkey"), ["o_orderkey"], 0.9, 3)


BOOT_SQL = f"""p AS (SELECT o_orderkey, {rank_sql('o_orderkey', 'boot')} AS pos, count(*) OVER () AS n FROM orders),
dr AS (SELECT rep::int AS rep, floor({u_sql('rep, pos', 'boot')} * n)::bigint + 1 AS pick, count(*) AS times FROM p, range(1, 6) x(rep) GROUP BY 1, 2),
bo AS (SELECT rep, o_orderkey, times FROM dr JOIN p ON pick = pos)"""


def boots(t) -> DataFrame:
    return rs.bootstraps(t.orders, ["o_orderkey"], 5)


@query("rs_bootstraps", f"WITH {BOOT_SQL} SELECT * FROM bo")
def rs_bootstraps(t):
    return boots(t)


@query("rs_boot_frequency", f"""WITH {BOOT_SQL}, f AS (SELECT rep, times, count(*) AS n_rows FROM bo GROUP BY 1, 2)
SELECT rep, times, n_rows FROM f UNION ALL SELECT rep, 0, (SELECT count(*) FROM orders) - sum(n_rows)::bigint FROM f GROUP BY 1""")
def rs_boot_frequency(t):
    f = boots(t).groupBy("rep", "times").agg(F.count(F.lit(1)).alias("n_rows"))
    zero = f.groupBy("rep").agg((F.lit(t.orders.count()) - F.sum("n_rows")).alias("n_rows")).select("rep", F.lit(0).cast("long").alias("times"), "n_rows")
    return f.unionByName(zero)


@query("rs_oob", f"WITH {BOOT_SQL} SELECT rep, round(1 - count(*) / (SELECT count(*) FROM orders), 6) AS oob, 0.367879::double AS theory FROM bo GROUP BY 1")
def rs_oob(t):
    n = t.orders.count()
    return boots(t).groupBy("rep").agg(r(1 - F.count(F.lit(1)) / F.lit(n)).alias("oob"), F.lit(0.367879).alias("theory"))


@query("rs_group_vfold", """WITH g AS (SELECT o_custkey, ntile(5) OVER (ORDER BY md5(concat_ws('-', o_custkey, 'group')), o_custkey)::int AS fold FROM (SELECT DISTINCT o_custkey FROM orders))
SELECT o_orderkey, o_custkey, fold FROM orders JOIN g USING (o_custkey)""")
def rs_group_vfold(t):
    return rs.group_vfold(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", 5)


ROLL_SQL = f"""{DAILY_SQL}, ix AS (SELECT d, n, row_number() OVER (ORDER BY d) AS i FROM daily), sp AS (SELECT unnest(range(365, (SELECT count(*) FROM ix) - 30 + 1, 90)) AS e), sq AS (SELECT e, row_number() OVER (ORDER BY e)::int AS split FROM sp)"""


@query("rs_rolling", f"""WITH {ROLL_SQL}, a AS (SELECT split, 'cumulative' AS kind, 'analysis' AS role, d, n FROM sq JOIN ix ON i <= e UNION ALL SELECT split, 'fixed', 'analysis', d, n FROM sq JOIN ix ON i BETWEEN e - 364 AND e
UNION ALL SELECT split, k, 'assessment', d, n FROM sq JOIN ix ON i BETWEEN e + 1 AND e + 30, (VALUES ('cumulative'), ('fixed')) v(k))
SELECT split, kind, role, cast(min(d) AS varchar) AS first_day, cast(max(d) AS varchar) AS last_day, count(*) AS days, sum(n)::bigint AS orders FROM a GROUP BY 1, 2, 3""")
def rs_rolling(t):
    """Expanding and fixed windows over days; a window list is joined to the days on the day number."""
    days = t.daily.withColumn("i", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("d")))  # one row per day
    n = days.count()
    rows = []
    for kind in ("cumulative", "fixed"):
        for s, a0, a1, b0, b1 in rs.rolling_origin(n, 365, 30, skip=89, cumulative=kind == "cumulative"):
            rows += [(s, kind, "analysis", a0, a1), (s, kind, "assessment", b0, b1)]
    windows = t.spark.createDataFrame(rows, "split int, kind string, role string, a int, b int")
    member = windows.select("split", "kind", "role", F.explode(F.sequence("a", "b")).alias("i"))
    return member.join(days, "i").groupBy("split", "kind", "role").agg(
        F.min("d").cast("string").alias("first_day"), F.max("d").cast("string").alias("last_day"), F.count(F.lit(1)).alias("days"), F.sum("n").alias("orders"))


@query("rs_sliding_period", """WITH m AS (SELECT o_orderkey, (year(o_orderdate) * 12 + month(o_orderdate))::int AS k FROM orders), b AS (SELECT min(k) AS lo, max(k) AS hi FROM m)
SELECT o_orderkey, (k + j)::int AS anchor, CASE WHEN j < 0 THEN 'assessment' ELSE 'analysis' END AS role FROM m, b, (VALUES (-1), (0), (1), (2)) x(j) WHERE k + j BETWEEN lo + 2 AND hi - 1""")
def rs_sliding_period(t):
    """Three months of analysis up to the anchor month, one month of assessment after it."""
    d = t.orders.select("o_orderkey", (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("k"))
    b = one_row(d, lo=F.min("k"), hi=F.max("k"))
    d = d.select("o_orderkey", "k", F.explode(F.array(*[F.lit(j) for j in (-1, 0, 1, 2)])).alias("j"))
    anchor = col("k") + col("j")
    return d.where(anchor.between(b["lo"] + 2, b["hi"] - 1)).select("o_orderkey", anchor.alias("anchor"), F.when(col("j") < 0, "assessment").otherwise("analysis").alias("role"))


@query("rs_nested", """WITH o AS (SELECT o_orderkey, ntile(5) OVER (ORDER BY md5(concat_ws('-', o_orderkey, 'outer')), o_orderkey)::int AS outer_fold FROM orders)
SELECT o_orderkey, outer_fold, split::int AS outer_split, ntile(4) OVER (PARTITION BY split ORDER BY md5(concat_ws('-', o_orderkey, split, 'inner')), o_orderkey)::int AS inner_fold
FROM o, range(1, 6) x(split) WHERE outer_fold <> split""")
def rs_nested(t):
    """Inner folds of the analysis rows of every outer fold."""
    outer = rs.vfold(t.orders.select("o_orderkey"), ["o_orderkey"], 5, "outer", name="outer_fold")
    inner = outer.withColumn("outer_split", F.explode(F.sequence(F.lit(1), F.lit(5)))).where(col("outer_fold") != col("outer_split"))
    d = rs.hash_positions(inner, ["o_orderkey", "outer_split"], "inner", ["outer_split"])
    return d.select("o_orderkey", "outer_fold", "outer_split", rs.ntile(col("pos"), col("total"), 4).alias("inner_fold"))


@query("rs_split_report", f"""WITH s AS (SELECT quality, CASE WHEN {rank_sql('doc_id', 'split', 'quality')} <= floor({cnt_sql('quality')} * 0.75) THEN 'train' ELSE 'test' END AS role FROM labels)
SELECT role, quality, count(*) AS n, round(count(*) / sum(count(*)) OVER () * 100, 4) AS percent, round(count(*) / sum(count(*)) OVER (PARTITION BY role), 6) AS share FROM s GROUP BY 1, 2""")
def rs_split_report(t):
    s = rs.initial_split(t.labels.select("doc_id", "quality"), ["doc_id"], strata=["quality"])
    n = share_of(s, ["role", "quality"], ["role"], "share")
    total = t.labels.count()
    return n.select("role", "quality", "n", r(col("n") / F.lit(total) * 100, 4).alias("percent"), r(col("share")).alias("share"))


@query("rs_leakage_check", f"""WITH {REG_SQL}, s AS (SELECT *, CASE WHEN {rank_sql('key', 'split')} <= floor({cnt_sql()} * 0.75) THEN 'train' ELSE 'test' END AS role FROM reg),
m AS (SELECT avg(x1) AS m, stddev_samp(x1) AS s FROM s WHERE role = 'train') SELECT role, round(avg((x1 - m) / s), 6) + 0.0 AS mean, round(stddev_samp((x1 - m) / s), 6) AS sd FROM s, m GROUP BY 1""")
def rs_leakage_check(t):
    s = rs.initial_split(t.reg, ["key"])
    st = one_row(s.where(col("role") == "train"), m=F.avg("x1"), s=F.stddev_samp("x1"))
    z = (col("x1") - st["m"]) / st["s"]
    return s.groupBy("role").agg((r(F.avg(z)) + 0.0).alias("mean"), r(F.stddev_samp(z)).alias("sd"))
