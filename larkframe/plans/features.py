"""Feature engineering: learned on the training rows, applied to all rows."""

from larkframe.learning import features as fe
from larkframe.learning.resample import initial_split
from larkframe.operators.verbs import numeric
from larkframe.plans.aggregates import guarded_corr
from larkframe.plans.base import *
from larkframe.plans.resampling import cnt_sql, rank_sql
from larkframe.plans.sqltext import fitted_sql, ols_sql
from larkframe.session import materialized
from larkframe.tables import CLS_SQL, ORDERS_NULLS_SQL, REG_NULLS_SQL, REG_SQL, u_sql

XS = ["x1", "x2", "x3"]
ROLE = f"CASE WHEN {rank_sql('key', 'split')} <= floor({cnt_sql()} * 0.75) THEN 'train' ELSE 'test' END AS role"
TRAIN_SQL = REG_SQL + f", s AS (SELECT *, {ROLE} FROM reg), tr AS (SELECT * FROM s WHERE role = 'train')"
PART_ROLE = f"CASE WHEN {rank_sql('p_partkey', 'split')} <= floor({cnt_sql()} * 0.75) THEN 'train' ELSE 'test' END AS role"
PART_SQL = f"ps AS (SELECT *, {PART_ROLE} FROM part), tr AS (SELECT * FROM ps WHERE role = 'train')"


def split(t) -> tuple[DataFrame, DataFrame]:
    """Training rows and all rows; the split is written once, because every step passes over it."""
    d = materialized(initial_split(t.reg, ["key"]))
    return d.where(col("role") == "train"), d


def part_split(t) -> tuple[DataFrame, DataFrame]:
    d = initial_split(t.part, ["p_partkey"])
    return d.where(col("role") == "train"), d


def baked(t, *steps, show=XS, digits=5) -> DataFrame:
    train, d = split(t)
    out = fe.bake(fe.prep(train, list(steps)), d)
    return out.select("key", *[r(col(c), digits).alias(c) for c in show])


def per_col(f: str, cols=XS, digits=5) -> str:
    return ", ".join(f"round({f.replace('X', c)}, {digits}) AS {c}" for c in cols)


STATS = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}, min({c}) AS a_{c}, max({c}) AS b_{c}" for c in XS)
STAT_CTE = f", st AS (SELECT {STATS} FROM tr)"


@query("fe_prep_bake", f"WITH {TRAIN_SQL}, w AS (SELECT key, role, ln(x1 + 1) AS x1, x2 FROM s), st AS (SELECT avg(x1) AS m1, stddev_samp(x1) AS s1, avg(x2) AS m2, stddev_samp(x2) AS s2 FROM w WHERE role = 'train') SELECT key, round((x1 - m1) / s1, 5) AS x1, round((x2 - m2) / s2, 5) AS x2 FROM w, st")
def fe_prep_bake(t):
    return baked(t, fe.log(["x1"], 1), fe.normalize(["x1", "x2"]), show=["x1", "x2"])


@query("fe_roles", f"WITH {REG_SQL} SELECT key, round(y, 4) AS outcome, x1, x2, x3 FROM reg")
def fe_roles(t):
    predictors = [c for c in numeric(t.reg) if c != "y"]
    return t.reg.select("key", r(col("y"), 4).alias("outcome"), *predictors)


@query("fe_model_matrix", f"WITH {REG_SQL} SELECT key, x1, x2, (cat = 'A')::int AS cat_a, (cat = 'N')::int AS cat_n, (cat = 'R')::int AS cat_r FROM reg")
def fe_model_matrix(t):
    return t.reg.select("key", "x1", "x2", *[(col("cat") == v).cast("int").alias(f"cat_{v.lower()}") for v in fe.levels_of(t.reg, "cat")])


@query("fe_normalize", f"WITH {TRAIN_SQL}{STAT_CTE} SELECT key, {per_col('(X - m_X) / s_X')} FROM s, st")
def fe_normalize(t):
    return baked(t, fe.normalize(XS))


@query("fe_center_scale", f"WITH {TRAIN_SQL}{STAT_CTE} SELECT key, round(x1 - m_x1, 5) AS x1, round(x2 / s_x2, 5) AS x2 FROM s, st")
def fe_center_scale(t):
    return baked(t, fe.center(["x1"]), fe.scale(["x2"]), show=["x1", "x2"])


@query("fe_range", f"WITH {TRAIN_SQL}{STAT_CTE} SELECT key, {per_col('greatest(0, least(1, (X - a_X) / (b_X - a_X)))')} FROM s, st")
def fe_range(t):
    return baked(t, fe.min_max(XS))


@query("fe_robust", f"WITH {TRAIN_SQL}, md AS (SELECT median(y) AS m, median(x1) AS m1 FROM tr), d AS (SELECT 1.4826::double * median(abs(y - m)) AS s, 1.4826::double * median(abs(x1 - m1)) AS s1 FROM tr, md) SELECT key, round((y - m) / s, 5) AS y, round((x1 - m1) / s1, 5) AS x1 FROM s, md, d")
def fe_robust(t):
    return baked(t, fe.robust(["y", "x1"]), show=["y", "x1"])


@query("fe_log", "SELECT o_orderkey, round(ln(o_totalprice + 1), 6) AS o_totalprice FROM orders")
def fe_log(t):
    d = fe.bake(fe.prep(t.orders, [fe.log(["o_totalprice"], 1)]), t.orders)
    return d.select("o_orderkey", r(col("o_totalprice")).alias("o_totalprice"))


@query("fe_sqrt", f"WITH {REG_SQL} SELECT key, round(sqrt(x1), 6) AS x1 FROM reg")
def fe_sqrt(t):
    return fe.bake(fe.prep(t.reg, [fe.sqrt(["x1"])]), t.reg).select("key", r(col("x1")).alias("x1"))


YJ = "CASE WHEN abs(lam) < 1e-9 THEN ln(x + 1) ELSE (pow(x + 1, lam) - 1) / lam END"
BC = "CASE WHEN abs(lam) < 1e-9 THEN ln(x) ELSE (pow(x, lam) - 1) / lam END"


def power_sql(f: str, jac: str) -> str:
    return f"""WITH {TRAIN_SQL}, v AS (SELECT role, key, x1 AS x FROM s), g AS (SELECT round(-2 + 0.1::double * i, 1) AS lam FROM range(41) p(i)),
l AS (SELECT lam, -count(*) / 2.0::double * ln(var_pop({f})) + (lam - 1) * sum({jac}) AS ll FROM v, g WHERE role = 'train' GROUP BY lam),
b AS (SELECT arg_max(lam, ll) AS lam FROM l) SELECT key, lam, round({f}, 5) AS x1 FROM v, b"""


def powered(t, kind: str) -> DataFrame:
    train, d = split(t)
    lam = fe.best_lambda(train, "x1", kind)
    fn = fe.yeo_johnson if kind == "yeo_johnson" else fe.box_cox
    return d.select("key", F.lit(lam).alias("lam"), r(fn(col("x1"), lam), 5).alias("x1"))


@query("fe_yeojohnson", power_sql(YJ, "ln(x + 1)"))
def fe_yeojohnson(t):
    return powered(t, "yeo_johnson")


@query("fe_boxcox", power_sql(BC, "ln(x)"))
def fe_boxcox(t):
    return powered(t, "box_cox")


SK = "avg(pow(X - (SELECT avg(X) FROM w), 3)) / pow(avg(pow(X - (SELECT avg(X) FROM w), 2)), 1.5::double)"


@query("fe_skew_compare", f"WITH {REG_SQL}, w AS (SELECT y + 20 AS raw, ln(y + 20) AS log, sqrt(y + 20) AS root FROM reg) " + " UNION ALL ".join(f"SELECT '{m}' AS method, round({SK.replace('X', m)}, 5) AS skew FROM w" for m in ("raw", "log", "root")))
def fe_skew_compare(t):
    x = col("y") + 20
    d = t.reg.select(x.alias("raw"), F.ln(x).alias("log"), F.sqrt(x).alias("root"))
    return d.agg(*[r(F.skewness(m), 5).alias(m) for m in d.columns]).unpivot([], d.columns, "method", "skew")


@query("fe_dummy", "SELECT o_orderkey, (o_orderstatus = 'O')::int AS \"o_orderstatus_O\", (o_orderstatus = 'P')::int AS \"o_orderstatus_P\" FROM orders")
def fe_dummy(t):
    d = fe.bake(fe.prep(t.orders, [fe.dummy("o_orderstatus")]), t.orders)
    return d.select("o_orderkey", "o_orderstatus_O", "o_orderstatus_P")


@query("fe_other", f"WITH {PART_SQL}, k AS (SELECT p_brand FROM tr GROUP BY 1 HAVING count(*) >= 0.04 * (SELECT count(*) FROM tr)) SELECT p_partkey, CASE WHEN k.p_brand IS NULL THEN 'other' ELSE ps.p_brand END AS p_brand FROM ps LEFT JOIN k ON ps.p_brand = k.p_brand")
def fe_other(t):
    train, d = part_split(t)
    return fe.bake(fe.prep(train, [fe.other("p_brand", 0.04)]), d).select("p_partkey", "p_brand")


@query("fe_novel", "SELECT p_partkey, CASE WHEN p_brand IN (SELECT p_brand FROM part WHERE p_size <= 25 AND p_retailprice < 905) THEN p_brand ELSE 'new' END AS p_brand FROM part")
def fe_novel(t):
    train = t.part.where((col("p_size") <= 25) & (col("p_retailprice") < 905))
    return fe.bake(fe.prep(train, [fe.novel("p_brand")]), t.part).select("p_partkey", "p_brand")


@query("fe_unknown", f"WITH {ORDERS_NULLS_SQL} SELECT o_orderkey, coalesce(o_orderpriority, 'unknown') AS o_orderpriority FROM orders_nulls")
def fe_unknown(t):
    d = t.orders_nulls
    return fe.bake(fe.prep(d, [fe.unknown("o_orderpriority")]), d).select("o_orderkey", "o_orderpriority")


@query("fe_freq_encode", f"WITH {PART_SQL}, f AS (SELECT p_brand, count(*) AS freq FROM tr GROUP BY 1) SELECT p_partkey, coalesce(freq, 0) AS freq FROM ps LEFT JOIN f USING (p_brand)")
def fe_freq_encode(t):
    train, d = part_split(t)
    return fe.bake(fe.prep(train, [fe.frequency("p_brand", "freq")]), d).select("p_partkey", "freq")


def target_sql(k: int) -> str:
    return f"""WITH {PART_SQL}, g AS (SELECT avg(p_retailprice) AS g FROM tr), f AS (SELECT p_brand, (sum(p_retailprice) + max(g) * {k}) / (count(*) + {k}) AS enc FROM tr, g GROUP BY 1)
SELECT p_partkey, round(coalesce(enc, g), 5) AS enc FROM ps LEFT JOIN f USING (p_brand), g"""


def target(t, k: float) -> DataFrame:
    train, d = part_split(t)
    return fe.bake(fe.prep(train, [fe.target_mean("p_brand", "p_retailprice", "enc", k)]), d).select("p_partkey", r(col("enc"), 5).alias("enc"))


@query("fe_target_encode", target_sql(0))
def fe_target_encode(t):
    return target(t, 0)


@query("fe_target_smooth", target_sql(10))
def fe_target_smooth(t):
    return target(t, 10)


@query("fe_embed_pca")
def fe_embed_pca(t):
    """Dense vectors of a category: components of its indicator columns."""
    train, d = part_split(t)
    names = [f"p_type_{v}" for v in fe.levels_of(train, "p_type")[1:]]
    as_double = fe.stateless(lambda df: df.withColumns({c: col(c).cast("double") for c in names}))
    out = fe.bake(fe.prep(train, [fe.dummy("p_type"), as_double, fe.pca(names, 2, "TC")]), d)
    return out.select("p_partkey", r(F.abs("TC1"), 5).alias("tc1"), r(F.abs("TC2"), 5).alias("tc2"))


@query("fe_interact", f"WITH {REG_SQL} SELECT key, x1 * x2 AS x1_x_x2, x1 * (cat = 'N')::int AS \"x1_x_cat_N\", x1 * (cat = 'R')::int AS \"x1_x_cat_R\" FROM reg")
def fe_interact(t):
    steps = [fe.interact("x1", "x2"), fe.dummy("cat"), fe.interact("x1", "cat_N"), fe.interact("x1", "cat_R")]
    return fe.bake(fe.prep(t.reg, steps), t.reg).select("key", "x1_x_x2", "x1_x_cat_N", "x1_x_cat_R")


@query("fe_poly", f"""WITH {TRAIN_SQL}, m AS (SELECT avg(x1) AS m FROM tr), c AS (SELECT x1 - m AS c, pow(x1 - m, 2) AS c2 FROM tr, m), o AS (SELECT regr_slope(c2, c) AS a, avg(c2) AS b, sum(c * c) AS s2 FROM c), q AS (SELECT sum(pow(c2 - a * c - b, 2)) AS s4 FROM c, o)
SELECT key, round((x1 - m) / sqrt(s2) * 1000, 5) AS p1, round((pow(x1 - m, 2) - a * (x1 - m) - b) / sqrt(s4) * 1000, 5) AS p2 FROM s, m, o, q""")
def fe_poly(t):
    train, d = split(t)
    return fe.bake(fe.prep(train, [fe.poly2("x1")]), d).select("key", r(col("x1_poly_1") * 1000, 5).alias("p1"), r(col("x1_poly_2") * 1000, 5).alias("p2"))


def _spline_sql() -> str:
    cube = lambda k: f"pow(greatest(x1 - k{k}, 0) / (k5 - k0), 3)"
    d = lambda k: f"(({cube(k)} - {cube(5)}) * (k5 - k0) / (k5 - k{k}))"
    cols = "round(x1 / (k5 - k0), 5) AS x1_ns_1, " + ", ".join(f"round({d(k)} - {d(4)}, 5) AS x1_ns_{k + 2}" for k in range(4))
    return f"WITH {TRAIN_SQL}, q AS (SELECT " + ", ".join(f"quantile_cont(x1, {i / 5}) AS k{i}" for i in range(6)) + f" FROM tr) SELECT key, {cols} FROM s, q"


@query("fe_spline", _spline_sql())
def fe_spline(t):
    return baked(t, fe.natural_spline("x1"), show=[f"x1_ns_{i}" for i in range(1, 6)])


@query("fe_mutate", f"WITH {REG_SQL} SELECT key, round(x1 / (x2 + 1), 6) AS ratio, (x3 > 4)::int AS taxed, 2005 - year(ship)::int AS age FROM reg")
def fe_mutate(t):
    step = fe.mutate(ratio=lambda: col("x1") / (col("x2") + 1), taxed=lambda: (col("x3") > 4).cast("int"), age=lambda: 2005 - F.year("ship"))
    return fe.bake(fe.prep(t.reg, [step]), t.reg).select("key", r(col("ratio")).alias("ratio"), "taxed", "age")


@query("fe_rm", f"WITH {REG_SQL} SELECT key, x1, x2, round(y, 4) AS y FROM reg")
def fe_rm(t):
    d = fe.bake(fe.prep(t.reg, [fe.remove("ship", "cat", "x3")]), t.reg)
    return d.withColumn("y", r(col("y"), 4))


@query("fe_zv_nzv", f"WITH {REG_SQL} SELECT key, x1, x2 FROM reg")
def fe_zv_nzv(t):
    rare = (col("key").substr(1, 3) == "123").cast("double")
    d = t.reg.select("key", "x1", "x2", F.lit(1.0).alias("constant"), rare.alias("rare"))
    return fe.bake(fe.prep(d, [fe.drop_nzv(["x1", "x2", "constant", "rare"])]), d)


@query("fe_corr_filter", f"WITH {REG_SQL} SELECT key, x1, x2, x3 FROM reg")
def fe_corr_filter(t):
    d = t.reg.select("key", *XS, (col("x1") * 3 + col("x3") * 0.1).alias("twin"), (col("x1") + col("x2") * 0.01).alias("copy"))
    kept = fe.bake(fe.prep(d, [fe.drop_correlated([*XS, "twin", "copy"], 0.9)]), d)
    # one of the three near copies stays; it is shown as x1
    left = [c for c in ("x1", "twin", "copy") if c in kept.columns]
    if len(left) != 1:
        raise RuntimeError(f"correlated columns left: {left}")
    return kept.join(d.select("key", col("x1").alias("_x1")), "key").select("key", col("_x1").alias("x1"), "x2", "x3")


@query("fe_corr_target", f"WITH {REG_SQL} " + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr({c}, y), 6) AS c FROM reg" for c in XS))
def fe_corr_target(t):
    d = t.reg.agg(*[r(guarded_corr(c, "y")).alias(c) for c in XS]).unpivot([], XS, "feature", "c")
    return d.orderBy(F.abs("c").desc())


NULL_TRAIN = REG_NULLS_SQL + f", s AS (SELECT *, {ROLE} FROM reg_nulls), tr AS (SELECT * FROM s WHERE role = 'train')"


def null_split(t):
    d = materialized(initial_split(t.reg_nulls, ["key"]))
    return d.where(col("role") == "train"), d


def imputed(t, *steps) -> DataFrame:
    train, d = null_split(t)
    return fe.bake(fe.prep(train, list(steps)), d)


def shown(d: DataFrame) -> DataFrame:
    return d.select("key", *[r(col(c), 5).alias(c) for c in XS])


@query("fe_impute_mean", f"WITH {NULL_TRAIN}, m AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3 FROM tr) SELECT key, round(coalesce(x1, m1), 5) AS x1, round(coalesce(x2, m2), 5) AS x2, round(coalesce(x3, m3), 5) AS x3 FROM s, m")
def fe_impute_mean(t):
    return shown(imputed(t, fe.impute_mean(XS)))


@query("fe_impute_median", f"WITH {NULL_TRAIN}, m AS (SELECT median(x1) AS m1, median(x2) AS m2, median(x3) AS m3 FROM tr) SELECT key, round(coalesce(x1, m1), 5) AS x1, round(coalesce(x2, m2), 5) AS x2, round(coalesce(x3, m3), 5) AS x3 FROM s, m")
def fe_impute_median(t):
    return shown(imputed(t, fe.impute_median(XS)))


@query("fe_impute_mode", f"WITH {ORDERS_NULLS_SQL}, m AS (SELECT o_orderpriority AS p FROM orders_nulls WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) SELECT o_orderkey, coalesce(o_orderpriority, p) AS o_orderpriority FROM orders_nulls, m")
def fe_impute_mode(t):
    d = t.orders_nulls
    return fe.bake(fe.prep(d, [fe.impute_mode("o_orderpriority")]), d).select("o_orderkey", "o_orderpriority")


@query("fe_impute_knn")
def fe_impute_knn(t):
    return imputed(t, fe.impute_knn("key", "x1", ["y", "t2", "t3"])).select("key", r(col("x1"), 5).alias("x1"))


@query("fe_impute_linear", f"WITH {NULL_TRAIN}, cc AS (SELECT * FROM tr WHERE x1 IS NOT NULL), {ols_sql('cc', 'x1', ['t2', 't3', 'y'])} SELECT key, round(coalesce(x1, {fitted_sql(['t2', 't3', 'y'])}), 4) AS x1 FROM s, ols")
def fe_impute_linear(t):
    return imputed(t, fe.impute_linear("x1", ["t2", "t3", "y"])).select("key", r(col("x1"), 4).alias("x1"))


@query("fe_naomit", f"WITH {REG_NULLS_SQL} SELECT key, x1, x2, x3 FROM reg_nulls WHERE x1 IS NOT NULL AND x2 IS NOT NULL AND x3 IS NOT NULL")
def fe_naomit(t):
    return t.reg_nulls.dropna(subset=XS).select("key", *XS)


@query("fe_missing_masks", f"WITH {REG_NULLS_SQL} SELECT key, (x1 IS NULL)::int AS mcar, (x2 IS NULL)::int AS mar, (x3 IS NULL)::int AS mnar FROM reg_nulls")
def fe_missing_masks(t):
    return t.reg_nulls.select("key", *[col(c).isNull().cast("int").alias(n) for c, n in (("x1", "mcar"), ("x2", "mar"), ("x3", "mnar"))])


@query("fe_impute_compare", f"""WITH {NULL_TRAIN}, m AS (SELECT avg(x1) AS a1, avg(x2) AS a2, avg(x3) AS a3, median(x1) AS d1, median(x2) AS d2, median(x3) AS d3 FROM tr) """ + " UNION ALL ".join(
    f"SELECT '{n}' AS method, 'x{i}' AS variable, round(avg(abs({v}{i} - t{i})), 6) AS err, count(*) AS n FROM s, m WHERE x{i} IS NULL" for n, v in (("mean", "a"), ("median", "d")) for i in (1, 2, 3)))
def fe_impute_compare(t):
    train, d = null_split(t)
    gaps = d.select("key", *[col(c).isNull().alias(f"gap_{c}") for c in XS])
    out = None
    for name, step in (("mean", fe.impute_mean(XS)), ("median", fe.impute_median(XS))):
        f = fe.bake(fe.prep(train, [step]), d).join(gaps, "key")
        rows = F.array(*[F.struct(F.lit(c).alias("variable"), F.when(col(f"gap_{c}"), F.abs(col(c) - col(f"t{c[1]}"))).alias("e")) for c in XS])
        e = f.select(F.inline(rows)).groupBy("variable").agg(r(F.avg("e")).alias("err"), F.count("e").alias("n")).withColumn("method", F.lit(name))
        out = e if out is None else out.unionByName(e)
    return out


@query("fe_pca")
def fe_pca(t):
    """Variance share per component of the embeddings, with the cumulative share."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    d = t.embeddings.select(array_to_vector("embedding").alias("v"))
    share = PCA(k=10, inputCol="v", outputCol="pc").fit(d).explainedVariance.toArray()
    rows = [(i + 1, round(float(s), 6), round(float(share[: i + 1].sum()), 6)) for i, s in enumerate(share)]
    return t.spark.createDataFrame(rows, "component int, share double, cumulative double")


O = "o_orderdate"


@query("fe_time_parts", f"SELECT o_orderkey, year({O})::int AS y, month({O})::int AS m, dayofweek({O})::int + 1 AS dow, dayofyear({O})::int AS doy, ((dayofyear({O}) - 1) // 7 + 1)::int AS wk, quarter({O})::int AS q FROM orders")
def fe_time_parts(t):
    from larkframe.functions.dates import week

    return t.orders.select("o_orderkey", F.year(O).alias("y"), F.month(O).alias("m"), F.dayofweek(O).alias("dow"), F.dayofyear(O).alias("doy"), week(col(O)).alias("wk"), F.quarter(O).alias("q"))


@query("fe_time_cyclic", f"SELECT o_orderkey, round(sin(2 * pi() * dayofyear({O}) / 365.25::double), 6) AS s, round(cos(2 * pi() * dayofyear({O}) / 365.25::double), 6) AS c FROM orders")
def fe_time_cyclic(t):
    a = 2 * F.pi() * F.dayofyear(O) / 365.25
    return t.orders.select("o_orderkey", r(F.sin(a)).alias("s"), r(F.cos(a)).alias("c"))


@query("fe_time_flags", f"SELECT o_orderkey, (dayofweek({O}) IN (0, 6))::int AS weekend, (day({O}) = 1)::int AS first, ({O}::date = last_day({O}))::int AS last FROM orders")
def fe_time_flags(t):
    return t.orders.select("o_orderkey", F.dayofweek(O).isin(1, 7).cast("int").alias("weekend"), (F.dayofmonth(O) == 1).cast("int").alias("first"),
                           (F.to_date(O) == F.last_day(O)).cast("int").alias("last"))


TOK_SQL = r"""tk AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}'']+') AS w FROM documents)"""
STOP_SQL = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in fe.STOP_WORDS) + ")"
LONG_SQL = TOK_SQL + ", lt AS (SELECT doc_id, unnest(w) AS term FROM tk)"


def words(t) -> DataFrame:
    return t.documents.select("doc_id", fe.tokens(col("text")).alias("w"))


@query("fe_tokenize", f"WITH {TOK_SQL} SELECT doc_id, len(w)::int AS n, md5(array_to_string(w, ' ')) AS h FROM tk")
def fe_tokenize(t):
    return words(t).select("doc_id", F.size("w").alias("n"), F.md5(F.array_join("w", " ")).alias("h"))


@query("fe_stopwords", f"WITH {TOK_SQL}, f AS (SELECT doc_id, list_filter(w, lambda x: x NOT IN {STOP_SQL}) AS w FROM tk) SELECT doc_id, len(w)::int AS n, md5(array_to_string(w, ' ')) AS h FROM f")
def fe_stopwords(t):
    d = words(t).withColumn("w", fe.without_stop_words(col("w")))
    return d.select("doc_id", F.size("w").alias("n"), F.md5(F.array_join("w", " ")).alias("h"))


@query("fe_ngram", f"WITH {TOK_SQL}, b AS (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || '_' || w[i + 1])) AS gram FROM tk) SELECT gram, count(*) AS n FROM b GROUP BY 1")
def fe_ngram(t):
    return words(t).select(F.explode(fe.bigrams(col("w"))).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


@query("fe_tf_binary", f"WITH {LONG_SQL} SELECT DISTINCT doc_id, term, 1 AS present FROM lt")
def fe_tf_binary(t):
    return fe.term_counts(words(t), "doc_id", col("w")).select("doc_id", "term", F.lit(1).alias("present"))


@query("fe_tfidf", f"""WITH {LONG_SQL}, c AS (SELECT doc_id, term, count(*) AS tf FROM lt GROUP BY 1, 2), x AS (SELECT *, sum(tf) OVER (PARTITION BY doc_id) AS len, count(*) OVER (PARTITION BY term) AS df FROM c)
SELECT doc_id, term, tf, round(tf / len * ln(1 + (SELECT count(*) FROM documents) / df), 6) AS tfidf FROM x""")
def fe_tfidf(t):
    d = fe.tf_idf(words(t), "doc_id", col("w"), t.documents.count())
    return d.select("doc_id", "term", "tf", r(col("tfidf")).alias("tfidf"))


@query("fe_tokenfilter", f"""WITH {LONG_SQL}, v AS (SELECT term FROM lt GROUP BY 1 ORDER BY count(*) DESC, term LIMIT 100) SELECT doc_id, term, count(*) AS tf FROM lt JOIN v USING (term) GROUP BY 1, 2""")
def fe_tokenfilter(t):
    d = words(t)
    top = d.select(F.explode("w").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("k")).orderBy(col("k").desc(), "term").limit(100)
    best = [row.term for row in top.collect()]  # 100 terms; the others are dropped before the count by document
    kept = d.select("doc_id", F.filter("w", lambda x: x.isin(best)).alias("w"))
    return fe.term_counts(kept, "doc_id", col("w"))


FX = ["f1", "f2", "f3", "f4"]
SMOTE_SQL = f"""WITH {CLS_SQL}, nn AS (SELECT count(*) FILTER (quality = 1) - count(*) FILTER (quality = 0) AS need, count(*) FILTER (quality = 0) AS few FROM cls),
sd AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in FX)} FROM cls), f AS (SELECT doc_id, {', '.join(FX)}, {', '.join(f'({c} - m_{c}) / s_{c} AS z_{c}' for c in FX)} FROM cls, sd WHERE quality = 0),
kn AS (SELECT a.doc_id, b.doc_id AS nid, row_number() OVER (PARTITION BY a.doc_id ORDER BY sqrt({' + '.join(f'(a.z_{c} - b.z_{c}) * (a.z_{c} - b.z_{c})' for c in FX)}), b.doc_id) AS place FROM f a JOIN f b ON a.doc_id <> b.doc_id),
p AS (SELECT doc_id, row_number() OVER (ORDER BY md5(concat_ws('-', doc_id, 'smote')), doc_id) AS pos FROM f),
cp AS (SELECT doc_id, unnest(range(1, need // few + (pos <= need % few)::int + 1)) AS copy FROM p, nn),
d AS (SELECT doc_id, copy, floor({u_sql('doc_id, copy', 'smote-n')} * 5)::int + 1 AS place, {u_sql('doc_id, copy', 'smote-w')} AS w FROM cp)
SELECT d.doc_id, copy, 0 AS quality, {', '.join(f'round(a.{c} + w * (b.{c} - a.{c}), 5) AS {c}' for c in FX)} FROM d JOIN kn USING (doc_id, place) JOIN f a ON a.doc_id = d.doc_id JOIN f b ON b.doc_id = kn.nid"""


@query("fe_smote", SMOTE_SQL)
def fe_smote(t):
    d = fe.smote(t.cls, "doc_id", "quality", 0, FX)
    return d.select("doc_id", "copy", "quality", *[r(col(c), 5).alias(c) for c in FX])


@query("fe_upsample", """WITH n AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(concat_ws('-', doc_id, 'up')), doc_id) AS pos, count(*) OVER (PARTITION BY quality) AS k FROM labels), m AS (SELECT max(k) AS top FROM n)
SELECT doc_id, quality, unnest(range(1, top // k + (pos <= top % k)::int + 1)) AS copy FROM n, m""")
def fe_upsample(t):
    return fe.upsample(t.labels, "doc_id", "quality").select("doc_id", "quality", "copy")


@query("fe_downsample", """WITH n AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(concat_ws('-', doc_id, 'down')), doc_id) AS pos, count(*) OVER (PARTITION BY quality) AS k FROM labels)
SELECT doc_id, quality FROM n WHERE pos <= (SELECT min(k) FROM n)""")
def fe_downsample(t):
    return fe.downsample(t.labels, "doc_id", "quality").select("doc_id", "quality")


@query("fe_rose")
def fe_rose(t):
    d = fe.rose(t.cls, "doc_id", "quality", FX)
    return d.select("quality", "draw", *[r(col(c), 5).alias(c) for c in FX])


@query("fe_class_weights", "SELECT doc_id, quality, round((SELECT count(*) FROM labels) / 2 / count(*) OVER (PARTITION BY quality), 6) AS weight FROM labels")
def fe_class_weights(t):
    return fe.class_weights(t.labels, "quality").select("doc_id", "quality", r(col("weight")).alias("weight"))


@query("fe_credit_recipe")
def fe_credit_recipe(t):
    """Classification chain: impute, ratios, transform, indicators, near-zero variance, scale, correlation filter, smote."""
    d = t.cls.withColumn("f4", F.when(uniform_gap("doc_id") >= 0.1, col("f4"))).select("doc_id", "quality", "lang", *FX)
    train = materialized(initial_split(d, ["doc_id"], strata=["quality"]).where(col("role") == "train").drop("role"))
    nums = FX + ["per_word"]
    steps = [fe.impute_median(["f4"]), fe.mutate(per_word=lambda: F.try_divide(F.exp("f1"), col("f4") + 1)), fe.power(["f1", "f4", "per_word"]),
             fe.dummy("lang"), fe.drop_nzv(nums), fe.normalize(nums), fe.drop_correlated(nums, 0.95)]
    out = fe.bake(fe.prep(train, steps), train)
    left = [c for c in nums if c in out.columns]
    more = fe.smote(out, "doc_id", "quality", 0, left)
    both = out.select("doc_id", "quality", F.lit(0).cast("long").alias("copy"), *left).unionByName(more.select("doc_id", "quality", "copy", *left))
    return both.select("doc_id", "quality", "copy", *[r(col(c), 4).alias(c) for c in left])


def uniform_gap(key: str) -> Column:
    from larkframe.operators.hashing import uniform

    return uniform([key], "gap")


@query("fe_house_recipe")
def fe_house_recipe(t):
    """Regression chain: log outcome, derived columns, removal, impute, lump, power, interaction, indicators, scale, variance filter."""
    d = t.reg_nulls.select("key", "cat", "y", *XS)
    train = materialized(initial_split(d, ["key"]).where(col("role") == "train").drop("role"))
    steps = [fe.log(["y"], 20), fe.mutate(per=lambda: col("x1") / (col("x2") + 1)), fe.impute_median(["x1", "x2", "x3", "per"]), fe.other("cat", 0.3),
             fe.power(["x1", "per"]), fe.interact("x1", "x2"), fe.dummy("cat", ["A", "N", "R", "other"]), fe.normalize(["x1", "x2", "x3", "per", "x1_x_x2"]), fe.drop_nzv(["x1", "x2", "x3", "per", "x1_x_x2"])]
    out = fe.bake(fe.prep(train, steps), d)
    return out.select("key", *[r(col(c).cast("double"), 4).alias(c) for c in out.columns if c != "key"])
