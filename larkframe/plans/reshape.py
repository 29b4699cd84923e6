"""Long and wide forms, splitting and uniting columns, completed tables, nested rows, per-group fits."""

from larkframe.operators import reshape as rs
from larkframe.operators.ordering import positions
from larkframe.plans.base import *
from larkframe.plans.windows import FULL_SQL, full_days
from larkframe.tables import DAILY_SQL, REG_SQL

Q_SQL = "q AS (SELECT year(l_shipdate) AS y, " + ", ".join(
    f"round(coalesce(sum(l_extendedprice) FILTER (quarter(l_shipdate) = {i}), 0), 2) AS revenue_q{i}, round(coalesce(sum(l_quantity) FILTER (quarter(l_shipdate) = {i}), 0), 2) AS qty_q{i}"
    for i in range(1, 5)) + " FROM lineitem GROUP BY 1)"


def quarters(t) -> DataFrame:
    """Per year: revenue_q1..q4 and qty_q1..q4."""
    d = t.lineitem.select(F.year("l_shipdate").alias("y"), F.quarter("l_shipdate").alias("q"), "l_extendedprice", "l_quantity")
    d = d.groupBy("y").pivot("q", [1, 2, 3, 4]).agg(r(F.sum("l_extendedprice"), 2).alias("revenue"), r(F.sum("l_quantity"), 2).alias("qty")).fillna(0.0)
    return d.withColumnsRenamed({f"{i}_{m}": f"{m}_q{i}" for i in range(1, 5) for m in ("revenue", "qty")})


@query("longer_basic", "SELECT p_partkey, 'size' AS name, p_size::double AS value FROM part UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part")
def longer_basic(t):
    d = t.part.select("p_partkey", col("p_size").cast("double").alias("size"), col("p_retailprice").alias("price"))
    return rs.longer(d, ["p_partkey"], ["size", "price"], "name", "value")


@query("longer_pattern", """SELECT p_partkey, 'size' AS subject, p_size::double AS score FROM part UNION ALL SELECT p_partkey, 'retail', p_retailprice FROM part""")
def longer_pattern(t):
    d = t.part.select("p_partkey", col("p_size").cast("double").alias("size_score"), col("p_retailprice").alias("retail_score"))
    return rs.longer(d, ["p_partkey"], ["size_score", "retail_score"], "name", "score").select(
        "p_partkey", F.regexp_extract("name", "^(.*)_score$", 1).alias("subject"), "score")


@query("longer_value", f"WITH {Q_SQL} " + " UNION ALL ".join(f"SELECT y, 'q{i}' AS quarter, revenue_q{i} AS revenue, qty_q{i} AS qty FROM q" for i in range(1, 5)))
def longer_value(t):
    return rs.longer_values(quarters(t), ["y"], {f"q{i}": {"revenue": f"revenue_q{i}", "qty": f"qty_q{i}"} for i in range(1, 5)}, "quarter").withColumn("y", col("y").cast("long"))


@query("longer_prefix", f"WITH {Q_SQL} " + " UNION ALL ".join(f"SELECT y, {i} AS quarter, revenue_q{i} AS revenue FROM q" for i in range(1, 5)))
def longer_prefix(t):
    d = rs.longer(quarters(t), ["y"], [f"revenue_q{i}" for i in range(1, 5)], "quarter", "revenue")
    return d.withColumn("quarter", F.regexp_replace("quarter", "^revenue_q", "").cast("int"))


@query("longer_sep_lookahead", "\nUNION ALL ".join(f"SELECT c_mktsegment, '{c}' AS variable, '{n}' AS stat, round({f}({c}), 4) AS value FROM customer GROUP BY 1"
       for c in ("c_acctbal", "c_nationkey") for n, f in (("mean", "avg"), ("sd", "stddev_samp"))))
def longer_sep_lookahead(t):
    fns = {"mean": F.avg, "sd": F.stddev_samp}
    names = {f"{c}_{n}": f(c) for c in ("c_acctbal", "c_nationkey") for n, f in fns.items()}
    wide = t.customer.groupBy("c_mktsegment").agg(*[r(a, 4).alias(n) for n, a in names.items()])
    long = rs.longer(wide, ["c_mktsegment"], list(names), "name", "value")
    part = lambda i: F.regexp_extract("name", "^(.*)_(mean|sd)$", i)
    return long.select("c_mktsegment", part(1).alias("variable"), part(2).alias("stat"), "value")


STATUS = ["F", "O", "P"]


@query("wider_basic", """SELECT o_custkey, min(o_totalprice) FILTER (o_orderstatus = 'F') AS "F", min(o_totalprice) FILTER (o_orderstatus = 'O') AS "O",
min(o_totalprice) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def wider_basic(t):
    return rs.wider(t.orders, ["o_custkey"], "o_orderstatus", STATUS, [F.min("o_totalprice")])


@query("wider_prefix", """SELECT o_orderpriority, """ + ", ".join(f"round(sum(o_totalprice) FILTER (year(o_orderdate) = {y}), 2) AS total_{y}" for y in range(1995, 2002)) + " FROM orders GROUP BY 1")
def wider_prefix(t):
    d = t.orders.withColumn("y", F.year("o_orderdate"))
    return rs.wider(d, ["o_orderpriority"], "y", list(range(1995, 2002)), [r(F.sum("o_totalprice"), 2)], lambda c: f"total_{c}")


@query("wider_multi", """SELECT l_shipdate::date::varchar AS d, """ + ", ".join(f"count(*) FILTER (l_returnflag = '{f}') AS {f}_n, round(sum(l_quantity) FILTER (l_returnflag = '{f}'), 2) AS {f}_qty" for f in "ANR") + " FROM lineitem GROUP BY 1")
def wider_multi(t):
    d = t.lineitem.withColumn("d", F.to_date("l_shipdate").cast("string"))
    w = rs.wider(d, ["d"], "l_returnflag", ["A", "N", "R"], [F.count(F.lit(1)).alias("n"), r(F.sum("l_quantity"), 2).alias("qty")])
    return w.fillna(0, subset=[f"{f}_n" for f in "ANR"])


@query("longer_then_wider", """SELECT p_partkey, p_size::double AS size, p_retailprice AS price, split_part(p_name, ' ', 1) AS adjective FROM part""")
def longer_then_wider(t):
    d = t.part.select("p_partkey", F.split("p_name", " ")[0].alias("adjective"), col("p_size").cast("double").alias("x_size"), col("p_retailprice").alias("x_price"))
    long = rs.longer(d, ["p_partkey", "adjective"], ["x_size", "x_price"], "name", "value").withColumn("name", F.regexp_replace("name", "^x_", ""))
    return rs.wider(long, ["p_partkey", "adjective"], "name", ["size", "price"], [F.first("value")])


@query("separate", "SELECT c_custkey, split_part(c_name, '#', 1) AS kind, try_cast(split_part(c_name, '#', 2) AS bigint) AS num, NULL::varchar AS rest FROM customer")
def separate(t):
    p = F.split("c_name", "#")
    return t.customer.select("c_custkey", F.get(p, F.lit(0)).alias("kind"), F.get(p, F.lit(1)).try_cast("bigint").alias("num"), F.get(p, F.lit(2)).alias("rest"))


@query("separate_keep", "SELECT o_orderkey, o_orderpriority, try_cast(split_part(o_orderpriority, '-', 1) AS int) AS level, split_part(o_orderpriority, '-', 2) AS word FROM orders")
def separate_keep(t):
    p = F.split("o_orderpriority", "-")
    return t.orders.select("o_orderkey", "o_orderpriority", F.get(p, F.lit(0)).try_cast("int").alias("level"), F.get(p, F.lit(1)).alias("word"))


@query("separate_rows", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def separate_rows(t):
    return t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@query("separate_kv", """SELECT event_id, 'type' AS k, event_type AS v FROM events UNION ALL SELECT event_id, 'user', user_id::varchar FROM events""")
def separate_kv(t):
    d = t.events.select("event_id", F.concat(F.lit("type:"), "event_type", F.lit(";user:"), col("user_id").cast("string")).alias("x"))
    d = d.select("event_id", F.explode(F.split("x", ";")).alias("kv"))
    p = F.split("kv", ":")
    return d.select("event_id", F.get(p, F.lit(0)).alias("k"), F.get(p, F.lit(1)).alias("v"))


@query("unite", "SELECT c_custkey, concat_ws('_', c_mktsegment, c_nationkey) AS code, concat_ws('/', c_name, coalesce(nullif(c_mktsegment, 'BUILDING'), 'NA')) AS path FROM customer")
def unite(t):
    seg = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return t.customer.select("c_custkey", F.concat_ws("_", "c_mktsegment", col("c_nationkey").cast("string")).alias("code"),
                             F.concat_ws("/", "c_name", F.coalesce(seg, F.lit("NA"))).alias("path"))


PER = "per AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)"


def per_priority(t):
    return t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("complete", f"WITH {PER} SELECT o_custkey, o_orderpriority, n FROM (SELECT * FROM (SELECT DISTINCT o_custkey FROM orders), (SELECT DISTINCT o_orderpriority FROM orders)) LEFT JOIN per USING (o_custkey, o_orderpriority)")
def complete(t):
    return rs.complete(per_priority(t), ["o_custkey", "o_orderpriority"])


@query("complete_fill", f"WITH {PER} SELECT o_custkey, o_orderpriority, coalesce(n, 0) AS n FROM (SELECT * FROM (SELECT DISTINCT o_custkey FROM orders), (SELECT DISTINCT o_orderpriority FROM orders)) LEFT JOIN per USING (o_custkey, o_orderpriority)")
def complete_fill(t):
    return rs.complete(per_priority(t), ["o_custkey", "o_orderpriority"], {"n": 0})


@query("complete_dates", f"WITH {FULL_SQL} SELECT cast(d AS varchar) AS d, coalesce(n, 0) AS n FROM full_days")
def complete_dates(t):
    return full_days(t).select(col("d").cast("string").alias("d"), F.coalesce("n", F.lit(0)).alias("n"))


@query("nest", """WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders)
SELECT o_custkey, (i // 1000)::bigint AS part_no, count(*)::int AS n, string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS keys, round(sum(o_totalprice), 2) AS total FROM n GROUP BY 1, 2""")
def nest(t):
    d = rs.pack(t.orders, ["o_custkey"], ["o_orderkey"], F.struct("o_orderkey", "o_totalprice"), "data")
    return d.select("o_custkey", "part_no", F.size("data").alias("n"), F.array_join(F.transform("data", lambda s: s["o_orderkey"].cast("string")), ",").alias("keys"),
                    r(F.aggregate("data", F.lit(0.0), lambda a, s: a + s["o_totalprice"]), 2).alias("total"))


@query("nest_multi", """WITH n AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) - 1 AS i FROM part)
SELECT p_type, (i // 1000)::bigint AS part_no, string_agg(p_size, ',' ORDER BY p_partkey) AS sizes, string_agg(p_brand, ',' ORDER BY p_partkey) AS brands FROM n GROUP BY 1, 2""")
def nest_multi(t):
    item = F.struct(F.struct("p_size").alias("a"), F.struct("p_brand").alias("b"))
    d = rs.pack(t.part, ["p_type"], ["p_partkey"], item, "data")
    return d.select("p_type", "part_no", F.array_join(F.transform("data", lambda s: s["a"]["p_size"].cast("string")), ",").alias("sizes"),
                    F.array_join(F.transform("data", lambda s: s["b"]["p_brand"]), ",").alias("brands"))


@query("unnest", "SELECT o_custkey, o_orderkey AS data_o_orderkey, o_totalprice AS data_o_totalprice FROM orders")
def unnest(t):
    d = rs.pack(t.orders, ["o_custkey"], ["o_orderkey"], F.struct("o_orderkey", "o_totalprice"), "data")
    rows = d.select("o_custkey", F.inline("data"))
    return rows.withColumnsRenamed({c: f"data_{c}" for c in rows.columns[1:]})


@query("unnest_wider", "SELECT p_partkey, p_size AS size, p_retailprice AS price FROM part")
def unnest_wider(t):
    s = F.struct(col("p_size").alias("size"), col("p_retailprice").alias("price"))
    return t.part.select("p_partkey", s.alias("s")).select("p_partkey", "s.*")


@query("unnest_index", "SELECT vec_id, unnest(range(1, len(embedding) + 1))::int AS i, round(unnest(embedding)::double, 6) AS x FROM embeddings")
def unnest_index(t):
    d = t.embeddings.select("vec_id", F.posexplode("embedding").alias("i", "x"))
    return d.select("vec_id", (col("i") + 1).alias("i"), r(col("x").cast("double")).alias("x"))


@query("list_summaries", "SELECT vec_id, len(embedding)::int AS n, round(list_sum(embedding::double[]), 5) AS total FROM embeddings")
def list_summaries(t):
    return t.embeddings.select("vec_id", F.size("embedding").alias("n"), r(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")), 5).alias("total"))


@query("list_field", "SELECT event_id, (props->>'k')::int AS k FROM events")
def list_field(t):
    return t.events.select("event_id", F.from_json("props", "map<string,int>")["k"].alias("k"))


@query("enframe", "\nUNION ALL ".join(f"SELECT '{c}' AS name, round(avg({c}), 6) AS value FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax")))
def enframe(t):
    cols = ["l_quantity", "l_discount", "l_tax"]
    return t.lineitem.agg(*[r(F.avg(c)).alias(c) for c in cols]).unpivot([], cols, "name", "value")


@query("nested_lm", f"""WITH {REG_SQL} SELECT cat, round(regr_intercept(y, x1), 5) AS intercept, round(regr_slope(y, x1), 6) AS slope, round(regr_r2(y, x1), 6) AS r2 FROM reg GROUP BY 1""")
def nested_lm(t):
    return t.reg.groupBy("cat").agg(r(F.regr_intercept("y", "x1"), 5).alias("intercept"), r(F.regr_slope("y", "x1")).alias("slope"), r(F.regr_r2("y", "x1")).alias("r2"))


TWO_X = """m AS (SELECT cat, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, covar_pop(x1, x1) AS s11, covar_pop(x2, x2) AS s22, covar_pop(x1, x2) AS s12,
covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y FROM reg GROUP BY 1),
b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM m),
f AS (SELECT cat, b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM b)"""


def group_fits(df: DataFrame, by: str, y: str, xs: list[str]) -> DataFrame:
    """Least squares per group: rows (group, term, estimate), solved from one moment row per group.

    The Python step sees one row per group, so it spreads over any number of groups and never holds a group's data.
    """
    import numpy as np
    import pandas as pd

    from larkframe.operators.moments import moment_table, row_moments, solve

    cols = xs + [y]

    def fit(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                m = row_moments(row, cols)
                if np.linalg.matrix_rank(m.cov[: len(xs), : len(xs)]) < len(xs):
                    continue
                f = solve(m, y, xs)
                out.append((row[by], "(Intercept)", f.intercept))
                out += [(row[by], x, None if np.isnan(b) else float(b)) for x, b in zip(xs, f.coef)]
            yield pd.DataFrame(out, columns=[by, "term", "estimate"])

    kind = dict(df.dtypes)[by]
    return moment_table(df, cols, [by]).mapInPandas(fit, f"{by} {kind}, term string, estimate double")


@query("nested_lm_coefs", f"""WITH {REG_SQL}, {TWO_X} SELECT cat, '(Intercept)' AS term, round(b0, 5) AS estimate FROM f UNION ALL SELECT cat, 'x1', round(b1, 6) FROM f UNION ALL SELECT cat, 'x2', round(b2, 6) FROM f""")
def nested_lm_coefs(t):
    d = group_fits(t.reg, "cat", "y", ["x1", "x2"])
    return d.withColumn("estimate", F.when(col("term") == "(Intercept)", r(col("estimate"), 5)).otherwise(r(col("estimate"))))


@query("nested_augment", f"WITH {REG_SQL}, {TWO_X} SELECT key, round(b0 + b1 * x1 + b2 * x2, 4) AS fitted, round(y - (b0 + b1 * x1 + b2 * x2), 4) AS resid FROM reg JOIN f USING (cat)")
def nested_augment(t):
    terms = group_fits(t.reg, "cat", "y", ["x1", "x2"]).groupBy("cat").pivot("term", ["(Intercept)", "x1", "x2"]).agg(F.first("estimate"))
    d = group_join(t.reg.where(col("cat").isNotNull()), terms.toDF("cat", "b0", "b1", "b2"), ["cat"])
    fitted = col("b0") + col("b1") * col("x1") + col("b2") * col("x2")
    return d.select("key", r(fitted, 4).alias("fitted"), r(col("y") - fitted, 4).alias("resid"))
