"""Higher-order functions on arrays, and user functions in their Arrow forms."""

import json
import math

import pandas as pd

from larkframe.operators.hashing import uniform
from larkframe.plans.base import *
from larkframe.tables import REG_SQL, u_sql

DBL = "list_transform(embedding, lambda x: x::double)"


def dbl() -> Column:
    return F.transform("embedding", lambda x: x.cast("double"))


def text_of(a: Column, digits: int = 4) -> Column:
    """Array as text, for comparison: scaled to whole numbers so that the spelling is the same everywhere."""
    return F.array_join(F.transform(a, lambda x: F.round(x * 10**digits).cast("long").cast("string")), ",")


def text_sql(a: str, digits: int = 4) -> str:
    return f"array_to_string(list_transform({a}, lambda z: round(z * {10**digits})::bigint), ',')"


@query("hof_map", f"SELECT vec_id, {text_sql(f'list_transform({DBL}, lambda y: y * y)')} AS squares, len(embedding)::int AS n, list_max(embedding) > 0.3 AS peak FROM embeddings")
def hof_map(t):
    return t.embeddings.select("vec_id", text_of(F.transform(dbl(), lambda x: x * x)).alias("squares"), F.size("embedding").alias("n"),
                               (F.array_max("embedding") > F.lit(0.3).cast("float")).alias("peak"))


@query("hof_keep", "SELECT vec_id, len(list_filter(embedding, lambda x: x > 0))::int AS n FROM embeddings")
def hof_keep(t):
    return t.embeddings.select("vec_id", F.size(F.filter("embedding", lambda x: x > 0)).alias("n"))


@query("hof_extract_pos", "SELECT vec_id, round(embedding[3]::double, 6) AS third, round(embedding[-1]::double, 6) AS last FROM embeddings")
def hof_extract_pos(t):
    return t.embeddings.select("vec_id", r(F.element_at("embedding", 3).cast("double")).alias("third"), r(F.element_at("embedding", -1).cast("double")).alias("last"))


@query("hof_map2", f"SELECT vec_id, round(list_sum(list_transform(list_zip({DBL}, list_reverse({DBL})), lambda p: p[1] * p[2])), 6) AS dot FROM embeddings")
def hof_map2(t):
    z = F.zip_with(dbl(), F.reverse(dbl()), lambda a, b: a * b)
    return t.embeddings.select("vec_id", r(F.aggregate(z, F.lit(0.0), lambda a, x: a + x)).alias("dot"))


@query("hof_pmap", "SELECT event_type, round(avg(value) - 1.96::double * stddev_samp(value) / sqrt(count(*)), 6) AS lo, round(avg(value) + 1.96::double * stddev_samp(value) / sqrt(count(*)), 6) AS hi FROM events GROUP BY 1")
def hof_pmap(t):
    """One call per row of a parameter frame (here: n, mean, sd per event type)."""
    params = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))

    def band(n, mean, sd):
        half = 1.96 * sd / math.sqrt(n)
        return round(mean - half, 6), round(mean + half, 6)

    def call(batches):
        for pdf in batches:
            res = [band(*p) for p in zip(pdf["n"], pdf["mean"], pdf["sd"])]
            yield pd.DataFrame({"event_type": pdf["event_type"], "lo": [a for a, _ in res], "hi": [b for _, b in res]})

    return params.mapInPandas(call, "event_type string, lo double, hi double")


@query("hof_map_if", f"SELECT vec_id, {text_sql(f'list_transform({DBL}, lambda y: CASE WHEN y < 0 THEN 0 ELSE y END)')} AS x FROM embeddings")
def hof_map_if(t):
    return t.embeddings.select("vec_id", text_of(F.transform(dbl(), lambda x: F.when(x < 0, F.lit(0.0)).otherwise(x))).alias("x"))


@query("hof_reduce", f"SELECT vec_id, round(list_reduce({DBL}, lambda a, b: a + b), 5) AS total FROM embeddings")
def hof_reduce(t):
    return t.embeddings.select("vec_id", r(F.reduce(dbl(), F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


@query("hof_accumulate", "SELECT c_custkey, array_to_string(list_transform(range(1, 6), lambda k: (k * (k + 1) // 2) * (c_nationkey + 1)), ',') AS run FROM customer")
def hof_accumulate(t):
    """Running fold: each step appends the last value plus the next element."""
    a = F.transform(F.sequence(F.lit(1), F.lit(5)), lambda k: k * (col("c_nationkey") + 1))
    start = F.array().cast("array<int>")
    run = F.aggregate(a, start, lambda acc, x: F.array_append(acc, F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)) + x))
    return t.customer.select("c_custkey", F.array_join(F.transform(run, lambda x: x.cast("string")), ",").alias("run"))


@query("hof_factory", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(pow(l_quantity, 2), 4) AS sq, round(pow(l_quantity, 3), 4) AS cube FROM lineitem")
def hof_factory(t):
    def make_power(n):
        return lambda c: F.pow(c, F.lit(n))

    square, cube = make_power(2), make_power(3)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r(square(col("l_quantity")), 4).alias("sq"), r(cube(col("l_quantity")), 4).alias("cube"))


def damaged(t) -> DataFrame:
    """Event properties of which some are cut off and cannot be parsed."""
    cut = F.when(uniform(["event_id"], "cut") < 0.1, F.substring("props", 1, 4)).otherwise(col("props"))
    return t.events.select("event_id", cut.alias("props"), "value")


CUT = u_sql("event_id", "cut")


@query("udf_safely", f"SELECT event_id, CASE WHEN {CUT} >= 0.1 THEN (props->>'k')::int END AS result, CASE WHEN {CUT} < 0.1 THEN 'JSONDecodeError' END AS error FROM events")
def udf_safely(t):
    @F.pandas_udf("result int, error string")
    def parse(s: pd.Series) -> pd.DataFrame:
        def one(x):
            try:
                return json.loads(x)["k"], None
            except Exception as e:  # the job goes on, the row says why
                return None, type(e).__name__

        out = pd.DataFrame([one(x) for x in s], columns=["result", "error"])
        return out.astype({"result": "Int32"})

    return damaged(t).select("event_id", parse("props").alias("p")).select("event_id", "p.*")


@query("udf_possibly", f"SELECT event_id, coalesce(CASE WHEN {CUT} >= 0.1 THEN (props->>'k')::double END, -1) AS k, round(coalesce(value / nullif((props->>'k')::int % 5, 0), 0), 6) AS ratio FROM events")
def udf_possibly(t):
    d = damaged(t).join(t.events.select("event_id", col("props").alias("whole")), "event_id")
    k = F.from_json("whole", "struct<k:int>")["k"]
    return d.select("event_id", F.coalesce(F.regexp_substr("props", F.lit("[0-9]+")).try_cast("double"), F.lit(-1.0)).alias("k"),
                    r(F.coalesce(F.try_divide(col("value"), k % 5), F.lit(0.0))).alias("ratio"))


@query("udf_quietly", "SELECT event_id, round(CASE WHEN value < 20 THEN ln(20 - value) END, 6) AS result, CASE WHEN value >= 20 THEN 'NaNs produced' ELSE '' END AS warnings FROM events")
def udf_quietly(t):
    import numpy as np

    @F.pandas_udf("result double, warnings array<string>")
    def quiet(s: pd.Series) -> pd.DataFrame:
        bad = s >= 20
        res = np.log((20 - s).where(~bad))
        return pd.DataFrame({"result": res.round(6), "warnings": [["NaNs produced"] if b else [] for b in bad]})

    d = t.events.select("event_id", quiet("value").alias("q"))
    return d.select("event_id", F.nanvl("q.result", F.lit(None).cast("double")).alias("result"), F.array_join("q.warnings", ";").alias("warnings"))


@query("udf_scalar", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(least(l_extendedprice, 50000) * (1 - l_discount), 4) AS net FROM lineitem")
def udf_scalar(t):
    @F.pandas_udf("double")
    def net(price: pd.Series, disc: pd.Series) -> pd.Series:
        return (price.clip(upper=50000) * (1 - disc)).round(4)

    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", net("l_extendedprice", "l_discount").alias("net"))


@query("udaf_group", f"WITH {REG_SQL} SELECT cat, count(*) AS n, round(exp(avg(ln(y + 100))), 5) AS gmean FROM reg GROUP BY 1")
def udaf_group(t):
    """A custom mean per group (here geometric), as a partial step per Arrow batch and a merge.

    The Python step returns one row per group and batch, so a hot group is never gathered into one task.
    """
    import numpy as np

    def partial(batches):
        for pdf in batches:
            g = np.log(pdf["y"] + 100).groupby(pdf["cat"]).agg(["size", "sum"])
            yield pd.DataFrame({"cat": g.index, "k": g["size"].to_numpy(), "s": g["sum"].to_numpy()})

    parts = t.reg.select("cat", "y").mapInPandas(partial, "cat string, k long, s double")
    return parts.groupBy("cat").agg(F.sum("k").alias("n"), r(F.exp(F.sum("s") / F.sum("k")), 5).alias("gmean"))


@query("udtf_rows", "SELECT o_orderkey, i::int AS part, round(o_totalprice / 4, 4) AS amount, cast((o_orderdate + to_months((3 * i)::int))::date AS varchar) AS due FROM orders, range(1, 5) r(i)")
def udtf_rows(t):
    """One row to many: a table function gives four instalments per order."""
    @F.udtf(returnType="part int, amount double, months int")
    class Instalments:
        def eval(self, total: float):
            for i in range(1, 5):
                yield i, total / 4, 3 * i

    t.spark.udtf.register("larkframe_instalments", Instalments)
    d = t.spark.sql("SELECT o_orderkey, o_orderdate, i.* FROM {o}, LATERAL larkframe_instalments(o_totalprice) i", o=t.orders)
    return d.select("o_orderkey", "part", r(col("amount"), 4).alias("amount"), F.add_months(F.to_date("o_orderdate"), col("months")).cast("string").alias("due"))


@query("parallel_map", f"""WITH e AS (SELECT floor({u_sql('event_id', 'task')} * 100)::int AS task, value + {u_sql('event_id', 'noise')} - 0.5::double AS x FROM events)
SELECT task, count(*) AS n, round(avg(x), 6) AS mean FROM e GROUP BY 1""")
def parallel_map(t):
    """A hundred independent tasks; each batch of a task gives partial sums, so a task may span partitions."""
    d = t.events.select(F.floor(uniform(["event_id"], "task") * 100).cast("int").alias("task"), (col("value") + uniform(["event_id"], "noise") - 0.5).alias("x"))

    def work(batches):
        for pdf in batches:
            g = pdf.groupby("task")["x"].agg(["size", "sum"]).reset_index()
            yield g.rename(columns={"size": "k", "sum": "s"})

    parts = d.mapInPandas(work, "task int, k long, s double")
    return parts.groupBy("task").agg(F.sum("k").alias("n"), r(F.sum("s") / F.sum("k")).alias("mean"))


@query("safe_frame_clean", """SELECT 'customer' AS frame, 'ok' AS status, count(*) AS n FROM customer UNION ALL SELECT 'orders', 'ok', count(*) FILTER (o_totalprice > 1000) FROM orders
UNION ALL SELECT 'region', 'missing column amount', 0""")
def safe_frame_clean(t):
    """Status per input table: a frame without the wanted column is reported, and the others go on."""
    frames = {"customer": t.customer.withColumn("amount", F.lit(2000.0)), "orders": t.orders.withColumnRenamed("o_totalprice", "amount"), "region": t.region}
    out = None
    for name, d in frames.items():
        if "amount" in d.columns:
            row = d.where(col("amount") > 1000).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("frame"), F.lit("ok").alias("status"), "n")
        else:
            row = d.agg(F.count_if(F.lit(False)).alias("n")).select(F.lit(name).alias("frame"), F.lit("missing column amount").alias("status"), "n")
        out = row if out is None else out.unionByName(row)
    return out
