"""The given tables, and the derived tables that models and metrics run on."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkframe.operators.hashing import uniform

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def line_key() -> Column:
    """Text key that is unique per lineitem row; price is written in cents so that its text is stable."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents)


class Tables:
    def __init__(self, spark: SparkSession, path: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.path = path.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    @cached_property
    def reg(self) -> DataFrame:
        """Line items with a known linear signal in y."""
        x1 = F.col("l_quantity")
        x2 = F.round(F.col("l_discount") * 100)
        x3 = F.round(F.col("l_tax") * 100)
        base = self.lineitem.select(
            line_key().alias("key"), x1.alias("x1"), x2.alias("x2"), x3.alias("x3"),
            F.col("l_returnflag").alias("cat"), F.col("l_shipdate").cast("timestamp").alias("ship"),
        )
        y = (
            10 + 2 * F.col("x1") + 3 * F.col("x2") + 0.5 * F.col("x1") * F.col("x2") - F.col("x3")
            + F.when(F.col("cat") == "R", 5.0).otherwise(0.0)
            + 20 * (uniform(["key"], "reg") - 0.5)
        )
        return base.withColumn("y", y)

    @cached_property
    def scored(self) -> DataFrame:
        """reg with the prediction of a fixed formula."""
        pred = 12 + 2.1 * F.col("x1") + 2.8 * F.col("x2") + 0.5 * F.col("x1") * F.col("x2") - F.col("x3")
        return self.reg.withColumn("pred", pred)

    @cached_property
    def cls(self) -> DataFrame:
        """Labelled documents with simple text features; the event is quality 0."""
        n = F.greatest(F.col("n_chars").cast("double"), F.lit(1.0))

        def share(pattern: str) -> Column:
            return F.length(F.regexp_replace("text", pattern, "")) / n

        docs = self.documents.select(
            "doc_id", "lang", "source", "n_chars",
            F.ln(n).alias("f1"), share("[^!?.]").alias("f2"), share("[^A-Z]").alias("f3"),
            F.regexp_count("text", F.lit("\\S+")).cast("double").alias("f4"),
        )
        return docs.join(self.labels, "doc_id").withColumn("event", (F.col("quality") == 0).cast("int"))

    @cached_property
    def cls_scored(self) -> DataFrame:
        """cls with the event probability of a fixed formula, rounded so that ties are the same everywhere."""
        p = F.round(1 / (1 + F.exp(-(60 * F.col("f2") - 3))), 6)
        return self.cls.withColumn("p", p).withColumn("pred", (F.col("p") > 0.5).cast("int"))

    @cached_property
    def multi(self) -> DataFrame:
        """Embeddings with class = position of the largest of the first three elements."""
        e = [F.col("embedding")[i].cast("double") for i in range(3)]
        df = self.embeddings.select("vec_id", "label", "embedding", *[c.alias(f"e{i + 1}") for i, c in enumerate(e)])
        top = F.greatest("e1", "e2", "e3")
        cls = F.when(F.col("e1") == top, 1).when(F.col("e2") == top, 2).otherwise(3)
        return df.withColumn("cls", cls)

    @cached_property
    def daily(self) -> DataFrame:
        """One row per order date: orders and revenue."""
        return (
            self.orders.groupBy(F.to_date("o_orderdate").alias("d"))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))
        )

    @cached_property
    def reg_nulls(self) -> DataFrame:
        """reg with values missing at random (x1), by x3 (x2), and by their own size (x3)."""
        d = self.reg.withColumn("t1", F.col("x1")).withColumn("t2", F.col("x2")).withColumn("t3", F.col("x3"))
        return d.select(
            "key", "cat", "y", "t1", "t2", "t3",
            F.when(uniform(["key"], "mcar") >= 0.2, F.col("x1")).alias("x1"),
            F.when(F.col("x3") >= 2, F.col("x2")).alias("x2"),
            F.when(~((F.col("x3") > 6) & (uniform(["key"], "mnar") < 0.5)), F.col("x3")).alias("x3"),
        )

    @cached_property
    def orders_nulls(self) -> DataFrame:
        """orders with a tenth of the priorities missing."""
        return self.orders.withColumn(
            "o_orderpriority", F.when(uniform(["o_orderkey"], "prio") >= 0.1, F.col("o_orderpriority"))
        )

    @cached_property
    def placed(self) -> DataFrame:
        """All orders by customer; the keys of a tenth of the customers are negative, so that both sides have unmatched rows."""
        unknown = uniform(["o_custkey"], "unknown") < 0.1
        return self.orders_nulls.select(
            F.when(unknown, -F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("c_custkey"),
            "o_orderkey", "o_totalprice", "o_orderpriority",
        )


# The same derived tables as SQL, for the checking queries.

def u_sql(key: str, seed: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('-', {key}, '{seed}')), 1, 13))::bigint / 4503599627370496::double)"


LINE_KEY_SQL = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice * 100) as bigint))"
)

REG_SQL = f"""reg0 AS (SELECT {LINE_KEY_SQL} AS key, l_quantity AS x1, round(l_discount * 100) AS x2,
  round(l_tax * 100) AS x3, l_returnflag AS cat, l_shipdate AS ship FROM lineitem),
reg AS (SELECT *, 10 + 2 * x1 + 3 * x2 + 0.5::double * x1 * x2 - x3 + CASE WHEN cat = 'R' THEN 5.0::double ELSE 0.0::double END
  + 20 * ({u_sql('key', 'reg')} - 0.5::double) AS y FROM reg0)"""

SCORED_SQL = REG_SQL + """,
scored AS (SELECT *, 12 + 2.1::double * x1 + 2.8::double * x2 + 0.5::double * x1 * x2 - x3 AS pred FROM reg)"""

CLS_SQL = """cls AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, ln(greatest(n_chars, 1)::double) AS f1,
  length(regexp_replace(text, '[^!?.]', '', 'g')) / greatest(n_chars, 1)::double AS f2,
  length(regexp_replace(text, '[^A-Z]', '', 'g')) / greatest(n_chars, 1)::double AS f3,
  len(regexp_extract_all(text, '\\S+'))::double AS f4, quality, toxic, CASE WHEN quality = 0 THEN 1 ELSE 0 END AS event
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

CLS_SCORED_SQL = CLS_SQL + """,
cls_p AS (SELECT *, round(1 / (1 + exp(-(60 * f2 - 3))), 6) AS p FROM cls),
cls_scored AS (SELECT *, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS pred FROM cls_p)"""

MULTI_SQL = """multi0 AS (SELECT vec_id, label, embedding, embedding[1]::double AS e1, embedding[2]::double AS e2,
  embedding[3]::double AS e3 FROM embeddings),
multi AS (SELECT *, CASE WHEN e1 >= e2 AND e1 >= e3 THEN 1 WHEN e2 >= e3 THEN 2 ELSE 3 END AS cls FROM multi0)"""

DAILY_SQL = """daily AS (SELECT cast(o_orderdate AS date) AS d, count(*) AS n, round(sum(o_totalprice), 2) AS revenue
  FROM orders GROUP BY 1)"""

REG_NULLS_SQL = REG_SQL + f""",
reg_nulls AS (SELECT key, cat, y, x1 AS t1, x2 AS t2, x3 AS t3,
  CASE WHEN {u_sql('key', 'mcar')} >= 0.2 THEN x1 END AS x1, CASE WHEN x3 >= 2 THEN x2 END AS x2,
  CASE WHEN NOT (x3 > 6 AND {u_sql('key', 'mnar')} < 0.5) THEN x3 END AS x3 FROM reg)"""

ORDERS_NULLS_SQL = f"""orders_nulls AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN {u_sql('o_orderkey', 'prio')} >= 0.1 THEN o_orderpriority END AS o_orderpriority FROM orders)"""

PLACED_SQL = ORDERS_NULLS_SQL + f""",
placed AS (SELECT CASE WHEN {u_sql('o_custkey', 'unknown')} < 0.1 THEN -o_custkey ELSE o_custkey END AS c_custkey,
  o_orderkey, o_totalprice, o_orderpriority FROM orders_nulls)"""
