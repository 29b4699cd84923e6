"""Readers and writers, each run over a whole given table that is first written in the wanted format."""

import pandas as pd

from larkframe.operators.hashing import uniform
from larkframe.plans.base import *
from larkframe.plans.verbs import poisson_copies
from larkframe.session import new_folder
from larkframe.sources import readers as rd
from larkframe.sources import records as rec
from larkframe.sources import writers as wr
from larkframe.tables import line_key, u_sql

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LINE_SCHEMA = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double"
ORD = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
ORD_SQL = ", ".join(ORD)


def orders_csv(t, **kw) -> str:
    d = t.orders.select(*ORD, F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_date"))
    return wr.write_delim(d, new_folder(t.spark, "orders"), **kw)


@query("src_csv", f"SELECT {ORD_SQL}, strftime(o_orderdate, '%Y-%m-%d') AS o_date FROM orders")
def src_csv(t):
    d = rd.read_delim(t.spark, orders_csv(t))
    return d.select(col("o_orderkey").cast("long"), col("o_custkey").cast("long"), "o_orderstatus", "o_totalprice", col("o_date").cast("string").alias("o_date"))


@query("src_csv_typed", f"SELECT {ORD_SQL}, year(o_orderdate) AS y FROM orders")
def src_csv_typed(t):
    price = F.concat(F.lit("$"), F.format_number("o_totalprice", 2)).alias("o_totalprice")
    path = wr.write_delim(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", price, F.date_format("o_orderdate", "dd/MM/yyyy").alias("o_date")), new_folder(t.spark, "typed"))
    d = t.spark.read.option("header", True).option("dateFormat", "dd/MM/yyyy").schema(
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice string, o_date date").csv(path)
    d = rd.cast_columns(d, {"o_totalprice": "number"})
    return d.select(*ORD, F.year("o_date").cast("long").alias("y"))


@query("src_csv_messy", """SELECT c_custkey AS id, c_name AS name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer""")
def src_csv_messy(t):
    """Files with a title line, comment lines, a header and several spellings of a missing value."""
    line = F.concat_ws(",", col("c_custkey").cast("string"), "c_name", F.when(col("c_acctbal") >= 0, col("c_acctbal").cast("string")).otherwise("N/A"),
                       F.when(col("c_mktsegment") != "BUILDING", col("c_mktsegment")).otherwise("missing"))
    noted = F.when(uniform(["c_custkey"], "note") < 0.05, F.array(F.lit("# checked by hand"), line)).otherwise(F.array(line))

    def with_title(batches):
        yield pd.DataFrame({"value": ["Customer list", "id,name,balance,segment"]})
        yield from batches

    path = new_folder(t.spark, "messy")
    t.customer.select(F.explode(noted).alias("value")).mapInPandas(with_title, "value string").write.text(path)
    d = rd.split_lines(rd.read_lines(t.spark, path, skip=2, comment="#"), ["id", "name", "balance", "segment"])
    return rd.cast_columns(rd.na_to_null(d, ["NA", "N/A", "missing"]), {"id": "long", "balance": "double"})


@query("src_csv_na_typed", "SELECT event_id, CASE WHEN event_type <> 'error' AND value <= 30 THEN value END AS value FROM events")
def src_csv_na_typed(t):
    text = F.when(col("event_type") == "error", "missing").when(col("value") > 30, "NA").otherwise(col("value").cast("string"))
    path = wr.write_delim(t.events.select("event_id", text.alias("value")), new_folder(t.spark, "mixed"))
    return rd.read_delim(t.spark, path, types={"event_id": "long", "value": "double"}, na=["NA", "missing"])


@query("src_csv_select", "SELECT l_orderkey, l_quantity FROM lineitem")
def src_csv_select(t):
    d = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    path = wr.write_delim(d, new_folder(t.spark, "lines"))
    return rd.read_delim(t.spark, path, schema="l_orderkey long, l_partkey long, l_quantity double, l_returnflag string", select=["l_orderkey", "l_quantity"])


@query("src_csv_preview", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 5")
def src_csv_preview(t):
    """The head of a delimited file, read from its front."""
    path = wr.write_delim(t.lineitem.select(*LINE).orderBy(*LINE), new_folder(t.spark, "sorted"))
    d = rec.preview(t.spark, path, LINE_SCHEMA, 5)
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("src_csv_blank_rows", "SELECT o_orderkey, o_orderstatus, nullif(o_totalprice, 0) AS price FROM orders")
def src_csv_blank_rows(t):
    row = F.struct(col("o_orderkey").cast("string").alias("a"), col("o_orderstatus").alias("b"), col("o_totalprice").cast("string").alias("c"), F.lit(None).cast("string").alias("d"))
    none = F.lit(None).cast("string")
    gap = F.struct(none.alias("a"), none.alias("b"), none.alias("c"), none.alias("d"))
    rows = F.when(uniform(["o_orderkey"], "gap") < 0.1, F.array(row, gap)).otherwise(F.array(row))
    d = t.orders.select(F.inline(rows)).toDF("o_orderkey", "o_orderstatus", "price", "_c3")
    path = new_folder(t.spark, "gaps")
    d.write.option("header", True).option("emptyValue", "").csv(path)
    d = rd.read_delim(t.spark, path, types={"o_orderkey": "long", "price": "double"})
    named = [c for c in d.columns if not c.startswith("_c")]
    return d.where(F.coalesce(*[col(c).cast("string") for c in named]).isNotNull()).select(*named)


@query("src_csv_encoding", "SELECT doc_id, md5(regexp_replace(regexp_replace(text, '[\\n\\r]', ' ', 'g'), '[^\\x00-\\xff]', '', 'g')) AS h FROM documents")
def src_csv_encoding(t):
    # Latin-1 keeps the characters up to U+00FF; others and line breaks are taken out before writing
    plain = F.regexp_replace(F.regexp_replace("text", "[\\n\\r]", " "), "[^\\x{00}-\\x{ff}]", "")
    d = t.documents.select("doc_id", plain.alias("x"))
    path = new_folder(t.spark, "latin")
    d.write.option("encoding", "ISO-8859-1").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    back = t.spark.read.option("encoding", "ISO-8859-1").option("header", True).option("escape", '"').schema("doc_id long, x string").csv(path)
    return back.select("doc_id", F.md5(F.coalesce("x", F.lit(""))).alias("h"))


@query("src_tsv", "SELECT n_nationkey, n_name, c_custkey FROM nation JOIN customer ON n_nationkey = c_nationkey")
def src_tsv(t):
    d = t.nation.join(t.customer, col("n_nationkey") == col("c_nationkey")).select("n_nationkey", "n_name", "c_custkey")
    path = wr.write_delim(d, new_folder(t.spark, "tabs"), sep="\t")
    return rd.read_delim(t.spark, path, sep="\t", schema="n_nationkey int, n_name string, c_custkey long")


@query("src_delim", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def src_delim(t):
    path = wr.write_delim(t.supplier.select("s_suppkey", "s_name", "s_acctbal"), new_folder(t.spark, "semi"), sep=";")
    return rd.read_delim(t.spark, path, sep=";", schema="s_suppkey long, s_name string, s_acctbal double")


@query("src_fwf", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def src_fwf(t):
    line = F.concat(F.lpad(col("s_suppkey").cast("string"), 12, " "), F.rpad("s_name", 24, " "), F.lpad(F.format_string("%.2f", "s_acctbal"), 14, " "))
    path = new_folder(t.spark, "fixed")
    t.supplier.select(line).write.text(path)
    return rd.read_fwf(t.spark, path, {"s_suppkey": (12, "long"), "s_name": (24, "string"), "s_acctbal": (14, "double")})


PROPS = "struct<k:bigint>"


@query("src_json", "SELECT event_id, user_id, (props->>'k')::bigint AS k FROM events")
def src_json(t):
    """Files that hold one JSON array each, with nested objects; read in splits."""
    who = F.struct("user_id", F.from_json("props", PROPS).alias("props")).alias("who")
    path = wr.write_json_arrays(t.events.select("event_id", who), new_folder(t.spark, "arrays"))
    back = rec.read_json_records(t.spark, path, "event_id long, who struct<user_id:bigint,props:struct<k:bigint>>")
    return back.select("event_id", "who.user_id", col("who.props.k").alias("k"))


@query("src_json_flatten", "SELECT p_partkey, p_brand || ';' || p_type AS tags, 2 AS n FROM part")
def src_json_flatten(t):
    path = wr.write_json(t.part.select("p_partkey", F.array("p_brand", "p_type").alias("tags")), new_folder(t.spark, "tags"))
    d = t.spark.read.schema("p_partkey long, tags array<string>").json(path)
    return d.select("p_partkey", F.array_join("tags", ";").alias("tags"), F.size("tags").alias("n"))


@query("src_json_string_col", "SELECT event_id, (props->>'k')::int AS k, props->>'k' AS text FROM events")
def src_json_string_col(t):
    return t.events.select("event_id", F.from_json("props", "struct<k:int>")["k"].alias("k"), F.get_json_object("props", "$.k").alias("text"))


@query("src_multi_file", "SELECT year(o_orderdate)::varchar AS file_year, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1")
def src_multi_file(t):
    path = new_folder(t.spark, "years")
    t.orders.withColumn("y", F.year("o_orderdate")).select(*ORD, "y").write.partitionBy("y").option("header", True).csv(path)
    d = t.spark.read.option("header", True).schema("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double").csv(f"{path}/*/*.csv")
    year = F.regexp_extract(F.input_file_name(), "y=([0-9]+)", 1)
    return d.groupBy(year.alias("file_year")).agg(F.count(F.lit(1)).alias("n"), r(F.avg("o_totalprice"), 4).alias("mean"))


@query("src_by_extension", "\nUNION ALL ".join(f"SELECT '{e}' AS ext, s_suppkey, s_name FROM supplier" for e in ("csv", "tsv", "json", "parquet")))
def src_by_extension(t):
    base, d = new_folder(t.spark, "any"), t.supplier.select("s_suppkey", "s_name")
    wr.write_delim(d, f"{base}.csv")
    wr.write_delim(d, f"{base}.tsv", sep="\t")
    wr.write_json(d, f"{base}.json")
    d.write.parquet(f"{base}.parquet")
    out = None
    for e in ("csv", "tsv", "json", "parquet"):
        x = rd.read_any(t.spark, f"{base}.{e}").select(F.lit(e).alias("ext"), col("s_suppkey").cast("long").alias("s_suppkey"), "s_name")
        out = x if out is None else out.unionByName(x)
    return out


@query("src_chunked", f"""WITH n AS (SELECT l_quantity, row_number() OVER (ORDER BY {', '.join(LINE)}) AS pos FROM lineitem)
SELECT min(pos) AS first_row, count(*) AS n, round(avg(l_quantity), 6) AS mean FROM n GROUP BY (pos - 1) // 10000""")
def src_chunked(t):
    """Chunks of 10,000 rows of a delimited file, each given to a function with the number of its first row."""
    path = wr.write_delim(t.lineitem.select(*LINE, "l_quantity").orderBy(*LINE), new_folder(t.spark, "sorted"))

    def summary(rows: pd.DataFrame, pos: int) -> pd.DataFrame:
        return pd.DataFrame({"first_row": [pos], "n": [len(rows)], "mean": [rows["l_quantity"].mean()]})

    d = rec.read_chunked(t.spark, path, f"{LINE_SCHEMA}, l_quantity double", summary, "first_row long, n long, mean double", 10_000)
    return d.select("first_row", "n", r(col("mean")).alias("mean"))


@query("src_sql", "SELECT c_name, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey")
def src_sql(t):
    return t.spark.sql("SELECT c_name, o_totalprice FROM {c} JOIN {o} ON c_custkey = o_custkey", c=t.customer, o=t.orders)


@query("src_lazy_table", "SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders WHERE o_totalprice > 100000 GROUP BY 1 ORDER BY 3 DESC")
def src_lazy_table(t):
    d = t.orders.where(col("o_totalprice") > 100000).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), r(F.avg("o_totalprice"), 4).alias("mean"))
    return d.orderBy(col("mean").desc())


@query("src_lazy_dt", "SELECT month(o_orderdate)::int AS m, round(avg(o_totalprice), 4) AS mean FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def src_lazy_dt(t):
    return t.orders.where(col("o_orderstatus") != "P").groupBy(F.month("o_orderdate").alias("m")).agg(r(F.avg("o_totalprice"), 4).alias("mean"))


@query("src_copy_to", "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1")
def src_copy_to(t):
    t.customer.createOrReplaceTempView("larkframe_customers")
    if "larkframe_customers" not in [x.name for x in t.spark.catalog.listTables()]:
        raise RuntimeError("the view was not registered")
    return t.spark.sql("SELECT c_nationkey, count(*) AS n FROM larkframe_customers GROUP BY c_nationkey")


@query("src_inline", """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' END AS word FROM orders""")
def src_inline(t):
    words = t.spark.createDataFrame([("F", "filled"), ("O", "open")], "o_orderstatus string, word string")
    return t.orders.join(F.broadcast(words), "o_orderstatus", "left").select("o_orderkey", "word")  # two literal rows


@query("src_generate", f"""WITH u AS (SELECT o_orderkey AS id, {u_sql('o_orderkey', 'g1')} AS a, {u_sql('o_orderkey', 'g2')} AS b FROM orders)
SELECT id, round(a, 6) AS unif, round(10 + 2 * sqrt(-2 * ln(1 - a)) * cos(2 * pi() * b), 6) AS norm, round(-ln(1 - a) / 0.5, 6) AS expo,
round(exp(sqrt(-2 * ln(1 - a)) * cos(2 * pi() * b)), 5) AS lnorm, CASE WHEN b < 0.5 THEN 'x' WHEN b < 0.8 THEN 'y' ELSE 'z' END AS choice FROM u""")
def src_generate(t):
    """Synthetic columns for every order key: uniform, normal, exponential, log-normal and a weighted choice."""
    d = t.orders.select(col("o_orderkey").alias("id"), uniform(["o_orderkey"], "g1").alias("a"), uniform(["o_orderkey"], "g2").alias("b"))
    z = F.sqrt(-2 * F.ln(1 - col("a"))) * F.cos(2 * F.pi() * col("b"))
    return d.select("id", r(col("a")).alias("unif"), r(10 + 2 * z).alias("norm"), r(-F.ln(1 - col("a")) / 0.5).alias("expo"), r(F.exp(z), 5).alias("lnorm"),
                    F.when(col("b") < 0.5, "x").when(col("b") < 0.8, "y").otherwise("z").alias("choice"))


SUMMARY = "SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 4) AS mean FROM part GROUP BY 1"


@query("sink_csv", f"WITH s AS ({SUMMARY}) " + " UNION ALL ".join(f"SELECT '{k}' AS kind, * FROM s" for k in ("csv", "tsv", "csv2")))
def sink_csv(t):
    d = t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), r(F.avg("p_retailprice"), 4).alias("mean"))
    out = None
    for kind, sep, dec in (("csv", ",", "."), ("tsv", "\t", "."), ("csv2", ";", ",")):
        path = wr.write_delim(d, new_folder(t.spark, kind), sep=sep, decimal=dec)
        x = t.spark.read.option("header", True).option("sep", sep).schema("p_brand string, n long, mean string").csv(path)
        mean = F.regexp_replace("mean", ",", ".") if dec == "," else col("mean")
        x = x.select(F.lit(kind).alias("kind"), "p_brand", "n", mean.cast("double").alias("mean"))
        out = x if out is None else out.unionByName(x)
    return out


@query("sink_json", "SELECT p_partkey, p_brand || '|' || p_type AS tags, p_size FROM part")
def sink_json(t):
    d = t.part.select("p_partkey", F.array("p_brand", "p_type").alias("tags"), F.struct("p_size").alias("spec"))
    path = wr.write_json(d, new_folder(t.spark, "out"))
    back = t.spark.read.schema(d.schema).json(path)
    return back.select("p_partkey", F.array_join("tags", "|").alias("tags"), "spec.p_size")


@query("sink_roundtrip", "SELECT count(*) AS n, 0::bigint AS lost, 0::bigint AS added FROM embeddings")
def sink_roundtrip(t):
    path = new_folder(t.spark, "nested")
    d = t.embeddings.withColumn("meta", F.struct("label", F.array("vec_id").alias("ids")))
    d.write.parquet(path)
    back = t.spark.read.parquet(path)
    lost, added = d.exceptAll(back).select(F.lit(1).alias("lost"), F.lit(0).alias("added")), back.exceptAll(d).select(F.lit(0), F.lit(1))
    sizes = back.select(F.lit(0).alias("lost"), F.lit(0).alias("added"), F.lit(1).alias("n"))
    both = lost.unionAll(added).withColumn("n", F.lit(0))
    return sizes.unionByName(both).agg(F.sum("n").alias("n"), F.sum("lost").alias("lost"), F.sum("added").alias("added"))
