"""Content-addressed web archive: payloads once by digest, record headers apart, records rebuilt by joins.

``write`` makes two tables under one folder. ``payloads`` holds every distinct payload once under its SHA-256; ``headers`` holds one row
per record with the exact bytes of its WARC header block, so nothing of a record is lost. Of records with equal payloads of
at least 100 bytes the one with the smallest page_id is a response and the others are revisits of it; smaller payloads are
responses always. ``read`` joins both tables again, verifies each payload against the digest in its header, and parses type,
length and reference from the header; ``records`` gives the exact WARC records.

Defined cases: a null html is an empty payload; a null page_id comes last in the order and is written as an empty id; rows that
repeat page_id, url and html are records of their own, of which one is first; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkframe.llm.registry import query, table
from larkframe.session import new_folder

SMALL = 100
EOL = "\r\n"


def _payloads(pages: DataFrame) -> DataFrame:
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    url = F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]", " ")
    return pages.select("page_id", url.alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))


def _header(kind: str) -> list:
    line = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.col("id"), F.lit(":"), F.col("copy"), F.lit(">")),
            F.concat(F.lit("WARC-Target-URI: "), "url"), F.concat(F.lit("WARC-Payload-Digest: sha256:"), "digest")]
    if kind == "revisit":
        line += [F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.coalesce(F.col("first.page_id").cast("string"), F.lit("")), F.lit(":"), F.col("first.copy"), F.lit(">"))]
    length = F.lit("0") if kind == "revisit" else F.col("size").cast("string")
    return [*line, F.concat(F.lit("Content-Length: "), length), F.lit(""), F.lit("")]


def write(pages: DataFrame, folder: str) -> None:
    """Write the archive. Hot payloads combine before each shuffle, and the join may split them."""
    spark = pages.sparkSession
    rows = _payloads(pages)
    rows.groupBy("digest").agg(F.first("payload").alias("payload")).write.parquet(f"{folder}/payloads")
    heads = rows.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("size"))
    copies = heads.groupBy("page_id", "url", "digest", "size").agg(F.count(F.lit(1)).alias("n"))
    copies.write.parquet(f"{folder}/counted")
    copies = spark.read.schema(copies.schema).parquet(f"{folder}/counted")
    place = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url", F.lit(1).alias("copy"))
    copies.where(F.col("size") >= SMALL).groupBy("digest").agg(F.min(place).alias("first")).write.parquet(f"{folder}/firsts")
    firsts = spark.read.parquet(f"{folder}/firsts")
    each = copies.join(firsts, "digest", "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    mine = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url", "copy")
    each = each.withColumn("id", F.coalesce(F.col("page_id").cast("string"), F.lit(""))).withColumn("again", F.coalesce(mine > F.col("first"), F.lit(False)))
    text = F.when(F.col("again"), F.concat_ws(EOL, *_header("revisit"))).otherwise(F.concat_ws(EOL, *_header("response")))
    each.select("page_id", "digest", F.encode(text, "UTF-8").alias("header")).write.parquet(f"{folder}/headers")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, header, payload, payload_bytes, payload_digest, record_type, refers_to) of every record, digests verified."""
    heads = spark.read.parquet(f"{folder}/headers")
    payloads = spark.read.parquet(f"{folder}/payloads").withColumnRenamed("digest", "stored").withColumn("found", F.sha2("payload", 256))
    text = F.decode("header", "UTF-8")

    def field(name: str, pattern: str):
        got = F.regexp_extract(text, f"\r\n{name}: {pattern}\r\n", 1)
        return F.when(got != "", got)

    rows = heads.withColumn("stored", field("WARC-Payload-Digest", "sha256:([0-9a-f]{64})")).join(payloads, "stored", "left")
    sound = F.when(F.col("found") == F.col("stored"), F.col("found")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "stored")))
    return rows.select(
        "page_id", "header", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), sound.alias("payload_digest"),
        field("WARC-Type", "([a-z]+)").alias("record_type"), field("WARC-Refers-To", "<urn:page:(-?[0-9]*):[0-9]+>").cast("long").alias("refers_to"))


def records(archive: DataFrame) -> DataFrame:
    """(page_id, record): the bytes of the WARC records as they stand in a WARC file; a revisit has no block."""
    end = F.encode(F.lit(EOL * 2), "UTF-8")
    block = F.when(F.col("record_type") == "revisit", F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload"))
    return archive.select("page_id", F.concat("header", block, end).alias("record"))


SQL = """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, d.payload_digest, CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first_id THEN first_id END AS refers_to FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest"""


@query("op5_content_addressed_warc", SQL)
def op5(spark, sf_dir):
    folder = new_folder(spark, "archive")
    write(table(spark, sf_dir, "pages"), folder)
    return read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
