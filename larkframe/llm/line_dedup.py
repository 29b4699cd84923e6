"""Line deduplication by overlapping windows of three lines, with DataFrame functions only.

The lines of a text are its parts between newlines. Every three neighbouring lines are hashed (128 bits); a window that
occurred before (in an earlier document, or earlier in the same one) is a later occurrence, and its three lines are covered.
Covered positions of all windows merge, and the covered lines go. Order of documents: doc_id, null last, then text hash.

Defined cases: windows of three blank lines are no repeats; texts that are null or shorter than three lines stay as they
are; a text of which every line is covered becomes empty; rows that repeat doc_id and text count as one document and all get
the same result; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkframe.llm.common import keyed, place, same_doc, written
from larkframe.llm.registry import query, table

SPAN = 3


def _lines() -> Column:
    return F.split("text", "\n", -1)


def _window(lines: Column):
    def at(i: Column) -> Column:
        three = [F.get(lines, i + j) for j in range(SPAN)]
        full = F.greatest(*[F.length(F.trim(x)) for x in three]) > 0
        return F.struct(i.alias("pos"), F.xxhash64(*three).alias("h1"), F.xxhash64(F.lit("second"), *three).alias("h2"), full.alias("full"))

    return at


def later_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, k, pos) of every window that occurred before; docs as from ``keyed``."""
    lines = docs.select("doc_id", "k", _lines().alias("lines")).where(F.size("lines") >= SPAN)
    spots = F.transform(F.sequence(F.lit(0), F.size("lines") - SPAN), _window(F.col("lines")))
    rows = lines.select("doc_id", "k", F.inline(spots)).where("full").drop("full")
    rows = written(rows, "line-windows")
    firsts = rows.groupBy("h1", "h2").agg(F.min(place("pos")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = written(firsts.drop("n"), "line-repeats")  # as a table: the join below may then split a hot window
    return rows.join(firsts, ["h1", "h2"]).where(place("pos") > F.col("first")).select("doc_id", "k", "pos")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All columns with the text shortened, n_lines before and n_removed."""
    base = keyed(docs, whole=True)
    covered = (
        later_windows(base)
        .groupBy("doc_id", "k")
        .agg(F.collect_set("pos").alias("pos"))
        .select("doc_id", "k", F.array_distinct(F.flatten(F.transform("pos", lambda p: F.sequence(p, p + (SPAN - 1))))).alias("gone"))
    )
    joined = base.alias("d").join(covered.alias("c"), same_doc("d", "c"), "left").select("d.row", "d.text", "c.gone")
    left = F.array_except(F.sequence(F.lit(0), F.size(_lines()) - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(F.col("lines"), i)), "\n"))
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    joined = joined.withColumn("lines", F.when(F.col("gone").isNotNull(), _lines()))
    cut = joined.select(
        "row", text.alias("text"),
        F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))
    return cut.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in others], "n_lines", "n_removed")


def keep_new_lines(docs: DataFrame) -> DataFrame:
    """The documents without their covered lines; those that lose every line go. n_chars, where present, is renewed."""
    got = dedup_lines(docs).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    if "n_chars" in docs.columns:
        got = got.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return got.select(*docs.columns)


SQL = """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, unnest(range(0, len(lines) - 2)) AS pos, lines FROM l WHERE len(lines) >= 3),
h AS (SELECT doc_id, pos, lines[pos + 1:pos + 3] AS three FROM w
  WHERE length(trim(lines[pos + 1])) + length(trim(lines[pos + 2])) + length(trim(lines[pos + 3])) > 0),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY three ORDER BY doc_id, pos) AS rn FROM h),
c AS (SELECT DISTINCT doc_id, pos + unnest([0, 1, 2]) AS pos FROM r WHERE rn > 1),
e AS (SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS pos FROM l),
k AS (SELECT e.doc_id, string_agg(line, chr(10) ORDER BY e.pos) FILTER (c.pos IS NULL) AS text, count(*) AS n_lines,
  count(c.pos) AS n_removed FROM e LEFT JOIN c ON e.doc_id = c.doc_id AND e.pos = c.pos GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id"""


@query("op4_line_windows", SQL)
def op4(spark, sf_dir):
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
