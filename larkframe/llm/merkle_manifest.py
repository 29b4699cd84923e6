"""Merkle manifest of a documents table: one tree of fan-out 16 per source, their roots in a tree above, a proof for every row.

Time-forward processing. Nodes are labelled (round, tree, block, level, place) in an order in which children come before parents. A
sweep in label order takes the digests sent to a node from a priority queue, hashes them and sends the digest on to the parent. The queue is
external: messages for the present block of 256 leaves lie in a heap, those for later blocks go to a written table that the next round
reads in label order, so a task holds one block whatever the size of a source. The reversed sweep starts at the root and sends every
child the digests of its siblings followed by what the parent has got, until each leaf holds its proof.

Positions come from one range sort over (source, doc_id), numbered per partition and shifted by the counts of earlier partitions, so
a hot source is many tasks.

Defined cases: a null value is hashed as ``-``; a null source is a tree of its own, before the others; null doc_ids come first in their
source and are never tampered with; rows under one doc_id are ordered by their leaf; rows equal in all columns are leaves of their own. A
table of one row has the leaf as root and the digest of nothing as digest of the proof. An empty table gives an empty result. Other
columns are not looked at, whatever their names. Texts of any length are hashed by Spark as they are.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkframe.llm.common import written
from larkframe.llm.registry import query, table

FAN = 16
LEVELS = 2  # of the tree, in one round
BLOCK = FAN**LEVELS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "grp string, n long, pos long, digest binary"
NOTE = "suffix string, spos long, m long, subroot string, root string"


def H(parts) -> str:
    return sha256("".join(parts).encode("ascii")).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _leaf(text: Column) -> Column:
    values = [text if name == "text" else F.col(name) for name in FIELDS]
    return F.unhex(F.sha2(F.concat(*[_field(v) for v in values]), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, tampered): digests of every row, and of its lower-cased form where 5 divides crc32(doc_id)."""
    lowered = F.translate("text", UPPER, LOWER)
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return docs.select("doc_id", "source", _leaf(F.col("text")).alias("digest"), F.when(struck, _leaf(lowered)).alias("tampered"))


def numbered(rows: DataFrame, grp: Column, order: list[Column]) -> DataFrame:
    """Written rows with grp, pos (from 0, in the order, per group) and n (rows of the group).

    The last key of the sort is the row's number, so that the sampled borders also split rows that are equal in all the others.
    """
    keyed = rows.withColumns({"grp": grp, "_id": F.monotonically_increasing_id()})
    keys = [F.col("grp").asc_nulls_first(), *order, F.col("_id")]
    ranged = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    ranged = written(ranged.withColumns({"_part": F.shiftright("_id", 33), "_row": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id"), "ranged")
    counts = ranged.groupBy("grp", "_part").agg(F.count(F.lit(1)).alias("_c"), F.min("_row").alias("_first"))
    group = Window.partitionBy("grp")
    before = F.coalesce(F.sum("_c").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = counts.select(F.col("grp").alias("_grp"), F.col("_part").alias("_p"), (before - F.col("_first")).alias("_shift"), F.sum("_c").over(group).alias("n"))
    placed = ranged.join(shift, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("_part") == F.col("_p")))
    return written(placed.withColumn("pos", F.col("_row") + F.col("_shift")).drop("_grp", "_part", "_p", "_row", "_shift"), "numbered")


def ascend(digests: list[str], first: int, n: int) -> tuple[dict[tuple[int, int], str], tuple[int, int]]:
    """Digest by label (level, place) of all nodes over one block of a level of n nodes, and the label of the last one."""
    nodes = {(0, first + i): d for i, d in enumerate(digests)}
    width = [n]
    for _ in range(LEVELS):
        width.append(-(-width[-1] // FAN))
    label = (0, first)
    queue = [((1, p // FAN), p % FAN, d) for (_, p), d in nodes.items()] if n > 1 else []
    heapq.heapify(queue)
    while queue:
        label, children = queue[0][0], []
        while queue and queue[0][0] == label:
            children.append(heapq.heappop(queue)[2])
        nodes[label] = H(children)
        level, p = label
        if level < LEVELS and width[level] > 1:
            heapq.heappush(queue, ((level + 1, p // FAN), p % FAN, nodes[label]))
    return nodes, label


def descend(nodes: dict[tuple[int, int], str], top: tuple[int, int], suffix: str) -> Iterator[tuple[int, str]]:
    """(place, proof) of the block's leaves: labels in falling order, each node passes on its children's siblings and its own suffix."""
    queue = [(-top[0], top[1], suffix)]
    while queue:
        level, p, got = heapq.heappop(queue)
        if not level:
            yield p, got
            continue
        children = [nodes[label] for c in range(FAN) if (label := (-level - 1, p * FAN + c)) in nodes]
        for c in range(len(children)):
            heapq.heappush(queue, (level + 1, p * FAN + c, "".join(children[:c] + children[c + 1 :]) + got))


def fold(digest: str, proof: str, at: int, turns: list[tuple[int, int]]) -> str:
    """The root that a leaf and its proof lead to; ``turns`` has (place, width) of the leaf in each tree on the way."""
    for p, n in turns:
        while n > 1:
            slot, others = p % FAN, min(FAN, n - p + p % FAN) - 1
            digest = H((proof[at : at + 64 * slot], digest, proof[at + 64 * slot : at + 64 * others]))
            at += 64 * others
            p, n = p // FAN, -(-n // FAN)
    return digest


def _blocks(batches) -> Iterator[list[dict]]:
    """Rows of one block after another, from batches sorted by (grp, block)."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            k = (row["grp"], row["block"])
            if rows and k != key:
                yield rows
                rows = []
            key = k
            rows.append(row)
    if rows:
        yield rows


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int = 4096):
    got = []
    for row in rows:
        got.append(row)
        if len(got) == most:
            yield pa.RecordBatch.from_pylist(got, schema)
            got = []
    if got:
        yield pa.RecordBatch.from_pylist(got, schema)


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")


def _round(nodes: DataFrame) -> DataFrame:
    """The nodes LEVELS higher, of trees that have more than one."""
    schema = pa.schema([("grp", pa.string()), ("n", pa.int64()), ("pos", pa.int64()), ("digest", pa.binary())])

    def last(rows: list[dict]) -> dict:
        n, pos = rows[0]["n"], rows[0]["pos"]
        done, label = ascend([r["digest"].hex() for r in rows], pos, n)
        return {"grp": rows[0]["grp"], "n": -(-n // BLOCK), "pos": pos // BLOCK, "digest": bytes.fromhex(done[label])}

    def sweep(batches):
        return _batches(map(last, _blocks(batches)), schema)

    more = nodes.where("n > 1").select("grp", "n", "pos", "digest", F.expr(f"pos div {BLOCK}").alias("block"))
    return _by_block(more).mapInArrow(sweep, NODE)


def climb(nodes: DataFrame) -> list[DataFrame]:
    """The nodes, and those after each round until every tree has one."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    rounds = [nodes]
    while most > 1:
        rounds.append(written(_round(rounds[-1]), "nodes"))
        most = -(-most // BLOCK)
    return rounds


def _delivered(nodes: DataFrame, notes: DataFrame, own: list[str], emit, schema: str, arrow: pa.Schema) -> DataFrame:
    """What ``emit(row, note, proof)`` gives for every node; notes hold (grp, block) and come first in their block."""

    def each(batches):
        for note, *rows in _blocks(batches):
            done, label = ascend([r["digest"].hex() for r in rows], rows[0]["pos"], rows[0]["n"])
            for (_, proof), row in zip(sorted(descend(done, label, note["suffix"])), rows):
                yield emit(row, note, proof)

    def sweep(batches):
        return _batches(each(batches), arrow)

    rows = nodes.select("grp", "n", "pos", "digest", F.expr(f"pos div {BLOCK}").alias("block"), *own)
    return _by_block(rows.unionByName(notes.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)).mapInArrow(sweep, schema)


_NOTE = [("suffix", pa.string()), ("spos", pa.int64()), ("m", pa.int64()), ("subroot", pa.string()), ("root", pa.string())]


def deliver(rounds: list[DataFrame], tops: DataFrame, own: list[str], emit, schema: str, arrow: pa.Schema) -> DataFrame:
    """Send the notes of the trees (grp and NOTE) down to the first nodes, round by round; ``emit`` makes the last rows."""
    columns = ["suffix", "spos", "m", "subroot", "root"]

    def passed(row, note, proof):
        return {"grp": row["grp"], "block": row["pos"], **{c: note[c] for c in columns}, "suffix": proof}

    notes = None
    for i, nodes in reversed(list(enumerate(rounds))):
        ended = nodes.where("n = 1").select(F.col("grp").alias("_grp"))
        mine = tops.join(ended, F.col("grp").eqNullSafe(F.col("_grp"))).select("grp", F.lit(0).cast("long").alias("block"), *columns)
        notes = mine if notes is None else notes.unionByName(mine)
        if i:
            got = _delivered(nodes, notes, [], passed, f"grp string, block long, {NOTE}", pa.schema([("grp", pa.string()), ("block", pa.int64()), *_NOTE]))
            notes = written(got, "notes")
    return _delivered(rounds[0], notes, own, emit, schema, arrow)


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, source, pos, n, leaf, subroot, root, proof, proof_sha256, folded_root, verified) of every row."""
    typed = dict(docs.dtypes)["doc_id"]
    found = written(leaves(docs), "leaves").withColumn("source", F.col("source").cast("string"))
    rows = numbered(found, F.col("source"), [F.col("doc_id").asc_nulls_first(), F.col("digest")])
    trees = climb(rows)
    heads = [t.where("n = 1").select("grp", F.col("digest")) for t in trees]
    subroots = heads[0]
    for more in heads[1:]:
        subroots = subroots.unionByName(more)
    above = numbered(subroots.withColumnRenamed("grp", "source"), F.lit(None).cast("string"), [F.col("source").asc_nulls_first()])
    tops = climb(above)

    def of_source(row, note, proof):
        return {"grp": row["source"], "suffix": proof, "spos": row["pos"], "m": row["n"], "subroot": row["digest"].hex(), "root": note["root"]}

    def of_row(row, note, proof):
        leaf, turns = row["digest"].hex(), [(row["pos"], row["n"]), (note["spos"], note["m"])]
        folded = fold((row["tampered"] or row["digest"]).hex(), proof, 0, turns)
        return {"doc_id": row["doc_id"], "source": row["grp"], "pos": row["pos"], "n": row["n"], "leaf": leaf, "subroot": note["subroot"], "root": note["root"],
                "proof": proof, "proof_sha256": H([proof]), "folded_root": folded, "verified": folded == note["root"]}

    start = tops[-1].where("n = 1").select("grp", F.lit("").alias("suffix"), *[F.lit(None).cast(t).alias(c) for c, t in (("spos", "long"), ("m", "long"), ("subroot", "string"))], F.lower(F.hex("digest")).alias("root"))
    notes = written(deliver(tops, start, ["source"], of_source, f"grp string, {NOTE}", pa.schema([("grp", pa.string()), *_NOTE])), "subroots")
    id_type = pa.string() if typed == "string" else pa.int64()
    names = [("doc_id", id_type), ("source", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
             ("proof", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())]
    kinds = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean"}
    rows0 = [trees[0].withColumn("doc_id", F.col("doc_id").cast(kinds[id_type])), *trees[1:]]
    return deliver(rows0, notes, ["doc_id", "tampered"], of_row, ", ".join(f"{c} {kinds[t]}" for c, t in names), pa.schema(names))


def _sql_field(name: str, value: str | None = None) -> str:
    value = value or name
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen(cast({value} AS varchar)) || ':' || cast({value} AS varchar) END"


def _sql_leaf(text: str) -> str:
    return "sha256(concat(" + ", ".join(_sql_field(f, text if f == "text" else None) for f in FIELDS) + "))"


# Trees are built level by level; crc32 is worked out byte by byte; the proof is the list of siblings by level and place.
SQL = f"""WITH RECURSIVE
crc(id, s, i, c) AS (SELECT DISTINCT doc_id, cast(doc_id AS varchar), 1, 4294967295::bigint FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT id, s, i + 1, list_reduce(range(8), lambda a, x: xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384::bigint ELSE 0::bigint END),
    xor(c, ascii(substr(s, i, 1))::bigint)) FROM crc WHERE i <= length(s)),
struck AS (SELECT id FROM crc WHERE i > length(s) AND xor(c, 4294967295::bigint) % 5 = 0),
l0 AS (SELECT doc_id, source, {_sql_leaf("text")} AS leaf, {_sql_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} AS low FROM documents),
l1 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY source) AS n FROM l0),
tree(source, level, p, n, d) AS (SELECT source, 0, p, n, leaf FROM l1
  UNION ALL SELECT source, level + 1, p // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY p)) FROM tree WHERE n > 1 GROUP BY source, level, n, p // 16),
sub AS (SELECT source, level AS depth, d AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS sp, count(*) OVER () AS m FROM tree WHERE n = 1),
above(level, p, n, d) AS (SELECT 0, sp, m, subroot FROM sub
  UNION ALL SELECT level + 1, p // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY p)) FROM above WHERE n > 1 GROUP BY level, n, p // 16),
walk(rid, source, sp, depth, d, level, p, n, m, proof) AS (
  SELECT row_number() OVER (), l1.source, sp, depth, CASE WHEN l1.doc_id IN (SELECT id FROM struck) THEN low ELSE leaf END, 0, p, n, m,
    struct_pack(doc_id := doc_id, leaf := leaf, subroot := subroot, proof := '') FROM l1 JOIN sub ON l1.source IS NOT DISTINCT FROM sub.source
  UNION ALL
  SELECT rid, walk.source, sp, depth, sha256(before || walk.d || after), walk.level + 1, walk.p // 16, (walk.n + 15) // 16, m,
    struct_pack(doc_id := proof.doc_id, leaf := proof.leaf, subroot := proof.subroot, proof := proof.proof || before || after)
  FROM walk JOIN (SELECT t.source, t.level, t.p, coalesce(string_agg(o.d, '' ORDER BY o.p) FILTER (o.p < t.p), '') AS before,
      coalesce(string_agg(o.d, '' ORDER BY o.p) FILTER (o.p > t.p), '') AS after
    FROM tree t JOIN tree o ON t.source IS NOT DISTINCT FROM o.source AND t.level = o.level AND t.p // 16 = o.p // 16 GROUP BY ALL) b
  ON walk.source IS NOT DISTINCT FROM b.source AND walk.level = b.level AND walk.p = b.p WHERE walk.n > 1),
up(rid, d, level, p, n, proof) AS (SELECT rid, d, 0, sp, m, proof FROM walk WHERE n = 1
  UNION ALL
  SELECT rid, sha256(before || up.d || after), up.level + 1, up.p // 16, (up.n + 15) // 16,
    struct_pack(doc_id := proof.doc_id, leaf := proof.leaf, subroot := proof.subroot, proof := proof.proof || before || after)
  FROM up JOIN (SELECT t.level, t.p, coalesce(string_agg(o.d, '' ORDER BY o.p) FILTER (o.p < t.p), '') AS before,
      coalesce(string_agg(o.d, '' ORDER BY o.p) FILTER (o.p > t.p), '') AS after
    FROM above t JOIN above o ON t.level = o.level AND t.p // 16 = o.p // 16 GROUP BY ALL) b ON up.level = b.level AND up.p = b.p WHERE up.n > 1)
SELECT proof.doc_id AS doc_id, proof.leaf AS leaf, proof.subroot AS subroot, root, sha256(proof.proof) AS proof_sha256, d AS folded_root, d = root AS verified
FROM up CROSS JOIN (SELECT d AS root FROM above WHERE n = 1) WHERE up.n = 1"""


@query("op11_merkle_sweep", SQL)
def op11(spark, sf_dir):
    return manifest(table(spark, sf_dir, "documents")).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
