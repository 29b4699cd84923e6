"""Numbered records of text files whose records are not lines: delimited rows with quoted line breaks, JSON arrays and documents.

Spark reads the files in splits, cut at a separator that ends every record (a line break, a closing brace). Whether such a cut
ends a record depends on all text before it: on open quotes and on nesting. So a first pass gives, for every split, what it does
to that state from either side of a quote, and how many records end in it at which depth: one row per split, which the driver
chains in file order. The second pass starts every split with its true state and number, and gives whole records; the pieces
of a record that lies over a border are put together by its number. Nothing is read in one task, however long a file is.

Defined cases: blank lines between delimited rows do not count; empty files have no records; a quote that is never closed makes
the rest of its file one record; files are taken in the order of their paths. JSON records are the objects inside ``level``
arrays or objects; anything else at that level is passed over; of a file that is cut off inside a record, the last record holds
what is there, or nulls.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LINE, BRACE = "\n", "}"


def pieces(spark: SparkSession, path: str | list[str], sep: str) -> DataFrame:
    """(file, block, value): the texts between separators, in their order inside every split."""
    return spark.read.option("lineSep", sep).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batches) -> Iterator[tuple[tuple[str, int], list[bytes], bool]]:
    """((file, block), pieces, first of the split?) for every run of pieces of one split."""
    seen = None
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("block").to_numpy()
        file = batch.column("file").to_pylist()
        cuts = [i for i in range(1, len(block)) if block[i] != block[i - 1] or file[i] != file[i - 1]]
        values = batch.column("value").cast(pa.binary()).to_pylist()
        for a, b in zip([0] + cuts, cuts + [len(block)]):
            key = (file[a], int(block[a]))
            yield key, values[a:b], key != seen
            seen = key


class Scan:
    """State after every piece of a run: inside quotes or not, and depth against the start of the run, for a start outside
    (0) or inside (1) quotes."""

    def __init__(self, values: list[bytes], nested: bool):
        sep = (BRACE if nested else LINE).encode()
        buffer = sep.join(values) + sep
        self.c = c = np.frombuffer(buffer, dtype=np.uint8)
        self.ends = np.cumsum([len(v) + 1 for v in values]) - 1
        quote = np.flatnonzero(c == 34)
        if nested and len(quote):  # a quote after an odd number of backslashes is part of its string
            place = np.arange(len(c))
            other = np.maximum.accumulate(np.where(c == 92, -1, place))
            run = np.where(quote > 0, quote - 1 - other[quote - 1], 0)
            quote = quote[run % 2 == 0]
        flips = np.zeros(len(c), dtype=np.int8)
        flips[quote] = 1
        self.quoted = np.cumsum(flips, dtype=np.int64) & 1
        self.nested = nested
        self.step = None
        if nested:
            self.step = np.isin(c, (123, 91)).astype(np.int64) - np.isin(c, (125, 93))
        self.blank = np.zeros(len(values), dtype=bool) if nested else np.array([not v.strip(b"\r") for v in values])

    def depth(self, start: int) -> np.ndarray:
        return np.cumsum(np.where(self.quoted == start, self.step, 0)) if self.nested else np.zeros(len(self.c), dtype=np.int64)

    def after(self, start: int) -> tuple[np.ndarray, np.ndarray]:
        return self.quoted[self.ends] ^ start, self.depth(start)[self.ends]


SPLIT = "file string, block long, start int, finish int, change long, depth long, n long"


def split_effects(parts: DataFrame, nested: bool) -> DataFrame:
    """Rows of a split and a start state: the state at its end, its change of depth, and the records that would end at each depth."""

    def effects(batches):
        key, state, depth, ended = None, [0, 1], [0, 0], [{}, {}]

        def rows():
            out = [(*key, s, state[s], depth[s], d, n) for s in (0, 1) for d, n in (ended[s] or {0: 0}).items()]
            return pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["file", "block", "start", "finish", "change", "depth", "n"]).astype(
                {"start": "int32", "finish": "int32"}), preserve_index=False)

        for now, values, first in _runs(batches):
            if first:
                if key is not None:
                    yield rows()
                key, state, depth, ended = now, [0, 1], [0, 0], [{}, {}]
            scan = Scan(values, nested)
            for s in (0, 1):
                inside, level = scan.after(state[s])
                at, n = np.unique(level[(inside == 0) & ~scan.blank] + depth[s], return_counts=True)
                for d, k in zip(at.tolist(), n.tolist()):
                    ended[s][d] = ended[s].get(d, 0) + k
                state[s], depth[s] = int(inside[-1]), depth[s] + int(level[-1])
        if key is not None:
            yield rows()

    return parts.mapInArrow(effects, SPLIT)


def _chain(effects: list, level: int, header: bool, within: Callable[[int, int], bool]) -> tuple[dict, bool]:
    """Start of every split (state, depth, records before it in its file, records of earlier files), and whether any record
    lies over a border. One entry per split."""
    table: dict = {}
    for e in effects:
        way = table.setdefault((e["file"], e["block"]), {}).setdefault(e["start"], [e["finish"], e["change"], {}])
        way[2][e["depth"]] = e["n"]
    starts, over, base, file = {}, False, 0, None
    state = depth = before = 0
    for key in sorted(table):
        if key[0] != file:
            if file is not None:
                base += max(before + int(within(state, depth)) - int(header), 0)
            file, state, depth, before = key[0], 0, 0, 0
        starts[key] = (state, depth, before, base)
        finish, change, ended = table[key][state]
        before += ended.get(level - depth, 0)
        state, depth = finish, depth + change
        over |= within(state, depth)
    return starts, over


def read_records(spark: SparkSession, path: str, nested: bool = False, level: int = 0, header: bool = False) -> DataFrame:
    """(number, text): the records of the files, numbered from 1 over all files in the order of their paths.

    ``header`` leaves out the first record of every file. The driver holds one entry per split, as its file listing does.
    """
    parts = pieces(spark, path, BRACE if nested else LINE)

    def _within(state: int, depth: int) -> bool:
        """Is a place with this state inside a record?"""
        return depth > level if nested else state == 1

    starts, over = _chain(split_effects(parts, nested).collect(), level, header, _within)  # some rows per split
    starts = spark.sparkContext.broadcast(starts)
    schema = "number long, block long, opened boolean, whole boolean, text string"

    def stitch(batches):
        state = depth = number = base = 0
        held: list[bytes] = []
        opened, whole, key = False, True, None
        out: list[tuple] = []

        def put(complete: bool):
            if header and number == 0:
                return
            text = b"".join(held)
            if complete and not nested:
                text = text.removesuffix(b"\n").removesuffix(b"\r")
            out.append((base + number + 1 - int(header), key[1], opened, complete, text))

        def rows():
            cols = list(zip(*out))
            arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.bool_()), pa.array(cols[3], pa.bool_()),
                      pa.array([t.decode("utf-8", "replace") for t in cols[4]], pa.string())]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["number", "block", "opened", "whole", "text"])

        for now, values, first in _runs(batches):
            if first:
                if held:
                    put(False)
                key = now
                state, depth, number, base = starts.value[key]
                held, opened, whole = [], False, key[1] == 0 or not _within(state, depth)
            scan = Scan(values, nested)
            inside, rel = scan.after(state)
            done = (inside == 0) & (rel + depth == level) & ~scan.blank
            if nested:
                opens = np.flatnonzero((scan.c == 123) & (scan.quoted == state) & (scan.depth(state) + depth == level + 1))
                last = np.searchsorted(opens, scan.ends, side="right") - 1
            quiet = (inside == 0) & scan.blank
            begin = 0
            for i, value in enumerate(values):
                if nested:
                    if last[i] >= 0 and opens[last[i]] >= begin:
                        held, opened = [], True
                        value = value[opens[last[i]] - begin :]
                    if opened or not whole:
                        held.append(value + b"}")
                    begin = int(scan.ends[i]) + 1
                elif quiet[i] and not held:
                    continue
                else:
                    opened = True
                    held.append(value + b"\n")
                if done[i]:
                    put(whole)
                    number += 1
                    held, opened, whole = [], False, True
            state, depth = int(inside[-1]), depth + int(rel[-1])
            if out:
                yield rows()
        if held:
            put(False)
        if out:
            yield rows()

    got = parts.mapInArrow(stitch, schema)
    complete = got.where("whole").select("number", "text")
    if not over:
        return complete
    # Pieces of one record, in order; what comes before the last opening is not part of it.
    joined = got.where("NOT whole").groupBy("number").agg(F.sort_array(F.collect_list(F.struct("block", "opened", "text"))).alias("p"))
    if nested:
        start = F.array_max(F.transform("p", lambda p, i: F.when(p["opened"], i)))
        joined = joined.withColumn("at", start).where("at IS NOT NULL").withColumn("p", F.expr("slice(p, at + 1, size(p))"))
    text = F.array_join(F.transform("p", lambda p: p["text"]), "")
    if not nested:
        text = F.regexp_replace(text, r"\r?\n$", "")
    return complete.unionByName(joined.select("number", text.alias("text")))


def parse_delim(records: DataFrame, schema: str, sep: str = ",") -> DataFrame:
    """number and the columns of delimited records; doubled quotes inside quotes are one quote."""
    parsed = F.from_csv("text", F.lit(schema), {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true"})
    return records.select("number", parsed.alias("r")).select("number", "r.*")


def read_numbered(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True) -> DataFrame:
    """Delimited rows with their number in the file order, from 1."""
    return parse_delim(read_records(spark, path, header=header), schema, sep)


def read_chunked(
    spark: SparkSession, path: str, schema: str, callback: Callable[[pd.DataFrame, int], pd.DataFrame], result: str,
    size: int = 10_000, sep: str = ",", header: bool = True,
) -> DataFrame:
    """The results of ``callback(rows, number of the first row)`` for every ``size`` rows in file order, put together.

    A chunk is what one call sees; chunks are spread over all tasks and may run in any order.
    """
    rows = read_numbered(spark, path, schema, sep, header)

    def call(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values("number", ignore_index=True)
        return callback(chunk.drop(columns=["number", "_chunk"]), int(chunk["number"].iloc[0]))

    return rows.withColumn("_chunk", F.floor((F.col("number") - 1) / size)).groupBy("_chunk").applyInPandas(call, result)


def preview(spark: SparkSession, path: str, schema: str, n_max: int = 5, sep: str = ",", header: bool = True) -> DataFrame:
    """The first ``n_max`` rows in file order, read from the front: one task per file, which stops when it has them.

    For a look at the head of a table; a large number of rows is better taken from ``read_numbered`` by number.
    """
    out, left = None, n_max
    for file in sorted(spark.read.text(path).inputFiles()):
        def head(batches, left=left):
            held, odd, skip, n, at = [], 0, header, 0, -1
            for (_, block), values, first in _runs(batches):
                if first and block < at:
                    raise ValueError("splits of the file are not in order")
                at = block
                for v in values:
                    if not held and not v.strip(b"\r"):
                        continue
                    held.append(v)
                    odd ^= v.count(b'"') & 1
                    if odd:
                        continue
                    text, held = b"\n".join(held), []
                    if skip:
                        skip = False
                        continue
                    n += 1
                    yield pa.RecordBatch.from_pydict({"number": [n], "text": [text.removesuffix(b"\r").decode("utf-8", "replace")]})
                    if n == left:
                        return
            if held and not skip:
                yield pa.RecordBatch.from_pydict({"number": [n + 1], "text": [b"\n".join(held).decode("utf-8", "replace")]})

        rows = pieces(spark, file, LINE).coalesce(1).mapInArrow(head, "number long, text string").limit(left)
        rows = rows.withColumn("number", F.col("number") + (n_max - left))
        found = rows.count()
        out = rows if out is None else out.unionByName(rows)
        left -= found
        if left <= 0:
            break
    if out is None:
        out = spark.createDataFrame([], "number long, text string")
    return parse_delim(out, schema, sep)


def read_json_records(spark: SparkSession, path: str, schema: str | StructType, level: int = 1) -> DataFrame:
    """number and the fields of JSON objects: ``level`` 0 for documents one after another, 1 for the elements of an array,
    2 for the elements of the arrays that are fields of a document."""
    records = read_records(spark, path, nested=True, level=level)
    return records.select("number", F.from_json("text", schema).alias("r")).select("number", "r.*")
