"""Best-fit packing of documents into token sequences, online and with bounded space.

Every task reads its documents once. It keeps at most OPEN sequences open, in a bitset with one bit per amount of
free space: the lowest set bit at or above a piece's length is the tightest fit. When one too many is open, the fullest closes.
Pieces leave the task at once with their sequence and place, so memory does not grow with the input, and nothing is shuffled.

A document is its ids and the end id. Only documents longer than a sequence are cut: into full pieces, of which the first may be
shorter.

Defined cases: a null text is empty, so its document is the end id alone; repeated rows are packed row by row; other columns
are not looked at. Sequence numbers hold the task's number and are unique, not dense.
"""

from __future__ import annotations

from contextlib import closing, nullcontext

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkframe.llm.common import lean
from larkframe.llm.registry import query, table
from larkframe.llm.tokens import CACHE, ByteLevelEncoder, byte_encoder, description_of

LENGTH = 2048
OPEN = 1024
PIECES = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"


class Bins:
    """Open sequences by free space."""

    def __init__(self, size: int, most: int, first_number: int = 0):
        self.size, self.most, self.number = size, most, first_number
        self.free = 0  # bit f: some open sequence has f places free
        self.at: list[list[int]] = [[] for _ in range(size + 1)]
        self.open = 0

    def put(self, length: int) -> tuple[int, int]:
        """Sequence and offset for a piece of 1 to ``size`` ids."""
        fits = self.free >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            sequence = self.at[room].pop()
            self.open -= 1
            if not self.at[room]:
                self.free ^= 1 << room
        else:
            room, sequence = self.size, self.number
            self.number += 1
        left = room - length
        if left:
            self.at[left].append(sequence)
            self.free |= 1 << left
            self.open += 1
            if self.open > self.most:
                fullest = (self.free & -self.free).bit_length() - 1
                self.at[fullest].pop(0)
                self.open -= 1
                if not self.at[fullest]:
                    self.free ^= 1 << fullest
        return sequence, self.size - room


def pieces_of(n: int, size: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    first = (n - 1) % size + 1
    return [(0, first), *((s, size) for s in range(first, n, size))]


def pack(docs: DataFrame, path: str, end_id: int = 0, size: int = LENGTH, most_open: int = OPEN, cache: int = CACHE, keep: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), sequence_id, offset.

    With ``keep`` a Python worker's caches stay warm from task to task; without it they are given back when a task ends.
    """
    description = description_of(path)

    @lean
    def run(batches):
        bins = Bins(size, most_open, TaskContext.get().partitionId() << 36)
        end = np.array([end_id], dtype="<u4").tobytes()
        with nullcontext(byte_encoder(description, cache)) if keep else closing(ByteLevelEncoder(description, cache=cache)) as encoder:
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch["doc_id"], batch["text"]):
                    ids = encoder.encode(text if isinstance(text, str) else "") + end
                    for piece, (start, length) in enumerate(pieces_of(len(ids) // 4, size)):
                        rows.append((doc_id, piece, start, length, ids[4 * start : 4 * (start + length)], *bins.put(length)))
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"])
                yield out.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(run, PIECES)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, lengths): the packed sequences themselves, with the lengths of their pieces in order."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return packed.groupBy("sequence_id").agg(inside.alias("p")).select(
        "sequence_id",
        F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.transform("p", lambda x: x["length"]).alias("lengths"))


@query("op6_online_best_fit")
def op6(spark, sf_dir):
    import public_tokenizers

    got = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keep=True)
    return got.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
