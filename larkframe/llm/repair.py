"""Token ids in files, compressed by Re-Pair grammars, one per block of documents.

In a block the most frequent pairs of neighbouring ids are replaced by new symbols, again and again; pairs never reach
across documents. A round replaces many pairs at once, chosen by count so that no symbol is the left part of one and the
right part of another, which rules out overlaps. The rules and the length of every symbol's expansion are stored beside the
symbols, so a document, or any range of its ids, is decoded by finding its symbols in the summed lengths and expanding only those.

File format: Parquet rows, one per block, written by Spark's committer. Numbers are little-endian unsigned 32-bit.
shard, block        place in the order of doc_id
doc_ids             array, in order
doc_tokens          ids per document
doc_symbols         symbols per document
base                first symbol that is a rule
rounds              rules per round
rules               left and right part of each rule
rule_lengths        ids under each rule
symbols             the compressed documents one after the other

Defined cases: a null text is an empty one, so its document is the end id alone; documents without doc_id come last; rows
that repeat a doc_id stay, ordered by text hash; other columns are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkframe.llm.common import keyed
from larkframe.llm.registry import query, table
from larkframe.llm.tokens import description_of, word_encoder
from larkframe.session import new_folder

BLOCK_IDS = 1 << 19
ROUNDS = 8
OFTEN = 24  # a pair is replaced when a block has it so many times
_U4 = "<u4"
_HALF, _RIGHT = np.uint64(32), np.uint64(0xFFFFFFFF)  # a pair is one number, its left part in the upper half
_SPREAD, _BUCKETS = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - 18)  # a product's upper 18 bits are the pair's bucket
BLOCK_ROW = (
    "shard long, block long, doc_ids array<long>, doc_tokens binary, doc_symbols binary, base long, rounds array<int>, "
    "rules binary, rule_lengths binary, symbols binary"
)


def _disjoint(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of the pairs, most frequent first, those whose left part is no chosen right part and the reverse."""
    left, right, chosen = set(), set(), []
    order = np.lexsort((pairs, -counts))
    for i, (a, b) in zip(order.tolist(), zip((pairs[order] >> _HALF).tolist(), (pairs[order] & _RIGHT).tolist())):
        if a != b and a not in right and b not in left:
            left.add(a)
            right.add(b)
            chosen.append(i)
    return np.sort(pairs[chosen])


def _bucket(pairs: np.ndarray) -> np.ndarray:
    return ((pairs * _SPREAD) >> _BUCKETS).view(np.int64)


def _places(known: np.ndarray, key: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Where each key stands among the known pairs, which ascend; -1: nowhere. Only pairs that share a bucket are searched for."""
    holder = np.zeros(1 << 18, dtype=np.int64)
    holder[_bucket(known)] = np.arange(len(known))
    place = holder.take(bucket)
    other = np.flatnonzero(known.take(place) != key)
    found = np.minimum(np.searchsorted(known, key[other]), len(known) - 1)
    place[other] = np.where(known[found] == key[other], found, -1)
    return place


def compress(ids: np.ndarray, doc_tokens: np.ndarray, rounds: int = ROUNDS, often: int = OFTEN) -> dict:
    """The grammar of one block; ids are unsigned 32-bit numbers.

    A pair that is rare in one round stays rare: replacing only takes places from pairs of older symbols. So a round looks at the
    pairs that were frequent in the round before and at those with a new symbol."""
    seq = ids.astype(np.uint64)
    base = int(seq.max()) + 1 if len(seq) else 1
    ends = np.cumsum(doc_tokens)  # where documents end, empty ones too
    rules, lengths, sizes = [], np.ones(base, dtype=np.int64), []
    maybe = np.ones(len(seq), dtype=bool)  # where a frequent pair may begin
    for _ in range(rounds):
        maybe[ends[ends > 0] - 1] = False  # never across documents
        at = np.flatnonzero(maybe)
        key = (seq.take(at) << _HALF) | seq.take(at + 1)
        bucket = _bucket(key)
        full = np.flatnonzero((np.bincount(bucket) >= often).take(bucket))  # a frequent pair fills its bucket: others need no sorting
        at, key, bucket = at.take(full), key.take(full), bucket.take(full)
        ordered = np.sort(key)
        cut = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
        cut = np.concatenate(([0], cut)) if len(ordered) else cut
        count = np.diff(np.append(cut, len(ordered)))
        frequent = count >= often
        if not frequent.any():
            break
        known = ordered[cut[frequent]]
        pairs = _disjoint(known, count[frequent])
        if not len(pairs):
            break
        a, b = (pairs >> _HALF).astype(np.int64), (pairs & _RIGHT).astype(np.int64)
        place = _places(known, key, bucket)
        hit = np.flatnonzero(place >= 0)
        at, place = at.take(hit), place.take(hit)
        rule = np.full(len(known), -1)
        rule[np.searchsorted(known, pairs)] = np.arange(len(pairs))
        rule = rule.take(place)
        hit = np.flatnonzero(rule >= 0)
        new = at.take(hit)
        seq[new] = len(lengths) + rule.take(hit)
        keep, maybe = np.ones(len(seq), dtype=bool), np.zeros(len(seq), dtype=bool)
        keep[new + 1] = False
        maybe[at] = maybe[np.maximum(new, 1) - 1] = True
        left = np.flatnonzero(keep)
        seq, maybe, ends = seq.take(left), maybe.take(left), ends - np.searchsorted(new + 1, ends)
        rules.append(np.stack([a, b], axis=1))
        sizes.append(len(pairs))
        lengths = np.concatenate([lengths, lengths[a] + lengths[b]])
    full = np.diff(ends, prepend=0)
    return {
        "doc_tokens": doc_tokens.astype(_U4).tobytes(), "doc_symbols": full.astype(_U4).tobytes(), "base": base, "rounds": sizes,
        "rules": (np.concatenate(rules) if rules else np.zeros((0, 2))).astype(_U4).tobytes(),
        "rule_lengths": lengths[base:].astype(_U4).tobytes(), "symbols": seq.astype(_U4).tobytes()}


def expand(block: dict, symbols: np.ndarray) -> np.ndarray:
    """The ids under the symbols; the rules of the last round are undone first."""
    rules = np.frombuffer(block["rules"], _U4).reshape(-1, 2)
    top = block["base"] + len(rules)
    for n in reversed(list(block["rounds"])):
        top -= n
        rule = symbols >= top
        out = np.repeat(symbols, 1 + rule)
        at = np.flatnonzero(rule) + np.arange(int(rule.sum()))
        parts = rules[symbols[rule].astype(np.int64) - block["base"]]
        out[at], out[at + 1] = parts[:, 0], parts[:, 1]
        symbols = out
    return symbols


def expand_all(block: dict, at_once: int = 1 << 14) -> np.ndarray:
    """The ids of a whole block: every rule is expanded once, and its ids are copied to where its symbol stands, ``at_once`` symbols at a time."""
    symbols = np.frombuffer(block["symbols"], _U4)
    lengths = np.frombuffer(block["rule_lengths"], _U4).astype(np.int64)
    under = expand(block, np.arange(block["base"], block["base"] + len(lengths), dtype=_U4))
    begins, out = np.cumsum(lengths) - lengths, [np.zeros(0, dtype=_U4)]
    for low in range(0, len(symbols), at_once):
        some = symbols[low : low + at_once]
        rule = some >= block["base"]
        at = some[rule].astype(np.int64) - block["base"]
        each = np.ones(len(some), dtype=np.int64)
        each[rule] = size = lengths[at]
        got = np.repeat(some, each)
        got[np.repeat(rule, each)] = under[np.repeat(begins[at] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        out.append(got)
    return np.concatenate(out)


def ids_of(block: dict, doc: int, start: int = 0, n: int | None = None) -> np.ndarray:
    """Ids start to start + n of the doc-th document of a block, expanding only the symbols that hold them."""
    ends = np.cumsum(np.frombuffer(block["doc_symbols"], _U4), dtype=np.int64)
    size = np.frombuffer(block["doc_symbols"], _U4)[doc]
    symbols = np.frombuffer(block["symbols"], _U4)[ends[doc] - size : ends[doc]]
    lengths = np.frombuffer(block["rule_lengths"], _U4)
    rule = symbols >= block["base"]
    each = np.ones(len(symbols), dtype=np.int64)
    each[rule] = lengths[symbols[rule].astype(np.int64) - block["base"]]
    total = np.concatenate(([0], np.cumsum(each)))
    stop = int(total[-1]) if n is None else min(start + n, int(total[-1]))
    if start >= stop:
        return np.zeros(0, dtype=np.uint32)
    low, high = int(np.searchsorted(total, start, "right")) - 1, int(np.searchsorted(total, stop))
    got = expand(block, symbols[low:high])
    return got[start - int(total[low]) : stop - int(total[low])]


def encoded(encoder, batches, at_once: int = 1 << 21):
    """(doc_id, ids) of all rows in order; texts go to the encoder together until they have ``at_once`` characters."""
    names, texts, held = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            names.append(None if pd.isna(doc_id) else int(doc_id))
            texts.append(text if isinstance(text, str) else "")
            held += len(texts[-1])
            if held >= at_once:
                yield from zip(names, encoder.encode_all(texts))
                names, texts, held = [], [], 0
    yield from zip(names, encoder.encode_all(texts))


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int = 2, block_ids: int = BLOCK_IDS) -> None:
    """Encode all documents in ascending order of doc_id and write the blocks."""
    description = description_of(path)

    def run(batches):
        encoder, shard, number = word_encoder(description), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype=_U4).tobytes()
        names, parts, held = [], [], 0

        def block() -> pd.DataFrame:
            sizes = np.array([len(p) // 4 for p in parts], dtype=np.int64)
            row = compress(np.frombuffer(b"".join(parts), _U4), sizes)
            return pd.DataFrame([{"shard": shard, "block": number, "doc_ids": list(names), **row}])

        for doc_id, ids in encoded(encoder, batches):
            names.append(doc_id)
            parts.append(ids + end)
            held += len(parts[-1]) // 4
            if held >= block_ids:
                yield block()
                names, parts, held, number = [], [], 0, number + 1
        if parts:
            yield block()

    order = [F.col("doc_id").asc_nulls_last(), "k"]
    rows = keyed(docs).repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    rows.mapInPandas(run, BLOCK_ROW).write.option("compression", "zstd").parquet(folder)


def read_ids(spark: SparkSession, folder: str, columns: dict[str, tuple[str, object]]) -> DataFrame:
    """One row per document: its block, doc_id, ids before it in the block, n_tokens and, by name, what each function of ``columns`` makes of its ids."""
    blocks = spark.read.parquet(folder)

    def run(batches):
        for batch in batches:
            for row in batch.to_dict("records"):
                tokens = np.frombuffer(row["doc_tokens"], _U4).astype(np.int64)
                ids = expand_all(row)
                ends = np.cumsum(tokens)
                frame = pd.DataFrame({
                    "shard": row["shard"], "block": row["block"], "doc_id": pd.Series(list(row["doc_ids"]), dtype="Int64"),
                    "before": ends - tokens, "n_tokens": tokens})
                for name, (_, make) in columns.items():
                    frame[name] = [make(ids[e - n : e]) for e, n in zip(ends, tokens)]
                yield frame

    made = "".join(f", {name} {kind}" for name, (kind, _) in columns.items())
    return blocks.mapInPandas(run, f"shard long, block long, doc_id long, before long, n_tokens long{made}")


def starts(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, block, ahead): ids before each block; one row per shard goes through one ordered window."""

    def total(batches):
        for batch in batches:
            yield pd.DataFrame({
                "shard": batch["shard"], "block": batch["block"],
                "n": [int(np.frombuffer(x, _U4).sum(dtype=np.int64)) for x in batch["doc_tokens"]]})

    sizes = spark.read.parquet(folder).select("shard", "block", "doc_tokens").mapInPandas(total, "shard long, block long, n long")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shards"))
    within = sizes.select("shard", "block", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("blocks"))
    return within.join(shards, "shard").select("shard", "block", (F.col("shards") + F.col("blocks")).alias("ahead"))


def documents_of(spark: SparkSession, folder: str, columns: dict[str, tuple[str, object]]) -> DataFrame:
    """(doc_id, start, n_tokens, ...) of all documents in the files; start counts the ids of all documents before."""
    rows = read_ids(spark, folder, columns).join(starts(spark, folder), ["shard", "block"])
    return rows.select("doc_id", (F.col("ahead") + F.col("before")).alias("start"), "n_tokens", *columns)


@query("op9_repair_ids")
def op9(spark, sf_dir):
    import public_tokenizers

    folder = new_folder(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)
    return documents_of(spark, folder, {"ids_crc32": ("long", lambda ids: zlib.crc32(ids.tobytes()))})
