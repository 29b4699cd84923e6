"""Document fingerprints from improbable byte windows: the rarest windows by entropy go into chained Bloom filters.

Every 32 bytes in a row are a window, its entropy one of 1,001 levels. ``rarity`` counts the levels over all windows of all documents and
orders them, rarest first; levels under ``FLOOR`` (little but one byte) come last. Among 32 windows that follow each other the rarest, the
first of equal ones, gets a vote; windows with at least eight votes are features. The rarest window of a text always has 32, so every text
but the empty one has a feature. Features go, in text order and each once, into Bloom filters of 2,048 bits, five bits each, a new filter
after every 128. The fingerprint is the filters in base 64, before each the number of its features.

Likeness of two fingerprints: every filter is compared with all filters of the other; the overlap of bits is scaled so that the overlap expected
of unrelated filters is 0 and that of equal ones 1; the best counts, weighted by features, over both sides. Equal fingerprints have 1.

``edited`` needs the next document in falling doc_id. One range sort brings neighbours together, a task walks its part in order,
and what stands at the borders (two rows per part) is joined by the number of the part: no window over the whole table, one move of the texts.

Defined cases: null texts are empty, the empty fingerprint is like itself (1) and unlike all others (0); a text under 32 bytes has one
feature, itself; null doc_ids come last in falling order, rows under one doc_id by their text; the document after the last is the first,
so a table of one row is its own neighbour. Texts are worked through in pieces of 2^19 bytes, so long ones need no more memory than
their own size a few times over. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from base64 import b64decode, b64encode
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkframe.llm.common import mix, written
from larkframe.llm.registry import query, table

SPAN = 32  # bytes of a window, and windows of a vote
VOTES = 8
LEVELS = 1001
FLOOR = 100
BITS, EACH, FULL = 2048, 5, 128
PIECE = 1 << 19
PAD = 0xFF  # never a byte of UTF-8

_c = np.arange(SPAN + 1, dtype=float)
_WEIGHT = _c * np.log2(np.maximum(_c, 1))
#: What one more of the same byte adds to the sum of c log2(c) over the bytes of a window, in units of 2^-16: whole numbers add up exactly.
_STEP = np.round(np.diff(_WEIGHT, prepend=0.0) * 65536).astype(np.int32)
_SUMMED = int(_STEP.sum())


def entropy_levels(b: np.ndarray) -> np.ndarray:
    """Level of the window that begins at every place of b but the last SPAN - 1."""
    n = len(b)
    later, earlier = np.ones(n, dtype=np.uint8), np.ones(n, dtype=np.uint8)
    for lag in range(1, SPAN):
        same = (b[lag:] == b[:-lag]).view(np.uint8)
        later[: n - lag] += same
        earlier[lag:] += same
    total = np.cumsum(_STEP[earlier], dtype=np.int64)
    total[SPAN:] -= np.cumsum(_STEP[later[:-SPAN]], dtype=np.int64)
    return ((_SUMMED - total[SPAN - 1 :]) * (LEVELS - 1) // _SUMMED).clip(0, LEVELS - 1).astype(np.int32)


def _padded(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces (bytes, text, first, last): of text ``text[i]`` the windows at places first[i] <= p < last[i] of these bytes belong to this piece.

    Short texts share a piece, with so many pads between them that neither a window nor a vote reaches two. A long text is cut into pieces that
    overlap by what the votes of their windows depend on.
    """
    gap, reach = b"\xff" * (2 * SPAN), 2 * SPAN
    parts, owner, first, last, at = [gap], [], [], [], 2 * SPAN

    def out():
        return np.frombuffer(b"".join(parts), dtype=np.uint8), np.array(owner), np.array(first), np.array(last)

    for i, text in enumerate(texts):
        windows = max(len(text) - SPAN + 1, 1) if text else 0
        for begin in range(0, windows, PIECE):
            end = min(begin + PIECE, windows)
            a = max(begin - reach, 0)
            cut = text[a : end + reach + SPAN]
            if at + len(cut) > PIECE + 4 * reach and owner:
                yield out()
                parts, owner, first, last, at = [gap], [], [], [], 2 * SPAN
            owner.append(i)
            first.append(at + begin - a)
            last.append(at + end - a)
            parts += [cut, gap]
            at += len(cut) + len(gap)
    if owner:
        yield out()


def level_counts(texts: list[bytes]) -> np.ndarray:
    out = np.zeros(LEVELS, dtype=np.int64)
    for b, _, first, last in _padded(texts):
        mine = np.zeros(len(b) + 1, dtype=np.int8)
        np.add.at(mine, first, 1)
        np.add.at(mine, last, -1)
        levels = entropy_levels(b)
        out += np.bincount(levels[np.cumsum(mine[: len(levels)], dtype=np.int8) > 0], minlength=LEVELS)
    return out


def order_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each level, 0 the rarest; of equally rare ones the higher level first; levels under FLOOR after all others."""
    level = np.arange(LEVELS)
    rank = np.empty(LEVELS, dtype=np.int32)
    rank[np.lexsort((-level, counts, level < FLOOR))] = level
    return rank


def features(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """64-bit hashes of the features of every text, in text order."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for b, owner, first, last in _padded(texts):
        n = len(b) - SPAN + 1
        valid = np.zeros(len(b) + 1, dtype=np.int8)
        lead = np.concatenate([[0], np.flatnonzero((b[1:] != PAD) & (b[:-1] == PAD)) + 1])[1:]  # where the texts of this piece begin
        tail = np.flatnonzero((b[1:] == PAD) & (b[:-1] != PAD)) + 1
        np.add.at(valid, lead, 1)
        np.add.at(valid, np.maximum(tail - SPAN + 1, lead + 1), -1)
        known = np.cumsum(valid[:n], dtype=np.int8) > 0
        place = np.arange(n, dtype=np.int32)
        key = np.where(known, (rank[entropy_levels(b)] << 20) | place, np.int32((LEVELS << 20) | ((1 << 20) - 1)))
        wide = 1
        while wide < SPAN:  # smallest of the next SPAN
            key = np.minimum(key[:-wide], key[wide:])
            wide *= 2
        chosen = key[key >> 20 < LEVELS] & ((1 << 20) - 1)
        places = np.flatnonzero(np.bincount(chosen, minlength=n) >= VOTES)
        grams = np.ascontiguousarray(b[places[:, None] + np.arange(SPAN)]).view("<u8")
        h = np.zeros(len(places), dtype=np.uint64)
        for j in range(SPAN // 8):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + grams[:, j] + np.uint64(j + 1))
        low, high = np.searchsorted(places, first), np.searchsorted(places, last)
        for i, lo, hi in zip(owner, low, high):
            out[i].append(h[lo:hi])
    return [np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64) for parts in out]


def bloom(hashes: np.ndarray) -> str:
    """The chained filters of the features, each feature once."""
    _, at = np.unique(hashes, return_index=True)
    hashes = hashes[np.sort(at)]
    out = []
    for a in range(0, len(hashes), FULL):
        part = hashes[a : a + FULL]
        bits = np.zeros(BITS, dtype=np.uint8)
        for j in range(EACH):
            bits[(part >> np.uint64(11 * j)) & np.uint64(BITS - 1)] = 1
        out.append(len(part).to_bytes(2, "big") + np.packbits(bits).tobytes())
    return b64encode(b"".join(out)).decode("ascii")


def fingerprints(texts: list[bytes], rank: np.ndarray) -> list[str]:
    return [bloom(h) for h in features(texts, rank)]


def _filters(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b64decode(fingerprint), dtype=np.uint8).reshape(-1, 2 + BITS // 8)
    return raw[:, 0] * 256.0 + raw[:, 1], np.unpackbits(raw[:, 2:], axis=1).astype(np.float32)


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    (na, fa), (nb, fb) = _filters(a), _filters(b)
    ca, cb = fa.sum(axis=1), fb.sum(axis=1)
    best_a, best_b = np.zeros(len(na)), np.zeros(len(nb))
    for at in range(0, len(na), 512):  # blocks bound the table of pairs
        rows = slice(at, at + 512)
        for to in range(0, len(nb), 512):
            cols = slice(to, to + 512)
            chance = np.outer(ca[rows], cb[cols]) / BITS
            most = np.minimum(ca[rows][:, None], cb[cols][None, :])
            score = ((fa[rows] @ fb[cols].T - chance) / np.maximum(most - chance, 1e-9)).clip(0.0, 1.0)
            best_a[rows] = np.maximum(best_a[rows], score.max(axis=1))
            best_b[cols] = np.maximum(best_b[cols], score.max(axis=0))
    return float((na @ best_a + nb @ best_b) / (na.sum() + nb.sum()))


def _some(batches, column: str, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with at most about ``most`` bytes of text, or one row."""
    for batch in batches:
        sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0))
        begin, total = 0, 0
        for i, size in enumerate(sizes):
            if i > begin and total + size > most:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += int(size)
        if begin < batch.num_rows:
            yield batch.slice(begin)


def rarity(docs: DataFrame) -> np.ndarray:
    """Ranks of the entropy levels over all windows of all texts; a task sends 1,001 counts."""
    schema = pa.schema([("level", pa.int32()), ("n", pa.int64())])

    def count(batches):
        total = np.zeros(LEVELS, dtype=np.int64)
        for part in _some(batches, "text"):
            total += level_counts([t.encode("utf-8") for t in part.column("text").to_pylist() if t])
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], schema)

    counts = np.zeros(LEVELS, dtype=np.int64)
    for r in docs.select("text").mapInArrow(count, "level int, n long").groupBy("level").agg(F.sum("n").alias("n")).collect():
        counts[r.level] = r.n
    return order_of(counts)


def replaced(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def compared(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    spark, rank = docs.sparkSession, rarity(docs)
    id_type, id_kind = (pa.string(), "string") if dict(docs.dtypes)["doc_id"] == "string" else (pa.int64(), "long")
    out_schema = pa.schema([("doc_id", id_type), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                            ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                            ("part", pa.int32()), ("first", pa.bool_()), ("last", pa.bool_()), ("text", pa.string())])

    def done(rows: list[tuple], following: list[tuple]) -> list[dict]:
        """Result rows of (doc_id, text, fingerprint), each with the row that follows it."""
        edits = [replaced(a[1], b[1]) for a, b in zip(rows, following)]
        prints = fingerprints([e.encode("utf-8") for e in edits], rank)
        return [{"doc_id": a[0], "n_chars": len(a[1]), "edited_sha256": sha256(e.encode("utf-8")).hexdigest(), "fingerprint": a[2], "edited_fingerprint": p,
                 "near_edited": likeness(a[2], p), "near_next": likeness(a[2], b[2])} for a, b, e, p in zip(rows, following, edits, prints)]

    def walk(batches):
        held, opened, part = None, False, 0
        for some in _some(batches, "text"):
            part = some.column("part")[0].as_py()
            texts = some.column("text").to_pylist()
            rows = list(zip(some.column("doc_id").cast(id_type).to_pylist(), texts, fingerprints([t.encode("utf-8") for t in texts], rank)))
            if not opened:  # what the part before this one waits for
                opened = True
                yield pa.RecordBatch.from_pylist([{"part": part, "first": True, "last": False, "text": rows[0][1], "fingerprint": rows[0][2]}], out_schema)
            if held is not None:
                rows.insert(0, held)
            held = rows[-1]
            if len(rows) > 1:
                yield pa.RecordBatch.from_pylist([{**r, "part": part, "first": False, "last": False} for r in done(rows[:-1], rows[1:])], out_schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([{"part": part, "first": False, "last": True, "doc_id": held[0], "text": held[1], "fingerprint": held[2]}], out_schema)

    kinds = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double", pa.int32(): "int", pa.bool_(): "boolean"}
    schema = ", ".join(f"{f.name} {id_kind if f.name == 'doc_id' else kinds[f.type]}" for f in out_schema)
    keys = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("_id")]
    # The number of the row splits rows that are equal otherwise; it is the place in the file, so the same on every run of a task.
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_id", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text", F.spark_partition_id().alias("part"))
    found = written(ranged.mapInArrow(walk, schema), "walked", dense=True)
    # The parts with rows, each with the next one; after the last comes the first. One row per part.
    heads = found.where("first").select(F.col("part").alias("head_part"), F.col("text").alias("head_text"), F.col("fingerprint").alias("head_print"))
    parts = found.where("first").select("part")
    order = Window.partitionBy(F.lit(0)).orderBy("part")
    after = parts.select("part", F.lead("part").over(order).alias("later"), F.min("part").over(Window.partitionBy(F.lit(0))).alias("start"))
    after = after.select("part", F.coalesce("later", "start").alias("head_part"))
    waiting = found.where("last").select("doc_id", "text", "fingerprint", "part").join(after, "part").join(heads, "head_part")

    def close(batches):
        for batch in batches:
            for r in batch.to_pylist():
                got = done([(r["doc_id"], r["text"], r["fingerprint"])], [(None, r["head_text"], r["head_print"])])[0]
                yield pa.RecordBatch.from_pylist([got], pa.schema([out_schema.field(n) for n in NAMES]))

    closing = ", ".join(schema.split(", ")[: len(NAMES)])
    ends = waiting.select(F.col("doc_id").cast(id_kind).alias("doc_id"), "text", "fingerprint", "head_text", "head_print").mapInArrow(close, closing)
    return found.where("NOT first AND NOT last").select(*NAMES).unionByName(ends)


@query("op13_rare_windows")
def op13(spark, sf_dir):
    return compared(table(spark, sf_dir, "documents"))
