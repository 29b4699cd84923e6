"""Near-duplicate documents by BagMinHash signatures of their five-word shingle multisets.

A shingle with count w is a Poisson process over the weights [0, w), cut into the dyadic intervals [0, 1), [1, 2), [2, 4) ...
Every interval has its own process with its length as rate; a point falls on a random weight of its interval (the halving
decisions of the hierarchy, drawn as bits) and counts only where that weight is below w. Points come in rising order and
go to random slots of the signature; a process stops at the largest slot value so far. Two slots are equal with the
weighted Jaccard similarity as probability, without bias.

Bands of equal slots propose pairs, and the exact multiset overlap decides. Texts with equal words are one node from the
start, so copies cost nothing. In a bucket of equal bands every node is compared with the earliest document first; nodes
that are connected by then need no more comparison with each other. What is left between different components is compared
in blocks, each of which gives out no more links than join its parts. Nothing is capped.

Words are runs of non-blank characters in lower case; a text of one to four words is one shingle.
Defined cases: a text that is null or has no word links with nothing and is its own class; class_id is the smallest doc_id of
the class (null only if every doc_id in it is null); rows that repeat a doc_id each get a row; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkframe.llm.common import connected, keyed, lean, mix, place, run_hashes, same_doc, slices, word_hashes, written
from larkframe.llm.registry import query, table

SHINGLE = 5
SLOTS = 96
ROWS = 4  # slots per band: a pair at 0.8 is missed by all 24 bands once in 300,000
SLICE_CHARS = 1 << 19
BLOCK = 512
DOCS_A_TASK = 10_000  # of tables of a few narrow rows per document, so that small inputs do not make hundreds of small files
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str | None]]:
    """(text number, shingle, count) sorted by text, and a digest of each text's words (None without a word)."""
    words, per_text = word_hashes(texts, lower=True)
    ends = np.cumsum(per_text)
    runs = run_hashes(words, SHINGLE)
    owner = np.repeat(np.arange(len(texts)), per_text)
    whole = owner[: len(runs)] == owner[SHINGLE - 1 :] if len(runs) else np.zeros(0, dtype=bool)
    short = np.flatnonzero((per_text > 0) & (per_text < SHINGLE))
    owner = np.concatenate([owner[: len(runs)][whole], short])
    short_hash = [mix(np.bitwise_xor.reduce(mix(words[ends[i] - per_text[i] : ends[i]] + np.arange(per_text[i], dtype=np.uint64)), keepdims=True))[0] for i in short]
    hashes = np.concatenate([runs[whole], np.array(short_hash, dtype=np.uint64)])
    key, count = np.unique((owner.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16)), return_counts=True)
    node = []
    for end, n in zip(ends, per_text):
        w = words[end - n : end]
        if not n:
            node.append(None)
            continue
        place_ = np.arange(n, dtype=np.uint64)
        h1 = int(mix(w + place_ * _GOLDEN).sum(dtype=np.uint64))
        h2 = int(mix(w ^ mix(place_ + np.uint64(7))).sum(dtype=np.uint64))
        node.append(f"{h1:016x}{h2:016x}")
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), count, node


def signatures(owner: np.ndarray, shingle: np.ndarray, count: np.ndarray, texts: int, slots: int = SLOTS) -> np.ndarray:
    """(texts, slots) 32-bit marks of the first point of every slot."""
    who, seed, low, rate, weight = [], [], [], [], []
    floor = 0
    while True:
        has = count > floor
        if not has.any():
            break
        who.append(owner[has])
        seed.append(mix(shingle[has] * np.uint64(64) + np.uint64(floor.bit_length())))
        size = max(floor, 1)
        low.append(np.full(int(has.sum()), floor))
        rate.append(np.full(int(has.sum()), size))
        weight.append(count[has])
        floor = max(1, floor * 2)
    first = np.full(texts * slots, np.inf)
    mark = np.zeros(texts * slots, dtype=np.uint32)
    if not who:
        return mark.reshape(texts, slots).view(np.int32)
    who, seed, low, rate, weight = (np.concatenate(x) for x in (who, seed, low, rate, weight))
    when = np.zeros(len(who))
    draw = np.zeros(len(who), dtype=np.uint64)
    while len(who):
        several = 1 if len(who) > 20_000 else 16
        ahead = draw[:, None] + np.arange(1, several + 1, dtype=np.uint64)
        r = mix(seed[:, None] + ahead * _GOLDEN)
        r2 = mix(r ^ np.uint64(0x5851F42D4C957F2D))
        gap = -np.log1p(-(r >> np.uint64(11)).astype(np.float64) * 2.0**-53) / rate[:, None]
        times = when[:, None] + np.cumsum(gap, axis=1)
        spot = (r2 >> np.uint64(32)).astype(np.int64) & (rate[:, None] - 1)
        ok = low[:, None] + spot < weight[:, None]
        flat = who[:, None] * slots + ((r2 & np.uint64(0xFFFFFFFF)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
        f, t, m = flat[ok], times[ok], r[ok]
        np.minimum.at(first, f, t)
        won = first[f] == t
        mark[f[won]] = (m[won] >> np.uint64(32)).astype(np.uint32)
        when, draw = times[:, -1], ahead[:, -1]
        more = when < first.reshape(texts, slots).max(axis=1)[who]
        who, seed, low, rate, weight, when, draw = (x[more] for x in (who, seed, low, rate, weight, when, draw))
    return mark.reshape(texts, slots).view(np.int32)


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, k, node, sig): the node is a digest of the words; null for texts without words."""

    @lean
    def sign(batches):
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for part in slices([len(t) for t in texts], SLICE_CHARS):
                owner, shingle, count, node = shingles(texts[part])
                sig = signatures(owner, shingle, count, len(node))
                yield pd.DataFrame({"doc_id": batch["doc_id"][part], "k": batch["k"][part], "node": node, "sig": list(sig)})

    return docs.select("doc_id", "k", "text").mapInPandas(sign, "doc_id long, k long, node string, sig array<int>")


def bags(texts: DataFrame) -> DataFrame:
    """(node, shingles, counts) of (node, text): the multiset as 64-bit and 32-bit little-endian numbers in rising order."""

    @lean
    def fill(batches):
        for batch in batches:
            text = list(batch["text"])
            for part in slices([len(t) for t in text], SLICE_CHARS):
                owner, shingle, count, _ = shingles(text[part])
                cut = np.searchsorted(owner, np.arange(part.stop - part.start + 1))
                yield pd.DataFrame({
                    "node": batch["node"][part],
                    "shingles": [shingle[i:j].astype("<u8").tobytes() for i, j in zip(cut, cut[1:])],
                    "counts": [count[i:j].astype("<u4").tobytes() for i, j in zip(cut, cut[1:])]})

    return texts.select("node", "text").mapInPandas(fill, "node string, shingles binary, counts binary")


def _bag(shingles_: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(shingles_, "<u8"), np.frombuffer(counts, "<u4").astype(np.int64)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Size of the multiset intersection and union."""
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    inter = int(np.minimum(a[1][at], b[1])[a[0][at] == b[0]].sum())
    return inter, int(a[1].sum() + b[1].sum()) - inter


def verified(pairs: DataFrame, of: DataFrame, tenths: int = 8) -> DataFrame:
    """The pairs (a, b) whose multiset Jaccard similarity is at least tenths / 10; a may be the same node very often."""

    @lean
    def test(batches):
        for batch in batches:
            hit = []
            for sa, ca, sb, cb in zip(batch["sa"], batch["ca"], batch["sb"], batch["cb"]):
                inter, union = overlap(_bag(sa, ca), _bag(sb, cb))
                hit.append(10 * inter >= tenths * union)
            yield batch.loc[hit, ["a", "b"]]

    def side(x: str) -> DataFrame:
        return of.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}"), F.col("counts").alias(f"c{x}"))

    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "sa", "ca", "sb", "cb").mapInPandas(test, "a string, b string")


def common_counts(own: list[tuple[np.ndarray, np.ndarray]], columns: int = 4096) -> np.ndarray:
    """Sizes of all multiset intersections of a block, by matrix products over the shingles that at least two members hold."""
    n = len(own)
    who = np.repeat(np.arange(n), [int(c.sum()) for _, c in own])
    shingle = np.concatenate([np.repeat(s, c) for s, c in own])
    order = np.lexsort((who, shingle))
    who, shingle = who[order], shingle[order]
    fresh = np.ones(len(who), dtype=bool)
    fresh[1:] = (who[1:] != who[:-1]) | (shingle[1:] != shingle[:-1])
    begin = np.flatnonzero(fresh)
    nth = np.arange(len(who)) - np.repeat(begin, np.diff(np.append(begin, len(who))))  # which copy within its member
    _, column, often = np.unique(mix(shingle * np.uint64(2) + np.uint64(1)) + nth.astype(np.uint64), return_inverse=True, return_counts=True)
    shared = often[column] >= 2
    who, column = who[shared], np.unique(column[shared], return_inverse=True)[1]
    total = np.zeros((n, n), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        i, j = np.searchsorted(column, [low, low + columns])
        dense = np.zeros((n, columns), dtype=np.float32)
        dense[who[i:j], column[i:j] - low] = 1
        total += dense @ dense.T
    return total


def forest(n: int, links: np.ndarray) -> list[tuple[int, int]]:
    """The links that join two parts not joined before."""
    up = list(range(n))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for x, y in links:
        rx, ry = root(int(x)), root(int(y))
        if rx != ry:
            up[rx] = ry
            out.append((int(x), int(y)))
    return out


def across(members: DataFrame, sigs: DataFrame, of: DataFrame, tenths: int = 8, least: float = 0.55) -> DataFrame:
    """Links (a, b) between nodes of one bucket in different components: as many as join all parts that any link joins.

    members: (key, node, label). Buckets are cut into blocks by node, and every pair of blocks is a group of its own, so
    that no bucket is too large. A first pass over signatures alone keeps the nodes of a group that have a partner in
    another component that agrees in a share ``least`` (six deviations below 0.8); the
    second compares the multisets of those exactly. Neither gives out pairs: a group of n nodes has at most n - 1 links.
    """
    parts = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    rows = members.join(parts, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    rows = rows.join(sigs, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    packs = members.count() // (2 * BLOCK) + 1
    pack = F.when(F.col("parts") == 1, F.pmod("key", F.lit(packs))).otherwise(F.xxhash64("key", i, j))  # many small buckets go to one call
    rows = rows.select(pack.alias("pack"), "key", i.alias("i"), j.alias("j"), "own", "node", "label", "sig")

    def groups(g: pd.DataFrame):
        g = g.sort_values(["key", "i", "j", "node"], kind="stable")
        at = g[["key", "i", "j"]].to_numpy()
        cut = np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1
        own, label = g["own"].to_numpy(), pd.factorize(g["label"])[0]
        for x, y in zip([0, *cut], [*cut, len(g)]):
            o, lab = own[x:y], label[x:y]
            yield g, x, y, (o[:, None] == at[x, 1]) & (o[None, :] == at[x, 2]) & (lab[:, None] != lab[None, :])

    def near(g: pd.DataFrame) -> pd.DataFrame:
        hit = []
        for g, x, y, ok in groups(g):
            if not x:
                sigs_ = np.stack(g["sig"].to_numpy())
            sig = sigs_[x:y]
            for z in range(y - x):
                to = np.flatnonzero(ok[z])
                if len(to):
                    ok[z, to] = (sig[to] == sig[z]).mean(axis=1) >= least
            hit.append(ok.any(axis=0) | ok.any(axis=1))
        return g.loc[np.concatenate(hit), ["pack", "key", "i", "j", "own", "node", "label"]]

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        out = []
        for g, x, y, ok in groups(g):
            part = g.iloc[x:y]
            own = [_bag(s, c) for s, c in zip(part["shingles"], part["counts"])]
            size = np.array([c.sum() for _, c in own], dtype=np.float32)
            inter = common_counts(own)
            hit = ok & (10 * inter >= tenths * (size[:, None] + size[None, :] - inter))
            node = part["node"].to_numpy()
            out += [(node[x], node[y]) for x, y in forest(len(part), np.argwhere(hit))]
        return pd.DataFrame(out, columns=["a", "b"])

    left = rows.groupBy("pack").applyInPandas(near, "pack long, key long, i int, j int, own int, node string, label string")
    left = written(left, "bag-near")
    return left.join(of, "node").groupBy("pack").applyInPandas(compare, "a string, b string").distinct()


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, k, node, label, class_id): one row per document row; label is the key of the class, which class_id is not."""
    base = keyed(docs)
    sigs = written(signed(base), "bag-signatures")
    tasks = 1 + sigs.count() // DOCS_A_TASK
    nodes = written(
        sigs.where("node is not null").groupBy("node").agg(F.min(place()).alias("p"), F.first("sig").alias("sig"), F.min("doc_id").alias("least_id"))
        .select("node", "p", "sig", "least_id"), "bag-nodes", tasks=tasks)
    bands = nodes.select("node", "p", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(SLOTS // ROWS - 1)), lambda b: F.xxhash64(b, F.slice("sig", b * ROWS + 1, ROWS)))).alias("key"))
    first = F.struct("p", "node")
    hubs = bands.groupBy("key").agg(F.min(first).alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    hubs = written(hubs.select("key", F.col("hub.node").alias("hub")), "bag-hubs", tasks=tasks)
    members = written(bands.join(hubs, "key").select("key", "node", "hub"), "bag-members", tasks=tasks)
    some = members.select("node").distinct()
    chosen = nodes.join(some, "node", "left_semi").select("node", "p.doc_id", "p.k")
    texts = base.alias("d").join(chosen.alias("n"), same_doc("d", "n")).select("n.node", "d.text").dropDuplicates(["node"])
    of = written(bags(texts), "bag-shingles")
    pairs = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = written(verified(pairs, of), "bag-links")
    star = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"))  # nodes of one star need no more comparison
    marked = written(members.select("key", "node").join(star, "node", "left").withColumn("label", F.coalesce("label", "node")), "bag-marked", tasks=tasks)
    mixed = marked.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    open_ = written(marked.join(written(mixed, "bag-mixed", tasks=tasks), "key"), "bag-open", tasks=tasks)
    more = across(open_, nodes.select("node", "sig"), of)
    labels = connected(links.unionByName(more))
    named = nodes.select("node", "least_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("least_id").alias("class_id"))
    named = written(named.join(smallest, "label").select("node", "label", "class_id"), "bag-classes", tasks=tasks)
    alone = F.col("node").isNull()
    return sigs.select("doc_id", "k", "node").join(named, "node", "left").select(
        "doc_id", "k", "node", F.when(alone, F.concat_ws("/", F.lit("none"), "doc_id", "k")).otherwise(F.col("label")).alias("label"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, k, node, class_id): one row per document row."""
    return classes(docs).drop("label")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One document of every class: its smallest doc_id, and of rows that repeat it the first by text hash and one copy.

    Classes go by label: unrelated texts without doc_id, or under one doc_id, have one class_id and are still classes apart.
    """
    chosen = classes(docs).groupBy("label").agg(F.min(place()).alias("p")).select("p.doc_id", "p.k")
    whole = keyed(docs, whole=True).alias("d").join(chosen.alias("c"), same_doc("d", "c"), "left_semi")
    return whole.dropDuplicates(["doc_id", "k"]).select("row.*")


@query("op7_bag_minhash")
def op7(spark, sf_dir):
    got = near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))
