"""Passages that repeat within and across documents, by sparse suffix arrays.

Only suffixes at minimiser places are kept: a place is kept when its eight-word hash is the smallest of some 36 neighbouring
ones, so equal passages keep the same places, about one word in eighteen. A suffix is known by a hash of its first words
(the core) and by a hash of all words from 35 before it to 50 after it (its context). Suffixes with equal core and context
are a class with one head, its first member. The heads are sorted by core and compared with their neighbours:
where two heads share the core but not the context, a match ends somewhere near, and there it is extended to the left and right
word by word, by comparing the windows of 50 words around the heads. Other members lie inside longer matches and are whole
already. So every repeat of at least 50 words is found exactly, also between members that are no neighbours, and only the
borders of matches cost more than one row per suffix.

Words are runs of non-blank characters. Of equal windows the first in order of documents (doc_id, null last, then text hash)
and place is the source; the others are repeats.

Defined cases: texts that are null or shorter than 50 words have no repeats; rows that repeat doc_id and text count as one
document; repeats within one document count; other columns are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkframe.llm.common import dropped, keyed, lean, mix, place, powers, run_hashes, same_doc, slices, word_hashes, written
from larkframe.llm.common import _INVERSE, _ODD
from larkframe.llm.registry import query, table

LEAST = 50  # words of the shortest repeat
GRAM = 8
SPREAD = 36  # neighbouring grams of which the smallest is kept
CORE = LEAST - SPREAD + 1  # words after a kept place that every window with it holds
SLICE_CHARS = 1 << 19


def _sliding(x: np.ndarray, size: int, least) -> np.ndarray:
    """least (minimum or maximum) of the ``size`` items from every place on, by doubling."""
    width = 1
    while 2 * width <= size:
        x = least(x[:-width], x[width:])
        width *= 2
    rest = size - width
    return least(x[: len(x) - rest], x[rest:]) if rest else x


def kept_places(words: np.ndarray) -> np.ndarray:
    """Places whose gram is the smallest of some SPREAD neighbouring grams."""
    grams = run_hashes(words, GRAM)
    if len(grams) < SPREAD:
        return np.zeros(0, dtype=np.int64)
    lowest = _sliding(grams, SPREAD, np.minimum)
    padded = np.concatenate([np.zeros(SPREAD - 1, dtype=np.uint64), lowest, np.zeros(SPREAD - 1, dtype=np.uint64)])
    return np.flatnonzero(_sliding(padded, SPREAD, np.maximum) == grams)


def suffixes(docs: DataFrame) -> DataFrame:
    """(core, context, doc_id, k, pos, before, after) of the kept suffixes of (doc_id, k, text).

    before and after are the words on both sides that the context covers; suffixes too near the ends of a short text to
    have a window of LEAST words around them are left out.
    """

    @lean
    def keep(batches):
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for part in slices([len(t) for t in texts], SLICE_CHARS):
                words, per_text = word_hashes(texts[part])
                pos = kept_places(words)
                ends = np.cumsum(per_text)
                owner = np.searchsorted(ends, pos, side="right")
                begin, end = (ends - per_text)[owner], ends[owner]
                low, high = np.maximum(begin, pos - SPREAD + 1), np.minimum(end, pos + LEAST)
                ok = (pos + CORE <= end) & (high - low >= LEAST)
                pos, owner, begin, low, high = (x[ok] for x in (pos, owner, begin, low, high))
                if not len(pos):
                    continue
                total = np.zeros(len(words) + 1, dtype=np.uint64)
                np.cumsum(words * powers(_ODD, len(words)), out=total[1:])
                context = (total[high] - total[low]) * powers(_INVERSE, len(words))[low]
                sides = ((pos - low) * 64 + (high - pos)).astype(np.uint64)
                yield pd.DataFrame({
                    "core": run_hashes(words, CORE)[pos].view(np.int64), "context": mix(context ^ mix(sides + np.uint64(1))).view(np.int64),
                    "doc_id": batch["doc_id"][part].to_numpy()[owner], "k": batch["k"][part].to_numpy()[owner],
                    "pos": pos - begin, "before": pos - low, "after": high - pos})

    return docs.select("doc_id", "k", "text").mapInPandas(
        keep, "core long, context long, doc_id long, k long, pos int, before int, after int")


def border_heads(classes: DataFrame) -> DataFrame:
    """Heads (doc_id, k, pos) whose neighbour in suffix order has the same core.

    The first and last head of a task's part of the order are given too, as their neighbour is in another task.
    """

    @lean
    def compare(batches):
        held = None
        for batch in batches:
            if held is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            if len(batch) < 3:
                held = batch
                continue
            core = batch["core"].to_numpy()
            same = core[1:] == core[:-1]
            near = np.concatenate([[held is None], same]) | np.concatenate([same, [False]])
            near[-1] = False  # decided with the next batch
            if held is not None:
                near[0] = False  # decided with the batch before
            yield batch.loc[near, ["doc_id", "k", "pos"]]
            held = batch.iloc[-2:].reset_index(drop=True)
        if held is not None:
            yield held[["doc_id", "k", "pos"]]

    ordered = classes.select("core", "context", "head.doc_id", "head.k", "head.pos").repartitionByRange("core", "context").sortWithinPartitions("core", "context")
    return ordered.mapInPandas(compare, "doc_id long, k long, pos int").distinct()


def windows(docs: DataFrame, heads: DataFrame) -> DataFrame:
    """(h1, h2, doc_id, k, start): the windows of LEAST words that hold a head within their first SPREAD grams.

    A document in several rows gives its windows several times; whole texts are not shuffled once more to prevent it.
    """
    places = heads.groupBy("doc_id", "k").agg(F.collect_set("pos").alias("places"))
    rows = docs.alias("d").join(places.alias("p"), same_doc("d", "p")).select("d.doc_id", "d.k", "d.text", "p.places")

    @lean
    def spread(batches):
        for batch in batches:
            for doc_id, k, text, places_ in zip(batch["doc_id"], batch["k"], batch["text"], batch["places"]):
                words, _ = word_hashes([text])
                h1, h2 = run_hashes(words, LEAST), run_hashes(mix(words + np.uint64(2)), LEAST)
                start = (np.asarray(places_, dtype=np.int64)[:, None] - np.arange(SPREAD)).ravel()
                start = np.unique(start[(start >= 0) & (start < len(h1))])
                yield pd.DataFrame({
                    "h1": h1[start].view(np.int64), "h2": h2[start].view(np.int64), "doc_id": pd.Series([doc_id] * len(start), dtype="Int64"),
                    "k": np.full(len(start), k), "start": start})

    return rows.mapInPandas(spread, "h1 long, h2 long, doc_id long, k long, start int")


def _joined(spans: list) -> list[tuple]:
    """Touching spans with one source document and one distance to it become one."""
    out: list[list] = []
    open_: dict[tuple, list] = {}
    for s in sorted(spans, key=lambda s: (s["start"], s["end"])):
        way = (s["source_doc_id"], s["source_k"], s["source_start"] - s["start"])
        last = open_.get(way)
        if last and s["start"] <= last[1]:
            last[1] = max(last[1], s["end"])
        else:
            open_[way] = last = [s["start"], s["end"], s["source_doc_id"], s["source_k"], s["source_start"]]
            out.append(last)
    return out


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, k, start, n_words, source_doc_id, source_k, source_start): maximal repeats, counted in words.

    Every window of LEAST words that occurred earlier lies in one of them.
    """
    base = keyed(docs)
    kept = written(suffixes(base), "suffixes", dense=True)
    spot = place("pos", "before", "after")
    classes = written(
        kept.groupBy("core", "context").agg(F.min(spot).alias("head"), F.count(F.lit(1)).alias("n")), "suffix-classes", dense=True)
    inner = kept.join(classes.where("n > 1").select("core", "context", "head"), ["core", "context"]).where(spot > F.col("head")).select(
        "doc_id", "k", (F.col("pos") - F.col("before")).alias("start"), (F.col("pos") + F.col("after")).alias("end"),
        F.col("head.doc_id").alias("source_doc_id"), F.col("head.k").alias("source_k"), (F.col("head.pos") - F.col("before")).alias("source_start"))
    inner = written(inner, "suffix-inner", dense=True)
    heads = written(border_heads(classes), "suffix-heads", dense=True)
    dropped(kept, classes)
    near = written(windows(base, heads), "suffix-windows", dense=True)
    dropped(heads)
    firsts = near.groupBy("h1", "h2").agg(F.min(place("start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = written(firsts.drop("n"), "suffix-firsts", dense=True)
    border = near.join(firsts, ["h1", "h2"]).where(place("start") > F.col("first")).select(
        "doc_id", "k", "start", (F.col("start") + LEAST).alias("end"),
        F.col("first.doc_id").alias("source_doc_id"), F.col("first.k").alias("source_k"), F.col("first.start").alias("source_start"))
    spans = inner.unionByName(border).groupBy("doc_id", "k").agg(
        F.collect_set(F.struct("start", "end", "source_doc_id", "source_k", "source_start")).alias("spans"))

    @lean
    def merge(batches):
        for batch in batches:
            rows = [(d, k, s, e - s, *rest) for d, k, spans_ in zip(batch["doc_id"], batch["k"], batch["spans"]) for s, e, *rest in _joined(spans_)]
            frame = pd.DataFrame(rows, columns=["doc_id", "k", "start", "n_words", "source_doc_id", "source_k", "source_start"])
            yield frame.astype({"doc_id": "Int64", "source_doc_id": "Int64"})

    return spans.mapInPandas(merge, "doc_id long, k long, start int, n_words int, source_doc_id long, source_k long, source_start int")


_WORD = re.compile(r"[^ \t\n\r\f\v]+")


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans (start, words) and the blanks inside them; what is left keeps its blanks."""
    gone: set[int] = set()
    for start, n in spans:
        gone.update(range(start, start + n))
    out, at, cut = [], 0, False
    for i, m in enumerate(_WORD.finditer(text)):
        if i in gone:
            if not cut:
                out.append(text[at : m.start()])
            cut, at = True, m.end()
        else:
            cut = False
    out.append(text[at:])
    return "".join(out)


def keep_new_passages(docs: DataFrame) -> DataFrame:
    """The documents without their repeats; those without a word left go. n_chars, where present, is renewed."""
    found = repeats(docs)
    spans = written(found.groupBy("doc_id", "k").agg(F.collect_list(F.struct("start", "n_words")).alias("spans")), "passages")
    dropped(found)  # reads written tables only
    base = keyed(docs, whole=True).alias("d").join(spans.alias("s"), same_doc("d", "s"), "left").select("d.row", "d.text", "s.spans")

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans_: pd.Series) -> pd.Series:
        """Only texts with spans are sent; the others are null here and stay as they are."""
        return pd.Series([None if t is None else without(t, [(s["start"], s["n_words"]) for s in sp]) for t, sp in zip(text, spans_)], dtype=object)

    whole = F.col("spans").isNull()
    left = base.withColumn("text", F.when(whole, F.col("text")).otherwise(cut(F.when(~whole, F.col("text")), "spans")))
    left = left.where(whole | (F.trim(F.translate("text", "\t\n\r\f\u000b", "     ")) != ""))
    columns = []
    for c in docs.columns:
        old = F.col("row").getField(c)
        if c == "text":
            old = F.col("text")
        elif c == "n_chars":
            old = F.when(F.col("spans").isNotNull(), F.length("text").cast(docs.schema[c].dataType)).otherwise(old)
        columns.append(old.alias(c))
    return left.select(*columns)


@query("op1_sparse_suffixes")
def op1(spark, sf_dir):
    got = repeats(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "start", "n_words", "source_doc_id", "source_start")
