"""Language of words and documents by a linear-chain conditional random field.

Every word gets a score per language from its affixes, its character n-grams and a lexicon; learned transitions tie
neighbouring words, and forward-backward gives each word its posterior over the languages, so that a text that switches
language is labelled part by part. A document's language is the one with the largest sum of word posteriors.

Training: the words of a labelled document carry its label. All labelled documents outside the held-out fold are learned from, whole
texts. They are dealt by hash to shards of some SHARD_CHARS characters; every shard climbs its conditional likelihood by Adagrad, a step
per slice, at least once through all its texts and at least STEPS steps, and the weights of the shards are averaged by how often
each shard has met the feature. Sums are of fixed-point numbers, so the model depends on the rows only. A word is in a shard's lexicon when
seen five times there. Only where ``train`` is given ``rows_per_label`` it fits a sample of so many documents a language.

Defined cases: a text that is null or has no letter is ``und`` with score 0; ties go to the alphabetically first language;
without any labelled row every text is ``und``; repeated rows are predicted row by row; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkframe.llm.common import lean, release, slices, written
from larkframe.llm.registry import query, table
from larkframe.operators.quantiles import quantiles

UND = "und"
BITS = 18  # hashed n-gram features
CHUNK = 128  # words per block of the blocked forward and backward passes
RESCALE = 8  # steps between two rescalings
SLICE_CHARS = 1 << 19
LEXICON = 1 << 16  # slots; the most frequent word of a slot has it
SHARD_CHARS = 1 << 23
STEPS = 12  # at least, for every shard
SEEN = 5
FIXED = 1 << 20  # weights are averaged as whole numbers of this fraction
_MUL = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


@dataclass
class Model:
    labels: list[str]
    ngrams: np.ndarray  # (2 ** BITS, labels)
    lexicon: np.ndarray  # word hash by slot, 0 where none
    lexicon_scores: np.ndarray  # (slots, labels)
    trans: np.ndarray  # (labels, labels), log scale
    start: np.ndarray  # (labels,)


_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes with every non-letter as a blank, first place and length of each word, and words per text."""
    joined = " " + " ".join(t.lower() for t in texts) + "  "
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[codes]
    step = np.diff(letter.astype(np.int8))
    first = np.flatnonzero(step == 1) + 1
    length = np.flatnonzero(step == -1) + 1 - first
    ends = 1 + np.cumsum([len(t.lower()) + 1 for t in texts])
    per_text = np.diff(np.searchsorted(first, ends), prepend=0)
    return np.where(letter, codes, np.uint32(32)), first, length, per_text


def mixed(*parts: np.ndarray) -> np.ndarray:
    h = parts[0] * _MUL[0]
    for i, p in enumerate(parts[1:], 1):
        h = (h ^ (h >> np.uint32(15))) * _MUL[i % 4] + p * _MUL[(i + 1) % 4]
    return h ^ (h >> np.uint32(13))


def grams(codes: np.ndarray) -> np.ndarray:
    """Feature of the three-gram around every place; the one around a word's first or last letter holds the blank."""
    h = np.zeros(len(codes), dtype=np.uint32)
    h[1:-1] = mixed(codes[:-2], codes[1:-1], codes[2:])
    return (h >> np.uint32(32 - BITS)).astype(np.intp)


def affixes(codes: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of prefix and suffix of up to three letters, and the word's own hash (first and last four letters, length)."""
    last = first + length - 1

    def letters(start: np.ndarray, way: int, n: int) -> list[np.ndarray]:
        return [np.where(length > i, codes[np.clip(start + way * i, 0, len(codes) - 1)], np.uint32(32)) for i in range(n)]

    head, tail = letters(first, 1, 4), letters(last, -1, 4)
    salt = np.uint32(1 << 21)
    prefix = mixed(head[0] + salt, *head[1:3]) >> np.uint32(32 - BITS)
    suffix = mixed(tail[0] + 2 * salt, *tail[1:3]) >> np.uint32(32 - BITS)
    word = mixed(*head, *tail, length.astype(np.uint32))
    return prefix.astype(np.intp), suffix.astype(np.intp), word


def gathered(per_place: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Sums of the rows of per_place over each word."""
    edges = np.stack([first, first + length], axis=1).ravel()
    return np.add.reduceat(per_place, edges, axis=0)[::2]


def emissions(model: Model, codes: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Score of every word for every language."""
    if not len(first):
        return np.zeros((0, len(model.labels)))
    prefix, suffix, word = affixes(codes, first, length)
    out = gathered(model.ngrams[grams(codes)], first, length).astype(np.float64)
    out += model.ngrams[prefix]
    out += model.ngrams[suffix]
    slot = word & np.uint32(len(model.lexicon) - 1)
    out += np.where((model.lexicon[slot] == word)[:, None], model.lexicon_scores[slot], 0)
    return out


def forward_backward(scores: np.ndarray, new: np.ndarray, trans: np.ndarray, start: np.ndarray):
    """Posterior of every word, and the factors of the pairwise posteriors (alpha, emission, beta).

    All texts stand in one sequence; ``new`` marks first words, where the chain begins again. Blocks of CHUNK words are
    walked in step: first for the product of each block, then, with the vectors that enter a block known, for its words.
    """
    n, m = scores.shape
    e = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -15.0))
    t = np.exp(trans - trans.max())
    s = np.exp(start - start.max())
    blocks = -(-n // CHUNK)
    pad = blocks * CHUNK - n
    by_step = np.ascontiguousarray(np.concatenate([e, np.ones((pad, m))]).reshape(blocks, CHUNK, m).transpose(1, 0, 2))
    begins = np.concatenate([new, np.ones(pad, dtype=bool)]).reshape(blocks, CHUNK).T
    begins = [np.flatnonzero(x) for x in begins]

    def even(x, j):
        return x if j % RESCALE else x / x.reshape(len(x), -1).max(axis=1).reshape(-1, *[1] * (x.ndim - 1))

    whole = np.broadcast_to(np.eye(m), (blocks, m, m)).copy()
    for j in range(CHUNK):
        moved = (whole.reshape(-1, m) @ t).reshape(whole.shape)
        if len(i := begins[j]):
            moved[i] = whole[i].sum(axis=2, keepdims=True) * s
        whole = even(moved * by_step[j][:, None, :], j)
    enter, leave = np.empty((blocks, m)), np.empty((blocks, m))
    v = np.full(m, 1.0 / m)
    for b in range(blocks):
        enter[b] = v
        v = v @ whole[b]
        v = v / v.max()
    v = np.full(m, 1.0)
    for b in range(blocks - 1, -1, -1):
        leave[b] = v
        v = whole[b] @ v
        v = v / v.max()
    alpha, beta = np.empty_like(by_step), np.empty_like(by_step)
    a = enter
    for j in range(CHUNK):
        moved = a @ t
        if len(i := begins[j]):
            moved[i] = a[i].sum(axis=1, keepdims=True) * s
        a = alpha[j] = even(moved * by_step[j], j)
    b = leave
    for j in range(CHUNK - 1, -1, -1):
        beta[j] = b
        w = by_step[j] * b
        b = w @ t.T
        if len(i := begins[j]):
            b[i] = (w[i] * s).sum(axis=1, keepdims=True)
        b = even(b, j)
    post = alpha * beta
    post /= (post @ np.ones(m))[:, :, None]

    def in_order(x):
        return x.transpose(1, 0, 2).reshape(-1, m)[:n]

    return in_order(post), in_order(alpha), e, in_order(beta), t


def unlearned(labels: list[str]) -> Model:
    m = len(labels)
    return Model(labels, np.zeros((1 << BITS, m)), np.zeros(LEXICON, dtype=np.uint32), np.zeros((LEXICON, m)), np.zeros((m, m)), np.zeros(m))


def fill_lexicon(model: Model, hashes: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Give every slot to its most frequent word; which of the words stand in the lexicon."""
    rank = np.lexsort((hashes, often))  # the last write to a slot stays
    model.lexicon[hashes[rank] & np.uint32(LEXICON - 1)] = hashes[rank]
    return model.lexicon[hashes & np.uint32(LEXICON - 1)] == hashes


def slopes(model: Model, words: tuple, langs: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the log-likelihood of the words' labels; ``words`` as from ``words_of``, one label number per text."""
    codes, first, length, per_text = words
    m = len(model.labels)
    prefix, suffix, word = affixes(codes, first, length)
    three = grams(codes)[codes != 32]
    slot = (word & np.uint32(LEXICON - 1)).astype(np.intp)
    has = model.lexicon[slot] == word
    gold = np.repeat(langs, per_text)
    new = np.zeros(len(first), dtype=bool)
    new[(np.cumsum(per_text) - per_text)[per_text > 0]] = True
    post, alpha, e, beta, t = forward_backward(emissions(model, codes, first, length), new, model.trans, model.start)
    miss = np.eye(m)[gold] - post
    inside = ~new[1:]
    left, right = alpha[:-1][inside], (e[1:] * beta[1:])[inside]
    pairs = left.T @ (right / np.maximum(((left @ t) * right).sum(axis=1), 1e-300)[:, None]) * t
    true = np.bincount(gold[:-1][inside] * m + gold[1:][inside], minlength=m * m).reshape(m, m)
    return {
        "ngrams": np.stack([
            np.bincount(np.concatenate([three, prefix, suffix]), np.concatenate([np.repeat(miss[:, j], length), miss[:, j], miss[:, j]]), 1 << BITS)
            for j in range(m)], axis=1),
        "lexicon_scores": np.stack([np.bincount(slot[has], miss[has, j], LEXICON) for j in range(m)], axis=1),
        "trans": true - pairs, "start": miss[new].sum(axis=0)}


def climb(model: Model, parts: Callable[[], Iterable], passes: int, step: float = 0.5, ridge: float = 1e-6) -> None:
    """Raise the conditional likelihood by Adagrad, a step for every one of ``parts`` (words, label numbers) in every pass."""
    g2: dict[str, np.ndarray] = {}
    for _ in range(passes):
        for words, langs in parts():
            if not len(words[1]):
                continue
            for name, grad in slopes(model, words, langs).items():
                w = getattr(model, name)
                grad = grad / len(words[1]) - ridge * w
                g2[name] = g2.get(name, 1e-10) + grad * grad
                w += step * grad / np.sqrt(g2[name])


def fit(texts: list[str], langs: list[str], epochs: int = STEPS, step: float = 0.5, ridge: float = 1e-6, seen: int = SEEN) -> Model:
    """Maximise the conditional likelihood of the words' labels by full-batch Adagrad."""
    model = unlearned(sorted(set(langs)))
    words = words_of(texts)
    if len(words[1]):
        hashes, often = np.unique(affixes(*words[:3])[2], return_counts=True)
        fill_lexicon(model, hashes[often >= seen], often[often >= seen])
        gold = np.searchsorted(model.labels, langs)
        climb(model, lambda: [(words, gold)], epochs, step, ridge)
    model.ngrams = model.ngrams.astype(np.float32)
    return model


def learn_shard(texts: list[str], langs: list[str], labels: list[str]) -> pd.DataFrame:
    """What one shard learned: (kind, id, c, w0.., g0..) with c the times met, w the weights times c, g the three-grams by label.

    kind is 0 for an n-gram, 1 for a word (id is its hash), 2 for transitions from label id, 3 for the start.
    """
    model, m = unlearned(labels), len(labels)
    gold = np.searchsorted(labels, langs)
    parts = list(slices([len(t) for t in texts], SLICE_CHARS))
    met, three_of = np.zeros(1 << BITS, dtype=np.int64), np.zeros((m, 1 << BITS), dtype=np.int64)
    hashes, often, filled, n = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64), 0, 0
    for part in parts:
        codes, first, length, per_text = words_of(texts[part])
        if not len(first):
            continue
        prefix, suffix, word = affixes(codes, first, length)
        three, own = grams(codes)[codes != 32], np.repeat(gold[part], per_text)
        by_label = np.bincount(np.repeat(own, length) * (1 << BITS) + three, minlength=m << BITS).reshape(m, -1)
        three_of += by_label
        met += by_label.sum(axis=0) + np.bincount(prefix, minlength=1 << BITS) + np.bincount(suffix, minlength=1 << BITS)
        here, times = np.unique(word, return_counts=True)
        hashes, back = np.unique(np.concatenate([hashes, here]), return_inverse=True)
        often = np.bincount(back, np.concatenate([often, times])).astype(np.int64)
        filled, n = filled + 1, n + len(first)
    if not n:
        return pd.DataFrame()
    hashes, often = hashes[often >= SEEN], often[often >= SEEN]
    has = fill_lexicon(model, hashes, often)
    hashes, often = hashes[has], often[has]
    climb(model, lambda: ((words_of(texts[p]), gold[p]) for p in parts), -(-STEPS // filled))
    at = np.flatnonzero(met)
    ids = np.concatenate([at, hashes.astype(np.int64), np.arange(m), [0]])
    c = np.concatenate([met[at], often, np.full(m + 1, n)])
    w = np.concatenate([model.ngrams[at], model.lexicon_scores[hashes & np.uint32(LEXICON - 1)], model.trans, model.start[None]])
    w = np.rint(w * FIXED).astype(np.int64) * c[:, None]
    g = np.zeros((len(ids), m), dtype=np.int64)
    g[: len(at)] = three_of[:, at].T
    kind = np.repeat([0, 1, 2, 3], [len(at), len(hashes), m, 1])
    return pd.DataFrame({"kind": kind, "id": ids, "c": c, **{f"w{j}": w[:, j] for j in range(m)}, **{f"g{j}": g[:, j] for j in range(m)}})


def labelled_docs(docs: DataFrame) -> DataFrame:
    key = F.xxhash64("doc_id", "lang", "text")
    rows = docs.select("doc_id", "text", "lang", key.alias("key"))
    return rows.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") > 0))


def learned(docs: DataFrame, max_labels: int, folds: int, held_out: int) -> tuple[Model | None, np.ndarray | None]:
    """The model of all labelled documents outside the held-out fold, and how often each language has each three-gram.

    Rows that repeat are one. More than ``max_labels`` languages are an error.
    """
    rows = labelled_docs(docs).where(fold(folds) != held_out)
    size = {r[0]: r[1] for r in rows.groupBy("lang").agg(F.sum(F.length("text").cast("long"))).limit(max_labels + 1).collect()}
    if len(size) > max_labels:
        raise ValueError(f"more than {max_labels} languages")
    if not size:
        return None, None
    labels, m = sorted(size), len(size)
    shards = -(-sum(size.values()) // SHARD_CHARS)
    names = [f"{x}{j}" for x in "wg" for j in range(m)]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["doc_id", "lang", "text"]).sort_values(["key", "doc_id"])
        got = learn_shard(group["text"].tolist(), group["lang"].tolist(), labels)
        release()
        return got

    shard = rows.select(F.pmod("key", F.lit(shards)).alias("shard"), "key", "doc_id", "lang", "text")
    got = shard.groupBy("shard").applyInPandas(run, ", ".join(["kind int", "id long", "c long", *[f"{x} long" for x in names]]))
    table = got.groupBy("kind", "id").agg(F.sum("c").alias("c"), *[F.sum(x).alias(x) for x in names]).toArrow().to_pandas().sort_values(["kind", "id"])
    model, seen = unlearned(labels), np.zeros((1 << BITS, m))
    kind, ids, c = (table[x].to_numpy() for x in ("kind", "id", "c"))
    w = table[names[:m]].to_numpy() / FIXED / c[:, None]
    model.ngrams = model.ngrams.astype(np.float32)
    model.ngrams[ids[kind == 0]] = w[kind == 0]
    seen[ids[kind == 0]] = table[names[m:]].to_numpy()[kind == 0]
    words = ids[kind == 1].astype(np.uint32)
    has = fill_lexicon(model, words, c[kind == 1])
    model.lexicon_scores[words[has] & np.uint32(LEXICON - 1)] = w[kind == 1][has]
    if len(table):
        model.trans, model.start = w[kind == 2], w[kind == 3][0]
    return model, seen


def sampled(
    docs: DataFrame, rows_per_label: int, train_chars: int, max_labels: int, folds: int, held_out: int, calibrate: bool,
) -> tuple[list[tuple], list[tuple]]:
    """(doc_id, text, lang) of the training and, with ``calibrate``, of the held-out documents, at most rows_per_label a language each.

    Documents come by hash, those of at most train_chars characters first; of longer ones the first train_chars are taken, where
    a language has too few short ones. Rows that repeat are one. More than ``max_labels`` languages are an error.
    """
    held = fold(folds) == held_out
    key = F.xxhash64("doc_id", "lang", "text")
    labelled = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") > 0))
    labelled = labelled if calibrate else labelled.where(~held)
    order = Window.partitionBy("lang", "held").orderBy("long", "h", "key")
    chosen = (
        labelled.select("lang", held.alias("held"), (F.length("text") > train_chars).alias("long"), F.xxhash64("doc_id").alias("h"), key.alias("key"))
        .distinct()
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= rows_per_label)
    )
    most = max_labels * rows_per_label * (1 + calibrate)
    keys = [r[0] for r in chosen.select("key").limit(most + 1).collect()]
    if len(keys) > most:
        raise ValueError(f"more than {max_labels} languages")
    if not keys:
        return [], []
    got = labelled.where(key.isin(keys)).select("doc_id", F.substring("text", 1, train_chars).alias("text"), "lang", held.alias("held")).distinct()
    rows = sorted(tuple(r) for r in got.collect())
    return [r[:3] for r in rows if not r[3]], [r[:3] for r in rows if r[3]]


def train(
    docs: DataFrame, rows_per_label: int | None = None, train_chars: int = 5_000, max_labels: int = 256, folds: int = 3, held_out: int = 1,
) -> Model | None:
    """Fit on all labelled documents outside the held-out fold, or on a sample of so many a language; None without any."""
    if rows_per_label is None:
        return learned(docs, max_labels, folds, held_out)[0]
    rows, _ = sampled(docs, rows_per_label, train_chars, max_labels, folds, held_out, False)
    return fit([r[1] for r in rows], [r[2] for r in rows]) if rows else None


def fold(folds: int = 3):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def _posteriors(model: Model, texts: list[str]):
    codes, first, length, per_text = words_of(texts)
    if not len(first):
        return np.zeros((0, len(model.labels))), first, length, per_text
    new = np.zeros(len(first), dtype=bool)
    new[(np.cumsum(per_text) - per_text)[per_text > 0]] = True
    post = forward_backward(emissions(model, codes, first, length), new, model.trans, model.start)[0]
    return post, first, length, per_text


def judge(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score (mean posterior of that language over the words) of every text."""
    lang, score = [UND] * len(texts), np.zeros(len(texts))
    for part in slices([len(t or "") for t in texts], SLICE_CHARS):
        post, _, _, per_text = _posteriors(model, [t or "" for t in texts[part]])
        total = np.concatenate([np.zeros((1, post.shape[1])), np.cumsum(post, axis=0)])
        ends = np.cumsum(per_text)
        sums = total[ends] - total[ends - per_text]
        for i in np.flatnonzero(per_text):
            best = int(np.argmax(np.round(sums[i], 9)))
            lang[part.start + i], score[part.start + i] = model.labels[best], min(1.0, max(0.0, sums[i][best] / per_text[i]))
    return lang, score


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents with lang_pred and score."""
    clean = docs.drop("lang_pred", "score")
    if model is None or not model.labels:
        return clean.select("*", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))

    @F.pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        lang, score = judge(model, [t if isinstance(t, str) else None for t in text])
        release()
        return pd.DataFrame({"lang_pred": lang, "score": score})

    got = clean.withColumn("_crf", predict("text"))
    return got.select(*clean.columns, "_crf.lang_pred", "_crf.score")


def label_runs(docs: DataFrame, model: Model) -> DataFrame:
    """Runs of neighbouring words with one most likely language: (doc_id, run, first_word, n_words, lang, probability)."""

    def runs(batches):
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                if not isinstance(text, str):
                    continue
                post = _posteriors(model, [text])[0]
                if not len(post):
                    continue
                best = post.argmax(axis=1)
                cut = np.concatenate(([0], np.flatnonzero(np.diff(best)) + 1))
                sizes = np.diff(np.append(cut, len(best)))
                mean = np.add.reduceat(post.max(axis=1), cut) / sizes
                yield pd.DataFrame({
                    "doc_id": pd.Series([doc_id] * len(cut), dtype="Int64"), "run": np.arange(len(cut)), "first_word": cut,
                    "n_words": sizes, "lang": [model.labels[j] for j in best[cut]], "probability": mean})

    return docs.select("doc_id", "text").mapInPandas(runs, "doc_id long, run long, first_word long, n_words long, lang string, probability double")


@dataclass
class Background:
    """What words weigh against a text of no learned language."""

    evidence: np.ndarray  # (2 ** BITS, labels): log share of each three-gram in the language, less the language's bar
    spread: float  # deviation of one three-gram's log share in its own language


def shares(seen: np.ndarray) -> np.ndarray:
    """Log share of each three-gram in each language."""
    kinds = np.count_nonzero(seen.any(axis=1)) + 1
    return np.log((seen + 0.5) / (seen.sum(axis=0) + 0.5 * kinds))


def mean_shares(held: DataFrame, share: np.ndarray, labels: list[str]) -> DataFrame:
    """(label, own, mean): per document and language the mean log share of its three-grams, and whether that is its own language."""

    def run(batches):
        for batch in batches:
            for part in slices([len(t) for t in batch["text"]], SLICE_CHARS):
                here = batch.iloc[part]
                codes, first, length, per_text = words_of(here["text"].tolist())
                if not len(first):
                    continue
                has = np.flatnonzero(per_text)
                begins = (np.cumsum(per_text) - per_text)[has]
                by_word = gathered(share[grams(codes)], first, length)
                mean = np.add.reduceat(by_word, begins, axis=0) / np.add.reduceat(length, begins)[:, None]
                keys, langs = here["key"].to_numpy()[has], here["lang"].to_numpy()[has]
                for j, label in enumerate(labels):
                    yield pd.DataFrame({"key": keys, "label": j, "own": langs == label, "mean": mean[:, j]})

    rows = held.select("key", "lang", "text").mapInPandas(lean(run), "key long, label int, own boolean, mean double")
    return rows.dropDuplicates(["key", "label"]).drop("key")


def background(held: DataFrame, seen: np.ndarray, labels: list[str]) -> Background:
    """Log shares of three-grams from the training texts, and each language's bar from the held-out ones.

    The bar of a language lies halfway between the mean log shares of its own held-out texts (the low end, without the last
    fiftieth) and those of the other languages' (the high end), which stand for languages that were not learned; it is never over
    the low end of its own. A single language has the share of a three-gram never seen as the other end. Without a held-out
    text nothing is known of a language, and it rejects nothing.
    """
    share = shares(seen)
    rows = written(mean_shares(held, share, labels), "language-means")
    ends = {(r["label"], r["own"]): r for r in quantiles(rows, ["label", "own"], "mean", {"low": 0.02, "high": 0.98}).collect()}
    bars, spread = np.full(len(labels), -np.inf), 0.0
    for j in range(len(labels)):
        if (j, True) in ends:
            low = ends[j, True]["low"]
            bars[j] = min(low, (low + (ends[j, False]["high"] if (j, False) in ends else share[:, j].min())) / 2)
            own_share = seen[:, j] / seen[:, j].sum()
            spread = max(spread, float(np.sqrt(own_share @ (share[:, j] - own_share @ share[:, j]) ** 2)))
    return Background(np.where(np.isfinite(bars), share - bars, 0).astype(np.float32), spread)


def known(model: Model, back: Background, texts: list[str | None], allow: float = 3.0) -> np.ndarray:
    """Whether a text has words, and they are words of the learned languages.

    Every word weighs by its posterior over the languages, so that a text may switch between them. Short texts may fall under
    the bar by ``allow`` deviations of a mean of so many three-grams.
    """
    out = np.zeros(len(texts), dtype=bool)
    for part in slices([len(t or "") for t in texts], SLICE_CHARS):
        codes, first, length, per_text = words_of([t or "" for t in texts[part]])
        if not len(first):
            continue
        new = np.zeros(len(first), dtype=bool)
        new[(np.cumsum(per_text) - per_text)[per_text > 0]] = True
        post = forward_backward(emissions(model, codes, first, length), new, model.trans, model.start)[0]
        by_word = (post * gathered(back.evidence[grams(codes)], first, length)).sum(axis=1)
        total, letters, ends = np.concatenate([[0], np.cumsum(by_word)]), np.concatenate([[0], np.cumsum(length)]), np.cumsum(per_text)
        n = letters[ends] - letters[ends - per_text]
        out[part] = (per_text > 0) & (total[ends] - total[ends - per_text] >= -allow * back.spread * np.sqrt(n))
    return out


def keep_identified(docs: DataFrame, max_labels: int = 256, folds: int = 3, held_out: int = 1) -> DataFrame:
    """Documents in the learned languages, by a bar that the labelled documents of the held-out fold set; the columns stay."""
    model, seen = learned(docs, max_labels, folds, held_out)
    if model is None:
        return docs.where(F.lit(False))
    back = background(labelled_docs(docs).where(fold(folds) == held_out), seen, model.labels)

    @F.pandas_udf("boolean")
    def keep(text: pd.Series) -> pd.Series:
        out = known(model, back, [t if isinstance(t, str) else None for t in text])
        release()
        return pd.Series(out)

    return docs.where(keep("text"))


@query("op8_language_crf")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = identify(docs.select("doc_id", "text"), train(docs))
    return got.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
