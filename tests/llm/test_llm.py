"""Every operator against brute force or the library it must equal, with nulls, empty tables, repeated rows and clashing columns."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, k string, pos string, node string, label string, row string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    passage = words(rng, 60)
    base = words(rng, 300)
    edited = base.split()
    edited[100:104] = ["x1", "x2", "x3", "x4"]
    copy = "\n".join(words(rng, 8) for _ in range(6))
    texts = [
        words(rng, 200), f"{words(rng, 90)} {passage} {words(rng, 40)}", f"{passage} {words(rng, 70)}", f"{words(rng, 30)}\n{passage}",
        base, " ".join(edited), base + " tail of it", None, "", "   ", "one two", "one two", "one two three", copy, copy + "\nlast line", "top\n" + copy,
        "a a a a a a a a a a " * 12, words(rng, 3000), "x\n\n\n\n\n\ny", "<|endoftext|> mark  <|endoftext|>", "12345 --- ...", "é ü ß  ñ  日本 😀",
    ]
    out = [(i, t, "en", "k", "p", "n", "l", "r", len(t) if t is not None else None) for i, t in enumerate(texts)]
    out += [out[0], out[0]]  # repeated rows
    out += [(3, "another text under the same id", None, None, None, None, None, None, 5), (None, words(rng, 60), "en", *[None] * 5, 1), (None, None, *[None] * 7)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def blank(text):
    return re.findall(r"[^ \t\n\r\f\v]+", text or "")


# 1 ------------------------------------------------------------------------------------------------------------------

def test_repeats_equal_brute_force(docs, rows, nothing):
    from larkframe.llm import suffix_dedup as m
    from larkframe.llm.common import keyed

    k = {(r.doc_id, r.text): r.k for r in keyed(docs).distinct().collect()}
    order = sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is None, r[0] or 0, k[r]))
    seen, want = set(), {}
    for key in order:
        w = blank(key[1])
        for j in range(len(w) - m.LEAST + 1):
            window = tuple(w[j : j + m.LEAST])
            if window in seen:
                want.setdefault((key[0], k[key]), set()).update(range(j, j + m.LEAST))
            seen.add(window)
    got = {}
    text = {(a, k[a, b]): blank(b) for a, b in order}
    for r in m.repeats(docs).collect():
        got.setdefault((r.doc_id, r.k), set()).update(range(r.start, r.start + r.n_words))
        assert text[r.doc_id, r.k][r.start : r.start + r.n_words] == text[r.source_doc_id, r.source_k][r.source_start : r.source_start + r.n_words]
    assert got == want and len(want) >= 4
    assert m.repeats(nothing).count() == 0


def test_only_written_tables_are_dropped(spark, tmp_path):
    from larkframe.llm.common import dropped, written

    rows = spark.range(5)
    a, b = written(rows, "here"), written(rows, "there")
    dropped(a)
    assert b.count() == 5
    with pytest.raises(Exception):
        spark.read.schema(a.schema).parquet(*a.inputFiles()).count()
    rows.write.parquet(str(tmp_path / "own"))
    with pytest.raises(ValueError):
        dropped(spark.read.parquet(str(tmp_path / "own")))
    assert spark.read.parquet(str(tmp_path / "own")).count() == 5


def test_passages_are_cut(docs, nothing):
    from larkframe.llm import suffix_dedup as m

    kept = m.keep_new_passages(docs)
    assert kept.columns == docs.columns
    assert m.without("a b  c d", [(1, 2)]) == "a  d"
    assert m.keep_new_passages(nothing).count() == 0
    assert m.repeats(kept.where("doc_id < 4")).count() == 0


# 2, 3 ---------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24))
    out = []
    for i in range(700):
        v = centres[i % 6] + rng.normal(size=24) * (0.12 if i % 3 else 0.9)
        out.append((i, [float(np.float32(x)) for x in v], i % 4 if i % 5 else 1, "x"))
    out += [(700 + i, out[12][1], out[12][2], None) for i in range(40)]  # copies
    out += [(900, None, 1, None), (901, [], 1, None), (902, [0.0] * 24, 1, None), (903, [float("nan")] * 24, 1, None), (904, [1.0, None], 1, None),
            (905, out[12][1], None, None), (906, [1.0, 2.0], 1, None), (907, [1.0, 2.1], 1, None), (950, [float("inf")] * 24, 1, None)]
    return spark.createDataFrame(out, "vec_id long, embedding array<float>, label int, node string").repartition(3).cache()


def sound(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


def test_near_vectors_equal_brute_force(spark, vectors):
    from larkframe.llm.cosine_dedup import near_vectors

    all_ = vectors.collect()
    ok = [r for r in all_ if sound(r.embedding) and any(r.embedding) and r.label is not None]
    links, root = Counter(), {r.vec_id: r.vec_id for r in all_}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(ok, 2):
        if a.label == b.label and len(a.embedding) == len(b.embedding):
            x, y = np.array(a.embedding, dtype=float), np.array(b.embedding, dtype=float)
            if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.93:
                links[a.vec_id] += 1
                links[b.vec_id] += 1
                x, y = sorted((find(a.vec_id), find(b.vec_id)))
                root[y] = x
    want = {(r.vec_id, links[r.vec_id], find(r.vec_id), find(r.vec_id) == r.vec_id) for r in all_}
    assert {tuple(r) for r in near_vectors(vectors, tile=64).collect()} == want
    assert sum(links.values()) > 1000
    assert near_vectors(vectors.limit(0)).count() == 0


def test_vectors_travel_once_per_block(spark, vectors, monkeypatch):
    from larkframe.llm import cosine_dedup as m

    x = np.random.default_rng(8).normal(size=(2000, 16))
    x[1500:] = x[:500] + 0.05
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    kept, make = {}, m.written

    def spy(df, name, **kw):
        kept[name] = make(df, name, **kw)
        return kept[name]

    monkeypatch.setattr(m, "written", spy)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.93
    assert {r.vec_id: r.n_links for r in m.near_vectors(rows, tile=20).collect()} == dict(enumerate(near.sum(axis=1) - 1))
    tiles, sent = kept["cosine-tiles"].count(), kept["cosine-goals"].count()
    assert tiles >= 100 and sent <= 3 * tiles  # each tile met each other one by itself before: some 100 x tiles
    whole = {tuple(r) for r in m.near_vectors(vectors).collect()}
    for block in (1, 20 * 24 * 4):  # blocks of one tile, of a few tiles
        monkeypatch.setattr(m, "BLOCK", block)
        assert {tuple(r) for r in m.near_vectors(vectors, tile=20).collect()} == whole


def test_vectors_of_any_size_link(spark):
    from larkframe.llm.cosine_dedup import near_vectors

    got = [[x, 2 * x, 0.0] for x in (1e-200, 1e200, 5e-324, 1.0, 8e307)] + [[0.0, 0.0, 1e-310], [-1e200, -2e200, 0.0], [1e200, 2e200, 1e199]]
    rows = spark.createDataFrame([(i, v, 1) for i, v in enumerate(got)], "vec_id long, embedding array<double>, label int")
    want = {0, 1, 2, 3, 4, 7}
    assert {tuple(r) for r in near_vectors(rows).collect()} == {(i, 5 * (i in want), 0 if i in want else i, i == 0 or i not in want) for i in range(8)}


def test_top_products_equal_brute_force(vectors, monkeypatch):
    from larkframe.llm import cover_search as m

    monkeypatch.setattr(m, "BLOCK", 100)
    monkeypatch.setattr(m, "GROUP", 8)
    ok = {r.vec_id: np.floor(256 * np.array(r.embedding, dtype=float)).astype(np.int64) for r in vectors.collect() if sound(r.embedding)}
    want = set()
    for q in (i for i in ok if i % 50 == 0):
        best = sorted((-int(ok[q] @ v), i) for i, v in ok.items() if i != q and len(v) == len(ok[q]))[:5]
        want |= {(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)}
    assert {tuple(r) for r in m.top_products(vectors, F.col("vec_id") % 50 == 0).collect()} == want
    assert m.top_products(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_too_many_vector_lengths_are_an_error(spark):
    from larkframe.llm.common import lengths_of

    rows = spark.createDataFrame([(i % 7,) for i in range(50)], "dims int")
    assert lengths_of(rows, 7) == list(range(7)) and lengths_of(rows.limit(0)) == []
    with pytest.raises(ValueError):
        lengths_of(rows, 6)


def test_trees_prune_clustered_points():
    from larkframe.llm.cover_search import search

    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 8)) * 4000
    x = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(size=(4000, 8)) * 20).astype(np.int64)
    got, compared = search(x[::5], np.arange(0, 4000, 5), x, np.arange(4000), 5, np.full(800, -np.inf))
    assert len(got) == 4000 and compared < 0.3 * 800 * 4000


@pytest.mark.parametrize("kind", ["clusters", "spread", "ties", "large"])
def test_walk_equals_plain_products(kind):
    from larkframe.llm.cover_search import search

    rng = np.random.default_rng(5)
    x = {
        "clusters": lambda: rng.normal(size=(60, 64))[rng.integers(60, size=8192)] * 256 + rng.normal(size=(8192, 64)) * 26,
        "spread": lambda: rng.normal(size=(1500, 64)) * 256,
        "ties": lambda: rng.integers(-2, 3, size=(1500, 3)).astype(float),
        "large": lambda: rng.normal(size=(600, 4)) * 2.0**28,
    }[kind]()
    x, ids = np.floor(x).astype(np.int64), rng.permutation(len(x))
    some = np.arange(0, len(x), 20)
    got, compared = search(x[some], ids[some], x, ids, 5, np.full(len(some), -np.inf))
    s = x[some] @ x.T
    want = set()
    for i, at in enumerate(some):
        by = np.lexsort((ids, -s[i]))
        want |= {(i, int(j), int(s[i, j])) for j in by[by != at][:5]}
    assert {tuple(r) for r in got.tolist()} == want
    share = compared / s.size
    print(f"{kind}: {share:.3f} of all products computed")
    assert share < (0.3 if kind == "clusters" else 1.1)


def test_scores_beyond_63_bits_are_an_error(spark):
    from larkframe.llm.cover_search import top_products

    def best(*vectors):
        rows = spark.createDataFrame([(i, list(v)) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
        return {tuple(r) for r in top_products(rows, F.col("vec_id") == 0, 1).collect()}

    big = 2.0**30
    assert best([big, 1.0], [1.0, 2.0], [0.5, 1.0]) == {(0, 1, 1, 2**46 + 2**17)}  # its product with itself would not fit
    for bad in ([[1e300, 1.0], [1e300, 2.0]], [[big, big], [big, big]]):
        with pytest.raises(Exception, match="does not fit 63 bits"):
            best(*bad)


# 4 ------------------------------------------------------------------------------------------------------------------

def test_lines(docs, rows, nothing):
    from larkframe.llm import line_dedup as m
    from larkframe.llm.common import keyed

    k = {(r.doc_id, r.text): r.k for r in keyed(docs).distinct().collect()}
    order = sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is None, r[0] or 0, k[r]))
    seen, want = set(), {}
    for key in order:
        lines = (key[1] or "").split("\n")
        gone = set()
        for j in range(len(lines) - 2):
            three = tuple(lines[j : j + 3])
            if any(x.strip(" ") for x in three):
                gone |= set(range(j, j + 3)) if three in seen else set()
                seen.add(three)
        want[key] = (None if key[1] is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), 0 if key[1] is None else len(lines), len(gone))
    got = m.dedup_lines(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    counted = Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect())
    assert counted == Counter((r[0], *want[r[0], r[1]]) for r in rows)
    assert sum(w[2] > 0 for w in want.values()) == 2
    assert m.dedup_lines(nothing).count() == 0 and m.keep_new_lines(docs).columns == docs.columns


# 5 ------------------------------------------------------------------------------------------------------------------

def test_archive_round_trip(spark, tmp_path):
    from larkframe.llm import warc as m

    long = "<p>" + "é" * 80
    data = [(1, "u1", long, 1), (2, "u2", long, 1), (2, "u2", long, 1), (3, "u\r\nX: y", "short", 1), (4, None, None, 1), (5, "u5", "", 1), (None, "u", long, 1), (6, "u6", "short", 1)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, digest long")
    m.write(pages, str(tmp_path / "a"))
    back = m.read(spark, str(tmp_path / "a"))
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back.collect())

    def digest(t):
        return hashlib.sha256((t or "").encode()).hexdigest()

    want = [(1, 163, digest(long), "response", None)] + [(i, 163, digest(long), "revisit", 1) for i in (2, 2, None)]
    want += [(i, len(t or ""), digest(t), "response", None) for i, t in ((3, "short"), (6, "short"), (4, None), (5, ""))]
    assert got == Counter(want)
    assert spark.read.parquet(str(tmp_path / "a/payloads")).count() == 3
    record = [r.record for r in m.records(back).where("page_id = 1").collect()][0]
    head, block = bytes(record).split(b"\r\n\r\n", 1)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response") and block == long.encode() + b"\r\n\r\n"
    m.write(pages.limit(0), str(tmp_path / "b"))
    assert m.read(spark, str(tmp_path / "b")).count() == 0


# 6, 9, 10 -----------------------------------------------------------------------------------------------------------

def library(path, rows):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch([r[1] or "" for r in rows], add_special_tokens=False)]


def test_packing(docs, rows, nothing):
    from larkframe.llm import packing as m

    got = m.pack(docs, BYTE, size=256, most_open=8).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and len(r.ids) == 4 * r.length
            at += r.length
        assert at <= 256
    ids = library(BYTE, rows)
    for i, r in enumerate(rows):
        if r[0] in (0, 3, None):
            continue
        parts = sorted(by_doc[r[0]], key=lambda p: p.piece)
        assert np.frombuffer(b"".join(bytes(p.ids) for p in parts), "<u4").tolist() == ids[i] + [0]
        assert all(p.length == 256 for p in parts[1:])
    assert sum(r.length for r in got) == sum(len(x) + 1 for x in ids)
    whole = {r.sequence_id: r for r in m.sequences(m.pack(docs, BYTE, size=256)).collect()}
    assert all(len(r.ids) == 4 * sum(r.lengths) for r in whole.values())
    assert m.pack(nothing, BYTE).count() == 0


def test_bins_are_near_the_bound():
    from larkframe.llm.packing import Bins, pieces_of

    rng = np.random.default_rng(1)
    sizes = np.minimum(rng.lognormal(6.5, 1, 20000).astype(int) + 1, 2048)
    bins = Bins(2048, 1024)
    for n in sizes:
        bins.put(int(n))
    assert bins.number < 1.02 * sizes.sum() / 2048
    assert pieces_of(2048) == [(0, 2048)] and pieces_of(4097) == [(0, 1), (1, 2048), (2049, 2048)]


def test_id_files(spark, docs, rows, nothing, tmp_path):
    from larkframe.llm import repair as m

    m.write_ids(docs, WORD, str(tmp_path / "a"), block_ids=500)
    got = m.documents_of(spark, str(tmp_path / "a"), {"ids": ("array<long>", lambda x: x.tolist())}).orderBy("start").collect()
    want = Counter((r[0], tuple(x + [2])) for r, x in zip(rows, library(WORD, rows)))
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is None, i or 0))
    m.write_ids(nothing, WORD, str(tmp_path / "b"))
    assert m.documents_of(spark, str(tmp_path / "b"), {}).count() == 0


def test_grammar_round_trip():
    from larkframe.llm import repair as m

    rng = np.random.default_rng(5)
    phrase = rng.integers(0, 50, 12)
    ids = np.concatenate([np.concatenate([phrase, rng.integers(0, 50, 3)]) for _ in range(400)]).astype(np.uint32)
    sizes = np.array([1000, 0, 1, 1999, 3000])
    block = m.compress(ids, sizes)
    assert np.array_equal(m.expand(block, np.frombuffer(block["symbols"], "<u4")), ids)
    assert len(block["symbols"]) + len(block["rules"]) < 0.5 * 4 * len(ids)
    begin = np.cumsum(sizes) - sizes
    for doc in range(5):
        assert np.array_equal(m.ids_of(block, doc), ids[begin[doc] : begin[doc] + sizes[doc]])
    assert np.array_equal(m.ids_of(block, 3, 700, 50), ids[begin[3] + 700 : begin[3] + 750])
    assert len(m.ids_of(block, 1)) == 0 and len(m.ids_of(block, 0, 5000, 3)) == 0
    same = m.compress(np.full(100, 7, dtype=np.uint32), np.array([100]))
    assert np.array_equal(m.expand(same, np.frombuffer(same["symbols"], "<u4")), np.full(100, 7))


def test_automaton(docs, rows, nothing):
    from larkframe.llm import bpe_automaton as m

    tok = Tokenizer.from_file(BYTE)
    want = []
    for r, ids in zip(rows, library(BYTE, rows)):
        back = tok.decode(ids, skip_special_tokens=False)
        want.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert Counter(tuple(r) for r in m.round_trip_digests(docs, BYTE).collect()) == Counter(want)
    back = m.decode_ids(m.encode_texts(docs, BYTE), BYTE).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((r[0], r[1] or "") for r in rows)
    assert m.round_trip_digests(nothing, BYTE).count() == 0


def test_automaton_equals_merging_on_random_words():
    from larkframe.llm.bpe_automaton import Automaton
    from larkframe.llm.tokens import ByteLevelEncoder, description_of

    rng = random.Random(2)
    merges, vocab = [], {c: i for i, c in enumerate("abc")}
    while len(merges) < 60:
        a, b = rng.choice(list(vocab)), rng.choice(list(vocab))
        if a + b not in vocab and len(a + b) < 9:
            vocab[a + b] = len(vocab)
            merges.append((a, b))
    machine, rank = Automaton(vocab, merges), {m: i for i, m in enumerate(merges)}

    def merged(word):
        parts = list(word)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (rank.get((parts[i], parts[i + 1]), 10**9), i))
            if (parts[best], parts[best + 1]) not in rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [vocab[p] for p in parts]

    for _ in range(3000):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))
        assert machine.encode(word) == merged(word)
    encoder, tok = ByteLevelEncoder(description_of(BYTE)), Tokenizer.from_file(BYTE)
    alphabet = ["a", "The", " ", "  ", "\n", "\t", "é", "1", "'s", "!", "<|endoftext|>", "\x1c", "　", "ǆ", "Z"]
    lower, word_tok = __import__("larkframe.llm.tokens", fromlist=["x"]).LowerWordEncoder(description_of(WORD)), Tokenizer.from_file(WORD)
    for _ in range(2000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)
        assert np.frombuffer(lower.encode(text), "<u4").tolist() == word_tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_blocks_of_ids_are_expanded_whole():
    from larkframe.llm import repair as m

    rng = np.random.default_rng(5)
    for _ in range(60):
        sizes = rng.integers(0, 9, rng.integers(1, 30))
        ids = rng.choice(np.array([0, 1, 2, 3, 2**20], dtype="<u4"), int(sizes.sum()))
        block = m.compress(ids, sizes, often=2)
        assert m.expand_all(block).tolist() == m.expand_all(block, at_once=3).tolist() == ids.tolist()
        ends = np.cumsum(sizes)
        assert [m.ids_of(block, i).tolist() for i in range(len(sizes))] == [ids[e - n : e].tolist() for e, n in zip(ends, sizes)]


def test_lower_words_are_kept_once_and_equal_the_library():
    from larkframe.llm.tokens import LowerWordEncoder, description_of

    encoder, tok = LowerWordEncoder(description_of(WORD)), Tokenizer.from_file(WORD)
    encoder.encode("An old, old Man\nan old man's")
    assert len(encoder.words) + len(encoder.parts) == len({"an", "old", ",", "man", "'s"})
    for c in map(chr, range(0x250)):
        for text in (c, f"a{c}b", f" {c} {c}{c}1", f"\n{c}'S  {c}'ll.{c}"):
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_texts_encoded_together_look_each_word_up_once_and_equal_the_library():
    from larkframe.llm.repair import encoded
    from larkframe.llm.tokens import LowerWordEncoder, description_of

    class Counting(dict):
        looked = 0

        def __getitem__(self, key):
            self.looked += 1
            return super().__getitem__(key)

        def __missing__(self, key):
            return self.setdefault(key, encoder._word(key))

    encoder, tok = LowerWordEncoder(description_of(WORD)), Tokenizer.from_file(WORD)
    encoder.words = Counting()
    encoder.encode_all(["an old, old man\nan old man's", "", "An Old man's man"] * 50)
    assert encoder.words.looked == len(encoder.words) == len({"an", "old", ",", "man", "'s"})
    rng = random.Random(4)
    alphabet = ["a", "s", "'", "'s", "'t", "'re", "'Ve", "'m", "'ll", "'d", "r", "e", "l", " ", "\n", "1", "\u00b2", "\u00c9", "\u0130", "\u01c6"]
    alphabet += ["\u00a0", "\x85", "!", "-", "\x00", "\x1c", "<|endoftext|>", "\u2019", "\u65e5", "e\u0301", "\u0149", "\u023a"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    for k in (1, 7, 3000):
        got = [ids for i in range(0, len(texts), k) for ids in encoder.encode_all(texts[i : i + k])]
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    batches = [pd.DataFrame({"doc_id": [3, None], "text": [None, "one two"]}), pd.DataFrame({"doc_id": [], "text": []}), pd.DataFrame({"doc_id": [9], "text": ["one"]})]
    for k in (1, 4, 100):
        assert list(encoded(encoder, iter(batches), k)) == [(3, b""), (None, encoder.encode("one two")), (9, encoder.encode("one"))]


def test_grammar_equals_one_that_counts_all_pairs_in_each_round():
    from larkframe.llm import repair as m

    def plain(docs, rounds, often):
        base, rules, sizes = max([x for d in docs for x in d], default=0) + 1, [], []
        for _ in range(rounds):
            count = Counter(p for d in docs for p in zip(d, d[1:]))
            left, right, chosen = set(), set(), []
            for (a, b), n in sorted(count.items(), key=lambda x: (-x[1], x[0])):
                if n >= often and a != b and a not in right and b not in left:
                    left.add(a)
                    right.add(b)
                    chosen.append((a, b))
            if not chosen:
                break
            number = {p: base + len(rules) + i for i, p in enumerate(sorted(chosen))}
            rules += sorted(chosen)
            sizes.append(len(chosen))
            for k, d in enumerate(docs):
                out, i = [], 0
                while i < len(d):
                    two = tuple(d[i : i + 2])
                    out.append(number.get(two, d[i]))
                    i += 2 if two in number else 1
                docs[k] = out
        return sizes, rules, docs

    rng = np.random.default_rng(6)
    for _ in range(150):
        sizes = rng.integers(0, 25, rng.integers(1, 30))
        ids = rng.choice(np.array([0, 1, 2, 3, 4, 5, 2**20]), int(sizes.sum()))
        ends = np.cumsum(sizes)
        often, rounds = int(rng.integers(2, 9)), int(rng.integers(1, 9))
        block = m.compress(ids, sizes, rounds, often)
        done, rules, docs = plain([ids[e - n : e].tolist() for e, n in zip(ends, sizes)], rounds, often)
        assert block["rounds"] == done and np.frombuffer(block["rules"], "<u4").reshape(-1, 2).tolist() == [list(r) for r in rules]
        assert np.frombuffer(block["symbols"], "<u4").tolist() == [x for d in docs for x in d]
        assert np.frombuffer(block["doc_symbols"], "<u4").tolist() == [len(d) for d in docs]


def test_places_of_pairs_that_share_a_bucket():
    from larkframe.llm import repair as m

    known = np.unique(np.random.default_rng(7).integers(0, 1 << 50, 4000).astype(np.uint64))
    assert len(np.unique(m._bucket(known))) < len(known)
    other = np.setdiff1d(known + np.uint64(1), known)
    key = np.concatenate([known, other])
    assert m._places(known, key, m._bucket(key)).tolist() == [*range(len(known)), *[-1] * len(other)]


def test_plain_texts_are_cut_as_the_library_does_and_each_word_is_kept_once():
    from larkframe.llm.tokens import ByteLevelEncoder, byte_encoder, description_of

    encoder, tok = ByteLevelEncoder(description_of(BYTE)), Tokenizer.from_file(BYTE)
    assert np.frombuffer(encoder.encode("an old, old man\nan old man"), "<u4").tolist() == tok.encode("an old, old man\nan old man").ids
    kept = [w for c in (encoder.plain, encoder.words, encoder.after_blank, encoder.exact) for w in c]
    assert len(kept) == len({"an", " old", ",", " man", "\n"})
    for c in map(chr, range(0x250)):
        for text in (c, f"a{c}b", f" {c} {c}{c}1", f"\n{c}'s  {c}'ll.{c}"):
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)
    assert byte_encoder(description_of(BYTE)) is byte_encoder(description_of(BYTE))


# 7 ------------------------------------------------------------------------------------------------------------------

def shingle_bag(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def test_near_duplicates_equal_brute_force(spark, docs, rows, nothing):
    from larkframe.llm import bag_minhash as m

    rng = random.Random(11)
    more = list(rows)
    family = words(rng, 120).split()
    for i in range(60):  # copies with more and more edits, and chains between them
        w = list(family)
        for j in rng.sample(range(120), i // 12):
            w[j] = f"edit{rng.randint(0, 3)}"
        more.append((100 + i, " ".join(w), *[None] * 7))
    table = spark.createDataFrame(more, SCHEMA).repartition(3)
    bags = [shingle_bag(r[1]) for r in more]
    root = list(range(len(more)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(more)), 2):
        inter, union = sum((bags[i] & bags[j]).values()), sum((bags[i] | bags[j]).values())
        if inter and 10 * inter >= 8 * union:
            root[find(j)] = find(i)
    least = {}
    for i, r in enumerate(more):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    want = Counter((r[0], least.get(find(i), r[0])) for i, r in enumerate(more))
    assert Counter((r.doc_id, r.class_id) for r in m.near_duplicates(table).collect()) == want
    kept = m.keep_one_of_each(docs)
    assert kept.columns == docs.columns and {5, 6, 11}.isdisjoint({r.doc_id for r in kept.collect()})
    assert m.near_duplicates(nothing).count() == 0


def test_unrelated_texts_without_an_id_of_their_own_stay(spark):
    from larkframe.llm import bag_minhash as m

    rng = random.Random(12)
    none, other, one, two, copied = (words(rng, 80) for _ in range(5))
    data = [(None, none), (None, other), (None, other + " tail"), (7, one), (7, two), (7, two), (None, copied), (9, copied), (None, ""), (None, " "), (8, None)]
    kept = m.keep_one_of_each(spark.createDataFrame(data, "doc_id long, text string").repartition(3)).collect()
    got = Counter((r.doc_id, r.text) for r in kept)
    assert got.keys() - {(None, other), (None, other + " tail")} == {(None, none), (7, one), (7, two), (9, copied), (None, ""), (None, " "), (8, None)}
    assert len(got) == 8 and set(got.values()) == {1}  # of the two near copies without an id one stays


def test_signature_estimates_weighted_jaccard():
    from larkframe.llm.bag_minhash import signatures

    rng = np.random.default_rng(0)
    shingle = rng.integers(0, 2**48, 60).astype(np.uint64)
    a, b = rng.integers(1, 40, 60), rng.integers(1, 40, 50)
    sig = signatures(np.repeat([0, 1], [60, 50]), np.concatenate([shingle, shingle[:50]]), np.concatenate([a, b]), 2, 20000)
    true = np.minimum(a[:50], b).sum() / (np.maximum(a[:50], b).sum() + a[50:].sum())
    assert abs((sig[0] == sig[1]).mean() - true) < 0.015


def test_narrow_tables_of_few_documents_are_few_files(spark, docs, monkeypatch):
    from larkframe.llm import bag_minhash as m

    files = {}

    def kept(df, name, *more, **options):
        out = written(df, name, *more, **options)
        files[name] = len(out.inputFiles())
        return out

    written = m.written
    want = {tuple(r) for r in m.near_duplicates(docs).collect()}
    monkeypatch.setattr(m, "written", kept)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert {tuple(r) for r in m.near_duplicates(docs).collect()} == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(files[f"bag-{x}"] <= 1 for x in ("nodes", "hubs", "members", "marked", "mixed", "open", "classes"))


# 8 ------------------------------------------------------------------------------------------------------------------

def test_language(spark, docs, nothing):
    from larkframe.llm import language_crf as m

    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = m.train(given)
    got = m.identify(given, model)
    assert got.where(m.fold() == 1).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.95
    en, fr = (given.where((F.col("lang") == x) & (F.length("text") < 3000)).orderBy("doc_id").first().text for x in ("en", "fr"))
    switched = spark.createDataFrame([(1, en + " " + fr), (2, None), (3, "12 34")], "doc_id long, text string")
    runs = m.label_runs(switched, model).where("n_words > 20").orderBy("first_word").collect()
    assert runs[0].lang == "en" and runs[-1].lang == "fr" and {r.doc_id for r in runs} == {1}
    odd = {r.text: r for r in m.identify(docs, model).collect()}
    assert odd[None].lang_pred == odd[""].lang_pred == odd["12345 --- ..."].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in odd.values())
    assert m.identify(nothing, m.train(nothing)).count() == 0 and m.train(given.withColumn("lang", F.lit(None).cast("string"))) is None


def test_language_of_long_or_repeated_documents_is_learned(spark):
    from larkframe.llm import language_crf as m

    docs = [(i, f"the house and the river number {'abcdefghij'[i % 10]} " * 3, "en") for i in range(40)]
    docs += [(100 + i, "la maison et le fleuve sont verts " * 40, "fr") for i in range(12)]  # all longer than train_chars
    docs += [(300, "das haus und der fluss sind grau", "de")] * 200 + [(400 + i, f"der baum und die katze {'abcdefghij'[i % 10]}", "de") for i in range(30)]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    rows, held = m.sampled(table, 20, 500, 256, 3, 1, True)
    by = Counter(r[2] for r in rows)
    assert by["en"] == 20 and by["fr"] >= 4 and by["de"] >= 15 and max(len(r[1]) for r in rows) == 500 and len(set(rows)) == len(rows)
    assert {r[2] for r in held} == {"en", "fr", "de"} and {r[0] for r in rows}.isdisjoint({r[0] for r in held})
    assert "fr" in m.train(table, rows_per_label=20, train_chars=500).labels


def test_whole_texts_of_all_labelled_documents_are_learned(spark):
    from larkframe.llm import language_crf as m

    same = "tano miru seko lavi podu " * 300  # over 5,000 characters that tell nothing
    docs = [(i, same + "plonk skree drumb " * 30, "aa") for i in range(12)] + [(100 + i, same + "quix wozzle brimp " * 30, "zz") for i in range(12)]
    docs += [(200 + i, "12 34", "no") for i in range(5)] + [(300 + i, f"tano miru {'abcdefghij'[i % 10] * 3}", "aa") for i in range(200)]
    docs += [(1_000, "fjord gnyx vlad " * 20, "zz")] * 3 + [(1_001 + i, "fjord gnyx vlad " * 20, "zz") for i in range(5)]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    models = [m.train(table.repartition(n)) for n in (1, 5)]
    assert m.judge(models[0], ["quix wozzle brimp", "fjord gnyx", "skree drumb plonk"])[0] == ["zz", "zz", "aa"]
    assert all(np.array_equal(getattr(models[0], x), getattr(models[1], x)) for x in ("ngrams", "lexicon", "lexicon_scores", "trans", "start"))
    model, seen = m.learned(table, 256, 3, 1)
    rows = {r for r in docs if zlib.crc32(str(r[0]).encode()) % 3 != 1}
    assert model.labels == ["aa", "no", "zz"]
    assert seen.sum(axis=0).tolist() == [sum(sum(map(str.isalpha, t)) for _, t, x in rows if x == lang) for lang in model.labels]


def test_shards_learn_together(spark, monkeypatch):
    from larkframe.llm import language_crf as m

    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    monkeypatch.setattr(m, "SHARD_CHARS", 1 << 16)
    got = m.identify(given, m.train(given)).where(m.fold() == 1)
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.95
    means = m.mean_shares(m.labelled_docs(given.unionByName(given)), np.zeros((1 << m.BITS, 2)), ["de", "en"])
    assert means.where("own").count() == given.where("lang in ('de', 'en') and text rlike '[A-Za-z]'").select("doc_id", "text", "lang").distinct().count()


def test_texts_of_unlearned_languages_go(spark):
    from larkframe.llm import language_crf as m

    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null and length(text) > 0")
    for learned in (("de", "en", "fr"), ("en", "es"), ("de",)):
        table = given.withColumn("lang", F.when(F.col("lang").isin(*learned), F.col("lang")))
        kept = Counter(r.doc_id for r in m.keep_identified(table).collect())
        own, other = Counter(), Counter()
        for r in given.collect():
            (own if r.lang in learned else other)[r.doc_id] += 1
        assert sum((kept & own).values()) >= 0.99 * sum(own.values()) and sum((kept & other).values()) <= 0.1 * sum(other.values())
    short = [" ".join(r.text.split()[:3]) for r in given.where("lang = 'en'").orderBy("doc_id").limit(40).collect()]
    more = [(10_000 + i, x, None) for i, x in enumerate([*short, "Привет мир это русский текст", "12 34", None])]
    kept = {r.doc_id for r in m.keep_identified(given.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"))).collect()}
    assert {i for i in kept if i >= 10_000} == {10_000 + i for i in range(40)}


def test_blocked_passes_equal_plain_ones():
    from larkframe.llm.language_crf import forward_backward

    rng = np.random.default_rng(4)
    scores, new = rng.normal(size=(700, 3)), rng.random(700) < 0.01
    new[0] = True
    trans, start = rng.normal(size=(3, 3)), rng.normal(size=3)
    post = forward_backward(scores, new, trans, start)[0]
    cut = np.append(np.flatnonzero(new), 700)
    for low, high in zip(cut, cut[1:]):
        a = np.exp(start + scores[low])
        alphas = [a / a.sum()]
        for i in range(low + 1, high):
            a = alphas[-1] @ np.exp(trans) * np.exp(scores[i])
            alphas.append(a / a.sum())
        b, betas = np.ones(3), [np.ones(3)]
        for i in range(high - 1, low, -1):
            b = np.exp(trans) @ (np.exp(scores[i]) * b)
            b /= b.sum()
            betas.append(b)
        plain = np.array(alphas) * np.array(betas[::-1])
        assert np.allclose(post[low:high], plain / plain.sum(axis=1, keepdims=True))


# all ----------------------------------------------------------------------------------------------------------------

def test_pipeline(spark):
    import corpus_pipeline as c

    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    packed = c.run(spark, "/root/testdata/sf0.001")
    assert packed.select("doc_id").distinct().count() <= given.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    assert [n for n, _ in c.STAGES] == ["language", "lines", "near_copies", "passages", "packing"]


def test_pipeline_equals_plain_python(spark, tmp_path):
    """The stages after the learned one, on rows with nulls, repeats, copied lines, near copies and copied passages."""
    import corpus_pipeline as c
    from larkframe.llm.common import keyed
    from larkframe.llm.suffix_dedup import LEAST

    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) between 400 and 2500").orderBy("doc_id").limit(60).collect()
    data = [(r.doc_id, r.text, r.lang) for r in given[:40]]
    extra = [r.text for r in given[40:]]
    data += [data[3], data[3], (data[5][0], extra[0], None), (None, None, None), (900, "12 34", None)]
    data += [(None, x, None) for x in extra[1:6]] + [(None, extra[1], None), (901, extra[2] + " und", None)]
    lines = "\n".join(" ".join(extra[6].split()[i : i + 6]) for i in range(0, 24, 6))
    data += [(902, lines + "\n" + extra[7], None), (903, extra[8] + "\n" + lines, None), (904, lines, None)]
    passage = " ".join((extra[9] + " " + extra[10]).split()[:LEAST + 12])
    data += [(905, extra[11] + " " + passage, None), (None, passage + " " + extra[12], None)]
    spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    now = [(r.doc_id, r.text) for r in c.language(spark, table, None).collect()]
    assert len(now) >= len(data) - 5

    def ordered(rows):
        k = {(r.doc_id, r.text): r.k for r in keyed(spark.createDataFrame(rows, "doc_id long, text string")).distinct().collect()}
        return sorted(k, key=lambda r: (r[0] is None, r[0] or 0, k[r]))

    seen, left = set(), {}
    for key in ordered(now):
        three = key[1].split("\n")
        gone = set()
        for j in range(len(three) - 2):
            w = tuple(three[j : j + 3])
            if any(x.strip(" ") for x in w):
                gone |= set(range(j, j + 3)) if w in seen else set()
                seen.add(w)
        left[key] = "\n".join(x for i, x in enumerate(three) if i not in gone) if len(gone) < len(three) else None
    assert any(a[1] != b for a, b in left.items())
    now = [(a[0], left[a]) for a in now if left[a] is not None]

    classes, before = [], len(now)  # lists of (place, row, bag); the first of a list is the one that stays
    for i, key in enumerate(ordered(now)):
        bag = shingle_bag(key[1])
        met = [x for x in classes if any(10 * sum((bag & y[2]).values()) >= 8 * sum((bag | y[2]).values()) for y in x)]
        classes = [x for x in classes if x not in met] + [sorted([y for x in met for y in x] + [(i, key, bag)], key=lambda y: y[0])]
    now = [x[0][1] for x in classes]
    assert len(now) < before

    seen, out = set(), Counter()
    for key in ordered(now):
        found = list(re.finditer(r"[^ \t\n\r\f\v]+", key[1]))
        w, gone, text = [x.group() for x in found], set(), key[1]
        for j in range(len(w) - LEAST + 1):
            window = tuple(w[j : j + LEAST])
            gone |= set(range(j, j + LEAST)) if window in seen else set()
            seen.add(window)
        for j in sorted(gone, reverse=True):
            text = text[: found[j - 1].end() if j - 1 in gone else found[j].start()] + text[found[j].end() :]
        if blank(text) or not gone:
            out[key[0], text] += 1
    assert sum(out[k] for k in out) >= 40 and set(out) - set(now)
    tok = Tokenizer.from_file(BYTE)
    want = Counter((i, tuple([*tok.encode(t, add_special_tokens=False).ids, 0])) for i, t in out.elements())
    packed = c.run(spark, str(tmp_path)).collect()
    assert all(r.piece == 0 for r in packed)
    assert Counter((r.doc_id, tuple(np.frombuffer(bytes(r.ids), "<u4").tolist())) for r in packed) == want


def test_queries_match_sql(spark):
    from compare import check, connect

    from larkframe.llm.queries import ORACLES, QUERIES

    con = connect("/root/testdata/sf0.001")
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 11)}
    for name, sql in ORACLES.items():
        assert check(spark, con, name, QUERIES[name], sql, "/root/testdata/sf0.001") is None


def test_crc_of_ids(spark):
    from larkframe.llm.queries import QUERIES

    path = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    tok = Tokenizer.from_file(WORD)
    for r in QUERIES["op9_repair_ids"](spark, path).limit(20).collect():
        ids = [*tok.encode(text[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))


def test_no_pandas_in_native_plan(spark):
    from larkframe.llm.queries import QUERIES

    plan = QUERIES["op4_line_windows"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
