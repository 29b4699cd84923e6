"""Manifest, whitening and fingerprints against plain Python versions, with nulls, repeats, ties, empty tables and clashing columns."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, grp string, n long, pos long, digest string, block long, root string, part int, first boolean"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for i in range(640):
        text = " ".join("".join(rng.choice("abcdefghiABCé日") for _ in range(rng.randint(1, 9))) for _ in range(rng.choice([0, 1, 3, 40, 160])))
        source = rng.choice(["hot"] * 12 + ["a", "b", "é", "", None, f"s{i % 25}"])
        out.append((i, text, rng.choice(["en", None]), source, rng.choice([len(text), None])))
    out += [(641, None, None, "alone", None), (642, "", "", "pair", 0), (643, "x", "", "pair", 1), (644, "Q" * 5000, "", "pair", 1)]
    out += [out[3]] * 3 + [(3, "OTHER text", "en", out[3][3], 10), (None, "no id", "en", "hot", 5), (None, "No Id 2", "en", "hot", 5), (None, None, None, None, None)]
    return [(*r, "g", 1, 2, "d", 3, "r", 4, True) for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


# 11 -----------------------------------------------------------------------------------------------------------------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(nodes):
    """Levels of the tree over the nodes."""
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][a : a + 16]) for a in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, p):
    """(digests to the left, to the right) on every level."""
    for nodes in levels[:-1]:
        a = p - p % 16
        yield nodes[a:p], nodes[p + 1 : a + 16]
        p //= 16


def plain_manifest(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))),) for s in order}
    trees = {s: (got, tree([leaf(*r) for r in got])) for s, (got,) in trees.items()}
    top = tree([trees[s][1][-1][0] for s in order])
    for k, s in enumerate(order):
        got, levels = trees[s]
        for p, r in enumerate(got):
            steps = [*path(levels, p), *path(top, k)]
            d = leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                d = leaf(r[0], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1]), *r[2:])
            for left, right in steps:
                d = H(*left, d, *right)
            yield (r[0], leaf(*r), levels[-1][0], top[-1][0], H(*[x for left, right in steps for x in left + right]), d, d == top[-1][0])


def test_manifest_equals_plain_version(docs, rows, monkeypatch):
    from larkframe.llm import merkle_manifest as m

    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = sorted(plain_manifest([r[:5] for r in rows]), key=str)
    got = sorted((tuple(r) for r in m.manifest(docs).select(*columns).collect()), key=str)
    assert got == want
    assert 0 < sum(not r[-1] for r in got) < len(got)
    for one in ([rows[0]], rows[:2]):
        small = docs.sparkSession.createDataFrame(one, DOCS)
        assert sorted((tuple(r) for r in m.manifest(small).select(*columns).collect()), key=str) == sorted(plain_manifest([r[:5] for r in one]), key=str)
    assert m.manifest(docs.limit(0)).count() == 0


def test_manifest_sql_equals_plain_version(rows):
    from larkframe.llm import merkle_manifest as m

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [r[:5] for r in rows])
    rel = con.execute(m.SQL)
    names = [d[0] for d in rel.description]
    assert names == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(rel.fetchall(), key=str) == sorted(plain_manifest([r[:5] for r in rows]), key=str)


def test_proofs_of_blocks_lead_to_the_root():
    from larkframe.llm import merkle_manifest as m

    for n in (1, 2, 15, 16, 17, 33, 255, 256):
        digests = [H(str(i)) for i in range(n)]
        done, label = m.ascend(digests, 0, n)
        assert done[label] == tree(digests)[-1][0]
        for p, proof in m.descend(done, label, ""):
            assert m.fold(digests[p], proof, 0, [(p, n)]) == done[label]
            assert m.fold(H("other"), proof, 0, [(p, n)]) != done[label]


# 12 -----------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    mixing = rng.normal(size=(24, 24)) * np.geomspace(3, 0.05, 24)
    base = [[float(np.float32(x)) for x in v] for v in rng.normal(size=(900, 24)) @ mixing]
    out = [(i, v, "c") for i, v in enumerate(base)]
    out += [(2000 + i, base[7], None) for i in range(400)] + [(7, base[7], None)]  # copies and a repeated row
    out += [(3000, None, None), (3001, [], None), (3002, [float("nan")] * 24, None), (3003, [1.0, None], None), (3004, [float("inf")] + [0.0] * 23, None)]
    out += [(None, base[3], None)]
    out += [(4000 + i, [float(a), 2.0 * a, 5.0], None) for i, a in enumerate((1, 2, 4, 9))] + [(5000, [3.0, 4.0], None)] * 2
    return spark.createDataFrame(out, "vec_id long, embedding array<float>, component string").repartition(4).cache()


def usable(vectors):
    by = defaultdict(list)
    for r in vectors.collect():
        v = r.embedding
        if v and all(x is not None and np.isfinite(x) for x in v):
            by[len(v)].append((r.vec_id, [int(np.floor(64 * x)) + 1000000 for x in v]))
    return by


def test_whitening_equals_dense_eigenvectors(vectors):
    from larkframe.llm.whitening import whitened

    got = defaultdict(list)
    for r in whitened(vectors).collect():
        got[r.dims].append(r)
    ranks = {24: 16, 3: 1}  # the three-entry vectors lie on a line; the two-entry ones are one vector
    assert set(got) == set(ranks)
    for dims, rows in usable(vectors).items():
        if dims not in ranks:
            continue
        fit = np.unique(np.array([x for _, x in rows]), axis=0)
        n, total = len(fit), fit.sum(axis=0)
        v = ((n * fit - total) / n).T @ ((n * fit - total) / n) / n
        values, axes = np.linalg.eigh(v)
        values, axes = values[::-1][: ranks[dims]], axes[:, ::-1][:, : ranks[dims]]
        want = defaultdict(list)
        for vec_id, x in rows:
            apart = n * np.array(x) - total
            for k, w in enumerate((apart / n @ axes) / np.sqrt(values), 1):
                want[vec_id, k].append((n, sum(int(a) ** 2 for a in apart), abs(w), values[k - 1] / np.trace(v)))
        assert len(got[dims]) == sum(map(len, want.values()))
        for r in got[dims]:
            w = want[r.vec_id, r.component][0]
            assert (r.n, int(r.deviation)) == w[:2]
            assert abs(r.whitened) == pytest.approx(w[2], abs=1e-7) and r.explained == pytest.approx(w[3], rel=1e-9)
            assert r.identity_error < 1e-8
        signs = {(r.component, r.vec_id): np.sign(r.whitened) for r in got[dims]}
        for k in range(1, ranks[dims] + 1):  # one sign for all rows
            own = {vec_id: float((n * np.array(x) - total) / n @ axes[:, k - 1]) for vec_id, x in rows}
            same = {signs[k, i] * np.sign(p) for i, p in own.items() if abs(p) > 1e-6}
            assert len(same) == 1
    assert whitened(vectors.limit(0)).count() == 0
    assert whitened(vectors.where("vec_id = 5000")).count() == 0


def test_factor_and_rotations():
    from larkframe.llm.whitening import components, jacobi, pivoted_cholesky, squares

    rng = np.random.default_rng(2)
    a = rng.normal(size=(40, 9))
    v = a @ a.T
    factor = pivoted_cholesky(v)
    assert factor.shape == (40, 9) and np.allclose(factor @ factor.T, v)
    values, axes = jacobi(factor)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:9]) and np.allclose(axes.T @ axes, np.eye(9)) and np.allclose(axes * values @ axes.T, v)
    assert pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0) and len(components(np.zeros((3, 3)))[0]) == 0
    graded = np.diag([1e12, 1.0, 1e-9])
    assert np.allclose(jacobi(pivoted_cholesky(graded))[0], [1e12, 1.0], rtol=1e-12) or np.allclose(jacobi(pivoted_cholesky(graded))[0], [1e12, 1.0, 1e-9], rtol=1e-12)
    assert int(squares(np.array([[1 << 40, 3]]))[0].as_py()) == (1 << 80) + 9


def test_too_large_entries_are_an_error(spark):
    from larkframe.llm.whitening import whitened

    with pytest.raises(Exception, match="too large"):
        whitened(spark.createDataFrame([(1, [1e300, 1.0])], "vec_id long, embedding array<double>"))


# 13 -----------------------------------------------------------------------------------------------------------------

def plain_windows(text, m):
    """(bytes, level) of every window; a short text is one window, filled up with pads."""
    text = text + bytes([m.PAD]) * (m.SPAN - len(text)) if text else text
    for a in range(len(text) - m.SPAN + 1):
        w = text[a : a + m.SPAN]
        total = sum(int(m._STEP[1 : w.count(c) + 1].sum()) for c in set(w))
        yield w, min(m.LEVELS - 1, (m._SUMMED - total) * (m.LEVELS - 1) // m._SUMMED)


def plain_features(text, rank, m):
    windows = list(plain_windows(text, m))
    votes = [0] * len(windows)
    for a in range(-m.SPAN + 1, len(windows) if windows else -m.SPAN):
        run = range(max(a, 0), min(a + m.SPAN, len(windows)))
        votes[min(run, key=lambda i: (rank[windows[i][1]], i))] += 1
    return [windows[i][0] for i, n in enumerate(votes) if n >= m.VOTES]


def test_features_equal_plain_version(monkeypatch):
    from larkframe.llm import rare_windows as m

    rng = random.Random(3)
    texts = ["".join(rng.choice("abcd é日") for _ in range(n)) for n in (0, 1, 5, 30, 31, 32, 33, 64, 100, 700, 2500)] + ["a" * 300, "ab" * 200]
    raw = [t.encode() for t in texts]
    counts = np.zeros(m.LEVELS, dtype=int)
    for t in raw:
        for _, level in plain_windows(t, m):
            counts[level] += 1
    assert (m.level_counts(raw) == counts).all()
    rank = m.order_of(counts)
    assert sorted(rank) == list(range(m.LEVELS)) and rank[m.FLOOR - 1] > rank[m.FLOOR :].max()
    want = [plain_features(t, rank, m) for t in raw]
    hashed = {}
    for t, f, h in zip(raw, want, m.features(raw, rank)):
        assert len(f) == len(h) and (len(f) > 0) == (len(t) > 0)
        for w, x in zip(f, h):
            assert hashed.setdefault(w, x) == x
    assert len(set(hashed.values())) == len(hashed)
    whole = [list(h) for h in m.features(raw, rank)]
    monkeypatch.setattr(m, "PIECE", 100)
    assert [list(h) for h in m.features(raw, rank)] == whole and (m.level_counts(raw) == counts).all()


def test_likeness_of_fingerprints():
    from larkframe.llm import rare_windows as m

    rng = random.Random(8)
    a, b = ("".join(rng.choice("abcdefgh ") for _ in range(9000)) for _ in range(2))
    rank = m.order_of(m.level_counts([a.encode(), b.encode()]))
    fa, fb, fh = m.fingerprints([a.encode(), b.encode(), (a[:4500] + b[:4500]).encode()], rank)
    assert m.likeness(fa, fa) == 1.0 and m.likeness("", "") == 1.0 and m.likeness("", fa) == 0.0
    assert m.likeness(fa, fb) < 0.1 and 0.4 < m.likeness(fa, fh) < 0.65 and m.likeness(fa, fh) == pytest.approx(m.likeness(fh, fa))
    sizes, bits = m._filters(fa)
    assert (sizes[:-1] == m.FULL).all() and bits.shape == (len(sizes), m.BITS) and (bits.sum(axis=1) <= m.EACH * sizes).all()


def test_edited_documents_equal_plain_version(docs, rows, monkeypatch):
    from pyspark.sql import functions as F

    from larkframe.llm import rare_windows as m

    k = {r.text: r.h for r in docs.select(F.coalesce("text", F.lit("")).alias("text")).distinct().withColumn("h", F.xxhash64("text")).collect()}
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0), k[r[1]]))
    counts = np.zeros(m.LEVELS, dtype=int)
    for _, t in order:
        for _, level in plain_windows(t.encode(), m):
            counts[level] += 1
    rank = m.order_of(counts)
    want = []
    for (i, a), (_, b) in zip(order, order[1:] + order[:1]):
        e = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
        pa, pe, pb = m.fingerprints([a.encode(), e.encode(), b.encode()], rank)
        want.append((i, len(a), hashlib.sha256(e.encode()).hexdigest(), pa, pe, m.likeness(pa, pe), m.likeness(pa, pb)))
    got = [tuple(r) for r in m.compared(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    one = m.compared(docs.where("doc_id = 644")).collect()
    assert [(r.doc_id, r.near_edited, r.near_next) for r in one] == [(644, 1.0, 1.0)]
    assert m.compared(docs.limit(0)).count() == 0
