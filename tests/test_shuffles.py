"""Steps that must not move rows more than once, or not at all, with the results of plain Python."""

import hashlib
import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F


def test_terms_are_counted_without_shuffling_documents(spark, monkeypatch):
    from larkframe.learning import features as fe

    rows = [(1, "a b a c"), (2, "a"), (2, "b"), (2, "b c"), (2, "c c"), (None, "d a"), (None, "d e"), (3, None), (4, ""), (5, "e e e")]
    df = spark.createDataFrame(rows, "k long, text string")
    want = Counter()
    for k, text in rows:
        for w in (text or "").split():
            want[k, len(text.split()), w] += 1
    df_of = Counter(w for _, _, w in want)
    words = fe.tokens(F.col("text"))
    for most in (100, 2):  # all terms go to every task, or two of them
        monkeypatch.setattr(fe, "FREQUENT", most)
        got = Counter((r.k, r.term, r.tf, round(r.tfidf, 9)) for r in fe.tf_idf(df, "k", words, 10).collect())
        assert got == Counter((k, w, tf, round(tf / n * math.log(1 + 10 / df_of[w]), 9)) for (k, n, w), tf in want.items())
    alone = df.where("k in (1, 5)")
    assert "Exchange" not in fe.terms_by_row(alone, "k", words)._jdf.queryExecution().toString()


def test_bootstrap_reads_the_rows_once(spark):
    from larkframe.learning import resample as rs

    df = spark.createDataFrame([(f"k{i % 40}",) for i in range(50)] + [(None,)], "key string")
    got = rs.bootstraps(df, ["key"], 3)
    assert sorted(map(tuple, got.groupBy("rep").agg(F.sum("times")).collect())) == [(1, 51), (2, 51), (3, 51)]
    assert got.schema["rep"].dataType.simpleString() == "int" and got.schema["times"].dataType.simpleString() == "bigint"
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") == 1  # places were taken twice before


def test_candidates_of_a_power_are_rows(spark):
    from larkframe.learning import features as fe

    x = np.random.default_rng(3).gamma(2.0, 3.0, 400) + 0.1
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")

    def plain(v, lam):
        return np.log(v) if abs(lam) < 1e-9 else (v**lam - 1) / lam

    lik = [-len(x) / 2 * np.log(plain(x, lam).var()) + (lam - 1) * np.log(x).sum() for lam in fe.LAMBDAS]
    assert fe.best_lambda(df, "x", "box_cox") == fe.LAMBDAS[int(np.argmax(lik))]
    lik = [-len(x) / 2 * np.log(plain(x + 1, lam).var()) + (lam - 1) * np.log(x + 1).sum() for lam in fe.LAMBDAS]
    assert fe.best_lambda(df, "x", "yeo_johnson") == fe.LAMBDAS[int(np.argmax(lik))]
    assert [fe.best_lambda(df, "x", "box_cox", [lam]) for lam in (0.0, 2.0)] == [0.0, 2.0]


def test_digests_travel_without_the_key(spark):
    from larkframe.operators.hashing import hash_positions

    df = spark.range(1000).select(F.concat(F.lit("key-"), "id").alias("key"), F.col("id").alias("v"))
    got = hash_positions(df, ["key"], "s").select("pos", "v")
    assert "key" not in [ln for ln in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in ln][0]
    order = sorted(range(1000), key=lambda i: hashlib.md5(f"key-{i}-s".encode()).hexdigest())
    assert [r.v for r in got.orderBy("pos").collect()] == order
