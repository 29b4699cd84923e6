"""Steps that must hold beyond the small tables: large counts, hot keys, and plans that move few rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkframe.learning import metrics as mt
from larkframe.learning.resample import initial_split, vfold
from larkframe.operators.grouping import attach
from larkframe.operators.hashing import hash_positions, hash_ranges
from larkframe.operators.neighbors import distances, knn
from larkframe.plans import features


def test_auc_counts_pairs_beyond_32_bits(spark):
    d = spark.range(200_000).select((F.col("id") % 10 / 10).alias("p"), (F.col("id") % 2).cast("int").alias("event"))
    assert mt.roc_auc(mt.curve(d, [], "p", "event"), []).first()["auc"] == pytest.approx(0.6)


@pytest.mark.parametrize("edges, by", [([0, 3, 3, 70], None), ([40], ["g"]), ([2, 500], ["g"])])
def test_ranges_equal_places(spark, edges, by):
    rows = [(i if i % 11 else None, f"g{i % 3}" if i % 4 else None, i) for i in range(200)] + [(7, "g1", 1000 + i) for i in range(30)]
    d = spark.createDataFrame(rows, "id long, g string, row long").repartition(5)
    cuts = lambda n: [F.least(F.lit(e), n) for e in edges]
    for rows in (d, d.dropDuplicates(["id"]), d.limit(0)):
        got = hash_ranges(rows, ["id"], "s", cuts, by, "x")
        sizes = {tuple(r[:-1]): r[-1] for r in got.groupBy(*(by or []), "x").count().collect()}
        placed = hash_positions(rows, ["id"], "s", by, "p", "n").withColumn("x", sum((F.when(F.col("p") > F.least(F.lit(e), F.col("n")), 1).otherwise(0) for e in edges), F.lit(1)))
        assert sizes == {tuple(r[:-1]): r[-1] for r in placed.groupBy(*(by or []), "x").count().collect()}
    one = d.dropDuplicates(["id"])
    want = {r.row: r.x for r in hash_positions(one, ["id"], "s", by, "p", "n").withColumn("x", sum((F.when(F.col("p") > F.least(F.lit(e), F.col("n")), 1).otherwise(0) for e in edges), F.lit(1))).collect()}
    assert {r.row: r.x for r in hash_ranges(one, ["id"], "s", cuts, by, "x").collect()} == want


def test_splits_and_group_joins_do_not_shuffle_rows(spark):
    d = spark.range(2000).withColumn("g", F.col("id") % 3)
    for out in (vfold(d, ["id"], 5), initial_split(d, ["id"]), attach(d, ["g"], m=F.avg("id"))):
        plan = out._jdf.queryExecution().toString().split("Physical Plan")[1]
        assert "BroadcastHashJoin" in plan or "BroadcastNestedLoopJoin" in plan
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("dims, metric", [(2, "l2"), (3, "l1"), (16, "l2")])
def test_neighbours_by_blocks(spark, dims, metric):
    """Small leaves and blocks, so that all levels and many block pairs are met; few queries, so that some tasks have none."""
    rng = np.random.default_rng(dims)
    x = np.concatenate([rng.normal(0, 1, (500, dims)), rng.normal(8, 0.1, (200, dims))]).round(3)
    x[7::90, 0] = np.nan  # has no neighbours and is none
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    for few, same in ((d, True), (d.where("id % 50 = 0"), False)):
        got = knn(d, few, 4, same=same, metric=metric, leaf=16, chunk=90).collect()
        by = {}
        for r in got:
            by.setdefault(r.qid, []).append((r.place, r.nid))
        for q, found in by.items():
            far = distances(x[q][None], x, metric)[0]
            order = [i for i in np.lexsort((np.arange(len(x)), far)) if not np.isnan(far[i]) and (not same or i != q)][:4]
            assert [i for _, i in sorted(found)] == order
        assert set(by) == {r.id for r in few.select("id").collect() if not np.isnan(x[r.id, 0])}


def test_token_filter_drops_terms_before_the_count(spark, tables):
    out = features.fe_tokenfilter(tables)
    assert out.select("term").distinct().count() == 100
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]  # after terms are spread, rows meet no other table


def test_neighbours_on_a_lattice_of_lines(spark, monkeypatch):
    """One continuous and two coarse columns, as in the imputation by neighbours: a query meets a few hundred points, rows are dealt to cells twice."""
    from larkframe.operators import neighbors as nb

    meet, calls = nb._meet, []
    monkeypatch.setattr(nb, "_meet", lambda *a, **kw: calls.append(1) or meet(*a, **kw))
    rng = np.random.default_rng(11)
    x = np.stack([rng.random(24_000) * 4, rng.integers(0, 11, 24_000) / 3, rng.integers(0, 9, 24_000) / 2.5], axis=1)
    d = spark.createDataFrame([(f"k{i:05d}", v.tolist()) for i, v in enumerate(x)], "id string, vec array<double>")
    donors, gaps, tally = d.where("id >= 'k04000'"), d.where("id < 'k04000'"), {}
    got = {(r.qid, r.place): r.nid for r in knn(donors, gaps, 5, same=False, tally=tally).collect()}
    assert len(calls) == 2  # once for the own cell and once for the others; before, twice more for every level of a tree
    assert len(got) == 20_000 and tally["all"] == 80_000_000
    assert tally["visited"] < 0.05 * tally["all"]
    for i in range(0, 4000, 97):
        far = distances(x[i][None], x[4000:], "l2")[0]
        assert [got[f"k{i:05d}", p] for p in range(1, 6)] == [f"k{4000 + j:05d}" for j in np.lexsort((np.arange(20_000), far))[:5]]
