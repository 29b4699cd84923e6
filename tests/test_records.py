"""Records over split borders: quoted line breaks and JSON nesting, against whole-file parsers, at many split sizes."""

import csv
import io
import json
import random

import pandas as pd
import pytest

from larkframe.sources import records as rec

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture(params=["150", "4000"])
def splits(spark, request):
    old = spark.conf.get(SPLIT)
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(SPLIT, request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    spark.conf.set(SPLIT, old)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def words(rng):
    return rng.choice(["", "plain", "a,b", 'say "x"', "two\nlines", "\n\n", "é{}[]", 'end"', "b\\\\"]) + "z" * rng.randrange(0, 30)


def test_quoted_line_breaks(spark, tmp_path, splits):
    rng = random.Random(3)
    want = []
    for part in range(3):
        out = io.StringIO()
        w = csv.writer(out, lineterminator="\r\n" if part == 1 else "\n", quoting=csv.QUOTE_ALL)
        w.writerow(["id", "note\nhere", "x"])
        for i in range([40, 0, 60][part]):
            row = [str(len(want)), words(rng), words(rng)]
            w.writerow(row)
            want.append(tuple(row))
            if i % 9 == 0:
                out.write("\n")  # blank lines do not count
        (tmp_path / f"p{part}.csv").write_bytes(out.getvalue().encode())
    (tmp_path / "p9.csv").write_bytes(b"")
    schema = "id string, note string, x string"
    got = [tuple(r) for r in rec.read_numbered(spark, str(tmp_path), schema).orderBy("number").collect()]
    assert [g[0] for g in got] == list(range(1, 101))
    assert [tuple(v or "" for v in g[1:]) for g in got] == want
    for n in (1, 5, 45, 200):
        head = [tuple(r) for r in rec.preview(spark, str(tmp_path), schema, n).orderBy("number").collect()]
        assert head == got[:n]


def test_chunks_see_rows_in_order(spark, tmp_path, splits):
    (tmp_path / "a.csv").write_text("id,q\n" + "".join(f'{i},"{i}\n"\n' for i in range(1, 106)))

    def call(rows: pd.DataFrame, pos: int) -> pd.DataFrame:
        assert rows["id"].tolist() == list(range(pos, pos + len(rows)))
        return pd.DataFrame({"pos": [pos], "n": [len(rows)], "mean": [rows["id"].mean()]})

    got = rec.read_chunked(spark, str(tmp_path), "id long, q string", call, "pos long, n long, mean double", size=10).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(p, min(10, 106 - p), (p + min(p + 9, 105)) / 2) for p in range(1, 106, 10)]


def test_unclosed_quote_is_one_record(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,x\n2,"y\n3,z\n')
    (tmp_path / "b.csv").write_text("a,b\n4,w\n")
    got = rec.read_records(spark, str(tmp_path), header=True).orderBy("number").collect()
    assert [tuple(r) for r in got] == [(1, "1,x"), (2, '2,"y\n3,z'), (3, "4,w")]


def objects(rng, n):
    deep = lambda: {"k": words(rng), "list": [rng.randrange(9) for _ in range(rng.randrange(4))], "in": [{"t": "}{][" + words(rng)}, {}]}
    return [{"id": i, "text": words(rng) + rng.choice(["", "\\", '\\"', "}", '"}', "{"]), "deep": deep()} for i in range(n)]


@pytest.mark.parametrize("indent", [None, 2])
def test_json_arrays_and_documents(spark, tmp_path, splits, indent):
    rng = random.Random(7)
    rows = objects(rng, 60)
    schema = "id long, text string, deep struct<k:string, list:array<int>, `in`:array<struct<t:string>>>"
    as_rows = lambda d: [(r["number"], r["id"], r["text"], r["deep"]["k"], list(r["deep"]["list"]), [x["t"] for x in r["deep"]["in"]])
                         for r in d.orderBy("number").collect()]
    want = [(i + 1, r["id"], r["text"], r["deep"]["k"], r["deep"]["list"], [x.get("t") for x in r["deep"]["in"]]) for i, r in enumerate(rows)]
    dump = lambda x: json.dumps(x, indent=indent, ensure_ascii=False)
    forms = {1: dump(rows), 0: "\n".join(dump(r) for r in rows) + "\n",
             2: dump({"company": "A } { [", "employees": rows[:31], "at": {"x": {}}, "more": rows[31:]})}
    for level, text in forms.items():
        folder = tmp_path / f"l{level}"
        folder.mkdir()
        (folder / "a.json").write_text(text)
        (folder / "b.json").write_text("[]" if level == 1 else "")
        got = as_rows(rec.read_json_records(spark, str(folder), schema, level).where("id IS NOT NULL" if level == 2 else "true"))
        assert [g[1:] for g in got] == [w[1:] for w in want]
        if level != 2:
            assert [g[0] for g in got] == [w[0] for w in want]


def test_one_long_array_is_read_by_several_tasks(spark, tmp_path):
    n = 100_000
    (tmp_path / "a.json").write_text("[" + ", ".join(json.dumps({"id": i, "s": {"t": "x" * (i % 40) + '}"'}}) for i in range(n)) + "]")
    old = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, "1MB")
    try:
        parts = rec.pieces(spark, str(tmp_path), rec.BRACE)
        assert parts.rdd.getNumPartitions() > 4
        got = rec.read_json_records(spark, str(tmp_path), "id long, s struct<t:string>", 1)
        row = got.selectExpr("count(*)", "sum(id)", "count(distinct number)", "sum(cast(number = id + 1 as int))", "sum(length(s.t))").first()
        assert tuple(row) == (n, n * (n - 1) // 2, n, n, sum(i % 40 + 2 for i in range(n)))
    finally:
        spark.conf.set(SPLIT, old)
