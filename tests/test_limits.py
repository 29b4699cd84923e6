"""The rate limiter against a plain replay, with calls in any order inside the lateness, and its state afterwards."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

from larkframe.streaming import jobs
from larkframe.streaming.limits import PROVIDER, ROCKS, decide, rate_limited

DAY = datetime(2024, 3, 1)


def replay(calls, limit, period):
    by, out = defaultdict(list), []
    for key, i, ts in calls:
        by[key].append((ts, i))
    for key, own in by.items():
        reset, count, start = None, 0, None
        for ts, i in sorted(own):
            if reset is None or ts > reset:
                start, reset, count, ok = ts, ts + timedelta(seconds=period), 1, True
            elif count > limit:
                ok = False
            else:
                count, ok = count + 1, True
            out.append((key, i, ts, start, count, ok))
    return sorted(out, key=str)


def test_decisions_equal_replay_and_state_goes(spark, tmp_path):
    rng = random.Random(5)
    calls = [(rng.choice(["hot"] * 4 + ["a", "b", None]), i, DAY + timedelta(seconds=rng.randrange(0, 3 * 86400), microseconds=rng.randrange(10**6))) for i in range(1500)]
    calls += [("burst", 2000 + i, DAY + timedelta(days=2, seconds=i * 10)) for i in range(130)]  # past the limit of 100
    calls += [("burst", 2200 + i, DAY + timedelta(days=2, seconds=3600 + i)) for i in range(3)]  # at the reset, and after it
    calls += [("same", 2300 + i, DAY + timedelta(days=1)) for i in range(4)] + [("once", 2400, DAY + timedelta(days=2, hours=20))]
    df = spark.createDataFrame(calls, "key string, id long, ts timestamp").repartition(2)
    for limit in (3,):
        state = str(tmp_path / f"state{limit}")
        got = sorted((tuple(r) for r in rate_limited(df, "day", "1 day", limit, state=state).collect()), key=str)
        assert got == replay(calls, limit, 3600)
        rejected = [r for r in got if r[0] == "burst" and not r[5]]
        assert rejected and all(r[4] == limit + 1 for r in rejected)
        spark.conf.set(PROVIDER, ROCKS)
        for name in ("open", "held"):
            left = spark.read.format("statestore").option("path", state).option("stateVarName", name).load()
            assert left.count() == 0  # every period is over and every call decided
        spark.conf.unset(PROVIDER)


def test_no_calls_and_calls_without_time(spark):
    none = spark.createDataFrame([("a", 1, None)], "key string, id long, ts timestamp")
    assert rate_limited(none, "day", "1 day").count() == 0


def test_a_hundred_and_one_calls_an_hour():
    rows, *_ = decide([(i, i) for i in range(130)], None, 0, 100, 3600)
    assert sum(r[4] for r in rows) == 101 and [r[4] for r in rows] == [True] * 101 + [False] * 29


def test_reset_is_after_the_hour():
    hour = 3600 * 10**6
    rows, start, count = decide([(0, 1), (hour, 2), (hour + 1, 3)], None, 0, 5, 3600)
    assert [(r[2], r[3]) for r in rows] == [(0, 1), (0, 2), (hour + 1, 1)] and (start, count) == (hour + 1, 1)


def test_files_arrive_unit_by_unit(spark):
    df = spark.createDataFrame([(i, DAY + timedelta(hours=7 * i)) for i in range(30)] + [(99, None)], "id long, ts timestamp").repartition(2)
    seen = []
    s = jobs.stream(spark, jobs.landed_in_order(df, "ts", "day", "ordered"), df.schema, files=1)
    got = jobs.run(s, "append", "ordered-out").collect()
    assert len(got) == 31
    for r in sorted((r for r in got if r.ts is not None), key=lambda r: r.batch):
        seen.append(r.ts.date())
    assert seen == sorted(seen) and min(got, key=lambda r: r.batch).id == 99
