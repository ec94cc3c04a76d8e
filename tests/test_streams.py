"""Event time with lateness and restarts, and tables of changes."""

import datetime
import os
import random

import pytest

from constituent360.sources.writers import Changes
from constituent360.streaming import jobs

HOURS = "ts timestamp, k string, v int"


def at(hour, minute=0):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hour, minutes=minute)


class Feed:
    """A folder of files that arrive one by one; every run restarts the job from its checkpoint."""

    def __init__(self, spark, path, late):
        self.spark, self.path, self.late = spark, str(path), late

    def run(self, rows):
        self.spark.createDataFrame(rows, HOURS).coalesce(1).write.mode("append").parquet(f"{self.path}/in")
        stream = jobs.read_stream(self.spark, f"{self.path}/in", self.spark.createDataFrame([], HOURS).schema)
        metric = jobs.metric_refresh(stream, "ts", "v", ["k"], late=self.late)
        job = jobs.append_closed(metric, f"{self.path}/out", f"{self.path}/checkpoint")
        job.awaitTermination()
        return [s for p in job.recentProgress for s in p["stateOperators"]]

    def out(self):
        return sorted((r["window_start"], r["k"], r["n"], r["total"]) for r in self.spark.read.parquet(f"{self.path}/out").collect())


def test_windows_close_once_and_late_rows_are_dropped(spark, tmp_path):
    feed = Feed(spark, tmp_path, "2 hours")
    feed.run([(at(0, 5), "a", 1), (at(1, 5), "a", 2), (at(0, 50), "b", 4)])
    assert feed.out() == []  # the latest time is 1:05, so nothing is two hours over
    feed.run([(at(0, 10), "a", 8), (at(3, 30), "a", 16)])  # late, but within two hours of 1:05
    assert feed.out() == [(at(0), "a", 2, 9), (at(0), "b", 1, 4)]  # closed up to 1:30
    states = feed.run([(at(0, 20), "a", 32), (at(1, 20), "a", 64)])  # the first hour is closed, the second still open
    assert sum(s["numRowsDroppedByWatermark"] for s in states) == 1
    assert feed.out() == [(at(0), "a", 2, 9), (at(0), "b", 1, 4)]
    states = feed.run([(at(9), "a", 128)])
    assert feed.out() == [(at(0), "a", 2, 9), (at(0), "b", 1, 4), (at(1), "a", 2, 66), (at(3), "a", 1, 16)]
    assert states[-1]["numRowsTotal"] == 1  # only the window of the ninth hour is kept


def test_state_follows_the_lateness_not_the_history(spark, tmp_path):
    feed, kept = Feed(spark, tmp_path, "3 hours"), []
    for day in range(3):
        kept.append(feed.run([(at(24 * day + h, 30), "a", 1) for h in range(24)])[-1]["numRowsTotal"])
    assert max(kept) <= 4 and len(feed.out()) == 72 - kept[-1]


def test_changes_by_hand(spark, tmp_path):
    r, table, known = random.Random(1), Changes(spark, str(tmp_path), ["id"], ["ts", "v"], "ts", 4), {}
    assert table.read() is None
    for step in range(6):
        rows = [(r.randrange(30), at(r.randrange(24 * step, 24 * (step + 2))), r.randrange(100)) for _ in range(40)] + [(None, at(24 * step), step)]
        for i, ts, v in rows:
            known[i] = max(known.get(i, (ts, v)), (ts, v))
        batch = spark.createDataFrame(rows, "id int, ts timestamp, v int")
        for _ in range(2 if step == 2 else 1):  # a batch that is added twice
            table.add(batch)
        if step in (2, 3):
            for _ in range(step - 1):  # a fold that is run twice
                table.fold(str(at(24 * step).date()))
        assert sorted(map(repr, ((x["id"], x["ts"], x["v"]) for x in table.read().collect()))) == sorted(map(repr, ((i, *x) for i, x in known.items())))


def written(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


@pytest.mark.parametrize("size", [1_000, 200_000])
def test_bytes_follow_the_batch(spark, tmp_path, size):
    table = Changes(spark, str(tmp_path), ["id"], ["ts"], "ts", 4)
    table.add(spark.range(size).selectExpr("id", "timestamp'2024-01-01 00:00:00' AS ts", "uuid() AS payload"))
    table.fold("2024-01-02")
    before = written(tmp_path)
    table.add(spark.range(10).selectExpr("id * 97 AS id", "timestamp'2024-01-03 00:00:00' AS ts", "uuid() AS payload").coalesce(1))
    assert 0 < written(tmp_path) - before < 5_000 and table.read().count() == size
