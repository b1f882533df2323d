import threading
import time

import pytest

from stratalake import register_reader, run_jobs
from stratalake.plans import together
from stratalake.plans.together import Stopped
from stratalake.sources import _READERS
from tests.conftest import rows


@pytest.fixture
def readers():
    before = dict(_READERS)
    yield register_reader
    _READERS.clear()
    _READERS.update(before)


def job(name, kind, **trusted):
    return {
        "job_name": name,
        "source": {"type": kind, "path": name},
        "destination": {"path": f"d/{name}", "trusted": {"ingest_type": "Replace", **trusted}},
    }


def numbers(spark, source, layers):
    return spark.range(len(source["path"])).selectExpr("id", "'x' AS v")


def stored(spark, outcome):
    return rows(spark.read.parquet(outcome.results[-1].path), "ID")


def test_jobs_and_steps(spark, layers, readers):
    readers("numbers", numbers)
    jobs = [job("a" * n, "numbers") for n in (5, 1, 3, 2, 4)]
    found = run_jobs(spark, jobs, layers, "20240131", at_once=2)
    assert [o.job_name for o in found] == [j["job_name"] for j in jobs]
    assert all(o.error is None and len(o.results) == 2 and o.seconds > 0 for o in found)
    assert [len(stored(spark, o)) for o in found] == [o.results[1].rows for o in found] == [5, 1, 3, 2, 4]
    only = run_jobs(spark, jobs[:1], layers, "20240131", steps=["trusted"])
    assert only[0].results[0].rows == 5
    assert run_jobs(spark, [], layers) == []


def test_a_job_that_fails_stops_no_other(spark, layers, readers):
    def broken(spark, source, layers):
        return spark.range(4).selectExpr("CASE WHEN id = 3 THEN raise_error('no more') ELSE id END AS id")

    readers("numbers", numbers)
    readers("broken", broken)
    jobs = [job("first", "broken"), job("second", "numbers"), job("third", "unheard of"), job("fourth", "numbers", ingest_type="Odd")]
    first, second, third, fourth = run_jobs(spark, jobs, layers, "20240131", at_once=1)
    assert "no more" in str(first.error) and first.results == ()
    assert second.error is None and len(stored(spark, second)) == 6
    assert "unheard of" in str(third.error) and "Odd" in str(fourth.error)


def test_at_most_so_many_at_once_with_own_tags_and_pools(spark, layers, readers):
    seen, running, most, lock = {}, [0], [0], threading.Lock()
    context = spark.sparkContext

    def watched(spark, source, layers):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        seen[source["path"]] = (context.getJobTags(), context.getLocalProperty("spark.scheduler.pool"))
        time.sleep(0.3)
        with lock:
            running[0] -= 1
        return numbers(spark, source, layers)

    readers("watched", watched)
    found = run_jobs(spark, [job(c * 2, "watched") for c in "abcdef"], layers, "20240131", steps=["raw"], at_once=3)
    assert all(o.error is None for o in found) and most[0] == 3
    assert {pool for _, pool in seen.values()} == set(seen)
    assert all(len(tags) == 1 for tags, _ in seen.values())
    assert len(set().union(*(tags for tags, _ in seen.values()))) == 6
    assert not context.getJobTags() and context.getLocalProperty("spark.scheduler.pool") is None


def endless(spark, source, layers):
    """Work in one task that only a cancel ends."""
    return spark.range(0, 1 << 50, numPartitions=1).selectExpr("id").filter("hash(id) = 1 AND hash(id + 1) = 2")


def test_a_job_that_takes_too_long_is_cancelled(spark, layers, readers):
    readers("endless", endless)
    readers("numbers", numbers)
    began = time.monotonic()
    long, short, queued = run_jobs(
        spark, [job("long", "endless"), job("short", "numbers"), job("queued", "numbers")], layers, "20240131", at_once=2, job_seconds=6
    )
    assert time.monotonic() - began < 40
    assert isinstance(long.error, Stopped) and "6 seconds" in str(long.error) and long.results == ()
    assert short.error is None and queued.error is None and len(stored(spark, queued)) == 6
    assert spark.range(10).count() == 10


def test_a_caller_that_gives_up_leaves_nothing_running(spark, layers, readers, monkeypatch):
    readers("endless", endless)
    given = together.wait

    def interrupted(*args, **kwargs):
        monkeypatch.setattr(together, "wait", given)
        given(args[0], timeout=2)
        raise KeyboardInterrupt

    monkeypatch.setattr(together, "wait", interrupted)
    began = time.monotonic()
    with pytest.raises(KeyboardInterrupt):
        run_jobs(spark, [job("one", "endless"), job("two", "endless"), job("three", "endless")], layers, "20240131", at_once=2)
    assert time.monotonic() - began < 40
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()


def test_jobs_that_would_meet_are_refused(spark, layers):
    one = job("one", "csv")
    with pytest.raises(ValueError, match="the name"):
        run_jobs(spark, [one, one], layers)
    with pytest.raises(ValueError, match="the path"):
        run_jobs(spark, [one, {**one, "job_name": "two"}], layers)
    with pytest.raises(ValueError, match="one job at once"):
        run_jobs(spark, [one], layers, at_once=0)
