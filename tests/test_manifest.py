"""A manifest that grows by new days only."""

from pyspark.sql import functions as F

from stopover.sources import manifest as m
from stopover.sources.manifest import days_of, discovered, extend_manifest, open_manifest
from tests.landed import envelope, land


def files(spark, path):
    return sorted(tuple(r) for r in discovered(spark, path).select("fetch_date", "files").collect())


def test_only_new_days_are_listed(spark, tmp_path, monkeypatch):
    base, path, calls = tmp_path / "landed", str(tmp_path / "manifest"), []
    real = m.list_versions
    monkeypatch.setattr(m, "list_versions",
                        lambda s, folders, f: (calls.extend(folders), real(s, folders, f))[1])
    for day in range(1, 8):
        land(base, f"2031-01-0{day}", "a.json", envelope([]))
    land(base, "undated", "a.json", envelope([]))
    land(base, "2031-02-30", "a.json", envelope([]))
    assert len(extend_manifest(spark, str(base), path)) == 7
    assert files(spark, path) == [(f"2031-01-0{day}", 1) for day in range(1, 8)]
    # One new day: its folder, and the newest one of the others.
    calls.clear()
    land(base, "fetch_date=2031-01-08", "a.json", envelope([]))
    land(base, "2031-01-07", "b.json", envelope([]))
    land(base, "2031-01-02", "unnoticed.json", envelope([]))
    assert extend_manifest(spark, str(base), path) == ["2031-01-07", "2031-01-08"]
    assert sorted(c.rsplit("/", 1)[1] for c in calls) == ["2031-01-07", "fetch_date=2031-01-08"]
    assert dict(files(spark, path))["2031-01-07"] == 2 and dict(files(spark, path))["2031-01-02"] == 1
    assert extend_manifest(spark, str(base), path, again=["2031-01-02"], newest=0) == ["2031-01-02"]
    assert dict(files(spark, path))["2031-01-02"] == 2
    assert extend_manifest(spark, str(base), path, newest=0) == []


def test_days_are_listed_a_few_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(m, "DAYS_AT_ONCE", 2)
    base, path = tmp_path / "landed", str(tmp_path / "manifest")
    for day in range(1, 6):
        land(base, f"2031-01-0{day}", "a.json", envelope([]))
    # A run that stopped behind its first days goes on with the others.
    real, calls = m.replace_snapshots, []

    def failing(rows, to):
        calls.append(to)
        if len(calls) == 2:
            raise RuntimeError("lost")
        real(rows, to)

    monkeypatch.setattr(m, "replace_snapshots", failing)
    try:
        extend_manifest(spark, str(base), path)
        raise AssertionError("should have failed")
    except RuntimeError:
        pass
    assert len(files(spark, path)) == 2
    assert extend_manifest(spark, str(base), path, newest=0) == [f"2031-01-0{d}" for d in (3, 4, 5)]
    assert len(files(spark, path)) == 5


def test_nothing_landed(spark, tmp_path):
    assert days_of(spark, str(tmp_path / "none")) == {}
    assert extend_manifest(spark, str(tmp_path / "none"), str(tmp_path / "manifest")) == []
    assert open_manifest(spark, str(tmp_path / "manifest")).agg(F.count("*")).first()[0] == 0
