"""Files read apart, batches with a log, and days kept in step with their files."""

import gzip
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from stopover.plans.snapshot_job import run
from stopover.sources import batches
from stopover.sources.batches import land, landed_files, open_landed, read_apart, read_log, unread
from stopover.sources.snapshots import list_versions, read_snapshots
from stopover.streaming.ingest import file_changes, sync_days
from tests.landed import envelope, itinerary, land as put, leg

SMALL = "status boolean, data struct<a:bigint>"
ALL = "*"


def file(base, day, name, text, packed=False):
    folder = base / day
    folder.mkdir(parents=True, exist_ok=True)
    raw = text if isinstance(text, bytes) else text.encode()
    (folder / name).write_bytes(gzip.compress(raw) if packed else raw)


def line(a):
    return json.dumps({"status": True, "data": {"a": a}}) + "\n"


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def broken(base, day, name):
    """A packed file that breaks off behind its first lines."""
    whole = gzip.compress("".join(line(i) for i in range(5000)).encode())
    (base / day).mkdir(parents=True, exist_ok=True)
    (base / day / name).write_bytes(whole[:len(whole) // 2])


@pytest.fixture
def base(tmp_path):
    folder = tmp_path / "landed"
    file(folder, "2031-01-01", "a.json", line(1) + line(2) + "\n \n" + '{"status": tr')
    file(folder, "2031-01-01", "b.json.gz", "﻿" + line(3) + "\r\n" + line(4), packed=True)
    file(folder, "2031-01-02", "none.json", "")
    file(folder, "2031-01-02", "blank.json", "\n\n")
    file(folder, "not a day", "c.json", line(5))
    broken(folder, "2031-01-03", "cut.json.gz")
    file(folder, "2031-01-03", "junk.json.gz", "no packed file")
    return folder


def test_rows_are_those_of_the_scan_by_line(spark, base):
    rows = read_apart(spark, str(base), SMALL, files=ALL)
    strict = read_snapshots(spark, str(base), SMALL, files="[abcn]*.json*",
                            days=["2031-01-01", "2031-01-02", "not a day"])
    assert values(rows.where("is_record").drop("is_record").select(strict.columns)) == values(strict)
    assert rows.count() == rows.where("is_record").count() + 1
    lost = unread(list_versions(spark, str(base), ALL), rows).select(
        F.element_at(F.split("file_path", "/"), -1))
    assert values(lost) == [("cut.json.gz",), ("junk.json.gz",)]


def test_arrays_and_whole_files(spark, tmp_path):
    file(tmp_path, "2031-01-01", "l.json", "[" + line(1).strip() + ", " + line(2).strip() + "]\n[]\n[1\n")
    file(tmp_path, "2031-01-02", "m.json", "[\n" + line(3) + ",\n" + line(4) + "]")
    file(tmp_path, "2031-01-02", "o.json", json.dumps({"status": True, "data": {"a": 5}}, indent=1))
    rows = read_apart(spark, str(tmp_path / "2031-01-01"), SMALL)
    assert values(rows.select("data.a", F.col("_corrupt_record").isNotNull(), "is_record")) == [
        (1, False, True), (2, False, True), (None, False, False), (None, True, True)]
    rows = read_apart(spark, str(tmp_path / "2031-01-02"), SMALL, multi_line=True)
    assert values(rows.select("data.a")) == [(3,), (4,), (5,)]


def test_larger_files_are_read_by_line(spark, base):
    readable = ["2031-01-01", "2031-01-02", "not a day"]
    paths = [str(base / day) for day in readable]
    small, large = (read_apart(spark, paths, SMALL, files=ALL, largest=size)
                    for size in (batches.LARGEST, 10))
    assert values(small.where("is_record")) == values(large.where("is_record"))
    with pytest.raises(Exception, match="FAILED_READ_FILE|reading file"):
        read_apart(spark, str(base), SMALL, files=ALL, largest=10).collect()


def test_batches_are_entered_once(spark, base, tmp_path):
    store, log = str(tmp_path / "store"), str(tmp_path / "log")

    def go(**more):
        return land(spark, str(base), store, log, SMALL, files=ALL, **{"most": 2, **more})

    def held():
        return values(open_landed(spark, store, log, SMALL).where("_corrupt_record is null")
                      .select("data.a"))

    with pytest.raises(ValueError, match="cannot be read"):
        go(most=1)
    assert read_log(spark, log).count() == 0 and open_landed(spark, store, log).count() == 0
    # A file of no bytes is none.
    assert go(most_files=2) == 4
    assert held() == [(1,), (2,), (3,), (4,), (5,)]
    states = values(landed_files(spark, log).groupBy("state").count())
    assert states == [("read", 4), ("unreadable", 2)]
    # What cannot be read is tried again, nothing else is.
    assert go() == 1 and held() == [(1,), (2,), (3,), (4,), (5,)]
    # Mended, replaced, and new files are taken; of a replaced one the new version counts.
    file(base, "2031-01-03", "cut.json.gz", line(6), packed=True)
    file(base, "2031-01-01", "a.json", line(1) + line(7) + line(8))
    file(base, "2031-01-04", "new.json", line(9))
    assert go(most=1) == 1
    assert held() == [(n,) for n in (1, 3, 4, 5, 6, 7, 8, 9)]
    assert values(landed_files(spark, log).where("records = 3").select("state")) == [("read",)]


def test_paths_with_odd_names_and_folders_in_folders(spark, tmp_path):
    base, store, log = tmp_path / "la'nd ed", str(tmp_path / "store"), str(tmp_path / "log")
    names = ["it's.json", "a b+c%20.json", "x[1].json", "ü{2}.json"]
    for n, name in enumerate(names):
        file(base / "sub", "2031-01-01", name, line(n))
        file(base / "sub" / "2031-01-01", "2031-01-02", name, line(n + 10))
    assert land(spark, str(base), store, log, SMALL) == 1
    assert land(spark, str(base), store, log, SMALL) == 0
    rows = open_landed(spark, store, log, SMALL).select("data.a", "fetch_date").collect()
    assert sorted(rows) == [(n, "2031-01-01") for n in range(4)] + [
        (n, "2031-01-02") for n in range(10, 14)]


def test_a_batch_that_was_not_entered_is_done_again(spark, tmp_path, monkeypatch):
    base, store, log = tmp_path / "landed", str(tmp_path / "store"), str(tmp_path / "log")
    for day in range(1, 5):
        file(base, f"2031-01-0{day}", "a.json", line(day))
    real, calls = batches.write_parquet, []

    def failing(df, path):
        calls.append(path)
        if len(calls) == 3:
            raise RuntimeError("lost")
        real(df, path)

    monkeypatch.setattr(batches, "write_parquet", failing)
    with pytest.raises(RuntimeError, match="lost"):
        land(spark, str(base), store, log, SMALL, most_files=1)
    assert values(open_landed(spark, store, log, SMALL).select("data.a")) == [(1,), (2,)]
    assert land(spark, str(base), store, log, SMALL, most_files=1) == 2
    assert values(open_landed(spark, store, log, SMALL).select("data.a", "batch")) == [
        (1, 1), (2, 2), (3, 3), (4, 4)]


def test_a_day_with_very_many_files_is_cut(spark, tmp_path):
    base, store, log = tmp_path / "landed", str(tmp_path / "store"), str(tmp_path / "log")
    for n in range(40):
        file(base, "2031-01-01", f"{n}.json", line(n))
    assert land(spark, str(base), store, log, SMALL, most_files=10) == 4
    rows = open_landed(spark, store, log, SMALL).select("data.a").collect()
    assert sorted(r.a for r in rows) == list(range(40))
    assert read_log(spark, log).groupBy("batch").count().agg(F.max("count")).first()[0] < 20


def test_an_unreadable_larger_file_costs_its_batch(spark, base, tmp_path):
    store, log = str(tmp_path / "store"), str(tmp_path / "log")
    assert land(spark, str(base), store, log, SMALL, files=ALL, most=2, largest=10) == 1
    assert values(landed_files(spark, log).groupBy("state").count()) == [
        ("read", 4), ("unreadable", 2)]


def test_many_bad_files_cost_little(spark, tmp_path):
    """One file in a hundred is bad; the time is that of a run without, and none counts half."""
    clean, mixed, good = tmp_path / "clean", tmp_path / "mixed", 0
    for n in range(1000):
        text = "".join(line(n * 20 + i) for i in range(20))
        file(clean, f"2031-01-{n % 28 + 1:02}", f"{n}.json.gz", text, packed=True)
        if n % 100 == 50:
            broken(mixed, f"2031-01-{n % 28 + 1:02}", f"{n}.json.gz")
        else:
            file(mixed, f"2031-01-{n % 28 + 1:02}", f"{n}.json.gz", text, packed=True)
            good += 20
    took = {}
    for attempt in ("first", "second"):
        for base, most in ((clean, 0), (mixed, 10)):
            store, log = (str(tmp_path / f"{attempt}-{base.name}-{x}") for x in ("store", "log"))
            start = time.time()
            assert land(spark, str(base), store, log, SMALL, files=ALL, most=most) == 1
            took[base.name] = time.time() - start
            rows = open_landed(spark, store, log, SMALL)
            assert rows.count() == (good if most else 20_000)
            assert read_log(spark, log).where("state = 'unreadable'").count() == most
    # Loose, since other work shares the machine; a second reading would double it.
    assert took["mixed"] < 1.7 * took["clean"]


def test_job_leaves_out_many_unreadable_files(spark, landing, tmp_path):
    import pathlib

    base = pathlib.Path(landing)
    want = values(run(spark, landing, str(tmp_path / "plain")))
    for n in range(12):
        broken(base, f"2031-07-0{n % 3 + 1}", f"bad{n}.json.gz")
    file(base, "2031-07-02", "empty.json", "")
    got = run(spark, landing, str(tmp_path / "out"), files="*.json*", unreadable=12)
    assert values(got) == want
    rejects = spark.read.json(str(tmp_path / "out" / "rejected"))
    assert values(rejects.groupBy("reason").count()) == [("file cannot be read", 12)]
    with pytest.raises(ValueError, match="more than 11"):
        run(spark, landing, str(tmp_path / "less"), files="*.json*", unreadable=11)


# Days in step with their files

def trip(name, codes=("AAA", "BBB")):
    return itinerary(name, [leg(f"{name}-leg", list(codes))])


def summary(spark, target):
    if not os.path.isdir(target):
        return []
    return values(spark.read.schema("itinerary_id string, destination string, fetch_date string")
                  .parquet(target).select("fetch_date", "itinerary_id", "destination"))


def test_days_follow_new_replaced_and_removed_files(spark, tmp_path):
    base, target, manifest = (tmp_path / n for n in ("landed", "days", "manifest"))

    def sync():
        return values(sync_days(spark, str(base), str(target), str(manifest))
                      .select("fetch_date", F.element_at(F.split("file_path", "/"), -1), "change"))

    put(base, "2031-01-01", "a.json", envelope([trip("one")]))
    put(base, "2031-01-01", "b.json", envelope([trip("two")]))
    put(base, "2031-01-02", "a.json", envelope([trip("three")]))
    put(base, "2031-01-03", "a.json", envelope([trip("four")]))
    put(base, "undated", "a.json", envelope([trip("stray")]))
    assert sync() == [("2031-01-01", "a.json", "new"), ("2031-01-01", "b.json", "new"),
                      ("2031-01-02", "a.json", "new"), ("2031-01-03", "a.json", "new")]
    assert summary(spark, str(target)) == [
        ("2031-01-01", "one", "BBB"), ("2031-01-01", "two", "BBB"),
        ("2031-01-02", "three", "BBB"), ("2031-01-03", "four", "BBB")]
    untouched = {p: p.stat().st_mtime_ns for p in (target / "fetch_date=2031-01-02").iterdir()}
    assert sync() == []

    (base / "2031-01-01" / "b.json").unlink()
    put(base, "2031-01-01", "a.json", envelope([trip("one", ("AAA", "CCC", "DDD"))]))
    put(base, "2031-01-04", "z.json", envelope([trip("five")]))
    # A day whose search found nothing, and one that is gone.
    put(base, "2031-01-03", "a.json", envelope([], "failure"))
    assert sync() == [("2031-01-01", "a.json", "changed"), ("2031-01-01", "b.json", "vanished"),
                      ("2031-01-03", "a.json", "changed"), ("2031-01-04", "z.json", "new")]
    want = [("2031-01-01", "one", "DDD"), ("2031-01-02", "three", "BBB"),
            ("2031-01-04", "five", "BBB")]
    assert summary(spark, str(target)) == want
    assert untouched == {p: p.stat().st_mtime_ns for p in untouched}
    assert sync() == []

    for name in ("2031-01-01", "2031-01-02", "2031-01-04"):
        for path in (base / name).iterdir():
            path.unlink()
    assert len(sync()) == 3 and summary(spark, str(target)) == []
    assert sync() == []


def test_a_run_that_fails_before_its_manifest_is_repeated(spark, tmp_path, monkeypatch):
    from stopover.streaming import ingest

    base, target, manifest = (tmp_path / n for n in ("landed", "days", "manifest"))
    put(base, "2031-01-01", "a.json", envelope([trip("one")]))
    real = ingest.replace_snapshots

    def failing(rows, path):
        if path == str(manifest):
            raise RuntimeError("lost")
        real(rows, path)

    monkeypatch.setattr(ingest, "replace_snapshots", failing)
    with pytest.raises(RuntimeError, match="lost"):
        sync_days(spark, str(base), str(target), str(manifest))
    monkeypatch.setattr(ingest, "replace_snapshots", real)
    assert sync_days(spark, str(base), str(target), str(manifest)).count() == 1
    assert summary(spark, str(target)) == [("2031-01-01", "one", "BBB")]
    assert sync_days(spark, str(base), str(target), str(manifest)).count() == 0


def test_file_changes_by_length_or_time(spark):
    columns = "file_path string, fetch_date string, length bigint, modified string"
    known = spark.createDataFrame([("a", "d", 1, "t"), ("b", "d", 1, "t"), ("c", "d", 1, "t"),
                                   ("e", "d", 1, "t")], columns)
    now = spark.createDataFrame([("a", "d", 1, "t"), ("b", "d", 2, "t"), ("c", "d", 1, "u"),
                                 ("f", "d", 1, "t")], columns)
    assert values(file_changes(now, known)) == [
        ("d", "b", "changed"), ("d", "c", "changed"), ("d", "e", "vanished"), ("d", "f", "new")]


def test_text_of_packed_files_is_never_held_whole(spark, tmp_path):
    """The text is longer than any value can be, the files have 2 MB; one breaks off at its end."""
    ends = [gzip.compress(line(n).encode()) for n in (1, 2)]
    blank = gzip.compress(b" " * (64 << 20) + b"\r\n", 1)
    whole = ends[0] + blank * 35 + ends[1]
    file(tmp_path, "2031-01-01", "whole.json.gz", whole)
    file(tmp_path, "2031-01-01", "cut.json.gz", whole[:-1])
    rows = read_apart(spark, str(tmp_path), SMALL, files=ALL)
    assert values(rows.select(F.element_at(F.split("file_path", "/"), -1), "data.a")) == [
        ("whole.json.gz", 1), ("whole.json.gz", 2)]


def test_packed_files_are_read_as_plain_ones(spark, tmp_path):
    """Line ends, blank lines, several members, odd bytes, arrays; broken in several places."""
    text = ("﻿" + line(1) + "\r\n \r" + line(2) + "[" + line(3) + "]\n[1\n" + "ü₹\n" * 3).encode()
    good = {"members": gzip.compress(text[:7]) + gzip.compress(text[7:]), "plain": gzip.compress(text),
            "odd": gzip.compress(b'{"status": "\xff\xe2\x82"}\n' + text), "none": gzip.compress(b""),
            "blank": gzip.compress(b"\n \r\n"), "no end": gzip.compress(text.rstrip())}
    bad = {"rest": good["plain"] + b"\0", "sum": good["plain"][:-8] + b"\0" * 8,
           "cut": good["plain"][:-1], "head": good["plain"] + good["plain"][:5], "text": text}
    for name, raw in {**good, **bad}.items():
        file(tmp_path / "packed", "2031-01-01", f"{name}.json.gz", raw)
    for name, raw in good.items():
        file(tmp_path / "plain", "2031-01-01", f"{name}.json", gzip.decompress(raw))
    name = F.regexp_extract("file_path", r"([^/]+)\.json", 1).alias("name")
    columns = ["status", "data", "_corrupt_record", "fetch_date", "is_record", name]
    packed, plain = (values(read_apart(spark, str(tmp_path / kind), SMALL, files=ALL).select(columns))
                     for kind in ("packed", "plain"))
    # Files of no bytes are not listed, packed ones of no text are.
    extra = (None, None, None, "2031-01-01", False, "none")
    assert packed == sorted([*plain, extra], key=repr)
