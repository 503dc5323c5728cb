"""The ZIP data source, its stream's journal, and loads that meet damaged archives."""

import json
import os
import uuid
import zipfile

import pytest

from cardiolake.operators.upsert import TableStore
from cardiolake.plans.ingest import Ingest
from cardiolake.sources import archive as AR, zip_source as Z
from cardiolake.streaming import jobs as J


def activity(day, steps):
    return f"activity-{day}.json", json.dumps({"date": day, "summary": {"stepCount": steps}})


def make_zip(path, entries, compress=zipfile.ZIP_DEFLATED):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", compress) as z:
        for name, text in entries:
            z.writestr(name, text)


def cut_short(path, keep):
    with open(path, "rb") as f:
        data = f.read()
    with open(path, "wb") as f:
        f.write(data[:keep])


def flip(path, find, by):
    """Damage the bytes of a stored entry."""
    with open(path, "rb") as f:
        data = f.read()
    assert data.count(find) == 1
    with open(path, "wb") as f:
        f.write(data.replace(find, by))


def test_one_archive_is_read_by_many_tasks(spark, tmpdir_path):
    inbox = os.path.join(tmpdir_path, "in")
    texts = {f"misc-{i}.json": json.dumps({"n": i, "pad": uuid.uuid4().hex * 20}) for i in range(300)}
    make_zip(f"{inbox}/subject_id=4/big.zip", [("folder/", ""), *texts.items(), ("note.txt", "no")], zipfile.ZIP_STORED)
    rows = AR.archive_source(spark, inbox, part_bytes=20_000)
    assert rows.rdd.getNumPartitions() > 8
    got = rows.collect()
    assert {r.file_name: bytes(r.content).decode() for r in got} == texts and len(got) == len(texts)  # each once
    assert {(r.subject_id, r.error, os.path.basename(r.archive)) for r in got} == {(4, None, "big.zip")}
    assert AR.archive_source(spark, inbox, json_only=False).count() == 301
    by_spark = AR.archive_source(spark, f"{inbox}/", by_spark=True)
    assert sorted(by_spark.columns) == sorted(rows.columns)
    assert {(r.subject_id, r.file_name) for r in by_spark.collect()} == {(4, n) for n in texts}


def test_no_archive_and_missing_folder(spark, tmpdir_path):
    os.makedirs(os.path.join(tmpdir_path, "empty"))
    assert AR.archive_source(spark, os.path.join(tmpdir_path, "empty")).count() == 0
    with pytest.raises(Exception, match="FileNotFoundError|nowhere"):
        AR.archive_source(spark, os.path.join(tmpdir_path, "nowhere")).count()


@pytest.mark.parametrize("by_spark", [False, True])
def test_damaged_archives_and_entries_are_rows(spark, tmpdir_path, by_spark):
    inbox = os.path.join(tmpdir_path, "in")
    make_zip(f"{inbox}/good.zip", [activity("2024-01-01", 1)])
    make_zip(f"{inbox}/short.zip", [activity("2024-01-02", 2)] * 1 + [("x.json", "{}" * 500)])
    cut_short(f"{inbox}/short.zip", 60)
    make_zip(f"{inbox}/flipped.zip", [("misc-a.json", "AAAAAAAA"), ("misc-b.json", "BBBBBBBB")], zipfile.ZIP_STORED)
    flip(f"{inbox}/flipped.zip", b"AAAAAAAA", b"AAAACAAA")
    make_zip(f"{inbox}/locked.zip", [("misc-c.json", "{}")], zipfile.ZIP_STORED)
    with open(f"{inbox}/locked.zip", "r+b") as f:
        data = bytearray(f.read())
        data[6] |= 1  # the encryption flag, in the entry's own header and in the directory
        data[data.index(b"PK\x01\x02") + 8] |= 1
        f.seek(0)
        f.write(data)
    if not by_spark:  # Spark's binary files leave out empty ones
        with open(f"{inbox}/nothing.zip", "wb"):
            pass
    got = {r.file_name: (r.content is not None, (r.error or "").split(":")[0])
           for r in AR.archive_source(spark, inbox, by_spark=by_spark).collect()}
    want = {"activity-2024-01-01.json": (True, ""), "short.zip": (False, "damaged_archive"),
            "misc-a.json": (False, "damaged_entry"), "misc-b.json": (True, ""), "misc-c.json": (False, "encrypted_entry")}
    assert got == (want if by_spark else {**want, "nothing.zip": (False, "damaged_archive")})


def test_load_goes_on_past_damage_and_reports_each_archive(spark, tmpdir_path):
    inbox = os.path.join(tmpdir_path, "in")
    make_zip(f"{inbox}/a.zip", [activity("2024-01-01", 1), activity("2024-01-02", 2), ("misc-bad.json", "{nope")])
    make_zip(f"{inbox}/b.zip", [activity("2024-01-03", 3)])
    cut_short(f"{inbox}/b.zip", 50)
    store = TableStore(spark, os.path.join(tmpdir_path, "tables"))
    load = lambda when: Ingest(spark, store, when).run(AR.archive_source(spark, inbox))
    one = load("2024-02-01 00:00:00")
    assert (one["new"], one["errors"]) == (4, 2)
    assert {r.steps for r in store.read("activity").collect()} == {1, 2}
    assert {r.file_name: r.parse_error.split(":")[0] for r in store.read("quarantine").collect()} == {
        "misc-bad.json": "malformed_json", "b.zip": "damaged_archive"}

    def report(when):
        rows = store.read("import_archives").where(f"imported_at = '{when}'").collect()
        assert all(r.seconds > 0 for r in rows)
        return {os.path.basename(r.archive): (r.new_files, r.changed_files, r.unchanged_files, r.errors) for r in rows}

    assert report("2024-02-01 00:00:00") == {"a.zip": (3, 0, 0, 1), "b.zip": (1, 0, 0, 1)}
    again = load("2024-02-02 00:00:00")
    assert (again["new"], again["changed"], again["unchanged"]) == (0, 0, 4)
    # the archive comes again, whole: its day is loaded, the note of the damage stays in the log alone
    make_zip(f"{inbox}/b.zip", [activity("2024-01-03", 3), activity("2024-01-02", 20)])
    third = load("2024-02-03 00:00:00")
    assert (third["new"], third["changed"], third["errors"]) == (1, 1, 0)
    assert report("2024-02-03 00:00:00")["b.zip"] == (1, 1, 0, 0)
    assert sorted(r.steps for r in store.read("activity").collect()) == [1, 3, 20]


def test_a_readable_older_entry_wins_over_a_damaged_newer_one(spark, tmpdir_path):
    inbox = os.path.join(tmpdir_path, "in")
    name, text = activity("2024-01-01", 7)
    make_zip(f"{inbox}/old.zip", [(name, text)], zipfile.ZIP_STORED)
    os.utime(f"{inbox}/old.zip", (1_000_000, 1_000_000))
    make_zip(f"{inbox}/new.zip", [(name, text.replace("7", "8"))], zipfile.ZIP_STORED)
    flip(f"{inbox}/new.zip", b'"stepCount": 8', b'"stepCount": 9')
    store = TableStore(spark, os.path.join(tmpdir_path, "tables"))
    rep = Ingest(spark, store).run(AR.archive_source(spark, inbox))
    assert (rep["new"], rep["errors"]) == (1, 0) and store.read("activity").first().steps == 7


def run_stream(spark, base, store, name, **more):
    return J.archive_stream(spark, f"{base}/in", store, journal=f"{base}/journal", name=name, **more)


def test_stream_reads_an_archive_once_and_goes_on_past_damage(spark, tmpdir_path):
    store, name = TableStore(spark, os.path.join(tmpdir_path, "tables")), uuid.uuid4().hex
    make_zip(f"{tmpdir_path}/in/subject_id=2/a.zip", [activity("2024-01-01", 1)])
    make_zip(f"{tmpdir_path}/in/subject_id=2/bad.zip", [activity("2024-01-02", 1)])
    cut_short(f"{tmpdir_path}/in/subject_id=2/bad.zip", 40)
    first = run_stream(spark, tmpdir_path, store, name)
    assert sum(r["new"] for r in first) == 2 and sum(r["errors"] for r in first) == 1
    assert store.read("activity").first().subject_id == 2
    second = run_stream(spark, tmpdir_path, store, name)
    assert sum(r["new"] + r["changed"] + r["unchanged"] for r in second) == 0  # no entry is read again
    make_zip(f"{tmpdir_path}/in/subject_id=2/c.zip", [activity("2024-01-01", 1), activity("2024-01-04", 4)])
    third = run_stream(spark, tmpdir_path, store, name)
    assert sum(r["new"] for r in third) == 1 and sum(r["unchanged"] for r in third) == 1


def test_loaded_archives_are_moved_and_half_done_moves_are_finished(spark, tmpdir_path, monkeypatch):
    store, name = TableStore(spark, os.path.join(tmpdir_path, "tables")), uuid.uuid4().hex
    done = f"{tmpdir_path}/done"
    for i in (1, 2, 3):
        make_zip(f"{tmpdir_path}/in/subject_id=1/a{i}.zip", [activity(f"2024-01-0{i}", i)])
    assert sum(r["new"] for r in run_stream(spark, tmpdir_path, store, name)) == 3
    pages = Z.ArchiveJournal(f"{tmpdir_path}/journal")
    assert pages.last() == 1 and pages.has(1, "loaded") and not pages.has(1, "moved")
    # dies after the first of three files
    os.makedirs(f"{done}/subject_id=1")
    os.rename(f"{tmpdir_path}/in/subject_id=1/a1.zip", f"{done}/subject_id=1/a1.zip")
    assert run_stream(spark, tmpdir_path, store, name, archive_dir=done) == [] or pages.last() == 1
    assert sorted(os.listdir(f"{done}/subject_id=1")) == ["a1.zip", "a2.zip", "a3.zip"]
    assert os.listdir(f"{tmpdir_path}/in/subject_id=1") == [] and pages.has(1, "moved")
    # dies after loading, before it is noted: loaded again without harm, then moved
    make_zip(f"{tmpdir_path}/in/subject_id=1/a4.zip", [activity("2024-01-04", 4)])
    with monkeypatch.context() as m:
        m.setattr(Z.ArchiveJournal, "loaded", lambda self: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception):
            run_stream(spark, tmpdir_path, store, name, archive_dir=done)
    assert os.path.exists(f"{tmpdir_path}/in/subject_id=1/a4.zip")
    again = run_stream(spark, tmpdir_path, store, name, archive_dir=done)
    assert sum(r["unchanged"] for r in again) == 1 and sum(r["new"] for r in again) == 0
    assert "a4.zip" in os.listdir(f"{done}/subject_id=1") and store.read("activity").count() == 4


def test_a_replaced_archive_is_not_moved_with_the_old_page(tmpdir_path):
    make_zip(f"{tmpdir_path}/in/a.zip", [activity("2024-01-01", 1)])
    pages = Z.ArchiveJournal(f"{tmpdir_path}/journal")
    assert pages.assign(Z.listing(f"{tmpdir_path}/in")) == 1 and pages.assign(Z.listing(f"{tmpdir_path}/in")) == 1
    pages.loaded()
    make_zip(f"{tmpdir_path}/in/a.zip", [activity("2024-01-01", 1), activity("2024-01-02", 2)])
    assert pages.move(f"{tmpdir_path}/in", f"{tmpdir_path}/done") == []
    assert pages.assign(Z.listing(f"{tmpdir_path}/in")) == 2  # new by time and size
    pages.loaded()
    assert len(pages.move(f"{tmpdir_path}/in", f"{tmpdir_path}/done")) == 1
