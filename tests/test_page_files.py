"""Page files written under their own names, and the ledger of the files loaded."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import page_doc, rec, write_batch
from stratum.plans import pipeline as P
from stratum.sources import bronze as B
from stratum.sources import file_ledger as L
from stratum.sources.page_sink import open_folder, write_named_pages
from stratum.sources.pages import scan_page_files

PAGES = "batch_id int, page int, raw_json string"


def _pages(spark, ids):
    rows = [(b, p, page_doc([rec(100 * b + p)])) for b, p in ids]
    return spark.createDataFrame(rows, PAGES)


def _tree(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, files in os.walk(root) for f in files)


def _age(root, seconds=100):
    """As if the folders had last changed some time ago."""
    for i, name in enumerate(sorted(os.listdir(root))):
        at = os.stat(os.path.join(root, name)).st_mtime - seconds
        os.utime(os.path.join(root, name), (at, at))


# ---------------------------------------------------------------- the sink
def test_named_pages_round_trip(spark, tmp_root):
    out = os.path.join(tmp_root, "import")
    pages = _pages(spark, [(b, p) for b in (1, 2, 12) for p in range(1, 8)]).repartition(5)
    write_named_pages(pages, out)
    assert _tree(out) == sorted(f"batch_{b}/page_{p}.json" for b in (1, 2, 12) for p in range(1, 8))
    with open(os.path.join(out, "batch_12", "page_3.json")) as f:
        assert f.read() == page_doc([rec(1203)])  # the document as it was given
    back = scan_page_files(spark, out)
    assert sorted((r.batch_id, r.page) for r in back.collect()) == [(b, p) for b in (1, 2, 12) for p in range(1, 8)]
    assert P.load_missing_batches(spark, out, os.path.join(tmp_root, "wh")) == 21


def test_texts_and_extra_columns(spark, tmp_root):
    out = os.path.join(tmp_root, "import")
    rows = [(1, 1, "", "x"), (1, 2, "ü\u0000 \U0001f600\n", "y"), (1, 3, "a" * 3_000_000, "z")]
    write_named_pages(spark.createDataFrame(rows, PAGES + ", path string"), out)
    for _, page, text, _ in rows:
        with open(os.path.join(out, "batch_1", f"page_{page}.json"), newline="") as f:
            assert f.read() == text
    write_named_pages(spark.createDataFrame([], PAGES), os.path.join(tmp_root, "none"))
    assert _tree(os.path.join(tmp_root, "none")) == []


@pytest.mark.parametrize("bad", [(None, 1, "{}"), (1, None, "{}"), (1, 1, None), (-1, 1, "{}"), (1, -1, "{}")])
def test_an_aborted_job_leaves_nothing(spark, tmp_root, bad):
    out = os.path.join(tmp_root, "import")
    good = _pages(spark, [(b, p) for b in (1, 2) for p in range(1, 30)])
    with pytest.raises(Exception, match="a page needs"):
        write_named_pages(good.union(spark.createDataFrame([bad], PAGES)), out)
    failing = good.withColumn("raw_json", F.when(F.col("page") == 20, F.raise_error(F.lit("lost"))).otherwise(F.col("raw_json")))
    with pytest.raises(Exception, match="lost"):
        write_named_pages(failing, out)
    assert _tree(out) == [] and (not os.path.exists(out) or os.listdir(out) == [])


def test_a_page_given_twice_or_a_batch_that_is_there(spark, tmp_root):
    out = os.path.join(tmp_root, "import")
    twice = _pages(spark, [(1, 1), (1, 2)]).union(_pages(spark, [(1, 2)]))
    with pytest.raises(Exception, match="there twice"):
        write_named_pages(twice, out)
    with pytest.raises(Exception, match="there twice"):
        write_named_pages(twice.coalesce(1), out)
    write_named_pages(_pages(spark, [(1, 1), (1, 2), (2, 1)]), out)
    before = _tree(out)
    with pytest.raises(Exception, match="exists"):
        write_named_pages(_pages(spark, [(0, 5), (2, 9)]), out)
    assert _tree(out) == before  # batch 0 has not come in either
    write_named_pages(_pages(spark, [(2, 9), (3, 1)]), out, overwrite=True)
    assert _tree(out) == ["batch_1/page_1.json", "batch_1/page_2.json", "batch_2/page_9.json", "batch_3/page_1.json"]


def test_a_second_attempt_replaces_the_first(tmp_root):
    from pyspark.sql import Row
    from stratum.sources.page_sink import PageFileWriter
    writer = PageFileWriter(f"file:{tmp_root}/import", False)
    rows = [Row(batch_id=1, page=p, raw_json=f"doc {p}") for p in (1, 2, 3)]

    def dies():
        yield from rows[:2]
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        writer.write(dies())
    writer.commit([writer.write(iter(rows)), None])
    assert _tree(f"{tmp_root}/import") == [f"batch_1/page_{p}.json" for p in (1, 2, 3)]


def test_a_commit_that_fails_half_way_is_undone(tmp_root, monkeypatch):
    from pyspark.sql import Row
    from stratum.sources import page_sink
    root = f"{tmp_root}/import"
    first = page_sink.PageFileWriter(root, False)
    first.commit([first.write(iter([Row(batch_id=1, page=1, raw_json="old")]))])
    writer = page_sink.PageFileWriter(root, True)
    message = writer.write(iter([Row(batch_id=b, page=2, raw_json="new") for b in (0, 1, 2)]))
    files, path = open_folder(root)

    class Failing:
        def __getattr__(self, name):
            return getattr(files, name)

        def move(self, src, dst):
            if dst.endswith("import/batch_2"):
                raise OSError("no space")
            files.move(src, dst)

    monkeypatch.setattr(page_sink, "open_folder", lambda _: (Failing(), path))
    with pytest.raises(OSError):
        writer.commit([message])
    writer.abort([message])
    assert _tree(root) == ["batch_1/page_1.json"]
    assert open_folder("file:///a/b/")[1] == open_folder("file:/a/b")[1] == open_folder("/a/b/")[1] == "/a/b"


# -------------------------------------------------------------- the ledger
@pytest.fixture()
def listed(monkeypatch):
    """The folders that were listed, call by call."""
    calls, plain = [], L.list_files

    def spy(spark, root, folders, layout="fetched"):
        calls.append(list(folders))
        return plain(spark, root, folders, layout)

    monkeypatch.setattr(L, "list_files", spy)
    return calls


def test_a_second_run_lists_no_loaded_batch(spark, tmp_root, listed):
    src, raw = os.path.join(tmp_root, "import"), os.path.join(tmp_root, "raw")
    assert L.load_new_files(spark, src, raw) == 0  # nothing there yet
    for b in (1, 2, 10):
        write_batch(src, b, {1: [rec(b)], 2: [rec(b + 100)]})
    os.makedirs(os.path.join(src, "batch_x"))
    os.makedirs(os.path.join(src, "batch_11"))  # empty
    _age(src)
    assert L.load_new_files(spark, src, raw) == 6
    assert listed == [["batch_1", "batch_2", "batch_10", "batch_11"]]
    assert L.load_new_files(spark, src, raw) == 0 and len(listed) == 1
    write_batch(src, 11, {1: [rec(11)]})
    assert L.load_new_files(spark, src, raw) == 1 and listed[1:] == [["batch_11"]]
    rows = B.read_bronze(spark, raw).orderBy("id").collect()
    assert [(r.id, r.batch_id, r.page) for r in rows] == [
        (1, 1, 1), (2, 1, 2), (3, 2, 1), (4, 2, 2), (5, 10, 1), (6, 10, 2), (7, 11, 1)]
    files = L.FileLedger(spark, raw).files().collect()
    assert len(files) == 7 and all(r.length > 0 and r.modified is not None for r in files)
    assert {(r.batch_id, r.page, r.folder) for r in files} == {(r.batch_id, r.page, f"batch_{r.batch_id}") for r in rows}


def test_a_half_loaded_batch_is_finished(spark, tmp_root, listed, monkeypatch):
    src, raw = os.path.join(tmp_root, "import"), os.path.join(tmp_root, "raw")
    write_batch(src, 1, {1: [rec(1)], 2: [rec(2)]})
    assert B.append_batches(spark, scan_page_files(spark, src), raw) == 2  # loaded without a ledger
    write_batch(src, 1, {3: [rec(3)], 4: [rec(4)]})
    write_batch(src, 2, {1: [rec(5)]})
    read, plain = [], L.read_files
    monkeypatch.setattr(L, "read_files", lambda s, paths, layout: read.extend(paths) or plain(s, paths, layout))
    assert L.load_new_files(spark, src, raw) == 3
    assert sorted(os.path.basename(p) for p in read) == ["batch_2", "page_3.json", "page_4.json"]
    # just written, so the folders are looked at once more, to no effect
    assert L.load_new_files(spark, src, raw) == 0 and len(listed) == 2
    monkeypatch.setattr(L, "PATHS_PER_READ", 0)  # many new files: the folder is read whole
    write_batch(src, 1, {5: [rec(6)]})
    read.clear()
    assert L.load_new_files(spark, src, raw) == 1 and [os.path.basename(p) for p in read] == ["batch_1"]
    got = B.read_bronze(spark, raw).collect()
    assert sorted((r.batch_id, r.page) for r in got) == [(1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (2, 1)]
    assert sorted(r.id for r in got) == list(range(1, 7))


def test_a_run_that_dies_before_its_entry_repeats_nothing(spark, tmp_root, monkeypatch):
    src, raw = os.path.join(tmp_root, "import"), os.path.join(tmp_root, "raw")
    for b in (1, 2, 3):
        write_batch(src, b, {1: [rec(b)], 2: [rec(10 + b)]})
    publish, calls = L.FileLedger.publish, []

    def dies(self, load, folders):
        calls.append(folders)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        publish(self, load, folders)

    monkeypatch.setattr(L.FileLedger, "publish", dies)
    with pytest.raises(RuntimeError, match="driver lost"):
        L.load_new_files(spark, src, raw, step=1)
    assert B.read_bronze(spark, raw).count() == 4 and L.FileLedger(spark, raw).files().count() == 2
    assert L.load_new_files(spark, src, raw, step=1) == 2
    got = B.read_bronze(spark, raw).collect()
    assert len(got) == 6 == len({(r.batch_id, r.page) for r in got}) == len({r.id for r in got})
    assert L.FileLedger(spark, raw).files().count() == 6


def test_bad_names_and_changed_files(spark, tmp_root):
    src, raw = os.path.join(tmp_root, "import"), os.path.join(tmp_root, "raw")
    folder = write_batch(src, 1, {1: [rec(1)], 2: [rec(2)]})
    assert L.changed_files(spark, os.path.join(tmp_root, "none"), raw).count() == 0
    assert L.load_new_files(spark, src, raw) == 2 and L.changed_files(spark, src, raw).count() == 0
    write_batch(src, 1, {2: [rec(2), rec(3)]})
    assert [(r.batch_id, r.page) for r in L.changed_files(spark, src, raw).collect()] == [(1, 2)]
    with open(os.path.join(folder, "page_last.json"), "w") as f:
        f.write("{}")
    with pytest.raises(ValueError, match="without batch or page"):
        L.load_new_files(spark, src, raw)
    assert B.read_bronze(spark, raw).count() == 2


def test_the_ledger_is_written_anew_as_one(spark, tmp_root, monkeypatch):
    src, raw = os.path.join(tmp_root, "import"), os.path.join(tmp_root, "raw")
    monkeypatch.setattr(L, "LOADS_KEPT", 2)
    for b in range(1, 5):
        write_batch(src, b, {1: [rec(b)]})
        _age(src)
        assert L.load_new_files(spark, src, raw) == 1
        assert L.FileLedger(spark, raw).files().count() == b
    assert len(L.FileLedger(spark, raw).state()["loads"]) == 2
    assert set(L.FileLedger(spark, raw).state()["folders"]) == {f"batch_{b}" for b in range(1, 5)}


def test_small_files_are_read_many_to_a_task(spark, tmp_root, monkeypatch):
    src, raw = os.path.join(tmp_root, "import"), os.path.join(tmp_root, "raw")
    write_batch(src, 1, {p: [rec(p)] for p in range(1, 61)})
    tasks, plain = [], B.write_raw
    monkeypatch.setattr(B, "write_raw", lambda rows, *a: tasks.append(rows.rdd.getNumPartitions()) or plain(rows, *a))
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")  # a partition each
    try:
        assert L.load_new_files(spark, src, raw) == 60
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    assert tasks == [16]  # four a core
    assert sorted((r.batch_id, r.page) for r in B.read_bronze(spark, raw).collect()) == [(1, p) for p in range(1, 61)]


def _odd_folder(src):
    """Batch 1 with names and texts out of the common."""
    folder = write_batch(src, 1, {1: [rec(1)], 2: [rec(2)]})
    texts = {"page_3.json": b"", "page_4.json": b"\xef\xbb\xbf{}", "page_5.json": b"no json \xff\xfe\n", "page_6.json": "{\"a\": \"ü\U0001f600\"}".encode(),
             "page_x.json": b"{}", "_page_7.json": b"{}", ".page_8.json": b"{}", "page_9.txt": b"{}", "page_10 %20#.json": b"{}",
             "page_11.json._COPYING_": b"{}", "deep er/page_12.json": b"{}", "_hidden/page_13.json": b"{}", "_k=1/page_14.json": b"{}", ".d/page_15.json": b"{}",
             "_metadata/page_17.json": b"{}", "_metadata_x": b"{}"}
    for name, text in texts.items():
        os.makedirs(os.path.dirname(os.path.join(folder, name)), exist_ok=True)
        with open(os.path.join(folder, name), "wb") as f:
            f.write(text)
    os.symlink(os.path.join(folder, "page_1.json"), os.path.join(folder, "page_16.json"))
    os.makedirs(os.path.join(folder, "page_18.json"))  # a folder
    return folder


def test_executors_list_and_read_as_sparks_readers_do(spark, tmp_root, monkeypatch):
    src = os.path.join(tmp_root, "im port")
    folder = _odd_folder(src)
    write_batch(src, 2, {1: [rec(3)]})
    paths = [f"{src}/batch_2", f"file:{folder}/page_1.json", f"{folder}/page_5.json"]

    def found():
        listed = sorted(map(tuple, L.list_files(spark, src, ["batch_1", "batch_2"]).collect()), key=str)
        read = [sorted(map(tuple, L.read_files(spark, p).select("batch_id", "page", F.hex("raw_json")).collect()), key=str)
                for p in ([f"{src}/batch_1"], paths)]
        return listed, read

    by_executors = found()
    monkeypatch.setattr(L, "_local", lambda *_: None)
    assert by_executors == found()
    assert len(by_executors[0]) == 12 and [len(r) for r in by_executors[1]] == [11, 3]


def test_the_driver_holds_no_row_a_file(spark, tmp_root, monkeypatch):
    src, raw = os.path.join(tmp_root, "import"), os.path.join(tmp_root, "raw")
    inputs, joins, frame = [], [], type(spark.range(0))
    for name in ("list_files", "read_files"):
        monkeypatch.setattr(L, name, lambda *a, plain=getattr(L, name): inputs.append((df := plain(*a)).inputFiles()) or df)

    def join(self, other, on=None, how=None, plain=frame.join):
        df = plain(self, other, on, how)
        if on in (["batch_id", "page"], "path"):
            plan = df._jdf.queryExecution().sparkPlan().toString()
            joins.append(next(line.split("[")[0].strip("+- ") for line in plan.splitlines() if "Join" in line))
        return df

    monkeypatch.setattr(frame, "join", join)
    for b in (1, 2):
        write_batch(src, b, {p: [rec(p)] for p in range(1, 21)})
        assert L.load_new_files(spark, src, raw) == 20
    assert inputs == [[]] * 4  # files that the driver has listed
    assert len(joins) == 8 and {j.split()[0] for j in joins} == {"SortMergeJoin"}


def test_a_commit_walks_the_files_of_a_batch(tmp_root, monkeypatch):
    from pyspark.sql import Row
    from stratum.sources import page_sink
    writer = page_sink.PageFileWriter(f"{tmp_root}/import", False)
    message = writer.write(iter([Row(batch_id=1, page=p, raw_json="x") for p in range(5)]))
    monkeypatch.setattr(page_sink.pafs, "FileSelector", lambda *_: pytest.fail("a list of all files"))
    writer.commit([message])
    assert len(_tree(f"{tmp_root}/import")) == 5
