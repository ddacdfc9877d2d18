"""Copy-on-write buckets: what an upsert rewrites, conflicts, epochs, vacuum."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rec, write_batch
from stratum.plans import pipeline as P
from stratum.sources.bucket_store import BucketStore
from stratum.sources.commit_log import CommitLog, Conflict

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])


def store_at(spark, root, buckets=32):
    return BucketStore(spark, root, {"t": (SCHEMA, "id")}, buckets)


def rows(spark, pairs):
    return spark.createDataFrame(pairs, SCHEMA)


def contents(df):
    return sorted(((r.id, r.v) for r in df.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def files(root):
    return set(glob.glob(os.path.join(root, "t", "data", "*", "*", "part-*")))


def test_upsert_rewrites_only_its_buckets(spark, tmp_root):
    store = store_at(spark, tmp_root)
    assert store.read("t").count() == 0 and store.current_version("t") is None
    assert store.upsert("t", rows(spark, [(i, "a") for i in range(1000)]), ["id"]) == 1000
    before = files(tmp_root)
    assert len({os.path.dirname(f) for f in before}) == 32
    batch = [(i, "b") for i in range(0, 1000, 100)] + [(2000, "b")]  # 1 % of the keys, and a new one
    assert store.upsert("t", rows(spark, batch), ["id"]) == 1001
    new = files(tmp_root) - before
    bucket = F.pmod(F.hash("id"), F.lit(32))
    touched = {r[0] for r in rows(spark, batch).select(bucket).collect()}
    assert {int(os.path.basename(os.path.dirname(f)).split("=")[1]) for f in new} == touched and len(touched) <= 11
    assert before <= files(tmp_root)
    # both versions can be read, each from its own files
    assert contents(store.read("t", 1)) == [(i, "a") for i in range(1000)]
    want = dict([(i, "a") for i in range(1000)] + batch)
    assert contents(store.read("t")) == sorted(want.items())
    used = {f.replace("file://", "").replace("file:", "") for f in store.read("t").inputFiles()}
    assert used & new == new and len({os.path.dirname(f) for f in used}) == 32
    # an upsert reads the touched buckets only
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in store.read("t", buckets=sorted(touched)).inputFiles()} == touched
    assert store.rows("t", 1) == 1000 and store.rows("t") == 1001
    with pytest.raises(ValueError, match="no version"):
        store.read("t", 9)


def test_null_keys_and_empty_batches(spark, tmp_root):
    store = store_at(spark, tmp_root, 4)
    assert store.upsert("t", rows(spark, [(None, "n"), (1, "a")]), ["id"]) == 2
    assert store.upsert("t", rows(spark, []), ["id"]) == 2
    assert store.upsert("t", rows(spark, [(None, "m")]), ["id"]) == 3  # as in MERGE: null matches nothing
    assert contents(store.read("t")) == [(1, "a"), (None, "m"), (None, "n")]


def interleaved(spark, root, mine, theirs):
    """``theirs`` is published by another writer while ``mine`` is being written."""
    a, b = store_at(spark, root), store_at(spark, root)
    write, times = a._write, []

    def during(name, df):
        out = write(name, df)
        if not times:
            b.upsert("t", rows(spark, theirs), ["id"])
        times.append(1)
        return out

    a._write = during
    a.upsert("t", rows(spark, mine), ["id"])
    return a, len(times)


def test_interleaved_writers_of_other_buckets(spark, tmp_root):
    first = store_at(spark, tmp_root)
    first.upsert("t", rows(spark, [(i, "a") for i in range(200)]), ["id"])
    bucket = {r.id: r.b for r in rows(spark, [(i, "") for i in range(200)]).select("id", F.pmod(F.hash("id"), F.lit(32)).alias("b")).collect()}
    other = next(i for i in range(200) if bucket[i] != bucket[0])
    store, writes = interleaved(spark, tmp_root, [(0, "mine")], [(other, "theirs")])
    assert writes == 1  # its files are kept, on top of the other version
    want = {i: "a" for i in range(200)} | {0: "mine", other: "theirs"}
    assert contents(store.read("t")) == sorted(want.items()) and store.versions("t") == [1, 2, 3]
    assert contents(store.read("t", 2)) == sorted((want | {0: "a"}).items())


def test_interleaved_writers_of_one_bucket(spark, tmp_root):
    store_at(spark, tmp_root).upsert("t", rows(spark, [(i, "a") for i in range(200)]), ["id"])
    store, writes = interleaved(spark, tmp_root, [(7, "mine"), (500, "mine")], [(7, "theirs"), (8, "theirs")])
    assert writes == 2  # merged again on the other writer's rows
    want = {i: "a" for i in range(200)} | {8: "theirs", 7: "mine", 500: "mine"}
    assert contents(store.read("t")) == sorted(want.items())
    # also where both begin with an empty table
    root = os.path.join(tmp_root, "new")
    store, _ = interleaved(spark, root, [(1, "mine")], [(1, "theirs"), (2, "theirs")])
    assert contents(store.read("t")) == [(1, "mine"), (2, "theirs")]


def test_vacuum(spark, tmp_root):
    store = store_at(spark, tmp_root, 8)
    for v in "abcd":
        store.upsert("t", rows(spark, [(i, v) for i in range(3 if v == "c" else 50)]), ["id"])
    os.makedirs(os.path.join(tmp_root, "t", "data", "_attempt=dead", "_bucket=1"))
    now = contents(store.read("t"))
    assert store.vacuum("t", keep=2) == 0  # all younger than the grace period
    assert store.versions("t") == [3, 4]
    removed = store.vacuum("t", keep=1, grace_hours=0)
    assert removed > 8 and store.versions("t") == [4] and contents(store.read("t")) == now
    assert not os.path.exists(os.path.join(tmp_root, "t", "data", "_attempt=dead"))
    assert {os.path.dirname(f) for f in files(tmp_root)} == {os.path.dirname(f.replace("file://", "").replace("file:", "")) for f in store.read("t").inputFiles()}
    assert store.upsert("t", rows(spark, [(99, "e")]), ["id"]) == 51
    with pytest.raises(ValueError):
        store.vacuum("t", keep=0)


def test_epochs_are_committed_once(spark, tmp_root):
    store = store_at(spark, tmp_root, 4)
    store.upsert("t", rows(spark, [(1, "a")]), ["id"], writer="s", epoch=0)
    assert store.committed("t", "s", 0) == 0 and store.committed("t", "s", 1) is None and store.committed("t", "x", 0) is None
    before = files(tmp_root)
    assert store.upsert("t", rows(spark, [(1, "again")]), ["id"], writer="s", epoch=0) == 1
    assert files(tmp_root) == before and store.current_version("t") == 1
    store.upsert("t", rows(spark, [(2, "b")]), ["id"], writer="s", epoch=1)
    store.upsert("t", rows(spark, [(3, "c")]), ["id"])  # another writer keeps the ledger
    assert store.committed("t", "s", 1) == 1
    assert contents(store.read("t")) == [(1, "a"), (2, "b"), (3, "c")]


def test_commit_log_takes_a_number_once(spark, tmp_root):
    log = CommitLog(spark, os.path.join(tmp_root, "log"))
    assert log.last() == (0, None) and log.publish(1, {"x": 1}) and not log.publish(1, {"x": 2})
    assert log.append(lambda n, e: {"x": e["x"] + n}) == (2, {"x": 2})
    assert log.since(1) == [{"x": 2}] and log.read(7) is None
    open(os.path.join(tmp_root, "log", "000000000003.json"), "w").close()
    with pytest.raises(Conflict):
        log.append(lambda n, e: e, tries=2, wait=0)


# ---------------------------------------------------------------- micro-batches
def test_twelve_batches_in_one_micro_batch(spark, tmp_root):
    from stratum.streaming.incremental import stream_pages_to_silver
    pages, wh, ckpt = (os.path.join(tmp_root, x) for x in ("in", "wh", "ckpt"))
    for b in range(1, 13):
        write_batch(pages, b, {1: [rec(1, score=float(b)), rec(100 + b, score=1.0, genres=[(b, f"g{b}")])]})
    stream_pages_to_silver(spark, pages, wh, ckpt).awaitTermination(300)
    store = P.open_store(spark, wh)
    assert {n: store.versions(n) for n in P.silver_tables()} == {n: [1] for n in P.silver_tables()}
    silver = {r.anime_id: r for r in store.read("anime").collect()}
    assert len(silver) == 13 and silver[1].score == 12.0 and silver[1].batch_id == 12
    assert store.read("links_anime_genres").count() == 12
    # the same epoch once more: Spark replays it if the stream died before its own commit
    written = {f: os.path.getmtime(f) for f in glob.glob(os.path.join(wh, "curated", "**", "*"), recursive=True)}
    raw = P.B.read_bronze(spark, os.path.join(wh, "raw", "api_data"))
    P.load_curated(spark, wh, pages=raw, writer=ckpt, epoch=0)
    assert {f: os.path.getmtime(f) for f in glob.glob(os.path.join(wh, "curated", "**", "*"), recursive=True)} == written


def test_replay_after_half_of_the_tables(spark, tmp_root, monkeypatch):
    """The epoch failed after the entity: the replay leaves it alone and does the rest
    as seen from before the epoch."""
    pages, wh = os.path.join(tmp_root, "in"), os.path.join(tmp_root, "wh")
    write_batch(pages, 1, {1: [rec(1, genres=[(1, "old")])]})
    write_batch(pages, 2, {1: [rec(1, genres=[(1, "new")]), rec(2)]})
    P.load_missing_batches(spark, pages, wh)
    raw = P.B.read_bronze(spark, os.path.join(wh, "raw", "api_data"))
    upsert = BucketStore.upsert

    def failing(self, name, *args, **kw):
        if name == "links_anime_genres":
            raise RuntimeError("lost")
        return upsert(self, name, *args, **kw)

    monkeypatch.setattr(BucketStore, "upsert", failing)
    with pytest.raises(RuntimeError, match="lost"):
        P.load_curated(spark, wh, pages=raw, writer="s", epoch=3)
    monkeypatch.undo()
    out = P.load_curated(spark, wh, pages=raw, writer="s", epoch=3)
    store = P.open_store(spark, wh)
    assert store.versions("anime") == [1] and out["anime"] == 2 and out["links_anime_genres"] == 1
    assert [r.genre_name for r in store.read("links_anime_genres").collect()] == ["new"]


# ------------------------------------------------------------------ raw ids
def page_rows(spark, batch, n):
    return spark.createDataFrame([(batch, p, "{}") for p in range(1, n + 1)], "batch_id int, page int, raw_json string")


def test_interleaved_loads_share_no_id(spark, tmp_root, monkeypatch):
    from stratum.sources import bronze as B
    path, reserve, outcome = os.path.join(tmp_root, "raw"), B.reserve_ids, []

    def during(spark_, path_, n, batches, writer=None):
        out = reserve(spark_, path_, n, batches, writer)
        if not outcome:  # the first writer has its ids, but has written nothing yet
            outcome.append(None)
            assert B.append_batches(spark, page_rows(spark, 2, 4), path) == 4
            with pytest.raises(B.Conflict, match="batch 1 is being loaded"):
                B.append_batches(spark, page_rows(spark, 1, 3), path)
        return out

    monkeypatch.setattr(B, "reserve_ids", during)
    assert B.append_batches(spark, page_rows(spark, 1, 3), path) == 3
    assert B.append_batches(spark, page_rows(spark, 1, 3), path) == 0
    got = sorted((r.batch_id, r.page, r.id) for r in B.read_bronze(spark, path).collect())
    assert [x[:2] for x in got] == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (2, 4)]
    assert [x[2] for x in got] == [1, 2, 3, 4, 5, 6, 7]


def test_failed_and_vanished_loads(spark, tmp_root, monkeypatch):
    from stratum.sources import bronze as B
    path = os.path.join(tmp_root, "raw")
    broken = page_rows(spark, 1, 2).withColumn("raw_json", F.raise_error(F.lit("unreadable")).cast("string"))
    with pytest.raises(Exception, match="unreadable"):
        B.write_raw(broken, path, keys=page_rows(spark, 1, 2))
    assert B.append_batches(spark, page_rows(spark, 1, 2), path) == 2  # the claim was given up, the ids were not
    assert sorted(r.id for r in B.read_bronze(spark, path).collect()) == [3, 4]
    B.reserve_ids(spark, path, 5, [2], writer="gone")  # killed before it wrote anything
    with pytest.raises(B.Conflict):
        B.append_batches(spark, page_rows(spark, 2, 1), path)
    assert B.write_raw(page_rows(spark, 2, 1), path, writer="gone") == 1  # the same writer, started again
    B.reserve_ids(spark, path, 5, [3], writer="gone")
    monkeypatch.setattr(B, "LEASE_SECONDS", 0)
    assert B.append_batches(spark, page_rows(spark, 3, 1), path) == 1
    ids = [r.id for r in B.read_bronze(spark, path).collect()]
    assert len(set(ids)) == len(ids) == 4
    with pytest.raises(B.Conflict, match="in the meantime"):
        B.write_raw(page_rows(spark, 3, 1), path)
    with pytest.raises(ValueError, match="twice"):
        B.write_raw(page_rows(spark, 4, 1).union(page_rows(spark, 4, 1)), path)
