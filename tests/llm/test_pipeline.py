"""The five stages of corpus_pipeline on planted, odd and empty documents."""

import hashlib
from collections import defaultdict

import pytest

import corpus_pipeline as C
from stratum.llm import packing

from . import brute, data

ITEMS = [("b1", data.prose(9999, 14))]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def stages(spark, tmp_path, rows):
    """[the documents each stage got ..., the last result], stage by stage as run() does."""
    root = str(tmp_path)
    spark.createDataFrame(ITEMS, "item_id string, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{root}/documents.parquet")
    docs, out = spark.read.parquet(f"{root}/documents.parquet"), []
    for n, (name, stage) in enumerate(C.STAGES):
        out.append(docs.collect())
        stage(spark, docs, root).write.parquet(f"{root}/{n}-{name}")
        docs = spark.read.parquet(f"{root}/{n}-{name}")
        if n < len(C.STAGES) - 1:
            assert sorted(docs.columns) == sorted(c.split()[0] for c in COLUMNS.split(", "))
    return [*out, docs.collect()]


def test_stage_names():
    assert [n for n, _ in C.STAGES] == ["quality_rules", "near_dedup", "decontamination", "pseudonyms", "packed_sequences"]


def test_stages_against_brute_force(spark, tmp_path):
    texts = [(i, data.prose(i, 60 + i)) for i in range(120)]
    texts += [(200 + i, t) for i, (_, t) in enumerate(texts[:10])]                      # copies
    texts += [(300 + i, t.replace(t.split()[30], "changed", 1)) for i, (_, t) in enumerate(texts[90:100])]  # near copies
    texts += [(400, f"{data.prose(7001, 60)} {ITEMS[0][1]} {data.prose(7002, 60)}")]            # a benchmark passage
    texts += [(500, f"{data.prose(7003, 70)} mail jane.doe@example.com or +1 (826) 555-4081")]
    texts += [(600, "too short"), (601, ""), (602, None), (603, " ".join(["again and again"] * 40))]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts] + [(None, None, None, None, None)]
    first, kept, single, clean, private, pieces = stages(spark, tmp_path, rows)
    # quality: the base rules by brute force; clean prose stays
    bad = {i for i, t in texts if brute.statistics(t)[-1]}
    assert {r.doc_id for r in kept} == {i for i, _ in texts} - bad and {600, 601, 602, 603} <= bad
    # one document of each near-duplicate group stays: the smallest id
    want = brute.near_duplicates([(r.doc_id, r.text) for r in kept], 5)
    assert sorted(r.doc_id for r in single) == sorted(i for i, (_, c) in want.items() if i == c)
    # the benchmark passage is cut out, nothing else changes
    hit = brute.contamination([(r.doc_id, r.text) for r in single], ITEMS)
    before = {r.doc_id: r.text for r in single}
    assert {i for i, (_, n, _) in hit.items() if n} == {400}
    for r in clean:
        assert (r.text == before[r.doc_id]) == (r.doc_id != 400) and r.n_chars == len(r.text)
    assert ITEMS[0][1] not in next(r.text for r in clean if r.doc_id == 400)
    # personal values are replaced
    for r in private:
        assert (r.text == before[r.doc_id]) == (r.doc_id not in (400, 500))
    text = next(r.text for r in private if r.doc_id == 500)
    assert "jane.doe@" not in text and "555-4081" not in text
    # every id of every document lies in exactly one piece
    tokenizer = packing.CachedTokenizer(open(data.TOKENIZER, encoding="utf-8").read())
    by_doc, filled = defaultdict(list), defaultdict(int)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        filled[p.sequence_id] += p.length
    for r in private:
        mine = sorted(by_doc[r.doc_id], key=lambda p: p.start)
        whole = b"".join(bytes(p.ids) for p in mine)
        assert hashlib.sha256(whole).digest() == hashlib.sha256(tokenizer.ids(r.text) + (1).to_bytes(4, "little")).digest()
    assert set(by_doc) == {r.doc_id for r in private}
    assert all(n == 2048 for s, n in filled.items() if s < max(filled))


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)]])
def test_stages_of_nothing(spark, tmp_path, rows):
    assert stages(spark, tmp_path, rows)[-1] == []
