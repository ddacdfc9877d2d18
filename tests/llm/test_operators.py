"""Each operator against a brute-force version, on edge cases and empty tables."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import (decontaminate, nbsvm, neardup, outliers, packing, pii, repeats, sharding, store,
                         suffix_tree, unigram)
from stratum.llm.components import components

from . import brute, data


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def edge(spark):
    return data.edge(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return data.empty(spark)


# ------------------------------------------------------------------ 1
def test_components_chain_and_star(spark):
    links = [(1, 2), (3, 2), (3, 4), (5, 4), (9, 8), (9, 9), (10, 30), (20, 30), (2, 1)] + [(100, n) for n in range(101, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert [got[n] for n in (1, 2, 3, 4, 5)] == [1] * 5
    assert [got[n] for n in (8, 9, 10, 20, 30, 150)] == [8, 8, 10, 10, 10, 100]


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, size):
    pairs = data.texts()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(data.plain(spark, pairs), size).collect()}
    assert got == brute.near_duplicates(pairs, size)


def test_near_duplicates_edges(edge, empty):
    got = neardup.near_duplicates(edge, 2).collect()
    assert len(got) == edge.count()
    alone = [r for r in got if r.doc_id in (200, 201, 100)]
    assert all(r.n_shingles == 0 and r.component_id == r.doc_id and r.kept for r in alone)
    assert neardup.near_duplicates(empty, 2).count() == 0


def damaged_copies(n, most, seed):
    """Copies of one text with up to ``most`` words replaced, a word always by the same."""
    rng = random.Random(seed)
    base = data.prose(seed, 100).split()
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(100), rng.randint(1, most)):
            words[at] = f"other{at}"
        out.append(" ".join(words))
    return out


def test_near_duplicates_compare_few_sets_of_a_dense_neighbourhood(spark, monkeypatch):
    pairs = list(enumerate(damaged_copies(400, 16, 1)))
    compared, checked = [], neardup._checked

    def counting(rows, bounded):
        compared.append(rows.select("a", "b").count())
        return checked(rows, bounded)

    monkeypatch.setattr(neardup, "_checked", counting)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(data.plain(spark, pairs), 2).collect()}
    want = brute.near_duplicates(pairs, 2)
    assert got == want
    assert len({c for _, c in want.values()}) > 20  # many sets are apart from the largest part
    assert sum(compared) < 20 * len(pairs)


def test_small_tables_are_written_in_few_files(spark):
    cores = spark.sparkContext.defaultParallelism
    assert store.few_files(spark.range(0, 100, 1, 64), 100).rdd.getNumPartitions() == cores
    assert store.few_files(spark.range(0, 100, 1, 64), 100, 5).rdd.getNumPartitions() == max(cores, 20)
    assert store.few_files(spark.range(0, 100, 1, 2), 100).rdd.getNumPartitions() == 2
    assert store.few_files(spark.range(0, 100, 1, 64), 1 << 40).rdd.getNumPartitions() == 64


def test_deduplicated_keeps_one_of_each_group(spark, edge, empty):
    pairs = data.texts()
    want = brute.near_duplicates(pairs, 5)
    kept = neardup.deduplicated(data.plain(spark, pairs)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i, (_, c) in want.items() if i == c)
    out = neardup.deduplicated(edge)
    assert out.columns == edge.columns
    assert Counter(r.doc_id for r in out.collect())[5] <= 1
    assert neardup.deduplicated(empty).columns == empty.columns


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 63, (2, 3000), dtype=np.uint64)
    both = np.concatenate([a, b])
    one = lambda g: neardup.sketch(np.zeros(len(g), np.int64), np.sort(g), 1)
    assert (np.maximum(one(a), one(b)) == one(both)).all()
    for share in (0.5, 0.8, 0.95):
        k = int(3000 * 2 * share / (1 + share))
        x, y = a, np.concatenate([a[:k], b[k:]])
        j = neardup.similarity(one(x), one(y), np.array([3000.0]), np.array([3000.0]))[0]
        assert abs(j - share) < 0.15


# ------------------------------------------------------------------ 2
def test_tokenizer_cache_is_exact():
    from tokenizers import Tokenizer
    definition = open(data.TOKENIZER, encoding="utf-8").read()
    whole = Tokenizer.from_str(definition)
    whole.encode_special_tokens = True
    mine = packing.CachedTokenizer(definition)
    rng = np.random.default_rng(2)
    alphabet = list("aAbé ÉñßI'sŚ  \x0b\x1c\x85\n\t\r 12²😀|<endoftext>İ中'll’µª")
    texts = [t for _, t in data.texts()] + ["".join(rng.choice(alphabet, 30)) for _ in range(500)]
    texts += ["".join(rng.choice(list("aB éÉß×÷.,-'12|\n"), 20)) for _ in range(500)]
    for t in texts:
        assert np.frombuffer(mine.ids(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("sequence,packet", [(64, 16), (2048, 512)])
def test_packing_round_trip(edge, sequence, packet):
    tokenizer = packing.CachedTokenizer(open(data.TOKENIZER, encoding="utf-8").read())
    pieces = packing.packed(edge, data.TOKENIZER, sequence_tokens=sequence, packet=packet).collect()
    filled = Counter()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled[p.sequence_id] and 0 < p.length == len(p.ids) // 4
        filled[p.sequence_id] += p.length
    assert sorted(filled) == list(range(len(filled)))
    assert all(n == sequence for s, n in filled.items() if s < len(filled) - 1)
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    for i, t in data.texts():
        if i == 5:
            continue  # a repeated row: its pieces are there three times
        whole = b"".join(bytes(p.ids) for p in sorted(by_doc[i], key=lambda p: p.start))
        assert whole == tokenizer.ids(t) + (1).to_bytes(4, "little")
    n_rows = Counter(r.doc_id for r in edge.collect())
    assert all(sum(p.start == 0 for p in by_doc[i]) == n for i, n in n_rows.items())


def test_packing_follows_the_mixture(spark):
    rows = [(i, data.prose(i, 300), "en", "ab"[i % 2], 0) + ("x",) * len(data.CLASHING) for i in range(400)]
    docs = spark.createDataFrame(rows, data.SCHEMA)
    pieces = packing.packed(docs, data.TOKENIZER, mixture={"a": 3, "b": 1}).collect()
    early = [p for p in pieces if p.sequence_id < 20]
    share = sum(p.length for p in early if p.source == "a") / sum(p.length for p in early)
    assert abs(share - 0.75) < 0.03
    # as long as both queues hold tokens every window keeps the mixture; then the other queue is sent alone
    held = {s: sum(p.length for p in pieces if p.source == s) for s in "ab"}
    last = max(p.sequence_id for p in pieces)
    empty_at = max(p.sequence_id for p in pieces if p.source == "a")
    assert held["a"] / 3 < held["b"] and empty_at < last
    for lo in range(0, empty_at - 8, 8):
        part = [p for p in pieces if lo <= p.sequence_id < lo + 8]
        assert abs(sum(p.length for p in part if p.source == "a") / sum(p.length for p in part) - 0.75) < 0.06
    assert {p.source for p in pieces if p.sequence_id > empty_at + 1} == {"b"}
    for wrong in (0, -1, float("nan")):
        with pytest.raises(ValueError, match="positive"):
            packing.packed(docs, data.TOKENIZER, mixture={"a": 1, "b": wrong})


def test_packing_empty(empty):
    assert packing.packed(empty, data.TOKENIZER).count() == 0


# ------------------------------------------------------------------ 3
@pytest.mark.parametrize("byte_pieces", [True, False])
def test_unigram_counts_are_the_tokenizers(edge, empty, byte_pieces):
    from tokenizers import Tokenizer, models, pre_tokenizers
    vocabulary = [p for p in unigram.read_vocabulary(data.UNIGRAM) if byte_pieces or not p[0].startswith("<0x")]
    t = Tokenizer(models.Unigram([(p, x or 0.0) for p, x in vocabulary], unk_id=0, byte_fallback=byte_pieces))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    got = unigram.count_tokens(edge, vocabulary).collect()
    want = [(r.doc_id, len(t.encode(r.text or "", add_special_tokens=False).ids)) for r in edge.collect()]
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=repr) == sorted(want, key=repr)
    assert unigram.count_tokens(empty, vocabulary).count() == 0


def test_unigram_names_of_special_pieces_are_text(spark):
    vocabulary = unigram.read_vocabulary(data.UNIGRAM)
    assert {p for p, s in vocabulary if s is None} >= {"<unk>", "<s>", "</s>", "<0x41>"}
    docs = data.plain(spark, enumerate(["<s>", "</s>", "<unk>", "<0x41>"]))
    assert all(r.n_tokens > 2 for r in unigram.count_tokens(docs, vocabulary).collect())


def test_unigram_ties_take_the_longest_last_piece():
    c = unigram.Counter([("<unk>", 0.0), ("▁a", -1.0), ("b", -1.0), ("c", -1.0), ("bc", -2.0), ("▁ab", -2.0)])
    # ▁ab|c and ▁a|bc score -3 like ▁a|b|c; the longest last piece is bc
    assert c.segment("▁abc") == (2, -3.0)


# ------------------------------------------------------------------ 4
@pytest.mark.parametrize("window", [50, 7, 1])
def test_repeats(spark, window):
    pairs = data.texts()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in repeats.remove_repeats(data.plain(spark, pairs), window).collect()}
    assert got == brute.repeats(pairs, window)


def test_repeats_more_levels(spark):
    pairs = data.texts()
    docs = data.plain(spark, pairs)
    rows = repeats._row_keys(docs, "doc_id", "text")
    seen = repeats._first_pass(rows, 50, 12)
    from pyspark.sql import functions as F
    part = seen.select(*repeats._KEY, F.explode(F.arrays_zip("hash", "at")).alias("s")).select(*repeats._KEY, "s.hash", "s.at")
    _, starts = repeats._levels(rows, part, 50, 12)  # 12, 24, 48, 50
    got = {r.id: set(r["at"]) for r in starts.collect()}
    first = {}
    for i, t in sorted(pairs):
        w = brute.words(t)
        for j in range(len(w) - 49):
            first.setdefault(tuple(w[j:j + 50]), i)
    want = {i: {j for j in range(len(brute.words(t)) - 49) if first[tuple(brute.words(t)[j:j + 50])] < i} for i, t in pairs}
    assert got == {i: s for i, s in want.items() if s}


def test_repeats_edges(edge, empty):
    got = repeats.remove_repeats(edge).collect()
    assert len(got) == edge.count()
    assert all(r.n_words == r.n_removed == 0 for r in got if r.doc_id in (200, 201))
    assert len({(r.n_removed, r.kept_sha256) for r in got if r.doc_id == 5}) == 1
    assert repeats.remove_repeats(empty).count() == 0


# ------------------------------------------------------------------ 5
def test_sharding(edge, empty):
    got = sharding.assign(edge, shards=4).collect()
    size = Counter()
    slots = {}
    for r in got:
        size[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in edge.collect()
                  if r.doc_id is not None)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == want
    shard_of = {}
    for r in got:
        assert shard_of.setdefault(r.text_crc32, r.shard) == r.shard
    assert sharding.assign(empty).count() == 0


def test_sharding_balances_and_splits_a_huge_group(spark):
    pairs = [(i, data.prose(i, 20 + i % 60)) for i in range(1500)] + [(2000 + i, "the same text " * 9) for i in range(900)]
    got = sharding.assign(data.plain(spark, pairs)).toPandas()
    size = got.groupby("shard")["size"].sum()
    assert len(size) == 16 and size.max() / size.mean() < 1.02 and size.min() / size.mean() > 0.98
    again = sharding.assign(data.plain(spark, pairs)).toPandas()
    assert got.sort_values("doc_id")["shard"].tolist() == again.sort_values("doc_id")["shard"].tolist()


# ------------------------------------------------------------------ 6
def test_statistics(edge):
    want = sorted(((r.doc_id, *brute.statistics(r.text)) for r in edge.collect()), key=repr)
    assert rows_of(outliers.quality(edge), "doc_id", *outliers.BASE, "base_failed") == want


def test_outliers_are_found_and_clean_documents_stay(spark, empty):
    pairs = [(i, data.prose(i, 80 + 3 * (i % 100))) for i in range(400)]
    junk = [(1000 + i, " ".join(w + "***$$" for w in data.prose(i, 120).split())) for i in range(20)]
    docs = data.plain(spark, pairs + junk)
    kept = {r.doc_id for r in outliers.quality(docs).collect() if r.kept}
    assert kept == {i for i, _ in pairs}
    assert {r.doc_id for r in outliers.keep(docs).collect()} == kept
    assert outliers.keep(docs).columns == docs.columns
    assert outliers.quality(empty).count() == 0 and outliers.keep(empty).count() == 0


def test_moderate_outliers_are_rejected(spark):
    """Menus, repeated words and repeated lines well inside the base rules."""
    clean = [(i, data.prose(i, 60 + 5 * (i % 80))) for i in range(300)]
    # one symbol for three words; a third of the words repeated; every second line of eight words repeated
    menu = [(1000 + i, " | ".join(data.prose(9000 + 60 * i + j, 3) for j in range(40))) for i in range(5)]
    again = [(2000 + i, " ".join([data.prose(7000 + i, 20)] * 2 + [data.prose(8000 + i, 80)])) for i in range(5)]
    lines = [(3000 + i, "\n".join([data.prose(5000 + 60 * i + j, 8) for j in range(12)] + ["home"] * 7)) for i in range(5)]
    got = {r.doc_id: r for r in outliers.quality(data.plain(spark, clean + menu + again + lines)).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {i for i, r in got.items() if i >= 1000 and r.kept} == set()
    assert sum(not r.kept for i, r in got.items() if i < 1000) <= 3


def test_small_sources_are_judged_by_themselves(spark):
    """A source of 40 texts with a shape of its own is kept, its outliers are not;
    the verdicts of a source do not turn with its hundredth text."""
    import random
    columns = ", ".join(f"{c} string" for c in ("lang", "source"))
    prose = [(i, data.prose(i, 100 + 5 * (i % 60)), "en", "web") for i in range(300)]
    table = [(1000 + i, " | ".join(data.prose(9000 + 60 * i + j, 3) for j in range(40)), "en", "tables") for i in range(40)]
    odd = [(2000 + i, " ".join(w * 4 for w in data.prose(i, 150).split()), "en", "tables") for i in range(2)]
    other = [(3000 + i, " ".join(random.Random(i).choices(["Donaudampfschiff", "Rindfleisch", "Satzung", "Wald"], k=4)[0] + w
                                 for w in data.prose(i, 150 + i).split()), "de", "recht") for i in range(60)]
    docs = spark.createDataFrame(prose + table + odd + other, f"doc_id long, text string, {columns}").repartition(3)
    lost = {r.doc_id for r in outliers.quality(docs).collect() if not r.kept and not r.base_failed}
    assert {2000, 2001} <= lost and len(lost) <= 4
    kept = []
    for n in (99, 100):
        part = spark.createDataFrame(prose + [(1000 + i, f"{t} {data.prose(i, 20 + i)}", "de", "small")
                                              for i, (_, t, *_) in enumerate((prose * 2)[:n])], f"doc_id long, text string, {columns}")
        kept.append({r.doc_id: r.distance for r in outliers.quality(part.repartition(3)).collect()})
    assert all(abs(kept[1][i] - d) < 0.2 * (1 + d) for i, d in kept[0].items())


def test_outliers_edges(edge):
    got = outliers.quality(edge).collect()
    assert len(got) == edge.count() and all(r.kept is not None for r in got)


def test_distances_are_mahalanobis(spark):
    """The estimate's steps repeated with numpy on one group."""
    pairs = [(i, data.prose(i, 60 + 5 * (i % 80))) for i in range(300)]
    got = outliers.quality(data.plain(spark, pairs)).toPandas()
    n = got.n_words.clip(lower=1)
    x = np.column_stack([np.log1p(got.n_words), np.log1p(got.word_chars / n), np.sqrt(got.n_symbols / n),
                         np.sqrt(got.n_dup_lines / n), np.sqrt(got.n_repeat_words / n)])
    used = ~got.base_failed.to_numpy()
    fit = x[used]
    floor, repeat = np.array(outliers.FLOOR), np.array(outliers.REPEAT)
    pct = lambda v, p: np.sort(v)[max(int(np.ceil(p * len(v))) - 1, 0)]  # noqa: E731  as percentile_approx
    med = np.array([pct(c, 0.5) for c in fit.T])
    mad = np.array([pct(np.abs(c - m), 0.5) for c, m in zip(fit.T, med)])
    robust = ((fit - med) / np.maximum(1.4826 * mad, floor)) ** 2
    plain = ((fit - fit.mean(axis=0)) / np.maximum(fit.std(axis=0), floor)) ** 2
    q = outliers.chi2_quantile(outliers.CORE, 5)
    factor = outliers.CORE / outliers.chi2_cdf(q, 7)

    def steps(d2, times):
        for _ in range(times):
            core = fit[d2 <= pct(d2, outliers.CORE)]
            cov = np.cov(core.T, bias=True) * factor + np.diag(floor ** 2) + np.outer(repeat, repeat)
            diff = fit - core.mean(axis=0)
            d2 = (diff @ np.linalg.inv(cov) * diff).sum(axis=1)
        return np.linalg.slogdet(cov)[1], d2

    found = [steps(d2, outliers.TRIAL) for d2 in (robust.sum(axis=1), plain.sum(axis=1), robust[:, :2].sum(axis=1))]
    best = steps(min(found, key=lambda f: f[0])[1], outliers.STEPS + 1 - outliers.TRIAL)
    assert np.allclose(np.sort(got.distance[used]), np.sort(best[1]), rtol=0.02, atol=0.02)


def test_inverse_and_determinant(spark):
    rng = np.random.default_rng(5)
    ms = [m @ m.T + np.eye(5) for m in rng.normal(size=(20, 5, 5))]
    df = spark.createDataFrame([(i, m.ravel().tolist()) for i, m in enumerate(ms)], "i int, m array<double>")
    for r in df.select("i", outliers._inverted(F.col("m")).alias("s")).collect():
        assert np.allclose(np.reshape(r.s.inverse, (5, 5)), np.linalg.inv(ms[r.i]))
        assert abs(r.s.logdet - np.linalg.slogdet(ms[r.i])[1]) < 1e-9


def test_one_repeated_line_is_kept(spark):
    """Texts of 50 to 100 words with one line of eight words twice, beside clean ones."""
    clean = [(i, data.prose(i, 50 + i % 200)) for i in range(400)]
    line = [(1000 + i, "\n".join([data.prose(4000 + i, 8), data.prose(i, 34 + i), data.prose(4000 + i, 8)])) for i in range(50)]
    got = outliers.quality(data.plain(spark, clean + line)).collect()
    assert all(r.n_dup_lines == 1 and 50 <= r.n_words < 100 for r in got if r.doc_id >= 1000)
    assert all(r.kept for r in got if r.doc_id >= 1000)
    assert sum(not r.kept and not r.base_failed for r in got) <= 2


def test_chi_square():
    assert abs(outliers.chi2_quantile(0.95, 5) - 11.0705) < 1e-3
    assert abs(outliers.chi2_cdf(6.6257, 5) - 0.75) < 1e-3


# ------------------------------------------------------------------ 7
VALUES = ["1234 5678 9012 3456", "4111111111111111", "4111-1111-1111-1111", "+1 (017) 555-7713", "415-555-1234", "555-7713",
          "ab.Cd7@mail.example.com", "04dbebab91ab85687d33eeaaf9ac699e1188f962", "97.51.17.173", "2024-02-29", "1999/12/31",
          "31.12.1999", "0001-01-01", "123-45-6789"]


def test_pseudonyms_are_permutations_within_the_format(spark):
    import datetime
    import re
    docs = data.plain(spark, [(i, f"x {v} y, {v}!") for i, v in enumerate(VALUES)])
    out = pii.pseudonymised(docs, "key")
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    for i, v in enumerate(VALUES):
        a, b = re.fullmatch(r"x (.*) y, (.*)!", got[i]).groups()
        assert a == b and a != v
        if "." not in v or "@" in v:
            shape = lambda s: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "9", s))) if len(s) != 40 else 40
            assert shape(a) == shape(v)
    card = lambda s: re.sub("[^0-9]", "", s)
    assert brute.luhn(card(VALUES[1])) and brute.luhn(got[1].split()[1])
    assert card(got[1].split()[1]) == card(got[2].split()[1])  # linked across layouts
    assert brute.luhn(card(VALUES[0])) == brute.luhn(card(got[0])[:16])
    datetime.date.fromisoformat(got[9].split()[1])
    assert all(int(o) < 256 for o in got[8].split()[1].split("."))
    assert {r.doc_id: r.text for r in pii.pseudonymised(out, "key", inverse=True).collect()} == {
        r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.text for r in pii.pseudonymised(docs, "other").collect()} != got


def test_pseudonyms_are_injective(spark):
    dates = [f"{1990 + n // 336}-{n // 28 % 12 + 1:02d}-{n % 28 + 1:02d}" for n in range(2000)]
    cards = [f"{4000000000000000 + 7919 * n}" for n in range(1000)]
    docs = data.plain(spark, list(enumerate(dates + cards)))
    got = [r.text for r in pii.pseudonymised(docs, "key").collect()]
    assert len(set(got)) == len(dates) + len(cards)


def test_pseudonyms_leave_the_rest_alone(spark, edge, empty):
    plain = ["2024-02-30", "13/13/1999", "no value", "", "v1.2.3", "12", "300.1.1.1", None, "1234567"]
    docs = data.plain(spark, list(enumerate(plain)))
    assert [r.text for r in pii.pseudonymised(docs, "key").orderBy("doc_id").collect()] == plain
    assert rows_of(pii.pseudonymised(edge, "key"), "doc_id", "text") == rows_of(edge, "doc_id", "text")
    assert pii.pseudonymised(empty, "key").count() == 0


ADJACENT = [("+1 (826) 555-4081", "190.137.223.204"), ("+1 (826) 555-4081", "4111 1111 1111 1111"), ("+49 30 1234567", "190.137.223.204"),
            ("+49 30 1234567", "4111 1111 1111 1111"), ("+49 30 1234567", "1999-12-31"), ("+44 20 7946 0958", "123-45-6789"),
            ("4111 1111 1111 1111", "123-45-6789"), ("4111111111111111", "190.137.223.204"), ("4111 1111 1111 1111", "4222 2222 2222 2222"),
            ("190.137.223.204", "+1 (826) 555-4081"), ("31.12.1999", "4111-1111-1111-1111"), ("555-7713", "190.137.223.204"),
            ("123-45-6789", "4111111111111111"), ("ab@mail.example.com", "+1 (826) 555-4081")]


def test_adjacent_values_stay_apart(spark):
    docs = data.plain(spark, [(i, f"x {a} {b}!") for i, (a, b) in enumerate(ADJACENT)])
    got = {r.doc_id: r.v for r in docs.select("doc_id", pii.values(docs["text"]).alias("v")).collect()}
    assert [tuple(got[i]) for i in range(len(ADJACENT))] == ADJACENT
    alone = data.plain(spark, [(0, "+1 (826) 555-4081"), (1, "+1 (826) 555-4081 2024"), (2, "+1 (826) 555-4081 12"), (3, "+49 30 1234567"),
                               (4, "+49 30 1234567 2024")])
    got = {r.doc_id: r.text for r in pii.pseudonymised(alone, "key").collect()}
    assert got[1] == got[0] + " 2024" and got[2] == got[0] + " 12" and got[4] == got[3] + " 2024"


def test_dates_and_secrets_of_every_layout(spark):
    import datetime
    import re
    dates = ["03/25/1999", "3/25/1999", "3/5/1999", "25/3/1999", "1999-3-5", "5.3.1999"]
    hexa = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    values = dates + [hexa * 2, (hexa * 4).upper(), hexa[:20] + hexa[20:].upper()] + [f"{n % 9 + 1}/{n % 16 + 13}/{1900 + n // 4}" for n in range(400)]
    docs = data.plain(spark, list(enumerate(values)))
    out = pii.pseudonymised(docs, "key")
    got = [r.text for r in out.orderBy("doc_id").collect()]
    shape = lambda s: re.sub("[A-F]", "A", re.sub("[a-f]", "a", re.sub("[0-9]", "9", s)))
    assert all(a != b and len(a) == len(b) for a, b in zip(got, values)) and len(set(got)) == len(set(values))
    assert [shape(v) for v in got[:6]] == [shape(v) for v in dates] and shape(got[8]) == shape(values[8])
    for v in got[:2] + got[9:]:
        datetime.datetime.strptime(v, "%m/%d/%Y")
    assert [r.text for r in pii.pseudonymised(out, "key", inverse=True).orderBy("doc_id").collect()] == values


# ------------------------------------------------------------------ 8
def test_base_scores(spark):
    pairs = data.texts()
    got = {r.doc_id: r for r in suffix_tree.scores(data.plain(spark, pairs)).collect()}
    for i, (held, n, known, total, base) in brute.base_scores(pairs).items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))


def _grown(pairs, held):
    """The tree in plain Python: (symbol of a word, retained contexts, P(symbol | context))."""
    import math
    texts = {i: brute.words(brute.lower(t)) for i, t in pairs}
    seen = Counter(x for i, t in texts.items() if not held[i] for x in t)
    n_train = sum(not h for h in held.values())
    total = sum(seen.values()) + n_train
    mass = total + 0.1 * (len(seen) + 2)
    head = {x for x, n in seen.items() if n >= max(suffix_tree.HEAD_SHARE * total, 1)}
    root = {x: (seen[x] + 0.1) / mass for x in head} | {"<end>": (n_train + 0.1) / mass}
    root["<rare>"] = 1 - sum(root.values())
    symbols = {i: [x if x in head else "<rare>" for x in t] + ["<end>"] for i, t in texts.items()}
    count = {}

    def add(ctx, x):
        count.setdefault(ctx, Counter())[x] += 1

    def each(length):
        for i, t in symbols.items():
            padded = ["<end>", *t]
            for at in range(length, len(padded)):
                ctx = tuple(padded[at - length:at])
                if not held[i] and "<rare>" not in ctx:
                    yield ctx, padded[at]

    for ctx, x in each(1):
        add(ctx, x)
    hot = max(suffix_tree.HOT_SHARE * total, suffix_tree.MIN_COUNT)
    for ctx, x in each(2):
        if count[ctx[:1]][ctx[1]] >= hot:
            add(ctx, x)

    def p(ctx, x):
        if not ctx:
            return root[x]
        n, w = sum(count[ctx].values()), suffix_tree.SMOOTHING
        once = sum(m == 1 for m in count[ctx].values())
        own = count[ctx][x]
        return (own if own > 1 else 0) / (n + w) + (w + once) / (n + w) * p(ctx[1:], x)

    retained = set()
    for ctx, after in count.items():
        n, w = sum(after.values()), suffix_tree.SMOOTHING
        if n >= suffix_tree.MIN_COUNT:
            once = sum(m == 1 for m in after.values())
            kl = sum(m * math.log(p(ctx, x) / p(ctx[1:], x)) for x, m in after.items() if m > 1)
            if kl + once * math.log((w + once) / (n + w)) >= suffix_tree.MIN_DIVERGENCE * n:
                retained |= {ctx, ctx[-1:]}
    return symbols, retained, root, p


@pytest.mark.parametrize("head, hot", [(5e-7, 5e-7), (2e-3, 5e-4)])
def test_tree_scores_by_definition(spark, head, hot, monkeypatch):
    """Grown and scored by plain Python on the same symbols."""
    import math
    monkeypatch.setattr(suffix_tree, "HEAD_SHARE", head)
    monkeypatch.setattr(suffix_tree, "HOT_SHARE", hot)
    pairs = data.texts()
    got = {r.doc_id: r for r in suffix_tree.scores(data.plain(spark, pairs)).collect()}
    base = brute.base_scores(pairs)
    symbols, retained, root, p = _grown(pairs, {i: h for i, (h, *_) in base.items()})
    assert {len(c) for c in retained} == {1, 2}
    for ctx in list(retained)[:20]:  # distributions
        assert abs(sum(p(ctx, x) for x in root) - 1) < 1e-9
    for i, t in symbols.items():
        padded, want = ["<end>", *t], base[i][4]
        for at in range(1, len(padded)):
            ctx = tuple(padded[max(at - 2, 0):at])
            while ctx and ctx not in retained:
                ctx = ctx[1:]
            want += math.log10(p(ctx, padded[at]) / root[padded[at]])
        assert abs(got[i].score - want) < 1e-6 * max(1, abs(want)), i
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())


def test_tree_grows_with_the_corpus(spark):
    """No share of the corpus bounds its edges, and unseen documents gain by them."""
    from stratum.llm.store import stored
    edges = []
    for sf in ("sf0.001", "sf0.01"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        kept = []
        monkey = pytest.MonkeyPatch()
        monkey.setattr(suffix_tree, "stored", lambda df, name, *a: kept.append((name, stored(df, name, *a))) or kept[-1][1])
        try:
            scored = suffix_tree.scores(docs).filter("held_out").agg({"score": "sum", "base_score": "sum"}).first()
        finally:
            monkey.undo()
        edges.append(next(df for name, df in kept if name == "tree").count())
    assert edges[1] > 4 * edges[0] > 0
    assert scored["sum(score)"] > 0.95 * scored["sum(base_score)"]  # 5 % nearer to zero


def test_scores_edges(spark, edge, empty):
    got = suffix_tree.scores(edge).collect()
    assert len(got) == edge.count()
    assert all(r.n_tokens == 1 and np.isfinite(r.score) for r in got if r.doc_id in (200, 201, 100))
    assert suffix_tree.scores(empty).count() == 0
    only_held_out = data.plain(spark, [(next(i for i in range(99) if zlib.crc32(str(i).encode()) % 10 == 0), "a b")])
    r = suffix_tree.scores(only_held_out).first()
    assert r.train_tokens == 0 and r.n_known == 0 and r.score == r.base_score == 0


def test_tree_leaves_little_on_disk(spark):
    """Steps that are stored leave no shuffle files, and no edge seen once is stored."""
    import time
    from stratum.llm.store import stored

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in files.split("\n") if "shuffle_" in f and f.endswith(".data")}

    kept, before = [], shuffled()
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    as_set = spark.conf.get(setting)
    monkey = pytest.MonkeyPatch()
    monkey.setattr(suffix_tree, "stored", lambda df, name, *a: kept.append((name, stored(df, name, *a))) or kept[-1][1])
    try:
        suffix_tree.scores(data.plain(spark, data.texts()))
    finally:
        monkey.undo()
    for _ in range(50):  # files are removed in the background
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(setting) == as_set
    for name in ("pairs", "triples"):
        least = next(df for n, df in kept if n == name).agg({"n": "min"}).first()[0]
        assert least > 1


@pytest.mark.parametrize("size", [0, 1, 2, 5, 5000])
def test_index_finds_what_it_holds(size):
    rng = np.random.default_rng(size)
    keys = rng.integers(-1 << 63, (1 << 63) - 1, size)
    keys[:2] = (-1, 0)[:size]
    index, order = suffix_tree.Index.of(keys)
    wanted = np.concatenate([keys, rng.integers(-1 << 63, (1 << 63) - 1, 3000), np.arange(-5, 5)])
    at, found = index.find(wanted)
    assert (found == np.isin(wanted, keys)).all()
    assert (keys[order][at[found]] == wanted[found]).all()


# ------------------------------------------------------------------ 9
ITEMS = [(1, data.prose(1, 30)), (2, "short item"), (3, None), (4, ""), (1, data.prose(1, 30)), (None, data.prose(100, 12)),
         (5, "!!"), (6, "one"), (7, data.prose(1, 30).upper())]


@pytest.mark.parametrize("limit", [100_000, 15])
def test_decontamination(spark, edge, empty, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_AUTOMATON_WORDS", limit)  # 15: several automata
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute.contamination([(n, r.text) for n, r in enumerate(edge.collect())], ITEMS)
    got = decontaminate.contamination(edge, items)
    assert rows_of(got, "n_words", "n_hit", "items") == sorted(want.values(), key=repr)
    assert any(h for _, h, _ in want.values())
    out = decontaminate.remove(edge, items)
    assert out.columns == edge.columns and out.count() == edge.count()
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[200] is None and "".join(texts[102].split()) == ""  # the text "one"
    before = {r.doc_id: r.text for r in edge.collect()}
    for r in got.collect():
        if r.doc_id is not None and r.doc_id < 60:
            left = len(brute.ITEM_WORD.findall(texts[r.doc_id]))
            assert left == r.n_words - r.n_hit
            assert r.n_hit or texts[r.doc_id] == before[r.doc_id]
    assert decontaminate.contamination(empty, items).count() == 0
    assert decontaminate.contamination(edge, items.limit(0)).agg({"n_hit": "sum"}).first()[0] == 0
    assert rows_of(decontaminate.remove(edge, items.limit(0)), "text") == rows_of(edge, "text")


# ----------------------------------------------------------------- 10
def test_classifier_learns_and_holds_out(spark, empty):
    good = [(i, data.prose(i, 60)) for i in range(300)]
    bad = [(1000 + i, data.prose(i, 50) + " " + "junk spam " * 5) for i in range(100)]
    docs = data.plain(spark, good + bad + [(5000, ""), (5001, None)])
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(9999, 1, 0), (1, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in nbsvm.quality_scores(docs, labels).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [r for i, r in got.items() if r.held_out and i < 5000]
    assert sum((r.predicted == 1) == (r.doc_id < 1000) for r in held) >= 0.95 * len(held)
    # labels of held-out rows have no influence
    flipped = labels.rdd.map(lambda r: (r.doc_id, 1 - r.quality if r.quality is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
                                        else r.quality, r.toxic)).toDF(labels.schema)
    again = {r.doc_id: r.score for r in nbsvm.quality_scores(docs, flipped).collect()}
    assert all(abs(again[i] - r.score) < 1e-12 for i, r in got.items())
    assert nbsvm.quality_scores(empty, labels).count() == 0


def test_classifier_without_labels(spark, edge):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in nbsvm.quality_scores(edge, none).collect()} == {0.5}
    one = spark.createDataFrame([(n, 1) for n in range(20)], "doc_id long, quality int")
    scores = {r.score for r in nbsvm.quality_scores(edge, one).collect()}
    assert len(scores) == 1 and 0.5 < scores.pop() < 1


def test_dual_descent_solves_the_hinge_problem():
    """No step along a coordinate of the dual improves its value."""
    rng = np.random.default_rng(3)
    n, d = 60, 8
    x = rng.normal(size=(n, d))
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=n) > 0, 1.0, -1.0)
    indptr, index = np.arange(0, n * d + 1, d), np.tile(np.arange(d), n)
    w, b = nbsvm.dual_descent(indptr, index, x.ravel(), y)
    loss = lambda w, b: 0.5 * (w @ w + b * b) + (np.where(y > 0, 0.5 / (y > 0).mean(), 0.5 / (y < 0).mean())
                                                 * np.maximum(0, 1 - y * (x @ w + b))).sum() * nbsvm.C
    best = brute.hinge_optimum(x, y, nbsvm.C * np.where(y > 0, 0.5 / (y > 0).mean(), 0.5 / (y < 0).mean()))
    assert abs(loss(w[:d], b) - best) < 1e-3 * best
    for _ in range(200):
        assert loss(w[:d] + rng.normal(size=d) * 0.02, b + rng.normal() * 0.02) > best - 1e-3


def test_foreign_labels_and_long_texts(spark, monkeypatch):
    """Labels of unknown documents do not move a score; a long text is part of the fit."""
    monkeypatch.setattr(nbsvm, "MAX_FIT", 300)
    good = [(i, data.prose(i, 40)) for i in range(300)]
    bad = [(1000 + i, data.prose(i, 40) + " " + "junk spam " * 4) for i in range(100)]
    huge = [(2000, " ".join(f"w{n}" for n in range(90_000)))]  # more n-grams than the old bound
    docs = data.plain(spark, good + bad + huge)
    known = [(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad + huge]
    labels = spark.createDataFrame(known, "doc_id long, quality int")
    foreign = spark.range(5000, 45000).selectExpr("id AS doc_id", "int(id % 2) AS quality")
    one = {r.doc_id: r.score for r in nbsvm.quality_scores(docs, labels).collect()}
    two = {r.doc_id: r.score for r in nbsvm.quality_scores(docs, labels.union(foreign)).collect()}
    assert all(abs(one[i] - s) < 1e-9 for i, s in two.items())
    held = [i for i in one if zlib.crc32(str(i).encode()) % 5 == 0 and i < 2000]
    assert sum((one[i] >= 0.3) == (i < 1000) for i in held) >= 0.95 * len(held)


def test_classifier_repeated_and_conflicting_ids(spark):
    """A repeated id is as many rows; an id labelled 0 and 1 counts for both classes."""
    rows = [(i % 60, data.prose(i % 60, 30) + (" junk" * 6 if i % 60 > 40 else "")) for i in range(120)] + [(None, "x"), (77, None)]
    labels = spark.createDataFrame([(i, int(i <= 40)) for i in range(60)] + [(3, 0), (3, 1), (None, 1), (5, None)], "doc_id long, quality int")
    got = nbsvm.quality_scores(data.plain(spark, rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(round(r.score, 12))
    assert all(len(s) == 1 for s in by_id.values())
