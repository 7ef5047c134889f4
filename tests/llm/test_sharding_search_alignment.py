"""Sharding, ranked search and alignment, against plain versions and on the odd cases."""

import random
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
import texts

from tallycube.llm import alignment, ranked, sharding

DOCS = texts.documents()
NAMES = "doc_id long, text string, shard string, Slot int, `n_a` string, rank int, score long, chunk int, part int, `odd``name` int"


def key(row):
    return tuple((v is not None, v) for v in row)


def extra(rows):
    return [(d, t, "s", 1, "a", 2, 3, 4, 5, 6) for d, t in rows]


# 11 sharding


def placed(df):
    return sorted((tuple(r) for r in df.select("doc_id", "size", "text_crc32", "shard", "slot", "grown_shard").collect()), key=key)


def test_shards_are_those_of_the_plain_version(table):
    rows = [*DOCS, (None, "a"), (None, None), (None, "a"), (7, "other"), (7, "other"), (-5, "b")] + [(1000 + k, f"t{k}") for k in range(500)]
    for weights in ((1.0,) * 16, (1.0, 0.0, 2.5), (3.0,)):
        got = placed(sharding.place(table(rows), weights, 2.0))
        assert got == sorted(brute.sharded(rows, weights, 2.0), key=key)


def test_one_more_shard_takes_rows_only_into_itself(table):
    rows = [(k, None) for k in range(2000)]
    got = sharding.place(table(rows), (1.0, 2.0, 1.0), 4.0).select("doc_id", "shard", "grown_shard").collect()
    assert {r.grown_shard for r in got if r.grown_shard != r.shard} == {3}
    counts = Counter(r.grown_shard for r in got)
    assert all(abs(counts[k] - 250 * w) < 130 for k, w in enumerate((1, 2, 1, 4)))
    later = sharding.place(table(rows[:50]), (1.0, 2.0, 1.0, 4.0)).select("doc_id", "shard").collect()
    of = {r.doc_id: r.grown_shard for r in got}
    assert all(of[r.doc_id] == r.shard for r in later)


def test_many_equal_rows_get_a_slot_each(llm):
    df = llm.range(4500).selectExpr("if(id < 3500, 1L, id) as doc_id", "'same' as text")
    got = sharding.place(df).select("shard", "slot").collect()
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert len(got) == 4500 and all(sorted(s) == list(range(len(s))) for s in by.values())


def test_sharding_of_odd_tables(table):
    df = sharding.place(table(extra(DOCS[:5]), NAMES))
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"] and df.count() == 5
    assert placed(df) == sorted(brute.sharded(DOCS[:5], (1.0,) * 16), key=key)
    assert sharding.place(table([])).count() == 0
    with pytest.raises(ValueError):
        sharding.place(table([]), (0.0,))


# 12 ranked search


def answers(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=key)


def items_of(docs, n=12):
    rng = random.Random(4)
    picked = [" ".join(rng.sample(t.split(), min(9, len(t.split())))) for _, t in docs if t and len(t.split()) > 3]
    return [(k, t) for k, t in enumerate(picked[:n])]


ITEMS = [*items_of(DOCS), (50, None), (51, ""), (52, "nowhere-word"), (53, "the THE the river"), (53, "the THE the river"), (None, "stone motion"), (54, "İSTANBUL ſtrasse x_y")]


def test_ranks_are_those_of_the_plain_version(table):
    docs = [*DOCS, (None, DOCS[0][1]), (3, DOCS[0][1]), (3, DOCS[0][1])]
    got = answers(ranked.search(table(docs), table(ITEMS, "item_id long, text string")))
    assert got == sorted(brute.ranked(docs, ITEMS), key=key)


def test_queries_in_blocks_and_buckets_in_parts_change_nothing(table, monkeypatch):
    want = sorted(brute.ranked(DOCS, ITEMS, 3), key=key)
    for name, value in {"BLOCK_BYTES": 150, "FIRST_DOCS": 4, "IN_BUCKET": 3, "PER_TASK": 5, "RATIO": 1.05}.items():
        monkeypatch.setattr(ranked, name, value)
    assert answers(ranked.search(table(DOCS), table(ITEMS, "item_id long, text string"), best=3)) == want


def test_bounds_leave_most_documents_unscored():
    rng = np.random.default_rng(1)
    n, v = 3000, 400
    usual = 1 / np.arange(1, v + 1)
    term = [np.sort(rng.choice(v, 30, replace=False, p=usual / usual.sum())) for _ in range(n)]
    times = [rng.integers(1, 5, 30).astype("<u4") for _ in range(n)]
    df = np.bincount(np.concatenate(term), minlength=v)
    corpus = ranked.Corpus(n, n * 200, np.array([ranked.term_weight(n, int(x)) for x in df], np.int64))
    picked = [term[k] for k in rng.choice(n, 20, replace=False)]
    queries = ranked.Queries(["q"] * 20, np.arange(v, dtype=np.uint64), picked, [np.ones(30, np.int64)] * 20)
    rows = ranked.rows_of(list(range(n)), np.full(n, 200), [t.astype("<u4").tobytes() for t in term], [t.tobytes() for t in times], corpus)
    first = ranked.Search(queries, corpus, np.zeros(20, np.int64), 20)
    first.add(rows)
    scored = []
    again = ranked.Search(queries, corpus, first.threshold, 20)
    whole = again._scores
    again._scores = lambda q, r, some: scored.append(len(some)) or whole(q, r, some)
    again.add(rows)
    assert sum(scored) < 0.2 * 20 * n
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(first.kept, again.kept, strict=True))


def test_search_of_odd_tables(table):
    schema = "item_id string, text string, score long, `h` int, rank string, query_text string"
    items = [("x", "river stone", 1, 2, "r", "q")]
    got = answers(ranked.search(table(extra(DOCS[:6]), NAMES), table(items, schema)))
    assert got == sorted(brute.ranked(DOCS[:6], [("x", "river stone")]), key=key)
    empty = table([], "item_id long, text string")
    assert ranked.search(table(DOCS), empty).count() == 0
    assert ranked.search(table([]), table(ITEMS, "item_id long, text string")).count() == 0
    assert ranked.search(table([(1, None), (2, "...")]), table(ITEMS, "item_id long, text string")).count() == 0


# 13 alignment


@pytest.fixture(scope="module")
def paths():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def whole(paths):
    """Both tokenizers on whole texts, with the bytes of each token."""
    both = alignment.Codecs(*paths)
    a = lambda t: [(i, both.bytes_a[i]) for i in both.a.encode(" " + t, add_special_tokens=False).ids]
    b = lambda t: [(i, both.bytes_b[i]) for i in both.b.encode(t)]
    return a, b


ODD = [
    "  two  spaces  inside   and behind  ",
    " ",
    "    ",
    "it's I'LL  they've 's 'S  'd",
    "a b c  d 　e   f",
    "ein schöner ñandú ción é á , über über",
    "x<|endoftext|> y <s> z </s> <0x41> <unk>",
    "a▁b ▁c",
    "😀👍🏽 日本語 中文 👍🏽",
    "tab\tand\nline \n next\r\n  end\n",
    "ﬁ ½ ² Å é ​ x",
    "\x00 a\x00b \x7f \x1c z",
    "=" * 300 + " " * 70 + "-" * 40,
    "12345678901234567890 3.14159 1,000,000",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa aaaa aaaa aaaa",
]
ALIGN_DOCS = [*DOCS, *[(200 + k, t) for k, t in enumerate(ODD)], (300, ODD[3]), (300, ODD[3]), (None, ODD[5])]


def test_alignment_is_that_of_the_plain_version(table, paths, whole):
    want, pairs = brute.aligned(ALIGN_DOCS, *whole)
    got = alignment.align(table(ALIGN_DOCS).repartition(5), *paths)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    counts = alignment.pair_counts(table(ALIGN_DOCS), *paths).collect()
    assert {(r.a, r.b): (r.docs, r.links) for r in counts} == pairs


def test_shares_and_flushes_change_nothing(table, paths, whole, monkeypatch):
    want, _ = brute.aligned(DOCS, *whole)
    for name, value in {"BYTES_PER_TASK": 30_000, "SLICE": 4_000}.items():
        monkeypatch.setattr(alignment, name, value)
    got = alignment.align(table(DOCS).repartition(3), *paths)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_counts_told_in_parts_add_up(monkeypatch):
    monkeypatch.setattr(alignment, "PAIRS_HELD", 40)
    rng = np.random.default_rng(3)
    rows, want = [], Counter()
    for _ in range(8):
        pairs = np.unique(rng.integers(0, 200, 25)).astype(np.uint64)
        n = rng.integers(1, 9, len(pairs))
        docs = np.concatenate([np.sort(rng.choice(40, x, replace=False)) for x in n])
        rows.append((40, *alignment.pack(alignment.Postings(pairs, n, docs, np.ones(len(docs), np.int64)), 40)))
        want.update(dict(zip(pairs.tolist(), n.tolist(), strict=True)))
    batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows]) for k in range(6)], ["size", "pairs", "counts", "lists", "bits", "planes"])
    got = Counter()
    for b in alignment._count(iter([batch])):
        got.update(dict(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)))
    assert got == want


def test_bitmaps_come_back_as_they_were():
    rng = np.random.default_rng(2)
    for size in (1, 7, 500, 65535):
        n = np.minimum(rng.integers(1, 60, 30), size)
        n[:3] = size
        docs = np.concatenate([np.sort(rng.choice(size, x, replace=False)) for x in n])
        p = alignment.Postings(np.arange(30, dtype=np.uint64), n, docs, rng.integers(1, 1000, len(docs)))
        back = alignment.unpack(alignment.pack(p, size), size)
        assert all((x == y).all() for x, y in zip(p, back, strict=True))


def test_alignment_of_odd_tables(table, paths, whole):
    want, _ = brute.aligned(DOCS[:9], *whole)
    got = alignment.align(table(extra(DOCS[:9]), NAMES), *paths)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    assert alignment.align(table([]), *paths).count() == 0
    none = alignment.align(table([(1, None), (2, ""), (3, "a▁b")]), *paths).collect()
    assert [tuple(r) for r in sorted(none)] == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2, 3)]
