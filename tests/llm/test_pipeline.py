"""The pipeline's stages on a small corpus, each against a plain version of its decision."""

import brute
import pytest
import texts

import __spark_entry__ as contract
import corpus_pipeline
from tallycube.llm import decontaminate, near, pii, quality, toxicity
from tallycube.llm.queries import PSEUDONYM_KEY, QUERIES, SQL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(llm, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    base = texts.prose(1, 200)
    rows = [(k, texts.prose(100 + k, 120 + k)) for k in range(12)]
    rows += [(20, base), (21, base), (22, texts.edited(base, 5, 3)), (23, None), (24, ""), (25, "too short")]
    rows += [(30, texts.prose(50, 80) + " " + texts.prose(51, 14).replace("\n", " ") + " " + texts.prose(52, 80))]
    rows += [(31, texts.prose(60, 120) + " call +1 (988) 555-2485 or 70.123.182.155 since 1985-02-28")]
    rows += [(32, " ".join(["same words again"] * 60))]
    items = [(1, texts.prose(51, 14).replace("\n", " "))]
    docs = [(d, t, "en", "src0", len(t or "")) for d, t in rows]
    llm.createDataFrame(docs, SCHEMA).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    llm.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), dict(rows), items


def test_each_stage_in_turn(llm, corpus):
    folder, rows, items = corpus
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "jaccard_join", "benchmark_decontamination", "pii", "packing"]
    docs = llm.read.parquet(f"{folder}/documents.parquet")

    def run(name, docs):
        out = stages[name](llm, docs, folder)
        assert out.columns == docs.columns
        return out, {r.doc_id: r.text for r in out.collect()}

    docs, kept = run("quality_rules", docs)
    judged = {d for d, t in rows.items() if (c := brute.quality_counts(t))[0] >= 50 and 100 * c[4] <= 50 * c[0]}
    assert set(kept) == judged and {23, 24, 25, 32}.isdisjoint(kept)
    docs, single = run("jaccard_join", docs)
    assert set(single) == {d for d, _, c in brute.near_components(sorted(kept.items()), 5, 80) if d == c} and 21 not in single and 22 not in single
    docs, clean = run("benchmark_decontamination", docs)
    assert set(clean) == {d for d, _, h, _ in brute.hits(sorted(single.items()), items) if not h} and 30 not in clean
    docs, private = run("pii", docs)
    assert {d for d in private if private[d] != clean[d]} == {31}
    assert not any(v in private[31] for v in ("555-2485", "70.123.182.155", "1985-02-28"))
    pieces = stages["packing"](llm, docs, folder).collect()
    assert {p.doc_id for p in pieces} == set(private)
    assert all(sum(p.length for p in pieces if p.doc_id == d) == next(p.doc_tokens for p in pieces if p.doc_id == d) for d in private)


def test_run_applies_all_stages(llm, corpus):
    folder, _, _ = corpus
    out = corpus_pipeline.run(llm, folder)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns) and out.count() >= 13


def test_pipeline_of_an_empty_table(llm, tmp_path):
    llm.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    llm.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(llm, str(tmp_path)).count() == 0


def test_pipeline_keeps_clean_documents_of_other_columns(llm):
    docs = llm.createDataFrame([(1, texts.prose(3, 100), "en", "a", 1, "kept?")], SCHEMA + ", kept string")
    assert quality.judge(docs).filter("kept").count() == 1
    assert pii.pseudonymise(docs, PSEUDONYM_KEY).columns == [*docs.columns, "pii_kinds"]


def test_columns_named_like_an_output_keep_their_values(llm):
    row = (1, texts.prose(3, 100), "en", "a", 1, "kept?", -5, "none")
    docs = llm.createDataFrame([row], SCHEMA + ", kept string, N_words int, pii_kinds string")
    stages = dict(corpus_pipeline.STAGES)
    for name in ("quality_rules", "pii"):
        out = stages[name](llm, docs, "")
        assert out.columns == docs.columns and [tuple(r) for r in out.collect()] == [row]


def test_all_are_registered():
    names = set(contract.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)} and set(QUERIES) <= names and "pipeline" in names
    assert set(SQL) <= set(QUERIES)


INNER = "_id _hash _m _lang _of _found _score _raw _vector _features prediction probability rawPrediction id hash c0 n best first".split()


def test_columns_named_as_inside_an_operator_keep_their_values(llm):
    row = (1, texts.prose(3, 300), "en", "a", 1, *INNER)
    docs = llm.createDataFrame([row], SCHEMA + "".join(f", {c} string" for c in INNER))
    spelt = lambda df: [tuple(r) for r in df.select(*docs.columns).collect()]
    assert spelt(quality.judge(docs)) == [row] and spelt(pii.pseudonymise(docs, PSEUDONYM_KEY)) == [row]
    assert spelt(near.keep_one(docs, near.join_similar(docs, size=5, percent=80))) == [row]
    benchmark = llm.createDataFrame([(1, "nothing of the kind")], "item_id long, text string")
    assert spelt(decontaminate.clean_documents(docs, decontaminate.contamination(docs, benchmark))) == [row]
    labelled = llm.createDataFrame([(k, texts.prose(k, 40) + (" idiot" if k % 2 else "")) for k in range(60)], "doc_id long, text string")
    model = toxicity.fit(labelled, llm.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int"))
    assert model.trees is not None and spelt(model.score(docs)) == [row]


def test_exactly_one_row_of_a_component_stays(llm):
    a, b = texts.prose(1, 80), texts.prose(2, 80)
    rows = [(None, a), (None, a), (5, b), (5, b), (None, b), (7, texts.edited(b, 1, 1)), (8, ""), (None, None), (9, texts.prose(4, 80))]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    kept = near.keep_one(docs, near.join_similar(docs, size=5, percent=80)).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [(None, a), (5, b), (8, ""), (None, None), rows[-1]]))
