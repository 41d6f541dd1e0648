"""The pipeline stage by stage on the fixture, each against the stage's own rule."""

import pytest
from conftest import SF_DIR
from test_llm_decontaminate import brute as hits
from test_llm_jaccard import brute as near

import corpus_pipeline
from tallyroom.llm import bpe, quality, toxicity
from tallyroom.llm.catalog import default_tokenizer
from tallyroom.llm.common import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("steps")
    docs = table(spark, SF_DIR, "documents")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF_DIR).write.parquet(f"{base}/{i}")
        out.append(spark.read.parquet(f"{base}/{i}"))
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(steps):
    assert all(s.columns == COLUMNS for s in steps[:-1])


@pytest.mark.parametrize(("at", "module", "keep", "label"), [
    (0, quality, lambda s: s >= quality.THRESHOLD, "quality"),
    (1, toxicity, lambda s: s < toxicity.THRESHOLD, "toxic"),
])
def test_classifier_stages(spark, steps, at, module, keep, label):
    from pyspark.sql import functions as F

    labels = table(spark, SF_DIR, "labels").select("doc_id", F.col(label).alias("label"))
    # A stage learns from the labels of the documents that reach it.
    labels = labels.join(steps[at].select("doc_id"), "doc_id", "left_semi")
    scores = module.score(steps[at], module.fit(steps[at], labels)).collect()
    assert set(rows(steps[at + 1])) == {r["doc_id"] for r in scores if keep(r["score"])}


def test_near_duplicate_stage(steps):
    before = [(r["doc_id"], r["text"]) for r in steps[2].collect()]
    smallest = {label for _, _, label in near(before)}
    assert sorted(rows(steps[3])) == sorted(smallest)


def test_decontamination_stage(spark, steps):
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()]
    before, after = rows(steps[3]), rows(steps[4])
    hit = {d for d, _, h, _ in hits([(i, r["text"]) for i, r in before.items()], items) if h}
    assert not any(h for _, _, h, _ in hits([(i, r["text"]) for i, r in after.items()], items))
    assert set(before) - hit <= set(after)
    assert all(after[i] == before[i] for i in after if i not in hit)
    assert all(r["n_chars"] == len(r["text"]) for i, r in after.items() if i in hit)


def test_bpe_stage(steps):
    tokenizer = default_tokenizer()
    assert isinstance(tokenizer, bpe.Tokenizer)
    texts = rows(steps[4])
    assert {i: r["n_tokens"] for i, r in rows(steps[5]).items()} == {
        i: len(tokenizer.encode(r["text"])) for i, r in texts.items()
    }


def test_run_is_all_stages(spark, steps):
    made = sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()))
    assert made == sorted(map(tuple, steps[5].collect()))


def test_the_toxicity_stage_learns_from_labels_of_its_documents(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda docs, labels: seen.append(labels))
    docs = table(spark, SF_DIR, "documents").where("doc_id % 3 = 0")
    kept = corpus_pipeline.toxicity_filter(spark, docs, SF_DIR).count()
    labels = table(spark, SF_DIR, "labels")
    expected = {r["doc_id"] for r in labels.collect() if r["doc_id"] % 3 == 0}
    assert kept == docs.count() and 0 < len(expected) < labels.count()
    assert {r["doc_id"] for r in seen[0].collect()} == expected


def test_near_duplicates_with_columns_of_any_name(spark):
    text = "one two three four five six seven eight"
    rows = [(5, text, 1, 2, 3, 4), (5, text + " nine", 1, 2, 3, 5), (9, text, 1, 2, 3, 6), (None, None, 1, 2, 3, 7), (2, "", 1, 2, 3, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other int, ID int, rank int, label int")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert {r["label"] for r in kept.collect()} == {4, 7, 8}
    assert {r["ID"] for r in kept.collect()} == {2} and {r["other"] for r in kept.collect()} == {1}


ODD = [
    (None, None), (None, "no id"), (1, ""), (2, "word"), (2, "word"), (3, "long words " * 60_000), (4, "\x00 \u2028 <P>"),
]


@pytest.mark.parametrize("at", range(5))
def test_every_stage_takes_odd_rows(spark, tmp_path, at):
    """NULLs, empty and very long texts, repeated rows, and columns with names of the stages' own."""
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 7, 8, "x") for i, t in ODD], (
        "doc_id long, text string, lang string, source string, n_chars long, score int, SHARD int, ids string"
    ))
    made = corpus_pipeline.STAGES[at][1](spark, docs, SF_DIR)
    made.write.parquet(f"{tmp_path}/out")
    found = spark.read.parquet(f"{tmp_path}/out")
    assert found.columns == (docs.columns if at < 4 else ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    assert 0 < found.count() <= len(ODD)
    if at == 2:  # one of the two equal rows
        assert found.count() == len(ODD) - 1
