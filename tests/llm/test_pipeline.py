"""Each stage of the corpus pipeline against brute force, on a small fixture, and all of them together."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
pytest.importorskip("public_tokenizers")

from tests.llm.test_operators import brute_components, brute_substrings, frame, near_copies, toxic_corpus  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows, labels = toxic_corpus()
    rng = random.Random(3)
    passage = " ".join(f"p{rng.randrange(900)}" for _ in range(60))
    rows += [(2000 + k, t) for k, t in enumerate(near_copies(9, 90, 25, 2))]
    rows += [(3000 + k, " ".join(f"q{rng.randrange(10**6)}" for _ in range(40)) + " " + passage) for k in range(6)]
    rows += [(4000, None), (4001, ""), (4002, passage)]
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def rows_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 4
    out = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, folder)
        path = f"{folder}/out-{k}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = (before, docs)
        if k < 3:
            assert docs.columns == COLUMNS

    before, after = out["toxicity"]
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    gone = set(rows_of(before)) - set(rows_of(after))
    assert sum(truth.get(i, 0) for i in gone) >= 0.9 * sum(truth.values())
    assert sum(1 - truth.get(i, 0) for i in gone) <= 0.02 * before.count()

    before, after = out["jaccard_join"]
    want = brute_components(list(rows_of(before).items()), 5, 80)
    assert set(rows_of(after)) == {i for i, (_, c) in want.items() if i == c}

    before, after = out["substring_dedup"]
    want = brute_substrings(list(rows_of(before).items()))
    texts = rows_of(before)
    assert rows_of(after) == {i: (w[3] if w[1] else texts[i]) for i, w in want.items() if not w[1] or w[1] < w[0]}
    assert all(r.n_chars == len(r.text or "") for r in after.collect()) and sum(w[1] > 0 for w in want.values()) >= 5

    before, after = out["best_fit_packing"]
    assert Counter(r.doc_id for r in after.where("piece = 0").collect()) == Counter(set(rows_of(before)))
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 1024

    whole = corpus_pipeline.run(spark, folder)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, whole.select(*columns).collect())) == Counter(map(tuple, after.select(*columns).collect()))


def test_stages_on_rows_without_ids_and_empty_tables(spark, folder):
    labels = f"{folder}/labels.parquet"
    assert spark.read.parquet(labels).count()
    odd = frame(spark, [(None, "no id here"), (1, None), (1, "again"), (2, "")], extra=True)
    empty = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES[:3]:
        assert not stage(spark, empty, folder).collect(), name
        got = stage(spark, odd, folder)
        assert got.columns == odd.columns and got.count() == 4, name
    assert not corpus_pipeline.STAGES[3][1](spark, empty, folder).collect()


def test_stages_decide_by_row(spark, folder):
    """Ids that repeat with other texts, rows without an id, copies of either, and ids above 2**53."""
    big = 2**53 + 1
    long = " ".join(f"z{k}" for k in range(60))
    near = long.replace("z7 ", "y ")
    rows = [(2, "aaa"), (2, "zzz entirely different text"), (big, long), (big + 1, near), (None, long), (None, "only here"), (2, "aaa"), (None, "q " + " ".join(f"z{k}" for k in range(20, 45)) + " r")]
    docs = frame(spark, rows, extra=True)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, folder).select("doc_id", "text").collect()
    assert Counter(map(tuple, kept)) == Counter([(2, "aaa"), (2, "zzz entirely different text"), (big, long), (None, "only here"), rows[-1]])
    cut = corpus_pipeline.drop_repeated_passages(spark, docs, folder)
    rest = {(None, "only here"): 1, (None, "q r"): 1, (2, "aaa"): 2, (2, "zzz entirely different text"): 1, (big, long): 1, (big + 1, " ".join(near.split()[:8])): 1}
    assert Counter(map(tuple, cut.select("doc_id", "text").collect())) == rest
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    toxic = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").where("text LIKE '%qwixx%'").limit(1).collect()]
    mixed = frame(spark, [(i, t) for i, t in rows_of(spark.read.parquet(f"{folder}/documents.parquet")).items()] + [(9001, toxic[0]), (9001, "clean words"), (None, toxic[0]), (None, "clean words")])
    left = corpus_pipeline.drop_toxic(spark, mixed, folder).where("doc_id IS NULL OR doc_id = 9001").collect()
    assert Counter((r.doc_id, r.text) for r in left) == Counter([(9001, "clean words"), (None, "clean words")])
