"""Classifiers by held-out accuracy, the pipeline stage by stage, and the registered queries against SQL."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check import compare, connect
from zoneflow.llm import decontaminate, pii, quality, queries, similarity, toxicity
from zoneflow.llm.text import table

NAMES = sorted(queries.QUERIES)


def auc(scores, labels):
    order = np.argsort(np.argsort(scores)) + 1
    ones = labels.sum()
    return (order[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(2)
    plain = [f"plain{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(800):
        bad = i % 5 == 0
        words = rng.choice(plain, 60).tolist()
        if bad:
            for at in rng.integers(0, 60, 4):
                words[at] = ["nasty", "vile", "awful"][at % 3]
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 7 != 0), int(bad)))
    for i, words in enumerate(docs):
        if i % 7 == 0:
            docs[i] = (i, " ".join(f"{w.upper()}%%%" for w in words[1].split()))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("score", "label"), [(toxicity.score_documents, "toxic"), (quality.score_quality, "quality")])
def test_held_out_rows_are_told_apart(labelled, score, label):
    docs, labels = labelled
    plain = docs.where("doc_id % 7 <> 0") if label == "toxic" else docs
    rows = score(plain, labels).join(labels, "doc_id").toPandas()
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows["doc_id"]]).all()
    held = rows[rows["held_out"]]
    assert auc(held["score"].to_numpy(), held[label].to_numpy()) > 0.97
    assert held["score"].between(0, 1).all()


@pytest.mark.parametrize("score", [toxicity.score_documents, quality.score_quality])
def test_scores_of_odd_rows_and_without_labels(spark, odd_documents, no_documents, labelled, score):
    _, labels = labelled
    assert score(odd_documents, labels).count() == odd_documents.count()
    assert score(no_documents, labels).count() == 0
    none = score(odd_documents, labels.limit(0)).select("score").distinct().collect()
    assert len(none) == 1 and 0 <= none[0][0] <= 1
    broken = labels.limit(5).withColumns({"toxic": F.lit(None).cast("int"), "quality": F.lit(None).cast("int")})
    assert score(odd_documents, broken).count() == odd_documents.count()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf_dir, con, name):
    df = queries.QUERIES[name](spark, sf_dir)
    if name in queries.ORACLES:
        problem = compare(df, con, queries.ORACLES[name])
        assert problem is None, problem
    else:
        assert df.count() >= table(spark, sf_dir, "documents").count()
    assert name in entry.queries()


def test_pipeline_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scores = toxicity.score_documents(docs, table(spark, sf_dir, "labels"))
    kept = corpus_pipeline.toxicity(spark, docs, sf_dir)
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(
        r["doc_id"] for r in scores.where("predicted = 0").select("doc_id").collect())
    single = corpus_pipeline.near_duplicates(spark, kept, sf_dir)
    groups = similarity.jaccard_components(kept, 5, 80)
    assert single.count() == groups.select("component_id").distinct().count()
    clean = corpus_pipeline.benchmark_passages(spark, single, sf_dir)
    assert decontaminate.contamination(clean, table(spark, sf_dir, "benchmark")).where("contaminated").count() == 0
    safe = corpus_pipeline.personal_data(spark, clean, sf_dir)
    assert not [r for r in safe.select("text").collect() if pii.base_spans(r["text"] or "")]
    for df in (kept, single, clean, safe):
        assert df.columns == docs.columns
        assert df.where("n_chars <> length(text)").count() == 0
    assert corpus_pipeline.run(spark, sf_dir).columns == corpus_pipeline.packing(spark, safe, sf_dir).columns


def test_pipeline_takes_odd_rows(spark, sf_dir, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns
            docs = out
        assert corpus_pipeline.packing(spark, docs, sf_dir).count() >= docs.count()


def plain_kneser_ney(rows):
    """Log-likelihood ratios of the words and bigrams of any text, from dictionaries of the counts of (words, label) rows."""
    n = [Counter(), Counter()]
    for own, label in rows:
        n[label].update(zip([None, *own], own, strict=False))
    both = n[0] + n[1]
    levels = [*n, both]
    types = [len(x) for x in levels]
    once, twice = ([sum(v == k for v in x.values()) for x in levels] for k in (1, 2))
    d = [min(0.95, max(0.1, a / max(1, a + 2 * b))) for a, b in zip(once, twice, strict=True)]
    follows = [Counter(w for _, w in x) for x in levels]
    opens, heads = [Counter(v for v, _ in x) for x in levels], [Counter() for _ in levels]
    for head, x in zip(heads, levels, strict=True):
        for (v, _), k in x.items():
            head[v] += k

    def alone(c, w):
        shared = (follows[2][w] + 1) / (types[2] + len(follows[2]) + 1)
        return (max(follows[c][w] - d[c], 0) + d[c] * len(follows[c]) * shared) / types[c]

    def pool(c, v, w):
        return (max(both[v, w] - d[2], 0) + d[2] * opens[2][v] * alone(c, w)) / heads[2][v] if heads[2][v] else alone(c, w)

    def pair(c, v, w):
        return (max(n[c][v, w] - d[c], 0) + d[c] * opens[c][v] * pool(c, v, w)) / heads[c][v] if heads[c][v] else pool(c, v, w)

    def ratios(own):
        return (np.array([np.log(alone(1, w) / alone(0, w)) for w in own]),
                np.array([np.log(pair(1, v, w) / pair(0, v, w)) for v, w in zip([None, *own], own, strict=False)]))

    return ratios


def plain_features(ratios, own):
    if not own:
        return np.zeros(1 + 2 * len(toxicity.WINDOWS))
    alone, pair = ratios(own)
    best = [max(x[i:i + k].mean() for i in range(max(1, len(x) - k + 1))) for x in (alone, pair) for k in toxicity.WINDOWS]
    return np.array([pair.mean(), *best])


@pytest.mark.parametrize(("run_words", "part_words"), [(1 << 20, 1 << 19), (40, 60)])
def test_models_equal_plain_kneser_ney(spark, monkeypatch, run_words, part_words):
    """Counts, back-off and windows of 50 labelled texts, in one run and partition and in many; fold 4 counts in the final models alone."""
    monkeypatch.setattr(toxicity, "RUN_WORDS", run_words)
    monkeypatch.setattr(toxicity, "PART_WORDS", part_words)
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.5, rng.integers(0, 25)) % 60) + (" vile brute" if i % 3 == 0 else "") for i in range(50)]
    texts[7], texts[8] = "", None
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(50)], "doc_id long, toxic int")
    own = [decontaminate.words((t or "").encode()) for t in texts]
    folds = [zlib.crc32(str(i).encode()) % 5 for i in range(50)]
    runs = toxicity.tokenised(docs)
    training, total = toxicity.training_runs(runs, labels, "toxic")
    assert total == sum(len(w) for w, f in zip(own, folds, strict=True) if f)
    model = toxicity.train(training, total)
    for variant, seen in (("a", (1, 2, 3)), ("b", (1, 2, 3, 4))):
        ratios = plain_kneser_ney([(w, int(i % 3 == 0)) for i, (w, f) in enumerate(zip(own, folds, strict=True)) if f in seen])
        got = {}
        for r in toxicity.run_features(runs, model, variant).collect():
            got |= dict(zip(r["ids"], np.frombuffer(r["features"]).reshape(len(r["ids"]), -1), strict=True))
        assert sorted(got) == list(range(50))
        for i, words in enumerate(own):
            assert np.allclose(got[i], plain_features(ratios, words), atol=1e-9), i


def test_layout_changes_no_score(spark, labelled, monkeypatch):
    docs, labels = labelled
    one = toxicity.score_documents(docs, labels).orderBy("doc_id").toPandas()
    monkeypatch.setattr(toxicity, "RUN_WORDS", 2000)
    monkeypatch.setattr(toxicity, "PART_WORDS", 3000)
    many = toxicity.score_documents(docs.repartition(6), labels).orderBy("doc_id").toPandas()
    assert np.allclose(one["score"], many["score"], atol=1e-7)


def test_toxic_words_of_the_tables_are_caught(spark):
    """Held-out labels of the driver's own documents."""
    sf_dir = "/root/testdata/sf0.1"
    rows = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).where("held_out").join(
        table(spark, sf_dir, "labels"), "doc_id").toPandas()
    hit, said = rows["toxic"] == 1, rows["predicted"] == 1
    assert auc(rows["score"].to_numpy(), rows["toxic"].to_numpy()) >= 0.95
    assert (hit & said).sum() >= 0.7 * hit.sum() and (hit & said).sum() >= 0.9 * said.sum()


def test_quality_sees_wording_alone(spark):
    """Classes of lower-case words of one shape and one frequency that differ in vocabulary only."""
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    vocabulary = sorted({"".join(rng.choice(letters, 7)) for _ in range(240)})[:200]
    docs = [(i, " ".join(rng.choice(vocabulary[i % 2::2], 50))) for i in range(800)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, quality int")
    rows = quality.score_quality(spark.createDataFrame(docs, "doc_id long, text string"), labels).toPandas()
    held = rows[rows["held_out"]]
    assert auc(held["score"].to_numpy(), held["doc_id"].to_numpy() % 2) > 0.95


def test_quality_learns_from_every_labelled_row(spark):
    """Most rows, those with the smallest hashes of their ids, are blanks; the classes differ in the others alone, in several runs."""
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    vocabulary = sorted({"".join(rng.choice(letters, 7)) for _ in range(240)})[:200]
    ids = spark.range(23_000).select(F.col("id").alias("doc_id"), F.col("id").alias("n"))
    order = [r["doc_id"] for r in ids.orderBy(F.xxhash64("doc_id")).collect()]
    first = {i for i in order if zlib.crc32(str(i).encode()) % 5}
    first = set([i for i in order if i in first][:16_384])
    docs = [(i, "" if i in first else " ".join(rng.choice(vocabulary[i % 2::2], 30))) for i in sorted(order)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, quality int")
    rows = quality.score_quality(spark.createDataFrame(docs, "doc_id long, text string"), labels).toPandas()
    held = rows[rows["held_out"]]
    assert auc(held["score"].to_numpy(), held["doc_id"].to_numpy() % 2) > 0.95


def test_network_of_several_runs_is_as_good(labelled):
    docs, labels = labelled
    rows = quality.score_quality(docs, labels, run_rows=80).join(labels, "doc_id").toPandas()
    held = rows[rows["held_out"]]
    assert auc(held["score"].to_numpy(), held["quality"].to_numpy()) > 0.97


def test_context_sums_equal_those_word_by_word(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(12)], n)) for n in (0, 1, 2, 3, 40, 7)] + [None]
    vectors = quality.word_vectors(spark.createDataFrame([(t,) for t in texts], "text string"))
    want = {}
    for text in texts:
        own = (text or "").encode().split()
        for i, w in enumerate(own):
            near = [quality.sparse_vector(own[j]) for j in range(max(0, i - 2), min(len(own), i + 3)) if j != i]
            want[w] = want.get(w, 0) + sum(near, np.zeros(quality.SIZE))
    assert len(vectors.words) == 12
    for w, v in want.items():
        at = vectors.numbers(quality._hashes([w], quality._memos()[0]))[0]
        assert np.allclose(vectors.context[at], v / max(np.linalg.norm(v), 1e-9), atol=1e-5)


def test_fixed_vectors_at_once_equal_those_one_by_one():
    words = [b"", b"a", b"word", "Ünï".encode(), *(b"w%d" % i for i in range(500))]
    assert (quality.sparse_vectors(words) == [quality.sparse_vector(w) for w in words]).all()
