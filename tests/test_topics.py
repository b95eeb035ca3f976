import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicwake.operators import online_lda, topics, vocabulary
from topicwake.plans.modeling import Params, fit_docs, run_modeling, score_docs

SPORT = "ball goal team match player coach league score stadium referee".split()
FOOD = "bread cheese soup pepper onion garlic butter flour sugar vinegar".split()


def planted(n=60, seed=0):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(SPORT if i % 2 else FOOD, k=30))) for i in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(planted(), "id long, text string").repartition(4).persist()


def vectors_of(docs):
    tokens = vocabulary.tokens_of(docs).select("id", "tokens")
    terms = vocabulary.vocabulary_terms(vocabulary.build_vocabulary(tokens, max_df=1.0))
    return vocabulary.vectorize(tokens, terms), terms


def test_vocabulary_rules(spark):
    texts = ["alpha beta beta", "alpha gamma", "alpha beta delta", "alpha", ""]
    tokens = vocabulary.tokens_of(spark.createDataFrame(list(enumerate(texts)), "id long, text string"))
    rows = vocabulary.build_vocabulary(tokens, max_df=0.8).orderBy("idx").collect()
    assert [tuple(r) for r in rows] == [("alpha", 0, 4, 4), ("beta", 1, 3, 2)]
    assert vocabulary.vocabulary_terms(vocabulary.build_vocabulary(tokens, max_df=0.7)) == ["beta"]
    assert vocabulary.vocabulary_terms(vocabulary.build_vocabulary(tokens, min_df=5)) == []


def test_vocabulary_cut_prefers_frequent_then_smaller_terms(spark):
    texts = ["dd cc bb aa ee ee"] * 3 + ["zz"] * 7
    tokens = vocabulary.tokens_of(spark.createDataFrame(list(enumerate(texts)), "id long, text string"))
    assert vocabulary.vocabulary_terms(vocabulary.build_vocabulary(tokens, size=4)) == ["aa", "bb", "ee", "zz"]


def test_document_words_are_worked_out_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    plan = vocabulary.exploded(vocabulary.tokens_of(df), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_doc_term_counts(spark):
    texts = ["pear fig pear", "fig kiwi", "", "kiwi fig nut"]
    tokens = vocabulary.tokens_of(spark.createDataFrame(list(enumerate(texts)), "id long, text string"))
    vocab = vocabulary.build_vocabulary(tokens)
    got = sorted(tuple(r) for r in vocabulary.doc_term_counts(tokens, vocab).collect())
    assert got == [(0, "fig", 1), (1, "fig", 1), (1, "kiwi", 1), (3, "fig", 1), (3, "kiwi", 1)]
    assert vocabulary.doc_term_counts(tokens, vocabulary.build_vocabulary(tokens, min_df=9)).count() == 0


def test_planted_topics_are_told_apart(docs):
    result = run_modeling(docs, Params(topics=2, max_df=1.0))
    assert result.error is None and result.num_topics == 2
    rows = result.results.collect()
    sides = {i % 2: {r.dominant_topic for r in rows if r.id % 2 == i} for i in (0, 1)}
    assert len(rows) == 60 and all(len(s) == 1 for s in sides.values()) and sides[0] != sides[1]
    summary = {r.topic_id: set(r.top_words) for r in result.summary.collect()}
    assert {frozenset(w) for w in summary.values()} == {frozenset(SPORT), frozenset(FOOD)}
    for r in rows:
        assert set(r.top_words) == summary[r.dominant_topic]
        assert sum(r.topic_distribution) == pytest.approx(1, abs=1e-3)
        assert r.dominant_topic == int(np.argmax(r.topic_distribution))


def test_same_seed_same_result(docs):
    first, second = (
        sorted((r.id, r.dominant_topic, r.topic_distribution) for r in run_modeling(docs, Params(topics=3)).results.collect())
        for _ in range(2)
    )
    assert [r[:2] for r in first] == [r[:2] for r in second]
    assert np.allclose([r[2] for r in first], [r[2] for r in second], atol=2e-3)


def test_batches_of_the_online_fit(docs):
    vectors, terms = vectors_of(docs)
    model = topics.fit_topics(vectors.persist(), terms, k=2, epochs=2, batch=30)
    assert model.state.updates == 4


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_batch_fit_reads_every_document_in_every_pass(docs, parts):
    """The same topics as a loop over documents, on any partitioning."""
    vectors, terms = vectors_of(docs)
    plain = [(np.array(r.indices), np.array(r.counts)) for r in vocabulary.sparse_counts(vectors).collect()]
    state = online_lda.new_state(terms, k=3)
    for _ in range(4):
        old = one_process_step(state, plain, len(plain))
        rate = (10.0 + state.updates + 1) ** -0.7
        weights = (old - (1 - rate) * state.weights) / rate  # the loop's target, without its blending
        state = online_lda.LdaState(terms, weights, state.updates)
    found = topics.fit_topics(vectors.repartition(parts), terms, k=3, epochs=4)
    assert np.allclose(found.state.weights, state.weights, rtol=1e-9, atol=1e-9) and found.state.updates == 4


def test_document_without_known_words_gets_equal_shares(spark, docs):
    model = fit_docs(docs, Params(topics=4, max_df=1.0))
    odd = spark.createDataFrame([(1, "unheard words only"), (2, ""), (3, None)], "id long, text string")
    for r in score_docs(odd, model).collect():
        assert r.dominant_topic == 0 and r.topic_distribution == [0.25] * 4 and len(r.top_words) == 10


@pytest.mark.parametrize("texts", [["a word here"] * 4, ["the of and"] * 9, [f"lonely{i}" for i in range(9)]])
def test_no_model(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    result = run_modeling(df)
    assert result.error and result.summary is None
    assert {(r.dominant_topic, tuple(r.topic_distribution), tuple(r.top_words)) for r in result.results.collect()} == {
        (-1, (), ())
    }


def test_argmax_tie(spark):
    from topicwake.functions.scalars import dominant_topic

    df = spark.createDataFrame([([0.1, 0.4, 0.4],), ([],), (None,)], "d array<double>")
    assert [r[0] for r in df.select(dominant_topic(F.col("d"))).collect()] == [1, -1, -1]


# ---- incremental model ----


def one_process_step(state, rows, total_docs):
    """The same update written as a loop over documents."""
    k, _ = state.weights.shape
    beta = np.exp(online_lda._expected_log(state.weights))
    sums = np.zeros_like(state.weights)
    for indices, counts in rows:
        if not len(indices):
            continue
        b, gamma = beta[:, indices], np.ones(k)
        for _ in range(100):
            theta = np.exp(online_lda._expected_log(gamma[None])[0])
            phi = theta @ b + np.finfo(float).eps
            new = 1 / k + theta * (b @ (counts / phi))
            moved, gamma = np.abs(new - gamma).mean(), new
            if moved < 1e-3:
                break
        theta = np.exp(online_lda._expected_log(gamma[None])[0])
        phi = theta @ b + np.finfo(float).eps
        sums[:, indices] += theta[:, None] * b * (counts / phi)
    rate = (10.0 + state.updates + 1) ** -0.7
    return (1 - rate) * state.weights + rate * (1 / k + total_docs / len(rows) * sums)


def test_update_equals_one_process(docs):
    vectors, terms = vectors_of(docs)
    plain = [
        (np.array(r.indices), np.array(r.counts)) for r in vocabulary.sparse_counts(vectors).collect()
    ]
    state = online_lda.new_state(terms, k=3)
    for _ in range(3):
        wanted = one_process_step(state, plain, 1_000_000)
        state = online_lda.partial_fit(state, vectors)
        assert np.allclose(state.weights, wanted, rtol=1e-9)
    assert state.updates == 3


def test_update_does_not_depend_on_the_partitions_or_portions(docs, monkeypatch):
    vectors, terms = vectors_of(docs)
    state = online_lda.new_state(terms, k=3)
    one = online_lda.partial_fit(state, vectors.coalesce(1))
    many = online_lda.partial_fit(state, vectors.repartition(9))
    monkeypatch.setattr(online_lda, "_PORTION", 7)
    cut = online_lda.partial_fit(state, vectors.coalesce(2))
    assert np.allclose(one.weights, many.weights) and np.allclose(one.weights, cut.weights)


def test_digamma():
    # fixed values of the function
    assert np.allclose(
        online_lda.digamma(np.array([0.1, 0.5, 1.0, 2.0, 10.0, 1000.0])),
        [-10.4237549404, -1.9635100260, -0.5772156649, 0.4227843351, 2.2517525890, 6.9072551956],
    )


def test_incremental_model_learns_and_scores(spark, docs):
    vectors, terms = vectors_of(docs)
    state = online_lda.first_fit(online_lda.new_state(terms, k=2), vectors, epochs=10)
    state = online_lda.partial_fit(state, vectors)
    rows = online_lda.score(state, vectors.union(vocabulary.vectorize(
        spark.createDataFrame([(999, [])], "id long, tokens array<string>"), terms
    ))).collect()
    by_id = {r.id: r for r in rows}
    assert by_id[999].topic_distribution == [0.5, 0.5] and by_id[999].dominant_topic == 0
    sides = [{r.dominant_topic for r in rows if r.id % 2 == i and r.id != 999} for i in (0, 1)]
    assert all(len(s) == 1 for s in sides) and sides[0] != sides[1]
    words = {r.topic_id: set(r.top_words) for r in topics.word_lists(topics.top_terms(online_lda.topic_weights(spark, state))).collect()}
    assert {frozenset(w) for w in words.values()} == {frozenset(SPORT), frozenset(FOOD)}


def test_first_fit_in_slices(docs):
    vectors, terms = vectors_of(docs)
    state = online_lda.first_fit(online_lda.new_state(terms, k=2), vectors, epochs=2, batch=25)
    assert state.updates == 6


def test_state_round_trip(spark):
    state = online_lda.LdaState(["a", "b", "c"], np.arange(6.0).reshape(2, 3) + 0.1, 4)
    again = online_lda.state_from_rows(online_lda.state_rows(spark, state).repartition(3))
    assert again.terms == state.terms and again.updates == 4 and (again.weights == state.weights).all()
    assert online_lda.state_from_rows(online_lda.state_rows(spark, None)) is None
    with pytest.raises(ValueError):
        online_lda.new_state([])


def test_the_barrier_job_equals_a_job_an_update(spark, docs, monkeypatch):
    """To 1e-9, with empty documents and a short last slice; one barrier job for the whole fit."""
    _, terms = vectors_of(docs)
    tokens = vocabulary.tokens_of(docs).select("id", "tokens")
    empty = spark.createDataFrame([(10_000 + i, []) for i in range(7)], "id long, tokens array<string>")
    vectors = vocabulary.vectorize(tokens.unionByName(empty), terms).persist()
    start = online_lda.new_state(terms, k=3)
    fits = []
    real = online_lda._fit_by_barrier
    monkeypatch.setattr(online_lda, "_fit_by_barrier", lambda *a: fits.append(a[-1]) or real(*a))
    found = online_lda.first_fit(start, vectors, epochs=2, batch=32)
    monkeypatch.setattr(online_lda, "_fit_by_barrier", lambda state, sliced, epochs, *_: online_lda._fit_by_jobs(state, sliced, epochs))
    wanted = online_lda.first_fit(start, vectors, epochs=2, batch=32)
    assert fits == [2] and found.updates == wanted.updates > 2
    np.testing.assert_allclose(found.weights, wanted.weights, rtol=1e-9)
    none = online_lda.first_fit(start, vectors.where("id < 0"), epochs=2, batch=32)
    vectors.unpersist()
    assert none is start


def test_messages_carry_sums_exactly():
    sums = np.zeros((50, 3))
    sums[[3, 7, 49]] = np.random.default_rng(1).normal(size=(3, 3))
    total = np.ones((50, 3))
    online_lda._add_message(total, online_lda._message(sums))
    online_lda._add_message(total, online_lda._message(np.zeros((50, 3))))
    assert (total == 1 + sums).all()


def test_a_fit_of_many_updates_waits_for_no_barrier(spark, docs, monkeypatch):
    """A barrier costs a second an update; a job an update gives the same topics."""
    vectors, terms = vectors_of(docs)
    start = online_lda.new_state(terms, k=3)
    monkeypatch.setattr(online_lda, "_BARRIER_UPDATES", 100)
    wanted = online_lda.first_fit(start, vectors, epochs=4, batch=16)
    monkeypatch.undo()
    monkeypatch.setattr(online_lda, "_fit_by_barrier", lambda *_: pytest.fail("a barrier job"))
    found = online_lda.first_fit(start, vectors, epochs=4, batch=16)
    assert found.updates == wanted.updates > 10
    np.testing.assert_allclose(found.weights, wanted.weights, rtol=1e-9)
    monkeypatch.setattr(online_lda, "_SLICE_GROUPS", 2)  # several slices in a partition
    np.testing.assert_allclose(online_lda.first_fit(start, vectors, epochs=4, batch=16).weights, wanted.weights, rtol=1e-9)


def test_infer_works_document_by_document_alike():
    """Documents of all sizes in one call as each alone, and blocks are padded little."""
    rng = np.random.default_rng(5)
    sizes = np.append(rng.integers(1, 300, 250), [1, 900])
    starts, topic_terms = np.cumsum(sizes) - sizes, rng.gamma(0.5, 1.0, (1000, 4)) + 1e-3
    terms = np.concatenate([rng.choice(1000, n, replace=False) for n in sizes])
    counts = rng.integers(1, 9, len(terms)).astype(float)
    gamma, expected = online_lda.infer(starts, terms, counts, topic_terms, 0.25)
    for i, (a, n) in enumerate(zip(starts, sizes)):
        one, own = online_lda.infer(np.zeros(1, np.int64), terms[a : a + n], counts[a : a + n], topic_terms, 0.25)
        np.testing.assert_allclose(gamma[i], one[0], rtol=1e-9)
        np.testing.assert_allclose(expected[a : a + n], own, rtol=1e-9, atol=1e-12)
    runs = online_lda._alike(np.sort(sizes))
    assert sum((last - first) * width for first, last, width in runs) < 1.3 * sizes.sum()


def test_topics_summary_normalises_the_texts_once(spark, monkeypatch):
    from topicwake.plans import queries

    calls = []
    real = queries.clean_texts
    monkeypatch.setattr(queries, "clean_texts", lambda *a: calls.append(a) or real(*a))
    rows = queries.topics_summary(spark, "/root/testdata/sf0.001").collect()
    assert len(calls) == 1 and sorted(tuple(r) for r in rows) == [(t, 10, 10) for t in range(10)]
