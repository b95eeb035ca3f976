"""From texts to topics in one go, and from a corpus folder to the stage tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicwake.functions.stopwords import STOP_WORDS
from topicwake.operators import drift, topics
from topicwake.operators.ids import rows_before
from topicwake.operators.normalize import normalize_docs
from topicwake.operators.vocabulary import build_vocabulary, tokens_of, vectorize, vocabulary_terms
from topicwake.session import materialize
from topicwake.sources.corpus import scan_corpus
from topicwake.sources.stage_tables import MODEL_VERSION, modeled_record, write_stages


@dataclass(frozen=True)
class Params:
    topics: int = 10
    top_words: int = 10
    min_df: int = 2
    max_df: float = 0.95
    max_terms: int = 5000
    seed: int = 42
    epochs: int = 10
    mini_batch: int = 128
    window: int = 200
    threshold: float = 0.15
    batch_size: int = 100
    model_version: str = MODEL_VERSION
    stop_words: tuple[str, ...] = STOP_WORDS


@dataclass(frozen=True)
class ModelingResult:
    """``summary`` (topic_id, top_words) and ``results`` (id, dominant_topic, topic_distribution,
    top_words). Without a model ``error`` says why, ``summary`` is None and the results are neutral."""

    num_topics: int
    summary: DataFrame | None
    results: DataFrame
    error: str | None = None


@dataclass(frozen=True)
class Analysis:
    """The stages of one corpus; ``model`` is None if there was nothing to fit."""

    normalized: DataFrame
    modeled: DataFrame
    windows: DataFrame
    model: topics.TopicModel | None


def fit_docs(docs: DataFrame, params: Params = Params()) -> topics.TopicModel | str:
    """A model of the written table ``docs`` (id, text), or the reason why there is none.

    The vocabulary and the vectors each read the texts once; every update of the model reads the
    written vectors. The driver gets the vocabulary and the topics x terms model, nothing that grows
    with the documents.
    """
    if not topics.enough_docs(docs):
        return "Need at least 5 documents"
    tokens = tokens_of(docs.select("id", "text"), params.stop_words).select("id", "tokens")
    terms = vocabulary_terms(build_vocabulary(tokens, params.min_df, params.max_df, params.max_terms))
    if not terms:
        return "No terms remain in the vocabulary"
    vectors = materialize(vectorize(tokens, terms), "vectors")
    return topics.fit_topics(vectors, terms, params.topics, params.seed, params.epochs)


def score_docs(docs: DataFrame, model: topics.TopicModel | None, params: Params = Params()) -> DataFrame:
    """``docs`` with dominant_topic, topic_distribution and top_words; all columns stay, no row moves."""
    if model is None:
        return topics.unfitted_scores(docs)
    scored = topics.score_topics(model, vectorize(tokens_of(docs, params.stop_words), model.terms))
    return topics.attach_top_words(scored, topics.topics_summary(docs.sparkSession, model, params.top_words))


def run_modeling(docs: DataFrame, params: Params = Params()) -> ModelingResult:
    """Topics of the texts (id, text) in one go: a summary of the topics and a result per document."""
    docs = materialize(docs.select("id", "text"), "docs")
    fitted = fit_docs(docs, params)
    model, error = (None, fitted) if isinstance(fitted, str) else (fitted, None)
    results = score_docs(docs, model, params).select("id", "dominant_topic", "topic_distribution", "top_words")
    summary = None if model is None else topics.topics_summary(docs.sparkSession, model, params.top_words)
    return ModelingResult(params.topics, summary, results, error)


def analyse_docs(raw: DataFrame, params: Params = Params(), dense: bool = False) -> Analysis:
    """Normalise, model and check for drift. ``dense`` promises ids 0, 1, 2, … without a gap.

    Texts are written twice on the way, normalised and scored, so that neither is computed again. Ids
    with gaps are numbered before the rows are written, the one time that rows move. From there on windows are
    arithmetic, and only the window counts and, by their closing rows, the window results are exchanged.
    """
    cleaned = normalize_docs(raw, params.stop_words)
    if dense:
        cleaned = cleaned.withColumn("_place", F.col("id"))
    else:
        cleaned = cleaned.join(rows_before(raw.select("id"), "id", name="_place"), "id", "left")
    normalized = materialize(cleaned, "normalized")
    fitted = fit_docs(normalized, params)
    model = None if isinstance(fitted, str) else fitted
    scored = materialize(score_docs(normalized, model, params), "scored")
    placed = model is not None  # then every row has a topic
    windowed = drift.count_windows(scored, window=params.window, dense=placed, place_col="_place").drop("_place")
    windows = materialize(
        drift.drift_windows(windowed, k=params.topics, window=params.window, threshold=params.threshold), "windows"
    )
    modeled = modeled_record(drift.attach_drift(windowed, windows, written=placed), params.model_version)
    return Analysis(normalized.drop("_place"), modeled, windows, model)


def analyse_corpus(
    spark: SparkSession,
    source: str,
    target: str,
    clock: Column,
    params: Params = Params(),
    max_rows: int | None = None,
) -> Analysis:
    """The whole run: scan the corpus folder, analyse it, write the stage tables below ``target``."""
    raw = scan_corpus(spark, source, max_rows)
    analysis = analyse_docs(raw, params, dense=True)
    write_stages(
        analysis.modeled,
        target,
        clock,
        raw=raw,
        normalized=analysis.normalized,
        source=source,
        batch_size=params.batch_size,
        dense=True,
    )
    return analysis
