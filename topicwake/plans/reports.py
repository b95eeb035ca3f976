"""The report queries. They read the whole stage table, not one file of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicwake.functions.scalars import first_words, page_count, reduction_pct, snippet
from topicwake.operators.ids import dense_id

SAMPLE = 1000
SEED = 42
PAGE_SIZE = 10

# The drift magnitudes.
_MAGNITUDES = ("none", "low", "medium", "high")


def _first(value: Column, order: str = "id") -> Column:
    """First non-null value in id order."""
    return F.min_by(value, F.when(value.isNotNull(), F.col(order)))


def _magnitude_code() -> Column:
    """Magnitudes as numbers: Spark can keep these in a hash table while it aggregates, whereas texts
    would make it sort all rows first."""
    return F.array_position(F.array(*map(F.lit, _MAGNITUDES)), F.col("drift_magnitude"))


def _magnitude(code: str) -> Column:
    return F.element_at(F.array(*map(F.lit, _MAGNITUDES)), F.col(code).cast("int"))


def overview(features: DataFrame) -> DataFrame:
    """Row count, mean lengths, model version of the first row, distinct topics, drift windows, windows.

    Aggregates by window and topic first, so the distinct counts run over that small table instead of
    sending each row once per distinct count.
    """
    groups = features.groupBy("window_id", "dominant_topic").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("original_length").alias("o"),
        F.count("original_length").alias("o_n"),
        F.sum("normalized_length").alias("m"),
        F.count("normalized_length").alias("m_n"),
        F.bool_or("drift_detected").alias("drifted"),
    )
    version = features.agg(F.min_by("model_version", "id")).scalar()
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.try_divide(F.sum("o"), F.sum("o_n")).alias("avg_original_length"),
        F.try_divide(F.sum("m"), F.sum("m_n")).alias("avg_normalized_length"),
        F.count_distinct("dominant_topic").alias("topics_detected"),
        F.count_distinct(F.when(F.col("drifted"), F.col("window_id"))).alias("drift_windows"),
        F.count_distinct("window_id").alias("windows"),
    ).withColumn("model_version", version)


def normalization_impact(docs: DataFrame) -> DataFrame:
    """Mean share of characters removed (empty texts left out) and characters saved in all."""
    return docs.agg(
        F.avg(reduction_pct(F.col("original_length"), F.col("normalized_length"))).alias("avg_reduction_pct"),
        (F.sum("original_length") - F.sum("normalized_length")).alias("chars_saved"),
    )


def lengths_long(docs: DataFrame) -> DataFrame:
    """(type, length): both lengths of every document below each other."""
    return docs.select(
        F.col("original_length").cast("long").alias("Original"),
        F.col("normalized_length").cast("long").alias("Normalized"),
    ).unpivot([], ["Original", "Normalized"], "type", "length")


def length_boxplot(docs: DataFrame) -> DataFrame:
    """Five-number summary of both lengths, exact: percentiles of the distinct lengths and their counts."""
    counted = lengths_long(docs).groupBy("type", "length").agg(F.count(F.lit(1)).alias("n"))
    five = F.percentile("length", F.array(*map(F.lit, (0.0, 0.25, 0.5, 0.75, 1.0))), F.col("n"))
    names = ["min_len", "q1", "median", "q3", "max_len"]
    return (
        counted.groupBy("type")
        .agg(five.alias("five"))
        .select("type", *[F.element_at("five", i + 1).alias(name) for i, name in enumerate(names)])
    )


def docs_per_topic(features: DataFrame) -> DataFrame:
    counts = features.groupBy("dominant_topic").agg(F.count(F.lit(1)).alias("docs")).orderBy("dominant_topic")
    return counts.select(F.concat(F.lit("Topic "), F.col("dominant_topic")).alias("topic"), "docs")


def topic_words_first(features: DataFrame, shown: int = 7) -> DataFrame:
    """Per topic the first non-empty word list in id order.

    Finds the first row of each topic by number, then fetches its words: one row per topic to broadcast.
    """
    worded = features.where((F.col("dominant_topic") >= 0) & (F.size("top_words") > 0))
    firsts = worded.groupBy("dominant_topic").agg(F.min("id").alias("id"))
    return (
        features.select("id", "dominant_topic", "top_words")
        .join(F.broadcast(firsts), ["id", "dominant_topic"])
        .select(F.col("dominant_topic").alias("topic"), first_words(F.col("top_words"), shown).alias("words"))
        .orderBy("topic")
    )


def head(df: DataFrame, n: int = 50, id_col: str = "id") -> DataFrame:
    return df.orderBy(id_col).limit(n)


def topic_heatmap(features: DataFrame, docs: int = 50) -> DataFrame:
    """(id, topic, probability) of the first documents, one row per topic."""
    return head(features.select("id", "topic_distribution"), docs).select(
        "id", F.posexplode(F.transform("topic_distribution", lambda p: F.coalesce(p, F.lit(0.0)))).alias("topic", "probability")
    )


def _topic_shares(features: DataFrame, topics: list[int]) -> tuple[DataFrame, DataFrame]:
    """(window_id, shares by topic) and the one row of all topics that occur or are listed; null counts as -1."""
    topic = F.coalesce("dominant_topic", F.lit(-1))
    tallies = features.groupBy("window_id", topic.alias("topic")).agg(F.count(F.lit(1)).alias("n"))
    listed = F.array(*map(F.lit, topics)).cast("array<int>")
    occurring = tallies.agg(F.sort_array(F.array_union(F.collect_set("topic"), listed)).alias("topics"))
    # at most k + 1 topics a window
    counts = F.map_from_entries(F.collect_list(F.struct("topic", "n")))
    shares = tallies.groupBy("window_id").agg(F.sum("n").alias("all"), counts.alias("counts"))
    return shares.select("window_id", F.transform_values("counts", lambda _, n: n / F.col("all")).alias("shares")), occurring


def window_topic_share(features: DataFrame, topics: list[int] = ()) -> DataFrame:
    """(window_id, topic, share): share of each topic in each window, 0 where a window lacks it.

    Topics are those that occur, and ``topics`` besides.
    """
    shares, occurring = _topic_shares(features, topics)
    cell = lambda t: F.struct(t.alias("topic"), F.coalesce(F.col("shares")[t], F.lit(0.0)).alias("share"))
    return shares.withColumn("topics", occurring.scalar()).select("window_id", F.inline(F.transform("topics", cell)))


def window_topic_table(features: DataFrame, topics: list[int] = ()) -> DataFrame:
    """The same with one column per topic; the topics that occur, k + 1 at most, are read first."""
    shares, occurring = _topic_shares(features, topics)
    every = occurring.first()[0]
    return shares.select("window_id", *[F.coalesce(F.col("shares")[t], F.lit(0.0)).alias(f"topic_{t}") for t in every])


def window_stats_first(features: DataFrame) -> DataFrame:
    """Per window the values of its first row, as the dashboard shows them. Results are written on the
    closing row, so these are the neutral values unless a window has one row; see :func:`window_stats`."""
    return (
        features.groupBy("window_id")
        .agg(
            _first(F.col("js_divergence")).alias("js_divergence"),
            _first(F.col("drift_detected")).alias("drift_detected"),
            _first(_magnitude_code()).alias("code"),
        )
        .select("window_id", "js_divergence", "drift_detected", _magnitude("code").alias("drift_magnitude"))
    )


def window_stats(features: DataFrame) -> DataFrame:
    """Per window the values of its last row with a topic: the result, once the window is complete."""
    closing = F.when(F.col("dominant_topic") >= 0, F.col("id"))
    return (
        features.groupBy("window_id")
        .agg(
            F.max_by("js_divergence", closing).alias("js_divergence"),
            F.max_by("drift_detected", closing).alias("drift_detected"),
            F.max_by(_magnitude_code(), closing).alias("code"),
        )
        .select("window_id", "js_divergence", "drift_detected", _magnitude("code").alias("drift_magnitude"))
    )


def avg_js(features: DataFrame) -> DataFrame:
    """Mean distance over windows, by first and by closing row."""
    closing = F.when(F.col("dominant_topic") >= 0, F.col("id"))
    per_window = features.groupBy("window_id").agg(
        _first(F.col("js_divergence")).alias("first_js"), F.max_by("js_divergence", closing).alias("closing_js")
    )
    return per_window.agg(F.avg("first_js").alias("avg_js"), F.avg("closing_js").alias("avg_js_closing"))


def drift_rows(features: DataFrame) -> DataFrame:
    return features.where("drift_detected")


def drift_event_log(features: DataFrame) -> DataFrame:
    """One row per window with drift."""
    return (
        drift_rows(features)
        .groupBy("window_id")
        .agg(_first(F.col("js_divergence")).alias("js_divergence"), _first(_magnitude_code()).alias("code"))
        .select("window_id", "js_divergence", _magnitude("code").alias("drift_magnitude"))
        .orderBy("window_id")
    )


def sample_n(df: DataFrame, n: int = SAMPLE, seed: int = SEED, id_col: str = "id") -> DataFrame:
    """Exactly ``n`` rows without replacement (all if there are fewer), the same ones for a seed."""
    order = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")).cast("binary"))
    return df.orderBy(order, id_col).limit(n)


def page(df: DataFrame, number: int, page_size: int = PAGE_SIZE, id_col: str = "id") -> DataFrame:
    """Page ``number`` (from 1) in id order, for any id that can be sorted and names one row.

    The ids alone are numbered by range, whatever the page, and the page's few ids fetch its rows.
    """
    start = page_size * (number - 1)
    place = dense_id(df.select(id_col), [id_col], "_place")
    wanted = place.where((F.col("_place") >= start) & (F.col("_place") < start + page_size)).select(id_col)
    return df.join(F.broadcast(wanted), id_col).orderBy(id_col)  # page_size rows


def shown_fields(docs: DataFrame, shown: int = 5) -> DataFrame:
    """(id, snippet) of documents, and of the record's other fields those that ``docs`` has:
    dominant_topic, both lengths and the first words of the topic."""
    fields = {
        "id": F.col("id"),
        "dominant_topic": F.col("dominant_topic"),
        "original_length": F.col("original_length"),
        "normalized_length": F.col("normalized_length"),
        "top_words": first_words(F.col("top_words"), shown),
        "text": snippet(F.col("text")),
    }
    names = {"text": "snippet", "top_words": "words"}
    return docs.select(*[c.alias(names.get(n, n)) for n, c in fields.items() if n in docs.columns])


def text_page(docs: DataFrame, number: int, page_size: int = PAGE_SIZE, shown: int = 5) -> DataFrame:
    """The shown fields of a page of documents."""
    return shown_fields(page(docs, number, page_size), shown)


def pages(df: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    return rows.select("rows", page_count(F.col("rows"), page_size).alias("total_pages"))
