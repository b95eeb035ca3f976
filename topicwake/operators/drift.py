"""Drift of the topic mix over count windows.

Rows with a topic are counted in id order; every ``window`` of them close a window. A window is
compared with the one before it by the Jensen-Shannon distance of their topic shares.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicwake.functions.scalars import drift_magnitude, js_distance, utc_iso
from topicwake.operators.ids import rows_before

WINDOW = 200
THRESHOLD = 0.15
TOPICS = 10
_SMOOTH = 1e-10
_BLOCK_BITS = 16


def has_topic(topic_col: str) -> Column:
    return F.coalesce(F.col(topic_col) >= 0, F.lit(False))


def count_windows(
    df: DataFrame,
    id_col: str = "id",
    topic_col: str = "dominant_topic",
    window: int = WINDOW,
    dense: bool = False,
    place_col: str | None = None,
) -> DataFrame:
    """Add ``window_id`` and ``is_closing``. Rows without a topic carry the current window.

    ``dense`` says that every row has a topic, as after scoring a whole corpus with one model, and that
    ``place_col``, or the id, runs 0, 1, 2, …: then it is its own running count and no row moves.
    """
    if dense:
        counted = df.withColumn("_before", F.col(place_col or id_col))
    else:
        counted = rows_before(df, id_col, has_topic(topic_col), "_before")
    last = F.col("_before") % window == window - 1
    return counted.withColumns(
        {"window_id": F.expr(f"_before div {window}"), "is_closing": has_topic(topic_col) & last}
    ).drop("_before")


def window_counts(
    windowed: DataFrame, id_col: str = "id", topic_col: str = "dominant_topic", k: int = TOPICS
) -> DataFrame:
    """(window_id, n, counts, closing_id): rows per topic as an array, topics without rows as 0.

    One aggregation by window with map-side partial counts, whatever the share of a hot topic.
    """
    per_topic = F.array(*[F.count_if(F.col(topic_col) == topic) for topic in range(k)])
    return (
        windowed.where(has_topic(topic_col))
        .groupBy("window_id")
        .agg(F.count(F.lit(1)).alias("n"), per_topic.alias("counts"), F.max(id_col).alias("closing_id"))
    )


def with_shares(counts: DataFrame) -> DataFrame:
    """Add ``dist``, the smoothed topic shares of a window."""
    share = F.transform("counts", lambda c: (c + _SMOOTH) / (F.col("n") + F.size("counts") * _SMOOTH))
    return counts.withColumn("dist", share)


def window_histogram(
    windowed: DataFrame, id_col: str = "id", topic_col: str = "dominant_topic", k: int = TOPICS, window: int = WINDOW
) -> DataFrame:
    """(window_id, topic, p) of the complete windows, one row per topic."""
    complete = with_shares(window_counts(windowed, id_col, topic_col, k)).where(F.col("n") == window)
    return complete.select("window_id", F.posexplode("dist").alias("topic", "p"))


def adjacent_windows(windows: DataFrame) -> DataFrame:
    """Each window with the shares of the one before it (null for the first).

    The windows grow with the corpus, so the lag runs in blocks of 2^16 windows instead of over all of
    them in one task; the last window of a block is sent to the next block too, to be looked back at.
    """
    block = F.shiftright("window_id", _BLOCK_BITS)
    at_end = F.shiftright(F.col("window_id") + 1, _BLOCK_BITS) > block
    placed = windows.withColumn("_block", F.explode(F.when(at_end, F.array(block, block + 1)).otherwise(F.array(block))))
    order = Window.partitionBy("_block").orderBy("window_id")
    follows = F.lag("window_id").over(order) == F.col("window_id") - 1
    return (
        placed.withColumn("previous_dist", F.when(follows, F.lag("dist").over(order)))
        .where(F.col("_block") == block)
        .drop("_block")
    )


def judge_windows(pairs: DataFrame, threshold: float = THRESHOLD, keys: tuple[str, ...] = ()) -> DataFrame:
    """Distance, drift flag and magnitude of windows paired with their predecessor.

    Flag and magnitude use the exact distance; the reported one has four decimals. The first window
    has nothing to differ from. The column keeps its customary name although it is a distance.
    """
    first = F.col("previous_dist").isNull()
    return (
        pairs.withColumn("js", F.when(first, 0.0).otherwise(js_distance(F.col("previous_dist"), F.col("dist"))))
        .withColumns(
            {
                "js_divergence": F.round("js", 4),
                "drift_detected": ~first & (F.col("js") > threshold),
                "drift_magnitude": F.when(first, "none").otherwise(drift_magnitude(F.col("js"))),
            }
        )
        .select(*keys, "window_id", "closing_id", "js_divergence", "drift_detected", "drift_magnitude")
    )


def drift_windows(
    windowed: DataFrame,
    id_col: str = "id",
    topic_col: str = "dominant_topic",
    k: int = TOPICS,
    window: int = WINDOW,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The drift table of rows numbered by :func:`count_windows`; an unfinished last window is left out."""
    counts = window_counts(windowed, id_col, topic_col, k)
    complete = with_shares(counts).where(F.col("n") == window)
    return judge_windows(adjacent_windows(complete), threshold)


def attach_drift(rows: DataFrame, windows: DataFrame, id_col: str = "id", written: bool = False) -> DataFrame:
    """Write each window's result onto the row that closed it; all other rows get the neutral values.

    ``rows`` come from :func:`count_windows`; ``is_closing`` is dropped. Only closing rows can have a
    result. If the rows are a map over a ``written`` table, reading it once for the closing rows and once
    for the others lets the join move one row in ``window`` only, however many windows there are.
    Otherwise one join on the closing row's id serves, where Spark broadcasts the windows while their
    size allows it.
    """
    results = windows.select(
        F.col("closing_id").alias(id_col), "drift_detected", "js_divergence", "drift_magnitude"
    )
    neutral = {
        "drift_detected": F.lit(False),
        "js_divergence": F.lit(0.0),
        "drift_magnitude": F.lit("none"),
    }
    if not written:
        joined = rows.join(results, id_col, "left")
        return joined.withColumns({n: F.coalesce(n, v) for n, v in neutral.items()}).drop("is_closing")
    closing = rows.where("is_closing").join(results, id_col, "left")
    closing = closing.withColumns({n: F.coalesce(n, v) for n, v in neutral.items()})
    return rows.where(~F.col("is_closing")).withColumns(neutral).unionByName(closing).drop("is_closing")


def drift_events(windows: DataFrame, clock: Column | None = None) -> DataFrame:
    """(window_id, js_divergence, magnitude, timestamp) of the windows with drift; ``clock`` is when they were judged."""
    return windows.where("drift_detected").select(
        "window_id",
        "js_divergence",
        F.col("drift_magnitude").alias("magnitude"),
        utc_iso(F.current_timestamp() if clock is None else clock).alias("timestamp"),
    )


def last_drift_events(windows: DataFrame, n: int = 10, clock: Column | None = None) -> DataFrame:
    """The last ``n`` events, oldest first."""
    return drift_events(windows, clock).orderBy(F.desc("window_id")).limit(n).orderBy("window_id")


def drift_summary(windows: DataFrame, n: int = 10, clock: Column | None = None) -> DataFrame:
    """One row: number of windows, number of events, and the last ``n`` events, oldest first."""
    totals = windows.agg(
        F.count(F.lit(1)).alias("total_windows"), F.count_if("drift_detected").alias("drift_events_count")
    )
    event = F.struct("window_id", "js_divergence", "magnitude", "timestamp")
    latest = last_drift_events(windows, n, clock).agg(F.sort_array(F.collect_list(event)).alias("drift_events"))
    return totals.withColumn("drift_events", latest.scalar())
