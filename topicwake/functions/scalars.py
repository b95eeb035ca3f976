"""Small column functions used by the drift, sink and report jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dominant_topic(distribution: Column) -> Column:
    """Index of the largest value; the lowest index wins a tie. No distribution gives -1."""
    best = F.array_position(distribution, F.array_max(distribution)) - 1
    return F.coalesce(best, F.lit(-1)).cast("int")


def round4(values: Column) -> Column:
    return F.transform(values, lambda v: F.round(v, 4))


def _shares(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(values, lambda v: v / total)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (square root, natural log) of two arrays of weights."""

    def gain(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.ln(a / ((a + b) / 2))).otherwise(F.lit(0.0))

    terms = F.zip_with(_shares(p), _shares(q), lambda a, b: gain(a, b) + gain(b, a))
    total = F.aggregate(terms, F.lit(0.0), lambda acc, v: acc + v)
    return F.sqrt(F.greatest(F.lit(0.0), total / 2))


def drift_magnitude(js: Column) -> Column:
    return (
        F.when(js < 0.05, "none").when(js < 0.10, "low").when(js < 0.20, "medium").otherwise("high")
    )


def reduction_pct(original: Column, normalized: Column) -> Column:
    """Share of characters removed; null where there was no text."""
    return F.try_divide((original - normalized).cast("double"), original.cast("double")) * 100


def snippet(text: Column, size: int = 500) -> Column:
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("..."))).otherwise(text)


def first_words(words: Column, n: int) -> Column:
    return F.array_join(F.slice(words, 1, n), ", ")


def page_count(rows: Column, page_size: int = 10) -> Column:
    return F.greatest(F.lit(1), F.ceil(rows / page_size)).cast("long")


def utc_stamp(clock: Column) -> Column:
    """``yyyyMMdd_HHmmss`` in UTC, whatever the session time zone is."""
    return F.date_format(F.to_utc_timestamp(clock, F.current_timezone()), "yyyyMMdd_HHmmss")


def utc_iso(clock: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(clock, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def batch_name(batch_num: Column, stamp: Column) -> Column:
    return F.format_string("batch_%06d_%s", batch_num, stamp)


def json_list(values: Column) -> Column:
    """JSON text of a list, with a blank after each comma."""
    return F.concat(F.lit("["), F.array_join(values.cast("array<string>"), ", ", "null"), F.lit("]"))
