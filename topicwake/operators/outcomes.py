"""Steps that a failing row does not stop: it goes on to the end with the step it failed in and the reason.

A row carries ``_failure``, null or a struct (step, reason). A step works on rows without a failure only, so the first failure of a row is
the one that is kept, and no row is lost: it ends among the good rows or among the dead letters.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAILURE = "_failure"
_KIND = "struct<step: string, reason: string>"

Step = Callable[[DataFrame], DataFrame]


def _fine() -> Column:
    return F.col(FAILURE).isNull()


def begin(rows: DataFrame) -> DataFrame:
    return rows.withColumn(FAILURE, F.lit(None).cast(_KIND))


def _failing(rows: DataFrame, step: str, reason: Column) -> DataFrame:
    failed = F.when(_fine() & reason.isNotNull(), F.struct(F.lit(step).alias("step"), reason.alias("reason")))
    return rows.withColumn(FAILURE, F.coalesce(F.col(FAILURE), failed))


def check(step: str, reason: Column) -> Step:
    """A row for which ``reason``, evaluated on its columns, is not null fails with it."""
    return lambda rows: _failing(rows, step, reason)


def derive(step: str, columns: dict[str, Column], reason: Column | None = None) -> Step:
    """Set ``columns`` of the rows that are fine so far, null elsewhere; then ``reason`` may fail them."""

    def run(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns({n: F.when(_fine(), c) for n, c in columns.items()})
        return rows if reason is None else _failing(rows, step, reason)

    return run


def decode(step: str, value_col: str, schema: T.StructType) -> Step:
    """The fields of a JSON object; a value that is none, or whose fields are of other kinds, fails. The value stays for the dead letter."""
    broken = "_corrupt_record"

    def run(rows: DataFrame) -> DataFrame:
        tolerant = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
        parsed = F.from_json(F.col(value_col).cast("string"), tolerant, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken})
        rows = rows.withColumn("_parsed", parsed)
        bad = F.col("_parsed").isNull() | F.col(f"_parsed.{broken}").isNotNull()
        rows = _failing(rows, step, F.when(bad, F.lit("no JSON object of the stage")))
        return rows.withColumns({n: F.when(_fine(), F.col(f"_parsed.{n}")) for n in schema.fieldNames()}).drop("_parsed")

    return run


def cast(step: str, name: str, kind: str) -> Step:
    """The column as another type; a value that cannot be read as one fails, null stays null."""

    def run(rows: DataFrame) -> DataFrame:
        value = F.col(name).cast("string")
        reason = F.when(value.isNotNull() & F.col(name).try_cast(kind).isNull(), F.concat(F.lit(f"{name} is no {kind}: "), value))
        rows = _failing(rows, step, reason)
        return rows.withColumn(name, F.when(_fine(), F.col(name).try_cast(kind)))

    return run


def guarded(function: Callable[..., pa.Array], kind: pa.DataType) -> Callable[..., pa.Array]:
    """``function`` of Arrow arrays so that a row it fails on does not fail its batch: it gives structs (value, error).

    A batch that fails is halved until single rows fail, which costs a few more calls for each of them. Running out of memory is
    no failure of a row and ends the task, as does anything that is no plain exception.
    """

    def parts(columns: tuple[pa.Array, ...]) -> list[tuple[pa.Array, str | None]]:
        n = len(columns[0])
        try:
            out = function(*columns)
            if len(out) != n:
                raise RuntimeError(f"{n} rows gave {len(out)}")
            return [(out.cast(kind), None)]
        except MemoryError:
            raise
        except Exception as error:  # noqa: BLE001  whatever a row's value leads to is that row's failure
            if n == 1:
                return [(pa.nulls(1, kind), f"{type(error).__name__}: {error}"[:500])]
            half = n // 2
            return parts(tuple(c.slice(0, half) for c in columns)) + parts(tuple(c.slice(half) for c in columns))

    def run(*columns: pa.Array) -> pa.Array:
        found = parts(columns) if len(columns[0]) else []
        values = pa.concat_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x, _ in found]) if found else pa.nulls(0, kind)
        errors = [e for x, error in found for e in [error] * len(x)]
        return pa.StructArray.from_arrays([values, pa.array(errors, pa.string())], names=["value", "error"])

    return run


def apply_arrow(step: str, name: str, function: Callable[..., pa.Array], inputs: list[str], kind: str) -> Step:
    """Set column ``name`` by a function of Arrow arrays; a row for which it raises fails with the exception. Failed rows are not handed to it."""
    arrow = {"double": pa.float64(), "long": pa.int64(), "string": pa.string(), "array<double>": pa.list_(pa.float64())}[kind]
    safe = guarded(function, arrow)

    def only_fine(fine: pa.Array, *columns: pa.Array) -> pa.Array:
        picked = pa.compute.indices_nonzero(fine)
        found = safe(*(c.take(picked) for c in columns))
        place = [None] * len(fine)
        for k, i in enumerate(picked.to_pylist()):
            place[i] = k
        return found.take(pa.array(place, pa.int64()))

    def run(rows: DataFrame) -> DataFrame:
        call = F.arrow_udf(lambda *c: only_fine(*c), f"struct<value: {kind}, error: string>")
        rows = rows.withColumn("_called", call(_fine(), *[F.col(c) for c in inputs]))
        rows = _failing(rows, step, F.col("_called.error"))
        return rows.withColumn(name, F.when(_fine(), F.col("_called.value"))).drop("_called")

    return run


def run_steps(rows: DataFrame, steps: list[Step]) -> DataFrame:
    """``rows`` after all steps, each with its failure or null; nothing is worked out yet."""
    rows = begin(rows)
    for step in steps:
        rows = step(rows)
    return rows


def write_outcomes(done: DataFrame, path: str, good: list[str], dead: list[str]) -> tuple[DataFrame, DataFrame]:
    """Write the outcome of :func:`run_steps` in one pass; returns (good rows, dead letters), read back.

    Good rows have the columns ``good``; dead letters have ``dead``, ``step`` and ``reason``. One write over one read of the source: the rows
    are dealt to two folders as they come.
    """
    names = list(dict.fromkeys([*good, *dead]))
    table = done.select(*names, F.col(f"{FAILURE}.step").alias("step"), F.col(f"{FAILURE}.reason").alias("reason"))
    table.withColumn("failed", F.when(F.col("step").isNull(), 0).otherwise(1)).write.mode("overwrite").partitionBy("failed").parquet(path)
    held = done.sparkSession.read.schema(table.withColumn("failed", F.lit(0)).schema).parquet(path)
    return held.where("failed = 0").select(*good), held.where("failed = 1").select(*dead, "step", "reason")
