"""Read a parquet corpus, repair its columns and number its rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicwake import schemas
from topicwake.session import materialize
from topicwake.sources.inventory import inspect_folder, update_inventory

_CHUNK_BITS = 20


def repair_float16(col: Column) -> Column:
    """Half-precision number from its two little-endian bytes, as a double.

    Spark cannot read FLOAT16 columns but reads their bytes when they are declared binary.
    """
    bits = F.conv(F.hex(F.concat(F.substring(col, 2, 1), F.substring(col, 1, 1))), 16, 10).cast("int")
    sign = F.when(bits.bitwiseAND(0x8000) != 0, -1.0).otherwise(1.0)
    exponent = F.shiftright(bits, 10).bitwiseAND(0x1F)
    fraction = bits.bitwiseAND(0x3FF) / 1024.0
    size = (
        F.when(exponent == 0, fraction * 2.0**-14)
        .when((exponent == 31) & (fraction == 0), F.lit(float("inf")))
        .when(exponent == 31, F.lit(float("nan")))
        .otherwise((1 + fraction) * F.pow(F.lit(2.0), exponent - 15))
    )
    return F.when(col.isNotNull(), sign * size)


def apply_defaults(df: DataFrame, columns: list[str] | None = None, null_as_none: bool = True) -> DataFrame:
    """The raw columns with their defaults, next to whatever else ``df`` has.

    ``columns`` are the ones the files really have. A missing title is an empty text, a null title or
    text becomes the word ``None`` (``null_as_none``), a missing or null score is 0.0, missing or null
    scores are an empty list. Without a text column there is no corpus.
    """
    present = df.columns if columns is None else columns
    if "text" not in present:
        raise ValueError("the corpus has no text column")
    null_text = F.lit("None") if null_as_none else F.lit(None).cast("string")
    no_scores = F.array().cast("array<bigint>")
    defaults = {
        "title": F.coalesce(F.col("title").cast("string"), null_text) if "title" in present else F.lit(""),
        "text": F.coalesce(F.col("text").cast("string"), null_text),
        "score": F.coalesce(F.col("score").cast("double"), F.lit(0.0)) if "score" in present else F.lit(0.0),
        "reddit_scores": (
            F.coalesce(F.col("reddit_scores").cast("array<bigint>"), no_scores)
            if "reddit_scores" in present
            else no_scores
        ),
    }
    return df.withColumns(defaults)


def _files(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    return spark.read.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(*paths)


# How a column's type in a file is declared to Spark; half precision is read as bytes and repaired.
_DECLARED = {
    "halffloat": T.BinaryType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "string": T.StringType(),
    "large_string": T.StringType(),
    "list<int32>": T.ArrayType(T.IntegerType()),
    "list<int64>": T.ArrayType(T.LongType()),
}


def _corpus_columns() -> Column:
    """The corpus columns of a file of the inventory, as ``name=type`` joined by ``|``."""
    kinds = F.from_json("columns", "map<string, string>")
    return F.concat_ws("|", *[F.concat(F.lit(f"{n}="), kinds[n]) for n in schemas.CORPUS.fieldNames()])


def _declared(columns: str) -> T.StructType:
    kinds = dict(c.split("=", 1) for c in columns.split("|") if c)
    return T.StructType([T.StructField(f.name, _DECLARED.get(kinds[f.name], f.dataType)) for f in schemas.CORPUS if f.name in kinds])


def placed_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})


def _file_offsets(per_file: DataFrame) -> DataFrame:
    """(_file, _n, _offset) of (_file, _n): rows of each file and of all files before it in path order.

    Files are ranged over partitions by path; sums run inside a partition, and over the partitions.
    """
    ranged = materialize(per_file.repartitionByRange("_file").withColumn("_part", F.spark_partition_id()), "files")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_part").agg(F.sum("_n").alias("_sum"))
    bases = parts.select("_part", F.coalesce(F.sum("_sum").over(before.orderBy("_part")), F.lit(0)).alias("_base"))
    inside = F.coalesce(F.sum("_n").over(before.partitionBy("_part").orderBy("_file")), F.lit(0))
    return ranged.join(bases, "_part").select("_file", "_n", (F.col("_base") + inside).alias("_offset"))


def rows_per_file(placed: DataFrame) -> DataFrame:
    return placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))


def number_rows(rows: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Dense ``id`` for a parquet scan: files in path order, rows in file order.

    The count per file needs the file metadata only, and the row's place in its file comes with the
    scan, so numbering neither sorts nor windows the rows. They meet the offsets by file and chunk of 2^20 rows: a broadcast where Spark
    measures the table of offsets as small, else an exchange in which a huge file is split.
    """
    placed = placed_rows(rows)
    return number_placed(placed, rows_per_file(placed), max_rows)


def number_placed(placed: DataFrame, per_file: DataFrame, max_rows: int | None = None, start: int = 0) -> DataFrame:
    """``placed`` rows with ``id``, counted on from ``start`` through the files of ``per_file`` (_file, _n); ids of ``max_rows`` and more are left out.

    For a limit the driver learns one path, the last one that is needed; files behind it are not read.
    """
    offsets = _file_offsets(per_file).withColumn("_offset", F.col("_offset") + start)
    chunks = F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("_n") - 1, _CHUNK_BITS))
    offsets = offsets.where("_n > 0").withColumn("_chunk", F.explode(chunks))
    if max_rows is not None:
        offsets = offsets.where((F.col("_offset") < max_rows) & (F.shiftleft("_chunk", _CHUNK_BITS) + F.col("_offset") < max_rows))
    offsets = materialize(offsets.drop("_n"), "offsets")
    if max_rows is not None:
        placed = placed.where(F.col("_file") <= F.lit(offsets.agg(F.max("_file")).first()[0]))
    joined = placed.withColumn("_chunk", F.shiftright("_row", _CHUNK_BITS)).join(offsets, ["_file", "_chunk"])
    numbered = joined.withColumn("id", F.col("_offset") + F.col("_row")).drop("_file", "_row", "_offset", "_chunk")
    return numbered if max_rows is None else numbered.where(F.col("id") < max_rows)


def scan_corpus(
    spark: SparkSession, path: str, max_rows: int | None = None, null_as_none: bool = True, inventory: str | None = None
) -> DataFrame:
    """The raw stage of a folder of parquet files: id, title, text, score, reddit_scores.

    Files may differ: each is read with its own columns and types, and gets the defaults of those it lacks;
    half-precision columns are repaired. A file without a text column is an error. ``inventory`` names a stored table of the files' columns
    and row counts, which is brought up to date; without one, all footers are looked into. Rows are numbered by these counts.
    """
    known = update_inventory(spark, path, inventory) if inventory else inspect_folder(spark, path)
    files = materialize(known.select("file_path", "n_rows", _corpus_columns().alias("columns")), "kinds")
    kinds = [r.columns for r in files.select("columns").distinct().collect()]  # one row a kind of file
    parts = []
    for columns in sorted(kinds):
        declared = _declared(columns)
        mine = files.where(F.col("columns") == columns)
        if "text" not in declared.fieldNames():
            raise ValueError(f"the corpus file {mine.first().file_path} has no text column")
        # one kind of file needs the folder only; several need their files by name, as Spark's reader takes them
        source = path if len(kinds) == 1 else [r.file_path for r in mine.select("file_path").toLocalIterator()]
        rows = placed_rows(_files(spark, source, declared))
        halves = [f.name for f in declared if f.dataType == T.BinaryType()]
        rows = rows.withColumns({name: repair_float16(F.col(name)) for name in halves})
        rows = apply_defaults(rows, declared.fieldNames(), null_as_none)
        parts.append(rows.select("_file", "_row", *schemas.RAW.fieldNames()[1:]))
    if not parts:
        return spark.createDataFrame([], schemas.RAW)
    placed = parts[0]
    for more in parts[1:]:
        placed = placed.unionByName(more)
    per_file = files.select(F.col("file_path").alias("_file"), F.col("n_rows").alias("_n"))
    return number_placed(placed, per_file, max_rows).select(*schemas.RAW.fieldNames())


def list_stage_files(spark: SparkSession, path: str, inventory: str | None = None, id_col: str = "id") -> DataFrame:
    """(file_name, file_path, file_size, n_rows, least_id, greatest_id) of the parquet files of a stage, sorted by path.

    ``file_path`` names a file; several may have one name. With a stored ``inventory``, only files new to it are opened.
    """
    known = update_inventory(spark, path, inventory, id_col) if inventory else inspect_folder(spark, path, id_col)
    name = F.element_at(F.split("file_path", "/"), -1)
    return known.select(name.alias("file_name"), "file_path", "file_size", "n_rows", "least_id", "greatest_id").orderBy("file_path")


def load_stage(spark: SparkSession, path: str, schema: T.StructType, file: str | None = None) -> DataFrame:
    """A stage table, or one of its files by its path below ``path`` or its whole path; no other file is listed or read."""
    if file is None:
        return _files(spark, path, schema)
    return spark.read.schema(schema).parquet(file if re.match(r"/|\w+:", file) else f"{path.rstrip('/')}/{file}")
