"""Raw files to aligned raw tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.cleaning import nan_to_null, tokens_to_null
from wayfare.schemas import MEASURE, NA_TOKENS, RAW_TRIPS, RAW_ZONES, TRIP_RENAMES, ZONE_RENAMES


def align(
    table: DataFrame, schema: T.StructType, renames: Mapping[str, str] | None = None
) -> DataFrame:
    """Give ``table`` exactly the columns of ``schema``, in its order and types.

    Source names are renamed, then lower-cased. Columns that are missing become NULL,
    others are left out. NaN becomes NULL. One projection, so the scan reads only the
    columns that are used later. Two source columns that come to the same name are an error.
    """
    renames = renames or {}
    found: dict[str, T.StructField] = {}
    for field in table.schema.fields:
        name = renames.get(field.name, field.name).lower()
        if name in found and name in schema.names:
            raise ValueError(f"columns {found[name].name} and {field.name} are both {name}")
        found[name] = field
    columns = []
    for field in schema.fields:
        source = found.get(field.name)
        if source is None:
            value = F.lit(None)
        else:
            value = nan_to_null(F.col(f"`{source.name}`"), source.dataType)
            if isinstance(source.dataType, T.FloatType) and field.dataType == MEASURE:
                value = value.cast("string")  # 0.1 stays 0.1
        value = value.cast(field.dataType)
        if source is not None and isinstance(source.dataType, T.StringType):
            value = nan_to_null(value, field.dataType)
        columns.append(value.alias(field.name))
    return table.select(*columns)


def with_source_file(table: DataFrame) -> DataFrame:
    """Name of the file each row was read from; must follow the scan directly."""
    return table.select("*", F.col("_metadata.file_name").alias("source_file"))


def read_trips(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Trip files (Parquet). A path may hold wildcards, all files it matches are read.

    Files may differ in their columns and in the types of them: each row is aligned as if
    its file had been read alone. A path that matches nothing is an error.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    parts = [part for path in paths for part in _of_one_schema(spark, path)]
    aligned = [align(with_source_file(part), RAW_TRIPS, TRIP_RENAMES) for part in parts]
    return reduce(DataFrame.unionByName, aligned)


def _of_one_schema(spark: SparkSession, path: str) -> list[DataFrame]:
    """The files of ``path``, as few tables as their column types allow.

    Schemas are merged by Spark from all footers. If a column has different types, the footers
    are looked at by tasks, and files of the same schema are read together: a job for the
    footers and one for each schema, however many files there are.
    """
    try:
        return [spark.read.option("mergeSchema", True).parquet(path)]
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    groups: dict[str, list[str]] = {}
    for file, schema in sorted(_schemas(spark, spark.read.parquet(path).inputFiles())):
        groups.setdefault(schema, []).append(file)
    return [spark.read.parquet(*map(unquote, files)) for files in groups.values()]


FOOTERS_OF_A_TASK = 200


def _schemas(spark: SparkSession, files: Sequence[str]) -> list[tuple[str, str]]:
    """Each file (a URI, as Spark lists them) with the columns and types in its footer, read by
    tasks.

    A store that only Spark can open is asked by Spark instead, some files at a time.
    """
    tasks = -(-len(files) // FOOTERS_OF_A_TASK)
    named = spark.createDataFrame([(file,) for file in files], "file string").repartition(tasks)
    found = named.mapInArrow(_footer_reader(), "file string, columns string").collect()
    if all(row["columns"] is not None for row in found):
        return [(row["file"], row["columns"]) for row in found]
    with ThreadPoolExecutor(16) as pool:
        schemas = pool.map(lambda file: spark.read.parquet(unquote(file)).schema.json(), files)
        return list(zip(files, schemas))


def _footer_reader() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Columns and types of Parquet files; NULL for those that cannot be opened from a task.

    A function of its own, which is sent whole: workers need not have this package.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow
        from pyarrow import fs, parquet

        for batch in batches:
            files, columns = batch.column(0).to_pylist(), []
            for file in files:
                try:
                    system, place = fs.FileSystem.from_uri(file)
                    schema = parquet.read_schema(place, filesystem=system)
                    columns.append(schema.remove_metadata().to_string())
                except (OSError, ValueError, ImportError, pyarrow.ArrowException):
                    columns.append(None)
            yield pyarrow.RecordBatch.from_arrays(
                [pyarrow.array(files), pyarrow.array(columns, pyarrow.string())], ["file", "columns"]
            )

    return read


def read_zones(spark: SparkSession, path: str, na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Zone list (CSV with header). Cells equal to one of ``na_tokens`` become NULL."""
    raw = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )
    cells = [tokens_to_null(F.col(f"`{name}`"), na_tokens).alias(name) for name in raw.columns]
    tagged = raw.select(*cells, F.col("_metadata.file_name").alias("source_file"))
    return align(tagged, RAW_ZONES, ZONE_RENAMES)


def stamped(table: DataFrame, column: str = "loaded_at") -> DataFrame:
    """Add the time of the load."""
    return table.withColumn(column, F.current_timestamp())
