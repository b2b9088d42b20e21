"""Layout-aware writes, table definitions, and checks of what was written."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusdeck.functions.layout_keys import with_layout_keys
from locusdeck.operators.normalise import to_schema
from locusdeck.schemas import MIB, Bucket, TableSpec, Truncate
from locusdeck.session import settings
from locusdeck.sources.tables import keep_layout

# Shuffled rows take about this many times the space of the same rows in Parquet.
SHUFFLE_TO_FILE = 3
# A writing task sorts its rows: it gets no more shuffled bytes than it can sort in memory, so large files become several.
SORTED_BYTES = 128 * MIB
# A file counts as larger than declared beyond this many times the declared size.
SIZE_SLACK = 1.5


def _bloom_options(spec: TableSpec) -> dict[str, str]:
    """Bloom filters per column, each as large as its row group's distinct values ask for."""
    options = {f"parquet.bloom.filter.enabled#{name}": "true" for name in spec.bloom}
    return options | ({"parquet.bloom.filter.adaptive.enabled": "true"} if options else {})


def file_sized(spec: TableSpec) -> dict[str, str]:
    """Settings under which a shuffle makes pieces of the table's file size, or of what a task sorts in memory."""
    piece = min(spec.target_file_bytes * SHUFFLE_TO_FILE, SORTED_BYTES)
    return {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(piece)}


def laid_out(df: DataFrame, spec: TableSpec, observe: tuple[Observation, Sequence[Column]] | None = None) -> DataFrame:
    """Rows distributed and sorted for the table's partitions.

    REBALANCE gathers a partition's rows, cuts a partition that is too big for one task into
    several file-sized pieces and packs small ones together. Sorting is local to a task and
    starts with the partition keys, so the writer does not sort again. ``observe`` (an observation and its
    aggregates) sees the rows of the writing tasks, so a repeated task counts once.
    """
    keyed = with_layout_keys(to_schema(df, spec.schema), spec)
    names = spec.partition_names
    order = [F.col(c) for c in names] + [F.col(f"`{c}`").asc_nulls_last() for c in spec.sort_by]
    spread = keyed.hint("rebalance", *names)
    if observe:
        spread = spread.observe(observe[0], *observe[1])
    return spread.sortWithinPartitions(*order)


def write_table(
    df: DataFrame,
    spec: TableSpec,
    path: str,
    mode: str = "append",
    max_records: int = 0,
    table: str | None = None,
    observe: tuple[Observation, Sequence[Column]] | None = None,
) -> None:
    """Write rows in the declared layout; ``max_records`` bounds the rows of a file.

    The layout is kept with the table, and rows are not added to a table that keeps another one. ``table``
    is the table's folder where ``path`` is a part of it.
    """
    spark = df.sparkSession
    # Overwriting a whole table takes its old layout away, too.
    anew = mode == "overwrite" and table is None
    if not anew:
        keep_layout(spark, table or path, spec)
    writer = (
        laid_out(df, spec, observe)
        .write.mode(mode)
        .partitionBy(*spec.partition_names)
        .option("compression", spec.codec)
        .options(**_bloom_options(spec))
    )
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    # Beside other writes of the session, the settings are those of the whole (see ingestion).
    with settings(spark, {} if observe else file_sized(spec)):
        writer.parquet(path)
    if anew:
        keep_layout(spark, path, spec)


# --- definitions -----------------------------------------------------------------------------


def _transform(key) -> str:
    if isinstance(key, Truncate):
        return f"truncate({key.width}, `{key.column}`)"
    if isinstance(key, Bucket):
        return f"bucket({key.count}, `{key.column}`)"
    return f"`{key.column}`"


def create_table_sql(spec: TableSpec, name: str, using: str = "parquet", location: str = "") -> str:
    """CREATE TABLE text.

    With ``iceberg`` the partitioning is hidden and the catalog prunes by it; with ``parquet``
    the partition keys are columns and predicates name them (see ``region``).
    """
    properties = {"locusdeck.table": spec.name}
    if using == "iceberg":
        columns = spec.schema
        keys = [_transform(key) for key in spec.partition_by]
        properties["write.target-file-size-bytes"] = str(spec.target_file_bytes)
        properties["write.parquet.compression-codec"] = spec.codec
        properties["write.distribution-mode"] = "hash"
        for column in spec.bloom:
            properties[f"write.parquet.bloom-filter-enabled.column.{column}"] = "true"
    else:
        columns = spec.stored_schema
        keys = spec.partition_names
        properties |= _bloom_options(spec)
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
    texts = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    place = f" LOCATION '{location}'" if location else ""
    return (
        f"CREATE TABLE {name} ({listed}) USING {using} PARTITIONED BY ({', '.join(keys)})"
        f"{place} TBLPROPERTIES ({texts})"
    )


def sort_order_sql(spec: TableSpec, name: str) -> str:
    """The statement that gives an Iceberg table its sort order."""
    columns = ", ".join(f"`{c}` ASC NULLS LAST" for c in spec.sort_by)
    return f"ALTER TABLE {name} WRITE DISTRIBUTED BY PARTITION LOCALLY ORDERED BY {columns}"


def create_table(
    spark: SparkSession, spec: TableSpec, name: str, using: str = "parquet", location: str = ""
) -> None:
    spark.sql(create_table_sql(spec, name, using, location))
    if using == "iceberg":
        spark.sql(sort_order_sql(spec, name))


def insert_into(df: DataFrame, spec: TableSpec, name: str, using: str = "parquet") -> None:
    """Append to a table made by ``create_table``.

    A table format with hidden partitioning distributes the rows itself.
    """
    if using == "iceberg":
        to_schema(df, spec.schema).writeTo(name).append()
        return
    changed = file_sized(spec) | {"spark.sql.sources.partitionOverwriteMode": "dynamic"}
    with settings(df.sparkSession, changed):
        laid_out(df, spec).write.insertInto(name)


def create_table_as(df: DataFrame, spec: TableSpec, name: str, using: str = "parquet", location: str = "") -> None:
    """Create a table from rows in one step, in the declared layout; without its rows there is no table.

    Fails if the table exists.
    """
    spark = df.sparkSession
    if using == "iceberg":
        keys = [_partitioning(key) for key in spec.partition_by]
        writer = to_schema(df, spec.schema).writeTo(name)
        properties = {f"write.parquet.bloom-filter-enabled.column.{c}": "true" for c in spec.bloom}
        properties |= {"write.target-file-size-bytes": str(spec.target_file_bytes), "write.parquet.compression-codec": spec.codec}
    else:
        keys = [F.col(name) for name in spec.partition_names]
        writer = laid_out(df, spec).writeTo(name).option("compression", spec.codec)
        properties = _bloom_options(spec)
        for key, value in properties.items():
            writer = writer.option(key, value)
    for key, value in (properties | {"locusdeck.table": spec.name}).items():
        writer = writer.tableProperty(key, value)
    if location:
        writer = writer.option("path", location)
    with settings(spark, file_sized(spec)):
        writer.using(using).partitionedBy(*keys).create()


def _partitioning(key) -> Column:
    """A partition key that the table format derives by itself."""
    if isinstance(key, Bucket):
        return F.partitioning.bucket(key.count, key.column)
    if isinstance(key, Truncate):
        return F.call_function("truncate", F.lit(key.width), F.col(key.column))
    return F.col(key.column)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table together with its data, but only one that ``create_table`` made."""
    if not spark.catalog.tableExists(name):
        return
    made = spark.sql(f"SHOW TBLPROPERTIES {name}").filter("key = 'locusdeck.table'").count()
    if not made:
        raise ValueError(f"{name} was not created here")
    spark.sql(f"DROP TABLE IF EXISTS {name} PURGE")


# --- checks ----------------------------------------------------------------------------------


def _run_check(columns: list[str]):
    """Compare neighbouring rows in scan order, batch by batch, per file split."""

    def ordered(left: pd.DataFrame, right: pd.DataFrame) -> pd.Series:
        """Row-wise left <= right over the sort columns, NULLs last."""
        result = pd.Series(True, index=left.index)
        decided = pd.Series(False, index=left.index)
        for name in columns:
            a, b = left[name], right[name]
            no_a, no_b = a.isna(), b.isna()
            both = ~no_a & ~no_b
            less = (no_b & ~no_a) | (both & (a.where(both) < b.where(both)))
            more = (no_a & ~no_b) | (both & (a.where(both) > b.where(both)))
            result = result.mask(~decided & more, False)
            decided = decided | less | more
        return result

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where: tuple | None = None
        first = last = None
        rows = broken = 0

        def summary() -> pd.DataFrame:
            out = {"file": [where[0]], "block": [where[1]], "n": [rows], "broken": [broken]}
            for name in columns:
                out[f"first_{name}"], out[f"last_{name}"] = [first[name]], [last[name]]
            return pd.DataFrame(out)

        for batch in batches:
            for place, piece in batch.groupby(["file", "block"], sort=False):
                piece = piece.reset_index(drop=True)
                if where is not None and place != where:
                    yield summary()
                if place != where:
                    where, rows, broken, first = place, 0, 0, piece.iloc[0]
                else:
                    piece = pd.concat([last.to_frame().T.astype(piece.dtypes), piece])
                    piece = piece.reset_index(drop=True)
                    rows -= 1
                left, right = piece.iloc[:-1], piece.iloc[1:]
                pairs = ordered(left.reset_index(drop=True), right.reset_index(drop=True))
                broken += int((~pairs).sum())
                rows += len(piece)
                last = piece.iloc[-1]
        if where is not None:
            yield summary()

    return check


def sort_violations(stored: DataFrame, spec: TableSpec) -> DataFrame:
    """(file, n, violations): neighbouring rows of a file that are out of the declared order.

    Rows are compared where they are read; only one summary per file split is moved. Split
    borders are compared from the summaries, so files of several splits are checked whole.
    """
    fields = [spec.schema[c] for c in spec.sort_by]
    names = [f"s{i}" for i in range(len(fields))]
    scan = stored.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        *[F.col(f"`{f.name}`").alias(n) for f, n in zip(fields, names)],
    )
    result = T.StructType([T.StructField("file", T.StringType())])
    for name in ("block", "n", "broken"):
        result = result.add(name, T.LongType())
    for name, f in zip(names, fields):
        result = result.add(f"first_{name}", f.dataType).add(f"last_{name}", f.dataType)
    splits = scan.mapInPandas(_run_check(names), result)
    window = Window.partitionBy("file").orderBy("block")
    border = F.lit(False)
    for name in reversed(names):
        before, after = F.lag(f"last_{name}").over(window), F.col(f"first_{name}")
        more = (before.isNull() & after.isNotNull()) | (before > after)
        same = before.eqNullSafe(after)
        border = F.coalesce(more, F.lit(False)) | (same & border)
    follows = F.lag("block").over(window).isNotNull()
    return (
        splits.select("file", "n", "broken", (follows & border).cast("long").alias("at_border"))
        .groupBy("file")
        .agg(F.sum("n").alias("n"), F.sum(F.col("broken") + F.col("at_border")).alias("violations"))
    )


def file_sizes(stored: DataFrame, spec: TableSpec) -> DataFrame:
    """(partition keys, files, rows, bytes, largest, oversized): the files of every partition.

    ``oversized`` counts files that are larger than the declared size by more than the slack of a writer's estimate.
    Only file names and sizes are read, and no column.
    """
    names = spec.partition_names
    each = stored.select(*names, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    files = each.groupBy(*names, "file", "size").agg(F.count("*").alias("n"))
    return files.groupBy(*names).agg(
        F.count("*").alias("files"), F.sum("n").alias("rows"), F.sum("size").alias("bytes"), F.max("size").alias("largest"),
        F.count_if(F.col("size") > int(spec.target_file_bytes * SIZE_SLACK)).alias("oversized"),
    )


def ranged(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """A total order across tasks: range partitions, each sorted; NULLs last."""
    columns = [F.col(c).asc_nulls_last() for c in order]
    spread = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    return spread.sortWithinPartitions(*columns)

