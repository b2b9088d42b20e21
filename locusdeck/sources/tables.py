"""Stored tables: Parquet folders in the declared layout, or catalog tables.

The partition keys that a folder was first written with are kept beside the data. Look-ups take
them from there, as keys of another width or bucket count would miss rows.
"""

from __future__ import annotations

from collections.abc import Container, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from locusdeck.schemas import TableSpec
from locusdeck.sources.files import create_text, matching, qualified, read_text

# Readers of Parquet folders pass over names that begin like this.
LAYOUT = "_layout.json"

# --- fixed values: how folder names spell partition values ---
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = "\"#%'*/:=?\\{[]^"
# --- end of fixed values ---


def kept_layout(spark: SparkSession, path: str, spec: TableSpec) -> TableSpec | None:
    """``spec`` under the partition keys kept with the table at ``path``; None if none are kept."""
    text = read_text(spark, f"{path}/{LAYOUT}")
    return spec.with_layout(text) if text else None


def stored_layout(spark: SparkSession, path: str, spec: TableSpec) -> TableSpec:
    """The layout to look rows up with: the kept one, or ``spec`` for a table that keeps none."""
    return kept_layout(spark, path, spec) or spec


def keep_layout(spark: SparkSession, path: str, spec: TableSpec) -> None:
    """Keep the partition keys of a new table; an error if the table is stored by others."""
    create_text(spark, f"{path}/{LAYOUT}", spec.layout_text())
    kept = kept_layout(spark, path, spec)
    if kept is None or kept.partition_by != spec.partition_by:
        raise ValueError(f"{path} is stored by {kept and kept.layout_text()}, not by {spec.layout_text()}")


def read_table(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    extra: T.StructType | None = None,
    folders: Sequence[str] | None = None,
) -> DataFrame:
    """A stored table with its partition keys, or the part of it that lies in ``folders``.

    The schema is stated, so no file is opened to infer it and a numeric contig stays text.
    """
    fields = spec.stored_schema.fields + (extra.fields if extra else [])
    reader = spark.read.schema(T.StructType(fields)).option("basePath", path)
    return reader.parquet(*(folders or [path]))


def _folder_name(value) -> str:
    """A partition value as it stands in a folder's name."""
    if value is None or value == "":
        return NO_VALUE
    return "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 0x20 or ord(c) == 0x7F else c for c in str(value))


def folders_of(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    keys: Iterable[tuple],
    above: str = "",
    only: Container[str] | None = None,
) -> list[str]:
    """The folders of some partitions, found by their names: no other folder of the table is listed.

    A key holds the values of the leading partition keys. ``above`` is a pattern of the folders between
    the table and its keys, of which those in ``only`` count.
    """
    groups: dict[tuple, set[str]] = {}
    for key in keys:
        names = [f"{n}={_folder_name(v)}" for n, v in zip(spec.partition_names, key)]
        groups.setdefault(tuple(names[:-1]), set()).add(names[-1])
    root = qualified(spark, path)
    plain = lambda name: "".join(f"\\{c}" if c in "\\{}[]*?,^" else c for c in name)
    found = []
    for front, last in groups.items():
        pattern = "/".join(filter(None, [root, above, *map(plain, front), "{" + ",".join(sorted(map(plain, last))) + "}"]))
        depth = len(front) + 1
        for folder in matching(spark, pattern):
            upper = folder.removeprefix(root).strip("/").rsplit("/", depth)[0]
            if only is None or upper in only:
                found.append(folder)
    return sorted(found)


def catalog_table(spark: SparkSession, name: str, spec: TableSpec) -> DataFrame:
    """The declared columns of a catalog table, in declared order."""
    return spark.table(name).select(*spec.schema.names)
