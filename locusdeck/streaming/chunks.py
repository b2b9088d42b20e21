"""Ingestion of one very large expression file in chunks of rows, each with its own commit.

A compressed file can be read from its start only, so its rows are parsed once, into a staged Parquet folder that
keeps their order. A chunk is a range of row numbers; its rows are found in the staged row groups by their statistics,
written to the table and stored in its ledger as ``<file>#rows=<first>-<last>``. A run that stops goes on with the first chunk
that is not stored, from the same staged rows; several runs share the chunks out among themselves.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusdeck.operators.layout import file_sized
from locusdeck.schemas import TPM, TPM_TABLE, TableSpec
from locusdeck.session import settings, sibling
from locusdeck.sources import files
from locusdeck.sources.expression import numbered_tpm
from locusdeck.streaming.ingest import POLL, claimed, write_part
from locusdeck.streaming.ledger import LEASE, Ledger

# --- fixed value: rows of a chunk ---
CHUNK_ROWS = 50_000_000
# --- end of fixed value ---


def _staged(spark: SparkSession, book: Ledger, path: str, chunk_rows: int) -> dict:
    """Where the rows of a file lie in order, with the size of its chunks and the rows of its blocks.

    Made once per file, by its name, size and time; what the first run has chosen holds for all.
    """
    place, system = files.place(spark, path)
    status = system.getFileStatus(place)
    key = f"{files.file_key(path, book.files_root)} {status.getLen()} {status.getModificationTime()}"
    record = f"{book.root}/staged/{hashlib.sha256(key.encode()).hexdigest()[:24]}"
    if (told := files.read_text(spark, f"{record}.json")) is None:
        folder = f"{record}-{uuid.uuid4().hex[:12]}"
        # Tasks keep the order of their rows, and each writes one file.
        numbered_tpm(spark, path).write.parquet(folder)
        blocks = spark.read.parquet(folder).groupBy("block").agg(F.min("line_no").alias("first"), F.count("*").alias("n"))
        # One row for each split of the file.
        counted = [[r["block"], r["first"], r["n"]] for r in blocks.orderBy("block").collect()]
        made = {"folder": folder, "chunk_rows": chunk_rows, "blocks": counted}
        if not files.create_text(spark, f"{record}.json", json.dumps(made)):
            files.delete(spark, folder)  # another run was first
        told = files.read_text(spark, f"{record}.json")
    return json.loads(told) | {"record": f"{record}.json"}


def chunks(staged: dict) -> Iterator[tuple[int, int]]:
    """(first, last) row number of every chunk, counted from 0 in file order."""
    total = sum(n for _, _, n in staged["blocks"])
    for first in range(0, total, staged["chunk_rows"]):
        yield first, min(total, first + staged["chunk_rows"]) - 1


def rows_between(spark: SparkSession, staged: dict, first: int, last: int) -> DataFrame:
    """Rows of a range; only row groups that can hold it are read."""
    parts, before = [], 0
    for block, start, n in staged["blocks"]:
        low, high = max(first - before, 0), min(last - before, n - 1)
        if low <= high:
            parts.append((F.col("block") == block) & F.col("line_no").between(start + low, start + high))
        before += n
    return spark.read.parquet(staged["folder"]).filter(reduce(lambda a, b: a | b, parts)).select(*TPM.names)


def ingest_chunks(
    spark: SparkSession,
    path: str,
    target: str,
    chunk_rows: int = CHUNK_ROWS,
    spec: TableSpec = TPM_TABLE,
    max_records: int = 0,
    ledger: str | None = None,
    lease: float = LEASE,
    poll: float = POLL,
) -> int:
    """Store all chunks of an expression file that are not stored yet; returns how many chunks it has.

    The staged rows go when every chunk is stored. Rows of a file that is also ingested whole count twice: the
    ledger keeps chunks and whole files apart.
    """
    spark = sibling(spark)
    book = Ledger.of_tables(spark, [target], ledger, lease)
    staged = _staged(spark, book, path, chunk_rows)
    named = {f"{path}#rows={a}-{b}": (a, b) for a, b in chunks(staged)}

    def write(batch: str, attempt: str, names: list[str]) -> dict[str, dict]:
        rows = rows_between(spark, staged, *named[names[0]])
        with settings(spark, file_sized(spec)):
            found = write_part(rows, "tpm", spec, target, batch, attempt, max_records)
        return {files.qualified(spark, target): found}

    while True:
        seen, late = book.decided(), set()
        done = {r["key"] for r in book.taken([target]).filter(F.col("key").contains("#rows=")).select("key").collect()}
        todo = [n for n in named if files.file_key(n, book.files_root) not in done]
        if all([claimed(book, [name], {"tpm": target}, seen, late, write) for name in todo]):
            break
        time.sleep(min(poll, max(0.05, lease / 5)))
    files.delete(spark, staged["folder"])
    files.delete(spark, staged["record"])
    return len(named)
