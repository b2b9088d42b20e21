"""SimHash near-duplicates, found by meeting in the middle: balls of half the radius.

A fingerprint emits every variant within half the radius, here one flipped bit and itself. Two
fingerprints within two bits share a variant, and all that share one lie within two bits of each
other. A variant's members are told by the flipped bit, so grouping by variant only ORs bit masks:
at most 65 members, no lists, no pairs within a group. Members are linked to the least of them
after their distance is verified, and components of those links are the groups.

Defined results: a NULL, empty or blank text has fingerprint zero and is linked like any other;
repeated rows stay; a NULL id counts in no minimum, so a group of NULL ids only has component
NULL; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusdeck.llm.components import components
from locusdeck.llm.shared import BLOCK, attach, bounded, cut

SHINGLE = 3
RADIUS = 2
SEED = 42
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _word_blocks(data: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of ``data`` in lists of about a block, each beginning with the last words of the one before."""
    start, carried = 0, []
    while start < len(data):
        end = len(data)
        if end - start > BLOCK:
            space = _SPACE.search(data, start + BLOCK)
            end = space.start() if space else end
        words = carried + data[start:end].split()
        yield words
        carried, start = words[len(words) - size + 1 :] if len(words) >= size else words, end


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64 majority votes over the hashes of the text's shingles; zero without words."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only
    hash_ = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    total, words = 0, []
    for words in _word_blocks(data, size):
        if len(words) < size:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[:-size] + 1).tolist()]
        h = np.fromiter(
            (hash_(line[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist())), np.uint64, len(words) - size + 1
        )
        votes += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
        total += len(h)
    if not total:
        return hash_(b" ".join(words), SEED) if words else 0
    return int(np.packbits(2 * votes > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), size: int = SHINGLE) -> DataFrame:
    """``keep`` and ``fp``, the fingerprint's bits as a signed long, for every row of ``docs``."""
    schema = docs.select(*keep).schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, size) for t in batch.column(len(keep)).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(fps.view(np.int64))], schema.names)

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Verified edges ``(a, b)`` that connect all of ``fp`` within ``radius`` bits (0, 1 or 2).

    Of the members of a ball each is linked to the least one (with radius 1: to the ball's centre).
    """
    if radius not in (0, 1, 2):
        raise ValueError("half the radius may be one bit at most")
    if radius == 0:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter("false")
    flipped = F.when(F.col("i") < 64, F.expr("shiftleft(1L, i)")).otherwise(F.lit(0).cast("long"))
    variants = distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("i")).select(
        F.col("fp").bitwiseXOR(flipped).alias("variant"), flipped.alias("bit"), (F.col("i") == 64).alias("own")
    )
    balls = (
        variants.groupBy("variant")
        .agg(F.bit_or("bit").alias("bits"), F.max("own").alias("own"))
        .filter(F.bit_count("bits") + F.col("own").cast("int") > 1)
    )
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)
    at = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("bits").bitwiseAND(bit(i)) != 0)
    members = F.transform(at, lambda i: F.col("variant").bitwiseXOR(bit(i)))
    own = F.when(F.col("own"), F.array("variant")).otherwise(F.array().cast("array<long>"))
    grouped = balls.select(F.concat(members, own).alias("all"), "variant", "own")
    if radius == 1:
        grouped = grouped.filter("own")
    centre = F.col("variant") if radius == 1 else F.array_min("all")
    pairs = grouped.select(F.explode("all").alias("a"), centre.alias("b")).filter("a != b").distinct()
    return pairs.filter(distance(F.col("a"), F.col("b")) <= radius)


def groups(fps: DataFrame, radius: int = RADIUS, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``fps`` with component_id, the least id reachable over links, and root, the least fingerprint."""
    distinct = cut(fps.groupBy("fp").agg(F.min(id_col).alias("least"), F.count("*").alias("n")))
    rooted = components(links(distinct.select("fp"), radius)).select(F.col("node").alias("fp"), "root")
    # Each fingerprint occurs once on both sides, so neither join can meet a hot key.
    known = cut(distinct.join(rooted, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    best = cut(known.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("m")))
    named = cut(attach(known, best, "root", "m").select("fp", "root", "component_id", "n"))
    return attach(fps, named, "fp", "n")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, root and component_id of every row."""
    return groups(cut(fingerprints(docs, size=size)), radius)


def one_of_each(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay: of every group the one with the least ``doc_id``.

    Rows with the same id, or without one, are told apart by their text; where those tie too they
    are equal but for other columns, and any one stays.
    """
    # Rows travel whole in one column, so their own columns may have any name.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    packed = docs.select(whole, F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    found = cut(near_duplicates(packed, size, radius))
    gone = found.filter(F.col("component_id").isNotNull() & (F.col("doc_id") != F.col("component_id")))
    gone = gone.select("doc_id").distinct()
    kept = packed.join(bounded(gone, 24), "doc_id", "left_anti")
    odd = found.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").select("doc_id")
    if odd.isEmpty():
        return kept.select("row.*")
    odd = cut(odd).select(F.col("doc_id").alias("_odd"))
    same = F.col("doc_id").eqNullSafe(F.col("_odd"))
    regular = kept.join(odd, same, "left_anti").select("row")
    rows = fingerprints(packed.join(odd, same, "left_semi"), ("row", "doc_id", "text"), size)
    component = found.select("fp", "root", "component_id").distinct().withColumnRenamed("fp", "_fp")
    own = rows.join(component, F.col("fp") == F.col("_fp"))
    first = Window.partitionBy("root").orderBy("doc_id", "text")
    left = own.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).withColumn("_nth", F.row_number().over(first))
    return regular.unionByName(left.filter("_nth = 1").select("row")).select("row.*")
