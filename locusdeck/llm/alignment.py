"""Two tokenizers aligned over the bytes of each distinct text, measured by corpus-wide pair counts.

Documents are grouped by their full text, so copies cost one line of a count; each distinct text is tokenised
and aligned once, and its pair counts weigh as often as the text occurs. The aligned pairs are written to the shared
folder with a digest of the text; counting them, comparing them with the best of their B id, and handing the measures
to all documents of a text are joins of small rows.

Over the bytes of one text both tokenizers' tokens end at certain offsets. Between two neighbouring ends, of
either, lies one stretch that a single A and a single B token cover: a link. Offsets where both end cut the text into groups.

Defined results: texts that are NULL or empty, or that the tokens of A or B do not spell byte for byte, have no tokens: zeros and
an empty string; repeated rows and NULL ids are documents of their own; an empty table gives no rows; other columns
are ignored, whatever their names. A long text is tokenised stretch by stretch, cut at spaces no token of either crosses; one
without such spaces as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusdeck.llm.byte_pairs import byte_pairs, stretches
from locusdeck.llm.pieces import encoder
from locusdeck.llm.shared import attach, fits
from locusdeck.session import new_folder

#: Characters of a stretch, and of the stretches that are aligned in one go.
STRETCH, TOGETHER = 1 << 18, 1 << 19
#: Bytes of a row of pair counts in a broadcast table.
PAIR_BYTES = 48
MEASURES = ("n_a", "n_b", "n_groups", "n_links")


class Aligner:
    """Both tokenizers, with the bytes of their tokens."""

    def __init__(self, byte_file: str, piece_file: str):
        self.a, self.b = byte_pairs(byte_file), encoder(piece_file)
        model = self.b.model
        spelled = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        as_byte = [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else None for i, p in enumerate(spelled)]
        self.b_bytes = [x if x is not None else p.replace("▁", " ").encode() for x, p in zip(as_byte, spelled)]
        self.size = [np.array([len(x) for x in t], np.int64) for t in (self.a.bytes_of, self.b_bytes)]
        # Texts of the ids with what stands behind them: inside a group, and at the end of its half.
        tables = [f"{i}{mark}" for n, marks in ((len(self.a.bytes_of), ",|"), (len(self.b_bytes), ",;")) for mark in marks for i in range(n)]
        self.texts = np.array(tables, object)
        self.starts = [0, 2 * len(self.a.bytes_of)]

    def ids(self, stretch: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and B for each stretch, empty where they do not spell it."""
        a = [self.a.encode(" " + t, special=False).astype(np.int64) for t in stretch]
        b = [np.frombuffer(x, "<u4")[1:-1].astype(np.int64) for x in self.b.encode(stretch)]
        none = np.zeros(0, np.int64)
        for k, text in enumerate(stretch):
            data = (" " + text).encode("utf-8", "surrogatepass")
            for ids, table in ((a[k], self.a.bytes_of), (b[k], self.b_bytes)):
                if b"".join(map(table.__getitem__, ids.tolist())) != data:
                    a[k] = b[k] = none
        return a, b

    def align(self, stretch: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, str]]:
        """For each stretch its four MEASURES, its pairs (a << 32 | b) with their counts, and its groups as text.

        A stretch with no tokens at all is one that the tokens do not spell.
        """
        sides = self.ids(stretch)
        count = [np.array([len(x) for x in side]) for side in sides]
        flat = [np.concatenate(side) for side in sides]
        ends = [np.cumsum(size[ids]) for size, ids in zip(self.size, flat)]
        # Both are in order, so merging them is a sort that moves little.
        links = np.sort(np.concatenate(ends), kind="stable")
        links = links[np.r_[True, links[1:] != links[:-1]][: len(links)]]
        at = [np.searchsorted(end, links) for end in ends]
        groups = links[(ends[0][at[0]] == links) & (ends[1][at[1]] == links)]
        # The last byte of each stretch that has any; both sides end there.
        owner = [np.repeat(np.arange(len(stretch)), c) for c in count]
        last = np.zeros(len(stretch), np.int64)
        last[owner[0]] = ends[0]
        last = np.maximum.accumulate(last)
        of = lambda offsets: np.searchsorted(last, offsets, "left")
        pair = flat[0][at[0]] << 32 | flat[1][at[1]]
        link_of = of(links)
        order = np.lexsort((pair, link_of))
        pair, link_of = pair[order], link_of[order]
        new = np.r_[True, (np.diff(pair) != 0) | (np.diff(link_of) != 0)][: len(pair)]
        first = np.flatnonzero(new)
        times = np.diff(np.r_[first, len(pair)])
        n_links = np.bincount(link_of, minlength=len(stretch))
        n_groups = np.bincount(of(groups), minlength=len(stretch))
        n_pairs = np.bincount(link_of[first], minlength=len(stretch))
        parts = np.split(np.stack([pair[first], times]), np.cumsum(n_pairs)[:-1], axis=1)
        # The groups' text: A's half of a group, then B's, each with its mark behind.
        codes, places = [], []
        for side, (ids, end, start) in enumerate(zip(flat, ends, self.starts)):
            group = np.searchsorted(groups, end)
            final = np.r_[group[1:] != group[:-1], True][: len(group)]
            codes.append(start + ids + final * (len(self.size[side])))
            places.append(group * 2 + side)
        merged = np.argsort(np.concatenate(places), kind="stable")
        text = self.texts[np.concatenate(codes)[merged]]
        cuts = np.cumsum(count[0] + count[1])
        told = ["".join(text[e - n : e].tolist())[:-1] for e, n in zip(cuts.tolist(), (count[0] + count[1]).tolist())]
        found = np.stack([count[0], count[1], n_groups, n_links], axis=1)
        return [(m, p[0], p[1], t) for m, p, t in zip(found, parts, told)]


class _Text:
    """The sum over the stretches of one text."""

    def __init__(self, key: bytes, times: int):
        self.key, self.times = key, times
        self.measures = np.zeros(4, np.int64)
        self.pairs: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.sha, self.spelled = hashlib.sha256(), True

    def add(self, found: tuple[np.ndarray, np.ndarray, np.ndarray, str]) -> None:
        measures, pairs, counts, told = found
        self.spelled &= bool(told)
        if self.spelled:
            self.sha.update((";" + told if self.pairs else told).encode())
            self.measures += measures
            self.pairs.append(pairs)
            self.counts.append(counts)
            if len(self.pairs) > 32:
                self.pairs, self.counts = ([x] for x in self.summed())

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pairs) == 1:
            return self.pairs[0], self.counts[0]
        pairs, where = np.unique(np.concatenate(self.pairs), return_inverse=True)
        return pairs, np.bincount(where, np.concatenate(self.counts)).astype(np.int64)

    def row(self) -> tuple:
        if not self.spelled:
            none = np.zeros(0, np.int64)
            return (self.key, self.times, 0, 0, 0, 0, "", none, none)
        return (self.key, self.times, *self.measures.tolist(), self.sha.hexdigest(), *self.summed())


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(byte_file: str, piece_file: str) -> Aligner:
    """The process's aligner for two vocabulary files."""
    if (byte_file, piece_file) not in _aligners:
        _aligners[byte_file, piece_file] = Aligner(byte_file, piece_file)
    return _aligners[byte_file, piece_file]


def aligned_texts(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """(key, times, MEASURES, groups_sha256, pairs, counts) of each distinct text; ``key`` is its SHA-256."""
    texts = docs.filter("text != ''").groupBy("text").agg(F.count("*").alias("times"))
    rows = texts.select(F.unhex(F.sha2("text", 256)).alias("key"), "times", F.col("text").alias("_text"))
    schema = rows.select("key", "times").schema
    for name in MEASURES:
        schema = schema.add(name, "long")
    schema = schema.add("groups_sha256", "string").add("pairs", T.ArrayType(T.LongType())).add("counts", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_file, piece_file)
        waiting: list[tuple[_Text, str]] = []

        def settle() -> None:
            for (text, _), found in zip(waiting, tool.align([s for _, s in waiting])):
                text.add(found)
            waiting.clear()

        def written(texts: list[_Text]) -> pa.RecordBatch:
            kinds = [pa.binary(), *[pa.int64()] * 5, pa.string(), *[pa.list_(pa.int64())] * 2]
            columns = zip(*(t.row() for t in texts))
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], schema.names)

        ready: list[_Text] = []
        size = 0
        for batch in batches:
            for key, times, whole in zip(batch.column(0), batch.column(1), batch.column(2)):
                text = _Text(key.as_py(), times.as_py())
                for stretch in stretches(whole.as_py(), STRETCH):
                    waiting.append((text, stretch))
                    size += len(stretch)
                    if size >= TOGETHER:
                        settle()
                        size = 0
                        if ready:
                            yield written(ready)
                            ready = []
                ready.append(text)
        if waiting:
            settle()
        if ready:
            yield written(ready)

    return rows.mapInArrow(run, schema)


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, count, best) over all documents: how many links hold the pair, and whether no pair of its B id has more."""
    each = texts.select("times", F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
    total = each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum(F.col("x.counts") * F.col("times")).alias("count"))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = total.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return total.withColumn("b", b).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def measured(docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    spark = docs.sparkSession
    folders = [new_folder(spark, f"aligned_{name}") for name in ("texts", "pairs", "measures")]
    own = docs.select(F.col(id_col).alias("_id"), F.col("text").alias("text"))
    aligned_texts(own, byte_file, piece_file).write.option("compression", "zstd").parquet(folders[0])
    texts = spark.read.parquet(folders[0])
    pair_counts(texts).write.parquet(folders[1])
    counts = spark.read.parquet(folders[1])
    each = texts.select("key", F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select(
        "key", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("times")
    )
    if fits(counts, PAIR_BYTES):
        known = each.join(F.broadcast(counts), "pair")
    else:
        known = attach(each, counts.withColumn("weight", F.col("count")), "pair", "weight")
    sums = known.groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    kept = texts.select("key", F.col("times").alias("copies"), *MEASURES, "groups_sha256")
    kept.join(sums, "key", "left").write.parquet(folders[2])
    found = spark.read.parquet(folders[2])
    key = F.when(F.col("text") != "", F.unhex(F.sha2("text", 256)))
    joined = attach(own.select("_id", key.alias("key")), found, "key", "copies")
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return joined.select(
        F.col("_id").alias(id_col), *[zero(c) for c in (*MEASURES, "n_best", "count_sum")],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
