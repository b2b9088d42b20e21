"""Language ID with a bit-sliced Bloom filter: one lookup tells all languages that hold an n-gram.

Fitting takes a sample of at most ``sample_rows`` labelled rows per language (``SAMPLE_ROWS``),
chosen by a hash. A character trigram of a lower-cased word, with a space at either
end, is entered for a language if it makes up at least ``MIN_SHARE`` of the language's trigrams and
a ``CONTRAST``-th of its largest share in any language. Predicting looks every trigram of the whole
text up in SLOTS slots of language bit masks: the AND of its slots has a bit for each language. The
counts per language are corrected for the slots' fill, and the largest decides.

Defined results: a NULL text or one without a letter is ``und`` with score 0; ties go to the
language that sorts first; a text of which no trigram is known gets the language with most
labelled rows and score 0; without any labelled row every text is ``und``; repeated rows count
as often as they occur; an empty table gives no rows; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusdeck.llm.shared import BLOCK, cut, pieces

SAMPLE_ROWS = 3_000
SLOTS = 1 << 19
PROBES = 2
MIN_SHARE = 1e-5
CONTRAST = 16
UNKNOWN = "und"
_WORD = 64

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, trigram) of every letter with its two neighbours; non-letters count as spaces."""
    lowered = [t.lower() for t in texts]
    flat = "\0" + "\0".join(lowered) + "\0"
    codes = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letter_table()[codes]
    codes = np.where(letter, codes, 32).astype(np.uint64)
    at = np.flatnonzero(letter)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    packed = (codes[at - 1] << np.uint64(42)) | (codes[at] << np.uint64(21)) | codes[at + 1]
    return owner[at - 1], packed


def slots_of(packed: np.ndarray, slots: int, probes: int) -> list[np.ndarray]:
    """The slots of each n-gram, from one mixed 64-bit value."""
    with np.errstate(over="ignore"):
        x = packed * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        step = (x >> np.uint64(32)) | np.uint64(1)
        return [((x + np.uint64(p) * step) % np.uint64(slots)).astype(np.int64) for p in range(probes)]


@dataclass
class LanguageFilter:
    """``masks[word, slot]`` has a bit for each of ``languages``; ``common`` is the usual one."""

    languages: list[str]
    common: int
    masks: np.ndarray
    probes: int = PROBES

    def fill(self) -> np.ndarray:
        """Chance per language that an n-gram it lacks is found all the same."""
        set_ = [
            np.count_nonzero(self.masks[j // _WORD] & np.uint64(1 << (j % _WORD)))
            for j in range(len(self.languages))
        ]
        return (np.array(set_) / self.masks.shape[1]) ** self.probes

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: n-grams, and how many of them each language's filter holds."""
        total = np.zeros(len(texts), np.int64)
        held = np.zeros((len(texts), len(self.languages)), np.int64)
        for part in pieces(texts, BLOCK):
            rows = np.array([i for i, _ in part])
            owner, packed = grams([t for _, t in part])
            owner = rows[owner]
            total += np.bincount(owner, minlength=len(texts))
            where = slots_of(packed, self.masks.shape[1], self.probes)
            for w in range(self.masks.shape[0]):
                found = self.masks[w][where[0]]
                for more in where[1:]:
                    found &= self.masks[w][more]
                for j in range(w * _WORD, min(len(self.languages), (w + 1) * _WORD)):
                    hit = (found >> np.uint64(j % _WORD)) & np.uint64(1)
                    held[:, j] += np.bincount(owner[hit == 1], minlength=len(texts))
        return total, held

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        total, held = self.counts(texts)
        chance = self.fill()
        real = np.maximum(0.0, (held - total[:, None] * chance) / np.maximum(1 - chance, 1e-9))
        sums = real.sum(axis=1)
        best = np.where(sums > 0, real.argmax(axis=1), self.common)
        score = np.where(sums > 0, real.max(axis=1) / np.maximum(sums, 1e-300), 0.0)
        names = [self.languages[b] if n else UNKNOWN for b, n in zip(best, total)]
        return names, np.where(total > 0, score, 0.0)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        for lang in sorted(set(langs)):
            own = [t for t, g in zip(texts, langs) if g == lang]
            for part in pieces(own, BLOCK):
                values, n = np.unique(grams([t for _, t in part])[1], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(n)],
                    ["lang", "gram", "n"],
                )


def fit(
    docs: DataFrame, train: Column, sample_rows: int = SAMPLE_ROWS, slots: int = SLOTS, probes: int = PROBES
) -> LanguageFilter:
    """A filter from ``text`` and ``lang`` of the rows of ``docs`` for which ``train`` holds.

    At most ``sample_rows`` rows of a language are used. What comes to the driver is bounded by the
    languages and the slots.
    """
    spark = docs.sparkSession
    usable = docs.filter(F.coalesce(train, F.lit(False)) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = usable.groupBy("lang").count().collect()
    if not rows:
        return LanguageFilter([], 0, np.zeros((1, slots), np.uint64), probes)
    languages = sorted(r["lang"] for r in rows)
    common = languages.index(min(rows, key=lambda r: (-r["count"], r["lang"]))["lang"])
    # A row's chance is twice its share of the sample, so that only about that many texts are moved.
    most = F.create_map(*[F.lit(x) for r in rows for x in (r["lang"], min(1.0, 2 * sample_rows / r["count"]))])
    order = F.xxhash64("doc_id", "text")
    drawn = F.pmod(order, F.lit(1 << 20)) < most[F.col("lang")] * (1 << 20)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("_order"))
    picked = usable.filter(drawn).select("text", "lang", order.alias("_order"))
    sample = picked.withColumn("_nth", nth).filter(F.col("_nth") <= sample_rows).select("text", "lang")
    counts = cut(
        sample.mapInArrow(_gram_counts, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    totals = {r["lang"]: r["s"] for r in counts.groupBy("lang").agg(F.sum("n").alias("s")).collect()}
    if not totals:
        return LanguageFilter(languages, common, np.zeros((-(-len(languages) // _WORD), slots), np.uint64), probes)
    number = F.create_map(*[F.lit(x) for i, g in enumerate(languages) for x in (g, i)])
    size = F.create_map(*[F.lit(x) for g, s in totals.items() for x in (g, float(s))])
    share = F.col("n") / size[F.col("lang")]
    # One short list per n-gram: a language has at most one row for it.
    held = counts.groupBy("gram").agg(
        F.max(share).alias("top"), F.collect_list(F.struct(number[F.col("lang")].alias("j"), share.alias("s"))).alias("l")
    )
    entered = held.select("gram", F.explode("l").alias("e"), "top").filter(
        (F.col("e.s") >= MIN_SHARE) & (F.col("e.s") * CONTRAST >= F.col("top"))
    ).select("gram", F.col("e.j").alias("j"))

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("gram").to_numpy().view(np.uint64)
            j = batch.column("j").to_numpy()
            for where in slots_of(packed, slots, probes):
                bits = np.left_shift(np.uint64(1), (j % _WORD).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(j // _WORD, pa.int32()), pa.array(where), pa.array(bits.view(np.int64))],
                    ["word", "slot", "bits"],
                )

    filled = (
        entered.mapInArrow(positions, "word int, slot long, bits long")
        .groupBy("word", "slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    )
    masks = np.zeros((-(-len(languages) // _WORD), slots), np.uint64)
    masks[filled["word"].to_numpy(), filled["slot"].to_numpy()] = filled["bits"].to_numpy().view(np.uint64)
    return LanguageFilter(languages, common, masks, probes)


def predict(docs: DataFrame, model: LanguageFilter, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` with lang_pred and score for every row; only ``text`` is looked at."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            names, score = shared.value.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(names, pa.string()), pa.array(score, pa.float64())],
                schema.names,
            )

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)
