"""Benchmark decontamination with spaced seeds: masks that skip token positions tolerate substitutions.

A seed is a hash of the tokens that a mask picks from a window. Seeds of benchmark items and of documents, at
every token of both, are joined. Hits of one document and item on one diagonal are counted: any overlap that is
accepted below has at least ``least_hits`` of them, whichever tokens are substituted, so diagonals with fewer are
left out, and the others are compared token by token. A document is contaminated if some WINDOW
tokens in a row (all of a shorter item) agree in SIMILARITY of their positions.

Defined results: an item of fewer than LEAST tokens is found where it is all of a document's tokens; one without
tokens matches nothing; NULL texts have no
tokens; repeated rows and items give the same hits once; an item that overlaps a document in several places is listed
with the best (the first of equals); a token inserted or deleted ends an overlap, as substitutions only are
tolerated; an empty benchmark or table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import lru_cache
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusdeck.llm.shared import bounded, cut, indices, let, words

# Picked positions of a window; all masks pick as many.
MASKS = ("1111", "11011", "10111", "11101")
LEAST = 5
WINDOW = 20
AROUND = 32
SIMILARITY = 0.8


@lru_cache
def least_hits(length: int, substituted: int) -> int:
    """The fewest seeds that ``length`` tokens share, position by position, with a copy that has so many substituted.

    The worst places are found position by position: what a substitution destroys depends on the last few tokens only.
    """
    span = max(map(len, MASKS))
    # The masks, seen from their last token back: which of the tokens behind it they pick.
    back = [{len(m) - 1 - i for i, c in enumerate(m) if c == "1"} for m in MASKS]
    best = {((), 0): 0}
    for at in range(length):
        following: dict[tuple, int] = {}
        for (last, used), hits in best.items():
            for wrong in (False, True):
                if used + wrong > substituted:
                    continue
                now = (wrong, *last)[:span]
                new = sum(all(not now[k] for k in picked) for picked, m in zip(back, MASKS) if at + 1 >= len(m))
                key = (now[: span - 1], used + wrong)
                following[key] = min(following.get(key, hits + new), hits + new)
        best = following
    return min(best.values())


def _seeds(t: Column, at: Column) -> Column:
    """The seeds of the windows at ``at``, one for each mask that fits."""

    def seed(mask: str) -> Column:
        picked = F.xxhash64(F.lit(mask), *[F.get(t, at + i) for i, c in enumerate(mask) if c == "1"])
        return picked if len(mask) == LEAST - 1 else F.when(at + len(mask) <= F.size(t), picked)

    return F.array(*[seed(mask) for mask in MASKS])


def _windows(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, ``at`` and ``seed`` for every window of the tokens ``t``."""
    starts = indices(F.size("t") - min(map(len, MASKS)) + 1)
    at = rows.select(*keep, "t", F.explode(starts).alias("at"))
    seeds = at.select(*keep, "at", F.explode(_seeds(F.col("t"), F.col("at"))).alias("seed"))
    return seeds.filter("seed IS NOT NULL")


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id"), words(F.col("text")).alias("t")).distinct()


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_hash, item, diag, low, high): the extent of an item's seeds on one diagonal."""
    tokens = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("t"))
    chosen = items.filter(F.size("t") >= LEAST)
    wanted = _windows(chosen, ["item"]).select("item", F.col("at").alias("item_at"), "seed")
    least = [max(1, least_hits(w, w - ceil(w * similarity - 1e-9))) if w >= LEAST else 1 for w in range(window + 1)]
    needed = chosen.select("item", F.array(*map(F.lit, least))[F.least(F.size("t"), F.lit(window))].alias("needed"))
    meet = _windows(tokens, ["doc_id", "text_hash"]).join(bounded(wanted, 40), "seed")
    end = F.max("at") + max(map(len, MASKS))
    meet = meet.groupBy("doc_id", "text_hash", "item", (F.col("at") - F.col("item_at")).alias("diag")).agg(
        F.min("at").alias("low"), end.alias("high"), F.count("*").alias("n")
    )
    found = meet.join(bounded(needed, 24), "item").filter("n >= needed").drop("n", "needed")
    whole = items.filter((F.size("t") > 0) & (F.size("t") < LEAST)).select("item", F.xxhash64("t").alias("all"))
    all_of = tokens.filter((F.size("t") > 0) & (F.size("t") < LEAST)).withColumn("all", F.xxhash64("t"))
    zero = F.lit(0)
    short = all_of.join(bounded(whole, 32), "all").select(
        "doc_id", "text_hash", "item", zero.alias("diag"), zero.alias("low"), F.size("t").alias("high")
    )
    return found.select(*short.columns).unionByName(short)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_hash, item_id, doc_start, doc_end, matched): verified overlaps; positions count tokens.

    One row for each document and item, with the window that agrees best.
    """
    listed = _items(benchmark)
    # Items are told apart by id and text; the number stands for both.
    items = cut(listed.withColumn("item", F.xxhash64("item_id", "t")))
    found = cut(hits(docs, items.select("item", "t"), window, similarity))
    spots = bounded(
        found.select(*[F.col(c).alias(f"_{c}" if c in ("doc_id", "text_hash") else c) for c in found.columns]), 64
    )
    own = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").join(
        spots, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("text_hash").eqNullSafe(F.col("_text_hash"))
    )
    total = items.agg(F.sum(F.size("t") * 24 + F.lit(64))).first()[0] or 0
    texts = items.select(F.col("item").alias("_item"), "item_id", F.col("t").alias("it"))
    both = own.join(bounded(texts, max(1, -(-total // max(1, items.count())))), F.col("item") == F.col("_item"))
    both = both.withColumn("t", words(F.col("text"))).drop("text")
    begin = F.greatest(F.lit(0), -F.col("diag"), F.col("low") - F.col("diag") - AROUND)
    end = F.least(F.size("it"), F.size("t") - F.col("diag"), F.col("high") - F.col("diag") + AROUND)
    ranged = both.withColumns({"begin": begin, "end": end, "w": F.least(F.size("it"), F.lit(window))})
    same = F.transform(
        indices(F.col("end") - F.col("begin")),
        lambda j: (F.get("t", F.col("diag") + F.col("begin") + j) == F.get("it", F.col("begin") + j)).cast("int"),
    )
    agree = lambda s: F.transform(
        indices(F.size(s) - F.col("w") + 1),
        lambda j: F.struct(F.aggregate(F.slice(s, j + 1, F.col("w")), F.lit(0), lambda a, x: a + x).alias("matched"), (-j).alias("j")),
    )
    best = ranged.withColumn("best", F.array_max(let(same, agree)))
    enough = best.filter(F.col("best.matched") >= F.ceil(F.col("w") * similarity - 1e-9))
    start = F.col("diag") + F.col("begin") - F.col("best.j")
    placed = enough.select(
        "doc_id", "text_hash", "item_id",
        F.struct(F.col("best.matched").alias("matched"), (-start).alias("back"), F.col("w")).alias("b"),
    )
    one = placed.groupBy("doc_id", "text_hash", "item_id").agg(F.max("b").alias("b"))
    return one.select(
        "doc_id", "text_hash", "item_id", (-F.col("b.back")).alias("doc_start"),
        (F.col("b.w") - F.col("b.back")).alias("doc_end"), F.col("b.matched").alias("matched"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    bad = cut(contaminated(docs, benchmark).select(F.col("doc_id").alias("__bad_id"), F.col("text_hash").alias("__bad_hash")).distinct())
    hashed = docs.withColumn("__text_hash", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__bad_id")) & (F.col("__text_hash") == F.col("__bad_hash"))
    return hashed.join(bounded(bad, 32), same, "left_anti").drop("__text_hash")
