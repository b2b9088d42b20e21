"""SpotSigs fingerprints: chains of content words that follow a common word.

A spot is a common word (an anchor) directly before a content word; its signature is a hash of the anchor
and the next CHAIN content words, common words between them skipped. A fingerprint is the set of a text's
signatures. Two fingerprints are alike by the Jaccard similarity of the sets; a pair whose sizes
alone rule a threshold out is not compared.

Defined results: a NULL text counts as empty; a text without a spot has one signature, of all its words;
equal texts have equal fingerprints; repeated rows stay, tied ids are ordered by text, rows without
id come last; a single document is its own next one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusdeck.llm.shared import attach, cut, indices, let, words

CHAIN = 2
SIMILARITY = 0.8
#: Groups of neighbouring ids that are ordered together: rows of one, and the most of them.
GROUP_ROWS, MOST_GROUPS_LOG2 = 4_000, 14

# --- fixed values: common words of the corpus languages ---
ANCHORS = (
    "a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the "
    "their there they this to was we were which will with you "
    "am auf aus bei das dass dem den der des die ein eine einem einen einer er es für im ist mit nicht sich sie sind "
    "und von war wie wird zu zum zur über "
    "au aux avec ce cette dans de du elle en est et il ils je la le les leur mais ne nous ou par pas plus pour qu que "
    "qui sa se ses son sont sur un une vous "
    "al como con del el ella ellos era esta este la las lo los más mi no o para pero por que se ser si sin su sus un y"
).split()
# --- end of fixed values ---


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The text's signatures as a sorted array of distinct longs below 2**32."""
    common = sorted(set(ANCHORS))
    short = lambda *parts: F.pmod(F.xxhash64(*parts), F.lit(1 << 32))

    def of(t: Column) -> Column:
        def spots(content: Column) -> Column:
            at = lambda k: F.get(content, k)
            starts = F.filter(
                indices(F.size(content) - chain + 1),
                lambda k: (at(k) > 0) & ((k == 0) | (at(k - 1) < at(k) - 1)),
            )
            return F.transform(
                starts, lambda k: short(F.get(t, at(k) - 1), *[F.get(t, at(k + j)) for j in range(chain)])
            )

        content = F.filter(indices(F.size(t)), lambda i: ~F.get(t, i).isin(common))
        whole = F.array(short(t))
        found = let(let(content, spots), lambda s: F.when(F.size(s) > 0, F.array_distinct(s)).otherwise(whole))
        return F.array_sort(found)

    return let(words(text), of)


def as_text(signs: Column) -> Column:
    """A fingerprint as text: eight hex digits for each signature."""
    return F.array_join(F.transform(signs, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints."""
    return let(
        F.size(F.array_intersect(a, b)), lambda both: both.cast("double") / (F.size(a) + F.size(b) - both).cast("double")
    )


def _groups(ids: DataFrame) -> tuple[Column, int]:
    """A column that numbers ranges of ``doc_id`` in ascending order; -1 without an id.

    The borders are approximate quantiles, at most 2**MOST_GROUPS_LOG2; the search for a row's range is binary.
    """
    rows = ids.count()
    levels = min(MOST_GROUPS_LOG2, max(0, (rows // GROUP_ROWS).bit_length()))
    if not levels:
        return F.when(F.col("doc_id").isNull(), -1).otherwise(0), rows
    share = [i / (1 << levels) for i in range(1, 1 << levels)]
    borders = ids.agg(F.percentile_approx("doc_id", share, 20 << levels)).first()[0] or []
    known = F.lit(sorted(set(borders))).cast("array<long>")
    step = lambda s: F.call_function("shiftleft", F.lit(1), F.lit(levels - 1) - s)
    found = F.aggregate(
        F.sequence(F.lit(0), F.lit(levels - 1)),
        F.lit(0),
        lambda acc, s: acc + F.when(F.get(known, acc + step(s) - 1) <= F.col("doc_id"), step(s)).otherwise(0),
    )
    return F.when(F.col("doc_id").isNull(), -1).otherwise(found), rows


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with ``next_<column>``: the values of the next row by descending ``doc_id``, then ``text``.

    Rows are ordered inside ranges of ids. The first rows of a range are copied to the end of the one above,
    those of the highest range to the lowest, so every row finds its next one in its own range.
    """
    group, _ = _groups(docs.select("doc_id"))
    placed = docs.withColumn("_group", group)
    tops = docs.select("doc_id", group.alias("_group")).groupBy("_group").agg(F.max("doc_id").alias("_top"))
    # A row for each range, of which there are 2**MOST_GROUPS_LOG2 at most.
    up = Window.partitionBy(F.lit(0)).orderBy("_group")
    above = F.lead("_group").over(up)
    lowest = F.min("_group").over(Window.partitionBy(F.lit(0)))
    borders = F.broadcast(tops.select("_top", F.coalesce(above, lowest).alias("_to"), F.col("_group").alias("_from")))
    copies = placed.join(
        borders, F.col("doc_id").eqNullSafe(F.col("_top")) & (F.col("_group") == F.col("_from"))
    ).withColumn("_group", F.col("_to")).select(*placed.columns, F.lit(1).alias("_copy"))
    rows = placed.withColumn("_copy", F.lit(0)).unionByName(copies)
    order = Window.partitionBy("_group").orderBy("_copy", F.col("doc_id").desc_nulls_last(), "text")
    led = [F.lead(c).over(order).alias(f"next_{c}") for c in columns]
    return rows.select("*", *led).filter("_copy = 0").drop("_group", "_copy")


def fingerprinted(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """doc_id, text, signs: the fingerprint of every document."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("signs", signatures(F.col("text"), chain))


def edited(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """Every document with its edited text, both fingerprints, and how alike they and the next one's are.

    The last half of the code points is replaced by the first as many of the next document.
    """
    led = with_next(fingerprinted(docs, chain), ["text", "signs"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    changed = led.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    )
    both = changed.drop("next_text").withColumn("edited_signs", signatures(F.col("edited"), chain))
    return both.withColumns(
        {"near_edited": likeness(F.col("signs"), F.col("edited_signs")), "near_next": likeness(F.col("signs"), F.col("next_signs"))}
    )


def near_pairs(docs: DataFrame, similarity: float = SIMILARITY, chain: int = CHAIN) -> DataFrame:
    """(a, b, similarity): pairs of representatives (least ids) of equal fingerprints, alike by ``similarity`` or more.

    Sets are partitioned by length: a set meets those of its own length range and the next shorter
    one. Within a partition only sets that share one of their rarest signatures are compared
    (as many as a similar pair must share at least), and only if their lengths allow it.
    """
    sets = cut(
        fingerprinted(docs, chain).filter("doc_id IS NOT NULL").groupBy("signs").agg(F.min("doc_id").alias("id"))
        .withColumn("size", F.size("signs"))
    )
    each = sets.select("id", "size", F.explode("signs").alias("sign"))
    counts = cut(each.groupBy("sign").agg(F.count("*").alias("n"), F.count("*").alias("df")))
    rare = attach(each, counts, "sign", "n").groupBy("id", "size").agg(F.sort_array(F.collect_list(F.struct("df", "sign"))).alias("all"))
    needed = F.ceil(F.col("size") * similarity - 1e-9).cast("int")
    prefix = rare.select("id", "size", F.explode(F.slice("all", 1, F.col("size") - needed + 1)).alias("s")).select(
        "id", "size", F.col("s.sign").alias("sign")
    )
    part = F.floor(F.log(F.col("size").cast("double")) / log(1 / similarity)).cast("int")
    left = prefix.select(F.col("id").alias("a"), F.col("size").alias("size_a"), "sign", part.alias("part"))
    right = prefix.select(
        F.col("id").alias("b"), F.col("size").alias("size_b"), "sign", F.explode(F.array(part, part + 1)).alias("part")
    )
    fit = (F.col("size_b") < F.col("size_a")) | ((F.col("size_b") == F.col("size_a")) & (F.col("b") < F.col("a")))
    fit &= F.col("size_b") >= F.col("size_a") * similarity - 1e-9
    found = left.join(right, ["sign", "part"]).filter(fit).select("a", "b").distinct()
    signs = sets.select("id", "signs")
    joined = found.join(signs.select(F.col("id").alias("a"), F.col("signs").alias("sa")), "a").join(
        signs.select(F.col("id").alias("b"), F.col("signs").alias("sb")), "b"
    )
    return joined.select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("similarity")).filter(F.col("similarity") >= similarity)
