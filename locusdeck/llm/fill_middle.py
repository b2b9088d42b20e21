"""Fill-in-middle texts by a counted regex: one match per row captures prefix, middle and suffix.

A text is a row of units (UNIT: a run of letters, or any one other character). ``regexp_count`` gives their
number n; a keyed hash of the id picks two borders 0 <= a <= b <= n; the row's own pattern, with
possessive groups ``(unit){a}+`` and ``(unit){b-a}+``, splits the text in a single match that never
steps back, and the replacement puts the three parts behind their markers. A row depends on nothing but its id and
text, so there is no shuffle and a lost task repeats its rows alike.

Defined results: NULL counts as empty; texts that are empty or hold a marker stay as they are (form ``plain``), as do
the rows that the hash picks; a NULL id hashes as the empty string; repeated rows give repeated
rows; an empty table gives no rows; other columns are ignored, whatever their names. Counting holds one string for
every unit of one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of the rows that are rearranged, and of these the percent with the suffix first.
RATE, SUFFIX_FIRST = 90, 20
_PARTS = "|".join((PREFIX, SUFFIX, MIDDLE))


def _draws(key: Column) -> list[Column]:
    """Four unsigned 32-bit numbers from a hash of ``key``."""
    digest = F.sha2(key, 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _pattern(first: Column, second: Column) -> Column:
    """The row's pattern: ``first`` units, ``second`` units, the rest."""
    unit = "(?:[A-Za-z]++|[^A-Za-z])"
    counted = lambda n: (F.lit("(" + unit + "{"), n.cast("string"), F.lit("}+)"))
    return F.concat(F.lit(r"(?s)\A"), *counted(first), *counted(second), F.lit(r"(.*)\z"))


def rearranged(
    docs: DataFrame, seed: int = 1, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, id_col: str = "doc_id"
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row; lengths count code points, NULL if plain."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce("text", F.lit("")).alias("_t"), F.array(*_draws(key)).alias("_h"))
    h = [F.col("_h")[i] for i in range(4)]
    counted = rows.withColumn("n", F.regexp_count("_t", F.lit(UNIT)).cast("long"))
    marked = F.col("_t").contains(PREFIX) | F.col("_t").contains(SUFFIX) | F.col("_t").contains(MIDDLE)
    plain = (F.col("_t") == "") | marked | (h[2] % 100 >= rate)
    form = F.when(plain, "plain").when(h[3] % 100 < suffix_first, "spm").otherwise("psm")
    ends = [h[i] % (F.col("n") + 1) for i in range(2)]
    planned = counted.withColumns({"form": form, "_a": F.least(*ends), "_b": F.greatest(*ends)})
    layout = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    put = F.regexp_replace("_t", _pattern(F.col("_a"), F.col("_b") - F.col("_a")), layout)
    done = planned.withColumn("output", F.when(F.col("form") == "plain", F.col("_t")).otherwise(put))
    part = parts(F.col("output"), F.col("form"))
    sized = done.withColumn("_p", F.when(F.col("form") != "plain", F.struct(F.char_length(part[0]).alias("a"), F.char_length(part[1]).alias("b"))))
    length = lambda name: F.col(f"_p.{name}").cast("long")
    return sized.select(
        F.col("_id").alias(id_col), "n", "form", length("a").alias("prefix_chars"), length("b").alias("middle_chars"), "output"
    )


def parts(output: Column, form: Column) -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix of a rearranged text. No part holds a marker, so the markers alone cut it."""
    cut = F.split(output, _PARTS)
    late = F.when(form == "spm", cut[2]).otherwise(cut[1])
    last = F.when(form == "spm", cut[1]).otherwise(cut[2])
    return late, cut[3], last


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of."""
    return F.when(form == "plain", output).otherwise(F.concat(*parts(output, form)))
