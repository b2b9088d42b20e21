"""Line dedup with a log-template tree: lines whose template recurs across documents are dropped.

The tree has a fixed depth: number of tokens, then DEPTH leading tokens; tokens that hold digits are variable from the
start. A child that is rare goes to its node's wild child: a line goes by the DEPTH tokens after its leading ones, or by its
last DEPTH tokens, where that makes a leaf of more than twice the size. A line is a row of FIELDS fields at most (single tokens;
in longer lines, runs of equal length). In a leaf, the texts that have a field's value in its place are counted;
the value stays part of the template if it is about as frequent as the line's other fields, and is generalised otherwise:
``m`` is the frequency that half of the fields reach (those that make the leaf left aside), and values with less than half
of it are variable, however many there are and wherever they stand. So each line has one template. A line of which half does not
recur has none; a generalised template has to be shared by a DOMINANT-th of its leaf or hold EVIDENCE constant fields,
or else it is a chance agreement of common words.

Grouping by template counts, for
each, the different texts and the families they come from. A text's family is the rarest of its lines of other
leaves, so that copies of one document are one family and texts that only share boilerplate are not. A line is as rare
as the commonest of its parts (runs of PART tokens from both ends), so edits that leave a part whole make no new
family; in a text with more lines of common and rare parts than lines of its own, edits are taken to be everywhere, and all
of the former together give the family. Texts whose lines are all of one leaf have no family: such a line is the whole document, so all of them
count as one family.

A template recurs if enough families hold it, however many texts each of them has. A family with more than half
of the texts is taken for copies of one document, which are left to document dedup: the texts with a part of its rarest line
keep the template's lines and count as one family; all others lose them.

Defined results: lines of fewer than ``min_tokens`` tokens, blank ones among them, always stay; lines of fewer than FULL_TOKENS
need ``short_docs`` families instead of ``min_docs``; a NULL text stays NULL, a text that loses all lines becomes
empty; repeated rows count as one text and lose the same lines; ``n_chars``, if there, follows the text; other columns
stay as they are, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusdeck.llm.components import components
from locusdeck.llm.shared import BROADCAST_BYTES, attach, bounded, cut, fits

DEPTH = 3
FIELDS = 16
DOMINANT, EVIDENCE = 4, 8
#: A line's parts: tokens of each, and the most from either end.
PART, PARTS = 5, 4
MIN_DOCS, SHORT_DOCS = 3, 30
MIN_TOKENS, FULL_TOKENS = 3, 8
WILD = "<*>"


def _lines(docs: DataFrame) -> DataFrame:
    """(text_hash, pos, line) of every line."""
    return docs.select(F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def _tokens(line: Column) -> Column:
    """The tokens of a line, those that hold a digit generalised.

    All of it is plain expressions, which Spark compiles; functions over array elements would be interpreted.
    """
    spaced = F.regexp_replace(line, "[ \\t\\r\\f\\x0b]+", " ")
    masked = F.regexp_replace(spaced, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*", WILD)
    odd = line.rlike("[\\t\\r\\f\\x0b0-9]") | line.contains("  ")
    return F.split(F.trim(F.when(odd, masked).otherwise(line)), " ")


def _part_size(n: Column) -> Column:
    return F.greatest(F.least(n, F.lit(MIN_TOKENS)), F.least(F.floor(n / 2).cast("int"), F.lit(PART)))


def parsed_lines(docs: DataFrame, depth: int = DEPTH, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(text_hash, pos, n, leaf, leaves, parts) of every line that counts, all but the place and n hashed.

    The lines are written before the short ones go: a filter on n would be pushed down and split every line again.
    """
    t, n, k = F.col("t"), F.col("n"), F.col("k")
    rows = _lines(docs).select("text_hash", "pos", _tokens(F.col("line")).alias("t"))
    sized = rows.select("text_hash", "pos", "t", F.size("t").alias("n")).withColumn("k", _part_size(n))
    some = lambda start, kind, size=F.lit(depth): F.xxhash64(n, F.lit(kind), F.slice(t, start, size))
    first = some(F.lit(1), "first")
    later = F.when(n > depth, some(F.lit(depth + 1), "later", F.least(F.lit(depth), n - depth)))
    last = F.when(n > 2 * depth, some(n - depth + 1, "last"))
    ends = [F.when((j + 1) * k <= n, F.xxhash64(F.slice(t, start, k))) for j in range(PARTS) for start in (j * k + 1, n - (j + 1) * k + 1)]
    parts = F.array_except(F.array(*ends), F.array(F.lit(None).cast("long")))
    found = sized.select("text_hash", "pos", "n", first.alias("leaf"), F.array(first, later, last).alias("leaves"), parts.alias("parts"))
    return cut(found).filter(n >= min_tokens)


def _fields(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(place, text_hash, pos, n, leaf, depth_at, size, f0, f1, ...) of the lines of ``chosen``, one row per text and line."""
    placed = _lines(docs).withColumn("place", F.xxhash64("text_hash", "pos"))
    rows = _joined(placed, chosen, "place", "one", 64)
    n, run = F.col("n"), F.col("run")
    rows = rows.withColumn("t", _tokens(F.col("line"))).withColumn("n", F.size("t")).withColumn("run", F.ceil(n / FIELDS).cast("int"))
    each = [F.when(j * run < n, F.xxhash64(F.slice("t", j * run + 1, run))).alias(f"f{j}") for j in range(FIELDS)]
    size = F.ceil(n / run).cast("int").alias("size")
    return rows.select("place", "text_hash", "pos", "n", "leaf", "depth_at", size, *each).distinct()


def _joined(left: DataFrame, right: DataFrame, key: str, weight: str, row_bytes: int) -> DataFrame:
    """The rows of ``left`` whose key is in ``right``, with its columns; hot keys are spread where it is not broadcast."""
    if fits(right, row_bytes):
        return left.join(F.broadcast(right), key)
    found = attach(left, right.withColumn("__hit", F.lit(True)).withColumn("__w", F.col(weight)), key, "__w")
    return found.filter("__hit").drop("__hit")


def _leaves(lines: DataFrame, least: int) -> DataFrame:
    """(place, depth_at, leaf, one) of the lines in a leaf of ``least`` lines; ``place`` is a hash of text and line.

    The leaf is the largest of a line's leaves, where one with a wild child has to be twice as large as the one before;
    ``depth_at`` is its number.
    """
    place = F.xxhash64("text_hash", "pos").alias("place")
    each = lines.select(place, F.posexplode("leaves").alias("depth_at", "leaf")).filter("leaf IS NOT NULL")
    often = cut(each.groupBy("leaf").agg(F.count("*").alias("held")).filter(F.col("held") >= least))
    found = _joined(each, often, "leaf", "held", 64)
    # The size, doubled for every wild child that a leaf has less than the last one, and the number in one.
    rated = (F.col("held") * F.element_at(F.array(F.lit(4), F.lit(2), F.lit(1)), F.col("depth_at") + 1)) * 4 + 2 - F.col("depth_at")
    best = found.groupBy("place").agg(
        F.max(rated).alias("best"), *[F.max(F.when(F.col("depth_at") == i, F.col("leaf"))).alias(f"l{i}") for i in range(3)]
    )
    at = (2 - F.col("best") % 4).cast("int").alias("depth_at")
    named = best.select("place", at, "l0", "l1", "l2")
    leaf = F.when(F.col("depth_at") == 0, F.col("l0")).when(F.col("depth_at") == 1, F.col("l1")).otherwise(F.col("l2"))
    return named.select("place", "depth_at", leaf.alias("leaf"), F.lit(1).alias("one"))


def _templates(docs: DataFrame, lines: DataFrame, least: int, depth: int) -> DataFrame:
    """(text_hash, pos, leaf, full, key) of the lines with a template; the rule is in the module's text."""
    own = cut(_fields(docs, cut(_leaves(lines, least))))
    rows = cut(own.groupBy("leaf").agg(F.count("*").alias("rows")))
    fields = F.array(*[f"f{j}" for j in range(FIELDS)])
    each = own.select("place", "leaf", F.posexplode(fields).alias("j", "field")).filter("field IS NOT NULL")
    each = each.select("place", "j", F.xxhash64("leaf", "j", "field").alias("value"))
    common = cut(each.groupBy("value").agg(F.count("*").alias("held")).filter(F.col("held") >= least))
    kept = _joined(each, common, "value", "held", 64)
    per_line = kept.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("j", "held", "value"))).alias("kept"))
    per_line = cut(per_line.withColumn("one", F.lit(1)))
    light = own.select("place", "text_hash", "pos", "n", "leaf", "depth_at", "size")
    both = _joined(_joined(light, per_line, "place", "one", 64 * FIELDS), rows, "leaf", "rows", 64)
    # Fields that make the leaf say nothing about the rest; only fields of one token do so.
    of_leaf = F.when(F.col("n") > FIELDS, 0).otherwise(
        F.when(F.col("depth_at") == 1, F.least(F.lit(depth), F.col("n") - depth)).otherwise(F.least(F.lit(depth), F.col("n")))
    )
    # A line that its leaf tells whole is left with none; then all of it is constant.
    half = F.ceil((F.col("size") - of_leaf) / 2).cast("int")
    ranked = F.sort_array(F.transform("kept", lambda x: x["held"]), False)
    m = F.when(half == 0, F.col("rows")).otherwise(F.get(ranked, of_leaf + half - 1))
    told = both.withColumns({"m": m, "of_leaf": of_leaf}).filter(F.col("m") >= least)
    told = told.withColumn("constant", F.filter("kept", lambda x: x["held"] * 2 >= F.col("m")))
    evidence = F.size("constant") - F.col("of_leaf")
    whole = F.size("constant") == F.col("size")
    sure = whole | (F.col("m") * DOMINANT >= F.col("rows")) | (evidence >= EVIDENCE)
    key = F.xxhash64("leaf", F.transform("constant", lambda x: x["value"]))
    return told.filter(sure).select("text_hash", "pos", "leaf", (F.col("n") >= FULL_TOKENS).alias("full"), key.alias("key"))


def _families(lines: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(text_hash, first, second): the rarest line of each of ``texts``, and the rarest of another leaf; (node, root) of parts.

    Both lines have ``rows``, ``id`` and ``leaf``. A part in one text only counts no rows, others as many as hold it;
    the commonest part stands for a line. Parts of a rarest line that are about as common are one, so that copies
    with different edits have the same id.
    """
    spread = lines.select("text_hash", F.explode("parts").alias("part")).groupBy("part").agg(
        F.count("*").alias("n"), F.min("text_hash").alias("low"), F.max("text_hash").alias("high")
    )
    shared = cut(spread.filter("low != high").select("part", "n", F.col("n").alias("rows")))
    own = lines.select("text_hash", "leaf", "parts").distinct().join(bounded(texts, 48), "text_hash", "left_semi")
    each = own.select("text_hash", "leaf", F.xxhash64("leaf", "parts").alias("line"), F.explode("parts").alias("part"))
    if fits(shared, 64):
        found = each.join(F.broadcast(shared.drop("n")), "part", "left")
    else:
        found = attach(each, shared, "part", "n")
    held = F.struct(F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), "part")
    per_line = found.groupBy("text_hash", "leaf", "line").agg(F.sort_array(F.collect_list(held), False).alias("parts"))
    top = F.get("parts", F.lit(0))
    like = F.filter("parts", lambda x: (x["rows"] > 0) & (x["rows"] * 2 >= top["rows"]))
    line = F.struct(
        top["rows"].alias("rows"), top["part"].alias("id"), "leaf", F.transform(like, lambda x: x["part"]).alias("like"),
        (F.size("parts") > F.size(like)).alias("mixed"),
    )
    ranked = per_line.groupBy("text_hash").agg(F.array_sort(F.collect_set(line)).alias("all"))
    # An edited copy has more lines of common and rare parts than lines of its own: the former, taken together, are its family.
    mixed = F.filter("all", lambda x: (x["rows"] > 0) & x["mixed"])
    own_lines = F.size(F.filter("all", lambda x: x["rows"] == 0))
    edited = (own_lines > 0) & (F.size(mixed) > own_lines)
    first = F.get("all", F.lit(0))
    other = F.get(F.filter("all", lambda x: x["leaf"] != first["leaf"]), F.lit(0))
    one = F.get(mixed, F.lit(0)).withField("like", F.flatten(F.transform(mixed, lambda x: x["like"])))
    least = cut(
        ranked.select("text_hash", F.when(edited, one).otherwise(first).alias("first"), F.when(edited, one).otherwise(other).alias("second"))
    )
    both = least.select(F.explode(F.array("first", "second")).alias("x")).select(F.col("x.id").alias("a"), F.explode("x.like").alias("b"))
    roots = cut(components(both))
    for name in ("first", "second"):
        known = bounded(roots, 64).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        one = F.struct(F.coalesce("_root", f"{name}.id").alias("id"), f"{name}.leaf")
        least = least.join(known, F.col(f"{name}.id") == F.col("_node"), "left").withColumn(name, one).drop("_node", "_root")
    return least, roots


def _holders(lines: DataFrame, majors: DataFrame, roots: DataFrame) -> DataFrame:
    """(text_hash, major): the texts with a part that gives one of the families ``majors``."""
    wanted = majors.select("major").distinct()
    nodes = roots.join(bounded(wanted, 48), F.col("root") == F.col("major")).select(F.col("node").alias("part"), "major")
    nodes = nodes.unionByName(wanted.select(F.col("major").alias("part"), "major")).distinct()
    parts = lines.select("text_hash", F.explode("parts").alias("part"))
    return parts.join(bounded(nodes, 64), "part").select("text_hash", "major").distinct()


def recurring(
    lines: DataFrame, held: DataFrame, min_docs: int = MIN_DOCS, short_docs: int = SHORT_DOCS
) -> tuple[DataFrame, DataFrame]:
    """(key, texts, major) of the templates that recur, and (text_hash, major) of the texts they are left alone in.

    ``held`` has (text_hash, key, leaf, full) of the lines in question.
    """
    rows = held.distinct()
    families, roots = _families(lines, rows.select("text_hash").distinct())
    family = F.when(F.col("leaf") == F.col("first.leaf"), F.col("second.id")).otherwise(F.col("first.id"))
    texts = cut(rows.join(bounded(families, 200), "text_hash").select("key", "full", family.alias("family"), "text_hash"))
    counts = texts.groupBy("key", "full", "family").agg(F.count("*").alias("c"))
    counted = F.when(F.col("family").isNull(), 1).otherwise(F.col("c"))
    spread = counts.groupBy("key", "full").agg(
        F.sum("c").alias("texts"), F.sum(counted).alias("counted"), F.max(F.struct(counted.alias("c"), "family")).alias("top"),
        F.count("*").alias("families"),
    )
    enough = F.when(F.col("full"), min_docs).otherwise(short_docs)
    major = F.when(F.col("top.c") * 2 > F.col("counted"), F.col("top.family"))
    known = cut(spread.filter(F.col("families") >= enough).select("key", "full", "texts", major.alias("major")))
    majors = known.filter("major IS NOT NULL")
    spared = cut(_holders(lines, majors, roots))
    # The majority's texts are one family, by whichever other lines they differ.
    others = texts.join(bounded(majors.select("key", "major"), 64), "key").join(
        bounded(spared, 64), ["text_hash", "major"], "left_anti"
    )
    others = others.select("key", "family").distinct().groupBy("key").agg(F.count("*").alias("others"))
    kept = majors.join(others, "key").filter(F.col("others") + 1 >= enough)
    columns = ["key", "texts", "major"]
    return known.filter("major IS NULL").select(columns).unionByName(kept.select(columns)), spared


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, short_docs: int = SHORT_DOCS, depth: int = DEPTH) -> DataFrame:
    """(text_hash, positions) of the texts with lines to drop; positions count from 0."""
    lines = parsed_lines(docs, depth)
    own = cut(_templates(docs, lines, min(min_docs, short_docs), depth))
    # A template in fewer texts than the lower bar cannot recur.
    often = cut(own.groupBy("key").agg(F.count("*").alias("held")).filter(F.col("held") >= min(min_docs, short_docs)))
    held = cut(_joined(own, often, "key", "held", 64).drop("held"))
    known, spared = recurring(lines, held.select("text_hash", "key", "leaf", "full"), min_docs, short_docs)
    marked = _joined(held, cut(known), "key", "texts", 96)
    marked = marked.join(bounded(spared, 64), ["text_hash", "major"], "left_anti")
    return marked.groupBy("text_hash").agg(F.collect_set("pos").alias("positions"))


def without_recurring(
    docs: DataFrame, min_docs: int = MIN_DOCS, short_docs: int = SHORT_DOCS, depth: int = DEPTH, counts: bool = False
) -> DataFrame:
    """``docs`` without its recurring lines, the columns as they are; with ``counts`` also n_lines and n_dropped."""
    drops = cut(dropped_lines(docs, min_docs, short_docs, depth)).withColumnRenamed("positions", "__drop_at")
    drops = drops.withColumnRenamed("text_hash", "__text_hash")
    size = drops.agg(F.sum(F.size("__drop_at") * 8 + 64)).first()[0] or 0
    hashed = docs.withColumn("__text_hash", F.xxhash64("text"))
    if size <= BROADCAST_BYTES:
        joined = hashed.join(F.broadcast(drops), "__text_hash", "left")
    else:
        # A text of many copies is one row here; its rows are counted, so that they can be spread.
        weights = hashed.groupBy("__text_hash").agg(F.count("*").alias("__weight"))
        joined = attach(hashed, cut(drops.join(weights, "__text_hash")), "__text_hash", "__weight")
    lines = F.split("text", "\n")
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("__drop_at", i)), "\n")
    changed = F.col("__drop_at").isNotNull()
    out = joined.withColumn("__new", F.when(changed, left).otherwise(F.col("text")))
    values = {c: F.col(f"`{c}`") for c in docs.columns} | {"text": F.col("__new")}
    if "n_chars" in values:
        kind = docs.schema["n_chars"].dataType
        values["n_chars"] = F.when(changed, F.char_length("__new").cast(kind)).otherwise(F.col("n_chars"))
    more = [F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size("__drop_at"), F.lit(0)).cast("long").alias("n_dropped")]
    return out.select(*[v.alias(c) for c, v in values.items()], *(more if counts else []))
