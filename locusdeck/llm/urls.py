"""URL filter: host and path rules, then the ratio of two character language models.

URLs that a rule accepts and URLs that a rule rejects train one smoothed variable-order Markov model
each: orders 0 to ORDER, Witten-Bell interpolated from the shorter context to the longer. A URL that no
rule fits is judged by the mean log-likelihood difference of its characters against a threshold,
which is calibrated on URLs with a rule that the models have not seen (one in HELD_OUT, by a hash): the one with the best
balanced accuracy.

Counts of the longest contexts are made once over all URLs; shorter ones are sums of them.

Defined results: a NULL url has empty host and path and is judged as an empty text; without accepted
or without rejected URLs the threshold is 0; scores at the threshold are allowed; repeated rows
count as often as they occur; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusdeck.llm.shared import attach, cut, let

ORDER = 4
UNIT = 1_000_000
STEP = 10_000
#: One url in so many is kept from the models.
HELD_OUT = 5
BEGIN, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# --- fixed values ---
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
# --- end of fixed values ---


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path of a url; both empty without ``://``."""
    mark = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(mark > 0, F.substr(url, mark + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def ruled(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, url, host, path, and the longest rule that fits with its verdict (else NULL)."""
    host, path = host_and_path(F.col("url"))
    placed = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.startswith("path", F.lit(r.path))
        rule = F.when(fits, r.text).otherwise(rule)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return placed.withColumns({"rule": rule, "verdict": verdict})


def _grams(urls: DataFrame, keep: list[str], order: int) -> DataFrame:
    """``keep``, context and character for every character of a url and its end."""
    chars = F.concat(F.array_repeat(F.lit(BEGIN), order), F.filter(F.split("url", ""), lambda c: c != ""), F.array(F.lit(END)))
    each = urls.select(*keep, chars.alias("c")).select(*keep, "c", F.explode(F.sequence(F.lit(order), F.size("c") - 1)).alias("i"))
    context = F.concat(*[F.get("c", F.col("i") - k) for k in range(order, 0, -1)])
    return each.select(*keep, "i", context.alias("context"), F.get("c", F.col("i")).alias("char"))


def _tail(context: Column, k: int) -> Column:
    return F.right(context, F.lit(k)) if k else F.lit("")


def ratios(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """(context, char, uses, ratio): log accepted - log rejected likelihood, in UNIT-ths.

    ``urls``: distinct urls with their row count ``w`` and ``verdict`` (allow, block or NULL).
    """
    yes = F.when(F.col("verdict") == "allow", F.col("w")).otherwise(0)
    no = F.when(F.col("verdict") == "block", F.col("w")).otherwise(0)
    longest = cut(
        _grams(urls.withColumns({"yes": yes, "no": no}), ["yes", "no"], order)
        .groupBy("context", "char")
        .agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"), F.count("*").alias("uses"))
    )
    sums = [F.sum(c).alias(c) for c in ("yes", "no", "uses")]
    zero = longest.groupBy("char").agg(*sums)
    size, n_yes, n_no = zero.agg(F.count("*"), F.sum("yes"), F.sum("no")).first()
    lower = cut(
        zero.select(
            F.lit("").alias("context"), "char",
            ((F.col("yes") + 1) / F.lit(float((n_yes or 0) + size))).alias("p_yes"),
            ((F.col("no") + 1) / F.lit(float((n_no or 0) + size))).alias("p_no"),
        )
    )
    for k in range(1, order + 1):
        own = longest.groupBy(_tail(F.col("context"), k).alias("context"), "char").agg(*sums)
        whole = own.groupBy("context").agg(
            F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"),
            F.count_if(F.col("yes") > 0).alias("kinds_yes"), F.count_if(F.col("no") > 0).alias("kinds_no"),
        )
        shorter = lower.select(F.col("context").alias("shorter"), "char", F.col("p_yes").alias("q_yes"), F.col("p_no").alias("q_no"))
        joined = own.join(whole, "context").withColumn("shorter", _tail(F.col("context"), k - 1)).join(shorter, ["shorter", "char"])

        def mixed(side: str) -> Column:
            seen = F.col(f"all_{side}") + F.col(f"kinds_{side}")
            value = (F.col(side) + F.col(f"kinds_{side}") * F.col(f"q_{side}")) / F.when(seen > 0, seen)
            return F.coalesce(value, F.col(f"q_{side}")).alias(f"p_{side}")

        lower = cut(joined.select("context", "char", "uses", mixed("yes"), mixed("no")))
    ratio = F.round(F.log(F.col("p_yes") / F.col("p_no")) * UNIT).cast("long")
    return lower.select("context", "char", "uses", ratio.alias("ratio"))


def scores(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """(id, score): the mean ratio of a url's characters, in UNIT-ths. ``urls`` has an ``id``, too."""
    known = ratios(urls, order).select(F.concat("context", "char").alias("gram"), "uses", "ratio")
    grams = _grams(urls, ["id"], order).select("id", "i", F.concat("context", "char").alias("gram"))
    rated = attach(grams, cut(known), "gram", "uses")
    return rated.groupBy("id").agg(F.floor(F.sum("ratio") / F.count("*")).cast("long").alias("score"))


def threshold(rated: DataFrame) -> int:
    """The score that parts accepted from rejected urls best, by balanced accuracy; 0 without both kinds.

    Scores are counted in steps of STEP, so the driver gets a bounded histogram.
    """
    step = F.floor(F.greatest(F.lit(-40), F.least(F.lit(40), F.col("score") / UNIT)) * (UNIT // STEP)).cast("int")
    rows = rated.filter("verdict IS NOT NULL").groupBy(step.alias("s"), "verdict").agg(F.sum("w").alias("w")).collect()
    totals = {v: sum(r["w"] for r in rows if r["verdict"] == v) for v in ("allow", "block")}
    if not all(totals.values()):
        return 0
    share: dict[int, float] = {}
    for r in rows:
        share[r["s"]] = share.get(r["s"], 0.0) + (r["w"] / totals["block"] if r["verdict"] == "block" else -r["w"] / totals["allow"])
    best, at, gain = 0.0, min(share), 0.0
    for s in sorted(share):
        gain += share[s]
        if gain > best:
            best, at = gain, s + 1
    return at * STEP


def held_out(url: Column) -> Column:
    """Whether a url is kept from the models, to choose the threshold on."""
    return F.pmod(F.xxhash64(url), F.lit(HELD_OUT)) == 0


def judged(pages: DataFrame, rules: Sequence[Rule] = RULES, order: int = ORDER) -> DataFrame:
    """page_id, host, path, rule, verdict and score for every row of ``pages``."""
    rows = ruled(pages, rules)
    each = rows.groupBy(F.coalesce("url", F.lit("")).alias("url")).agg(F.count("*").alias("w"), F.first("verdict").alias("verdict"))
    urls = cut(each.withColumn("id", F.monotonically_increasing_id()))
    # The models do not know the rules' verdicts on the urls that the threshold is chosen on.
    known = urls.withColumn("verdict", F.when(~held_out(F.col("url")), F.col("verdict")))
    rated = cut(urls.join(scores(known, order), "id").select("url", "w", "verdict", "score"))
    bar = threshold(rated.filter(held_out(F.col("url"))))
    method = F.when(F.col("score") >= bar, "allow").otherwise("block")
    known = rated.select(F.col("url").alias("key"), "w", "score")
    left = rows.withColumn("key", F.coalesce("url", F.lit("")))
    joined = attach(left, known, "key", "w")
    return joined.select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"),
        (F.col("score") / float(UNIT)).alias("score"),
    )
