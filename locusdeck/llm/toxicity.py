"""Toxicity as multiple-instance learning: documents are labelled, sentences are scored.

A sentence's score is logistic in the features it holds (words and their beginnings); a document's is
the noisy-or of its sentences and a base rate for labels that no sentence explains. Weights
are fitted on document labels only. The sentences that carry the score are then known, too.

Fitting takes at most ``sample_rows`` labelled documents of either label (``SAMPLE_ROWS``), chosen by a hash. Features
are those that are significantly more frequent in toxic documents of the sample; statistics are made
by Spark, and the driver gets, for the sample only, which sentence holds which chosen feature.

Defined results: a NULL or empty text gets the base rate, as does a text without features; without
labels of both kinds every score is 0; several labels of a document count as toxic if one is;
NULL labels and labels of unknown documents are left out; repeated documents give repeated rows; an empty table gives
no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 6_000
#: A feature occurs in at least so many toxic documents, so many times their share of others, so surely.
LEAST_DOCS, LEAST_RATIO, LEAST_Z = 5, 8.0, 5.0
PREFIXES = (4, 5, 6, 7, 8)
STEPS, RATE, DECAY = 400, 0.1, 1e-3
THRESHOLD = 0.7
MEMO_WORDS = 300_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    """The word itself, marked as whole, and its beginnings."""
    return [word + "$", *(word[:n] for n in PREFIXES if len(word) >= n)]


@dataclass
class ToxicityModel:
    """Weights by feature; ``bias`` for a sentence with features, ``base`` for a document."""

    weights: dict[str, float]
    bias: float
    base: float
    memo: dict[str, float] = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "base": self.base, "memo": {}}

    def hits(self, words: list[str]) -> set[str]:
        """The known features of a sentence's words."""
        return {f for w in words for f in features_of(w) if f in self.weights}

    def known(self, word: str) -> bool:
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) > MEMO_WORDS:
                self.memo.clear()
            found = self.memo[word] = any(f in self.weights for f in features_of(word))
        return found

    def sentences(self, text: str | None) -> list[tuple[int, int, float]]:
        """(start, end, score) of the sentences that hold a feature."""
        text = text or ""
        known = self.known
        if not any(known(w) for w in set(_WORD.findall(text.lower()))):
            return []
        out = []
        for m in _SENTENCE.finditer(text):
            found = self.hits([w for w in _WORD.findall(m.group().lower()) if known(w)])
            if found:
                z = self.bias + sum(self.weights[f] for f in found)
                out.append((m.start(), m.end(), float(1 / (1 + np.exp(-z)))))
        return out

    def score(self, scored: list[tuple[int, int, float]]) -> float:
        keep = 1.0 - self.base
        for _, _, p in scored:
            keep *= 1.0 - p
        return 1.0 - keep


def _feature_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        count: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            for f in {f for w in set(_WORD.findall(text.lower())) for f in features_of(w)}:
                count.setdefault(f, [0, 0])[1 if toxic else 0] += 1
        n = list(count.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(count), pa.string()), pa.array([x[0] for x in n], pa.int64()), pa.array([x[1] for x in n], pa.int64())],
            ["feature", "clean", "toxic"],
        )


def labelled(docs: DataFrame, labels: DataFrame, train: Column, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """text and toxic of at most ``sample_rows`` documents of either label for which ``train`` holds."""
    one = labels.filter(F.coalesce(train, F.lit(False)) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    one = one.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    sizes = one.groupBy("toxic").count().collect()
    # About twice the sample of either label is left to be ordered, however many labels there are.
    share = [F.lit(x) for r in sizes for x in (r["toxic"], min(1.0, 2 * sample_rows / r["count"]))]
    if share:
        drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.create_map(*share)[F.col("toxic")] * (1 << 20)
        one = one.filter(drawn)
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    of = lambda toxic: one.filter(F.col("toxic") == toxic).orderBy(*order).limit(sample_rows)
    picked = of(0).unionByName(of(1)).select(F.col("doc_id").alias("_id"), "toxic")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "toxic")


def _fit_weights(rows: np.ndarray, column: np.ndarray, sentence_doc: np.ndarray, label: np.ndarray, n_features: int):
    """Adam on the noisy-or likelihood. rows, column: sentence and feature of every hit."""
    n_docs, n_sent = len(label), len(sentence_doc)
    theta = np.r_[np.full(n_features, 1.0), -1.0, -3.0]  # weights, bias, base rate's logit
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    toxic = label == 1
    for step in range(1, STEPS + 1):
        z = np.bincount(rows, theta[column], n_sent) + theta[-2]
        p = np.clip(1 / (1 + np.exp(-z)), 1e-9, 1 - 1e-9)
        base = 1 / (1 + np.exp(-theta[-1]))
        keep = np.bincount(sentence_doc, np.log1p(-p), n_docs) + np.log1p(-base)
        q = np.minimum(np.exp(keep), 1 - 1e-9)
        push = np.where(toxic, -q / (1 - q), 1.0)  # of the loss by -log keep
        dz = push[sentence_doc] * p
        grad = np.r_[np.bincount(column, dz[rows], n_features), dz.sum(), (push * base).sum()] / n_docs
        grad[:n_features] += DECAY * theta[:n_features] / max(1, n_features)
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        theta = theta - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta


def fit(docs: DataFrame, labels: DataFrame, train: Column, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """A model from the labels for which ``train`` (a condition on doc_id) holds."""
    sample = labelled(docs, labels, train, sample_rows)
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return ToxicityModel({}, 0.0, 0.0)
    counts = (
        sample.select("text", "toxic").mapInArrow(_feature_docs, "feature string, clean long, toxic long")
        .groupBy("feature").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    )
    share = (F.col("c") + F.col("t")) / (n0 + n1)
    gap = F.col("t") / n1 - F.col("c") / n0
    z = gap / F.sqrt(share * (1 - share) * (1 / n0 + 1 / n1))
    chosen = counts.filter(
        (F.col("t") >= LEAST_DOCS) & (F.col("t") * n0 >= LEAST_RATIO * n1 * F.col("c")) & ((share >= 1) | (z >= LEAST_Z))
    )
    names = sorted(r["feature"] for r in chosen.select("feature").collect())
    model = ToxicityModel({f: 0.0 for f in names}, 0.0, 0.0)
    number = {f: i for i, f in enumerate(names)}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels_, docs_, sents, feats = [], [], [], []
            for doc, text, toxic in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "toxic"))):
                hits = [(m, model.hits([w for w in _WORD.findall(text[m[0] : m[1]].lower())])) for m in model.sentences(text)]
                for k, (_, found) in enumerate(hits or [(None, set())]):
                    docs_.append(doc)
                    labels_.append(toxic)
                    sents.append(k)
                    feats.append(sorted(number[f] for f in found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs_, pa.int64()), pa.array(labels_, pa.int32()), pa.array(sents, pa.int32()), pa.array(feats, pa.list_(pa.int32()))],
                ["doc", "toxic", "sentence", "features"],
            )

    rows = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "toxic").mapInArrow(
        held, "doc long, toxic int, sentence int, features array<int>"
    ).collect()
    rows.sort(key=lambda r: (r["doc"], r["sentence"], r["features"]))
    doc_no: dict[int, int] = {}
    label: list[int] = []
    sentence_doc, at, column = [], [], []
    for r in rows:
        if r["doc"] not in doc_no:
            doc_no[r["doc"]] = len(label)
            label.append(r["toxic"])
        if r["features"]:
            at += [len(sentence_doc)] * len(r["features"])
            column += r["features"]
            sentence_doc.append(doc_no[r["doc"]])
    theta = _fit_weights(
        np.array(at, np.int64), np.array(column, np.int64), np.array(sentence_doc, np.int64), np.array(label), len(names)
    )
    weights = dict(zip(names, theta[: len(names)].tolist()))
    return ToxicityModel(weights, float(theta[-2]), float(1 / (1 + np.exp(-theta[-1]))))


def scored(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep``, score, and the sentence that carries most of it: its start, end and own score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*keep).schema
    for name, kind in (("score", "double"), ("worst_start", "integer"), ("worst_end", "integer"), ("worst_score", "double")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = shared.value
        for batch in batches:
            found = [tool.sentences(t) for t in batch.column(len(keep)).to_pylist()]
            worst = [max(f, key=lambda s: (s[2], -s[0])) if f else (None, None, None) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(keep)],
                    pa.array([tool.score(f) for f in found], pa.float64()),
                    pa.array([w[0] for w in worst], pa.int32()),
                    pa.array([w[1] for w in worst], pa.int32()),
                    pa.array([w[2] for w in worst], pa.float64()),
                ],
                schema.names,
            )

    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def offending(docs: DataFrame, model: ToxicityModel, least: float = 0.5) -> DataFrame:
    """(doc_id, start, end, sentence, score) of every sentence scored ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select("doc_id").schema.add("start", "integer").add("end", "integer").add("sentence", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for a, b, p in shared.value.sentences(text):
                    if p >= least:
                        for column, value in zip(out, (doc, a, b, text[a:b], p)):
                            column.append(value)
            kinds = (batch.schema.field(0).type, pa.int32(), pa.int32(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
