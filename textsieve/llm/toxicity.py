"""Toxicity by maximum-scoring segments of token log-odds.

1. Log-odds of tokens between toxic and other labelled texts, with an
   informative Dirichlet prior from the counts of the whole corpus.  A token's
   features are the word and its stems, counted once a text by Spark.  A
   log-odds z standard deviations from zero is shrunk to z^2 / (z^2 + SHRINK)
   of itself, so little data gives small scores and not an empty model.  At most
   ``MAX_FEATURES`` features (the surest, beyond ``MIN_Z``) are kept, so the model
   that is broadcast has a bounded size.
2. A text is a sequence of token scores (log-odds less a drift, so that the
   expected score is negative).  One linear scan finds all disjoint
   maximum-scoring segments.
3. Extreme-value calibration: lambda solves sum(p e^(lambda s)) = 1 over the
   scores of texts that are not toxic, K is fitted to their best segments, and
   a segment of score S in n tokens has the E-value K n e^(-lambda S).
   Significant segments are summed as -log p, and a logistic curve fitted to
   the labelled texts turns the sum into the score.

Corpus counts cover all texts.  The classifier is fitted on at most
``MAX_LABELLED`` labelled rows (those of the smallest hash), which bounds what
is broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, column, fields, id_and_text, table, whole_row

MAX_FEATURES = 1 << 16
MAX_LABELLED = 20_000
STEMS = (4, 5, 6, 7)
MIN_Z = 1.0
#: z^2 at which half of a log-odds counts
SHRINK = 9.0
#: strength of the corpus prior, as a share of what the toxic texts hold
PRIOR = 0.1
DRIFT = 0.3
#: E-value under which a segment is a finding
SIGNIFICANT = 0.05
CACHE_WORDS = 50_000
#: distinct words that a task counts before it puts them out
COUNT_WORDS = 125_000
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def features(word: str) -> list[str]:
    """The word ("w" before it) and its stems ("s")."""
    return [f"w{word}", *(f"s{word[:k]}" for k in STEMS if len(word) >= k)]


# ---------------------------------------------------------------- model

@dataclass
class Model:
    """(log-odds, z) of the sure features, and the calibration."""

    sure: dict[str, tuple[float, float]]
    lam: float = 1.0
    k: float = 1.0
    slope: float = 1.0
    offset: float = 0.0
    words: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "words": {}}

    def score(self, word: str) -> float:
        """The log-odds of the word's most certain feature, less the drift."""
        s = self.words.get(word)
        if s is None:
            found = [self.sure[f] for f in features(word) if f in self.sure]
            s = max(found, key=lambda x: abs(x[1]))[0] - DRIFT if found else -DRIFT
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            self.words[word] = s
        return s

    def scores(self, words: list[str]) -> np.ndarray:
        known = self.words
        return np.array([known[w] if w in known else self.score(w) for w in words])

    def e_value(self, score: float, n: int) -> float:
        return self.k * n * math.exp(-min(self.lam * score, 700.0))

    def findings(self, words: list[str]) -> list[tuple[int, int, float, float]]:
        """(first token, end, score, E-value) of the significant segments."""
        out = [(a, b, s, self.e_value(s, len(words))) for a, b, s in segments(self.scores(words))]
        return [x for x in out if x[3] < SIGNIFICANT]

    def evidence(self, words: list[str]) -> float:
        """log(1 + sum of -log p) over the significant segments; zero without one."""
        return math.log1p(sum(-math.log(max(-math.expm1(-e), 1e-300)) for *_, e in self.findings(words)))

    def probability(self, evidence: float) -> float:
        x = self.slope * evidence + self.offset
        return 1.0 / (1.0 + math.exp(-x)) if x > -700 else 0.0


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments [a, b) with positive score, left to right, in linear time.

    Runs of tokens of one sign are one item.  A stack keeps candidates with the
    sums left and right of them; a new run joins the candidates from the latest
    one on whose left sum is lower, as long as that raises the score.
    """
    if not len(scores) or scores.max() <= 0:
        return []
    sign = scores > 0
    cuts = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1], [True]]))
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[int, int, float, float, int]] = []  # first, end, left sum, right sum, nearest with lower left sum
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if not sign[a]:
            continue
        left, right = float(total[a]), float(total[b])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append((a, b, left, right, j))
                break
            a, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, r - l) for a, b, l, r, _ in stack]


# ---------------------------------------------------------------- fitting

def _bounded_labels(labels: DataFrame, id_col: str, label_col: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled ids, a deterministic draw; an id with several labels takes the largest."""
    rows = (labels.select(F.col(id_col).cast("long").alias("lid"), F.col(label_col).cast("int").alias("y"))
            .filter("lid is not null and y is not null"))
    draw = rows.withColumn("h", F.xxhash64("lid")).orderBy("h", "lid", F.desc("y")).limit(limit)
    return draw.groupBy("lid").agg((F.max("y") >= 1).cast("int").alias("y"))


def _count_words(marked: DataFrame) -> DataFrame:
    """(word, n, toxic, other): in how many texts, toxic texts and other labelled texts each word is.

    A word counts once a text, so that a text that repeats one word is one piece of evidence.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Counter(), Counter(), Counter()]  # unlabelled, other, toxic

        def flush() -> pa.RecordBatch:
            words = [w for c in held for w in c]
            n = np.array([x for c in held for x in c.values()], np.int64)
            kind = np.repeat([0, 1, 2], [len(c) for c in held])
            for c in held:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n), pa.array(n * (kind == 2)), pa.array(n * (kind == 1))],
                                              names=["word", "n", "toxic", "other"])

        for b in batches:
            for t, y in zip(b.column("text"), b.column("y").to_pylist()):
                held[0 if y is None else 2 if y else 1].update(set(words_of(t.as_py())))
            if sum(map(len, held)) > COUNT_WORDS:
                yield flush()
        yield flush()

    return (marked.mapInArrow(run, "word string, n long, toxic long, other long")
            .groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "toxic", "other")]))


def _sure_features(counts: DataFrame) -> dict[str, tuple[float, float]]:
    """Log-odds with the corpus as Dirichlet prior and z-scores, of the features that are sure."""
    stems = [F.when(F.length("word") >= k, F.concat(F.lit("s"), F.substring("word", 1, k))) for k in STEMS]
    names = F.array_compact(F.array(F.concat(F.lit("w"), F.col("word")), *stems))
    rows = (counts.select(F.explode(names).alias("f"), "n", "toxic", "other")
            .groupBy("f").agg(*[F.sum(c).alias(c) for c in ("n", "toxic", "other")]))
    total = counts.agg(*[F.sum(c).alias(c) for c in ("n", "toxic", "other")]).first()
    if not total["toxic"] or not total["other"]:
        return {}
    strength = PRIOR * total["toxic"]
    prior = F.col("n") * F.lit(strength / total["n"])

    def logit(c: str):
        return F.log((F.col(c) + prior) / (F.lit(total[c] + strength) - F.col(c) - prior))

    odds = logit("toxic") - logit("other")
    z = odds / F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("other") + prior))
    found = (rows.filter("toxic + other > 0").select("f", (odds * z * z / (z * z + SHRINK)).alias("odds"), z.alias("z"))
             .filter(F.abs("z") >= MIN_Z).orderBy(F.abs("z").desc(), "f").limit(MAX_FEATURES).collect())
    return {r["f"]: (r["odds"], r["z"]) for r in found}


def _lambda(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum(p e^(lambda s)) = 1 (the mean score is negative)."""
    p = weights / weights.sum()

    def f(lam: float) -> float:
        return float(np.log(np.sum(p * np.exp(np.minimum(lam * scores, 700.0)))))

    low, high = 1e-6, 1e-3
    while f(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, with targets smoothed by the class sizes and a small ridge."""
    pos, neg = float(y.sum()), float(len(y) - y.sum())
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    w = np.zeros(2)
    a = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - t) + 1e-3 * w
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_labelled: int = MAX_LABELLED) -> Model:
    """Log-odds, extreme-value parameters and score curve.  Without both labels every score is the smoothed base rate.

    An id with several labels has the largest; all rows of a labelled id count
    for the log-odds, and the curve sees their least evidence.  Rows and
    labels without an id are not labelled; null texts hold no words.
    """
    scratch = Scratch(docs.sparkSession)
    drawn = scratch.put("labels", _bounded_labels(labels, id_col, label_col, max_labelled))
    rows = id_and_text(docs, id_col, text_col)
    marked = rows.join(F.broadcast(drawn), rows["id"] == drawn["lid"], "left").select("text", "y")  # <= max_labelled rows
    model = Model(_sure_features(scratch.put("words", _count_words(marked))))
    ys = rows.join(F.broadcast(drawn), rows["id"] == drawn["lid"]).select("id", "text", "y")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def nulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Score counts of the texts that are not toxic (bins of 0.05), and each one's length and best segment."""
        m = sent.value
        bins: Counter = Counter()
        for b in batches:
            best = []
            for t, y in zip(b.column("text"), b.column("y").to_pylist()):
                w = [] if y else words_of(t.as_py())
                if not w:
                    continue
                s = m.scores(w)
                bins.update(np.round(s * 20).astype(int).tolist())
                found = segments(s)
                if found:
                    best.append((len(w), max(x[2] for x in found)))
            yield pa.RecordBatch.from_arrays([pa.array([-1] * len(best), pa.int32()), pa.array([float(x) for x, _ in best], pa.float64()),
                                              pa.array([x for _, x in best], pa.float64())], names=["bin", "n", "best"])
        yield pa.RecordBatch.from_arrays([pa.array(list(bins), pa.int32()), pa.array([float(x) for x in bins.values()], pa.float64()),
                                          pa.array([0.0] * len(bins), pa.float64())], names=["bin", "n", "best"])

    null = scratch.put("nulls", ys.select("text", "y").mapInArrow(nulls, "bin int, n double, best double"))
    hist = null.filter("bin <> -1 or best = 0").groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    score, weight = hist["bin"].to_numpy(float) / 20, hist["n"].to_numpy(float)
    # one pseudo token of each score that the model can give, so that lambda is finite
    top = max((odds for odds, _ in model.sure.values()), default=0.0) - DRIFT
    if top > 0 and len(score):
        model.lam = _lambda(np.append(score, top), np.append(weight, 1.0))
        fit_k = null.filter("bin = -1 and best > 0").agg(
            F.count("*").alias("c"), F.avg("best").alias("s"), F.avg(F.log("n")).alias("n")).first()
        # a Gumbel variable's mean is its mode + 0.5772 / lambda, the mode is log(K n) / lambda
        model.k = math.exp(min(model.lam * fit_k["s"] - 0.5772156649 - fit_k["n"], 0.0)) if fit_k["c"] >= 30 else 0.1
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            x = [m.evidence(words_of(t.as_py())) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(x, pa.float64()), b.column("y")], names=["id", "x", "y"])

    # rows of one id are one labelled text, of the least evidence: at most max_labelled rows reach the driver
    seen = ys.select("id", "text", "y").mapInArrow(evidence, "id long, x double, y int").groupBy("id", "y").agg(F.min("x").alias("x")).toPandas()
    x, y = seen["x"].to_numpy(float), seen["y"].to_numpy(float)
    if len(y):
        model.slope, model.offset = _logistic(x, y)
    else:
        model.slope, model.offset = 0.0, 0.0
    scratch.drop("labels", "nulls", "words")
    return model


# ---------------------------------------------------------------- scoring

def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", passages: bool = False,
          carry: bool = False) -> DataFrame:
    """(id, score), and on request passages: array of (first, end, score, e_value) in tokens, and row (all input columns).

    Null and empty texts have no passage and get the curve's value at zero;
    repeated rows stay and get equal scores; an empty table gives no rows;
    extra columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(column(id_col).cast("long").alias("id"), column(text_col).cast("string").alias("text"), *([whole_row(docs).alias("row")] if carry else []))
    schema = fields("id long, score double" + ", passages array<struct<first:int,end:int,score:double,e_value:double>>" * passages,
                    **({"row": rows.schema["row"].dataType} if carry else {}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            scores, found = [], []
            for t in b.column("text"):  # the words of one text at a time
                w = words_of(t.as_py())
                scores.append(m.probability(m.evidence(w)))
                if passages:
                    found.append([dict(zip(("first", "end", "score", "e_value"), x)) for x in m.findings(w)])
            cols = {"id": b.column("id"), "score": pa.array(scores, pa.float64())}
            if passages:
                kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())]))
                cols["passages"] = pa.array(found, kind)
            if carry:
                cols["row"] = b.column("row")
            yield pa.RecordBatch.from_pydict(cols)

    return rows.mapInArrow(run, schema)


def held_out(col) -> "F.Column":
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_documents(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(docs, labels.filter(~held_out("doc_id")))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit_documents(docs, table(spark, sf_dir, "labels")))
    return out.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"))
