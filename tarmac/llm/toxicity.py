"""Toxic passages by maximum-scoring segments over token log-odds.

*Model.* Words and word beginnings of labelled training rows are counted per label, once for each text that has them; log-odds between toxic and other rows use
an informative Dirichlet prior (pseudo-counts in proportion to the frequency over both labels) and are kept where they are
so far above chance that, by their number, at most ``FALSE_SHARE`` of the kept ones are there by chance. A token scores the largest log-odds among its features, less a drift; tokens without one score
the drift alone, so the expected score of clean text is negative.

*Search.* One linear scan finds all maximal-scoring segments of a text, that is every passage whose score neither a longer nor
a shorter one improves.

*Calibration.* Scores of the best segment in clean text follow an extreme-value law P(S > x) = 1 - exp(-K n exp(-lambda x)).
lambda solves sum p(s) exp(lambda s) = 1 over clean tokens, K is the likelihood estimate over clean training rows. Segments
with an expected number under ``SIGNIFICANT`` count; their excess over chance is summed and a logistic curve, fitted on the
training rows, turns the sum into a score between 0 and 1.

The model is fitted on at most ``MOST_TRAINING_ROWS`` labelled rows, one for each id, so what the driver and the workers hold is
bounded. Scoring is one scan without a shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.arrays import REMEMBERED
from tarmac.plans.storage import materialize

#: Labelled rows the model is fitted on: those with the smallest hashes of their id.
MOST_TRAINING_ROWS = 20_000
PREFIXES = (3, 4, 5, 6, 7, 8)
#: Pseudo-counts of the prior for each feature counted.
PRIOR_SHARE = 0.001
#: Share of features kept by chance alone, among all kept; and toxic texts that must have a feature to be tested.
FALSE_SHARE = 0.001
LEAST_COUNT = 3
LEAST_ODDS = 3.0
DRIFT = 0.5
SIGNIFICANT = 0.001
THRESHOLD = 0.7
_EDGES = ".,;:!?#$%&@+=|/\\~^\"'()[]{}<>*_-–—…«»„“”‚‘’¿¡"


def features(token: str) -> list[str]:
    """Features of one lower-cased token: the word, marked by a leading blank, and its beginnings; none for punctuation."""
    word = token.strip(_EDGES)
    if not word or word == "#":
        return []
    return [" " + word, *[word[:k] for k in PREFIXES if len(word) > k]]


def maximal_segments(places: list[int], scores: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first token, last token, score) of a sequence that scores ``-drift`` except at ``places``.

    Kept segments have left totals and right totals; a new one joins back to the nearest kept segment that began lower, as
    long as that one also ended lower. Every token enters and leaves the list once.
    """
    kept: list[tuple[float, float, int, int]] = []  # total before, total after, first, last
    total, after = 0.0, 0
    for place, score in zip(places, scores, strict=True):
        total -= drift * (place - after)
        left, right, first = total, total + score, place
        total, after = right, place + 1
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][0] >= left:
                j -= 1
            if j < 0 or kept[j][1] >= right:
                break
            left, first = kept[j][0], kept[j][2]
            del kept[j:]
        kept.append((left, right, first, place))
    return [(first, last, right - left) for left, right, first, last in kept]


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    rate: float = 1.0
    k: float = 1.0
    intercept: float = -30.0
    slope: float = 0.0

    def scorer(self) -> "TokenScores":
        return TokenScores(self.weights)

    def passages(self, n: int, segments: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
        """Significant segments with their excess over chance."""
        chance = math.log(max(self.k * n, 1e-300)) if n else 0.0
        found = [(a, b, self.rate * s - chance) for a, b, s in segments]
        return [x for x in found if x[2] > -math.log(SIGNIFICANT)]

    def score(self, excess: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, self.intercept + self.slope * math.log1p(excess)))))


class TokenScores(dict):
    """Score of each token met, 0 where only the drift counts."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self._weights = weights

    def __missing__(self, token: str) -> float:
        if len(self) > REMEMBERED:
            self.clear()
        known = [self._weights[f] for f in features(token) if f in self._weights]
        self[token] = value = max(max(known, default=0.0) - DRIFT, 0.0)
        return value

    def segments(self, text: str) -> tuple[int, list[int], list[float], list[tuple[int, int, float]]]:
        tokens = text.lower().split()
        values = list(map(self.__getitem__, tokens))
        places = [i for i, v in enumerate(values) if v]
        scores = [values[i] for i in places]
        return len(tokens), places, scores, maximal_segments(places, scores, DRIFT)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    """(text, toxic) of the chosen labelled ids, one row each (of a repeated id the text with the smallest hash, and toxic if a label says so); rows without an id or label, and held-out rows, are never among them."""
    usable = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_toxic")).where("_id is not null and _toxic is not null")
    usable = usable.where(~held_out("_id")).groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    chosen = usable.orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(most)
    chosen = F.broadcast(materialize(chosen, "training-ids"))  # at most ``most`` rows
    texts = docs.select(F.col(id_col).alias("_id"), _text(text_col).alias("_text")).join(chosen, "_id")
    # one text for each id, so that repeated ids do not pass the bound
    one = F.min_by("_text", F.struct(F.xxhash64("_text").alias("h"), F.col("_text").alias("t")))
    return texts.groupBy("_id", "_toxic").agg(one.alias("_text")).select("_text", "_toxic")


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for toxic, texts in batch.groupby("_toxic")["_text"]:
            # a text counts once for each feature: repeats within a text are one author's habit
            found: Counter[str] = Counter()
            total = 0
            for text in texts:
                own = {f for token in set(text.lower().split()) for f in features(token)}
                found.update(own)
                total += len(own)
            found[""], found["#"] = total, len(texts)
            yield pd.DataFrame({"feature": list(found), "_toxic": int(toxic), "n": list(found.values())})


def _sketch(texts: pd.Series) -> pd.Series:
    """Smallest hash of a text's neighbouring word pairs: the same for most near copies, hardly ever for other texts."""
    out = []
    for text in texts:
        tokens = text.lower().split()
        pairs = {f"{a} {b}" for a, b in zip(tokens, tokens[1:])} or {" ".join(tokens)}
        out.append(min(xxhash.xxh64_intdigest(p) for p in pairs) >> 1)
    return pd.Series(out, dtype="int64")


def feature_weights(training: DataFrame) -> dict[str, float]:
    """Log-odds of the features that tell toxic rows, those that pass the bound on false ones."""
    # near copies are one witness, however many they are
    witnesses = training.withColumn("_w", F.pandas_udf(_sketch, "long")("_text")).groupBy("_w", "_toxic").agg(F.min("_text").alias("_text")).select("_text", "_toxic")
    counted = witnesses.mapInPandas(_counts, "feature string, _toxic int, n long")
    toxic, clean = F.sum(F.when(F.col("_toxic") == 1, F.col("n")).otherwise(0)), F.sum(F.when(F.col("_toxic") == 1, 0).otherwise(F.col("n")))
    counted = materialize(counted.groupBy("feature").agg(toxic.alias("t"), clean.alias("c")).where(F.col("t") > 0), "feature-counts")
    total = counted.where("feature = ''").first()
    if total is None or not total.t or not total.c:
        return {}
    t_all, c_all = float(total.t), float(total.c)
    words = counted.where(~F.col("feature").isin("", "#")).where(F.col("t") >= LEAST_COUNT)
    both = F.col("t") + F.col("c")
    strength = PRIOR_SHARE * (t_all + c_all)
    prior = PRIOR_SHARE * both
    t, c = F.col("t") + prior, F.col("c") + prior
    odds = F.ln(t / (t_all + strength - t)) - F.ln(c / (c_all + strength - c))
    # certainty: signed root of twice the log-likelihood gained over chance, about normal also for small counts
    expected = both * (t_all / (t_all + c_all))
    gain = F.col("t") * F.ln(F.col("t") / expected) + F.when(F.col("c") > 0, F.col("c") * F.ln(F.col("c") / (both - expected))).otherwise(0.0)
    z = F.when(F.col("t") > expected, F.sqrt(F.greatest(2 * gain, F.lit(0.0)))).otherwise(0.0)
    sure = materialize(words.select("feature", odds.alias("odds"), z.alias("z")), "feature-odds")
    best = sure.where(F.col("z") >= _certain(sure)).where(F.col("odds") >= LEAST_ODDS)
    return {r.feature: r.odds for r in best.collect()}  # features that several of the bounded training rows share


def _certain(tested: DataFrame) -> float:
    """Least z at which, of the features at or above it, at most ``FALSE_SHARE`` are expected by chance."""
    step = 0.05
    counts = {r[0]: r[1] for r in tested.groupBy(F.floor(F.least(F.col("z"), F.lit(40.0)) / step).cast("int").alias("b")).agg(F.count("*")).collect()}
    tests, above, least = sum(counts.values()), 0, math.inf
    for b in sorted(counts, reverse=True):
        above += counts[b]
        if tests * math.erfc(b * step / math.sqrt(2)) / 2 <= FALSE_SHARE * above:
            least = b * step
    return least


def _evidence(weights: dict[str, float]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores = TokenScores(weights)
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["_text"], batch["_toxic"], strict=True):
                n, _, values, segments = scores.segments(text)
                rows.append((int(toxic), n, values, [s for _, _, s in segments]))
            yield pd.DataFrame(rows, columns=["toxic", "n", "tokens", "segments"])

    return run


def _rate(positive: np.ndarray, others: float) -> float:
    """lambda of the clean token scores; half a token of the best score is added, as no sample shows every rare token."""
    values, weight = np.append(positive, positive.max(initial=1.0)), np.append(np.ones(len(positive)), 0.5)
    total = weight.sum() + others
    grows = lambda rate: (weight * np.exp(rate * values)).sum() + others * math.exp(-rate * DRIFT) - total
    low, high = 1e-6, 1.0
    while grows(high) < 0 and high < 50:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if grows(middle) < 0 else (low, middle)
    return low


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps, with a small penalty on the slope so that separable rows keep it finite."""
    a, b, penalty = 0.0, 0.0, 0.5
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -35, 35)))
        w = np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([(y - p).sum(), ((y - p) * x).sum() - penalty * b])
        hessian = np.array([[w.sum() + 1e-6, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + penalty]])
        step = np.linalg.solve(hessian, gradient)
        step = np.clip(step, -5, 5)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_rows: int = MOST_TRAINING_ROWS) -> ToxicityModel:
    """Model from labelled rows that are not held out. Without rows of both labels every text scores near 0."""
    training = materialize(training_rows(docs, labels, id_col, text_col, label_col, most_rows), "training")
    weights = feature_weights(training)
    model = ToxicityModel(weights)
    if not weights:
        return model
    rows = training.mapInPandas(_evidence(weights), "toxic int, n long, tokens array<double>, segments array<double>").collect()  # at most ``most_rows``
    clean = [r for r in rows if r.toxic != 1 and r.n]
    positive = np.array([s for r in clean for s in r.tokens])
    model.rate = _rate(positive, sum(r.n for r in clean) - len(positive))
    tops = np.array([max(r.segments, default=0.0) for r in clean])
    model.k = len(clean) / (np.array([r.n for r in clean]) * np.exp(-model.rate * tops)).sum()
    x = np.array([math.log1p(sum(e for _, _, e in model.passages(r.n, [(0, 0, s) for s in r.segments]))) for r in rows])
    model.intercept, model.slope = _logistic(x, np.array([float(r.toxic == 1) for r in rows]))
    return model


def _judge(model: ToxicityModel):
    @F.pandas_udf("score double, passages array<struct<first:int,last:int,excess:double>>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scores = model.scorer()
        for batch in batches:
            rows = []
            for text in batch:
                n, _, _, segments = scores.segments(text)
                found = model.passages(n, segments)
                rows.append((model.score(sum(e for _, _, e in found)), [{"first": a, "last": b, "excess": e} for a, b, e in found]))
            yield pd.DataFrame(rows, columns=["score", "passages"])

    return judge


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Whole rows that score below ``threshold``; edge cases as in ``score_documents``."""
    judged = docs.select(F.struct(*docs.columns).alias("_row"), _judge(model)(_text(text_col)).alias("_o"))
    return judged.where(F.col("_o.score") < threshold).select("_row.*")


def score_documents(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``id_col``, held_out, score, predicted and passages (first and last token, excess over chance) of every row.

    Null and empty texts hold no passage and get the score of a text without evidence; a null id stays null and is not held
    out; repeated rows get equal scores; other columns are not read; an empty table gives an empty result. Texts are read whole.
    """
    out = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), _judge(model)(_text(text_col)).alias("_o"))
    score = F.col("_o.score")
    return out.select(id_col, "held_out", score.alias("score"), F.when(score >= threshold, 1).otherwise(0).alias("predicted"), F.col("_o.passages").alias("passages"))
