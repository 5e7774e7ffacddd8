"""Toxic passages by maximum-scoring segments over token log-odds, calibrated by extreme values.

1. Training: in how many sentences of toxic and of other texts does each unit occur? Units of a
   word are the word and its first 4, 5 and 6 characters, so that word forms never seen share what
   their stem tells. A sentence counts once, or a copied text would make all its words look toxic.
   Log-odds get an informative Dirichlet prior: each unit's own frequency, scaled down, is added
   to both sides, which pulls rare units to zero; only significant units stay.
2. Scoring: a word counts the log-odds of its most significant unit, any other word a small
   negative drift. One scan per text finds all maximal segments in linear time (Ruzzo, Tompa 1999).
3. Calibration: the best segment of m words without toxicity follows an extreme-value law,
   P(S >= x) = 1 - exp(-K m exp(-lambda x)) (Karlin, Altschul 1990). Its parameters are fitted on
   texts without the label, so a long text is not suspect for its length. The evidence of a text is
   the sum, over segments, of how far each lies above what its length explains; a logistic curve
   turns it into the chance of the label. Units and calibration come from different texts.

Labelled texts are read once for training, all texts once for scoring; nothing else is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F

from wordloom.llm.shipping import ship
from wordloom.workspace import materialize

# The fit uses about this many labelled texts at most, chosen by a hash of the id. This bounds
# the fit alone; every text is scored.
MAX_TRAINING_TEXTS = 50_000
MIN_Z = 3.5
# Odds that a unit must change at least twofold and more (e to this power). In large corpora slight
# leanings of common words are significant too, and would let segments grow over any text.
MIN_WEIGHT = 1.0
PRIOR_SHARE = 0.05
STEMS = (4, 5, 6)
DRIFT = -0.4
# Segments below this chance of arising without toxicity are reported as passages.
SIGNIFICANT = 0.01
# Evidence of a segment is the negative log of that chance as far as it exceeds this.
FLOOR = 2.0
ROWS = 2048

_WORD = regex.compile(r"[\p{L}\p{N}]+")


def units(token: str) -> list[str]:
    """Units of the words of one white-space separated token; a stem is marked by a ``-``."""
    out = []
    for word in _WORD.findall(token):
        out.append(word)
        out += [word[:n] + "-" for n in STEMS if len(word) > n]
    return out


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Where each text's tokens begin, the number of each token, and the different tokens."""
    texts = pa.concat_arrays([texts.cast(pa.large_string()).fill_null("")])
    split = pc.utf8_split_whitespace(pc.utf8_lower(texts))
    coded = split.values.dictionary_encode()
    return split.offsets.to_numpy(), coded.indices.to_numpy(), coded.dictionary.to_pylist()


@dataclass
class Model:
    """Log-odds of units, the law of random segments, and the curve from evidence to score."""

    weights: dict[str, float] = field(default_factory=dict)
    strengths: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    scale: float = 1e-3
    slope: float = 0.0
    base: float = -40.0

    def token_weight(self, token: str) -> float:
        known = [unit for unit in units(token) if unit in self.weights]
        if not known:
            return DRIFT
        return self.weights[max(known, key=lambda unit: self.strengths[unit])]


def segments(weights: np.ndarray, before: np.ndarray, positive: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, last, score)`` of one text in linear time.

    ``before[i]`` is the sum of the weights ahead of token i; ``positive`` lists the tokens with a
    positive weight. A segment is joined with the nearest one that starts lower, as long as that
    one ends lower too.
    """
    held: list[tuple[int, int, float, float]] = []
    for at, low, high in zip(positive.tolist(), before[positive].tolist(), before[positive + 1].tolist()):
        first = at
        while True:
            k = len(held) - 1
            while k >= 0 and held[k][2] >= low:
                k -= 1
            if k < 0 or held[k][3] >= high:
                held.append((first, at, low, high))
                break
            first, low = held[k][0], held[k][2]
            del held[k:]
    return [(first, last, high - low) for first, last, low, high in held]


def found(texts: pa.Array, model: Model) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """Number of tokens and maximal segments of each text."""
    offsets, numbers, tokens = coded_words(texts)
    each = np.array([model.token_weight(token) for token in tokens] or [DRIFT])
    weights = each[numbers] if len(numbers) else np.zeros(0)
    before = np.concatenate(([0.0], np.cumsum(weights)))
    positive = np.flatnonzero(weights > 0)
    borders = np.searchsorted(positive, offsets)
    for k in range(len(offsets) - 1):
        low, high = borders[k], borders[k + 1]
        own = segments(weights, before, positive[low:high]) if high > low else []
        start = int(offsets[k])
        yield int(offsets[k + 1]) - start, [(a - start, b - start, s) for a, b, s in own]


def chances(n_words: int, own: list[tuple[int, int, float]], model: Model) -> np.ndarray:
    """Chance that the best of ``n_words`` words without toxicity is as good as each segment."""
    scores = np.array([score for _, _, score in own])
    expected = model.scale * max(n_words, 1) * np.exp(-np.minimum(model.decay * scores, 600.0))
    return np.maximum(-np.expm1(-expected), 1e-300)


def evidence(n_words: int, own: list[tuple[int, int, float]], model: Model) -> float:
    if not own:
        return 0.0
    return float(np.maximum(0.0, -np.log(chances(n_words, own, model)) - FLOOR).sum())


def held_out(id_col: Column) -> Column:
    """True where the checksum of the id, as text, leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = np.array(batch.column(1).to_pylist(), dtype=np.int64)
        offsets, numbers, tokens = coded_words(batch.column(0))
        made = [units(token) for token in tokens]
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        borders = offsets.tolist()
        for label, low, high in zip(toxic.tolist(), borders, borders[1:]):
            here = set(numbers[low:high].tolist())
            counts[label].update({unit for number in here for unit in made[number]})
        names = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([counts[1][x] for x in names], pa.int64()),
                pa.array([counts[0][x] for x in names], pa.int64()),
            ],
            names=["unit", "toxic", "other"],
        )


def significant_units(counts: DataFrame, n_toxic: int, n_other: int) -> DataFrame:
    """``unit, weight, z``: log-odds with a Dirichlet prior, and how many deviations they are."""
    prior = F.lit(PRIOR_SHARE) * (F.col("toxic") + F.col("other"))
    shared = PRIOR_SHARE * (n_toxic + n_other)

    def log_odds(seen: Column, texts: int) -> Column:
        return F.log((seen + prior) / (F.lit(texts + shared + 1.0) - seen - prior))

    weight = log_odds(F.col("toxic"), n_toxic) - log_odds(F.col("other"), n_other)
    spread = F.sqrt(1.0 / (F.col("toxic") + prior) + 1.0 / (F.col("other") + prior))
    rated = counts.select("unit", weight.alias("weight"), (weight / spread).alias("z"))
    return rated.where((F.abs("z") >= F.lit(MIN_Z)) & (F.abs("weight") >= F.lit(MIN_WEIGHT)))


def _maxima(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, ROWS):
            batch = whole.slice(start, ROWS)
            rows = list(found(batch.column(0), model))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    pa.array([n for n, _ in rows], pa.int64()),
                    pa.array([[s for _, _, s in own] for _, own in rows], pa.list_(pa.float64())),
                ],
                names=["toxic", "n_words", "scores"],
            )


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and base of a logistic curve, by Newton steps with a slight pull to zero."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    pull = np.diag([1e-2, 1e-4])
    w = np.array([0.0, np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))])
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ w, -40, 40)))
        slope = design.T @ (y - p) - pull @ w
        bend = (design * (p * (1 - p))[:, None]).T @ design + pull
        step = np.linalg.solve(bend, slope)
        w = w + step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Model:
    """Learn from labelled texts that are not held out.

    Repeated labels of an id count as their greatest; null labels and ids are left out. With no
    text of either label the model knows no unit and scores all texts near the share of label 1.
    """
    spark = docs.sparkSession
    ship(spark)
    key = F.col(id_col).cast("bigint")
    known = labels.select(key.alias("id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
    known = materialize(known.groupBy("id").agg(F.max(F.least("toxic", F.lit(1))).alias("toxic")), "labels")
    share = min(1.0, MAX_TRAINING_TEXTS / max(known.count(), 1))
    place = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    chosen = known.where(place < F.lit(int(share * 1_000_000)))
    # One text of four tells how segments of texts that were not counted score.
    chosen = chosen.withColumn("calibrates", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) == 0)
    texts = docs.select(key.alias("id"), F.col(text_col).alias("text"))
    # The chosen labels are at most MAX_TRAINING_TEXTS rows of three numbers, give or take.
    training = texts.join(F.broadcast(chosen), "id").select("text", "toxic", "calibrates")
    training = materialize(training, "training")

    sentences = F.explode(F.split("text", r"[.!?\n]+")).alias("sentence")
    counted = training.where(~F.col("calibrates")).select(sentences, "toxic")
    counted = counted.where(F.trim("sentence") != "").distinct()
    counted = materialize(counted, "sentences")
    sizes = {row["toxic"]: row["n"] for row in counted.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    model = Model()
    if sizes.get(0) and sizes.get(1):
        counts = counted.mapInArrow(_count, "unit string, toxic bigint, other bigint")
        counts = counts.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        best = significant_units(counts, sizes[1], sizes[0])
        # Every significant unit is kept; what bounds them is the bound on the training texts.
        for row in best.collect():
            model.weights[row["unit"]] = row["weight"]
            model.strengths[row["unit"]] = abs(row["z"])

    held = training.where("calibrates").select("text", "toxic")
    rows = held.mapInArrow(
        lambda batches: _maxima(batches, model), "toxic int, n_words bigint, scores array<double>"
    ).collect()
    if not rows:
        return model
    plain = [(row["n_words"], max(row["scores"], default=0.0)) for row in rows if not row["toxic"]]
    words = np.array([max(n, 1) for n, _ in plain] or [1.0], dtype=float)
    best = np.array([s for _, s in plain] or [0.0])
    if (best > 0).any():
        # The tail above the median of the positive maxima falls exponentially.
        middle = float(np.median(best[best > 0]))
        above = best[best >= middle]
        model.decay = 1.0 / max(float((above - middle).mean()), 0.25)
        rate = min(len(above) / len(best), 0.99)
        model.scale = float(-np.log1p(-rate) * np.exp(model.decay * middle) / words.mean())
    else:
        model.scale = 1.0 / (len(plain) + 1) / float(words.mean())
    x = np.array([evidence(row["n_words"], [(0, 0, s) for s in row["scores"]], model) for row in rows])
    model.slope, model.base = _logistic(x, np.array([float(row["toxic"]) for row in rows]))
    return model


_SCORED = (
    "id bigint, score double, "
    "passages array<struct<first_word:bigint,last_word:bigint,score:double,p_value:double>>"
)
_PASSAGES = pa.list_(
    pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64()), ("p_value", pa.float64())])
)


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, ROWS):
            batch = whole.slice(start, ROWS)
            scores, passages = [], []
            for n_words, own in found(batch.column(1), model):
                x = np.clip(model.slope * evidence(n_words, own, model) + model.base, -40, 40)
                scores.append(float(1.0 / (1.0 + np.exp(-x))))
                chance = chances(n_words, own, model) if own else ()
                passages.append(
                    [
                        {"first_word": a, "last_word": b, "score": s, "p_value": float(p)}
                        for (a, b, s), p in zip(own, chance)
                        if p <= SIGNIFICANT
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(passages, _PASSAGES)],
                names=["id", "score", "passages"],
            )


def score_toxicity(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and the significant ``passages`` of each row.

    A passage is a range of white-space separated words with its log-odds and the chance that a
    text of this length has as good a segment by accident. Null texts are empty; a text without
    words has no evidence and gets the lowest score. Rows that repeat an id are scored each by
    itself; a null id stays null and is not held out. Other columns are not looked at. An empty
    table gives an empty one.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(lambda batches: _score(batches, model), _SCORED)
    return scored.select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= F.lit(threshold)).cast("int").alias("predicted"),
        "passages",
    )


def drop_toxic(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text scores below the threshold.

    Every row is judged by its text alone: null and empty texts have no evidence and stay, repeated rows
    and ids stay or go by their own text. Other columns may have any names. An empty table gives an
    empty one.
    """
    ship(docs.sparkSession)
    kept_schema = docs.schema
    at = kept_schema.fieldNames().index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                limit = np.log(threshold / (1.0 - threshold))
                clean = [
                    bool(model.slope * evidence(n, own, model) + model.base < limit)
                    for n, own in found(batch.column(at), model)
                ]
                yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(keep, kept_schema)
