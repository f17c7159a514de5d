"""Naive Bayes support vectors: a quality score for whole texts.

Features say which byte 2-grams and 3-grams a text holds (not how often). Each is scaled by its class log-count ratio; a
linear hinge-loss model over the scaled features is fitted by dual coordinate descent and blended with the mean weight.

The fit uses at most about ``fit_rows`` labelled rows, chosen by a hash of doc_id, and runs in one task on their features;
scoring is one pass without a shuffle. Labels are 0 or 1; other labels, null labels and held-out rows are not used.

Defined cases: a null text is empty; empty text has no features and gets the score of the model's constant; without
labelled rows of both classes every score is 0.5; a document with several labels has the smallest; a null doc_id has no
label and is not held out. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import byte_buffer, tasks_need_package, thrifty, written

FIT_ROWS = 8_000
PAIRS = 2**16
FEATURES = PAIRS + 2**18


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def features(text: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Sorted numbers of the features a text has. ``flags`` is scratch space of FEATURES zeros, and left so."""
    if len(text) < 2:
        return np.zeros(0, np.int32)
    wide = text.astype(np.uint32)
    two = wide[:-1] << 8 | wide[1:]
    flags[two] = True
    if len(text) > 2:
        three = (two[:-1] << 8 | wide[2:]) * np.uint32(0x9E3779B1)
        flags[PAIRS + (three >> np.uint32(14))] = True
    found = np.flatnonzero(flags)
    flags[found] = False
    return found.astype(np.int32)


def fit(df: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> bytes | None:
    """The model as bytes (weights, slope, offset), or None if a class has no labelled rows."""
    tasks_need_package(df)
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").cast("int").alias("y"))
    share = min(1.0, fit_rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(2**30)) < int(share * 2**30))  # about fit_rows rows: may be broadcast
    rows = df.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("text", "y")
    examples = written(rows.mapInArrow(thrifty(_examples), "y int, features binary"), "examples")
    model = examples.groupBy().applyInPandas(_train, "model binary").first()
    return bytes(model.model) if model is not None and model.model is not None else None


def _examples(batches):
    flags = np.zeros(FEATURES, bool)
    for batch in batches:
        data, starts = byte_buffer(batch.column("text"))
        parts = [features(data[a:b], flags).tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(parts, pa.binary())], names=["y", "features"])


def _train(rows: pd.DataFrame) -> pd.DataFrame:
    y = np.where(rows["y"].to_numpy() == 1, 1.0, -1.0)
    examples = [np.frombuffer(b, np.int32) for b in rows["features"]]
    order = sorted(range(len(y)), key=lambda i: (y[i], rows["features"].iloc[i]))  # the same model however rows arrive
    model = train([examples[i] for i in order], y[order])
    return pd.DataFrame({"model": [model]})


def train(examples: list[np.ndarray], y: np.ndarray, c: float = 1.0, blend: float = 0.25, rounds: int = 12) -> bytes | None:
    if not (y > 0).any() or not (y < 0).any():
        return None
    counts = {sign: np.ones(FEATURES) for sign in (1.0, -1.0)}
    for found, sign in zip(examples, y, strict=True):
        counts[sign][found] += 1
    ratio = np.log(counts[1.0] / counts[1.0].sum()) - np.log(counts[-1.0] / counts[-1.0].sum())
    seen = counts[1.0] + counts[-1.0] > 3
    ratio[~seen] = 0.0

    # dual coordinate descent: one multiplier per example, moved to where its part of the dual is best
    most = {1.0: c * len(y) / (2 * (y > 0).sum()), -1.0: c * len(y) / (2 * (y < 0).sum())}
    weights, constant, alpha = np.zeros(FEATURES), 0.0, np.zeros(len(y))
    squared = ratio**2
    norms = np.array([squared[f].sum() + 1.0 for f in examples])
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        for i in rng.permutation(len(y)):
            found, sign = examples[i], y[i]
            scaled = ratio[found]
            gradient = sign * (weights[found] @ scaled + constant) - 1.0
            moved = min(max(alpha[i] - gradient / norms[i], 0.0), most[sign]) - alpha[i]
            if moved:
                alpha[i] += moved
                weights[found] += moved * sign * scaled
                constant += moved * sign
    mean = np.abs(weights[seen]).mean() if seen.any() else 0.0
    weights = ((1 - blend) * mean + blend * weights) * ratio
    constant *= blend
    margins = np.array([weights[f].sum() + constant for f in examples])
    slope, offset = _calibrate(margins, y)
    return np.concatenate([weights, [constant, slope, offset]]).astype(np.float64).tobytes()


def _calibrate(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve that turns margins into scores, both classes weighing the same."""
    scale = max(float(np.abs(margins).mean()), 1e-9)
    x, share = margins / scale, np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    target = np.where(y > 0, 0.98, 0.02)
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -40, 40)))
        error, bend = share * (p - target), share * p * (1 - p)
        gradient = np.array([(error * x).sum() + 1e-4 * slope, error.sum()])
        hessian = np.array([[(bend * x * x).sum() + 1e-4, (bend * x).sum()], [(bend * x).sum(), bend.sum() + 1e-6]])
        step = np.linalg.solve(hessian, gradient)
        slope, offset = slope - np.clip(step[0], -2, 2), offset - np.clip(step[1], -2, 2)
    return max(float(slope), 1e-3) / scale, float(offset)


def score(df: DataFrame, model: bytes | None, text: str = "text") -> DataFrame:
    """Adds ``score``. The model has a fixed size (about 2.6 MB), so every task may have it."""
    tasks_need_package(df)
    columns = [c for c in df.columns if c != "score"]
    rows = df.select(*columns)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        fitted = np.frombuffer(shared.value, np.float64) if shared.value else None
        flags = np.zeros(FEATURES, bool)
        for batch in batches:
            if fitted is None:
                scores = np.full(batch.num_rows, 0.5)
            else:
                weights, (constant, slope, offset) = fitted[:FEATURES], fitted[FEATURES:]
                data, starts = byte_buffer(batch.column(text))
                sums = [weights[features(data[a:b], flags)].sum() for a, b in zip(starts[:-1], starts[1:], strict=True)]
                scores = 1 / (1 + np.exp(-np.clip(slope * (np.array(sums) + constant) + offset, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*columns, "score"])

    return rows.mapInArrow(thrifty(scored), rows.select("*", F.lit(0.0).alias("score")).schema)


def scored_documents(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    judged = score(docs.select("doc_id", "text"), fit(docs, labels, fit_rows))
    return judged.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
