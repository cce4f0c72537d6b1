"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the hashes of its words, of neighbouring pairs and of pairs with one word
between them, each present or not, in `1 << BITS` coordinates. A longer word is also counted by its
stems (first `STEMS` bytes): languages that compound hide a word behind endings that no sample has. FTRL-proximal keeps a learning
rate for each coordinate and its L1 term leaves almost all weights at exactly zero; the rest, a
few thousand (index, weight) pairs at most, travel to the executors inside the task closure. A logistic curve fitted across two halves of the
sample makes the score a probability.

At most `MOST_LABELLED` labelled documents teach (see _labels), as long as they have no more than
`MOST_COORDINATES` coordinates together; the driver receives the coordinates of these only. Scoring is one map over whole texts: no shuffle, and only coordinates with
a weight are made distinct per document.

Defined results: null and empty texts have the score of the bias alone; without labelled documents
every score is 0; repeated rows score alike; an empty table gives an empty one; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._labels import held_out, teaching_sample, within
from tessera.llm._tables import read, ship, whole_texts
from tessera.llm._text import LOWER, U64, Hasher, mix, pieces, words

MOST_LABELLED, MOST_COORDINATES = 5000, 20_000_000
BITS = 22
TOXIC_FROM = 0.5
#: FTRL-proximal: learning rate, its smoothing, L1, L2, passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 1.0, 1.0, 4.0, 1.0, 6
STEMS = (4, 5, 6)
#: Bytes that belong to no word: ASCII other than letters and digits.
GAP = np.zeros(256, bool)
GAP[:128] = True
GAP[48:58] = GAP[65:91] = GAP[97:123] = False


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of words, stems, pairs and skip-pairs, lower-cased, and their rows."""
    starts, ends, rows = words(data, offsets, GAP)
    hasher = Hasher(LOWER[data])
    h = hasher.spans(starts, ends)
    keys, owners = [h], [rows]
    for n in STEMS:
        long_ = np.flatnonzero(ends - starts > n)
        keys.append(hasher.spans(starts[long_], starts[long_] + n) * U64(0x27D4EB2F165667C5))
        owners.append(rows[long_])
    for gap, salt in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
        if len(h) > gap:
            same = rows[gap:] == rows[:-gap]
            keys.append(((mix(h[:-gap]) + h[gap:]) * U64(salt))[same])
            owners.append(rows[gap:][same])
    return (mix(np.concatenate(keys)) >> U64(64 - bits)).astype(np.int64), np.concatenate(owners)


def ftrl(samples: list[np.ndarray], labels: np.ndarray, bits: int = BITS, passes: int = PASSES, seed: int = 5) -> tuple[np.ndarray, np.ndarray, float]:
    """Indices and values of the weights that aren't zero, and the bias (which L1 leaves alone)."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bias_z = bias_n = 0.0
    order = np.random.default_rng(seed)
    where = lambda z, n: np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    for _ in range(passes):
        for i in order.permutation(len(samples)):
            x = samples[i]
            zx, nx = z[x], n[x]
            w = where(zx, nx)
            bias = -bias_z / ((BETA + bias_n**0.5) / ALPHA)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - labels[i]
            z[x] = zx + g - (np.sqrt(nx + g * g) - np.sqrt(nx)) / ALPHA * w
            n[x] = nx + g * g
            bias_z += g - ((bias_n + g * g) ** 0.5 - bias_n**0.5) / ALPHA * bias
            bias_n += g * g
    w = where(z, n)
    kept = np.flatnonzero(w)
    return kept, w[kept], -bias_z / ((BETA + bias_n**0.5) / ALPHA)


def fit(samples: list[np.ndarray], labels: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Indices and weights, slope and shift of the score's logistic curve. The curve is fitted to
    sums of weights that were learned without the document: each half scores the other one."""
    sums = np.zeros(len(samples))
    for half in (0, 1):
        rest = [i for i in range(len(samples)) if i % 2 != half]
        index, value, bias = ftrl([samples[i] for i in rest], labels[rest], bits)
        dense = np.zeros(1 << bits)
        dense[index] = value
        for i in range(half, len(samples), 2):
            sums[i] = dense[samples[i]].sum() + bias
    index, value, bias = ftrl(samples, labels, bits)
    slope, shift = 1.0, 0.0
    for _ in range(100):  # Newton's method, damped
        p = 1 / (1 + np.exp(-np.clip(slope * sums + shift, -35, 35)))
        g = np.array([((labels - p) * sums).sum(), (labels - p).sum()]) - 0.1 * np.array([slope - 1, shift])
        s = p * (1 - p)
        h = np.array([[(s * sums * sums).sum(), (s * sums).sum()], [(s * sums).sum(), s.sum()]]) + np.eye(2) * 0.1
        move = np.clip(np.linalg.solve(h, g), -0.5, 0.5)
        slope, shift = max(0.05, slope + move[0]), shift + move[1]
    return index, value, slope, slope * bias + shift


def teach(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> tuple[np.ndarray, np.ndarray, float, float] | None:
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, "body"):
            x, row = features(data, offsets)
            pair = np.unique(row << BITS | x)
            edges = np.searchsorted(pair, np.arange(batch.num_rows + 1) << BITS)
            x = (pair & ((1 << BITS) - 1)).astype(np.uint32)
            cut = [x[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(edges)), pa.array(cut, pa.binary())], ["doc_id", "label", "n", "features"])

    sample = whole_texts(teaching_sample(docs, labels, "toxic", most), "doc_id", "label")
    kept = within(sample.mapInArrow(rows, "doc_id long, label int, n long, features binary"), "n", MOST_COORDINATES, "toxicity-teachers")
    got = sorted(kept.select("doc_id", "label", "features").collect())
    if not got:
        return None
    samples = [np.frombuffer(r["features"], np.uint32).astype(np.int64) for r in got]
    return fit(samples, np.array([r["label"] for r in got], np.float64))


def score_toxicity(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float, float] | None, keep: list[str]) -> DataFrame:
    """The columns of docs named in keep, with `score`."""
    ship(docs.sparkSession)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = None
        for batch, data, offsets in pieces(batches, "body"):
            total = np.zeros(batch.num_rows)
            if model is None:
                score = total
            else:
                index, value, slope, shift = model
                if dense is None:
                    dense = np.zeros(1 << BITS, np.float32)
                    dense[index] = value
                x, row = features(data, offsets)
                hit = np.flatnonzero(dense[x])
                pair = np.unique(row[hit] << BITS | x[hit])
                np.add.at(total, pair >> BITS, dense[pair & ((1 << BITS) - 1)])
                score = 1 / (1 + np.exp(-np.clip(slope * total + shift, -35, 35)))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], [*batch.schema.names[:-1], "score"])

    bodies = whole_texts(docs, *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bodies.schema.fields[:-1])
    return bodies.mapInArrow(scores, f"{schema}, score double")


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_toxicity(docs, teach(docs, read(spark, sf_dir, "labels")), ["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
