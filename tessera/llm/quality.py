"""Quality by a linear-chain conditional random field over a document's lines.

Every line is good or bad. Features are shape statistics of the line itself and of the lines
before and after it (share of letters, capitals, digits, symbols, table bars and shouts, word
length, repetition inside the document); two-state transitions tie neighbours together.
Forward-backward gives each line's marginal of being good, and the mean of these, weighted by the
lines' lengths, is mapped to the document's score by a fitted logistic curve.

Labels mark documents, not lines, so training alternates: all lines of a bad document start as
bad, the field is fitted, and lines that it then finds good although their document is bad are
relabelled, except a bad document's worst line. At most `MOST_LABELLED` labelled documents teach, none
of more than `TEACHER_LINES` lines, and `MOST_LINES` lines of all of them together; only their feature
rows reach the driver. Scoring is one map over whole texts: no shuffle.

Short documents are scored many at a time, their chains in step. A document of more than `LONG_LINES`
lines or `LONG_BYTES` bytes is taken block by block: features are sums over bytes and words, carried
on where a block cuts a line, and only three numbers a line and the hash of each triple of words are kept. Its chain is cut into about
sqrt(n) segments; the odds that enter each follow from the product of the segments' 2 x 2 matrices,
and all segments are then walked in step. So memory is some 16 bytes a line and 8 a word, and the time all but
linear.

Defined results: a word ends after LONG_BYTES bytes at the latest, in texts of any size (what goes on is another
word); null and empty texts are one empty line and get its score; without any labelled
document every score is 0.5; repeated rows score alike; an empty table gives an empty one; only
the text is looked at, so other columns can't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._labels import held_out, teaching_sample, within
from tessera.llm._tables import read, ship, whole_texts
from tessera.llm._text import SPACE, U64, Hasher, mix, pieces, words

MOST_LABELLED, TEACHER_LINES, MOST_LINES = 6000, 2000, 500_000
LONG_LINES, LONG_BYTES, RUN_LINES = 2000, 1 << 20, 20_000
KEEP_FROM = 0.3
#: Byte classes that are counted in every line.
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".,;:'\"-()?", "shout": b"!", "bar": b"|", "symbol": b"#$%&*+/<=>@[\\]^_`{}~", "space": b" \t\r\x0b\x0c"}
_OWN = len(_CLASSES) + 8
_N = len(_CLASSES)
_SIZE, _COUNT, _LENGTH, _REPEAT, _WIDE, _LAST = range(_N, _N + 6)


class Seen:
    """What earlier blocks of a document leave: its last two words and the hashes of all triples of words so
    far, in sorted runs of which each is at least twice as long as the next. So a triple is moved a few
    times only, however long the document is, and takes eight bytes."""

    def __init__(self) -> None:
        self.last, self.runs = np.zeros(0, U64), list[np.ndarray]()

    def had(self, triples: np.ndarray) -> np.ndarray:
        out = np.zeros(len(triples), bool)
        for run in self.runs:
            out |= run[np.minimum(np.searchsorted(run, triples), len(run) - 1)] == triples
        return out

    def add(self, fresh: np.ndarray) -> None:
        """fresh: sorted, distinct and not had()."""
        while self.runs and len(self.runs[-1]) < 2 * len(fresh):
            fresh = np.sort(np.concatenate([self.runs.pop(), fresh]), kind="stable")
        if len(fresh):
            self.runs.append(fresh)


def _repeats(hashes: np.ndarray, doc: np.ndarray, seen: Seen | None) -> np.ndarray:
    """Whether a word and the two before it came before in its document."""
    carried = 0
    if seen is not None:
        carried = len(seen.last)
        hashes = np.concatenate([seen.last, hashes])
        doc = np.zeros(len(hashes), np.int64)
        seen.last = hashes[-2:]
    repeat = np.zeros(len(hashes), bool)
    if len(hashes) > 2:
        triple = mix(mix(hashes[:-2] + U64(1)) * U64(3) + mix(hashes[1:-1] + U64(2)) * U64(5) + hashes[2:])
        at = np.flatnonzero(doc[2:] == doc[:-2])
        triple = mix(triple[at] + mix(doc[at].astype(U64)))
        distinct, fresh = np.unique(triple, return_index=True)
        again = np.ones(len(triple), bool)
        again[fresh] = False
        if seen is not None:
            had = seen.had(distinct)
            again[fresh[had]] = True
            seen.add(distinct[~had])
        repeat[at + 2] = again
    return repeat[carried:]


def _line_sums(data: np.ndarray, offsets: np.ndarray, seen: Seen | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A row of sums per line, which add up over the pieces of a line, and the documents' offsets in
    these rows. The last byte (0 where there is none) is the one entry that doesn't add up."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(offsets, breaks, "right") - 1
    first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n) + 1)])
    total = int(first[-1])
    starts, ends = np.empty(total, np.int64), np.empty(total, np.int64)
    at = np.arange(len(breaks)) + owner
    starts[first[:-1]] = offsets[:-1]
    starts[at + 1] = breaks + 1
    ends[first[1:] - 1] = offsets[1:]
    ends[at] = breaks
    x = np.zeros((total, _N + 6))
    for k, members in enumerate(_CLASSES.values()):
        table = np.zeros(256, np.uint8)
        table[list(members)] = 1
        sums = np.concatenate([[0], np.cumsum(table[data], dtype=np.int32)])
        x[:, k] = sums[ends] - sums[starts]
    ws, we, doc = words(data, offsets, SPACE)
    line = np.searchsorted(starts, ws, "right") - 1
    repeat = _repeats(Hasher(data).spans(ws, we), doc, seen)
    x[:, _SIZE] = ends - starts
    x[:, _COUNT] = np.bincount(line, minlength=total)
    x[:, _LENGTH] = np.bincount(line, weights=we - ws, minlength=total)
    x[:, _REPEAT] = np.bincount(line, weights=repeat, minlength=total)
    x[:, _WIDE] = np.bincount(line, weights=we - ws > 25, minlength=total)
    if len(data):
        x[:, _LAST] = np.where(ends > starts, data[np.maximum(ends - 1, 0)], 0)
    return x, first


def _own(sums: np.ndarray) -> np.ndarray:
    """Features of lines by themselves, from their sums."""
    size, count = sums[:, _SIZE], sums[:, _COUNT]
    per_word = np.maximum(count, 1)
    x = np.zeros((len(sums), _OWN), np.float32)
    x[:, :_N] = sums[:, :_N] / np.maximum(size, 1)[:, None]
    x[:, -8] = np.log1p(size) / 8
    x[:, -7] = sums[:, _LENGTH] / per_word / 10
    x[:, -6] = sums[:, _REPEAT] / per_word
    x[:, -5] = size == 0
    x[:, -4] = (count > 0) & (count < 4)
    x[:, -3] = (size > 0) & np.isin(sums[:, _LAST], list(b".?!:;"))
    x[:, -2] = np.minimum(1, sums[:, _WIDE] / per_word * 5)
    x[:, -1] = 1
    return x


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of features per line, the documents' offsets in these rows, and the lines' byte lengths."""
    sums, first = _line_sums(data, offsets)
    x = _own(sums)
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.hstack([x, before, after]), first, sums[:, _SIZE]


def _cuts(data: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """A text in blocks of at most `most` bytes that end with a line, else with a word where one ends."""
    at = 0
    while len(data) - at > most:
        some = data[at : at + most]
        for found in (some == 10, SPACE[some]):
            if found.any():
                some = some[: most - int(np.argmax(found[::-1]))]
                break
        yield some
        at += len(some)
    yield data[at:]


def _by_lines(block: np.ndarray) -> Iterator[np.ndarray]:
    """A block in pieces of at most RUN_LINES lines."""
    breaks = np.flatnonzero(block == 10)[RUN_LINES - 1 :: RUN_LINES] + 1
    yield from np.split(block, breaks)


def _scan(lean: np.ndarray, step: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The log-odds of good at each line of a chain, given this line and those before it, as (lines, log-odds)
    for one line of every segment at a time. Backwards with the transposed step."""
    n = len(lean)
    yield np.zeros(1, np.int64), np.asarray(lean[:1], np.float64)
    if n == 1:
        return
    width = int(np.ceil(np.sqrt(n - 1)))
    begin = np.arange(1, n, width)
    a, b, c, d = (np.full(len(begin), v, np.float64) for v in (1, 0, 0, 1))
    (s00, s01), (s10, s11) = step
    for t in range(width):
        e = np.exp(lean[np.minimum(begin + t, n - 1)].astype(np.float64))
        a, b, c, d = e * (s11 * a + s01 * c), e * (s11 * b + s01 * d), s10 * a + s00 * c, s10 * b + s00 * d
        top = np.maximum(np.maximum(a, b), np.maximum(c, d))
        a, b, c, d = a / top, b / top, c / top, d / top
    odds, enter = float(np.exp(np.float64(lean[0]))), np.empty(len(begin))
    for k, (p, q, r, s) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist())):
        enter[k] = odds
        odds = (p * odds + q) / (r * odds + s)
    odds = enter
    for t in range(width):
        at = begin + t
        keep = at < n
        begin, at, odds = begin[keep], at[keep], odds[keep]
        odds = np.exp(lean[at].astype(np.float64)) * (s01 + s11 * odds) / (s00 + s10 * odds)
        yield at, np.log(odds)


class Field:
    """Two states, bad 0 and good 1: line weights for good against bad, and transitions."""

    def __init__(self, width: int):
        self.weights, self.moves = np.zeros(width), np.zeros((2, 2))
        self.centre, self.spread = np.zeros(width), np.ones(width)
        self.slope, self.shift = 1.0, 0.0

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.spread, -6, 6)

    def marginals(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) per line, and the expected transitions, by scaled forward-backward over all
        documents in step: step t handles every document with more than t lines."""
        lean = np.clip(x @ self.weights, -30, 30)
        emit = np.stack([1 / (1 + np.exp(lean)), 1 / (1 + np.exp(-lean))], 1)
        step = np.exp(np.clip(self.moves, -5, 5))
        length = np.diff(first)
        order = np.argsort(-length, kind="stable")
        begin, sorted_length = first[:-1][order], length[order]
        active = [int(k) for k in np.searchsorted(-sorted_length, -np.arange(1, (sorted_length[0] if len(order) else 0) + 1), "right")]
        ahead, behind, pairs = np.empty_like(emit), np.ones_like(emit), np.zeros((2, 2))
        for t, k in enumerate(active):
            i = begin[:k] + t
            a = emit[i] if t == 0 else (ahead[i - 1] @ step) * emit[i]
            ahead[i] = a / a.sum(1, keepdims=True)
        for t in range(len(active) - 1, 0, -1):
            i = begin[: active[t]] + t
            later = behind[i] * emit[i]
            b = later @ step.T
            joint = ahead[i - 1][:, :, None] * step[None] * later[:, None, :]
            pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            behind[i - 1] = b / b.sum(1, keepdims=True)
        both = ahead * behind
        return both[:, 1] / both.sum(1), pairs

    def fit(self, x: np.ndarray, first: np.ndarray, truth: np.ndarray, weight: np.ndarray, steps: int, rate: float = 0.1, ridge: float = 1e-3) -> None:
        """Gradient ascent (Adam) on the conditional likelihood of the lines' labels."""
        inner = np.ones(len(truth), bool)
        inner[first[:-1]] = False
        i = np.flatnonzero(inner)
        seen = np.bincount(truth[i - 1] * 2 + truth[i], minlength=4).reshape(2, 2)
        theta = np.concatenate([self.weights, self.moves.ravel()])
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for k in range(1, steps + 1):
            self.weights, self.moves = theta[:-4], theta[-4:].reshape(2, 2)
            good, pairs = self.marginals(x, first)
            g = np.concatenate([x.T @ ((truth - good) * weight), (seen - pairs).ravel() * weight.mean()]) / weight.sum() - ridge * theta
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            theta = theta + rate / (1 + k / 50) * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        self.weights, self.moves = theta[:-4], theta[-4:].reshape(2, 2)

    def quality(self, x: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Length-weighted mean marginal per document."""
        good, _ = self.marginals(self.scaled(x), first)
        w = np.maximum(size, 1)
        return np.add.reduceat(good * w, first[:-1]) / np.add.reduceat(w, first[:-1])

    def long_quality(self, data: np.ndarray, most: int = LONG_BYTES) -> float:
        """quality() of one text of any length, block by block."""
        n = sum(int(np.count_nonzero(data[a : a + most] == 10)) for a in range(0, len(data), most)) + 1
        lean, size = np.empty(n, np.float32), np.empty(n, np.float32)
        before, held, seen, at = np.zeros((1, _OWN), np.float32), np.zeros((0, _OWN), np.float32), Seen(), 0
        rest = None

        def put(own: np.ndarray, after: np.ndarray) -> None:
            nonlocal at, before
            if len(own):
                x = np.hstack([own, np.concatenate([before, own[:-1]]), after])
                lean[at : at + len(own)] = np.clip(self.scaled(x) @ self.weights, -30, 30)
                at, before = at + len(own), own[-1:]

        def lines(sums: np.ndarray, last: bool) -> None:
            """Take finished lines; each waits for the one after it."""
            nonlocal held, done
            size[done : done + len(sums)] = sums[:, _SIZE]
            done += len(sums)
            own = np.concatenate([held, _own(sums)])
            if last:
                put(own, np.concatenate([own[1:], np.zeros((1, _OWN), np.float32)]))
            else:
                put(own[:-1], own[1:])
                held = own[-1:]

        done = 0
        for some in (piece for block in _cuts(data, most) for piece in _by_lines(block)):
            sums, _ = _line_sums(some, np.array([0, len(some)]), seen)
            if rest is not None:
                end = sums[0, _LAST] if sums[0, _SIZE] else rest[_LAST]
                sums[0] += rest
                sums[0, _LAST] = end
            lines(sums[:-1], False)
            rest = sums[-1]
        lines(rest[None], True)
        ahead = np.empty(n, np.float32)
        step = np.exp(np.clip(self.moves, -5, 5))
        for i, odds in _scan(lean, step):
            ahead[i] = odds
        good = weight = 0.0
        back = lean[::-1]
        for i, odds in _scan(back, step.T):
            i = n - 1 - i
            w = np.maximum(size[i], 1).astype(np.float64)
            good += float((w / (1 + np.exp(-(ahead[i] + odds - lean[i])))).sum())
            weight += float(w.sum())
        return good / weight

    def score(self, quality: np.ndarray) -> np.ndarray:
        q = np.clip(quality, 1e-4, 1 - 1e-4)
        return 1 / (1 + np.exp(-(self.slope * np.log(q / (1 - q)) + self.shift)))


def train(x: np.ndarray, first: np.ndarray, size: np.ndarray, label: np.ndarray, rounds: int = 3) -> Field:
    field = Field(x.shape[1])
    field.centre, field.spread = x.mean(0, dtype=np.float64), np.maximum(x.std(0, dtype=np.float64), 1e-3)
    own = _OWN - 1  # the constant keeps its value
    field.centre[own::_OWN], field.spread[own::_OWN] = 0, 1
    raw, x = x, field.scaled(x)
    doc = np.repeat(np.arange(len(label)), np.diff(first))
    truth = label[doc].astype(np.int64)
    share = label.mean()
    for k in range(rounds):
        weight = np.where(label[doc] == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6)) * np.log1p(size)
        field.fit(x, first, truth, np.maximum(weight, 1e-3), 150 if k == 0 else 80)
        good, _ = field.marginals(x, first)
        worst = np.minimum.reduceat(good, first[:-1])
        truth = np.where(label[doc] == 1, 1, (good > 0.8) & (good > worst[doc])).astype(np.int64)
    q = np.clip(field.quality(raw, first, size), 1e-4, 1 - 1e-4)
    z = np.log(q / (1 - q))
    for _ in range(200):  # Newton's method on the two calibration values, with a little damping
        p = 1 / (1 + np.exp(-(field.slope * z + field.shift)))
        g = np.array([np.sum((label - p) * z), np.sum(label - p)]) - 1e-3 * np.array([field.slope - 1, field.shift])
        s = p * (1 - p)
        h = np.array([[np.sum(s * z * z), np.sum(s * z)], [np.sum(s * z), np.sum(s)]]) + np.eye(2) * 1e-2
        move = np.clip(np.linalg.solve(h, g), -0.5, 0.5)
        field.slope, field.shift = max(0.05, field.slope + move[0]), field.shift + move[1]
    return field


def short_runs(batches: Iterator[pa.RecordBatch], name: str, longest: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray | None, np.ndarray]]:
    """Runs of rows of at most RUN_LINES lines, as pieces() gives them; a row of more than `longest`
    lines or LONG_BYTES bytes comes by itself as (row, None, its bytes)."""
    for batch, data, offsets in pieces(batches, name, LONG_BYTES):
        lines = np.diff(np.searchsorted(np.flatnonzero(data == 10), offsets)) + 1
        long_ = (lines > longest) | (np.diff(offsets) > LONG_BYTES)
        a = 0
        while a < batch.num_rows:
            if long_[a]:
                yield batch.slice(a, 1), None, data[offsets[a] : offsets[a + 1]]
                a += 1
                continue
            upto = np.cumsum(lines[a:])
            stop = a + max(1, int(np.searchsorted(upto, RUN_LINES, "right")))
            if long_[a:stop].any():
                stop = a + int(np.argmax(long_[a:stop]))
            yield batch.slice(a, stop - a), data[offsets[a] : offsets[stop]], offsets[a : stop + 1] - offsets[a]
            a = stop


def teach(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Field | None:
    """The fitted field, or None without labelled documents."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in short_runs(batches, "body", TEACHER_LINES):
            if data is None:
                continue
            x, first, size = line_features(data, offsets)
            cut = [(x[a:b].tobytes(), size[a:b].tobytes()) for a, b in zip(first[:-1], first[1:])]
            lines = pa.array(np.diff(first))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lines, pa.array([c[0] for c in cut], pa.binary()), pa.array([c[1] for c in cut], pa.binary())], ["doc_id", "label", "lines", "x", "size"])

    sample = whole_texts(teaching_sample(docs, labels, "quality", most), "doc_id", "label")
    kept = within(sample.mapInArrow(rows, "doc_id long, label int, lines long, x binary, size binary"), "lines", MOST_LINES, "quality-teachers")
    got = sorted(kept.select("doc_id", "label", "x", "size").collect())
    if not got:
        return None
    size = [np.frombuffer(r["size"]) for r in got]
    x = np.concatenate([np.frombuffer(r["x"], np.float32).reshape(len(s), -1) for r, s in zip(got, size)])
    first = np.concatenate([[0], np.cumsum([len(s) for s in size])])
    return train(x, first, np.concatenate(size), np.array([r["label"] for r in got], np.float64))


def score_quality(docs: DataFrame, field: Field | None, keep: list[str] | None = None) -> DataFrame:
    """The columns of docs named in keep (all where not given) with `score`."""
    ship(docs.sparkSession)
    keep = [c for c in docs.columns if c != "score"] if keep is None else keep

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in short_runs(batches, "text" if "text" in keep else "body", LONG_LINES):
            if field is None:
                score = np.full(batch.num_rows, 0.5)
            elif data is None:
                score = field.score(np.array([field.long_quality(offsets)]))
            else:
                x, first, size = line_features(data, offsets)
                score = field.score(field.quality(x, first, size))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(score)], [*keep, "score"])

    rows = docs.select(*keep) if "text" in keep else whole_texts(docs, *keep)  # a text travels once
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keep)])
    return rows.mapInArrow(scores, f"{schema}, score double")


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    field = teach(docs, read(spark, sf_dir, "labels"))
    out = score_quality(docs, field, ["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))
