"""Best-fit packing of documents into sequences of at most `CAPACITY` tokens.

Tokenising: a text falls into white-space-delimited chunks, no token of the given vocabulary
crosses one, and each distinct chunk of a batch is encoded once; ids of all documents are then
gathered by numpy. Documents longer than the capacity, and only they, are cut.

Packing: pieces go to `parts` partitions by a hash of doc_id. Best-fit decreasing packs each
(open bins are kept by free space, so a piece costs O(1)), and dual-feasible functions give a
lower bound on its bins. A partition that meets its bound is certified and done. The others are
packed in slightly disturbed orders, too, and where that doesn't help give up every bin that isn't
full; these bins are dealt anew, whole, to as few groups as hold them, and each group packs its
pieces again, in descending and in disturbed orders. A group's new packing is taken only where it
has fewer bins than were dealt to it, so exchanging never costs sequences. This goes on, with one
partition too, until all bounds are met, or `ROUNDS` are over and the last one shrank no gap; what is
left then stays uncertified. Each piece carries `gap`, the bins that its group was above its bound when
its sequence was settled: 0 is certified.

Only (doc_id, piece, length) rows are shuffled, 24 bytes a piece. Partitions hold some
`PIECES_PER_PART` pieces however large the corpus is.

Defined results: null and empty texts are one piece that holds the closing id; repeated rows of
one doc_id each keep a piece of their own; an empty table gives an empty one; ties in length are
broken by doc_id, piece and start; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._tables import materialize, read, ship, whole_texts
from tessera.llm._text import Hasher, pieces, ragged, words

CAPACITY = 4096
END_ID = 1
PIECES_PER_PART = 100_000
ROUNDS = 4
#: Pieces placed in a group and round while it misses its bound, and the most orders tried.
WORK, TRIES = 1_000_000, 256
_MEMORY = 300_000  # chunks whose ids a worker remembers
_GROUP = 4000  # chunks encoded as one string
#: 1: ASCII letters, 2: ASCII punctuation but the apostrophe. The vocabulary's pre-tokeniser always
#: cuts between the two, so chunks are cut there as well and "word" and "word," share an entry.
_KIND = np.zeros(256, np.uint8)
_KIND[65:91] = _KIND[97:123] = 1
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = 2
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of chunks by way of a memory of chunks seen before."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.engine = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.engine.get_added_tokens_decoder().values()]
        # a byte-level vocabulary writes each byte as one character, so a token's length in bytes is known
        vocabulary = self.engine.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.width[i] = len(token.removesuffix("</w>"))
        self.forget()

    def forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def chunks(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = data.tobytes()
        starts, ends, rows = words(data, offsets)
        if len(data) < 2 or any(t in raw for t in self.special):
            return starts, ends, rows
        kind = _KIND[data]
        cut = np.flatnonzero(kind[1:] * kind[:-1] == 2) + 1
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        cut = cut[~edge[cut]]
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
        return starts, ends, np.searchsorted(offsets, starts, "right") - 1

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: list[int]) -> None:
        """Encode new chunks: many as one string, cut again where their lengths say. A group whose
        lengths don't add up (normalisation changed one) is encoded chunk by chunk."""
        length = ends - starts
        spaced = np.full(int(length.sum()) + len(length), 32, np.uint8)
        to = np.cumsum(length + 1) - length - 1
        spaced[ragged(to, length)] = data[ragged(starts, length)]
        spaced = spaced.tobytes()
        found: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        firsts = range(0, len(length), _GROUP)
        bounds = np.append(to, len(spaced))
        texts = [spaced[bounds[a] : bounds[min(a + _GROUP, len(length))]].decode("utf-8", "replace") for a in firsts]
        for a, e in zip(firsts, self.engine.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            reached, due = np.cumsum(self.width[ids]), np.cumsum(length[a : a + _GROUP])
            stop = np.searchsorted(reached, due)
            if len(ids) and reached[-1] == due[-1] and (reached[stop] == due).all():
                sizes.append(np.diff(stop + 1, prepend=0))
                found.append(ids)
            else:
                each = self.engine.encode_batch_fast([spaced[x : x + n].decode("utf-8", "replace") for x, n in zip(to[a : a + _GROUP].tolist(), length[a : a + _GROUP].tolist())], add_special_tokens=False)
                sizes.append(np.array([len(x.ids) for x in each], np.int64))
                found += [np.array(x.ids, np.uint32) for x in each]
        size = np.concatenate(sizes)
        self.slots.update(zip(keys, range(len(self.sizes), len(self.sizes) + len(keys))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(size) - size])
        self.sizes = np.concatenate([self.sizes, size])
        self.flat = np.concatenate([self.flat, *found])

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows behind each other, each row closed by END_ID, and the rows' offsets in them."""
        starts, ends, rows = self.chunks(data, offsets)
        n = len(offsets) - 1
        distinct, at, inverse = np.unique(Hasher(data).spans(starts, ends), return_index=True, return_inverse=True)
        keys = distinct.tolist()
        if len(self.slots) > _MEMORY:
            self.forget()
        slot = np.array([self.slots.get(k, -1) for k in keys], np.int64)
        new = np.flatnonzero(slot < 0)
        if len(new):
            self.learn(data, starts[at[new]], ends[at[new]], [keys[i] for i in new.tolist()])
            slot[new] = np.arange(len(self.sizes) - len(new), len(self.sizes))
        slot = slot[inverse] if len(starts) else slot[:0]
        length = self.sizes[slot]
        ids = self.flat[ragged(self.starts[slot], length)]
        stops = np.cumsum(np.bincount(rows, weights=length, minlength=n).astype(np.int64) + 1)
        out = np.full(len(ids) + n, END_ID, np.uint32)
        body = np.ones(len(out), bool)
        body[stops - 1] = False
        out[body] = ids
        return out, np.concatenate([[0], stops])


def token_ids(data: np.ndarray, offsets: np.ndarray, tokenizer: str) -> tuple[np.ndarray, np.ndarray]:
    if tokenizer not in _encoders:
        _encoders[tokenizer] = Encoder(tokenizer)
    return _encoders[tokenizer].ids(data, offsets)


_PIECES = "doc_id long, copy long, piece int, start long, length long, ids_crc32 long"


def tokenized(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32. `copy` tells repeated rows apart."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, "body", 2 << 20):
            ids, bounds = token_ids(data, offsets, tokenizer)
            doc_ids, copies = batch.column(0), batch.column(1)
            length = np.diff(bounds)
            count = -(-length // capacity)
            row = np.repeat(np.arange(len(length)), count)
            piece = ragged(np.zeros(len(count), np.int64), count)
            start = piece * capacity
            stop = np.minimum(start + capacity, length[row])
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((bounds[row] + start).tolist(), (bounds[row] + stop).tolist())]
            yield pa.RecordBatch.from_arrays([doc_ids.take(pa.array(row)), copies.take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(stop - start), pa.array(crc, pa.int64())], ["doc_id", "copy", "piece", "start", "length", "ids_crc32"])

    bodies = whole_texts(docs, F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("copy"))
    return bodies.mapInArrow(cut, _PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the largest bound of the dual-feasible functions
    f_t(x) = capacity if x > capacity - t, x if t <= x, else 0 (t up to half), and the identity."""
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    mass = np.cumsum(counts * np.arange(capacity + 1))
    many = np.cumsum(counts)
    t = np.arange(0, capacity // 2 + 1)
    over = many[-1] - many[capacity - t]
    middle = mass[capacity - t] - np.where(t > 0, mass[np.maximum(t - 1, 0)], 0)
    return int(np.max(over + -(-middle // capacity)))


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing over lengths sorted in descending order: each one's bin and offset."""
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    present, bins, offsets, opened = 0, [0] * len(lengths), [0] * len(lengths), 0
    for i, size in enumerate(lengths.tolist()):
        fitting = present >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            b = stacks[free].pop()
            if not stacks[free]:
                present ^= 1 << free
        else:
            free, b, opened = capacity, opened, opened + 1
        bins[i], offsets[i], rest = b, capacity - free, free - size
        if rest:
            if not stacks[rest]:
                present |= 1 << rest
            stacks[rest].append(b)
    return np.array(bins, np.int64), np.array(offsets, np.int64)


def repack(lengths: np.ndarray, bins: np.ndarray, offsets: np.ndarray, capacity: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A packing of lengths, sorted in descending order, in fewer bins than given; else the given one."""
    rng, most, least = np.random.default_rng(seed), int(bins.max()) + 1, lower_bound(lengths, capacity)
    for k in range(min(TRIES, 2 + WORK // len(lengths))):
        if most <= least:
            break
        order = np.argsort(-lengths * rng.uniform(0.9, 1, len(lengths)), kind="stable") if k else np.arange(len(lengths))
        b, o = best_fit(lengths[order], capacity)
        if b.max() + 1 < most:
            most, bins, offsets = int(b.max()) + 1, np.empty_like(b), np.empty_like(o)
            bins[order], offsets[order] = b, o
    return bins, offsets


_PACKED = "doc_id long, copy long, piece int, start long, length long, ids_crc32 long, part int, bin long, offset long, settled boolean, gap long"


def _pack_round(rows: DataFrame, parts: int, k: int, capacity: int) -> DataFrame:
    """Pack each of `parts` partitions, from the second round on those of whole bins; `settled` marks
    what stays: certified partitions and full bins. gap: bins of the partition above its bound."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [b for b in batches if len(b)]
        if not got:
            return
        for part, rows in pd.concat(got).groupby("part", sort=True):
            rows = rows.sort_values(["length", "doc_id", "piece", "start", "copy"], ascending=[False, True, True, True, True], ignore_index=True)
            size = rows["length"].to_numpy()
            bins = (rows.groupby(["home", "bin"], sort=False).ngroup().to_numpy(), rows["offset"].to_numpy()) if k else best_fit(size, capacity)
            rows["bin"], rows["offset"] = repack(size, *bins, capacity, k)
            used = np.bincount(rows["bin"].to_numpy(), weights=size)
            rows["gap"] = len(used) - lower_bound(size, capacity)
            rows["settled"] = (rows["gap"] <= 0) | (used[rows["bin"].to_numpy()] == capacity)
            yield rows[["doc_id", "copy", "piece", "start", "length", "ids_crc32", "part", "bin", "offset", "settled", "gap"]]

    dealt = F.xxhash64("home", "bin", F.lit(k)) if k else F.xxhash64("doc_id", "copy", "piece", F.lit(k))
    return rows.withColumn("part", F.pmod(dealt, F.lit(parts)).cast("int")).repartition(parts, "part").mapInPandas(pack, _PACKED)


def pack(pieces_: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS, per_part: int = PIECES_PER_PART) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset and gap for every piece."""
    parts = max(1, -(-pieces_.count() // per_part))
    done, rest, last_gap = [], pieces_, None
    for k in range(256):  # the round's number is a byte of sequence_id
        packed = materialize(_pack_round(rest, parts, k, capacity), "packing-round")
        number = F.col("bin") * F.lit(1 << 32) + F.col("part") * F.lit(1 << 8) + F.lit(k)
        numbered = packed.select("doc_id", "piece", "start", "length", "ids_crc32", number.alias("sequence_id"), "offset", F.greatest("gap", F.lit(0)).alias("gap"), "settled")
        left = packed.filter("not settled")
        groups = left.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("gap")).agg(F.sum("n").alias("n"), F.sum("gap").alias("gap")).first()
        if not groups["n"] or k == 255 or (k + 1 >= rounds and last_gap is not None and groups["gap"] >= last_gap) or rounds <= 1:
            done.append(numbered.drop("settled"))
            break
        done.append(numbered.filter("settled").drop("settled"))
        rest = left.select("doc_id", "copy", "piece", "start", "length", "ids_crc32", F.col("part").alias("home"), "bin", "offset")
        parts, last_gap = -(-groups["n"] // per_part), groups["gap"]
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(materialize(tokenized(docs, tokenizer, capacity), "pieces"), capacity)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, gap."""
    return pack_documents(read(spark, sf_dir, "documents").select("doc_id", "text"), default_tokenizer())
