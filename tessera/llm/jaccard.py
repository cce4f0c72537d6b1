"""N-gram Jaccard join: which documents' shingle sets overlap by a rule's share or more.

Documents and n-grams form a sparse incidence matrix; overlaps are its product with its transpose.
The product is never taken whole:

1. Documents with equal sets are one row of the matrix (its id: a hash of the set).
2. Size-derived bounds choose the blocks. Two sets that link have sizes within the ratio, and at
   most K = (1 - t) / t of the smaller size, t being the share, in elements that only one of them has. Sizes are classed
   geometrically; a class fixes K, and each set's hashes are cut by value into T > K + 1 parts.
   A linked pair differs in at most K parts, so it agrees in one: its content hash brings the pair
   into one block. Should a set have so many empty parts that all agreeing ones could be empty
   (more than T - K - 1), it also enters the blocks of its empty parts; two such sets still meet.
3. In a block the row that most blocks have is multiplied with all others, not all pairs with each
   other, and the products are counted by n-gram: overlap counts accumulate over the shared
   columns, pairs below the bound are discarded. Components of these links are formed.
4. Blocks that are then not within one component get a second such row; blocks that still aren't
   are multiplied in full across their components, where a bound from parity bitmaps discards
   pairs before anything is emitted. So no link between components is lost, and a block of
   thousands of near copies costs few products per row.

Rows that thousands of others are compared with are spread over several tasks (`CHUNK` rows each), and
a block that is multiplied in full falls into tiles of `TILE` by `TILE` rows. Buckets of block keys
grow in number with the shingles of the corpus.

jaccard_components() stops there: links inside a component that its connection doesn't need are not
computed. jaccard_join() counts them all. Links lie within components and between neighbouring size
classes, so each component's classes are dealt into tiles (`LINK_TILE` rows, fewer of long sets), and
each pair of tiles is one block of the product: overlaps accumulate over runs of shared columns, what
is below the bound is discarded, and only counts a row leave the task. Every pair is in one block, so
nothing is counted twice; no pair is emitted. The work of a component of n different sets is n * n / 2
products; rows sent to tasks are n * n / LINK_TILE, equal sets being one row with their number.

Defined results: documents without words (null, empty, white space) have an empty set and are
linked with nothing; equal sets are linked; rows that repeat a doc_id are treated as rows of their
own that may link, also without doc_id, whose component's id is the least doc_id there is; a row's
links are the other rows it links with, equal sets included; an empty table gives an empty one; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._tables import materialize, read, ship, shuffle_width, whole_texts
from tessera.llm._text import LOWER, U64, Hasher, mix, pieces, words
from tessera.llm.components import components


@dataclass(frozen=True)
class Rule:
    """Linked: shingles of `width` words with of * overlap >= number * union."""

    width: int = 5
    number: int = 80
    of: int = 100


#: The rule that the query's contract states; stages take Rule()'s five words and 0.8.
CONTRACT = Rule(4, 85, 100)
CHUNK, TILE, BUCKET_SHINGLES = 128, 2048, 4_000_000
#: Rows and shingles of a tile whose links are counted, shingles that one call takes, columns multiplied at once.
LINK_TILE, LINK_SHINGLES, CALL_SHINGLES, COLUMNS = 256, 500_000, 2_000_000, 4096
_RATIO = 1.5  # of neighbouring size classes; rules below 1 / _RATIO take wider ones


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row behind each other, and the rows' offsets."""
    n = len(offsets) - 1
    starts, ends, rows = words(data, offsets)
    h = Hasher(LOWER[data]).spans(starts, ends)
    count = np.bincount(rows, minlength=n)
    first = np.cumsum(count) - count
    value, owner = np.zeros(0, U64), np.zeros(0, np.int64)
    if len(h) >= width:
        rolled = h[: len(h) - width + 1].copy()
        for k in range(1, width):
            rolled = mix(rolled * U64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k])
        inside = rows[: len(rolled)] == rows[width - 1 :]
        value, owner = rolled[inside], rows[: len(rolled)][inside]
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        lone = np.full(len(short), 0x243F6A8885A308D3, U64)
        for k in range(width - 1):
            has = count[short] > k
            lone[has] = mix(lone[has] * U64(0x9E3779B97F4A7C15) + h[first[short[has]] + k] + U64(k + 1))
        value, owner = np.concatenate([value, lone]), np.concatenate([owner, short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])


def set_ids(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 63-bit id of each set; 0 for the empty one."""
    size = np.diff(bounds)
    out = np.zeros(len(size), U64)
    some = size > 0
    if some.any():
        out[some] = mix(np.add.reduceat(mix(value ^ U64(0x452821E638D01377)), bounds[:-1][some]) + size[some].astype(U64))
        out[some] = np.maximum(out[some] >> U64(1), U64(1))
    return out.astype(np.int64)


def parity_bits(value: np.ndarray, finer: int) -> bytes:
    """One bit for each residue of the hashes modulo a power of two, some `1 << finer` times their
    number: how many hashes have it, modulo 2. Two sizes compare after folding the larger one."""
    size = 1 << min(max(9, int(len(value)).bit_length() + finer), 20)
    odd = np.bincount((value & U64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _class_tops(largest: int, rule: Rule) -> np.ndarray:
    """The largest size of each class: 1, 2, 3, 4, 6, 9, ... A set's partners are in its own class
    and the two beside it."""
    tops = [1]
    while tops[-1] < largest:
        tops.append(max(tops[-1] * rule.of // rule.number, tops[-1] + 1, int(tops[-1] * _RATIO)))
    return np.array(tops, np.int64)


def signatures(value: np.ndarray, bounds: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Block keys and the rows they belong to."""
    size = np.diff(bounds)
    if not len(value):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    tops = _class_tops(int(size.max()) + 1, rule)
    own = np.searchsorted(tops, size)
    keys, owners = [], []
    for down in (0, 1):  # a row joins its own class, and the one below where its partners can be there
        group = own - down
        yes = (size > 0) & (group >= 0)
        yes[yes] &= rule.number * size[yes] <= rule.of * tops[group[yes]]
        rows = np.flatnonzero(yes)
        if not len(rows):
            continue
        differ = ((rule.of - rule.number) * tops[group[rows]]) // rule.number  # K: union - overlap <= (1 - t) / t * smaller size
        parts = differ + 2 + differ // 16
        n = size[rows]
        at = np.repeat(bounds[:-1][rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        row = np.repeat(np.arange(len(rows)), n)
        v = value[at]
        part = ((v >> U64(32)) * parts[row].astype(U64) >> U64(32)).astype(np.int64)
        begin = np.ones(len(v), bool)
        begin[1:] = (part[1:] != part[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(begin)
        content = np.add.reduceat(mix(v + U64(0x13198A2E03707344)), begin)
        where = group[rows[row[begin]]].astype(U64) << U64(40) | part[begin].astype(U64)
        keys.append(mix(content + mix(where)))
        owners.append(rows[row[begin]])
        filled = np.bincount(row[begin], minlength=len(rows))
        for k in np.flatnonzero(parts - filled > parts - differ - 1).tolist():
            empty = np.setdiff1d(np.arange(parts[k]), part[begin][row[begin] == k])
            keys.append(mix(U64(0xA4093822299F31D0) + mix(U64(group[rows[k]]) << U64(40) | empty.astype(U64))))
            owners.append(np.full(len(empty), rows[k]))
    return np.concatenate(keys), np.concatenate(owners)


def document_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, body_key, n_shingles, set_id for every row."""
    ship(docs.sparkSession)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, "body"):
            value, bounds = shingle_sets(data, offsets, rule.width)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(bounds)), pa.array(set_ids(value, bounds))], ["doc_id", "body_key", "n_shingles", "set_id"])

    bodies = whole_texts(docs, F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("body_key"))
    return bodies.mapInArrow(look, "doc_id long, body_key long, n_shingles long, set_id long")


def _blocks(docs: DataFrame, buckets: int, rule: Rule) -> DataFrame:
    """Blocks of at least two different rows, as (block, members): members are sorted set ids."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in pieces(batches, "body"):
            value, bounds = shingle_sets(data, offsets, rule.width)
            ids = set_ids(value, bounds)
            _, one_each = np.unique(ids, return_index=True)
            key, row = signatures(value, bounds, rule)
            kept = np.zeros(len(ids), bool)
            kept[one_each] = True
            key, row = key[kept[row]], row[kept[row]]
            bucket = ((key >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            key, row, edge = key[order], row[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
            used = np.flatnonzero(np.diff(edge))
            low, high, owner = key.astype(np.uint32), (key >> U64(32)).astype(np.uint16), ids[row]  # the bucket stands for the upper bits
            cut = lambda x: pa.array([x[edge[b] : edge[b + 1]].tobytes() for b in used], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), cut(low), cut(high), cut(owner)], ["bucket", "low", "high", "ids"])

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        load = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in rows[c]])
        key, ids = load("high", np.uint16).astype(U64) << U64(32) | load("low", np.uint32), load("ids", np.int64)
        order = np.argsort(key, kind="stable")
        key, ids = key[order], ids[order]
        shared = np.zeros(len(key), bool)
        same = key[1:] == key[:-1]
        shared[1:] |= same
        shared[:-1] |= same
        key, ids = key[shared], ids[shared]
        order = np.lexsort((ids, key))
        key, ids = key[order], ids[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])
        key, ids = key[new], ids[new]
        edge = np.append(np.flatnonzero(np.diff(key, prepend=key[:1] ^ U64(1)) != 0) if len(key) else [], len(key)).astype(np.int64)
        found = {ids[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:]) if b - a > 1}
        return pd.DataFrame({"members": sorted(found)})

    bodies = whole_texts(docs)
    met = bodies.mapInArrow(emit, "bucket int, low binary, high binary, ids binary").groupBy("bucket").applyInPandas(meet, "members binary")
    return materialize(met, "blocks").dropDuplicates(["members"])


def _members(blocks: DataFrame) -> DataFrame:
    """(block, node): the blocks' rows one by one."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(m, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(ids), pa.string()), pa.array(ids)], ["block", "node"])

    return blocks.select(F.md5("members").alias("block"), "members").mapInArrow(unpack, "block string, node long")


def _heads(placed: DataFrame) -> DataFrame:
    """(a, b): in each block that isn't within one component, the row most blocks have, of the
    components but that of the block's very first row, with all rows of other components. Near
    copies of one original share most with it, so it tends to lead."""
    best = F.struct("popular", "node", "label")
    lead = placed.groupBy("block").agg(F.max(best).alias("lead"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("block", "lead")
    lead = materialize(lead, "block-leads")  # written, so that a hot block can be split in the joins
    open_ = placed.join(lead, "block")
    second = open_.filter(F.col("label") != F.col("lead.label")).groupBy("block").agg(F.max(best).alias("second")).select(F.col("block").alias("in_block"), "second")
    second = materialize(second, "block-leads")
    met = open_.join(second, F.col("block") == F.col("in_block")).filter(F.col("label") != F.col("second.label"))
    return met.select(F.col("second.node").alias("a"), F.col("node").alias("b"))


def _first_heads(placed: DataFrame) -> DataFrame:
    lead = materialize(placed.groupBy("block").agg(F.max(F.struct("popular", "node")).alias("lead")), "block-leads")
    return placed.join(lead, "block").filter(F.col("node") != F.col("lead.node")).select(F.col("lead.node").alias("a"), F.col("node").alias("b"))


def _likely(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose sizes and parity bitmaps allow a link; few others than links do."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(i).to_numpy() for i in (2, 3))
            small, large = np.minimum(n, m), np.maximum(n, m)
            fits = rule.number * large <= rule.of * small
            for i in np.flatnonzero(fits).tolist():
                x, y = (np.frombuffer(batch.column(k)[i].as_py(), U64) for k in (4, 5))
                least = min(len(x), len(y))
                x, y = (np.bitwise_xor.reduce(v.reshape(-1, least), 0) for v in (x, y))
                fits[i] = (rule.of + rule.number) * int(np.bitwise_count(x ^ y).sum()) <= (rule.of - rule.number) * (small[i] + large[i])
            yield batch.select([0, 1]).filter(pa.array(fits))

    side = lambda c: sets.select(F.col("set_id").alias(c), F.col("size").alias(f"{c}_size"), F.col("bits").alias(f"{c}_bits"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_size", "b_size", "a_bits", "b_bits")
    return both.mapInArrow(compare, "a long, b long")


def _across(placed: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): all pairs across the components of a block whose parity bitmaps allow a link. The
    bitmaps' distance is never above the number of n-grams that only one set has, so the bound is
    safe; the comparison is one blocked product inside the task, and only what passes is emitted."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["block", "low", "high", "node"], ignore_index=True)
        label, node, size, packed, slot = (rows[c].to_numpy() for c in ("label", "node", "size", "bits", "slot"))
        diagonal = (rows["low"] == rows["high"]).to_numpy()
        tile = rows[["block", "low", "high"]]
        edge = np.append(np.flatnonzero((tile != tile.shift()).any(axis=1)), len(rows))
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first, end in zip(edge[:-1].tolist(), edge[1:].tolist()):
            least = min(map(len, packed[first:end]))
            bits = np.stack([np.bitwise_xor.reduce(np.frombuffer(x, U64).reshape(-1, least // 8), 0) for x in packed[first:end]])
            for i in range(first, end - 1):
                far = np.bitwise_count(bits[i + 1 - first :] ^ bits[i - first]).sum(1)
                small, large = np.minimum(size[i], size[i + 1 : end]), np.maximum(size[i], size[i + 1 : end])
                hit = np.flatnonzero((diagonal[i] | (slot[i + 1 : end] != slot[i])) & (label[i + 1 : end] != label[i]) & (rule.number * large <= rule.of * small) & ((rule.of + rule.number) * far <= (rule.of - rule.number) * (small + large)))
                out_a.append(np.full(len(hit), node[i]))
                out_b.append(node[i + 1 + hit])
        return pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    mixed = placed.groupBy("block").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("slots"))
    mixed = materialize(mixed.filter("low < high").select("block", "slots"), "mixed-blocks")
    described = placed.join(mixed, "block").withColumn("slot", F.pmod(F.xxhash64("node"), F.col("slots")).cast("int"))
    described = described.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))  # a row is in a tile with each slot
    described = described.withColumns({"low": F.least("slot", "other"), "high": F.greatest("slot", "other")})
    described = described.join(sets.select(F.col("set_id").alias("node"), "size", F.col("coarse").alias("bits")), "node")
    many = F.pmod(F.xxhash64("block", "low", "high"), F.lit(8 * shuffle_width(placed.sparkSession))).alias("part")  # several tiles a call
    return described.select(many, "block", "low", "high", "slot", "node", "label", "size", "bits").groupBy("part").applyInPandas(compare, "a long, b long")


def _products(pairs: DataFrame, sets: DataFrame, rule: Rule, most: bool) -> DataFrame:
    """The pairs (a, b) whose overlap reaches the bound. sets: set_id, shingles (packed hashes).
    most: the pairs need most of the sets, so these are dealt out; else AQE goes by measured sizes."""
    spread = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).select("a", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    dealt = pairs.join(spread, "a").select("a", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk"), F.col("b").alias("set_id"), F.lit(1).alias("side"))
    heads = spread.select("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("a").alias("set_id"), F.lit(0).alias("side"))
    wanted = dealt.unionByName(heads)
    rows = (wanted.hint("merge") if most else wanted).join(sets.select("set_id", "shingles"), "set_id")

    def multiply(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        head = rows.loc[rows["side"] == 0, "shingles"]
        rows = rows[rows["side"] == 1]
        if not len(head) or not len(rows):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        row = np.frombuffer(head.iloc[0], U64)
        ids, size = rows["set_id"].to_numpy(), rows["shingles"].str.len().to_numpy() // 8
        fits = (rule.number * size <= rule.of * len(row)) & (rule.number * len(row) <= rule.of * size)
        columns = np.frombuffer(b"".join(rows["shingles"]), U64)
        at = np.minimum(np.searchsorted(row, columns), len(row) - 1)
        overlap = np.add.reduceat((row[at] == columns).astype(np.int64), np.cumsum(size) - size)
        linked = fits & (rule.of * overlap >= rule.number * (size + len(row) - overlap))
        return pd.DataFrame({"a": np.full(int(linked.sum()), key[0]), "b": ids[linked]})

    return rows.select("a", "chunk", "side", "set_id", "shingles").groupBy("a", "chunk").applyInPandas(multiply, "a long, b long")


def _sets_of(docs: DataFrame, known: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """set_id, shingles of the wanted set ids, each computed from one document that has it."""
    one = known.join(wanted.select("set_id").distinct(), "set_id", "left_semi").groupBy("set_id").agg(F.min(F.struct("doc_id", "body_key")).alias("one"))
    one = one.select("set_id", F.col("one.doc_id").alias("one_id"), F.col("one.body_key").alias("one_key"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, "body"):
            value, bounds = shingle_sets(data, offsets, rule.width)
            ids, due = set_ids(value, bounds), np.asarray(batch.column(0))
            rows = np.flatnonzero(ids == due)
            cut = [value[bounds[i] : bounds[i + 1]] for i in rows]
            yield pa.RecordBatch.from_arrays([pa.array(due[rows]), pa.array([len(x) for x in cut], pa.int64()), pa.array([parity_bits(x, 1) for x in cut], pa.binary()), pa.array([parity_bits(x, 2) for x in cut], pa.binary()), pa.array([x.tobytes() for x in cut], pa.binary())], ["set_id", "size", "coarse", "bits", "shingles"])

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("body_key"))
    texts = keyed.join(one.hint("merge"), keyed["doc_id"].eqNullSafe(F.col("one_id")) & (keyed["body_key"] == F.col("one_key")))  # grows with the corpus: never broadcast
    return whole_texts(texts, "set_id").mapInArrow(look, "set_id long, size long, coarse binary, bits binary, shingles binary")


def _connect(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every row with its set, the wanted sets, and (node, label) of the sets that link with another."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = materialize(document_sets(docs, rule), "document-sets")
    shingles = known.agg(F.sum("n_shingles")).first()[0] or 0
    members = materialize(_members(_blocks(docs, max(4 * shuffle_width(spark), shingles // BUCKET_SHINGLES), rule)), "block-members")
    popular = members.groupBy("node").agg(F.count(F.lit(1)).alias("popular"))
    rows = materialize(members.join(popular, "node"), "block-rows")
    sets = materialize(_sets_of(docs, known, rows.select(F.col("node").alias("set_id")), rule), "sets")
    merged = rows.select("node", F.col("node").alias("label")).filter("1 = 0")
    tried = links = None
    for step in ("first", "second", "across"):
        placed = rows.join(merged, "node", "left").select("block", "node", "popular", F.coalesce("label", "node").alias("label"))
        pairs = _first_heads(placed) if step == "first" else _heads(placed) if step == "second" else _across(placed, sets, rule)
        pairs = pairs.withColumns({"low": F.least("a", "b"), "high": F.greatest("a", "b")}).dropDuplicates(["low", "high"])
        pairs = materialize(pairs if tried is None else pairs.join(tried, ["low", "high"], "left_anti"), "pairs")
        if pairs.isEmpty():
            continue  # nothing untried across components in this step; the next looks wider
        tried = pairs.select("low", "high") if tried is None else tried.unionByName(pairs.select("low", "high"))
        likely = materialize(_likely(pairs.select("a", "b"), sets, rule), "likely")
        found = materialize(_products(likely, sets, rule, step == "first"), "links")
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            merged = components(links)
    return known, sets, merged


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Shared elements of each row of left with each of right (None: of left with itself), as sums of
    products of COLUMNS incidence columns; columns that only one side or one row has are left out."""
    rows = left if right is None else left + right
    size = np.array([len(x) for x in rows])
    columns, at = np.unique(np.concatenate(rows), return_inverse=True)
    row = np.repeat(np.arange(len(rows)), size)
    on_left = row < len(left)
    if right is None:
        shared = np.bincount(at, minlength=len(columns)) > 1
    else:
        shared = (np.bincount(at[on_left], minlength=len(columns)) > 0) & (np.bincount(at[~on_left], minlength=len(columns)) > 0)
    place = np.cumsum(shared) - 1
    row, at = row[shared[at]], place[at[shared[at]]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    out = np.zeros((len(left), len(rows if right is None else right)), np.int64)
    for first in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(at, (first, first + COLUMNS))
        part = np.zeros((len(rows), COLUMNS), np.float32)
        part[row[a:b], at[a:b] - first] = 1
        out += (part[: len(left)] @ (part if right is None else part[len(left) :]).T).astype(np.int64)
    return out


def _linked_rows(known: DataFrame, sets: DataFrame, merged: DataFrame, rule: Rule) -> DataFrame:
    """(node, linked): for sets within components, how many rows have another set that links with it."""

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        node, total = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for (_, _, low, high, wide), tile in rows.groupby(["label", "tile_class", "low", "high", "wide"], sort=False):
            ids, size, copies, side = (tile[c].to_numpy() for c in ("node", "size", "copies", "side"))
            packed = [np.frombuffer(x, U64) for x in tile["shingles"]]
            one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            alone = not wide and low == high
            if alone:
                two = one
            if not len(one) or not len(two):
                continue
            common = overlaps([packed[i] for i in one], None if alone else [packed[i] for i in two])
            hit = rule.of * common >= rule.number * (size[one][:, None] + size[two][None, :] - common)
            if alone:
                np.fill_diagonal(hit, False)
            node.append(ids[one])
            total.append(hit @ copies[two])
            if not alone:
                node.append(ids[two])
                total.append(hit.T @ copies[one])
        return pd.DataFrame({"node": np.concatenate(node), "linked": np.concatenate(total)})

    copies = known.join(merged, known["set_id"] == merged["node"], "left_semi").groupBy("set_id").agg(F.count(F.lit(1)).alias("copies"))
    copies = copies.select(F.col("set_id").alias("copied"), "copies")
    size = sets.select("set_id", "size")
    geometric = math.log(max(_RATIO, 1.01 * rule.of / rule.number))  # linked sizes are in one class or in neighbours
    rows = merged.join(size, merged["node"] == size["set_id"]).join(copies, F.col("node") == F.col("copied"))
    rows = materialize(rows.select("label", "node", "copies", "size", F.floor(F.log("size") / geometric).cast("int").alias("class")), "linked-sets")
    slots = rows.groupBy("label", "class").agg(F.count(F.lit(1)).alias("n"), F.greatest(F.ceil(F.count(F.lit(1)) / LINK_TILE), F.ceil(F.sum("size") / LINK_SHINGLES)).cast("int").alias("slots"))
    slots = materialize(slots, "link-slots")
    beside = lambda by, name: slots.select("label", (F.col("class") + by).alias("class"), F.col("slots").alias(name))
    slots = slots.join(beside(-1, "above"), ["label", "class"], "left").join(beside(1, "below"), ["label", "class"], "left")
    slots = materialize(slots.select(F.col("label").alias("of_label"), F.col("class").alias("of_class"), "n", "slots", "above", "below"), "link-slots")
    dealt = rows.join(slots, (F.col("label") == F.col("of_label")) & (F.col("class") == F.col("of_class"))).withColumn("slot", F.pmod(F.xxhash64("node"), F.col("slots")).cast("int"))
    tile = lambda cls, low, high, wide, side: F.struct(cls.cast("int").alias("tile_class"), low.cast("int").alias("low"), high.cast("int").alias("high"), F.lit(wide).alias("wide"), side.cast("int").alias("side"))
    slot, cls = F.col("slot"), F.col("class")
    own = F.transform(F.sequence(F.lit(0), F.col("slots") - 1), lambda o: tile(cls, F.least(slot, o), F.greatest(slot, o), False, slot > o))
    up = F.transform(F.sequence(F.lit(0), F.col("above") - 1), lambda o: tile(cls, slot, o, True, F.lit(0)))
    down = F.transform(F.sequence(F.lit(0), F.col("below") - 1), lambda o: tile(cls - 1, o, slot, True, F.lit(1)))
    none = F.filter(own, lambda _: F.lit(False))
    tiles = F.concat(F.when(F.col("n") > 1, own).otherwise(none), F.coalesce(up, none), F.coalesce(down, none))
    dealt = materialize(dealt.select("label", "node", "copies", F.explode(tiles).alias("t")).select("label", "node", "copies", "t.*"), "link-tiles")
    load = dealt.join(size, dealt["node"] == size["set_id"]).agg(F.sum("size")).first()[0] or 0
    parts = max(8 * shuffle_width(known.sparkSession), load // CALL_SHINGLES)
    whole = dealt.join(sets.select(F.col("set_id").alias("node"), "size", "shingles"), "node")
    part = F.pmod(F.xxhash64("label", "tile_class", "low", "high", "wide"), F.lit(parts)).alias("part")
    counted = whole.select(part, *dealt.columns, "size", "shingles").groupBy("part").applyInPandas(count, "node long, linked long")
    return counted.groupBy("node").agg(F.sum("linked").alias("linked"))


def _with_component(known: DataFrame, labels: DataFrame, *more: str) -> DataFrame:
    grouped = known.join(labels, known["set_id"] == labels["node"], "left").select("doc_id", "n_shingles", "set_id", F.coalesce("label", "set_id").alias("label"), *more)
    least = materialize(grouped.filter("n_shingles > 0").groupBy("label").agg(F.min("doc_id").alias("least")), "least-ids")
    out = grouped.join(least, "label", "left")
    return out.select("doc_id", "n_shingles", "set_id", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), *more)


def jaccard_components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, set_id, component_id for every row of docs."""
    known, _, merged = _connect(docs, rule)
    return _with_component(known, merged)


def jaccard_join(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, set_id, component_id, n_links (other rows linked with it) for every row of docs."""
    known, sets, merged = _connect(docs, rule)
    linked = materialize(_linked_rows(known, sets, merged, rule), "linked-rows").withColumnRenamed("node", "linked_node")
    copies = known.filter("n_shingles > 0").groupBy("set_id").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").withColumnRenamed("set_id", "copied")
    nodes = merged.join(copies, F.col("node") == F.col("copied"), "full").select(F.coalesce("node", "copied").alias("node"), F.coalesce("label", "copied").alias("label"), F.coalesce("copies", F.lit(1)).alias("copies"))
    nodes = nodes.join(linked, F.col("node") == F.col("linked_node"), "left").select("node", "label", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"))
    out = _with_component(known, materialize(nodes, "set-links"), "links")
    return out.select("doc_id", "n_shingles", "set_id", "component_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def op5_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (least doc_id reachable by links), n_links."""
    return jaccard_join(read(spark, sf_dir, "documents").select("doc_id", "text"), CONTRACT).select("doc_id", "n_shingles", "component_id", "n_links")


OP5_SQL = r"""
WITH RECURSIVE word AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), shingle AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_distinct(list_transform(generate_series(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 3], ' '))) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM word
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), link AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN size m ON m.doc_id = a.doc_id JOIN size n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n HAVING 100 * count(*) >= 85 * (m.n + n.n - count(*))
), reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y
), degree AS (SELECT x, count(*) AS n_links FROM link GROUP BY x)
SELECT reach.x AS doc_id, coalesce(any_value(size.n), 0) AS n_shingles, min(reach.y) AS component_id, coalesce(any_value(degree.n_links), 0) AS n_links
FROM reach LEFT JOIN size ON size.doc_id = reach.x LEFT JOIN degree ON degree.x = reach.x GROUP BY reach.x
"""
