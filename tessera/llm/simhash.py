"""Document fingerprints: SimHash, with DataFrame functions only.

A text's terms are its word 5-shingles (a shorter text is one term). Each term's 64-bit hash votes
on 64 signed bits with the term's frequency as weight; a bit of the fingerprint is set where more
than half of the votes are for it. Votes are counted in 32 sums of two 32-bit lanes each, which
the partial aggregation reduces to one row per text before the shuffle.

near_fingerprints() finds all fingerprints within a Hamming radius r by permuted block tables: the
64 bits fall into k blocks, k - r of which any such pair has in common, so each table is keyed by
k - r blocks moved to the front. A pair is reported by the first table in which it meets. k follows
from the number of fingerprints, so that a key of a table has about one of them however many there
are: more blocks make longer keys, and more tables. It searches a stated query set against all
fingerprints, each different fingerprint once.

The document that follows another by doc_id is found without a global sort of texts: ids alone are
range-partitioned, neighbours are looked up inside a partition, and the first id of each partition
(one row per partition) bridges the gaps.

Defined results: null texts are empty and have one term; rows that repeat doc_id and text are
returned each, with equal values; of different texts under one doc_id the least prefix follows the document before;
rows without doc_id follow nothing, keep their text and have near_next 0; one document follows
itself; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._tables import materialize, read, shuffle_width

SHINGLE = 5
RADIUS = 3
QUERY_EVERY = 50
_LANES = 0x0000000100000001


def fingerprints(texts: DataFrame, keys: list[str], body: str) -> DataFrame:
    """The key columns with `simhash` (64 bits) of the text in `body`, and `copies`, the rows that have both."""
    words = texts.select(*keys, F.transform(F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != ""), lambda w: F.xxhash64(w)).alias("_words"))
    several = F.transform(F.sequence(F.lit(0), F.size("_words") - SHINGLE), lambda i: F.xxhash64(F.slice("_words", i + 1, SHINGLE)))
    term = F.when(F.size("_words") >= SHINGLE, several).otherwise(F.array(F.xxhash64("_words")))
    votes = words.select(*keys, F.posexplode(term).alias("_at", "_term"))
    sums = [F.sum(F.shiftrightunsigned("_term", k).bitwiseAND(F.lit(_LANES))).alias(f"_votes{k}") for k in range(32)]
    counted = votes.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"), F.count_if(F.col("_at") == 0).alias("copies"), *sums)
    bit = lambda ones, k: F.when(ones * 2 > F.col("_all"), F.shiftleft(F.lit(1).cast("long"), k)).otherwise(F.lit(0).cast("long"))
    out = F.lit(0).cast("long")
    for k in range(32):
        low, high = F.col(f"_votes{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"_votes{k}", 32)
        out = out.bitwiseOR(bit(low, k)).bitwiseOR(bit(high, k + 32))
    return counted.select(*keys, out.alias("simhash"), "copies")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def blocks_for(n: int, radius: int = RADIUS) -> int:
    """The fewest blocks whose tables' keys have as many bits as numbers up to n."""
    k = radius + 2
    while k < 16 and 64 * (k - radius) // k < int(n).bit_length():
        k += 1
    return k


def near_fingerprints(queries: DataFrame, all_: DataFrame, radius: int = RADIUS, blocks: int = RADIUS + 2) -> DataFrame:
    """(query, simhash) for every distinct `simhash` of all_ within radius bits of one of queries."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    signed = lambda m: F.lit(m - (1 << 64) if m >> 63 else m).cast("long")
    tables = list(combinations(range(blocks), blocks - radius))
    front = [sum(masks[k] for k in t) for t in tables]
    entry = lambda c: F.array(*[F.struct(F.lit(t).alias("table"), c.bitwiseAND(signed(m)).alias("front")) for t, m in enumerate(front)])
    left = queries.select(F.col("simhash").alias("query")).distinct().select("query", F.inline(entry(F.col("query"))))
    right = all_.select("simhash").distinct().select("simhash", F.inline(entry(F.col("simhash"))))
    # a pair is reported where the table's blocks are the first that agree: all others before its last one differ
    differ = F.transform(F.array(*[signed(m) for m in masks]), lambda m: F.col("query").bitwiseXOR(F.col("simhash")).bitwiseAND(m) != 0)
    others = F.array(*[F.array(*[F.lit(k) for k in range(t[-1]) if k not in t]).cast("array<int>") for t in tables])
    met = left.alias("l").join(right.alias("r"), (F.col("l.table") == F.col("r.table")) & (F.col("l.front") == F.col("r.front")) & (distance(F.col("query"), F.col("simhash")) <= radius))
    met = met.select(F.col("l.table").alias("table"), "query", "simhash").withColumn("differ", differ)
    return met.filter(F.forall(others[F.col("table")], lambda k: F.col("differ")[k])).select("query", "simhash")


def followers(docs: DataFrame) -> DataFrame:
    """doc_id, next_id (of the last: the first) and `need`, the characters wanted of the next."""
    ids = docs.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.floor(F.length(F.coalesce("text", F.lit(""))) / 4)).cast("int").alias("need"))
    ids = ids.repartitionByRange(shuffle_width(docs.sparkSession), "doc_id").withColumn("part", F.spark_partition_id())
    ids = materialize(ids, "followers")
    firsts = ids.groupBy("part").agg(F.min("doc_id").alias("first"))  # one row per partition
    bridge = firsts.select("part", F.coalesce(F.lead("first").over(Window.orderBy("part")), F.min("first").over(Window.partitionBy())).alias("after"))
    inside = F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    return ids.withColumn("inside", inside).join(F.broadcast(bridge), "part").select("doc_id", F.coalesce("inside", "after").alias("next_id"), "need")


def edited_texts(docs: DataFrame, order: DataFrame) -> DataFrame:
    """doc_id, text and edited: the last quarter replaced by the beginning of the next document."""
    named = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    wanted = order.select(F.col("doc_id").alias("_to"), F.col("next_id").alias("_from"), "need")
    # both joins deal the texts by doc_id alike, so they share one exchange
    heads = named.join(wanted.hint("merge"), named["doc_id"] == F.col("_from")).select("_to", F.substring("text", F.lit(1), F.col("need")).alias("head"))
    heads = heads.groupBy("_to").agg(F.min("head").alias("head"))
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - quarter), F.substring("head", F.lit(1), quarter))
    again = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    changed = again.join(heads.hint("merge"), again["doc_id"] == F.col("_to")).select("doc_id", "text", edited.alias("edited"))
    alone = docs.filter(F.col("doc_id").isNull()).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("edited", F.col("text"))
    return changed.unionByName(alone)


def op1_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    order = materialize(followers(docs), "following")
    both = edited_texts(docs, order)
    stack = both.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), F.xxhash64("text").alias("body_key"), F.inline(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("body")))))
    keys = ["doc_id", "n_chars", "edited_sha256", "body_key"]
    votes = fingerprints(stack, [*keys, "kind"], "body")
    found = votes.groupBy(*keys).agg(F.max(F.when(F.col("kind") == 0, F.col("simhash"))).alias("simhash"), F.max(F.when(F.col("kind") == 1, F.col("simhash"))).alias("edited"), F.max("copies").alias("copies"))
    found = materialize(found, "fingerprints")
    # the stated query set: every row whose doc_id is divisible by 50, against all rows
    counts = materialize(found.groupBy("simhash").agg(F.sum("copies").alias("n")), "fingerprint-counts")
    asked = found.filter(F.col("doc_id") % QUERY_EVERY == 0).select("simhash").distinct()
    near = near_fingerprints(asked, counts, blocks=blocks_for(counts.count())).join(counts, "simhash").groupBy("query").agg(F.sum("n").alias("n_near"))
    after = found.groupBy("doc_id").agg(F.min("simhash").alias("next_simhash")).withColumnRenamed("doc_id", "next_id")
    out = found.join(order.select(F.col("doc_id").alias("_id"), "next_id"), F.col("doc_id") == F.col("_id"), "left").join(after, "next_id", "left")
    out = out.join(near, (F.col("simhash") == F.col("query")) & (F.col("doc_id") % QUERY_EVERY == 0), "left")
    text = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    like = lambda a, b: F.lit(1.0) - distance(F.col(a), F.col(b)) / F.lit(64.0)
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select("doc_id", "n_chars", "edited_sha256", text("simhash").alias("fingerprint"), text("edited").alias("edited_fingerprint"), like("simhash", "edited").alias("near_edited"), F.coalesce(like("simhash", "next_simhash"), F.lit(0.0)).alias("near_next"), "n_near")
