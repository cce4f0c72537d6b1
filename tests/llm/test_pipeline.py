"""The corpus pipeline, stage by stage against brute force on its own input."""

import hashlib
import math
import os
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline as cp
from tessera.llm import jaccard, lines, mixing, packing, quality
from tests.llm.test_models_media import plain_budgets, plain_quality
from tests.llm.test_text_ops import brute_components, brute_lines

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def brute_mix(rows):
    """Ids that a tree dealt recursively takes, each leaf its longest prefix by seeded digest. rows: (doc_id, text, lang, source)."""
    units, supply = {}, defaultdict(int)
    for i, text, lang, source in rows:
        number = re.search(r"([0-9]+)$", source or "")
        number = int(number[1]) if number else 99
        leaf = ("web" if number <= 9 else "books" if number <= 15 else "code", lang or "", source or "")
        units[i] = (leaf, len([w for w in re.split(r"[ \t\n\x0B\f\r]+", text) if w]))
        supply[leaf] += units[i][1]
    out = set()
    for leaf, budget in plain_budgets(dict(supply), mixing.SHARE * sum(supply.values()), mixing.WEIGHTS).items():
        total = 0
        for i in sorted((i for i in units if units[i][0] == leaf), key=lambda i: hashlib.md5(f"{mixing.SEED}:0:{i}".encode()).hexdigest()):
            total += units[i][1]
            if total <= budget:
                out.add(i)
    return out


def brute_pieces(rows):
    """doc_id, piece -> start, length, checksum, tokenized text by text."""
    from tokenizers import Tokenizer

    tokenizer, out = Tokenizer.from_file(packing.default_tokenizer()), {}
    for i, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        for k in range(math.ceil(len(ids) / 4096)):
            part = ids[4096 * k : 4096 * (k + 1)]
            out[i, k] = (4096 * k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    return out


def test_stages(spark):
    docs = cp.read(spark, SF, "documents")
    before = {r["doc_id"]: r for r in docs.collect()}
    out = cp.materialize(cp.quality_filter(spark, docs, SF), "t")
    field = quality.teach(docs, cp.read(spark, SF, "labels"))
    score = {i: field.score(np.array([plain_quality(r["text"], field)]))[0] for i, r in before.items()}
    good = {i for i, x in score.items() if x >= quality.KEEP_FROM}
    assert min(abs(x - quality.KEEP_FROM) for x in score.values()) > 1e-4  # no rounding decides
    assert out.columns == cp.COLUMNS and {r["doc_id"] for r in out.collect()} == good and len(good) > 0.7 * len(before)

    rows = [(r["doc_id"], r["text"]) for r in out.collect()]
    expect = {i: t for i, (t, n) in brute_lines(rows, lines.WINDOW).items() if not n or t.strip(" ")}
    out = cp.materialize(cp.line_dedup(spark, out, SF), "t")
    got = {r["doc_id"]: r for r in out.collect()}
    assert {i: r["text"] for i, r in got.items()} == expect and all(r["n_chars"] == len(r["text"]) for r in got.values())

    keep = {i for i, (n, c) in brute_components(list(expect.items()), jaccard.Rule()).items() if i == c}
    out = cp.materialize(cp.near_duplicates(spark, out, SF), "t")
    assert out.columns == cp.COLUMNS and {r["doc_id"] for r in out.collect()} == keep

    mixed = cp.materialize(cp.mix(spark, out, SF), "t")
    chosen = brute_mix([(r["doc_id"], r["text"], r["lang"], r["source"]) for r in out.collect()])
    assert mixed.columns == cp.COLUMNS and {r["doc_id"] for r in mixed.collect()} == chosen and 0 < len(chosen) < len(keep)

    packed = cp.pack(spark, mixed, SF).toPandas()
    pieces = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in packed.itertuples()}
    assert pieces == brute_pieces([(i, expect[i]) for i in chosen])
    full = packed.groupby("sequence_id")["length"].sum()
    assert full.max() <= 4096 and len(full) == math.ceil(packed["length"].sum() / 4096) + int(packed["gap"].max())
    for _, row in packed.sort_values("offset").groupby("sequence_id"):
        assert (row["offset"] == row["length"].cumsum() - row["length"]).all()


def test_run_is_registered_and_agrees(spark):
    import __spark_entry__ as entry

    assert 4 <= len(cp.STAGES) <= 5 and "pipeline" in entry.queries()
    assert entry.queries()["pipeline"](spark, SF).count() > 0


def test_edge_cases_pass_through(spark, tmp_path):
    """Nulls anywhere, empty and very long texts, repeated rows, clashing columns, and empty tables."""
    from pyspark.sql import functions as F

    long_ = "\n".join(f"A fine sentence number {k} stands here, as it should." for k in range(4000))
    rows = [(1, None, "en", "src1"), (2, "", None, None), (None, "Some words of a text without an id.", "en", "src2"), (3, long_, "de", "src3"), (3, long_, "de", "src3"), (4, long_, "de", "src11"), (5, "Two lines.\nAnd more of them.", "fr", "src20"), (6, " ", "en", ""), (None, None, None, None)]
    d = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    d = d.withColumns({c: F.lit("clash") for c in ("score", "gone", "row", "epoch", "label", "_id", "size")})
    for name, table in (("some", d), ("none", d.filter("false"))):
        folder = tmp_path / name
        table.write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([(3, 1, 0), (5, 1, 0), (6, 0, 0), (2, 0, 0), (7, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
        docs = cp.read(spark, str(folder), "documents")
        for _, stage in cp.STAGES[:-1]:
            docs = cp.materialize(stage(spark, docs, str(folder)), "edge")
            assert docs.columns == cp.COLUMNS
        packed = cp.STAGES[-1][1](spark, docs, str(folder)).collect()
        assert len(packed) >= docs.count() and (name == "some" or not packed)
        cp.run(spark, str(folder)).collect()
