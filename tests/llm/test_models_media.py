"""Classifiers, media, extraction, mixing and the pipeline."""

import hashlib
import math
import time
import glob
import os
import random
import struct
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import htmltext, lines, mixing, quality, queries, toxicity, webp
from tessera.llm._labels import held_out

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src1", len(t or ""), "clash") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score string").repartition(3)


# -- WebP -------------------------------------------------------------------------------------


class Writer:
    def __init__(self):
        self.value = self.n = 0

    def put(self, v, n):
        self.value |= v << self.n
        self.n += n

    def simple(self, *symbols):
        self.put(1, 1)
        self.put(len(symbols) - 1, 1)
        self.put(1, 1)
        for s in symbols:
            self.put(s, 8)

    def lengths(self, lengths):
        """A normal code of lengths below 16, each written in four bits."""
        self.put(0, 1)
        self.put(15, 4)
        for s in webp.LENGTH_ORDER:
            self.put(4 if s < 16 else 0, 3)
        self.put(0, 1)
        for n in lengths:
            self.put(int(f"{n:04b}"[::-1], 2), 4)

    def file(self, width, height, body):
        head = width - 1 | height - 1 << 14
        self_ = Writer()
        self_.put(head, 28)
        self_.put(0, 4)
        self_.put(body.value, body.n)
        raw = b"\x2f" + self_.value.to_bytes((self_.n + 7) // 8 + 2, "little")
        raw += b"\0" * (len(raw) & 1)
        return b"RIFF" + struct.pack("<I", 12 + len(raw)) + b"WEBPVP8L" + struct.pack("<I", len(raw)) + raw


def flat_pixels(w, pixels, main, cache=0):
    """Pixels whose channels have one or two values each, as simple codes. pixels: (a, r, g, b)."""
    w.put(1 if cache else 0, 1)
    if cache:
        w.put(cache, 4)
    if main:
        w.put(0, 1)
    values = [sorted({p[c] for p in pixels}) for c in (2, 1, 3, 0)]
    for v in values:
        w.simple(*v)
    w.simple(0)
    for p in pixels:
        for v, c in zip(values, (2, 1, 3, 0)):
            if len(v) == 2:
                w.put(v.index(p[c]), 1)


def test_plain_pixels_and_subtract_green():
    px = [(255, 10, 200, 7), (255, 10, 3, 9), (254, 12, 3, 7), (254, 12, 200, 9)]
    w = Writer()
    w.put(0, 1)
    flat_pixels(w, px, True)
    assert webp.decode(w.file(2, 2, w)).reshape(-1, 4).tolist() == [list(p) for p in px]
    w = Writer()
    w.put(1, 1), w.put(2, 2), w.put(0, 1)
    flat_pixels(w, px, True)
    assert webp.decode(w.file(2, 2, w)).reshape(-1, 4).tolist() == [[a, r + g & 255, g, b + g & 255] for a, r, g, b in px]


def test_palette_is_bundled():
    colours = [(255, 1, 2, 3), (255, 9, 8, 7), (0, 100, 0, 50)]
    deltas = [colours[0]] + [tuple(b - a & 255 for a, b in zip(x, y)) for x, y in zip(colours, colours[1:])]
    index = [0, 1, 2, 2, 1, 0, 1]  # one row of seven, two bits each, four to a pixel
    packed = [sum(v << 2 * k for k, v in enumerate(index[i : i + 4])) for i in (0, 4)]
    w = Writer()
    w.put(1, 1), w.put(3, 2), w.put(2, 8)
    w.put(0, 1)  # the palette's pixels: no cache
    for c in (2, 1, 3, 0):
        n = [0] * (280 if c == 2 else 256)
        values = sorted({d[c] for d in deltas})
        if len(values) < 3:
            w.simple(*values)
        else:
            for v, k in zip(values, (1, 2, 2)):
                n[v] = k
            w.lengths(n)
    w.simple(0)
    for d in deltas:
        for c in (2, 1, 3, 0):
            values = sorted({x[c] for x in deltas})
            if len(values) == 2:
                w.put(values.index(d[c]), 1)
            elif len(values) == 3:
                w.put(*{0: (0, 1), 1: (1, 2), 2: (3, 2)}[values.index(d[c])])
    w.put(0, 1)
    flat_pixels(w, [(255, 0, p, 0) for p in packed], True)
    assert webp.decode(w.file(7, 1, w)).reshape(-1, 4).tolist() == [list(colours[i]) for i in index]


def test_predictor_and_cross_colour():
    rng = random.Random(4)
    want = [tuple(rng.randrange(256) for _ in range(4)) for _ in range(25)]
    pack = lambda p: p[0] << 24 | p[1] << 16 | p[2] << 8 | p[3]
    flat = [pack(p) for p in want]
    for mode in range(14):
        left = []
        for i, p in enumerate(flat):  # residuals by the definition, with other means than the decoder's loop
            y, x = divmod(i, 5)
            guess = 0xFF000000 if i == 0 else flat[i - 1] if y == 0 else flat[i - 5] if x == 0 else webp._predict(mode, flat[i - 1], flat[i - 5], flat[i - 4], flat[i - 6])
            left.append(webp._each(lambda a, b: a - b & 255, p, guess))
        assert webp._undo_predictor(left, 5, 2, [mode << 8] * 4) == flat
    assert webp._predict(11, pack((0, 9, 0, 0)), pack((0, 1, 0, 0)), 0, pack((0, 1, 0, 0))) == pack((0, 9, 0, 0))
    assert webp._predict(12, pack((200, 9, 0, 0)), pack((100, 1, 0, 0)), 0, pack((10, 20, 0, 0))) == pack((255, 0, 0, 0))
    assert webp._predict(13, pack((0, 10, 0, 0)), pack((0, 10, 0, 0)), 0, pack((0, 13, 0, 0))) == pack((0, 9, 0, 0))
    s = lambda v: v - 256 if v > 127 else v
    to_red, to_blue, red_blue = 200, 17, 130
    e = pack((255, red_blue, to_blue, to_red))
    coded = [pack((a, r - (s(to_red) * s(g) >> 5) & 255, g, b - (s(to_blue) * s(g) >> 5) - (s(red_blue) * s(r) >> 5) & 255)) for a, r, g, b in want]
    assert webp._undo_cross_colour(coded, 5, 2, [e] * 4) == flat


def test_back_reference_and_cache():
    # green symbols: literal 5, length code 256 + 4 (5 or 6 pixels), cache entry
    w = Writer()
    w.put(0, 1), w.put(1, 1), w.put(1, 4), w.put(0, 1)
    n = [0] * 282
    key = (0x1E35A7BD * 0xFF000500 & 0xFFFFFFFF) >> 31
    n[5], n[260], n[280 + key] = 1, 2, 2
    w.lengths(n)
    w.simple(0), w.simple(0), w.simple(255)
    n = [0] * 40
    n[0], n[1] = 1, 1
    w.lengths(n)
    words = dict(zip(sorted((5, 260, 280 + key), key=lambda k: (1 if k == 5 else 2, k)), ((0, 1), (1, 2), (3, 2))))
    w.put(*words[5])
    w.put(*words[280 + key])
    w.put(*words[260]), w.put(1, 1), w.put(1, 1)  # six pixels; distance code 2: one to the left
    assert webp.decode(w.file(8, 1, w)).reshape(-1, 4).tolist() == [[255, 0, 5, 0]] * 8
    assert len(webp.NEAR) == 120 and webp.NEAR[:4] == [(0, 1), (1, 0), (1, 1), (-1, 1)] and webp.NEAR[-1] == (8, 7)


def test_media_round_trip(spark):
    rng = np.random.default_rng(0)
    rows = [(1, None), (2, ""), (3, "a"), (4, "é" * 32), (5, "x" * 64), (6, "".join(map(chr, rng.integers(1, 3000, 9000)))), (7, "x" * 64), (8, "abc " * 5000)]
    got = {r["doc_id"]: r for r in webp.read_media(webp.store_texts(docs(spark, rows))).collect()}
    for i, t in rows:
        raw = (t or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        r = got[i]
        import hashlib

        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert got[5]["media_sha256"] == got[7]["media_sha256"] and got[1]["feature"] == got[2]["feature"]
    media = webp.encode_grey(np.frombuffer(b"".join(bytes([k]) * 64 for k in range(80)), np.uint8), np.array([0, 5120]))
    assert b"".join(np.ascontiguousarray(webp.decode(x)[:, :, 2]).tobytes() for x in webp.images_of(media[0])) == b"".join(bytes([k]) * 64 for k in range(80))
    assert webp.store_texts(docs(spark, rows).filter("doc_id < 0")).count() == 0
    with pytest.raises(ValueError, match="not a lossless"):
        webp.decode(b"RIFF" + b"\0" * 30)


def uses_matches(image):
    """Whether the plain head is followed by a green code of 280 lengths."""
    head = webp._fields(None, webp._MATCHED)
    data, at = np.frombuffer(image + b"\0" * 16, np.uint8), np.array([21 * 8])
    return all(webp._bits_at(data, at + p, n)[0] == v for v, n, p in webp._placed(head) if p != 14)


def test_back_references_are_written_and_read():
    rng = random.Random(6)
    words_ = ["".join(rng.choices("abcdefgh é", k=rng.randint(2, 9))) for _ in range(40)]
    texts = [b"a" * 4096, b"ab" * 3000, bytes(range(256)) * 40, rng.randbytes(9000), b"x" * 64, b"abcdefgh" * 8, b"abc" * 64 + rng.randbytes(4032) + b"abc" * 900]
    texts += [" ".join(rng.choices(words_, k=rng.randint(1, 3000))).encode() for _ in range(30)]
    rows = [t + b"\0" * (-len(t) % 64) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    media = webp.encode_grey(np.frombuffer(b"".join(rows), np.uint8), offsets)
    assert webp.decode_grey(media) == rows
    images = [webp.images_of(m) for m in media]
    assert [b"".join(np.ascontiguousarray(webp.decode(x)[:, :, 2]).tobytes() for x in y) for y in images] == rows  # the full decoder agrees
    flat = [x for y in images for x in y]
    assert 0.2 < sum(map(uses_matches, flat)) / len(flat) < 1 and not any(map(uses_matches, images[3]))
    alone = [webp.encode_grey(np.frombuffer(r, np.uint8), np.array([0, len(r)]))[0] for r in rows]
    assert alone == media  # wherever a text lies
    cut = flat[[uses_matches(x) for x in flat].index(True)]
    for k in (60, len(cut) // 2):  # damaged streams are errors or other samples, never a crash of the batch
        try:
            webp.decode_grey([cut[:k] + bytes([cut[k] ^ 255]) + cut[k + 1 :], media[0]])
        except ValueError:
            pass


def test_media_query(spark, tmp_path):
    """Every column of the query by plain means, over the stored files themselves."""
    import math

    rows = [(1, None), (2, ""), (3, "é😀" * 50), (4, "plain text, " * 900), (4, "plain text, " * 900), (5, "x" * 64), (6, "\0")]
    docs(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    stored = {r["doc_id"]: bytes(r["media"]) for r in webp.store_texts(docs(spark, rows)).collect()}
    got = webp.op3_webp_media(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in got) == [i for i, _ in rows]
    texts = dict(rows)
    for r in got:
        raw, media = (texts[r["doc_id"]] or "").encode(), stored[r["doc_id"]]
        payload = raw + b"\0" * ((-len(raw)) % 64 if raw else 64)
        assert b"".join(np.ascontiguousarray(webp.decode(x)[:, :, 2]).tobytes() for x in webp.images_of(media)) == payload
        share = [payload.count(bytes([v])) / len(payload) for v in set(payload)]
        feature = f"{sum(payload) / len(payload):.4f};{abs(-sum(p * math.log2(p) for p in share)):.4f}"
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r["media_bytes"], r["media_sha256"], r["feature"]) == (len(media), hashlib.sha256(media).hexdigest(), feature)


def test_predictors_by_their_definition():
    """The fourteen modes spelled out on four channels."""
    rng = random.Random(5)
    for _ in range(300):
        left, top, right, corner = ([rng.choice([0, 1, 127, 128, 254, 255, rng.randrange(256)]) for _ in range(4)] for _ in range(4))
        half = lambda a, b: [(x + y) // 2 for x, y in zip(a, b)]
        clamp = lambda v: max(0, min(255, v))
        mean = half(left, top)
        manhattan = lambda p: sum(abs(l + t - c - x) for l, t, c, x in zip(left, top, corner, p))  # noqa: E731, E741
        expect = [
            [255, 0, 0, 0], left, top, right, corner, half(half(left, right), top), half(left, corner), mean, half(corner, top), half(top, right), half(half(left, corner), half(top, right)),
            left if manhattan(left) < manhattan(top) else top, [clamp(a + b - c) for a, b, c in zip(left, top, corner)], [clamp(m + int((m - c) / 2)) for m, c in zip(mean, corner)],
        ]
        pack = lambda p: p[0] << 24 | p[1] << 16 | p[2] << 8 | p[3]
        for mode, want in enumerate(expect):
            assert webp._predict(mode, pack(left), pack(top), pack(right), pack(corner)) == pack(want), mode


# -- classifiers ------------------------------------------------------------------------------


@needs_tables
@pytest.mark.parametrize(("name", "label", "least"), [("op10_quality_classifier", "quality", 0.95), ("op2_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.1").toPandas()
    truth = duckdb.sql(f"SELECT doc_id, {label} AS truth FROM '/root/testdata/sf0.1/labels.parquet'").df()
    m = got.merge(truth, on="doc_id")
    m = m[m["held_out"]]
    assert (m["held_out"] == (m["doc_id"].astype(str).map(lambda x: zlib.crc32(x.encode())) % 5 == 0)).all()
    assert (m["predicted"] == m["truth"]).mean() >= least and got["score"].between(0, 1).all()


def test_classifiers_without_labels(spark):
    d = docs(spark, [(1, None), (2, ""), (3, "some words here"), (3, "some words here")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.teach(d, none) is None and quality.teach(d, none) is None
    assert {r["score"] for r in quality.score_quality(d, None, ["doc_id"]).collect()} == {0.5}
    assert {r["score"] for r in toxicity.score_toxicity(d, None, ["doc_id"]).collect()} == {0.0}
    assert quality.score_quality(d.filter("doc_id < 0"), None, ["doc_id"]).count() == 0
    odd = spark.createDataFrame([(3, None, 1), (None, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    field = quality.teach(d, odd.filter(~held_out(F.col("doc_id"))))
    assert field is None or len(quality.score_quality(d, field, ["doc_id"]).collect()) == 4


def test_chain_marginals_are_exact():
    rng = np.random.default_rng(0)
    f = quality.Field(3)
    f.weights, f.moves = rng.normal(size=3), rng.normal(size=(2, 2))
    x, first = rng.normal(size=(7, 3)), np.array([0, 4, 5, 7])
    good, _ = f.marginals(x, first)
    for a, b in zip(first[:-1], first[1:]):
        total, mass = 0.0, np.zeros(b - a)
        for s in range(1 << (b - a)):
            y = [s >> k & 1 for k in range(b - a)]
            lean = x[a:b] @ f.weights
            p = np.exp(sum(v for v, k in zip(lean, y) if k) + sum(f.moves[i, j] for i, j in zip(y, y[1:])))
            total += p
            mass += p * np.array(y)
        assert good[a:b] == pytest.approx(mass / total)


def plain_quality(text, field):
    """The field's document quality line by line and word by word."""
    import math
    import re

    data, lines_, own, seen, back = (text or "").encode(), [], [], set(), []
    for line in data.split(b"\n"):
        ws = re.findall(rb"[^\x20\x09-\x0D]+", line)
        repeats = 0
        for w in ws:
            back.append(w)
            t = tuple(back[-3:])
            if len(t) == 3:
                repeats += t in seen
                seen.add(t)
        n, k = len(line), max(len(ws), 1)
        shares = [sum(c in members for c in line) / max(n, 1) for members in quality._CLASSES.values()]
        own.append([*shares, math.log1p(n) / 8, sum(map(len, ws)) / k / 10, repeats / k, n == 0, 0 < len(ws) < 4, line[-1:] in (b".", b"?", b"!", b":", b";"), min(1, sum(len(w) > 25 for w in ws) / k * 5), 1])
        lines_.append(max(n, 1))
    zero = [0] * len(own[0])
    lean = []
    for i, x in enumerate(own):
        x = np.array([*x, *(own[i - 1] if i else zero), *(own[i + 1] if i + 1 < len(own) else zero)], float)
        lean.append(float(np.clip(field.scaled(x) @ field.weights, -30, 30)))
    s = np.exp(np.clip(field.moves, -5, 5))
    ahead, behind = [], [np.ones(2)]
    for i, x in enumerate(lean):
        e = np.array([1 / (1 + math.exp(x)), 1 / (1 + math.exp(-x))])
        a = e if i == 0 else (ahead[-1] @ s) * e
        ahead.append(a / a.sum())
    for x in lean[:0:-1]:
        e = np.array([1 / (1 + math.exp(x)), 1 / (1 + math.exp(-x))])
        b = s @ (behind[-1] * e)
        behind.append(b / b.sum())
    good = [(a * b)[1] / (a * b).sum() for a, b in zip(ahead, behind[::-1])]
    return sum(g * w for g, w in zip(good, lines_)) / sum(lines_)


def random_field(seed):
    rng = np.random.default_rng(seed)
    f = quality.Field(3 * quality._OWN)
    f.weights, f.moves = rng.normal(size=3 * quality._OWN), rng.normal(size=(2, 2)) * 2
    f.centre, f.spread = rng.random(3 * quality._OWN) / 5, rng.random(3 * quality._OWN) + 0.5
    return f


def test_quality_line_by_line():
    r = random.Random(4)
    words_ = ["a", "Bc", "x|y", "12", "é", "#" * 5, "w" * 30, "end.", "?"]
    texts = ["", "\n", "one", "a\n\n", *("\n".join(" ".join(r.choices(words_, k=r.randint(0, 9))) for _ in range(r.randint(1, 60))) for _ in range(25))]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    for seed in range(3):
        f = random_field(seed)
        expect = [plain_quality(t, f) for t in texts]
        assert f.quality(*quality.line_features(data, offsets)) == pytest.approx(expect, abs=1e-5)
        for most in (31, 64, 1 << 20):  # in blocks of any size; 31 bytes hold any word here
            assert [f.long_quality(np.frombuffer(x, np.uint8), most) for x in raw] == pytest.approx(expect, abs=1e-5)


def test_quality_of_very_long_texts(spark):
    import resource

    f = random_field(9)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert 0 <= f.long_quality(np.full(5_000_000, 10, np.uint8)) <= 1
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000  # KB; some 16 bytes a line and blocks
    long_ = "word word2 and.\n" * 3000
    rows = [(1, long_), (2, "short"), (3, None), (4, long_), (5, "w" * 3_000_000), (6, "\n" * 100_000), (7, "")]
    got = {r["doc_id"]: r["score"] for r in quality.score_quality(docs(spark, rows), f, ["doc_id"]).collect()}
    assert got[1] == got[4] and got[3] == got[7] and len(got) == 7
    assert got[1] == pytest.approx(f.score(np.array([plain_quality(long_, f)]))[0], abs=1e-4)


def test_teachers_are_bounded(spark, monkeypatch):
    rows = [(i, "good line of words.\nand another one." if i % 2 else "### | |\n###") for i in range(60)] + [(60, "\n" * 5000)]
    d, lab = docs(spark, rows), spark.createDataFrame([(i, i % 2, i % 2) for i in range(61)], "doc_id long, quality int, toxic int")
    assert quality.teach(d, lab) is not None and toxicity.teach(d, lab) is not None
    monkeypatch.setattr(quality, "MOST_LINES", 20)
    monkeypatch.setattr(toxicity, "MOST_COORDINATES", 30)
    assert quality.teach(d, lab) is not None and toxicity.teach(d, lab) is not None
    monkeypatch.setattr(quality, "MOST_LINES", 0)
    assert quality.teach(d, lab) is None


def plain_ftrl(samples, labels, passes, seed):
    """FTRL-proximal coordinate by coordinate."""
    import math

    z, n, bz, bn, order = defaultdict(float), defaultdict(float), 0.0, 0.0, np.random.default_rng(seed)
    weight = lambda i: 0.0 if abs(z[i]) <= toxicity.L1 else -(z[i] - math.copysign(toxicity.L1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)
    for _ in range(passes):
        for k in order.permutation(len(samples)):
            w = {int(i): weight(int(i)) for i in samples[k]}
            bias = -bz / ((toxicity.BETA + math.sqrt(bn)) / toxicity.ALPHA)
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()) + bias)))) - labels[k]
            for i, v in w.items():
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA * v
                n[i] += g * g
            bz += g - (math.sqrt(bn + g * g) - math.sqrt(bn)) / toxicity.ALPHA * bias
            bn += g * g
    return {i: weight(i) for i in z if weight(i)}, -bz / ((toxicity.BETA + math.sqrt(bn)) / toxicity.ALPHA)


def test_ftrl_coordinate_by_coordinate():
    rng = np.random.default_rng(3)
    samples = [np.unique(np.concatenate([rng.integers(10, 200, 20), [5] if k % 3 == 0 else [6]])) for k in range(120)]
    labels = np.array([float(k % 3 == 0) for k in range(120)])
    index, value, bias = toxicity.ftrl(samples, labels, bits=8, passes=3, seed=11)
    expect, expect_bias = plain_ftrl(samples, labels, 3, 11)
    assert index.tolist() == sorted(expect) and value == pytest.approx([expect[i] for i in sorted(expect)]) and bias == pytest.approx(expect_bias)


def test_ftrl_is_sparse():
    rng = np.random.default_rng(0)
    samples = [np.unique(np.concatenate([rng.integers(10, 1000, 30), [5] if k % 3 == 0 else [6]])) for k in range(300)]
    index, value, bias = toxicity.ftrl(samples, np.array([float(k % 3 == 0) for k in range(300)]), bits=10)
    assert 5 in index and value[index.tolist().index(5)] > 0 and len(index) < 300


# -- HTML -------------------------------------------------------------------------------------


def test_main_text():
    page = """<!DOCTYPE html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body><header>top</header><nav><a href=x>menu</a></nav>
    <div class="cookie-notice">we use</div><article><h1>Head &amp; Shoulders</h1><p>One  <b>bo</b>ld.<br>Two<p>x&lt;y &#233;</p><!-- no --><div class='ad'>buy</div><aside>side</aside><p></p><p></p><p></p><p>short</p>
    <form>f</form><section class="comments"><p>bad</p></section></article><div id="sidebar"><p>more</p></div><footer>&copy;</footer></body>"""
    assert htmltext.main_text(page) == "Head & Shoulders\n\nOne bold. Two\n\nx<y é\n\nshort"
    plain = "<body><div><a href=1>a</a> <a href=2>b</a></div><div><h2>T</h2><p>long enough text here</p><p>b</p></div><div><p>tiny</p></div><div class=footer>z"
    assert htmltext.main_text(plain) == "T\n\nlong enough text here\n\nb"
    assert [htmltext.main_text(x) for x in (None, "", "<p", "just text", "<article><p>cut off <a hre")] == ["", "", "", "just text", "cut off"]


@pytest.mark.parametrize(
    "kept",
    [
        '<div style="overflow:hidden">{}</div>', '<div class="overflow-hidden">{}</div>', '<div aria-hidden="false">{}</div>', '<a href="/hidden-gems">{}</a>', '<a href="?id=search">{}</a>', '<section id="discussion">{}</section>',
        '<section id="search">{}</section>', '<h2 id="related-work">{}</h2>', '<p class="ad-hoc">{}</p>', '<div class="ad-hoc">{}</div>', '<div class="no-sidebar">{}</div>', '<div data-class="ad" title="display: none">{}</div>', '<p data-note="x hidden">{}</p>',
    ],
)
def test_text_that_only_looks_like_boilerplate(kept):
    assert htmltext.main_text(f"<article><p>one</p>{kept.format('two')}<p>three</p></article>").split() == ["one", "two", "three"]


@pytest.mark.parametrize("attributes", ["hidden", 'HIDDEN=""', 'style="color:red; display : none"', "class='post cookie-notice'", "class=siteFooter", "id=sidebar", "id='ad-slot-2'", "role=navigation", 'aria-label="Cookie consent"'])
def test_marked_boilerplate(attributes):
    assert htmltext.main_text(f"<article><p>one</p><div {attributes}>two</div><p>three</p></article>").split() == ["one", "three"]
    assert htmltext.main_text("<article><p>one</p></article><article class='comment'>no</article>") == "one"


def test_main_text_of_several_blocks():
    first, second, third = ("one two three four five six seven eight nine ten. " * n for n in (6, 9, 4))
    parts = [first.strip(), second.strip(), "Yes.", third.strip()]
    menu = "<div><a href=1>Home</a> <a href=2>About us</a></div>"
    page = f"<body>{menu}<div><h1>Title</h1></div>" + "".join(f"<div><section><p>{p}</p></section></div>" for p in parts) + "<div>(c) us</div>"
    assert htmltext.main_text(page) == "\n\n".join(["Title", *parts])
    cards = "".join(f"<article><h3><a href={k}>Card {k}</a></h3><p>Short teaser {k}</p></article>" for k in range(20))
    beside = htmltext.main_text(f"<body><div id=content><p>{first}</p><p>{second}</p></div>{cards}")
    assert beside.startswith("\n\n".join(parts[:2]))  # many small articles don't silence the text beside them
    assert htmltext.main_text(f"<body><div>{third}</div><article><p>{second}</p><div>x</div><div>y</div></article>") == f"{parts[1]}\n\nx\n\ny"
    posts = "<article><p>ok</p></article>" + f"<article><p>{second}</p></article>" + "<article><p>thanks</p></article>"
    assert htmltext.main_text(f"<body>{posts}<div>{third}</div>") == f"ok\n\n{parts[1]}\n\nthanks"


@pytest.mark.parametrize(
    "page",
    [
        '<p class="notice">no<p>two</p>', '<p class="notice">no <b>way</b><div>two</div>', '<ul><li class="share">no<ul><li>no</ul><li>two</ul>', '<ul><li class="share">no</ul><p>two', '<dl><dt>two<dd class="ad">no</dl>',
        '<table><tr><td class="ad">no<table><tr><td>no</table><td>two</table>', '<table><tr class="ad"><td>no<tr><td>two</table>', '<div><p class="advert">no</div><p>two', '<div class="ad">no<div>no</div></div>two', '<span class="market-share">two</span>', '<p title="the hidden valley">two</p>',
    ],
)
def test_implied_ends(page):
    assert htmltext.main_text(f"<article><p>one</p>{page}<p>three</p></article>") == "one\n\ntwo\n\nthree"
    assert htmltext.main_text(f"<article><p>one</p>{page}</article>") == "one\n\ntwo"


def test_blocks_and_borders(spark):
    assert htmltext.main_text("<article><h1>T</h1><p>one</p><p>two</p></article>") == "T\n\none\n\ntwo"
    assert htmltext.main_text("<article><p>one<div class=ad>never closed</article><footer>f</footer>") == "one"
    long_ = "<article>" + "<p>word and word</p>" * 50_000
    rows = [(1, "u", long_), (1, "u", long_), (2, None, None), (3, "v", ""), (4, "v", "   ")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(0))
    got = sorted((r["page_id"], r["n_chars"]) for r in htmltext.extract(pages, ["page_id", "url"]).collect())
    assert got == [(1, 50_000 * 15 - 2), (1, 50_000 * 15 - 2), (2, 0), (3, 0), (4, 0)]
    assert htmltext.extract(pages.filter("page_id < 0"), ["page_id"]).count() == 0


@needs_tables
def test_pages_hold_their_documents(spark):
    got = htmltext.op9_html_extraction(spark, SF).collect()
    texts = {"\n\n".join(" ".join(x.split()) for x in t.split("\n") if x.strip()) for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()}
    assert sum(r["text"].split("\n\n", 1)[-1] in texts for r in got) == len(got) and all(r["n_chars"] == len(r["text"]) for r in got)


# -- mixing -----------------------------------------------------------------------------------


def plain_split(budget, weights, capacity):
    """Siblings fill in turns until none is above its capacity."""
    got, free, left = [0.0] * len(weights), [i for i, w in enumerate(weights) if w > 0 and capacity[i] > 0], min(budget, sum(c for w, c in zip(weights, capacity) if w > 0))
    while free and left > 1e-9:
        total = sum(weights[i] for i in free)
        full = [i for i in free if capacity[i] - got[i] <= left * weights[i] / total]
        if not full:
            for i in free:
                got[i] += left * weights[i] / total
            break
        for i in full:
            left -= capacity[i] - got[i]
            got[i] = capacity[i]
        free = [i for i in free if i not in full]
    return got


def plain_budgets(supply, budget, weights, epochs=1, default=1.0):
    capacity, children, out = defaultdict(float), defaultdict(list), {}
    for leaf, tokens in sorted(supply.items()):
        for depth in range(len(leaf) + 1):
            capacity[leaf[:depth]] += float(tokens) * epochs
            if depth and leaf[:depth] not in children[leaf[: depth - 1]]:
                children[leaf[: depth - 1]].append(leaf[:depth])

    def deal(node, amount):
        if not children[node]:
            out[node] = int(amount + 1e-6)
            return
        for child, part in zip(children[node], plain_split(amount, [weights.get(c, default) for c in children[node]], [capacity[c] for c in children[node]])):
            deal(child, part)

    if supply:
        deal((), min(budget, capacity[()]))
    return out


def budgets(spark, supply, budget, weights, epochs=1):
    n = len(next(iter(supply))) if supply else 1
    names = [f"p{k}" for k in range(n)]
    df = spark.createDataFrame([(*k, v) for k, v in supply.items()], ", ".join(f"{a} string" for a in names) + ", tokens long")
    return {tuple(r[a] for a in names): r["budget"] for r in mixing.leaf_budgets(df, names, budget, weights, epochs).collect()}


def test_budgets(spark):
    one = lambda *x: {(str(i),): v for i, v in enumerate(x)}
    assert budgets(spark, one(30, 200), 100, {}) == one(30, 70)
    assert budgets(spark, one(500, 500, 500), 100, {("0",): 3, ("1",): 1, ("2",): 0}) == one(75, 25, 0)
    assert budgets(spark, one(10, 20), 100, {}) == one(10, 20) and budgets(spark, {}, 5, {}) == {}
    supply = {("a", "x"): 10, ("a", "y"): 1000, ("b", "z"): 5}
    assert budgets(spark, supply, 100, {("a",): 1, ("b",): 1, ("a", "x"): 1, ("a", "y"): 1}) == {("a", "x"): 10, ("a", "y"): 85, ("b", "z"): 5}  # b's shortage goes to a; x's to y
    assert budgets(spark, supply, 10_000, {}, 3)[("b", "z")] == 15
    r = random.Random(2)
    for _ in range(4):
        supply = {(f"a{r.randint(0, 3)}", f"b{r.randint(0, 4)}", f"c{k}"): r.choice([0, 1, 7, 100, 5000]) for k in range(40)}
        weights = {k[:d]: r.choice([0, 0.5, 1, 3]) for k in list(supply)[::2] for d in (1, 2, 3)}
        budget = r.random() * sum(supply.values())
        got, expect = budgets(spark, supply, budget, weights, 2), plain_budgets(supply, budget, weights, 2)
        assert got.keys() == expect.keys() and all(abs(got[k] - expect[k]) <= 1 for k in got)


def test_mix_takes_prefixes(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "en" if i % 3 else "de", "src0" if i % 2 else f"src{i % 13}", 0) for i in range(400)] + [(400, None, None, None, 0), (0, "w", "de", "src0", 0), (0, "w", "de", "src0", 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = mixing.choose(d, mixing.source_path(), weights=mixing.WEIGHTS, share=0.6, epochs=2).collect()

    units = defaultdict(int)
    for i, t, lang, source, _ in rows:
        n = int("".join(filter(str.isdigit, source or "")) or 99)
        units[(i, t, "web" if n <= 9 else "books" if n <= 15 else "code", lang or "", source or "")] += len((t or "").split())
    supply = defaultdict(int)
    for (_, _, dom, lang, source), n in units.items():
        supply[(dom, lang, source)] += n
    expect = set()
    for leaf, budget in budgets(spark, dict(supply), 0.6 * sum(supply.values()), mixing.WEIGHTS, 2).items():
        for epoch in range(2):
            part, total = min(budget, supply[leaf]), 0
            if budget <= 0:
                continue
            for key in sorted((k for k in units if k[2:] == leaf), key=lambda k: hashlib.md5(f"{mixing.SEED}:{epoch}:{k[0]}".encode()).hexdigest()):
                total += units[key]
                if total <= part:
                    expect.add((key[0], *leaf, epoch))
            budget -= supply[leaf]
    assert {(r["doc_id"], r["domain"], r["lang"], r["source"], r["epoch"]) for r in got if r["doc_id"]} == {e for e in expect if e[0]}
    d = d.withColumns({c: F.lit("clash") for c in ("_id", "_key", "row", "taken_id", "body_key", "epoch")})
    whole = mixing.mix_sources(d, mixing.source_path(), weights=mixing.WEIGHTS, share=0.6)
    assert whole.columns == d.columns and whole.count() > 0 and mixing.choose(d.filter("doc_id < 0"), mixing.source_path(), weights={}, share=1.0).count() == 0


def test_mix_of_rows_without_doc_id(spark):
    """They are dealt to all slices by their text, and the leaf's prefix is the one by hand."""
    texts = [f"w{k} " * (1 + k % 5) for k in range(3000)] + [None, "", "w1 w1 "]
    d = spark.createDataFrame([(None, t, "en", "s") for t in texts], "doc_id long, text string, lang string, source string").repartition(4)
    got = mixing.choose(d, mixing.source_path(), weights={}, share=0.5).collect()
    units = {r["k"]: r["n"] for r in d.selectExpr("xxhash64(text) AS k", "size(filter(split(coalesce(text, ''), '[ ]+'), w -> w <> '')) AS n").groupBy("k").agg(F.sum("n").alias("n")).collect()}
    place = {k: hashlib.md5(f"{mixing.SEED}:0:text:{k}".encode()).hexdigest() for k in units}
    assert len({v[:3] for v in place.values()}) > 2000
    budget, total, expect = math.floor(0.5 * sum(units.values()) + 1e-6), 0, set()
    for k in sorted(units, key=place.get):
        total += units[k]
        if total > budget:
            break
        expect.add(k)
    assert {r["body_key"] for r in got} == expect and 1000 < len(expect) < 2000



# -- queries and the pipeline -----------------------------------------------------------------


@needs_tables
def test_line_dedup_sql(spark):
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS FROM '{SF}/documents.parquet'")
    a = lines.op8_line_dedup(spark, SF).toPandas().sort_values("doc_id", ignore_index=True)
    b = c.sql(lines.OP8_SQL).df().sort_values("doc_id", ignore_index=True)
    assert (a[b.columns] == b).all().all() and a["n_removed"].sum() > 0


@needs_tables
def test_all_are_registered():
    names = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert names == list(range(1, 11)) and set(queries.SQL) <= set(queries.QUERIES)
    assert glob.glob(f"{SF}/*.parquet")


SENTENCE = "This is a long sentence of the text which goes on and on until it is surely longer than any menu, and then some more words."


@pytest.mark.parametrize(
    "page, want",
    [
        ('<body><form id="aspnetForm"><div><p>{L}</p><p>{L}</p></div></form></body>', "L\n\nL"), ('<body><div class="content search"><p>{L}</p></div></body>', "L"),
        ("<body><aside>side<p>s</p><div><p>{L}</p></div></body>", "L"), ("<body><div><aside>x<p>unclosed</div><div><p>{L}</p></div>", "L"),
        ("<body><div><p>{L}</p></div><div><p>The end.</p></div><div>Menu</div></body>", "L\n\nThe end."), ("<body><div><p>Short start.</p></div><div><p>{L}</p></div></body>", "Short start.\n\nL"),
        ("<body><header><nav>menu</nav>logo<h1>Title</h1></header><main><p>{L}</p></main></body>", "Title\n\nL"), ("<body><header><h1>Site</h1></header><main><h1>Title</h1><p>{L}</p></main></body>", "Title\n\nL"),
        ("<body><header><h1>Title</h1><p>by me</p></header><div><p>{L}</p></div><footer>f</footer>", "Title\n\nL"), ("<p>press <button>OK</button> now</p>", "press now"), ("<p>a<script>x</script>b</p>", "ab"),
        ("<div><form><input><p>search here</p></form></div><p>{L}</p>", "L"), ("<div class=comments><p>{L}</p></div><article><p>{L}</p><p>{L}</p></article>", "L\n\nL"), ("<div hidden><p>{L}</p><p>{L}</p></div><p>{L}</p>", "L"),
    ],
)
def test_no_page_is_lost(page, want):
    assert htmltext.main_text(page.replace("{L}", SENTENCE)).replace(SENTENCE, "L") == want


def test_pages_table(spark):
    rows = [(1, "u", f"<form><p>{SENTENCE}</p></form>"), (1, "u", f"<form><p>{SENTENCE}</p></form>"), (2, None, None), (3, "v", "<div class=ad>" * 5000), (4, "w", "<form>" * 2000 + f"<p>{SENTENCE} " * 3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in ("text", "n_chars", "body")})
    got = sorted((r["page_id"], r["n_chars"]) for r in htmltext.extract(pages, ["page_id", "url"]).collect())
    n = len(SENTENCE)
    assert got == [(1, n), (1, n), (2, 0), (3, 0), (4, 3000 * n + 2 * 2999)]
    assert htmltext.extract(pages.limit(0), ["page_id"]).count() == 0


def test_quality_of_long_texts_of_distinct_words():
    """Twenty megabytes of words that never repeat, in a moment; the doubling runs find what a set does."""
    rng = np.random.default_rng(0)
    text = " ".join(f"{i:x}" for i in rng.integers(1 << 24, 1 << 30, 2_500_000)).encode()
    start = time.time()
    field = quality.Field(3 * quality._OWN)
    assert 0 <= field.long_quality(np.frombuffer(text, np.uint8)) <= 1 and time.time() - start < 60
    seen, known = quality.Seen(), set()
    for _ in range(200):
        some = np.unique(rng.integers(0, 3000, 40).astype(np.uint64))
        had = seen.had(some)
        assert had.tolist() == [int(x) in known for x in some]
        seen.add(some[~had])
        known |= set(some.tolist())
    assert sum(map(len, seen.runs)) == len(known) and len(seen.runs) < 13
