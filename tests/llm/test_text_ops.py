"""Byte and line operators against brute force, and their edge cases."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import jaccard, lines, packing, simhash, suffix
from tessera.llm._text import Hasher, words

LONG = " ".join(f"word{i % 977} {i}" for i in range(20_000))
PASSAGE = "In the beginning of this passage there are words which many documents share, and it runs on for well over a hundred bytes; é ü ñ."
EDGE = [
    (1, None), (2, ""), (3, "   \n\t"), (4, "one"), (5, "one two three"), (6, "One two THREE"), (7, PASSAGE + " tail a"), (8, "head b " + PASSAGE), (9, PASSAGE + PASSAGE),
    (10, "ab" * 400), (11, LONG), (12, LONG), (13, LONG + " more words at the end"), (14, "x\ny\nz\nw"), (15, "q\nx\ny\nz\nr\n\nx\ny"), (16, "x\ny"), (20, "same line\n" * 30),
]


def docs(spark, rows=EDGE):
    """Documents with extra columns whose names clash with the operators' own."""
    df = spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in ("score", "body", "names", "size", "bits", "label", "epoch", "lines_removed", "set_id", "tokens")}).repartition(3)


def empty(spark):
    return docs(spark).filter("doc_id < 0")


# -- suffix arrays ----------------------------------------------------------------------------


def brute_suffix(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        x = (t or "").encode()
        gone = np.zeros(len(x), bool)
        for p in range(len(x) - length + 1):
            w = x[p : p + length]
            if w in seen:
                gone[p : p + length] = True
            seen.add(w)
        kept = np.frombuffer(x, np.uint8)[~gone].tobytes() if x else b""
        out[i] = (len(x), int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if x else 0, kept)
    return out


def test_suffix_dedup(spark):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix.suffix_dedup(docs(spark)).collect()}
    assert got == brute_suffix(EDGE)
    assert suffix.suffix_dedup(empty(spark)).count() == 0


def test_suffix_repeated_rows_stay(spark):
    rows = [(1, PASSAGE), (1, PASSAGE), (2, PASSAGE)]
    got = sorted((r["doc_id"], r["n_removed"] > 0) for r in suffix.suffix_dedup(docs(spark, rows)).collect())
    assert got == [(1, False), (1, False), (2, True)]


def test_difference_cover():
    for period in (7, 13, 16):
        cover = suffix.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", min_size=100, max_size=260), min_size=1, max_size=5))
def test_sorted_windows(texts):
    data = "".join(texts).encode()
    at = np.arange(len(data) - 99)
    padded = np.frombuffer(data + bytes(400), np.uint8)
    order, fresh = suffix.sorted_windows(padded, at)
    found = [padded[i : i + 100].tobytes() for i in order.tolist()]
    assert found == sorted(found) and sorted(order.tolist()) == at.tolist()
    assert fresh.tolist() == [i == 0 or found[i] != found[i - 1] for i in range(len(found))]


# -- Jaccard ----------------------------------------------------------------------------------


def sets_of(rows, width):
    out = {}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        out[i] = frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    return out


def brute_components(rows, rule):
    s = sets_of(rows, rule.width)
    root = {i: i for i in s}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(s)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if s[i] and s[j] and rule.of * len(s[i] & s[j]) >= rule.number * len(s[i] | s[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s[i]), find(i)) for i in ids}


@pytest.mark.parametrize("rule", [jaccard.CONTRACT, jaccard.Rule(), jaccard.Rule(2, 60, 100)])
@pytest.mark.parametrize("tile", [jaccard.TILE, 3])
def test_jaccard(spark, monkeypatch, rule, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    rng = np.random.default_rng(3)
    rows = list(EDGE)
    base = [[f"w{x}" for x in rng.integers(0, 5000, n)] for n in (5, 8, 20, 60, 300)]
    for k in range(160):  # clouds of near copies around five texts, at all distances from the bound
        w = list(base[k % 5])
        for _ in range(int(rng.integers(0, 1 + len(w) // 12))):
            w[int(rng.integers(len(w)))] = f"e{rng.integers(0, 20)}"
        rows.append((100 + k, " ".join(w)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs(spark, rows), rule).collect()}
    assert got == brute_components(rows, rule)


def brute_links(rows, rule):
    s = sets_of(rows, rule.width)
    return {i: sum(i != j and bool(s[i]) and bool(s[j]) and rule.of * len(s[i] & s[j]) >= rule.number * len(s[i] | s[j]) for j in s) for i in s}


@pytest.mark.parametrize("rule", [jaccard.CONTRACT, jaccard.Rule(2, 60, 100)])
@pytest.mark.parametrize(("tile", "shingles", "columns"), [(jaccard.LINK_TILE, jaccard.LINK_SHINGLES, jaccard.COLUMNS), (4, 900, 16)])
def test_jaccard_links(spark, monkeypatch, rule, tile, shingles, columns):
    """Links of every row, counted tile by tile; sizes on both sides of class borders, copies of many sets."""
    for name, value in (("LINK_TILE", tile), ("LINK_SHINGLES", shingles), ("COLUMNS", columns)):
        monkeypatch.setattr(jaccard, name, value)
    rng = np.random.default_rng(8)
    rows = list(EDGE)
    base = [[f"w{x}" for x in rng.integers(0, 5000, n)] for n in (7, 20, 64, 300)]
    for k in range(140):
        w = list(base[k % 4])
        for _ in range(int(rng.integers(0, 1 + len(w) // 14))):
            w[int(rng.integers(len(w)))] = f"e{rng.integers(0, 20)}"
        rows.append((100 + k, " ".join(w[: len(w) - int(rng.integers(0, 1 + len(w) // 7))])))
    rows += [(300 + k, rows[-1 - k % 9][1]) for k in range(20)]
    got = {r["doc_id"]: (r["n_links"], r["component_id"]) for r in jaccard.jaccard_join(docs(spark, rows), rule).collect()}
    links, placed = brute_links(rows, rule), brute_components(rows, rule)
    assert got == {i: (links[i], placed[i][1]) for i in placed} and max(links.values()) > 9


def test_jaccard_links_edges(spark):
    assert jaccard.jaccard_join(empty(spark)).count() == 0
    apart = jaccard.jaccard_join(docs(spark, [(1, "a b c d e f"), (2, "u v w x y z")])).collect()
    assert sorted((r["doc_id"], r["n_links"]) for r in apart) == [(1, 0), (2, 0)]
    some = jaccard.jaccard_join(docs(spark, [(5, "a b c d e"), (5, "a b c d e"), (3, "A b c d e"), (4, None), (None, "a b c d e"), (6, " ")])).collect()
    assert sorted((r["doc_id"] or 0, r["n_links"]) for r in some) == [(0, 3), (3, 3), (4, 0), (5, 3), (5, 3), (6, 0)]


@given(st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=30, unique=True), min_size=1, max_size=9), st.integers(0, 8))
def test_overlaps(rows, cut):
    sets = [np.sort(np.array(r, np.uint64)) for r in rows]
    cut = min(cut, len(sets) - 1)
    alone, both = jaccard.overlaps(sets, None), jaccard.overlaps(sets[: cut + 1], sets[cut:])
    for i, x in enumerate(rows):
        for j, y in enumerate(rows):
            common = len(set(x) & set(y))
            assert i == j or alone[i, j] == common
            assert i > cut or j < cut or both[i, j - cut] == common


def test_jaccard_edges(spark):
    assert jaccard.jaccard_components(empty(spark)).count() == 0
    twice = jaccard.jaccard_components(docs(spark, [(5, "a b c d e"), (5, "a b c d e"), (3, "A b c d e"), (4, None)])).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in twice) == [(3, 3), (4, 4), (5, 3), (5, 3)]
    base = [f"w{k}" for k in range(300)]
    near = lambda k: " ".join(base[:k] + ["x"] + base[k + 1 :])
    lone = jaccard.jaccard_components(docs(spark, [(None, near(5)), (None, near(9)), (7, near(200)), (None, "q r s t u")])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in lone) == [(0, 0), (0, 7), (0, 7), (7, 7)]


# -- lines ------------------------------------------------------------------------------------


def brute_lines(rows, window=2, alone=lines.ALONE):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        all_ = (t or "").split("\n")
        solid = [k for k, x in enumerate(all_) if x.strip(" ")]
        runs = [solid[k : k + window] for k in range(len(solid) - window + 1)]
        runs += [[k] for k in solid if alone and (len(all_[k].encode()) >= lines.ALONE_BYTES or len(re.split(r"[\x20\x09-\x0D]+", all_[k].strip(" "))) >= alone)]
        gone = set()
        for at in sorted(set(map(tuple, runs))):
            w = tuple(all_[p] for p in at)
            if w in seen:
                gone.update(at)
            seen.add(w)
        out[i] = ("\n".join(x for k, x in enumerate(all_) if k not in gone), len(gone))
    return out


@pytest.mark.parametrize("window", [1, 2, 3, 5])
def test_line_dedup(spark, window):
    rng = np.random.default_rng(window)
    rows = EDGE + [(100 + k, "\n".join(f"l{x}" for x in rng.integers(0, 9, rng.integers(0, 25)))) for k in range(80)]
    rows += [(None, "l1\nl2\nl3\nl4\nl5\nl6"), (300, "l1\nl2\n\nl3\nl4\nl5\nl6"), (300, "l1\nl2\n\nl3\nl4\nl5\nl6")]
    clashing = docs(spark, rows).withColumns({c: F.lit("clash") for c in ("gone", "_gone_id", "row", "lines", "at", "key", "fingerprint")})
    for alone in (None, lines.ALONE):
        out = lines.line_dedup(clashing, window, alone)
        got = [(r["doc_id"], (r["text"] or "", r["lines_removed"])) for r in out.collect()]
        assert dict(got) == brute_lines(rows[:-1], window, alone) and len(got) == len(rows)
    assert out.columns == [c for c in clashing.columns if c != "lines_removed"] + ["lines_total", "lines_removed"] and lines.line_dedup(empty(spark)).count() == 0
    assert out.filter("doc_id = 1").first()["text"] is None


def test_winnowing_selects_minima(spark):
    """Fewer fingerprints than windows, each window under exactly one, and shared runs share one."""
    rng = np.random.default_rng(0)
    d = docs(spark, [(k, "\n".join(f"l{x}" for x in rng.integers(0, 50, 400))) for k in range(20)])
    for window in (2, 3, 8):
        got = lines.selected(d, window, None).collect()
        starts = [w["start"] for r in got if r["doc_id"] == 7 for w in r["windows"]]
        assert sorted(starts) == list(range(400 - window + 1)) and len(got) < 20 * 401 * 2.4 / (window + 1)
        assert all(w["start"] <= r["position"] < w["start"] + window for r in got for w in r["windows"])


def test_long_single_lines(spark):
    """A passage of one line between other neighbours, and a document of one line, go once repeated."""
    passage = " ".join(f"w{k}" for k in range(60))
    dense = "語" * 120  # no spaces: long by its bytes
    rows = [(1, f"a\n{passage}\nb"), (2, f"c\n{passage}\nd"), (3, passage), (4, "short line"), (5, "short line"), (6, dense), (7, f"e\n{dense}"), (8, f"{passage} and more"), (9, None)]
    got = {r["doc_id"]: (r["text"], r["lines_removed"]) for r in lines.line_dedup(docs(spark, rows)).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("c\nd", 1), 3: ("", 1), 4: ("short line", 0), 5: ("short line", 0), 6: (dense, 0), 7: ("e", 1), 8: (rows[7][1], 0), 9: (None, 0)}


# -- packing ----------------------------------------------------------------------------------


def test_best_fit_and_bound():
    rng = np.random.default_rng(1)
    for _ in range(30):
        size = np.sort(rng.integers(1, 101, 60))[::-1]
        bins, offsets = packing.best_fit(size, 100)
        used = np.bincount(bins, weights=size)
        assert used.max() <= 100 and packing.lower_bound(size, 100) <= len(used)
        for b in range(len(used)):
            o, n = offsets[bins == b], size[bins == b]
            k = np.argsort(o)
            assert o[k].tolist() == np.concatenate([[0], np.cumsum(n[k])[:-1]]).tolist()
    assert packing.lower_bound(np.array([51, 51, 51]), 100) == 3 and packing.lower_bound(np.array([], int), 100) == 0


def check_packing(spark, rows, **how):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    t = Tokenizer.from_file(path)
    pieces = packing.tokenized(docs(spark, rows), path)
    got = packing.pack(pieces, **how).toPandas()
    by = defaultdict(list)
    for r in got.sort_values("piece").itertuples():
        by[r.doc_id].append(r)
    assert set(by) == {i for i, _ in rows}
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        assert [(r.start, r.length) for r in by[i]] == [(a, min(4096, len(ids) - a)) for a in range(0, len(ids), 4096)]
        assert [r.ids_crc32 for r in by[i]] == [zlib.crc32(np.array(ids[a : a + 4096], "<u4").tobytes()) for a in range(0, len(ids), 4096)]
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["length"].sum() <= 4096 and s["offset"].tolist() == np.concatenate([[0], s["length"].cumsum()[:-1]]).tolist()
    return got["sequence_id"].nunique(), -(-got["length"].sum() // 4096)


def test_packing(spark):
    odd = [(50, "a<|endoftext|>b don't İstanbul ΣΑΣ ½3 ——,!a \u0085x…y"), (51, "<|startoftext|>"), (52, "é Å")]
    used, least = check_packing(spark, EDGE + odd)
    assert used <= least + 1
    many = [(1000 + k, "tok " * int(n)) for k, n in enumerate(np.random.default_rng(2).integers(1, 3500, 60))]
    alone, _ = check_packing(spark, many)
    used, _ = check_packing(spark, many, per_part=10)  # several partitions, so that they exchange
    assert alone <= used <= alone + 6  # a bin a partition at most, as each is certified by itself
    assert packing.pack_documents(empty(spark), packing.default_tokenizer()).count() == 0


def test_exchange_never_costs_and_closes_gaps(spark):
    rng = np.random.default_rng(24)
    size = np.sort(rng.integers(15, 60, 40))[::-1]
    bins, offsets = packing.best_fit(size, 100)
    assert bins.max() + 1 > packing.lower_bound(size, 100)
    rows = [(i, 0, 0, 0, int(n), 0) for i, n in enumerate(size)]
    pieces = spark.createDataFrame(rows, "doc_id long, copy long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack(pieces, 100).toPandas()  # one partition with a gap is exchanged, too
    assert got["sequence_id"].nunique() == packing.lower_bound(size, 100) and len(got) == len(rows)
    used = {}
    for rounds in (1, 2, 5):
        got = packing.pack(pieces, 100, rounds=rounds, per_part=7).toPandas()
        assert sorted(got["doc_id"]) == list(range(40))
        for _, x in got.sort_values("offset").groupby("sequence_id"):
            assert x["length"].sum() <= 100 and x["offset"].tolist() == [0, *x["length"].cumsum()[:-1]]
        used[rounds] = got["sequence_id"].nunique()
    assert used[1] >= used[2] >= used[5]
    for seed in range(50):  # nothing is taken that has more bins than before
        size = np.sort(np.random.default_rng(seed).integers(1, 100, 30))[::-1]
        good, at = packing.best_fit(size, 100)
        b, o = packing.repack(size, good, at, 100, seed)
        assert b.max() <= good.max() and np.bincount(b, weights=size).max() <= 100


# -- fingerprints -----------------------------------------------------------------------------


def test_followers_and_edits(spark):
    got = simhash.edited_texts(docs(spark), simhash.followers(docs(spark))).collect()
    texts = dict((i, t or "") for i, t in EDGE)
    ids = sorted(texts)
    for r in got:
        x, n = texts[r["doc_id"]], texts[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        q = len(x) // 4
        assert r["edited"] == x[: len(x) - q] + n[:q]
    assert len(got) == len(EDGE)
    lone = simhash.edited_texts(docs(spark, [(7, "abcdefgh")]), simhash.followers(docs(spark, [(7, "abcdefgh")]))).first()
    assert lone["edited"] == "abcdefab"
    assert simhash.followers(empty(spark)).count() == 0
    none = docs(spark, [(None, "abcd"), (1, "efghijkl")])
    assert sorted((r["doc_id"] or 0, r["edited"]) for r in simhash.edited_texts(none, simhash.followers(none)).collect()) == [(0, "abcd"), (1, "efghijef")]


def test_fingerprint_votes(spark):
    got = {r["doc_id"]: r["simhash"] for r in simhash.fingerprints(docs(spark).select("doc_id", F.coalesce("text", F.lit("")).alias("t")), ["doc_id"], "t").collect()}
    assert got[11] == got[12] and got[1] == got[2] == got[3] and len(got) == len(EDGE)
    grams = spark.createDataFrame([(["a", "b", "c", "d", "e"],), (["b", "c", "d", "e", "f"],), (["c", "d", "e", "f", "g"],)], "w array<string>").select(F.xxhash64(F.transform("w", lambda w: F.xxhash64(w))).alias("h"))
    votes = [r["h"] & (1 << 64) - 1 for r in grams.collect()]
    expect = sum(1 << k for k in range(64) if 2 * sum(v >> k & 1 for v in votes) > 3)
    one = simhash.fingerprints(spark.createDataFrame([(1, "a b c d e f g")], "i long, t string"), ["i"], "t").first()["simhash"]
    assert one & (1 << 64) - 1 == expect


def test_near_fingerprints(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**63), 2**63 - 1, 40)
    fps = set(base.tolist())
    for b in base.tolist():
        for n in (1, 2, 3, 4, 5):
            v = b & (1 << 64) - 1
            for k in rng.choice(64, n, replace=False).tolist():
                v ^= 1 << k
            fps.add(v - (1 << 64) if v >> 63 else v)
    all_ = spark.createDataFrame([(int(f),) for f in fps], "simhash long")
    asked = spark.createDataFrame([(int(b),) for b in base], "simhash long")
    expect = sorted((int(a), int(b)) for a in base for b in fps if ((int(a) ^ int(b)) & (1 << 64) - 1).bit_count() <= 3)
    for blocks in (5, 6, 8):  # each pair once, whatever the tables
        assert sorted((r["query"], r["simhash"]) for r in simhash.near_fingerprints(asked, all_, blocks=blocks).collect()) == expect
    assert [simhash.blocks_for(n) for n in (0, 1 << 20, 1 << 26, 1 << 33)] == [5, 5, 6, 7]


def plain_simhash(text):
    """Votes of word 5-shingles one by one; hashes chain as Spark's do."""
    import struct

    import xxhash

    signed = lambda v: v - (1 << 64) if v >> 63 else v
    words_ = [signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in re.split(r"[\x20\x09-\x0D]+", text) if w]

    def term(part):
        h = 42
        for w in part:
            h = xxhash.xxh64(struct.pack("<q", w), seed=h).intdigest()
        return h

    terms = [term(words_[k : k + 5]) for k in range(len(words_) - 4)] if len(words_) >= 5 else [term(words_)]
    return sum(1 << k for k in range(64) if 2 * sum(t >> k & 1 for t in terms) > len(terms))


def test_fingerprint_query(spark, tmp_path):
    rng = np.random.default_rng(8)
    words_ = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(rng.choice(words_, int(n)))) for i, n in zip(range(0, 120, 2), rng.integers(0, 80, 60))]
    rows += [(51, rows[3][1] + " x"), (53, None), (55, "é😀 " * 9), (50, rows[25][1]), (100, rows[50][1])]  # 50 and 100 twice each: repeated rows
    docs(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    got = simhash.op1_document_fingerprints(spark, str(tmp_path)).collect()
    texts = {i: t or "" for i, t in rows}
    ids = sorted(texts)
    prints = {i: plain_simhash(t) for i, t in texts.items()}
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in rows)
    for r in got:
        i, x = r["doc_id"], texts[r["doc_id"]]
        after = ids[(ids.index(i) + 1) % len(ids)]
        edited = x[: len(x) - len(x) // 4] + texts[after][: len(x) // 4]
        like = lambda a, b: 1 - (a ^ b).bit_count() / 64
        assert (r["n_chars"], r["edited_sha256"]) == (len(x), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (f"{prints[i]:016x}", f"{plain_simhash(edited):016x}")
        assert (r["near_edited"], r["near_next"]) == (like(prints[i], plain_simhash(edited)), like(prints[i], prints[after]))
        assert r["n_near"] == (sum((prints[i] ^ prints[j]).bit_count() <= 3 for j, _ in rows) if i % 50 == 0 else None)


# -- shared primitives ------------------------------------------------------------------------


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text("a é\n\tbß", max_size=20), max_size=6))
def test_words(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    starts, ends, rows = words(data, offsets)
    got = [(r, data[a:b].tobytes()) for a, b, r in zip(starts, ends, rows)]
    assert got == [(i, w) for i, x in enumerate(raw) for w in re.findall(rb"[^\x20\x09-\x0D]+", x)]
    if len(got):
        h = Hasher(data).spans(starts, ends)
        assert len(set(h.tolist())) == len({w for _, w in got})


def test_digest_is_sha():
    assert suffix._digest(b"x") == hashlib.sha256(b"x").digest()[:16]


def test_suffix_many_rows_without_id(spark):
    """Rows without doc_id are as many documents as they have texts: none is paired with another's texts."""
    rows = [(None, f"{k} " + PASSAGE + f" {k * 7919}") for k in range(400)] + [(None, "short")] * 50 + [(5, PASSAGE), (6, PASSAGE)]
    got = suffix.suffix_dedup(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    whole = [r for r in got if r["doc_id"] is None and PASSAGE.encode() in bytes(r["kept"])]
    assert len(whole) == 1  # the first of them by the order of their digests
    assert [(r["n_removed"], r["n_spans"]) for r in sorted((r for r in got if r["doc_id"]), key=lambda r: r["doc_id"])] == [(len(PASSAGE.encode()), 1)] * 2
