"""Filter interactions, fill-in-the-middle and personal data against brute force, and their edge cases."""

import hashlib
import os
import random
import re
import time
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import infill, interaction, pii

SF = "/root/testdata/sf0.001"
MANY = " ".join(f"w{i}" for i in range(300))
EDGE = [
    (1, None, "en"), (2, "", "en"), (3, "  \n\t", None), (4, "one\ntwo\n\nthree", "en"), (5, MANY, "de"), (6, MANY, "en"), (6, MANY, "en"), (7, MANY + " # x", "de"), (8, "SHOUT " * 250, "fr"),
    (9, "same word " * 150, "fr"), (10, MANY + " LOUD" * 30, "en"), (11, "é ü\x85z\xa0y " * 120, ""), (None, MANY, "en"), (None, "", "xx"), (12, "a<P>b\nc", "en"), (13, "line\n" * 40, "es"), (14, "\n\n\n", "es"),
    (15, "write to jo [at] mail [dot] org or call +1 (743) 555-3824\n10.0.0.300 10.0.0.30", "en"), (16, "x" * 30_000 + " y\n" + "z" * 5, "en"),
]


def docs(spark, rows=EDGE):
    """Documents with extra columns whose names clash with the operators' own."""
    df = spark.createDataFrame([(i, t, lang, "src", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in ("part", "mask", "digest", "n", "body", "h1", "form", "output", "spans", "kind", "good")}).repartition(3)


def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (6, 1, 1), (6, 0, None), (7, 0, 1), (10, None, 0), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")


# -- filter interactions ------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_audit(rows, known):
    texts = [(i, t or "", lang or "") for i, t, lang in rows]
    good, bad = {d for d, q, _ in known if q == 1}, {d for d, _, x in known if x == 1}
    fails = []
    for i, t, _ in texts:
        w = WORD.findall(t)
        caps = sum("A" <= c <= "Z" for c in t)
        same = i is not None and any(j is not None and j < i and u == t for j, u, _ in texts)
        fails.append({k for k, x in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * caps > 3 * len(t), re.search(r"[#$%&*|]", t), same)) if x})
    out = {}
    for part in {p for *_, p in texts}:
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                c = Counter()
                for (i, _, p), failed in zip(texts, fails):
                    if p == part:
                        gone, here = bool(failed & set(order[:k])), f in failed
                        c["kept"] += not gone and not here
                        c["removed"] += here and not gone
                        c["redundant"] += here and gone
                        c["unique_fails"] += failed == {f}
                        c["good_lost"] += here and not gone and i is not None and i in good
                        c["toxic_lost"] += here and not gone and i is not None and i in bad
                shapley[f] += c["removed"]
                out[part, order, k + 1] = [c[x] for x in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")]
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                out[part, order, k + 1].append(shapley[f])
    return out


def test_filter_interactions(spark):
    known = [tuple(r) for r in labels(spark).collect()]
    got = interaction.filter_interactions(docs(spark), labels(spark)).collect()
    rows = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in got}
    assert len(rows) == len(got) and rows == brute_audit(EDGE, known)


def test_filter_interactions_of_nothing(spark):
    assert interaction.filter_interactions(docs(spark).filter("doc_id < 0"), labels(spark)).count() == 0
    bare = interaction.filter_interactions(docs(spark, [(1, "a", "en")]), labels(spark).limit(0)).collect()
    assert len(bare) == 600 and {r["shapley"] for r in bare} == {0, 120}


def counts(text, symbols=b"#$%&*|"):
    w = WORD.findall(text)
    return [len(w), len(set(w)), sum("A" <= c <= "Z" for c in text), sum(c in symbols.decode() for c in text), len(text)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab AB\n\té#\x0b\x85", max_size=60), min_size=1, max_size=6), st.sampled_from([4, 7, 1 << 20]), st.booleans())
def test_measure(texts, block, weak):
    """Blocks of any size, and hashes of a few bits, give the same counts."""
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])])
    with pytest.MonkeyPatch.context() as m:
        m.setattr(interaction, "BLOCK", block)
        if weak:
            spans = interaction.Hasher.spans
            m.setattr(interaction.Hasher, "spans", lambda self, s, e: spans(self, s, e) & np.uint64(1))
        got = interaction.measure(np.frombuffer(b"".join(data), np.uint8), offsets)
        alone = [interaction.measure(np.frombuffer(x, np.uint8), np.array([0, len(x)]))[:, 0].tolist() for x in data]
    assert got.T.tolist() == alone == [counts(t) for t in texts]


def test_measure_long_text_in_bounded_time():
    text = " ".join(f"{i:x}" for i in range(3_000_000)).encode()  # distinct words only
    start = time.time()
    got = interaction.measure(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert got[:2, 0].tolist() == [3_000_000, 3_000_000] and time.time() - start < 60


# -- fill in the middle -------------------------------------------------------------------------


def brute_infill(rows):
    out = []
    for i, t, _ in rows:
        t = t or ""
        units = re.findall(r"[^\n]*\n|[^\n]+", t)
        h = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
        h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
        n = len(units)
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not t or any(x in t for x in ("<P>", "<S>", "<M>")):
            form, got, lengths = "plain", t, (None, None)
        elif h[3] % 100 < 50:
            form, got, lengths = "spm", f"<S>{suf}<P>{pre}<M>{mid}", (len(pre), len(mid))
        else:
            form, got, lengths = "psm", f"<P>{pre}<S>{suf}<M>{mid}", (len(pre), len(mid))
        out.append((i, n, form, *lengths, hashlib.sha256(got.encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def as_table(spark, tmp_path, name, df):
    df.write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_fill_in_middle_query(spark, tmp_path):
    rows = EDGE + [(100 + k, "\n".join("αβγ €uro 🙂"[: j % 9] for j in range(k)), "en") for k in range(60)]
    got = infill.op12_fill_in_middle(spark, as_table(spark, tmp_path, "documents", docs(spark, rows))).collect()
    assert sorted(map(tuple, got), key=repr) == brute_infill(rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(docs(spark).filter("doc_id < 0")).count() == 0


@pytest.mark.parametrize("unit, rate, spm", [("word", 100, 0), ("char", 100, 100), ("line", 30, 50)])
def test_fill_in_middle_settings(spark, unit, rate, spm):
    markers = ("<|pre|>", "<|suf|>", "<|mid|>")
    d = docs(spark)
    got = infill.fill_in_middle(d, unit, 3, rate, spm, markers).withColumn("again", infill.restore(F.col("output"), F.col("form"), markers)).collect()
    assert sorted((repr(r["doc_id"]), r["again"]) for r in got) == sorted((repr(i), t or "") for i, t, _ in EDGE)
    assert {r["form"] for r in got} <= {"plain", *(["psm"] if spm < 100 else []), *(["spm"] if spm else [])}


def test_boundaries():
    f = lambda t, u: infill.boundaries(infill.decode(t.encode()), u).tolist()
    assert f("a\n\nb", "line") == [2, 3, 4] and f("a\n", "line") == [2] and f("", "line") == []
    assert f(" ab  c\nd", "word") == [1, 5, 7, 8] and f("é🙂", "char") == [1, 2]
    assert infill.encode(infill.decode(b"\xff\xc3a")) == b"\xff\xc3a"
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "ba", "c"), ("aa", "b", "c")):
        with pytest.raises(ValueError):
            infill.check_markers(bad)


# -- personal data ------------------------------------------------------------------------------


def brute_base(t):
    """The contract's patterns as they are written."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda x: (x[1], ("email", "ip", "card", "phone").index(x[0])))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "@", ".", "b-c", "_", "1", "12", "255", "256", "4111 1111 1111 1111", "+", "+1", " ", "-", "(", ")", "é", "\n", "..", "@x.y", "378282246310005"]), max_size=24).map("".join))
def test_plain_spans(t):
    assert sorted(pii.plain_spans(t)) == sorted(brute_base(t))
    assert [x[:3] for x in pii.spans_of(t) if x[3]] == brute_base(t)


DIGITS = "zero one two three four five six seven eight nine".split()
ALIKE = str.maketrans("aceopxy", "асеорху")


def disguise(kind, value, how):
    if kind == "email":
        name, host = value.split("@")
        return {
            "square": f"{name} [at] {host.replace('.', ' [dot] ')}", "round": f"{name}(at){host}", "words": f"{name} at {host.replace('.', ' dot ')}", "upper": f"{name} AT {host.replace('.', ' DOT ')}",
            "alike": value.translate(ALIKE), "wide": "".join(chr(ord(c) + 0xFEE0) for c in value), "hidden": value.replace("@", "​@"),
        }[how]
    spelled = " ".join(DIGITS[int(c)] if c.isdigit() else {"+": "plus", ".": "dot"}[c] for c in value)
    return {"words": spelled, "upper": spelled.title(), "hidden": "‍".join(value), "wide": "".join(chr(0xFF10 + int(c)) if c.isdigit() else c for c in value), "alike": value.translate(str.maketrans("０", "0")).replace("0", "O")}[how]


@pytest.mark.parametrize("how", ["square", "round", "words", "upper", "alike", "wide", "hidden"])
def test_planted(how):
    """A disguised value between prose is found, whole and nothing else."""
    rng = random.Random(how)
    values = {"email": "anne.poe@mail3.example.org", "ip": "192.168.30.7", "card": "4785380592391139", "phone": "+17435553824"}
    prose = "the tionst of café hein severn sheep, and at noon und drei. Then un pointe".split(" ")
    for kind, value in values.items():
        if kind != "email" and how in ("square", "round"):
            continue
        for _ in range(20):
            a, b = (" ".join(rng.choices(prose, k=6)) + x for x in (" the ", "."))
            hidden = disguise(kind, value, how)
            if kind in ("ip", "phone") and how == "alike":
                continue  # dots and few zeros: no run of digits
            got = pii.spans_of(a + hidden + " " + b)
            new = [(k, a_, b_) for k, a_, b_, plain in got if not plain]
            assert new == [(kind, len(a), len(a) + len(hidden))] or (kind, len(a), len(a) + len(hidden), True) in got, (how, kind, a + hidden + " " + b, got)


def test_clean_prose():
    for t in ("meet me at noon. Then at 10.30 we go", "the dot at the end", "un deux trois quatre cinq", "look at this point. one two three", "a @ b", "eins zwei drei 4785 1234", "5 plus 3 point 2"):
        assert pii.spans_of(t) == [], t


def test_pii_query(spark, tmp_path):
    rows = [r for r in EDGE if r[0] != 16] + [(200, "die re.46@mail8.example.com&&& 4785380592391139$$$ +1 (523) 555-1055 152.143.123.131###", "en")]
    got = {(r["doc_id"], r["base_sha256"], r["n_base"], r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"], r["spans"]) for r in pii.op13_pii(spark, as_table(spark, tmp_path, "documents", docs(spark, rows))).collect()}
    want = set()
    for i, t, _ in rows:
        base, every = brute_base(t or ""), pii.spans_of(t or "")
        text = lambda xs: ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in xs)
        want.add((i, hashlib.sha256(text(base).encode()).hexdigest(), len(base), len(every), text(every)))
    assert got == want
    assert pii.find_pii(docs(spark).filter("doc_id < 0")).count() == 0


def test_redact(spark):
    d = docs(spark, [(1, "é jo [at] mail [dot] org, x 10.0.0.1", "en"), (2, None, "en"), (3, "ad​min@mail.ru", "en")])
    got = d.join(pii.find_pii(d).withColumnRenamed("spans", "found"), "doc_id").select("doc_id", pii.redact(F.coalesce("text", F.lit("")), F.col("found")).alias("text"))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "é <email>, x <ip>", 2: "", 3: "<email>"}


@pytest.mark.parametrize("t", ["a" * 500_000, "a@" * 200_000, "1." * 200_000, "1 " * 200_000, "one " * 100_000, "a dot " * 80_000, "a at " * 80_000, "+1(" * 100_000, "b@c." * 100_000, "a[at]b" * 50_000, "а" * 200_000])
def test_pii_time_is_linear(t):
    start = time.time()
    pii.spans_of(t)
    assert time.time() - start < 15


# -- against SQL --------------------------------------------------------------------------------


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("query, sql", [(interaction.op11_filter_interactions, interaction.OP11_SQL), (infill.op12_fill_in_middle, infill.OP12_SQL)])
def test_against_sql(spark, query, sql):
    c = duckdb.connect()
    for t in ("documents", "labels"):
        c.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    want = c.sql(sql).df()
    got = query(spark, SF).toPandas()[list(want.columns)]
    row = lambda r: repr([None if x is None or x != x else x.item() if hasattr(x, "item") else x for x in r])
    assert sorted(map(row, got.astype(object).to_numpy())) == sorted(map(row, want.astype(object).to_numpy()))
