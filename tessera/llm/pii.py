"""Personal data in texts, disguised or not, by spans of the source's code points.

The plain patterns of the four kinds (email, ip, card, phone) run over the text as it is; what they find
always stays. A text that may hide more then goes through transducers, each of which rewrites
some of it and keeps for every character which source characters it stands for:

1. look-alikes: letters and digits of other scripts, full-width and mathematical ones become ASCII;
   invisible characters go; O and l among digits become 0 and 1,
2. spelled digits of the corpus' languages become digits and their separators go; `dot` between digits
   becomes a point and `plus` before them a sign,
3. disguised addresses: `name [at] host (dot) org`, `name at host dot org` and the like.

The patterns run again over the rewritten text, and what they find is mapped back: a span begins where its
first character's source does and ends where its last one's does. It is added unless it meets a plain span
of its kind; an address may also surround a plain one (a look-alike letter cuts an address short).

Bare words are only read as a disguise where the whole address or number is spelled so: `at` needs a
spelled `dot` in the host, a run of digits two spelled ones at least. Patterns take time linear in the text,
whatever it looks like; a text is decoded once and, if it is rewritten, held with two offsets a character.

Defined results: null and empty texts have no spans; repeated rows have the same; bytes that are no UTF-8
count as one character each; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm._tables import read, ship, whole_texts
from tessera.llm._text import pieces

KINDS = ("email", "ip", "card", "phone")
CARD_DIGITS, PHONE_DIGITS = (12, 19), (9, 15)

# Characters that look like the ASCII ones below them.
_ALIKE = (
    ("АВЕЅІЈКМНОРСТУХаеѕіјорсухԁԛԝһ", "ABESIJKMHOPCTYXaesijopcyxdqwh"),
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρι", "ABEZHIKMNOPTYXovpi"),
    ("ıɑɡⅼ", "iagl"),
    ("‐‑‒–—−․﹒。", "------..."),
)
# The digits' names.
_NAMES = {
    "en": "zero one two three four five six seven eight nine",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
}
_DIGIT = {w: str(k) for names in _NAMES.values() for k, w in enumerate(names.split())}
_SPELLED = rf"(?:{'|'.join(sorted(_DIGIT, key=len, reverse=True))})(?!\w)"

_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = re.compile(rf"({_LOCAL}++)(@{_HOST}++(?:\.{_HOST}++)++)?")  # takes runs without an address too, so none is read twice
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DOT_WORD, _AT_WORD = "(?:dot|punkt|punto|point)", "(?:at|arroba|arobase)"
_MARKED_DOT, _MARKED_AT = rf"\s?[\[({{<]\s?(?:{_DOT_WORD}|\.)\s?[\])}}>]\s?", rf"\s?[\[({{<]\s?(?:{_AT_WORD}|@)\s?[\])}}>]\s?"
_ANY_DOT = rf"(?:{_MARKED_DOT}|\x20{_DOT_WORD}\x20)"
INVISIBLE = re.compile("[­​-‏⁠-⁤﻿]+")
_LIKE_DIGITS = re.compile(r"(?<![\w@.])\+?[0-9OoIl](?:[\x20.-]?[0-9OoIl]){8,}(?![\w@])")
_SIGN = re.compile(rf"(?i)(?<!\w)plus\s(?=[0-9]|{_SPELLED})")
def _run(names: str) -> str:
    token = rf"(?:[0-9]+|(?:{'|'.join(names.split())})(?!\w))"
    return rf"{token}(?:(?:[\x20,-]{{1,2}}|{_ANY_DOT}){token})++"


RUN = re.compile(rf"(?i)(?<![\w.])(?:{'|'.join(map(_run, _NAMES.values()))})")  # one language a run
_WORDS = re.compile(rf"(?i){_SPELLED}|[0-9]+|{_DOT_WORD}|[\[({{<.]")
ADDRESS = re.compile(
    rf"(?i)({_LOCAL}++(?:{_ANY_DOT}{_LOCAL}++)*+)"
    rf"(?:(?:{_MARKED_AT}|\x20?@\x20?)({_HOST}++(?:(?:{_ANY_DOT}|\.){_HOST}++)++)|\x20{_AT_WORD}\x20({_HOST}++(?:\.{_HOST}++)*+{_ANY_DOT}{_HOST}++(?:(?:{_ANY_DOT}|\.){_HOST}++)*+))?"
)  # takes words without an address too, as EMAIL does
_HINTS = re.compile(rf"(?i)[\[({{<]\s?(?:{_AT_WORD}|{_DOT_WORD}|@|\.)\s?[\])}}>]|\s{_DOT_WORD}\s|\x20@|@\x20|(?<!\w){_SPELLED}[\s,-]+(?:{_SPELLED}|{_DOT_WORD})")


class _Fold(dict):
    """A character's ASCII look-alike: listed above, a digit of any script, or by compatibility."""

    def __missing__(self, code: int) -> int:
        c = chr(code)
        digit, plain = unicodedata.decimal(c, None), unicodedata.normalize("NFKC", c)
        got = code if code < 128 else 48 + digit if digit is not None else ord(plain) if len(plain) == 1 and " " <= plain <= "~" else code
        self[code] = got
        return got


FOLD = _Fold({ord(a): ord(b) for alike, plain in _ALIKE for a, b in zip(alike, plain)})


def luhn(digits: str) -> bool:
    doubled = str.maketrans("0123456789", "0246813579")
    return (sum(map(int, digits[-1::-2])) + sum(map(int, digits[-2::-2].translate(doubled)))) % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """What the patterns find: kind, start, end."""
    out = []
    if "@" in text:
        out += [("email", *m.span()) for m in EMAIL.finditer(text) if m[2]]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(x) <= 3 and int(x) <= 255 for x in (part.lstrip("0") or "0" for part in m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0] and CARD_DIGITS[0] <= len(d := _digits(m[0])) <= CARD_DIGITS[1] and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]]
    return out


class Tape:
    """A text whose characters know the source characters they stand for: first, and one past the last."""

    def __init__(self, text: str):
        self.text = text
        self.first = np.arange(len(text), dtype=np.int32 if len(text) < 1 << 30 else np.int64)
        self.last = self.first + 1

    def rewrite(self, pattern: re.Pattern, value: Callable[[re.Match], str]) -> None:
        """Put value(match) in place of each match; its characters stand for the whole of it, but where
        their number stays the same each stands for its own."""
        text, first, last, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            new, (a, b) = value(m), m.span()
            if new == m[0]:
                continue
            text += [self.text[at:a], new]
            same = len(new) == b - a
            first += [self.first[at:a], self.first[a:b] if same else np.full(len(new), self.first[a])]
            last += [self.last[at:a], self.last[a:b] if same else np.full(len(new), self.last[b - 1])]
            at = b
        if text:
            self.text = "".join([*text, self.text[at:]])
            self.first, self.last = np.concatenate([*first, self.first[at:]]), np.concatenate([*last, self.last[at:]])


def _as_digits(m: re.Match) -> str:
    """O and l as digits, where most of a run are digits."""
    letters = sum(map(m[0].count, "OoIl"))
    return m[0].translate(str.maketrans("OoIl", "0011")) if 0 < letters and 3 * letters <= len(_digits(m[0])) else m[0]


def _points(text: str) -> str:
    return re.sub(rf"(?i){_ANY_DOT}", ".", text)


def _joined(m: re.Match) -> str:
    """A run of digits and their names without separators; spelled dots as points."""
    found = [x.lower() for x in _WORDS.findall(m[0])]
    names = sum(x in _DIGIT for x in found)
    dots = any(x in ("dot", "punkt", "punto", "point") or x in "[({<" for x in found)
    if not dots and names < 2:
        return m[0]
    if not names:  # digits with spelled dots keep their separators
        return _points(m[0])
    return re.sub(r"[\x20,-]", "", re.sub(rf"(?i){_SPELLED}", lambda w: _DIGIT[w[0].lower()], _points(m[0])))


def _address(m: re.Match) -> str:
    """name@host of a disguised address; other words stay."""
    host = m[2] or m[3]
    return f"{_points(m[1])}@{_points(host)}" if host else m[0]


def hidden_spans(text: str, plain: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """What the patterns find behind the transducers only."""
    tape = Tape(text)
    if not text.isascii():
        tape.text = text.translate(FOLD)
        tape.rewrite(INVISIBLE, lambda m: "")
    tape.rewrite(_LIKE_DIGITS, _as_digits)
    if _HINTS.search(tape.text) or _SIGN.search(tape.text):
        tape.rewrite(_SIGN, lambda m: "+")
        tape.rewrite(RUN, _joined)
        tape.rewrite(ADDRESS, _address)
    if tape.text == text:
        return []
    taken = {k: sorted((s, e) for kind, s, e in plain if kind == k) for k in KINDS}
    starts = {k: np.array([s for s, _ in v], np.int64) for k, v in taken.items()}
    out = []
    for kind, s, e in plain_spans(tape.text):
        start, end = int(tape.first[s]), int(tape.last[e - 1])
        # plain spans of a kind are apart, so the ones this meets are neighbours
        k = max(0, int(np.searchsorted(starts[kind], start)) - 1)
        met = []
        while k < len(taken[kind]) and taken[kind][k][0] < end:
            if taken[kind][k][1] > start:
                met.append(taken[kind][k])
            k += 1
        wider = kind == "email" and all(start <= a and b <= end and (a, b) != (start, end) for a, b in met)
        if not met or wider:
            out.append((kind, start, end))
    return out


def spans_of(text: str) -> list[tuple[str, int, int, bool]]:
    """Kind, start, end, whether it is plain; by start, then kind as listed."""
    plain = plain_spans(text)
    found = [(*x, True) for x in plain] + [(*x, False) for x in hidden_spans(text, plain)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, spans: array of (kind, start, end, plain), code points, end exclusive."""
    ship(docs.sparkSession)
    given = whole_texts(docs, "doc_id", "text").select("doc_id", "body")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())]
        for batch, data, offsets in pieces(batches, "body"):
            found = [[dict(zip(("kind", "start", "end", "plain"), x)) for x in spans_of(data[a:b].tobytes().decode("utf-8", "surrogateescape"))] for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(pa.struct(fields)))], names=["doc_id", "spans"])

    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(work, f"doc_id {kind}, spans array<struct<kind: string, start: long, end: long, plain: boolean>>")


def redact(text: Column, spans: Column) -> Column:
    """The text with `<kind>` in place of every span; of spans that overlap, the first one's name."""
    step = lambda acc, x: F.when(x["end"] <= acc["at"], acc).otherwise(
        F.struct(
            F.concat(acc["text"], F.substring(text, acc["at"] + 1, F.greatest(F.lit(0), x["start"] - acc["at"])), F.when(x["start"] >= acc["at"], F.concat(F.lit("<"), x["kind"], F.lit(">"))).otherwise("")).alias("text"),
            x["end"].cast("int").alias("at"),
        )
    )
    rest = lambda acc: F.concat(acc["text"], F.substring(text, acc["at"] + 1, F.length(text)))
    short = F.transform(spans, lambda x: F.struct(x["kind"].alias("kind"), x["start"].cast("int").alias("start"), x["end"].cast("int").alias("end")))
    return F.aggregate(short, F.struct(F.lit("").alias("text"), F.lit(0).alias("at")), step, rest)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = find_pii(read(spark, sf_dir, "documents"))
    of = lambda kind: F.filter("spans", lambda x: x["kind"] == kind)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    plain = F.filter("spans", lambda x: x["plain"])
    return got.select("doc_id", *counts, F.sha2(listed(plain), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), F.size(plain).cast("long").alias("n_base"))
