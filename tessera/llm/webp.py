"""Media columns in lossless WebP: writing texts as images and reading images as pixel arrays.

decode() reads any lossless stream: prefix codes (simple and normal, with several groups),
back-references with the two-dimensional distance map, the colour cache, and the inverse
predictor, cross-colour, subtract-green and palette transforms.

A payload is stored as grey images of 64 columns and at most 64 rows, one sample a byte, one RIFF
file behind the other; red and blue equal green, so the subtract-green transform leaves nothing of
them, and the green samples get an own length-limited prefix code per image. Samples that came
before in the image are written as back-references where that makes the image smaller. Both layouts
are decoded in lockstep by numpy, one token of every image a step, each going at most 4096
steps, so a very long text is many streams and not a long one. All others take decode().

The stored form is written as a table and read back from it. Both passes are maps: no shuffle,
and memory is bounded by a slice of a batch.

Defined results: null and empty texts are 64 zero bytes; equal texts have equal stored forms,
wherever they lie; repeated rows are stored each; an empty table gives an empty one; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._tables import materialize, read, ship, whole_texts
from tessera.llm._text import pieces, ragged

SIDE = 64
_LONGEST = 12  # bits of a code in the plain layout: log2 of the samples in an image
#: Fixed values of the format.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
#: Near pixels by distance code: by distance, then column distance, right before left.
NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), -p[0]))


class Bits:
    """A reader of bits, lowest first."""

    def __init__(self, data: bytes):
        self.data, self.at, self.size = data, 0, 8 * len(data)

    def peek(self, n: int) -> int:
        byte = self.at >> 3
        return int.from_bytes(self.data[byte : byte + 8], "little") >> (self.at & 7) & ((1 << n) - 1)

    def take(self, n: int) -> int:
        out = self.peek(n)
        self.at += n
        if self.at > self.size:
            raise ValueError("the stream ends early")
        return out


class Code:
    """A canonical prefix code as a table over as many bits as its longest word has."""

    def __init__(self, lengths: list[int]):
        used = sorted((n, s) for s, n in enumerate(lengths) if n)
        if not used:
            raise ValueError("a prefix code has no symbols")
        if len(used) == 1:
            self.bits, self.table = 0, [(used[0][1], 0)]
            return
        self.bits = used[-1][0]
        if sum(1 << (self.bits - n) for n, _ in used) != 1 << self.bits:
            raise ValueError("a prefix code is not complete")
        straight = [(s, n) for n, s in used for _ in range(1 << (self.bits - n))]
        self.table = [straight[int(f"{i:0{self.bits}b}"[::-1], 2)] for i in range(1 << self.bits)]

    def read(self, bits: Bits) -> int:
        symbol, n = self.table[bits.peek(self.bits)]
        bits.at += n
        return symbol


def _read_code(bits: Bits, alphabet: int) -> Code:
    lengths = [0] * alphabet
    if bits.take(1):
        two, wide = bits.take(1), bits.take(1)
        symbols = [bits.take(8 if wide else 1)] + ([bits.take(8)] if two else [])
        for s in symbols:
            lengths[s] = 1
        return Code(lengths)
    of_lengths = [0] * 19
    for k in range(4 + bits.take(4)):
        of_lengths[LENGTH_ORDER[k]] = bits.take(3)
    code = Code(of_lengths)
    left = alphabet if not bits.take(1) else 2 + bits.take(2 + 2 * bits.take(3))
    at, before = 0, 8
    while at < alphabet and left > 0:
        left -= 1
        s = code.read(bits)
        if s < 16:
            lengths[at] = s
            at, before = at + 1, s or before
        else:
            n = 3 + bits.take(2) if s == 16 else 3 + bits.take(3) if s == 17 else 11 + bits.take(7)
            if at + n > alphabet:
                raise ValueError("too many code lengths")
            lengths[at : at + n] = [before if s == 16 else 0] * n
            at += n
    return Code(lengths)


def _read_extra(bits: Bits, symbol: int) -> int:
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.take(extra) + 1


def _read_pixels(bits: Bits, width: int, height: int, main: bool) -> list[int]:
    """Entropy-coded pixels as 32-bit ARGB."""
    cache_bits = bits.take(4) if bits.take(1) else 0
    cache = [0] * (1 << cache_bits) if cache_bits else []
    group_of, block = None, 0
    if main and bits.take(1):
        block = bits.take(3) + 2
        across = (width + (1 << block) - 1) >> block
        group_of = [p >> 8 & 0xFFFF for p in _read_pixels(bits, across, (height + (1 << block) - 1) >> block, False)]
    groups = [[_read_code(bits, n) for n in (280 + len(cache), 256, 256, 256, 40)] for _ in range(max(group_of) + 1 if group_of else 1)]
    total, out, codes = width * height, [], groups[0]
    while len(out) < total:
        if group_of:
            y, x = divmod(len(out), width)
            codes = groups[group_of[(y >> block) * across + (x >> block)]]
        s = codes[0].read(bits)
        if s < 256:
            red, blue, alpha = codes[1].read(bits), codes[2].read(bits), codes[3].read(bits)
            fresh = [alpha << 24 | red << 16 | s << 8 | blue]
        elif s < 280:
            length = _read_extra(bits, s - 256)
            far = _read_extra(bits, codes[4].read(bits))
            if far > 120:
                far -= 120
            else:
                x, y = NEAR[far - 1]
                far = max(1, x + y * width)
            if far > len(out) or len(out) + length > total:
                raise ValueError("a back-reference leaves the image")
            start = len(out) - far
            fresh = [out[start + k % far] for k in range(length)]
        else:
            fresh = [cache[s - 280]]
        out += fresh
        if cache:
            for p in fresh:
                cache[(0x1E35A7BD * p & 0xFFFFFFFF) >> (32 - cache_bits)] = p
    return out


def _channels(p: int) -> tuple[int, int, int, int]:
    return p >> 24, p >> 16 & 255, p >> 8 & 255, p & 255


def _average(a: int, b: int) -> int:
    return (((a ^ b) & 0xFEFEFEFE) >> 1) + (a & b)


def _each(f, *pixels: int) -> int:
    a, r, g, b = (f(*c) for c in zip(*map(_channels, pixels)))
    return a << 24 | r << 16 | g << 8 | b


def _clamp(x: int) -> int:
    return 0 if x < 0 else min(x, 255)


def _predict(mode: int, left: int, top: int, right: int, corner: int) -> int:
    """What a predictor mode makes of the pixels left, above, above right and above left."""
    if mode == 11:
        to_left = sum(abs(t - c) for t, c in zip(_channels(top), _channels(corner)))
        to_top = sum(abs(n - c) for n, c in zip(_channels(left), _channels(corner)))
        return left if to_left < to_top else top
    if mode == 12:
        return _each(lambda a, b, c: _clamp(a + b - c), left, top, corner)
    if mode == 13:
        return _each(lambda a, c: _clamp(a + int((a - c) / 2)), _average(left, top), corner)
    if mode in (5, 10):
        other = right if mode == 5 else corner
        return _average(_average(left, other), top if mode == 5 else _average(top, right))
    pairs = {6: (left, corner), 7: (left, top), 8: (corner, top), 9: (top, right)}
    if mode in pairs:
        return _average(*pairs[mode])
    return {1: left, 2: top, 3: right, 4: corner}.get(mode, 0xFF000000)


def _undo_predictor(pixels: list[int], width: int, block: int, modes: list[int]) -> list[int]:
    across = (width + (1 << block) - 1) >> block
    out: list[int] = []
    for i, p in enumerate(pixels):
        y, x = divmod(i, width)
        if not y:
            guess = out[-1] if x else 0xFF000000
        elif not x:
            guess = out[i - width]
        else:
            guess = _predict(modes[(y >> block) * across + (x >> block)] >> 8 & 15, out[-1], out[i - width], out[i - width + 1], out[i - width - 1])
        out.append(_each(lambda a, b: a + b & 255, p, guess))
    return out


def _undo_cross_colour(pixels: list[int], width: int, block: int, elements: list[int]) -> list[int]:
    across = (width + (1 << block) - 1) >> block
    rows = np.arange(len(pixels)) // width
    e = np.array(elements, np.int64)[(rows >> block) * across + ((np.arange(len(pixels)) % width) >> block)]
    p = np.array(pixels, np.int64)
    signed = lambda v: (v & 255 ^ 128) - 128
    green = signed(p >> 8)
    red = (p >> 16) + (signed(e) * green >> 5) & 255
    blue = p + (signed(e >> 8) * green >> 5) + (signed(e >> 16) * signed(red) >> 5) & 255
    return (p & 0xFF00FF00 | red << 16 | blue).tolist()


def _undo_palette(pixels: list[int], width: int, packing: int, palette: list[int]) -> list[int]:
    each, packed = 8 >> packing, (width + (1 << packing) - 1) >> packing
    out = []
    for row in range(len(pixels) // packed):
        for x in range(width):
            i = (pixels[row * packed + (x >> packing)] >> 8 & 255) >> each * (x & (1 << packing) - 1) & (1 << each) - 1
            out.append(palette[i] if i < len(palette) else 0)
    return out


def decode(riff: bytes) -> np.ndarray:
    """The image as (height, width, 4) samples in the order alpha, red, green, blue."""
    if riff[:4] != b"RIFF" or riff[8:16] != b"WEBPVP8L" or riff[20] != 0x2F:
        raise ValueError("not a lossless WebP file")
    bits = Bits(riff[21 : 20 + struct.unpack("<I", riff[16:20])[0]])
    width, height = bits.take(14) + 1, bits.take(14) + 1
    bits.take(1)
    if bits.take(3):
        raise ValueError("unknown version")
    undo, now = [], width
    while bits.take(1):
        kind = bits.take(2)
        if kind < 2:
            block = bits.take(3) + 2
            data = _read_pixels(bits, (now + (1 << block) - 1) >> block, (height + (1 << block) - 1) >> block, False)
            undo.append((_undo_predictor if kind == 0 else _undo_cross_colour, now, block, data))
        elif kind == 2:
            undo.append((None, now, 0, []))
        else:
            size = bits.take(8) + 1
            palette = _read_pixels(bits, size, 1, False)
            for i in range(1, size):
                palette[i] = _each(lambda a, b: a + b & 255, palette[i], palette[i - 1])
            packing = 3 if size <= 2 else 2 if size <= 4 else 1 if size <= 16 else 0
            undo.append((_undo_palette, now, packing, palette))
            now = (now + (1 << packing) - 1) >> packing
    pixels = _read_pixels(bits, now, height, True)
    for f, across, block, data in reversed(undo):
        if f is None:
            p = np.array(pixels, np.int64)
            green = p >> 8 & 255
            pixels = (p & 0xFF00FF00 | ((p >> 16) + green & 255) << 16 | (p + green & 255)).tolist()
        else:
            pixels = f(pixels, across, block, data)
    return np.array(pixels, ">u4").view(np.uint8).reshape(height, width, 4)


# -- many grey images at once ------------------------------------------------------------------

_REVERSED = np.array([int(f"{i:0{_LONGEST}b}"[::-1], 2) for i in range(1 << _LONGEST)], np.int64)


_PLAIN, _SINGLE, _MATCHED = range(3)
_GREEN, _FAR, _TOP = 280, 40, 64  # symbols of green without a cache, of distances; the longest match written


def _lengths_head() -> list[tuple[int, int]]:
    """A normal code whose lengths take four bits each, up to where it may say how many there are."""
    return [(0, 1), (15, 4), *((0 if s > 15 else 4, 3) for s in LENGTH_ORDER)]


def _fields(height: int | None, kind: int) -> list[tuple[int, int]]:
    """(value, bits) of an image's head up to the green code's lengths; height None: left out."""
    head = [(SIDE - 1, 14), ((height or 1) - 1, 14), (0, 1), (0, 3), (1, 1), (2, 2), (0, 1), (0, 1), (0, 1)]
    if kind == _SINGLE:
        return [*head, (1, 1), (0, 1), (1, 1)]  # then the one symbol, 8 bits
    if kind == _MATCHED:
        return [*head, *_lengths_head(), (0, 1)]  # then 280 lengths, 4 bits each
    return [*head, *_lengths_head(), (1, 1), (3, 3), (254, 8)]  # then 256 lengths, 4 bits each


#: The codes of red, blue (always 0), alpha (always 255) and distance (unused).
_TAIL = [(1, 1), (0, 1), (0, 1), (0, 1), (1, 1), (0, 1), (0, 1), (0, 1), (1, 1), (0, 1), (1, 1), (255, 8), (1, 1), (0, 1), (0, 1), (0, 1)]


def _joined(fields: list[tuple[int, int]]) -> tuple[int, int]:
    value = at = 0
    for v, n in fields:
        value |= v << at
        at += n
    return value, at


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Complete prefix-code lengths for each row of symbol counts: the ideal lengths rounded up,
    then words are shortened, common symbols first, until no code space is left."""
    total = counts.sum(1, keepdims=True)
    lengths = np.where(counts > 0, np.ceil(np.log2(np.maximum(total, 1) / np.maximum(counts, 1))), 0).astype(np.int64)
    lengths[(counts > 0) & (lengths == 0)] = 1
    room = (1 << _LONGEST) - np.where(counts > 0, 1 << (_LONGEST - lengths), 0).sum(1)
    order = np.argsort(-counts, axis=1, kind="stable")
    most = int((counts > 0).sum(1).max(initial=0))
    rows = np.arange(len(counts))
    many = (counts > 0).sum(1) > 1
    while (room[many] > 0).any():
        for k in range(most):
            s = order[:, k]
            n = lengths[rows, s]
            gain = 1 << (_LONGEST - n)
            yes = many & (counts[rows, s] > 0) & (n > 1) & (gain <= room)
            lengths[rows[yes], s[yes]] -= 1
            room[yes] -= gain[yes]
    return lengths


def _write_fields(words: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
    """OR values of up to 32 bits into 32-bit words at ascending bit positions."""
    if not len(at):
        return
    word, shifted = at >> 5, value.astype(np.uint64) << (at & 31).astype(np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    sums = np.add.reduceat(shifted, first)
    words[word[first]] |= (sums & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    np.bitwise_or.at(words, word[first] + 1, (sums >> np.uint64(32)).astype(np.uint32))


def _canonical(lengths: np.ndarray) -> np.ndarray:
    """Words by (length, symbol), counted up, written from their first bit."""
    order = np.argsort(np.where(lengths > 0, lengths, 99), axis=1, kind="stable")
    sorted_lengths = np.take_along_axis(lengths, order, 1)
    space = np.where(sorted_lengths > 0, 1 << np.maximum(_LONGEST - sorted_lengths, 0), 0)
    word = _REVERSED[(np.cumsum(space, 1) - space) & ((1 << _LONGEST) - 1)]
    codes = np.zeros_like(lengths)
    np.put_along_axis(codes, order, word, 1)
    return codes


def _prefixed(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbol, number of extra bits and these, of lengths or distance codes from 1 on."""
    v = value - 1
    high = np.frexp(np.maximum(v, 1))[1].astype(np.int64) - 1
    extra = np.where(v < 4, 0, high - 1)
    symbol = np.where(v < 4, v, 2 * high + ((v >> np.maximum(high - 1, 0)) & 1))
    return symbol, extra, v & ((1 << extra) - 1)


def _tokens(samples: np.ndarray, start: np.ndarray, length: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A greedy parse of every image: the positions of its tokens, their lengths (1: a literal), and the
    distance of a match, the nearest place before that has the same four samples."""
    n = len(samples)
    end = (start + length)[owner]
    at = np.arange(n)
    most, far = np.ones(n, np.int64), np.zeros(n, np.int64)
    if n > 4:
        word = samples[: n - 3].astype(np.uint64)
        for k in (1, 2, 3):
            word |= samples[k : n - 3 + k].astype(np.uint64) << np.uint64(8 * k)
        inside = at[: n - 3] + 4 <= end[: n - 3]
        key = owner[: n - 3].astype(np.uint64) << np.uint64(44) | word << np.uint64(12) | (at - start[owner])[: n - 3].astype(np.uint64)
        key = np.sort(key[inside])
        same = np.flatnonzero(key[1:] >> np.uint64(12) == key[:-1] >> np.uint64(12))
        here = (start[(key[same + 1] >> np.uint64(44)).astype(np.int64)] + (key[same + 1] & np.uint64(4095)).astype(np.int64)).astype(np.int64)
        back = ((key[same + 1] & np.uint64(4095)) - (key[same] & np.uint64(4095))).astype(np.int64)
        far[here], size = back, np.full(len(here), 4)
        live = np.arange(len(here))
        for k in range(4, _TOP):
            p = here[live] + k
            live = live[p < end[here[live]]]
            p = here[live] + k
            live = live[samples[p] == samples[p - back[live]]]
            if not len(live):
                break
            size[live] += 1
        good = size >= 5
        most[here[good]] = size[good]
    step, seen, cur, stop = at + most, np.zeros(n, bool), start.copy(), start + length
    while len(cur):
        seen[cur] = True
        cur = step[cur]
        more = cur < stop
        if not more.all():
            cur, stop = cur[more], stop[more]
    place = np.flatnonzero(seen)
    return place, most[place], far[place]


def encode_grey(samples: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """For each row of samples (a multiple of 64 bytes), its images behind each other."""
    size = np.diff(offsets)
    per_row = -(-size // (SIDE * SIDE))
    image_row = np.repeat(np.arange(len(size)), per_row)
    start = offsets[:-1][image_row] + ragged(np.zeros(len(size), np.int64), per_row) * SIDE * SIDE
    length = np.minimum(SIDE * SIDE, offsets[1:][image_row] - start)
    n = len(start)
    owner = np.repeat(np.arange(n), length)
    start = np.cumsum(length) - length  # images lie behind each other
    counts = np.bincount(owner * 256 + samples, minlength=n * 256).reshape(n, 256)
    lengths = code_lengths(counts)
    kind = np.where((counts > 0).sum(1) == 1, _SINGLE, _PLAIN)
    lengths[kind == _SINGLE] = 0
    heads = [_joined(_fields(None, k)) for k in range(3)]
    tail, n_tail = _joined(_TAIL)
    far_head, n_far = _joined([*_TAIL[:12], *_lengths_head(), (0, 1)])
    body = np.bincount(owner, weights=lengths.ravel()[owner * 256 + samples], minlength=n).astype(np.int64)
    before = np.where(kind == _SINGLE, heads[_SINGLE][1] + 8, heads[_PLAIN][1] + 1024) + n_tail

    place, most, far = _tokens(samples, start, length, owner)
    image, match = owner[place], most > 1
    symbol, extra, rest = _prefixed(most)
    green = np.where(match, 256 + symbol, samples[place])
    far_symbol, far_extra, far_rest = _prefixed(far + 120)  # the first 120 codes are near pixels
    green_counts = np.bincount(image * _GREEN + green, minlength=n * _GREEN).reshape(n, _GREEN)
    far_counts = np.bincount(image[match] * _FAR + far_symbol[match], minlength=n * _FAR).reshape(n, _FAR)
    green_lengths, far_lengths = code_lengths(green_counts), code_lengths(far_counts)
    green_bits = green_lengths.ravel()[image * _GREEN + green] + np.where(match, extra, 0)
    far_bits = np.where(match, far_lengths.ravel()[image * _FAR + far_symbol] + far_extra, 0)
    matched_body = np.bincount(image, weights=green_bits + far_bits, minlength=n).astype(np.int64)
    matched_before = heads[_MATCHED][1] + 4 * _GREEN + n_far + 4 * _FAR
    better = ((far_counts > 0).sum(1) > 1) & ((green_counts > 0).sum(1) > 1) & (matched_before + matched_body < before + body)
    kind[better], body[better], before[better] = _MATCHED, matched_body[better], matched_before

    n_bytes = 1 + (before + body + 7) // 8
    room = 6 + (n_bytes + 3) // 4  # words of a record: 20 bytes of RIFF head, the stream, slack
    base = np.concatenate([[0], np.cumsum(room)])
    words = np.zeros(int(base[-1]) + 2, np.uint32)
    bit0 = (base[:-1] * 4 + 21) * 8

    def constant(at: np.ndarray, value: int, bits: int, height: np.ndarray | None = None) -> None:
        for low in range(0, bits, 32):
            part = np.full(len(at), value >> low & 0xFFFFFFFF, np.int64)
            if height is not None and not low:
                part |= (height - 1 & 63) << 14
            _write_fields(words, at + low, part)

    def nibbles(at: np.ndarray, table: np.ndarray) -> None:
        width = table.shape[1]
        _write_fields(words, (at[:, None] + np.arange(width) * 4).ravel(), (_REVERSED[table] >> (_LONGEST - 4)).ravel())

    for k, (head, n_head) in enumerate(heads):
        at = np.flatnonzero(kind == k)
        constant(bit0[at], head, n_head, length[at] // SIDE)
        after = bit0[at] + n_head
        if k == _SINGLE:
            _write_fields(words, after, counts[at].argmax(1))
            constant(after + 8, tail, n_tail)
        elif k == _PLAIN:
            nibbles(after, lengths[at])
            constant(after + 1024, tail, n_tail)
        else:
            nibbles(after, green_lengths[at])
            constant(after + 4 * _GREEN, far_head, n_far)
            nibbles(after + 4 * _GREEN + n_far, far_lengths[at])

    some = np.flatnonzero(kind[owner] == _PLAIN)
    bits, codes = lengths.ravel()[owner[some] * 256 + samples[some]], _canonical(lengths).ravel()
    _write_fields(words, _places(owner[some], bits, n) + (bit0 + before)[owner[some]], codes[owner[some] * 256 + samples[some]])
    some = np.flatnonzero(kind[image] == _MATCHED)
    if len(some):
        image, green, match, extra, rest, far_symbol, far_rest = (x[some] for x in (image, green, match, extra, rest, far_symbol, far_rest))
        green_bits, far_bits = green_bits[some], far_bits[some]
        at = _places(image, green_bits + far_bits, n) + (bit0 + before)[image]
        short = green_lengths.ravel()[image * _GREEN + green]
        _write_fields(words, at, _canonical(green_lengths).ravel()[image * _GREEN + green] | np.where(match, rest, 0) << short)
        short = far_lengths.ravel()[image * _FAR + far_symbol][match]
        _write_fields(words, (at + green_bits)[match], _canonical(far_lengths).ravel()[image * _FAR + far_symbol][match] | far_rest[match] << short)
    raw = words.view(np.uint8)
    raw[(base[:-1] * 4)[:, None] + np.arange(20)] = _riff_heads(n_bytes)
    raw[base[:-1] * 4 + 20] = 0x2F
    record = 20 + n_bytes + (n_bytes & 1)
    blob = raw[ragged(base[:-1] * 4, record)].tobytes()
    ends = np.cumsum(np.bincount(image_row, weights=record, minlength=len(size)).astype(np.int64))
    return [blob[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def _places(owner: np.ndarray, bits: np.ndarray, n: int) -> np.ndarray:
    """Where each field begins among those of its owner; fields are ordered by owner."""
    within = np.cumsum(bits) - bits
    first = np.zeros(n, np.int64)
    new = np.flatnonzero(np.diff(owner, prepend=-1))
    first[owner[new]] = within[new]
    return within - first[owner]


def _riff_heads(n_bytes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(n_bytes), 5), "<u4")
    out[:, 0], out[:, 2], out[:, 3] = np.frombuffer(b"RIFF", "<u4"), np.frombuffer(b"WEBP", "<u4"), np.frombuffer(b"VP8L", "<u4")
    out[:, 1], out[:, 4] = 12 + n_bytes + (n_bytes & 1), n_bytes
    return out.view(np.uint8)


def images_of(blob: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(blob):
        size = 8 + struct.unpack_from("<I", blob, at + 4)[0]
        out.append(blob[at : at + size])
        at += size
    return out


def _bits_at(data: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """n <= 24 bits at each of the bit positions."""
    byte = at >> 3
    value = data[byte].astype(np.int64) | data[byte + 1].astype(np.int64) << 8 | data[byte + 2].astype(np.int64) << 16 | data[byte + 3].astype(np.int64) << 24
    return value >> (at & 7) & ((1 << n) - 1)


def decode_grey(media: list[bytes]) -> list[bytes]:
    """The samples of each row of images. Plain layouts are read in lockstep, others by decode()."""
    images = [images_of(m) for m in media]
    per_row = [len(x) for x in images]
    flat = [i for x in images for i in x]
    data = np.frombuffer(b"".join(flat) + b"\0" * 16, np.uint8)
    size = np.array([len(x) for x in flat], np.int64)
    bit0 = (np.cumsum(size) - size + 21) * 8
    out: list[bytes | None] = [None] * len(flat)
    matches = lambda at, fields, skip: np.logical_and.reduce([_bits_at(data, at + p, n) == v for v, n, p in _placed(fields) if p not in skip])
    height = _bits_at(data, bit0 + 14, 14) + 1
    n_far = _joined([*_TAIL[:12], *_lengths_head(), (0, 1)])[1]
    for kind in range(3):
        n_head = _joined(_fields(None, kind))[1]
        n_green = (1024, 8, 4 * _GREEN)[kind]
        here = np.array([i for i in range(len(flat)) if size[i] > 21 + (n_head + n_green + (n_far + 4 * _FAR if kind == _MATCHED else 40)) // 8], np.int64)
        if not len(here):
            continue
        here = here[matches(bit0[here], _fields(None, kind), {14}) & (height[here] <= SIDE)]
        here = here[matches(bit0[here] + n_head + n_green, [*_TAIL[:12], *_lengths_head(), (0, 1)] if kind == _MATCHED else _TAIL, set())]
        if not len(here):
            continue
        if kind == _SINGLE:
            for i, v in zip(here.tolist(), _bits_at(data, bit0[here] + n_head, 8).tolist()):
                out[i] = bytes([v]) * (SIDE * int(height[i]))
            continue
        at = bit0[here] + n_head
        lengths, full = _lengths_at(data, at, n_green // 4)
        at = at + n_green + (n_far if kind == _MATCHED else _joined(_TAIL)[1])
        if kind == _PLAIN:
            here, at, lengths = here[full], at[full], lengths[full]
            found = _lockstep(data, at, lengths, height[here] * SIDE)
        else:
            far_lengths, far_full = _lengths_at(data, at, _FAR)
            full &= far_full
            here, at, lengths, far_lengths = here[full], at[full], lengths[full], far_lengths[full]
            found = _lockstep_matched(data, at + 4 * _FAR, lengths, far_lengths, height[here] * SIDE)
        for i, samples in zip(here.tolist(), found):
            out[i] = samples
    for i, x in enumerate(out):
        if x is None:
            out[i] = np.ascontiguousarray(decode(flat[i])[:, :, 2]).tobytes()
    ends = np.cumsum(per_row).tolist()
    return [b"".join(out[a:b]) for a, b in zip([0, *ends[:-1]], ends)]


def _placed(fields: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    at, out = 0, []
    for v, n in fields:
        out.append((v, n, at))
        at += n
    return out


def _lengths_at(data: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n code lengths of four bits each at every position, and whether they make a complete code."""
    lengths = _REVERSED[_bits_at(data, at[:, None] + np.arange(n) * 4, 4)] >> (_LONGEST - 4)
    full = (np.where(lengths > 0, 1 << np.maximum(_LONGEST - lengths, 0), 0).sum(1) == 1 << _LONGEST) & (lengths.max(1, initial=0) <= _LONGEST)
    return lengths, full


def _tables(lengths: np.ndarray) -> np.ndarray:
    """For each image's code a table over _LONGEST bits: symbol, and the word's length from bit 9 on."""
    by_length = np.argsort(np.where(lengths > 0, lengths, 99), axis=1, kind="stable")
    n = np.take_along_axis(lengths, by_length, 1)
    straight = np.repeat((by_length | n << 9).ravel(), np.where(n > 0, 1 << np.maximum(_LONGEST - n, 0), 0).ravel())
    return np.ascontiguousarray(straight.reshape(len(lengths), -1)[:, _REVERSED]).astype(np.uint16).ravel()


def _wide(data: np.ndarray) -> np.ndarray:
    """32 bits from each byte on."""
    wide = data[:-3].astype(np.uint32)
    for k in (1, 2, 3):
        wide |= data[k : len(data) - 3 + k].astype(np.uint32) << np.uint32(8 * k)
    return wide


def _unprefixed(symbol: np.ndarray, wide: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The value of a length or distance symbol whose extra bits lie at `at`, and where they end."""
    extra = np.where(symbol < 4, 0, (symbol - 2) >> 1)
    more = (wide[at >> 3] >> (at & 7).astype(np.uint32)).astype(np.int64) & ((1 << extra) - 1)
    return np.where(symbol < 4, symbol + 1, ((2 + (symbol & 1)) << extra) + 1 + more), at + extra


def _lockstep_matched(data: np.ndarray, at: np.ndarray, lengths: np.ndarray, far_lengths: np.ndarray, count: np.ndarray) -> list[bytes | None]:
    """Decode images with back-references, one token of all of them a step; null where a token leaves
    the image or refers to near pixels, which decode() is for."""
    n, most = len(at), SIDE * SIDE
    if not n:
        return []
    green, far, wide, mask = _tables(lengths), _tables(far_lengths), _wide(data), (1 << _LONGEST) - 1
    out, odd = np.zeros((n + 1) * most, np.uint8), np.zeros(n, bool)
    image, p, o, stop = np.arange(n), at.astype(np.int64), np.arange(n) * most, np.arange(n) * most + count
    limit = 8 * (len(wide) - 1)
    while len(image):
        table = image << _LONGEST
        got = green[table + ((wide[p >> 3] >> (p & 7).astype(np.uint32)) & mask)].astype(np.int64)
        symbol = got & 511
        p = p + (got >> 9)
        out[o] = symbol.astype(np.uint8)
        step = np.ones(len(o), np.int64)
        m = np.flatnonzero(symbol > 255)
        if len(m):
            length, q = _unprefixed(symbol[m] - 256, wide, p[m])
            got = far[table[m] + ((wide[q >> 3] >> (q & 7).astype(np.uint32)) & mask)].astype(np.int64)
            code, q = _unprefixed(got & 511, wide, q + (got >> 9))
            back, to = code - 120, o[m]
            bad = (back < 1) | (back > to - image[m] * most) | (to + length > stop[m])
            if bad.any():
                odd[image[m[bad]]] = True
                back, length = np.where(bad, 1, back), np.where(bad, 1, length)
            many = ragged(to, length)
            again = np.repeat(to, length)
            apart = np.repeat(back, length)
            out[many] = out[np.maximum(again - apart, 0) + (many - again) % apart]
            step[m], p[m] = length, q
        o = o + step
        more = (o < stop) & (p < limit) & ~odd[image]
        if not more.all():
            odd[image[(o < stop) & (p >= limit)]] = True
            image, p, o, stop = image[more], p[more], o[more], stop[more]
    rows = out.reshape(n + 1, most)
    return [None if odd[i] else rows[i, : count[i]].tobytes() for i in range(n)]


def _lockstep(data: np.ndarray, at: np.ndarray, lengths: np.ndarray, count: np.ndarray) -> list[bytes]:
    """Decode count[i] symbols from bit at[i] of every image i, one symbol of all images a step."""
    if not len(at):
        return []
    order = np.argsort(-count, kind="stable")
    at, count, lengths = at[order].copy(), count[order], lengths[order]
    table, wide = _tables(lengths), _wide(data)
    base = np.arange(len(at)) << _LONGEST
    steps = int(count[0])
    active = np.searchsorted(-count, -np.arange(1, steps + 1), "right").tolist()
    found = np.zeros((steps, len(at)), np.uint8)
    mask = (1 << _LONGEST) - 1
    for t, k in enumerate(active):
        p = at[:k]
        got = table[base[:k] + ((wide[p >> 3] >> (p & 7)) & mask)]
        found[t, :k] = got & 255
        p += got >> 9
    columns = np.ascontiguousarray(found.T)
    out: list[bytes] = [b""] * len(at)
    for j, i in enumerate(order.tolist()):
        out[i] = columns[j, : count[j]].tobytes()
    return out


# -- tables ------------------------------------------------------------------------------------


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media: every text's bytes, padded with zeros, as images."""
    ship(docs.sparkSession)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, "body", 2 << 20):
            size = np.diff(offsets)
            padded = -(-np.maximum(size, 1) // SIDE) * SIDE
            bounds = np.concatenate([[0], np.cumsum(padded)])
            samples = np.zeros(int(bounds[-1]), np.uint8)
            samples[ragged(bounds[:-1], size)] = data
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(encode_grey(samples, bounds), pa.binary())], ["doc_id", "n_bytes", "media"])

    return whole_texts(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(store, "doc_id long, n_bytes long, media binary")


_READ = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def read_media(stored: DataFrame) -> DataFrame:
    """Decode every stored form and describe its samples. feature: mean and entropy (bits) of the samples."""
    ship(stored.sparkSession)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in pieces(batches, "media", 2 << 20):
            media = batch.column(2).to_pylist()
            rows = []
            for blob, payload in zip(media, decode_grey(media)):
                samples = np.frombuffer(payload, np.uint8)
                share = np.bincount(samples, minlength=256) / len(samples)
                share = share[share > 0]
                feature = f"{samples.mean():.4f};{abs(float(-(share * np.log2(share)).sum())):.4f}"
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-SIDE:]), len(blob), hashlib.sha256(blob).hexdigest(), feature))
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return stored.select("doc_id", "n_bytes", "media").mapInArrow(look, _READ)


def op3_webp_media(spark, sf_dir: str) -> DataFrame:
    return read_media(materialize(store_texts(read(spark, sf_dir, "documents").select("doc_id", "text")), "media"))
