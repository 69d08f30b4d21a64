"""Media columns as lossless WebP: a writer and a full reader of the format, in numpy.

The reader decodes every part of a lossless stream: simple and normal prefix codes, several code groups, literals,
back-references with the plane-distance codes, the colour cache, and the four transforms (predictor, cross-colour,
subtract-green, palette with pixel bundling). Streams of literals under one group of codes, as the writer makes
them for most texts, take a path without a loop over pixels: the symbol and length that would begin at every bit of a
portion are looked up at once, and the chain of pixel starts is followed by jumps over several pixels. All others take the plain
path.

The writer lays bytes out as opaque RGB pixels, ``UNIT`` bytes (64 pixels) to a row or a multiple of that, with
prefix codes made from the bytes' counts. Images with few colours go through the palette transform. Others have green
subtracted, or are predicted by the pixel to the left or above, if that takes fewer bits by the entropy of some rows; and where at
least ``REPEATED`` of the pixels repeat earlier ones, these become back-references. The colour cache and cross-colour
are read but never written, as reading a cache back is sequential and cross-colour saves nothing on text.

Defined cases of the query: null text counts as empty, and an empty text is stored as one row of spaces; equal
texts give equal values; texts of any length are stored whole (rows are widened so that no side exceeds 16,384), in some 40 bytes of memory a
byte of text;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.common import map_arrow

UNIT, SIDE = 192, 16384
#: Longest prefix code that the writer makes.
LIMIT = 11
#: Bytes of a stream, or codes, that are looked up or joined at once.
PORTION = 1 << 15
#: Pixels of the shortest back-reference, of the longest, and the part that they must cover.
SHORTEST, FARTHEST, REPEATED = 8, 4096, 0.5
#: Rows by which the way of writing is chosen.
JUDGED = 64
#: Pixels that a back-reference reaches back at most.
WITHIN = (1 << 20) - 120
# Fixed values of the format.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
LITERALS, LENGTHS, DISTANCES = 256, 24, 40
CACHE_FACTOR = 0x1E35A7BD
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)


@cache
def plane_distances() -> list[tuple[int, int]]:
    """The 120 nearby pixels, nearest first: (left, up)."""
    near = [(x, y) for y in range(8) for x in range(-7, 9) if y > 0 or x > 0]
    return sorted(near, key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0))


class Bits:
    """Bits of a stream, the lowest of each byte first; zeros beyond the end are an error."""

    def __init__(self, data: bytes):
        self.at, self.end = 0, 8 * len(data)
        self.data = data + bytes(24)

    def peek(self, n: int) -> int:
        byte = self.at >> 3
        return (int.from_bytes(self.data[byte : byte + 5], "little") >> (self.at & 7)) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        if self.at + n > self.end:
            raise ValueError("the stream ends too early")
        out = self.peek(n)
        self.at += n
        return out

    def skip(self, n: int) -> None:
        self.at += n
        if self.at > self.end:
            raise ValueError("the stream ends too early")

    def between(self, start: int, end: int) -> int:
        """The bits from start to end as a number."""
        return (int.from_bytes(self.data[start >> 3 : (end + 7) >> 3], "little") >> (start & 7)) & ((1 << (end - start)) - 1)


@cache
def _reversed(length: int) -> np.ndarray:
    """Each number of ``length`` bits with its bits the other way round."""
    n = np.arange(1 << length)
    out = np.zeros_like(n)
    for k in range(length):
        out |= ((n >> k) & 1) << (length - 1 - k)
    return out


def _in_order(lengths: np.ndarray) -> np.ndarray:
    """Symbols in the order of their codes."""
    used = np.flatnonzero(lengths)
    return used[np.argsort(lengths[used], kind="stable")]


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes of symbols by their lengths, as the stream has them (first bit lowest)."""
    codes, order = np.zeros(len(lengths), dtype=np.int64), _in_order(lengths)
    spans = 1 << 15 >> lengths[order]
    codes[order] = _reversed(15)[(np.cumsum(spans) - spans) & 0x7FFF]
    return codes


class Code:
    """A prefix code for reading: by the next ``depth`` bits, the symbol and the length."""

    def __init__(self, lengths: np.ndarray):
        order = _in_order(lengths)
        if len(order) == 0:
            raise ValueError("a prefix code without symbols")
        self.last = int(order.max())
        if len(order) == 1:  # one symbol takes no bits
            self.depth, self.symbols, self.lengths = 0, order, np.zeros(1, np.int32)
        else:
            own = lengths[order]
            self.depth = int(own[-1])
            if (1 << 15 >> own).sum() != 1 << 15:
                raise ValueError("an incomplete prefix code")
            spans, turned = 1 << self.depth >> own, _reversed(self.depth)
            self.symbols, self.lengths = np.repeat(order, spans)[turned], np.repeat(own, spans)[turned].astype(np.int32)
        self.pairs = list(zip(self.symbols.tolist(), self.lengths.tolist(), strict=True)) if self.depth < 8 else None

    def read(self, bits: Bits) -> int:
        k = bits.peek(self.depth)
        symbol, length = self.pairs[k] if self.pairs else (int(self.symbols[k]), int(self.lengths[k]))
        bits.skip(length)
        return symbol


@cache
def _lone(symbol: int) -> Code:
    lengths = np.zeros(symbol + 1, dtype=np.int64)
    lengths[symbol] = 1
    return Code(lengths)


def read_codes(bits: Bits, sizes: tuple[int, ...]) -> list[Code]:
    """Several codes; one that repeats the bits of the one before it, symbols below 256 alone, isn't read again."""
    out: list[Code] = []
    spelt = None  # the bits of a code, where they end, and the code
    for size in sizes:
        start = bits.at
        if spelt and size >= LITERALS and start + spelt[1] <= bits.end and bits.between(start, start + spelt[1]) == spelt[0]:
            bits.skip(spelt[1])
            out.append(spelt[2])
            continue
        code = read_code(bits, size)
        out.append(code)
        spelt = (bits.between(start, bits.at), bits.at - start, code) if code.depth and code.last < LITERALS - 1 else None
    return out


def read_code(bits: Bits, size: int) -> Code:
    lengths = np.zeros(size, dtype=np.int64)
    if bits.read(1):  # simple
        two = bits.read(1)
        first = bits.read(8 if bits.read(1) else 1)
        if not two:
            return _lone(first)
        lengths[[first, bits.read(8)]] = 1
        return Code(lengths)
    own = np.zeros(19, dtype=np.int64)
    for k in range(4 + bits.read(4)):
        own[LENGTH_ORDER[k]] = bits.read(3)
    code = Code(own)
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else size
    k, before = 0, 8
    while k < size and left > 0:
        left -= 1
        n = code.read(bits)
        if n < 16:
            lengths[k] = n
            k, before = k + 1, n or before
        else:
            times = bits.read(2) + 3 if n == 16 else bits.read(3) + 3 if n == 17 else bits.read(7) + 11
            if k + times > size:
                raise ValueError("too many code lengths")
            lengths[k : k + times] = before if n == 16 else 0
            k += times
    return Code(lengths)


def _extra(bits: Bits, prefix: int) -> int:
    if prefix < 4:
        return prefix + 1
    n = (prefix - 2) >> 1
    return ((2 + (prefix & 1)) << n) + bits.read(n) + 1


def _literals(bits: Bits, codes: list[Code], n: int) -> np.ndarray | None:
    """All pixels at once, where the codes have literals only; None if the stream is too short for that."""
    if codes[0].last >= LITERALS:
        return None
    if not any(c.depth for c in codes[:4]):
        return np.tile(np.array([c.symbols[0] for c in codes[:4]], dtype=np.uint8), (n, 1))
    deepest = max(c.depth for c in codes[:4])
    longest = sum(c.depth for c in codes[:4])  # bits of a pixel at most
    out, done = np.empty((n, 4), dtype=np.uint8), 0
    data = np.frombuffer(bits.data, np.uint8)
    while done < n:
        if bits.at > bits.end:
            raise ValueError("the stream ends too early")
        first = bits.at >> 3
        part = data[first : first + min(PORTION, ((n - done) * longest + 7) // 8 + 12) + 3].astype(np.uint32)
        three = part[:-2] | part[1:-1] << 8 | part[2:] << 16
        window = (three[:, None] >> np.arange(8, dtype=np.uint32)).ravel() & np.uint32((1 << deepest) - 1)
        size = len(window)
        stay = np.arange(size + 64, dtype=np.int32)  # beyond the end a chain stands still
        lengths: dict[int, np.ndarray] = {}
        afters, jump = [], stay
        for code in codes[:4]:
            if code.depth:
                if id(code) not in lengths:
                    lengths[id(code)] = stay.copy()
                    lengths[id(code)][:size] += code.lengths[window if code.depth == deepest else window & np.uint32((1 << code.depth) - 1)]
                jump = lengths[id(code)] if jump is stay else lengths[id(code)][jump]
            afters.append(jump)
        # Every 16th start is followed one by one, those between by the jumps over 8, 4, 2 and 1 pixels.
        leaps, limit, at, marks = [jump], size - longest, bits.at & 7, []
        for _ in range(4):
            leaps.append(leaps[-1][leaps[-1]])
        far = memoryview(leaps.pop())
        while at <= limit and 16 * len(marks) < n - done:
            marks.append(at)
            at = far[at]
        starts = np.array(marks, dtype=np.int32)
        for leap in reversed(leaps):
            starts = np.stack([starts, leap[starts]], axis=-1)
        starts = starts.ravel()
        starts = starts[: min(n - done, int(np.searchsorted(starts, limit, "right")))]
        if not len(starts):
            raise ValueError("the stream ends too early")
        at = starts
        for k, code in enumerate(codes[:4]):
            out[done : done + len(starts), k] = code.symbols[window[at] & np.uint32((1 << code.depth) - 1)] if code.depth else code.symbols[0]
            at = afters[k][starts]
        done, bits.at = done + len(starts), (first << 3) + int(jump[starts[-1]])
    if bits.at > bits.end:
        raise ValueError("the stream ends too early")
    return out


def read_pixels(bits: Bits, width: int, height: int, main: bool) -> np.ndarray:
    """Entropy-coded pixels as a vector of ARGB numbers."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    groups_of, group_bits, groups = None, 0, 1
    if main and bits.read(1):
        group_bits = bits.read(3) + 2
        across = -(-width >> group_bits)
        groups_of = (read_pixels(bits, across, -(-height >> group_bits), False) >> 8) & 0xFFFF
        groups = int(groups_of.max()) + 1
    sizes = (LITERALS + LENGTHS + (1 << cache_bits if cache_bits else 0), 256, 256, 256, DISTANCES)
    codes = [read_codes(bits, sizes) for _ in range(groups)]
    n = width * height
    if groups == 1:
        fast = _literals(bits, codes[0], n)
        if fast is not None:
            return np.ascontiguousarray(fast[:, [2, 0, 1, 3]]).view("<u4")[:, 0].astype(np.int64)
    out, stored, noted, k = [0] * n, [0] * (1 << cache_bits), 0, 0
    while k < n:
        group = codes[int(groups_of[(k // width >> group_bits) * across + (k % width >> group_bits)])] if groups_of is not None else codes[0]
        s = group[0].read(bits)
        if s < LITERALS:
            red, blue, alpha = (group[j].read(bits) for j in (1, 2, 3))
            out[k] = alpha << 24 | red << 16 | s << 8 | blue
            k += 1
        elif s < LITERALS + LENGTHS:
            length, near = _extra(bits, s - LITERALS), _extra(bits, group[4].read(bits))
            if near > 120:
                back = near - 120
            else:
                left, up = plane_distances()[near - 1]
                back = max(1, left + up * width)
            if back > k or k + length > n:
                raise ValueError("a back-reference out of the image")
            while length:
                some = min(length, back)
                out[k : k + some] = out[k - back : k - back + some]
                k, length = k + some, length - some
        else:
            for p in out[noted:k]:
                stored[(CACHE_FACTOR * p & 0xFFFFFFFF) >> (32 - cache_bits)] = p
            noted = k
            out[k] = stored[s - LITERALS - LENGTHS]
            k += 1
    return np.array(out, dtype=np.int64)


def _planes(argb: np.ndarray) -> np.ndarray:
    return np.stack([argb >> 24 & 255, argb >> 16 & 255, argb >> 8 & 255, argb & 255], axis=-1)


def _numbers(planes: np.ndarray) -> np.ndarray:
    p = planes.astype(np.int64) & 255
    return p[..., 0] << 24 | p[..., 1] << 16 | p[..., 2] << 8 | p[..., 3]


def _predict(mode: int, left, top, corner, right) -> list[int]:
    """The predicted pixel, by channel. corner: above left; right: above right."""
    half = lambda a, b: [(x + y) >> 1 for x, y in zip(a, b, strict=True)]
    clamp = lambda x: 0 if x < 0 else 255 if x > 255 else x
    match mode:
        case 1:
            return left
        case 2:
            return top
        case 3:
            return right
        case 4:
            return corner
        case 5:
            return half(half(left, right), top)
        case 6:
            return half(left, corner)
        case 7:
            return half(left, top)
        case 8:
            return half(corner, top)
        case 9:
            return half(top, right)
        case 10:
            return half(half(left, corner), half(top, right))
        case 11:
            to_left = sum(abs(t - c) for t, c in zip(top, corner, strict=True))
            to_top = sum(abs(x - c) for x, c in zip(left, corner, strict=True))
            return left if to_left < to_top else top
        case 12:
            return [clamp(x + t - c) for x, t, c in zip(left, top, corner, strict=True)]
        case 13:
            return [clamp(a + int((a - c) / 2)) for a, c in zip(half(left, top), corner, strict=True)]
    return [255, 0, 0, 0]


def undo_predictor(argb: np.ndarray, width: int, height: int, modes: np.ndarray, size_bits: int) -> np.ndarray:
    kinds = np.unique(modes >> 8 & 15)
    if len(kinds) == 1 and kinds[0] in (1, 2):  # by the left or upper pixel alone: running sums
        planes = _planes(argb).astype(np.uint8).reshape(height, width, 4)
        planes[0, 0, :1] += 255
        lead, other = (0, 1) if kinds[0] == 1 else (1, 0)  # the edge that is summed first
        edge = planes[:, 0] if lead == 0 else planes[0]
        edge[:] = np.cumsum(edge, axis=0, dtype=np.uint8)
        return _numbers(np.cumsum(planes, axis=other, dtype=np.uint8).reshape(-1, 4))
    rest, across = _planes(argb).tolist(), -(-width >> size_bits)
    for k in range(width * height):
        y, x = divmod(k, width)
        if k == 0:
            guess = [255, 0, 0, 0]
        elif y == 0:
            guess = rest[k - 1]
        elif x == 0:
            guess = rest[k - width]
        else:
            mode = int(modes[(y >> size_bits) * across + (x >> size_bits)]) >> 8 & 15
            guess = _predict(mode, rest[k - 1], rest[k - width], rest[k - width - 1], rest[k - width + 1])
        rest[k] = [(a + b) & 255 for a, b in zip(rest[k], guess, strict=True)]
    return _numbers(np.array(rest))


def undo_cross_colour(argb: np.ndarray, width: int, height: int, factors: np.ndarray, size_bits: int) -> np.ndarray:
    y, x = np.divmod(np.arange(width * height), width)
    own = _planes(factors)[(y >> size_bits) * -(-width >> size_bits) + (x >> size_bits)]
    signed = lambda v: (v & 255) - ((v & 128) << 1)
    delta = lambda t, c: signed(t) * signed(c) >> 5
    a, red, green, blue = _planes(argb).T
    red = (red + delta(own[:, 3], green)) & 255
    blue = (blue + delta(own[:, 2], green) + delta(own[:, 1], red)) & 255
    return _numbers(np.stack([a, red, green, blue], axis=-1))


def undo_subtract_green(argb: np.ndarray) -> np.ndarray:
    a, red, green, blue = _planes(argb).T
    return _numbers(np.stack([a, red + green, green, blue + green], axis=-1))


def undo_palette(argb: np.ndarray, packed: int, width: int, height: int, colours: np.ndarray) -> np.ndarray:
    index = argb >> 8 & 255
    if packed:
        per, each = 1 << packed, 8 >> packed
        index = (index[:, None] >> (each * np.arange(per)) & ((1 << each) - 1)).reshape(height, -1)[:, :width].ravel()
    table = np.zeros(256, dtype=np.int64)
    table[: len(colours)] = colours
    return table[index]


def _chunk(data: bytes) -> bytes:
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise ValueError("not a WebP file")
    at = 12
    while at + 8 <= len(data):
        size = int.from_bytes(data[at + 4 : at + 8], "little")
        if data[at : at + 4] == b"VP8L":
            return data[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no lossless image in the file")


def decode(data: bytes) -> np.ndarray:
    """A lossless WebP file as an array height x width x 4 of RGBA samples."""
    bits = Bits(_chunk(data))
    if bits.read(8) != 0x2F:
        raise ValueError("not a lossless stream")
    full, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("unknown version")
    width, undo = full, []
    while bits.read(1):
        kind = bits.read(2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            size_bits = bits.read(3) + 2
            part = read_pixels(bits, -(-width >> size_bits), -(-height >> size_bits), False)
            undo.append((undo_predictor if kind == PREDICTOR else undo_cross_colour, width, height, part, size_bits))
        elif kind == SUBTRACT_GREEN:
            undo.append((undo_subtract_green,))
        else:
            n = bits.read(8) + 1
            colours = _numbers(np.cumsum(_planes(read_pixels(bits, n, 1, False)), axis=0))
            packed = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            undo.append((undo_palette, packed, width, height, colours))
            width = -(-width >> packed)
    argb = read_pixels(bits, width, height, True)
    for function, *rest in reversed(undo):
        argb = function(argb, *rest)
    return np.stack([(argb >> k).astype(np.uint8) for k in (16, 8, 0, 24)], axis=-1).reshape(height, full, 4)


class Writer:
    """Bits to write: numbers and vectors of (value, length), joined at the end."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def put(self, *pairs: tuple[int, int]) -> None:
        values, lengths = zip(*pairs, strict=True)
        self.parts.append((np.array(values, dtype=np.int32), np.array(lengths, dtype=np.int8)))

    def bytes(self) -> bytes:
        """Values, below 2**24 each, are added up in words of 32 bits, some thousand at a time."""
        total, at = sum(int(n.sum(dtype=np.int64)) for _, n in self.parts), 0
        words = np.zeros(total // 32 + 3, dtype=np.uint64)
        for values, lengths in self._portions():
            ends = at + np.cumsum(lengths, dtype=np.int64)
            begins = ends - lengths
            word = begins >> 5
            shifted = values.astype(np.uint64) << (begins & 31).astype(np.uint64)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            words[word[first]] += np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), first)
            words[word[first] + 1] += np.add.reduceat(shifted >> np.uint64(32), first)
            at = int(ends[-1])
        return words.astype("<u4").tobytes()[: (total + 7) // 8]

    def _portions(self):
        small: list = []
        for part in self.parts:
            if len(part[0]) < PORTION:
                small.append(part)
                continue
            if small:
                yield tuple(np.concatenate(c) for c in zip(*small, strict=True))
                small = []
            for k in range(0, len(part[0]), PORTION):
                yield part[0][k : k + PORTION], part[1][k : k + PORTION]
        if small:
            yield tuple(np.concatenate(c) for c in zip(*small, strict=True))


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of a Huffman code; counts are evened out until no length exceeds the limit."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    weights = counts[used].tolist()
    while True:
        n = len(used)
        heap = [(w, k) for k, w in enumerate(weights)]
        heapq.heapify(heap)
        parent = [0] * (2 * n - 1)
        for k in range(n, 2 * n - 1):
            a = heapq.heappop(heap)
            b = heap[0]
            parent[a[1]] = parent[b[1]] = k
            heapq.heapreplace(heap, (a[0] + b[0], k))
        depth = [0] * (2 * n - 1)
        for k in range(2 * n - 3, -1, -1):
            depth[k] = depth[parent[k]] + 1
        if max(depth[:n]) <= limit:
            lengths[used] = depth[:n]
            return lengths
        weights = [w // 2 + 1 for w in weights]


def code_bits(lengths: np.ndarray) -> list[tuple[int, int]]:
    """A prefix code as the stream spells it; runs of zero lengths are shortened."""
    used = np.flatnonzero(lengths)
    if len(used) <= 2 and used.max(initial=0) < 256:
        first = int(used[0]) if len(used) else 0
        out = [(1, 1), (int(len(used) == 2), 1), (1, 1), (first, 8)]
        return [*out, (int(used[1]), 8)] if len(used) == 2 else out
    items: list[tuple[int, int, int]] = []  # symbol, extra bits, their number
    k, end = 0, int(used[-1]) + 1
    while k < end:
        if lengths[k]:
            items.append((int(lengths[k]), 0, 0))
            k += 1
            continue
        run = int(np.argmax(lengths[k:end] > 0))
        k += run
        while run:
            take = min(run, 138)
            if take >= 11:
                items.append((18, take - 11, 7))
            elif take >= 3:
                items.append((17, take - 3, 3))
            else:
                items += [(0, 0, 0)] * take
            run -= take
    own = code_lengths(np.bincount([i[0] for i in items], minlength=19), 7)
    codes, lone = canonical(own), np.count_nonzero(own) == 1
    out = [(0, 1), (15, 4), *((int(own[s]), 3) for s in LENGTH_ORDER)]
    n, width = len(items), max(2, (len(items) - 2).bit_length())
    width += width % 2
    out += [(1, 1), ((width - 2) // 2, 3), (max(n, 2) - 2, width)]
    items += [(0, 0, 0)] * (2 - n)
    for symbol, extra, size in items:
        out += [(0 if lone else int(codes[symbol]), 0 if lone else int(own[symbol])), (extra, size)]
    return out


def put_pixels(out: Writer, planes: np.ndarray, main: bool) -> None:
    """Literals under one group of codes. planes: pixels x (green, red, blue, alpha)."""
    out.put((0, 1), *[(0, 1)] * main)  # no colour cache, one group of codes
    varied = [k for k in range(4) if not (planes[:, k] == planes[0, k]).all()]
    shared = None
    if varied:
        lengths = code_lengths(sum(np.bincount(planes[:, k], minlength=256) for k in varied))
        shared = (canonical(lengths).astype(np.int32), lengths.astype(np.int8), code_bits(lengths))
    for k in range(4):
        out.put(*(shared[2] if k in varied else [(1, 1), (0, 1), (1, 1), (int(planes[0, k]), 8)]))
    out.put((1, 1), (0, 1), (0, 1), (0, 1))  # no distances
    if varied:
        told = planes[:, varied].ravel()
        out.parts.append((shared[0][told], shared[1][told]))


_FACTOR = CACHE_FACTOR * 2 + 1
_POWERS: list[np.ndarray] = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a factor and of its inverse, kept from call to call."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 12)
        _POWERS[:] = [np.cumprod(np.full(size, f, dtype=np.uint64)) for f in (np.uint64(_FACTOR), np.uint64(pow(_FACTOR, -1, 1 << 64)))]
    return _POWERS[0][:n], _POWERS[1][:n]


def repeats(pixels: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, distance) of runs of pixels that repeat earlier ones, in order; the last like window is the source.

    Windows are compared by their sums. One in eight, told by the sum itself, decides first whether the others are looked
    at: like windows are told alike, so what repeats shows among them as it does among all.
    """
    n = len(pixels)
    if n < 2 * SHORTEST:
        return []
    powers, inverse = _powers(n)
    summed = np.concatenate([np.zeros(1, np.uint64), np.cumsum((pixels.astype(np.uint64) + np.uint64(1)) * powers)])
    windows = (summed[SHORTEST:] - summed[:-SHORTEST]) * inverse[: n - SHORTEST + 1]
    some = np.sort(windows[(windows >> np.uint64(40)) & np.uint64(7) == 0])
    if len(some) > 64 and np.count_nonzero(some[1:] == some[:-1]) < 0.8 * REPEATED * len(some):
        return []
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    source = np.full(len(windows), -1, dtype=np.int64)
    source[order[1:][same]] = order[:-1][same]
    source[np.arange(len(source)) - source > WITHIN] = -1
    starts = np.flatnonzero(source >= 0)
    if len(starts) + SHORTEST < REPEATED * n:
        return []
    found, at = [], 0
    while (k := int(np.searchsorted(starts, at))) < len(starts):
        start = int(starts[k])
        back = start - int(source[start])
        most = min(FARTHEST, n - start)
        differ = pixels[start : start + most] != pixels[start - back : start - back + most]
        length = int(differ.argmax()) if differ.any() else most
        if length >= SHORTEST:  # windows of like sums that differ are left alone
            found.append((start, length, back))
        at = start + max(length, 1)
    return found if sum(x[1] for x in found) >= REPEATED * n else []


def _prefix(value: int) -> tuple[int, int, int]:
    """A length or distance from 1 on as (prefix symbol, extra bits, their number)."""
    x = value - 1
    if x < 4:
        return x, 0, 0
    high = x.bit_length() - 1
    return 2 * high + (x >> (high - 1) & 1), x & ((1 << (high - 1)) - 1), high - 1


def put_references(out: Writer, planes: np.ndarray, found: list[tuple[int, int, int]]) -> None:
    """Literals and back-references under one group of codes, a code for each channel."""
    literal = np.ones(len(planes), bool)
    for start, length, _ in found:
        literal[start : start + length] = False
    kept = np.flatnonzero(literal)
    runs = [(_prefix(length), _prefix(back + 120)) for _, length, back in found]  # distances of 120 and less name near pixels
    counts = [np.bincount(planes[kept, k], minlength=256) for k in range(4)]
    counts[0] = np.concatenate([counts[0], np.bincount([r[0][0] for r in runs], minlength=LENGTHS)])
    counts.append(np.bincount([r[1][0] for r in runs], minlength=DISTANCES))
    out.put((0, 1), (0, 1))
    codes = []
    for own in counts:
        lengths = code_lengths(own)
        out.put(*code_bits(lengths))
        alone = np.count_nonzero(lengths) < 2  # one symbol takes no bits
        codes.append((canonical(lengths) * (not alone), lengths * (not alone)))
    # Four fields a literal, four a reference: length, its extra bits, distance, its extra bits.
    values, sizes = (np.zeros((len(kept) + len(found), 4), dtype=kind) for kind in (np.int32, np.int8))
    starts = np.array([x[0] for x in found], dtype=np.int64)
    place = np.searchsorted(kept, starts) + np.arange(len(found))
    is_literal = np.ones(len(values), bool)
    is_literal[place] = False
    for k in range(4):
        told = planes[kept, k].astype(np.int64)
        values[is_literal, k], sizes[is_literal, k] = codes[k][0][told], codes[k][1][told]
    for row, (length, back) in zip(place.tolist(), runs, strict=True):
        green, distance = LITERALS + length[0], back[0]
        values[row] = codes[0][0][green], length[1], codes[4][0][distance], back[1]
        sizes[row] = codes[0][1][green], length[2], codes[4][1][distance], back[2]
    out.parts.append((values.ravel(), sizes.ravel()))


def _bits(samples: np.ndarray) -> float:
    """Bits of the samples under one code, by their entropy."""
    counts = np.bincount(samples.ravel(), minlength=256)
    counts = counts[counts > 0]
    return float((counts * np.log2(counts.sum() / counts)).sum())


def _told(rgb: np.ndarray, kind) -> np.ndarray:
    """Samples as they are written: as they are, with green subtracted, or less their left (1) or upper (2) pixel; edges have but one neighbour."""
    if kind is None:
        return rgb
    out = rgb.copy()
    if kind == "green":
        out[:, :, [0, 2]] -= rgb[:, :, [1]]
    elif kind == 1:
        out[:, 1:] -= rgb[:, :-1]
        out[1:, 0] -= rgb[:-1, 0]
    else:
        out[1:] -= rgb[:-1]
        out[0, 1:] -= rgb[0, :-1]
    return out


def _form(rgb: np.ndarray):
    """The way of writing that takes the fewest bits by its entropy, judged by up to ``JUDGED`` rows, evenly spread, and those above them."""
    step = max(1, len(rgb) // JUDGED)
    rows, above = rgb[1::step], rgb[: len(rgb) - 1 : step]
    if not len(rows):
        rows = above = rgb
    above = above[: len(rows)]
    green = rows - rows[:, :, [1]]
    bits = {None: _bits(rows), "green": _bits(np.stack([green[:, :, 0], rows[:, :, 1], green[:, :, 2]])), 1: _bits(rows[:, 1:] - rows[:, :-1]), 2: _bits(rows - above)}
    return min(bits, key=lambda k: bits[k] * (1 if k is None else 1.02) + (k is not None) * 64)


def encode(rgb: np.ndarray) -> bytes:
    """Opaque pixels (height x width x 3, bytes) as a lossless WebP file."""
    rgb = np.ascontiguousarray(rgb, dtype=np.uint8)
    height, width = rgb.shape[:2]
    n, flat = height * width, rgb.reshape(-1, 3)
    out = Writer()
    out.put((0x2F, 8), (width - 1, 14), (height - 1, 14), (0, 1), (0, 3))
    numbers = flat[:, 0].astype(np.int64) << 16 | flat[:, 1].astype(np.int64) << 8 | flat[:, 2]
    colours, index = np.unique(numbers, return_inverse=True) if n <= 4096 else (numbers, None)
    if index is not None and len(colours) <= min(256, max(1, n // 3)):
        packed = 3 if len(colours) <= 2 else 2 if len(colours) <= 4 else 1 if len(colours) <= 16 else 0
        out.put((1, 1), (PALETTE, 2), (len(colours) - 1, 8))
        table = _planes(colours | 255 << 24)
        steps = np.diff(table, axis=0, prepend=np.zeros((1, 4), np.int64)) & 255
        put_pixels(out, steps[:, [2, 1, 3, 0]], False)
        out.put((0, 1))
        per, each = 1 << packed, 8 >> packed
        rows = np.zeros((height, -(-width // per) * per), np.int64)
        rows[:, :width] = index.reshape(height, width)
        green = (rows.reshape(height, -1, per) << (each * np.arange(per))).sum(axis=2).ravel()
        put_pixels(out, np.stack([green, green * 0, green * 0, green * 0 + 255], axis=1), True)
    elif found := repeats(numbers):
        out.put((0, 1))
        put_references(out, np.column_stack([flat[:, [1, 0, 2]], np.full(n, 255, np.uint8)]), found)
    else:
        kind, alpha = _form(rgb), 255
        told = _told(rgb, kind).reshape(-1, 3)
        if kind == "green":
            out.put((1, 1), (SUBTRACT_GREEN, 2))
        elif kind is not None:
            size_bits, alpha = 9, 0
            tiles = -(-width >> size_bits) * -(-height >> size_bits)
            out.put((1, 1), (PREDICTOR, 2), (size_bits - 2, 3))
            put_pixels(out, np.tile(np.array([[kind, 0, 0, 255]], np.uint8), (tiles, 1)), False)
        out.put((0, 1))
        put_pixels(out, np.column_stack([told[:, [1, 0, 2]], np.full(n, alpha, np.uint8)]), True)
    data = out.bytes()
    chunk = b"VP8L" + len(data).to_bytes(4, "little") + data + b"\0" * (len(data) % 2)
    return b"RIFF" + (4 + len(chunk)).to_bytes(4, "little") + b"WEBP" + chunk


def payload(text: str | None) -> tuple[bytes, int]:
    """The text's bytes, padded by spaces to a positive multiple of UNIT, and their number before."""
    data = (text or "").encode()
    return data + b" " * (-len(data) % UNIT or (0 if data else UNIT)), len(data)


def store(data: bytes) -> bytes:
    """Bytes as an image whose rows hold UNIT bytes or a multiple; the last row is filled up with zeros."""
    across = -(-len(data) // (UNIT * SIDE))
    row = UNIT * across
    padded = data + bytes(-len(data) % row)
    return encode(np.frombuffer(padded, np.uint8).reshape(-1, row // 3, 3))


def restore(pixels: np.ndarray, n: int) -> bytes:
    return pixels[:, :, :3].tobytes()[:n]


def feature(pixels: np.ndarray) -> str:
    """Size, mean of the three channels, and the number of different samples."""
    red, green, blue = pixels[:, :, :3].reshape(-1, 3).sum(axis=0, dtype=np.int64).tolist()
    n = pixels.shape[0] * pixels.shape[1]
    return f"{pixels.shape[1]}x{pixels.shape[0]} mean {red / n:.4f} {green / n:.4f} {blue / n:.4f} samples {np.count_nonzero(np.bincount(pixels[:, :, :3].ravel(), minlength=256))}"


def media(docs: DataFrame, keep_media: bool = False, keep_pixels: bool = False) -> DataFrame:
    """Stores every whole text as an image, reads it back, and returns digests and features of what was read.

    With keep_media the file comes too; with keep_pixels the RGB samples, row by row.
    """

    def row(text: str | None) -> tuple:
        data, n = payload(text)
        stored = store(data)
        pixels = decode(stored)
        back = restore(pixels, len(data))
        out = (n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(pixels))
        return out + (stored,) * keep_media + (pixels[:, :, :3].tobytes(),) * keep_pixels

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()] + [pa.binary()] * (keep_media + keep_pixels)
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"] + ["media"] * keep_media + ["pixels"] * keep_pixels

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [row(t.as_py()) for t in batch.column(1)]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    fields = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string" + ", media binary" * keep_media + ", pixels binary" * keep_pixels
    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")), run, fields)
