"""Lossless WebP (VP8L) codec in numpy: a complete decoder and an encoder that fits its stream to the pixels.

The decoder reads the RIFF container and the VP8L bit stream: simple and normal prefix codes, meta prefix
images, length/distance back-references with the two-dimensional distance codes, the colour cache, and the
inverse of the four transforms (predictor, cross-colour, subtract-green, palette with pixel bundling).
Every stream is parsed in full. Images whose codes turn out to be plain 8-bit codes decode with whole-array
operations instead of symbol by symbol.

``encode_bytes`` chooses per image, by estimated size, a transform or none and a colour cache or none, and writes
back-references and Huffman codes; pixels that no code shortens get plain 8-bit codes.

``encode_many`` and ``decode_many`` take many images at a time, whose arrays lie one after the other: what is chosen and
written for an image comes from whole numbers of that image alone, whatever images lie beside it. The decoder takes a symbol
of every image in each step; the few longest ones, and images with meta codes, are read one by one.

Pixels are arrays (height, width, 4) of uint8 in the order R, G, B, A.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np

# Fixed values of the format.
CODE_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
# Distance codes 1..120: (x, y) offsets, nearest first, as the format lists them.
DISTANCE_MAP = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3), (-1, 3),
    (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4),
    (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0), (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2),
    (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1), (2, 6), (-2, 6), (6, 2), (-6, 2),
    (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1),
    (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5),
    (8, 0), (4, 7), (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7),
    (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
CACHE_MULTIPLIER = 0x1E35A7BD
MAX_SIDE = 1 << 14
#: Entries of a table of the first code are below this for pixels, above for lengths and the cache.
LITERALS = 256 << 14
#: Images are read together down to so many; the rest one by one.
FEWEST_LANES = 40
REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))
_R8 = np.frombuffer(REVERSED, dtype=np.uint8).astype(np.int64)
REVERSED_16 = (_R8[:, None] | _R8[None, :] << 8).ravel()


class Bits:
    """Little-endian bit reader over a Python integer window."""

    def __init__(self, data: bytes):
        self.data, self.pos, self.end = data, 0, 8 * len(data)

    def read(self, n: int) -> int:
        if n == 0:
            return 0
        if self.pos + n > self.end:
            raise ValueError("the bit stream ends early")
        first, last = self.pos >> 3, (self.pos + n + 7) >> 3
        value = int.from_bytes(self.data[first:last], "little") >> (self.pos & 7)
        self.pos += n
        return value & ((1 << n) - 1)

    def peek(self, n: int) -> int:
        first, last = self.pos >> 3, (self.pos + n + 7) >> 3
        return (int.from_bytes(self.data[first:last], "little") >> (self.pos & 7)) & ((1 << n) - 1)

    def peek15(self) -> int:
        first = self.pos >> 3
        return (int.from_bytes(self.data[first : first + 3], "little") >> (self.pos & 7)) & 0x7FFF


class Code:
    """Canonical prefix code as a table from the next 15 bits to (symbol, length)."""

    def __init__(self, lengths: bytes):
        self.lengths = lengths
        used = len(lengths) - lengths.count(0)
        size = found = kraft = 0
        while found < used:
            size += 1
            same = lengths.count(size)
            found += same
            kraft += same << 15 - size
        if not used:
            raise ValueError("a prefix code without symbols")
        self.only = next(i for i, n in enumerate(lengths) if n) if used == 1 else None
        self.flat = used == 256 and lengths[:256] == b"\x08" * 256
        self.deepest = 0 if used < 2 else size
        self.table = self.mask = None
        if self.only is None and kraft != 1 << 15:
            raise ValueError("an incomplete prefix code")

    def entries(self, shift: int) -> tuple[list[int], int]:
        """Table from the next bits to symbol << shift + 6 | length, and the mask of the bits that it takes."""
        if self.only is not None:
            return [self.only << shift + 6], 0
        used = sorted((n, i) for i, n in enumerate(self.lengths) if n)
        deepest = self.deepest
        table, code, last = [0] * (1 << deepest), 0, used[0][0]
        for size, symbol in used:
            code <<= size - last
            last = size
            low = (REVERSED[code & 255] << 8 | REVERSED[code >> 8]) >> 16 - size
            table[low :: 1 << size] = [symbol << shift + 6 | size] * (1 << deepest - size)
            code += 1
        return table, (1 << deepest) - 1

    def next(self, bits: Bits) -> int:
        if self.only is not None:
            return self.only
        if self.table is None:
            self.table, self.mask = self.entries(0)
        found = self.table[bits.peek15() & self.mask]
        bits.pos += found & 63
        if bits.pos > bits.end:
            raise ValueError("the bit stream ends early")
        return found >> 6


@lru_cache(maxsize=1 << 12)
def _length_table(of_lengths: bytes) -> tuple[list[tuple[int, int]], int]:
    """Table from the next bits to (length, symbol) of the code for lengths, and its mask."""
    table, mask = Code(of_lengths).entries(0)
    return [(x & 63, x >> 6) for x in table], mask


def _read_code(bits: Bits, alphabet: int) -> Code:
    lengths = bytearray(alphabet)
    if bits.read(1):
        two, wide = bits.read(1), bits.read(1)
        lengths[bits.read(8 if wide else 1)] = 1
        if two:
            lengths[bits.read(8)] = 1
        return Code(lengths)
    of_lengths, n = bytearray(19), 4 + bits.read(4)
    steps = bits.read(3 * n)
    for i in range(n):
        of_lengths[CODE_LENGTH_ORDER[i]] = steps >> 3 * i & 7
    table, mask = _length_table(bytes(of_lengths))
    limit = alphabet
    if bits.read(1):
        limit = 2 + bits.read(2 + 2 * bits.read(3))
    at, before = 0, 8
    data, pos, window, left = bits.data, bits.pos, 0, 0
    for _ in range(limit):
        if left < 14:  # the longest symbol and its extra bits
            pos -= left
            first = pos >> 3
            window, left = int.from_bytes(data[first : first + 24], "little") >> (pos & 7), 192 - (pos & 7)
            pos += left
        took, x = table[window & mask]
        window >>= took
        left -= took
        if x < 16:
            if x:
                lengths[at] = before = x
            at += 1
        else:
            least, extra = ((3, 2), (3, 3), (11, 7))[x - 16]
            times = least + (window & (1 << extra) - 1)
            window >>= extra
            left -= extra
            if at + times > alphabet:
                raise ValueError("code lengths run over")
            if x == 16:
                lengths[at : at + times] = bytes((before,)) * times
            at += times
        if at >= alphabet:
            break
    bits.pos = pos - left
    if bits.pos > bits.end:
        raise ValueError("the bit stream ends early")
    return Code(lengths)


def _prefixed(bits: Bits, symbol: int) -> int:
    """Value of a length or distance prefix symbol."""
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.read(extra) + 1


def _head(bits: Bits, width: int, height: int, top: bool) -> tuple:
    """(groups of codes, meta image or None, its blocks' side, bits of the cache) of an entropy-coded image."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise ValueError("colour cache too large")
    meta, side = None, 0
    groups = 1
    if top and bits.read(1):
        side = 2 + bits.read(3)
        w, h = -(-width >> side), -(-height >> side)
        meta = ((_image(bits, w, h, False) >> 8) & 0xFFFF).astype(np.int64).reshape(h, w)
        groups = int(meta.max()) + 1
    cache_size = 1 << cache_bits if cache_bits else 0
    alphabets = (256 + 24 + cache_size, 256, 256, 256, 40)
    return [[_read_code(bits, a) for a in alphabets] for _ in range(groups)], meta, side, cache_bits


def _body(bits: Bits, head: tuple, width: int, total: int) -> np.ndarray:
    codes, _, _, cache_bits = head
    if len(codes) == 1 and not cache_bits and all(c.flat for c in codes[0][:4]):
        return _plain(bits, total)
    return _symbols(bits, *head, width, total)


def _copy(bits: Bits, symbol: int, distances: Code, width: int, at: int, total: int) -> tuple[int, int]:
    """Length and distance in pixels of a back-reference; symbol: the length's one, which has been read."""
    length = _prefixed(bits, symbol - 256)
    code = _prefixed(bits, distances.next(bits))
    if code > 120:
        back = code - 120
    else:
        x, y = DISTANCE_MAP[code - 1]
        back = max(1, x + y * width)
    if back > at or at + length > total:
        raise ValueError("a back-reference leaves the image")
    return length, back


def _image(bits: Bits, width: int, height: int, top: bool) -> np.ndarray:
    """ARGB pixels (uint32, flat) of an entropy-coded image."""
    return _body(bits, _head(bits, width, height, top), width, width * height)


def _plain(bits: Bits, total: int) -> np.ndarray:
    """Pixels when every sample is an 8-bit code: undo the shift and the bit order of whole arrays."""
    first, shift, n = bits.pos >> 3, bits.pos & 7, 4 * total
    if bits.pos + 8 * n > bits.end:
        raise ValueError("the bit stream ends early")
    raw = bits.data[first : first + n + (shift > 0)]
    if shift:
        raw = ((int.from_bytes(raw, "little") >> shift) & ((1 << 8 * n) - 1)).to_bytes(n, "little")
    bits.pos += 8 * n
    grba = np.frombuffer(raw.translate(REVERSED), dtype=np.uint8).reshape(total, 4)
    argb = np.empty((total, 4), dtype=np.uint8)
    argb[:, 0], argb[:, 1], argb[:, 2], argb[:, 3] = grba[:, 2], grba[:, 0], grba[:, 1], grba[:, 3]
    return argb.view("<u4").ravel()


def _symbols(bits, codes, meta, side, cache_bits, width, total, begun=None) -> np.ndarray:
    """begun: the first pixels and the cache, where these have been read."""
    out, cache = begun or ([], [0] * (1 << cache_bits) if cache_bits else None)
    at = len(out)
    out += [0] * (total - at)
    shift = 32 - cache_bits
    # Symbols stand where the pixel has them, above six bits for the lengths, so that one sum holds a pixel and its bits.
    tables = [[x for code, at in zip(group, (8, 16, 0, 24)) for x in code.entries(at)] for group in codes]
    green, green_mask, red, red_mask, blue, blue_mask, alpha, alpha_mask = tables[0]
    distances = codes[0][4]
    data, pos, literal = bits.data, bits.pos, LITERALS
    window = left = 0

    while at < total:
        if meta is not None:
            group = meta[at // width >> side, at % width >> side]
            green, green_mask, red, red_mask, blue, blue_mask, alpha, alpha_mask = tables[group]
            distances = codes[group][4]
        if left < 60:  # the longest codes of a pixel
            byte = pos >> 3
            window, left = int.from_bytes(data[byte : byte + 32], "little") >> (pos & 7), 256 - (pos & 7)
        g = green[window & green_mask]
        if g < literal:
            window >>= g & 63
            r = red[window & red_mask]
            window >>= r & 63
            b = blue[window & blue_mask]
            window >>= b & 63
            a = alpha[window & alpha_mask]
            window >>= a & 63
            g += r + b + a
            used = g & 63
            pos += used
            left -= used
            pixel = g >> 6
            out[at] = pixel
            if cache is not None:
                cache[((CACHE_MULTIPLIER * pixel) & 0xFFFFFFFF) >> shift] = pixel
            at += 1
            continue
        pos += g & 63
        s = g >> 14
        if s < 280:
            bits.pos = pos
            length, back = _copy(bits, s, distances, width, at, total)
            pos, left = bits.pos, 0
            for k in range(at, at + length):
                pixel = out[k] = out[k - back]
                if cache is not None:
                    cache[((CACHE_MULTIPLIER * pixel) & 0xFFFFFFFF) >> shift] = pixel
            at += length
        else:
            window >>= g & 63
            left -= g & 63
            pixel = cache[s - 280]
            out[at] = pixel
            cache[((CACHE_MULTIPLIER * pixel) & 0xFFFFFFFF) >> shift] = pixel
            at += 1
    if pos > bits.end:
        raise ValueError("the bit stream ends early")
    bits.pos = pos
    return np.array(out, dtype=np.uint32)


def canonical(code: np.ndarray, symbol: np.ndarray, size: np.ndarray, codes: int) -> np.ndarray:
    """Bits as written for every used symbol of many prefix codes; rows in order of code and symbol."""
    group = code * 16 + size
    counts = np.bincount(group, minlength=16 * codes).reshape(codes, 16)
    first = np.zeros_like(counts)
    for k in range(1, 16):
        first[:, k] = first[:, k - 1] + counts[:, k - 1] << 1
    order = np.argsort(group, kind="stable")
    rank = np.empty_like(group)
    rank[order] = np.arange(len(group)) - np.repeat(np.cumsum(counts.ravel()) - counts.ravel(), counts.ravel())
    return REVERSED_16[first.ravel()[group] + rank & 0xFFFF] >> 16 - size


def _tables(codes: list[Code], shifts: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tables of many codes, where each begins, and its mask; shifts: of the codes in turn. Tables of a width lie together."""
    lengths = np.frombuffer(b"".join(c.lengths for c in codes), dtype=np.uint8)
    sizes, deepest = np.array([len(c.lengths) for c in codes]), np.array([c.deepest for c in codes])
    place = np.flatnonzero(lengths)
    code = np.repeat(np.arange(len(codes)), sizes)[place]
    symbol, size = place - (np.cumsum(sizes) - sizes)[code], np.where(deepest[code] > 0, lengths[place], 0)
    order = np.argsort((deepest[code] * len(codes) + code) * 16 + size, kind="stable")
    code, symbol, size = code[order], symbol[order], size[order]
    # In order of the codes' first bits first; the reader's next bit is the lowest.
    table = np.repeat(symbol << np.array(shifts)[code % len(shifts)] + 6 | size, 1 << deepest[code] - size)
    begins, at = np.zeros(len(codes), dtype=np.int64), 0
    for depth in np.unique(deepest).tolist():
        some = np.flatnonzero(deepest == depth)
        begins[some] = at + (np.arange(len(some)) << depth)
        end = at + (len(some) << depth)
        table[at:end] = table[at:end].reshape(len(some), -1).take(REVERSED_16[: 1 << depth] >> 16 - depth, axis=1).ravel()
        at = end
    return table, begins, (1 << deepest) - 1


def _lanes(jobs: list[tuple]) -> list[np.ndarray]:
    """Pixels of images with one group of codes, a symbol of each in every step. jobs: (bits, codes, bits of the cache, width, pixels)."""
    order = sorted(range(len(jobs)), key=lambda i: -jobs[i][4])
    jobs = [jobs[i] for i in order]
    sizes = np.array([len(bits.data) + 16 for bits, *_ in jobs])
    data = np.frombuffer(b"".join(x for bits, *_ in jobs for x in (bits.data, bytes(16))), dtype=np.uint8)
    windows = np.lib.stride_tricks.as_strided(data[:8].view("<i8"), (len(data) - 7,), (1,))
    base = 8 * (np.cumsum(sizes) - sizes)
    pos = base + np.array([bits.pos for bits, *_ in jobs])
    table, begins, masks = _tables([c for _, codes, *_ in jobs for c in codes[:4]], (8, 16, 0, 24))
    begins, masks = (np.ascontiguousarray(x.reshape(-1, 4).T) for x in (begins, masks))
    cache_bits, totals = np.array([j[2] for j in jobs]), np.array([j[4] for j in jobs])
    held = np.cumsum(1 << cache_bits) - (1 << cache_bits)
    cache, out = np.zeros(int((1 << cache_bits).sum()), dtype=np.int64), np.empty(int(totals.sum()), dtype=np.int64)
    # A step's pixels lie together, those of the largest image first.
    width_of = np.searchsorted(-totals, -np.arange(int(totals[0])), "left")
    steps = np.cumsum(width_of) - width_of
    begin = steps.tolist()
    left, back = np.zeros(len(jobs), dtype=np.int64), np.zeros(len(jobs), dtype=np.int64)
    shift, n, at, copying = 32 - cache_bits, len(jobs), 0, 0
    while n >= FEWEST_LANES:
        (b0, b1, b2, b3), (m0, m1, m2, m3) = begins[:, :n], masks[:, :n]
        p, gone, to, off, slot = pos[:n], left[:n], back[:n], shift[:n], held[:n]
        for at in range(at, int(totals[n - 1])):  # noqa: B020 - goes on where the last stretch ended
            w = windows[p >> 3] >> (p & 7)
            g = table.take(b0 + (w & m0))
            w >>= g & 63
            r = table.take(b1 + (w & m1))
            w >>= r & 63
            b = table.take(b2 + (w & m2))
            w >>= b & 63
            pixel = g + r + b + table.take(b3 + (w & m3))
            used = pixel & 63
            pixel >>= 6
            other = (g >= LITERALS).nonzero()[0]
            if copying:
                other = other[gone[other] == 0]
            if len(other):
                symbol = g[other]
                used[other] = symbol & 63
                symbol >>= 14
                cached = symbol >= 280
                some = other[cached]
                pixel[some] = cache[slot[some] + symbol[cached] - 280]
                if len(some) < len(other):
                    for i, s in zip(other[~cached].tolist(), symbol[~cached].tolist()):
                        bits, codes, _, width, total = jobs[i]
                        bits.pos = int(p[i] + used[i] - base[i])
                        gone[i], to[i] = _copy(bits, s, codes[4], width, at, total)
                        p[i], copying = bits.pos + base[i], copying + 1
            if copying:
                some = gone.nonzero()[0]
                pixel[some] = out[steps[at - to[some]] + some]
                used[some] = 0
                gone[some] -= 1
                copying -= int(np.count_nonzero(gone[some] == 0))
            out[begin[at] : begin[at] + n] = pixel
            p += used
            cache[slot + ((pixel * CACHE_MULTIPLIER & 0xFFFFFFFF) >> off)] = pixel
        at = int(totals[n - 1])
        n = int(np.count_nonzero(totals > at))
    found: list = [None] * len(jobs)
    for i, (bits, codes, some, width, total) in enumerate(jobs):
        bits.pos = int(pos[i] - base[i])
        if bits.pos > bits.end:
            raise ValueError("the bit stream ends early")
        done = out.take(steps[: min(at, total)] + i)
        if i < n:
            # A copy that has begun ends first.
            done, kept = done.tolist(), cache[held[i] : held[i] + (1 << some)].tolist()
            for _ in range(int(left[i])):
                pixel = done[-int(back[i])]
                done.append(pixel)
                kept[(CACHE_MULTIPLIER * pixel & 0xFFFFFFFF) >> 32 - some] = pixel
            done = _symbols(bits, [codes], None, 0, some, width, total, (done, kept if some else None))
        found[order[i]] = done.astype(np.uint32)
    return found


# Inverse transforms work on int arrays (height, width, 4) in the order A, R, G, B.
def _average(a, b):
    return (a + b) >> 1


def _select(left, top, corner):
    to_left, to_top = (sum(d[..., k : k + 1] for k in range(4)) for d in (np.abs(top - corner), np.abs(left - corner)))
    return np.where(to_left < to_top, left, top)


def _clamp(x):
    return np.clip(x, 0, 255)


def _half(a, b):
    """a + (a - b) / 2, the division towards zero."""
    d = a - b
    return _clamp(a + np.where(d >= 0, d >> 1, -((-d) >> 1)))


def predict(mode: int, left, top, right, corner):
    """Prediction of one pixel from its neighbours: left, top, top right and top left."""
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
            return _average(_average(left, right), top)
        case 6:
            return _average(left, corner)
        case 7:
            return _average(left, top)
        case 8:
            return _average(corner, top)
        case 9:
            return _average(top, right)
        case 10:
            return _average(_average(left, corner), _average(top, right))
        case 11:
            return _select(left, top, corner)
        case 12:
            return _clamp(left + top - corner)
        case 13:
            return _half(_average(left, top), corner)
        case _:
            return np.array((255, 0, 0, 0))


def _modes(data: np.ndarray, x: int, y: int, side: int) -> int:
    if y == 0:
        return 1 if x else 0
    return 2 if x == 0 else int(data[y >> side, x >> side, 2]) & 15


def unpredict(image: np.ndarray, data: np.ndarray, side: int, forward: bool = False) -> np.ndarray:
    """Adds (or with forward subtracts) predictions. The pixel right of the last column is the next row's first."""
    height, width, _ = image.shape
    out = image.astype(np.int64).copy()
    known = image.astype(np.int64) if forward else out
    for y in range(height):
        for x in range(width):
            left = known[y, x - 1] if x else None
            top = known[y - 1, x] if y else None
            corner = known[y - 1, x - 1] if x and y else None
            right = (known[y - 1, x + 1] if x + 1 < width else known[y, 0]) if y else None
            p = predict(_modes(data, x, y, side), left, top, right, corner)
            out[y, x] = (out[y, x] - p if forward else out[y, x] + p) & 255
    return out


def _signed(x):
    return np.where(x > 127, x - 256, x)


def uncross(image: np.ndarray, data: np.ndarray, side: int, forward: bool = False) -> np.ndarray:
    """Cross-colour transform: data holds per block red_to_blue, green_to_blue, green_to_red in R, G, B."""
    height, width, _ = image.shape
    out = image.astype(np.int64).copy()
    block = data[(np.arange(height) >> side)[:, None], np.arange(width) >> side].astype(np.int64)
    red_blue, green_blue, green_red = (_signed(block[..., k]) for k in (1, 2, 3))
    green = _signed(out[..., 2])
    sign = -1 if forward else 1
    red = (out[..., 1] + sign * ((green_red * green) >> 5)) & 255
    base = _signed(out[..., 1] if forward else red)
    blue = (out[..., 3] + sign * (((green_blue * green) >> 5) + ((red_blue * base) >> 5))) & 255
    out[..., 1], out[..., 3] = red, blue
    return out


def _split(argb: np.ndarray, width: int, height: int) -> np.ndarray:
    return argb.astype("<u4").view(np.uint8).reshape(height, width, 4)[..., ::-1].astype(np.int64)


def _opened(data: bytes) -> tuple:
    """(bits, width, height, transforms, width as coded) of a stream, read up to its image."""
    if not data or data[0] != 0x2F:
        raise ValueError("no VP8L signature")
    bits = Bits(data[1:])
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)  # alpha is used: a hint only
    if bits.read(3):
        raise ValueError("unknown version")
    transforms, coded = [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind in [k for k, *_ in transforms]:
            raise ValueError("a transform is used twice")
        if kind in (0, 1):
            side = 2 + bits.read(3)
            w, h = -(-coded >> side), -(-height >> side)
            transforms.append((kind, coded, side, _split(_image(bits, w, h, False), w, h)))
        elif kind == 2:
            transforms.append((kind, coded, 0, None))
        else:
            n = bits.read(8) + 1
            steps = _split(_image(bits, n, 1, False), n, 1)[0]
            bundle = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            transforms.append((kind, coded, bundle, np.cumsum(steps, 0) & 255))
            coded = -(-coded >> bundle)
    return bits, width, height, transforms, coded


def _restored(argb: np.ndarray, width: int, height: int, transforms: list, coded: int) -> np.ndarray:
    """Pixels from what the image codes: the transforms undone."""
    if not transforms:
        return argb.astype("<u4").view(np.uint8).reshape(height, width, 4)[..., [2, 1, 0, 3]]
    image = _split(argb, coded, height)
    for kind, wide, side, extra in reversed(transforms):
        if kind == 0:
            image = unpredict(image, extra, side)
        elif kind == 1:
            image = uncross(image, extra, side)
        elif kind == 2:
            image[..., 1] = (image[..., 1] + image[..., 2]) & 255
            image[..., 3] = (image[..., 3] + image[..., 2]) & 255
        else:
            per, width_bits = 1 << side, 8 >> side
            index = np.repeat(image[..., 2], per, 1)[:, :wide]
            index = (index >> ((np.arange(wide) % per) * width_bits)) & ((1 << width_bits) - 1)
            palette = np.vstack([extra, np.zeros((256 - len(extra), 4), dtype=np.int64)])
            image = palette[index]
    return image[..., [1, 2, 3, 0]].astype(np.uint8)


def decode_vp8l(data: bytes) -> np.ndarray:
    bits, width, height, transforms, coded = _opened(data)
    return _restored(_image(bits, coded, height, True), width, height, transforms, coded)


def _stream(data: bytes) -> bytes:
    """The VP8L stream of a WebP file; other chunks are skipped."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise ValueError("no WebP file")
    at, end = 12, min(len(data), 8 + struct.unpack("<I", data[4:8])[0])
    while at + 8 <= end:
        size = struct.unpack("<I", data[at + 4 : at + 8])[0]
        if data[at : at + 4] == b"VP8L":
            return data[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no lossless image in the file")


def decode(data: bytes) -> np.ndarray:
    """Pixels of a WebP file that holds a lossless image."""
    return decode_vp8l(_stream(data))


def decode_all(files: list[bytes]) -> list[np.ndarray]:
    """Pixels of every file, as decode has them."""
    opened, jobs, images = [], [], []
    for data in files:
        bits, width, height, transforms, coded = _opened(_stream(data))
        head = codes, meta, _, cache_bits = _head(bits, coded, height, True)
        # A window holds 57 bits at least.
        together = meta is None and not all(c.flat for c in codes[0][:4]) and sum(c.deepest for c in codes[0][:4]) <= 57
        argb = None if together else _body(bits, head, coded, coded * height)
        if together:
            jobs.append((bits, codes[0], cache_bits, coded, coded * height))
        opened.append((argb, width, height, transforms, coded))
    done = iter(_lanes(jobs) if jobs else ())
    for argb, *rest in opened:
        images.append(_restored(next(done) if argb is None else argb, *rest))
    return images


class Writer:
    """Bit writer, first bit lowest."""

    def __init__(self):
        self.value, self.size = 0, 0

    def put(self, value: int, n: int):
        self.value |= value << self.size
        self.size += n

    def bytes(self) -> bytes:
        return self.value.to_bytes((self.size + 7) // 8, "little")


def _headers(lengths: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, bits as written, their count) of the fields that write many prefix codes, whose lengths lie one after the other.

    A code of one symbol below 256 is a simple one. Else runs of lengths are written by 16 (repeats the last non-zero length), 17 and 18 (zeros),
    in a fixed-width code for the kinds of runs, filled up with unused kinds so that it is complete."""
    codes, ends = len(sizes), np.cumsum(sizes)
    begins = ends - sizes
    used = np.add.reduceat((lengths > 0).astype(np.int64), begins)
    place = np.flatnonzero(lengths)
    only = place[np.searchsorted(place, begins)] - begins
    simple = (used == 1) & (only < 256)
    starts = np.concatenate(([True], lengths[1:] != lengths[:-1]))
    starts[begins] = True
    starts = np.flatnonzero(starts)
    code, size, run = np.searchsorted(ends, starts, "right"), lengths[starts], np.diff(np.append(starts, len(lengths)))
    keep = ~simple[code]
    code, size, run = code[keep], size[keep], run[keep]
    filled = np.flatnonzero(size)
    before = np.full(len(size), 8)
    if len(filled):
        before[filled[1:]] = np.where(code[filled[1:]] == code[filled[:-1]], size[filled[:-1]], 8)
    alone = ((size > 0) & (size != before)).astype(np.int64)
    most = np.where(size > 0, 6, 138)
    full, rest = np.divmod(run - alone, most)
    times = alone + full + np.where(rest < 3, rest, 1)
    nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    code, size, alone, full, rest = (np.repeat(x, times) for x in (code, size, alone, full, rest))
    whole = (nth >= alone) & (nth < alone + full)
    copied = whole | ((nth >= alone + full) & (rest >= 3))
    took = np.where(whole, np.where(size > 0, 6, 138), rest)
    kind = np.where(copied, np.where(size > 0, 16, np.where(took >= 11, 18, 17)), size)
    extra = np.where(copied, took - np.where(kind == 18, 11, 3), 0)
    extra_bits = np.array([0] * 16 + [2, 3, 7])[kind]
    kinds = np.bincount(code * 19 + kind, minlength=19 * codes).reshape(codes, 19) > 0
    count = kinds.sum(1)
    depth = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64)
    kinds |= ~kinds & (np.cumsum(~kinds, 1) <= ((1 << depth) - count)[:, None])
    rank = np.cumsum(kinds, 1) - 1
    of_lengths = np.where(kinds, np.maximum(depth, 1)[:, None], 0)[:, list(CODE_LENGTH_ORDER)]
    last = np.maximum(4, 19 - np.argmax(of_lengths[:, ::-1] > 0, 1))
    head = last - 4 << 1 | (of_lengths << 5 + 3 * np.arange(19)).sum(1)
    head_bits = 6 + 3 * last
    head[simple], head_bits[simple] = 0b101 | only[simple] << 3, 11
    width = depth[code]
    value = REVERSED_16[rank[code, kind]] >> 16 - width | extra << width
    all_codes = np.concatenate((np.arange(codes), code))
    order = np.argsort(all_codes, kind="stable")
    return all_codes[order], np.concatenate((head, value))[order], np.concatenate((head_bits, width + extra_bits))[order]


def _written(lengths: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits as written and their count for every symbol of many codes; the only symbol of a code takes none."""
    place = np.flatnonzero(lengths)
    code = np.repeat(np.arange(len(sizes)), sizes)[place]
    bits, counts = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    single = (np.bincount(code, minlength=len(sizes)) == 1)[code]
    size = lengths[place]
    bits[place] = np.where(single, 0, canonical(code, place, size, len(sizes)))
    counts[place] = np.where(single, 0, size)
    return bits, counts


def put_code(out: Writer, lengths: list[int]) -> dict[int, tuple[int, int]]:
    """Writes a prefix code and returns symbol -> (bits as written, count)."""
    lengths, sizes = np.array(lengths), np.array([len(lengths)])
    for value, n in zip(*(x.tolist() for x in _headers(lengths, sizes)[1:])):
        out.put(value, n)
    bits, counts = _written(lengths, sizes)
    return {i: (int(bits[i]), int(counts[i])) for i in np.flatnonzero(lengths).tolist()}


def riff(stream: bytes) -> bytes:
    body = stream + b"\0" * (len(stream) & 1)
    return b"RIFF" + struct.pack("<I", 12 + len(body)) + b"WEBPVP8L" + struct.pack("<I", len(stream)) + body


def _plain_head() -> tuple[int, int]:
    """Bits between the image's size and its pixels for the plain form: no transform, no cache, no meta codes,
    four codes of 8 bits and a distance code of one symbol."""
    out = Writer()
    out.put(1, 1)
    out.put(0, 3)
    out.put(0, 3)
    put_code(out, [8] * 256 + [0] * 24)
    for _ in range(3):
        put_code(out, [8] * 256)
    put_code(out, [1] + [0] * 39)
    return out.value, out.size


PLAIN_HEAD = _plain_head()
ROW = 64
TILE = ROW * MAX_SIDE
#: The writer's longest code; the format has 15, but a reader's table doubles with each bit.
DEEPEST = 11
SHORTEST_COPY, LONGEST_COPY = 3, 4096
#: Estimated sizes are whole numbers of 1 / BIT bits.
BIT = 1 << 12
#: Images are encoded together up to so many bytes.
TOGETHER = 128 << 10
#: Predictors that the writer tries, each for the whole image: left and top, and those made of both. The latter are tried where
#: one of the former or subtract-green comes within an eighth of the plain size.
TRIED = (1, 2, 7, 11, 12)
#: The cross-colour step is tried where a channel explains this share of what varies in another one.
TOLD = 1 / 16


def _code_lengths(w: list[int], symbols: list[int]) -> list[int]:
    """Huffman code lengths of at most DEEPEST bits for positive counts in ascending order, of equal ones by symbol; counts are halved until the tree is flat enough."""
    n = len(w)
    if n == 1:
        return [1]
    leaves, made, parent = [*w, 1 << 62], [], [0] * (2 * n - 1)
    leaf, inner, least = 0, n, w[0]
    for node in range(n, 2 * n - 1):
        if inner == node or least <= made[inner - n]:
            total = least
            parent[leaf] = node
            leaf += 1
            least = leaves[leaf]
        else:
            total = made[inner - n]
            parent[inner] = node
            inner += 1
        if inner == node or least <= made[inner - n]:
            total += least
            parent[leaf] = node
            leaf += 1
            least = leaves[leaf]
        else:
            total += made[inner - n]
            parent[inner] = node
            inner += 1
        made.append(total)
    depth = [0] * (2 * n - 1)
    for node in range(2 * n - 3, -1, -1):
        depth[node] = depth[parent[node]] + 1
    if depth[0] <= DEEPEST:
        return depth[:n]
    w = [c + 1 >> 1 for c in w]
    order = sorted(range(n), key=lambda i: (w[i], symbols[i]))
    lengths = _code_lengths([w[i] for i in order], [symbols[i] for i in order])
    return [size for _, size in sorted(zip(order, lengths))]


def code_lengths(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Code lengths of many codes whose counts lie one after the other; a code without counts gets one symbol."""
    begins = np.cumsum(sizes) - sizes
    counts = counts.copy()
    counts[begins[np.add.reduceat(counts, begins) == 0]] = 1
    place = np.flatnonzero(counts)
    ends = np.searchsorted(place, begins + sizes)
    code = np.repeat(np.arange(len(sizes)), np.diff(ends, prepend=0))
    place = place[np.argsort(code << 32 | counts[place], kind="stable")]
    given, symbols, found, at = counts[place].tolist(), place.tolist(), [], 0
    for end in ends.tolist():
        found += _code_lengths(given[at:end], symbols[at:end])
        at = end
    lengths = np.zeros(len(counts), dtype=np.int64)
    lengths[place] = found
    return lengths


def _prefixes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, extra values, extra bits) of lengths or distances."""
    v = values - 1
    top = np.frexp(np.maximum(v, 1).astype(float))[1].astype(np.int64) - 1
    extra = np.maximum(top - 1, 0)
    few = v < 4
    return np.where(few, v, 2 * top + ((v >> extra) & 1)), np.where(few, 0, v & ((1 << extra) - 1)), np.where(few, 0, extra)


def _logs(most: int, known: list = []) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006 - grows to the largest number
    """n * log2(n) in BIT-ths for every n up to most, and that less what a used symbol takes; whole numbers, whose sums do not depend on any order."""
    if not known or len(known[0]) <= most:
        n = np.arange(max(most + 1, 1 << 13))
        logs = np.round(n * np.log2(np.maximum(n, 1)) * BIT).astype(np.int64)
        known[:] = logs, logs - 4 * BIT * (n > 0)
    return known[0], known[1]


def _sizes(counts: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Bits that codes for these counts take, about, the codes themselves included, in BIT-ths. Codes lie one after the other."""
    totals = np.add.reduceat(counts, begins)
    logs, used = _logs(int(totals.max()))
    return logs[totals] - np.add.reduceat(used.take(counts), begins)


def _channels(samples: np.ndarray, image: np.ndarray, images: int) -> np.ndarray:
    """Size by the four channels' counts for every image. samples: rows of pixels of uint8; image: a row's one."""
    counts = np.bincount((samples + ((image * 1024)[:, None] + np.arange(0, 1024, 256))[:, None]).ravel(), minlength=1024 * images).reshape(images, 1024)
    totals = counts[:, :256].sum(1)
    logs, used = _logs(int(totals.max()))
    return 4 * logs[totals] - used.take(counts).sum(1)


def _copies(pixels: np.ndarray, stream: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, distance), greedily in each stream: three pixels or more that the latest like place before also has."""
    n = len(pixels) - SHORTEST_COPY + 1
    if n < 2:
        return []
    p = pixels.astype(np.uint64)
    key = p[:n] * np.uint64(0x9E3779B97F4A7C15) + p[1 : n + 1] * np.uint64(0xC2B2AE3D27D4EB4F) + p[2 : n + 2] * np.uint64(0x165667B19E3779F9)
    key += stream[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    # The upper bits of the key above the place: sorting numbers takes less than ordering them.
    wide = np.uint64(n.bit_length())
    held = np.sort(key >> wide << wide | np.arange(n, dtype=np.uint64))
    order, held = (held & (np.uint64(1) << wide) - np.uint64(1)).astype(np.int64), held >> wide
    same = held[1:] == held[:-1]
    like = np.full(n, -1)
    like[order[1:][same]] = order[:-1][same]
    places = np.flatnonzero(like >= 0)
    places = places[stream[places] == stream[like[places]]]
    found, at = [], 0
    for i, j, end in zip(places.tolist(), like[places].tolist(), ends[stream[places]].tolist()):
        if i < at:
            continue
        part = pixels[i : min(i + LONGEST_COPY, end)]
        other = part != pixels[j : j + len(part)]
        length = int(other.argmax()) if other.any() else len(part)
        if length >= SHORTEST_COPY:
            found.append((i, length, i - j))
            at = i + length
    return found


def _near(width: int, known: dict = {}) -> dict[int, int]:  # noqa: B006 - filled once a width
    if width not in known:
        known[width] = {}
        for code, (x, y) in enumerate(DISTANCE_MAP, 1):
            known[width].setdefault(max(1, x + y * width), code)
    return known[width]


def _colours(pixels: np.ndarray, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stream, pixel, count) of every stream's different pixels, in order."""
    held = np.sort(stream << 32 | pixels)
    new = np.flatnonzero(np.concatenate(([True], held[1:] != held[:-1])))
    return held[new] >> 32, held[new] & 0xFFFFFFFF, np.diff(np.append(new, len(held)))


def _joined_fields(order: np.ndarray, values: np.ndarray, counts: np.ndarray, streams: int) -> list[tuple[bytes, int]]:
    """(bytes, bits) of every stream from fields of up to 63 bits. order: stream * 32 + place in it; every stream begins a word."""
    by_order = np.argsort(order, kind="stable")
    stream, values, counts = order[by_order] >> 5, values[by_order].astype(np.uint64), counts[by_order]
    total = np.zeros(streams, dtype=np.int64)
    ends = np.cumsum(counts)
    last = np.searchsorted(stream, np.arange(streams), "right")
    upto = np.concatenate(([0], ends))[last]
    total = np.diff(upto, prepend=0)
    words = total + 63 >> 6
    first = np.cumsum(words) - words
    at = ends - counts - (upto - total)[stream] + (first << 6)[stream]
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    out = np.zeros(int(words.sum()) + 1, dtype=np.uint64)
    starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    out[word[starts]] = np.bitwise_or.reduceat(values << shift, starts)
    over = np.flatnonzero((at & 63) + counts > 64)
    out[word[over] + 1] |= values[over] >> (np.uint64(64) - shift[over])
    data = out.astype("<u8").tobytes()
    return [(data[8 * f : 8 * f + (n + 7 >> 3)], n) for f, n in zip(first.tolist(), total.tolist())]


def put_pixels(images: list[tuple[int, int, np.ndarray, int, bool]]) -> list[tuple[bytes, int]]:
    """(bytes, bits) of entropy-coded images with one group of codes. images: bits before and their count, flat ARGB pixels, width, top."""
    n = len(images)
    sizes = np.array([len(x[2]) for x in images])
    ends = np.cumsum(sizes)
    pixels = np.concatenate([x[2] for x in images]).astype(np.int64)
    stream = np.repeat(np.arange(n), sizes)
    copies = _copies(pixels, stream, ends)
    start, length, back = (np.array(x, dtype=np.int64) for x in (zip(*copies) if copies else ((), (), ())))
    owner = stream[start]
    distance = np.array([_near(images[k][3]).get(d, d + 120) for k, d in zip(owner.tolist(), back.tolist())], dtype=np.int64)
    copied = np.zeros(len(pixels) + 1, dtype=np.int64)
    copied[start] += 1
    np.subtract.at(copied, start + length, 1)
    alone = np.flatnonzero(np.cumsum(copied)[:-1] == 0)
    lone = stream[alone]
    held = pixels[alone]
    samples = [held >> k & 255 for k in (8, 16, 0, 24)]
    (length_symbol, length_extra, length_bits), (symbol, extra, extra_bits) = _prefixes(length), _prefixes(distance)

    def counted(bits, hit, key):
        """Counts of all codes, where each begins, and each image's size. bits: of every image's cache; hit: the pixels alone that it has."""
        alphabets = np.stack([280 + np.where(bits > 0, 1 << bits, 0), *(np.full(n, x) for x in (256, 256, 256, 40))], 1)
        begins = (np.cumsum(alphabets) - alphabets.ravel()).reshape(n, 5)
        green = begins[lone, 0] + np.where(hit, 280 + key, samples[0])
        rest = np.flatnonzero(~hit)
        some = lone[rest]
        places = [green, *(begins[some, k] + samples[k][rest] for k in (1, 2, 3)), begins[owner, 0] + 256 + length_symbol, begins[owner, 4] + symbol]
        counts = np.bincount(np.concatenate(places), minlength=int(alphabets.sum()))
        return counts, begins, alphabets.ravel(), _sizes(counts, begins.ravel()).reshape(n, 5)[:, :4].sum(1), green

    # The cache: of pixels with the same key the one before is held; an unused place holds 0.
    tried = np.clip(np.ceil(np.log2(np.bincount(_colours(pixels, stream)[0], minlength=n))).astype(np.int64), 1, 10)
    tried[np.bincount(lone, minlength=n) < 2] = 0
    key = (pixels * CACHE_MULTIPLIER & 0xFFFFFFFF) >> 32 - tried[stream]
    wide = len(pixels).bit_length()
    order = np.sort((stream << 10 | key) << wide | np.arange(len(pixels)))
    group, order = order >> wide, order & (1 << wide) - 1
    before = np.zeros_like(pixels)
    before[order[1:]] = np.where(group[1:] == group[:-1], pixels[order[:-1]], 0)
    hit, key = ((before == pixels) & (tried > 0)[stream])[alone], key[alone]
    without, with_cache = counted(np.zeros(n, dtype=np.int64), np.zeros(len(alone), dtype=bool), key), counted(tried, hit, key)
    bits = np.where(with_cache[3] < without[3], tried, 0)
    hit &= (bits > 0)[lone]
    counts, begins, alphabets, _, green = counted(bits, hit, key)
    lengths = code_lengths(counts, alphabets)
    code_of, head, head_bits = _headers(lengths, alphabets)
    written, taken = _written(lengths, alphabets)
    # A field per pixel or copy.
    value, count = written[green], taken[green]
    for k in (1, 2, 3):
        place = begins[lone, k] + samples[k]
        value |= np.where(hit, 0, written[place]) << count
        count = count + np.where(hit, 0, taken[place])
    at, to = begins[owner, 0] + 256 + length_symbol, begins[owner, 4] + symbol
    pair, pair_count = written[at], taken[at]
    for x, m in ((length_extra, length_bits), (written[to], taken[to]), (extra, extra_bits)):
        pair = pair | x << pair_count
        pair_count = pair_count + m
    by_place = np.argsort(np.concatenate((alone, start)), kind="stable")
    fields = [(np.concatenate((lone, owner))[by_place] * 32 + 9, np.concatenate((value, pair))[by_place], np.concatenate((count, pair_count))[by_place])]
    fields.append((code_of // 5 * 32 + 2 + code_of % 5, head, head_bits))
    top = np.array([x[4] for x in images], dtype=np.int64)
    fields.append((np.arange(n) * 32 + 1, np.where(bits > 0, 1 | bits << 1, 0), np.where(bits > 0, 5, 1) + top))
    parts = [(k, value >> at & 0xFFFFFFFF, min(32, count - at)) for k, (value, count, *_) in enumerate(images) for at in range(0, count, 32)]
    if parts:
        owner, value, count = (np.array(x, dtype=np.int64) for x in zip(*parts))
        fields.append((owner * 32, value, count))
    return _joined_fields(*(np.concatenate(x) for x in zip(*fields)), n)


def _joined(image: np.ndarray) -> np.ndarray:
    """Flat uint32 ARGB of an int array in the order A, R, G, B."""
    return np.ascontiguousarray(image[..., ::-1].astype(np.uint8)).view("<u4").ravel()


def _residuals(image: np.ndarray, first: np.ndarray, modes: tuple[int, ...]):
    """(mode, what unpredict undoes when every block has it) for every mode; whole arrays of uint8, since the encoder knows all pixels.

    first: images' first rows."""
    edges = image.copy()
    edges[:, 1:] -= image[:, :-1]
    edges[1:, 0] -= image[:-1, 0]
    edges[first, 0] = image[first, 0] - np.array((255, 0, 0, 0), dtype=np.uint8)
    wide = image.astype(np.int16) if max(modes) > 2 else None
    for mode in modes:
        out = edges.copy() if mode > 1 else edges
        if mode == 2:
            np.subtract(image[1:, 1:], image[:-1, 1:], out=out[1:, 1:])
        elif mode > 2:
            left, top, corner = wide[1:, :-1], wide[:-1, 1:], wide[:-1, :-1]
            right = np.concatenate((wide[:-1, 2:], wide[1:, :1]), 1) if mode in (3, 5, 9, 10) else None
            np.subtract(image[1:, 1:], predict(mode, left, top, right, corner).astype(np.uint8), out=out[1:, 1:])
        if mode > 1:
            out[first, 1:] = edges[first, 1:]
        yield mode, out


def _slopes(samples: tuple[np.ndarray, ...], begins: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares slopes of blue on red, blue on green and red on green in 32nds for every image, as the cross-colour transform has them,
    and whether any of them explains ``TOLD`` of what varies. samples: rows of red, green and blue."""
    red, green, blue = samples
    total = [np.add.reduceat(x.sum(1), begins) for x in samples]
    across = lambda x, y: np.add.reduceat(np.einsum("ij,ij->i", x, y), begins, dtype=np.int64)
    vary = [n * across(x, x) - t * t for x, t in zip(samples, total)]
    slopes, telling = [], np.zeros(len(n), dtype=bool)
    for x, y in ((0, 2), (1, 2), (1, 0)):
        both = n * across(samples[x], samples[y]) - total[x] * total[y]
        slopes.append(np.where(vary[x] > 0, np.clip(np.round(32 * both / np.maximum(vary[x], 1)), -128, 127), 0).astype(np.int64))
        telling |= both.astype(float) ** 2 > TOLD * vary[x].astype(float) * vary[y]
    return np.stack(slopes, 1), telling


def _palette(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the palette, and the packed indices of an image of at most 256 colours."""
    colours, index = np.unique(_joined(image), return_inverse=True)
    height, width, _ = image.shape
    bundle = 3 if len(colours) <= 2 else 2 if len(colours) <= 4 else 1 if len(colours) <= 16 else 0
    per, bits = 1 << bundle, 8 >> bundle
    index = np.pad(index.reshape(height, width), ((0, 0), (0, -width % per)))
    packed = np.zeros((height, index.shape[1] // per, 4), dtype=np.int64)
    packed[..., 0] = 255
    for k in range(per):
        packed[..., 2] |= index[:, k::per] << k * bits
    return np.diff(_split(colours, len(colours), 1)[0], axis=0, prepend=0) & 255, packed


def _palette_sizes(image: np.ndarray, owner: np.ndarray, images: int) -> dict[int, int]:
    """Size with a palette of every image that has at most 256 colours."""
    stream, colour, count = _colours(_joined(image).astype(np.int64), np.repeat(owner, image.shape[1]))
    number = np.bincount(stream, minlength=images)
    few = number[stream] <= 256
    stream, colour, count = stream[few], colour[few], count[few]
    some, begins, which = np.unique(stream, return_index=True, return_inverse=True)
    if not len(some):
        return {}
    samples = _split(colour, len(colour), 1)[0]
    steps = np.diff(samples, axis=0, prepend=0)
    steps[begins] = samples[begins]
    # One index a pixel: its codes are the colours' counts, those of the other channels hold one symbol.
    sizes = _channels((steps & 255)[:, None], which, len(some)) + _sizes(count, begins) + (64 + 3 * 4) * BIT
    found = dict(zip(some.tolist(), sizes.tolist()))
    for k in some[number[some] <= 16].tolist():
        found[k] = 64 * BIT + sum(int(_channels(x.reshape(-1, 1, 4), np.zeros(x.size // 4, dtype=np.int64), 1)[0]) for x in _palette(image[owner == k]))
    return found


def _forms(image: np.ndarray, rows: np.ndarray) -> list[tuple]:
    """(transform or None, its data, pixels to code) for every image: of the forms that the writer tries the one of least estimated size.

    image: uint8 in the order A, R, G, B, the images' rows one after the other; rows: their numbers."""
    n, first = len(rows), np.cumsum(rows) - rows
    owner = np.repeat(np.arange(n), rows)
    tried = [(None, None, image, first)]
    best, which = _channels(image, owner, n), np.zeros(n, dtype=np.int64)
    plain, every = best, np.arange(n)

    def offer(kind, data, coded, more, some):
        """data and more: of the images ``some``, whose rows ``coded`` holds."""
        size = _channels(coded, np.repeat(np.arange(len(some)), rows[some]), len(some)) + more * BIT
        less = size < best[some]
        which[some] = np.where(less, len(tried), which[some])
        best[some] = np.minimum(size, best[some])
        at = np.zeros(n, dtype=np.int64)
        at[some] = np.cumsum(rows[some]) - rows[some]
        tried.append((kind, data and dict(zip(some.tolist(), data)), coded, at))
        return size

    best = best.copy()
    green = image.copy()
    green[..., [1, 3]] -= image[..., 2:3]
    least = offer(2, None, green, 3, every)
    for mode, rest in _residuals(image, first, TRIED[:2]):
        least = np.minimum(least, offer(0, [(0, 0, mode, 0)] * n, rest, 64, every))
    some = np.flatnonzero(least * 8 <= plain * 9)
    if len(some):
        part = image[np.isin(owner, some)] if len(some) < n else image
        for mode, rest in _residuals(part, np.cumsum(rows[some]) - rows[some], TRIED[2:]):
            offer(0, [(0, 0, mode, 0)] * len(some), rest, 64, some)
    signed = tuple(image[..., k].astype(np.int8).astype(np.int32) for k in (1, 2, 3))
    steps, telling = _slopes(signed, first, 16 * rows)
    some = np.flatnonzero(telling & steps.any(1))
    if len(some):
        mine = np.isin(owner, some)
        red, green, blue = (x[mine] for x in signed)
        red_blue, green_blue, green_red = (steps[owner[mine], k][:, None] for k in range(3))
        crossed = image[mine]
        crossed[..., 1] -= (green_red * green >> 5).astype(np.uint8)
        crossed[..., 3] -= ((green_blue * green >> 5) + (red_blue * red >> 5)).astype(np.uint8)
        offer(1, [(0, *(x & 255 for x in steps[k].tolist())) for k in some.tolist()], crossed, 64, some)
    chosen = []
    with_palette = _palette_sizes(image, owner, n)
    for k, (at, height, form) in enumerate(zip(first.tolist(), rows.tolist(), which.tolist())):
        kind, data, coded, begins = tried[form]
        begin = int(begins[k])
        chosen.append((kind, data and data[k], coded[begin : begin + height]))
        if k in with_palette and with_palette[k] < best[k]:
            chosen[-1] = 3, *_palette(image[at : at + height])
    return chosen


def encode_images(parts: list[bytes]) -> list[bytes]:
    """VP8L streams of parts of up to TILE bytes as images 16 pixels wide."""
    rows = np.array([len(x) // ROW for x in parts])
    image = np.frombuffer(b"".join(parts), dtype=np.uint8).reshape(-1, ROW // 4, 4)[..., [3, 1, 0, 2]]
    forms = _forms(image, rows)
    extra = [(k, 0, 0, _joined(data), len(data), False) if kind == 3 else (k, 0, 0, np.repeat(_joined(np.array(data)), -(-int(rows[k]) >> 9)), 1, False) for k, (kind, data, _) in enumerate(forms) if kind not in (None, 2)]
    written = dict(zip((x[0] for x in extra), put_pixels([x[1:] for x in extra]))) if extra else {}
    images = []
    for k, (kind, data, coded) in enumerate(forms):
        out = Writer()
        out.put(ROW // 4 - 1 | int(rows[k]) - 1 << 14, 28)
        out.put(1, 1)
        out.put(0, 3)
        if kind is not None:
            out.put(1 | kind << 1, 3)
            if kind == 3:
                out.put(len(data) - 1, 8)
            elif kind != 2:
                out.put(7, 3)  # blocks of 512 pixels
            if k in written:
                out.put(int.from_bytes(written[k][0], "little"), written[k][1])
        out.put(0, 1)
        images.append((out.value, out.size, _joined(coded), coded.shape[1], True))
    plain, size = PLAIN_HEAD
    streams = []
    for part, height, (data, n) in zip(parts, rows.tolist(), put_pixels(images)):
        if n > 28 + size + 8 * len(part):
            head = (ROW // 4 - 1) | (height - 1) << 14 | plain << 28
            whole, shift = divmod(size + 28, 8)
            first = (head & ((1 << 8 * whole) - 1)).to_bytes(whole, "little")
            rest = head >> 8 * whole | int.from_bytes(part.translate(REVERSED), "little") << shift
            data = first + rest.to_bytes(len(part) + (shift > 0), "little")
        streams.append(b"\x2f" + data)
    return streams


def encode_many(payloads: list[bytes]) -> list[bytes]:
    """encode_bytes of every payload; images are made together up to TOGETHER bytes."""
    if any(not x or len(x) % ROW for x in payloads):
        raise ValueError("the payload must be a positive multiple of 64 bytes")
    media, parts, room = [b""] * len(payloads), [], 0

    def flush():
        for (k, _), stream in zip(parts, encode_images([x for _, x in parts]) if parts else ()):
            media[k] += riff(stream)
        parts.clear()

    for k, payload in enumerate(payloads):
        for at in range(0, len(payload), TILE):
            part = payload[at : at + TILE]
            if len(part) > room:
                flush()
                room = TOGETHER
            parts.append((k, part))
            room -= len(part)
    flush()
    return media


def encode_bytes(payload: bytes) -> bytes:
    """A payload of a positive multiple of 64 bytes as one or more images 16 pixels wide, one after the other.

    Four bytes make a pixel: its samples in the order G, R, B, A, as the payload's bytes come."""
    return encode_many([payload])[0]


def _files(media: bytes) -> list[bytes]:
    at, files = 0, []
    while at < len(media):
        size = 8 + struct.unpack("<I", media[at + 4 : at + 8])[0]
        files.append(media[at : at + size])
        at += size
    return files


def decode_bytes(media: bytes) -> tuple[bytes, list[np.ndarray]]:
    """The payload and the pixel arrays of what encode_bytes wrote."""
    return decode_many([media])[0]


def decode_many(media: list[bytes]) -> list[tuple[bytes, list[np.ndarray]]]:
    """decode_bytes of every value."""
    files = [_files(m) for m in media]
    done = iter(decode_all([f for some in files for f in some]))
    found = [[next(done) for _ in some] for some in files]
    return [(b"".join(x[..., [1, 0, 2, 3]].tobytes() for x in images), images) for images in found]
