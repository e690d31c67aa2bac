"""Round trips of the WebP codec: every feature of the bit stream is written by a small test encoder."""

import numpy as np
import pytest

from lodestack.llm import media, webp


def huffman(counts):
    """Code lengths (at most 14) of a Huffman code over the used symbols."""
    import heapq

    heap = [(c, i, (i,)) for i, c in enumerate(counts) if c]
    lengths = [0] * len(counts)
    if len(heap) == 1:
        lengths[heap[0][1]] = 1
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for s in a[2] + b[2]:
            lengths[s] += 1
        heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
    assert max(lengths) <= 14
    return lengths


def prefix(value):
    """(symbol, extra bits, count) of a length or distance."""
    if value <= 4:
        return value - 1, 0, 0
    value -= 1
    top = value.bit_length() - 1
    second = (value >> (top - 1)) & 1
    return 2 * top + second, value & ((1 << (top - 1)) - 1), top - 1


def put_image(out, argb, width, top, cache_bits=0, matches=(), meta=False):
    """Writes flat ARGB pixels; matches: {start: (length, distance code)}."""
    matches = dict(matches)
    out.put(1, 1) if cache_bits else out.put(0, 1)
    if cache_bits:
        out.put(cache_bits, 4)
    cache = {}
    symbols, at = [], 0

    def key(p):
        return ((webp.CACHE_MULTIPLIER * p) & 0xFFFFFFFF) >> (32 - cache_bits)

    while at < len(argb):
        if at in matches:
            length, code = matches[at]
            symbols.append(("copy", at, length, code))
            if cache_bits:
                for p in argb[at : at + length]:
                    cache[key(p)] = p
            at += length
            continue
        p = argb[at]
        if cache_bits and cache.get(key(p), 0) == p:
            symbols.append(("cache", at, key(p), 0))
        else:
            symbols.append(("pixel", at, p, 0))
        if cache_bits:
            cache[key(p)] = p
        at += 1
    groups = 1
    height = len(argb) // width
    if top:
        out.put(int(meta), 1)
        if meta:
            out.put(0, 3)
            w, h = -(-width // 4), -(-height // 4)
            groups = 2
            put_image(out, [((x + y) % 2) << 8 for y in range(h) for x in range(w)], w, False)
    group = lambda at: ((at % width >> 2) + (at // width >> 2)) % 2 if meta else 0
    sizes = (280 + ((1 << cache_bits) if cache_bits else 0), 256, 256, 256, 40)
    counts = [[[0] * n for n in sizes] for _ in range(groups)]
    for kind, at, a, b in symbols:
        c = counts[group(at)]
        if kind == "pixel":
            for i, shift in enumerate((8, 16, 0, 24)):
                c[i][(a >> shift) & 255] += 1
        elif kind == "cache":
            c[0][280 + a] += 1
        else:
            c[0][256 + prefix(a)[0]] += 1
            c[4][prefix(b)[0]] += 1
    codes = []
    for c in counts:
        for one in c:
            if not any(one):
                one[0] = 1
        codes.append([webp.put_code(out, huffman(one)) for one in c])
    for kind, at, a, b in symbols:
        c = codes[group(at)]
        if kind == "pixel":
            for i, shift in enumerate((8, 16, 0, 24)):
                out.put(*c[i][(a >> shift) & 255])
        elif kind == "cache":
            out.put(*c[0][280 + a])
        else:
            for table, base, value in ((0, 256, a), (4, 0, b)):
                s, extra, n = prefix(value)
                out.put(*c[table][base + s])
                out.put(extra, n)


def flat(image):
    return [int(p[0]) << 24 | int(p[1]) << 16 | int(p[2]) << 8 | int(p[3]) for p in image.reshape(-1, 4)]


def file(width, height, body):
    out = webp.Writer()
    out.put(width - 1, 14)
    out.put(height - 1, 14)
    out.put(1, 1)
    out.put(0, 3)
    body(out)
    return webp.riff(b"\x2f" + out.bytes())


def picture(width, height, seed=0, colours=None):
    rng = np.random.default_rng(seed)
    if colours:
        palette = rng.integers(0, 256, (colours, 4))
        return palette[rng.integers(0, colours, (height, width))]
    return rng.integers(0, 256, (height, width, 4)) // 16 * 16


def check(argb, data):
    assert (webp.decode(data) == argb[..., [1, 2, 3, 0]]).all()


def test_payloads_round_trip():
    for n in (64, 128, 64 * 1000, webp.TILE, webp.TILE + 64):
        payload = np.random.default_rng(n).integers(0, 256, n, dtype=np.uint8).tobytes()
        media = webp.encode_bytes(payload)
        back, images = webp.decode_bytes(media)
        assert back == payload
        assert sum(x.size for x in images) == n
    for bad in (b"", b"x" * 63):
        with pytest.raises(ValueError):
            webp.encode_bytes(bad)


def test_plain_form_equals_general_parse(monkeypatch):
    payload = bytes(range(256)) * 4
    media = webp.encode_bytes(payload)
    monkeypatch.setattr(webp, "PLAIN_HEAD", (0, 1 << 40))
    assert webp.decode_bytes(media)[0] == payload


@pytest.mark.parametrize("cache_bits", [0, 1, 6, 11])
@pytest.mark.parametrize("meta", [False, True])
def test_prefix_codes_and_cache(cache_bits, meta):
    image = picture(13, 9, 1, colours=20)

    def body(out):
        out.put(0, 1)
        put_image(out, flat(image), 13, True, cache_bits, meta=meta)

    check(image, file(13, 9, body))


@pytest.mark.parametrize("code", [1, 2, 3, 4, 121, 130])
def test_back_references(code):
    width, height, start, length = 11, 8, 40, 30
    image = picture(width, height, 2)
    back = code - 120 if code > 120 else max(1, webp.DISTANCE_MAP[code - 1][0] + webp.DISTANCE_MAP[code - 1][1] * width)
    pixels = image.reshape(-1, 4)
    for k in range(start, start + length):
        pixels[k] = pixels[k - back]

    def body(out):
        out.put(0, 1)
        put_image(out, flat(image), width, True, 3, {start: (length, code)})

    check(image, file(width, height, body))


@pytest.mark.parametrize("mode", range(14))
def test_predictor(mode):
    width, height = 9, 7
    image = picture(width, height, mode)
    w, h = -(-width // 4), -(-height // 4)
    data = np.zeros((h, w, 4), dtype=np.int64)
    data[..., 2] = mode
    coded = webp.unpredict(image, data, 2, forward=True)

    def body(out):
        out.put(1, 1)
        out.put(0, 2)
        out.put(0, 3)
        put_image(out, flat(data), w, False)
        out.put(0, 1)
        put_image(out, flat(coded), width, True)

    check(image, file(width, height, body))


def test_predictor_by_hand():
    """Two rows by mode 1 and mode 11, worked out from the rules."""
    left, top, corner = np.array([0, 10, 20, 30]), np.array([0, 50, 20, 30]), np.array([0, 12, 20, 30])
    # Distances to left: |50-12| = 38; to top: |10-12| = 2: top is nearer.
    assert webp.predict(11, left, top, None, corner)[1] == 50
    assert webp.predict(12, left, top, None, corner)[1] == 48
    assert webp.predict(13, left, top, None, corner)[1] == 30 + 9
    assert webp.predict(13, np.array([3]), np.array([3]), None, np.array([6]))[0] == 3 - 1


def test_cross_colour_and_green():
    width, height = 10, 6
    image = picture(width, height, 5)
    data = np.random.default_rng(3).integers(0, 256, (2, 3, 4))
    data[..., 0] = 255
    green = image.copy()
    green[..., 1] = (green[..., 1] - green[..., 2]) & 255
    green[..., 3] = (green[..., 3] - green[..., 2]) & 255
    coded = webp.uncross(green, data, 2, forward=True)

    def body(out):
        out.put(1, 1)
        out.put(2, 2)
        out.put(1, 1)
        out.put(1, 2)
        out.put(0, 3)
        put_image(out, flat(data), 3, False)
        out.put(0, 1)
        put_image(out, flat(coded), width, True)

    check(image, file(width, height, body))


@pytest.mark.parametrize("colours", [1, 2, 3, 4, 7, 16, 40])
def test_palette(colours):
    width, height = 11, 5
    palette = np.random.default_rng(colours).integers(0, 256, (colours, 4))
    index = np.random.default_rng(1).integers(0, colours, (height, width))
    bundle = 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0
    packed = np.zeros((height, -(-width >> bundle), 4), dtype=np.int64)
    packed[..., 0] = 255
    for y in range(height):
        for x in range(width):
            packed[y, x >> bundle, 2] |= int(index[y, x]) << ((x & ((1 << bundle) - 1)) * (8 >> bundle))
    steps = np.diff(palette, axis=0, prepend=0) & 255

    def body(out):
        out.put(1, 1)
        out.put(3, 2)
        out.put(colours - 1, 8)
        put_image(out, flat(steps), colours, False)
        out.put(0, 1)
        put_image(out, flat(packed), packed.shape[1], True)

    check(palette[index], file(width, height, body))


def test_damaged_files_raise():
    media = webp.encode_bytes(b"a" * 64)
    for bad in (b"", media[:30], b"RIFX" + media[4:]):
        with pytest.raises(ValueError):
            webp.decode(bad)


def test_rows_go_through_the_full_decoder(monkeypatch):
    """Text gets prefix codes, copies, a cache or a palette, and comes back by symbols; only noise keeps 8-bit codes."""
    calls, inner, plain = [], webp._symbols, []
    monkeypatch.setattr(webp, "_symbols", lambda *a: calls.append(a) or inner(*a))
    flat_form = webp._plain
    monkeypatch.setattr(webp, "_plain", lambda *a: plain.append(a) or flat_form(*a))
    rng = np.random.default_rng(4)
    words = [bytes(rng.integers(97, 123, int(n), dtype=np.uint8)) for n in rng.integers(2, 9, 80)]
    text = b" ".join(words[i] for i in rng.integers(0, 80, 3000))[:12800]
    for payload in (text, text[:640] * 7, b"ab" * 320, bytes(range(64)) * 500, b"x" * 64 * 40000):
        media = webp.encode_bytes(payload)
        assert webp.decode_bytes(media)[0] == payload and len(media) < len(payload)
    assert len(calls) > 5 and not plain


def test_writer_uses_transforms():
    rng = np.random.default_rng(6)
    ramp = (np.arange(16)[None, :, None] * np.array([3, 5, 7, 11]) + np.arange(400)[:, None, None] * 13 + rng.integers(0, 2, (400, 16, 4))) & 255
    green = rng.integers(0, 256, (400, 16, 1)) + np.array([0, 7, 9, 0])
    green[..., 3] = 200
    crossed = rng.integers(0, 128, (400, 16, 4)) & np.array([127, 0, 0, 0])
    crossed[..., 1], crossed[..., 2], crossed[..., 3] = crossed[..., 0] // 2, 60, 5
    few = rng.integers(0, 256, (5, 4))[rng.integers(0, 5, (400, 16))]
    kinds = set()
    for samples in (ramp, green, crossed, few):
        payload = (samples & 255).astype(np.uint8).tobytes()
        media = webp.encode_bytes(payload)
        bits = int.from_bytes(media[21:29], "little") >> 32
        kinds.add((bits >> 1) & 3 if bits & 1 else None)
        assert webp.decode_bytes(media)[0] == payload and len(media) < len(payload)
    assert kinds == {0, 1, 2, 3}


def test_forms_that_promise_nothing_are_not_made(monkeypatch):
    """Prose is neither smooth nor are its channels alike: no mixed predictor and no cross-colour step is computed for it; a ramp beside it has them."""
    calls, inner = [], webp.predict
    monkeypatch.setattr(webp, "predict", lambda mode, *a: calls.append((mode, a)) or inner(mode, *a))
    rng = np.random.default_rng(4)
    words = [bytes(rng.integers(97, 123, int(n), dtype=np.uint8)) for n in rng.integers(2, 9, 80)]
    text = b" ".join(words[i] for i in rng.integers(0, 80, 3000))[:12800]
    alone = webp.encode_bytes(text)
    assert not calls
    ramp = ((np.arange(16)[None, :, None] * np.array([3, 5, 7, 11]) + np.arange(400)[:, None, None] * 13 + rng.integers(0, 2, (400, 16, 4))) & 255).astype(np.uint8).tobytes()
    files = webp.encode_many([text, ramp, text])
    assert [mode for mode, _ in calls] == [7, 11, 12] and {left.shape for _, (left, *_) in calls} == {(399, 15, 4)}
    assert files[::2] == [alone, alone] and [x for x, _ in webp.decode_many(files)] == [text, ramp, text]


def test_slopes_of_the_tallest_image():
    rows = webp.MAX_SIDE
    samples = tuple(np.full((rows + 2, 16), x, dtype=np.int32) for x in (-128, -128, 127))
    samples[0][::2], samples[1][::3], samples[2][::2] = 127, 5, -128
    slopes, telling = webp._slopes(samples, np.array([0, rows]), np.array([16 * rows, 32]))
    for k, part in enumerate((slice(0, rows), slice(rows, rows + 2))):
        red, green, blue = (x[part].ravel().astype(float) for x in samples)
        want = [round(32 * np.cov(x, y, bias=True)[0, 1] / x.var()) if x.var() else 0 for x, y in ((red, blue), (green, blue), (green, red))]
        assert slopes[k].tolist() == np.clip(want, -128, 127).tolist()
    assert telling.all()


def test_images_of_many_batches_are_read_together(monkeypatch):
    import pyarrow as pa

    def batch(begin, n, size):
        return pa.RecordBatch.from_arrays([pa.array(range(begin, begin + n)), pa.array([size] * n), pa.array([b"%d" % k for k in range(begin, begin + n)], pa.binary())], names=["doc_id", "n_bytes", "media"])

    monkeypatch.setattr(media, "READ_ROWS", 100)
    monkeypatch.setattr(media, "READ_BYTES", 5000)
    got = list(media._gathered(batch(10 * k, 10, 1) for k in range(25)))
    assert [len(ids) for ids, _, _ in got] == [100, 100, 50]
    assert [x for ids, _, data in got for x in zip(ids, data)] == [(k, b"%d" % k) for k in range(250)]
    assert [sum(sizes) for _, sizes, _ in media._gathered(batch(10 * k, 10, 400) for k in range(5))] == [8000, 8000, 4000]
    assert list(media._gathered(iter([]))) == list(media._gathered(iter([batch(0, 0, 0)]))) == []


def mixed():
    """Payloads of many lengths and kinds: prose, repeats, few colours, noise, ramps, single rows."""
    rng = np.random.default_rng(9)
    words = [bytes(rng.integers(97, 123, int(n), dtype=np.uint8)) for n in rng.integers(2, 9, 80)]
    for k in range(130):
        rows = int(rng.integers(1, 60)) if k % 9 else 400
        line = b" ".join(words[i] for i in rng.integers(0, 80, 20 * rows))
        line = (line, line[:200] * rows, b"ab" * 64 * rows, rng.bytes(64 * rows), bytes(range(256)) * rows, b"\0" * 64 * rows)[k % 11 if k % 11 < 6 else 0]
        yield line[: 64 * rows]
    yield b"long " * 64 * 60000


def test_many_images_are_those_of_each_alone(monkeypatch):
    payloads = list(mixed())
    media = webp.encode_many(payloads)
    assert media == [webp.encode_bytes(p) for p in payloads] == webp.encode_many(payloads[::-1])[::-1]
    calls, inner = [], webp._symbols
    monkeypatch.setattr(webp, "_symbols", lambda *a: calls.append(a) or inner(*a))
    back = webp.decode_many(media)
    assert [x for x, _ in back] == payloads
    together = sum(len(a) == 8 for a in calls)
    assert 0 < together < webp.FEWEST_LANES  # the rest ended in common steps
    monkeypatch.setattr(webp, "FEWEST_LANES", 1)
    assert [x for x, _ in webp.decode_many(media)] == payloads
    assert webp.encode_many([]) == webp.decode_many([]) == []


@pytest.mark.parametrize("lanes", [1, 3, 40])
def test_streams_of_other_writers_together(monkeypatch, lanes):
    """Caches, copies that reach over themselves, transforms and meta codes of the test encoder, many at once."""
    monkeypatch.setattr(webp, "FEWEST_LANES", lanes)
    files, images = [], []
    for k in range(60):
        width, height = 5 + k % 7, 6 + k % 5
        image = picture(width, height, k, colours=9 if k % 2 else None)
        copies, pixels = {}, image.reshape(-1, 4)
        if k % 3 == 0:
            copies = {10: (12, 121 + k % 4)}
            for i in range(10, 22):
                pixels[i] = pixels[i - 1 - k % 4]

        def body(out):
            out.put(0, 1)
            put_image(out, flat(image), width, True, (0, 1, 5, 11)[k % 4], copies, meta=k % 5 == 0)

        files.append(file(width, height, body))
        images.append(image)
    for got, image in zip(webp.decode_all(files), images):
        assert (got == image[..., [1, 2, 3, 0]]).all()
    with pytest.raises(ValueError):
        webp.decode_all([*files[:-1], files[-1][:-12]])
