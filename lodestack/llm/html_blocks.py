"""HTML extraction: leaf blocks of a page labelled by a bidirectional LSTM in numpy.

A page is cut into blocks, the runs of text between block-level tags in page order. A block's vector holds the
hashed tags and class, id and role words on its path, its hashed words, and a few measures (length, share of text in
links, punctuation). The LSTM reads the page's whole sequence in both directions, so that every label
depends on the whole page, and blocks labelled as main text are joined by one newline.

The network is trained here, at first use, on generated pages of many layouts (fixed seed, a few seconds); no page of
the input is a training page. Pages are labelled in batches of similar length; a narrow pass without a shuffle.

Cases: null and empty pages give the empty text; unclosed and crossing tags, stray ends and cut-off pages are read
as far as they go; character references are decoded; nothing of a chosen block is cut; repeated rows stay; an empty table gives an
empty one; a page of any length is one sequence, in memory with some 600 bytes a block; other columns are not read.
"""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH, WORDS, EXTRA = 96, 32, 8
SIZE = PATH + WORDS + EXTRA
HIDDEN = 20

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"([\w:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style noscript template textarea title svg iframe object select option head".split())
RAW = frozenset("script style textarea title".split())


def _marks(attributes: str) -> tuple[str, ...]:
    found = []
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name in ("class", "id", "role", "itemprop"):
            found += [w for w in re.split(r"[\W_]+|(?<=[a-z])(?=[A-Z])|\d+", value) if w]
        elif name in ("hidden", "aria-hidden") or name == "style" and "none" in value.replace(" ", ""):
            found.append("hidden")
    return tuple(w.lower() for w in found)


class Block:
    __slots__ = ("path", "parts", "linked")

    def __init__(self, path):
        self.path, self.parts, self.linked = path, [], 0

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


def blocks(page: str) -> list[tuple[tuple, str, float]]:
    """(path, text, share of characters in links) of the leaf blocks. The path is a tuple of (tag, marks)."""
    out, stack, at = [], [], 0
    current: Block | None = None
    unread = links = 0

    def close():
        nonlocal current
        if current is not None:
            if text := current.text():
                out.append((current.path, text, min(1.0, current.linked / max(1, sum(map(len, current.parts))))))
            current = None

    def take(piece: str):
        nonlocal current
        if piece and not unread:
            if current is None:
                if not piece.strip():
                    return
                current = Block(tuple(s for s in stack if s[0] not in INLINE))
            current.parts.append(piece)
            current.linked += len(piece) if links else 0

    def pop(k: int):
        nonlocal unread, links
        while len(stack) > k:
            tag = stack.pop()[0]
            unread -= tag in UNREAD
            links -= tag == "a"

    while True:
        m = TAG.search(page, at)
        if m is None:
            take(page[at:])
            break
        take(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag not in INLINE:
            close()
        elif tag == "br":
            take(" ")
        if m[1]:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if k is not None:
                pop(k)
            continue
        if tag in VOID or m[3].endswith("/"):
            continue
        if tag not in INLINE:
            # A block that opens ends an open paragraph; list items and cells end their like.
            like = {"li": ("li",), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "tr": ("tr",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "body": ("head",)}.get(tag, ("p",))
            scope = {"li": ("ul", "ol"), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table",)}.get(tag, ("table", "article", "section", "div", "blockquote"))
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in like:
                    pop(i)
                    break
                if stack[i][0] in scope:
                    break
        stack.append((tag, _marks(m[3]) if m[3] else ()))
        unread += tag in UNREAD
        links += tag == "a"
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            pop(len(stack) - 1)
            at = end.end() if end else len(page)
    close()
    return out


class Vectors:
    """Blocks to vectors; hashes are kept by path and word."""

    def __init__(self):
        self.paths: dict = {}
        self.words: dict[str, int] = {}

    def path(self, path) -> np.ndarray:
        found = self.paths.get(path)
        if found is None:
            if len(self.paths) > 20_000:
                self.paths.clear()
            found = np.zeros(PATH, dtype=np.float32)
            for depth, (tag, marks) in enumerate(path):
                last = depth == len(path) - 1
                for name in (tag, *("." + w for w in marks), *(["=" + tag] if last else [])):
                    found[zlib.crc32(name.encode()) % PATH] = 1.0
            self.paths[path] = found
        return found

    def word(self, word: str) -> int:
        if len(self.words) > 300_000:
            self.words.clear()
        found = self.words[word] = zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % WORDS
        return found

    def page(self, found: list) -> np.ndarray:
        out = np.zeros((len(found), SIZE), dtype=np.float32)
        get = self.words.get
        for i, (path, text, linked) in enumerate(found):
            words = text.split(" ")
            row = out[i]
            row[:PATH] = self.path(path)
            index = [get(w) if w in self.words else self.word(w) for w in words]
            row[PATH : PATH + WORDS] = np.bincount(index, minlength=WORDS) / len(words)
            ends = sum(text.count(c) for c in ".!?;:,")
            row[PATH + WORDS :] = (np.log1p(len(text)) / 6, linked, min(1.0, len(words) / 40), min(2.0, 5 * ends / len(words)), text[-1] in ".!?", i / len(found), 1.0 / (1 + i), 1.0 / (len(found) - i))
        return out


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _forward(x, mask, wx, wh, b):
    """LSTM over (batch, time, features); a masked step keeps the state. Returns outputs and what training needs."""
    batch, steps, _ = x.shape
    pre = x @ wx + b
    h, c = np.zeros((batch, HIDDEN), dtype=np.float32), np.zeros((batch, HIDDEN), dtype=np.float32)
    out, kept = np.zeros((batch, steps, HIDDEN), dtype=np.float32), []
    for t in range(steps):
        z = pre[:, t] + h @ wh
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        m = mask[:, t : t + 1]
        fresh = f * c + i * g
        c2 = m * fresh + (1 - m) * c
        tc = np.tanh(c2)
        h2 = m * (o * tc) + (1 - m) * h
        kept.append((h, c, i, f, o, g, tc, m))
        h, c = h2, c2
        out[:, t] = h
    return out, kept


def _backward(dout, x, kept, wh):
    batch, steps, size = x.shape
    dh, dc = np.zeros((batch, HIDDEN)), np.zeros((batch, HIDDEN))
    dwh, dpre = np.zeros_like(wh), np.zeros((batch, steps, 4 * HIDDEN), dtype=np.float32)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, tc, m = kept[t]
        dh = dh + dout[:, t]
        dact, keep_h = dh * m, dh * (1 - m)
        dcell = dc + dact * o * (1 - tc**2)
        dnew, keep_c = dcell * m, dcell * (1 - m)
        dz = np.concatenate((dnew * g * i * (1 - i), dnew * c * f * (1 - f), dact * tc * o * (1 - o), dnew * i * (1 - g**2)), 1)
        dpre[:, t] = dz
        dwh += h.T @ dz
        dh = dz @ wh.T + keep_h
        dc = dnew * f + keep_c
    flat = dpre.reshape(-1, 4 * HIDDEN)
    return x.reshape(-1, size).T @ flat, dwh, flat.sum(0)


def _reverse(x, mask):
    """Each row's real steps in reverse order, padding stays behind."""
    out = np.zeros_like(x)
    for k, n in enumerate(mask.sum(1).astype(int)):
        out[k, :n] = x[k, :n][::-1]
    return out


class Labeller:
    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @staticmethod
    def fresh(seed: int = 7) -> "Labeller":
        rng = np.random.default_rng(seed)
        make = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        w = {"v": make(2 * HIDDEN, 1), "vb": np.zeros(1, dtype=np.float32)}
        for side in "fb":
            w |= {side + "x": make(SIZE, 4 * HIDDEN), side + "h": make(HIDDEN, 4 * HIDDEN), side + "c": np.zeros(4 * HIDDEN, dtype=np.float32)}
        return Labeller(w)

    def run(self, x, mask):
        w = self.w
        xr = _reverse(x, mask)
        forward, kf = _forward(x, mask, w["fx"], w["fh"], w["fc"])
        back, kb = _forward(xr, mask, w["bx"], w["bh"], w["bc"])
        both = np.concatenate((forward, _reverse(back, mask)), 2)
        return _sigmoid((both @ w["v"])[..., 0] + w["vb"]), (xr, kf, kb, both)

    def gradients(self, x, mask, y):
        p, (xr, kf, kb, both) = self.run(x, mask)
        d = ((p - y) * mask / mask.sum())[..., None].astype(np.float32)
        g = {"v": both.reshape(-1, 2 * HIDDEN).T @ d.reshape(-1, 1), "vb": d.sum((0, 1))}
        dboth = d @ self.w["v"].T
        g["fx"], g["fh"], g["fc"] = _backward(dboth[..., :HIDDEN], x, kf, self.w["fh"])
        g["bx"], g["bh"], g["bc"] = _backward(_reverse(dboth[..., HIDDEN:], mask), xr, kb, self.w["bh"])
        return g

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 12, batch: int = 32, rate: float = 0.02, seed: int = 3) -> None:
        """Adam over batches of pages of similar length."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        pages = sorted(pages, key=lambda p: len(p[1]))
        groups = [_padded(pages[i : i + batch]) for i in range(0, len(pages), batch)]
        step = 0
        for epoch in range(epochs):
            for k in rng.permutation(len(groups)):
                step += 1
                for name, g in self.gradients(*groups[k]).items():
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.99 * second[name] + 0.01 * g * g
                    move = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-7)
                    self.w[name] = (self.w[name] - rate * 0.85**epoch * move).astype(np.float32)

    def labels(self, pages: list[np.ndarray], room: int = 16_384) -> list[np.ndarray]:
        """Probability of main text for the blocks of each page; batches of similar length with at most ``room`` steps,
        a longer page alone."""
        out: list = [np.zeros(0, dtype=np.float32)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(pages[order[end]]) <= room and end - at < 256:
                end += 1
            x, mask, _ = _padded([(pages[i], np.zeros(len(pages[i]))) for i in order[at:end]])
            p, _ = self.run(x, mask)
            for k, i in enumerate(order[at:end]):
                out[i] = p[k, : len(pages[i])]
            at = end
        return out


def _padded(pages):
    steps = max(len(y) for _, y in pages)
    x = np.zeros((len(pages), steps, SIZE), dtype=np.float32)
    mask, y = np.zeros((len(pages), steps), dtype=np.float32), np.zeros((len(pages), steps), dtype=np.float32)
    for k, (a, b) in enumerate(pages):
        x[k, : len(b)], mask[k, : len(b)], y[k, : len(b)] = a, 1, b
    return x, mask, y


# Generated training pages.
MAIN_NAMES = "content main post entry article body story text page-content post-body entry-content article-text".split()
OTHER_NAMES = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav site-nav main-menu".split(),
    "aside": "sidebar aside widget related more-links sidebar-right recommended tags".split(),
    "ad": "ad ads advert advertisement sponsored promo banner ad-slot".split(),
    "comments": "comments comment reader-comments comment-list discussion responses".split(),
    "notice": "cookie cookie-banner notice consent newsletter subscribe alert popup privacy-notice".split(),
    "share": "share social sharing buttons share-bar".split(),
    "footer": "footer foot site-footer copyright legal colophon".split(),
    "header": "header masthead site-header topbar logo page-header".split(),
    "form": "form search login signup contact-form".split(),
}
SEMANTIC = {"nav": "nav", "aside": "aside", "footer": "footer", "header": "header", "form": "form", "comments": "section", "ad": "aside"}
SHORT = {"nav": ["Home", "About", "News", "Contact", "Blog"], "share": ["Share", "Tweet", "Print", "Email"], "form": ["Search", "Sign in", "Name", "Send", "Password"], "header": ["Welcome", "Daily", "The Journal"]}


class Layouts:
    def __init__(self, seed: int):
        import random

        self.r = random.Random(seed)
        self.style = "named"

    def name(self, names: list[str]) -> str:
        """Class or id of a part; pages of an unknown style have names that say nothing, or none."""
        r = self.r
        if self.style == "named":
            return f' {r.choice(("class", "class", "id"))}="{r.choice(names)}"'
        return f' class="{self.word()}{r.choice(("", "-" + self.word(), str(r.randrange(12))))}"' if r.random() < 0.7 else ""

    def word(self) -> str:
        r = self.r
        return "".join(r.choice("bcdfghlmnprstvw") + r.choice(("a", "e", "i", "o", "u", "ä", "é", "ou", "er", "in")) for _ in range(r.choice((1, 1, 2, 2, 3, 4))))

    def words(self, n: int) -> str:
        return " ".join(self.word() for _ in range(n))

    def sentence(self, low=3, high=16) -> str:
        text = self.words(self.r.randrange(low, high)).capitalize()
        return (text.replace(" ", ", ", 1) if self.r.random() < 0.4 else text) + self.r.choice("....!?")

    def prose(self, most=7) -> str:
        if self.r.random() < 0.12:
            return self.sentence(1, 4)
        return " ".join(self.sentence() for _ in range(self.r.randrange(1, most)))

    def other(self, kind: str) -> list[str]:
        """Texts of a part that is not main text."""
        r = self.r
        if kind in SHORT:
            return [r.choice(SHORT[kind]) if r.random() < 0.3 else self.words(r.randrange(1, 3)) for _ in range(r.randrange(1, 8))]
        if kind == "footer":
            return [r.choice(("© ", "&copy; ", "Copyright ")) + self.words(2) + r.choice((" &middot; ", " ")) + self.sentence()] + [self.words(2) for _ in range(r.randrange(3))]
        if kind == "notice":
            return [r.choice(("We use cookies ", "Subscribe ", "Accept ", "This site ")) + self.sentence()] + ["Accept"] * r.randrange(2)
        if kind == "ad":
            return [self.prose(4) for _ in range(r.randrange(1, 3))]
        if kind == "comments":
            return [t for _ in range(r.randrange(1, 5)) for t in (self.word() + " wrote:", self.prose(4))]
        return [self.words(r.randrange(2, 6)) if r.random() < 0.7 else self.prose(3) for _ in range(r.randrange(1, 6))]

    def part(self, kind: str) -> tuple[str, list[int]]:
        r = self.r
        texts = self.other(kind)
        tag = SEMANTIC.get(kind, "div") if r.random() < (0.5 if self.style == "named" else 0.2) else "div"
        name = self.name(OTHER_NAMES[kind]) if tag in ("div", "section", "aside") or r.random() < 0.3 else ""
        if kind in ("nav", "share", "aside") and r.random() < 0.8:
            body = "<ul>" + "".join(f'<li><a href="/{i}">{t}</a></li>' for i, t in enumerate(texts)) + "</ul>"
        elif len(texts) == 1 and r.random() < 0.7:
            body = texts[0]
        elif kind == "form":
            body = "<form>" + "".join(f"<p>{t}</p>" for t in texts) + "</form>"
        else:
            inner = r.choice(("p", "div", "li", "p"))
            body = "".join(f"<{inner}>{t}</{inner}>" for t in texts)
        return f"<{tag}{name}>{body}</{tag}>", [0] * len(texts)

    def article(self) -> tuple[str, list[int]]:
        r = self.r
        out, labels = [], []
        for k in range(r.choice((1, 2, 3, 5, 8, 12, 20, 32))):
            kind = r.random()
            if k == 0 and kind < 0.85 or kind < 0.1:
                tag = "h1" if k == 0 else r.choice(("h2", "h3"))
                out.append(f"<{tag}>{self.words(r.randrange(2, 9)).capitalize()}{r.choice(('', '.'))}</{tag}>")
            elif kind < 0.78:
                text = self.prose()
                if r.random() < 0.25:
                    text = f'<a href="/x">{self.words(2)}</a> ' + text
                out.append(f"<p><b>{text}<br>" if r.random() < 0.12 else f"<p>{text}</p>")
            elif kind < 0.85:
                texts = [self.sentence(2, 9) for _ in range(r.randrange(1, 4))]
                out.append("<ul>" + "".join(f"<li>{t}</li>" for t in texts) + "</ul>")
                labels += [1] * (len(texts) - 1)
            elif kind < 0.88:
                out.append(f"<blockquote>{self.prose()}</blockquote>")
            elif kind < 0.95:
                text, n = self.special()
                out.append(text)
                labels += [1] * (n - 1)
            else:
                out.append(f"<div>{self.prose()}</div>")
            labels.append(1)
            if r.random() < 0.05:
                text, more = self.part(r.choice(("ad", "share", "notice", "aside")))
                out.append(text)
                labels += more
        body = "".join(out)
        if r.random() < 0.1:
            body = f"<section>{body}</section>"
        if self.style == "bare":
            return body, labels
        form = r.random() if self.style == "named" else 0.5 + 0.7 * r.random()
        if form < 0.55:
            return f"<article>{body}</article>", labels
        if form < 0.7:
            return f"<main>{body}</main>", labels
        return f"<div{self.name(MAIN_NAMES)}>{body}</div>", labels

    def special(self) -> tuple[str, int]:
        """Parts of an article other than paragraphs, and how many blocks they make."""
        r = self.r
        kind = r.randrange(6)
        if kind == 0:
            rows = [[self.words(r.randrange(1, 3)) for _ in range(2)] for _ in range(r.randrange(1, 4))]
            head = r.random() < 0.5
            cells = "".join("<tr>" + "".join(f"<{'th' if head and k == 0 else 'td'}>{c}</{'th' if head and k == 0 else 'td'}>" for c in row) + "</tr>" for k, row in enumerate(rows))
            return f"<table>{cells}</table>", 2 * len(rows)
        if kind == 1:
            a, b = self.word(), self.word()
            return r.choice((f"<pre>{a} = {b}({r.randrange(9)})</pre>", f"<pre><code>{a} &lt; {b} and {r.randrange(9)} > 2</code></pre>", f"<pre>for {a} in {b}:\n  {self.word()}({a})</pre>")), 1
        if kind == 2:
            return f"<details><summary>{self.words(r.randrange(1, 4))}</summary>{self.prose(4)}</details>", 2
        if kind == 3:
            n = r.randrange(1, 4)
            return "<dl>" + "".join(f"<dt>{self.words(r.randrange(1, 3))}</dt><dd>{self.sentence()}</dd>" for _ in range(n)) + "</dl>", 2 * n
        if kind == 4:
            return f'<figure><img src="/{self.word()}.png"><figcaption>{self.sentence(2, 9)}</figcaption></figure>', 1
        return f"<p>{self.word()} &lt; {self.word()} {self.word()} {r.randrange(9)} > {r.randrange(9)}{r.choice(('.', ''))}</p>", 1

    def page(self) -> tuple[str, list[int]]:
        r = self.r
        self.style = r.choices(("named", "unknown", "bare"), (6, 3, 1.5))[0]
        if self.style == "bare" and r.random() < 0.6:
            article, labels = self.article()
            return f"<html><body>{article}</body></html>" if r.random() < 0.7 else f"<body>{article}", labels
        before = [k for k, p in (("notice", 0.2), ("header", 0.5), ("nav", 0.8), ("ad", 0.45), ("form", 0.15), ("aside", 0.2)) if r.random() < p]
        after = [k for k, p in (("share", 0.25), ("comments", 0.35), ("aside", 0.35), ("form", 0.15), ("ad", 0.2), ("nav", 0.15), ("footer", 0.8), ("notice", 0.1)) if r.random() < p]
        parts = [self.part(k) for k in before] + [self.article()] + [self.part(k) for k in after]
        body = "".join(p for p, _ in parts)
        if r.random() < 0.2:
            body = f"<div{self.name(['wrapper', 'page', 'container', 'site'])}>{body}</div>"
        return "<!DOCTYPE html><html><head><title>t</title></head><body>" + body + "</body></html>", [y for _, ys in parts for y in ys]


def training_pages(n: int, seed: int = 11) -> list[tuple[np.ndarray, np.ndarray]]:
    layouts, vectors, out = Layouts(seed), Vectors(), []
    while len(out) < n:
        page, labels = layouts.page()
        found = blocks(page)
        if len(found) == len(labels):
            out.append((vectors.page(found), np.array(labels, dtype=np.float32)))
    return out


_TRAINED: list[Labeller] = []


def trained() -> Labeller:
    """The labeller, trained once in a process; the same weights every time."""
    if not _TRAINED:
        labeller = Labeller.fresh()
        labeller.train(training_pages(2600))
        _TRAINED.append(labeller)
    return _TRAINED[0]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Row per page: page_id, url, text, n_chars, n_blocks, n_main."""
    weights = trained().w

    def run(batches):
        import pyarrow as pa

        labeller, vectors = Labeller(weights), Vectors()
        for batch in batches:
            raw = batch.column(2).to_pylist()
            at = 0
            while at < len(raw):
                end, size = at, 0
                while end < len(raw) and (end == at or size + len(raw[end]) <= 4 << 20):
                    size += len(raw[end])
                    end += 1
                found = [blocks(p) for p in raw[at:end]]
                labels = labeller.labels([vectors.page(f) for f in found])
                texts = ["\n".join(b[1] for b, p in zip(f, ps) if p >= 0.5) for f, ps in zip(found, labels)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[at:end], batch.column(1)[at:end], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(f) for f in found], pa.int64()), pa.array([int((p >= 0.5).sum()) for p in labels], pa.int64())], names=["page_id", "url", "text", "n_chars", "n_blocks", "n_main"])
                at = end

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long, n_main long")
