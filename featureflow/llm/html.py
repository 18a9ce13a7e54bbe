"""Main-text extraction: a recurrent network labels every block of a page.

A page becomes the sequence of its leaf blocks (text between block-level
boundaries).  Each block is the mean of hashed tag-path embeddings (tags,
class and id words, roles of all its ancestors), the mean of hashed word
embeddings, and a few counts.  A bidirectional LSTM in numpy reads the whole
sequence, so every block is judged with the context of the entire page, and a
logistic unit marks it as main text or not.

The network is trained here, on the driver, on generated pages: their layouts
come from rules (``LAYOUTS``, ``NOISE``), their texts from a bounded sample of
the pages to be read, split by the page's own semantic tags.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featureflow.llm.words import Words

PATHS, WORDS = 1 << 12, 1 << 12    # hash buckets
PATH_DIM, WORD_DIM, COUNTS = 16, 8, 6
HIDDEN = 16
SAMPLE_PAGES = 200                 # pages (expected number) whose texts dress the training pages
TRAIN_PAGES = 900

# elements that end a block where they begin or end
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split())
# elements whose text is never shown as text of the page
HIDDEN_TEXT = frozenset(
    "applet audio button canvas datalist embed head iframe input noembed noframes noscript object optgroup option "
    "script select style svg template textarea title video".split())
# what may stand in a head; any other element, or text, ends one that was not closed
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
# names of a path that are kept when elements nest deeper: the outer and the inner ones
OUTER, INNER = 32, 96
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# an element that begins also ends an open element of these names
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPES = frozenset("table ul ol dl td th article section div main body html select menu".split())


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int                    # characters inside links


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.path: tuple[str, ...] = ()
        self.hidden = self.links = self.linked = 0

    def _flush(self):
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(self.path, text, self.linked))
        self.parts, self.linked = [], 0

    def _pop(self):
        tag, _ = self.stack.pop()
        self.hidden -= tag in HIDDEN_TEXT
        self.links -= tag == "a"

    def _end(self, names, scope=True):
        """Close the nearest open element of these names, unless a scope stands before it."""
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[i][0]
            if tag in names:
                while len(self.stack) > i:
                    self._pop()
                return
            if scope and tag in SCOPES:
                return

    def _end_head(self):
        if any(tag == "head" for tag, _ in self.stack[:8]):
            self._end({"head"}, scope=False)

    def handle_starttag(self, tag, attrs):
        if tag not in IN_HEAD and self.hidden:
            self._end_head()
        if tag in BLOCKS:
            self._flush()
            self._end({"p"})
        elif tag == "br":
            self.parts.append(" ")
        for _ in range(2):
            if tag in ENDS:
                self._end(ENDS[tag])
        if tag in VOID:
            return
        own = [tag]
        for k, v in attrs:
            if v and k in ("class", "id", "role", "itemprop"):
                own += [f"{k[0]}:{w}" for w in re.findall(r"[a-z]+|[0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", v).lower())]
        self.stack.append((tag, tuple(own)))
        self.hidden += tag in HIDDEN_TEXT
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS and tag != "a":
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._flush()
        self._end({tag}, scope=False)

    def handle_data(self, data):
        if self.hidden and self.stack[-1][0] == "head" and data.strip():
            self._end_head()
        if self.hidden:
            return
        if not self.parts:
            if not data.strip():
                return
            deep = len(self.stack) > OUTER + INNER
            shown = self.stack[:OUTER] + self.stack[-INNER:] if deep else self.stack
            self.path = tuple(x for _, own in shown for x in own)
        self.parts.append(data)
        if self.links:
            self.linked += len(data.strip())


def leaf_blocks(html: str) -> list[Block]:
    """Blocks of a page in order: character references decoded, white space inside a block one space."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader._flush()
    return reader.blocks


def _bucket(token: str, size: int) -> int:
    return zlib.crc32(token.encode("utf-8", "replace")) % size


def path_buckets(path: tuple[str, ...]) -> np.ndarray:
    """Buckets of a path's names, of neighbouring pairs, and of its last name by itself."""
    tokens = [*path, *(f"{a}>{b}" for a, b in zip(path, path[1:], strict=False)), "last " + (path[-1] if path else "")]
    return np.array([_bucket(t, PATHS) for t in tokens], dtype=np.int64)


def counts(blocks: list[Block]) -> np.ndarray:
    """Per block: length, link share, sentence ends, position, position from the end, is a heading."""
    n = len(blocks)
    out = np.zeros((n, COUNTS), dtype=np.float32)
    for i, b in enumerate(blocks):
        out[i] = (np.log1p(len(b.text)) / 4, min(1.0, b.linked / len(b.text)),
                  min(1.0, sum(b.text.count(c) for c in ".!?") / 5), i / n, (n - i) / n,
                  any(x in ("h1", "h2", "h3") for x in b.path[-2:]))
    return out


def word_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    w = Words(pa.array(texts, pa.large_string()), lower=True)
    return (w.hashes() % np.uint64(WORDS)).astype(np.int64), w.bounds


class Labeller:
    """Embeddings and a bidirectional LSTM; ``params`` are float32 arrays by name."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        d = PATH_DIM + WORD_DIM + COUNTS
        self.params = {"path": rng.normal(0, 0.3, (PATHS, PATH_DIM)), "word": rng.normal(0, 0.1, (WORDS, WORD_DIM)),
                       "out": rng.normal(0, 0.3, 2 * HIDDEN), "out0": np.zeros(1)}
        for way in ("f", "b"):
            self.params |= {f"x{way}": rng.normal(0, 0.3, (d, 4 * HIDDEN)),
                            f"h{way}": rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)),
                            f"c{way}": np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)}
        self.params = {k: v.astype(np.float32) for k, v in self.params.items()}

    def inputs(self, blocks: list[Block], cache: dict) -> np.ndarray:
        """(blocks, features) of one or more pages' blocks (counts are added by the caller per page)."""
        p = self.params
        out = np.zeros((len(blocks), PATH_DIM + WORD_DIM + COUNTS), dtype=np.float32)
        for i, b in enumerate(blocks):
            if b.path not in cache:
                if len(cache) > 20_000:
                    cache.clear()
                cache[b.path] = p["path"][path_buckets(b.path)].mean(axis=0)
            out[i, :PATH_DIM] = cache[b.path]
        ids, bounds = word_buckets([b.text for b in blocks])
        number = np.diff(bounds)
        full = np.flatnonzero(number)
        if len(full):
            sums = np.add.reduceat(p["word"][ids], bounds[:-1][full], axis=0)
            out[full, PATH_DIM:PATH_DIM + WORD_DIM] = sums / number[full, None]
        return out

    def _run(self, x: np.ndarray, mask: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (time, pages, HIDDEN) in the order of ``x``; padded steps carry the state on."""
        p = self.params
        steps, n, _ = x.shape
        h = np.zeros((n, HIDDEN), np.float32)
        c = np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((steps, n, HIDDEN), np.float32)
        for t in (range(steps) if way == "f" else range(steps - 1, -1, -1)):
            z = x[t] @ p[f"x{way}"] + h @ p[f"h{way}"] + p[f"c{way}"]
            i, f, o = (1 / (1 + np.exp(-np.clip(z[:, k * HIDDEN:(k + 1) * HIDDEN], -30, 30))) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            c_new = m * (f * c + i * g) + (1 - m) * c
            tc = np.tanh(c_new)
            h_new = m * (o * tc) + (1 - m) * h
            if keep is not None:
                keep.append((t, i, f, o, g, c, tc, h, m))
            h, c = h_new, c_new
            out[t] = h
        return out

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, mask, "f"), self._run(x, mask, "b")], axis=2)
        return 1 / (1 + np.exp(-np.clip(both @ self.params["out"] + self.params["out0"][0], -30, 30)))

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the mean log loss by parameter, and by input."""
        p, grads = self.params, {}
        keeps = {"f": [], "b": []}
        states = {w: self._run(x, mask, w, keeps[w]) for w in "fb"}
        both = np.concatenate([states["f"], states["b"]], axis=2)
        prob = 1 / (1 + np.exp(-np.clip(both @ p["out"] + p["out0"][0], -30, 30)))
        dz = (prob - y) * mask / mask.sum()
        grads["out"] = np.einsum("tnh,tn->h", both, dz)
        grads["out0"] = dz.sum(keepdims=True).reshape(1)
        dboth = dz[:, :, None] * p["out"]
        dx = np.zeros_like(x)
        for k, way in enumerate("fb"):
            dout = dboth[:, :, k * HIDDEN:(k + 1) * HIDDEN]
            gx, gh, gc = (np.zeros_like(p[f"{a}{way}"]) for a in "xhc")
            dh = np.zeros((x.shape[1], HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, i, f, o, g, c, tc, h, m in reversed(keeps[way]):
                dh = dh + dout[t]
                live = dh * m
                dcm = (dc + live * o * (1 - tc * tc)) * m
                dgate = np.concatenate([dcm * g * i * (1 - i), dcm * c * f * (1 - f), live * tc * o * (1 - o),
                                        dcm * i * (1 - g * g)], axis=1)
                gx += x[t].T @ dgate
                gh += h.T @ dgate
                gc += dgate.sum(axis=0)
                dx[t] += dgate @ p[f"x{way}"].T
                dh = dgate @ p[f"h{way}"].T + dh * (1 - m)
                dc = dcm * f + dc * (1 - m)
            grads |= {f"x{way}": gx, f"h{way}": gh, f"c{way}": gc}
        return grads, dx


# ---------------------------------------------------------------- training pages
# containers of the article, outermost first; a word after '.' is a class, after '#' an id
LAYOUTS = [
    ["article"], ["main", "article"], ["main"], ["div#content", "article.post"], ["div.container", "div.main-content"],
    ["div#main", "div.entry-content"], ["section.story-body"], ["div.page", "div.post"], ["div.wrapper", "div.article"],
    ["table", "tr", "td.content"], ["div.row", "div.col-8", "div.text"], ["div#page", "main#main", "div.article-body"],
    ["div.site", "div.content-area", "article", "div.entry"], ["div", "div", "div"], ["div", "section"], [],
]
# kinds of page parts that are not the article: containers, and the shape of what they hold
NOISE = {
    "menu": [["nav"], ["div.menu"], ["ul.nav"], ["div#navigation"], ["header", "nav"], ["div.navbar"], ["div.breadcrumbs"],
             ["nav.pagination"], ["div.topbar"], ["div.tags"]],
    "header": [["header"], ["div.header"], ["div#masthead"], ["header.site-header"], ["div.banner"]],
    "footer": [["footer"], ["div.footer"], ["div#footer"], ["footer.site-footer"], ["div.copyright"], ["div.bottom"]],
    "sidebar": [["aside"], ["div.sidebar"], ["div#sidebar"], ["aside.widget"], ["div.related"], ["div.rail"],
                ["section.recommended"], ["div.col-4"], ["td.side"]],
    "notice": [["div.cookie-notice"], ["div#cookie-banner"], ["div.notice"], ["div.alert"], ["div.gdpr", "div.modal"],
               ["div.popup"], ["dialog"], ["div.consent"], ["section.newsletter"]],
    "advert": [["div.ad"], ["div.ads"], ["div.advert"], ["div.advertisement"], ["ins.adsbygoogle"], ["div#ad-top"],
               ["div.sponsored"], ["aside.promo"], ["div.promotion"]],
    "form": [["form"], ["div.login", "form"], ["form.search"], ["div.subscribe", "form"], ["div.signup"], ["fieldset"]],
    "comments": [["section.comments"], ["div#comments"], ["ol.commentlist", "li.comment"], ["div.comment", "div.body"],
                 ["section#respond"], ["div.disqus"], ["div.replies"], ["div.discussion"], ["ul.reader-comments", "li"]],
    "share": [["div.share"], ["div.social"], ["ul.sharing"]],
}
PHRASES = {
    "notice": ["We use cookies to improve your experience.", "Accept all", "This site uses cookies", "Read our privacy policy."],
    "form": ["Search", "Your email", "Password", "Sign in", "Subscribe", "Send", "Name"],
    "comments": ["Comments", "Reply", "Leave a comment", "2 comments", "says:"],
    "share": ["Share", "Tweet", "Share on Facebook", "Print"],
    "advert": ["Advertisement", "Sponsored", "Buy now", "Ad"],
    "footer": ["All rights reserved", "© 2024", "Contact", "Terms of use", "Privacy"],
    "sidebar": ["Related articles", "Most read", "Popular", "See also"],
    "menu": ["Home", "News", "About", "Contact", "Next", "Previous"],
    "header": ["Home", "Sign in", "Subscribe"],
}


def _names(element: str) -> tuple[str, ...]:
    tag, *rest = re.split(r"(?=[.#])", element)
    return (tag, *(f"{'c' if r[0] == '.' else 'i'}:{w}" for r in rest for w in re.findall(r"[a-z]+|[0-9]+", r)))


def _path(*elements: str) -> tuple[str, ...]:
    return tuple(x for e in ("html", "body", *elements) for x in _names(e))


def make_page(rng, main: list[str], other: list[str]) -> tuple[list[Block], list[int]]:
    """A generated page: its blocks, and 1 for each that belongs to the article."""
    def pick(items):
        return items[int(rng.integers(len(items)))]

    def some_words(most):
        words = pick(main if rng.random() < 0.5 else other).split()
        at = int(rng.integers(len(words)))
        return " ".join(words[at:at + int(rng.integers(1, most + 1))])

    shell = pick([[], [], ["div.wrapper"], ["div#page"], ["div"]])
    inside = [*shell, *pick(LAYOUTS)]
    if rng.random() < 0.3:             # containers with names that say nothing
        inside = [*shell, *(f"{pick(['div', 'section'])}{pick('.#')}{''.join(pick('abdeiklmnorstu') for _ in range(6))}"
                            for _ in range(int(rng.integers(1, 3))))]
    blocks: list[Block] = []
    marks: list[int] = []

    def add(elements, text, mark, linked=False):
        if text:
            blocks.append(Block(_path(*elements), text, len(text) if linked else 0))
            marks.append(mark)

    def noise(kind, base):
        box = [*base, *pick(NOISE[kind])]
        phrases = PHRASES[kind]
        if kind in ("menu", "share"):
            for _ in range(int(rng.integers(2, 9))):
                add([*box, *pick([["ul", "li"], ["li"], ["div"], []]), "a"],
                    pick(phrases) if rng.random() < 0.3 else some_words(2), 0, rng.random() < 0.9)
        elif kind == "comments":
            if rng.random() < 0.6:
                add([*box, pick(["h2", "h3", "h4"])], pick(phrases), 0)
            for _ in range(int(rng.integers(1, 6))):
                add([*box, *pick([["p"], ["div.comment", "p"], ["li"], []])], pick(main), 0)
        elif kind == "sidebar":
            add([*box, "h3"], pick(phrases) if rng.random() < 0.6 else some_words(4), 0)
            for _ in range(int(rng.integers(1, 6))):
                link = rng.random() < 0.7
                add([*box, *pick([["ul", "li"], ["p"], ["div"]]), *(["a"] if link else [])],
                    some_words(10) if link else pick(other), 0, link)
        elif kind == "form":
            for _ in range(int(rng.integers(1, 4))):
                add([*box, *pick([["label"], ["p"], ["div"]])], pick(phrases) if rng.random() < 0.7 else some_words(4), 0)
        else:
            for _ in range(int(rng.integers(1, 4))):
                text = pick(phrases) if rng.random() < 0.4 else pick(other) if rng.random() < 0.7 else some_words(12)
                inner = [["h1"], ["a"], ["div"], []] if kind == "header" else [["p"], ["div"], [], []]
                add([*box, *pick(inner)], text, 0, rng.random() < 0.15)

    for kind in ("notice", "header", "menu", "advert", "form", "menu"):
        if rng.random() < 0.4:
            noise(kind, shell)
    if rng.random() < 0.75:
        title = pick(main)[:60]
        add([*inside, *pick([["h1"], ["h1"], ["h2"], ["header", "h1"]])], title, 1)
    for k in range(int(rng.integers(1, 14))):
        if k and rng.random() < 0.07:
            noise(pick(["advert", "share", "form", "sidebar", "notice"]), inside)
        kind = rng.random()
        if kind < 0.8:
            add([*inside, *pick([["p"], ["p"], ["p"], ["p", "b"], ["div"], ["section", "p"]])], pick(main), 1,
                rng.random() < 0.03)
        elif kind < 0.88:
            add([*inside, pick(["h2", "h3"])], some_words(6), 1)
        elif kind < 0.96:
            for _ in range(int(rng.integers(1, 5))):
                add([*inside, *pick([["ul", "li"], ["ol", "li"], ["blockquote"], ["blockquote", "p"], ["pre"], ["figure", "figcaption"], ["table", "tr", "td"], ["dl", "dd"]])],
                    some_words(20), 1)
        else:
            add(inside, pick(main), 1)
    if rng.random() < 0.3:
        noise("comments", inside if rng.random() < 0.4 else shell)
    for kind in ("share", "sidebar", "comments", "advert", "form", "menu", "footer", "notice"):
        if rng.random() < 0.35:
            noise(kind, shell if rng.random() < 0.85 else inside)
    return blocks, marks


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(x) for x in pages)
    x = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for i, one in enumerate(pages):
        x[:len(one), i] = one
        mask[:len(one), i] = 1
    return x, mask


def fit(main: list[str], other: list[str], pages: int = TRAIN_PAGES, epochs: int = 6, seed: int = 5) -> Labeller:
    """Train on generated pages whose texts come from the two pools."""
    rng = np.random.default_rng(seed)
    model = Labeller()
    p = model.params
    made = [make_page(rng, main, other) for _ in range(pages)]
    made = [(b, m) for b, m in made if b]
    ready = []
    for blocks, marks in made:
        ids, bounds = word_buckets([b.text for b in blocks])
        ready.append(([path_buckets(b.path) for b in blocks],
                      [ids[a:z] for a, z in zip(bounds[:-1], bounds[1:], strict=True)], counts(blocks),
                      np.array(marks, np.float32)))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step, total = 0, epochs * -(-len(ready) // 32)
    for _ in range(epochs):
        order = rng.permutation(len(ready))
        for k in range(0, len(order), 32):
            own = [ready[i] for i in order[k:k + 32]]
            xs = []
            for paths, words, numbers, _ in own:
                path = np.stack([p["path"][q].mean(axis=0) for q in paths])
                word = np.stack([p["word"][w].mean(axis=0) if len(w) else np.zeros(WORD_DIM, np.float32) for w in words])
                xs.append(np.concatenate([path, word, numbers], axis=1))
            x, mask = _padded(xs)
            y = np.zeros_like(mask)
            for i, one in enumerate(own):
                y[:len(one[3]), i] = one[3]
            grads, dx = model.gradients(x, mask, y)
            dp, dw = np.zeros_like(p["path"]), np.zeros_like(p["word"])
            for i, (paths, words, _, _) in enumerate(own):
                for t, (q, w) in enumerate(zip(paths, words, strict=True)):
                    np.add.at(dp, q, dx[t, i, :PATH_DIM] / len(q))
                    if len(w):
                        np.add.at(dw, w, dx[t, i, PATH_DIM:PATH_DIM + WORD_DIM] / len(w))
            grads |= {"path": dp, "word": dw}
            step += 1
            rate = 0.02 * (1 - step / (total + 1))
            for name, g in grads.items():
                m, v = moments[name]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p[name] -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    return model


MAIN_TAGS = {"article", "main"}
OTHER_TAGS = {"nav", "footer", "header", "aside", "form"}


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE_PAGES) -> Labeller:
    """Labeller whose training texts come from about ``sample`` pages (by a hash of the id)."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html")).filter("html IS NOT NULL")
    n = rows.count()
    draw = F.pmod(F.xxhash64("id", F.lit("html sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    got = rows.filter(draw < min(1.0, sample / max(n, 1))).collect()
    main, other = [], []
    for r in sorted(got, key=lambda r: (str(r["id"]), r["html"])):
        for b in leaf_blocks(r["html"]):
            tags = set(b.path)
            if tags & OTHER_TAGS or b.linked > len(b.text) // 2:
                other.append(b.text[:2000])
            elif tags & MAIN_TAGS or len(b.text) > 200:
                main.append(b.text[:2000])
    plain = ["It was a long day and the town was quiet.", "Nobody had seen the letter before it was read out."]
    return fit(main or plain, other or ["Read more", "Contact us", *plain])


def main_text(pages: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """(page_id, url, text) for every row of ``pages``: the blocks marked as main text, joined by a line break.

    The whole html is read.  NULL, empty and text-free pages give an empty
    text.  Repeated rows give equal results, NULL ids and urls are passed
    through, other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).cast("string").alias("html"))

    def run(batches):
        cache: dict = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                pages = [leaf_blocks(h or "") for h in part.column("html").to_pylist()]
                texts = [""] * len(pages)
                order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
                while order:
                    # pages of similar length together, and few of them when they are long
                    size = max(1, min(64, 20_000 // len(pages[order[-1]])))
                    own, order = order[-size:], order[:-size]
                    flat = model.inputs([b for i in own for b in pages[i]], cache)
                    flat[:, PATH_DIM + WORD_DIM:] = np.concatenate([counts(pages[i]) for i in own])
                    cuts = np.cumsum([len(pages[i]) for i in own])[:-1]
                    x, mask = _padded(np.split(flat, cuts))
                    probability = model.probabilities(x, mask)
                    for j, i in enumerate(own):
                        texts[i] = "\n".join(b.text for b, q in zip(pages[i], probability[:, j], strict=False) if q >= 0.5)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                                                 ["page_id", "url", "text"])

    schema = StructType([rows.schema["page_id"], rows.schema["url"], *StructType.fromDDL("text string")])
    return rows.mapInArrow(run, schema)
