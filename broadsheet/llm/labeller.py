"""A recurrent labeller of leaf blocks: which blocks of a page are its article.

Each block is read as a vector of its tag path (hashed element names and parts of class, id and role) and its hashed words, plus
a few shapes. A bidirectional LSTM in numpy runs over the whole sequence of a page, so every block is judged with the document
around it. The model is trained here, on ``TRAINING_PAGES`` composed pages whose blocks have known labels: layouts of all usual kinds, some of whose
names mean nothing, with words taken from a bounded sample of ``SAMPLE_PAGES`` pages. Inference batches pages of like length; all blocks are labelled.
"""

from __future__ import annotations

import random
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .blocks import Block, leaf_blocks, path_marks
from .words import WHITE, text_words

PATH_DIMS, WORD_DIMS, SHAPE_DIMS = 256, 32, 6
DIMS = PATH_DIMS + WORD_DIMS + SHAPE_DIMS
HIDDEN = 16
TRAINING_PAGES = 1600
SAMPLE_PAGES = 200
EPOCHS = 7
#: Words say less than paths: how much their vector counts, and how often training hides it.
WORD_SCALE, HIDE_WORDS = 0.5, 0.5
#: Shares of names that are made up, so that the rest of a page has to tell, and of pages laid out by a table.
STRANGE_NAMES, TABLE_LAYOUTS = 0.25, 0.08
BATCH_BLOCKS = 1 << 14


@lru_cache(maxsize=1 << 16)
def _path_places(path_id: tuple) -> tuple[int, ...]:
    places = set()
    for depth, marks in enumerate(path_id):
        for mark in marks:
            places.add(zlib.crc32(mark.encode()) % PATH_DIMS)
            if depth == 0:
                places.add(zlib.crc32(b"leaf " + mark.encode()) % PATH_DIMS)
    return tuple(places)


def features(pages: list[list[Block]]) -> np.ndarray:
    """One row per block of all pages."""
    blocks = [b for page in pages for b in page]
    x = np.zeros((len(blocks), DIMS), np.float32)
    if not blocks:
        return x
    known: dict[int, tuple[int, ...]] = {}
    rows, columns = [], []
    for i, b in enumerate(blocks):
        places = known.get(id(b.path))
        if places is None:
            places = known[id(b.path)] = _path_places(tuple(path_marks(b.path)))
        rows.extend([i] * len(places))
        columns.extend(places)
    x[rows, columns] = 1
    hashes, counts = text_words(pa.array([b.text for b in blocks], pa.large_string()), WHITE)
    owner = np.repeat(np.arange(len(blocks)), counts)
    bags = np.bincount(owner * WORD_DIMS + (hashes % np.uint64(WORD_DIMS)).astype(np.int64), minlength=len(blocks) * WORD_DIMS)
    x[:, PATH_DIMS : PATH_DIMS + WORD_DIMS] = WORD_SCALE * bags.reshape(-1, WORD_DIMS) / np.maximum(counts, 1)[:, None]
    size = np.array([len(b.text) for b in blocks], np.float32)
    at = np.concatenate([np.arange(len(p)) / len(p) for p in pages if p])
    shapes = [np.log1p(size) / 8, np.array([b.linked for b in blocks]) / size, np.log1p(counts) / 6, at, [b.text[-1] in ".!?" for b in blocks], size < 30]
    x[:, PATH_DIMS + WORD_DIMS :] = np.stack([np.asarray(s, np.float32) for s in shapes], axis=1)
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Weights: per direction input, recurrent and bias (gates i, f, o, g), and the output layer."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.w = {"out": init(2 * HIDDEN, 1), "out_b": np.zeros(1, np.float32)}
        for d in "fb":
            self.w |= {d + "x": init(DIMS, 4 * HIDDEN), d + "h": init(HIDDEN, 4 * HIDDEN), d + "c": np.zeros(4 * HIDDEN, np.float32)}
            self.w[d + "c"][HIDDEN : 2 * HIDDEN] = 1

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States over time; where ``mask`` is 0 the state stays as it was."""
        steps, n = mask.shape
        into = x @ self.w[d + "x"] + self.w[d + "c"]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        states, trace = np.zeros((steps, n, HIDDEN), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = into[t] + h @ self.w[d + "h"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o, g = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            if keep:
                trace.append((t, h, c, i, f, o, g, tanh_c, m))
            h, c = m * (o * tanh_c) + (1 - m) * h, m * new_c + (1 - m) * c
            states[t] = h
        return states, trace

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """x (steps, pages, DIMS) to log odds (steps, pages)."""
        states = np.concatenate([self._run(d, x, mask, False)[0] for d in "fb"], axis=2)
        return (states @ self.w["out"] + self.w["out_b"])[..., 0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        runs = {d: self._run(d, x, mask, True) for d in "fb"}
        states = np.concatenate([runs[d][0] for d in "fb"], axis=2)
        p = _sigmoid((states @ self.w["out"] + self.w["out_b"])[..., 0])
        total = mask.sum()
        loss = -float((mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / total)
        error = (mask * (p - y) / total).astype(np.float32)
        grads = {"out": np.tensordot(states, error, ([0, 1], [0, 1]))[:, None], "out_b": error.sum(keepdims=True)[0, :1]}
        d_states = error[..., None] * self.w["out"][:, 0]
        for k, d in enumerate("fb"):
            d_out = d_states[..., k * HIDDEN : (k + 1) * HIDDEN]
            dh = dc = np.zeros(d_out.shape[1:], np.float32)
            dz_all = np.zeros((*mask.shape, 4 * HIDDEN), np.float32)
            w_h, g_h = self.w[d + "h"], np.zeros_like(self.w[d + "h"])
            for t, h, c, i, f, o, g, tanh_c, m in reversed(runs[d][1]):
                dh = dh + d_out[t]
                live_h, live_c = dh * m, dc * m
                d_cell = live_c + live_h * o * (1 - tanh_c**2)
                dz = np.concatenate([d_cell * g * i * (1 - i), d_cell * c * f * (1 - f), live_h * tanh_c * o * (1 - o), d_cell * i * (1 - g**2)], axis=1)
                dz_all[t] = dz
                g_h += h.T @ dz
                dh = dz @ w_h.T + dh * (1 - m)
                dc = d_cell * f + dc * (1 - m)
            grads |= {d + "x": np.tensordot(x, dz_all, ([0, 1], [0, 1])), d + "h": g_h, d + "c": dz_all.sum((0, 1))}
        return loss, grads

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For every page, which of its blocks belong to the article."""
        out = [np.zeros(len(p), bool) for p in pages]
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        start = 0
        while start < len(order):
            end = start + 1
            while end < len(order) and (end + 1 - start) * len(pages[order[end]]) <= BATCH_BLOCKS:
                end += 1
            chosen = order[start:end]
            x, mask = padded([pages[i] for i in chosen])
            positive = self.scores(x, mask) > 0
            for column, i in enumerate(chosen):
                out[i] = positive[: len(pages[i]), column]
            start = end
        return out


def padded(pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), DIMS), np.float32), np.zeros((steps, len(pages)), np.float32)
    rows, at = features(pages), 0
    for k, page in enumerate(pages):
        x[: len(page), k] = rows[at : at + len(page)]
        mask[: len(page), k] = 1
        at += len(page)
    return x, mask


class _Composer:
    """Pages of usual layouts; the text of a block of the article begins with a mark that tells its label."""

    MARK = "⁣"
    NAMES = {
        "nav": ["nav", "menu", "navbar", "main-menu", "topnav", "navigation", "breadcrumb", "breadcrumbs", "toc", "pagination", "pager", "tabs"],
        "header": ["header", "masthead", "site-header", "page-header", "topbar", "branding", "logo", "site-title"],
        "footer": ["footer", "site-footer", "page-footer", "bottom", "copyright", "legal", "colophon", "credits"],
        "aside": ["sidebar", "aside", "related", "recommended", "widget", "rail", "more-stories", "trending", "popular", "teaser", "read-more", "author-bio", "tags"],
        "notice": ["notice", "cookie", "cookie-banner", "consent", "gdpr", "alert", "warning", "popup", "modal", "overlay", "paywall", "subscribe-notice"],
        "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "banner", "adbox", "sponsor"],
        "form": ["form", "search", "login", "newsletter", "signup", "contact-form", "subscribe"],
        "comments": ["comments", "comment-list", "discussion", "responses", "replies", "disqus", "comment", "reader-comments"],
        "share": ["share", "social", "sharing", "follow", "toolbar"],
    }
    GOOD = ["article", "content", "main", "post", "entry", "story", "article-body", "post-content", "entry-content", "text", "body", "main-content", "body-text", "news"]
    PLAIN = ["wrap", "container", "row", "inner", "page", "col", "outer", "box", "site", "section", "block"]

    def __init__(self, words: list[str], seed: int):
        self.words, self.r = words or ["word"], random.Random(seed)

    def text(self, low: int, high: int) -> str:
        got = self.r.choices(self.words, k=self.r.randint(low, high))
        return " ".join(got).capitalize() + self.r.choice([".", ".", ".", "", "!", "?"])

    def strange(self) -> str:
        return "".join(self.r.choices("abcdefghijklmnopqrstuvwxyz", k=self.r.randint(3, 12)))

    def name(self, names: list[str]) -> str:
        kind = self.r.choice(["class", "class", "id"])
        value = self.r.choice(names) if self.r.random() >= STRANGE_NAMES else self.strange()
        if kind == "class" and self.r.random() < 0.3:
            value += " " + self.r.choice(self.PLAIN)
        return f'{kind}="{value}"'

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{self.r.randint(1, 99)}">{self.text(1, 3)}</a>' for _ in range(self.r.randint(low, high))]
        style = self.r.random()
        if style < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return "".join(f"<div>{x}</div>" for x in items) if style < 0.8 else " | ".join(items)

    def noise(self, kind: str) -> str:
        r = self.r
        tag = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comments": "section"}.get(kind, "div")
        plain = r.random() < 0.25 and kind in ("nav", "header", "footer", "aside", "form")
        attributes = "" if plain else " " + self.name(self.NAMES[kind])
        tag = tag if plain or r.random() < 0.5 else r.choice(["div", "section", "div", "span" if kind == "ad" and r.random() < 0.1 else "div"])
        inner = {
            "nav": lambda: self.links(2, 9),
            "header": lambda: r.choice([f"<h1>{self.text(1, 4)}</h1>", f"<h2>{self.text(1, 4)}</h2>", f"<div>{self.text(1, 5)}</div>", f"<p>{self.text(2, 8)}</p>"]) + r.choice(["", self.links(1, 4)]),
            "footer": lambda: r.choice(["&copy; ", "", "&copy; 2024 "]) + self.text(2, 25) + r.choice(["", self.links(1, 5), f"<p>{self.text(3, 20)}</p>"]),
            "aside": lambda: f"<h{r.randint(2, 4)}>{self.text(1, 4)}</h4>" + "".join(r.choice([f"<p>{self.text(4, 40)}</p>", self.links(2, 6)]) for _ in range(r.randint(1, 3))),
            "notice": lambda: r.choice([f"<p>{self.text(5, 40)}</p>", self.text(5, 40)]) + r.choice(["", f"<button>{self.text(1, 2)}</button>"]),
            "ad": lambda: r.choice([self.text(2, 25), f"<p>{self.text(2, 40)}</p>", f'<a href="/x">{self.text(2, 10)}</a>']),
            "form": lambda: f"<label>{self.text(1, 3)}</label><input><button>{self.text(1, 2)}</button>" + r.choice(["", f"<p>{self.text(4, 20)}</p>"]),
            "comments": lambda: f"<h3>{self.text(1, 3)}</h3>"
            + "".join(r.choice([f'<div class="comment"><b>{self.text(1, 2)}</b><p>{self.text(3, 90)}</p></div>', f"<li><p>{self.text(3, 90)}</p></li>", f"<p>{self.text(3, 90)}</p>"]) for _ in range(r.randint(1, 6))),
            "share": lambda: self.links(2, 5),
        }[kind]()
        return f"<{tag}{attributes}>{inner}</{tag}>"

    def content(self) -> list[str]:
        r, m = self.r, self.MARK
        out = []
        p = f'<p class="{self.strange()}">' if r.random() < 0.15 else "<p>"
        for _ in range(r.randint(1, 10)):
            kind = r.random()
            if kind < 0.7:
                text = self.text(1, r.choice([3, 12, 50, 160]))
                form = r.choice([p + "{}</p>", p + "{}</p>", p + "{}", "<div>{}</div>", "<p><b>{}<br>"]).format(m + text)
                out.extend([form] * (r.randint(2, 5) if r.random() < 0.1 else 1))
            elif kind < 0.8:
                out.append(f"<h{r.randint(2, 4)}>{m}{self.text(1, 9)}</h2>")
            elif kind < 0.87:
                out.append("<ul>" + "".join(f"<li>{m}{self.text(1, 30)}</li>" for _ in range(r.randint(1, 6))) + "</ul>")
            elif kind < 0.92:
                out.append(f"<blockquote>{r.choice(['', '<p>'])}{m}{self.text(4, 40)}</blockquote>")
            elif kind < 0.96:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{m}{self.text(1, 5)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 3))) + "</table>")
            else:
                out.append(r.choice([f"<pre>{m}{self.text(2, 30)}</pre>", f"<figure><img><figcaption>{m}{self.text(2, 15)}</figcaption></figure>"]))
        return out

    def page(self) -> str:
        r, m = self.r, self.MARK
        body = self.content()
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            body.insert(r.randint(0, len(body)), self.noise(r.choice(["ad", "ad", "aside", "share", "form", "notice", "nav"])))
        title = f"<h1>{m}{self.text(1, 12)}</h1>"
        title = r.choice([title, title, f"<header>{title}</header>", f'<div class="title">{title}</div>', ""])
        if r.random() < 0.15:
            body.append(self.noise("comments"))
        style = r.random()
        article = title + "".join(body)
        if style < 0.55:
            article = f"<article{r.choice(['', ' ' + self.name(self.GOOD)])}>{article}</article>"
        elif style < 0.8:
            article = f"<div {self.name(self.GOOD)}>{article}</div>"
        elif style < 0.9:
            article = f"<main>{article}</main>"
        if r.random() < 0.3:
            article = r.choice(["<main>{}</main>", "<section>{}</section>", f"<div {self.name(self.PLAIN)}>{{}}</div>", f"<div {self.name(self.GOOD)}>{{}}</div>"]).format(article)
        before = [self.noise(k) for k in ("header", "nav", "ad", "notice", "form", "aside") if r.random() < (0.75 if k in ("nav", "ad") else 0.35)]
        after = [self.noise(k) for k in ("comments", "aside", "share", "ad", "nav", "form", "notice", "footer") if r.random() < (0.85 if k == "footer" else 0.3)]
        if r.random() < 0.3:
            r.shuffle(before)
        html = "".join(before) + article + "".join(after)
        if r.random() < TABLE_LAYOUTS:
            cells = [f"<td>{r.choice(['<br>'.join(f'<a href=/{i}>{self.text(1, 3)}</a>' for i in range(r.randint(2, 7))), self.noise('nav')])}</td>", f"<td>{article}</td>"]
            if r.random() < 0.3:
                cells.append(f"<td>{self.noise('aside')}</td>")
            end = r.choice(["", f"<tr><td colspan=2>{r.choice(['', '&copy; '])}{self.text(1, 12)}</td></tr>"])
            html = f"<table>{r.choice(['', f'<tr><td>{self.text(1, 4)}</td></tr>'])}<tr>{''.join(cells)}</tr>{end}</table>"
        if r.random() < 0.3:
            html = f"<div {self.name(self.PLAIN)}>{html}</div>"
        html = f"<html><head><title>{self.text(1, 6)}</title></head><body>{html}</body></html>"
        return html[: r.randint(len(html) // 2, len(html))] if r.random() < 0.08 else html


def composed(words: list[str], n: int, seed: int) -> tuple[list[list[Block]], list[np.ndarray]]:
    """Composed pages with their labels; the marks are taken out again."""
    composer = _Composer(words, seed)
    pages, labels = [], []
    while len(pages) < n:
        blocks = leaf_blocks(composer.page())
        if not blocks:
            continue
        labels.append(np.array([composer.MARK in b.text for b in blocks], np.float32))
        for b in blocks:
            b.text = b.text.replace(composer.MARK, "").strip() or "-"
        pages.append(blocks)
    return pages, labels


def train(words: list[str], n_pages: int = TRAINING_PAGES, epochs: int = EPOCHS, seed: int = 1) -> Labeller:
    """A labeller fitted by Adam; the same words give the same one."""
    pages, labels = composed(words, n_pages, seed)
    model, rng = Labeller(seed), np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.w.items()}
    order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
    batches = []
    for i in range(0, len(order), 24):
        chosen = order[i : i + 24]
        x, mask = padded([pages[k] for k in chosen])
        y = np.zeros_like(mask)
        for c, k in enumerate(chosen):
            y[: len(labels[k]), c] = labels[k]
        batches.append((x, mask, y))
    step = 0
    for epoch in range(epochs):
        for k in rng.permutation(len(batches)):
            step += 1
            x, mask, y = batches[k]
            hidden = rng.random(mask.shape) < HIDE_WORDS
            x = x.copy()
            x[..., PATH_DIMS : PATH_DIMS + WORD_DIMS][hidden] = 0
            _, grads = model.gradients(x, mask, y)
            rate = 0.02 * (1 - epoch / epochs) + 0.001
            for name, g in grads.items():
                m, v = moments[name]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                model.w[name] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model
