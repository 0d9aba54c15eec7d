"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks; a bidirectional LSTM, written in numpy, reads the sequence of their tag-path and
hashed-word vectors in both directions and says for every block, from the whole page around it, whether it belongs to
the article. The text is the article's blocks in page order.

There are no labels, so the labeller is trained on pages it knows the answer for: a bounded sample of pages (about
``SAMPLE_PAGES``, a documented bound) labelled by the elements their blocks stand in, and the same blocks dressed anew in
random page layouts, with menus, headers, footers, sidebars, notices, adverts, forms and comments around and inside the
article. Training takes seconds and gives the same weights every time; it reads pages whole, in stretches of
``TRAINING_BLOCKS``. Every page is then labelled whole.

* A null or empty page, and one without article blocks, has an empty text of 0 characters. A null url stays null.
* Unclosed and misnested elements end with the element they stand in; ``p`` ends where a block begins. A comment that is
  never closed goes on to the end of the page; a tag that is never closed goes, up to its first ``>``, whatever quotes it has.
* Repeated pages give repeated rows. Without pages the result is empty; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropforge.llm.html_blocks import N_FEATURES, NAME_STEMS, Element, blocks_of, down_to, vectors
from dropforge.llm.tables import table
from dropforge.llm.words import text_slices

SAMPLE_PAGES = 240
HIDDEN = 16
ROUNDS = 16
DRESSED = 4
TRAINING_BLOCKS = 120
_KINDS = list(NAME_STEMS)
_APART_TAGS = {"nav", "footer", "aside", "form", "button", "label", "dialog"}
_APART_NAMES = {w for k in ("menu", "head", "foot", "side", "notice", "ad", "form", "comment", "share") for w in NAME_STEMS[k].split()}


def element_label(element: Element | None) -> int:
    """1 in an article or main element and nothing set apart in it, 0 elsewhere."""
    for e in down_to(element, lambda e: e.seen is not None):
        above = e.parent.seen if e.parent is not None else "outside"
        if above == "apart" or e.tag in _APART_TAGS or _APART_NAMES & set(e.named) or (e.tag == "header" and above == "outside"):
            e.seen = "apart"
        else:
            e.seen = "inside" if e.tag in ("article", "main") or "main" in e.named or "articlebody" in e.named else above
    return int(element is not None and element.seen == "inside")


class Layouts:
    """Dresses texts in random page layouts of which it knows what the article is."""

    def __init__(self, seed: int = 3):
        self.rnd = np.random.default_rng(seed)

    def pick(self, *options):
        return options[self.rnd.integers(len(options))]

    def named(self, kind: str) -> str:
        words = NAME_STEMS[kind].split()
        name = self.pick(*words) + self.pick("", "", "-" + self.pick("box", "wrap", "area", "inner", "block", "list", "1"))
        return f' {self.pick("class", "class", "id")}="{self.pick("", "", "site-", "c-")}{name}"'

    def apart(self, kind: str, texts: list[str]) -> str:
        """A piece of page that is not article."""
        text = self.pick(*texts)
        short = " ".join(text.split()[: int(self.rnd.integers(1, 9))])
        items = [" ".join(self.pick(*texts).split()[: int(self.rnd.integers(1, 4))]) for _ in range(self.rnd.integers(2, 9))]
        links = "".join(f'<li><a href="/x">{i}</a></li>' for i in items)
        plain = lambda t: self.pick(f"<p>{t}</p>", f"{t}", f"<span>{t}</span>", f"<p>{t}</p><p>{short}</p>")
        div = self.pick("div", "div", "section")
        if kind == "menu":
            return self.pick(f"<nav><ul>{links}</ul></nav>", f"<nav{self.named('menu')}>{links}</nav>", f"<{div}{self.named('menu')}><ul>{links}</ul></{div}>", f"<ul{self.named('menu')}>{links}</ul>")
        if kind == "head":
            return self.pick(f"<header>{plain(short)}</header>", f"<header{self.named('head')}><h1>{short}</h1>{plain(text)}</header>", f"<{div}{self.named('head')}>{plain(short)}</{div}>")
        if kind == "foot":
            return self.pick(f"<footer>&copy; {short}</footer>", f"<footer{self.named('foot')}>{plain(text)}<ul>{links}</ul></footer>", f"<{div}{self.named('foot')}>{plain(text)}</{div}>")
        if kind == "side":
            return self.pick(f"<aside><h3>{short}</h3>{plain(text)}</aside>", f"<aside{self.named('side')}><ul>{links}</ul></aside>", f"<{div}{self.named('side')}><h3>{short}</h3><ul>{links}</ul>{plain(text)}</{div}>")
        if kind == "form":
            return self.pick(f"<form>{plain(short)}<label>{short}</label><input><button>{items[0]}</button></form>", f"<{div}{self.named('form')}><form><label>{short}</label></form>{plain(short)}</{div}>", f"<form{self.named('form')}>{plain(text)}</form>")
        if kind == "comment":
            each = "".join(f"<{t}{self.named('comment')}>{plain(self.pick(*texts))}</{t}>" for t in [self.pick("div", "li", "article", "p")] * int(self.rnd.integers(1, 5)))
            return self.pick(f"<{div}{self.named('comment')}><h3>{short}</h3>{each}</{div}>", f"<ol{self.named('comment')}>{each}</ol>", f"<{div}{self.named('comment')}>{plain(text)}{plain(short)}</{div}>")
        tag = self.pick("div", "div", "section", "aside")
        return f"<{tag}{self.named(kind)}>{self.pick(text, plain(text), plain(short))}</{tag}>"

    def page(self, article: list[str], texts: list[str]) -> str:
        """A page around ``article``; its own blocks are marked with an attribute the labeller does not read."""
        kinds = ["menu", "head", "foot", "side", "notice", "ad", "form", "comment", "share"]
        body = []
        for i, text in enumerate(article):
            tag = self.pick("h1", "h2", "p") if i == 0 else self.pick("p", "p", "p", "p", "p", "h2", "blockquote", "li", "div", "pre")
            inner = self.pick(text, text, text, f"<b>{text}</b>", f"<a href='/y'>{text}</a>" if len(text) < 60 else text)
            block = f"<{tag} data-own=1>{inner}</{tag}>"
            body.append({"li": f"<ul>{block}</ul>"}.get(tag, block) if i or self.rnd.random() < 0.8 else f"<header data-own=1>{block}</header>")
        for _ in range(self.rnd.integers(0, 3)):
            body.insert(int(self.rnd.integers(0, len(body) + 1)), self.apart(self.pick("ad", "share", "side", "notice", "form"), texts))
        if self.rnd.random() < 0.25:
            body.append(self.apart("comment", texts))
        inside = "".join(body)
        tag = self.pick("article", "article", "article", "main", "div", "div", "section")
        name = self.named("content") if tag in ("div", "section") or self.rnd.random() < 0.4 else ""
        core = f"<{tag}{name}>{inside}</{tag}>"
        if self.rnd.random() < 0.4:
            outer = self.pick("main", "div", "section")
            core = f"<{outer}{self.pick('', self.named('content'))}>{core}</{outer}>"
        around = lambda n: "".join(self.apart(self.pick(*kinds), texts) for _ in range(self.rnd.integers(0, n)))
        wrap = self.pick("{}", "{}", "<div id='wrapper'>{}</div>", "<div class='container'><div class='row'>{}</div></div>")
        after = self.apart("comment", texts) if self.rnd.random() < 0.35 else ""
        return "<html><body>" + wrap.format(around(5) + core + after + around(4)) + "</body></html>"


class Labeller:
    """A bidirectional LSTM with one output per block."""

    def __init__(self, seed: int = 1):
        rnd = np.random.default_rng(seed)
        self.p = {}
        for side in "fb":
            self.p["w" + side] = rnd.normal(0, 1 / np.sqrt(N_FEATURES), (N_FEATURES, 4 * HIDDEN)).astype(np.float32)
            self.p["u" + side] = rnd.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
            self.p["c" + side] = bias
        self.p["o"] = rnd.normal(0, 0.1, (2 * HIDDEN,)).astype(np.float32)
        self.p["d"] = rnd.normal(0, 0.1, (N_FEATURES,)).astype(np.float32)
        self.p["e"] = np.zeros(1, np.float32)

    def _run(self, x, mask, side, keep):
        """One direction over padded sequences (time, page, feature); states only move where there is a block."""
        t, n, _ = x.shape
        u = self.p["u" + side]
        pre = x @ self.p["w" + side] + self.p["c" + side]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, past = np.zeros((t, n, HIDDEN), np.float32), []
        for k in range(t) if side == "f" else range(t - 1, -1, -1):
            z = pre[k] + h @ u
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            g = np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            m = mask[k][:, None]
            new_c = f * c + i * g
            th = np.tanh(new_c)
            if keep:
                past.append((k, i, f, o, g, c, h, th, m))
            c = np.where(m, new_c, c)
            h = np.where(m, o * th, h)
            out[k] = h
        return out, past

    def logits(self, x, mask, keep=False):
        forward, pf = self._run(x, mask, "f", keep)
        backward, pb = self._run(x, mask, "b", keep)
        both = np.concatenate([forward, backward], 2)
        return both @ self.p["o"] + x @ self.p["d"] + self.p["e"][0], both, (pf, pb)

    def gradients(self, x, mask, y):
        z, both, past = self.logits(x, mask, keep=True)
        error = np.where(mask, 1 / (1 + np.exp(-z)) - y, 0).astype(np.float32) / max(1, mask.sum())
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["o"] = np.einsum("tn,tnh->h", error, both)
        grad["d"] = np.einsum("tn,tnf->f", error, x)
        grad["e"] = np.array([error.sum()], np.float32)
        for side, steps, part in (("f", past[0], slice(0, HIDDEN)), ("b", past[1], slice(HIDDEN, None))):
            dh, dc = np.zeros((x.shape[1], HIDDEN), np.float32), np.zeros((x.shape[1], HIDDEN), np.float32)
            u, dz_all = self.p["u" + side], np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            for k, i, f, o, g, c, h, th, m in reversed(steps):
                dh = dh + error[k][:, None] * self.p["o"][part]
                live_h, live_c = np.where(m, dh, 0), np.where(m, dc, 0)
                dnew = live_c + live_h * o * (1 - th * th)
                dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), live_h * th * o * (1 - o), dnew * i * (1 - g * g)], 1)
                dz_all[k] = dz
                grad["u" + side] += h.T @ dz
                dh, dc = np.where(m, dz @ u.T, dh), np.where(m, dnew * f, dc)
            flat = dz_all.reshape(-1, 4 * HIDDEN)
            grad["w" + side] = x.reshape(-1, N_FEATURES).T @ flat
            grad["c" + side] = flat.sum(0)
        return grad

    def fit(self, sequences, labels, rounds=ROUNDS, batch=24, rate=0.01):
        """Adam steps over batches of pages of like length, in a fixed random order."""
        rnd = np.random.default_rng(9)
        one, two, step = {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        order = np.argsort([len(s) for s in sequences], kind="stable")
        groups = [order[k : k + batch] for k in range(0, len(order), batch)]
        for turn in range(rounds):
            for g in rnd.permutation(len(groups)):
                x, mask = padded([sequences[i] for i in groups[g]])
                y = np.zeros(mask.shape, np.float32)
                for j, i in enumerate(groups[g]):
                    y[: len(labels[i]), j] = labels[i]
                step += 1
                now = rate * (1 - turn / (rounds + 1))
                for k, v in self.gradients(x, mask, y).items():
                    v = np.clip(v, -1, 1)
                    one[k] = 0.9 * one[k] + 0.1 * v
                    two[k] = 0.99 * two[k] + 0.01 * v * v
                    self.p[k] -= now * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def label(self, sequences) -> list[np.ndarray]:
        """For every block of every page whether it is article; pages of like length run together."""
        out = [np.zeros(len(s), bool) for s in sequences]
        order = np.argsort([len(s) for s in sequences], kind="stable")
        start = 0
        while start < len(order):
            stop = start + 1
            while stop < len(order) and len(sequences[order[stop]]) * (stop + 1 - start) <= 8192:
                stop += 1
            own = order[start:stop]
            if len(sequences[own[-1]]):
                x, mask = padded([sequences[i] for i in own])
                z, _, _ = self.logits(x, mask)
                for j, i in enumerate(own):
                    out[i] = z[: len(sequences[i]), j] > 0
            start = stop
        return out


def padded(sequences):
    t = max(len(s) for s in sequences)
    x = np.zeros((t, len(sequences), N_FEATURES), np.float32)
    mask = np.zeros((t, len(sequences)), bool)
    for j, s in enumerate(sequences):
        x[: len(s), j], mask[: len(s), j] = s, True
    return x, mask


def training_pages(pages: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Vectors and labels: the pages by their elements, and their blocks in new layouts."""
    found, labels, layouts = [], [], Layouts()
    read = [b for b in map(blocks_of, pages) if b]
    texts = sorted({b.text for page in read for b in page})
    escape = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")
    texts = [escape(t) for t in texts] or ["Text."]

    def learn(blocks, answer):
        made = vectors(blocks)
        for k in range(0, len(blocks), TRAINING_BLOCKS):
            found.append(made[k : k + TRAINING_BLOCKS])
            labels.append(answer[k : k + TRAINING_BLOCKS])

    for page in read:
        own = np.array([element_label(b.element) for b in page], np.float32)
        if own.any():
            learn(page, own)
        for _ in range(DRESSED):
            n = int(layouts.rnd.integers(1, 12)) if layouts.rnd.random() < 0.8 else int(layouts.rnd.integers(30, TRAINING_BLOCKS))
            article = [layouts.pick(*texts) for _ in range(n)]
            dressed = blocks_of(layouts.page(article, texts).replace(" data-own=1", ' data-own=1 itemprop="zzown"'))
            above = [down_to(b.element, lambda e: False) for b in dressed]
            answer = np.array([any("zzown" in e.named for e in path) for path in above], np.float32)
            for e in (e for path in above for e in path):
                e.named = tuple(w for w in e.named if w != "zzown")
            if len(dressed):
                learn(dressed, answer)
    return found, labels


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Labeller:
    # Different pages, those of the smallest digests: copies are neither counted nor collected.
    digest = F.xxhash64("html", F.lit(23))
    held = pages.where("html IS NOT NULL")
    least = [r[0] for r in held.select(digest.alias("d")).distinct().orderBy("d").limit(sample_pages).collect()]
    found = sorted(r[0] for r in held.where(digest.isin(least)).groupBy(digest.alias("d")).agg(F.min("html").alias("html")).select("html").collect())
    return Labeller().fit(*training_pages(found))


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars``."""
    slim = pages.select("page_id", "url", "html")
    sent = slim.sparkSession.sparkContext.broadcast(train(slim, sample_pages))
    kinds = ", ".join(f"{c} {slim.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))

    def read(batches):
        for batch in batches:
            for part in text_slices(batch, "html"):
                pages = [blocks_of(h) for h in part.column(2).to_pylist()]
                kept = sent.value.label([vectors(p) for p in pages])
                texts = ["\n".join(b.text for b, k in zip(page, keep, strict=True) if k) for page, keep in zip(pages, kept, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return slim.mapInArrow(read, f"{kinds}, text string, n_chars long")


def op3_html_extract(spark, sf_dir) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
