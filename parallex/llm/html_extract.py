"""Main text of web pages by a linear-chain CRF over DOM leaf blocks.

A page is the chain of its leaf blocks. Features of a block are the tags it is
in, the words in their class, id and role, its link share, length and
punctuation; neighbouring labels are tied by the chain. The model is trained on
labelled pages (``training_pages``: layouts written out here with a label for
every block, filled with seeded pseudo-words; their number is a parameter) and a
page is decoded by Viterbi.

NULL and empty pages give an empty text. Pages of any length are handled whole;
repeated rows get equal results. Columns of the input named like the added ones
are replaced.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from parallex.llm.common import add_columns
from parallex.llm.crf import Crf
from parallex.llm.html_blocks import Block, blocks

TRAINING_PAGES = 400
SEED = 6
_STOPS = tuple(".!?\"'»”)…:")


def features(found: list[Block]) -> list[list[str]]:
    out = []
    for b in found:
        n = b.text.count(" ") + 1
        f = ["bias", f"tag:{b.tags[-1] if b.tags else ''}",
             f"links:{0 if not b.linked else 1 if b.linked < 0.4 else 2 if b.linked < 0.8 else 3}",
             f"words:{0 if n < 2 else 1 if n < 5 else 2 if n < 10 else 3 if n < 25 else 4 if n < 60 else 5}",
             f"stop:{b.text.endswith(_STOPS)}"]
        if "©" in b.text:
            f.append("copyright")
        f += [f"in:{t}" for t in set(b.tags) if t not in ("html", "body")]
        f += [f"is:{w}" for w in b.names]
        out.append(f)
    return out


def _words(rng: random.Random, low: int, high: int, end: str = "") -> str:
    parts = ("the", "ra", "lo", "men", "ti", "sa", "ver", "en", "and", "of", "ko", "zu")
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high))).capitalize() + end


def training_pages(n: int = TRAINING_PAGES, seed: int = SEED) -> Iterator[tuple[str, list[int]]]:
    """Labelled pages: the HTML and a label (1: main text) for each leaf block."""
    rng = random.Random(seed)
    pick = rng.choice

    def menu() -> tuple[str, int]:
        k = rng.randint(2, 9)
        links = "".join(f'<li><a href="/{i}">{_words(rng, 1, 2)}</a></li>' for i in range(k))
        return pick(("<nav>{}</nav>", '<div id="menu">{}</div>', '<div class="nav navigation">{}</div>', '<nav class="breadcrumb">{}</nav>',
                     '<div class="top-bar menu">{}</div>', '<div role="navigation">{}</div>')).format(f"<ul>{links}</ul>"), k

    def note(kinds: tuple[str, ...], low: int, high: int) -> tuple[str, int]:
        k = rng.randint(1, 3)
        body = "".join(f"<p>{_words(rng, low, high, pick(('.', '', '!')))}</p>" for _ in range(k))
        shell = pick(kinds)
        if rng.random() < 0.5:
            return shell.format(_words(rng, low, high, pick((".", "")))), 1
        return shell.format(body), k

    banners = ('<header>{}</header>', '<div class="header">{}</div>', '<div id="masthead" class="site-header">{}</div>', '<div role="banner">{}</div>')
    notices = ('<div class="cookie-notice">{}</div>', '<div id="consent" class="cookie">{}</div>', '<div class="alert notice">{}</div>',
               '<div class="banner">{}</div>', '<dialog>{}</dialog>', '<div class="newsletter subscribe">{}</div>', '<div class="popup modal">{}</div>')
    adverts = ('<div class="ad">{}</div>', '<div class="ads advert">{}</div>', '<div id="sponsored">{}</div>', '<div class="promo promotion">{}</div>',
               '<aside class="ad advertisement">{}</aside>', '<div class="adbox banner">{}</div>')
    sides = ('<aside>{}</aside>', '<div class="sidebar">{}</div>', '<div id="side" class="widget">{}</div>', '<section class="related">{}</section>',
             '<div class="share social">{}</div>', '<div role="complementary">{}</div>')
    feet = ('<footer>{}</footer>', '<div class="footer">{}</div>', '<div id="footer" class="copyright">{}</div>', '<div role="contentinfo">{}</div>')
    forms = ('<form>{}</form>', '<form class="search"><label>{}</label></form>', '<form id="login"><fieldset>{}</fieldset></form>')
    talks = ('<section class="comments">{}</section>', '<div id="comments"><div class="comment">{}</div></div>',
             '<div class="comment-list discussion">{}</div>', '<ol class="responses replies">{}</ol>', '<section id="reader-comments">{}</section>')
    outside = ((banners, 1, 9), (notices, 4, 30), (adverts, 3, 25), (sides, 2, 20), (forms, 1, 6), (talks, 3, 60))

    def story() -> tuple[list[str], list[int]]:
        parts, labels = [], []
        if rng.random() < 0.9:
            parts.append(pick(("<h1>{}</h1>", "<h1>{}</h1>", "<header><h1>{}</h1></header>", "<h2>{}</h2>")).format(_words(rng, 1, 10)))
            labels.append(1)
        for _ in range(rng.randint(1, 14)):
            kind, text = rng.random(), _words(rng, 1, pick((2, 8, 60, 120)), pick((".", ".", ".", "!", "?", "")))
            if kind < 0.7:
                parts.append(pick(("<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<p>{}</p>", "<div>{}</div>")).format(text))
            elif kind < 0.78:
                parts.append(f"<{pick(('h2', 'h3', 'h4'))}>{text[:60]}</h2>")
            elif kind < 0.84:
                parts.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.9:
                k = rng.randint(1, 5)
                parts.append("<ul>" + "".join(f"<li>{_words(rng, 1, 15)}</li>" for _ in range(k)) + "</ul>")
                labels += [1] * (k - 1)
            elif kind < 0.94:
                parts.append(f"<table><tr><td>{text}</td><td>{_words(rng, 1, 3)}</td></tr></table>")
                labels.append(1)
            elif kind < 0.97:
                parts.append(f"<pre>{text}</pre>")
            else:
                parts.append(f'<p>{text} <a href="/x">{_words(rng, 1, 4)}</a></p>')
            labels.append(1)
            if rng.random() < 0.06:  # foreign parts inside the article
                kinds, low, high = pick(outside[1:])
                part, k = note(kinds, low, high)
                parts.append(part)
                labels += [0] * k
        if rng.random() < 0.15:
            part, k = note(talks, 3, 60)
            parts.append(part)
            labels += [0] * k
        return parts, labels

    shells = ("<article>{}</article>", "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>",
              '<div class="content">{}</div>', '<div id="main" class="post entry">{}</div>', '<div class="article-body story">{}</div>', "<div>{}</div>")
    for _ in range(n):
        parts, labels = [], []

        def add(part: tuple[str, int], parts=parts, labels=labels) -> None:
            parts.append(part[0])
            labels += [0] * part[1]

        for _ in range(rng.randint(0, 2)):
            add(menu())
        for kinds, low, high in rng.sample(outside[:4], rng.randint(0, 3)):
            add(note(kinds, low, high))
        inner, marks = story()
        parts.append(pick(shells).format("".join(inner)))
        labels += marks
        for kinds, low, high in rng.sample(outside[2:], rng.randint(0, 2)):
            add(note(kinds, low, high))
        if rng.random() < 0.9:
            parts.append(pick(feet).format(pick(("&copy; ", "", "")) + _words(rng, 2, 14, pick((".", "")))))
            labels.append(0)
        page = f"<!DOCTYPE html><html><head><title>{_words(rng, 2, 8)}</title></head><body>{''.join(parts)}</body></html>"
        yield page, labels


@lru_cache(maxsize=4)
def trained(n: int = TRAINING_PAGES, seed: int = SEED) -> Crf:
    pages = list(training_pages(n, seed))
    return Crf().fit([features(blocks(p)) for p, _ in pages], [y for _, y in pages])


def main_text(page: str | None, model: Crf) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, y in zip(found, model.decode(features(found)), strict=True) if y)


def extract(pages: DataFrame, html: str = "html", model: Crf | None = None, drop: tuple = ()) -> DataFrame:
    """``pages`` plus ``text`` (the main text, blocks joined by a line feed) and
    ``n_chars`` (its code points)."""
    sent = pages.sparkSession.sparkContext.broadcast(model or trained())

    def run(found: list) -> list[list]:
        texts = [main_text(p and p.decode("utf-8", "replace"), sent.value) for p in found]
        return [texts, [len(t) for t in texts]]

    return add_columns(pages, html, run, "text string, n_chars long", drop)


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages, drop=("html",))
