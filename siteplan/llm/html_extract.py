"""HTML extraction: a conditional random field labels each leaf block as main text or not."""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .crf import Chain, fit
from .dom import Block, Element, leaf_blocks

#: Labelled pages the model is trained on, and the seed they are made with.
TRAIN_PAGES, SEED = 600, 11

#: Words of class, id and role names, by what they usually mark (fixed values).
NAMES = {
    "nav": "nav navigation menu menubar breadcrumb breadcrumbs toolbar tabs pagination pager toc skip",
    "head": "header masthead topbar logo brand banner site",
    "foot": "footer foot copyright legal colophon contentinfo bottom",
    "side": "sidebar aside side related recommended popular trending widget more complementary teaser",
    "ad": "ad ads adv advert advertisement adsense sponsor sponsored promo promotion promoted commercial dfp",
    "note": "cookie cookies consent gdpr notice alert newsletter subscribe popup modal overlay paywall dialog toast",
    "talk": "comment comments commentlist disqus reply replies discussion respond responses feedback thread",
    "form": "form search login signup register searchbox contact",
    "share": "share sharing social follow tags tagcloud meta byline",
    "main": "article main content post entry story body text prose page",
}
GROUP_OF = {word: group for group, listed in NAMES.items() for word in listed.split()}
LANDMARKS = frozenset("nav header footer aside main article section form body table figure dialog details button fieldset".split())
SIGNS = ("©", "copyright", "all rights reserved", "cookie", "subscribe", "newsletter", "sign up", "log in", "advertis", "sponsored", "privacy", "comment", "share")


#: What `_surroundings` says of no element: the block's tag, what is around, and the innermost of it.
_OUTSIDE = ("none", frozenset(), ("inner=nothing",))
#: From so many words on a block is prose, which may well mention what marks a short block as none.
LONG_WORDS = 60


def _surroundings(element: Element | None) -> tuple[str, frozenset[str], tuple[str, ...]]:
    """What an element and those around it say, found once per element from its parent's."""
    chain = []
    while element is not None and element.notes is None:
        chain.append(element)
        element = element.parent
    tag, around, inner = element.notes if element is not None else _OUTSIDE
    for element in reversed(chain):
        own = ["name=" + GROUP_OF[name] for name in element.names if name in GROUP_OF]
        if element.tag in LANDMARKS:
            own.append("in=" + element.tag)
        if element.tag == "header" and around & {"in=article", "in=main", "name=main"}:
            own.append("title part")
        if not around.issuperset(own):
            around = around.union(own)
        if own and element.tag not in ("body", "section"):
            inner = tuple("inner " + o for o in own)
        if element.tag not in ("a", "b", "i", "span", "strong", "em"):
            tag = element.tag
        element.notes = (tag, around, inner)
    return tag, around, inner


def block_features(block: Block) -> list[str]:
    """Names of what holds for a block: its tag, what is around it, and its whole text."""
    tag, held, inner = _surroundings(block.inner)
    out, around = ["bias", "tag=" + tag], set(held)
    if "in=article" in around or "in=main" in around:
        nested = [k for k in around if k not in ("in=article", "in=main", "in=body", "in=section", "in=figure", "in=table", "name=main")]
        around.add("inside=clean" if not nested else "inside=marked")
    elif not around - {"in=body", "in=section"}:
        around.add("inside=nothing")
    out += sorted(around) + sorted(inner)
    text = block.text
    words = text.count(" ") + 1
    out.append("links=" + ("none" if block.linked < 0.05 else "some" if block.linked < 0.6 else "all"))
    out.append("words=" + ("1" if words < 3 else "3" if words < 8 else "8" if words < 20 else "20"))
    if text[-1] in ".!?…\"”»":
        out.append("ends")
    low, kind = text.lower(), "sign=" if words < LONG_WORDS else "long sign="
    out += [kind + s for s in SIGNS if s in low]
    return out


# --- labelled pages -----------------------------------------------------------------------

_SYLLABLES = "an be co de en fi ga hi in jo ka lo mi no or pe qu ra so ti un ve wa xi yo za sch tion ment é ä ñ".split()


class _Writer:
    """Parts of pages with filler text; main text is marked by the attribute data-main."""

    def __init__(self, seed: int) -> None:
        self.draw = random.Random(seed)

    def word(self) -> str:
        return "".join(self.draw.choices(_SYLLABLES, k=self.draw.randint(1, 4)))

    def sentence(self, low: int, high: int) -> str:
        words = [self.word() for _ in range(self.draw.randint(low, high))]
        return " ".join(words).capitalize() + self.draw.choice([".", ".", ".", "!", "?", ""])

    def prose(self, low: int = 1, high: int = 5) -> str:
        text = " ".join(self.sentence(3, 18) for _ in range(self.draw.randint(low, high)))
        kind = self.draw.random()
        if kind < 0.08:
            return text.upper().replace(" ", "!! ")
        if kind < 0.14:
            return text.replace(" ", "### ")
        if kind < 0.2:
            return self.word().capitalize() + "."
        return text

    def named(self, tag: str, names: list[str], inner: str, share: float = 0.6) -> str:
        if self.draw.random() < share:
            return f'<{tag} {self.draw.choice(["class", "id", "class"])}="{self.draw.choice(names)}">{inner}</{tag}>'
        return f"<{tag}>{inner}</{tag}>"

    def links(self, n: int) -> str:
        item = lambda: f'<a href="/{self.word()}">{self.sentence(1, 4).rstrip(".!?")}</a>'
        if self.draw.random() < 0.7:
            return "<ul>" + "".join(f"<li>{item()}</li>" for _ in range(n)) + "</ul>"
        return " ".join(item() for _ in range(n))

    def menu(self) -> str:
        inner = self.links(self.draw.randint(2, 9))
        return self.named("nav", ["menu", "main-nav", "breadcrumb"], inner) if self.draw.random() < 0.6 else self.named("div", ["menu", "topmenu nav", "navigation", "breadcrumbs"], inner, 1)

    def banner(self) -> str:
        inner = self.draw.choice([f"<h1>{self.sentence(1, 4)}</h1>", f"<a href='/'>{self.word()}</a>", f"<p>{self.sentence(2, 8)}</p>"])
        return self.named("header", ["site-header", "masthead", "top"], inner + (self.links(3) if self.draw.random() < 0.5 else "")) if self.draw.random() < 0.7 else self.named("div", ["header", "masthead", "topbar", "site-header"], inner, 1)

    def foot(self) -> str:
        inner = self.draw.choice([f"&copy; {self.word()} &middot; {self.prose(1, 3)}", f"<p>Copyright {self.word()}. All rights reserved.</p>", self.links(4), f"<p>{self.prose(1, 2)}</p>"])
        return self.named("footer", ["site-footer", "footer"], inner) if self.draw.random() < 0.7 else self.named("div", ["footer", "site-footer legal", "copyright"], inner, 1)

    def advert(self) -> str:
        inner = self.draw.choice([self.prose(1, 3), f"<p>{self.prose(1, 3)}</p>", f"<a href='#'>{self.sentence(3, 9)}</a>", f"<span>Advertisement</span><p>{self.prose(1, 2)}</p>"])
        return self.named(self.draw.choice(["div", "div", "aside", "section"]), ["ad", "ads", "advert", "sponsored", "promo box", "ad-slot", "adsense"], inner, 1)

    def side(self) -> str:
        inner = f"<h3>{self.sentence(1, 4)}</h3>" + self.draw.choice([self.links(4), f"<p>{self.prose(1, 3)}</p>", f"<ul><li>{self.prose(1, 1)}</li><li>{self.prose(1, 1)}</li></ul>"])
        return self.named("aside", ["sidebar", "related", "widget"], inner) if self.draw.random() < 0.6 else self.named("div", ["sidebar", "related", "recommended", "widget popular", "side"], inner, 1)

    def notice(self) -> str:
        inner = self.draw.choice([f"<p>{self.prose(1, 2)}</p>", f"<p>We use cookies. {self.sentence(3, 9)}</p><button>OK</button>", f"{self.prose(1, 2)} <a href='#'>{self.word()}</a>", f"<p>Subscribe to our newsletter. {self.sentence(3, 8)}</p>"])
        return self.named(self.draw.choice(["div", "div", "section", "dialog"]), ["cookie-notice", "cookie", "consent", "notice", "newsletter", "alert", "gdpr popup", "modal"], inner, 1)

    def form(self) -> str:
        return self.named("form", ["search", "login", "contact-form"], f"<label>{self.sentence(1, 4)}</label><input name='q'>" + self.draw.choice([f"<button>{self.word()}</button>", f"<p>{self.prose(1, 1)}</p>", f"<textarea>{self.word()}</textarea>"]))

    def talk(self) -> str:
        one = lambda: self.named(self.draw.choice(["div", "li", "article"]), ["comment", "reply", "comment-body"], f"<p>{self.prose(1, 3)}</p>", 0.8)
        return self.named(self.draw.choice(["section", "div"]), ["comments", "comment-list", "discussion", "disqus", "comments-area"], f"<h3>{self.draw.choice(['Comments', self.sentence(1, 3)])}</h3>" + "".join(one() for _ in range(self.draw.randint(1, 5))), 1)

    def share(self) -> str:
        return self.named(self.draw.choice(["div", "ul"]), ["share", "social", "tags", "sharing"], " ".join(f"<a href='#'>{self.word()}</a>" for _ in range(3)), 1)

    def main_block(self) -> str:
        text = self.prose()
        kind = self.draw.random()
        if kind < 0.06:
            return f"<h2 data-main>{self.sentence(1, 6)}</h2>".replace("data-main", 'data-main="1"')
        if kind < 0.1:
            return '<ul data-main="1">' + "".join(f"<li>{self.sentence(1, 9)}</li>" for _ in range(self.draw.randint(2, 4))) + "</ul>"
        if kind < 0.13:
            return f'<blockquote data-main="1"><p>{text}</p></blockquote>'
        if kind < 0.16:
            return f'<table data-main="1"><tr><td>{self.word()}</td><td>{self.sentence(1, 5)}</td></tr></table>'
        if kind < 0.3:
            return f'<p data-main="1"><b>{text}<br></p>'
        if kind < 0.4:
            return f'<p data-main="1">{text} <a href="/{self.word()}">{self.word()}</a> {self.sentence(2, 6)}</p>'
        if kind < 0.45:
            return f'<pre data-main="1">{text}</pre>'
        return f'<p data-main="1">{text}</p>'

    def article(self) -> str:
        title = f'<h1 data-main="1">{self.sentence(2, 9)}</h1>'
        if self.draw.random() < 0.15:
            title = f"<header>{title}</header>"
        blocks = [self.main_block() for _ in range(self.draw.choice([0, 1, 1, 2, 3, 5, 8, 14]))]
        for extra in (self.advert, self.side, self.share, self.notice, self.form):
            if self.draw.random() < 0.08:
                blocks.insert(self.draw.randint(0, len(blocks)), extra())
        if self.draw.random() < 0.12:
            blocks.append(self.talk())
        inner = title * (self.draw.random() < 0.9) + "".join(blocks)
        kind = self.draw.random()
        if kind < 0.5:
            return f"<article>{inner}</article>"
        if kind < 0.65:
            return f"<main>{inner}</main>"
        if kind < 0.75:
            return f'<main><article class="post">{inner}</article></main>'
        if kind < 0.95:
            return self.named("div", ["content", "post", "entry-content", "article-body", "story", "main"], inner, 1)
        return f"<div>{inner}</div>"

    def page(self) -> str:
        before = [p() for p in (self.notice, self.banner, self.menu, self.form, self.advert, self.side) if self.draw.random() < 0.45]
        after = [p() for p in (self.advert, self.side, self.share, self.talk, self.form, self.notice) if self.draw.random() < 0.3]
        if self.draw.random() < 0.5:
            self.draw.shuffle(before)
        end = [self.foot()] if self.draw.random() < 0.9 else []
        body = "".join([*before, self.article(), *after, *end])
        body = f'<div class="wrapper">{body}</div>' if self.draw.random() < 0.2 else body
        return f"<!DOCTYPE html><html><head><title>{self.word()}</title></head><body>{body}</body></html>"


def labelled_pages(n: int = TRAIN_PAGES, seed: int = SEED) -> list[str]:
    """Pages of many layouts in which elements with the attribute data-main hold the main text.

    The layouts cover semantic and plain markup, article parts among boilerplate and the other
    way round, odd and empty articles, and unclosed tags.
    """
    writer = _Writer(seed)
    return [writer.page() for _ in range(n)]


def train(pages: list[str] | None = None) -> Chain:
    """A model of pages whose main text is marked by data-main (by default `labelled_pages`)."""
    parsed = [leaf_blocks(p) for p in (labelled_pages() if pages is None else pages)]
    labels = [[int(any(e.main for e in b.path)) for b in blocks] for blocks in parsed]
    return fit([[block_features(b) for b in blocks] for blocks in parsed], labels)


def main_text(page: str | None, model: Chain) -> str:
    """The blocks labelled as main text, joined by newlines."""
    blocks = leaf_blocks(page or "")
    chosen = model.decode([block_features(b) for b in blocks])
    return "\n".join(b.text for b, c in zip(blocks, chosen) if c)


def extract_main_text(pages: DataFrame, model: Chain | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of `pages` (page_id, url, html).

    Character references are decoded, white space inside a block becomes one space, blocks come
    in page order. Null and empty html gives an empty text; pages of any length are read whole;
    repeated rows are treated alike; an empty table gives an empty table; other columns are not
    read. The model is trained when called, on a bounded number of labelled pages; pages are
    labelled block by block inside the tasks, nothing is shuffled.
    """
    chain = train() if model is None else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), chain) for page in batch.column("html")]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    read = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return read.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def oracle(pages: str = "pages") -> str:
    """The same rows in SQL for pages whose main text stands in one article of h1 and p blocks.

    It knows the layout and so needs no labels; it serves to compare the model's result with.
    """
    inner = "regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1)"
    cut = f"regexp_replace({inner}, '(?s)<[^>]*$', '')"
    marks = f"regexp_replace(regexp_replace({cut}, '</?b>', '', 'g'), '</?(p|h1)>', chr(1), 'g')"
    plain = f"regexp_replace({marks}, '(?s)<[^>]*>', ' ', 'g')"
    for name, sign in (("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#x?0*27;|&#39;", "''"), ("&amp;?", "&")):
        plain = f"regexp_replace({plain}, '{name}', '{sign}', 'g')"
    parts = f"list_transform(string_split({plain}, chr(1)), lambda b: trim(regexp_replace(b, '\\s+', ' ', 'g')))"
    text = f"coalesce(array_to_string(list_filter({parts}, lambda b: b <> ''), chr(10)), '')"
    return f"SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM (SELECT page_id, url, {text} AS text FROM {pages}) p"
