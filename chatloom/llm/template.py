"""HTML extraction by equivalence classes of template tokens.

A template token is a container element in its place: the path of container names with their classes and ids. The pages of a host with the same outermost
containers are a layout. Over a layout's different pages (copies count once), tokens that share their occurrence vector (how often each page has them) form a
class; classes that at least half the pages have, and that hold more than one token or occur the same number of times on every page, are the template, nested
by their paths. What a page has between template tokens are its slots. A slot whose text is the same on all pages that have it (``REPEATS`` at least) belongs to the
template itself: a notice, an advert, a footer, whatever it is called. A slot of links is a menu. Of the rest, all text-bearing slots are kept: the article and
main containers where the template has any, else every slot.

Names and roles of elements say what is a menu, header, footer, sidebar, notice, advert, form, script or comment even on a host with one page. Words in classes
and ids only ever take away a container with less than half of the page's text, and never html, body, main or article; inside an article only whole class names count.

Occurrence vectors never meet in one place: a token's vector is the exclusive or of one 64-bit hash per (page, count), which is a
partial aggregate. Per layout only tokens of at least half the pages are gathered, so that a template is bounded by the size of its pages, not their number.

Edge cases: a null or empty page gives empty text; a null URL is a host of its own; a host with one page has the page's own containers as
template; a page without the main container keeps all text outside the boilerplate; unclosed, misnested and cut-off markup is
tolerated; repeated rows are extracted each; an empty table gives an empty result. Only the key, the URL and the results are returned.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.frames import cut, released
from chatloom.session import is_small

# Elements by role.
RAW = frozenset("script style noscript template iframe textarea svg object annotation".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr "
    "math mi mo mn ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd mstyle mpadded semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset(
    "html body head title main article section nav header footer aside div ul ol dl menu table form figure details dialog blockquote button select label fieldset script style noscript".split()
)
BOILER = frozenset("head title nav footer aside form menu dialog button select label fieldset input option legend".split()) | RAW
MAIN = frozenset(("article", "main"))
WHOLE = MAIN | {"html", "body"}
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead "
    "comment comments respond reply replies discussion notice cookie cookies consent gdpr popup modal newsletter subscribe signup login search share sharing social "
    "related recommended recommendations widget pagination pager toolbar copyright disclaimer".split()
)
# Words that say so inside an article too, as a part of a name like comment-list.
STRONG_WORDS = frozenset("ad ads advert adverts advertisement advertising comment comments cookie cookies newsletter sidebar share sharing sponsored subscribe".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def element(name: str, attributes: str, inside_main: bool) -> tuple[str, int]:
    """How a container is named in a path, and its role: 0 none, 1 boilerplate, 2 main, 3 boilerplate by its words unless it holds most of the text."""
    label, role, worded = name, int(name in BOILER or (name == "header" and not inside_main)), False
    for key, a, b, c in NAMED.findall(attributes) if attributes else ():
        value = (a or b or c).lower()
        label += f".{value}"
        if key.lower() == "role":
            role = role or int(value in BOILER_ROLES)
        for whole in value.split():
            parts = re.split(r"[^a-z]+", whole)
            if inside_main:
                worded |= whole in BOILER_WORDS or parts[0] in STRONG_WORDS or parts[-1] in STRONG_WORDS
            else:
                worded |= not BOILER_WORDS.isdisjoint(parts)
    if name in WHOLE:
        role, worded = 0, False
    return re.sub(r"\d+", "", label), role or 3 * worded or 2 * (name in MAIN)


def pieces(html: str) -> Iterator[tuple[str, object]]:
    """The page as events: ("open", (label, role)), ("close", n containers), ("break", None), ("link", +1 or -1), ("text", raw)."""
    at, stack, roles, size = 0, [], [], len(html)
    while at < size:
        match = TOKEN.search(html, at)
        if match is None:
            yield "text", html[at:]
            return
        if match.start() > at:
            yield "text", html[at : match.start()]
        at = match.end()
        name = match[2] or match[5]
        if not name:
            continue
        name, closing = name.lower(), bool(match[1] or match[4])
        if name in RAW and not closing:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(html, at)
            at = end.end() if end else size
            if name not in CONTAINERS:
                yield "break", None
                continue
            label, _ = element(name, "", False)
            yield "open", (label, 1)
            yield "close", 1
            continue
        if name == "a":
            yield "link", -1 if closing else 1
        if name in INLINE:
            continue
        yield "break", None
        if name not in CONTAINERS:
            continue
        if not closing:
            if not (match[3] or match[6] or "").rstrip().endswith("/"):
                label, role = element(name, match[3] or match[6] or "", 2 in roles)
                stack.append(name)
                roles.append(role)
                yield "open", (label, role)
        elif name in stack:
            n = 1 + stack[::-1].index(name)
            del stack[-n:], roles[-n:]
            yield "close", n


def token(parent: int, label: str) -> int:
    """A path's 64-bit name out of its parent's."""
    raw = f"{parent}/{label}".encode("utf-8", "replace")
    return ((zlib.crc32(raw) << 32) | zlib.crc32(raw[::-1] + b"/")) - (1 << 63)


class Page:
    """A page's events, and of each container its token, depth, text and link characters, whether it is boilerplate, and a hash of its text."""

    def __init__(self, html: str):
        self.events = list(pieces(html))
        self.tokens, self.roles, self.depths, self.chars, self.links, self.content, self.names, self.inner = [], [], [], [], [], [], [], []
        path, open_, hidden, linked, self.total = [0], [], 0, 0, 0
        outer = []
        for kind, value in self.events:
            if kind == "open":
                label, role = value
                path.append(token(path[-1], label))
                for column, x in zip((self.tokens, self.roles, self.depths, self.chars, self.links, self.content), (path[-1], role, len(path) - 1, 0, 0, 0)):
                    column.append(x)
                if all(self.names[i] in ("html", "body") for i in open_) and label.split(".")[0] not in ("html", "body", "head"):
                    outer.append(label)
                self.inner.append(any(self.roles[i] == 2 for i in open_))
                open_.append(len(self.tokens) - 1)
                self.names.append(label.split(".")[0])
                hidden += role == 1
            elif kind == "close":
                hidden -= sum(self.roles[i] == 1 for i in open_[-value:])
                del path[-value:], open_[-value:]
            elif kind == "link":
                linked = max(0, linked + value)
            elif kind == "text" and not hidden and (text := value.strip()):
                self.total += len(text)
                for i in open_:
                    self.chars[i] += len(text)
                    self.links[i] += len(text) if linked else 0
                    self.content[i] = zlib.crc32(text.encode("utf-8", "replace"), self.content[i])
        self.layout = zlib.crc32("\n".join(sorted(set(outer))).encode("utf-8", "replace"))
        self.boiler = [r == 1 or (r == 3 and 2 * n <= self.total) for r, n in zip(self.roles, self.chars)]

    def slots(self) -> dict[int, list]:
        """Per token outside boilerplate: [count, text characters, link characters, role, depth, hash of the text]; text inside boilerplate counts nowhere."""
        found: dict[int, list] = {}
        for i in self.opened():
            t = self.tokens[i]
            entry = found.setdefault(t, [0, 0, 0, INNER if self.inner[i] and self.roles[i] != 2 else self.roles[i], self.depths[i], 0])
            entry[0] += 1
            entry[1] += self.chars[i]
            entry[2] += self.links[i]
            entry[5] = zlib.crc32(self.content[i].to_bytes(4, "little"), entry[5])
        return found

    def opened(self) -> Iterator[int]:
        """Numbers of the containers outside boilerplate."""
        i, open_, hidden = -1, [], 0
        for kind, value in self.events:
            if kind == "open":
                i += 1
                open_.append(i)
                hidden += self.boiler[i]
                if not hidden:
                    yield i
            elif kind == "close":
                hidden -= sum(self.boiler[j] for j in open_[-value:])
                del open_[-value:]

    def text(self, mains: frozenset[int], drops: frozenset[int]) -> str:
        """The blocks of the main slots; where the page has none, of its own article or main; else all text outside boilerplate and template."""
        dropped = [b or (t in drops and r != 2 and 2 * n <= self.total) for b, t, r, n in zip(self.boiler, self.tokens, self.roles, self.chars)]
        kept = list(self.opened())
        for chosen in ({i for i in kept if self.tokens[i] in mains}, {i for i in kept if self.roles[i] == 2}, None):
            if chosen is None or chosen:
                blocks = self.blocks(chosen, dropped)
                if blocks:
                    return "\n".join(blocks)
        return ""

    def blocks(self, chosen: set[int] | None, dropped: list[bool]) -> list[str]:
        blocks, now, open_ = [], [], []
        i, hidden, inside = -1, 0, int(chosen is None)

        def end() -> None:
            block = re.sub(r"\s+", " ", unescape("".join(now))).strip()
            now.clear()
            if block:
                blocks.append(block)

        for kind, value in self.events:
            if kind == "text":
                if inside and not hidden:
                    now.append(value)
                continue
            if kind == "link":
                continue
            end()
            if kind == "open":
                i += 1
                open_.append(i)
                hidden += dropped[i]
                inside += chosen is not None and i in chosen
            elif kind == "close":
                hidden -= sum(dropped[j] for j in open_[-value:])
                inside -= sum(j in chosen for j in open_[-value:]) if chosen is not None else 0
                del open_[-value:]
        end()
        return blocks


def deduce(tokens: pd.DataFrame) -> tuple[list[int], list[int]]:
    """The main slots of a layout, and the slots that are template or menus, from its frequent tokens:
    (token, vec, pages, least, most, chars, links, role, same)."""
    total = int(tokens["pages"].max())
    sizes = tokens.groupby("vec")["token"].transform("size")
    valid = tokens[(sizes > 1) | (tokens["least"] == tokens["most"]) & (tokens["pages"] == total) | (tokens["pages"] == 1)]
    bearing = valid[valid["chars"] > 0]
    mains = bearing[bearing["role"] == 2]
    others = bearing[bearing["role"] != 2]
    drops = others[(others["same"] & (others["pages"] >= REPEATS)) | ((others["role"] != INNER) & (10 * others["links"] >= 8 * others["chars"]))]
    return sorted(int(t) for t in mains["token"]), sorted(int(t) for t in drops["token"])


INNER = 4  # the role of containers inside an article
REPEATS = 5  # different pages with the same text in a slot that make it template
TEMPLATES = "_host string, layout long, mains array<bigint>, drops array<bigint>"


def templates(pages: DataFrame) -> DataFrame:
    """(_host, layouts array<struct<layout, mains, drops>>): one row per host. ``pages`` has _host and _html."""

    def counted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["_host", "layout", "page", "token", "sig", "count", "chars", "links", "role", "content"]
        for part in parts:
            rows = []
            for host, own, html in zip(part["_host"], part["_own"], part["_html"], strict=True):
                page = Page(html or "")
                rows.append((host, page.layout, own, 0, token(0, f"{own}:1"), 1, 0, 0, 0, 0))
                for t, (n, chars, links, role, _, content) in page.slots().items():
                    rows.append((host, page.layout, own, t, token(t, f"{own}:{n}"), n, chars, links, role, content))
            yield pd.DataFrame(rows, columns=names)

    schema = "_host string, layout long, page long, token long, sig long, count long, chars long, links long, role int, content long"
    seen = pages.withColumn("_own", F.xxhash64("_html")).mapInPandas(released(counted), schema)
    once = seen.groupBy("_host", "layout", "token", "page").agg(*[F.first(c).alias(c) for c in ("sig", "count", "chars", "links", "role", "content")])
    by_token = once.groupBy("_host", "layout", "token").agg(
        F.bit_xor("sig").alias("vec"), F.count(F.lit(1)).alias("pages"), F.min("count").alias("least"), F.max("count").alias("most"),
        F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.max("role").alias("role"), (F.min("content") == F.max("content")).alias("same"),
    )
    by_token = cut(by_token)
    whole = by_token.filter("token = 0").select("_host", "layout", F.col("pages").alias("_of"))
    frequent = by_token.join(whole, ["_host", "layout"]).filter("2 * pages >= _of AND token <> 0").drop("_of")

    def deduced(pdf: pd.DataFrame) -> pd.DataFrame:
        mains, drops = deduce(pdf)
        return pd.DataFrame({"_host": [pdf["_host"].iloc[0]], "layout": [pdf["layout"].iloc[0]], "mains": [mains], "drops": [drops]})

    found = frequent.groupBy("_host", "layout").applyInPandas(deduced, TEMPLATES)
    return found.groupBy("_host").agg(F.collect_list(F.struct("layout", "mains", "drops")).alias("layouts"))


def extract(pages: DataFrame, html: str = "html", url: str = "url", key: str = "page_id", salts: int = 64) -> DataFrame:
    """(key, url, text, n_chars) of every page. The pages are read and parsed twice: for the template, and for the slots.

    The hosts' templates are broadcast where a count shows that they are small; else the pages are joined by (host, salt), so that a host with
    most pages is split.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"), host.alias("_host"), F.col(html).alias("_html"))
    found = cut(templates(rows))
    if is_small(found):
        joined = rows.join(F.broadcast(found), "_host", "left")
    else:
        spread = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = rows.withColumn("_salt", F.pmod(F.xxhash64("_key", "_url"), F.lit(salts)).cast("int")).join(spread, ["_host", "_salt"], "left")

    def texts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for html, layouts in zip(part["_html"], part["layouts"], strict=True):
                page = Page(html or "")
                own = next((x for x in (layouts if layouts is not None else ()) if x["layout"] == page.layout), None)
                out.append(page.text(*(frozenset(map(int, own[c])) if own else frozenset() for c in ("mains", "drops"))))
            yield pd.DataFrame({"_key": part["_key"], "_url": part["_url"], "_text": out, "_n": [len(t) for t in out]})

    schema = f"_key {pages.schema[key].dataType.simpleString()}, _url string, _text string, _n long"
    done = joined.select("_key", "_url", "_html", "layouts").mapInPandas(released(texts), schema)
    return done.select(F.col("_key").alias(key), F.col("_url").alias(url), F.col("_text").alias("text"), F.col("_n").alias("n_chars"))
