"""Main text of web pages by a consensus of each host's pages.

First every page is read alone: its containers, named by a generalised path of
tags and classes, get a score from the text they hold outside links and
boilerplate, and the page votes for the best one. Spark counts the votes per
host and path, and the path with most wins. Then each page is read again and
the text under its host's winning path is taken; a page without that path takes
its own best container.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscore.session import settle

# Fixed values of HTML: elements without content, elements whose content is not
# markup, and elements that stand as a block of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp svg".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: Elements that an opening block closes if they are open.
CLOSED_BY_BLOCK = frozenset(("p",))
#: Inside these an open paragraph or item is not closed from further in.
SCOPES = frozenset("article aside body div footer form header main nav section table td th ul ol dl blockquote".split())

#: Elements and words of class, id or role that are not part of an article.
BOILERPLATE = frozenset("nav header footer aside form script style noscript template iframe button select svg head dialog menu".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments "
    "contentinfo cookie cookies consent disclaimer discussion disqus footer gdpr header hidden login masthead menu menus "
    "modal nav navbar navigation newsletter notice notices pagination popup privacy promo promotion promoted related "
    "replies reply search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Words that may stand beside those: places, shapes and what they hold.
QUALIFIERS = frozenset(
    "site main page global top bottom left right primary secondary mobile desktop wrap wrapper container inner outer box block "
    "area bar section panel list lists link links slot unit sticky fixed content group module form posts articles stories items".split()
)
#: Words of reader comments, which may be longer than the article.
COMMENT_WORDS = frozenset("comment comments disqus replies reply".split())
#: Elements that no class or id makes boilerplate: the page, articles, and headings, whose ids are anchors.
NEVER_NAMED = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())
#: The share of all text outside links that a marked element holds if it is the article after all, and its least length.
MOST_OF_PAGE, LEAST_ARTICLE = 0.9, 200
#: Elements that one of the same name closes.
REPEATED = frozenset("li tr td th dt dd option".split())
#: Containers that may hold the article.
CONTAINERS = frozenset("article main section div td body".split())

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>|\Z)|[^>]*)(?:>|\Z)"
    r"|<[!?/](?:[^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")


def names_boilerplate(token: str) -> bool:
    """Whether a class, id or role names boilerplate: such a word, with nothing but words of place and shape beside it.

    ``site-header`` and ``cookie-banner`` do, ``has-sidebar``, ``no-header``, ``post-header`` and ``search-tips`` do not.
    """
    words = [w.lower() for w in _WORDS.findall(token)]
    return not BOILERPLATE_WORDS.isdisjoint(words) and all(w in BOILERPLATE_WORDS or w in QUALIFIERS for w in words)


class Element:
    """An element; ``path`` is a number for the tags and class words from the root down to it."""

    __slots__ = ("container", "link", "mark", "marked", "may_hold_all", "name", "parent", "path", "plain", "score", "visible")

    def __init__(self, name: str, parent: Element | None, attributes: str):
        words: set[str] = set()
        named = hidden = comments = False
        for key, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
            key, value = key.lower(), "".join(values)
            if key in ("class", "id", "role"):
                for token in value.split():
                    own = {w.lower() for w in _WORDS.findall(token)}
                    words |= own
                    if names_boilerplate(token):
                        named, comments = True, comments or not COMMENT_WORDS.isdisjoint(own)
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                hidden = True
            elif key == "style" and re.search(r"display\s*:\s*none", value, re.I):
                hidden = True
        self.name, self.parent = name, parent
        step = ".".join([name, *sorted(words)]).encode("utf-8", "surrogatepass")
        self.path = xxhash.xxh64_intdigest(step, parent.path if parent else 0) >> 1  # fits a signed long
        self.marked = name in BOILERPLATE or hidden or (named and name not in NEVER_NAMED)
        # A form around the page, or a class that only sounds like boilerplate, may hold all that there is.
        self.may_hold_all = self.marked and not hidden and not comments and (name == "form" or name not in BOILERPLATE)
        self.mark = self if self.marked else (parent.mark if parent else None)
        self.container = self if name in CONTAINERS else (parent.container if parent else None)
        self.link = name == "a" or (parent is not None and parent.link)
        self.plain, self.score, self.visible = 0, 0.0, True


class Page:
    """Blocks of a page in order: text, if it is all link, and the innermost container around it.

    Boilerplate is left out. Tags that are never closed, cut off or out of
    order are borne; white space in a block is one space, references are
    decoded after the markup is gone. Work and memory are linear in the page,
    however deep it is nested.
    """

    def __init__(self, page: str | None):
        self.elements: list[Element] = []
        raw: list[list[tuple[Element | None, str]]] = [[]]
        self._parse(page or "", raw)
        self._show(raw)
        self.blocks: list[tuple[str, bool, Element | None]] = []
        for pieces in raw:
            seen = [(e, t) for e, t in pieces if e is None or e.visible]
            text = _SPACE.sub(" ", entities.unescape("".join([t for _, t in seen]))).strip()
            if text:
                linked = all(e is not None and e.link for e, t in seen if t.strip())
                self.blocks.append((text, linked, next((e.container for e, _ in seen if e and e.container), None)))

    def _parse(self, page: str, raw: list[list[tuple[Element | None, str]]]) -> None:
        """Elements, parents before children, and of each block its pieces of text with the elements they are in."""
        stack: list[Element] = []
        open_names: Counter[str] = Counter()

        def say(text: str) -> None:
            raw[-1].append((stack[-1] if stack else None, text))

        def close(to: int) -> None:
            open_names.subtract(e.name for e in stack[to:])
            del stack[to:]

        at, n = 0, len(page)
        while at < n:
            found = _TOKEN.search(page, at)
            if not found:
                say(page[at:])
                break
            if found.start() > at:
                say(page[at : found.start()])
            at = found.end()
            name = found["name"]
            if not name:
                continue
            name = name.lower()
            if name in BLOCK and raw[-1]:
                raw.append([])
            if found["end"]:
                for i in range(len(stack) - 1, -1, -1) if open_names[name] > 0 else ():
                    if stack[i].name == name:
                        close(i)
                        break
                    if stack[i].name in SCOPES and name not in SCOPES:
                        break  # a stray end tag does not close what is around
                continue
            attributes = found["attrs"]
            if name in VOID:
                continue
            if name in BLOCK:
                closes = {*CLOSED_BY_BLOCK, *({name} & REPEATED)}
                for i in range(len(stack) - 1, -1, -1) if any(open_names[c] > 0 for c in closes) else ():
                    if stack[i].name in closes:
                        close(i)
                        break
                    if stack[i].name in SCOPES:
                        break
            if attributes.endswith("/") and name not in BLOCK and name not in RAW:
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else n
                continue
            stack.append(Element(name, stack[-1] if stack else None, attributes))
            self.elements.append(stack[-1])
            open_names[name] += 1

    def _show(self, raw: list[list[tuple[Element | None, str]]]) -> None:
        """Which elements are not boilerplate: unmarked, or marked but holding nearly all text that is neither link nor marked."""
        free = 0
        for pieces in raw:
            for element, text in pieces:
                size = len(text.strip())
                if size and element is not None and element.mark is not None:
                    element.mark.plain += 0 if element.link else size
                elif size and not (element is not None and element.link):
                    free += size
        for e in self.elements:
            least = 0 if e.name == "form" else LEAST_ARTICLE
            spared = e.may_hold_all and e.plain > least and e.plain >= MOST_OF_PAGE * (e.plain + free)
            e.visible = (e.parent is None or e.parent.visible) and (not e.marked or spared)

    def scores(self) -> dict[int, int]:
        """Score by container path: code points of text outside links, less those in links.

        A block counts fully for the container it stands in and three quarters of
        that for each one further out, so that the innermost that holds most wins.
        """
        for e in self.elements:
            e.score = 0.0
        for text, linked, container in self.blocks:
            if container is not None:
                container.score += -len(text) if linked else len(text)
        sums: dict[int, float] = {}
        for e in reversed(self.elements):
            if e.container is e:
                sums[e.path] = sums.get(e.path, 0.0) + e.score
                outer = e.parent.container if e.parent else None
                if outer is not None:
                    outer.score += 0.75 * e.score
        return {path: int(s) for path, s in sums.items() if s >= 1}

    def text(self, path: int | None) -> str:
        """Blocks under ``path``, or under the page's own best container if it has none there, joined by line breaks."""
        kept = self._under(path)
        if not kept and self.blocks:
            own = best_container(self.scores())
            kept = self._under(own) if own is not None else [text for text, linked, _ in self.blocks if not linked]
        return "\n".join(kept)

    def _under(self, path: int | None) -> list[str]:
        inside: set[int] = set()
        for e in self.elements:  # parents first
            outer = e.parent.container if e.parent else None
            if e.container is e and (e.path == path or (outer is not None and id(outer) in inside)):
                inside.add(id(e))
        return [text for text, _, container in self.blocks if container is not None and id(container) in inside]


def score_containers(page: str | None) -> dict[int, int]:
    return Page(page).scores()


def best_container(scores: dict[int, int]) -> int | None:
    """The path with the largest score, the least number of equals."""
    return min(scores, key=lambda path: (-scores[path], path), default=None)


def main_text(page: str | None, path: int | None) -> str:
    return Page(page).text(path)


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _vote_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums: dict[tuple[str, int], list[int]] = {}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            scores = score_containers(page)
            path = best_container(scores)
            if path is not None:
                both = sums.setdefault((host, path), [0, 0])
                both[0] += 1
                both[1] += scores[path]
        rows = [(host, path, n, s) for (host, path), (n, s) in sums.items()]
        columns = zip(*rows) if rows else [()] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "path", "votes", "score"])


def winning_paths(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """host, path, votes, score: the path with most votes of each host; of equals by score, then by number."""
    rows = pages.select(host_of(F.col(f"`{url_column}`")).alias("host"), F.col(f"`{html_column}`").alias("html"))
    voted = rows.mapInArrow(_vote_task, "host string, path long, votes long, score long")
    sums = voted.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("score").alias("score"))
    best = F.min(F.struct((-F.col("votes")).alias("n"), (-F.col("score")).alias("s"), "path"))
    return sums.groupBy("host").agg(best.alias("b")).select(
        "host", F.col("b.path").alias("path"), (-F.col("b.n")).alias("votes"), (-F.col("b.s")).alias("score")
    )


#: Hosts up to which their winning paths are broadcast; salts of a host beyond that.
BROADCAST_HOSTS, SALTS = 200_000, 64


def _text_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            texts = [main_text(page, path) for page, path in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )


def extract_pages(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    broadcast_hosts: int = BROADCAST_HOSTS,
) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points).

    Null and empty pages, and pages without text outside boilerplate, have the
    empty text. Pages whose URL is null or has no host vote as one host.
    Repeated rows vote and are extracted each; other columns are ignored; an
    empty table gives no rows. Winning paths are stored, then broadcast if
    there are few hosts, which is counted; else a host is spread over salts.
    """
    winners = settle(winning_paths(pages, url_column, html_column).select("host", "path"))
    rows = pages.select(
        F.col(f"`{id_column}`").alias("page_id"),
        F.col(f"`{url_column}`").alias("url"),
        F.col(f"`{html_column}`").alias("html"),
        host_of(F.col(f"`{url_column}`")).alias("host"),
    )
    if winners.count() <= broadcast_hosts:
        joined = rows.join(F.broadcast(winners), "host", "left")
    else:
        salted = winners.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))).join(
            salted, ["host", "salt"], "left"
        )
    kind = pages.schema[id_column].dataType.simpleString()
    texts = joined.select("page_id", "url", "html", "path").mapInArrow(_text_task, f"page_id {kind}, url string, text string")
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
