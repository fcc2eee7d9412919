"""Main text of web pages by template deduction.

The tokens of a page are its tags and words, told apart by the elements they stand in. Tokens of one
host with the same occurrence vector over the host's pages form an equivalence class; large classes
found on most pages are its template. The template's tokens, in their common order, cut each page
into slots. The main text are those inside the article, or where there is none, those not mostly
links; on both kinds of page, template text is left out: slots, and blocks of a slot in the article,
all of whose words are template tokens. Copies of one page tell nothing of a template, so a token
must be on two pages that differ.

Null and empty pages have an empty text. A page without a host shares the host ''. Repeated rows
count as pages of their own and get one result each. Pages of any length are read whole; other
columns are kept, whatever their names. Hosts of fewer than LEAST_PAGES pages have no
template; their pages are read by their elements alone. Empty tables give empty results.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.components import free_names, written

LEAST_PAGES = 4
# A template class is found on at least this share of a host's pages and has this many tokens.
LEAST_SHARE = 0.5
LEAST_TOKENS = 3
# Text in an article is a page's own until it is on this share of the host's pages, LEAST_PAGES at least.
LEAST_SAID_SHARE = 0.8
BROADCAST_TOKENS = 500_000
HELD_TOKENS = 200_000

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^'">]|"[^"]*"|'[^']*')*)>|<[!?][^>]*>|<[a-zA-Z/!?][^<>]*\Z""", re.S
)
NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
SPACE = re.compile(r"\s+")
# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
RAW = set("script style textarea title noscript iframe svg template".split())
# Elements, and names in class, id or role, that hold something else than the article.
ASIDE_ELEMENTS = set("head nav aside footer form button select dialog menu".split()) | RAW
ASIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|alert|sidebar|comments?|commentlist|disqus|"
    r"respond|repl(?:y|ies)|nav|navbar|navigation|menu|breadcrumbs?|footer|share|sharing|social|related|newsletter|subscribe|popup|modal|"
    r"login|signup|widget|toolbar|pagination|search|complementary|contentinfo)(?:$|[\s_-])",
    re.I,
)
HEADER_NAMES = re.compile(r"(?:^|[\s_-])(?:header|masthead|topbar)(?:$|[\s_-])", re.I)


def read(page: str) -> Iterator[tuple[str, str, str]]:
    """``(kind, name, attributes or text)`` with kind ``open``, ``close`` or ``text``. The content of
    raw elements is left out; a tag cut off at the end is dropped."""
    at = 0
    while at < len(page):
        found = MARKUP.search(page, at)
        if not found:
            yield "text", "", page[at:]
            return
        if found.start() > at:
            yield "text", "", page[at : found.start()]
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            yield "close", name, ""
            continue
        yield "open", name, found[3]
        if name in RAW and not found[3].rstrip().endswith("/"):
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)


def _names(attributes: str) -> str:
    return " ".join("".join(m) for m in NAMES.findall(attributes)) if attributes else ""


class Walk:
    """The page's open block elements, and whether they lie in the article or beside it."""

    def __init__(self):
        #: Name, in_article, beside and path of each open element.
        self.open: list[tuple[str, bool, bool, str]] = [("", False, False, "")]
        self._top()

    def _top(self) -> None:
        _, self.in_article, self.beside, self.path = self.open[-1]

    def enter(self, name: str, attributes: str) -> None:
        if name in VOID or name in INLINE and not attributes or attributes.endswith("/"):
            return
        if name == "p" and self.path.endswith("/p"):
            self.leave("p")
        names = _names(attributes)
        main = name in ("article", "main") or "main" in names.lower().split()
        aside = name in ASIDE_ELEMENTS or bool(names and ASIDE_NAMES.search(names))
        if not self.in_article:
            aside = aside or name == "header" or bool(names and HEADER_NAMES.search(names))
        main = main and not aside
        if main and not self.in_article:
            # An element beside the article that was never closed ends here.
            while self.open[-1][2]:
                self.open.pop()
            self._top()
        if name not in INLINE or aside:
            self.open.append((name, self.in_article or main, self.beside or aside, f"{self.path}/{name}"))
            self._top()

    def leave(self, name: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == name:
                del self.open[i:]
                self._top()
                return
            # Within the article a stray end tag closes nothing outside.
            if self.open[i][1] and not self.open[i - 1][1] and name not in ("body", "html"):
                return


@lru_cache(maxsize=100_000)
def _token(kind: str, path: str, value: str) -> int:
    """An even number; those of ``_said`` are odd."""
    return (xxhash.xxh64_intdigest(f"{kind} {path} {value}".encode("utf-8", "surrogatepass")) & ~1) - (1 << 63)


def page_tokens(page: str) -> list[int]:
    """The page's tokens: tags and words, each with the elements around it. Words of the article
    stand in the whole run of text between two tags, see ``_said``."""
    walk, out, said = Walk(), [], []
    for kind, name, rest in read(page):
        if kind == "text":
            path, found = walk.path, html.unescape(rest).split()
            if walk.in_article and not walk.beside:
                said.append((path, found))
            else:
                out += [_token("word", path, w) for w in found]
        elif kind == "open":
            out.append(_token("tag", walk.path, f"{name} {_names(rest)}"))
            walk.enter(name, rest)
        else:
            walk.leave(name)
            out.append(_token("end", walk.path, name))
    for tokens in _said(said):
        out += tokens
    return out


def _said(runs: list[tuple[str, list[str]]]) -> list[list[int]]:
    """The tokens of each run of words of a page's article, given as ``path, words``.

    Prose repeats single words at will, so a word counts with its whole run and the run's number of
    times on the page. A run's first LEAST_TOKENS words stand for all: the others would have the
    same occurrence vector.
    """
    texts = [(path, " ".join(words)) for path, words in runs]
    times = Counter(texts)
    out = []
    for (path, text), (_, words) in zip(texts, runs):
        whole = xxhash.xxh64_intdigest(f"said {path} {times[path, text]} {text}".encode("utf-8", "surrogatepass"))
        out.append([(((whole + 2 * i) & ((1 << 64) - 1)) | 1) - (1 << 63) for i in range(min(len(words), LEAST_TOKENS))])
    return out


def occurrences(pages: DataFrame) -> DataFrame:
    """``host, token, n_pages, vector, place, differ``: of each token of each host the number of
    pages it is on, a hash of its occurrence vector, the sum of its first places, and whether two of
    its pages differ. The hash is a sum over pages, so that copies of a page count like others.

    Tasks combine what they have read, at most HELD_TOKENS entries at a time, before the shuffle.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list[int]] = {}

        def flush() -> pa.RecordBatch:
            rows = [(h, t, *v) for (h, t), v in held.items()]
            held.clear()
            kinds = (pa.string(), *[pa.int64()] * 7)
            columns = zip(*rows) if rows else [()] * 8
            names = ["host", "token", "n_pages", "high", "low", "place", "least", "most"]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for host, key, page in zip(*(batch.column(i) for i in range(3))):
                tokens = page_tokens(page.as_py() or "")
                first = {t: i for i, t in reversed(list(enumerate(tokens)))}
                own = xxhash.xxh64_intdigest((page.as_py() or "").encode("utf-8", "surrogatepass")) - (1 << 63)
                for token, count in Counter(tokens).items():
                    entry = held.setdefault((host.as_py(), token), [0, 0, 0, 0, own, own])
                    entry[0] += 1
                    high, low = divmod(xxhash.xxh64_intdigest(f"{key.as_py()} {count}"), 1 << 32)
                    entry[1] += high
                    entry[2] += low
                    entry[3] += first[token]
                    entry[4], entry[5] = min(entry[4], own), max(entry[5], own)
                if len(held) >= HELD_TOKENS:
                    yield flush()
        yield flush()

    parts = pages.select("host", "key", "html").mapInArrow(counted, "host string, token long, n_pages long, high long, low long, place long, least long, most long")
    vector = F.struct(F.sum("high").alias("high"), F.sum("low").alias("low")).alias("vector")
    differ = (F.min("least") < F.max("most")).alias("differ")
    return parts.groupBy("host", "token").agg(F.sum("n_pages").alias("n_pages"), vector, F.sum("place").alias("place"), differ)


def templates(pages: DataFrame) -> DataFrame:
    """``host, template``: the tokens of the host's valid classes in their common order.

    A token on at least half of the pages is one of at most twice as many as a page has on average,
    so the list stays as small as a page.
    """
    sizes = pages.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= LEAST_PAGES)
    said = F.col("token").bitwiseAND(1) == 1
    share = F.when(said, LEAST_SAID_SHARE).otherwise(LEAST_SHARE)
    often = occurrences(pages).join(sizes, "host").where((F.col("n_pages") >= share * F.col("pages")) & F.col("differ"))
    often = often.where(~said | (F.col("n_pages") >= LEAST_PAGES))
    often = written(often, "tokens")
    classes = often.groupBy("host", "vector").agg(F.count("*").alias("size")).where(F.col("size") >= LEAST_TOKENS)
    members = often.join(classes, ["host", "vector"])
    order = F.struct((F.col("place") / F.col("n_pages")).alias("at"), "token")
    return members.groupBy("host").agg(F.transform(F.sort_array(F.collect_list(order)), lambda x: x["token"]).alias("template"))


def main_text(page: str | None, template: list[int] | None = None) -> str:
    """The text of the page's main slots, one space between blocks."""
    if not page:
        return ""
    known = {t: i for i, t in enumerate(template or ())}
    walk, slots, reached, link = Walk(), [], -1, 0
    article = False
    # Of each block its text and how many words it has, in links, and of the template.
    blocks: list[list] = [["", 0, 0, 0]]
    said: list[tuple[str, list[str]]] = []
    said_in: list[list] = []

    def close_slot() -> None:
        if len(blocks) > 1 or blocks[0][0]:
            slots.append((where, list(blocks)))
        blocks[:] = [["", 0, 0, 0]]

    where = False
    for kind, name, rest in read(page):
        if kind == "text":
            inside = walk.in_article and not walk.beside
            article |= inside
            if inside != where:
                close_slot()
                where = inside
            if walk.beside:
                continue
            block = blocks[-1]
            block[0] += rest
            if inside and known:
                found = html.unescape(rest).split()
                block[1] += len(found)
                said.append((walk.path, found))
                said_in.append(block)
            if not inside:
                found = html.unescape(rest).split()
                block[1] += len(found)
                block[2] += len(found) if link else 0
                block[3] += sum(_token("word", walk.path, w) in known for w in found) if known else 0
            continue
        link = max(0, link + (1 if kind == "open" else -1)) if name == "a" else link
        token = None
        if kind == "open":
            token = _token("tag", walk.path, f"{name} {_names(rest)}") if known else None
            walk.enter(name, rest)
        else:
            walk.leave(name)
            token = _token("end", walk.path, name) if known else None
        if name in INLINE:
            continue
        if known.get(token, -1) > reached:
            reached = known[token]
            close_slot()
        else:
            blocks.append(["", 0, 0, 0])
    close_slot()
    for tokens, (_, words), block in zip(_said(said), said, said_in):
        block[3] += len(words) if tokens and tokens[0] in known else 0
    kept = []
    for inside, parts in slots:
        if article:
            # Tags of the article recur on a page and cut no slots, so its blocks are judged one by one.
            kept += [text for text, n, _, fixed in parts if inside and (not n or fixed < n)]
            continue
        n, linked, fixed = (sum(part[i] for part in parts) for i in (1, 2, 3))
        kept += [part[0] for part in parts] if 2 * linked <= n and fixed < n else []
    return " ".join(x for x in (SPACE.sub(" ", html.unescape(b)).strip() for b in kept) if x)


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", text_col: str = "main_text") -> DataFrame:
    """``pages`` with ``text_col``, the main text of the whole page; a column of that name is replaced."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)", 1))
    keyed = pages.select(host.alias("host"), F.xxhash64(url_col, html_col).alias("key"), F.col(html_col).alias("html"))
    found = written(templates(keyed), "templates")
    name_host, name_template = free_names(pages, "host", "template")
    tokens = found.agg(F.sum(F.size("template"))).first()[0] or 0
    found = found.select(F.col("host").alias(name_host), F.col("template").alias(name_template))
    joined = pages.join(F.broadcast(found) if tokens <= BROADCAST_TOKENS else found, host == F.col(name_host), "left")

    @F.arrow_udf("string")
    def texts(htmls: pa.Array, known: pa.Array) -> pa.Array:
        out = []
        for page, template in zip(htmls, known):
            out.append(main_text(page.as_py(), template.as_py()))
        return pa.array(out, pa.string())

    return joined.withColumn(text_col, texts(F.col(html_col), F.col(name_template))).drop(name_host, name_template)
