"""Main text of web pages from their structure and a host-wide suffix array.

Pages are read once, by a scanner that passes over every sign a bounded number of times, into blocks of text in page order, which are
stored with a number for each page. A block is *main* inside an article or main
element, *chrome* inside navigation, headers, footers, asides, forms that hold no such element, hidden elements, and elements of
which a token of class, id or role says so (adverts, notices, comments and the like), and *loose* otherwise. A token says
so if it consists of such words, or begins or ends with one (``share-buttons``, ``post-comments``) and has no word of state or
layout (``has-sidebar``, ``menu-open``). Tokens never mark html, body, main and article elements, nor headers inside main ones. A main element inside
a marked one is main again; so is an article there if the page has no other main text. Scripts,
styles and comments are no text.

The token streams outside main elements form a suffix array per host, in which every suffix is ordered
by the fingerprint of its first ``RUN`` tokens. Pages of a host with equal text (copies under other
addresses) count as one, by one of their streams. Each task sorts the suffixes of its own pages and keeps one row
per distinct prefix with the number of pages; the shuffle merges these arrays, so a
host with a third of all pages is one row per task and prefix. A prefix is repeated if at least ``LEAST_PAGES`` pages and the
share ``SHARE`` of the host's pages hold it. Loose blocks that repeated prefixes cover as a whole are removed, and
inside others covered runs of ``LONG_RUN`` tokens or more. A page of which that would leave nothing keeps its
loose text. Main blocks are kept whatever repeats, chrome goes in any case.

A null or empty html gives an empty text; a null url is a host of its own. Rows that repeat an id, an url or both
are pages of their own. A tag that never ends is text. Very long pages are read whole. Extra columns are left out. An empty table gives none.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm.textops import by_bytes, mix, some_rows
from adloom.session import scratch_dir

RUN = 8  # tokens
LONG_RUN = 24
LEAST_PAGES, SHARE = 3, 0.05  # of a host

# Element names and words of class, id and role attributes that mark what is not main text.
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes"}
DROPPED = {"nav", "menu", "header", "footer", "aside", "form", "dialog", "template", "noscript", "iframe", "svg", "math", "canvas", "object", "audio",
           "video", "button", "select", "datalist", "fieldset", "head"}
CHROME_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
                "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "menu", "modal", "nav", "navbar",
                "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "search", "share", "sharing", "sidebar", "social",
                "sponsor", "sponsored", "subscribe", "toolbar", "widget", "cookiebar", "cookiebanner", "sharebar", "adslot", "adbox"}
# Words that make a token tell a state or a layout instead.
STATE_WORDS = {"has", "no", "not", "with", "without", "is", "open", "opened", "closed", "on", "off", "enabled", "disabled", "active", "inactive", "visible",
               "wrap", "wrapper", "content", "layout", "page", "body", "main", "article", "text", "entry"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
          "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_COMMENT_END = re.compile(r"--!?>")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])", re.I)
_STYLE = re.compile(r"""(?<![\w-])style\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_MARKS = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PARTS = re.compile(r"[-_:]+")
_HOLDERS = {"article", "main"}
_UNMARKED = {"html", "body", *_HOLDERS}
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
_SPACE = re.compile(r"\s+")
_FORM = re.compile(r"<form", re.I)

MAIN, LOOSE, CHROME, HELD = 0, 1, 2, 3  # held: an article inside a marked element


@dataclass
class Block:
    kind: int
    text: str


class Tag(NamedTuple):
    start: int
    name: str  # in lower case; empty for comments, declarations and the like
    closing: bool
    attributes: str


def _marks(token: str, inside_main: bool) -> bool:
    """Whether a token says chrome (``ad``, ``cookie-notice``, ``share-buttons``; not ``has-sidebar``, ``menu-open``)."""
    words = [w for w in _PARTS.split(token) if w]
    if not words or (inside_main and words[-1] == "header"):
        return False
    if all(w in CHROME_WORDS for w in words):
        return True
    return not STATE_WORDS.intersection(words) and (words[0] in CHROME_WORDS or words[-1] in CHROME_WORDS)


def _is_marked(attributes: str, inside_main: bool = False) -> bool:
    """Whether class, id or role have a token that says chrome."""
    return "=" in attributes and any(_marks(token, inside_main) for m in _MARKS.finditer(attributes) for token in m[1].strip("\"'").lower().split())


def _is_hidden(attributes: str) -> bool:
    lowered = attributes.lower()
    if "hidden" not in lowered and "display" not in lowered:
        return False
    bare = _QUOTED.sub('""', attributes)
    return bool(_HIDDEN.search(bare)) or any(_UNSEEN.search(m[1]) for m in _STYLE.finditer(attributes))


def _tag_end(page: str, at: int) -> int:
    """Where the tag ends whose attributes begin at ``at``; -1 if nowhere. A quote that is never closed
    does not count, which can happen once for each kind of quote."""
    while (stop := _STOP.search(page, at)) is not None:
        sign = stop[0]
        if sign == ">":
            return stop.end()
        closed = page.find(sign, stop.end())
        at = stop.end() if closed < 0 else closed + 1
    return -1


def _tags(page: str) -> Iterator[tuple[int, int, Tag | None]]:
    """Begin and end of the text before each tag, and the tag; the text of raw elements is left out."""
    begin = at = 0
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = _COMMENT_END.search(page, start + 2)
            tag, after = Tag(start, "", False, ""), len(page) if end is None else end.end()
        else:
            closing = page.startswith("</", start)
            name = _NAME.match(page, start + 1 + closing)
            if name is None and not page.startswith(("<!", "<?"), start):
                at = start + 1
                continue
            if name is None or closing:
                after = page.find(">", start) + 1
            else:
                after = _tag_end(page, name.end())
            if after <= 0:  # no tag ends from here on
                break
            tag = Tag(start, name[0].lower(), closing, page[name.end() : after - 1]) if name else Tag(start, "", False, "")
        yield begin, start, tag
        begin = at = after
        if tag.name in RAW and not tag.closing:  # ends at its own end tag only
            end = _RAW_ENDS[tag.name].search(page, at)
            begin = at = len(page) if end is None else end.end()
    yield begin, len(page), None


def _holding_forms(page: str) -> set[int]:
    """Where forms begin that hold an article or main element."""
    found: set[int] = set()
    if not _FORM.search(page):
        return found
    open_forms: list[int] = []
    for _, _, tag in _tags(page):
        if tag is None:
            break
        if tag.name == "form" and not tag.closing:
            open_forms.append(tag.start)
        elif tag.name == "form" and open_forms:
            open_forms.pop()
        elif tag.name in _HOLDERS and not tag.closing:
            found.update(open_forms)
            open_forms = []
    return found


def blocks(page: str) -> list[Block]:
    """Text blocks in page order, empty ones left out."""
    out: list[Block] = []
    parts: list[str] = []
    open_names: list[str] = []
    open_count: Counter[str] = Counter()
    open_kinds: list[int] = []
    kind = LOOSE

    def close() -> None:
        if parts:
            text = "".join(parts)
            if "&" in text:
                text = entities.unescape(text)
            text = _SPACE.sub(" ", text).strip()
            if text:
                out.append(Block(kind, text))
            parts.clear()

    forms = _holding_forms(page)
    open_soft: list[bool] = []  # chrome by marks alone, outside main elements
    for begin, end, tag in _tags(page):
        if end > begin:
            parts.append(page[begin:end])
        if tag is None:
            break
        name = tag.name
        if tag.closing:
            if name not in INLINE:
                close()
            if open_count.get(name):
                while (ended := open_names.pop()) != name:
                    open_count[ended] -= 1
                    open_kinds.pop()
                    open_soft.pop()
                open_count[name] -= 1
                open_kinds.pop()
                open_soft.pop()
                new = open_kinds[-1] if open_kinds else LOOSE
                if new != kind:
                    close()
                    kind = new
        elif name:
            if name in RAW:
                continue
            if name not in INLINE:
                close()
            elif name == "br":
                parts.append(" ")
            if name in VOID or tag.attributes.endswith("/"):
                continue
            new, soft = kind, bool(open_soft) and open_soft[-1]
            within = kind in (MAIN, HELD)
            marks = name not in _UNMARKED and _is_marked(tag.attributes, within)
            if (name in DROPPED and not (name == "header" and within) and tag.start not in forms) or (name not in ("html", "body") and _is_hidden(tag.attributes)):
                new, soft = CHROME, False
            elif kind == CHROME:
                if soft and name == "main":
                    new, soft = MAIN, False
                elif soft and name == "article" and not _is_marked(tag.attributes):
                    new, soft = HELD, False
            elif marks:
                new, soft = CHROME, not within
            elif name in _HOLDERS and kind != HELD:
                new = MAIN
            if name not in INLINE or new != kind:
                open_names.append(name)
                open_count[name] += 1
                open_kinds.append(new)
                open_soft.append(soft)
                if new != kind:
                    close()
                    kind = new
    close()
    held = CHROME if any(b.kind == MAIN for b in out) else MAIN
    for block in out:
        if block.kind == HELD:
            block.kind = held
    return out


def _fingerprints(tokens: list[str]) -> np.ndarray:
    """Of the ``RUN`` tokens from each position on."""
    if len(tokens) < RUN:
        return np.zeros(0, dtype=np.uint64)
    value = np.array([hash_of(t) for t in tokens], dtype=np.uint64)
    n = len(tokens) - RUN + 1
    found = np.zeros(n, dtype=np.uint64)
    for k in range(RUN):
        found = mix(found + value[k : k + n])
    return found


def hash_of(token: str) -> int:
    data = token.encode()
    return (zlib.crc32(data) << 32) | zlib.crc32(data, 0x5BD1E995)


def _host_seed(url: str | None) -> np.uint64:
    host = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*).*", r"\1", url or "", flags=re.S).lower()
    return np.uint64(hash_of(host))


def _streams(found: list[Block]) -> tuple[list[str], list[tuple[int, int, int]]]:
    """Tokens outside main blocks, and (block, first token, tokens) of the loose ones."""
    tokens: list[str] = []
    loose = []
    for k, block in enumerate(found):
        if block.kind != MAIN:
            words = block.text.split(" ")
            if block.kind == LOOSE:
                loose.append((k, len(tokens), len(words)))
            tokens += words
    return tokens, loose


_STORED = "host long, kinds array<tinyint>, texts array<string>"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as their blocks."""
    for batch in by_bytes(batches, column=2):
        hosts, kinds, texts = [], [], []
        for url, html in zip(*(batch.column(k).to_pylist() for k in (1, 2)), strict=True):
            found = blocks(html or "")
            hosts.append(_host_seed(url))
            kinds.append([b.kind for b in found])
            texts.append([b.text for b in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(3), pa.array(np.array(hosts, np.uint64).view(np.int64)), pa.array(kinds, pa.list_(pa.int8())), pa.array(texts, pa.list_(pa.string()))],
            ["_id", "_url", "host", "kinds", "texts"])


def _blocks_of(kinds: list[int], texts: list[str]) -> list[Block]:
    return [Block(k, t) for k, t in zip(kinds, texts, strict=True)]


def _page_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host, fingerprint of the text and tokens outside main blocks, of pages with enough of them."""
    for batch in some_rows(batches):
        hosts, prints, streams = [], [], []
        for host, kinds, texts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found = _blocks_of(kinds, texts)
            tokens, _ = _streams(found)
            if len(tokens) >= RUN:
                text = "\n\n".join(b.text for b in found if b.kind != CHROME)
                hosts.append(host)
                prints.append(hashlib.blake2b(text.encode(), digest_size=16).digest())
                streams.append(" ".join(tokens))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.int64()), pa.array(prints, pa.binary()), pa.array(streams, pa.string())], ["host", "print", "stream"])


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted array for each run of pages: prefix, host, pages."""
    for batch in some_rows(batches):
        keys, hosts = [], []
        for host, stream in zip(batch.column(0).to_numpy(), batch.column(1).to_pylist(), strict=True):
            key = _fingerprints(stream.split(" "))
            keys.append(mix(np.unique(key) ^ np.int64(host).view(np.uint64)))
            hosts.append(np.full(len(keys[-1]), host))
        if not keys:
            continue
        key, host = np.concatenate(keys), np.concatenate(hosts)
        order = np.argsort(key, kind="stable")
        key, host = key[order], host[order]
        at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[at].view(np.int64)), pa.array(host[at]), pa.array(np.diff(np.append(at, len(key))))], ["key", "host", "n"])


def _removed(found: list[Block], gone: np.ndarray, loose: list[tuple[int, int, int]]) -> dict[int, np.ndarray]:
    """By loose block, the tokens to leave out: all, or long runs; none if nothing of the page would be left."""
    out = {}
    for k, first, n in loose:
        own = gone[first : first + n].copy()
        if not own.all():
            edges = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8)))
            for a, b in edges.reshape(-1, 2):
                if b - a < LONG_RUN:
                    own[a:b] = False
        out[k] = own
    if all(b.kind != MAIN for b in found) and all(x.all() for x in out.values()):
        return {}
    return out


def _joined(found: list[Block], covered: dict[int, np.ndarray] | None = None) -> str:
    texts = []
    for k, block in enumerate(found):
        if block.kind == MAIN:
            texts.append(block.text)
        elif block.kind == LOOSE:
            gone = (covered or {}).get(k)
            if gone is None or not gone.any():
                texts.append(block.text)
            else:
                words = [w for w, g in zip(block.text.split(" "), gone, strict=True) if not g]
                if words:
                    texts.append(" ".join(words))
    return "\n\n".join(texts)


def _loose_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page number, prefix, place) of the substrings that touch loose tokens."""
    for batch in some_rows(batches):
        for number, host, kinds, texts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            tokens, loose = _streams(_blocks_of(kinds, texts))
            if not loose or len(tokens) < RUN:
                continue
            key = mix(_fingerprints(tokens) ^ np.int64(host).view(np.uint64))
            near = np.zeros(len(key), dtype=bool)
            for _, first, n in loose:
                near[max(0, first - RUN + 1) : first + n] = True
            at = np.flatnonzero(near)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), number)), pa.array(key[at].view(np.int64)), pa.array(at.astype(np.int32))], ["number", "key", "at"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in some_rows(batches):
        out = []
        for kinds, texts, repeated in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
            found = _blocks_of(kinds, texts)
            tokens, loose = _streams(found)
            gone = np.zeros(len(tokens), dtype=bool)
            for at in repeated or []:
                gone[at : at + RUN] = True
            out.append(_joined(found, _removed(found, gone, loose)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["_id", "_url", "text"])


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Row per page: the id and url columns and ``text``."""
    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_site"), F.col(html_col).cast("string").alias("_html"), F.col(url_col).alias("_url"))
    spark, path = pages.sparkSession, scratch_dir(pages.sparkSession, "page-blocks")
    (rows.mapInArrow(_read, f"_id {id_type}, _url {url_type}, {_STORED}").withColumn("number", F.monotonically_increasing_id())
     .write.option("compression", "zstd").parquet(f"{path}/pages"))
    stored = spark.read.parquet(f"{path}/pages")  # numbers stay as they were written
    (stored.select("host", "kinds", "texts").mapInArrow(_page_streams, "host long, print binary, stream string").groupBy("host", "print").agg(F.min("stream").alias("stream"))
     .select("host", "stream").write.option("compression", "zstd").parquet(f"{path}/streams"))
    streams = spark.read.schema("host long, stream string").parquet(f"{path}/streams")
    hosts = (streams.groupBy("host").agg(F.greatest(F.lit(LEAST_PAGES), F.ceil(F.count("*") * SHARE)).alias("least"))
             .repartition("host", "least"))  # dealt anew, so that the join can split a hot host
    repeated = (streams.mapInArrow(_suffixes, "key long, host long, n long").groupBy("key", "host").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_PAGES)
                .join(hosts, "host").where(F.col("n") >= F.col("least")).select("key", "n").repartition("key", "n").select("key"))
    is_loose = F.array_contains("kinds", F.lit(LOOSE).cast("tinyint"))
    loose = stored.where(is_loose)
    found = (loose.select("number", "host", "kinds", "texts").mapInArrow(_loose_suffixes, "number long, key long, at int").join(repeated, "key")
             .groupBy("number").agg(F.collect_set("at").alias("at")))
    columns = ("_id", "_url", "kinds", "texts")
    # Pages without loose blocks wait for nothing: none of theirs hangs on other pages.
    plain = stored.where(~is_loose).select(*columns, F.lit(None).cast("array<int>").alias("at"))
    cut = plain.unionAll(loose.join(found, "number", "left").select(*columns, "at")).mapInArrow(_cut, f"_id {id_type}, _url {url_type}, text string")
    return cut.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
