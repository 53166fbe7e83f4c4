"""HTML extraction (operator 6): page structure, and a host suffix array for what structure does not settle.

1. Every page is read into blocks (texts between block tags). A block lies in the page's article, in a part that is never
   article (menus, headers, footers, sidebars, notices, adverts, forms, reader comments, scripts, styles), or in neither.
   The article is the text of the ``article`` elements, else of ``main``, else of parts whose class or id says so.
2. The blocks outside the article form the page's token stream. Streams of a host are concatenated in shards; a suffix
   array (prefix doubling up to ``RUN`` tokens) groups equal substrings of RUN tokens, and their counts of distinct
   pages are summed over the host's shards. A longer repeated substring is a chain of overlapping ones.
3. On pages without a marked article, tokens covered by substrings that stand on at least ``MIN_PAGES`` distinct pages and
   on ``MIN_SHARE`` of the host's pages are removed as boilerplate; the unique runs that remain are the text. Where less than
   ``MIN_LEFT`` of a page's tokens would remain, the page itself repeats (a print version, a mirror) and is kept whole: no
   page loses its body to its near copies. An article that is marked is kept whole, also where it repeats on other pages.

Class and id names count by whole tokens. A token says "never article" if it is such a word, or a compound of such words and
of words for places and boxes (``ad-top``, ``share-buttons``, ``site-footer``); ``entry-header`` or ``copyright-law`` say nothing.

Character references are decoded, white space in a block becomes one space, blocks are trimmed, empty ones go, and the
rest is joined in page order by one line feed.

Scale: pages that are equal in their stream count once, so copies of a page neither mark themselves as boilerplate nor pile
up. A hot host is cut into shards of at most about ``SHARD_PAGES`` pages by hash of the stream; only the streams outside
articles are shuffled, and the counts of a substring are one row per shard.

Defined results: NULL and empty html give the empty text. A NULL or odd url counts as the host "". Rows are independent
but for the host counts; repeated rows repeat their result; an empty table gives an empty result; extra columns pass
through, and one named like a result column raises ``ValueError``.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import broadcast_if_small, checkpointed, pieces, refuse_clash

RUN = 8
MIN_PAGES = 3
MIN_SHARE = 0.2
MIN_LEFT = 0.2
SHARD_PAGES = 2048

# Element names and class words by their role.
NEVER = frozenset("nav header footer aside form script style noscript template iframe svg math canvas object audio video button select "
                  "textarea input menu dialog head title option datalist".split())  # fmt: skip
RAW = frozenset("script style textarea title noscript iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table tbody tfoot thead "
                   "tr caption ul title".split())  # fmt: skip
SPACES = frozenset("br td th wbr".split())
CLOSES = {"p": "p", "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr", "option": "option"}
NEVER_WORDS = frozenset("ad ads advert adverts advertisement sponsor sponsored promo promotion banner sidebar nav navbar navigation menu "
                        "breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices alert popup modal "
                        "newsletter subscribe subscription signup login share sharing social related recommended comment comments reply "
                        "replies disqus widget toolbar pagination pager copyright legal disclaimer skip".split())  # fmt: skip
NEVER_ARTICLE = frozenset("ad ads advert advertisement sponsored promo related recommended teaser comment comments reply replies".split())
PLACE_WORDS = frozenset("site page global top bottom left right main inner outer box bar block list item items link links button buttons icon icons "
                        "slot unit zone area container wrapper wrap section row column col inline post posts article articles form text".split())  # fmt: skip
MAIN_WORDS = frozenset("article content main post entry story maincontent articlebody".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())

_PART = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|([^<]+)|<", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def _is_never(token: str, words: frozenset[str]) -> bool:
    """Whether a class or id token is one of the words, or a compound of them with words for places and boxes."""
    parts = [p for p in re.split(r"[-_]+|(?<=\D)(?=\d)", token) if p]
    own = [p in words for p in parts]
    return any(own) and all(o or p in PLACE_WORDS or p.isdigit() for o, p in zip(own, parts))


def _role(tag: str, attributes: str, in_article: bool) -> int | None:
    """-1: never article; 1 to 3: how strongly the element claims to be the article; None: neither."""
    level = {"article": 3, "main": 2}.get(tag)
    if tag in NEVER and not (tag == "header" and in_article):  # an article's own header holds its title
        return -1
    if not attributes.strip(" \t\r\n/"):
        return level
    at = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in at or at.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", at.get("style", "")):
        return -1
    role = at.get("role", "").lower()
    names = f"{at.get('class', '')} {at.get('id', '')}".lower().split()
    if level:
        return -1 if any(_is_never(n, NEVER_ARTICLE) for n in names) else level
    if tag in ("html", "body"):
        return None
    if role in NEVER_ROLES or any(_is_never(n, NEVER_WORDS) for n in names):
        return -1
    if role == "main":
        return 2
    words = {w for n in names for w in re.findall(r"[a-z0-9]+", n)}
    return 1 if words & MAIN_WORDS else None


def read_blocks(page: str | None) -> list[tuple[int, str]]:
    """(place, text) of the page's blocks in order; place -1: never article, 0: neither, 1 to 3: strength of the claim."""
    blocks: list[tuple[int, str]] = []
    open_: list[tuple[str, int]] = [("", 0)]  # element and the place of what it holds
    count: dict[str, int] = {}  # open elements by name
    text: list[str] = []  # of the block that is being read
    never: list[str] = []  # what stands in it but in elements that are never article
    text_place = 0

    def close(i: int) -> None:
        for name, _ in open_[i:]:
            count[name] -= 1
        del open_[i:]

    def enter(name: str, place: int) -> None:
        open_.append((name, place))
        count[name] = count.get(name, 0) + 1

    def flush() -> None:
        for place, parts in ((text_place, text), (-1, never)):
            joined = " ".join("".join(parts).split()) if parts else ""
            parts.clear()
            if joined:
                blocks.append((place, joined))

    def add(part: str) -> None:
        nonlocal text_place
        place = open_[-1][1]
        if place < 0:
            never.append(part)
            return
        if place != text_place:
            flush()
            text_place = place
        text.append(part)

    page, at = page or "", 0
    while m := _PART.match(page, at):
        at = m.end()
        if m[4] is not None:
            add(html.unescape(m[4]) if "&" in m[4] else m[4])
            continue
        if m[2] is None:
            if m[0] == "<":
                add("<")
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCKS:
                flush()
            if count.get(tag):
                i = len(open_) - 1
                while open_[i][0] != tag:
                    i -= 1
                close(i)
            continue
        if tag in SPACES:
            add(" ")
        if tag in BLOCKS:
            flush()
            if tag in CLOSES or tag in ("div", "section", "article", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6"):
                for name in CLOSES.get(tag, "p").split():
                    if open_[-1][0] == name:
                        close(len(open_) - 1)
        if tag in VOID or m[3].rstrip().endswith("/"):
            continue
        place = open_[-1][1]
        role = _role(tag, m[3], place > 0)
        if role is not None and role != place and place >= 0:
            enter(tag, -1 if role < 0 else max(place, role))
        elif tag in BLOCKS:
            enter(tag, place)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
    flush()
    return blocks


def split_page(page: str | None) -> tuple[list[str] | None, list[str], list[str]]:
    """(blocks of the marked article, or None; blocks that may be article on a page without one; all blocks outside)."""
    blocks = read_blocks(page)
    level = max((p for p, _ in blocks), default=0)
    if level > 0:
        return [t for p, t in blocks if p == level], [], [t for p, t in blocks if p != level]
    return None, [t for p, t in blocks if p == 0], [t for _, t in blocks]


# ---- suffix array of a shard -----------------------------------------------------------------------------------------
def suffix_ranks(tokens: np.ndarray, length: int) -> np.ndarray:
    """Prefix doubling: rank of every suffix by its first ``length`` tokens (a power of two); equal ranks mean equal
    substrings. Suffixes that end before sort by what they have."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    width = 1
    while width < length:
        after = np.zeros_like(rank)
        if width < len(rank):
            after[:-width] = rank[width:]
        rank = np.unique(rank * (len(rank) + 2) + after, return_inverse=True)[1].astype(np.int64) + 1
        width *= 2
    return rank


def _tokens(blocks: Sequence[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for b in blocks for w in b.split(" ")), np.uint64)


def _run_hashes(tokens: np.ndarray, run: int) -> np.ndarray:
    """One hash per substring of ``run`` tokens."""
    out = np.zeros(max(0, len(tokens) - run + 1), np.uint64)
    for i in range(run):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + tokens[i : i + len(out)]
    return out ^ (out >> np.uint64(32))


def _shard_counts(pdf: pd.DataFrame, run: int) -> pd.DataFrame:
    """Suffix array of a shard's streams: (host, hash, pages) of its distinct substrings of ``run`` tokens."""
    streams = [np.frombuffer(s, "<u8") for s in pdf["stream"]]
    lengths = np.array([len(s) for s in streams])
    tokens, page = np.concatenate(streams), np.repeat(np.arange(len(streams)), lengths)
    left = np.concatenate([np.arange(n, 0, -1) for n in lengths])
    rank = suffix_ranks(tokens, run)
    order = np.lexsort((page, rank))
    order = order[left[order] >= run]  # substrings that cross into the next page are none
    first = np.flatnonzero(np.append(True, np.diff(rank[order]) != 0)) if len(order) else np.empty(0, int)
    new_page = np.append(True, (np.diff(rank[order]) != 0) | (np.diff(page[order]) != 0)) if len(order) else np.empty(0, bool)
    pages = np.add.reduceat(new_page.astype(np.int64), first) if len(order) else np.empty(0, np.int64)
    hashes = _run_hashes(tokens, run)[order[first]] if len(order) else np.empty(0, np.uint64)
    return pd.DataFrame({"host": pdf["host"].iloc[0], "hash": hashes.view(np.int64), "pages": pages})


def _positions(run: int):
    """(host, hash, stream_key, at) of every substring of the streams that have to be cleaned."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for host, key, blocks in zip(*(batch.column(c).to_pylist() for c in ("host", "own_key", "candidates")), strict=True):
                h = _run_hashes(_tokens(blocks), run)
                n = len(h)
                cols = [pa.array([host] * n, pa.string()), pa.array(h.view(np.int64)), pa.array([key] * n, pa.int64()), pa.array(np.arange(n))]
                yield pa.RecordBatch.from_arrays(cols, names=["host", "hash", "own_key", "at"])

    return make


def clean(blocks: Sequence[str], covered_at: Sequence[int], run: int, min_left: float = MIN_LEFT) -> list[str]:
    """The blocks without the tokens that lie in a substring of ``run`` tokens starting at one of ``covered_at``; all of them
    if less than ``min_left`` of the tokens would remain."""
    words = [b.split(" ") for b in blocks]
    n = sum(map(len, words))
    bad = np.zeros(n + run, bool)
    for at in covered_at:
        bad[at : at + run] = True
    if n - bad.sum() < min_left * n:
        return list(blocks)
    out, i = [], 0
    for ws in words:
        kept = " ".join(w for j, w in enumerate(ws) if not bad[i + j])
        i += len(ws)
        if kept:
            out.append(kept)
    return out


_READ = "host string, article string, candidates array<string>, outside array<string>, stream_key bigint, own_key bigint"
RESULT = "text string, n_chars bigint"


def _parse(df: DataFrame, url_col: str, html_col: str, keep: Sequence[str]) -> DataFrame:
    names = [f"k{i}" for i in range(len(keep))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = lambda blocks: xxhash.xxh3_64_intdigest("\n".join(blocks)) - (1 << 63)
        for batch in batches:
            for part in pieces(batch, ["html"]):
                split = [split_page(p) for p in part.column("html").to_pylist()]
                cols = [
                    pa.array([host_of(u) for u in part.column("url").to_pylist()], pa.string()),
                    pa.array([None if a is None else "\n".join(a) for a, _, _ in split], pa.string()),
                    pa.array([c for _, c, _ in split], pa.list_(pa.string())),
                    pa.array([o for _, _, o in split], pa.list_(pa.string())),
                    pa.array([key(o) for _, _, o in split], pa.int64()),
                    pa.array([key(c) for _, c, _ in split], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], *cols], names=[*names, *[c.split(" ")[0] for c in _READ.split(", ")]])

    kept = ", ".join(f"{n} {df.schema[c].dataType.simpleString()}" for c, n in zip(keep, names, strict=True))
    return rows.mapInArrow(run, f"{kept}, {_READ}" if kept else _READ)


def repeated_runs(streams: DataFrame, run: int = RUN, min_pages: int = MIN_PAGES, shard_pages: int = SHARD_PAGES,
                  min_share: float = MIN_SHARE) -> DataFrame:
    """(host, hash) of the substrings of ``run`` tokens that stand on at least ``min_pages`` distinct streams of a host and on
    ``min_share`` of its streams of that length. ``streams`` has host, stream_key and outside (blocks)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = pa.array([_tokens(b).astype("<u8").tobytes() for b in batch.column("outside").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("stream_key"), s], names=["host", "stream_key", "stream"])

    coded = streams.select("host", "stream_key", "outside").mapInArrow(encode, "host string, stream_key bigint, stream binary")
    coded = checkpointed(coded.where(F.length("stream") >= 8 * run).dropDuplicates(["host", "stream_key"]))
    hosts = checkpointed(coded.groupBy("host").agg(F.count("*").alias("streams")))
    shards = hosts.select("host", F.ceil(F.col("streams") / F.lit(shard_pages)).cast("int").alias("shards"))
    dealt = coded.join(shards, "host").withColumn("shard", F.pmod(F.xxhash64("stream_key"), F.col("shards")).cast("int"))
    counts = dealt.select("host", "shard", "stream").groupBy("host", "shard").applyInPandas(
        lambda pdf: _shard_counts(pdf, run), "host string, hash bigint, pages bigint")
    counts = counts.groupBy("host", "hash").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= min_pages)
    return counts.join(broadcast_if_small(hosts), "host").where(F.col("pages") >= F.col("streams") * min_share).select("host", "hash")


def extract(
    df: DataFrame, url_col: str = "url", html_col: str = "html", keep: Sequence[str] | None = None, run: int = RUN,
    min_pages: int = MIN_PAGES, shard_pages: int = SHARD_PAGES,
) -> DataFrame:
    """The ``keep`` columns (default: all) plus ``text`` and ``n_chars`` of every page."""
    keep = df.columns if keep is None else list(keep)
    refuse_clash(keep, RESULT)
    names = [f"k{i}" for i in range(len(keep))]
    # Two readings: a narrow one for what lies outside articles, written once, and a last one for marked articles, which
    # are handed on as they are read.
    first = _parse(df, url_col, html_col, keep).withColumn("marked", F.col("article").isNotNull())
    needed = [F.when(~F.col("marked"), F.col(n)).alias(n) for n in names]
    parsed = checkpointed(first.select(*needed, "marked", "host", "candidates", "outside", "stream_key", "own_key"))
    marked = _parse(df, url_col, html_col, keep).where("article is not null").select(*names, F.col("article").alias("text"))

    unmarked = parsed.where("not marked").select(*names, "host", "own_key", "candidates")
    repeated = checkpointed(repeated_runs(parsed, run, min_pages, shard_pages))
    own = unmarked.select("host", "own_key", "candidates").dropDuplicates(["host", "own_key"])
    places = own.mapInArrow(_positions(run), "host string, hash bigint, own_key bigint, at bigint")
    covered = places.join(repeated, ["host", "hash"]).groupBy("host", "own_key").agg(F.collect_list("at").alias("covered"))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("candidates").to_pylist(), batch.column("covered").to_pylist(), strict=True)
            text = ["\n".join(clean(c or [], at or [], run)) for c, at in both]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("own_key"), pa.array(text, pa.string())], names=["host", "own_key", "text"])

    texts = own.join(covered, ["host", "own_key"], "left").mapInArrow(strip, "host string, own_key bigint, text string")
    cleaned = unmarked.select(*names, "host", "own_key").join(texts, ["host", "own_key"]).select(*names, "text")
    out = marked.unionByName(cleaned)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "text", F.char_length("text").cast("bigint").alias("n_chars"))
