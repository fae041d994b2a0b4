"""Main text of web pages, with boilerplate found by suffix arrays over the pages of a host.

A page becomes a list of blocks; each knows its zone: ``article`` (inside article or main), ``body``
(elsewhere) or none, if it is dropped by its element or class (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, reader comments). Class, id, role, hidden and the element form
never drop an outermost article or main, nor an element that one starts in; elements by whose own name text
goes (nav, aside, footer, a page's header) and elements whose class or id names reader comments go with all
that is in them. An article inside an article is a part like others, and goes if it is hinted at; so
does one named as a comment behind another article. The words of all blocks that are left form the page's
token stream.

The streams of a host's pages are concatenated and their suffixes sorted by prefix doubling; neighbours in
that order that share ``RUN`` tokens or more are the occurrences of a repeated substring. A larger host is dealt by
hash over chunks of about ``CHUNK_BYTES``, so that no task holds a whole host; there runs of ``RUN`` tokens
have 64-bit hashes, chunks count their distinct pages, and the counts are summed over the host. A token is
covered if it lies in a run that enough distinct pages of the host hold. Pages with equal streams count
once.

A page with an article keeps the article: its passages may repeat on other pages, so they only go where
nearly all pages of the host hold them. A page without one keeps what is not covered: its unique runs.

Defined results: null or empty html gives an empty text; broken or unclosed markup is read as far as it
goes, in time that grows with the page: a quote that never closes holds no value, and if no > is left the rest
is text; equal rows get equal results; an empty table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenamart.llm.common import contiguous, read, stored
from arenamart.llm.near_dup import mix
from arenamart.llm.url_filter import host_of

CHUNK_BYTES = 2_000_000
#: Tokens of a substring that counts as repeated (a power of two: prefixes double).
RUN = 8
#: A body run goes if so many distinct pages of the host hold it.
BODY_LEAST = 3
#: An article passage goes only if this share of the host's distinct pages holds it, and ``ARTICLE_LEAST`` at least.
ARTICLE_SHARE, ARTICLE_LEAST = 0.9, 10

#: Inside a tag, what stands before its end: quotes hold a value only directly behind an equals sign.
INSIDE = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+"
#: A comment, a tag, another declaration, or the start of one of these that nothing ends. Possessive, as a
#: page must be read in one pass.
SCAN, PLAIN = (
    re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-z][a-z0-9:-]*+)({inside})>|<[!?/][^>]*+>|<(?=[!?/a-z])", re.S | re.I) for inside in (INSIDE, "[^>]*+")
)
#: Elements whose content is no markup: skipped to their end tag or to the end of the page.
RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "textarea", "title", "xmp")}
#: Elements skipped whole up to their end tag; without one only the start tag is skipped.
SKIPPED = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("noscript", "template", "svg", "iframe")}
#: One attribute: the name at the start or behind white space or a slash, the value consumed whole.
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*))?")
DROPPED_TAGS = frozenset("nav aside footer head button select dialog menu object".split())
BREAKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table "
    "tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open p or li ends where a new block of these starts.
ENDS_P = BREAKS - {"br", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice gdpr "
    "popup modal overlay newsletter subscribe sidebar widget nav navbar navigation menu breadcrumb breadcrumbs footer header "
    "masthead topbar toolbar related recommended share sharing social comment comments disqus respond reply replies login signup search "
    "pagination pager paywall".split()
)
#: Words that only say which part of something a class names. Others, as in has-sidebar, no-header,
#: comments-open or ad-free, make it the name of something else.
PARTS = frozenset(
    "area bar block bottom box button buttons col column container fixed form global group icon icons inner item items js left "
    "link links list main mobile outer panel primary right row secondary section site slot sticky top unit wrap wrapper".split()
)
COMMENTS = frozenset("comment comments disqus respond reply replies".split())
#: Words that name parts of reader comments, if one of ``COMMENTS`` stands beside them.
COMMENT_PARTS = frozenset("author body children content count entry feed meta reader readers text thread title user users".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
CASED = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")


def _names_hint(name: str) -> bool:
    """Whether a class name consists of hint words and names of parts, as share-bar does."""
    words = {w.lower() for w in CASED.split(name) if w}
    return not HINTS.isdisjoint(words) and words <= HINTS | PARTS or _names_comments(name)


def _names_comments(name: str) -> bool:
    words = {w.lower() for w in CASED.split(name) if w}
    return not COMMENTS.isdisjoint(words) and words <= HINTS | PARTS | COMMENT_PARTS


def _commented(attributes: str) -> bool:
    """Whether class or id mark an element as reader comments."""
    return any(
        name.lower() in ("class", "id") and any(map(_names_comments, value.strip("\"'").split())) for name, value in ATTRIBUTE.findall(attributes)
    )


def _hinted(attributes: str) -> bool:
    """Whether class, id, role or hidden mark an element as something beside the text."""
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value[1:-1] if value[:1] in ("'", '"') else value
        if name in ("class", "id") and any(map(_names_hint, value.split())):
            return True
        if name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
    return False


def blocks_of(page: str | None) -> list[tuple[str, bool]]:
    """(text, inside an article) of every block that is not dropped, in page order."""
    items: list[str | bool] = []  # pieces of text; where a block ends, whether an article is open
    #: Open elements: name, 1: dropped, 2: article, 3: a header in an article, 4: dropped if no article
    #: starts in it, or 0; for 4 the items and the articles before it.
    stack: list[tuple[str, int, int, int]] = []
    dropped = article = header = articles = 0
    opened: Counter[str] = Counter()  # names on the stack

    def flush() -> None:
        if items and not isinstance(items[-1], bool):
            items.append(article > 0)

    def pop() -> str:
        nonlocal dropped, article, header
        name, kind, start, before = stack.pop()
        opened[name] -= 1
        if kind == 4 and articles == before:
            items[start:] = [x for x in items[start:] if isinstance(x, bool)][:1]
        dropped, article, header = dropped - (kind == 1), article - (kind == 2), header - (kind == 3)
        return name

    def close(name: str) -> None:
        if opened[name]:
            while pop() != name:
                pass

    at, page, scan, main_seen = 0, page or "", SCAN, False
    endless: set[str] = set()  # skipped elements without an end tag in the rest of the page
    while m := scan.search(page, at):
        if m.start() > at and not dropped and (not header or any(opened[x] for x in HEADINGS)):
            items.append(page[at : m.start()])
        at = m.end()
        end, name = m.group(1), m.group(2)
        if at == m.start() + 1:
            at -= 1
            if scan is PLAIN:
                # No > is left, so that the rest is text, up to a comment.
                page = page[: page.find("<!--", at) % (len(page) + 1)]
                break
            scan = PLAIN  # a quoted value has taken the last >: from here on tags end at the first
        if name is None:
            continue
        name = name.lower()
        if name in RAW and not end:
            last = RAW[name].search(page, at)
            at = last.end() if last else len(page)
            continue
        if name in SKIPPED:
            if not end and name not in endless and not (name == "svg" and m.group(3).endswith("/")):
                last = SKIPPED[name].search(page, at)
                if last:
                    at = last.end()
                else:
                    endless.add(name)
            continue
        if name in BREAKS:
            flush()
        if end:
            close(name)
        elif name not in VOID:
            if name == "body":
                close("head")
            if name in ENDS_P and stack and stack[-1][0] == "p" or name == "li" and stack and stack[-1][0] == "li":
                close(stack[-1][0])
            attributes = m.group(3)
            kind, comments = 0, name not in ("html", "body", "main") and bool(attributes) and _commented(attributes)
            nested = opened["article"] > 0
            if name in DROPPED_TAGS or name == "header" and not article:
                kind = 1
            elif comments and (name != "article" or nested or main_seen):
                kind = 1
            elif name in ("article", "main") and not nested:
                kind = 2
                articles += not dropped
                main_seen |= name == "article" and not dropped
            elif name == "form" or name not in ("html", "body") and attributes and _hinted(attributes):
                kind = 4
            elif name == "header":
                kind = 3
            stack.append((name, kind, len(items), articles))
            opened[name] += 1
            dropped, article, header = dropped + (kind == 1), article + (kind == 2), header + (kind == 3)
    if not dropped:
        items.append(page[at:])
    inside = article > 0
    while stack:
        pop()
    found, parts = [], []
    for item in (*items, inside):
        if not isinstance(item, bool):
            parts.append(item)
        elif parts:
            if text := " ".join(html.unescape("".join(parts)).split()):
                found.append((text, item))
            parts = []
    return found


def suffixes(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array by prefix doubling, and how many tokens each suffix shares with the one before."""
    size, length = len(tokens), 1
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    ranks = [rank]  # by the first 1, 2, 4, ... tokens, until all differ
    while int(rank.max(initial=-1)) + 1 < size:
        ahead = np.zeros_like(rank)
        ahead[:-length] = rank[length:] + 1
        rank = np.unique(rank * (size + 1) + ahead, return_inverse=True)[1].astype(np.int64)
        ranks.append(rank)
        length *= 2
    order = np.empty(size, np.int64)
    order[rank] = np.arange(size)
    left, right, shared = order[:-1].copy(), order[1:].copy(), np.zeros(max(size - 1, 0), np.int64)
    for k in reversed(range(len(ranks))):
        level = np.append(ranks[k], -1)  # behind the end; two suffixes never end together
        step = (level[np.minimum(left, size)] == level[np.minimum(right, size)]).astype(np.int64) << k
        left, right, shared = left + step, right + step, shared + step
    return order, np.append(0, shared)[:size]


def run_ranks(tokens: np.ndarray) -> np.ndarray:
    """For each position the number, in suffix order, of the longest interval of the suffix array whose suffixes share ``RUN`` tokens."""
    order, shared = suffixes(tokens)
    rank = np.empty(len(tokens), np.int64)
    rank[order] = np.cumsum(shared < RUN) - 1
    return rank


def _spread(starts: np.ndarray, size: int) -> np.ndarray:
    """Mask of the tokens in runs that begin at ``starts``."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + RUN, -1)
    return np.cumsum(edge[:-1]) > 0


def run_hashes(streams: list[list[str]]) -> list[np.ndarray]:
    """Per stream a 64-bit hash of each of its runs, by position."""
    ids: dict[str, int] = {}
    coded = [np.fromiter((ids.setdefault(w, len(ids)) for w in s), np.int64, len(s)) for s in streams]
    words = np.array([w.encode("utf-8", "surrogatepass") for w in ids], dtype=object)
    hashes = pd.util.hash_array(words, categorize=False) if len(words) else np.zeros(0, np.uint64)
    out = []
    for code in coded:
        own = hashes[code]
        run = np.zeros(max(0, len(own) - RUN + 1), np.uint64)
        for k in range(RUN):
            run = mix(run * np.uint64(0x9E3779B97F4A7C15) + own[k : k + len(run)])
        out.append(run.view(np.int64))
    return out


def covered(streams: list[list[str]]) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """Per stream two masks: tokens in body boilerplate, tokens on nearly all pages; distinct pages."""
    unique: dict[tuple[str, ...], int] = {}
    which = [unique.setdefault(tuple(s), len(unique)) for s in streams]
    lists = list(unique)
    sizes = np.array([len(s) for s in lists], dtype=np.int64)
    ids: dict[str, int] = {}
    # Each stream ends with a token of its own, so that no run crosses pages.
    flat = np.fromiter((ids.setdefault(w, len(ids)) for s in lists for w in (*s, None)), np.int64, int(sizes.sum()) + len(lists))
    starts = np.cumsum(sizes + 1) - sizes - 1
    flat[starts + sizes] = len(ids) + np.arange(len(lists))
    owner = np.repeat(np.arange(len(lists)), sizes + 1)
    left = np.repeat(starts + sizes, sizes + 1) - np.arange(len(flat))  # tokens up to the end of the page
    masks = []
    if len(flat):
        rank = run_ranks(flat)
        whole = np.flatnonzero(left >= RUN)
        pairs = np.unique(rank[whole] * len(lists) + owner[whole])
        pages = np.bincount(pairs // len(lists), minlength=int(rank.max()) + 1)
        for least in (BODY_LEAST, max(ARTICLE_LEAST, ARTICLE_SHARE * len(lists))):
            masks.append(_spread(whole[pages[rank[whole]] >= least], len(flat)))
    cut = [[m[starts[k] : starts[k] + sizes[k]] for m in masks] for k in which]
    return [c[0] for c in cut], [c[1] for c in cut], len(lists)


def unique_runs(words: list[str], mask: np.ndarray) -> str:
    """A block without what is covered. Shorter pieces at its ends stay: they belong to runs that
    reach in from a neighbouring block, as a menu and the word after it."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
    gone = {i for a, b in edges.reshape(-1, 2) if b - a >= RUN or b - a == len(words) for i in range(a, b)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def extract_chunk(pages: list[str | None]) -> list[str]:
    """Main texts of the pages of one chunk of a host."""
    return main_texts([blocks_of(p) for p in pages])


def stream_of(blocks: list[tuple[str, bool]]) -> list[str]:
    return [w for text, _ in blocks for w in text.split(" ")]


def main_texts(blocks: list[list[tuple[str, bool]]], marks: tuple[np.ndarray, np.ndarray] | None = None) -> list[str]:
    """Main texts of a whole host, or of a chunk by ``marks``: hashes of the host's body and article runs that go."""
    streams = [stream_of(b) for b in blocks]
    if marks is None:
        body, everywhere, _ = covered(streams)
    elif not any(map(len, marks)):
        body = everywhere = [np.zeros(len(s), bool) for s in streams]
    else:
        hashes = run_hashes(streams)
        # Looked up once for the whole chunk, then cut by page.
        flat, cuts = np.concatenate(hashes), np.cumsum([len(r) for r in hashes])[:-1]
        body, everywhere = (
            [_spread(np.flatnonzero(x), len(s)) for x, s in zip(np.split(np.isin(flat, m), cuts), streams, strict=True)] for m in marks
        )
    out = []
    for own, in_body, in_all in zip(blocks, body, everywhere, strict=True):
        has_article, at, kept = any(inside for _, inside in own), 0, []
        for text, inside in own:
            words = text.split(" ")
            mask = (in_all if inside else in_body)[at : at + len(words)]
            at += len(words)
            if inside == has_article:
                if mask.any():
                    text = unique_runs(words, mask)
                if text:
                    kept.append(text)
        out.append("\n".join(kept))
    return out


PARSED = "page_id bigint, url string, host string, chunk bigint, chunks bigint, digest binary, plain boolean, blocks binary"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages to their blocks, compressed, as they are shuffled next. A block has no line feed."""
    for batch in batches:
        digests, plain, packed = [], [], []
        for page in batch.column("html").to_pylist():
            blocks = blocks_of(page)
            digests.append(hashlib.blake2b(" ".join(text for text, _ in blocks).encode("utf-8", "surrogatepass"), digest_size=16).digest())
            plain.append(not any(inside for _, inside in blocks))
            packed.append(zlib.compress("\n".join("BA"[inside] + text for text, inside in blocks).encode("utf-8", "surrogatepass")))
        kept = [c for c in batch.schema.names if c != "html"]
        arrays = [pa.array(digests, pa.binary()), pa.array(plain, pa.bool_()), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *arrays], [*kept, "digest", "plain", "blocks"])


def _unpack(packed: bytes) -> list[tuple[str, bool]]:
    text = zlib.decompress(packed).decode("utf-8", "surrogatepass")
    return [(line[1:], line[0] == "A") for line in text.split("\n")] if text else []


RUNS = "host string, chunk bigint, run bigint, n bigint, wanted boolean, near boolean"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of each chunk with the number of distinct pages that are counted here (rows sorted by chunk).

    Rows without blocks name a page that another chunk counts (digest) or a run that is asked for. If
    none is asked for, these are the runs on nearly all of the chunk's pages, and all runs if the host
    has pages without an article. ``wanted`` runs stand on such a page of this chunk. One row without a
    run gives the number of pages.
    """
    for chunk in contiguous(batches, ["host", "chunk"]):
        table = pa.Table.from_batches(chunk)
        away, asked, pages = set(), [], {}
        for digest, plain, blocks, run in zip(*(table[c].to_pylist() for c in ("digest", "plain", "blocks", "run")), strict=True):
            if blocks is not None:
                pages[digest] = (pages[digest][0] or plain, blocks) if digest in pages else (plain, blocks)
            elif run is None:
                away.add(digest)
            else:
                asked.append(run)
        every = any(x for x in table["every"].to_pylist())
        hashes = [np.unique(h) for h in run_hashes([stream_of(_unpack(b)) for _, b in pages.values()])]
        sizes = [len(h) for h in hashes]
        own = np.array([d not in away for d in pages], bool)
        bare = np.array([plain for plain, _ in pages.values()], bool)
        found, which = np.unique(np.concatenate(hashes) if hashes else np.zeros(0, np.int64), return_inverse=True)
        n = np.bincount(which[np.repeat(own, sizes)], minlength=len(found))
        wanted = np.bincount(which[np.repeat(bare, sizes)], minlength=len(found)) > 0
        near = (n > 0) & (n >= ARTICLE_SHARE * own.sum())
        kept = np.isin(found, asked) if asked else near | every
        columns = [found[kept], n[kept], wanted[kept], near[kept]]
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
        arrays = [pa.concat_arrays([pa.array(c, k), last]) for c, k, last in zip(
            columns, kinds, (pa.nulls(1, pa.int64()), pa.array([int(own.sum())], pa.int64()), *[pa.array([False])] * 2), strict=True
        )]
        size = len(arrays[0])
        keys = [pa.array([table[c][0].as_py()] * size, k) for c, k in (("host", pa.string()), ("chunk", pa.int64()))]
        yield pa.RecordBatch.from_arrays([*keys, *arrays], ["host", "chunk", "run", "n", "wanted", "near"])


def repeated_runs(parsed: DataFrame) -> DataFrame:
    """host, chunk, run, body for the runs in each chunk that go by the distinct pages of their whole host.

    Every distinct page is counted in one chunk, so that counts of chunks add up. A run that nearly all
    pages of a host hold is held by nearly all counted pages of one of its chunks at least, so that these
    are all candidates for article passages.
    """
    places = parsed.groupBy("host", "digest").agg(F.collect_set("chunk").alias("_in")).where(F.size("_in") > 1)
    # An array of at most as many numbers as the host has chunks.
    away = places.select("host", F.explode(F.array_remove("_in", F.array_min("_in"))).alias("chunk"), "digest")
    # Stored, so that joins by host know the size and shuffle no blocks where it is small.
    bare = stored(parsed.where("plain").select("host").distinct().withColumn("every", F.lit(True)), "html-bare")

    def counted(pages: DataFrame, *more: DataFrame) -> DataFrame:
        rows = pages.select("host", "chunk", "digest", "plain", "blocks", "every")
        for other in (away, *more):
            rows = rows.unionByName(other, allowMissingColumns=True)
        if "run" not in rows.columns:
            rows = rows.withColumn("run", F.lit(None).cast("bigint"))
        dealt = rows.repartition("host", "chunk").sortWithinPartitions("host", "chunk")
        return stored(dealt.mapInArrow(_runs, RUNS), "html-runs")

    found = counted(parsed.join(bare, "host", "left"))
    total = found.where("run is not null").groupBy("host", "run").agg(F.sum("n").alias("_n")).where(F.col("_n") >= BODY_LEAST)
    body = found.where("wanted").join(total, ["host", "run"]).select("host", "chunk", "run", F.lit(True).alias("body"))
    sizes = found.where("run is null").groupBy("host").agg(F.sum("n").alias("_pages"))
    likely = found.where("near").select("host", "run").distinct()
    likely = stored(likely.join(sizes.where(F.col("_pages") >= ARTICLE_LEAST).select("host"), "host"), "html-likely")
    if likely.isEmpty():
        return body
    chunks = parsed.select("host", "chunk").distinct()
    pages = parsed.join(stored(likely.select("host").distinct(), "html-asked"), "host", "left_semi").withColumn("every", F.lit(False))
    again = counted(pages, chunks.join(likely, "host")).where("run is not null")
    total = again.groupBy("host", "run").agg(F.sum("n").alias("_n")).join(sizes, "host")
    total = total.where(F.col("_n") >= F.greatest(F.lit(ARTICLE_LEAST), ARTICLE_SHARE * F.col("_pages"))).select("host", "run")
    return body.union(again.join(total, ["host", "run"]).select("host", "chunk", "run", F.lit(False).alias("body")))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by chunk; one chunk is held at a time. Rows without blocks are runs that go."""
    for chunk in contiguous(batches, ["host", "chunk"]):
        table = pa.Table.from_batches(chunk)
        pages = table.filter(table["blocks"].is_valid())
        runs = table.filter(table["run"].is_valid())
        if not len(pages):
            continue
        marks = None
        if pages["chunks"][0].as_py() > 1:
            run, body = runs["run"].to_numpy(), runs["body"].to_numpy().astype(bool)
            marks = run[body], run[~body]
        text = main_texts([_unpack(b) for b in pages["blocks"].to_pylist()], marks)
        columns = [pages["page_id"], pages["url"], pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())]
        yield from pa.table(columns, ["page_id", "url", "text", "n_chars"]).to_batches()


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    page = F.coalesce(pages["html"], F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"), F.octet_length(page).alias("_bytes")
    )
    # Stored, so that the join knows its size and shuffles no html where it is small.
    hosts = stored(rows.groupBy("host").agg((F.floor(F.sum("_bytes") / CHUNK_BYTES) + 1).alias("chunks")), "html-hosts")
    # Spread by content and id: a hot host fills many chunks, and each has all kinds of its pages.
    chunk = F.pmod(F.xxhash64("page_id", "html"), F.col("chunks"))
    chunked = rows.join(hosts, "host").select("page_id", "url", "html", "host", chunk.alias("chunk"), "chunks")
    parsed = stored(chunked.mapInArrow(_parse, PARSED), "html-blocks")
    marks = repeated_runs(parsed.where("chunks > 1"))
    rows = parsed.drop("digest", "plain").unionByName(marks, allowMissingColumns=True)
    dealt = rows.repartition("host", "chunk").sortWithinPartitions("host", "chunk")
    return dealt.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")


def op10_html(spark, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
