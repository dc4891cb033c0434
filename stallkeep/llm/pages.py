"""Main text of web pages: marked articles, and a suffix array per host for the rest.

A page is cut into blocks. Blocks in containers that are never content (menus,
footers, adverts, forms, comments and their like, by element name or by words
of class, id and role) go; blocks of a marked article or main part stay whole,
also where other pages repeat them. For everything outside a marked article
the pages of a host are laid end to end as one stream of tokens, and a suffix
array finds the runs of at least ``RUN`` tokens that different pages share.
They are the host's boilerplate: on pages that mark no article, blocks mostly
covered by such runs go, and of the others the unique runs stay. Large hosts
are sorted in chunks; runs that pages of different chunks share are found by
their hashes over the whole host.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.llm.common import batch_of, weighed, written
from stallkeep.llm.words import shingles
from stallkeep.operators.joins import spread_join

RUN = 8  # tokens of a shared run, a power of two
CHUNK_PAGES = 2_000

# HTML elements by their role, and words of class, id or role.
_RAW = "script|style|textarea|title|noscript|template|iframe|xmp"
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td"
    " tfoot th thead tr ul".split()
)
_NESTING = _BLOCKS - frozenset("p hr h1 h2 h3 h4 h5 h6 li dd dt option optgroup tr td th thead tbody tfoot body html".split()) | {"svg", "button", "object"}
_NEVER = frozenset("nav footer aside form head menu select button svg object dialog fieldset".split())
_ARTICLE = frozenset("article main".split())
_NEVER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer"
    " footer login menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted promotion related"
    " recommended search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets"
    " contentinfo complementary".split()
)
_HEADER_WORDS = frozenset("header masthead topbar".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|<[a-zA-Z][^<>]*+(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
_PARTS = re.compile(r"[^a-z0-9]+")


@dataclass(frozen=True)
class Block:
    text: str
    in_article: bool
    never: bool


def _named(rest: str) -> set[str]:
    found = (a or b or c for a, b, c in _NAMES.findall(rest))
    names = (re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower() for value in found for name in value.split())
    # has-sidebar or no-footer names the page's layout, not the element.
    return {part for name in names if not name.startswith(("with-", "has-", "no-")) for part in _PARTS.split(name)}


def blocks(page: str | None) -> list[Block]:
    """Blocks of a page in order, white space inside turned into single spaces; null gives none.

    Unclosed and stray tags are taken as browsers do in the simple cases: a
    closing tag ends everything opened since its opening one, without one it is
    ignored; an unfinished tag at the end is dropped.
    """
    page = page or ""
    out: list[Block] = []
    opened: list[tuple[str, bool, bool]] = []  # name, in an article, never content
    inside = never = False
    held: list[str] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(Block(text, inside, never))

    at = 0
    for found in _MARKUP.finditer(page):
        if found.start() > at:
            held.append(html.unescape(page[at : found.start()]))
        at = found.end()
        name = found["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            held.append(" ")
        if name not in _BLOCKS and name not in _NESTING:
            continue
        flush()
        if name not in _NESTING:
            continue
        if found["close"]:
            depth = next((k for k in range(len(opened) - 1, -1, -1) if opened[k][0] == name), None)
            if depth is not None:
                del opened[depth:]
        else:
            rest = found["rest"]
            words = _named(rest) if rest else set()
            refused = name in _NEVER or bool(words & _NEVER_WORDS) or bool(rest and _HIDDEN.search(rest))
            if not inside:
                refused |= name == "header" or bool(words & _HEADER_WORDS)
            opened.append((name, inside or name in _ARTICLE or "main" in words and "role" in rest, never or refused))
        _, inside, never = opened[-1] if opened else ("", False, False)
    held.append(html.unescape(page[at:]))
    flush()
    return out


@lru_cache(maxsize=1 << 16)
def _token_key(token: str) -> tuple[int, int]:
    raw = blake2b(token.encode(), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:], "little")


def run_keys(tokens: list[str], run: int = RUN) -> np.ndarray:
    """The 128-bit hashes, as two columns of 64 bits, of all runs of ``run`` tokens."""
    if len(tokens) < run:
        return np.zeros((0, 2), np.int64)
    keys = np.array([_token_key(t) for t in tokens], np.uint64)
    return np.stack([shingles(keys[:, k], run) for k in range(2)], axis=1).view(np.int64)


def shared_runs(pages: list[list[str]], run: int = RUN, known: set[tuple[int, int]] = frozenset()) -> list[np.ndarray]:
    """Per page, which tokens lie in a run of at least ``run`` that another page has too.

    The suffixes of all pages are sorted by doubling, as far as ``run`` tokens;
    neighbours in that order that agree so far share a run. Pages that are equal
    count as one. Runs whose ``run_keys`` are ``known`` are shared with pages
    beyond these.
    """
    sizes = [len(p) for p in pages]
    edges = np.cumsum([0, *sizes])
    if not edges[-1]:
        return [np.zeros(0, bool) for _ in pages]
    _, tokens = np.unique(np.array([t for p in pages for t in p], dtype=object), return_inverse=True)
    same: dict[tuple[str, ...], int] = {}
    owner = np.repeat([same.setdefault(tuple(p), k) for k, p in enumerate(pages)], sizes)
    rank, step = tokens.astype(np.int64), 1
    ends = np.repeat(edges[1:], sizes)
    while step < run:
        ahead = np.arange(len(rank)) + step
        beyond = ahead >= ends
        follow = np.where(beyond, -1, rank[np.minimum(ahead, len(rank) - 1)])
        _, rank = np.unique(rank * (len(rank) + 2) + follow + 1, return_inverse=True)
        step *= 2
    whole = np.arange(len(rank)) + run <= ends
    order = np.lexsort((owner, rank))
    order = order[whole[order]]
    ranked, owners = rank[order], owner[order]
    group = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(order) else np.zeros(0, np.int64)
    last = np.append(group[1:], len(order)) - 1
    several = owners[group] != owners[last] if len(order) else np.zeros(0, bool)
    hits = order[np.repeat(several, np.diff(np.append(group, len(order))))]
    delta = np.zeros(len(rank) + 1, np.int64)
    np.add.at(delta, hits, 1)
    np.add.at(delta, hits + run, -1)
    if known:
        for page, edge in zip(pages, edges, strict=False):
            also = edge + np.array([k for k, key in enumerate(run_keys(page, run).tolist()) if tuple(key) in known], np.int64)
            np.add.at(delta, also, 1)
            np.add.at(delta, also + run, -1)
    return np.split(np.cumsum(delta[:-1]) > 0, edges[1:-1])


def _unique_runs(found: list[Block], covered: np.ndarray, run: int = RUN) -> str:
    """What stays of a page without a marked article.

    A shared run that only reaches into a block with less than ``run`` tokens
    belongs to its neighbour and takes nothing from it.
    """
    kept, at = [], 0
    for block in found:
        words = block.text.split(" ")
        shared = covered[at : at + len(words)]
        at += len(words)
        if block.never or 2 * shared.sum() > len(words):
            continue
        turns = np.flatnonzero(np.diff(shared, prepend=False, append=False)).reshape(-1, 2)
        for a, b in turns[np.diff(turns, axis=1)[:, 0] < run]:
            shared[a:b] = False
        kept += [w for w, s in zip(words, shared, strict=True) if not s]
    return " ".join(kept)


def _tokens(found: list[Block]) -> list[str]:
    return [w for b in found for w in b.text.split(" ")]


def _across(pages: DataFrame) -> DataFrame:
    """host, chunk, key0 and key1 of the runs that one page of a chunk has, and pages of other chunks.

    Columns host, chunk and html are read. Pages that are equal count as one. Runs
    are counted by their hashes, combined before they are moved; the texts stay
    where they are and are parsed once more.
    """
    fields = pa.schema([("host", pa.string()), *((n, pa.int64()) for n in ("chunk", "key0", "key1", "page"))])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in weighed(batches, 2, 1_000_000):
            for host, chunk, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = _tokens([b for b in blocks(page) if not b.in_article])
                keys = np.unique(run_keys(tokens), axis=0)
                if len(keys):
                    own = int.from_bytes(blake2b(" ".join(tokens).encode(), digest_size=8).digest(), "little", signed=True)
                    n = len(keys)
                    yield batch_of(fields, ([host] * n, np.full(n, chunk), keys[:, 0], keys[:, 1], np.full(n, own)))

    found = pages.select("host", "chunk", "html").mapInArrow(runs, "host string, chunk long, key0 long, key1 long, page long")
    found = found.groupBy("host", "chunk", "key0", "key1").agg(F.min("page").alias("low"), F.max("page").alias("high"))
    alone = F.when(F.col("low") == F.col("high"), F.col("chunk"))
    whole = found.groupBy("host", "key0", "key1").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.collect_list(alone).alias("chunks"))
    return whole.filter("low != high").select("host", F.explode("chunks").alias("chunk"), "key0", "key1")


def main_text(pages: DataFrame, chunk_pages: int = CHUNK_PAGES) -> DataFrame:
    """page_id, url, text, n_chars (code points) and shared_tokens of every page.

    Columns page_id, url and html are read. A null or empty html gives an empty
    text; rows of a repeated page_id are pages each. Pages without a host in
    their url form one host. The pages of a host above ``chunk_pages`` are dealt
    to chunks by a hash of page_id and url, each with its own array, so a host of
    any size is many groups; what a page shares with pages of other chunks alone
    is told to its chunk (``_across``), so the result does not depend on chunks.
    ``shared_tokens`` counts the page's tokens outside its article that lie in
    shared runs.
    """
    host = F.lower(F.regexp_extract(F.col("url"), r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/@]*@)?(?:www\.)?([^/:?#]*)", 1))
    read = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    read = read.withColumn("host", F.coalesce(host, F.lit("")))
    large = read.groupBy("host").count().select("host", F.ceil(F.col("count") / chunk_pages).alias("chunks")).filter("chunks > 1")
    large = written(large, "large-hosts")  # so that the join below knows its size
    fields = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("article", pa.string()), ("outside", pa.list_(pa.string())), ("never", pa.list_(pa.bool_()))])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in weighed(batches, 2, 4_000_000):
            rows = []
            for page_id, url, page, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = blocks(page)
                marked = any(b.in_article and not b.never for b in found)
                article = " ".join(b.text for b in found if b.in_article and not b.never) if marked else None
                outside = [b for b in found if not b.in_article]
                rows.append((page_id, url, name, article, [b.text for b in outside], [b.never for b in outside]))
            yield batch_of(fields, zip(*rows, strict=True))

    parsed = read.select("page_id", "url", "html", "host").mapInArrow(parse, "page_id long, url string, host string, article string, outside array<string>, never array<boolean>")
    chunk = F.pmod(F.xxhash64("page_id", "url"), F.col("chunks"))
    dealt = spread_join(parsed, large, ["host"], "left").withColumn("chunk", F.coalesce(chunk, F.lit(0)))
    told = _across(spread_join(read, large, ["host"], "inner").select("host", chunk.alias("chunk"), "html"))

    def decide(some: pa.Table, told: pa.Table) -> pa.Table:
        article, outside, never = (some.column(c).to_pylist() for c in ("article", "outside", "never"))
        found = [[Block(t, False, n) for t, n in zip(texts, flags, strict=True)] for texts, flags in zip(outside, never, strict=True)]
        known = set(zip(told.column("key0").to_pylist(), told.column("key1").to_pylist(), strict=True))
        covered = shared_runs([_tokens(page) for page in found], known=known)
        texts = [a if a is not None else _unique_runs(f, c) for a, f, c in zip(article, found, covered, strict=True)]
        new = {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64()), "shared_tokens": pa.array([int(c.sum()) for c in covered], pa.int64())}
        return pa.table({"page_id": some.column("page_id"), "url": some.column("url")} | new)

    return dealt.groupBy("host", "chunk").cogroup(told.groupBy("host", "chunk")).applyInArrow(decide, "page_id long, url string, text string, n_chars long, shared_tokens long")
