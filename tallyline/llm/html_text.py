"""Main text of web pages: markup where it speaks, a suffix array of the host's pages where it does not.

A page is read into blocks.  Markup settles most of them: blocks inside an article or main element are content, blocks
inside navigation, page headers and footers, asides, forms, scripts, adverts, notices or comments are furniture.  A
page with content blocks is done.  Marks (class, id, role) speak for the inside of an element only where they do not
speak of the article itself: on html, body, an article or main element and whatever contains one they decide nothing,
except that an article of comments, adverts or links to other pages is none if the page has another.

For a page without an article nothing but repetition tells its blocks apart.  The token streams of a host's unsettled
and furniture blocks are put one after another and sorted as a suffix array (by prefix doubling, to the depth of the
shortest run that counts).  Suffixes that agree so far and come from distinct pages are boilerplate; every token such a
run covers is marked, and blocks that are mostly covered go.  What is left are the page's unique runs.

A host with too many tokens for one array is dealt into several by page.  A run may then stand once in each of two
arrays, so the distinct runs of such a host are also counted over all its arrays, by hash, and each array is told which of
its runs stand on distinct pages: the result is that of one array.

Repetition alone is not enough where there is an article: its paragraphs may repeat on other pages and still belong to
it, and an advert may be the only one of its kind.  So a repeated run never removes content blocks.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from tallyline.llm.common import cut, packed, partitions, small_batches, text_of, unpacked

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TELLING = re.compile(r"class|id|role|itemprop|hidden|style", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_WORD = re.compile(r"\w+")
#: Fixed names of HTML: elements without an end tag, elements whose text is not markup, elements that end a block.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td"
    " tfoot th thead tr ul".split()
)
_CONTENT = frozenset("article main".split())
_FURNITURE = frozenset(
    "aside button dialog footer form head header iframe menu nav noscript object script select style svg template"
    " textarea title".split()
)
#: End tags that HTML lets out.  These elements end an open p, unless one of the second stands between ...
_ENDS_P = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul".split()
)
_AROUND_P = frozenset("button caption html object table td template th".split())
#: ... and these end others of their kind.
_LISTED = _BLOCK - frozenset("address div p".split())
_ENDS = {
    "li": (frozenset(["li"]), _LISTED - {"li"}),
    "dd": (frozenset(["dd", "dt"]), _LISTED - {"dd", "dt"}),
    "dt": (frozenset(["dd", "dt"]), _LISTED - {"dd", "dt"}),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
} | dict.fromkeys(["tbody", "thead", "tfoot"], (frozenset("caption colgroup tbody td tfoot th thead tr".split()), frozenset(["table"])))
#: Elements that leave a head open.
_IN_HEAD = frozenset("base head link meta noscript object script style template title".split())
#: Words in class, id or role that name furniture.
_FURNITURE_MARKS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments complementary consent"
    " contentinfo cookie cookies copyright disqus footer header login masthead menu modal nav navbar navigation"
    " newsletter notice notices pager pagination popup promo related replies search share sidebar signup social"
    " sponsor sponsored subscribe toolbar widget".split()
)
#: Those that may name an article element which is not the page's own.
_OTHERS_MARKS = frozenset(
    "ad ads advert adverts advertisement comment comments disqus promo related replies sidebar sponsor sponsored widget".split()
)
#: What may stand beside such a word in one name: ad-box, comment-body, related-posts; but not search-results.
_BESIDE = frozenset(
    "area bar block body bottom box button buttons container content entry form group icon icons inner item items label"
    " left link links list message meta outer panel post posts right row section slot text title top unit wrap wrapper".split()
)
#: Those that drop an element in the middle of a line.
_INLINE_MARKS = frozenset("ad ads advert adverts advertisement promo share social sponsor sponsored subscribe".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of other languages: only there a slash at the end of a tag closes it.
_FOREIGN = frozenset("math svg".split())
#: What makes an element furniture: nothing, a mark, a mark of another's article, its tag.
_NO, _MARK, _OTHERS, _TAGGED = range(4)


@dataclass(frozen=True)
class Settings:
    """``run_tokens`` (a power of two): shortest repeated run; ``covered``: share of a block's tokens that removes it;
    ``shard_tokens``: most tokens of one suffix array.  A host with more is dealt into several by page."""

    run_tokens: int = 8
    covered: float = 0.5
    shard_tokens: int = 1 << 20


def attributes(rest: str) -> tuple[dict[str, str], bool]:
    """The attributes of a tag, and whether it ends in a slash of its own (one that is no part of a value)."""
    found: dict[str, str] = {}
    end = 0
    for match in _ATTRIBUTE.finditer(rest):
        name, *values = match.groups()
        found.setdefault(name.lower(), next((v for v in values if v is not None), ""))
        end = match.end()
    return found, rest[end:].strip() == "/"


def _kind(name: str, rest: str, inside: bool) -> tuple[bool, int]:
    """(content, what makes it furniture) of an element; ``inside``: within content, where a header is not the page's."""
    if name in ("html", "body"):
        return False, _NO
    if name in _FURNITURE and not (inside and name == "header"):
        return False, _TAGGED
    content, mark = name in _CONTENT, _NO
    if rest and _TELLING.search(rest):
        given, _ = attributes(rest)
        if "hidden" in given or given.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(given.get("style", "")):
            return False, _TAGGED
        for key in ("class", "id", "role", "itemprop"):
            value = given.get(key, "").lower()
            content |= (key in ("role", "itemprop") or name in ("div", "section")) and value in ("main", "articlebody")
            if name in _HEADINGS:  # a heading's name is that of its section: <h2 id="related-work">
                continue
            for word in value.split():
                if name not in _BLOCK:
                    mark = _MARK if word in _INLINE_MARKS else mark
                elif word in _OTHERS_MARKS:
                    mark = _OTHERS
                elif mark == _NO and _marked(word, key, inside):
                    mark = _MARK
    return content, mark


def _marked(word: str, key: str, inside: bool) -> bool:
    """Whether a name is one of furniture: such a word, in classes also with words beside it that say nothing else."""
    marks = _FURNITURE_MARKS - {"header"} if inside else _FURNITURE_MARKS
    if word in marks:
        return True
    parts = re.split(r"[-_]+", word)
    return key == "class" and len(parts) > 1 and any(p in marks for p in parts) and all(p in marks or p in _BESIDE for p in parts)


def blocks_of(page: str) -> list[tuple[int, str]]:
    """(kind, text) of every block with text, in page order: 1 content, 0 unsettled, -1 furniture."""
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[list] = []  # name, content, what makes it furniture
    furniture = content = doubtful = dropped = 0
    at = 0

    def ended() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append((-1 if furniture else (2 if doubtful else 1) if content else -1 if doubtful else 0, text))

    def close(first: int) -> None:
        nonlocal furniture, content, doubtful, dropped
        for name, own, mark in stack[first:]:
            if name not in _BLOCK and name not in _FURNITURE:
                dropped -= mark > _NO
                continue
            content -= own
            furniture -= mark > _NO
            doubtful -= mark < _NO
        del stack[first:]

    def implied(ends: frozenset[str], around: frozenset[str]) -> None:
        first = None
        for n in range(len(stack) - 1, -1, -1):
            if stack[n][0] in ends:
                first = n
            elif stack[n][0] in around:
                break
        if first is not None:
            close(first)

    while True:
        tag = _TAG.search(page, at)
        stop = tag.start() if tag else len(page)
        if stop > at:
            text = page[at:stop]
            if stack and stack[-1][0] == "head" and not text.isspace():
                ended()
                close(len(stack) - 1)
            if not dropped:
                parts.append(html.unescape(text))
        if not tag:
            break
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in _BLOCK or name in _RAW or name in _FURNITURE:
            ended()
        if tag["end"]:
            for n in range(len(stack) - 1, -1, -1):
                if stack[n][0] == name:
                    close(n)
                    break
            continue
        if stack and stack[-1][0] == "head" and name not in _IN_HEAD:
            ended()
            close(len(stack) - 1)
        if name in _ENDS_P:
            implied(frozenset(["p"]), _AROUND_P)
        if name in _ENDS:
            implied(*_ENDS[name])
        if name in _VOID:
            continue
        if tag["rest"].endswith("/") and (name in _FOREIGN or any(e[0] in _FOREIGN for e in stack)) and attributes(tag["rest"])[1]:
            continue
        if name in _RAW:  # no markup inside: go on behind its end tag
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        own, mark = _kind(name, tag["rest"], content > 0)
        if name not in _BLOCK and name not in _FURNITURE:  # in the middle of a line
            stack.append([name, False, mark])
            dropped += mark > _NO
            continue
        stack.append([name, own, mark])
        content += own
        furniture += mark > _NO
        # an article inside an article is a comment or the like; of any other, marks on it and around it say nothing
        if own and furniture and not (name == "article" and any(e[0] == "article" for e in stack[:-1])):
            for element in stack:
                if element[2] in (_MARK, _OTHERS):
                    furniture -= 1
                    doubtful += element[2] == _OTHERS
                    element[2] = -_OTHERS if element[2] == _OTHERS else _NO
    ended()
    sure = any(kind == 1 for kind, _ in out)
    return [(kind if kind < 2 else -1 if sure else 1, text) for kind, text in out]


def _read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's text if it has content blocks; else its unsettled blocks.  Tokens of all other blocks for the host."""
    known: dict[str, int] = {}
    for part in parts:
        texts, unsettled, tokens, owners = [], [], [], []
        for page in part.column("html").to_pylist():
            blocks = blocks_of(page)
            content = [t for kind, t in blocks if kind == 1]
            open_ = [t for kind, t in blocks if kind == 0]
            texts.append("\n".join(content) if content or not open_ else None)
            unsettled.append([] if content else open_)
            own, of = [], []
            number = 0
            for kind, text in blocks:
                if kind == 1:
                    continue
                words = [_token(w, known) for w in _WORD.findall(text.lower())]
                own += words
                of += [number if kind == 0 and not content else -1] * len(words)
                number += kind == 0
            tokens.append(np.array(own, np.int64).tobytes())
            owners.append(np.array(of, np.int32).tobytes())
        yield pa.record_batch(
            [part.column("row"), part.column("page"), pa.array(texts, pa.string()), pa.array(unsettled, pa.list_(pa.string())),
             pa.array(tokens, pa.binary()), pa.array(owners, pa.binary())],
            names=["row", "page", "text", "unsettled", "tokens", "owners"],
        )


def _token(word: str, known: dict[str, int]) -> int:
    value = known.get(word)
    if value is None:
        if len(known) >= 1 << 20:
            known.clear()
        value = known[word] = xxhash.xxh64_intdigest(word) >> 1
    return value


def suffix_order(stream: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, rank of each suffix), compared to ``depth`` tokens: equal ranks agree that far."""
    rank = np.unique(stream, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step < depth:
        behind = np.zeros(len(rank), np.int64)
        behind[: max(0, len(rank) - step)] = rank[step:] + 1
        rank = np.unique(rank * (len(rank) + 2) + behind, return_inverse=True)[1].astype(np.int64)
        step *= 2
    return np.argsort(rank, kind="stable"), rank


def runs_of(stream: np.ndarray, depth: int) -> np.ndarray:
    """A hash of every run of ``depth`` tokens, by its first token."""
    size = max(0, len(stream) - depth + 1)
    value = np.zeros(size, np.uint64)
    tokens = stream.astype(np.int64).view(np.uint64)
    for k in range(depth):
        value = (value ^ tokens[k : k + size]) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return value.view(np.int64)


def _counted(parts: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Distinct runs of each array's pages in a batch, with the smallest and largest hash of a page they stand on."""
    for part in parts:
        held: dict[tuple[str, int], list[tuple[np.ndarray, int]]] = {}
        for host, shard, tokens in zip(*(c.to_pylist() for c in part.columns), strict=True):
            page = xxhash.xxh64_intdigest(tokens) >> 1
            held.setdefault((host, shard), []).append((runs_of(np.frombuffer(tokens, np.int64), depth), page))
        for (host, shard), pages in held.items():
            runs = np.concatenate([r for r, _ in pages])
            if not len(runs):
                continue
            of = np.repeat(np.array([p for _, p in pages], np.int64), [len(r) for r, _ in pages])
            order = np.argsort(runs, kind="stable")
            runs, of = runs[order], of[order]
            first = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]])
            columns = [pa.array([host] * len(first), pa.string()), pa.array(np.full(len(first), shard, np.int32)), pa.array(runs[first])]
            columns += [pa.array(np.minimum.reduceat(of, first)), pa.array(np.maximum.reduceat(of, first))]
            yield pa.record_batch(columns, names=["host", "shard", "run", "low", "high"])


def repeated(pages: list[np.ndarray], depth: int, elsewhere: np.ndarray | None = None) -> list[np.ndarray]:
    """For each page's tokens, which of them a run of ``depth`` tokens covers that stands on a distinct page too.

    Pages with equal streams are copies of one page, not distinct pages.  ``elsewhere``: hashes of runs that are known
    to stand on distinct pages, of which some are not among these.
    """
    distinct: dict[bytes, int] = {}
    same = np.array([distinct.setdefault(p.tobytes(), len(distinct)) for p in pages])
    sizes = np.array([len(p) for p in pages])
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    # every page ends in a token of its own, so no run crosses two pages
    stream = np.concatenate([np.append(p, -1 - n) for n, p in enumerate(pages)])
    page = np.repeat(same, sizes + 1)
    order, rank = suffix_order(stream, depth)
    first = np.flatnonzero(np.r_[True, rank[order][1:] != rank[order][:-1]])
    low = np.minimum.reduceat(page[order], first)
    high = np.maximum.reduceat(page[order], first)
    shared = (low != high)[rank]
    if elsewhere is not None and len(elsewhere):  # a run over the end of a page holds that page's own token
        known = np.isin(runs_of(stream, depth), elsewhere)
        shared[: len(known)] |= known
    edges = np.zeros(len(stream) + depth + 1, np.int64)
    edges[:-depth][: len(stream)][shared] += 1
    edges[depth:][: len(stream)][shared] -= 1
    covered = np.cumsum(edges)[: len(stream)] > 0
    return [covered[a : a + n] for a, n in zip(starts, sizes, strict=True)]


def _judged(parts: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (host, shard): the numbers of the blocks that each unsettled page loses.

    Rows without tokens come first and name a run that stands on distinct pages of the host.
    """
    held: tuple | None = None
    pages: list[tuple[int, np.ndarray, np.ndarray]] = []
    elsewhere: list[int] = []

    def judged() -> Iterator[pa.RecordBatch]:
        marks = repeated([t for _, t, _ in pages], settings.run_tokens, np.array(elsewhere, np.int64))
        names, lost = [], []
        for (page, _, owners), covered in zip(pages, marks, strict=True):
            if (owners >= 0).any():
                total = np.bincount(owners[owners >= 0])
                hit = np.bincount(owners[(owners >= 0) & covered], minlength=len(total))
                names.append(page)
                lost.append(np.flatnonzero((total > 0) & (hit >= settings.covered * total)).tolist())
        yield pa.record_batch([pa.array(names, pa.int64()), pa.array(lost, pa.list_(pa.int32()))], names=["judged", "lost"])

    for part in parts:
        for host, shard, page, tokens, owners, run in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if held != (host, shard):
                if held:
                    yield from judged()
                held, pages, elsewhere = (host, shard), [], []
            if tokens is None:
                elsewhere.append(run)
                continue
            pages.append((page, np.frombuffer(tokens, np.int64), np.frombuffer(owners, np.int32)))
    if held:
        yield from judged()


def main_text(pages: DataFrame, settings: Settings = Settings(), url: str = "url", page: str = "html", into: str = "text") -> DataFrame:
    """The rows of ``pages`` with their main text in column ``into``.

    Blocks are joined by one newline; inside a block character references are decoded and white space becomes one
    space.  Null and empty pages have the empty text, and so have pages of furniture alone.  Pages with a null url
    form one host.  Repeated rows get equal texts: copies of a page are one page when runs are counted.
    """
    small_batches(pages.sparkSession)
    rows = packed(pages, html=text_of(pages, page), host=F.coalesce(F.lower(F.regexp_extract(F.col(url), "^[a-zA-Z]+://([^/?#]*)", 1)), F.lit("")))
    rows = rows.withColumn("row", F.struct("row", "host")).withColumn("page", F.monotonically_increasing_id())
    shape = StructType([rows.schema["row"]]).add("page", "long").add("text", "string")
    shape = shape.add("unsettled", ArrayType(StringType())).add("tokens", "binary").add("owners", "binary")
    read = rows.select("row", "page", "html").mapInArrow(_read, shape)
    settled = read.where(F.size("unsettled") == 0).select(F.col("row.row").alias("row"), "text")
    streams = cut(read.select(F.col("row.host").alias("host"), "page", "tokens", "owners", F.size("unsettled").alias("open")))
    needed = streams.groupBy("host").agg(F.sum(F.octet_length("tokens") / 8).alias("held"), F.sum("open").alias("open"))
    needed = needed.where("open > 0").select("host", F.ceil((F.col("held") + 1) / settings.shard_tokens).alias("shards"))
    dealt = streams.join(needed, "host").withColumn("shard", F.pmod(F.xxhash64("tokens"), F.col("shards")).cast("int"))
    # runs of a host with several arrays, counted over all of them: those on distinct pages of different arrays
    spread = dealt.where("shards > 1").select("host", "shard", "tokens")
    spread = spread.mapInArrow(partial(_counted, depth=settings.run_tokens), "host string, shard int, run long, low long, high long")
    spread = spread.groupBy("host", "run").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.collect_set("shard").alias("in"))
    spread = spread.where((F.col("low") < F.col("high")) & (F.size("in") > 1)).select("host", F.explode("in").alias("shard"), "run")
    told = spread.selectExpr("host", "shard", "-1L AS page", "CAST(NULL AS binary) AS tokens", "CAST(NULL AS binary) AS owners", "run")
    dealt = dealt.selectExpr("host", "shard", "page", "tokens", "owners", "CAST(NULL AS long) AS run").unionByName(told)
    ordered = dealt.repartition(partitions(pages.sparkSession), "host", "shard")
    lost = ordered.sortWithinPartitions("host", "shard", "page").mapInArrow(partial(_judged, settings=settings), "judged long, lost array<int>")
    unsettled = read.where(F.size("unsettled") > 0).join(lost, F.col("page") == F.col("judged"), "left")
    kept = F.filter("unsettled", lambda t, i: ~F.array_contains(F.coalesce("lost", F.array().cast("array<int>")), i))
    runs = unsettled.select(F.col("row.row").alias("row"), F.array_join(kept, "\n").alias("text"))
    return unpacked(settled.unionByName(runs), pages.columns, **{into: F.col("text")})
