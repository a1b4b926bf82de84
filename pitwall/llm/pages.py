"""Main text of web pages: blocks that the markup allows, without what the pages of a host repeat.

A page is cut into blocks. Elements that are never main text (menus, headers, footers, forms,
scripts and so on, by tag, role, whole class or id) are left out with all they hold; one that is
not closed ends with the element around it, or where an article or main part begins. If the page marks its
article (also itemprop="articleBody", or else its main part, also role="main"), only the blocks inside are left.

The blocks of a host's pages are token streams, and substrings that many pages repeat are
boilerplate; marked pages are compared with marked ones, all others with each other. Pages with
the same content are no distinct pages, and pages more than half
of whose tokens stand in long blocks that distinct pages share are the same body if the longest of
these is the same: such an article may have other menus or adverts around it. Suffixes of the
streams, cut to a few tokens, are brought together by host and content; suffixes that fall
together share at least so many tokens. This is the host's suffix array to that depth, dealt over
all tasks, so that no task holds a host. A shorter block is one substring. What stands in several
bodies, and in at least half of the host's, is repeated. Runs of repeated tokens are removed if
they are at least half of their block or long; shorter ones are phrases of the text and stay.

Of a marked page, whose markup vouches for its text, only what at least three bodies repeat goes,
no short block (a heading, say), and nothing if that were over a quarter of the text: such a page is a
near copy. So the same article may stand on several pages.

Few suffixes are repeated that much, so most need not travel: those of a host fall into buckets
by hash, each task counts the pages in a bucket, and only suffixes of buckets with enough pages
go on. A bucket has at least the pages of each of its suffixes, so none is lost.

References are decoded, white space in a block (line breaks too) becomes one space, blocks
without text vanish, and the others are joined by an empty line. A null or empty html gives an
empty text; a url without a host, also a null one, counts to the host "". Rows with one page_id,
also null, are pages of their own. Other columns are ignored; an empty table gives no rows.
"""

import hashlib
import html
import re
from bisect import bisect
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.tables import by_batch, release_memory, stored
from pitwall.llm.words import NOT_SPACE, mixed, span_sums, split_words

SUBSTRING_TOKENS = 8
#: Repeated runs of so many tokens are boilerplate also where they are less than half of a block.
LONG_RUN = 32
#: What marked pages repeat must stand in so many of a host's bodies at least.
MARKED_BODIES = 3
#: Buckets of a host's suffixes, and hosts whose buckets a task holds.
BUCKETS, HELD_HOSTS = 4096, 512
_SUFFIX_BASE = 0xD1342543DE82EF95
_HOST = r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?|[\"'][^\s]*")
_RAW = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in ("script", "style", "textarea", "title", "xmp", "iframe")}
#: Where an element of raw text ends that is never closed.
_RAW_LOST = re.compile(r"<(?:/head|body|article|main)(?=[\s/>])", re.I)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose end tag may be left out, and by start tag: the elements it ends, and those it does not look beyond.
_OPTIONAL = frozenset("body caption colgroup dd dt head html li optgroup option p rp rt tbody td tfoot th thead tr".split())
_CELLS, _SECTIONS = frozenset("caption td th".split()), frozenset("tbody tfoot thead".split())
_TABLE = frozenset({"table"})
_ENDS = {
    "li": (frozenset({"li"}), _BLOCKS - frozenset("address div li p".split())),
    **dict.fromkeys(("dd", "dt"), (frozenset({"dd", "dt"}), _BLOCKS - frozenset("address dd div dt p".split()))),
    **dict.fromkeys(_CELLS, (_CELLS, _TABLE | {"tr"})),
    "tr": (_CELLS | {"tr"}, _TABLE | _SECTIONS),
    **dict.fromkeys(_SECTIONS, (_CELLS | _SECTIONS | {"tr"}, _TABLE)),
}
_NESTING = _BLOCKS | frozenset("button dialog form iframe noscript object select svg template".split())
_P, _NOT_BEYOND_P = frozenset({"p"}), _TABLE | _CELLS | {"button", "object", "template"}
#: Elements that an end tag does not look beyond; else those of blocks stay in their cell, all others in their block.
_BEYOND = {
    **dict.fromkeys(_CELLS | _SECTIONS | {"tr"}, _TABLE),
    **dict.fromkeys(("article", "body", "html", "main", "section", "table"), frozenset()),
}
_NEVER_TAGS = frozenset(
    "aside button dialog footer form header iframe menu nav noscript object script select style svg template "
    "textarea title xmp".split()
)
_NEVER_ROLES = frozenset("alert banner complementary contentinfo dialog menu menubar navigation search".split())
#: Whole classes and ids; parts of longer names, such as "market-share", say nothing.
_NEVER_NAMES = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice pager pagination "
    "popup promo promotion related share sharing sidebar social sponsor sponsored subscribe widget "
    "ad-banner ad-container ad-slot ad-unit ad-wrapper banner-ad comment-list comments-area cookie-banner cookie-bar "
    "cookie-consent cookie-notice main-menu main-nav main-navigation nav-bar nav-menu page-footer page-header "
    "post-navigation related-articles related-links related-posts share-buttons share-links site-footer site-header "
    "site-nav site-navigation social-links social-media social-share sponsored-content top-nav".split()
)
#: Ids of other elements than these are often made from headings.
_NAMED_BY_ID = frozenset("div ol table ul".split())


def _attributes(text: str) -> dict[str, str]:
    """The first value of each attribute."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        if name:
            quoted = value[:1] in ("'", '"')
            found.setdefault(name.lower(), html.unescape(value[1:-1] if quoted else value))
    return found


def _mark(tag: str, attributes: dict[str, str]) -> str:
    """Whether an element is the page's article or main part."""
    if tag == "article" or "articlebody" in attributes.get("itemprop", "").lower().split():
        return "article"
    return "main" if tag == "main" or "main" in attributes.get("role", "").lower().split() else ""


def _never(tag: str, attributes: dict[str, str]) -> bool:
    if tag in _NEVER_TAGS:
        return True
    if not attributes:
        return False
    if "hidden" in attributes or not _NEVER_ROLES.isdisjoint(attributes.get("role", "").lower().split()):
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if tag in ("html", "body") or _mark(tag, attributes):
        return False
    classes = attributes.get("class", "").lower().split()
    by_id = tag in _NAMED_BY_ID and "section" not in classes
    return not _NEVER_NAMES.isdisjoint([*classes, attributes.get("id", "").strip().lower()] if by_id else classes)


@dataclass
class _Tag:
    """A tag: its place in the page, what it is, and for never-elements and marks the number of the tag that ends it."""

    start: int
    stop: int
    name: str
    closing: bool
    never: bool = False
    mark: str = ""
    end: int = 0
    closed: bool = False


def _tags(page: str) -> list[_Tag]:
    """The tags of a page, with their elements' ends as HTML has them."""
    tags: list[_Tag] = []
    stack: list[tuple[str, int]] = []
    n_open: Counter[str] = Counter()
    unclosed: dict[str, list[tuple[int, int]]] = defaultdict(list)

    def pop_to(depth: int, now: int, explicit: bool) -> None:
        while len(stack) > depth:
            name, number = stack.pop()
            n_open[name] -= 1
            tags[number].end = now
            tags[number].closed = name in _OPTIONAL or (explicit and len(stack) == depth)
            if not tags[number].closed:
                spans = unclosed[name]
                while spans and spans[-1][0] > number:
                    spans.pop()
                spans.append((number, now))

    def pop(names: frozenset[str], beyond: frozenset[str], now: int, explicit: bool = False) -> None:
        """Ends the innermost element of such a name, or with several names the outermost, but looks beyond no others."""
        found = -1
        for depth in range(len(stack) - 1, -1, -1):
            name = stack[depth][0]
            if name in names:
                found = depth
                if len(names) == 1:
                    break
            elif name in beyond:
                break
        if found >= 0:
            pop_to(found, now, explicit)

    at = 0
    while (markup := _MARKUP.search(page, at)) is not None:
        at = markup.end()
        now = len(tags)
        if markup[2] is None:
            tags.append(_Tag(markup.start(), at, "", False))
            continue
        name, closing = markup[2].lower(), bool(markup[1])
        if closing:
            if n_open[name]:
                pop(frozenset({name}), _BEYOND.get(name, _TABLE | _CELLS if name in _NESTING else _NESTING), now, True)
            tags.append(_Tag(markup.start(), at, name, True))
            continue
        if name in _RAW:
            end = _RAW[name].search(page, at) or _RAW_LOST.search(page, at)
            at = end.start() if end else len(page)
            tags.append(_Tag(markup.start(), at, "", False))
            continue
        if name in _BLOCKS and n_open["p"]:
            pop(_P, _NOT_BEYOND_P, now)
        if name in _ENDS:
            names, beyond = _ENDS[name]
            if any(n_open[n] for n in names):
                pop(names, beyond, now)
        attributes = _attributes(markup[3]) if markup[3] else {}
        tag = _Tag(markup.start(), at, name, False)
        tags.append(tag)
        if name in _VOID or (markup[3].endswith("/") and (name in ("svg", "math") or n_open["svg"] or n_open["math"])):
            continue
        tag.mark = _mark(name, attributes)
        tag.never = _never(name, attributes)
        stack.append((name, now))
        n_open[name] += 1
    pop_to(0, len(tags), False)
    for number, tag in enumerate(tags):
        # Of nested elements of one name any may be the one whose end tag is missing.
        if tag.never and (spans := unclosed.get(tag.name)):
            before = bisect(spans, (number, len(tags) + 1)) - 1
            tag.closed = tag.closed and not (before >= 0 and number < spans[before][1])
    return tags


def blocks_of(page: str) -> tuple[list[str], bool]:
    """The blocks that may be main text, and whether the markup says that they are."""
    found: list[tuple[str, bool, bool]] = []
    parts: list[str] = []
    open_marks: list[tuple[str, int]] = []
    seen: set[str] = set()
    skip: _Tag | None = None
    at = 0

    def end_block() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            kinds = [kind for kind, _ in open_marks]
            found.append((text, "article" in kinds, "main" in kinds))
        parts.clear()

    for number, tag in enumerate(_tags(page)):
        if skip is None:
            parts.append(page[at : tag.start])
        at = tag.stop
        if skip is not None:
            if number >= skip.end:
                own_end = tag.closing and tag.name == skip.name and skip.end == number and skip.closed
                skip = None
                if own_end:
                    continue
            elif tag.mark and not tag.never and not skip.closed:
                skip = None
            else:
                continue
        while open_marks and open_marks[-1][1] <= number:
            end_block()
            open_marks.pop()
        if tag.name in _BLOCKS or tag.mark:
            end_block()
        elif tag.name == "br":
            parts.append(" ")
        if tag.never:
            end_block()
            skip = tag
        elif tag.mark:
            open_marks.append((tag.mark, tag.end))
            seen.add(tag.mark)
    if skip is None:
        parts.append(page[at:])
    end_block()
    if "article" in seen:
        return [text for text, in_article, _ in found if in_article], True
    if "main" in seen:
        return [text for text, _, in_main in found if in_main], True
    return [text for text, _, _ in found], False


def _read(pages: Iterable[str | None]) -> Iterator[tuple[bool, bytes, list[str]]]:
    """Of each page: whether it marks its article, a digest of what decides its text, and its blocks."""
    for page in pages:
        blocks, marked = blocks_of(page or "")
        content = "\n\n".join(blocks) if marked else page or ""
        yield marked, hashlib.blake2b(content.encode(), digest_size=16).digest(), blocks


def _suffixes(pages: list[tuple[bool, list[str]]]) -> Iterator[tuple[np.ndarray, ...]]:
    """(page, block, first token, tokens, hash of the first tokens) of the suffixes of all blocks, in chunks.

    Short blocks of marked pages, such as headings, have none.
    """
    texts = [block for _, blocks in pages for block in blocks]
    page_of = np.repeat(np.arange(len(pages)), [len(blocks) for _, blocks in pages])
    block_of = np.concatenate([np.arange(len(blocks)) for _, blocks in pages]) if texts else page_of
    marked = np.array([m for m, _ in pages], bool)[page_of]
    for words in split_words(pa.array(texts, pa.string()), NOT_SPACE):
        here = np.arange(words.n_docs) + words.first_row
        first, tokens = words.bounds[:-1], np.diff(words.bounds)
        length = np.minimum(tokens, SUBSTRING_TOKENS)
        n = np.where((tokens == 0) | (marked[here] & (tokens < SUBSTRING_TOKENS)), 0, tokens - length + 1)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start, size = np.repeat(first, n) + at, np.repeat(length, n)
        grams = mixed(span_sums(words.hashes, start, start + size, _SUFFIX_BASE) + size.astype(np.uint64))
        yield np.repeat(page_of[here], n), np.repeat(block_of[here], n), at, size, grams


def _rows(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_PROFILE = pa.schema([
    ("host", pa.string()), ("marked", pa.bool_()), ("digest", pa.binary()), ("whole", pa.int64()), ("block", pa.binary()),
    ("n", pa.int64()), ("total", pa.int64()), ("bucket", pa.int32()), ("pages", pa.int64()),
])


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each different page (host, html): a row without a block and one for each long block, with its tokens and
    those of all its copies in the page; and of each host how many pages have suffixes in which buckets."""
    seen: set[tuple[str, bytes]] = set()
    counts: dict[tuple[str, bool], np.ndarray] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        for (host, marked), of_bucket in counts.items():
            at = np.flatnonzero(of_bucket)
            none = [None] * len(at)
            yield _rows([[host] * len(at), [marked] * len(at), none, none, none, none, none, at, of_bucket[at]], _PROFILE)
        counts.clear()

    for batch in batches:
        rows, pages, keys = [], [], []
        for host, (marked, digest, blocks) in zip(batch.column(0).to_pylist(), _read(x.as_py() for x in batch.column(1))):
            if not blocks or (host, digest) in seen:
                continue
            seen.add((host, digest))
            pages.append((marked, blocks))
            keys.append((host, marked))
            lengths = [block.count(" ") + 1 for block in blocks]
            whole = sum(lengths)
            rows.append((host, marked, digest, whole, None, None, None, None, None))
            times = Counter((b, n) for b, n in zip(blocks, lengths) if n >= SUBSTRING_TOKENS)
            rows += [(host, marked, digest, whole, _digest(b), n, n * k, None, None) for (b, n), k in times.items()]
        if rows:
            yield _rows(list(zip(*rows)), _PROFILE)
        with_bucket = [np.zeros(0, np.int64)]
        for page, _, _, _, grams in _suffixes(pages):
            with_bucket.append(np.unique(page * BUCKETS + (grams % np.uint64(BUCKETS)).astype(np.int64)))
        page, bucket = np.divmod(np.unique(np.concatenate(with_bucket)), BUCKETS)
        numbers = {key: i for i, key in enumerate(dict.fromkeys(keys))}
        number = np.array([numbers[key] for key in keys], np.int64)[page] if keys else page
        for key, i in numbers.items():
            here = np.bincount(bucket[number == i], minlength=BUCKETS)
            counts[key] = counts[key] + here if key in counts else here
        if len(counts) > HELD_HOSTS:
            yield from counted()
    yield from counted()
    release_memory()


_CANDIDATES = pa.schema([
    ("host", pa.string()), ("marked", pa.bool_()), ("digest", pa.binary()), ("gram", pa.int64()), ("block", pa.int32()),
    ("at", pa.int32()), ("n", pa.int32()),
])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffixes of each different page (host, html, buckets if it is marked, else) that lie in these buckets."""
    seen: set[tuple[str, bytes]] = set()
    for batch in batches:
        hosts, pages, digests, wanted = [], [], [], []
        columns = zip(batch.column(0).to_pylist(), _read(x.as_py() for x in batch.column(1)), batch.column(2), batch.column(3))
        for host, (marked, digest, blocks), in_marked, in_open in columns:
            buckets = (in_marked if marked else in_open).values
            if not blocks or not len(buckets) or (host, digest) in seen:
                continue
            seen.add((host, digest))
            hosts.append(host)
            pages.append((marked, blocks))
            digests.append(digest)
            wanted.append(buckets.to_numpy())
        is_wanted = np.zeros((len(pages), BUCKETS), bool)
        for i, buckets in enumerate(wanted):
            is_wanted[i, buckets] = True
        for page, block, at, size, grams in _suffixes(pages):
            keep = is_wanted[page, (grams % np.uint64(BUCKETS)).astype(np.int64)]
            of = page[keep]
            yield _rows(
                [[hosts[i] for i in of], [pages[i][0] for i in of], [digests[i] for i in of], grams[keep].view(np.int64),
                 block[keep].astype(np.int32), at[keep].astype(np.int32), size[keep].astype(np.int32)], _CANDIDATES,
            )
    release_memory()


_PARSED = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("marked", pa.bool_()), ("digest", pa.binary()),
    ("blocks", pa.list_(pa.string())),
])


def _parsed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    read = list(_read(x.as_py() for x in batch.column(3)))
    yield _rows([batch.column(0), batch.column(1), batch.column(2), *(list(c) for c in zip(*read))], _PARSED)


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode(), digest_size=16).digest()


def _without_runs(tokens: list[str], spans: list[tuple[int, int]]) -> str:
    """The tokens that no long enough run of the spans (first, end) covers."""
    runs: list[list[int]] = []
    for first, end in sorted(spans):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(end, runs[-1][1])
        else:
            runs.append([first, end])
    kept, at = [], 0
    for first, end in runs:
        if 2 * (end - first) >= len(tokens) or end - first >= LONG_RUN:
            kept += tokens[at:first]
            at = end
    return " ".join(kept + tokens[at:])


def _tokens(texts: list[str]) -> int:
    return sum(len(text.split()) for text in texts)


def _unique_runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    texts = []
    for marked, blocks, spans in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
        repeated = defaultdict(list)
        for span in spans or []:
            repeated[span["block"]].append((span["at"], span["at"] + span["n"]))
        kept = [_without_runs(block.split(), repeated[b]) if b in repeated else block for b, block in enumerate(blocks)]
        if marked and repeated and 4 * _tokens(kept) < 3 * _tokens(blocks):
            kept = blocks
        texts.append("\n\n".join(text for text in kept if text))
    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])


_KIND = ["host", "marked"]
_PAGE = [*_KIND, "digest"]


def _page_bodies(profile: DataFrame) -> DataFrame:
    """The body of each different page: its longest shared block if such blocks are most of the page, else the page."""
    blocks = profile.where("block IS NOT NULL").select(*_PAGE, "whole", "block", "n", "total").distinct()
    shared = (
        blocks.groupBy(*_KIND, "block").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
        .where("low < high").select(*_KIND, "block")
    )
    bodies = (
        blocks.join(shared, [*_KIND, "block"])
        .groupBy(*_PAGE).agg(F.sum("total").alias("n"), F.max("whole").alias("whole"), F.max(F.struct("n", "block")).alias("most"))
        .where("2 * n > whole").select(*_PAGE, F.col("most.block").alias("body"))
    )
    pages = profile.where("digest IS NOT NULL").select(*_PAGE).distinct()
    return pages.join(bodies, _PAGE, "left").withColumn("body", F.coalesce("body", "digest"))


def _often(count: str) -> F.Column:
    """In at least half of a host's bodies, and in several; of marked pages, whose text their markup vouches for, in three."""
    return (2 * F.col(count) >= F.col("bodies")) & (F.col(count) >= F.when(F.col("marked"), MARKED_BODIES).otherwise(2))


def _repeated_spans(pages: DataFrame) -> DataFrame:
    """Where the different pages (host, html) have tokens that the host repeats: host, marked, digest, spans."""
    profile = stored(pages.mapInArrow(_profiles, _ddl(_PROFILE)), "profiles")
    page_bodies = stored(_page_bodies(profile), "bodies")
    bodies = page_bodies.groupBy(*_KIND).agg(F.count_distinct("body").alias("bodies"))
    # As many buckets for a host of any size: what half of its bodies have fills a bucket, what few have spreads.
    hot = (
        profile.where("bucket IS NOT NULL").groupBy(*_KIND, "bucket").agg(F.sum("pages").alias("pages"))
        .join(bodies, _KIND).where(_often("pages"))
        .groupBy("host").agg(
            F.collect_list(F.when(F.col("marked"), F.col("bucket"))).alias("in_marked"),
            F.collect_list(F.when(~F.col("marked"), F.col("bucket"))).alias("in_open"),
        )
    )
    found = stored(pages.join(stored(hot, "buckets"), "host").mapInArrow(_candidates, _ddl(_CANDIDATES)), "suffixes")
    repeated = (
        found.join(page_bodies, _PAGE).select(*_KIND, "gram", "body").distinct()
        .groupBy(*_KIND, "gram").agg(F.count("*").alias("with"))
        .join(bodies, _KIND).where(_often("with")).select(*_KIND, "gram")
    )
    spans = found.join(repeated, [*_KIND, "gram"]).groupBy(*_PAGE).agg(F.collect_set(F.struct("block", "at", "n")).alias("spans"))
    return stored(spans, "spans")


def _ddl(schema: pa.Schema) -> str:
    kinds = {"bool": "boolean", "int32": "int", "int64": "long", "list<item: string>": "array<string>"}
    return ", ".join(f"{field.name} {kinds.get(str(field.type), str(field.type))}" for field in schema)


def main_texts(pages: DataFrame) -> DataFrame:
    """Of each page: page_id, url, text, n_chars."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.lower(F.regexp_extract("url", _HOST, 1)), F.lit("")).alias("host"),
        F.col("html").cast("string").alias("html"),
    )
    spans = _repeated_spans(rows.select("host", "html"))
    parsed = rows.mapInArrow(by_batch(lambda: _parsed), _ddl(_PARSED))
    return (
        parsed.join(spans, _PAGE, "left").select("page_id", "url", "marked", "blocks", "spans")
        .mapInArrow(by_batch(lambda: _unique_runs), "page_id long, url string, text string")
        .withColumn("n_chars", F.char_length("text").cast("long"))
    )
