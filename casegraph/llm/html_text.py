"""Main text of web pages: page structure first, then a suffix array of each host's token streams.

A page is read into blocks of text. Menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts
and styles go by element, role and class; if a page marks its article, only the article stays. The remaining token
streams of a host are concatenated and their suffixes sorted; stretches of ``min_tokens`` tokens and more that stand on several
distinct pages are boilerplate, and the tokens they cover are removed. Pages with the same text count as one, and stay alike. Inside a marked article a stretch must be on
nearly all of a host's pages, for a passage that a few articles share belongs to them.

A host with much text is dealt out to groups of about ``group_bytes``, by a hash of the page; the pages of a stretch are counted over
all its groups, so the result is that of the whole host.

* null or empty html: empty text; no host in the url, or null url: repeated stretches stay, for nothing ties such pages;
* repeated rows: one result each; unclosed elements and a cut-off end are read as far as they go;
* no rows: no rows; other columns are not carried.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from casegraph.llm.fm_index import suffix_order
from casegraph.llm.words import NON_SPACE, find_words, hash_runs, slices
from casegraph.session import fits, materialize

# Kinds of elements.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("script style title noscript template textarea select iframe object svg canvas math audio video xmp".split())
CHROME = frozenset("nav aside footer form button menu dialog label fieldset".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
CHROME_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies disqus disclaimer footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification "
    "pager pagination popup promo promotion related replies reply respond share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar widget widgets".split()
)
#: Parts of a class that may stand beside a name of chrome: "comment-list", "sidebar-left", "footer-links".
BESIDE = frozenset(
    "area bar block body bottom box button col column container content fixed form global group header heading inner item items left "
    "link links list main nav outer overlay page panel post posts primary right secondary section site slot sticky title top "
    "unit wrap wrapper".split()
)
#: Elements that hold a page or its article, whatever their class says about the page.
HOLDERS = frozenset("html body main article".split())
#: A start tag of these ends an open element of the second kind.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)""", re.S
)
_NAMES = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[^a-z]+")


@dataclass(frozen=True)
class Settings:
    min_tokens: int = 8
    #: Distinct pages of a host, and their share, that make a stretch boilerplate outside and inside a marked article.
    min_pages: int = 2
    min_share: float = 0.2
    article_pages: int = 8
    article_share: float = 0.8
    group_bytes: int = 4 << 20
    task_bytes: int = 128 << 20
    max_broadcast: int = 100_000


def _is_chrome_name(value: str, names: frozenset[str]) -> bool:
    """Whether a class is made of names of chrome alone: "cookie-notice" is, "has-sidebar" or "notice-of-meeting" is not."""
    for token in value.split():
        parts = {p for p in _PARTS.split(token) if p}
        if not parts.isdisjoint(names) and parts <= CHROME_NAMES | BESIDE:
            return True
    return False


def _role(tag: str, attributes: str, in_article: bool) -> str:
    """``chrome``, ``article`` or nothing in particular."""
    chrome = tag in CHROME or (tag == "header" and not in_article)
    article = tag in ("article", "main")
    if attributes:
        for name, *values in _NAMES.findall(attributes):
            value = (values[0] or values[1] or values[2]).lower()
            name = name.lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
                return "chrome"
            if name == "role":
                chrome |= value in CHROME_ROLES
                article |= value in ("main", "article")
            elif name == "itemprop":
                article |= value == "articlebody"
            elif name in ("class", "id"):
                if tag not in HOLDERS or (tag == "article" and in_article):
                    chrome |= _is_chrome_name(value, CHROME_NAMES if in_article else CHROME_NAMES | {"header"})
    return "chrome" if chrome else "article" if article else ""


def blocks_of(page: str) -> tuple[list[str], bool]:
    """Blocks of text without chrome, and whether they are those of a marked article."""
    plain: list[str] = []
    article: list[str] = []
    stack: list[str] = []  # open elements
    chrome_from: int | None = None  # depth of the outermost chrome element
    article_from: int | None = None
    skipping: str | None = None  # an element whose content is no text
    text: list[str] = []

    def flush() -> None:
        if text:
            whole = "".join(text)
            if "&" in whole:
                whole = html.unescape(whole)
            whole = _SPACE.sub(" ", whole).strip()
            if whole:
                (article if article_from is not None else plain).append(whole)
            text.clear()

    def close(depth: int) -> None:
        nonlocal chrome_from, article_from
        del stack[depth:]
        if article_from is not None and article_from >= depth:
            flush()
            article_from = None
        if chrome_from is not None and chrome_from >= depth:
            chrome_from = None

    at = 0
    for m in _TAG.finditer(page):
        if skipping is None and chrome_from is None and m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if skipping is not None:
            if m[1] and tag == skipping:
                skipping = None
            continue
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            text.append(" ")
        if m[1]:
            if tag in stack:
                close(len(stack) - 1 - stack[::-1].index(tag))
            continue
        if tag in NO_TEXT:
            if not m[3].endswith("/"):
                skipping = tag
            continue
        if tag in VOID:
            continue
        ended = ENDS.get(tag, ("p",) if tag in BLOCKS else ())
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth] in ended:
                close(depth)
                break
            if stack[depth] in BLOCKS:
                break
        role = _role(tag, m[3], article_from is not None)
        if role == "article" and article_from is None and chrome_from is not None and stack[chrome_from] in ("div", "section", "p", "span"):
            chrome_from = None  # an element that was never closed
        if role == "chrome" and chrome_from is None:
            flush()
            chrome_from = len(stack)
        elif role == "article" and chrome_from is None and article_from is None:
            flush()
            article_from = len(stack)
        stack.append(tag)
    if skipping is None and chrome_from is None:
        rest = page[at:]
        text.append(rest)
    flush()
    return (article, True) if article else (plain, False)


def _stretches(symbols: np.ndarray, page: np.ndarray, min_tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all stretches of ``min_tokens`` in suffix order, the number of the stretch at each, and on how many pages each stands.

    ``symbols`` has zeros between pages and at both ends; ``page`` numbers the pages.
    """
    order = suffix_order(symbols)
    # neighbours in suffix order that agree in so many tokens
    padded = np.concatenate([symbols, np.zeros(min_tokens, dtype=symbols.dtype)])
    whole = np.ones(len(order), dtype=bool)
    same = np.ones(max(len(order) - 1, 0), dtype=bool)
    for j in range(min_tokens):
        own = padded[order + j]
        whole &= own > 0
        same &= own[1:] == own[:-1]
    group = np.cumsum(np.concatenate([[True], ~same]))
    group, order = group[whole], order[whole]
    pairs = np.unique(group * (int(page[-1]) + 1 if len(page) else 1) + page[order]) // (int(page[-1]) + 1 if len(page) else 1)
    pages = np.bincount(pairs, minlength=int(group[-1]) + 1 if len(group) else 1)
    return order, group, pages


def _cover(starts: np.ndarray, n: int, min_tokens: int) -> np.ndarray:
    """Which of ``n`` symbols are covered by the stretches that begin at ``starts``."""
    covered = np.zeros(n + 1, dtype=np.int64)
    covered[starts] += 1
    np.add.at(covered, starts + min_tokens, -1)
    return np.cumsum(covered[:-1]) > 0


def repeated_tokens(symbols: np.ndarray, page: np.ndarray, need: np.ndarray, min_tokens: int) -> np.ndarray:
    """Which symbols are covered by stretches of ``min_tokens`` that stand on at least ``need`` pages (per symbol)."""
    order, group, pages = _stretches(symbols, page, min_tokens)
    return _cover(order[pages[group] >= need[order]] if len(group) else order, len(symbols), min_tokens)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, with zeros between texts and at both ends, and the number of the text at each place."""
    symbols, page = [], []
    for p in slices(texts):
        w = find_words(p, NON_SPACE)
        gaps = w.text + 1  # a separator before each page
        ids = np.zeros(len(w.start) + p.n, dtype=np.uint64)
        place = np.arange(len(w.start)) + gaps
        ids[place] = hash_runs(p.data, w.start, w.end) | np.uint64(1)
        owner = np.zeros(len(ids), dtype=np.int64)
        owner[place] = w.text + p.first
        breaks = np.ones(len(ids), dtype=bool)
        breaks[place] = False
        owner[breaks] = p.first + np.arange(p.n)
        symbols.append(ids)
        page.append(owner)
    return np.concatenate([*symbols, np.zeros(1, np.uint64)]), np.concatenate([*page, [max(len(texts) - 1, 0)]])


def _numbered(hashes: np.ndarray) -> np.ndarray:
    return np.unique(hashes, return_inverse=True)[1].astype(np.int64)  # zero stays the smallest


def _stretch_starts(hashes: np.ndarray, min_tokens: int) -> np.ndarray:
    """Places at which so many tokens of one text follow."""
    gap = np.cumsum(np.concatenate([[0], hashes == 0]))
    n = max(len(hashes) - min_tokens + 1, 0)
    return np.flatnonzero(gap[min_tokens : min_tokens + n] == gap[:n])


def _stretch_hashes(hashes: np.ndarray, starts: np.ndarray, min_tokens: int) -> np.ndarray:
    """One number per stretch, the same in every group of a host."""
    found = np.zeros(len(starts), dtype=np.uint64)
    for j in range(min_tokens):
        found = found * np.uint64(0x9E3779B97F4A7C15) + hashes[starts + j]
    return found.view(np.int64)


def _needs(n_pages: int, settings: Settings) -> tuple[int, int]:
    """Pages on which a stretch is boilerplate outside and inside a marked article."""
    return (
        max(settings.min_pages, int(np.ceil(settings.min_share * n_pages))),
        max(settings.article_pages, int(np.ceil(settings.article_share * n_pages))),
    )


def _reported(n_pages: int, settings: Settings) -> int:
    """Pages of a group from which on it reports a stretch: half the smaller share, so that few reports do not suffice."""
    return max(1, int(np.ceil(min(settings.min_share, settings.article_share) / 2 * n_pages)))


def _without_boilerplate(texts: pa.Array, article: np.ndarray, settings: Settings) -> list[str]:
    """Texts of one host; a text that several pages have is looked at once, for a copy proves no boilerplate."""
    coded = texts.dictionary_encode()
    of = coded.indices.to_numpy(zero_copy_only=False)
    marked = np.zeros(len(coded.dictionary), dtype=bool)
    marked[of[article]] = True
    cleaned = _clean_distinct(coded.dictionary, marked, settings)
    return [cleaned[i] for i in of.tolist()]


def _clean_distinct(texts: pa.Array, article: np.ndarray, settings: Settings) -> list[str]:
    """Different texts of a host without what they share."""
    outside, inside = _needs(len(texts), settings)
    needs = np.where(article, inside, outside)
    if len(texts) < needs.min():
        return texts.to_pylist()
    hashes, page = _tokens(texts)
    return _without(texts, hashes, page, repeated_tokens(_numbered(hashes), page, needs[page], settings.min_tokens))


def _without(texts: pa.Array, hashes: np.ndarray, page: np.ndarray, covered: np.ndarray) -> list[str]:
    """Texts without their covered tokens; blocks are lines with an empty line between."""
    out = texts.to_pylist()
    for i in np.unique(page[covered]).tolist():
        a, b = np.searchsorted(page, [i, i + 1])
        keep, tokens = ~covered[a:b][hashes[a:b] > 0], 0
        blocks = []
        for block in out[i].split("\n\n"):
            own = [t for t in re.split(r"[\x20\x09-\x0D]+", block) if t]
            left = [t for t, k in zip(own, keep[tokens : tokens + len(own)]) if k]
            tokens += len(own)
            if left:
                blocks.append(" ".join(left))
        out[i] = "\n\n".join(blocks)
    return out


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _texts_of(group: pa.Table, told: pa.Table, owned: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different texts of a group (or those that it counts), whether a page of the host marks them, and of which row each is the text."""
    codes = group.column("code").to_numpy()
    names = told.filter(pa.compute.equal(told.column("kind"), 0))
    if owned:
        names = names.filter(names.column("a"))
    known = names.column("code").to_numpy()
    different, first, of = np.unique(codes, return_index=True, return_inverse=True)
    at = np.searchsorted(different, known)
    order = np.argsort(at)
    return _column(group, "text").take(pa.array(first[at[order]])), names.column("b").to_numpy(zero_copy_only=False)[order].astype(bool), of


def _boilerplate(pages: DataFrame, settings: Settings) -> DataFrame:
    """What groups must be told (``host, group, kind, code, a, b``): of their texts (kind 0) whether they count them and
    whether they are marked, of boilerplate (kind 1) whether it goes outside and inside marked articles.

    The pages of a stretch are counted over all groups of a host. A stretch on a share of all different texts is on half of it in so
    many groups that these tell of it (``_reported``, by suffix arrays); the stretches told of are then counted everywhere. Only these
    numbers are sent: the pages stay in the groups to which one shuffle dealt them.
    """
    n_tokens = settings.min_tokens
    groups = pages.groupBy("host", "group")

    def name_texts(table: pa.Table) -> pa.Table:
        if table.column("groups")[0].as_py() == 1 or table.column("host")[0].as_py() == "":
            table = table.slice(0, 0)
        found = table.group_by(["host", "group", "code"]).aggregate([("article", "any")])
        return found.select(["host", "group", "code", "article_any"]).rename_columns(["host", "group", "code", "marked"])

    copies = Window.partitionBy("host", "code")
    texts = groups.applyInArrow(name_texts, "host string, group long, code long, marked boolean").select(
        "host", "group", F.lit(0).alias("kind"), "code",
        (F.min("group").over(copies) == F.col("group")).alias("a"), F.max("marked").over(copies).alias("b"),
    )
    n = F.sum(F.col("a").cast("long"))
    share = min(settings.min_share, settings.article_share)
    hosts = texts.groupBy("host", "group").agg(n.alias("n"))
    hosts = hosts.withColumn("unseen", F.greatest(F.lit(1), F.ceil(F.lit(share / 2) * F.col("n"))) - 1)
    hosts = hosts.groupBy("host").agg(F.sum("n").alias("n"), F.sum("unseen").alias("unseen"), F.collect_list("group").alias("in_groups"))
    hosts = hosts.select(
        "host", "unseen", "in_groups",
        F.greatest(F.lit(settings.min_pages), F.ceil(F.lit(settings.min_share) * F.col("n"))).alias("outside"),
        F.greatest(F.lit(settings.article_pages), F.ceil(F.lit(settings.article_share) * F.col("n"))).alias("inside"),
    )

    def told(host: str, codes: np.ndarray, numbers: np.ndarray) -> pa.Table:
        names = pa.array([host] * len(codes), pa.string())
        return pa.table([names, pa.array(codes, pa.int64()), pa.array(numbers, pa.int64())], names=["host", "code", "pages"])

    def report(group: pa.Table, right: pa.Table) -> pa.Table:
        host = group.column("host")[0].as_py()
        none = told(host, np.zeros(0, np.int64), np.zeros(0, np.int64))
        if not right.num_rows:
            return none
        own = _texts_of(group, right, True)[0]
        if not len(own):
            return none
        least = _reported(len(own), settings)
        hashes, page = _tokens(own)
        order, stretch, on = _stretches(_numbered(hashes), page, n_tokens)
        stretch, first = np.unique(stretch, return_index=True)
        often = on[stretch] >= least
        # by how much it is more than a group may leave untold
        return told(host, _stretch_hashes(hashes, order[first[often]], n_tokens), on[stretch[often]] - (least - 1))

    def count(group: pa.Table, right: pa.Table) -> pa.Table:
        host = group.column("host")[0].as_py()
        asked = np.sort(right.filter(pa.compute.equal(right.column("kind"), 1)).column("code").to_numpy())
        own = _texts_of(group, right, True)[0] if len(asked) else []
        if not len(own):
            return told(host, np.zeros(0, np.int64), np.zeros(0, np.int64))
        hashes, page = _tokens(own)
        starts = _stretch_starts(hashes, n_tokens)
        found = _stretch_hashes(hashes, starts, n_tokens)
        at = np.minimum(np.searchsorted(asked, found), len(asked) - 1)
        hit = asked[at] == found
        pairs = np.unique(at[hit] * len(own) + page[starts[hit]]) // len(own)
        on = np.bincount(pairs, minlength=len(asked))
        return told(host, asked[on > 0], on[on > 0])

    def to_groups(stretches: DataFrame, a: Column, b: Column) -> DataFrame:
        return stretches.select("host", F.explode("in_groups").alias("group"), F.lit(1).alias("kind"), "code", a.alias("a"), b.alias("b"))

    numbers = "host string, code long, pages long"
    said = groups.cogroup(texts.groupBy("host", "group")).applyInArrow(report, numbers)
    asked = said.groupBy("host", "code").agg(F.sum("pages").alias("pages")).join(hosts, "host")
    asked = asked.where(F.col("pages") + F.col("unseen") >= F.least("outside", "inside"))
    asked = texts.unionByName(to_groups(asked, F.lit(False), F.lit(False)))
    counted = groups.cogroup(asked.groupBy("host", "group")).applyInArrow(count, numbers)
    counted = counted.groupBy("host", "code").agg(F.sum("pages").alias("pages")).join(hosts, "host")
    counted = counted.where(F.col("pages") >= F.least("outside", "inside"))
    return texts.unionByName(to_groups(counted, F.col("pages") >= F.col("outside"), F.col("pages") >= F.col("inside")))


def _without_told(group: pa.Table, right: pa.Table, settings: Settings) -> list[str]:
    """Texts of a group without the boilerplate of its host."""
    texts, marked, of = _texts_of(group, right, False)
    stretches = right.filter(pa.compute.equal(right.column("kind"), 1))
    codes = stretches.column("code").to_numpy()
    cleaned = texts.to_pylist()
    if len(codes):
        order = np.argsort(codes)
        codes = codes[order]
        goes = np.stack([stretches.column(c).to_numpy(zero_copy_only=False).astype(bool)[order] for c in ("a", "b")])
        hashes, page = _tokens(texts)
        starts = _stretch_starts(hashes, settings.min_tokens)
        found = _stretch_hashes(hashes, starts, settings.min_tokens)
        at = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
        gone = (codes[at] == found) & goes[marked[page[starts]].astype(np.int64), at]
        cleaned = _without(texts, hashes, page, _cover(starts[gone], len(hashes), settings.min_tokens))
    return [cleaned[i] for i in of.tolist()]


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html", settings: Settings = Settings()) -> DataFrame:
    """``id, url, text`` of every page."""
    pages = pages.select(id, url, page)
    kept = [pages.schema[id], pages.schema[url]]
    parsed = StructType([*kept, *StructType.fromDDL("text string, article boolean")])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks_of(p or "") for p in batch.column(2).to_pylist()]
            texts = pa.array(["\n\n".join(b) for b, _ in found], pa.string())
            marked = pa.array([flag for _, flag in found], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts, marked], names=parsed.names)

    # empty for pages without a host, which are dealt out like a large one but not compared
    host = F.coalesce(F.lower(F.regexp_extract(url, r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    # hosts with more text than a group takes
    # written, as several jobs use it: the pages are read once for it
    sizes = materialize(pages.groupBy(host.alias("host")).agg(F.sum(F.octet_length(page)).alias("bytes")), "host-bytes")
    large = sizes.where(F.col("bytes") > settings.group_bytes)
    large = large.select("host", F.ceil(F.col("bytes") / settings.group_bytes).alias("groups"))
    blocks = pages.mapInArrow(parse, parsed).withColumn("host", host)
    blocks = blocks.join(F.broadcast(large) if fits(large, settings.max_broadcast) else large, "host", "left")
    own = F.when(F.col("host") == "", F.xxhash64("text"))
    group = F.pmod(F.xxhash64(F.col(id), F.col(url), own), F.coalesce("groups", F.lit(1)))
    # hosts of several groups: different texts are known by a hash
    several = large.where("host <> ''").limit(1).count() > 0
    names = [F.coalesce("groups", F.lit(1)).alias("groups"), F.xxhash64("text").alias("code")] if several else []
    page_keys = [F.col(id).alias("_id"), F.col(url).alias("_url")]  # their own names may be anything
    blocks = blocks.select("host", group.alias("group"), *page_keys, "text", "article", *names)
    # more partitions than the session's where these would hold more than ``task_bytes`` each
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    tasks = int(total // settings.task_bytes) + 1
    if tasks > int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        blocks = blocks.repartition(tasks, "host", "group")
    result = StructType([*kept, StructField("text", parsed["text"].dataType)])

    def clean_told(table: pa.Table, right: pa.Table | None) -> pa.Table:
        if right is not None and right.num_rows:
            cleaned = pa.array(_without_told(table, right, settings), pa.string())
        elif table.column("host")[0].as_py() == "":
            cleaned = _column(table, "text")
        else:
            marked = table.column("article").to_numpy().astype(bool)
            cleaned = pa.array(_without_boilerplate(_column(table, "text"), marked, settings), pa.string())
        return pa.table([table.column("_id"), table.column("_url"), cleaned], names=result.names)

    def clean(table: pa.Table) -> pa.Table:
        return clean_told(table, None)

    groups = blocks.groupBy("host", "group")
    if not several:
        return groups.applyInArrow(clean, result)
    return groups.cogroup(_boilerplate(blocks, settings).groupBy("host", "group")).applyInArrow(clean_told, result)
