"""The main text of web pages: their structure, and a suffix array over each host's token streams.

A page is read into words. Menus, headers, footers, sidebars, notices, adverts, forms and reader
comments are known by element, role, class or id, and go. What is left goes by the suffix array of
its host's token streams, which are concatenated; the unique runs stay:

* Where a page marks its article, the words in there are its text. As the mark speaks for them, a
  run of RUN of its words or more is boilerplate where it stands in over half of the host's distinct
  articles, and in ARTICLES of them at least: a notice of the site that is put into each.
* Where it does not, what is left is open: words and block tags of everything outside marked
  articles are the streams, and open words are boilerplate that lie in a run of RUN tokens or more
  which stands on PAGES distinct pages or more.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketeer.llm import arrays as A
from docketeer.llm import suffixes
from docketeer.session import settled

RUN, PAGES = 8, 3
# Distinct articles of a host that a run stands in at least, beside over half of all.
ARTICLES = 10
# A page has text of its own where one open word in so many at least is in no shared run.
OWN = 10
# Distinct pages of a host whose streams are put together; a larger host is worked through as
# several sites of about this size, by a hash of the page. And pages of one task's group.
SITE_PAGES, GROUP_PAGES = 512, 2048

# Where a comment, raw data, a declaration or a tag begins; and what decides where a tag ends.
_OPEN = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)([a-zA-Z][^\s/><\"']*)")
_SPECIAL = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_RAW = "script style noscript template iframe textarea title xmp noembed noframes".split()
_RAW_END = {name: re.compile(rf"</{name}\b", re.IGNORECASE) for name in _RAW}
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_DROPPED = frozenset(
    "head nav footer aside form button select datalist svg math object dialog menu map audio"
    " video canvas".split()
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt"
    " ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
# An opening tag that ends an open element of these kinds.
_ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
_ENDS_P = frozenset(
    "address article aside blockquote center details div dl fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_SCOPES = frozenset("article main section div body html td th li table blockquote".split())
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu"
    " menubar toolbar".split()
)
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|cookies?|consent|gdpr|notices?"
    r"|alert|sidebar\w*|side|menu\w*|nav|navbar|navigation|breadcrumbs?|comments?|commentlist"
    r"|replies|reply|respond|disqus\w*|share|sharing|social\w*|related|recommend\w*|newsletter"
    r"|subscribe|subscription|popup|modal|overlay|widgets?|pagination|pager|footer|copyright"
    r"|skip|toolbar|login|signup)(?:$|[\s_-])",
    re.IGNORECASE,
)
_HEADER = re.compile(r"(?:^|[\s_-])(?:header|masthead|topbar)(?:$|[\s_-])", re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
# An article that is a teaser card, an advert or a comment: whole words, as themes put words like
# has-sidebar or comments-open on real ones.
_CARD = re.compile(
    r"(?:^|\s)(?:ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|comments?|replies|reply|related"
    r"|recommend\w*|teasers?|newsletter|widgets?|popup|modal|sidebar)"
    r"(?:[_-]+(?:\d+|item|card|post|body|box|teaser|article|list))*(?:\s|$)",
    re.IGNORECASE,
)
_ROOTS = frozenset(("html", "body", "article", "main"))
# Marks in a stream: of a block tag, and of a word of an open block.
TAG, OPEN = "\x01", "\x02"


def _drops(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is no part of an article."""
    if name in _DROPPED or (name == "header" and not in_article):
        return True
    if not attributes or name in ("html", "body"):
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "style" and _HIDDEN.search(value)):
            return True
        if key == "role" and value.lower() in _ROLES:
            return True
        if name == "article" and key in ("class", "id") and _CARD.search(value):
            return True
        if key in ("class", "id") and name not in _ROOTS:
            if _NAMES.search(value) or (not in_article and _HEADER.search(value)):
                return True
    return False


class _Tags:
    """The tags of a page, found in time linear in its length, whatever is left open in it.

    A tag ends at the first ``>`` outside of quotes. One that has no such end, or a quote that is
    never closed, is text. Places from which that was found are kept, so no way is gone twice.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.next_special = -1
        self.nowhere: set[int] = set()

    def find(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(start, end, whether it closes, name, rest) of the next tag from a place on."""
        page, n = self.page, len(self.page)
        while (found := _OPEN.search(page, at)) is not None:
            begin = found.end()
            if found[2]:
                end = self._end(begin)
                if end >= 0:
                    return found.start(), end + 1, bool(found[1]), found[2].lower(), page[begin:end]
                at = begin
                continue
            mark = {"<!--": "-->", "<![CDATA[": "]]>"}.get(found[0], ">")
            end = page.find(mark, begin)
            held = page[begin : n if end < 0 else end] if mark == "]]>" else ""
            return found.start(), n if end < 0 else end + len(mark), False, "", held
        return None

    def _end(self, at: int) -> int:
        """Where the tag ends whose name ends here, or -1."""
        page = self.page
        if self.next_special < at:
            found = _SPECIAL.search(page, at)
            self.next_special = found.start() if found else len(page)
        stop, way = self.next_special, []
        while stop < len(page) and stop not in self.nowhere:
            if page[stop] == ">":
                return stop
            way.append(stop)
            closed = page.find(page[stop], stop + 1)
            found = _SPECIAL.search(page, closed + 1) if closed >= 0 else None
            stop = found.start() if found else len(page)
        self.nowhere.update(way)
        return -1


def read_page(page: str) -> tuple[list[str], list[str]]:
    """(words of the marked articles, tokens of everything else) of a page.

    Without a marked article the words list is empty, and the words that are not dropped for
    their element are marked as open in the tokens. Articles count where they hold most of the
    words of ``main`` and articles, or of the page if it has no ``main``; else the article is in ``main``. Elements that are never closed end with the one around them.
    """
    # Runs of raw text, with where they stand: (tag that opened a block or "", text, state).
    stack: list[tuple[str, bool, str]] = []  # name, dropped, article
    parts: list[tuple[str, str, bool, str]] = []
    at, n = 0, len(page)
    dropped, article = False, ""
    tags = _Tags(page)
    while at < n:
        found = tags.find(at)
        end = found[0] if found else n
        if end > at:
            parts.append(("", page[at:end], dropped, article))
        if not found:
            break
        _, at, closing, name, rest = found
        if not name:
            if rest:
                parts.append(("", html.escape(rest, False), dropped, article))
            continue
        if name not in _INLINE:
            parts.append((name, "", dropped, article))
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
        elif name in _RAW_END:
            over = _RAW_END[name].search(page, at)
            end = page.find(">", over.end()) if over else -1
            at = end + 1 if end >= 0 else n
        elif name not in _VOID:
            ends = _ENDS.get(name, ())
            if name in _ENDS_P:
                ends = ("p",)
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    del stack[k:]
                    break
                if stack[k][0] in _SCOPES:
                    break
            dropped, article = stack[-1][1:] if stack else (False, "")
            if name == "article":
                article = "article in main" if article.endswith("main") else "article"
            elif name == "main":
                article = article or "main"
            drops = dropped or _drops(name, rest, bool(article))
            stack.append((name, drops, article))
        dropped, article = stack[-1][1:] if stack else (False, "")
    said: Counter[str] = Counter()
    for _, text, drop, where in parts:
        if not drop:
            said[where] += len(text.split())
    articles = said["article"] + said["article in main"]
    in_main = said["main"] + said["article in main"]
    inside: tuple[str, ...] = ()
    if 2 * articles > (in_main + said["article"] if in_main else sum(said.values())):
        inside = ("article", "article in main")
    elif in_main:
        inside = ("main", "article in main")

    words: list[str] = []
    tokens: list[str] = []
    block: list[str] = []
    kind: tuple[bool, bool] = (False, False)

    def close() -> None:
        said = html.unescape("".join(block)).split()
        block.clear()
        if kind[0]:
            words.extend(said)
        else:
            tokens.extend(OPEN + w if kind[1] else w for w in said)

    for tag, text, drop, where in parts:
        main = not drop and where in inside
        now = (main, not inside and not drop)
        if tag or now != kind:
            close()
            kind = now
        if tag and not main:
            tokens.append(TAG + tag)
        if text:
            block.append(text)
    close()
    return words, tokens


def host_of(url: Column) -> Column:
    """The host of a url in lower case, empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _runs(streams: list[list[str]], sites: np.ndarray, run: int) -> tuple[np.ndarray, ...]:
    """Where runs begin, which run of a site each one is, its stream, and the bounds of the streams."""
    sizes = np.array([len(s) for s in streams], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
    numbers: dict[str, int] = {}
    text = np.zeros(int((sizes + 1).sum()), np.int64)
    for begin, stream in zip(begins.tolist(), streams, strict=True):
        bare = (w[1:] if w[:1] == OPEN else w for w in stream)
        text[begin : begin + len(stream)] = [numbers.setdefault(w, len(numbers) + 1) for w in bare]
    page = np.repeat(np.arange(len(streams)), sizes + 1)
    room = np.repeat(begins + sizes, sizes + 1) - np.arange(len(text))
    array = suffixes.suffix_array(text)
    plcp, _ = suffixes.permuted_lcp(text, array)
    group = np.empty(len(text), np.int64)
    group[array] = np.cumsum(plcp[array] < run)
    at = np.flatnonzero(room >= run)
    own = group[at] * (int(sites.max()) + 1) + sites[page[at]]
    return at, np.unique(own, return_inverse=True)[1], page[at], begins, sizes


def _spread(index: np.ndarray, page: np.ndarray, streams: int) -> np.ndarray:
    """On how many streams each run stands."""
    pairs = np.unique(index * streams + page)
    return np.bincount(pairs // streams, minlength=int(index.max(initial=-1)) + 1)


def _flags(first: np.ndarray, begins: np.ndarray, sizes: np.ndarray, run: int) -> list[np.ndarray]:
    flags = A.covered(first, first + run, int((sizes + 1).sum()))
    return [flags[b : b + n] for b, n in zip(begins.tolist(), sizes.tolist(), strict=True)]


def boilerplate(streams: list[list[str]], sites: np.ndarray, run: int = RUN, pages: int = PAGES) -> list[np.ndarray]:
    """Which tokens of each stream lie in a run that ``pages`` streams of its site share."""
    if not any(streams):
        return [np.zeros(0, bool) for _ in streams]
    at, index, page, begins, sizes = _runs(streams, sites, run)
    first = at[_spread(index, page, len(streams))[index] >= pages]
    return _flags(first, begins, sizes, run)


def _hashes(streams: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash of the run at every place of the streams, the bounds of the streams."""
    sizes = np.array([len(s) for s in streams], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
    seen: dict[str, int] = {}
    text = np.zeros(int((sizes + 1).sum()), np.uint64)
    for begin, stream in zip(begins.tolist(), streams, strict=True):
        for k, w in enumerate(stream, begin):
            w = w[1:] if w[:1] == OPEN else w
            h = seen.get(w)
            if h is None:
                h = seen[w] = int.from_bytes(hashlib.blake2b(w.encode(errors="replace"), digest_size=8).digest())
            text[k] = h
    return A.window_hashes(text, RUN).view(np.int64), begins, sizes


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _streams(group: pd.DataFrame) -> list[list[str]]:
    return [s.split(" ") if s else [] for s in group["stream"]]


def _shared(group: pd.DataFrame, shared: pd.DataFrame) -> tuple[list[list[str]], np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Streams; place, run hash and stream of each shared run in them; and which tokens these cover."""
    streams = _streams(group)
    hashes, begins, sizes = _hashes(streams)
    page = np.repeat(np.arange(len(streams)), np.maximum(sizes - RUN + 1, 0))
    at = begins[page] + _within(np.maximum(sizes - RUN + 1, 0))
    site = group["site"].to_numpy()
    known = pd.MultiIndex.from_arrays([shared["site"].to_numpy(), shared["run"].to_numpy()])
    held = pd.MultiIndex.from_arrays([site[page], hashes[at]]).isin(known) if len(known) else np.zeros(len(at), bool)
    at, page = at[held], page[held]
    return streams, at, hashes[at], page, _flags(at, begins, sizes, RUN)


def _stretches(streams: list[list[str]], sites: np.ndarray) -> tuple[list[list[str]], np.ndarray]:
    """The stretches of RUN words or more that each stand in over half of a site's streams; their stream.

    A run that over half of the streams hold lies in such stretches, as each of its words does.
    """
    sizes = np.array([len(s) for s in streams], np.int64)
    page = np.repeat(np.arange(len(streams)), sizes)
    words = np.array([w for s in streams for w in s], object)
    own = pd.factorize(words)[0].astype(np.int64) * (int(sites.max(initial=0)) + 1) + sites[page]
    index = np.unique(own, return_inverse=True)[1]
    often = 2 * _spread(index, page, len(streams))[index] > np.bincount(sites)[sites[page]]
    begins = np.flatnonzero(often & np.append(True, ~often[:-1] | (page[1:] != page[:-1]))) if len(page) else page
    ends = np.flatnonzero(often & np.append(~often[1:] | (page[1:] != page[:-1]), True)) + 1 if len(page) else page
    long = ends - begins >= RUN
    begins, ends = begins[long], ends[long]
    return [words[b:e].tolist() for b, e in zip(begins.tolist(), ends.tolist(), strict=True)], page[begins]


def _is_open(words: list[str], tokens: list[str]) -> bool:
    """Whether a page marks no article and has words that may be its text."""
    return not words and any(w[:1] == OPEN for w in tokens)


def _digest(said: str) -> bytes:
    return hashlib.blake2b(said.encode(errors="replace"), digest_size=16).digest()


def article_runs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, runs) of the runs that are boilerplate in articles, and (host) of those with an open page.

    ``rows`` has id, url, html and host. A run in over half of a host's distinct articles is in over
    half of those of one of its sites, so each site's suffix array tells which runs to count over
    the whole host, and how it is cut into sites decides nothing.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            hosts, texts, digests = [], [], []
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                words, tokens = read_page(page or "")
                said = " ".join(words)
                if not words and not _is_open(words, tokens):
                    continue
                digest = _digest(said)
                if (host, digest) not in seen:
                    seen.add((host, digest))
                    hosts.append(host)
                    texts.append(said)
                    digests.append(digest)
            out = [pa.array(hosts, pa.string()), pa.array(texts, pa.string()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(out, ["host", "text", "digest"])

    pages = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).withColumn("parts", F.ceil(F.col("n") / SITE_PAGES))
    pages = settled(pages, "hosts")
    groups = max(1, -(-(pages.agg(F.sum("n")).first()[0] or 0) // GROUP_PAGES))
    # One row for SITE_PAGES pages at most.
    large = F.broadcast(pages.where("parts > 1").select("host", "parts"))
    found = rows.select("host", "html").mapInArrow(read, "host string, text string, digest binary")
    found = found.join(large, "host", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    site = F.xxhash64("host", F.pmod(F.xxhash64("digest"), "parts"))
    found = found.withColumn("site", site).withColumn("group", F.pmod("site", F.lit(groups)))

    def nominate(group: pd.DataFrame) -> pd.DataFrame:
        """A row for each site, and one for each run in over half of its articles."""
        group = group.drop_duplicates(["host", "digest"])
        open_page = group["text"] == ""
        told = [pd.DataFrame({"host": group["host"][open_page].unique(), "n": 0, "run": None, "open": True})]
        group = group[~open_page]
        # A host that has no more than these is in one site.
        size = group.groupby(["host", "site"])["digest"].transform("size")
        total = group.groupby(["host", "site"], as_index=False).agg(n=("digest", "size"), parts=("parts", "first"))
        total = total[(total["n"] >= ARTICLES) | (total["parts"] > 1)]
        told.append(total[["host", "n"]].assign(run=None, open=False))
        group = group[(size >= ARTICLES) | (group["parts"] > 1)]
        if len(group):
            sites, own = np.unique(group["site"].to_numpy(), return_inverse=True)
            streams, page = _stretches([s.split(" ") for s in group["text"]], own)
            at, index, stretch, _, _ = _runs(streams, own[page], RUN) if streams else [np.zeros(0, np.int64)] * 5
            _, one = np.unique(index, return_index=True)
            here = np.bincount(own)[own[page[stretch[one]]]]
            one = one[2 * _spread(index, page[stretch], len(group)) > here]
            if len(one):
                hosts = group["host"].to_numpy()[page[stretch[one]]]
                runs = pd.array(_hashes(streams)[0][at[one]], dtype="Int64")
                told.append(pd.DataFrame({"host": hosts, "n": 0, "run": runs, "open": False}))
        out = pd.concat([t.astype({"run": "Int64", "n": "int64", "open": bool}) for t in told if len(t)] or [told[0]])
        return out[["host", "n", "run", "open"]]

    # As many partitions as groups, so that a task's part does not grow with the table.
    grouped = found.repartition(groups, "group").groupBy("group")
    told = settled(grouped.applyInPandas(nominate, "host string, n long, run long, open boolean"), "sites")
    open_hosts = told.where("open").select("host").distinct()
    named = told.where("run is not null").groupBy("host").agg(F.collect_set("run").alias("runs"))
    named = settled(named, "named")
    if named.isEmpty():
        return named, open_hosts

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, runs = [], []
            columns = (batch.column(c).to_pylist() for c in ("html", "runs"))
            for page, wanted in zip(*columns, strict=True):
                words = read_page(page or "")[0]
                hashes = _hashes([words])[0][: max(0, len(words) - RUN + 1)]
                digests.append(_digest(" ".join(words)))
                runs.append(np.intersect1d(hashes, np.array(wanted, np.int64)).tolist())
            out = [batch.column("host"), pa.array(digests, pa.binary()), pa.array(runs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(out, ["host", "digest", "runs"])

    texts = rows.select("host", "html").join(named, "host").mapInArrow(held, "host string, digest binary, runs array<long>")
    texts = texts.where(F.size("runs") > 0).dropDuplicates(["host", "digest"])
    count = texts.select("host", F.explode("runs").alias("run")).groupBy("host", "run").agg(F.count(F.lit(1)).alias("n"))
    all_of = told.groupBy("host").agg(F.sum("n").alias("articles"))
    often = count.join(all_of, "host").where((F.col("n") >= ARTICLES) & (2 * F.col("n") > F.col("articles")))
    return settled(often.groupBy("host").agg(F.collect_list("run").alias("runs")), "frequent"), open_hosts


def without_runs(words: list[str], runs: np.ndarray) -> list[str]:
    """The words of an article that lie in none of the runs; all of them if those cover over half."""
    hashes = _hashes([words])[0][: max(0, len(words) - RUN + 1)]
    at = np.flatnonzero(np.isin(hashes, runs))
    gone = A.covered(at, at + RUN, len(words))
    if 2 * int(gone.sum()) > len(words):
        return words
    return [w for w, x in zip(words, gone.tolist(), strict=True) if not x]


def _cut_articles(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """(id, url, text, open): the marked text of every page, without its host's frequent runs."""
    kind = rows.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, opened = [], []
            for page, runs in zip(batch.column("html").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                words, tokens = read_page(page or "")
                opened.append(_is_open(words, tokens))
                texts.append(" ".join(without_runs(words, np.array(runs, np.int64)) if runs else words))
            out = [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(opened, pa.bool_())]
            yield pa.RecordBatch.from_arrays(out, ["id", "url", "text", "open"])

    if frequent.isEmpty():
        beside = rows.withColumn("runs", F.lit(None).cast("array<long>"))
    else:
        beside = rows.join(frequent, "host", "left")
    return beside.select("id", "url", "html", "runs").mapInArrow(read, f"id {kind}, url string, text string, open boolean")


def main_text(
    df: DataFrame, key: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """(id, url, text) for every row of ``df``.

    Character references are decoded, white space is one blank within and between blocks. A null
    or empty page has an empty text; a page without a host belongs to the host without a name;
    an empty table gives an empty one; other columns are not looked at. Pages that repeat are read
    alike and count as one page. So that near copies are not boilerplate of each other, only pages
    that mark an article, or of whose open words one in OWN at least lies in no run that PAGES
    pages share, make a run boilerplate. An article of which frequent runs cover over half is a near
    copy and stays whole. Pages are read again rather than written; the words of each task's distinct
    articles are shuffled once, and the pages of hosts with one that marks no article.
    """
    rows = df.select(
        F.col(f"`{key}`").alias("id"), F.col(f"`{url}`").alias("url"), F.col(f"`{page}`").alias("html")
    )
    rows = rows.withColumn("host", host_of(F.col("url")))
    frequent, open_hosts = article_runs(rows)
    marked = _cut_articles(rows, frequent).where("not open").select("id", "url", "text")
    if open_hosts.isEmpty():
        return marked
    kind = rows.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                texts, streams, digests, opened = [], [], [], []
                for html_text in part.column("html").to_pylist():
                    words, tokens = read_page(html_text or "")
                    opened.append(_is_open(words, tokens))
                    texts.append(" ".join(words))
                    streams.append(" ".join(tokens))
                    digests.append(_digest(f"{texts[-1]}\n{streams[-1]}"))
                out = [*(part.column(c) for c in ("id", "url", "host")), pa.array(texts, pa.string()), pa.array(streams, pa.string())]
                out += [pa.array(digests, pa.binary()), pa.array(opened, pa.bool_())]
                yield pa.RecordBatch.from_arrays(out, ["id", "url", "host", "text", "stream", "digest", "open"])

    schema = f"id {kind}, url string, host string, text string, stream string, digest binary, open boolean"
    known = settled(rows.join(open_hosts, "host", "left_semi").select("id", "url", "host", "html").mapInArrow(read, schema), "pages")
    unmarked = known.where("open")
    # One row for each distinct page of a host; its copies are never in two sites.
    hosts = known.select("host", "digest").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    hosts = settled(hosts, "hosts").withColumn("parts", F.ceil(F.col("n") / SITE_PAGES))
    groups = max(1, -(-hosts.agg(F.sum("n")).first()[0] // GROUP_PAGES))
    large = hosts.where("parts > 1").select("host", "parts")
    distinct = known.groupBy("host", "digest").agg(
        F.first("stream").alias("stream"), F.first(F.col("text") != "").alias("marked"), F.first("open").alias("open")
    )
    distinct = distinct.join(large, "host", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("digest"), "parts")
    distinct = distinct.withColumn("site", F.xxhash64("host", part)).withColumn("whole", F.col("parts") == 1)
    distinct = distinct.withColumn("group", F.pmod("site", F.lit(groups))).withColumn("host_hash", F.xxhash64("host"))
    distinct = settled(distinct.drop("parts"), "distinct")
    counts = "group long, host_hash long, site long, run long, n long"

    def told(group: pd.DataFrame, first: np.ndarray, run: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        """Rows of counted runs; ``first`` has a stream that each stands in."""
        row = group.iloc[first]
        return pd.DataFrame(
            {c: row[c].to_numpy() for c in ("group", "host_hash", "site")} | {"run": run, "n": n}
        )

    def count(group: pd.DataFrame) -> pd.DataFrame:
        """Distinct pages of each run of a site; of a host in one site only the shared runs."""
        streams = _streams(group)
        none = np.zeros(0, np.int64)
        if not any(streams):
            return told(group, none, none, none)
        sites = np.unique(group["site"].to_numpy(), return_inverse=True)[1]
        at, index, page, _, _ = _runs(streams, sites, RUN)
        n = _spread(index, page, len(streams))
        _, one = np.unique(index, return_index=True)
        wanted = (n >= PAGES) | ~group["whole"].to_numpy()[page[one]]
        one = one[wanted]
        return told(group, page[one], _hashes(streams)[0][at[one]], n[wanted])

    def count_own(key: tuple, group: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        """Of the shared runs, the distinct pages with text of their own."""
        if group.empty:
            return told(group, *[np.zeros(0, np.int64)] * 3)
        streams, _, run, page, flags = _shared(group, shared)
        own = group["marked"].to_numpy().copy()
        for k, (stream, gone) in enumerate(zip(streams, flags, strict=True)):
            left = [not x for w, x in zip(stream, gone.tolist(), strict=True) if w[:1] == OPEN]
            own[k] |= OWN * sum(left) >= len(left)
        held = pd.DataFrame({"page": page, "run": run})[own[page]].drop_duplicates()
        held["site"] = group["site"].to_numpy()[held["page"]]
        total = held.groupby(["site", "run"], as_index=False).agg(n=("page", "size"), first=("page", "min"))
        return told(group, *(total[c].to_numpy(np.int64) for c in ("first", "run", "n")))

    def spread(counted: DataFrame) -> DataFrame:
        """The runs that PAGES distinct pages share, for each site that has them."""
        counted = settled(counted, "runs")
        enough = counted.groupBy("host_hash", "run").agg(F.sum("n").alias("total")).where(F.col("total") >= PAGES)
        return counted.join(enough.drop("total"), ["host_hash", "run"], "left_semi").select("group", "site", "run")

    def finish(key: tuple, group: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        group = group[group["open"]] if len(group) else group
        if group.empty:
            return pd.DataFrame({"host": [], "digest": [], "text": []}, dtype=object)
        streams, _, _, _, flags = _shared(group, shared)
        texts = [
            " ".join(w[1:] for w, x in zip(stream, gone.tolist(), strict=True) if w[:1] == OPEN and not x)
            for stream, gone in zip(streams, flags, strict=True)
        ]
        return pd.DataFrame({"host": group["host"], "digest": group["digest"], "text": texts})

    grouped = distinct.groupBy("group")
    shared = spread(grouped.applyInPandas(count, counts))
    shared = spread(grouped.cogroup(shared.groupBy("group")).applyInPandas(count_own, counts))
    texts = grouped.cogroup(shared.groupBy("group")).applyInPandas(finish, "host string, digest binary, text string")
    texts = settled(texts, "texts")
    opened = unmarked.select("id", "url", "host", "digest").join(texts, ["host", "digest"])
    return marked.unionByName(opened.select("id", "url", "text"))
