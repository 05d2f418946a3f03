"""Main text of pages: markup says what may be main text, host suffix arrays which of it is the site's and not the page's."""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawldelta.llm.scratch import BROADCAST_ROWS, keys_for_join, new_folder, ship_code, stored

#: A run of this many tokens on two distinct pages of a host is boilerplate.
LEAST_TOKENS = 8

#: Tokens of one suffix array; the streams of a larger host are dealt out by page.
SEGMENT_TOKENS = 2_000_000

#: Within marked articles, a run on more than half of a host's pages and in more than half of its distinct articles is the
#: site's; hosts of fewer distinct articles tell nothing.
SITE_ARTICLES = 10

#: So many articles of a host that are read together have a suffix array there; fewer are sent to the host's others.
TOGETHER = 50

#: Marked articles of one suffix array.
SEGMENT_ARTICLES = 500

# ---------------------------------------------------------------- blocks of a page

#: Elements whose text is never main text, raw-text elements,
#: elements without content, and elements within a line.
DROPPED = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "svg", "iframe", "object", "template", "canvas", "head"}
RAW = {"script", "style", "noscript", "textarea", "title", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: Roles and name parts of elements that are not main text.
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "form", "menu", "menubar"}
NAME_PARTS = (
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead ad ads advert advertisement advertising banner "
    "sponsor sponsored promo cookie cookies consent gdpr notice alert popup modal newsletter subscribe signup share sharing social "
    "comment comments commentlist respond replies reply related recommended widget toolbar skip pagination pager"
).split()
#: What a name may add without telling of anything else; within an article only names of nothing but these words count.
NEUTRAL_PARTS = (
    "area articles bar block body bottom box button buttons container content form group holder icons inner item items left links list "
    "news outer panel posts right row section slot stories thread title top unit user users view wrap wrapper"
).split()
NAMES = re.compile(rf"(?:^|[\s_-])(?:{'|'.join(NAME_PARTS)})(?:$|[\s_-])", re.IGNORECASE)
#: What such names do not stand for: the rest of a name after one of these words tells of something elsewhere.
_MODIFIED = re.compile(r"(?:^|(?<=[\s_-]))(?:has|no|with|without)[_-]\S*", re.IGNORECASE)
#: A quote opens a value only after an equals sign; elsewhere it is a sign like any other.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>]++)?+)*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTR = re.compile(r"([^\s=/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s>]*+)))?+|[=/\s>]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
#: An opening element of these closes an open p; li, dt, dd, tr, td, th and option close their own kind.
_CLOSES_P = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "div", "ul", "ol", "dl", "table", "section", "article", "blockquote", "pre", "figure", "main", "hr"}
_CLOSES_OWN = {"li", "dt", "dd", "tr", "td", "th", "option"}


def attributes(attrs: str) -> dict[str, str]:
    """The attributes of a tag, names in lower case, values decoded; of a repeated name the first counts."""
    of: dict[str, str] = {}
    for m in _ATTR.finditer(attrs):
        if m[1]:
            of.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return of


def _named(value: str, within: bool) -> bool:
    """Does a class or id name say that this is no main text? Within an article, only if it says nothing else."""
    plain = _MODIFIED.sub(" ", value)
    if not within or not NAMES.search(plain):
        return bool(NAMES.search(plain))
    tokens = [set(re.split(r"[_-]+", t.lower())) - {""} for t in plain.split()]
    return any(t & set(NAME_PARTS) and t <= {*NAME_PARTS, *NEUTRAL_PARTS} for t in tokens)


def _aside(name: str, of: dict[str, str], within: bool) -> str:
    """Why an element is not main text: `kind` (its name, its role, or hidden), `named` (class or id), or empty."""
    if name in DROPPED:
        return "kind"
    hidden = "hidden" in of or of.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(of.get("style", "")) is not None
    if hidden or of.get("role", "").lower() in ROLES:
        return "kind"
    named = name not in ("html", "body", "article", "main") and any(_named(of.get(k, ""), within) for k in ("class", "id"))
    return "named" if named else ""


@dataclass
class Page:
    """Blocks of text in page order: those of the article, and those whose role markup leaves open."""

    article: list[str] = field(default_factory=list)
    open_blocks: list[str] = field(default_factory=list)
    has_article: bool = False


def read_page(source: str | None) -> Page:
    """Cut a page into blocks. White space within a block becomes one space; empty blocks are left out.

    What an element is by its kind is final. A class or id name only says what
    its element holds outside articles: article, main and role main within it
    are read as such, as the name may belong to a wrapper around them. Of
    several articles those within the fewest such names count (comments and
    teasers are often articles too), likewise of main elements. Where these
    are within a name while there is text outside, both are left open.
    """
    page, text = Page(), source or ""
    stack: list[tuple[str, str, tuple[str, int] | None]] = []  # name, why set aside, what was in force before
    opened: Counter[str] = Counter()  # open elements by name: an end tag of none costs nothing
    aside = names = 0  # elements around that are set aside by kind, and by class or id
    # The innermost article or main element, and the names around it.
    inner: tuple[str, int] | None = None
    parts: list[str] = []
    blocks: list[tuple[str, tuple[str, int] | None]] = []

    def close_block() -> None:
        if parts:
            words = " ".join("".join(parts).split())
            parts.clear()
            if words:
                blocks.append((words, inner))

    def pop_to(depth: int) -> None:
        nonlocal aside, names, inner
        while len(stack) > depth:
            name, why, inner = stack.pop()
            opened[name] -= 1
            aside -= why == "kind"
            names -= why == "named"

    def said(raw: str) -> None:
        if not aside and names == (inner[1] if inner else 0) and raw:
            parts.append(html.unescape(raw))

    at = 0
    while at < len(text):
        m = _TAG.search(text, at)
        if m is None:
            said(text[at:])
            break
        said(text[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name, closing = m[2].lower(), m[1] == "/"
        if not closing and name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE).search(text, at)
            at = end.end() if end else len(text)
            continue
        if name in INLINE and not (name == "span" and "=" in m[3] and _aside(name, attributes(m[3]), inner is not None)):
            continue  # an inline element is only a boundary where it is set aside, like a hidden span
        close_block()
        if closing:
            if opened[name]:
                pop_to(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            continue
        if name in VOID:
            continue
        if name in _CLOSES_P and stack and stack[-1][0] == "p" or name in _CLOSES_OWN and stack and stack[-1][0] == name:
            pop_to(len(stack) - 1)
        of = attributes(m[3])
        why = _aside(name, of, inner is not None)
        is_main = why != "kind" and not aside and (name in ("article", "main") or of.get("role", "").lower() == "main")
        if is_main:
            why = ""
            page.has_article = page.has_article or not names
        stack.append((name, why, inner))
        opened[name] += 1
        aside += why == "kind"
        names += why == "named"
        if is_main:
            inner = ("article" if name == "article" else "main", names)
    close_block()
    least: dict[str, int] = {}
    for _, within in blocks:
        if within:
            least[within[0]] = min(within[1], least.get(within[0], within[1]))
    told = [(words, within) for words, within in blocks if within is None or within[1] == least[within[0]]]
    page.has_article = page.has_article or bool(least) and all(within for _, within in told)
    for words, within in told:
        (page.article if within and page.has_article else page.open_blocks).append(words)
    return page


# ---------------------------------------------------------------- the suffix array


def suffix_ranks(tokens: np.ndarray, least: int) -> np.ndarray:
    """Rank of each suffix by its first tokens, `least` or up to twice as many, by doubling; equal beginnings share a rank.

    Sorted by rank, the suffixes are the suffix array as far as it is needed:
    suffixes with a common run of that length are neighbours.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    length = 1
    while length < least:
        step = min(length, least - length)
        then = np.full(len(rank), -1, np.int64)
        then[:-step] = rank[step:]
        rank = np.unique(rank * (len(rank) + 1) + then + 1, return_inverse=True)[1].astype(np.int64)
        length += step
    return rank


def _buckets(streams: Iterable[list[str]], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, stream, position) of every run of `least` tokens, in the order of the suffix array, one for each bucket and stream.

    A bucket is a group of suffixes with the same first tokens. A stream's
    later suffixes of one bucket are found again by the run itself.
    """
    codes: dict[str, int] = {}
    parts = []
    for i, s in enumerate(streams):
        # A separator of its own after each stream: no run goes on into the next page.
        parts.append(np.fromiter((*[codes.setdefault(t, len(codes)) for t in s], -1 - i), np.int64, len(s) + 1))
    lengths = np.array([len(p) for p in parts], np.int64)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(parts)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    rank = suffix_ranks(flat, least)
    inside = np.flatnonzero(place + least < lengths[owner])
    array = inside[np.argsort(rank[inside] * (len(parts) + 1) + owner[inside], kind="stable")]
    fresh = np.ones(len(array), bool)
    fresh[1:] = (rank[array[1:]] != rank[array[:-1]]) | (owner[array[1:]] != owner[array[:-1]])
    array = array[fresh]
    return rank[array], owner[array], place[array]


def repeated_runs(streams: list[list[str]], least: int) -> Iterator[tuple[int, int, str]]:
    """(stream, position, run) of every run of `least` tokens, one representative for each suffix-array bucket and stream."""
    _, owner, place = _buckets(streams, least)
    for i, low in zip(owner.tolist(), place.tolist()):
        yield i, low, " ".join(streams[i][low : low + least])


def common_runs(texts: list[str], least: int) -> list[str]:
    """The runs of `least` tokens that more than half of the texts hold."""
    bucket, owner, place = _buckets((t.split(" ") for t in texts), least)
    begins = np.flatnonzero(np.diff(bucket, prepend=-1))
    often = begins[2 * np.diff(begins, append=len(bucket)) > len(texts)]
    return [" ".join(texts[i].split(" ")[low : low + least]) for i, low in zip(owner[often].tolist(), place[often].tolist())]


def run_key(run: str) -> bytes:
    """128 bits that stand for a run where it is shuffled."""
    return hashlib.md5(run.encode(), usedforsecurity=False).digest()


def covered(tokens: list[str], runs: set[bytes], least: int) -> np.ndarray:
    """True for every token within a run of one of the keys."""
    mark = np.zeros(len(tokens) + 1, np.int64)
    for i in range(len(tokens) - least + 1):
        if run_key(" ".join(tokens[i : i + least])) in runs:
            mark[i] += 1
            mark[min(len(tokens), i + least)] -= 1
    return np.cumsum(mark)[:-1] > 0


# ---------------------------------------------------------------- Spark


def host(url: str) -> Column:
    """Host of an address in lower case; no host gives an empty one."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


#: The blocks of `article` are lines: white space within a block is a space. `common` has the runs found among the articles
#: read together, in one row for all of them; articles that are `apart` are of a host that has few there.
_READ = (
    "page_id long, url string, host string, page_key string, has_article boolean, article string, open_blocks array<string>, "
    "common array<binary>, apart boolean"
)


def _common_keys(articles: list[str], least: int) -> list[bytes]:
    return list(map(run_key, common_runs([a.replace("\n", " ") for a in articles], least)))


def _read_pages(least: int, segment_tokens: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pages = [read_page(h) for h in pdf.pop("html")]
            articles = ["\n".join(p.article) for p in pages]
            common: list[list[bytes]] = [[] for _ in pages]
            apart = np.array([p.has_article for p in pages], bool)
            for own in pdf["host"].groupby(pdf["host"].to_numpy()).indices.values():
                own = own[apart[own]]
                if len(own) < TOGETHER:
                    continue
                apart[own] = False
                tokens = sum(articles[i].count(" ") + articles[i].count("\n") + 1 for i in own)
                for some in np.array_split(own, max(-(-len(own) // SEGMENT_ARTICLES), min(len(own), -(-tokens // segment_tokens)))):
                    common[some[0]] = _common_keys([articles[i] for i in some], least)
            columns = {"has_article": [p.has_article for p in pages], "article": articles, "open_blocks": [p.open_blocks for p in pages]}
            yield pdf.assign(**columns, common=common, apart=apart)

    return read


def extract(pages: DataFrame, least: int = LEAST_TOKENS, segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """Per page: page_id, url, text. The whole html is read; null counts as empty.

    Where a page marks its article (article, main, role main), its text is the
    article's blocks but those that are the site's: blocks within runs of
    `least` tokens that more than half of the host's marked pages and more than
    half of their distinct articles hold, as notices and adverts without a name
    of their own do. Where these are more than half of an article it is a copy
    with changes, and stays whole.
    Elsewhere every block that markup does not set aside goes into the stream of
    its host; runs of `least` tokens or more that two distinct pages share are
    boilerplate and go, and the unique runs stay, joined in page order. Blocks
    outside an article take part in the streams as evidence. Pages are distinct
    by url and html, so a repeated row is no second page. Pages without a host
    share one; a null url is kept as null; extra columns are ignored.
    """
    ship_code(pages.sparkSession)
    keyed = pages.select(
        "page_id",
        "url",
        host("url").alias("host"),
        F.sha2(F.concat_ws("\n", F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))).cast("binary"), 256).alias("page_key"),
        "html",
    )
    # Each page is parsed once. Its open blocks are few where the article is marked, the whole page where it is not.
    folder = new_folder(pages.sparkSession, "parsed")
    keyed.mapInPandas(_read_pages(least, segment_tokens), _READ).write.option("compression", "zstd").parquet(folder)
    parsed = pages.sparkSession.read.schema(_READ).parquet(folder)
    articles = parsed.where("has_article").withColumn("article_key", F.md5("article")).drop("has_article", "page_key", "open_blocks")
    marked = _without_site_blocks(articles, _site_runs(articles, least, segment_tokens), least)
    opened = parsed.where("size(open_blocks) > 0 or not has_article").drop("article", "common", "apart")
    unmarked = opened.where("not has_article")
    if unmarked.isEmpty():
        return marked
    cleaned = _without_runs(unmarked, _boilerplate(opened, least, segment_tokens), least)
    return marked.unionByName(cleaned)


def _site_runs(articles: DataFrame, least: int, segment_tokens: int) -> DataFrame:
    """Stored (host, run): the keys of runs of tokens on more than half of a host's marked pages and in more than half of their articles.

    Suffix arrays of bounded size are built where enough of a host's articles
    are read together; the others are dealt out by text into segments with a
    suffix array each. What more than half of all pages hold, more than half of
    some array's pages hold: only such runs go on, and are then counted over all
    of the host's articles.
    """
    tokens = F.length("article") - F.length(F.translate("article", " \n", "")) + 1
    apart = articles.where("apart").select("host", "article_key", "article")
    sized = articles.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if("apart").alias("n"), F.sum(F.when(F.col("apart"), tokens)).alias("tokens")
    )
    parts = F.ceil(F.greatest(F.col("n") / SEGMENT_ARTICLES, F.col("tokens") / segment_tokens)).cast("int")
    sized = stored(sized.where((F.col("pages") >= SITE_ARTICLES) & (F.col("n") > 0)).select("host", parts.alias("parts")), "hosts")
    dealt = apart.join(keys_for_join(sized), "host").withColumn("segment", F.pmod(F.xxhash64("article_key"), "parts"))

    def common(pdf: pd.DataFrame) -> pd.DataFrame:
        found = pd.DataFrame({"run": _common_keys(pdf["article"].tolist(), least)}, dtype=object)
        return found.assign(host=pdf["host"].iloc[0])[["host", "run"]]

    local = dealt.select("host", "segment", "article").groupBy("host", "segment").applyInPandas(common, "host string, run binary")
    asked = stored(local.unionByName(articles.select("host", F.explode("common").alias("run"))).distinct(), "asked")

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, key, article, runs in zip(pdf["host"], pdf["article_key"], pdf["article"], pdf["runs"]):
                tokens = re.split("[ \n]", article)
                own = {run_key(" ".join(tokens[i : i + least])) for i in range(len(tokens) - least + 1)}
                rows += [(name, key, run) for run in (None, *own.intersection(map(bytes, runs)))]
            yield pd.DataFrame(rows, columns=["host", "article_key", "run"])

    # The rows without a run count the host's articles.
    found = _with_runs(articles, asked).select("host", "article_key", "article", "runs").mapInPandas(held, "host string, article_key string, run binary")
    counts = stored(found.groupBy("host", "run").agg(F.count(F.lit(1)).alias("pages"), F.count_distinct("article_key").alias("articles")), "counts")
    of = counts.where("run is null").select("host", F.col("pages").alias("all_pages"), F.col("articles").alias("all_articles"))
    most = (F.col("all_articles") >= SITE_ARTICLES) & (2 * F.col("pages") > F.col("all_pages")) & (2 * F.col("articles") > F.col("all_articles"))
    return stored(counts.where("run is not null").join(of, "host").where(most).select("host", "run"), "site")


def _with_runs(articles: DataFrame, runs: DataFrame) -> DataFrame:
    """The articles of the hosts of stored (host, run), with their host's runs."""
    listed = runs.groupBy("host").agg(F.collect_list("run").alias("runs"))
    return articles.join(F.broadcast(listed) if runs.count() <= BROADCAST_ROWS else listed, "host")


def _without_site_blocks(articles: DataFrame, runs: DataFrame, least: int) -> DataFrame:
    """The articles without the blocks that lie within runs of their host; those that are more than half of such blocks stay whole."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = []
            for article, found in zip(pdf["article"], pdf["runs"]):
                blocks = [b.split(" ") for b in article.split("\n")]
                gone = covered([t for b in blocks for t in b], set(map(bytes, found)), least)
                ends = np.cumsum([len(b) for b in blocks]).tolist()
                own = [b for b, end in zip(blocks, ends) if not gone[end - len(b) : end].all()]
                texts.append(" ".join(" ".join(b) for b in (own if 2 * sum(map(len, own)) >= ends[-1] else blocks)))
            yield pdf[["page_id", "url"]].assign(text=texts)

    plain = articles.join(keys_for_join(runs.select("host").distinct()), "host", "left_anti")
    plain = plain.select("page_id", "url", F.translate("article", "\n", " ").alias("text"))
    cut = _with_runs(articles, runs).select("page_id", "url", "article", "runs").mapInPandas(keep, "page_id long, url string, text string")
    return plain.unionByName(cut)


def _boilerplate(opened: DataFrame, least: int, segment_tokens: int) -> DataFrame:
    """Stored (host, run): the keys of runs of tokens on two distinct pages of a host that has an unmarked page.

    A host's streams are dealt out by page into segments of bounded size, each
    with a suffix array of its own; the runs' first and last page are then
    brought together over the segments.
    """
    tokens = F.size(F.split(F.array_join("open_blocks", " "), " "))
    sized = opened.groupBy("host").agg(F.sum(tokens).alias("tokens"), F.bool_or(~F.col("has_article")).alias("asks"))
    sized = stored(sized.where("asks").select("host", F.ceil(F.col("tokens") / segment_tokens).cast("int").alias("parts")), "hosts")
    dealt = opened.join(sized, "host").withColumn("segment", F.pmod(F.xxhash64("page_key"), F.greatest("parts", F.lit(1))))

    def runs(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("page_key")
        streams = [" ".join(b).split(" ") for b in pdf["open_blocks"]]
        keys = pdf["page_key"].tolist()
        rows = [(run_key(run), keys[i]) for i, _, run in repeated_runs(streams, least)]
        found = pd.DataFrame(rows, columns=["run", "page_key"]).groupby("run")["page_key"].agg(first="min", last="max").reset_index()
        if pdf["parts"].iloc[0] <= 1:  # the host has no other segment where the run may be on another page
            found = found[found["first"] != found["last"]]
        return found.assign(host=pdf["host"].iloc[0])[["host", "run", "first", "last"]]

    local = dealt.select("host", "segment", "parts", "page_key", "open_blocks").groupBy("host", "segment").applyInPandas(
        runs, "host string, run binary, first string, last string"
    )
    over = local.groupBy("host", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return stored(over.where("first <> last").select("host", "run"), "runs")


def _without_runs(unmarked: DataFrame, runs: DataFrame, least: int) -> DataFrame:
    """The pages' open blocks without covered tokens."""
    blocks = F.transform("open_blocks", lambda b: F.split(b, " "))
    rows = unmarked.select(F.monotonically_increasing_id().alias("row_id"), "page_id", "url", "host", F.flatten(blocks).alias("tokens"))
    rows = stored(rows, "streams")
    windows = F.transform(
        F.when(F.size("tokens") >= least, F.sequence(F.lit(0), F.size("tokens") - least)).otherwise(F.array().cast("array<int>")),
        lambda i: F.unhex(F.md5(F.array_join(F.slice("tokens", i + 1, F.lit(least)), " ").cast("binary"))),
    )
    asked = rows.select("row_id", "host", F.explode(F.array_distinct(windows)).alias("run"))
    hits = asked.join(runs, ["host", "run"]).groupBy("row_id").agg(F.collect_list("run").alias("runs"))

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = []
            for tokens, found in zip(pdf["tokens"], pdf["runs"]):
                tokens = list(tokens)
                gone = covered(tokens, set(map(bytes, found)) if found is not None else set(), least)
                texts.append(" ".join(t for t, g in zip(tokens, gone) if not g).strip())
            yield pdf[["page_id", "url"]].assign(text=texts)

    return rows.join(hits, "row_id", "left").select("page_id", "url", "tokens", "runs").mapInPandas(keep, "page_id long, url string, text string")
