"""Main text of web pages: differencing against the page with the nearest URL of the same host."""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsreports.llm.common import in_order, settle

# Element names of HTML, and words that name page furniture in classes, ids and roles.
RAW = "script|style|noscript|template|iframe|textarea|svg|math|object|title|select"
FURNITURE_TAGS = frozenset("nav header footer aside form button dialog menu head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies "
    "disqus footer header masthead menu modal nav navbar navigation newsletter notice notices notification popup promo promotion related replies "
    "search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?![\w:-])(?:(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+(?=>)|[^>]*)(?:(?<=/)>|>.*?(?:</(?P=raw)\s*>|\Z))|<[!?][^>]*>|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
WORD = re.compile(r"[a-z]+")
#: Class tokens that tell what an element has, not what it is.
HAS = re.compile(r"(?:has|with|no|without)[-_]")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Where a line stands: in furniture, in a marked article, elsewhere.
FURNITURE, ARTICLE, OTHER = 0, 1, 2


#: How an element is furniture: not, by part of a name (search-page), by a whole name (search), by its element or as hidden.
NOT, PART, NAMED, SURE = 0, 1, 2, 3


def _furniture(tag: str, rest: str, in_article: bool) -> int:
    if tag in FURNITURE_TAGS and not (tag == "header" and in_article):
        return SURE
    if tag in ("html", "body", "main", "article") and not in_article:
        return NOT
    out = NOT
    for name, value in ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return SURE
        if name not in ("class", "id", "role") or name == "id" and in_article and tag in HEADINGS:
            continue
        whole = name == "id" and in_article and tag == "section"
        for token in value.split():
            if token in FURNITURE_WORDS:
                out = NAMED
            elif not whole and not HAS.match(token) and any(w in FURNITURE_WORDS for w in WORD.findall(token)):
                out = max(out, PART)
    return out


def lines_of(source: str | None) -> list[tuple[str, int]]:
    """The page's text lines, one per block, and where each stands. Character references are decoded, white space is one space.

    A main element, or an article of no furniture class, may stand in a div or section that is furniture by its class or id only (for an article:
    by part of it). If no other is marked, those under the fewest such elements are the article, unless more text stands outside furniture.
    """
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int, bool, int, bool]] = []  # tag, furniture, in an article, furniture elements so far, any article
    parts: list[str] = []

    def place() -> int:
        if stack and stack[-1][1]:
            return FURNITURE
        return (OTHER + stack[-1][3] if stack[-1][3] else ARTICLE) if stack and stack[-1][2] else OTHER

    def end_line() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append((text, place()))

    at, source = 0, source or ""
    for m in TOKEN.finditer(source):
        parts.append(source[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
        if tag in INLINE and not (stack and stack[-1][0] == tag and m["close"]) and not _furniture(tag, m["rest"] or "", False):
            continue
        end_line()
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in VOID or m["rest"].endswith("/"):
            continue
        if tag in ("article", "main") and stack and stack[-1][0] in ("nav", "header", "footer", "aside"):
            stack.pop()  # left open by mistake
        if stack and stack[-1][0] == "p" or stack and stack[-1][0] == tag == "li":
            stack.pop()
        above = stack[-1] if stack else ("", NOT, False, 0, False)
        own, marks = _furniture(tag, m["rest"], above[2]), tag in ("article", "main")
        off, doubtful = max(above[1], own), above[3] + (own != NOT)
        if marks and above[1] and not above[4] and above[1] <= (NAMED if tag == "main" else PART) and _furniture(tag, m["rest"], True) <= PART:
            off, doubtful = NOT, above[3]
        stack.append((tag, off, (above[2] or marks) and not off, doubtful, above[4] or marks))
    parts.append(source[at:])
    end_line()
    least = min((p for _, p in out if p > OTHER), default=0)
    size = lambda place: sum(len(t) for t, p in out if p == place)
    if least and (any(p == ARTICLE for _, p in out) or size(least) < size(OTHER)):
        least = 0
    return [(t, p if p <= OTHER else ARTICLE if p == least else FURNITURE) for t, p in out]


def shared_lines(a: list, b: list) -> list[bool]:
    """Which lines of ``a`` are in a longest common subsequence of both: matches by descending place, then a longest rising run."""
    places: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    tails: list[int] = []
    ends: list[tuple] = []
    for i, line in enumerate(a):
        for j in places.get(line, ()):
            k = bisect_left(tails, j)
            step = (i, ends[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                ends.append(step)
            else:
                tails[k], ends[k] = j, step
    out, step = [False] * len(a), ends[-1] if ends else None
    while step:
        out[step[0]] = True
        step = step[1]
    return out


def digest(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode(errors="replace"), digest_size=8).digest(), "little", signed=True)


def main_text(lines: list[tuple[str, int]], other: list[int] | None, copy_share: float = 0.9) -> tuple[str, int]:
    """The main text, and how many lines outside a marked article the other page shares, by its lines' digests.

    Furniture goes. The lines of a marked article stay. Of the others, those that are also in the other page go. Without a marked article
    this decides alone; unless the shared lines are more than ``copy_share`` of what would be left: then the pages are
    copies of each other, and nothing is told. Next to a marked article all other lines go.
    """
    marked = any(p == ARTICLE for _, p in lines)
    shared = shared_lines([digest(t) for t, _ in lines], other) if other else [False] * len(lines)
    gone = [s and p != ARTICLE for s, (_, p) in zip(shared, lines, strict=True)]
    if marked:
        return "\n".join(t for t, p in lines if p == ARTICLE), sum(gone)
    wanted = sum(len(t) for t, p in lines if p == OTHER)
    if sum(len(t) for g, (t, p) in zip(gone, lines, strict=True) if g and p == OTHER) > copy_share * wanted:
        gone = [False] * len(lines)
    return "\n".join(t for g, (t, p) in zip(gone, lines, strict=True) if p == OTHER and not g), sum(gone)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (id, url, text, nearest, n_shared): each page's main text, the page it was compared with, and the lines that both have.

    Pages of a host are ordered by path; the nearer of a page's two neighbours, by edit distance of their URLs, is its partner (ties: the
    one before it). Hosts may be of any size: only ids and URLs are ordered, in slices. Partners travel as the digests
    of their lines.

    Null or empty html: empty text. Null or hostless URLs and null ids: no partner. Rows that repeat an id each get their own text; as
    partners they are one, of the smallest list of digests. Lone pages of a host have no partner. An empty table gives no rows;
    other columns are ignored.
    """
    kind = df.schema[id_col].dataType.simpleString()
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [[digest(t) for t, _ in lines_of(h)] for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.int64()))], names=["id", "url", "lines"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [main_text(lines_of(own), other) for own, other in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())],
                names=["id", "url", "nearest", "text", "n_shared"],
            )

    parsed = settle(pages.where("id IS NOT NULL").mapInArrow(parse, f"id {kind}, url string, lines array<long>"), "lines")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    slim = parsed.where("url IS NOT NULL").select("id", "url", host.alias("host"), path.alias("path")).where("host <> ''").dropDuplicates(["id"])
    ordered = settle(in_order(slim, ["path"], within=["host"], take=["id", "url"]), "neighbours").where("next_id IS NOT NULL")
    gap = F.levenshtein("url", "next_url")
    both = ordered.select("id", F.col("next_id").alias("other"), gap.alias("gap"), F.lit(1).alias("after")).union(
        ordered.select("next_id", "id", gap, F.lit(0))
    )
    nearest = both.groupBy("id").agg(F.min(F.struct("gap", "after", "other")).alias("n")).select("id", F.col("n.other").alias("nearest"))
    partners = parsed.groupBy(F.col("id").alias("nearest")).agg(F.min("lines").alias("theirs"))
    compared = nearest.join(partners, "nearest")
    joined = pages.join(compared, "id", "left").select("id", "url", "nearest", "html", "theirs")
    return joined.mapInArrow(decide, f"id {kind}, url string, nearest {kind}, text string, n_shared long").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "nearest", "n_shared"
    )
