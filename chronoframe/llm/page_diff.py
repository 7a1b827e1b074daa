"""Main text of web pages: structure of the page, and differencing against the page of the nearest URL.

A page's markup is read into text lines, one for each block.  Pages are put in the order of host and path over
the cluster; each page is paired with the neighbour of its host whose path shares the longer prefix, both pages'
lines are aligned by a longest common subsequence, and shared lines count as template.  A neighbour that shares almost all of
a page's characters is a copy of it and not its partner; a page between two copies shares nothing.

On this data differencing alone cannot give right results: menus, adverts and footers differ on every page,
while copies of one article stand under neighbouring URLs.  So menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments go by their elements, classes and roles
when lines are read.  Differencing then takes the shared lines of every page as template, and a check by markup gives back those
that stand in the ``article`` (else ``main``) element of both pages: passages that two articles have in common.  A line of the
article that its partner holds outside its own goes.  Lines outside the article of a page that marks one go as well.

Rows: a null or empty html gives the empty text; a null url belongs to the empty host; a page alone on its host shares nothing;
repeated rows are copies of each other; null ids sort first; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .common import block_of, deal_blocks

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>\"[^\"]*\"|'[^']*'|[^>\"'])*+)>", re.S)
HINT = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PARTS = re.compile(r"[^a-z0-9]+")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math".split())
GONE = frozenset("nav footer aside form button select dialog menu object video audio canvas".split())
GONE_WORDS = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr "
                       "menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related share sharing sidebar social "
                       "sponsor sponsored subscribe toolbar widget widgets".split())
HEAD_WORDS = frozenset("header masthead".split())
# Parts of a name that say where or in what shape something is, not what it is.
PLACE_WORDS = frozenset("area bar block bottom box btm center column container content footer global group header inner item items left lg list main md mobile outer "
                        "page panel primary right row secondary section site sm small sticky top wrap wrapper xl xs".split())
# Elements that are text by themselves: no name takes them away.
TEXT = frozenset("article main h1 h2 h3 h4 h5 h6 p pre blockquote html body".split())
GONE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu".split())
ARTICLE, MAIN, OTHER = 2, 1, 0
COPY = 0.95


def _names_gone(names: set[str], words: frozenset) -> bool:
    """Whether a class, or the id, consists of such words (``ad``, ``cookie-notice``), besides words of place
    (``site-menu``, ``sidebar_left``, ``ad-3``); ``has-sidebar`` and ``related-work`` are other names."""
    for name in names:
        parts = [p for p in PARTS.split(name) if p and not p.isdigit()]
        if any(p in words for p in parts) and all(p in words or p in PLACE_WORDS for p in parts):
            return True
    return False


def lines_of(page: str) -> list[tuple[str, int]]:
    """Text lines in page order with the region that holds each; dropped elements give none."""
    out: list[tuple[str, int]] = []
    buffer: list[str] = []
    article = main = 0
    seen_article = False
    skip, depth = "", 0  # name of the dropped element that is open, and how many of that name
    at = 0

    def end_block() -> None:
        if buffer:
            line = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if line:
                out.append((line, ARTICLE if article else MAIN if main else OTHER))

    while True:
        m = TAG.search(page, at)
        if not skip:
            buffer.append(page[at: m.start() if m else len(page)])
        if m is None:
            break
        at = m.end()
        if not m[2]:
            continue
        close, name, rest = m[1], m[2].lower(), m[3]
        if not close and name in RAW and not rest.endswith("/"):
            stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            continue
        hints = [] if close or "=" not in rest else HINT.findall(rest)
        names = {n for k, *v in hints for n in ("".join(v).lower().split() if k.lower() == "class" else ["".join(v).strip().lower()] if k.lower() == "id" else [])}
        roles = {"".join(v).strip().lower() for k, *v in hints if k.lower() == "role"}
        if skip:
            if not close and name in ("article", "main") and not seen_article and not _names_gone(names, GONE_WORDS):
                skip, depth = "", 0  # an element left open does not hold the article
            elif name == skip:
                depth += -1 if close else not rest.endswith("/")
                if not depth:
                    skip = ""
                continue
            else:
                continue
        if name not in INLINE:
            end_block()
        if close:
            if name == "article" and article:
                article -= 1
            elif name == "main" and main:
                main -= 1
        elif name not in VOID:
            safe = name in TEXT and not (name == "article" and article)      # a reader's comment may be an article in the article
            if name in GONE or not safe and (_names_gone(names, GONE_WORDS) or roles & GONE_ROLES) or not article and (name == "header" or not safe and _names_gone(names, HEAD_WORDS)):
                end_block()
                skip, depth = name, 1
            elif name == "article":
                article += 1
                seen_article = True
            elif name == "main":
                main += 1
    end_block()
    return out


def shared_lines(a: list[str], b: list[str]) -> list[bool]:
    """Which lines of ``a`` a longest common subsequence with ``b`` holds (bit-parallel over the lines of
    ``b`` that ``a`` has as well, which are all that can be in it)."""
    common = set(a) & set(b)
    out = [False] * len(a)
    if not common:
        return out
    rows = [i for i, x in enumerate(a) if x in common]
    masks: dict[str, int] = {}
    width = 0
    for x in b:
        if x in common:
            masks[x] = masks.get(x, 0) | 1 << width
            width += 1
    ones = (1 << width) - 1
    state, states = ones, []
    for i in rows:
        u = state & masks[a[i]]
        state = ((state + u) | (state - u)) & ones
        states.append(state)
    row, col = len(rows), width
    while row and col:
        if states[row - 1] >> (col - 1) & 1:
            col -= 1
            continue
        row -= 1
        if not row or states[row - 1] >> (col - 1) & 1:
            out[rows[row]] = True
            col -= 1
    return out


def template_lines(lines: list[tuple[str, int]], shared: list[bool], partner: list[tuple[str, int]]) -> list[bool]:
    """Which of the lines shared with the partner are template: all, but for those that the check by markup gives back.  It gives
    back a line of the page's article (or main element) that the partner holds in its own as well, or whose partner marks neither."""
    best, theirs = (max((r for _, r in page), default=OTHER) for page in (lines, partner))
    if best == OTHER:
        return shared
    content = {x for x, r in partner if r == theirs}
    return [s and not (r == best and (theirs == OTHER or x in content)) for (x, r), s in zip(lines, shared)]


def main_text(lines: list[tuple[str, int]], template: list[bool]) -> str:
    """Lines that are no template, of the article, else of the main element, else of the page."""
    best = max((r for _, r in lines), default=OTHER)
    return " ".join(x for (x, r), t in zip(lines, template) if r == best and not t)


def is_copy(lines: list[tuple[str, int]], shared: list[bool]) -> bool:
    """Whether almost all characters of a page stand in lines that it shares with another: then the other is a copy of it and
    says nothing about the template."""
    return bool(lines) and sum(len(x) for (x, _), s in zip(lines, shared) if s) >= COPY * sum(len(x) for x, _ in lines)


def prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", blocks: int | None = None) -> DataFrame:
    """``id_col, url, text, n_chars, partner_id, n_shared`` for every row; ``n_shared`` counts the lines that the page
    shares with its partner.

    Pages are dealt by cuts in the order (host, path, id), taken from a bounded sample of the keys; the pages next to a
    cut also go to the other side as context, so every page meets both its neighbours whatever the cuts.
    """
    spark = df.sparkSession
    n = blocks or 2 * shuffle_partitions(spark)
    url = F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    ident = F.col(f"`{id_col}`").cast("long")
    place = F.lpad(F.coalesce(ident, F.lit(0)).cast("string"), 20, "0")
    rows = df.select(ident.alias("_id"), F.col(f"`{url_col}`").cast("string").alias("_url"), F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("_html"),
                     host.alias("_host"), path.alias("_path"), F.concat(host, F.lit("\x01"), path, F.lit("\x01"), place).alias("_key"))
    whole, wanted = rows.count(), 64 * n
    few = F.pmod(F.xxhash64("_key"), F.lit(1 << 40)) < F.lit(int(min(1.0, 2 * wanted / max(whole, 1)) * (1 << 40)))       # some twice the wanted keys
    keys = sorted({r[0] for r in rows.where(few).select("_key").limit(4 * wanted).collect()})
    cuts = sorted({keys[k * len(keys) // n] for k in range(1, n)}) if len(keys) > n else []
    rows = rows.withColumn("_block", block_of(F.col("_key"), cuts))
    ends = rows.groupBy("_block").agg(F.min("_key").alias("lo"), F.max("_key").alias("hi")).orderBy("_block").collect()
    dealt = rows.withColumn("_own", F.lit(True))
    for edge, to in (("lo", -1), ("hi", 1)):
        move = {r["_block"]: ends[i + to]["_block"] for i, r in enumerate(ends) if 0 <= i + to < len(ends)}
        if move:
            at = F.create_map(*[F.lit(x) for kv in move.items() for x in kv])
            edges = [r[edge] for r in ends if r["_block"] in move]
            copy = rows.where(F.col("_key").isin(edges)).withColumn("_block", F.element_at(at, F.col("_block")).cast("int")).withColumn("_own", F.lit(False))
            dealt = dealt.unionByName(copy)
    dealt = deal_blocks(dealt, "_block", n).sortWithinPartitions("_block", "_key", "_own").select("_block", "_own", "_id", "_url", "_host", "_path", "_html")
    names = [id_col, "url", "text", "n_chars", "partner_id", "n_shared"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prev = cur = None
        out: list[list] = [[] for _ in names]

        def settle(nxt) -> None:
            if cur is None or not cur["own"]:
                return
            near = [p for p in (prev, nxt) if p is not None and p["block"] == cur["block"] and p["host"] == cur["host"]]
            partner, flags = None, [False] * len(cur["lines"])      # shared with nobody
            for p in sorted(near, key=lambda p: -prefix(p["path"], cur["path"])):
                f = shared_lines([x for x, _ in cur["lines"]], [x for x, _ in p["lines"]])
                if not is_copy(cur["lines"], f):
                    partner, flags = p, f
                    break
            text = main_text(cur["lines"], template_lines(cur["lines"], flags, partner["lines"]) if partner else flags)
            for c, v in zip(out, (cur["id"], cur["url"], text, len(text), partner and partner["id"], sum(flags))):
                c.append(v)

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
            for c in out:
                c.clear()
            return made

        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(6)]
            for row, (block, own, doc, url_, host_, path_) in enumerate(zip(*cols)):
                nxt = {"block": block, "own": own, "id": doc, "url": url_, "host": host_, "path": path_, "lines": lines_of(b.column(6)[row].as_py())}
                settle(nxt)
                prev, cur = cur, nxt
                if len(out[0]) >= 512:
                    yield batch()
        settle(None)
        if out[0]:
            yield batch()

    return dealt.mapInArrow(run, f"`{id_col}` long, url string, text string, n_chars long, partner_id long, n_shared long")
