"""Main text of web pages: structure first, then each host's repeated token runs.

A page is cut into blocks of text with a verdict each. Inside an article (or
the main part of a page without articles) a block is content; in navigation,
headers, footers, asides, forms, notices, adverts and comments it is not.
Blocks that the markup says nothing about are left open.

For these the host decides. All blocks outside the content, in page order, are
the page's token stream, with a separator after each block. Stretches that share
an anchor (see ``contexts``) meet by host and anchor, equal ones as one row; a
suffix array over each shard's stretches (see ``suffixes``) finds the runs of
``LENGTH`` tokens that stand on at least ``PAGES`` distinct pages of the host.
Tokens under such a run are boilerplate; an open block keeps its unique runs.
Pages with equal streams count as one page: mirrors don't make an article
boilerplate.

Defined cases: a null or empty page has the text ''; text cut off in a tag or a
reference is read as far as it goes; a null url belongs to the host ''; equal
page_ids and repeated rows are pages of their own with the same text; an empty
table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areatab.llm.common import meet, ranges_hash, slices, written
from areatab.llm.contexts import contexts
from areatab.llm.suffixes import suffix_array

#: Tokens of a repeated run, separators between blocks included, and the pages of a host that must share it.
LENGTH = 8
GRAM = 3
PAGES = 3
SHARD_TOKENS = 1 << 16

#: Elements and names that mark what a part of a page is.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
NOT_CONTENT = set("nav aside footer head button select option dialog menu svg canvas object audio video map datalist fieldset".split())
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar status form".split())
NAMES = set(
    "nav navbar navigation menu menubar submenu sidebar aside footer header masthead topbar bottombar breadcrumb breadcrumbs pagination pager "
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login "
    "comment comments disqus replies respond discussion share sharing social related recommended recommendations widget search searchbox form "
    "copyright legal skip toolbar tags toc".split()
)
CONTENT_NAMES = set("article post story entry content maincontent articlebody postcontent entrycontent storybody main".split())
#: Words that only say where or how large such a part is, or whose.
PLAIN = set(
    "area bar bars big block body bottom box btn button buttons by center col column container content desktop email facebook fixed float follow foot google group has "
    "head hide hidden icon icons image img in inline inner is item items js large latest left like link links list mail main middle mini mobile module more most native "
    "outer page panel popular post posts print right row rss section show site slot small story sticky text the third title top twitter unit wide wrap wrapper zone".split()
)
REMARKS = {"comment", "comments", "reply", "replies", "disqus"}
TOKEN = re.compile(
    r"""<!--(?P<comment>.*?)(?:--!?>|\Z)
    |<(?P<close>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+|))*+)(?P<end>>|\Z)
    |<(?P<loose>/?[a-zA-Z])(?P<rest>[^>]*)(?:>|\Z)
    |<[!?/](?P<other>[^>]*)(?:>|\Z)
    |(?P<text>[^<]+|<)""",
    re.VERBOSE | re.DOTALL,
)
ATTR = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))|([^\s=/>"']+)""")
PARTS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z0-9]+")
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

CONTENT, MAIN, OPEN, FORM, OUT = 4, 3, 2, 1, 0


@dataclass
class Element:
    tag: str
    verdict: int | None  # what it says about the text in it; None: nothing


def furniture(words: list[str]) -> bool:
    """Whether one of an element's names says that it is no content, and says nothing else."""
    for word in words:
        parts = {p.lower() for p in PARTS.findall(word) if not p.isdigit()}
        if re.sub("[-_]", "", word.lower()) in NAMES or (parts & NAMES and parts <= NAMES | PLAIN):
            return True
    return False


def verdict(tag: str, attrs: str, inside_article: bool) -> int | None:
    """What an element says about the text in it; None: nothing."""
    if tag in NOT_CONTENT or (tag == "header" and not inside_article):
        return OUT
    own = {"article": CONTENT, "main": MAIN, "form": FORM}.get(tag)
    if not attrs:
        return own
    found = {(m[1] or m[5]).lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(attrs)}
    words = [w for a in ("class", "id") for w in found.get(a, "").split()]
    names = {p.lower() for w in words for p in PARTS.findall(w)} | {re.sub("[-_]", "", w.lower()) for w in words}
    roles, prop = set(found.get("role", "").lower().split()), found.get("itemprop", "").lower()
    if names & REMARKS or "comment" in prop:
        return OUT
    if roles & ROLES or "hidden" in found or re.search(r"display\s*:\s*none", found.get("style", "").lower()):
        return OUT
    if tag == "article" or "articlebody" in prop or "article" in roles:
        return CONTENT
    if tag not in ("html", "body", "main") and names & NAMES and not names & CONTENT_NAMES:
        # inside an article one word among others is not enough: a "form of government" is a section like any other
        return OUT if not inside_article or furniture(words) else own
    if tag == "main" or "main" in roles or (tag in ("div", "section", "td") and names & CONTENT_NAMES):
        return MAIN
    return own


def blocks(page: str) -> list[tuple[str, int]]:
    """(text, verdict) of each block that has text, in page order."""
    out: list[tuple[str, int]] = []
    stack: list[Element] = []
    opened: dict[str, int] = {}
    held: list[str] = []
    state, article = OPEN, 0

    def close_block() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((text, state))

    def restate() -> None:
        nonlocal state, article
        state, article = OPEN, 0
        for e in stack:
            if e.verdict is None:
                continue
            if e.verdict == OUT:
                state = OUT
                break
            # a form may wrap the whole page: an article inside it is one all the same
            state = FORM if e.verdict == FORM else max(state, e.verdict)
            article += e.verdict == CONTENT

    def pop(to: int) -> None:
        changed = any(e.verdict is not None for e in stack[to:])
        for e in stack[to:]:
            opened[e.tag] -= 1
        del stack[to:]
        if changed:
            restate()

    pos, end = 0, len(page)
    while pos < end:
        m = TOKEN.match(page, pos)
        if m is None:  # an unclosed quotation mark: the rest is markup
            break
        pos = m.end()
        if m["text"] is not None:
            held.append(m["text"])
            continue
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"] != ">":
            break  # the page ends in a tag
        inline = tag in INLINE
        if m["close"]:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag), -1) if opened.get(tag) else -1
            if not inline:
                close_block()
            if at >= 0 and (not inline or all(e.tag in INLINE for e in stack[at:])):
                if any(e.verdict is not None for e in stack[at:]):
                    close_block()
                pop(at)
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE).search(page, pos)
            pos = close.end() if close else end
            if not inline:
                close_block()
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                close_block()
            continue
        if not inline:
            close_block()
            at = len(stack) - 1
            while at >= 0 and stack[at].tag in INLINE:
                at -= 1
            if at >= 0 and stack[at].tag == "p":  # a block ends an open paragraph
                pop(at)
            closed = CLOSES.get(tag, ())
            if stack and stack[-1].tag in closed:
                pop(len(stack) - 1)
        if m["attrs"].endswith("/") and tag in ("svg", "path", "use"):
            continue
        says = verdict(tag, m["attrs"], article > 0)
        if says is not None:
            close_block()
        if inline and says is None:
            continue
        stack.append(Element(tag, says))
        opened[tag] = opened.get(tag, 0) + 1
        if says is not None:
            restate()
    close_block()
    # beside an article what the markup says nothing about is open, as the article may be a teaser; without one the main part is the content
    top = max((s for _, s in out), default=OUT)
    if top == CONTENT:
        final = {CONTENT: CONTENT, MAIN: OPEN, OPEN: OPEN}
    else:
        final = {MAIN: CONTENT} if top == MAIN else {OPEN: OPEN}
    return [(t, final.get(s, OUT)) for t, s in out]


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def stream(page: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """(token, block) of all blocks outside the content; a blank token ends each block."""
    return [(w, i) for i, (t, v) in enumerate(page) if v != CONTENT for w in [*t.split(), " "]]


def token_codes(tokens: list[str]) -> np.ndarray:
    raw = [t.encode() for t in tokens]
    ends = np.cumsum([0, *map(len, raw)])
    return ranges_hash(np.frombuffer(b"".join(raw), np.uint8), ends[:-1], ends[1:])


def shared_runs(texts: list[list[int]], at: list[int], pages: list[set[int]], length: int = LENGTH, least: int = PAGES) -> list[list[int]]:
    """Of each stretch, the starts of its runs of ``length`` tokens that stand on ``least`` distinct pages.

    ``at``: the anchor's place in each stretch, so that runs meet at the same distance from it.
    """
    numbers = {c: i + len(texts) for i, c in enumerate(sorted({c for t in texts for c in t}))}
    flat: list[int] = []
    owner: list[int] = []
    for i, t in enumerate(texts):
        flat += [numbers[c] for c in t] + [i]
        owner += [i] * (len(t) + 1)
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    sa = np.array(suffix_array(flat), np.int64)
    text, own = np.array(flat), np.array(owner)
    room = begin[own + 1] - 1 - np.arange(len(text)) >= length
    order = sa[room[sa]]
    out: list[list[int]] = [[] for _ in texts]
    if not len(order):
        return out
    same = np.ones(len(order) - 1, bool)
    for k in range(length):
        w = np.flatnonzero(same)
        same[w] = text[order[w] + k] == text[order[w + 1] + k]
    cuts = np.flatnonzero(np.r_[True, ~same, True])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        by_distance: dict[int, list[int]] = {}
        for s in order[a:b].tolist():
            by_distance.setdefault(at[owner[s]] - (s - int(begin[owner[s]])), []).append(s)
        for group in by_distance.values():
            if sum(len(pages[owner[s]]) for s in group) < least:
                continue
            if len(set().union(*(pages[owner[s]] for s in group))) >= least:
                for s in group:
                    out[owner[s]].append(s - int(begin[owner[s]]))
    return out


def parsed(rows: list[dict]) -> Iterator[tuple[dict, list[tuple[str, int]]]]:
    return ((r, blocks(r["html"] or "")) for r in rows)


def settled(page: list[tuple[str, int]]) -> bool:
    """Whether the markup alone decides every block."""
    return all(v != OPEN for _, v in page)


FOUND = (
    "key long, open boolean, page long, anchor long, content long, first int, last int, at int, tokens array<long>, "
    "page_id long, url string, blocks array<struct<text:string,verdict:int>>"
)
FOUND_FIELDS = pa.schema([
    ("key", pa.int64()), ("open", pa.bool_()), *((c, pa.int64()) for c in ("page", "anchor", "content")),
    *((c, pa.int32()) for c in ("first", "last", "at")), ("tokens", pa.list_(pa.int64())),
    ("page_id", pa.int64()), ("url", pa.string()), ("blocks", pa.list_(pa.struct([("text", pa.string()), ("verdict", pa.int32())]))),
])


def keyed(pages: DataFrame) -> DataFrame:
    """(key, page_id, url, html); rows with equal id, url and html share a key."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.select(F.xxhash64("page_id", "url", "html").alias("key"), "page_id", "url", "html")


def find_contexts(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The contexts of the pages' streams, and the pages with open blocks (``blocks`` is set).

    A context is (key, open, page, anchor, content, first, last, at, tokens);
    ``page`` is a hash of the whole stream, by which equal pages count once;
    ``anchor`` and ``content`` are hashed with the host; ``open`` tells that its
    page has open blocks; tokens go with the first place of a content in a slice.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            out: list[dict] = []
            keys, hosts, streams, waiting = [], [], [], []
            for r, page in parsed(batch.to_pylist()):
                keys.append(r["key"])
                hosts.append(host_of(r["url"]))
                streams.append([w for w, _ in stream(page)])
                waiting.append(not settled(page))
                if waiting[-1]:
                    own = [{"text": t, "verdict": v} for t, v in page]
                    out.append({"key": r["key"], "page_id": r["page_id"], "url": r["url"], "blocks": own})
            offsets = np.cumsum([0, *map(len, streams)])
            codes = token_codes([w for s in streams for w in s])
            whole = ranges_hash(codes, offsets[:-1], offsets[1:]).view(np.int64).tolist()
            c = contexts(codes, offsets, length, gram)
            base = offsets[c.text]
            signed = codes.view(np.int64)
            of_host = token_codes(hosts)[c.text]
            anchors = ((c.anchor.view(np.uint64) ^ of_host) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)
            contents = ((c.content.view(np.uint64) ^ of_host) * np.uint64(0x94D049BB133111EB) ^ anchors.view(np.uint64)).view(np.int64)
            columns = (c.text, anchors, contents, c.first, c.last, c.place - c.first, base + c.first, base + c.last + length)
            seen: set[int] = set()
            for i, anchor, content, first, last, at, a, b in zip(*(x.tolist() for x in columns), strict=True):
                out.append({
                    "key": keys[i], "open": waiting[i], "page": whole[i], "anchor": anchor, "content": content,
                    "first": first, "last": last, "at": at, "tokens": None if content in seen else signed[a:b].tolist(),
                })
                seen.add(content)
            yield pa.RecordBatch.from_pylist(out, FOUND_FIELDS)

    return rows.mapInArrow(work, FOUND)


def boilerplate(found: DataFrame) -> DataFrame:
    """(key, spans): the runs of a page's stream that its host repeats."""
    pages = PAGES
    found = found.where("blocks is null")
    same = ["anchor", "content"]
    # a content on fewer pages than the threshold, three, is on its least and its most one
    by_page = found.groupBy(*same, "page").agg(F.lit(1).alias("one"))
    contents = by_page.groupBy(*same).agg(F.count("*").alias("n"), F.min("page").alias("least"), F.max("page").alias("most"))
    contents = written(contents, "html-contents")
    often = contents.where(F.col("n") >= pages).select(*same)
    anchors = contents.groupBy("anchor").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where((F.col("total") >= pages) & (F.col("kinds") > 1))
    few = meet(contents, anchors.select("anchor"), "anchor")
    few = written(few.select(*same, "n", F.array_distinct(F.array("least", "most")).alias("pages")), "html-few")
    # the tokens of those only: they depend on the content, so any of its places will do
    shown = found.where("tokens is not null").groupBy(*same).agg(F.first("at").alias("at"), F.first("tokens").alias("tokens"))
    few = written(meet(few, shown, same), "html-open")
    found = found.where("open")  # the verdict matters to these pages only
    size = few.agg(F.sum(F.size("tokens"))).first()[0] or 0
    shards = max(1, -(-int(size) // SHARD_TOKENS))

    def shard(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        # the anchor, which tells the hosts apart, stands before the tokens' numbers
        names = {h: i for i, h in enumerate(sorted({r["anchor"] for r in rows}))}
        texts = [[(names[r["anchor"]], t) for t in r["tokens"]] for r in rows]
        # a content on enough pages makes each of its runs repeated; its pages count as that many
        own = [set(r["pages"]) | ({(i, k) for k in range(pages)} if r["n"] >= pages else set()) for i, r in enumerate(rows)]
        out = []
        for r, starts in zip(rows, shared_runs(texts, [r["at"] for r in rows], own, LENGTH, pages), strict=True):
            out += [(r["anchor"], r["content"], s) for s in starts]
        types = [pa.int64(), pa.int64(), pa.int32()]
        columns = list(zip(*out, strict=True)) if out else [()] * 3
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], [*same, "start"])

    dealt = few.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    part = written(dealt.groupBy("shard").applyInArrow(shard, "anchor long, content long, start int"), "html-runs")
    whole = meet(found, often, same).select("key", F.col("first").alias("lo"), F.col("last").alias("hi"))
    at = F.col("first") + F.col("start")
    some = meet(found, part, same).select("key", at.alias("lo"), at.alias("hi"))
    spans = whole.unionByName(some).groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    return written(spans, "html-spans")


def main_text(page: list[tuple[str, int]], spans: list[dict] | None) -> tuple[str, int]:
    """The page's text without what its host repeats, and how many tokens its open blocks lose by that."""
    tokens = stream(page)
    covered = np.zeros(len(tokens) + 1, np.int64)
    for s in spans or ():
        covered[s["lo"]] += 1
        covered[min(len(tokens), s["hi"] + LENGTH)] -= 1
    covered = np.cumsum(covered)[: len(tokens)] > 0
    unique: dict[int, list[str]] = {}
    repeated = 0
    for (w, i), c in zip(tokens, covered.tolist(), strict=True):
        if w != " " and page[i][1] == OPEN:
            repeated += c
            if not c:
                unique.setdefault(i, []).append(w)
    lines = [t if v == CONTENT else " ".join(unique.get(i, ())) for i, (t, v) in enumerate(page)]
    return "\n".join(x for x in lines if x), repeated


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_repeated) of every page.

    Pages that the markup settles are read out where they lie; only those with
    open blocks meet their host's verdict in a join.
    """
    rows = keyed(pages)
    found = written(find_contexts(rows), "html-contexts")
    spans = boilerplate(found)

    def row(r: dict, page: list[tuple[str, int]], own: list[dict] | None) -> dict:
        text, repeated = main_text(page, own)
        return {"page_id": r["page_id"], "url": r["url"], "text": text, "n_chars": len(text), "n_repeated": repeated}

    def at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            out = [row(r, page, None) for r, page in parsed(batch.to_pylist()) if settled(page)]
            yield pa.RecordBatch.from_pylist(out, OUT_FIELDS)

    def by_host(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
                out = [row(r, [(b["text"], b["verdict"]) for b in r["blocks"]], r["spans"]) for r in part.to_pylist()]
                yield pa.RecordBatch.from_pylist(out, OUT_FIELDS)

    names = "page_id long, url string, text string, n_chars long, n_repeated long"
    open_ = meet(found.where("blocks is not null").select("key", "page_id", "url", "blocks"), spans, "key", "left")
    return rows.mapInArrow(at_once, names).unionByName(open_.select("page_id", "url", "blocks", "spans").mapInArrow(by_host, names))


OUT_FIELDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_repeated", pa.int64()),
])
