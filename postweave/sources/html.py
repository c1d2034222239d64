"""Job boards that answer with HTML: links of a search page, text of a detail page."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from postweave.functions.text import stable_uuid
from postweave.sources.landed import arrival


@dataclass(frozen=True)
class Board:
    """How one board marks its job links and its job text."""

    source: str
    host: str
    link_parts: tuple[str, ...]
    content: tuple[str, ...]
    at_start: bool = False   # the link part must begin the href
    ids_too: bool = False    # content names may also be element ids


# Hosts, link marks and content names, the latter in order of precedence.
BOARDS = {b.source: b for b in (
    Board("myjobmag", "https://www.myjobmag.com", ("/job/",),
          ("read-job-section-in", "job-details", "mag-body"), at_start=True),
    Board("fuzu", "https://www.fuzu.com", ("/job/",),
          ("job-description", "job-detail", "description", "content", "main"), ids_too=True),
    Board("jobgurus", "https://www.jobgurus.com.ng", ("/job/", "/vacancy/", ".html"),
          ("job-details", "job-description", "single-content", "content", "main", "entry-content")),
    Board("jobberman", "https://www.jobberman.com", ("/job/",),
          ("job-description", "job-detail", "description", "content", "main", "job-body")),
)}
MIN_LINK_TEXT = 6

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset(("script", "style", "template", "rt", "rp"))


class _Page(HTMLParser):
    """Anchors, page title, and the text pieces below every element of interest, in document order."""

    def __init__(self, names: tuple[str, ...] = (), ids_too: bool = False):
        super().__init__()
        self.names, self.ids_too = names, ids_too
        self.open: list[tuple[str, list[list[str]]]] = []
        self.sinks: list[list[str]] = []
        self.anchors: list[tuple[str, list[str]]] = []
        self.by_class: dict[str, list[str]] = {}
        self.by_id: dict[str, list[str]] = {}
        self.title: list[str] | None = None
        self.pending: list[str] = []
        self.everything: list[str] = []
        self.sinks.append(self.everything)

    def handle_starttag(self, tag, attrs):
        self.flush()
        a = dict(attrs)
        mine: list[list[str]] = []

        def sink() -> list[str]:
            mine.append([])
            return mine[-1]

        if tag == "a" and "href" in a:
            self.anchors.append((a["href"] or "", sink()))
        if tag == "title" and self.title is None:
            self.title = sink()
        if self.names:
            classes = (a.get("class") or "").split()
            for n in self.names:
                if n in classes and n not in self.by_class:
                    self.by_class[n] = sink()
                if self.ids_too and a.get("id") == n and n not in self.by_id:
                    self.by_id[n] = sink()
        if tag not in _VOID:
            self.open.append((tag, mine))
            self.sinks.extend(mine)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.flush()
        if not any(t == tag for t, _ in self.open):
            return
        while True:
            t, mine = self.open.pop()
            if mine:
                gone = {id(s) for s in mine}
                self.sinks = [s for s in self.sinks if id(s) not in gone]
            if t == tag:
                return

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def flush(self):
        """Text between two marks is one piece, however the parser hands it over."""
        if self.pending and not any(t in _SILENT for t, _ in self.open):
            piece = "".join(self.pending)
            for s in self.sinks:
                s.append(piece)
        self.pending.clear()

    @classmethod
    def of(cls, html: str, *args) -> _Page:
        page = cls(*args)
        page.feed(html)
        page.close()
        page.flush()
        return page


def _joined(pieces: list[str]) -> str:
    return "\n".join(p for p in (x.strip() for x in pieces) if p)


def links_in(html: str) -> list[tuple[str, str]]:
    page = _Page.of(html)
    return [(href, "".join(text).strip()) for href, text in page.anchors]


def text_of(html: str, names: tuple[str, ...], ids_too: bool) -> str:
    page = _Page.of(html, names, ids_too)
    hit = next((s for n in names for s in (page.by_class.get(n), page.by_id.get(n)) if s is not None), None)
    body = (_joined(hit) if hit is not None else "") or _joined(page.everything)
    return f"Title: {''.join(page.title or []).strip()}\n\n{body}"


def _is_job_link(board: Board) -> Column:
    href = F.col("href")
    marks = [href.startswith(p) if board.at_start else href.contains(p) for p in board.link_parts]
    hit = marks[0]
    for m in marks[1:]:
        hit = hit | m
    return hit & (F.length("text") >= MIN_LINK_TEXT)


def html_anchors(pages: DataFrame) -> DataFrame:
    """pages: page_seq, unit, query, fetched_at, payload. One row per anchor with an href."""
    carried = ["page_seq", "unit", "query", "fetched_at"]

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            hits = [(i, pos, *a) for i, html in enumerate(f["payload"]) if html for pos, a in enumerate(links_in(html))]
            out = pd.DataFrame(hits, columns=["_i", "pos", "href", "text"])
            yield f[carried].iloc[out["_i"]].reset_index(drop=True).join(out[["pos", "href", "text"]])

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in carried)
    return pages.select(*carried, "payload").mapInPandas(rows, f"{kinds}, pos int, href string, text string")


def html_job_links(pages: DataFrame, board: Board) -> DataFrame:
    """Job links of search pages: seq, unit, query, fetched_at, title, url.

    Pages that cannot hold such a link are left out before they reach Python.
    """
    may_hit = F.col("payload").contains(board.link_parts[0])
    for p in board.link_parts[1:]:
        may_hit = may_hit | F.col("payload").contains(p)
    # A mark may be written with character references, so pages with any in an href are read too.
    may_hit = may_hit | F.col("payload").rlike(r"(?i)href\s*=[^>]*&")
    href = F.col("href")
    hosted = F.concat(F.lit(board.host), href)
    url = hosted if board.at_start else F.when(href.startswith("http"), href).otherwise(hosted)
    return html_anchors(pages.filter(may_hit)).filter(_is_job_link(board)).select(
        arrival(F.col("page_seq"), F.col("pos")).alias("seq"), "unit", "query", "fetched_at",
        F.col("text").alias("title"), url.alias("url"),
    )


def html_detail_text(pages: DataFrame, board: Board) -> DataFrame:
    """pages: url, payload. The posting text of each detail page."""
    names, ids_too = board.content, board.ids_too

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"url": f["url"], "raw_text": [text_of(h or "", names, ids_too) for h in f["payload"]]})

    return pages.select("url", "payload").mapInPandas(rows, "url string, raw_text string")


def raw_from_html(links: DataFrame, details: DataFrame, board: Board) -> DataFrame:
    """Links with their detail text; a url found again in the same fetch unit keeps its first link.

    Links shrink to one per (unit, url) before they meet the page texts, so that a url linked from
    everywhere does not multiply its text. Of a page crawled several times one text counts, the least.
    """
    details = details.groupBy("url").agg(F.min("raw_text").alias("raw_text"))
    first = links.groupBy("unit", "url").agg(F.min(F.struct("seq", "query", "fetched_at", "title")).alias("_l"))
    rows = first.select("unit", "url", "_l.*").join(details, "url")
    meta = F.to_json(F.struct("title", "query"), {"ignoreNullFields": "false"})
    return rows.select(
        "seq", stable_uuid(F.lit(board.source), F.col("seq").cast("string")).alias("id"),
        F.lit(board.source).alias("source"), F.col("url").alias("external_id"), "raw_text",
        F.col("url").alias("source_url"), F.col("fetched_at").cast("timestamp").alias("fetched_at"),
        meta.alias("metadata"), "unit",
    )
