"""Main text of web pages by wrappers: union-free regular expressions per host, inferred by aligning all its pages.

A page is a stream of tags and texts. Adjacent repetitions fold into repeated groups. All pages of a host with the same folded stream
merge into one expression, in which texts that differ are slots; the expressions are aligned one after the other, and what only some
have becomes optional. Pages with and without an article or main element have a wrapper each. The wrapper's texts are judged once
(kind of the elements around them, texts that never change, where most of the text is), and every page is aligned with it; pages of
one structure share the alignment.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from postweave.llm.common import small_batches
from postweave.session import pin

# Parts into which the expressions of a host are dealt before they meet, and nodes of expressions that a task holds at once.
PARTS, HELD = 64, 200_000
MOST_BROADCAST = 64 << 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|svg|textarea)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^<>]*\Z|([^<]++|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_FOLD = re.compile(r"(.{1,40}?)\1+", re.S)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
# Elements, and words of class, id or role, around what is not main text.
_OUTSIDE = frozenset("head title nav footer aside form button select option label menu dialog".split())
_OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement banner promo sponsor sponsored sidebar side aside menu nav navigation navbar breadcrumb breadcrumbs footer "
    "foot comment comments reply replies respond discussion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription share sharing social related recommended recommendations widget login signup register search toolbar pagination pager tags masthead "
    "complementary contentinfo".split()
)
_MAIN = ("article", "main")
_PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre".split())


def tokens(page: str) -> list[tuple[str, str]]:
    """(mark, text) of the page: marks are tags with their class, id and role, or '#' for a text that has a character to show."""
    out: list[tuple[str, str]] = []
    for m in _TOKEN.finditer(page):
        name = m.group(3)
        if name:
            name = name.lower()
            if m.group(2):
                out.append((f"</{name}>", ""))
                continue
            kept = ""
            if m.group(4) and "=" in m.group(4):
                found = sorted((a.lower(), re.sub(r"\d+", "0", (b or c or d).strip().lower())) for a, b, c, d in _ATTRIBUTE.findall(m.group(4)))
                kept = "".join(f" {a}={v}" for a, v in found)
            out.append((f"<{name}{kept}>", ""))
        elif m.group(5):
            if out and out[-1][0] == "#":
                out[-1] = ("#", out[-1][1] + m.group(5))
            else:
                out.append(("#", m.group(5)))
    # White space between tags shows nothing, but keeps inline words apart; it goes to the text before or after it.
    shown: list[tuple[str, str]] = []
    space = False
    for mark, text in out:
        if mark == "#" and not text.strip():
            space = True
            continue
        if mark == "#" and space:
            text = " " + text
        space = False if mark == "#" or mark[1:].strip("/>").split(" ")[0] in _BLOCKS else space
        shown.append((mark, text))
    return shown


def fold(marks: list[str]) -> list:
    """The marks with adjacent repetitions folded: a node is an index of marks, or ('+', repetitions), each a list of nodes."""
    chars: dict = {}

    def char(key) -> str:
        return chars.setdefault(key, chr(0x10000 + len(chars)))

    line = "".join(map(char, marks))
    nodes: list = list(range(len(marks)))
    for _ in range(8):
        out: list = []
        parts: list[str] = []
        at = 0
        for m in _FOLD.finditer(line):
            size = len(m.group(1))
            out += nodes[at : m.start()]
            parts.append(line[at : m.start()])
            out.append(("+", [nodes[i : i + size] for i in range(m.start(), m.end(), size)]))
            parts.append(char(("+", m.group(1))))
            at = m.end()
        if not at:
            break
        nodes, line = out + nodes[at:], "".join(parts) + line[at:]
    return nodes


def expression(nodes: list, stream: list[tuple[str, str]], paths: list[tuple]) -> list[dict]:
    """The folded stream as a list of {k: key, o: optional}, with b (a repeated body), or t, n, p (hash, length and path of a text)."""
    out = []
    for node in nodes:
        if isinstance(node, tuple):
            bodies = [expression(r, stream, paths) for r in node[1]]
            body = bodies[0]
            for other in bodies[1:]:
                body = _merged(body, other)
            out.append({"k": "(" + " ".join(x["k"] for x in body) + ")+", "o": False, "b": body})
        elif stream[node][0] == "#":
            text = hashlib.blake2b(" ".join(stream[node][1].split()).encode("utf-8", "replace"), digest_size=12).hexdigest()
            out.append({"k": "#", "o": False, "t": text, "n": len(stream[node][1]), "p": list(paths[node])})
        else:
            out.append({"k": stream[node][0], "o": False})
    return out


def _merged(a: list[dict], b: list[dict]) -> list[dict]:
    """Two lists of equal keys as one: differing texts become slots."""
    out = []
    for x, y in zip(a, b):
        z = {**x, "o": x["o"] or y["o"]}
        if "b" in x and "b" in y:
            z["b"] = _merged(x["b"], y["b"])
        elif x["k"] == "#":
            z["t"] = x["t"] if x["t"] == y["t"] else None
            z["n"] = x["n"] + y["n"]
            if "s" in x and "s" in y:
                z["s"] = x["s"] + y["s"]
        out.append(z)
    return out


def _optional(nodes: list[dict]) -> list[dict]:
    return [{**x, "o": True} for x in nodes]


def _reconciled(a: list[dict], b: list[dict]) -> list[dict]:
    """Differing stretches: a repeated group meets a single copy of its body, or another group; all else is optional."""
    if a and b:
        for x, y, swap in ((a, b, False), (b, a, True)):
            body = x[0].get("b")
            if body and [n["k"] for n in y[: len(body)]] == [n["k"] for n in body]:
                merged = _merged(body, y[: len(body)])
                rest = (x[1:], y[len(body) :])
                return [{**x[0], "b": merged}, *_reconciled(*(rest[::-1] if swap else rest))]
        if a[0].get("b") and b[0].get("b") and a[0]["b"][0]["k"] == b[0]["b"][0]["k"]:
            body = aligned(a[0]["b"], b[0]["b"])
            return [{"k": "(" + " ".join(n["k"] for n in body) + ")+", "o": a[0]["o"], "b": body}, *_reconciled(a[1:], b[1:])]
    return _optional(a) + _optional(b)


def aligned(a: list[dict], b: list[dict]) -> list[dict]:
    """The union-free expression of both: equal stretches merge, the others are reconciled."""
    out: list[dict] = []
    for op, i, j, k, m in SequenceMatcher(None, [x["k"] for x in a], [x["k"] for x in b], autojunk=False).get_opcodes():
        out += _merged(a[i:j], b[k:m]) if op == "equal" else _reconciled(a[i:j], b[k:m])
    return out


def paths_of(marks: list[str]) -> list[tuple]:
    """For each mark the open elements around it. An unclosed paragraph or item ends where the next begins."""
    open_: list[str] = []
    out = []
    for mark in marks:
        if mark == "#":
            out.append(tuple(open_))
            continue
        name = mark.strip("</>").split(" ")[0]
        if mark[1] == "/":
            for i in range(len(open_) - 1, -1, -1):
                if open_[i].split(" ")[0] == name:
                    del open_[i:]
                    break
        elif name not in _VOID:
            if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option"):
                for i in range(len(open_) - 1, -1, -1):
                    other = open_[i].split(" ")[0]
                    if other == name:
                        del open_[i:]
                        break
                    if other in _BLOCKS:
                        break
            open_.append(mark[1:-1])
        out.append(tuple(open_))
    return out


def outside(path) -> bool:
    """Is a text with these elements around it a menu, form, advert, comment or the like?"""
    main = False
    for element in path:
        name, _, attributes = element.partition(" ")
        if name in _OUTSIDE or (name == "header" and not main):
            return True
        main = main or name in _MAIN
        if attributes and not _OUTSIDE_WORDS.isdisjoint(re.split(r"[^a-z]+", re.sub(r"\b(?:class|id|role)=", " ", attributes))):
            return True
    return False


def _slots(nodes: list[dict], repeated: bool = False) -> Iterator[tuple[dict, bool]]:
    for x in nodes:
        if "b" in x:
            yield from _slots(x["b"], True)
        elif x["k"] == "#":
            yield x, repeated


def _fixed(texts: list[tuple[dict, bool]], pages: int, shapes: int) -> set[int]:
    """Texts of the frame: blocks of links only, and blocks that at least half of the shapes hold and that never change, unless most text is such."""
    blocks: list[list[tuple[dict, bool]]] = []
    last = None
    for x, repeated in texts:
        inner = max((i + 1 for i, e in enumerate(x["p"]) if e.split(" ")[0] in _BLOCKS), default=0)
        if x["p"][:inner] != last:
            blocks.append([])
            last = x["p"][:inner]
        blocks[-1].append((x, repeated))
    same = [b for b in blocks if pages >= 3 and all(not r and 2 * x.get("s", 1) >= shapes and x["t"] is not None for x, r in b)]
    if sum(x["n"] for b in same for x, _ in b) > 0.3 * sum(x["n"] for x, _ in texts):
        same = []
    links = [b for b in blocks if all(any(e.split(" ")[0] == "a" for e in x["p"]) for x, _ in b)]
    return {id(x) for b in same + links for x, _ in b}


def _in_main(nodes: list[dict]) -> list[dict]:
    return [x for x, _ in _slots(nodes) if not outside(x["p"]) and any(e.split(" ")[0] in _MAIN for e in x["p"])]


def judged(wrapper: list[dict], pages: int, shapes: int = 1) -> dict:
    """The wrapper with a verdict (v) on every text, and the region of the main text as the elements around it."""
    texts = [(x, r) for x, r in _slots(wrapper) if not outside(x["p"])]
    main = _in_main(wrapper)
    region: list[str] = []
    if main:
        region = next([*x["p"][: i + 1]] for x in main for i, e in enumerate(x["p"]) if e.split(" ")[0] in _MAIN)
        kept = main
    else:
        fixed = _fixed(texts, pages, shapes)
        loose = [x for x, _ in texts if id(x) not in fixed]
        total = sum(x["n"] for x in loose)
        while True:
            inner = {tuple(x["p"][: len(region) + 1]) for x in loose if len(x["p"]) > len(region) and x["p"][: len(region)] == region}
            inner = {p for p in inner if p[-1].split(" ")[0] in _BLOCKS - _PARAGRAPHS}
            best = max(inner, key=lambda p: (sum(x["n"] for x in loose if tuple(x["p"][: len(p)]) == p), p), default=None)
            if best is None or sum(x["n"] for x in loose if tuple(x["p"][: len(best)]) == best) < 0.6 * total:
                break
            region = list(best)
        kept = [x for x in loose if x["p"][: len(region)] == region]
    ids = set(map(id, kept))
    for x, _ in _slots(wrapper):
        x["v"] = id(x) in ids
    return {"region": region, "main": bool(main), "nodes": wrapper}


def read(page: str | None) -> tuple[str, list[dict]] | None:
    """Shape of the page and its expression; None if it has neither tags nor text."""
    stream = tokens(page or "")
    if not stream:
        return None
    marks = [m for m, _ in stream]
    nodes = fold(marks)
    return _shape(nodes, marks), expression(nodes, stream, paths_of(marks))


def one_shape(nodes: list[dict]) -> list[dict]:
    """The expression of a shape, its texts counted once, however many pages it stands for."""
    for x, _ in _slots(nodes):
        x["s"] = 1
    return nodes


def infer(pages: list[str]) -> dict | None:
    """Wrapper of the pages: those of one shape merge, the shapes are aligned in the order of their first pages."""
    by_shape: dict[str, list[dict]] = {}
    for shape, own in filter(None, map(read, pages)):
        by_shape[shape] = _merged(by_shape[shape], own) if shape in by_shape else own
    wrapper = None
    for own in map(one_shape, by_shape.values()):
        wrapper = own if wrapper is None else aligned(wrapper, own)
    return judged(wrapper, len(pages), len(by_shape)) if wrapper else None


def _by_path(path, wrapper: dict) -> bool:
    """Verdict on a text that the wrapper does not know."""
    if outside(path):
        return False
    if wrapper["main"]:
        return any(e.split(" ")[0] in _MAIN for e in path)
    return list(path[: len(wrapper["region"])]) == wrapper["region"]


def _verdicts(own: list[dict], known: list[dict], wrapper: dict) -> list:
    """Verdicts of a folded page in the shape of its nodes: a bool, or a list for a repeated group."""
    out: list = []

    def alone(x: dict):
        return [alone(y) for y in x["b"]] if "b" in x else x["k"] == "#" and _by_path(x["p"], wrapper)

    def paired(x: dict, y: dict):
        if "b" in x:
            return _verdicts(x["b"], y["b"], wrapper)
        # The frame's fixed texts are known by their words; another text in their place is judged by its path.
        return x["k"] == "#" and (bool(y["v"]) if y["v"] or y["t"] is None or y["t"] == x["t"] else _by_path(x["p"], wrapper))

    for op, i, j, k, m in SequenceMatcher(None, [x["k"] for x in own], [x["k"] for x in known], autojunk=False).get_opcodes():
        if op == "equal":
            out += [paired(x, y) for x, y in zip(own[i:j], known[k:m])]
        else:
            out += [alone(x) for x in own[i:j]]
    return out


def extract(page: str | None, wrapper: dict | list[dict] | None, cache: dict) -> str:
    """Main text of the page: blocks joined by line ends. Of several wrappers that of its kind is used; without one the page is judged alone."""
    stream = tokens(page or "")
    if not stream:
        return ""
    marks = [m for m, _ in stream]
    nodes = fold(marks)
    shape = _shape(nodes, marks)
    if shape not in cache:
        if len(cache) > 2000:
            cache.clear()
        own = expression(nodes, stream, paths_of(marks))
        kind = bool(_in_main(own))
        fit = [w for w in ([wrapper] if isinstance(wrapper, dict) else wrapper or []) if w["main"] == kind]
        rules = fit[0] if fit else judged(json.loads(json.dumps(own)), 1)
        cache[shape] = _verdicts(own, rules["nodes"], rules)
    keep = [False] * len(stream)
    _spread(nodes, cache[shape], keep)
    blocks, now = [], []
    for i, (mark, text) in enumerate(stream):
        if mark == "#":
            if keep[i]:
                now.append(text)
        else:
            name = mark.strip("</>").split(" ")[0]
            if name == "br":
                now.append(" ")
            elif name in _BLOCKS and now:
                blocks.append("".join(now))
                now = []
    blocks.append("".join(now))
    clean = (" ".join(entities.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def _shape(nodes: list, marks: list[str]) -> str:
    return " ".join("(" + _shape(n[1][0], marks) + ")+" if isinstance(n, tuple) else marks[n] for n in nodes)


def _spread(nodes: list, verdicts: list, keep: list[bool]) -> None:
    for node, verdict in zip(nodes, verdicts):
        if isinstance(node, tuple):
            for copy in node[1]:
                _spread(copy, verdict, keep)
        else:
            keep[node] = verdict


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _shapes(pages: DataFrame, held: int) -> DataFrame:
    """(host, main, shape, pages, expression as JSON): a row per shape of a host for what a task holds at once, from all pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "main", "shape", "pages", "expression"]
        known: dict[tuple, list] = {}
        nodes = 0

        def rows() -> pa.RecordBatch:
            made = [(*k, n, json.dumps(x, separators=(",", ":"))) for k, (n, x) in known.items()]
            types = (pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names=names)

        for batch in batches:
            for host_, page in zip(*batch.columns):
                found = read(page.as_py())
                if found is None:
                    continue
                shape, own = found
                key = (host_.as_py(), bool(_in_main(own)), hashlib.blake2b(shape.encode("utf-8", "replace"), digest_size=16).hexdigest())
                if key in known:
                    known[key] = [known[key][0] + 1, _merged(known[key][1], own)]
                    continue
                known[key] = [1, own]
                nodes += len(own)
                if nodes > held:
                    yield rows()
                    known, nodes = {}, 0
        if known:
            yield rows()

    html = pages.where(F.col("html").isNotNull()).select(host(F.col("url")).alias("host"), "html")
    return html.mapInArrow(run, "host string, main boolean, shape string, pages bigint, expression string")


def wrappers(pages: DataFrame, parts: int = PARTS, held: int = HELD) -> DataFrame:
    """(host, wrappers as JSON), from all pages: one for those with a text in an article or main element, one for the others.

    Tasks merge the pages of a shape, a shuffle by host and part of the shapes merges what they hold and aligns the shapes of a part;
    the parts of a host meet last. Shapes are taken in the order of their hashes, so the result does not depend on how rows are dealt.
    """
    dealt = _shapes(pages, held).withColumn("part", F.pmod(F.xxhash64("shape"), F.lit(parts)))

    def align(group: pd.DataFrame) -> pd.DataFrame:
        wrapper, n, first = None, 0, group.iloc[0]
        for _, same in group.sort_values("shape").groupby("shape", sort=True):
            own = None
            for x in map(json.loads, same["expression"]):
                own = x if own is None else _merged(own, x)
            own = one_shape(own)
            wrapper = own if wrapper is None else aligned(wrapper, own)
            n += 1
        row = (first["host"], bool(first["main"]), int(first["part"]), int(group["pages"].sum()), n, json.dumps(wrapper, separators=(",", ":")))
        return pd.DataFrame([row], columns=["host", "main", "part", "pages", "shapes", "expression"])

    def build(group: pd.DataFrame) -> pd.DataFrame:
        made = []
        for _, kind in group.groupby("main", sort=True):
            wrapper = None
            for own in map(json.loads, kind.sort_values("part")["expression"]):
                wrapper = own if wrapper is None else aligned(wrapper, own)
            made.append(judged(wrapper, int(kind["pages"].sum()), int(kind["shapes"].sum())))
        return pd.DataFrame([(group["host"].iloc[0], json.dumps(made, separators=(",", ":")))], columns=["host", "wrapper"])

    schema = "host string, main boolean, part long, pages long, shapes long, expression string"
    return dealt.groupBy("host", "main", "part").applyInPandas(align, schema).groupBy("host").applyInPandas(build, "host string, wrapper string")


def main_text(pages: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars.

    Null or empty html gives an empty text. Pages without url are taken as of one host. A host without wrapper has its pages judged
    one by one. Repeated rows get equal results, and an empty table gives none. Other columns are not read. Wrappers of up to
    `most` characters in all are sent to all tasks, more are joined by a shuffle.
    """
    made = pin(wrappers(small_batches(pages)))
    size = made.agg(F.sum(F.length("wrapper"))).first()[0] or 0
    sent = made.select(F.col("host").alias("w_host"), "wrapper")
    rows = pages.select("page_id", "url", "html").join(F.broadcast(sent) if size <= most else sent, host(F.col("url")) == F.col("w_host"), "left")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, tuple[dict | None, dict]] = {}
        for batch in batches:
            texts = []
            for page, wrapper in zip(batch.column(2), batch.column(3)):
                wrapper = wrapper.as_py()
                if wrapper not in known:
                    if len(known) > 500:
                        known.clear()
                    known[wrapper] = (json.loads(wrapper) if wrapper else None, {})
                texts.append(extract(page.as_py(), *known[wrapper]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema=schema
            )

    return rows.select(F.col("page_id").cast("long"), "url", "html", "wrapper").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
