"""Operator 5 — main-text extraction by inferring union-free wrappers for each host.

A page becomes a stream of blocks; a block is the path of its open containers (tag and class) and
its text.  The stream of paths is generalised to a union-free regular expression: adjacent repeats
of any period up to ``PERIOD`` become a repeated group, and two pages' expressions are aligned step by
step — what only one of them has becomes optional, groups that repeat in either stay repeated.  Each
item keeps in how many pages it was met, how much text it held and a summary of bounded size of which
texts it held how often.  Wrappers are folded within a partition first and then by host (salted, so
that a host with a third of all pages is spread), so every page takes part and a group stays small.

The wrapper then tells what is content.  An item whose text is the same on half of the host's pages is
template, other items are slots.  If the wrapper has an article container, its items are the article
(many near copies of one article make its title and much else constant, so constancy does not count there).
If there is none, the article is the container that holds most of the slots' text, with first headings
that vary outside it and without small constant items, headings aside, in it.  Menus, headers, footers,
sidebars, notices, adverts, forms and comments are never content, but a header inside an article belongs
to it, and a name counts only if its other words are structural (``ad-slot``, not ``share-price``).  On
hosts with few pages, or of copies of one page, constancy tells nothing and is not used.  Each page is
read by matching its own expression with the wrapper of its host, item by item.

Defined cases: null or empty html gives the empty text; a null or malformed url belongs to the host
''; unclosed and misnested tags end with their container; comments, scripts and styles are skipped
as the raw text they are; pages that fill none of the wrapper's content fall back on all slots outside
boilerplate, then on all text outside it; null page_ids are kept; repeated pages give repeated rows;
extra columns, clashing names included, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import batches, doc_columns, map_arrow, prepare, stage

SALTS = 32
#: Bytes of wrappers up to which they are broadcast; beyond, pages and wrappers are shuffled by host.
BROADCAST_BYTES = 32 << 20
#: Items of a wrapper: beyond, an expression is generalised to a set of paths (all optional, repeated).
LONGEST = 200
#: Blocks of a repeated group at most.
PERIOD = 6
#: Texts that an item remembers with their counts; a text of more than a ninth of the pages is among them.
VOTES = 8
#: Constancy is told from this many pages on, and not on hosts where one page makes up this share.
PAGES, COPIES = 4, 0.3
#: Share of an item's pages that hold one text in a constant, and of the slots' text that a constant among the content stays below.
CONSTANT, SMALL = 0.5, 0.2
#: Share of its parent's text that a container must hold to be the article in its place.
DENSE = 0.7

#: Elements by role.
RAW = frozenset("script style noscript template textarea title svg math iframe object select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 dt dd li td th tr option".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form menu dialog button fieldset search head".split())
BOILERPLATE_NAMES = frozenset("nav navbar navigation menu header masthead footer sidebar aside ad ads advert advertisement adverts banner promo promotion sponsor sponsored cookie cookies consent notice notices alert popup modal overlay comment comments reply replies respond disqus share sharing social related recommended breadcrumb breadcrumbs pagination pager subscribe subscription newsletter signup login widget toolbar copyright disclaimer skip".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
MAIN_NAMES = frozenset("article content main post entry story maincontent articlebody postcontent entrycontent".split())
#: Words that may stand beside those names without changing what they say.
STRUCTURAL = frozenset("area article articles bar block body bottom box button buttons col column container content entry global group icon icons inner item items js left link links list main news outer page post posts primary right row secondary section site slot stories story text top unit wrap wrapper".split())
CONTAINERS = frozenset("div section td main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in RAW}


@lru_cache(50_000)
def _token_role(token: str) -> str:
    """What a class or id says: b boilerplate, m main, or nothing."""
    words = {w for w in re.findall("[a-z]+", re.sub("(?<=[a-z])(?=[A-Z])", "-", token).lower())}
    named = words & BOILERPLATE_NAMES
    if named and words - named <= STRUCTURAL and not (named == {"header"} and words & MAIN_NAMES):
        return "b"
    return "m" if words & MAIN_NAMES and words <= MAIN_NAMES | STRUCTURAL else ""


@lru_cache(50_000)
def _label(tag: str, attributes: str, inside: str) -> tuple[str, str]:
    """Name of an element in paths, and its role inside a container of a role: b boilerplate, m main, or none."""
    role = "" if tag == "header" and inside == "m" else "b" if tag in BOILERPLATE_TAGS else "m" if tag in ("article", "main") else ""
    if not attributes or tag in ("body", "html"):
        return tag, role
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAMES.finditer(attributes)}
    classes, ids, aria = found.get("class", "").split(), found.get("id", "").split(), found.get("role", "").lower()
    says = {_token_role(t) for t in (*classes, *ids)}
    if "b" in says or aria in BOILERPLATE_ROLES:
        role = "b"
    elif not role and tag in CONTAINERS and ("m" in says or aria in ("main", "article")):
        role = "m"
    # Long numbers differ from page to page; short ones may tell classes apart.
    names = sorted({re.sub(r"\d{3,}", "#", t.lower()) for t in classes} | {re.sub(r"\d+", "#", t.lower()) for t in ids})
    return f"{tag}.{'.'.join(names)}".replace("/", "#").replace("|", "#") if names else tag, role


def page_blocks(html: str) -> list[tuple[str, str, str]]:
    """(path, role, text) of the blocks of a page in order; the role is that of its containers, boilerplate first."""
    out: list[tuple[str, str, str]] = []
    stack: list[tuple[str, str, str]] = [("", "", "")]  # tag, path, role
    text: list[str] = []

    def close() -> None:
        if text:
            words = " ".join(unescape("".join(text)).split())
            text.clear()
            if words:
                out.append((stack[-1][1], stack[-1][2], words))

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if not m:
            text.append(html[at:])
            break
        if m.start() > at:
            text.append(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                text.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if tag == "br" or tag == "hr":
            text.append(" ")
            continue
        if tag in RAW and not m[1]:
            end = _RAW_END[tag].search(html, at)
            at = n if not end else html.find(">", end.end()) + 1 or n
            continue
        if tag not in BLOCK:
            continue
        close()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if stack[-1][0] in LEAF and (tag in LEAF or stack[-1][0][0] in "ph" and stack[-1][0] != "hgroup") and not (tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6") and stack[-1][0] in ("li", "td", "th", "dd")) and not (tag in ("td", "th") and stack[-1][0] == "tr"):
            stack.pop()  # an open paragraph, heading or item ends where the next block starts
            if tag in ("tr", "li") and stack[-1][0] == tag:
                stack.pop()
        _, path, outer = stack[-1]
        name, role = _label(tag, m[3], outer)
        stack.append((tag, f"{path}/{name}", "b" if "b" in (outer, role) else outer or role))
    close()
    return out


# A wrapper is {"pages": number, "copies": votes of whole pages, "items": list}.  An item is
# [signature, optional, repeated, roles, pages, text, votes]: signature is a path or paths joined by "|" for a
# group, roles its blocks' roles, pages and text how many pages and code points it was met in, and votes the
# hashes of its commonest texts with their counts.


def fold(blocks: list[tuple[str, str, str]]) -> list[list]:
    """The expression of one page: adjacent repeats of any short period become repeated groups."""
    return [item for item, _ in folded(blocks)]


def folded(blocks: list[tuple[str, str, str]]) -> list[tuple[list, range]]:
    """The items of a page's expression, each with its blocks."""
    paths = [path for path, _, _ in blocks]
    out: list[tuple[list, range]] = []
    i = 0
    while i < len(blocks):
        best = (1, 1)
        for period in range(1, min(PERIOD, len(blocks) - i) + 1):
            first = paths[i : i + period]
            times = 1
            while paths[i + times * period : i + (times + 1) * period] == first:
                times += 1
            if times > 1 and times * period > best[0] * best[1]:
                best = (period, times)
        period, times = best
        texts = [text for _, _, text in blocks[i : i + period * times]]
        vote = format(xxhash.xxh64_intdigest("\n".join(texts)), "x")
        out.append((["|".join(paths[i : i + period]), False, times > 1, "".join(r or "-" for _, r, _ in blocks[i : i + period]), 1, sum(map(len, texts)), {vote: 1}], range(i, i + period * times)))
        i += period * times
    return out


def wrapper_of(blocks: list[tuple[str, str, str]]) -> dict:
    """The wrapper of one page."""
    items = fold(blocks)
    whole = format(xxhash.xxh64_intdigest("".join(v for x in items for v in x[6])), "x")
    return {"pages": 1, "copies": {whole: 1}, "items": items if len(items) <= LONGEST else flatten(items)}


def unite(a: dict, b: dict) -> dict:
    """The wrapper of two sets of pages."""
    return {"pages": a["pages"] + b["pages"], "copies": votes_of(a["copies"], b["copies"]), "items": align(a["items"], b["items"])}


def votes_of(a: dict[str, int], b: dict[str, int]) -> dict[str, int]:
    """Counts of both; beyond ``VOTES`` texts, all lose what the first one too many has (frequent items stay)."""
    both = dict(a)
    for k, n in b.items():
        both[k] = both.get(k, 0) + n
    if len(both) <= VOTES:
        return both
    least = sorted(both.values(), reverse=True)[VOTES]
    return {k: n - least for k, n in both.items() if n > least}


def merged(x: list, y: list) -> list:
    return [x[0], x[1] or y[1], x[2] or y[2], x[3], x[4] + y[4], x[5] + y[5], votes_of(x[6], y[6])]


def flatten(items: list[list]) -> list[list]:
    """Each path once, optional and repeated: what an over-long expression is generalised to."""
    found: dict[str, list] = {}
    for signature, _, _, roles, pages, text, _ in items:
        paths = signature.split("|")
        for path, role in zip(paths, roles, strict=True):
            x = found.setdefault(path, [path, True, True, role, 0, 0, {}])
            x[4], x[5] = max(x[4], pages), x[5] + text // len(paths)
    return list(found.values())


def path_through(a: list[str], b: list[str]) -> list[tuple[int | None, int | None]]:
    """Both lists in order, equal elements of a longest common subsequence together."""
    if a == b:
        return [(i, i) for i in range(len(a))]
    rows, columns = len(a), len(b)
    best = [[0] * (columns + 1) for _ in range(rows + 1)]
    for i in range(rows - 1, -1, -1):
        for j in range(columns - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out: list[tuple[int | None, int | None]] = []
    i = j = 0
    while i < rows or j < columns:
        if i < rows and j < columns and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif j >= columns or i < rows and best[i + 1][j] >= best[i][j + 1]:
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out


def align(a: list[list], b: list[list]) -> list[list]:
    """The least general expression of this kind that covers both: shared items in order, the others optional."""
    out: list[list] = []
    for i, j in path_through([x[0] for x in a], [x[0] for x in b]):
        if i is not None and j is not None:
            new = merged(a[i], b[j])
        else:
            new = list(a[i] if j is None else b[j])
            new[1] = True
        if out and out[-1][0] == new[0]:  # repeats of one path side by side are one repeated group
            optional = out[-1][1] and new[1]
            out[-1] = merged(out[-1], new)
            out[-1][1:3] = optional, True
        else:
            out.append(new)
    return out if len(out) <= LONGEST else flatten(out)


def reader_of(wrapper: dict) -> list[tuple[str, str]]:
    """Each item's signature and what its blocks are: 2 content, 1 slots outside boilerplate, 0 template."""
    items = wrapper["items"]
    told = wrapper["pages"] >= PAGES and max(wrapper["copies"].values(), default=0) < COPIES * wrapper["pages"]

    def constant(x: list) -> bool:
        return told and x[4] >= PAGES and max(x[6].values(), default=0) >= CONSTANT * x[4]

    if any("m" in x[3] for x in items):

        def content(x: list, path: str, role: str) -> bool:
            return role == "m"
    else:
        slots = [(x[0].split("|")[0], x[5]) for x in items if "-" in x[3] and not constant(x)]
        dense, whole = densest(slots), sum(text for _, text in slots)

        def content(x: list, path: str, role: str) -> bool:
            heading = path.rpartition("/")[2][:2] in HEADINGS
            if path != dense and not path.startswith(f"{dense}/"):
                return role == "-" and path.rpartition("/")[2][:2] == "h1" and not constant(x)
            return role == "-" and (heading or not (constant(x) and x[5] < SMALL * whole))

    out = []
    for x in items:
        parts = zip(x[0].split("|"), x[3], strict=True)
        out.append((x[0], "".join("2" if content(x, p, r) else "1" if r != "b" and not constant(x) else "0" for p, r in parts)))
    return out


def densest(slots: list[tuple[str, int]]) -> str:
    """The innermost container that holds most of the slots' text."""
    mass: dict[str, int] = {"": 0}
    inside: dict[str, set[str]] = {}
    for path, text in slots:
        parts = path.split("/")
        for k in range(1, len(parts) + 1):
            here = "/".join(parts[:k])
            mass[here] = mass.get(here, 0) + text
            if k > 1:
                inside.setdefault("/".join(parts[: k - 1]), set()).add(here)
    at = ""
    while inside.get(at):
        best = max(sorted(inside[at]), key=mass.__getitem__)
        if best not in inside or mass[best] < DENSE * mass[at]:
            break
        at = best
    return at


class Reader:
    """Reads pages of one host by its wrapper."""

    def __init__(self, wrapper: str | None):
        self.items = [tuple(x) for x in json.loads(wrapper)] if wrapper else []
        self.by_path = {p: f for s, flags in self.items for p, f in zip(s.split("|"), flags, strict=True)}
        self.known: dict[tuple[str, ...], list[str]] = {}

    def flags(self, signatures: tuple[str, ...]) -> list[str]:
        """What each item of a page's expression is, by the wrapper's item that it matches."""
        if signatures not in self.known:
            if len(self.known) > 1000:
                self.known.clear()
            found = ["".join(self.by_path.get(p, "0") for p in s.split("|")) for s in signatures]
            for i, j in path_through(list(signatures), [s for s, _ in self.items]):
                if i is not None and j is not None:
                    found[i] = self.items[j][1]
            self.known[signatures] = found
        return self.known[signatures]

    def main_text(self, html: str) -> str:
        blocks = page_blocks(html)
        page = folded(blocks)
        if len(page) > LONGEST:
            kinds = [self.by_path.get(p, "0") for p, _, _ in blocks]
        else:
            kinds = [flags[k % len(flags)] for flags, (_, places) in zip(self.flags(tuple(x[0] for x, _ in page)), page, strict=True) for k in range(len(places))]
        for wanted in ("2", "1"):
            if wanted in kinds:
                return "\n".join(text for kind, (_, _, text) in zip(kinds, blocks, strict=True) if kind == wanted)
        return "\n".join(text for _, role, text in blocks if role != "b")


def with_host(pages: DataFrame) -> DataFrame:
    return doc_columns(pages, "page_id", "url", "html").withColumn("host", F.coalesce(F.lower(F.try_parse_url("url", F.lit("HOST"))), F.lit("")))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host and reader (JSON: each item of its wrapper and what it is), from every page."""

    def out(found: dict[str, dict], last: bool = False) -> pa.RecordBatch:
        texts = [json.dumps(reader_of(w) if last else w) for w in found.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(texts, pa.string())], names=["host", "wrapper"])

    def first(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, dict] = {}
        for b in batches(parts):
            for host, html in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                page = wrapper_of(page_blocks(html or ""))
                found[host] = unite(found[host], page) if host in found else page
            if len(found) >= 5000:  # many hosts: pass on what is known
                yield out(found)
                found = {}
        if found:
            yield out(found)

    def again(last: bool):
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Rows come sorted by host: only one host's wrapper is open at a time.
            host, whole = None, None
            for b in batches(parts):
                done: dict[str, dict] = {}
                for h, w in zip(b.column("host").to_pylist(), b.column("wrapper").to_pylist(), strict=True):
                    if h == host:
                        whole = unite(whole, json.loads(w))
                    else:
                        if host is not None:
                            done[host] = whole
                        host, whole = h, json.loads(w)
                if done:
                    yield out(done, last)
            if host is not None:
                yield out({host: whole}, last)

        return run

    schema = "host string, wrapper string"
    partial = map_arrow(with_host(pages).select("host", "html"), first, schema)
    salted = partial.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    salted = map_arrow(salted.repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper").select("host", "wrapper"), again(False), schema)
    return map_arrow(salted.repartition("host").sortWithinPartitions("host", "wrapper"), again(True), schema)


def extract_with(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page, read with the wrapper of its host."""
    size = wrappers.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host") + 64)).first()[0] or 0
    rows = with_host(pages).join(F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers, "host", "left").select("page_id", "url", "html", "wrapper")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers: dict[str | None, Reader] = {}
        for b in batches(parts):
            texts = []
            for html, w in zip(b.column("html").to_pylist(), b.column("wrapper").to_pylist(), strict=True):
                if w not in readers:
                    if len(readers) > 500:
                        readers.clear()
                    readers[w] = Reader(w)
                texts.append(readers[w].main_text(html or ""))
            yield pa.RecordBatch.from_arrays([b.column("page_id").cast(pa.int64()), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return map_arrow(rows, run, "page_id long, url string, text string, n_chars long")


def extract_main_text(pages: DataFrame) -> DataFrame:
    spark = prepare(pages.sparkSession)
    return extract_with(pages, stage(spark, infer_wrappers(pages), "wrappers"))
