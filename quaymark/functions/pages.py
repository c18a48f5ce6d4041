"""Pages of portals (inventory X12-X15, X17, J16, F13, F14, F18): links, ids, fields and signals.

Parsing needs an HTML parser, so pages go through Arrow batches of one page each call; nothing else does.
"""

from __future__ import annotations

import json
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import Cols, _c

#: Elements without an end tag, and elements whose text is not shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template svg iframe".split())
#: Open elements that a new one ends, and elements beyond which none is ended.
ENDS = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "li": ("li",), "p": ("p",), "option": ("option",)}
WALLS = frozenset("table ul ol div section article select body".split())
#: Main containers in the order in which they are tried, and the length of a page that is sent.
SELECTORS = ((None, "content_body"), ("main", None), ("article", None), ("body", None))
LONGEST = 12_000


class Node:
    """An element: tag, attributes, children (elements and strings)."""

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []

    def classes(self) -> list[str]:
        return self.attributes.get("class", "").split()

    def walk(self):
        yield self
        for c in self.children:
            if isinstance(c, Node):
                yield from c.walk()

    def find(self, *steps: str) -> list[Node]:
        """Elements below that match a path of simple selectors (tag, .class or #id), in page order."""
        found = [self]
        for step in steps:
            found = list(dict.fromkeys(n for f in found for n in f.walk() if n is not f and n.matches(step)))
        return found

    def matches(self, step: str) -> bool:
        if step.startswith("#"):
            return self.attributes.get("id") == step[1:]
        tag, _, name = step.partition(".")
        return (not tag or self.tag == tag) and (not name or name in self.classes())

    def text(self, between: str = "") -> str:
        parts: list[str] = []
        for n in self.pieces():
            if t := n.strip():
                parts.append(t)
        return between.join(parts)

    def pieces(self):
        for c in self.children:
            if isinstance(c, str):
                yield c
            elif c.tag not in HIDDEN:
                yield from c.pieces()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in ENDS.get(tag, ()):
                del self.open[k:]
            elif self.open[k].tag in WALLS:
                break
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                break

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def json_blocks(html: str | None) -> list[dict]:
    """Objects of the page's JSON-LD scripts in order; broken scripts are passed over."""
    found: list[dict] = []
    for n in parse(html).walk():
        if n.tag == "script" and n.attributes.get("type") == "application/ld+json":
            try:
                payload = json.loads("".join(c for c in n.children if isinstance(c, str)).strip())
            except ValueError:
                continue
            found += [x for x in (payload if isinstance(payload, list) else [payload]) if isinstance(x, dict)]
    return found


def ld_fields(html: str | None) -> dict:
    """The first offer's price, the first posted and modified dates, and the schema of an estate agent as JSON."""
    price = posted = updated = ""
    agent = None
    for x in json_blocks(html):
        offer = x.get("offers")
        if not price and isinstance(offer, dict) and offer.get("price") is not None:
            price = str(offer["price"])
        posted = posted or " ".join(str(x.get("datePosted") or x.get("datePublished") or "").split())
        updated = updated or " ".join(str(x.get("dateModified") or "").split())
        if agent is None and x.get("@type") == "RealEstateAgent":
            agent = json.dumps(x, ensure_ascii=False, sort_keys=True)
    return {"price": price, "posted": posted, "updated": updated, "agent": agent}


def listing_links(html: str | None, base: str, mark: str) -> list[str]:
    """Addresses with ``mark`` in item lists of the page's JSON-LD, each once; without any, those of its anchors."""
    found = [e.get("url") for x in json_blocks(html) if isinstance(x.get("itemListElement"), list) for e in x["itemListElement"] if isinstance(e, dict)]
    links = list(dict.fromkeys(u for u in found if isinstance(u, str) and mark in u))
    if links:
        return links
    hrefs = (n.attributes.get("href", "") for n in parse(html).find("a.detail_page"))
    return list(dict.fromkeys(u for h in hrefs if h and mark in (u := base + h if h.startswith("/") else h)))


def detail_fields(html: str | None) -> dict | None:
    """Fields of a listing's page; null if its content is not there."""
    root = parse(html)
    body = next(iter(root.find(".content_body", ".ten")), None)
    if body is None:
        return None

    def first(*steps: str, between: str = "") -> str:
        found = body.find(*steps)
        return found[0].text(between) if found else ""

    contacts = []
    for c in body.find(".contactsDiv"):
        header = c.find(".header")
        numbers = [t.replace("代理個人牌照號碼:", "").strip() for s in c.find(".content", "span.less_span") if "牌照號碼" in (t := s.text())]
        contacts.append({"name": header[0].text() if header else "", "license_no": numbers[-1] if numbers else None})
    dates = first(".propertyDate", between=" ").split("|")
    info = {}
    for row in body.find("table.tablePair", "tr"):
        name, value = row.find("td.table_left"), row.find(".pairValue")
        if name and value:
            info[name[0].text(" ")] = value[0].text(" ")
    return {
        "location_parts": [s.text() for s in root.find("ol.breadcrumb", "a", "span") if s.attributes.get("itemprop") == "name"][2:],
        "title": first(".message", ".header"),
        "description": first("#desc_normal", between="\n"),
        "labels": [x.text() for x in body.find(".labels", ".label")],
        "contacts": contacts,
        "posted": dates[0].replace("刊登:", "").strip(),
        "updated": dates[1].replace("更新:", "").strip() if len(dates) > 1 else "",
        "info": info,
        "images": list(dict.fromkeys(s for i in root.find(".slider-block", "img") if (s := i.attributes.get("src")))),
    }


def page_for_model(html: str | None, longest: int = LONGEST) -> str:
    """Text of the first main container that the page has, without hidden elements, up to a length."""
    root = parse(html)
    for tag, name in SELECTORS:
        found = root.find(f"{tag or ''}.{name}" if name else tag)
        if found:
            return found[0].text("\n")[:longest]
    return root.text("\n")[:longest]


#: Elements and classes that are no content, and containers of the content.
DROPPED = ("script", "style", "noscript", "svg", "canvas", "form", "iframe", "header", "footer", "nav", "aside", ".sidebar", ".menu", ".breadcrumb", ".ads", ".advertisement", ".cookie", ".popup")
CONTENT = ("main", "article", ".article", ".post", "#content", ".content")


def _table_lines(number: int, table: Node) -> list[str]:
    """A table as text: a title, and a line a row, with its headers before the values if it has as many."""
    rows = [[c for c in r.walk() if c.tag in ("th", "td")] for r in table.find("tr")]
    if not rows:
        return []
    clean = lambda c: " ".join(c.text(" ").split())
    heads = [clean(c) for c in rows[0]] if any(c.tag == "th" for c in rows[0]) else []
    lines = []
    for row in rows[1:] if heads else rows:
        cells = list(filter(None, map(clean, row)))
        if cells:
            lines.append("; ".join(f"{h}: {v}" for h, v in zip(heads, cells, strict=True) if h) if heads and len(heads) == len(cells) else " | ".join(cells))
    named = " | ".join(filter(None, heads))
    return [f"Table {number}: {named}" if named else f"Table {number}", *lines] if lines else []


def clean_page(html: str | None) -> dict[str, str]:
    """X11: the title, and the text of the first content container without what is no content; tables follow as lines."""
    root = parse(html)
    title = next((" ".join("".join(c for c in n.children if isinstance(c, str)).split()) for n in root.walk() if n.tag == "title"), "")
    for n in list(root.walk()):
        n.children = [c for c in n.children if isinstance(c, str) or not any(c.matches(d) for d in DROPPED)]
    found = [n for n in root.walk() if n.tag and any(n.matches(c) for c in CONTENT)] or root.find("body") or [root]
    target = found[0]
    tables = ["\n".join(lines) for k, t in enumerate(target.find("table"), 1) if (lines := _table_lines(k, t))]
    for n in list(target.walk()):
        n.children = [c for c in n.children if isinstance(c, str) or c.tag != "table"]
    text = "\n".join(filter(None, (" ".join(line.split()) for line in target.text("\n").split("\n"))))
    return {"title": title, "text": text + ("\n\nStructured tables\n" + "\n\n".join(tables) if tables else "")}


def agents_of(html: str | None) -> list[dict]:
    """Name, phone and licence of every agent's block of a company's page that has a licence."""
    out = []
    for n in parse(html).find(".agent"):
        name, licence = n.find(".name"), n.find(".license")
        tel = [a.attributes.get("href", "") for a in n.find("a") if a.attributes.get("href", "").startswith("tel:")]
        if licence and licence[0].text():
            out.append({"name": name[0].text() if name else "", "phone": tel[0].removeprefix("tel:") if tel else "", "license": licence[0].text()})
    return out


_DETAIL = "location_parts array<string>, title string, description string, labels array<string>, contacts array<struct<name:string,license_no:string>>, posted string, updated string, info map<string,string>, images array<string>"


def _rows(f, schema: str):
    @F.pandas_udf(schema)
    def run(html: pd.Series) -> pd.DataFrame:
        found = [f(h) or {} for h in html]
        names = [n.split()[0] for n in schema.replace("struct<name:string,license_no:string>", "s").split(", ")]
        return pd.DataFrame({n: pd.Series([x.get(n) for x in found], dtype=object) for n in names})

    return run


def ld_json(html: Cols) -> Column:
    """X17 as a column: a struct of price, posted, updated and agent."""
    return _rows(ld_fields, "price string, posted string, updated string, agent string")(_c(html))


def cleaned(html: Cols) -> Column:
    """X11 as a column: a struct of title and text."""
    return _rows(clean_page, "title string, text string")(_c(html))


def details(html: Cols) -> Column:
    """X13 as a column: a struct of fields, null fields where the page has no content."""
    return _rows(detail_fields, _DETAIL)(_c(html))


def links_of(html: Cols, base: str, mark: str) -> Column:
    """X14 as a column: an array of addresses."""

    @F.pandas_udf("array<string>")
    def run(html: pd.Series) -> pd.Series:
        return pd.Series([listing_links(h, base, mark) for h in html], dtype=object)

    return run(_c(html))


def model_text(html: Cols, longest: int = LONGEST) -> Column:
    """X12 as a column."""

    @F.pandas_udf("string")
    def run(html: pd.Series) -> pd.Series:
        return pd.Series([page_for_model(h, longest) for h in html], dtype=object)

    return run(_c(html))


def agents(html: Cols) -> Column:
    """J16 as a column: an array to be exploded."""

    @F.pandas_udf("array<struct<name:string,phone:string,license:string>>")
    def run(html: pd.Series) -> pd.Series:
        return pd.Series([agents_of(h) for h in html], dtype=object)

    return run(_c(html))


def source_fields(url: Cols, portal: str) -> Column:
    """Id, type and post_type of a listing from the last three parts of its path; null where it has fewer.

    The source id is the portal and what follows the last dash of the last part.
    """
    path = F.regexp_extract(_c(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    at = lambda k: F.try_element_at(parts, F.lit(k))
    found = F.struct(
        F.concat(F.lit(f"{portal}-"), F.element_at(F.split(at(-1), "-"), -1)).alias("source_id"),
        at(-1).alias("prop_id"), at(-2).alias("prop_type"), at(-3).alias("post_type"),
    )
    return F.when(F.size(parts) >= 3, found)


def due_review(reviewed: Cols, status: Cols, now: int, hours: int = 6) -> Column:
    """never reviewed, or not in the last hours, and not archived."""
    return (_c(reviewed).isNull() | (_c(reviewed) <= now - hours * 3600)) & ~_c(status).eqNullSafe(F.lit("archived"))


def stale(updated: Cols, now: int, days: int = 3) -> Column:
    """not scraped in the last days."""
    return F.coalesce(now - _c(updated) >= days * 86400, F.lit(True))


#: Words of a page whose listing is gone.
GONE = ("樓盤已過期", "此樓盤已被隱藏")


def removed(status: Cols, url: Cols, final_url: Cols, html: Cols) -> Column:
    """the page was not answered, led elsewhere (a slash at the end aside), or says that the listing is gone."""
    moved = F.rtrim(F.coalesce(_c(final_url), F.lit("")), F.lit("/")) != F.rtrim(_c(url), F.lit("/"))
    says = F.lit(False)
    for w in GONE:
        says = says | F.coalesce(_c(html), F.lit("")).contains(w)
    return F.coalesce(_c(status) >= 400, F.lit(True)) | moved | says
