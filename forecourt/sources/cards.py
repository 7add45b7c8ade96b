"""Listing cards on HTML pages by simple selectors: one mapInPandas stage, pages to cards."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import fingerprint, vehicle_key
from ..functions.text import relative_url
from .pages import source_id_of_url

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCKS = "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
#: Start tag -> open elements that it ends.
_CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)} | {b: ("p",) for b in _BLOCKS}
_PART = re.compile(r"""([\w*]+)?((?:\.[\w-]+|\[class\*=['"]?[^'"\]]+['"]?\])*)""")


class _Node:
    __slots__ = ("tag", "attrs", "parent", "children", "texts")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children, self.texts = tag, attrs, parent, [], []

    def walk(self):
        """Descendants in document order; a stack instead of recursion, as broken pages nest without bound."""
        left = [c for c in reversed(self.children) if isinstance(c, _Node)]
        while left:
            node = left.pop()
            yield node
            left.extend(c for c in reversed(node.children) if isinstance(c, _Node))

    def text(self) -> str:
        left, parts = list(reversed(self.children)), []
        while left:
            part = left.pop()
            if isinstance(part, _Node):
                left.extend(reversed(part.children))
            else:
                parts.append(part)
        return re.sub(r"\s+", " ", " ".join(parts)).strip()


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__()
        self.root = self.at = _Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if self.at.tag in _CLOSED_BY.get(tag, ()):  # an end tag that HTML lets out
            self.at = self.at.parent
        node = _Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def _fits(node: _Node, part: str) -> bool:
    tag, rest = _PART.fullmatch(part).groups()
    kinds = node.attrs.get("class") or ""
    return (tag in (None, "*", node.tag)) and all(c[1:] in kinds.split() if c[0] == "." else c[8:-1].strip("'\"") in kinds for c in re.findall(r"\.[\w-]+|\[[^\]]+\]", rest or ""))


def select(node: _Node, selector: str) -> list[_Node]:
    """Descendants that meet a selector of tags, .class, [class*='x'], blanks, > and commas, in document order."""
    found = []
    for n in node.walk():
        for option in re.sub(r"::[\w-]+(\([^)]*\))?", "", selector).split(","):
            steps = re.sub(r"\s*>\s*", " > ", option).split()
            at, i, child = n, len(steps) - 1, False
            if i < 0 or not _fits(n, steps[i]):
                continue
            i -= 1
            while i >= 0:
                child = steps[i] == ">"
                i -= child
                at = at.parent
                while at is not None and at is not node.parent and not _fits(at, steps[i]) and not child:
                    at = at.parent
                if at is None or at is node.parent or not _fits(at, steps[i]):
                    break
                i -= 1
            if i < 0:
                found.append(n)
                break
    return found


def first_text(node: _Node, *selectors: str | None) -> str | None:
    return next((t for s in selectors if s for n in select(node, s) if (t := n.text())), None)


FIELDS = ("title", "price", "new_car_price", "reg_date", "mileage", "city", "battery_info", "battery_health", "fast_charge", "displacement", "gearbox", "emission")
# Where listing pages put dates and mileage if their own selectors meet nothing.
FALLBACKS = {"reg_date": ("span[class*='date']", "span[class*='info']"), "mileage": ("span[class*='km']", "span[class*='info']")}


def extract_cards(pages: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """pages(page_id, source, html), sources(key, base_url, selectors map) -> (raw cards, page errors). A page without a card is an
    error, a card without a title is passed over. The sources are a short list of descriptions, joined by key; one page is held at a time."""
    given = pages.join(sources.select(F.col("key").alias("source"), "base_url", F.to_json("selectors").alias("selectors")), "source").select("page_id", "source", "base_url", "selectors", "html")
    fields = ", ".join(f"{f} string" for f in FIELDS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        parsed: dict[str, dict] = {}  # one entry for each source
        for batch in batches:
            rows = []
            for page_id, source, base, selectors, html in batch.itertuples(index=False):
                if selectors not in parsed:
                    parsed[selectors] = json.loads(selectors)
                by, tree = parsed[selectors], _Tree()
                tree.feed(html or "")
                cards = [c for c in select(tree.root, by.get("card") or "") if first_text(c, by.get("title"))] if by.get("card") else []
                for ord_, card in enumerate(cards):
                    link = next((n.attrs["href"] for n in select(card, by.get("link") or "a") if n.attrs.get("href")), None)
                    texts = " ".join(t for n in select(card, by["range_info"]) if (t := n.text())) if by.get("range_info") else None
                    whole = card.text()
                    values = [first_text(card, by.get(f), *FALLBACKS.get(f, ())) for f in FIELDS]
                    if values[6] is None and "电池" in whole:
                        values[6] = whole
                    rows.append((page_id, source, base, ord_, link, *values, texts or (whole if "续航" in whole or "电池" in whole else None)))
                if not cards:
                    rows.append((page_id, source, base, -1, None, *[None] * len(FIELDS), None))
            yield pd.DataFrame(rows, columns=["page_id", "source", "base_url", "ord", "link", *FIELDS, "range_info"])

    made = given.mapInPandas(run, f"page_id long, source string, base_url string, ord int, link string, {fields}, range_info string")
    cards = made.filter("ord >= 0").withColumn("detail_url", relative_url("base_url", "link"))
    cards = cards.withColumn("source_id", source_id_of_url("detail_url"))
    named = {"title": "title_raw", "price": "price_raw", "new_car_price": "new_car_price_raw", "reg_date": "reg_date_raw", "mileage": "mileage_raw", "city": "city_raw", "battery_info": "battery_raw", "range_info": "range_raw", "battery_health": "battery_health_raw", "fast_charge": "fast_charge_raw", "displacement": "displacement_raw", "gearbox": "gearbox_raw", "emission": "emission_raw"}
    cards = cards.withColumnsRenamed(named).withColumn("vehicle_key", vehicle_key("source", "source_id", fingerprint("title_raw", "price_raw", "mileage_raw"))).drop("base_url", "link")
    return cards, made.filter("ord < 0").select("page_id", "source", F.lit("cards").alias("stage"), F.lit("no card on the page").alias("reason"))


def card_hits(cards: DataFrame, required: list[str]) -> DataFrame:
    """Hits of each field by source, and whether a required one has none."""
    fields = [c for c in cards.columns if c.endswith("_raw")]
    counts = cards.groupBy("source").agg(*[F.count(c).alias(c) for c in fields]).unpivot(["source"], fields, "field", "hits")
    return counts.withColumn("missing", F.col("field").isin(*required) & (F.col("hits") == 0))
