"""HTML to a flat array of elements; everything after that is Spark SQL.

Spark has no HTML tokenizer, so one Arrow UDF walks the markup and reports the
few element kinds the page operators look at.  Choosing titles, paragraphs,
sections, links and climate cells from them is done with Column expressions.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ELEMENT = T.StructType(
    [T.StructField(name, T.IntegerType()) for name in ("n", "up")]
    + [
        T.StructField(name, T.StringType())
        for name in ("tag", "id", "css", "href", "lang", "colspan", "rowspan")
    ]
    + [T.StructField(name, T.BooleanType()) for name in ("in_body", "top")]
    + [T.StructField(name, T.IntegerType()) for name in ("section", "in_table")]
    + [T.StructField(name, T.StringType()) for name in ("label", "text", "tight")]
)

_KEPT = {"h1", "h2", "h3", "p", "a", "section", "table", "caption", "tr", "th", "td"}
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "source", "track", "wbr",
}
_KEPT_CLASSES = {"geo-dec", "mw-headline"}


class _Elements(HTMLParser):
    """Collects kept elements in document order.

    ``up`` is the ordinal of the parent if it was kept, ``in_table`` the one of
    the nearest table.  Which article body counts is only known at the end, see
    ``finish``.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[dict] = []
        # Open tags: name, kept element, number of the body it starts, is root.
        self.open: list[tuple[str, dict | None, int | None, bool]] = []
        self.bodies: list[bool] = []
        self.root_seen = False
        self.muted = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        attr = {k: v or "" for k, v in attrs}
        classes = set(attr.get("class", "").split())
        is_root = attr.get("id") == "mw-content-text"
        self.root_seen = self.root_seen or is_root
        element = None
        if tag in _KEPT or classes & _KEPT_CLASSES:
            element = self._element(tag, attr)
        body = None
        if tag == "div" and "mw-parser-output" in classes:
            body = len(self.bodies)
            self.bodies.append(any(o[3] for o in self.open))
        if tag in ("style", "script"):
            self.muted += 1
        if tag not in _VOID:
            self.open.append((tag, element, body, is_root))

    def _element(self, tag: str, attr: dict) -> dict:
        parent = self.open[-1] if self.open else ("", None, None, False)
        kept = [o[1] for o in self.open if o[1] is not None]
        element = {
            "n": len(self.found),
            "up": parent[1]["n"] if parent[1] else None,
            "tag": tag,
            "id": attr.get("id"),
            "css": attr.get("class"),
            "href": attr.get("aria-labelledby") if tag == "section" else attr.get("href"),
            "lang": attr.get("hreflang"),
            "colspan": attr.get("colspan"),
            "rowspan": attr.get("rowspan"),
            "in_table": next((k["n"] for k in reversed(kept) if k["tag"] == "table"), None),
            "label": attr.get("data-mw-section-id") if tag == "section" else None,
            "bodies": {o[2] for o in self.open if o[2] is not None},
            "parent_body": parent[2],
            "sections": [k for k in kept if k["tag"] == "section"],
            "raw": [],
        }
        self.found.append(element)
        return element

    def handle_endtag(self, tag: str) -> None:
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if at is None:
            return
        self.muted -= sum(o[0] in ("style", "script") for o in self.open[at:])
        del self.open[at:]

    def handle_data(self, data: str) -> None:
        if self.muted:
            return
        for _, element, _, _ in self.open:
            if element is not None:
                element["raw"].append(data)

    def finish(self) -> list[dict]:
        """Elements related to the article body: the first one inside the
        content root, or the first one of a page without a root."""
        wanted = [b for b, in_root in enumerate(self.bodies) if in_root or not self.root_seen]
        body = wanted[0] if wanted else -1
        for element in self.found:
            element["in_body"] = body in element.pop("bodies")
            element["top"] = element.pop("parent_body") == body
        for element in self.found:
            element["section"] = next((s["n"] for s in element.pop("sections") if s["top"]), None)
            raw = element.pop("raw")
            element["text"] = "".join(raw)
            element["tight"] = "".join(part.strip() for part in raw)
        return self.found


def _parse(html: str | None) -> list[dict]:
    parser = _Elements()
    parser.feed(html or "")
    parser.close()
    return parser.finish()


def whole_references(html: Column) -> Column:
    """Markup whose references without their semicolon (of a text cut short, say) are plain text."""
    return F.regexp_replace(html, r"&(?=(?:#[0-9]++|#[xX][0-9A-Fa-f]++|[A-Za-z][A-Za-z0-9]*+)(?!;))", "&amp;")


@F.pandas_udf(T.ArrayType(ELEMENT))
def html_elements(pages: pd.Series) -> pd.Series:
    """Kept elements of each page, in document order."""
    return pages.map(_parse)
