"""Link extraction from page text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import urls

# Parts of a page whose text is not markup; an unclosed one reaches to the end of the page.
_NOT_MARKUP = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"
_TAG = r"""(?i)<(?:a|link|i?frame)\b(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>"""
_ADDRESS = (
    r"""(?is)\A<(?:(?:a|link)\b.*?[\s"']href|i?frame\b.*?[\s"']src)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++)"""
)
# Character references that occur in addresses.
_REFERENCES = {"&quot;": '"', "&#34;": '"', "&#39;": "'", "&#x27;": "'", "&#38;": "&", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def hrefs(html: Column) -> Column:
    """Link addresses in page order as written: ``a`` and ``link`` hrefs, frame sources."""
    tags = F.regexp_extract_all(F.regexp_replace(html, _NOT_MARKUP, " "), F.lit(_TAG), F.lit(0))
    addresses = F.filter(F.transform(tags, lambda tag: F.regexp_extract(tag, _ADDRESS, 1)), lambda a: a != "")

    def clean(address: Column) -> Column:
        address = F.regexp_replace(address, r"""^["']|["']$""", "")
        for reference, character in _REFERENCES.items():
            address = F.replace(address, F.lit(reference), F.lit(character))
        return urls.strip(address)

    return F.transform(addresses, clean)


def links(page_url: Column, html: Column) -> Column:
    """``array<struct<pos, href, dst>>``: every http(s) link, resolved, without fragment."""
    resolved = F.transform(
        hrefs(html),
        lambda href, pos: F.struct(
            pos.cast("long").alias("pos"),
            href.alias("href"),
            urls.without_fragment(urls.resolve(page_url, href)).alias("dst"),
        ),
    )
    return F.filter(resolved, lambda x: x["dst"].rlike(r"^(?i:https?)://"))
