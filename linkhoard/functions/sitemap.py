"""Sitemap document columns: body decoding, kind, and listed locations."""

from __future__ import annotations

import codecs
import re
import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from . import urls

INDEX, URLSET, OTHER, PLAIN = "index", "urlset", "other", "plain"

_LOCATIONS = "array<struct<loc:array<string>>>"
_XML_SCHEMA = f"url {_LOCATIONS}, sitemap {_LOCATIONS}, _corrupt string"
_XML_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
_PROLOG = r"(?s)\A(?:\s++|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*+(?:\[.*?\]\s*+)?>)*+"
_EPILOG = r"(?s)(?:\s++|<!--(?:(?!-->).)*+-->|<\?(?:(?!\?>).)*+\?>)*+\z"


# Encodings that are read as UTF-8. A declaration that can be read byte by byte isn't in UTF-16, whatever it says.
_AS_UTF8 = ("utf-8", "utf8", "us-ascii", "ascii", "utf-16", "utf-16le", "utf-16be", "utf-32", "utf-32le", "utf-32be", "ucs-2", "ucs-4")
_DECLARED = r"""(?is)\A\s*<\?xml\b[^>]*?\bencoding\s*=\s*["']([\w.:-]+)["']"""
_HEAD = 512


def _readers():
    # Defined inside a function so that tasks get them by value and need no package on their path.
    as_utf8, head = _AS_UTF8, _HEAD
    declaration = re.compile(_DECLARED)
    marks = (
        (codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF32_LE, "utf-32-le"), (codecs.BOM_UTF32_BE, "utf-32-be"),
        (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"),
    )

    def first_member(body):
        if body is None:
            return None
        reader = zlib.decompressobj(wbits=31)
        try:
            content = reader.decompress(body)
        except zlib.error:
            return body
        return content if reader.eof else body

    def encoding(content):
        for mark, name in marks:
            if content.startswith(mark):
                return name
        if 0 in content[:2]:
            return "utf-16-be" if content[0] == 0 else "utf-16-le"
        declared = declaration.match(content[:head].decode("latin-1"))
        return declared.group(1).lower() if declared else "utf-8"

    def in_utf8(body):
        if body is None:
            return None
        content = first_member(body)
        name = encoding(content)
        if name in as_utf8:
            return content
        try:
            return content.decode(name).encode()
        except (LookupError, ValueError):
            return None

    def gunzipped(bodies: pd.Series) -> pd.Series:
        return bodies.map(first_member)

    def readable(bodies: pd.Series) -> pd.Series:
        return bodies.map(in_utf8)

    return F.pandas_udf(gunzipped, BinaryType()), F.pandas_udf(readable, BinaryType())


gunzip, _readable = _readers()
"""First gzip member of each body, a broken stream being returned unchanged; the same in UTF-8, NULL where it can't be decoded."""


def _zipped(body: Column) -> Column:
    return F.substring(body, 1, 2) == F.unhex(F.lit("1F8B"))


def _foreign(body: Column) -> Column:
    """True for bodies that don't begin as UTF-8 does: another byte order mark, zero bytes as in UTF-16, another encoding declared."""
    head = F.decode(F.substring(body, 1, _HEAD), "ISO-8859-1")
    declared = F.lower(F.regexp_extract(head, _DECLARED, 1))
    return head.rlike(r"(?s)\A(?:\xFE\xFF|\xFF\xFE|\x00|.\x00)") | ~declared.isin("", *_AS_UTF8)


def decode_body(body: Column) -> Column:
    """Uncompressed body, ``''`` for NULL. Only gzip streams are sent through the Arrow function."""
    return F.coalesce(gunzip(F.when(_zipped(body), body)), body, F.lit("").cast("binary"))


def readable_body(body: Column) -> Column:
    """Uncompressed body in UTF-8, ``''`` for NULL; NULL if its encoding can't decode it or isn't known.

    A byte order mark decides, then zero bytes, then the XML declaration. Only gzip streams and bodies in other encodings
    are sent through the Arrow function. Bytes that are no UTF-8 stay as they are in a body without mark and declaration.
    """
    sent = F.coalesce(_zipped(body) | _foreign(body), F.lit(False))
    return F.when(sent, _readable(F.when(sent, body))).otherwise(F.coalesce(body, F.lit("").cast("binary")))


def text(body: Column) -> Column:
    return F.ltrim(body.cast("string"), F.lit("﻿"))


def root_name(content: Column) -> Column:
    """Local name of the root element; NULL when the text has none."""
    name = F.regexp_extract(
        F.regexp_replace(content, _PROLOG, ""), r"\A<(?:[\p{L}_][\w.\-]*:)?([\p{L}_][\p{L}\w.\-]*)", 1
    )
    return F.when(name != "", name)


def _closes_once(content: Column, root: Column) -> Column:
    """The root element is closed exactly once and nothing but comments follows it.

    ``from_xml`` stops reading after the first root element, so a second one or trailing text
    has to be found here. Only tags with the root's own name are extracted.
    """
    tags = F.regexp_extract_all(
        content, F.concat(F.lit(r"</?(?:[\w.\-]+:)?"), root, F.lit(r"(?=[\s/>])[^>]*+>")), F.lit(0)
    )
    state = F.aggregate(
        tags,
        F.struct(F.lit(0).alias("depth"), F.lit(0).alias("closed")),
        lambda s, tag: F.struct(
            F.when(tag.startswith("</"), s["depth"] - 1)
            .when(tag.endswith("/>"), s["depth"])
            .otherwise(s["depth"] + 1)
            .alias("depth"),
            (
                s["closed"]
                + F.when(
                    (tag.startswith("</") & (s["depth"] == 1)) | (tag.endswith("/>") & (s["depth"] == 0)), 1
                ).otherwise(0)
            ).alias("closed"),
        ),
    )
    last_tag = F.try_element_at(tags, F.lit(-1))
    trimmed = F.rtrim(content, F.lit(urls.WHITESPACE))
    trimmed = F.when(trimmed.endswith("-->") | trimmed.endswith("?>"), F.regexp_replace(trimmed, _EPILOG, "")).otherwise(
        trimmed
    )
    return (state["closed"] == 1) & trimmed.endswith(last_tag)


def _locations(nodes: Column) -> Column:
    """Stripped, non-blank ``loc`` texts in document order."""
    none = F.array().cast("array<string>")
    locs = F.flatten(F.transform(nodes, lambda n: F.coalesce(n["loc"], none)))
    return F.coalesce(F.filter(F.transform(locs, urls.strip), lambda u: u != ""), none)


def _dropped_locations(nodes: Column) -> Column:
    """How many nodes and ``loc`` texts give no location: nodes without a ``loc``, and blank ones."""
    return F.coalesce(
        F.aggregate(
            nodes,
            F.lit(0).cast("long"),
            lambda n, node: n
            + F.when(F.coalesce(F.size(node["loc"]), F.lit(0)) <= 0, 1).otherwise(F.size(F.filter(node["loc"], lambda u: urls.is_blank(u)))),
        ),
        F.lit(0).cast("long"),
    )


def plain_lines(content: Column) -> Column:
    """Stripped lines that are http(s) URLs."""
    return F.filter(F.transform(F.split(content, "\n", -1), urls.strip), urls.is_http_url)


def document_reader(out: str, body: str = "body") -> Callable[[DataFrame], DataFrame]:
    """A step that adds ``out``, a ``struct<kind, root_name, page_locs, child_locs, dropped>`` read from a body column.

    ``dropped`` counts the entries of an XML document without a location, and the lines of a text that are neither blank nor URLs.
    A body that can't be decoded is an empty text and counts as one.

    Text that is not a well-formed XML document is read as one URL per line. The parts are columns
    of their own so that each document is decoded and parsed once.
    """
    content, xml, root, well_formed = (F.col(c) for c in ("_text", "_xml", "_root", "_well_formed"))
    is_index = well_formed & (root == "sitemapindex")
    none = F.array().cast("array<string>")
    document = F.struct(
        F.when(~well_formed, PLAIN)
        .when(root == "sitemapindex", INDEX)
        .when(root == "urlset", URLSET)
        .otherwise(OTHER)
        .alias("kind"),
        F.when(well_formed, root).alias("root_name"),
        F.when(is_index, none)
        .when(well_formed, _locations(xml["url"]))
        .otherwise(plain_lines(content))
        .alias("page_locs"),
        F.when(is_index, _locations(xml["sitemap"])).otherwise(none).alias("child_locs"),
        F.when(F.col("_bytes").isNull(), F.lit(1).cast("long"))
        .when(is_index, _dropped_locations(xml["sitemap"]))
        .when(well_formed, _dropped_locations(xml["url"]))
        .otherwise(F.size(F.filter(F.split(content, "\n", -1), lambda line: ~urls.is_blank(line) & ~urls.is_http_url(urls.strip(line)))).cast("long"))
        .alias("dropped"),
    )
    checked = root.isNotNull() & xml["_corrupt"].isNull() & _closes_once(content, root)
    parts = {
        "_bytes": readable_body(F.col(body)),
        "_text": F.coalesce(text(F.col("_bytes")), F.lit("")),
        "_xml": F.from_xml(content, _XML_SCHEMA, _XML_OPTIONS),
        "_root": root_name(content),
        "_well_formed": F.coalesce(checked, F.lit(False)),
        out: document,
    }

    def read(df: DataFrame) -> DataFrame:
        for name, part in parts.items():
            df = df.withColumn(name, part)
        return df.drop("_bytes", "_text", "_xml", "_root", "_well_formed")

    return read


def with_document(df: DataFrame, out: str, body: str = "body") -> DataFrame:
    """``document_reader`` applied once."""
    return document_reader(out, body)(df)
