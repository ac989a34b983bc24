"""Attachments: change window, parent join, text extraction."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemsync.functions.text import html_to_text
from itemsync.functions.times import local_text
from itemsync.operators.joins import skew_join
from itemsync.operators.quality import faults, set_aside
from itemsync.operators.shape import ENGINE_FIELDS, allow_permissions, zone_fault
from itemsync.operators.windows import change_window, chunk_index
from itemsync.options import JobOptions
from itemsync.schemas import ATTACHMENT_TYPES, DAY_COLUMN, DOCUMENT_FIELDS

Extractor = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

# Media whose text needs no parser, besides all other ``text/`` ones.
TEXT_MEDIA = ("application/json", "application/xml")
HTML_MEDIA = ("text/html", "application/xhtml+xml")
# Labels of charsets, by the charset that reads them (us-ascii as browsers do).
CHARSETS = {
    "UTF-8": "utf-8 utf8 unicode-1-1-utf-8",
    "UTF-16": "utf-16",
    "UTF-16LE": "utf-16le",
    "UTF-16BE": "utf-16be",
    "UTF-32": "utf-32",
    "ISO-8859-1": "iso-8859-1 latin1 l1",
    "windows-1252": "windows-1252 cp1252 us-ascii ascii x-cp1252",
    "ISO-8859-2": "iso-8859-2 latin2 l2",
    "ISO-8859-3": "iso-8859-3 latin3",
    "ISO-8859-4": "iso-8859-4 latin4",
    "ISO-8859-5": "iso-8859-5 cyrillic",
    "ISO-8859-6": "iso-8859-6 arabic",
    "ISO-8859-7": "iso-8859-7 greek",
    "ISO-8859-8": "iso-8859-8 iso-8859-8-i hebrew",
    "ISO-8859-9": "iso-8859-9 latin5",
    "ISO-8859-13": "iso-8859-13",
    "ISO-8859-15": "iso-8859-15 latin9",
    "windows-1250": "windows-1250 cp1250",
    "windows-1251": "windows-1251 cp1251",
    "windows-1253": "windows-1253 cp1253",
    "windows-1254": "windows-1254 cp1254",
    "windows-1255": "windows-1255 cp1255",
    "windows-1256": "windows-1256 cp1256",
    "windows-1257": "windows-1257 cp1257",
    "windows-1258": "windows-1258 cp1258",
    "windows-874": "windows-874 tis-620 iso-8859-11",
    "IBM866": "ibm866 cp866",
    "x-MacRoman": "macintosh x-mac-roman",
    "KOI8-R": "koi8-r koi8",
    "KOI8-U": "koi8-u",
    "GBK": "gbk gb2312 x-gbk",
    "GB18030": "gb18030",
    "Big5": "big5 big5-hkscs",
    "EUC-JP": "euc-jp",
    "ISO-2022-JP": "iso-2022-jp",
    "windows-31j": "shift_jis shift-jis sjis x-sjis windows-31j",
    "EUC-KR": "euc-kr ks_c_5601-1987",
}
#: Bytes at the start of a text that say its charset, in hex, and how many they are.
MARKS = (("EFBBBF", "UTF-8", 3), ("FEFF", "UTF-16BE", 2), ("FFFE", "UTF-16LE", 2))
#: Bytes of an HTML text in which it may state its charset.
META_BYTES = 1024
UNKNOWN_CHARSET = "unknown charset, read as UTF-8"
BAD_BYTES = "undecodable bytes replaced"


def attachments_of(
    items: DataFrame,
    attachments: DataFrame,
    start,
    end,
    same_chunk: int | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Attachments changed in ``[start, end)`` of the given items, with the owner's zone.

    ``items`` is already cut to its own window. ``same_chunk`` keeps pairs that
    fall into the same of so many time chunks. Both sides are filtered and
    pruned before the join; one parent may hold most of the attachments.
    ``sized_by`` are the items before their accounts were joined.
    """
    parents = items.filter("has_attachments").select(
        F.col("id").alias("parent_id"),
        "account",
        "timezone",
        zone_fault(items).alias("zone_fault"),
        *([chunk_index(items, "last_modified", start, end, same_chunk).alias("_chunk")] if same_chunk else []),
    )
    day = DAY_COLUMN if DAY_COLUMN in attachments.columns else None
    children = change_window(attachments, "last_modified", start, end, day=day).drop("account")
    if same_chunk:
        children = children.withColumn(
            "_own", chunk_index(children, "last_modified", start, end, same_chunk)
        )
    if sized_by is not None:
        sized_by = sized_by.select("id", "account")
    joined = skew_join(children, parents, "parent_id", spread=F.col("attachment_id"), sized_by=sized_by)
    return joined.filter("_own = _chunk").drop("_own", "_chunk") if same_chunk else joined


def attachment_rules() -> dict[str, Column]:
    """What every attachment needs: without an id it is no document, without a time in no window."""
    return {"no attachment_id": F.col("attachment_id").isNull(), "no last_modified": F.col("last_modified").isNull()}


def undated(attachments: DataFrame) -> DataFrame:
    """Attachments without a time: in no window, set aside with the reason."""
    return set_aside(attachments, {"no last_modified": F.col("last_modified").isNull()})[1]


def media_type(stated: Column) -> Column:
    """The media type alone: lower case, without parameters."""
    return F.lower(F.btrim(F.substring_index(stated, ";", 1)))


def stated_charset(content: Column, stated: Column) -> Column:
    """The label a text goes by: that of its media type, else of an HTML text's own ``<meta>``; empty without one."""
    named = F.regexp_extract(stated, r"""(?i);\s*charset\s*=\s*["']?([^"';\s]+)""", 1)
    html = F.when(media_type(stated).isin(*HTML_MEDIA), F.decode(F.substring(content, 1, META_BYTES), "ISO-8859-1"))
    inside = F.regexp_extract(html, r"""(?i)<meta\s[^>]*charset\s*=\s*["']?\s*([^"'\s/>;]+)""", 1)
    return F.lower(F.coalesce(F.nullif(named, F.lit("")), inside, F.lit("")))


def reading(content: Column, stated: Column) -> Column:
    """How to read bytes as text: struct of the charset, the bytes to skip, and whether the label is unknown.

    A byte-order mark goes before the stated label. Labels that are not known are read as UTF-8.
    """
    known = F.create_map(*(F.lit(x) for name, labels in CHARSETS.items() for label in labels.split() for x in (label, name)))
    label = stated_charset(content, stated)
    charset = F.when(label == "", F.lit("UTF-8")).otherwise(known[label])
    start = F.hex(F.substring(content, 1, 3))
    marked, skipped = F.lit(None).cast("string"), F.lit(0)
    for mark, name, size in MARKS:
        marked = F.when(start.startswith(mark), F.lit(name)).otherwise(marked)
        skipped = F.when(start.startswith(mark), F.lit(size)).otherwise(skipped)
    return F.struct(
        F.coalesce(marked, charset, F.lit("UTF-8")).alias("charset"),
        skipped.alias("skipped"),
        (marked.isNull() & charset.isNull()).alias("unknown"),
    )


def decoded(content: Column, how: Column) -> Column:
    """The bytes as text, read as ``reading`` says; what cannot be decoded becomes U+FFFD."""
    utf8 = how.charset == "UTF-8"
    data = F.when(how.skipped == 0, content).otherwise(F.substring(content, how.skipped + 1, F.length(content)))
    # only rows of another charset reach the decoder
    other = F.call_function("decode", F.when(~utf8, data), F.when(~utf8, how.charset))
    return F.when(utf8, F.make_valid_utf8(data.cast("string"))).otherwise(other)


def is_text(stated: Column) -> Column:
    """Whether the media need no parser."""
    media = media_type(stated)
    return media.isin(*HTML_MEDIA, *TEXT_MEDIA) | media.startswith("text/")


def native_text(content: Column, stated: Column, how: Column) -> Column:
    """Text of media that need no parser; null for every other kind."""
    text = decoded(content, how)
    return F.when(media_type(stated).isin(*HTML_MEDIA), html_to_text(text)).when(is_text(stated), text)


def text_fault(content: Column, stated: Column, how: Column) -> Column:
    """What was wrong with the bytes of a text; null if nothing or if it is none."""
    replaced = F.when(how.charset == "UTF-8", ~F.is_valid_utf8(content.cast("string"))).otherwise(
        decoded(content, how).contains("\ufffd")
    )
    found = faults(F.when(how.unknown, F.lit(UNKNOWN_CHARSET)), F.when(replaced, F.lit(BAD_BYTES)))
    return F.when(is_text(stated) & content.isNotNull(), found)


def with_text(attachments: DataFrame, extractor: Extractor | None = None) -> DataFrame:
    """Replace ``content`` by ``body`` and ``fault``, which says what was wrong with the bytes.

    Without an extractor everything stays in native expressions. An extractor is
    an Arrow-batched function that fills ``body`` of other media. Only rows that
    have content and no text yet reach it, after windowing and joining.
    """
    content, stated, how = F.col("content"), F.col("content_type"), F.col("_how")
    texts = attachments.withColumn("_how", reading(content, stated)).withColumns(
        {"body": native_text(content, stated, how), "fault": text_fault(content, stated, how)}
    ).drop("_how")
    if extractor is None:
        return texts.drop("content")
    todo = F.col("body").isNull() & F.col("content").isNotNull()
    parsed = texts.filter(todo)
    parsed = parsed.mapInPandas(extractor, parsed.schema)
    return texts.filter(~todo).unionByName(parsed).drop("content")


def fill_body(parse: Callable[[bytes, str], str | None]) -> Extractor:
    """An extractor out of a one-document parser, for rows that still lack text.

    A document on which the parser raises stays without text, and its ``fault`` names the error.
    """

    def tried(content: bytes, media: str) -> tuple[str | None, str | None]:
        try:
            return parse(content, media), None
        except Exception as error:
            return None, f"extractor: {type(error).__name__}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            todo = batch["body"].isna() & batch["content"].notna()
            found = [tried(c, m) for c, m in zip(batch.loc[todo, "content"], batch.loc[todo, "content_type"])]
            for at, name in enumerate(("body", "fault")):
                batch[name] = batch[name].astype(object)
                batch.loc[todo, name] = pd.Series([row[at] for row in found], index=batch.index[todo], dtype=object)
            yield batch

    return run


def attachment_documents(
    items: DataFrame,
    attachments: DataFrame,
    name: str,
    start,
    end,
    options: JobOptions,
    extractor: Extractor | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Attachment documents of one object. Their date goes to ``created``."""
    own = attachments.filter((F.col("object") == name) & F.col("attachment_id").isNotNull())
    joined = attachments_of(items, own, start, end, options.time_chunks if options.same_chunk else None, sized_by)
    texts = with_text(joined, extractor)
    stamp = local_text(F.col("last_modified"), F.col("timezone"))
    missing = F.lit(None).cast("string")
    return texts.select(
        F.lit(ATTACHMENT_TYPES[name]).alias("type"),
        F.col("attachment_id").cast("string").alias("id"),
        F.col("name").alias("title"),
        "body",
        missing.alias("url"),
        (stamp if options.unify_created else missing).alias("created_at"),
        (missing if options.unify_created else stamp).alias("created"),
        allow_permissions(F.col("account"), options.permissions).alias("_allow_permissions"),
        "account",
        F.lit(name).alias("object"),
        F.col("parent_id").cast("string").alias("parent_id"),
        "last_modified",
        F.lit(None).cast("boolean").alias("has_attachments"),
        faults(F.col("zone_fault"), F.col("fault")).alias("fault"),
    ).select(*DOCUMENT_FIELDS, *ENGINE_FIELDS)
