"""Text functions, all native expressions."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that strip() removes from both ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Entities frequent enough to decode with plain replaces. The
# ampersand comes last, so that no entity is decoded twice.
COMMON_ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&nbsp;": "\xa0",
    "&copy;": "\xa9",
    "&middot;": "\xb7",
    "&amp;": "&",
}

# What stands inside a tag. Quotes count only where a value begins, behind an equals sign;
# a quoted value may hold any character, another ends at white space or the tag's end.
# Taken without going back (possessive), so that a broken tag costs no more than its length.
INSIDE = r"""(?:[^>=]++|=++\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|))*+"""

# Markup that carries no text: comments, blocks of code (to the end of the page
# where they are not closed), tags. One scan from left to right, without
# look-around, which means the same in RE2.
MARKUP = (
    rf"(?is)<(?:!--.*?-->|script\b{INSIDE}>.*?(?:</script\s*>|\z)|style\b{INSIDE}>.*?(?:</style\s*>|\z)"
    rf"|template\b{INSIDE}>.*?(?:</template\s*>|\z)|[a-z/][^\s/>]*+{INSIDE}>|[!?][^>]*>)"
)

# Stands where markup was until entities are decoded, as none reaches across a
# tag. A code point that no text may contain.
GAP = "\uffff"

RARE_ENTITY = r"&(?!lt;|gt;|quot;|#39;|nbsp;|copy;|middot;|amp;)(?:#[0-9]|#[xX][0-9a-fA-F]|[a-zA-Z])"
ENTITY_OR_TEXT = r"(&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*;?)|[^&]+|&)"


def _literal_map(pairs: dict[str, str]) -> Column:
    """A constant map out of one literal, which keeps the plan short."""
    packed = "\x02".join(f"{key}\x01{value}" for key, value in pairs.items())
    return F.str_to_map(F.lit(packed), F.lit("\x02"), F.lit("\x01"))


def _code_point(number: Column) -> Column:
    """The character of a code point; the replacement character for impossible ones."""
    # Old pages number characters after the Windows code page in this range.
    old = {str(n): bytes([n]).decode("cp1252", "ignore") for n in range(0x80, 0xA0)}
    valid = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number <= 0x10FFFF))
    shown = F.when(number.isNotNull(), F.when(valid, number).otherwise(F.lit(0xFFFD)))
    packed = F.unhex(F.lpad(F.hex(shown), 8, "0"))
    remapped = F.try_element_at(_literal_map({k: v for k, v in old.items() if v}), number.cast("string"))
    return F.coalesce(remapped, F.decode(packed, "UTF-32"))


def _decode_token(token: Column) -> Column:
    # leading zeros do not count; more digits than a code point has stand for an impossible one
    digits = F.regexp_extract(token, r"^&#0*([0-9]+);?$", 1)
    hexes = F.regexp_extract(token, r"^&#[xX]0*([0-9a-fA-F]+);?$", 1)
    number = (
        F.when(F.greatest(F.length(digits), F.length(hexes)) > 9, F.lit("4294967295"))
        .when(digits != "", F.conv(digits, 10, 10))
        .when(hexes != "", F.conv(hexes, 16, 10))
        .cast("long")
    )
    # The named characters come from the standard table of the language.
    named = _literal_map({"&" + name: char for name, char in html5.items()})
    # names that need no semicolon may have other letters behind them: the longest counts
    bare = {"&" + name: char for name, char in html5.items() if not name.endswith(";")}
    short = _literal_map(bare)
    longest = [
        F.concat(F.try_element_at(short, F.substring(token, 1, n)), F.substring(token, n + 1, 1 << 20))
        for n in sorted({len(name) for name in bare}, reverse=True)
    ]
    known = F.coalesce(_code_point(number), F.try_element_at(named, token), *longest, token)
    return F.when(token.startswith("&"), known).otherwise(token)


def decode_entities(text: Column) -> Column:
    """Each entity decoded exactly once.

    Almost every text holds only common entities and takes the chain of
    replaces; the others are cut into tokens, which are looked up one by one.
    """
    chain = text
    for entity, char in COMMON_ENTITIES.items():
        chain = F.replace(chain, F.lit(entity), F.lit(char))
    tokens = F.regexp_extract_all(text, F.lit(ENTITY_OR_TEXT), F.lit(1))
    return (
        F.when(~F.contains(text, F.lit("&")), text)
        .when(text.rlike(RARE_ENTITY), F.array_join(F.transform(tokens, _decode_token), ""))
        .otherwise(chain)
    )


def html_to_text(html: Column) -> Column:
    """Text of a page without markup, entities decoded, ends stripped; null for empty input.

    Plain text, where no tag can begin or none can end and no entity stands,
    skips the scans. Otherwise the stripped text is bound to a name, so that it
    is computed once.
    """
    tags = F.contains(html, F.lit("<")) & F.contains(html, F.lit(">"))
    plain = ~tags & ~F.contains(html, F.lit("&"))
    stripped = F.array(F.regexp_replace(html, MARKUP, GAP))
    decoded = F.replace(F.get(F.transform(stripped, decode_entities), 0), F.lit(GAP), F.lit(""))
    return F.when(html != "", F.btrim(F.when(plain, html).otherwise(decoded), F.lit(WHITESPACE)))


def encode_name(name: Column) -> Column:
    """Percent-encoding of everything but unreserved characters; quotes are doubled."""
    encoded = F.url_encode(name)
    for found, wanted in (("+", "%20"), ("%7E", "~"), ("*", "%2A"), ("%27", "''")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def text_or_none(value: Column) -> Column:
    """The word ``None`` stands for a missing value inside a body."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def join_texts(values: Column) -> Column:
    """``a, b``; empty for an empty or missing list, missing members are left out."""
    return F.concat_ws(", ", values)


def join_field(values: Column, name: str, skip_empty: bool = False) -> Column:
    """``join_texts`` over one field of a list of structs."""
    texts = F.transform(values, lambda value: value[name])
    if skip_empty:
        texts = F.filter(texts, lambda text: text.isNotNull() & (text != ""))
    return join_texts(texts)


def first_text(values: Column) -> Column:
    return F.coalesce(F.get(values, 0), F.lit(""))
