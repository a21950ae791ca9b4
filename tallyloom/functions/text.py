"""Text clean-up for report cells, all as JVM expressions."""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character a Unicode-aware strip removes, not only the ASCII blanks.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# References that stay escaped until a cell's text is taken, so that markup is never made out of text.
_KEPT = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
_REFERENCE = r"^(#0*[0-9]{1,7}|#[xX]0*[0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
_RESOLVABLE = r"&(?!(?:amp|lt|gt|quot|apos);)(?:#0*[0-9]{1,7}|#[xX]0*[0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def strip(c: Column) -> Column:
    """Remove leading and trailing white space."""
    return F.btrim(c, F.lit(WHITESPACE))


def drop_brackets(c: Column) -> Column:
    """'[P]' becomes 'P'."""
    return F.translate(c, "[]", "")


def slug(c: Column) -> Column:
    """'Duplicated (2 or more sites)' becomes 'duplicated_2_or_more_sites'."""
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))


def last_two(c: Column) -> Column:
    return F.right(c, F.lit(2))


def _named_entities() -> Column:
    """Entity names to characters, as one literal."""
    pairs = "\n".join(f"{name}={chr(code)}" for name, code in html.entities.name2codepoint.items() if name not in _KEPT)
    return F.str_to_map(F.lit(pairs), F.lit("\n"), F.lit("="))


def resolve_references(doc: Column) -> Column:
    """Turn named and numeric character references of a document into characters.

    The five references of XML itself are left for ``unescape``; unknown references stay as they are. A document
    without others is returned untouched. Each step below is its own pass over the short list of references.
    """
    parts = F.split(doc, "&")
    tail = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    named = F.transform(tail, lambda p: F.struct(p.alias("p"), F.regexp_extract(p, _REFERENCE, 1).alias("ref")))
    hexadecimal = lambda ref: F.conv(F.regexp_replace(ref, "^#[xX]0*", ""), 16, 10)
    coded = F.transform(
        named,
        lambda x: F.struct(
            x["p"].alias("p"), x["ref"].alias("ref"),
            F.when(x["ref"].rlike("^#[xX]"), hexadecimal(x["ref"])).when(x["ref"].startswith("#"), F.regexp_replace(x["ref"], "^#0*", ""))
            .try_cast("int").alias("code"),
        ),
    )
    valid = lambda code: code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    char = lambda x: F.when(
        valid(x["code"]), escape(F.decode(F.unhex(F.lpad(F.hex(x["code"]), 8, "0")), "UTF-32"))
    ).when(x["code"].isNull(), F.try_element_at(_named_entities(), x["ref"]))
    spelled = F.transform(coded, lambda x: F.struct(x["p"].alias("p"), x["ref"].alias("ref"), char(x).alias("char")))
    text = F.transform(
        spelled,
        lambda x: F.when(x["char"].isNull(), F.concat(F.lit("&"), x["p"]))
        .otherwise(F.concat(x["char"], F.substr(x["p"], F.length(x["ref"]) + 2))),
    )
    resolved = F.concat(F.get(parts, F.lit(0)), F.array_join(text, ""))
    return F.when(doc.rlike(_RESOLVABLE), resolved).otherwise(doc)


def unescape(c: Column) -> Column:
    """Decode XML's own references; the ampersand comes last."""
    out = c
    for name in ("lt", "gt", "quot", "apos", "amp"):
        out = F.replace(out, F.lit(f"&{name};"), F.lit(_KEPT[name]))
    return F.when(F.contains(c, F.lit("&")), out).otherwise(c)


def escape(c: Column) -> Column:
    """The inverse: text that can stand in a cell or in a quoted attribute."""
    for raw, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        c = F.replace(c, F.lit(raw), F.lit(ref))
    return c
