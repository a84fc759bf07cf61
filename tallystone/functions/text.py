"""Text column expressions (all JVM-side regex / higher-order functions).

Regex classes are written with ``\\x{..}`` escapes, which Java and RE2 both
accept, so the DuckDB oracle SQL can reuse the very same patterns.
"""

from __future__ import annotations

import functools
import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's ``str.isspace`` accepts (what ``\s`` means for str).
WS = (r"\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# Line boundaries of ``str.splitlines``.
LB = r"\n\r\x{0B}\f\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}"
# Whitespace that is not a line boundary.
SP = r"\t \x{1F}\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}"

WS_RUN = f"[{WS}]+"

# Comments and HTML subtrees whose text is never shown, in one left-to-right
# alternation (a tag inside a comment opens nothing, and the reverse); an
# element that is never closed hides the rest.
HTML_HIDDEN = (r"(?is)<!--.*?-->"
               r"|<script\b[^>]*>.*?(?:</script\s*>|\z)"
               r"|<style\b[^>]*>.*?(?:</style\s*>|\z)"
               r"|<noscript\b[^>]*>.*?(?:</noscript\s*>|\z)")
# Any markup tag; a > inside a quoted attribute does not end it.
HTML_TAG = r"""<[!/?a-zA-Z][^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*>|<[!/?a-zA-Z][^>]*>"""

# Fixed value (must equal the reference's for equal sections): the filing
# section header, e.g. "Item 1A. Risk Factors" — case-insensitive; the title
# is the first letter after the dot plus at most 100 more characters of the
# same line. Written with an explicit whitespace class so Java and RE2 agree.
SECTION_HEADER = rf"(?i)(Item[{WS}]+[0-9]+[A-Za-z]?\.[{WS}]*[A-Za-z][^\n]{{0,100}})"


def collapse_ws(c: Column) -> Column:
    """Unicode whitespace runs -> one space, then strip."""
    return F.trim(F.regexp_replace(c, WS_RUN, " "))


def normalize_header(c: Column) -> Column:
    """Header key: collapsed whitespace, stripped, lower case."""
    return F.lower(collapse_ws(c))


def clean_lines(c: Column) -> Column:
    """Per line: collapse whitespace and strip; drop blank lines; join by \\n.

    Done as four whole-text regex passes instead of split/transform/join.
    """
    s = F.regexp_replace(c, f"\r\n|[{LB}]", "\n")
    s = F.regexp_replace(s, f"[{SP}]+", " ")
    s = F.regexp_replace(s, " *\n[ \n]*", "\n")
    return F.regexp_replace(s, "^[ \n]+|[ \n]+$", "")


def _json_map(d: dict, value_type: str = "string") -> Column:
    # one JSON literal parsed to a map: a single constant for Catalyst to
    # fold, instead of thousands of literal columns built through py4j
    return F.from_json(F.lit(json.dumps(d, ensure_ascii=False)), f"map<string,{value_type}>")


@functools.lru_cache(maxsize=1)
def _entity_tables() -> tuple[dict, dict, str]:
    # From the standard library's HTML5 table (a rule, not a hand-made list):
    # names ending in ";" -> text; legacy names (also valid without ";").
    h5 = html.entities.html5
    full = {k[:-1]: v for k, v in h5.items() if k.endswith(";")}
    legacy = {k: v for k, v in h5.items() if not k.endswith(";")}
    # longest first, so the alternation takes the longest legacy prefix
    pattern = "^(" + "|".join(sorted(legacy, key=lambda k: (-len(k), k))) + ")"
    return full, legacy, pattern


def _named_entity_map() -> Column:
    return _json_map(_entity_tables()[0])


def _legacy_names_pattern() -> str:
    return _entity_tables()[2]


def _legacy_map() -> Column:
    return _json_map(_entity_tables()[1])


def _numeric_special_map() -> Column:
    # Code points an HTML5 parser replaces (windows-1252 range) or drops,
    # taken from the standard library's decoder tables when present.
    import html as _h
    repl = {str(k): v for k, v in getattr(_h, "_invalid_charrefs", {}).items()}
    for cp in getattr(_h, "_invalid_codepoints", ()):
        repl.setdefault(str(cp), "")
    return _json_map(repl)


def _codepoint_text(num: Column) -> Column:
    """Text of a numeric reference (NULL-safe): replacement rules first,
    U+FFFD for surrogates and values beyond U+10FFFF."""
    special = F.try_element_at(_numeric_special_map(), num.cast("string"))
    plain = F.decode(F.unhex(F.lpad(F.conv(num.cast("string"), 10, 16), 8, "0")), "UTF-32")
    return (F.when(special.isNotNull(), special)
            .when((num > 0x10FFFF) | num.between(0xD800, 0xDFFF), F.lit("\ufffd"))
            .otherwise(plain))


def decode_entities(c: Column) -> Column:
    """Decode character references in one left-to-right pass, HTML5 style.

    ``&name;`` from the full HTML5 table; legacy names also without ``;``
    (longest prefix: ``&ampx`` -> ``&x``, ``&notit;`` -> ``¬it;``);
    ``&#NNN`` / ``&#xHH`` with or without ``;``. The text is split on
    ``&``; each piece after the first starts right after an ampersand, so a
    reference is recognised at the start of the piece and replaced, otherwise
    the ampersand is put back. One pass means ``&amp;lt;`` becomes ``&lt;``.
    """
    from tallystone.functions import let
    ents, legacy_map, legacy_pat = _named_entity_map(), _legacy_map(), _legacy_names_pattern()
    pieces = F.split(c, "&", -1)

    def piece(p: Column) -> Column:
        dec = F.regexp_extract(p, r"^#([0-9]+);?", 1)
        hexd = F.regexp_extract(p, r"^#[xX]([0-9a-fA-F]+);?", 1)
        full = F.regexp_extract(p, r"^([^\t\n\f <&#;]{1,32});", 1)
        # the legacy table (106 names, the common ones) first; the full table
        # (a linear lookup over 2,231 names) only when that misses
        named = F.coalesce(F.try_element_at(legacy_map, full), F.try_element_at(ents, full))
        leg = F.regexp_extract(p, legacy_pat, 1)
        big = F.lit(0x110000).cast("long")
        dec_num = F.when(F.length(dec) > 8, big).otherwise(dec.cast("long"))
        hex_num = F.when(F.length(hexd) > 7, big).otherwise(F.conv(hexd, 16, 10).cast("long"))
        return (F.when(dec != "", F.concat(_codepoint_text(dec_num),
                                           F.regexp_replace(p, r"^#[0-9]+;?", "")))
                .when(hexd != "", F.concat(_codepoint_text(hex_num),
                                           F.regexp_replace(p, r"^#[xX][0-9a-fA-F]+;?", "")))
                .when(named.isNotNull(), F.concat(named, F.substring(p, F.length(full) + 2, 1 << 30)))
                .when(leg != "", F.concat(F.try_element_at(legacy_map, leg),
                                          F.substring(p, F.length(leg) + 1, 1 << 30)))
                .otherwise(F.concat(F.lit("&"), p)))

    return F.when(F.instr(c, "&") == 0, c).otherwise(let(pieces, lambda ps: F.concat(
        F.element_at(ps, 1), F.array_join(F.transform(F.slice(ps, 2, 1 << 30), piece), ""))))


def html_to_text_expr(html_col: Column) -> Column:
    """HTML -> visible text, one text node per line (see ``html_to_text``)."""
    s = F.regexp_replace(html_col, HTML_HIDDEN, "\n")
    s = F.regexp_replace(s, HTML_TAG, "\n")
    s = decode_entities(s)
    return clean_lines(s)


def word_tokens(c: Column) -> Column:
    """Whitespace-separated words (the default token of the chunker)."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), WS_RUN), lambda t: t != "")


def quote_literal_regex(s: str) -> str:
    """A Java regex matching ``s`` literally."""
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"
