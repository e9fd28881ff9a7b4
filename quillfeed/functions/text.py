"""HTML/text column expressions (PRJ8 scrub, PRJ9 to-text, PRJ10 unescape, FLT2 word filter).

Everything here is a JVM-side ``Column`` expression: no Python worker, and no
character is looked at row by row outside the regex engine.
"""

import json
import re
from html.entities import html5 as HTML_ENTITIES

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Tags the scrubber keeps (the HTML sanitiser's public default allow-list).
ALLOWED_TAGS = ("a", "abbr", "acronym", "b", "blockquote", "code", "em", "i", "li", "ol", "strong", "ul")
# ---------------------------------------------------------------------------

COMMENT_RE = r"(?s)<!--.*?-->"
TAG_RE = r"<[a-zA-Z/!][^>]*>"  # a bare "<" is text
# Attributes that stay, by tag (the sanitiser's public defaults), and the schemes a link may have.
ALLOWED_ATTRIBUTES = {"a": ("href", "title"), "abbr": ("title",), "acronym": ("title",)}
LINK_SCHEMES = ("http", "https", "mailto")
# Pieces of marked-up text: a comment, a tag (quoted attribute values may hold ">"), any other "<...>", a text, a lone
# "<". The count limits the depth of the matcher's stack; a tag with more quoted values ends at its first ">".
MARKUP_PIECE_RE = (r"""(?s)<!--.*?(?:-->|\z)|</?[a-zA-Z](?:[^"'<>]++|"[^"]*+"|'[^']*+'){0,200}+>|<[a-zA-Z/!?][^>]*+>|[^<]++|<""")
ATTRIBUTE_RE = r"""(?s)([^\s"'<>/=]+)(?:\s*=\s*("[^"]*+"|'[^']*+'|[^\s"'>]++))?"""
SCRIPT_STYLE_RE = r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>"


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _attribute(found: Column, name: str) -> Column:
    """`` name="value"`` of the first attribute of that name, its quotes escaped; empty without one."""
    def written(raw: Column) -> Column:
        bare = F.when(raw.rlike("""^["']"""), F.substring(raw, 2, F.length(raw) - 2)).otherwise(raw)
        text = F.concat(F.lit(f' {name}="'), F.replace(F.replace(bare, F.lit('"'), F.lit("&quot;")), F.lit("<"), F.lit("&lt;")), F.lit('"'))
        if name == "href":
            scheme = F.lower(F.regexp_extract(F.regexp_replace(raw, r"[\x00-\x20\"']+", ""), r"^([^:/?#]*):", 1))
            text = F.when((scheme == "") | scheme.isin(*LINK_SCHEMES), text)
        return F.coalesce(text, F.lit(""))

    mine = F.filter(found, lambda x: x.startswith(f"{name}="))
    return _bind(F.substring(F.try_element_at(mine, F.lit(1)), len(name) + 2, 1 << 30), written)


def _scrubbed_tag(piece: Column, name: Column) -> Column:
    """An allowed tag with its allowed attributes in the order of their names."""
    def kept(found: Column) -> Column:
        parts = []
        for attribute in sorted({x for names in ALLOWED_ATTRIBUTES.values() for x in names}):
            tags = [t for t, names in ALLOWED_ATTRIBUTES.items() if attribute in names]
            parts.append(F.when(name.isin(*tags), _attribute(found, attribute)).otherwise(""))
        return F.concat(F.lit("<"), name, *parts, F.lit(">"))

    # What follows the tag's name, as attributes in turn: a name inside a quoted value is none.
    found = F.transform(F.regexp_extract_all(F.regexp_replace(piece, r"^<[a-zA-Z][^\s/>]*", ""), F.lit(ATTRIBUTE_RE), 0),
                        lambda x: F.concat(F.lower(F.regexp_extract(x, ATTRIBUTE_RE, 1)), F.lit("="), F.regexp_extract(x, ATTRIBUTE_RE, 2)))
    return (F.when(~name.isin(*ALLOWED_TAGS), "")
            .when(piece.startswith("</"), F.concat(F.lit("</"), name, F.lit(">")))
            .when(name.isin(*ALLOWED_ATTRIBUTES) & piece.contains("="), _bind(found, kept))
            .otherwise(F.concat(F.lit("<"), name, F.lit(">"))))


def _scrubbed_piece(piece: Column) -> Column:
    """One piece of MARKUP_PIECE_RE: text with its angle brackets escaped, an allowed tag, else nothing."""
    text = F.replace(F.replace(piece, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    name = F.lower(F.regexp_extract(piece, r"^</?([a-zA-Z][^\s/>]*)", 1))
    return F.when(~piece.startswith("<") | (F.length(piece) == 1), text).otherwise(_bind(name, lambda n: _scrubbed_tag(piece, n)))


def scrub_html(c: Column) -> Column:
    """PRJ8: drop comments and every tag outside ALLOWED_TAGS but keep the inner text
    (script text included), then turn ``&amp;`` back into ``&``.

    The value is cut into pieces once, so a ``>`` inside a quoted attribute does not
    end its tag. Allowed tags keep ALLOWED_ATTRIBUTES (a link only with an allowed
    scheme, or none); angle brackets that are no tag are escaped. Tags are not
    balanced. NULL stays NULL (never fails a row)."""
    def scrub(v: Column) -> Column:
        pieces = F.regexp_extract_all(v, F.lit(MARKUP_PIECE_RE), 0)
        marked = F.when(v.rlike("[<>]"), F.array_join(F.transform(pieces, _scrubbed_piece), "")).otherwise(v)
        return F.replace(marked, F.lit("&amp;"), F.lit("&"))

    return _bind(c, scrub)


def strip_tags(c: Column, drop_script_style: bool = True) -> Column:
    """Tag removal only (comments, then optionally script/style bodies, then tags)."""
    x = F.regexp_replace(c, COMMENT_RE, "")
    if drop_script_style:
        x = F.regexp_replace(x, SCRIPT_STYLE_RE, "")
    return F.regexp_replace(x, TAG_RE, "")


# Pieces of a text: a character reference, a run without "&", or a lone "&".
REFERENCE_PIECE_RE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]{1,31});?|[^&]+|&"
_LEGACY = sorted((n for n in HTML_ENTITIES if not n.endswith(";")), key=lambda n: (-len(n), n))
LEGACY_PREFIX_RE = "^&(?:" + "|".join(_LEGACY) + ")"  # names that HTML accepts without a semicolon
# Usual references; a value that holds no other is decoded by plain replacements, "&amp;" last.
COMMON_NAMES = ("lt;", "gt;", "quot;", "apos;", "nbsp;", "hellip;", "mdash;", "ndash;", "lsquo;", "rsquo;", "ldquo;", "rdquo;", "middot;")
COMMON_REFERENCES = {"&" + n: HTML_ENTITIES[n] for n in COMMON_NAMES} | {"&#39;": "'", "&#x27;": "'", "&#34;": '"'}
UNCOMMON_RE = "&(?!(?:amp;|" + "|".join(r[1:] for r in COMMON_REFERENCES) + "))[#A-Za-z]"
# The whole table by first letter: a map is searched from its start, so it should be short.
ENTITY_JSON = json.dumps({letter: {"&" + n: HTML_ENTITIES[n] for n in HTML_ENTITIES if n[0] == letter}
                          for letter in sorted({n[0] for n in HTML_ENTITIES})})
CONTROL_CODES = tuple(bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(128, 160))


def _decode_reference(piece: Column) -> Column:
    """One piece of REFERENCE_PIECE_RE: a named reference through the HTML entity
    table of the standard library, a numeric one by its code point (0, surrogates
    and values beyond Unicode give U+FFFD; 128 to 159 mean Windows-1252; other
    control codes go); other pieces as they are."""
    tables = F.from_json(F.lit(ENTITY_JSON), "map<string,map<string,string>>")  # folded to a literal map by the optimizer
    table = F.try_element_at(tables, F.substring(piece, 2, 1))
    digits = F.regexp_extract(piece, r"^&#([0-9]+)", 1)
    code = F.when(digits != "", digits).otherwise(F.conv(F.regexp_extract(piece, r"^&#[xX]([0-9a-fA-F]+)", 1), 16, 10)).try_cast("int")
    good = F.coalesce((code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF), F.lit(False))
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(good, code).otherwise(0xFFFD).cast("long")), 8, "0")), "UTF-32")
    numeric = (F.when(code.between(128, 159), F.element_at(F.array(*[F.lit(c) for c in CONTROL_CODES]), F.greatest(F.least(code, F.lit(159)), F.lit(128)) - 127))
               .when(code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127), F.lit(""))
               .otherwise(char))
    prefix = F.regexp_extract(piece, LEGACY_PREFIX_RE, 0)
    named = F.coalesce(F.try_element_at(table, piece),
                       F.concat(F.try_element_at(table, prefix), F.substring(piece, F.length(prefix) + 1, F.length(piece))), piece)
    return (F.when(~piece.startswith("&") | (F.length(piece) < 3), piece)
            .when(piece.startswith("&#"), F.when(piece.rlike("^&#[0-9xX]"), numeric).otherwise(piece)).otherwise(named))


def unescape_entities(c: Column) -> Column:
    """PRJ10 on the JVM: every character reference decoded in one left-to-right
    pass, so ``&amp;lt;`` becomes ``&lt;``. Values without a reference are returned
    as they are. The value is bound once (a one-element ``transform``)."""
    def decode(v: Column) -> Column:
        pieces = F.regexp_extract_all(v, F.lit(REFERENCE_PIECE_RE), 0)
        usual = v
        for reference, char in COMMON_REFERENCES.items():
            usual = F.replace(usual, F.lit(reference), F.lit(char))
        usual = F.replace(usual, F.lit("&amp;"), F.lit("&"))
        return (F.when(v.rlike(UNCOMMON_RE), F.array_join(F.transform(pieces, _decode_reference), ""))
                .when(F.instr(v, "&") > 0, usual).otherwise(v))

    return _bind(c, decode)


def html_to_text(c: Column) -> Column:
    """PRJ9: all tags dropped, entities decoded (what a DOM's text content gives)."""
    return unescape_entities(strip_tags(c))


def title_text(c: Column) -> Column:
    """Titles are decoded twice in the reference (DOM text, then unescape)."""
    return unescape_entities(html_to_text(c))


WORD_RE = r"[a-z0-9_]+"  # words of a lower-cased text


def words_of(c: Column) -> Column:
    """The words of the lower-cased text, in order."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD_RE), 0)


def word_pattern(words) -> str:
    """FLT2: one case-insensitive whole-word alternation for a word list."""
    alts = "|".join(re.escape(w.lower()) for w in sorted(set(words), key=lambda w: (-len(w), w)) if w)
    return r"(^|[^a-z0-9_])(" + alts + r")($|[^a-z0-9_])"


def contains_listed_word(c: Column, words) -> Column:
    """True when the lower-cased text contains a listed word as a whole word."""
    if not words:
        return F.lit(False)
    return F.coalesce(F.lower(c).rlike(word_pattern(words)), F.lit(False))
