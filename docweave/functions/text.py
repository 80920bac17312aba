"""String column functions (Column -> Column), all JVM-side.

Python's ``str.strip``/``str.split`` treat every Unicode space as
whitespace and ``str.splitlines`` knows ten line separators; Spark's
``trim`` only removes blanks, so explicit character classes are used.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dictionaries as D

# Characters Python's str.isspace() accepts.
WS = r"[\t\n\x0B\f\r\x1C-\x1F \x85\p{Z}]"
# Line boundaries of str.splitlines().
LINE_BREAK = r"[\n\r\x0B\f\x1C\x1D\x1E\x85\x{2028}\x{2029}]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once (bound to a lambda variable)."""
    return F.transform(F.array(value), use)[0]


# The same set as characters: trim() with an explicit set only looks at the
# two ends of a string instead of scanning it with a regex.
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")


def strip_ws(c) -> Column:
    """``str.strip()`` with Python's whitespace set."""
    return F.trim(col(c), F.lit(WS_CHARS))


def rstrip_ws(c) -> Column:
    return F.rtrim(col(c), F.lit(WS_CHARS))


def collapse_ws(c) -> Column:
    """``" ".join(s.split())``."""
    return F.regexp_replace(strip_ws(c), f"{WS}+", " ")


def nullif_empty(c) -> Column:
    c = col(c)
    return F.when(c != "", c)


def normalize_content(c) -> Column:
    """Strip every line, drop blank lines, join with newline.

    A whitespace run holding at least one line break is exactly the seam
    between two kept lines, so one regex pass replaces split/trim/join.
    """
    joined = F.regexp_replace(col(c), f"{WS}*{LINE_BREAK}{WS}*", "\n")
    return strip_ws(joined)


def summarize(c, max_chars: int = D.MAX_SUMMARY_CHARS) -> Column:
    """U4: collapse whitespace; blank -> null; cut to max + '...'."""
    s = collapse_ws(c)
    cut = F.concat(rstrip_ws(F.substring(s, 1, max_chars)), F.lit(D.SUMMARY_MARKER))
    return F.when(s == "", F.lit(None)).when(F.length(s) <= max_chars, s).otherwise(cut)


def truncate(c, max_chars: int = D.MAX_CONTENT_CHARS) -> Column:
    """Keep up to max; else first max-15 chars right-stripped + marker."""
    c = col(c)
    keep = max_chars - len(D.TRUNCATION_MARKER)
    cut = F.concat(rstrip_ws(F.substring(c, 1, keep)), F.lit(D.TRUNCATION_MARKER))
    return F.when(F.length(c) <= max_chars, c).otherwise(cut)


def clean_xml_text(c) -> Column:
    """Collapse whitespace, empty -> null."""
    return nullif_empty(collapse_ws(c))


def split_full_name(c) -> Column:
    """(first_name, last_name) struct from tokens split on single spaces.

    One token -> (x, x); several -> (all but last, last); none -> error.
    """
    tokens = F.filter(F.split(col(c), " "), lambda t: t != "")
    n = F.size(tokens)
    first = F.when(n == 1, F.try_element_at(tokens, F.lit(1))).otherwise(
        F.array_join(F.slice(tokens, 1, n - 1), " "))
    last = F.try_element_at(tokens, F.lit(-1))
    checked = F.when((n == 0) | col(c).isNull(),
                     F.raise_error(F.lit("User name is empty."))).otherwise(first)
    return F.struct(checked.alias("first_name"), last.alias("last_name"))


def content_to_text(c, data_type=None) -> Column:
    """Flatten a value to text, chosen by the column's static type.

    strings pass through; arrays and maps join their (recursively
    flattened) elements/values with a space; anything else is cast.
    """
    from pyspark.sql import types as T

    c = col(c)
    if data_type is None or isinstance(data_type, T.StringType):
        return c
    if isinstance(data_type, T.ArrayType):
        return F.array_join(F.transform(c, lambda x: content_to_text(x, data_type.elementType)), " ")
    if isinstance(data_type, T.MapType):
        return F.array_join(
            F.transform(F.map_values(c), lambda x: content_to_text(x, data_type.valueType)), " ")
    if isinstance(data_type, T.StructType):
        parts = [content_to_text(c.getField(f.name), f.dataType) for f in data_type.fields]
        return F.concat_ws(" ", *parts)
    if isinstance(data_type, T.BooleanType):
        return F.when(c, F.lit("True")).otherwise(F.lit("False"))
    return c.cast("string")


def contains_any(c, words) -> Column:
    """OR of substring tests; constant False for an empty list."""
    c = col(c)
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


@lru_cache(maxsize=1)
def _references() -> tuple[str, str, str]:
    """The named references that end with ``;`` (one text of names and characters), those that need none, and a pattern
    of the latter, longest first; from the standard library's HTML 5 table.

    Each is one string: a plan holds many copies, and every task reads them, which is slow for maps of thousands."""
    from html.entities import html5

    def table(pairs: list[tuple[str, str]]) -> str:
        return "\x01" + "\x01".join(f"{name}\x02{char}" for name, char in pairs) + "\x01"

    closed = sorted((k[:-1], v) for k, v in html5.items() if k.endswith(";"))
    bare = sorted((k, v) for k, v in html5.items() if not k.endswith(";"))
    pattern = "^(?:" + "|".join(sorted((k for k, _ in bare), key=lambda k: (-len(k), k))) + ")"
    return table(closed), table(bare), pattern


def _character(table: str, name: Column) -> Column:
    """The characters of a name in a table of :func:`_references`; null if it is not there."""
    def found(key: Column) -> Column:
        return F.when(F.lit(table).contains(key), F.substring_index(F.call_function("substring_index", F.lit(table), key, F.lit(-1)), "\x01", 1))

    return bound(F.concat(F.lit("\x01"), name, F.lit("\x02")), found)


def _numbered(n: Column) -> Column:
    """Character of a numeric reference: the C1 range as Windows-1252, surrogates and numbers beyond Unicode as the
    replacement character, other control characters and noncharacters as nothing."""
    c1 = [bytes([i]).decode("cp1252") if i not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(i) for i in range(0x80, 0xA0)]
    nothing = (n.between(1, 8) | n.between(0xE, 0x1F) | (n == 0xB) | (n == 0x7F) | n.between(0xFDD0, 0xFDEF)
               | n.bitwiseAND(F.lit(0xFFFE)).eqNullSafe(F.lit(0xFFFE)))
    return (F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "�").when(n == 0xD, "\r")
            .when(n.between(0x80, 0x9F), F.get(F.array(*[F.lit(x) for x in c1]), (n - 0x80).cast("int")))
            .when(nothing, "").otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")))


def html_unescape(c) -> Column:
    """Decode character references as HTML 5 reads them: all names, names that need no semicolon by their
    longest prefix, numbers with or without one; unknown ones stay.

    The text is split at ``&``; each later piece starts with a reference or keeps its ``&``."""
    closed, bare, pattern = _references()

    def number(piece: Column) -> Column:
        ref = F.regexp_extract(piece, "^(#(?:[0-9]+|[xX][0-9a-fA-F]+);?)", 1)
        digits = F.regexp_extract(piece, "^#[xX]?0*([0-9a-fA-F]*)", 1)
        size = F.length(F.regexp_extract(piece, "^#[xX]?0*([0-9]*)", 1))
        hexed = piece.rlike("^#[xX]")
        n = F.when(hexed, F.when(F.length(digits) > 8, F.lit(0x110000)).otherwise(F.conv(F.concat(F.lit("0"), digits), 16, 10).cast("long"))).otherwise(
            F.when(size > 9, F.lit(0x110000)).otherwise(F.concat(F.lit("0"), F.regexp_extract(piece, "^#0*([0-9]*)", 1)).try_cast("long")))
        return F.when(ref != "", F.concat(bound(n, _numbered), F.substr(piece, F.length(ref) + 1))).otherwise(F.concat(F.lit("&"), piece))

    def named(piece: Column) -> Column:
        def shorter(_: Column) -> Column:
            return bound(F.regexp_extract(piece, pattern, 0), lambda k: F.when(
                k != "", F.concat(_character(bare, k), F.substr(piece, F.length(k) + 1))).otherwise(F.concat(F.lit("&"), piece)))

        def whole(name: Column) -> Column:
            char = (F.when(name == "amp", "&").when(name == "lt", "<").when(name == "gt", ">").when(name == "quot", '"').when(name == "nbsp", " ")
                    .when(name != "", _character(closed, name)))
            return bound(char, lambda x: F.when(x.isNotNull(), F.concat(x, F.substr(piece, F.length(name) + 2))).otherwise(shorter(x)))

        return bound(F.regexp_extract(piece, "^([A-Za-z][A-Za-z0-9]{0,31});", 1), whole)

    def decode(piece: Column) -> Column:
        return F.when(piece.startswith("#"), number(piece)).when(piece.rlike("^[A-Za-z]"), named(piece)).otherwise(F.concat(F.lit("&"), piece))

    def references(pieces: Column) -> Column:
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), decode), ""))

    return bound(col(c), lambda text: F.when(text.contains("&"), bound(F.split(text, "&"), references)).otherwise(text))
