"""Text column expressions shared by extraction and document building.

Everything here is a built-in Spark expression (regexp / string / array
functions), so it stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: Python's whitespace and line-break character sets --------
# Characters for which Python's str.isspace() is true (what str.strip drops).
PY_SPACE = (r"\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}"
            r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
# Line boundaries of Python's str.splitlines().
PY_LINE_BREAK = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
# --- end of fixed values ---------------------------------------------------

SPACE_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _low_charref(n: int) -> str:
    """Character for a reference below 256: windows-1252 where that code
    page defines the byte, the code point itself otherwise (rule of the
    HTML parser the crawler used)."""
    try:
        return bytes([n]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(n)


# References 128-159 differ from their code points; built from the codec.
CP1252_HIGH = tuple(_low_charref(n) for n in range(128, 160))


def bind(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (which may use it many
    times). Without this, an expensive input expression (a regex over a
    whole page) would be re-evaluated at every use inside one projection."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: Unicode whitespace at both ends; only the ends
    are looked at."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def charref(code: Column) -> Column:
    """Character of a numeric reference body (``39`` or ``x27``)."""
    hexa = code.startswith("x") | code.startswith("X")
    digits = F.when(hexa, F.conv(F.substring(code, 2, 1 << 20), 16, 10)).otherwise(code)
    n = F.when(F.length(digits) <= 18, digits.try_cast("long"))
    high = F.split(F.lit("\x1d".join(CP1252_HIGH)), "\x1d")   # one literal, split at planning time
    utf32 = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (F.when(n.isNull() | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), F.lit("\ufffd"))
            .when(n.between(128, 159), F.element_at(high, (n - 127).cast("int")))
            .otherwise(utf32))


def _entity_names() -> dict[str, str]:
    """Every HTML5 character reference name (without ';') -> its text, built
    from the standard library's table; the first spelling in sorted order
    wins, as in the parser the crawler used."""
    from html.entities import html5
    out: dict[str, str] = {}
    for key, text in sorted(html5.items()):
        out.setdefault(key[:-1] if key.endswith(";") else key, text)
    return out


ENTITY_NAMES = _entity_names()
# The name table as one string literal: RS name US text RS name US text ...
# One literal node keeps plans small (a map literal built from arrays would
# add thousands of expression nodes per use).
RS, US = "\x1e", "\x1f"
ENTITY_TABLE = RS + RS.join(f"{k}{US}{v}" for k, v in ENTITY_NAMES.items()) + RS


def _tables_by_initial() -> dict[str, str]:
    """The name table split by first character: each search then scans only
    the names sharing that initial (a fiftieth of the table)."""
    groups: dict[str, list[str]] = {}
    for k, v in ENTITY_NAMES.items():
        groups.setdefault(k[0], []).append(f"{k}{US}{v}")
    return {ch: RS + RS.join(items) + RS for ch, items in sorted(groups.items())}


ENTITY_TABLES = _tables_by_initial()
INITIALS = "".join(ENTITY_TABLES)
GS = "\x1d"   # separates the sub-tables inside one literal


def entity_text(name: Column) -> Column:
    """Text of a reference name, null if the name is unknown. The sub-table
    of the name's initial is picked by index from one constant array (a
    single literal split once at planning time), then searched."""
    tables = F.split(F.lit(GS.join(ENTITY_TABLES.values())), GS)
    idx = F.position(F.substring(name, 1, 1), F.lit(INITIALS))
    table = F.element_at(tables, F.greatest(idx, F.lit(1)))
    at = F.position(F.concat(F.lit(RS), name, F.lit(US)), table)
    return F.when((idx > 0) & (at > 0),
                  F.substring_index(F.substring(table, at + F.length(name) + 2, F.lit(16)), RS, 1))


# One reference: '&' + '#digits', '#x' + hex digits, or a name (letters,
# digits, '-', '.'); group 2 is an optional ';'.
REF_RE = r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][-.a-zA-Z0-9]*)(;?)"


def decode_entities(c: Column) -> Column:
    return bind(c, _decode_entities)


def _decode_entities(c: Column) -> Column:
    """Resolve character references in one left-to-right pass with the HTML
    parser's rules: a known name becomes its text and an unknown one stays
    ``&name`` (a following ';' is consumed either way); a numeric reference
    needs ';' or a non-hex character after it, else it stays literal. The
    character after a reference is never consumed, so ``&lt&gt`` is ``<>``
    and ``&#38;lt;`` stays ``&lt;``. Strings without '&' skip the work."""
    # every array below is a zip_with argument, so it is computed once per
    # row; only the per-reference mapping runs inside the lambdas
    pieces = F.split(c, REF_RE)
    bodies = F.regexp_extract_all(c, F.lit(REF_RE), 1)
    semis = F.regexp_extract_all(c, F.lit(REF_RE), 2)
    after = F.slice(pieces, 2, F.size(bodies))     # text following each reference

    def ref_text(bs, nxt):
        body, semi = bs["b"], bs["s"]
        numeric_ok = (semi == ";") | ~F.coalesce(nxt, F.lit("")).rlike("^[0-9a-fA-F]")
        return (F.when(body.startswith("#"), F.when(numeric_ok, charref(F.substring(body, 2, 1 << 20)))
                       .otherwise(F.concat(F.lit("&"), body, semi)))
                .otherwise(F.coalesce(entity_text(body), F.concat(F.lit("&"), body))))
    refs = F.zip_with(F.zip_with(bodies, semis, lambda b, s_: F.struct(b.alias("b"), s_.alias("s"))),
                      after, ref_text)
    joined = F.array_join(F.zip_with(pieces, refs, lambda p, r: F.concat(p, F.coalesce(r, F.lit("")))), "")
    return F.when(c.contains("&"), joined).otherwise(c)


def clean_lines(c: Column) -> Column:
    """``'\\n'.join(l.strip() for l in s.splitlines() if l.strip())``."""
    parts = F.transform(F.split(c, PY_LINE_BREAK), py_strip)
    return F.array_join(F.filter(parts, lambda x: x != F.lit("")), "\n")


def safe_title(title: Column) -> Column:
    """File-name stem of a title: drop characters that are not word, space or
    hyphen (Unicode aware), keep 50, strip, and replace plain spaces by '_'."""
    # Python's \w is letters + numbers + '_', and its \s is Unicode-aware.
    kept = F.regexp_replace(title, rf"[^\p{{L}}\p{{N}}_{PY_SPACE}-]", "")
    return F.replace(py_strip(F.substring(kept, 1, 50)), F.lit(" "), F.lit("_"))
