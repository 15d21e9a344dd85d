"""Text cleaning and script detection as native column expressions.

Every function returns a ``Column`` built from ``regexp_replace``,
``length``, ``split`` and higher-order array functions, so a whole
cleaning plan stays one codegen'd projection with no Python worker.

Python's ``str.strip`` and ``re`` ``\\s`` are Unicode-aware while Java's
``\\s`` and ``trim`` are ASCII-only, so the whitespace class is spelled out.
The regex text is valid for both Java (Spark) and RE2 (DuckDB oracle).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from duoweave.functions.markup import decode_references

# ---------------------------------------------------------------------------
# Fixed values.  They must equal the reference behaviour for equal results.
# Separator lines that split a page into its Khmer and English halves:
SEPARATOR_TOKENS = ("- - -", "---", "***", "* * *")
# Block text that is dropped as a placeholder:
PLACEHOLDER = "..."
# Minimum cleaned length of a main-layout block:
MIN_BLOCK_LENGTH = 3
# A text is Khmer when Khmer letters are more than this share of all letters:
KHMER_SHARE = 0.6
# Characters Python counts as whitespace (str.isspace, re \s):
WHITESPACE_CLASS = (
    r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# Khmer code points that survive the non-word strip (letters, digits, signs
# that are word characters): U+1780-17B3, 17D7, 17DC, 17E0-17E9, 17F0-17F9.
KHMER_LETTERS = r"\x{1780}-\x{17B3}\x{17D7}\x{17DC}\x{17E0}-\x{17E9}\x{17F0}-\x{17F9}"
# Alphabetic characters below U+0100:
LATIN_LETTERS = r"A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}"
# ---------------------------------------------------------------------------

_WS_EDGES = rf"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+\z"
_WS_RUN = rf"{WHITESPACE_CLASS}+"
# Tags and declarations.  A bare < is text, a > in a quoted attribute is the attribute's; a quote that is not
# closed is a character like any other.
TAG_PATTERN = r"""</?[a-zA-Z](?:=[\t\n\f\r ]*+(?:"[^"]*+"|'[^']*+')|[^>])*+>|<[!?][^>]*+>"""


def _chars(spec: str) -> str:
    """Expand a character-class body like "\\x{1780}-\\x{17B3}A-Z" into its characters."""
    import re as _re

    def one(tok: str) -> int:
        if tok.startswith("\\x{"):
            return int(tok[3:-1], 16)
        return {"\\t": 9, "\\r": 13, "\\n": 10}.get(tok, None) or ord(tok)

    toks = _re.findall(r"\\x\{[0-9A-Fa-f]+\}|\\[trn]|.", spec)
    out, k = [], 0
    while k < len(toks):
        if k + 2 < len(toks) and toks[k + 1] == "-":
            out.extend(chr(c) for c in range(one(toks[k]), one(toks[k + 2]) + 1))
            k += 3
        else:
            out.append(chr(one(toks[k])))
            k += 1
    return "".join(out)


# The same sets as plain character lists (for translate / btrim, which are
# much faster than character-class regexes).
WHITESPACE_CHARS = _chars(WHITESPACE_CLASS[1:-1])
_SPACES = " " * len(WHITESPACE_CHARS)
# Few ranges that hold every whitespace character but ' ': texts without any of them need no translate.
_MAYBE_SPACE = r"[\x{0}-\x{1F}\x{80}-\x{A0}\x{1680}\x{2000}-\x{3000}]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.btrim(_col(c), F.lit(WHITESPACE_CHARS))


def _spaced(c: Column) -> Column:
    """Every Unicode whitespace character turned into ' '; a text without any but ' ' is not rewritten."""
    return F.when(c.rlike(_MAYBE_SPACE), F.translate(c, WHITESPACE_CHARS, _SPACES)).otherwise(c)


def _collapsed(s: Column) -> Column:
    return F.when(s.contains("  "), F.regexp_replace(s, "  +", " ")).otherwise(s)


def _only_dashes(c: Column) -> Column:
    """Whether a text without spaces at its ends is made of dashes and spaces only."""
    return (c == "") | (c.startswith("-") & c.rlike(r"^[- ]*\z"))


def clean_text(c) -> Column:
    """Clean one passage.

    null/'' -> ''; a stripped separator token is kept as is; otherwise
    whitespace runs become one space, text made only of dashes and spaces
    becomes '', a lone '.' becomes ''.
    """
    raw = F.coalesce(_col(c), F.lit(""))
    s = F.btrim(_spaced(raw), F.lit(" "))
    collapsed = _collapsed(s)
    # s has the length of the stripped text, with inner whitespace as ' ';
    # it is a token only if the original stripped text is that token.
    token = s.isin(*SEPARATOR_TOKENS) & (strip_ws(raw) == s)
    return (
        F.when(raw == "", F.lit(""))
        .when(token, s)
        .when(_only_dashes(collapsed), F.lit(""))
        .when(collapsed == ".", F.lit(""))
        .otherwise(collapsed)
    )


@dataclass(frozen=True)
class LanguageRule:
    """Which letters count for the target script, and the share to beat."""

    script_letters: str = KHMER_LETTERS
    other_letters: str = LATIN_LETTERS
    threshold: float = KHMER_SHARE
    script_label: str = "khmer"
    other_label: str = "english"


KHMER = LanguageRule()


def script_counts(c, rule: LanguageRule = KHMER) -> tuple[Column, Column]:
    """(script letters, other letters) counted in code points."""
    t = F.coalesce(_col(c), F.lit(""))
    n = F.length(t)
    k = n - F.length(F.translate(t, _chars(rule.script_letters), ""))
    l_ = n - F.length(F.translate(t, _chars(rule.other_letters), ""))
    return k, l_


def is_script(c, rule: LanguageRule = KHMER) -> Column:
    """True iff script letters / (script + other letters) > threshold."""
    t = F.coalesce(_col(c), F.lit(""))
    k, l_ = script_counts(t, rule)
    # the counts are bound: lambdas evaluate a repeated expression as often as it is written
    over = F.transform(F.array(F.struct(k.alias("k"), l_.alias("l"))), lambda x: F.when(
        x["k"] + x["l"] > 0, x["k"] / (x["k"] + x["l"]) > F.lit(rule.threshold)))
    share = F.coalesce(F.get(over, 0), F.lit(False))
    if rule.threshold < 0 or min(_chars(rule.script_letters), default="") < "\x80":
        return share
    # a text of ASCII alone has no letter of the script
    return F.when(F.octet_length(t) == F.length(t), F.lit(False)).otherwise(share)


def language_label(c, rule: LanguageRule = KHMER) -> Column:
    """'khmer' when the text is in the script, else 'english'."""
    return F.when(is_script(c, rule), F.lit(rule.script_label)).otherwise(F.lit(rule.other_label))


def text_of(c, glue: str = "") -> Column:
    """Text content of an HTML fragment.

    Splits on tags, decodes character references per text node, strips each node and
    joins the non-empty ones with ``glue`` ('' as ``get_text(strip=True)``,
    ' ' as ``get_text(separator=' ', strip=True)``).
    """
    whole = F.coalesce(_col(c), F.lit(""))
    nodes = F.when(whole.contains("<"), F.split(whole, TAG_PATTERN, -1)).otherwise(F.array(whole))
    # trimming by a set walks the whole text: only texts that have one of it at an end are trimmed
    ends = lambda x: F.lit(WHITESPACE_CHARS).contains(F.left(x, F.lit(1))) | F.lit(WHITESPACE_CHARS).contains(F.right(x, F.lit(1)))
    stripped = F.transform(F.transform(nodes, decode_references), lambda x: F.when(ends(x), strip_ws(x)).otherwise(x))
    return F.array_join(F.filter(stripped, lambda x: x != ""), glue)


def clean_array(arr) -> Column:
    """``clean_text`` over every element of an array, each step evaluated once.

    Lambdas of higher-order functions are not subject to common
    subexpression elimination, so intermediate forms are bound as struct
    fields in separate passes instead of being repeated.
    """
    a = _col(arr)
    st = F.transform(a, lambda x: F.struct(
        F.coalesce(x, F.lit("")).alias("r"),
        F.btrim(_spaced(F.coalesce(x, F.lit(""))), F.lit(" ")).alias("s")))
    co = F.transform(st, lambda v: F.struct(v["r"].alias("r"), v["s"].alias("s"),
                                            _collapsed(v["s"]).alias("c")))
    return F.transform(co, lambda v: (
        F.when(v["r"] == "", F.lit(""))
        .when(v["s"].isin(*SEPARATOR_TOKENS) & (strip_ws(v["r"]) == v["s"]), v["s"])
        .when(_only_dashes(v["c"]), F.lit(""))
        .when(v["c"] == ".", F.lit(""))
        .otherwise(v["c"])))


def texts_of(arr, glue: str = "") -> Column:
    """``text_of`` over every element of an array of HTML fragments."""
    return F.transform(_col(arr), lambda x: text_of(x, glue))


def labelled(arr, rule: "LanguageRule" = None) -> Column:
    """array<struct<t:string, k:boolean>>: each text with its script flag, computed once."""
    r = rule or KHMER
    return F.transform(_col(arr), lambda x: F.struct(x.alias("t"), is_script(x, r).alias("k")))
