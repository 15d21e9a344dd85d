"""Elements, attributes and character references of HTML as column expressions.

A layout matcher, not a DOM parser: elements are intervals of the markup that
end at their balanced closing tag (one fold over the tags of a name), direct
children come from one fold with a stack of open names, attribute names and
values are matched exactly, in any case and with either quote.
"""

from __future__ import annotations

import html.entities
import json
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements without content or closing tag.
VOID = "area base br col embed hr img input link meta param source track wbr".split()
# A quote counts after an equals sign only; one that is not closed is a character like any other.
_ATTRS = r"""(?:=[\t\n\f\r ]*+(?:"[^"]*+"|'[^']*+')|[^>])*+"""
ANY_TAG = rf"</?[a-zA-Z][a-zA-Z0-9]*{_ATTRS}>"
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"


def visible(markup: Column) -> Column:
    """Comments, scripts and styles become an empty tag: no text, but a border between texts."""
    valid = F.make_valid_utf8(markup)
    return F.when(valid.rlike("(?i)<!--|<script|<style"), F.regexp_replace(valid, _HIDDEN, "<!>")).otherwise(valid)


def _escaped(s: str) -> str:
    return "".join(c if c.isalnum() or c in "_-" else "\\" + c for c in s)


@dataclass(frozen=True)
class Sel:
    """A simple selector: ``tag``, ``tag.class`` or ``tag#id``."""

    tag: str
    cls: str | None = None
    id: str | None = None

    def open(self) -> str:
        """Regex for the opening tag."""
        need = ""
        if self.cls:
            c = _escaped(self.cls)
            need = (rf"""(?=[^>]*?\sclass\s*=\s*(?:"(?:[^"]*\s)?(?-i:{c})(?:\s[^"]*)?"|"""
                    rf"""'(?:[^']*\s)?(?-i:{c})(?:\s[^']*)?'|(?-i:{c})(?=[\s>])))""")
        elif self.id:
            i = _escaped(self.id)
            need = rf"""(?=[^>]*?\sid\s*=\s*(?:"(?-i:{i})"|'(?-i:{i})'|(?-i:{i})(?=[\s>])))"""
        return rf"(?i)<{_escaped(self.tag)}(?=[\s/>]){need}{_ATTRS}>"

    def close(self) -> str:
        return rf"(?i)</{_escaped(self.tag)}\s*>"


def bound(value: Column, name: str, sql: str) -> Column:
    """An SQL expression of the variable ``name``, applied to ``value``, which is evaluated once.

    Long expressions are one parsed text this way, not thousands of calls to the JVM.
    """
    return F.get(F.call_function("transform", F.array(value), F.expr(f"{name} -> {sql}")), F.lit(0))


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _tags_sql(pattern: str) -> str:
    """The tags of the markup ``m``: each with the text before it (fields `0` and `1`)."""
    p = _text(pattern)
    return f"filter(arrays_zip(split(m, {p}, -1), regexp_extract_all(m, {p}, 0)), z -> z.`1` IS NOT NULL)"


def elements(markup: Column, tag: str, sels: tuple[Sel, ...]) -> Column:
    """array<struct<o, s, e, m>>: the elements of a tag name that match one of ``sels``, in document order.

    ``o`` is the place (in bytes, from 0) of the opening tag, ``s`` to ``e`` the content,
    bit i of ``m`` whether ``sels[i]`` matches.  A closing tag ends the last
    open element of the name; an element that is not closed ends with the
    markup.  One fold over the name's tags; only elements that match are held.
    """
    def state(depth: str, now: str, out: str) -> str:
        return f"named_struct('depth', {depth}, 'pos', a.pos + t.before + t.n, 'now', {now}, 'out', {out})"

    tags = rf"(?i)</?{_escaped(tag)}(?=[\s/>]){_ATTRS}>"
    bits = " + ".join(f"CASE WHEN z.`1` RLIKE {_text('^' + s.open())} THEN {1 << i} ELSE 0 END" for i, s in enumerate(sels))
    marks = f"""transform({_tags_sql(tags)}, z -> named_struct('before', octet_length(z.`0`), 'n', octet_length(z.`1`),
      'kind', CASE WHEN startswith(z.`1`, '</') THEN 1 WHEN endswith(z.`1`, '/>') THEN 2 ELSE 0 END,
      'm', CASE WHEN startswith(z.`1`, '</') THEN 0 ELSE {bits} END))"""
    at, after, last = "a.pos + t.before", "a.pos + t.before + t.n", "get(a.now, size(a.now) - 1)"
    step = f"""CASE
      WHEN t.kind = 0 AND t.m = 0 THEN {state("a.depth + 1", "a.now", "a.out")}
      WHEN t.kind = 0 THEN {state("a.depth + 1",
                                  f"concat(a.now, array(named_struct('d', a.depth + 1, 'o', {at}, 's', {after}, 'm', t.m)))", "a.out")}
      WHEN t.kind = 1 AND {last}.d = a.depth THEN {state(
          "a.depth - 1", "slice(a.now, 1, size(a.now) - 1)",
          f"concat(a.out, array(named_struct('o', {last}.o, 's', {last}.s, 'e', {at}, 'm', {last}.m)))")}
      WHEN t.kind = 1 THEN {state("greatest(a.depth - 1, 0)", "a.now", "a.out")}
      WHEN t.m > 0 THEN {state("a.depth", "a.now",
                               f"concat(a.out, array(named_struct('o', {at}, 's', {after}, 'e', {after}, 'm', t.m)))")}
      ELSE {state("a.depth", "a.now", "a.out")} END"""
    return bound(markup, "m", f"""aggregate({marks}, named_struct('depth', 0, 'pos', 0,
      'now', CAST(array() AS array<struct<d:int,o:int,s:int,m:int>>), 'out', CAST(array() AS array<struct<o:int,s:int,e:int,m:int>>)),
      (a, t) -> {step}, a -> sort_array(concat(a.out, transform(a.now, x ->
        named_struct('o', x.o, 's', x.s, 'e', octet_length(m), 'm', x.m)))))""")


def matching(found: Column, bit: int) -> Column:
    """The elements that match the selector of that bit."""
    return F.filter(found, lambda x: x["m"].bitwiseAND(F.lit(1 << bit)) != 0)


def within(found: Column, outer: Column) -> Column:
    """The elements that lie in one of ``outer``."""
    return F.filter(found, lambda x: F.exists(outer, lambda a: (a["s"] <= x["o"]) & (x["o"] < a["e"])))


def outermost(found: Column) -> Column:
    """The elements that lie in none of the others."""
    return F.filter(found, lambda x: ~F.exists(found, lambda a: (a["s"] <= x["o"]) & (x["o"] < a["e"])))


def cut(markup: Column, start: Column, end: Column) -> Column:
    """The markup between two places in bytes; a cut of bytes walks no characters to find its start."""
    return F.substring(markup.cast("binary"), start + 1, end - start).cast("string")


def content(markup: Column, x: Column) -> Column:
    return cut(markup, x["s"], x["e"])


def _walked(inner: Column, finish: str) -> Column:
    """Fold over all tags of a content with a stack of open names; ``finish`` is SQL of the last state ``a``.

    A closing tag closes the nearest open element of its name with everything
    inside; one that matches nothing is passed over.
    """
    def state(stack: str, tag: str = "a.tag", s: str = "a.s", out: str = "a.out") -> str:
        return f"named_struct('stack', {stack}, 'pos', a.pos + t.before + t.n, 'tag', {tag}, 's', {s}, 'out', {out})"

    void = ", ".join(map(_text, VOID))
    tags = f"""transform(transform({_tags_sql(ANY_TAG)}, z -> named_struct('before', octet_length(z.`0`), 'tag', z.`1`, 'n', octet_length(z.`1`),
      'name', lower(regexp_extract(z.`1`, '^</?([a-zA-Z][a-zA-Z0-9]*)', 1)))), t -> named_struct('before', t.before, 'tag', t.tag,
      'n', t.n, 'name', t.name, 'close', startswith(t.tag, '</'), 'empty', endswith(t.tag, '/>') OR t.name IN ({void})))"""
    at, after = "a.pos + t.before", "a.pos + t.before + t.n"
    left = "CAST(size(a.stack) - array_position(reverse(a.stack), t.name) AS INT)"
    step = f"""CASE
      WHEN t.close AND get(a.stack, 0) = t.name AND {left} = 0 THEN {state(
          "CAST(array() AS array<string>)", out=f"concat(a.out, array(named_struct('tag', a.tag, 's', a.s, 'e', {at})))")}
      WHEN t.close THEN {state(f"CASE WHEN array_contains(a.stack, t.name) THEN slice(a.stack, 1, {left}) ELSE a.stack END")}
      WHEN t.empty AND size(a.stack) = 0 THEN {state(
          "a.stack", out=f"concat(a.out, array(named_struct('tag', t.tag, 's', {after}, 'e', {after})))")}
      WHEN t.empty THEN {state("a.stack")}
      WHEN size(a.stack) = 0 THEN {state("array(t.name)", "t.tag", after)}
      ELSE {state("concat(a.stack, array(t.name))")} END"""
    return bound(inner, "m", f"""aggregate({tags}, named_struct('stack', CAST(array() AS array<string>), 'pos', 0, 'tag', '', 's', 0,
      'out', CAST(array() AS array<struct<tag:string,s:int,e:int>>)), (a, t) -> {step}, a -> {finish})""")


def children(inner: Column) -> Column:
    """array<struct<tag, s, e>>: direct child elements of a content, each with its opening tag and the
    positions (in bytes, from 0) of its own content."""
    return _walked(inner, f"""CASE WHEN size(a.stack) = 0 THEN a.out
      ELSE concat(a.out, array(named_struct('tag', a.tag, 's', a.s, 'e', {1 << 30}))) END""")


def closed(inner: Column) -> Column:
    """Whether every element that a piece of markup opens is closed in it."""
    return _walked(inner, "size(a.stack) = 0")


def attribute(tag: Column, name: str) -> Column:
    """Decoded value of an attribute of an opening tag; null without it."""
    pattern = rf"""(?i)\s{_escaped(name)}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
    value = F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)])
    return F.when(tag.rlike(pattern), decode_references(value)) \
        .when(tag.rlike(rf"(?i)\s{_escaped(name)}(?=[\s/>])"), F.lit(""))


# ---------------------------------------------------------------------------
# Character references.  The names and their characters are the standard
# library's table; the remapped and the dropped numbers are HTML's.
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_NAMED = dict(html.entities.html5)
_OPEN_NAMES = {k: v for k, v in _NAMED.items() if not k.endswith(";")}
_WINDOWS = {0x00: 0xFFFD, 0x0D: 0x0D, **{
    n: ord(bytes([n]).decode("cp1252", "replace")) if bytes([n]).decode("cp1252", "ignore") else n
    for n in range(0x80, 0xA0)}}


def _table(entries: dict, kind: str = "string") -> str:
    return f"from_json({_text(json.dumps(entries))}, 'map<string,{kind}>')"


def _with(value: str, name: str, sql: str) -> str:
    return f"get(transform(array({value}), {name} -> {sql}), 0)"


#: One-character string of a code point ``c`` (UTF-16BE bytes, surrogate pair above U+FFFF); U+FFFD for surrogates
#: and values above U+10FFFF, '' for -1.
_CHAR = """CASE WHEN c = -1 THEN '' ELSE decode(unhex(CASE
  WHEN c < 0 OR c > 1114111 OR c BETWEEN 55296 AND 57343 THEN 'FFFD'
  WHEN c <= 65535 THEN lpad(hex(c), 4, '0')
  ELSE concat(lpad(hex(floor((c - 65536) / 1024) + 55296), 4, '0'), lpad(hex(pmod(c - 65536, 1024) + 56320), 4, '0')) END), 'UTF-16BE') END"""
#: Numbers that stand for no character.
_DROPPED = """(n BETWEEN 1 AND 8 OR n = 11 OR n BETWEEN 14 AND 31 OR n BETWEEN 127 AND 159 OR n BETWEEN 64976 AND 65007
  OR (n & 65534) = 65534 AND n <= 1114111)"""


def _reference_sql() -> str:
    """Text of one reference ``r``, as the standard library decodes it."""
    digits = "regexp_extract(r, '^&#[xX]?0*([0-9a-fA-F]*);?$', 1)"
    number = """CAST(CASE WHEN length(d) > 8 THEN '1114112' WHEN d = '' THEN '0'
      WHEN r RLIKE '^&#[xX]' THEN conv(d, 16, 10) ELSE conv(d, 10, 10) END AS BIGINT)"""
    windows = _table({str(k): v for k, v in _WINDOWS.items()}, "bigint")
    point = f"coalesce(element_at({windows}, string(n)), CASE WHEN {_DROPPED} THEN -1 ELSE n END)"
    numbered = _with(_with(_with(digits, "d", number), "n", point), "c", _CHAR)
    prefix = f"""get(filter(transform(sequence(length(w), 1, -1), k -> substring(w, 1, k)),
      p -> map_contains_key({_table(_OPEN_NAMES)}, p)), 0)"""
    open_name = _with(prefix, "h", f"concat(element_at({_table(_OPEN_NAMES)}, h), substring(w, length(h) + 1, 40))")
    named = _with("substring(r, 2, 40)", "w", f"coalesce(element_at({_table(_NAMED)}, w), {open_name}, r)")
    return f"CASE WHEN startswith(r, '&#') THEN {numbered} ELSE {named} END"


def _decode_sql() -> str:
    pattern = _text(_REFERENCE)
    return f"""CASE WHEN contains(t, '&') THEN array_join(transform(
      arrays_zip(split(t, {pattern}, -1), regexp_extract_all(t, {pattern}, 0)),
      z -> CASE WHEN z.`1` IS NULL THEN z.`0` ELSE concat(z.`0`, {_with("z.`1`", "r", _reference_sql())}) END), '') ELSE t END"""


_DECODE = _decode_sql()


def decode_references(text: Column) -> Column:
    """Character references decoded in one pass, as ``html.unescape`` does."""
    return bound(text, "t", _DECODE)
