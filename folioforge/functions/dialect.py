"""Portable expressions: written once, rendered for Spark SQL or for DuckDB.

Patterns use only what java.util.regex and RE2 share: no look-around, no back
references, [0-9] for digits, explicit word characters. Spark gets patterns as
raw string literals.
"""

from __future__ import annotations

import re

#: What Python's strip() takes from text that normalize_whitespace() has been over.
BLANKS = " \t\n\r\x0b\x0c"


class Dialect:
    """Spark SQL."""

    name = "spark"

    def text(self, s: str) -> str:
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def pattern(self, p: str) -> str:
        assert '"' not in p or "'" not in p
        return f'r"{p}"' if '"' not in p else f"r'{p}'"

    def rx(self, x: str, p: str) -> str:
        """Over a plain column a pattern that fixes how a match begins is tried only where the column begins so: a regex decodes the whole string first."""
        if p in (r"^\p{Ll}", r"^\p{Lu}"):
            return f"regexp_like(substring({x}, 1, 1), {self.pattern(p)})"
        guard = self.begins(x, p) if re.fullmatch(r"\w+", x) else ""
        return f"({guard} AND regexp_like({x}, {self.pattern(p)}))" if guard else f"regexp_like({x}, {self.pattern(p)})"

    def begins(self, x: str, p: str) -> str:
        """What a string that the anchored pattern p matches begins with, as a condition; empty if p does not say."""
        if "|" in p:
            return ""
        if m := re.match(r"\^\[(\w)-(\w)\](?![*?{])", p):
            return f"{x} >= '{m[1]}' AND {x} < {self.text(chr(ord(m[2]) + 1))}"
        if p.startswith(("^#{1,6}", "^(#{1,6})")):
            return self.starts(x, "#")
        if m := re.match(r"\^\[([*†‡]+)\](?![*?{])", p):
            return "(" + " OR ".join(self.starts(x, c) for c in m[1]) + ")"
        if m := re.match(r"\^([A-Za-z]{2,})(?=\\s|\[ )", p):
            return self.starts(x, m[1])
        return ""

    def trimmed(self, x: str) -> str:
        """strip() of a plain column, which is left alone where neither end is blank: btrim() walks over the whole string."""
        return f"CASE WHEN {x} < '!' OR {self.ends_in(x, BLANKS)} THEN {self.strip(x)} ELSE {x} END"

    def rtrimmed(self, x: str) -> str:
        """rstrip() of a plain column, as trimmed()."""
        return f"CASE WHEN {self.ends_in(x, BLANKS)} THEN {self.rstrip(x)} ELSE {x} END"

    def ends_in(self, x: str, chars: str) -> str:
        """Whether x ends in one of some characters."""
        return "(" + " OR ".join(self.ends(x, c) for c in chars) + ")"

    def let(self, name: str, value: str, body: str) -> str:
        """body, in which name stands for value, made once and only where body is."""
        return f"get(transform(array({value}), {name} -> {body}), 0)"

    def count(self, x: str, p: str) -> str:
        return f"CAST(regexp_count({x}, {self.pattern(p)}) AS BIGINT)"

    def extract(self, x: str, p: str, group: int = 1) -> str:
        return f"regexp_extract({x}, {self.pattern(p)}, {group})"

    def extract_all(self, x: str, p: str, group: int = 0) -> str:
        return f"regexp_extract_all({x}, {self.pattern(p)}, {group})"

    def sub(self, x: str, p: str, to: str = "") -> str:
        """to: groups as \\1."""
        for k in "123":
            to = to.replace(f"\\{k}", f"${k}")
        return f"regexp_replace({x}, {self.pattern(p)}, {self.text(to)})"

    def strip(self, x: str, chars: str = BLANKS) -> str:
        return f"btrim({x}, {self.text(chars)})"

    def rstrip(self, x: str, chars: str = BLANKS) -> str:
        return f"rtrim({self.text(chars)}, {x})"

    def size(self, a: str) -> str:
        return f"CAST(size({a}) AS BIGINT)"

    def split(self, x: str, separator: str) -> str:
        return f"split({x}, {self.pattern(''.join(chr(92) + c if c in '.|()[]*+?^$' else c for c in separator))})"

    def filter(self, a: str, v: str, condition: str) -> str:
        return f"filter({a}, {v} -> {condition})"

    def map(self, a: str, v: str, e: str) -> str:
        return f"transform({a}, {v} -> {e})"

    def at(self, a: str, k: int) -> str:
        """The k-th item from 1, null beyond; -1 is the last."""
        return f"try_element_at({a}, {k})"

    def distinct(self, a: str) -> str:
        return f"array_distinct({a})"

    def join(self, a: str, separator: str) -> str:
        return f"array_join({a}, {self.text(separator)})"

    def total(self, a: str, v: str, e: str) -> str:
        """Sum of e over the items."""
        return f"aggregate({a}, 0L, (acc, {v}) -> acc + CAST({e} AS BIGINT))"

    def starts(self, x: str, s: str) -> str:
        return f"startswith({x}, {self.text(s)})"

    def ends(self, x: str, s: str) -> str:
        return f"endswith({x}, {self.text(s)})"

    def has(self, x: str, s: str) -> str:
        return f"contains({x}, {self.text(s)})"

    def md5(self, x: str) -> str:
        return f"md5({x})"

    def array(self, *items: str) -> str:
        return f"array({', '.join(items)})"

    def sort(self, a: str) -> str:
        return f"array_sort({a})"

    def slice(self, a: str, n: int) -> str:
        return f"slice({a}, 1, {n})"

    def minus(self, a: str, b: str) -> str:
        return f"array_except({a}, {b})"

    def lower_start(self, x: str) -> str:
        return self.rx(x, r"^\p{Ll}")

    def any_of(self, x: str, items) -> str:
        return "(" + " OR ".join(self.has(x, i) for i in items) + ")"

    def in_(self, x: str, items) -> str:
        return f"({x} IN ({', '.join(map(self.text, items))}))"

    def double(self, x: str) -> str:
        return f"CAST({x} AS DOUBLE)"

    def idiv(self, a: str, b: str) -> str:
        return f"({a} DIV {b})"

    def round(self, x: str, digits: int) -> str:
        """A double as DuckDB rounds it: the double times a power of ten, halves away from zero. Spark's round() takes the shortest decimal that names the double, and 64.225 lies below its decimal."""
        return f"(round(({x}) * 1e{digits}D) / 1e{digits}D)"


class Duck(Dialect):
    name = "duckdb"

    def trimmed(self, x: str) -> str:
        return self.strip(x)

    def ends_in(self, x: str, chars: str) -> str:
        return self.rx(x, f"[{chars}]$")

    def text(self, s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def pattern(self, p: str) -> str:
        return "'" + p.replace("'", "''") + "'"

    def rx(self, x: str, p: str) -> str:
        return f"regexp_matches({x}, {self.pattern(p)})"

    def count(self, x: str, p: str) -> str:
        return f"CAST(len(regexp_extract_all({x}, {self.pattern(p)})) AS BIGINT)"

    def extract_all(self, x: str, p: str, group: int = 0) -> str:
        return f"regexp_extract_all({x}, {self.pattern(p)}, {group})"

    def sub(self, x: str, p: str, to: str = "") -> str:
        return f"regexp_replace({x}, {self.pattern(p)}, {self.text(to)}, 'g')"

    def strip(self, x: str, chars: str = BLANKS) -> str:
        return f"trim({x}, {self.text(chars)})"

    def rstrip(self, x: str, chars: str = BLANKS) -> str:
        return f"rtrim({x}, {self.text(chars)})"

    def size(self, a: str) -> str:
        return f"CAST(len({a}) AS BIGINT)"

    def split(self, x: str, separator: str) -> str:
        return f"string_split({x}, {self.text(separator)})"

    def filter(self, a: str, v: str, condition: str) -> str:
        return f"list_filter({a}, lambda {v}: {condition})"

    def map(self, a: str, v: str, e: str) -> str:
        return f"list_transform({a}, lambda {v}: {e})"

    def at(self, a: str, k: int) -> str:
        return f"({a})[{k}]"

    def distinct(self, a: str) -> str:
        return f"list_distinct({a})"

    def join(self, a: str, separator: str) -> str:
        return f"array_to_string({a}, {self.text(separator)})"

    def total(self, a: str, v: str, e: str) -> str:
        return f"CAST(COALESCE(list_sum(list_transform({a}, lambda {v}: CAST({e} AS BIGINT))), 0) AS BIGINT)"

    def starts(self, x: str, s: str) -> str:
        return f"starts_with({x}, {self.text(s)})"

    def ends(self, x: str, s: str) -> str:
        return f"ends_with({x}, {self.text(s)})"

    def array(self, *items: str) -> str:
        return f"[{', '.join(items)}]"

    def sort(self, a: str) -> str:
        return f"list_sort({a})"

    def slice(self, a: str, n: int) -> str:
        return f"({a})[1:{n}]"

    def minus(self, a: str, b: str) -> str:
        # both lists once, not b anew for every item of a
        return f"list_transform([{{'a': list_distinct({a}), 'b': list_distinct({b})}}], lambda p: list_filter(p.a, lambda e: NOT list_contains(p.b, e)))[1]"

    def idiv(self, a: str, b: str) -> str:
        return f"({a} // {b})"

    def round(self, x: str, digits: int) -> str:
        return f"round({x}, {digits})"


SPARK, DUCK = Dialect(), Duck()


def columns_of(s: str) -> list[str]:
    """Split a select list at its outer commas."""
    out, depth, quote, start = [], 0, "", 0
    for i, c in enumerate(s):
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"":
            quote = c
        elif c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
        elif c == "," and depth == 0:
            out.append(s[start:i])
            start = i + 1
    return [*out, s[start:]]
