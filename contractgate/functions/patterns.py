"""Contract patterns: Python's dialect rewritten in Java's, which Spark's RLIKE runs.

A pattern is read by Python's own parser and written out again element by
element, with no flag and no shorthand whose meaning differs between the two:
classes are spelled out (``\\d``, ``\\w``, ``\\s`` in their Unicode or ASCII meaning), ``.``,
``^``, ``$``, ``\\b`` become what Python takes them for, named groups become numbered
ones, and case-insensitive letters become the set of letters Python would
accept. What has no equal is refused with ``ValueError``: conditional groups,
case-insensitive back references, lone surrogates and counts beyond an int.

Limit: Java matches a repeated group of varying length by recursion, about one
frame a repetition, so such a pattern needs a deep stack on very long values.
"""

from __future__ import annotations

import functools
import re
import sys

try:
    from re import _constants as sre
    from re import _parser as parser
except ImportError:  # before Python 3.11
    import sre_constants as sre
    import sre_parse as parser

# --- fixed values: what Python's classes hold ------------------------------------
DIGIT = {False: r"\p{Nd}", True: "0-9"}  # by "ASCII only"
WORD = {False: r"\p{L}\p{N}_", True: "a-zA-Z0-9_"}
SPACE = {False: r"\x09-\x0D\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}", True: r"\x09-\x0D\x20"}
# -----------------------------------------------------------------------------
ANY_CHAR = r"[\x{0}-\x{10FFFF}]"
_MOST = (1 << 31) - 1  # of a count in Java
_CLASSES = {"DIGIT": DIGIT, "WORD": WORD, "SPACE": SPACE}


def _char(code: int) -> str:
    if 0xD800 <= code <= 0xDFFF:
        raise ValueError("a lone surrogate cannot be matched")
    c = chr(code)
    return c if c.isascii() and c.isalnum() else rf"\x{{{code:X}}}"


@functools.lru_cache(maxsize=1)
def _cased() -> list[str]:
    """Characters that have another case."""
    every = (chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    return [c for c in every if c.lower() != c or c.upper() != c]


def _other_cases(lo: int, hi: int, flags: int) -> list[int]:
    """Characters outside lo..hi that Python accepts for the range when case is ignored."""
    own = re.compile(f"[{re.escape(chr(lo))}-{re.escape(chr(hi))}]", (flags & re.ASCII) | re.IGNORECASE)
    return [ord(c) for c in _cased() if not lo <= ord(c) <= hi and own.match(c)]


class _Writer:
    def __init__(self, flags: int):
        self.flags = flags

    def sequence(self, items, flags: int) -> str:
        return "".join(self.element(op, value, flags) for op, value in items)

    def element(self, op, value, flags: int) -> str:
        method = getattr(self, f"on_{str(op).lower()}", None)
        if method is None:
            raise ValueError(f"{str(op).lower()} has no equal")
        return method(value, flags)

    # characters

    def _range(self, lo: int, hi: int, flags: int) -> str:
        out = _char(lo) if lo == hi else f"{_char(lo)}-{_char(hi)}"
        if flags & re.IGNORECASE:
            out += "".join(map(_char, _other_cases(lo, hi, flags)))
        return out

    def on_literal(self, code, flags):
        if flags & re.IGNORECASE:
            return f"[{self._range(code, code, flags)}]"
        return _char(code)

    def on_not_literal(self, code, flags):
        return f"[^{self._range(code, code, flags)}]"

    def on_any(self, _, flags):
        return ANY_CHAR if flags & re.DOTALL else r"[^\x0A]"

    def _category(self, name, flags) -> tuple[bool, str]:
        """(whether it is negated, what it holds inside a class)."""
        parts = str(name).split("_")  # CATEGORY_[NOT_]DIGIT
        return "NOT" in parts, _CLASSES[parts[-1]][bool(flags & re.ASCII)]

    def on_category(self, name, flags):
        negated, held = self._category(name, flags)
        return f"[^{held}]" if negated else f"[{held}]"

    def on_in(self, items, flags):
        held, others, negated = "", [], False
        for op, value in items:
            if op is sre.NEGATE:
                negated = True
            elif op is sre.LITERAL:
                held += self._range(value, value, flags)
            elif op is sre.RANGE:
                held += self._range(*value, flags)
            else:
                inverse, own = self._category(value, flags)
                if inverse:
                    others.append(f"[^{own}]")
                else:
                    held += own
        if not others:
            return f"[{'^' if negated else ''}{held}]"
        either = "|".join(([f"[{held}]"] if held else []) + others)
        return f"(?:(?!{either}){ANY_CHAR})" if negated else f"(?:{either})"

    # places

    def on_at(self, place, flags):
        many, word = flags & re.MULTILINE, f"[{WORD[bool(flags & re.ASCII)]}]"
        name = str(place)
        if name == "AT_BEGINNING":
            return r"(?:\A|(?<=\x0A))" if many else r"\A"
        if name == "AT_BEGINNING_STRING":
            return r"\A"
        if name == "AT_END":
            return r"(?=\x0A|\z)" if many else r"(?=\x0A?\z)"
        if name == "AT_END_STRING":
            return r"\z"
        if name == "AT_BOUNDARY":
            return f"(?:(?<={word})(?!{word})|(?<!{word})(?={word}))"
        if name == "AT_NON_BOUNDARY":
            inside = f"(?:(?<={word})(?={word})|(?<!{word})(?!{word}))"
            return inside if sys.version_info >= (3, 14) else rf"(?!\A\z){inside}"  # never in an empty text
        raise ValueError(f"{name.lower()} has no equal")

    # groups

    def on_branch(self, value, flags):
        return "(?:" + "|".join(self.sequence(b, flags) for b in value[1]) + ")"

    def on_subpattern(self, value, flags):
        group, add, drop, items = value
        inside = self.sequence(items, (flags | add) & ~drop)
        return f"(?:{inside})" if group is None else f"({inside})"

    def on_atomic_group(self, items, flags):
        return f"(?>{self.sequence(items, flags)})"

    def on_groupref(self, group, flags):
        if flags & re.IGNORECASE:
            raise ValueError("a case-insensitive back reference has no equal")
        return rf"(?:\{group})"

    def on_assert(self, value, flags):
        return f"(?{'<' if value[0] < 0 else ''}={self.sequence(value[1], flags)})"

    def on_assert_not(self, value, flags):
        return f"(?{'<' if value[0] < 0 else ''}!{self.sequence(value[1], flags)})"

    def on_failure(self, _, flags):
        return "(?!)"

    # repeats

    def _repeat(self, value, flags, suffix: str) -> str:
        least, most, items = value
        if least > _MOST or (most is not sre.MAXREPEAT and most > _MOST):
            raise ValueError("a count is too large")
        inside = self.sequence(items, flags)
        single = len(items) == 1 and items[0][0] in (sre.LITERAL, sre.NOT_LITERAL, sre.ANY, sre.CATEGORY, sre.IN)
        if not (single and not inside.startswith("(")):
            inside = f"(?:{inside})"
        return f"{inside}{{{least},{'' if most is sre.MAXREPEAT else most}}}{suffix}"

    def on_max_repeat(self, value, flags):
        return self._repeat(value, flags, "")

    def on_min_repeat(self, value, flags):
        return self._repeat(value, flags, "?")

    def on_possessive_repeat(self, value, flags):
        return self._repeat(value, flags, "+")


@functools.lru_cache(maxsize=4096)
def java_pattern(pattern: str) -> str:
    """A Java pattern that is found in exactly the texts ``re.match`` accepts for ``pattern``."""
    try:
        re.compile(pattern)
        tree = parser.parse(pattern)
    except (re.error, RecursionError, OverflowError) as err:
        raise ValueError(f"bad pattern {pattern!r}: {err}") from None
    try:
        return rf"\A(?:{_Writer(tree.state.flags).sequence(tree, tree.state.flags)})"
    except ValueError as err:
        raise ValueError(f"pattern {pattern!r} cannot be run by Spark: {err}") from None
