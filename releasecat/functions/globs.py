"""Shell globs as regular expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_BRACKET = re.compile(r"\[(!?)(\]?[^\]]*)\]")


def glob_to_regex(glob: str) -> str:
    """Case-sensitive whole-string pattern for ``*``, ``?``, ``[..]`` and ``[!..]``."""
    pieces = []
    position = 0
    while position < len(glob):
        character = glob[position]
        bracket = _BRACKET.match(glob, position) if character == "[" else None
        if bracket:
            pieces.append(_character_class(bracket.group(2), negated=bool(bracket.group(1))))
            position = bracket.end()
            continue
        pieces.append({"*": ".*", "?": "."}.get(character) or _quote(character))
        position += 1
    return "(?s)\\A(?:" + "".join(pieces) + ")\\z"


def matches_any(column: Column | str, globs: Iterable[str]) -> Column:
    """Does the value match at least one of the globs?"""
    value = F.col(column) if isinstance(column, str) else column
    patterns = [glob_to_regex(g) for g in globs]
    return value.rlike("|".join(patterns)) if patterns else F.lit(False)


def _character_class(body: str, negated: bool) -> str:
    members = []
    position = 0
    while position < len(body):
        low = body[position]
        if position + 2 < len(body) and body[position + 1] == "-":
            high = body[position + 2]
            if low <= high:
                members.append(f"{_quote(low)}-{_quote(high)}")
            position += 3
        else:
            members.append(_quote(low))
            position += 1
    if not members:
        # Only backward ranges: nothing is in the class, everything outside it.
        return "." if negated else "(?!)"
    return f"[{'^' if negated else ''}{''.join(members)}]"


def _quote(character: str) -> str:
    return character if character.isalnum() or character in "_ " else "\\" + character
