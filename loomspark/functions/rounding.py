"""Number helpers shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it. Without it a chain of steps doubles its expression at each."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def round_half_up(x: Column) -> Column:
    """Nearest integer, halves toward plus infinity."""
    return F.floor(x + 0.5).cast("double")


def present(*columns: str | Column) -> Column:
    """How many of the columns are not null."""
    return sum((F.isnotnull(c).cast("int") for c in columns), F.lit(0))


#: What a case-insensitive pattern takes for an s or an i although its lower case is another letter.
_FOLDS = (("\u017f", "s"), ("\u0130", "i"), ("\u0131", "i"))
#: More literals of one pattern than this are no shorter way than the pattern.
_MOST_NEEDLES = 40


def folded(text: Column) -> Column:
    """Lower case in which every letter stands that a case-insensitive pattern takes it for."""
    return F.lower(reduce(lambda t, f: F.replace(t, F.lit(f[0]), F.lit(f[1])), _FOLDS, text))


def _best(found: list[frozenset[str]]) -> frozenset[str] | None:
    return max(found, key=lambda s: (min(map(len, s)), -len(s)), default=None)


def _options(op: str, arg) -> list[str] | None:
    """The few characters that one place of a pattern can hold, or none if they are many or not plain."""
    codes = [arg] if op == "LITERAL" else []
    for kind, x in arg if op == "IN" else ():
        if str(kind) not in ("LITERAL", "RANGE"):
            return None
        codes += [x] if str(kind) == "LITERAL" else range(x[0], min(x[1], x[0] + 5) + 1)
    chars = list(dict.fromkeys(chr(c).lower() for c in codes))
    return chars if 0 < len(chars) <= 4 and all(len(c) == 1 and (" " <= c <= "~" or c in "åäöéü£") for c in chars) else None


def _shared(parts: list[list[frozenset[str]]]) -> list[frozenset[str]]:
    """Literals that every alternative needs, as a whole or in part of its own."""
    singles = {n for p in parts for s in p if len(s) == 1 for n in s if len(n) >= 3}
    return [frozenset([c]) for c in singles if all(any(all(c in n for n in s) for s in p) for p in parts)]


def _required(tree) -> list[frozenset[str]]:
    """Sets of literals, of each of which a match holds one."""
    found, runs = [], [""]

    def flush() -> None:
        if runs[0]:
            found.append(frozenset(runs))
        runs[:] = [""]

    for op, arg in tree:
        op = str(op)
        options = _options(op, arg) if op in ("LITERAL", "IN") else None
        if options and len(runs) * len(options) <= 8:
            runs[:] = [r + o for r in runs for o in options]
            continue
        if op == "AT":
            continue
        flush()
        if options:
            runs[:] = options
        elif op == "BRANCH":
            parts = [_required(x) for x in arg[1]]
            found += (_shared(parts) or [frozenset().union(*map(_best, parts))]) if all(parts) else []
        elif op == "SUBPATTERN":
            found += _required(arg[-1])
        elif op == "ATOMIC_GROUP":
            found += _required(arg)
        elif op.endswith("_REPEAT") and arg[0] > 0:
            found += _required(arg[2])
    flush()
    return found


@cache
def needles(pattern: str) -> tuple[str, ...]:
    """Literals in lower case of which every text that the pattern matches holds one at least, once folded; none if the pattern has no such ones."""
    try:
        found = _best(_required(re._parser.parse(pattern)))
    except (AttributeError, re.error):
        return ()
    # A literal that holds another adds nothing.
    kept = sorted(n for n in found or () if not any(m != n and m in n for m in found))
    return tuple(kept) if len(kept) <= _MOST_NEEDLES else ()


def may_match(low: Column, *patterns: str) -> Column:
    """Whether a folded text holds a literal of one of the patterns. No says that none matches; yes says nothing. Looking for literals costs a tenth of a pattern."""
    wanted = [needles(p) for p in patterns]
    if not all(wanted):
        return F.lit(True)
    return reduce(Column.__or__, (low.contains(n) for n in dict.fromkeys(n for w in wanted for n in w)))


def matches(text: str | Column, pattern: str, low: Column | None = None) -> Column:
    """Case-insensitive regular-expression search; null texts don't match. Letters outside ASCII fold as well. Texts without the pattern's literals are told by these alone; ``low`` is the
    folded text where it is at hand."""
    t = F.coalesce(F.expr("''") if text is None else (F.col(text) if isinstance(text, str) else text), F.lit(""))
    found, wanted = t.rlike("(?iu)" + pattern), needles(pattern)
    if not wanted:
        return found
    if low is not None or len(wanted) == 1:
        return may_match(folded(t) if low is None else low, pattern) & found
    # Inside a lambda nothing is shared, so the folded text is bound.
    return let(folded(t), lambda x: may_match(x, pattern)) & found
