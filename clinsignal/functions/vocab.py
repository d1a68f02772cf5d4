"""Ordered regex vocabularies: free text -> standard code, first match wins.

Two equivalent forms:

* ``code_expr``  folds the ordered rules into one native ``CASE WHEN ... RLIKE``
  expression.  No Python at run time; it stays inside whole-stage codegen and
  needs no shuffle.  Right for short rule lists (the shipped ones have 5).
* the table-driven form for long vocabularies is an operator
  (``operators.enrich.code_join``): it runs a batch kernel over the rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinsignal.functions.text import normalize_text

# ---------------------------------------------------------------------------
# Fixed values (must equal the source pipeline's vocabularies): pattern, code,
# in priority order; plus the codes used when nothing matches.
# ---------------------------------------------------------------------------
RXNORM_RULES = [
    (r"\b(amlodipin[e]?|norvasc)\b", "17767"),
    (r"\b(lisinopril|lisinosyn|prinivil|zestril)\b", "29302"),
    (r"\b(simvastatin|zocor)\b", "json_36561"),
    (r"\b(metformin|glucophage)\b", "311654"),
    (r"\b(ibuprofen|advil|motrin)\b", "5640"),
]
RXNORM_DEFAULT = "00000"

SNOMED_RULES = [
    (r"\b(kidney|renal|creatinine|nephro)\b.*(injury|damage|elevated|failure)\b", "709044004"),
    (r"\b(muscle pain|myalgia|rhabdo|muscle ache)\b", "450428004"),
    (r"\b(rash|swelling|urticaria|injection site)\b", "266395002"),
    (r"\b(dizzy|dizziness|lightheaded|vertigo)\b", "404640003"),
    (r"\b(cough|dry cough|persistent cough)\b", "450428004"),
]
SNOMED_DEFAULT = "000000000"
# ---------------------------------------------------------------------------

# Java's `.` also stops at \r, U+0085, U+2028/9; UNIX_LINES makes it stop at
# \n only, like the regex engines the rules were written for.
JAVA_PREFIX = "(?d)"

# The rules' classes as their engines read them, over all scripts: letters, numbers
# and the underscore; decimal digits; white space with the separators and U+0085.
# Java's own are ASCII-only, and its word boundary also counts combining marks.
CLASSES = {"w": r"\p{L}\p{N}_", "d": r"\p{Nd}", "s": r"\s\x0B\x1C-\x1F\x85\p{Z}"}
_W = f"[{CLASSES['w']}]"
BOUNDARY = f"(?:(?<={_W})(?!{_W})|(?<!{_W})(?={_W}))"
NO_BOUNDARY = f"(?:(?<={_W})(?={_W})|(?<!{_W})(?!{_W}))"


def _class(letter: str, inside: bool) -> str | None:
    """A class escape in Java's words; ``inside`` brackets a plain one needs none of its own."""
    members = CLASSES.get(letter.lower())
    if members is None:
        return None
    if letter.isupper():
        return f"[^{members}]"
    return members if inside else f"[{members}]"


def java_pattern(pattern: str) -> str:
    """The rule for Java's engine, with the meaning it has in the engine it was written for."""
    out, i, inside = [], 0, False
    while i < len(pattern):
        ch, following = pattern[i], pattern[i + 1 : i + 2]
        if ch == "\\":
            named = _class(following, inside)
            if not inside and following in ("b", "B"):
                named = BOUNDARY if following == "b" else NO_BOUNDARY
            out.append(named or ch + following)
            i += 2
            continue
        if not inside and ch == "[":
            inside = True
            head = re.match(r"\[\^?\]?", pattern[i:])[0]  # a bracket in first place is a member
            out.append(head.replace("]", "\\]"))
            i += len(head)
            continue
        if inside and ch == "]":
            inside = False
        elif inside and ch in "[&":  # plain members here, operators in Java
            ch = "\\" + ch
        out.append(ch)
        i += 1
    return JAVA_PREFIX + "".join(out)


_QUANTIFIERS = set("?*+{")
_METACHARS = set("[](){}?*+.\\^$|") | _QUANTIFIERS


def _outer_alternative(pattern: str) -> bool:
    """A ``|`` outside all groups (one in a character class counts too: only the pre-check is lost)."""
    depth = 0
    for ch in re.sub(r"\\.", "", pattern):
        depth += (ch == "(") - (ch == ")")
        if ch == "|" and depth == 0:
            return True
    return False


def required_words(pattern: str) -> list[str] | None:
    """Literal words one of which must occur in any text the pattern matches.

    For patterns shaped ``\\b(alt|alt|...)...`` (all shipped rules), each
    alternative cut before its first regex metacharacter (one character
    earlier when that is a quantifier).  ``None`` for any other shape: no
    pre-check is used then.  A group that may be skipped (a quantifier follows)
    and a pattern with alternatives outside the group require none of its words.
    """
    if not pattern.startswith("\\b("):
        return None
    close = pattern.find(")", 3)
    if close > 0 and (pattern[close + 1 : close + 2] in _QUANTIFIERS or _outer_alternative(pattern)):
        return None
    group = pattern[3:close] if close > 0 else ""
    if not group or "(" in group or "\\" in group:
        return None
    words = []
    for alt in group.split("|"):
        cut = next((i for i, ch in enumerate(alt) if ch in _METACHARS), len(alt))
        if cut < len(alt) and alt[cut] in _QUANTIFIERS:
            cut -= 1
        if cut <= 0:
            return None
        words.append(alt[:cut])
    return words


def rule_hit(normalized: Column, pattern: str) -> Column:
    """``normalized RLIKE pattern``, behind a literal pre-check when one exists.

    A byte search for the rule's required words is far cheaper than a regex
    scan of a long text; ``AND`` short-circuits, so the regex only runs on
    texts that contain one of them.  The result is the same either way.
    """
    regex = normalized.rlike(java_pattern(pattern))
    words = required_words(pattern)
    if not words:
        return regex
    present = None
    for w in words:
        c = normalized.contains(w)
        present = c if present is None else present | c
    return present & regex


def code_expr(text: Column | str, rules: list[tuple[str, str]], default: str) -> Column:
    """Native first-match coder: null / empty / no match -> ``default``."""
    normalized = normalize_text(text)
    expr = None
    for pattern, code in rules:
        hit = rule_hit(normalized, pattern)
        expr = F.when(hit, F.lit(code)) if expr is None else expr.when(hit, F.lit(code))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def rxnorm_code(text: Column | str) -> Column:
    return code_expr(text, RXNORM_RULES, RXNORM_DEFAULT)


def snomed_code(text: Column | str) -> Column:
    return code_expr(text, SNOMED_RULES, SNOMED_DEFAULT)
