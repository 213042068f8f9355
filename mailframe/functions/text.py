"""Text filters over whole texts (F10, F11, F13): tokens, match, phrase, substring.

A token is a maximal run of letters and digits, lower-cased.  ``match`` and
``match_phrase`` compile to one JVM regex over the lower-cased text, so no token
array is built per row; ``tokens`` builds the array when the caller needs it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: token separator (anything that is not a letter or a digit).
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
_SEP = r"[^\p{L}\p{N}]"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def query_tokens(query: str) -> list[str]:
    """Tokens of a query string (driver side; the query is configuration, not data)."""
    return [t for t in re.split(r"[\W_]+", query.lower()) if t]


def tokens(text: str | Column) -> Column:
    return F.filter(F.split(F.lower(_c(text)), TOKEN_SPLIT), lambda t: t != F.lit(""))


def match(text: str | Column, query: str) -> Column:
    """the text holds any token of the query."""
    toks = query_tokens(query)
    if not toks:
        return F.lit(False)
    alt = "|".join(re.escape(t) for t in toks)
    low = F.lower(_c(text))
    # cheap substring test first; the token-boundary regex only runs on candidates
    maybe = None
    for t in toks:
        maybe = low.contains(t) if maybe is None else (maybe | low.contains(t))
    return F.coalesce(maybe & low.rlike(f"(^|{_SEP})({alt})({_SEP}|$)"), F.lit(False))


def match_phrase(text: str | Column, phrase: str) -> Column:
    """the query tokens occur consecutively and in order."""
    toks = query_tokens(phrase)
    if not toks:
        return F.lit(False)
    body = (_SEP + "+").join(re.escape(t) for t in toks)
    low = F.lower(_c(text))
    longest = max(toks, key=len)
    return F.coalesce(low.contains(longest) & low.rlike(f"(^|{_SEP}){body}({_SEP}|$)"), F.lit(False))


def contains(text: str | Column, needle: str) -> Column:
    """plain substring test on the source text."""
    return F.coalesce(_c(text).contains(needle), F.lit(False))
