"""Text analysis and matching as row-local column expressions (SCH-01 .. SCH-06).

Matching never leaves the row: the analysed text and the query tokens meet inside
array functions, so a search is one narrow scan with no token table and no shuffle.
The query is analysed by the same expression as the text and folds to a constant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One token per Han character, otherwise runs of letters, marks and digits.
HAN = r"(\p{IsHan})"
WORD = r"[\p{L}\p{M}\p{N}]+"


def analysed(text: Column) -> Column:
    """Lower-case word tokens in order; every Han character is its own token."""
    spaced = F.regexp_replace(text, HAN, " $1 ")
    return F.regexp_extract_all(F.lower(spaced), F.lit(WORD), F.lit(0))


def query_tokens(query: str) -> Column:
    return F.array_distinct(analysed(F.lit(query)))


def match_score(text: Column, query: str) -> Column:
    """How many distinct query tokens the text holds."""
    return F.size(F.array_intersect(analysed(text), query_tokens(query)))


def contains_any(text: Column, query: str) -> Column:
    return F.arrays_overlap(analysed(text), query_tokens(query))


def contains_all(text: Column, query: str) -> Column:
    wanted = query_tokens(query)
    return (F.size(wanted) > 0) & (F.size(F.array_except(wanted, analysed(text))) == 0)


def contains_phrase(text: Column, phrase: str) -> Column:
    """Query tokens at consecutive positions.

    Tokens hold no blank, so joining them with blanks and looking for the blank-framed
    phrase finds exactly the consecutive runs.
    """
    return _framed(analysed(text)).contains(_framed(analysed(F.lit(phrase))))


def _framed(tokens: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))


def highlight(text: Column, query: str, before: str = "<em>", after: str = "</em>") -> Column:
    """Wrap every whole-token hit, keeping the case of the text.

    Tokens are letters, marks and digits only, so they need no quoting in the pattern. A
    Han token may touch its neighbours, any other token may not.
    """
    edge = r"[\p{L}\p{M}\p{N}&&[^\p{IsHan}]]"
    pattern = F.concat(
        F.lit(rf"(?iu)(?:(?<!{edge})|(?=\p{{IsHan}}))("),
        F.array_join(query_tokens(query), "|"),
        F.lit(rf")(?:(?!{edge})|(?<=\p{{IsHan}}))"),
    )
    return F.regexp_replace(text, pattern, F.lit(f"{before}$1{after}"))


def words(line: Column, keep_empty: bool = True) -> Column:
    """Blank-separated words; trailing empty ones never count, inner ones may."""
    parts = F.split(F.regexp_replace(line, " +$", ""), " ")
    return parts if keep_empty else F.filter(parts, lambda w: F.length(w) > 0)
