"""Column expressions for text, terms and URLs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Paragraph separator, length of a telling paragraph, words that
# open a question, and the name of the redirect parameter of result links.
BLANK_LINE = "\n\n"
LONG_PARAGRAPH = 40
QUESTION_WORDS = ["what", "how", "why", "when", "where", "who"]
QUESTION_PREFIX = "what is "
REDIRECT_PARAMETER = "uddg"

_SPACE = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends."""
    return F.regexp_replace(text, rf"(?U)^{_SPACE}+|{_SPACE}+\z", "")


def join_paragraphs(parts: Column) -> Column:
    return F.array_join(parts, BLANK_LINE)


def split_paragraphs(text: Column) -> Column:
    return F.split(text, BLANK_LINE, -1)


def long_paragraphs(parts: Column, longer_than: int = LONG_PARAGRAPH) -> Column:
    return F.filter(parts, lambda p: F.length(p) > longer_than)


def term_pattern(term: str) -> str:
    """Pattern of a whole word, any case, every character taken literally."""
    quoted = term.replace("\\E", "\\E\\\\E\\Q")
    return rf"(?iU)\b\Q{quoted}\E\b"


def has_term(text: Column, term: str) -> Column:
    return text.rlike(term_pattern(term))


def context(parts: Column, position: Column, size: int) -> Column:
    """Paragraphs up to ``size`` before and after a position (from 0), joined."""
    first = F.greatest(position - F.lit(size), F.lit(0))
    last = F.least(position + F.lit(size), F.size(parts) - 1)
    return join_paragraphs(F.slice(parts, first + 1, last - first + 1))


def url_host(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))


def encode_query(text: Column) -> Column:
    return F.url_encode(text)


def unwrap_redirect(url: Column, parameter: str = REDIRECT_PARAMETER) -> Column:
    """Target of a site-relative redirect link; other links stay as they are."""
    whole = F.concat(F.lit("http://host"), url)
    target = F.try_url_decode(F.try_parse_url(whole, F.lit("QUERY"), F.lit(parameter)))
    return F.when(url.startswith("/"), F.coalesce(F.nullif(target, F.lit("")), url)).otherwise(url)


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: F.length(w) > 0)


def first_words(text: Column, n: int = 2) -> Column:
    return F.array_join(F.slice(words(text), 1, n), " ")


def is_question(text: Column) -> Column:
    """Starts with a question word (also as the start of a longer word)."""
    hit = F.lit(False)
    for word in QUESTION_WORDS:
        hit = hit | F.lower(text).startswith(word)
    return hit


def fallback_query(query: Column) -> Column:
    """What to ask when a query found nothing; NULL when nothing is left to try."""
    shorter = first_words(query)
    return (
        F.when(query.contains(" ") & (shorter != query), shorter)
        .when(~is_question(query), F.concat(F.lit(QUESTION_PREFIX), query))
    )


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"(?U)[^\p{L}\p{N}]+"), lambda t: F.length(t) > 0)
