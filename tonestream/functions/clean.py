"""Text cleaning as built-in Column expressions (no Python UDF).

Every function takes and returns a ``Column`` so the whole cleaning chain
collapses into one projection inside whole-stage codegen. Null in gives null
out; callers decide whether null becomes ``''`` (scoring) or is dropped
(training).

Regex dialect: the cleaning was defined with Python's ``\\S`` and ``\\w``. Java's
classes of that name are ASCII, and with ``(?U)`` still not Python's (marks count
as word characters, other numbers and the separators U+001C to U+001F don't), so
Python's are spelled out here.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written for results to match).
# Spark ML's default English stop-word list (StopWordsRemover, "english"),
# 181 words, in Spark's own order.
STOP_WORDS: tuple[str, ...] = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "her",
    "hers", "herself", "it", "its", "itself", "they", "them", "their", "theirs",
    "themselves", "what", "which", "who", "whom", "this", "that", "these", "those",
    "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had",
    "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if",
    "or", "because", "as", "until", "while", "of", "at", "by", "for", "with",
    "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where",
    "why", "how", "all", "any", "both", "each", "few", "more", "most", "other",
    "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too",
    "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll",
    "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd",
    "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't",
    "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't",
    "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't",
    "cannot", "could", "here's", "how's", "let's", "ought", "that's", "there's",
    "what's", "when's", "where's", "who's", "why's", "would",
)

# NLTK's English stop-word list (the "stopwords" corpus, 179 words), in its
# own order: the list the reference's cleaning removes.
NLTK_STOP_WORDS: tuple[str, ...] = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he",
    "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's",
    "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do",
    "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because",
    "as", "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below",
    "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t",
    "can", "will", "just", "don", "don't", "should", "should've", "now", "d", "ll",
    "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't",
    "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't",
    "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn",
    "mustn't", "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn",
    "wasn't", "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
)

# Cleaning patterns (fixed values).
SPACE_CLASS = r"\t-\r\x1c-\x1f\x85\p{Z}"
WORD_CLASS = r"\p{L}\p{N}_"
URL_V1 = rf"http[^{SPACE_CLASS}]+"
URL_V2 = rf"http[^{SPACE_CLASS}]+|www\.[^{SPACE_CLASS}]+"
MENTION = rf"[@#][{WORD_CLASS}]+"
NON_LETTER = r"[^a-zA-Z]+"
BLANK = rf"\A[{SPACE_CLASS}]*\z"
# ---------------------------------------------------------------------------


STOP_WORD_LISTS = {"spark": STOP_WORDS, "nltk": NLTK_STOP_WORDS}


def stop_word_list(name: str) -> tuple[str, ...]:
    """A named stop-word list: ``nltk`` (the cleaning's) or ``spark`` (``StopWordsRemover``'s)."""
    return STOP_WORD_LISTS[name]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_urls(c: Column | str, version: str = "v2") -> Column:
    """v1: ``http\\S+`` removed; v2: ``http\\S+|www\\.\\S+`` replaced by a space."""
    if version == "v1":
        return F.regexp_replace(_col(c), URL_V1, "")
    return F.regexp_replace(_col(c), URL_V2, " ")


def strip_mentions(c: Column | str) -> Column:
    """``@user`` and ``#tag`` replaced by a space."""
    return F.regexp_replace(_col(c), MENTION, " ")


def letters_only(c: Column | str) -> Column:
    """Every run of characters that are not ASCII letters becomes one space, then
    lower case (after the replacement, so no non-ASCII letter can lower-case
    into an ASCII one)."""
    return F.lower(F.regexp_replace(_col(c), NON_LETTER, " "))


def words(c: Column | str, min_len: int = 1, stop_words: Iterable[str] | None = NLTK_STOP_WORDS) -> Column:
    """Split letters-only text on single spaces (a literal split, no regex),
    keep words of at least ``min_len`` characters that are not stop words; the
    empty strings at either end never pass. Returns ``array<string>``."""
    parts = F.split(_col(c), " ")
    stops = list(stop_words or ())

    def keep(w: Column) -> Column:
        cond = F.length(w) >= F.lit(max(min_len, 1))
        if stops:
            cond = cond & ~w.isin(stops)
        return cond

    return F.filter(parts, keep)


def clean_v1(c: Column | str, stop_words: Iterable[str] | None = NLTK_STOP_WORDS) -> Column:
    """Older cleaning: URLs removed, non-letters to space, lower, stop words out."""
    return F.array_join(words(letters_only(strip_urls(c, "v1")), 1, stop_words), " ")


def clean_v2(c: Column | str, stop_words: Iterable[str] | None = NLTK_STOP_WORDS) -> Column:
    """Canonical cleaning: URLs and mentions to space, non-letters to space, lower,
    stop words out, words of three letters or more."""
    return F.array_join(words(letters_only(strip_mentions(strip_urls(c, "v2"))), 3, stop_words), " ")


def clean_text(c: Column | str, version: str = "v2", stop_words: Iterable[str] | None = NLTK_STOP_WORDS) -> Column:
    if version == "v1":
        return clean_v1(c, stop_words)
    if version == "v2":
        return clean_v2(c, stop_words)
    raise ValueError(f"unknown cleaning version {version!r}")


def letter_text(c: Column | str) -> Column:
    """v2 cleaning without word filters: single-spaced lower-case letter words."""
    return F.trim(letters_only(strip_mentions(strip_urls(c, "v2"))))


def is_blank(c: Column | str) -> Column:
    """True when the text is empty or only (Unicode) whitespace; null stays null."""
    return _col(c).rlike(BLANK)


def text_or_empty(c: Column | str) -> Column:
    """Text as a string, null as ``''``."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def snippet(c: Column | str, n: int = 120) -> Column:
    """First ``n`` characters, newlines as spaces."""
    return F.replace(F.substring(_col(c), 1, n), F.lit("\n"), F.lit(" "))
