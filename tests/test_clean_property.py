"""Cleaning against its specification: a table of cases, and a scanner that reads character by character."""

import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tonestream.functions import clean

#: (text, older cleaning, canonical cleaning)
CASES = [
    ("I love http://t.co/x so much!", "love much", "love much"),
    ("www.site.com is down", "www site com", ""),
    ("@user thanks #great day", "user thanks great day", "thanks day"),
    ("@joséabc fine day", "jose abc fine day", "abc fine day"),
    ("@user²abc fine day", "user abc fine day", "fine day"),
    ("http://x\x1cgood day", "good day", "good day"),
    ("http://x good day", "good day", "good day"),
    ("didn't isn wouldn could cannot", "could cannot", "could cannot"),
    ("naïve 3rd x_y", "na rd x", ""),
    ("http www. @ #", "http www", "http www"),
    ("abhttp://q cd", "ab cd", ""),
    ("", "", ""),
    ("İSTANBUL Kelvin", "stanbul elvin", "stanbul elvin"),
]


@pytest.mark.parametrize("text, v1, v2", CASES)
def test_table(spark, text, v1, v2):
    row = spark.createDataFrame([(text,)], "t string").select(clean.clean_v1("t").alias("v1"), clean.clean_v2("t").alias("v2")).first()
    assert (row.v1, row.v2) == (v1, v2)


def gap(c):
    return c.isspace()


def in_word(c):
    return c == "_" or unicodedata.category(c)[0] in "LN"


def without(text, starts, inside, instead):
    """The text with each start mark and the longest run of ``inside`` characters behind it replaced."""
    out, i = [], 0
    while i < len(text):
        mark = next((m for m in starts if text.startswith(m, i) and i + len(m) < len(text) and inside(text[i + len(m)])), None)
        if mark is None:
            out.append(text[i])
            i += 1
            continue
        i += len(mark)
        while i < len(text) and inside(text[i]):
            i += 1
        out.append(instead)
    return "".join(out)


def letter_words(text):
    words, word = [], ""
    for c in text + " ":
        if "a" <= c <= "z" or "A" <= c <= "Z":
            word += c
        elif word:
            words.append(word.lower())
            word = ""
    return [w for w in words if w not in clean.NLTK_STOP_WORDS]


def scan(text):
    plain = without(text, ["http"], lambda c: not gap(c), "")
    marks = without(without(text, ["http", "www."], lambda c: not gap(c), " "), ["@", "#"], in_word, " ")
    return " ".join(letter_words(plain)), " ".join(w for w in letter_words(marks) if len(w) > 2)


PIECES = st.sampled_from([
    "http://t.co/x", "https://a.b/c?d=1", "www.site.com", "@user", "#tag", "@joséabc", "#_x1", "http", "www", "www.", "@", "#", "The", "quick",
    "Brown", "fox's", "don't", "I", "it", "AND", "didn", "could", "été", "naïve", "Straße", "12345", "3rd", "x_y", "!!!", ",", ".", " ",
    "  ", "\t", "\n", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", " ", " ", " ", "​", "́", "²", "Ⅷ", "‿", "‍", "-",
    "'", '"', "great", "loves", "awful"])
TEXTS = st.lists(PIECES, min_size=0, max_size=25).map("".join)


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(TEXTS, min_size=1, max_size=20))
def test_scanner(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.orderBy("i").select(clean.clean_v1("t").alias("v1"), clean.clean_v2("t").alias("v2")).collect()
    assert [(r.v1, r.v2) for r in rows] == [scan(t) for t in texts]
