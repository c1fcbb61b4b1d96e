"""Review-text cleaning as native column expressions.

Per review: lower-case, strip HTML tags, strip everything but ASCII letters, digits
and whitespace, split on whitespace, drop stop words, re-join with single spaces.
The regular expressions are written so that Java (Spark) and RE2 (DuckDB) match
exactly what Python's ``re`` matches in the reference.
"""

from __future__ import annotations

import functools
import glob
import os
import zipfile

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's ``\s`` for str patterns, spelled out because ``\s`` is ASCII-only in Java
# and in RE2 (fixed values: U+0009-000D, U+001C-0020, U+0085, U+00A0, U+1680,
# U+2000-200A, U+2028, U+2029, U+202F, U+205F, U+3000).
WHITESPACE_CLASS = (r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# ``<.*?>`` where ``.`` is anything but a newline, as in Python (Java's ``.`` would
# also stop at \r and other line terminators).
HTML_TAG = r"<[^\n]*?>"
NOT_KEPT = r"[^a-zA-Z0-9" + WHITESPACE_CLASS + r"]"
WHITESPACE_RUN = r"[" + WHITESPACE_CLASS + r"]+"

# The same whitespace as characters, and the only two non-ASCII characters whose
# lower case contains an ASCII letter (U+0130 -> "i" + combining dot, U+212A -> "k").
_WHITESPACE_CHARS = "".join(chr(c) for c in (
    *range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
_LOWERS_TO_ASCII = {"\u0130": "i", "\u212a": "k"}


def normalise_text(text: Column) -> Column:
    r"""Lower-case, drop tags, keep only ASCII letters, digits and whitespace; every
    whitespace character comes out as a plain space.  A NULL (non-text) input
    becomes the empty string.  "não" becomes "no".

    Same tokens as lower -> strip ``<.*?>`` -> strip ``[^a-zA-Z0-9\s]``, but cheaper:
    whitespace is mapped to " " by ``translate`` (a per-character table), so the
    character class to strip is ASCII-only, and lower-casing runs on ASCII text.
    Tags are stripped first (lower-casing never creates or moves "<", ">" or a
    newline), and the two characters that lower-case to ASCII are mapped up front.
    """
    t = F.regexp_replace(F.coalesce(text, F.lit("")), HTML_TAG, "")
    src = _WHITESPACE_CHARS + "".join(_LOWERS_TO_ASCII)
    dst = " " * len(_WHITESPACE_CHARS) + "".join(_LOWERS_TO_ASCII.values())
    t = F.translate(t, src, dst)
    # ``\p{Alnum}`` is ASCII [a-zA-Z0-9] in Java; this spelling of the class runs
    # several times faster than the explicit negated ranges.
    return F.lower(F.regexp_replace(t, r"[^\p{Alnum} ]+", ""))


def tokens(text: Column) -> Column:
    """Words of a normalised text (split on runs of spaces), empty strings dropped.
    (``array_remove`` rather than a lambda filter keeps the stage in generated code.)"""
    return F.array_remove(F.split(F.trim(text), " +"), "")


def terms(token_array: Column, min_length: int = 2) -> Column:
    """Tokens a TF-IDF vocabulary counts: at least ``min_length`` characters (on
    cleaned text these are exactly the ``\\b\\w\\w+\\b`` matches)."""
    return F.filter(token_array, lambda w: F.length(w) >= min_length)


def join_tokens(token_array: Column) -> Column:
    return F.array_join(token_array, " ")


def _stopwords_from_jar(language: str) -> list[str] | None:
    """The list as a file of the Spark ML jar, if the jar can be found: under
    ``$SPARK_HOME``, or beside an unzipped pyspark."""
    import pyspark

    homes = [os.environ.get("SPARK_HOME"), os.path.dirname(os.path.abspath(pyspark.__file__))]
    for home in filter(None, homes):
        for jar in glob.glob(os.path.join(home, "jars", "spark-mllib_*.jar")):
            with zipfile.ZipFile(jar) as z:
                data = z.read(f"org/apache/spark/ml/feature/stopwords/{language}.txt")
                return [w for w in data.decode("utf-8").split("\n") if w]
    return None


@functools.lru_cache(maxsize=None)
def default_stopwords(language: str = "portuguese") -> list[str]:
    """The stop-word list bundled with Spark ML (the one ``StopWordsRemover`` loads).
    Read from the installed jar where there is one in sight (no JVM needed), else
    through the running session, as with pyspark imported from ``pyspark.zip``."""
    words = _stopwords_from_jar(language)
    if words is None:
        from pyspark.ml.feature import StopWordsRemover

        words = [w for w in StopWordsRemover.loadDefaultStopWords(language) if w]
    return words
