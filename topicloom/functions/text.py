"""Text expressions: cleaning, entity decoding, tokens, document classes.

Everything is a `Column -> Column` built from Spark's own functions, so it runs
the same in a batch and in a stream. The one exception is rare entities, which
go to Python in Arrow batches.
"""

from __future__ import annotations

import html
from collections.abc import Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Python's Unicode \s and \w, spelled out because Java's shorthands are ASCII.
SPACE = r"[\s\p{Z}\x{85}\x{0b}\x{1c}-\x{1f}]"
NOT_SPACE = r"[^\s\p{Z}\x{85}\x{0b}\x{1c}-\x{1f}]"
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"

# --- Fixed values: they decide results and must stay as they are. -------------
DOCUMENT_TYPES = {
    "diagnostic_report": (
        rf"(?i)(?:^|{NOT_WORD})lhd(?:{SPACE}*"
        r"(?:bolometer|flxloop|fpellet|interferometer|cxrs|ece|diagnostic|probe)"
        rf"(?:{NOT_WORD}|$)|{SPACE}*#?\p{{Nd}}+)"
    ),
}
DEFAULT_TYPE = "scientific_paper"
UNKNOWN_TYPE = "unknown"
BOILERPLATE_WORDS = [
    "type", "application", "departmental", "bulletin", "text",
    "論文", "記事", "表紙", "裏表紙", "奥付", "目次",
]
# ------------------------------------------------------------------------------

# Entities decoded in the JVM; any other form takes the Arrow branch. `&amp;` is
# last, so that what it produces is not decoded again.
COMMON_ENTITIES = ["lt", "gt", "quot", "apos", "nbsp", "copy", "reg", "middot",
                   "hellip", "ndash", "mdash", "lsquo", "rsquo", "ldquo", "rdquo", "amp"]


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def is_blank(c: Column) -> Column:
    """True for null, empty and Unicode-whitespace-only text."""
    return ~F.coalesce(c.rlike(NOT_SPACE), F.lit(False))


def strip(c: Column) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.regexp_replace(c, rf"^{SPACE}+|(?<!{SPACE}){SPACE}+$", "")


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def decode_entities(c: Column) -> Column:
    """HTML entities to characters, in one pass over the text."""
    known = "|".join(COMMON_ENTITIES)
    plain = c
    for name in COMMON_ENTITIES:
        plain = F.replace(plain, F.lit(f"&{name};"), F.lit(html.entities.html5[f"{name};"]))
    left_over = F.regexp_replace(c, f"&(?:{known});", " ")
    rare = c.contains("&") & left_over.rlike("&[A-Za-z#]")
    # Rows without a rare entity reach the Python worker as nulls only.
    return (F.when(rare, _unescape(F.when(rare, c)))
            .when(c.contains("&"), plain)
            .otherwise(c))


def clean_markup(c: Column, entities: bool = True) -> Column:
    """Strip tags, entities and LaTeX from a text and settle its whitespace."""
    c = F.regexp_replace(text_or_empty(c), "<[^>]++>", " ")
    if entities:
        c = decode_entities(c)
    # (?d): only \n ends a line.
    rules = [
        (r'\\"([a-zA-Z])', "$1"),
        (r"\\'", ""),
        (r"(?d)\$(.*?)\$", "$1"),
        (r"(?d)\\[a-zA-Z]+\{(.*?)\}", "$1"),
        (r"(?d)\\(?:begin|end)\{.*?\}", " "),
        (r"\\[a-zA-Z]+", ""),
    ]
    for pattern, replacement in rules:
        c = F.regexp_replace(c, pattern, replacement)
    for quotes in ("``", "''"):
        c = F.replace(c, F.lit(quotes), F.lit('"'))
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def document_type(title: Column, types: Mapping[str, str] = DOCUMENT_TYPES,
                  default: str = DEFAULT_TYPE) -> Column:
    """First class whose pattern is found in the lowered, stripped title."""
    folded = F.lower(strip(title.cast("string")))
    found = F.when(title.isNull(), F.lit(UNKNOWN_TYPE))
    for name, pattern in types.items():
        found = found.when(folded.rlike(pattern), F.lit(name))
    return found.otherwise(F.lit(default))


def starts_with_word(c: Column, words: Sequence[str] = tuple(BOILERPLATE_WORDS)) -> Column:
    """True when the text begins with one of ``words`` as a whole word."""
    alternatives = "|".join(words)
    return F.coalesce(c.rlike(f"(?iu)^(?:{alternatives})(?:{NOT_WORD}|$)"), F.lit(False))


def tokens(c: Column) -> Column:
    """Lowercase runs of word characters, single characters included."""
    return F.array_remove(F.split(F.lower(c), f"{NOT_WORD}+"), "")


def without(words: Column, drop: Iterable[str]) -> Column:
    """Drop the given words from an array of words, keeping repeats."""
    drop = sorted(set(drop))
    return F.filter(words, lambda w: ~w.isin(drop)) if drop else words


def counted(words: Column) -> Column:
    """Array of words to array of (term, tf), inside the row.

    Sorting brings repeats together; a term starts wherever a word differs from
    the one before. No row is exploded, so counting needs no shuffle.
    """
    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (ordered[i] != ordered[F.greatest(i - 1, F.lit(0))]),
        )
        return let(starts, lambda s: F.transform(
            s, lambda at, k: F.struct(
                ordered[at].alias("term"),
                (F.when(k + 1 < F.size(s), s[F.least(k + 1, F.size(s) - 1)])
                 .otherwise(F.size(ordered)) - at).cast("bigint").alias("tf"))))

    return let(F.sort_array(words),
               lambda ordered: F.when(F.size(ordered) > 0, runs(ordered)).otherwise(F.array()))


def joined(*parts: Column, sep: str) -> Column:
    """Concatenate with nulls read as empty text."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit(sep), F.coalesce(part, F.lit(""))]
    return F.concat(*pieces[1:])


def clean_answer(c: Column) -> Column:
    """A model's answer without its reasoning block."""
    return strip(F.substring_index(F.replace(c, F.lit("<think>"), F.lit("")), "</think>", -1))
