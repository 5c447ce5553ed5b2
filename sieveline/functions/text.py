"""Text as Column functions. Null and '' both mean missing: clean() makes them null."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)\s+"


def _fold_table() -> tuple[str, str]:
    """Latin letters with a decomposition (U+00C0 to U+024F) and their base letters."""
    pairs = [(c, unicodedata.normalize("NFD", c)[0]) for c in map(chr, range(0xC0, 0x250))]
    pairs = [(c, b) for c, b in pairs if b != c and b.isascii()]
    return "".join(c for c, _ in pairs), "".join(b for _, b in pairs)


_FROM, _TO = _fold_table()


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is taken once."""
    return F.transform(F.array(value), f)[0]


def clean(c: str | Column) -> Column:
    """Trimmed; null where nothing is left."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def first_filled(*cs: str | Column) -> Column:
    return F.coalesce(*[clean(c) for c in cs])


def fold(c: str | Column) -> Column:
    """Latin letters without their accents."""
    return F.translate(col(c), _FROM, _TO)


def aggressive_form(c: str | Column) -> Column:
    """Lower case, no accents, nothing but 0-9 and a-z."""
    return F.regexp_replace(fold(F.lower(col(c))), "[^0-9a-z]", "")


def match_key(c: str | Column) -> Column:
    """Lower case, no accents, spaces collapsed; punctuation stays."""
    return squeeze(fold(F.lower(col(c))))


def squeeze(c: str | Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(col(c), SPACE, " "))


def slug(c: str | Column, length: int = 96) -> Column:
    s = F.regexp_replace(fold(F.lower(col(c))), "[^0-9a-z]+", "-")
    return F.substring(F.regexp_replace(s, "^-+|-+$", ""), 1, length)


def stable_slug(c: str | Column, length: int = 40) -> Column:
    """A slug with a hash of the whole value, for values that share a beginning."""
    return F.concat(slug(c, length), F.lit("-"), F.substring(F.sha1(col(c)), 1, 8))


def clean_cell(c: str | Column, most: int) -> Column:
    """struct(value, cut): control characters and line ends as spaces, collapsed, trimmed, cut to most characters."""
    v = squeeze(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"[\x00-\x1F\x7F]", " "))
    return F.struct(F.substring(v, 1, most).alias("value"), (F.length(v) > most).alias("cut"))


def clean_headers(names: list[str | None]) -> list[str]:
    """Names without BOM and control characters, numbered from 2 on collision."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        n = "".join(ch for ch in (n or "").lstrip("﻿") if ch.isprintable()).strip() or "column"
        seen[n] = seen.get(n, 0) + 1
        out.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return out


def dehyphenate(c: str | Column) -> Column:
    """Words that a line end has split with a hyphen, joined."""
    return F.regexp_replace(col(c), r"([\p{L}\p{N}_])-\n([\p{Ll}])", "$1$2")


# Characters that scanners and word processors put for plain ones.
_OCR_FROM = "“”‘’–— •"
_OCR_TO = "\"\"''-- *"


def plain_characters(c: str | Column) -> Column:
    return F.replace(F.translate(col(c), _OCR_FROM, _OCR_TO), F.lit("…"), F.lit("..."))


#: What stands inside a math span, by pattern and what it says in plain text, in the order of use.
_MATH = (
    (r"\\(?:text|textrm|textbf|textit|mathrm|mathbf|mathit|operatorname)\s*\{([^{}]*)\}", "$1"),
    (r"\\[dt]?frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", "$1/$2"),
    (r"\s*\^\s*\{\s*\\prime\s*\\prime\s*\}", "″"),
    (r"\s*\^\s*(?:\{\s*\\prime\s*\}|\\prime\b)", "′"),
    (r"([0-9])\s*\^\s*(?:\{\s*(?:\\circ|[oº])\s*\}|\\circ\b|[oº](?![A-Za-z]))", "$1º"),
    (r"([0-9])\s*\^\s*(?:\{\s*[aª]\s*\}|[aª](?![A-Za-z]))", "$1ª"),
    (r"\s*\\%", "%"),
    (r"\\S(?![A-Za-z])\s*", "§ "),
    (r"\\l?dots\b", "…"),
    (r"\\times\b", "×"),
    (r"\\[,;:! ]|~", " "),
    (r"\s+", " "),
)


def latex_plain(c: str | Column) -> Column:
    """Math spans as plain text: percent signs, ordinals, fractions, primes, upright text, roman numbers; ordinals also without a span around them.

    A span that has a command, a brace, a power or an index left stays as it was, whole, and so does one
    without anything to put right: two sums of money are no span. Null for null.
    """
    marked = F.regexp_replace(col(c), r"(?<![A-Za-z$\\])\$([^$\n]*[\\^][^$\n]*|\s*[IVXLCDM]+\s*)\$", "\x01$1\x02")

    def plain(piece: Column) -> Column:
        inner = F.regexp_replace(piece, "[\x01\x02]", "")
        v = inner
        for pattern, said in _MATH:
            v = F.regexp_replace(v, pattern, said)
        return F.when(~piece.startswith("\x01"), piece).when(v.rlike(r"[\\^_{}]"), F.concat(F.lit("$"), inner, F.lit("$"))).otherwise(F.trim(v))

    pieces = F.split(marked, "(?=\x01)|(?<=\x02)")
    return F.regexp_replace(F.array_join(F.transform(pieces, plain), ""), r"\b([0-9]+)\s*\^\s*(?:\{\s*\\circ\s*\}|\\circ\b)(?![^$\n]*\$)", "$1º")


def latex_residue(c: str | Column) -> Column:
    return F.regexp_count(col(c), F.lit(r"\$[^$\n]+\$|\\[a-zA-Z]+"))


def no_images(c: str | Column) -> Column:
    """Image lines out, at most one blank line in a row."""
    v = F.regexp_replace(col(c), r"(?m)^!\[[^\]\n]*\]\([^)\n]*\)[ \t]*\n?", "")
    return F.trim(F.regexp_replace(v, r"\n{3,}", "\n\n"))


def split_provisions(c: str | Column) -> Column:
    """A new line before an article or paragraph sign that follows the end of a sentence."""
    return F.regexp_replace(col(c), r"(?<=[.;:]) +(?=(?:Art\. ?[0-9]|§ ?[0-9]))", "\n")


def collapse_doubled(c: str | Column) -> Column:
    """A text that is one text twice (with a space between) is that text once."""
    v, n = squeeze(c), F.length(squeeze(c))
    half = F.substring(v, F.lit(1), F.floor(n / 2).cast("int"))
    return F.when((n > 2) & (v == F.concat(half, F.lit(" "), half)), half).otherwise(v)


def token_estimate(c: str | Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.length(col(c)) / 4)).cast("long")


def noise_counts(c: str | Column) -> list[Column]:
    v = F.coalesce(col(c), F.lit(""))
    count = lambda p: F.regexp_count(v, F.lit(p)).cast("long")
    return [
        F.length(v).cast("long").alias("chars"),
        count("[0-9]").alias("digits"),
        count(r"[|\\$^{}<>]").alias("residue"),
        count("\n").alias("line_ends"),
        count("  +").alias("double_spaces"),
    ]


def quality_alert(c: str | Column) -> Column:
    """ok, check or critical, by traces of truncation and of wrong decoding."""
    v = F.coalesce(F.trim(col(c)), F.lit(""))
    return (
        F.when(F.length(v) < 20, "critical")
        .when(v.rlike("Ã[\u0080-¿]|�"), "critical")
        .when(v.rlike(r"(?:\.\.\.|,| (?:and|of|the|de|und))$"), "check")
        .otherwise("ok")
    )


def truncated(c: str | Column, most: int, mark: str = "...") -> Column:
    """At most so many characters, cut before a word, with a mark where something was cut."""
    v = squeeze(c)
    cut = F.regexp_replace(F.substring(v, 1, most - len(mark) + 1), r"\s*\S*$", "")
    return F.when(F.length(v) <= most, v).otherwise(F.concat(F.regexp_replace(cut, r"[,;:\s]+$", ""), F.lit(mark)))


def looks_unfinished(c: str | Column) -> Column:
    return F.lower(F.trim(col(c))).rlike(r"(?:\b(?:and|or|of|the|to|in|with|de|la|und|der)|[,;:-])$")


def title_case(c: str | Column, small=("of", "the", "and", "de", "der", "la")) -> Column:
    """Initials as capitals but for small words; words all in capitals of up to three letters stay."""
    words = F.split(squeeze(c), " ")
    one = lambda w, i: F.when((i > 0) & F.lower(w).isin(*small), F.lower(w)).when((F.length(w) <= 3) & (w == F.upper(w)) & w.rlike("[A-Z]"), w).otherwise(F.initcap(w))
    return F.array_join(F.transform(words, one), " ")


def sentences(c: str | Column) -> Column:
    """Pieces that end with . ! or ? before a space."""
    return F.filter(F.transform(F.split(col(c), r"(?<=[.!?])\s+"), lambda x: F.trim(x)), lambda x: x != "")


def sentences_of(text: str | None) -> list[str] | None:
    """As sentences(), but ends inside parentheses don't split; parentheses without a partner count as plain characters."""
    if text is None:
        return None
    opened, steps = [], {}
    for m in re.finditer(r"[()]", text):
        if m[0] == "(":
            opened.append(m.start())
        elif opened:
            steps[opened.pop()], steps[m.start()] = 1, -1
    places, depth, k, start, out = sorted(steps), 0, 0, 0, []
    for m in re.finditer(r"(?<=[.!?])\s+", text, re.ASCII):
        while k < len(places) and places[k] < m.start():
            depth, k = depth + steps[places[k]], k + 1
        if not depth:
            out.append(text[start : m.start()])
            start = m.end()
    return [p for p in (x.strip(" ") for x in [*out, text[start:]]) if p]


def whole_sentences(c: str | Column) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(sentences_of)

    return F.pandas_udf(run, "array<string>")(col(c))


def pieces(c: str | Column, size: int) -> Column:
    """The text in pieces of so many characters."""
    n = F.greatest(F.ceil(F.length(col(c)) / size).cast("int"), F.lit(1))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(col(c), i * size + 1, F.lit(size)))


def repair_mojibake(c: str | Column) -> Column:
    """UTF-8 that was read as Latin-1, read again; texts without its traces stay."""
    again = F.decode(F.encode(col(c), "ISO-8859-1"), "UTF-8")
    return F.when(col(c).rlike("[ÂÃ][\u0080-¿]"), again).otherwise(col(c))


def short_summary(c: str | Column, most: int = 240) -> Column:
    return truncated(F.regexp_extract(squeeze(c), r"^(.*?[.!?])(?:\s|$)", 1), most)


def difficulty(c: str | Column, stop_words: tuple[str, ...]) -> Column:
    """hard for fewer than 120 words or a share of stop words under 0.14, else easy."""
    words = F.filter(F.split(F.lower(col(c)), r"[^\p{L}]+"), lambda w: w != "")
    share = F.size(F.filter(words, lambda w: w.isin(*stop_words))) / F.greatest(F.size(words), F.lit(1))
    return F.when((F.size(words) < 120) | (share < 0.14), "hard").otherwise("easy")
