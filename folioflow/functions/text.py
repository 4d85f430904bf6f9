"""Text functions: alphabets, normalisers, cleaners and counts as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Code point ranges of each alphabet (fixed values).
ALPHABETS = {
    "verify": ((0x1200, 0x137F), (0x1380, 0x139F), (0x2D80, 0x2DDF)),
    "build": ((0x1200, 0x137F),),
    "v1": ((0x1200, 0x137F), (0x1380, 0x139F), (0x2D80, 0x2DDF), (0xAB00, 0xAB2F)),
    "ethiopic": ((0x1200, 0x137F), (0x2D80, 0x2DDF)),
    "letter": ((0x1200, 0x135A), (0x2D80, 0x2DDF)),
    "numeral": ((0x1369, 0x137C),),
    "latin": ((0x41, 0x5A), (0x61, 0x7A)),
    "digit": ((0x30, 0x39),),
}


def char_class(ranges, negate: bool = False) -> str:
    """A regular expression class that Java, RE2 and Python read alike."""
    body = "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in ranges)
    return f"[{'^' if negate else ''}{body}]"


@F.pandas_udf(T.StringType())
def nfc(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Canonical composition; Spark has no function for it."""
    for s in texts:
        yield s.map(lambda t: t if t is None or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t))


def composed(text: Column) -> Column:
    """NFC where it can matter: ASCII texts never enter Python."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), nfc(text)).otherwise(text)


def keep_alphabet(text: Column, ranges) -> Column:
    """Drops every character outside the ranges."""
    return F.regexp_replace(text, char_class(ranges, negate=True), "")


def normalize(text: Column, alphabet: str = "verify") -> Column:
    """The verify and build normalisers: NFC, then the alphabet's characters only."""
    return keep_alphabet(composed(text), ALPHABETS[alphabet])


def normalize_v1(text: Column) -> Column:
    """The archived normaliser: no NFC, and numerals go as well."""
    return F.regexp_replace(keep_alphabet(text, ALPHABETS["v1"]), char_class(ALPHABETS["numeral"]), "")


def count_in(text: Column, ranges) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(char_class(ranges))), F.lit(0)).cast("long")


def first_in(text: Column, ranges, n: int = 20) -> Column:
    """The first n characters of the ranges, joined."""
    return F.substring(keep_alphabet(text, ranges), 1, n)


#: White space as str.isspace() has it (fixed values): the characters, and a class that Java, RE2 and Python read alike.
SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_SPACE = "[^" + SPACE[1:]
#: White space but for the line feed.
INLINE = SPACE.replace(r"\x09-\x0D", r"\x09\x0B-\x0D")
#: The spellings of the four-dot full stop (fixed values).
FULL_STOP = "::|፡፡|：："


def strip(text: Column) -> Column:
    """White space of any kind off both ends."""
    return F.btrim(text, F.lit(SPACES))


def clean_text(text: Column) -> Column:
    """The reading cleaner; the order of the steps matters.

    Emphasis marks and stray ideographic commas go, typed guillemets become real
    ones, heading marks (with white space after them) go with the white space
    before, line wraps become a space, doubled colons a full stop that takes the
    white space before it, runs of blanks one blank.
    """
    t = F.regexp_replace(text, r"\*\*|、", "")
    t = F.replace(F.replace(t, F.lit("<<"), F.lit("«")), F.lit(">>"), F.lit("»"))
    # Each run of white space is entered once, at its first character, and never given back, so time grows with the text.
    t = F.regexp_replace(t, rf"(?:\A|\G(?<=\n)|(?<!{SPACE})({INLINE}*+\n)){SPACE}*+#++{SPACE}++", "$1")
    t = F.regexp_replace(t, rf"(?<!{SPACE}){INLINE}*+\n{SPACE}*+", " ")
    t = F.regexp_replace(t, rf"(?<!{SPACE}){SPACE}*+(?:{FULL_STOP})", "።")
    t = F.regexp_replace(t, r"[ \t]{2,}", " ")
    return strip(t)


#: Addresses and names that mark a watermark line (fixed values).
WATERMARK = r"(?i)(www\.|https?://|zenadebretsion|debretsion|\.org|\.com|gmail|facebook)"
#: A line of nothing but these is a page number (fixed values).
PAGE_NUMBER = r"^[0-9 .,:;\-_()\[\]{}|/\\፡።፣፤፥፦፧፨፩-፼]+$"


def line_reason(line: Column, script=ALPHABETS["v1"], latin=ALPHABETS["latin"], page_number: str = PAGE_NUMBER, watermark: str = WATERMARK) -> Column:
    """Why a stripped line of recognised text is not body text (archived cleaner), or null for one that stays."""
    say = lambda text, most: F.concat(F.lit(f"{text}: "), F.substring(line, 1, most))
    foreign = (count_in(line, script) == 0) & (count_in(line, latin) > 0)
    return F.when(line.rlike(watermark), say("website/watermark", 120)).when(line.rlike(page_number), say("page number", 80)).when(foreign, say("latin artifact", 120))


def clean_lines(text: Column, script=ALPHABETS["v1"], latin=ALPHABETS["latin"], page_number: str = PAGE_NUMBER, watermark: str = WATERMARK) -> Column:
    """struct(text, removed): the archived cleaner, inside the row.

    Lines are stripped and blanks in them squeezed; dropped lines are listed with
    their reason; stretches of blank lines become one, and none stays at the ends.
    """
    lines = F.transform(F.split(F.regexp_replace(text, r"\r\n?", "\n"), "\n"), lambda x: strip(x))
    marked = F.transform(lines, lambda x: F.struct(x.alias("t"), F.when(x != "", line_reason(x, script, latin, page_number, watermark)).alias("why")))
    removed = F.transform(F.filter(marked, lambda x: x["why"].isNotNull()), lambda x: x["why"])
    kept = F.filter(marked, lambda x: x["why"].isNull())
    # A kept line is preceded by a blank one where a blank line came since the last kept one.
    body = F.array_join(F.transform(kept, lambda x: F.regexp_replace(x["t"], r"[ \t]+", " ")), "\n")
    return F.struct(F.btrim(F.regexp_replace(body, r"\n{3,}", "\n\n"), F.lit("\n")).alias("text"), removed.alias("removed"))


def verse_split(text: Column, category: Column, numeral: str) -> Column:
    """struct(verse, text, cut): numerals that open a text region, with an optional dot and white space after them, and how much is cut off."""
    p = rf"^({numeral}+)\.?{SPACE}+"
    own = category.isin("Text", "List-item")
    head = F.when(own, F.regexp_extract(text, p, 0)).otherwise("")
    verse = F.when(own, F.regexp_extract(text, p, 1)).otherwise("")
    cut = F.coalesce(F.length(head), F.lit(0))
    return F.struct(verse.alias("verse"), F.substr(text, cut + 1).alias("text"), cut.alias("cut"))


def shift_runs(runs: Column, cut: Column) -> Column:
    """Marked stretches (s, e) after `cut` characters went from the front."""
    left = F.filter(runs, lambda r: r["e"] > cut)
    return F.transform(left, lambda r: F.struct(F.greatest(F.lit(0), r["s"] - cut).alias("s"), (r["e"] - cut).alias("e")))


def page_stem(page: Column) -> Column:
    return F.format_string("page_%03d", page.cast("int"))


def is_ornament_reading(text: Column, letters=ALPHABETS["letter"]) -> Column:
    """A border read as text: fewer than two letters, over 200 characters, or one token of two letters at most, three times or more."""
    tokens = F.regexp_extract_all(text, F.lit(f"{NOT_SPACE}+"), F.lit(0))
    same = (F.size(tokens) >= 3) & (F.size(F.array_distinct(tokens)) == 1) & (count_in(F.try_element_at(tokens, F.lit(1)), letters) <= 2)
    return (count_in(text, letters) < 2) | (F.length(text) > 200) | F.coalesce(same, F.lit(False))


def role_of(category: Column, verse: Column) -> Column:
    """title for headings, instruction for notes and captions, verse for numbered text, prayer for the rest."""
    return F.when(category.isin("Title", "Section-header"), "title").when(category.isin("Footnote", "Caption"), "instruction").when(F.coalesce(verse, F.lit("")) != "", "verse").otherwise("prayer")


def is_numeral(word: Column, numeral=ALPHABETS["numeral"]) -> Column:
    """A word of nothing but numerals opens a verse."""
    return F.coalesce(strip(word).rlike(rf"^{char_class(numeral)}+\z"), F.lit(False))


def is_draft(source: Column) -> Column:
    """A page that nobody checked yet says so in its source."""
    low = F.lower(F.coalesce(source, F.lit("")))
    return low.contains("draft") | low.contains("tesseract on cleaned layers")


def nonempty_lines(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]"), lambda x: strip(x) != ""))


def candidate_score(text: Column, confidence: Column, words: Column, script=ALPHABETS["v1"], latin=ALPHABETS["latin"], watermark: str = WATERMARK) -> Column:
    """What one recognition attempt is worth (archived; weights and caps are fixed values).

    Confidence (null: 0), plus up to 25 for script characters, 20 for their
    share, up to 10 for lines and 5 for words, less 18 for the Latin share, 4 for
    each watermark line and 10 for a page with hardly any script.
    """
    n, m = count_in(text, script), count_in(text, latin)
    letters = F.greatest(n + m, F.lit(1))
    marks = F.size(F.filter(F.split(text, r"\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]"), lambda x: x.rlike(watermark)))
    bonus = F.least(F.lit(25.0), n / F.lit(35.0)) + n / letters * 20.0 + F.least(F.lit(10.0), nonempty_lines(text) * 0.4) + F.least(F.lit(5.0), words / F.lit(60.0))
    return F.coalesce(confidence.cast("double"), F.lit(0.0)) + bonus - m / letters * 18.0 - marks * 4.0 - F.when(n < 20, 10.0).otherwise(0.0)
