"""Text: time formats, normal forms, tokenizers, numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that on-screen terms leave out.
STOP = (
    "the a an and or of to in on for with is are be by as at from this that these those "
    "it its we you they he she our your their i us them not no yes so then than but if when while "
    "what which who how why can could should would will shall may might must do does did done have "
    "has had been being was were am into over under about after before during between each all any "
    "some more most other another such only just also very too much many one two three new use used "
    "using make makes made get gets got go goes going see sees seen say says said like well now here "
    "there where because"
).split()
# Number words that count as the number.
NUMBER_WORDS = {
    "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10",
    "twenty": "20", "thirty": "30", "forty": "40", "fifty": "50", "sixty": "60", "ninety": "90",
    "hundred": "100", "thousand": "1000", "million": "1000000", "billion": "1000000000",
}


def two(n: Column) -> Column:
    return F.lpad(n.cast("long").cast("string"), 2, "0")


def ms(t: Column) -> Column:
    """MM:SS; minutes run past 59."""
    return F.when(t < 6000, F.concat(two(F.floor(t / 60)), F.lit(":"), two(t % 60))).otherwise(F.concat(F.floor(t / 60).cast("string"), F.lit(":"), two(t % 60)))


def hms(t: Column) -> Column:
    """HH:MM:SS."""
    return F.concat_ws(":", two(F.floor(t / 3600)), two(F.floor(t % 3600 / 60)), two(t % 60))


def human_bytes(n: Column) -> Column:
    """Bytes in steps of 1024, one decimal above bytes."""
    out = F.concat(F.format_number(n / F.lit(1024.0**4), 1), F.lit(" TB"))
    for k, unit in ((3, " GB"), (2, " MB"), (1, " KB")):
        out = F.when(n < 1024 ** (k + 1), F.concat(F.regexp_replace(F.format_number(n / F.lit(1024.0**k), 1), ",", ""), F.lit(unit))).otherwise(out)
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B"))).otherwise(out)


def slug(s: Column, n: int = 42) -> Column:
    flat = F.regexp_replace(F.regexp_replace(F.lower(s), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    cut = F.regexp_replace(F.substring(flat, 1, n), "-+$", "")
    return F.when(cut == "", "section").otherwise(cut)


def normal(s: Column) -> Column:
    """Trimmed, lower case, white space collapsed."""
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(s, r"^\s+|\s+$", ""))), r"\s+", " ")


def split_words(s: Column) -> Column:
    """White-space separated words, no empty ones."""
    return F.filter(F.split(s, r"\s+"), lambda w: w != "")


def plain_tokens(s: Column) -> Column:
    return F.regexp_extract_all(F.lower(s), F.lit(r"[a-z0-9$.]+"), F.lit(0))


def screen_terms(s: Column) -> Column:
    """Terms of three characters and more, without stop words, in order."""
    return F.filter(F.regexp_extract_all(F.lower(s), F.lit(r"[a-z0-9][a-z0-9+#.\-]{2,}"), F.lit(0)), lambda w: ~w.isin(STOP))


def numbers(s: Column) -> Column:
    """Numbers as text without commas and final full stops, and number words as numbers; distinct."""
    digits = F.transform(F.regexp_extract_all(s, F.lit(r"\d[\d,]*\.?\d*"), F.lit(0)), lambda x: F.rtrim(F.regexp_replace(x, ",", ""), F.lit(".")))
    # whole words: what stands between characters that no word has
    words = F.array_intersect(F.split(F.lower(s), r"[^a-z0-9_]+"), F.array(*[F.lit(w) for w in NUMBER_WORDS]))
    known = F.create_map(*[F.lit(x) for pair in NUMBER_WORDS.items() for x in pair])
    named = F.transform(words, lambda w: F.element_at(known, w))
    return F.array_distinct(F.concat(digits, named))


def flat(s: Column) -> Column:
    """Lower case, one blank for white space, only a-z, 0-9 and blanks."""
    return F.regexp_replace(F.regexp_replace(F.lower(s), r"\s+", " "), "[^a-z0-9 ]", "")


# Timestamps, file names, URLs, section signs and inline code, in which no number counts.
SCRUBBED = (r"\d\d:\d\d(:\d\d)?", r"[\w./-]*\.(png|jpg|md|json|mp4|txt|py|pdf)", r"https?://\S+", r"§\s*[\d.]+", r"`[^`]*`")


def scrub(s: Column) -> Column:
    """Without timestamps, file names, URLs, section signs and inline code."""
    for pattern in SCRUBBED:
        s = F.regexp_replace(s, pattern, " ")
    return s


def any_of(patterns: list[str]) -> str:
    return "(?i)" + "|".join(f"(?:{p})" for p in patterns)


def bits_apart(a: list[Column], b: list[Column]) -> Column:
    """Hamming distance of hashes given as longs; stays in generated code."""
    return reduce(lambda x, y: x + y, [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b)])
