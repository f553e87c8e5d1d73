"""Patterns of translated text, and what they find: scripts, markup, tokens to keep, names of species.

Fixed values: the patterns, word lists and tables here must be what validated
texts were written against.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CYRILLIC = r"[\x{0400}-\x{04ff}]"
LATIN_CLASS = r"A-Za-z\x{00c0}-\x{024f}\x{1e00}-\x{1eff}"
MIXED_ALPHABET = rf"[{LATIN_CLASS}][\x{{0400}}-\x{{04ff}}]|[\x{{0400}}-\x{{04ff}}][{LATIN_CLASS}]"
MARKUP = r"</?[A-Za-z][^>]*>|```|\[[^\]]+\]\([^)]+\)"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
KEY_CHORD = r"\b[A-Za-z][A-Za-z0-9]*(?:\+[A-Za-z][A-Za-z0-9]*)+\b"
ACRONYM = r"\b[A-Z][A-Z0-9.+/-]{1,11}\b"
ACRONYM_ONLY = r"^[A-Z][A-Z0-9.+/-]{1,11}$"
LANGUAGE_ORIGIN = r'^[A-Za-z]+:\s*"([^"]+)"$'
GRAMMAR_WORD = r"(?i)\b(?:this|that|these|those|which|who|whom|whose)\b"
BINOMIAL = r"(^|[;(,]\s*)(([A-Z][a-z]{2,})\s+([a-z][a-z-]{2,}))\b"
TAXON = r"[A-Z][a-z]+(?:\s+[a-z][a-z-]+){1,2}(?:\s+(?:subsp|ssp|var|f)\.\s+[a-z][a-z-]+|\s+(?:x|×)\s+[A-Z]\.\s+[a-z][a-z-]+)?"
NO_EPITHET = ("a", "an", "and", "code", "coordinates", "dynasty", "heaven", "law", "paper", "people", "period", "pilgrim", "pilgrimage", "school", "sea", "style", "treat", "wheel")
NO_GENUS = ("akihabara", "cartesian", "chinese", "dalmatian", "dutch", "english", "german", "islamic", "japanese", "kamakura", "korin", "morse", "muromachi", "qin", "scythian", "shikoku", "tusita")
TOOLTIP_ABBREVIATION = r"(?<![А-Яа-яЁё])(?:гл|сущ|прил|нар|межд|телеком|машиностр)\."
FULL_POS_LABEL = r"(?iu)(?<![\p{L}\p{N}_])(?:глагол|существительное|прилагательное|наречие|междометие)(?![\p{L}\p{N}_])"
ENDING_KANA = {"bu": "ぶ", "gu": "ぐ", "hu/fu": "ふ", "ku": "く", "mu": "む", "nu": "ぬ", "ru": "る", "su": "す", "tsu": "つ", "u": "う", "dzu": "づ", "yu": "ゆ", "zu": "ず"}
SOURCE_FORM_KANA = {"kureru": "くれる", "Kuru": "くる", "suru": "する", "zuru": "ずる", "jiru": "じる", "-aru": "ある", "Iku/Yuku": "行く／ゆく"}

#: A boundary of words of any script, as the built-in one knows ASCII letters only.
EDGE_BEFORE, EDGE_BEHIND = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
ASCII_WORD = rf"{EDGE_BEFORE}[A-Za-z]{{3,}}{EDGE_BEHIND}"
TAXON_IN_BRACKETS = rf"(?<=\(){TAXON}(?=\s*[;,)])"


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches of a pattern, or of a group of it; none in a null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.array().cast("array<string>"))


def binomials(text: Column, no_genus: tuple[str, ...] = NO_GENUS, no_epithet: tuple[str, ...] = NO_EPITHET) -> Column:
    """Latin names of species that a cross-reference must keep, each once and in order.

    Of pairs of a capitalised and a small word, at the start or behind a bracket,
    semicolon or comma, those behind a bracket or a comma count, and those whose
    genus comes more than once; not those with a listed word.
    """
    pattern = rf"(?U){BINOMIAL}"
    pairs = F.arrays_zip(*(found(text, pattern, k).alias(name) for k, name in ((1, "before"), (2, "name"), (3, "genus"), (4, "epithet"))))
    genera = found(text, pattern, 3)
    kept = F.filter(
        pairs,
        lambda x: ~F.lower(x["genus"]).isin(*no_genus) & ~F.lower(x["epithet"]).isin(*no_epithet)
        & (F.substring(x["before"], 1, 1).isin("(", ",") | (F.size(F.filter(genera, lambda g: g == x["genus"])) > 1)),
    )
    return F.array_distinct(F.transform(kept, lambda x: x["name"]))


def without_words(text: Column, words: Column) -> Column:
    """Without the given words, whatever their case."""
    quoted = lambda w: F.concat(F.lit(rf"(?iu){EDGE_BEFORE}\Q"), w, F.lit(rf"\E{EDGE_BEHIND}"))
    return F.aggregate(words, text, lambda acc, w: F.regexp_replace(acc, quoted(w), F.lit("")))
