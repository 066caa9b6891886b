"""Text rules as Column functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letters a word may hold, and the characters that stay in a normalised token.
LETTERS = "A-Za-zÀ-ÿ"
TOKEN = r"[A-Za-zÀ-ÿ]+(?:'[A-Za-zÀ-ÿ]+)?"
TOKEN_LOOSE = r"[A-Za-zÀ-ÿ']+"
# Words that are English only; the second list serves deletion.
FOREIGN = "all believe can decide don't down eyes feel find got heart heavens know make need see take guy crashing that's you've your just then whenever truth world light true when you're open lies way let through too turn what where look far the of".split()
FOREIGN_DROP = [*FOREIGN, "it", "is"]
# Fixed value: credits and closing lines that speech models invent.
BOILERPLATE = r"sous-titrage|subtitle|amara|merci d'avoir regardé|thanks for watching|abonnez-vous"
# Fixed value: characters after which a lone I at the end of a line was an exclamation mark.
BEFORE_MARK = "[a-zàâäéèêëîïôöùûüçA-Z0-9.?]"
# Language codes (2-letter, 3-letter, dictionary).
LANGUAGES = {"en": ("eng", "en_US"), "fr": ("fra", "fr_FR"), "de": ("deu", "de_DE"), "es": ("spa", "es_ES"), "it": ("ita", "it_IT"), "pt": ("por", "pt_PT")}
#: White space as Python's \s has it: French texts use several no-break and thin spaces.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def normal(word: Column) -> Column:
    """Lower-case; only a-z, à-ÿ, digits and apostrophes stay."""
    return F.regexp_replace(F.lower(word), "[^a-zà-ÿ0-9']", "")


def tokens(text: Column, loose: bool = False) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN_LOOSE if loose else TOKEN), F.lit(0))


def spacing(text: Column, lang: str) -> Column:
    """No space before , and .; before ! ? ; : one space in French, none elsewhere; runs of spaces collapse."""
    out = F.regexp_replace(text, SPACE + r"+([,.])", "$1")
    out = F.regexp_replace(out, SPACE + r"*([!?;:])", " $1") if lang == "fr" else F.regexp_replace(out, SPACE + r"+([!?;:])", "$1")
    return F.regexp_replace(F.regexp_replace(out, SPACE + "{2,}", " "), f"^{SPACE}+|{SPACE}+$", "")


def ocr_line(line: Column, lang: str, guard_capitals: bool = False) -> Column:
    """Repair of what optical reading makes of marks: I for !, braces and bars, accents, curly quotes, spacing.

    guard_capitals: keep an I that ends a word in capitals (`OUI!`).
    """
    out = F.regexp_replace(line, "(?<![A-ZÀ-Ý])I!" if guard_capitals else "I!", "!")
    out = F.regexp_replace(out, "!I(?![A-Za-zÀ-ÿ])", "!")
    out = F.regexp_replace(out, f"(?<={BEFORE_MARK}){SPACE}+I\\z", " !")
    out = F.regexp_replace(out, r"(?U)\{u\b", "tu")
    out = F.replace(F.replace(out, F.lit("{"), F.lit("")), F.lit("|"), F.lit("l"))
    out = F.regexp_replace(out, "ï[ií]", "î")
    return spacing(F.translate(out, "’‘“”", "''\"\""), lang)


def is_sign(text: Column) -> Column:
    """Over 85 of 100 letters are capitals, and there is a letter."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    capitals = F.length(F.regexp_replace(text, r"[^\p{Lu}]", ""))
    return (letters > 0) & (capitals * 100 > letters * 85)


def foreign_share(text: Column, lexicon: list[str] = FOREIGN) -> Column:
    """Share of tokens in the lexicon; 0 without tokens."""
    words = tokens(F.lower(text), loose=True)
    hits = F.size(F.filter(words, lambda w: w.isin(lexicon)))
    return F.when(F.size(words) > 0, hits / F.size(words)).otherwise(F.lit(0.0))


def is_boilerplate(text: Column) -> Column:
    return text.rlike(f"(?iu){BOILERPLATE}")


def naive_boundary(text: Column) -> Column:
    """A lower-case letter, a space and a capitalised word: fires on every name, so it only serves to compare detectors."""
    return text.rlike("[a-zà-ÿ] [A-ZÀ-Ý][a-zà-ÿ]")


def language_codes(code: Column) -> Column:
    """(three letters, dictionary) of a two-letter language code; null for an unknown one."""
    known = F.create_map(*[x for k, (three, words) in LANGUAGES.items() for x in (F.lit(k), F.struct(F.lit(three).alias("three"), F.lit(words).alias("dictionary")))])
    return known[code]


def any_word(text: Column, terms: list[str]) -> Column:
    """Whole-word, case-insensitive search for any of the terms."""
    return text.rlike("(?iuU)\\b(" + "|".join("\\Q" + t.replace("\\E", "\\E\\\\E\\Q") + "\\E" for t in terms) + ")\\b")


def duration_cap(word: Column) -> Column:
    """Longest credible duration of a word in ms: 120 a character, at least 1200, at most 4500."""
    return F.least(F.lit(4500), F.greatest(F.lit(1200), F.lit(120) * F.length(F.trim(word)))).cast("long")


def pattern_spaces(pattern: str) -> str:
    """Literal spaces of a rule match any run of white space."""
    return re.sub(r"(?<!\\) ", r"\\s+", pattern)


def starts_sentence(before: Column, word: Column) -> Column:
    """A capitalised word after one that ends in lower case without a closing mark."""
    return word.rlike("^[A-ZÀ-Ý][a-zà-ÿ]") & before.rlike("[a-zà-ÿ]$") & ~before.rlike("[.!?:…]$")


def repeats_itself(text: Column, share: float = 0.5) -> Column:
    """A window whose distinct tokens are fewer than `share` of its tokens (our own threshold): no evidence."""
    words = tokens(F.lower(text))
    return (F.size(words) > 3) & (F.size(F.array_distinct(words)) < F.size(words) * share)
