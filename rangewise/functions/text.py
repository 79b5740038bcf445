"""Text cleaning as built-in column expressions (JVM-side, codegen'd).

* ``needs_cleaning``: the value holds a character outside ``\\x1F-\\x7F`` -
  any non-ASCII character, and also tab, newline, carriage return and the
  other control characters below 0x1F.
* ``transliterate``: letters to an ASCII spelling. Latin letters with marks
  come from Unicode's own decomposition (a rule, not a list); letters that do
  not decompose, Greek, Cyrillic and common punctuation from the short tables
  below; syllabaries from the spelling in Unicode's character names, and
  Korean syllables from the parts they are numbered by. A character without an
  entry **stays as it is**: nothing vanishes, and ``unmapped`` counts what
  stayed (signs of whole words, and alphabets whose letters are named rather than spelled).
* ``strip_line_breaks``: remove CR LF pairs, then lone LF. A lone CR stays.

NULL stays NULL throughout.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Pattern that marks a value for cleaning (characters outside 0x1F..0x7F).
NEEDS_CLEANING_PATTERN = r"[^\x1F-\x7F]"
NON_ASCII_PATTERN = r"[^\x00-\x7F]"
# Latin letters that Unicode does not decompose, and punctuation.
LATIN = {
    "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o", "ß": "ss", "ẞ": "SS",
    "Þ": "Th", "þ": "th", "Ð": "D", "ð": "d", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h",
    "Ł": "L", "ł": "l", "Ŧ": "T", "ŧ": "t", "ı": "i", "ĸ": "k", "Ŋ": "NG", "ŋ": "ng",
    "Ə": "E", "ə": "e", "Ɓ": "B", "ɓ": "b", "Ɗ": "D", "ɗ": "d", "Ƙ": "K", "ƙ": "k",
    "Ɛ": "E", "ɛ": "e", "Ɔ": "O", "ɔ": "o", "Ƴ": "Y", "ƴ": "y", "Ɖ": "D", "ɖ": "d",
    "Ɩ": "I", "ɩ": "i", "Ʋ": "V", "ʋ": "v", "ʼ": "'", "ʻ": "'", "ʹ": "'", "ʺ": '"',
}
PUNCTUATION = {
    "‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "‹": "<", "›": ">",
    "«": "<<", "»": ">>", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-",
    "×": "x", "÷": "/", "¡": "!", "¿": "?", "·": ".", "•": "*", "€": "EUR", "£": "PS",
    "ー": "-", "。": ".", "、": ",", "・": ".", "「": '"', "」": '"', "　": " ",
    "©": "(c)", "®": "(r)", "°": "deg", "−": "-", "⁄": "/", "†": "+", "§": "SS",
}
# Greek after ISO 843 (transcription), Cyrillic after the BGN/PCGN romanisations.
GREEK = {
    "α": "a", "β": "v", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "i", "θ": "th", "ι": "i",
    "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s",
    "ς": "s", "τ": "t", "υ": "y", "φ": "f", "χ": "ch", "ψ": "ps", "ω": "o",
}
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i",
    "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t",
    "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "'",
    "ы": "y", "ь": "'", "э": "e", "ю": "yu", "я": "ya", "і": "i", "є": "ye", "ґ": "g",
    "й": "y", "ё": "yo", "ї": "yi", "ў": "w",
    "ђ": "dj", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "c", "џ": "dz", "ѕ": "dz",
}
# Blocks whose letters are decomposed: Latin-1 to Extended-B with the marks,
# Greek and Cyrillic (their accented letters), the additional and extended
# Latin and Greek blocks, general punctuation, letter-like signs, ligatures
# and full-width forms.
BLOCKS = [(0x00A0, 0x0530), (0x1E00, 0x2070), (0x2100, 0x2150), (0xFB00, 0xFB07), (0xFF01, 0xFFA0)]
# Blocks whose characters are named after their sound, as the last word of
# "... LETTER KA" or "... SYLLABLE KA": Ethiopic, Cherokee, Canadian, kana with
# Bopomofo, phonetic kana, Yi, small Cherokee.
NAMED_BLOCKS = [(0x1200, 0x1380), (0x13A0, 0x13FE), (0x1400, 0x1680), (0x3000, 0x3130), (0x31F0, 0x3200),
                (0xA000, 0xA490), (0xAB70, 0xABC0)]
NAMED_KINDS = ("LETTER", "SYLLABLE", "SYLLABICS")
# Korean syllables are numbered by first consonant, vowel and last consonant,
# spelled after the parts' short names in Unicode.
HANGUL_START = 0xAC00
HANGUL_FIRST = "g gg n d dd r m b bb s ss - j jj c k t p h".replace("-", "").split(" ")
HANGUL_VOWEL = "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i".split(" ")
HANGUL_LAST = "- g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h".replace("-", "").split(" ")


def _with_capitals(table: dict[str, str]) -> dict[str, str]:
    upper = {k.upper(): v.capitalize() for k, v in table.items() if len(k.upper()) == 1}
    return upper | table


def _sound(c: str) -> str | None:
    """The spelling in a character's name, if it is named after its sound."""
    words = unicodedata.name(c, "").split()
    if any(k in words[:-1] for k in NAMED_KINDS) and words[-1].isalpha():
        return words[-1].lower()
    return None


@lru_cache(maxsize=1)
def spellings() -> dict[str, str]:
    """Every mapped character (but Korean syllables) and its ASCII spelling;
    marks on their own map to nothing, as they belong to the letter before them."""
    base = LATIN | PUNCTUATION | _with_capitals(GREEK) | _with_capitals(CYRILLIC)
    for start, end in NAMED_BLOCKS:
        for c in map(chr, range(start, end)):
            if c not in base and (sound := _sound(c)):
                base[c] = sound
    out = dict(base)
    for start, end in BLOCKS:
        for code in range(start, end):
            c = chr(code)
            if c in out:
                continue
            if unicodedata.combining(c):
                out[c] = ""
                continue
            parts = unicodedata.normalize("NFKD", c)
            if parts == c:
                continue
            spelled = "".join("" if unicodedata.combining(p) else base.get(p, p) for p in parts)
            if spelled.isascii():
                out[c] = spelled
    return out


def _array(values: list, kind: str = "array<string>") -> Column:
    """A literal array: read once, indexed in constant time."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _pages() -> Column:
    """The spellings by page (a character's number / 256), then by place there."""
    table = {ord(k): v for k, v in spellings().items()}
    used = {k >> 8 for k in table}
    return _array([[table.get(page << 8 | k) for k in range(256)] if page in used else None
                   for page in range(max(used) + 1)], "array<array<string>>")


def needs_cleaning(c: Column) -> Column:
    return c.rlike(NEEDS_CLEANING_PATTERN)


def _hangul(at: int) -> str:
    vowels, lasts = len(HANGUL_VOWEL), len(HANGUL_LAST)
    return (HANGUL_FIRST[at // (vowels * lasts)] + HANGUL_VOWEL[at % (vowels * lasts) // lasts]
            + HANGUL_LAST[at % lasts])


@lru_cache(maxsize=1)
def _short() -> tuple[str, str]:
    """Characters spelled by one letter and these letters, then those spelled by none."""
    syllables = len(HANGUL_FIRST) * len(HANGUL_VOWEL) * len(HANGUL_LAST)
    table = spellings() | {chr(HANGUL_START + k): _hangul(k) for k in range(syllables)}
    one = [k for k, v in table.items() if len(v) == 1]
    return "".join(one) + "".join(k for k, v in table.items() if not v), "".join(table[k] for k in one)


def transliterate(c: Column) -> Column:
    """Characters spelled by one letter (or none) are replaced in one pass. In values that
    hold others, each character is then looked up, by its number in its page's table."""
    return F.transform(F.array(F.translate(c, *_short())), lambda v: F.when(
        v.rlike(NON_ASCII_PATTERN), _looked_up(v)).otherwise(v))[0]


def _looked_up(c: Column) -> Column:
    pages = _pages()

    def spelled(ch: Column, code: Column) -> Column:
        at = code - HANGUL_START
        vowels, lasts = len(HANGUL_VOWEL), len(HANGUL_LAST)
        syllable = F.concat(
            F.element_at(_array(HANGUL_FIRST), F.floor(at / (vowels * lasts)).cast("int") + 1),
            F.element_at(_array(HANGUL_VOWEL), F.floor(at % (vowels * lasts) / lasts).cast("int") + 1),
            F.element_at(_array(HANGUL_LAST), at % lasts + 1))
        found = F.get(F.get(pages, F.shiftright(code, 8)), code.bitwiseAND(255))
        return (F.when(code < 128, ch)
                .when(at.between(0, len(HANGUL_FIRST) * vowels * lasts - 1), syllable)
                .otherwise(F.coalesce(found, ch)))

    def bound(ch: Column) -> Column:
        """The character's number, also beyond ASCII, is taken once."""
        return F.transform(F.array(F.ascii(ch)), lambda code: spelled(ch, code))[0]

    return F.array_join(F.transform(F.split(c, ""), bound), "")


def unmapped(c: Column) -> Column:
    """Characters outside ASCII that a transliterated value still holds."""
    return F.char_length(F.regexp_replace(transliterate(c), r"[\x00-\x7F]", ""))


def strip_line_breaks(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("")), F.lit("\n"), F.lit(""))


def clean_text(c: Column) -> Column:
    """Transliterate, then remove line breaks (the column-cleaning step)."""
    return strip_line_breaks(transliterate(c))


def cleaned(c: Column) -> Column:
    """``clean_text`` of the values that need it. A value of printable ASCII
    alone is its own clean form, so testing first only saves the work."""
    return F.when(needs_cleaning(c), clean_text(c)).otherwise(c)
