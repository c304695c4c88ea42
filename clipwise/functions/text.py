"""Text functions as column expressions."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import written

#: Diacritics of transliterated Sanskrit and typographic marks, with the ASCII they become.
ASCII_OF = {
    "ā": "a", "Ā": "A", "ī": "i", "Ī": "I", "ū": "u", "Ū": "U", "ē": "e", "Ē": "E", "ō": "o", "Ō": "O",
    "ṛ": "ri", "Ṛ": "Ri", "ṝ": "ri", "Ṝ": "Ri", "ḷ": "li", "Ḷ": "Li", "ḹ": "li", "Ḹ": "Li",
    "ṅ": "n", "Ṅ": "N", "ñ": "n", "Ñ": "N", "ṇ": "n", "Ṇ": "N", "ṁ": "m", "Ṁ": "M", "ṃ": "m", "Ṃ": "M",
    "ś": "sh", "Ś": "Sh", "ṣ": "sh", "Ṣ": "Sh", "ṭ": "t", "Ṭ": "T", "ḍ": "d", "Ḍ": "D", "ḥ": "h", "Ḥ": "H",
    "ṟ": "r", "ḻ": "l", "ṉ": "n", "’": "", "‘": "", "ʼ": "",
    "–": "-", "—": "-", "“": '"', "”": '"', "…": "...",
}

#: White space of Unicode, spelled out so that every regex engine agrees.
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


#: The same characters, for functions that take a list of them.
BLANKS = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    """Without white space at both ends; linear, whatever runs of blanks there are inside."""
    return F.btrim(c, F.lit(BLANKS))


def transliterate(c: Column) -> Column:
    """Drops bracketed notes, maps diacritics to ASCII and collapses runs of white space.

    Letters that become one character, or none, go through one ``translate``; the others are replaced one by one.
    """
    single = {k: v for k, v in ASCII_OF.items() if len(v) == 1}
    gone = [k for k, v in ASCII_OF.items() if not v]
    c = F.regexp_replace(c, r"\[[^\]]*\]", "")
    c = F.translate(c, "".join([*single, *gone]), "".join(single.values()))
    for k, v in ASCII_OF.items():
        if len(v) > 1:
            c = F.replace(c, F.lit(k), F.lit(v))
    return strip(F.regexp_replace(c, SPACE + "{2,}", " "))


def clean_text(c: Column) -> Column:
    """``transliterate``, no space before punctuation, and single spaces."""
    c = F.regexp_replace(transliterate(c), SPACE + r"+([,.?!;:])", "$1")
    return strip(F.regexp_replace(c, SPACE + "+", " "))


def word_count(c: Column) -> Column:
    """Number of words between white space; 0 for null or empty."""
    s = strip(F.coalesce(c, F.lit("")))
    return F.when(s == "", 0).otherwise(F.size(F.split(s, SPACE + "+")))


def tokens(c: Column) -> Column:
    """Runs of a-z and apostrophes of the lower-cased text."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z']+"), F.lit(0))


def share_of(tokens_: Column, lexicon: list[str]) -> Column:
    """Share of tokens in a small lexicon, 0 without tokens. A large one belongs in a semi join."""
    known = F.size(F.filter(tokens_, lambda t: t.isin(lexicon)))
    return F.coalesce(F.try_divide(known, F.size(tokens_)), F.lit(0.0))


def pattern_ratio(c: Column, token: str, marked: str) -> Column:
    """Matches of ``marked`` for each match of ``token``."""
    n = F.size(F.regexp_extract_all(c, F.lit(token), F.lit(0)))
    return F.coalesce(F.try_divide(F.size(F.regexp_extract_all(c, F.lit(marked), F.lit(0))), n), F.lit(0.0))


def diacritic_ratio(c: Column) -> Column:
    """Words with a transliteration's diacritics or an apostrophe inside, for each word, whatever the case."""
    letters = "".join(k for k, v in ASCII_OF.items() if v and k.isalpha()).lower()
    found = F.regexp_extract_all(F.lower(c), F.lit(f"[a-z{letters}'’]+"), F.lit(0))
    marked = F.filter(found, lambda w: w.rlike(f"[{letters}]|[a-z]['’][a-z]"))
    return F.coalesce(F.try_divide(F.size(marked), F.size(found)), F.lit(0.0))


def is_ascii(c: Column) -> Column:
    return c.rlike(r"^[\x00-\x7F]*$")


def without_words(c: Column, words: list[str]) -> Column:
    """A text's words without the given ones, compared as whole words in lower case."""
    return F.array_join(F.filter(F.split(strip(c), SPACE + "+"), lambda w: ~F.lower(w).isin(words)), " ")


def ends_sentence(c: Column) -> Column:
    return c.rlike(r"[.?!]\s*$")


def non_ascii(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"[^\x00-\x7F]"), F.lit(0))


def basename(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def stem(c: Column) -> Column:
    return F.regexp_replace(basename(c), r"\.[^.]+$", "")


#: What HTML takes for a character reference, and the characters that end a name.
MARK = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: Names that count without a semicolon, and so also before other letters.
OPEN_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
_BETWEEN, _IS = "\x01", "\x02"


def character(code: Column) -> Column:
    """The character of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _numbered(code: Column) -> Column:
    """What a numeric reference stands for: bytes 128 to 159 are those of windows-1252, control characters and non-characters nothing."""
    bytes_ = {b: bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)}
    special = F.str_to_map(F.lit(_BETWEEN.join(f"{b}{_IS}{c}" for b, c in bytes_.items())), F.lit(_BETWEEN), F.lit(_IS))
    none = code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF) | (code % 0x10000 >= 0xFFFE)
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), "\ufffd")
        .when(code.between(0x80, 0x9F), F.try_element_at(special, code.cast("string")))
        .when(none, "")
        .otherwise(character(code.cast("bigint")))
    )


def _named(name: Column) -> Column:
    """The characters of a name; of one that isn't known, those of the longest known beginning and the rest; else the mark itself."""
    known = F.str_to_map(F.lit(_BETWEEN.join(f"{n}{_IS}{c}" for n, c in html5.items())), F.lit(_BETWEEN), F.lit(_IS))
    begin = F.regexp_extract(name, f"^(?:{'|'.join(OPEN_NAMES)})", 0)
    longest = F.concat(F.try_element_at(known, begin), F.substring(name, F.length(begin) + 1, F.length(name)))
    return F.coalesce(F.try_element_at(known, name), F.when(begin != "", longest), F.concat(F.lit("&"), name))


def unescape(c: Column) -> Column:
    """All character references of HTML, in one pass: what a reference gives isn't read again, so ``&amp;lt;`` becomes ``&lt;``.

    The text is cut at its marks, and each mark looked up in the table of names that the language's library has. Texts without an ampersand are left alone.
    """
    number = lambda m, pattern, base: F.conv(F.regexp_extract(m, pattern, 1), base, 10).cast("decimal(20,0)")
    resolved = F.transform(
        F.regexp_extract_all(c, F.lit(MARK), F.lit(0)),
        lambda m: F.when(m.rlike("^&#[xX]"), _numbered(number(m, "^&#[xX]0*([0-9a-fA-F]{1,16})", 16)))
        .when(m.startswith("&#"), _numbered(number(m, "^&#0*([0-9]{1,19})", 10)))
        .otherwise(_named(F.substring(m, 2, 40))),
    )
    joined = F.array_join(F.zip_with(F.split(c, MARK, -1), resolved, lambda text, m: F.concat(text, F.coalesce(m, F.lit("")))), "")
    return F.when(c.contains("&"), joined).otherwise(c)


def strip_tags(c: Column, label: str = "") -> Column:
    """Fixed patterns of the format. Line breaks for ``<br>``, no other tags, entities resolved, a speaker label dropped, single blanks."""
    c = F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>", "\n"), "<[^>]+>", "")
    c = unescape(c)
    c = F.replace(c, F.lit(label), F.lit("")) if label else c
    return strip(F.regexp_replace(c, r"[ \t]+", " "))


def paragraphs(html: Column, attributes: str = "", label: str = "") -> Column:
    """Texts of ``<p>`` elements whose tag matches ``attributes``, without empty ones."""
    found = F.regexp_extract_all(html, F.lit(rf"(?is)<p\b[^>]*{attributes}[^>]*>(.*?)</p>"), F.lit(1))
    return F.filter(F.transform(found, lambda p: strip_tags(p, label)), lambda p: p != "")


def media_url(html: Column, base: Column, extension: str = "mp3") -> Column:
    """First ``<source src>`` of the extension, made absolute; null without one."""
    src = unescape(F.regexp_extract(html, rf'(?i)<source[^>]+src="([^"]+\.{extension})"', 1))
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^?#]*/)[^/?#]*", 1)
    absolute = (
        F.when(src.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), src)
        .when(src.startswith("//"), F.concat(F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1), src))
        .when(src.startswith("/"), F.concat(origin, src))
        .otherwise(F.concat(F.when(folder == "", F.concat(origin, F.lit("/"))).otherwise(folder), src))
    )
    return F.when(src != "", absolute)


def slug(url: Column) -> Column:
    """A name from the query string: without leading number, other characters as dashes."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    raw = F.regexp_replace(F.substring_index(query, "&a_id", 1), r"\+", "%2B")
    raw = F.regexp_replace(F.coalesce(F.try_url_decode(raw), raw), r"^\d+-+", "")
    s = F.lower(F.regexp_replace(F.regexp_replace(raw, "[^A-Za-z0-9]+", "-"), "^-+|-+$", ""))
    return F.when(s == "", "lecture").otherwise(s)


def reasons(*rules: tuple[Column, Column]) -> Column:
    """Array of the texts whose conditions hold; a null condition doesn't."""
    return F.array_compact(F.array(*[F.when(cond, text) for cond, text in rules]))


def with_value(code: str, value: Column, places: int = 2) -> Column:
    """``code(value)``, as reports write it."""
    return written(f"{code}(%s)", value, places)


def status(reasons_: Column) -> Column:
    return F.when(F.size(reasons_) == 0, "PASS").otherwise("FAIL")


def cer(reference: Column, hypothesis: Column) -> Column:
    """Character error rate: 0 for an empty reference, 1 for a blank hypothesis; it may exceed 1."""
    norm = lambda c: strip(F.regexp_replace(F.regexp_replace(F.lower(c), r"[\p{P}]", ""), SPACE + "+", " "))
    ref, hyp = norm(reference), norm(hypothesis)
    return (
        F.when(strip(reference) == "", 0.0)
        .when(strip(hypothesis) == "", 1.0)
        .otherwise(F.coalesce(F.try_divide(F.levenshtein(ref, hyp), F.length(ref)), F.lit(0.0)))
    )


def backbone(c: Column, lexicon: list[str]) -> Column:
    """The tokens that are in the lexicon, joined by blanks."""
    return F.array_join(F.filter(tokens(c), lambda t: t.isin(lexicon)), " ")


def error_rates(reference: Column, hypothesis: Column, lexicon: list[str], strict: bool = True) -> Column:
    """Struct of cer_raw, cer_core (over the lexicon's words only) and load, their difference.

    Without any word of the lexicon in the reference cer_core is null; with ``strict`` off it is 0.
    """
    raw = cer(reference, hypothesis)
    ref = backbone(reference, lexicon)
    core = F.when((ref == "") & F.lit(strict), F.lit(None).cast("double")).otherwise(cer(ref, backbone(hypothesis, lexicon)))
    blank = strip(hypothesis) == ""
    return F.struct(
        F.when(blank, 1.0).otherwise(raw).alias("cer_raw"),
        F.when(blank, 1.0).otherwise(core).alias("cer_core"),
        F.when(blank, 0.0).otherwise(raw - core).alias("load"),
    )
