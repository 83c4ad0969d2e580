"""Text folding as Column expressions. Positions, lengths and classes count code points.

Only Unicode normal forms need Python; `nfkc` and `nfkd` are Arrow UDFs, to be run once at ingest.
Everything else stays in generated code.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Classes and tables that the results depend on.
TATWEEL = "ـ"
WORD = r"[\u0621-\u065F\u0670-\u06D3]+"
ARABIC_BLOCK = r"[\u0600-\u06FF]"
ARABIC_ANY = r"[\u0600-\u06FF\u0750-\u077F\u08A0-\u08FF\uFB50-\uFDFF\uFE70-\uFEFF]"
ARABIC_TYPED = r"[\u0600-\u06FF\u0750-\u077F]"
ARABIC_LETTER = r"[\u0621-\u064A\u0671-\u06D3]"
LATIN_OR_DIGIT = r"[A-Za-z0-9]"
DIGRAPHS = {"ḫ": "kh", "ḵ": "kh", "ḡ": "gh", "ġ": "gh", "ṯ": "th", "ḏ": "dh", "š": "sh", "ǧ": "j", "ž": "zh", "č": "ch"}
LETTERS_AR = "ابتثجحخدذرزسشصضطظعغفقكلمنهويءؤئ"
LETTERS_LATIN = "abtṯǧḥḫdḏrzsšṣḍṭẓʿġfqklmnhwyʾʾʾ"
SYNONYMS = {"الكيلاني": "الجيلاني", "الجيلي": "الجيلاني", "الكيلي": "الجيلاني", "الجيلانى": "الجيلاني"}
STOP_LATIN = ("al", "b", "bn", "ibn", "abu", "abi", "abd", "umm", "bint", "ben", "el", "ed", "of", "the", "and", "le", "la")
STOP_ARABIC = ("بن", "ابن", "ابو", "ابي", "ام", "بنت", "عبد", "ال")
GENERIC = ("ابن", "ابو", "ام", "ابي", "بن", "بنت", "ال", "الله", "عبد", "الدين", "محمد", "احمد", "علي", "الحسن", "الحسين", "القاسم", "الرحمن", "الكريم", "القادر", "العزيز", "الكبير", "الواحد", "الصمد", "الغفار")
SHORTHAND = (("a:", "ā"), ("i:", "ī"), ("u:", "ū"), ("h.", "ḥ"), ("s.", "ṣ"), ("d.", "ḍ"), ("t.", "ṭ"), ("z.", "ẓ"), ("d_", "ḏ"), ("t_", "ṯ"), ("g_", "ġ"), ("h_", "ḫ"), ("s_", "š"), ("j_", "ǧ"), ("'", "ʾ"), ("`", "ʿ"))


def _normal_form(form: str):
    @F.pandas_udf("string")
    def normal(s: pd.Series) -> pd.Series:
        return s.map(lambda x: unicodedata.normalize(form, x), na_action="ignore")

    return normal


def nfkc(c: Column) -> Column:
    return _normal_form("NFKC")(c)


def nfkd(c: Column) -> Column:
    return _normal_form("NFKD")(c)


def squeeze(c: Column) -> Column:
    """White space of any kind as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def alike(c: Column) -> Column:
    """Carriers of alif, ya and ta marbuta as their plain letters, one for one; without tatweel."""
    return F.translate(c, "آأإٱىة" + TATWEEL, "ااااي" + "ه")


def fold(c: Column) -> Column:
    """The comparison key of a name or word in NFKC: no marks, no tatweel, carriers of alif, ya and ta
    marbuta as their plain letters."""
    return squeeze(alike(F.regexp_replace(c, r"\p{M}", "")))


def normalize_ar(c: Column) -> Column:
    return fold(nfkc(c))


def bare(c: Column) -> Column:
    """Without marks and tatweel; the weaker key of worklists."""
    return F.regexp_replace(c, rf"[\p{{M}}{TATWEEL}]", "")


def app_key(c: Column) -> Column:
    """A word's Arabic letters without marks and tatweel, no letter folded; empty for a word of another script."""
    return F.regexp_replace(bare(c), r"[^\u0621-\u065F\u0670-\u06D3]", "")


def words(c: Column) -> Column:
    """Arabic word tokens, marks and tatweel inside."""
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def word_keys(c: Column) -> Column:
    return F.transform(words(c), fold)


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def mapped(c: Column, table: dict[str, str]) -> Column:
    """table[c], or c where it has none."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c) if pairs else c


def fold_orthography(c: Column, synonyms: dict[str, str] = SYNONYMS) -> Column:
    return F.array_join(F.transform(tokens(c), lambda t: mapped(t, synonyms)), " ")


def strip_article(t: Column) -> Column:
    return F.when(t.startswith("ال") & (F.length(t) > 3), F.substr(t, F.lit(3))).otherwise(t)


def strip_diacritics(c: Column) -> Column:
    """Lower-cased romanization in plain letters; consonants of two letters are spelled out first."""
    c = F.lower(F.coalesce(c, F.lit("")))
    for letter, pair in DIGRAPHS.items():
        c = F.replace(c, F.lit(letter), F.lit(pair))
    return F.regexp_replace(nfkd(c), r"\p{M}", "")


def translit_tokens(c: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(strip_diacritics(c), "[ʾʿ'’]", ""), r"(?U)[^a-z0-9\s-]", " ")
    parts = F.filter(F.split(plain, r"(?U)[\s-]+"), lambda t: t != "")
    return F.transform(parts, lambda t: F.when(t.startswith("al") & (F.length(t) > 3) & ~t.isin(*STOP_LATIN), F.substr(t, F.lit(3))).otherwise(t))


def content_tokens(c: Column) -> Column:
    return F.filter(translit_tokens(c), lambda t: ~t.isin(*STOP_LATIN) & (F.length(t) > 1))


def ar_tokens(c: Column) -> Column:
    parts = F.transform(tokens(fold_orthography(normalize_ar(F.coalesce(c, F.lit(""))))), strip_article)
    return F.filter(parts, lambda t: (t != "") & ~t.isin(*STOP_ARABIC))


def distinctive(c: Column, generic: tuple[str, ...] = GENERIC) -> Column:
    return F.array_distinct(F.filter(tokens(c), lambda t: ~t.isin(*generic) & (F.length(t) > 2)))


def kunya(c: Column, particles: str = "ابو|ام") -> Column:
    """The token after the first kunya particle that has one, else null."""
    return F.nullif(F.regexp_extract(c, rf"(?:^| )(?:{particles}) (\S+)", 1), F.lit(""))


def has_arabic(c: Column) -> Column:
    return c.rlike(ARABIC_BLOCK)


def is_arabic(c: Column) -> Column:
    return c.rlike(ARABIC_ANY)


def typed_arabic(c: Column) -> Column:
    """What a field for a transliteration must not hold."""
    return c.rlike(ARABIC_TYPED)


def has_letter(c: Column) -> Column:
    """A letter, and not only marks, digits or punctuation of the script."""
    return c.rlike(ARABIC_LETTER)


def latin_in_arabic(c: Column) -> Column:
    return c.rlike(LATIN_OR_DIGIT)


def strip_orphan_marks(c: Column) -> Column:
    """Keeps a mark only right after a letter."""
    return squeeze(F.regexp_replace(c, rf"(?<!{ARABIC_LETTER})\p{{M}}+", ""))


def space_letters_digits(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, rf"({ARABIC_LETTER})([0-9])", "$1 $2"), rf"([0-9])({ARABIC_LETTER})", "$1 $2")


def capitalize(w: Column) -> Column:
    """The first letter in upper case, the rest as it is."""
    at = F.regexp_instr(w, F.lit(r"\p{L}"))
    return F.when(at > 0, F.concat(F.substr(w, F.lit(1), at - 1), F.upper(F.substr(w, at, F.lit(1))), F.substr(w, at + 1))).otherwise(w)


def latin_author(c: Column) -> Column:
    s = squeeze(c)
    parts = F.split(s, ",", 2)
    turned = F.when(F.instr(s, ",") > 0, F.trim(F.concat_ws(" ", F.trim(F.get(parts, F.lit(1))), F.trim(F.get(parts, F.lit(0)))))).otherwise(s)
    return F.array_join(F.transform(tokens(turned), capitalize), " ")


def blank_placeholder(c: Column) -> Column:
    c = F.coalesce(c, F.lit(""))
    return F.when(F.lower(F.trim(c)).isin("na", "n/a", "n.a.", "n.a", "n a"), "").otherwise(c)


def clean(c: Column) -> Column:
    return F.trim(F.replace(c, F.lit("\u00a0"), F.lit(" ")))


def cluster_reverse(c: Column) -> Column:
    """Reversed, each mark staying behind its base."""
    return F.array_join(F.reverse(F.regexp_extract_all(c, F.lit(r"(?s).\p{M}*"), F.lit(0))), "")


def visual_to_logical(c: Column) -> Column:
    """Painted order to reading order: each right-to-left run, with the space behind it, is reversed.
    White space that opens a text belongs to no such run."""
    run = rf"{ARABIC_ANY}(?:{ARABIC_ANY}|\p{{M}}|(?U:\s))*"
    gaps, hits = F.split(c, run, -1), F.regexp_extract_all(c, F.lit(run), F.lit(0))
    joined = F.array_join(F.transform(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda x: F.concat(F.coalesce(x["gap"], F.lit("")), F.coalesce(cluster_reverse(x["hit"]), F.lit("")))), "")
    return nfkc(joined)


def mechanical(c: Column) -> Column:
    """Letter by letter; what has no letter is dropped, a detached article is joined."""
    known = F.regexp_replace(c, rf"(?U)[^{LETTERS_AR}\s-]", "")
    return squeeze(F.regexp_replace(F.translate(F.regexp_replace(known, r"(?U)\s", " "), LETTERS_AR, LETTERS_LATIN), r"(?U)\bal ", "al-"))


def expand_shorthand(c: Column, table: tuple[tuple[str, str], ...] = SHORTHAND) -> Column:
    for short, full in table:
        c = F.replace(c, F.lit(short), F.lit(full))
    return c


def state_free(c: Column) -> Column:
    return F.when(c.endswith("at"), F.concat(F.substr(c, F.lit(1), F.length(c) - 2), F.lit("ah"))).otherwise(c)


def death_year(c: Column) -> Column:
    found = F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"/\D*(\d{3,4})", 1), F.lit(""))
    return F.coalesce(found.cast("int"), F.lit(99999))


def escape_html(c: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c
