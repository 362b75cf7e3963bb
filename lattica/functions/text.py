"""Text clean-up and abstracts."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bare(letter: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", letter) if unicodedata.category(c) != "Mn")


@cache
def _decompositions() -> tuple[str, str, dict[str, str]]:
    """By the rule of canonical decomposition without non-spacing marks: letters that become one letter, followed by
    marks, which become nothing; what the letters become; and letters that become several. Hangul syllables have a rule of their own."""
    changed = {c: _bare(c) for c in map(chr, (i for i in range(0x80, 0x110000) if not 0xD800 <= i < 0xE000 and not 0xAC00 <= i < 0xD7A4)) if unicodedata.decomposition(c) or unicodedata.category(c) == "Mn"}
    one = {c: b for c, b in changed.items() if len(b) == 1 and b != c}
    return "".join([*one, *(c for c, b in changed.items() if not b)]), "".join(one.values()), {c: b for c, b in changed.items() if len(b) > 1}


def _jamo(syllable: Column) -> Column:
    """A Hangul syllable as its two or three letters."""
    first, middle, last = ("".join(map(chr, range(a, a + n))) for a, n in ((0x1100, 19), (0x1161, 21), (0x11A8, 27)))
    at = F.ascii(syllable) - 0xAC00
    letter = lambda of, k: F.substr(F.lit(of), (k + 1).cast("int"), F.lit(1))
    return F.concat(letter(first, F.floor(at / 588)), letter(middle, F.floor(at % 588 / 28)), F.when(at % 28 > 0, letter(last, at % 28 - 1)).otherwise(F.lit("")))


def strip_accents(c: Column, split_syllables: bool = True) -> Column:
    """Canonical decomposition without its non-spacing marks, all in the JVM; plain texts stay untouched. split_syllables: of Hangul, too."""
    letters, bare, several = _decompositions()

    def rest(plain: Column) -> Column:
        spelt = plain
        for x, y in several.items():
            spelt = F.replace(spelt, F.lit(x), F.lit(y))
        if not split_syllables:
            return spelt
        syllables = F.transform(F.regexp_extract_all(spelt, F.lit("(?s)(.)"), F.lit(1)), lambda x: F.when(x.between("\uac00", "\ud7a3"), _jamo(x)).otherwise(x))
        return F.when(plain.rlike(f"[\uac00-\ud7a3{''.join(several)}]"), F.array_join(syllables, "")).otherwise(plain)

    return F.when(c.rlike(r"[^\x00-\x7F]"), F.element_at(F.transform(F.array(F.translate(c, letters, bare)), rest), 1)).otherwise(c)  # translated once, as an argument


#: Latin spelling of lower-case Greek and Cyrillic letters and of Latin ones that do not decompose.
ONE_LETTER = ("αβγδεζηικλμνξοπρσςτυωабвгдезийклмнопрстуфыэієґøđłı", "abgdezeiklmnxoprsstuoabvgdeziiklmnoprstufyeieg" + "odli")
MORE_LETTERS = {"θ": "th", "φ": "ph", "χ": "kh", "ψ": "ps", "ж": "zh", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ю": "iu", "я": "ia", "ъ": "'", "ь": "'", "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d"}


def transliterated(c: Column) -> Column:
    """Lower-case text with accents removed and Greek, Cyrillic and special Latin letters in plain ones; other scripts stay."""
    plain = F.translate(strip_accents(c), *ONE_LETTER)
    for letter, spelt in MORE_LETTERS.items():
        plain = F.replace(plain, F.lit(letter), F.lit(spelt))
    return F.when(c.rlike(r"[^\x00-\x7F]"), plain).otherwise(c)


def ascii_clean(c: Column) -> Column:
    """Accents removed, what is still outside ASCII a space for each code point; null the empty text."""
    return F.coalesce(F.regexp_replace(strip_accents(c), r"[^\x00-\x7F]", " "), F.lit(""))


def without_html(c: Column) -> Column:
    """Shortest runs from < to > on one line removed."""
    return F.regexp_replace(c, "<[^\n]*?>", "")


def without_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)[^\p{L}\p{N}\s]", "")


def dedup_key(c: Column, decode: bool = True) -> Column:
    """Lower case in Latin letters without accents, tags, punctuation, articles, 'and' and white space; null for nothing to start from."""
    low = F.lower(c)
    plain = without_punctuation(without_html(transliterated(low) if decode else low))
    return F.when(F.length(c) > 0, F.regexp_replace(F.regexp_replace(plain, r"(?U)\b(?:an?|the|and)\b", ""), r"(?U)\s+", ""))


def plain_key(c: Column) -> Column:
    """dedup_key() as SQL engines make it whose patterns know the words and white space of ASCII only: letters lose their accents
    but are not spelt in Latin ones, ß is ss, and the empty text has the empty key."""
    low = F.replace(strip_accents(F.lower(F.replace(c, F.lit("Σ"), F.lit("σ"))), False), F.lit("ß"), F.lit("ss"))  # a sigma ends a word as it is elsewhere
    words = F.regexp_replace(without_html(low), r"[^\p{L}\p{N}\t\n\f\r ]", "")
    return F.regexp_replace(F.regexp_replace(words, "(?<![0-9A-Za-z])(?:an?|the|and)(?![0-9A-Za-z])", ""), r"[\t\n\f\r ]+", "")


def clean_title(c: Column) -> Column:
    """The two characters backslash and n, left over from escaping, as a space."""
    return F.replace(c, F.lit("\\n"), F.lit(" "))


def json_text(c: Column) -> Column:
    return F.coalesce(F.to_json(c), F.lit("null"))


def affiliation_text(many: Column, one: Column) -> Column:
    """The list joined by ';', or else the single value; null for neither."""
    return F.coalesce(F.nullif(F.array_join(many, ";"), F.lit("")), F.nullif(one, F.lit("")))


def index_of(c: Column) -> Column:
    """JSON text of an inverted index as a map; the newer form has it under InvertedIndex. Malformed text gives null."""
    newer = F.when(F.contains(c, F.lit("InvertedIndex")), F.get_json_object(c, "$.InvertedIndex"))
    return F.from_json(F.when(F.startswith(newer, F.lit("{")), newer).otherwise(c), "map<string,array<int>>")  # it may be a word, too


def abstract_text(index: Column) -> Column:
    """Words of an inverted index (word to positions) in the order of positions; null for none. Of two words at a position the later entry's counts."""
    placed = F.flatten(F.transform(F.map_entries(index), lambda e, i: F.transform(e["value"], lambda p: F.struct(p.alias("at"), i.alias("entry"), e["key"].alias("word")))))

    def joined(held: Column) -> Column:
        last = F.filter(held, lambda x, i: F.coalesce(F.get(held, i + 1)["at"] != x["at"], F.lit(True)))
        return F.nullif(F.array_join(F.transform(last, lambda x: x["word"]), " "), F.lit(""))

    return F.element_at(F.transform(F.array(F.sort_array(placed)), joined), 1)  # sorted once, as an argument


def inverted_index(words: Column) -> Column:
    """The inverse of abstract_text, each word of a list with its positions: the words are sorted with their positions, and each run
    of a word is an entry. Null for no list."""

    def index(placed: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(placed) - 1), lambda i: (i == 0) | (F.get(placed, i)["word"] != F.get(placed, i - 1)["word"]))

        def entries(at: Column) -> Column:
            places = F.transform(at, lambda a, k: F.transform(F.slice(placed, a + 1, F.coalesce(F.get(at, k + 1), F.size(placed)) - a), lambda x: x["at"]))
            return F.map_from_arrays(F.transform(at, lambda a: F.get(placed, a)["word"]), places)

        return F.element_at(F.transform(F.array(starts), entries), 1)

    placed = F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at")))
    return F.element_at(F.transform(F.array(F.sort_array(placed)), index), 1)  # sorted once, as an argument


def inverted_indexes(df: DataFrame, key: str, text: str, pattern: str = r"\s+") -> DataFrame:
    """(key, index): the inverted_index() of each text, made within the row. Null and empty texts have no row."""
    return df.where(F.trim(F.col(text)) != "").select(key, inverted_index(F.split(F.trim(F.col(text)), pattern)).alias("index"))
