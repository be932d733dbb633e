"""Text cleaning: titles, search terms, remote flag and skills."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from rolecall.schemas import REMOTE_KEYWORDS, SKILLS, TITLE_NOISE

# Every Unicode blank, control separators included: as ranges, as a pattern, as a text.
_BLANKS = (
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)
BLANK = "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in _BLANKS) + "]"
BLANK_TEXT = "".join(chr(c) for a, b in _BLANKS for c in range(a, b + 1))
# Letters that have a case, and the characters that make up a word.
CASED = r"\p{IsUppercase}\p{IsLowercase}\p{IsTitlecase}"
WORD = r"[\p{L}\p{N}_]"
# U+FFFF is no character, so no text holds it.
MARK = chr(0xFFFF) + " "
# Dotted and dotless i, long s and the Kelvin sign: equal to plain letters when case is ignored.
ODD_CASE, PLAIN_CASE = "".join(map(chr, (0x0130, 0x0131, 0x017F, 0x212A))), "iisk"


def strip(text: Column) -> Column:
    """Remove blanks of any kind at both ends (plain `trim` knows the space only)."""
    return F.btrim(text, F.lit(BLANK_TEXT))


def title_case(text: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others.

    `initcap` starts a word after a space only. A marked space is therefore set before
    each letter that follows another kind of character, and taken out again; this stays
    inside generated code, which a per-run `transform` would not.
    """
    spaced = F.regexp_replace(text, rf"([^{CASED}])(?=[{CASED}])", "$1" + MARK)
    return F.replace(F.initcap(spaced), F.lit(MARK), F.lit(""))


def normalize_title(title: Column, noise: Sequence[str] = TITLE_NOISE) -> Column:
    """Strip, drop the noise endings, title-case; NULL becomes the empty text."""
    bare = strip(F.coalesce(title, F.lit("")))
    bare = reduce(lambda text, end: F.regexp_replace(text, f"(?iU){end}", ""), noise, bare)
    return title_case(strip(bare))


def normalize_keyword(keyword: Column) -> Column:
    """Search term in lower case with single spaces; NULL becomes the empty text."""
    joined = F.regexp_replace(F.coalesce(keyword, F.lit("")), f"{BLANK}+", " ")
    return F.lower(F.trim(joined))


def detect_remote(
    title: Column, description: Column, keywords: Sequence[str] = REMOTE_KEYWORDS
) -> Column:
    """True when a phrase occurs anywhere in title and description, read as one text."""
    empty = F.lit("")
    text = F.lower(F.concat(F.coalesce(title, empty), F.lit(" "), F.coalesce(description, empty)))
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(k)) for k in keywords])


def _whole(term: str) -> str:
    """Pattern for `term` between word boundaries, with the term's text taken literally."""
    before = f"(?<!{WORD})" if re.match(r"\w", term[0]) else f"(?<={WORD})"
    after = f"(?!{WORD})" if re.match(r"\w", term[-1]) else f"(?={WORD})"
    return before + r"\Q" + term + r"\E" + after


def extract_skills(description: Column, lexicon: Sequence[str] = SKILLS) -> Column:
    """Lexicon terms that occur as whole words, in lexicon order, each once.

    One scan of the text yields its words, and with them all one-word terms. A term with
    blanks or signs in it is searched for by pattern, where the text contains it at all.
    """
    text = F.coalesce(description, F.lit(""))
    if any(not t.isascii() or t != t.lower() for t in lexicon):
        hits = [F.when(F.rlike(text, F.lit("(?iu)" + _whole(t))), F.lit(t)) for t in lexicon]
        return F.array_compact(F.array(*hits))
    folded = F.lower(F.translate(text, ODD_CASE, PLAIN_CASE))
    found = F.regexp_extract_all(folded, F.lit(f"{WORD}+"), F.lit(0))
    phrases = [t for t in lexicon if not re.fullmatch(r"\w+", t)]
    if phrases:
        tests = [F.contains(folded, F.lit(t)) & F.rlike(folded, F.lit(_whole(t))) for t in phrases]
        hits = F.array(*[F.when(test, F.lit(t)) for test, t in zip(tests, phrases)])
        found = F.concat(found, F.array_compact(hits))
    return F.array_intersect(F.array(*[F.lit(t) for t in lexicon]), found)
