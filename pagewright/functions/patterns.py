"""Patterns that classify lines of legal documents.

Bodies are shared with the SQL that checks the engine. Spark's regular expressions get a prefix that
makes classes Unicode-aware (U), lets ``.`` and ``$`` know the line feed alone (d), and ignores case (i)
where the rule does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column

# The line patterns of the domain.
DASH = r"[\x{2012}\x{2013}\x{2014}\x{2212}\-]"
PRESIDENT = r"^\s*PRESIDEN\s+REPUBLIK\s+INDONESIA\s*$"
MINISTRY = r"^\s*KEMENTERIAN\s+KETENAGAKERJAAN\s*(RI)?\s*$"
GAZETTE = r"^\s*(TAMBAHAN\s+)?LEMBARAN\s+NEGARA\s+REPUBLIK\s+INDONESIA.*$"
DASHED_NUMBER = rf"^\s*{DASH}{{1,3}}\s*\d+\s*{DASH}{{1,3}}\s*$"
PAGE_WORD = r"^\s*(Hal(?:\.|aman))\s*\d+\s*$"
BARE_NUMBER_3 = r"^\s*\d{1,3}\s*$"
BARE_NUMBER_4 = r"^\s*\d{1,4}\s*$"
LEGAL_HEADING = r"^(BAB\s+[IVXLCDM]|Pasal\s+\d+|Menimbang:?|Mengingat:?|PENJELASAN)\b"
LEGAL_HEADING_STRICT = r"^(BAB\s+[IVXLCDM]+|Pasal\s+\d+|Menimbang:?|Mengingat:?|PENJELASAN)\b"
PREAMBLE = r"^\s*(Menimbang|Mengingat)\s*:\s*$"
CHAPTER = r"^\s*BAB\s+([IVXLCDM]+)\b(.*)$"
ARTICLE = r"^\s*Pasal\s+(\d+)\s*$"
ELUCIDATION = r"^\s*PENJELASAN\s*$"
ROMAN_TITLE = r"^\s*([IVX]+)\.\s+([A-Z][^\n]+)$"
BROKEN_WORD = r"(\w)-\n(\w)"
LETTER_ITEM = r"^\s*([a-z])\.\s+"
NUMBER_ITEM = r"^\s*\d+\.\s+"
LONE_PAREN = r"^\s*\((\d+)\)\s*$"
LONE_NUMBER = r"^\s*([0-9]+)\.\s*$"
LONE_LETTER = r"^\s*([a-z])\.\s*$"
ANY_LONE_NUMBER = r"^\s*\d+\.\s*$"
SPLIT_PAREN = r"\(\s*\n\s*\d+\)"
MD_CHAPTER = r"^##\s+BAB\s+[IVXLCDM]+"
MD_ARTICLE = r"^##\s+Pasal\s+\d+"


# The characters with the Unicode property White_Space, in the notation of a class.
SPACES = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: A class of them without the line feed, for patterns over whole texts.
IN_LINE = r"[\t\x{b}-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def java(body: str, ignore_case: bool = False) -> str:
    """A body for Spark. ``\\s`` is spelt out, since a listed class is quicker than a Unicode-aware one."""
    return f"(?{'i' if ignore_case else ''}dU){body.replace(chr(92) + 's', f'[{SPACES}]')}"


def _any(line: Column, bodies: tuple[tuple[str, bool], ...]) -> Column:
    """Whether one of the patterns fits. Each is anchored and tried once, at the line's start."""
    fits = matches(line, *bodies[0])
    for body, ignore_case in bodies[1:]:
        fits = fits | matches(line, body, ignore_case)
    return fits


@dataclass(frozen=True)
class RuleSet:
    """The rules of one document profile. ``strict_roman`` reads whole roman numerals in headings.

    By default a heading's numeral must be a single letter at a word boundary, as ``BAB I``; ``BAB II`` is
    no heading for the suppressor and the soft-wrap join.
    """

    headers: tuple[str, ...] = (PRESIDENT, MINISTRY, GAZETTE)
    footers: tuple[tuple[str, bool], ...] = ((DASHED_NUMBER, False), (PAGE_WORD, True))
    strict_roman: bool = False

    def header(self, line: Column) -> Column:
        return _any(line, tuple((b, True) for b in self.headers))

    def footer(self, line: Column) -> Column:
        return _any(line, self.footers)

    def heading(self, line: Column) -> Column:
        return line.rlike(java(LEGAL_HEADING_STRICT if self.strict_roman else LEGAL_HEADING, True))


DEFAULT_RULES = RuleSet()


def matches(line: Column, body: str, ignore_case: bool = False) -> Column:
    return line.rlike(java(body, ignore_case))
