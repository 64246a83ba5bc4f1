"""What the document rules say, in sets, counts and ranks over flat lists of lines, to hold the relational plans against."""

from __future__ import annotations

import re
from collections import Counter, namedtuple
from itertools import accumulate, groupby
from math import ceil

from pagewright.functions import patterns as P

Line = namedtuple("Line", "page first last text")
Suppressed = namedtuple("Suppressed", "pages header footer overrun sample candidates")


def rule(body: str, ignore_case: bool = False):
    """A pattern of the engine for Python."""
    return re.compile(re.sub(r"\\x\{([0-9a-fA-F]+)\}", lambda m: chr(int(m[1], 16)), body), re.I if ignore_case else 0)


HEADER = [rule(x, True) for x in (P.PRESIDENT, P.MINISTRY, P.GAZETTE)]
FOOTER = [rule(P.DASHED_NUMBER), rule(P.PAGE_WORD, True)]
HEADING, NUMBER = rule(P.LEGAL_HEADING, True), rule(P.BARE_NUMBER_4)
#: Classes of a line, from its text and from whether it is a repeated one; the first that fits holds.
CLASSES = [
    ("header", lambda text, again: fits(HEADER, text)),
    ("footer", lambda text, again: fits(FOOTER, text)),
    ("number", lambda text, again: again and fits([NUMBER], text)),
    ("text", lambda text, again: fits([NUMBER], text)),
    ("repeated", lambda text, again: again),
    ("text", lambda text, again: True),
]
#: Headings: pattern, name, and what the line becomes.
PROMOTED = [
    (rule(P.PREAMBLE), None, r"## \1"),
    (rule(P.CHAPTER), "bab", r"## BAB \1\2"),
    (rule(P.ARTICLE), "pasal", r"## Pasal \1"),
    (rule(P.ELUCIDATION), "penjelasan", "## PENJELASAN"),
    (rule(P.ROMAN_TITLE), "subheading", r"### \1. \2"),
]
MARKS = [(rule(P.LONE_PAREN), r"(\1)"), (rule(P.LONE_NUMBER), r"\1."), (rule(P.LONE_LETTER), r"\1.")]
ITEMS = [(rule(P.LETTER_ITEM), r"- (\1 )"), (rule(P.NUMBER_ITEM), "1. ")]


def fits(patterns, line: str) -> bool:
    return any(p.search(line) for p in patterns)


def lines_of(text: str) -> list[str]:
    """Line feeds end lines, and take a carriage return before them along; what follows the last one is a line if there is anything."""
    return [x.removesuffix("\n").removesuffix("\r") if x.endswith("\n") else x for x in re.findall(r"[^\n]*\n|[^\n]+", text)]


def normal(line: str) -> str:
    return " ".join(re.split(r"\s+", line.strip()))


def suppress(pages: list[str], keep: str | None = None) -> Suppressed:
    flat = []
    for n, page in enumerate(pages):
        own = lines_of(page)
        flat += [Line(n, k == 0, k + 1 == len(own), x) for k, x in enumerate(own)]
    counted = [x for x in flat if x.text.strip() and not HEADING.search(x.text.strip())]
    everywhere, above, below = (Counter(normal(x.text) for x in counted if test(x)) for test in (lambda x: True, lambda x: x.first, lambda x: x.last))
    enough = max(1, ceil(3 * max(1, len(pages)) / 5))
    often = {n for n, c in everywhere.items() if c >= enough and 2 * max(above[n], below[n]) >= c}
    repeated = {n for n in often if 3 <= len(n.encode()) <= 120 and not HEADING.search(n)}

    kinds = [next(k for k, test in CLASSES if test(x.text.rstrip(), normal(x.text) in repeated)) for x in flat]
    drops = [k != "text" and not (keep and re.search(keep, x.text.rstrip())) for k, x in zip(kinds, flat)]
    ranks = []
    for _, own in groupby(zip(flat, drops), key=lambda x: x[0].page):
        ranks += accumulate(d for _, d in own)
    stay = [not d or r > 5 for d, r in zip(drops, ranks)]
    kept = [[x.text.rstrip() for x, s in zip(flat, stay) if s and x.page == n] for n in range(len(pages))]
    number_of = Counter(kinds)
    return Suppressed(
        ["\n".join(x) for x in kept], number_of["header"], number_of["footer"] + number_of["number"], sum(d and r > 5 for d, r in zip(drops, ranks)),
        [x.text.strip() for x, d in zip(flat, drops) if d][:5], repeated,
    )


def cleanup(text: str) -> tuple[str, int, int, int]:
    whole, fixed = rule(P.BROKEN_WORD).subn(r"\1\2", text)
    parts = {"header": [], "footer": [], "text": []}
    for x in lines_of(whole):
        parts["header" if fits(HEADER, x) else "footer" if fits([*FOOTER, rule(P.BARE_NUMBER_3)], x) else "text"].append(x)
    # A line goes on behind one that ends in an ASCII letter or digit and is no heading.
    goes_on = [False, *(bool(re.search(r"[0-9A-Za-z]\s*\Z", x)) and not HEADING.search(x) for x in parts["text"])]
    wrapped = "".join(" " + x.lstrip() if on else "\n" + x for on, x in zip(goes_on, parts["text"]))[1:]

    rows = lines_of(wrapped)
    marks = [next((m.expand(to) for p, to in MARKS if (m := p.search(x))), None) for x in rows]
    able = [bool(mark and after and after.strip() and not HEADING.search(after)) for mark, after in zip(marks, [*rows[1:], None])]
    takes = set()  # every other one of a run, from its first
    for can, run in groupby(range(len(rows)), key=lambda k: able[k]):
        takes.update(list(run)[::2] if can else [])
    merged = [f"{marks[k]} {rows[k + 1].lstrip()}" if k in takes else x for k, x in enumerate(rows) if k - 1 not in takes]
    listed = [next((p.sub(to, x, count=1) for p, to in ITEMS if p.search(x)), x) for x in merged]
    return "\n".join(listed), len(parts["header"]), len(parts["footer"]), fixed


def promote(text: str) -> tuple[str, dict]:
    out = [next(((name or m[1].lower(), m.expand(to)) for p, name, to in PROMOTED if (m := p.search(x))), ("text", x)) for x in lines_of(text)]
    n = Counter(name for name, _ in out)
    return "\n".join(x for _, x in out), {"bab": n["bab"], "pasal": n["pasal"], **{k: n[k] > 0 for k in ("menimbang", "mengingat", "penjelasan")}}


def metrics(raw: str, md: str) -> tuple[float, float, int]:
    visible = lambda s: len("".join(s.split()))
    leaks = lambda s: sum(fits([HEADER[2], *FOOTER], x) for x in lines_of(s))
    both, lone = leaks(raw) + leaks(md), sum(fits([rule(P.LONE_LETTER), rule(P.ANY_LONE_NUMBER)], x) for x in lines_of(md))
    return (min(1.0, visible(md) / visible(raw)) if visible(raw) else 0.0, leaks(md) / both if both else 0.0, len(rule(P.SPLIT_PAREN).findall(md)) + lone)
