"""Text functions with Unicode white space, and lines as arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions.patterns import SPACES


#: The characters of ``patterns.SPACES``.
SPACE_CHARS = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def trim(x: Column) -> Column:
    return F.trim(x, F.lit(SPACE_CHARS))


def trim_start(x: Column) -> Column:
    return F.ltrim(x, F.lit(SPACE_CHARS))


def trim_end(x: Column) -> Column:
    return F.rtrim(x, F.lit(SPACE_CHARS))


def collapse(x: Column) -> Column:
    """Runs of white space as one blank; most lines have single blanks alone, which two quick tests tell."""
    return F.when(x.contains("  ") | x.rlike(f"[{SPACES}&&[^ ]]"), F.regexp_replace(x, f"[{SPACES}]+", " ")).otherwise(x)


def normal(x: Column) -> Column:
    return collapse(trim(x))


def visible_length(x: Column) -> Column:
    """Code points that are not white space."""
    return F.length(F.translate(x, SPACE_CHARS, "")).cast("bigint")


def ends_in_ascii_alnum(x: Column) -> Column:
    """Whether the last character that is not white space is an ASCII letter or digit."""
    return F.substring(trim_end(x), -1, 1).rlike("^[0-9A-Za-z]")


def lines(text: Column) -> Column:
    """The lines of a text: cut at line feeds, without a carriage return before one, and without an empty last part."""
    # All on the text itself: a lambda that looked at another part would split it again for each line.
    plain = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    body = F.when(plain.endswith("\n"), F.substring(plain, F.lit(1), F.length(plain) - 1)).otherwise(plain)
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n", -1))


def explode_lines(df: DataFrame, text: str, keys: list[str], keep_empty: bool = False) -> DataFrame:
    """keys, n_lines, line_idx (from 0), line.

    A row whose text is null or empty gives no line, or one row with a null line_idx and line if ``keep_empty``.
    """
    own = df.select(*keys, lines(F.col(text)).alias("__lines"))
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return own.select(*keys, F.size("__lines").alias("n_lines"), explode("__lines").alias("line_idx", "line"))


def joined(position: Column, line: Column, sep: str = "\n") -> Column:
    """Aggregate: the lines in order of position, joined."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(position.alias("at"), line.alias("line")))), lambda x: x["line"]), sep)
