"""Line repair of merged documents (doc_id, text): broken words, page furniture, soft wraps, stray list marks.

Each step takes and gives ordered line rows (doc_id, line_no, line). What looks like a sequential fold
has a closed form: joining a soft wrap depends on the kept line before (``lag``), and taking the line
behind a stray mark depends on the parity of a run (a running maximum). All windows share the
partitioning by document that merging left behind.

``clean_whole`` does the same inside the row of a document, for plans that need no lines as rows: arrays
of lines for what depends on a neighbour, and replacements over the text for what consumes the next line,
since matches do not overlap and go from left to right.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import patterns as P
from pagewright.functions import text as X


def in_doc():
    return Window.partitionBy("doc_id").orderBy("line_no")


def running():
    return in_doc().rowsBetween(Window.unboundedPreceding, 0)


def dehyphenate(documents: DataFrame) -> DataFrame:
    """doc_id, text with words joined that a hyphen broke at a line's end, and hyphens_fixed."""
    body = P.java(P.BROKEN_WORD)
    return documents.select("doc_id", F.regexp_replace("text", body, "$1$2").alias("text"), F.regexp_count("text", F.lit(body)).cast("bigint").alias("hyphens_fixed"))


def numbered_lines(documents: DataFrame) -> DataFrame:
    return X.explode_lines(documents, "text", ["doc_id"]).select("doc_id", F.col("line_idx").alias("line_no"), "line")


def furniture(lines: DataFrame, rules: P.RuleSet = P.DEFAULT_RULES) -> DataFrame:
    """Lines with their class: header, footer (bare numbers of up to three digits among them) or text."""
    line = F.col("line")
    footer = rules.footer(line) | P.matches(line, P.BARE_NUMBER_3)
    return lines.withColumn("class", F.when(rules.header(line), "header").when(footer, "footer").otherwise("text"))


def furniture_counts(documents: DataFrame, classified: DataFrame) -> DataFrame:
    counts = classified.groupBy("doc_id").agg(F.count_if(F.col("class") == "header").alias("removed_header"), F.count_if(F.col("class") == "footer").alias("removed_footer"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return documents.select("doc_id").join(counts, "doc_id", "left").select("doc_id", zero("removed_header"), zero("removed_footer"))


def reread(lines: DataFrame) -> DataFrame:
    """The lines that their text, joined and cut again, would have: without an empty last line, or a carriage return before a line feed."""
    line, last = F.col("line"), F.col("__last")
    rows = lines.withColumn("__last", F.lead(F.lit(1)).over(in_doc()).isNull()).where(~(last & (line == "")))
    cut = F.when(~last & line.endswith("\r"), F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    return rows.withColumn("line", cut).drop("__last")


def join_soft_wraps(lines: DataFrame, rules: P.RuleSet = P.DEFAULT_RULES) -> DataFrame:
    """Lines after one that ends in an ASCII letter or digit, and is no heading, continue it with a blank."""
    line = F.col("line")
    wraps = ~rules.heading(line) & X.ends_in_ascii_alnum(line)
    rows = lines.withColumn("__on", F.coalesce(F.lag(wraps).over(in_doc()), F.lit(False)))
    rows = rows.withColumn("__group", F.sum((~F.col("__on")).cast("int")).over(running()))
    piece = F.when(F.col("__on"), X.trim_start(line)).otherwise(line)
    rows = rows.groupBy("doc_id", "__group").agg(X.joined(F.col("line_no"), piece, " ").alias("line"))
    rows = rows.select("doc_id", F.col("__group").alias("line_no"), "line")
    return reread(rows.withColumn("line_no", (F.col("line_no") - 1).cast("int")))


def merge_stray_marks(lines: DataFrame, rules: P.RuleSet = P.DEFAULT_RULES) -> DataFrame:
    """A lone ``(1)``, ``1.`` or ``a.`` takes the next line, unless that is blank or a heading; a taken line takes none."""
    line, after = F.col("line"), F.col("__next")
    token = (
        F.when(P.matches(line, P.LONE_PAREN), F.concat(F.lit("("), F.regexp_extract(line, P.java(P.LONE_PAREN), 1), F.lit(")")))
        .when(P.matches(line, P.LONE_NUMBER), F.concat(F.regexp_extract(line, P.java(P.LONE_NUMBER), 1), F.lit(".")))
        .when(P.matches(line, P.LONE_LETTER), F.concat(F.regexp_extract(line, P.java(P.LONE_LETTER), 1), F.lit(".")))
    )
    rows = lines.withColumns({"__next": F.lead("line").over(in_doc()), "__at": F.row_number().over(in_doc())})
    rows = rows.withColumn("__token", token)
    can = F.col("__token").isNotNull() & F.coalesce((X.trim(after) != "") & ~rules.heading(after), F.lit(False))
    rows = rows.withColumn("__can", can).withColumn("__stop", F.coalesce(F.max(F.when(~F.col("__can"), F.col("__at"))).over(running()), F.lit(0)))
    takes = F.col("__can") & ((F.col("__at") - F.col("__stop")) % 2 == 1)
    rows = rows.withColumn("__takes", takes).withColumn("__taken", F.coalesce(F.lag("__takes").over(in_doc()), F.lit(False))).where(~F.col("__taken"))
    return rows.select("doc_id", "line_no", F.when(F.col("__takes"), F.concat_ws(" ", "__token", X.trim_start(after))).otherwise(line).alias("line"))


def normalise_lists(lines: DataFrame) -> DataFrame:
    """``a. x`` becomes ``- (a )x``, and ``7. x`` becomes ``1. x``."""
    line = F.col("line")
    new = (
        F.when(P.matches(line, P.LETTER_ITEM), F.regexp_replace(line, P.java(P.LETTER_ITEM), "- ($1 )"))
        .when(P.matches(line, P.NUMBER_ITEM), F.regexp_replace(line, P.java(P.NUMBER_ITEM), "1. "))
        .otherwise(line)
    )
    return lines.withColumn("line", new)


def cleanup_lines(documents: DataFrame, rules: P.RuleSet = P.DEFAULT_RULES) -> tuple[DataFrame, DataFrame]:
    """(cleaned lines, stats by document) of merged documents."""
    whole = dehyphenate(documents)
    classified = furniture(numbered_lines(whole), rules)
    stats = whole.select("doc_id", "hyphens_fixed").join(furniture_counts(documents, classified), "doc_id")
    kept = classified.where(F.col("class") == "text").drop("class")
    return normalise_lists(merge_stray_marks(join_soft_wraps(kept, rules), rules)), stats


def to_documents(documents: DataFrame, lines: DataFrame, name: str = "text") -> DataFrame:
    """doc_id and the lines as one text; documents without lines stay, as empty."""
    text = lines.groupBy("doc_id").agg(X.joined(F.col("line_no"), F.col("line")).alias(name))
    return documents.select("doc_id").join(text, "doc_id", "left").select("doc_id", F.coalesce(name, F.lit("")).alias(name))


#: What may start a header or footer; a quick test before the patterns themselves.
FURNITURE_START = r"^\s*[PpKk\x{212a}TtLlHh\p{Nd}\x{2012}\x{2013}\x{2014}\x{2212}\-]"
_HEADING_AHEAD = f"(?!(?i:BAB{P.IN_LINE}+[IVXLCDM]|Pasal{P.IN_LINE}+\\p{{Nd}}+|Menimbang:?|Mengingat:?|PENJELASAN)\\b)"
_HEADING_AHEAD_STRICT = _HEADING_AHEAD.replace("[IVXLCDM]", "[IVXLCDM]+")


def stray_mark(rules: P.RuleSet) -> str:
    """A lone mark with its line feed, and the next line's indent and first character, if that is neither blank nor a heading.

    The character is part of the match, so that the line that was taken is no start of another match.
    """
    ahead = _HEADING_AHEAD_STRICT if rules.strict_roman else _HEADING_AHEAD
    return f"(?mdU)^{P.IN_LINE}*(\\(\\p{{Nd}}+\\)|[0-9]+\\.|[a-z]\\.){P.IN_LINE}*\n{ahead}{P.IN_LINE}*([^{P.SPACES}])"


def clean_whole(documents: DataFrame, rules: P.RuleSet = P.DEFAULT_RULES) -> DataFrame:
    """``documents`` with text replaced by the array ``lines`` of cleaned lines, as they are read again, and the counters."""
    broken = P.java(P.BROKEN_WORD)
    rows = documents.withColumns({"hyphens_fixed": F.regexp_count("text", F.lit(broken)).cast("bigint"), "text": F.regexp_replace("text", broken, "$1$2")})

    def kind(x):
        may = P.matches(x, FURNITURE_START)
        header = may & rules.header(x)
        return F.when(~may, 0).when(header, 1).when(rules.footer(x) | P.matches(x, P.BARE_NUMBER_3), 2).otherwise(0)

    if rules != P.DEFAULT_RULES:  # other profiles may have other starts
        kind = lambda x: F.when(rules.header(x), 1).when(rules.footer(x) | P.matches(x, P.BARE_NUMBER_3), 2).otherwise(0)
    rows = rows.withColumn("__marked", F.transform(X.lines(F.col("text")), lambda x: F.struct(x.alias("line"), kind(x).alias("kind"))))
    of = lambda k: F.size(F.filter("__marked", lambda x: x["kind"] == k)).cast("bigint")
    # Each kept line with whether the next one continues it.
    wraps = lambda x: X.ends_in_ascii_alnum(x) & ~rules.heading(x)
    kept = F.transform(F.filter("__marked", lambda x: x["kind"] == 0), lambda x: F.struct(x["line"].alias("line"), wraps(x["line"]).alias("on")))
    rows = rows.withColumns({"removed_header": of(1), "removed_footer": of(2), "__kept": kept}).drop("__marked", "text")
    on = lambda i: F.coalesce(F.get(F.col("__kept"), i - 1)["on"], F.lit(False))
    piece = lambda x, i: F.when(on(i), F.concat(F.lit(" "), X.trim_start(x["line"]))).when(i == 0, x["line"]).otherwise(F.concat(F.lit("\n"), x["line"]))
    rows = rows.withColumn("__text", F.array_join(X.lines(F.array_join(F.transform("__kept", piece), "")), "\n")).drop("__kept")
    text = F.regexp_replace("__text", stray_mark(rules), "$1 $2")
    text = F.regexp_replace(text, f"(?md)^{P.IN_LINE}*([a-z])\\.{P.IN_LINE}+", "- ($1 )")
    text = F.regexp_replace(text, f"(?md)^{P.IN_LINE}*\\p{{Nd}}+\\.{P.IN_LINE}+", "1. ")
    return rows.withColumn("lines", X.lines(text)).drop("__text")
