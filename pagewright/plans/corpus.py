"""A corpus of legal-looking pages, derived from conversations in the same way by Spark and by SQL.

A conversation is a document, a turn a page. Every page has headings, list marks, page numbers and
repeated lines around the turn's text, in which words are broken and lines wrapped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pages_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, page_idx, text of the conversations themselves."""
    return pages_from(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def pages_from(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("conv_id").cast("string").alias("doc_id"), F.col("turn").cast("int").alias("page_idx"), F.coalesce("text", F.lit("")).alias("text"))


def legal_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legal_from(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def legal_from(conversations: DataFrame) -> DataFrame:
    rows = pages_from(conversations)
    n, number = F.col("page_idx"), F.col("page_idx").cast("string")
    after = (F.col("page_idx") + 1).cast("string")
    lit = F.lit
    body = F.replace(F.replace(F.replace(F.col("text"), lit("tion "), lit("ti-\non ")), lit(" de "), lit(" de\n")), lit(", "), lit(",\n"))
    parts = [
        lit("PRESIDEN REPUBLIK INDONESIA"), F.when(n % 2 == 0, "BAB I KETENTUAN UMUM").otherwise("BAB II"), F.concat(lit("Pasal "), after), lit("Menimbang:"), body,
        F.when(n % 3 == 0, ""), lit("Hal. 3"), lit("12"), lit("1234"), lit("a. huruf satu."), lit("b."), F.concat(lit("("), number, lit(")")), lit("2."), lit("lanjutan."), lit("c."),
        lit("   Pasal 9"), lit("isi akhir"), lit("I. UMUM"), lit("PENJELASAN"), F.when(n % 3 == 1, "Mengingat :"), lit("5. lima."), lit("( "), lit("7) tujuh;"),
        lit("LEMBARAN NEGARA REPUBLIK INDONESIA X"), lit("– 4 —"), lit("- 1 -"), lit("- 2 -"), lit("KEMENTERIAN KETENAGAKERJAAN RI"), lit("kaki tetap"), F.concat(lit("- "), after, lit(" -")),
    ]
    return rows.select("doc_id", "page_idx", F.concat_ws("\n", *parts).alias("text"))


def single_page_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages, each a document of its own."""
    rows = legal_pages(spark, sf_dir)
    return rows.select(F.concat_ws("-", "doc_id", F.col("page_idx").cast("string")).alias("doc_id"), F.lit(0).alias("page_idx"), "text")


def truth_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected headings of each document: a chapter and an article for each page."""
    rows = pages_of(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("n"))
    return rows.select("doc_id", F.col("n").alias("bab"), F.floor((F.col("n") + 1) / 2).cast("bigint").alias("pasal"))


SQL_PAGES = "pages_of AS (SELECT CAST(conv_id AS VARCHAR) AS doc_id, CAST(turn AS INTEGER) AS page_idx, coalesce(text, '') AS text FROM conversations)"
SQL_LEGAL = SQL_PAGES + """,
legal AS (
  SELECT doc_id, page_idx, concat_ws(chr(10), 'PRESIDEN REPUBLIK INDONESIA', CASE WHEN page_idx % 2 = 0 THEN 'BAB I KETENTUAN UMUM' ELSE 'BAB II' END,
    'Pasal ' || (page_idx + 1), 'Menimbang:', replace(replace(replace(text, 'tion ', 'ti-' || chr(10) || 'on '), ' de ', ' de' || chr(10)), ', ', ',' || chr(10)),
    CASE WHEN page_idx % 3 = 0 THEN '' END, 'Hal. 3', '12', '1234', 'a. huruf satu.', 'b.', '(' || page_idx || ')', '2.', 'lanjutan.', 'c.',
    '   Pasal 9', 'isi akhir', 'I. UMUM', 'PENJELASAN', CASE WHEN page_idx % 3 = 1 THEN 'Mengingat :' END, '5. lima.', '( ', '7) tujuh;',
    'LEMBARAN NEGARA REPUBLIK INDONESIA X', chr(8211) || ' 4 ' || chr(8212), '- 1 -', '- 2 -', 'KEMENTERIAN KETENAGAKERJAAN RI', 'kaki tetap', '- ' || (page_idx + 1) || ' -') AS text
  FROM pages_of
)"""
