"""The query catalogue in SQL, written independently of the DataFrame plans, for a second engine.

The corpora hold no white space but blanks and line feeds, so ASCII classes and trims agree with the
engine's Unicode ones.
"""

from __future__ import annotations

from pagewright.functions import patterns as P
from pagewright.plans.corpus import SQL_LEGAL, SQL_PAGES

WORD = r"[\pL\pM\p{Nd}\p{Pc}]"
BROKEN = f"({WORD})-\\n({WORD})"


def rx(column: str, body: str, ignore_case: bool = False) -> str:
    return f"regexp_matches({column}, '{body}'{", 'i'" if ignore_case else ''})"


def header(c: str) -> str:
    return f"({rx(c, P.PRESIDENT, True)} OR {rx(c, P.MINISTRY, True)} OR {rx(c, P.GAZETTE, True)})"


def footer(c: str) -> str:
    return f"({rx(c, P.DASHED_NUMBER)} OR {rx(c, P.PAGE_WORD, True)})"


def heading(c: str) -> str:
    return rx(c, P.LEGAL_HEADING, True)


def exploded(source: str, keys: str, text: str = "text") -> str:
    """keys, line_idx, n_lines, line of the lines of a text."""
    return f"""(SELECT {keys}, unnest(generate_series(0, len(ls) - 1)) AS line_idx, len(ls) AS n_lines, unnest(ls) AS line
      FROM (SELECT *, CASE WHEN parts[-1] = '' THEN list_slice(parts, 1, len(parts) - 1) ELSE parts END AS ls
            FROM (SELECT *, string_split({text}, chr(10)) AS parts FROM {source})) WHERE len(ls) > 0)"""


def suppressor(pages: str = "legal", keep: str | None = None) -> str:
    rescue = f" AND NOT {rx('line', keep)}" if keep else ""
    return f"""
plines AS {exploded(pages, "doc_id, page_idx")},
freq AS (
  SELECT doc_id, regexp_replace(trim(line), '\\s+', ' ', 'g') AS norm, count(*) AS c, count(*) FILTER (line_idx = 0) AS t, count(*) FILTER (line_idx = n_lines - 1) AS b
  FROM plines WHERE trim(line) <> '' AND NOT {heading("trim(line)")} GROUP BY ALL
),
cand AS (
  SELECT doc_id, norm FROM freq JOIN (SELECT doc_id, count(*) AS n FROM {pages} GROUP BY doc_id) USING (doc_id)
  WHERE c >= greatest(1, (3 * n + 4) // 5) AND strlen(norm) BETWEEN 3 AND 120 AND (2 * t >= c OR 2 * b >= c) AND NOT {heading("norm")}
),
classed AS (
  SELECT p.doc_id, page_idx, line_idx, rtrim(line) AS line,
         CASE WHEN {header("rtrim(line)")} THEN 'header' WHEN {footer("rtrim(line)")} THEN 'footer'
              WHEN {rx("line", P.BARE_NUMBER_4)} THEN CASE WHEN k.norm IS NOT NULL THEN 'number' ELSE 'text' END
              WHEN k.norm IS NOT NULL THEN 'repeated' ELSE 'text' END AS class
  FROM plines p LEFT JOIN cand k ON p.doc_id = k.doc_id AND regexp_replace(trim(line), '\\s+', ' ', 'g') = k.norm
),
dropping AS (SELECT *, class <> 'text'{rescue} AS drop FROM classed),
ranked AS (SELECT *, sum(CASE WHEN drop THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_idx ORDER BY line_idx ROWS UNBOUNDED PRECEDING)::BIGINT AS drop_rank FROM dropping),
kept AS (SELECT *, NOT drop OR drop_rank > 5 AS kept FROM ranked),
spages AS (
  SELECT doc_id, page_idx, coalesce(t.text, '') AS text FROM {pages} p
  LEFT JOIN (SELECT doc_id, page_idx, string_agg(line, chr(10) ORDER BY line_idx) AS text FROM kept WHERE kept GROUP BY ALL) t USING (doc_id, page_idx)
),
sstats AS (
  SELECT d.doc_id, coalesce(h, 0)::BIGINT AS removed_header, coalesce(f, 0)::BIGINT AS removed_footer, coalesce(o, 0)::BIGINT AS suppressor_overrun, coalesce(s, []) AS removed_lines_sample
  FROM (SELECT DISTINCT doc_id FROM {pages}) d
  LEFT JOIN (SELECT doc_id, count(*) FILTER (class = 'header') AS h, count(*) FILTER (class IN ('footer', 'number')) AS f, count(*) FILTER (drop AND drop_rank > 5) AS o FROM kept GROUP BY doc_id) USING (doc_id)
  LEFT JOIN (SELECT doc_id, list(trim(line) ORDER BY page_idx, line_idx) AS s
             FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_idx, line_idx) AS r FROM kept WHERE drop) WHERE r <= 5 GROUP BY doc_id) USING (doc_id)
),
merged AS (SELECT doc_id, string_agg(text, chr(10) ORDER BY page_idx) AS text FROM spages GROUP BY doc_id)"""


CLEANUP = f"""
dehyph AS (
  SELECT doc_id, regexp_replace(text, '{BROKEN}', '\\1\\2', 'g') AS text, len(regexp_extract_all(text, '{BROKEN}'))::BIGINT AS hyphens_fixed FROM merged
),
furniture AS (
  SELECT doc_id, line_idx AS line_no, line, CASE WHEN {header("line")} THEN 'header' WHEN {footer("line")} OR {rx("line", P.BARE_NUMBER_3)} THEN 'footer' ELSE 'text' END AS class
  FROM {exploded("dehyph", "doc_id")}
),
fstats AS (
  SELECT doc_id, coalesce(h, 0)::BIGINT AS removed_header, coalesce(f, 0)::BIGINT AS removed_footer FROM dehyph
  LEFT JOIN (SELECT doc_id, count(*) FILTER (class = 'header') AS h, count(*) FILTER (class = 'footer') AS f FROM furniture GROUP BY doc_id) USING (doc_id)
),
wraps AS (
  SELECT doc_id, line_no, line, coalesce(lag(NOT {heading("line")} AND {rx("line", "[0-9A-Za-z][ ]*$")}) OVER (PARTITION BY doc_id ORDER BY line_no), false) AS continues
  FROM furniture WHERE class = 'text'
),
grouped AS (SELECT *, sum(CASE WHEN continues THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) - 1 AS g FROM wraps),
soft0 AS (SELECT doc_id, g::INTEGER AS line_no, string_agg(CASE WHEN continues THEN ltrim(line) ELSE line END, ' ' ORDER BY grouped.line_no) AS line FROM grouped GROUP BY doc_id, g),
soft AS (SELECT doc_id, line_no, line FROM (SELECT *, max(line_no) OVER (PARTITION BY doc_id) AS m FROM soft0) WHERE NOT (line_no = m AND line = '')),
marks AS (
  SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS next, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS i,
         CASE WHEN {rx("line", P.LONE_PAREN)} THEN '(' || regexp_extract(line, '{P.LONE_PAREN}', 1) || ')' WHEN {rx("line", P.LONE_NUMBER)} THEN regexp_extract(line, '{P.LONE_NUMBER}', 1) || '.'
              WHEN {rx("line", P.LONE_LETTER)} THEN regexp_extract(line, '{P.LONE_LETTER}', 1) || '.' END AS token
  FROM soft
),
able AS (SELECT *, token IS NOT NULL AND coalesce(trim(next) <> '' AND NOT {heading("next")}, false) AS can FROM marks),
stops AS (SELECT *, coalesce(max(CASE WHEN NOT can THEN i END) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING), 0) AS stop FROM able),
takes AS (SELECT *, can AND (i - stop) % 2 = 1 AS takes FROM stops),
taken AS (SELECT *, coalesce(lag(takes) OVER (PARTITION BY doc_id ORDER BY i), false) AS gone FROM takes),
strays AS (SELECT doc_id, line_no, CASE WHEN takes THEN token || ' ' || ltrim(next) ELSE line END AS line FROM taken WHERE NOT gone),
listed AS (
  SELECT doc_id, line_no, CASE WHEN {rx("line", P.LETTER_ITEM)} THEN regexp_replace(line, '{P.LETTER_ITEM}', '- (\\1 )')
         WHEN {rx("line", P.NUMBER_ITEM)} THEN regexp_replace(line, '{P.NUMBER_ITEM}', '1. ') ELSE line END AS line FROM strays
),
cleaned AS (SELECT doc_id, coalesce(t.text, '') AS text FROM dehyph LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM listed GROUP BY doc_id) t USING (doc_id)),
kinds AS (
  SELECT *, CASE WHEN {rx("line", P.PREAMBLE)} THEN lower(regexp_extract(line, '{P.PREAMBLE}', 1)) WHEN {rx("line", P.CHAPTER)} THEN 'bab' WHEN {rx("line", P.ARTICLE)} THEN 'pasal'
                 WHEN {rx("line", P.ELUCIDATION)} THEN 'penjelasan' WHEN {rx("line", P.ROMAN_TITLE)} THEN 'subheading' ELSE 'text' END AS kind
  FROM listed
),
promoted AS (
  SELECT doc_id, line_no, kind, CASE kind WHEN 'menimbang' THEN '## Menimbang' WHEN 'mengingat' THEN '## Mengingat'
         WHEN 'bab' THEN '## BAB ' || regexp_extract(line, '{P.CHAPTER}', 1) || regexp_extract(line, '{P.CHAPTER}', 2) WHEN 'pasal' THEN '## Pasal ' || regexp_extract(line, '{P.ARTICLE}', 1)
         WHEN 'penjelasan' THEN '## PENJELASAN' WHEN 'subheading' THEN '### ' || regexp_extract(line, '{P.ROMAN_TITLE}', 1) || '. ' || regexp_extract(line, '{P.ROMAN_TITLE}', 2) ELSE line END AS line
  FROM kinds
),
markdown AS (SELECT doc_id, coalesce(t.text, '') AS text FROM dehyph LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM promoted GROUP BY doc_id) t USING (doc_id)),
found AS (
  SELECT doc_id, coalesce(bab, 0)::BIGINT AS bab, coalesce(pasal, 0)::BIGINT AS pasal, coalesce(m1, false) AS menimbang, coalesce(m2, false) AS mengingat, coalesce(p, false) AS penjelasan FROM dehyph
  LEFT JOIN (SELECT doc_id, count(*) FILTER (kind = 'bab') AS bab, count(*) FILTER (kind = 'pasal') AS pasal, bool_or(kind = 'menimbang') AS m1, bool_or(kind = 'mengingat') AS m2, bool_or(kind = 'penjelasan') AS p
             FROM promoted GROUP BY doc_id) USING (doc_id)
)"""


def visible(c: str) -> str:
    return f"length(regexp_replace({c}, '[ \\n]', '', 'g'))"


def leaks(source: str) -> str:
    return f"(SELECT doc_id, count(*) FILTER ({rx('line', P.GAZETTE, True)} OR {footer('line')}) AS n FROM {exploded(source, 'doc_id')} GROUP BY doc_id)"


METRICS = f"""
cover AS (
  SELECT doc_id, CASE WHEN {visible("r.text")} > 0 THEN least(1.0, {visible("m.text")}::DOUBLE / {visible("r.text")}) ELSE 0.0 END AS character_coverage
  FROM merged r JOIN markdown m USING (doc_id)
),
leak AS (
  SELECT doc_id, CASE WHEN coalesce(r.n, 0) + coalesce(m.n, 0) > 0 THEN coalesce(m.n, 0)::DOUBLE / (coalesce(r.n, 0) + coalesce(m.n, 0)) ELSE 0.0 END AS leak_rate
  FROM dehyph LEFT JOIN {leaks("merged")} r USING (doc_id) LEFT JOIN {leaks("markdown")} m USING (doc_id)
),
splits AS (
  SELECT doc_id, (len(regexp_extract_all(text, '{P.SPLIT_PAREN}')) + coalesce(n, 0))::BIGINT AS split_violations FROM markdown
  LEFT JOIN (SELECT doc_id, count(*) FILTER ({rx("line", P.LONE_LETTER)} OR {rx("line", P.ANY_LONE_NUMBER)}) AS n FROM {exploded("markdown", "doc_id")} GROUP BY doc_id) USING (doc_id)
)"""

FULL = f"WITH {SQL_LEGAL}, {suppressor()}, {CLEANUP}, {METRICS}"
SINGLE = f"WITH {SQL_LEGAL}, single AS (SELECT doc_id || '-' || page_idx AS doc_id, 0 AS page_idx, text FROM legal), {suppressor('single')}, {CLEANUP}, {METRICS}"
RAW = f"WITH {SQL_LEGAL}, merged AS (SELECT doc_id, string_agg(text, chr(10) ORDER BY page_idx) AS text FROM legal GROUP BY doc_id), {CLEANUP}, {METRICS}"

REPORT = """SELECT doc_id, (SELECT count(*) FROM {pages} p WHERE p.doc_id = d.doc_id)::INTEGER AS page_count, bab, pasal, menimbang, mengingat, penjelasan, hyphens_fixed,
  (s.removed_header + f.removed_header)::BIGINT AS removed_header, (s.removed_footer + f.removed_footer)::BIGINT AS removed_footer, suppressor_overrun, character_coverage, leak_rate, split_violations
FROM dehyph d JOIN sstats s USING (doc_id) JOIN fstats f USING (doc_id) JOIN found USING (doc_id) JOIN cover USING (doc_id) JOIN leak USING (doc_id) JOIN splits USING (doc_id)"""


def suspects(source: str) -> str:
    return f"""sized AS (SELECT doc_id, page_idx, {visible("text")}::BIGINT AS visible_chars FROM {source}),
summed AS (
  SELECT doc_id, count(*)::INTEGER AS page_count, coalesce(list(page_idx ORDER BY page_idx) FILTER (visible_chars < 64), []) AS suspect_pages FROM sized GROUP BY doc_id
)"""


SUSPECTS = suspects("pages_of")

SLUG = "coalesce(nullif(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'doc')"


def slugs(name: str, key: str, source: str) -> str:
    """Numbers within a slug; the names of these tables hold no slug that equals a numbered one."""
    slug = SLUG.format(x=name)
    return f"SELECT {key}, slug, slug || CASE WHEN n > 0 THEN '-' || n ELSE '' END AS doc_id FROM (SELECT {key}, {slug} AS slug, row_number() OVER (PARTITION BY {slug} ORDER BY {key}) - 1 AS n FROM {source})"


META = f"""WITH {SQL_LEGAL}, every AS (SELECT * FROM legal UNION ALL SELECT 'raw-' || doc_id, page_idx, text FROM pages_of), {suppressor('every')}, {CLEANUP}, {METRICS}, {suspects('every')},
times AS (SELECT doc_id, 1000::BIGINT AS started_ms, (sum(length(text)) + 1000)::BIGINT AS finished_ms FROM every GROUP BY doc_id),
report AS ({REPORT.format(pages='every')}),
flat AS (
  SELECT doc_id, 'poppler' AS engine, bab, mengingat, menimbang, pasal, penjelasan, character_coverage, 1.0::DOUBLE - len(suspect_pages)::DOUBLE / s.page_count AS coverage_pages, leak_rate, split_violations,
         CASE WHEN len(suspect_pages) > 0 THEN 'tesseract_missing' END AS skipped_reason, ((finished_ms - started_ms) // s.page_count)::BIGINT AS ms, s.page_count, hyphens_fixed, removed_footer, removed_header,
         removed_lines_sample, suppressor_overrun, suspect_pages, finished_ms, started_ms
  FROM report r JOIN (SELECT doc_id, removed_lines_sample FROM sstats) USING (doc_id) JOIN summed s USING (doc_id) JOIN times USING (doc_id)
),
timed AS (SELECT *, list_transform(range(page_count), lambda x: ms) AS timing FROM flat),
parts AS (
  SELECT *, to_json({{'bab': bab, 'mengingat': mengingat, 'menimbang': menimbang, 'pasal': pasal, 'penjelasan': penjelasan}}) AS found,
         to_json({{'character_coverage': character_coverage, 'coverage_pages': coverage_pages, 'leak_rate': leak_rate, 'split_violations': split_violations}}) AS metrics,
         to_json({{'dpi': 300, 'enabled': false, 'lang': 'ind+eng', 'ocr_run_pages': []::INTEGER[], 'oem': 1, 'psm': 4, 'ran': false, 'skipped_reason': skipped_reason}}) AS ocr,
         to_json({{'hyphens_fixed': hyphens_fixed, 'removed_footer': removed_footer, 'removed_header': removed_header, 'removed_lines_sample': removed_lines_sample, 'suppressor_overrun': suppressor_overrun}}) AS stats
  FROM timed
),
texts AS (
  SELECT *, '{{"doc_id":"' || doc_id || '","engine":"poppler","found":' || found || ',' AS a,
         '"metrics":' || metrics || ',"ocr":' || ocr || ',"p95_latency_ms_per_page":' || ms || ',"page_count":' || page_count || ',"stats":' || stats
         || ',"suspect_pages":' || to_json(suspect_pages) AS b, ',"timing_ms_per_page":' || to_json(timing) || '}}' AS c
  FROM parts
),
signed AS (SELECT *, sha256(a || b || c) AS meta_fingerprint FROM texts)"""

TRUTH = "truth AS (SELECT doc_id, count(*)::BIGINT AS want_bab, ((count(*) + 1) // 2)::BIGINT AS want_pasal FROM pages_of GROUP BY doc_id)"

SQL = {
    "document_report": f"{FULL} {REPORT.format(pages='legal')}",
    "single_page_report": f"{SINGLE} {REPORT.format(pages='single')}",
    "page_lines": f"WITH {SQL_LEGAL} SELECT doc_id, page_idx, line_idx::INTEGER AS line_idx, n_lines::INTEGER AS n_lines, line FROM {exploded('legal', 'doc_id, page_idx')}",
    "document_lines": f"SELECT doc_id, line_idx::INTEGER AS line_idx, n_lines::INTEGER AS n_lines, line FROM {exploded('documents', 'doc_id')}",
    "suspect_pages": f"WITH {SQL_PAGES}, {SUSPECTS} SELECT doc_id, page_idx, visible_chars FROM sized WHERE visible_chars < 64",
    "suspect_summary": f"WITH {SQL_PAGES}, {SUSPECTS} SELECT doc_id, page_count, suspect_pages, 1.0 - len(suspect_pages)::DOUBLE / page_count AS coverage_pages FROM summed",
    "suspect_sample": f"WITH {SQL_PAGES}, {SUSPECTS} SELECT doc_id, list_slice(suspect_pages, 1, 1) AS suspect_pages, 1.0 - least(1, len(suspect_pages))::DOUBLE / page_count AS coverage_pages FROM summed",
    "merge_overrides": f"""WITH {SQL_PAGES}, ov AS (SELECT doc_id, page_idx, 'OCR ' || b.text AS text FROM pages_of p JOIN benchmark b ON b.item_id = p.page_idx WHERE {visible("p.text")} < 64)
        SELECT doc_id, string_agg(coalesce(o.text, p.text), chr(10) ORDER BY page_idx) AS text FROM pages_of p LEFT JOIN ov o USING (doc_id, page_idx) GROUP BY doc_id""",
    "formfeed_pages": f"""WITH {SQL_PAGES}, joined AS (SELECT doc_id, string_agg(CASE WHEN page_idx % 3 = 1 THEN ' ' ELSE text END, chr(12) ORDER BY page_idx) || chr(12) || ' ' || chr(12) AS text FROM pages_of GROUP BY doc_id),
        parts AS (SELECT doc_id, unnest(string_split(text, chr(12))) AS text, unnest(generate_series(0, len(string_split(text, chr(12))) - 1)) AS page_idx FROM joined),
        ends AS (SELECT *, max(CASE WHEN trim(text) <> '' THEN page_idx END) OVER (PARTITION BY doc_id) AS last FROM parts)
        SELECT doc_id, page_idx::INTEGER AS page_idx, text FROM ends WHERE page_idx <= last""",
    "repeated_line_freq": f"{FULL} SELECT doc_id, norm, c::BIGINT AS c, t::BIGINT AS t, b::BIGINT AS b FROM freq",
    "document_line_freq": f"""SELECT doc_id, regexp_replace(trim(line), '\\s+', ' ', 'g') AS norm, count(*)::BIGINT AS c, (count(*) FILTER (line_idx = 0))::BIGINT AS t, (count(*) FILTER (line_idx = n_lines - 1))::BIGINT AS b
        FROM {exploded('documents', 'doc_id')} WHERE trim(line) <> '' AND NOT {heading("trim(line)")} GROUP BY ALL""",
    "repeated_line_candidates": f"{FULL} SELECT doc_id, norm FROM cand",
    "candidate_lists": f"{FULL} SELECT doc_id, list(norm ORDER BY norm) AS candidates FROM cand GROUP BY doc_id",
    "line_classes": f"{FULL} SELECT doc_id, page_idx, line_idx::INTEGER AS line_idx, line, class, drop, drop_rank, kept FROM kept",
    "suppressed_pages": f"{FULL} SELECT doc_id, page_idx, text FROM spages",
    "suppressor_stats": f"{FULL} SELECT * FROM sstats",
    "keep_lines_rescue": f"WITH {SQL_LEGAL}, {suppressor(keep='^- [0-9]|^kaki')} SELECT doc_id, page_idx, text, removed_header, removed_footer, suppressor_overrun FROM spages JOIN sstats USING (doc_id)",
    "dehyphenate": f"{FULL} SELECT doc_id, hyphens_fixed, text FROM dehyph",
    "header_footer_drop": f"{RAW} SELECT doc_id, removed_header, removed_footer FROM fstats",
    "soft_wrap": f"{FULL} SELECT doc_id, line_no, line FROM soft",
    "orphan_merge": f"{FULL} SELECT doc_id, line_no, line FROM strays",
    "list_normalise": f"{FULL} SELECT doc_id, line_no, line FROM listed",
    "cleanup_full": f"{FULL} SELECT doc_id, text AS cleaned, hyphens_fixed, removed_header, removed_footer FROM cleaned JOIN fstats USING (doc_id) JOIN (SELECT doc_id, hyphens_fixed FROM dehyph) USING (doc_id)",
    "heading_promote": f"{FULL} SELECT doc_id, line_no, kind, line FROM promoted",
    "structure_counts": f"{FULL} SELECT * FROM found",
    "markdown_counts": f"{FULL} SELECT doc_id, (count(*) FILTER ({rx('line', P.MD_CHAPTER)}))::BIGINT AS bab, (count(*) FILTER ({rx('line', P.MD_ARTICLE)}))::BIGINT AS pasal FROM promoted GROUP BY doc_id",
    "coverage": f"{RAW} SELECT * FROM cover",
    "leak_rate": f"{RAW} SELECT * FROM leak",
    "split_violations": f"{RAW} SELECT * FROM splits",
    "latency": """SELECT user_id, count(*)::BIGINT AS n_pages, (sum(ms) // count(*))::BIGINT AS mean_ms, quantile_cont(ms::DOUBLE, 0.95) AS true_p95_ms, sum(ms)::BIGINT AS total_ms
        FROM (SELECT user_id, floor(value)::BIGINT AS ms FROM events) GROUP BY user_id""",
    "url_slugs": slugs("regexp_replace(regexp_extract(url, '[^/]*$'), '(\\.pdf)+$', '')", "page_id", "pages"),
    "source_slugs": slugs("source || ' ' || lang || '.PDF'", "doc_id", "documents").replace("AS doc_id", "AS unique_slug"),
    "fingerprint": f"{META} SELECT doc_id, meta_fingerprint FROM signed",
    "document_metadata": META
    + """ SELECT doc_id, a || '"meta_fingerprint":"' || meta_fingerprint || '",' || b || ',"timestamps":{"finished_ms":' || finished_ms || ',"started_ms":' || started_ms || '}' || c AS meta_json FROM signed""",
    "meta_read": META
    + """ SELECT doc_id, engine, meta_fingerprint, ms AS p95_latency_ms_per_page, page_count, suspect_pages, timing AS timing_ms_per_page, bab AS found_bab, mengingat AS found_mengingat, menimbang AS found_menimbang,
        pasal AS found_pasal, penjelasan AS found_penjelasan, character_coverage AS metrics_character_coverage, coverage_pages AS metrics_coverage_pages, leak_rate AS metrics_leak_rate, split_violations AS metrics_split_violations,
        300 AS ocr_dpi, false AS ocr_enabled, 'ind+eng' AS ocr_lang, []::INTEGER[] AS ocr_ocr_run_pages, 1 AS ocr_oem, 4 AS ocr_psm, false AS ocr_ran, skipped_reason AS ocr_skipped_reason,
        hyphens_fixed AS stats_hyphens_fixed, removed_footer AS stats_removed_footer, removed_header AS stats_removed_header, removed_lines_sample AS stats_removed_lines_sample, suppressor_overrun AS stats_suppressor_overrun,
        finished_ms AS timestamps_finished_ms, started_ms AS timestamps_started_ms FROM signed""",
    "extracted_files": f"""WITH {SQL_PAGES}, cut AS (SELECT doc_id, page_idx, text, max(CASE WHEN trim(text) <> '' THEN page_idx END) OVER (PARTITION BY doc_id) AS last FROM pages_of)
        SELECT 'file-no-' || doc_id AS doc_id, page_idx, text, NULL::VARCHAR AS error FROM cut WHERE page_idx <= last AND doc_id::BIGINT % 9 <> 0
        UNION ALL SELECT DISTINCT 'file-no-' || doc_id, NULL::INTEGER, NULL, NULL FROM cut WHERE last IS NULL OR doc_id::BIGINT % 9 = 0""",
    "recognised_pages": f"""WITH {SQL_PAGES}, asked AS (SELECT doc_id, page_idx FROM pages_of WHERE {visible("text")} < 200)
        SELECT doc_id, page_idx, CASE page_idx % 5 WHEN 0 THEN doc_id || '/' || page_idx || ' ind 4' WHEN 1 THEN doc_id || '/' || page_idx || ' ind+eng 6' END AS text,
               CASE page_idx % 5 WHEN 2 THEN 'empty_text;empty_text;empty_text' WHEN 3 THEN 'tesseract_exit_1;tesseract_exit_1;tesseract_exit_1' WHEN 4 THEN 'image_missing' END AS error, false AS skipped FROM asked""",
    "markdown_digest": f"{FULL} SELECT doc_id, sha256(text) AS markdown_sha256 FROM markdown",
    "ground_truth_report": f"""{FULL}, {TRUTH}, right_ AS (SELECT *, CASE WHEN want_pasal = 0 THEN CASE WHEN pasal = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 - abs(pasal - want_pasal)::DOUBLE / want_pasal END AS accuracy FROM found JOIN truth USING (doc_id))
        SELECT doc_id, bab, pasal, want_bab, want_pasal, bab = want_bab AND pasal = want_pasal AS exact, accuracy, accuracy >= 0.98 AS reaches_goal, CASE WHEN bab = want_bab AND pasal = want_pasal THEN 'PASS' ELSE 'FAIL' END AS status FROM right_""",
    "ground_truth_overall": f"""{FULL}, {TRUTH} SELECT count(*)::BIGINT AS documents, (count(*) FILTER (bab <> want_bab OR pasal <> want_pasal))::BIGINT AS failures,
        CASE WHEN count(*) FILTER (bab <> want_bab OR pasal <> want_pasal) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM found JOIN truth USING (doc_id)""",
    "ground_truth_skipped": f"WITH {SQL_PAGES} SELECT DISTINCT CAST(doc_id AS VARCHAR) AS doc_id FROM labels WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT doc_id FROM pages_of)",
    "idempotency": f"{FULL} SELECT doc_id, sha256(text) AS markdown_sha256, true AS equal FROM markdown",
    "strict_check": f"{FULL} SELECT doc_id, bab, pasal, bab = 0 OR pasal = 0 AS violates FROM found",
    "ocr_decision": f"""WITH {SQL_PAGES}, {SUSPECTS}, flags AS (SELECT e, f FROM (SELECT unnest([true, false]) AS e) a, (SELECT unnest([NULL, true, false]) AS f) b)
        SELECT doc_id, e AS enabled, f AS forced, len(suspect_pages)::INTEGER AS suspects, coalesce(f, len(suspect_pages) > 0) AS requested, e AND coalesce(f, len(suspect_pages) > 0) AND len(suspect_pages) > 0 AS ran,
               CASE WHEN len(suspect_pages) = 0 THEN NULL WHEN NOT e THEN 'tesseract_missing' WHEN f IS NOT DISTINCT FROM false THEN 'disabled_by_flag' END AS skipped_reason
        FROM summed CROSS JOIN flags""",
    "ground_truth_parse": """SELECT regexp_extract(value, '^\\s*([^: ]+):', 1) AS doc_id, coalesce(try_cast(regexp_extract(value, 'bab:\\s*([0-9]+)', 1) AS BIGINT), 0) AS bab, coalesce(try_cast(regexp_extract(value, 'pasal:\\s*([0-9]+)', 1) AS BIGINT), 0) AS pasal
        FROM (SELECT source || '-' || doc_id || ': { bab: ' || n_chars || CASE WHEN doc_id % 3 = 0 THEN '' ELSE ', pasal: ' || doc_id END || ' }' AS value FROM documents UNION ALL SELECT '# comment' UNION ALL SELECT '')
        WHERE NOT starts_with(value, '#') AND value <> '' AND regexp_extract(value, '^\\s*([^: ]+):', 1) <> ''""",
    "ground_truth_lines": FULL
    + f" SELECT doc_id, doc_id || ': {{ bab: ' || count(*) FILTER ({rx('line', P.MD_CHAPTER)}) || ', pasal: ' || count(*) FILTER ({rx('line', P.MD_ARTICLE)}) || ' }}' AS value FROM promoted GROUP BY doc_id",
    "acceptance_report": f"""{FULL}, {SUSPECTS}, covered AS (SELECT *, 1.0 - len(suspect_pages)::DOUBLE / page_count AS share FROM summed)
        SELECT doc_id, page_count AS pages, len(suspect_pages)::INTEGER AS suspect, 0 AS ocr_run, share AS coverage_pages, 0::BIGINT AS p95_ms_per_page, leak_rate AS leak, split_violations AS split, 'NA' AS cache_hit_txt, 'NA' AS cache_hit_img,
               CASE WHEN len(suspect_pages) > 0 THEN 'OCRNoRunPages,CoveragePagesLow' ELSE '' END AS reasons, CASE WHEN len(suspect_pages) > 0 THEN 'FAIL' ELSE 'PASS' END AS status
        FROM covered JOIN leak USING (doc_id) JOIN splits USING (doc_id)""",
    "stream_structure_counts": f"{FULL} SELECT * FROM found",
}
