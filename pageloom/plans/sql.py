"""The queries once more, in another engine's SQL, written against the same rules and not against the frames."""

from __future__ import annotations

from .inputs import CONVERSATIONS, FORMS, OCR, PAGES, SIGNALS, VISION

# The other engine's pattern dialect: no (?d), white space spelt out.
W = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
N = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]"
MARKER = rf"(?i)\bDOCUMENT{W}+\d+{W}+OF{W}+\d+\b"
PAGE = rf"(?i)Page{W}+(\d+){W}+of{W}+(\d+)"
PAGE_ONE = rf"(?i)\bPage{W}*1{W}*of{W}*\d+\b"
PHONE = rf"[+(]?\d(?:\d|{W}|[-().]){{7,}}\d"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, '{pattern}')"


def sub(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"


def strip(x: str) -> str:
    return sub(x, f"^{W}+|{W}+$", "")


def lines(x: str) -> str:
    split = rf"regexp_split_to_array({x}, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]')"
    return f"list_filter(list_transform({split}, lambda l: {strip('l')}), lambda l: l <> '')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{W}+'), lambda w: w <> '')"


def digits(x: str) -> str:
    return sub(x, r"\P{Nd}", "")


def filename(x: str) -> str:
    return f"""coalesce(nullif({sub(strip(sub(x, r'[<>:"/\\|?*]+', '')), f'{W}+', ' ')}, ''), 'Untitled')"""


def sane(x: str) -> str:
    kept = strip(sub(x, r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{No}_\s\x0b\x1c-\x1f\x{85}\p{Z}\x{200c}\x{200d}\p{Pc}-]", ""))
    return f"coalesce(nullif({sub(sub(kept, f'{W}+', '_'), '^_+|_+$', '')}, ''), 'Untitled')"


def titled(x: str) -> str:
    return f"list_aggregate(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|\\P{{L}}+)'), lambda c: upper(left(c, 1)) || lower(substr(c, 2))), 'string_agg', '')"


def meaningful(x: str) -> str:
    return f"({x} <> '' AND NOT {has(x, rf'(?i)^Page{W}+\d+$')} AND NOT {has(x, MARKER)} AND NOT starts_with(lower({x}), 'non-authoritative copy'))"


def marker_title(after: str, every: str, fallback: str) -> str:
    c = f"coalesce(list_filter({after}, lambda m: {meaningful('m')})[1], list_filter({every}, lambda m: {meaningful('m')})[1])"
    return f"coalesce({filename(f'CASE WHEN {c} = upper({c}) AND {c} <> lower({c}) THEN {titled(c)} ELSE {c} END')} || CASE WHEN {c} IS NULL THEN NULL ELSE '' END, {fallback})"


def could_be(s: str, least: int, most: int) -> str:
    skip = rf"(?i)FORM{W}+NO\.|[:(#@©()]|\b(?:LLC|INC|CORP|LTD|INCORPORATED)\b"
    return (
        f"length({s}) BETWEEN 4 AND 60 AND NOT ends_with({s}, '.') AND NOT {has(s, r'[^\x00-\x7F]')} AND len({words(s)}) BETWEEN {least} AND {most} AND NOT {has(s, rf'^\d+(?:{W}|$)')}"
        f" AND len(list_filter({words(s)}, lambda w: length(regexp_replace(w, '[^A-Za-z]', '', 'g')) >= 3)) > 0 AND length({digits(s)}) < 7 AND NOT {has(s, skip)} AND NOT {has(s, rf'^(?:[A-Za-z]|\d+)\.{W}')} AND NOT {has(s, MARKER)}"
    )


def text_title(lines_: str, last: bool) -> str:
    head = f"list_transform({lines_}[1:greatest(len({lines_}) // 2, 10)], lambda q: {strip(sub('q', '[*]+$', ''))})"
    caps = f"list_filter({head}, lambda z: z = upper(z) AND {has('z', '[A-Za-z]')} AND {could_be('z', 3, 8)})"
    six = f"list_transform({lines_}[1:6], lambda q: {strip(sub('q', '[*]+$', ''))})"
    loud = f"len(list_filter({words('z')}, lambda w: w = upper(w) AND length(regexp_replace(w, '[^A-Za-z]', '', 'g')) >= 3)) = 0"
    small = f"len(list_filter({words('z')}, lambda w: {has('w', '^[a-z]')})) = 0"
    named = f"list_filter({six}, lambda z: z <> upper(z) AND {could_be('z', 2, 4)} AND {loud} AND {small})"
    found = f"coalesce({caps}[{-1 if last else 1}], {named}[1])"
    return f"CASE WHEN {found} IS NOT NULL THEN {filename(found)} END"


def content(x: str) -> str:
    return f"CASE WHEN {has(x, rf'(?i)\bDT{W}*\d')} AND {has(x, rf'(?i)INCOMPLETE{W}+APPLICATIONS{W}+WILL{W}+NOT{W}+BE{W}+PROCESSED')} THEN 'Credit Application' END"


LINED = f"lined AS (SELECT pdf_id, page_idx, text, {lines('text')} AS l FROM pages_src)"
MARKED = f"""marked AS (SELECT *, coalesce(list_position(list_transform(l, lambda x: {has("x", MARKER)}), true), 0) AS k FROM lined)"""
FOOT = f"""foot AS (SELECT *, list_filter(list_transform(list_filter(l, lambda x: {has("x", PAGE)}), lambda x: [CAST(regexp_extract(x, '{PAGE}', 1) AS INT), CAST(regexp_extract(x, '{PAGE}', 2) AS INT)]), lambda y: y[1] >= 1)[1] AS f FROM marked)"""
TEXT_SIGNALS = f"""raw AS (SELECT pdf_id, page_idx, f, {has("text", MARKER)} AS is_marked, nullif({marker_title("l[k + 1:]", "l", "''")}, '') AS marker_title, {content("text")} AS inferred, {text_title("l", False)} AS first_title, {text_title("l", True)} AS last_title FROM foot),
sig AS (SELECT pdf_id, page_idx,
 CASE WHEN is_marked THEN 'NEW_DOC' WHEN f[1] > 1 THEN 'CONTINUATION' WHEN f[1] = 1 OR inferred IS NOT NULL OR first_title IS NOT NULL THEN 'NEW_DOC' ELSE 'AMBIGUOUS' END AS classification,
 CASE WHEN is_marked THEN marker_title WHEN f[1] > 1 THEN NULL WHEN f[1] = 1 THEN last_title ELSE coalesce(inferred, first_title) END AS title_text,
 CASE WHEN is_marked THEN 1 ELSE f[1] END AS page_num_in_doc,
 CASE WHEN is_marked THEN NULL WHEN f[1] > 1 THEN f[2] WHEN f[2] > 1 THEN f[2] END AS total_pages_in_doc FROM raw)"""


def grouped(source: str) -> str:
    return f"""flag AS (SELECT *, lag(CASE WHEN classification <> 'AMBIGUOUS' THEN total_pages_in_doc END) OVER w AS before, row_number() OVER w AS rn,
 coalesce(max(CASE WHEN classification <> 'AMBIGUOUS' THEN 1 ELSE 0 END) OVER (PARTITION BY pdf_id ORDER BY page_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS anchored FROM {source} WINDOW w AS (PARTITION BY pdf_id ORDER BY page_idx)),
started AS (SELECT *, CASE WHEN rn = 1 THEN 1 WHEN classification = 'NEW_DOC' THEN anchored WHEN classification = 'CONTINUATION' AND before <> total_pages_in_doc THEN 1 ELSE 0 END AS is_start FROM flag),
grouped AS (SELECT *, CAST(sum(is_start) OVER (PARTITION BY pdf_id ORDER BY page_idx ROWS UNBOUNDED PRECEDING) AS INT) AS group_no FROM started),
summed AS (SELECT pdf_id, group_no, CAST(min(page_idx) + 1 AS INT) AS start_page, CAST(max(page_idx) + 1 AS INT) AS end_page, count(*) AS n_pages, arg_min(title_text, page_idx) FILTER (WHERE title_text <> '') AS raw_title FROM grouped GROUP BY pdf_id, group_no),
based AS (SELECT *, CASE WHEN raw_title IS NOT NULL THEN {sane("raw_title")} WHEN end_page > start_page THEN 'pages_' || start_page || '-' || end_page ELSE 'page_' || start_page END AS base_name FROM summed),
named AS (SELECT *, CAST(row_number() OVER (PARTITION BY pdf_id, base_name ORDER BY group_no) AS INT) AS dup_no FROM based),
made AS (SELECT *, base_name || CASE WHEN dup_no > 1 THEN ' (' || dup_no || ')' ELSE '' END || '.pdf' AS file_name FROM named)"""


STARTS = f"""flagged AS (SELECT pdf_id, page_idx, text, {has("text", MARKER)} AS m, {has("text", PAGE_ONE)} AS o FROM pages_src),
starts AS (SELECT *, CASE WHEN bool_or(m) OVER (PARTITION BY pdf_id) THEN m ELSE o OR page_idx = min(page_idx) OVER (PARTITION BY pdf_id) END AS is_start FROM flagged)"""
SEGMENTS = f"""seg AS (SELECT *, sum(CAST(is_start AS INT)) OVER (PARTITION BY pdf_id ORDER BY page_idx ROWS UNBOUNDED PRECEDING) AS segment FROM starts),
cut AS (SELECT pdf_id, segment, CAST(min(page_idx) AS INT) AS start_page, CAST(max(page_idx) + 1 AS INT) AS end_page, arg_min(text, page_idx) AS first FROM seg WHERE segment > 0 GROUP BY pdf_id, segment HAVING bool_or({strip("text")} <> '')),
nth AS (SELECT *, CAST(row_number() OVER (PARTITION BY pdf_id ORDER BY segment) AS INT) AS document_no, {lines("first")} AS l FROM cut),
based AS (SELECT *, {marker_title("l", "l", "'Document ' || document_no")} AS base_name FROM nth),
named AS (SELECT *, CAST(row_number() OVER (PARTITION BY pdf_id, base_name ORDER BY segment) AS INT) AS dup_no FROM based)"""

SCORED = f"""stripped AS (SELECT page, line_no, strip, text, {strip("text")} AS s, height FROM ocr_src),
scored AS (SELECT *, CASE WHEN length(s) BETWEEN 4 AND 60 AND NOT {has("s", "[:(#@]")} AND length({digits("s")}) < 7 AND len({words("s")}) <= 8 AND len(list_filter({words("s")}, lambda w: length(w) > 2 AND w = lower(w) AND w <> upper(w))) < 2
 THEN height * CASE WHEN len({words("s")}) >= 2 THEN 2.0::DOUBLE ELSE 0.3::DOUBLE END END AS score FROM stripped)"""
FEET = rf"""feet AS (SELECT page, line_no, CAST(regexp_extract(text, '{PAGE}', 1) AS INT) AS n, CAST(regexp_extract(text, '{PAGE}', 2) AS INT) AS m FROM ocr_src WHERE strip = 'bottom' AND {has("text", PAGE)})"""

_RO_LINE = strip(rf"regexp_extract(text, '(?i)Credit Application:{W}*Applicant{W}*\n(.+)', 1)")
_RO_PARTS = words(f"regexp_replace({_RO_LINE}, '(?i)^(?:Mrs?|Miss|Ms|Dr)\\.?{W}*', '')")


def phones(raw: str) -> str:
    return f"list_transform(list_filter({raw}, lambda x, i: length({digits('x')}) >= 10 AND list_position(list_transform({raw}, lambda y: {digits('y')}), {digits('x')}) = i), lambda x: {strip('x')})"


RO_PHONES = phones(f"list_transform(regexp_split_to_array(regexp_extract(text, '(?is)at the following telephone number\\(s\\):{W}*(.+?)\\.', 1), '[,;]'), lambda p: {strip('p')})")
RO_CONSENT = rf"CASE WHEN {has(f"regexp_extract(text, '(?is)Optional Consent.*?Applicant:{W}*By{W}+Date(.*?)(?:Source:|$)', 1)", r'\d{1,2}/\d{1,2}/\d{4}')} THEN 'opted_in' ELSE 'opted_out' END"
DT_NAME = rf"(?m)^([A-Z]{{2,}}){W}+([A-Z]{{2,}}){W}+\d{{3}}-\d{{2}}-\d{{4}}"
DT_PHONES = phones(f"regexp_extract_all(regexp_extract(text, '(?is)at the following number\\(s\\)(.*?)(?:including any cell phone numbers|You understand)', 1), '{PHONE}')")
KIND = f"CASE WHEN {has('text', '(?i)RouteOne')} THEN 'routeone' WHEN {has('text', rf'(?i)\bDT{W}*\d')} THEN 'dealertrack' ELSE 'unknown' END"
RECORDS = f"""fields AS (SELECT f.*, {KIND} AS form_type, CASE WHEN len({_RO_PARTS}) >= 2 THEN {_RO_PARTS}[1] END AS ro_last, CASE WHEN len({_RO_PARTS}) >= 2 THEN {_RO_PARTS}[2] END AS ro_first, {RO_PHONES} AS ro_phones, {RO_CONSENT} AS ro_consent,
 nullif(regexp_extract(text, '{DT_NAME}', 1), '') AS dt_last, nullif(regexp_extract(text, '{DT_NAME}', 2), '') AS dt_first, {DT_PHONES} AS dt_phones,
 CASE WHEN json_valid(v.answer) THEN v.answer END AS a FROM forms f LEFT JOIN vision v USING (source_file)),
mode AS (SELECT *, CASE WHEN form_type = 'routeone' AND text_heavy THEN 'r' WHEN form_type = 'dealertrack' AND text_heavy THEN 'd' ELSE 'v' END AS m, json_extract_string(a, '$.opt_in_status') AS v_status, json_extract_string(a, '$.confidence') AS v_confidence FROM fields),
records AS (SELECT form_type, source_file,
 CASE m WHEN 'r' THEN ro_last WHEN 'd' THEN dt_last ELSE json_extract_string(a, '$.last_name') END AS last_name, CASE m WHEN 'r' THEN ro_first WHEN 'd' THEN dt_first ELSE json_extract_string(a, '$.first_name') END AS first_name,
 CASE WHEN m = 'r' THEN ro_consent WHEN m = 'd' AND checkbox_page IS NULL THEN 'not_found' ELSE coalesce(v_status, 'unclear') END AS opt_in_status,
 CASE m WHEN 'r' THEN ro_phones WHEN 'd' THEN dt_phones ELSE coalesce(CAST(CASE WHEN json_type(a, '$.telemarketing_phones') = 'ARRAY' THEN json_extract(a, '$.telemarketing_phones') END AS VARCHAR[]), []) END AS phones,
 CASE WHEN m = 'r' THEN 'high' WHEN m = 'd' AND checkbox_page IS NULL THEN 'low' WHEN m = 'd' THEN coalesce(v_confidence, 'medium') ELSE coalesce(v_confidence, 'low') END AS confidence FROM mode)"""


def q(*parts: str) -> str:
    return f"WITH {', '.join(parts[:-1])} {parts[-1]}" if len(parts) > 1 else parts[0]


_NAME = "(' ' || p_name || CASE p_partkey % 4 WHEN 0 THEN ' : <a|b>? ' WHEN 1 THEN chr(9) || ' x' || chr(10) ELSE '' END)"
_LOUD = "(upper(p_name) || ' O''NEIL 2ND')"
_PATH = "(split_part(url, '://', 2) || CASE page_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PDF' ELSE '.txt' END)"
_STEM = r"regexp_extract(path, '([^/]+?)(\.[^./]+)?$', 1)"
_JOINED = "string_agg(text, chr(10) || chr(10) ORDER BY page_idx) FILTER (WHERE text <> '')"

ORACLE_SQL: dict[str, str] = {
    "page_lines": f"SELECT doc_id, len(l) AS n_lines, coalesce(l[1], '') AS first_line, coalesce(length(list_aggregate(l, 'string_agg', '')), 0) AS n_chars FROM (SELECT doc_id, {lines("coalesce(text, '')")} AS l FROM documents)",
    "strip_len_route": f"SELECT doc_id, length({strip("coalesce(text, '')")}) AS n_stripped, length({strip("coalesce(text, '')")}) < 50 AS is_image FROM documents",
    "doc_marker_pages": q(PAGES, f"SELECT pdf_id, page_idx FROM pages_src WHERE {has('text', MARKER)}"),
    "page_n_of_m": q(PAGES, LINED, f"x AS (SELECT pdf_id, page_idx, list_filter(l, lambda x: {has('x', PAGE)})[1] AS h FROM lined)", f"SELECT pdf_id, page_idx, CAST(regexp_extract(h, '{PAGE}', 1) AS INT) AS page_num, CAST(regexp_extract(h, '{PAGE}', 2) AS INT) AS total FROM x WHERE h IS NOT NULL"),
    "meaningful_lines": q(PAGES, LINED, f"SELECT pdf_id, page_idx, coalesce(list_aggregate(list_filter(l, lambda x: {meaningful('x')}), 'string_agg', '|'), '') AS lines FROM lined"),
    "title_first": q(PAGES, LINED, f"SELECT pdf_id, page_idx, {text_title('l', False)} AS title FROM lined"),
    "title_last": q(PAGES, LINED, f"SELECT pdf_id, page_idx, {text_title('l', True)} AS title FROM lined"),
    "marker_titles": q(PAGES, LINED, MARKED, f"SELECT pdf_id, page_idx, {marker_title('l[k + 1:]', 'l', chr(39) + 'none' + chr(39))} AS title FROM marked"),
    "text_page_signals": q(PAGES, LINED, MARKED, FOOT, TEXT_SIGNALS, "SELECT * FROM sig"),
    "group_pages": q(SIGNALS, grouped("signals_src"), "SELECT pdf_id, page_idx, group_no FROM grouped"),
    "group_summary": q(SIGNALS, grouped("signals_src"), "SELECT pdf_id, group_no, start_page, end_page, n_pages, raw_title, base_name, dup_no, file_name FROM made"),
    "group_members": q(SIGNALS, grouped("signals_src"), "SELECT pdf_id, group_no, string_agg(CAST(page_idx AS VARCHAR), ',' ORDER BY page_idx) AS page_idxs FROM grouped GROUP BY pdf_id, group_no"),
    "split_manifest": q(PAGES, LINED, MARKED, FOOT, TEXT_SIGNALS, grouped("sig"), "SELECT pdf_id, group_no, start_page, end_page, n_pages, raw_title, file_name FROM made"),
    "legacy_starts": q(PAGES, STARTS, "SELECT pdf_id, page_idx FROM starts WHERE is_start"),
    "legacy_segments": q(PAGES, STARTS, SEGMENTS, "SELECT pdf_id, document_no, start_page, end_page, base_name, dup_no, base_name || CASE WHEN dup_no > 1 THEN ' (' || dup_no || ')' ELSE '' END || '.pdf' AS file_name FROM named"),
    "ocr_flatten": q(OCR, "SELECT page, coalesce(string_agg(text, '|' ORDER BY line_no) FILTER (WHERE strip = 'bottom'), '') AS bottom, coalesce(string_agg(text, '|' ORDER BY line_no) FILTER (WHERE strip = 'top'), '') AS top FROM ocr_src GROUP BY page"),
    "ocr_best_title": q(OCR, SCORED, "SELECT page, s AS title, score FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY score DESC, line_no) AS k FROM scored WHERE strip = 'top' AND score >= 50) WHERE k = 1"),
    "image_page_signals": q(
        OCR, SCORED, FEET,
        "more AS (SELECT page, arg_min([n, m], line_no) AS f FROM feet WHERE n > 1 GROUP BY page)", "total AS (SELECT page, arg_max(m, line_no) AS t FROM feet WHERE n = 1 AND m > 1 GROUP BY page)",
        "best AS (SELECT page, s FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY score DESC, line_no) AS k FROM scored WHERE strip = 'top' AND score >= 50) WHERE k = 1)",
        "joined AS (SELECT page, coalesce(string_agg(text, ' ' ORDER BY strip, line_no), '') AS text FROM ocr_src GROUP BY page)",
        f"x AS (SELECT page, f, t, s, {content('text')} AS c, page % 17 <> 0 AS seen FROM joined LEFT JOIN more USING (page) LEFT JOIN total USING (page) LEFT JOIN best USING (page))",
        """SELECT page, CASE WHEN NOT seen THEN 'AMBIGUOUS' WHEN f IS NOT NULL THEN 'CONTINUATION' WHEN c IS NOT NULL OR s IS NOT NULL OR t IS NOT NULL THEN 'NEW_DOC' ELSE 'AMBIGUOUS' END AS classification,
 CASE WHEN seen AND f IS NULL THEN coalesce(c, s) END AS title_text, CASE WHEN NOT seen THEN NULL WHEN f IS NOT NULL THEN f[1] WHEN t IS NOT NULL THEN 1 END AS page_num_in_doc, CASE WHEN NOT seen THEN NULL WHEN f IS NOT NULL THEN f[2] ELSE t END AS total_pages_in_doc FROM x""",
    ),
    "sanitize_filename": f"SELECT p_partkey, {filename(_NAME)} AS name, 'Untitled' AS nothing FROM part",
    "sanitize_title": f"SELECT doc_id, {sane("coalesce(text, '')")} AS title FROM documents",
    "title_case": f"SELECT p_partkey, {titled(_LOUD)} AS title, {_LOUD} = upper({_LOUD}) AND {_LOUD} <> lower({_LOUD}) AS is_upper, p_name = upper(p_name) AND p_name <> lower(p_name) AS name_is_upper, false AS no_letter FROM part",
    "whole_documents": q(CONVERSATIONS, f"d AS (SELECT pdf_id, count(*) AS page_count, coalesce({_JOINED}, '') AS c, string_agg(coalesce(text, ''), chr(10) ORDER BY page_idx) AS a, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS total_chars FROM conv_src GROUP BY pdf_id)", "SELECT pdf_id, page_count, length(c) AS combined_len, md5(c) AS combined_md5, length(a) AS all_len, md5(a) AS all_md5, total_chars, total_chars >= 50 * page_count AS text_heavy FROM d"),
    "first_page_with": q(CONVERSATIONS, "SELECT pdf_id, min(page_idx) FILTER (WHERE contains(text, 'the')) AS first_page FROM conv_src GROUP BY pdf_id"),
    "document_json": q(CONVERSATIONS, f"SELECT CAST(pdf_id AS VARCHAR) AS source_path, count(*) AS page_count, md5(coalesce({_JOINED}, '')) AS combined_md5, min(page_idx) + 1 AS first_page FROM conv_src GROUP BY pdf_id"),
    "metadata": "SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN 3 ELSE 0 END::BIGINT AS n, CASE WHEN p_partkey % 3 <> 0 THEN p_name END AS title, CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS type, CASE WHEN p_partkey % 3 <> 0 AND p_size > 10 THEN CAST(p_size AS VARCHAR) END AS size FROM part",
    "form_types": q(FORMS, f"SELECT c_custkey, {KIND} AS form_type, text_heavy, checkbox_page FROM forms"),
    "routeone_fields": q(FORMS, f"SELECT c_custkey, CASE WHEN len({_RO_PARTS}) >= 2 THEN {_RO_PARTS}[1] END AS last_name, CASE WHEN len({_RO_PARTS}) >= 2 THEN {_RO_PARTS}[2] END AS first_name, coalesce(list_aggregate({RO_PHONES}, 'string_agg', '|'), '') AS phones, {RO_CONSENT} AS consent FROM forms"),
    "dealertrack_fields": q(FORMS, f"SELECT c_custkey, nullif(regexp_extract(text, '{DT_NAME}', 1), '') AS last_name, nullif(regexp_extract(text, '{DT_NAME}', 2), '') AS first_name, coalesce(list_aggregate({DT_PHONES}, 'string_agg', '|'), '') AS phones FROM forms"),
    "unique_phones": f"SELECT doc_id, coalesce(list_aggregate({phones('r')}, 'string_agg', '|'), '') AS phones FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{PHONE}') AS r FROM documents)",
    "credit_app_records": q(FORMS, VISION, RECORDS, "SELECT form_type, last_name, first_name, opt_in_status, coalesce(list_aggregate(phones, 'string_agg', '|'), '') AS telemarketing_phones, confidence, source_file FROM records"),
    "opt_in_sheet": q(FORMS, VISION, RECORDS, "SELECT coalesce(last_name, '') AS last_name, coalesce(first_name, '') AS first_name, coalesce(phones[1], '') AS phone_1, coalesce(phones[2], '') AS phone_2, coalesce(phones[3], '') AS phone_3, opt_in_status AS consent, source_file FROM records"),
    "vision_requests": q(FORMS, f"k AS (SELECT *, {KIND} AS kind FROM forms)", "SELECT source_file, CASE WHEN kind <> 'unknown' AND text_heavy THEN checkbox_page END AS page FROM k WHERE kind = 'unknown' OR NOT text_heavy OR (kind = 'dealertrack' AND checkbox_page IS NOT NULL)"),
    "credit_app_selection": q(PAGES, LINED, MARKED, FOOT, TEXT_SIGNALS, grouped("sig"), "SELECT pdf_id, group_no FROM made WHERE file_name = 'Credit_Application.pdf'"),
    "pdf_discovery": q(f"f AS (SELECT page_id, {_PATH} AS path FROM pages)", f"SELECT page_id, ends_with(path, '.pdf') AS in_folder_scan, {_STEM} || '.json' AS output_name, {_STEM} || '/part.pdf' AS blob FROM f WHERE ends_with(lower(path), '.pdf')"),
    "wrapped_lines": r"SELECT doc_id, array_to_string(regexp_extract_all(array_to_string(list_filter(string_split(coalesce(text, ''), ' '), lambda x: x <> ''), ' '), '(?s)([^ ](?:.{0,22}[^ ])?|[^ ]+)(?: |$)', 1), '|') AS lines FROM documents",
    "largest_image": "SELECT l_orderkey AS page, CAST(l_quantity AS INT) AS width, l_suppkey % 7 AS height, (CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 1000000 + l_suppkey AS image_no FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_quantity AS INT) * (l_suppkey % 7) DESC, (CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 1000000 + l_suppkey) AS k FROM lineitem) WHERE k = 1",
}
