"""The catalogue's queries in DuckDB's SQL, from the driver's tables alone."""

from __future__ import annotations

_STRIP = r"regexp_replace({}, '^[\s\x0b\x1c-\x1f]+|[\s\x0b\x1c-\x1f]+$', '', 'g')"
_DOC_PAGES = """p AS (SELECT doc_id, 1 AS page_number, source,
  CASE WHEN doc_id % 7 = 0 THEN replace(text, 'e', chr(1)) ELSE text END AS text FROM documents)"""
_TURN_PAGES = """p AS (SELECT conv_id AS doc_id, CAST(turn + 1 AS INT) AS page_number,
  CASE WHEN conv_id % 7 = 0 AND turn % 2 = 0 THEN replace(text, 'e', chr(1)) ELSE text END AS text FROM conversations)"""
_REASONS = rf"""s AS (SELECT *, length({_STRIP.format("coalesce(text, '')")}) AS chars,
  len(regexp_extract_all(coalesce(text, ''), '[\x00-\x08\x0b\x0c\x0e-\x1f]')) / greatest(length(coalesce(text, '')), 1) AS bad FROM p),
r AS (SELECT *, CASE WHEN chars < 20 THEN 'image_only' WHEN bad > 0.05 THEN 'garbage' END AS reason FROM s)"""
_CHUNKS = r"""c AS (SELECT conv_id AS doc_id, CAST(turn AS INT) AS seq, CAST(turn + 1 AS INT) AS page_number,
  '# ' || role || chr(10) || '## ' || replace(substr(text, 1, 40), chr(10), ' ') || chr(10) || chr(10) || text AS text FROM conversations),
m AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY doc_id ORDER BY seq) > 1
  THEN chr(10) || chr(10) || '<!-- page ' || page_number || ' -->' || chr(10) || chr(10) ELSE '' END AS marker FROM c)"""
_BODY = _CHUNKS + """, b AS (SELECT doc_id, string_agg(marker || text, '' ORDER BY seq) AS md FROM m GROUP BY doc_id)"""
_LINES = _BODY + """, sl AS (SELECT doc_id, string_split(md, chr(10)) AS x FROM b),
l AS (SELECT doc_id, CAST(unnest(range(len(x))) AS INT) AS line_no, unnest(x) AS line FROM sl)"""
_TAGGED = (
    _LINES
    + rf""", t AS (SELECT *, {_STRIP.format("line")} AS s FROM l),
u AS (SELECT *, TRY_CAST(nullif(regexp_extract(s, '^<!-- page (\d+) -->', 1), '') AS INT) AS mark FROM t),
g AS (SELECT *, coalesce(last_value(mark IGNORE NULLS) OVER w, 1) AS page, count(mark) OVER w AS segment FROM u
  WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING))"""
)
_HEADINGS = (
    _TAGGED
    + rf""", h0 AS (SELECT doc_id, line_no, page, segment, length(regexp_extract(s, '^(#{{1,6}})\s+(.+)$', 1)) AS level,
  {_STRIP.format(r"replace(regexp_extract(s, '^(#{1,6})\s+(.+)$', 2), '*', '')")} AS text FROM g WHERE mark IS NULL),
h AS (SELECT *, row_number() OVER (PARTITION BY doc_id, segment ORDER BY line_no) = 1 AS is_first FROM h0 WHERE text <> ''),
bn AS (SELECT doc_id, text, count(*) AS n FROM h WHERE is_first GROUP BY ALL HAVING count(*) >= 3),
ix AS (SELECT doc_id, line_no, CAST(level AS INT) AS level, text, page FROM h ANTI JOIN bn USING (doc_id, text))"""
)
_INDEX_TEXT = """, it AS (SELECT doc_id, chr(10) || chr(10) || '<!-- document index' || chr(10) ||
  string_agg(repeat('  ', level - 1) || '- ' || text || ' (page ' || page || ')', chr(10) ORDER BY line_no) || chr(10) || '-->' || chr(10) AS index_text FROM ix GROUP BY doc_id)"""
_BLOCKS = rf"""sp AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL),
bl AS (SELECT doc_id, CAST(unnest(range(len(x))) AS INT) AS seq, unnest(x) AS text FROM sp),
k AS (SELECT *, CAST(seq // 5 AS INT) AS page_idx, {_STRIP.format("text")} AS key, count(*) OVER (PARTITION BY doc_id, {_STRIP.format("text")}) AS n FROM bl)"""
_NEEDLES = _BLOCKS + """, nd AS (SELECT doc_id, seq, page_idx, substr(key, 1, 40) AS needle FROM k
  WHERE NOT (key <> '' AND n >= 3) AND length(substr(key, 1, 40)) >= 10)"""
_MARKED = (
    _NEEDLES
    + """, nk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS nth FROM nd),
    w AS (SELECT doc_id, CAST(0 AS BIGINT) AS nth, CAST(1 AS BIGINT) AS cursor, CAST(1 AS BIGINT) AS last, CAST(NULL AS INT) AS page, '' AS done, 0 AS n, text AS md FROM documents
      UNION ALL SELECT doc_id, nth, CASE WHEN hit THEN pos + length(needle) ELSE cursor END, CASE WHEN turn THEN pos ELSE last END, CASE WHEN hit THEN page_idx ELSE page END,
        CASE WHEN turn THEN done || substr(md, last, pos - last) || chr(10) || chr(10) || '<!-- page ' || (page_idx + 1) || ' -->' || chr(10) || chr(10) ELSE done END,
        CASE WHEN turn THEN n + 1 ELSE n END, md
      FROM (SELECT *, hit AND page IS NOT NULL AND page <> page_idx AS turn FROM (SELECT *, off > 0 AS hit, cursor + off - 1 AS pos FROM (
        SELECT w.doc_id, nk.nth, cursor, last, page, done, n, md, page_idx, needle, strpos(substr(md, cursor), needle) AS off FROM w JOIN nk ON w.doc_id = nk.doc_id AND nk.nth = w.nth + 1)))),
    e AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY nth DESC) = 1),
    pm AS (SELECT doc_id, done || substr(md, last) AS md, n FROM e), bl2 AS (SELECT doc_id, CAST(seq // 5 AS INT) AS page_idx FROM bl)"""
)
_TOKENS = r"""tk AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-z]{5,}') AS x FROM documents),
te AS (SELECT doc_id, unnest(range(len(x))) AS nth, unnest(x) AS token FROM tk),
ct AS (SELECT doc_id, token, count(*) AS n, min(nth) AS first FROM te GROUP BY ALL),
wl AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]{5,}'))) AS word FROM benchmark),
ra AS (SELECT * FROM ct WHERE n >= 2 AND lower(token) NOT IN (SELECT word FROM wl)),
di AS (SELECT * FROM ct WHERE n >= 2 AND lower(token) IN (SELECT word FROM wl))"""
_TWINS = _TOKENS + """, tw AS (SELECT ra.doc_id, ra.token AS rare_token, di.token AS dict_token, ra.first FROM ra JOIN di
  ON ra.doc_id = di.doc_id AND length(ra.token) = length(di.token) AND levenshtein(lower(ra.token), lower(di.token)) <= 2)"""
_CONFIRMED = (
    _TWINS
    + """, rf AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(replace(text, 'e', 'q'), '[A-Za-z]{5,}')) AS token FROM documents),
cf AS (SELECT doc_id, dict_token, rare_token FROM tw WHERE (doc_id, rare_token) IN (SELECT (doc_id, token) FROM rf) AND (doc_id, dict_token) NOT IN (SELECT (doc_id, token) FROM rf)
  QUALIFY row_number() OVER (PARTITION BY doc_id, dict_token ORDER BY first, rare_token) = 1)"""
)
_MONEY = "CASE WHEN {0} < 0 THEN '(' || {1} || ')' ELSE {1} END"
_SIZE = "CASE WHEN abs(v) = floor(abs(v)) THEN format('{:,}', CAST(abs(v) AS BIGINT)) ELSE format('{:,.2f}', abs(v)) END"
_CELLS = rf"""k AS (SELECT *, c_custkey AS k, c_acctbal AS v FROM customer),
f AS (SELECT k // 1000 AS doc_id, CAST(k % 1000 // 50 AS INT) AS sheet_ix, CAST(k % 50 + 1 AS INT) AS row, CAST(c_custkey AS VARCHAR) AS v1,
  c_name || ' \| ' || c_mktsegment AS v2,
  CASE WHEN k % 11 = 3 THEN '[unresolved formula]' ELSE {_MONEY.format("v", f"({_SIZE})")} END AS v3,
  {_MONEY.format("v", f"replace({_SIZE}, ',', '')")} AS v4 FROM k),
ce AS (SELECT doc_id, sheet_ix, row, CAST(c AS INT) AS col, CASE c WHEN 1 THEN v1 WHEN 2 THEN v2 WHEN 3 THEN v3 ELSE v4 END AS value FROM f, range(1, 5) r(c))"""
_MERGED = """mg AS (SELECT DISTINCT c_custkey // 1000 AS doc_id, CAST(c_custkey % 1000 // 50 AS INT) AS sheet_ix FROM customer),
mb AS (SELECT doc_id, sheet_ix, CAST(sheet_ix % 5 + 1 + r AS INT) AS row, CAST(2 + c AS INT) AS col FROM mg, range(2) a(r), range(2) b(c) WHERE r + c > 0)"""
_TABLES = """ln AS (SELECT doc_id, sheet_ix, row, '| ' || string_agg(value, ' | ' ORDER BY col) || ' |' AS line FROM {} GROUP BY ALL),
tb AS (SELECT doc_id, sheet_ix, string_agg(CASE WHEN row = 1 THEN line || chr(10) || '|---|---|---|---|' ELSE line END, chr(10) ORDER BY row) AS "table" FROM ln GROUP BY ALL)"""
_ITEMS = rf"""rw AS (SELECT page_id AS doc_id, regexp_extract_all(html, '(?s)<(?:h1|p)>(?:.*?)</(?:h1|p)>') AS x FROM pages),
ri AS (SELECT doc_id, CAST(unnest(range(len(x))) AS INT) AS seq, unnest(x) AS raw FROM rw),
rt AS (SELECT *, {_STRIP.format("regexp_replace(raw, '^<(?:h1|p)>|</(?:h1|p)>$', '', 'g')")} AS t FROM ri),
im AS (SELECT doc_id, seq, CASE WHEN t = '' THEN '' WHEN starts_with(raw, '<h1>') THEN '# ' || t ELSE t END AS md FROM rt)"""

_LINEITEMS = "li AS (SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey, max(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1, 2)"


def _sql() -> dict[str, str]:
    o: dict[str, str] = {}
    o["page_reason"] = f"WITH {_DOC_PAGES}, {_REASONS} SELECT doc_id, page_number, chars, reason FROM r"
    o["page_reason_by_count"] = f"WITH {_DOC_PAGES}, {_REASONS} SELECT doc_id, page_number, CASE WHEN chars < 20 THEN 'image_only' END AS reason FROM r"
    o["doc_verdict"] = f"""WITH {_TURN_PAGES}, {_REASONS}, d AS (SELECT doc_id, CAST(count(*) AS INT) AS page_count, CAST(sum(chars) AS BIGINT) AS total_chars,
      coalesce(string_agg(page_number, ',' ORDER BY page_number) FILTER (reason IS NOT NULL), '') AS needs_ocr,
      coalesce(string_agg(page_number, ',' ORDER BY page_number) FILTER (reason = 'garbage'), '') AS garbage, '' AS image, count(reason) AS n FROM r GROUP BY doc_id)
    SELECT doc_id, page_count, total_chars, needs_ocr, garbage, image, round(n / page_count, 6) AS ratio,
      CASE WHEN garbage <> '' OR n / page_count > 0.2 THEN 'scan' ELSE 'digital' END AS verdict FROM d"""
    o["ocr_ratio_by_source"] = f"""WITH {_DOC_PAGES}, {_REASONS} SELECT source, count(*) AS pages, count(reason) AS needing,
      bool_or(coalesce(reason = 'garbage', false)) AS any_garbage, round(count(reason) / count(*), 6) AS ratio FROM r GROUP BY source"""
    o["image_coverage"] = """WITH q AS (SELECT l_orderkey AS doc_id, l_partkey % 600 AS x0, l_suppkey % 700 AS y0, l_quantity AS q FROM lineitem),
    s AS (SELECT doc_id, least(sum(greatest(least(x0 + q * 10, 612) - x0, 0) * greatest(least(y0 + q * 8, 792) - y0, 0)) / (612.0::DOUBLE * 792.0::DOUBLE), 1.0::DOUBLE) AS c FROM q GROUP BY doc_id)
    SELECT doc_id, round(c, 6) AS coverage, c > 0.5 AS heavy FROM s"""
    o["rotation_resolve"] = """WITH p AS (SELECT p_partkey AS k, p_size AS size FROM part),
    ob AS (SELECT k, k // 20 AS doc_id, CAST(k % 20 + 1 AS INT) AS page_number, size % 4 * 90 AS base, CASE WHEN k % 5 < 4 THEN k % 5 * 90 END AS turn, size / 10.0 AS conf FROM p),
    rc AS (SELECT k, CAST(r AS INT) AS r FROM p, (VALUES (0), (90), (180), (270)) t(r) WHERE (k + r) % 11 <> 0 AND (r + k % 7 * 90) % 360 = 0),
    ch AS (SELECT ob.k, min(r) AS degrees FROM ob JOIN rc ON ob.k = rc.k AND (r = (base + turn) % 360 OR r = (base - turn + 360) % 360) GROUP BY ob.k)
    SELECT doc_id, page_number, CASE WHEN NOT (coalesce(turn, 0) <> 0 AND conf >= 1) THEN 'untouched' WHEN degrees IS NOT NULL THEN 'fixed' ELSE 'unresolved' END AS status,
      CASE WHEN coalesce(turn, 0) <> 0 AND conf >= 1 THEN degrees END AS degrees FROM ob LEFT JOIN ch USING (k)"""
    o["merged_run_scan"] = r"""WITH w AS (SELECT doc_id, list_filter(regexp_extract_all(text, '[\pL\pM\pN\p{Pc}]+'), lambda x: regexp_full_match(x, '[A-Z]{8,}')) AS x FROM documents)
    SELECT doc_id, CAST(len(x) AS INT) AS n_runs, array_to_string(x, ' ') AS runs FROM w WHERE len(x) > 0"""
    o["assemble_pages"] = f"WITH {_BODY} SELECT doc_id, md FROM b"
    o["assemble_document"] = f"WITH {_HEADINGS}{_INDEX_TEXT} SELECT doc_id, md || coalesce(index_text, '') AS md FROM b LEFT JOIN it USING (doc_id)"
    o["chunk_offsets"] = f"""WITH {_CHUNKS}, z AS (SELECT *, CAST(sum(length(marker) + length(text)) OVER (PARTITION BY doc_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM m)
    SELECT doc_id, seq, page_number, stop - length(text) AS start, stop FROM z"""
    o["chunk_boxes"] = f"""WITH {_CHUNKS}, z AS (SELECT *, CAST(sum(length(marker) + length(text)) OVER (PARTITION BY doc_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM m)
    SELECT doc_id, seq, CAST(0 AS INT) AS box_no, 'text' AS class, text, page_number, stop - length(text) AS start, stop FROM z
    UNION ALL SELECT doc_id, seq, 1, 'picture', NULL, page_number, NULL, NULL FROM z"""
    o["tag_lines_with_page"] = f"WITH {_TAGGED} SELECT doc_id, line_no, line, page FROM g"
    o["title_index"] = f"WITH {_HEADINGS} SELECT doc_id, line_no, level, text, page FROM ix"
    o["title_index_text"] = f"WITH {_HEADINGS}{_INDEX_TEXT} SELECT doc_id, index_text FROM it"
    o["running_headers"] = f"WITH {_HEADINGS} SELECT doc_id, text, n FROM bn"
    o["boilerplate_blocks"] = f"WITH {_BLOCKS} SELECT DISTINCT doc_id, key, n FROM k WHERE key <> '' AND n >= 3"
    o["anchor_blocks"] = f"WITH {_NEEDLES} SELECT doc_id, seq, page_idx, needle FROM nd"
    o["page_markers"] = f"WITH RECURSIVE {_MARKED} SELECT doc_id, md, n AS n_markers FROM pm"
    o["marker_audit"] = f"""WITH RECURSIVE {_MARKED}, ls AS (SELECT doc_id, max(page_idx) AS last FROM bl2 GROUP BY doc_id)
    SELECT doc_id, coalesce(last, 0) + 1 AS pages, n AS n_markers, greatest(coalesce(last, 0) - n, 0) AS missing FROM pm LEFT JOIN ls USING (doc_id)"""
    o["convert_scanned"] = f"""WITH RECURSIVE {_MARKED.replace("text AS md FROM documents", "'# Part' || chr(10) || text || chr(10) || '## End' AS md FROM documents")},
    b AS (SELECT doc_id, md FROM pm){_HEADINGS[len(_BODY):]}{_INDEX_TEXT}
    SELECT doc_id, md || coalesce(index_text, '') AS md, CAST(NULL AS VARCHAR) AS error FROM b LEFT JOIN it USING (doc_id)"""
    o["json_blocks"] = f"WITH {_BLOCKS} SELECT doc_id, seq, text, page_idx FROM k"
    o["rare_tokens"] = f"WITH {_TOKENS} SELECT doc_id, token, n FROM ra"
    o["dictionary_tokens"] = f"WITH {_TOKENS} SELECT doc_id, token, n FROM di"
    o["spelling_twins"] = f"WITH {_TWINS} SELECT doc_id, rare_token, dict_token FROM tw"
    o["spelling_reconciled"] = f"WITH {_CONFIRMED} SELECT doc_id, dict_token, rare_token FROM cf"
    words = r"regexp_extract_all(text, '[\pL\pM\pN\p{Pc}]+|[^\pL\pM\pN\p{Pc}]+')"
    o["spelling_text"] = f"""WITH {_CONFIRMED}, mp AS (SELECT doc_id, map(list(dict_token), list(rare_token)) AS m FROM cf GROUP BY doc_id),
    tt AS (SELECT doc_id, text, m, {words} AS x FROM documents LEFT JOIN mp USING (doc_id))
    SELECT doc_id, CASE WHEN m IS NULL THEN text ELSE array_to_string(list_transform(x, lambda t: coalesce(m[t], t)), '') END AS md,
      CAST(CASE WHEN m IS NULL THEN 0 ELSE len(list_filter(x, lambda t: m[t] IS NOT NULL)) END AS INT) AS n_replaced FROM tt"""
    o["spelling_log"] = f"""WITH {_CONFIRMED}, rt AS (SELECT doc_id, unnest(regexp_extract_all(replace(text, 'e', 'q'), '[A-Za-z]{{5,}}')) AS rare_token FROM documents),
    rn AS (SELECT doc_id, rare_token, count(*) AS n_reference FROM rt GROUP BY ALL), tt AS (SELECT doc_id, {words} AS x FROM documents)
    SELECT doc_id, dict_token, rare_token, CAST(len(list_filter(x, lambda t: t = dict_token)) AS INT) AS n_replaced, n_reference
    FROM cf JOIN rn USING (doc_id, rare_token) JOIN tt USING (doc_id) WHERE len(list_filter(x, lambda t: t = dict_token)) > 0"""
    o["spacing_repair"] = rf"""WITH w AS (SELECT doc_id, text, regexp_split_to_array(array_to_string(list_transform(regexp_extract_all(text, '[A-Z]+|[^A-Z]+'), lambda t: CASE WHEN regexp_full_match(t, '[A-Z]{{8,}}')
        THEN array_to_string(list_transform(range(0, length(t) // 4), lambda k: CASE WHEN k < length(t) // 4 - 1 THEN substr(t, 4 * k + 1, 4) ELSE substr(t, 4 * k + 1) END), ' ') ELSE t END), ''), '[\s]+') AS words FROM documents),
    ba AS (SELECT *, list_transform(words, lambda x: coalesce(nullif(upper(regexp_replace(x, '[^A-Za-z]', '', 'g')), ''), '|')) AS bare FROM w),
    dw AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word, unnest(bare) AS bare FROM ba),
    en AS (SELECT *, sum(length(bare)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM dw),
    ru AS (SELECT DISTINCT doc_id, unnest(list_filter(regexp_extract_all(text, '[\pL\pM\pN\p{{Pc}}]+'), lambda x: regexp_full_match(x, '[A-Z]{{8,}}'))) AS run FROM documents),
    st AS (SELECT doc_id, list(CAST(stop - length(bare) + 1 AS BIGINT) ORDER BY i) AS starts FROM en WHERE doc_id IN (SELECT doc_id FROM ru) GROUP BY doc_id),
    le AS (SELECT doc_id, array_to_string(bare, '') AS letters, bare, words, starts FROM ba JOIN st USING (doc_id)),
    hs AS (SELECT doc_id, run, unnest(list_filter(range(1, len(words) + 1), lambda i: bare[i] <> '|' AND substr(letters, starts[i], length(run)) = run)) AS i FROM ru JOIN le USING (doc_id)),
    ft AS (SELECT hs.doc_id, run, hs.i AS i, b.i AS j FROM hs JOIN en a ON a.doc_id = hs.doc_id AND a.i = hs.i JOIN en b ON b.doc_id = hs.doc_id AND b.stop = a.stop - length(a.bare) + length(run) WHERE b.bare <> '|'
      QUALIFY row_number() OVER (PARTITION BY hs.doc_id, run ORDER BY hs.i) = 1),
    mp AS (SELECT doc_id, map(list(run), list(array_to_string(words[i:j], ' '))) AS m FROM ft JOIN le USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, CASE WHEN m IS NULL THEN text ELSE array_to_string(list_transform({words}, lambda t: coalesce(m[t], t)), '') END AS text FROM documents LEFT JOIN mp USING (doc_id)"""
    o["format_cells"] = f"WITH {_CELLS} SELECT doc_id, sheet_ix, row, col, value FROM ce"
    o["merged_cells"] = f"WITH {_MERGED} SELECT doc_id, sheet_ix, row, col FROM mb"
    o["sheet_markdown"] = f"""WITH {_CELLS}, {_MERGED}, cv AS (SELECT ce.doc_id, ce.sheet_ix, ce.row, ce.col, CASE WHEN mb.row IS NULL THEN value ELSE '' END AS value
      FROM ce LEFT JOIN mb ON ce.doc_id = mb.doc_id AND ce.sheet_ix = mb.sheet_ix AND ce.row = mb.row AND ce.col = mb.col), {_TABLES.format("cv")} SELECT doc_id, sheet_ix, "table" FROM tb"""
    o["workbook_markdown"] = f"""WITH {_CELLS}, {_TABLES.format("ce")} SELECT doc_id,
      string_agg('## Sheet' || (sheet_ix + 1) || chr(10) || chr(10) || "table", chr(10) || chr(10) ORDER BY sheet_ix) AS md, CAST(NULL AS VARCHAR) AS error FROM tb GROUP BY doc_id"""
    o["trim_trailing_rows"] = f"WITH {_CELLS} SELECT doc_id, sheet_ix, max(row) FILTER (row + sheet_ix <= 45 AND NOT (col = 3 AND value = '[unresolved formula]')) AS last_row, max(col) AS width FROM ce GROUP BY ALL"
    o["ragged_table"] = rf"""WITH ls AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: len(regexp_extract_all(x, '\|')) >= 2) AS x FROM documents),
    rr AS (SELECT doc_id, unnest(range(len(x))) AS nth, list_transform(string_split(unnest(x), '|'), lambda v: {_STRIP.format("v")}) AS cells, len(string_split(x[1], '|')) AS width FROM ls WHERE len(x) > 0),
    rl AS (SELECT *, '| ' || array_to_string(list_transform(range(1, width + 1), lambda i: coalesce(cells[i], '')), ' | ') || ' |' AS line FROM rr)
    SELECT doc_id, string_agg(CASE WHEN nth = 0 THEN line || chr(10) || '|' || repeat('---|', width) ELSE line END, chr(10) ORDER BY nth) AS "table" FROM rl GROUP BY doc_id"""
    o["style_headings"] = f"""WITH t AS (SELECT doc_id, {_STRIP.format("coalesce(text, '')")} AS t, length(source) % 7 AS s FROM documents)
    SELECT doc_id, CASE WHEN t = '' THEN '' ELSE CASE s WHEN 0 THEN '# ' WHEN 1 THEN '# ' WHEN 2 THEN '## ' WHEN 3 THEN '### ' WHEN 4 THEN '#### ' WHEN 5 THEN '# ' ELSE '' END || t END AS md FROM t"""
    o["ordered_items"] = f"WITH {_ITEMS} SELECT doc_id, seq, md FROM im"
    o["page_documents"] = rf"""WITH {_ITEMS}, d AS (SELECT doc_id, coalesce(string_agg(md, chr(10) || chr(10) ORDER BY seq) FILTER (md <> ''), '') AS md FROM im GROUP BY doc_id)
    SELECT doc_id, md, CASE WHEN length({_STRIP.format("md")}) < 20 THEN 'almost no output' END AS error FROM d"""
    o["dedupe_headers"] = rf"""WITH t AS (SELECT conv_id AS doc_id, turn // 2 AS section_ix, turn % 2 AS footer, {_STRIP.format("text")} AS text FROM conversations WHERE turn % 5 <> 4),
    f AS (SELECT * FROM t WHERE text <> '' QUALIFY row_number() OVER (PARTITION BY doc_id, text ORDER BY section_ix, footer) = 1)
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY section_ix, footer) AS INT) AS nth, '*' || CASE footer WHEN 0 THEN 'Header' ELSE 'Footer' END || ': ' || text || '*' AS md FROM f"""
    o["route_files"] = """WITH t AS (SELECT page_id, ['pdf', 'docx', 'xlsx', 'doc', 'xls', 'txt', 'pdf', ''][page_id % 8 + 1] AS ext,
      CAST(page_id AS VARCHAR) || CASE WHEN page_id % 8 = 6 THEN '.derotated' ELSE '' END AS stem,
      CASE WHEN page_id % 13 = 0 THEN 'ocr' WHEN page_id % 17 = 0 THEN 'other' END AS forced, CASE page_id % 3 WHEN 0 THEN 'text' WHEN 1 THEN 'ocr' ELSE 'classify' END AS auto FROM pages),
    e AS (SELECT *, CASE WHEN ext IN ('', 'txt') THEN 'unsupported extension' WHEN ext <> 'pdf' AND forced IS NOT NULL THEN 'engine applies to pdf only' WHEN forced = 'other' THEN 'unknown engine' END AS error FROM t)
    SELECT page_id, ext, stem, CASE WHEN ext IN ('doc', 'xls') AND forced IS NULL THEN stem || '.from' || ext || '.pdf' END AS next_name,
      CASE WHEN error IS NOT NULL THEN NULL WHEN ext IN ('docx', 'xlsx') THEN ext WHEN ext IN ('doc', 'xls') THEN 'legacy' ELSE coalesce(forced, auto) END AS engine,
      error, ext NOT IN ('', 'txt') AND page_id % 8 <> 6 AS supported FROM e"""
    o["pick_artifact"] = """WITH t AS (SELECT p_partkey % 500 AS doc_id, CAST(p_size AS BIGINT) AS size, p_partkey % 3 = 0 AS exact,
      '/out/' || CASE WHEN p_partkey % 3 = 0 THEN 'd' || (p_partkey % 500) ELSE 'x' || p_partkey END || '.md' AS path FROM part)
    SELECT doc_id, path, size FROM t QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY exact DESC, CASE WHEN exact THEN 0 ELSE size END DESC, path DESC, size DESC) = 1"""
    o["image_links"] = "SELECT doc_id, replace('![a](images/a.png) ' || text || ' ![b](images/b.png)', '](images/', '](images/doc' || doc_id || '/') AS md FROM documents"
    o["engine_diff"] = """WITH d AS (SELECT doc_id, sha256(text) AS v FROM documents), a AS (SELECT * FROM d),
    b AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'changed' ELSE v END AS v FROM d)
    SELECT doc_id, a.v AS left_value, b.v AS right_value, CASE WHEN b.doc_id IS NULL THEN 'left_only' WHEN a.doc_id IS NULL THEN 'right_only' WHEN a.v IS NOT DISTINCT FROM b.v THEN 'same' ELSE 'changed' END AS outcome
    FROM (SELECT doc_id, v FROM a) a FULL JOIN b USING (doc_id)"""
    o["refoot_totals"] = """WITH f AS (SELECT l_orderkey AS doc_id, sum(round(l_extendedprice, 2)) AS s FROM lineitem GROUP BY 1)
    SELECT o_orderkey AS doc_id, round(coalesce(s, 0), 2) AS footed, abs(o_totalprice - round(coalesce(s, 0), 4)) <= 0.005 AS agrees FROM orders LEFT JOIN f ON f.doc_id = o_orderkey"""
    o["nil_audit"] = """WITH c AS (SELECT c_custkey AS k, c_custkey % 4 = 0 AS was FROM customer), n AS (SELECT k, was, CASE WHEN k % 9 = 0 THEN true WHEN k % 6 = 0 THEN false WHEN k % 5 = 0 THEN true ELSE was END AS now FROM c)
    SELECT k AS doc_id, CASE WHEN was AND NOT now THEN 'fabricated' WHEN NOT was AND now THEN 'lost' WHEN was THEN 'kept_nil' ELSE 'kept' END AS finding FROM n"""
    o["spacer_split"] = f"""WITH {_LINEITEMS}, l AS (SELECT l_orderkey AS doc_id, l_linenumber AS row, CAST(l_partkey AS VARCHAR) AS cell, length(CAST(l_partkey AS VARCHAR)) % 2 = 0 AS blank FROM li),
    g AS (SELECT *, CAST(blank AND NOT coalesce(lag(blank) OVER (PARTITION BY doc_id ORDER BY row), true) AS INT) AS begins FROM l),
    n AS (SELECT *, CAST(sum(begins) OVER (PARTITION BY doc_id ORDER BY row ROWS UNBOUNDED PRECEDING) AS INT) AS table_no FROM g) SELECT doc_id, row, cell, table_no FROM n WHERE NOT blank"""
    o["complete_periods"] = "SELECT o_custkey AS doc_id, count(DISTINCT year(o_orderdate)) AS n_periods, count(DISTINCT year(o_orderdate)) = 2 AS complete FROM orders GROUP BY 1"
    o["rolls_forward"] = "SELECT o_custkey AS doc_id, o_orderkey AS period, abs(o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)) <= 0.005 AS agrees FROM orders"
    o["footnote_between_tables"] = f"""WITH {_LINEITEMS}, b AS (SELECT l_orderkey AS doc_id, l_linenumber AS seq, CASE WHEN l_linenumber % 2 = 0 THEN 'footnote' WHEN l_suppkey % 3 = 0 THEN 'text' ELSE 'table' END AS kind FROM li)
    SELECT * FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY seq) QUALIFY kind = 'footnote' AND lag(kind) OVER w = 'table' AND lead(kind) OVER w = 'table'"""
    o["heading_depth"] = f"WITH {_HEADINGS} SELECT doc_id, line_no, CAST(level * 2 AS INT) AS level, CAST(dense_rank() OVER (PARTITION BY doc_id ORDER BY level) AS INT) AS depth FROM h"
    o["finding_scorecard"] = """SELECT l_orderkey AS doc_id, count(*) FILTER (l_partkey % 3 = 0) AS "A", count(*) FILTER (l_partkey % 3 = 1) AS "B", count(*) FILTER (l_partkey % 3 = 2) AS "C" FROM lineitem GROUP BY 1"""
    o["html_tables"] = rf"""WITH h AS (SELECT page_id, url, string_split(regexp_replace(html, '(?s)<(?:script|style).*?</(?:script|style)>', '', 'g'), '<p>') AS x FROM pages),
    p AS (SELECT page_id, unnest(range(1, len(x))) AS i, unnest(x[2:]) AS t FROM h),
    t AS (SELECT page_id, i, replace(replace(replace(replace(regexp_replace(split_part(t, '</p>', 1), '<[^>]*>', '', 'g'), '&copy;', chr(169)), '&middot;', chr(183)), '&quot;', '"'), '&amp;', '&') AS t FROM p),
    a AS (SELECT page_id, 0 AS table_no, i AS row, CASE i WHEN 1 THEN 2 ELSE 0 END AS col, 1 AS span, {_STRIP.format("t")} AS text FROM t
      UNION ALL SELECT page_id, 0, 0, 0, 2, url || ' end' FROM pages UNION ALL SELECT page_id, 1, 0, 0, 1, CAST(page_id AS VARCHAR) FROM pages)
    SELECT CAST(page_id AS VARCHAR) AS doc_id, CAST(0 AS INT) AS seq, CAST(table_no AS INT) AS table_no, CAST(row AS INT) AS row, CAST(col AS INT) AS col, CAST(span AS INT) AS rowspan, CAST(span AS INT) AS colspan, text FROM a"""
    o["image_heavy_pages"] = f"""WITH {_LINEITEMS}, p AS (SELECT l_orderkey AS doc_id, l_linenumber AS n, l_partkey % 100 > 50 AS heavy FROM li)
    SELECT doc_id, coalesce(string_agg(n, ',' ORDER BY n) FILTER (heavy), '') AS image, CASE WHEN count(*) FILTER (heavy) / count(*) > 0.2 THEN 'scan' ELSE 'digital' END AS verdict FROM p GROUP BY doc_id"""
    o["letters_only"] = "SELECT doc_id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters FROM documents"
    o["wordlist"] = "SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]{5,}'))) AS word FROM benchmark"
    o["model_available"] = """SELECT p_partkey, (p_partkey % 7 = p_size % 7) AS available FROM part"""
    o["output_inside"] = "SELECT c_custkey, c_nationkey = c_custkey % 5 AS inside FROM customer"
    o["too_little"] = f"SELECT doc_id, length({_STRIP.format('text')}) < 20 * greatest(doc_id % 200, 1) * 0.2 AS little FROM documents"
    o["sql_functions"] = rf"""SELECT doc_id, {_STRIP.format("text")} AS stripped, CAST(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS INT) AS letters, '<!-- page ' || doc_id || ' -->' AS marker,
      len(regexp_extract_all(text, '[\x00-\x08\x0b\x0c\x0e-\x1f]')) / greatest(length(text), 1) AS ratio, 't' || doc_id AS ext FROM documents"""
    grand = _HEADINGS.replace("chr(10) || chr(10) || text AS text FROM conversations", "chr(10) || chr(10) || text || chr(10) || 'GRAND TOTAL ' || turn AS text FROM conversations")
    o["convert_digital"] = f"""WITH {grand}{_INDEX_TEXT}, pc AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id)
    SELECT doc_id, md || coalesce(index_text, '') AS md, CASE WHEN length({_STRIP.format("md || coalesce(index_text, '')")}) < 20 * n * 0.2 THEN 'little output' END AS warning, CAST(NULL AS VARCHAR) AS error
    FROM b JOIN pc USING (doc_id) LEFT JOIN it USING (doc_id)"""
    o["rotation_summary"] = f"""SELECT doc_id, count(*) FILTER (status = 'fixed') AS n_fixed, count(*) FILTER (status = 'unresolved') AS n_unresolved,
      coalesce(string_agg(page_number, ',' ORDER BY page_number) FILTER (status = 'unresolved'), '') AS unresolved FROM ({o["rotation_resolve"]}) GROUP BY doc_id"""
    o["split_headings"] = f"""WITH {_HEADINGS} SELECT doc_id, line_no, CAST(0 AS INT) AS part, CAST(level AS INT) AS level, text FROM h
    UNION ALL SELECT doc_id, line_no, CAST(1 AS INT), CAST(3 AS INT), 'of  ' || page FROM h WHERE level = 1"""
    o["xlsx_cells"] = f"""WITH k AS (SELECT *, c_custkey AS k, c_acctbal AS v, c_custkey % 1440 AS m, c_custkey % 60 AS h FROM customer),
    c AS (SELECT k, CAST(c AS INT) AS col, CASE c WHEN 1 THEN c_name WHEN 2 THEN {_MONEY.format("v", f"({_SIZE})")} WHEN 3 THEN strftime(DATE '1899-12-30' + CAST(40000 + k % 5000 AS INT), '%Y-%m-%d')
      WHEN 4 THEN format('{{:02d}}:{{:02d}}:00', m // 60, m % 60) WHEN 5 THEN CASE WHEN h < 24 THEN '' WHEN h < 48 THEN '1 day, ' ELSE '2 days, ' END || (h % 24) || ':00:00'
      WHEN 6 THEN CASE k % 2 WHEN 1 THEN 'TRUE' ELSE 'FALSE' END ELSE '[unresolved formula]' END AS value FROM k, range(1, 8) r(c) WHERE k % 10 <> 0)
    SELECT CAST(k AS VARCHAR) AS doc_id, CAST(1 AS INT) AS row, col, value FROM c UNION ALL SELECT CAST(c_custkey AS VARCHAR), 0, 0, 'error' FROM customer WHERE c_custkey % 10 = 0"""
    o["docx_items"] = r"""SELECT CAST(page_id AS VARCHAR) AS doc_id, CAST(s AS INT) AS seq, CASE s WHEN 0 THEN '# Page' WHEN 1 THEN url ELSE '| page | a\|b |' || chr(10) || '|---|---|' || chr(10) || '| ' || page_id || ' |  |' END AS md
    FROM pages, range(3) r(s) WHERE page_id % 10 <> 0 UNION ALL SELECT CAST(page_id AS VARCHAR), -1, 'error' FROM pages WHERE page_id % 10 = 0"""
    o["inbox_once"] = "SELECT page_id || '.docx' AS file, count(*) AS taken, max(CASE WHEN page_id % 7 = 0 THEN 'failed' ELSE 'processed' END) AS outcome FROM pages WHERE page_id % 3 <> 2 GROUP BY page_id"
    o["files_below"] = "SELECT CAST(page_id AS VARCHAR) AS stem, CASE WHEN page_id % 3 = 0 THEN 'png' ELSE 'md' END AS ext, strlen(html) AS length, CAST(page_id % 2 AS VARCHAR) AS folder FROM pages"
    o["markdown_files"] = "SELECT CAST(doc_id AS VARCHAR) AS stem, text AS md FROM documents"
    o["block_list_files"] = o["json_blocks"]
    o["inbox_replay"] = "SELECT page_id || '.docx' AS file, CASE WHEN page_id % 10 = 0 THEN 'failed' ELSE 'processed' END AS outcome FROM pages"
    return o


def oracle_sql() -> dict[str, str]:
    return _sql()
