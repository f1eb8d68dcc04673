"""Plain SQL for DuckDB with the same results as the queries of the same name.

Regular expressions here are RE2's: no lookahead, and blanks beyond ASCII are spelled out.
"""

from __future__ import annotations

from string import Formatter

from docketry.functions import templates
from docketry.functions.lines import NOISE_PATTERNS
from docketry.operators.responses import LABEL_PATTERNS, PLAIN_REASONING_PATTERNS, REASONING_PATTERNS
from workload import inputs as i

ORACLES: dict[str, str] = {}

BLANKS = (
    r"\s\v\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
BLANK = f"[{BLANKS}]"


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def squeeze(expr: str) -> str:
    return f"regexp_replace({expr}, '{BLANK}+', ' ', 'g')"


def search(expr: str, pattern: str, group: int, flags: str = "(?i)") -> str:
    pattern = flags + pattern.replace(r"\s", BLANK)
    return f"nullif(regexp_extract({expr}, {text(pattern)}, {group}), '')"


NOISE = text("(?i)" + "|".join(p.replace(r"\s", BLANK) for p in NOISE_PATTERNS))
RULE = rf"'^[{BLANKS}\-_=*.]+$'"
DIGITS = r"'^\pNd+$'".replace("pNd", "p{Nd}")


def lines(expr: str) -> str:
    return f"list_transform(string_split({expr}, chr(10)), lambda x: {strip('x')})"


def clean(expr: str) -> str:
    kept = (
        f"list_filter({lines(expr)}, lambda x: length(x) >= 10 AND NOT regexp_matches(x, {RULE})"
        f" AND NOT regexp_matches(x, {DIGITS}) AND NOT regexp_matches(x, {NOISE}))"
    )
    return strip(f"regexp_replace(array_to_string({kept}, chr(10)), '[ \\t]+', ' ', 'g')")


def page_text(html: str) -> str:
    """Enough for the regular markup of `pages`."""
    for name in ("head", "nav", "script", "style"):
        html = f"regexp_replace({html}, '(?is)<{name}\\b.*?</{name}>', chr(10), 'g')"
    html = f"regexp_replace({html}, '(?s)<!--.*?-->', chr(10), 'g')"
    html = f"regexp_replace({html}, '<[^>]*>', chr(10), 'g')"
    for name, character in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        html = f"regexp_replace({html}, '&{name};?', '{character}', 'g')"
    return clean(html)


def values(taxonomy: dict) -> str:
    rows = ", ".join(
        f"({n}, {text(label)}, {str(entry['relevant']).lower()})"
        for n, (label, entry) in enumerate(taxonomy.items())
    )
    return f"(VALUES {rows}) AS tax(ordinal, event_type, relevant)"


# --- filings -----------------------------------------------------------------------------

KEYS = """lpad(cast(o_custkey AS string), 10, '0')"""
INDEX = f"""
    SELECT {KEYS} AS cik, coalesce({i.COMPANY_NAME}, 'Unknown') AS company_name, o_orderkey,
           {i.FORM} AS form, {i.ORDER_DATE} AS filing_date, {i.ACCESSION} AS accession_number, 0 AS position
    FROM orders
    UNION ALL
    SELECT {KEYS}, coalesce({i.COMPANY_NAME}, 'Unknown'), o_orderkey,
           '8-K/A', {i.ORDER_DATE}, concat({i.ACCESSION}, '-A'), 1
    FROM orders
    UNION ALL
    SELECT {KEYS}, coalesce({i.COMPANY_NAME}, 'Unknown'), o_orderkey, '8-K',
           cast({i.ORDER_DAY} + 30 AS string),
           CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE concat({i.ACCESSION}, '-L') END, 2
    FROM orders"""

FILE_KEY = "concat(filing_date, '_', replace(accession_number, '-', ''), '_8k')"
URL = (
    "concat('https://www.sec.gov/Archives/edgar/data/', cik, '/',"
    " replace(accession_number, '-', ''), '/', accession_number, '.txt')"
)

ORACLES["filings_explode_filter"] = f"""
WITH rows AS ({INDEX})
SELECT cik, company_name, filing_date, accession_number, {FILE_KEY} AS filename,
       concat(cik, '_', {FILE_KEY}) AS directory, {URL} AS document_url,
       cast(position AS bigint) AS position
FROM rows
WHERE form = '8-K' AND accession_number IS NOT NULL
  AND filing_date BETWEEN '1995-01-01' AND '1997-06-30'"""

ORACLES["filings_quarantine"] = f"""
WITH rows AS ({INDEX})
SELECT cik, form, count(*) AS n_broken FROM rows
WHERE accession_number IS NULL GROUP BY cik, form"""

ORACLES["submissions_landed"] = f"""
WITH rows AS ({INDEX})
SELECT cik, company_name, form, count(*) AS n_filings, min(filing_date) AS first_date,
       count(accession_number) AS n_keys
FROM rows GROUP BY cik, company_name, form"""

ORACLES["filings_last_days"] = f"""
SELECT o_orderkey, {i.ORDER_DATE} AS filing_date FROM orders
WHERE {i.ORDER_DAY} BETWEEN date '1997-08-01' - 45 AND date '1997-08-01'"""

ORACLES["date_normalize"] = f"""
SELECT o_orderkey,
       CASE WHEN regexp_full_match(raw, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}')
            THEN strftime(try_strptime(raw, '%Y-%m-%d'), '%Y-%m-%d') END AS filing_date
FROM (SELECT o_orderkey, {i.LOOSE_DATE} AS raw FROM orders)"""

ORACLES["companies_listing"] = """
SELECT concat(upper(substring(name, 1, 1)), lower(substring(name, 2))) AS name, cik
FROM (SELECT concat(lower(p_brand), ' ', p_type) AS name, cast(p_partkey AS string) AS cik FROM part)"""

REQUESTS = f"""
    SELECT c_custkey, q.name, CASE WHEN q.name IS NULL THEN q.cik ELSE cast(n.n_nationkey AS string) END AS cik
    FROM (SELECT c_custkey, {i.REQUEST_NAME} AS name, {i.REQUEST_CIK} AS cik FROM customer) q
    LEFT JOIN nation n ON lower(n.n_name) = q.name"""
ORACLES["company_resolve"] = f"""
SELECT c_custkey, name, lpad(cik, 10, '0') AS cik FROM ({REQUESTS}) WHERE cik IS NOT NULL"""
ORACLES["company_unresolved"] = f"""
SELECT c_custkey, name FROM ({REQUESTS}) WHERE cik IS NULL"""

ORACLES["filings_for_requests"] = f"""
WITH wanted AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 3 = 0 THEN date '1997-08-01' - 60 ELSE date '1996-02-01' END AS start_day,
         CASE WHEN c_custkey % 3 = 0 OR c_custkey % 2 = 0 THEN date '1997-08-01'
              ELSE date '1996-12-31' END AS end_day
  FROM customer)
SELECT o_orderkey, {KEYS} AS cik FROM orders
WHERE EXISTS (SELECT 1 FROM wanted WHERE c_custkey = o_custkey
              AND {i.ORDER_DAY} BETWEEN start_day AND end_day)"""

ORDER_FILINGS = f"""
    SELECT lpad({i.COMPANY_CIK}, 10, '0') AS cik, coalesce({i.COMPANY_NAME}, 'Unknown') AS company_name,
           {i.FORM} AS form, {i.ORDER_DATE} AS filing_date, {i.ACCESSION} AS accession_number,
           o_orderkey, o_custkey
    FROM orders"""
ORACLES["filings_metadata"] = f"""
SELECT cik, company_name, form, filing_date, accession_number, {URL} AS document_url,
       {FILE_KEY} AS filename
FROM ({ORDER_FILINGS})"""
ORACLES["filings_preview"] = f"""
SELECT filing_date, accession_number, count(*) OVER () AS n_selected
FROM ({ORDER_FILINGS}) WHERE form = '8-K'"""

ORACLES["attach_content_status"] = """
SELECT cast(o_orderkey AS string) AS accession_number, length(text) AS content_length
FROM orders LEFT JOIN documents ON o_orderkey = doc_id * 3"""

ORACLES["filing_status"] = """
SELECT cast(d.doc_id AS string) AS accession_number, lang,
       CASE WHEN l.doc_id IS NULL THEN NULL WHEN quality = 1 THEN 'Plain Event' ELSE 'Other' END AS event_type,
       toxic = 0 AS relevant, l.doc_id IS NOT NULL AS classified
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
ORACLES["filings_unclassified"] = """
SELECT cast(doc_id AS string) AS accession_number, lang FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""

ORACLES["source_type"] = r"""
SELECT page_id, address,
       CASE WHEN regexp_matches(address, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+') THEN 'URL'
            ELSE 'File' END AS source_type
FROM (SELECT page_id,
             CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN replace(url, '://', ':/')
                  WHEN 2 THEN concat('C:/landed/', url) ELSE replace(url, 'http', 'ftp+x') END AS address
      FROM pages)"""

ORACLES["documents_landed"] = """
SELECT page_id, length(html) + 1 AS n_characters, md5(html || chr(10)) AS html_md5 FROM pages"""
ORACLES["documents_listing"] = "SELECT page_id, strlen(html) + 1 AS length FROM pages"
ORACLES["results_landed"] = """
SELECT cast(doc_id AS string) AS accession_number, CASE WHEN quality = 1 THEN 'Plain Event' ELSE 'Other' END AS event_type,
       toxic = 0 AS relevant, 'as labelled' AS reasoning, cast(0.8 AS double) AS confidence,
       'detailed' AS prompt_strategy, '2024-01-01' AS classification_timestamp
FROM labels"""

# --- text --------------------------------------------------------------------------------

ORACLES["extract_text_pages"] = f"""
SELECT page_id, length(text) AS text_length, substring(text, 1, 200) AS sample, md5(text) AS text_md5
FROM (SELECT page_id, {page_text('html')} AS text
      FROM (SELECT page_id, {i.SHOWN_HTML} AS html FROM pages))"""

PICTURE = "'ValueError: an encoded attachment, not text'"
ORACLES["submission_documents"] = f"""
WITH packed AS (
  SELECT page_id * 2 AS key, 1 AS position, '8-K' AS doc_type, 1 AS sequence, 'page.htm' AS filename, url AS description,
         md5({page_text('html')}) AS text_md5, NULL AS read_error FROM pages
  UNION ALL
  SELECT page_id * 2, 2, 'GRAPHIC', NULL, 'picture.jpg', NULL, NULL, {PICTURE} FROM pages)
SELECT cast(o_orderkey AS string) AS accession_number, {i.FORM} AS form, cast(position AS bigint) AS position, doc_type,
       cast(sequence AS bigint) AS sequence, filename, description, text_md5, read_error
FROM orders JOIN packed ON o_orderkey = key"""

ORACLES["clean_lines_documents"] = f"""
SELECT doc_id, length(text) AS text_length, md5(text) AS text_md5
FROM (SELECT doc_id, {clean('text')} AS text
      FROM (SELECT doc_id, {i.NOISY_TEXT} AS text FROM documents))"""

ORACLES["line_drop_reasons"] = f"""
SELECT CASE WHEN line = '' THEN 'empty'
            WHEN regexp_matches(line, {RULE}) THEN 'rule'
            WHEN regexp_matches(line, {DIGITS}) THEN 'digits'
            WHEN length(line) < 10 THEN 'short'
            WHEN regexp_matches(line, {NOISE}) THEN 'noise'
            ELSE 'kept' END AS reason, count(*) AS n_lines
FROM (SELECT unnest({lines('text')}) AS line
      FROM (SELECT {i.NOISY_TEXT} AS text FROM documents)) GROUP BY 1"""

# --- prompts -----------------------------------------------------------------------------

ORACLES["taxonomy_text"] = """
WITH kinds AS (SELECT event_type, count(*) AS n, min(event_id) AS first FROM events GROUP BY event_type)
SELECT string_agg(event_type, ', ' ORDER BY first) AS labels,
       string_agg(concat('- ', event_type, ': ', n, ' events',
                         CASE WHEN event_type = 'view' THEN ''
                              ELSE concat(' (Keywords: ', lower(event_type), ', ', upper(event_type), ')') END),
                  chr(10) ORDER BY first) AS label_lines
FROM kinds"""

ORACLES["taxonomy_file"] = """
SELECT row_number() OVER (ORDER BY first) - 1 AS ordinal, event_type, relevant, description, keywords
FROM (SELECT event_type, min(event_id) AS first, avg(value) > 20 AS relevant,
             concat(count(*), ' events') AS description,
             CASE WHEN event_type = 'view' THEN ''
                  ELSE concat(lower(event_type), '|', upper(event_type)) END AS keywords
      FROM events GROUP BY event_type)"""

LABELS = text(", ".join(i.TAXONOMY))
LABEL_LINES = text(
    "\n".join(
        f"- {label}: {entry['description']}"
        + (f" (Keywords: {', '.join(entry['keywords'])})" if entry["keywords"] else "")
        for label, entry in i.TAXONOMY.items()
    )
)
EXAMPLE_LINES = [
    line
    for n, example in enumerate(templates.DEFAULT_EXAMPLES, 1)
    for line in (
        f"Example {n}:", f"Text: {example['text']}", "REASONING:", example["reasoning"],
        "CLASSIFICATION:", example["classification"], "",
    )
]


def prompt(template: str, **slots: str) -> str:
    slots = {"labels": LABELS, "label_lines": LABEL_LINES,
             "examples": text("\n".join(EXAMPLE_LINES)), "text": "text", **slots}
    parts = []
    for literal, slot, _, _ in Formatter().parse(template):
        parts += [text(literal)] if literal else []
        parts += [slots[slot]] if slot else []
    return "(" + " || ".join(parts) + ")"


def prompt_facts(expr: str, source: str = "documents", keys: str = "doc_id") -> str:
    return f"""
SELECT {keys}, length(prompt) AS prompt_length, md5(prompt) AS prompt_md5
FROM (SELECT {keys}, {expr} AS prompt FROM {source})"""


for _name, _template in templates.STRATEGIES.items():
    ORACLES[f"prompt_{_name}"] = prompt_facts(prompt(_template))

_BLOCK = (
    "concat('Example ', n, ':', chr(10), 'Text: ', source, chr(10), 'REASONING:', chr(10),"
    f" CASE WHEN doc_id % 2 = 0 THEN lang ELSE {text(templates.STOCK_REASONING)} END, chr(10),"
    " 'CLASSIFICATION:', chr(10), 'Event Type: Other, Relevant: false', chr(10))"
)
ORACLES["prompt_few_shot_own_examples"] = prompt_facts(
    prompt(
        templates.FEW_SHOT,
        examples="CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN {0} ELSE concat({0}, chr(10), {1}) END".format(
            _BLOCK.replace(" n,", " '1',"), _BLOCK.replace(" n,", " '2',")
        ),
    )
)
ORACLES["prompt_validation"] = prompt_facts(
    prompt(
        templates.VALIDATION,
        classification="concat('Event Type: ', lang, ', Relevant: {true}')",
    )
)
ORACLES["strategy_fan_out"] = "\nUNION ALL\n".join(
    prompt_facts(prompt(template), f"(SELECT doc_id, text, '{name}' AS strategy FROM documents)",
                 "doc_id, strategy")
    for name, template in templates.STRATEGIES.items()
)

# --- responses ---------------------------------------------------------------------------

_LABELS = "[" + ", ".join(text(label) for label in i.EVENT_TAXONOMY) + "]"

def first(patterns: tuple[str, ...], group: int, flags: str = "(?i)") -> str:
    return "coalesce(" + ", ".join(search("response", p, group, flags) for p in patterns) + ")"


def canonical(label: str) -> str:
    return f"""coalesce(
        list_filter({_LABELS}, lambda t: lower(t) = lower({label}))[1],
        list_filter({_LABELS}, lambda t: contains(lower({label}), lower(t))
                                      OR contains(lower(t), lower({label})))[1])"""


# RE2 has no lookahead; what follows a section may as well be part of the match.
SECTIONS = tuple(p.replace("(?=", "(?:") for p in REASONING_PATTERNS)
PARSED = f"""
    SELECT *, CASE WHEN coalesce(response, '') = '' THEN 'empty_response'
                   WHEN given IS NULL THEN 'no_match'
                   WHEN known IS NULL THEN 'unknown_label' ELSE 'ok' END AS parse_status
    FROM (SELECT *, CASE WHEN given IS NOT NULL THEN {canonical('given')} END AS known
          FROM (SELECT *, {strip(first(LABEL_PATTERNS, 1))} AS given,
                       lower({first(LABEL_PATTERNS, 2)}) IN ('true', 'yes') AS stated_relevant,
                       coalesce(
                         nullif({squeeze(strip(first(SECTIONS, 1, '(?is)')))}, ''),
                         {strip(first(PLAIN_REASONING_PATTERNS, 1, '(?is)'))},
                         '') AS reasoning_text
                FROM (SELECT *, {i.RESPONSE} AS response FROM events)))"""

ORACLES["parse_responses"] = f"""
SELECT event_id, parse_status, given = '' AS blank_label, stated_relevant, known AS label,
       CASE WHEN parse_status = 'ok' THEN cast(0.8 AS double) END AS confidence,
       CASE WHEN parse_status = 'ok' THEN reasoning_text END AS reasoning,
       CASE WHEN parse_status = 'ok' THEN response END AS raw_response
FROM ({PARSED})"""
ORACLES["response_quarantine"] = f"""
SELECT parse_status, substring(response, 1, 100) AS response_start, md5(response) AS response_md5, count(*) AS n_rejected
FROM ({PARSED}) WHERE parse_status <> 'ok' GROUP BY 1, 2, 3"""
ORACLES["result_json_text"] = f"""
SELECT event_id, cast(json_object('event_type', known, 'relevant', stated_relevant,
           'confidence', cast(0.8 AS double), 'reasoning', reasoning_text, 'raw_response', response)
           AS string) AS result_json
FROM ({PARSED}) WHERE parse_status = 'ok'"""

ORACLES["normalize_labels"] = f"""
SELECT event_id, given, {canonical(strip('given'))} AS label
FROM (SELECT event_id,
             CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN upper(event_type)
                  WHEN 2 THEN concat('  ', event_type, ' event')
                  ELSE substring(event_type, 1, 2) END AS given FROM events)"""

ORACLES["normalize_many_labels"] = f"""
WITH given AS (SELECT c_custkey, given, lower({strip('given')}) AS low FROM (SELECT c_custkey, {i.CUSTOMER_LABEL} AS given FROM customer)),
lows AS (SELECT DISTINCT low FROM given),
met AS (SELECT l.low, arg_min(c.c_name, (lower(c.c_name) <> l.low, c.c_custkey)) AS label
        FROM lows l JOIN customer c ON contains(l.low, lower(c.c_name)) OR contains(lower(c.c_name), l.low) GROUP BY l.low)
SELECT c_custkey, given, label FROM given LEFT JOIN met USING (low)"""

ATTEMPTS = f"SELECT *, event_id // 4 AS doc_id, event_id % 4 + 1 AS attempt FROM ({PARSED})"
ORACLES["first_valid_attempt"] = f"""
SELECT doc_id, attempt, known AS label, response AS raw_response FROM ({ATTEMPTS})
WHERE parse_status = 'ok' AND attempt <= 3
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY attempt) = 1"""
ORACLES["attempt_report"] = f"""
SELECT doc_id, coalesce(bool_or(parse_status = 'ok'), false) AS solved,
       coalesce(min(attempt) FILTER (parse_status = 'ok'), count(*)) AS attempts_used,
       CASE WHEN NOT bool_or(parse_status = 'ok') THEN arg_max(parse_status, attempt) END AS failure
FROM ({ATTEMPTS}) WHERE attempt <= 3 GROUP BY doc_id"""

RESULTS = f"""
    SELECT event_id, user_id, ts, {i.RESULT_LABEL} AS event_type, {i.STATED} AS stated_relevant,
           cast({i.CONFIDENCE} AS double) AS confidence FROM events"""
RATED = f"""
    SELECT r.*, coalesce(tax.relevant, stated_relevant) AS relevant
    FROM ({RESULTS}) r LEFT JOIN {values(i.EVENT_TAXONOMY)} ON r.event_type = tax.event_type"""
ORACLES["relevance_override"] = f"""
SELECT event_id, event_type, stated_relevant, relevant FROM ({RATED})"""
ORACLES["relevance_conflicts"] = f"""
SELECT event_type, stated_relevant, relevant, count(*) AS n_conflicts FROM ({RATED})
WHERE stated_relevant <> relevant GROUP BY 1, 2, 3"""

ANSWER = (
    "concat('REASONING: ', n, ' characters CLASSIFICATION: Event Type: Plain, Relevant: false')"
)
ORACLES["score_prompts"] = f"""
SELECT doc_id,
       CASE n % 5 WHEN 0 THEN NULL WHEN 1 THEN 'I cannot tell' WHEN 2 THEN '' ELSE {ANSWER} END AS response,
       CASE WHEN n % 5 = 0 THEN 'RuntimeError: no answer' END AS error
FROM (SELECT doc_id, length({prompt(templates.BASIC)}) AS n FROM documents)"""

OUTCOME = """
       CASE WHEN blank THEN 'empty_text' WHEN n % 5 >= 3 THEN 'classified' ELSE 'unclassified' END AS status,
       CASE WHEN blank THEN NULL WHEN n % 5 = 0 THEN 'RuntimeError: no answer'
            WHEN n % 5 = 1 THEN 'no_match' WHEN n % 5 = 2 THEN 'empty_response' END AS failure"""
ORACLES["score_prompts_batched"] = ORACLES["score_prompts"]

# The answer of attempt k is valid where (n + k) % 5 is 3 or 4.
ORACLES["classify_documents"] = f"""
SELECT doc_id, CASE WHEN blank THEN 'empty_text' WHEN solved THEN 'classified' ELSE 'unclassified' END AS status,
       CASE WHEN NOT blank AND NOT solved THEN 'empty_response' END AS failure,
       CASE WHEN NOT blank AND solved THEN false END AS stated_relevant,
       CASE WHEN blank THEN 0 WHEN n % 5 IN (2, 3) THEN 1 WHEN n % 5 = 1 THEN 2 ELSE 3 END AS attempts,
       CASE WHEN NOT blank AND solved THEN 'Plain Event' END AS event_type,
       CASE WHEN NOT blank AND solved THEN true END AS relevant,
       CASE WHEN NOT blank AND solved THEN concat(n, ' characters') END AS reasoning
FROM (SELECT doc_id, length({prompt(templates.COT)}) AS n, n % 5 <> 4 AS solved,
             NOT regexp_matches(text, '[^{BLANKS}]') AS blank
      FROM (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN ' ' ELSE text END AS text FROM documents))"""

PROCESSED = f"""
WITH texts AS (
  SELECT o_orderkey, coalesce(html, '') = '' AS missing, coalesce(page_id % 11 = 3, false) AS picture, text
  FROM orders LEFT JOIN (SELECT page_id, page_id * 2 AS key, html, {page_text('html')} AS text FROM pages)
       ON o_orderkey = key),
sized AS (SELECT *, length({prompt(templates.BASIC)}) AS n,
                 picture OR coalesce(NOT regexp_matches(text, '[^{BLANKS}]'), true) AS blank FROM texts),
outcomes AS (SELECT *, {OUTCOME} FROM sized),
judged AS (SELECT cast(o_orderkey AS string) AS accession_number,
                  CASE WHEN missing THEN 'no_content' WHEN picture THEN 'unreadable' ELSE status END AS status,
                  CASE WHEN picture THEN {PICTURE} ELSE failure END AS failure FROM outcomes)"""
ORACLES["process_filings_pages"] = f"""
{PROCESSED}
SELECT *, CASE WHEN status = 'classified' THEN 'Plain Event' END AS event_type,
       CASE WHEN status = 'classified' THEN true END AS relevant
FROM judged"""
ORACLES["batch_summary"] = f"""
{PROCESSED}
SELECT count(*) AS found, count(*) FILTER (WHERE status <> 'unreadable') AS processed,
       count(*) FILTER (WHERE status = 'classified') AS classified,
       count(*) FILTER (WHERE status = 'unreadable') AS failed, 'basic' AS strategy
FROM judged"""

# --- evidence, checks, reports -------------------------------------------------------------


def hits(label: str) -> str:
    tests = [
        "cast(regexp_matches(text, {}) AS bigint)".format(
            text(rf"(?i)(?:^|[^\p{{L}}\p{{N}}]){word}(?:$|[^\p{{L}}\p{{N}}])")
        )
        for word in i.TAXONOMY[label]["keywords"]
    ]
    return " + ".join(tests) or "0"


def keyword_rows(source: str, key: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {key}, {n} AS ordinal, {text(label)} AS event_type,"
        f" {str(entry['relevant']).lower()} AS relevant, {hits(label)} AS hits FROM {source}"
        for n, (label, entry) in enumerate(i.TAXONOMY.items())
    )


def keyword_best(source: str, key: str) -> str:
    return f"""
    SELECT {key}, CASE WHEN hits = 0 THEN 'Other' ELSE event_type END AS event_type,
           CASE WHEN hits = 0 THEN false ELSE relevant END AS relevant, hits
    FROM ({keyword_rows(source, key)})
    QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY hits DESC, ordinal) = 1"""


ORACLES["keyword_hits"] = f"""
SELECT doc_id, event_type, hits FROM ({keyword_rows('documents', 'doc_id')}) WHERE hits > 0"""
WORD = r"'[\p{L}\p{N}]+'"
ORACLES["keyword_hits_joined"] = f"""
WITH words AS (SELECT DISTINCT lang, regexp_extract(lower(text), {WORD}) AS word FROM documents),
padded AS (SELECT doc_id, concat(' ', regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ') AS text FROM documents)
SELECT doc_id, lang AS event_type, count(*) AS hits
FROM padded JOIN words ON word <> '' AND contains(padded.text, concat(' ', word, ' ')) GROUP BY ALL"""
ORACLES["keyword_classify"] = keyword_best("documents", "doc_id")
ORACLES["classify_pages"] = f"""
WITH texts AS (SELECT page_id, {page_text('html')} AS text FROM pages)
SELECT event_type, relevant, count(*) AS n_filings FROM ({keyword_best('texts', 'page_id')})
GROUP BY 1, 2"""

ORACLES["strategy_consensus"] = f"""
WITH votes AS (SELECT user_id, event_type, count(*) AS votes FROM ({RESULTS})
               WHERE event_type IS NOT NULL GROUP BY 1, 2),
ranked AS (SELECT user_id, v.event_type, votes, sum(votes) OVER (PARTITION BY user_id) AS total,
                  row_number() OVER (PARTITION BY user_id
                                     ORDER BY votes DESC, ordinal NULLS LAST, v.event_type) AS place
           FROM votes v LEFT JOIN {values(i.EVENT_TAXONOMY)} ON v.event_type = tax.event_type)
SELECT user_id, event_type, cast(total AS bigint) AS n_strategies, votes / total AS agreement
FROM ranked WHERE place = 1"""

VERDICT_WORD = f"nullif(regexp_extract(response, '(?i)Status:[*\\[{BLANKS}]*(INVALID|VALID)', 1), '')"
ORACLES["validation_parse"] = f"""
SELECT conv_id, turn, verdict AS validation_status,
       CASE WHEN verdict = 'INVALID'
            THEN nullif({squeeze(strip(search('response', r'Issues:[*]*\s*(.+)', 1, '(?is)')))}, '') END AS issues
FROM (SELECT *, upper({VERDICT_WORD}) AS verdict
      FROM (SELECT conv_id, turn, {i.VERDICT} AS response FROM conversations))"""

ORACLES["result_schema_check"] = f"""
SELECT event_id, event_type, violation
FROM (SELECT event_id, r.event_type,
             CASE WHEN r.event_type IS NULL THEN 'missing_label'
                  WHEN tax.event_type IS NULL THEN 'unknown_label'
                  WHEN confidence NOT BETWEEN 0 AND 1 THEN 'bad_confidence' END AS violation
      FROM ({RESULTS}) r LEFT JOIN {values(i.EVENT_TAXONOMY)} ON r.event_type = tax.event_type)
WHERE violation IS NOT NULL"""

ORACLES["event_counts_month"] = f"""
SELECT user_id, strftime(ts, '%Y-%m') AS month, event_type, relevant, count(*) AS n_filings
FROM ({RATED}) GROUP BY 1, 2, 3, 4"""
ORACLES["event_counts_totals"] = f"""
SELECT month, event_type, relevant, count(*) AS n_filings
FROM (SELECT *, strftime(ts, '%Y-%m') AS month FROM ({RATED}))
GROUP BY ROLLUP (month, event_type, relevant)"""
_RULE = "=" * 60
ORACLES["report_text"] = f"""
SELECT input_source, 'URL' AS source_type, length(text) AS text_length, md5(text) AS text_md5,
       concat('{_RULE}', chr(10), '8-K FILING CLASSIFICATION RESULTS', chr(10), '{_RULE}', chr(10),
              'Source: ', input_source, chr(10), 'Asked by: cot', chr(10),
              'Text Length: ', format('{{:,}}', length(text)), ' characters', chr(10),
              'Event Type: ', lang, chr(10),
              'Relevant: ', CASE WHEN doc_id % 2 = 0 THEN 'Yes' ELSE 'No' END, chr(10),
              'Confidence: ', printf('%.1f%%', 80.0),
              CASE WHEN doc_id % 3 = 0 THEN ''
                   ELSE concat(chr(10), chr(10), 'Why:', chr(10), source) END,
              chr(10), chr(10), 'Answer as given:', chr(10), 'raw ', lang, chr(10), chr(10), '{_RULE}') AS report
FROM (SELECT *, concat('https://example.org/', source) AS input_source FROM documents)"""

# --- stored and streamed ---------------------------------------------------------------------

ORACLES["metadata_upsert"] = f"""
SELECT cik, company_name,
       CASE WHEN o_custkey % 25 < 5 AND o_orderkey % 2 = 0 THEN '8-K/A' ELSE form END AS form,
       filing_date, accession_number, {URL} AS document_url, {FILE_KEY} AS filename
FROM ({ORDER_FILINGS})"""
ORACLES["classification_upsert"] = f"""
SELECT accession_number, form AS event_type, o_orderkey % 3 = 0 AS relevant,
       company_name AS reasoning, cast(0.8 AS double) AS confidence,
       CASE WHEN form = '8-K' THEN 'cot' ELSE 'detailed' END AS prompt_strategy,
       filing_date AS classification_timestamp, cik
FROM ({ORDER_FILINGS})"""
ORACLES["event_counts_kept"] = f"""
SELECT substring(filing_date, 1, 7) AS month, CASE WHEN form = '8-K' THEN 'Corrected' ELSE form END AS event_type,
       o_orderkey % 3 = 0 AS relevant, count(*) AS n_filings
FROM ({ORDER_FILINGS}) GROUP BY ALL"""

WAVES = """
    SELECT CASE WHEN event_id % 6 < 3 THEN '1' ELSE '2' END AS cik, event_id // 6 AS accession_number,
           event_id % 10 > 0 AS usable FROM events"""
ORACLES["arrivals_dedup"] = f"SELECT DISTINCT cik, accession_number FROM ({WAVES})"
ORACLES["arrivals_marked"] = f"""
SELECT cik, accession_number, arrival, sum(n)::bigint AS n_rows
FROM (SELECT cik, accession_number,
             unnest([{{'arrival': 'first', 'n': least(count(*) FILTER (WHERE usable), 1)}},
                     {{'arrival': 'repeat', 'n': count(*) FILTER (WHERE usable) - 1}},
                     {{'arrival': 'rejected', 'n': count(*) FILTER (WHERE NOT usable)}}], recursive := true)
      FROM ({WAVES}) GROUP BY cik, accession_number)
WHERE n > 0 GROUP BY ALL"""
