"""How the given tables play filings, texts, responses and requests.

The expressions are SQL that Spark and DuckDB both read, so queries and oracles start from the
same rows; only the operators under test differ.
"""

# Words that occur in the invented prose of `documents` and `pages`.
TAXONOMY = {
    "Licence Notice": {"relevant": True, "description": "Rights and licence lines",
                       "keywords": ["license", "rights", "all rights", "MIT"]},
    "French Prose": {"relevant": True, "description": "Typical of {French} text",
                     "keywords": ["les", "que", "tion", "elle", "de la"]},
    "German Prose": {"relevant": False, "description": "Typical of German text",
                     "keywords": ["und", "der", "ver", "nicht", "sch"]},
    "Spanish Prose": {"relevant": True, "description": "Typical of Spanish text",
                      "keywords": ["para", "los", "con", "por"]},
    "Plain Event": {"relevant": True, "description": "Typical of English text",
                    "keywords": ["the", "for", "ther", "and the", "tion"]},
    "Other": {"relevant": False, "description": "", "keywords": []},
}

# Labels that overlap with events.event_type exactly, partly, or not at all.
EVENT_TAXONOMY = {
    "Page View": {"relevant": True, "description": "A page was seen", "keywords": ["view"]},
    "click": {"relevant": True, "description": "Something was pressed", "keywords": []},
    "Pur": {"relevant": True, "description": "Start of a purchase", "keywords": ["buy", "pay"]},
    "PURCHASE": {"relevant": True, "description": "A purchase", "keywords": ["order"]},
    "Sign": {"relevant": False, "description": "A signup", "keywords": []},
    "Other": {"relevant": False, "description": "Everything else", "keywords": []},
}

FORM = (
    "CASE WHEN o_orderpriority = '1-URGENT' THEN '8-K'"
    " WHEN o_orderpriority = '2-HIGH' THEN '8-K/A' ELSE '10-Q' END"
)
ORDER_DAY = "cast(o_orderdate AS date)"
ORDER_DATE = f"cast({ORDER_DAY} AS string)"
ACCESSION = (
    "concat(lpad(cast(o_custkey AS string), 10, '0'), '-',"
    f" substring({ORDER_DATE}, 3, 2), '-', cast(o_orderkey AS string))"
)
COMPANY_CIK = "cast(o_custkey % 25 AS string)"
COMPANY_NAME = "CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE concat('Company ', cast(o_custkey AS string)) END"

# The date of an order in five spellings, two of them no dates.
LOOSE_DATE = f"""CASE o_orderkey % 6
    WHEN 0 THEN {ORDER_DATE}
    WHEN 1 THEN concat(cast(year({ORDER_DAY}) AS string), '-', cast(month({ORDER_DAY}) AS string),
                       '-', cast(day({ORDER_DAY}) AS string))
    WHEN 2 THEN replace({ORDER_DATE}, '-', '/')
    WHEN 3 THEN concat(cast(year({ORDER_DAY}) AS string), '-13-01')
    WHEN 4 THEN concat({ORDER_DATE}, ' ')
    ELSE concat(cast(year({ORDER_DAY}) AS string), '-02-',
                cast(28 + o_orderkey % 3 AS string)) END"""

REQUEST_NAME = """CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'nowhere'
    ELSE concat('nation_', cast(c_nationkey AS string)) END"""
REQUEST_CIK = "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE cast(c_custkey AS string) END"

FLAG = "CASE WHEN value > 20 THEN 'true' ELSE 'false' END"
RESPONSE = f"""CASE event_id % 14
    WHEN 0 THEN concat('Event Type: ', event_type, ', Relevant: ', {FLAG})
    WHEN 1 THEN concat('REASONING:', chr(10), 'The  value', chr(10), 'was ', cast(user_id AS string),
                       '.', chr(10), chr(10), 'CLASSIFICATION:', chr(10), 'event type:  ',
                       upper(event_type), ' ,  relevant: ', upper({FLAG}))
    WHEN 2 THEN concat('Type: ', event_type, ', Relevant: ', {FLAG}, chr(10), 'Because: user ',
                       cast(user_id AS string), ' did it', chr(10), 'and more')
    WHEN 3 THEN concat('Classification: ', event_type, ', Significant: ', {FLAG})
    WHEN 4 THEN concat(event_type, ': ', CASE WHEN value > 20 THEN 'yes' ELSE 'no' END)
    WHEN 5 THEN concat('**Event Type:** ', event_type, ', **Relevant:** true')
    WHEN 6 THEN concat('no idea about user ', cast(user_id AS string))
    WHEN 7 THEN 'Note: none'
    WHEN 8 THEN concat('**REASONING:** weighed', chr(10), '**CLASSIFICATION:**', chr(10),
                       'Event Type: ', event_type, ', Relevant: ', {FLAG}, ' indeed')
    WHEN 9 THEN ''
    WHEN 10 THEN NULL
    WHEN 11 THEN concat('Event Type: ', chr(160), event_type, chr(160), chr(10), ', Relevant: true')
    WHEN 12 THEN concat('Analysis: short one. Event Type: ', event_type, ' of user, Relevant: false',
                        chr(10), 'Explanation: none')
    ELSE 'Event Type:  , Relevant: true' END"""

# A stored result for each event; some break the schema.
RESULT_LABEL = """CASE WHEN event_id % 17 = 0 THEN 'Unheard Of' WHEN event_id % 19 = 0 THEN NULL
    WHEN event_type = 'click' THEN 'click' WHEN event_type = 'purchase' THEN 'PURCHASE'
    WHEN event_type = 'view' THEN 'Page View' ELSE 'Other' END"""
STATED = "value > 20"
CONFIDENCE = "CASE WHEN event_id % 23 = 0 THEN 1.5 ELSE 0.8 END"

VERDICT = """CASE turn % 4
    WHEN 0 THEN concat('REASONING:', chr(10), replace(text, ':', ' '), chr(10), 'Status: VALID', chr(10), 'Issues: none')
    WHEN 1 THEN concat('Status: [INVALID]', chr(10), 'Issues:  ', role, chr(10), '  says ',
                       text, ' ')
    WHEN 2 THEN concat('**Status:** invalid', chr(10), '**Issues:** ', cast(conv_id AS string), ' ', text)
    ELSE text END"""

# Documents with lines for every cleaning rule behind their own text.
NOISY_TEXT = """concat(text, chr(10), CASE doc_id % 8
    WHEN 0 THEN '  --==**.. __ '
    WHEN 1 THEN '  123456789012345 '
    WHEN 2 THEN concat('Attached to this form', chr(160), '  8-k of the year')
    WHEN 3 THEN concat(chr(160), 'nine char', chr(10), 'ten chars!', chr(9))
    WHEN 4 THEN concat('Washington, the capital, D.C.', chr(9), '20549 and more')
    WHEN 5 THEN concat('xbrl instance of the document', chr(10), chr(10), 'the edgarton  and   other names')
    WHEN 6 THEN concat('a', chr(9), chr(9), 'long  line', chr(9), 'with tabs', chr(10), '☑ ticked by the clerk')
    ELSE concat('commission FILE number 001-2', chr(10), '1234567890 is not only digits') END)"""

# Pages with pieces of a filing behind them, and the same pages without the pieces to be dropped.
FILING_HTML = """concat(html, CASE page_id % 7
    WHEN 0 THEN '<TABLE><tr><td>Filing <b>Detail</b></td><td>a long cell in a dropped table</td></TABLE>'
    WHEN 1 THEN '<div class="x page-header y"><div>a long line in a dropped block</div>more of that</div>'
    WHEN 2 THEN '<table><tr><td>a long cell in a kept table</td></tr></table>'
    WHEN 3 THEN '<p>Washington, D.C. 20549</p><noscript>a long line without scripts</noscript>'
    WHEN 4 THEN '<div id=main>a long line in a kept block<nav>a long way around</nav></div>'
    WHEN 5 THEN '<table><tr><td><table><td>Document Format Files</td></table></td><td>a long outer cell</td></tr></table>'
    ELSE '<TYPE>EX-99.1<DIV ID="mailer"><p>a long postal address line</p></DIV>the end of the page' END)"""
SHOWN_HTML = """concat(html, CASE page_id % 7
    WHEN 2 THEN '<table><tr><td>a long cell in a kept table</td></tr></table>'
    WHEN 4 THEN '<div id=main>a long line in a kept block</div>'
    WHEN 6 THEN '<TYPE>EX-99.1<p>the end of the page</p>'
    ELSE '' END)"""

# A page as a full submission: the page, and a picture as it is encoded there.
SUBMISSION = """concat('<SEC-DOCUMENT>', chr(10), '<SEC-HEADER>a long line in the header</SEC-HEADER>', chr(10),
    '<DOCUMENT>', chr(10), '<TYPE>8-K', chr(10), '<SEQUENCE>1', chr(10), '<FILENAME>page.htm', chr(10),
    '<DESCRIPTION>', url, chr(10), '<TEXT>', chr(10), html, chr(10), '</TEXT>', chr(10), '</DOCUMENT>', chr(10),
    'a long line between documents', chr(10), '<document>', chr(10), '<type>GRAPHIC', chr(10), '<sequence>two', chr(10),
    '<filename> picture.jpg ', chr(10), '<text>', chr(10), 'begin 644 picture.jpg', chr(10), 'M', cast(page_id AS string),
    chr(10), '</text>', chr(10), '</document>', chr(10), '</SEC-DOCUMENT>')"""

# Pages, some of which are pictures.
PAGE_OR_PICTURE = "CASE WHEN page_id % 11 = 3 THEN concat('begin 644 page.gif', chr(10), html) ELSE html END"

# The name of a customer in capitals, with more around it, or the end of it, which others may have.
CUSTOMER_LABEL = """CASE c_custkey % 5 WHEN 0 THEN upper(c_name) WHEN 1 THEN concat('see  ', c_name, '! ')
    WHEN 2 THEN substring(c_name, length(c_name) - 1) WHEN 3 THEN '' ELSE concat('no ', c_mktsegment) END"""
