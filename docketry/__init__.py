"""Filing-event analytics on Spark: select, clean, prompt, parse, classify, store, summarise."""

from docketry.functions.lines import clean_lines
from docketry.operators.attempts import attempt_report, first_valid
from docketry.operators.checks import parse_validation, schema_violations, strategy_consensus
from docketry.operators.extraction import extract_text, line_drop_reasons
from docketry.operators.filings import (
    attach_content, chosen_copies, date_window, explode_filings, filing_key, filter_dates, filter_form,
    last_days, merge_windows, one_document_each, preview, request_window, resolve_company, select_filings, split_dated,
    split_windows,
    to_metadata, with_document_url,
)
from docketry.operators.keywords import keyword_classify, keyword_hits, with_keyword_hits
from docketry.operators.packages import split_submission
from docketry.operators.prompts import (
    basic_prompt, cot_prompt, detailed_prompt, fan_out_strategies, few_shot_prompt,
    render_prompt, render_validation_prompt, taxonomy_text,
)
from docketry.operators.relevance import apply_relevance, relevance_conflicts
from docketry.operators.reports import (
    batch_summary, event_counts, observe_summary, observed_summary, render_report, with_month,
)
from docketry.operators.responses import normalize_labels, parse_responses, split_valid
from docketry.operators.scoring import score
from docketry.plans.classify import (
    classify, classify_documents, filing_status, process_filings, to_classifications,
    filing_texts, to_document_result, unclassified,
)
from docketry.plans.selection import Found, find_filings, find_filings_checked
from docketry.sinks.counts import maintained_counts
from docketry.sinks.tables import (
    read_classifications, read_metadata, vacuum, write_classifications, write_metadata,
)
from docketry.sources.companies import companies_listing, popular_companies, read_companies
from docketry.sources.files import (
    list_documents, read_documents, read_metadata_files, read_results, read_submissions,
    with_accession, with_source_type,
)
from docketry.sources.taxonomy import (
    default_taxonomy, load_taxonomy, read_taxonomy, taxonomy_from_dict,
)

