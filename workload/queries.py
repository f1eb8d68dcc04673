"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps
from tempfile import mkdtemp
from urllib.parse import urlsplit
from uuid import uuid4

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import docketry as d
from docketry.functions.keys import normalize_date, pad_cik
from docketry.functions.lines import clean_lines, text_sample
from docketry.operators.responses import result_json
from docketry.streaming.arrivals import KEYED_STATE, first_arrivals, marked_arrivals, run_available
from workload import inputs as i

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shared_folder(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; a local session may have none and is given one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = mkdtemp(prefix="docketry-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with costly columns; how its files are laid out decides on the tasks."""
    return table(spark, sf_dir, name)


def prose_taxonomy(spark: SparkSession) -> DataFrame:
    return d.taxonomy_from_dict(spark, i.TAXONOMY)


def event_taxonomy(spark: SparkSession) -> DataFrame:
    return d.taxonomy_from_dict(spark, i.EVENT_TAXONOMY)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def long_length(column: str):
    return F.length(column).cast("bigint")


# --- filings -----------------------------------------------------------------------------


def submissions(orders: DataFrame) -> DataFrame:
    """Each order as a small index: the filing, its amendment and a late report."""
    date, accession = F.expr(i.ORDER_DATE), F.expr(i.ACCESSION)
    late = F.date_add(F.expr(i.ORDER_DAY), 30).cast("string")
    keys = F.array(accession, F.concat(accession, F.lit("-A")), F.concat(accession, F.lit("-L")))
    return orders.select(
        F.expr(i.COMPANY_NAME).alias("name"),
        F.expr("cast(o_custkey AS string)").alias("cik"),
        F.struct(
            F.struct(
                F.array(F.expr(i.FORM), F.lit("8-K/A"), F.lit("8-K")).alias("form"),
                F.array(date, date, late).alias("filingDate"),
                F.when(F.expr("o_orderkey % 11 = 0"), F.slice(keys, 1, 2))
                .otherwise(keys)
                .alias("accessionNumber"),
            ).alias("recent")
        ).alias("filings"),
    )


def order_filings(orders: DataFrame) -> DataFrame:
    """Each order as one filing of one of 25 companies."""
    return orders.select(
        pad_cik(F.expr(i.COMPANY_CIK)).alias("cik"),
        F.coalesce(F.expr(i.COMPANY_NAME), F.lit("Unknown")).alias("company_name"),
        F.expr(i.FORM).alias("form"),
        F.expr(i.ORDER_DATE).alias("filing_date"),
        F.expr(i.ACCESSION).alias("accession_number"),
        F.expr(i.ORDER_DAY).alias("filing_day"),
        "o_orderkey",
        "o_custkey",
    )


@query
def filings_explode_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows to dated 8-K filings with keys and addresses."""
    filings = d.filter_form(d.explode_filings(submissions(table(spark, sf_dir, "orders"))))
    dated, _ = d.split_dated(d.filter_dates(filings, "1995-01-01", "1997-06-30"))
    return d.with_document_url(d.filing_key(dated)).select(
        "cik", "company_name", "filing_date", "accession_number", "filename", "directory",
        "document_url", F.col("position").cast("bigint").alias("position"),
    )


@query
def submissions_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The indexes written as JSON lines and read back, then counted per company and form."""
    path = scratch(spark, "submissions")
    submissions(texts(spark, sf_dir, "orders")).write.json(path)
    filings = d.explode_filings(d.read_submissions(spark, path, lines=True))
    return filings.groupBy("cik", "company_name", "form").agg(
        F.count(F.lit(1)).alias("n_filings"),
        F.min("filing_date").alias("first_date"),
        F.count("accession_number").alias("n_keys"),
    )


@query
def filings_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """index rows without a usable key, counted per company and form."""
    filings = d.explode_filings(submissions(table(spark, sf_dir, "orders")))
    _, broken = d.split_dated(filings)
    return broken.groupBy("cik", "form").agg(F.count(F.lit(1)).alias("n_broken"))


@query
def filings_last_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a window that ends on a fixed day."""
    filings = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr(i.ORDER_DAY).alias("filing_day")
    )
    return d.last_days(filings, 45, "1997-08-01").select(
        "o_orderkey", F.col("filing_day").cast("string").alias("filing_date")
    )


@query
def date_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", normalize_date(F.expr(i.LOOSE_DATE)).alias("filing_date")
    )


def requests(customer: DataFrame) -> DataFrame:
    return customer.select(
        "c_custkey", F.expr(i.REQUEST_NAME).alias("name"), F.expr(i.REQUEST_CIK).alias("cik")
    )


def directory(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.lower("n_name").alias("name"), F.expr("cast(n_nationkey AS string)").alias("cik")
    )


@query
def companies_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6."""
    named = table(spark, sf_dir, "part").select(
        F.concat_ws(" ", F.lower("p_brand"), "p_type").alias("name"),
        F.expr("cast(p_partkey AS string)").alias("cik"),
    )
    return d.companies_listing(named)


@query
def company_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """requests that name a company or a cik."""
    resolved, _ = d.resolve_company(
        requests(table(spark, sf_dir, "customer")), directory(table(spark, sf_dir, "nation"))
    )
    return resolved.select("c_custkey", "name", "cik")


@query
def company_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """requests that name neither."""
    _, unresolved = d.resolve_company(
        requests(table(spark, sf_dir, "customer")), directory(table(spark, sf_dir, "nation"))
    )
    return unresolved.select("c_custkey", "name")


@query
def filings_for_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every company with its own date range."""
    filings = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        pad_cik(F.expr("cast(o_custkey AS string)")).alias("cik"),
        F.expr(i.ORDER_DAY).alias("filing_day"),
    )
    wanted = d.request_window(
        table(spark, sf_dir, "customer").select(
            pad_cik(F.expr("cast(c_custkey AS string)")).alias("cik"),
            F.expr("CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '1996-2-1' END").alias("start"),
            F.expr("CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE '1996-12-31' END").alias("end"),
        ),
        days=60,
        as_of="1997-08-01",
    )
    return d.select_filings(filings, wanted).select("o_orderkey", "cik")


@query
def filings_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F15."""
    return d.to_metadata(order_filings(table(spark, sf_dir, "orders")))


@query
def filings_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16."""
    filings = d.filter_form(order_filings(table(spark, sf_dir, "orders")))
    return d.preview(filings)


def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents keyed like orders, a quarter in two copies; those of other keys find no filing."""
    documents = table(spark, sf_dir, "documents").select(
        F.expr("cast(doc_id * 3 AS string)").alias("accession_number"), "doc_id", F.col("text").alias("html")
    )
    return with_copies(documents, "doc_id % 4 = 0", F.concat("html", F.lit(" as copied")))


def with_copies(documents: DataFrame, which: str, html) -> DataFrame:
    """Documents with a path, and second copies of some with another content."""
    path = lambda folder: F.concat(F.lit(f"{folder}/"), "accession_number").alias("path")
    first = documents.select("accession_number", path("a"), "html")
    return first.unionByName(documents.filter(which).select("accession_number", path("b"), html.alias("html")))


@query
def attach_content_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """all filings, with the length of their document if there is one."""
    filings = table(spark, sf_dir, "orders").select(
        F.expr("cast(o_orderkey AS string)").alias("accession_number")
    )
    return d.attach_content(filings, text_documents(spark, sf_dir)).select(
        "accession_number", long_length("html").alias("content_length")
    )


def label_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.expr("cast(doc_id AS string)").alias("accession_number"),
        F.expr("CASE WHEN quality = 1 THEN 'Plain Event' ELSE 'Other' END").alias("event_type"),
        F.expr("toxic = 0").alias("relevant"),
    )


def document_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.expr("cast(doc_id AS string)").alias("accession_number"), "lang"
    )


@query
def filing_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9."""
    return d.filing_status(document_keys(spark, sf_dir), label_results(spark, sf_dir))


@query
def filings_unclassified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9."""
    return d.unclassified(document_keys(spark, sf_dir), label_results(spark, sf_dir))


@query
def source_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7."""
    address = F.expr(
        "CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN replace(url, '://', ':/')"
        " WHEN 2 THEN concat('C:/landed/', url) ELSE replace(url, 'http', 'ftp+x') END"
    )
    pages = table(spark, sf_dir, "pages").select("page_id", address.alias("address"))
    return d.with_source_type(pages, "address")


FILES_A_FOLDER = 1_000  # landed files in one folder


def land_files(df: DataFrame, path: str) -> None:
    """One text file for each value of the first column of ``df``, with the texts of the second as lines.

    Files are named by that value. On a mounted folder each task writes them itself, a thousand to a folder: Spark's
    writer makes a folder of its own, a checksum and several renames for each, and a listing then opens all these folders.
    A task that comes again writes the same files.
    """
    key, value = df.columns
    if urlsplit(path).scheme not in ("", "file"):
        df.write.partitionBy(key).text(path)
        return

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        files, root = pa.fs.FileSystem.from_uri(path)
        places: dict = {}
        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                name, again = name.as_py(), True
                if name not in places:
                    folder, again = f"{root}/part-{task:05d}/{len(places) // FILES_A_FOLDER:05d}", False
                    if len(places) % FILES_A_FOLDER == 0:
                        files.create_dir(folder)
                    places[name] = f"{folder}/{key}={name}.txt"
                opened = files.open_append_stream if again else files.open_output_stream
                with opened(places[name], compression=None) as out:
                    out.write(text.as_buffer() if text.is_valid else b"")
                    out.write(b"\n")
        yield pa.RecordBatch.from_pydict({"n": pa.array([len(places)], pa.int64())})

    df.withColumn(value, F.col(value).cast("binary")).mapInArrow(write, "n bigint").agg(F.sum("n")).collect()


def landed_pages(spark: SparkSession, sf_dir: str) -> str:
    """A folder with one file for each page."""
    path = scratch(spark, "pages")
    land_files(table(spark, sf_dir, "pages").select("page_id", "html"), path)
    return path


def page_of_path():
    return F.regexp_extract("path", r"page_id=([0-9]+)[./]", 1).cast("bigint").alias("page_id")


@query
def documents_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as files and read back whole."""
    read = d.read_documents(spark, landed_pages(spark, sf_dir), "*.txt")
    return read.select(page_of_path(), long_length("html").alias("n_characters"), F.md5("html").alias("html_md5"))


@query
def documents_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: those files listed, without opening them."""
    return d.list_documents(spark, landed_pages(spark, sf_dir), "*.txt").select(page_of_path(), "length")


@query
def results_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One classification file for each labelled document, read back."""
    path = scratch(spark, "results")
    record = F.struct(
        F.expr("cast(doc_id AS string)").alias("accession_number"),
        F.expr("CASE WHEN quality = 1 THEN 'Plain Event' ELSE 'Other' END").alias("event_type"),
        F.expr("toxic = 0").alias("relevant"), F.lit("as labelled").alias("reasoning"), F.lit(0.8).alias("confidence"),
        F.lit("detailed").alias("prompt_strategy"), F.lit("2024-01-01").alias("classification_timestamp"),
    )
    land_files(table(spark, sf_dir, "labels").select("doc_id", F.to_json(record).alias("value")), path)
    return d.read_results(spark, path, "*.txt")


# --- text --------------------------------------------------------------------------------


@query
def extract_text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1-T12, with pieces of filings behind the pages."""
    markup = texts(spark, sf_dir, "pages").select("page_id", F.expr(i.FILING_HTML).alias("html"))
    pages = d.extract_text(markup)
    return pages.select(
        "page_id",
        long_length("text").alias("text_length"),
        text_sample(F.col("text")).alias("sample"),
        F.md5("text").alias("text_md5"),
    )


@query
def submission_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as full submissions of two documents, one of them a picture, joined to the index."""
    packed = table(spark, sf_dir, "pages").select(
        F.expr("cast(page_id * 2 AS string)").alias("accession_number"), F.expr(i.SUBMISSION).alias("html")
    )
    texts = d.extract_text(d.split_submission(packed), error_col="read_error")
    index = table(spark, sf_dir, "orders").select(
        F.expr("cast(o_orderkey AS string)").alias("accession_number"), F.expr(i.FORM).alias("form")
    )
    return index.join(texts.drop("html"), "accession_number").select(
        "accession_number", "form", F.col("position").cast("bigint").alias("position"), "doc_type",
        F.col("sequence").cast("bigint").alias("sequence"), "filename", "description", F.md5("text").alias("text_md5"), "read_error",
    )


@query
def clean_lines_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6-T11."""
    cleaned = texts(spark, sf_dir, "documents").select(
        "doc_id", clean_lines(F.expr(i.NOISY_TEXT)).alias("text")
    )
    return cleaned.select(
        "doc_id", long_length("text").alias("text_length"), F.md5("text").alias("text_md5")
    )


@query
def line_drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T14."""
    documents = texts(spark, sf_dir, "documents").select(F.expr(i.NOISY_TEXT).alias("text"))
    return d.line_drop_reasons(documents)


# --- prompts -----------------------------------------------------------------------------


def event_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A taxonomy derived from the whole of `events`: one label per kind of event."""
    kinds = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first")
    )
    return kinds.select(
        F.col("first").cast("int").alias("ordinal"),
        "event_type",
        (F.col("mean") > 20).alias("relevant"),
        F.concat(F.col("n").cast("string"), F.lit(" events")).alias("description"),
        F.when(F.col("event_type") == "view", F.array().cast("array<string>"))
        .otherwise(F.array(F.lower("event_type"), F.upper("event_type")))
        .alias("keywords"),
    )


@query
def taxonomy_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6."""
    return d.taxonomy_text(event_kinds(spark, sf_dir))


@query
def taxonomy_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """That taxonomy written as one JSON object, without its empty keyword lists."""
    path = scratch(spark, "taxonomy")
    label = F.struct(
        "relevant", "description", F.when(F.size("keywords") > 0, F.col("keywords")).alias("keywords")
    )
    entries = F.array_sort(F.collect_list(F.struct("ordinal", "event_type", label.alias("entry"))))
    named = F.transform(entries, lambda e: F.struct(e["event_type"], e["entry"]))
    event_kinds(spark, sf_dir).agg(F.to_json(F.map_from_entries(named)).alias("value")).write.text(path)
    read = d.read_taxonomy(spark, path)
    return read.select(
        F.col("ordinal").cast("bigint").alias("ordinal"), "event_type", "relevant", "description",
        F.array_join("keywords", "|").alias("keywords"),
    )


def prompt_facts(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(
        *keys, long_length("prompt").alias("prompt_length"), F.md5("prompt").alias("prompt_md5")
    )


def _prompt_query(strategy: str, **options) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        documents = texts(spark, sf_dir, "documents")
        prompts = d.render_prompt(documents, prose_taxonomy(spark), strategy, **options)
        return prompt_facts(prompts, "doc_id")

    QUERIES[f"prompt_{strategy}"] = run


for _strategy in ("basic", "detailed", "cot", "few_shot"):
    _prompt_query(_strategy)


@query
def prompt_few_shot_own_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 with examples from the row: none, one, or two, some without reasoning."""
    example = F.struct(
        F.col("source").alias("text"),
        F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("reasoning"),
        F.lit("Event Type: Other, Relevant: false").alias("classification"),
    )
    documents = table(spark, sf_dir, "documents").withColumn(
        "examples", F.slice(F.array(example, example), F.lit(1), (F.col("doc_id") % 3).cast("int"))
    )
    prompts = d.few_shot_prompt(documents, prose_taxonomy(spark), F.col("examples"))
    return prompt_facts(prompts, "doc_id")


@query
def prompt_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5."""
    documents = table(spark, sf_dir, "documents").withColumn(
        "classification", F.concat(F.lit("Event Type: "), "lang", F.lit(", Relevant: {true}"))
    )
    return prompt_facts(d.render_validation_prompt(documents, prose_taxonomy(spark)), "doc_id")


@query
def strategy_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four prompts per document, chosen by a column."""
    fanned = d.fan_out_strategies(texts(spark, sf_dir, "documents").select("doc_id", "text"))
    prompts = d.render_prompt(fanned, prose_taxonomy(spark), F.col("strategy"))
    return prompt_facts(prompts, "doc_id", "strategy")


# --- responses ---------------------------------------------------------------------------


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "events").withColumn("response", F.expr(i.RESPONSE))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.parse_responses(responses(spark, sf_dir), event_taxonomy(spark))


@query
def parse_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1-R9."""
    return parsed(spark, sf_dir).select(
        "event_id",
        "parse_status",
        "blank_label",
        "stated_relevant",
        F.col("result.event_type").alias("label"),
        F.col("result.confidence").alias("confidence"),
        F.col("result.reasoning").alias("reasoning"),
        F.col("result.raw_response").alias("raw_response"),
    )


@query
def response_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected responses by reason."""
    _, rejected = d.split_valid(parsed(spark, sf_dir))
    return rejected.groupBy("parse_status", "response_start", F.md5("response").alias("response_md5")).agg(
        F.count(F.lit(1)).alias("n_rejected")
    )


@query
def result_json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R10."""
    valid, _ = d.split_valid(parsed(spark, sf_dir))
    return valid.select("event_id", result_json(F.col("result")).alias("result_json"))


@query
def normalize_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4-R6."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.expr(
            "CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN upper(event_type)"
            " WHEN 2 THEN concat('  ', event_type, ' event') ELSE substring(event_type, 1, 2) END"
        ).alias("given"),
    )
    return d.normalize_labels(events, event_taxonomy(spark), "given")


@query
def normalize_many_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4, R5 with one label for each customer."""
    customers = table(spark, sf_dir, "customer")
    labels = customers.select(F.col("c_custkey").cast("int").alias("ordinal"), F.col("c_name").alias("event_type"))
    return d.normalize_labels(customers.select("c_custkey", F.expr(i.CUSTOMER_LABEL).alias("given")), labels, "given")


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four consecutive events are the attempts of one document."""
    return parsed(spark, sf_dir).withColumns(
        {
            "doc_id": F.expr("event_id div 4"),
            "attempt": F.expr("cast(event_id % 4 + 1 AS int)"),
        }
    )


@query
def first_valid_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2."""
    return d.first_valid(attempts(spark, sf_dir), "doc_id").select(
        "doc_id",
        F.col("attempt").cast("bigint").alias("attempt"),
        F.col("result.event_type").alias("label"),
        F.col("result.raw_response").alias("raw_response"),
    )


@query
def attempt_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3."""
    return d.attempt_report(attempts(spark, sf_dir), "doc_id")


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a stored result."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "ts",
        F.expr(i.RESULT_LABEL).alias("event_type"),
        F.expr(i.STATED).alias("stated_relevant"),
        F.expr(i.CONFIDENCE).cast("double").alias("confidence"),
    )


@query
def relevance_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4."""
    return d.apply_relevance(results(spark, sf_dir), event_taxonomy(spark)).select(
        "event_id", "event_type", "stated_relevant", "relevant"
    )


@query
def relevance_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5."""
    return d.relevance_conflicts(
        d.apply_relevance(results(spark, sf_dir), event_taxonomy(spark))
    )


def answer(prompt: str, kind: int) -> str | None:
    """Stands in for a model: the answer depends only on the length of the prompt and on ``kind``."""
    if kind == 0:
        raise RuntimeError("no answer")
    if kind == 1:
        return "I cannot tell"
    if kind == 2:
        return ""
    return f"REASONING: {len(prompt)} characters CLASSIFICATION: Event Type: Plain, Relevant: false"


def fake_model(prompt: str) -> str | None:
    return answer(prompt, len(prompt) % 5)


def fake_batch_model(prompts: list[str]) -> list[str | None]:
    """One prompt without an answer spoils the whole call."""
    return [fake_model(prompt) for prompt in prompts]


def fake_model_of(attempt: int) -> Callable[[str], str | None]:
    """Answers that depend on the attempt, too."""
    return lambda prompt: answer(prompt, (len(prompt) + attempt) % 5)


@query
def score_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1."""
    prompts = d.render_prompt(texts(spark, sf_dir, "documents"), prose_taxonomy(spark), "basic")
    return d.score(prompts, fake_model).select("doc_id", "response", "error")


@query
def score_prompts_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 with 16 prompts in a call."""
    prompts = d.render_prompt(texts(spark, sf_dir, "documents"), prose_taxonomy(spark), "basic")
    return d.score(prompts, fake_batch_model, batch_size=16).select("doc_id", "response", "error")


@query
def classify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning, prompts, up to three attempts, parsing, taxonomy relevance."""
    documents = texts(spark, sf_dir, "documents").select(
        "doc_id", F.expr("CASE WHEN doc_id % 9 = 0 THEN ' ' ELSE text END").alias("text")
    )
    classified = d.classify(documents, prose_taxonomy(spark), setup=fake_model_of, strategy="cot")
    return classified.select(
        "doc_id", "status", "failure", "stated_relevant",
        F.col("attempts").cast("bigint").alias("attempts"),
        F.col("result.event_type").alias("event_type"),
        F.col("result.relevant").alias("relevant"),
        F.col("result.reasoning").alias("reasoning"),
    )


def processed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings with pages as documents: some have none, some two copies, some are pictures."""
    orders = order_filings(table(spark, sf_dir, "orders")).withColumn(
        "accession_number", F.expr("cast(o_orderkey AS string)")
    )
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.expr("cast(page_id * 2 AS string)").alias("accession_number"), F.expr(i.PAGE_OR_PICTURE).alias("html")
    )
    documents = with_copies(pages, "page_id % 5 = 0", F.lit("<p>a second copy with another text</p>"))
    return d.process_filings(orders, documents, prose_taxonomy(spark), fake_model, "basic", max_retries=1)


@query
def process_filings_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8."""
    return processed_pages(spark, sf_dir).select(
        "accession_number", "status", "failure", F.col("result.event_type").alias("event_type"),
        F.col("result.relevant").alias("relevant"),
    )


# --- evidence, checks, reports -------------------------------------------------------------


@query
def keyword_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1."""
    hits = d.keyword_hits(texts(spark, sf_dir, "documents"), prose_taxonomy(spark), "doc_id")
    return hits.withColumn("hits", F.col("hits").cast("bigint"))


@query
def keyword_hits_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 with the first words of all documents as the keywords of their languages."""
    documents = table(spark, sf_dir, "documents")
    first = documents.select("lang", F.regexp_extract(F.lower("text"), r"[\p{L}\p{N}]+", 0).alias("word")).filter("word != ''")
    taxonomy = first.groupBy(F.col("lang").alias("event_type")).agg(F.array_sort(F.collect_set("word")).alias("keywords")).select(
        F.pmod(F.xxhash64("event_type"), F.lit(1_000_003)).cast("int").alias("ordinal"), "event_type", F.lit(True).alias("relevant"), "keywords"
    )
    hits = d.keyword_hits(documents, taxonomy, "doc_id")
    return hits.withColumn("hits", F.col("hits").cast("bigint"))


@query
def keyword_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2."""
    documents = texts(spark, sf_dir, "documents").select("doc_id", "text")
    return d.keyword_classify(documents, prose_taxonomy(spark)).select(
        "doc_id", "event_type", "relevant", F.col("hits").cast("bigint").alias("hits")
    )


@query
def classify_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: pages to text to event type to counts."""
    cleaned = d.extract_text(texts(spark, sf_dir, "pages").select("page_id", "html"))
    return d.event_counts(d.keyword_classify(cleaned.drop("html"), prose_taxonomy(spark)))


@query
def strategy_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The votes on each user."""
    return d.strategy_consensus(results(spark, sf_dir), event_taxonomy(spark), "user_id")


@query
def validation_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4."""
    verdicts = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.expr(i.VERDICT).alias("response")
    )
    return d.parse_validation(verdicts).select("conv_id", "turn", "validation_status", "issues")


@query
def result_schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5."""
    stored = results(spark, sf_dir).withColumnRenamed("stated_relevant", "relevant")
    return d.schema_violations(stored, event_taxonomy(spark), "event_id").select(
        "event_id", "event_type", "violation"
    )


@query
def event_counts_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4."""
    rated = d.apply_relevance(results(spark, sf_dir), event_taxonomy(spark))
    return d.event_counts(d.with_month(rated, "ts"), ["user_id", "month"])


@query
def event_counts_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 with roll-up rows."""
    rated = d.apply_relevance(results(spark, sf_dir), event_taxonomy(spark))
    return d.event_counts(d.with_month(rated, "ts"), ["month"], totals=True)


@query
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: observed while the outcome of C8 is written."""
    watched, summary = d.observe_summary(processed_pages(spark, sf_dir))
    watched.write.parquet(scratch(spark, "processed"))
    return d.observed_summary(spark, summary, "basic")


@query
def report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7, K5."""
    classified = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.expr("concat('https://example.org/', source)").alias("input_source"),
        "text",
        F.struct(
            F.col("lang").alias("event_type"),
            F.expr("doc_id % 2 = 0").alias("relevant"),
            F.expr("cast(0.8 AS double)").alias("confidence"),
            F.expr("CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END").alias("reasoning"),
            F.expr("concat('raw ', lang)").alias("raw_response"),
        ).alias("result"),
    )
    reported = d.render_report(d.to_document_result(classified, "cot"))
    return reported.select(
        "input_source", "source_type", F.col("text_length").cast("bigint").alias("text_length"),
        F.md5("extracted_text").alias("text_md5"), "report",
    )


# --- stored and streamed ---------------------------------------------------------------------


@query
def metadata_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: written, then partly written again in two conflicting forms; read back."""
    root = scratch(spark, "metadata")
    filings = order_filings(texts(spark, sf_dir, "orders"))
    d.write_metadata(filings, root)
    again = filings.filter("o_custkey % 25 < 5 AND o_orderkey % 2 = 0")
    both = again.select("*", F.explode(F.array(F.lit("8-K/A"), F.lit("9-X"))).alias("new")).withColumn("form", F.col("new"))
    d.write_metadata(both, root, order=F.col("new") == "8-K/A")
    return d.read_metadata(spark, root)


def order_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_filings(texts(spark, sf_dir, "orders")).select(
        "cik",
        "accession_number",
        F.col("form").alias("event_type"),
        F.expr("o_orderkey % 3 = 0").alias("relevant"),
        F.col("company_name").alias("reasoning"),
        F.lit(0.8).alias("confidence"),
        F.lit("detailed").alias("prompt_strategy"),
        F.col("filing_date").alias("classification_timestamp"),
    )


@query
def classification_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: one classification per order, Parquet; the second run replaces part of them, the last by order."""
    root = scratch(spark, "classifications")
    filings = order_results(spark, sf_dir)
    d.write_classifications(filings, root, "parquet")
    again = filings.filter("event_type = '8-K'").select("*", F.explode(F.array(F.lit(2), F.lit(1))).alias("n"))
    again = again.withColumn("prompt_strategy", F.when(F.col("n") == 2, "cot").otherwise("few_shot"))
    d.write_classifications(again, root, "parquet", F.col("n"))
    return d.read_classifications(spark, root, "parquet")


@query
def event_counts_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: counts kept up over two runs of K2, the second of which changes labels."""
    root = scratch(spark, "classifications")
    filings = order_results(spark, sf_dir)
    d.write_classifications(filings, root)
    d.maintained_counts(spark, root, ["month"])
    again = filings.filter("event_type = '8-K'").withColumn("event_type", F.lit("Corrected"))
    d.write_classifications(again, root)
    return d.maintained_counts(spark, root, ["month"])


def event_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive in three batches, out of order: three copies each of the filings of two companies."""
    path = scratch(spark, "waves")
    arriving = table(spark, sf_dir, "events").select(
        F.expr("CASE WHEN event_id % 6 < 3 THEN '1' ELSE '2' END").alias("cik"),
        F.expr("event_id div 6").alias("accession_number"),
        F.expr("CASE WHEN event_id % 10 > 0 THEN cast(ts AS date) END").alias("filing_day"),
        F.expr("event_id % 3").alias("wave"),
    )
    arriving.repartition(3, "wave").write.partitionBy("wave").parquet(path)
    schema = "cik string, accession_number bigint, filing_day date, wave int"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path).drop("wave")


def streamed(spark: SparkSession, stream: DataFrame, settings: dict[str, str] | None = None) -> DataFrame:
    """What all batches of a stream gave."""
    root = scratch(spark, "arrivals")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/data/batch_id={batch_id}")

    run_available(stream, handle, f"{root}/checkpoint", settings).awaitTermination()
    return spark.read.parquet(f"{root}/data").drop("batch_id")


@query
def arrivals_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each filing of each company once."""
    arriving = event_waves(spark, sf_dir).withColumn("arrived_at", F.current_timestamp())
    return streamed(spark, first_arrivals(arriving)).select("cik", "accession_number")


@query
def arrivals_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First arrivals, repeats and rejected rows of each filing."""
    marked = marked_arrivals(event_waves(spark, sf_dir), usable=F.col("filing_day").isNotNull())
    told = streamed(spark, marked, KEYED_STATE)
    return told.groupBy("cik", "accession_number", "arrival").agg(F.count(F.lit(1)).alias("n_rows"))
