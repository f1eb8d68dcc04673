"""Selecting filings by form, company and date (F1-F16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.functions.keys import (
    ARCHIVE_BASE, DEFAULT_DAYS, DEFAULT_FORM, UNKNOWN_COMPANY, directory_key, document_url,
    file_key, pad_cik, parse_day,
)
from docketry.sources.schemas import METADATA, columns


def explode_filings(submissions: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """one row per filing, in the order of the index (``position``).

    ``filing_day`` is the date, null when the text is not one; see :func:`split_dated`.
    ``keep`` names further columns of the index to carry along.
    """
    # A missing array counts as an empty one; zipping with a null would lose the whole index.
    none = F.array().cast("array<string>")
    recent = F.arrays_zip(
        *[
            F.coalesce(F.col(f"filings.recent.{name}"), none).alias(name)
            for name in ("form", "filingDate", "accessionNumber")
        ]
    )
    rows = submissions.select(
        pad_cik(F.col("cik")).alias("cik"),
        F.coalesce("name", F.lit(UNKNOWN_COMPANY)).alias("company_name"),
        *keep,
        F.posexplode(recent).alias("position", "filing"),
    )
    return rows.select(
        *keep,
        "cik",
        "company_name",
        F.col("filing.form").alias("form"),
        F.col("filing.filingDate").alias("filing_date"),
        F.col("filing.accessionNumber").alias("accession_number"),
        parse_day(F.col("filing.filingDate")).alias("filing_day"),
        "position",
    )


def filter_form(df: DataFrame, form: str = DEFAULT_FORM) -> DataFrame:
    """exactly this form, so amendments stay out."""
    return df.filter(F.col("form") == form)


def filter_dates(
    df: DataFrame, start=None, end=None, day_col: str = "filing_day"
) -> DataFrame:
    """both ends inclusive, each optional; ISO strings, dates or columns."""
    for bound, keep in ((start, "__ge__"), (end, "__le__")):
        if bound is not None:
            bound = bound if isinstance(bound, Column) else F.lit(bound)
            df = df.filter(getattr(F.col(day_col), keep)(bound.cast("date")))
    return df


def date_window(start=None, end=None, days: int = DEFAULT_DAYS, as_of=None):
    """the pair of bounds a request means.

    With a start, the end defaults to today. Without one the window is the last ``days`` days
    and an end given alone is ignored.
    """
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    if start is None:
        return F.date_sub(today, days), today
    return F.lit(start).cast("date"), today if end is None else F.lit(end).cast("date")


def last_days(
    df: DataFrame, days: int = DEFAULT_DAYS, as_of=None, day_col: str = "filing_day"
) -> DataFrame:
    """``[as_of - days, as_of]``."""
    return filter_dates(df, *date_window(days=days, as_of=as_of), day_col=day_col)


def split_dated(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows with a usable date and key, and the quarantined rest."""
    usable = (
        F.col("filing_day").isNotNull()
        & F.col("accession_number").isNotNull()
        & F.col("form").isNotNull()
    )
    return df.filter(usable), df.filter(~usable)


def filing_key(df: DataFrame) -> DataFrame:
    """Add ``filename`` and ``directory``."""
    date, accession = F.col("filing_date"), F.col("accession_number")
    return df.withColumns(
        {
            "filename": file_key(date, accession),
            "directory": directory_key(F.col("cik"), date, accession),
        }
    )


def with_document_url(df: DataFrame, base: str = ARCHIVE_BASE) -> DataFrame:
    """F10."""
    return df.withColumn(
        "document_url", document_url(F.col("cik"), F.col("accession_number"), base)
    )


def resolve_company(requests: DataFrame, companies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """requests with their cik, and those that name no known company and no cik.

    A company name beats an explicit cik. The directory is joined without a hint: Spark
    broadcasts it while it is small and shuffles it, splitting hot names, when it is not.
    """
    directory = companies.groupBy("name").agg(F.min("cik").alias("__directory_cik"))
    joined = requests.join(directory, "name", "left")
    resolved = joined.withColumn(
        "cik",
        F.when(F.col("name").isNull(), F.col("cik")).otherwise(F.col("__directory_cik")),
    ).drop("__directory_cik")
    known = F.col("cik").isNotNull() & (F.col("cik") != "")
    return (
        resolved.filter(known).withColumn("cik", pad_cik(F.col("cik"))),
        resolved.filter(~known | F.col("cik").isNull()),
    )


def request_window(requests: DataFrame, days: int = DEFAULT_DAYS, as_of=None) -> DataFrame:
    """F4 per request row: turn ``start``/``end`` strings into ``start_day``/``end_day``.

    A date that is given but cannot be read gives no window: both days are null, and the request
    selects nothing. See :func:`split_windows`.
    """
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    days_of = {name: parse_day(F.col(name)) for name in ("start", "end")}
    broken = [
        (F.coalesce(F.col(name), F.lit("")) != "") & day.isNull() for name, day in days_of.items()
    ]
    start, end = days_of.values()
    readable = ~(broken[0] | broken[1])
    return requests.withColumns(
        {
            "start_day": F.when(readable, F.coalesce(start, F.date_sub(today, days))),
            "end_day": F.when(
                readable, F.when(start.isNotNull(), F.coalesce(end, today)).otherwise(today)
            ),
        }
    )


def split_windows(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests with a window, and the quarantined ones whose dates could not be read."""
    return requests.filter("start_day IS NOT NULL"), requests.filter("start_day IS NULL")


def merge_windows(requests: DataFrame) -> DataFrame:
    """Disjoint ``start_day, end_day`` ranges per cik that cover the same days.

    The first grouping leaves at most one row per company and start day, so the window behind
    it is small even for a company that most requests ask for.
    """
    longest = (
        requests.filter(F.col("start_day") <= F.col("end_day"))
        .groupBy("cik", "start_day")
        .agg(F.max("end_day").alias("end_day"))
    )
    by_start = Window.partitionBy("cik").orderBy("start_day")
    covered = F.max("end_day").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start_day") > F.date_add(covered, 1), F.lit(True))
    return (
        longest.withColumn("__opens", opens.cast("int"))
        .withColumn("__run", F.sum("__opens").over(by_start))
        .groupBy("cik", "__run")
        .agg(F.min("start_day").alias("start_day"), F.max("end_day").alias("end_day"))
        .drop("__run")
    )


def select_filings(filings: DataFrame, requests: DataFrame) -> DataFrame:
    """filings inside the date range of a request for their company.

    ``requests`` has ``cik, start_day, end_day``. A filing asked for twice comes out once: a
    semi join, with the range test inside it, needs no deduplication. Ranges are merged first,
    so few of them are tried per filing.
    """
    f, r = filings.alias("f"), merge_windows(requests).alias("r")
    wanted = (F.col("f.cik") == F.col("r.cik")) & F.col("f.filing_day").between(
        F.col("r.start_day"), F.col("r.end_day")
    )
    return f.join(r, wanted, "left_semi")


def chosen_copies(documents: DataFrame, key: str = "accession_number", path: str = "path") -> DataFrame:
    """``key, path`` of the copy that counts for each filing; content is never read.

    The longest copy if there is a column ``length``, as a listing has it; of those the first by path.
    """
    choice = F.min(path)
    if "length" in documents.columns:
        choice = F.min_by(path, F.struct((-F.col("length")).alias("length"), F.col(path).alias("path")))
    return documents.filter(F.col(path).isNotNull()).groupBy(key).agg(choice.alias(path))


def one_document_each(documents: DataFrame, key: str = "accession_number") -> DataFrame:
    """One ``html`` per filing where copies have no path to tell them apart: the greatest string.

    Copies fall away map-side, however many there are of one, but content is sorted and shuffled;
    give documents a ``path``, as ``read_documents`` does, to avoid that.
    """
    return documents.groupBy(key).agg(F.max("html").alias("html"))


def attach_content(
    filings: DataFrame, documents: DataFrame, key: str = "accession_number", path: str = "path"
) -> DataFrame:
    """filings with their document, null where it is missing.

    With a ``path``, which must be different for every row of ``documents``, the copy is chosen on
    keys and paths alone. Content is then shuffled once, on key and path; nothing sorts or aggregates
    it, since the filings are the side that is hashed.
    """
    if path not in documents.columns:
        return filings.join(one_document_each(documents, key), key, "left")
    wanted = filings.join(chosen_copies(documents, key, path).withColumnRenamed(path, "__path"), key, "left")
    content = documents.select(F.col(key).alias("__key"), F.col(path).alias("__copy"), "html")
    same = (F.col(key) == F.col("__key")) & (F.col("__path") == F.col("__copy"))
    joined = wanted.hint("shuffle_hash").join(content, same, "left")
    return joined.select(*[c for c in filings.columns if c != "html"], "html")


def to_metadata(df: DataFrame) -> DataFrame:
    """the seven metadata columns."""
    if "document_url" not in df.columns:
        df = with_document_url(df)
    if "filename" not in df.columns:
        df = filing_key(df)
    return df.select(*columns(METADATA))


def preview(filings: DataFrame) -> DataFrame:
    """F16: the selection with its size on each row; touches no document.

    The count is a scalar subquery over the pruned selection, not a one-partition window.
    """
    total = filings.agg(F.count(F.lit(1)).alias("n")).scalar()
    return filings.select("filing_date", "accession_number", total.alias("n_selected"))
