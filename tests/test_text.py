"""Text nodes, line cleaning, audit."""

import html
import random
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

import docketry as d
from docketry.functions.lines import NOISE_PATTERNS, clean_lines, noise_regex, text_sample
from docketry.operators.markup import DROPPED_ELEMENTS, VOID_ELEMENTS, visible_text
from helpers import fixture, plan, python_strip_lines, rows


def nodes(markup):
    return python_strip_lines(visible_text(markup))


@pytest.mark.parametrize(
    "markup, expected",
    [
        ("<p>one</p><p>two</p>", ["one", "two"]),
        ("a<b>b</b>c", ["a", "b", "c"]),
        ("one sen<!-- x -->tence", ["one sen", "tence"]),
        ("<script>if (a<b) '</p>'</script>after", ["after"]),
        ("<style>p{}</style><title>t</title>x<nav>n<p>m</p></nav>y", ["x", "y"]),
        ("<noscript>n</noscript><button>b</button><iframe>i</iframe>k", ["k"]),
        ("x<img alt='a'>y<input value=z>w", ["x", "y", "w"]),
        ("<header>kept</header><footer>kept too</footer>", ["kept", "kept too"]),
        ("<div id=header>no<div>no</div>no</div>yes", ["yes"]),
        ("<div class='a my-footer b'>no</div><div class=Header>yes</div>", ["yes"]),
        ("<p class=header>yes</p>", ["yes"]),
        ("<div class='hea&#100;er'>no</div>yes", ["yes"]),
        ("<table><tr><td>Navigation</td><td>z</td></tr></table>yes", ["yes"]),
        ("<table class=tableFile><td>yes</td></table>", ["yes"]),
        ("<table><td>Filing</td> <td>Detail</td></table>yes", ["yes"]),
        ("<table>a<table>tableFile</table>b</table>yes", ["yes"]),
        ("<table>a<table>c</table>b</table>yes", ["a", "c", "b", "yes"]),
        ("<table>navigation</table>", ["navigation"]),
        ("<table><nav>Navigation</nav>kept</table>", ["kept"]),
        ("<table><div class=mailer>Navigation</div>gone</table>kept", ["kept"]),
        ("<SEC-DOCUMENT>0001.txt : 2024\n<TYPE>8-K\n<TEXT>body", ["0001.txt : 2024", "8-K", "body"]),
        ("fish &amp chips &copy; &unknown; &#8217;&#x2019; &#146; AT&T", ["fish & chips © &unknown ’’ ’ AT&T"]),
        ("a < b and c > d", ["a < b and c > d"]),
        ("<p>unclosed <b>tags</p><p>x", ["unclosed", "tags", "x"]),
        ("</p>stray</div>", ["stray"]),
        ("<nav/>x", ["x"]),
        ("<nav>swallows <p>the rest", []),
        ("<div><nav>gone</div>back", ["back"]),
        ("<!DOCTYPE html><?pi x?><![CDATA[data]]>t", ["data", "t"]),
        ("<ruby>kan<rt>reading</rt></ruby><template>no</template>", ["kan"]),
        ("<!-- never closed", []),
        ("a<!-- never <b>closed</b> x", ["a"]),
        ("a <b c", ["a <b c"]),
        ("x<p>y <b", ["x", "y <b"]),
        ("<p title=\"a > b\">x</p><p title=it's>y</p>", ["x", "y"]),
        ("", []),
    ],
)
def test_text_nodes(markup, expected):
    assert nodes(markup) == expected


def test_null_document():
    assert visible_text(None) is None


def test_broken_markup_is_read_in_linear_time():
    import time

    for broken in ("<a " * 200_000, "<p>" + "<a x='" * 200_000, "<!--" * 200_000, "<div>" * 200_000,
                   "<table>" * 50_000 + "x" + "</table>" * 50_000, "</p>" * 200_000, "a=\"<" * 200_000, "&" * 500_000):
        start = time.perf_counter()
        visible_text(broken)
        assert time.perf_counter() - start < 5


def test_random_markup_matches_a_plain_reading():
    """Balanced random trees against a recursive definition of the same rules."""
    rng = random.Random(7)
    dropped = ["nav", "script", "head", "button"]

    def tree(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.35:
            return rng.choice(["alpha", " ", "beta & co", "Navigation", "x < y", "\n", "Filing Detail"])
        tag = rng.choice(["p", "div", "span", "table", "td", *dropped, "div.mailer", "br"])
        return (tag, [tree(depth - 1) for _ in range(rng.randrange(4))])

    def markup(node):
        if isinstance(node, str):
            return html.escape(node, quote=False)
        tag, children = node
        if tag == "br":
            return "<br>"
        if tag == "script":
            return "<script>var a = '<p>';</script>"
        name, _, mark = tag.partition(".")
        attribute = f' class="{mark}"' if mark else ""
        return f"<{name}{attribute}>" + "".join(map(markup, children)) + f"</{name}>"

    def plain(node, final):
        """Text nodes of a subtree, None for an element edge; tables and divs go if final."""
        if isinstance(node, str):
            return [node]
        tag, children = node
        if tag in dropped or tag == "br" or final and tag == "div.mailer":
            return [None]
        if final and tag == "table":
            whole = "".join(merge(plain(node, False)))
            if any(w in whole for w in ("Navigation", "Filing Detail")):
                return [None]
        return [None, *(n for child in children for n in plain(child, final)), None]

    def merge(parts):
        """Join neighbours that no tag separates."""
        out, open_ = [], False
        for part in parts:
            if part is None:
                open_ = False
            elif open_:
                out[-1] += part
            else:
                out.append(part)
                open_ = True
        return [(" " if "\n" not in n else "\n") if not n.strip() else n for n in out]

    for _ in range(2000):
        forest = [tree(4) for _ in range(4)]
        got = nodes("".join(map(markup, forest)))
        want = merge([n for t in forest for n in plain(t, True)])
        assert got == [x for n in want for x in python_strip_lines(n)]


def python_clean(text):
    """Independent reading of T6-T11."""
    noise = re.compile("|".join(NOISE_PATTERNS), re.IGNORECASE)
    kept = [
        line
        for line in python_strip_lines(text)
        if len(line) >= 10 and set(line) - set("-_=*.") - {c for c in line if c.isspace()}
        and not re.fullmatch(r"\d+", line) and not noise.search(line)
    ]
    return re.sub(r"[ \t]+", " ", "\n".join(kept)).strip()


def test_clean_lines_against_python(spark):
    rng = random.Random(3)
    pieces = ["word", "edgar", "Form 8-K", "ﬁve", " ", "\x1d", " ", " ", "\t", "  ", "\n",
              "\n\n", "-", "=", "١٢٣٤٥٦٧٨٩٠", "1234567890", "☐", "Current Report", "XBRL x DOCUMENT", "😀",
              "Waſhington, D.C. 20549", "ſec.gov", "longer piece of text", "D.C.20549", "\r", "\x85"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string").repartition(8)
    got = dict(rows(df.select("n", clean_lines(F.col("text")))))
    bad = [(t, got[n], python_clean(t)) for n, t in enumerate(texts) if got[n] != python_clean(t)]
    assert not bad[:3]


def test_line_rules(spark):
    lines = ["nine char", "ten chars!", "-----------", "123456789012", "visit edgar now please",
             "a   b\tc   d   e"]
    df = spark.createDataFrame([("\n".join(lines),)], "text string")
    assert rows(df.select(clean_lines(F.col("text")))) == [("ten chars!\na b c d e",)]
    audit = dict(rows(d.line_drop_reasons(df)))
    assert audit == {"short": 1, "kept": 2, "rule": 1, "digits": 1, "noise": 1}


def test_own_noise_patterns(spark):
    df = spark.createDataFrame([("plain long line\n(foo) long line\nEDGAR long line",)], "text string")
    kept = rows(df.select(clean_lines(F.col("text"), (r"\(foo\)",))))
    assert kept == [("plain long line\nEDGAR long line",)]
    assert rows(df.select(clean_lines(F.col("text"), ()))) != kept
    assert "(?-i:" not in noise_regex((r"\(foo\)",))
    assert "(?-i:" not in noise_regex((r"x?foo",))
    assert "(?-i:" in noise_regex(NOISE_PATTERNS)


def test_filing_fixture(spark):
    df = d.extract_text(spark.createDataFrame([(fixture("filing.html"),)], "html string"))
    text = df.first()["text"]
    assert text.split("\n") == [
        "Harbour Co", "Harbour C.", "94-1234567", "(Employer Identification)", "12 Quay Street",
        "Port Alder, Maine 04101", "behind the mailer block", "PORT ALDER, MAINE",
        "The company signed an acquisition agreement & will buy Northwind.", "a b c d e f",
        "Footer elements are kept as text",
    ]


def test_noise_only_and_empty_documents(spark):
    df = spark.createDataFrame(
        [("<body></body>",), ("<p>SEC.gov | EDGAR filings</p><p>123</p>",), (None,)], "html string"
    )
    assert rows(d.extract_text(df).select("text")) == [("",), ("",), (None,)]


def test_sample_and_length(spark):
    df = spark.createDataFrame([("😀" * 300,)], "text string")
    assert rows(df.select(F.length(text_sample(F.col("text"))), F.length("text"))) == [(200, 300)]


def test_text_does_not_depend_on_partitions(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet").select("page_id", "html")
    one, many = d.extract_text(pages.coalesce(1)), d.extract_text(pages.repartition(16))
    assert rows(one.select("page_id", "text"), "page_id") == rows(many.select("page_id", "text"), "page_id")


def test_filtering_on_text_runs_python_once(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet").select("page_id", "html")
    kept = plan(d.extract_text(pages).filter("length(text) > 5 AND page_id > 3").select("page_id", "text"))
    assert kept.count("ArrowEvalPython") == 1
    assert kept.count("transform(split") == 1
    assert "PushedFilters: [IsNotNull(page_id), GreaterThan(page_id,3)]" in kept


def test_cleaning_needs_no_python(spark, data):
    documents = spark.read.parquet(f"{data}/documents.parquet")
    assert "EvalPython" not in plan(documents.select(clean_lines(F.col("text"))))


def test_bytes_that_are_not_utf8(spark):
    df = spark.sql("SELECT concat('<p>Soci', cast(unhex('E9') AS string), 't generale</p>') AS html")
    assert rows(d.extract_text(df).select("text")) == [("Soci\ufffdt generale",)]
    prompts = df.select(F.col("html").alias("prompt"))
    assert d.score(prompts, lambda p: p[:8]).first()["response"] == "<p>Soci\ufffd"


def test_one_unreadable_document_does_not_stop_the_rest(spark):
    def fragile(document):
        if "bad" in document:
            raise ValueError("no text in it")
        return document

    df = spark.createDataFrame([(1, "bad one is here"), (2, "good one is here")], "n int, html string")
    read = d.extract_text(df, error_col="why", reader=fragile)
    assert rows(read.select("n", "text", "why"), "n") == [(1, None, "ValueError: no text in it"), (2, "good one is here", None)]
    plain = d.extract_text(df.filter("n = 1").withColumn("html", F.lit("begin 644 a.jpg\nM123")), error_col="why")
    assert rows(plain.select("text", "why")) == [(None, "ValueError: an encoded attachment, not text")]


class Plain(HTMLParser):
    """Text nodes by the standard library's tokenizer, without the table and div rules."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.open, self.parts, self.held = [], [], []

    def cut(self):
        node, self.held = "".join(self.held), []
        if node and not any(name in DROPPED_ELEMENTS for name in self.open):
            self.parts.append(node)

    def handle_starttag(self, name, attributes):
        self.cut()
        if name not in VOID_ELEMENTS:
            self.open.append(name)

    def handle_startendtag(self, name, attributes):
        self.cut()

    def handle_endtag(self, name):
        self.cut()
        if name in self.open:
            while self.open.pop() != name:
                pass

    def handle_data(self, data):
        self.held.append(data)

    def handle_entityref(self, name):
        self.held.append(html.unescape(f"&{name};"))

    def handle_charref(self, name):
        self.held.append(html.unescape(f"&#{name};"))

    def handle_comment(self, data):
        self.cut()

    handle_decl = handle_pi = handle_comment

    def nodes(self, markup):
        self.feed(markup + "<p>")
        self.close()
        self.cut()
        return python_strip_lines("\n".join(self.parts))


def test_tokens_agree_with_the_standard_library():
    rng = random.Random(5)
    tokens = ["<p>", "</p>", "<NAV>", "</nav>", "<br>", "<br/>", "<nav/>", "</br>", "<b class=\"x > y\">", "</b >",
              "<i title='a' x = y>", "<i title=it's>", "</i>", "<a href=x/>", "</a>", "<!-- c > d -->", "<!DOCTYPE html>",
              "<?pi?>", "<script>a<b</p>'</script>", "<style>x</style >", "<TYPE>8-K\n", "<ns:tag a:b='c'>", "</ns:tag>",
              "<button disabled>", "</button>", "<img src=a alt='>'>", "text ", "more\n", " & ", "&amp;", "&amp ", "&#65;",
              "&#x41;", "&eacute;x", " < 5 ", "a > b", "é", "\xa0", "<title>t</title>"]
    for _ in range(5000):
        markup = "".join(rng.choice(tokens) for _ in range(rng.randrange(1, 20)))
        assert nodes(markup + "<p>") == Plain().nodes(markup), markup


def test_full_submissions(spark):
    whole = """<SEC-HEADER>a long line in the header</SEC-HEADER>
<DOCUMENT>
<TYPE>8-K
<SEQUENCE>1
<FILENAME>a.htm
<DESCRIPTION>The report
<TEXT>
<p>the first document of the filing</p>
</TEXT>
</DOCUMENT>
a long line between documents
<document>
<type>EX-99.1
<sequence>x2
<text><p>the second document of the filing</p></text>
</document>
<DOCUMENT>
<TYPE>GRAPHIC
<TEXT>
begin 644 a.jpg
M12
</TEXT>
<DOCUMENT>
<p>cut off, without a header</p>"""
    given = [("w", whole), ("p", "<p>a page and no submission</p>"), ("e", ""), ("n", None), ("r", whole.replace("\n", "\r\n"))]
    df = spark.createDataFrame(given, "k string, html string")
    split = d.split_submission(df)
    assert split.columns == ["k", "position", "doc_type", "sequence", "filename", "description", "html"]
    read = d.extract_text(split, error_col="why").select("k", "position", "doc_type", "sequence", "filename", "description", "text", "why")
    got = [r for r in rows(read, "k", "position")]
    image = "ValueError: an encoded attachment, not text"
    four = [(1, "8-K", 1, "a.htm", "The report", "the first document of the filing", None),
            (2, "EX-99.1", None, None, None, "the second document of the filing", None),
            (3, "GRAPHIC", None, None, None, None, image), (4, None, None, None, None, "cut off, without a header", None)]
    assert got == [("e", 0, None, None, None, None, "", None), ("p", 0, None, None, None, None, "a page and no submission", None),
                   *[("r", *r) for r in four], *[("w", *r) for r in four]]
    text = plan(split)
    assert "Exchange" not in text and "Python" not in text
