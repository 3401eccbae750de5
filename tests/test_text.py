import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lavra.functions import scalars as S
from lavra.functions import text as T


def one(spark, value, *columns):
    return spark.createDataFrame([(value,)], "x string").select(*[c(F.col("x")).alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_steps_of_cleaning(spark):
    assert one(spark, "a  b \r\n\tc\x00\n\n\n\nd", T.clean_whitespace)[0] == "a b\nc\n\nd"
    assert one(spark, "um\n 12 \ndois\n12345", T.strip_page_numbers)[0] == "um\ndois\n12345"
    assert one(spark, "Cabo X\na\nCabo X\nb\n Cabo X\nabc\nabc\nabc\n2.1 Tema\n2.1 Tema\n2.1 Tema", T.strip_repeated_lines)[0] == "a\nb\nabc\nabc\nabc\n2.1 Tema\n2.1 Tema\n2.1 Tema"
    assert one(spark, "capa\nCAPÍTULO 1\ncorpo", T.cut_front_matter)[0] == "CAPÍTULO 1\ncorpo"
    assert one(spark, "REFERÊNCIAS\na\nb\nREFERÊNCIAS \nc", T.cut_references)[0] == "REFERÊNCIAS\na\nb\n"
    assert one(spark, "REFERÊNCIA\na\nb\nc", T.cut_references)[0] == "REFERÊNCIA\na\nb\nc"


def test_hyphens_and_unicode():
    assert T.joined_hyphens("infor-\n mação é\nex-\n\nfim") == "informação é\nex-\n\nfim"
    assert T.joined_hyphens("abc-\nde-\nfgi") == "abcde-\nfgi"  # what was taken in is not looked at again
    assert T.repaired("informaÃ§Ã£o") == "informação"
    assert T.repaired("SÃO e Ã§ €") == "SÃO e Ã§ €".replace("€", "€")
    assert T.folded("  Ação\nß ") == "acao ss"


def test_nulls_and_empty_texts(spark):
    steps = (T.clean_whitespace, T.strip_page_numbers, T.strip_repeated_lines, T.cut_front_matter, T.cut_references, T.clean_text, T.fold)
    assert all(v is None for v in one(spark, None, *steps))
    assert list(one(spark, "", *steps)) == ["", "", "", "", "", "\n", ""]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from(["12", "CAPÍTULO 2", "linha", "", " linha ", "REFERÊNCIAS", "ab-", "cde", "texto  com\tblancos"]), max_size=14))
def test_the_native_steps_and_the_single_pass_agree(rows):
    from pyspark.sql import SparkSession

    spark, text = SparkSession.getActiveSession(), "\n".join(rows)
    kept = one(spark, text, lambda c: T.strip_repeated_lines(T.strip_page_numbers(T.clean_whitespace(c))))[0]
    cut = one(spark, T.joined_hyphens(kept), lambda c: T.strip(T.cut_references(T.cut_front_matter(c))))[0]
    assert T.cleaned(text) == cut + "\n"


@pytest.mark.parametrize(
    ("raw", "iso", "year"),
    [("2012", "2012", "2012"), ("2012-03", "2012-03", "2012"), (" 05/11/2010 ", "2010-11-05", "2010"), ("2010/01/31", "2010-01-31", "2010"), ("[2014?]", "", "2014"), ("s.d.", "", ""), (None, "", "")],
)
def test_dates(spark, raw, iso, year):
    assert list(one(spark, raw, S.iso_date, S.year)) == [iso, year]


def test_labels_names_and_addresses(spark):
    assert one(spark, " Português ", S.language_code)[0] == "pt"
    assert one(spark, "xx", S.language_code)[0] == ""
    assert one(spark, "NAO INFORMADO pela  instituição", S.informed)[0] == ""
    assert one(spark, "a||  ||Não informado pela instituição||b ", S.split_values)[0] == ["a", "b"]
    assert one(spark, "HTTP://user@Site.Example:80#x", S.canonical_url)[0] == "http://site.example:80/"
    assert one(spark, "x http://a.test/1). || HTTP://A.test/1 https://b.test", S.urls_in)[0] == ["http://a.test/1", "https://b.test"]
    assert one(spark, "..a b/ç..", S.safe_name)[0] == "a_b"
    assert one(spark, "2012-01-01", S.plausible_author)[0] is False
    assert one(spark, "4.2  Métodos – ", S.section_name)[0] == "Métodos"
    assert one(spark, "attachment; filename*=UTF-8''tese%20final.pdf", S.disposition_name)[0] == "tese final.pdf"
    assert one(spark, "por favor, enable JavaScript", S.landing_block)[0] == "landing_js_gate"


def test_landing_links(spark):
    page = lambda body: one(spark, body, lambda c: S.landing_pdf(c, F.lit("https://h.test/x/y")))[0]
    assert page('<a class="b" href="/bitstream/1/t.pdf">t</a>') == "https://h.test/bitstream/1/t.pdf"
    assert page('<meta name="citation_pdf_url" content="z.pdf"><a href="q.pdf">') == "https://h.test/x/z.pdf"
    assert page('<a href="http://o.test/Q.PDF">q</a>') == "http://o.test/Q.PDF"
    assert page("<p>nada</p>") is None


def test_payloads(spark):
    df = spark.createDataFrame([(bytearray(b"%PDF-1.4 x %%EOF"), "application/pdf; q=1"), (bytearray(b"%PDF-1.4"), "application/pdf"), (bytearray(b"\x89PNG\r\n\x1a\n"), "image/png")], "c binary, t string")
    rows = df.select(S.valid_pdf(F.col("t"), F.col("c")).alias("v"), S.content_kind(F.col("c")).alias("k")).collect()
    assert [(r.v, r.k) for r in rows] == [(True, "application/pdf"), (False, "application/pdf"), (False, "image/png")]


def test_retry_after():
    assert S.retry_after("7") == 7 and S.retry_after("999") == 60 and S.retry_after("x") is None and S.retry_after(None) is None
