import sys
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cuota.functions.text import (fold_ascii, normalize_name, normalize_text, percent_label, strip_accents, strip_blanks,
                                  title_case)


def ascii_form(text):
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")


def evaluate(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row[1] for row in df.select("i", make(F.col("v"))).orderBy("i").collect()]


def test_fold_of_every_code_point(spark):
    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    lines = ["".join(chars[i:i + 500]) for i in range(0, len(chars), 500)]
    assert evaluate(spark, lines, fold_ascii) == [ascii_form(line) for line in lines]


def test_fold_of_short_and_long_alphabets(spark):
    """Few distinct characters are replaced one by one, many translated; both with ligatures, marks and what has no form."""
    few, many = "ñandú ﬁn ½ Ⅷ 漢 é" * 50, "".join(map(chr, range(0x80, 0x480))) + "ﬁ½ plain"
    texts = [few, many, few + many, "漢字" * 9, "", None]
    assert evaluate(spark, texts, fold_ascii) == [t if t is None else ascii_form(t) for t in texts]


TEXTS = st.lists(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n'-ñÁüßﬁ½Ⅷ３")),
                         max_size=30), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_names_and_titles_like_python(spark, texts):
    names = [ascii_form(t).upper().strip().replace("  ", " ") for t in texts]
    assert evaluate(spark, texts, normalize_name) == names
    plain = [n for n in names if "\x01" not in n]
    assert evaluate(spark, plain, title_case) == [n.title() for n in plain]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_text_like_python(spark, texts):
    def expected(text):
        kept = "".join(c if c.isalnum() else " " for c in ascii_form(text).lower())
        return " ".join(kept.split())

    assert evaluate(spark, texts, normalize_text) == [expected(t) for t in texts]


def test_literal_cases(spark):
    assert evaluate(spark, ["  Itaú\t", "Banco   Río", "D'oro tu-fin 3ra", None], normalize_name) == [
        "ITAU", "BANCO  RIO", "D'ORO TU-FIN 3RA", None]
    assert evaluate(spark, ["D'ORO TU-FIN 3RA"], title_case) == ["D'Oro Tu-Fin 3Ra"]
    assert evaluate(spark, ["5. Créd. por sector", "", None], normalize_text) == ["5 cred por sector", "", ""]
    assert evaluate(spark, ["\x0b a b \n"], strip_blanks) == ["a b"]
    assert strip_accents("Código") == "Codigo"


def test_percent_labels_tie_to_even(spark):
    values = [0.125, 0.135, 0.0, 1.0, 0.005, 0.4999]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(percent_label(F.col("v"))).collect()]
    assert got == [f"{v:.0%}" for v in values]
