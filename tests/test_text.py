from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewmill.functions import text as tx
from reviewmill.functions.labels import period_month, sentiment
from reviewmill.functions.numeric import half_even
from reviewmill.schema import ROW_ID, TEXT


def metrics_of(make_reviews, texts):
    rows = tx.add_text_metrics(make_reviews([{TEXT: t} for t in texts])).orderBy(ROW_ID).collect()
    return [r.asDict() for r in rows]


def test_null_text_has_no_counts_but_definite_flags(make_reviews):
    (m,) = metrics_of(make_reviews, [None])
    assert m["n_chars"] is None and m["n_words"] is None and m["n_sentences"] is None
    assert m["n_tokens"] == 0 and m["n_unique_words"] == 0
    assert m["has_url"] is False and m["has_emoji"] is False


def test_blank_text(make_reviews):
    for m in metrics_of(make_reviews, ["", "  \n"]):
        assert m["n_words"] == 0 and m["n_sentences"] == 1
        assert m["mean_word_len"] is None and m["unique_ratio"] is None


def test_tokens_and_words_differ(make_reviews):
    glued, quotes, digits = metrics_of(make_reviews, ["well-organized,fun", "' don't", "1234 !!"])
    assert (glued["n_words"], glued["n_tokens"]) == (1, 3)
    assert quotes["n_tokens"] == 2
    assert digits["n_tokens"] == 0 and digits["n_exclaim"] == 2


def test_ratio_ties_round_to_even(make_reviews):
    (m,) = metrics_of(make_reviews, [" ".join(["same"] * 32)])
    assert m["unique_ratio"] == 0.0312  # 1/32 = 0.03125


def test_url_and_emoji(make_reviews):
    url, face, sun, plain = metrics_of(make_reviews, ["See HTTP://x.y and www.z", "ok \U0001f600", "ok ☀", "ok"])
    assert url["has_url"] and not plain["has_url"]
    assert face["has_emoji"] and sun["has_emoji"] and not plain["has_emoji"]
    assert face["n_chars"] == 4  # code points, not UTF-16 units


def test_sentence_needs_space_or_end(make_reviews):
    a, b, c = metrics_of(make_reviews, ["One. Two! Three?", "v1.2.3 released", "Really?!... yes"])
    assert (a["n_sentences"], b["n_sentences"], c["n_sentences"]) == (3, 1, 1)


TEXTS = st.lists(st.text(alphabet="aB'Z .!?\n1é,-", max_size=40), min_size=1, max_size=20)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_metrics_match_python(make_reviews, texts):
    for text, m in zip(texts, metrics_of(make_reviews, texts)):
        tokens = re.findall(r"[a-z']+", text.lower())
        assert m["n_chars"] == len(text)
        assert m["n_words"] == len(re.findall(r"\S+", text))
        assert m["n_sentences"] == max(len(re.findall(r"[.!?]+(?:\s|\Z)", text)), 1)
        assert (m["n_tokens"], m["n_unique_words"]) == (len(tokens), len(set(tokens)))
        assert m["n_upper"] == len(re.findall("[A-Z]", text))
        assert (m["n_exclaim"], m["n_question"]) == (text.count("!"), text.count("?"))


def test_normalisers(spark):
    df = spark.createDataFrame([("See http://a.b NOW, it's 5!",), (None,)], "t string")
    rows = df.select(tx.model_text(F.col("t")).alias("m"), tx.frequency_text(F.col("t")).alias("f")).collect()
    assert rows[0]["m"] == "see  now, it's 5!" and rows[0]["f"] == "see now it's"
    assert rows[1]["m"] == "" and rows[1]["f"] is None


def test_ngrams_skip_stop_words_before_joining(spark):
    df = spark.createDataFrame([(["a", "b", "a", "c"],), (["c"],)], "t array<string>")
    kept = tx.without_stop_words(F.col("t"), ["b"])
    assert [r[0] for r in df.select(tx.ngrams(kept, 2)).collect()] == [["a a", "a c"], []]
    assert [r[0] for r in df.select(tx.ngrams(F.col("t"), 3)).collect()] == [["a b a", "b a c"], []]
    assert [r[0] for r in df.select(tx.ngrams(F.col("t"), 9)).collect()] == [[], []]


@pytest.mark.parametrize(
    "text,month",
    [("2019-4", "2019-04-01"), ("2019-04", "2019-04-01"), ("missing", None), ("2019-13", None), ("2019-4-1", None), ("19-4", None), (None, None)],
)
def test_period(spark, text, month):
    (row,) = spark.createDataFrame([(text,)], "p string").select(period_month(F.col("p")).alias("m")).collect()
    assert (str(row["m"]) if row["m"] else None) == month


def test_labels(spark):
    df = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 0, 6, None)], "r int")
    three = [r[0] for r in df.select(sentiment(F.col("r"))).collect()]
    two = [r[0] for r in df.select(sentiment(F.col("r"), "binary")).collect()]
    assert three == ["negative", "negative", "neutral", "positive", "positive", None, None, None]
    assert two == ["negative", "negative", "negative", "positive", "positive", None, None, None]
    with pytest.raises(ValueError):
        sentiment(F.col("r"), "five_class")


def test_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,), (None,)], "x double")
    assert [r[0] for r in df.select(half_even(F.col("x"), 2)).collect()] == [0.12, 0.38, 2.5, None]


def test_urls_are_deleted_as_by_the_pattern_alone(make_reviews):
    texts = [None, "", "plain", "HTTP", "http ://a", "see HTTPS://X.y/z?q now", "WWW.a.b", "www. a", "awww.b c", "xhttpx é", "\u212Ahttp://\u0130", "\u03a3 www.\u03a3 \u03a3"]
    rows = make_reviews([{TEXT: t} for t in texts])
    plain = F.regexp_replace(F.lower(F.coalesce(TEXT, F.lit(""))), tx.MODEL_URL, "")
    got = rows.select(tx.model_text(F.col(TEXT)).alias("got"), plain.alias("want")).collect()
    assert len(got) == len(texts) and all(r["got"] == r["want"] for r in got)
    assert "CASE WHEN (contains" in rows.select(tx.model_text(F.col(TEXT)))._jdf.queryExecution().executedPlan().toString()
