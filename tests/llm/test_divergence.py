from __future__ import annotations

import random

import brute

from reviewmill.llm import divergence


def report(spark, rows, **options):
    schema = "lang string, source string, text string, Lang string, term string, n long"
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], schema).repartition(3)
    made = divergence.audit(docs, **options).report()
    return sorted(tuple(r) for r in made.select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(seed, n=150, vocabulary=90):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcÉéß") for _ in range(rnd.randint(1, 5))) for _ in range(vocabulary)]
    rows = []
    for _ in range(n):
        source = rnd.choice(["s1", "s1", "s1", "s2", "S3", None, "é"])
        lean = words[:30] if source == "s1" else words
        text = "".join(rnd.choice(lean) + rnd.choice([" ", "-", "\n", "9", " X ", ", "]) for _ in range(rnd.randint(0, 60)))
        rows.append((rnd.choice(["en", "en", "fr", None]), source, text))
    return rows


def test_equals_brute_force(spark):
    rows = corpus(1)
    rows += [("en", "empty", None), ("en", "empty", ""), ("de", "lonely", "one text"), ("de", "other", None), rows[0], rows[0]]
    rows.append(("en", "long", "word Word1wORD " * 200_000))  # three megabytes
    want = brute.divergence(rows, 10, 7)
    got = report(spark, rows, least_documents=10, entries=40, held=50)
    got = [r for r in got if r[2] == "pair" or r[5] <= 7]
    assert got == want
    assert any(r[1] == "empty" for r in got) and ("de", "lonely", "pair", "other", 0, 1) in got


def test_one_bucket_and_many_give_the_same(spark):
    rows = corpus(2, n=200)
    assert report(spark, rows, least_documents=5) == report(spark, rows, least_documents=5, entries=25, held=20)


def test_empty_table(spark):
    assert report(spark, [("en", "s", "x")][:0]) == []


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    n, total, terms = 3 * 10**13, 9 * 10**14, 10**7
    one = spark.range(1).select(divergence.parts_of(F.lit(n), F.lit(total), F.lit(terms)).alias("p")).first()["p"]
    assert one == 1 + 10**9 * (n + 5) // (total + 5 * terms)
