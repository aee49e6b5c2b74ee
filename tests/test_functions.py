from __future__ import annotations

import math
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from scriptorium.functions import jsonx, temporal, text as X, vector as V


def one(spark, value, kind, expression):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x")).alias("y")).first()["y"]


SPACES = [" ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", " ", " ", "　"]


def test_every_kind_of_whitespace_is_squeezed(spark):
    rows = [(f"{s}a{s}{s}b{s}",) for s in SPACES]
    df = spark.createDataFrame(rows, "x string").select(X.normalize_ws(F.col("x")).alias("y"))
    assert {r["y"] for r in df.collect()} == {"a b"}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=[*SPACES, "a", "é", "β"], max_size=12), min_size=20, max_size=40))
def test_whitespace_as_in_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(X.normalize_ws(F.col("x"))).collect()]
    assert got == [re.sub(r"\s+", " ", t).strip() for t in texts]
    stripped = [r[0] for r in df.select(X.strip(F.col("x"))).collect()]
    assert stripped == [t.strip() for t in texts]


@pytest.mark.parametrize(
    ("path", "tail"), [("http://a/b/2301.1v1", "2301.1v1"), ("plain", "plain"), ("a/", ""), ("", "")]
)
def test_path_tail(spark, path, tail):
    assert one(spark, path, "string", X.path_tail) == tail == path.split("/")[-1]


def test_object_path_and_joined(spark):
    assert one(spark, "1v1", "string", X.object_path) == "arxiv_pdfs/1v1.pdf"
    assert one(spark, ["a", "b"], "array<string>", X.joined) == "a, b"


def test_mentions_ignores_case_and_nulls(spark):
    texts = [("An llM", None), (None, None), ("no", "none"), (None, "many LLMs."), ("LLM-based", ""),
             ("Diffie-Hellman", "Hellmann"), ("LLM2", "xLLM"), ("\u00e9LLM", "LLM_x")]
    df = spark.createDataFrame(texts, "a string, b string")
    hits = [r[0] for r in df.select(X.mentions("LLM", F.col("a"), F.col("b"))).collect()]
    assert hits == [True, False, False, True, True, False, False, False]
    dotted = spark.createDataFrame([("a.b",), ("axb",)], "a string").select(X.mentions("a.b", F.col("a")))
    assert [r[0] for r in dotted.collect()] == [True, False]


def test_weeks_start_on_monday(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-06-09 23:00:00' AS t")
    row = df.select(temporal.week_of(F.col("t")), temporal.day_of(F.col("t"))).first()
    assert (str(row[0]), str(row[1])) == ("2024-06-03", "2024-06-09")


def test_clock_is_an_argument(spark):
    got = spark.range(1).select(temporal.clock("2024-01-01 08:00:00").cast("string")).first()[0]
    assert got == "2024-01-01 08:00:00"


def test_json_strings(spark):
    df = spark.createDataFrame(
        [(1, '["a","b"]'), (2, "[]"), (3, None), (4, "broken")], "id long, j string"
    )
    rows = df.select("id", jsonx.each_string(F.col("j")).alias("v")).collect()
    assert [(r["id"], r["v"]) for r in rows] == [(1, "a"), (1, "b")]
    broken = df.filter(jsonx.is_broken(F.col("j"))).collect()
    assert [r["id"] for r in broken] == [4]


@pytest.mark.parametrize(
    ("a", "b", "distance"),
    [
        ([1.0, 0.0], [0.0, 2.0], 1.0),
        ([1.0, 0.0], [-3.0, 0.0], 2.0),
        ([1.0, 1.0], [2.0, 2.0], 0.0),
        ([0.0, 0.0], [1.0, 0.0], None),
        (None, [1.0, 0.0], None),
        ([1.0], [1.0, 0.0], None),
    ],
)
def test_cosine_distance(spark, a, b, distance):
    df = spark.createDataFrame([(a, b)], "a array<float>, b array<float>")
    got = df.select(V.cosine_distance(F.col("a"), F.col("b"))).first()[0]
    assert got == distance or math.isclose(got, distance, abs_tol=1e-12)


def test_vector_literal_dim_and_text_form(spark):
    assert one(spark, "[0.5, -1]", "string", lambda c: V.parse(c, 2)) == [0.5, -1.0]
    assert one(spark, "[0.5]", "string", lambda c: V.parse(c, 2)) is None
    df = spark.sql("SELECT array(float(0), float('-0.0')) AS v")
    assert df.select(V.text_form(F.col("v"))).first()[0] == "[0.0, -0.0]"


def test_row_json_round_trip(spark):
    df = spark.createDataFrame([(1, ["a", None], None)], "id long, names array<string>, x string")
    parsed = df.select(
        F.from_json(jsonx.row_json("id", "names"), "id long, names array<string>").alias("r")
    ).select("r.*")
    assert [tuple(r) for r in parsed.collect()] == [(1, ["a", None])]
