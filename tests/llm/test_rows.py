"""Rows that share an id, columns that clash, and article text that looks like something else."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerstar.llm import exact, html, neardup, pii
from ledgerstar.llm.tables import Tables

TEXT = " ".join(f"word{i}" for i in range(60))
OTHER = " ".join(f"other{i}" for i in range(60))
LONG = "This paragraph of the article is long enough, has commas, and tells the reader something. " * 3


def test_each_row_goes_by_its_own_text(spark):
    rows = [(1, TEXT, 1, "x"), (2, TEXT + " end", 2, "x"), (2, OTHER, 3, "x"), (3, None, 4, "y"), (None, TEXT, 5, "y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, of long, print string")
    found = neardup.dedup(frame, Tables(spark, "t"))
    assert found.columns == frame.columns
    assert sorted(r["of"] for r in found.collect()) == [1, 3, 4, 5]
    names = {"of": "doc", "print": "rep"}
    assert neardup.dedup(frame.withColumnsRenamed(names), Tables(spark, "t")).count() == 4


def test_one_of_equal_rows_stays(spark):
    rows = [(1, TEXT, 1, {"k": 1}), (1, TEXT, 2, None), (1, OTHER, 3, {}), (2, TEXT + " ", 4, {}), (3, "once", 5, {})]
    rows += [(2, " " + TEXT, 6, {}), (4, None, 7, {}), (None, "", 8, {}), (5, "five", 9, {}), (5, " five", 10, {})]
    rows += [(None, "no id", i, {}) for i in range(20, 60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, digest long, kept map<string, long>")
    found = exact.dedup(frame, Tables(spark, "t"))
    assert found.columns == frame.columns
    got = sorted((r["digest"], r["doc_id"]) for r in found.collect())
    # of the rows of id 2 with TEXT the greater original text stays; any one of those without an id
    assert got[:-1] == [(3, 1), (4, 2), (5, 3), (7, 4), (10, 5)] and got[-1][0] >= 20
    names = {"digest": "n_best", "kept": "of_digest"}
    assert exact.dedup(frame.withColumnsRenamed(names), Tables(spark, "t")).count() == 6
    verdicts = {(r["doc_id"], r["keep_id"], r["group_size"]) for r in exact.judged(frame, Tables(spark, "t")).collect()}
    assert (1, 2, 4) in verdicts and (None, None, 40) in verdicts and (None, 4, 2) in verdicts


PHRASES = [  # text, personal data in it, kind
    ("Call us under (030) 555 0100 today", "(030) 555 0100", "phone"),
    ("my phone 555 123 4567, evenings", "555 123 4567", "phone"),
    ("tel: 0171/555 2368", "0171/555 2368", "phone"),
    ("Pay to DE89 3704 0044 0532 0130 00 NOW", "DE89 3704 0044 0532 0130 00", "iban"),
    ("IBAN GB82WEST12345698765432.", "GB82WEST12345698765432", "iban"),
    ("Her number is 078-05-1120.", "078-05-1120", "ssn"),
    ("He lives at 221B Baker Street, upstairs", "221B Baker Street", "address"),
    ("wohnhaft Lange Hauptstraße 12 in Bonn", "Hauptstraße 12", "address"),
    ("Dear Mrs. Agatha Q. Pumblechook, thank you", "Agatha Q. Pumblechook", "name"),
    ("as Maria Lopez-Garcia said", "Maria Lopez-Garcia", "name"),
]
PLAIN = [
    "on 2024-05-13 and 13.05.2024, in 1999-2004", "numbers 10 20 30 40 50 60 70 80 90", "The United States Senate met",
    "see DE12 3704 0044 0532 0130 00", "chapter 12 34 56", "the Martin Luther King Street", "In Spring New Rules Apply",
]


def test_phrases_of_personal_data(spark):
    texts = [x[0] for x in PHRASES] + PLAIN + [None, "", "1 " * 30_000, "Ab " * 20_000]
    rows = [(i, x) for i, x in enumerate(texts)] + [(None, "Call (030) 555 0100")] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.judged(frame, Tables(spark, "t"), "doc_id", F.col("text").alias("body")).collect()
    spans = {r["doc_id"]: {(r["body"][x.start : x.end], x.kind) for x in r["spans"]} for r in found if r["body"]}
    for i, (_, body, kind) in enumerate(PHRASES):
        assert spans[i] == {(body, kind)}
    assert all(not spans.get(i) for i in range(len(PHRASES), len(texts)))
    assert spans[None] == {("(030) 555 0100", "phone")} and len(found) == len(rows)


def test_spans_of_a_text_with_very_many(spark):
    text = "".join(f"{i} mail a{i}@b.org, " for i in range(1500))
    row = pii.matched(spark.createDataFrame([(text,)], "text string"), F.lit(1).alias("one")).first()
    assert [(x.start, x.end) for x in row.email] == [x.span() for x in re.finditer(r"a[0-9]+@b[.]org", text)]
    assert [x.body for x in row.candidates] == [x for x in text.split() if x != "mail"]


def test_estimates_equal_plain_loops(spark):
    rng = random.Random(1)
    made = [(rng.choice("ab"), [rng.choice([-1, 0, 1, 1]) for _ in range(3)], rng.randint(1, 50)) for _ in range(60)]
    shares, right = {"a": 0.5, "b": 0.5}, [pii.START] * 3
    for _ in range(pii.STEPS):
        p = []
        for shape, votes, _ in made:
            odds = shares[shape] / (1 - shares[shape])
            for v, r in zip(votes, right):
                odds *= {1: r / (1 - r), 0: (1 - r) / r, -1: 1}[v]
            p.append(odds / (1 + odds))
        for shape in shares:
            own = [(x, n) for x, (s, _, n) in zip(p, made) if s == shape]
            shares[shape] = min(max((sum(x * n for x, n in own) + 1) / (sum(n for _, n in own) + 2), 0.01), 0.99)
        for i in range(3):
            own = [(x if v[i] else 1 - x, n) for x, (_, v, n) in zip(p, made) if v[i] >= 0]
            agreed = sum(x * n for x, n in own) + pii.START * pii.WORTH
            right[i] = min(max(agreed / (sum(n for _, n in own) + pii.WORTH), 0.05), 0.99)
    patterns = spark.createDataFrame(made, "shape string, votes array<tinyint>, n long")
    got = pii.estimate(patterns, 3)
    assert got[0] == pytest.approx(shares, abs=1e-9) and got[1] == pytest.approx(right, abs=1e-9)


@pytest.mark.parametrize(
    "markup, expected",
    [
        # a page that is one form, and a form beside the article
        ("<body><form id='aspnetForm'><div><article><h1>Title</h1><p>{0}</p></article></div></form></body>", "Title\n{0}"),
        ("<body><form><h1>Title</h1><p>{0}</p></form></body>", "Title\n{0}"),
        ("<article><p>{0}</p></article><form><p>Your mail address, please, and your name</p></form>", "{0}"),
        ("<article><p>{0}</p><form><label>Mail</label><input></form></article>", "{0}"),
        # values that contain the names of attributes
        ("<article><p title='now hidden '>{0}</p></article>", "{0}"),
        ("<article><p data-id='comment-7'>{0}</p></article>", "{0}"),
        ("<article><p data-class=\"nav menu\" title='style=\"display:none\"'>{0}</p></article>", "{0}"),
        ("<article><p>{0}</p><p hidden>{0}</p><p HIDDEN=''>a</p><p aria-hidden=true>b</p></article>", "{0}"),
        ("<article><p>{0}</p><div style='color: red; display : none'>{0}</div></article>", "{0}"),
        ("<article><p>{0}</p><div class=comment>{0}</div><div id='sidebar'>{0}</div></article>", "{0}"),
        # formulas are text, their sources are not
        (
            "<article><p>{0}</p><p>Then <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='tex'>x=2</annotation>"
            "</math> holds.</p></article>",
            "{0}\nThen x=2 holds.",
        ),
    ],
)
def test_article_text_stays(markup, expected):
    assert html.main_text(markup.format(LONG)) == expected.format(LONG.strip())


def test_attributes():
    token = """<p a=1 B = 'x "y"' c="d=e" hidden data-x A=2/>"""
    assert html.attributes("p", token) == {"a": "1", "b": 'x "y"', "c": "d=e", "hidden": "", "data-x": ""}
