"""Quality classifier: statistics and densities against plain formulas, held-out accuracy, awkward rows."""

import math
import zlib

import duckdb
import numpy as np
import pytest

from ledgerstar.llm import discriminant as qda
from ledgerstar.llm import queries
from ledgerstar.scratch import Tables

MIDDLE = "/root/testdata/sf0.01"


def test_statistics_of_a_text():
    text = "It was, as Émile said:\nA B 12 | it was, as Émile said:"
    got = dict(zip(qda.STATISTICS, (qda.statistics([b"", text.encode(), b"x"])[1] / qda.SCALE).tolist()))
    words = text.split()
    lengths = [len(x) for x in words]
    seen = [x for x in text if not x.isspace()]

    def share(part, whole):
        return math.asin(math.sqrt(part / whole))

    letters = sum(x.isalpha() for x in seen)
    mean = sum(lengths) / len(words)
    shares = [text.encode().count(bytes([b])) / len(text.encode()) for b in set(text.encode())]
    expected = {
        "log_words": math.log1p(len(words)),
        "log_word_length": math.log1p(mean),
        "word_length_spread": math.log1p(np.std(lengths)),
        "letters": share(letters, len(seen)),
        "capitals": share(sum(x in "IAB" for x in seen), letters),
        "digits": share(2, len(seen)),
        "stops": share(sum(x in ",:" for x in seen), len(seen)),
        "other_marks": 0.0,
        "quotes": 0.0,
        "pipes": share(1, len(seen)),
        "distinct_words": math.log1p(len(set(words))) / math.log1p(len(words)),
        "top_word": share(2, len(words)),
        "repeated_windows": 0.0,  # "It" and "it" differ, so four words repeat
        "short_words": share(sum(x <= 3 for x in lengths), len(words)),
        "marked_ends": share(sum(x[-1] in ",:|" for x in words), len(words)),
        "entropy": -sum(p * math.log2(p) for p in shares) / 8,
        "log_line": math.log1p(len(seen) / 2),
        "compression": math.log1p(len(text.encode())) - math.log1p(len(zlib.compress(text.encode(), 1))),
    }
    assert got == pytest.approx(expected, abs=2 / qda.SCALE)


def test_repeated_windows():
    text = b"a b c d e f a b c d e g"
    got = qda.statistics([b"a b c d e", text, b"a b c d e"])[:, qda.STATISTICS.index("repeated_windows")]
    assert got.tolist() == [0, round(math.asin(math.sqrt(10 / 12)) * qda.SCALE), 0]


def test_statistics_do_not_depend_on_neighbours():
    texts = [b"", b"one two", "éé é".encode() * 50, b" \n", b"A" * 5000, b"one two " * 9]
    together = qda.statistics(texts)
    assert (together == np.concatenate([qda.statistics([x]) for x in texts])).all()


def made(rng, n, spread):
    return np.rint((rng.normal(size=(n, qda.SIZE)) @ spread + 1) * qda.SCALE).astype(np.int32)


def test_moments_and_densities(spark):
    """Moments summed by Spark, and log densities by determinant and inverse instead of factors."""
    rng = np.random.default_rng(5)
    kinds = [made(rng, 400, rng.normal(size=(qda.SIZE, qda.SIZE))) for _ in range(2)]
    rows = [(x.tobytes(), good, i % qda.FOLDS) for good, part in enumerate(kinds) for i, x in enumerate(part)]
    frame = spark.createDataFrame(rows, "stats binary, good int, fold int")
    parts = qda.moments(frame)
    classes = []
    for good in (0, 1):
        held = [parts[fold, good] for fold in range(qda.FOLDS)]
        classes.append(qda.Moments(*(sum(getattr(x, k) for x in held) for k in ("n", "first", "second"))))
        values = kinds[good] / qda.SCALE
        assert classes[good].n == 400
        assert classes[good].mean() == pytest.approx(values.mean(0))
        assert classes[good].scatter() / 400 == pytest.approx(np.cov(values.T, bias=True))

    to_pooled, to_sphere = 0.2, 0.05
    model = qda.fitted(classes, to_pooled, to_sphere)
    own = [np.cov((x / qda.SCALE).T, bias=True) for x in kinds]
    pooled = sum(own) / 2
    scale = np.sqrt(np.diag(pooled))
    odds = np.zeros(400)
    for sign, part, cov in zip((-1, 1), kinds, own):
        shrunk = ((1 - to_pooled) * cov + to_pooled * pooled) / np.outer(scale, scale)
        shrunk = (1 - to_sphere) * shrunk + to_sphere * np.eye(qda.SIZE) * np.trace(shrunk) / qda.SIZE
        away = (kinds[1] / qda.SCALE - (part / qda.SCALE).mean(0)) / scale
        far = np.einsum("ij,jk,ik->i", away, np.linalg.inv(shrunk), away)
        odds += sign * -0.5 * (far + np.linalg.slogdet(shrunk)[1])
    assert model.log_odds(kinds[1]) == pytest.approx(np.clip(odds, -qda.FAR, qda.FAR), rel=1e-6, abs=1e-6)


def test_held_out_rows(spark):
    got = queries.op11_quality_classifier(spark, MIDDLE).toPandas()
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{MIDDLE}/labels.parquet'").df()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    judged = got[got.held_out].merge(labels, on="doc_id")
    assert (judged.predicted == judged.quality).mean() > 0.95
    again = queries.op11_quality_classifier(spark, MIDDLE).toPandas()
    assert (got.set_index("doc_id").score == again.set_index("doc_id").score).all()


def test_held_out_labels_are_not_read(spark):
    documents = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    other = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality"
    )
    one, two = (qda.scored(documents, x, Tables(spark, "t")).toPandas().set_index("doc_id").score for x in (labels, other))
    assert (one == two).all()


def test_copies_do_not_move_the_model(spark):
    """One text with a third of all rows, each row labelled."""
    documents = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").select("doc_id", "quality")
    plain = qda.scored(documents, labels, Tables(spark, "t")).toPandas().set_index("doc_id").score
    first = documents.join(labels.filter("quality = 1"), "doc_id").orderBy("doc_id").limit(1)
    ids = spark.range(10_000_000, 10_000_500).withColumnRenamed("id", "doc_id")
    copies = ids.join(first.select("text"))
    more = qda.scored(
        documents.unionByName(copies), labels.unionByName(ids.selectExpr("doc_id", "1 AS quality")), Tables(spark, "t")
    ).toPandas().set_index("doc_id").score
    assert more.loc[plain.index].to_numpy() == pytest.approx(plain.to_numpy(), abs=0.05)


def test_awkward_rows(spark):
    rows = [
        (1, "plain words in a line of text", "en", 1), (1, "other words under that id", "en", 1), (None, "nameless", None, 0),
        (3, None, "en", 0), (4, "", "en", 0), (5, " \n\t ", "de", 0), (6, "### $$$ %%% " * 9, "en", 0), (7, "z" * 300_000, "x", 0),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    marks = [(i, int(i < 4)) for i in range(1, 8)] + [(None, 1), (1, 1), (2, None), (7, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    got = qda.scored(frame, labels, Tables(spark, "t")).collect()
    assert len(got) == len(rows)
    assert all(0 <= row["score"] <= 1 and row["held_out"] is not None for row in got)
    nothing = {row["score"] for row in got if row["doc_id"] in (3, 4)}
    assert len(nothing) == 1
    # no labels, labels of one class, no documents
    for few, share in ((labels.limit(0), 1 / 2), (spark.createDataFrame([(6, 1)], "doc_id long, quality int"), 2 / 3)):
        assert {row["score"] for row in qda.scored(frame, few, Tables(spark, "t")).collect()} == {share}
    assert qda.scored(frame.limit(0), labels, Tables(spark, "t")).collect() == []
