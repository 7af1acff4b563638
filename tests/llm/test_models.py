"""Line field, severity model and the pipeline."""

import itertools
import random

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.conftest import prose
from typerank.llm import quality, substring, toxicity
from typerank.llm.common import read

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
FOLDER = "/root/testdata/sf0.01"


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(4)
    lines, odds, pairs = np.array([3, 1, 4]), rng.normal(size=8), rng.normal(size=(2, 2))
    good, counts = quality._forward_backward(lines, odds, pairs)
    want, total, at = [], np.zeros((2, 2)), 0
    for n in lines:
        own, weight, seen = np.zeros(n), 0.0, np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            p = np.exp(sum(odds[at + i] * y[i] for i in range(n)) + sum(pairs[a, b] for a, b in zip(y, y[1:])))
            weight += p
            own += p * np.array(y)
            for a, b in zip(y, y[1:]):
                seen[a, b] += p
        want += (own / weight).tolist()
        total += seen / weight
        at += n
    assert np.allclose(good, want) and np.allclose(counts, total)


def test_features_of_a_line_do_not_depend_on_other_texts():
    texts = ["One line.\nTWO!!\n\nx x x x", None, "", "a | b\r\n1 2", "One line.\nTWO!!\n\nx x x x"]
    lines, length, x = quality.line_features(texts)
    assert lines.tolist() == [4, 1, 1, 2, 4] and x.shape == (12, quality.WIDTH)
    alone = [quality.line_features([t]) for t in texts]
    assert np.array_equal(x, np.concatenate([a[2] for a in alone]))
    assert length.tolist() == np.concatenate([a[1] for a in alone]).tolist()


def test_gradient_of_the_ordinal_model():
    """The fit reaches a point where moving any weight lowers the likelihood."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    score = x @ [1.5, -1.0, 0.0] + rng.logistic(size=400)
    grades = np.searchsorted([-1.0, 0.5, 2.0], score)
    rows = [dict(enumerate(r)) for r in x]
    weights, cuts = toxicity.fit(rows, grades, 3, steps=2000, ridge=0.0)
    assert np.abs(weights - [1.5, -1.0, 0.0]).max() < 0.4 and (np.diff(cuts) > 0).all()

    def loss(w, c):
        above = np.hstack([np.ones((400, 1)), toxicity._above(x @ w, c), np.zeros((400, 1))])
        at = np.arange(400)
        return -np.log(above[at, grades] - above[at, grades + 1]).sum()

    best = loss(weights, cuts)
    for i in range(3):
        for step in (-0.02, 0.02):
            assert loss(weights + step * np.eye(3)[i], cuts) >= best - 1e-2
            assert loss(weights, cuts + step * np.eye(3)[i]) >= best - 1e-2


def held_out_rows(spark, name, scored, column):
    labels = read(spark, FOLDER, "labels").where(f"{name} IS NOT NULL")
    rows = scored.join(labels, "doc_id").where(quality.held_out("doc_id")).select(name, column).collect()
    return np.array(rows, dtype=float).T


def test_held_out_quality(spark):
    docs = read(spark, FOLDER, "documents")
    scored = quality.score(docs, quality.train(docs, read(spark, FOLDER, "labels")))
    assert scored.columns == [*docs.columns, "_quality"]
    label, value = held_out_rows(spark, "quality", scored, "_quality")
    assert ((value >= quality.THRESHOLD) == label).mean() >= 0.95 and ((value >= 0) & (value <= 1)).all()


def test_held_out_toxicity(spark):
    docs = read(spark, FOLDER, "documents")
    model = toxicity.train(docs, read(spark, FOLDER, "labels"))
    assert (np.diff(model.thresholds) > 0).all()
    label, value = held_out_rows(spark, "toxic", toxicity.score(docs, model), "_severity")
    toxic = value >= toxicity.THRESHOLD
    assert not toxic[label == 0].any() and (toxic == label).mean() >= 0.9


def test_rare_toxic_words_keep_their_place(table, spark):
    """Words of few toxic documents count beside the many forms of frequent ones."""
    often = [f"{a}{b}mudworm" for a in "bcdfghjklmnp" for b in "aeiouyaeiouy"[:6]]
    often += [w.replace("mud", "rot") for w in often]
    rows = [(i, f"some plain words here w{i % 7}", 0) for i in range(200)]
    rows += [(1000 + i, "some plain words " + " ".join(often), 1) for i in range(60)]
    rows += [(2000 + i, "some plain words zzz here", 1) for i in range(20)]
    docs = table([(i, t, "en", "s", 0) for i, t, _ in rows], DOCS)
    model = toxicity.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    assert "zzz" in model.index and len(often) * 3 < len(model.index)
    assert model.expected(["zzz is a word here"])[0] >= toxicity.THRESHOLD > model.expected(["a plain word here"])[0]


ODD = [(1, None, "l", "s", 0), (2, "", "l", "s", 0), (None, "text", "l", "s", 0), (3, "word " * 40_000, "l", "s", 0), (3, "word", "l", "s", 0)]


def test_grades_rise_with_planted_severity(table, spark):
    """The share of toxic words decides the expected grade of unseen documents."""
    rng = random.Random(3)
    bad = [f"vile{c}" for c in "abcdefghijklmnop"]
    docs, labels, planted = [], [], {}
    for i in range(900):
        w = prose(rng, 100).split()
        n = rng.choice([0, 0, 0, 3, 12, 40])
        for at in rng.sample(range(100), n):
            w[at] = rng.choice(bad)
        docs.append((i, " ".join(w), "", "", 0))
        planted[i] = n
        labels.append((i, 1, int(n > 0)))
    model = toxicity.train(table(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    unseen = toxicity.score(table(docs, DOCS), model).where(quality.held_out("doc_id"))
    values = {}
    for r in unseen.collect():
        values.setdefault(planted[r.doc_id], []).append(r._severity)
    means = [np.mean(values[n]) for n in (0, 3, 12, 40)]
    assert means[0] < toxicity.THRESHOLD and all(b > a + 0.3 for a, b in zip(means, means[1:]))


def test_samples_are_bounded_by_ids_and_sizes(table, spark):
    """A text of a million lines and ids that repeat do not reach the driver."""
    rng = random.Random(2)
    docs = [(i, prose(rng, 30) + "\n" + prose(rng, 5), "", "", 0) for i in range(200)]
    docs += [(i, "again " + docs[i][1], "", "", 0) for i in range(200)] + [(500, "x\n" * 1_000_000, "", "", 0)]
    labels = [(i, i % 2, i % 2) for i in [*range(200), *range(200), 500]]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    lines = quality.F.size(quality.F.split("text", "\n"))
    rows = quality.sampled(table(docs, DOCS), labels, "quality", 150, lines, 250).collect()
    assert 100 <= len(rows) <= 125 and len({r.doc_id for r in rows}) == len(rows)
    assert all(r.doc_id < 200 and r.text.startswith("again") for r in rows)
    field = quality.train(table(docs, DOCS), labels, lines=300)
    assert field.weights.shape == (quality.WIDTH,)


def test_clashing_columns_are_replaced(table, spark):
    docs = table([(1, "some words here", 7.0, 8.0, 9)], "doc_id long, text string, _quality double, _severity double, _n_words int")
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = quality.score(docs, quality.train(docs, empty))
    two = toxicity.score(docs, toxicity.train(docs, empty))
    three = substring.remove_repeats(docs)
    assert one.columns == ["doc_id", "text", "_severity", "_n_words", "_quality"] and one.first()._quality > 0.5
    assert two.columns == ["doc_id", "text", "_quality", "_n_words", "_severity"] and two.first()._severity < 0.1
    assert three.columns == ["doc_id", "text", "_quality", "_severity", "_n_words", "_n_removed"]
    assert three.first()._n_words == 3


@pytest.mark.parametrize("labels", [[], [(None, 1, 0), (1, 1, 1)], [(3, None, None), (77, 0, 1)]])
def test_models_without_usable_labels(table, spark, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = table(ODD, DOCS)
    good = quality.score(docs, quality.train(docs, known)).collect()
    assert len(good) == len(ODD) and all(r._quality > quality.THRESHOLD for r in good)
    mild = toxicity.score(docs, toxicity.train(docs, known)).collect()
    assert len(mild) == len(ODD) and all(r._severity < toxicity.THRESHOLD for r in mild)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean, bad, toxic, repeated and odd documents, some of them labelled."""
    rng, path = random.Random(6), tmp_path_factory.mktemp("tables")
    sentence = lambda n: prose(rng, n).capitalize() + "."
    passage = sentence(60)
    rows, labels = [], []
    for i in range(300):
        kind = i % 6
        text = "\n".join(sentence(rng.randint(8, 30)) for _ in range(4))
        if kind == 0:
            text = "\n".join(" ".join(["SPAM!!"] * 20) for _ in range(4))
        elif kind == 1:
            text = text.replace(" w1", " vilest w1").replace(" w2", " vile w2") + " vile."
        elif kind == 2:
            text = text + "\n" + passage
        rows.append((i, text, "en", "s", len(text)))
        if i % 2 or kind == 0:
            labels.append((i, int(kind != 0), int(kind == 1)))
    rows += [(1000 + i, rows[3][1] + f" tail{i}", "en", "s", 0) for i in range(5)]
    rows += [(2000, None, "en", "s", 0), (2001, "", "en", "s", 0), (None, sentence(20), "en", "s", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), passage


def test_pipeline_stages(spark, folder):
    path, passage = folder
    docs = read(spark, path, "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(corpus_pipeline.staged(stage(spark, seen[-1], path), name))
        assert seen[-1].columns == docs.columns
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in seen]
    clean = {i for i in range(300) if i % 6 > 1}
    assert ids[1] == ids[0] - {i for i in range(300) if i % 6 == 0}
    assert ids[2] == ids[1] - {i for i in range(300) if i % 6 == 1}
    assert ids[3] == ids[2] - {1000 + i for i in range(5)} and clean <= ids[3] and None in ids[3]
    assert ids[4] == ids[3]
    texts = {r.doc_id: r.text for r in seen[4].collect()}
    assert all(passage not in (t or "") for t in texts.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, seen[4], path).toPandas()
    assert set(pieces.doc_id.dropna().astype(int)) == {i for i in ids[4] if i is not None}
    assert sorted(corpus_pipeline.run(spark, path).toPandas().length.tolist()) == sorted(pieces.length.tolist())


def test_stages_of_an_empty_table(spark, folder):
    path, _ = folder
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0
