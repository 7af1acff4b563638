"""The n-gram join against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tests.llm.test_pairs import DOCS, grouped, shingles, words
from typerank.llm import ngram_join
from typerank.llm.common import staged

#: Both kinds of columns in short texts; a common gram is chosen all but surely.
SMALL = ngram_join.Join(cut=40, every=2)


def expected(rows, percent=90):
    return sorted(((i, len(s), low) for i, s, low in grouped(rows, 3, percent)), key=repr)


def found(table, rows, p):
    docs = table([(i, t, "en", "clash") for i, t in rows], DOCS)
    return sorted((tuple(r) for r in ngram_join.ngram_links(docs, p=p).collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    base = [prose(rng, rng.randint(1, 150)) for _ in range(50)]
    passage = prose(rng, 30)
    texts = base + [f"{passage} {t}" for t in base[:20]]
    for _ in range(200):
        w = words(rng.choice(base[:10]))
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(["x", "y", "Z"])
        texts.append(" ".join(w))
    texts += [base[0].upper(), base[0].replace(" ", "\n\t"), "one", "One", "two words", None, "", " \n", prose(rng, 9000)]
    texts += [" ".join(f"n{i}" for i in range(11)), " ".join(f"n{i}" for i in range(12))]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts)) + [(ids[0], texts[0]), (None, base[1]), (ids[3], base[2]), (None, "nobody like me here")]


@pytest.mark.parametrize("p", [ngram_join.Join(), SMALL])
def test_components_against_brute_force(table, corpus, p):
    assert found(table, corpus, p) == expected(corpus)


def test_chains_are_linked_beyond_the_hubs(table):
    w = [f"t{i}" for i in range(700)]
    rows = [(i, " ".join(w[3 * i : 3 * i + 200])) for i in range(60)]
    rows += [(100 + i, " ".join(w[:100] + [f"s{i}_{j}" for j in range(20)])) for i in range(30)]
    for p in (ngram_join.Join(), SMALL):
        assert found(table, rows, p) == expected(rows)


def test_a_large_cluster_in_blocks(table, monkeypatch):
    """Neighbours in several blocks; most are not similar to the hubs."""
    monkeypatch.setattr(ngram_join, "BLOCK", 600)
    monkeypatch.setattr(ngram_join, "COLUMNS", 64)
    rng = random.Random(1)
    base = words(prose(rng, 90))
    rows = []
    for i in range(120):
        w = list(base)
        for at in rng.sample(range(90), rng.randint(0, 4)):
            w[at] = f"e{i % 17}_{at}"
        rows.append((i, " ".join(w)))
    assert found(table, rows, SMALL) == expected(rows)


def test_block_products_link_the_components(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        w = words(prose(random.Random(i // 20), 150))
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = f"new{i}"
        rows.append((i, " ".join(w)))
    p = ngram_join.Join()
    docs = spark.createDataFrame(rows, "id long, text string")
    classes = staged(ngram_join.matrix_rows(docs, p, chosen=True).withColumnRenamed("id", "node"), "classes")
    full = ngram_join.full_rows(docs.withColumnRenamed("id", "node"), p)
    sets = [shingles(t, 3) for _, t in rows]
    similar = {
        (i, j) for i, j in itertools.combinations(range(60), 2)
        if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])
    }
    for group in (1, 5):
        mixed = ngram_join.heads(classes, p).withColumn("component", F.col("node") - F.col("node") % group)
        blocks = ngram_join.patches(mixed, full)
        pairs = {tuple(sorted(r)) for r in ngram_join.block_products(blocks, p).collect()}
        between = {(i // group, j // group) for i, j in similar if i // group != j // group}
        assert pairs <= similar and {(i // group, j // group) for i, j in pairs} == between


def test_rows_without_a_partner_have_no_head(spark):
    """Own grams beyond the bound, although a passage is shared."""
    rng = random.Random(2)
    passage = prose(rng, 60)
    rows = [(i, " ".join([passage, *(f"u{i}_{j}" for j in range(300))])) for i in range(20)]
    p = ngram_join.Join()
    docs = spark.createDataFrame(rows, "id long, text string")
    classes = staged(ngram_join.matrix_rows(docs, p, chosen=True).withColumnRenamed("id", "node"), "classes")
    assert ngram_join.heads(classes, p).count() == 0


def test_least_overlap_is_exact():
    p = ngram_join.Join()
    for a, b in itertools.product(range(1, 60), repeat=2):
        least = min((k for k in range(min(a, b) + 1) if 100 * k >= 90 * (a + b - k)), default=None)
        if least is not None:
            assert p.overlap(a, b) == least
    assert [p.missing(n) for n in (1, 9, 10, 19, 20, 105)] == [0, 0, 1, 1, 2, 10]
    assert np.all(p.overlap(np.array([10, 20]), np.array([10, 20])) == [10, 19])


def test_empty_table(spark):
    assert ngram_join.ngram_links(spark.createDataFrame([], DOCS)).count() == 0
