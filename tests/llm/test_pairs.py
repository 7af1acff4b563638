"""Near duplicates, repeated passages and fingerprints against plain Python."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import prose
from typerank.llm import common, fingerprint, neardup, substring

DOCS = "doc_id long, text string, lang string, component string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, width):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def grouped(rows, width, percent):
    """(id, set, smallest id of the group) of each row; every row is a document."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in itertools.combinations(range(len(sets)), 2):
        a, b = sets[x][1], sets[y][1]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            parent[root(y)] = root(x)
    groups = {}
    for x in range(len(sets)):
        groups.setdefault(root(x), []).append(sets[x][0])
    lowest = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return [(i, s, lowest[root(x)]) for x, (i, s) in enumerate(sets)]


def components(rows, width, percent):
    return {(i, len(s), low, low == i) for i, s, low in grouped(rows, width, percent)}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(60)]
    texts = list(base)
    for _ in range(150):
        w = words(rng.choice(base[:12]))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(["x", "y", "Z"])
        texts.append(" ".join(w))
    texts += [base[0].upper(), base[0].replace(" ", "\n\t"), "one", "One", "two words", None, "", " \n", prose(rng, 9000)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts)) + [(ids[0], texts[0]), (None, base[1])]


@pytest.mark.parametrize("p", [neardup.QUERY, neardup.STAGE])
def test_near_duplicates_against_brute_force(table, corpus, p):
    docs = table([(i, t, "en", "clash") for i, t in corpus], DOCS)
    got = neardup.near_duplicates(docs, p=p)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(corpus)
    assert set(rows) == components(corpus, p.width, p.percent)


REPEATED = [(3, "A b c d e f"), (5, "A b c d e f"), (5, "other words that stand here alone"), (7, None), (7, "a good text of its own")]


def test_ids_that_repeat_with_other_texts(table):
    """Each text is judged on its own, and no text without a copy is lost."""
    docs = table([(i, t, "", "") for i, t in REPEATED], DOCS)
    got = {tuple(r) for r in neardup.near_duplicates(docs, p=neardup.STAGE).collect()}
    assert got == {(3, 2, 3, True), (5, 2, 3, False), (5, 2, 5, True), (7, 0, 7, True), (7, 2, 7, True)}
    kept = neardup.survivors(docs).select("doc_id", "text").collect()
    assert {tuple(r) for r in kept} == {REPEATED[0], *REPEATED[2:]} and len(kept) == 4


def test_survivors_are_one_of_each_group(table):
    rng = random.Random(4)
    base = [prose(rng, 60) for _ in range(6)]
    texts = [(i, rng.choice([str, str.upper])(base[i % 6])) for i in range(30)] + [(4, base[4].upper()), (None, base[1])]
    texts += [(None, "no id here but some words"), (None, "no id here but some words"), (None, None), (9, " "), (9, " ")]
    rows = [(i, t, "x", "y") for i, t in texts]
    schema = "doc_id long, text string, id string, set_hash string"
    kept = neardup.survivors(table(rows, schema))
    assert kept.columns == ["doc_id", "text", "id", "set_hash"]
    got = sorted((tuple(r) for r in kept.collect()), key=repr)
    groups = {}
    for (i, t), (_, s, _) in zip(texts, grouped(texts, 5, 80)):
        groups.setdefault(frozenset(s) or object(), []).append((i is None, i or 0, t))
    want = [min(g) for g in groups.values() if g[0][2] and g[0][2].strip()]
    want = [(None if none else i, t, "x", "y") for none, i, t in want]
    assert got == sorted(want + [(None, None, "x", "y"), (9, " ", "x", "y"), (9, " ", "x", "y")], key=repr)


def test_links_beyond_the_hub_are_found(table):
    """A chain of neighbours: most are not similar to the first, and are linked all the same."""
    w = [f"t{i}" for i in range(400)]
    rows = [(i, " ".join(w[4 * i : 4 * i + 200]), "", "") for i in range(40)]
    got = {r.id: r.component_id for r in neardup.near_duplicates(table(rows, DOCS)).collect()}
    assert set(got.values()) == {0}


def test_bit_maps_never_reject_a_similar_pair(spark):
    rng = random.Random(5)
    p = neardup.QUERY
    rows = []
    for i in range(60):
        w = words(prose(random.Random(i // 20), 150))
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = "new"
        rows.append((i, " ".join(w)))
    marks = neardup.signatures(spark.createDataFrame(rows, "id long, text string"), p)
    apart = marks.selectExpr("1L AS key", "id", "n_shingles", "id AS component", "bits", "60L AS n")
    possible = {tuple(r) for r in neardup._still_possible(apart, p).collect()}
    sets = [shingles(t, 3) for _, t in rows]
    similar = {
        (i, j) for i, j in itertools.combinations(range(60), 2)
        if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    }
    assert similar and similar <= possible


def test_minimum_and_maximum_agree_as_often_as_the_sets_do():
    rng = np.random.default_rng(0)
    common_, one, two = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (600, 200, 200))
    p = neardup.MinMax(permutations=500, rows=1)
    a, b = np.concatenate([common_, one]), np.concatenate([common_, two])
    keys = neardup._bands(np.concatenate([a, b]), np.array([0, 800, 1600]), p)
    assert abs((keys[0] == keys[1]).mean() - 0.6) < 0.05


def plain_removal(rows, width):
    texts = [words(t) for _, t in rows]
    counts = Counter(tuple(w[i : i + width]) for w in texts for i in range(len(w) - width + 1))
    out = []
    for (i, _), w in zip(rows, texts):
        gone = set()
        for k in range(len(w) - width + 1):
            if counts[tuple(w[k : k + width])] > 1:
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def test_repeated_passages_against_brute_force(table):
    rng = random.Random(8)
    passages = [prose(rng, n) for n in (35, 34, 60, 120)]
    rows = []
    for i in range(80):
        parts = [prose(rng, rng.randint(0, 50)) for _ in range(3)]
        parts.insert(1, rng.choice(passages) if i % 3 else "")
        rows.append((i, rng.choice([" ", "\n", "\x0b "]).join(parts)))
    rows += [(90, passages[2] + " " + passages[2]), (91, " ".join(["a"] * 90)), (92, None), (93, ""), (93, passages[3]), (None, passages[0])]
    rows += [(95, prose(rng, 6000) + " " + passages[2] + " glued " + prose(rng, 3000))]
    docs = table([(i, t, "l", "c") for i, t in rows], DOCS)
    got = substring.remove_repeats(docs)
    assert got.columns == [*docs.columns, "_n_words", "_n_removed"]
    assert sorted(((r.doc_id, r._n_words, r._n_removed, r.text) for r in got.collect()), key=repr) == plain_removal(rows, 35)


def test_copies_are_one_path_and_branches_cut_it(table):
    rng = random.Random(9)
    shared, other = prose(rng, 80), prose(rng, 50)
    rows = [(1, shared), (2, shared), (3, prose(rng, 10) + " " + shared + " " + other), (4, other + " " + prose(rng, 10))]
    found = substring.repeated_paths(table([(i, t, "", "") for i, t in rows], DOCS)).collect()
    assert sorted((r.id, r.first_word, r.n_words) for r in found) == [(1, 0, 80), (2, 0, 80), (3, 10, 80), (3, 90, 50), (4, 0, 50)]
    assert Counter(Counter(r.path for r in found).values()) == {3: 1, 2: 1}


def test_paths_with_other_words_at_a_place_are_told():
    """As after a collision of hashes: the digests of the words differ."""
    answers = substring._answers(2, pa.table({
        "bucket": [0, 0], "chunk": [1, 2], "hashes": [np.uint64([5, 9]).tobytes(), np.uint64([5, 9]).tobytes()],
        "before": [np.uint64([1, 1]).tobytes(), np.uint64([2, 1]).tobytes()], "after": [np.uint64([7, 7]).tobytes()] * 2, "flags": [b"\0\0"] * 2,
    }))
    bits = np.unpackbits(np.frombuffer(answers["bits"][0].as_py(), np.uint8))[:6].reshape(3, 2)
    assert bits.tolist() == [[1, 1], [1, 0], [0, 0]]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\x1c é", max_size=30)), max_size=8))
def test_words_of_any_text(texts):
    found = common.Words(pa.array(texts, pa.string()))
    spans = [bytes(found.data[a:b]).decode() for a, b in zip(found.starts, found.ends)]
    assert [spans[a:b] for a, b in zip(found.bounds, found.bounds[1:])] == [words(t) for t in texts]
    by_word = dict(zip(spans, found.hashes.tolist()))
    assert [by_word[s] for s in spans] == found.hashes.tolist() and len(set(by_word.values())) == len(by_word)


def test_components_grow_with_further_links(spark):
    pairs = [(i, i + 1) for i in range(0, 40, 2)]
    more = [(i, i + 1) for i in range(1, 20, 2)] + [(60, 61)]
    make = lambda x: spark.createDataFrame(x, "a long, b long")
    first = common.joined_components(None, make(pairs))
    got = {tuple(r) for r in common.joined_components(first, make(more)).collect()}
    assert got == {tuple(r) for r in common.connected(make(pairs + more)).collect()}


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    got = {tuple(r) for r in common.connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(51)} | {(i, 100) for i in range(100, 130)}
    assert common.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints_estimate_the_likeness(table):
    rng = random.Random(2)
    rows = [(i * 3, prose(rng, rng.randint(20, 400))) for i in range(40)]
    rows += [(i * 3 + 1, rows[i][1]) for i in range(5)]
    rows += [(200, None), (201, ""), (202, "a"), (203, "a"), (204, "b c"), (205, prose(rng, 8000)), (206, "é" * 7)]
    got = {r.id: r for r in fingerprint.edited_fingerprints(table([(i, t, "", "") for i, t in rows], DOCS)).collect()}
    order = sorted(rows, reverse=True)
    near = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    misses = []
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        misses.append(r.near_edited - near(shingles(text, 5), shingles(edited, 5)))
        misses.append(r.near_next - near(shingles(text, 5), shingles(after, 5)))
        assert len(r.fingerprint) == (256 if words(text) else 0)
    assert np.abs(misses).max() < 0.2 and np.abs(misses).mean() < 0.03
    assert got[0].fingerprint == got[1].fingerprint and got[202].fingerprint == got[203].fingerprint


def test_a_single_document_follows_itself(table):
    (r,) = fingerprint.edited_fingerprints(table([(5, "a b c d", "", ""), (None, "x", "", "")], DOCS)).collect()
    assert (r.id, r.near_next) == (5, 1.0)


def test_fingerprints_use_no_python(table, capsys):
    fingerprint.edited_fingerprints(table([(1, "a", "", "")], DOCS)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("run", [neardup.near_duplicates, substring.remove_repeats, fingerprint.edited_fingerprints])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], DOCS)).count() == 0
