import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.porter import porter_stem
from typerank.operators import features, index, search
from typerank.schemas import FEATURES, STOP_WORDS
from typerank.sources.stage import staged

DOCS = [("d1", "red fox red"), ("d2", "fox"), ("d3", "blue whale fox fox"), ("d4", "the")]


def questions(spark, rows):
    return spark.createDataFrame(rows, "id string, question string")


@pytest.fixture(scope="module")
def small(spark):
    docs = spark.createDataFrame(DOCS, "doc_id string, catch_all string")
    return index.build_index(docs)


def test_index_tables(spark, small, rows):
    assert rows(small.term_stats) == [("blue", 1), ("fox", 3), ("red", 1), ("whale", 1)]
    assert rows(small.doc_stats) == [("d1", 3), ("d2", 1), ("d3", 4)]
    assert rows(small.field_stats) == [(3, round(8 / 3, 6))]
    sums = small.postings.agg(F.sum("tf"), F.max("dl")).first()
    assert tuple(sums) == (8, 4)
    assert small.term_stats.where("df > 3").count() == 0


def test_index_is_replaced_and_loaded(spark, small, rows, tmp_path):
    path = str(tmp_path / "index")
    docs = spark.createDataFrame([("x", "old text")], "doc_id string, catch_all string")
    index.build_index(docs, path)
    small.save(path)
    loaded = index.load_index(spark, path)
    assert rows(loaded.postings) == rows(small.postings)
    freqs = index.doc_term_freqs(loaded, spark.createDataFrame([("d1",), ("no",)], "doc_id string"))
    assert [r.asDict() for r in freqs.collect()] == [{"doc_id": "d1", "freqs": {"red": 2, "fox": 1}}]


@pytest.mark.parametrize("plan", ["direct", "pruned"])
def test_bm25_by_hand(spark, small, rows, plan):
    asked = questions(spark, [("q", "Red fox"), ("none", "green"), ("null", None)])
    assert rows(search.retrieve(asked, small, plan=plan)) == [
        ("q", 1, "d1", 0.649942),
        ("q", 2, "d2", 0.081546),
        ("q", 3, "d3", 0.073168),
    ]


def test_features_by_hand(spark, small, rows):
    terms = search.analyze_queries(questions(spark, [("q", "red the fox fox green")]), small)
    assert [r.term for r in terms.orderBy("pos").collect()] == ["red", "fox", "fox"]
    pairs = spark.createDataFrame(
        [("q", d) for d in ("d1", "d2", "d3", "gone")], "id string, doc_id string"
    )
    got = features.ltr_features(pairs, terms, small)
    assert got.columns == ["id", "doc_id", *FEATURES]
    query = (3.0, 1.098612, 1.098612, 0.366204)
    assert rows(got) == [
        ("q", "d1", *query, 3.0, 3.0, 4.0, 2.0, 1.333333),
        ("q", "d2", *query, 1.0, 2.0, 2.0, 1.0, 0.666667),
        ("q", "d3", *query, 4.0, 2.0, 4.0, 2.0, 1.333333),
        ("q", "gone", *query, 0.0, 0.0, 0.0, 0.0, 0.0),
    ]


def brute_force(docs, asked, k, stem=False):
    def tokens(text):
        kept = [w for w in text.lower().split() if w not in STOP_WORDS]
        return [porter_stem(w) for w in kept] if stem else kept

    bags = {d: tokens(t) for d, t in docs}
    bags = {d: b for d, b in bags.items() if b}
    n, avgdl = len(bags), sum(map(len, bags.values())) / len(bags)
    df = {}
    for bag in bags.values():
        for term in set(bag):
            df[term] = df.get(term, 0) + 1
    out = []
    for qid, text in asked:
        scored = []
        for d, bag in bags.items():
            score = 0.0
            for term in tokens(text):
                tf = bag.count(term)
                if tf:
                    norm = tf + 1.2 * (0.25 + 0.75 * len(bag) / avgdl)
                    score += math.log(1 + (n - df[term] + 0.5) / (df[term] + 0.5)) * tf / norm
            if score:
                scored.append((-round(score, 6), d))
        out += [(qid, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def crowd():
    """Documents and questions that share one very frequent word."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)] + ["running", "runs", "ponies", "pony"]

    def text(n):
        picked = [rng.choice(words) for _ in range(n)]
        return " ".join(picked + ["hot"] * rng.choice([0, 0, 1, 2]))

    docs = [(f"d{i:03}", text(rng.randint(1, 30))) for i in range(200)]
    docs += [(f"copy{i}", "hot w1") for i in range(30)]
    asked = [(f"q{i}", text(rng.randint(0, 6))) for i in range(40)]
    asked += [("hot", "hot"), ("hot2", "hot hot w1"), ("empty", "the of")]
    return docs, asked


@pytest.mark.parametrize("plan", ["direct", "pruned"])
@pytest.mark.parametrize("k", [1, 10])
def test_exact_top_k(spark, crowd, rows, plan, k, monkeypatch):
    monkeypatch.setattr(search, "SPLIT_ABOVE", 2)
    monkeypatch.setattr(search, "PAIRS", 100)
    docs, asked = crowd
    built = index.build_index(spark.createDataFrame(docs, "doc_id string, catch_all string"))
    assert rows(search.retrieve(questions(spark, asked), built, k, plan)) == brute_force(
        docs, asked, k
    )


def test_grid_follows_the_pairs(spark, monkeypatch):
    docs = [(f"d{i:04}", f"hot x{i % 97}") for i in range(1000)]
    built = index.build_index(spark.createDataFrame(docs, "doc_id string, catch_all string"))
    terms = search.analyze_queries(questions(spark, [(f"q{i}", "hot") for i in range(50)]), built)
    weighted = search.weighted_query(terms, built)
    assert search.grid(weighted, built) == search.Grid(1, 1)
    monkeypatch.setattr(search, "PAIRS", 1000)
    # 50 cells; 2,000 postings and 50 terms, so rather more shards than blocks.
    cells = search.grid(weighted, built)
    assert cells.shards * cells.blocks >= 50 and cells.shards == 45
    none = weighted.where("false")
    assert search.grid(none, built) == search.Grid() and search.direct_scores(none, built).count() == 0


def test_copies_do_not_grow_with_the_pairs(spark, monkeypatch):
    """Each further cell copies postings and query terms; only what fits in one counts."""
    docs = [(f"d{i:04}", f"hot x{i % 97}") for i in range(1000)]
    built = index.build_index(spark.createDataFrame(docs, "doc_id string, catch_all string"))
    terms = search.analyze_queries(questions(spark, [(f"q{i}", "hot") for i in range(50)]), built)
    weighted = staged(search.weighted_query(terms, built))
    want = sorted((r.id, r.doc_id, round(r.score, 9)) for r in search.direct_scores(weighted, built, 3).collect())
    monkeypatch.setattr(search, "PAIRS", 10)
    monkeypatch.setattr(search, "CELLS", 8)
    # 5,000 cells would copy every posting 12 times and every query term 447 times.
    assert search.grid(weighted, built) == search.Grid(8, 1)
    monkeypatch.setattr(search, "HELD", 200)
    cells = search.grid(weighted, built)
    assert cells == search.Grid(10, 1)
    monkeypatch.setattr(search, "HELD", 25)
    assert search.grid(weighted, built).blocks == 2
    found = search.direct_scores(weighted, built, 3, cells)
    got = search.top_k(found, 3).collect()
    assert [(r[0], r[1], round(r[2], 6)) for r in want] == sorted((r.id, r.doc_id, r.score) for r in got)


@pytest.mark.parametrize("share", [0, 0.05, 1])
def test_dense_and_sparse_terms_add_up(monkeypatch, share):
    """In any mixture, also where an id is null or a posting repeats."""
    monkeypatch.setattr(search, "DENSE_SHARE", share)
    monkeypatch.setattr(search, "PAIRS", 40)
    rng = random.Random(5)
    asked = [(f"q{i}" if i else None, t, rng.choice([0.5, 1.0])) for i in range(30) for t in rng.sample("abcdefg", 3)]
    held = [(f"d{i:02}" if i else None, t, rng.choice([0.25, 0.5])) for i in range(50) for t in "a" + "".join(rng.sample("abcdefg", 2))]
    sums = {}
    for q, t, w in asked:
        for d, u, x in held:
            if t == u:
                sums[q, d] = sums.get((q, d), 0.0) + w * x
    want = []
    for q in {q for q, _ in sums}:
        best = sorted((-s, d or "", d) for (p, d), s in sums.items() if p == q)
        want += [(q, d, -s) for s, _, d in best[:4]]
    tables = (pa.table(dict(zip(n, map(list, zip(*r))))) for n, r in ((("id", "term", "weight"), asked), (("doc_id", "term", "impact"), held)))
    got = [(r["id"], r["doc_id"], r["score"]) for r in search.cell_scores(*tables, 4).to_pylist()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("matches", [1, 5, 1000])
@pytest.mark.parametrize("k", [1, 3, None])
def test_a_cell_adds_up_its_matches(monkeypatch, matches, k):
    """In slices of any size; ties go to the smaller document."""
    monkeypatch.setattr(search, "MATCHES", matches)
    rng = random.Random(4)
    asked = [(f"q{i}", t, rng.choice([0.5, 1.0])) for i in range(6) for t in rng.sample("abcdefg", 3)] + [("none", "z", 1.0)]
    held = [(f"d{i}", t, rng.choice([0.25, 0.5])) for i in range(9) for t in rng.sample("abcdef", 3)] + [("other", "y", 1.0)]
    tables = (
        pa.table(dict(zip(names, map(list, zip(*rows)))))
        for names, rows in ((("id", "term", "weight"), asked), (("doc_id", "term", "impact"), held))
    )
    sums = {}
    for q, t, w in asked:
        for d, u, x in held:
            if t == u:
                sums[q, d] = sums.get((q, d), 0.0) + w * x
    want = []
    for q in {q for q, _ in sums}:
        best = sorted((-s, d) for (p, d), s in sums.items() if p == q)
        want += [(q, d, -s) for s, d in best[:k]]
    got = search.cell_scores(*tables, k).to_pylist()
    assert sorted((r["id"], r["doc_id"], r["score"]) for r in got) == sorted(want)


def test_weak_terms_count_where_the_cut_is_reached():
    asked = pa.table({"id": ["q"] * 3, "term": ["a", "b", "c"], "weight": [1.0, 1.0, 1.0], "weak": [False, True, True], "cut": [0.5] * 3})
    held = [("d1", "a", 0.5), ("d1", "b", 0.25), ("d2", "a", 0.25), ("d2", "b", 0.75), ("d3", "c", 1.0), ("d4", "a", 1.0)]
    held = pa.table(dict(zip(("doc_id", "term", "impact"), map(list, zip(*held)))))
    got = [(r["doc_id"], r["score"]) for r in search.cell_scores(asked, held, None).to_pylist()]
    assert got == [("d1", 0.75), ("d4", 1.0)]


def test_candidates_of_the_pruned_plan_are_no_rows(spark):
    """At most k rows of a query leave a cell, however many documents reach the cut."""
    docs = [(f"d{i:04}", f"hot x{i % 3}") for i in range(300)]
    built = index.build_index(spark.createDataFrame(docs, "doc_id string, catch_all string"))
    terms = search.analyze_queries(questions(spark, [("q", "hot x1")]), built)
    assert search.scores(terms, built, 5, "pruned").count() == 5


def test_pruning_skips_frequent_terms(spark, crowd):
    """The frequent word must not bring all its documents into the scoring."""
    docs = [(f"d{i:04}", f"hot filler{i % 5} x{i % 97}") for i in range(1000)]
    built = index.build_index(spark.createDataFrame(docs, "doc_id string, catch_all string"))
    asked = questions(spark, [("q", "x3 hot filler1")])
    terms = search.analyze_queries(asked, built)
    assert search.direct_scores(search.weighted_query(terms, built), built).count() == 1000
    assert search.scores(terms, built, 5, "pruned").count() < 300


def test_stemmed_index(spark, crowd, rows):
    docs, asked = crowd
    built = index.build_index(
        spark.createDataFrame(docs, "doc_id string, catch_all string"), stem=True
    )
    assert rows(search.retrieve(questions(spark, asked), built, 5)) == brute_force(
        docs, asked, 5, stem=True
    )
    sums = built.postings.agg(F.sum("tf")).first()[0], built.doc_stats.agg(F.sum("dl")).first()[0]
    assert sums[0] == sums[1]


def test_raw_lookup_counts_self_stems_only(spark):
    docs = spark.createDataFrame([("d", "running fox"), ("e", "runs")], "doc_id string, catch_all string")
    built = index.build_index(docs, stem=True)
    terms = search.analyze_queries(questions(spark, [("q", "running fox")]), built)
    pairs = spark.createDataFrame([("q", "d")], "id string, doc_id string")
    one = features.ltr_features(pairs, terms, built).first()
    raw = features.ltr_features(pairs, terms, built, raw_lookup=True).first()
    assert (one.query_length, one.unique_query_terms_in_catch_all) == (2.0, 2.0)
    assert (raw.query_length, raw.unique_query_terms_in_catch_all) == (2.0, 1.0)
    assert raw.query_sum_idf == pytest.approx(math.log(2))


def test_two_fields_take_the_better_score(spark, rows):
    docs = spark.createDataFrame(
        [("fox", "fox", "red fox"), ("dog", "dog", "fox fox fox")],
        "doc_id string, type string, catch_all string",
    )
    built = {f: index.build_index(docs, text=f) for f in ("type", "catch_all")}
    asked = questions(spark, [("q", "fox")])
    terms = {f: search.analyze_queries(asked, i) for f, i in built.items()}
    both = search.multi_field_topk(terms, built)
    single = {f: {r.doc_id: r.score for r in search.retrieve(asked, i).collect()} for f, i in built.items()}
    for r in both.collect():
        assert r.score == max(s.get(r.doc_id, 0.0) for s in single.values())


def test_possessives_on_both_sides(spark, rows):
    docs = spark.createDataFrame(
        [("a", "class s ship"), ("b", "Obama's dog")], "doc_id string, catch_all string"
    )
    built = index.build_index(docs)
    asked = questions(spark, [("q", "Obama's dog")])
    assert [r.term for r in search.analyze_queries(asked, built).orderBy("pos").collect()] == ["obama", "dog"]
    assert [r.doc_id for r in search.retrieve(asked, built).collect()] == ["b"]


def test_later_loads_replace_earlier_ones(spark, rows):
    docs = spark.createDataFrame(
        [("d1", "red red", 1), ("d2", "fox", 2), ("d1", "blue", 3)], "doc_id string, catch_all string, n int"
    )
    built = index.build_index(docs, order="n")
    assert rows(built.postings) == [("d1", "blue", 1, 1), ("d2", "fox", 1, 1)]
    assert rows(built.field_stats) == [(2, 1.0)]
    same = docs.drop("n").union(docs.drop("n"))
    assert index.build_index(same.where("doc_id = 'd2'")).doc_stats.count() == 1


@pytest.mark.parametrize("stem", [False, True])
def test_upsert_equals_a_full_rebuild(spark, rows, stem, tmp_path, monkeypatch):
    schema = "doc_id string, catch_all string"
    old = [("a", "red fox running"), ("b", "blue ponies"), ("c", "grey pony fox"), ("d", "the")]
    load = [("b", "green foxes run run"), ("c", "the of"), ("e", "zebra fox"), ("d", "now ponies"), ("f", None)]
    built = index.build_index(spark.createDataFrame(old, schema), stem=stem)
    seen = []
    postings = index.document_postings
    monkeypatch.setattr(index, "document_postings", lambda d, t: seen.append(rows(d.select("doc_id"))) or postings(d, t))
    path = str(tmp_path / "new")
    got = index.upsert(built, spark.createDataFrame(load, schema), path)
    # Only the loaded documents are tokenized.
    assert seen == [sorted((d,) for d, _ in load)]
    monkeypatch.undo()
    merged = spark.createDataFrame(list({**dict(old), **dict(load)}.items()), schema)
    want = index.build_index(merged, stem=stem)
    for name in ("postings", "term_stats", "doc_stats", "field_stats"):
        assert rows(getattr(got, name)) == rows(getattr(want, name)), name
    loaded = index.load_index(spark, path, stem=stem)
    assert rows(loaded.postings) == rows(got.postings)
    asked = questions(spark, [("q", "running fox pony")])
    assert rows(search.retrieve(asked, loaded)) == rows(search.retrieve(asked, want))
    # The former index still answers.
    assert {r.doc_id for r in built.doc_stats.collect()} == {"a", "b", "c"}


def test_later_rows_of_a_load_win_and_all_documents_can_go(spark, rows):
    schema = "doc_id string, catch_all string, n int"
    built = index.build_index(spark.createDataFrame([("a", "red", 0)], schema))
    twice = spark.createDataFrame([("a", "blue blue", 1), ("a", "green", 2)], schema)
    got = index.upsert(built, twice, order="n")
    assert rows(got.postings) == [("a", "green", 1, 1)] and rows(got.term_stats) == [("green", 1)]
    gone = index.upsert(got, spark.createDataFrame([("a", "", 3)], schema), order="n")
    assert gone.postings.count() == gone.term_stats.count() == gone.doc_stats.count() == 0
    assert rows(gone.field_stats) == [(0, None)]


def test_postings_of_pieces_equal_those_of_the_text(spark, rows):
    pieces = [("t", i, f"w{i % 7} Fox's the{' red' * (i % 3)}" if i % 5 else None) for i in range(60)]
    pieces += [("empty", 60, ""), ("u", 61, "blue")]
    df = spark.createDataFrame(pieces, "type string, ord long, piece string")
    whole = {}
    for kind, _, piece in pieces:
        whole[kind] = whole.get(kind, "") + " " + (piece or "")
    documents = spark.createDataFrame(list(whole.items()), "doc_id string, catch_all string")
    for stem in (False, True):
        one = index.build_index_from_pieces(df, stem=stem)
        two = index.build_index(documents, stem=stem, unique=True)
        assert rows(one.postings) == rows(two.postings)
        assert rows(one.field_stats) == rows(two.field_stats)


@pytest.mark.parametrize("prune", [False, True])
@pytest.mark.parametrize("share", [0, 1])
def test_single_precision_does_not_decide(monkeypatch, prune, share):
    """Scores that differ from the sixth digit on are ranked as in double precision, whether
    terms are dense rows (share 0) or not."""
    monkeypatch.setattr(search, "DENSE_SHARE", share)
    rng = random.Random(11)
    terms = [f"t{i}" for i in range(40)]
    asked = [(f"q{i}", t, rng.choice([1.0, 2.0]) * 3.7) for i in range(4) for t in rng.sample(terms, 20)]
    held = [(f"d{i:03}", t, 0.5 + rng.randint(0, 9) * 3e-6) for i in range(400) for t in terms if rng.random() < 0.9]
    sums = {}
    weights = {(q, t): w for q, t, w in asked}
    for d, t, x in held:
        for q in ("q0", "q1", "q2", "q3"):
            if (q, t) in weights:
                sums[q, d] = sums.get((q, d), 0.0) + weights[q, t] * x
    want = {q: sorted((-math.floor(s * 1e6 + 0.5), d) for (p, d), s in sums.items() if p == q)[:5] for q in ("q0", "q1", "q2", "q3")}
    tables = (pa.table(dict(zip(n, map(list, zip(*r))))) for n, r in ((("id", "term", "weight"), asked), (("doc_id", "term", "impact"), held)))
    got = {}
    for r in search.cell_scores(*tables, 5, prune).to_pylist():
        got.setdefault(r["id"], []).append((-math.floor(r["score"] * 1e6 + 0.5), r["doc_id"]))
    assert got == want
