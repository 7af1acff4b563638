"""One query per operator, on the given tables. Keys equal those of the SQL."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from typerank.catalog import inputs
from typerank.functions import text
from typerank.operators import (
    classify,
    evaluation,
    features,
    hierarchy,
    huber,
    index,
    ltr,
    questions,
    search,
    svm,
    typedocs,
)
from typerank.operators.huber import Huber
from typerank.plans import runs
from typerank.schemas import ABSTRACT_WORDS, DOCUMENT_CHARS, FEATURES, TRAIN_QUESTIONS
from typerank.sources import readers
from typerank.sources.stage import staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def joined(types: str) -> Column:
    return F.array_join(types, " ")


# Triples and documents


@query
def triples_entity_types(spark, sf):
    return typedocs.parse_types(inputs.part_lines(spark, sf)).select("ord", "entity", "type")


@query
def triples_entity_abstracts(spark, sf):
    """The first ten words of each abstract: the limit is the feature."""
    parsed = typedocs.parse_abstracts(inputs.abstract_lines(spark, sf), ABSTRACT_WORDS)
    return typedocs.entity_abstracts(parsed)


@query
def triples_page_abstracts(spark, sf):
    """The whole literal as abstract; pages of one name collide, the last one wins."""
    parsed = typedocs.parse_abstracts(inputs.page_abstract_lines(spark, sf), n_words=None)
    return typedocs.entity_abstracts(parsed)


@query
def type_entity_lists(spark, sf):
    return typedocs.type_entity_lists(typedocs.parse_types(inputs.part_lines(spark, sf)))


@query
def type_documents(spark, sf):
    """The first 20,000 characters of each type document: the cap is the feature."""
    pieces = inputs.type_pieces(spark, sf)
    return typedocs.indexable(typedocs.type_documents(pieces, DOCUMENT_CHARS))


@query
def type_postings(spark, sf):
    """Postings of the whole type documents, added up over their pieces."""
    return inputs.type_index(spark, sf).postings


@query
def index_documents(spark, sf):
    """Repeated loads of one id: the last document of each source and language stays."""
    loads = _loads(spark, sf)
    return typedocs.indexable(questions.last_per_key(loads, "doc_id", "ord")).drop("ord")


def _loads(spark, sf):
    return inputs.table(spark, sf, "documents").select(
        F.concat_ws("/", "lang", "source").alias("doc_id"),
        F.col("text").alias("catch_all"),
        F.col("doc_id").alias("ord"),
    )


@query
def index_reloaded(spark, sf):
    """Postings after repeated loads of each id: the last one replaces the others."""
    built = index.build_index(_loads(spark, sf), order="ord")
    average = F.round(built.field_stats.select("avgdl").scalar(), 6)
    return built.postings.select("doc_id", "term", "tf", "dl", average.alias("avgdl"))


@query
def index_upserted(spark, sf):
    """The index of the documents after a load of the pages, which replace the documents
    that have their ids."""
    pages = inputs.texts(spark, sf, "pages", "page_id").select(
        F.col("page_id").cast("string").alias("doc_id"), F.col("html").alias("catch_all")
    )
    built = index.upsert(inputs.corpus_index(spark, sf), pages, unique=True)
    average = F.round(built.field_stats.select("avgdl").scalar(), 6).alias("avgdl")
    n = built.field_stats.select("doc_count").scalar().alias("doc_count")
    rows = built.postings.join(built.term_stats, "term")
    rows = rows.join(built.doc_stats.withColumnRenamed("dl", "doc_length"), "doc_id")
    return rows.select("doc_id", "term", "tf", "dl", "df", "doc_length", average, n)


# Text


@query
def html_preprocess(spark, sf):
    pages = inputs.texts(spark, sf, "pages", "page_id")
    return pages.select("page_id", text.preprocess(F.col("html")).alias("text"))


@query
def word_breaks(spark, sf):
    """Tokens of lines with prices, initials, apostrophes and grouped digits."""
    line = F.concat(
        "p_type",
        F.lit("\u2019s U.S. list: "),
        F.col("p_retailprice").cast("decimal(18,2)"),
        F.lit(", O'"),
        "p_name",
        F.lit("; 1,"),
        F.lpad((F.col("p_size") * 17 % 1000).cast("string"), 3, "0"),
        F.lit(" units. No."),
        "p_size",
        F.lit(" a."),
        "p_brand",
    )
    parts = inputs.table(spark, sf, "part")
    return parts.select("p_partkey", F.posexplode(text.word_tokens(line)).alias("pos", "token"))


@query
def clean_query(spark, sf):
    asked = inputs.questions(spark, sf)
    return asked.select("id", text.clean_query(F.col("question")).alias("query"))


# Questions


@query
def nonempty_questions(spark, sf):
    """Questions by conversation id: the last turn with a text wins."""
    turns = inputs.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("id"), F.col("text").alias("question"), F.col("turn").alias("ord")
    )
    return questions.last_per_key(questions.nonempty(turns), "id", "ord").select("id", "question")


@query
def train_questions(spark, sf):
    """The first hundred questions in order."""
    turns = inputs.table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.col("text").alias("question"),
        F.struct("conv_id", "turn").alias("ord"),
    )
    first, _ = readers.train_split(turns, n=100)
    return first.select("id", "question")


@query
def literal_types_blanked(spark, sf):
    orders = inputs.order_answers(spark, sf)
    blank = questions.blank_literal_types(orders)
    only = questions.resource_types(orders).select("id", F.col("type").alias("resource"))
    return blank.join(only, "id").select(
        "id", joined("type").alias("types"), joined("resource").alias("resource_types")
    )


# Index


@query
def postings(spark, sf):
    return index.document_postings(index.by_document(inputs.corpus(spark, sf)))


@query
def term_stats(spark, sf):
    return index.term_statistics(index.document_postings(index.by_document(inputs.corpus(spark, sf))))


@query
def doc_stats(spark, sf):
    return index.document_stats(inputs.corpus(spark, sf))


@query
def field_stats(spark, sf):
    stats = index.field_statistics(index.document_stats(inputs.corpus(spark, sf)))
    return rounded(stats, "avgdl")


@query
def doc_term_freqs(spark, sf):
    built = inputs.corpus_index(spark, sf)
    freqs = index.doc_term_freqs(built, built.doc_stats)
    entries = F.array_sort(F.map_entries("freqs"))
    line = F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"]))
    return freqs.select("doc_id", F.array_join(line, " ").alias("freqs"))


@query
def stemmed_postings(spark, sf):
    return inputs.stemmed_corpus_index(spark, sf).postings


# Retrieval


def query_terms(spark, sf):
    return search.analyze_queries(inputs.questions(spark, sf), inputs.corpus_index(spark, sf))


@query
def analyzed_query_terms(spark, sf):
    return query_terms(spark, sf).select("id", "pos", "term")


@query
def bm25_top10(spark, sf):
    return search.bm25_topk(query_terms(spark, sf), inputs.corpus_index(spark, sf), 10)


@query
def bm25_top10_pruned(spark, sf):
    """The same result by scoring only what can be among the best."""
    return search.bm25_topk(query_terms(spark, sf), inputs.corpus_index(spark, sf), 10, plan="pruned")


@query
def bm25_top5(spark, sf):
    return search.first_pass(query_terms(spark, sf), inputs.corpus_index(spark, sf), 5)


@query
def bm25_two_fields(spark, sf):
    """Type documents by name and text: the better field counts."""
    indexes = {"type": inputs.type_name_index(spark, sf), "catch_all": inputs.type_index(spark, sf)}
    asked = inputs.questions(spark, sf)
    terms = {field: search.analyze_queries(asked, i) for field, i in indexes.items()}
    return search.multi_field_topk(terms, indexes, 5)


@query
def bm25_stemmed(spark, sf):
    built = inputs.stemmed_corpus_index(spark, sf)
    terms = search.analyze_queries(inputs.questions(spark, sf), built)
    return search.bm25_topk(terms, built, 10)


@query
def ranking_lists(spark, sf):
    hits = search.first_pass(query_terms(spark, sf), inputs.corpus_index(spark, sf), 5)
    return questions.ranking_lists(hits).select("id", joined("type").alias("types"))


# Features


def candidate_pairs(spark, sf):
    """Hits of the items, and their gold documents."""
    items = inputs.labelled_items(spark, sf)
    built = inputs.corpus_index(spark, sf)
    terms = staged(search.analyze_queries(items, built), "query-terms")
    hits = search.first_pass(terms, built, 5)
    gold = ltr.type_rows(questions.blank_literal_types(items))
    return terms, ltr.candidates(hits, gold)


@query
def query_features(spark, sf):
    built = inputs.corpus_index(spark, sf)
    found = features.query_features(query_terms(spark, sf), built)
    return rounded(found, "query_sum_idf", "query_max_idf", "query_avg_idf")


@query
def doc_features(spark, sf):
    return features.doc_features(inputs.corpus(spark, sf), inputs.corpus_index(spark, sf))


@query
def query_doc_features(spark, sf):
    terms, pairs = candidate_pairs(spark, sf)
    found = features.query_doc_features(pairs, terms, inputs.corpus_index(spark, sf))
    return rounded(found, "avg_TF_catch_all")


@query
def ltr_features(spark, sf):
    terms, pairs = candidate_pairs(spark, sf)
    found = features.ltr_features(staged(pairs, "pairs"), terms, inputs.corpus_index(spark, sf))
    return rounded(found, *FEATURES)


@query
def ltr_features_raw(spark, sf):
    """Unstemmed look-ups in the stemmed index."""
    built = inputs.stemmed_corpus_index(spark, sf)
    terms = staged(search.analyze_queries(inputs.questions(spark, sf), built), "query-terms")
    hits = staged(search.first_pass(terms, built, 5), "hits")
    return rounded(features.ltr_features(hits, terms, built, raw_lookup=True), *FEATURES)


# Learning to rank


@query
def ltr_candidates(spark, sf):
    return candidate_pairs(spark, sf)[1]


def _training(spark, sf, label_mode, n=TRAIN_QUESTIONS):
    first, _ = readers.train_split(inputs.labelled_items(spark, sf), n)
    return ltr.training_set(first, inputs.corpus_index(spark, sf), label_mode=label_mode)


@query
def ltr_training_set(spark, sf):
    return rounded(_training(spark, sf, "query"), *FEATURES)


@query
def ltr_training_set_doc(spark, sf):
    return rounded(_training(spark, sf, "document"), *FEATURES)


#: A fixed number of iterations, so that SQL can follow them.
FIXED_STEPS = Huber(steps=30, tol=0.0)


def _fixed_fit(training):
    return ltr.fit_ranker(training, p=FIXED_STEPS)


@query
def ltr_weights(spark, sf):
    """Weights of the ranker on all labelled items."""
    rows = staged(_training(spark, sf, "query", n=None), "training")
    found = huber.fit(rows.withColumn("label", F.col("label").cast("double")), FEATURES, FIXED_STEPS)
    named = [*zip(FEATURES, found.weights), ("intercept", found.intercept)]
    return rounded(spark.createDataFrame(named, "feature string, weight double"), "weight", digits=9)


def _reranked(spark, sf, fit):
    model = fit(staged(_training(spark, sf, "query"), "training"))
    asked, built = inputs.questions(spark, sf), inputs.corpus_index(spark, sf)
    return ltr.rankings(model, asked, built, use_model=True)


@query
def ltr_first_pass_rankings(spark, sf):
    asked, built = inputs.questions(spark, sf), inputs.corpus_index(spark, sf)
    return ltr.rankings(None, asked, built)


@query
def ltr_first_pass_two_fields(spark, sf):
    """The first pass of the ranking run over both fields of the type documents."""
    names = {"type": inputs.type_name_index(spark, sf)}
    return ltr.rankings(None, inputs.questions(spark, sf), inputs.type_index(spark, sf), fields=names)


@query
def ltr_rerank_members(spark, sf):
    """What the re-ranking cannot change: each question's documents, and gapless ranks."""
    ranked = _reranked(spark, sf, _fixed_fit).groupBy("id")
    members = ranked.agg(
        F.array_join(F.sort_array(F.collect_list("doc_id")), " ").alias("docs"),
        F.array_join(F.sort_array(F.collect_list("rank")).cast("array<string>"), " ").alias("ranks"),
    )
    return members


@query
def ltr_rerank(spark, sf):
    return rounded(_reranked(spark, sf, _fixed_fit), "score")


@query
def ltr_rerank_forest(spark, sf):
    return _reranked(spark, sf, ltr.fit_forest_ranker)


# Classification


@query
def term_counts(spark, sf):
    return classify.term_counts(inputs.categorized_documents(spark, sf))


@query
def count_features(spark, sf):
    """Counts of all documents over the vocabulary of the training set."""
    return classify.features_over(inputs.marked_documents(spark, sf), "annotated", tfidf_weights=False)


@query
def tfidf_l2(spark, sf):
    return rounded(classify.features_over(inputs.marked_documents(spark, sf), "annotated"), "weight")


@query
def nb_model(spark, sf):
    model = classify.nb_fit(inputs.train_documents(spark, sf))
    return rounded(classify.nb_log_likelihoods(model), "log_likelihood")


@query
def nb_predict(spark, sf):
    found = classify.nb_predict_together(inputs.marked_documents(spark, sf), "annotated")
    return rounded(found, "score", digits=3)


@query
def nb_accuracy(spark, sf):
    """On the documents that the training set lacks."""
    model = classify.nb_fit(inputs.train_documents(spark, sf))
    gold = inputs.unseen_documents(spark, sf)
    return rounded(classify.accuracy(gold, classify.nb_predict(model, gold)), "accuracy")


@query
def svm_above_majority(spark, sf):
    """Whether the SVM is right more often than the largest category, on unseen rows."""
    test = inputs.unseen_documents(spark, sf)
    predicted = svm.predict_together(inputs.marked_documents(spark, sf), "annotated")
    largest = test.groupBy("category").count().agg(F.max("count")).scalar()
    found = classify.accuracy(test, predicted)
    return found.select("n", (F.col("accuracy") > largest / F.col("n")).alias("above"))


@query
def svm_predict(spark, sf):
    return svm.predict_together(inputs.marked_documents(spark, sf), "annotated")


@query
def svm_weights(spark, sf):
    model = svm.fit(inputs.train_documents(spark, sf))
    return rounded(model.weights, "weight", digits=4)


# Hierarchy


@query
def hierarchy_closure(spark, sf):
    return hierarchy.closure(hierarchy.type_paths(inputs.hierarchy(spark, sf)))


@query
def type_path(spark, sf):
    found = hierarchy.type_paths(inputs.hierarchy(spark, sf))
    return found.select("type", "depth", joined("path").alias("path"))


@query
def max_depth(spark, sf):
    return hierarchy.max_depth(inputs.hierarchy(spark, sf))


@query
def type_distance(spark, sf):
    return hierarchy.distances(inputs.paths(spark, sf))


@query
def most_specific(spark, sf):
    return evaluation.gold_rows(_gold(spark, sf), inputs.paths(spark, sf))


@query
def expanded_types(spark, sf):
    """The gold types below each region and nation of the tree, expanded."""
    types = inputs.hierarchy(spark, sf).select(F.col("parent").alias("id"), "type")
    return hierarchy.expand(types, inputs.paths(spark, sf))


# Evaluation


def _gold(spark, sf):
    return questions.known_gold_types(
        inputs.answers(spark, sf), inputs.hierarchy(spark, sf)
    )


def _depth(spark, sf):
    return hierarchy.max_depth(inputs.hierarchy(spark, sf)).scalar()


def _gains(spark, sf):
    found = inputs.paths(spark, sf)
    gold = evaluation.gold_rows(_gold(spark, sf), found)
    predicted = evaluation.predicted_rows(inputs.predictions(spark, sf))
    return gold, evaluation.type_gains(predicted, gold, found, _depth(spark, sf))


@query
def known_gold_types(spark, sf):
    return _gold(spark, sf).select("id", joined("type").alias("types"))


@query
def type_gains(spark, sf):
    return rounded(_gains(spark, sf)[1], "gain")


@query
def ideal_gains(spark, sf):
    found = inputs.paths(spark, sf)
    gold = evaluation.gold_rows(_gold(spark, sf), found)
    return rounded(evaluation.ideal_gains(gold, found, _depth(spark, sf)), "gain")


@query
def dcg_ndcg(spark, sf):
    gold, gains = _gains(spark, sf)
    depth = max(evaluation.CUTOFFS)
    ideal = evaluation.ideal_gains(gold, inputs.paths(spark, sf), _depth(spark, sf), depth)
    values = evaluation.ndcg(gains, ideal)
    return rounded(values, *[c for c in values.columns if c != "id"])


def _order_evaluation(spark, sf):
    return runs.evaluate(
        inputs.answers(spark, sf),
        inputs.predictions(spark, sf),
        inputs.hierarchy(spark, sf),
    )


@query
def question_scores(spark, sf):
    return rounded(_order_evaluation(spark, sf).scores, "ndcg_5", "ndcg_10")


@query
def evaluation_summary(spark, sf):
    return _order_evaluation(spark, sf).summary


@query
def evaluation_counts(spark, sf):
    """What a run has loaded, observed while it is stored."""
    counts = _order_evaluation(spark, sf).counts
    return spark.createDataFrame([counts], "types long, max_depth long, questions long, predictions long")


@query
def evaluation_diagnostics(spark, sf):
    return _order_evaluation(spark, sf).warnings


# Runs


def _predicted(spark, sf):
    return staged(runs.categories_together(inputs.marked_documents(spark, sf), "annotated", svm=False), "categories")


def _baseline(spark, sf):
    test = inputs.categorized_documents(spark, sf)
    return runs.baseline_output(test, _predicted(spark, sf), inputs.type_index(spark, sf))


def _as_rows(output):
    return output.select("id", "category", joined("type").alias("types"))


@query
def category_gated_output(spark, sf):
    return _as_rows(_baseline(spark, sf))


@query
def end_to_end_index(spark, sf):
    """Triple lines to the postings of the type documents."""
    types = typedocs.parse_types(inputs.document_type_lines(spark, sf))
    abstracts = typedocs.parse_abstracts(inputs.abstract_lines(spark, sf))
    return runs.index_from_triples(types, abstracts, stem=False).postings


@query
def end_to_end_category(spark, sf):
    return _predicted(spark, sf)


@query
def end_to_end_category_svm(spark, sf):
    predicted = staged(runs.categories_together(inputs.marked_documents(spark, sf), "annotated"), "categories")
    test = inputs.categorized_documents(spark, sf)
    return rounded(classify.accuracy(test, predicted), "accuracy", digits=3)


@query
def end_to_end_baseline(spark, sf):
    """Categories, retrieval and scores of the baseline."""
    gold = inputs.categorized_documents(spark, sf)
    output = staged(_baseline(spark, sf), "output")
    scores = runs.evaluate(gold, output, inputs.document_types(spark, sf)).scores
    return rounded(scores, "ndcg_5", "ndcg_10")


@query
def end_to_end_ltr(spark, sf):
    """Categories, re-ranked retrieval and scores of the learning-to-rank method, over the
    texts and the names of the types."""
    train, test = inputs.train_documents(spark, sf), inputs.categorized_documents(spark, sf)
    built, names = inputs.type_index(spark, sf), {"type": inputs.type_name_index(spark, sf)}
    run = runs.ltr_output(train, test, _predicted(spark, sf), built, fields=names, loss=FIXED_STEPS)
    output = staged(run.output, "output")
    scores = runs.evaluate(test, output, inputs.document_types(spark, sf)).scores
    return rounded(scores, "ndcg_5", "ndcg_10")
