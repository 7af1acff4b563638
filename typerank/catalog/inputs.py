"""The given tables in the shape of the domain: triples, documents, questions,
categories, hierarchy, gold and predicted answers. Every table is read whole."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from typerank.operators import typedocs
from typerank.operators.hierarchy import type_paths
from typerank.operators.index import Index, build_index, build_index_from_pieces
from typerank.operators.questions import ordered_list
from typerank.sources.stage import staged

BLOCK_BITS = 16


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str, key: str) -> DataFrame:
    """A table of long texts, spread over all cores.

    A small table is a single row group, so one task would do all the cleaning. Only
    a scan with fewer splits than cores is exchanged; a large one is left as it is.
    """
    rows = table(spark, sf, name)
    cores = spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:
        rows = rows.repartition(4 * cores, key)
    return rows


def key_block(key: str) -> Column:
    """Key ranges of a fixed width, as the blocks of an ordered table."""
    return F.shiftright(key, BLOCK_BITS)


# Triples


def part_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Four lines per part: its brand, its kind, the root type, and a comment."""
    subject = F.format_string(
        "<http://ex.org/resource/%s_%s>", F.replace("p_name", F.lit(" "), F.lit("_")), "p_partkey"
    )
    line = "%s <http://ex.org/type> <http://ex.org/%s> ."
    lines = F.array(
        F.format_string(line, subject, F.concat(F.lit("ontology/"), "p_brand")),
        F.format_string(line, subject, F.concat(F.lit("ontology/"), "p_type")),
        F.format_string(line, subject, F.lit("owl#Thing")),
        F.concat(F.lit("# "), "p_name"),
    )
    return table(spark, sf, "part").select(
        key_block("p_partkey").alias("block"), "p_partkey", F.posexplode(lines).alias("pos", "line")
    ).select("block", (F.col("p_partkey") * 4 + F.col("pos")).alias("ord"), "line")


def abstract_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One abstract line per document; copies of a text share their entity, so the
    last document of a source and language wins some of them."""
    text = F.regexp_replace("text", r"[\r\n]+", " ")
    line = F.concat(
        F.format_string("<http://ex.org/resource/%s/%s> <http://ex.org/abstract> ", "source", "doc_id"),
        F.lit('"'),
        text,
        F.lit('"@en .'),
    )
    return texts(spark, sf, "documents", "doc_id").select(
        key_block("doc_id").alias("block"), F.col("doc_id").alias("ord"), line.alias("line")
    )


def page_abstract_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Abstract lines whose entity is the last segment of a page address."""
    line = F.concat(
        F.lit("<"), "url", F.lit('> <http://ex.org/abstract> "'),
        F.regexp_replace("html", r"[\r\n]+", " "), F.lit('"@en .')
    )
    return texts(spark, sf, "pages", "page_id").select(
        key_block("page_id").alias("block"), F.col("page_id").alias("ord"), line.alias("line")
    )


def document_type_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Two type lines per document: its language, and its language and source."""
    subject = F.format_string("<http://ex.org/resource/%s/%s>", "source", "doc_id")
    line = "%s <http://ex.org/type> <http://ex.org/ontology/%s> ."
    lines = F.array(
        F.format_string(line, subject, "lang"),
        F.format_string(line, subject, F.concat("lang", F.lit("_"), "source")),
    )
    return texts(spark, sf, "documents", "doc_id").select(
        key_block("doc_id").alias("block"), "doc_id", F.posexplode(lines).alias("pos", "line")
    ).select("block", (F.col("doc_id") * 2 + F.col("pos")).alias("ord"), "line")


# Documents


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, catch_all): every document with its whole text."""
    return texts(spark, sf, "documents", "doc_id").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("catch_all")
    )


def type_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Whole document texts as pieces of two types each: language, and language and
    source. More than half of all texts belong to one type."""
    types = F.array("lang", F.concat_ws("/", "lang", "source"))
    return texts(spark, sf, "documents", "doc_id").select(
        F.explode(types).alias("type"),
        key_block("doc_id").alias("block"),
        F.col("doc_id").alias("ord"),
        F.col("text").alias("piece"),
    )


_stored: dict[tuple, object] = {}


def stored(spark: SparkSession, sf: str, name: str, build):
    """What ``build`` writes, once per application and folder: indexes and tables that
    a user of the operators has on disk."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _stored:
        _stored[key] = build()
    return _stored[key]


def corpus_index(spark: SparkSession, sf: str) -> Index:
    """Index of the documents."""
    return stored(spark, sf, "corpus", lambda: build_index(corpus(spark, sf), unique=True))


def stemmed_corpus_index(spark: SparkSession, sf: str) -> Index:
    return stored(spark, sf, "stemmed", lambda: build_index(corpus(spark, sf), stem=True, unique=True))


def type_index(spark: SparkSession, sf: str) -> Index:
    """Index of the whole type documents."""
    return stored(spark, sf, "types", lambda: build_index_from_pieces(type_pieces(spark, sf)))


def type_name_index(spark: SparkSession, sf: str) -> Index:
    """Index of the names of the types that have a text."""

    def build():
        names = typedocs.named_types(type_pieces(spark, sf))
        return build_index(names, text="type", unique=True)

    return stored(spark, sf, "type-names", build)


# Questions


def questions(spark: SparkSession, sf: str) -> DataFrame:
    """(id, question): benchmark items and what was said in conversations."""
    items = table(spark, sf, "benchmark").select(
        F.concat(F.lit("b"), "item_id").alias("id"), F.col("text").alias("question")
    )
    said = texts(spark, sf, "conversations", "conv_id").select(
        F.concat_ws("-", F.concat(F.lit("c"), "conv_id"), "turn").alias("id"),
        F.col("text").alias("question"),
    )
    return items.unionByName(said)


def labelled_items(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark items as labelled questions (id, question, category, type, ord).

    The documents of ``labels`` are dealt out to the items in turn as gold
    types; items with more than one toxic one count as literal questions.
    """
    items = table(spark, sf, "benchmark")
    n_items = items.agg(F.count(F.lit(1))).scalar()
    dealt = (
        table(spark, sf, "labels")
        .groupBy((F.col("doc_id") % n_items).alias("item_id"))
        .agg(ordered_list("doc_id", "doc_id").alias("docs"), F.sum("toxic").alias("toxic"))
    )
    category = (
        F.when(F.col("docs").isNull(), "boolean")
        .when(F.col("toxic") > 1, "literal")
        .otherwise("resource")
    )
    types = (
        F.when(category == "boolean", F.array(F.lit("boolean")))
        .when(category == "literal", F.array(F.lit("date")))
        .otherwise(F.col("docs").cast("array<string>"))
    )
    return items.join(dealt, "item_id", "left").select(
        F.concat(F.lit("b"), "item_id").alias("id"),
        F.col("text").alias("question"),
        category.alias("category"),
        types.alias("type"),
        F.col("item_id").alias("ord"),
    )


def category_of(lang: str) -> Column:
    return F.when(F.col(lang) == "en", "resource").when(F.col(lang) == "de", "boolean").otherwise("literal")


def categorized_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a labelled question (id, question, category, type, ord). Its
    type is its language and source."""
    return as_questions(texts(spark, sf, "documents", "doc_id"))


def as_questions(documents: DataFrame, *keep: str) -> DataFrame:
    category = category_of("lang")
    types = (
        F.when(category == "boolean", F.array(F.lit("boolean")))
        .when(category == "literal", F.array(F.lit("string")))
        .otherwise(F.array(F.concat_ws("/", "lang", "source")))
    )
    return documents.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("question"),
        category.alias("category"),
        types.alias("type"),
        F.col("doc_id").alias("ord"),
        *keep,
    )


def train_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The training set: the documents that ``labels`` covers."""
    labels = table(spark, sf, "labels").select("doc_id")
    return as_questions(texts(spark, sf, "documents", "doc_id").join(labels, "doc_id", "left_semi"))


def marked_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a labelled question, with ``annotated``: in the training set."""
    labels = table(spark, sf, "labels").select("doc_id").distinct().withColumn("annotated", F.lit(True))
    documents = texts(spark, sf, "documents", "doc_id").join(labels, "doc_id", "left")
    return as_questions(documents.withColumn("annotated", F.coalesce("annotated", F.lit(False))), "annotated")


def unseen_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that the training set lacks."""
    labels = table(spark, sf, "labels").select("doc_id")
    return as_questions(texts(spark, sf, "documents", "doc_id").join(labels, "doc_id", "left_anti"))


def document_types(spark: SparkSession, sf: str) -> DataFrame:
    """Hierarchy of the document types: languages, and their sources below them."""
    documents = table(spark, sf, "documents")
    root = documents.select(
        F.col("lang").alias("type"), F.lit(1).alias("depth"), F.lit("owl:Thing").alias("parent")
    )
    leaf = documents.select(
        F.concat_ws("/", "lang", "source").alias("type"), F.lit(2).alias("depth"), F.col("lang").alias("parent")
    )
    return root.unionByName(leaf).distinct()


# Hierarchy, gold and predicted answers


def hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """Regions, nations and suppliers as a tree of types (type, depth, parent)."""
    region = table(spark, sf, "region").select(
        F.concat(F.lit("R"), "r_regionkey").alias("type"),
        F.lit(1).alias("depth"),
        F.lit("owl:Thing").alias("parent"),
    )
    nation = table(spark, sf, "nation").select(
        F.concat(F.lit("N"), "n_nationkey").alias("type"),
        F.lit(2).alias("depth"),
        F.concat(F.lit("R"), "n_regionkey").alias("parent"),
    )
    supplier = table(spark, sf, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("type"),
        F.lit(3).alias("depth"),
        F.concat(F.lit("N"), "s_nationkey").alias("parent"),
    )
    return region.unionByName(nation).unionByName(supplier)


def paths(spark: SparkSession, sf: str) -> DataFrame:
    """Paths of the hierarchy."""
    return stored(spark, sf, "paths", lambda: staged(type_paths(hierarchy(spark, sf)), "paths"))


def answers(spark: SparkSession, sf: str) -> DataFrame:
    """The gold answers of the orders as a table."""
    return stored(spark, sf, "answers", lambda: staged(order_answers(spark, sf), "answers"))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """The predicted answers of the orders as a table."""
    return stored(
        spark, sf, "predictions", lambda: staged(order_predictions(spark, sf), "predictions")
    )


def supplied_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with supplier, nation and region types. They are shuffled here, by
    order, and as numbers, so what is counted by order needs no other exchange."""
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    line = ["l_orderkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus"]
    return (
        table(spark, sf, "lineitem")
        .select(*line, "l_suppkey")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(*line, "l_suppkey", "s_nationkey", "n_regionkey")
        .repartition("l_orderkey")
        .select(
            *line,
            F.concat(F.lit("X"), "l_suppkey").alias("x"),
            F.concat(F.lit("S"), "l_suppkey").alias("s"),
            F.concat(F.lit("N"), "s_nationkey").alias("n"),
            F.concat(F.lit("R"), "n_regionkey").alias("r"),
        )
    )


def order_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as questions (id, question, category, type) with gold types: a label
    for boolean and literal ones; for others the supplier of each line, its nation
    if the line was returned, both if it was accepted, and a type that the
    hierarchy does not have if the line has no discount."""
    types = (
        F.when(F.col("l_discount") == 0, F.array("x"))
        .when(F.col("l_returnflag") == "R", F.array("n"))
        .when(F.col("l_returnflag") == "A", F.array("s", "n"))
        .otherwise(F.array("s"))
    )
    listed = (
        supplied_lines(spark, sf)
        .select("l_orderkey", F.explode(types).alias("type"))
        .distinct()
        .groupBy("l_orderkey")
        .agg(ordered_list("type", "type").alias("types"))
    )
    category = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "boolean")
        .when(F.col("o_orderpriority") == "2-HIGH", "literal")
        .otherwise("resource")
    )
    label = (
        F.when(F.col("o_orderstatus") == "F", "date")
        .when(F.col("o_orderstatus") == "O", "number")
        .otherwise("string")
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return orders.join(listed, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("question"),
        category.alias("category"),
        F.when(category == "boolean", F.array(F.lit("boolean")))
        .when(category == "literal", F.array(label))
        .otherwise(F.coalesce("types", F.array().cast("array<string>")))
        .alias("type"),
    )


def order_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """System output for the orders: their types by quantity; a wrong category where a
    medium order is partly open, no category where one without a priority is, and no types
    where an order has no lines."""
    quantity = (
        supplied_lines(spark, sf)
        .select("l_orderkey", "l_quantity", F.explode(F.array("s", "n", "r")).alias("type"))
        .groupBy("l_orderkey", "type")
        .agg(F.sum("l_quantity").alias("quantity"))
    )
    pairs = F.sort_array(F.collect_list(F.struct((-F.col("quantity")).alias("cost"), "type")))
    listed = quantity.groupBy("l_orderkey").agg(
        F.transform(pairs, lambda p: p["type"]).alias("types")
    )
    category = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "boolean")
        .when(F.col("o_orderpriority") == "2-HIGH", "literal")
        .when((F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_orderstatus") == "P"), "literal")
        .when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "P"), None)
        .otherwise("resource")
    )
    label = F.when(F.col("o_orderstatus") == "O", "number").otherwise("date")
    orders = table(spark, sf, "orders")
    return orders.join(listed, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").cast("string").alias("id"),
        category.alias("category"),
        F.when(category == "boolean", F.array().cast("array<string>"))
        .when(category == "literal", F.array(label))
        .otherwise(F.coalesce("types", F.array().cast("array<string>")))
        .alias("type"),
    )
