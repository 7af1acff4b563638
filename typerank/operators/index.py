"""Postings and statistics tables of a document collection."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from typerank.functions.text import counted, index_tokens
from typerank.operators.questions import last_per_key
from typerank.operators.stems import stem_table
from typerank.sources.stage import drop, new_folder, staged, stored as _store


#: The postings of a document of more tokens than these may lie in several tasks.
TOGETHER = 1_000_000


@dataclass(frozen=True)
class Index:
    """Tables of one indexed text field.

    postings(doc_id, term, tf, dl), term_stats(term, df), doc_stats(doc_id, dl),
    field_stats(doc_count, avgdl); stems(term, stem) where the index is stemmed.
    """

    postings: DataFrame
    term_stats: DataFrame
    doc_stats: DataFrame
    field_stats: DataFrame
    stems: DataFrame | None = None

    def save(self, path: str) -> None:
        """Write the tables, replacing those of an earlier index."""
        for name, table in self.tables().items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")

    def tables(self) -> dict[str, DataFrame]:
        names = ["postings", "term_stats", "doc_stats", "field_stats", "stems"]
        return {n: getattr(self, n) for n in names if getattr(self, n) is not None}


def all_tokens(documents: DataFrame, text: str = "catch_all") -> DataFrame:
    """(doc_id, tokens, dl) of all documents."""
    tokens = documents.select("doc_id", index_tokens(F.col(text)).alias("tokens"))
    return tokens.withColumn("dl", F.size("tokens").cast("bigint"))


def document_tokens(documents: DataFrame, text: str = "catch_all") -> DataFrame:
    """(doc_id, tokens, dl); documents without any token are not counted."""
    return all_tokens(documents, text).where("dl > 0")


def document_stats(documents: DataFrame, text: str = "catch_all") -> DataFrame:
    """(doc_id, dl): the length is counted inside the row, without a shuffle."""
    return document_tokens(documents, text).select("doc_id", "dl")


def document_postings(documents: DataFrame, text: str = "catch_all") -> DataFrame:
    """(doc_id, term, tf, dl). The tokens of a document are counted inside its row, so no
    posting is shuffled, and the postings of a document stay together in the stored table.
    Rows of one id and length are put together first, which is an exchange of their tokens
    unless they come ``by_document``. The length rides along, which spares the scoring a
    join with the document table. A document without any token gives no row; a filter on
    the tokens would take them once more, before the exchange."""
    tokens = F.flatten(F.collect_list("tokens"))
    return (
        all_tokens(documents, text)
        .groupBy("doc_id", "dl")
        .agg(tokens.alias("tokens"))
        .select("doc_id", "dl", F.inline(counted(F.col("tokens"))))
        .select("doc_id", "term", F.col("n").alias("tf"), "dl")
    )


def by_document(documents: DataFrame) -> DataFrame:
    """``documents`` with all rows of an id in one task. Their texts are smaller than
    their tokens, so this exchange comes before the tokens are taken."""
    return documents.repartition("doc_id")


def stemmed_postings(postings: DataFrame, stems: DataFrame) -> DataFrame:
    """Postings with every term replaced by its stem. Pass both as stored tables, so
    that a frequent term is split by the adaptive planner. The postings of a document stay
    together, those of a very long one in several tasks."""
    piece = F.pmod(F.xxhash64("term"), F.greatest(F.ceil(F.col("dl") / TOGETHER), F.lit(1)))
    return (
        postings.join(stems, "term")
        .select("doc_id", F.col("stem").alias("term"), "dl", "tf")
        .withColumn("piece", piece)
        .repartition("doc_id", "piece")
        .groupBy("doc_id", "piece", "term", "dl")
        .agg(F.sum("tf").alias("tf"))
        .select("doc_id", "term", "tf", "dl")
        .sortWithinPartitions("doc_id")
    )


def term_statistics(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def field_statistics(doc_stats: DataFrame) -> DataFrame:
    """One row (doc_count, avgdl)."""
    return doc_stats.agg(F.count(F.lit(1)).alias("doc_count"), F.avg("dl").alias("avgdl"))


def piece_postings(pieces: DataFrame) -> DataFrame:
    """(type, piece) -> (doc_id, term, tf) of the type documents.

    Words never cross pieces, so the postings of a document are the sums over its
    pieces, and no document text is built, however many entities a type has.
    """
    return (
        pieces.select(F.col("type").alias("doc_id"), F.explode(index_tokens(F.col("piece"))).alias("term"))
        .groupBy("doc_id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def build_index(
    documents: DataFrame,
    path: str | None = None,
    text: str = "catch_all",
    stem: bool = False,
    unique: bool = False,
    order: str | None = None,
) -> Index:
    """Index ``documents`` (doc_id, text) and write its tables to ``path``.

    A later load of an id replaces the earlier one: the row that is last by the column
    ``order``, else in reading order, is indexed. ``unique`` says that no id repeats,
    so all rows stay.
    """
    documents = _last_loads(documents, text, unique, order)
    return _stored_index(document_postings(documents, text), path, stem)


def _last_loads(documents: DataFrame, text: str, unique: bool, order: str | None) -> DataFrame:
    if unique:
        return by_document(documents.select("doc_id", text))
    at = F.col(order) if order else F.monotonically_increasing_id()
    return last_per_key(documents.select("doc_id", text, at.alias("load")), "doc_id", "load")


def upsert(
    index: Index,
    documents: DataFrame,
    path: str | None = None,
    text: str = "catch_all",
    unique: bool = False,
    order: str | None = None,
) -> Index:
    """``index`` after a further load of ``documents`` (doc_id, text), in the folder
    ``path``; the tables of ``index`` stay as they are until the caller deletes them.

    A document replaces the stored one of its id; one without any token removes it. Only
    the loaded texts are tokenized, and in a stemmed index only new terms are stemmed. The
    postings of other documents are copied; document frequencies and the statistics of the
    field are corrected by what comes and goes. The ids of a load are stored, so few of
    them are sent to the postings and many are shuffled.
    """
    spark = documents.sparkSession
    path = path or new_folder(spark, "index")
    documents = _last_loads(documents, text, unique, order)
    ids = staged(documents.select("doc_id").distinct(), "loaded-ids")
    coming = staged(document_postings(documents, text), "coming")
    stems = index.stems
    if stems is not None:
        new = stem_table(coming.join(stems, "term", "left_anti"))
        stems = _store(stems.unionByName(new), f"{path}/stems")
        coming = staged(stemmed_postings(coming, stems), "coming")
    going = staged(index.postings.join(ids, "doc_id", "left_semi"), "going")
    kept = index.postings.join(ids, "doc_id", "left_anti")
    postings = _store(kept.unionByName(coming), f"{path}/postings")
    changed = [
        index.term_stats,
        coming.select("term", F.lit(1).cast("bigint").alias("df")),
        going.select("term", F.lit(-1).cast("bigint").alias("df")),
    ]
    counts = changed[0].unionByName(changed[1]).unionByName(changed[2])
    counts = counts.groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")
    term_stats = _store(counts, f"{path}/term_stats")
    lengths = index.doc_stats.join(ids, "doc_id", "left_anti")
    new_lengths = coming.select("doc_id", "dl").distinct()
    doc_stats = _store(lengths.unionByName(new_lengths), f"{path}/doc_stats")
    field_stats = _store(_corrected(index.field_stats, new_lengths, going), f"{path}/field_stats")
    return Index(postings, term_stats, doc_stats, field_stats, stems)


def _corrected(field_stats: DataFrame, coming: DataFrame, going: DataFrame) -> DataFrame:
    """Field statistics after documents (doc_id, dl) came and others went."""
    total = F.round(F.col("doc_count") * F.col("avgdl"))
    parts = field_stats.select("doc_count", total.alias("total"))
    parts = parts.unionByName(coming.select(F.lit(1).alias("doc_count"), F.col("dl").alias("total")))
    gone = going.select("doc_id", "dl").distinct()
    parts = parts.unionByName(gone.select(F.lit(-1).alias("doc_count"), (-F.col("dl")).alias("total")))
    n = F.sum("doc_count")
    average = F.when(n > 0, F.sum("total") / n)
    return parts.agg(n.alias("doc_count"), average.alias("avgdl"))


def build_index_from_pieces(pieces: DataFrame, path: str | None = None, stem: bool = False) -> Index:
    """Index of the type documents that ``pieces`` (type, piece) make up."""
    return _index_of_counts(piece_postings(pieces.where("type <> ''")), path, stem)


def build_index_from_entities(
    type_entity: DataFrame, abstracts: DataFrame, path: str | None = None, stem: bool = False
) -> Index:
    """Index of the type documents that the abstracts (entity, abstract) of the listed
    entities (entity, type) make up.

    Each abstract is tokenized once, however many types list its entity, and stored, so
    that an entity in a third of all rows is split by the adaptive planner.
    """
    words = abstracts.select("entity", index_tokens(F.col("abstract")).alias("tokens"))
    words = staged(words.where(F.size("tokens") > 0), "words")
    counts = (
        type_entity.where("type <> ''")
        .join(words, "entity")
        .select(F.col("type").alias("doc_id"), F.explode("tokens").alias("term"))
        .groupBy("doc_id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    return _index_of_counts(counts, path, stem)


def _index_of_counts(counts: DataFrame, path: str | None, stem: bool) -> Index:
    """Index from (doc_id, term, tf); the few lengths are stored and joined by size."""
    counts = staged(counts, "piece-postings")
    lengths = staged(counts.groupBy("doc_id").agg(F.sum("tf").alias("dl")), "lengths")
    postings = counts.join(lengths, "doc_id").select("doc_id", "term", "tf", "dl")
    return _stored_index(postings, path, stem)


def _stored_index(surface: DataFrame, path: str | None, stem: bool) -> Index:
    """Tables of an index from its unstemmed postings.

    Each table is written once and the next is derived from the stored one, so the
    texts are tokenized only once and every later join sees the true sizes.
    """
    spark = surface.sparkSession
    path = path or new_folder(spark, "index")

    def stored(table: DataFrame, name: str) -> DataFrame:
        return _store(table, f"{path}/{name}")

    stems = None
    if stem:
        surface = staged(surface, "surface")
        stems = stored(stem_table(surface), "stems")
        postings = stored(stemmed_postings(surface, stems), "postings")
        drop(surface)
    else:
        postings = stored(surface, "postings")
    term_stats = stored(term_statistics(postings), "term_stats")
    doc_stats = stored(postings.select("doc_id", "dl").distinct(), "doc_stats")
    field_stats = stored(field_statistics(doc_stats), "field_stats")
    return Index(postings, term_stats, doc_stats, field_stats, stems)


def load_index(spark: SparkSession, path: str, doc_id: str = "string", stem: bool = False) -> Index:
    schemas = {
        "postings": f"doc_id {doc_id}, term string, tf bigint, dl bigint",
        "term_stats": "term string, df bigint",
        "doc_stats": f"doc_id {doc_id}, dl bigint",
        "field_stats": "doc_count bigint, avgdl double",
    }
    if stem:
        schemas["stems"] = "term string, stem string"
    tables = {n: spark.read.schema(s).parquet(f"{path}/{n}") for n, s in schemas.items()}
    return Index(**tables)


def doc_term_freqs(index: Index, doc_ids: DataFrame) -> DataFrame:
    """(doc_id, freqs): the terms of the given documents with their frequencies."""
    wanted = index.postings.join(doc_ids.select("doc_id"), "doc_id", "left_semi")
    return wanted.groupBy("doc_id").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "tf"))).alias("freqs")
    )
