"""Fingerprints by one-permutation MinHash, in DataFrame functions only.

Every shingle is hashed once. The high bits of the hash name one of ``BINS`` bins, the
rest is the value; a bin keeps its smallest value. An empty bin borrows the value of a
filled one: it probes bins in a pseudo-random sequence of its own until it meets a filled
one (optimal densification), so that equal borrowers agree with the right probability. Of
each bin the four low-order bits are stored, as one hex digit; two unequal values agree in
them by chance once in 16, and the likeness corrects that bias.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from typerank.llm.common import staged

WIDTH = 5
BIN_BITS, LOW_BITS = 8, 4
BINS = 1 << BIN_BITS
_VALUE = (1 << (64 - BIN_BITS)) - 1
#: Probes before an empty bin looks at all filled ones in its random order.
PROBES = 12
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _once(value: Column, body) -> Column:
    """body(value) with ``value`` computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Hashes of the runs of ``width`` words; of the whole sequence if it is shorter."""
    words = F.split(F.translate(text, UPPER, LOWER), r"[\x20\x09-\x0D]+")
    # A separator at either end leaves an empty string there.
    hashes = F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        full = F.transform(
            F.slice(h, 1, F.greatest(F.size(h) - (width - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, width))),
        )
        short = F.array(F.xxhash64(F.array_join(F.transform(h, lambda x: x.cast("string")), " ")))
        none = F.array().cast("array<bigint>")
        return F.when(F.size(h) >= width, full).when(F.size(h) > 0, short).otherwise(none)

    return _once(hashes, runs)


def fingerprint(text: Column, width: int = WIDTH) -> Column:
    """One hex digit a bin; empty for a text without words. Null is an empty text."""
    shift = 64 - BIN_BITS
    first, last = -(BINS // 2), BINS // 2 - 1
    # The largest value of each bin: it is left at the front only where nothing else is.
    ends = F.array(*(F.lit((b << shift) + _VALUE) for b in range(first, last + 1)))
    bin_of = lambda x: F.shiftright(x, shift)
    empty = lambda x: x.bitwiseAND(F.lit(_VALUE)) == F.lit(_VALUE)

    def minima(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(s, i - 1))))

    def filled(a: Column) -> Column:
        def probe(b: Column) -> Column:
            def step(found: Column, t: Column) -> Column:
                x = F.get(a, F.pmod(F.xxhash64(b, t), F.lit(BINS)).cast("int"))
                return F.when(found.isNotNull(), found).when(~empty(x), x)

            few = F.reduce(F.sequence(F.lit(1), F.lit(PROBES)), F.lit(None).cast("bigint"), step)
            order = lambda x: F.struct(F.xxhash64(b, bin_of(x), F.lit("order")).alias("o"), x.alias("v"))
            every = F.array_min(F.transform(F.filter(a, lambda x: ~empty(x)), order))["v"]
            return F.coalesce(few, every)

        return F.transform(a, lambda x: F.when(empty(x), probe(bin_of(x))).otherwise(x))

    def digits(h: Column) -> Column:
        bins = _once(F.sort_array(F.concat(h, ends)), minima)
        low = F.transform(_once(bins, filled), lambda x: F.lower(F.hex(x.bitwiseAND(F.lit(15)))))
        return F.when(F.size(h) == 0, "").otherwise(F.array_join(low, ""))

    return _once(shingle_hashes(F.coalesce(text, F.lit("")), width), digits)


def likeness(one: Column, two: Column) -> Column:
    """Estimated Jaccard similarity, 0 to 1, of the shingle sets of two fingerprints.

    Two texts without words are alike (1), one of them is like no other text (0).
    """
    same = F.zip_with(F.split(one, ""), F.split(two, ""), lambda x, y: (x == y).cast("int"))
    share = F.reduce(same, F.lit(0), lambda n, x: n + F.coalesce(x, F.lit(0))) / BINS
    chance = 1.0 / (1 << LOW_BITS)
    corrected = (share - chance) / (1 - chance)
    estimate = F.least(F.lit(1.0), F.greatest(F.lit(0.0), corrected))
    return F.when(one == two, 1.0).when((one == "") | (two == ""), 0.0).otherwise(estimate)


def followers(ids: DataFrame) -> DataFrame:
    """(id, next_id): the next smaller id; the largest after the smallest.

    Ranges of ids are written once; inside each a window finds the next one, and between
    ranges only the two ends of each are compared.
    """
    blocks = staged(
        ids.select("id").distinct().repartitionByRange("id").withColumn("block", F.spark_partition_id()),
        "ids",
    )
    ends = blocks.groupBy("block").agg(F.max("id").alias("high"), F.min("id").alias("low"))
    # One row a range: their number is that of the partitions.
    in_turn = W.orderBy(F.col("high").desc())
    ends = ends.select(
        F.col("low").alias("id"),
        F.coalesce(F.lead("high").over(in_turn), F.max("high").over(W.partitionBy())).alias("after"),
    )
    inside = W.partitionBy("block").orderBy(F.col("id").desc())
    return (
        blocks.withColumn("next_id", F.lead("id").over(inside))
        .join(ends, "id", "left")
        .select("id", F.coalesce("next_id", "after").alias("next_id"))
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    Edited: the last half of the code points (rounded down) is replaced by as many from the
    start of the next document, in descending order of ids, the first following the last.
    Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. Null texts are empty. Rows without an id have no place in the order and are
    left out; of texts that share an id the smallest stands for the id as the next
    document, and each keeps its own row. A single document follows itself. Other columns
    are not read.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).where("id IS NOT NULL")
    half = F.floor(F.length("text") / 2).cast("int")
    # One exchange of the texts by id serves both sides; of the next text only the part
    # that is put in travels to the edited one.
    by_id = texts.repartition("id")
    after = by_id.groupBy("id").agg(F.min("text").alias("next_text")).select(
        F.col("id").alias("next_id"), "next_text", fingerprint(F.col("next_text"), width).alias("next_fingerprint")
    )
    asked = texts.groupBy("id").agg(F.max(half).alias("most")).join(followers(texts), "id")
    given = asked.join(after, "next_id").select(
        "id", F.substring("next_text", F.lit(1), F.col("most")).alias("given"), "next_fingerprint"
    )
    out = by_id.join(given, "id").select(
        "id",
        F.length("text").cast("long").alias("n_chars"),
        F.concat(
            F.substring("text", F.lit(1), F.length("text") - half), F.substring("given", F.lit(1), half)
        ).alias("edited"),
        "next_fingerprint",
        fingerprint(F.col("text"), width).alias("fingerprint"),
    ).withColumn("edited_fingerprint", fingerprint(F.col("edited"), width))
    return out.select(
        "id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
