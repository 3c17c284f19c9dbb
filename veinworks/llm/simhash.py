"""SimHash near-duplicates, found through one-wildcard segment variants.

A fingerprint of 64 bits is cut into so few segments that, of two fingerprints
at most ``max_bits`` apart, one segment differs by at most one bit. Every
distinct fingerprint is indexed under each segment as it is, and under each
segment with one bit left open. Fingerprints that share an index entry are
joined on equality and verified by counting the bits that differ.

An entry with more than ``bucket`` fingerprints (a large group of near copies)
is not expanded into pairs. Its fingerprints are indexed under every value at
most one bit away. All that share such a value are at most two bits apart, and
any two that are at most two bits apart share one, so linking each to the
smallest is exact and its cost grows with their number, not with its square.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from veinworks.llm.base import map_arrow, query, table, texts, written
from veinworks.operators.graph import connected_components

BITS = 64
SEED = 42
ROWS_PER_FILE = 1_000_000  # of the narrow table of fingerprints
CHUNK = 1 << 16  # hashes whose bits are unpacked at once: bounds memory on long texts


def fingerprint(text: str, words: int = 3) -> int:
    """SimHash of the word shingles of a text, repeats included, as a signed long."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    hashed = xxhash.xxh64_intdigest
    ones, n = np.zeros(BITS, np.int64), max(1, len(w) - words + 1)
    for start in range(0, n, CHUNK):
        hashes = [hashed(b" ".join(w[i : i + words]), SEED) for i in range(start, min(n, start + CHUNK))]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``, the fingerprint as a long.

    A null text counts as empty; texts without a word get fingerprint zero. A
    text with fewer words than a shingle is one shingle. Other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            prints = pa.array([fingerprint(t, words) for t in texts(batch.column(1))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], ["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(chosen, run, f"doc_id {kind}, fp long")


def index(prints: DataFrame, max_bits: int) -> DataFrame:
    """(entry, value, open, fp): every index entry of every fingerprint.

    ``entry`` numbers segment and open bit together, ``value`` is the segment
    with that bit cleared and ``open`` the bit; it is null where no bit is open.
    """
    segments = max_bits // 2 + 1
    width = -(-BITS // segments)
    entry = F.col("entry")
    segment, bit = (entry / (width + 1)).cast("int"), entry % (width + 1) - 1
    part = F.call_function("shiftrightunsigned", F.col("fp"), segment * width)
    if width < BITS:
        part = part.bitwiseAND(F.lit((1 << width) - 1))
    hole = F.when(bit >= 0, F.call_function("shiftleft", F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long"))
    rows = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(segments * (width + 1) - 1))).alias("entry"))
    return rows.select(
        "entry", part.bitwiseAND(F.bitwise_not(hole)).alias("value"),
        F.when(bit >= 0, F.call_function("shiftrightunsigned", part, bit).bitwiseAND(F.lit(1)).cast("int")).alias("open"),
        "fp",
    )


def sorted_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """An equality join that is never a broadcast.

    Spark's estimates leave out how many rows an ``explode`` makes, so index
    entries many times the size of any broadcast would pass for small tables.
    """
    return left.join(right.hint("merge"), on)


def links(prints: DataFrame, max_bits: int = 2, bucket: int = 16) -> DataFrame:
    """(a, b): pairs of distinct fingerprints that connect all those at most ``max_bits`` apart.

    Pairs from entries of up to ``bucket`` fingerprints are all pairs at most
    ``max_bits`` apart; fuller entries give a star per shared value.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits is 0, 1 or 2")
    if max_bits == 0:  # distinct fingerprints are never equal
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("a <> b")
    # Few bytes, but dozens of entries a fingerprint: spread before they are made.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = index(prints.repartition(parts, "fp"), max_bits)
    sizes = entries.groupBy("entry", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(sorted_join(entries, sizes, ["entry", "value"]), "simhash-shared")
    few = shared.where(F.col("n") <= bucket).drop("n")
    left, right = few.withColumnRenamed("fp", "a").alias("l"), few.withColumnRenamed("fp", "b").alias("r")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    # Equal segments meet in the entry without an open bit, others where that bit differs.
    ordered = F.coalesce(F.col("l.open") < F.col("r.open"), F.col("a") < F.col("b"))
    same = (F.col("l.entry") == F.col("r.entry")) & (F.col("l.value") == F.col("r.value"))
    pairs = sorted_join(left, right, same & ordered & (apart <= max_bits)).select("a", "b")
    return pairs.unionByName(stars(shared.where(F.col("n") > bucket).select("fp").distinct(), max_bits))


def stars(prints: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): each fingerprint with the smallest that shares a value one bit away."""
    if max_bits == 1:  # neighbours are themselves values one bit away
        near = prints.select(F.col("fp").alias("b"), F.explode(_flips(F.col("fp"))).alias("a"))
        return sorted_join(near, prints.select(F.col("fp").alias("a")), "a").select("a", "b")
    around = prints.select("fp", F.explode(F.array_append(_flips(F.col("fp")), F.col("fp"))).alias("value"))
    least = around.groupBy("value").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b < top")
    return sorted_join(around, least, "value").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def _flips(fp: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        lambda i: fp.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)),
    )


def near_duplicates(
    docs: DataFrame, words: int = 3, max_bits: int = 2, bucket: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fp, component_id): the smallest id reachable over near-duplicate links.

    One row per row of ``docs``, repeated rows included. Rows with a null id get
    the component of their fingerprint, and never name one: a component of null
    ids only has a null name. Empty tables give empty results.
    """
    prints = written(fingerprints(docs, words, id_col, text_col), "simhash-prints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    nodes = written(classes.coalesce(max(1, prints.count() // ROWS_PER_FILE)), "simhash-classes")
    found = connected_components(nodes.select(F.col("fp").alias("node")), links(nodes.select("fp"), max_bits, bucket))
    joined = sorted_join(nodes, found.withColumnRenamed("node", "fp"), "fp")
    names = joined.groupBy("component").agg(F.min("low").alias("component_id"))
    named = sorted_join(joined, names, "component").select("fp", "component_id")
    return sorted_join(prints, named, "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id names their component: one document of each group.

    Rows with a null id are kept; of rows that repeat an id, all stay or none does.
    """
    found = near_duplicates(docs, id_col=id_col, **options)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)


@query("op6_simhash_near_dedup")
def op6(spark, sf_dir):
    """Near-duplicate components of all documents: 3-word shingles, at most 2 bits."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
