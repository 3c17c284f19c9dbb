"""Spelling variants: words one edit apart, found through Bloom filters.

The filters hold the vocabulary, cut by word length and within a length by
hash, so that each shard has a bounded size. They are sent to the tasks in
rounds of bounded size. A task generates the edits of its words, as hashes
only: deletions, and replacements by a larger character, which find every pair
once. An edit that its shard's filter knows becomes a string and is shuffled to
an exact join with the vocabulary, which removes false positives.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from veinworks.llm.base import map_arrow, query, table, texts, written

SHARD_WORDS = 1 << 16
ROUND_BYTES = 32 << 20
BITS_PER_WORD, LANES, LEAST_BLOCKS = 16, 8, 64
LONG = 64  # words of this length and beyond share the shards of one length
PART_BITS = 32
TABLE_WORDS = 300_000
WORDS_PER_TASK = 20_000
CELLS = 1 << 18  # edits generated at once

P = 0x9E3779B97F4A7C15
P_INVERSE = pow(P, -1, 1 << 64)
U64 = np.uint64


def letters() -> bytes:
    """For every Latin-1 byte the lower-case letter (only A-Z change), or a blank."""
    kept = {b: b for b in (*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100))}
    kept |= {b: b + 32 for b in range(ord("A"), ord("Z") + 1)}
    return bytes(kept.get(b, 32) for b in range(256))


def vocabulary(
    docs: DataFrame, least_length: int = 5, least_count: int = 3, typo_every: int | None = None, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, n): the words of all whole texts and how often they occur.

    A word is a maximal run of Latin-1 letters, A-Z lower-cased. With
    ``typo_every`` a run loses one character in the documents where that number
    divides the crc32 of ``id:run``; a null id has no crc32, its runs stay.
    Null texts have no words; repeated documents count each.
    """

    def run(batches):
        keep, counts = letters(), Counter()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                start = zlib.crc32(f"{key}:".encode()) if typo_every and key is not None else None
                for word, n in Counter(text.encode("latin-1", "replace").translate(keep).split()).items():
                    if len(word) < least_length:
                        continue
                    if start is not None:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % typo_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_length:
                                continue
                    counts[word] += n
                if len(counts) > TABLE_WORDS:
                    yield _counts(counts)
                    counts.clear()
        yield _counts(counts)

    chosen = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    found = map_arrow(chosen, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= least_count)


def _counts(counts: Counter) -> pa.RecordBatch:
    words = pa.array([w.decode("latin-1") for w in counts], pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes whose bits all depend on all bits of ``h``."""
    h = (h ^ (h >> U64(31))) * U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U64(29))) * U64(0xA0761D6478BD642F)
    return h ^ (h >> U64(32))


def powers(length: int) -> np.ndarray:
    steps = np.full(length, P, U64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=U64)


def by_length(words: list[str]):
    """(rows of ``words``, their code points as a matrix) for every length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        codes = np.frombuffer("".join(words[r] for r in rows).encode("utf-32-le"), "<u4")
        yield rows, codes.reshape(len(rows), length)


def word_hashes(codes: np.ndarray) -> np.ndarray:
    return (codes.astype(U64) * powers(codes.shape[1])).sum(1, dtype=U64)


def shard_of(h: np.ndarray, length: int, parts: dict[int, int]) -> np.ndarray:
    """Shard numbers of mixed hashes of words of one length, -1 where no word has it."""
    length = min(length, LONG)
    if length not in parts:
        return np.full(len(h), -1, np.int64)
    return (length << PART_BITS) + ((h * U64(P)) >> U64(40)).astype(np.int64) % parts[length]


def _cells(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of a mixed hash, and a hash whose 5-bit groups choose a bit in each lane."""
    return ((h >> U64(32)) * U64(blocks) >> U64(32)).astype(np.int64), (h * U64(P_INVERSE)) >> U64(20)


def _bit(chosen: np.ndarray, lane: int) -> np.ndarray:
    return np.uint32(1) << ((chosen >> U64(5 * lane)) & U64(31)).astype(np.uint32)


def bloom(h: np.ndarray) -> np.ndarray:
    """Blocked Bloom filter of mixed hashes: one bit in each of eight lanes of one block."""
    blocks = max(LEAST_BLOCKS, -(-len(h) * BITS_PER_WORD // (32 * LANES)))
    found = np.zeros((blocks, LANES), np.uint32)
    block, chosen = _cells(h, blocks)
    for lane in range(LANES):
        np.bitwise_or.at(found[:, lane], block, _bit(chosen, lane))
    return found


def known(found: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Rows of ``h`` that the filter knows; most leave after a lane or two."""
    rows = np.arange(len(h))
    block, chosen = _cells(h, len(found))
    for lane in range(LANES):
        hit = (found[block, lane] & _bit(chosen, lane)) != 0
        rows, block, chosen = rows[hit], block[hit], chosen[hit]
    return rows


def edits(codes: np.ndarray, alphabet: np.ndarray):
    """(target length, rows, position, new character or -1, hash) of the edits of words of one length.

    Deletions take the first of equal neighbours, replacements a larger
    character, so every pair of near words comes up exactly once.
    """
    n, length = codes.shape
    power, wide = powers(length), codes.astype(U64)
    terms = wide * power
    whole, before = terms.sum(1, dtype=U64), np.zeros(n, U64)
    for at in range(length):
        column = codes[:, at]
        first = np.flatnonzero(column != codes[:, at - 1]) if at else np.arange(n)
        rest = (whole - before - terms[:, at]) * U64(P_INVERSE)
        yield length - 1, first, at, np.full(len(first), -1, np.int64), (before + rest)[first]
        rows, new = np.nonzero(alphabet[None, :] > column[:, None])
        change = (alphabet[new].astype(U64) - wide[rows, at]) * power[at]
        yield length, rows, at, alphabet[new].astype(np.int64), whole[rows] + change
        before = before + terms[:, at]


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): every unordered pair of words exactly one edit apart, once.

    ``words`` holds (word, n), each word once, as a written table.
    """
    spark = words.sparkSession
    length = F.least(F.length("word"), F.lit(LONG))
    found = words.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most LONG rows
    parts = {r["length"]: -(-r["n"] // SHARD_WORDS) for r in found}
    empty = "edit string, word string, n long"
    total = sum(r["n"] for r in found)
    if not total:
        return spark.createDataFrame([], "a string, n_a long, b string, n_b long")
    spread = words.repartition(max(1, -(-total // WORDS_PER_TASK)), "word")
    shards = written(_filters(spread, parts), "spelling-filters")
    characters = spread.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().collect()
    alphabet = np.array(sorted(ord(r["c"]) for r in characters if r["c"]), np.uint32)  # at most 90 letters
    rounds, room = [[]], 0
    for shard, size in sorted((r["shard"], r["size"]) for r in shards.select("shard", F.length("bits").alias("size")).collect()):
        if rounds[-1] and room + size > ROUND_BYTES:
            rounds.append([])
            room = 0
        rounds[-1].append(shard)
        room += size
    hits = []
    for own in rounds:
        low, high = own[0] >> PART_BITS, own[-1] >> PART_BITS
        chosen = shards.where(F.col("shard").between(own[0], own[-1])).collect()  # at most ROUND_BYTES
        filters = spark.sparkContext.broadcast({r["shard"]: bytes(r["bits"]) for r in chosen})
        part = spread if len(rounds) == 1 else spread.where(length.between(low, min(high + 1, LONG)))
        hits.append(written(map_arrow(part, _probe(filters, parts, alphabet), empty), "spelling-hits"))
        filters.unpersist()
    hit = reduce(DataFrame.unionAll, hits).select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("edit").alias("b"))
    return hit.join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b").select("a", "n_a", "b", "n_b")


def _filters(words: DataFrame, parts: dict[int, int]) -> DataFrame:
    """(shard, bits): a filter for each shard, whose words are hashed before they are shuffled."""

    def hashed(batches):
        for batch in batches:
            for _, codes in by_length(batch.column(0).to_pylist()):
                h = mixed(word_hashes(codes))
                shard = shard_of(h, codes.shape[1], parts)
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(h.astype(np.int64))], ["shard", "h"])

    def build(part: pa.Table) -> pa.Table:
        bits = bloom(part["h"].to_numpy().astype(U64)).tobytes()
        return pa.Table.from_arrays([part["shard"][:1], pa.array([bits], pa.binary())], ["shard", "bits"])

    rows = map_arrow(words.select("word"), hashed, "shard long, h long")
    return rows.groupBy("shard").applyInArrow(build, "shard long, bits binary")


def _probe(filters, parts: dict[int, int], alphabet: np.ndarray):
    """Task that turns (word, n) into (edit, word, n) for the edits that the filters know."""

    def run(batches):
        shards = {k: np.frombuffer(v, np.uint32).reshape(-1, LANES) for k, v in filters.value.items()}
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for rows, codes in by_length(words):
                step = max(1, CELLS // max(1, len(alphabet)))
                for start in range(0, len(rows), step):
                    yield from found(shards, words, counts, rows[start : start + step], codes[start : start + step])

    def found(shards, words, counts, rows, codes):
        for length, at_rows, at, new, h in edits(codes, alphabet):
            h = mixed(h)
            shard = shard_of(h, length, parts)
            hits = []
            for own in np.unique(shard):
                if int(own) in shards:
                    mine = np.flatnonzero(shard == own)
                    hits.append(mine[known(shards[int(own)], h[mine])])
            hit = np.concatenate(hits) if hits else np.zeros(0, np.int64)
            if len(hit):
                source = rows[at_rows[hit]]
                made = [words[w][:at] + (chr(c) if c >= 0 else "") + words[w][at + 1 :] for w, c in zip(source, new[hit], strict=True)]
                arrays = [pa.array(made, pa.string()), pa.array([words[w] for w in source], pa.string()), pa.array(counts[source])]
                yield pa.RecordBatch.from_arrays(arrays, ["edit", "word", "n"])

    return run


def variants(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of (word, n), each word once.

    ``form`` is the near word of largest n, the smallest of equals, where that n
    is at least twice the word's; ``root`` ends the chain of forms. Chains end,
    as n doubles with each step.
    """
    words = written(words.select("word", "n"), "spelling-words")
    pairs = written(near_pairs(words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near", "near_n")).alias("best")
    )
    has_form = F.col("best.near_n") >= 2 * F.col("n")
    forms = written(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(has_form, F.col("best.near")).alias("form"), F.when(has_form, F.col("best.near_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    return forms.join(_roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root), from the roots down: a word is the form of no more words than it has edits."""
    layer = forms.where("form is null").select("word", F.col("word").alias("root"))
    edges, layers = forms.where("form is not null").select(F.col("word").alias("child"), "form"), [layer]
    while True:
        below = edges.join(layer, F.col("form") == F.col("word")).select(F.col("child").alias("word"), "root")
        layer = written(below, "spelling-layer")
        if layer.isEmpty():
            return reduce(DataFrame.unionAll, layers)
        layers.append(layer)


@query("op11_spelling_variants")
def op11(spark, sf_dir):
    """Words of all documents, with the planted typos, and the forms they vary from."""
    return variants(vocabulary(table(spark, sf_dir, "documents"), typo_every=97))
