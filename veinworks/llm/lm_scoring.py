"""Language-model scores by deleted interpolation of bigrams and unigrams.

Maximum-likelihood bigram estimates are mixed with unigram ones. The weight of
a mixture depends on how often the context occurs: contexts fall into buckets
by powers of two, and expectation-maximisation learns the weight of each bucket
on counts of a part of the training documents that the estimates leave out.

Counting is spread by n-gram. Texts are kept as lots, tables of word numbers
with the hashes of the words. A lot asks each bucket of n-grams for the counts
of its own distinct n-grams, in packed arrays; the bucket adds up what all lots
bring and answers every lot. Common words cost one entry per lot, so no key is
hot, and what is sent is never more than the distinct n-grams of every lot.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from veinworks.llm.base import crc_fold, fresh_folder, map_arrow, query, table, texts, written
from veinworks.llm.files import filesystem

LOT_CHARS = 8 << 20
GROUP_TOKENS = 2 << 20  # tokens of the corpus per bucket of n-grams
END, START = 0, -1  # the end token's number; the context of the first token
END_HASH, START_HASH = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC3A5C85C97CB3127)
CONTEXTS = 48  # buckets of context frequency, by powers of two
RATIOS, RATIO_LOW, RATIO_STEP = 480, -12.0, 8  # bins of log2(bigram / unigram estimate), RATIO_STEP to an octave
EM_ROUNDS = 200


def pack(values: np.ndarray) -> bytes:
    """Integers below 2**32 as compressed planes of bytes."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def rows_of(batch: pa.RecordBatch):
    """Rows of a batch as tuples, one in memory at a time."""
    for k in range(batch.num_rows):
        yield tuple(c[k].as_py() for c in batch.columns)


def make_lots(docs: DataFrame, fold: Column, id_col: str = "doc_id", text_col: str = "text", lot_chars: int = LOT_CHARS) -> DataFrame:
    """(lot, doc_ids, folds, lengths, hashes, words): texts as word numbers, in lots of bounded size.

    Words are lower-cased in A-Z and split at ASCII white space; number 0 is the
    end token, which is not stored. A null text has no words.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("doc_id"), fold.cast("int").alias("fold"), F.col(text_col).alias("text"))
    schema = f"lot long, doc_ids array<{kind}>, folds array<int>, lengths array<long>, hashes binary, words binary"

    def close(number: int, ids: list, folds: list, lengths: list, seqs: list, known: dict, ids_type, folds_type) -> pa.RecordBatch:
        hashed = xxhash.xxh64_intdigest
        hashes = np.array([int(END_HASH), *(hashed(w, 42) for w in known)], "<u8")
        words = np.concatenate(seqs) if seqs else np.zeros(0, np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([ids], pa.list_(ids_type)), pa.array([folds], pa.list_(folds_type)),
             pa.array([lengths], pa.list_(pa.int64())), pa.array([hashes.tobytes()], pa.binary()), pa.array([pack(words)], pa.binary())],
            ["lot", "doc_ids", "folds", "lengths", "hashes", "words"],
        )

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids: list = []
        folds, lengths, seqs, chars, types = [], [], [], 0, None
        known: dict = defaultdict()
        known.default_factory = lambda: len(known) + 1
        for batch in batches:
            types = batch.column(0).type, batch.column(1).type
            for doc_id, fold_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2)), strict=True):
                seq = [known[w] for w in text.encode("utf-8", "surrogatepass").lower().split()]
                ids.append(doc_id)
                folds.append(fold_)
                lengths.append(len(seq))
                seqs.append(np.array(seq, np.int32))
                chars += len(text)
                if chars >= lot_chars:
                    yield close(number, ids, folds, lengths, seqs, known, *types)
                    ids, folds, lengths, seqs, chars, number = [], [], [], [], 0, number + 1
                    known.clear()
        if ids:
            yield close(number, ids, folds, lengths, seqs, known, *types)

    return map_arrow(chosen, run, schema)


@dataclass
class Lot:
    """Tokens of a lot in order: word, context, fold and n-grams by number."""

    token: np.ndarray
    context: np.ndarray
    doc: np.ndarray
    fold: np.ndarray  # of each document, -1 without one
    word_hash: np.ndarray
    pair: np.ndarray  # of each token, its pair's number
    pair_hash: np.ndarray

    @classmethod
    def read(cls, folds: list, lengths: list, hashes: bytes, words: bytes) -> "Lot":
        length = np.array(lengths, np.int64) + 1
        ends = np.cumsum(length)
        token = np.insert(unpack(words), ends - np.arange(1, len(ends) + 1), END)
        context = np.concatenate([[START], token[:-1]])
        context[ends - length] = START
        word_hash = np.frombuffer(hashes, "<u8")
        key = (context + 1) * len(word_hash) + token
        order = np.argsort(key)
        new = np.concatenate([[True], np.diff(key[order]) != 0])
        pair = np.empty(len(key), np.int64)
        pair[order] = np.cumsum(new) - 1
        first = order[new]
        before = np.where(context[first] == START, START_HASH, word_hash[np.maximum(context[first], 0)])
        mixed = before * np.uint64(0x9FB21C651E98DF25) ^ (word_hash[token[first]] + np.uint64(0x165667B19E3779F9))
        mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xBF58476D1CE4E5B9)
        fold = np.array([-1 if f is None else f for f in folds], np.int64)
        return cls(token, context, np.repeat(np.arange(len(length)), length), fold, word_hash, pair, mixed ^ mixed >> np.uint64(29))

    def tallies(self, held_out: int, left_out: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Counts of words and of pairs: (kept for the estimates, left out for the weights)."""
        fold = self.fold[self.doc]
        kept, left = (fold != held_out) & (fold != left_out), fold == left_out
        return [
            (np.bincount(x[kept], minlength=n), np.bincount(x[left], minlength=n))
            for x, n in ((self.token, len(self.word_hash)), (self.pair, len(self.pair_hash)))
        ]

    def orders(self, groups: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For words and pairs: their numbers in order of bucket, and where each bucket starts."""
        out = []
        for hashes in (self.word_hash, self.pair_hash):
            bucket = ((hashes >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            out.append((order, np.searchsorted(bucket[order], np.arange(groups + 1))))
        return out


def requests(lots: DataFrame, groups: int, held_out: int, left_out: int) -> DataFrame:
    """(bucket, lot, words, pairs, kept, left): hashes of a lot's n-grams in a bucket, with the lot's counts.

    Words have whole hashes, pairs the low 48 bits: with the bucket, the chance
    that a pair meets another's count is below one in a hundred million.
    """

    def run(batches):
        for batch in batches:
            for lot, _, folds, lengths, hashes, words in rows_of(batch):
                own = Lot.read(folds, lengths, hashes, words)
                counts = own.tallies(held_out, left_out)
                (word, word_at), (pair, pair_at) = own.orders(groups)
                low = own.pair_hash.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                rows = []
                for g in range(groups):
                    w, p = word[word_at[g] : word_at[g + 1]], pair[pair_at[g] : pair_at[g + 1]]
                    if len(w) or len(p):
                        kept, left = (pack(np.concatenate([counts[0][k][w], counts[1][k][p]])) for k in (0, 1))
                        rows.append((g, lot, own.word_hash[w].tobytes(), low[p].tobytes(), kept, left))
                types = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    ["bucket", "lot", "words", "pairs", "kept", "left"],
                )

    chosen = lots.select("lot", "doc_ids", "folds", "lengths", "hashes", "words")
    return map_arrow(chosen, run, "bucket int, lot long, words binary, pairs binary, kept binary, left binary")


def replies(asked: DataFrame) -> DataFrame:
    """(lot, bucket, kept, left, tokens, types, kept_tokens, kept_types): a lot's n-grams with the counts of all lots.

    The last four are sums over the words of a bucket and stand in its first row.
    """

    def total(keys: np.ndarray, counts: list[np.ndarray]) -> list[np.ndarray]:
        order = np.argsort(keys)
        new = np.concatenate([[True], np.diff(keys[order]) != 0]) if len(keys) else np.zeros(0, bool)
        which = np.empty(len(keys), np.int64)
        which[order] = np.cumsum(new) - 1
        n = int(new.sum())
        return [which, *(np.bincount(which, c, minlength=n).astype(np.int64) for c in counts)]

    def add(part: pa.Table) -> pa.Table:
        rows = sorted(zip(*(part[c].to_pylist() for c in ("lot", "words", "pairs", "kept", "left")), strict=True))
        n_words = [len(r[1]) // 8 for r in rows]
        n_pairs = [len(r[2]) // 6 for r in rows]
        words = np.frombuffer(b"".join(r[1] for r in rows), "<u8")
        wide = np.zeros((sum(n_pairs), 8), np.uint8)
        wide[:, :6] = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, 6)
        counts = [[unpack(r[k]) for r in rows] for k in (3, 4)]
        of_words = total(words, [np.concatenate([c[:n] for c, n in zip(cs, n_words, strict=True)]) for cs in counts])
        of_pairs = total(wide.view("<u8").ravel(), [np.concatenate([c[n:] for c, n in zip(cs, n_words, strict=True)]) for cs in counts])
        out, w, p = [], 0, 0
        kept, left = of_words[1], of_words[2]
        sums = [int((kept + left).sum()), int((kept + left > 0).sum()), int(kept.sum()), int((kept > 0).sum())]
        for (lot, *_), n, m in zip(rows, n_words, n_pairs, strict=True):
            own_w, own_p = of_words[0][w : w + n], of_pairs[0][p : p + m]
            found = [pack(np.concatenate([of_words[k][own_w], of_pairs[k][own_p]])) for k in (1, 2)]
            out.append((lot, part["bucket"][0].as_py(), *found, *(sums if not out else [0] * 4)))
            w, p = w + n, p + m
        types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    names = ["lot", "bucket", "kept", "left", "tokens", "types", "kept_tokens", "kept_types"]
    return asked.groupBy("bucket").applyInArrow(
        add, "lot long, bucket int, kept binary, left binary, tokens long, types long, kept_tokens long, kept_types long"
    )


@dataclass
class Totals:
    """Sizes of the training corpus: tokens, distinct tokens, documents; the same without the part left out."""

    tokens: int
    types: int
    docs: int
    kept_tokens: int
    kept_types: int
    kept_docs: int


def lot_counts(lot: int, own: Lot, groups: int, fs, path: str) -> list[np.ndarray]:
    """Counts for every word and every pair of a lot, from its answers: kept, left out."""
    import pyarrow.parquet as pq

    answers = pq.read_table(f"{path}/lot={lot}", filesystem=fs, columns=["bucket", "kept", "left"], partitioning=None)
    by_bucket = dict(zip(answers["bucket"].to_pylist(), zip(answers["kept"].to_pylist(), answers["left"].to_pylist(), strict=True), strict=True))
    (word, word_at), (pair, pair_at) = own.orders(groups)
    out = []
    for k in (0, 1):
        words, pairs = np.zeros(len(word), np.int64), np.zeros(len(pair), np.int64)
        for g in range(groups):
            n = word_at[g + 1] - word_at[g]
            if n or pair_at[g + 1] > pair_at[g]:
                found = unpack(by_bucket[g][k])
                words[word[word_at[g] : word_at[g + 1]]] = found[:n]
                pairs[pair[pair_at[g] : pair_at[g + 1]]] = found[n:]
        out += [words, pairs]
    return out


def context_bucket(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(count + 1.0).astype(np.int64), CONTEXTS - 1)


def estimates(own: Lot, words: np.ndarray, pairs: np.ndarray, tokens: int, types: int, docs: int):
    """Per token: unigram estimate, bigram estimate, count of the context."""
    unigram = (words[own.token] + 0.5) / (tokens + 0.5 * (types + 1))
    context = np.where(own.context == START, docs, words[np.maximum(own.context, 0)])
    return unigram, pairs[own.pair] / np.maximum(1, context), context


def learn_weights(lots: DataFrame, groups: int, folder: str, totals: Totals, left_out: int) -> np.ndarray:
    """Weight of the bigram estimate for each bucket of context frequency.

    The left-out tokens are summed up by context bucket and ratio of the two
    estimates, all that the likelihood of a mixture depends on: a table of
    bounded size, over which expectation-maximisation runs.
    """

    def run(batches):
        fs, path = filesystem(folder)
        sums = np.zeros((CONTEXTS, RATIOS + 1), np.int64)
        for batch in batches:
            for lot, _, folds, lengths, hashes, words in rows_of(batch):
                own = Lot.read(folds, lengths, hashes, words)
                if not (own.fold == left_out).any():
                    continue
                kept, pairs, *_ = lot_counts(lot, own, groups, fs, path)
                unigram, bigram, context = estimates(own, kept, pairs, totals.kept_tokens, totals.kept_types, totals.kept_docs)
                of = (own.fold[own.doc] == left_out) & (context > 0)
                ratio = bigram[of] / unigram[of]
                bins = np.clip((np.log2(np.maximum(ratio, 2.0**-60)) - RATIO_LOW) * RATIO_STEP, 0, RATIOS - 1).astype(np.int64)
                np.add.at(sums, (context_bucket(context[of]), np.where(ratio > 0, bins + 1, 0)), 1)
        c, r = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32()), pa.array(r, pa.int32()), pa.array(sums[c, r], pa.int64())], ["context", "ratio", "n"]
        )

    chosen = lots.select("lot", "doc_ids", "folds", "lengths", "hashes", "words")
    found = map_arrow(chosen, run, "context int, ratio int, n long").groupBy("context", "ratio").agg(F.sum("n").alias("n"))
    table = np.zeros((CONTEXTS, RATIOS + 1))
    for c, r, n in found.collect():  # at most CONTEXTS x RATIOS rows
        table[c, r] = n
    return mixture_weights(table)


def mixture_weights(table: np.ndarray) -> np.ndarray:
    """Expectation-maximisation of a two-part mixture per row of counts by ratio bin (bin 0: ratio zero)."""
    ratio = np.concatenate([[0.0], 2.0 ** (RATIO_LOW + (np.arange(RATIOS) + 0.5) / RATIO_STEP)])
    weight = np.full(len(table), 0.5)
    n = table.sum(1)
    for _ in range(EM_ROUNDS):
        mixed = weight[:, None] * ratio
        share = mixed / (mixed + 1 - weight[:, None])
        weight = np.where(n > 0, (table * share).sum(1) / np.maximum(n, 1), weight)
        weight = np.clip(weight, 1e-6, 1 - 1e-6)
    # A bucket without left-out tokens takes the weight of the nearest one below it that has some.
    for k in range(1, len(weight)):
        if not n[k] and n[:k].any():
            weight[k] = weight[k - 1]
    return weight


def score_texts(
    docs: DataFrame, folds: int = 5, held_out: int = 1, left_out: int = 0, id_col: str = "doc_id", text_col: str = "text",
    lot_chars: int = LOT_CHARS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    Documents whose crc32 of the id modulo ``folds`` is ``held_out`` are scored
    and not learned from; those at ``left_out`` teach the mixture weights and
    are counted in the final estimates. A null id has no fold: it is learned
    from and not held out. Without training documents all scores are 0. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    lots = written(make_lots(docs, crc_fold(F.col(id_col), folds), id_col, text_col, lot_chars), "lm-lots")
    sizes = lots.select(
        F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n + 1).alias("n"),
        F.size(F.filter("folds", lambda f: ~f.eqNullSafe(F.lit(held_out)))).alias("docs"),
        F.size(F.filter("folds", lambda f: ~f.eqNullSafe(F.lit(held_out)) & ~f.eqNullSafe(F.lit(left_out)))).alias("kept"),
    ).agg(F.sum("n"), F.sum("docs"), F.sum("kept")).first()
    groups = max(1, -(-(sizes[0] or 0) // GROUP_TOKENS))
    folder = fresh_folder(spark, "lm-answers")
    answers = replies(requests(lots, groups, held_out, left_out))
    # One file per lot, which the later passes over the lots open directly: the lots themselves never move.
    answers.repartition("lot").write.partitionBy("lot").parquet(folder)
    if sizes[0]:
        known = spark.read.parquet(folder)
        sums = known.agg(*(F.sum(c) for c in ("tokens", "types", "kept_tokens", "kept_types"))).first()
        totals = Totals(sums[0], sums[1], sizes[1], sums[2], sums[3], sizes[2])
        weights = learn_weights(lots, groups, folder, totals, left_out)
    else:
        totals, weights = Totals(0, 0, 0, 0, 0, 0), np.full(CONTEXTS, 0.5)

    def run(batches):
        fs, path = filesystem(folder)
        for batch in batches:
            ids_type = batch.schema.field("doc_ids").type.value_type
            for lot, ids, folds_, lengths, hashes, words in rows_of(batch):
                own = Lot.read(folds_, lengths, hashes, words)
                kept, kept_pairs, left, left_pairs = lot_counts(lot, own, groups, fs, path)
                count = kept + left
                unigram, bigram, context = estimates(own, count, kept_pairs + left_pairs, totals.tokens, totals.types, totals.docs)
                weight = np.where(context > 0, weights[context_bucket(context)], 0.0)
                mixed = np.log10(weight * bigram + (1 - weight) * unigram)
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, ids_type), pa.array(own.fold == held_out), pa.array(np.bincount(own.doc, minlength=n)),
                        pa.array(np.bincount(own.doc, count[own.token] > 0, minlength=n).astype(np.int64)),
                        pa.array(np.full(n, totals.tokens, np.int64)),
                        pa.array(np.bincount(own.doc, np.log10(unigram), minlength=n)), pa.array(np.bincount(own.doc, mixed, minlength=n)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    chosen = lots.select("lot", "doc_ids", "folds", "lengths", "hashes", "words")
    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(
        chosen, run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


@query("op7_lm_scoring")
def op7(spark, sf_dir):
    """Language-model scores of all documents, beside those of the base unigram model."""
    return score_texts(table(spark, sf_dir, "documents"))
