"""Quality rules: divergence of a document from what its corpus writes.

References are learned from the corpus: per language, a histogram of character
classes and one of common words, over documents that pass the base rules. Every
distinct text counts, however often it occurs, so a crowd of exact copies does
not become the language. A document fails when its histograms lie too far, by
Jensen-Shannon distance, from the reference of its language. Short documents are
left to the base rules, because their histograms say little, and so are
documents of a language with too few words for a reference.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from veinworks.llm.base import map_arrow, query, table, texts, written
from veinworks.llm.charclass import CLASSES, class_counts, class_table

WINDOW = 5
KEPT_REFERENCES = 256  # parsed references that a task holds at once
BASE_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
SYMBOL = re.compile(r"[#*$%&|<>]")


def base_rules(text: str, words: list[bytes]) -> tuple[int, int, int, int, int, bool]:
    """The columns of ``BASE_SCHEMA``; ``words`` are the words of the text as UTF-8."""
    n = len(words)
    spaces = sum(map(text.count, " \t\n\x0b\x0c\r"))
    seen, dup_lines = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\x0b\x0c\r"):
            dup_lines += line in seen
            seen.add(line)
    repeats = 0
    if n > WINDOW:
        # Every window as a tuple; equal neighbours are told apart by how often each occurs.
        windows = list(zip(*(words[k:] for k in range(WINDOW)), strict=False))
        often = Counter(windows)
        if len(often) < len(windows):
            end = 0
            for i, w in enumerate(windows):
                if often[w] > 1:
                    repeats += i + WINDOW - max(i, end)
                    end = i + WINDOW
    failed = n < 10 or 100 * repeats > 20 * n
    return n, len(text) - spaces, len(SYMBOL.findall(text)), dup_lines, repeats, failed


@dataclass
class Rules:
    """Thresholds and guards of the divergence rules.

    A limit on a distance is a base plus ``slack`` over the square root of the
    number of words, because histograms of short documents scatter.
    """

    char_distance: float = 0.15
    word_distance: float = 0.31
    slack: float = 0.8
    char_words: int = 50  # fewest words for the test of character classes
    word_words: int = 100  # fewest words for the test of common words
    common_share: float = 0.002  # of the words of a language, to be common in it
    language_words: int = 5_000  # fewest words of a language for a reference: a common one occurs ten times
    symbol_share: float = 0.1  # symbols per word above which a document teaches nothing


@dataclass
class Reference:
    """Histograms of a language; words that are not common in it are one rest, the last share."""

    chars: np.ndarray
    words: list[bytes]
    common: np.ndarray

    @classmethod
    def parse(cls, text: str) -> Reference:
        """From the JSON of ``references``."""
        row = json.loads(text)
        chars = np.zeros(len(CLASSES))
        for item, n in zip(row["classes"], row["class_counts"], strict=True):
            chars[int(item)] = n
        common = np.array([*row["word_counts"], 0], float) / row["total"]
        common[-1] = 1 - common.sum()
        return cls(chars / max(1, chars.sum()), [w.encode() for w in row["words"]], common)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (square root, base 2) of ``p`` to each row of ``q``."""
    middle = (p + q) / 2

    def part(x):
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(middle > 0, middle, 1)), 0).sum(-1)

    return np.sqrt(np.maximum(0, (part(np.broadcast_to(p, q.shape)) + part(q)) / 2))


def references(docs: DataFrame, rules: Rules, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, reference): of each language with enough words, learned from all documents
    that pass the base rules and hold few symbols; of equal texts one counts.

    A null language is a language of its own, named "". ``reference`` is JSON of at
    most 1 / ``common_share`` words; the table stays with Spark.
    """

    def summaries(batches):
        classes = class_table()
        for batch in batches:
            out = []
            for lang, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                whole = text.encode("utf-8", "surrogatepass")
                words = whole.split()
                n, _, symbols, _, _, failed = base_rules(text, words)
                if failed or symbols > rules.symbol_share * n:
                    continue
                tally = {w.decode("utf-8", "replace"): c for w, c in Counter(words).items()}
                tally = json.dumps([class_counts(text, classes).tolist(), tally], ensure_ascii=False, separators=(",", ":"))
                out.append((lang or "", xxhash.xxh3_128_digest(whole), zlib.compress(tally.encode("utf-8", "replace"), 1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else ([], [], []), (pa.string(), pa.binary(), pa.binary()), strict=True)],
                ["lang", "digest", "summary"],
            )

    def tallies(batches):
        for batch in batches:
            chars, counts = {}, {}
            for lang, summary in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                classes, words = json.loads(zlib.decompress(summary.as_py()))
                chars[lang] = chars.get(lang, 0) + np.array(classes)
                counts.setdefault(lang, Counter()).update(words)
            rows = [(lang, str(k), True, int(n)) for lang, c in chars.items() for k, n in enumerate(c)]
            rows += [(lang, w, False, n) for lang, c in counts.items() for w, n in c.items()]
            columns = zip(*rows, strict=True) if rows else ([], [], [], [])
            types = (pa.string(), pa.string(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["lang", "item", "is_class", "n"]
            )

    chosen = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    summed = map_arrow(chosen, summaries, "lang string, digest binary, summary binary")
    one = summed.groupBy("lang", "digest").agg(F.min("summary").alias("summary")).select("lang", "summary")
    counted = map_arrow(one, tallies, "lang string, item string, is_class boolean, n long")
    counted = written(counted.groupBy("lang", "item", "is_class").agg(F.sum("n").alias("n")), "rule-counts")
    totals = counted.where("not is_class").groupBy("lang").agg(F.sum("n").alias("total")).where(F.col("total") >= rules.language_words)
    # One row a language goes to all tasks, so words are not gathered by language before they are few.
    frequent = counted.join(F.broadcast(totals), "lang").where(F.col("is_class") | (F.col("n") >= rules.common_share * F.col("total")))
    # Two sorted lists: words and their counts stay in step.
    pair = F.struct("item", "n")
    lists = frequent.groupBy("lang").agg(
        F.first("total").alias("total"), F.array_sort(F.collect_list(F.when(~F.col("is_class"), pair))).alias("w"),
        F.array_sort(F.collect_list(F.when(F.col("is_class"), pair))).alias("c"),
    )
    made = F.struct(
        "total", F.col("w.item").alias("words"), F.col("w.n").alias("word_counts"), F.col("c.item").alias("classes"),
        F.col("c.n").alias("class_counts"),
    )
    return written(lists.select("lang", F.to_json(made).alias("reference")), "rule-references")


def divergences(text: str, words: list[bytes], classes: np.ndarray, known: Reference | None) -> tuple[float, float]:
    """Distances of a text to the reference of its language: character classes, common words."""
    if known is None:
        return 0.0, 0.0
    chars = class_counts(text, classes)
    tally = Counter(words)
    common = np.array([*(tally.get(w, 0) for w in known.words), 0], float)
    common[-1] = len(words) - common.sum()
    return (
        float(distance(chars / max(1, chars.sum()), known.chars[None])[0]),
        float(distance(common / max(1, len(words)), known.common[None])[0]),
    )


def apply_rules(docs: DataFrame, known: DataFrame, rules: Rules, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """All columns of ``docs`` but the text, with base columns, both distances and ``kept``.

    ``known`` is the table of ``references``. A null text counts as empty: no
    words, base rules failed. Columns of the names made here are replaced. Without
    a reference of the language both distances are 0 and only the base rules decide.
    """
    made = StructType.fromDDL(f"{BASE_SCHEMA}, char_distance double, word_distance double, kept boolean")
    kept = [c for c in docs.columns if c not in made.fieldNames() and c != text_col]
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("_lang")
    rows = docs.select(*kept, F.col(text_col).alias("_whole_text"), lang)
    schema = StructType([*rows.schema.fields[:-2], *made.fields])
    known = known.select(F.col("lang").alias("_lang"), F.col("reference").alias("_reference"))
    rows = rows.join(known, "_lang", "left").select(*kept, "_whole_text", "_lang", "_reference")

    def run(batches):
        classes, parsed = class_table(), {}
        for batch in batches:
            out = []
            whole, langs, found = batch.columns[len(kept) :]
            for text, lang, reference in zip(texts(whole), langs.to_pylist(), found, strict=True):
                if lang not in parsed:
                    if len(parsed) >= KEPT_REFERENCES:
                        parsed.clear()
                    parsed[lang] = Reference.parse(reference.as_py()) if reference.is_valid else None
                words = text.encode("utf-8", "surrogatepass").split()
                base = base_rules(text, words)
                chars, common = divergences(text, words, classes, parsed[lang])
                slack = rules.slack / max(1, len(words)) ** 0.5
                far = len(words) >= rules.char_words and chars > rules.char_distance + slack
                far = far or len(words) >= rules.word_words and common > rules.word_distance + slack
                out.append((*base, chars, common, not (base[-1] or far)))
            types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)] if out else []
            if out:
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *columns], schema.fieldNames())

    return map_arrow(rows, run, schema)


def judge(docs: DataFrame, rules: Rules | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``apply_rules`` with references learned from ``docs`` itself."""
    rules = rules or Rules()
    return apply_rules(docs, references(docs, rules, text_col, lang_col), rules, text_col, lang_col)


@query("op4_quality_rules")
def op4(spark, sf_dir):
    """Base rules and divergence verdict of every document."""
    return judge(table(spark, sf_dir, "documents").select("doc_id", "lang", "text")).drop("lang")
