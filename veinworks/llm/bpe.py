"""BPE encoding and decoding of whole texts with the vocabulary of a tokenizer file.

Texts are taken in lots. The distinct words of a lot are laid out in one row of
symbols; an index maps each pair of neighbouring symbols to all its positions.
Ranks present in the index are applied in ascending order, each at all its
positions, and the lists of the pairs that a merge makes are extended. Every
text is then put together from the ids of its words.

White space separates words for the tokenizers read here, so a run without
ASCII white space is encoded the same way wherever it stands.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from veinworks.llm.base import map_arrow, query, table, texts

# How the tokenizer file normalises and splits, and the same split
# for code points below U+0250, whose classes no Unicode version changes and
# which composition leaves alone. Other runs go through the library.
KNOWN_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
KNOWN_NORMALIZERS = ["NFC", "Replace", "Lowercase"]

LOT_CHARS = 8 << 20  # texts merged together; a longer text is a lot of its own


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


class PairMerger:
    """Vocabulary and merges of a tokenizer file, and the merge of many words at once."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)  # used for normalising and splitting only
        spec_ = json.loads(spec)
        model = spec_["model"]
        odd = {k: model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")}
        if model["type"] != "BPE" or any(odd.values()):
            raise ValueError(f"not a plain BPE model: {odd}")
        vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec_["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec_["added_tokens"]):
            raise ValueError("only plain added tokens are supported")
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.inner = {c: vocab[c] for c in byte_letters() if c in vocab}
        self.final = {c: vocab[c + suffix] for c in byte_letters() if c + suffix in vocab}
        self.merges = []
        for pair in model["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.append((vocab[a], vocab[b], vocab[a + b]))
        self.step = max(vocab.values()) + 1
        pair = np.array([a * self.step + b for a, b, _ in self.merges], np.int64)
        self.key_ranks = np.argsort(pair, kind="stable")
        self.keys = pair[self.key_ranks]
        # Whether no merge makes a symbol that an earlier merge takes: ranks then only come up in ascending order.
        used = {}
        for r, (a, b, _) in enumerate(self.merges):
            used.setdefault(a, r)
            used.setdefault(b, r)
        self.ordered = all(used.get(made, r + 1) > r for r, (_, _, made) in enumerate(self.merges))
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        self.bytes_joined = (spec_.get("decoder") or {}).get("type") == "ByteLevel"
        if spec_.get("decoder") and not self.bytes_joined:
            raise ValueError("only byte-level or absent decoders are supported")
        steps = (spec_.get("normalizer") or {}).get("normalizers", [])
        splits = (spec_.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.known = (
            [x["type"] for x in steps] == KNOWN_NORMALIZERS and steps[1].get("content") == " "
            and [x["type"] for x in splits] == ["Split", "ByteLevel"]
            and splits[0]["pattern"] == {"Regex": KNOWN_SPLIT} and splits[0]["invert"] and not splits[1]["use_regex"]
            and all(t.startswith("<") for t in self.added)
        )
        self.letters = dict(enumerate(byte_letters()))
        self.letter_bytes = {c: b for b, c in enumerate(byte_letters())}

    def _layout(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words in one row, and where each word starts (one more at the end)."""
        known = set("".join(self.inner))
        if not set("".join(words)) <= known:
            words = ["".join(c for c in w if c in known) for w in words]
        length = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(length)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        inner, final = np.zeros(512, np.int32), np.zeros(512, np.int32)
        for letters, ids in ((inner, self.inner), (final, self.final)):
            for c, i in ids.items():
                letters[ord(c)] = i
        sym = inner[codes]
        last = ends[length > 0] - 1
        sym[last] = final[codes[last]]
        return sym, np.concatenate([[0], ends])

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of each word as packed 32-bit integers, all words merged together."""
        sym, bounds = self._layout(words)
        n, step, keys, key_ranks = len(sym), self.step, self.keys, self.key_ranks
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        filled = bounds[:-1] < bounds[1:]
        prv[bounds[:-1][filled]] = nxt[bounds[1:][filled] - 1] = -1
        where: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray) -> None:
            """Index the pairs that start at these positions."""
            pair = sym[at].astype(np.int64) * step + sym[nxt[at]]
            slot = np.searchsorted(keys, pair)
            hit = keys[np.minimum(slot, len(keys) - 1)] == pair
            ranks, at = key_ranks[slot[hit]], at[hit]
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, part in zip(ranks[np.concatenate([[0], cuts])].tolist() if len(ranks) else [], np.split(at, cuts), strict=False):
                if rank not in where:
                    where[rank] = []
                    heapq.heappush(active, rank)
                where[rank].append(part)

        if n and len(keys):
            add(np.flatnonzero(nxt >= 0))
        while active:
            rank = heapq.heappop(active)
            first, second, made = self.merges[rank]
            parts = where.pop(rank)
            at = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
            at = at[(sym[at] == first) & (nxt[at] >= 0)]
            at = at[sym[nxt[at]] == second]
            if first == second and len(at) > 1:  # of a row of equal symbols, every other one starts a merge
                at = _every_other(at, nxt)
            if not self.ordered and len(at) > 1:  # merges may bring up lower ranks: one occurrence in each word at a time
                word = np.searchsorted(bounds, at, side="right")
                leading = np.concatenate([[True], word[1:] != word[:-1]])
                if not leading.all():
                    where[rank] = [at[~leading]]
                    heapq.heappush(active, rank)
                    at = at[leading]
            if not len(at):
                continue
            taken = nxt[at]
            after = nxt[taken]
            sym[at], sym[taken], nxt[at] = made, -1, after
            prv[after[after >= 0]] = at[after >= 0]
            before = prv[at]
            add(np.concatenate([at[after >= 0], before[before >= 0]]))
        kept = sym >= 0
        packed, cut = sym[kept].astype("<i4").tobytes(), (np.concatenate([[0], np.cumsum(kept)])[bounds] * 4).tolist()
        return [packed[i:j] for i, j in zip(cut, cut[1:], strict=False)]

    def _words(self, run: str) -> list[str | int]:
        """Byte-level words of a run without white space; an int is the id of an added token."""
        out: list[str | int] = []
        for part in self.added_pattern.split(run) if self.added_pattern else [run]:
            if part in self.added:
                out.append(self.added[part])
            elif part:
                plain = self.library.normalizer.normalize_str(part) if self.library.normalizer else part
                out += [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]
        return out

    def split(self, runs: list[bytes]) -> dict[bytes, list[str | int]]:
        """Words of each distinct run."""
        out, special, letters = {}, self.added_pattern, self.letters
        find = regex.compile(KNOWN_SPLIT).findall
        simple = re.compile("[\x21-\x7e\xa1-\u024f]+").fullmatch if self.known else (lambda t: False)
        for r in runs:
            t = r.decode("utf-8", "surrogatepass")
            if simple(t) and not (special and "<" in t and special.search(t)):
                words = find(t.lower())
                out[r] = words if t.isascii() else [w.encode().decode("latin-1").translate(letters) for w in words]
            else:
                out[r] = self._words(t)
        return out

    def encode(self, lot: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        runs = [t.encode("utf-8", "surrogatepass").split() for t in lot]
        split = self.split(list(dict.fromkeys(r for text in runs for r in text)))
        words = list(dict.fromkeys(w for ws in split.values() for w in ws if isinstance(w, str)))
        ids = dict(zip(words, self.merge(words), strict=True))
        ids.update((i, np.int32(i).tobytes()) for i in self.added.values())
        packed = {r: b"".join([ids[w] for w in ws]) for r, ws in split.items()}
        return [np.frombuffer(b"".join([packed[r] for r in text]), np.int32) for text in runs]

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids, added tokens included."""
        tokens = self.tokens
        if not self.bytes_joined:
            return " ".join([tokens[i] for i in ids.tolist()])
        letters = "".join([tokens[i] for i in ids.tolist()])
        if all(c in self.letter_bytes for c in letters):
            return bytes(self.letter_bytes[c] for c in letters).decode("utf-8", "replace")
        return "".join(
            bytes(self.letter_bytes[c] for c in t).decode("utf-8", "replace") if all(c in self.letter_bytes for c in t) else t
            for t in (tokens[i] for i in ids.tolist())
        )


def _every_other(at: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Of ascending positions, the first of each row of neighbours and every second after it."""
    joined = np.concatenate([[False], nxt[at[:-1]] == at[1:]])
    start = np.maximum.accumulate(np.where(joined, 0, np.arange(len(at))))
    return at[(np.arange(len(at)) - start) % 2 == 0]


def lots(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of batches whose texts have about ``LOT_CHARS`` code points, with the texts."""
    for batch in batches:
        start, lot, chars = 0, [], 0
        for k, text in enumerate(texts(batch.column(text_at))):
            lot.append(text)
            chars += len(text)
            if chars >= LOT_CHARS:
                yield batch.slice(start, k + 1 - start), lot
                start, lot, chars = k + 1, [], 0
        if lot:
            yield batch.slice(start), lot


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", decoded_col: str | None = "decoded") -> DataFrame:
    """All columns of ``docs`` but the text, with ``ids`` (array<int>) and what they decode to.

    ``tokenizer`` is the path of a tokenizer file that the driver can read; its
    content travels with the tasks. A null text counts as empty and gives no
    ids. Columns of the same names are replaced.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())  # the vocabulary: a few MB, whatever the corpus
    made = ["ids", *([decoded_col] if decoded_col else [])]
    docs = docs.select(*[c for c in docs.columns if c not in made or c == text_col])
    at = docs.columns.index(text_col)
    kept = [k for k in range(len(docs.columns)) if k != at]
    schema = StructType([docs.schema.fields[k] for k in kept]).add("ids", ArrayType(IntegerType()))
    if decoded_col:
        schema = schema.add(decoded_col, "string")

    def run(batches):
        merger = PairMerger(spec.value)
        for batch, lot in lots(batches, at):
            ids = merger.encode(lot)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            columns = [*(batch.column(k) for k in kept), pa.ListArray.from_arrays(offsets, np.concatenate(ids))]
            if decoded_col:
                columns.append(pa.array([merger.decode(x) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return map_arrow(docs, run, schema)


def decode(rows: DataFrame, tokenizer: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """All columns of ``rows`` with the text of ``ids_col``; null ids give an empty text."""
    with open(tokenizer, encoding="utf-8") as file:
        spec = rows.sparkSession.sparkContext.broadcast(file.read())
    rows = rows.drop(decoded_col)
    at = rows.columns.index(ids_col)

    def run(batches):
        merger = PairMerger(spec.value)
        for batch in batches:
            found = [merger.decode(np.array(x.as_py() or [], np.int64)) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, decoded_col])

    return map_arrow(rows, run, StructType(rows.schema.fields[:]).add(decoded_col, "string"))


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of rows with ids and decoded text."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def default_tokenizer(name: str) -> str:
    """Path of a tokenizer file of the installed ``public_tokenizers``."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_bpe_encode_decode")
def op2(spark, sf_dir):
    """Ids of every document and the text that they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(encode(docs, default_tokenizer("word_bpe_49k.json")))
