"""BPE and the token store give what the tokenizers library gives."""

import hashlib
import os
import struct
import zlib

import numpy as np
import pytest
from texts import no_docs, odd_docs, odd_texts, prose

tokenizers = pytest.importorskip("tokenizers")

from veinworks.llm import bpe, token_store  # noqa: E402
from veinworks.llm.base import fresh_folder  # noqa: E402
from veinworks.llm.files import coalesce, filesystem  # noqa: E402

WORD, BYTE = bpe.default_tokenizer("word_bpe_49k.json"), bpe.default_tokenizer("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def merger():
    with open(WORD, encoding="utf-8") as f:
        return bpe.PairMerger(f.read())


@pytest.mark.parametrize("ordered", [True, False])
def test_ids_and_decoded_text_equal_the_library(merger, ordered):
    library, texts = tokenizers.Tokenizer.from_file(WORD), [t or "" for t in odd_texts()] + [prose(s, 200) for s in range(20)]
    merger.ordered = ordered
    for text, ids in zip(texts, merger.encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, text[:50]
        assert merger.decode(ids) == library.decode(want, skip_special_tokens=False)
    merger.ordered = True


def test_merges_of_equal_symbols(merger):
    library = tokenizers.Tokenizer.from_file(WORD)
    words = ["a" * n for n in range(1, 40)] + ["haha" * n for n in range(1, 9)] + ["00000", "........", "oooooooh"]
    for word, ids in zip(words, merger.encode(words), strict=True):
        assert ids.tolist() == library.encode(word, add_special_tokens=False).ids


def test_encode_keeps_rows_and_columns(spark):
    library = tokenizers.Tokenizer.from_file(WORD)
    docs = odd_docs(spark, "ids decoded n_chars")
    rows = bpe.encode(docs, WORD).collect()
    assert set(rows[0].asDict()) == {"doc_id", "lang", "source", "n_chars", "ids", "decoded"} and len(rows) == docs.count()
    want = sorted(tuple(library.encode(t or "", add_special_tokens=False).ids) for t in [r["text"] for r in docs.collect()])
    assert sorted(tuple(r["ids"]) for r in rows) == want
    again = bpe.decode(bpe.encode(docs, WORD), WORD).select("ids", "decoded").collect()
    assert all(r["decoded"] == library.decode(r["ids"], skip_special_tokens=False) for r in again)
    assert bpe.encode(no_docs(spark), WORD).count() == 0


def test_digests(spark):
    library = tokenizers.Tokenizer.from_file(WORD)
    docs = spark.createDataFrame([(1, prose(3, 50)), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe.digests(bpe.encode(docs, WORD)).collect()}
    for k, text in ((1, prose(3, 50)), (2, "")):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        sums = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]
        assert got[k] == (len(ids), *sums)


def test_pieces_equal_the_library(monkeypatch):
    library = tokenizers.Tokenizer.from_file(BYTE)
    with open(BYTE, encoding="utf-8") as f:
        encoder = token_store.PieceEncoder(f.read())
    texts = [t or "" for t in odd_texts()] + [prose(s, 100) for s in range(10)]
    texts += [" a b\nc\n\nd\te f.\n G", "a\n \nb", "x \n", " a \xa0b　c", "x\x1cy \x1dz", " lead", "trail ", "\n"]
    monkeypatch.setattr(token_store, "PIECES_AT_ONCE", 50)
    found = list(encoder.encode(texts, 0))
    assert len(found) > 3
    ids, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
    assert len(ids) == sizes.sum()
    at = 0
    for text, n in zip(texts, sizes.tolist(), strict=True):
        assert ids[at : at + n].tolist() == library.encode(text, add_special_tokens=False).ids + [0], text[:50]
        at += n


def test_store_round_trip(spark):
    library, docs, folder = tokenizers.Tokenizer.from_file(BYTE), odd_docs(spark, "start n_tokens shard"), fresh_folder(spark, "t")
    index = token_store.write_store(docs, BYTE, folder, shards=3)
    rows = token_store.read_store(token_store.global_starts(index), folder).collect()
    assert len(rows) == docs.count()
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, bytes(r["ids"])) for r in rows)
    packed = [(r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids + [0]) for r in docs.collect()]
    assert got == sorted((k is not None, k or 0, struct.pack(f"<{len(v)}I", *v)) for k, v in packed)
    rows.sort(key=lambda r: r["first"])
    assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in rows), key=lambda k: (k is not None, k or 0))
    assert [r["first"] for r in rows] == [sum(x["n_tokens"] for x in rows[:k]) for k in range(len(rows))]
    some = token_store.read_store(index.where("doc_id = 8"), folder).collect()
    assert len(some) == 1 and zlib.crc32(some[0]["ids"]) == zlib.crc32(next(x for _, k, x in got if k == 8))
    assert token_store.write_store(no_docs(spark), BYTE, fresh_folder(spark, "t")).count() == 0


def test_readers_decompress_only_frames_asked_for(spark, tmp_path):
    path = tmp_path / "x.zst"
    with open(path, "wb") as f:
        writer = token_store.FrameWriter(f, frame_bytes=1000)
        data = os.urandom(10_500)
        for at in range(0, len(data), 700):
            writer.write(data[at : at + 700])
        writer.close()
    fs, where = filesystem(f"file://{path}")
    reader = token_store.FrameReader(fs.open_input_file(where))
    assert reader.read(2_950, 100) == data[2_950:3_050] and reader.decompressed == 2
    assert reader.read(0, len(data)) == data and reader.read(10_499, 1) == data[-1:] and reader.read(5, 0) == b""
    import zstandard

    whole = path.read_bytes()
    assert zstandard.ZstdDecompressor().stream_reader(whole, read_across_frames=True).read() == data
    broken = bytearray(whole)
    broken[-10] ^= 1  # in the checksum of the last frame
    path.write_bytes(broken)
    with pytest.raises(OSError, match="checksum"):
        token_store.FrameReader(fs.open_input_file(where)).read(0, len(data))


def test_coalesce():
    assert coalesce([(10, 5), (0, 5), (16, 4), (100, 1)], 5, 100) == [(0, 20), (100, 1)]
    assert coalesce([(0, 60), (60, 60), (120, 500)], 5, 100) == [(0, 60), (60, 60), (120, 500)]
