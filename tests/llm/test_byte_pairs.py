"""Byte-level BPE against the tokenizer library, and the parts on their own."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from pixelframe.llm import byte_pairs

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def words():
    return byte_pairs.vocabulary(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = byte_pairs.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(11)
    classes = ["a", "B", "é", "ß", "1", "²", "Ⅷ", " ", "\n", " ", " ", "!", "'", "'s", "'ll", "\U0001f600", "̀", "中", "࢏", "\x1c"]
    mixed = ["".join(rng.choices(classes, k=rng.randint(1, 60))) for _ in range(300)]
    points = "".join(chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000)
    return [*mixed, points, " ".join(points[:20000]), "a" * 30_000, " " * 5000, "ab" * 9000 + "\n\n x", "<|endoftext|>", ""]


def test_as_library(words, library):
    encoder = byte_pairs.Encoder(words)
    texts = odd_texts()
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder(texts)]
    assert got == [library.encode_ordinary(t) for t in texts]
    again = [np.frombuffer(b, "<u4").tolist() for t in texts for b in encoder([t])]
    assert again == got


def test_small_memory(words, library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 3)
    texts = ["qzxv wvut qzxv zzyx", "wvut pqrs qzxv xxzy"] * 5
    assert [np.frombuffer(b, "<u4").tolist() for b in byte_pairs.Encoder(words)(texts)] == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("count", [0, 1, 5, 3000])
def test_perfect_hash(count):
    keys = [f"key {i}".encode() for i in range(count)]
    table = byte_pairs.PerfectHash(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(count))
    if count:
        assert set(table.slots([b"", b"other"]).tolist()) <= set(range(count))


def test_merge_against_search_of_the_least(words):
    ranks = dict(zip(words.tokens, words.ids.tolist(), strict=True))
    rng = random.Random(12)
    for _ in range(300):
        piece = bytes(rng.choices(b"abetn \xc3\xa9", k=rng.randint(1, 40)))
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            joined = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
            if not joined:
                break
            _, i = min(joined)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert byte_pairs.merged(piece, ranks, 99) == [ranks[p] for p in parts]


def test_tables(spark, words, library):
    rows = [(1, "One two  three's", 5), (1, "One two  three's", 5), (2, None, 6), (None, "", 7), (3, "x" * 3000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, body string, text long")
    found = byte_pairs.encode(docs, words, ["doc_id", "text"], text="body", ids="decoded")
    back = byte_pairs.decode(found, words, ["text", "decoded"], ids="decoded", decoded="doc_id").collect()
    assert sorted((r.text, bytes(r.doc_id).decode()) for r in back) == sorted((n, t or "") for _, t, n in rows)
    ids = {r.text: np.frombuffer(r.decoded, "<u4").tolist() for r in found.collect()}
    assert ids == {n: library.encode_ordinary(t or "") for _, t, n in rows}
    assert byte_pairs.encode(docs.limit(0), words, ["doc_id"], text="body").count() == 0
    broken = spark.sql("select cast(X'61ff62' as string) as text")
    assert byte_pairs.decode(byte_pairs.encode(broken, words, []), words, []).first().decoded == "a�b".encode()


def test_query(spark, library, tmp_path):
    rows = [(i, t) for i, t in enumerate(["", None, "Hello, wörld's 12", "line\r\n\r\n  indented"])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in byte_pairs.op11_byte_pairs(spark, str(tmp_path)).collect()}
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_incomplete_vocabulary(tmp_path):
    (tmp_path / "ranks").write_text("YQ== 0\n")
    with pytest.raises(ValueError, match="lacks the bytes"):
        byte_pairs.vocabulary(str(tmp_path / "ranks"), public_tokenizers.PATTERN)
