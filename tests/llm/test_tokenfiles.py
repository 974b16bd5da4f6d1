import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sedimenta.llm import tokenfiles
from sedimenta.llm.prefixcode import PrefixCode, code_lengths
from sedimenta.llm.tokenfiles import TokenFile, WordEncoder, read_token_files, write_token_files
from tests.llm.helpers import documents, words

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
BYTES = str(public_tokenizers.path("byte_bpe_50k.json"))


def texts():
    pick = random.Random(5)
    out = ["", " ", "It's 'S WE'LL\n\n x  y\t", "Éauouon ßkeit ñ", "日本 語", "a<|endoftext|>b <|startoftext|>", "² ½ Ⅷ \x1c\x85 x y\xa0z", "é ́x", "x" * 5000, "ΑΣ ΑΣ.", "\x0b\x0c\r\nİ"]
    return out + ["".join(pick.choice("aéß 'sStT\n.1Zİ́\x85\x1f　 -") for _ in range(80)) for _ in range(400)]


def check_ids(encoder, tokenizer, some):
    for text, ids in zip(some, encoder.ids(pa.array(some, pa.string()), 7).to_pylist(), strict=True):
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 7]
        assert np.frombuffer(ids, encoder.dtype).tolist() == want, text


@pytest.mark.parametrize("path", [PATH, BYTES])
def test_ids_are_those_of_the_tokenizer(path):
    encoder, tokenizer = WordEncoder(path), Tokenizer.from_file(path)
    assert encoder._by_word is (path == PATH)
    some = [None, *texts(), None, "", "  "]
    check_ids(encoder, tokenizer, some)
    for text in some:
        check_ids(encoder, tokenizer, [text])
    column = pa.array(some, pa.string())
    assert encoder.ids(column.slice(5, 30), 7).to_pylist() == encoder.ids(column, 7).to_pylist()[5:35]
    assert len(encoder.ids(column.slice(0, 0), 7)) == 0


def test_words_of_common_characters_are_cut_as_the_library_does():
    encoder, tokenizer = WordEncoder(PATH), Tokenizer.from_file(PATH)
    letters = [chr(c) for c in range(0x21, 0x2030) if tokenfiles._COMMON.fullmatch(chr(c))]
    words = [a + b for a in letters for b in ("", "s", "É", "1", "'S", ".")] + [b + a for a in letters for b in ("x'", "'", "9", "Ñ")]
    words += ["<|startoftext|>x", "a<|endoftext|>", "x" * 70 + "é" * 70, "don't'll'd''s", "ⅧA"]
    check_ids(encoder, tokenizer, words)
    assert not any(len(word) > 64 for word in [*encoder._words, *encoder._pieces])


def test_a_full_memory_of_words_is_emptied(monkeypatch):
    monkeypatch.setattr(tokenfiles, "_WORDS", 5)
    monkeypatch.setattr(tokenfiles, "_PIECES_KEPT", 5)
    encoder, tokenizer = WordEncoder(PATH), Tokenizer.from_file(PATH)
    check_ids(encoder, tokenizer, texts())
    for text in texts():
        check_ids(encoder, tokenizer, [text])


def huffman_bits(counts):
    heap, total = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        total += pair
        heapq.heappush(heap, pair)
    return total


def best_limited(counts, longest):
    """Least total over all length sequences of at most ``longest`` bits, by trying them."""
    counts = sorted((int(c) for c in counts if c), reverse=True)
    best = [None]

    def go(i, least, room, total):
        if room < 0 or (best[0] is not None and total >= best[0]):
            return
        if i == len(counts):
            best[0] = total
            return
        for length in range(least, longest + 1):
            go(i + 1, length, room - (1 << (longest - length)), total + length * counts[i])

    go(0, 1, 1 << longest, 0)
    return best[0]


def test_code_lengths_are_best():
    pick = np.random.default_rng(1)
    for n in (2, 3, 7, 50, 400):
        counts = pick.integers(0, 1000, n) ** 2
        counts[:2] = 1, 5
        lengths = code_lengths(counts, 40).astype(int)
        assert (counts * lengths).sum() == huffman_bits(counts)
        assert ((lengths > 0) == (counts > 0)).all()
    for _ in range(30):
        counts = (2.0 ** pick.integers(0, 14, 7)).astype(int)
        for longest in (3, 4, 5):
            lengths = code_lengths(counts, longest).astype(int)
            assert lengths.max() <= longest and (0.5**lengths).sum() <= 1
            assert (counts * lengths).sum() == best_limited(counts, longest)
    assert code_lengths(np.array([0, 9, 0]), 4).tolist() == [0, 1, 0]
    assert code_lengths(np.zeros(3), 4).tolist() == [0, 0, 0]
    with pytest.raises(ValueError, match="bits"):
        code_lengths(np.ones(9), 3)


def test_canonical_codes_decode_from_any_checkpoint():
    pick = np.random.default_rng(2)
    counts = (pick.pareto(0.5, 3000) * 10 + 1).astype(np.int64)
    code = PrefixCode(code_lengths(counts, 16))
    order = sorted(range(3000), key=lambda i: (code.lengths[i], i))
    written = [f"{int(code.codes[i]):0{code.lengths[i]}b}" for i in order]
    assert written == sorted(written) and not any(b.startswith(a) for a, b in zip(written, written[1:], strict=False))
    ids = pick.choice(3000, 10_001, p=counts / counts.sum())
    data, starts = code.encode(ids, 100)
    assert "".join(f"{b:08b}" for b in data).startswith("".join(f"{int(code.codes[i]):0{code.lengths[i]}b}" for i in ids))
    raw = np.frombuffer(data, dtype=np.uint8)
    assert (code.decode(raw, starts, np.minimum(10_001 - 100 * np.arange(101), 100)) == ids).all()
    assert (code.decode(raw, starts[[7, 3]], np.array([100, 5])) == np.concatenate([ids[700:800], ids[300:305]])).all()


def expected(rows, path=PATH, end=2):
    """Rows in the order of the files: without id first, then by id, in the order given."""
    tokenizer, out, start = Tokenizer.from_file(path), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        raw = np.array(ids, "<u4").tobytes()
        out.append((doc_id, start, len(ids), zlib.crc32(raw), raw))
        start += len(ids)
    return out


def rows():
    pick = random.Random(9)
    out = [(i, t) for i, t in enumerate(texts())]
    out += [(2000 - i, " ".join(words(i, pick.randint(0, 300)))) for i in range(400)]
    out += [(5000, None), (None, "no id"), (-3, "long text " * 60_000)]
    pick.shuffle(out)
    return out


@pytest.mark.parametrize("shape", [{}, {"block_ids": 1000, "checkpoint_ids": 7}, {"block_ids": 64, "checkpoint_ids": 64}])
def test_files_round_trip(spark, tmp_path, shape):
    docs = documents(spark, rows()).withColumnRenamed("lang", "ids").repartition(5)
    files = write_token_files(docs, PATH, str(tmp_path), **shape).orderBy("part").collect()
    out = read_token_files(spark, str(tmp_path), keep_ids=True).orderBy("start").collect()
    want = expected(rows())
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in out] == want
    assert [tuple(r) for r in read_token_files(spark, str(tmp_path)).orderBy("start").collect()] == [w[:4] for w in want]
    stream = np.frombuffer(b"".join(w[4] for w in want), "<u4")
    assert sum(f.n_tokens for f in files) == len(stream) and sum(f.n_docs for f in files) == len(want)
    at, pick = 0, random.Random(1)
    for f in files:
        file = TokenFile(f"{tmp_path}/{f.file}")
        for _ in range(20):  # any stretch, from the checkpoint before it
            first, count = pick.randrange(f.n_tokens), pick.randrange(3000)
            assert (file.ids(first, count) == stream[at + first : at + min(first + count, f.n_tokens)]).all()
        assert len(file.ids(f.n_tokens)) == 0
        file.close()
        at += f.n_tokens
    assert sum(f.n_bytes for f in files) < 2.4 * len(stream) + 200_000 * len(files)


def test_documents_longer_than_what_is_decoded_at_once(spark, tmp_path):
    file = []
    docs = documents(spark, rows()).coalesce(1)
    write_token_files(docs, PATH, str(tmp_path), block_ids=100, checkpoint_ids=30)
    for f in spark.read.parquet(f"{tmp_path}/files").orderBy("part").collect():
        base = sum(len(b) for b in file)
        whole = TokenFile(f"{tmp_path}/{f.file}")
        file += list(whole.stretches(100))
        assert sum(len(b) for b in file) == base + f.n_tokens
    want = expected(rows())
    assert (np.concatenate(file) == np.frombuffer(b"".join(w[4] for w in want), "<u4")).all()


def test_repeated_ids_other_types_and_another_tokenizer(spark, tmp_path):
    docs = spark.createDataFrame([("b", "two words"), ("a", "first"), ("b", "two words"), (None, "")], "doc_id string, text string")
    write_token_files(docs.coalesce(1), BYTES, f"{tmp_path}/files1", end_id=0)
    out = read_token_files(spark, f"{tmp_path}/files1", "string").orderBy("start").collect()
    assert [r.doc_id for r in out] == [None, "a", "b", "b"] and out[2].ids_crc32 == out[3].ids_crc32
    small = docs.filter("doc_id = 'a'").select(F.lit(7).cast("smallint").alias("doc_id"), "text")
    write_token_files(small, BYTES, f"{tmp_path}/files2", end_id=0)
    assert [(r.doc_id, r.start) for r in read_token_files(spark, f"{tmp_path}/files2", "smallint").collect()] == [(7, 0)]


def test_empty_table(spark, tmp_path):
    docs = documents(spark, [(1, "x")]).limit(0)
    assert write_token_files(docs, PATH, str(tmp_path)).count() == 0
    assert read_token_files(spark, str(tmp_path)).collect() == []


def test_damage_is_found(spark, tmp_path):
    write_token_files(documents(spark, [(1, "some text " * 500)]), PATH, str(tmp_path))
    (name,) = [r.file for r in spark.read.parquet(f"{tmp_path}/files").collect()]
    raw = bytearray((tmp_path / name).read_bytes())
    (tmp_path / "cut").write_bytes(raw[:-3])
    with pytest.raises(ValueError, match="whole"):
        TokenFile(str(tmp_path / "cut"))
    whole = TokenFile(str(tmp_path / name))
    raw[int(whole._blocks[0][0]) + 5] ^= 1
    (tmp_path / "bad").write_bytes(raw)
    with pytest.raises(ValueError, match="damaged"):
        TokenFile(str(tmp_path / "bad")).ids()
