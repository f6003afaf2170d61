import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from panelforge.llm.unigram import MARKER, UnigramEncoder, decode_pieces, double_array, encode_pieces, load_vocabulary

SF = "/root/testdata/sf0.001"
ODD = ["Hello world", "  a  b\n", "日本語 x", "é ñandú", "", "x▁y", None, "\n", "   ", "a\n\n b", "🙂 ok", "\x00\x01", "Ⅷ ﬁ" * 3]


@pytest.fixture(scope="module")
def pieces(vocabulary):
    return load_vocabulary(vocabulary("piece_bpe_32k.model"))


def brute(v, text):
    """Best path by trying every piece at every place; ties go to the longer last piece."""
    if not text:
        return []
    ids = {s: i for i, s in enumerate(v.surface) if s and i not in set(v.byte_id.tolist())}
    s = " " + text.replace(MARKER, " ")
    best = [(0.0, None, None)] + [None] * len(s)
    for i in range(len(s)):
        alone = False
        for j in range(i + 1, min(len(s), i + v.depth) + 1):
            k = ids.get(s[i:j].encode())
            if k is not None:
                alone |= j == i + 1
                if best[j] is None or best[i][0] + v.score[k] > best[j][0]:
                    best[j] = (best[i][0] + v.score[k], i, [k])
        if not alone and (best[i + 1] is None or best[i][0] + v.unknown_score > best[i + 1][0]):
            best[i + 1] = (best[i][0] + v.unknown_score, i, [int(v.byte_id[b]) for b in s[i].encode()])
    out, at = [], len(s)
    while at:
        _, before, own = best[at]
        out, at = own + out, before
    return out


def test_double_array_holds_exactly_its_entries():
    words = {b"a": 1, b"ab": 2, b"abc": 3, b"b": 4, bytes([255, 0]): 5, b"zz": 6}
    base, check, value = double_array(words)

    def find(word):
        node = 0
        for byte in word:
            to = base[node] + byte + 1
            if check[to] != node:
                return -1
            node = to
        return value[node]

    assert {w: find(w) for w in words} == words
    assert find(b"z") == find(b"ac") == find(b"abcd") == find(bytes([255])) == -1


def test_brute_force(spark, pieces):
    texts = ODD + [r.text[:400] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    own = [v[0].tolist() for v in UnigramEncoder(pieces).texts(pa.array(texts, pa.string()), 5000)]
    assert own == [brute(pieces, t) for t in texts]


def test_score_equals_the_library(spark, pieces, vocabulary):
    """The public library's lattice search over the same pieces as a unigram model."""
    raw = open(vocabulary("piece_bpe_32k.model"), "rb").read()
    library = sentencepiece.SentencePieceProcessor(model_proto=raw + b"\x12\x02\x18\x01")  # model type: unigram
    words = {w for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(50).collect() for w in r.text.split() if w.isascii() and w.isalpha()}
    words = sorted(words)[:800]
    for word, (ids,) in zip(words, UnigramEncoder(pieces).texts(pa.array(words))):
        best = library.nbest_encode(word, nbest_size=2)[0]
        assert pieces.score[ids].sum() == pieces.score[best].sum(), word


def test_round_trip(spark, odd_docs, no_docs, pieces):
    for docs in (odd_docs, spark.read.parquet(f"{SF}/documents.parquet")):
        coded = encode_pieces(docs, pieces).withColumn("ids", F.col("pieces.ids"))
        back = decode_pieces(coded, pieces).select("text", "decoded", "pieces.n_tokens", "ids").collect()
        assert len(back) == docs.count()
        for r in back:
            assert r.decoded == (r.text or "").replace(MARKER, " ")
            assert r.n_tokens == len(r.ids) // 4 and (r.n_tokens > 0) == bool(r.text)
    assert encode_pieces(no_docs, pieces).count() == 0


def test_decoding_broken_bytes(spark, pieces):
    ids = np.array([pieces.byte_id[0xE2], pieces.byte_id[0x41]], "<u4").tobytes()
    row = decode_pieces(spark.createDataFrame([(bytearray(ids),), (None,)], "ids binary"), pieces).collect()
    assert [r.decoded for r in row] == ["�A", ""]
