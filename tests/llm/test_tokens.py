import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from panelforge.llm import encoding, packing
from panelforge.llm.encoding import Encoder
from panelforge.llm.packing import pack_mixture
from panelforge.llm.simple8b import COUNTS, pack, read_token_file, unpack, write_token_file
from panelforge.llm.token_counts import allocate, token_counts

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", "  ", "a  b  c", "don't it's. we'll, x", "É. ñ, ×. ÷! ẖ H̱ Å. Å", "\n\n a  b\t\tc \n", "x" * 50 + "." * 30,
    "日本語。 テスト text. 12.5, 3", "a .b ?c", "\r\n\x0b\x0c x\x85 y\x1c z", "“quoted” —dash… …. ½. ª. ²", "Σ ΟΔΟΣ. İ İ.", "'S 'RE. 's", "rock'n'roll's.#tag!",
    "hello​ world", "  a  b", "<|endoftext|> a",
]


def plain(vocabulary, name, texts, end):
    tool = Tokenizer.from_file(vocabulary(name))
    tool.encode_special_tokens = True
    return [np.array(e.ids + [end], "<u4") for e in tool.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize(("name", "lower"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_cached_pieces_equal_whole_texts(spark, vocabulary, monkeypatch, name, lower):
    monkeypatch.setattr(encoding, "REMEMBERED", 5000)  # the cache starts again several times
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    own = [v[0].tolist() for v in Encoder(vocabulary(name), lower).texts(pa.array(texts, pa.string()), 20_000)]
    assert own == [v[:-1].tolist() for v in plain(vocabulary, name, texts, 0)]


def test_spans_equal_whole_texts(vocabulary):
    tool = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    tool.encode_special_tokens = True
    own = Encoder(vocabulary("byte_bpe_50k.json"), spans=True).texts(pa.array(ODD, pa.string()))
    for text, (ids, begin, end) in zip(ODD, own):
        whole = tool.encode(text or "", add_special_tokens=False)
        assert whole.ids == ids.tolist() and whole.offsets == list(zip(begin.tolist(), end.tolist()))


@pytest.mark.parametrize("high", [1, 2, 3, 17, 300, 49408, 2**20 + 1, 2**31, 2**60, 2**64])
def test_words_round_trip(high):
    rng = np.random.default_rng(high % 1000)
    for n in (0, 1, 2, 59, 127, 128, 129, 240, 241, 5000):
        ids = rng.integers(0, high - 1, n, dtype=np.uint64, endpoint=True)
        ids[rng.random(n) < 0.3] = 0
        words, escapes = pack(ids)
        assert (unpack(words, escapes, n) == ids).all()
        assert len(words) <= max(n, 1) and (COUNTS[(words >> np.uint64(60)).astype(int)].sum() >= n)


def test_token_file(spark, vocabulary, odd_docs, no_docs, tmp_path):
    for i, docs in enumerate((odd_docs, spark.read.parquet(f"{SF}/documents.parquet"))):
        write_token_file(docs, path := str(tmp_path / str(i)), vocabulary("word_bpe_49k.json"), 2, block_ids=3000)
        rows = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
        ids = plain(vocabulary, "word_bpe_49k.json", [t for _, t in rows], 2)
        found = sorted(read_token_file(spark, path, with_ids=True).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in found] == [d for d, _ in rows]
        assert [r.ids for r in found] == [v.tolist() for v in ids]
        assert [r.start for r in found] == np.cumsum([0] + [len(v) for v in ids])[:-1].tolist()
        assert [r.ids_crc32 for r in found] == [zlib.crc32(v.tobytes()) for v in ids]
    write_token_file(no_docs, path := str(tmp_path / "none"), vocabulary("word_bpe_49k.json"), 2)
    assert read_token_file(spark, path).count() == 0


def test_a_token_file_holds_its_payload_once(spark, vocabulary, odd_docs, monkeypatch, tmp_path):
    from pyspark.sql import DataFrameWriter

    written, put = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **b: written.append((self._df.columns, path)) or put(self, path, *a, **b))
    write_token_file(odd_docs, path := str(tmp_path / "once"), vocabulary("word_bpe_49k.json"), 2)
    payload = [at for columns, at in written if "words" in columns]
    assert len(payload) == 1 and payload[0].startswith(path)
    with pytest.raises(FileExistsError):
        write_token_file(odd_docs, path, vocabulary("word_bpe_49k.json"), 2)


@pytest.mark.parametrize("weights", [None, {"s0": 5.0}])
def test_packing(vocabulary, odd_docs, weights):
    rows = odd_docs.collect()
    ids = plain(vocabulary, "byte_bpe_50k.json", [r.text for r in rows], 1)
    pieces = pack_mixture(odd_docs, vocabulary("byte_bpe_50k.json"), 1, length=64, window=512, weights=weights, with_ids=True).collect()
    assert sum(p.length for p in pieces) == sum(map(len, ids))
    pieces.sort(key=lambda p: (p.sequence_id, p.offset))
    at = 0
    for p in pieces:  # gapless, never over a sequence's end
        assert (p.sequence_id, p.offset) == divmod(at, 64) and p.offset + p.length <= 64
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        at += p.length
    whole = {}
    for p in sorted(pieces, key=lambda p: p.start):
        if p.doc_id != rows[5].doc_id:  # that one stands there twice
            assert len(whole.setdefault(p.doc_id, b"")) == 4 * p.start
            whole[p.doc_id] += p.ids
    assert whole == {r.doc_id: v.tobytes() for r, v in zip(rows, ids) if r.doc_id != rows[5].doc_id}


def test_packing_holds_the_mixture(spark, vocabulary):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "text", "if(doc_id % 10 = 0, 'rare', 'rest') source")
    pieces = pack_mixture(docs, vocabulary("byte_bpe_50k.json"), 1, length=512, window=8192, weights={"rare": 1.0, "rest": 3.0})
    sent = {(r["round"], r.source): r.n for r in pieces.groupBy("round", "source").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    full = [k for k in range(max(k for k, _ in sent)) if (k + 1, "rare") in sent and (k + 1, "rest") in sent]
    assert len(full) > 3
    assert all(abs(sent[k, "rare"] - 2048) <= 1 and abs(sent[k, "rest"] - 6144) <= 1 for k in full)


def test_packing_nothing(vocabulary, no_docs):
    assert pack_mixture(no_docs, vocabulary("byte_bpe_50k.json"), 1).count() == 0


def test_allocation_rule():
    starts = np.array([0, 5, 7, 20])
    begin, end = np.array([0, 3, 4, 4, 6, 19, 25, 7]), np.array([5, 6, 6, 7, 21, 21, 25, 7])
    to, crossing = allocate(starts, begin, end)
    assert to.tolist() == [0, 0, 0, 1, 2, 2, 3, 2]
    assert crossing.tolist() == [False, True, True, True, True, True, False, False]


def test_token_counts(odd_docs, no_docs, vocabulary):
    tool = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    found = {}
    for r in token_counts(odd_docs, vocabulary("byte_bpe_50k.json")).collect():
        found.setdefault(r.doc_id, {})[(r.field == "text", r.section)] = r
    for row in odd_docs.collect():
        source, text = row.source or "", row.text or ""
        own = found[row.doc_id]
        if row.doc_id == odd_docs.collect()[5].doc_id:
            continue
        assert len(own) == 1 + max(1, text.count("\n") + 1)
        whole = tool.encode(source + "\n" + text, add_special_tokens=False)
        assert sum(r.n_tokens for r in own.values()) == len(whole.ids) == own[False, 0].doc_tokens
        assert own[False, 0].stop == len(source) + 1 and own[True, 0].start == len(source) + 1
    assert token_counts(no_docs, vocabulary("byte_bpe_50k.json")).count() == 0


MARKED = [
    "end of page <|endoftext|> next", "<|endoftext|>", "a<|endoftext|>b<|endoftext|><|endoftext|> ", "<|ENDOFTEXT|> <|EndOfText|>x", "<|startoftext|>A b.<|endoftext|>\n\nC",
    "<|endoftext| >", "<|<|endoftext|>|>", "x  <|endoftext|>  y", "é<|endoftext|>\u0301é", "Word.<|endoftext", "|> later", "...<|endoftext|>...", *[t for t in ODD if t != ""], "",
]


@pytest.mark.parametrize(("name", "lower"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
@pytest.mark.parametrize("spans", [False, True])
def test_added_tokens_as_in_the_library(vocabulary, name, lower, spans):
    tool = Tokenizer.from_file(vocabulary(name))
    for at_once in (1, 4 << 20):
        own = list(encoding.encoder(vocabulary(name), lower, spans).texts(pa.array(MARKED, pa.string()), at_once))
        for text, found in zip(MARKED, own, strict=True):
            whole = tool.encode(text or "", add_special_tokens=False)
            assert found[0].tolist() == whole.ids, text
            if spans and not lower:
                assert list(zip(found[1].tolist(), found[2].tolist())) == whole.offsets, text


def test_token_file_and_packing_with_added_tokens(spark, vocabulary, tmp_path):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(MARKED)], "doc_id long, text string, source string")
    write_token_file(docs, path := str(tmp_path / "ids"), vocabulary("word_bpe_49k.json"), 2)
    tool = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    whole = [tool.encode(t or "", add_special_tokens=False).ids + [2] for t in MARKED]
    found = sorted(read_token_file(spark, path, with_ids=True).collect(), key=lambda r: r.doc_id)
    assert [r.ids for r in found] == whole
    assert [r.start for r in found] == np.cumsum([0] + [len(v) for v in whole])[:-1].tolist()
    tool = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    sizes = {r.doc_id: r.doc_tokens for r in pack_mixture(docs, vocabulary("byte_bpe_50k.json"), 1).collect()}
    assert sizes == {i: len(tool.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in enumerate(MARKED)}


@pytest.mark.parametrize(("name", "lower"), [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
@pytest.mark.parametrize("remembered", [60, 400])
def test_forgetting_pieces_changes_no_id(vocabulary, odd_docs, monkeypatch, name, lower, remembered):
    monkeypatch.setattr(encoding, "REMEMBERED", remembered)
    tool = encoding.Encoder(vocabulary(name), lower, specials=True)
    texts = [r.text for r in odd_docs.select("text").collect() if len(r.text or "") < 5000]
    for _ in range(3):  # batches of two texts, again and again
        for i in range(0, len(texts), 2):
            for text, (ids,) in zip(texts[i : i + 2], tool.texts(pa.array(texts[i : i + 2], pa.string()))):
                assert ids.tolist() == tool.tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("name", "lower"), [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_new_pieces_reach_the_tokenizer_joined(vocabulary, odd_docs, monkeypatch, name, lower):
    """Many pieces in one text, an added token between them: few result objects, the same ids."""
    monkeypatch.setattr(encoding, "JOINED", 50)
    tool = encoding.Encoder(vocabulary(name), lower, specials=True)
    joined, sizes = tool._solve_joined, []
    monkeypatch.setattr(tool, "_solve_joined", lambda new: sizes.append(len(new)) or joined(new))
    texts = [t or "" for t in ODD[:-1] + ["<|endoftext", "|> <|endoftext", "<|"]] + [r.text for r in odd_docs.select("text").collect() if 0 < len(r.text or "") < 5000]
    for text, (ids,) in zip(texts, tool.texts(pa.array(texts, pa.string()), 20_000)):
        assert ids.tolist() == tool.tokenizer.encode(text, add_special_tokens=False).ids
    assert max(sizes) > 50


def round_robin(queues, quanta):
    """Deficit round-robin by the book: each round a source's credit grows by its quantum, whole tokens
    are sent and the rest is carried. Gives the stream of (source, place in its queue)."""
    credit, sent, out = {s: 0 for s in queues}, {s: 0 for s in queues}, []
    while any(sent[s] < n for s, n in queues.items()):
        for s in sorted(queues):
            credit[s] += quanta[s]
            n = min(credit[s] >> 16, queues[s] - sent[s])
            credit[s] -= (credit[s] >> 16) << 16
            out += [(s, sent[s] + i) for i in range(n)]
            sent[s] += n
    return out


@pytest.mark.parametrize("window", [40, 700, 1 << 20])
def test_packing_equals_a_plain_round_robin(spark, vocabulary, window, monkeypatch):
    monkeypatch.setattr(packing, "RUN", 3)
    docs = spark.createDataFrame([(i, f"s{i % 7 % 3}", "word " * (i * 5 % 23)) for i in range(60)], "doc_id long, source string, text string")
    weights = {"s0": 5.0, "s1": 1.0, "s2": 2.5}
    pieces = pack_mixture(docs, vocabulary("byte_bpe_50k.json"), end_id=1, length=64, window=window, weights=weights).collect()
    sizes = {r.doc_id: r.doc_tokens for r in pieces}
    ahead, queues = {}, {"s0": 0, "s1": 0, "s2": 0}
    for r in docs.orderBy("doc_id").collect():
        ahead[r.doc_id] = queues[r.source]
        queues[r.source] += sizes[r.doc_id]
    quanta = {s: max(1 << 16, int(w / 8.5 * float(window << 16))) for s, w in weights.items()}
    place = {at: i for i, at in enumerate(round_robin(queues, quanta))}
    assert len(place) == sum(sizes.values())
    for r in pieces:
        for j in range(r.length):
            assert place[r.source, ahead[r.doc_id] + r.start + j] == r.sequence_id * 64 + r.offset + j
