"""Tokenizer operators against the libraries, and file round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from edge_rows import TEXTS, edge_docs, no_docs
from tidemart.llm import archives
from tidemart.llm import sentencepiece_codec as sc
from tidemart.llm import token_files
from tidemart.llm.common import read_table
from tidemart.llm.queries import QUERIES, SENTENCEPIECE_MODEL, TOKENIZER, vocabulary_path

MODEL = sc.model_bytes(vocabulary_path(SENTENCEPIECE_MODEL))


def as_unigram():
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(MODEL)
    proto.trainer_spec.model_type = sc.UNIGRAM
    return proto.SerializeToString()


def odd_texts(n=150):
    rng = random.Random(9)
    letters = "aabcdeeeghiiilmnnoorsttu   \n\t.,'-\u2581éßñ中文\u0301😀0123456789THE"
    return ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(n)]


def test_codec_equals_library():
    library, codec = sentencepiece.SentencePieceProcessor(model_proto=MODEL), sc.Codec(MODEL)
    texts = odd_texts() + ["the quick brown fox, internationalization", "   ", "a  b   c    d", "\n", " lead", "trail "]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text), text
        assert codec.decode(ids.tolist()) == library.decode(ids.tolist()) == text.replace(sc.MARK, " "), text


def test_unigram_sums_are_the_librarys_best():
    model = as_unigram()
    library, codec = sentencepiece.SentencePieceProcessor(model_proto=model), sc.Codec(model)
    rng = random.Random(4)
    for _ in range(100):
        text = " ".join("".join(rng.choices("aeionrstlhd", k=rng.randint(1, 9))) for _ in range(6))
        [ids], [best] = codec.encode([text]), library.nbest_encode_as_ids(text, 1)
        assert sum(map(library.get_score, ids.tolist())) == sum(map(library.get_score, best)), text
        assert codec.decode(ids.tolist()) == text


def test_codec_equals_library_on_documents(spark, sf_dir):
    library, codec = sentencepiece.SentencePieceProcessor(model_proto=MODEL), sc.Codec(MODEL)
    texts = [r.text for r in read_table(spark, sf_dir, "documents").collect()]
    assert all(a.tolist() == b for a, b in zip(codec.encode(texts), library.encode(texts), strict=True))


def test_prefixes_are_shared_and_order_is_free():
    codec = sc.Codec(MODEL)
    words = sorted({w for t in odd_texts(40) for w in codec.words.findall("▁" + t.replace(" ", "▁"))})
    together = dict(codec.segmented(words))
    assert all(next(sc.Codec(MODEL).segmented([w]))[1] == together[w] for w in words[::9])


def test_a_full_cache_changes_nothing():
    kept, sc.CACHE_WORDS = sc.CACHE_WORDS, 3
    try:
        codec, texts = sc.Codec(MODEL), odd_texts(30)
        assert [i.tolist() for t in texts for i in codec.encode([t])] == [i.tolist() for i in sc.Codec(MODEL).encode(texts)]
    finally:
        sc.CACHE_WORDS = kept


def test_encode_decode_frames(spark):
    path = vocabulary_path(SENTENCEPIECE_MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    coded = sc.encode(edge_docs(spark), path)
    assert coded.columns == [c for c in edge_docs(spark).columns if c != "ids"] + ["ids"]
    rows = sc.decode(coded, path).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert r.ids == library.encode(r.text or "") and r.decoded == (r.text or "").replace(sc.MARK, " ")
    assert sc.encode(no_docs(spark), path).count() == 0


def test_sentencepiece_query(spark, sf_dir):
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(SENTENCEPIECE_MODEL))
    texts = {r.doc_id: r.text for r in read_table(spark, sf_dir, "documents").collect()}
    rows = QUERIES["op1_sentencepiece"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_crc32, r.same) == (len(ids), zlib.crc32(np.array(ids, "<i4").tobytes()), True)


# ---- token files -------------------------------------------------------------------------

def library_rows(texts):
    tokenizer = Tokenizer.from_file(vocabulary_path(TOKENIZER))
    start, out = 0, []
    for doc_id, text in sorted(texts, key=lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, t[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_word_encoder_equals_library():
    encoder = token_files.WordEncoder(open(vocabulary_path(TOKENIZER), encoding="utf-8").read())
    library = Tokenizer.from_file(vocabulary_path(TOKENIZER))
    texts = odd_texts() + ["<|endoftext|> x<|startoftext|>y", "it's  we'LL\u00a0a\u2003b\x1cc\x85d", "İ ΑΣ ΑΣ. ﬁ ẞ"]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_files_round_trip(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    files = token_files.write_tokens(spark, edge_docs(spark), vocabulary_path(TOKENIZER))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = token_files.read_tokens(spark, files).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) for r in rows), key=lambda r: r[1]) == library_rows(TEXTS)
    assert [f[1] for f in files] == sorted(f[1] for f in files) and len(files) > 1
    none = token_files.write_tokens(spark, no_docs(spark), vocabulary_path(TOKENIZER))
    assert token_files.read_tokens(spark, none).count() == 0


def test_token_query(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in read_table(spark, sf_dir, "documents").collect()]
    rows = QUERIES["op7_token_files"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == [r[:4] for r in library_rows(texts)]


# ---- archives ----------------------------------------------------------------------------

PAGES = [
    (1, "http://a/ b\n", "x" * 1200), (2, "http://a/c", "x" * 1200), (3, None, "x" * 999), (4, "u", "x" * 999), (5, "u", None),
    (6, "u", ""), (7, "u", "é\r\n\r\nWARC/1.1\r\n" * 5000), (8, "ü", "é\r\n\r\nWARC/1.1\r\n" * 5000), (2, "http://a/c", "x" * 1200),
    (None, "n", "x" * 1200), (None, None, None),
]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("record_type", __import__("pyspark").sql.functions.lit(1)).repartition(3)
    rows = archives.read_warcs(spark, archives.convert(spark, archives.write_arcs(spark, pages))).collect()
    assert len(rows) == len(PAGES)
    groups = defaultdict(list)
    for r in rows:
        groups[r.payload_digest, r.payload_bytes].append(r)
    for page_id, _, html in PAGES:
        body = (html or "").encode()
        group = groups[__import__("hashlib").sha1(body).hexdigest(), len(body)]
        assert page_id in [r.page_id for r in group]
        best = max((r.page_id for r in group if r.page_id is not None), default=None)
        if len(body) >= 1000:
            [response] = [r for r in group if r.record_type == "response"]
            assert response.page_id == best and response.refers_to is None
            assert all(r.refers_to == best for r in group if r.record_type == "revisit")
        else:
            assert {r.record_type for r in group} == {"response"} and {r.refers_to for r in group} == {None}
    assert len({r.record_id for r in rows}) == len(rows) and {r.date for r in rows} == {"2020-01-01T00:00:00Z"}
    assert {r.url for r in rows} >= {"http://a/%20b%0A", "about:blank", "ü"}
    none = archives.write_arcs(spark, pages.where("false"))
    assert archives.read_warcs(spark, archives.convert(spark, none)).count() == 0


def test_header_lines_by_version(tmp_path):
    for version in (1, 2):
        path = tmp_path / f"{version}.arc.gz"
        block = archives.arc_block(7, b"body")
        with open(path, "wb") as f:
            first = archives.squeezed(archives.version_block(version, "n.arc"))
            f.write(first)
            head = archives.arc_header(version, "http://x/", "2019", "text/html", len(block), "n.arc", len(first))
            f.write(archives.squeezed(head + block + b"\n"))
        with open(path, "rb") as f:
            [record] = archives.arc_records(f)
        assert (record.offset, record.url, record.date, record.payload) == (len(first), "http://x/", "2019", b"body")
        with pytest.raises(ValueError):
            archives.parse_arc(head[:-5] + b"99999\n" + block, version, 0)
    with pytest.raises(ValueError):
        archives.arc_version(b"filedesc://x 0.0.0.0 2019 text/plain 9\n3 0 x\nURL\n")
    assert archives.warc_date("2019") == "2019-01-01T00:00:00Z"
