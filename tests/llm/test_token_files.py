"""Operator 12: the code of boundaries, the encoder against the library, files against plain lists."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from voltframe.llm import eliasfano, queries, tokenfiles

MODEL = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(MODEL)


def test_code_returns_every_value():
    rng = random.Random(2)
    for n in (0, 1, 2, 63, 64, 65, 129, 5000):
        for greatest in (1, 100, 10 ** 6, 2 ** 63):
            values = np.sort(np.array([rng.randrange(greatest) for _ in range(n)], np.uint64))
            code = eliasfano.Sequence(eliasfano.encode(values))
            assert len(code) == n and code[np.arange(n)].tolist() == values.tolist()
            assert code[np.arange(n)[::-3]].tolist() == values[::-3].tolist()
    with pytest.raises(IndexError):
        code[[n]]


def test_code_with_gaps_uses_stored_places():
    values = np.r_[np.arange(1000), 10 ** 7 + np.arange(3000), 2 * 10 ** 7 + np.arange(5)].astype(np.uint64)
    many = np.r_[np.zeros(20000), np.arange(0, 64 * 10 ** 6, 10 ** 6)].astype(np.uint64)
    for v in (values, np.sort(many)):
        code = eliasfano.Sequence(eliasfano.encode(v))
        assert code[np.arange(len(v))].tolist() == v.tolist()
    assert len(eliasfano.Sequence(eliasfano.encode(np.sort(many))).far) > 0


def test_code_is_near_minimal():
    rng = np.random.default_rng(3)
    values = np.cumsum(rng.integers(0, 2000, 100_000)).astype(np.uint64)
    bits = 8 * len(eliasfano.encode(values)) / len(values)
    assert bits < np.log2(float(values[-1]) / len(values)) + 3


def test_encoder_equals_library_on_odd_texts(library):
    enc, rng = tokenfiles.encoder(tokenfiles.read_model(MODEL)), random.Random(5)
    signs = ["a", "B", "é", "ß", "Ł", "日", "İ", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", " ", "　", " ", "'s", "'LL", "'", "1", "²", "½", "×", ".",
             "$$", "_", "<|endoftext|>", "\x00", "́", " ́", "\U0001f642", "ǅ", "ª", "µ"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(14))) for _ in range(4000)]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x2FFFF), 32, 10])) for _ in range(8)) for _ in range(800)]
    for t in texts:
        assert np.frombuffer(enc.encode(t), "<u2").tolist() == library.encode(t, add_special_tokens=False).ids, t


def check(spark, library, rows, folder, file_ids=tokenfiles.FILE_IDS, read_ids=tokenfiles.READ_IDS, flush=tokenfiles.FLUSH_BYTES):
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, ids int")
    manifest = tokenfiles.write_tokens(docs, MODEL, 2, str(folder), file_ids)
    got = tokenfiles.read_tokens(manifest, read_ids, flush).orderBy("place").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    at, found = 0, []
    for place, r in enumerate(got):
        ids = np.frombuffer(r.ids, "<u4")
        assert (r.place, r.start) == (place, at) and ids[-1] == 2
        at += len(ids)
        found.append((r.doc_id, ids[:-1].tolist()))
    want = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    return manifest.collect()


def test_files_hold_every_document(spark, library, tmp_path, rows):
    odd = [(r[0], r[1], "x", 1) for r in rows] + [(None, "no id", "x", 1), (None, None, "x", 1), (-5, "less", "x", 1), (4, "twice", "x", 1), (-(2 ** 63), "least", "x", 1),
                                                  (2 ** 63 - 1, "most", "x", 1), (4, "twice", "x", 1)]
    manifest = check(spark, library, odd, tmp_path, 500, 700, 3000)
    assert len(manifest) > 8 and sum(r.n_docs for r in manifest) == len(odd)
    one = max(manifest, key=lambda r: r.n_docs)
    file = tokenfiles.TokenFile(one.file)
    for k in range(file.n_docs):
        assert file.document(k)[-1] == 2
    assert sum(len(file.document(k)) for k in range(file.n_docs)) == one.n_ids


def test_empty_table_has_no_files(spark, library, tmp_path):
    assert check(spark, library, [], tmp_path) == []


def test_drafts_do_not_stay(spark, library, tmp_path):
    check(spark, library, [(i, f"text {i}", "x", 1) for i in range(50)], tmp_path)
    assert not [p.name for p in tmp_path.iterdir() if p.name.startswith("_draft")]


def test_doc_id_must_be_an_integer(spark):
    with pytest.raises(TypeError):
        tokenfiles.write_tokens(spark.createDataFrame([("a", "b")], "doc_id string, text string"), MODEL, 2)


def test_query_equals_plain_list(spark, library):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op12_token_files(spark, sf).collect()}
    at, want = 0, {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        want[r.doc_id] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got == want
