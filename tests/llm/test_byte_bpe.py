import hashlib

import numpy as np
import public_tokenizers as P
import pytest

from cardwatch.llm import byte_bpe

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
ODD = [None, "", " ", "Hello  world\n\n\tx  ", "it's 12 o'clock…", "ñandú été über", "a" * 3000, " \n" * 500 + "x",
       "日本語 テキスト 123", "<|endoftext|> is text", "it's    x", "word, 12 and more. " * 400]


@pytest.mark.parametrize("size", [1, 7, 64])
def test_parts_do_not_change_ids(size):
    enc = byte_bpe.encoder(RANKS, P.PATTERN)
    for t in ODD:
        whole = np.asarray(enc.encode_ordinary(t or ""), "<u4").tobytes()
        assert byte_bpe.encode_text(enc, t or "", size) == whole
        assert byte_bpe.decode_ids(enc, whole, size) == (t or "").encode()
        assert "".join(byte_bpe.parts(t or "", size)) == (t or "")


def test_encode_decode_rows(spark, docs_of):
    docs = docs_of(*ODD, (None, "no id", None, None, None), (3, "same id again", "en", "s", 1))
    coded = byte_bpe.encode(docs, RANKS, P.PATTERN)
    got = byte_bpe.decode(coded, RANKS, P.PATTERN).collect()
    assert len(got) == len(ODD) + 2 and coded.columns == [*docs.columns, "ids"]
    for r in got:
        assert bytes(r.decoded) == (r.text or "").encode()


def test_clashing_name_and_empty_table(spark, docs_of):
    from pyspark.sql import functions as F

    docs = docs_of("one two").withColumn("ids", F.lit(1)).withColumn("decoded", F.lit("x"))
    r = byte_bpe.decode(byte_bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert len(r) == 1 and bytes(r[0].decoded) == b"one two"
    assert byte_bpe.encode(docs.filter("doc_id < 0"), RANKS, P.PATTERN).collect() == []


def test_query(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL

    enc = byte_bpe.encoder(RANKS, P.PATTERN)
    want = {}
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        ids = enc.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256((r.text or "").encode()).hexdigest())
    got = {r[0]: tuple(r[1:]) for r in E.queries()["op7_byte_bpe"](spark, SF_SMALL).collect()}
    assert got == want
