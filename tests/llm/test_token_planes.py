import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linkflow.llm import queries, token_planes

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = "a b\tc\r\n\x0b\x0c\x1c\x85  　'sSÉé́ßΣ漢字1½²<|endoftext|>!&-_﻿‍"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ODD, max_size=40) | st.text(max_size=40))
def test_pieces_encode_as_whole_texts(text):
    text = text.encode("utf-8", "replace").decode()
    whole = Tokenizer.from_file(PATH) if not hasattr(test_pieces_encode_as_whole_texts, "t") else test_pieces_encode_as_whole_texts.t
    test_pieces_encode_as_whole_texts.t = whole
    enc = getattr(test_pieces_encode_as_whole_texts, "e", None) or token_planes.Encoder(PATH)
    test_pieces_encode_as_whole_texts.e = enc
    assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 65_536, 65_537])
def test_pack_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint64).astype("<u4")
    blob = token_planes.pack(ids, [None, 3], [n, 0], 4, 5, kind)
    for tail in (b"", b"\n"):
        index, got = token_planes.unpack(blob + tail)
        assert got.tolist() == ids.tolist() and index["doc_ids"] == [None, 3] and index["pid"] == 4


def expected(rows):
    t, out, start = Tokenizer.from_file(PATH), [], 0
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def test_edge_rows(spark):
    rows = [(5, None), (1, ""), (1, ""), (None, "x"), (3, "Long " * 50_000), (2, "same"), (2, "same"), (9, "Ünï <|endoftext|> it's")]
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], "doc_id long, text string, n_tokens int, start int")
    got = [tuple(r) for r in token_planes.digests(df, PATH).collect()]
    assert sorted(got, key=str) == expected(rows)
    assert token_planes.digests(df.limit(0), PATH).count() == 0


def test_small_shards_and_bit_planes(spark, tmp_path):
    rows = [(i, f"word{i} text") for i in range(50)]
    token_planes.write(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_path}/p", PATH, kind="bit", shard_ids=10)
    got = [(r.doc_id, r.n_tokens, r.ids_crc32) for r in token_planes.read(spark, f"{tmp_path}/p").collect()]
    assert sorted(got) == [(d, n, c) for d, _, n, c in sorted(expected(rows))]


def test_query_against_library(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in queries.op6_token_planes(spark, d).collect()), key=str) == expected(rows)
