import json
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from linkflow.llm import quality
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard import brute as near
from tests.llm.test_mixing import plain

DIR = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").select("item_id", "text").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mix", "token_ids"]
    before = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DIR)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "token_ids":
            break
        assert docs.columns == corpus_pipeline.DOCUMENT
        after = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
        ids, pairs = sorted(r[0] for r in after), [r[:2] for r in before]
        if name == "quality":
            net = quality.fit(spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet"), usable=corpus_pipeline.id_crc() % 3 != 1)
            want = [d for d, t in pairs if net.score(quality.encode(t), np.array([0]))[0][0] >= 0.5]
        elif name == "near_duplicates":
            want = {c for _, _, c in near(pairs, 5, 80)}
        elif name == "decontamination":
            want = [r[0] for r in contaminated(pairs, items) if not r[5]]
        else:
            want = [d for (d, _), n in plain([(d, s) for d, _, s in before]).items() for _ in range(n)]
        assert ids == sorted(want) and 0 < len(ids)
        before = after
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for d, text, _ in sorted(before):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, docs.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == sorted(want)


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, DIR)
    assert got.count() > 0 and json.dumps(got.columns) == json.dumps(["doc_id", "start", "n_tokens", "ids_crc32"])
