import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marlstone.llm import token_files
from marlstone.llm.token_files import read_blocks, read_token_files, write_blocks, write_token_files
from marlstone.session import shared_dir
from tests.llm.helpers import table
from tests.llm.test_bpe import odd_texts


@pytest.mark.parametrize("n", [0, 1, 5, 127, 128, 129, 1000, 5000])
@pytest.mark.parametrize("top", [1, 2, 50_000, 2**32])
def test_blocks_give_the_ids_back(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype("u8")
    ids[::17] = 2**32 - 1
    data = write_blocks(ids)
    assert read_blocks(data, n).tolist() == ids.tolist()
    if n > 300:
        assert read_blocks(data, n, 100, 190).tolist() == ids[100:290].tolist()


def test_outliers_do_not_widen_a_block():
    ids = np.full(128, 7, "u8")
    narrow = len(write_blocks(ids))
    ids[5] = 2**31
    assert len(write_blocks(ids)) == narrow + 5


def test_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 4000)
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = odd_texts(150)
    rows = [(None if i == 7 else (i * 37) % 140, t, i) for i, t in enumerate(texts)]
    df = table(spark, rows, "doc_id long, text string, shard int")
    place = shared_dir(spark, "test-files")
    write_token_files(df, path, place)
    assert spark.read.parquet(place).select("shard").distinct().count() > 3
    found = read_token_files(spark, place).orderBy("start").collect()
    known = Tokenizer.from_file(path)
    expected = sorted((str(i), tuple(known.encode(t or "", add_special_tokens=False).ids + [0])) for i, t, _ in rows)
    assert sorted((str(r.id), tuple(r.ids)) for r in found) == expected
    assert [r.id for r in found] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in found:
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        start += len(r.ids)
    digests = {(r.start, r.ids_crc32) for r in read_token_files(spark, place, digest=True).collect()}
    assert digests == {(r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in found}


def test_empty_table(spark):
    place = shared_dir(spark, "test-files")
    write_token_files(table(spark, [(1, "a")]).where(F.lit(False)), public_tokenizers.path("byte_bpe_50k.json"), place)
    assert read_token_files(spark, place, digest=True).collect() == []
