import random
import zlib

import numpy as np
import pytest

from ripplelog.llm import records as R
from ripplelog.llm.catalog import tokenizer_path
from ripplelog.session import workspace


def whole(texts):
    """Ids of whole texts, straight from the library."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_parts_are_coded_as_the_whole_text_is():
    rng = random.Random(2)
    marks = [" ", "\n", ".", ",", "a", "Be", "é", "1", "'s", "\t", "\xa0", "\x1d", "　", "<|endoftext|>", "漢", "..."]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    encode = R.Encoder(tokenizer_path(), most=500)
    for a in range(0, len(texts), 50):
        some = texts[a : a + 50]
        for text, ids, got in zip(some, whole(some), encode.many(some)):
            assert np.frombuffer(got, "<u2").tolist() == ids, repr(text)


def test_the_string_of_an_added_token_is_that_token():
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "<|endoftext|", "a  <|endoftext|>\t"]
    got = [np.frombuffer(x, "<u2").tolist() for x in R.Encoder(tokenizer_path()).many(texts)]
    assert got == whole(texts) and got[0] == [64, 220, 50256, 275]


def test_table_counts_and_checks(docs, prose):
    texts = [prose(i, i % 50) for i in range(150)] + [None, ""]
    got = {r.id: r for r in R.token_table(docs(texts), tokenizer_path(), files=7).collect()}
    start = 0
    for i, ids in enumerate(whole([t or "" for t in texts])):
        ids = np.array([*ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens) == (start, len(ids))
        assert got[i].ids_crc32 == zlib.crc32(ids.tobytes())
        start += len(ids)


def test_shuffled_reads_and_damage(spark, docs, prose):
    folder = workspace(spark, "records")
    manifest = R.write_records(docs([prose(i, 9) for i in range(60)]), folder, tokenizer_path(), files=2)
    ordered = R.read_records(spark, folder, manifest).collect()
    mixed = R.read_records(spark, folder, manifest, order="shuffled", seed=4).collect()
    assert sorted(map(tuple, mixed)) == sorted(map(tuple, ordered))
    of_part = lambda rows: [r.frame for r in rows if r.part == ordered[0].part]
    assert of_part(ordered) == sorted(of_part(ordered)) != of_part(mixed)
    name = manifest.first().name
    path = f"{folder.removeprefix('file:')}/{name}.rec"
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        R.read_records(spark, folder, manifest).count()


def test_odd_rows(odd):
    got = R.token_table(odd, tokenizer_path(), files=3).collect()
    assert len(got) == odd.count()
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert got and sorted(got, key=lambda r: r.start)[0].id is None
    assert R.token_table(odd.limit(0), tokenizer_path(), files=3).collect() == []
