import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from chromaloom.llm import tokenize as t

REFERENCE = "/opt/tokenizers/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(REFERENCE)
    tokenizer.encode_special_tokens = True
    return lambda texts: [x.ids for x in tokenizer.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def encoded(texts):
    own, out = t.encoder(t.VOCABULARY), []
    for data, offsets in t.chunks(pa.array(texts, pa.string())):
        ids, ends = own.encode(data, offsets)
        assert np.diff(ends).tolist() == own.count(data, offsets).tolist()
        out += [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
    return out


def test_random_texts(reference):
    r = random.Random(5)
    pool = [*"ab Z9 '’s t\n\n\r\t\x85\x1c!?.,-中文カёжé1٣²½́ा🙂|<>_", "　", " ", "\xa0", "‍", "'s", "'re", " 's", "<|endoftext|>", "  \n", " \n x", "don't"]
    texts = ["".join(r.choices(pool, k=r.randint(0, 60))) for _ in range(6000)] + ["", None, " ", "\n"]
    assert encoded(texts) == reference(texts)


def test_every_character_between_letters(reference):
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}'s" for c in range(1, 0x3400) if not 0xD800 <= c < 0xE000]
    assert encoded(texts) == reference(texts)


def test_round_trip_and_cuts():
    own = t.encoder(t.VOCABULARY)
    text = "The slice's count — 12,345 reads　at chr1:10-20.\n\n" * 3
    data = np.frombuffer(text.encode(), np.uint8)
    cuts = np.flatnonzero(own.cuts(data))
    whole = own._bpe.encode_ordinary(text)
    parts = [own._bpe.encode_ordinary(x.tobytes().decode()) for x in np.split(data, cuts)]
    assert sum(parts, []) == whole and own._bpe.decode(whole) == text and len(cuts) > 10


def test_small_chunks_and_long_texts(reference, monkeypatch):
    monkeypatch.setattr(t, "CHUNK_BYTES", 50)
    texts = ["word " * 40_000, None, "", "x" * 3000, " ", *["ab c"] * 30]
    assert encoded(texts) == reference(texts)
    assert encoded([]) == []


def test_queries(spark, reference):
    rows = [(1, "Hello world", 5), (2, None, 5), (3, "", 5), (4, "  ", 5), (1, "Hello world", 5), (None, "x", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = sorted(((r.doc_id, r.ids) for r in t.encode(df, "doc_id", "text").collect()), key=str)
    assert out == sorted(zip([r[0] for r in rows], reference([r[1] for r in rows])), key=str)
    assert sorted(str(r.n_tokens) for r in t.count_tokens(df, "doc_id", "text").collect()) == sorted(str(len(x)) for _, x in out)
    assert t.encode(df.limit(0), "doc_id", "text").count() == 0
