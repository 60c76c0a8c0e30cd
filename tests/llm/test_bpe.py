"""Speculative byte-level BPE against the library."""

import hashlib
import os
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from genoloom.llm import bpe, queries
from genoloom.llm.common import ship

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.SpeculativeBPE(PATH)


def odd_texts(seed, count):
    rng = random.Random(seed)
    letters = "abeinorst  '\n\t.,!?1234567890\x85\xa0 éñ日本😀\x1c\x00<|>́ß\U0001c89a"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(count)]
    out += ["x" * 30_000, "ab" * 9_000, " " * 500, "a\n\n\nb  c\t\td ", "<|endoftext|> a<|endoftext|><|endoftext|>b  ", "'s 'S don't I'LL we'll'", "\xa0  a", "a \xa0 b"]
    out.append("".join(chr(rng.choice([rng.randrange(32, 0x2FFF), rng.randrange(0x1F300, 0x1FAFF)])) for _ in range(4000)))
    return out


def test_ids_and_text_are_the_librarys(own, library):
    texts = odd_texts(1, 4000)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [x.tolist() for x in own.encode(texts)]
    assert got == want
    assert 0 < own.merged < own.proposed  # some words pass the check, some need merging
    assert [own.decode(x) for x in got] == [library.decode(x, skip_special_tokens=False) for x in want] == texts


def test_decode_of_any_ids(own, library):
    rng = random.Random(2)
    for _ in range(500):
        ids = [rng.randrange(50_257) for _ in range(rng.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_check_of_pairs_is_exact(own):
    """For words of two tokens, a pair stays apart exactly if merging the bytes gives the pair."""
    import numpy as np

    rng = random.Random(3)
    pairs = [(rng.randrange(50_256), rng.randrange(50_256)) for _ in range(4000)]
    texts = [b"zqzq", b"aaaaaaaaaaaaaa", b" the the", b"==========", b"        ", b"000000000"]
    pairs += [(own.merge(t[:k])[-1], own.merge(t[k:])[0]) for t in texts for k in range(1, len(t))]
    a, b = np.array(pairs).T
    want = [own.merge(own.bytes_of[x] + own.bytes_of[y]) == [x, y] for x, y in pairs]
    assert own.stay_apart(a, b).tolist() == want and 0 < sum(want) < len(want)


def test_remembered_tables_may_be_small(library):
    small = bpe.SpeculativeBPE(PATH, remembered=50)
    texts = odd_texts(4, 300)
    assert [x.tolist() for x in small.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.SpeculativeBPE(public_tokenizers.path("word_bpe_49k.json"))


def test_query_rows(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for r in docs:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(tuple(r) for r in queries.op13_bpe(spark, SF).collect()) == sorted(want)


def test_odd_rows(spark, library):
    ship(spark)
    texts = [None, "", " ", "a", "a", "<|endoftext|>", "x" * 20_000]
    df = spark.createDataFrame([(None if k == 3 else k // 2, t, k, "y") for k, t in enumerate(texts)], "doc_id int, text string, ids int, `a.b` string")
    out = bpe.encode_documents(df, PATH)
    got = sorted(((r.doc_id is not None, r.doc_id or 0), r.ids) for r in out.collect())
    want = sorted(((k != 3, 0 if k == 3 else k // 2), library.encode(t or "", add_special_tokens=False).ids) for k, t in enumerate(texts))
    assert got == want and out.schema["doc_id"].dataType.simpleString() == "int"
    back = out.select(bpe.decoded("ids", PATH).alias("t")).collect()
    assert sorted(r.t for r in back) == sorted(t or "" for t in texts)
    assert bpe.encode_documents(df.limit(0), PATH).collect() == []
