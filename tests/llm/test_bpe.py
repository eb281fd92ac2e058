import base64
import hashlib

import edges
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from folioflow.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = ["", " ", "a" * 3000, "  \n\n\t x", "don't we'll 123 4567", "é中文字😀👩‍👩‍👧́", "\x00\x1c\x85  ", "=-" * 900, "Ünïcode ſ İ ß", "퟿�"]


@pytest.fixture(scope="module")
def theirs():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_rank_encoder(theirs):
    own = bpe.ByteBpe(PATH, PATTERN)
    texts = TEXTS + ["a" + chr(c) + "1 " + chr(c) + chr(c) for c in range(0x3000) if c not in range(0xD800, 0xE000)]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == theirs.encode_ordinary(text), text


def test_offsets_cover_the_text(theirs):
    own = bpe.ByteBpe(PATH, PATTERN)
    for text, ids in zip(TEXTS, own.encode(TEXTS)):
        starts, ends = own.offsets(text, ids)
        for token, a, b in zip(ids.tolist(), starts.tolist(), ends.tolist()):
            assert theirs.decode_single_token_bytes(token) in text[a:b].encode()
        assert (ends.tolist() or [0])[-1] == len(text)


def test_round_trip_of_edge_rows(spark, theirs):
    got = edges.rows(bpe.round_trip(edges.clashing(spark), PATH, PATTERN))
    want = []
    for doc_id, text, *_ in edges.ROWS:
        ids = theirs.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        want.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_encode_then_decode_gives_the_texts(spark):
    docs = edges.docs(spark)
    back = bpe.decode(bpe.encode(docs, ["doc_id"], PATH, PATTERN), PATH, PATTERN)
    assert edges.rows(back) == sorted(((d, t or "") for d, t, *_ in edges.ROWS), key=repr)


def test_split_characters_and_no_ids(spark):
    own = bpe.ByteBpe(PATH, PATTERN)
    ids = own.encode(["𓂀"])[0]
    assert len(ids) > 1 and own.decode(ids) == "𓂀".encode()
    rows = spark.createDataFrame([(1, ids[:1].tolist()), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert edges.rows(bpe.decode(rows, PATH, PATTERN)) == [(1, "�"), (2, ""), (3, "")]
    assert bpe.round_trip(edges.empty(spark), PATH, PATTERN).collect() == []
