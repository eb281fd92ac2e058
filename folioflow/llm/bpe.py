"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file (base64 bytes and rank per line) becomes a BPE model whose alphabet is one character per
byte; the merges are all splits of a token into two tokens, by the rank of the token, so the library
merges what a rank-driven encoder merges. The pattern cuts a text into pieces that are encoded apart.
Offsets come from the byte-to-character mapping: a token covers as many bytes as it has characters, so
running sums give byte offsets, and the lead bytes before them the code points. Decoding reverses the
byte table; a character split over tokens comes back whole once its bytes are joined.

Edge cases: null text is empty and has no tokens; unknown ids raise; repeated rows, null ids and extra
columns are carried as they are; an empty table gives an empty table. The rank file is named by path,
which every executor can read.
"""

from __future__ import annotations

import base64
import hashlib
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from folioflow.llm import common as C

ENCODED = "ids array<int>, starts array<int>, ends array<int>"
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"
# Encoded pieces a worker keeps before it starts anew; no result depends on it.
PIECES = 500_000


def byte_alphabet() -> list[str]:
    """One visible character per byte: printable Latin-1 as itself, the rest from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


@lru_cache(maxsize=2)
def ranks(path: str) -> tuple[bytes, ...]:
    """Token bytes by id."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    out = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return tuple(out[i] for i in range(len(out)))


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel work
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokens = ranks(path)
        alphabet = byte_alphabet()
        known = set(self.tokens)
        names = ["".join(alphabet[b] for b in token) for token in self.tokens]
        merges = []
        for token, name in zip(self.tokens, names):
            merges += [(name[:i], name[i:]) for i in range(1, len(token)) if token[:i] in known and token[i:] in known]
        vocabulary = {name: i for i, name in enumerate(names)}
        # A piece that is a token is that token, whatever the merges would make of it.
        self.tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        # The byte table in reverse: a token's characters are its bytes, here all tokens in one run.
        back = {char: byte for byte, char in enumerate(alphabet)}
        self.flat = np.frombuffer(bytes([back[char] for name in names for char in name]), np.uint8)
        self.places = np.cumsum(self.lengths) - self.lengths

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids per text. Pieces recur, so each is encoded once per `PIECES` kept ones."""
        cut = [self.pieces.findall(text) for text in texts]
        if len(self.known) > PIECES:
            self.known.clear()
        known = self.known
        fresh = list(set().union(*cut).difference(known))
        for piece, found in zip(fresh, self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)):
            known[piece] = np.array(found.ids, "<u4").tobytes()
        return [np.frombuffer(b"".join(map(known.__getitem__, run)), "<u4") for run in cut]

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points that each token touches: [start, end); tokens of one split character share it."""
        lead = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
        upto = np.zeros(len(lead) + 1, np.int64)
        np.cumsum(lead, out=upto[1:])
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        inside = ~np.append(lead, True)[starts]  # the token starts within a character
        return upto[starts] - inside, upto[ends]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens: whatever characters were split are whole again."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.places[ids] - ends + sizes, sizes)].tobytes()


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def _batch(texts: list[str]):
    """Texts in runs that keep the encodings of a run small."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size > 1 << 18:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode(docs: DataFrame, carry: list[str], path: str, pattern: str) -> DataFrame:
    """`carry` with token ids and the code points [start, end) each token touches."""

    def compute(text: pa.Array) -> list:
        own = coder(path, pattern)
        ids, starts, ends = [], [], []
        for run in _batch(text.to_pylist()):
            for one, found in zip(run, own.encode(run)):
                start, end = own.offsets(one, found)
                ids.append(found.astype(np.int32))
                starts.append(start.astype(np.int32))
                ends.append(end.astype(np.int32))
        return [_lists(ids), _lists(starts), _lists(ends)]

    return C.per_row(docs, carry, compute, ENCODED)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    sizes = np.cumsum([0, *[len(a) for a in arrays]])
    flat = np.concatenate([np.zeros(0, np.int32), *arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int32()))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the text of its ids; bytes that are no UTF-8 become U+FFFD. Null ids are an empty text."""

    def step(batches):
        own = coder(path, pattern)
        for batch in batches:
            texts = [own.decode(np.array(ids or [], np.int64)).decode("utf-8", "replace") for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return C.map_arrow(encoded.select("doc_id", "ids"), step, "doc_id long, text string")


def tokenised(docs: DataFrame, carry: list[str], path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """`carry`, token ids if asked for, their number, and digests of the ids (little-endian uint32) and of the decoded bytes."""

    def compute(text: pa.Array) -> list:
        own = coder(path, pattern)
        lists, counts, ids, decoded = [], [], [], []
        for run in _batch(text.to_pylist()):
            for found in own.encode(run):
                if with_ids:
                    lists.append(found.astype(np.int32))
                counts.append(len(found))
                ids.append(hashlib.sha256(found.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(own.decode(found)).hexdigest())
        return [*([_lists(lists)] if with_ids else []), counts, ids, decoded]

    return C.per_row(docs, carry, compute, ("ids array<int>, " if with_ids else "") + DIGESTS)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, token count and both digests."""
    return tokenised(docs, ["doc_id"], path, pattern, with_ids=False)
