"""Byte-level BPE encoding and decoding by a sentencepiece model that is made from a vocabulary of ranks."""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import textkit
from lectern.llm.staging import map_rows, prepare, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Characters that are cut to pre-tokens at once, pre-tokens that a worker remembers at most, and characters of the longest that it remembers.
RUN, REMEMBERED, LONG = 1_000_000, 400_000, 48
#: Bytes of ids that are decoded to one batch.
DECODED = 4_000_000


def byte_letters() -> list[str]:
    """A letter for each byte: visible Latin ones stand for themselves, the others for code points from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + rest.index(b)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _message(field: int, content: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(content)) + content


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def read_ranks(content: bytes) -> dict[bytes, int]:
    """The lines of a vocabulary file: a token in base 64, and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


def model_of(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece model: pieces in order of rank, each scored by its negative rank, and an unknown piece at the end.

    Its kind is BPE; its normaliser is the identity, adds no space and keeps all.
    Sentencepiece merges the neighbours whose piece scores highest, the leftmost
    of equals, which is the least rank first. The fields are those of its public
    message format.
    """
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"no tokens for the bytes {missing}")
    letters = byte_letters()
    normal, unknown, bpe = 1, 2, 2
    pieces = [("".join(letters[b] for b in token), -float(rank), normal) for token, rank in sorted(ranks.items(), key=lambda x: x[1])]
    pieces.append(("<unk>", 0.0, unknown))
    out = b"".join(_message(1, _message(1, text.encode()) + b"\x15" + struct.pack("<f", score) + _number(3, kind)) for text, score, kind in pieces)
    trainer = _number(3, bpe)
    normalizer = _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return out + _message(2, trainer) + _message(3, normalizer)


class Coder:
    """Encodes texts to ids and decodes ids to bytes, by a model of `model_of` and the ids of its pieces."""

    def __init__(self, model: bytes, ids: list[int], pattern: str) -> None:
        import regex
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pattern = regex.compile(pattern)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        self.letters = dict(enumerate(byte_letters()))
        self.ids = ids
        self.tokens = {i: bytes(map(byte_of.__getitem__, self.pieces.id_to_piece(k))) for k, i in enumerate(ids)}
        self.whole = {token: i for i, token in self.tokens.items()}
        self.known: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of pre-tokens as little-endian words. One that is a token is that token, whether or not merges lead to it."""
        spelt = [t.encode() for t in new]
        merged = iter(self.pieces.encode([b.decode("latin-1").translate(self.letters) for b in spelt if b not in self.whole], num_threads=1))
        found = ([self.whole[b]] if b in self.whole else [self.ids[k] for k in next(merged)] for b in spelt)
        return {t: struct.pack(f"<{len(ids)}I", *ids) for t, ids in zip(new, found, strict=True)}

    def _pre_tokens(self, text: str) -> Iterator[list[str]]:
        """What the pattern matches, in runs of about ``RUN`` characters."""
        if len(text) <= RUN:
            yield self.pattern.findall(text)
            return
        run, size = [], 0
        for m in self.pattern.finditer(text):
            run.append(m.group())
            size += len(run[-1])
            if size >= RUN:
                yield run
                run, size = [], 0
        yield run

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian words, each match of the pattern by itself."""
        out = []
        for run in self._pre_tokens(text):
            ids = list(map(self.known.get, run))
            if None in ids:
                learnt = self._learn(list({t for t, i in zip(run, ids, strict=True) if i is None}))
                ids = [learnt[t] if i is None else i for t, i in zip(run, ids, strict=True)]
                if len(self.known) > REMEMBERED:
                    self.known.clear()
                self.known |= {t: i for t, i in learnt.items() if len(t) <= LONG}
            out.append(b"".join(ids))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


def coder_maker(spark: SparkSession, path: str | None = None, pattern: str | None = None) -> Callable[[], Coder]:
    """Gives what makes a coder on an executor, once a task. The vocabulary is read on the driver and sent as a model, whose size is the vocabulary's; ``path`` and ``pattern`` are those of the public vocabulary where they aren't given."""
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
        ranks = read_ranks(f.read())
    sent = spark.sparkContext.broadcast((model_of(ranks), sorted(ranks.values()), pattern or public_tokenizers.PATTERN))
    return lambda: Coder(*sent.value)


def encoded(docs: DataFrame, coder: Callable[[], Coder]) -> DataFrame:
    """``doc_id`` and ``ids``, the ids of the whole text as little-endian unsigned 32-bit words, of every row of ``docs``.

    Takes ``doc_id`` and ``text``; other columns are ignored. A null text is an
    empty one and has no ids. Repeated rows are encoded once each, and rows
    without an id too; an empty table gives no rows. A text is looked up in runs
    of pre-tokens, so a long one needs no more memory than itself and its ids.
    """
    prepare(docs.sparkSession)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = coder()
        for pdf in batches:
            for at, run in textkit.chunks(pdf["text"]):
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[at:at + len(run)].array, "ids": [own.encode(t) for t in run]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, encode, "doc_id long, ids binary")


def decoded(tokens: DataFrame, coder: Callable[[], Coder]) -> DataFrame:
    """The rows of `encoded` with ``bytes``, what their ids stand for; null ids are none."""
    prepare(tokens.sparkSession)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = coder()
        for pdf in batches:
            sizes = pdf["ids"].str.len().fillna(0).cumsum()
            for _, part in pdf.groupby(sizes // DECODED, sort=True):
                yield part.assign(bytes=[own.decode(x or b"") for x in part["ids"]])

    return map_rows(tokens.select("doc_id", "ids"), decode, "doc_id long, ids binary, bytes binary")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document."""
    coder = coder_maker(spark)
    both = decoded(encoded(table(spark, sf_dir, "documents"), coder), coder)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
