"""Encoding a corpus with a public tokenizer, and decoding (problem 7)."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Folder of the tokenizers' files; every function takes another path.
DEFAULT_FOLDER = "/opt/tokenizers"
#: Characters given to the tokenizer at once; bounds a worker's memory, not what is encoded.
CHUNK_CHARS = 2_000_000


def tokenizer_path(name: str = "byte_bpe_50k") -> str:
    """File of a public tokenizer: from the installed package if there is one, else from the default folder."""
    try:
        import public_tokenizers

        return public_tokenizers.path(f"{name}.json")
    except ImportError:
        return os.path.join(DEFAULT_FOLDER, f"{name}.json")


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer of a file, once a worker; strings of special tokens within a text count as ordinary text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = True
    return t


def shipped(spark: SparkSession, path: str) -> Callable[[], str]:
    """Gives the tokenizer's file to every executor that a task runs on; what is returned finds it there, or else at ``path``."""
    if os.path.isfile(path):
        spark.sparkContext.addFile(path)
    name = os.path.basename(path)

    def find() -> str:
        local = SparkFiles.get(name)
        return local if os.path.isfile(local) else path

    return find


def byte_characters() -> dict[str, int]:
    """Character to byte of byte-level vocabularies: printable Latin-1 characters stand for themselves, the other bytes in order for those from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _chunks(texts: list[str]):
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= CHUNK_CHARS):
            size += len(texts[end])
            end += 1
        yield texts[at:end]
        at = end


def encode(df: DataFrame, key: str, text: str, path: str | None = None, offsets: bool = False) -> DataFrame:
    """``key`` and ``ids`` (array of int) of each row, without special tokens; null and empty texts have the empty list.

    ``offsets`` adds ``starts`` and ``ends``: for each token the characters of the text it covers; tokens that split
    one character cover the same one. Texts of any length are encoded whole. One row for each row, in any order.
    """
    find = shipped(df.sparkSession, path or tokenizer_path())
    whole = pa.list_(pa.int32())

    def run(batches):
        tokenizer = load(find())
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            ids, starts, ends = [], [], []
            for part in _chunks(texts):
                if offsets:
                    for e in tokenizer.encode_batch(part, add_special_tokens=False):
                        ids.append(e.ids)
                        starts.append([o[0] for o in e.offsets])
                        ends.append([o[1] for o in e.offsets])
                else:
                    ids += [e.ids for e in tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            columns = [batch.column(0), pa.array(ids, whole)] + ([pa.array(starts, whole), pa.array(ends, whole)] if offsets else [])
            yield pa.RecordBatch.from_arrays(columns, names=[key, "ids", "starts", "ends"][: len(columns)])

    fields = [T.StructField(key, df.schema[key].dataType), *[T.StructField(n, T.ArrayType(T.IntegerType())) for n in (["ids", "starts", "ends"] if offsets else ["ids"])]]
    return df.select(F.col(key), F.col(text).cast("string").alias("__text")).mapInArrow(run, T.StructType(fields))


def decode(df: DataFrame, key: str, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``key`` and ``text`` of each id list: the tokens' characters are turned back to bytes by the byte table, and all bytes of a
    text are decoded together, so characters split over tokens come out whole; bytes that are no UTF-8 become U+FFFD.
    Null and empty lists give the empty text; ids outside the vocabulary are an error.
    """
    find = shipped(df.sparkSession, path or tokenizer_path())

    def run(batches):
        tokenizer = load(find())
        table = byte_characters()
        special = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
        known: dict[int, bytes] = {}

        def raw(i: int) -> bytes:
            if i not in known:
                token = tokenizer.id_to_token(i)
                if token is None:
                    raise ValueError(f"no token has the id {i}")
                known[i] = special.get(i) or bytes(table[c] for c in token)
            return known[i]

        for batch in batches:
            texts = [b"".join(raw(i) for i in row or []).decode("utf-8", "replace") for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return df.select(key, ids).mapInArrow(run, T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("text", T.StringType())]))
