"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are cut at safe boundaries into parts of at most ``PART`` bytes, the parts are
encoded in batches of about ``BATCH`` bytes each whatever the number of rows, and a
text's count is the sum over its parts.

A boundary is safe where the vocabulary's splitting pattern ends a token in any case:
before a single space or line feed between two characters that are not white space.
SentencePiece merges across such places, so its texts stay whole.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = 1 << 16
BATCH = 1 << 20
_SAFE = regex.compile(r"(?<=\S)[ \n](?=\S)")
#: The published splitting pattern of byte-level vocabularies (fixed value).
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte, and the byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranked(path: str):
    """A byte-level BPE file as an encoding by ranks, or None if it isn't one whose ids follow its merges.

    Both libraries then give the same ids; the one that works on ranks takes a quarter of the time.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    if model["type"] != "BPE" or not plain or spec.get("normalizer") or model.get("dropout") or model.get("ignore_merges"):
        return None
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", [])):
        return None
    vocabulary, letters = model["vocab"], byte_alphabet()
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(merged) or any(c not in vocabulary for c in letters):
        return None
    ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in added}
    return tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens=added)


@functools.cache
def encoder(path: str) -> tuple[Callable[[list[str]], list[list[int]]], bool]:
    """A batch encoder without begin, end or added tokens, and whether texts may be cut for it."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: model.encode(texts, num_threads=1), False
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def library(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    ranked = _ranked(path)
    if ranked is None:
        return library, False

    def by_ranks(texts: list[str]) -> list[list[int]]:
        out = []
        for text in texts:
            try:
                out.append(ranked.encode(text, allowed_special="all"))
            except BaseException as error:  # the pattern engine gives up on some endless runs of one character
                if isinstance(error, (KeyboardInterrupt, SystemExit)):
                    raise
                out.extend(library([text]))
        return out

    return by_ranks, True


def parts(text: str, size: int = PART) -> Iterator[str]:
    """Parts of about ``size`` characters, cut at safe boundaries; joined they are the text."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def _encoded(texts: list[str], path: str) -> Iterator[tuple[int, list[int]]]:
    """The number of a text and the ids of its next part, in order, encoded in batches of about ``BATCH``."""
    encode, cut = encoder(path)
    batch, owner, size = [], [], 0
    for i, text in enumerate(texts):
        for part in parts(text) if cut else (text,):
            batch.append(part)
            owner.append(i)
            size += len(part)
            if size >= BATCH:
                yield from zip(owner, encode(batch), strict=True)
                batch, owner, size = [], [], 0
    yield from zip(owner, encode(batch), strict=True)


def counts(texts: list[str], path: str) -> list[int]:
    """The number of tokens of each text."""
    out = [0] * len(texts)
    for i, ids in _encoded(texts, path):
        out[i] += len(ids)
    return out


def token_ids(texts: list[str], path: str) -> list[np.ndarray]:
    """The ids of each text."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for i, ids in _encoded(texts, path):
        out[i].append(np.array(ids, np.uint32))
    return [np.concatenate(x) if len(x) != 1 else x[0] for x in out]


def count_tokens(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df`` without ``text`` but with its number of tokens in ``out``; a null or empty text has none.

    ``path`` is a ``.json`` file of the tokenizers library or a ``.model`` file of
    sentencepiece. Nothing is shuffled; every text is encoded whole, and only lengths
    leave Python. Other columns, whatever their names, and repeated rows stay; a column
    that is already named ``out`` is replaced.
    """
    others = [c for c in df.columns if c not in (text, out)]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_in in rows:
            n = counts([t or "" for t in rows_in.column(0).to_pylist()], path)
            columns = [rows_in.column(i + 1) for i in range(len(others))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64())], [*others, out])

    schema = df.select(*others).withColumn(out, F.lit(0).cast("long")).schema
    return df.select(F.col(text), *others).mapInArrow(batches, schema)
