"""Encoding of a corpus with a public byte-level BPE tokenizer.

Most texts are encoded where they are read (one narrow Arrow pass).  A text
longer than ``leaf_chars`` is encoded by *tree concatenation*: it is cut into
leaves, the leaves are spread over all tasks and encoded on their own, and
neighbours are joined pairwise up a binary tree.  A join re-encodes a window
around the seam and doubles it until both edges are proven:

* an edge is *certain* where the pre-tokenizer splits whatever stands around
  it (a word or number ends there);
* an edge inside one run of letters, digits, punctuation or white space
  counts once the window's outermost token equals the token that is already
  there.  All neighbouring tokens then occur next to each other in a valid
  encoding, and a BPE sequence whose neighbours are all valid pairs is the
  encoding of its text.

Token ids give their bytes back, so only ids travel to the joins.

Defined results: null and empty texts give an empty list; blank text is
encoded like any other; special-token strings are ordinary text; repeated
rows stay repeated; a null id is kept; other columns are ignored.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.sources.stages import spread

#: Vocabulary file of the tokenizer; the folder is the same on all workers.
BYTE_BPE_50K = "/opt/tokenizers/byte_bpe_50k.json"

#: Texts longer than this many characters are encoded as a tree of leaves.
LEAF_CHARS = 8192

#: Characters handed to the tokenizer at once; bounds the memory of a task.
CALL_CHARS = 1 << 20

_APOSTROPHES = {"'"}
_PLAIN_SPACE = {" ", "\n", "\t", "\r", "\x0b", "\x0c", " ", " ", " ", "　"}


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    """The tokenizer of this process; one task has one core, so it starts no threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """Bytes of every token id; the byte alphabet maps the printable Latin-1 characters to themselves, the rest upwards of 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    back = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    tokenizer = load_tokenizer(path)
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    return [bytes(back.get(c, 0) for c in tokenizer.id_to_token(i) or "") for i in range(size)]


def encode_texts(texts: list[str], path: str = BYTE_BPE_50K) -> list[list[int]]:
    """Token ids of each text as a whole."""
    tokenizer, out, call, chars = load_tokenizer(path), [], [], 0
    for text in texts:
        call.append(text)
        chars += len(text)
        if chars >= CALL_CHARS:
            out += [e.ids for e in tokenizer.encode_batch_fast(call, add_special_tokens=False)]
            call, chars = [], 0
    return out + [e.ids for e in tokenizer.encode_batch_fast(call, add_special_tokens=False)] if call else out


def _kind(c: str) -> str:
    if c in _PLAIN_SPACE:
        return "space"
    category = unicodedata.category(c)
    if category[0] in "LN":
        return category[0]
    return "P" if category[0] in "PS" and not c.isspace() else "?"


def _edge(tokens: list[int], k: int, pieces: list[bytes]) -> str:
    """``certain``, ``run`` or nothing: how far the boundary before tokens[k] can be trusted."""
    ahead = b"".join(pieces[t] for t in tokens[k : k + 4])
    if not ahead or 0x80 <= ahead[0] < 0xC0:
        return ""
    before = b"".join(pieces[t] for t in tokens[max(0, k - 12) : k])[-16:].decode("utf-8", "ignore")[-2:]
    after = ahead[:4].decode("utf-8", "ignore")[:1]
    if len(before) < 2 or not after or "?" in (kinds := (_kind(before[-1]), _kind(after))):
        return ""
    last, first = kinds
    if last != "space" and (first == "space" or last != first and (last, first) != ("P", "L")):
        return "certain"
    if last == first and after not in _APOSTROPHES and not _APOSTROPHES & set(before):
        return "run"
    return ""


def join_encodings(left: list[int], right: list[int], encode: Callable[[str], list[int]], pieces: list[bytes], window: int = 8) -> list[int]:
    """The encoding of the text of ``left`` followed by that of ``right``, exactly."""
    if not left or not right:
        return left or right
    while True:
        a, b = max(0, len(left) - window), min(len(right), window)
        while a > 0 and not (at_left := _edge(left, a, pieces)):
            a -= 1
        while b < len(right) and not (at_right := _edge(right, b, pieces)):
            b += 1
        middle = encode(b"".join(pieces[t] for t in [*left[a:], *right[:b]]).decode("utf-8"))
        if (a == 0 or at_left == "certain" or middle[0] == left[a]) and (b == len(right) or at_right == "certain" or middle[-1] == right[b - 1]):
            return [*left[:a], *middle, *right[b:]]
        window *= 2


def tree_join(leaves: list[list[int]], encode: Callable[[str], list[int]], pieces: list[bytes]) -> list[int]:
    """Join neighbouring leaves level by level."""
    while len(leaves) > 1:
        joined = [join_encodings(leaves[i], leaves[i + 1], encode, pieces) for i in range(0, len(leaves) - 1, 2)]
        leaves = joined + leaves[len(leaves) - len(leaves) % 2 :]
    return leaves[0] if leaves else []


def _list_array(rows: list[list[int]]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.fromiter((t for r in rows for t in r), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _leaf_bounds(n: int, leaf_chars: int) -> list[int]:
    """Bounds of the leaves that halving gives until none is longer than ``leaf_chars``."""
    parts = 1
    while n > parts * leaf_chars:
        parts *= 2
    return [n * i // parts for i in range(parts + 1)]


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = BYTE_BPE_50K, leaf_chars: int = LEAF_CHARS, sizes_only: bool = False) -> DataFrame:
    """(id, ids) of every row, or (id, size) with ``sizes_only``.

    The two branches (texts up to and beyond ``leaf_chars``) read the texts once each; decoding them twice costs
    little beside encoding them, and short texts need no shuffle at all.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    value = "size int" if sizes_only else "ids array<int>"
    rows = spread(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    is_long = F.length("text") > leaf_chars

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = encode_texts(b.column(1).to_pylist(), path)
            out = pa.array([len(x) for x in ids], pa.int32()) if sizes_only else _list_array(ids)
            yield pa.RecordBatch.from_arrays([b.column(0), out], names=["id", "size" if sizes_only else "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in enumerate(b.column(2).to_pylist()):
                bounds = _leaf_bounds(len(text), leaf_chars)
                n = len(bounds) - 1
                take = pa.array(np.full(n, i))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), b.column(1).take(take), pa.array(np.arange(n), pa.int32()), pa.array([text[bounds[k] : bounds[k + 1]] for k in range(n)])],
                    names=["id", "mark", "leaf", "text"],
                )

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), _list_array(encode_texts(b.column(3).to_pylist(), path))], names=["id", "mark", "leaf", "ids"])

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("leaf", kind="stable")
        copies = int((group["leaf"] == 0).sum())
        leaves = [list(x) for x in group.drop_duplicates("leaf")["ids"]]
        pieces = token_bytes(path)
        ids = tree_join(leaves, lambda t: encode_texts([t], path)[0], pieces)
        first = group["id"].iloc[0]
        return pd.DataFrame({"id": [first] * copies, "size" if sizes_only else "ids": [len(ids) if sizes_only else ids] * copies})

    short = rows.where(~is_long).mapInArrow(whole, f"id {id_type}, {value}")
    leaves = (
        rows.where(is_long)
        .select("id", F.xxhash64("text").alias("mark"), "text")
        .mapInArrow(cut, f"id {id_type}, mark long, leaf int, text string")
        .repartition("id", "mark", "leaf")
        .mapInArrow(encode_leaves, f"id {id_type}, mark long, leaf int, ids array<int>")
    )
    long = leaves.groupBy("id", "mark").applyInPandas(joined, f"id {id_type}, {value}")
    return short.unionByName(long).withColumnRenamed("id", id_col)
