"""Token counts with the whole-token shortcut, and token ids, for byte-level BPE files.

A byte-level BPE never merges across pre-tokens, and a space before a character
that is no white space always starts a pre-token, also at the end of a run of white
space: the run before it is then what is left of it, just as at the end of a text.
So every text falls apart at such spaces into pieces that can be encoded one by
one, whatever stands around them. Strings of special tokens are cut out before.
Pieces repeat, so each worker keeps a bounded table of pieces it has met.

Counting uses the shortcut: ``whole_tokens`` proves once, on the driver, which
vocabulary strings are one pre-token and encode alone as one token. Pre-tokens in
that table count as one; only the rest is merged, by the tokenizers library.

Null texts count as empty; nothing is cut or padded; special strings in a text
become special tokens, the library's default. A file whose added tokens take the
white space or word borders around them is not cut at them: texts that hold one
are given to the library whole. Columns with the names that counting adds
(n_bytes, n_tokens, over_limit) are replaced.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm.common import kept, small_batches, text_buffer, text_runs

#: The pre-tokeniser's pattern of byte-level BPE files (fixed value).
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces that a worker keeps for good, and as many young ones; about 200 bytes each. A full table is emptied.
CACHED_PIECES = 100_000
_SPLIT = regex.compile(PRE_TOKEN)
_RUN_OF_SPACE = re.compile(r" \s")
_PIECE = re.compile(r" (?=\S)")


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def whole_tokens(path: str) -> dict[str, int]:
    """Vocabulary strings, as text, that are one pre-token and encode alone as one token, with its id.

    Its size is bounded by the vocabulary's.
    """
    tokenizer = _tokenizer(path)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    ids = [i for s, i in tokenizer.get_vocab(with_added_tokens=False).items() if s not in special]
    texts = tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False)
    pairs = [(t, i) for t, i in zip(texts, ids, strict=True) if t and "�" not in t and _SPLIT.fullmatch(t) and len(_SPLIT.findall(t)) == 1]
    encoded = tokenizer.encode_batch_fast([t for t, _ in pairs], add_special_tokens=False)
    return {t: i for (t, i), e in zip(pairs, encoded, strict=True) if e.ids == [i]}


def ranked_merges(path: str):
    """An encoder by merge ranks for the file's vocabulary, where that gives the library's ids; else None.

    It does if ids follow the order of the merges: then a merge's rank is the id
    it makes. Both libraries' splits agree on the letters of ``_SHARED``.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocabulary = model["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [vocabulary.get("".join(m)) for m in merges]
    if None in made or made != sorted(made) or model.get("ignore_merges") or model.get("dropout"):
        return None
    # byte-level files write printable Latin-1 bytes as themselves and the others as U+0100 and on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    merged = set(made)
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if len(t) == 1 or i in merged}
    if not {bytes([b]) for b in range(256)} <= set(ranks):
        return None
    return tiktoken.Encoding("ranks", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary


class PieceTable:
    """What ``encode`` gives for pieces of texts, from a bounded table; held by one Python worker over its tasks.

    Pieces met once are kept among the young, and for good when met again, so that
    rare ones do not push out common ones.
    """

    def __init__(self, path: str, limit: int = CACHED_PIECES) -> None:
        self.tokenizer = _tokenizer(path)
        self.ranked = ranked_merges(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in added.items()}
        self.apart = not any(t.lstrip or t.rstrip or t.single_word for t in added.values())
        # of strings that begin alike the longest counts, as in the library
        self.specials = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.limit = limit
        self.known: dict[str, object] = {}
        self.young: dict[str, object] = {}

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text without special strings; the first one, which follows no space, has a key of its own."""
        found = text.split(" ") if _RUN_OF_SPACE.search(text) is None else _PIECE.split(text)
        found[0] = "\n" + found[0]  # no later piece begins with white space
        return found

    def values(self, texts: list[str]) -> list[list]:
        """For each text the values of its pieces and special tokens, in their order."""
        if self.specials is None or not any(map(self.specials.search, texts)):
            return self._values(texts)
        if not self.apart:
            held = [self.specials.search(t) is not None for t in texts]
            plain = iter(self._values([t for t, h in zip(texts, held, strict=True) if not h]))
            whole = iter(self.encode_whole([t for t, h in zip(texts, held, strict=True) if h]))
            return [[next(whole)] if h else next(plain) for h in held]
        parts = [self.specials.split(t) for t in texts]  # texts at even places, special strings at odd ones
        plain = iter(self._values([p for found in parts for p in found[::2]]))
        out: list[list] = []
        for found in parts:
            row: list = []
            for k, part in enumerate(found):
                row += [self.special_value(self.special[part])] if k % 2 else next(plain)
            out.append(row)
        return out

    def _values(self, texts: list[str]) -> list[list]:
        out: list[list] = []
        again: list[tuple[int, list[str]]] = []
        missing: dict[str, None] = {}
        get = self.known.get
        for k, text in enumerate(texts):
            pieces = self.pieces(text)
            found = list(map(get, pieces))
            if None in found:
                again.append((k, pieces))
                missing.update(dict.fromkeys([p for p, v in zip(pieces, found, strict=True) if v is None]))
            out.append(found)
        if missing:
            young = self.young
            met = {p: young.pop(p) for p in missing if p in young}
            fresh = [p for p in missing if p not in met]
            new = dict(zip(fresh, self.encode([p[1:] if p[0:1] == "\n" else " " + p for p in fresh]), strict=True))
            here = new | met
            for k, pieces in again:
                out[k] = [here[p] if v is None else v for p, v in zip(pieces, out[k], strict=True)]
            if len(young) + len(new) > self.limit:
                young.clear()
            young.update(new)
            if len(self.known) + len(met) > self.limit:
                self.known.clear()
            self.known.update(met)
        return out

    def special_value(self, token: int):
        return array("I", [token]).tobytes()

    def ids(self, pieces: list[str]) -> list[list[int]]:
        """Token ids of pieces without special strings."""
        if self.ranked is None:
            return self._library_ids(pieces)
        odd = [p for p in pieces if not _shared(p)]
        other = dict(zip(odd, self._library_ids(odd), strict=True))
        ranked = self.ranked
        return [other[p] if p in other else ranked(p) for p in pieces] if other else list(map(ranked, pieces))

    def _library_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def encode(self, pieces: list[str]) -> list:
        return [array("I", i).tobytes() for i in self.ids(pieces)]

    def encode_whole(self, texts: list[str]) -> list:
        return [array("I", i).tobytes() for i in self._library_ids(texts)]


def _shared(text: str) -> bool:
    """Letters below U+0250 are the same in all libraries' tables."""
    return text.isascii() or max(text) < "ɐ"


_TABLES: dict[tuple, PieceTable] = {}


def piece_table(kind, path: str, *more) -> PieceTable:
    """This worker's table; kept over its tasks."""
    key = (kind, path)
    if key not in _TABLES:
        _TABLES[key] = kind(path, *more)
    return _TABLES[key]


class CountTable(PieceTable):
    """Counts tokens: known whole tokens first, merges for the rest."""

    def __init__(self, path: str, whole: dict[str, int], limit: int = CACHED_PIECES) -> None:
        super().__init__(path, limit)
        self.single = whole

    def encode(self, pieces: list[str]) -> list[int]:
        split = [_SPLIT.findall(p) if _shared(p) else self._library_split(p) for p in pieces]
        single = self.single
        rest = list(dict.fromkeys(w for words in split for w in words if w not in single))
        merged = dict(zip(rest, map(len, self.ids(rest)), strict=True))
        return [sum(1 if w in single else merged[w] for w in words) for words in split]

    def _library_split(self, piece: str) -> list[str]:
        """The library's own pre-tokens, where its tables of letters may differ from ours."""
        return [piece[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)]

    def encode_whole(self, texts: list[str]) -> list[int]:
        return [len(i) for i in self._library_ids(texts)]

    def special_value(self, token: int) -> int:
        return 1


def count_tokens(documents: DataFrame, tokenizer_path: str, text: str = "text", keep: list[str] | None = None, limit: int = 1024) -> DataFrame:
    """The columns ``keep`` (all by default) with n_bytes, n_tokens (long) and over_limit (n_tokens > limit)."""
    spark = documents.sparkSession
    small_batches(spark)
    keep = kept(documents, keep, ("n_bytes", "n_tokens", "over_limit"))
    single = spark.sparkContext.broadcast(whole_tokens(tokenizer_path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(CountTable, tokenizer_path, single.value)
        for batch in batches:
            column = batch.column(text)
            _, bounds = text_buffer(column)
            counts = [sum(v) for texts in text_runs(column) for v in table.values(texts)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(np.diff(bounds), pa.int64()), pa.array(counts, pa.int64())], [*keep, "n_bytes", "n_tokens"])

    schema = T.StructType([*(documents.schema[c] for c in keep), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    counted = documents.select(*dict.fromkeys([*keep, text])).mapInArrow(count, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def tokenizer_kind(path: str) -> str:
    """byte-bpe where the shortcut's premises hold; other files are refused."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError(f"{path} is no plain byte-level BPE file")
    return "byte-bpe"
