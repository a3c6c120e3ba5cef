"""Operator 1: token ids of whole texts in a Simple-8b file.

The file is a Parquet folder whose rows are blocks of whole documents in
ascending ``doc_id`` order: ``shard`` and ``block`` (the order), ``shard_start``
(ids of the shard before the block), ``doc_ids`` and ``lengths`` of its documents,
``n_ids`` and ``payload`` (see ``simple8b``). Spark's commit protocol writes it,
so a lost executor leaves no partial file, and any Hadoop store can hold it.

Null and empty texts give the end id alone. Rows that share a ``doc_id`` (or have
none: these sort first) are all written, next to each other, ordered by text. An
empty table gives an empty file. Other columns are not read.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyspark
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm import simple8b
from folioforge.llm._store import Scratch
from folioforge.llm._text import LOWER, buffer_of, lean, slices, words

FILE_SCHEMA = "shard int, block int, shard_start long, doc_ids array<bigint>, lengths array<int>, n_ids long, payload binary"
_FILE_ARROW = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("shard_start", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("n_ids", pa.int64()), ("payload", pa.binary())])
#: Ids after which a block closes, and words that a task remembers.
BLOCK_IDS = 1 << 16
REMEMBERED = 400_000


#: First bytes of the marks U+0300-U+036F, which compose with A-Z and a-z differently.
_MARKS = (b"\xcc", b"\xcd")


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


class WordEncoder:
    """Encodes texts word by word, each different word once.

    Holds for tokenizers that never join text across a space or line end and
    drop both, which ``exact_for`` confirms on the tokenizer's own description.
    Words are told apart by the hash of their bytes with A-Z lower-cased, which the
    tokenizer does too; texts with combining marks or a special token's text, where
    case could matter earlier, go word by word as they are. A new word is cut by the tokenizer's own pattern, and its new pieces go to the
    tokenizer together; the suffix of their last ids tells them apart again.
    """

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = False
        kind = json.loads(Path(path).read_text())
        self.pieces = regex.compile(kind["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.special = regex.compile(b"|".join(regex.escape(t["content"].encode().lower()) for t in kind["added_tokens"]) or b"(?!)", regex.IGNORECASE).search
        suffix = kind["model"]["end_of_word_suffix"]
        self.last = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.classes: dict[str, bool] = {}
        self.trusted = set(map(chr, range(128)))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.hashed: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.first = np.zeros(1 << 16, np.int64)
        self.n_ids = self.n_words = 0

    def _add(self, names: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        n = len(counts)
        while self.n_words + n + 1 > len(self.first):
            self.first = np.r_[self.first, np.zeros_like(self.first)]
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.first[self.n_words + 1 : self.n_words + 1 + n] = self.n_ids + np.cumsum(counts)
        self.known.update(zip(names, range(self.n_words, self.n_words + n)))
        self.n_ids += len(ids)
        self.n_words += n

    def _gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.first[which + 1] - self.first[which]
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(self.first[which] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)], sizes

    def _alone(self, names: list[str]) -> None:
        each = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in names]
        self._add(names, np.array([i for ids in each for i in ids], np.int32), np.array([len(ids) for ids in each]))

    def _learn(self, rest: list[str]) -> None:
        normalize = self.tokenizer.normalizer.normalize_str
        settled = lambda w: w.isascii() or w.lower() == w and unicodedata.is_normalized("NFC", w)
        normal = [w if w.isascii() or w.islower() and unicodedata.is_normalized("NFC", w) else normalize(w) for w in rest]
        # Normalising twice can differ from once (a composition may follow lower-casing), and so can the classes of characters
        # between the pattern here and the tokenizer's: such a word goes to the tokenizer as it is.
        if unstable := [w for w, n in zip(rest, normal, strict=True) if not n.isascii() and (not settled(n) and normalize(n) != n or not (self.trusted.issuperset(n) or all(map(self._same_class, n))))]:
            self._alone(unstable)
            rest, normal = zip(*x) if (x := [(w, n) for w, n in zip(rest, normal, strict=True) if w not in self.known]) else ((), ())
        cut = [[w] if w.isalpha() else self.pieces(w) for w in normal]
        fresh = list(set().union(*cut).difference(self.known)) if cut else []
        if fresh:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(fresh)], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(fresh) and ends[-1] == len(ids):
                self._add(fresh, ids, np.diff(np.r_[0, ends]))
            else:
                self._alone(fresh)
        made = [(w, c) for w, c in zip(rest, cut, strict=True) if w not in self.known]
        if made:
            flat, sizes = self._gather(np.fromiter(map(self.known.__getitem__, chain.from_iterable(c for _, c in made)), np.int64))
            total = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum([len(c) for _, c in made])]]
            self._add([w for w, _ in made], flat, np.diff(total))

    def _same_class(self, c: str) -> bool:
        """Whether the pattern takes a character for a letter, number, space or other as the tokenizer does."""
        if c not in self.classes:
            cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
            spans = [[span for _, span in cut(before + c)] for before in ("a", ".", "")]
            theirs = "letter" if spans[0] == [(0, 2)] else "other" if spans[1] == [(0, 2)] else "number" if spans[2] else "space"
            own = [self.pieces(before + c) for before in ("a", ".", "")]
            ours = "letter" if own[0] == ["a" + c] else "other" if own[1] == ["." + c] else "number" if own[2] else "space"
            self.classes[c] = theirs == ours
            if theirs == ours:
                self.trusted.add(c)
        return self.classes[c]

    def _learn_letters(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> bool:
        """Encode words of A-Z and a-z, each one piece, as one text; their places follow those known so far."""
        sizes = end - begin + 1
        ends = np.cumsum(sizes)
        joined = LOWER[data[np.minimum(np.repeat(begin - (ends - sizes), sizes) + np.arange(ends[-1]), len(data) - 1)]]
        joined[ends - 1] = 32
        ids = np.array(self.tokenizer.encode_batch_fast([joined.tobytes().decode("ascii")], add_special_tokens=False)[0].ids, np.int32)
        stops = np.flatnonzero(self.last[ids]) + 1
        if len(stops) != len(begin) or stops[-1] != len(ids):
            return False
        self._add([], ids, np.diff(np.r_[0, stops]))
        return True

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and each text's count."""
        if self.n_words > REMEMBERED:
            self.forget()
        data, _ = buffer_of(column)
        whole = data.tobytes()
        if any(m in whole for m in _MARKS) or self.special(whole):
            return self._by_name(column.to_pylist())
        hashes, rows, first, last = words(column)
        value, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        found = list(map(self.hashed.get, value.tolist()))
        missing = np.array([k for k, x in enumerate(found) if x is None], np.int64)
        if len(missing):
            begin, end = first[at[missing]], last[at[missing]]
            other = np.r_[0, np.cumsum(~_LETTER[data])]
            plain = other[end] == other[begin]
            if plain.any() and not self._learn_letters(data, begin[plain], end[plain]):
                plain[:] = False
            new = np.empty(len(missing), np.int64)
            new[plain] = np.arange(self.n_words - int(plain.sum()), self.n_words)
            rest = np.flatnonzero(~plain)
            names = [whole[a:b].lower().decode() for a, b in zip(begin[rest].tolist(), end[rest].tolist(), strict=True)]
            if unknown := [w for w in names if w not in self.known]:
                self._learn(unknown)
            new[rest] = [self.known[w] for w in names]
            for k, x in zip(missing.tolist(), new.tolist(), strict=True):
                found[k] = x
            self.hashed.update(zip(value[missing].tolist(), new.tolist(), strict=True))
        ids, sizes = self._gather(np.array(found, np.int64)[which])
        total = np.r_[0, np.cumsum(sizes)]
        return ids, np.diff(total[np.searchsorted(rows, np.arange(len(column) + 1))])

    def _by_name(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        parts = [(t or "").replace("\n", " ").split(" ") for t in texts]
        new = list(set().union(*parts).difference(self.known))
        if whole := [w for w in new if self.special(w.encode()) or w.isascii() and w != w.lower()]:
            self._alone(whole)
            new = [w for w in new if w not in self.known]
        if new:
            self._learn(new)
        ids, sizes = self._gather(np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), np.int64))
        return ids, np.diff(np.r_[0, np.cumsum(sizes)[np.cumsum([len(p) for p in parts]) - 1]])


class TextEncoder:
    """Encodes each text as a whole, for any other tokenizer."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def forget(self) -> None:
        """Nothing is remembered."""

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = [t or "" for t in column.to_pylist()]
        ids = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.concatenate(ids), np.array([len(x) for x in ids])


def exact_for(path: str) -> bool:
    """Whether the tokenizer replaces white space by one space and drops it between words."""
    kind = json.loads(Path(path).read_text())
    steps = (kind.get("normalizer") or {}).get("normalizers", [])
    split = ((kind.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    plain = any(s["type"] == "Lowercase" for s in steps) and all(s["type"] in ("NFC", "Lowercase") or s["type"] == "Replace" and s["pattern"] == {"Regex": "\\s+"} and s["content"] == " " for s in steps)
    added = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) and not any(c.isspace() for c in t["content"]) for t in kind.get("added_tokens", []))
    return plain and added and kind.get("post_processor") is None and split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True and bool(kind["model"].get("end_of_word_suffix")) and "[^\\s\\p{L}\\p{N}]" in split["pattern"]["Regex"]


_encoders: dict[str, WordEncoder | TextEncoder] = {}


def _encoder(name: str) -> WordEncoder | TextEncoder:
    """The encoder of a tokenizer's file that Spark has sent to the executors."""
    if name not in _encoders:
        path = SparkFiles.get(name)
        _encoders[name] = WordEncoder(path) if exact_for(path) else TextEncoder(path)
    return _encoders[name]


def _writer(name: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name)
        shard = pyspark.TaskContext.get().partitionId()
        total = block = 0
        names: list = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal total, block, held
            row = [[shard], [block], [total], [names[:]], [np.concatenate(lengths).tolist()], [held], [simple8b.to_bytes(np.concatenate(ids))]]
            total, block, held = total + held, block + 1, 0
            for x in (names, lengths, ids):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _FILE_ARROW, strict=True)], schema=_FILE_ARROW)

        for batch in batches:
            for piece in slices(batch, "text"):
                flat, counts = encoder.encode(piece.column(1))
                ends = np.cumsum(counts + 1) - 1
                out = np.empty(len(flat) + len(counts), np.int64)
                at = np.ones(len(out), bool)
                at[ends] = False
                out[at], out[ends] = flat, end_id
                names += piece.column(0).to_pylist()
                lengths.append(counts + 1)
                ids.append(out)
                held += len(out)
                if held >= BLOCK_IDS:
                    yield close()
        if names:
            yield close()
        encoder.forget()

    return write


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write the file at ``path``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", "text")
    docs.sparkSession.sparkContext.addFile(tokenizer)
    ordered.mapInArrow(lean(_writer(Path(tokenizer).name, end_id)), FILE_SCHEMA).write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = simple8b.from_bytes(row["payload"]).astype("<u4")
            ends = np.cumsum(row["lengths"])
            starts = ends - row["lengths"]
            crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            n = len(crcs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["shard"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(row["shard_start"] + starts, pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array(crcs, pa.int64())],
                names=["shard", "doc_id", "within", "n_tokens", "ids_crc32"],
            )


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            flat = pa.array(simple8b.from_bytes(row["payload"]).astype(np.int64))
            offsets = pa.array(np.r_[0, np.cumsum(row["lengths"])], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.ListArray.from_arrays(offsets, flat)], names=["doc_id", "ids"])


def read_ids(spark, path: str) -> DataFrame:
    """``doc_id`` and its ``ids`` as an array, from the file."""
    return spark.read.schema(FILE_SCHEMA).parquet(path).mapInArrow(_ids, "doc_id long, ids array<bigint>")


def digest(spark, path: str) -> DataFrame:
    """Per document of the file: its first id's index over the whole file, its ids and their checksum."""
    blocks = spark.read.schema(FILE_SCHEMA).parquet(path)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    rows = blocks.mapInArrow(lean(_read), "shard int, doc_id long, within long, n_tokens long, ids_crc32 long")
    return rows.join(shards, "shard").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def encode(docs: DataFrame, tokenizer: str, end_id: int = 2, **columns: str) -> DataFrame:
    """Write the file in the shared folder and return what ``digest`` reads from it."""
    spark = docs.sparkSession
    path = Scratch(spark, "ids").path("ids")
    write_ids(docs, path, tokenizer, end_id, **columns)
    return digest(spark, path)
