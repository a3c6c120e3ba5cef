"""Operator 11: how many tokens a tokenizer makes of every whole text.

An Arrow function gets a batch of texts, cuts their bytes into segments at safe
boundaries and returns numbers only. Segments of a batch are told apart exactly
(Arrow's dictionary), and each different one is encoded once, in batches of about
``BATCH`` bytes; short ones stay known to the task. A window of ``WINDOW`` bytes is
worked on at a time, whatever the sizes of the texts in it, so one very long text
takes no more memory than many short ones.

A boundary is safe where the tokenizer can't join what stands on its sides:

* sentencepiece BPE that neither normalises nor drops spaces, puts one space before
  a text and falls back to bytes: before a space after another character, and before
  a line end, if no piece of the vocabulary runs across; within a longer run also
  between two characters that follow one another in no piece. The space that the
  library puts before a segment stands for the one cut off, or is taken off again;
* byte-level and word BPE of tokenizers: before a space after a printing ASCII
  character, where their patterns always end a word.

Any other tokenizer, and a run without a safe boundary, gets its texts whole.

Defined results: null and empty texts have 0 tokens (and 0 bytes); nothing is put
before or after a text; strings of special tokens in a text are taken as the library
does by default; rows that repeat an id are counted each, and ids may be null; an
empty table gives an empty result; other columns pass through, but for columns named
as those that are added.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm._text import buffer_of, give_back
from folioforge.llm.tokens import exact_for

WINDOW = 1 << 22
BATCH = 1 << 20
#: Bytes from which a segment is cut further, and up to which it stays known; how many stay known.
LONG = 1 << 16
SHORT = 64
REMEMBERED = 400_000
_SPACE, _LINE = 0x20, 0x0A
_MARK = "▁"


class PieceCounter:
    """Counts the pieces of a sentencepiece model."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(Path(path).read_bytes())
        norm, trainer = model.normalizer_spec, model.trainer_spec
        pieces = [p.piece for p in model.pieces if p.type == 1]
        self.pairs = {p[k : k + 2] for p in pieces for k in range(len(p) - 1)}
        plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
        known = {p.type for p in model.pieces} <= {1, 2, 3, 6}
        self.cuts = plain and known and trainer.model_type == 2 and trainer.byte_fallback and not trainer.treat_whitespace_as_suffix and not any(b == _MARK != a or "\n" in a + b for a, b in self.pairs)

    def boundaries(self, data: np.ndarray) -> np.ndarray:
        """Where a segment may begin; at a line end, or at a space after neither a space nor the mark that stands for one."""
        here, before = data[1:], data[:-1]
        safe = (here == _SPACE) & (before != _SPACE)
        mark = np.zeros(len(safe), bool)
        mark[2:] = (data[:-3] == 0xE2) & (data[1:-2] == 0x96) & (before[2:] == 0x81)
        return np.flatnonzero((safe & ~mark) | (here == _LINE)) + 1

    def _parts(self, text: str) -> list[str]:
        """A text cut after about ``LONG`` characters where two neighbours, or a space and the second, share no piece."""
        out, at, k = [], 0, LONG
        while k < len(text):
            if text[k] not in f" {_MARK}" and text[k - 1 : k + 1] not in self.pairs and _MARK + text[k] not in self.pairs:
                out.append(text[at:k])
                at, k = k, k + LONG
            else:
                k += 1
        return [*out, text[at:]]

    def count(self, segments: list[bytes], first: bool) -> list[int]:
        """Tokens of each segment; ``first`` if they begin their texts, else each begins with a space or a line end."""
        out = [0] * len(segments)
        texts, of = [], []
        for k, segment in enumerate(segments):
            text = segment.decode(errors="replace")
            if not first:
                if text == " ":
                    out[k] = 1
                    continue
                if text[0] == " ":
                    text = text[1:]
                else:
                    out[k] = -1
            parts = self._parts(text) if self.cuts and len(text) > LONG else [text]
            out[k] -= len(parts) - 1
            texts += parts
            of += [k] * len(parts)
        for k, ids in zip(of, self.library.encode(texts, num_threads=1) if texts else [], strict=True):
            out[k] += len(ids)
        return out


class WordCounter:
    """Counts the tokens of a tokenizers file."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        kind = json.loads(Path(path).read_text())
        first = kind["pre_tokenizer"] or {}
        by_bytes = kind["normalizer"] is None and first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first["add_prefix_space"]
        self.cuts = (by_bytes or exact_for(path)) and not any(" " in t["content"] or t["rstrip"] for t in kind["added_tokens"])

    def boundaries(self, data: np.ndarray) -> np.ndarray:
        before = data[:-1]
        return np.flatnonzero((data[1:] == _SPACE) & (before > _SPACE) & (before < 0x7F)) + 1

    def count(self, segments: list[bytes], first: bool) -> list[int]:
        return [len(x) for x in self.library.encode_batch_fast([s.decode(errors="replace") for s in segments], add_special_tokens=False)]


def balanced(sizes: np.ndarray, limit: int) -> Iterator[slice]:
    """Runs of about ``limit`` bytes, a larger item alone."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield slice(at, end)
        at = end


class Counts:
    """Token counts of columns of texts; remembers short segments."""

    def __init__(self, path: str) -> None:
        self.counter = PieceCounter(path) if path.endswith(".model") else WordCounter(path)
        self.forget()

    def forget(self) -> None:
        self.known: tuple[dict[bytes, int], dict[bytes, int]] = ({}, {})

    def _each(self, segments: pa.Array, first: bool) -> np.ndarray:
        """Tokens of each segment, by its different ones."""
        coded = segments.dictionary_encode()
        names = coded.dictionary.to_pylist()
        known = self.known[first]
        counts = [known.get(x, -1) for x in names]
        fresh = [k for k, n in enumerate(counts) if n < 0]
        for part in balanced(np.array([len(names[k]) for k in fresh], np.int64), BATCH):
            batch = fresh[part]
            for k, n in zip(batch, self.counter.count([names[k] for k in batch], first), strict=True):
                counts[k] = n
                if len(names[k]) <= SHORT:
                    known[names[k]] = n
        if sum(map(len, self.known)) > REMEMBERED:
            self.forget()
        return np.array(counts, np.int64)[coded.indices.to_numpy(zero_copy_only=False)] if len(segments) else np.zeros(0, np.int64)

    def of(self, column: pa.Array) -> np.ndarray:
        data, offsets = buffer_of(column)
        out = np.zeros(len(offsets) - 1, np.int64)
        starts = offsets[:-1][np.diff(offsets) > 0]
        at, n = 0, len(data)
        while at < n:
            size = WINDOW
            while True:  # up to the last boundary in reach
                end = min(n, at + size)
                cuts = self.counter.boundaries(data[at : end + 1]) + at if self.counter.cuts else np.zeros(0, np.int64)
                here = np.zeros(end - at + 1, bool)
                here[0] = True
                here[starts[np.searchsorted(starts, at) : np.searchsorted(starts, end, "right")] - at] = True
                here[cuts[: np.searchsorted(cuts, end, "right")] - at] = True
                begins = np.flatnonzero(here) + at
                if end == n or begins[-1] > at:
                    break
                size *= 2
            end = n if end == n else int(begins[-1])
            begins = begins[: np.searchsorted(begins, end)]
            edges = np.r_[begins, end] - at
            segments = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(data[at:end])])
            rows = np.searchsorted(offsets, begins, "right") - 1
            first = offsets[rows] == begins
            for which in (True, False):
                np.add.at(out, rows[first == which], self._each(segments.filter(pa.array(first == which)), which))
            at = end
        return out


_counts: dict[str, Counts] = {}


def _counted(name: str) -> Counts:
    """For a tokenizer's file that Spark has sent to the executors."""
    if name not in _counts:
        _counts[name] = Counts(SparkFiles.get(name))
    return _counts[name]


def counter(name: str) -> Callable:
    @F.arrow_udf("long")
    def tokens(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts = _counted(name)
        for column in texts:
            yield pa.array(counts.of(column), pa.int64())
        counts.forget()
        give_back()

    return tokens


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 4096, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_token_bytes`` (UTF-8), ``_token_count`` and ``_token_over`` (more than ``limit`` tokens).

    ``tokenizer`` is the path of a sentencepiece ``.model`` or a tokenizers ``.json`` on the driver.
    """
    docs.sparkSession.sparkContext.addFile(tokenizer)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.withColumn("_token_bytes", F.octet_length(text).cast("long")).withColumn("_token_count", counter(Path(tokenizer).name)(text))
    return rows.withColumn("_token_over", F.col("_token_count") > limit)
