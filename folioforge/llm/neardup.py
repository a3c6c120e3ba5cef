"""Operator 4: near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct ``k``-word shingles, embedded as 64 minwise
tokens. Every node of a tree picks two of the 64 places by its own randomness and
sends each of its documents to the two children named by the document's tokens
there, so documents of Jaccard similarity ``s`` share a child with chance
``1-(1-s)**2`` and others part at once. Nodes of at most ``limit`` documents are
compared exhaustively, larger ones branch again into two children at every level.
With the 4 trees of the default, an isolated pair at 0.80 is missed with a chance of
4e-5 if its nodes are small after the first two levels, 1.1e-4 after 3 further
levels, 1.3e-4 after 5 and 1.5e-4 after 11 (at 0.85: 5e-6, 1.1e-5, 1.2e-5, 1.3e-5),
computed for independent places over the 64 tokens.

Within a node, documents are compared by four bits of each token: a pair at the
threshold falls below the cutoff with a chance under 1e-6. The likeliest pairs that
connect the node's documents, a spanning forest, are confirmed on the full sets
first, then what is near but not yet connected, so no list of all pairs is made.
Sets that are compared together are dealt into blocks of about ``BLOCK_BYTES``.

Copies first collapse to one class by a 128-bit digest of the set, aggregated on
both sides of the shuffle. A large node compares everything with one random pivot,
and stops once all its documents are connected; if at most ``4 * limit`` documents are
not connected with most others, these are compared with the whole node and it stops
too. So a group of thousands of near copies costs a multiple of its size, not its
square. Documents that are alike but not linked (of one template, say) part slowly by
branching, which doubles their entries at every level; so an unconnected node of up to
``WHOLE * limit`` documents is compared exhaustively in blocks at once, at a bounded
cost for each of its documents. A larger one branches on, and is compared so as soon
as it is as small, or after ``depth`` levels.

Defined results: null or empty texts, and texts without words, have an empty set
and are linked with nothing; rows that share an id are copies of one node; a null
id takes its component's least id, and links others as any row does; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from folioforge.llm._graph import components
from folioforge.llm._store import Scratch, light
from folioforge.llm._text import distinct, lean, mix, shingles, slices, words

PLACES = 64
#: A large node whose documents aren't connected is compared whole, in blocks, if it has at most so many times ``limit`` of them.
WHOLE = 16
#: Bytes of full sets that one group gathers to compare them, if more than two of them.
BLOCK_BYTES = 1 << 25
_SEEDS = mix(np.arange(1, PLACES + 1, dtype=np.uint64))
_ODD = mix(np.arange(1001, 1001 + PLACES, dtype=np.uint64)) | np.uint64(1)


def _sets(piece: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, rows, _, _ = words(piece.column(piece.schema.get_field_index("text")))
    value, row, _ = shingles(hashes, rows, k)
    return distinct(value, row)


def _tokens(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minwise tokens of each segment of ``value``, 64 unsigned 32-bit integers a row."""
    out = np.empty((len(starts), PLACES), np.uint32)
    for j in range(PLACES):
        x = (value ^ _SEEDS[j]) * _ODD[j]
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        out[:, j] = np.minimum.reduceat((x >> np.uint64(32)).astype(np.uint32), starts)
    return out


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                value, row = _sets(piece, k)
                size = np.bincount(row, minlength=piece.num_rows)
                full = np.flatnonzero(size)
                d1, d2 = np.zeros(piece.num_rows, np.uint64), np.zeros(piece.num_rows, np.uint64)
                tokens: list = [None] * piece.num_rows
                if len(full):
                    starts = np.r_[0, np.cumsum(size[full])[:-1]]
                    d1[full] = np.add.reduceat(mix(value + np.uint64(11)), starts)
                    d2[full] = np.bitwise_xor.reduceat(mix(value + np.uint64(29)), starts)
                    for i, t in zip(full, _tokens(value, starts), strict=True):
                        tokens[i] = t.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(piece.schema.get_field_index(c)) for c in ("id", "t1", "t2")), pa.array(size.astype(np.int64)), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), pa.array(tokens, pa.binary())],
                    names=["id", "t1", "t2", "n", "d1", "d2", "tokens"],
                )

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, PLACES)


def _children(path: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The two children of each (node, document)."""
    draw = mix(path)
    one = (draw % np.uint64(PLACES)).astype(np.int64)
    two = (one + 1 + ((draw >> np.uint64(32)) % np.uint64(PLACES - 1)).astype(np.int64)) % PLACES
    at = np.arange(len(path))
    return np.stack([mix(path ^ mix((place.astype(np.uint64) << np.uint64(32)) + tokens[at, place])) for place in (one, two)], 1)


def _short(tokens: np.ndarray) -> pa.Array:
    """Four bits of each token."""
    low = (tokens & np.uint32(15)).astype(np.uint8)
    return pa.array([r.tobytes() for r in low[:, ::2] | low[:, 1::2] << 4], pa.binary())


def _places(column: pa.Array) -> np.ndarray:
    packed = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, PLACES // 2)
    return np.stack([packed & 15, packed >> 4], 2).reshape(-1, PLACES)


_ENTRIES = "path long, rep long, n long, short binary"


def _entry_batch(paths: np.ndarray, batch: pa.RecordBatch, tokens: np.ndarray) -> pa.RecordBatch:
    again = pa.array(np.repeat(np.arange(len(tokens)), paths.shape[1]))
    columns = [batch.column(batch.schema.get_field_index(c)) for c in ("rep", "n")] + [_short(tokens)]
    return pa.RecordBatch.from_arrays([pa.array(paths.ravel().view(np.int64)), *(c.take(again) for c in columns)], names=["path", "rep", "n", "short"])


def _entries(trees: int):
    """Two levels of every tree at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = _matrix(batch.column(batch.schema.get_field_index("tokens")))
            paths = np.repeat(mix(np.arange(1, trees + 1, dtype=np.uint64))[None, :], len(tokens), 0)
            for _ in range(2):
                width = paths.shape[1]
                paths = _children(paths.ravel(), np.repeat(tokens, width, 0)).reshape(len(tokens), -1)
            yield _entry_batch(paths, batch, tokens)

    return run


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            tokens = _matrix(batch.column(batch.schema.get_field_index("tokens")))
            yield _entry_batch(_children(batch.column(0).to_numpy().view(np.uint64), tokens), batch, tokens)


def _cutoff(percent: int) -> int:
    """Agreeing tokens that a pair at the threshold falls below with a chance under 1e-6."""
    s = percent / 100
    return max(1, math.floor(PLACES * s - 4.9 * math.sqrt(PLACES * s * (1 - s))))


def _one_bit_cutoff(percent: int) -> int:
    """The same for single bits of tokens, half of which agree by chance where tokens differ."""
    s = (1 + percent / 100) / 2
    return max(1, math.floor(PLACES * s - 4.9 * math.sqrt(PLACES * s * (1 - s))))


def _possible(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can reach the threshold."""
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def _connect(n: np.ndarray, places: np.ndarray, group: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Connects a node's documents by near pairs, likeliest first.

    ``group`` tells what is connected already. Returns a number for each document's
    part of the node and the pairs of a spanning forest.
    """
    part = np.unique(group, return_inverse=True)[1]
    bit = np.packbits(places & 1, axis=1).view(np.uint64).ravel()
    edges: list[tuple[int, int]] = []
    least, one_bit = _cutoff(percent), _one_bit_cutoff(percent)
    sure = PLACES * percent // 100
    for low in sorted({least, max(least, sure - 5), max(least, sure + 4)}, reverse=True):
        for at in range(0, len(n), 256):
            end = min(at + 256, len(n))
            agree = PLACES - np.bitwise_count(bit[at:end, None] ^ bit[None, at:])
            may = (agree >= one_bit) & (part[at:end, None] != part[None, at:])
            for x in np.flatnonzero(may.any(1)).tolist():
                i = at + x
                j = at + np.flatnonzero(may[x])
                j = j[(j > i) & (part[j] != part[i])]
                j = j[_possible(n[i], n[j], percent)]
                near = (places[j] == places[i]).sum(1)
                j, near = j[near >= low], near[near >= low]
                if len(j):
                    j = j[np.argsort(-near, kind="stable")]
                    parts, best = np.unique(part[j], return_index=True)
                    edges += [(i, int(y)) for y in j[best]]
                    part[np.isin(part, parts)] = part[i]
    found = np.array(edges, np.int64).reshape(-1, 2)
    return part, found[:, 0], found[:, 1]


def _parts(percent: int, forest: bool):
    """What near pairs connect in each node: rows of a part's name, and a document with its label.

    Parts of several nodes with the same documents share a name. With ``forest``, rows
    without a name follow: the ends of the pairs that connect them.
    """

    least = _cutoff(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            docs = lists.flatten()
            rep, n, label = (docs.field(x).to_numpy() for x in ("rep", "n", "label"))
            places = _places(docs.field("short")) if len(docs) else np.zeros((0, PLACES), np.uint8)
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            sizes = np.diff(offsets)
            # Nodes of two documents at once, the others one by one.
            i = offsets[:-1][sizes == 2]
            i, j = np.where(rep[i] < rep[i + 1], i, i + 1), np.where(rep[i] < rep[i + 1], i + 1, i)
            near = ((places[i] == places[j]).sum(1) >= least) & _possible(n[i], n[j], percent) & (label[i] != label[j])
            i, j = i[near], j[near]
            total = mix(rep[i].view(np.uint64)) + mix(rep[j].view(np.uint64))
            edges, members = [np.stack([i, j])], [(np.r_[total, total], np.r_[i, j])]
            for node in np.flatnonzero(sizes > 2).tolist():
                own = offsets[node] + np.argsort(rep[offsets[node] : offsets[node + 1]])
                part, i, j = _connect(n[own], places[own], label[own], percent)
                if len(i):
                    some = np.flatnonzero(np.isin(part, part[i]))
                    total = np.zeros(len(own), np.uint64)
                    np.add.at(total, part[some], mix(rep[own[some]].view(np.uint64)))
                    edges.append(np.stack([own[i], own[j]]))
                    members.append((total[part[some]], own[some]))
            names, at = (np.concatenate(x) for x in zip(*members, strict=True))
            i, j = np.concatenate(edges, 1) if forest else np.zeros((2, 0), np.int64)
            first = np.r_[np.ones(len(i), bool), np.zeros(len(at), bool)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[np.zeros(len(i), np.int64), names.view(np.int64)], mask=first), pa.array(np.r_[rep[i], rep[at]]), pa.array(np.r_[label[i], label[at]]), pa.array(np.r_[rep[j], np.zeros(len(at), np.int64)], mask=~first)],
                names=["cluster", "rep", "label", "other"],
            )

    return run


_PARTS = "cluster long, rep long, label long, other long"


class _Union:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def top(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.top(x), self.top(y)
        self.up[x] = y
        return x != y


def _verify(percent: int):
    """Links between labels of groups given with full sets, as spanning forests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                docs = batch.column(0).slice(row, 1).flatten()
                rep, label = docs.field("rep").to_numpy(), docs.field("label").to_numpy()
                sets = [np.frombuffer(x, np.uint64) for x in docs.field("full").to_pylist()]
                size = np.array([len(x) for x in sets])
                starts = np.r_[0, np.cumsum(size)[:-1]]
                names, place = np.unique(np.concatenate(sets), return_inverse=True)
                kinds, kind, many = np.unique(label, return_inverse=True, return_counts=True)
                union = _Union(len(kinds))
                edges = []
                mark = np.zeros(len(names), np.int32)
                for x in np.flatnonzero(kind != many.argmax()).tolist():
                    own = place[starts[x] : starts[x] + size[x]]
                    mark[own] = 1
                    common = np.add.reduceat(mark[place], starts)
                    mark[own] = 0
                    for y in np.flatnonzero(100 * common >= percent * (size + size[x] - common)).tolist():
                        if union.join(int(kind[x]), int(kind[y])):
                            edges.append((min(rep[x], rep[y]), max(rep[x], rep[y])))
                yield pa.RecordBatch.from_arrays([pa.array([int(e[k]) for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def _against_pivot(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, n, b, m = (batch.column(c).to_numpy() for c in (0, 1, 3, 4))
            agree = (_places(batch.column(2)) == _places(batch.column(5))).sum(1)
            hit = np.flatnonzero((agree >= _cutoff(percent)) & _possible(n, m, percent))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[hit]), pa.array(np.maximum(a, b)[hit])], names=["a", "b"])

    return run


def _full_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                value, row = _sets(piece, k)
                ends = np.cumsum(np.bincount(row, minlength=piece.num_rows)) * 8
                whole = value.tobytes()
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array([whole[a:b] for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True)], pa.binary())], names=["rep", "full"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for q, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    keep.append(q)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return run


def _pivot_rank() -> Column:
    """Orders a node's documents; nodes draw from four orders, so those of one group share few pivots."""
    return F.xxhash64("rep", F.pmod("path", F.lit(4)))


class _Join:
    def __init__(self, rows: DataFrame, k: int, percent: int, trees: int, limit: int, depth: int) -> None:
        self.rows, self.k, self.percent, self.trees, self.limit, self.depth = rows, k, percent, trees, limit, depth
        self.scratch = Scratch(rows.sparkSession, "neardup")
        self.labels: DataFrame | None = None
        self.n_labels = 0
        self.sets: DataFrame | None = None

    def confirm(self, pairs: DataFrame, n: int) -> None:
        """Add the pairs that reach the threshold on full sets, and label components anew."""
        left = self.sets.select(F.col("rep").alias("a"), F.col("full").alias("full_a"))
        right = self.sets.select(F.col("rep").alias("b"), F.col("full").alias("full_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "full_a", "full_b")
        self.add(both.mapInArrow(lean(_confirm(self.percent)), "a long, b long"), n)

    def confirm_clusters(self, rows: DataFrame) -> None:
        """Add the links between different labels within clusters, confirmed on full sets.

        A cluster of much data is dealt into blocks, and each pair of blocks is a group of its own.
        """
        full = rows.join(self.sets, "rep").select("cluster", "rep", "label", "full")
        total = rows.join(self.sets.select("rep", "bytes"), "rep").groupBy("cluster").agg(F.sum("bytes").alias("bytes"))
        blocks = total.select("cluster", F.ceil(2 * F.col("bytes") / BLOCK_BYTES).cast("int").alias("of")).withColumn("of", F.when(F.col("of") <= 2, 1).otherwise(F.col("of")))
        block = full.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("of")).cast("int"))
        block = block.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
        lists = block.groupBy("cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).agg(F.collect_list(F.struct("rep", "label", "full")).alias("docs"))
        self.add(lists.select("docs").mapInArrow(lean(_verify(self.percent)), "a long, b long"))

    def add(self, links: DataFrame, most: int | None = None) -> None:
        """Join the components that links, at most ``most`` of them if known, connect."""
        ends = links
        for c in ("a", "b"):
            ends = self.labelled(ends, c, f"label_{c}")
        more, n = components(ends.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")), self.scratch, most)
        if not n:
            return
        if self.labels is None:
            self.labels, self.n_labels = more, n
            return
        old, seen = self.labels, Observation()
        further = light(more.select(F.col("node").alias("label"), F.col("label").alias("further")), n)
        moved = old.join(further, "label", "left").select("node", F.coalesce("further", "label").alias("label"))
        alone = more.join(light(old.select("node"), self.n_labels), "node", "left_anti")
        self.labels = self.scratch.keep(moved.union(alone.select("node", "label")).observe(seen, F.count(F.lit(1)).alias("n")), "labels", self.n_labels + n)
        self.n_labels = seen.get["n"]
        self.scratch.drop(old)

    def labelled(self, rows: DataFrame, rep: str = "rep", label: str = "label") -> DataFrame:
        rows = rows.drop(label)
        if self.labels is None:
            return rows.withColumn(label, F.col(rep))
        found = self.labels.select(F.col("node").alias(rep), F.col("label").alias("_found"))
        return rows.join(light(found, self.n_labels), rep, "left").withColumn(label, F.coalesce("_found", rep)).drop("_found")

    def nodes(self, members: DataFrame, *keys: str) -> DataFrame:
        """One row for each node: its documents, about ``limit`` of them by construction, if labels differ."""
        lists = members.groupBy(*keys).agg(F.collect_list(F.struct("rep", "n", "short", "label")).alias("docs"), F.min("label").alias("low"), F.max("label").alias("high"))
        return lists.where("low <> high").select("docs")

    def classes(self) -> tuple[DataFrame, DataFrame]:
        """The sketch of every row, and one row for each different set, named by ``rep``.

        Names are drawn when the classes are written, and stay as written.
        """
        text = [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")]
        sketch = self.scratch.keep(self.rows.select("id", *text, "text").mapInArrow(lean(_sketch(self.k)), "id long, t1 long, t2 long, n long, d1 long, d2 long, tokens binary"), "sketch")
        first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t1", "t2")).alias("first")
        classes = sketch.where("n > 0").groupBy("d1", "d2", "n").agg(first, F.any_value("tokens").alias("tokens"))
        return sketch, self.scratch.keep(classes.select("d1", "d2", "n", "first.id", "first.t1", "first.t2", "tokens", F.monotonically_increasing_id().alias("rep")), "classes")

    def gather(self, reps: DataFrame, involved: DataFrame) -> None:
        """Full sets of the documents that are compared, from the text of one row each."""
        wanted, n = self.scratch.counted(reps.join(involved.distinct(), "rep").select("rep", F.col("id").alias("wanted"), "t1", "t2"), "wanted")
        rows = self.rows.select("id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), "text")
        texts = rows.join(light(wanted, n), ["t1", "t2"]).where(F.col("id").eqNullSafe(F.col("wanted"))).select("rep", "text")
        sets = texts.mapInArrow(lean(_full_sets(self.k)), "rep long, full binary").groupBy("rep").agg(F.any_value("full").alias("full"))
        self.sets = self.scratch.keep(sets.withColumn("bytes", F.length("full")), "sets")

    def run(self) -> tuple[DataFrame, DataFrame]:
        keep, limit, percent = self.scratch.keep, self.limit, self.percent
        sketch, reps = self.classes()
        entries = reps.select("rep", "n", "tokens").mapInArrow(lean(_entries(self.trees)), _ENTRIES)
        for level in range(self.depth):
            if level:
                entries = keep(entries.distinct(), "entries")
            sizes, seen = entries.groupBy("path").agg(F.count("*").alias("size"), F.min(_pivot_rank()).alias("pivot")).where("size > 1"), Observation()
            nodes = keep(sizes.observe(seen, F.count_if(F.col("size") > limit).alias("big")), "nodes")
            n_big = seen.get["big"]
            large = light(nodes.where(f"size > {limit}"), n_big)
            some = entries.join(large.select("path"), "path", "left_anti") if n_big else entries
            small = some.join(nodes.where(f"size <= {limit}").select("path"), "path")
            near = keep(self.nodes(self.labelled(small), "path").mapInArrow(lean(_parts(percent, True)), _PARTS), "near")
            pairs = near.where("cluster is null").select(F.col("rep").alias("a"), F.col("other").alias("b"))
            parts = near.where("cluster is not null").select("cluster", "rep")
            involved = near.select("rep")
            if n_big:
                big = keep(entries.join(large, "path").select("path", "rep", "n", "short", "size", (_pivot_rank() == F.col("pivot")).alias("is_pivot")), "big")
                pivots = big.where("is_pivot").select("path", F.col("rep").alias("p"), F.col("n").alias("pn"), F.col("short").alias("pshort"))
                star = big.join(light(pivots, n_big), "path").where("rep <> p").select("rep", "n", "short", "p", "pn", "pshort").mapInArrow(_against_pivot(percent), "a long, b long")
                pairs, involved = pairs.union(star), involved.union(big.select("rep"))
            pairs, n_pairs = self.scratch.counted(pairs.distinct(), "pairs")
            if self.sets is None and (n_pairs or n_big):
                self.gather(reps, involved)
            if n_pairs:
                self.confirm(pairs, n_pairs)
            rest = self.unequal(self.labelled(parts.distinct()))
            n_left = 0
            if n_big:
                whole = self.labelled(big)
                by_label = whole.groupBy("path", "size", "label").agg(F.count("*").alias("of"))
                states = by_label.groupBy("path", "size").agg(F.max(F.struct("of", "label")).alias("most")).where("most.of < size")
                states = states.select("path", F.col("most.label").alias("main"), (F.col("size") - F.col("most.of")).alias("apart"))
                whole = keep(whole.join(light(states, n_big), "path"), "whole")
                few = self.nodes(self.spread(whole.where(f"apart <= {4 * limit}")), "path", "part").mapInArrow(_parts(percent, False), _PARTS)
                rest = rest.union(few.select("cluster", "rep", "label").distinct())
                left, n_left = self.scratch.counted(whole.where(f"apart > {4 * limit}").select("path", "rep", "n", "short", "size"), "left")
            rest, n_rest = self.scratch.counted(rest, "rest")
            if n_rest:
                self.confirm_clusters(rest)
            self.scratch.drop(nodes, near, pairs, rest)
            if not n_left:
                break
            last = level == self.depth - 1
            settled = F.lit(last) | (F.col("size") <= WHOLE * limit)
            n_settled = left.where(settled).count()
            if n_settled:
                self.blocks(left.where(settled))
            if n_settled == n_left:
                break
            left = left.where(~settled)
            entries = left.join(reps.select("rep", "tokens"), "rep").select("path", "rep", "n", "tokens").mapInArrow(_branch, _ENTRIES)
        return sketch, reps

    def spread(self, whole: DataFrame) -> DataFrame:
        """Parts of about ``limit`` documents of each node, each with the node's documents apart from its main label."""
        parts = whole.withColumn("of", F.ceil(F.col("size") / self.limit).cast("int"))
        own = F.array(F.pmod(F.xxhash64("rep"), F.col("of")).cast("int"))
        every = F.sequence(F.lit(0), F.col("of") - 1)
        return parts.withColumn("part", F.explode(F.when(F.col("label") == F.col("main"), own).otherwise(every)))

    def unequal(self, rows: DataFrame) -> DataFrame:
        """The rows of clusters whose labels differ. Their names are written, so that a large cluster's rows need not meet in one task."""
        rows = self.scratch.keep(rows, "parts")
        open_ones, n = self.scratch.counted(rows.groupBy("cluster").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("cluster"), "open")
        return rows.join(light(open_ones, n), "cluster", "left_semi").select("cluster", "rep", "label")

    def blocks(self, members: DataFrame) -> None:
        """Compare what branching did not part: every pair of parts of a node is a group of its own."""
        parts = members.withColumn("of", F.ceil(F.col("size") / self.limit).cast("int")).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("of")).cast("int"))
        each = parts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
        each = each.withColumn("low_part", F.least("part", "other")).withColumn("high_part", F.greatest("part", "other"))
        found = self.nodes(self.labelled(each), "path", "low_part", "high_part").mapInArrow(_parts(self.percent, False), _PARTS)
        self.confirm_clusters(self.scratch.keep(found.select("cluster", "rep", "label").distinct(), "blocks"))


def components_of(docs: DataFrame, k: int = 5, percent: int = 80, trees: int = 4, limit: int = 4096, depth: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: ``id_col``, ``n_shingles``, ``component_id`` and ``kept``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    join = _Join(rows, k, percent, trees, limit, depth)
    sketch, reps = join.run()
    named = reps.select("d1", "d2", "n", F.col("id").alias("least"))
    if join.labels is not None:
        linked = reps.select("rep", "id").join(light(join.labels.withColumnRenamed("node", "rep"), join.n_labels), "rep")
        least = linked.groupBy("label").agg(F.min("id").alias("found"))
        found = light(linked.join(least, "label").select("rep", "found"), join.n_labels)
        named = reps.join(found, "rep", "left").select("d1", "d2", "n", F.coalesce("found", "id").alias("least"))
    out = sketch.select("id", "n", "d1", "d2").join(named, ["d1", "d2", "n"], "left")
    component = F.coalesce("least", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings: int) -> DataFrame:
    """The documents of which ``components_of`` keeps one a component, with all columns.

    Rows that repeat an id and its text count once; a null id stays, as nothing names it.
    """
    scratch = Scratch(docs.sparkSession, "kept")
    found = components_of(docs, id_col=id_col, text_col=text_col, **settings).where(F.col(id_col).isNotNull())
    marks = found.groupBy(F.col(id_col).alias("_dup_id")).agg((F.min("component_id") != F.col("_dup_id")).alias("_dup_lost"), (F.count("*") > 1).alias("_dup_again"))
    marks, n = scratch.counted(marks.where("_dup_lost or _dup_again"), "marks")
    rows = docs.join(light(marks, n), docs[id_col] == marks["_dup_id"], "left").where("not coalesce(_dup_lost, false)")
    again = rows.where("_dup_again").dropDuplicates([id_col, text_col]).select(*docs.columns)
    return rows.where("_dup_again is null or not _dup_again").select(*docs.columns).union(again)
