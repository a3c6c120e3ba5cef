"""Operator 6: near-duplicate vectors by E8 lattice hashing.

Each of ``tables`` random projections maps a vector's direction to ``blocks`` points of
eight dimensions, decoded to the nearest points of the E8 lattice: together its home
cell. With the defaults a pair of 64 dimensions at a cosine of 0.95 meets with a chance
of 0.994 (at 0.96: 0.9998), and unrelated vectors about 1.3 times in 100,000. A vector also probes the ``probes`` cells reached by the lattice's shortest
steps that come nearest. Vectors that meet in a cell are compared by cosine in
double precision. Equal vectors are one class first, by a 128-bit digest.

Vectors that meet in cells are connected in two steps. Every vector of a cell is
compared with one of those at home there, the same one in as many cells as possible,
so a pair meets once; then cells whose vectors are not one component yet are compared
whole, in groups of at most ``2 * limit`` vectors. Within each component links are
counted by comparing all its vectors. Components of more than ``limit`` vectors are
dealt by their angle to one vector, the pole, into rings: by the triangle inequality
all vectors of two rings link, or none, or else the rings are compared in groups of
at most ``2 * limit``. So a group of thousands of copies that differ little is counted
without comparing its pairs.

Defined results: vectors that are null, zero, or hold null or non-finite numbers
link with nothing; vectors of different lengths don't link; rows that share an id
are separate vectors of one component if they link; a null id takes its component's
least id, and links others as any row does; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from folioforge.llm._graph import components
from folioforge.llm._store import Scratch, light
from folioforge.llm._text import mix


def _steps() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    pairs = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            pairs.append(v)
    halves = [np.array(s) / 2 for s in product((1, -1), repeat=8) if s.count(-1) % 2 == 0]
    return np.array(pairs + halves)


STEPS = _steps()


def nearest(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: of D8, or of D8 moved by a half everywhere."""
    both = []
    for move in (0.0, 0.5):
        y = np.round(x - move)
        error = x - move - y
        odd = np.flatnonzero(y.sum(1) % 2 != 0)
        worst = np.abs(error[odd]).argmax(1)
        y[odd, worst] += np.where(error[odd, worst] >= 0, 1, -1)
        both.append(y + move)
    far = [((x - y) ** 2).sum(1) for y in both]
    return np.where((far[1] < far[0])[:, None], both[1], both[0])


@lru_cache(maxsize=8)
def _projection(dim: int, tables: int, scale: float, blocks: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([dim, tables, 8])).normal(size=(tables, dim, 8 * blocks)) * scale


def _name(points: np.ndarray, table: int) -> np.ndarray:
    """A 64-bit name of rows of lattice coordinates."""
    out = np.full(len(points), mix(np.array([table + 1], np.uint64))[0])
    for c in range(points.shape[1]):
        out = mix(out + np.round(points[:, c] * 2).astype(np.int64).view(np.uint64))
    return out


def cells(unit: np.ndarray, tables: int, probes: int, scale: float, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Home cells (rows, tables) and probed cells (rows, tables, probes)."""
    home = np.zeros((len(unit), tables), np.uint64)
    near = np.zeros((len(unit), tables, probes), np.uint64)
    parts = [slice(8 * b, 8 * b + 8) for b in range(blocks)]
    for t, matrix in enumerate(_projection(unit.shape[1], tables, scale, blocks)):
        x = unit @ matrix
        points = np.concatenate([nearest(x[:, p]) for p in parts], 1)
        home[:, t] = _name(points, t)
        rest = x - points
        gain = np.concatenate([rest[:, p] @ STEPS.T - (STEPS**2).sum(1) / 2 for p in parts], 1)
        for k, step in enumerate(np.argpartition(-gain, probes, axis=1)[:, :probes].T):
            moved = points.copy()
            for b, p in enumerate(parts):
                own = np.flatnonzero(step // len(STEPS) == b)
                moved[own, p] += STEPS[step[own] % len(STEPS)]
            near[:, t, k] = _name(moved, t)
    return home, near


def _column(column: pa.Array) -> np.ndarray:
    """Directions of vectors of one length."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _by_length(column: pa.Array) -> Iterator[np.ndarray]:
    sizes = np.array(column.value_lengths())
    for n in np.unique(sizes):
        yield np.flatnonzero(sizes == n)


def _entries(tables: int, probes: int, scale: float, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                piece = batch.slice(start, 1024)
                for which in _by_length(piece.column(1)):
                    unit = _column(piece.column(1).take(pa.array(which)))
                    home, near = cells(unit, tables, probes, scale, blocks)
                    names = np.concatenate([home[:, :, None], near], 2).reshape(len(which), -1)
                    rep = piece.column(0).take(pa.array(which)).to_numpy()
                    at_home = np.tile(np.arange(probes + 1) == 0, len(which) * tables)
                    dim = mix(np.array([unit.shape[1]], np.uint64))[0]
                    yield pa.RecordBatch.from_arrays([pa.array((names ^ dim).ravel().view(np.int64)), pa.array(np.repeat(rep, names.shape[1])), pa.array(at_home)], names=["cell", "rep", "home"])

    return run


def _pairs(threshold: float):
    """The pairs of rows (a, b, vector of a, vector of b) that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for which in _by_length(batch.column(2)):
                part = batch.take(pa.array(which))
                near = (_column(part.column(2)) * _column(part.column(3))).sum(1) >= threshold
                yield part.select([0, 1]).filter(pa.array(near))

    return run


def _group_links(threshold: float):
    """Links between different labels of groups given as lists, one for each pair of labels that a row meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                docs = batch.column(0).slice(row, 1).flatten()
                rep, label = (docs.field(x).to_numpy() for x in ("rep", "label"))
                unit = _column(docs.field("vector"))
                found = [np.zeros((2, 0), np.int64)]
                kinds, kind = np.unique(label, return_inverse=True)
                for at in range(0, len(rep), 256):
                    i, j = np.nonzero((unit[at : at + 256] @ unit.T >= threshold) & (kind[at : at + 256, None] < kind[None, :]))
                    first = np.unique(kind[i + at] * len(kinds) + kind[j], return_index=True)[1]
                    found.append(np.stack([rep[i[first] + at], rep[j[first]]]))
                a, b = np.concatenate(found, 1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _counts(threshold: float):
    """Links of each row of groups given as lists: with the other half of the group, or with all others if it has no halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                docs = batch.column(0).slice(row, 1).flatten()
                rep, many, half = (docs.field(x).to_numpy() for x in ("rep", "many", "half"))
                unit = _column(docs.field("vector"))
                n = np.zeros(len(rep), np.int64)
                for at in range(0, len(rep), 256):
                    near = unit[at : at + 256] @ unit.T >= threshold
                    near &= (half[at : at + 256, None] != half[None, :]) | (half[at : at + 256, None] < 0)
                    near[np.arange(len(near)), at + np.arange(len(near))] = False
                    n[at : at + 256] = near @ many
                yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(n)], names=["rep", "n"])

    return run


def _angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Angle of each row's vector to its pole."""
    for batch in batches:
        for which in _by_length(batch.column(2)):
            part = batch.take(pa.array(which))
            cosine = (_column(part.column(2)) * _column(part.column(3))).sum(1)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.arccos(np.clip(cosine, -1, 1)))], names=["rep", "label", "angle"])


class _Join:
    def __init__(self, vectors: DataFrame, threshold: float, tables: int, probes: int, scale: float, blocks: int, limit: int) -> None:
        self.threshold, self.lattice, self.limit = threshold, (tables, probes, scale, blocks), limit
        self.scratch = Scratch(vectors.sparkSession, "vectors")
        kind = vectors.schema["vector"].dataType.simpleString()
        vector = F.col("vector").cast(kind if kind == "array<float>" else "array<double>")
        valid = F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0), F.lit(False))
        rows = vectors.select("id", F.when(valid, vector).alias("vector"))
        self.rows = self.scratch.keep(rows.withColumn("h1", F.when(F.col("vector").isNotNull(), F.xxhash64("vector"))).withColumn("h2", F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(1), "vector"))), "rows")
        classes = self.rows.where("vector is not null").groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count("*").alias("many"), F.any_value("vector").alias("vector"))
        # A number of its own for each class, scrambled one to one, so the least of a cell is a random choice that cells share.
        self.classes = self.scratch.keep(classes.withColumn("rep", F.xxhash64(F.monotonically_increasing_id())), "classes")
        self.labels: DataFrame | None = None
        self.n_labels = 0

    def vector(self, rows: DataFrame, rep: str, name: str) -> DataFrame:
        return rows.join(self.classes.select(F.col("rep").alias(rep), F.col("vector").alias(name)), rep)

    def labelled(self, rows: DataFrame) -> DataFrame:
        if self.labels is None:
            return rows.withColumn("label", F.col("rep"))
        found = self.labels.select(F.col("node").alias("rep"), F.col("label").alias("_found"))
        return rows.join(light(found, self.n_labels), "rep", "left").withColumn("label", F.coalesce("_found", "rep")).drop("_found")

    def connect(self) -> None:
        """Labels of the components that links within cells connect."""
        keep, limit, threshold = self.scratch.keep, self.limit, self.threshold
        entries = keep(self.classes.select("rep", "vector").mapInArrow(_entries(*self.lattice), "cell long, rep long, home boolean"), "entries")
        shared = entries.groupBy("cell").agg(F.count("*").alias("size"), F.min(F.when(F.col("home"), F.col("rep"))).alias("pole"))
        shared, n_cells = self.scratch.counted(shared.where("size > 1 and pole is not null"), "cells")
        members = keep(entries.join(light(shared, n_cells), "cell"), "members")
        stars = members.where("rep <> pole").select(F.least("rep", "pole").alias("a"), F.greatest("rep", "pole").alias("b")).distinct()
        linked = self.vector(self.vector(stars, "a", "x"), "b", "y").select("a", "b", "x", "y").mapInArrow(_pairs(threshold), "a long, b long")
        links = keep(linked, "links")
        self.labels, self.n_labels = components(links, self.scratch)
        whole = self.labelled(members.where("size > 2").select("cell", "rep", "size"))
        states = whole.groupBy("cell", "size", "label").agg(F.count("*").alias("of")).groupBy("cell", "size").agg(F.max(F.struct("of", "label")).alias("most")).where("most.of < size")
        states = states.select("cell", F.col("most.label").alias("main"), F.ceil(F.col("most.of") / limit).cast("int").alias("mains"), F.ceil((F.col("size") - F.col("most.of")) / limit).cast("int").alias("others"))
        states, n_open = self.scratch.counted(states, "states")
        if not n_open:
            return
        rows = whole.join(light(states, n_open), "cell")
        # Vectors apart from the cell's main component meet each other and those of it, part by part.
        is_main = F.col("label") == F.col("main")
        part = F.pmod(F.xxhash64("rep"), F.when(is_main, F.col("mains")).otherwise(F.col("others"))).cast("int")
        every = F.sequence(F.lit(0), F.col("others") - 1)
        with_main = F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda m: F.struct(part.alias("low"), (-1 - m).alias("high")))
        groups = F.when(is_main, F.transform(every, lambda o: F.struct(o.alias("low"), (-1 - part).alias("high")))).otherwise(F.concat(with_main, F.transform(every, lambda o: F.struct(F.least(part, o).alias("low"), F.greatest(part, o).alias("high")))))
        dealt = self.vector(rows.select("cell", "rep", "label", F.explode(groups).alias("at")), "rep", "vector")
        lists = dealt.groupBy("cell", "at").agg(F.collect_list(F.struct("rep", "label", "vector")).alias("docs"), F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h").select("docs")
        more = keep(lists.mapInArrow(_group_links(threshold), "a long, b long"), "links")
        self.labels, self.n_labels = components(links.union(more), self.scratch)

    def count(self) -> DataFrame | None:
        """``rep`` and ``n``, its links with other classes' rows."""
        if self.labels is None:
            return None
        limit, threshold = self.limit, self.threshold
        rows = self.classes.select("rep", "many").join(light(self.labels.withColumnRenamed("node", "rep"), self.n_labels), "rep")
        sizes, seen = rows.groupBy("label").agg(F.count("*").alias("size")), Observation()
        sizes = self.scratch.keep(sizes.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col("size") > limit).alias("large")), "sizes")
        rows = rows.join(light(sizes, seen.get["n"]), "label")
        fields = F.struct("rep", "many", "half", "vector")
        small = self.vector(rows.where(f"size <= {limit}").withColumn("half", F.lit(-1)), "rep", "vector")
        lists = small.groupBy("label").agg(F.collect_list(fields).alias("docs")).select("docs")
        counts = self.scratch.keep(lists.mapInArrow(_counts(threshold), "rep long, n long"), "counts")
        if not seen.get["large"]:
            return counts
        large = self.vector(rows.where(f"size > {limit}"), "rep", "vector")
        poles = light(self.vector(sizes.where(f"size > {limit}").select("label", F.col("label").alias("pole")), "pole", "at").select("label", "at"), seen.get["large"])
        angle = large.join(poles, "label").select("rep", "label", "vector", "at").mapInArrow(_angles, "rep long, label long, angle double")
        reach = float(np.arccos(threshold))
        step, slack = reach / 8, 1e-7
        rings = self.scratch.keep(angle.join(rows.select("rep", "many"), "rep").withColumn("ring", F.floor(F.col("angle") / step).cast("int")), "rings")
        totals = self.scratch.keep(rings.groupBy("label", "ring").agg(F.count("*").alias("rows"), F.sum("many").alias("many")), "totals")
        one = totals.select("label", F.col("ring").alias("r"), F.ceil(F.col("rows") / limit).cast("int").alias("parts"))
        two = totals.select("label", F.col("ring").alias("s"), F.col("many").alias("all"), F.ceil(F.col("rows") / limit).cast("int").alias("others"))
        near = (F.col("r") + F.col("s") + 2) * step <= reach - slack
        apart = (F.abs(F.col("r") - F.col("s")) - 1) * step > reach + slack
        pairs = self.scratch.keep(one.join(two, "label").where(~apart).withColumn("near", near), "pairs")
        sure = rings.join(pairs.where("near").groupBy("label", F.col("r").alias("ring")).agg(F.sum("all").alias("all"), F.max(F.col("r") == F.col("s")).alias("own")), ["label", "ring"])
        sure = sure.select("rep", (F.col("all") - F.when(F.col("own"), F.col("many")).otherwise(0)).cast("long").alias("n"))
        # The other pairs of rings are compared part by part: a row goes to every part of the other ring.
        part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
        dealt = rings.withColumnRenamed("ring", "r").join(pairs.where("not near"), ["label", "r"]).withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
        mine, yours = F.struct(F.col("r").alias("ring"), F.col("part")), F.struct(F.col("s").alias("ring"), F.col("other").alias("part"))
        dealt = dealt.select("rep", "many", "label", F.least(mine, yours).alias("low"), F.greatest(mine, yours).alias("high"), F.when(mine == yours, -1).when(mine < yours, 0).otherwise(1).alias("half"))
        lists = self.vector(dealt, "rep", "vector").groupBy("label", "low", "high").agg(F.collect_list(fields).alias("docs")).select("docs")
        return counts.union(sure).union(lists.mapInArrow(_counts(threshold), "rep long, n long"))


def links_of(vectors: DataFrame, threshold: float = 0.95, tables: int = 12, probes: int = 8, scale: float = 0.5, blocks: int = 3, limit: int = 512, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row a vector: ``id_col``, ``n_links``, ``component_id`` and ``kept``."""
    join = _Join(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")), threshold, tables, probes, scale, blocks, limit)
    join.connect()
    counts = join.count()
    classes = join.labelled(join.classes.select("h1", "h2", "id", "many", "rep"))
    least = classes.groupBy("label").agg(F.min("id").alias("least"))
    classes = classes.join(least, "label")
    classes = classes.join(counts.groupBy("rep").agg(F.sum("n").alias("n")), "rep", "left") if counts is not None else classes.withColumn("n", F.lit(None).cast("long"))
    out = join.rows.select("id", "h1", "h2").join(classes.select("h1", "h2", "many", "least", "n"), ["h1", "h2"], "left")
    component = F.coalesce("least", "id")
    links = F.coalesce(F.col("many") - 1 + F.coalesce("n", F.lit(0)), F.lit(0))
    return out.select(F.col("id").alias(id_col), links.cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
