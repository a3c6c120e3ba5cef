"""Decisions that depend on the last row that was accepted, not on the row before.

Such a fold looks sequential, but the row that follows an accepted one is known for
every row at once: the first, in order, that an accepted row lets pass. These
successors are found by windows over fine keys, and the accepted rows are those that
can be reached from each key's first one. Pointer doubling finds them in as many
rounds as the longest chain has binary digits, so one key with a third of all rows
is spread over all tasks like any other. Requests under a budget have so many short
steps that their chains are first contracted, block by block.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from folioforge.session import kept


def first_from(rows: DataFrame, queries: DataFrame, part: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``of`` and ``found``: for each of ``queries`` the ``node`` of the first row of its part at or after it.

    ``rows`` has ``part``, ``order`` and ``node``; ``queries`` has ``part``, ``order`` and ``of``. No pairs are formed.
    """
    none = lambda frame, name: F.lit(None).cast(frame.schema[name].dataType).alias(name)
    line = rows.select(*part, *order, "node", none(queries, "of")).union(queries.select(*part, *order, none(rows, "node"), "of"))
    back = Window.partitionBy(*part).orderBy(*[F.desc(c) for c in order], F.col("of").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return line.withColumn("found", F.last("node", ignorenulls=True).over(back)).where("of is not null").select("of", "found")


def reached(starts: DataFrame, jumps: DataFrame) -> DataFrame:
    """The ``node``s that follow from ``starts`` by ``jumps`` (``node``, ``next``), starts included; chains don't meet."""
    found = [kept(starts.select("node"), "reached")]
    jumps = kept(jumps.where("next is not null").select("node", "next"), "jumps")
    while True:
        seen, all_found = Observation(), reduce(DataFrame.union, found)
        new = kept(all_found.join(jumps, "node").select(F.col("next").alias("node")).observe(seen, F.count(F.lit(1)).alias("n")), "reached")
        if not seen.get["n"]:
            return all_found
        found.append(new)
        onward = jumps.select(F.col("node").alias("next"), F.col("next").alias("further"))
        jumps = kept(jumps.join(onward, "next").select("node", F.col("further").alias("next")), "jumps")


def attempts(rows: DataFrame, keys: Sequence[str], at: str, row_id: str, ok: str, wait: int) -> DataFrame:
    """Adds ``decision``: ``attempt``, ``done`` or ``waiting``.

    The first row of a key is an attempt. After one that is ``ok`` the key is done for
    ever; after a failed one the next attempt is the first row at least ``wait`` later,
    and rows between are waiting. ``at`` and ``wait`` are whole numbers of one unit,
    ``keys`` and ``row_id`` tell rows apart, and ties of ``at`` go by ``row_id``. A null
    ``ok`` is a failure; rows with a null key, time or id get no decision. An empty table
    stays empty.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    known = rows.dropna(subset=[*keys, at, row_id])
    known = known.select(*[F.col(c).alias(n) for c, n in zip(keys, names, strict=True)], F.col(at).cast("long").alias("at"), F.col(row_id).alias("id"), F.coalesce(F.col(ok), F.lit(False)).alias("ok"))
    known = kept(known.withColumn("node", F.struct(*names, "id")).withColumn("span", F.floor(F.col("at") / wait)), "attempts")
    part = [*names, "span"]
    # A failed row's successor stands in the next span, or is the first row of a later one. No id sorts before all rows of its time.
    failed = known.where(~F.col("ok")).select(*names, (F.col("span") + 1).alias("span"), (F.col("at") + wait).alias("at"), F.lit(None).cast(known.schema["id"].dataType).alias("id"), F.col("node").alias("of"))
    near = first_from(known, failed, part, ["at", "id"])
    spans = known.groupBy(*part).agg(F.min(F.struct("at", "id")).alias("f")).select(*part, F.struct(*names, F.col("f.id").alias("id")).alias("node"))
    asked = failed.select(*names, (F.col("span") + 1).alias("span")).distinct().withColumn("of", F.struct(*part))
    later = first_from(spans, asked, names, ["span"]).select(*[F.col(f"of.{n}").alias(n) for n in names], (F.col("of.span") - 1).alias("span"), F.col("found").alias("beyond"))
    jumps = failed.select(*part, "of").join(near, "of").join(later, part).select(F.col("of").alias("node"), F.coalesce("found", "beyond").alias("next"))
    starts = known.groupBy(*names).agg(F.min(F.struct("at", "id")).alias("f")).select(F.struct(*names, F.col("f.id").alias("id")).alias("node"))
    decided = known.join(reached(starts, jumps).withColumn("accepted", F.lit(True)), "node", "left")
    ends = decided.where("accepted and ok").select(*names, F.struct("at", "id").alias("end"))
    decision = F.when(F.col("accepted"), "attempt").when(F.struct("at", "id") > F.col("end"), "done").otherwise("waiting")
    decided = decided.join(ends, names, "left").select(*names, F.col("id").alias("_id"), decision.alias("decision"))
    on = [F.col(f"r.{c}") == F.col(f"d.{n}") for c, n in zip(keys, names, strict=True)] + [F.col(f"r.{row_id}") == F.col("d._id")]
    return rows.alias("r").join(decided.alias("d"), on, "left").select("r.*", "d.decision")


def versioned(objects: DataFrame, changes: DataFrame, transitions: Sequence[tuple[str, str, str]] | None = None) -> DataFrame:
    """``changes`` with ``accepted``, and for accepted ones the ``version`` and ``status`` that they lead to.

    ``objects`` has ``key``, ``version`` and ``status``; ``changes`` has ``key``, ``place``
    (their order, unique within a key), ``expected`` and ``action``. A change counts if it
    names the version that its object has by then and ``transitions`` (status before,
    action, status after) allow it; then the version grows by one. Without transitions
    every action is allowed and leaves the status. A refused change moves nothing. Changes
    of unknown objects, and with a null key, place, version or action, are refused.
    """
    asked = changes.dropna(subset=["key", "place", "expected", "action"]).select("key", "place", "expected", "action")
    if transitions is None:
        moves = asked.join(objects.select("key", F.coalesce("status", F.lit("")).alias("before")), "key").withColumn("after", F.col("before"))
    else:
        table = F.create_map(*[x for action in sorted({a for _, a, _ in transitions}) for x in (F.lit(action), F.array(*[F.struct(F.lit(b).alias("before"), F.lit(c).alias("after")) for b, a, c in transitions if a == action]))])
        moves = asked.withColumn("_m", F.explode(F.try_element_at(table, F.col("action")))).select("key", "place", "expected", "action", "_m.before", "_m.after")
    # A node is a change together with the status that it meets.
    moves = kept(moves.withColumn("node", F.struct("key", "place", "before")), "moves")
    part, rows = ["key", "expected", "before"], moves.select("key", "expected", "before", "place", "node")
    onward = moves.select("key", (F.col("expected") + 1).alias("expected"), F.col("after").alias("before"), "place", F.col("node").alias("of"))
    begin = objects.dropna(subset=["key", "version"]).select("key", F.col("version").cast(moves.schema["expected"].dataType).alias("expected"), F.coalesce("status", F.lit("")).alias("before"))
    begin = begin.withColumn("place", F.lit(None).cast(moves.schema["place"].dataType)).withColumn("of", F.struct("key"))
    jumps = first_from(rows, onward, part, ["place"]).select(F.col("of").alias("node"), F.col("found").alias("next"))
    starts = first_from(rows, begin, part, ["place"]).select(F.col("found").alias("node")).where("node is not null")
    found = reached(starts, jumps).join(moves, "node").select("key", "place", F.lit(True).alias("accepted"), (F.col("expected") + 1).alias("version"), F.col("after").alias("status"))
    return changes.join(found, ["key", "place"], "left").withColumn("accepted", F.coalesce("accepted", F.lit(False)))


#: Items of a block, which one task folds.
BLOCK_ROWS = 1 << 16


def _requests(sizes: np.ndarray, firsts: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block whose keys begin at ``firsts``: sums before and through each item within its key, the end of its key, and where the next request begins if one begins with it."""
    ends = np.cumsum(sizes)
    lengths = np.diff(np.append(firsts, len(sizes)))
    stop = np.repeat(firsts + lengths, lengths)
    after = np.searchsorted(ends, ends - sizes + budget, "right")
    before = np.repeat((ends - sizes)[firsts], lengths)
    return ends - sizes - before, ends - before, stop, np.minimum(np.maximum(after, np.arange(1, len(sizes) + 1)), stop)


def _ways(sizes: np.ndarray, firsts: np.ndarray, budget: int) -> dict[str, np.ndarray]:
    """The items that a request from before the block may give way to, and the place and number of the last of the requests that follow from each."""
    begin, end, stop, after = _requests(sizes, firsts, budget)
    last, count = list(range(len(sizes))), [1] * len(sizes)
    for i, (n, s) in reversed(list(enumerate(zip(after.tolist(), stop.tolist(), strict=True)))):
        if n < s:
            last[i], count[i] = last[n], count[n] + 1
    at = np.flatnonzero(begin <= budget)
    return {"at": at, "end": end[at], "last": begin[np.array(last)[at]], "n": np.array(count)[at], "total": end[stop[at] - 1], "beyond": stop[at]}


def _numbers(sizes: np.ndarray, firsts: np.ndarray, entries: list[int | None], before: np.ndarray, budget: int) -> np.ndarray:
    """Each item's request, if of each key ``before`` ones began before the block, and at ``entries`` the first within it."""
    _, _, stop, after = _requests(sizes, firsts, budget)
    begins, after = np.zeros(len(sizes), np.int64), after.tolist()
    for at, end in zip(entries, stop[firsts].tolist(), strict=True):
        while at is not None and at < end:
            begins[at] = 1
            at = after[at]
    total = np.cumsum(begins)
    return total + np.repeat(before - (total - begins)[firsts], np.diff(np.append(firsts, len(sizes))))


def packed(items: DataFrame, keys: Sequence[str], place: str, size: str, budget: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``items`` with ``request``, from 1: a key's items go in order into requests of at most ``budget``.

    An item joins the request of the one before it if it fits, else it begins the next
    one, and no request is filled up later; one larger than the budget has a request of
    its own. Sizes are whole numbers; null and negative ones
    count as 0. ``place`` is unique within a key. Rows with a null key or place get no
    request; an empty table stays empty.

    Items are cut, in order, into blocks of ``block_rows``. A block tells for each of the few
    items that a request from before it can give way to where the last request that follows
    begins. Pointer doubling goes over these only, so its rows and rounds follow the blocks;
    then every block numbers its items.
    """
    names, width = [f"_k{i}" for i in range(len(keys))], budget + 1
    lost = reduce(or_, [F.col(c).isNull() | F.isnan(c) if items.schema[c].dataType.typeName() in ("float", "double") else F.col(c).isNull() for c in [*keys, place]])
    weight = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long").alias("size")
    rows = items.where(~lost).select(*[F.col(c).alias(n) for c, n in zip(keys, names, strict=True)], F.col(place).alias("place"), weight, F.struct(*[F.col(c) for c in items.columns]).alias("item"))
    rows = rows.repartitionByRange(*names, "place").sortWithinPartitions(*names, "place").withColumn("row", F.monotonically_increasing_id())
    rows = kept(rows.drop("place").withColumn("block", F.floor(F.col("row") / block_rows)), "items")

    def ways(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        new = np.zeros(len(table), bool)
        for n in names:
            column = table[n].combine_chunks()
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        new[0] = True
        row, told = table["row"].to_numpy(), _ways(table["size"].to_numpy(), np.flatnonzero(new), budget)
        at, beyond = told.pop("at"), told.pop("beyond")
        return pa.table({n: table[n].take(pa.array(at)) for n in (*names, "block", "row")} | told | {"beyond": row[beyond - 1] + 1})

    types = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    found = kept(rows.select(*names, "block", "row", "size").groupBy("block").applyInArrow(ways, f"{types}, block long, row long, `end` long, last long, n long, total long, beyond long"), "ways")
    earlier = Window.partitionBy(*names).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = found.groupBy(*names, "block").agg(F.min("row").alias("first"), F.first("total").alias("total"))
    sums = sums.withColumn("base", F.coalesce(F.sum("total").over(earlier), F.lit(0))).drop("total")
    found = found.join(sums, [*names, "block"]).withColumn("node", F.struct(*names, "row"))
    # The next request begins with the first item beyond the block that ends beyond the last one's budget, or that follows one too large itself.
    full = F.greatest(F.col("base") + F.col("last") + width, F.col("base") + F.col("total"))
    span = F.floor(F.col("end") / width).alias("span")
    entries = kept(found.select(*names, "node", "row", (F.col("base") + F.col("end")).alias("end")).select("*", span), "entries")
    ask = kept(found.select(*names, F.col("node").alias("of"), F.col("beyond").alias("row"), full.alias("end")).select("*", span), "asked")
    part = [*names, "span"]
    near = first_from(entries, ask, part, ["end", "row"])
    spans = entries.groupBy(*part).agg(F.min("row").alias("row")).select(*part, F.struct(*names, "row").alias("node"))
    asked = ask.select(*names, (F.col("span") + 1).alias("span")).distinct().withColumn("of", F.struct(*part))
    later = first_from(spans, asked, names, ["span"]).select(*[F.col(f"of.{n}").alias(n) for n in names], (F.col("of.span") - 1).alias("span"), F.col("found").alias("beyond"))
    jumps = ask.select(*part, "of").join(near, "of").join(later, part).select(F.col("of").alias("node"), F.coalesce("found", "beyond").alias("next"))
    starts = entries.groupBy(*names).agg(F.min("row").alias("row")).select(F.struct(*names, "row").alias("node"))
    entered = found.join(reached(starts, jumps), "node").select(*names, "block", F.col("row").alias("entry"), "n")
    blocks = sums.join(entered, [*names, "block"], "left").withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))

    def number(table: pa.Table, block: pa.Table) -> pa.Table:
        table, block = table.sort_by("row"), block.sort_by("first")
        row = table["row"].to_numpy()
        entries = [None if e is None else int(np.searchsorted(row, e)) for e in block["entry"].to_pylist()]
        told = _numbers(table["size"].to_numpy(), np.searchsorted(row, block["first"].to_numpy()), entries, block["before"].to_numpy(), budget)
        return pa.table({"item": table["item"], "request": told})

    told = rows.select("block", "row", "size", "item").groupBy("block").cogroup(blocks.select("block", "first", "entry", "before").groupBy("block"))
    told = told.applyInArrow(number, f"item {rows.schema['item'].dataType.simpleString()}, request long")
    return told.select("item.*", "request").union(items.where(lost).withColumn("request", F.lit(None).cast("long")))
