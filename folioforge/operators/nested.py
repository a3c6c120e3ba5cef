"""Validation of nested records of any depth, level by level.

A record is a variant. A level's nodes are rows (document, path, place, kind, value);
each is checked against the shape of its kind, and its children are exploded into the
next level's rows. What was found goes on with the first child, so all levels of a shape
that ends are one pass over the records; a shape that refers to itself is written every
few levels and followed as deep as its records go. All faults of a record are found, not
the first one only.

A shape is a dictionary of kinds, each one of

* ``("object", {key: (kind, required)})``: those keys and no others;
* ``("array", kind)``;
* ``("attributes", pattern, forbidden)``: an object of scalars with such keys;
* ``("text",)``, ``("filled",)`` (not blank) or ``("id",)`` (filled, and once only in the whole record).

``root`` is the kind of the whole. Kinds may refer to each other in circles.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from folioforge.functions.values import cell_problem
from folioforge.operators.hierarchy import CATEGORIES
from folioforge.session import kept

Shape = Mapping[str, tuple]

#: Keys of attributes and those that are forbidden: fixed values of the record format.
ATTRIBUTE = r"\A[a-z][a-z0-9_]*\z"
FORBIDDEN = ("form_order", "form_index", "form_sequence", "instance")

_OBJECTS = {c: (f"{c}_list", False) for c in CATEGORIES}
_COMMON = {
    "attributes": ("attributes", ATTRIBUTE, FORBIDDEN),
    "text": ("text",),
    "filled": ("filled",),
    "id": ("id",),
} | {f"{c}_list": ("array", "thing") for c in CATEGORIES}
#: Batches whose steps name their form and carry ids.
FLAT: Shape = _COMMON | {
    "root": ("object", {"batch": ("filled", True), "process": ("processes", True)}),
    "processes": ("array", "process"),
    "process": ("object", {"subprocess": ("text", True), "step": ("steps", True)}),
    "steps": ("array", "step"),
    "step": ("object", {"id": ("id", True), "stage": ("text", True), "form": ("text", True), **_OBJECTS}),
    "thing": ("object", {"id": ("id", True), "name": ("text", True), "attributes": ("attributes", True)}),
}
#: Batches of processes, subprocesses, steps and forms.
DEEP: Shape = _COMMON | {
    "root": ("object", {"batch": ("filled", True), "process": ("processes", True)}),
    "processes": ("array", "process"),
    "process": ("object", {"name": ("text", True), "subprocess": ("subprocesses", True)}),
    "subprocesses": ("array", "subprocess"),
    "subprocess": ("object", {"name": ("text", True), "step": ("steps", True)}),
    "steps": ("array", "step"),
    "step": ("object", {"name": ("text", True), "form": ("forms", True)}),
    "forms": ("array", "form"),
    "form": ("object", {"name": ("text", True), **_OBJECTS}),
    "thing": ("object", {"name": ("text", True), "attributes": ("attributes", True)}),
}


def _map(pairs: list[tuple[str, Column]], empty: str) -> Column:
    return F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)]) if pairs else F.expr(empty)


def _strings(values) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


#: What a node has to tell: a fault, or (without one) the name and place of an id.
_FOUND = "struct<path:string,fault:string,name:string,place:array<int>>"
_NONE = f"cast(array() as array<{_FOUND}>)"


def _found(fault: Column, name: Column | None = None) -> Column:
    place = F.lit(None).cast("array<int>") if name is None else F.col("place")
    return F.struct(F.col("path"), fault.cast("string").alias("fault"), (F.lit(None).cast("string") if name is None else name).alias("name"), place.alias("place"))


def _below(shape: Shape, kinds: set[str]) -> set[str]:
    """The kinds of the next level's nodes; those of attributes are ``attributes.``."""
    out = set()
    for form, *rest in (shape[k] for k in kinds if k in shape):
        out |= {c for c, _ in rest[0].values()} if form == "object" else {rest[0]} if form == "array" else set()
    return out | {f"{k}." for k in kinds if k in shape and shape[k][0] == "attributes"}


def _level(nodes: DataFrame, shape: Shape, kinds: set[str]) -> DataFrame:
    """The next level's nodes; ``found`` of a node and of those above goes on with its first child, or alone."""
    of = {f: [k for k in sorted(kinds) if k in shape and shape[k][0] == f] for f in ("object", "array", "attributes", "text", "filled", "id")}
    kind, value = F.col("kind"), F.col("value")
    members, elements, leaves = of["object"] + of["attributes"], of["array"], of["text"] + of["filled"] + of["id"]
    scalars = sorted(k for k in kinds if k.endswith("."))
    typed = nodes
    if members:
        typed = typed.withColumn("_m", F.when(kind.isin(*members), F.try_variant_get(value, "$", "map<string,variant>")))
    if elements:
        typed = typed.withColumn("_a", F.when(kind.isin(*elements), F.try_variant_get(value, "$", "array<variant>")))
    if leaves or scalars:
        typed = typed.withColumn("_type", F.when(kind.isin(*leaves, *scalars), F.schema_of_variant(value)))
        typed = typed.withColumn("_text", F.when(F.col("_type") == "STRING", F.try_variant_get(value, "$", "string")))
    found: list[Column] = []
    if "root" in kinds:
        found.append(F.when(value.isNull() & (kind == "root"), _found(F.lit("not a record"))))
    if members:
        found.append(F.when(value.isNotNull() & kind.isin(*members) & F.col("_m").isNull(), _found(F.lit("expected an object"))))
    if elements:
        found.append(F.when(value.isNotNull() & kind.isin(*elements) & F.col("_a").isNull(), _found(F.lit("expected an array"))))
    for k in of["object"]:
        required, allowed = [n for n, (_, must) in shape[k][1].items() if must], list(shape[k][1])
        for word, names in (("missing ", F.array_except(_strings(required), F.map_keys("_m"))), ("unsupported ", F.array_except(F.map_keys("_m"), _strings(allowed)))):
            found.append(F.when((kind == k) & F.col("_m").isNotNull() & (F.size(names) > 0), _found(F.concat(F.lit(word), F.array_join(F.sort_array(names), ",")))))
    if leaves:
        text = F.col("_text")
        blank = F.when(kind.isin(*of["filled"], *of["id"]) & (F.trim(text) == ""), "blank") if of["filled"] or of["id"] else F.lit(None).cast("string")
        fault = F.when(F.col("_type") != "STRING", "expected a string").when(cell_problem(text).isNotNull(), "not a cell's text").otherwise(blank)
        found.append(F.when(value.isNotNull() & kind.isin(*leaves) & fault.isNotNull(), _found(fault)))
    if of["id"]:
        found.append(F.when(kind.isin(*of["id"]) & (F.trim("_text") != ""), _found(F.lit(None), F.col("_text"))))
    for k in scalars:
        _, pattern, forbidden = shape[k[:-1]]
        name = F.col("name")
        fault = F.when(~name.rlike(pattern) | name.isin(*forbidden), "unsupported field").when(F.col("_type").rlike(r"\A(OBJECT|ARRAY)"), "not a scalar").when(cell_problem(F.col("_text")).isNotNull(), "not a cell's text")
        found.append(F.when((kind == k) & fault.isNotNull(), _found(fault)))
    typed = typed.withColumn("found", F.when(F.coalesce(*found).isNotNull(), F.concat("found", F.array_compact(F.array(*found)))).otherwise(F.col("found")))
    # Objects' children have names, arrays' have none.
    none = "cast(null as array<struct<key:string,value:variant>>)"
    inside = F.expr(none)
    if members:
        inside = F.map_entries("_m")
    if elements:
        listed = F.arrays_zip(F.expr("cast(array() as array<string>)").alias("key"), F.col("_a").alias("value"))
        inside = F.coalesce(inside, listed) if members else listed
    inner = typed.select("id", "record", "path", "place", "kind", "found", F.posexplode_outer(inside).alias("at", "child"))
    name = F.col("child.key")
    slots = [(f"{k}.{n}", c, i) for k in of["object"] for i, (n, (c, _)) in enumerate(shape[k][1].items())]
    slot = F.concat_ws(".", "kind", name)
    member = F.when(kind.isin(*of["attributes"]), F.concat("kind", F.lit("."))) if of["attributes"] else F.lit(None).cast("string")
    if slots:
        member = F.coalesce(F.try_element_at(_map([(s, F.lit(c)) for s, c, _ in slots], ""), slot), member)
    element = F.try_element_at(_map([(k, F.lit(shape[k][1])) for k in elements], "cast(map() as map<string,string>)"), kind)
    place = F.try_element_at(_map([(s, F.lit(i)) for s, _, i in slots], "cast(map() as map<string,int>)"), slot)
    under = inner.select(
        "id",
        "record",
        F.when(name.isNull(), F.concat("path", F.lit("["), F.col("at"), F.lit("]"))).otherwise(F.concat("path", F.lit("."), name)).alias("path"),
        F.array_append("place", F.coalesce(place, F.col("at")).cast("int")).alias("place"),
        F.when(F.col("child").isNotNull(), F.when(name.isNull(), element).otherwise(member)).alias("kind"),
        name.alias("name"),
        F.col("child.value").alias("value"),
        F.when(F.coalesce(F.col("at"), F.lit(0)) == 0, F.col("found")).otherwise(F.expr(_NONE)).alias("found"),
    )
    return under.where(F.col("kind").isNotNull() | (F.size("found") > 0))


#: Levels of a shape that refers to itself between two writes.
LEVELS = 6


def validate(records: DataFrame, shape: Shape) -> DataFrame:
    """``id``, ``path`` and ``fault`` of every fault of ``records`` (``id``, ``value``: a variant).

    A null value is not a record. A key that an object repeats can't be in a variant: such
    texts don't parse, so they are null here. Ids that come again are faults of all but
    their first place, in the order of the shape's keys and of arrays. Ids of records need
    not be unique; an empty table gives none.
    """
    nodes = records.select("id", F.monotonically_increasing_id().alias("record"), F.lit("$").alias("path"), F.array().cast("array<int>").alias("place"), F.lit("root").alias("kind"), F.lit(None).cast("string").alias("name"), "value", F.expr(_NONE).alias("found"))
    kinds, told, level = {"root"}, None, 0
    while kinds:
        nodes, kinds, level = _level(nodes, shape, kinds), _below(shape, kinds), level + 1
        if kinds and level % LEVELS == 0 and _endless(shape, kinds):
            seen = Observation()
            nodes = kept(nodes.observe(seen, F.count_if(F.col("kind").isNotNull()).alias("n")), "nodes")
            part = _told(nodes)
            told = part if told is None else told.union(part)
            if not seen.get["n"]:
                break
            nodes = nodes.where("kind is not null").withColumn("found", F.expr(_NONE))
    else:
        told = _told(nodes) if told is None else told.union(_told(nodes))
    if any(s[0] == "id" for s in shape.values()):
        # Faults have no name: they stand in no order, and all are told.
        again = Window.partitionBy("id", "record", "name").orderBy("place")
        first = F.row_number().over(again) == 1
        told = told.withColumn("fault", F.when(F.col("name").isNotNull() & ~first, "duplicate id").otherwise(F.col("fault"))).where("fault is not null")
    return told.select("id", "path", "fault")


def _told(nodes: DataFrame) -> DataFrame:
    return nodes.select("id", "record", F.explode("found").alias("f")).select("id", "record", "f.*")


def _endless(shape: Shape, kinds: set[str]) -> bool:
    for _ in shape:
        kinds = _below(shape, kinds)
    return bool(kinds)
