"""Deeply nested records to related flat tables (problem 7): shared inlining over a Spark schema.

The schema is a graph of record types. A struct that occurs once below its parent is inlined into the parent's table. A table of
its own goes to every element that repeats (arrays and maps), to every element that recurs below itself (the levels that a schema
spells out are one type and share one table), and, with `shared`, to every struct type that several places have. Every table has the
record's key; a child's row also has its place among its siblings and above, which together are its foreign key.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideglass.functions.timeparse import let
from tideglass.operators.ticks import one_per_id
from tideglass.session import materialise


@dataclass
class Place:
    """Where rows of a table are: steps (path of fields below the last element, whether that is a map) to open one below the other, then
    the path of fields below the last element."""

    steps: tuple[tuple[tuple[str, ...], bool], ...] = ()
    path: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return ".".join(x for path, _ in (*self.steps, (self.path, False)) for x in path)


@dataclass
class Table:
    """name; places; columns: (name, path of fields below the place). several: the rows of all places have columns place, at and parent
    instead of one column for each position."""

    name: str
    places: list[Place] = field(default_factory=list)
    columns: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)
    several: bool = False
    kind: T.StructType | None = None


def _signature(kind: T.StructType) -> tuple:
    return tuple(sorted((f.name.lower(), f.dataType.simpleString()) for f in kind.fields))


def _shared_types(kind: T.DataType, counts: dict[tuple, int]) -> dict[tuple, int]:
    """How many places have each struct type of at least two fields."""
    if isinstance(kind, T.StructType):
        if len(kind.fields) > 1:
            counts[_signature(kind)] = counts.get(_signature(kind), 0) + 1
        for f in kind.fields:
            _shared_types(f.dataType, counts)
    elif isinstance(kind, T.ArrayType):
        _shared_types(kind.elementType, counts)
    elif isinstance(kind, T.MapType):
        _shared_types(kind.valueType, counts)
    return counts


def analyse(schema: T.StructType, root: str = "record", key: str = "", shared: bool = False) -> list[Table]:
    """The tables of a record type. Names join the fields' names with `_`; where two columns of a table would have one name, the
    later one (or one with the key's name) gets a number. An array of arrays makes a table in a table."""
    tables: list[Table] = []
    common = {k for k, n in _shared_types(schema, {}).items() if n > 1} if shared else set()
    by_type: dict[tuple, Table] = {}

    def add(t: Table, name: str, path: tuple[str, ...]) -> None:
        own = {"place", "at", "parent"} if t.several else {"position", *(f"position_{i}" for i in range(len(t.places[0].steps)))}
        taken = {n.lower() for n, _ in t.columns} | {key.lower()} | own
        free, k = name, 2
        while free.lower() in taken:
            free, k = f"{name}_{k}", k + 1
        t.columns.append((free, path))

    def fresh(name: str, place: Place, several: bool = False, kind: T.StructType | None = None) -> Table:
        taken, free, k = {t.name for t in tables}, name, 2
        while free in taken:
            free, k = f"{name}_{k}", k + 1
        tables.append(Table(free, [place], several=several, kind=kind))
        return tables[-1]

    def walk(t: Table, kind: T.DataType, here: Place, path: tuple[str, ...], above: tuple[tuple[str, Table], ...]) -> None:
        """kind stands at `path` below `here`, a place of t. above: the repeated elements around it."""
        if isinstance(kind, T.StructType):
            if path and _signature(kind) in common:
                shared_place(kind, Place(here.steps, here.path + path), path[-1], above)
                return
            for f in kind.fields:
                walk(t, f.dataType, here, (*path, f.name), above)
        elif isinstance(kind, (T.ArrayType, T.MapType)):
            as_map = isinstance(kind, T.MapType)
            element = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)]) if as_map else kind.elementType
            label = "_".join(path) or "element"
            inner = Place((*here.steps, (here.path + path, as_map)))
            again = next((x for n, x in above if path and n == path[-1] and isinstance(element, T.StructType) and x.kind and {f.name for f in element.fields} <= {f.name for f in x.kind.fields}), None)
            if again:  # a level of a recursive element
                again.places.append(inner)
                descend(again, element, inner, above)
            elif isinstance(element, T.StructType) and not as_map and _signature(element) in common:
                shared_place(element, inner, path[-1] if path else "element", above)
            else:
                recursive = isinstance(element, T.StructType) and bool(path) and _recurs(element, path[-1])
                child = fresh(label if t is tables[0] else f"{t.name}_{label}", inner, recursive, element if isinstance(element, T.StructType) else None)
                if isinstance(element, (T.StructType, T.ArrayType, T.MapType)):
                    walk(child, element, inner, (), (*above, (path[-1] if path else "", child)))
                else:
                    add(child, "value", ())
        else:
            add(t, "_".join(path), path)

    def descend(t: Table, element: T.StructType, place: Place, above: tuple[tuple[str, Table], ...]) -> None:
        """Only what repeats below a further level or place: its own columns are the table's already."""
        def nested(kind: T.DataType, path: tuple[str, ...]) -> None:
            if isinstance(kind, T.StructType):
                if path and _signature(kind) in common:
                    walk(t, kind, place, path, above)
                    return
                for f in kind.fields:
                    nested(f.dataType, (*path, f.name))
            elif isinstance(kind, (T.ArrayType, T.MapType)):
                walk(t, kind, place, path, above)

        nested(element, ())

    def shared_place(kind: T.StructType, place: Place, name: str, above: tuple[tuple[str, Table], ...]) -> None:
        known = by_type.get(_signature(kind))
        if known:
            known.places.append(place)
            descend(known, kind, place, above)
        else:
            by_type[_signature(kind)] = t = fresh(name, place, True, kind)
            for f in kind.fields:
                walk(t, f.dataType, place, (f.name,), above)

    fresh(root, Place())
    walk(tables[0], schema, Place(), (), ())
    return tables


def _recurs(kind: T.StructType, name: str) -> bool:
    """Whether an array `name` of elements without fields of their own names is somewhere below elements of `name`."""
    names = {f.name for f in kind.fields}

    def below(k: T.DataType) -> bool:
        if isinstance(k, T.StructType):
            return any((f.name == name and isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType) and {x.name for x in f.dataType.elementType.fields} <= names) or below(f.dataType) for f in k.fields)
        return below(k.elementType) if isinstance(k, T.ArrayType) else False

    return below(kind)


def _below(at: Column, path: tuple[str, ...]) -> Column:
    for name in path:
        at = at.getField(name)
    return at


def _has(kind: T.DataType, path: tuple[str, ...]) -> bool:
    for name in path:
        if not isinstance(kind, T.StructType) or name not in kind.names:
            return False
        kind = kind[name].dataType
    return True


def _kind_at(kind: T.DataType, place: Place) -> T.DataType:
    def down(k: T.DataType, path: tuple[str, ...]) -> T.DataType:
        for name in path:
            k = k[name].dataType
        return k

    for path, as_map in place.steps:
        k = down(kind, path)
        kind = T.StructType([T.StructField("key", k.keyType), T.StructField("value", k.valueType)]) if as_map else k.elementType
    return down(kind, place.path)


def inline(records: DataFrame, key: str, record: str, root: str = "record", shared: bool = False) -> dict[str, DataFrame]:
    """The tables of the struct column `record`, by name, each with the column `key`.

    A child's `position` counts from 0 with null elements, which make no row; `position_i` are the positions above it. A table of
    several places has `place` (the fields on the way), `at` (all positions, from the record down) and `parent` (those of the row that
    holds it, or null if that is the record). Maps have `key` and `value`. Null and empty arrays and null structs make no child rows; a null
    record still makes its row of the root table."""
    kind = records.schema[record].dataType

    def at_place(t: Table, place: Place) -> DataFrame:
        rows, at, places = records, F.col(record), []
        for depth, (path, as_map) in enumerate(place.steps):
            spot, opened = f"__p{depth}", _below(at, path)
            rows = rows.select(key, *places, F.posexplode(F.map_entries(opened) if as_map else opened).alias(spot, f"__e{depth}"))
            at, places = F.col(f"__e{depth}"), [*places, spot]
            rows = rows.where(at.isNotNull())
        at = _below(at, place.path)
        if place.path:
            rows = rows.where(at.isNotNull())
        if t.several:
            spots = F.array(*map(F.col, places)).cast("array<int>")
            own = len(places) if place.path else len(places) - 1
            ids = [F.lit(place.name).alias("place"), spots.alias("at"), (F.slice(spots, 1, own) if own else F.lit(None).cast("array<int>")).alias("parent")]
        else:
            ids = [F.col(p).alias("position" if i == len(places) - 1 else f"position_{i}") for i, p in enumerate(places)]
        here = _kind_at(kind, place)
        return rows.select(key, *ids, *((_below(at, path) if _has(here, path) else F.lit(None)).alias(name) for name, path in t.columns))

    return {t.name: reduce(lambda x, y: x.unionByName(y), (at_place(t, p) for p in t.places)) for t in analyse(kind, root, key, shared)}


def _cast(v: Column, kind: T.DataType) -> Column:
    """A variant as `kind`: numbers may be text with thousands' commas, a single object may stand for an array; what doesn't fit is null."""
    if isinstance(kind, T.StructType):
        inner = lambda t: lambda x: _cast(x, t)
        fields = [let(F.try_variant_get(v, f"$['{f.name}']", "variant"), inner(f.dataType)).alias(f.name) for f in kind.fields]
        return F.when(F.schema_of_variant(v).startswith("OBJECT<"), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        single = F.when(v.isNotNull() & ~F.is_variant_null(v), F.array(v))
        return F.transform(F.coalesce(F.try_variant_get(v, "$", "array<variant>"), single), lambda x: _cast(x, kind.elementType))
    text = F.try_variant_get(v, "$", "string")
    if isinstance(kind, T.StringType):
        return text
    name = kind.simpleString()
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return let(F.trim(F.regexp_replace(text, "[,$]", "")), lambda x: F.coalesce(x.try_cast(name), x.try_cast("double").try_cast(name)))
    if isinstance(kind, T.DoubleType):
        return F.trim(F.regexp_replace(text, "[,$]", "")).try_cast(name)
    return F.lower(F.trim(text)).try_cast(name)


def read_json(payloads: DataFrame, payload: str, schema: T.StructType, record: str = "record") -> DataFrame:
    """payloads with `record`, the text as a struct of `schema`; null for null texts and texts that are no JSON object.
    Absent fields are null; what the schema doesn't know is in `unknown_fields`."""
    return payloads.withColumn("__v", F.try_parse_json(payload)).withColumn(record, _cast(F.col("__v"), schema)).drop("__v")


_UNKNOWN = "array<struct<place:string,field:string,value:string>>"


def _unknown(v: Column, kind: T.DataType, place: Column) -> Column:
    """What of a variant has no field in `kind`."""
    none = F.expr(f"cast(array() as {_UNKNOWN})")
    if isinstance(kind, T.StructType):
        held = F.map_entries(F.map_filter(F.try_variant_get(v, "$", "map<string,variant>"), lambda k, _: ~k.isin([f.name for f in kind.fields])))
        own = F.coalesce(F.transform(held, lambda e: F.struct(place.alias("place"), e["key"].alias("field"), F.to_json(e["value"]).alias("value"))), none)
        nested = [f for f in kind.fields if isinstance(f.dataType, (T.StructType, T.ArrayType))]
        return F.concat(own, *(_unknown(F.try_variant_get(v, f"$['{f.name}']", "variant"), f.dataType, F.concat(place, F.lit(f".{f.name}"))) for f in nested))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        single = F.when(v.isNotNull() & ~F.is_variant_null(v), F.array(v))
        elements = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), single)
        return F.coalesce(F.flatten(F.transform(elements, lambda x, i: _unknown(x, kind.elementType, F.concat(place, F.lit("["), i.cast("string"), F.lit("]"))))), none)
    return none


def unknown_fields(payloads: DataFrame, key: Column, payload: str, schema: T.StructType) -> DataFrame:
    """key, place, field, value: each field of the payloads that `schema` doesn't have, wherever it stands, with its value as JSON."""
    v = F.try_parse_json(payload)
    return payloads.select(key.alias("key"), F.explode(_unknown(v, schema, F.lit("$"))).alias("x")).select("key", "x.*")


def filings(form4: DataFrame, form4_raw: DataFrame) -> DataFrame:
    """source_file, record of each filing that can be read in either table, one row per source_file (of equal ones the last
    parsed, then the one of least hash). Filings without a source_file have no key and are left out."""
    schema = T.StructType(form4.schema.fields)
    own = form4.select(F.struct(*(F.col(f"`{f.name}`") for f in schema.fields)).alias("record"))
    raw = read_json(form4_raw.select("payload"), "payload", schema).where(F.col("record").isNotNull()).select("record")
    both = own.unionByName(raw).withColumn("source_file", F.col("record.filing_metadata.source_file"))
    latest = F.desc_nulls_last("record.parsed_timestamp"), F.xxhash64("record")
    return one_per_id(both, "source_file", *latest).select("source_file", "record")


def filing_tables(form4: DataFrame, form4_raw: DataFrame, several: bool = True) -> dict[str, DataFrame]:
    """The flat tables of all filings: filing, transactions, derivative_transactions, footnotes, reporting_person_relationship_to_issuer.

    several: more than one of them is asked for, so the filings are read and reconciled once and written out."""
    found = filings(form4, form4_raw)
    return inline(materialise(found, "filings") if several else found, "source_file", "record", "filing")


def children(tables: dict[str, DataFrame]) -> DataFrame:
    """source_file, child_kind, child_pos: each child of each filing, from its flat tables.

    The person and the address were inlined; they are there if anything inside them isn't null."""
    root, c = tables["filing"], F.col
    inside = lambda prefix: [c(x).isNotNull() for x in root.columns if x.startswith(prefix)]
    some = lambda tests: tests[0] if len(tests) == 1 else F.greatest(*tests)
    held = tables["reporting_person_relationship_to_issuer"].where(c("value").isNotNull()).select("source_file").distinct().withColumn("held", F.lit(True))
    person = root.join(held, "source_file", "left").where(some([*inside("reporting_person_"), c("held").isNotNull()]))
    address = root.where(some(inside("reporting_person_address_")))
    row = lambda df, kind, at: df.select("source_file", F.lit(kind).alias("child_kind"), at.cast("int").alias("child_pos"))
    out = row(person, "reporting_person", F.lit(0)).unionByName(row(address, "address", F.lit(0)))
    for kind in ("transactions", "derivative_transactions"):
        out = out.unionByName(row(tables[kind], kind, c("position")))
    return out
