"""Document-store value tags, handled with native expressions.

An item attribute is a one-key object naming its type: ``{"S": "text"}``,
``{"N": "12.5"}``, ``{"BOOL": true}``, ``{"NULL": true}``, ``{"SS": [...]}``,
``{"NS": [...]}``, ``{"B": "base64"}``, ``{"BS": [...]}``, ``{"L": [v, ...]}``, ``{"M": {"k": v, ...}}``.

The JSON reader parses items against a fixed schema (no inference); a
value is a struct with one nullable field per tag. Unwrapping is then a
``coalesce`` over that struct - no Python worker, no JSON round trip per row.
Containers inside a group (``L``, ``M``) are kept as their JSON text and parsed only
where there is one, against a schema of ``DEPTH`` levels whose unwrapping is
compiled from that schema; what lies deeper keeps its tags.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ITEM_GROUPS, PARTITION_KEY_ATTR


def _scalar_fields() -> list[T.StructField]:
    return [
        T.StructField("S", T.StringType()),
        T.StructField("N", T.StringType()),
        T.StructField("BOOL", T.BooleanType()),
        T.StructField("NULL", T.BooleanType()),
        T.StructField("SS", T.ArrayType(T.StringType())),
        T.StructField("NS", T.ArrayType(T.StringType())),
        T.StructField("B", T.StringType()),  # binary values are base64 text in the encoding
        T.StructField("BS", T.ArrayType(T.StringType())),
    ]


DEPTH = 5  # levels of containers inside a field that are unwrapped

# A field of a group: containers are JSON text until they are unwrapped.
VALUE = T.StructType(_scalar_fields() + [
    T.StructField("L", T.StringType()),
    T.StructField("M", T.StringType()),
])
GROUP = T.MapType(T.StringType(), VALUE)


# An attribute of an item: a group is an M of fields.
ATTRIBUTE = T.StructType(_scalar_fields() + [T.StructField("L", T.StringType()), T.StructField("M", GROUP)])

# One item line: {"Item": {<attribute>: <tagged value>, ...}}; attributes and fields that nobody knows are kept.
ITEM_SCHEMA = T.StructType([T.StructField("Item", T.MapType(T.StringType(), ATTRIBUTE))])

# Bronze: the outer tag stripped, one map column per group; ``rescued``: what belongs to no known column, as text.
RESCUED = "rescued"
BRONZE_SCHEMA = T.StructType(
    [T.StructField(g, GROUP) for g in ITEM_GROUPS] + [T.StructField(RESCUED, T.StringType()), T.StructField("ingest_run_id", T.StringType())]
)


# The expressions below are SQL text: they are large, and one call hands them over.

_SETS = ("SS", "NS", "BS")


def _value_ddl(depth: int) -> str:
    """The type of a value whose containers are parsed to ``depth`` levels, for ``from_json``."""
    fields = ["S:string", "N:string", "BOOL:boolean", "`NULL`:boolean", "SS:array<string>", "NS:array<string>", "B:string", "BS:array<string>"]
    inner = _value_ddl(depth - 1) if depth else None
    fields += ["L:string", "M:string"] if inner is None else [f"L:array<{inner}>", f"M:map<string,{inner}>"]
    return f"struct<{','.join(fields)}>"


def _scalar_sql(v: str) -> list[str]:
    """Texts of a scalar-tagged value, the first that is not NULL counts; all NULL for the NULL tag and for absent tags."""
    return [f"{v}.S", f"{v}.N", f"CAST({v}.BOOL AS STRING)", *[f"CASE WHEN {v}.{s} IS NOT NULL THEN to_json({v}.{s}) END" for s in ("SS", "NS")],
            f"{v}.B", f"CASE WHEN {v}.BS IS NOT NULL THEN to_json({v}.BS) END"]


def _quoted_sql(text: str) -> str:
    """A JSON string."""
    return f"substring(to_json(array({text})), 2, length(to_json(array({text}))) - 2)"


def _unwrapped_sql(v: str, depth: int) -> str:
    """JSON of a value parsed to ``depth`` levels of containers. Lists and maps share the expression of their elements (bound to
    a name), so its size grows with the depth and not with its power."""
    known = [f"CASE WHEN {v}.{s} IS NOT NULL THEN {_quoted_sql(f'CAST({v}.{s} AS STRING)')} END" for s in ("S", "N", "BOOL", "B")]
    known += [f"CASE WHEN {v}.{s} IS NOT NULL THEN to_json({v}.{s}) END" for s in _SETS]
    if not depth:
        return f"coalesce({', '.join([*known, f'{v}.L', f'{v}.M'])}, 'null')"
    x, p, k = (f"{n}{depth}" for n in "xpk")
    parts = f"transform(coalesce({v}.L, map_values({v}.M)), {x} -> {_unwrapped_sql(x, depth - 1)})"
    named = f"zip_with(map_keys({v}.M), {p}, ({k}, e{depth}) -> concat({_quoted_sql(k)}, ':', e{depth}))"
    joined = (f"CASE WHEN {v}.L IS NOT NULL THEN concat('[', array_join({p}, ','), ']') "
              f"WHEN {v}.M IS NOT NULL THEN concat('{{', array_join({named}, ','), '}}') END")
    return f"coalesce({', '.join(known)}, transform(array({parts}), {p} -> {joined})[0], 'null')"


def container_sql(v: str, depth: int = DEPTH) -> str:
    """JSON of the unwrapped elements of an L or M value, at any level; NULL for others."""
    whole = f"""coalesce(concat('{{"L":', {v}.L, '}}'), concat('{{"M":', {v}.M, '}}'))"""
    parsed = f"from_json({whole}, '{_value_ddl(depth)}')"
    return f"CASE WHEN {v}.L IS NOT NULL OR {v}.M IS NOT NULL THEN transform(array({parsed}), r -> {_unwrapped_sql('r', depth)})[0] END"


def scalar_text(v: str) -> Column:
    """Text of a scalar value named in SQL, such as ``treatment['id']``; NULL for containers."""
    return F.expr(f"coalesce({', '.join(_scalar_sql(v))})")


def _some_container(group: str, fields: Sequence[str]) -> str:
    return " OR ".join(f"{group}['{f}'].L IS NOT NULL OR {group}['{f}'].M IS NOT NULL" for f in fields)


def with_containers(group: str, fields: Sequence[str]) -> Column:
    """A group with a container among its fields, NULL for others."""
    return F.expr(f"CASE WHEN {_some_container(group, fields)} THEN {group} END")


def container_texts(group: str, fields: Sequence[str]) -> Column:
    """The fields of a group that are containers, unwrapped; NULL for a group without one, which is all that most rows
    evaluate."""
    kept = f"map_filter({group}, (k, v) -> v.L IS NOT NULL OR v.M IS NOT NULL)"
    return F.expr(f"CASE WHEN {_some_container(group, fields)} THEN transform_values({kept}, (k, v) -> {container_sql('v')}) END")


def unwrap_group(group: str) -> Column:
    """map<string, tagged value> named in SQL -> map<string, string>; a NULL group stays NULL."""
    return F.expr(f"transform_values({group}, (k, v) -> coalesce({', '.join(_scalar_sql('v'))}, {container_sql('v')}))")


RESCUED_TYPE = "array<struct<name:string,value:string>>"


def rescued_text(item: str = "Item") -> Column:
    """JSON list of ``name, value`` for everything in an item (read with ``ITEM_SCHEMA``) that has no column: attributes that
    are no group under their name, unknown fields as ``group.field``, a group that is no M; values with their tags. NULL
    where there is nothing. Items that name no more than the known fields, in their order, are told by comparing names; the
    lambdas run only for others."""
    none = f"CAST(array() AS {RESCUED_TYPE})"

    def others(m: str, names: list[str], prefix: str) -> str:
        listed = ", ".join(f"'{n}'" for n in names)
        kept = f"filter(map_entries({m}), e -> e.key NOT IN ({listed}))"
        entries = f"transform({kept}, e -> struct(concat('{prefix}', e.key) AS name, to_json(e.value) AS value))"
        return f"coalesce(CASE WHEN size(array_except(map_keys({m}), array({listed}))) > 0 THEN {entries} END, {none})"

    parts = [others(item, [*ITEM_GROUPS, PARTITION_KEY_ATTR], "")] + [others(f"{item}['{g}'].M", fields, f"{g}.") for g, fields in ITEM_GROUPS.items()]
    for g in ITEM_GROUPS:
        v = f"{item}['{g}']"
        parts.append(f"CASE WHEN {v} IS NOT NULL AND {v}.M IS NULL AND NOT coalesce({v}.`NULL`, false) "
                     f"THEN array(struct('{g}' AS name, to_json({v}) AS value)) ELSE {none} END")
    whole = f"transform(array(concat({', '.join(parts)})), x -> CASE WHEN size(x) > 0 THEN to_json(x) END)[0]"

    def plain(m: str, names: Sequence[str]) -> str:
        return f"map_keys({m}) = array({', '.join(repr(n) for n in names)})"

    usual = [plain(item, [PARTITION_KEY_ATTR, *ITEM_GROUPS]), *[plain(f"{item}['{g}'].M", fields) for g, fields in ITEM_GROUPS.items()]]
    return F.expr(f"CASE WHEN {' AND '.join(usual)} THEN CAST(NULL AS STRING) ELSE {whole} END")


# --- bronze rows as one text (to be moved between tasks) ---------------------

_NEXT, _OTHER = "\x01", "\x02"  # between the values of a packed row; in place of a value that has no packed form
_GROUPS_DDL = ", ".join(f"{g} map<string,{_value_ddl(0)}>" for g in ITEM_GROUPS)


def packed_groups(rows: DataFrame, name: str) -> DataFrame:
    """The groups of bronze rows as one text column: the values alone, each after a letter for its tag, where every group has its
    known fields in their order and each value is one S, N or NULL; JSON for other rows. ``unpacked_groups`` gives the groups
    back. Rows of maps are names and absent tags for the most part."""
    plain = " AND ".join(f"v.{t} IS NULL" for t in ("BOOL", "SS", "NS", "B", "BS", "L", "M"))
    value = (f"CASE WHEN {plain} AND NOT contains(coalesce(v.S, v.N, ''), '{_NEXT}') THEN CASE WHEN v.N IS NULL AND v.`NULL` IS NULL THEN concat('S', v.S) "
             "WHEN v.S IS NULL AND v.`NULL` IS NULL THEN concat('N', v.N) WHEN v.S IS NULL AND v.N IS NULL AND v.`NULL` THEN '0' END END")
    usual = " AND ".join(f"map_keys({g}) = array({', '.join(repr(f) for f in fields)})" for g, fields in ITEM_GROUPS.items())
    values = f"concat({', '.join(f'map_values({g})' for g in ITEM_GROUPS)})"
    short = F.expr(f"CASE WHEN {usual} THEN array_join(transform({values}, v -> coalesce({value}, '{_OTHER}')), '{_NEXT}') END")
    rows = rows.withColumn(name, short)
    whole = F.to_json(F.struct(*ITEM_GROUPS))
    return rows.withColumn(name, F.when(F.col(name).isNotNull() & ~F.col(name).contains(_OTHER), F.col(name)).otherwise(whole)).drop(*ITEM_GROUPS)


def unpacked_groups(rows: DataFrame, name: str) -> DataFrame:
    """The group columns of what ``packed_groups`` made, in place of the text."""
    def value(i: int) -> str:
        p = f"get(_parts, {i})"
        tags = {f.name: f"CAST(NULL AS {f.dataType.simpleString()})" for f in VALUE.fields}
        tags |= {t: f"CASE WHEN startswith({p}, '{t}') THEN substring({p}, 2) END" for t in ("S", "N")} | {"NULL": f"CASE WHEN {p} = '0' THEN true END"}
        return f"named_struct({', '.join(f'{t!r}, {v}' for t, v in tags.items())})"

    kept = [c for c in rows.columns if c != name]
    rows = rows.select(*kept, F.expr(f"CASE WHEN startswith({name}, '{{') THEN from_json({name}, '{_GROUPS_DDL}') END").alias("_whole"),
                       F.expr(f"split({name}, '{_NEXT}', -1)").alias("_parts"))
    groups, at = [], 0
    for g, fields in ITEM_GROUPS.items():
        short = f"map({', '.join(f'{f!r}, {value(at + i)}' for i, f in enumerate(fields))})"
        groups.append(F.expr(f"CASE WHEN _whole IS NULL THEN {short} ELSE _whole.{g} END").alias(g))
        at += len(fields)
    return rows.select(*groups, *kept)


# --- building tagged values (used to produce item files from typed rows) ----

def tag_value(c: Column, kind: str) -> Column:
    """Tagged value (VALUE struct) for a typed column. ``kind`` is "S" or "N";
    NULL becomes the NULL tag."""
    text = c.cast("string")
    fields = {f.name: F.lit(None).cast(f.dataType) for f in VALUE.fields}
    fields[kind] = text
    fields["NULL"] = F.when(c.isNull(), F.lit(True))
    fields[kind] = F.when(c.isNotNull(), text)
    return F.struct(*[v.alias(k) for k, v in fields.items()])
