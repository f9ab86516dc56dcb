"""Captured logical-replication messages -> change rows.

Input: a table of captured messages ``(system_id, _seq, _lsn, payload)``
with the protocol's message bytes in ``payload`` (the 25-byte copy-data
header already removed). Layouts (all integers big-endian):

* ``R`` relation: oid i32, namespace C string, name C string, identity
  byte, column count i16, then per column: flags byte (1 = key), name C
  string, type oid i32, type modifier i32.
* ``I`` insert: oid i32, ``N``, tuple.
* ``U`` update: oid i32, optionally ``K`` (old key) or ``O`` (old row)
  followed by a tuple, then ``N`` and the new tuple.
* ``D`` delete: oid i32, ``K`` or ``O``, tuple.
* tuple: column count i16, then per column a kind byte: ``t``/``b`` then
  length i32 and the bytes; ``n`` NULL; ``u`` unchanged (not sent).
* ``B``/``C`` (transaction markers) and any other kind carry no rows;
  ``T`` (truncate) cannot be applied as row changes and fails the job.

Everything is a built-in expression: tuples are walked with one projection
for each column, carrying the byte offset.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.binary import (byte_at, char_at, cstring_end, int16_be,
                                int32_be, latin1, uint_be, utf8_at)
from ..operators.asof import carry_forward
from ..operators.changes import DELETE, INSERT, UPDATE
from ..operators.partitioning import spread
from ..operators.sizing import fits_broadcast, materialize

ROW_KINDS = ("I", "U", "D")
TRUNCATE = "T"


def _walk(df: DataFrame, payload: Column, start: Column, max_cols: int,
          name: str) -> DataFrame:
    """Add struct ``name`` = (end, kinds, vals) for the tuple at ``start``,
    walking at most ``max_cols`` columns with one projection per column.

    Each projection computes one column's kind, value and the next offset
    from the previous offset; all of it is plain expressions, so the walk
    compiles into the surrounding generated code.
    """
    p = f"_{name}_"
    keep = df.columns
    n = int16_be(payload, start)
    made = [f"{p}n"]
    df = df.select(*keep, F.when(start.isNotNull(), n).alias(f"{p}n"),
                   (start + 2).cast("int").alias(f"{p}o0"))
    cnt = F.col(f"{p}n")
    for i in range(max_cols):
        off = F.col(f"{p}o{i}")
        active = F.lit(i) < cnt
        kb = payload.substr(off, F.lit(1))
        sized = active & ((kb == F.lit(b"t")) | (kb == F.lit(b"b")))
        ln = uint_be(payload, off + 1, 4).cast("int")
        made += [f"{p}k{i}", f"{p}v{i}"]
        # only the next offset is carried on, the last ones are done with
        df = df.select(*keep, *made[:-2],
                       F.when(active, F.decode(kb, "ISO-8859-1")).alias(f"{p}k{i}"),
                       F.when(sized, utf8_at(payload, off + 5, ln)).alias(f"{p}v{i}"),
                       F.when(sized, off + 5 + ln).when(active, off + 1)
                       .otherwise(off).alias(f"{p}o{i + 1}"))
    size = F.coalesce(cnt, F.lit(0)).cast("int")
    arr = lambda pre: F.slice(F.array(*[F.col(f"{p}{pre}{i}")
                                        for i in range(max_cols)]), 1, size)
    out = F.when(cnt.isNotNull(), F.struct(
        F.col(f"{p}o{max_cols}").alias("end"),
        (arr("k") if max_cols else F.array().cast("array<string>")).alias("kinds"),
        (arr("v") if max_cols else F.array().cast("array<string>")).alias("vals")))
    return df.select(*keep, out.alias(name))


def parse_rows(messages: DataFrame, max_cols: int,
               partitions: int | None = None) -> DataFrame:
    """Row messages (I/U/D) with their tuples still as text arrays.

    Output: system_id?, _seq, _lsn?, kind, oid, old_tag, old (struct),
    new (struct). Other message kinds are dropped here. ``max_cols``: the
    widest relation (from ``parse_relations``). ``partitions``: deal the
    messages over so many tasks first.
    """
    keep = [c for c in ("system_id", "_seq", "_lsn") if c in messages.columns]
    p = F.col("payload")
    kind = F.col("kind")
    m = (spread(messages, partitions).select(*keep, p, char_at(p, 1).alias("kind"))
         .where(F.when(kind == TRUNCATE, F.raise_error(F.concat(
             F.lit("truncate message at position "), F.col("_seq").cast("string")))
             .cast("boolean")).otherwise(kind.isin(*ROW_KINDS))))
    tag6 = char_at(p, 6)
    m = m.select(*keep, "kind", p,
                 uint_be(p, 2, 4).alias("oid"),
                 F.when(tag6.isin("K", "O"), tag6).alias("old_tag"))
    old_start = F.when(F.col("old_tag").isNotNull(), F.lit(7))
    m = _walk(m, p, old_start, max_cols, "old")
    new_start = F.when(F.col("kind") != "D", F.when(
        F.col("old").isNotNull(), F.col("old.end")).otherwise(6) + 1)
    m = _walk(m, p, new_start, max_cols, "new")
    return m.drop("payload")


def parse_relations(messages: DataFrame) -> DataFrame:
    """Relation messages -> (system_id?, _seq, oid, namespace, name,
    identity, cols, keys, type_oids)."""
    keep = [c for c in ("system_id", "_seq") if c in messages.columns]
    p = F.col("payload")
    r = (messages.select(*keep, p, latin1(p).alias("_v"))
         .where(char_at(p, 1) == "R"))
    v = F.col("_v")
    ns_end = cstring_end(v, 6)
    r = r.select(*keep, p, v, uint_be(p, 2, 4).alias("oid"),
                 utf8_at(p, 6, ns_end - 6).alias("namespace"),
                 ns_end.alias("_ns_end"))
    name_end = cstring_end(v, F.col("_ns_end") + 1)
    r = r.select(*keep, p, v, "oid", "namespace",
                 utf8_at(p, F.col("_ns_end") + 1,
                         name_end - F.col("_ns_end") - 1).alias("name"),
                 name_end.alias("_name_end"))
    ne = F.col("_name_end")
    n = int16_be(p, ne + 2)
    idx = F.when(n > 0, F.sequence(F.lit(1), n.cast("int"))).otherwise(
        F.array().cast("array<int>"))
    zero = F.struct((ne + 4).cast("bigint").alias("off"),
                    F.array().cast("array<string>").alias("cols"),
                    F.array().cast("array<bigint>").alias("flags"),
                    F.array().cast("array<bigint>").alias("types"))

    def step(acc: Column, _i: Column) -> Column:
        off = acc["off"]
        end = cstring_end(v, off + 1)
        return F.struct(
            (end + 9).cast("bigint").alias("off"),
            F.concat(acc["cols"], F.array(utf8_at(p, off + 1, end - off - 1))
                     ).alias("cols"),
            F.concat(acc["flags"], F.array(byte_at(p, off))).alias("flags"),
            F.concat(acc["types"], F.array(uint_be(p, end + 1, 4))
                     ).alias("types"))

    walked = F.aggregate(idx, zero, step)
    r = r.select(*keep, "oid", "namespace", "name",
                 char_at(p, ne + 1).alias("identity"), walked.alias("_w"))
    cols = F.col("_w.cols")
    flags = F.col("_w.flags")
    keys = F.filter(cols, lambda c, i: F.get(flags, i) == 1)
    return r.select(*keep, "oid", "namespace", "name", "identity",
                    cols.alias("cols"), keys.alias("keys"),
                    F.col("_w.types").alias("type_oids"))


def relation_versions(relations: DataFrame) -> DataFrame:
    """Each relation message is in force from its position up to the next
    one for the same oid: (oid, _from, _to, namespace, name, cols, keys).

    The window runs over relation messages only - a few per table."""
    w = Window.partitionBy("oid").orderBy("_seq")
    return relations.select(
        "oid", F.col("_seq").alias("_from"),
        F.lead("_seq").over(w).alias("_to"),
        "namespace", "name", "cols", "keys")


def collect_versions(relations: DataFrame) -> DataFrame:
    """Relation versions, staged once in the shared folder: the relation
    messages are read a single time and the planner knows their size."""
    return materialize(relation_versions(relations))


#: Versions of one relation up to which rows are held against all of them.
FEW_VERSIONS = 64


def relation_as_of(rows: DataFrame, relations: DataFrame,
                   versions: DataFrame | None = None,
                   carry: bool | None = None) -> DataFrame:
    """Attach to each row message the relation in force at its position.

    Two ways, of the same result. A staged version table that may be broadcast
    and has few versions of any relation is joined on oid and position range:
    the rows are not shuffled. Otherwise versions are carried forward along the
    feed (``asof``): the cost is rows plus versions, and the rows of one oid,
    however many, are spread over all tasks. ``carry`` decides by hand.
    """
    vers = versions if versions is not None else collect_versions(relations)
    if carry is None:
        carry = not fits_broadcast(vers) or most_versions(version_facts(vers)) > FEW_VERSIONS
    values = ["_rel_seq", "namespace", "table", "cols", "keys"]
    if carry:
        force = vers.select("oid", F.col("_from").alias("_seq"), F.struct(
            F.col("_from").alias("_rel_seq"), "namespace", F.col("name").alias("table"),
            "cols", "keys").alias("_rel"))
        out = carry_forward(rows, force, ["oid"], ["_seq"], ["_rel"])
        return out.select(*rows.columns, *[F.col(f"_rel.{c}").alias(c) for c in values])
    in_range = ((F.col("r._seq") >= F.col("v._from")) &
                (F.col("v._to").isNull() | (F.col("r._seq") < F.col("v._to"))))
    out_cols = [F.col(f"r.{c}") for c in rows.columns] + [
        F.col("v._from").alias("_rel_seq"),
        F.col("v.namespace").alias("namespace"), F.col("v.name").alias("table"),
        F.col("v.cols").alias("cols"), F.col("v.keys").alias("keys")]
    return rows.alias("r").join(vers.alias("v"), (F.col("r.oid") == F.col("v.oid")) & in_range,
                                "left").select(*out_cols)


def most_versions(facts: list) -> int:
    """The largest number of versions that one relation has (of ``version_facts``)."""
    count = Counter()
    for r in facts:
        count[r["oid"]] += r["n"]
    return max(count.values(), default=0)


def _of_table(table: str | None, namespace: str | None, name_col: str) -> Column:
    wanted = F.lit(True)
    if table is not None:
        wanted = wanted & (F.col(name_col) == F.lit(table))
    if namespace is not None:
        wanted = wanted & (F.col("namespace") == F.lit(namespace))
    return wanted


def version_facts(versions: DataFrame) -> list:
    """One row for each relation and key that was announced: (oid, namespace,
    name, keys, n versions, most columns). As many rows as tables are replicated
    (more only where a table's key changed) come to the driver."""
    return versions.groupBy("oid", "namespace", "name", "keys").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("cols")).alias("width")).collect()


def resolve_keys(versions: DataFrame | list, schema: StructType, table: str | None = None,
                 namespace: str | None = None) -> list[str]:
    """The key columns that the relations of one table announce - the same
    way for any number of them. None announced (replica identity full or
    nothing): every target column is the key, as for a key-less target.

    Relations of one name in several namespaces are different tables: then
    ``namespace`` must say which one is meant. ``versions`` or their
    ``version_facts``.
    """
    facts = versions if isinstance(versions, list) else version_facts(versions)
    mine = [r for r in facts if table in (None, r["name"]) and namespace in (None, r["namespace"])]
    if table is not None and namespace is None:
        spaces = sorted({r["namespace"] for r in mine})
        if len(spaces) > 1:
            raise ValueError(f"table {table!r} stands in several namespaces: {spaces}")
    found = sorted({tuple(r["keys"]) for r in mine})
    if len(found) > 1:
        raise ValueError(f"relation versions disagree on the key: {found}")
    return list(found[0]) if found and found[0] else [f.name for f in schema.fields]


def to_changes(attached: DataFrame, schema: StructType,
               keys: list[str], table: str | None = None,
               namespace: str | None = None) -> DataFrame:
    """Rows with their relation -> the change-frame contract.

    * values are matched to target columns by name and cast to the
      target type;
    * a delete carries the key only (F7); a full old row (``O``) is
      projected to the key the same way (X2);
    * an update whose old key differs from its new key becomes a delete of
      the old key (``_sub`` 0) and an insert of the new row (``_sub`` 1),
      both at the message's position (X1);
    * a column that the new tuple leaves unchanged takes the old tuple's value
      where that was sent (all columns of ``O``, the keys of ``K``);
    * ``_unchanged`` lists target columns whose value the message did not
      send at all (X3); for a moved row ``_from`` holds the old key, so the
      value can be looked up there.

    ``keys``: the key columns (``resolve_keys``).
    """
    # rows without a relation stay: they must fail below, not vanish
    df = attached.where(F.col("cols").isNull() | _of_table(table, namespace, "table"))
    names = [f.name for f in schema.fields]
    rel_cols = F.col("cols")
    meta = [c for c in ("system_id", "_seq", "_lsn") if c in df.columns]
    pos = {n: F.array_position(rel_cols, F.lit(n)).cast("int") for n in names}
    for k in keys:
        pos.setdefault(k, F.array_position(rel_cols, F.lit(k)).cast("int"))

    def val(tup: str, n: str) -> Column:
        # get() is 0-based and NULL out of range: a column the relation
        # version does not list (position 0) reads as NULL.
        return F.get(F.col(f"{tup}.vals"), pos[n] - 1)

    kind = F.col("kind")
    # A row message whose relation has not been seen cannot be read; fail
    # the batch rather than drop or misread it.
    df = df.withColumn("cols", F.when(
        F.col("cols").isNull(),
        F.raise_error(F.concat(F.lit("no relation message for oid "),
                               F.col("oid").cast("string"), F.lit(" before position "),
                               F.col("_seq").cast("string"))).cast("array<string>"))
        .otherwise(F.col("cols")))
    key_set = set(keys)

    def left_out(n: str) -> Column:
        return F.coalesce(F.get(F.col("new.kinds"), pos[n] - 1) == "u", F.lit(False))

    def from_old(n: str) -> Column:
        sent = F.get(F.col("old.kinds"), pos[n] - 1).isin("t", "b", "n")
        tags = ["O", "K"] if n in key_set else ["O"]
        return F.coalesce(left_out(n) & F.col("old_tag").isin(tags) & sent, F.lit(False))

    def new_val(n: str) -> Column:
        return F.when(from_old(n), val("old", n)).otherwise(val("new", n))

    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & (val("old", k).eqNullSafe(new_val(k))
                               | (left_out(k) & ~from_old(k)))
    key_change = (kind == "U") & F.col("old").isNotNull() & ~same_key
    new_vals = [new_val(n).alias(n) for n in names]
    unchanged = F.array_compact(F.array(*[
        F.when(left_out(n) & ~from_old(n), F.lit(n))
        for n in names])) if names else F.array().cast("array<string>")
    none = F.array().cast("array<string>")
    types = {f.name: f.dataType for f in schema.fields}
    old_key = F.struct(*[val("old", k).cast(types.get(k, "string")).alias(k) for k in keys])
    nowhere = F.when(F.lit(False), old_key)
    old_delete = F.struct(F.lit(0).alias("_sub"), F.lit(DELETE).alias("_op"),
                          *[(val("old", n) if n in key_set
                             else F.lit(None).cast("string")).alias(n)
                            for n in names],
                          none.alias("_unchanged"), nowhere.alias("_from"))
    new_struct = F.struct(F.lit(0).alias("_sub"),
                          F.when(kind == "I", INSERT).when(kind == "U", UPDATE)
                          .alias("_op"),
                          *new_vals, unchanged.alias("_unchanged"), nowhere.alias("_from"))
    split_insert = F.struct(F.lit(1).alias("_sub"), F.lit(INSERT).alias("_op"),
                            *new_vals, unchanged.alias("_unchanged"), old_key.alias("_from"))
    parts = (F.when(kind == "D", F.array(old_delete))
             .when(key_change, F.array(old_delete, split_insert))
             .otherwise(F.array(new_struct)))
    out = df.select(*meta, F.inline(parts))
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    return out.select(*meta, "_sub", "_op", *typed, "_unchanged", "_from")


def decode_messages(messages: DataFrame, schema: StructType,
                    table: str | None = None, keys: list[str] | None = None,
                    relations: DataFrame | None = None,
                    versions: DataFrame | None = None,
                    namespace: str | None = None,
                    partitions: int | None = None) -> DataFrame:
    """Captured messages -> typed change rows for one target schema.

    ``relations`` may come from an earlier batch's relation table (a
    relation message can precede its rows by many batches); by default
    the relation messages in ``messages`` are used. ``versions``: relation
    versions already staged (``collect_versions``) - a stream reuses them
    until a batch brings a new relation message. ``table`` and ``namespace``
    name the relation whose rows are wanted.
    """
    rels = relations if relations is not None else parse_relations(messages)
    vers = versions if versions is not None else collect_versions(rels)
    facts = version_facts(vers)
    widest = max((r["width"] for r in facts), default=0)
    keys = keys or resolve_keys(facts, schema, table, namespace)
    rows = parse_rows(messages, widest, partitions)
    carry = not fits_broadcast(vers) or most_versions(facts) > FEW_VERSIONS
    return to_changes(relation_as_of(rows, rels, versions=vers, carry=carry), schema,
                      keys=keys, table=table, namespace=namespace)
