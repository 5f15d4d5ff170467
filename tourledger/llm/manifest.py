"""A Merkle manifest: a tree over the leaves of each group, and one over the groups' roots.

Where a leaf stands in its group is not found by sorting leaves. Ids become bitmaps, of which
only words of 64 that hold a bit are stored; partial bitmaps merge by OR, and a directory of counts
over words, and over 2**16 words, 2**32 and 2**48, says how many leaves precede a word. A leaf's place
is that count and the number of lower bits in its own word. Trees are then reduced in arrays of
``BLOCK`` slots, each keyed by group and block, of which one digest goes on to the next round, and
on the way back down each block adds the siblings inside it to the path from its digest up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tourledger.llm.common import cut, pick, remainder

#: Nodes under one parent.
FAN_OUT = 8
#: Levels that one task reduces at once, and so slots in an array.
DEPTH = 4
BLOCK = FAN_OUT**DEPTH
#: A null id comes before all others: its word precedes that of the least long.
NULL_WORD = -(1 << 57) - 1
#: Copies of one row are numbered in runs of so many.
RUN = 1 << 16

PATH = "array<struct<before: string, after: string>>"


def field_text(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values' field texts, lower-case hex."""
    return F.sha2(F.concat(*map(field_text, values)), 256)


def folded(digest: Column, path: Column) -> Column:
    """The root that a digest and the siblings on its path lead to."""
    return F.aggregate(path, digest, lambda own, level: F.sha2(F.concat(level["before"], own, level["after"]), 256))


def siblings(path: Column) -> Column:
    """All siblings on a path, level by level and left to right."""
    return F.array_join(F.transform(path, lambda level: F.concat(level["before"], level["after"])), "")


# Places by rank in bitmaps


def _before(count: str, *order: str, within: tuple[str, ...]) -> Column:
    """What precedes a row: the running sum without its own."""
    return F.sum(count).over(Window.partitionBy(*within).orderBy(*order)) - F.col(count)


def directory(leaves: DataFrame) -> DataFrame:
    """The bitmaps of ids: for each group and word with a bit its ``bits``, the number ``held`` of
    leaves in it, the number ``start`` of leaves before it and the number ``n`` of the group's.

    A window orders at most 2**16 rows: the words, counts of words, counts of those, and
    at the top the 1,025 parts of a group that the highest ten bits tell apart.
    """
    one = F.lit(1).cast("long")
    words = leaves.groupBy("tree", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.sum(one).alias("held"))
    words = words.withColumns({"w16": F.shiftright("word", 16), "w32": F.shiftright("word", 32), "w48": F.shiftright("word", 48)})
    by16 = words.groupBy("tree", "w48", "w32", "w16").agg(F.sum("held").alias("m"))
    by32 = by16.groupBy("tree", "w48", "w32").agg(F.sum("m").alias("m"))
    by48 = by32.groupBy("tree", "w48").agg(F.sum("m").alias("m"))
    total = F.sum("m").over(Window.partitionBy("tree")).alias("n")
    by48 = by48.select("tree", "w48", _before("m", "w48", within=("tree",)).alias("start48"), total)
    by32 = by32.select("tree", "w48", "w32", _before("m", "w32", within=("tree", "w48")).alias("start32"))
    by32 = by32.join(by48, ["tree", "w48"]).select("tree", "w32", (F.col("start32") + F.col("start48")).alias("start32"), "n")
    by16 = by16.select("tree", "w32", "w16", _before("m", "w16", within=("tree", "w32")).alias("start16"))
    by16 = by16.join(by32, ["tree", "w32"]).select("tree", "w16", (F.col("start16") + F.col("start32")).alias("start16"), "n")
    words = words.select("tree", "w16", "word", "bits", "held", _before("held", "word", within=("tree", "w16")).alias("start"))
    return words.join(by16, ["tree", "w16"]).select("tree", "word", "bits", "held", (F.col("start") + F.col("start16")).alias("start"), "n")


def placed(leaves: DataFrame, key: str, carried: list[str]) -> DataFrame:
    """``slot``, a leaf's place in its group from 0, by ascending ``key`` (null first), and ``n``, the
    number of the group's leaves.

    Ids that occur once have the rank of their bit. Words with repeated ids hold more leaves
    than bits; their leaves are ordered by id, leaf and carried columns after equal rows are
    counted, in pieces by the leaf's first four digits, so that no id has to fit into one task.
    """
    number = F.col(key).cast("long")
    keyed = leaves.withColumns({
        "word": F.coalesce(F.shiftright(number, 6), F.lit(NULL_WORD).cast("long")),
        "bit": F.coalesce(number.bitwiseAND(F.lit(63).cast("long")), F.lit(0).cast("long")).cast("int"),
    })
    rows = keyed.join(directory(keyed), ["tree", "word"])
    crowded = F.col("held") > F.bit_count("bits")
    lower = F.bit_count(F.col("bits").bitwiseAND(F.expr("~shiftleft(-1L, bit)"))).cast("long")
    out = ["tree", key, "leaf", *carried]
    single = rows.where(~crowded).select(*out, "n", (F.col("start") + lower).alias("slot"))

    piece = F.substring("leaf", 1, 4).alias("piece")
    equal = rows.where(crowded).groupBy("tree", "word", "start", "n", "bit", piece, *out[1:]).agg(F.count(F.lit(1)).alias("copies"))
    pieces = equal.groupBy("tree", "word", "bit", "piece").agg(F.sum("copies").alias("m"))
    bits = pieces.groupBy("tree", "word", "bit").agg(F.sum("m").alias("k"))
    bits = bits.select("tree", "word", "bit", _before("k", "bit", within=("tree", "word")).alias("by_bit"))
    pieces = pieces.select("tree", "word", "bit", "piece", _before("m", "piece", within=("tree", "word", "bit")).alias("by_piece"))
    within = ("tree", "word", "bit", "piece")
    equal = equal.withColumn("by_leaf", _before("copies", "leaf", *carried, within=within))
    equal = equal.join(pieces, list(within)).join(bits, ["tree", "word", "bit"])
    first = F.col("start") + F.col("by_bit") + F.col("by_piece") + F.col("by_leaf")
    runs = equal.select(*out, "n", first.alias("first"), "copies", F.explode(F.expr(f"sequence(0L, copies - 1, {RUN}L)")).alias("run"))
    runs = runs.repartition("tree", "first", "run")
    last = F.least(F.col("run") + RUN, F.col("copies")) - 1
    repeated = runs.select(*out, "n", F.explode(F.sequence(F.col("first") + F.col("run"), F.col("first") + last)).alias("slot"))
    return single.unionByName(repeated)


def ranked(keys: DataFrame, column: str) -> DataFrame:
    """``slot``: the place of each key in ascending order, from 0. Ranges of keys are ordered
    apart, and a range's start is the number of keys in earlier ones."""
    dealt = cut(keys.repartitionByRange(column).withColumn("range", F.spark_partition_id()))
    sizes = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("m"))
    sizes = sizes.select("range", F.coalesce(F.sum("m").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("range").orderBy(column)) - 1
    return dealt.withColumn("own", own).join(sizes, "range").withColumn("slot", F.col("start") + F.col("own")).drop("range", "start", "own")


# Trees in arrays of slots


def _digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels(table: pa.Table, digest: str) -> list[list[str]]:
    """The digests of a block by level: its array of slots, then what each eight become.

    A block of a tree that has more blocks becomes one digest over all ``DEPTH`` levels, however
    few slots it has; a tree of one block has as many levels as it takes.
    """
    n = table.column("n")[0].as_py()
    slots = [None] * len(table)
    for slot, own in zip(table.column("slot").to_pylist(), table.column(digest).to_pylist()):
        slots[slot % BLOCK] = own
    levels = [slots]
    while len(levels) <= DEPTH if n > BLOCK else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_digest(below[i : i + FAN_OUT]) for i in range(0, len(below), FAN_OUT)])
    return levels


_NODE = StructType([StructField("tree", StringType()), StructField("slot", LongType()), StructField("n", LongType()), StructField("digest", StringType())])


def _reduced(nodes: DataFrame, digest: str) -> DataFrame:
    """One digest per block of nodes, as nodes of the next round."""

    def work(table: pa.Table) -> pa.Table:
        n = table.column("n")[0].as_py()
        top = _levels(table, digest)[-1][0]
        row = {"tree": [table.column("tree")[0].as_py()], "slot": [table.column("slot")[0].as_py() // BLOCK], "n": [-(-n // BLOCK)], "digest": [top]}
        return pa.table(row, schema=pa.schema([("tree", pa.string()), ("slot", pa.int64()), ("n", pa.int64()), ("digest", pa.string())]))

    blocks = nodes.select("tree", "slot", "n", digest, F.floor(F.col("slot") / BLOCK).alias("block"))
    return blocks.groupBy("tree", "block").applyInArrow(work, _NODE)


_UPPER = f"subroot string, root string, path {PATH}"
_LEVEL = pa.struct([("before", pa.string()), ("after", pa.string())])


def _descended(nodes: DataFrame, digest: str, upper: DataFrame) -> DataFrame:
    """Nodes with subroot, root and path from those of their blocks' digests."""
    schema, names = StructType([*nodes.schema.fields, *_schema(_UPPER)]), nodes.columns

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        levels = _levels(left, digest)[:-1]
        above = right.column("path")[0].as_py()
        befores, afters, offsets = [], [], [0]
        for slot in left.column("slot").to_pylist():
            at = slot % BLOCK
            for level in levels:
                begin = at - at % FAN_OUT
                befores.append("".join(level[begin:at]))
                afters.append("".join(level[at + 1 : begin + FAN_OUT]))
                at //= FAN_OUT
            befores += [level["before"] for level in above]
            afters += [level["after"] for level in above]
            offsets.append(len(befores))
        paths = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(befores, pa.string()), pa.array(afters, pa.string())], fields=list(_LEVEL)))
        same = [pa.array([right.column(name)[0].as_py()] * len(left), pa.string()) for name in ("subroot", "root")]
        columns = [left.column(name).combine_chunks() for name in names]
        return pa.Table.from_arrays([*columns, *same, paths], names=schema.names)

    blocks = nodes.withColumn("block", F.floor(F.col("slot") / BLOCK))
    above = upper.withColumnRenamed("slot", "block").select("tree", "block", "subroot", "root", "path")
    return blocks.groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(work, schema)


def _schema(ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields


def _rounds(nodes: DataFrame, digest: str) -> list[DataFrame]:
    """The nodes of each round, up to one per tree. Every round is ``BLOCK`` times smaller."""
    rounds, n = [nodes], nodes.agg(F.max("n")).first()[0] or 1
    while n > 1:
        rounds.append(cut(_reduced(rounds[-1], "digest" if len(rounds) > 1 else digest)))
        n = -(-n // BLOCK)
    return rounds


def _leaves_from(rounds: list[DataFrame], digest: str, upper: DataFrame) -> DataFrame:
    """From the roots' rows (subroot, root, path) down to the first round's nodes."""
    for number in range(len(rounds) - 2, -1, -1):
        upper = _descended(rounds[number], "digest" if number else digest, upper)
    return upper


def manifest(leaves: DataFrame, tree: str, key: str, leaf: str, carried: Iterable[str] = ()) -> DataFrame:
    """The columns tree, key, leaf and ``carried``, with ``slot``, ``subroot``, ``root`` and
    ``path``: the siblings before and after a leaf's own digest at each level up to the root.

    ``leaf`` holds digests as text, ``key`` integers. Leaves of one ``tree`` value (null is one)
    ascend by key, null first, equal keys by leaf and carried columns; every repeated row is
    a leaf of its own. While nodes remain each eight become their digest, the last run also where
    it is fewer. Subroots by tree value, null first and bytewise, likewise give the root, and no
    leaves give no rows.
    """
    carried = list(carried)
    rows = pick(leaves, tree, key, leaf, *carried)
    rows = rows.toDF("tree", "id", "leaf", *[f"c{i}" for i in range(len(carried))])
    rows = rows.withColumn("tree", F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit("")))
    own = cut(placed(rows, "id", rows.columns[3:]))
    rounds = _rounds(own, "leaf")
    single = len(rounds) == 1
    subroots = rounds[-1].select("tree", F.col("leaf" if single else "digest").alias("digest"))

    order = cut(ranked(subroots, "tree"))
    number = order.agg(F.count(F.lit(1)).alias("n"))
    tops = order.crossJoin(F.broadcast(number)).select(F.lit("").alias("tree"), "slot", "n", "digest", F.col("tree").alias("of"))
    above = _rounds(tops, "digest")
    upper = above[-1].select("tree", "slot", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"), F.expr(f"cast(array() as {PATH})").alias("path"))
    if len(above) > 1:
        upper = _leaves_from(above, "digest", upper)
    else:
        upper = upper.join(tops.select("slot", "digest", "of"), "slot")
    upper = cut(upper.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("slot"), F.col("digest").alias("subroot"), "root", "path"))
    if single:
        found = own.join(upper.drop("slot"), "tree")
    else:
        found = _leaves_from(rounds, "leaf", upper)
    value = F.when(F.col("tree") != "", F.substring("tree", 2, 2**31 - 1)).cast(dict(leaves.dtypes)[tree]).alias(tree)
    names = [F.col(f"c{i}").alias(name) for i, name in enumerate(carried)]
    return found.select(value, F.col("id").alias(key), F.col("leaf").alias(leaf), *names, "slot", "subroot", "root", "path")


def document_manifest(docs: DataFrame) -> DataFrame:
    """Each document's leaf, the leaf that it has after tampering (null where it is let alone)
    and its path in the manifest over all documents.

    Tampering lower-cases A-Z in the texts of ids whose crc32 as text three divides; a null id
    counts as the empty text. Nulls in other columns are ``-`` in the digest.
    """
    rows = pick(docs, "doc_id", "source", "lang", "n_chars", "text")
    others = [F.col(name) for name in rows.columns[:-1]]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(remainder(F.col("doc_id"), 3) == 0, leaf_digest(*others, lower))
    leaves = rows.select("lang", "doc_id", leaf_digest(*others, F.col("text")).alias("leaf"), changed.alias("changed"))
    return manifest(leaves, "lang", "doc_id", "leaf", ["changed"])
