"""Near-duplicate documents by Order MinHash, verified by banded alignment."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField, StructType

from tourledger.llm.common import cut, frugal, mix, numbered, pick, pieces, prefix_hash, schema_of, span_hash, text_bytes
from tourledger.llm.components import connected_components
from tourledger.llm.decontamination import normalised

SHINGLE = 5
SIMILARITY = 0.8
#: Sketches of a document, and the k-mers that one keeps. At similarity 0.8 two documents agree
#: in a sketch with probability 0.41, if it has many k-mers, and in none of 32 once in 20 million.
SKETCHES = 32
KEPT = 4
#: Sketches that a key and its hub have in common if they are compared first.
AGREE = 2
#: Texts of up to so many distinct shingles need share no sketch to be compared.
SHORT = 32
#: What a text similar to one of those has at most.
_SHORT = int(SHORT / SIMILARITY)

_RNG = np.random.default_rng(4)
_WORD_FACTORS = _RNG.integers(1, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
_SKETCH_FACTORS = _RNG.integers(1, 1 << 63, SKETCHES, np.uint64) * np.uint64(2) + np.uint64(1)
_LABEL = np.uint64(0x9E3779B97F4A7C15)
#: K-mers of a document that stay in the draw for its least ones, on average.
_DRAWN = 16


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the rows' words, the index of each row's first, the normalised text and where
    its rows end."""
    text, begins, first = normalised(data, offsets)
    gaps = np.flatnonzero(text <= 0x20)
    ends = gaps[np.searchsorted(gaps, begins)] if len(begins) else begins
    return span_hash(prefix_hash(text), begins, ends), first, text, np.flatnonzero(text == 0x0A)


def shingles(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of SHINGLE words; a shorter row, but not an empty one, is one."""
    counts = np.diff(first)
    many = np.where(counts >= SHINGLE, counts - SHINGLE + 1, (counts > 0).astype(np.int64))
    row = np.repeat(np.arange(len(counts)), many)
    at = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    end = first[row + 1]
    found = np.zeros(len(row), np.uint64)
    for k in range(SHINGLE):
        here = at + k < end
        found[here] += words[at[here] + k] * _WORD_FACTORS[k]
    return mix(found), row


def labelled(grams: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The k-mers' hashes with their occurrence in the row: the first, second, ... of its kind."""
    order = np.lexsort((grams, row))
    g, r = grams[order], row[order]
    fresh = np.ones(len(g), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    begins = np.flatnonzero(fresh)
    occurrence = np.empty(len(g), np.uint64)
    occurrence[order] = np.arange(len(g)) - np.repeat(begins, np.diff(np.append(begins, len(g))))
    return np.where(occurrence > 0, mix(grams + occurrence * _LABEL), grams)


def order_minhash(kmers: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Each row's sketches: for each of SKETCHES orders of all k-mers, the KEPT least of the
    row's, hashed together in the order they have in the text."""
    found = np.zeros((rows, SKETCHES), np.int64)
    counts = np.bincount(row, minlength=rows)
    most = np.iinfo(np.uint64).max
    with np.errstate(divide="ignore"):
        share = np.minimum(_DRAWN / np.maximum(counts, 1), 1.0)
    limit = np.where(counts > 2 * _DRAWN, (share * 2.0**63).astype(np.uint64) * np.uint64(2), most)
    limits = limit[row]
    wanted = np.minimum(counts, KEPT)
    for s in range(SKETCHES):
        value = kmers * _SKETCH_FACTORS[s]
        drawn = np.flatnonzero(value <= limits)
        few = np.flatnonzero(np.bincount(row[drawn], minlength=rows) < wanted)
        if len(few):  # hardly ever: all their k-mers are drawn
            again = np.isin(row, few)
            drawn = np.union1d(drawn, np.flatnonzero(again))
        own = row[drawn]
        order = np.lexsort((value[drawn], own))
        begins = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=rows))])
        rank = np.arange(len(order)) - begins[own[order]]
        least = np.sort(drawn[order[rank < KEPT]])  # in text order again
        own = row[least]
        begins = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=rows))])
        table = np.zeros((rows, KEPT), np.uint64)
        table[own, np.arange(len(least)) - begins[own]] = kmers[least]
        sketch = np.full(rows, s + 1, np.uint64)
        for k in range(KEPT):
            sketch = mix(sketch * _LABEL + table[:, k])
        found[:, s] = sketch.view(np.int64)
    return found


def text_keys(data: np.ndarray, offsets: np.ndarray, text: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the MD5 of each row's words or, if it has none, of its bytes."""
    raw, plain = text.tobytes(), data.tobytes()
    digests = []
    low = 0
    for k, end in enumerate(ends.tolist()):
        body = raw[low:end].strip() if first[k] < first[k + 1] else b"\0" + plain[offsets[k] : offsets[k + 1]]
        digests.append(hashlib.md5(body).digest())
        low = end + 1
    halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return halves[:, 0], halves[:, 1]


#: The columns that are equal for texts of equal words: 128 bits, so that no two of 10**15 different
#: texts agree but with a probability of 10**-9.
KEY = ["key_a", "key_b"]


def with_keys(df: DataFrame, text: str, carry: list[str], sketched: bool) -> DataFrame:
    """The columns in ``carry`` with ``KEY``, equal for texts of equal words and null for null
    texts, and if asked for ``sketches``, null for texts without words, and ``short``, whether
    the text is compared without a common sketch too."""
    at = df.columns.index(text)
    kept = [df.columns.index(name) for name in carry]
    fields = [StructField(name, LongType()) for name in KEY]
    fields += [StructField("sketches", ArrayType(LongType())), StructField("short", BooleanType())] * sketched
    schema = schema_of(df.select(*carry), *fields)

    @frugal
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, at):
            words, first, normal, ends = word_hashes(data, offsets)
            null = np.asarray(batch.column(at).is_null())
            columns = [pa.array(half, mask=null) for half in text_keys(data, offsets, normal, ends, first)]
            if sketched:
                grams, row = shingles(words, first)
                sketches = order_minhash(labelled(grams, row), row, batch.num_rows)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(sketches.ravel()), SKETCHES).cast(pa.list_(pa.int64()))
                has_words = pa.array(np.diff(first) > 0)
                columns.append(pa.compute.if_else(has_words, lists, pa.scalar(None, lists.type)))
                order = np.lexsort((grams, row))
                g, r = grams[order], row[order]
                fresh = np.ones(len(g), bool)
                fresh[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
                distinct = np.bincount(r[fresh], minlength=batch.num_rows)
                columns.append(pa.array((distinct > 0) & (distinct <= _SHORT)))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], *columns], names=schema.names)

    return df.mapInArrow(read, schema)


def _along(a: np.ndarray, b: np.ndarray, x: int, y: int) -> int:
    """How many words agree from the two places on, looked at in stretches of growing length."""
    begin, size, most = x, 32, min(len(a) - x, len(b) - y)
    while most > 0:
        size = min(size, most)
        differ = a[x : x + size] != b[y : y + size]
        if differ.any():
            return x + int(differ.argmax()) - begin
        x, y, most, size = x + size, y + size, most - size, size * 2
    return x - begin


def edit_distance(a: np.ndarray, b: np.ndarray, band: int) -> int | None:
    """Words to delete and insert to make ``a`` into ``b``, if not more than ``band``: the
    alignment keeps to the diagonals that so many edits can reach, and on each goes on along
    equal words as far as it can. All diagonals of one number of edits are arrays, from which
    those go that cannot come back to the last word in time: memory is linear in the band, and
    time at most its square, of array elements."""
    n, m = len(a), len(b)
    if abs(n - m) > band:
        return None
    zero, none = band + 1, -(n + m + 2)
    reach = np.full(2 * band + 3, none, np.int64)  # how far into ``a`` each diagonal has come
    reach[zero + 1] = 0
    for edits in range(band + 1):
        low, high = max(-edits, n - m - (band - edits)), min(edits, n - m + (band - edits))
        low += (low + edits) % 2
        k = np.arange(low, high + 1, 2)
        x = np.maximum(reach[zero + k + 1], reach[zero + k - 1] + 1)
        going = np.arange(len(k))
        for _ in range(8):
            own, other = x[going], x[going] - k[going]
            inside = (own >= 0) & (own < n) & (other >= 0) & (other < m)
            going, own, other = going[inside], own[inside], other[inside]
            going = going[a[own] == b[other]]
            if not len(going):
                break
            x[going] += 1
        for i in going.tolist():  # the few that agree for long
            x[i] += _along(a, b, int(x[i]), int(x[i] - k[i]))
        reach[zero + k] = x
        if ((x >= n) & (x - k >= m)).any():
            return edits
    return None


def similar(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> bool:
    """Whether two rows of words are near duplicates: the Jaccard similarity of their shingles
    is at least ``threshold``, and so is the share of words that the alignment matches. So texts
    of the same passages in another order, or another number of times, are not."""
    one, _ = shingles(a, np.array([0, len(a)]))
    two, _ = shingles(b, np.array([0, len(b)]))
    one, two = np.unique(one), np.unique(two)
    common = len(np.intersect1d(one, two, assume_unique=True))
    if common < threshold * (len(one) + len(two) - common):
        return False
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    begin = int(differ[0]) if len(differ) else short
    rest = short - begin
    differ = np.flatnonzero(a[len(a) - rest :][::-1] != b[len(b) - rest :][::-1]) if rest else differ[:0]
    end = int(differ[0]) if len(differ) else rest
    band = int((1 - threshold) * (len(a) + len(b)) + 1e-9)
    return edit_distance(a[begin : len(a) - end], b[begin : len(b) - end], band) is not None


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of keys whose texts are near duplicates."""
    other = pairs.hint("shuffle_hash").join(texts.withColumnsRenamed({"key": "b", "text": "text_b"}), "b")
    both = other.join(texts.withColumnsRenamed({"key": "a", "text": "text_a"}), "a").select("a", "b", "text_a", "text_b")
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])

    @frugal
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, 2):
            one, first_one, _, _ = word_hashes(data, offsets)
            two, first_two, _, _ = word_hashes(*text_bytes(batch.column(3)))
            spans = zip(first_one[:-1], first_one[1:], first_two[:-1], first_two[1:])
            near = pa.array([similar(one[p:q], two[r:s]) for p, q, r, s in spans], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], names=["a", "b"])

    return both.mapInArrow(verify, schema)


def _across(texts: DataFrame) -> DataFrame:
    """All pairs (a, b) of keys with different roots whose shingles can be similar enough.

    With all shingles in one order, sets of n whose Jaccard similarity is at least t share one
    among the first n - ceil(t n) + 1 of either. In the order used, the fewer of the texts have
    a shingle the earlier it comes: what is left out of copies by their own edits fills that
    beginning, so copies too far apart seldom meet at all.
    """
    schema = StructType([StructField("key", LongType()), StructField("root", LongType()), StructField("grams", ArrayType(LongType()))])

    @frugal
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, 2):
            words, first, _, _ = word_hashes(data, offsets)
            grams, row = shingles(words, first)
            begins = np.searchsorted(row, np.arange(batch.num_rows + 1))
            sets = [np.unique(grams[x:y]).view(np.int64) for x, y in zip(begins[:-1], begins[1:])]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(np.concatenate(sets)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=schema.names)

    grams = texts.select("key", "root", "text").mapInArrow(read, schema)
    rows = grams.select("key", "root", F.size("grams").alias("n"), F.explode("grams").alias("gram")).repartition("gram")
    known = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("texts"), F.min("root").alias("low"), F.max("root").alias("high"))
    order = Window.partitionBy("key").orderBy("texts", "gram")
    begin = rows.join(known, "gram").withColumn("place", F.row_number().over(order))
    begin = begin.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * SIMILARITY - 1e-9) + 1)
    begin = cut(begin.where("low != high").select("key", "root", "n", "gram", "place"))
    # Pairs within one component are of no use, so the largest of a shingle's is not paired with itself.
    main = begin.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("keys")).groupBy("gram").agg(F.max(F.struct("keys", "root")).alias("main"))
    others = begin.join(main, "gram").where("root != main.root").select("gram", *[F.col(c).alias(f"{c}_a") for c in ("key", "root", "n", "place")])
    # Of their first common shingle on, both must have as many as they need in common.
    needed = (F.col("n") + F.col("n_a")) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9
    enough = F.least(F.col("n") - F.col("place"), F.col("n_a") - F.col("place_a")) + 1 >= needed
    # A pair of two keys that are both outside the largest component is met from either side.
    pairs = others.join(begin, "gram").where((F.col("root") != F.col("root_a")) & enough)
    return pairs.select(F.least("key", "key_a").alias("a"), F.greatest("key", "key_a").alias("b")).distinct()


def _agreeing(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose texts agree in at least AGREE sketches."""
    sketches = texts.select("key", "sketches")
    both = pairs.join(sketches.withColumnsRenamed({"key": "a", "sketches": "sa"}), "a").join(sketches.withColumnsRenamed({"key": "b", "sketches": "sb"}), "b")
    return both.where(F.size(F.array_intersect("sa", "sb")) >= AGREE).select("a", "b")


def near_duplicate_keys(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents' doc_id and KEY, and for each key its group: KEY, group_id, group_size,
    first (whether it is the key of the group's document that stays).

    Texts of equal words are one key from the start. Where a sketch is common to several keys,
    each is first held against one hub, the key whose sketches most others share, if they
    agree in AGREE. Components form; of the keys whose sketches still join different ones, and of
    all short texts, all pairs across components are compared but those that an exact bound on the
    similarity rules out. So every pair at the threshold is found, or in one component already,
    unless one of its texts is not short and shares no sketch with any key outside its component.
    """
    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("mark"))
    rows = cut(with_keys(plain, "text", ["doc_id", "mark"], sketched=True))
    # The text of a key is that of its row of least id, known again by a hash of its bytes too: null
    # and repeated ids say little.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "mark")).alias("least")
    keys = rows.where("key_a is not null").groupBy(*KEY).agg(least, F.count(F.lit(1)).alias("copies"), F.any_value("sketches").alias("sketches"), F.any_value("short").alias("short"))
    # From here on a key is a number, which the written table fixes.
    keys = cut(keys.select(F.monotonically_increasing_id().alias("key"), *KEY, F.col("least.doc_id").alias("least_id"), F.col("least.mark").alias("mark"), "copies", "sketches", "short"))

    entries = keys.where("sketches is not null").select("key", F.explode("sketches").alias("sketch")).repartition("sketch")
    sizes = entries.groupBy("sketch").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = cut(entries.join(sizes, "sketch"))
    score = members.groupBy("key").agg(F.sum("size").alias("score"))
    scored = members.select("sketch", "key").join(score, "key")
    hubs = scored.groupBy("sketch").agg(F.max(F.struct("score", "key")).alias("hub")).select("sketch", "hub.key", "hub.score")
    against = members.select("sketch", F.col("key").alias("b")).join(hubs.withColumnsRenamed({"key": "a", "score": "hub_score"}), "sketch").where("a != b")
    # Of its hubs, a key is held against the one it shares most sketches with.
    shared = against.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("hub_score").alias("hub_score"))
    best = shared.groupBy("b").agg(F.max(F.struct("n", "hub_score", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")

    short = keys.where("short").select("key")
    needed = members.select("key").union(short).distinct().join(keys.select("key", *KEY, "least_id", "mark", "sketches"), "key")
    wanted = needed.select("key", "least_id", F.col("mark").alias("least_mark"), *[F.col(c).alias(f"wanted_{c}") for c in KEY]).hint("shuffle_hash")
    source = plain.join(wanted, F.col("doc_id").eqNullSafe(F.col("least_id")) & (F.col("mark") == F.col("least_mark")))
    found = with_keys(source, "text", ["key", "text", *[f"wanted_{c}" for c in KEY]], sketched=False)
    texts = cut(found.where("key_a = wanted_key_a AND key_b = wanted_key_b").select("key", "text").dropDuplicates(["key"]))

    first = cut(_agreeing(best, needed))
    links = cut(_linked(first, texts))
    roots = connected_components(links)
    placed = members.select("sketch", "key").join(roots.withColumnRenamed("v", "key"), "key", "left").select("sketch", "key", F.coalesce("root", "key").alias("root"))
    open_sketches = placed.groupBy("sketch").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("sketch")
    alone = short.join(roots.withColumnRenamed("v", "key"), "key", "left").select("key", F.coalesce("root", "key").alias("root"))
    rest = placed.join(open_sketches, "sketch").select("key", "root").union(alone).distinct()
    across = _across(texts.join(rest, "key"))
    tested = first.union(first.select("b", "a"))
    more = _linked(cut(across.join(tested, ["a", "b"], "left_anti")), texts)
    roots = connected_components(links.union(more))

    grouped = keys.select("key", *KEY, "least_id", "copies").join(roots.withColumnRenamed("v", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    winner = F.min(F.struct(F.col("least_id").isNull().alias("unknown"), "least_id", "key"))
    groups = grouped.groupBy("root").agg(winner.alias("winner"), F.sum("copies").alias("group_size"))
    groups = groups.select("root", F.col("winner.least_id").alias("group_id"), F.col("winner.key").alias("winner"), "group_size")
    groups = grouped.select("key", *KEY, "root").join(groups, "root").select(*KEY, "group_id", "group_size", (F.col("key") == F.col("winner")).alias("first"))
    return rows.select("doc_id", *KEY), groups


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, group_id, group_size and stays of every document row.

    Groups are the connected components of near duplicates (see ``similar``), on words of
    ASCII letters and digits and non-ASCII characters, A-Z lower-cased; group_id is their
    least doc_id. Texts of equal words are copies; texts without words are copies if their
    bytes are equal. Null texts are groups of their own. Null ids count in a group's size and
    give its id only if it has no others. ``stays`` marks the rows with the group's id: one row,
    or equal ones if a row is repeated.
    """
    rows, groups = near_duplicate_keys(docs)
    joined = rows.join(groups, KEY, "left")
    alone = F.col("key_a").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("group_id")).alias("group_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("first") & F.col("doc_id").eqNullSafe(F.col("group_id")))).alias("stays"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, with their own columns, of which one of each group is kept: that with
    the least doc_id. All documents with a null text are kept."""
    rows, groups = near_duplicate_keys(docs)
    plain, at = numbered(docs)
    keyed = with_keys(plain, at["text"], plain.columns, sketched=False)
    staying = groups.where("first").select(*[F.col(c).alias(f"own_{c}") for c in KEY], "group_id")
    joined = keyed.join(staying, (F.col("key_a") == F.col("own_key_a")) & (F.col("key_b") == F.col("own_key_b")), "left")
    kept = joined.where(F.col("key_a").isNull() | (F.col("own_key_a").isNotNull() & F.col(at["doc_id"]).cast("long").eqNullSafe(F.col("group_id"))))
    repeated = rows.where("key_a is not null").groupBy(*KEY, "doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():
        kept = kept.where("key_a is null").unionByName(kept.where("key_a is not null").dropDuplicates(KEY))
    return kept.select(*plain.columns).toDF(*docs.columns)
