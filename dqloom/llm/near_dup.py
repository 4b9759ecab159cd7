"""Near-duplicate documents: SuperMinHash, banding, verification, union-find.

A document's set are its distinct ``WORDS``-word shingles (fewer words: all of them as one shingle;
A-Z lower-cased, parted by ASCII white space). SuperMinHash gives every element a random permutation of
the registers; its j-th step offers j plus a fraction to one register. Offers of step j only matter to
registers that hold more than j, so steps end early; all elements of many documents are taken together,
step by step. ``REGISTERS`` registers make ``BANDS`` bands of ``ROWS``; at similarity 0.75 a pair shares no
band with probability 8e-6. Bands are that long because of passages which very many documents share: a
document falls into the passage's bucket of a band with the passage's share of its set to the power ``ROWS``.

Documents with equal sets are one class, represented by its smallest id; only representatives are
banded. Members of a bucket are verified against its smallest member. A pair of the bucket that is still
in two components then has a member outside the first one's component: those members are verified against
some more members, and where that does not connect them against all others of the bucket, but for those that
they can't be similar to: too few shingles of either occur in any document of another component, or the two differ
from one third document in too much that is not the same. Near copies of one text differ from it in little, most of it their own,
so the second rule settles a large group of them from what each differs in. So every pair that shares a band is verified, ruled out or connected, without all pairs of a group being made. Links are verified on full sets: 100 * both >= 75 * any.

Null and empty texts and texts of white space have empty sets and are linked with nothing. Rows without id
are linked with nothing; their component is null and they are kept. Rows with the same id are one node
with several sets. Ties go to the smaller id. Further columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.functions.text import quoted
from dqloom.llm.common import LOWER, RangeHash, arrow_pass, cut, drop, in_rows, mix, slices
from dqloom.llm.components import components

WORDS = 5
ROWS, BANDS = 6, 60
REGISTERS = ROWS * BANDS
SIMILARITY = 75  # in hundredths
PROBES = 2
#: Groups, by hash, in which two sets' differences from a third one are counted and compared.
PARTS = 16
#: Bits of one bitmap of Spark's functions, and the most that a set of ids is marked in (16 MB).
BITS_PER_BLOCK, MOST_BITS = 2**15, 2**27


@functools.lru_cache(maxsize=1)
def _hash() -> RangeHash:
    return RangeHash(500_000)


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text."""
    plain = [b" ".join((t or "").encode().translate(LOWER).split()) for t in texts]
    data = np.frombuffer(b"\n".join([*plain, b""]), np.uint8)
    breaks = np.flatnonzero((data == 32) | (data == 10))
    starts = np.concatenate([[0], breaks[:-1] + 1]) if len(breaks) else breaks
    real = breaks > starts
    starts, ends = starts[real], breaks[real]
    counts = np.array([p.count(b" ") + 1 if p else 0 for p in plain])
    first = np.cumsum(counts) - counts
    hasher = _hash()
    sums = hasher.prefixes(data)
    out = []
    inside = hasher.of(sums, starts[: len(starts) - words + 1], ends[words - 1 :]) if len(starts) >= words else None
    for f, n in zip(first.tolist(), counts.tolist()):
        if n >= words:
            out.append(np.unique(inside[f : f + n - words + 1]))
        elif n:
            out.append(hasher.of(sums, starts[f : f + 1], ends[f + n - 1 : f + n]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def super_min_hash(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """Signatures (rows of ``registers``) of sets of 64-bit hashes; empty sets stay infinite."""
    m = registers
    signature = np.full((len(sets), m), np.inf)
    flat = signature.reshape(-1)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate([*sets, np.zeros(0, np.uint64)])
    order = None  # permutation so far, by element; at step 0 nothing has been swapped
    for j in range(m):
        if j:
            active = signature.max(1) > j
            keep = active[owner]
            owner, elements = owner[keep], elements[keep]
            if order is not None:
                order = order[keep]
            if not len(owner):
                break
            if order is None:
                order = np.tile(np.arange(m, dtype=np.uint16), (len(owner), 1))
                _swap(order, 0, _step(elements, 0, m)[0])
        k, fraction = _step(elements, j, m)
        place = k if order is None else _swap(order, j, k)
        np.minimum.at(flat, owner * m + place, j + fraction)
    return signature


def _step(elements: np.ndarray, j: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Each element's swap position and fraction of step j."""
    drawn = mix(elements + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
    k = j + ((drawn >> np.uint64(40)) % np.uint64(m - j)).astype(np.int64)
    fraction = (mix(drawn + np.uint64(1)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return k, fraction


def _swap(order: np.ndarray, j: int, k: np.ndarray) -> np.ndarray:
    """Exchange places j and k of every permutation; what is now at j."""
    rows = np.arange(len(order))
    taken = order[rows, k].copy()
    order[rows, k] = order[:, j]
    order[:, j] = taken
    return taken.astype(np.int64)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for every band of every signature."""
    bits = signature.view(np.uint64).reshape(len(signature), BANDS, ROWS)
    key = np.zeros(bits.shape[:2], np.uint64)
    for r in range(ROWS):
        key = mix(key + bits[:, :, r] + np.uint64(r + 1))
    return key.view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a 128-bit fingerprint of the set, band keys (none for an empty set)."""

    def make(batch):
        texts = batch.column(1).to_pylist()
        for a, b in slices(np.array([len(t or "") for t in texts]), 300_000):
            sets = shingle_sets(texts[a:b])
            keys = band_keys(super_min_hash(sets))
            sizes = [len(s) for s in sets]
            bands = pa.array([k.tolist() if n else [] for k, n in zip(keys, sizes)], pa.list_(pa.int64()))
            prints = [(mix(s).sum(), mix(s ^ np.uint64(0xA5A5A5A5)).sum()) for s in sets]
            yield {
                "doc_id": batch.column(0)[a:b],
                "n_shingles": pa.array(sizes, pa.int64()),
                "f1": pa.array(np.array([p[0] for p in prints], np.uint64).view(np.int64)),
                "f2": pa.array(np.array([p[1] for p in prints], np.uint64).view(np.int64)),
                "bands": bands,
            }

    schema = "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>"
    return arrow_pass(docs.select(F.col("doc_id").cast("long"), "text"), make, schema)


def _marks(ids: DataFrame) -> tuple[int, dict[int, bytes]]:
    """A number of bits, and which of them hashes of the ids set: blocks of bits by number.

    Some more ids than those named have such a hash; none that is named has another.
    """
    bits, wanted = BITS_PER_BLOCK, min(MOST_BITS, 32 * ids.count())
    while bits < wanted:
        bits *= 2
    place = _place(bits)
    blocks = ids.groupBy(F.bitmap_bucket_number(place).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("marks")
    )
    return bits, {row["block"]: bytes(row["marks"]) for row in blocks.collect()}


def _place(bits: int) -> Column:
    """The bit of a ``doc_id``, from 1."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(bits)) + 1


def _sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and its full set, for the named documents.

    Texts are never shuffled: each task picks its documents by a bitmap of the ids' hashes, and of the sets
    of what it picked those of other ids are dropped.
    """
    bits, blocks = _marks(ids)
    marks = np.zeros(bits // 8, np.uint8)
    for block, data in blocks.items():
        at = (block - 1) * (BITS_PER_BLOCK // 8)
        marks[at : at + len(data)] = np.frombuffer(data, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(marks)

    def make(batch):
        place = batch.column(2).to_numpy() - 1
        named = (shared.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1
        kept = batch.filter(pa.array(named.astype(bool)))
        texts = kept.column(1).to_pylist()
        for a, b in slices(np.array([len(t or "") for t in texts]), 400_000):
            sets = [s.view(np.int64) for s in shingle_sets(texts[a:b])]
            places = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            yield {
                "doc_id": kept.column(0)[a:b],
                "shingles": pa.ListArray.from_arrays(places, np.concatenate(sets)),
            }

    own = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    picked = arrow_pass(own.withColumn("place", _place(bits)), make, "doc_id long, shingles array<long>")
    return picked.join(ids, "doc_id", "left_semi")


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    ids = cut(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    sets = cut(_sets_of(docs, ids), "sets")
    drop(ids)
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    any_ = F.size("of_a") + F.size("of_b") - both
    links = pairs.join(one, "a").join(two, "b").where(both * 100 >= any_ * SIMILARITY).select("a", "b")
    found = cut(links.distinct(), "links")
    drop(sets)
    return found


def _near_in_size(a: str, b: str):
    """No pair can be similar enough whose sizes are too different."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * SIMILARITY


def find_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row for every row of ``docs``."""
    signed = cut(signatures(docs), "signatures")
    linked = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["f1", "f2", "n_shingles"]
    classes = cut(
        linked.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands")),
        "classes",
    )
    buckets = classes.select("rep", F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "key"))
    # dealt once for counting and joining; near copies of one text are at most 1 / BANDS of the rows of a key
    buckets = buckets.repartition("band", "key")
    firsts = buckets.groupBy("band", "key").agg(
        F.min(F.struct("rep", "n")).alias("first"), F.count("*").alias("members")
    ).where("members > 1")
    shared = cut(
        buckets.join(firsts, ["band", "key"]).select(
            "band", "key", "rep", "n", F.col("first.rep").alias("first"), F.col("first.n").alias("first_n")
        ),
        "buckets",
    )
    stars = shared.where((F.col("rep") != F.col("first")) & _near_in_size("n", "first_n"))
    tried = cut(stars.select(F.col("rep").alias("a"), F.col("first").alias("b")).distinct(), "stars")
    links = verified(docs, tried)
    labels = components(links)
    # a member outside the first one's component meets other members: some probes, then all that are left
    held = cut(_open_buckets(shared, labels), "open-buckets")
    drop(shared)
    for turn in range(PROBES + 1):
        used: list[DataFrame] = []
        pairs = _probed(held, labels, turn) if turn < PROBES else _across(docs, held, labels, used)
        pairs = cut(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        for table in used:
            drop(table)
        if pairs.isEmpty():
            continue
        tried = tried.union(pairs)
        links = links.union(verified(docs, pairs))
        labels = components(links)
    drop(held)
    own = linked.join(classes.select(*same, "rep"), same).select("doc_id", "rep")
    merged = _with_repeats(own, labels)
    found = signed.select("doc_id", "n_shingles").join(merged, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _placed(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets with their component and that of the bucket's first member (``head``)."""
    named = labels.select(F.col("node").alias("rep"), "component")
    heads = labels.select(F.col("node").alias("first"), F.col("component").alias("head"))
    return shared.join(named, "rep", "left").join(heads, "first", "left").select(
        "band", "key", "rep", "n", "first",
        F.coalesce("component", "rep").alias("component"), F.coalesce("head", "first").alias("head"),
    )


def _open_buckets(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold several components."""
    placed = _placed(shared, labels)
    several = placed.where("component <> head").select("band", "key").distinct()
    return placed.join(several, ["band", "key"], "left_semi").select("band", "key", "rep", "n", "first")


def _pairs(
    outside: DataFrame, others: DataFrame, reach: DataFrame | None = None, unlike: DataFrame | None = None
) -> DataFrame:
    """Members outside with others of their bucket in another component, as distinct (a, b).

    ``reach`` (rep, c) says how many shingles of a member any document of another component has: it can't have more
    in common with one of them. ``unlike`` says what it differs in from the head of its bucket: two members differ in all
    of that which is not the same. Pairs that the bounds of both rule out are left out.
    """
    named = {"rep": "x", "n": "x_n", "component": "x_component"}
    own = outside.withColumnsRenamed(named)
    near = _near_in_size("n", "x_n")
    if reach is not None:
        bound = reach.select("rep", "c")
        others = others.join(bound, "rep")  # a member that is not in it has nothing in common
        own = own.join(bound.select(F.col("rep").alias("x"), F.col("c").alias("x_c")), "x")
        most = F.least("c", "x_c")
        near = near & (most * 100 >= (F.col("n") + F.col("x_n") - most) * SIMILARITY)
    if unlike is not None:
        parts = [f"g{i}" for i in range(PARTS)]
        others = others.join(unlike, ["head", "rep"], "left")
        of_x = unlike.withColumnsRenamed({"rep": "x", "d": "x_d"} | {c: f"x_{c}" for c in parts})
        own = own.join(of_x, ["head", "x"], "left")
        same = sum((F.least(c, f"x_{c}") for c in parts), F.lit(0))
        apart = F.col("d") + F.col("x_d") - 2 * same
        # similar sets differ in no more than this share of both sizes; without bounds a pair stays
        near = near & F.coalesce(apart * (100 + SIMILARITY) <= (F.col("n") + F.col("x_n")) * (100 - SIMILARITY), F.lit(True))
    joined = own.drop("head", "first").join(others, ["band", "key"]).where((F.col("component") != F.col("x_component")) & near)
    return joined.select(F.greatest("x", "rep").alias("a"), F.least("x", "rep").alias("b")).distinct()


def _open_sets(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """The sets of the members of buckets and of the buckets' heads."""
    ids = cut(placed.select(F.explode(F.array("rep", "head")).alias("doc_id")).distinct(), "open-ids")
    sets = cut(_sets_of(docs, ids), "open-sets")
    drop(ids)
    return sets


def _reach(sets: DataFrame, placed: DataFrame) -> DataFrame:
    """For every member of the buckets, how many of its shingles a member of another component has."""
    # an id with two sets counts for both: a bound all the same
    named = sets.withColumnRenamed("doc_id", "rep").join(placed.select("rep", "component").distinct(), "rep")
    each = named.select("rep", "component", F.explode("shingles").alias("s"))
    ends = each.groupBy("s").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    common = ends.where("low <> high").select("s")
    return cut(each.join(common, "s").groupBy("rep").agg(F.count("*").alias("c")), "reach")


def _unlike(sets: DataFrame, placed: DataFrame) -> DataFrame:
    """For members of buckets and the heads of these: in how many shingles (``d``) their sets differ.

    Columns ``g0`` and on count, by parts, those shingles that a member of another component differs in from that
    head as well. Members that have less than half in common with the head are not listed, nor ids with several sets.
    """
    one = sets.groupBy("doc_id").agg(F.min("shingles").alias("own"), F.max("shingles").alias("last"))
    one = one.where("own = last").select("doc_id", "own")
    pairs = placed.select("head", "rep", "component").distinct()
    joined = pairs.join(one.withColumnRenamed("doc_id", "rep"), "rep").join(
        one.select(F.col("doc_id").alias("head"), F.col("own").alias("of_head")), "head"
    )
    both = F.size(F.array_intersect("own", "of_head"))
    joined = joined.where(both * 3 >= F.size("own") + F.size("of_head"))
    differing = F.concat(F.array_except("own", "of_head"), F.array_except("of_head", "own"))
    each = joined.select("head", "rep", "component", F.explode_outer(differing).alias("s"))
    ends = each.groupBy("head", "s").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    common = ends.where("low <> high").select("head", "s", F.pmod("s", F.lit(PARTS)).alias("part"))
    counts = [F.count(F.when(F.col("part") == i, 1)).alias(f"g{i}") for i in range(PARTS)]
    found = each.join(common, ["head", "s"], "left").groupBy("head", "rep").agg(F.count("s").alias("d"), *counts)
    return cut(found, "unlike")


def _probed(shared: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """Members outside with one other member of each of their buckets.

    Every bucket chooses by a hash of its own, so a member meets up to ``BANDS`` others a turn, most often
    those like itself. In a large group that settles all but the few that are unlike most.
    """
    placed = _placed(shared, labels)
    order = F.xxhash64("rep", "band", F.lit(turn))
    chosen = placed.groupBy("band", "key").agg(F.min(F.struct(order.alias("o"), "rep", "n", "component")).alias("m"))
    return _pairs(placed.where("component <> head"), chosen.select("band", "key", "m.rep", "m.n", "m.component"))


def _across(docs: DataFrame, shared: DataFrame, labels: DataFrame, used: list[DataFrame]) -> DataFrame:
    """Members outside with all others of their buckets that they can be similar to; ``used`` gets what it wrote."""
    left = cut(_open_buckets(shared, labels), "open-buckets")
    placed = _placed(left, labels)
    sets = _open_sets(docs, placed)
    reach, unlike = _reach(sets, placed), _unlike(sets, placed)
    drop(sets)
    used += [left, reach, unlike]
    return _pairs(placed.where("component <> head"), placed, reach, unlike)


def _with_repeats(own: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and component; ids that occur with several sets join the components of all of them."""
    placed = own.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", F.coalesce("component", "rep").alias("component")
    )
    per_id = placed.groupBy("doc_id").agg(F.min("component").alias("component_id"), F.max("component").alias("last"))
    split = per_id.where("component_id <> last")
    if split.isEmpty():
        return per_id.drop("last")
    ties = components(placed.join(split.select("doc_id"), "doc_id").select(
        F.col("component").alias("a"), F.col("doc_id").alias("b")).union(
        split.select(F.col("last").alias("a"), F.col("component_id").alias("b"))))
    final = per_id.join(ties.select(F.col("node").alias("component_id"), F.col("component").alias("joined")), "component_id", "left")
    return final.select("doc_id", F.coalesce("joined", "component_id").alias("component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group, with all columns: the one with the smallest id.

    Rows without id are kept. Where ids repeat, rows are told apart by their place in a written table: rows that share
    an id and no text are no group, and of rows with one id the first of that table stays.
    """
    repeats = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if repeats.isEmpty():
        found = cut(find_groups(docs), "groups")
        gone = found.where("NOT kept").select("doc_id")
        return docs.join(gone, "doc_id", "left_anti").select(*map(quoted, docs.columns))
    numbered = in_rows(docs).select("text", "row", F.monotonically_increasing_id().alias("place"))
    numbered = cut(numbered, "numbered")
    named = numbered.where("row.doc_id IS NOT NULL")
    groups = find_groups(named.select(F.col("place").alias("doc_id"), "text"))
    ids = named.select("place", F.col("row.doc_id").cast("long").alias("id"))
    placed = groups.select(F.col("doc_id").alias("place"), "component_id").join(ids, "place")
    first = placed.groupBy("component_id").agg(F.min(F.struct("id", "place")).alias("first"))
    kept = numbered.join(cut(first.select(F.col("first.place").alias("place")), "kept"), "place", "left_semi")
    return kept.select("row.*").unionByName(numbered.where("row.doc_id IS NULL").select("row.*"))
