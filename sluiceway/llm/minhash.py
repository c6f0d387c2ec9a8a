"""Near-duplicates: minima of universal hashes in bands, checked on signatures and whole sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.anchored import mixed
from sluiceway.llm.components import components
from sluiceway.llm.shared import Staged, let_go

SHINGLE = 5
#: Bands of minima. Two sets of similarity 0.8 miss each other in all bands with chance 3e-6, of 0.85 with 7e-9.
BANDS, ROWS = 32, 5
#: A pair whose signatures agree in less than the threshold minus this share is no link; four to five
#: standard errors of the estimate.
SLACK = 0.15
#: Distinct words whose hashes a worker keeps; when full, it starts anew.
KEPT_WORDS = 200_000
#: So many documents at most are named to all tasks to find their texts; of more, texts and names are shuffled.
NAMED_ROWS = 1_000_000
#: Further centres of a bucket in the first round that needs them; eight times as many in each later one.
CENTRES = 64

#: Whether a bucket is the one of the first band that two documents share.
FIRST_SHARED = (
    f"bucket = element_at(filter(transform(sequence(0, {BANDS - 1}), "
    "i -> if(bands[i] = bands_of_centre[i], bands[i], NULL)), x -> x IS NOT NULL), 1)"
)

#: In how many of their minima two signatures agree.
AGREEING = (
    f"size(filter(sequence(0, {BANDS * ROWS - 1}), i -> "
    "substring(signature, 2 * i + 1, 2) = substring(signature_of_centre, 2 * i + 1, 2)))"
)

_draw = np.random.default_rng(20)
MULTIPLIERS = _draw.integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _draw.integers(0, 2**63, BANDS * ROWS, np.uint64)
PLACES = _draw.integers(0, 2**63, 16, np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


#: Of the worker, kept from task to task.
word_hashes = WordHashes()


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; with fewer words, one of all; without, none."""
    words = (text or "").encode().lower().split()  # bytes: lower-cases A-Z alone
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(word_hashes.__getitem__, words), np.uint64, len(words))
    count = max(1, len(codes) - size + 1)
    width = min(size, len(codes))
    total = np.full(count, width, np.uint64)
    for k in range(width):
        total += mixed(codes[k : k + count] + PLACES[k]) * PLACES[k + 8]
    return np.unique(mixed(total))


def minima(found: np.ndarray) -> np.ndarray:
    """The smallest value of each universal hash over a set."""
    least = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), 2048):
        part = found[start : start + 2048]
        np.minimum(least, (MULTIPLIERS[:, None] * part + OFFSETS[:, None]).min(axis=1), out=least)
    return least


def described(documents: DataFrame) -> DataFrame:
    """``doc``, ``n_shingles``, ``whole`` (digest of the set), ``bands``, ``signature``; null without words."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            size, whole, band, signature = [], [], [], []
            for value in batch.column("text"):
                found = shingles(value.as_py())
                size.append(len(found))
                if not len(found):
                    whole.append(None), band.append(None), signature.append(None)
                    continue
                least = mixed(minima(found))
                joint = (least.reshape(BANDS, ROWS) * PLACES[:ROWS]).sum(axis=1, dtype=np.uint64)
                whole.append(xxhash.xxh3_128_digest(found.tobytes()))
                band.append(mixed(joint + bands).view(np.int64))
                signature.append((least & np.uint64(0xFFFF)).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"), pa.array(size, pa.int64()), pa.array(whole, pa.binary()),
                    pa.array(band, pa.list_(pa.int64())), pa.array(signature, pa.binary()),
                ],
                names=["doc", "n_shingles", "whole", "bands", "signature"],
            )

    kind = documents.schema["doc"].dataType.simpleString()
    return documents.mapInArrow(
        describe, f"doc {kind}, n_shingles long, whole binary, bands array<long>, signature binary"
    )


def sets_of(documents: DataFrame) -> DataFrame:
    """``doc`` and ``members``, the sorted hashes of its shingles."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(x.as_py()).tobytes() for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(found, pa.binary())], names=["doc", "members"])

    kind = documents.schema["doc"].dataType.simpleString()
    return documents.mapInArrow(gather, f"doc {kind}, members binary")


class Links:
    """Pairs checked on signatures, then on whole sets."""

    def __init__(self, sets: DataFrame, heads: DataFrame, percent: int):
        self.sets, self.percent = sets, percent
        self.heads = heads.select("doc", "n_shingles", "signature")
        self.kind = sets.schema["doc"].dataType.simpleString()

    def joined(self, pairs: DataFrame, side: DataFrame) -> DataFrame:
        """Pairs with what a table has of both ends, the pairs on the side that a join can split."""
        for end in ("a", "b"):
            pairs = pairs.join(
                side.select(F.col("doc").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in side.columns if c != "doc")), end
            )
        return pairs

    def of(self, pairs: DataFrame) -> Staged:
        """The links among pairs (``a``, ``b``)."""
        percent, kind = self.percent, self.kind

        def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                one, two = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                    for c in ("signature_a", "signature_b")
                )
                near = (one == two).mean(axis=1) >= percent / 100 - SLACK if batch.num_rows else np.zeros(0, bool)
                yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for x, y in zip(batch.column("members_a"), batch.column("members_b"), strict=True):
                    one, two = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    common = len(np.intersect1d(one, two, assume_unique=True))
                    keep.append(100 * common >= percent * (len(one) + len(two) - common))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        sized = self.joined(pairs, self.heads).where(
            f"100 * least(n_shingles_a, n_shingles_b) >= {percent} * greatest(n_shingles_a, n_shingles_b)"
        )
        likely = Staged(sized.select("a", "b", "signature_a", "signature_b").mapInArrow(agree, f"a {kind}, b {kind}"), "pairs")
        near = likely.read()
        found = self.joined(near, self.sets).select("a", "b", "members_a", "members_b")
        links = Staged(found.mapInArrow(meet, f"a {kind}, b {kind}").distinct(), "links")
        likely.discard()
        let_go(pairs.sparkSession)
        return links


def merged(groups: DataFrame | None, links: DataFrame) -> DataFrame:
    """Groups (``doc``, ``group``) joined by links; documents without links are not listed."""
    if groups is None:
        return components(links).withColumnsRenamed({"a": "doc", "component": "group"})
    ends = links
    for end in ("a", "b"):
        ends = ends.join(groups.withColumnsRenamed({"doc": end, "group": f"{end}_group"}), end, "left").withColumn(
            f"{end}_group", F.coalesce(f"{end}_group", end)
        )
    new = components(ends.select(F.col("a_group").alias("a"), F.col("b_group").alias("b")))
    lifted = groups.join(new, groups["group"] == new["a"], "left").select(
        "doc", F.coalesce("component", "group").alias("group")
    )
    alone = new.join(groups.select(F.col("doc").alias("a")), "a", "left_anti")
    return lifted.unionByName(alone.select(F.col("a").alias("doc"), F.col("component").alias("group")))


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """A row per document: key, ``n_shingles``, ``component_id``, ``kept``.

    Texts with one set are reduced to the smallest key before anything else. Buckets of a band take
    their smallest key as centre, and every member is checked against it, first where most bands
    agree. A bucket whose members are then in several groups takes all that are outside its largest
    group as further centres, in growing rounds, until one group is left or all have been centre. So
    the work grows with the rows and the odd members, never with all pairs of a group, and no
    candidate of any band is left out.

    Null and empty texts have no set, are linked with nothing and kept. A null key links nothing and
    is kept, with a null component. Repeated keys are one document with the links of all its texts, in
    every one of its rows. Equal rows get equal results; other columns are not read; no rows give none.
    """
    source = documents.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    staged = Staged(described(source), "described")
    every = staged.read()
    named = every.where("doc IS NOT NULL AND whole IS NOT NULL")
    firsts = Staged(named.groupBy("whole").agg(F.min("doc").alias("head")), "heads")
    heads = Staged(
        named.join(firsts.read().select("whole", F.col("head").alias("doc")), ["whole", "doc"], "left_semi"), "head-rows"
    )
    # a document with several sets is one with the first of each
    several = named.groupBy("doc").agg(F.min("whole").alias("one"), F.max("whole").alias("two")).where("one <> two")
    own = named.join(several.select("doc"), "doc", "left_semi").join(firsts.read(), "whole")
    same = Staged(own.where("doc <> head").select(F.col("doc").alias("a"), F.col("head").alias("b")).distinct(), "own-links")
    rows = heads.read().select("doc", F.explode("bands").alias("bucket"))
    buckets = rows.groupBy("bucket").agg(F.min("doc").alias("centre"), F.max("doc").alias("last")).where("centre <> last")
    members = Staged(rows.join(buckets.select("bucket", "centre"), "bucket").distinct(), "members")
    stars = Staged(
        members.read().where("doc <> centre").groupBy("doc", "centre").agg(F.count(F.lit(1)).alias("bands")), "stars"
    )
    # the sets of all that share a bucket; texts are not shuffled while the names of these are few
    sharing = Staged(members.read().select("doc").distinct(), "sharing")
    some = sharing.read()
    some = F.broadcast(some) if some.count() <= NAMED_ROWS else some.hint("shuffle_hash")
    sets = Staged(sets_of(source.join(some, "doc", "left_semi")), "sets")
    sharing.discard()
    let_go(documents.sparkSession)
    check = Links(sets.read(), heads.read(), percent)

    # first, the centre with which a document shares most bands
    best = stars.read().groupBy("doc").agg(F.max_by("centre", F.struct("bands", -F.col("centre"))).alias("centre"))
    links = check.of(best.select(F.least("doc", "centre").alias("a"), F.greatest("doc", "centre").alias("b")).distinct())
    groups = Staged(merged(None, links.read().unionByName(same.read())), "groups")
    used = [links, same]
    tested = best
    # then the other centres, where they could still join two groups
    rest = apart(stars.read().join(tested, ["doc", "centre"], "left_anti"), "doc", "centre", groups.read())
    links = check.of(rest.select(F.least("doc", "centre").alias("a"), F.greatest("doc", "centre").alias("b")).distinct())
    used += [links, groups, stars]
    groups = Staged(merged(groups.read(), links.read()), "groups")
    discard(used)

    limit, left = CENTRES, []
    state = members.read().where("doc <> centre").select("bucket", "doc")
    while True:
        now = state.join(groups.read(), "doc", "left").select("bucket", "doc", F.coalesce("group", "doc").alias("group"))
        open_rows = Staged(several_groups(now), "open")
        opened = open_rows.read()
        if opened.isEmpty():
            open_rows.discard()
            break
        shared = shared_sizes(sets.read(), opened, heads.read())
        # what a document is compared by is put together once, not in each of its buckets
        facts = shared.read().where(f"100 * shared >= {percent} * size")
        able = several_groups(opened.join(facts.select("doc"), "doc", "left_semi"))
        facts = facts.join(heads.read().select("doc", "bands", "signature"), "doc").join(listed(sets.read()), "doc")
        able_rows = Staged(able.join(facts, "doc"), "able")
        able = able_rows.read()
        sizes = able.groupBy("bucket", "group").agg(F.count(F.lit(1)).alias("rows"))
        largest = sizes.groupBy("bucket").agg(F.max_by("group", F.struct("rows", "group")).alias("main"))
        turn = Window.partitionBy("bucket").orderBy("doc")
        centre_rows = Staged(
            able.join(largest, "bucket")
            .where("group <> main")
            .withColumn("turn", F.row_number().over(turn))
            .where(F.col("turn") <= limit)
            .select("bucket", *(F.col(c).alias(f"{c}_of_centre") for c in ("doc", "group", "size", "shared", "bands", "signature", "members"))),
            "centres",
        )
        centres = centre_rows.read()
        common = F.least("shared", "shared_of_centre")
        both = F.size(F.array_intersect("members", "members_of_centre"))
        # the join gives links alone: what is cheap to compare comes first, whole sets last
        found = (
            able.join(centres, "bucket")
            .where(F.col("group") != F.col("group_of_centre"))
            .where(100 * common >= percent * (F.col("size") + F.col("size_of_centre") - common))
            .where(FIRST_SHARED)  # a pair is made in one bucket only
            .where(f"{AGREEING} >= {(percent / 100 - SLACK) * BANDS * ROWS}")
            .where(100 * both >= percent * (F.size("members") + F.size("members_of_centre") - both))
            .select(F.least("doc", "doc_of_centre").alias("a"), F.greatest("doc", "doc_of_centre").alias("b"))
            .distinct()
        )
        links = Staged(found, "links")
        used = [open_rows, shared, able_rows, centre_rows, links, groups, *left]
        groups = Staged(merged(groups.read(), links.read()), "groups")
        been = centres.select("bucket", F.col("doc_of_centre").alias("doc"))
        left = [Staged(able.select("bucket", "doc").join(been, ["bucket", "doc"], "left_anti"), "left")]
        state = left[0].read()
        discard(used)
        limit *= 8
        let_go(documents.sparkSession)
    discard([heads, members, sets, *left])

    rows = every.select("doc", "n_shingles", "whole")
    # a row without words has the component of its document's other rows
    other = named.join(every.where("whole IS NULL").select("doc").distinct(), "doc", "left_semi")
    other = Staged(other.groupBy("doc").agg(F.min("whole").alias("other")), "other-rows")
    if not other.read().isEmpty():
        rows = rows.join(other.read(), "doc", "left").withColumn("whole", F.coalesce("whole", "other")).drop("other")
    result = (
        rows
        .join(firsts.read(), "whole", "left")
        .join(groups.read().withColumnRenamed("doc", "head"), "head", "left")
    )
    component = F.when(F.col("doc").isNotNull(), F.coalesce("group", "head", "doc"))
    return result.select(
        F.col("doc").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"),
    )


def discard(tables: list[Staged]) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        table.discard()


def listed(sets: DataFrame) -> DataFrame:
    """``doc`` and ``members`` as an array that the JVM can intersect."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("members")]
            starts = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            values = pa.array(np.concatenate([*found, np.zeros(0, np.int64)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.ListArray.from_arrays(pa.array(starts), values)], names=["doc", "members"]
            )

    kind = sets.schema["doc"].dataType.simpleString()
    return sets.mapInArrow(read, f"doc {kind}, members array<long>")


def several_groups(rows: DataFrame) -> DataFrame:
    """Rows of buckets with more than one group."""
    mixed_up = rows.groupBy("bucket").agg(F.min("group").alias("one"), F.max("group").alias("two")).where("one <> two")
    return rows.join(mixed_up.select("bucket"), "bucket", "left_semi")


def shared_sizes(sets: DataFrame, rows: DataFrame, heads: DataFrame) -> Staged:
    """``doc``, ``size`` of its set and ``shared``, how many of it some other document of the rows has.

    Two documents have no more in common than the smaller of their shared numbers, so these bound
    their similarity from above, exactly. Of a document with several texts it is the smallest size
    and all that its texts share; one that shares nothing is not listed.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("members")]
            owner = np.repeat(np.arange(batch.num_rows), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").take(pa.array(owner)),
                    pa.array(np.concatenate([*found, np.zeros(0, np.int64)])),
                ],
                names=["doc", "shingle"],
            )

    kind = sets.schema["doc"].dataType.simpleString()
    some = sets.join(rows.select("doc").distinct(), "doc", "left_semi")
    staged = Staged(some.mapInArrow(spread, f"doc {kind}, shingle long"), "shingles")
    each = staged.read()
    common = each.groupBy("shingle").agg(F.min("doc").alias("one"), F.max("doc").alias("two")).where("one <> two")
    sizes = heads.groupBy("doc").agg(F.min("n_shingles").alias("size"))
    counts = each.join(common.select("shingle"), "shingle", "left_semi").groupBy("doc").agg(F.count(F.lit(1)).alias("shared"))
    found = Staged(counts.join(sizes, "doc"), "shared")
    staged.discard()
    return found


def apart(pairs: DataFrame, one: str, two: str, groups: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one group yet."""
    for end in (one, two):
        pairs = pairs.join(groups.withColumnsRenamed({"doc": end, "group": f"{end}_group"}), end, "left").withColumn(
            f"{end}_group", F.coalesce(f"{end}_group", end)
        )
    return pairs.where(f"{one}_group <> {two}_group").drop(f"{one}_group", f"{two}_group")
