"""Similarity join on word shingles by chosen paths."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.carried import packed, returning, unpacked
from sedimenta.llm.components import components
from sedimenta.llm.texts import mixed, shingle_sets
from sedimenta.session import stored

#: Sampled tokens per set: of each of so many hash orders, the first token.
SAMPLED = 128
#: A node's sets are split on one sampled token, in one node of SECOND on two.
SECOND = 4
#: A node that keeps this share of its parent's sets is a cluster that more splits
#: would only copy: it is a leaf, compared in blocks.
CLUSTER = 0.7
#: Sets per block of a large leaf.
BLOCK = 2048
_SEEDS = np.random.default_rng(977).integers(0, 1 << 63, SAMPLED, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ID_SEED = np.uint64(0x5851F42D4C957F2D)


def runs_needed(similarity: float, depth: int, recall: float) -> int:
    """How often to repeat so that a pair of the least similarity meets in a leaf
    with probability ``recall``, even where every path takes ``depth`` splits."""
    meets = 1.0
    for _ in range(depth):
        once = similarity * meets
        meets = (1 - 1 / SECOND) * once + (1 / SECOND) * (1 - (1 - once) ** 2)
    return ceil(log(1 - recall) / log(1 - meets))


def set_ids(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit id per set of shingles, the same in any order; 0 for the empty set."""
    return np.array([(mixed(s ^ _ID_SEED).sum(dtype=np.uint64) | np.uint64(1)) if len(s) else 0 for s in sets], dtype=np.uint64).astype(np.int64)


def sampled_tokens(sets: list[np.ndarray]) -> np.ndarray:
    """Rows of SAMPLED 32-bit values; sets agree in one with the probability of
    their Jaccard similarity.  No set may be empty."""
    flat = np.concatenate(sets)
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), SAMPLED), np.uint32)
    for j, seed in enumerate(_SEEDS):
        out[:, j] = np.minimum.reduceat((flat * seed) >> np.uint64(32), first)
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            sets = shingle_sets([(t or "").encode() for t in part.column(1).to_pylist()])
            full = [i for i, s in enumerate(sets) if len(s)]
            tokens = np.zeros((len(sets), SAMPLED), np.int32)
            if full:
                tokens[full] = sampled_tokens([sets[i] for i in full]).view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(set_ids(sets)),
                    pa.array(np.array([len(s) for s in sets], np.int64)),
                    pa.FixedSizeListArray.from_arrays(pa.array(tokens.ravel()), SAMPLED).cast(pa.list_(pa.int32())),
                    pa.array([row.tobytes() for row in tokens.astype(np.uint8)], pa.binary()),
                ],
                names=["doc_id", "sid", "n", "tokens", "sketch"],
            )


def _children(node: Column | None, run: int | None) -> Column:
    """Keys of the child nodes a set goes to; which sampled token splits a node is
    drawn from the node's own key."""

    def child(which: int, place: Column) -> Column:
        return F.xxhash64(parent, F.lit(which), F.element_at("tokens", place + 1))

    parent = F.lit(run).cast("long") if node is None else node
    draw = F.xxhash64(parent, F.lit("split"))
    first = F.pmod(draw, F.lit(SAMPLED)).cast("int")
    other = F.pmod(first + 1 + F.pmod(F.shiftrightunsigned(draw, 8), F.lit(SAMPLED - 1)).cast("int"), F.lit(SAMPLED))
    two = F.pmod(F.shiftrightunsigned(draw, 24), F.lit(SECOND)) == 0
    return F.when(two, F.array(child(0, first), child(1, other))).otherwise(F.array(child(0, first)))


def chosen_paths(sets: DataFrame, runs: int, depth: int, small: int) -> DataFrame:
    """Leaves: ``node``, ``sid`` and the number of sets in the node, 2 at least.

    Sets start in one root per run.  A node of at most ``small`` sets is a leaf, and
    so is a cluster of similar ones; others split on sampled tokens, ``depth``
    times at most.  Every level is one aggregation and one join, written to the shared folder.
    """
    rooted = sets.select(
        "sid",
        F.explode(F.concat(*[_children(None, r) for r in range(runs)])).alias("node"),
        F.lit(None).cast("long").alias("above"),
    )
    leaves = None
    for level in range(1, depth + 1):
        counts = rooted.groupBy("node").agg(F.count(F.lit(1)).alias("count"), F.min("above").alias("above"))
        splits = (F.col("count") > small) & (F.col("above").isNull() | (F.col("count") < F.lit(CLUSTER) * F.col("above")))
        # Stored, counts have a size that Spark knows: few are broadcast and the sets stay where they are; with
        # many, both sides come straight from a shuffle, where a hot node's sets may be split.
        counts = stored(counts.filter(F.col("count") > 1).select("node", "count", splits.alias("splits")), "nodes")
        here = stored(rooted.select("node", "sid").join(counts, "node").select("node", "sid", "count", "splits"), "paths")
        more = here.filter("splits")
        last = level == depth or more.isEmpty()
        found = (here if last else here.filter("NOT splits")).drop("splits")
        leaves = found if leaves is None else leaves.unionByName(found)
        if last:
            break
        rooted = more.join(sets.select("sid", "tokens"), "sid").select(
            "sid", F.explode(_children(F.col("node"), None)).alias("node"), F.col("count").alias("above")
        )
    return leaves


class _Bucket:
    """Pairs of rows of one leaf, or of two blocks of a large one, to compare here."""

    def __init__(self, node: np.ndarray, side: np.ndarray, sketches: np.ndarray, paths: np.ndarray, agree: int):
        """Rows sorted by bucket: candidate pairs (i, j) of all buckets at once."""
        starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(node)]]))
        self.left, self.right = [], []
        ends = np.repeat(starts + sizes, sizes)
        at = np.arange(len(node))
        for gap in range(1, int(sizes.max(initial=1))):
            i = at[at + gap < ends]
            j = i + gap
            pick = (side[i] < 0) | (side[i] != side[j])
            i, j = i[pick], j[pick]
            if len(i):
                near = (sketches[i] == sketches[j]).sum(axis=1) >= agree
                self.left.append(i[near])
                self.right.append(j[near])
        empty = np.empty(0, np.int64)
        self.left = np.concatenate([empty, *self.left])
        self.right = np.concatenate([empty, *self.right])
        if len(self.left):
            order = np.lexsort((self.right, self.left))
            self.left, self.right = self.left[order], self.right[order]
        # A pair that meets in several leaves is compared in the first of them only.
        fresh = np.ones(len(self.left), bool)
        for a in range(0, len(self.left), 5_000):
            i, j = self.left[a : a + 5_000], self.right[a : a + 5_000]
            same = (paths[i][:, :, None] == paths[j][:, None, :]).any(axis=2) & (paths[i] < self._leaf(node, i)[:, None])
            fresh[a : a + 5_000] = ~same.any(axis=1)
        self.left, self.right = self.left[fresh], self.right[fresh]

    _leaf = staticmethod(lambda node, i: node[i]["leaf"])


_BUCKET = np.dtype([("leaf", "<i8"), ("one", "<i4"), ("two", "<i4")])


def _grouped(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Tables of whole buckets, of about ``most`` rows, from rows sorted by bucket."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            part = batch.slice(at, most)
            held.append(part)
            rows += part.num_rows
            if rows >= most:
                table = pa.Table.from_batches(held)
                keys = _keys(table)
                cut = len(keys) - 1
                while cut > 0 and keys[cut - 1] == keys[-1]:
                    cut -= 1
                if cut:
                    yield table.slice(0, cut)
                held = table.slice(cut).combine_chunks().to_batches()
                rows = table.num_rows - cut
    if rows:
        yield pa.Table.from_batches(held)


def _keys(table: pa.Table) -> np.ndarray:
    keys = np.empty(table.num_rows, _BUCKET)
    for name in _BUCKET.names:
        keys[name] = table.column(name).to_numpy()
    return keys


def _pairs_of(table: pa.Table, agree: int) -> _Bucket:
    keys = _keys(table)
    sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(keys), SAMPLED)
    lists = table.column("paths").combine_chunks()
    ends = lists.offsets.to_numpy()
    widths = np.diff(ends)
    paths = np.repeat(np.arange(1, len(keys) + 1, dtype=np.int64)[:, None], max(1, widths.max(initial=1)), axis=1)
    # Free places hold values that no two rows share.
    paths = -(1 << 62) - paths
    inside = np.arange(paths.shape[1])[None, :] < widths[:, None]
    paths[inside] = lists.values.to_numpy()[ends[0] : ends[-1]]
    return _Bucket(keys, table.column("side").to_numpy(), sketches, paths, agree)


def similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs reach the similarity, from the whole sets."""
    sizes = np.array([len(s) for s in sets])
    common = np.zeros(len(left), np.int64)
    used = np.unique(np.concatenate([left, right]))
    if len(left) > 4 * len(used):  # many pairs of few sets: all common counts from one product
        place = np.full(len(sets), -1)
        place[used] = np.arange(len(used))
        flat, owner = np.concatenate([sets[i] for i in used]), np.repeat(np.arange(len(used)), sizes[used])
        values, columns, counts = np.unique(flat, return_inverse=True, return_counts=True)
        shared = counts[columns] > 1
        columns, owner = columns[shared], owner[shared]
        order = np.argsort(columns, kind="stable")
        columns, owner = columns[order], owner[order]
        total = np.zeros((len(used), len(used)), np.float32)
        for low in range(0, len(values), 4096):
            a, b = np.searchsorted(columns, [low, low + 4096])
            if a < b:
                block = np.zeros((len(used), 4096), np.float32)
                block[owner[a:b], columns[a:b] - low] = 1
                total += block @ block.T
        common = np.rint(total[place[left], place[right]]).astype(np.int64)
    else:
        for k, (i, j) in enumerate(zip(left, right, strict=True)):
            a, b = (sets[i], sets[j]) if sizes[i] <= sizes[j] else (sets[j], sets[i])
            if sizes[i] and len(a) >= similarity * len(b) - 1e-9:
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                common[k] = (b[at] == a).sum()
    return common >= similarity * (sizes[left] + sizes[right] - common) - 1e-9


def _roots(n: int, left: np.ndarray, right: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The smallest name in each row's component."""
    label = names.copy()
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        if (new == label).all():
            return label
        label = new


def _buckets(leaves: DataFrame, block: int) -> DataFrame:
    """Leaves, with large ones cut into blocks that meet pair by pair: exact at any
    size, in tasks of bounded memory."""
    blocks = F.ceil(F.col("count") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("sid", "leaf"), blocks).cast("int")
    cut = leaves.withColumn("_b", blocks).withColumn("_own", own)
    met = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_b") - 1)))
    return met.withColumns(
        {
            "one": F.least("_own", "_other"),
            "two": F.greatest("_own", "_other"),
            # Rows of one block meet each other where both are the same; else the other block only.
            "side": F.when(F.col("_own") == F.col("_other"), F.lit(-1)).otherwise(F.col("_own")),
        }
    ).drop("_b", "_own", "_other", "count")


def _by_bucket(rows: DataFrame) -> DataFrame:
    return rows.repartition("leaf", "one", "two").sortWithinPartitions("leaf", "one", "two", "sid")


def linked_sets(docs: DataFrame, similarity: float, recall: float, depth: int, small: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Documents with the ids of their sets (``doc_id, sid, n``) and, per set, its
    ``copies``, ``links`` to documents of other sets and component (``least``)."""
    signed = stored(
        docs.select("doc_id", "text").mapInArrow(returning(_signed), _kinds(docs)), "shingled"
    )
    sets = stored(
        signed.filter(F.col("n") > 0)
        .groupBy("sid")
        .agg(F.count(F.lit(1)).alias("copies"), F.any_value("n").alias("n"), F.min("doc_id").alias("doc_id"), F.any_value("tokens").alias("tokens"), F.any_value("sketch").alias("sketch")),
        "sets",
    )
    agree = int(SAMPLED * similarity - 5.5 * (SAMPLED * similarity * (1 - similarity)) ** 0.5)
    leaves = chosen_paths(sets, runs_needed(similarity, depth, recall), depth, small).withColumnRenamed("node", "leaf")
    paths = leaves.groupBy("sid").agg(F.collect_list("leaf").alias("paths"))
    facts = paths.join(sets.select("sid", "n", "copies", "sketch"), "sid")
    filled = stored(leaves.join(facts, "sid"), "leaves")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, 4096):
            pairs = _pairs_of(table, agree)
            used = np.unique(np.concatenate([pairs.left, pairs.right]))
            yield from table.take(pa.array(used)).to_batches()

    kinds = "sid long, leaf long, n long, copies long, sketch binary, paths array<long>, one int, two int, side int"
    names = [k.split()[0] for k in kinds.split(", ")]
    met = _by_bucket(_buckets(filled, block).select(*names)).mapInArrow(returning(candidates), kinds)
    wanted = stored(met, "candidates")
    needed = wanted.select("sid").distinct().join(sets.select("sid", "doc_id"), "sid").select("doc_id", "sid")

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = shingle_sets([(t or "").encode() for t in part.column(1).to_pylist()])
                # Ids may repeat with other texts.
                same = np.flatnonzero(set_ids(found) == part.column(0).to_numpy())
                held = pa.array([found[i].tobytes() for i in same], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(same)), held], names=["sid", "shingles"])

    texts = docs.select(F.col("doc_id").alias("_d"), "text")
    read = texts.join(needed, F.col("_d").eqNullSafe(F.col("doc_id"))).select("sid", "text")
    contents = stored(read.mapInArrow(returning(shingles), "sid long, shingles binary").dropDuplicates(["sid"]), "contents")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, 2048):
            pairs = _pairs_of(table, agree)
            sets_here = [np.frombuffer(b, np.uint64) for b in table.column("shingles").to_pylist()]
            left, right = pairs.left, pairs.right
            # Bucket by bucket, as one holds few distinct tokens.
            if len(left):
                keys = _keys(table)
                edge = np.flatnonzero(keys[left][1:] != keys[left][:-1]) + 1
                reach = np.concatenate([similar(sets_here, i, j, similarity) for i, j in zip(np.split(left, edge), np.split(right, edge), strict=True)])
                left, right = left[reach], right[reach]
            sid, copies = table.column("sid").to_numpy(), table.column("copies").to_numpy()
            links = np.zeros(len(sid), np.int64)
            np.add.at(links, left, copies[right])
            np.add.at(links, right, copies[left])
            root = _roots(len(sid), left, right, sid)
            some = np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays([pa.array(sid[some]), pa.array(links[some]), pa.array(root[some])], names=["sid", "links", "root"])

    whole = wanted.join(contents, "sid").select(*names, "shingles")
    links = stored(_by_bucket(whole).mapInArrow(returning(verified), "sid long, links long, root long"), "links")
    least = components(links.select(F.col("sid").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("sid").agg(F.sum("links").alias("links"))
    classes = (
        sets.select("sid", "copies", "doc_id")
        .join(counted, "sid", "left")
        .join(least.withColumnRenamed("node", "sid"), "sid", "left")
        .select("sid", "copies", "doc_id", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("least", "sid").alias("least"))
    )
    return signed.select("doc_id", "sid", "n"), stored(classes, "classes")


def _kinds(docs: DataFrame) -> str:
    return f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, sid long, n long, tokens array<int>, sketch binary"


def similarity_classes(
    docs: DataFrame, similarity: float = 0.8, recall: float = 0.999999, depth: int = 5, small: int = 2048, block: int = BLOCK
) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` and ``n_links``.

    Documents are linked whose sets of five-word shingles have a Jaccard similarity
    of ``similarity`` or more; ``n_links`` counts the others that a document is
    linked with, ``class_id`` is the smallest id that links lead to.  A text
    of one to four words is one shingle; NULL texts and texts without words are
    linked with nothing.  Repeated rows are documents of their own.  A NULL id takes
    part; it is a class's id only where there is no other.  An empty table gives an
    empty result.  Only ``doc_id`` and ``text`` are read.

    Equal sets are one set with copies from the start.  Sets meet in the leaves of
    chosen paths, in as many runs as ``recall`` needs; sketches of the sampled tokens
    drop most pairs there, and whole sets decide on the rest.  A pair that meets
    in several leaves counts in the first.  Leaves emit each set's count and
    the smallest linked set, never pairs; large leaves are compared in blocks.
    """
    signed, classes = linked_sets(docs, similarity, recall, depth, small, block)
    ids = classes.groupBy("least").agg(F.min("doc_id").alias("class_id"))
    named = classes.join(ids, "least").select("sid", "class_id", (F.col("copies") - 1 + F.col("links")).alias("n_links"))
    joined = signed.join(named, "sid", "left")
    blank = F.col("n") == 0
    return joined.select(
        "doc_id",
        F.when(blank, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(
    docs: DataFrame, similarity: float = 0.8, recall: float = 0.999999, depth: int = 5, small: int = 2048, block: int = BLOCK
) -> DataFrame:
    """``docs`` with the document of the smallest id of each class of
    :func:`similarity_classes`.

    NULL ids come last in a class.  Documents without words all stay; rows that
    repeat an id and a text are one document.  Other columns come along.
    """
    # Every row gets a number that stays, so that only numbers decide and the texts move once.
    rows = stored(docs.select(packed(docs.columns), F.monotonically_increasing_id().alias("_id")), "numbered")
    whole = F.struct(F.col("_row.doc_id").isNull().alias("none"), F.col("_row.doc_id").alias("doc_id"), F.col("_id").alias("id"))
    signed, classes = linked_sets(
        rows.select(whole.alias("doc_id"), F.col("_row.text").alias("text")), similarity, recall, depth, small, block
    )
    linked = classes.groupBy("least").agg(F.min("doc_id").alias("doc_id"))
    blank = signed.filter(F.col("n") == 0).groupBy("doc_id.none", "doc_id.doc_id").agg(F.min("doc_id.id").alias("_id"))
    kept = linked.select(F.col("doc_id.id").alias("_id")).unionByName(blank.select("_id"))
    return rows.join(kept.hint("shuffle_hash"), "_id", "left_semi").select(*unpacked(docs.columns))
