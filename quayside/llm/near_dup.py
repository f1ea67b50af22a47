"""Near-duplicates by bottom-k sketches of one hash function.

1. A document's set is its distinct hashed word shingles. Equal sets collapse to
   one *node* before anything is compared: the number of one of their rows, so
   different sets are different nodes whatever their doc_ids are.
2. A node keeps its ``KEYS`` smallest hashes as keys of inverted lists and its
   ``SKETCH`` smallest (upper halves) for estimates. Two sets with similarity s
   share none of their k smallest with probability (1 - s)^k: 2e-10 at 0.75.
3. In each inverted list, members not yet joined in it are compared by the
   union sketch (the hashes up to the smaller of both sketches' last value are a
   uniform sample of the union); estimates of ``LOOSE`` or more join them. Only
   pairs with ``SHARED`` of the first ``KEYS`` hashes in common are estimated: of
   linked sets of more hashes all but 3e-7 are among them, of smaller ones all. A
   list gives a spanning forest of its joins, never its pairs. Lists over
   ``LIST_BLOCK`` members are compared block against block.
4. Components of those joins are loose clusters. One text of each member is read
   again and full sets compared exactly, cluster by cluster, large clusters
   block against block; confirmed links again leave as spanning forests.
5. Components of the confirmed links give each node the smallest doc_id of all
   rows of its nodes.

No pair is skipped unless its members are already joined, so no list or cluster
size has a cap, and what leaves a task is linear in what enters it.

Defined results: a NULL or empty text, or one without words, has an empty set
and is linked with nothing; a NULL doc_id comes after all others and gives a
NULL component_id; rows that repeat a doc_id are classed each by its own text;
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import LAST_ID, Scratch
from quayside.llm.components import components
from quayside.llm.kernel import Forest, chunks, mix, shingle_sets, texts

SHINGLE_WORDS = 5
#: Similarity of a link, in per cent.
PERCENT = 75
KEYS = 16
SHARED = 3
SKETCH = 64
LOOSE = 0.5
LIST_BLOCK = 4096
CLUSTER_BLOCK = 512

_PAD = np.uint32(0xFFFFFFFF)
_SIGNED = "node bigint, other bigint"


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in chunks(batches):
        n, s1, s2, keys, sketches = [], [], [], [], []
        for s in shingle_sets(data, offsets, SHINGLE_WORDS):
            n.append(len(s))
            s1.append(np.add.reduce(mix(s + np.uint64(1)), dtype=np.uint64).view(np.int64))
            s2.append(np.bitwise_xor.reduce(mix(s * np.uint64(3)), dtype=np.uint64).view(np.int64))
            keys.append(s[:KEYS].view(np.int64))
            pad = np.full(SKETCH, _PAD)
            pad[:len(s[:SKETCH])] = s[:SKETCH] >> np.uint64(32)
            sketches.append(pad.tobytes())
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), rows.column(2), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
             pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
            ["did", "row", "rid", "n", "s1", "s2", "keys", "sketch"])


def estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarity of sketch ``one`` to each row of ``others`` from their union sketches."""
    last = np.minimum(one[-1], others[:, -1])[:, None]
    known = np.zeros(1 << 16, bool)  # by the lower half: one foreign value in a thousand counts as shared
    known[one & 0xFFFF] = True
    within = (others <= last) & (others != _PAD)
    both = (within & known[others & 0xFFFF]).sum(1)
    own = ((one <= last) & (one != _PAD)).sum(1)
    return both / np.maximum(1, own + within.sum(1) - both)


def _join_list(nodes: np.ndarray, n: np.ndarray, sketches: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the members whose estimate is LOOSE or more."""
    forest, out = Forest(len(nodes)), []
    first = (sketches[:, :KEYS] & 0xFFFF).astype(np.uint16)
    known = np.zeros(1 << 16, np.uint8)  # as in ``estimates``; padding counts as shared
    for i in range(len(nodes) - 1):
        rest = np.flatnonzero(forest.roots()[i + 1:] != forest.root(i)) + i + 1 if out else np.arange(i + 1, len(nodes))
        rest = rest[(100 * np.minimum(n[rest], n[i]) >= PERCENT * np.maximum(n[rest], n[i])) & (nodes[rest] != nodes[i])]
        if len(rest):
            known[sketches[i] & 0xFFFF] = 1
            rest = rest[known[first[rest]].sum(1) >= SHARED]
            known[sketches[i] & 0xFFFF] = 0
        if len(rest):
            for j in rest[estimates(sketches[i], sketches[rest]) >= LOOSE].tolist():
                if forest.join(i, j):
                    out.append((int(nodes[i]), int(nodes[j])))
    return out


def _join_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal ``task`` are lists; a list may go on in the next batch."""
    held: list[pa.RecordBatch] = []

    def joined(part: pa.Table):
        task = part.column("task").to_numpy()
        nodes, n = part.column("node").to_numpy(), part.column("n").to_numpy()
        sketches = np.frombuffer(texts(part.column("sketch"))[0], np.uint32).reshape(-1, SKETCH)
        cuts = np.flatnonzero(np.diff(task)) + 1
        pairs = {p for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(task)], strict=True) if b - a > 1
                 for p in _join_list(nodes[a:b], n[a:b], sketches[a:b])}
        x = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["node", "other"])

    for batch in batches:
        task = batch.column(0).to_numpy()
        if not len(task):
            continue
        if held and held[-1].column(0)[-1].as_py() != task[0]:
            yield joined(pa.Table.from_batches(held))
            held = []
        if task[0] == task[-1]:
            held.append(batch)
            continue
        cut = int(np.flatnonzero(task != task[-1])[-1]) + 1
        yield joined(pa.Table.from_batches([*held, batch.slice(0, cut)]))
        held = [batch.slice(cut)]
    if held:
        yield joined(pa.Table.from_batches(held))


def _links(sets: list[np.ndarray], ids: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the exact links among full sets."""
    forest, out = Forest(len(sets)), []
    n = np.array([len(s) for s in sets])
    for i in range(len(sets) - 1):
        rest = np.flatnonzero(forest.roots()[i + 1:] != forest.root(i)) + i + 1
        rest = rest[(100 * np.minimum(n[rest], n[i]) >= PERCENT * np.maximum(n[rest], n[i])) & (n[rest] > 0)]
        if not n[i] or not len(rest):
            continue
        flat = np.concatenate([sets[j] for j in rest])
        found = sets[i][np.minimum(np.searchsorted(sets[i], flat), n[i] - 1)] == flat
        both = np.add.reduceat(found.astype(np.int64), np.r_[0, np.cumsum(n[rest])[:-1]])
        for j in rest[100 * both >= PERCENT * (n[rest] + n[i] - both)].tolist():
            if forest.join(i, j):
                out.append((int(ids[i]), int(ids[j])))
    return out


def _verify(group: pa.Table) -> pa.Table:
    """All clusters of a group: full sets from whole texts, then exact links."""
    sets, clusters, nodes = [], [], []
    for rows, data, offsets in chunks(iter(group.to_batches())):
        sets += shingle_sets(data, offsets, SHINGLE_WORDS)
        clusters.append(rows.column(rows.schema.get_field_index("cluster")).to_numpy())
        nodes.append(rows.column(rows.schema.get_field_index("node")).to_numpy())
    clusters, nodes = np.concatenate(clusters), np.concatenate(nodes)
    order = np.lexsort((nodes, clusters))
    pairs = []
    for part in np.split(order, np.flatnonzero(np.diff(clusters[order])) + 1):
        pairs += _links([sets[i] for i in part], nodes[part])
    x = np.array(sorted({p for p in pairs if p[0] != p[1]}), np.int64).reshape(-1, 2)
    return pa.table({"node": x[:, 0], "other": x[:, 1]})


def _identified(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns that tell rows apart: did, the doc_id, and row, the text."""
    return docs.withColumns({"did": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)),
                             "row": F.xxhash64(F.coalesce("text", F.lit("")))})


def _classified(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: did, row, n, component."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "near-dup")
    ids = _identified(docs.select("doc_id", "text")).select("did", "row", F.monotonically_increasing_id().alias("rid"), "text")
    ids = scratch.save(ids)  # doc_id and text may repeat, rid does not
    signed = scratch.save(ids.mapInArrow(
        _signatures, "did bigint, row bigint, rid bigint, n bigint, s1 bigint, s2 bigint, keys array<bigint>, sketch binary"))

    classes = signed.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("rid").alias("node"), F.min("did").alias("did"))
    classes = scratch.save(classes)
    nodes = scratch.save(signed.join(classes.drop("did").hint("merge"), ["n", "s1", "s2"]).where("rid = node").select("node", "n", "keys", "sketch"))
    lists = nodes.select("node", F.explode(F.array_distinct("keys")).alias("key"))
    sizes = (lists.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
             .select("key", F.ceil(F.col("m") / LIST_BLOCK).cast("int").alias("blocks")))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    lists = lists.join(sizes.hint("merge"), "key").select(
        "node", F.explode(F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda j: F.xxhash64("key", F.least(mine, j), F.greatest(mine, j)))).alias("task"))
    lists = lists.join(nodes.select("node", "n", "sketch").hint("merge"), "node")
    lists = lists.select("task", "node", "n", "sketch").repartition("task").sortWithinPartitions("task", "node")
    # none of these sides has a size bound, so the joins above and below are sort-merge joins at every size
    loose = scratch.save(lists.mapInArrow(_join_lists, _SIGNED).distinct())

    clusters = components(loose, scratch)
    sizes = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    total = clusters.count()
    blocks = F.ceil(F.col("m") / CLUSTER_BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    group = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(total // CLUSTER_BLOCK + 1)))
    members = (clusters.join(sizes, "component").withColumn("blocks", blocks).select(
        "node", F.col("component").alias("cluster"), F.explode(F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda j: group.otherwise(F.xxhash64("component", F.least(mine, j), F.greatest(mine, j))))).alias("task")))
    read = ids.join(members.hint("merge"), ids["rid"] == members["node"]).select("task", "cluster", "node", "text")
    links = scratch.save(read.groupBy("task").applyInArrow(_verify, _SIGNED).distinct())
    scratch.drop(ids)

    found = components(links, scratch)
    labels = found.join(classes.select("node", "did").hint("merge"), "node").groupBy("component").agg(F.min("did").alias("label"))
    named = found.join(scratch.save(labels).hint("merge"), "component").select("node", "label")
    classed = classes.join(named.hint("merge"), "node", "left").select("n", "s1", "s2", F.coalesce("label", "did").alias("component"))
    out = signed.select("did", "row", "n", "s1", "s2").join(classed.hint("merge"), ["n", "s1", "s2"], "left")
    return out.select("did", "row", "n", F.coalesce("component", "did").alias("component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    unknown = F.lit(None).cast("bigint")
    return _classified(docs).select(
        F.when(F.col("did") < LAST_ID, F.col("did")).otherwise(unknown).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("component") < LAST_ID, F.col("component")).otherwise(unknown).alias("component_id"),
        (F.col("did") == F.col("component")).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that a smaller doc_id stands for; of equal rows one stays."""
    columns = docs.columns
    stays = _classified(docs).where("did = component").groupBy(F.col("did").alias("__did"), F.col("row").alias("__row")).agg(
        (F.count(F.lit(1)) > 1).alias("__many"))
    marked = docs.withColumns({"__did": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)),
                               "__row": F.xxhash64(F.coalesce("text", F.lit("")))})
    kept = marked.join(stays, ["__did", "__row"])
    once = kept.where(~F.col("__many")).select(*columns)
    return once.unionByName(kept.where("__many").dropDuplicates(["__did", "__row"]).select(*columns))
