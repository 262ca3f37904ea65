"""MinHash near-dedup with SuperMinHash signatures.

Method:

1. Sketch: a document's shingle set becomes a SuperMinHash signature. Every element draws a random permutation
   step by step; its step j offers the value j + r (r random in [0, 1)) to the slot that the permutation
   names. After a step in which no slot is above j, later steps cannot change a slot, and drawing stops.
2. Copies: rows with the same word sequence are one node. Only nodes go on.
3. Banding: nodes that agree in all slots of a band share a bucket. In each bucket, nodes whose signatures
   agree well enough (the threshold less five standard errors) are connected; union-find gives families.
4. Verification: the texts of each family are compared on full shingle sets; the links found are connected by
   union-find again. Component ids are the smallest document ids.

Which links are found: a pair at exactly the threshold shares no band with a probability of about 1e-6 or less,
see ``bands``; more similar pairs, less. All links inside a family are verified exactly.

Scale: buckets and families are split into blocks, every pair of blocks is one group of bounded size, and a group
returns at most one link per member (a spanning star of each of its components), never its pairs.
Components are found by alternating large-star and small-star steps on written tables. Nothing but row
counts reaches the driver.

Defined results: a null or empty text, or one without words, has an empty set and is linked with nothing. Rows with
one doc_id and one text are one document. Ties: the smallest id stands for a component; null ids only
where a component has no other. Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_name, map_in_arrow, shared_table, slices
from strata.llm.shingles import Shingler, mix

SLOTS = 120
WIDTH = 5
THRESHOLD = Fraction(4, 5)
#: Members and shingles in a block; a group holds two blocks at most.
BUCKET_BLOCK = 1024
FAMILY_BLOCK = 256
BLOCK_SHINGLES = 500_000
#: Elements that draw their permutations together.
CHUNK = 8192


def bands(threshold: float, slots: int = SLOTS, miss: float = 2e-6) -> tuple[int, int]:
    """(bands, slots per band): as many slots per band as keep the chance that a pair at the threshold shares no band below ``miss``."""
    rows = max(r for r in range(1, slots + 1) if (1 - threshold**r) ** (slots // r) <= miss or r == 1)
    return slots // rows, rows


def superminhash(elements: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signature of distinct 64-bit elements. A value is (step, 56 random bits); 16 bits of its scramble are kept."""
    low = np.full(slots, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(elements), CHUNK):
        x = elements[at : at + CHUNK]
        rows = np.arange(len(x))
        for j in range(slots):
            if int(low.max()) >> 56 < j:
                break
            z = mix(x + np.uint64((2 * j + 1) * 0x9E3779B97F4A7C15 % 2**64))
            pick = j + ((mix(z) >> np.uint64(32)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
            if j == 0:  # the permutation is still the identity
                slot = first = pick
            else:
                if j == 1:
                    order = np.tile(np.arange(slots, dtype=np.int16), (len(x), 1))
                    order[rows, first] = 0
                slot = order[rows, pick]
                order[rows, pick] = order[:, j]
            np.minimum.at(low, slot, (z >> np.uint64(8)) | np.uint64(j << 56))
    return (mix(low) >> np.uint64(48)).astype("<u2")


def sketch(docs: DataFrame, width: int, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, version, n, node, sig): id, hash of the text, set size, digest of the word sequence, signature; the last two null without words."""

    def run(batches):
        import xxhash

        shingler = Shingler(width)
        for part in slices(batches):
            n, node, sig = [], [], []
            for text in part.column(2).to_pylist():
                words = shingler.words(text)
                found = shingler.sorted_set(words)
                n.append(len(found))
                node.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                sig.append(superminhash(found, slots).tobytes() if words else None)
            made = [pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(sig, pa.binary())]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *made], names=["doc", "version", "n", "node", "sig"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    return map_in_arrow(rows, run, "doc long, version long, n long, node binary, sig binary")


def star_of_components(n: int, linked: Callable[[int], np.ndarray]) -> list[tuple[int, int]]:
    """(root, member) for each component of a graph on n members; ``linked(i)`` marks the neighbours of i."""
    new, out = np.ones(n, dtype=bool), []
    for root in range(n):
        if not new[root]:
            continue
        new[root] = False
        todo = [root]
        while todo and new.any():
            near = np.flatnonzero(linked(todo.pop()) & new)
            new[near] = False
            out += [(root, int(k)) for k in near]
            todo += near.tolist()
    return out


def links_by_signature(members: list[bytes], least: float) -> list[tuple[int, int]]:
    sigs = np.frombuffer(b"".join(members), dtype="<u2").reshape(len(members), -1)
    need = least * sigs.shape[1]
    if len(members) == 2:
        return [(0, 1)] if (sigs[0] == sigs[1]).sum() >= need else []
    return star_of_components(len(members), lambda i: (sigs == sigs[i]).sum(axis=1) >= need)


def links_by_sets(sets: list[np.ndarray], threshold: Fraction) -> list[tuple[int, int]]:
    """Links with intersection / union >= threshold, exactly, as stars of the components that they form."""
    sizes = np.array([len(s) for s in sets])
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    mark = np.zeros(len(values), dtype=np.int64)

    def linked(i: int) -> np.ndarray:
        own = flat[starts[i] : starts[i] + sizes[i]]
        mark[own] = 1
        both = np.add.reduceat(mark[flat], starts)
        mark[own] = 0
        return threshold.denominator * both >= threshold.numerator * (sizes + sizes[i] - both)

    return star_of_components(len(sets), linked)


def in_blocks(members: DataFrame, blocks: str, node: str = "node") -> DataFrame:
    """``members`` with (i, j), the pair of blocks to be compared; a member of one of ``blocks`` blocks meets each other block once."""
    own = F.pmod(F.xxhash64(node), F.col(blocks))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1), lambda x: x != F.col("own"))
    pairs = F.when(F.col(blocks) == 1, F.array(F.lit(0).cast("long"))).otherwise(others)
    spread = members.withColumn("own", own).withColumn("other", F.explode(pairs))
    return spread.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("own", "other", blocks)


def links_in_groups(members: DataFrame, keys: list[str], value: str, find: Callable[[], Callable[[list], list[tuple[int, int]]]]) -> DataFrame:
    """(u, v) links between the nodes of each group; columns of ``members``: the keys, node and ``value``.

    A group comes in consecutive rows and is held alone; its size is bounded by its blocks.
    """
    members = members.select(*keys, "node", value).repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]):
        links, key, nodes, values = find(), None, [], []

        def done(out):
            if len(nodes) > 1:
                order = sorted(range(len(nodes)), key=nodes.__getitem__)
                for a, b in links([values[k] for k in order]):
                    u, v = nodes[order[a]], nodes[order[b]]
                    if u != v:
                        out.append((u, v))

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], names=["u", "v"])

        for part in slices(batches, 2048):
            out: list = []
            columns = [c.to_pylist() for c in part.columns]
            for *k, node, v in zip(*columns):
                if k != key:
                    done(out)
                    key, nodes, values = k, [], []
                nodes.append(node)
                values.append(v)
            yield batch_of(out)
        out = []
        done(out)
        yield batch_of(out)

    return map_in_arrow(members, run, "u binary, v binary")


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, root) of each node of ``links`` (u, v): the smallest node of its component. Alternating large-star and small-star steps."""
    edges = shared_table(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
        both = edges.union(edges.select("v", "u"))
        # Written, so that the join below can split a node with very many neighbours.
        least = shared_table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), label)
        large = shared_table(both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), label)
        least = shared_table(large.groupBy("u").agg(F.min("v").alias("m")), label)
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = shared_table(small.union(least.select("u", "m")).distinct(), label)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())


def families(nodes: DataFrame, threshold: Fraction, slots: int = SLOTS) -> DataFrame:
    """(node, root) of the nodes that a band and their signatures bring together."""
    n_bands, rows = bands(float(threshold), slots)
    least = float(threshold) - 5 * (float(threshold) * (1 - float(threshold)) / slots) ** 0.5
    step = 2 * rows
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("sig", b * step + 1, step)) for b in range(n_bands)])
    entries = nodes.select("node", F.explode(keys).alias("bucket"))
    shared = shared_table(entries.groupBy("bucket").count().where("count > 1"), "buckets")
    shared = shared.select("bucket", F.ceil(F.col("count") / BUCKET_BLOCK).cast("long").alias("blocks"))
    members = entries.join(shared, "bucket").join(nodes.select("node", "sig"), "node")
    return components(links_in_groups(in_blocks(members, "blocks"), ["bucket", "i", "j"], "sig", lambda: lambda sigs: links_by_signature(sigs, least)), "families")


def find_components(docs: DataFrame, width: int = WIDTH, threshold: Fraction = THRESHOLD, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, version, n, component, kept) per row of ``docs``; ``version`` is the text's xxhash64."""
    sketches = shared_table(sketch(docs, width, slots, id_col, text_col), "sketches")
    rows = sketches.select("doc", "version", "n", "node")
    nodes = shared_table(
        sketches.where("node IS NOT NULL").groupBy("node").agg(F.min("doc").alias("doc"), F.min(F.struct(F.col("doc").isNull().alias("x"), "doc", "version")).alias("first"), F.first("n").alias("n"), F.first("sig").alias("sig")),
        "nodes",
    )
    near = families(nodes.select("node", "sig"), threshold, slots)
    near = shared_table(near.join(nodes.select("node", "first", "n"), "node"), "family-members")
    sizes = near.groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / FAMILY_BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("long").alias("blocks")
    )
    places = near.join(shared_table(sizes, "family-sizes"), "root").select("root", "blocks", "node", F.col("first.doc").alias("doc"), F.col("first.version").alias("version"))
    texts = docs.select(F.col(id_col).cast("long").alias("of"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    members = texts.join(places, texts["of"].eqNullSafe(places["doc"]) & (texts["hash"] == places["version"])).select("root", "blocks", "node", "text")

    def compare():
        shingler = Shingler(width)
        return lambda found: links_by_sets([shingler.sorted_set(shingler.words(t)) for t in found], threshold)

    linked = components(links_in_groups(in_blocks(members, "blocks"), ["root", "i", "j"], "text", compare), "links")
    named = nodes.select("node", "doc").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = shared_table(named.groupBy("root").agg(F.min("doc").alias("component")), "components")
    named = shared_table(named.join(smallest, "root").select("node", "component"), "nodes-named")
    out = rows.join(named, "node", "left")
    component = F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component"))
    return out.select("doc", "version", "n", component.alias("component"), F.col("doc").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, width: int = WIDTH, threshold: Fraction = THRESHOLD, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their component; of rows with one id and one text, one (without words, too)."""
    found = find_components(docs, width, threshold, slots, id_col, text_col).where("kept").select("doc", "version").distinct()
    # Plain equality on the names that the repeats are dropped by: the texts are shuffled once.
    keys = [free_name(docs, x) for x in ("kept_no_id", "kept_id", "kept_version")]
    key = lambda c: (c.isNull(), F.coalesce(c.cast("long"), F.lit(0)))
    rows = docs.withColumns(dict(zip(keys, (*key(F.col(id_col)), F.xxhash64(text_col)))))
    found = found.select(*[c.alias(k) for k, c in zip(keys, (*key(F.col("doc")), F.col("version")))])
    return rows.join(found, keys).dropDuplicates(keys).select(*[F.col(c) for c in docs.columns])
