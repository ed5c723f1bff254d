"""Near-duplicate groups: SuperMinHash signatures, banding, verification on full sets and union-find."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm._native import ROW, with_row_key
from tideline.llm._shared import Scratch, map_batches
from tideline.llm.components import components

#: 32 bands of 4 ranks: a pair at similarity 0.75 shares no band with a probability below 6 in a million.
BANDS, ROWS = 32, 4
#: A link: 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75
#: Members of a bucket that one task compares with as many others, or with their centre, at once.
BLOCK = 512


def _digest(s) -> tuple[int, int]:
    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _sketch(bands: int, rows: int):
    """Batches whose last column is a text: instead of it the size of its set, the digest in two halves, the band keys."""

    def sketch(batches):
        import pyarrow as pa

        from tideline.llm._shingles import bands_of, shingle_sets

        for batch in batches:
            sizes, digests = [], []

            def sets(column=batch.columns[-1], sizes=sizes, digests=digests):
                for s in shingle_sets(column):
                    sizes.append(len(s))
                    digests.append(_digest(s))
                    yield s

            keys = list(bands_of(sets(), bands, rows))
            columns = [pa.array(sizes, pa.int64()), pa.array([a for a, _ in digests], pa.int64()), pa.array([b for _, b in digests], pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], "n", "a", "b", "bands"])

    return sketch


def _whole_sets(batches):
    """Batches of (node, a, b, text) to (node, set), once a task for each node, where the text's set has that digest."""
    import pyarrow as pa

    from tideline.llm._shingles import shingle_sets

    seen = set()
    for batch in batches:
        nodes, sets = [], []
        for node, a, b, s in zip(*(c.to_pylist() for c in batch.columns[:3]), shingle_sets(batch.columns[3]), strict=True):
            if node not in seen and _digest(s) == (a, b):
                seen.add(node)
                nodes.append(node)
                sets.append(s.astype("<u8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "s"])


def _unpack(s: bytes):
    import numpy as np

    return np.frombuffer(s, "<u8")


def _similar(x, y, threshold: int) -> bool:
    import numpy as np

    small, large = sorted((len(x), len(y)))
    if 100 * small < threshold * large:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= threshold * (small + large - both)


def _verify(threshold: int):
    """Batches of (u, part, v, set), rows of a part of u together and that of u itself first: the (u, v) that are similar."""

    def verify(batches):
        import pyarrow as pa

        center, center_set = None, None
        for batch in batches:
            us, vs = [], []
            for u, v, s in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                if u == v:
                    center, center_set = u, _unpack(s.as_py())
                elif u == center and _similar(center_set, _unpack(s.as_py()), threshold):
                    us.append(u)
                    vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return verify


def _common(left: list, right: list):
    """The sizes of all intersections of two lists of sets, by a product of their incidence matrices."""
    import numpy as np

    both = np.concatenate([*left, *right])
    _, column = np.unique(both, return_inverse=True)
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    step = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        i, j = np.searchsorted(column, [low, low + step])
        m = np.zeros((len(left) + len(right), step), dtype=np.float32)
        m[row[i:j], column[i:j] - low] = 1
        out += m[: len(left)] @ m[len(left) :].T
    return out.astype(np.int64)


def _cross(threshold: int):
    """Of blocks of (band, i, j, side, node, root, set), rows of a block together: links that join roots not joined yet.

    Rows of side 1 are compared with those of side 2; side 3 is on both.
    """

    def links(rows: list[tuple]) -> list[tuple[int, int]]:
        import numpy as np

        left, right = [r for r in rows if r[0] & 1], [r for r in rows if r[0] & 2]
        if not left or not right:
            return []
        ls, rs = [_unpack(r[3]) for r in left], [_unpack(r[3]) for r in right]
        n, m = np.array([len(x) for x in ls]), np.array([len(x) for x in rs])
        both = _common(ls, rs)
        union = n[:, None] + m[None, :] - both
        apart = np.array([r[2] for r in left])[:, None] != np.array([r[2] for r in right])[None, :]
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        out = []
        for i, j in np.argwhere(apart & (100 * both >= threshold * union)):
            x, y = find(left[i][2]), find(right[j][2])
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((left[i][1], right[j][1]))
        return out

    def cross(batches):
        import pyarrow as pa

        key, rows = None, []

        def answer(found):
            return pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], pa.int64()), pa.array([v for _, v in found], pa.int64())], ["u", "v"])

        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[:3] != key:
                    yield answer(links(rows))
                    key, rows = r[:3], []
                rows.append(r[3:])
        yield answer(links(rows))

    return cross


def _mixed_links(members: DataFrame, roots: DataFrame, whole: DataFrame, threshold: int, scratch: Scratch) -> DataFrame | None:
    """Links within buckets whose nodes are in several components: of the nodes outside the largest with all others."""
    placed = scratch.write(members.select("band", "node").distinct().join(roots.withColumnRenamed("id", "node"), "node", "left").select("band", "node", F.coalesce("root", "node").alias("root")))
    sizes = placed.groupBy("band", "root").agg(F.count("*").alias("size"))
    mixed = sizes.groupBy("band").agg(F.max(F.struct("size", "root")).alias("major"), F.count("*").alias("n"), F.sum("size").alias("k")).where("n > 1")
    mixed = scratch.write(mixed.select("band", F.col("major.root").alias("major"), "k", (F.col("k") - F.col("major.size")).alias("out")))
    if not mixed.limit(1).count():
        return None
    open_ = scratch.write(placed.join(mixed, "band"))
    same = open_.groupBy("band", "k").agg(F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("h"))
    once = scratch.write(same.groupBy("k", "h").agg(F.min("band").alias("band")).select("band"))
    rows = open_.join(once, "band").select("*", F.ceil(F.col("out") / BLOCK).cast("int").alias("bi"), F.ceil(F.col("k") / BLOCK).cast("int").alias("bj"))
    outside, one, h = F.col("root") != F.col("major"), F.col("bj") == 1, F.xxhash64("node")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = rows.where(outside & ~one).select("band", F.pmod(h, "bi").cast("int").alias("i"), every("bj").alias("j"), F.lit(1).alias("side"), "node", "root")
    right = rows.where(~one).select("band", every("bi").alias("i"), F.pmod(h, "bj").cast("int").alias("j"), F.lit(2).alias("side"), "node", "root")
    small = rows.where(one).select("band", F.lit(0).alias("i"), F.lit(0).alias("j"), F.when(outside, 3).otherwise(2).alias("side"), "node", "root")
    blocks = left.union(right).union(small).join(whole, "node").select("band", "i", "j", "side", "node", "root", "s")
    blocks = blocks.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "node")
    return scratch.write(map_batches(blocks, _cross(threshold), "u long, v long"))


def _groups(docs: DataFrame, extra: list[str], text_col: str, id_col: str, bands: int, rows: int, threshold: int) -> DataFrame:
    """(extra columns, id, n, component, kept), written to the shared folder."""
    texts = docs.select(*extra, F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    kinds = ", ".join(f"{c} {dict(texts.dtypes)[c]}" for c in extra)
    with Scratch(docs.sparkSession) as scratch:
        sketched = scratch.write(map_batches(texts, _sketch(bands, rows), f"{kinds}{', ' * bool(extra)}id long, n long, a long, b long, bands array<long>"))
        sets = sketched.where("n > 0 AND id IS NOT NULL")
        nodes = sets.groupBy("a", "b").agg(F.min("id").alias("id")).orderBy("id", "a", "b")
        nodes = scratch.write(nodes.withColumn("node", F.monotonically_increasing_id()))
        banded = scratch.write(sets.join(nodes, ["a", "b", "id"]).select("node", "bands"))
        each = banded.select("node", F.explode("bands").alias("band"))
        buckets = scratch.write(each.groupBy("band").agg(F.min("node").alias("center"), F.max("node").alias("last")).where("center <> last").drop("last"))
        members = scratch.write(each.join(buckets, "band"))
        scratch.drop(banded, buckets)

        pairs = scratch.write(members.where("node <> center").select(F.col("center").alias("u"), F.col("node").alias("v")).distinct())
        wanted = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct().join(nodes, "node")
        whole = texts.select("id", "text").join(wanted, "id").select("node", "a", "b", "text")
        whole = scratch.write(map_batches(whole, _whole_sets, "node long, s binary"))
        many = scratch.write(pairs.groupBy("u").agg(F.count("*").alias("k")).where(F.col("k") > BLOCK))
        part = F.when(F.col("k").isNull(), 0).otherwise(F.pmod(F.xxhash64("v"), F.ceil(F.col("k") / BLOCK))).cast("int")
        parts = pairs.join(many, "u", "left").select("u", part.alias("part"), "v")
        rows_ = parts.union(parts.select("u", "part", F.col("u").alias("v")).distinct()).join(whole.withColumnRenamed("node", "v"), "v").select("u", "part", "v", "s")
        rows_ = rows_.repartition("u", "part").sortWithinPartitions("u", "part", F.col("u") != F.col("v"))
        links = scratch.write(map_batches(rows_, _verify(threshold), "u long, v long"))
        roots = components(links, scratch)
        more = _mixed_links(members, roots, whole, threshold, scratch)
        if more is not None and more.limit(1).count():
            roots = components(links.union(more), scratch)

        named = roots.join(nodes.select(F.col("node").alias("root"), F.col("id").alias("component")), "root").select(F.col("id").alias("node"), "component")
        placed = nodes.join(named, "node", "left").select("a", "b", F.coalesce("component", "id").alias("component"))
        found = sketched.select(*extra, "id", "n", "a", "b").join(placed, ["a", "b"], "left")
        component = F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")))
        return scratch.keep(found.select(*extra, "id", "n", component.alias("component"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")))


def near_duplicate_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", bands: int = BANDS, rows: int = ROWS, threshold: int = THRESHOLD) -> DataFrame:
    """Returns (id_col, n_shingles, component_id, kept) for each row of the documents.

    Two documents are linked where their sets of distinct five-word shingles have 100 * intersection >= threshold *
    union; component_id is the smallest id that links lead to; kept marks the document that has it.

    1. One pass gives each document its set's size and 128-bit digest and the keys of its bands. Documents with equal
       sets are one node from here on; nodes are numbered in the order of their smallest ids.
    2. Nodes that share a band are a bucket, whose smallest node is its centre. The sets of nodes in buckets are made
       once more, as the only other use of the texts.
    3. The nodes of each bucket are verified against its centre on their full sets, by parts of BLOCK, so that the
       centre's set goes to each part once and a large bucket is many tasks; the links give components.
    4. In buckets whose nodes are still in several components, the nodes outside the largest are compared with all
       others, block by block; of buckets with the same nodes one is taken. Only links that join components leave a
       task. So every pair that shares a band is linked, or in one component already, or not similar.

    A null, empty or blank text has an empty set and is linked with nothing. A row with a null id is linked with
    nothing, its component_id is null and it is kept. Repeated rows share a set, a component and kept. Ids are
    integers; rows that share an id but not a text are nodes of their own. A very long text is one set, which must fit
    in a task. Empty tables stay empty. Other input columns take no part, whatever their names.

    Nothing but counts reaches the driver. Tables are written to the shared folder as the work goes on. Step 4 compares
    pairs, in memory, where nodes share a band without being similar to the bucket's first: its work, though not its
    output, grows with their number times the bucket's.
    """
    out = _groups(docs, [], text_col, id_col, bands, rows, threshold)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept")


def drop_near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", bands: int = BANDS, rows: int = ROWS, threshold: int = THRESHOLD) -> DataFrame:
    """The documents that near_duplicate_groups() keeps, with all their columns.

    Rows are told apart by id and text, so that of rows that share an id but not a text each follows its own group.
    Rows equal in both are one document, and stay or go together. Nulls, empty and very long texts and empty tables
    are as in near_duplicate_groups().
    """
    keyed = with_row_key(docs, id_col, text_col)
    gone = _groups(keyed, ROW, text_col, id_col, bands, rows, threshold).where("NOT kept").select(*ROW)
    return keyed.join(gone, ROW, "left_anti").select(*(f"`{c}`" for c in docs.columns))
