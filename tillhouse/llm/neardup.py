"""Near-duplicate documents by a chosen-path similarity join.

Each tree starts with one minwise shingle per document: documents that share it meet in a node. A node of more than
``NODE_ROWS`` documents branches: every document goes to ``BRANCHES`` children, chosen by coordinates of its sketch that the
path picks. Small nodes are compared exhaustively on sketches. ``TREES`` independent trees run. A pair at similarity 0.85
shares the first shingle of a tree with probability 0.85, and two branches keep such a pair with 0.97 at any depth, so all
ten trees miss it with probability 3e-8; the sketch comparison (36 of 64 coordinates) misses it with about 3e-7. At 0.8, the
limit of the pipeline's stage, the trees miss a pair with 1e-6 and the sketches with 4e-6.
What the trees join is then compared on full shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm import textkit as kit
from tillhouse.llm.components import components
from tillhouse.llm.ship import ship_package
from tillhouse.session import materialize

U = np.uint64
SHINGLE = 5
TREES = 10
SKETCH = 64
MOST_EQUAL = 36  # coordinates of the sketch that are asked for at most, for a pair to be compared in full
MISSED = 1e-5  # share of the pairs at the limit that the sketches may miss
NODE_ROWS = 2048
BRANCHES = 2
DEPTH = 8
GROUP_ROWS = 4096
NO_ID = np.iinfo(np.int64).min


def _salts(n: int) -> np.ndarray:
    return np.random.default_rng(7042024).integers(1, 2**63, n, dtype=np.uint64) * U(2) + U(1)


def least_equal(share: float) -> int:
    """How many coordinates of the sketch have to agree, so that at most ``MISSED`` of the pairs at similarity ``share`` have fewer."""
    below, least = 0.0, 0
    while least < MOST_EQUAL:
        below += math.comb(SKETCH, least) * share**least * (1 - share) ** (SKETCH - least)
        if below > MISSED:
            break
        least += 1
    return least


def shingle_sets(texts: pa.ChunkedArray, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle, one without words has none."""
    buf, bounds = kit.joined(texts, separator=True)
    starts, ends, of_doc = kit.word_bounds(buf, bounds)
    words = kit.word_hashes(buf, starts, ends, lower=True)
    shingles = kit.window_hash(words, width)
    out = []
    for lo, hi in zip(of_doc[:-1].tolist(), of_doc[1:].tolist()):
        if hi - lo >= width:
            s = np.sort(shingles[lo : hi - width + 1])
            out.append(s[np.append(True, s[1:] != s[:-1])])
        elif hi > lo:
            out.append(kit.mix(kit.window_hash(words[lo:hi], hi - lo) + U(hi - lo)))
        else:
            out.append(np.empty(0, U))
    return out


def sketches(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``id, n, h1, h2, keys, sketch`` of every row: set size, set hash, first shingle of each tree, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = _salts(TREES + 2)
        odd = _salts(TREES + 2 + SKETCH)[-SKETCH:].astype(np.uint32) | np.uint32(1)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = pa.Table.from_batches([batch.slice(at, 512)])
                sets = shingle_sets(part[text])
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                keys = np.zeros((len(sets), TREES), np.int64)
                sketch = np.zeros((len(sets), SKETCH), np.uint16)
                h1, h2 = np.zeros(len(sets), U), np.zeros(len(sets), U)
                if len(full):
                    flat = np.concatenate([sets[i] for i in full])
                    head = np.cumsum(sizes[full]) - sizes[full]
                    h1[full] = np.add.reduceat(kit.mix(flat ^ salts[-1]), head)
                    h2[full] = np.add.reduceat(kit.mix(flat ^ salts[-2]), head)
                    for t in range(TREES):
                        keys[full, t] = np.minimum.reduceat(kit.mix(flat ^ salts[t]), head).view(np.int64)
                    short = (flat >> U(32)).astype(np.uint32)
                    for k in range(SKETCH):
                        x = short * odd[k]
                        x ^= x >> np.uint32(15)
                        x *= np.uint32(0x2C1B3C6D)
                        least = np.minimum.reduceat(x, head)
                        sketch[full, k] = ((least * np.uint32(0x297A2D39)) >> np.uint32(16)).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [
                        part[doc_id].cast(pa.int64()).fill_null(NO_ID).combine_chunks(),
                        pa.array(sizes),
                        pa.array(h1.view(np.int64)),
                        pa.array(h2.view(np.int64)),
                        pa.array(list(keys), pa.list_(pa.int64())),
                        pa.array([row.tobytes() for row in sketch], pa.binary()),
                    ],
                    names=["id", "n", "h1", "h2", "keys", "sketch"],
                )

    return docs.select(doc_id, text).mapInArrow(kit.giving_back(run), "id long, n long, h1 long, h2 long, keys array<long>, sketch binary")


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a partition that is sorted by ``keys``, one at a time."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        cols = [table[k].to_numpy() for k in keys]
        edge = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        if last is not None and last != tuple(c[0] for c in cols):
            yield pa.concat_tables(held)
            held = []
        cuts = [0, *edge.tolist(), len(table)]
        for i, j in zip(cuts[:-1], cuts[1:]):
            if i:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(i, j - i))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.concat_tables(held)


def forest(n: int, linked) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``n`` rows; ``linked(i, others)`` says which of the others row i is linked with."""
    out, open_ = [], np.arange(n)
    while len(open_):
        queue, open_ = [int(open_[0])], open_[1:]
        while queue and len(open_):
            i = queue.pop()
            hit = linked(i, open_)
            found = open_[hit].tolist()
            out += [(i, j) for j in found]
            queue += found
            open_ = open_[~hit]
    return out


def _edges(pairs: list[tuple[int, int]], ids: np.ndarray) -> pa.RecordBatch:
    p = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(ids[p[:, 0]]), pa.array(ids[p[:, 1]])], names=["a", "b"])


def _binary_matrix(column: pa.ChunkedArray, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def split_blocks(rows: DataFrame, size: str, limit: int, id_col: str) -> DataFrame:
    """Groups of more than ``limit`` rows as pairs of blocks ``i <= j``: any two rows of a group meet in one pair."""
    blocks = F.ceil(F.col(size) / F.lit(limit // 2)).cast("int")
    one = F.col(size) <= limit
    own = F.when(one, F.lit(0)).otherwise(F.pmod(F.xxhash64(id_col), blocks).cast("int"))
    pairs = F.when(one, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), blocks - 1), lambda x: F.struct(F.least(x, F.col("_own")).alias("i"), F.greatest(x, F.col("_own")).alias("j")))
    )
    return rows.withColumn("_own", own).withColumn("_pair", F.explode(pairs)).select("*", "_pair.i", "_pair.j").drop("_own", "_pair")


def sketch_links(nodes: DataFrame, share: float) -> DataFrame:
    """Spanning links ``a, b`` of the pairs in each node whose sketches agree enough."""
    least = least_equal(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["node", "i", "j"]):
            ids, n = group["c"].to_numpy(), group["n"].to_numpy()
            sketch = _binary_matrix(group["sketch"], np.uint16, SKETCH)

            def linked(i, others):
                fits = (np.minimum(n[i], n[others]) >= share * np.maximum(n[i], n[others])) & (ids[others] != ids[i])
                return fits & ((sketch[others] == sketch[i]).sum(axis=1) >= least)

            pairs = forest(len(ids), linked)
            if pairs:
                yield _edges(pairs, ids)

    return nodes.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j").select("node", "i", "j", "c", "n", "sketch").mapInArrow(kit.giving_back(run), "a long, b long")


def exact_links(sets: DataFrame, percent: int) -> DataFrame:
    """Spanning links ``a, b`` of the pairs in each group with ``100 * |A & B| >= percent * |A | B|`` on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["group", "i", "j"]):
            ids = group["c"].to_numpy()
            data = group["shingles"].to_pylist()
            n = np.array([len(d) // 8 for d in data], np.int64)
            _, token = np.unique(np.frombuffer(b"".join(data), U), return_inverse=True)
            at = np.append(0, np.cumsum(n))
            present = np.zeros(int(token.max()) + 1, bool)

            def linked(i, others):
                fits = others[(100 * np.minimum(n[i], n[others]) >= percent * np.maximum(n[i], n[others]))]
                hit = np.zeros(len(others), bool)
                if len(fits):
                    own = token[at[i] : at[i + 1]]
                    present[own] = True
                    total = int(n[fits].sum())
                    head = np.cumsum(n[fits]) - n[fits]
                    where = np.arange(total) + np.repeat(at[fits] - head, n[fits])
                    both = np.add.reduceat(present[token[where]], head, dtype=np.int64)
                    present[own] = False
                    hit[np.searchsorted(others, fits)] = 100 * both >= percent * (n[i] + n[fits] - both)
                return hit

            pairs = forest(len(ids), linked)
            if pairs:
                yield _edges(pairs, ids)

    return sets.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j").select("group", "i", "j", "c", "shingles").mapInArrow(kit.giving_back(run), "a long, b long")


def tree_nodes(classes: DataFrame) -> DataFrame:
    """Nodes to compare: ``node, i, j, c, n, sketch``."""
    rows = classes.select("c", F.explode("keys").alias("node"))
    done, depth = [], 0
    while True:
        sizes = rows.groupBy("node").agg(F.count("*").alias("m")).where("m > 1")
        rows = materialize(rows.join(sizes, "node"), "nodes")
        largest = rows.agg(F.max("m")).first()[0] or 0
        done.append(rows if depth == DEPTH or largest <= NODE_ROWS else rows.where(F.col("m") <= NODE_ROWS))
        if depth == DEPTH or largest <= NODE_ROWS:
            break
        depth += 1
        big = rows.where(F.col("m") > NODE_ROWS).join(classes.select("c", "sketch"), "c")
        children = []
        for b in range(BRANCHES):
            place = F.pmod(F.xxhash64("node", F.lit(b), F.lit(depth)), F.lit(SKETCH)).cast("int")
            # the same place in the sketch for all documents of the node
            value = F.col("sketch").substr(place * 2 + 1, F.lit(2))
            children.append(F.xxhash64("node", F.lit(b), value))
        rows = big.select("c", F.explode(F.array(*children)).alias("node"))
    nodes = done[0]
    for more in done[1:]:
        nodes = nodes.unionByName(more)
    nodes = nodes.join(classes.select("c", "n", "sketch"), "c")
    return split_blocks(nodes, "m", NODE_ROWS, "c")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Two documents are linked when ``100 * |A & B| >= percent * |A | B|`` for their sets of distinct shingles of five lower-cased
    words (a text of fewer words is one shingle). ``component_id`` is the smallest id reachable over links, and the document
    that carries it is kept. Texts with the same set form one class, so copies cost one row however many there are.

    Null texts and texts without words have the empty set and are linked with nothing. A null id counts as smaller
    than any other id. Repeated rows are copies of each other: with the same id, all are kept or none.
    """
    ship_package(docs.sparkSession)
    share = percent / 100
    marked = materialize(sketches(docs, text, doc_id), "sketches")
    classes = materialize(
        marked.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("id").alias("c"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")),
        "classes",
    )
    joined = components(sketch_links(tree_nodes(classes), share))
    joined = materialize(joined.join(joined.groupBy("component").agg(F.count("*").alias("m")), "component"), "groups")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(pa.chunked_array([batch.column("text")]))
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in ("group", "m", "c")] + [pa.array([s.tobytes() for s in sets], pa.binary())], names=["group", "m", "c", "shingles"])

    wanted = joined.select(F.col("node").alias("c"), F.col("component").alias("group"), "m")
    texts = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("c"), F.col(text).alias("text"))
    sets = texts.join(wanted, "c").select("group", "m", "c", "text").mapInArrow(kit.giving_back(to_sets), "group long, m long, c long, shingles binary")
    links = exact_links(split_blocks(sets.where(F.length("shingles") > 0), "m", GROUP_ROWS, "c"), percent)
    found = components(links)
    classes = classes.select("h1", "h2", "n", "c").join(found.withColumnRenamed("node", "c"), "c", "left")
    classes = classes.select("h1", "h2", "n", F.coalesce("component", "c").alias("component"))
    out = marked.select("id", "n", "h1", "h2").join(classes, ["h1", "h2", "n"], "left")
    component = F.coalesce("component", "id")
    none = F.lit(NO_ID)
    return out.select(
        F.nullif("id", none).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.nullif(component, none).alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
