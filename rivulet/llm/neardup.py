"""Near-duplicate groups by HyperMinHash.

1. Every text becomes the set of its word shingles and a sketch of 256
   registers (leading-zero count and mantissa of the smallest hash per bucket).
   Texts with equal sets form a class, represented by its smallest id.
2. Bands over the densified registers put similar classes into common
   buckets. In each bucket all members are paired with the smallest one only.
3. The collision-corrected Jaccard estimate of the registers discards pairs
   far below the threshold; the rest are confirmed on the full sets.
4. Buckets whose members are still in several components are finished by
   comparing, on the full sets, the members outside the bucket's main
   component with all others but the smallest one, which has met them all;
   of buckets with the same members one is compared. Rows are dealt to cells
   of bounded size.
5. Connected components of the confirmed links give the groups.

Two sets at the threshold meet in a bucket with probability
1 - (1 - threshold^width)^bands; the defaults miss 3 in 10^6 at 0.8 and fewer
above, if the registers of a band are independent. Those of sets below SMALL
shingles are not, since most are copies of others; these sets, and those
that may be linked with one, have bands of independent hash functions
instead. Everything found is confirmed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm import hyperminhash as H
from rivulet.llm.common import components, id_filter, id_slot, lookup
from rivulet.llm.words import by_bytes, shingle_sets
from rivulet.session import written

#: about the most sets and shingles of one side of a cell
CELL, CELL_SHINGLES = 1000, 1 << 21
SMALL = 64


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    threshold: float = 0.8, bands: int = 42, width: int = 6) -> DataFrame:
    """One row per row of `docs`: (id, n_shingles, component_id, kept).

    Two texts are linked when the Jaccard similarity of their shingle sets is
    at least `threshold` (a multiple of 0.01). component_id is the smallest id
    that links reach, kept is id = component_id. Null and empty texts and
    texts without words have an empty set and are linked with nothing. Rows
    sharing an id are one document: whatever one of them is linked with, all
    are. Rows with a null id are sketched but never linked: their component is
    null and they are kept. Further columns are ignored.
    """
    percent = round(threshold * 100)
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketch = written(d.mapInArrow(_sketcher(shingle, percent, bands, width), _SKETCH), "sketch")
    total = sketch.count()
    named = sketch.where(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
    classes = written(named.groupBy("h1", "h2").agg(
        F.min("id").alias("cid"), F.count(F.lit(1)).alias("n_rows"), F.first("n_shingles").alias("n"),
        F.first("reg").alias("reg"), F.first("small").alias("small")), "classes")

    members = _members(classes, total, bands, width)
    star = written(members.where(F.col("cid") != F.col("hub")).select("hub", "cid").distinct(), "star")
    star = _estimated(star, classes, percent)
    links = _repeated_ids(sketch.where("id IS NOT NULL"), classes, total)
    links = links.union(_confirmed(_star_cells(star), d, shingle, percent))
    links = written(links, "links")
    first = written(components(links), "labels")

    second = _confirmed(_open_cells(members, first, total), d, shingle, percent)
    found = written(components(links.union(second)), "labels")

    labelled = classes.select("h1", "h2", "n_rows", "cid").join(
        found.withColumnRenamed("id", "cid"), "cid", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "cid"))
    light = sketch.select("id", "n_shingles", "h1", "h2")
    out = written(lookup(light, labelled, ["h1", "h2"], ["component"], total), "placed")
    # a row without words goes with the other rows of its id, where there are some with words
    bare = out.where((F.col("n_shingles") == 0) & F.col("id").isNotNull()).select("id").distinct()
    own = out.where(F.col("n_shingles") > 0).join(bare, "id", "left_semi").groupBy("id").agg(
        F.min("component").alias("own"), F.count(F.lit(1)).alias("n_rows"))
    out = lookup(out, own, ["id"], ["own"], total)
    comp = F.when(F.col("n_shingles") > 0, F.when(F.col("id").isNotNull(), F.col("component"))).otherwise(F.coalesce("own", "id"))
    out = out.withColumn("component_id", comp)
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` with one document of each near-duplicate group: the one with
    the smallest id. All columns stay; rows with a null id stay."""
    gone = near_duplicates(docs, id_col, text_col, **options).where(~F.col("kept")).select(id_col).distinct()
    return docs.join(gone, id_col, "left_anti").select(docs.columns)


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` with one row of each group of near-duplicate rows, whether their
    ids are repeated or null: the one with the smallest id, a null id only
    where the group has no other. Rows without words are linked with nothing
    and stay. Every row gets a key of its own, written with the input, and
    the links run on these keys."""
    docs = written(docs.withColumn(_ROW, F.monotonically_increasing_id()), "rows")
    gone = near_duplicates(docs, _ROW, text_col, **options).where(~F.col("kept"))
    gone = written(gone.select(_ROW, "component_id"), "gone")
    # groups of one row never get here; a key links to the smallest key of its group
    rows = gone.union(gone.select(F.col("component_id").alias(_ROW), "component_id").distinct())
    rows = rows.join(docs.select(_ROW, F.col(id_col).alias("__id")), _ROW)
    rows = written(rows.select(_ROW, "component_id", "__id"), "groups")
    best = rows.groupBy("component_id").agg(
        F.min(F.struct(F.col("__id").isNull(), "__id", _ROW))[_ROW].alias(_ROW))
    gone = rows.select(_ROW).join(best, _ROW, "left_anti")
    return docs.join(gone, _ROW, "left_anti").drop(_ROW)


_ROW = "__row"
_SKETCH = "id long, n_shingles long, h1 long, h2 long, reg binary, small binary"


def _sketcher(shingle: int, percent: int, bands: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in (s for b in batches for s in by_bytes(b, "text")):
            sets = shingle_sets(b.column("text"), shingle)
            reg = H.registers(sets)
            digest = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            both = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
            few = [i for i, s in enumerate(sets) if 0 < len(s) * percent < SMALL * 100]
            small = dict(zip(few, H.independent_band_keys([sets[i] for i in few], bands, width)))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(both[:, 0].copy()),
                 pa.array(both[:, 1].copy()), pa.array([r.tobytes() for r in reg], pa.binary()),
                 pa.array([small[i].tobytes() if i in small else None for i in range(len(sets))], pa.binary())],
                ["id", "n_shingles", "h1", "h2", "reg", "small"])
    return run


def _members(classes: DataFrame, total: int, bands: int, width: int) -> DataFrame:
    """(bucket, cid, n, hub): the members of every bucket with two or more."""
    def run(batches):
        for b in (b.slice(a, 2000) for b in batches for a in range(0, b.num_rows, 2000)):
            few = b.column("small").is_valid()
            for part, keys in ((b.filter(pc.greater_equal(b.column("n"), SMALL)), None), (b.filter(few), "small")):
                if keys:
                    k = np.frombuffer(b"".join(part.column(keys).to_pylist()), np.int64)
                else:
                    reg = np.frombuffer(b"".join(part.column("reg").to_pylist()), np.uint16).reshape(-1, H.BUCKETS)
                    k = H.band_keys(reg, bands, width).view(np.int64).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(k), *(pa.array(np.repeat(part.column(c).to_numpy(), bands))
                                                                 for c in ("cid", "n"))], ["bucket", "cid", "n"])

    rows = classes.select("cid", "n", "reg", "small").mapInArrow(run, "bucket long, cid long, n long")
    hubs = rows.groupBy("bucket").agg(F.min("cid").alias("hub"), F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
    # a bucket's rows are at most total * bands, twice for sets with both kinds of bands
    out = lookup(rows, hubs, ["bucket"], ["hub"], 2 * total * bands)
    return written(out.where(F.col("hub").isNotNull()), "members")


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (hub, cid) whose set sizes and estimated Jaccard similarity do
    not rule the threshold out: the estimate may be five standard
    deviations below it."""
    sk = classes.select("cid", "n", "reg")
    hub = sk.select(F.col("cid").alias("hub"), F.col("n").alias("hub_n"), F.col("reg").alias("hub_reg"))
    j = pairs.join(sk, "cid").where(F.col("n") > 0)
    per_hub = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n_pairs"))
    # a hub with many pairs is met by as many salted copies of its sketch
    salts = per_hub.withColumn("parts", (F.col("n_pairs") / CELL).cast("long") + 1)
    hub = hub.join(salts, "hub").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    j = lookup(j, salts, ["hub"], ["parts"], pairs.count(), count="n_pairs").withColumn(
        "part", F.pmod(F.xxhash64("cid"), F.col("parts")))
    j = j.join(hub.select("hub", "part", "hub_n", "hub_reg"), ["hub", "part"])
    j = j.where(F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            a, c = (np.frombuffer(b"".join(b.column(x).to_pylist()), np.uint16).reshape(-1, H.BUCKETS)
                    for x in ("reg", "hub_reg"))
            est, used = H.jaccard_estimate(a, c, b.column("n").to_numpy(), b.column("hub_n").to_numpy())
            t = percent / 100
            keep = est >= t - 5 * np.sqrt(t * (1 - t) / np.maximum(used, 1))
            yield b.select(["hub", "cid", "n"]).filter(pa.array(keep))

    return written(j.select("hub", "cid", "n", "hub_n", "reg", "hub_reg").mapInArrow(
        run, "hub long, cid long, n long"), "pairs")


def _star_cells(pairs: DataFrame) -> DataFrame:
    """Rows (cell, part, side, id, label): each hub on side 0 of its cells,
    the classes paired with it on side 1, at most about CELL, or CELL_SHINGLES
    in their sets, in each part."""
    n = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n_pairs"), F.sum("n").alias("n")).withColumn("parts", _parts("n_pairs", "n"))
    side1 = lookup(pairs, n, ["hub"], ["parts"], pairs.count(), count="n_pairs").select(
        F.col("hub").alias("cell"), F.pmod(F.xxhash64("cid"), F.col("parts")).alias("part"), F.lit(1).alias("side"),
        F.col("cid").alias("id"), F.col("cid").alias("label"))
    side0 = n.select(F.col("hub").alias("cell"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
                     .alias("part"), F.lit(0).alias("side"), F.col("hub").alias("id"), F.col("hub").alias("label"))
    return side0.union(side1)


def _parts(rows: str, shingles: str):
    return F.greatest(F.col(rows) / CELL, F.col(shingles) / CELL_SHINGLES).cast("long") + 1


def _open_cells(members: DataFrame, labels: DataFrame, total: int) -> DataFrame:
    """The cells of the buckets whose members besides the hub, which has met
    them all, are in several components. Side 0 holds those outside the hub's
    component, side 1 all; both are cut into blocks of about CELL, and each
    pair of blocks is a cell. Of buckets with the same members one is taken:
    similar texts share several."""
    lab = labels.select(F.col("id").alias("cid"), F.col("component").alias("label"))
    m = members.join(lab, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    m = written(m, "open")
    other = F.col("cid") != F.col("hub")
    size = m.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("shingles"), F.min(F.when(other, F.col("label"))).alias("lo"),
        F.max(F.when(other, F.col("label"))).alias("hi"), F.max(F.when(~other, F.col("label"))).alias("main"),
        F.sum(F.xxhash64("cid").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("xor"))
    same = size.where("lo < hi").groupBy("n_rows", "main", "sum", "xor").agg(
        F.min("bucket").alias("bucket"), F.first("shingles").alias("shingles"))
    same = same.select("bucket", "n_rows", "main", _parts("n_rows", "shingles").alias("parts"))
    out = lookup(m.where(other), same, ["bucket"], ["main", "parts"], members.count()).where(F.col("main").isNotNull())
    block = F.pmod(F.xxhash64("cid"), F.col("parts"))
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    base = out.select("bucket", "cid", "label", "main", "parts", block.alias("block"), every.alias("every"))
    side1 = base.select("bucket", F.explode("every").alias("other"), "block", "parts", F.lit(1).alias("side"), "cid", "label")
    side0 = base.where(F.col("label") != F.col("main")).select(
        "bucket", F.col("block").alias("other"), F.explode("every").alias("block"), "parts", F.lit(0).alias("side"),
        "cid", "label")
    return side0.unionByName(side1).select(
        F.col("bucket").alias("cell"), (F.col("other") * F.col("parts") + F.col("block")).alias("part"), "side",
        F.col("cid").alias("id"), "label")


def _confirmed(cells: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between members of side 0 and side 1 of a cell with
    different labels whose full shingle sets reach the threshold; links inside
    what earlier links of the cell have joined are left out."""
    cells = written(cells, "cells")
    ids = cells.select("id").distinct()
    bits = id_filter(ids, "id")
    wanted = docs.where(F.col("id").isNotNull()).select("id", "text", id_slot("id").alias("slot"))

    def sets(batches):
        table = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
        seen = set()
        for b in (s for b in batches for s in by_bytes(b, "text")):
            b = b.filter(pa.array(table[b.column("slot").to_numpy()].astype(bool)))
            out = shingle_sets(b.column("text"), shingle)
            # another text of the id may have no word: it links with nothing
            new = []
            for i, s in zip(b.column("id").to_pylist(), out):
                mark = (i, len(s), hash(s.tobytes()))
                new.append(len(s) > 0 and mark not in seen)
                seen.add(mark)
            if len(seen) > 100_000:  # an id with very many rows is soon met again
                seen.clear()
            b, out = b.filter(pa.array(new, pa.bool_())), [s for s, x in zip(out, new) if x]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([s.tobytes() for s in out], pa.large_binary()).cast(pa.binary())],
                ["id", "shingles"])

    # a task sends an id's set once; dealt by id, the sets meet their cells without another shuffle
    full = wanted.mapInArrow(sets, "id long, shingles binary").repartition("id").dropDuplicates(["id", "shingles"])
    rows = cells.join(full, "id").repartition("cell", "part").sortWithinPartitions("cell", "part", "side")
    return rows.select("cell", "part", "side", "id", "label", "shingles").mapInArrow(
        _cell_links(percent), "a long, b long")


def _cell_links(percent: int):
    def links(ids, side, label, sets):
        size = np.fromiter(map(len, sets), np.int64, len(sets))
        codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        group = {x: x for x in set(label)}

        def root(x):
            while group[x] != x:
                group[x] = x = group[group[x]]
            return x

        mark = np.zeros(codes.max() + 1, bool)
        right = np.flatnonzero(np.asarray(side) == 1)
        lab = np.asarray(label)
        for i in np.flatnonzero(np.asarray(side) == 0).tolist():
            mine = codes[start[i]:start[i] + size[i]]
            mark[mine] = True
            common = np.add.reduceat(mark[codes].astype(np.int64), start)
            mark[mine] = False
            hit = right[(100 * common[right] >= percent * (size[i] + size[right] - common[right]))
                        & (lab[right] != lab[i])]
            for j in hit.tolist():
                x, y = root(label[i]), root(label[j])
                if x != y:
                    group[max(x, y)] = min(x, y)
                    yield ids[i], ids[j]

    def run(batches):
        key, rows = None, ([], [], [], [])

        def flush():
            found = list(links(*rows)) if rows[0] and rows[1][0] == 0 and rows[1][-1] == 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()),
                                               pa.array([x[1] for x in found], pa.int64())], ["a", "b"])

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("cell", "part", "side", "id", "label", "shingles")]
            for cell, part, side, i, label, s in zip(*cols):
                if (cell, part) != key:
                    if len(rows[0]) > 1:
                        yield flush()
                    key, rows = (cell, part), ([], [], [], [])
                for to, x in zip(rows, (i, side, label, np.frombuffer(s, np.uint64))):
                    to.append(x)
        if len(rows[0]) > 1:
            yield flush()
    return run


def _repeated_ids(sketch: DataFrame, classes: DataFrame, total: int) -> DataFrame:
    """Links between the classes of rows that share an id."""
    own = lookup(sketch.where("n_shingles > 0").select("id", "h1", "h2"), classes, ["h1", "h2"], ["cid"], total)
    low = own.groupBy("id").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).where("low < high")
    return own.join(low, "id").where(F.col("cid") != F.col("low")).select(
        F.col("cid").alias("a"), F.col("low").alias("b")).distinct()
