"""Near duplicates among embeddings of one label, by randomised-rotation binary codes.

1. Equal vectors of a label form a class, made before anything else is compared.
2. Every class has a binary code with its correction factor, and band keys (``binary_codes``).
3. Dense places become cells: the mean direction of a bucket of the first band that holds at least
   ``HEAVY`` classes is a pivot, and classes that share one of the first ``LOOKUPS`` bands with a pivot
   go to the nearest one. Those within half the threshold's angle form its tight cell, in which all
   pairs link by the triangle inequality of angles; those up to the whole angle form its loose cell.
   All other classes are units of their own. So a group of near copies is a few units, however large.
4. Units that share a band key are candidates. The confidence bound of their estimated inner product,
   widened by the cells' radii, drops those that cannot link; only the rest is computed exactly.
   Buckets above ``BUCKET`` units are split into blocks, and pairs of blocks go to different tasks.
5. Exactly known angles of two pivots decide for all their members at once where the radii allow it.
   Other pairs of cells, and loose cells with themselves, are compared member by member in blocks;
   such a block gives counts and the edges of a spanning forest, not its pairs.
6. Links of a class are added up from these parts, and components are those of the units.

Only step 2's bands are a matter of chance: a pair just at the threshold is missed with probability
``binary_codes.MISSED`` (less, the closer it is), and no pair below the threshold is ever linked.

Defined cases: null, zero, empty vectors, vectors with null or non-finite entries, and rows of null label
link with nothing; vectors of different lengths do not link; equal vectors of one label always link;
rows of null or repeated vec_id count each for itself, and a component of null ids only has a null id;
an empty table gives no rows; only vec_id, embedding and label are read, so other columns may have
any names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.llm import binary_codes
from waitlens.llm.common import cut, shuffle_partitions, stored
from waitlens.llm.components import components

THRESHOLD = 0.93
HEAVY = 32
LOOKUPS = 6
BUCKET = 2048
BLOCK = 2048
#: angles nearer than this to a bound are not decided by the triangle inequality
MARGIN = 1e-7
PLACE = ["label", "width"]
CODE = ["code", "factor", "query", "step"]
SINGLE, TIGHT, LOOSE = 0, 1, 2


def comparable(vector: Column, label: Column) -> Column:
    """Rows that can link at all."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return label.isNotNull() & vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda c: c != 0), F.lit(False))


def _by_width(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) for the rows of each length."""
    values = np.asarray(column.flatten()).astype(np.float64)
    sizes = np.diff(np.asarray(column.offsets))
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    for width in np.unique(sizes):
        rows = np.flatnonzero(sizes == width)
        yield rows, binary_codes.unit(values[starts[rows][:, None] + np.arange(width)])


def _table(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def coded(rows: DataFrame, bits: int, bands: int) -> DataFrame:
    """``rows`` (with a column embedding) and their keys and codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("embedding"))
            n = len(batch)
            keys, factor, step = np.zeros((n, bands), np.int64), np.zeros(n, np.float32), np.zeros(n, np.float32)
            code, query = [b""] * n, [b""] * n
            for at, units in _by_width(vectors):
                keys[at] = binary_codes.band_keys(units, bits, bands)
                c, factor[at], q, step[at] = binary_codes.encode(units)
                for i, a, b in zip(at.tolist(), c, q, strict=True):
                    code[i], query[i] = a.tobytes(), b.tobytes()
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, n * bands + 1, bands, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, listed, pa.array(code, pa.binary()), pa.array(factor), pa.array(query, pa.binary()), pa.array(step)],
                [*batch.schema.names, "keys", *CODE])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, keys array<long>, code binary, factor float, query binary, step float")


def with_cosine(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` with the exact cosine of the vectors in columns a and b in their place."""
    others = [c for c in pairs.columns if c not in (a, b)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosine = np.zeros(len(batch))
            sides = zip(_by_width(batch.column(len(others))), _by_width(batch.column(len(others) + 1)), strict=True)
            for (at, x), (_, y) in sides:
                cosine[at] = np.einsum("ij,ij->i", x, y)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(others)], pa.array(cosine)], [*others, "cosine"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.select(*others).schema)
    return pairs.select(*others, a, b).mapInArrow(run, f"{fields}, cosine double")


def _angle(cosine: Column) -> Column:
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine)))


def _pivots(classes: DataFrame, bits: int, bands: int) -> DataFrame:
    """pid, label, width, embedding, keys, codes: mean directions of heavy buckets of the first band,
    thinned to the one of most support in each bucket of the next bands."""
    first = classes.withColumn("key", F.col("keys")[0])
    heavy = first.groupBy(*PLACE, "key").agg(F.count("*").alias("support")).filter(F.col("support") >= HEAVY)
    size = F.aggregate("embedding", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    entries = first.join(heavy, [*PLACE, "key"]).select(
        *PLACE, "key", "support", F.posexplode(F.transform("embedding", lambda c: c.cast("double") / F.sqrt(size))).alias("i", "c"))
    means = entries.groupBy(*PLACE, "key", "support", "i").agg(F.avg("c").alias("c"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("i", "c"))), lambda e: e["c"])  # one entry a dimension
    vectors = means.groupBy(*PLACE, "key", "support").agg(listed.alias("embedding"))
    vectors = vectors.filter(comparable(F.col("embedding"), F.col("label"))).drop("key")
    pivots = stored(coded(vectors, bits, bands).withColumn("pid", F.monotonically_increasing_id()))
    kept = pivots.select(*PLACE, "pid", "support", "keys")
    for band in range(1, min(LOOKUPS, bands)):
        best = F.max_by(F.struct("pid", "support", "keys"), F.struct("support", "pid")).alias("best")
        kept = kept.groupBy(*PLACE, F.col("keys")[band].alias("key")).agg(best).select(*PLACE, "best.*")
    return cut(pivots.join(kept.select("pid"), "pid", "left_semi"))


def _members(classes: DataFrame, pivots: DataFrame, reach: float) -> DataFrame:
    """cid, unit, kind, angle (to the cell's pivot) for every class."""
    mine = classes.select(*PLACE, "cid", F.explode(F.slice("keys", 1, LOOKUPS)).alias("key"))
    theirs = pivots.select(*PLACE, "pid", F.explode(F.slice("keys", 1, LOOKUPS)).alias("key"))
    met = mine.join(theirs, [*PLACE, "key"]).select("cid", "pid").distinct()
    both = (met.join(classes.select("cid", F.col("embedding").alias("a")), "cid")
            .join(pivots.select("pid", F.col("embedding").alias("b")), "pid"))
    near = with_cosine(both, "a", "b").select("cid", "pid", _angle(F.col("cosine")).alias("angle")).filter(F.col("angle") <= reach)
    nearest = near.groupBy("cid").agg(F.min(F.struct("angle", "pid")).alias("n")).select("cid", "n.*")
    kind = F.when(F.col("angle") <= reach / 2 - MARGIN, TIGHT).otherwise(LOOSE)
    placed = nearest.select("cid", kind.alias("kind"), "angle", (-2 * F.col("pid") - kind).alias("unit"))
    alone = F.col("unit").isNull()
    return classes.select("cid", "weight").join(placed, "cid", "left").select(
        "cid", "weight", F.when(alone, F.col("cid")).otherwise(F.col("unit")).alias("unit"),
        F.when(alone, SINGLE).otherwise(F.col("kind")).alias("kind"), F.coalesce("angle", F.lit(0.0)).alias("angle"))


def _candidates(entries: DataFrame, reach: float, bucket: int) -> DataFrame:
    """(u, v), u < v: units that share a band key and whose bound allows a link."""
    spark = entries.sparkSession
    place = [*PLACE, "key"]
    hot = entries.groupBy(*place).agg(F.count("*").alias("held")).filter(F.col("held") > bucket)
    blocks = hot.select(*place, F.ceil(F.col("held") / bucket).cast("int").alias("blocks"))
    dealt = entries.join(blocks, place, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("unit"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("cell", F.xxhash64(*place, F.least("block", "other"), F.greatest("block", "other")))
    across = (F.col("block") != F.col("other")).alias("across")
    dealt = dealt.select("cell", across, "block", "unit", "radius", *CODE)
    parts = shuffle_partitions(spark)
    dealt = dealt.repartition(parts, "cell").sortWithinPartitions("cell", "unit")

    def pairs(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        cell, unit = np.asarray(rows["cell"]), np.asarray(rows["unit"])
        block, across, radius = np.asarray(rows["block"]), np.asarray(rows["across"]), np.asarray(rows["radius"])
        factor, step = np.asarray(rows["factor"]), np.asarray(rows["step"])
        codes, queries = rows["code"].to_pylist(), rows["query"].to_pylist()
        widths = np.array([len(q) for q in queries])
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for width in np.unique(widths):
            at = np.flatnonzero(widths == width)
            code = np.frombuffer(b"".join(codes[i] for i in at), np.uint8).reshape(len(at), -1)
            query = np.frombuffer(b"".join(queries[i] for i in at), np.int8).reshape(len(at), -1)
            c, u, bl, ac, r, f, s = cell[at], unit[at], block[at], across[at], radius[at], factor[at], step[at]
            here = np.arange(len(at) - 1)
            for away in range(1, len(at)):
                here = here[here + away < len(at)]
                here = here[c[here] == c[here + away]]
                if not len(here):
                    break
                for lo in range(0, len(here), 1 << 16):
                    i = here[lo:lo + (1 << 16)]
                    j = i + away
                    meant = (u[i] != u[j]) & ((ac[i] & ac[j] & (bl[i] != bl[j])) | (~ac[i] & ~ac[j]))
                    i, j = i[meant], j[meant]
                    upper = binary_codes.upper_cosines(code[i], f[i], query[j], s[j])
                    may = np.arccos(np.clip(upper, -1, 1)) - r[i] - r[j] <= reach + MARGIN
                    out.append((u[i[may]], u[j[may]]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def found(rows: pa.Table) -> pa.RecordBatch:
            u, v = pairs(rows)
            both = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], 1), axis=0)
            return _table({"u": pa.array(both[:, 0]), "v": pa.array(both[:, 1])})

        for batch in batches:  # whole cells at a time; the last one may go on in the next batch
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            cells = np.asarray(held["cell"])
            end = int(np.searchsorted(cells, cells[-1])) if len(cells) else 0
            if end:
                yield found(held.slice(0, end).combine_chunks())
                held = held.slice(end)
        if held is not None and len(held):
            yield found(held.combine_chunks())

    return dealt.mapInArrow(run, "u long, v long").distinct()


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Edges (row, column) of a spanning forest of a bipartite matrix of links."""
    edges, free_rows, free_columns = [], links.any(1), np.ones(links.shape[1], bool)
    while free_rows.any():
        start = int(np.argmax(free_rows))
        free_rows[start] = False
        wave = [start]
        while wave:
            row = wave.pop()
            for column in np.flatnonzero(links[row] & free_columns).tolist():
                free_columns[column] = False
                edges.append((row, column))
                more = np.flatnonzero(links[:, column] & free_rows)
                free_rows[more] = False
                edges.extend((r, column) for r in more.tolist())
                wave.extend(more.tolist())
    return edges


def _member_links(partial: DataFrame, members: DataFrame, classes: DataFrame, threshold: float, block: int) -> DataFrame:
    """(cid, links, other): numbers of linked rows of the classes of undecided pairs of units (u, v), one
    row a class and pair of blocks, and the edges of a spanning forest (links 0)."""
    units = members.groupBy("unit").agg(F.count("*").alias("held"))
    blocks = units.select("unit", F.ceil(F.col("held") / block).cast("int").alias("blocks"))
    jobs = (partial.join(blocks.toDF("u", "ku"), "u").join(blocks.toDF("v", "kv"), "v")
            .withColumn("bu", F.explode(F.sequence(F.lit(0), F.col("ku") - 1))).withColumn("bv", F.explode(F.sequence(F.lit(0), F.col("kv") - 1)))
            .filter((F.col("u") != F.col("v")) | (F.col("bu") <= F.col("bv"))).select("u", "v", "bu", "bv"))
    dealt = (members.join(blocks, "unit").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
             .select("unit", "block", "cid", "weight").join(classes.select("cid", "embedding"), "cid"))
    job = ["u", "v", "bu", "bv"]
    left = jobs.join(dealt.withColumnsRenamed({"unit": "u", "block": "bu"}), ["u", "bu"]).select(*job, F.lit(0).alias("side"), "cid", "weight", "embedding")
    right = jobs.join(dealt.withColumnsRenamed({"unit": "v", "block": "bv"}), ["v", "bv"]).select(*job, F.lit(1).alias("side"), "cid", "weight", "embedding")
    right = right.filter((F.col("u") != F.col("v")) | (F.col("bu") != F.col("bv")))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["side", "cid"])
        vectors = binary_codes.unit(np.array(rows["embedding"].tolist(), np.float64))
        cid, weight, side = rows["cid"].to_numpy(), rows["weight"].to_numpy(), rows["side"].to_numpy()
        a = side == 0
        own = rows["u"].iloc[0] == rows["v"].iloc[0] and rows["bu"].iloc[0] == rows["bv"].iloc[0]  # a block with itself
        b = a if own else ~a
        links = vectors[a] @ vectors[b].T >= threshold
        if own:
            np.fill_diagonal(links, False)
        counts = [pd.DataFrame({"cid": cid[a], "links": links @ weight[b], "other": cid[a]})]
        if not own:
            counts.append(pd.DataFrame({"cid": cid[b], "links": links.T @ weight[a], "other": cid[b]}))
        tree = _forest(links)
        counts.append(pd.DataFrame({"cid": cid[a][[r for r, _ in tree]], "links": 0, "other": cid[b][[c for _, c in tree]]}))
        out = pd.concat(counts, ignore_index=True)
        return out[(out["links"] > 0) | (out["cid"] != out["other"])]

    return left.unionByName(right).groupBy(*job).applyInPandas(compare, "cid long, links long, other long")


def class_links(classes: DataFrame, threshold: float = THRESHOLD, *, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """cid, n_links (rows that a row of the class links with), component_id for the classes (cid, label,
    width, embedding, weight, least) of one or more rows with equal vectors."""
    reach = math.acos(threshold)
    most = classes.groupBy(*PLACE).count().agg(F.max("count")).first()[0] or 1
    bits, bands = binary_codes.banding(most, threshold)
    classes = stored(coded(classes, bits, bands))
    pivots = _pivots(classes, bits, bands)
    members = stored(_members(classes, pivots, reach))
    cells = members.filter(F.col("kind") != SINGLE).groupBy("unit", "kind").agg(F.max("angle").alias("radius"), F.sum("weight").alias("weight"))
    cells = cells.withColumn("pid", (F.abs("unit") - F.col("kind")) / 2)
    cells = stored(cells.withColumn("pid", F.col("pid").cast("long")).join(pivots.select("pid", *PLACE, "embedding", *CODE), "pid").drop("pid"))
    alone = classes.join(members.filter(F.col("kind") == SINGLE).select("cid"), "cid", "left_semi")

    singles = alone.select(*PLACE, F.explode("keys").alias("key"), F.col("cid").alias("unit"), F.lit(0.0).alias("radius"), *CODE)
    in_cells = members.filter(F.col("kind") != SINGLE).select("cid", "unit").join(classes.select("cid", "keys"), "cid")
    shown = in_cells.select("unit", F.explode("keys").alias("key")).distinct().join(cells.select("unit", "radius", *PLACE, *CODE), "unit")
    entries = singles.unionByName(shown.select(*singles.columns))
    pairs = cut(_candidates(entries, reach, bucket))

    units = (alone.select(F.col("cid").alias("unit"), *PLACE, F.col("embedding").cast("array<double>").alias("embedding"),
                          F.lit(0.0).alias("radius"), F.lit(SINGLE).alias("kind"), "weight")
             .unionByName(cells.select("unit", *PLACE, "embedding", "radius", "kind", "weight")))
    both = pairs.join(units.toDF("u", *PLACE, "a", "ra", "ka", "wa"), "u").join(units.toDF("v", *PLACE, "b", "rb", "kb", "wb"), ["v", *PLACE])
    judged = with_cosine(both, "a", "b").withColumn("angle", _angle(F.col("cosine")))
    spread = F.col("ra") + F.col("rb")
    loose = (F.col("ka") == LOOSE) | (F.col("kb") == LOOSE)
    simple = (F.col("ka") == SINGLE) & (F.col("kb") == SINGLE)
    verdict = (F.when(simple, F.when(F.col("cosine") >= threshold, "all").otherwise("none"))
               .when(F.col("angle") - spread > reach + MARGIN, "none")
               .when(~loose & (F.col("angle") + spread <= reach - MARGIN), "all").otherwise("partly"))
    judged = stored(judged.withColumn("verdict", verdict).filter("verdict != 'none'").select("u", "v", "wa", "wb", "verdict"))

    whole = judged.filter("verdict = 'all'")
    partial = judged.filter("verdict = 'partly'").select("u", "v").unionByName(
        cells.filter(F.col("kind") == LOOSE).select(F.col("unit").alias("u"), F.col("unit").alias("v")))
    compared = cut(_member_links(partial, members, classes, threshold, block))
    node = F.when(F.col("kind") == LOOSE, F.col("cid")).otherwise(F.col("unit"))
    nodes = members.select("cid", node.alias("node"))
    edges = (compared.filter("cid != other").select("cid", "other").join(nodes.toDF("cid", "a"), "cid")
             .join(nodes.toDF("other", "b"), "other").select(F.col("a").alias("u"), F.col("b").alias("v")))
    roots = components(whole.select("u", "v").unionByName(edges))

    by_unit = (whole.select(F.col("u").alias("unit"), F.col("wb").alias("w")).unionByName(whole.select(F.col("v").alias("unit"), F.col("wa").alias("w")))
               .groupBy("unit").agg(F.sum("w").alias("by_unit")))
    by_class = compared.groupBy("cid").agg(F.sum("links").alias("by_class"))
    inside = cells.filter(F.col("kind") == TIGHT).select("unit", F.col("weight").alias("inside"))
    zero = F.lit(0).cast("long")
    counted = members.join(by_unit, "unit", "left").join(inside, "unit", "left").join(by_class, "cid", "left").select(
        "cid", node.alias("node"), (F.coalesce("inside", F.col("weight")) - 1 + F.coalesce("by_unit", zero) + F.coalesce("by_class", zero)).alias("n_links"))
    rooted = counted.join(roots, "node", "left").select("cid", "n_links", F.coalesce("root", "node").alias("root")).join(
        classes.select("cid", "least"), "cid")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("cid", "n_links", "component_id")


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, *, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links (other rows linked directly), component_id (least vec_id reachable by links) and
    kept (it is the row's own) for every row of ``embeddings`` (vec_id, embedding, label)."""
    rows = embeddings.select("vec_id", "embedding", "label").withColumn("able", comparable(F.col("embedding"), F.col("label")))
    able = rows.filter("able")
    classes = stored(able.groupBy("label", "embedding").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
                     .select(F.monotonically_increasing_id().alias("cid"), "label", F.size("embedding").alias("width"), "embedding", "weight", "least"))
    linked = stored(class_links(classes, threshold, bucket=bucket, block=block))
    named = classes.select("cid", "label", "embedding").join(linked, "cid").drop("cid")
    found = able.join(named, ["label", "embedding"], "left").select("vec_id", "n_links", "component_id")
    rest = rows.filter(~F.col("able")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
