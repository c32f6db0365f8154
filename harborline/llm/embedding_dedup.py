"""Embedding near-dedup: cosine links inside labels, by sorted projection passes.

In each pass a vector's key is a row of ``HASHES`` random hashes, the signs of its products with random directions.
Vectors are range-sorted by (label, key), near ones agree in their leading signs and stand near each other, and each is
compared in double precision with the next ``WINDOW`` in the order. Verified pairs are united across passes.

The number of passes follows the data. From the keys of the first passes it is read how many signs two neighbours must share
to meet in one window, hence how likely a pass shows a pair just at the threshold: crowded labels ask for many passes, spread
ones for a few. A label goes on with new directions until the expected share of pairs missed is at most
``MISSED`` and the last round united nothing new. Links are then counted inside the components, where every
pair that can be near is compared, so counts are whole there. Links never found are ones that joined two components in no
pass (measured recall: README). ``exact`` takes every label as one component to be searched: links and
components are then whole for certain, at a cost that grows faster than the label.

Inside a component (or label) a few vectors, chosen by hash, are pivots. Every vector lives in the cell of its nearest
pivot and visits the later cells that can hold a vector near enough, by a bound that never errs. A cell's vectors are
compared with each other and with its visitors in blocks of bounded size, so that each pair that can be linked is
compared once.

Vectors are compared when their labels are equal and not null and their lengths are equal. A vector that is
null, empty or zero, or holds null, NaN or infinite components, links with nothing and keeps itself. Equal
vectors of a label fall together first and count as links of one another. Equal rows and rows that share an
id count each; a null id never names a component that has another id, and is not kept. Extra columns
aren't read. Of the links, each task passes on only those that connect something new, and counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import components, cut

HASHES = 64  # signs in a key
NEXT = 512  # vectors of the order that each is compared with
PASSES = 4  # in the first round; later ones double up to four times as many
MISSED = 0.002  # share of pairs at the threshold that a label's passes may be expected to miss
COUNTS = (4, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512)  # numbers of passes to choose the least from
UNKNOWN = 32  # passes where the keys don't tell
SORTED_ROWS = 1 << 16  # aimed at in a sorted partition
CELL = 1024  # vectors of a component to one pivot
PIVOTS, PIVOT_BYTES = 1 << 11, 64 << 20  # in all at most, as every worker holds them; cells grow beyond
BLOCK = 1024  # vectors of a cell that one task compares with as many
WINDOW = 256  # of them at a time


def _unit(vectors: np.ndarray) -> np.ndarray:
    x = np.asarray(vectors, dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _pivots(nodes: DataFrame, count: int, seed: int) -> dict[tuple, np.ndarray]:
    """Unit vectors of a few nodes by (label, size), chosen by hash: about one in CELL, PIVOTS and PIVOT_BYTES in all at most."""
    width = nodes.agg(F.max("size")).first()[0] or 1
    most = max(1, min(PIVOTS, PIVOT_BYTES // (8 * width)))
    share = min(1 / CELL, most / 2 / max(1, count))
    chosen = nodes.where(F.pmod(F.xxhash64(F.lit(seed), "node"), F.lit(1 << 30)) < int(share * (1 << 30)))
    found: dict[tuple, list] = {}
    for r in chosen.select("node", "label", "size", "v").orderBy("node").limit(most).collect():
        found.setdefault((r.label, r.size), []).append(r.v)
    return {k: _unit(np.array(v, dtype=np.float64)) for k, v in found.items()}


def _placed(nodes: DataFrame, pivots: dict[tuple, np.ndarray], threshold: float) -> DataFrame:
    """``nodes`` with ``home``, the cell of the nearest pivot, and ``visits``, the later cells that can hold a near vector.

    A vector x of cell a is (x.a - x.b) / |a - b| away from every vector of cell b at least, as the plane halfway
    between a and b lies between them, and near vectors are sqrt(2 - 2 threshold) apart at most.
    """
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    shared = nodes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        apart: dict[tuple, np.ndarray] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, 1_000):
                batch = whole.slice(start, 1_000)
                homes, visits = np.zeros(batch.num_rows, dtype=np.int32), [[] for _ in range(batch.num_rows)]
                rows: dict[tuple, list[int]] = {}
                for k, key in enumerate(zip(batch.column("label").to_pylist(), batch.column("size").to_pylist())):
                    if key in known:
                        rows.setdefault(key, []).append(k)
                for key, at in rows.items():
                    p = known[key]
                    if key not in apart:  # never less than the true distance, whatever is rounded
                        apart[key] = np.sqrt(np.maximum(0, 2 - 2 * (p @ p.T)) + 1e-12)
                    near = _unit(_matrix(batch.column("v").take(pa.array(at)), key[1])) @ p.T
                    home = near.argmax(axis=1)
                    open_to = near.max(axis=1)[:, None] - near <= reach * apart[key][home] + 1e-9
                    for k, h, o in zip(at, home.tolist(), open_to):
                        homes[k], visits[k] = h, (np.flatnonzero(o[h + 1 :]) + h + 1).tolist()
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in names), pa.array(homes), pa.array(visits, pa.list_(pa.int32()))], [*names, "home", "visits"]
                )

    names = ("node", "label", "size", "copies", "v")
    label, kind = (nodes.schema[c].dataType.simpleString() for c in ("label", "v"))
    return nodes.select(*names).mapInArrow(run, f"node string, label {label}, size int, copies long, v {kind}, home int, visits array<int>")


def _dealt(placed: DataFrame) -> DataFrame:
    """Every vector once for each pair of blocks it is compared in: (task, side, node, copies, v).

    Homes of a cell are compared with each other and with its visitors, in blocks, so that every pair of vectors
    that can be near meets once.
    """
    cell = F.explode(F.concat(F.array(F.struct(F.col("home").alias("cell"), F.lit(True).alias("own"))), F.transform("visits", lambda k: F.struct(k.alias("cell"), F.lit(False).alias("own")))))
    where = ("label", "size", "cell")
    blocks = lambda own: F.ceil(F.count_if(F.col("c.own") == own) / BLOCK).cast("int")
    sizes = placed.select("label", "size", cell.alias("c")).groupBy("label", "size", F.col("c.cell").alias("cell"))
    sizes = sizes.agg(blocks(F.lit(True)).alias("homes"), blocks(F.lit(False)).alias("guests"))
    rows = placed.select("label", "size", "node", "copies", "v", cell.alias("c")).select("label", "size", "c.*", "node", "copies", "v")
    rows = rows.join(sizes, [*where])
    homes, guests, own = F.col("homes"), F.col("guests"), F.col("own")
    block = F.pmod(F.xxhash64("node"), F.when(own, homes).otherwise(guests)).cast("int")
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    pair = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    among = F.transform(upto(homes), lambda k: F.when(k < block, pair(k, block, 1)).otherwise(pair(block, k, 0)))
    hosted = F.transform(upto(guests), lambda k: pair(block, homes + k, 0))
    hosting = F.transform(upto(homes), lambda k: pair(k, homes + block, 1))
    rows = rows.withColumn("c", F.explode(F.when(own, F.concat(among, hosted)).otherwise(hosting)))
    task = F.concat_ws("|", "cell", "c.i", "c.j", "size", F.col("label").cast("string"))
    return rows.select(task.alias("task"), (F.col("c.i") == F.col("c.j")).alias("same"), "c.side", "size", "node", "copies", "v")


def _forest(near: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Pairs (row, column) of ``near`` that connect what it connects; ``same``: rows and columns are the same vectors."""
    back = near if same else np.ascontiguousarray(near.T)
    new_rows = near.any(axis=1)
    new_cols = new_rows if same else near.any(axis=0)
    found = []
    for first in np.flatnonzero(new_rows).tolist():
        if not new_rows[first]:
            continue
        new_rows[first] = False
        todo = [(first, True)]
        while todo:
            k, is_row = todo.pop()
            fresh = new_cols if is_row else new_rows
            hit = np.flatnonzero((near if is_row else back)[k] & fresh).tolist()
            fresh[hit] = False
            found += [(k, h) if is_row else (h, k) for h in hit]
            todo += [(h, same or not is_row) for h in hit]
    return found


def _joins(a: str, b: str, joined: dict[str, str]) -> bool:
    """Unite ``a`` and ``b`` in ``joined``; false if they were united already."""
    ends = []
    for x in (a, b):
        while joined.setdefault(x, x) != x:
            joined[x] = joined[joined[x]]
            x = joined[x]
        ends.append(x)
    joined[max(ends)] = min(ends)
    return ends[0] != ends[1]


def _keyed(nodes: DataFrame, first: int, passes: int, seed: int) -> DataFrame:
    """``nodes`` once per pass with the pass's sort key; labels that one window holds come in one pass only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, 2_000):
                batch = whole.slice(start, 2_000)
                sizes = batch.column("size").to_numpy()
                for size in np.unique(sizes).tolist():
                    part = batch.filter(pa.array(sizes == size))
                    if size not in directions:
                        made = [np.random.default_rng([seed, size, first + k]).standard_normal((size, HASHES)) for k in range(passes)]
                        directions[size] = np.concatenate(made, axis=1)
                    signs = _unit(_matrix(part.column("v"), size)) @ directions[size] > 0
                    many = part.column("m").to_numpy() > NEXT + 1
                    for k in range(passes):
                        use = many if first + k else np.ones(part.num_rows, dtype=bool)
                        keys = np.packbits(signs[use, k * HASHES : (k + 1) * HASHES], axis=1)
                        taken = part.filter(pa.array(use))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(taken.num_rows, first + k, dtype=np.int32)), taken.column("label"), taken.column("size"), pa.array([r.tobytes() for r in keys], pa.binary()), taken.column("node"), taken.column("v")],
                            ["pass", "label", "size", "key", "node", "v"],
                        )

    label, kind = (nodes.schema[c].dataType.simpleString() for c in ("label", "v"))
    return nodes.select("node", "label", "size", "m", "v").mapInArrow(run, f"pass int, label {label}, size int, key binary, node string, v {kind}")


def _runs(rows: pa.Table) -> Iterator[tuple[pa.Table, int]]:
    """Stretches of sorted rows that have one pass, label and vector length, and that length."""
    marks = list(zip(*(rows.column(c).to_pylist() for c in ("pass", "label", "size"))))
    start = 0
    for stop in range(1, len(marks) + 1):
        if stop == len(marks) or marks[stop] != marks[start]:
            yield rows.slice(start, stop - start), marks[start][2]
            start = stop


def _near_pairs(rows: pa.Table, threshold: float, joined: dict[str, str]) -> list[tuple[str, str]]:
    """Pairs of sorted rows at most NEXT apart that connect what is linked and not yet in ``joined``."""
    found = []
    for run, size in _runs(rows):
        x, names = _unit(_matrix(run.column("v").combine_chunks(), size)), run.column("node").to_pylist()
        for i in range(0, len(x), NEXT):
            a, b = x[i : i + NEXT], x[i : i + 2 * NEXT]
            ahead = np.arange(len(b))[None, :] - np.arange(len(a))[:, None]
            near = (a @ b.T >= threshold) & (ahead >= 1) & (ahead <= NEXT)
            pairs = [(names[i + r], names[i + c]) for r, c in _forest(near, False)] if near.any() else []
            found += [p for p in pairs if _joins(*p, joined)]
    return found


def _shared_signs(rows: pa.Table) -> list[tuple]:
    """(label, size, leading signs shared by two rows NEXT apart in one run, number of such rows)."""
    found = []
    for run, size in _runs(rows):
        if run.num_rows > NEXT:
            keys = np.frombuffer(b"".join(run.column("key").to_pylist()), dtype=">u8").astype(np.uint64)
            differ = np.unpackbits((keys[:-NEXT] ^ keys[NEXT:]).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            same = np.where(differ.any(axis=1), differ.argmax(axis=1), HASHES)
            label = run.column("label")[0].as_py()
            found += [(label, size, int(k), int(n)) for k, n in zip(*np.unique(same, return_counts=True))]
    return found


def _round(nodes: DataFrame, first: int, passes: int, threshold: float, seed: int, count: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) that the windows of some passes link, and signs shared at their ends (label, size, signs, rows)."""
    order = ("pass", "label", "size", "key", "node")
    dealt = _keyed(nodes, first, passes, seed).repartitionByRange(max(1, count * passes // SORTED_ROWS), *order).sortWithinPartitions(*order)
    label, kind = (nodes.schema[c].dataType.simpleString() for c in ("label", "v"))

    def emit(arrow: dict[str, pa.DataType], n: int, columns: dict) -> pa.RecordBatch:
        arrays = [columns[c] if columns.get(c) is not None else pa.nulls(n, k) for c, k in arrow.items()]
        return pa.RecordBatch.from_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in arrays], list(arrow))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs inside a partition, and its first and last rows for the pairs across its ends."""
        at, joined = TaskContext.get().partitionId(), {}
        head = tail = arrow = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if arrow is None:
                kinds = {f.name: f.type for f in batch.schema}
                arrow = {"a": pa.string(), "b": pa.string(), "boundary": pa.int32(), "pos": pa.int32(), "signs": pa.int32(), "rows": pa.int64(), **kinds}
            if head is None or head.num_rows < NEXT:
                more = rows.slice(0, NEXT - (head.num_rows if head is not None else 0))
                head = more if head is None else pa.concat_tables([head, more])
            rows = rows if tail is None else pa.concat_tables([tail, rows])
            pairs = _near_pairs(rows, threshold, joined)
            yield emit(arrow, len(pairs), {"a": pa.array([p[0] for p in pairs], pa.string()), "b": pa.array([p[1] for p in pairs], pa.string())})
            signs = _shared_signs(rows)
            cells = {c: pa.array([r[k] for r in signs], arrow[c]) for k, c in enumerate(("label", "size", "signs", "rows"))}
            yield emit(arrow, len(signs), cells)
            tail = rows.slice(max(0, rows.num_rows - NEXT))
        if head is not None:
            for rows, boundary, offset in ((head, at - 1, NEXT), (tail, at, NEXT - tail.num_rows)):
                n = rows.num_rows
                place = {"boundary": pa.array([boundary] * n, pa.int32()), "pos": pa.array(range(offset, offset + n), pa.int32())}
                yield emit(arrow, n, {**place, **{c: rows.column(c) for c in rows.column_names}})

    made = cut(dealt.mapInArrow(run, f"a string, b string, boundary int, pos int, signs int, rows long, pass int, label {label}, size int, key binary, node string, v {kind}"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def pairs() -> pa.RecordBatch:
            found = _near_pairs(pa.Table.from_batches(held), threshold, {})
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.string()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            marks = batch.column("boundary").to_numpy()
            bounds = [0, *(np.flatnonzero(marks[1:] != marks[:-1]) + 1).tolist(), len(marks)]
            for start, stop in zip(bounds, bounds[1:]):
                if start == stop:
                    continue
                if held and marks[start] != at:
                    yield pairs()
                    held = []
                at = marks[start]
                held.append(batch.slice(start, stop - start))
        if held:
            yield pairs()

    across = made.where("boundary is not null").select("boundary", "pos", "pass", "label", "size", "node", "v")
    across = across.repartition("boundary").sortWithinPartitions("boundary", "pos").mapInArrow(ends, "a string, b string")
    pairs = cut(made.where("a is not null").select("a", "b").unionByName(across).distinct())
    return pairs, made.where("signs is not null").select("label", "size", "signs", "rows")


def _united(nodes: DataFrame, threshold: float, seed: int) -> DataFrame:
    """(id, component) of the vectors that the passes link with another one."""
    labels = cut(nodes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("m")))
    agree = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi  # odds that a sign is shared at the threshold
    known = active = None
    done, passes = 0, PASSES
    while True:
        use = labels if active is None else labels.join(active, ["label", "size"])
        rows = nodes.join(use.select("label", "size", "m"), ["label", "size"])
        count = use.agg(F.sum("m")).first()[0]
        if not count:
            break
        pairs, signs = _round(rows, done, passes, threshold, seed, count)
        if not done:
            missed = lambda n: F.sum(F.col("rows") * F.pow(1 - F.pow(F.lit(agree), F.col("signs") + 1), F.lit(float(n))))
            share = signs.groupBy("label", "size").agg(*[missed(n).alias(f"n{n}") for n in COUNTS])
            least = F.coalesce(*[F.when(F.col(f"n{n}") <= MISSED * passes * F.col("m"), F.lit(n)) for n in COUNTS], F.lit(COUNTS[-1]))
            # partitions of fewer rows than a window show no share
            wanted = F.when(F.col(f"n{COUNTS[0]}").isNull(), F.lit(UNKNOWN)).otherwise(least)
            wanted = cut(labels.where(F.col("m") > NEXT + 1).join(share, ["label", "size"], "left").select("label", "size", wanted.alias("wanted")))
        done += passes
        if known is None:
            fresh = pairs
        else:
            end = lambda x: known.select(F.col("id").alias(x), F.col("component").alias(f"_{x}"))
            ends = pairs.join(end("a"), "a", "left").join(end("b"), "b", "left")
            fresh = cut(ends.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b"))
        if not fresh.isEmpty():
            edges = fresh if known is None else fresh.unionByName(known.select(F.col("id").alias("a"), F.col("component").alias("b")))
            known = cut(components(edges))
        gained = fresh.join(nodes.select(F.col("node").alias("a"), "label", "size"), "a").select("label", "size")
        # one window holds a small label whole, so a pass was enough
        more = gained.join(wanted.select("label", "size"), ["label", "size"]).unionByName(wanted.where(F.col("wanted") > done).select("label", "size"))
        active = cut(more.distinct())
        if active.isEmpty():
            break
        passes = min(2 * passes, 4 * PASSES)
    return known if known is not None else nodes.select(F.col("node").alias("id"), F.col("node").alias("component")).limit(0)


def _compared(nodes: DataFrame, threshold: float, seed: int, count: int) -> DataFrame:
    """Exact links: rows (node, links) whose sum by node is whole, and rows (a, b) that connect what is linked."""
    dealt = _dealt(cut(_placed(nodes, _pivots(nodes, count, seed), threshold)))
    dealt = dealt.repartition("task").sortWithinPartitions("task", "side")

    def linked(parts: list[pa.RecordBatch], joined: dict[str, str]) -> pa.RecordBatch | None:
        size, same = parts[0].column("size")[0].as_py(), parts[0].column("same")[0].as_py()
        side = np.concatenate([p.column("side").to_numpy() for p in parts])
        n = int((side == 0).sum())
        copies = np.concatenate([p.column("copies").to_numpy() for p in parts])
        x = _unit(np.concatenate([_matrix(p.column("v"), size) for p in parts]))
        names = [name for p in parts for name in p.column("node").to_pylist()]
        right = slice(0, n) if same else slice(n, None)
        y, theirs = x[right], names[right]
        if not n or not len(y):
            return None
        near = np.concatenate([x[k : min(n, k + WINDOW)] @ y.T >= threshold for k in range(0, n, WINDOW)])
        if same:
            near &= ~np.eye(n, dtype=bool)
            near |= near.T  # rounding may differ between the two sides
        sums = [(name, int(v)) for name, v in zip(names, (near @ copies[right]).tolist()) if v]
        if not same:
            sums += [(name, int(v)) for name, v in zip(theirs, (near.T @ copies[:n]).tolist()) if v]
        pairs = [(names[i], theirs[j]) for i, j in _forest(near, same)]
        pairs = [p for p in pairs if _joins(*p, joined)]
        columns = zip(*[(s[0], s[1], None, None) for s in sums], *[(None, None, *p) for p in pairs]) if sums else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string()))], ["node", "links", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined: dict[str, str] = {}
        held: list[pa.RecordBatch] = []
        at = None
        for batch in batches:
            tasks = np.array(batch.column("task").to_pylist(), dtype=object)
            bounds = [0, *(np.flatnonzero(tasks[1:] != tasks[:-1]) + 1).tolist(), len(tasks)]
            for start, stop in zip(bounds, bounds[1:]):
                if start == stop:
                    continue
                if tasks[start] != at and held:
                    if (out := linked(held, joined)) is not None:
                        yield out
                    held = []
                at = tasks[start]
                held.append(batch.slice(start, stop - start))
        if held and (out := linked(held, joined)) is not None:
            yield out

    return dealt.mapInArrow(run, "node string, links long, a string, b string")


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = 0.98,
    seed: int = 7,
    exact: bool = False,
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links`` (vectors linked directly), ``component_id`` (smallest id reachable), ``kept``."""
    # a float's double is itself, so it may travel as the float
    kind = "array<float>" if vectors.schema[embedding].dataType.simpleString() == "array<float>" else "array<double>"
    usable = (
        F.col("label").isNotNull()
        & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast(kind).alias("v"))
    name = F.concat(F.hex(F.xxhash64("label", "v")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), "v", "label")))
    rows = rows.withColumn("node", F.when(F.coalesce(usable, F.lit(False)), name))
    nodes = cut(
        rows.where("node is not null")
        .groupBy("node")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("v").alias("v"))
        .withColumn("size", F.size("v"))
    )
    if exact:
        made = cut(_compared(nodes, threshold, seed, nodes.count()))
        joined = components(made.where("a is not null").select("a", "b")).withColumnRenamed("id", "node")
    else:
        joined = _united(nodes, threshold, seed).withColumnRenamed("id", "node")
        inside = cut(nodes.drop("label").join(joined, "node").withColumnRenamed("component", "label"))
        made = cut(_compared(inside, threshold, seed, inside.count()))
    counts = made.where("node is not null").groupBy("node").agg(F.sum("links").alias("links"))
    members = cut(nodes.select("node", "least").join(joined, "node").select("component", "node", "least"))
    smallest = members.groupBy("component").agg(F.min("least").alias("smallest"))
    known = members.join(smallest, "component").select("node", "smallest").join(counts, "node", "left")
    named = nodes.select("node", "copies", "least").join(known, "node", "left").select(
        "node",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("smallest", "least").alias("component_id"),
    )
    out = rows.select("vec_id", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
