"""Vector codes from codebooks per part, learned and assigned through trees of balls.

The components of a vector become whole numbers, floor(``scale`` * x), and the vector is cut into
``parts`` equal parts. Each part position has a codebook; a code names the nearest entry of each.
Codebooks start as the parts of the ``entries`` rows of smallest id. Each of ``rounds`` rounds assigns
all parts and replaces each entry by the floor of its parts' mean; entries without parts stay.

Assignment goes through an anchors hierarchy, built once. ``chunk`` vectors make a tree per part,
middle-out: about sqrt(n) anchors are set up, each next one at the point farthest from its anchor,
which takes over the points nearer to it (points less than half as far from their anchor as the two
anchors are apart need no look); neighbouring balls are merged upwards, and each anchor's points are
treated alike downwards, to balls of a few points or of equal ones. Every ball keeps centre, radius,
count and sum. A round walks the trees from the top with the list of entries that can be nearest: an
entry leaves it if the ball lies on the far side of the plane between it and the entry nearest to the
centre, and what is inside inherits the list. A ball with one entry left is wholly owned; its count
and sum go to the entry without a look at its points. Only points of small balls that several entries
can own are compared one by one, in whole numbers. So the result is that of comparing all with all.

A task holds one chunk at a time, sums reach the driver as a row per entry and component (``entries``
times the vector's length), and so do the codebooks that go back. Trees are kept in the shared folder.

Defined cases: rows whose vector is null or has a null, NaN or infinite component are dropped, as are
those with another number of components than the kept row of smallest id. That number must be a
multiple of ``parts`` and components at most 2^26 in units of 1 / ``scale``, otherwise an error is
raised. Rows without id come last in the order of ids, rows of the same id are in the order of their
components. With fewer rows than entries the codebooks are as short. Equal parts get the same entry,
ties go to the lower one. Other columns may have any name. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botiquin.llm.tables import stored

MOST = 1 << 26


@dataclass(frozen=True)
class Coding:
    """Scale, parts, entries of a codebook, rounds, vectors of a tree, points of a ball not cut."""

    scale: int = 1024
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    chunk: int = 1024
    leaf: int = 32


@dataclass
class Tree:
    """Balls over points in ``order``; ball i holds those from ``first`` to ``last``, 0 is the root.

    ``left`` and ``right`` are its halves, -1 where it is not cut.
    """

    order: np.ndarray
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray
    right: np.ndarray
    radius: np.ndarray
    sums: np.ndarray


def _anchors(points: np.ndarray, wanted: int) -> list[np.ndarray]:
    """The points of up to ``wanted`` anchors, as places; fewer if some anchors' points are all equal."""
    pivots = [points[0]]
    owned = [np.arange(len(points))]
    far = [np.sqrt(((points - points[0]) ** 2).sum(axis=1))]
    while len(pivots) < wanted:
        widest = max(range(len(pivots)), key=lambda a: far[a].max())
        if far[widest].max() == 0:
            break
        pivot = points[owned[widest][far[widest].argmax()]]
        mine, my_far = [], []
        for a, other in enumerate(pivots):
            between = np.sqrt(((pivot - other) ** 2).sum())
            look = np.flatnonzero(far[a] >= between / 2)
            if not len(look):
                continue
            distance = np.sqrt(((points[owned[a][look]] - pivot) ** 2).sum(axis=1))
            nearer = distance < far[a][look]
            if nearer.any():
                mine.append(owned[a][look[nearer]])
                my_far.append(distance[nearer])
                stay = np.ones(len(owned[a]), dtype=bool)
                stay[look[nearer]] = False
                owned[a], far[a] = owned[a][stay], far[a][stay]
        pivots.append(pivot)
        owned.append(np.concatenate(mine))
        far.append(np.concatenate(my_far))
    return owned


def _hierarchy(points: np.ndarray, places: np.ndarray, leaf: int):
    """A nested pair of balls over the places, or the places themselves where they are not cut."""
    if len(places) <= leaf:
        return places
    groups = _anchors(points[places], int(np.ceil(np.sqrt(len(places)))))
    if len(groups) == 1:
        return places
    balls = [_hierarchy(points, places[group], leaf) for group in groups]
    centres = np.stack([points[places[group]].mean(axis=0) for group in groups])
    counts = np.array([len(group) for group in groups], dtype=np.float64)
    radii = np.array([
        np.sqrt(((points[places[group]] - centre) ** 2).sum(axis=1).max())
        for group, centre in zip(groups, centres)
    ])

    def joint(a: int) -> tuple[np.ndarray, np.ndarray]:
        """Centres and radii of the balls around ball ``a`` and each other one."""
        share = (counts[a] / (counts[a] + counts))[:, None]
        middle = share * centres[a] + (1 - share) * centres
        apart = np.sqrt(((centres - centres[a]) ** 2).sum(axis=1))
        reach = np.maximum(radii[a] + (1 - share[:, 0]) * apart, radii + share[:, 0] * apart)
        return middle, reach

    alive = np.ones(len(balls), dtype=bool)
    cost = np.stack([joint(a)[1] for a in range(len(balls))])
    np.fill_diagonal(cost, np.inf)
    for _ in range(len(balls) - 1):
        a, b = divmod(int(cost.argmin()), len(balls))
        middle, reach = joint(a)
        balls[a] = (balls[a], balls[b])
        centres[a], radii[a], counts[a] = middle[b], reach[b], counts[a] + counts[b]
        alive[b] = False
        cost[b], cost[:, b] = np.inf, np.inf
        cost[a] = np.where(alive, joint(a)[1], np.inf)
        cost[a, a] = np.inf
        cost[:, a] = cost[a]
    return balls[int(np.flatnonzero(alive)[0])]


def build(points: np.ndarray, leaf: int) -> Tree:
    """The tree over whole-number points."""
    nested = _hierarchy(points.astype(np.float64), np.arange(len(points)), leaf)
    order, rows = [], []
    # Balls in the order in which their points are laid down; a ball is numbered before its halves.
    todo = [(nested, None)]
    held = 0
    while todo:
        ball, above = todo.pop()
        if above is not None and above[0] == "close":
            rows[above[1]][1] = held
            continue
        number = len(rows)
        rows.append([held, held, -1, -1])
        if above is not None:
            rows[above[1]][above[0]] = number
        if isinstance(ball, tuple):
            todo.append((None, ("close", number)))
            todo.append((ball[1], (3, number)))
            todo.append((ball[0], (2, number)))
        else:
            order.append(ball)
            held += len(ball)
            rows[number][1] = held
    order = np.concatenate(order) if order else np.empty(0, dtype=np.int64)
    first, last, left, right = np.array(rows, dtype=np.int64).T
    ordered = points[order]
    before = np.concatenate([np.zeros((1, points.shape[1]), dtype=np.int64), np.cumsum(ordered, axis=0)])
    sums = before[last] - before[first]
    centres = sums / np.maximum(last - first, 1)[:, None]
    radius = np.array([
        np.sqrt(((ordered[a:b] - centre) ** 2).sum(axis=1).max()) if b > a else 0.0
        for a, b, centre in zip(first, last, centres)
    ])
    return Tree(order, first, last, left, right, radius, sums)


def distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances in whole numbers.

    The product runs in double precision where every sum it forms is a whole number below 2^53.
    """
    largest = max(1, int(np.abs(points).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.float64 if 4 * largest * largest * max(1, points.shape[1]) < 1 << 53 else np.int64
    cross = (points.astype(kind) @ book.T.astype(kind)).astype(np.int64)
    return (points**2).sum(axis=1)[:, None] - 2 * cross + (book**2).sum(axis=1)


class Walk:
    """Assigns the points of trees to the entries of a codebook."""

    def __init__(self, book: np.ndarray):
        self.book = book
        self.squares = (book.astype(np.float64) ** 2).sum(axis=1)
        self.apart = np.sqrt(np.maximum(distances(book, book), 0).astype(np.float64))
        # Of equal entries only the lowest can be nearest.
        _, lowest = np.unique(book, axis=0, return_index=True)
        self.start = np.zeros(len(book), dtype=bool)
        self.start[lowest] = True

    def run(self, tree: Tree, points: np.ndarray):
        """Wholly owned balls with their entries, and single points (in the tree's order) with theirs."""
        balls, lists = np.zeros(1, dtype=np.int64), self.start[None, :]
        owned, owners, singles, single_lists = [], [], [], []
        while len(balls):
            count = (tree.last - tree.first)[balls]
            centres = tree.sums[balls] / np.maximum(count, 1)[:, None]
            far = (centres**2).sum(axis=1)[:, None] - 2 * centres @ self.book.T + self.squares
            slack = 1e-9 * (1.0 + np.abs(far).max(axis=1, keepdims=True) + self.squares.max())
            nearest = np.where(lists, far, np.inf).argmin(axis=1)
            behind = far - np.take_along_axis(far, nearest[:, None], axis=1)
            lists = lists & ~(behind > 2 * tree.radius[balls][:, None] * self.apart[nearest] * (1 + 1e-9) + slack)
            whole = lists.sum(axis=1) == 1
            owned.append(balls[whole])
            owners.append(nearest[whole])
            end = ~whole & (tree.left[balls] < 0)
            sizes = count[end]
            begin = np.repeat(tree.first[balls[end]] - np.cumsum(sizes) + sizes, sizes)
            singles.append(begin + np.arange(sizes.sum()))
            single_lists.append(np.repeat(lists[end], sizes, axis=0))
            inner = ~whole & ~end
            balls = np.concatenate([tree.left[balls[inner]], tree.right[balls[inner]]])
            lists = np.concatenate([lists[inner], lists[inner]])
        singles = np.concatenate(singles)
        far = distances(points[singles], self.book)
        far[~np.concatenate(single_lists)] = np.iinfo(np.int64).max
        return np.concatenate(owned), np.concatenate(owners), singles, far.argmin(axis=1)


_NODES = ("first", "last", "left", "right")
_TREES = "ids array<long>, labels array<{label}>, points array<int>, placed array<int>, balls array<int>, " \
         "first array<int>, last array<int>, left array<int>, right array<int>, radius array<double>, sums array<long>"


def usable(rows: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label and vector (whole numbers) of the rows without null or endless components."""
    vector = F.col(vector_col).cast("array<double>")
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # What lies beyond the bound stays beyond it, so that it is noticed later.
    bounded = F.transform(
        "vector",
        lambda x: F.floor(F.greatest(F.lit(-MOST - 1.0), F.least(F.lit(MOST + 1.0), x * float(scale)))).cast("int"),
    )
    return (
        rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), vector.alias("vector"))
        .where(F.col("vector").isNotNull() & ~odd)
        .select("id", "label", bounded.alias("vector"))
    )


def plant(kept: DataFrame, dims: int, coding: Coding) -> DataFrame:
    """Chunks of rows, each with a tree per part, laid out as lists one part after the other."""
    label = kept.schema["label"].dataType
    width = dims // coding.parts
    schema = _TREES.format(label=label.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, coding.chunk):
                yield _planted(batch.slice(start, coding.chunk), dims, width, coding)

    return kept.mapInArrow(run, schema)


def _planted(batch: pa.RecordBatch, dims: int, width: int, coding: Coding) -> pa.RecordBatch:
    vectors = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, dims).astype(np.int64)
    if np.abs(vectors).max(initial=0) > MOST:
        raise ValueError(f"components beyond {MOST} units: errors would not fit 64 bits")
    lists: dict[str, list[np.ndarray]] = {}
    for part in range(coding.parts):
        points = vectors[:, part * width : (part + 1) * width]
        tree = build(points, coding.leaf)
        laid = {name: getattr(tree, name) for name in (*_NODES, "radius")} | {
            "points": points[tree.order].reshape(-1), "placed": tree.order,
            "balls": np.array([len(tree.first)]), "sums": tree.sums.reshape(-1),
        }
        for name, values in laid.items():
            lists.setdefault(name, []).append(values)
    arrays, names = [], []
    for name in ("ids", "labels", "points", "placed", "balls", *_NODES, "radius", "sums"):
        if name in ("ids", "labels"):
            values = batch.column(name[:-1])
        else:
            kind = {"radius": pa.float64(), "sums": pa.int64()}.get(name, pa.int32())
            values = pa.array(np.concatenate(lists[name])).cast(kind)
        arrays.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
        names.append(name)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _forest(batch: pa.RecordBatch, width: int, parts: int) -> Iterator[tuple[int, list[tuple[Tree, np.ndarray]]]]:
    """Per row its number and the trees of its parts with their points."""
    for row in range(batch.num_rows):
        lists = {
            name: batch.column(name)[row].values.to_numpy()
            for name in ("points", "placed", "balls", *_NODES, "radius", "sums")
        }
        count = len(lists["placed"]) // parts
        ends = np.cumsum([0, *lists["balls"]]).tolist()
        forest = []
        for part, (a, b) in enumerate(zip(ends, ends[1:])):
            points = lists["points"].reshape(parts, count, width)[part].astype(np.int64)
            nodes = [lists[name][a:b].astype(np.int64) for name in _NODES]
            sums = lists["sums"].reshape(-1, width)[a:b] if width else np.zeros((b - a, 0), dtype=np.int64)
            order = lists["placed"].reshape(parts, count)[part]
            forest.append((Tree(order, *nodes, lists["radius"][a:b], sums), points))
        yield row, forest


def entry_sums(trees: DataFrame, books: np.ndarray, parts: int) -> DataFrame:
    """part, entry, place, total and number of the parts assigned to each entry."""
    entries, width = books.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = [Walk(book) for book in books]
        total = np.zeros((parts, entries, width), dtype=np.int64)
        number = np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            for _, forest in _forest(batch, width, parts):
                for part, (tree, points) in enumerate(forest):
                    balls, owners, singles, nearest = walks[part].run(tree, points)
                    np.add.at(total[part], owners, tree.sums[balls])
                    np.add.at(number[part], owners, (tree.last - tree.first)[balls])
                    np.add.at(total[part], nearest, points[singles])
                    np.add.at(number[part], nearest, 1)
        part, entry = np.nonzero(number)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(part, width).astype(np.int32)), pa.array(np.repeat(entry, width).astype(np.int32)),
                pa.array(np.tile(np.arange(width, dtype=np.int32), len(part))),
                pa.array(total[part, entry].reshape(-1)), pa.array(np.repeat(number[part, entry], width)),
            ],
            names=["part", "entry", "place", "total", "number"],
        )

    sums = trees.drop("ids", "labels").mapInArrow(
        run, "part int, entry int, place int, total long, number long"
    )
    return sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("number").alias("number"))


def code_rows(trees: DataFrame, books: np.ndarray, parts: int) -> DataFrame:
    """id, label, code and error of every row."""
    width = books.shape[2]
    label = trees.schema["labels"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = [Walk(book) for book in books]
        for batch in batches:
            for row, forest in _forest(batch, width, parts):
                codes = np.zeros((len(forest[0][1]), parts), dtype=np.uint8)
                error = np.zeros(len(codes), dtype=np.int64)
                for part, (tree, points) in enumerate(forest):
                    balls, owners, singles, nearest = walks[part].run(tree, points)
                    entry = np.zeros(len(points), dtype=np.int64)
                    for ball, owner in zip(balls, owners):
                        entry[tree.first[ball] : tree.last[ball]] = owner
                    entry[singles] = nearest
                    codes[tree.order, part] = entry
                    error[tree.order] += ((points - books[part][entry]) ** 2).sum(axis=1)
                ids, labels = (batch.column(name)[row].values for name in ("ids", "labels"))
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array([bytes(code).hex() for code in codes], pa.string()), pa.array(error)],
                    names=["id", "label", "code", "error"],
                )

    return trees.mapInArrow(run, f"id long, label {label}, code string, error long")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def codes(
    rows: DataFrame,
    coding: Coding = Coding(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """id, label, code, error and label_error of the kept rows; and the codebooks (part, entry, place)."""
    if coding.entries > 256:
        raise ValueError("two hex digits name 256 entries")
    kept = usable(rows, coding.scale, id_col, vector_col, label_col)
    # Bounded by the entries of a codebook.
    ordered = kept.orderBy(F.col("id").asc_nulls_last(), F.size("vector"), "vector")
    head = ordered.select("vector").limit(1).collect()
    dims = len(head[0]["vector"]) if head else 0
    if dims % coding.parts:
        raise ValueError(f"{dims} components do not make {coding.parts} equal parts")
    kept = kept.where(F.size("vector") == dims)
    first = ordered.where(F.size("vector") == dims).select("vector").limit(coding.entries).collect()
    start = np.array([row["vector"] for row in first], dtype=np.int64).reshape(len(first), dims)
    if np.abs(start).max(initial=0) > MOST:
        raise ValueError(f"components beyond {MOST} units: errors would not fit 64 bits")
    books = start.reshape(len(first), coding.parts, dims // coding.parts).transpose(1, 0, 2).copy()
    trees = stored(plant(kept, dims, coding), "ball-trees")
    for _ in range(coding.rounds if len(first) and dims else 0):
        sums = entry_sums(trees, books, coding.parts).toPandas()
        at = tuple(sums[name].to_numpy() for name in ("part", "entry", "place"))
        books[at] = sums["total"].to_numpy() // sums["number"].to_numpy()
    coded = stored(code_rows(trees, books, coding.parts), "ball-codes")
    by_label = coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    out = coded.join(by_label, F.col("label").eqNullSafe(F.col("same")))
    return out.select("id", "label", "code", "error", "label_error"), books
