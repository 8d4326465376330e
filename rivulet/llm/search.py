"""Ranked lexical search over a frequency-pattern tree of documents.

Terms are the runs of ASCII letters, digits and characters beyond ASCII, with A-Z
lower-cased.  A document's vector is restricted to the terms that some item uses
and ordered by how many documents hold a term, rarest first, so that documents
with the same rare terms share a path of the tree and a subtree can hold no term
rarer than its path.  Every node knows, of the documents below it, the largest
count of each term on its edge, the largest count of any term further down, and
the smallest length norm m.  With them no score below the node is larger than

    sum over the item's terms on the path   w * part(largest count, smallest m)
  + sum of w over its terms further down    * part(largest count below, smallest m)

and each item walks the tree depth first, leaving out subtrees that cannot reach
its tenth best score so far.  Items walk together: a node is worked on once, for
the items that still follow it.

Spark's part: one pass restricts the texts (their vectors are written to the
shared folder), one aggregation counts documents by term, every task builds trees
of its own vectors and keeps its k best of each item, and these (k a task) are
ranked per item.  Texts are never shuffled.  Items are read in blocks of bounded
size, so what tasks are sent does not grow with the number of items.
"""

from __future__ import annotations

import math
from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import saved, table

TOP = 10
BLOCK_CHARS = 2_000_000  # code points of the items that are searched for at once
_TREE_TERMS = 2_000_000  # terms of the vectors of one tree

# ASCII characters that are no letters or digits become blanks, A-Z lower case
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_PLAIN).split()


def part(tf, m):
    """What a term's weight is multiplied by, for its count and the length norm."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def norm(n, docs: int, total: int):
    """The length norm m of a document with n terms."""
    return 100 - 75 + (75 * n * docs) // total


# -------------------------------------------------------------------- vectors
def _restrict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = shared.value
        for b in batches:
            size, own, tfs = [], [], []
            for t in b.column(1):
                found = terms(t.as_py())
                held = [(known[w], c) for w, c in Counter(found).items() if w in known]
                size.append(len(found))
                own.append([w for w, _ in held])
                tfs.append([c for _, c in held])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(own, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                ["doc_id", "n", "terms", "tfs"],
            )

    return run


# ----------------------------------------------------------------------- tree
class Items:
    """Items as postings by place (of a term in the order of frequency), and the
    sums of the weights of each item's later places."""

    def __init__(self, items: list[dict[int, int]], weight: np.ndarray):
        """``items``: per item its places and how often each stands in it."""
        self.n, self.places = len(items), len(weight)
        own = [sorted(i) for i in items]
        size = np.fromiter(map(len, own), np.int64, self.n)
        place = np.fromiter((p for o in own for p in o), np.int64, int(size.sum()))
        item = np.repeat(np.arange(self.n), size)
        gain = weight[place] * np.fromiter((items[i][p] for i, o in enumerate(own) for p in o), np.int64, len(place))
        # by item, then place: sums of what follows
        self.flat = item * self.places + place
        total = np.concatenate(([0], np.cumsum(gain)))
        self.upto, self.end = total, total[np.cumsum(size)]
        by_place = np.lexsort((item, place))
        self.item, self.gain = item[by_place], gain[by_place]
        self.first = np.searchsorted(place[by_place], np.arange(self.places + 1))

    def postings(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items and gains of these places, with the index of each's place."""
        lo = self.first[places]
        size = self.first[places + 1] - lo
        owner = np.repeat(np.arange(len(places)), size)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + lo[owner]
        return self.item[at], self.gain[at], owner

    def rest(self, items: np.ndarray, place: int) -> np.ndarray:
        """Weights of the items' terms behind a place."""
        at = np.searchsorted(self.flat, items * self.places + place, side="right")
        return self.end[items] - self.upto[at]


class Best:
    """The k best ``(score, id)`` of every item."""

    def __init__(self, n: int, k: int):
        self.k, self.rows = k, [[] for _ in range(n)]
        self.least = np.zeros(n, np.int64)  # scores below can't enter

    def offer(self, items: np.ndarray, scores: np.ndarray, ids: list) -> None:
        """Documents ``ids`` (each a sort key of its id) of one score per item."""
        for i, s in zip(items.tolist(), scores.tolist()):
            rows = self.rows[i]
            for key in ids:
                row = (-s, key)
                if len(rows) == self.k:
                    if row >= rows[-1]:
                        break
                    rows.pop()
                insort(rows, row)
            if len(rows) == self.k:
                self.least[i] = -rows[-1][0]


class _Node:
    __slots__ = ("depth", "rows", "children", "most", "below", "least_m")

    def __init__(self, depth: int):
        self.depth = depth  # terms on the path from the root
        self.rows: list[int] = []  # vectors that end here
        self.children: list[tuple[_Node, int]] = []  # and a row below each
        self.most: np.ndarray | None = None  # largest counts of the terms on the path
        self.below = 0  # largest count of any later term
        self.least_m = 1 << 62

    def take(self, child: _Node, row: int) -> None:
        self.children.append((child, row))
        self._widen(child.most, child.least_m, child.below)

    def end(self, row: int, tfs: np.ndarray, m: int) -> None:
        self.rows.append(row)
        self._widen(tfs, m, 0)

    def _widen(self, tfs: np.ndarray, m: int, below: int) -> None:
        head = tfs[: self.depth]
        self.most = head.copy() if self.most is None else np.maximum(self.most, head)
        self.below = max(self.below, below, int(tfs[self.depth :].max(initial=0)))
        self.least_m = min(self.least_m, m)


def tree(paths: list[np.ndarray], tfs: list[np.ndarray], m: list[int]) -> _Node:
    """The path-compressed tree of vectors sorted by their paths."""
    open_: list[tuple[_Node, int]] = [(_Node(0), 0)]  # from the root, with a row below
    for i, path in enumerate(paths):
        shared = 0
        if i:
            before = paths[i - 1]
            size = min(len(before), len(path))
            other = before[:size] != path[:size]
            shared = int(other.argmax()) if other.any() else size
        while open_[-1][0].depth > shared:
            node, row = open_.pop()
            if open_[-1][0].depth < shared:
                open_.append((_Node(shared), row))
            open_[-1][0].take(node, row)
        if len(path) > shared:
            open_.append((_Node(len(path)), i))
        open_[-1][0].end(i, tfs[i], m[i])
    while len(open_) > 1:
        node, row = open_.pop()
        open_[-1][0].take(node, row)
    return open_[0][0]


def search(root: _Node, paths: list[np.ndarray], tfs: list[np.ndarray], m: list[int], ids: list[list], items: Items, best: Best) -> int:
    """Branch and bound of all items over one tree; ``ids`` are the documents of each
    different vector.  Returns the number of nodes that were entered."""
    entered = 0
    every = np.arange(items.n)
    todo = [(root, 0, 0, every, np.zeros(items.n, np.int64))]
    while todo:
        node, row, depth, active, known = todo.pop()
        # the bound may have risen since the node was put aside
        path = paths[row][:node.depth]
        if node.depth > depth:
            gained = np.zeros(items.n, np.int64)
            edge = path[depth:]
            item, gain, owner = items.postings(edge)
            np.add.at(gained, item, gain * part(node.most[depth:], node.least_m)[owner])
            known = known + gained[active]
        bound = known
        if node.below:
            last = int(path[-1]) if len(path) else -1
            bound = known + items.rest(active, last) * int(part(node.below, node.least_m))
        follow = (bound > 0) & (bound >= best.least[active])
        if not follow.any():
            continue
        entered += 1
        active, known = active[follow], known[follow]
        if node.rows:
            item, gain, owner = items.postings(path)
            wanted = np.zeros(items.n, bool)
            wanted[active] = True
            some = wanted[item]
            item, gain, owner = item[some], gain[some], owner[some]
            for r in node.rows:
                score = np.zeros(items.n, np.int64)
                np.add.at(score, item, gain * part(tfs[r], m[r])[owner])
                won = np.nonzero((score > 0) & (score >= best.least) & wanted)[0]
                best.offer(won, score[won], ids[r])
        todo.extend((child, at, node.depth, active, known) for child, at in reversed(node.children))
    return entered


def _id_key(doc_id):
    return (doc_id is None, doc_id or 0)


def distinct_vectors(rows: list[tuple], k: int) -> tuple[list[np.ndarray], list[np.ndarray], list[int], list[list]]:
    """``(path, counts, m, id key)`` rows -> the different vectors sorted by path, each
    with its k smallest ids: equal vectors have equal scores for every item."""
    found: dict[tuple, list] = {}
    for path, tf, m, key in rows:
        ids = found.setdefault((path.astype(">i4").tobytes(), tf.astype(">i4").tobytes(), m), [])
        if len(ids) < k or key < ids[-1]:
            ids.insert(bisect_right(ids, key), key)
            del ids[k:]
    keys = sorted(found)
    paths = [np.frombuffer(p, ">i4").astype(np.int64) for p, _, _ in keys]
    tfs = [np.frombuffer(t, ">i4").astype(np.int64) for _, t, _ in keys]
    return paths, tfs, [x for _, _, x in keys], [found[x] for x in keys]


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_places, weight, place_of, docs, total = shared.value
        items, best = Items(item_places, weight), Best(len(item_places), k)
        held: list[tuple] = []
        size = 0

        def settle() -> None:
            nonlocal held, size
            paths, tfs, m, ids = distinct_vectors(held, k)
            search(tree(paths, tfs, m), paths, tfs, m, ids, items, best)
            held, size = [], 0

        for b in batches:
            ids, n = b.column(0).to_pylist(), b.column(1).to_pylist()
            first = b.column(2).offsets.to_numpy()
            place = place_of[b.column(2).values.to_numpy(zero_copy_only=False)]
            tf = b.column(3).values.to_numpy(zero_copy_only=False).astype(np.int64)
            for i in range(b.num_rows):
                lo, hi = first[i], first[i + 1]
                if lo == hi:
                    continue
                order = np.argsort(place[lo:hi])
                held.append((place[lo:hi][order], tf[lo:hi][order], norm(n[i], docs, total), _id_key(ids[i])))
                size += hi - lo
                if size >= _TREE_TERMS:
                    settle()
        if held:
            settle()
        out = [(i, -s, None if key[0] else key[1]) for i, rows in enumerate(best.rows) for s, key in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[j] for r in out], kind) for j, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))],
            ["item", "score", "doc_id"],
        )

    return run


def _block(docs: DataFrame, items: list, k: int) -> DataFrame:
    """``(item, score, doc_id)``: the k best of each item from every task."""
    spark = docs.sparkSession
    own = [Counter(terms(r["text"])) for r in items]
    known = {w: i for i, w in enumerate(sorted(set().union(*own)))}
    vectors = saved(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
            _restrict(spark.sparkContext.broadcast(known)), "doc_id long, n long, terms array<int>, tfs array<int>"
        ),
        "search-vectors",
    )
    docs_held, total = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    # at most one row for each term of the block
    df = np.zeros(len(known), np.int64)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
        df[r["t"]] = r["df"]
    order = np.lexsort((np.arange(len(known)), df))  # rarest first
    place_of = np.empty(len(known), np.int64)
    place_of[order] = np.arange(len(known))
    weight = np.array([math.floor(1000 * math.log((2 * (docs_held or 0) + 2) / (2 * int(x) + 1))) for x in df[order]], np.int64)
    places = [{int(place_of[known[w]]): c for w, c in o.items()} for o in own]
    shared = spark.sparkContext.broadcast((places, weight, place_of, docs_held or 0, total or 1))
    found = vectors.where("size(terms) > 0").mapInArrow(_search(shared, k), "item int, score long, doc_id long")
    return found


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents with the highest scores above
    0 for every item of ``items(item_id, text)``, equal scores by ascending ``doc_id``
    (nulls last), ranked from 1.  Whole texts are searched.

    A null or blank text of a document holds no term and is found by no item; one of an
    item finds nothing.  Rows equal in item_id and text are one item; unlike texts under
    one id (or without one) are items of their own, each with its ranks.  Document rows
    under one id, null ids too, are ranked as rows of their own.  Other columns are not
    read; empty tables give no rows."""
    spark = docs.sparkSession
    asked = saved(
        items.select("item_id", F.col("text").cast("string").alias("text")).where("length(text) > 0").distinct()
        .withColumn("h", F.xxhash64("item_id", "text")), "search-items",
    )
    blocks = -(-(asked.agg(F.sum(F.char_length("text"))).first()[0] or 0) // block_chars)
    out = None
    for b in range(blocks):
        some = [r for r in asked.where(F.pmod("h", F.lit(blocks)) == b).orderBy("h", "item_id", "text").collect()]
        if not any(terms(r["text"]) for r in some):
            continue
        names = spark.createDataFrame(
            [(i, r["item_id"], r["h"]) for i, r in enumerate(some)], f"item int, item_id {asked.schema['item_id'].dataType.simpleString()}, h long"
        )
        # at most the items of a block
        found = _block(docs, some, k).join(F.broadcast(names), "item").select("item_id", "h", "score", "doc_id")
        out = found if out is None else out.unionAll(found)
    if out is None:
        return asked.select("item_id", F.lit(0).alias("rank"), F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    by_score = Window.partitionBy("item_id", "h").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        out.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
    )


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents WHERE text IS NOT NULL),
i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
q AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL),
size AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS total FROM d WHERE len(t) > 0),
norms AS (SELECT r, doc_id, 100 - 75 + ((75 * len(t) * docs) // total) AS m FROM d, size WHERE len(t) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), size),
scores AS (
  SELECT item_id, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN norms USING (r) GROUP BY item_id, r),
ranks AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scores JOIN norms USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 10
"""
