"""Regression tree with exact splits (M9) and its node table.

The tree grows level by level as the R package does: every cut between two
neighbouring values of a feature counts, not the bounds of bins alone. A level is a
fixed number of jobs whatever the number of its nodes: each task adds up its rows of
all open nodes by (node, feature, bin), the tasks' sums are merged by (node,
feature), and a bin within which no cut can reach the best one known is done with;
only the rows of the other bins are counted by value (``_Levels``). Text features
with more levels than a task should hold, or targets whose sums pass 63 bits, are
counted by value from the start (``_entries``, ``_best_cuts``). Nodes that a task can
hold are grown to their leaves there, each by itself, by the same rules. The driver
holds the nodes only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators.indexing import running_sums
from kiln.session import checkpoint_root, scratch_dir

NODE = ("id long, prediction double, impurity double, n long, left long, right long, feature string, threshold double, "
        "categories array<string>")


@dataclass(frozen=True)
class RegTree:
    """Nodes by number: the root is 1, the sons of i are 2i and 2i + 1. A node has
    n, prediction, impurity (mean squared error) and, if it is split, feature,
    threshold or categories (levels that go left), and ``left_known`` /
    ``right_known`` (levels of a text feature on either side) and ``major`` (the
    side of rows without the feature or with another level, the larger one)."""
    nodes: dict[int, dict]
    types: dict[str, str]

    def leaf(self) -> Column:
        """The number of the leaf that a row falls into."""
        return _walk(self.nodes, self.types, 1, lambda i: F.lit(i).cast("long"))

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """``df`` with each row's leaf (node number) and the leaf's mean."""
        at = _walk(self.nodes, self.types, 1, lambda i: F.struct(F.lit(i).cast("long").alias("leaf"), F.lit(self.nodes[i]["prediction"]).alias("mean")))
        return df.withColumn("_at", at).select(*df.columns, F.col("_at.leaf").alias("leaf"), F.col("_at.mean").alias(name))

    def table(self, spark) -> DataFrame:
        """The node table."""
        rows = [(i, n["prediction"], n["impurity"], n["n"], 2 * i if n["feature"] else None, 2 * i + 1 if n["feature"] else None,
                 n["feature"], n["threshold"], n["categories"]) for i, n in sorted(self.nodes.items())]
        return spark.createDataFrame(rows, NODE)


def _number(c: str, dtype: str) -> Column:
    """A feature as a number: dates as days since 1970, timestamps as seconds."""
    if dtype == "date":
        return F.unix_date(F.col(c)).cast("double")
    if dtype.startswith("timestamp"):
        return F.unix_micros(F.col(c).cast("timestamp")) / 1e6
    value = F.col(c).cast("double")
    return F.when(~F.isnan(value), value)


def _walk(nodes: dict, types: dict, i: int, end) -> Column:
    """``end`` of the node without a split that a row falls into, from node i on."""
    n = nodes[i]
    if n["feature"] is None:
        return end(i)
    c, left = n["feature"], n["major"] == "left"
    if n["threshold"] is not None:
        goes_left = _number(c, types[c]) <= n["threshold"]
    elif left:
        goes_left = ~F.col(c).isin(n["right_known"])
    else:
        goes_left = F.col(c).isin(n["left_known"])
    return F.when(F.coalesce(goes_left, F.lit(left)), _walk(nodes, types, 2 * i, end)).otherwise(_walk(nodes, types, 2 * i + 1, end))


def reg_tree(df: DataFrame, target: str, exclude=(), max_depth: int = 30, min_split: int = 20, min_leaf: int = 7,
             cp: float = 0.01, part_rows: int = 100_000, n_bins: int = 1024, most_levels: int = 4096) -> RegTree:
    """M9: regression tree of ``target`` on every other column, with the defaults of
    the R package: nodes under ``min_split`` rows are not split, no side has less
    than ``min_leaf``, the depth is 30 at most.

    Numbers and dates are cut midway between neighbouring values. The levels of a
    text column are put in the order of their means, where the best cut into two
    sets is one of the cuts between neighbours. The best split lowers the squared
    error most; of equal ones the earlier column counts, then the cut with fewer
    rows on its left. Rows without a feature are left out when its cuts are rated
    and go with the larger side. Rows without a target are left out.

    The grown tree is pruned by cost and complexity (``prune``). A node whose whole
    error is not above ``cp`` x the root's could not keep a split and is not tried,
    so that a level has 1 / cp open nodes at most, and so many rows reach the driver.
    A decimal or integer target is added up exactly. Below ``part_rows`` rows a node
    is finished in one task (``_Part``). ``n_bins`` is the number of bins of a number
    while a level is added up; it changes the work, not the result. Text columns with
    more than ``most_levels`` levels are counted by value.
    """
    types = dict(df.dtypes)
    cols = [c for c in df.columns if c != target and c not in exclude]
    y = F.col(target) if types[target] in ("int", "bigint", "smallint", "tinyint") or types[target].startswith("decimal") else F.col(target).cast("double")
    checkpoint_root(df.sparkSession)
    path = scratch_dir(df.sparkSession, "tree")  # stored by column: each level reads all rows
    df.select(*cols, y.alias("_y")).where("_y IS NOT NULL AND NOT isnan(CAST(_y AS DOUBLE))").write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    nodes: dict[int, dict] = {1: _node()}
    plain, levels = _Levels.of(rows, cols, types, min_leaf, n_bins, most_levels)
    open_, floor, small = [1], None, []
    while open_:
        entries = None if levels else _entries(rows, nodes, open_, cols, types)
        if levels:
            totals, cuts = levels.sums(plain, nodes, open_)
        else:
            totals = {r["node"]: (r["n"], float(r["s"]), float(r["q"])) for r in entries.where("f = -1").select("node", "n", "s", "q").collect()}
        if not totals:  # an empty table
            break
        for i, (n, s, q) in totals.items():
            square = max(0.0, q - s * s / n)
            nodes[i] |= {"n": n, "prediction": s / n, "error": square, "impurity": square / n}
        if floor is None:
            floor, stored = cp * nodes[1]["error"], nodes[1]["n"]
        tried = [i for i in totals if nodes[i]["n"] >= min_split and nodes[i]["error"] > floor and i.bit_length() <= max_depth]
        small += [i for i in tried if nodes[i]["n"] <= part_rows]
        tried = [i for i in tried if nodes[i]["n"] > part_rows]
        if not tried:
            break
        if levels:
            best = levels.best(plain, nodes, {i: cuts[i] for i in tried if i in cuts})
        else:
            best = _best_cuts(entries.where(F.col("f") >= 0).where(F.col("node").isin(tried)), min_leaf)
        open_ = []
        for i, split in best.items():
            text = types[cols[split["f"]]] == "string"
            nodes[i] |= {"feature": cols[split["f"]], "threshold": None if text else (split["num"] + split["next"]) / 2,
                         "categories": sorted(split["left"]) if text else None, "left_known": split["left"], "right_known": split["right"],
                         "major": "left" if 2 * split["nl"] >= split["n"] else "right"}
            nodes |= {2 * i: _node(), 2 * i + 1: _node()}
            open_ += [2 * i, 2 * i + 1]
        left = sum(nodes[i]["n"] for i in best)
        if levels and open_ and 2 * left <= stored:
            plain, stored = levels.kept(plain, nodes, open_), left
    if small:
        nodes |= _finished(rows, nodes, small, cols, types, _Rules(max_depth, min_split, min_leaf, floor))
    if floor is None:
        return RegTree({1: _node() | {"n": 0}}, types)
    return RegTree(prune(nodes, floor), types)


def _node() -> dict:
    return dict.fromkeys(("n", "prediction", "impurity", "feature", "threshold", "categories", "left_known", "right_known", "major"))


def _entries(rows: DataFrame, nodes: dict, open_: list[int], cols: list[str], types: dict) -> DataFrame:
    """(node, f, num, txt, n, s, q): rows, sum and sum of squares of the target for
    each value of each feature in the open nodes; f = -1 is the node as a whole."""
    at = _walk(nodes, types, 1, lambda i: F.lit(i if i in open_ else None).cast("long"))
    none, word = F.lit(None).cast("double"), F.lit(None).cast("string")

    def pair(f, num, txt):
        return F.struct(F.lit(f).alias("f"), num.alias("num"), txt.alias("txt"))
    feats = [pair(i, none, F.col(c)) if types[c] == "string" else pair(i, _number(c, types[c]), word) for i, c in enumerate(cols)]
    melted = (rows.select(at.alias("node"), "_y", F.array(pair(-1, none, word), *feats).alias("_f")).where("node IS NOT NULL")
                  .select("node", "_y", F.inline("_f")).where("f = -1 OR num IS NOT NULL OR txt IS NOT NULL"))
    return melted.groupBy("node", "f", "num", "txt").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("s"),
                                                         F.sum(F.col("_y") * F.col("_y")).alias("q")).checkpoint(eager=True)


def _features(cols: list[str], types: dict) -> list[Column]:
    return [(F.col(c) if types[c] == "string" else _number(c, types[c])).alias(f"_f{i}") for i, c in enumerate(cols)]


def _table(kinds: dict, rows: list[dict]) -> pa.Table:
    return pa.table([pa.array([r[c] for r in rows], t) for c, t in kinds.items()], names=list(kinds))


@dataclass(frozen=True)
class _Levels:
    """The sums of a level and its best cuts. ``edges``: for a number the upper ends of
    its bins (a last one holds the rest), for a text its levels. A number that is not
    ``coarse`` has a bin for each value. A decimal or integer target is held as whole
    multiples of 1 / ``unit``; if ``small`` a chunk's sums are exact as doubles."""
    cols: list[str]
    types: dict
    edges: list[list]
    coarse: list[bool]
    unit: float
    whole: bool
    small: bool
    min_leaf: int

    @staticmethod
    def of(rows: DataFrame, cols: list[str], types: dict, min_leaf: int, n_bins: int, most_levels: int):
        """The rows as numbers and texts, and the levels; None twice where values are to be counted one by one."""
        kind = dict(rows.dtypes)["_y"]
        whole, scale = kind != "double", int(kind.rstrip(")").split(",")[1]) if kind.startswith("decimal") else 0
        names, numbers = [c for c in cols if types[c] == "string"], [i for i, c in enumerate(cols) if types[c] != "string"]
        each = {i: _number(cols[i], types[cols[i]]) for i in numbers}
        most = F.max(F.abs(F.col("_y").cast("decimal(38,18)") if whole and not scale else F.col("_y")))
        found = rows.agg(F.count(F.lit(1)).alias("_n"), most.alias("_most"), *[F.approx_count_distinct(v).alias(f"_f{i}") for i, v in each.items()]).first()
        greatest = (int(found["_most"]) + 1) * 10 ** scale if whole and found["_n"] else 0
        if greatest * found["_n"] >= 1 << 62:
            return None, None
        edges: list = [[] for _ in cols]
        few = [F.struct(F.lit(i).alias("f"), v.alias("v")) for i, v in each.items() if found[f"_f{i}"] <= n_bins]
        if few:
            for f, v in rows.select(F.inline(F.array(*few))).where("v IS NOT NULL").distinct().collect():
                edges[f].append(v)
        coarse = [i in each and (found[f"_f{i}"] > n_bins or len(edges[i]) > 2 * n_bins) for i in range(len(cols))]
        probs = [k / n_bins for k in range(1, n_bins)]
        ends = [F.percentile_approx(each[i], probs).alias(f"_f{i}") for i in each if coarse[i]]
        if ends:
            for name, v in rows.agg(*ends).first().asDict().items():
                edges[int(name[2:])] = v or []
        edges = [sorted(set(e)) for e in edges]
        for c in names:
            levels = [r[0] for r in rows.select(c).where(F.col(c).isNotNull()).distinct().limit(most_levels + 1).collect()]
            if len(levels) > most_levels:
                return None, None
            edges[cols.index(c)] = sorted(levels, key=str.encode)
        y = (F.col("_y") * F.lit(10 ** scale)).cast("long") if whole else F.col("_y")
        return rows.select(*_features(cols, types), y.alias("_y")), _Levels(cols, types, edges, coarse, 10.0 ** scale, whole, greatest < 1 << 34, min_leaf)

    def _chunks(self, batches, nodes: dict, most: int = 200_000):
        """(columns, target, node of each row), some batches at a time."""
        tree, codes = _Tree(nodes, self.cols, self.edges), [{v: k for k, v in enumerate(e)} for e in self.edges]
        for part in _joined(batches, most):
            columns = []
            for f, c in enumerate(self.cols):
                column = part.column(f"_f{f}").combine_chunks()
                if self.types[c] == "string":
                    own = column.dictionary_encode()
                    number = np.array([codes[f][v] for v in own.dictionary.to_pylist()] + [np.nan])
                    columns.append(number[own.indices.fill_null(len(number) - 1).to_numpy(zero_copy_only=False)])
                else:
                    columns.append(column.fill_null(np.nan).to_numpy(zero_copy_only=False))
            y = part.column("_y").to_numpy()
            yield columns, y, tree.place(columns, len(y))

    def _bins(self, f: int, column: np.ndarray) -> np.ndarray:
        return column.astype(np.int64) if self.types[self.cols[f]] == "string" else np.searchsorted(self.edges[f], column)

    def kept(self, rows: DataFrame, nodes: dict, open_: list[int]) -> DataFrame:
        """The rows in the open nodes, stored."""
        def own(batches):
            for part in _joined(batches, 200_000):
                for _, _, at in self._chunks(part.to_batches(), nodes, part.num_rows):
                    yield from part.filter(pa.array(np.isin(at, open_))).to_batches()
        path = scratch_dir(rows.sparkSession, "tree")
        rows.mapInArrow(own, rows.schema).write.parquet(path)
        return rows.sparkSession.read.parquet(path)

    def sums(self, rows: DataFrame, nodes: dict, open_: list[int]) -> tuple[dict, dict]:
        """Rows, sum and sum of squares of each open node, and what is known of the
        cuts of each of its features (``_rated``)."""
        width = [len(e) + 1 for e in self.edges]
        index = {i: k for k, i in enumerate(open_)}
        held = np.int64 if self.whole else np.float64

        def add(batches):
            zero = [dict(n=np.zeros(len(open_) * w, np.int64), s=np.zeros(len(open_) * w, held), xl=np.full(len(open_) * w, np.inf), xh=np.full(len(open_) * w, -np.inf),
                         yl=np.full(len(open_) * w, np.inf), yh=np.full(len(open_) * w, -np.inf)) for w in [1, *width]]
            squares = np.zeros(len(open_))
            for columns, y, at in self._chunks(batches, nodes):
                own, back = np.unique(at, return_inverse=True)
                at = np.array([index.get(i, -1) for i in own.tolist()])[back]
                known = at >= 0
                for f, total in enumerate(zero, -1):
                    mine = known if f < 0 else known & ~np.isnan(columns[f])
                    key, v = at[mine], y[mine]
                    if f >= 0:
                        key = key * width[f] + self._bins(f, columns[f][mine])
                        if self.coarse[f]:
                            np.minimum.at(total["xl"], key, columns[f][mine])
                            np.maximum.at(total["xh"], key, columns[f][mine])
                            np.minimum.at(total["yl"], key, v)
                            np.maximum.at(total["yh"], key, v)
                    else:
                        squares += np.bincount(key, (v / self.unit) ** 2, len(open_))
                    total["n"] += np.bincount(key, minlength=len(total["n"]))
                    if self.small:
                        total["s"] += np.bincount(key, v, len(total["s"])).astype(held)
                    else:
                        np.add.at(total["s"], key, v)
            out = []
            for f, total in enumerate(zero, -1):
                for k, i in enumerate(open_):
                    own = {c: v.reshape(len(open_), -1)[k] for c, v in total.items()}
                    filled = np.flatnonzero(own["n"])
                    if len(filled):
                        out.append({"node": i, "f": f, "q": squares[k], "bin": filled} | {c: v[filled] if c in "ns" or f >= 0 and self.coarse[f] else [] for c, v in own.items()})
            if out:
                yield from _table(kinds, out).to_batches()

        def merge(part: pa.Table) -> pa.Table:
            i, f = part.column("node")[0].as_py(), part.column("f")[0].as_py()
            bins = part.column("bin").combine_chunks().flatten().to_numpy()
            values, place = np.unique(bins, return_inverse=True)
            got = {c: part.column(c).combine_chunks().flatten().to_numpy() for c in ("n", "s", "xl", "xh", "yl", "yh")}
            n, s = np.zeros(len(values), np.int64), np.zeros(len(values), held)
            np.add.at(n, place, got["n"])
            np.add.at(s, place, got["s"])
            ends = {c: np.full(len(values), np.inf if c[1] == "l" else -np.inf) for c in ("xl", "xh", "yl", "yh")}
            if f >= 0 and self.types[self.cols[f]] != "string" and not self.coarse[f]:
                ends["xl"] = ends["xh"] = np.array(self.edges[f])[values]
            for c, v in ends.items() if f >= 0 and self.coarse[f] else ():
                (np.minimum if c[1] == "l" else np.maximum).at(v, place, got[c])
            one = dict.fromkeys(rated) | {"node": i, "f": f, "n": int(n.sum()), "s": float(s.sum()) / self.unit, "q": float(np.sum(part.column("q").to_numpy()))}
            return _table(rated, [one if f < 0 else one | self._rated(f, values, n, s, ends)])
        whole = pa.int64() if self.whole else pa.float64()
        kinds = {"node": pa.int64(), "f": pa.int32(), "q": pa.float64(), "bin": pa.list_(pa.int64()), "n": pa.list_(pa.int64()), "s": pa.list_(whole),
                 **{c: pa.list_(pa.float64()) for c in ("xl", "xh", "yl", "yh")}}
        rated = {"node": pa.int64(), "f": pa.int32(), "n": pa.int64(), "s": pa.float64(), "q": pa.float64(), "gain": pa.float64(), "nl": pa.int64(), "num": pa.float64(),
                 "next": pa.float64(), "left": pa.list_(pa.int64()), "right": pa.list_(pa.int64()), "bin": pa.list_(pa.int64()), "bound": pa.list_(pa.float64()),
                 "before_n": pa.list_(pa.int64()), "before_s": pa.list_(whole), "sa": whole}
        kind = "bigint" if self.whole else "double"
        parts = rows.mapInArrow(add, f"node long, f int, q double, bin array<long>, n array<long>, s array<{kind}>, xl array<double>, xh array<double>, "
                                          "yl array<double>, yh array<double>")
        got = parts.groupBy("node", "f").applyInArrow(merge, f"node long, f int, n long, s double, q double, gain double, nl long, num double, next double, "
                                                      f"left array<long>, right array<long>, bin array<long>, bound array<double>, before_n array<long>, before_s array<{kind}>, sa {kind}").collect()
        totals, cuts = {}, {}
        for r in got:
            if r["f"] < 0:
                totals[r["node"]] = (r["n"], r["s"], r["q"])
            else:
                cuts.setdefault(r["node"], []).append(r)
        return totals, cuts

    def _gain(self, nl, sl, na, sa):
        """What cuts with ``nl`` rows and the sum ``sl`` on their left take off the error."""
        def part(s, n):
            s = np.asarray(s, float) / self.unit
            return s * s / n
        return part(sl, nl) + part(sa - sl, na - nl) - part(sa, na)

    def _rated(self, f: int, bins: np.ndarray, n: np.ndarray, s: np.ndarray, ends: dict) -> dict:
        """The best cut of a feature between two bins, or two levels; and the bins of
        several values within which a cut may be better, with a bound of its gain.

        The gain is convex in the rows and the sum on the left; with the least and the
        greatest target of a bin, what the left may have of it lies in a parallelogram,
        so that its corners bound the gain."""
        text = self.types[self.cols[f]] == "string"
        if text:
            mean = np.asarray(s, float) / self.unit / n
            order = np.array(sorted(range(len(bins)), key=lambda k: (mean[k], bins[k])))
            bins, n, s = bins[order], n[order], s[order]
        na, sa = n.sum(), s.sum()
        nl, sl = np.cumsum(n), np.cumsum(s)
        found = {"n": int(na), "sa": sa.item(), "gain": None, "bin": [], "bound": [], "before_n": [], "before_s": []}
        ok = np.flatnonzero((nl[:-1] >= self.min_leaf) & (na - nl[:-1] >= self.min_leaf))
        if len(ok):
            gain = self._gain(nl[ok], sl[ok], na, sa)
            k = int(gain.argmax())
            if gain[k] > 0:
                cut = int(ok[k])
                found |= {"gain": float(gain[k]), "nl": int(nl[cut])}
                if text:
                    found |= {"left": bins[:cut + 1], "right": bins[cut + 1:]}
                else:
                    found |= {"num": float(ends["xh"][cut]), "next": float(ends["xl"][cut + 1])}
        if not self.coarse[f]:
            return found
        many = np.flatnonzero((ends["xl"] < ends["xh"]) & (nl - 1 >= self.min_leaf) & (na - nl + n - 1 >= self.min_leaf))
        low, high, nb, sb = ends["yl"][many], ends["yh"][many], n[many], s[many]
        before_n, before_s = nl[many] - nb, sl[many] - sb
        spread = np.where(high > low, high - low, 1.0)
        bound = np.full(len(many), -np.inf)
        up, down = np.clip((sb - nb * low) / spread, 0, nb), np.clip((nb * high - sb) / spread, 0, nb)
        for m, t in ((0.0 * nb, 0.0 * nb), (nb, sb), (up, up * high), (down, down * low)):
            left_n, left_s = before_n + m, before_s + t
            inner = (left_n > 0) & (left_n < na)
            bound[inner] = np.maximum(bound[inner], self._gain(left_n[inner], left_s[inner], na, sa))
        bound = bound + 1e-9 * (np.abs(bound) + (float(sa) / self.unit) ** 2 / na)  # above any rounding
        return found | {"bin": bins[many], "bound": bound, "before_n": before_n, "before_s": before_s}

    def best(self, rows: DataFrame, nodes: dict, cuts: dict[int, list]) -> dict[int, dict]:
        """The best cut of each node: f, num, n (rows with the feature), nl (those on
        the left), next (the next value), left and right (levels of a text feature)."""
        found: dict[int, dict] = {}

        def better(i, r):
            if r["gain"] is not None and (i not in found or (r["gain"], -r["f"], -r["nl"]) > (found[i]["gain"], -found[i]["f"], -found[i]["nl"])):
                found[i] = r
        open_bins: dict[int, dict] = {}
        for i, features in cuts.items():
            for r in features:
                better(i, r.asDict())
            least = found[i]["gain"] if i in found else 0.0
            for r in features:
                chosen = {b: (n, s, r["n"], r["sa"]) for b, bound, n, s in zip(r["bin"], r["bound"], r["before_n"], r["before_s"]) if bound >= least}
                if chosen:
                    open_bins.setdefault(i, {})[r["f"]] = chosen
        if open_bins:
            for r in self._within(rows, nodes, open_bins):
                better(r["node"], r.asDict() | {"left": None, "right": None})
        for r in found.values():
            if r["left"] is not None:
                r["left"], r["right"] = ([self.edges[r["f"]][k] for k in r[side]] for side in ("left", "right"))
        return found

    def _within(self, rows: DataFrame, nodes: dict, open_bins: dict[int, dict]) -> list:
        """The best cut between two values of each of the bins."""
        kind = "long" if self.whole else "double"

        def values(batches):
            for columns, y, at in self._chunks(batches, nodes):
                for i, features in open_bins.items():
                    own = np.flatnonzero(at == i)
                    for f, chosen in features.items():
                        x = columns[f][own]
                        mine = own[~np.isnan(x)]
                        bins = self._bins(f, columns[f][mine])
                        wanted = np.isin(bins, list(chosen))
                        mine, bins = mine[wanted], bins[wanted]
                        if len(mine):
                            x, place = np.unique(columns[f][mine], return_inverse=True)
                            s = np.zeros(len(x), y.dtype)
                            np.add.at(s, place, y[mine])
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), i)), pa.array(np.full(len(x), f, np.int32)), pa.array(self._bins(f, x)), pa.array(x),
                                                              pa.array(np.bincount(place)), pa.array(s)], names=["node", "f", "bin", "x", "n", "s"])

        def rate(part: pa.Table) -> pa.Table:
            i, f, b = (part.column(c)[0].as_py() for c in ("node", "f", "bin"))
            before_n, before_s, na, sa = open_bins[i][f][b]
            x, place = np.unique(part.column("x").to_numpy(), return_inverse=True)
            n, s = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64 if self.whole else np.float64)
            np.add.at(n, place, part.column("n").to_numpy())
            np.add.at(s, place, part.column("s").to_numpy())
            nl, sl = before_n + np.cumsum(n)[:-1], before_s + np.cumsum(s)[:-1]
            ok = np.flatnonzero((nl >= self.min_leaf) & (na - nl >= self.min_leaf))
            out = []
            if len(ok):
                gain = self._gain(nl[ok], sl[ok], na, sa)
                k = int(gain.argmax())
                if gain[k] > 0:
                    out.append({"node": i, "f": f, "n": na, "gain": float(gain[k]), "nl": int(nl[ok[k]]), "num": float(x[ok[k]]), "next": float(x[ok[k] + 1])})
            return _table({"node": pa.int64(), "f": pa.int32(), "n": pa.int64(), "gain": pa.float64(), "nl": pa.int64(), "num": pa.float64(), "next": pa.float64()}, out)
        own = rows.mapInArrow(values, f"node long, f int, bin long, x double, n long, s {kind}")
        return own.groupBy("node", "f", "bin").applyInArrow(rate, "node long, f int, n long, gain double, nl long, num double, next double").collect()


def _joined(batches, most: int):
    """Batches put together to tables of ``most`` rows or a little more."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


class _Tree:
    """The nodes for rows as arrays: numbers, and texts by the number of their level."""

    def __init__(self, nodes: dict, cols: list[str], edges: list[list]):
        self.nodes = {}
        for i, n in nodes.items():
            if n["feature"] is None:
                self.nodes[i] = None
                continue
            f, major, left = cols.index(n["feature"]), n["major"] == "left", None
            if n["threshold"] is None:
                left = np.full(len(edges[f]), major)
                code = {v: k for k, v in enumerate(edges[f])}
                left[[code[v] for v in n["left_known"]]] = True
                left[[code[v] for v in n["right_known"]]] = False
            self.nodes[i] = f, n["threshold"], left, major

    def place(self, columns: list[np.ndarray], n: int) -> np.ndarray:
        """The node without a split that each row falls into."""
        out, stack = np.zeros(n, np.int64), [(1, np.arange(n))]
        while stack:
            i, at = stack.pop()
            if self.nodes[i] is None:
                out[at] = i
                continue
            f, threshold, left, major = self.nodes[i]
            own = columns[f][at]
            none = np.isnan(own)
            goes = own <= threshold if left is None else left[np.where(none, 0, own).astype(int)]
            goes = np.where(none, major, goes)
            stack += [(2 * i, at[goes]), (2 * i + 1, at[~goes])]
        return out


@dataclass(frozen=True)
class _Rules:
    max_depth: int
    min_split: int
    min_leaf: int
    floor: float


_GROWN = ("id long, n long, prediction double, error double, f int, threshold double, left_known array<string>, right_known array<string>, major string")


def _finished(rows: DataFrame, nodes: dict, small: list[int], cols: list[str], types: dict, rules: _Rules) -> dict[int, dict]:
    """The nodes below (and at) each of ``small``, grown in one task for each."""
    at = _walk(nodes, types, 1, lambda i: F.lit(i if i in small else None).cast("long"))
    own = rows.select(at.alias("_node"), *_features(cols, types), "_y").where("_node IS NOT NULL")

    def grow(part: pa.Table) -> pa.Table:
        grown = _Part(part, len(cols), rules).grow(part.column("_node")[0].as_py())
        names = [c.split()[0] for c in _GROWN.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
        return pa.table([pa.array([g[c] for g in grown], t) for c, t in zip(names, kinds)], names=names)
    out = {}
    for r in own.groupBy("_node").applyInArrow(grow, _GROWN).collect():
        n = _node() | {"n": r["n"], "prediction": r["prediction"], "error": r["error"], "impurity": r["error"] / r["n"]}
        if r["f"] is not None:
            n |= {"feature": cols[r["f"]], "threshold": r["threshold"], "categories": sorted(r["left_known"]) if r["left_known"] is not None else None,
                  "left_known": r["left_known"], "right_known": r["right_known"], "major": r["major"]}
        out[r["id"]] = n
    return out


class _Part:
    """The rows of a node in one task, as arrays: numbers, or levels by their number
    and name; an integer or decimal target as whole multiples of ``unit``."""

    def __init__(self, rows: pa.Table, width: int, rules: _Rules):
        self.rules, self.columns, self.levels = rules, [], []
        for i in range(width):
            column = rows.column(f"_f{i}").combine_chunks()
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                coded = column.dictionary_encode()
                self.levels.append(np.array(coded.dictionary.to_pylist(), object))
                self.columns.append(coded.indices.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False))
            else:
                self.levels.append(None)
                self.columns.append(column.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False))
        y = rows.column("_y")
        self.unit = 1.0
        if pa.types.is_decimal(y.type):
            self.unit = 10.0 ** y.type.scale
            self.y = np.array([int(v.scaleb(y.type.scale)) for v in y.to_pylist()], np.int64)
        else:
            self.y = y.to_numpy()

    def _gain(self, s, n):
        s = np.asarray(s, float) / self.unit
        return s * s / n

    def _best(self, at: np.ndarray) -> tuple | None:
        """(gain, f, threshold, left levels, right levels, major) of the rows' best cut."""
        best, y = None, self.y[at]
        for f, column in enumerate(self.columns):
            own = column[at]
            known = ~np.isnan(own)
            own, yk = own[known], y[known]
            values, place = np.unique(own, return_inverse=True)
            n = np.bincount(place, minlength=len(values))
            s = np.zeros(len(values), self.y.dtype)
            np.add.at(s, place, yk)
            names = self.levels[f]
            if names is not None:
                names = names[values.astype(int)]
                mean = np.asarray(s, float) / self.unit / n
                order = sorted(range(len(values)), key=lambda k: (mean[k], names[k].encode()))
                names, n, s = names[order], n[order], s[order]
            nl, sl = np.cumsum(n)[:-1], np.cumsum(s)[:-1]
            na, sa = n.sum(), s.sum()
            ok = np.flatnonzero((nl >= self.rules.min_leaf) & (na - nl >= self.rules.min_leaf))
            if not len(ok):
                continue
            gain = self._gain(sl[ok], nl[ok]) + self._gain(sa - sl[ok], na - nl[ok]) - self._gain(sa, na)
            k = int(gain.argmax())
            if gain[k] > 0 and (best is None or gain[k] > best[0]):
                cut = ok[k]
                major = "left" if 2 * nl[cut] >= na else "right"
                if names is None:
                    best = gain[k], f, float((values[cut] + values[cut + 1]) / 2), None, None, major
                else:
                    best = gain[k], f, None, names[:cut + 1].tolist(), names[cut + 1:].tolist(), major
        return best

    def grow(self, top: int) -> list[dict]:
        out, stack = [], [(top, np.arange(len(self.y)))]
        while stack:
            i, at = stack.pop()
            y = self.y[at]
            total, squares = float(y.sum()) / self.unit, float((y.astype(float) ** 2).sum()) / self.unit ** 2
            node = {"id": i, "n": len(at), "prediction": total / len(at), "error": max(0.0, squares - total * total / len(at))}
            r = self.rules
            best = self._best(at) if len(at) >= r.min_split and node["error"] > r.floor and i.bit_length() <= r.max_depth else None
            _, f, threshold, left, right, major = best or (None,) * 6
            out.append(node | {"f": f, "threshold": threshold, "left_known": left, "right_known": right, "major": major})
            if best:
                own = self.columns[f][at]
                goes = own <= threshold if left is None else np.isin(own, np.flatnonzero(np.isin(self.levels[f], left)))
                goes = np.where(np.isnan(own), major == "left", goes)
                stack += [(2 * i, at[goes]), (2 * i + 1, at[~goes])]
        return out


def _best_cuts(entries: DataFrame, min_leaf: int) -> dict[int, dict]:
    """For each node its best cut: f, num, n (rows with the feature), nl (those on
    the left), next (the next value), left and right (levels of a text feature)."""
    placed = entries.select("node", "f", "num", "txt", "n", "s",
                            F.when(F.col("txt").isNotNull(), F.col("s").cast("double") / F.col("n")).otherwise(F.col("num")).alias("at"))
    run = running_sums(placed, ["node", "f"], ["at", "txt"], {"nl": "n", "sl": "s"})
    whole = placed.groupBy("node", "f").agg(F.sum("n").alias("na"), F.sum("s").alias("sa"))
    sl, sr, sa = F.col("sl").cast("double"), (F.col("sa") - F.col("sl")).cast("double"), F.col("sa").cast("double")
    gain = sl * sl / F.col("nl") + sr * sr / (F.col("na") - F.col("nl")) - sa * sa / F.col("na")
    cuts = (run.join(F.broadcast(whole), ["node", "f"])  # open nodes x features
               .where((F.col("nl") >= min_leaf) & (F.col("na") - F.col("nl") >= min_leaf))
               .withColumn("gain", gain).where("gain > 0"))
    best = (cuts.groupBy("node").agg(F.max_by(F.struct("f", "num", "txt", "at", "nl", "na"), F.struct("gain", -F.col("f"), -F.col("nl"))).alias("b"))
                .select("node", "b.*"))
    found = {r["node"]: r for r in best.collect()}
    if not found:
        return {}
    # what lies on either side of the chosen cuts
    spark = entries.sparkSession
    chosen = spark.createDataFrame([(i, r["f"], r["at"], r["txt"]) for i, r in found.items()], "node long, f int, _at double, _txt string")
    left = (F.col("at") < F.col("_at")) | ((F.col("at") == F.col("_at")) & (F.coalesce("txt", F.lit("")) <= F.coalesce("_txt", F.lit(""))))
    sides = (placed.join(F.broadcast(chosen), ["node", "f"]).withColumn("_left", left).groupBy("node")
                   .agg(F.min(F.when(~F.col("_left"), F.col("num"))).alias("next"),
                        F.collect_list(F.when(F.col("_left"), F.col("txt"))).alias("l"), F.collect_list(F.when(~F.col("_left"), F.col("txt"))).alias("r")))
    side = {r["node"]: r for r in sides.collect()}
    return {i: {"f": r["f"], "num": r["num"], "n": r["na"], "nl": r["nl"], "next": side[i]["next"], "left": side[i]["l"], "right": side[i]["r"]}
            for i, r in found.items()}


def prune(nodes: dict, floor: float) -> dict:
    """Cost-complexity pruning: of each node's subtrees the one with the least
    error + ``floor`` x leaves stays; a split that only equals its leaf is undone."""
    nodes, cost = {i: dict(n) for i, n in nodes.items()}, {}
    for i in sorted(nodes, reverse=True):
        below = cost[2 * i] + cost[2 * i + 1] if nodes[i]["feature"] else None
        cost[i] = nodes[i]["error"] + floor
        if below is not None and below < cost[i]:
            cost[i] = below
        else:
            nodes[i] |= dict.fromkeys(("feature", "threshold", "categories", "left_known", "right_known", "major"))
    kept, stack = {}, [1]
    while stack:
        i = stack.pop()
        kept[i] = nodes[i]
        stack += [2 * i, 2 * i + 1] if nodes[i]["feature"] else []
    return kept
