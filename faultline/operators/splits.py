"""Sampling and leakage-safe splits.

Random order is a reproducible hash rank: ``md5('<row_id>-<seed>')`` (DuckDB
has the same function, so every split has an exact oracle).  No operator
ranks all rows with a window -- a ``row_number`` partitioned by class would
put each class (95 % of the table for the normal class) into one task.
Instead, each split needs only a few *cut points*: the row of rank k in
(hash prefix, md5, key) order within a stratum.  The 52-bit md5 prefix is
uniform on [0, 2^52), so once the stratum sizes are known (a count of the
stratum column alone) the row of rank k lies, but for one case in 10^11, in
an interval of ``SIGMAS`` standard deviations round k / n.  One scan counts
the rows below each interval and gathers those inside it, a few times sqrt(n)
of them; the cut is read off.  Where an interval would hold more than
``small`` rows (n above some 10^8), or missed its row, 12-bit digit
histograms narrow it first (map-side combined, at most 4,096 cells per
interval) and one job fetches what is left.
Every row is then assigned by a narrow comparison against literal tuples.
Quotas use the largest-remainder rule so stratum sizes add up exactly.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.order import position
from ..session import short_methods
HBITS, DIGIT = 52, 12
SIGMAS = 7

H, MD5 = "_h", "_md5"


def with_hash(df: DataFrame, key: str = "row_id", seed: int = 42) -> DataFrame:
    short_methods(df.sparkSession)      # a scan that also labels and deals its rows is a long method
    md5 = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))
    return (df.withColumn(MD5, md5)
              .withColumn(H, F.conv(F.substring(F.col(MD5), 1, 13), 16, 10).cast("long")))


def largest_remainder(counts: dict, draws: int) -> dict:
    """Allocate ``draws`` over strata proportionally; floors first, then one
    more for the largest fractional parts (ties: stratum order)."""
    n = sum(counts.values())
    if n == 0:
        return {k: 0 for k in counts}
    cont = {k: c / n * draws for k, c in counts.items()}
    out = {k: int(math.floor(v)) for k, v in cont.items()}
    need = draws - sum(out.values())
    for k in sorted(counts, key=lambda k: (-(cont[k] - out[k]), str(k)))[:max(need, 0)]:
        out[k] += 1
    return out


def _tuple_le(m, k, key):
    """(H, md5, key) <= (h, m, k) in lexicographic order; H is the md5's own prefix, so it need not be read."""
    return (F.col(MD5) < F.lit(m)) | ((F.col(MD5) == F.lit(m)) & (F.col(key) <= F.lit(k)))


def _prefix(h: int):
    """The hash prefix ``h`` as the md5's hex digits, for comparisons with the md5 itself."""
    return F.lit(f"{h:0{HBITS // 4}x}" if h < 1 << HBITS else "g")


def _copies(key):
    return ValueError(f"a cut falls between rows of equal {key!r}; add a tie-breaking column to the key")


def rank_cuts(dfh: DataFrame, strata: str | None, counts: dict | None, wanted, key: str = "row_id",
              small: int = 100000, with_counts: bool = False):
    """Predicates selecting, within each stratum ``s``, the ``k`` lowest
    ranked rows for every ``k`` in ``wanted[s]``; all targets share the
    histogram and fetch jobs.  Copies of one key share a hash and can't be
    told apart: a cut that would fall between two of them is refused,
    whatever their number; any other cut keeps its exact quota.

    With ``counts=None`` the stratum sizes are counted first and ``wanted``
    may be a function of them."""
    preds, state = {}, {}
    if counts is None:
        sv = F.col(strata) if strata is not None else F.lit(None).cast("int")
        counts = {r["s"]: r["count"] for r in dfh.groupBy(sv.alias("s")).count().collect()}     # <= #strata rows
    if callable(wanted):
        wanted = wanted(counts)
    for s, ks in wanted.items():
        n = counts.get(s, 0)
        for k in ks:
            if k <= 0:
                preds[(s, k)] = F.lit(False)
            elif k >= n:
                preds[(s, k)] = F.lit(True)
            else:          # interval [lo, lo + 2^bits), rows below it, rows inside
                state[(s, k)] = {"lo": 0, "bits": HBITS, "below": 0, "count": n}

    def narrow(v, rank, cells, shift):
        below = v["below"]
        for d, c in sorted(cells):
            if rank < below + c:
                v.update(lo=v["lo"] + (int(d) << shift), bits=shift, below=below, count=int(c))
                return
            below += c

    def read(t, v, got):
        """The cut's tuple among the sorted rows of its interval."""
        at = t[1] - 1 - v["below"]
        if at + 1 < len(got) and got[at] == got[at + 1]:
            raise _copies(key)
        m, k = got[at]
        preds[t] = _tuple_le(m, k.item() if hasattr(k, "item") else k, key)

    near = {}
    for (s, k), v in state.items():
        n, top = v["count"], 1 << HBITS
        wide = SIGMAS * math.sqrt(k * (n - k) / n) + 64
        if 2 * wide <= small:
            near[(s, k)] = (max(0, int((k - wide) / n * top)), min(top, int((k + wide) / n * top) + 1))
    if near:
        parts = []
        for i, (t, (lo, hi)) in enumerate(near.items()):
            mine, m = _in_stratum(strata, t[0]), F.col(MD5)
            parts += [F.count_if(mine & (m < _prefix(lo))).alias(f"b{i}"),
                      F.collect_list(F.when(mine & (m >= _prefix(lo)) & (m < _prefix(hi)), F.struct(
                          m.alias("m"), F.col(key).alias("k")))).alias(f"r{i}")]
        r = dfh.agg(*parts).first()     # <= small tuples per target
        for i, t in enumerate(near):
            got = sorted(tuple(x) for x in r[f"r{i}"])
            v = {"below": r[f"b{i}"]}
            if 0 <= t[1] - 1 - v["below"] < len(got):
                read(t, v, got)
                del state[t]

    def intervals(items):
        ids = {}
        for t, v in items:
            ids.setdefault((t[0], v["lo"], v["bits"]), len(ids))
        return ids

    def members(iv, lo, bits):
        h = F.col(H)
        return _in_stratum(strata, iv) & (h >= F.lit(lo)) & (h < F.lit(lo + (1 << bits)))

    while True:
        wide = [(t, v) for t, v in state.items() if v["count"] > small and v["bits"] > 0]
        if not wide:
            break
        ids = intervals(wide)
        parts = []
        for (sv, lo, bits), i in ids.items():
            shift = max(bits - DIGIT, 0)
            parts.append(F.when(members(sv, lo, bits), F.struct(
                F.lit(i).alias("i"), F.shiftright(F.col(H) - F.lit(lo), shift).alias("d"))))
        hist = (dfh.select(F.explode(F.array(*parts)).alias("x")).where(F.col("x").isNotNull())
                   .groupBy("x.i", "x.d").count().toPandas())                  # <= 4,096 rows per interval
        for t, v in wide:
            i = ids[(t[0], v["lo"], v["bits"])]
            cells = [(int(d), int(c)) for d, c in hist[hist["i"] == i][["d", "count"]].itertuples(index=False)]
            narrow(v, t[1] - 1, cells, max(v["bits"] - DIGIT, 0))
    for t, v in state.items():
        if v["count"] > small:      # only identical (hash, md5, key) tuples remain: duplicated keys
            raise _copies(key)
    if state:
        ids = intervals(list(state.items()))
        parts = [F.when(members(sv, lo, bits), F.struct(F.lit(i).alias("i"), F.col(MD5).alias("m"), F.col(key).alias("k")))
                 for (sv, lo, bits), i in ids.items()]
        rows = (dfh.select(F.explode(F.array(*parts)).alias("x")).where(F.col("x").isNotNull())
                   .select("x.i", "x.m", "x.k").toPandas())             # <= small rows per interval
        for t, v in state.items():
            i = ids[(t[0], v["lo"], v["bits"])]
            got = sorted(rows[rows["i"] == i][["m", "k"]].itertuples(index=False, name=None))
            read(t, v, got)
    return (preds, counts) if with_counts else preds


def rank_cut(dfh: DataFrame, k: int, n: int, key: str = "row_id"):
    """Predicate selecting the ``k`` lowest-ranked rows of ``dfh``."""
    return rank_cuts(dfh, None, {None: n}, {None: [k]}, key)[(None, k)]


def _in_stratum(strata, value) -> Column:
    if strata is None:
        return F.lit(True)
    return F.col(strata).isNull() if value is None else (F.col(strata) == F.lit(value))


def assign_folds(df: DataFrame, quotas, names, key: str = "row_id", seed: int = 42,
                 strata: str | None = None, out: str = "fold") -> DataFrame:
    """Per stratum, the first quotas[s][0] rows in hash order get names[0],
    the next quotas[s][1] names[1], ..., the rest names[-1].  ``quotas`` may
    be a function of the stratum sizes."""
    dfh = with_hash(df, key, seed)
    box = {}

    def cumulative(counts):
        q = quotas(counts) if callable(quotas) else quotas
        box["acc"] = {s: [sum(qs[:i + 1]) for i in range(len(qs))] for s, qs in q.items()}
        return box["acc"]

    preds = rank_cuts(dfh, strata, None, cumulative, key)
    acc = box["acc"]
    expr = None
    for s, ks in acc.items():
        branch = None
        for k, name in zip(ks, names):
            c = preds[(s, k)]
            branch = F.when(c, F.lit(name)) if branch is None else branch.when(c, F.lit(name))
        branch = branch.otherwise(F.lit(names[-1])) if branch is not None else F.lit(names[-1])
        expr = F.when(_in_stratum(strata, s), branch) if expr is None else expr.when(_in_stratum(strata, s), branch)
    return dfh.withColumn(out, expr).drop(H, MD5)


def split_stratified(df: DataFrame, label: str, test_size: float = 0.30, second_test: float = 0.5,
                     key: str = "row_id", seed: int = 42, out: str = "fold") -> DataFrame:
    """G1: stratified train / validation / test: ceil(30 %) out, then half
    of that (ceil) for test; class quotas by largest remainder."""
    def quotas(counts):
        n = sum(counts.values())
        n_out = int(math.ceil(test_size * n))
        train = largest_remainder(counts, n - n_out)
        temp = {k: counts[k] - train[k] for k in counts}
        n_test = int(math.ceil(second_test * n_out))
        val = largest_remainder(temp, n_out - n_test)
        return {k: [train[k], val[k]] for k in counts}
    return assign_folds(df, quotas, ["train", "val", "test"], key, seed, label, out)


def split_two_way(df: DataFrame, label: str, test_size: float = 0.30, key: str = "row_id",
                  seed: int = 42, out: str = "fold") -> DataFrame:
    """Stratified train / test (70/30, 75/25, ...)."""
    def quotas(counts):
        n = sum(counts.values())
        train = largest_remainder(counts, n - int(math.ceil(test_size * n)))
        return {k: [train[k]] for k in counts}
    return assign_folds(df, quotas, ["train", "test"], key, seed, label, out)


def split_chronological(df: DataFrame, ts: str = "ts", row_id: str = "row_id", train: float = 0.70,
                        val: float = 0.15, out: str = "fold", strategy: str = "auto") -> DataFrame:
    """First int(0.70 n) rows in time order train, next int(0.15 n)
    validation, the rest test (global position via the segmented scan)."""
    d = position(df, [], [ts, row_id], strategy=strategy, pos="_pos", total="_n")
    n_tr = F.floor(F.lit(train) * F.col("_n"))
    n_va = F.floor(F.lit(val) * F.col("_n"))
    fold = (F.when(F.col("_pos") <= n_tr, "train").when(F.col("_pos") <= n_tr + n_va, "val").otherwise("test"))
    return d.withColumn(out, fold).drop("_pos", "_n", "_seg", "_rn")


def split_event_group(df: DataFrame, event_col: str = "event_id", key: str = "row_id", seed: int = 42,
                      test_size: float = 0.30, second_test: float = 0.5, out: str = "fold") -> DataFrame:
    """Group split; every event is one group and every normal row
    (event -1) its own group.  ceil(30 %) of the groups leave training, then
    ceil(half) of those form the test set.  A group is never cut: the fold
    is a function of the group key alone."""
    g = F.when(F.col(event_col) >= 0, F.concat(F.lit("e"), F.col(event_col).cast("string"))) \
         .otherwise(F.concat(F.lit("r"), F.col(key).cast("string")))
    d = df.withColumn("_group", g)
    # distinct groups without a full distinct: normal rows are unique groups
    groups = d.where(F.col(event_col) < 0).select("_group").unionByName(
        d.where(F.col(event_col) >= 0).select("_group").distinct())
    n = groups.count()
    n_out = int(math.ceil(test_size * n))
    n_test = int(math.ceil(second_test * n_out))
    gh = with_hash(groups, "_group", seed)
    # groups ranked by hash: the first n_out leave training; of those the
    # first (n_out - n_test) validate and the rest test
    cuts = rank_cuts(gh, None, {None: n}, {None: [n_out - n_test, n_out]}, "_group")
    c_val, c_out = cuts[(None, n_out - n_test)], cuts[(None, n_out)]
    dh = with_hash(d, "_group", seed)
    return (dh.withColumn(out, F.when(c_val, "val").when(c_out, "test").otherwise("train"))
              .drop("_group", H, MD5))


def sample_stratified(df: DataFrame, label: str | None, n_max: int = 5000, key: str = "row_id",
                      seed: int = 42) -> DataFrame:
    """Stratified sample of min(n_max, n) rows without replacement
    (largest-remainder class allocation); plain sample when no label."""
    dfh = with_hash(df, key, seed)
    box = {}

    def wanted(counts):
        box["take"] = largest_remainder(counts, min(n_max, sum(counts.values())))
        return {s: [k] for s, k in box["take"].items()}

    preds = rank_cuts(dfh, label, None, wanted, key)
    take = box["take"]
    cond = None
    for s, k in take.items():
        c = _in_stratum(label, s) & preds[(s, k)]
        cond = c if cond is None else (cond | c)
    return dfh.where(cond).drop(H, MD5)


def sample_n(df: DataFrame, n: int, key: str = "row_id", seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows in hash order."""
    total = df.count()
    dfh = with_hash(df, key, seed)
    return dfh.where(rank_cut(dfh, n, total, key)).drop(H, MD5)


def balanced_subsample(df: DataFrame, label: str, cap: int = 6000, key: str = "row_id",
                       seed: int = 42) -> DataFrame:
    """n = min(positives, negatives, cap // 2) rows of each class; all
    rows when a class is empty."""
    dfh = with_hash(df, key, seed)
    box = {}

    def wanted(counts):
        box["k"] = min(counts.get(1, 0), counts.get(0, 0), cap // 2)
        return {1: [box["k"]], 0: [box["k"]]}

    preds = rank_cuts(dfh, label, None, wanted, key)
    k = box["k"]
    if k <= 0:
        return df
    c1 = (F.col(label) == 1) & preds[(1, k)]
    c0 = (F.col(label) == 0) & preds[(0, k)]
    return dfh.where(c1 | c0).drop(H, MD5)


def align_semi_join(df: DataFrame, kept: DataFrame, key: str = "row_id") -> DataFrame:
    """rows of ``df`` whose key survives in ``kept`` (left-semi join;
    prefer carrying columns instead of re-aligning)."""
    return df.join(kept.select(key), key, "left_semi")
