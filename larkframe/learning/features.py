"""Feature steps that learn from training rows and apply to any table.

A step is a function ``learn(train) -> apply``, where ``apply`` maps a DataFrame to a DataFrame. ``prep`` learns a list of
steps in order, each on the training rows as the earlier steps leave them; ``bake`` applies the learned steps. What is
learned is a few numbers per column, or a level table that is joined back.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkframe.operators.grouping import FEW, group_join, match_join, one_row
from larkframe.operators.hashing import hash_positions, uniform
from larkframe.operators.moments import collect_moments, correlations, fit_ols
from larkframe.operators.neighbors import knn
from larkframe.operators.quantiles import long_form, quantile_values
from larkframe.session import materialized

Apply = Callable[[DataFrame], DataFrame]
Step = Callable[[DataFrame], Apply]
MAX_LEVELS = 1000  # one indicator column per level
FREQUENT = 100_000  # terms whose counts go to every task


def prep(train: DataFrame, steps: list[Step]) -> list[Apply]:
    out = []
    for step in steps:
        done = step(train)
        out.append(done)
        train = done(train)
    return out


def bake(prepped: list[Apply], df: DataFrame) -> DataFrame:
    for done in prepped:
        df = df.transform(done)
    return df


def stateless(fn: Apply) -> Step:
    return lambda train: fn


def _columns(cols: list[str], make: Callable[[str], Column]) -> Apply:
    return lambda df: df.withColumns({c: make(c) for c in cols})


# Numeric scales and transforms

def _mean_sd(train: DataFrame, cols: list[str]) -> dict:
    return one_row(train, **{f"m_{c}": F.avg(c) for c in cols}, **{f"s_{c}": F.stddev_samp(c) for c in cols})


def center(cols: list[str]) -> Step:
    def learn(train):
        s = _mean_sd(train, cols)
        return _columns(cols, lambda c: F.col(c) - s[f"m_{c}"])
    return learn


def scale(cols: list[str]) -> Step:
    def learn(train):
        s = _mean_sd(train, cols)
        return _columns(cols, lambda c: F.col(c) / (s[f"s_{c}"] or None))
    return learn


def normalize(cols: list[str]) -> Step:
    def learn(train):
        s = _mean_sd(train, cols)
        return _columns(cols, lambda c: (F.col(c) - s[f"m_{c}"]) / (s[f"s_{c}"] or None))
    return learn


def min_max(cols: list[str], lo: float = 0.0, hi: float = 1.0) -> Step:
    """Training range to [lo, hi]; new values outside it are clipped."""
    def learn(train):
        s = one_row(train, **{f"a_{c}": F.min(c) for c in cols}, **{f"b_{c}": F.max(c) for c in cols})

        def one(c):
            width = (s[f"b_{c}"] - s[f"a_{c}"]) if s[f"a_{c}"] is not None else 0
            if not width:  # a constant column goes to the lower end
                return F.when(F.col(c).isNotNull(), F.lit(float(lo)))
            z = lo + (F.col(c) - s[f"a_{c}"]) * (hi - lo) / width
            return F.greatest(F.lit(lo), F.least(F.lit(hi), z))
        return _columns(cols, one)
    return learn


def robust(cols: list[str]) -> Step:
    """Subtract the median, divide by 1.4826 times the median absolute deviation."""
    def learn(train):
        med = {c: v["m"] for c, v in quantile_values(train, cols, {"m": 0.5}).items()}
        dev = train.select(*[F.abs(F.col(c) - med[c]).alias(c) for c in cols])
        mad = {c: 1.4826 * v["m"] for c, v in quantile_values(dev, cols, {"m": 0.5}).items()}
        return _columns(cols, lambda c: (F.col(c) - med[c]) / (mad[c] or None))
    return learn


def log(cols: list[str], offset: float = 0.0) -> Step:
    return stateless(_columns(cols, lambda c: F.ln(F.col(c) + offset)))


def sqrt(cols: list[str]) -> Step:
    return stateless(_columns(cols, lambda c: F.sqrt(c)))


def yeo_johnson(x: Column, lam: float | Column) -> Column:
    lam = F.lit(lam)
    pos = F.when(F.abs(lam) < 1e-9, F.ln(x + 1)).otherwise((F.pow(x + 1, lam) - 1) / lam)
    neg = F.when(F.abs(lam - 2) < 1e-9, -F.ln(1 - x)).otherwise(-(F.pow(1 - x, 2 - lam) - 1) / (2 - lam))
    return F.when(x >= 0, pos).otherwise(neg)


def box_cox(x: Column, lam: float | Column) -> Column:
    lam = F.lit(lam)
    return F.when(F.abs(lam) < 1e-9, F.ln(x)).otherwise((F.pow(x, lam) - 1) / lam)


LAMBDAS = [round(-2 + 0.1 * i, 1) for i in range(41)]


def best_lambda(df: DataFrame, col: str, kind: str, lambdas: list[float] = LAMBDAS) -> float:
    """Exponent with the highest normal log-likelihood; one aggregation gives the likelihood of every candidate.

    Candidates are groups of rows, not columns: dozens of variances side by side make code too long for the JVM to compile.
    """
    x = F.col(col)
    if kind == "yeo_johnson":
        fn, jac = yeo_johnson, F.sum(F.signum(x) * F.ln(F.abs(x) + 1))
    else:
        fn, jac = box_cox, F.sum(F.ln(x))
    rows = df.where(x.isNotNull()).select(x)
    s = one_row(rows, n=F.count(x), j=jac)
    each = rows.select(x.alias("x"), F.posexplode(F.array(*[F.lit(lam) for lam in lambdas])).alias("place", "lam"))
    v = {r["place"]: r["v"] for r in each.groupBy("place").agg(F.var_pop(fn(F.col("x"), F.col("lam"))).alias("v")).collect()}
    lik = [-s["n"] / 2 * np.log(v[i]) + (lam - 1) * s["j"] for i, lam in enumerate(lambdas)]
    return lambdas[int(np.argmax(lik))]


def power(cols: list[str], kind: str = "yeo_johnson") -> Step:
    """Yeo-Johnson, or Box-Cox for the columns that are positive in training."""
    fn = yeo_johnson if kind == "yeo_johnson" else box_cox

    def learn(train):
        use = cols
        if kind == "box_cox":
            low = one_row(train, **{c: F.min(c) for c in cols})
            use = [c for c in cols if low[c] > 0]
        lam = {c: best_lambda(train, c, kind) for c in use}
        return _columns(use, lambda c: fn(F.col(c), lam[c]))
    return learn


# Categories

def levels_of(train: DataFrame, col: str) -> list[str]:
    """Sorted levels; a column that would need more indicator columns than the limit is an error."""
    rows = train.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col).limit(MAX_LEVELS + 1).collect()
    if len(rows) > MAX_LEVELS:
        raise ValueError(f"{col} has more than {MAX_LEVELS} levels; lump or encode it first")
    return [r[0] for r in rows]


def dummy(col: str, levels: list[str] | None = None) -> Step:
    """Indicators for all levels but the first."""
    def learn(train):
        rest = (levels or levels_of(train, col))[1:]
        return lambda df: df.withColumns({f"{col}_{v}": (F.col(col) == v).cast("int") for v in rest}).drop(col)
    return learn


def _with_table(df: DataFrame, col: str, table: DataFrame) -> DataFrame:
    return group_join(df, table, [col], "left")


def other(col: str, threshold: float) -> Step:
    """Levels with a training share below the threshold, and unseen levels, become "other"."""
    def learn(train):
        n = train.count()
        keep = train.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n * threshold).select(col, F.lit(True).alias("_keep"))
        return lambda df: _with_table(df, col, keep).withColumn(col, F.when(F.col(col).isNull() | F.col("_keep"), F.col(col)).otherwise("other")).drop("_keep")
    return learn


def novel(col: str, name: str = "new") -> Step:
    def learn(train):
        seen = train.select(col).distinct().withColumn("_seen", F.lit(True))
        return lambda df: _with_table(df, col, seen).withColumn(col, F.when(F.col(col).isNull() | F.col("_seen"), F.col(col)).otherwise(name)).drop("_seen")
    return learn


def unknown(col: str, name: str = "unknown") -> Step:
    return stateless(lambda df: df.withColumn(col, F.coalesce(F.col(col), F.lit(name))))


def frequency(col: str, out: str) -> Step:
    def learn(train):
        t = train.groupBy(col).agg(F.count(F.lit(1)).alias(out))
        return lambda df: _with_table(df, col, t).fillna({out: 0})
    return learn


def target_mean(col: str, y: str, out: str, smoothing: float = 0.0) -> Step:
    """Level mean of the target, drawn to the overall mean by ``smoothing`` rows; unseen levels get the overall mean."""
    def learn(train):
        overall = one_row(train, m=F.avg(y))["m"]
        t = train.groupBy(col).agg(((F.sum(y) + overall * smoothing) / (F.count(y) + smoothing)).alias(out))
        return lambda df: _with_table(df, col, t).fillna({out: overall})
    return learn


# Columns made from columns

def mutate(**exprs: Callable[[], Column]) -> Step:
    return stateless(lambda df: df.withColumns({n: e() for n, e in exprs.items()}))


def interact(a: str, b: str) -> Step:
    return stateless(lambda df: df.withColumn(f"{a}_x_{b}", F.col(a) * F.col(b)))


def remove(*cols: str) -> Step:
    return stateless(lambda df: df.drop(*cols))


def poly2(col: str) -> Step:
    """Orthogonal terms of degree 1 and 2: zero mean, unit length and zero product on the training rows."""
    def learn(train):
        m = one_row(train, m=F.avg(col))["m"]
        c = F.col(col) - m
        s = one_row(train, n=F.count(c), s2=F.sum(c * c), s3=F.sum(c * c * c), s4=F.sum(c * c * c * c))
        a, b = s["s3"] / s["s2"], s["s2"] / s["n"]
        norm2 = s["s4"] - a * s["s3"] - b * s["s2"]
        return lambda df: df.withColumns({f"{col}_poly_1": c / s["s2"] ** 0.5, f"{col}_poly_2": (c * c - a * c - b) / norm2 ** 0.5})
    return learn


def natural_spline(col: str, df_: int = 5) -> Step:
    """Natural cubic spline basis: knots at training quantiles, linear beyond the outer knots."""
    def learn(train):
        probs = {f"k{i}": i / df_ for i in range(df_ + 1)}
        q = quantile_values(train, [col], probs)[col]
        knots = sorted({q[f"k{i}"] for i in range(df_ + 1)})
        top, span, x = len(knots) - 1, knots[-1] - knots[0], F.col(col)

        def cube(k):
            return F.pow(F.greatest(x - knots[k], F.lit(0.0)) / span, F.lit(3))

        def d(k):
            return (cube(k) - cube(top)) * span / (knots[top] - knots[k])
        return lambda df: df.withColumns({f"{col}_ns_1": x / span, **{f"{col}_ns_{k + 2}": d(k) - d(top - 1) for k in range(top - 1)}})
    return learn


def pca(cols: list[str], k: int, prefix: str = "PC") -> Step:
    """Principal component scores; the covariance is summed on the executors."""
    def learn(train):
        va = VectorAssembler(inputCols=cols, outputCol="_v")
        means = _mean_sd(train, cols)
        centred = lambda df: df.withColumns({c: F.col(c) - means[f"m_{c}"] for c in cols})
        model = PCA(k=k, inputCol="_v", outputCol="_pc").fit(va.transform(centred(train)))

        def apply(df):
            s = vector_to_array("_pc")
            out = model.transform(va.transform(centred(df)))
            return out.withColumns({f"{prefix}{i + 1}": s[i] for i in range(k)}).drop("_v", "_pc", *cols)
        return apply
    return learn


# Filters on columns

def near_zero_variance(train: DataFrame, cols: list[str], ratio: float = 95 / 5, unique: float = 0.1) -> list[str]:
    """Constant columns, and columns whose top value is too frequent and that have few distinct values."""
    n = train.count()
    c = long_form(train, [], cols).groupBy("measure", "value").agg(F.count(F.lit(1)).alias("k"))
    top = c.groupBy("measure").agg(F.max("k").alias("k1"), F.count(F.lit(1)).alias("distinct"), F.max_by("value", "k").alias("_v"))
    second = group_join(c, top.select("measure", "_v"), ["measure"]).where(~F.col("value").eqNullSafe(F.col("_v"))).groupBy("measure").agg(F.max("k").alias("k2"))
    t = match_join(top, second, ["measure"], "left")
    bad = F.col("k2").isNull() | ((F.col("k1") / F.col("k2") > ratio) & (F.col("distinct") / F.lit(n) <= unique))
    return [r["measure"] for r in t.where(bad).select("measure").collect()]  # at most one row per column


def drop_nzv(cols: list[str]) -> Step:
    def learn(train):
        bad = near_zero_variance(train, cols)
        return lambda df: df.drop(*bad)
    return learn


def correlated(train: DataFrame, cols: list[str], threshold: float) -> list[str]:
    """Columns to drop so that no pair is above the threshold: of the worst pair, the one with the larger mean correlation goes."""
    c = np.abs(correlations(collect_moments(train, cols)[None]))
    np.fill_diagonal(c, 0)
    left, drop = list(range(len(cols))), []
    while True:
        sub = np.nan_to_num(c[np.ix_(left, left)])
        if not len(left) or sub.max() <= threshold:
            return drop
        i, j = np.unravel_index(sub.argmax(), sub.shape)
        worst = i if sub[i].mean() >= sub[j].mean() else j
        drop.append(cols[left[worst]])
        left.pop(int(worst))


def drop_correlated(cols: list[str], threshold: float) -> Step:
    def learn(train):
        bad = correlated(train, cols, threshold)
        return lambda df: df.drop(*bad)
    return learn


# Missing values

def impute_mean(cols: list[str]) -> Step:
    def learn(train):
        s = one_row(train, **{c: F.avg(c) for c in cols})
        return lambda df: df.fillna(s)
    return learn


def impute_median(cols: list[str]) -> Step:
    def learn(train):
        s = {c: v["m"] for c, v in quantile_values(train, cols, {"m": 0.5}).items()}
        return lambda df: df.fillna(s)
    return learn


def impute_mode(col: str) -> Step:
    """Most frequent level; equal counts go to the first in text order."""
    def learn(train):
        top = train.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("k")).orderBy(F.col("k").desc(), col).first()
        return lambda df: df.fillna({col: top[0]})
    return learn


def impute_linear(col: str, using: list[str]) -> Step:
    """Prediction of a regression on complete training rows."""
    def learn(train):
        f = fit_ols(train.dropna(subset=[col] + using), col, using)
        return lambda df: df.withColumn(col, F.coalesce(F.col(col), f.predict()))
    return learn


def impute_knn(key: str, col: str, using: list[str], k: int = 5) -> Step:
    """Mean of the k nearest complete training rows, distances on standardised columns."""
    def learn(train):
        s = _mean_sd(train, using)
        vec = F.array(*[(F.col(c) - s[f"m_{c}"]) / (s[f"s_{c}"] or 1.0) for c in using])  # a constant column adds no distance
        donors = train.dropna(subset=[col] + using).select(key, vec.alias("vec"), F.col(col).alias("_donor"))

        def apply(df):
            gaps = df.where(F.col(col).isNull()).dropna(subset=using).select(key, vec.alias("vec"))
            near = knn(donors, gaps, k, key=key, same=False)
            value = near.join(donors.select(F.col(key).alias("nid"), "_donor"), "nid").groupBy(F.col("qid").alias(key)).agg(F.avg("_donor").alias("_fill"))
            return df.join(value, key, "left").withColumn(col, F.coalesce(F.col(col), F.col("_fill"))).drop("_fill")
        return apply
    return learn


# Class balance

def class_counts(df: DataFrame, y: str) -> dict:
    return {r[0]: r[1] for r in df.groupBy(y).agg(F.count(F.lit(1))).collect()}  # one row per class


def upsample(df: DataFrame, key: str, y: str, ratio: float = 1.0, seed: str = "up") -> DataFrame:
    """Minority rows repeated until each class has ratio times the majority; the extra rows go to the first in hash order."""
    n = class_counts(df, y)
    top = max(n.values())
    d = hash_positions(df, [key], seed, [y], "_pos", "_n")
    want = F.greatest(F.floor(F.lit(top * ratio)), F.col("_n"))
    copies = F.floor(want / F.col("_n")) + (F.col("_pos") <= want % F.col("_n")).cast("long")
    return d.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))).drop("_pos", "_n")


def downsample(df: DataFrame, key: str, y: str, ratio: float = 1.0, seed: str = "down") -> DataFrame:
    """Majority rows thinned to ratio times the smallest class, in hash order."""
    keep = int(min(class_counts(df, y).values()) * ratio)
    return hash_positions(df, [key], seed, [y], "_pos", "_n").where(F.col("_pos") <= keep).drop("_pos", "_n")


def smote(df: DataFrame, key: str, y: str, minority, xs: list[str], ratio: float = 1.0, k: int = 5, seed: str = "smote") -> DataFrame:
    """Synthetic minority rows on the lines to near minority neighbours; neighbour and place on the line come from the row hash."""
    n = class_counts(df, y)
    need = int(max(n.values()) * ratio) - n[minority]
    k = min(k, n[minority] - 1)  # a small class has fewer neighbours; a single row is its own
    s = _mean_sd(df, xs)
    few = df.where(F.col(y) == minority).select(key, *xs, F.array(*[(F.col(c) - s[f"m_{c}"]) / (s[f"s_{c}"] or 1.0) for c in xs]).alias("vec"))
    base = hash_positions(few, [key], seed, None, "_pos", "_n")
    copies = F.floor(F.lit(need) / F.col("_n")) + (F.col("_pos") <= need % F.col("_n")).cast("long")
    made = base.where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    made = made.withColumn("place", (F.floor(uniform([key, "copy"], seed + "-n") * max(k, 1)) + 1).cast("int")).withColumn("_w", uniform([key, "copy"], seed + "-w"))
    near = knn(few, few, k, key=key).select(F.col("qid").alias(key), "nid", "place") if k else few.select(key, F.col(key).alias("nid"), F.lit(1).alias("place"))
    mate = few.select(F.col(key).alias("nid"), *[F.col(c).alias(f"_{c}") for c in xs])
    j = made.join(near, [key, "place"]).join(mate, "nid")
    return j.select(key, "copy", *[(F.col(c) + F.col("_w") * (F.col(f"_{c}") - F.col(c))).alias(c) for c in xs], F.lit(minority).alias(y))


def normal(keys: list[str], seed: str) -> Column:
    """Standard normal number from two uniforms of the row."""
    return F.sqrt(-2 * F.ln(1 - uniform(keys, seed + "a"))) * F.cos(2 * F.pi() * uniform(keys, seed + "b"))


def rose(df: DataFrame, key: str, y: str, xs: list[str], seed: str = "rose") -> DataFrame:
    """Smoothed bootstrap: each class drawn with replacement to half the table, plus normal noise of a kernel bandwidth."""
    total, d = df.count(), len(xs)
    classes = class_counts(df, y)
    half = total // len(classes)
    placed = hash_positions(df, [key], seed, [y], "_pos", "_n")
    s = placed.groupBy(y).agg(*[F.stddev_samp(c).alias(f"_s_{c}") for c in xs])
    # draws: positions 1..half per class come from the rows themselves, spread over the classes
    draws = hash_positions(df.select(key), [key], seed + "-d", None, "draw", "_t").where(F.col("draw") <= half).select("draw")
    draws = draws.withColumn(y, F.explode(F.array(*[F.lit(c) for c in sorted(classes)])))
    draws = match_join(draws, placed.groupBy(y).agg(F.max("_n").alias("_n")), [y])
    pick = (F.floor(uniform([y, "draw"], seed) * F.col("_n")) + 1).alias("_pos")
    j = match_join(match_join(draws.select(y, "draw", pick), placed, [y, "_pos"]), s, [y])
    h = F.pow(4.0 / ((d + 2) * F.col("_n")), F.lit(1.0 / (d + 4)))
    return j.select(y, "draw", *[(F.col(c) + h * F.col(f"_s_{c}") * normal([y, "draw"], f"{seed}-{c}")).alias(c) for c in xs])


def class_weights(df: DataFrame, y: str, out: str = "weight") -> DataFrame:
    """Weight n / (classes * n of the class)."""
    n = class_counts(df, y)
    t = df.groupBy(y).agg((F.lit(sum(n.values()) / len(n)) / F.count(F.lit(1))).alias(out))
    return group_join(df, t, [y])


# Text

def tokens(text: Column) -> Column:
    """Lower-case runs of letters, digits and apostrophes."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}']+)"), F.lit(1))


# The usual English stop words.
STOP_WORDS = """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its
itself they them their theirs themselves what which who whom this that these those am is are was were be been being have has had
having do does did doing would should could ought i'm you're he's she's it's we're they're i've you've we've they've i'd you'd he'd
she'd we'd they'd i'll you'll he'll she'll we'll they'll isn't aren't wasn't weren't hasn't haven't hadn't doesn't don't didn't won't
wouldn't shan't shouldn't can't cannot couldn't mustn't let's that's who's what's here's there's when's where's why's how's a an the
and but if or because as until while of at by for with about against between into through during before after above below to from up
down in out on off over under again further then once here there when where why how all any both each few more most other some such
no nor not only own same so than too very""".split()


def without_stop_words(words: Column) -> Column:
    return F.filter(words, lambda w: ~w.isin(*STOP_WORDS))


def bigrams(words: Column) -> Column:
    n = F.size(words)
    head, rest = F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(0)))
    return F.zip_with(head, rest, lambda a, b: F.concat_ws("_", a, b))


def term_counts(df: DataFrame, key: str, words: Column) -> DataFrame:
    """(key, term, tf) rows; a sparse long table instead of one column per term."""
    return df.select(key, F.explode(words).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def _counted(df: DataFrame, key: str) -> DataFrame:
    """(key, _len, term, tf) of every row by itself: its terms are sorted in place and runs of equal ones counted, so nothing is shuffled."""
    d = df.where(F.size("_w") > 0).select(key, "_len", F.array_sort("_w").alias("_s"))
    at = F.filter(F.sequence(F.lit(1), F.size("_s")), lambda i: (i == 1) | ~F.get("_s", i - 1).eqNullSafe(F.get("_s", i - 2)))
    d = d.withColumn("_at", at)
    runs = F.transform("_at", lambda i, k: F.struct(
        F.get("_s", i - 1).alias("term"), (F.coalesce(F.get("_at", k + 1), F.size("_s") + 1) - i).cast("long").alias("tf")))
    return d.select(key, "_len", F.inline(runs))


def terms_by_row(df: DataFrame, key: str, words: Column) -> DataFrame:
    """(key, _len, term, tf), with rows of one key and length taken together; only rows that are not alone in that are shuffled."""
    d = df.select(key, F.size(words).alias("_len"), words.alias("_w"))
    twice = materialized(d.groupBy(key, "_len").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").drop("_c"))
    n = twice.limit(FEW + 1).count()
    if not n:
        return _counted(d, key)
    if n <= FEW:
        alone, more = (match_join(d, F.broadcast(twice), [key, "_len"], how) for how in ("left_anti", "left_semi"))
    else:
        alone, more = d.limit(0), d
    more = more.select(key, "_len", F.explode("_w").alias("term")).groupBy(key, "_len", "term").agg(F.count(F.lit(1)).alias("tf"))
    return _counted(alone, key).unionByName(more)


def tf_idf(df: DataFrame, key: str, words: Column, n_docs: int) -> DataFrame:
    """(key, term, tf, tfidf): share of the document times ln(1 + documents / documents with the term).

    The document length travels with its terms; the only join is with the table of terms. Its FREQUENT most frequent ones, which have
    most of the rows, go to every task; only the rows of the others are shuffled.
    """
    d = terms_by_row(df, key, words)
    terms = materialized(d.groupBy("term").agg(F.count(F.lit(1)).alias("_df")))
    if terms.limit(FREQUENT + 1).count() <= FREQUENT:
        got = match_join(d, F.broadcast(terms), ["term"])
    else:
        top = materialized(terms.orderBy(F.col("_df").desc(), "term").limit(FREQUENT))
        rare = match_join(terms, F.broadcast(top), ["term"], "left_anti")
        got = match_join(d, F.broadcast(top), ["term"]).unionByName(match_join(match_join(d, F.broadcast(top), ["term"], "left_anti"), rare, ["term"]))
    got = got.withColumn("tfidf", F.col("tf") / F.col("_len") * F.ln(1 + F.lit(n_docs) / F.col("_df")))
    return got.select(key, "term", "tf", "tfidf")
