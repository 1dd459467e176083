"""Quality rules: base counts, and outliers among a language's and source's documents by robust distance.

The location and scatter of a group are minimum-covariance-determinant estimates: of all subsets of a share of the
rows, the one whose covariance has the least determinant, found by concentration steps from two deterministic starts.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylift.llm.shared import checkpointed, trimmed, words_of

MIN_WORDS = 50
#: Units of a transformed statistic per 1.0; vectors are whole numbers, so that sums over any partitioning agree.
SCALE = 128
#: Statistics of the vector and the least spread each is credited with, since most clean texts have none of the last three.
#: Small enough that each statistic can reject alone, even repeated words, whose root share is at most sqrt(0.5) here.
SPREAD = {"v_length": 0.05, "v_symbols": 0.05, "v_lines": 0.14, "v_repeats": 0.14}
VECTOR = list(SPREAD)
P = len(VECTOR)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
BINS = 4096


# --- counts of one text -------------------------------------------------------------------------------


def repeat_words(words: Column, n: Column) -> Column:
    """Words in three-word windows that the text holds twice or more, in one sort of the window hashes.

    Each window is one long: the upper bits of its hash over its place. Sorted, equal windows are neighbours; their words
    are compared before they count, and a text in which neighbours agree in these bits alone is sorted by words instead.
    Then the places found are merged to stretches. Counts are exact whatever the hashes.
    """
    last = (n - 3).cast("int")
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n < 4, F.lit(0)).otherwise(_covered(hashes, words, n))


def _same_window(words: Column, i: Column, j: Column) -> Column:
    equal = F.lit(True)
    for k in range(3):
        equal = equal & (F.get(words, i + k) == F.get(words, j + k))
    return equal


def _beside_one(pairs: Column, k: Column) -> Column:
    """Whether a place in order equals the next one or the one before."""
    after, before = F.get(pairs, k) == 1, F.when(k > 0, F.get(pairs, k - 1) == 1)
    return F.coalesce(after, F.lit(False)) | F.coalesce(before, F.lit(False))


def _stretches(found: Column) -> Column:
    """Words in the windows that begin at the given places."""
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
    return F.aggregate(
        F.sort_array(found), start,
        lambda acc, x: F.struct((acc["total"] + x + 3 - F.greatest(x, acc["end"])).alias("total"), (x + 3).alias("end")),
        lambda acc: acc["total"],
    )


def _covered_by_words(words: Column, n: Column) -> Column:
    """The same without hashes: windows sorted by their words, so that equal ones are neighbours whatever they are."""
    places = F.sequence(F.lit(0), (n - 3).cast("int"))
    windows = F.transform(places, lambda i: F.struct(*[F.get(words, i + k).alias(f"w{k}") for k in range(3)], i.alias("place")))

    def of_sorted(s: Column) -> Column:
        last = F.size(s) - 1
        pairs = F.transform(
            F.sequence(F.lit(0), last - 1),
            lambda k: F.when(_same_window(words, F.get(s, k)["place"], F.get(s, k + 1)["place"]), F.lit(1)).otherwise(F.lit(0)),
        )

        def of_pairs(p: Column) -> Column:
            equal = F.filter(F.sequence(F.lit(0), last), lambda k: _beside_one(p, k))
            return _stretches(F.transform(equal, lambda k: F.get(s, k)["place"]))

        return F.get(F.transform(F.array(pairs), of_pairs), F.lit(0))

    return F.get(F.transform(F.array(F.sort_array(windows)), of_sorted), F.lit(0))


def _covered(hashes: Column, words: Column, n: Column) -> Column:
    low = F.pow(F.lit(2.0), F.ceil(F.log2(n))).cast("long") - 1

    # A one-element array carries a value into a lambda, so that it is computed once.
    def with_mask(mask: Column) -> Column:
        packed = F.transform(hashes, lambda h, i: h.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")))

        def of_sorted(s: Column) -> Column:
            def beside(k: Column) -> Column:
                """0: the hash bits of this place and the next differ; 1: the windows are equal; 2: only the hash bits are."""
                x, y = F.get(s, k), F.get(s, k + 1)
                i, j = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
                apart = x.bitwiseXOR(y)
                return F.when((apart > mask) | (apart < 0), F.lit(0)).when(_same_window(words, i, j), F.lit(1)).otherwise(F.lit(2))

            def of_pairs(pairs: Column) -> Column:
                places = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: _beside_one(pairs, k))
                found = F.transform(places, lambda k: F.get(s, k).bitwiseAND(mask).cast("int"))
                # Windows that share their hash bits with others may stand between equal ones: then the words are sorted.
                return F.when(F.array_contains(pairs, 2), _covered_by_words(words, n)).otherwise(_stretches(found))

            pairs = F.transform(F.sequence(F.lit(0), F.size(s) - 2), beside)
            return F.get(F.transform(F.array(pairs), of_pairs), F.lit(0))

        return F.get(F.transform(F.array(F.sort_array(packed)), of_sorted), F.lit(0))

    return F.get(F.transform(F.array(low), with_mask), F.lit(0))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "lang", "source", text.alias("text")).withColumn("words", words_of(F.col("text")))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: trimmed(x) != ""))
    n = F.size("words")
    counted = rows.select(
        "doc_id", "lang", "source", n.cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words"), n).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


# --- robust estimates per group ------------------------------------------------------------------------


def _even_chi2(x: float, dof: int) -> float:
    """Distribution function of chi squared, for even degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dof // 2))


def chi2_quantile(q: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _even_chi2(middle, dof) < q else (low, middle)
    return high


def consistency(share: float) -> float:
    """What makes the covariance of the nearest ``share`` of normal rows that of all."""
    return share / _even_chi2(chi2_quantile(share, P), P + 2)


def vectors(stats: DataFrame) -> DataFrame:
    """Log mean word length and square roots of the symbol, repeated-line and repeated-word rates, in whole units."""
    n = F.col("n_words")
    values = [F.log(F.col("word_chars") / n), F.sqrt(F.col("n_symbols") / n), F.sqrt(F.col("n_dup_lines") / F.col("n_lines")), F.sqrt(F.col("n_repeat_words") / n)]
    return stats.withColumns({name: F.round(v * SCALE).cast("long") for name, v in zip(VECTOR, values, strict=True)})


def grouped(rows: DataFrame, least: int) -> DataFrame:
    """Add ``grp``: language and source; sources with fewer than ``least`` rows form one group per language, and languages
    whose pool is still smaller one group of all."""
    own = F.to_json(F.struct("lang", "source"))
    counts = checkpointed(rows.groupBy("lang", "source").agg(F.count("*").alias("rows")))
    pool = F.when(F.col("rows") < least, F.col("rows"))
    counts = counts.withColumn("pooled", F.sum(pool).over(Window.partitionBy("lang")))
    grp = F.when(F.col("rows") >= least, own).when(F.col("pooled") >= least, F.concat(F.lit("pool "), F.to_json(F.struct("lang")))).otherwise("pool")
    named = counts.select(F.col("lang").alias("l"), F.col("source").alias("s"), grp.alias("grp"))
    return rows.join(named, rows["lang"].eqNullSafe(named["l"]) & rows["source"].eqNullSafe(named["s"])).drop("l", "s")


def _median(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Weighted lower median of ``value`` per key; the rows of a key are distinct whole values, not documents."""
    counts = values.groupBy(*keys, value).agg(F.sum("n").alias("n"))
    window = Window.partitionBy(*keys).orderBy(value)
    cut = counts.withColumn("upto", F.sum("n").over(window)).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    return cut.filter("2 * upto >= all").groupBy(*keys).agg(F.min(value).alias("median"))


def _starts(cells: DataFrame) -> DataFrame:
    """For each cell the distances of the two starts, from coordinate-wise median and median deviation: the
    Euclidean and the largest coordinate."""
    long = cells.select("grp", "n", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(v).alias("v")) for i, v in enumerate(VECTOR)])).alias("x"))
    long = long.select("grp", "n", "x.i", "x.v").groupBy("grp", "i", "v").agg(F.sum("n").alias("n"))
    centre = _median(long, ["grp", "i"], "v")
    spread = long.join(centre, ["grp", "i"]).withColumn("off", F.abs(F.col("v") - F.col("median")))
    spread = _median(spread, ["grp", "i"], "off").withColumnRenamed("median", "off")
    floors = F.array(*[F.lit((SPREAD[v] * SCALE) ** 2) for v in VECTOR])
    both = centre.join(spread, ["grp", "i"]).withColumn("variance", F.pow(F.col("off") * 1.4826, 2) + F.get(floors, F.col("i")))
    wide = both.groupBy("grp").agg(*[F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}{i}") for i in range(P) for c in ("median", "variance")])
    apart = [F.pow(F.col(v) - F.col(f"median{i}"), 2) / F.col(f"variance{i}") for i, v in enumerate(VECTOR)]
    total, most = sum(apart[1:], apart[0]), F.greatest(*apart) * P
    found = cells.join(wide, "grp").select("grp", *VECTOR, "n", F.explode(F.array(F.struct(F.lit(0).alias("start"), total.alias("d")), F.struct(F.lit(1).alias("start"), most.alias("d")))).alias("s"))
    return found.select("grp", F.col("s.start").alias("start"), *VECTOR, "n", F.col("s.d").alias("d"))


def _concentrated(apart: DataFrame, share: float) -> DataFrame:
    """Moments of the nearest ``share`` of each group and start: the rows up to the distance bin that reaches the share."""
    binned = apart.withColumn("bin", F.least(F.floor(F.log2(1 + F.col("d")) * 128), F.lit(BINS - 1)).cast("int"))
    counts = binned.groupBy("grp", "start", "bin").agg(F.sum("n").alias("n"))
    key = Window.partitionBy("grp", "start")
    cut = counts.withColumn("upto", F.sum("n").over(key.orderBy("bin"))).withColumn("all", F.sum("n").over(key))
    cut = cut.filter(F.col("upto") >= F.col("all") * share).groupBy("grp", "start").agg(F.min("bin").alias("last"))
    core = binned.join(cut, ["grp", "start"]).filter("bin <= last")
    sums = [F.sum(F.col("n") * F.col(v)).alias(f"s{i}") for i, v in enumerate(VECTOR)]
    products = [F.sum(F.col("n") * F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"q{i}{j}") for i, j in PAIRS]
    return core.groupBy("grp", "start").agg(F.sum("n").alias("h"), *sums, *products)


def _estimates(moments: DataFrame, share: float) -> DataFrame:
    """Centre m, and the covariance (consistent, with the least spreads added) as unit lower triangle l and diagonal d."""
    factor = consistency(share)
    out = moments.withColumns({f"m{i}": F.col(f"s{i}") / F.col("h") for i in range(P)})
    cov = {}
    for i, j in PAIRS:
        spread = (SPREAD[VECTOR[i]] * SCALE) ** 2 if i == j else 0.0
        raw = F.col(f"q{i}{j}") / F.col("h") - F.col(f"m{i}") * F.col(f"m{j}")
        cov[f"c{i}{j}"] = (F.greatest(raw, F.lit(0.0)) if i == j else raw) * factor + spread
    out = out.withColumns(cov)
    for i in range(P):
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}") * F.col(f"d{k}")
            # Rounding may not leave a spread below the least one, which is what keeps distances finite.
            out = out.withColumn(f"d{i}", F.greatest(rest, F.lit((SPREAD[VECTOR[i]] * SCALE) ** 2))) if i == j else out.withColumn(f"l{i}{j}", rest / F.col(f"d{j}"))
    det = F.lit(0.0)
    for i in range(P):
        det = det + F.log(F.col(f"d{i}"))
    keep = [f"m{i}" for i in range(P)] + [f"l{i}{j}" for i, j in PAIRS if i != j] + [f"d{i}" for i in range(P)]
    return out.select("grp", "start", "h", *keep, det.alias("log_det"))


def _distance(rows: DataFrame) -> Column:
    """Squared Mahalanobis distance of a row that carries its group's estimates."""
    y: list[Column] = []
    for i, v in enumerate(VECTOR):
        off = F.col(v) - F.col(f"m{i}")
        for k in range(i):
            off = off - F.col(f"l{i}{k}") * y[k]
        y.append(off)
    total = F.lit(0.0)
    for i in range(P):
        total = total + y[i] * y[i] / F.col(f"d{i}")
    return total


def robust_estimates(rows: DataFrame, share: float) -> DataFrame:
    """A row per ``grp`` of ``rows`` (with a vector): the estimate of lower determinant of the two starts.

    Equal vectors of a group are counted together first, map-side, so that the steps read counts and not documents, and
    a group with a third of all rows is no larger than its distinct vectors. Each start takes steps for as long as they
    lower its determinant, which ends by itself, since there are finitely many subsets; there is no limit of steps.
    """
    cells = checkpointed(rows.groupBy("grp", *VECTOR).agg(F.count("*").alias("n")))
    moving = checkpointed(_estimates(_concentrated(_starts(cells), share), share))
    rested: list[DataFrame] = []
    while not moving.isEmpty():
        apart = cells.join(moving, "grp")
        apart = apart.select("grp", "start", *VECTOR, "n", _distance(apart).alias("d"))
        stepped = _estimates(_concentrated(apart, share), share)
        before = moving.select("grp", "start", F.col("log_det").alias("was"))
        both = checkpointed(stepped.join(before, ["grp", "start"]))
        lower = F.col("log_det") < F.col("was")
        # A start whose step no longer lowers the determinant rests where it was; the others go on.
        rested.append(moving.join(both.filter(~lower).select("grp", "start"), ["grp", "start"], "left_semi"))
        moving = both.filter(lower).drop("was")
    estimates = reduce(DataFrame.unionByName, rested, moving)
    ordered = Window.partitionBy("grp").orderBy("log_det", "start")
    return estimates.withColumn("turn", F.row_number().over(ordered)).filter("turn = 1").drop("turn", "start")


def judged(docs: DataFrame, share: float = 0.75, tail: float = 1e-3, least: int = 30) -> DataFrame:
    """Every document with its counts and verdict: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, distance.

    Documents that fail the base rules (too few words, mostly repeated ones) are not kept and have no distance. The
    others are grouped by language and source (null is a value; small groups are pooled, see ``grouped``), and those
    whose squared distance from their group's robust estimate exceeds the chi-squared quantile of 1 - ``tail`` are not
    kept. Null and empty texts have no words and fail. Equal rows get equal verdicts. Columns besides doc_id, text,
    lang and source are not read. An empty table gives no rows.
    """
    stats = checkpointed(statistics(docs.select("doc_id", "text", "lang", "source")))
    passed = checkpointed(grouped(vectors(stats.filter("NOT base_failed")), least))
    estimates = checkpointed(robust_estimates(passed, share))
    measured = passed.join(estimates, "grp")
    limit = chi2_quantile(1 - tail, P)
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    near = measured.select(*counts, _distance(measured).alias("distance")).withColumn("kept", F.col("distance") <= limit)
    failed = stats.filter("base_failed").select(*counts, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return near.unionByName(failed).select(*counts, "kept", "distance")
