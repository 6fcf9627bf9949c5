"""Balanced samples with quotas."""

from pyspark.sql import functions as F

from lexloom import rules
from lexloom.operators.ordered import split_row_number, top_k


def quotas(total, norm_ratio, gazette_ratio):
    """Rows wanted per (normative, in gazette) bucket."""
    norm = round(total * norm_ratio)
    out = {}
    for name, size in (("normative", norm), ("non_normative", total - norm)):
        out[(name, True)] = round(size * gazette_ratio)
        out[(name, False)] = size - out[(name, True)]
    return out


def with_bucket(df):
    return df.withColumns({"_norm": F.when(F.col("type") == rules.NORMATIVE_MODULE, "normative").otherwise("non_normative"), "_gaz": F.col("appears_in_dogc")})


def _hash(ident, seed):
    return F.xxhash64(F.col(ident), F.lit(seed))


def quota_sample(df, total=100, norm_ratio=0.3, gazette_ratio=0.3, max_per=2, seed=42, ident="unit_id"):
    """SMP1: per bucket, round robin over (year, bulletin), at most ``max_per`` per
    institution, topped up from the rest when the caps leave a bucket short.

    Every step is a top-k, so partitions are limited before anything is shuffled. The hash
    order replaces a random sequence: quotas and caps are the contract.
    """
    q = quotas(total, norm_ratio, gazette_ratio)
    largest, b = max(q.values()), ["_norm", "_gaz"]
    want = F.create_map(*[x for (n, g), size in q.items() for x in (F.lit(f"{n}:{str(g).lower()}"), F.lit(size))])
    df = with_bucket(df).withColumns({"_h": _hash(ident, seed)})
    df = df.withColumn("_quota", want[F.concat_ws(":", "_norm", F.col("_gaz").cast("string"))])
    slim = df.select(ident, *b, "_h", "_quota", "institucio", "year", "butlleti")
    capped = top_k(slim, b + ["institucio"], ["_h", ident], max_per, "_i")
    rounds = top_k(capped, b + ["year", "butlleti"], ["_h", ident], largest, "_round")
    picked = top_k(rounds, b, ["_round", "_h", ident], largest, "_n").filter("_n <= _quota").select(ident, *b)
    short = picked.groupBy(*b).agg(F.count(F.lit(1)).alias("_have"))
    rest = top_k(slim.join(picked.select(ident), ident, "left_anti"), b, ["_h", ident], largest, "_n")
    rest = rest.join(short, b, "left").filter(F.col("_n") <= F.col("_quota") - F.coalesce("_have", F.lit(0))).select(ident, *b)
    chosen = picked.select(ident).unionByName(rest.select(ident))
    return df.drop("_h", "_quota").join(chosen, ident, "left_semi").withColumnRenamed("_norm", "bucket").withColumnRenamed("_gaz", "in_gazette")


def valid_pool(df, per_bucket=60, tested=2000, seed=42, ident="unit_id"):
    """SMP2: reachable units of one or two pages, among the first ``tested`` per bucket in
    hash order, at most ``per_bucket`` of them."""
    d = with_bucket(df).withColumn("_h", _hash(ident, seed))
    # ranks in 1024 slices of the hash and their sizes before, as a bucket may hold most units
    d = split_row_number(d, ["_norm", "_gaz"], [F.floor(F.col("_h") / (1 << 54))], ["_h", ident], "_t")
    d = d.filter((F.col("_t") <= tested) & F.col("reachable") & F.col("pages").between(1, 2))
    return top_k(d, ["_norm", "_gaz"], ["_t"], per_bucket, "_n").drop("_h", "_t", "_n")
